"""Source divergence audit against plain Python, and its skyband against the definition."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from latewatch.llm import divergence

from .support import ODD_TEXTS, documents, rows


def brute(docs, least=10, k=10):
    """docs: (lang, source, text) with nulls; the rows of audit() in plain whole numbers."""
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    groups, in_docs = defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in docs:
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(lower))
        groups[lang or "", source or ""].update(terms)
        in_docs[lang or ""].update(set(terms))
    out = set()
    for lang in in_docs:
        kept = [t for t, n in in_docs[lang].items() if n >= least]
        own = {s: {t: c[t] for t in kept} for (g, s), c in groups.items() if g == lang}
        whole = {t: sum(c[t] for c in own.values()) for t in kept}
        p_of = lambda c: {t: 1 + 10**9 * (c[t] + 2) // (sum(c.values()) + 2 * len(kept)) for t in kept}
        q, p = p_of(whole), {s: p_of(c) for s, c in own.items()}
        f = lambda x, y: (x - y) ** 2 // (x + y)
        for s in own:
            pairs = [(o, sum(f(p[s][t], p[o][t]) for t in kept)) for o in own if o != s]
            terms = [(t, f(p[s][t], q[t])) for t in kept if own[s][t] > 0 and p[s][t] > q[t]]
            for part, found, top in (("pair", pairs, len(pairs)), ("term", terms, k)):
                ranked = sorted(found, key=lambda x: (-x[1], x[0].encode()))[:top]
                out |= {(lang, s, part, item, value, i + 1) for i, (item, value) in enumerate(ranked)}
    return out


def judged(df):
    found = [(r["lang"], r["source"], r["part"], r["item"], r["value"], r["rank"]) for r in rows(df)]
    assert len(found) == len(set(found))
    return set(found)


def some(seed, n=400, sources=5, words=60):
    rng = random.Random(seed)
    vocabulary = [rng.choice(["Aé", "ß", "w", "漢", "Z"]) + "".join(rng.choices("abcÀ字", k=rng.randint(0, 3))) for _ in range(words)]
    out = []
    for _ in range(n):
        s = rng.choice([None, "", *(f"s{i}" for i in range(sources))])
        weights = [1 / (1 + (i * (7 if s else 3)) % words) for i in range(words)]
        out.append((rng.choice(["en", "en", "de", None, ""]), s, " ".join(rng.choices(vocabulary, weights, k=rng.randint(0, 30)))))
    return out + [("only", "one", "too rare to be kept"), ("bare", "a", None), ("bare", "b", "12 ?!")]


@pytest.mark.parametrize("block, held", [(1 << 16, 1 << 18), (64, 40)])
def test_audit_against_brute_force(spark, monkeypatch, block, held):
    monkeypatch.setattr(divergence, "BLOCK", block)
    monkeypatch.setattr(divergence, "HELD", held)
    docs = some(5)
    df = spark.createDataFrame(docs, "lang string, source string, text string").repartition(7)
    kept = divergence.kept_terms(df.na.fill(""), 10)
    totals = divergence.group_totals(df.na.fill("").select("lang", "source").distinct(), kept)
    want = {x[:2] + x[3:5] for x in brute(docs) if x[2] == "pair"}
    assert {tuple(r) for r in divergence.pairs(kept, totals, block).collect()} == want
    assert judged(divergence.audit(df)) == brute(docs)
    assert judged(divergence.audit(df, least=2, k=3)) == brute(docs, 2, 3)


def test_skyband_against_its_definition():
    rng = random.Random(3)
    for size in (0, 1, 7, 200):
        for k in (1, 3, 10):
            n = np.array([rng.randint(1, 6) for _ in range(size)], np.int64)
            low = n + np.array([rng.randint(0, 6) for _ in range(size)], np.int64)
            terms = np.empty(size, object)
            terms[:] = [f"t{i}".encode() for i in rng.sample(range(10 * size + 1), size)]
            want = [i for i in range(size) if sum(n[j] >= n[i] and low[j] <= low[i] and terms[j] < terms[i] for j in range(size)) < k]
            assert sorted(divergence.skyband(n, low, terms, k).tolist()) == want


def test_bands_handed_on_early_lose_nothing(spark):
    docs = some(9, n=300)
    df = spark.createDataFrame(docs, "lang string, source string, text string").coalesce(1)
    bands = divergence._Bands(2)
    rng = random.Random(1)
    data = [(("l", f"s{i % 3}"), rng.randint(1, 9), rng.randint(9, 20), f"t{i}".encode()) for i in range(300)]
    seen = []
    for lo in range(0, 300, 50):
        part = data[lo:lo + 50]
        terms = np.empty(len(part), object)
        terms[:] = [x[3] for x in part]
        bands.add([x[0] for x in part], [np.array([x[1] for x in part]), np.array([x[2] for x in part]), np.zeros(len(part), np.int64), terms])
        if lo % 100:
            seen.append(bands.flush())
    got = {(r["source"], r["term"]) for b in seen for r in b.to_pylist()}
    for s in range(3):
        rows_ = [x for x in data if x[0][1] == f"s{s}"]
        for x in rows_:
            if sum(y[1] >= x[1] and y[2] <= x[2] and y[3] < x[3] for y in rows_) < 2:
                assert (f"s{s}", x[3]) in got
    assert judged(divergence.audit(df)) == brute(docs)


def test_shares_are_exact_for_large_counts():
    rng = random.Random(2)
    for _ in range(2000):
        total = rng.randint(4, 9 * 10**15)
        count = rng.randint(0, total - 2)
        assert divergence.share(np.array([count]), np.array([total]))[0] == 1 + 10**9 * (count + 2) // total


def test_odd_and_empty_tables(spark):
    df = documents(spark, ODD_TEXTS * 12)
    docs = [(r["lang"], r["source"], r["text"]) for r in rows(df)]
    assert judged(divergence.audit(df)) == brute(docs)
    empty = divergence.audit(df.limit(0))
    assert empty.columns == ["lang", "source", "part", "item", "value", "rank"] and rows(empty) == []
