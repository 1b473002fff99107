"""Substring dedup against plain Python, its sketch and its plan."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from latewatch.llm import substring

from .support import ODD_TEXTS, documents, rows


def brute(texts, width):
    """(kept text, words, removed) of each text."""
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    seen = Counter(tuple(w[i:i + width]) for w in words for i in range(len(w) - width + 1))
    out = []
    for w in words:
        gone = {j for i in range(len(w) - width + 1) if seen[tuple(w[i:i + width])] > 1 for j in range(i, i + width)}
        out.append((" ".join(x for i, x in enumerate(w) if i not in gone), len(w), len(gone)))
    return out


def some(seed, n=120):
    rng = random.Random(seed)
    word = lambda: rng.choice(["a", "b", "ab", "é", "\x1c", " ", "Word", "字字"]) + rng.choice(["", "x", "yy"])
    passages = [" ".join(word() for _ in range(rng.randint(3, 60))) for _ in range(6)]
    texts = []
    for _ in range(n):
        parts = [" ".join(word() for _ in range(rng.randint(0, 50))) for _ in range(rng.randint(0, 3))]
        if rng.random() < 0.5:
            parts.insert(rng.randint(0, len(parts)), rng.choice(passages))
        texts.append(rng.choice([" ", "\n", " \t\r\n", "\x0b\x0c"]).join(parts))
    return [*texts, None, "", "  ", *texts[:9], passages[0] + " " + passages[0], "same " * 80, "x" * 3000]


@pytest.mark.parametrize("width, chunk_bytes, per_bucket", [(35, 1 << 22, 1 << 22), (5, 2000, 50), (1, 700, 9)])
def test_against_brute_force(spark, width, chunk_bytes, per_bucket):
    texts = some(width)
    df = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "doc_id long, text string, place string").repartition(5)
    found = rows(substring.remove_repeats(df, width, per_bucket, chunk_bytes))
    want = brute(texts, width)
    assert len(found) == len(texts)
    assert {r["doc_id"]: (r["text"], r["n_words"], r["n_removed"]) for r in found} == dict(enumerate(want))
    assert sum(w[2] for w in want) > 500


def test_repeated_and_null_ids(spark):
    texts = ["a b c d e f", "a b c d", "q r s t", None, ""]
    df = spark.createDataFrame([(None if i < 2 else 7, t) for i, t in enumerate(texts)], "doc_id long, text string")
    found = rows(substring.remove_repeats(df, 3))
    want = [(None if i < 2 else 7, *w) for i, w in enumerate(brute(texts, 3))]
    assert sorted(map(repr, ((r["doc_id"], r["text"], r["n_words"], r["n_removed"]) for r in found))) == sorted(map(repr, want))


def test_odd_and_empty_tables(spark):
    df = documents(spark)
    found = {r["doc_id"]: (r["text"], r["n_words"], r["n_removed"]) for r in rows(substring.remove_repeats(df))}
    assert found == {len(ODD_TEXTS) - i: w for i, w in enumerate(brute(ODD_TEXTS, 35))}
    empty = substring.remove_repeats(df.limit(0))
    assert empty.columns == ["doc_id", "text", "n_words", "n_removed"] and rows(empty) == []


def test_hashes_follow_the_words_alone(monkeypatch):
    monkeypatch.setattr(substring, "RUN", 64)  # runs of few words, and words longer than a run
    substring._powers.clear()
    rng = random.Random(4)
    words = [bytes(rng.choices(b"abc\xc3\xa9", k=rng.choice([1, 3, 9, 63, 64, 65, 200]))) for _ in range(30)]
    texts = [b" ".join(rng.choices(words, k=rng.randint(0, 40))) for _ in range(60)]
    found = substring.Chunk(texts, 2)
    whole = [tuple(w[i:i + 2]) for w in (t.split() for t in texts) for i in range(len(w) - 1)]
    by = {}
    for seq, h, d in zip(whole, found.hashes().tolist(), found.digests(np.arange(len(whole))), strict=True):
        assert by.setdefault(seq, (h, d.tobytes())) == (h, d.tobytes())
    assert len({x[0] for x in by.values()}) == len({x[1] for x in by.values()}) == len(by)
    substring._powers.clear()


def test_merged_sketches_never_count_too_low(monkeypatch):
    monkeypatch.setattr(substring, "SEGMENT", 64)
    rng = np.random.default_rng(5)
    parts = [rng.integers(0, 400, 150).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) for _ in range(6)]
    seen = Counter(x for p in parts for x in p.tolist())
    for row in range(2):
        cells = [substring.Cells(p, row, 5) for p in parts]
        asks = [(0, i, row, *ask) for i, c in enumerate(cells) for ask in c.asks()]
        table = pa.Table.from_batches([substring._asked(asks)])
        answers = []
        for s in set(table.column("bucket").to_pylist()):
            answers += substring._merged_sketch(table.filter(pa.compute.equal(table.column("bucket"), s))).to_pylist()
        for i, (c, p) in enumerate(zip(cells, parts, strict=True)):
            maybe = c.answered(substring._bits([x for x in answers if x["chunk"] == i], row))
            assert all(m for m, x in zip(maybe, p.tolist(), strict=True) if seen[x] > 1)


def test_packed_cells():
    rng = np.random.default_rng(1)
    for size in (1, 5, 1000):
        for top in (10, 300, 70_000, 1 << 25, (1 << 32) - 1):
            cells = np.unique(rng.integers(0, top, size)).astype(np.uint32)
            assert (substring.unpacked(substring.packed(cells)) == cells).all()


def test_texts_stay_where_they_are(spark):
    """Answers are shuffled to the chunks, never the chunks to the answers."""
    df = spark.createDataFrame([(i, f"a b c {i % 3}") for i in range(20)], "doc_id long, text string")
    plan = substring.remove_repeats(df, 2)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Bucketed: true") == 1 and "SortMergeJoin" not in plan
    for line in plan.splitlines():
        assert "Exchange" not in line or "texts" not in line
    assert "ShuffledHashJoin" in plan
