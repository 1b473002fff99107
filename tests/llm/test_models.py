"""Language, toxicity and quality: held-out accuracy, brute force on the exact parts, odd rows."""

import zlib
from collections import Counter

import numpy as np
import pytest

from pyspark.sql import functions as F

from latewatch.llm import langid, quality, toxicity
from .support import ODD_TEXTS, documents, rows

DATA = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet"), spark.read.parquet(f"{DATA}/labels.parquet")


def in_split(d, parts, part):
    return zlib.crc32(str(d).encode()) % parts == part


# --- language ---

def test_held_out_accuracy(tables):
    truth = {r.doc_id: r.lang for r in tables[0].select("doc_id", "lang").collect()}
    got = rows(langid.identify(tables[0]))
    assert len(got) == len(truth) and all(r["held_out"] == in_split(r["doc_id"], 4, 2) for r in got)
    held = [r for r in got if r["held_out"]]
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in held]) > 0.98
    assert all(0 <= r["score"] <= 1 for r in got)


def test_trigrams_and_counts_against_brute_force(spark):
    texts = ["Ab c", "", "é-a1b", "  x "]
    codes, first, n = langid.trigrams([t.encode() for t in texts])
    want = []
    for t in texts:
        for w in "".join(c.lower() if c.isascii() and c.isalpha() else c if not c.isascii() else " " for c in t).split():
            b = b"  " + w.encode() + b" "
            want += [(b[i] << 16 | b[i + 1] << 8 | b[i + 2]) for i in range(len(b) - 2)]
    assert codes.tolist() == want and n.tolist() == [2, 0, 3, 1] and len(first) == 6
    docs = spark.createDataFrame([(t, "aa") for t in texts] + [("Ab", "bb"), ("x", None), (None, "aa")], "text string, lang string")
    got = {(r["lang"], r["code"]): r["n"] for r in rows(langid.counts(docs))}
    assert sum(v for (k, _), v in got.items() if k == "aa") == len(want) and sum(v for (k, _), v in got.items() if k == "bb") == 3


def test_model_against_brute_force(spark):
    words = {"aa": "ab abc ba", "bb": "ab xyz", "cc": "zz"}
    model = langid.fit(spark.createDataFrame([(t, x) for x, t in words.items()] + [("abc", "aa"), ("12", "dd"), (None, "ee")], "text string, lang string"))
    seen = {}
    for x, t in [*words.items(), ("aa", "abc")]:
        for c in langid.trigrams([t.encode()])[0].tolist():
            seen.setdefault(x, Counter())[c] += 1
    assert model.langs == sorted(seen)
    share = lambda x, c: seen[x][c] / seen[x].total()
    codes = sorted({c for n in seen.values() for c in n})
    for c in codes:
        same = [d for d in codes if d >> 8 == c >> 8]
        shared = (sum(share(x, c) for x in seen) + 1e-9) / (sum(share(x, d) for x in seen for d in same) + 256e-9)
        for x, row in zip(model.langs, model.table, strict=True):
            want = np.log((seen[x][c] + langid.SHARED * shared) / (sum(seen[x][d] for d in same) + langid.SHARED))
            assert abs(row[langid.cell(np.array([c]))[0]] - want) < 1e-5
    assert (model.table == np.float32(-np.log(256.0))).sum() == model.table.size - len(codes) * len(seen)


def test_every_trigram_keeps_its_own_probabilities(spark):
    """Trigrams that a hash to 2^18 cells would merge: a frequent one of letters, a rare one of another script."""
    hashed = lambda c: (c * 2654435769 & 0xFFFFFFFF) >> 14
    letters = {hashed(c): c for x in range(97, 123) for y in range(97, 123) for z in range(97, 123) if (c := x << 16 | y << 8 | z)}
    word, other = next((chr(x), c) for x in range(0x400, 0xD800) for c in langid.trigrams([chr(x).encode()])[0].tolist() if hashed(c) in letters)
    mine = letters[hashed(other)]
    text = mine.to_bytes(3, "big").decode()
    model = langid.fit(spark.createDataFrame([(f"{text} " * 50, "aa"), (word, "bb")], "text string, lang string"))
    both = langid.cell(np.array([mine, other]))
    assert both[0] != both[1]
    a, b = (dict(zip(model.langs, model.table[:, at])) for at in both)
    assert a["aa"] > a["bb"] and b["bb"] > b["aa"]
    assert langid.predict(model, [text.encode(), word.encode()])[0] == ["aa", "bb"]
    every = np.array([x << 16 | y << 8 | z for x in langid.BYTES for y in langid.BYTES for z in langid.BYTES])
    assert len(np.unique(langid.cell(every))) == len(every) == langid.CELLS


def test_mixture_proportions_and_language_set(tables):
    model = langid.fit(tables[0].where(~langid.held_out()))
    own = {}
    for r in tables[0].where(langid.held_out()).collect():
        own.setdefault(r.lang, []).append(" ".join(w for w in r.text.split() if w.isalpha()))
    en, de = (" ".join(own[x]).split() for x in ("en", "de"))
    mixed = " ".join(en[:300] + de[:100])
    found, score, share = langid.predict(model, [mixed.encode(), " ".join(en[:300]).encode(), " ".join(de[:60]).encode()], detail=True)
    assert found == ["en", "en", "de"]
    share = dict(zip(model.langs, share[0]))
    assert abs(share["en"] - 0.75) < 0.1 and abs(share["de"] - 0.25) < 0.1 and share["es"] == share["fr"] == 0
    assert score[1] > 0.95


def test_em_against_a_plain_loop():
    rng = np.random.default_rng(0)
    logs, n = rng.normal(size=(3, 12)).astype(np.float32), np.array([5, 7])
    theta, total = langid._em(logs, n, np.full((3, 2), 1 / 3), 4)
    for t, part in enumerate((slice(0, 5), slice(5, 12))):
        p, w = np.exp(logs[:, part].astype(float)), np.full(3, 1 / 3)
        for _ in range(4):
            r = p * w[:, None]
            w = (r / r.sum(0)).mean(1)
        assert np.allclose(theta[:, t], w, atol=1e-4) and abs(total[t] - np.log((p * w[:, None]).sum(0)).sum()) < 1e-3


def test_a_table_without_languages_keeps_what_has_a_letter(spark):
    docs = spark.createDataFrame([(i, t, None) for i, t in enumerate(["abc", "é1", "12 !", "", None])], "doc_id long, text string, lang string")
    assert sorted(r.doc_id for r in langid.keep_identified(docs).collect()) == [0, 1]


def test_only_letters_make_a_language(spark, tables):
    found, score, _ = langid.predict(langid.fit(tables[0]), [t.encode() for t in ("½", "²³", "①②", "Ⅷ", "_", "٣", "ª", "字")])
    assert [x == "und" for x in found] == [True] * 6 + [False] * 2 and score[:6] == [0] * 6


def test_documents_in_unwanted_languages_go(spark, tables):
    """The share of the wanted languages decides, against the mixture itself."""
    rows_ = tables[0].where("lang in ('en', 'de')").select("text", "lang").limit(60).collect()
    text = {x: " ".join(r.text for r in rows_ if r.lang == x and r.text).split() for x in ("en", "de")}
    mixed = [" ".join(text["en"][:n] + text["de"][:200 - n]) for n in (200, 150, 50, 0)]
    given = spark.createDataFrame([(i, t, None) for i, t in enumerate([*mixed, "12", None])], "doc_id long, text string, lang string")
    docs = given.unionByName(tables[0].select("doc_id", "text", "lang").withColumn("doc_id", F.col("doc_id") + 1000))
    model = langid.fit(docs.where(~langid.held_out()))
    share = [sum(s for x, s in zip(model.langs, m, strict=True) if x == "en") for m in langid.predict(model, [t.encode() for t in mixed], True)[2]]
    for least in (0.1, 0.5, 0.9):
        kept = {r.doc_id for r in langid.keep_identified(docs, ["en"], least).where("doc_id < 1000").collect()}
        assert kept == {i for i, s in enumerate(share) if s >= least}
    assert {r.doc_id for r in langid.keep_identified(docs).where("doc_id < 1000").collect()} == {0, 1, 2, 3}
    assert share[0] > 0.9 and share[3] < 0.1


def test_language_of_odd_rows(spark, tables):
    model = langid.fit(tables[0])
    docs = documents(spark, [*ODD_TEXTS, "123 !!", "ª"])
    got = {r["doc_id"]: r for r in rows(langid.identify(docs, model))}
    assert {r.doc_id for r in docs.collect()} == set(got)
    und = {d for d, r in got.items() if r["lang_pred"] == "und"}
    assert und == {r.doc_id for r in docs.collect() if not any(c.isalpha() for c in r.text or "")}
    assert all(r["score"] == 0 for d, r in got.items() if d in und)
    kept = langid.keep_identified(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == set(got) - und
    assert langid.identify(docs.where("false")).count() == 0
    none = docs.withColumn("lang", docs["source"])
    assert {r["lang_pred"] for r in rows(langid.identify(none))} == {"und"}
    alone = spark.createDataFrame([(1, "abc", "xx"), (2, "", "xx"), (None, "abd", "xx"), (3, "abe", "xx")], "doc_id long, text string, lang string")
    assert sorted(r["lang_pred"] for r in rows(langid.identify(alone))) == ["und", "xx", "xx", "xx"]


# --- toxicity ---

WORDS = "trash pathetic idiot worthless disgusting stupid clown scum loser moron".split()


def test_toxic_documents_are_caught_and_clean_ones_left(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    words = {r.doc_id: set((r.text or "").lower().replace(".", " ").replace(",", " ").split()) for r in docs.collect()}
    got = rows(toxicity.score(docs, labels))
    assert len(got) == len(words) and all(r["held_out"] == in_split(r["doc_id"], 4, 2) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got)
    held = [r for r in got if r["held_out"]]
    assert np.mean([r["predicted"] for r in held if words[r["doc_id"]] & set(WORDS)]) > 0.9
    assert np.mean([r["predicted"] for r in held if not words[r["doc_id"]] & set(WORDS)]) < 0.02


def test_pair_counts_against_brute_force(spark):
    data = [("a b a b", 1), ("a b c", 0), ("", 0), ("x", 1), (None, 0), ("A,b", 0)]
    got = {(r["toxic"], r["first"], r["second"]): r["n"] for r in rows(toxicity.pair_counts(spark.createDataFrame(data, "text string, toxic int")))}
    cell = lambda w: toxicity.cells([w.encode()])[0][0]
    a, b, c = map(cell, "abc")
    assert got == {(1, a, b): 2, (1, b, a): 1, (0, a, b): 2, (0, b, c): 1}


def test_toxic_words_of_the_curves_fifth_are_counted(spark, monkeypatch):
    rng = np.random.default_rng(2)
    own = {r.id for r in spark.range(3000).where("pmod(xxhash64(id), 5) = 0").collect()}
    held = {i for i in range(3000) if in_split(i, 4, 2)}
    texts, toxic = {}, {}
    for i in range(3000):
        rare = (i in own or i in held) and rng.random() < 0.5
        toxic[i] = int(rng.random() < 0.2)
        texts[i] = " ".join(rng.choice([f"w{k}" for k in range(50)], 12)) + (" zork blat" if rare else " foo bar") * toxic[i]
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    labels = spark.createDataFrame(list(toxic.items()), "doc_id long, toxic int")
    for limit in (20_000, 300):  # fewer than the fifth has, too
        monkeypatch.setattr(toxicity, "CURVE_ROWS", limit)
        got = {r["doc_id"]: r["predicted"] for r in rows(toxicity.score(docs, labels))}
        assert np.mean([got[i] for i in held if "zork" in texts[i]]) > 0.9 and np.mean([got[i] for i in held if not toxic[i]]) < 0.05
        split = rows(toxicity.split(docs))
        assert {r["doc_id"] for r in split if r["curve"]} <= own and min(limit, len(own)) - 1 <= sum(r["curve"] for r in split) <= limit


def test_evidence_against_brute_force_over_many_pairs(spark, monkeypatch):
    """Every counted pair and word has a row of its own, and the evidence follows from exact counts."""
    rng = np.random.default_rng(4)
    data = [(" ".join(rng.choice([f"v{k}" for k in range(40)], 30)), int(i % 3 == 0)) for i in range(60)]
    p, before, types, after = Counter(), Counter(), Counter(), Counter()
    for t, c in data:
        w = t.split()
        p.update((c, a, b) for a, b in zip(w, w[1:]))
    for (c, a, b), n in p.items():
        before[c, a] += n
        types[c, a] += 1
        after[c, b] += 1
    total = [sum(n for (x, _), n in after.items() if x == c) for c in (0, 1)]
    size = len({w for _, w in before} | {w for _, w in after})

    def tells(a, b):
        shared = after[0, b] + after[1, b]
        departs = [(after[c, b] + toxicity.SHARED) / (shared * total[c] / sum(total) + toxicity.SHARED) for c in (0, 1)]
        if a is None:
            return np.log(departs[1] / departs[0])
        n, kinds, single = before[0, a] + before[1, a], types[0, a] + types[1, a], (shared + 1) / (sum(total) + size)
        both = (max(p[0, a, b] + p[1, a, b] - 0.75, 0) + 0.75 * kinds * single) / n if n else single
        like = [(max(p[c, a, b] - 0.75, 0) + (min(0.75 * types[c, a], before[c, a]) + toxicity.SHARED_PAIRS) * both * departs[c]) / (before[c, a] + toxicity.SHARED_PAIRS) for c in (0, 1)]
        return np.log(like[1] / like[0])

    counts = toxicity.pair_counts(spark.createDataFrame(data, "text string, toxic int"))
    table = toxicity.weights(counts)
    assert table.where("second <> 0").count() == len({k[1:] for k in p}) and table.where("second = 0").count() == size
    texts = [*(t for t, _ in data[:20]), "new v1 v2 new", "v3", "", None]
    monkeypatch.setattr(toxicity, "CHUNK", 500)
    got = {r["doc_id"]: (r["whole"], r["passage"]) for r in rows(toxicity.evidence(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), table))}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        w = (t or "").split()
        d = [tells(a, b) for a, b in zip([None, *w], w)]
        want = (np.mean(d), max(np.mean(d[max(0, k - 1):k + 1]) for k in range(min(1, len(d) - 1), len(d)))) if d else (0, 0)
        assert np.allclose(got[i], want, atol=1e-6), (i, got[i], want)


def test_counts_that_come_back_tell_what_the_table_tells(spark, monkeypatch):
    """Packs, buckets and rounds give the evidence of the written table, and the curve that of the rows it is fitted on."""
    rng = np.random.default_rng(5)
    words = [f"v{k}" for k in range(300)]
    data = [(i % 380 if i % 50 else None, " ".join(rng.choice(words, rng.integers(0, 30), p=np.arange(300, 0, -1) / 45150)) if i % 21 else None) for i in range(400)]
    docs = spark.createDataFrame(data, "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(300)] + [(7, 1), (8, None), (None, 1)], "doc_id long, toxic int")
    monkeypatch.setattr(toxicity, "PACK", 2000)
    monkeypatch.setattr(toxicity, "PER_BUCKET", 500)
    found, curve = toxicity.learnt(docs, labels)
    train = toxicity.split(toxicity.labelled(docs.where(~langid.held_out()), labels, "toxic"))
    table, without = (toxicity.weights(toxicity.pair_counts(x)) for x in (train, train.where("not curve")))
    near = lambda df: sorted((-1 if r["doc_id"] is None else r["doc_id"], round(r["whole"], 9), round(r["passage"], 9)) for r in rows(df))
    assert np.allclose(near(found), near(toxicity.evidence(docs, table)), atol=1e-8)
    seen = toxicity.evidence(train.where("curve").select("text", "toxic"), without).toPandas()
    own = toxicity.Curve(seen[["whole", "passage"]].to_numpy(), seen["toxic"].to_numpy(float))
    assert own.ready and np.allclose(own.w, curve.w) and np.allclose(own.mean, curve.mean)


def test_toxicity_writes_neither_texts_nor_a_row_a_pair(spark, tmp_path, monkeypatch):
    """What scoring keeps on disk is a small part of what a row a pair took."""
    rng = np.random.default_rng(6)
    data = [(i, " ".join(f"w{k}" for k in rng.zipf(1.3, 200) % 20_000)) for i in range(1500)]
    docs, labels = spark.createDataFrame(data, "doc_id long, text string"), spark.createDataFrame([(i, i % 2) for i in range(1500)], "doc_id long, toxic int")
    monkeypatch.setattr("latewatch.llm.common.scratch_path", lambda _, name: f"{tmp_path}/{name}-{rng.integers(1 << 60)}")
    assert toxicity.score(docs.coalesce(2), labels).count() == 1500
    pairs = sum(len(t.split()) - 1 for _, t in data)
    assert sum(f.stat().st_size for f in tmp_path.rglob("*.parquet")) < 6 * pairs


def test_toxicity_of_odd_rows(spark, tables):
    docs = documents(spark)
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, None), (None, 1), (99, 1), (1, 0)], "doc_id long, toxic int")
    for own in (labels, labels.where("false")):
        got = rows(toxicity.score(docs, own))
        assert len(got) == docs.count() and all(0 <= r["score"] <= 1 for r in got)
    assert toxicity.score(docs.where("false"), labels).count() == 0
    more = tables[0].select("doc_id", "text").unionByName(docs.selectExpr("-doc_id as doc_id", "text"))
    assert sum(r["doc_id"] < 0 for r in rows(toxicity.score(more, tables[1]))) == docs.count()


# --- quality ---

def test_quality_held_out(tables):
    truth = {r.doc_id: r.quality for r in tables[1].collect()}
    got = rows(quality.score(*tables))
    assert all(r["held_out"] == in_split(r["doc_id"], 5, 0) for r in got) and len(got) == tables[0].count()
    held = [r for r in got if r["held_out"] and r["doc_id"] in truth]
    low = np.array([r["score"] for r in held if not truth[r["doc_id"]]])
    high = np.array([r["score"] for r in held if truth[r["doc_id"]]])
    assert (low[:, None] < high[None, :]).mean() > 0.95


def test_votes_with_ties_against_brute_force():
    rng = np.random.default_rng(1)
    near = np.round(rng.normal(0, 0.5, (50, 300)), 1)  # many equal similarities
    labels = (rng.random(300) < 0.5).astype(float)
    got, some = quality.votes(near.astype(np.float32), labels)
    for row, score in zip(near, got):
        best = sorted(range(300), key=lambda i: (-row[i], i))[:quality.NEIGHBOURS]
        weight = [max(row[i], 0) ** 4 for i in best]
        assert abs(score - sum(w for w, i in zip(weight, best) if labels[i]) / sum(weight)) < 1e-6
    assert some.all() and not quality.votes(np.zeros((1, 3), np.float32), labels[:3])[1].any()
    near = np.repeat([0.9, 0.5, 0.5], [20, 30, 30])[None].astype(np.float32)  # 20 others, then 30 of label 1 and 30 of label 0
    assert abs(quality.votes(near, np.repeat([0.0, 1.0, 0.0], [20, 30, 30]))[0][0] - 11 * 0.5 ** 4 / (20 * 0.9 ** 4 + 11 * 0.5 ** 4)) < 1e-6


def test_quality_scores_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(quality, "BLOCK", 7)
    monkeypatch.setattr(quality, "STEP", 50)
    rng = np.random.default_rng(2)
    words = ["alpha", "Beta", "GAMMA!!", "delta.", "x1", "aa", "été", *[f"once{i}" for i in range(40)]]
    texts = {i: " ".join(rng.choice(words[:7] + [words[7 + i % 40]], 30, p=[.3, .2, .1, .1, .1, .1, .05, .05] if i % 2 else [.1, .1, .3, .1, .1, .2, .05, .05])) for i in range(80)}
    texts |= {100 + i: texts[i] for i in range(5)} | {200: "", 201: "unknownword"}
    labels = {i: i % 2 for i in range(75)} | {100: 1, 101: 1}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r for r in rows(quality.score(docs, spark.createDataFrame(list(labels.items()), "doc_id long, quality int")))}
    assert set(got) == set(texts)
    # the same from dense matrices in double precision
    order = dict(docs.select("doc_id", F.xxhash64("doc_id")).collect())
    sample = sorted((i for i in labels if not in_split(i, 5, 0)), key=order.get)
    shape = lambda w: quality._RUN.sub(rb"\1", w.encode().translate(quality.SHAPE))

    def terms(text):
        ws = text.split()
        return Counter([("w", w.encode().lower()) for w in ws] + [("s", shape(w)) for w in ws] + [("r",)] * sum(a == b for a, b in zip(ws, ws[1:])) + [("n",)] * len(ws))

    seen = Counter(t for i in sample for t in terms(texts[i]))
    in_texts = Counter(t for i in sample for t in set(terms(texts[i])))
    cols = sorted({t for t in seen if in_texts[t] > 1} | {("r",), ("n",)})
    tf = {i: np.log1p([terms(t)[c] for c in cols]) for i, t in texts.items()}
    idf = np.array([np.log((1 + len(texts)) / (1 + sum(terms(t)[c] > 0 for t in texts.values()))) + 1 for c in cols])
    unit = lambda x: x / max(np.linalg.norm(x), 1e-12)
    right = np.linalg.svd(np.array([unit(tf[i] * idf) for i in sample]), full_matrices=False)[2][:quality.RANK]
    vectors = [unit(right @ (tf[i] * idf)) for i in sample]
    for i, text in texts.items():
        mine = unit(right @ (tf[i] * idf))
        near = [round(float(mine @ v) / quality.GRID) * quality.GRID for v in vectors]
        best = sorted(range(len(sample)), key=lambda j: (-near[j], j))[:quality.NEIGHBOURS]
        weight = [max(near[j], 0) ** 4 for j in best]
        want = sum(w for w, j in zip(weight, best) if labels[sample[j]]) / sum(weight) if sum(weight) else np.mean([labels[j] for j in sample])
        assert abs(got[i]["score"] - want) < 1e-5 and got[i]["held_out"] == in_split(i, 5, 0), (i, got[i], want)
    assert got[200]["score"] == np.mean([labels[j] for j in sample])


def test_quality_of_odd_rows(spark):
    docs = documents(spark)
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, None), (None, 1), (99, 1), (4, 0), (4, 1), (5, 0)], "doc_id long, quality int")
    for own in (labels, labels.where("false")):
        got = rows(quality.score(docs, own))
        assert len(got) == docs.count() and all(0 <= r["score"] <= 1 for r in got)
    assert quality.score(docs.where("false"), labels).count() == 0
