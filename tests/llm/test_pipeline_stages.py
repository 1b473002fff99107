"""The pipeline's stages against brute force, each on its own input, and the queries' contract."""

import hashlib
from collections import defaultdict

import corpus_pipeline
from latewatch.llm import decontam, queries
from .conftest import SF
from .support import documents
from .test_bpe import brute as brute_bpe
from .test_bpe import result
from .test_decontam import brute as brute_decontam
from .test_simhash import brute_components, brute_fp


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def follow(spark, docs, sf_dir):
    """Runs all stages; each is held against brute force on what its predecessor kept."""
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    at = docs
    for name, stage in corpus_pipeline.STAGES:
        before = [(r.doc_id, r.text) for r in at.collect()]
        out = stage(spark, at, sf_dir)
        if name == "bpe_codec":
            assert result(out) == brute_bpe(before)
            return out
        assert out.columns == docs.columns
        if name == "language_id":
            want = [d for d, t in before if any(c.isalpha() for c in t or "")]
        elif name == "exact_dedup":
            best = defaultdict(list)
            for d, t in before:
                best[hashlib.sha256((t or "").encode().lower()).digest()].append(d)
            want = [max(g) for g in best.values()]
        elif name == "near_dedup":
            found = brute_components([(d, brute_fp(t)) for d, t in before])
            want = sorted(set(found.values()))
        else:
            want = [d for d, t in before if not brute_decontam(t, bench)[-1]]
        out = corpus_pipeline.written(out, name)
        assert ids(out) == sorted(want), name
        rest = {r.doc_id: r for r in docs.collect()}
        assert all(r == rest[r.doc_id] for r in out.collect())
        at = out


def test_stages_on_the_table_and_run(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    last = follow(spark, docs, SF)
    assert result(corpus_pipeline.run(spark, SF)) == result(last)


def test_stages_on_odd_rows(spark):
    docs = documents(spark)
    follow(spark, docs, SF)
    none = docs.where("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, SF).count() == 0


def test_dropping_stages_tell_rows_with_null_and_repeated_ids_apart(spark):
    base = [f"w{i}" for i in range(300)]
    near = [" ".join(base), " ".join(base[:150] + ["zz"] + base[151:]), " ".join(base[:90] + ["yy"] + base[91:])]
    other = [" ".join(f"{x}{i}" for i in range(60)) for x in ("a", "b", "c", "d", "e")]
    frame = lambda rows: spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = lambda df: sorted(((r.doc_id, r.text) for r in df.collect()), key=str)
    # near copies by null and repeated ids; the others share those ids
    docs = frame([(None, near[0], "x"), (7, near[1], "x"), (7, near[2], "x"), (7, other[0], "x"), (None, other[1], "x"), (9, other[2], "x")])
    got = found(corpus_pipeline.near_dedup(spark, docs, SF))
    assert len(got) == 4 and {(7, other[0]), (None, other[1]), (9, other[2])} < set(got)
    assert [d for d, t in got if t in near] == [7]
    # a group whose ids are all null, and one row that is there three times
    docs = frame([(None, t, "x") for t in near] + [(4, other[3], "x")] * 3 + [(None, other[4], "x")])
    got = found(corpus_pipeline.near_dedup(spark, docs, SF))
    assert sum(t in near for _, t in got) == 1 and got.count((4, other[3])) == 1 and (None, other[4]) in got and len(got) == 3
    bench = frame([(1, other[0], None)]).selectExpr("doc_id as item_id", "text")
    docs = frame([(None, other[0], "x"), (7, other[0], "x"), (7, other[1], "x"), (None, other[2], "x"), (8, other[3], "x"), (8, other[3], "x"), (None, None, "x")])
    want = [(7, other[1]), (None, other[2]), (8, other[3]), (8, other[3]), (None, None)]
    assert found(decontam.clean(docs, bench)) == sorted(want, key=str)


def test_dropping_stages_take_columns_of_any_name(spark):
    """Names that the stages use themselves, in any case; every column comes back as it was."""
    names = ["digest", "Digest_Key", "lost_id", "lost_digest", "folded_digest", "hot_digest", "HOT_ID", "kept", "stays", "group_size", "uid", "fp", "__digest", "__id"]
    texts = ["a b c d e f g", "A b c d e f g", "q r s t u v w x y z", None, ""] + ["hot hot"] * 30
    docs = spark.createDataFrame([(i, t, "en", *[f"{n}{i}" for n in names]) for i, t in enumerate(texts)],
                                 "doc_id long, text string, lang string, " + ", ".join(f"{n} string" for n in names)).repartition(3)
    rest = {r.doc_id: r for r in docs.collect()}
    want = {"exact_dedup": [1, 2, 4, 34], "near_dedup": [0, 2, 3, 5], "decontamination": list(range(35)), "language_id": [i for i in range(35) if i not in (3, 4)]}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and ids(out) == want[name], name
        assert all(r == rest[r.doc_id] for r in out.collect())


def test_exact_dedup_moves_texts_once(spark):
    """Repeated rows, repeated and null ids: one row a text stays, that of the largest id."""
    docs = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (None, "b"), (None, "c"), (None, "C"), (5, None), (5, "")], "doc_id long, text string")
    out = corpus_pipeline.exact_dedup(spark, docs, SF)
    assert sorted(((r.doc_id, (r.text or "").lower()) for r in out.collect()), key=str) == sorted([(1, "a"), (1, "b"), (None, "c"), (5, "")], key=str)


def test_one_query_an_operator():
    numbers = sorted(int(k[2:].split("_")[0]) for k in queries.QUERIES)
    assert numbers == list(range(1, 14)) and set(queries.SQL) <= set(queries.QUERIES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "near_dedup", "decontamination", "bpe_codec"]
