import hashlib
from collections import Counter, defaultdict

from latewatch.llm import exactdedup
from .support import documents, rows


def brute(docs):
    groups = defaultdict(list)
    for d, t in docs:
        groups[bytes((t or "").encode()).lower()].append(d)
    return {d: (max(g), len(g), hashlib.sha256(t).hexdigest()) for t, g in groups.items() for d in g}


def test_judge_against_brute_force_on_odd_rows(spark):
    texts = [None, "", "Same", "SAME", "same", "É", "é", "x" * 100_000] + ["hot Text"] * 400 + [f"t{i % 50}" for i in range(100)]
    docs = documents(spark, texts).repartition(7)
    want = brute([(r.doc_id, r.text) for r in docs.collect()])
    for k in (1, 8, 512):
        got = rows(exactdedup.judge(docs, k))
        assert len(got) == len(texts)
        assert {r["doc_id"]: (r["keep_id"], r["group_size"], r["text_sha256"]) for r in got} == want
        assert all(r["kept"] == (r["doc_id"] == r["keep_id"]) for r in got)


def test_misra_gries_names_every_frequent_digest(spark):
    texts = ["a"] * 300 + ["b"] * 200 + [f"r{i}" for i in range(500)]
    table = exactdedup.digests(documents(spark, texts).repartition(5))
    found = {bytes(r.digest): r.group_size for r in exactdedup.frequent(table, 9).collect()}
    counts = Counter(hashlib.sha256(t.encode()).digest() for t in texts)
    assert {d for d, n in counts.items() if n > 2 * len(texts) / 10} <= set(found) and len(found) <= 10
    assert all(counts[d] == n for d, n in found.items())


def test_repeated_rows_null_ids_and_columns(spark):
    docs = documents(spark, ["a", "a", "b"])
    twice = docs.unionByName(docs)
    judged = rows(exactdedup.judge(twice))
    assert sum(r["kept"] for r in judged) == 2 and len(judged) == 6
    kept = exactdedup.deduplicate(twice)
    assert kept.columns == docs.columns and sorted(r.text for r in kept.collect()) == ["a", "b"]
    nulls = spark.createDataFrame([(None, "a"), (None, "a"), (4, "A"), (None, "z")], "doc_id long, text string")
    assert sorted((r["keep_id"] is None, r["kept"]) for r in rows(exactdedup.judge(nulls))) == [(False, False), (False, False), (False, True), (True, True)]
    assert exactdedup.deduplicate(nulls).count() == 2


def test_empty_table(spark):
    none = documents(spark).where("false")
    assert exactdedup.judge(none).count() == 0 and exactdedup.deduplicate(none).count() == 0


def test_lost_rows_are_merged_at_every_size(spark):
    """A table that grows with the corpus is not broadcast while it is small: shuffles then grow as the texts do."""
    from pyspark.sql import functions as F

    from latewatch.llm.common import digest, without
    docs = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (None, "c"), (3, "d")], "doc_id long, text string")
    lost = docs.where("text in ('a', 'b')").select("doc_id", digest().alias("digest"), (F.col("text") == "a").alias("stays")).distinct()
    out = without(docs, lost)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    assert sorted((str(r.doc_id), r.text) for r in out.collect()) == [("1", "a"), ("3", "d"), ("None", "c")]
