import hashlib
import re

import pyarrow.parquet as pq
import pytest

from latewatch.llm import decontam
from .support import documents, rows

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def split(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(text, items, window=13):
    w = split(text)
    hit, found = set(), set()
    for item, t in items:
        b = split(t)
        wins = {tuple(b[i:i + window]) for i in range(max(1, len(b) - window + 1))} if b and item is not None else set()
        for i in range(len(w)):
            for n in {len(x) for x in wins}:
                if tuple(w[i:i + n]) in wins:
                    hit.update(range(i, i + n))
                    found.add(str(item))
    return len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), len(hit) > 0 and 20 * len(hit) >= len(w)


PASSAGE = " ".join(f"w{i}" for i in range(30))
ITEMS = [(1, PASSAGE), (2, "short Item"), (10, " ".join(["the"] * 40)), (3, None), (4, "..."), (None, "alpha beta"), (2, "short item"), (11, " ".join(f"w{i}" for i in range(10, 25))), (12, "é漢字 ünï")]
TEXTS = [None, "", "!!", "a short item, SHORT ITEM", PASSAGE, PASSAGE.upper() + " tail", "x " + " ".join(f"w{i}" for i in range(5, 18)) + " y" * 300, "the " * 39, "the " * 12, "the " * 13 + PASSAGE[:40],
         " ".join(f"w{i}" for i in range(12)), "short", "item short item", "alpha beta", "É漢字 ünï é漢字 ünï", "q " * 3000 + PASSAGE]


@pytest.mark.parametrize("options", [{}, {"limit": 1}, {"shard_words": 5}, {"shard_words": 50, "limit": 200}])
def test_judge_against_brute_force(spark, options):
    docs = documents(spark, TEXTS).repartition(4)
    items = spark.createDataFrame([(i, t, "x") for i, t in ITEMS], "item_id long, text string, doc_id string")
    got = {r["doc_id"]: tuple(r[c] for c in ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")) for r in rows(decontam.judge(docs, items, **options))}
    assert got == {r.doc_id: brute(r.text, ITEMS) for r in docs.collect()}


def test_hot_words_in_runs(spark, monkeypatch):
    shard = decontam.Shard.build([1, 2], [__import__("numpy").zeros(400, "uint32"), __import__("numpy").zeros(20, "uint32")], [b"the"])
    monkeypatch.setattr(decontam, "RUN", 7)
    w, start = decontam.search(shard, decontam.TestBlock([(1, b"the " * 50), (2, b"the")]))
    assert len(start) == (400 - 12) + (20 - 12) + 420


def test_proximity(spark):
    docs = documents(spark, ["red x green y blue", "red " + "x " * 30 + "green blue", "blue green red", "red green"])
    items = spark.createDataFrame([(5, "red green blue")], "item_id long, text string")
    assert sorted(r["doc_id"] for r in rows(decontam.near(docs, items, 4))) == [2, 4]
    assert decontam.near(docs, items.where("false"), 4).count() == 0


def test_clean_and_empty(spark):
    docs, items = documents(spark, TEXTS), spark.createDataFrame([(i, t) for i, t in ITEMS], "item_id long, text string")
    kept = decontam.clean(docs, items)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in docs.collect() if not brute(r.text, ITEMS)[-1]}
    assert decontam.judge(docs.where("false"), items).count() == 0
    assert not any(r["contaminated"] or r["n_items"] for r in rows(decontam.judge(docs, items.where("false"))))


def python_steps(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow")


def test_one_python_worker_a_task(spark):
    docs, items = documents(spark, TEXTS), spark.createDataFrame([(i, t) for i, t in ITEMS], "item_id long, text string")
    assert python_steps(decontam.judge(docs, items)) == 1
    assert python_steps(decontam.judge(docs, items.where("false"))) == 1
    assert python_steps(decontam.clean(docs, items)) == 0  # the search is over before texts are shuffled


def test_index_in_small_row_groups(spark, monkeypatch):
    monkeypatch.setattr(decontam, "INDEX_BLOCK", 1 << 10)
    before = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
    index = decontam.build_index(documents(spark, [" ".join(f"a{n}x{i}" for i in range(1000)) for n in range(6)]).coalesce(1), shard_words=1000)
    groups = [g for f in index.inputFiles() for g in [pq.ParquetFile(f.removeprefix("file://")).metadata] if g.num_rows]
    assert sum(g.num_rows for g in groups) == 6 and all(g.num_row_groups == g.num_rows for g in groups)
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == before
