import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from latewatch.llm import tokenfile
from latewatch.llm.chunks import ChunkEncoder, library, vocabulary
from .conftest import SF
from .support import ODD_TEXTS, documents, rows


def brute(docs):
    lib, out, at = library(vocabulary()), {}, 0
    for d, t in sorted(docs):
        ids = lib.encode(t or "", add_special_tokens=False).ids + [0]
        out[d] = (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    return out


@pytest.mark.parametrize("size", [1, 1000, 1 << 20])
def test_round_trip_against_the_library(spark, size):
    docs = documents(spark).repartition(3)
    got = rows(tokenfile.read_documents(tokenfile.write_shards(docs, shard_tokens=size)))
    assert {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in got} == brute([(r.doc_id, r.text) for r in docs.collect()])
    assert len(got) == len(ODD_TEXTS)


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = rows(tokenfile.read_documents(tokenfile.write_shards(docs)))
    assert {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in got} == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_rank_select_access(spark):
    rng = np.random.default_rng(1)
    for n, top in ((1, 1), (700, 3), (5000, 70_000), (513, 1)):
        ids = rng.integers(0, top, n).astype(np.uint32)
        shard = tokenfile.WaveletShard(tokenfile.WaveletShard.build(ids, [7], np.array([n])))
        assert (shard.ids() == ids).all() and shard.doc_ids() == [7]
        for i in rng.integers(0, n, 20).tolist():
            t = int(ids[i])
            assert shard.access(i) == t and shard.rank(t, i) == int((ids[:i] == t).sum())
            assert shard.occurrences(t) == np.flatnonzero(ids == t).tolist()
            assert shard.count(t, 3, i) == int((ids[3:i] == t).sum())
        assert shard.count(99_999_999) == 0
        with pytest.raises(IndexError):
            shard.select(int(ids[0]), n)


def test_find_token_empty_and_null_ids(spark):
    shards = tokenfile.write_shards(documents(spark, ["a b a", None, "b"]))
    ids = library(vocabulary()).encode("a b").ids
    assert sorted((r.doc_id, r.place) for r in tokenfile.find_token(shards, ids[1]).collect()) == [(3, 1)]
    assert tokenfile.read_documents(tokenfile.write_shards(documents(spark).where("false"))).count() == 0
    nulls = spark.createDataFrame([(None, "x"), (1, "y"), (1, "x")], "doc_id long, text string")
    assert sorted((r["start"], r["doc_id"]) for r in rows(tokenfile.read_documents(tokenfile.write_shards(nulls)))) == [(0, None), (2, 1), (4, 1)]


def test_words_are_remembered_between_columns():
    """450,000 distinct words come twice; the second time none is new."""
    asked = []

    def encode(pieces):
        asked.append(len(pieces))
        return [len(p).to_bytes(4, "little") for p in pieces]

    encoder = ChunkEncoder(encode, lambda text: b"", [])
    columns = [pa.array([" ".join(f"w{chr(97 + k % 26)}{chr(97 + k // 26 % 26)}{chr(97 + k // 676 % 26)}{'é' * (k // 17576)}" for k in range(a, a + 150_000))]) for a in (0, 150_000, 300_000)]
    first = [encoder(c)[0].tolist() for c in columns]
    assert sum(asked) == 450_000 and first[0][:2] == [4, 5]
    assert [encoder(c)[0].tolist() for c in columns] == first and sum(asked) == 450_000


def test_columns_of_odd_white_space_against_the_library():
    rng, lib = random.Random(5), library(vocabulary())
    parts = ["a", "word", "don't", " ", "  ", "\n", "\t", "　", " ", "x\ny", "漢字", "é", "12", "...", "<|endoftext|>", "ünï", "🙂"]
    texts = [rng.choice(["", " "]).join(rng.choices(parts, k=rng.randint(0, 9))) for _ in range(3000)] + [None, ""]
    want = [lib.encode(t or "", add_special_tokens=False).ids for t in texts]
    for n in (1, 7, 1000, len(texts)):
        for a in range(0, len(texts) if n > 1 else 200, n):
            ids, at = tokenfile.encoder(vocabulary())(pa.array(texts[a:a + n], pa.string()))
            assert [ids[x:y].tolist() for x, y in zip(at, at[1:])] == want[a:a + n]
    ids, at = tokenfile.encoder(vocabulary())(pa.array([], pa.string()))
    assert ids.tolist() == [] and at.tolist() == [0]
