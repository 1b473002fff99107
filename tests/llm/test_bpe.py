import hashlib
import random

import pytest

from latewatch.llm import bpe
from latewatch.llm.chunks import ChunkEncoder, library, vocabulary
from .conftest import SF
from .support import ODD_TEXTS, documents, rows


def brute(texts):
    lib, out = library(vocabulary()), {}
    for d, t in texts:
        ids = lib.encode(t or "", add_special_tokens=False).ids
        back = lib.decode(ids, skip_special_tokens=False)
        out[d] = (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(back.encode()).hexdigest())
    return out


def result(df):
    return {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in rows(df)}


def test_odd_texts_against_the_library(spark):
    docs = documents(spark).repartition(3)
    assert result(bpe.code(docs)) == brute([(r.doc_id, r.text) for r in docs.collect()])
    assert bpe.code(docs).columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert bpe.code(docs.where("false")).count() == 0


def test_whole_table_against_the_library(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert result(bpe.code(docs)) == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_round_trip(spark):
    got = {r["doc_id"]: r["decoded"] for r in rows(bpe.code(documents(spark), texts=True))}
    assert got == {len(ODD_TEXTS) - i: t or "" for i, t in enumerate(ODD_TEXTS)}


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(vocabulary())


def test_random_words_of_one_trie(codec):
    rng, lib = random.Random(2), library(vocabulary())
    letters = "aaabbcdeeeinorst  éß漢🙂'.,!0129\n\t=-"
    words = list({"".join(rng.choices(letters, k=rng.randint(1, 14))) for _ in range(4000)} | {"=" * n for n in range(1, 200)} | {"ab" * n for n in range(1, 40)})
    pieces = list({p for w in words for p in codec.encode.find(w)})
    trie = bpe.TrieEncoder(codec.v)
    want = [lib.encode(p, add_special_tokens=False).ids for p in pieces]
    got = [list(memoryview(x).cast("I")) for x in trie(pieces)]
    assert got == want


def test_every_token_is_its_own_encoding_or_as_the_library_says(codec):
    lib, rng = library(vocabulary()), random.Random(4)
    tokens = [t for t in rng.sample(sorted(codec.v.ids), 1500)]
    texts = [t.decode() for t in tokens if t.decode(errors="ignore").encode() == t and len(codec.encode.find(t.decode())) == 1]
    got = bpe.TrieEncoder(codec.v)(texts)
    assert [list(memoryview(x).cast("I")) for x in got] == [lib.encode(t, add_special_tokens=False).ids for t in texts]


def test_decoding_broken_bytes(codec):
    lib = library(vocabulary())
    for ids in ([0xE9 % 256], [codec.v.ids[b"\xc3"], codec.v.ids[b"a"]], [codec.v.ids[b"\xf0"], codec.v.ids[b"\x9f"], 50256], []):
        assert codec.decode(ids).decode() == lib.decode(ids, skip_special_tokens=False)


def test_small_memory_gives_the_same(codec, monkeypatch):
    import pyarrow as pa
    texts = pa.array([t for t in ODD_TEXTS if t])
    want = codec.encode(texts)[0].tolist()
    monkeypatch.setattr(bpe, "PAIRS", 2)
    monkeypatch.setattr(bpe, "RUN", 3)
    small = ChunkEncoder(bpe.TrieEncoder(codec.v), codec._whole, list(codec.v.special), 3, 2)
    assert small(texts)[0].tolist() == want and small(texts)[0].tolist() == want
