import numpy as np
import pytest
import xxhash

from latewatch.llm import simhash
from .conftest import SF
from .support import documents, rows


def brute_fp(text, k=4):
    w = [x for x in (text or "").encode().lower().replace(b"\x0b", b" ").split()]
    if not w:
        return 0
    hs = [xxhash.xxh64_intdigest(b" ".join(w[i:i + k]), 42) for i in range(max(1, len(w) - k + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(fps, distance=4):
    """fps: [(doc_id, fp)] -> {doc_id: smallest reachable}"""
    f = np.array(sorted({x for _, x in fps}), np.uint64)
    root = np.arange(len(f))
    while True:
        low = np.array([root[np.bitwise_count(f ^ x) <= distance].min() for x in f])
        if (low == root).all():
            break
        root = low
    of = dict(zip(f.tolist(), root.tolist()))
    first = {}
    for d, x in fps:
        first[of[x]] = min(d, first.get(of[x], d))
    return {d: first[of[x]] for d, x in fps}


def check(docs, got):
    fps = [(r.doc_id, brute_fp(r.text)) for r in docs.collect()]
    want = brute_components(fps)
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in got} == {d: (f"{x:016x}", want[d]) for d, x in fps}
    assert len(got) == len(fps)


def test_odd_rows_and_whole_table(spark):
    base = [f"w{i}" for i in range(300)]
    near = [" ".join(base[:i] + ["zz"] + base[i + 1:]) for i in range(0, 300, 7)]
    from .support import ODD_TEXTS
    docs = documents(spark, ODD_TEXTS + near + [None, "", "WORD", "a b", "A  b", "a b c d e"]).repartition(5)
    check(docs, rows(simhash.judge(docs)))
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    check(docs, rows(simhash.judge(docs)))
    assert simhash.judge(docs.where("false")).count() == 0


@pytest.mark.parametrize("blocks,slice_rows", [(5, 1024), (5, 10), (6, 40), (7, 3)])
def test_links_at_every_block_count_and_slicing(spark, blocks, slice_rows):
    rng = np.random.default_rng(3)
    centre = rng.integers(0, 1 << 63, 12).astype(np.uint64)
    fps = set(rng.integers(0, 1 << 63, 200).tolist()) | {0, (1 << 64) - 1}
    for c in centre.tolist() * 15:
        for b in rng.choice(64, int(rng.integers(0, 5)), replace=False).tolist():
            c ^= 1 << b
        fps.add(c)
    chain = 1
    for b in range(60):  # a long chain of links
        chain |= 1 << b
        fps.add(chain)
    docs = sorted(fps)
    signed = [x - (1 << 64) if x >> 63 else x for x in docs]
    frame = spark.createDataFrame([(x,) for x in signed], "fp long").repartition(3)
    found = simhash.components(simhash.edges(frame, len(docs), blocks=blocks, slice_rows=slice_rows))
    root = dict(zip(signed, signed)) | {r["node"]: r["root"] for r in rows(found)}
    want = brute_components(list(zip(signed, docs)))
    groups = {}
    for x in signed:
        groups.setdefault(root[x], set()).add(x)
    expected = {}
    for x in signed:
        expected.setdefault(want[x], set()).add(x)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expected.values()))


def test_gray_index_against_all_pairs():
    rng = np.random.default_rng(5)
    for n in (1, 2, 15, 17, 300, 1000):
        fps = np.unique(rng.integers(0, 1 << 20, n).astype(np.uint64) << np.uint64(3))
        want = {(i, j) for i in range(len(fps)) for j in np.flatnonzero(np.bitwise_count(fps ^ fps[i]) <= 4).tolist()}
        got = [(int(a), int(b)) for q, p in simhash.GrayIndex(fps).pairs(fps, 4, 500) for a, b in zip(q, p)]
        assert len(got) == len(set(got)) and set(got) == want


def test_enough_blocks_for_any_size():
    assert simhash.n_blocks(10**5) == 5 and simhash.n_blocks(10**10) >= 7
    for b in (5, 6, 7, 8, 9):
        masks = simhash.block_masks(b)
        assert sum(masks) == (1 << 64) - 1


def test_keep_first(spark):
    docs = documents(spark, ["a b c d e", "A b c d e", "other words entirely here now", None, ""])
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {4, 3, 1}


def test_fingerprints_of_many_texts_at_once():
    rng = np.random.default_rng(9)
    parts = ["a", "B", "word", "WORD", "é", "漢字", " ", "x" * 45, "Y" * 700, "\x1c", "\x00", " ", "  ", "\t", "\n", "\x0b", "\x0c", "\r", " one two three four five "]
    for shingle in (1, 3, 4):
        texts = ["".join(rng.choice(parts, int(rng.integers(0, 60)))) for _ in range(120)] + ["", " \n", "lone", "a b c d", " ".join(f"w{i}" for i in range(3000))]
        assert simhash.fingerprinted([t.encode() for t in texts], shingle).tolist() == [brute_fp(t, shingle) for t in texts]
    assert len(simhash.fingerprinted([])) == 0


def test_hashes_of_every_length():
    data = np.random.default_rng(4).integers(0, 256, 700, dtype=np.uint8)
    at = np.arange(200)
    for length in [*range(0, 100), 255, 256, 480]:
        assert simhash.xxh64(data, at, length).tolist() == [xxhash.xxh64_intdigest(data[a:a + length].tobytes(), 42) for a in at.tolist()]


def near_copies(n, bits, seed):
    rng = np.random.default_rng(seed)
    flips = np.array([sum(1 << int(b) for b in rng.choice(64, bits, replace=False)) for _ in range(n)], np.uint64)
    return np.unique(flips ^ np.uint64(0x123456789ABCDEF))


def test_spanning_edges_against_all_pairs():
    rng = np.random.default_rng(8)
    for n, near, bits in ((1, 2, 1), (30, 60, 3), (300, 200, 5), (5, 400, 7)):
        fps = np.unique(np.concatenate([rng.integers(0, 1 << 63, n).astype(np.uint64), near_copies(near, bits, n)]))
        for part in (None, rng.integers(0, 2, len(fps)), (np.arange(len(fps)) < 3).astype(int), np.zeros(len(fps), int)):
            a, b = np.nonzero(np.bitwise_count(fps[:, None] ^ fps) <= 4)
            apart = slice(None) if part is None else part[a] != part[b]
            want = simhash.forest(np.arange(len(fps)), a[apart], b[apart])
            for at_once in (50, 1 << 18):
                assert (simhash.spanning(fps, part, 4, at_once) == want).all()
            u, v = simhash.leaf_links(fps[:16], np.array([len(fps[:16])]), np.full(len(fps[:16]), -1) if part is None else part[:16], 4)
            first = np.nonzero((a < 16) & (b < 16) & (True if part is None else part[a] != part[b]))[0]
            assert len(u) == len(v) == np.count_nonzero(simhash.forest(np.arange(len(fps[:16])), a[first], b[first]) != np.arange(len(fps[:16])))


def test_near_copies_are_not_compared_by_the_square(monkeypatch):
    asked = []
    pairs = simhash.GrayIndex.pairs
    monkeypatch.setattr(simhash.GrayIndex, "pairs", lambda self, queries, *a: asked.append(len(queries) * len(self.fps)) or pairs(self, queries, *a))
    fps = near_copies(3000, 3, 1)
    u, _ = simhash.links_of(fps, None, 4)
    assert len(u) == len(fps) - 1
    assert sum(asked) < len(fps) ** 2 / 8


def test_few_keys_a_fingerprint():
    """A key is a row to shuffle, while some hundred fingerprints of a key are compared in less time."""
    assert simhash.n_blocks(3_000_000) == 5 and simhash.n_blocks(20_000_000) == 6


def test_large_keys_merged_or_broadcast(spark, monkeypatch):
    fps = near_copies(400, 3, 6)
    frame = spark.createDataFrame([(x,) for x in fps.view(np.int64).tolist()], "fp long").repartition(3)
    for most in (0, 1 << 16):
        monkeypatch.setattr(simhash, "LARGE_KEYS", most)
        found = rows(simhash.components(simhash.edges(frame, len(fps), slice_rows=50)))
        assert {r["root"] for r in found} == {int(fps.view(np.int64).min())} and len({r["node"] for r in found} | {r["root"] for r in found}) == len(fps)
