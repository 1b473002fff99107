"""SimHash near-dedup with a Gray-order hierarchical index.

Fingerprints: XXH64 (seed 42) of every shingle of ``shingle`` words, repeats
included; a bit is set if it is set in over half of the hashes.  The shingles of
many texts are hashed together, those of one length in each step.  Documents whose
fingerprints differ in at most ``distance`` bits are linked; a component's id is
its smallest doc_id.

Only distinct fingerprints are compared.  They are cut into blocks of bits so
that two fingerprints within the distance agree on some choice of whole blocks
(pigeonhole); each choice is one table, and the value of its blocks is a key
that co-locates what may be linked.  The number of blocks follows from the number
of fingerprints, so that a key holds some hundred of them at most; any number of
blocks finds all links.  A key with more than ``SLICE`` fingerprints (a large group
of near copies) is cut into slices, and each pair of slices is a task's group of its own.

Inside a group the fingerprints are sorted by Gray rank, so neighbours share most
bits.  Leaves of 16 form a tree of fan-out 4; a node keeps the bits that all below
it share, less those that a node above already keeps.  A search adds up a query's
differences to the kept bits on its way down and leaves a whole node as soon as
they exceed the distance.  Found links become a spanning forest at once, so no
group's pairs leave its task, and links inside the group's largest component are
not looked for once it is known.  Groups of one leaf are compared together.

Components: large-star and small-star steps on the forests' edges, each written to
the shared folder; no links or components reach the driver.

A null or wordless text has fingerprint zero, linked like any other.  Repeated
rows share a fingerprint.  Null doc_ids are smallest only if no other id is there.
An empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import digest, raw, slices, without, written

SHINGLE, DISTANCE, SEED = 4, 4, 42
#: Text bytes hashed at once: each takes some ten bytes of arrays.
SLICE_TEXT = 4 << 20
#: Runs hashed in one go.
RUN = 1 << 14
#: White space to a space, A-Z to a-z, all other bytes to themselves.
FOLD = bytes(32 if b in b"\t\n\v\f\r" else b + 32 if 65 <= b <= 90 else b for b in range(256))
#: Of XXH64.
PRIMES = tuple(map(np.uint64, (11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261)))
#: Fingerprints of a group that one task compares at once.
SLICE = 4096
#: Fingerprints a key should hold at most, on average: to compare so many takes less than more keys for each.
PER_KEY = 512
#: Keys with more than a slice that are broadcast at most; more are merged.
LARGE_KEYS = 1 << 16
LEAF, FAN = 16, 4


def _turned(x: np.ndarray, by: int) -> np.ndarray:
    """``x``, itself turned left by so many bits."""
    high = x >> np.uint64(64 - by)
    x <<= np.uint64(by)
    x |= high
    return x


def _lane(lane: np.ndarray, before: np.ndarray | np.uint64 = np.uint64(0)) -> np.ndarray:
    lane *= PRIMES[1]
    lane += before
    _turned(lane, 31)
    lane *= PRIMES[0]
    return lane


def xxh64(data: np.ndarray, at: np.ndarray, length: int, seed: int = SEED) -> np.ndarray:
    """XXH64 of the runs of ``length`` bytes of ``data`` that begin ``at``; 7 more bytes stand behind the last."""
    p1, p2, p3, p4, p5 = PRIMES
    whole = lambda n: np.uint64(n % (1 << 64))
    eights, fours = (np.ndarray(len(data) - 7, kind, data.data, strides=(1,)) for kind in ("<u8", "<u4"))
    left = length
    if left >= 32:
        lanes = [whole(seed + int(p1) + int(p2)), whole(seed + int(p2)), whole(seed), whole(seed - int(p1))]
        while left >= 32:
            lanes = [_lane(eights[at + 8 * i], x) for i, x in enumerate(lanes)]
            at, left = at + 32, left - 32
        h = sum(_turned(x.copy(), by) for x, by in zip(lanes, (1, 7, 12, 18), strict=True))
        for x in lanes:
            h ^= _lane(x)
            h *= p1
            h += p4
        h += np.uint64(length)
    else:
        h = np.full(len(at), whole(seed + int(p5) + length))
    while left >= 8:
        h ^= _lane(eights[at])
        _turned(h, 27)
        h *= p1
        h += p4
        at, left = at + 8, left - 8
    if left >= 4:
        h ^= fours[at] * p1
        _turned(h, 23)
        h *= p2
        h += p3
        at, left = at + 4, left - 4
    while left:
        h ^= data[at] * p5
        _turned(h, 11)
        h *= p1
        at, left = at + 1, left - 1
    h ^= h >> np.uint64(33)
    h *= p2
    h ^= h >> np.uint64(29)
    h *= p3
    h ^= h >> np.uint64(32)
    return h


def _hashes(data: np.ndarray, at: np.ndarray, length: np.ndarray) -> np.ndarray:
    """XXH64 of each run; runs of one length go through each step together, those of rare lengths one by one."""
    out = np.empty(len(at), np.uint64)
    narrow = length.astype(np.uint16) if length.max(initial=0) < 1 << 16 else length  # sorted by radix
    order = np.argsort(narrow, kind="stable")
    cuts = np.flatnonzero(np.diff(narrow[order])) + 1
    view = data.data
    for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(order)]):
        n = int(length[order[lo]]) if hi > lo else 0
        for at_once in range(lo, hi, RUN):
            own = order[at_once:min(hi, at_once + RUN)]
            out[own] = xxh64(data, at[own], n) if len(own) > n else [xxhash.xxh64_intdigest(view[a:a + n], SEED) for a in at[own].tolist()]
    return out


def fingerprinted(texts: list[bytes], shingle: int = SHINGLE) -> np.ndarray:
    """The 64-bit SimHash of each text's shingles; 0 without words."""
    folded = [t.translate(FOLD) for t in texts]
    data = np.frombuffer(b" ".join([b"", *folded, b""]), np.uint8)
    space = data == 32
    first = space[:-1] & ~space[1:]  # a word begins behind it
    n = np.diff(np.searchsorted(np.flatnonzero(first), np.cumsum([0, *(len(t) + 1 for t in folded)])))
    data = np.concatenate([data[1:][~(space[:-1] & space[1:])], np.zeros(8, np.uint8)])  # one space behind each word
    stop = np.flatnonzero(data[:-8] == 32)
    start = np.concatenate([[0], stop + 1])[:len(stop)]
    end = np.cumsum(n)
    last = np.repeat(end - 1, n)
    to = np.arange(len(stop)) + shingle - 1
    inside = to <= last
    inside[(end - n)[n > 0]] = True  # of fewer words than a shingle's, all
    to = np.minimum(to, last)[inside]
    start = start[inside]
    hashes = _hashes(data, start, stop[to] - start)
    return _majority(hashes, np.where(n > 0, np.maximum(n - shingle + 1, 1), 0))


def _majority(hashes: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The bits set in over half of each text's ``n`` hashes; 0 where there are none."""
    out = np.zeros(len(n), np.uint64)
    some = n[n > 0]
    if not len(some):
        return out
    # a byte counts a bit of up to 255 hashes, so a word counts eight bits at once
    pieces = -(-some // 255)
    of = np.cumsum(pieces) - pieces
    starts = np.repeat(np.cumsum(some) - some, pieces) + 255 * (np.arange(pieces.sum()) - np.repeat(of, pieces))
    ones = np.empty((len(some), 8, 8), np.int64)
    for bit in range(8):
        counted = np.add.reduceat(hashes >> np.uint64(bit) & np.uint64(0x0101010101010101), starts)
        ones[:, :, bit] = np.add.reduceat(counted.view(np.uint8).reshape(-1, 8), of, axis=0, dtype=np.int64)
    out[n > 0] = np.packbits(2 * ones.reshape(-1, 64) > some[:, None], axis=1, bitorder="little").view(np.uint64)[:, 0]
    return out


def _fingerprints(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, limit=SLICE_TEXT):
                found = fingerprinted(raw(part.column("text")), shingle)
                keep = [n for n in part.schema.names if n != "text"]
                yield pa.RecordBatch.from_arrays([part.column(n) for n in keep] + [pa.array(found.view(np.int64))], names=[*keep, "fp"])
    return run


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, *more: Column) -> DataFrame:
    """doc_id, ``more``, fp (the fingerprint as a signed long) of every row, written."""
    rows = docs.select(F.col("doc_id").cast("long"), *more, F.col("text").cast("string"))
    fields = [f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != "text"]
    return written(rows.mapInArrow(_fingerprints(shingle), ", ".join([*fields, "fp long"])), "fingerprints")


def gray_rank(x: np.ndarray) -> np.ndarray:
    """Place of each bit pattern in the reflected Gray code's order."""
    out = x.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        out ^= out >> np.uint64(shift)
    return out


class GrayIndex:
    """Exact search within a Hamming distance over distinct fingerprints."""

    def __init__(self, fps: np.ndarray) -> None:
        self.order = np.argsort(gray_rank(fps), kind="stable")
        self.fps = fps[self.order]
        shared, pattern = np.full(len(fps), ~np.uint64(0)), self.fps
        self.levels = []  # from the leaves up: (kept bits, their values, width below)
        width = LEAF
        while True:
            starts = np.arange(0, len(shared), width)
            # bits on which all below agree, taking from each only those it shares itself
            ones = np.bitwise_and.reduceat(pattern | ~shared, starts)
            zeros = np.bitwise_and.reduceat(~pattern | ~shared, starts)
            both = np.bitwise_and.reduceat(shared, starts)
            shared, pattern = (ones | zeros) & both, ones & both
            self.levels.append([shared, pattern & shared, width])
            if len(shared) == 1:
                break
            width = FAN
        for below, above in zip(self.levels, self.levels[1:]):  # a node keeps what its parent doesn't
            parent = np.arange(len(below[0])) // above[2]
            below.append(below[0] & ~above[0][parent])
        self.levels[-1].append(self.levels[-1][0])
        self.leaves = np.concatenate([self.fps, np.zeros(-len(fps) % LEAF, np.uint64)]).reshape(-1, LEAF)

    def pairs(self, queries: np.ndarray, distance: int, at_once: int = 1 << 18) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query number, place in the input) of all within the distance, in bounded runs."""
        step = max(1, at_once // max(LEAF, len(self.fps)))
        for lo in range(0, len(queries), step):
            yield self._search(queries, np.arange(lo, min(len(queries), lo + step)), distance)

    def _search(self, queries: np.ndarray, q: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
        node, gone = np.zeros(len(q), np.int64), np.zeros(len(q), np.int64)
        for level in range(len(self.levels) - 1, -1, -1):
            _, pattern, width, kept = self.levels[level]
            gone = gone + np.bitwise_count((queries[q] ^ pattern[node]) & kept[node])
            live = gone <= distance
            q, node, gone = q[live], node[live], gone[live]
            if level:
                child = node[:, None] * width + np.arange(width)
                inside = child < len(self.levels[level - 1][0])
                q, gone, node = np.broadcast_to(q[:, None], child.shape)[inside], np.broadcast_to(gone[:, None], child.shape)[inside], child[inside]
        # a leaf's fingerprints lie side by side
        hit = np.flatnonzero(np.bitwise_count(self.leaves[node] ^ queries[q][:, None]) <= distance)
        q, place = q[hit // LEAF], node[hit // LEAF] * LEAF + hit % LEAF
        there = place < len(self.fps)
        return q[there], self.order[place[there]]


def forest(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest member of each number's component, once a and b are linked, too."""
    while True:
        x, y = root[a], root[b]
        apart = x != y
        if not apart.any():
            return root
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while True:  # to the roots
            up = root[root]
            if (up == root).all():
                break
            root = up


def spanning(fps: np.ndarray, part: np.ndarray | None, distance: int, at_once: int = 1 << 18) -> np.ndarray:
    """The smallest member of each fingerprint's component.

    part: 0 or 1 where only links between the two parts are looked for.  Links inside a component
    add nothing, so what is in the largest one is asked for by the others only: a group of near
    copies takes time by its size and not by its square.
    """
    root, asked = np.arange(len(fps)), np.zeros(len(fps), bool)
    if part is not None and part.min() == part.max():
        return root
    sides = [(root.copy(), root.copy())] if part is None else [tuple(np.flatnonzero(part == x) for x in own) for own in ((1, 0), (0, 1))]
    trees = [GrayIndex(fps[there]) for _, there in sides]
    step = max(1, at_once // max(LEAF, len(fps)))
    while True:
        outside = root != np.bincount(root).argmax()
        left = [own[~asked[own] & outside[own]] for own, _ in sides]
        side, ask = 0, left[0]
        if part is not None and not len(ask):  # either the other part's or the rest of this one's makes it whole
            rest = sides[0][0][~asked[sides[0][0]]]
            side, ask = (0, rest) if len(rest) <= len(left[1]) else (1, left[1])
        if not len(ask):
            return root
        ask = ask[::-(-len(ask) // step)]
        asked[ask] = True
        for q, place in trees[side].pairs(fps[ask], distance, at_once):
            root = forest(root, ask[q], sides[side][1][place])


def links_of(fps: np.ndarray, part: np.ndarray | None, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning edges (fingerprint, smaller fingerprint) of a group.

    part: 0 or 1 where only links between the two parts are looked for.
    """
    order = np.argsort(fps.view(np.int64), kind="stable")
    fps = fps[order]
    root = spanning(fps, None if part is None else part[order], distance)
    moved = np.flatnonzero(root != np.arange(len(fps)))
    return fps[moved], fps[root[moved]]


def leaf_links(fps: np.ndarray, size: np.ndarray, part: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning edges (fingerprint, smaller fingerprint) of groups that are one leaf each, all at once.

    Groups stand one behind another; size: rows of each; part: of each row its slice, or -1 where all are compared.
    """
    behind = np.repeat(np.cumsum(size), size) - np.arange(len(fps))  # rows from here to the group's end
    root, at = np.arange(len(fps)), np.arange(len(fps))
    for off in range(1, int(size.max(initial=0))):
        at = at[behind[at] > off]
        near = at[np.bitwise_count(fps[at] ^ fps[at + off]) <= distance]
        near = near[(part[near] < 0) | (part[near] != part[near + off])]
        root = forest(root, near, near + off)
    moved = np.flatnonzero(root != np.arange(len(fps)))
    pair = np.sort(np.stack([fps[moved], fps[root[moved]]], 1).view(np.int64), axis=1).view(np.uint64)
    return pair[:, 1], pair[:, 0]


def _group_links(distance: int):
    """Groups arrive sorted by (choice, key, a, b); one is held at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            ids = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("choice", "key", "a", "b", "slice")], 1)
            fps = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            if held is not None:
                ids, fps = np.concatenate([held[0], ids]), np.concatenate([held[1], fps])
            cut = np.flatnonzero((ids[1:, :4] != ids[:-1, :4]).any(1)) + 1
            bounds = [0, *cut.tolist()]
            held = ids[bounds[-1]:], fps[bounds[-1]:]
            yield _edges(ids, fps, bounds, distance)
        if held is not None and len(held[0]):
            yield _edges(*held, [0, len(held[0])], distance)
    return run


def _edges(ids: np.ndarray, fps: np.ndarray, bounds: list[int], distance: int) -> pa.RecordBatch:
    size, part = np.diff(bounds), np.where(ids[:, 2] == ids[:, 3], -1, ids[:, 4])
    small = (size > 1) & (size <= LEAF)
    rows = np.flatnonzero(np.repeat(small, size))
    out = [leaf_links(fps[rows], size[small], part[rows], distance)]
    for i in np.flatnonzero(size > LEAF).tolist():
        lo, hi = bounds[i], bounds[i + 1]
        out.append(links_of(fps[lo:hi], None if part[lo] < 0 else (part[lo:hi] == ids[lo, 3]).astype(int), distance))
    a, b = (np.concatenate(x).view(np.int64) for x in zip(*out, strict=True))
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["u", "v"])


def block_masks(blocks: int) -> list[int]:
    """The bits of each block; sizes differ by one at most."""
    ends = [64 * (i + 1) // blocks for i in range(blocks)]
    return [(1 << b) - (1 << a) for a, b in zip([0, *ends], ends)]


def n_blocks(n: int, distance: int = DISTANCE, per_key: int = PER_KEY) -> int:
    """Blocks so that about ``per_key`` of ``n`` fingerprints, or fewer, share a key."""
    for blocks in range(distance + 1, 2 * distance + 2):
        if n <= per_key * 2 ** (64 * (blocks - distance) / blocks):
            break
    return blocks


def edges(distinct: DataFrame, n: int, distance: int = DISTANCE, slice_rows: int = SLICE, blocks: int | None = None) -> DataFrame:
    """Spanning edges u, v (v smaller) of the links among distinct fingerprints ``fp``."""
    blocks = blocks or n_blocks(n, distance)
    masks = block_masks(blocks)
    signed = lambda m: m - (1 << 64) if m >> 63 else m
    choices = [sum(masks[i] for i in c) for c in combinations(range(blocks), blocks - distance)]
    keyed = distinct.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(signed(m))) for m in choices])).alias("choice", "key"))
    sizes = keyed.groupBy("choice", "key").agg(F.count("*").alias("size")).where(F.col("size") > slice_rows)
    large = written(sizes.withColumn("slices", F.ceil(F.col("size") / slice_rows).cast("int")).drop("size"), "large")
    large = large.hint("broadcast" if large.count() <= LARGE_KEYS else "merge")
    sized = keyed.join(large, ["choice", "key"], "left").fillna(1, ["slices"])
    own = F.pmod(F.xxhash64("fp"), F.col("slices")).cast("int")
    sized = sized.withColumn("slice", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
    groups = sized.select("choice", "key", F.least("slice", "other").alias("a"), F.greatest("slice", "other").alias("b"), "slice", "fp")
    by = ["choice", "key", "a", "b"]
    return groups.repartition(*by).sortWithinPartitions(*by).mapInArrow(_group_links(distance), "u long, v long")


def components(links: DataFrame) -> DataFrame:
    """node, root of all nodes of the links u, v: large-star and small-star until nothing moves."""
    current = written(links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    total = None
    while True:
        # large-star: larger neighbours of a node go to its smallest neighbour
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = written(large, "large-star")
        # small-star: a node and its smaller neighbours go to the smallest of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v"))).distinct()
        small = written(small, "small-star")
        now = small.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == total:
            return small.select(F.col("u").alias("node"), F.col("v").alias("root"))
        current, total = small, now


def _components_of(rows: DataFrame, first: Column, distance: int, **options) -> DataFrame:
    """fp, component_id (the smallest ``first`` of the component) of every fingerprint of ``rows``."""
    distinct = written(rows.groupBy("fp").agg(F.min(first).alias("first")), "distinct")
    roots = components(edges(distinct.select("fp"), distinct.count(), distance, **options))
    named = distinct.join(roots, distinct["fp"] == roots["node"], "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    named = written(named, "roots")
    smallest = named.groupBy("root").agg(F.min("first").alias("component_id"))
    return named.select("fp", "root").join(smallest, "root").select("fp", "component_id")


def groups(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, **options) -> DataFrame:
    """doc_id, fp, component_id of every row of ``docs``."""
    rows = fingerprints(docs, shingle)
    return rows.join(_components_of(rows, F.col("doc_id"), distance, **options), "fp").select("doc_id", "fp", "component_id")


def judge(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id."""
    found = groups(docs, shingle, distance)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """Of each component one row stays, with all its columns: of those with the smallest
    doc_id (null ids last) the one whose text's SHA-256 is smallest, of equal ones any.
    """
    rows = fingerprints(docs, shingle, digest().alias("digest"))
    place = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col("digest"))
    found = rows.join(_components_of(rows, place, distance), "fp")
    keys = found.groupBy("doc_id", "digest").agg(F.count("*").alias("n"), F.min(place == F.col("component_id")).alias("stays"))
    return without(docs, written(keys.where("n > 1 or not stays").drop("n"), "lost"))
