"""Hard-negative mining with anchor-clustered shared lists.

Anchors are the rows whose vec_id is divisible by ``every``; a row's score is its integer
inner product with the anchor.  An anchor's positives are its best ``positives`` rows of
its own label; for each of them the best ``negatives`` rows of other labels whose score lies
between 30 and 90 % of the positive's are its hard negatives.

Anchors are clustered by angle.  For a cluster with centre c and widest angle t between c and
a member, no member's score with a vector x exceeds |member| |x| cos(max(angle(c, x) - t, 0)).
The vectors of a batch are sorted by that bound once a cluster; every member walks the shared
list, a slice at a time, and leaves it as soon as the next bound is below the last score it
still needs, which proves that nothing further on can enter its result.  What a member needs
starts at what its fellow anchors give it and rises from batch to batch; each task sends the
best rows that it saw, and a ranking of those is exact.

The anchors (a share of all rows) are taken in blocks of bounded bytes.  A block is broadcast, its
results are written and its broadcast is freed before the next, so neither the driver nor a task
ever holds more than one.  The other vectors stay where they are: none is shuffled or broadcast.

Components become floor(256 x).  Rows with a null vec_id, label or vector, or with a null or
non-finite component take no part; shorter vectors count as ended by zeros.  Where vec_id is
divisible by ``shift_every`` the label becomes (label + 1) mod 10 first.  Equal scores rank by
smaller vec_id.  Rows that share a vec_id are rows of their own, told apart by the place at which
they were written.  Scores must fit in a long.  An anchor without positives, or a positive without
negatives, gives no row; so does an empty table.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written

EVERY, SHIFT_EVERY, POSITIVES, NEGATIVES = 100, 7, 5, 10
#: Bytes of anchor vectors in a block, anchors in a cluster (on average), clusters at most.
BLOCK_BYTES, PER_CLUSTER, CLUSTERS = 16 << 20, 32, 256
#: Anchors that the centres are fitted on; only speed depends on the centres.
FIT_ROWS = 4096
#: Vectors of a shared list that are scored at once.
STEP = 1024
_NONE = np.iinfo(np.int64).min


def prepared(vectors: DataFrame, shift_every: int = SHIFT_EVERY) -> DataFrame:
    """uid, vec_id, label, q (whole numbers) of the rows that take part, written."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))  # NaN counts as larger
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), F.col("embedding"))
    rows = rows.where("vec_id is not null and label is not null and embedding is not null").where(finite)
    label = F.when(F.col("vec_id") % shift_every == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    q = F.transform("embedding", lambda x: F.floor(F.lit(256.0) * x.cast("double")))
    return written(rows.select(F.monotonically_increasing_id().alias("uid"), "vec_id", label.alias("label"), q.alias("q")), "vectors")


def matrix(column: pa.Array) -> np.ndarray:
    """Lists of whole numbers as the rows of a matrix, shorter ones ended by zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    width = int(sizes.max(initial=0))
    if len(sizes) and (sizes == width).all():
        return values.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = values
    return out


def padded(x: np.ndarray, width: int) -> np.ndarray:
    return x if x.shape[1] >= width else np.pad(x, ((0, 0), (0, width - x.shape[1])))


def norms(x: np.ndarray) -> np.ndarray:
    return np.sqrt((x.astype(np.float64) ** 2).sum(1))


def exact_kind(largest: float) -> type:
    """A number type in which inner products of at most that size are exact; by Cauchy-Schwarz so are their sums."""
    if largest < 2 ** 23:
        return np.float32
    if largest < 2 ** 52:
        return np.float64
    if largest < 2 ** 62:
        return np.int64
    raise OverflowError("scores must fit in a long")


class Block:
    """Some anchors, clustered by angle."""

    def __init__(self, uid: np.ndarray, vec_id: np.ndarray, label: np.ndarray, x: np.ndarray) -> None:
        self.uid, self.vec_id, self.label, self.x, self.norm = uid, vec_id, label, x, norms(x)
        unit = x / np.maximum(self.norm, 1e-300)[:, None]
        n = min(CLUSTERS, max(1, len(x) // PER_CLUSTER))
        rng = np.random.default_rng(0)
        fit = unit[rng.permutation(len(x))[:FIT_ROWS]]
        self.centres = fit[:n].copy()
        for _ in range(8):
            of = (fit @ self.centres.T).argmax(1)
            for k in range(n):
                if (of == k).any():
                    self.centres[k] = fit[of == k].sum(0)
            self.centres /= np.maximum(norms(self.centres), 1e-300)[:, None]
        near = unit @ self.centres.T
        of = near.argmax(1)
        self.members = [np.flatnonzero(of == k) for k in range(n)]
        #: Widest angle to a member, with slack for rounding; a member of length zero scores zero anyway.
        self.widest = [float(np.arccos(np.clip(near[m, k][self.norm[m] > 0], -1, 1)).max(initial=0)) + 1e-7 for k, m in enumerate(self.members)]

    def walk(self, x: np.ndarray, need, visit, only: int | None = None) -> None:
        """Scores of every member with the vectors of its cluster's list until it may leave.

        need() is the least score each anchor still wants; visit(anchors, vectors, scores) takes a slice.
        """
        if not len(x):
            return
        width = max(x.shape[1], self.x.shape[1])
        x, own, centres = padded(x, width), padded(self.x, width), padded(self.centres, width)
        size = norms(x)
        kind = exact_kind(float(size.max()) * float(self.norm.max(initial=0)))
        x, own = x.astype(kind), own.astype(kind)
        near = np.clip((x.astype(np.float64) @ centres.T) / np.maximum(size, 1e-300)[:, None], -1, 1)
        for k, members in enumerate(self.members):
            if not len(members) or only not in (None, k):
                continue
            bound = size * np.cos(np.maximum(np.arccos(near[:, k]) - self.widest[k], 0)) + 1e-6 * size.max()
            order = np.argsort(-bound, kind="stable")
            for lo in range(0, len(order), STEP):
                live = members[self.norm[members] * bound[order[lo]] + 1 >= need()[members]]
                if not len(live):
                    break
                some = order[lo:lo + STEP]
                visit(live, some, (own[live] @ x[some].T).astype(np.int64))


class Best:
    """The best ``k`` entries (score, vec_id, uid) of each slot; larger scores, smaller ids first."""

    def __init__(self, slots: int, k: int) -> None:
        self.k = k
        self.score, self.vec_id, self.uid = (np.full((slots, k), fill, np.int64) for fill in (_NONE, 0, 0))

    def add(self, slot: np.ndarray, score: np.ndarray, vec_id: np.ndarray, uid: np.ndarray) -> None:
        if not len(slot):
            return
        old = np.unique(slot)
        old, at = np.repeat(old, self.k), np.tile(np.arange(self.k), len(old))
        there = self.score[old, at] != _NONE
        old, at = old[there], at[there]
        slot, score, vec_id, uid = (np.r_[a, b] for a, b in ((slot, old), (score, self.score[old, at]), (vec_id, self.vec_id[old, at]), (uid, self.uid[old, at])))
        order = np.lexsort((uid, vec_id, -score, slot))
        slot = slot[order]
        first = np.flatnonzero(np.r_[True, slot[1:] != slot[:-1]])
        place = np.arange(len(slot)) - np.repeat(first, np.diff(np.r_[first, len(slot)]))
        stay = place < self.k
        slot, place, order = slot[stay], place[stay], order[stay]
        self.score[slot, place], self.vec_id[slot, place], self.uid[slot, place] = score[order], vec_id[order], uid[order]

    def last(self) -> np.ndarray:
        """The score that a new entry must reach."""
        return self.score[:, -1]

    def batch(self, slots: np.ndarray) -> pa.RecordBatch:
        at = np.nonzero(self.score != _NONE)
        return pa.RecordBatch.from_arrays([pa.array(slots[at[0]]), pa.array(self.vec_id[at]), pa.array(self.uid[at]), pa.array(self.score[at])],
                                          names=["slot", "vec_id", "uid", "score"])


class Positives:
    """The walk for rows of the anchor's own label."""

    def __init__(self, block: Block, k: int, floor: np.ndarray | None = None) -> None:
        self.block, self.best = block, Best(len(block.uid), k)
        self.floor = np.full(len(block.uid), _NONE) if floor is None else floor

    def need(self) -> np.ndarray:
        return np.maximum(self.floor, self.best.last())

    def see(self, uid: np.ndarray, vec_id: np.ndarray, label: np.ndarray, x: np.ndarray, only: int | None = None) -> None:
        b = self.block

        def visit(live: np.ndarray, some: np.ndarray, scores: np.ndarray) -> None:
            ok = (scores >= self.need()[live][:, None]) & (label[some] == b.label[live][:, None]) & (uid[some] != b.uid[live][:, None])
            r, c = np.nonzero(ok)
            self.best.add(live[r], scores[r, c], vec_id[some[c]], uid[some[c]])
        b.walk(x, self.need, visit, only)


class Negatives:
    """The walk for rows of other labels within each positive's band; a slot is (anchor, place of the positive)."""

    def __init__(self, block: Block, positive: np.ndarray, k: int, floor: np.ndarray | None = None) -> None:
        """positive: (anchors, positives) scores, or the least long where there is none."""
        self.block, self.n = block, positive.shape[1]
        self.best = Best(positive.size, k)
        there = positive != _NONE
        safe = np.where(there, positive, 0)
        self.low, self.high = -((-30 * safe) // 100), (90 * safe) // 100  # 30 p <= 100 n <= 90 p
        self.open = there & (self.low <= self.high)
        self.floor = np.full(positive.shape, _NONE) if floor is None else floor

    def wanted(self) -> np.ndarray:
        """Least score for each slot."""
        return np.maximum(np.maximum(self.low, self.floor), self.best.last().reshape(self.low.shape))

    def need(self) -> np.ndarray:
        return np.where(self.open, self.wanted(), np.iinfo(np.int64).max).min(1, initial=np.iinfo(np.int64).max)

    def see(self, uid: np.ndarray, vec_id: np.ndarray, label: np.ndarray, x: np.ndarray, only: int | None = None) -> None:
        b = self.block

        def visit(live: np.ndarray, some: np.ndarray, scores: np.ndarray) -> None:
            r, c = np.nonzero((scores >= self.need()[live][:, None]) & (label[some] != b.label[live][:, None]))
            score, wanted = scores[r, c], self.wanted()
            for p in range(self.n):
                a = live[r]
                ok = self.open[a, p] & (score >= wanted[a, p]) & (score <= self.high[a, p])
                self.best.add(a[ok] * self.n + p, score[ok], vec_id[some[c[ok]]], uid[some[c[ok]]])
        b.walk(x, self.need, visit, only)


def _walked(shared, make):
    """Every task walks its batches with a state of its own and sends the best it saw."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, *more = shared.value
        floor = make(block, *more)
        for k, members in enumerate(block.members):  # what fellow anchors give is a floor for what is needed
            floor.see(block.uid[members], block.vec_id[members], block.label[members], block.x[members], k)
        state = make(block, *more, floor=floor.best.last().reshape(floor.floor.shape))
        del floor
        for batch in batches:
            ids = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("uid", "vec_id", "label")]
            state.see(*ids, matrix(batch.column("q")))
        yield state.best.batch(np.arange(len(state.best.score)))
    return run


_FOUND = "slot long, vec_id long, uid long, score long"


def _ranked(found: DataFrame, k: int) -> DataFrame:
    place = Window.partitionBy("slot").orderBy(F.col("score").desc(), "vec_id", "uid")
    return found.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k)


def _mine_block(rows: DataFrame, anchors: pa.Table, positives: int, negatives: int) -> DataFrame:
    """The result rows of one block of anchors, written."""
    context = rows.sparkSession.sparkContext
    uid, vec_id, label = (anchors.column(c).to_numpy() for c in ("uid", "vec_id", "label"))
    block = Block(uid, vec_id, label, matrix(anchors.column("q")))
    shared = context.broadcast((block,))
    found = rows.mapInArrow(_walked(shared, lambda b, floor=None: Positives(b, positives, floor)), _FOUND)
    best = written(_ranked(found, positives), "positives").toArrow()  # positives x anchors of the block
    shared.unpersist()
    slot, place = best.column("slot").to_numpy(), best.column("rank").to_numpy() - 1
    score, who = np.full((len(uid), positives), _NONE), np.zeros((len(uid), positives), np.int64)
    score[slot, place], who[slot, place] = best.column("score").to_numpy(), best.column("vec_id").to_numpy()
    shared = context.broadcast((block, score, who))
    found = rows.mapInArrow(_walked(shared, lambda b, s, _, floor=None: Negatives(b, s, negatives, floor)), _FOUND)

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b, s, w = shared.value
        for batch in batches:
            a, p = np.divmod(batch.column("slot").to_numpy(zero_copy_only=False), s.shape[1])
            yield pa.RecordBatch.from_arrays([pa.array(b.vec_id[a]), pa.array(w[a, p]), batch.column("rank"), batch.column("vec_id"), pa.array(s[a, p]), batch.column("score")],
                                             names=[f.split()[0] for f in _MINED.split(", ")])
    out = written(_ranked(found, negatives).mapInArrow(named, _MINED), "negatives")
    shared.unpersist()
    return out


_MINED = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def mine(vectors: DataFrame, every: int = EVERY, shift_every: int = SHIFT_EVERY, positives: int = POSITIVES, negatives: int = NEGATIVES,
         block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    spark = vectors.sparkSession
    rows = prepared(vectors, shift_every)
    anchors = rows.where(F.col("vec_id") % every == 0)
    size = anchors.agg(F.sum(8 * F.size("q") + 32)).first()[0] or 0
    blocks = -(-size // block_bytes)
    dealt = anchors.withColumn("block", F.pmod(F.xxhash64("uid"), F.lit(max(1, blocks))))
    done = [_mine_block(rows, dealt.where(F.col("block") == i).drop("block").toArrow(), positives, negatives) for i in range(blocks)]
    return reduce(DataFrame.unionByName, done) if done else spark.createDataFrame([], _MINED)
