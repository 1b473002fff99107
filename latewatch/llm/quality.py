"""Quality by nearest-neighbour voting over latent-semantic vectors.

A text's terms are its words (A-Z lower-cased), their shapes (letters by case, digits,
other marks; runs as one), how often a word repeats the one before, and how many there
are; weights are log term frequency times inverse document frequency over all documents.
The labelled training rows whose ids hash lowest (``LABELLED`` at most) are the sample.
The words and shapes found in most of its texts, ``TERMS`` of them at most and each in two
or more, get a column each; they are known by their 64-bit XXH64, and a term without a
column counts for nothing.  The leading singular vectors of the sample's sparse matrix span
the latent space.  Space, sample vectors and labels are broadcast (TERMS and LABELLED times
RANK numbers); every document's cosine with every one of them is computed exactly in
blocks, and the ``NEIGHBOURS`` nearest vote with the fourth power of their similarity.
Similarities count to ``GRID``; of equal ones the earlier in the sample's hash order is
the nearer, and rows of one id in the order of their terms.

A null or empty text, or one whose vector is zero, is near to none; it scores the
sample's share of label 1.  Without labelled rows every score is 0.  Null ids count
as the empty string in the split; null labels are not learnt from, and where label
rows for an id differ the highest counts.  Repeated rows are scored each; other
columns are not read; texts of any length are handled whole; an empty table gives an
empty result.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import raw, slices, written
from .langid import held_out

TERMS, LABELLED, RANK, NEIGHBOURS = 1 << 15, 4096, 64, 31
GRID = 2.0 ** -20
THRESHOLD = 0.3
#: Texts, and entries of a sparse matrix, that one step takes.
BLOCK, STEP = 512, 1 << 17
SHAPE = bytes(65 if 65 <= b <= 90 else 97 if 97 <= b <= 122 or b >= 128 else 48 if 48 <= b <= 57 else b for b in range(256))
_RUN = re.compile(rb"(.)\1+", re.DOTALL)


class Keys(dict):
    """Word -> the 64-bit keys of its word term and its shape term, one after the other; forgets all when it holds ``most``."""

    def __init__(self, most: int = 200_000) -> None:
        self.most = most

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= self.most:
            self.clear()
        self[word] = found = xxhash.xxh64_digest(b"w" + word.lower()) + xxhash.xxh64_digest(b"s" + _RUN.sub(rb"\1", word.translate(SHAPE)))
        return found

    def of(self, words: Iterable[bytes]) -> np.ndarray:
        return np.frombuffer(b"".join(map(self.__getitem__, words)), ">u8").astype(np.uint64).reshape(-1, 2)


class Rows:
    """Sparse rows: counts by row and column, in that order."""

    def __init__(self, n: int, row: np.ndarray, col: np.ndarray, count: np.ndarray) -> None:
        self.n, self.row, self.col, self.value = n, row, col, np.log1p(count).astype(np.float32)

    @staticmethod
    def _sums(n: int, to: np.ndarray, at: np.ndarray, value: np.ndarray, dense: np.ndarray) -> np.ndarray:
        """Sums by ``to`` (ascending, below n) of value * dense[at]."""
        out = np.zeros((n, dense.shape[1]), np.float32)
        for lo in range(0, len(to), STEP):
            some = slice(lo, lo + STEP)
            first = np.flatnonzero(np.r_[True, to[some][1:] != to[some][:-1]])
            out[to[some][first]] += np.add.reduceat(value[some, None] * dense[at[some]], first)
        return out

    def times(self, dense: np.ndarray) -> np.ndarray:
        return self._sums(self.n, self.row, self.col, self.value, dense)

    def weighted(self, idf: np.ndarray) -> tuple[Callable, Callable]:
        """Products with the matrix whose values are weighted and whose rows have length 1, and with its transpose."""
        value = self.value * idf[self.col]
        value /= np.maximum(np.sqrt(np.bincount(self.row, value * value, self.n)), 1e-12)[self.row].astype(np.float32)
        order = np.argsort(self.col, kind="stable")
        turned = self.col[order], self.row[order], value[order]
        return lambda d: self._sums(self.n, self.row, self.col, value, d), lambda d: self._sums(len(idf), *turned, d)


def counted(texts: pa.Array, keys: Keys, columns: np.ndarray) -> Rows:
    """The texts' counts by column: of each key of ``columns`` (ascending), then repeats, then words."""
    cut = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    coded = cut.flatten().dictionary_encode()
    at = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    of = np.repeat(np.arange(len(texts)), np.diff(cut.offsets.to_numpy()))
    words = coded.dictionary.cast(pa.binary()).to_pylist()
    if b"" in words:  # beside leading or trailing white space
        some = at != words.index(b"")
        at, of = at[some], of[some]
    n = np.bincount(of, minlength=len(texts))
    width = len(columns) + 2
    found = []
    if len(columns) and words:
        wanted = keys.of(words)
        place = np.minimum(np.searchsorted(columns, wanted), len(columns) - 1)
        place = np.where(columns[place] == wanted, place, -1)
        for kind in (0, 1):
            col = place[at, kind]
            found.append((of * width + col)[col >= 0])
    cell, count = np.unique(np.concatenate([*found, np.zeros(0, np.int64)]), return_counts=True)
    again = np.bincount(of[1:][(at[1:] == at[:-1]) & (of[1:] == of[:-1])], minlength=len(texts))
    for col, own in ((width - 2, again), (width - 1, n)):
        cell, count = np.concatenate([cell, np.flatnonzero(own) * width + col]), np.concatenate([count, own[own > 0]])
    order = np.argsort(cell, kind="stable")
    return Rows(len(texts), cell[order] // width, cell[order] % width, count[order])


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct term keys of each text."""
    keys = Keys()
    for batch in batches:
        for part in slices(batch):
            for text in raw(part.column("text")):
                yield pa.RecordBatch.from_arrays([pa.array(np.unique(keys.of(set(text.split()))).view(np.int64))], names=["term"])


def columns(sample: DataFrame) -> np.ndarray:
    """The keys of the terms that get a column, ascending."""
    found = sample.select("text").mapInArrow(_terms, "term long").groupBy("term").agg(F.count("*").alias("n")).where("n > 1")
    found = found.orderBy(F.desc("n"), "term").limit(TERMS).toPandas()["term"]
    return np.sort(found.to_numpy(np.int64).view(np.uint64))


def _blocks(part: pa.RecordBatch, keys: Keys, cols: np.ndarray) -> Iterator[tuple[int, Rows]]:
    for at in range(0, part.num_rows, BLOCK):
        yield at, counted(part.column("text").slice(at, BLOCK), keys, cols)


def _seen(cols: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, found, keys = 0, np.zeros(len(cols) + 2, np.int64), Keys()
        for batch in batches:
            for part in slices(batch):
                for _, rows in _blocks(part, keys, cols):
                    n += rows.n
                    found += np.bincount(rows.col, minlength=len(found))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, len(found))), pa.array(np.concatenate([[n], found]))], names=["term", "n"])
    return run


def inverse_frequencies(docs: DataFrame, cols: np.ndarray) -> np.ndarray:
    """ln((1 + documents) / (1 + documents with the term)) + 1, over all rows."""
    found = docs.select("text").mapInArrow(_seen(cols), "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).orderBy("term").toPandas()["n"].to_numpy(np.float64)
    if not len(found):
        return np.ones(len(cols) + 2, np.float32)
    return (np.log((1 + found[0]) / (1 + found[1:])) + 1).astype(np.float32)


def _sparse(cols: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = Keys()
        for batch in batches:
            for part in slices(batch):
                for at, rows in _blocks(part, keys, cols):
                    cuts = np.searchsorted(rows.row, np.arange(1, rows.n))
                    own = part.slice(at, rows.n)
                    packed = [pa.array([x.astype(t).tobytes() for x in np.split(v, cuts)], pa.binary()) for v, t in ((rows.col, "<i4"), (np.rint(np.expm1(rows.value.astype(np.float64))), "<i4"))]
                    yield pa.RecordBatch.from_arrays([own.column("doc_id"), own.column("quality"), *packed], names=["doc_id", "quality", "cols", "counts"])
    return run


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def votes(near: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row's share of label 1 among its nearest columns, and whether there is one; of equal similarities the first columns count."""
    near = np.rint(near / GRID) * GRID
    k = min(NEIGHBOURS, near.shape[1])
    last = np.partition(near, -k, axis=1)[:, -k:-k + 1 or None] if k < near.shape[1] else near.min(1, keepdims=True)
    above, equal = near > last, near == last
    chosen = above | (equal & (np.cumsum(equal, axis=1, dtype=np.int32) <= k - above.sum(1, keepdims=True)))
    weight = np.where(chosen, np.maximum(near, 0).astype(np.float64) ** 4, 0.0)
    total = weight.sum(1)
    return weight @ labels / np.maximum(total, 1e-30), total > 0


class Voters:
    """The latent space, and the labelled vectors in it."""

    def __init__(self, cols: np.ndarray, idf: np.ndarray, rows: Rows, labels: np.ndarray) -> None:
        self.cols, self.keys = cols, Keys()
        self.share = float(labels.mean(dtype=np.float64)) if len(labels) else 0.0
        self.labels = labels.astype(np.float64)
        self.space = np.zeros((len(idf), 1), np.float32)
        if rows.n:
            # leading right singular vectors, by subspace iteration from a fixed start, a little wider than wanted
            times, turned = rows.weighted(idf)
            basis = np.random.default_rng(0).standard_normal((len(idf), min(RANK + 16, rows.n, len(idf)))).astype(np.float32)
            for _ in range(3):
                basis = np.linalg.qr(turned(times(basis)))[0]
            turn = np.linalg.svd(times(basis), full_matrices=False)[2]
            self.space = (idf[:, None] * (basis @ turn.T[:, :RANK])).astype(np.float32)
        self.vectors = _unit(rows.times(self.space))

    def score(self, texts: pa.Array) -> np.ndarray:
        out = np.full(len(texts), self.share)
        for at in range(0, len(texts), BLOCK) if len(self.labels) else ():
            mine = counted(texts.slice(at, BLOCK), self.keys, self.cols).times(self.space)
            vote, some = votes(_unit(mine) @ self.vectors.T, self.labels)
            some &= np.linalg.norm(mine, axis=1) > 1e-6
            out[at:at + BLOCK][some] = vote[some]
        return np.clip(out, 0, 1)


def fit(docs: DataFrame, labels: DataFrame) -> Voters:
    """The voters: labelled rows that are not held out, LABELLED of them at most."""
    order = F.xxhash64("doc_id")
    chosen = labels.where(F.col("quality").isNotNull() & ~held_out(parts=5, part=0)).groupBy("doc_id").agg(F.max("quality").alias("quality")).orderBy(order).limit(LABELLED)
    chosen = F.broadcast(chosen.withColumnRenamed("doc_id", "__id"))  # LABELLED rows at most
    sample = written(docs.join(chosen, docs["doc_id"] == chosen["__id"]).select("doc_id", "text", "quality"), "quality-sample")
    cols = columns(sample)
    found = sample.mapInArrow(_sparse(cols), "doc_id long, quality int, cols binary, counts binary").orderBy(order, "cols", "counts", "quality").limit(LABELLED).toPandas()
    parts = [[np.frombuffer(x, "<i4").astype(np.int64) for x in found[c]] for c in ("cols", "counts")]
    col, count = (np.concatenate([*p, np.zeros(0, np.int64)]) for p in parts)
    rows = Rows(len(found), np.repeat(np.arange(len(found)), [len(x) for x in parts[0]]), col, count)
    return Voters(cols, inverse_frequencies(docs, cols), rows, found["quality"].to_numpy(np.float32))


def _scored(voters):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                score = voters.value.score(part.column("text"))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("held_out"), pa.array(score), pa.array((score >= THRESHOLD).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])
    return run


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of ``docs``; labels: doc_id, quality."""
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    voters = docs.sparkSession.sparkContext.broadcast(fit(docs, labels.select(F.col("doc_id").cast("long"), F.col("quality").cast("int"))))
    return docs.withColumn("held_out", held_out(parts=5, part=0)).mapInArrow(_scored(voters), "doc_id long, held_out boolean, score double, predicted int")
