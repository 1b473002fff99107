"""Substring dedup: words covered by a window of words that occurs more than once are removed.

A window is ``width`` consecutive words of one document; a word goes if any window over
it has a word sequence that starts anywhere else, too (judged on the input).

1. Every write task packs its documents into chunks of a few MB and writes them to one
   file (a table bucketed by ``place``, the task), so that what is found out about a chunk
   later is brought to it, and texts are never shuffled.
2. Count-min prefilter.  Each chunk turns its windows into cells of two sketch rows, whose
   widths follow the number of windows of the corpus (8 cells a window, in segments of fixed
   size).  A partition's sketch is its sorted cells with a mark where it hit one twice;
   per segment these merge into counters that saturate at two.  Equal windows hit equal cells,
   so a count is never too low: the answer, one bit a cell, tells which windows may be repeated.
3. Only those get a digest (BLAKE2b of the word sequence), dealt by digest and
   counted exactly; of each chunk a digest is sent once, so a passage that a third of all
   documents share costs a task no more than one entry a chunk.  The answers are bits, too.
   A digest is told apart by its 80 bits and its bucket, whose number grows with the data.
4. Each chunk drops the words of its repeated windows.

Words are runs of bytes other than space, tab, LF, VT, FF, CR, unchanged.  A null text counts
as empty; one without a whole window stays as it is.  Repeated rows are documents of their
own (their windows are repeated); ids may repeat or be null.  A very long text is a chunk
of its own.  An empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import brought, placed, written

WIDTH = 35
#: Text bytes of a chunk (one longer document goes whole).
CHUNK_BYTES = 4 << 20
#: Sketch rows; cells a window and row; cells of a segment.
DEPTH, CELLS, SEGMENT = 2, 8, 1 << 25
#: Digests that a counting task should get.
PER_BUCKET = 1 << 22
#: Bytes that are hashed at once; a longer word is hashed by itself.
RUN = 1 << 18

_U = np.uint64
_BYTE, _WORD = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F
_MIX = (_U(0xFF51AFD7ED558CCD), _U(0xC4CEB9FE1A85EC53))
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base^i and base^-i modulo 2^64 for i < n, at least."""
    if base not in _powers or len(_powers[base][0]) < n:
        size = max(n, RUN + 1)
        with np.errstate(over="ignore"):
            _powers[base] = tuple(np.cumprod(np.r_[_U(1), np.full(size - 1, _U(b))]) for b in (base, pow(base, -1, 1 << 64)))
    return _powers[base]


def _mixed(h: np.ndarray) -> np.ndarray:
    for m in _MIX:
        h = (h ^ (h >> _U(32))) * m
    return h ^ (h >> _U(29))


class Chunk:
    """The words and windows of some texts."""

    def __init__(self, texts: list[bytes], width: int = WIDTH) -> None:
        joined = [b" ".join(t.split()) for t in texts]
        self.n_words = np.array([t.count(b" ") + 1 if t else 0 for t in joined], np.int64)
        self.text = b"".join([t + b" " for t in joined if t])
        self.ends = np.flatnonzero(np.frombuffer(self.text, np.uint8) == 32)
        self.starts = np.r_[0, self.ends[:-1] + 1][:len(self.ends)]
        self.first = np.r_[0, np.cumsum(self.n_words)]  # a document's first word
        self.width = width
        whole = np.maximum(self.n_words - width + 1, 0)
        #: The word at which each window starts.
        self.windows = np.arange(whole.sum()) + np.repeat(self.first[:-1] - np.r_[0, np.cumsum(whole)[:-1]][:len(whole)], whole)

    def _word_hashes(self) -> np.ndarray:
        out, at, data = np.empty(len(self.ends), _U), 0, np.frombuffer(self.text, np.uint8)
        while at < len(out):
            base = self.starts[at]
            to = int(np.searchsorted(self.ends, base + RUN, side="right"))
            if to == at:  # a word longer than a run
                out[at] = int.from_bytes(hashlib.blake2b(self.text[base:self.ends[at]], digest_size=8).digest(), "little")
                at += 1
                continue
            there, back = _power(_BYTE, int(self.ends[to - 1] - base) + 1)
            part = data[base:self.ends[to - 1]].astype(_U) + _U(1)
            sums = np.r_[_U(0), np.cumsum(part * there[:len(part)])]
            a, b = self.starts[at:to] - base, self.ends[at:to] - base
            out[at:to] = (sums[b] - sums[a]) * back[a]
            at = to
        return _mixed(out)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of every window; equal sequences have equal ones."""
        words = self._word_hashes()
        there, back = _power(_WORD, len(words) + 1)
        sums = np.r_[_U(0), np.cumsum(words * there[:len(words)])]
        a = self.windows
        return _mixed((sums[a + self.width] - sums[a]) * back[a])

    def digests(self, chosen: np.ndarray) -> np.ndarray:
        """16 bytes for each of the chosen windows."""
        view, make = memoryview(self.text), hashlib.blake2b
        a, b = self.starts[self.windows[chosen]].tolist(), self.ends[self.windows[chosen] + self.width - 1].tolist()
        return np.frombuffer(b"".join([make(view[x:y], digest_size=16).digest() for x, y in zip(a, b, strict=True)]), np.uint8).reshape(-1, 16)

    def removed(self, repeated: np.ndarray) -> np.ndarray:
        """Which words the windows of that mask cover."""
        edge = np.zeros(len(self.ends) + 1, np.int64)
        at = self.windows[repeated]
        np.add.at(edge, at, 1)
        np.add.at(edge, at + self.width, -1)
        return np.cumsum(edge[:-1]) > 0

    def kept(self, gone: np.ndarray) -> list[bytes]:
        """The words of each text that are not gone, joined by a space."""
        out = []
        for lo, hi in zip(self.first[:-1].tolist(), self.first[1:].tolist(), strict=True):
            text = self.text[self.starts[lo]:self.ends[hi - 1]] if hi > lo else b""
            out.append(b" ".join(compress(text.split(b" "), (~gone[lo:hi]).tolist())) if gone[lo:hi].any() else text)
        return out


class Cells:
    """A chunk's cells of one sketch row, in order, cut at the segments."""

    def __init__(self, hashes: np.ndarray, row: int, segments: int) -> None:
        wide = _U(segments * SEGMENT)
        cell = (hashes if not row else _mixed(hashes + _U(row))) % wide
        self.cells, self.place, counts = np.unique(cell, return_inverse=True, return_counts=True)
        self.twice = counts > 1
        segment = (self.cells // _U(SEGMENT)).astype(np.int64)
        self.segments = segment[np.r_[True, segment[1:] != segment[:-1]]] if len(segment) else segment
        self.cuts = np.r_[np.searchsorted(segment, self.segments), len(segment)].astype(np.int64)

    def asks(self) -> Iterator[tuple[int, bytes, bytes]]:
        """segment, cells, marks."""
        for s, a, b in zip(self.segments.tolist(), self.cuts[:-1], self.cuts[1:]):
            yield s, packed((self.cells[a:b] - _U(s * SEGMENT)).astype(np.uint32)), np.packbits(self.twice[a:b]).tobytes()

    def answered(self, bits: dict[int, bytes]) -> np.ndarray:
        """Of every window: whether its cell was hit twice or more."""
        hit = [np.unpackbits(np.frombuffer(bits[s], np.uint8), count=int(b - a)) for s, a, b in zip(self.segments.tolist(), self.cuts[:-1], self.cuts[1:])]
        return np.concatenate([np.zeros(0, np.uint8), *hit]).astype(bool)[self.place]


def packed(cells: np.ndarray) -> bytes:
    """Rising uint32s as differences of as few bytes as the largest takes; the first byte tells how many."""
    steps = np.diff(cells, prepend=np.uint32(0))
    width = max(1, (int(steps.max()).bit_length() + 7) // 8)
    return bytes([width]) + steps.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :width].tobytes()


def unpacked(blob: bytes) -> np.ndarray:
    steps = np.frombuffer(blob, np.uint8, offset=1).reshape(-1, blob[0])
    out = np.zeros((len(steps), 4), np.uint8)
    out[:, :blob[0]] = steps
    return np.cumsum(out.view("<u4").ravel(), dtype=np.uint32)


class Digests:
    """A chunk's distinct digests in order of bucket and value."""

    def __init__(self, found: np.ndarray, buckets: int) -> None:
        column = lambda a, b, kind: np.ascontiguousarray(found[:, a:b]).view(kind).ravel()
        bucket, high, low = column(0, 4, "<u4") % np.uint32(buckets), column(4, 12, "<u8"), column(12, 14, "<u2")
        order = np.lexsort((low, high, bucket))
        key = [x[order] for x in (bucket, high, low)]
        new = np.ones(len(order), bool)
        new[1:] = np.logical_or.reduce([x[1:] != x[:-1] for x in key])
        self.place = np.empty(len(order), np.int64)
        self.place[order] = np.cumsum(new) - 1
        at = np.flatnonzero(new)
        self.twice = np.diff(np.r_[at, len(order)]) > 1
        bucket, self.high, self.low = (x[at] for x in key)
        self.buckets = bucket[np.r_[True, bucket[1:] != bucket[:-1]]].astype(np.int64) if len(bucket) else bucket
        self.cuts = np.r_[np.searchsorted(bucket, self.buckets), len(bucket)].astype(np.int64)

    def asks(self) -> Iterator[tuple[int, bytes, bytes]]:
        for s, a, b in zip(self.buckets.tolist(), self.cuts[:-1], self.cuts[1:]):
            yield s, self.high[a:b].tobytes() + self.low[a:b].tobytes(), np.packbits(self.twice[a:b]).tobytes()

    def answered(self, bits: dict[int, bytes]) -> np.ndarray:
        hit = [np.unpackbits(np.frombuffer(bits[s], np.uint8), count=int(b - a)) for s, a, b in zip(self.buckets.tolist(), self.cuts[:-1], self.cuts[1:])]
        return np.concatenate([np.zeros(0, np.uint8), *hit]).astype(bool)[self.place]


def _pack(chunk_bytes: int):
    """Documents in rows of about ``chunk_bytes``."""
    def row(ids: list, texts: list[bytes]) -> pa.RecordBatch:
        one = lambda values, kind: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values, kind))
        words = sum(len(t.split()) for t in texts)
        return pa.RecordBatch.from_arrays([one(ids, pa.int64()), one(texts, pa.binary()), pa.array([words], pa.int64())], names=["ids", "texts", "words"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, held = [], [], 0
        for batch in batches:
            for i, text in zip(batch.column("doc_id"), batch.column("text"), strict=True):
                ids.append(i.as_py())
                texts.append(text.as_py() or b"")
                held += len(texts[-1])
                if held >= chunk_bytes:
                    yield row(ids, texts)
                    ids, texts, held = [], [], 0
        if ids:
            yield row(ids, texts)
    return run


def chunks(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """place, chunk, ids, texts, words: the documents in chunks, one file a write task."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))
    return placed(rows.mapInArrow(_pack(chunk_bytes), "ids array<long>, texts array<binary>, words long"), "chunks", 4 * chunk_bytes)


_ASK = "place int, chunk long, part int, bucket int, blob binary, twice binary"
_ASK_TYPES = (pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary())


def _asked(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * 6
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _ASK_TYPES, strict=True)], names=["place", "chunk", "part", "bucket", "blob", "twice"])


def _each(batch: pa.RecordBatch) -> Iterator[dict]:
    for i in range(batch.num_rows):
        yield {n: batch.column(n)[i].values.to_pylist() if n in ("ids", "texts") else batch.column(n)[i].as_py() for n in batch.schema.names}


def _bits(answers: list[dict] | None, part: int) -> dict[int, bytes]:
    return {x["bucket"]: x["bits"] for x in answers or () if x["part"] == part}


def _maybe(found: Chunk, answers: list[dict], segments: int) -> np.ndarray:
    """The windows that every sketch row says may be repeated."""
    hashes, out = found.hashes(), np.ones(len(found.windows), bool)
    for row in range(DEPTH):
        out &= Cells(hashes, row, segments).answered(_bits(answers, row))
    return np.flatnonzero(out)


def _sketch(width: int, segments: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in _each(batch):
                hashes = Chunk(r["texts"], width).hashes()
                for row in range(DEPTH):
                    yield _asked([(r["place"], r["chunk"], row, *ask) for ask in Cells(hashes, row, segments).asks()])
    return run


def _digest(width: int, segments: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in _each(batch):
                found = Chunk(r["texts"], width)
                maybe = _maybe(found, r["answers"], segments)
                yield _asked([(r["place"], r["chunk"], DEPTH, *ask) for ask in Digests(found.digests(maybe), buckets).asks()])
    return run


def _remove(width: int, segments: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in _each(batch):
                found = Chunk(r["texts"], width)
                maybe = _maybe(found, r["answers"], segments)
                repeated = maybe[Digests(found.digests(maybe), buckets).answered(_bits(r["more"], DEPTH))]
                gone = found.removed(repeated)
                n_gone = np.diff(np.r_[0, np.cumsum(gone)][found.first])
                yield pa.RecordBatch.from_arrays([pa.array(r["ids"], pa.int64()), pa.array(found.kept(gone), pa.binary()), pa.array(found.n_words),
                                                  pa.array(n_gone, pa.int64())], names=["doc_id", "text", "n_words", "n_removed"])
    return run


def _merged_sketch(asks: pa.Table) -> pa.Table:
    """The counters of one segment, saturating at two; a bit for each cell that was sent."""
    counts = np.zeros(SEGMENT, np.uint8)
    blobs, twice = asks.column("blob").to_pylist(), asks.column("twice").to_pylist()
    for blob, marks in zip(blobs, twice, strict=True):
        cells = unpacked(blob)
        counts[cells] = np.minimum(counts[cells] + 1 + np.unpackbits(np.frombuffer(marks, np.uint8), count=len(cells)), 2)
    return _answers(asks, [np.packbits(counts[unpacked(b)] > 1) for b in blobs])


def _counted_digests(asks: pa.Table) -> pa.Table:
    """Which of a bucket's digests are of more than one window."""
    blobs, twice = asks.column("blob").to_pylist(), asks.column("twice").to_pylist()
    sizes = [len(b) // 10 for b in blobs]
    high = np.concatenate([np.frombuffer(b, "<u8", n) for b, n in zip(blobs, sizes, strict=True)])
    low = np.concatenate([np.frombuffer(b, "<u2", n, 8 * n) for b, n in zip(blobs, sizes, strict=True)])
    marks = np.concatenate([np.unpackbits(np.frombuffer(m, np.uint8), count=n) for m, n in zip(twice, sizes, strict=True)])
    order = np.lexsort((low, high))
    h, w = high[order], low[order]
    at = np.flatnonzero(np.r_[True, (h[1:] != h[:-1]) | (w[1:] != w[:-1])])
    runs = np.diff(np.r_[at, len(order)])
    many = np.empty(len(order), bool)
    many[order] = np.repeat((runs > 1) | (np.maximum.reduceat(marks[order], at) > 0), runs)
    return _answers(asks, [np.packbits(x) for x in np.split(many, np.cumsum(sizes)[:-1])])


def _answers(asks: pa.Table, bits: list[np.ndarray]) -> pa.Table:
    out = asks.select(["place", "chunk", "part", "bucket"]).append_column("bits", pa.array([b.tobytes() for b in bits], pa.binary()))
    return out.append_column("hits", pa.array([int(np.bitwise_count(b).sum()) for b in bits], pa.int64()))


_ANSWER = "place int, chunk long, part int, bucket int, bits binary, hits long"


def remove_repeats(docs: DataFrame, width: int = WIDTH, per_bucket: int = PER_BUCKET, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """doc_id, text (the words that stay, joined by a space), n_words, n_removed of every row of ``docs``."""
    packs = chunks(docs, chunk_bytes)
    words = packs.agg(F.sum("words")).first()[0] or 0
    segments = max(1, -(-words * CELLS // SEGMENT))
    asks = packs.select("place", "chunk", "texts").mapInArrow(_sketch(width, segments), _ASK)
    cells = written(asks.groupBy("part", "bucket").applyInArrow(_merged_sketch, _ANSWER), "cells")
    maybe = cells.where("part = 0").agg(F.sum("hits")).first()[0] or 0
    buckets = max(1, -(-maybe // per_bucket))
    asks = brought(packs.select("place", "chunk", "texts"), cells, "answers").select("place", "chunk", "texts", "answers").mapInArrow(_digest(width, segments, buckets), _ASK)
    counted = written(asks.groupBy("bucket").applyInArrow(_counted_digests, _ANSWER), "counted")
    both = brought(brought(packs, cells, "answers"), counted, "more")
    kept = both.select("ids", "texts", "answers", "more").mapInArrow(_remove(width, segments, buckets), "doc_id long, text binary, n_words long, n_removed long")
    return kept.withColumn("text", F.col("text").cast("string"))
