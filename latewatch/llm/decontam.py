"""Benchmark decontamination over a distributed positional inverted index.

The index is partitioned by document: a shard holds consecutive documents of one
task (about ``SHARD_WORDS`` words; a longer document makes a longer shard) as a
dictionary of its distinct words, and for each word the sorted list of all its
positions in the shard.  Every word of every training document is posted, so one
written index serves any test set.

A search takes windows (word sequences) from the test items.  In each shard it
starts from the rarest word of a window, shifts that word's posting list by the
word's offset to get candidate starts, and intersects them with the other words'
offset-adjusted lists in order of rarity.  All windows of a block go through
each intersection together: postings are one sorted array of (word, position)
keys, so a step is one vectorised binary search.  Candidate starts are worked
through in bounded runs.  Words are compared as strings, never by hash, and no
document is shuffled.

Test sets are searched in blocks of at most ``BLOCK_BYTES`` text: each block's
size is known before it is broadcast.  Blocks are merged by document.

Words: A-Z lower-cased, ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``.  A window is
13 consecutive item words; an item of fewer words (but not none) is one window.
Null texts have no words; items with a null id or no words match nothing; items
that repeat an id are one item.  Rows that repeat a doc_id are judged apart.
Empty tables give empty results (an empty benchmark: nothing contaminated).
"""

from __future__ import annotations

import hashlib
import itertools
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import digest, frugal, raw, slices, without, written

WINDOW = 13
SHARD_WORDS = 1 << 20
#: Text of the test items that one broadcast holds at most (or one item).
BLOCK_BYTES = 16 << 20
#: Candidate starts that a task works through at once.
RUN = 1 << 20
#: Bytes of shards that the index's writer and readers hold at once (or one shard).
INDEX_BLOCK = 8 << 20
#: Bytes of a word to themselves (A-Z to a-z), all others to a space.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

INDEX = "uid long, n_words long, n_docs long, doc_ids array<long>, lengths binary, dictionary binary, ends binary, firsts binary, postings binary, digests array<binary>"


def words(text: bytes) -> list[bytes]:
    return text.translate(FOLD).split()


class Shard:
    """Postings of one shard: word number -> sorted positions."""

    def __init__(self, doc_ids, lengths: np.ndarray, dictionary: list[bytes], firsts: np.ndarray, postings: np.ndarray) -> None:
        self.doc_ids, self.lengths, self.dictionary, self.firsts, self.postings = doc_ids, lengths, dictionary, firsts, postings
        self.size = len(postings)

    @classmethod
    def build(cls, doc_ids: list, documents: list[np.ndarray], dictionary: list[bytes]) -> Shard:
        """documents: the word numbers of each."""
        lengths = np.array([len(d) for d in documents], np.int64)
        numbers = np.concatenate(documents) if documents else np.zeros(0, np.uint32)
        counts = np.bincount(numbers, minlength=len(dictionary))
        order = np.argsort(numbers, kind="stable").astype(np.uint32 if len(numbers) < 1 << 32 else np.uint64)
        return cls(doc_ids, lengths, dictionary, np.concatenate([[0], np.cumsum(counts)]).astype(np.int64), order)

    def row(self) -> list:
        ends = np.cumsum([len(w) for w in self.dictionary], dtype=np.int64)
        gaps = np.diff(self.postings, prepend=self.postings.dtype.type(0))  # small numbers, which the table's codec shortens
        return [self.size, len(self.doc_ids), self.doc_ids, self.lengths.tobytes(), b"".join(self.dictionary), ends.tobytes(), self.firsts.tobytes(),
                bytes([gaps.dtype.itemsize]) + gaps.tobytes()]

    @classmethod
    def of(cls, row: dict) -> Shard:
        ends, text = np.frombuffer(row["ends"], np.int64).tolist(), row["dictionary"]
        kind = np.uint32 if row["postings"][0] == 4 else np.uint64
        return cls(row["doc_ids"], np.frombuffer(row["lengths"], np.int64), [text[a:b] for a, b in zip([0, *ends], ends)],
                   np.frombuffer(row["firsts"], np.int64), np.cumsum(np.frombuffer(row["postings"], kind, offset=1), dtype=kind))

    def keys(self) -> np.ndarray:
        """All postings as sorted word * size + position."""
        number = np.repeat(np.arange(len(self.dictionary), dtype=np.int64), np.diff(self.firsts))
        return number * self.size + self.postings.astype(np.int64)

    def starts_end(self) -> np.ndarray:
        """For each position the end of its document."""
        return np.repeat(np.cumsum(self.lengths), self.lengths)


def _indexed(shard_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in INDEX.split(", ")]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), *[pa.binary()] * 5, pa.list_(pa.binary())]
        uid = TaskContext.get().partitionId() << 40  # of the shard's first document
        number = defaultdict(itertools.count().__next__)
        docs: list = []
        digests: list = []
        held: list[np.ndarray] = []
        size = 0

        def flush() -> pa.RecordBatch:
            nonlocal number, docs, digests, held, size, uid
            row = [uid, *Shard.build(docs, held, list(number)).row(), digests]
            uid += len(docs)
            number, docs, digests, held, size = defaultdict(itertools.count().__next__), [], [], [], 0
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names=names)

        for batch in batches:
            for part in slices(batch):
                for doc, text, key in zip(part.column("doc_id").to_pylist(), raw(part.column("text")), part.column("digest").to_pylist(), strict=True):
                    own = words(text)
                    held.append(np.fromiter(map(number.__getitem__, own), np.uint32, len(own)))
                    docs.append(doc)
                    digests.append(key)
                    size += len(own)
                    if size >= shard_words:
                        yield flush()
        if docs:
            yield flush()
    return run


def build_index(docs: DataFrame, shard_words: int = SHARD_WORDS, keyed: bool = False) -> DataFrame:
    """The written index of doc_id, text: one row a shard; ``keyed``: with the texts' digests."""
    key = digest() if keyed else F.lit(None).cast("binary")
    with frugal(docs.sparkSession):
        return written(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), key.alias("digest")).mapInArrow(_indexed(shard_words), INDEX), "postings", block=INDEX_BLOCK)


class TestBlock:
    """Distinct windows of some test items, with the items of each."""

    __test__ = False

    def __init__(self, items: list[tuple[int, bytes]], window: int = WINDOW) -> None:
        number = defaultdict(itertools.count().__next__)
        found: dict[tuple[int, ...], set[int]] = defaultdict(set)
        for item, text in items:
            own = [number[w] for w in words(text)]
            for i in range(max(1, len(own) - window + 1) if own else 0):
                found[tuple(own[i:i + window])].add(item)
        self.dictionary = list(number)
        self.lengths = np.array([len(w) for w in found], np.int64)
        self.words = np.zeros((len(found), int(self.lengths.max()) if found else 0), np.int64)
        for i, w in enumerate(found):
            self.words[i, :len(w)] = w
        self.items = [sorted(x) for x in found.values()]


def _candidates(shard: Shard, block: TestBlock) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the windows all of whose words the shard has, and the block's words as the shard's."""
    own = {w: i for i, w in enumerate(shard.dictionary)}
    mine = np.array([own.get(w, -1) for w in block.dictionary] + [-1], np.int64)
    at = mine[block.words] if len(block.words) else np.zeros((0, 0), np.int64)
    used = np.arange(at.shape[1])[None, :] < block.lengths[:, None]
    whole = np.flatnonzero(((at >= 0) | ~used).all(1)) if at.size else np.zeros(0, np.int64)
    return whole, at


def _runs(counts: np.ndarray) -> Iterator[np.ndarray]:
    """Consecutive windows whose posting lists hold at most RUN positions together (or one window)."""
    ends, at = np.cumsum(counts), 0
    while at < len(counts):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + RUN, side="right")))
        yield np.arange(at, to)
        at = to


def search(shard: Shard, block: TestBlock, slop: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(window, start) of every occurrence in the shard.

    With ``slop``: (window, position of its rarest word) wherever every word of
    the window occurs within ``slop`` positions of it in the same document.
    """
    whole, at = _candidates(shard, block)
    if not len(whole):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    counts = np.append(np.diff(shard.firsts), np.iinfo(np.int64).max)  # -1, beyond the window: last
    used = np.arange(at.shape[1])[None, :] < block.lengths[whole][:, None]
    at = np.where(used, at[whole], -1)
    order = np.argsort(counts[at], axis=1, kind="stable")
    keys, ends = shard.keys(), shard.starts_end()
    begins = ends - np.repeat(shard.lengths, shard.lengths)
    rarest = np.take_along_axis(at, order[:, :1], 1)[:, 0]
    out_w, out_p = [], []
    for rows in _runs(counts[rarest]):
        n = counts[rarest[rows]]
        w = np.repeat(rows, n)
        shift = np.repeat(shard.firsts[rarest[rows]] - (np.cumsum(n) - n), n)
        position = shard.postings[shift + np.arange(n.sum())].astype(np.int64)
        if slop is None:
            start = position - order[w, 0]
            keep = (start >= 0) & (start + block.lengths[whole][w] <= ends[position])
            keep &= ends[np.maximum(start, 0)] == ends[position]
            w, start = w[keep], start[keep]
        else:
            start = position
        for step in range(1, at.shape[1]):
            live = block.lengths[whole][w] > step
            if not live.any():
                break
            offset = order[w, step]
            word = at[w, offset]
            if slop is None:
                want = word * shard.size + start + offset
                place = np.searchsorted(keys, want[live])
                ok = np.ones(len(w), bool)
                ok[live] = (place < len(keys)) & (keys[np.minimum(place, len(keys) - 1)] == want[live])
            else:
                low = word * shard.size + np.maximum(start - slop, begins[start])
                high = word * shard.size + np.minimum(start + slop, ends[start] - 1)
                ok = ~live | (np.searchsorted(keys, high, side="right") > np.searchsorted(keys, low))
            w, start = w[ok], start[ok]
        out_w.append(whole[w])
        out_p.append(start)
    return np.concatenate(out_w), np.concatenate(out_p)


def _spans(start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The union of [start, stop) as separate spans."""
    order = np.argsort(start, kind="stable")
    start, reach = start[order], np.maximum.accumulate(stop[order])
    new = np.concatenate([[True], start[1:] > reach[:-1]]) if len(start) else np.zeros(0, bool)
    return start[new], reach[np.append(np.flatnonzero(new)[1:] - 1, len(start) - 1)] if len(start) else reach


def _document(shard: Shard, block: TestBlock) -> tuple[dict, dict]:
    """By document of the shard: hit spans (from the document's first word), and items."""
    w, start = search(shard, block)
    ends = np.cumsum(shard.lengths)
    of = np.searchsorted(ends, start, side="right")
    a, b = _spans(start, start + block.lengths[w]) if len(w) else (start, start)
    spans: dict[int, list] = defaultdict(list)
    home = np.searchsorted(ends, a, side="right")
    # spans of neighbouring documents may touch and so have run together
    for d, x, y in zip(home.tolist(), a.tolist(), b.tolist(), strict=True):
        while x < y:
            to = min(y, int(ends[d]))
            if x < to:
                spans[d].append((x - int(ends[d] - shard.lengths[d]), to - int(ends[d] - shard.lengths[d])))
            x, d = to, d + 1
    items: dict[int, set] = defaultdict(set)
    for pair in np.unique(of * max(1, len(block.items)) + w).tolist():
        items[pair // len(block.items)].update(block.items[pair % len(block.items)])
    return spans, items


FOUND = "uid long, doc_id long, digest binary, n_words long, spans array<struct<a:long,b:long>>, items array<long>"


def one_by_one(batch: pa.RecordBatch) -> Iterator[dict]:
    for i in range(batch.num_rows):
        yield batch.slice(i, 1).to_pylist()[0]


def _found(block, first: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))
        for batch in batches:
            for row in one_by_one(batch):
                shard = Shard.of(row)
                spans, items = _document(shard, block.value)
                say = [i for i in range(len(shard.doc_ids)) if first or i in items]
                yield pa.RecordBatch.from_arrays([
                    pa.array([row["uid"] + i for i in say], pa.int64()), pa.array([shard.doc_ids[i] for i in say], pa.int64()), pa.array([row["digests"][i] for i in say], pa.binary()), pa.array(shard.lengths[say] if say else [], pa.int64()),
                    pa.array([[{"a": a, "b": b} for a, b in spans.get(i, ())] for i in say], span),
                    pa.array([sorted(items.get(i, ())) for i in say], pa.list_(pa.int64()))], names=["uid", "doc_id", "digest", "n_words", "spans", "items"])
    return run


def blocks(items: DataFrame, limit: int = BLOCK_BYTES) -> Iterator[list[tuple[int, bytes]]]:
    """The test items in blocks of at most ``limit`` text bytes (or one item)."""
    held: list[tuple[int, bytes]] = []
    size = 0
    wanted = items.select(F.col("item_id").cast("long"), F.col("text").cast("string")).where("item_id is not null and text is not null")
    for row in wanted.toLocalIterator():
        text = row.text.encode()
        if held and size + len(text) > limit:
            yield held
            held, size = [], 0
        held.append((row.item_id, text))
        size += len(text)
    if held:
        yield held


def _searches(docs: DataFrame, items: DataFrame, window: int = WINDOW, limit: int = BLOCK_BYTES, shard_words: int = SHARD_WORDS, keyed: bool = False) -> tuple[DataFrame, list]:
    """The index, and the search for each block of the test items (without items: for an empty one)."""
    context, index, found = docs.sparkSession.sparkContext, build_index(docs, shard_words, keyed), []
    for held in blocks(items, limit):
        found.append(_found(context.broadcast(TestBlock(held, window)), not found))
    return index, found or [_found(context.broadcast(TestBlock([])), True)]


def _merged(index: DataFrame, searches: list) -> DataFrame:
    found = reduce(DataFrame.unionByName, [index.mapInArrow(search, FOUND) for search in searches])
    if len(searches) == 1:
        return found
    return found.groupBy("uid").agg(F.first("doc_id").alias("doc_id"), F.first("digest").alias("digest"), F.first("n_words").alias("n_words"), F.flatten(F.collect_list("spans")).alias("spans"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"))


def matches(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """uid, doc_id, digest, n_words, spans (hit words as [a, b)), items of every row of ``docs``.

    uid numbers the rows of the index; digest is null unless ``keyed``.
    """
    return _merged(*_searches(docs, items, **options))


def _judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n_hit, n_items, named = [], [], []
        for spans, items in zip(batch.column("spans").to_pylist(), batch.column("items").to_pylist(), strict=True):
            at = np.array([(s["a"], s["b"]) for s in spans], np.int64).reshape(-1, 2)
            a, b = _spans(at[:, 0], at[:, 1]) if len(at) else (at[:, 0], at[:, 1])
            n_hit.append(int((b - a).sum()))
            ids = sorted({str(i) for i in items})
            n_items.append(len(ids))
            named.append(hashlib.sha256(",".join(ids).encode()).hexdigest())
        words_ = batch.column("n_words").to_numpy(zero_copy_only=False)
        hit = np.array(n_hit, np.int64)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("digest"), batch.column("n_words"), pa.array(hit), pa.array(n_items, pa.int64()), pa.array(named, pa.string()), pa.array((hit > 0) & (20 * hit >= words_))],
                                         names=["doc_id", "digest", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"])


VERDICT = "doc_id long, digest binary, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"


def _verdicts(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    index, searches = _searches(docs, items, **options)
    if len(searches) == 1:  # found and judged by the same Python worker: a second one a task would stay in the executor's memory
        return index.mapInArrow(lambda batches: _judged(searches[0](batches)), VERDICT)
    return _merged(index, searches).mapInArrow(_judged, VERDICT)


def judge(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every row of ``docs``.

    Contaminated: a twentieth of the words or more lie in windows of test items.
    """
    return _verdicts(docs, items, **options).drop("digest")


def _near(block, slop: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in one_by_one(batch):
                shard = Shard.of(row)
                w, position = search(shard, block.value, slop)
                ends = np.cumsum(shard.lengths)
                of = np.searchsorted(ends, position, side="right")
                found = {(d, i) for d, x in zip(of.tolist(), w.tolist(), strict=True) for i in block.value.items[x]}
                yield pa.RecordBatch.from_arrays([pa.array([shard.doc_ids[d] for d, _ in found], pa.int64()), pa.array([i for _, i in found], pa.int64())], names=["doc_id", "item_id"])
    return run


def near(docs: DataFrame, items: DataFrame, slop: int, window: int = WINDOW, limit: int = BLOCK_BYTES) -> DataFrame:
    """Proximity matches: doc_id, item_id wherever the words of a window of the item
    all occur within ``slop`` positions of the window's rarest word."""
    spark, index, found = docs.sparkSession, build_index(docs), None
    for held in blocks(items, limit):
        own = index.mapInArrow(_near(spark.sparkContext.broadcast(TestBlock(held, window)), slop), "doc_id long, item_id long")
        found = own if found is None else found.unionByName(own)
    return spark.createDataFrame([], "doc_id long, item_id long") if found is None else found.distinct()


def clean(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with all their columns.

    Rows are told apart by doc_id and text: repeated and null ids take no other row along.
    """
    with frugal(docs.sparkSession):  # before any text is shuffled
        lost = written(_verdicts(docs, items, keyed=True, **options).where("contaminated").select("doc_id", "digest").distinct(), "contaminated")
    return without(docs, lost)
