"""Toxicity by class-conditional Kneser-Ney models.

One word-pair model for toxic texts and one for ordinary ones.  A class's pair
counts, discounted, back off to the pair model of both classes together (itself
Kneser-Ney: discounted pairs over continuation counts, in how many pairs a word
comes second), moved by how far the class's own continuation count of the word
departs from its share.  Expressions rare in either class so rest on the shared
counts and tell little; common ones tell by their own.  A text's
evidence is the difference of its two log-likelihoods by word, over the whole text
and over its most telling passage of ``SPAN`` words; a logistic curve turns the two into the score.  It is fitted on at
most ``CURVE_ROWS`` training rows, by models that have not seen those.

The counts that score come from all labelled training rows, by class and pair of words (their 64-bit
XXH64), and are learnt and used in one go, so that neither the texts nor the pairs are written as rows:

1. Every write task packs its documents, as numbered words, into one file (see ``placed``).  Labels come to their packs.
2. A pack sends its distinct pairs once, as sorted 64-bit keys squeezed to their differences, with what its
   own training rows count.  A bucket of keys adds these up and answers each pack in the order asked.
   Buckets take turns in ``ROUNDS``, so only a part of the keys is on disk at a time.
3. Of the packs that count a pair, one is told so; it counts the pair for its words.  Words are asked for and answered likewise.
4. The evidence of a pack follows from the counts that came back.

The counts of the curve's rows travel apart from the rest, so the models for the curve come from the same answers.
``pair_counts``, ``weights`` and ``evidence`` do the same with a written table of the evidence of every word
and pair, for texts that come later: chunks of at most ``CHUNK`` text bytes ask it through a shuffle.

A null or empty text has no evidence and scores what the curve gives for none.
Null ids count as the empty string in the split; null labels are not learnt from,
and where label rows for an id differ the highest counts.  Without labelled rows of
both classes every score is 0.  Repeated rows count as often as they occur; other
columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import itertools
from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import brought_from, frugal, placed, raw, settled, slices, written
from .langid import held_out

#: Text bytes that are scored together by a stored table.
CHUNK = 4 << 20
#: Text bytes of a pack, whose distinct words and pairs ask together (one longer document goes whole).
PACK = 10 << 20
#: Pairs, and words, are counted in so many rounds; the shuffle of one is gone before the next.
ROUNDS, WORD_ROUNDS = 4, 2
#: Words of a pack whose evidence is worked out at once.
STEP = 1 << 19
#: Word places of all packs for each bucket of keys.
PER_BUCKET = 1 << 21
DISCOUNT = 0.75
#: Pseudo-counts of the shared models in a class's words and contexts.
SHARED, SHARED_PAIRS = 8.0, 200.0
SPAN = 2
#: Training rows, at most, that the curve is fitted on: those whose ids hash lowest.
CURVE_ROWS = 20_000
THRESHOLD = 0.3
#: A-Z to a-z; letters, digits and other scripts make words.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def numbered(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The number of each word among the distinct ones, how many words each text has, and the distinct words' hashes (never 0)."""
    number = defaultdict(itertools.count().__next__)
    split = (t.translate(FOLD).split() for t in texts)
    found = [np.fromiter(map(number.__getitem__, ws), np.int32, len(ws)) for ws in split]
    n = np.fromiter(map(len, found), np.int64, len(found))
    at = np.concatenate([np.zeros(0, np.int64), *found])
    ids = np.fromiter(map(xxhash.xxh64_intdigest, number), np.uint64, len(number)).view(np.int64)
    return at, n, np.where(ids == 0, 1, ids)


def cells(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all words, and how many each text has."""
    at, n, ids = numbered(texts)
    return ids[at], n


def _inside(n: np.ndarray) -> np.ndarray:
    """Places of all words but each text's first."""
    of = np.repeat(np.arange(len(n)), n)
    return np.flatnonzero(of[1:] == of[:-1]) + 1


LOW = (1 << 31) - 1


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch):
            toxic = part.column("toxic").to_numpy(zero_copy_only=False).astype(np.int64)
            at, n, ids = numbered(raw(part.column("text")))
            later = _inside(n)
            key, count = np.unique(np.repeat(toxic, n)[later] << 62 | at[later - 1] << 31 | at[later], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array((key >> 62).astype(np.int32)), pa.array(ids[key >> 31 & LOW]), pa.array(ids[key & LOW]), pa.array(count.astype(np.int64))], names=["toxic", "first", "second", "n"])


def pair_counts(rows: DataFrame) -> DataFrame:
    """toxic, first, second, n: the counts of word pairs by class over all rows of text, toxic."""
    found = rows.select(F.col("text").cast("string"), F.col("toxic").cast("int")).mapInArrow(_counted, "toxic int, first long, second long, n long")
    return found.groupBy("toxic", "first", "second").agg(F.sum("n").alias("n"))


def word_counts(counts: DataFrame) -> DataFrame:
    """word, and of each class: how often it comes first, in how many pairs, and in how many it comes second."""
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    sides = F.array(F.struct(F.col("first").alias("word"), F.col("n").alias("before"), one.alias("types"), zero.alias("after")),
                    F.struct(F.col("second").alias("word"), zero.alias("before"), zero.alias("types"), one.alias("after")))
    sums = [F.sum(F.when(F.col("toxic") == c, F.col(x)).otherwise(zero)).alias(f"{x}{c}") for x in ("before", "types", "after") for c in (0, 1)]
    return counts.select("toxic", F.inline(sides)).groupBy("word").agg(*sums)


def weights(counts: DataFrame) -> DataFrame | None:
    """first, second, x, y, written; None without counts of both classes.

    Of a word (second is 0): what it tells as the second of any pair, and as the first of a
    pair not counted.  Of a counted pair: what it tells beyond these two, and 0.
    """
    words = written(word_counts(counts), "words")
    size, *totals = words.agg(F.count("*"), F.sum("before0"), F.sum("before1"), F.sum("after0"), F.sum("after1")).first()
    if not (size and totals[0] and totals[1]):
        return None
    total = [float(t) for t in totals[2:]]
    shared = F.col("after0") + F.col("after1")

    def departs(c: int) -> Column:  # of the class's continuation count from its share
        return (F.col(f"after{c}") + SHARED) / (shared * (total[c] / sum(total)) + SHARED)

    def mass(c: int) -> Column:
        return F.least(DISCOUNT * F.col(f"types{c}"), F.col(f"before{c}").cast("double")) + SHARED_PAIRS

    back = [F.log(mass(c) / (F.col(f"before{c}") + SHARED_PAIRS)) for c in (0, 1)]
    alone = words.select(F.col("word").alias("first"), F.lit(0).cast("long").alias("second"), F.log(departs(1) / departs(0)).alias("x"), (back[1] - back[0]).alias("y"))
    as_first = words.select(F.col("word").alias("first"), mass(0).alias("mass0"), mass(1).alias("mass1"), (F.col("types0") + F.col("types1")).alias("kinds"), (F.col("before0") + F.col("before1")).alias("n"))
    as_second = words.select(F.col("word").alias("second"), departs(0).alias("departs0"), departs(1).alias("departs1"), ((shared + 1) / (sum(total) + size)).alias("single"))
    pairs = counts.groupBy("first", "second").agg(*[F.sum(F.when(F.col("toxic") == c, F.col("n")).otherwise(0)).alias(f"p{c}") for c in (0, 1)])
    # merge joins at every size; Spark splits the pairs of a word that begins or ends many
    pairs = pairs.join(as_first.hint("merge"), "first").join(as_second.hint("merge"), "second")
    # what both share: Kneser-Ney over the counts of the two together
    both = (F.greatest(F.col("p0") + F.col("p1") - DISCOUNT, F.lit(0.0)) + DISCOUNT * F.col("kinds") * F.col("single")) / F.col("n")
    own = [F.log1p(F.greatest(F.col(f"p{c}") - DISCOUNT, F.lit(0.0)) / (F.col(f"mass{c}") * both * F.col(f"departs{c}"))) for c in (0, 1)]
    pairs = pairs.select("first", "second", (own[1] - own[0]).alias("x"), F.lit(0.0).alias("y"))
    return written(alone.unionByName(pairs), "weights")


def _chunked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    chunk = TaskContext.get().partitionId() << 33
    for batch in batches:
        for part in slices(batch, limit=CHUNK):
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array([chunk] * part.num_rows, pa.int64())], names=[*part.schema.names, "chunk"])
            chunk += 1


def _asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct words (second is 0) and pairs of each chunk."""
    for batch in batches:
        numbers = batch.column("chunk").to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(numbers[1:] != numbers[:-1]) + 1).tolist(), len(numbers)]
        for lo, hi in zip(cuts, cuts[1:]):
            if lo < hi:
                at, n, ids = numbered(raw(batch.column("text").slice(lo, hi - lo)))
                later = _inside(n)
                key = np.unique(at[later - 1] << 31 | at[later])
                first, second = np.concatenate([ids, ids[key >> 31]]), np.concatenate([np.zeros(len(ids), np.int64), ids[key & LOW]])
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(first), numbers[lo])), pa.array(first), pa.array(second)], names=["chunk", "first", "second"])


def _looked_up(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The value of each wanted key; 0 where there is none."""
    if not len(keys):
        return np.zeros(len(wanted))
    order = np.argsort(keys, kind="stable")
    keys, values = keys[order], values[order]
    place = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[place] == wanted, values[place], 0.0)


def told(texts: list[bytes], first: np.ndarray, second: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Two numbers a text: mean log-likelihood difference, whole and in the most telling passage.

    first, second, x, y: the rows of ``weights`` for the texts' words and pairs.
    """
    at, n, ids = numbered(texts)
    if not len(at):
        return np.zeros((len(texts), 2))
    word = second == 0
    as_second, as_first = (_looked_up(first[word], v[word], ids) for v in (x, y))
    order = np.argsort(ids, kind="stable")
    number = lambda h: order[np.searchsorted(ids[order], h)]
    later = _inside(n)
    pair = _looked_up(number(first[~word]) << 31 | number(second[~word]), x[~word], at[later - 1] << 31 | at[later])
    difference = as_second[at]
    difference[later] += as_first[at[later - 1]] + pair
    return _passages(difference, n)


def _passages(difference: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Of each text, whose n words tell ``difference``: the mean over all, and over the most telling passage."""
    out = np.zeros((len(n), 2))
    some = n > 0
    if not some.any():
        return out
    n = n[some]
    starts = np.cumsum(n) - n
    out[some, 0] = np.add.reduceat(difference, starts) / n
    # passages of SPAN words (or the whole of a shorter text) that end at each word
    run = np.concatenate([[0], np.cumsum(difference)])
    place, length = np.arange(len(difference)), np.repeat(np.minimum(SPAN, n), n)
    whole = place + 1 - np.repeat(starts, n) >= length
    mean = np.where(whole, (run[place + 1] - run[np.maximum(place + 1 - length, 0)]) / length, -np.inf)
    out[some, 1] = np.maximum.reduceat(mean, starts)
    return out


def evidence(docs: DataFrame, table: DataFrame | None) -> DataFrame:
    """The columns of ``docs`` but text, and whole, passage (see ``told``)."""
    keep = [c for c in docs.columns if c != "text"]
    if table is None:
        return docs.select(*keep, F.lit(0.0).alias("whole"), F.lit(0.0).alias("passage"))
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in docs.schema.fields)
    chunks = written(docs.mapInArrow(_chunked, f"{fields}, chunk long"), "chunks")
    found = chunks.select("chunk", "text").mapInArrow(_asked, "chunk long, first long, second long").join(table.hint("merge"), ["first", "second"])

    def run(texts: pa.Table, found: pa.Table) -> pa.Table:
        got = told(raw(texts.column("text")), *[found.column(c).to_numpy() for c in ("first", "second", "x", "y")])
        return pa.table([*[texts.column(c) for c in keep], pa.array(got[:, 0]), pa.array(got[:, 1])], names=[*keep, "whole", "passage"])

    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in docs.schema.fields if f.name != "text")
    return chunks.groupBy("chunk").cogroup(found.groupBy("chunk")).applyInArrow(run, f"{kept}, whole double, passage double")


class Curve:
    """Logistic regression on standardised evidence."""

    def __init__(self, x: np.ndarray, y: np.ndarray, rounds: int = 30) -> None:
        self.ready = len(set(y.tolist())) == 2
        if not self.ready:
            return
        self.mean, self.scale = x.mean(0), x.std(0) + 1e-9
        z = np.column_stack([(x - self.mean) / self.scale, np.ones(len(x))])
        w = np.zeros(z.shape[1])
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
            h = (z * (p * (1 - p))[:, None]).T @ z + 1e-2 * np.eye(len(w))
            w += np.linalg.solve(h, z.T @ (y - p) - 1e-2 * w)
        self.w = w

    def __call__(self, x: np.ndarray) -> np.ndarray:
        if not self.ready:
            return np.zeros(len(x))
        return 1 / (1 + np.exp(-np.clip(np.column_stack([(x - self.mean) / self.scale, np.ones(len(x))]) @ self.w, -30, 30)))


def labelled(docs: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    """The rows of ``docs`` whose doc_id has a label, with it."""
    given = labels.where(F.col(label).isNotNull()).groupBy(F.col("doc_id").cast("long").alias("__id")).agg(F.max(F.col(label).cast("int")).alias(label))
    given = given.hint("merge")  # the same plan at every size: label tables outgrow a broadcast
    return docs.join(given, docs["doc_id"] == given["__id"]).select(*docs.columns, label)


def split(rows: DataFrame) -> DataFrame:
    """``rows`` with ``curve``: whether the row is one of those for the curve.

    Those are at most ``CURVE_ROWS`` of a fifth of the rows: whose ids hash lowest.
    """
    part = F.pmod(F.xxhash64("doc_id"), F.lit(5)) == 0
    place = F.xxhash64(F.lit(7), "doc_id")
    n, last = rows.where(part).select(place.alias("place")).orderBy("place").limit(CURVE_ROWS + 1).agg(F.count("*"), F.max("place")).first()
    if n > CURVE_ROWS:
        part &= place < last
    return rows.withColumn("curve", part)


def squeezed(values: np.ndarray) -> bytes:
    """Whole numbers from 0 on, in the fewest bytes, plane by plane: equal bytes cost little."""
    values = values.ravel()
    values = values.astype(np.min_scalar_type(int(values.max()) if len(values) else 0))
    planes = values.view(np.uint8).reshape(-1, values.itemsize).T
    return len(values).to_bytes(8, "little") + bytes([values.itemsize]) + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unsqueezed(blob: bytes) -> np.ndarray:
    """The numbers, unsigned and as narrow as they were sent."""
    n, size = int.from_bytes(blob[:8], "little"), blob[8]
    if not n:
        return np.zeros(0, np.uint8)
    planes = np.frombuffer(pa.decompress(blob[9:], n * size, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(size, n).T).view(f"<u{size}").ravel()


def pair_keys(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """64-bit keys of pairs of word hashes."""
    u = np.uint64
    key = first * u(0x9E3779B97F4A7C15) ^ (second ^ second >> u(31)) * u(0xC2B2AE3D27D4EB4F)
    key = (key ^ key >> u(32)) * u(0xFF51AFD7ED558CCD)
    return key ^ key >> u(29)


def _bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of each key; rises with the key."""
    return ((keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def _least(bucket: int, buckets: int) -> np.uint64:
    """The least key of a bucket."""
    return np.uint64(-(-(bucket << 32) // buckets) << 32)


def _inside_buckets(keys: np.ndarray, lo: int, hi: int, buckets: int) -> np.ndarray:
    inside = keys >= _least(lo, buckets)
    return inside & (keys < _least(hi, buckets)) if hi < buckets else inside


def _distinct(keys: np.ndarray) -> np.ndarray:
    keys = np.sort(keys)
    return keys[np.r_[True, keys[1:] != keys[:-1]]] if len(keys) else keys


def _packed(limit: int):
    """Documents in rows of about ``limit`` text bytes, as numbers of their distinct words, the most frequent first."""
    def row(ids: list[pa.Array], texts: list[bytes]) -> pa.RecordBatch:
        at, n, words = numbered(texts)
        words = words.view(np.uint64)
        order = np.lexsort((words, -np.bincount(at, minlength=len(words))))
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        values = [pa.ListArray.from_arrays(pa.array([0, len(texts)], pa.int32()), pa.concat_arrays(ids)), squeezed(n), squeezed(np.diff(words[order], prepend=np.uint64(0))), squeezed(rank[at]), len(at)]
        return pa.RecordBatch.from_arrays([values[0], *[pa.array([v]) for v in values[1:]]], names=["ids", "lengths", "words", "numbers", "places"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, held = [], [], 0
        for batch in batches:
            for part in slices(batch, limit=max(1, limit // 8)):
                more = raw(part.column("text"))
                size = sum(map(len, more))
                if texts and held + size > limit:
                    yield row(ids, texts)
                    ids, texts, held = [], [], 0
                ids.append(part.column("doc_id"))
                texts += more
                held += size
        if texts:
            yield row(ids, texts)
    return run


class Pack:
    """The texts of a pack, the keys of their pairs, and how each text counts: 0 and 1 by class, 2 and 3 in the curve's rows, -1 not."""

    def __init__(self, row: dict) -> None:
        self.n = unsqueezed(row["lengths"].as_py()).astype(np.int64)
        self.words = np.cumsum(unsqueezed(row["words"].as_py()), dtype=np.uint64)
        self.at = unsqueezed(row["numbers"].as_py()).astype(np.int32)
        self.curve, self.toxic = np.zeros(len(self.n), bool), np.full(len(self.n), -1)
        if row["marks"].is_valid:
            pos, toxic, curve = (row["marks"].values.field(c).to_numpy(zero_copy_only=False) for c in ("pos", "toxic", "curve"))
            self.curve[pos], self.toxic[pos] = curve, toxic
        later = np.ones(len(self.at), bool)
        later[(np.cumsum(self.n) - self.n)[self.n > 0]] = False
        later = later[1:]
        self.first, self.second = self.at[:-1][later], self.at[1:][later]
        self.of = np.repeat(np.arange(len(self.n), dtype=np.int32), np.maximum(self.n - 1, 0))
        self.kind = np.where((self.toxic == 0) | (self.toxic == 1), 2 * self.curve + self.toxic, -1).astype(np.int8)[self.of]
        self.keys = np.empty(len(self.first), np.uint64)
        for lo in range(0, len(self.keys), STEP):  # few at once
            part = slice(lo, lo + STEP)
            self.keys[part] = pair_keys(self.words[self.first[part]], self.words[self.second[part]])

    def pair_asks(self, lo: int, hi: int, buckets: int) -> pa.RecordBatch:
        """Distinct pairs of the buckets from lo to hi, with the counts of each kind."""
        inside = _inside_buckets(self.keys, lo, hi, buckets)
        keys, kind = self.keys[inside], self.kind[inside]
        distinct = _distinct(keys)
        counts = [np.bincount(np.searchsorted(distinct, keys[kind == k]), minlength=len(distinct)) for k in range(4)]
        return _asks(distinct, np.stack(counts), buckets)

    def pairs_answered(self, answers: list[pa.Scalar]) -> None:
        """counts: of each distinct pair by kind, and whether this pack counts it for its words; place: of each pair in it."""
        self.counts, self.place = _answered(answers, 5), np.empty(len(self.keys), np.int32)
        order = np.argsort(self.keys)
        keys = self.keys[order]
        self.place[order] = np.cumsum(np.r_[True, keys[1:] != keys[:-1]][:len(keys)], dtype=np.int32) - 1
        del self.keys  # no longer needed, and large

    def word_asks(self, lo: int, hi: int, buckets: int) -> pa.RecordBatch:
        """Of each word of the buckets from lo to hi: how often first, by kind; in how many pairs first, and second, by class, without the curve's rows and only with them."""
        own = np.flatnonzero(self.kind >= 0)
        place = self.place[own]
        first, second = np.zeros((2, self.counts.shape[1]), np.int32)
        first[place], second[place] = self.first[own], self.second[own]
        of = lambda words: np.bincount(words, minlength=len(self.words))
        before = [of(self.first[self.kind == k]) for k in range(4)]
        counting = np.flatnonzero(self.counts[4])
        rest, own = np.split(self.counts[:4, counting] > 0, 2)
        counted = [counting[x] for x in (*rest, *(own & ~rest))]
        order = np.argsort(self.words, kind="stable")
        order = order[_inside_buckets(self.words[order], lo, hi, buckets)]
        return _asks(self.words[order], np.stack([*before, *[of(side[c]) for side in (first, second) for c in counted]])[:, order], buckets)

    def words_answered(self, answers: list[pa.Scalar]) -> None:
        order = np.argsort(self.words, kind="stable")
        self.known = np.zeros((12, len(self.words)), np.int64)
        self.known[:, order] = _answered(answers, 13)[:12]
        self.known[:4] += self.known[4:8]

    def evidence(self, fit: int, sums: np.ndarray, docs: np.ndarray) -> np.ndarray:
        """Whole and passage of the texts ``docs`` by the counts of a fit (0: without the curve's rows, 1: all); sums: of ``known``, and both numbers of words."""
        n = self.n[docs]
        if not ready(fit, sums) or not n.any():
            return np.zeros((len(n), 2))
        before, types, after = (_of_fit(x, fit) for x in np.split(self.known, 3))
        total, size = _of_fit(sums[8:12], fit).astype(float), sums[12 + fit]
        shared = after[0] + after[1]
        departs = [(after[c] + SHARED) / (shared * (total[c] / total.sum()) + SHARED) for c in (0, 1)]
        mass = [np.minimum(DISCOUNT * types[c], before[c]) + SHARED_PAIRS for c in (0, 1)]
        back = [np.log(mass[c] / (before[c] + SHARED_PAIRS)) for c in (0, 1)]
        alone, lead = np.log(departs[1] / departs[0]), back[1] - back[0]
        chosen = np.zeros(len(self.n), bool)
        chosen[docs] = True
        at, own = self.at if chosen.all() else self.at[np.repeat(chosen, self.n)], np.flatnonzero(chosen[self.of])
        place = self.place[own]
        # each distinct pair that is counted, by one of its places
        a, b = np.zeros((2, self.counts.shape[1]), np.int32)
        a[place], b[place] = self.first[own], self.second[own]
        met = np.zeros(self.counts.shape[1], bool)
        met[place] = True
        some = np.flatnonzero(met & self.counts[:2 + 2 * fit].any(0))
        p, a, b = _of_fit(self.counts[:4, some].astype(np.int64), fit), a[some], b[some]
        both = (np.maximum(p.sum(0) - DISCOUNT, 0) + DISCOUNT * (types[0] + types[1])[a] * ((shared + 1) / (total.sum() + size))[b]) / (before[0] + before[1])[a]
        tells = [np.log1p(np.maximum(p[c] - DISCOUNT, 0) / (mass[c][a] * both * departs[c][b])) for c in (0, 1)]
        pair = np.zeros(self.counts.shape[1])
        pair[some] = tells[1] - tells[0]
        difference = alone[at]
        difference[_inside(n)] += lead[self.first[own]] + pair[place]
        return _passages(difference, n)


def ready(fit: int, sums: np.ndarray) -> bool:
    """Whether a fit has pairs of both classes."""
    return bool((_of_fit(sums[:4], fit) > 0).all())


def _of_fit(kinds: np.ndarray, fit: int) -> np.ndarray:
    """Counts by class from those by kind."""
    return kinds[:2] + kinds[2:] if fit else kinds[:2]


def _asks(keys: np.ndarray, counts: np.ndarray, buckets: int) -> pa.RecordBatch:
    """A row for each bucket; keys: distinct, ascending."""
    bucket = _bucket(keys, buckets)
    cuts = [*np.flatnonzero(np.r_[len(keys) > 0, bucket[1:] != bucket[:-1]]).tolist(), len(keys)] if len(keys) else [0]
    spans = list(zip(cuts, cuts[1:]))
    sent = [squeezed(np.diff(keys[lo:hi], prepend=np.uint64(0))) for lo, hi in spans], [squeezed(counts[:, lo:hi]) for lo, hi in spans]
    return pa.RecordBatch.from_arrays([pa.array(bucket[cuts[:-1]].astype(np.int32)), *[pa.array(x, pa.binary()) for x in sent]], names=["bucket", "keys", "counts"])


def _answered(answers: list[pa.Scalar], rows: int) -> np.ndarray:
    """What came back for a pack's keys in all rounds, in ascending order."""
    bits = {b: x for a in answers if a.is_valid for b, x in zip(a.values.field("bucket").to_pylist(), a.values.field("bits"), strict=True)}
    return np.concatenate([np.zeros((rows, 0), np.uint8), *[unsqueezed(bits[b].as_py()).reshape(rows, -1) for b in sorted(bits)]], axis=1)


def _summed(asks: pa.Table) -> pa.Table:
    """Each ask of a bucket with the sums of its keys, and for each key whether it is the first that counts it.

    sums: once a bucket, of all distinct keys; and how many of these are words that the first fit knows, and the second.
    """
    found = [np.cumsum(unsqueezed(x.as_py()), dtype=np.uint64) for x in asks.column("keys")]
    counts = [unsqueezed(x.as_py()).reshape(-1, len(k)) for x, k in zip(asks.column("counts"), found, strict=True)]
    sizes = [len(k) for k in found]
    keys, counts = np.concatenate(found), np.concatenate(counts, axis=1)
    distinct = _distinct(keys)
    place = np.searchsorted(distinct, keys)
    total = np.zeros((len(counts), len(distinct)), np.int64)
    mine = np.zeros(len(keys), bool)
    some = np.flatnonzero(counts.any(0))
    for row, own in zip(total, counts):
        np.add.at(row, place[some], own[some].astype(np.int64))
    mine[some[np.unique(place[some], return_index=True)[1]]] = True
    sums = total.sum(1).tolist()
    if len(total) == 12:  # words
        sums += [int(_of_fit(total[4:8] + total[8:], f).any(0).sum()) for f in (0, 1)]
        total[:4] -= total[4:8]  # how often beyond once a pair: mostly 0
    cuts = np.cumsum([0, *sizes])
    bits = [squeezed(np.vstack([total[:, place[lo:hi]], mine[None, lo:hi]])) for lo, hi in zip(cuts, cuts[1:])]
    out = asks.select(["place", "chunk", "bucket"]).append_column("bits", pa.array(bits, pa.binary()))
    return out.append_column("sums", pa.array([sums, *[None] * (len(bits) - 1)], pa.list_(pa.int64())))


def _by_pack(does):
    """``does`` for each row of packs: its columns by name to a batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield does({n: batch.column(n)[i] for n in batch.schema.names})
                pa.default_memory_pool().release_unused()
    return run


def _sent(row: dict, asks: pa.RecordBatch) -> pa.RecordBatch:
    own = [pa.array([row[c].as_py()] * asks.num_rows, t) for c, t in (("place", pa.int32()), ("chunk", pa.int64()))]
    return pa.RecordBatch.from_arrays([*own, *asks.columns], names=["place", "chunk", *asks.schema.names])


_ASK = "place int, chunk long, bucket int, keys binary, counts binary"
_ANSWER = "place int, chunk long, bucket int, bits binary, sums array<long>"
_TEXTS = ("place", "chunk", "lengths", "words", "numbers", "marks")


def learnt(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, Curve]:
    """doc_id, whole, passage of every row of ``docs`` (doc_id, text), and the curve; learnt from the labelled rows that are not held out.

    The curve sees evidence by counts without the curve's rows; what is returned counts all.
    """
    texts = placed(docs.mapInArrow(_packed(PACK), "ids array<long>, lengths binary, words binary, numbers binary, places long"), "packs", PACK)
    ids = texts.select("place", "chunk", F.posexplode("ids").alias("pos", "doc_id"))
    rows = written(labelled(ids.where(~held_out()), labels.where(~held_out()), "toxic"), "toxic-rows")
    packs = brought_from(texts, settled(split(rows), "marks", ("pos", "toxic", "curve"), PACK), "marks").select("ids", *_TEXTS)
    places = texts.agg(F.sum("places")).first()[0] or 0
    buckets = max(1, -(-places // PER_BUCKET))

    def answered(packs: DataFrame, name: str, rounds: int, asks: Callable[[dict, int, int], pa.RecordBatch]) -> list[DataFrame]:
        """The answers to what packs ask about the buckets of each round, by place."""
        cuts = [turn * buckets // min(rounds, buckets) for turn in range(min(rounds, buckets) + 1)]
        sent = [packs.mapInArrow(_by_pack(lambda r, lo=lo, hi=hi: _sent(r, asks(r, lo, hi))), _ASK) for lo, hi in zip(cuts, cuts[1:])]
        return [settled(x.groupBy("bucket").applyInArrow(_summed, _ANSWER), name, ("bucket", "bits", "sums"), PACK) for x in sent]

    def with_pairs(r: dict) -> Pack:
        pack = Pack(r)
        pack.pairs_answered([r[c] for c in names])
        return pack

    pairs = answered(packs.select(*_TEXTS), "pairs", ROUNDS, lambda r, lo, hi: Pack(r).pair_asks(lo, hi, buckets))
    names = [f"pairs{turn}" for turn in range(len(pairs))]
    for name, own in zip(names, pairs, strict=True):
        packs = brought_from(packs, own, name)
    words = answered(packs.select(*_TEXTS, *names), "words", WORD_ROUNDS, lambda r, lo, hi: with_pairs(r).word_asks(lo, hi, buckets))
    known = [f"words{turn}" for turn in range(len(words))]
    for name, own in zip(known, words, strict=True):
        packs = brought_from(packs, own, name)
    found = reduce(DataFrame.unionByName, words).select(F.explode(F.map_values("all")).alias("one")).select(F.explode("one.sums").alias("sums")).select(F.posexplode("sums"))
    found = found.groupBy("pos").agg(F.sum("col")).orderBy("pos").collect()
    sums = np.array([x[1] for x in found] or [0] * 14)

    def evidence_of(r: dict, fit: int, curve: bool) -> tuple[Pack, np.ndarray, np.ndarray]:
        pack = with_pairs(r)
        docs = np.flatnonzero(pack.curve) if curve else np.arange(len(pack.n))
        if ready(fit, sums) and len(docs):
            pack.words_answered([r[c] for c in known])
            steps = np.cumsum(pack.n[docs]) // STEP  # few words at once
            return pack, docs, np.concatenate([pack.evidence(fit, sums, x) for x in np.split(docs, np.flatnonzero(np.diff(steps)) + 1)])
        return pack, docs, np.zeros((len(docs), 2))

    def for_curve(r: dict) -> pa.RecordBatch:
        pack, docs, got = evidence_of(r, 0, True)
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (got[:, 0], got[:, 1], pack.toxic[docs].astype(np.int32))], names=["whole", "passage", "toxic"])

    def for_all(r: dict) -> pa.RecordBatch:
        got = evidence_of(r, 1, False)[2]
        return pa.RecordBatch.from_arrays([r["ids"].values, pa.array(got[:, 0]), pa.array(got[:, 1])], names=["doc_id", "whole", "passage"])

    seen = packs.select(*_TEXTS, *names, *known).mapInArrow(_by_pack(for_curve), "whole double, passage double, toxic int").toPandas()
    curve = Curve(seen[["whole", "passage"]].to_numpy(), seen["toxic"].to_numpy(np.float64))
    return written(packs.select("ids", *_TEXTS, *names, *known).mapInArrow(_by_pack(for_all), "doc_id long, whole double, passage double"), "evidence"), curve


def _scored(curve: Curve):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = curve(np.column_stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("whole", "passage")]))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(score), pa.array((score >= THRESHOLD).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])
    return run


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of ``docs``; labels: doc_id, toxic."""
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    with frugal(docs.sparkSession):
        found, curve = learnt(docs, labels.select(F.col("doc_id").cast("long"), F.col("toxic").cast("int")))
    return found.withColumn("held_out", held_out()).mapInArrow(_scored(curve), "doc_id long, held_out boolean, score double, predicted int")
