"""Source divergence audit: how far each source's words lie from the other sources' of its
language, and which terms set it apart.

A term is a run of letters (A-Z lower-cased, everything beyond ASCII counts as a letter).
A language keeps the V terms that occur in at least ``least`` of its documents.  With N the
kept terms' occurrences in a group (a source of a language) or in a language, a term with
``count`` of them has the smoothed share p = 1 + floor(10^9 (count + 2) / (N + 2 V)); two
shares p, q differ by f = floor((p - q)^2 / (p + q)).  All of it is whole numbers, so the result
does not depend on order or partitioning; N + 2 V must be below 9 * 10^15.

Pairs: f summed over all kept terms for each two sources of a language.  The terms are dealt
in blocks of bounded size, a block meets the totals of its language's groups, and only
sums leave it; no pair of rows is ever built.

Terms: those that a source uses more than its language (p > q), by f, the first ``k``.  f
grows with the group's count and falls with the language's, so a term is out of the first
k if k others have a count as high, a language count as low and an earlier UTF-8 form:
they dominate it.  Each partition keeps its k-skyband (terms dominated by fewer than
k others), skybands are merged into the skyband of the whole, and what is left is ranked exactly.

Null text, lang and source count as ''.  A text without terms, however empty, still makes
its group occur; a language without kept terms has pairs of value 0 and no terms.  Repeated rows
are documents of their own.  Equal values rank by the item's UTF-8 form.  Very long texts are read
whole, one at a time.  An empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import raw, slices, written

LEAST, RANKS = 10, 10
#: Over lower-cased UTF-8: every byte of a character beyond ASCII is 0x80 or more.
TERM = re.compile(rb"[a-z\x80-\xff]+")
#: Distinct (group, term) a task counts before it hands them on.
HELD = 1 << 18
#: Rows (term, source) a block of the pair sums holds, or as many as the pairs it yields.
BLOCK = 1 << 16
#: Cells of a block's count matrix that are worked on at once.
CELLS = 1 << 20
#: Skyband rows a task holds before it hands them on.
BAND_ROWS = 1 << 18


def share(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 + floor(10^9 (count + 2) / total) by long division, three digits at a time."""
    out, left = np.divmod(count + 2, total)
    for _ in range(3):
        digits, left = np.divmod(left * 1000, total)
        out = out * 1000 + digits
    return out + 1


def distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task: occurrences and documents of each term in each group; groups without terms give nothing."""
    uses: dict[tuple, Counter] = {}
    docs: dict[tuple, Counter] = {}

    def flush() -> pa.RecordBatch:
        keys = [(g, t) for g, c in uses.items() for t in c]
        columns = [pa.array([g[0] for g, _ in keys], pa.string()), pa.array([g[1] for g, _ in keys], pa.string()),
                   pa.array([t for _, t in keys], pa.binary()), pa.array([uses[g][t] for g, t in keys], pa.int64()),
                   pa.array([docs[g][t] for g, t in keys], pa.int64())]
        uses.clear()
        docs.clear()
        return pa.RecordBatch.from_arrays(columns, names=["lang", "source", "term", "n", "docs"])

    held = 0
    for batch in batches:
        for part in slices(batch):
            groups = zip(part.column("lang").to_pylist(), part.column("source").to_pylist(), strict=True)
            for group, text in zip(groups, raw(part.column("text")), strict=True):
                terms = TERM.findall(text.lower())
                if terms:
                    use = uses.setdefault(group, Counter())
                    held -= len(use)
                    use.update(terms)
                    held += len(use)
                    docs.setdefault(group, Counter()).update(set(terms))
                if held > HELD:
                    yield flush()
                    held = 0
    yield flush()


def kept_terms(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """lang, source, term (UTF-8), n, lang_n, first (one row a term of a lang has it), written.

    docs: lang, source, text without nulls.
    """
    counted = docs.mapInArrow(_counts, "lang string, source string, term binary, n long, docs long").repartition("lang", "term")
    term = Window.partitionBy("lang", "term")
    summed = counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    summed = summed.select("lang", "source", "term", "n", F.sum("n").over(term).alias("lang_n"), F.sum("docs").over(term).alias("lang_docs"),
                           (F.col("source") == F.min("source").over(term)).alias("first"))
    return written(summed.where(F.col("lang_docs") >= least).drop("lang_docs"), "kept-terms")


def group_totals(groups: DataFrame, kept: DataFrame) -> DataFrame:
    """lang, source, total (N + 2 V of the group), lang_total, sources, lang_rows of every group, written."""
    own = kept.groupBy("lang", "source").agg(F.sum("n").alias("n"), F.count("*").alias("rows"), F.sum(F.col("first").cast("long")).alias("terms"))
    lang = own.groupBy("lang").agg(F.sum("n").alias("lang_n"), F.sum("terms").alias("v"), F.sum("rows").alias("lang_rows"))
    sources = groups.groupBy("lang").agg(F.count("*").alias("sources"))
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long"))
    found = groups.join(own, ["lang", "source"], "left").join(lang, "lang", "left").join(sources, "lang")
    return written(found.select("lang", "source", (zero("n") + 2 * zero("v")).alias("total"), (zero("lang_n") + 2 * zero("v")).alias("lang_total"),
                                "sources", zero("lang_rows").alias("lang_rows")), "group-totals")


def _block_sums(terms: pa.Table, totals: pa.Table) -> pa.Table:
    """Of a block of a language's terms: the summed distances of each two of its sources."""
    names = totals.column("source").to_pylist()
    place = {s: i for i, s in enumerate(names)}
    total = totals.column("total").to_numpy()
    if not terms.num_rows or len(names) < 2:
        names, sums = [], np.zeros((0, 0), np.int64)
    else:
        row = terms.column("term").combine_chunks().dictionary_encode().indices.to_numpy()
        of = np.array([place[s] for s in terms.column("source").to_pylist()], np.int64)
        n = terms.column("n").to_numpy()
        order = np.argsort(row, kind="stable")
        row, of, n = row[order], of[order], n[order]
        sums = np.zeros((len(names), len(names)), np.int64)
        step = max(1, CELLS // len(names))
        for lo in range(0, int(row[-1]) + 1, step):
            a, b = np.searchsorted(row, [lo, lo + step])
            counts = np.zeros((min(step, int(row[-1]) + 1 - lo), len(names)), np.int64)
            counts[row[a:b] - lo, of[a:b]] = n[a:b]
            p = share(counts, total)
            for i in range(len(names) - 1):
                sums[i, i + 1:] += distance(p[:, i + 1:], p[:, i:i + 1]).sum(0)
        sums += sums.T
    a, b = np.nonzero(~np.eye(len(names), dtype=bool)) if names else ([], [])
    lang = totals.column("lang").to_pylist()[:1]
    return pa.table([pa.array(lang * len(a), pa.string()), pa.array([names[i] for i in a], pa.string()), pa.array([names[i] for i in b], pa.string()),
                     pa.array(sums[a, b] if names else [], pa.int64())], names=["lang", "source", "item", "value"])


def pairs(kept: DataFrame, totals: DataFrame, block: int = BLOCK) -> DataFrame:
    """lang, source, item (another source of the lang), value of every pair."""
    size = F.greatest(F.lit(block), F.col("sources") * F.col("sources"))
    blocks = totals.withColumn("blocks", F.greatest(F.ceil(F.col("lang_rows") / size), F.lit(1)).cast("int"))
    dealt = kept.join(blocks.select("lang", "blocks").distinct(), "lang")
    dealt = dealt.select("lang", "source", "term", "n", F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int").alias("block"))
    each = blocks.select("lang", "source", "total", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    sums = (dealt.groupBy("lang", "block").cogroup(each.groupBy("lang", "block"))
            .applyInArrow(_block_sums, "lang string, source string, item string, value long"))
    sums = sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    all_pairs = totals.select("lang", "source").join(totals.select("lang", F.col("source").alias("item")), "lang").where("source <> item")
    return all_pairs.join(sums, ["lang", "source", "item"], "left").select("lang", "source", "item", F.coalesce("value", F.lit(0).cast("long")).alias("value"))


def skyband(n: np.ndarray, lang_n: np.ndarray, terms: np.ndarray, k: int) -> np.ndarray:
    """Places of the terms that fewer than ``k`` others dominate; terms are distinct bytes.

    Whatever dominates a term stands before it in the order below, and k dominating it in all
    means k of the skyband do, so comparing with what was kept is enough.
    """
    text = np.empty(len(terms), np.int64)
    text[np.argsort(terms, kind="stable")] = np.arange(len(terms))
    order = np.lexsort((text, lang_n, -n))
    a, b = n[order], lang_n[order]
    starts = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])][:len(order)])
    within = np.arange(len(order)) - np.repeat(starts, np.diff(np.r_[starts, len(order)]))
    order = order[within < k]  # of equal counts the first k at most
    lows, texts = np.empty(len(order), np.int64), np.empty(len(order), np.int64)
    out, kept = [], 0
    for i, low, at in zip(order.tolist(), lang_n[order].tolist(), text[order].tolist(), strict=True):
        if kept < k or np.count_nonzero((lows[:kept] <= low) & (texts[:kept] < at)) < k:
            lows[kept], texts[kept] = low, at
            kept += 1
            out.append(i)
    return np.array(out, np.int64)


class _Bands:
    """The skybands of the groups a task has met, within bounded memory."""

    def __init__(self, k: int) -> None:
        self.k, self.held = k, {}

    def add(self, keys: list[tuple], columns: list[np.ndarray]) -> None:
        """columns: n, lang_n, value, term of rows whose group ``keys`` names."""
        places: dict[tuple, list[int]] = {}
        for i, key in enumerate(keys):
            places.setdefault(key, []).append(i)
        for key, at in places.items():
            rows = [c[at] for c in columns]
            if key in self.held:
                rows = [np.concatenate(x) for x in zip(self.held[key], rows, strict=True)]
            stay = skyband(rows[0], rows[1], rows[3], self.k)
            self.held[key] = [c[stay] for c in rows]

    def rows(self) -> int:
        return sum(len(x[0]) for x in self.held.values())

    def flush(self) -> pa.RecordBatch:
        sizes = [(key, len(x[0])) for key, x in self.held.items()]
        n, lang_n, value = (np.concatenate([np.zeros(0, np.int64), *(x[i] for x in self.held.values())]) for i in range(3))
        columns = [pa.array([key[0] for key, s in sizes for _ in range(s)], pa.string()), pa.array([key[1] for key, s in sizes for _ in range(s)], pa.string()),
                   pa.array([t for x in self.held.values() for t in x[3]], pa.binary()), pa.array(n), pa.array(lang_n), pa.array(value)]
        self.held = {}
        return pa.RecordBatch.from_arrays(columns, names=["lang", "source", "term", "n", "lang_n", "value"])


_BAND = "lang string, source string, term binary, n long, lang_n long, value long"


def _skybands(k: int):
    """Rows with the totals (first pass) lose what their group doesn't use more than its language, and get their value."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands = _Bands(k)
        for batch in batches:
            n, lang_n = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("n", "lang_n"))
            if "total" in batch.schema.names:
                p, q = (share(x, batch.column(c).to_numpy(zero_copy_only=False)) for x, c in ((n, "total"), (lang_n, "lang_total")))
                use, value = p > q, distance(p, q)
            else:
                use, value = np.ones(len(n), bool), batch.column("value").to_numpy(zero_copy_only=False)
            batch = batch.filter(pa.array(use))
            terms = np.empty(batch.num_rows, object)
            terms[:] = batch.column("term").to_pylist()
            bands.add(list(zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), strict=True)),
                      [n[use], lang_n[use], value[use], terms])
            if bands.rows() > BAND_ROWS:
                yield bands.flush()
        yield bands.flush()
    return run


def telling_terms(kept: DataFrame, totals: DataFrame, k: int = RANKS) -> DataFrame:
    """lang, source, item, value, rank: the k terms that set each source most apart from its language."""
    joined = kept.select("lang", "source", "term", "n", "lang_n").join(totals.select("lang", "source", "total", "lang_total"), ["lang", "source"])
    partial = joined.mapInArrow(_skybands(k), _BAND)
    merged = partial.repartition("lang", "source").mapInArrow(_skybands(k), _BAND)
    place = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item"))
    ranked = merged.select("lang", "source", F.col("term").cast("string").alias("item"), "value").withColumn("rank", F.row_number().over(place))
    return ranked.where(F.col("rank") <= k)


def audit(docs: DataFrame, least: int = LEAST, k: int = RANKS) -> DataFrame:
    """lang, source, part ('pair' or 'term'), item, value, rank."""
    known = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    kept = kept_terms(known, least)
    totals = group_totals(known.select("lang", "source").distinct(), kept)
    place = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item"))
    both = pairs(kept, totals).withColumn("rank", F.row_number().over(place))
    part = lambda df, name: df.select("lang", "source", F.lit(name).alias("part"), "item", "value", "rank")
    return part(both, "pair").unionByName(part(telling_terms(kept, totals, k), "term"))
