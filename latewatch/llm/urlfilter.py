"""URL filter over a sorted digest array.

The rules become one file: the sorted 64-bit XXH64 keys of their strings, then
offsets, verdicts and the strings themselves.  Spark ships the file to every
executor, where it is memory-mapped, so all workers of a machine share its
pages.  A url is probed with each of its host suffixes joined to each rule-length
prefix of its path: the keys of a whole batch are looked up by one vectorised
binary search, and a hit counts only if the stored string is equal, so a digest
collision cannot decide.  The longest fitting rule wins (of equal lengths the one
with the longer host); a url on no rule is allowed, as the list names what to
block.

Rules beyond ``max_bytes`` are not shipped: the distinct candidates of all urls are
then joined with the rules by a shuffle on their bytes, the hits go back to the urls,
and the same choice is made.  A candidate that many urls share (``com/``, say) is one
row in the first join; in the second its urls are spread over ``SALT`` tasks.

A null url, or one without ``://``, has empty host and path, which fit no rule.
An empty table gives an empty result, an empty rule list allows all; of repeated
rules the blocking one holds.  A rule's path is empty or begins with ``/`` and its host
has no ``/``; a rule that is otherwise, or null, fits no url.  Urls of any length are
handled whole.  Repeated rows are judged each; columns beyond the named ones are not read.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import raw, slices, written

MAX_BYTES = 256 << 20
#: Parts that the urls of one candidate are spread over when the rules are joined.
SALT = 16
_UPPER = bytes(range(65, 91))
_OPEN: dict[str, "DigestArray"] = {}


def split_url(url: bytes) -> tuple[bytes, bytes]:
    """Host (A-Z lower-cased) and path of a url."""
    _, mark, rest = url.partition(b"://")
    if not mark:
        return b"", b""
    for stop in (b"#", b"?"):
        rest = rest.partition(stop)[0]
    host, slash, path = rest.partition(b"/")
    return host.lower(), slash + path


class DigestArray:
    """Sorted 64-bit keys with the full strings behind them; ``probe`` is exact."""

    def __init__(self, data) -> None:
        view = np.frombuffer(data, np.uint8) if isinstance(data, bytes) else np.memmap(data, np.uint8, "r")
        n, lengths = view[:16].view(np.uint64).tolist()
        at = 16
        self.keys = view[at:(at := at + 8 * n)].view(np.uint64)
        self.ends = view[at:(at := at + 8 * n)].view(np.uint64)
        self.lengths = view[at:(at := at + 8 * lengths)].view(np.uint64).tolist()
        self.block = view[at:(at := at + n)]
        self.text = view[at:]

    @staticmethod
    def pack(rules: list[tuple[bytes, bool]]) -> bytes:
        """rules: host + path, and whether it blocks."""
        verdict: dict[bytes, bool] = {}
        for rule, block in rules:
            verdict[rule] = verdict.get(rule, False) or block
        order = sorted((xxhash.xxh64_intdigest(r), r) for r in verdict)
        lengths = sorted({len(r) - r.index(b"/") if b"/" in r else 0 for r in verdict})
        ends = np.cumsum([len(r) for _, r in order], dtype=np.uint64)
        return b"".join([np.array([len(order), len(lengths)], np.uint64).tobytes(), np.array([k for k, _ in order], np.uint64).tobytes(),
                         ends.tobytes(), np.array(lengths, np.uint64).tobytes(), bytes(verdict[r] for _, r in order), *[r for _, r in order]])

    def rule(self, i: int) -> bytes:
        return self.text[int(self.ends[i - 1]) if i else 0:int(self.ends[i])].tobytes()

    def probe(self, strings: list[bytes], keys: np.ndarray | None = None) -> np.ndarray:
        """The place of each string, or -1.  Equal keys are confirmed on the stored string."""
        if keys is None:
            keys = np.fromiter(map(xxhash.xxh64_intdigest, strings), np.uint64, len(strings))
        at = np.searchsorted(self.keys, keys)
        found = np.full(len(strings), -1, np.int64)
        inside = at < len(self.keys)
        for i in np.flatnonzero(inside)[self.keys[at[inside]] == keys[inside]].tolist():
            j = int(at[i])
            while j < len(self.keys) and self.keys[j] == keys[i]:
                if self.rule(j) == strings[i]:
                    found[i] = j
                    break
                j += 1
        return found


def candidates(host: bytes, path: bytes, lengths: list[int]) -> list[bytes]:
    """What a rule that fits may be, longest string first."""
    if not host:
        return []
    labels = host.split(b".")
    hosts = [b".".join(labels[i:]) for i in range(len(labels))]
    out = [(h, path[:n]) for h in hosts for n in lengths if n <= len(path)]
    return [h + p for h, p in sorted(out, key=lambda x: (-len(x[0]) - len(x[1]), -len(x[0])))]


def _judged(name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rules = _OPEN.get(name)
        if rules is None:
            rules = _OPEN[name] = DigestArray(SparkFiles.get(name))
        for batch in batches:
            for part in slices(batch, "url"):
                urls = [split_url(u) for u in raw(part.column("url"))]
                tried = [candidates(h, p, rules.lengths) for h, p in urls]
                found = rules.probe([c for row in tried for c in row])
                rule, verdict, at = [], [], 0
                for row in tried:
                    hit = next((int(i) for i in found[at:at + len(row)] if i >= 0), -1)
                    at += len(row)
                    rule.append(rules.rule(hit).decode() if hit >= 0 else None)
                    verdict.append("block" if hit >= 0 and rules.block[hit] else "allow")
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), pa.array([h for h, _ in urls], pa.binary()).cast(pa.string()),
                     pa.array([p for _, p in urls], pa.binary()).cast(pa.string()), pa.array(rule, pa.string()), pa.array(verdict, pa.string())],
                    names=["page_id", "host", "path", "rule", "verdict"])
    return run


def judge(pages: DataFrame, rules: DataFrame, max_bytes: int = MAX_BYTES) -> DataFrame:
    """page_id, host, path, rule, verdict for every row of ``pages`` (page_id, url).

    ``rules``: host, path, verdict (allow or block).
    """
    spark = pages.sparkSession
    proper = ~F.col("host").contains("/") & ((F.col("path") == "") | F.col("path").startswith("/"))
    rules = rules.where("host is not null and path is not null").where(proper).select(
        F.concat("host", "path").cast("binary").alias("rule"), F.octet_length("path").alias("n"), (F.col("verdict") == "block").alias("block")).distinct()
    wanted = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"))
    size = rules.agg(F.coalesce(F.sum(F.octet_length("rule") + 32), F.lit(0))).first()[0]
    if size > max_bytes:
        return _joined(wanted, rules)
    packed = DigestArray.pack([(bytes(r.rule), bool(r.block)) for r in rules.collect()])  # at most max_bytes, checked
    folder = tempfile.mkdtemp(prefix="rules-")  # the driver's own; Spark ships the file
    name = f"rules-{uuid.uuid4().hex}"
    with open(os.path.join(folder, name), "wb") as f:
        f.write(packed)
    spark.sparkContext.addFile(os.path.join(folder, name))
    return wanted.mapInArrow(_judged(name), "page_id long, host string, path string, rule string, verdict string")


def _tried(lengths: list[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "url"):
                urls = [split_url(u) for u in raw(part.column("url"))]
                text = lambda xs: pa.array(xs, pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([part.column("page_id"), text([h for h, _ in urls]), text([p for _, p in urls]),
                                                  pa.array([candidates(h, p, lengths) for h, p in urls], pa.list_(pa.binary()))], names=["page_id", "host", "path", "tried"])
    return run


def _joined(wanted: DataFrame, rules: DataFrame) -> DataFrame:
    """The same for a rule list too large to ship: shuffle joins of candidates and rules, by bytes."""
    lengths = [r[0] for r in rules.select("n").distinct().orderBy("n").collect()]  # as many as rule paths have lengths
    tried = wanted.mapInArrow(_tried(lengths), "page_id long, host string, path string, tried array<binary>")
    tried = written(tried.withColumn("row", F.monotonically_increasing_id()), "url-candidates")  # the numbers are read back, not made again
    block = rules.groupBy("rule").agg(F.max(F.coalesce("block", F.lit(False))).alias("block"))
    pairs = tried.select("row", F.posexplode("tried").alias("place", "rule"))
    hits = written(pairs.select("rule").distinct().join(block.hint("merge"), "rule"), "url-hits")
    salted = hits.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    pairs = pairs.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(SALT)).cast("int"))
    best = pairs.join(salted.hint("merge"), ["rule", "salt"]).groupBy("row").agg(F.min_by(F.struct("rule", "block"), "place").alias("best"))
    return tried.join(best.hint("merge"), "row", "left").select(
        "page_id", "host", "path", F.col("best.rule").cast("string").alias("rule"),
        F.when(F.col("best.block"), "block").otherwise("allow").alias("verdict"))
