"""Token ids as wavelet matrices: one compressed, self-contained file per shard.

A shard holds the ids of consecutive documents (in doc_id order, about
``SHARD_TOKENS`` ids; a longer document makes a longer shard).  Its body is a
wavelet matrix: one bit-plane per id bit, most significant first; each plane is
ordered by a stable partition on the plane above it.  Every plane has the count
of ones before each 512-bit block, so ``rank`` reads one block, ``access`` one
block a plane, and ``select`` searches the counts.  From these the shard answers
token access, counting in a range, and where an id occurs, without restoring the ids.
Sections (a plane is one) are zstd-compressed one by one; a plane is decompressed whole when read.

Shards are the rows of a Parquet table written by Spark (its commit protocol
covers lost executors and works on any file system Spark knows); the bytes in
``payload`` are the file of one shard.

Null texts count as empty documents (they still get the end id); null doc_ids
come first; documents with one doc_id follow each other by their text's XXH64, then text.
Texts of any length are encoded whole.  Columns beyond doc_id and text are not read; an empty table gives no shards.
"""

from __future__ import annotations

import struct
import zlib
from array import array
from collections.abc import Iterator
from itertools import chain
from operator import attrgetter

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .chunks import ChunkEncoder, byte_letters, library, runs, vocabulary
from .common import slices, written

SHARD_TOKENS = 1 << 20
END_ID = 0
BLOCK = 512
#: Text bytes encoded at once: the more, the fewer words are new to a worker again.
SLICE = 24 << 20
#: Pieces whose tokens are held as objects at once (4,096 took twice as long).
PIECES = 64
MAGIC = b"WVM1"


def _pack(sections: list[bytes], head: bytes) -> bytes:
    squeeze = zstandard.ZstdCompressor(level=1)
    packed = [squeeze.compress(s) for s in sections]
    return b"".join([MAGIC, struct.pack("<II", len(head), len(packed)), head, struct.pack(f"<{len(packed)}Q", *map(len, packed)), *packed])


class WaveletShard:
    """Read access to one shard."""

    def __init__(self, data: bytes) -> None:
        if data[:4] != MAGIC:
            raise ValueError("not a wavelet shard")
        head, n = struct.unpack_from("<II", data, 4)
        self.length, self.bits, self.documents = struct.unpack_from("<QII", data, 12)
        sizes = struct.unpack_from(f"<{n}Q", data, 12 + head)
        at = 12 + head + 8 * n
        self._sections = []
        for size in sizes:
            self._sections.append(data[at:at + size])
            at += size
        self._open: dict[int, np.ndarray] = {}

    @staticmethod
    def build(ids: np.ndarray, doc_ids: list[int | None], lengths: np.ndarray) -> bytes:
        """The file of ``ids``; lengths: ids of each document."""
        bits = max(1, int(ids.max()).bit_length()) if len(ids) else 1
        at = ids.astype(np.uint16 if bits <= 16 else np.uint32)
        sections = [np.array([d is None for d in doc_ids], np.uint8).tobytes(), np.array([d or 0 for d in doc_ids], np.int64).tobytes(), np.asarray(lengths, np.int64).tobytes()]
        for level in range(bits - 1, -1, -1):
            ones = (at >> level) & 1 == 1
            plane = np.packbits(ones, bitorder="little")
            plane = np.concatenate([plane, np.zeros(-len(plane) % (BLOCK // 8), np.uint8)])
            counts = np.bitwise_count(plane.view(np.uint64)).reshape(-1, BLOCK // 64).sum(1, dtype=np.uint32)
            sections += [plane.tobytes(), np.concatenate([[0], np.cumsum(counts)]).astype(np.uint32).tobytes()]
            if level:
                at = np.concatenate([at[np.flatnonzero(~ones)], at[np.flatnonzero(ones)]])  # several times faster than by masks
        return _pack(sections, struct.pack("<QII", len(ids), bits, len(doc_ids)))

    def _section(self, i: int, kind) -> np.ndarray:
        if i not in self._open:
            self._open[i] = np.frombuffer(zstandard.ZstdDecompressor().decompress(self._sections[i]), kind)
        return self._open[i]

    def doc_ids(self) -> list[int | None]:
        return [None if n else d for n, d in zip(self._section(0, np.uint8).tolist(), self._section(1, np.int64).tolist(), strict=True)]

    def lengths(self) -> np.ndarray:
        return self._section(2, np.int64)

    def _plane(self, p: int) -> tuple[np.ndarray, np.ndarray]:
        return self._section(3 + 2 * p, np.uint8), self._section(4 + 2 * p, np.uint32)

    def _bit(self, p: int, i: int) -> int:
        return int(self._plane(p)[0][i >> 3]) >> (i & 7) & 1

    def _ones(self, p: int, i: int) -> int:
        """Ones among the first ``i`` bits of plane ``p``."""
        plane, counts = self._plane(p)
        b = i // BLOCK
        tail = plane[b * BLOCK // 8:(i + 7) // 8]
        n = int(np.bitwise_count(tail).sum()) if len(tail) else 0
        if i & 7:
            n -= (int(tail[-1]) >> (i & 7)).bit_count()
        return int(counts[b]) + n

    def _zeros(self, p: int) -> int:
        return self.length - int(self._plane(p)[1][-1])

    def access(self, i: int) -> int:
        """The id at place ``i``."""
        if not 0 <= i < self.length:
            raise IndexError(i)
        out = 0
        for p in range(self.bits):
            bit, ones = self._bit(p, i), self._ones(p, i)
            out = out << 1 | bit
            i = self._zeros(p) + ones if bit else i - ones
        return out

    def _range(self, token: int, start: int, stop: int) -> tuple[int, int]:
        """Where the occurrences of ``token`` in [start, stop) lie below the last plane."""
        if token < 0 or token >> self.bits:
            return 0, 0
        for p in range(self.bits):
            a, b = self._ones(p, start), self._ones(p, stop)
            start, stop = (self._zeros(p) + a, self._zeros(p) + b) if token >> (self.bits - 1 - p) & 1 else (start - a, stop - b)
        return start, stop

    def count(self, token: int, start: int = 0, stop: int | None = None) -> int:
        """How often ``token`` occurs in [start, stop)."""
        a, b = self._range(token, max(0, start), self.length if stop is None else min(stop, self.length))
        return max(0, b - a)

    def rank(self, token: int, i: int) -> int:
        return self.count(token, 0, i)

    def _select_bit(self, p: int, bit: int, k: int) -> int:
        """Place of the k-th (from 0) ``bit`` of plane ``p``."""
        plane, counts = self._plane(p)
        before = counts.astype(np.int64) if bit else np.arange(len(counts)) * BLOCK - counts.astype(np.int64)
        b = int(np.searchsorted(before, k, side="right")) - 1
        inside = np.unpackbits(plane[b * BLOCK // 8:(b + 1) * BLOCK // 8], bitorder="little") == bit
        return b * BLOCK + int(np.flatnonzero(inside)[k - int(before[b])])

    def select(self, token: int, k: int) -> int:
        """The place of the k-th (from 0) occurrence of ``token``."""
        a, b = self._range(token, 0, self.length)
        if not 0 <= k < b - a:
            raise IndexError(k)
        at = a + k
        for p in range(self.bits - 1, -1, -1):
            bit = token >> (self.bits - 1 - p) & 1
            at = self._select_bit(p, bit, at - self._zeros(p) if bit else at)
        return at

    def occurrences(self, token: int) -> list[int]:
        return [self.select(token, k) for k in range(self.count(token))]

    def ids(self) -> np.ndarray:
        """All ids in order, undoing the partitions from the lowest plane up."""
        out = np.zeros(self.length, np.uint16 if self.bits <= 16 else np.uint32)
        for p in range(self.bits - 1, -1, -1):
            ones = np.unpackbits(self._plane(p)[0], count=self.length, bitorder="little").view(bool)
            zeros = self.length - int(self._plane(p)[1][-1])
            up = np.empty_like(out)
            up[np.flatnonzero(~ones)] = out[:zeros]
            up[np.flatnonzero(ones)] = out[zeros:] | out.dtype.type(1 << (self.bits - 1 - p))
            out = up
        return out.astype(np.uint32)


_ENCODERS: dict[str, ChunkEncoder] = {}


def encoder(path: str) -> ChunkEncoder:
    """The worker's encoder on the library; kept between tasks."""
    if path not in _ENCODERS:
        lib = library(path)
        letter = np.zeros(256, np.uint16)
        for c, b in byte_letters().items():
            letter[b] = ord(c)
        special = [t.content for t in lib.get_added_tokens_decoder().values()]
        tokenize, number = lib.model.tokenize, attrgetter("id")

        def pieces(ps: list[str]) -> pa.Array:
            # a piece is what the library's own cut gives its model, so it goes to the model at once, in the vocabulary's letters: one a byte
            spelt = [p.encode() for p in ps]
            at = np.cumsum([0, *map(len, spelt)]).tolist()
            letters = letter[np.frombuffer(b"".join(spelt), np.uint8)].tobytes().decode("utf-16-le")
            ids, sizes = [], [0]
            for i in range(0, len(ps), PIECES):
                found = [tokenize(letters[a:b]) for a, b in zip(at[i:i + PIECES], at[i + 1:i + PIECES + 1])]
                sizes += map(len, found)
                ids.append(np.fromiter(map(number, chain.from_iterable(found)), np.uint32))
            return runs(np.concatenate([np.zeros(0, np.uint32), *ids]), np.cumsum(sizes))

        _ENCODERS[path] = ChunkEncoder(
            pieces,
            lambda text: array("I", lib.encode(text, add_special_tokens=False).ids).tobytes(), special)
    return _ENCODERS[path]


def _shards(path: str, end_id: int, shard_tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part_id = encoder(path), TaskContext.get().partitionId()
        held: list[np.ndarray] = []
        docs: list[int | None] = []
        seq = tokens = 0

        def flush() -> pa.RecordBatch:
            nonlocal held, docs, seq, tokens
            lengths = np.array([len(x) for x in held], np.int64)
            data = WaveletShard.build(np.concatenate(held), docs, lengths)
            out = pa.RecordBatch.from_arrays([pa.array([part_id], pa.int32()), pa.array([seq], pa.int32()), pa.array([len(docs)], pa.int64()), pa.array([tokens], pa.int64()), pa.array([data], pa.binary())],
                                             names=["part", "seq", "n_docs", "n_tokens", "payload"])
            held, docs, seq, tokens = [], [], seq + 1, 0
            return out

        end = np.array([end_id], np.uint32)
        for batch in batches:
            for part in slices(batch, limit=SLICE):
                ids, at = encode(part.column("text"))
                for doc, a, b in zip(part.column("doc_id").to_pylist(), at[:-1].tolist(), at[1:].tolist(), strict=True):
                    held.append(np.concatenate([ids[a:b], end]))
                    docs.append(doc)
                    tokens += b - a + 1
                    if tokens >= shard_tokens:
                        yield flush()
        if docs:
            yield flush()
    return run


def write_shards(docs: DataFrame, path: str | None = None, end_id: int = END_ID, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Encodes doc_id, text and writes the shards; the table reads them back.

    (part, seq) is the order of the shards.
    """
    path = path or vocabulary()
    tie = F.xxhash64("text")  # rows of one id may fill several tasks; ranges are found from samples of these two numbers, not of texts
    ordered = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).repartitionByRange("doc_id", tie).sortWithinPartitions("doc_id", tie, "text")
    shards = ordered.mapInArrow(_shards(path, end_id, shard_tokens), "part int, seq int, n_docs long, n_tokens long, payload binary")
    return written(shards, "wavelet", "none")


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, seq, data in zip(batch.column("part"), batch.column("seq"), batch.column("payload"), strict=True):
            shard = WaveletShard(data.as_py())
            ids, lengths = shard.ids(), shard.lengths()
            ends = np.cumsum(lengths)
            n = len(lengths)
            crc = [zlib.crc32(ids[e - k:e].astype("<u4", copy=False)) for e, k in zip(ends.tolist(), lengths.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array([part.as_py()] * n, pa.int32()), pa.array([seq.as_py()] * n, pa.int32()), pa.array(shard.doc_ids(), pa.int64()), pa.array(ends - lengths, pa.int64()), pa.array(lengths, pa.int64()), pa.array(crc, pa.int64())],
                                             names=["part", "seq", "doc_id", "inside", "n_tokens", "ids_crc32"])


def read_documents(shards: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the shards."""
    sizes = shards.select("part", "seq", "n_tokens")
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("size"))  # one row for each task that wrote
    before = F.coalesce(F.sum("size").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = parts.select("part", before.alias("part_start"))
    own = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn("shard_start", F.coalesce(F.sum("n_tokens").over(own), F.lit(0))).drop("n_tokens").join(parts, "part")
    found = shards.select("part", "seq", "payload").mapInArrow(_documents, "part int, seq int, doc_id long, inside long, n_tokens long, ids_crc32 long")
    return found.join(starts, ["part", "seq"]).select("doc_id", (F.col("part_start") + F.col("shard_start") + F.col("inside")).cast("long").alias("start"), "n_tokens", "ids_crc32")


def _lookup(token: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, seq, data in zip(batch.column("part"), batch.column("seq"), batch.column("payload"), strict=True):
                shard = WaveletShard(data.as_py())
                places = np.array(shard.occurrences(token), np.int64)
                ends = np.cumsum(shard.lengths())
                of, docs = np.searchsorted(ends, places, side="right"), shard.doc_ids()
                yield pa.RecordBatch.from_arrays([pa.array([docs[i] for i in of.tolist()], pa.int64()), pa.array(places - (ends - shard.lengths())[of], pa.int64())], names=["doc_id", "place"])
    return run


def find_token(shards: DataFrame, token: int) -> DataFrame:
    """doc_id and place in the document of every occurrence of an id."""
    return shards.select("part", "seq", "payload").mapInArrow(_lookup(token), "doc_id long, place long")
