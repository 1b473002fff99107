"""Helpers shared by the corpus operators: reading, scratch tables, bounded Arrow slices."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

#: Text bytes that one step of a Python task holds at once (one longer document still goes whole).
SLICE_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, which all executors share (only a local master may go without)."""
    return scratch_path(spark, name)


def written(df: DataFrame, name: str, compression: str = "zstd", block: int | None = None) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: cuts lineage, survives lost executors.

    ``block``: for rows of some MB each, the bytes of a row group.
    """
    path = scratch(df.sparkSession, name)
    writer = df.write.option("compression", compression)
    (_small_groups(writer, block) if block else writer).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _small_groups(writer: DataFrameWriter, block: int) -> DataFrameWriter:
    """Small row groups, checked after every row: a row is some MB."""
    return writer.option("parquet.block.size", block).option("parquet.page.size.row.check.min", 1)


def _places(spark: SparkSession) -> int:
    return min(int(spark.conf.get("spark.sql.shuffle.partitions")), 100_000)


def placed(rows: DataFrame, name: str, block: int) -> DataFrame:
    """``rows``, of some MB each, with ``place`` (the task that wrote it) and ``chunk`` (its number); written one file a task.

    What is found out about a row later can be ``brought`` to it without moving the rows.
    """
    rows = rows.select(F.spark_partition_id().alias("place"), F.monotonically_increasing_id().alias("chunk"), *rows.columns)
    return _bucketed(rows, name, block)


def _bucketed(rows: DataFrame, name: str, block: int) -> DataFrame:
    """``rows`` as a table bucketed by place."""
    spark = rows.sparkSession
    table = f"{name}_{uuid.uuid4().hex}"
    _small_groups(rows.write.bucketBy(_places(spark), "place").option("path", scratch(spark, name)).option("compression", "zstd"), block).saveAsTable(table)
    found = spark.table(table)
    spark.sql(f"DROP TABLE {table}")  # the name only; its files stay
    return found


def _of_place(answers: DataFrame, fields: tuple[str, ...]) -> DataFrame:
    """place, all: the answers to each of its chunks."""
    own = answers.repartition(_places(answers.sparkSession), "place").groupBy("place", "chunk").agg(F.collect_list(F.struct(*fields)).alias("one"))
    return own.groupBy("place").agg(F.map_from_entries(F.collect_list(F.struct("chunk", "one"))).alias("all"))


def settled(answers: DataFrame, name: str, fields: tuple[str, ...], block: int) -> DataFrame:
    """The answers, written by place: ``brought_from`` moves neither them nor the packs."""
    return _bucketed(_of_place(answers, fields), name, block)


def brought_from(packs: DataFrame, of_place: DataFrame, name: str) -> DataFrame:
    return packs.join(of_place.hint("shuffle_hash"), "place", "left").withColumn(name, F.col("all")[F.col("chunk")]).drop("all")


def brought(packs: DataFrame, answers: DataFrame, name: str) -> DataFrame:
    """Each chunk with its answers (part, bucket, bits); the chunks stay where they are."""
    return brought_from(packs, _of_place(answers, ("part", "bucket", "bits")), name)


@contextmanager
def frugal(spark: SparkSession) -> Iterator[None]:
    """Within it, the shuffle files of a job go when it ends, not when the driver collects its garbage,
    and Python tasks get about ``SLICE_BYTES`` at once."""
    wanted = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.execution.arrow.maxBytesPerBatch": str(SLICE_BYTES)}
    before = {name: spark.conf.get(name) for name in wanted}
    try:
        for name, value in wanted.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def unused(df: DataFrame, name: str) -> str:
    """``name``, lengthened until the table has no such column (names match in any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def without(docs: DataFrame, lost: DataFrame, by: Column | None = None) -> DataFrame:
    """``docs`` less the rows that ``lost`` names by doc_id and ``digest`` (of ``by``, the text's own if not given).

    Where ``lost`` has a column ``stays``, one row of each name for which it holds stays.  Texts move once;
    what is lost grows with the corpus, so it is merged, never broadcast: the same plan at every size.
    """
    key, ident, value = (unused(docs, n) for n in ("digest_key", "lost_id", "lost_digest"))
    marked = docs.withColumn(key, digest() if by is None else by)
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(ident)) & (F.col(key) == F.col(value))
    named = lambda df: df.select(F.col("doc_id").alias(ident), F.col("digest").alias(value)).hint("merge")
    out = marked.join(named(lost), same, "left_anti")
    if "stays" in lost.columns:
        again = written(lost.where("stays"), "repeated")
        if not again.isEmpty():
            out = out.unionByName(marked.join(named(again), same, "left_semi").dropDuplicates(["doc_id", key]))
    return out.drop(key)


def digest() -> Column:
    """SHA-256 of the text (null as empty); with doc_id it tells rows apart, whose ids may repeat or be null."""
    return F.unhex(F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary"), 256))


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of ``batch`` in runs whose ``column`` is at most ``limit`` bytes (or one row)."""
    if not batch.num_rows:
        return
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        base = int(ends[at - 1]) if at else 0
        to = max(at + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield batch.slice(at, to - at)
        at = to
    pa.default_memory_pool().release_unused()


def raw(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a string column; null as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def record(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)
