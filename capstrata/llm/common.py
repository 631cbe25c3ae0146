"""Helpers shared by the corpus operators."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MASK64 = (1 << 64) - 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: `spark.checkpoint.dir`; a local one only where that is unset."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = "file://" + os.path.join(tempfile.gettempdir(), "capstrata-checkpoints")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Cut the lineage: write to the shared folder and read back. It survives the loss of executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/capstrata/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "snappy").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def require(df: DataFrame, *columns: str) -> DataFrame:
    """Only the named columns, so that extra columns of any name never clash."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df.select(*[F.col(f"`{c}`") for c in columns])


def sample_share(df: DataFrame, id_col: str, rows: int) -> DataFrame:
    """About `rows` rows of df, or all if it has fewer: those whose id hashes into a share of the range. The same rows at
    any partitioning, and no task sends more than its own part of them."""
    share = 1_000_000 * rows // max(1, df.count())
    return df if share >= 1_000_000 else df.where(F.pmod(F.xxhash64(id_col), F.lit(1_000_000)) < F.lit(share))


HOT_GROUPS = 1024  # as many groups at most can each hold more than 1/HOT_GROUPS of all rows
BLOCK_ROWS = 64


def attach_group(rows: DataFrame, groups: DataFrame, keys: list[str], size: str = "n") -> DataFrame:
    """rows joined with their group's one row of values, without moving a hot group into one task.

    Only HOT_GROUPS groups can hold more than one part in HOT_GROUPS of all rows each; these few are broadcast (a fixed
    bound), and their rows are spread over all tasks by a salt. The rows of all others meet their group in a shuffle.
    """
    values = [c for c in groups.columns if c not in keys]
    hot = groups.orderBy(F.desc(size), *keys).limit(HOT_GROUPS).select(*keys, F.struct(*values).alias("_hot"))
    salt = F.when(F.col("_hot").isNotNull(), F.pmod(F.xxhash64(*[c for c in rows.columns]), F.lit(4096)) + 1).otherwise(F.lit(0).cast("bigint"))
    marked = rows.join(F.broadcast(hot), keys, "left").withColumn("_salt", salt)
    cold = groups.select(*keys, F.lit(0).cast("bigint").alias("_salt"), F.struct(*values).alias("_cold"))
    both = marked.join(cold.hint("shuffle_hash"), [*keys, "_salt"], "left").withColumn("_group", F.coalesce("_hot", "_cold")).where("_group is not null")
    return both.select(*rows.columns, *[F.col(f"_group.{c}").alias(c) for c in values])


def pair_rows(members: DataFrame, keys: list[str], row_id: str, other: str | None = None) -> DataFrame:
    """(id_a, id_b), id_a < id_b, of all rows with equal keys.

    members has a column n, the size of the row's group. Groups are cut into blocks of about BLOCK_ROWS rows, and a block
    meets another under the number of the one and the keys, so that no task holds or pairs a whole group. other: a column
    whose values must differ.
    """
    cut = members.withColumn("_blocks", F.ceil(F.col("n") / BLOCK_ROWS)).withColumn("_block", F.pmod(F.xxhash64(row_id), F.col("_blocks")))
    item = F.struct(F.col(row_id).alias("id"), *([F.col(other).alias("other")] if other else []))
    blocks = cut.groupBy(*keys, "_block").agg(F.collect_list(item).alias("_rows"))
    a, b = blocks.alias("a"), blocks.withColumn("_with", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_block")))).alias("b")
    on = [F.col(f"a.{k}") == F.col(f"b.{k}") for k in keys] + [F.col("a._block") == F.col("b._with")]
    paired = a.join(b, on).select((F.col("a._block") < F.col("b._block")).alias("apart"), F.explode("a._rows").alias("x"), F.col("b._rows").alias("ys"))
    paired = paired.select("apart", "x", F.explode("ys").alias("y")).where("x.id <> y.id and (apart or x.id < y.id)")
    if other:
        paired = paired.where("x.other <> y.other")
    return paired.select(F.least("x.id", "y.id").alias("id_a"), F.greatest("x.id", "y.id").alias("id_b"))


SMALL_IDS = 2_000_000


def with_ids(df: DataFrame, ids: DataFrame, on: str) -> DataFrame:
    """The rows of df whose column is among ids (written, one column of numbers); SMALL_IDS or fewer are broadcast."""
    ids = ids.toDF(on)
    return df.join(F.broadcast(ids) if ids.count() <= SMALL_IDS else ids, on, "left_semi")


# Rows of a fixed size in bytes cross a shuffle in blobs, one for each part of the receiving side: Spark then moves some
# thousands of long values instead of millions of rows, and numpy reads them back without a copy.

FLUSH = 1 << 19  # rows that a task gathers before it cuts them into blobs


def blobs(chunks: Iterator[tuple[np.ndarray, np.ndarray]], parts: int) -> Iterator[pa.RecordBatch]:
    """(part, data) of chunks (part of each row, rows of a structured type)."""

    def cut(held: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        part, rows = (np.concatenate(x) for x in zip(*held))
        order = np.argsort(part, kind="stable")
        edges = np.searchsorted(part[order], np.arange(parts + 1))
        used = np.flatnonzero(np.diff(edges))
        offsets = (np.append(edges[used], len(rows)) * rows.itemsize).astype(np.int32)
        data = pa.Array.from_buffers(pa.binary(), len(used), [None, pa.py_buffer(offsets), pa.py_buffer(rows[order].tobytes())])
        return pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), data], ["part", "data"])

    held, size = [], 0
    for part, rows in chunks:
        held.append((part, rows))
        size += len(rows)
        if size >= FLUSH:
            yield cut(held)
            held, size = [], 0
    if size:
        yield cut(held)


def exchange(df: DataFrame, make: Callable, take: Callable, parts: int, dtype: np.dtype, schema: str) -> DataFrame:
    """df -> make(batches) -> chunks (part, rows) -> shuffle -> take(all rows of a part) -> record batches.

    A part is held by one task: whoever makes the rows spreads hot keys over parts.
    """

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from blobs(make(batches), parts)

    def receive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [np.frombuffer(v.as_buffer(), dtype) for batch in batches for v in batch.column(1)]
        if found:
            yield from take(np.concatenate(found))

    return df.mapInArrow(send, "part int, data binary").repartitionById(parts, "part").mapInArrow(receive, schema)
