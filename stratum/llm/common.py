"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.session import delete_path, scratch_path

#: Text bytes that a Python worker turns into Python objects at a time.
BLOCK_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, read by Spark (any file system)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` under the shared checkpoint folder and
    read it back, so that lost executors cost no recomputation."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_at = path
    return out


def drop(*frames: DataFrame | None) -> None:
    """Delete tables of :func:`written` that nothing reads any more.  Only the
    frame that it returned knows its folder; others, and None, are left alone."""
    for df in frames:
        path = getattr(df, "_written_at", None)
        if path:
            delete_path(df.sparkSession, path)


def free_name(columns: list[str], wanted: str) -> str:
    """``wanted``, with underscores appended until no input column has it
    (Spark compares names without case)."""
    taken = {c.lower() for c in columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def crc_mod(column: str, m: int) -> Column:
    """crc32 of the value as text, modulo ``m`` (null: remainder null)."""
    return F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(m))


def text_bytes(texts: pa.Array) -> list[bytes]:
    """UTF-8 bytes of every text; null counts as empty."""
    return [b"" if t is None else t for t in texts.cast(pa.binary()).to_pylist()]


def text_blocks(texts: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[pa.Array]:
    """Slices of whole texts with about ``limit`` bytes each (a longer text is
    a slice of its own), so that one Arrow batch of long texts does not become
    Python objects all at once."""
    if len(texts) == 0:
        return
    size = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    block = np.cumsum(size) // limit
    cut = np.flatnonzero(np.diff(block)) + 1
    for lo, hi in zip([0, *cut], [*cut, len(texts)]):
        yield texts.slice(lo, hi - lo)


def connected_components(edges: DataFrame, max_rounds: int = 40) -> DataFrame:
    """Components of an undirected graph: (``u``, ``v``) pairs of longs in,
    (``node``, ``label``) out, label = smallest node reachable.  Nodes without
    an edge are not listed.

    Alternating large-star / small-star rounds: every round is two aggregates
    and two joins on the edge list.  A hub's neighbours are never gathered: its
    minimum is a partial aggregate, and the minima are written before they are
    joined back, as the engine can split a hub's rows only where both sides of
    a join come straight from a shuffle.
    """
    cur = written(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                  .distinct(), "cc-edges")
    sign = None
    for _ in range(max_rounds):
        both = cur.select("u", "v").union(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = written(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "cc-low")
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = written(large.where("u <> v").distinct(), "cc-large")
        low = written(large.groupBy("u").agg(F.min("v").alias("m")), "cc-low")
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        nxt = written(small.union(low.select("u", F.col("m").alias("v"))).distinct(), "cc-edges")
        state = nxt.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))"), F.sum(F.expr("u % 1000003 + v % 1000003"))).first()
        cur = nxt
        if state == sign:
            break
        sign = state
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    stars = cur.groupBy("u").agg(F.min("v").alias("label")).withColumnRenamed("u", "node")
    roots = stars.select(F.col("label").alias("node"), "label").distinct()
    return stars.union(roots)
