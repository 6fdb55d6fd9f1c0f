"""Line deduplication with levelled sorted runs of line hashes.

Documents come in batches of ascending ``doc_id``.  A :class:`RunStore` keeps
the hashes of all lines seen, as sorted parquet runs on levels; a batch
merge-anti-joins all runs (a hash that a run holds was seen in an earlier
batch), adds its own new hashes as a run on level 0, and whenever a level holds
``fanout`` runs they are merged into one run on the next level.  Hashes of
different runs are disjoint, so a merge is a sorted union.

A line's key is the line stripped of ``[\\x20\\x09-\\x0D]`` at both ends with
A-Z lower-cased; keys under ``min_chars`` code points are left alone.  A key
held by two documents or more loses all its lines except in the smallest
``doc_id`` holding it (all lines of the key stay there).

Defined cases: null or empty text is one empty line, and a null text stays null
as nothing can be dropped from it; a null ``doc_id`` counts as larger than any
other, and rows with the same ``doc_id`` count as one document (their lines
share one fate); an empty table gives an empty table; further columns pass
through, and result columns get trailing underscores where the name is taken.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum.llm.common import free_name, table, text_blocks, text_bytes, written
from stratum.session import scratch_path

SPACE = b" \t\n\x0b\x0c\r"
LAST_ID = (1 << 63) - 1


def line_hash(line: bytes, min_chars: int) -> bytes | None:
    """128-bit hash of a line's key; None for keys that are too short."""
    key = line.strip(SPACE).lower()
    if len(key) < min_chars or (len(key) < 4 * min_chars and len(key.decode("utf-8", "replace")) < min_chars):
        return None
    return hashlib.md5(key, usedforsecurity=False).digest()


def _hash_rows(min_chars: int):
    def rows(batches):
        for batch in batches:
            ids = batch.column(0)
            at = 0
            for block in text_blocks(batch.column(1)):
                docs, keys = [], []
                for k, text in enumerate(text_bytes(block)):
                    own = {h for line in text.split(b"\n") if (h := line_hash(line, min_chars))}
                    docs.extend([at + k] * len(own))
                    keys.extend(own)
                at += len(block)
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(docs, pa.int64())), pa.array(keys, pa.binary())], ["doc", "line"])
    return rows


class RunStore:
    """Levelled sorted runs of line hashes in the shared folder."""

    def __init__(self, spark: SparkSession, fanout: int = 2):
        self.spark, self.fanout = spark, fanout
        self.levels: list[list[str]] = []

    def runs(self) -> list[DataFrame]:
        return [self.spark.read.schema("line binary").parquet(p) for level in self.levels for p in level]

    def seen(self) -> DataFrame | None:
        """All hashes added so far, each once."""
        out = None
        for run in self.runs():
            out = run if out is None else out.union(run)
        return out

    def _write(self, hashes: DataFrame) -> str:
        path = scratch_path(self.spark, "line-run")
        hashes.repartition("line").sortWithinPartitions("line").write.parquet(path)
        return path

    def add(self, hashes: DataFrame) -> None:
        """Add hashes that no run holds; merge full levels."""
        new, level = self._write(hashes), 0
        while True:
            if level == len(self.levels):
                self.levels.append([])
            self.levels[level].append(new)
            if len(self.levels[level]) < self.fanout:
                return
            parts = [self.spark.read.schema("line binary").parquet(p) for p in self.levels[level]]
            merged = parts[0]
            for p in parts[1:]:
                merged = merged.union(p)
            self.levels[level], new, level = [], self._write(merged), level + 1


def batch_drops(lines: DataFrame, store: RunStore) -> DataFrame:
    """(``doc``, ``line``) pairs of one batch that go, where ``lines`` holds the
    batch's distinct pairs; adds the batch's new hashes to the store."""
    firsts = lines.groupBy("line").agg(F.min("doc").alias("first_doc"), F.count("*").alias("holders"))
    old = store.seen()
    if old is None:
        firsts = firsts.withColumn("old", F.lit(False))
    else:
        marked = old.withColumn("old", F.lit(True))
        firsts = firsts.hint("merge").join(marked, "line", "left").withColumn("old", F.coalesce("old", F.lit(False)))
    firsts = written(firsts, "line-firsts")
    store.add(firsts.where("not old").select("line"))
    again = firsts.where("old or holders > 1").select("line", "first_doc", "old")
    return written(lines.hint("merge").join(again, "line").where("old or doc > first_doc").select("doc", "line"),
                   "line-drops")


@F.arrow_udf(T.StructType().add("text", T.StringType()).add("n_lines", T.LongType()).add("n_dropped", T.LongType()))
def _without(text: pa.Array, drops: pa.Array, min_chars: pa.Array) -> pa.Array:
    chunks, total, gone, at = [pa.array([], pa.string())], [], [], 0
    least = min_chars[0].as_py() if len(min_chars) else 0
    for block in text_blocks(text):
        kept = []
        for raw, drop in zip(text_bytes(block), drops.slice(at, len(block)).to_pylist()):
            lines = raw.split(b"\n")
            stay = lines
            if drop:
                drop = set(drop)
                stay = [x for x in lines if line_hash(x, least) not in drop]
            total.append(len(lines))
            gone.append(len(lines) - len(stay))
            kept.append(raw if stay is lines else b"\n".join(stay))
        own = pa.array(kept, pa.binary()).cast(pa.string())
        # a null text has nothing to lose
        chunks.append(pc.if_else(pc.is_null(block), pa.scalar(None, pa.string()), own) if block.null_count else own)
        at += len(block)
    out = pa.concat_arrays(chunks)
    return pa.StructArray.from_arrays([out, pa.array(total, pa.int64()), pa.array(gone, pa.int64())],
                                      ["text", "n_lines", "n_dropped"])


def dedup_lines(docs: DataFrame, min_chars: int = 10, n_batches: int = 4, fanout: int = 2) -> DataFrame:
    """``docs`` with the repeated lines gone from ``text``, plus ``n_lines``
    (before) and ``n_dropped``.  ``n_batches``: batches of about equal row
    counts, in order of ``doc_id``."""
    spark = docs.sparkSession
    lines = docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LAST_ID)).alias("doc"), "text")
    lines = written(lines.mapInArrow(_hash_rows(min_chars), "doc bigint, line binary").distinct(), "line-hashes")
    cuts = lines.agg(F.percentile_approx("doc", [i / n_batches for i in range(1, n_batches)], 10000)).first()[0] \
        if n_batches > 1 else []
    bounds = [None, *sorted(set(cuts or [])), None]
    store, drops = RunStore(spark, fanout), None
    for lo, hi in zip(bounds, bounds[1:]):
        batch = lines
        batch = batch if lo is None else batch.where(F.col("doc") > lo)
        batch = batch if hi is None else batch.where(F.col("doc") <= hi)
        found = batch_drops(batch, store)
        drops = found if drops is None else drops.union(found)
    per_doc = drops.groupBy("doc").agg(F.collect_list("line").alias("gone"))
    row = F.struct(*[docs[c] for c in docs.columns]).alias("row")
    joined = docs.select(row, F.coalesce(docs["doc_id"].cast("bigint"), F.lit(LAST_ID)).alias("doc")) \
        .join(per_doc, "doc", "left")
    out = joined.select("row", _without(F.col("row.text"), F.col("gone"), F.lit(min_chars)).alias("r"))
    names = docs.columns
    n_lines = free_name(names, "n_lines")
    n_dropped = free_name(names, "n_dropped")
    return out.select(*[F.col("r.text").alias("text") if c == "text" else F.col("row")[c].alias(c) for c in names],
                      F.col("r.n_lines").alias(n_lines), F.col("r.n_dropped").alias(n_dropped))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line dedup of all ``documents``: lines, dropped lines, kept text's hash."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs).select(
        "doc_id", "n_lines", "n_dropped",
        F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


OP9_SQL = """
WITH raw AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents
), keyed AS (
  SELECT doc_id, pos, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM raw
), owner AS (
  SELECT k, min(doc_id) AS first_doc FROM keyed WHERE length(k) >= 10 GROUP BY k
), marked AS (
  SELECT keyed.*, coalesce(owner.first_doc < keyed.doc_id, false) AS gone
  FROM keyed LEFT JOIN owner USING (k)
)
SELECT doc_id, CAST(count(*) AS BIGINT) AS n_lines, CAST(count(*) FILTER (gone) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
