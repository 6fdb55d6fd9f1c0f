"""Incremental keyed upsert with a lookback window, and full refresh.

Semantics of an incremental model with a unique key:

* the new batch is the model's full result filtered to
  ``ts >= max(ts in target) - lookback`` (a NULL ``ts`` never passes, so
  such rows only arrive with a full refresh);
* target rows whose key appears in the batch are deleted, wherever they
  are, then every batch row is inserted (anti join + union);
* a full refresh rebuilds the table from the model's full result.

The table is a committed one (:mod:`stratum.sources.committed`): a run that dies
at any step leaves the rows of the last commit, and the next run goes on from
them.  Beside the rows it keeps, per table partition,

* the maximum of ``ts``, so the high-water mark is read from the pointer, and
  the counts asked for (rows that violate a check, say), so that those of the
  table are sums;
* a filter of the partition's keys: every key sets ``PROBES`` bits of one bitmap,
  so a batch finds the partitions that may hold its keys without reading the key
  column of all history (a key that a partition does not hold passes its filter
  about once in a million; what passes is checked against the keys themselves);

and, for the table, the keys that several rows hold.  All three are merged from
the partitions and the keys that a run touches.

Deviation: an existing but *empty* target is treated as a first load (the
plain rule would load nothing, because ``max`` of nothing is NULL).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructType

from stratum.session import delete_path
from stratum.sources import committed
from stratum.sources.committed import PART, Pointer

#: Bits of one bitmap (as the engine's bitmap functions have it), bits per key at
#: least, and bits that a key sets.
BITMAP_BITS = 32768
BITS_PER_KEY = 128
PROBES = 4


def high_water_mark(target: DataFrame, ts_col: str):
    """``max(ts_col)`` of the target as a driver-side scalar (one value); a
    timestamp in the session's time zone."""
    text = target.agg(F.max(ts_col).cast("string").alias("m")).first()["m"]
    return None if text is None else _mark_value(text, target.schema[ts_col].dataType.simpleString())


def committed_mark(spark: SparkSession, path: str, ts_col: str):
    """The high-water mark of a table: the largest of its partitions' marks, which
    its pointer holds; a table of plain files is scanned for it."""
    pointer = committed.current(spark, path)
    if pointer is None:
        return high_water_mark(spark.read.parquet(path), ts_col)
    if any(e.get("mark_of") != ts_col for e in pointer.parts.values()):
        return high_water_mark(committed.read_parts(spark, path, pointer), ts_col)
    marks = [e["mark"] for e in pointer.parts.values() if e["mark"] is not None]
    return max((_mark_value(m, pointer.schema[ts_col].dataType.simpleString()) for m in marks), default=None)


def _mark_value(text: str, kind: str):
    if kind == "date":
        return dt.date.fromisoformat(text)
    if kind in ("timestamp", "timestamp_ntz"):
        return dt.datetime.fromisoformat(text)
    return text if kind == "string" else float(text) if kind in ("double", "float") else int(text)


# ------------------------------------------------------------- key filters
def blocks_for(rows: int) -> int:
    """Bitmaps (a power of two) for a partition of so many keys."""
    return 1 << max(0, (rows * BITS_PER_KEY - 1) // BITMAP_BITS).bit_length()


def _block_and_bits(keys: list[str], blocks: Column) -> tuple[Column, list[Column]]:
    """A key's bitmap and the bits that it sets there."""
    h = F.xxhash64(*[F.col(k) for k in keys])
    g = F.xxhash64(F.lit(7), *[F.col(k) for k in keys])
    return F.pmod(h, blocks), [F.shiftrightunsigned(g, 15 * i).bitwiseAND(F.lit(BITMAP_BITS - 1)) for i in range(PROBES)]


def key_filters(rows: DataFrame, keys: list[str], blocks: dict[str, int]) -> DataFrame:
    """Per table partition and block its ``bitmap``; rows with a null in their key
    set no bit, as they match nothing."""
    sizes = rows.sparkSession.createDataFrame(sorted(blocks.items()), f"{PART} string, blocks int")
    block, bits = _block_and_bits(keys, F.col("blocks"))
    spread = rows.select(PART, *keys).dropna(subset=keys).join(sizes, PART) \
        .select(PART, "blocks", block.cast("int").alias("block"), F.explode(F.array(*bits)).alias("bit"))
    return spread.groupBy(PART, "blocks", "block").agg(F.bitmap_construct_agg(F.col("bit")).alias("bitmap"))


def _has(bit: Column) -> Column:
    """Whether the bitmap has the bit (bits of a byte from the lowest)."""
    byte = F.conv(F.hex(F.substring("bitmap", (bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, (bit % 8).cast("int")) == 1


def parts_that_may_hold(spark: SparkSession, path: str, pointer: Pointer, batch: DataFrame, keys: list[str],
                        parts: list[str]) -> list[str]:
    """Of ``parts`` those whose filter passes a key of the batch.  Reads the
    filters of these parts only; a partition without one always may."""
    known = {p: pointer.parts[p] for p in parts if "blocks" in pointer.parts[p]}
    sure = [p for p in parts if p not in known]
    if not known:
        return sorted(sure)
    folders = sorted({f"{path}/keys/{e['write']}" for e in known.values()})
    filters = spark.read.parquet(*folders).where(F.col(PART).isin(sorted(known)))
    wanted = spark.createDataFrame([(p, e["write"]) for p, e in known.items()], f"{PART} string, made string")
    # a partition that several kept writes have made counts with its current one
    filters = filters.withColumn("made", F.element_at(F.split(F.input_file_name(), "/"), -2)) \
        .join(wanted, [PART, "made"], "left_semi") if len(folders) > 1 else filters
    sizes = sorted({e["blocks"] for e in known.values()})
    probe = batch.select(*keys).dropna().withColumn("blocks", F.explode(F.array(*[F.lit(b) for b in sizes])))
    block, bits = _block_and_bits(keys, F.col("blocks"))
    probe = probe.select("blocks", block.cast("int").alias("block"), *[b.alias(f"b{i}") for i, b in enumerate(bits)]).distinct()
    passed = filters.join(probe, ["blocks", "block"])
    for i in range(PROBES):
        passed = passed.where(_has(F.col(f"b{i}")))
    return sorted(sure + [r[0] for r in passed.select(PART).distinct().collect()])


def lookback_filter(batch: DataFrame, target: DataFrame | None, ts_col: str,
                    lookback_days: int = 3, mark=None) -> DataFrame:
    """Keep batch rows with ``ts_col >= max(target.ts_col) - lookback_days``.

    ``mark`` gives the maximum where it is known.  The bound becomes a
    literal, so it reaches the scan as a pushed filter.  Without a target, or
    with an empty one, the whole batch is kept.
    """
    if target is None and mark is None:
        return batch
    hw = high_water_mark(target, ts_col) if mark is None else mark
    if hw is None:
        return batch
    bound = hw - dt.timedelta(days=lookback_days)
    lit = F.lit(bound)
    dtype = dict(batch.dtypes)[ts_col]
    if dtype in ("timestamp", "timestamp_ntz"):
        lit = F.lit(bound.isoformat(sep=" ")).cast(dtype)
    elif dtype == "date":
        lit = F.lit(bound).cast("date")
    return batch.filter(F.col(ts_col) >= lit)


def merge_keyed(target: DataFrame, batch: DataFrame, key: str | list[str]) -> DataFrame:
    """Delete target rows whose key is in ``batch``, then insert ``batch``.

    The batch keys go to the anti join as a key-only projection; when the
    batch is small AQE turns the join into a broadcast from measured sizes,
    otherwise it is a shuffle join on the key.
    """
    keys = [key] if isinstance(key, str) else list(key)
    kept = target.join(batch.select(*keys), keys, "left_anti")
    return kept.unionByName(batch)


def repeated_keys(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Keys (without a null) that several rows hold, with their number."""
    return rows.select(*keys).dropna().groupBy(*keys).agg(F.count(F.lit(1)).alias("n_records")).where("n_records > 1")


def read_repeated(spark: SparkSession, path: str, keys: list[str]) -> DataFrame | None:
    """The kept repeated keys of the table (``n_records`` rows each); None where
    the table keeps none."""
    pointer = committed.current(spark, path)
    if pointer is None or not pointer.repeated:
        return None
    schema = StructType([pointer.schema[k] for k in keys]).add("n_records", LongType())
    return spark.read.schema(schema).parquet(f"{path.rstrip('/')}/repeated/{pointer.repeated}")


def kept_counts(spark: SparkSession, path: str, names: list[str]) -> dict[str, int] | None:
    """Sums over the table of the counts kept with its partitions; None where a
    partition lacks one."""
    pointer = committed.current(spark, path)
    if pointer is None or any(n not in e.get("counts", {}) for e in pointer.parts.values() for n in names):
        return None
    return {n: sum(e["counts"][n] for e in pointer.parts.values()) for n in names}


def _part_entries(df: DataFrame, write: str, ts_col: str | None, counts: dict[str, Column]) -> dict[str, dict]:
    """Pointer entries of a write's partitions: rows, mark and counts, in one scan
    (a row per table partition comes back)."""
    mark = F.max(ts_col).cast("string") if ts_col else F.lit(None).cast("string")
    own = df.groupBy(PART).agg(F.count(F.lit(1)).alias("n"), mark.alias("mark"),
                               *[F.count(F.when(c, 1)).alias(f"c{i}") for i, c in enumerate(counts.values())])
    return {r[PART]: {"write": write, "rows": r["n"], "mark": r["mark"], "mark_of": ts_col, "blocks": blocks_for(r["n"]),
                      "counts": {n: r[f"c{i}"] for i, n in enumerate(counts)}} for r in own.collect()}


def _put_filters(spark: SparkSession, path: str, write: str, schema: StructType, keys: list[str], ts_col: str | None,
                 counts: dict[str, Column]) -> dict[str, dict]:
    """Write the key filters of a write's partitions; their pointer entries."""
    made = Pointer(0, schema, {p: {"write": write} for p in committed.written_parts(spark, path, write)})
    if not made.parts:
        return {}
    df = committed.read_parts(spark, path, made, with_part=True)
    entries = _part_entries(df, write, ts_col, counts)
    key_filters(df, keys, {p: e["blocks"] for p, e in entries.items()}) \
        .write.mode("overwrite").parquet(f"{path}/keys/{write}")
    return entries


def _put_repeated(spark: SparkSession, path: str, write: str, repeated: DataFrame) -> str:
    repeated.write.mode("overwrite").parquet(f"{path}/repeated/{write}")
    return write


def upsert_table(spark: SparkSession, batch: DataFrame, path: str, key: str | list[str], *,
                 ts_col: str | None = None, lookback_days: int = 3,
                 partition_by: list[str] | None = None, full_refresh: bool = False, filtered: bool = False,
                 counts: dict[str, Column] | None = None) -> dict:
    """Apply ``batch`` to the committed table at ``path``.

    * first load or ``full_refresh``: the (whole) batch replaces the table;
    * otherwise filter the batch by the lookback window (unless ``filtered``
      says that it is) and write anew only the partitions that it touches: its
      own, plus those holding older versions of its keys.

    The batch is staged once (the model is computed once, and lineage is cut).
    Rows, key filters and repeated keys go to folders of their own; the pointer
    commits them together, and only then are replaced folders removed.
    ``counts``: conditions whose rows are counted per table partition, and kept
    (:func:`kept_counts`): a run counts only in the partitions that it writes.
    Returns a small summary: ``mode``, ``partitions`` (ids written or emptied)
    and ``read`` (ids of old partitions whose rows were read).
    """
    keys = [key] if isinstance(key, str) else list(key)
    parts, path, counts = list(partition_by or []), path.rstrip("/"), dict(counts or {})
    pointer, write = committed.current(spark, path), committed.new_write()
    old_files = pointer is None and committed.is_table(spark, path)  # a table of plain files
    if full_refresh or (pointer is None and not old_files):
        committed.put_rows(batch.withColumn(PART, committed.part_id(parts)), path, write, parts)
        entries = _put_filters(spark, path, write, batch.schema, keys, ts_col, counts)
        new = Pointer(pointer.number + 1 if pointer else 1, batch.schema, entries, parts)
        new.repeated = _put_repeated(spark, path, write, repeated_keys(committed.read_parts(spark, path, new), keys))
        committed.point(spark, path, new)
        committed.clean(spark, path)
        return {"mode": "full", "partitions": None, "read": []}
    if old_files:  # commit the files' rows first, then go on as always
        upsert_table(spark, spark.read.parquet(path), path, key, ts_col=ts_col, partition_by=parts, full_refresh=True,
                     counts=counts)
        return upsert_table(spark, batch, path, key, ts_col=ts_col, lookback_days=lookback_days, partition_by=parts,
                            filtered=filtered, counts=counts)

    if ts_col and not filtered:
        batch = lookback_filter(batch, None, ts_col, lookback_days, committed_mark(spark, path, ts_col))
    staging = f"{path}/staging/{write}"
    batch.withColumn(PART, committed.part_id(parts)).write.mode("overwrite").parquet(staging)
    staged = spark.read.schema(_with_part(batch.schema)).parquet(staging)
    own = {r[0] for r in staged.select(PART).distinct().collect()}  # a row per table partition
    if not own:  # nothing new inside the window: leave the table alone
        delete_path(spark, staging)
        return {"mode": "incremental", "partitions": [], "read": []}

    may = parts_that_may_hold(spark, path, pointer, staged, keys, sorted(set(pointer.parts) - own))
    held = set()
    if may:
        rows = committed.read_parts(spark, path, pointer, may, with_part=True)
        held = {r[0] for r in rows.join(staged.select(*keys), keys, "left_semi").select(PART).distinct().collect()}
    touched = sorted(own | held)
    read = sorted(set(touched) & set(pointer.parts))
    old = committed.read_parts(spark, path, pointer, read, with_part=True)
    columns = [f.name for f in pointer.schema.fields]
    merged = merge_keyed(old.select(*columns, PART), staged.select(*columns, PART), keys)
    committed.put_rows(merged, path, write, parts)
    entries = _put_filters(spark, path, write, pointer.schema, keys, ts_col, counts)
    before = read_repeated(spark, path, keys)
    if before is None:
        before = repeated_keys(committed.read_parts(spark, path, pointer), keys)
    state = _put_repeated(spark, path, write, merge_repeated(before, staged, keys))
    stay = {p: e for p, e in pointer.parts.items() if p not in set(touched)}
    committed.point(spark, path, Pointer(pointer.number + 1, pointer.schema, {**stay, **entries}, parts, state))
    committed.clean(spark, path)
    return {"mode": "incremental", "partitions": touched, "read": read}


def merge_repeated(before: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """Repeated keys after an upsert: the batch decides for its keys, all others
    stay as they were."""
    stay = before.join(batch.select(*keys), keys, "left_anti")
    return stay.unionByName(repeated_keys(batch, keys))


def _with_part(schema: StructType) -> StructType:
    return StructType([*schema.fields]).add(PART, StringType())
