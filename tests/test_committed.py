"""Committed tables: a run that dies at any step loses no row; marks, key filters
and repeated keys follow random upserts without a scan of history."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from stratum.operators import upsert
from stratum.operators.quality import Unique
from stratum.operators.upsert import committed_mark, high_water_mark, read_repeated, upsert_table
from stratum.sources import committed
from stratum.sources.committed import current, read_table, replace_table

SCHEMA = "id int, ts date, v string, month string"
D = dt.date


def rows(spark, items):
    return spark.createDataFrame([(i, d, v, d.strftime("%Y-%m") if d else None) for i, d, v in items], SCHEMA)


def held(spark, path):
    return sorted((r.id, r.v) for r in read_table(spark, path).collect())


FIRST = [(1, D(2018, 1, 5), "a"), (2, D(2018, 2, 1), "b"), (3, D(2018, 3, 1), "c")]
BATCH = [(1, D(2018, 3, 2), "a2"), (4, D(2018, 3, 20), "d")]     # id 1 leaves January, which becomes empty
AFTER = [(1, "a2"), (2, "b"), (3, "c"), (4, "d")]

# every step of a run, in order; the last one comes after the commit
STEPS = [(committed, "put_rows"), (upsert, "parts_that_may_hold"), (committed, "written_parts"),
         (upsert, "_put_filters"), (upsert, "_put_repeated"), (committed, "point"), (committed, "clean")]


@pytest.mark.parametrize("step, late, parts", [*((s, False, ["month"]) for s in range(len(STEPS))),
                                               (0, True, ["month"]), (3, True, None), (5, True, ["month"])])
def test_a_run_that_dies_loses_nothing(spark, tmp, monkeypatch, step, parts, late):
    """``late``: the step's work is done before the run dies, else it dies first."""
    path = f"{tmp}/t"
    upsert_table(spark, rows(spark, FIRST), path, "id", ts_col="ts", partition_by=parts)
    module, name = STEPS[step]
    real = getattr(module, name)

    def dies(*a, **kw):
        if late:
            real(*a, **kw)
        raise RuntimeError("killed")
    with monkeypatch.context() as m:
        m.setattr(module, name, dies)
        with pytest.raises(RuntimeError, match="killed"):
            upsert_table(spark, rows(spark, BATCH), path, "id", ts_col="ts", partition_by=parts)
    done = name == "clean" or (name == "point" and late)
    assert held(spark, path) == (AFTER if done else [(1, "a"), (2, "b"), (3, "c")])
    assert committed_mark(spark, path, "ts") == (D(2018, 3, 20) if done else D(2018, 3, 1))
    upsert_table(spark, rows(spark, BATCH), path, "id", ts_col="ts", partition_by=parts)
    assert held(spark, path) == AFTER and committed_mark(spark, path, "ts") == D(2018, 3, 20)
    # nothing is left behind but the last two versions
    files = {os.path.relpath(os.path.join(d, f), path) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}
    kept = [committed._read_pointer(spark, path, n).writes() for n in committed._numbers(spark, path)]
    needed = {f"{kind}/{name}" for w in kept for kind, name in w}
    assert len(kept) == 2 and files and all(any(f.startswith(n + "/") for n in needed) for f in files)


@pytest.mark.parametrize("name", ["put_rows", "written_parts", "point", "clean"])
def test_full_replace_that_dies(spark, tmp, monkeypatch, name):
    path = f"{tmp}/t"
    replace_table(rows(spark, FIRST), path)
    with monkeypatch.context() as m:
        m.setattr(committed, name, lambda *a, **kw: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError):
            replace_table(rows(spark, BATCH), path)
    assert held(spark, path) == ([(1, "a2"), (4, "d")] if name == "clean" else [(1, "a"), (2, "b"), (3, "c")])
    replace_table(rows(spark, BATCH).limit(0), path)
    assert read_table(spark, path).columns == ["id", "ts", "v", "month"] and held(spark, path) == []


def test_a_job_that_fails_in_its_tasks_leaves_the_old_rows(spark, tmp):
    path = f"{tmp}/t"
    upsert_table(spark, rows(spark, FIRST), path, "id", ts_col="ts")
    bad = rows(spark, BATCH).withColumn("v", F.when(F.col("id") == 4, F.raise_error(F.lit("bad cell"))).otherwise(F.col("v")))
    for full in (False, True):
        with pytest.raises(Exception, match="bad cell"):
            upsert_table(spark, bad, path, "id", ts_col="ts", full_refresh=full)
        assert held(spark, path) == [(1, "a"), (2, "b"), (3, "c")]


def test_two_writers_cannot_commit_the_same_number(spark, tmp):
    path = f"{tmp}/t"
    replace_table(rows(spark, FIRST), path)
    old = current(spark, path)
    replace_table(rows(spark, BATCH), path)
    with pytest.raises(RuntimeError, match="another writer"):
        committed.point(spark, path, committed.Pointer(old.number + 1, old.schema, old.parts))
    assert held(spark, path) == [(1, "a2"), (4, "d")]


def test_plain_files_are_taken_over(spark, tmp):
    path = f"{tmp}/plain"
    rows(spark, FIRST).write.parquet(path)
    assert held(spark, path) == [(1, "a"), (2, "b"), (3, "c")]
    upsert_table(spark, rows(spark, BATCH), path, "id", ts_col="ts", partition_by=["month"])
    assert held(spark, path) == AFTER


def model_upsert(table, batch, mark):
    """The rule itself, on a list."""
    bound = mark - dt.timedelta(days=40)
    batch = [r for r in batch if r[1] is not None and r[1] >= bound]
    keys = {r[0] for r in batch}
    return [r for r in table if r[0] not in keys] + batch


def test_random_upserts(spark, tmp):
    """Rows, mark, repeated keys and the partitions read, over random batches
    with repeated keys inside them and keys that change their month."""
    rng = random.Random(8)
    path = f"{tmp}/t"

    def some(n, lo, hi, days):
        return [(rng.randint(lo, hi), D(2019, 1, 1) + dt.timedelta(days=rng.choice(days)), f"v{rng.random():.6f}")
                for _ in range(n)]
    table = some(60, 1, 45, range(300))
    upsert_table(spark, rows(spark, table), path, "id", ts_col="ts", partition_by=["month"])
    for k in range(5):
        mark = max(r[1] for r in table)
        assert committed_mark(spark, path, "ts") == mark == high_water_mark(read_table(spark, path), "ts")
        batch = some(8, 1, 90, range(250 + 10 * k, 310 + 10 * k))
        before = table
        odd = {"odd": F.col("id") % 2 == 1, "late": F.col("ts") > D(2019, 6, 1)}
        info = upsert_table(spark, rows(spark, batch), path, "id", ts_col="ts", lookback_days=40, partition_by=["month"],
                            counts=odd if k else {})
        table = model_upsert(table, batch, mark)
        if k == 0:   # what no run has counted is not there
            assert upsert.kept_counts(spark, path, ["odd"]) is None
            upsert_table(spark, rows(spark, table), path, "id", ts_col="ts", partition_by=["month"], full_refresh=True,
                         counts=odd)
        assert upsert.kept_counts(spark, path, ["odd", "late"]) == {
            "odd": sum(r[0] % 2 for r in table), "late": sum(r[1] > D(2019, 6, 1) for r in table)}
        assert held(spark, path) == sorted((r[0], r[2]) for r in table)
        full = Unique("u", ["id"]).rows(read_table(spark, path))
        kept = read_repeated(spark, path, ["id"])
        assert sorted(map(tuple, kept.collect())) == sorted(map(tuple, full.collect()))
        # old partitions that were read: the batch's months, and those that held its keys
        if k == 0:
            continue
        new = [r for r in table if r not in before]
        months = {r[1].strftime("%Y-%m") for r in new} | {r[1].strftime("%Y-%m") for r in before
                                                          if r[0] in {x[0] for x in new}}
        ids = {r.p for r in rows(spark, before).where(F.col("month").isin(sorted(months)))
               .select(committed.part_id(["month"]).alias("p")).collect()}
        assert set(info["read"]) == ids


def test_only_partitions_that_may_match_are_read(spark, tmp, monkeypatch):
    path = f"{tmp}/t"
    months = [(i, D(2019, 1 + i % 12, 3), "x") for i in range(24_000)]
    upsert_table(spark, rows(spark, months), path, "id", ts_col="ts", partition_by=["month"])
    asked, files = [], []
    real = committed.read_parts

    def spy(s, p, pointer, parts=None, with_part=False):
        df = real(s, p, pointer, parts, with_part)
        if parts is not None:
            asked.append(sorted(parts))
            files.extend(df.inputFiles())
        return df
    with monkeypatch.context() as m:
        m.setattr(committed, "read_parts", spy)
        # key 14 moves from March to December; 100,000 and on are new
        batch = [(14, D(2019, 12, 30), "moved")] + [(100_000 + i, D(2019, 12, 28), "new") for i in range(2000)]
        info = upsert_table(spark, rows(spark, batch), path, "id", ts_col="ts", partition_by=["month"])
    assert len(info["read"]) == 2 and len(info["partitions"]) == 2
    # candidates: March, and no month that only a filter's chance lets through
    assert [len(a) for a in asked] == [1, 2]
    assert len({f.split("__part=")[1].split("/")[0] for f in files}) == 2
    got = {r.id: r.v for r in read_table(spark, path).collect()}
    assert got[14] == "moved" and len(got) == 26_000


def test_filters_pass_every_key_and_few_others(spark, tmp):
    path = f"{tmp}/t"
    df = spark.range(20_000).select(F.col("id").cast("int").alias("id"), F.lit(D(2019, 1, 1)).alias("ts"),
                                    F.lit("x").alias("v"), F.lit("m").alias("month"))
    upsert_table(spark, df, path, "id", ts_col="ts", partition_by=["month"])
    pointer = current(spark, path)
    part = list(pointer.parts)
    assert pointer.parts[part[0]]["rows"] == 20_000 and pointer.parts[part[0]]["blocks"] == 128
    assert upsert.parts_that_may_hold(spark, path, pointer, df.where("id % 1000 = 7"), ["id"], part) == part
    filters = spark.read.parquet(f"{path}/keys/{pointer.parts[part[0]]['write']}")
    assert filters.agg(F.sum(F.bitmap_count("bitmap"))).first()[0] > 78_000      # four bits per key, few shared
    strange = spark.range(1_000_000, 1_030_000).select(F.col("id").cast("int").alias("id"))
    assert upsert.parts_that_may_hold(spark, path, pointer, strange, ["id"], part) == []
    nulls = spark.createDataFrame([(None,)], "id int")
    assert upsert.parts_that_may_hold(spark, path, pointer, nulls, ["id"], part) == []
