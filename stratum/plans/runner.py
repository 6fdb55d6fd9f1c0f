"""Build the warehouse: models in order, checks after each layer, gating.

``run`` goes through :data:`stratum.plans.warehouse.MODELS` layer by layer;
within a layer independent models are built at the same time (``workers`` threads
submit jobs, in a fair pool each), a model after those of its layer that it reads:

* ``table`` models are written (full replace) and re-read, which also cuts
  the lineage for everything downstream;
* ``view`` / ``ephemeral`` models stay lazy DataFrames that Catalyst inlines
  into their consumers, unless the run would compute one more than once (it has
  several consumers, checks among them): such a view is written once to scratch
  and read from there (:func:`shared_views`);
* ``incremental`` models take the lookback-window batch and are upserted on
  their unique key, or rebuilt with ``full_refresh=True``.

A model's checks run after it is built and their report is written; an
``error`` status blocks the models downstream of it.  Row-level checks of what
is written are counted by the job that writes it; an incremental model's row-level
counts and the uniqueness of its key come from the state that its table keeps; orphan checks are made
once per parent at the end of a layer, unless a model of that layer reads the
checked one.  Freshness is separate and never blocks.
"""

from __future__ import annotations

import datetime as dt
import threading
import time
import uuid
from collections import defaultdict
from collections.abc import Iterable
from concurrent.futures import Future, ThreadPoolExecutor
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.operators.freshness import freshness_report
from stratum.operators.quality import (QualityError, RatioConsistency, Relationships, Skipped, evaluate,
                                       observed, observed_report, orphan_report, report_of, row_level)
from stratum.operators.upsert import committed_mark, kept_counts, read_repeated, upsert_table
from stratum.session import apply_defaults, delete_path, path_exists, scratch_path
from stratum.sources.committed import is_table, read_table
from stratum.sources.config import LAYERS, PipelineConfig
from stratum.sources.ingest import load_csvs, read_source
from stratum.sources.seeds import SEEDS, load_seed, seed_frame
from stratum.sources.sinks import write_table
from stratum.sources.specs import ALL_SOURCES, MARKETPLACE, STATE_STATS
from stratum.plans.warehouse import MODEL_INDEX, MODELS, SOURCE_CHECKS, Model


class Blocked(Exception):
    """A model reads a source or model whose checks failed."""


class BuildContext:
    def __init__(self, spark: SparkSession, cfg: PipelineConfig, building: set[str]):
        self.spark = spark
        self.cfg = cfg
        self.building = building
        self.frames: dict[str, DataFrame] = {}
        self.seeds: dict[str, DataFrame] = {}
        self.shared: set[str] = set()    # views that are written once for the run
        self.scratch: list[str] = []
        self.seen: dict[str, tuple] = {}  # row-level checks counted while their model was written
        self.locks: defaultdict[str, threading.RLock] = defaultdict(threading.RLock)  # one builder per model
        self.guard = threading.Lock()
        self.failed: set[str] = set()    # sources (``source.x``) and models whose checks failed
        self.skipped: set[str] = set()   # models that read one of those, directly or not

    def lock(self, name: str) -> threading.RLock:
        with self.guard:
            return self.locks[name]

    def source(self, name: str) -> DataFrame:
        if f"source.{name}" in self.failed:
            raise Blocked(f"source.{name}")
        return read_source(self.spark, self.cfg, ALL_SOURCES[name])

    def seed(self, name: str) -> DataFrame:
        with self.lock(f"seed.{name}"):
            if name not in self.seeds:
                self.seeds[name] = load_seed(self.spark, SEEDS[name], self.cfg.seeds_dir)
            return self.seeds[name]

    def path(self, m: Model) -> str:
        return self.cfg.model_path(m.layer, m.name)

    def ref(self, name: str) -> DataFrame:
        if name in self.failed or name in self.skipped:
            raise Blocked(name)
        with self.lock(name):
            return self._frame(name)

    def _frame(self, name: str) -> DataFrame:
        if name in self.frames:
            return self.frames[name]
        m = MODEL_INDEX[name]
        if m.materialized in ("table", "incremental") and name not in self.building:
            p = self.path(m)
            if not is_table(self.spark, p):
                raise FileNotFoundError(f"model {name} is not built yet ({p}); include it in the selection")
            df = _read_model(self, m)
        else:
            df = m.fn(self)
            if name in self.shared:
                path = scratch_path(self.spark, f"view-{name}")
                self.scratch.append(path)
                schema = df.schema
                self.observe(m, df).write.mode("overwrite").parquet(path)
                df = self.spark.read.schema(schema).parquet(path)
        self.frames[name] = df
        return df

    def ref_with(self, name: str, **kw) -> DataFrame:
        """A view model built with extra arguments (e.g. pruned unpivot years)."""
        if name in self.failed or name in self.skipped:
            raise Blocked(name)
        return MODEL_INDEX[name].fn(self, **kw)

    def observe(self, m: Model, df: DataFrame) -> DataFrame:
        """``df``, with the model's row-level checks counted when it is written."""
        checks = row_level(m.checks(self)) if m.checks is not None and m.name in self.building else []
        df, seen = observed(df, checks)
        if seen is not None:
            self.seen[m.name] = (seen, checks)
        return df

    def close(self) -> None:
        for path in self.scratch:
            delete_path(self.spark, path)


@dataclass
class RunResult:
    run_id: str
    built: list[str] = field(default_factory=list)
    reports: list[DataFrame] = field(default_factory=list)
    skipped: list[str] = field(default_factory=list)   # blocked by a failed check upstream
    incremental: dict = field(default_factory=dict)
    seconds: dict = field(default_factory=dict)

    def report(self) -> DataFrame | None:
        out = None
        for r in self.reports:
            out = r if out is None else out.unionByName(r)
        return out


def selection(select: Iterable[str] | None = None, exclude: Iterable[str] | None = None) -> list[Model]:
    """Models matching names, layers (``bronze``, ``silver`` = both silver
    layers, ``gold``), tags or a materialisation (``incremental``)."""
    if select is None:
        chosen = list(MODELS)
    else:
        sel = set(select)
        if "silver" in sel:
            sel |= {"silver_staging", "silver_intermediate"}
        chosen = [m for m in MODELS if m.name in sel or m.layer in sel or sel & set(m.tags) or m.materialized in sel]
    ex = set(exclude or [])
    return [m for m in chosen if m.name not in ex and m.layer not in ex]


def ingest(spark: SparkSession, cfg: PipelineConfig, marketplace_dir: str, state_stats_dir: str,
           filenames: dict[str, str] | None = None) -> list[str]:
    """Load both raw catalogs (CSV -> parquet under ``cfg.source_base``);
    ``filenames`` maps table names to the drop's file names when they are not
    ``{name}.csv``."""
    return (load_csvs(spark, cfg, marketplace_dir, MARKETPLACE, filenames)
            + load_csvs(spark, cfg, state_stats_dir, STATE_STATS, filenames))


def _with_layout(m: Model, df: DataFrame) -> DataFrame:
    for name, expr in m.partition_cols.items():
        df = df.withColumn(name, expr())
    return df


def _read_model(ctx: BuildContext, m: Model) -> DataFrame:
    df = read_table(ctx.spark, ctx.path(m))
    return df.drop(*m.partition_cols) if m.partition_cols else df


def _check_key(check) -> str:
    return f"{check.name}({check.column})"


def _build_incremental(ctx: BuildContext, m: Model, full_refresh: bool) -> dict:
    path = ctx.path(m)
    counts = {_check_key(c): c.violation() for c in row_level(m.checks(ctx) if m.checks is not None else [])}
    how = {"ts_col": m.lookback_col, "partition_by": m.partition_by, "counts": counts}
    hw = committed_mark(ctx.spark, path, m.lookback_col) if is_table(ctx.spark, path) and not full_refresh else None
    if hw is None:  # no target, or an empty one: first load (documented deviation)
        df = _with_layout(m, m.fn(ctx))
        return {**upsert_table(ctx.spark, df, path, m.unique_key, full_refresh=True, **how), "since": None}
    since = hw - dt.timedelta(days=m.lookback_days)
    since_lit = F.lit(since.isoformat(sep=" ") if isinstance(since, dt.datetime) else since.isoformat())
    since_col = since_lit.cast("timestamp_ntz") if isinstance(since, dt.datetime) else since_lit.cast("date")
    batch = _with_layout(m, m.fn(ctx, since=since_col))
    info = upsert_table(ctx.spark, batch, path, m.unique_key, filtered=True, **how)
    return {**info, "since": str(since)}


def run(spark: SparkSession, cfg: PipelineConfig, select: Iterable[str] | None = None,
        exclude: Iterable[str] | None = None, full_refresh: bool = False, gate: bool = True,
        source_checks: bool = True, workers: int = 6) -> RunResult:
    """Build the selected models.  ``full_refresh`` rebuilds incremental
    models from scratch (other models are always rebuilt).

    With ``gate`` a failed check blocks what depends on its model and nothing
    else: models that read it, directly or over others, are skipped, all other
    branches are built, and the run then raises :class:`QualityError` with
    every failed check.
    """
    apply_defaults(spark)
    models = selection(select, exclude)
    ctx = BuildContext(spark, cfg, {m.name for m in models})
    graph = model_graph(spark)
    ctx.shared = shared_views(models, graph)
    res = RunResult(run_id=uuid.uuid4().hex[:12])
    bad: list[str] = []
    try:
        if source_checks and any(m.layer == "bronze" for m in models):
            bad += _publish(spark, cfg, res, "sources", _source_report(ctx), ctx if gate else None)
        for layer in LAYERS:
            own = [m for m in models if m.layer == layer]
            # a model that none of its layer reads may have its orphans counted at the layer's end
            read_here = {r for m in own for r in graph[m.name].models}
            reports, orphans = [], []

            def build(m: Model, earlier: dict[str, Future]) -> None:
                spark.sparkContext.setLocalProperty("spark.scheduler.pool", m.name)
                # only models of the layer that were started before are waited for, so none wait for each other
                for name in earlier.keys() & (graph[m.name].models | set(graph[m.name].checks)):
                    earlier[name].result()
                t0 = time.perf_counter()
                try:
                    _build(ctx, m, res, full_refresh)
                except Blocked:
                    ctx.skipped.add(m.name)
                    res.skipped.append(m.name)
                    return
                res.built.append(m.name)
                rep, later = _check(ctx, m, defer=m.name not in read_here)
                orphans.extend(later)
                if rep is not None and gate:  # decided before anything reads the model
                    bad.extend(_publish(spark, cfg, res, f"{layer}/{m.name}", rep, ctx))
                elif rep is not None:
                    reports.append(rep)
                res.seconds[m.name] = round(time.perf_counter() - t0, 3)
            with ThreadPoolExecutor(max(1, workers)) as pool:
                started: dict[str, Future] = {}
                for m in own:
                    started[m.name] = pool.submit(build, m, dict(started))
            for f in started.values():
                f.result()
            if orphans:
                rep = orphan_report(orphans)
                if gate:
                    bad += _publish(spark, cfg, res, f"{layer}/orphans", rep, ctx)
                else:
                    reports.append(rep)
            if reports:
                rep = reports[0]
                for r in reports[1:]:
                    rep = rep.unionByName(r)
                _publish(spark, cfg, res, layer, rep, None)
    finally:
        ctx.close()
    order = {m.name: i for i, m in enumerate(MODELS)}
    res.built.sort(key=order.get)
    res.skipped.sort(key=order.get)
    if bad:
        bad.sort()
        raise QualityError(f"failed checks: {', '.join(bad)}; not built: {', '.join(res.skipped) or 'none'}")
    return res


def _build(ctx: BuildContext, m: Model, res: RunResult, full_refresh: bool) -> None:
    if m.materialized == "table":
        write_table(ctx.observe(m, _with_layout(m, m.fn(ctx))), ctx.path(m), m.partition_by)
        ctx.frames[m.name] = _read_model(ctx, m)
    elif m.materialized == "incremental":
        res.incremental[m.name] = _build_incremental(ctx, m, full_refresh)
        ctx.frames[m.name] = _read_model(ctx, m)
    else:
        ctx.ref(m.name)


def _resolved(check):
    """The check with the frame that it compares with; skipped where that one's
    rows are not to be relied on."""
    try:
        if isinstance(check, Relationships):
            return replace(check, parent=check.parent())
        if isinstance(check, RatioConsistency) and check.join_to is not None:
            return replace(check, join_to=check.join_to())
    except Blocked:
        return Skipped(check.name, check.column, check.severity)
    return check


def _check(ctx: BuildContext, m: Model, defer: bool) -> tuple[DataFrame | None, list[tuple]]:
    """The model's report, and the (table, frame, check) orphan checks to be made
    at the end of the layer."""
    checks = [_resolved(c) for c in (m.checks(ctx) if m.checks is not None else [])]
    df = ctx.frames[m.name]
    later = [(m.name, df, c) for c in checks if isinstance(c, Relationships)] if defer else []
    left = [c for c in checks if not (defer and isinstance(c, Relationships))]
    rep = None
    if m.name in ctx.seen:
        seen, flat = ctx.seen[m.name]
        rep = observed_report(ctx.spark, seen, flat, m.name)
        left = [c for c in left if c not in row_level(left)]
    kept = {}
    if m.materialized == "incremental":
        flat = row_level(left)
        sums = kept_counts(ctx.spark, ctx.path(m), [_check_key(c) for c in flat])
        if flat and sums is not None:
            rep = report_of(ctx.spark, [(c, sums[_check_key(c)]) for c in flat], m.name)
            left = [c for c in left if c not in flat]
        own = read_repeated(ctx.spark, ctx.path(m), [m.unique_key])
        kept = {} if own is None else {(m.unique_key,): own}
    rest = evaluate(df, left, m.name, repeated=kept)
    return (rest if rep is None else rep if rest is None else rep.unionByName(rest)), later


def _source_report(ctx: BuildContext) -> DataFrame | None:
    out = None
    for name, mk in SOURCE_CHECKS.items():
        r = evaluate(ctx.source(name), mk(ctx), f"source.{name}")
        out = r if out is None else out.unionByName(r)
    return out


def _publish(spark, cfg, res: RunResult, part: str, rep: DataFrame | None, gated: BuildContext | None) -> list[str]:
    """Write a report (small); when gating, note and return what failed."""
    if rep is None:
        return []
    path = cfg.report_path(f"{res.run_id}/{part}")
    rep.coalesce(1).write.mode("overwrite").parquet(path)
    rep = spark.read.parquet(path)
    res.reports.append(rep)
    if gated is None:
        return []
    bad = rep.filter(F.col("status") == "error").collect()
    gated.failed.update(r.table_name for r in bad)
    return [f"{r.table_name}.{r.check_name}={r.violations}" for r in bad]


def freshness(spark: SparkSession, cfg: PipelineConfig, as_of: dt.datetime) -> DataFrame | None:
    """Freshness of every source with a policy (warn/error never block)."""
    known = [s for s in ALL_SOURCES.values() if s.freshness is not None and s.loaded_at]
    there = [s for s in known if path_exists(spark, cfg.source_path(s.namespace, s.name))]
    rep = freshness_report([(s.name, read_source(spark, cfg, s), s.loaded_at, s.freshness) for s in there], as_of)
    missing = [(s.name, None, "error") for s in known if s not in there]
    if missing:  # reported like an empty source
        none = spark.createDataFrame(missing, "source_name string, max_loaded_at timestamp_ntz, status string")
        rep = none if rep is None else rep.unionByName(none)
    return rep


@dataclass
class Reads:
    """What a model reads: by its function, and by its checks (a name per check);
    ``jobs``: passes over the model itself that its checks make."""
    models: set[str] = field(default_factory=set)
    checks: list[str] = field(default_factory=list)
    jobs: int = 0


_GRAPH: dict[str, Reads] = {}


def model_graph(spark: SparkSession) -> dict[str, Reads]:
    """Who reads what, noted while every model is planned once over empty tables
    (no job runs; once per process)."""
    if not _GRAPH:
        ctx = _Noting(spark)
        for m in MODELS:
            ctx.ref(m.name)
            checks = m.checks(ctx) if m.checks is not None else []
            ctx.at.append(None)
            for c in checks:
                before = len(ctx.loose)
                _resolved(c)
                ctx.graph[m.name].checks += ctx.loose[before:]
            ctx.at.pop()
            ctx.graph[m.name].jobs = bool(row_level(checks)) + len(checks) - len(row_level(checks))
        _GRAPH.update(ctx.graph)
    return _GRAPH


def shared_views(models: list[Model], graph: dict[str, Reads]) -> set[str]:
    """Views that building and checking ``models`` would compute more than once."""
    needed, todo = set(), [m.name for m in models]
    while todo:  # the models and the views below them
        name = todo.pop()
        if name not in needed:
            needed.add(name)
            todo += [r for r in graph[name].models if MODEL_INDEX[r].materialized in ("view", "ephemeral")]
    chosen = {m.name for m in models}
    uses: dict[str, int] = {}

    def of(name: str) -> int:
        if name not in uses:
            n = graph[name].jobs if name in chosen else 0
            n += sum(graph[c].checks.count(name) for c in chosen)
            for c in needed:
                if name in graph[c].models:
                    # an inlined view is computed whenever its own consumers are
                    n += of(c) if MODEL_INDEX[c].materialized in ("view", "ephemeral") and of(c) < 2 else 1
            uses[name] = n
        return uses[name]
    return {n for n in needed if MODEL_INDEX[n].materialized in ("view", "ephemeral") and of(n) >= 2}


class LazyContext(BuildContext):
    """Resolve every model as a lazy DataFrame over given source frames (no
    writes): the whole model graph becomes one Catalyst plan per output."""

    def __init__(self, spark: SparkSession, sources, seeds=None):
        super().__init__(spark, PipelineConfig(source_base="", target_base=""), {m.name for m in MODELS})
        self._sources = sources
        self._seeds = seeds

    def source(self, name: str) -> DataFrame:
        return self._sources(name)

    def seed(self, name: str) -> DataFrame:
        if name not in self.seeds:
            df = self._seeds(name) if self._seeds is not None else None
            self.seeds[name] = df if df is not None else load_seed(self.spark, SEEDS[name], None)
        return self.seeds[name]

    def ref(self, name: str) -> DataFrame:
        if name not in self.frames:
            self.frames[name] = MODEL_INDEX[name].fn(self)
        return self.frames[name]


class _Noting(LazyContext):
    """Plans models over empty tables and notes what each one reads."""

    def __init__(self, spark: SparkSession):
        super().__init__(spark, lambda n: spark.createDataFrame([], ALL_SOURCES[n].schema),
                         lambda n: seed_frame(spark, [], SEEDS[n].schema.simpleString()[7:-1].replace(":", " "), SEEDS[n].key))
        self.graph: dict[str, Reads] = {m.name: Reads() for m in MODELS}
        self.at: list[str | None] = [None]
        self.loose: list[str] = []      # what checks read

    def _note(self, name: str) -> None:
        if self.at[-1] is None:
            self.loose.append(name)
        else:
            self.graph[self.at[-1]].models.add(name)

    def ref(self, name: str) -> DataFrame:
        self._note(name)
        if name not in self.frames:
            self.at.append(name)
            self.frames[name] = MODEL_INDEX[name].fn(self)
            self.at.pop()
        return self.frames[name]

    def ref_with(self, name: str, **kw) -> DataFrame:
        self._note(name)
        return MODEL_INDEX[name].fn(self, **kw)


# --------------------------------------------------------------------- jobs
def standard_job(spark: SparkSession, cfg: PipelineConfig, gate: bool = True) -> RunResult:
    """Build every model, incremental models incrementally, checks gating."""
    return run(spark, cfg, gate=gate)


def full_refresh_job(spark: SparkSession, cfg: PipelineConfig, gate: bool = True) -> RunResult:
    """Rebuild only the incremental models from scratch (drift repair)."""
    return run(spark, cfg, select=["incremental"], full_refresh=True, gate=gate, source_checks=False)


def freshness_job(spark: SparkSession, cfg: PipelineConfig, as_of: dt.datetime | None = None) -> DataFrame | None:
    """Source freshness report only; never blocks a build."""
    return freshness(spark, cfg, as_of or dt.datetime.now(dt.timezone.utc).replace(microsecond=0, tzinfo=None))
