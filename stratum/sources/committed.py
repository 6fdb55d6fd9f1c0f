"""Tables that are replaced as a whole or not at all.

A write puts its rows into a folder of its own and then adds a *pointer file*
that names the folders the table now consists of.  The pointer is written last
(under another name, then renamed) and read first, so a run that dies before it
leaves the table as it was, and one that dies after it has finished; what no
pointer names is removed by the next write.  Layout below a table's path::

    data/<write>/__part=<id>/*.parquet    rows, by table partition
    keys/<write>/                         key filters of those partitions (upserted tables)
    repeated/<write>/                     keys that several rows hold (upserted tables)
    pointer/<number>.json                 folders of every table partition; the largest number counts

The pointer before the current one is kept with its folders, so that a reader
that opened the table just before a write still finishes.  A pointer holds one
entry per table partition (days or months), no more.

One writer at a time: two that start from one pointer both name the next number,
and the rename of the later one fails.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from stratum.session import delete_path, hadoop_fs, path_exists

PART = "__part"
ALL = "all"          # the one partition of an unpartitioned table
KEPT_POINTERS = 2


@dataclass
class Pointer:
    number: int
    schema: StructType
    parts: dict[str, dict]              # partition id -> folder, values, rows, mark, blocks
    partition_by: list[str] = field(default_factory=list)
    repeated: str | None = None         # write that holds the repeated keys

    def folders(self, path: str, parts=None) -> list[str]:
        chosen = self.parts if parts is None else [p for p in self.parts if p in set(parts)]
        return [f"{path}/data/{self.parts[p]['write']}/{PART}={p}" for p in chosen]

    def writes(self) -> set[tuple[str, str]]:
        """(kind, folder name) of everything this pointer needs."""
        out = {("data", f"{e['write']}/{PART}={p}") for p, e in self.parts.items()}
        out |= {("keys", e["write"]) for e in self.parts.values()}
        if self.repeated:
            out.add(("repeated", self.repeated))
        return out


def _numbers(spark: SparkSession, path: str) -> list[int]:
    fs, p = hadoop_fs(spark, f"{path}/pointer")
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def _read_pointer(spark: SparkSession, path: str, number: int) -> Pointer:
    fs, p = hadoop_fs(spark, f"{path}/pointer/{number:08d}.json")
    stream = fs.open(p)
    try:
        body = json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()
    return Pointer(number, StructType.fromJson(body["schema"]), body["parts"], body["partition_by"], body["repeated"])


def current(spark: SparkSession, path: str) -> Pointer | None:
    """The table's pointer; None where nothing was committed."""
    path = path.rstrip("/")
    numbers = _numbers(spark, path)
    return _read_pointer(spark, path, numbers[-1]) if numbers else None


def new_write() -> str:
    return uuid.uuid4().hex[:16]


def clustered(df: DataFrame, partition_by: list[str] | None) -> DataFrame:
    """Cluster rows by table partition before they are written, so that each is
    written by few tasks (not one file per task and partition).  The
    ``rebalance`` hint lets AQE split a big partition and merge small ones."""
    return df.hint("rebalance", PART) if partition_by else df


def put_rows(df: DataFrame, path: str, write: str, partition_by: list[str] | None = None) -> None:
    """Write rows (with column ``__part``) into the folders of ``write``."""
    clustered(df, partition_by).write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(PART) \
        .parquet(f"{path.rstrip('/')}/data/{write}")


def part_id(partition_by: list[str] | None):
    """Column: the id of a row's table partition, from its values (null is one)."""
    if not partition_by:
        return F.lit(ALL)
    return F.md5(F.to_json(F.struct(*partition_by), {"ignoreNullFields": "false"}))


def point(spark: SparkSession, path: str, new: Pointer) -> None:
    """Make ``new`` the table's pointer: the commit."""
    path = path.rstrip("/")
    fs, folder = hadoop_fs(spark, f"{path}/pointer")
    fs.mkdirs(folder)
    name = f"{path}/pointer/{new.number:08d}"
    _, tmp = hadoop_fs(spark, f"{name}.{uuid.uuid4().hex[:8]}.tmp")
    _, final = hadoop_fs(spark, f"{name}.json")
    body = json.dumps({"schema": new.schema.jsonValue(), "parts": new.parts, "partition_by": new.partition_by,
                       "repeated": new.repeated})
    out = fs.create(tmp, True)
    try:
        out.write(bytearray(body.encode("utf-8")))
    finally:
        out.close()
    if fs.exists(final) or not fs.rename(tmp, final):
        fs.delete(tmp, False)
        raise RuntimeError(f"{path}: another writer has committed version {new.number}")


def clean(spark: SparkSession, path: str) -> None:
    """Remove what neither the current pointer nor the one before it names.
    Folders are listed once; nothing is read."""
    path = path.rstrip("/")
    numbers = _numbers(spark, path)
    kept = [_read_pointer(spark, path, n) for n in numbers[-KEPT_POINTERS:]]
    needed = set().union(*(p.writes() for p in kept)) if kept else set()
    for n in numbers[:-KEPT_POINTERS]:
        delete_path(spark, f"{path}/pointer/{n:08d}.json")
    for name in _names(spark, f"{path}/pointer"):
        if name.endswith(".tmp"):
            delete_path(spark, f"{path}/pointer/{name}")
    for kind in ("keys", "repeated"):
        for name in _names(spark, f"{path}/{kind}"):
            if (kind, name) not in needed:
                delete_path(spark, f"{path}/{kind}/{name}")
    whole = {folder.split("/")[0] for kind, folder in needed if kind == "data"}
    for write in _names(spark, f"{path}/data"):
        if write not in whole:
            delete_path(spark, f"{path}/data/{write}")
            continue
        for part in _names(spark, f"{path}/data/{write}"):
            if part.startswith(PART) and ("data", f"{write}/{part}") not in needed:
                delete_path(spark, f"{path}/data/{write}/{part}")
    delete_path(spark, f"{path}/staging")


def _names(spark: SparkSession, folder: str) -> list[str]:
    fs, p = hadoop_fs(spark, folder)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def written_parts(spark: SparkSession, path: str, write: str) -> list[str]:
    """Ids of the table partitions that a write has made, from its folders."""
    prefix = f"{PART}="
    return sorted(n[len(prefix):] for n in _names(spark, f"{path.rstrip('/')}/data/{write}") if n.startswith(prefix))


def replace_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Full replace of a table: readers see the old rows until all new ones are there."""
    spark, path = df.sparkSession, path.rstrip("/")
    old, write = current(spark, path), new_write()
    put_rows(df.withColumn(PART, part_id(partition_by)), path, write, partition_by)
    parts = {p: {"write": write} for p in written_parts(spark, path, write)}
    point(spark, path, Pointer(old.number + 1 if old else 1, df.schema, parts, list(partition_by or [])))
    clean(spark, path)


def is_table(spark: SparkSession, path: str) -> bool:
    """Whether rows were committed at the path, or plain parquet files lie there."""
    path = path.rstrip("/")
    if _numbers(spark, path):
        return True
    if not path_exists(spark, path):
        return False
    return any(n not in ("data", "keys", "repeated", "pointer", "staging") for n in _names(spark, path))


def read_parts(spark: SparkSession, path: str, pointer: Pointer, parts=None, with_part: bool = False) -> DataFrame:
    """Rows of the table partitions named, with their id in ``__part`` if asked."""
    path = path.rstrip("/")
    schema = pointer.schema
    if not with_part:
        folders = pointer.folders(path, parts)
        return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)
    out = None
    chosen = pointer.parts if parts is None else {p: e for p, e in pointer.parts.items() if p in set(parts)}
    wide = StructType([*schema.fields]).add(PART, StringType())
    for write in sorted({e["write"] for e in chosen.values()}):  # a base path per write
        base = f"{path}/data/{write}"
        own = [f"{base}/{PART}={p}" for p, e in chosen.items() if e["write"] == write]
        df = spark.read.schema(wide).option("basePath", base).parquet(*own)
        out = df if out is None else out.union(df)
    return spark.createDataFrame([], wide) if out is None else out


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The table at ``path``: what its pointer names, or plain parquet files."""
    pointer = current(spark, path)
    return spark.read.parquet(path) if pointer is None else read_parts(spark, path, pointer)
