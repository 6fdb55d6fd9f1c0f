"""Conversation structure repair by a persistent audit DP.

A conversation's turns, in order, are edited until the initials of the roles
read ``(s?(ua)+)?``: *Keep* costs 0, *Rerole* (to user or assistant) 2, *Delete*
3 (the only edit of a blank or duplicate turn), *Insert* of an empty user or
assistant turn 2, and every truncated turn that stays adds 1.  The audit is the
cheapest edits' initials in order, of equal costs the ASCII-least.

*DP*: four states (nothing yet, after the system turn, after a user, after an
assistant) hold the cheapest audit that ends there.  An audit is a node linked
to the node of its prefix, so that audits share their prefixes; a node keeps its
ancestors at distances 1, 2, 4, ... and the rolling hash of its whole text.  Of
two audits of equal cost the smaller is found by lifting both to their longest
common prefix (equal hashes at equal depth) and comparing the next edit; equal
hashes of different nodes are verified edit by edit, and a collision is resolved
by that comparison.  (No audit is a proper prefix of another of equal cost in the
same row: what follows could only be inserts, which cost.)  A state also carries
the running SHA-256 of its repaired turns, so no text is kept.

*Spark*: turns are dealt by ``conv_id``, sorted within the partition and read as a
stream, so a task holds a conversation's audits and the 128-bit digests of its
turns, never its texts, however long it is.  The audit and the digest are one
value per conversation, so one task makes them.  :func:`repaired_turns` applies
the audits to the turns with windows and joins.

Order: turn (nulls first), role, text; rows equal in all three follow each other.
Defined cases: a null role or text counts as one space; a role is judged by its
first character, and an empty one, or one that begins with none of s, u, a, can
only be reroled or deleted; a null ``conv_id`` is a conversation of its own; an
empty table gives an empty table; a conversation without turns (see ``present``)
has zeros, an empty audit and the hash of the empty string; other columns are
not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from stratum.llm.common import table

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COST = {KEEP: 0, REROLE: 2, DELETE: 3, INSERT: 2}
TRUNCATED_COST = 1
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
#: Role initials of ``(s?(ua)+)?``: state after a turn, from state and initial.
STEPS = {(EMPTY, "s"): SYSTEM, (EMPTY, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER, (USER, "a"): ASSISTANT}
LEGAL_NEXT = {"su", "ua", "au"}
ROLE = {"u": "user", "a": "assistant"}
PRIME, BASE = (1 << 61) - 1, 1_000_003

VISIBLE = re.compile(r"[^\x20\x09-\x0D]")
SPACES = " \t\n\x0b\x0c\r"


class Node:
    """An edit, linked to its prefix; ``up[k]`` is the node 2**k edits before."""

    __slots__ = ("edit", "depth", "hash", "up")

    def __init__(self, edit: str, prefix: Node | None):
        self.edit = edit
        if prefix is None:
            self.depth, self.hash, self.up = 0, 0, ()
            return
        self.depth = prefix.depth + 1
        self.hash = (prefix.hash * BASE + ord(edit)) % PRIME
        up, far = [prefix], prefix
        k = 0
        while k < len(far.up):
            far = far.up[k]
            up.append(far)
            k += 1
        self.up = tuple(up)


def ancestor(node: Node, depth: int) -> Node:
    while node.depth > depth:
        node = node.up[min(len(node.up), (node.depth - depth).bit_length()) - 1]
    return node


def audit_text(node: Node) -> str:
    out = []
    while node.depth:
        out.append(node.edit)
        node = node.up[0]
    return "".join(reversed(out))


def _same(a: Node, b: Node) -> bool:
    """Whether two nodes of equal depth and hash spell the same audit."""
    while a is not b:
        if a.edit != b.edit:
            return False
        a, b = a.up[0], b.up[0]
    return True


def smaller(a: Node, b: Node) -> bool:
    """Whether ``a`` spells a smaller text than ``b``."""
    depth = min(a.depth, b.depth)
    x, y = ancestor(a, depth), ancestor(b, depth)
    if x is y or (x.hash == y.hash and _same(x, y)):
        return a.depth < b.depth
    if x.hash == y.hash:  # a collision of the whole texts
        return audit_text(x) < audit_text(y)
    for k in range(len(x.up) - 1, -1, -1):
        # levels shrink as the nodes rise; above the common prefix the hashes differ
        if k < len(x.up) and x.up[k].hash != y.up[k].hash:
            x, y = x.up[k], y.up[k]
    p, q = x.up[0], y.up[0]
    if p is not q and not _same(p, q):
        return audit_text(p) < audit_text(q)
    return x.edit < y.edit


class Path:
    """The cheapest way into a state: cost, audit, digest of the turns kept."""

    __slots__ = ("cost", "node", "digest", "any", "system")

    def __init__(self, cost, node, digest, any_, system):
        self.cost, self.node, self.digest, self.any, self.system = cost, node, digest, any_, system

    def then(self, edit: str, extra: int = 0, turn: str | None = None, system: bool = False) -> Path:
        """This path and one more edit; ``turn`` is the ``role:text`` it leaves."""
        digest = self.digest
        if turn is not None:
            digest = digest.copy()
            digest.update(("\n" + turn if self.any else turn).encode("utf-8", "surrogatepass"))
        return Path(self.cost + COST[edit] + extra, Node(edit, self.node), digest,
                    self.any or turn is not None, self.system or system)


class Repair:
    """The DP over one conversation; takes its turns in order."""

    def __init__(self):
        start = Path(0, Node("", None), hashlib.sha256(), False, False)
        self.best: list[Path | None] = [start, None, None, None]
        self._insert()
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.turns, self.low, self.high = 0, None, None
        self.number, self.last_turn, self.before = 0, None, None
        self.seen: set[bytes] = set()

    @staticmethod
    def _offer(into: list, state: int, source: Path, edit: str, extra: int, turn: str | None, system=False) -> None:
        """``source`` and one more edit become the state's path where that is better."""
        cost = source.cost + COST[edit] + extra
        held = into[state]
        if held is not None and held.cost < cost:
            return
        if held is not None and held.cost == cost and not smaller(Node(edit, source.node), held.node):
            return
        into[state] = source.then(edit, extra, turn, system)

    def _insert(self) -> None:
        """Inserts after the last turn: a user, an assistant, or both."""
        before = list(self.best)
        for state in (EMPTY, SYSTEM, ASSISTANT):
            if before[state] is not None:
                self._offer(self.best, USER, before[state], INSERT, 0, "user:")
        if self.best[USER] is not None:
            self._offer(self.best, ASSISTANT, self.best[USER], INSERT, 0, "assistant:")

    def fault(self, role: str, text: str) -> str | None:
        key = hashlib.blake2b(f"{len(role)}:{role}{text}".encode("utf-8", "surrogatepass"), digest_size=16).digest()
        again = key in self.seen
        self.seen.add(key)
        if not VISIBLE.search(text):
            return "blank"
        if again:
            return "duplicate"
        return None if text.rstrip(SPACES)[-1] in ".!?" else "truncated"

    def add(self, turn: int | None, role: str, text: str) -> None:
        if turn is not None:
            self.low = turn if self.low is None else min(self.low, turn)
            self.high = turn if self.high is None else max(self.high, turn)
            self.number += turn != self.last_turn  # turns come in order
            self.last_turn = turn
        initial = role[:1]
        if self.before is not None and self.before + initial not in LEGAL_NEXT:
            self.illegal += 1
        self.before = initial
        fault = self.fault(role, text)
        if fault:
            setattr(self, fault, getattr(self, fault) + 1)
        self.turns += 1
        old, new = self.best, [None] * 4
        for state, path in enumerate(old):
            if path is None:
                continue
            self._offer(new, state, path, DELETE, 0, None)
            if fault in ("blank", "duplicate"):
                continue
            extra = TRUNCATED_COST if fault == "truncated" else 0
            if (state, initial) in STEPS:
                self._offer(new, STEPS[state, initial], path, KEEP, extra, f"{role}:{text}", initial == "s")
            other = "a" if state == USER else "u"
            self._offer(new, STEPS[state, other], path, REROLE, extra, f"{ROLE[other]}:{text}")
        self.best = new
        self._insert()

    def result(self) -> dict:
        ends = [self.best[s] for s in (EMPTY, ASSISTANT) if self.best[s] is not None]
        best = ends[0]
        for p in ends[1:]:
            if p.cost < best.cost or (p.cost == best.cost and smaller(p.node, best.node)):
                best = p
        return {"gaps": 0 if self.low is None else self.high - self.low + 1 - self.number,
                "blank": self.blank, "duplicate": self.duplicate, "truncated": self.truncated,
                "illegal": self.illegal, "cost": best.cost, "audit": audit_text(best.node),
                "repaired_sha256": best.digest.hexdigest(), "system_first": best.system}


RESULT = T.StructType([
    *[T.StructField(n, T.LongType()) for n in ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
    T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType()),
    T.StructField("system_first", T.BooleanType())])


def _stream(schema: pa.Schema):
    def repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[dict] = []
        at, run = None, None
        for batch in batches:
            for conv, turn, role, text, present in zip(*(c.to_pylist() for c in batch.columns)):
                if run is None or conv != at:
                    if run is not None:
                        done.append({"conv_id": at, **run.result()})
                    at, run = conv, Repair()
                if present:
                    run.add(turn, role, text)
            if len(done) >= 1000:
                yield pa.RecordBatch.from_pylist(done, schema)
                done = []
        if run is not None:
            done.append({"conv_id": at, **run.result()})
        if done:
            yield pa.RecordBatch.from_pylist(done, schema)
    return repair


ARROW = pa.schema([*[pa.field(n, pa.int64()) for n in (
    "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
    pa.field("audit", pa.string()), pa.field("repaired_sha256", pa.string()), pa.field("system_first", pa.bool_())])


def _slim(turns: DataFrame, present: str | None) -> DataFrame:
    here = F.lit(True) if present is None else F.coalesce(F.col(present), F.lit(False))
    return turns.select(F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
                        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
                        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"), here.alias("present"))


def repair_conversations(turns: DataFrame, present: str | None = None) -> DataFrame:
    """One row per conversation: ``conv_id``, ``gaps``, the counts of ``blank``,
    ``duplicate`` and ``truncated`` turns, ``illegal`` neighbours, the repair's
    ``cost``, ``audit`` and ``repaired_sha256``, and ``system_first``.  Rows whose
    column ``present`` is not true only name their conversation."""
    dealt = _slim(turns, present).repartition("conv_id")
    order = dealt.sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "role", "text")
    return order.mapInArrow(_stream(ARROW), RESULT)


def repaired_turns(turns: DataFrame, audits: DataFrame | None = None, present: str | None = None) -> DataFrame:
    """The repaired turns: ``conv_id``, ``position`` (from 1), ``edit``, ``turn``
    (null: inserted), ``role``, ``text``.  ``audits``: of these turns, if known."""
    audits = repair_conversations(turns, present) if audits is None else audits
    of = Window.partitionBy("conv_id").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    edits = audits.select("conv_id", "system_first",
                          F.posexplode(F.filter(F.split("audit", ""), lambda e: e != "")).alias("step", "edit"))
    edits = edits.withColumn("number", F.sum((F.col("edit") != INSERT).cast("int")).over(of)) \
        .withColumn("position", F.sum((F.col("edit") != DELETE).cast("int")).over(of)).where(F.col("edit") != DELETE)
    rows = _slim(turns, present).where("present").drop("present")
    rows = rows.withColumn("number", F.row_number().over(
        Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "text")))
    rows = rows.withColumnRenamed("conv_id", "own")
    made = edits.withColumn("made", F.when((F.col("position") - F.col("system_first").cast("int")) % 2 == 1, "user")
                            .otherwise("assistant"))
    both = made.join(rows, (F.col("conv_id").eqNullSafe(F.col("own"))) & (rows["number"] == made["number"])
                     & (made["edit"] != INSERT), "left")
    return both.select("conv_id", "position", "edit", "turn",
                       F.when(F.col("edit") == KEEP, F.col("role")).otherwise(F.col("made")).alias("role"),
                       F.when(F.col("edit") == INSERT, F.lit("")).otherwise(F.col("text")).alias("text"))


def damaged(turns: DataFrame) -> DataFrame:
    """Reproducible damage by crc32(``conv_id:turn``) mod 20 (nulls: one space):
    0 drops the row, 1 empties its text, 2 removes its sentence ends, 3 repeats
    it, 4 makes its role user.  A dropped row stays with ``present`` false."""
    def told(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))
    hit = F.pmod(F.crc32(F.concat(told("conv_id"), F.lit(":"), told("turn")).cast("binary")), F.lit(20))
    text = F.when(F.col("hit") == 1, F.lit("")) \
        .when(F.col("hit") == 2, F.regexp_replace(told("text"), "[.!?]", "")).otherwise(told("text"))
    rows = turns.select("conv_id", "turn", "role", "text", hit.alias("hit"))
    rows = rows.select("conv_id", "turn", F.when(F.col("hit") == 4, F.lit("user")).otherwise(told("role")).alias("role"),
                       text.alias("text"), (F.col("hit") != 0).alias("present"),
                       F.explode(F.when(F.col("hit") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
                       .alias("copy"))
    return rows.drop("copy")


def op11_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repair of all ``conversations`` after the damage."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return repair_conversations(damaged(turns), "present").drop("system_first")


OP11_SQL = r"""
WITH RECURSIVE told AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name
  FROM conversations
), coded AS (
  SELECT conv_id, turn, role, text, xor(4294967295, list_reduce(
           list_prepend(CAST(4294967295 AS BIGINT), [CAST(ascii(c) AS BIGINT) FOR c IN string_split(name, '')]),
           lambda crc, b: list_reduce([xor(crc, b), 0, 0, 0, 0, 0, 0, 0, 0],
                                      lambda x, k: xor(x >> 1, 3988292384 * (x & 1))))) % 20 AS hit
  FROM told
), hurt AS (
  SELECT conv_id, turn, CASE hit WHEN 4 THEN 'user' ELSE role END AS role,
         CASE hit WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE hit WHEN 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM coded WHERE hit <> 0
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i FROM hurt
), judged AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
                 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
                 WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE 'none' END AS fault,
         left(role, 1) AS c, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before
  FROM placed
), costed AS (
  SELECT conv_id, i, c, fault IN ('blank', 'duplicate') AS must_go, CAST(fault = 'truncated' AS INTEGER) AS cut FROM judged
), walk AS (  -- four states; a key is the cost in six digits, then the audit
  SELECT conv_id, 0::BIGINT AS i, '000000' AS k0, CAST(NULL AS VARCHAR) AS k1, '000002I' AS k2, '000004II' AS k3
  FROM (SELECT DISTINCT conv_id FROM conversations)
  UNION ALL
  SELECT conv_id, i, k0, k1, j2,
         least(k3, printf('%06d', CAST(left(j2, 6) AS INTEGER) + 2) || substr(j2, 7) || 'I')
  FROM (
    SELECT conv_id, i, k0, k1, k3,
           least(k2, printf('%06d', CAST(left(k0, 6) AS INTEGER) + 2) || substr(k0, 7) || 'I',
                 printf('%06d', CAST(left(k1, 6) AS INTEGER) + 2) || substr(k1, 7) || 'I',
                 printf('%06d', CAST(left(k3, 6) AS INTEGER) + 2) || substr(k3, 7) || 'I') AS j2
    FROM (
      SELECT w.conv_id, r.i,
             printf('%06d', CAST(left(k0, 6) AS INTEGER) + 3) || substr(k0, 7) || 'D' AS k0,
             least(printf('%06d', CAST(left(k1, 6) AS INTEGER) + 3) || substr(k1, 7) || 'D',
                   CASE WHEN NOT must_go AND c = 's' THEN
                     printf('%06d', CAST(left(k0, 6) AS INTEGER) + cut) || substr(k0, 7) || 'K' END) AS k1,
             least(printf('%06d', CAST(left(k2, 6) AS INTEGER) + 3) || substr(k2, 7) || 'D',
                   CASE WHEN NOT must_go THEN least(
                     printf('%06d', CAST(left(k0, 6) AS INTEGER) + cut + 2) || substr(k0, 7) || 'R',
                     printf('%06d', CAST(left(k1, 6) AS INTEGER) + cut + 2) || substr(k1, 7) || 'R',
                     printf('%06d', CAST(left(k3, 6) AS INTEGER) + cut + 2) || substr(k3, 7) || 'R') END,
                   CASE WHEN NOT must_go AND c = 'u' THEN least(
                     printf('%06d', CAST(left(k0, 6) AS INTEGER) + cut) || substr(k0, 7) || 'K',
                     printf('%06d', CAST(left(k1, 6) AS INTEGER) + cut) || substr(k1, 7) || 'K',
                     printf('%06d', CAST(left(k3, 6) AS INTEGER) + cut) || substr(k3, 7) || 'K') END) AS k2,
             least(printf('%06d', CAST(left(k3, 6) AS INTEGER) + 3) || substr(k3, 7) || 'D',
                   CASE WHEN NOT must_go THEN
                     printf('%06d', CAST(left(k2, 6) AS INTEGER) + cut + 2) || substr(k2, 7) || 'R' END,
                   CASE WHEN NOT must_go AND c = 'a' THEN
                     printf('%06d', CAST(left(k2, 6) AS INTEGER) + cut) || substr(k2, 7) || 'K' END) AS k3
      FROM walk w JOIN costed r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.i = w.i + 1))
), ended AS (
  SELECT conv_id, arg_max(least(k0, k3), i) AS best FROM walk GROUP BY conv_id
), audits AS (
  SELECT conv_id, CAST(left(best, 6) AS BIGINT) AS cost, substr(best, 7) AS audit FROM ended
), steps AS (
  SELECT conv_id, unnest(string_split(audit, '')) AS e, generate_subscripts(string_split(audit, ''), 1) AS k
  FROM audits WHERE audit <> ''
), numbered AS (
  SELECT *, sum(CAST(e <> 'I' AS INTEGER)) OVER (PARTITION BY conv_id ORDER BY k) AS i,
         sum(CAST(e <> 'D' AS INTEGER)) OVER (PARTITION BY conv_id ORDER BY k) AS j FROM steps
), said AS (
  SELECT n.conv_id, n.k, n.j, n.e, p.role, CASE WHEN n.e = 'I' THEN '' ELSE p.text END AS text,
         bool_or(n.e = 'K' AND n.j = 1 AND left(p.role, 1) = 's') OVER (PARTITION BY n.conv_id) AS s
  FROM numbered n LEFT JOIN placed p ON n.conv_id IS NOT DISTINCT FROM p.conv_id AND n.i = p.i AND n.e <> 'I'
  WHERE n.e <> 'D'
), repaired AS (
  SELECT conv_id, string_agg(CASE WHEN e = 'K' THEN role WHEN (j - CAST(s AS INTEGER)) % 2 = 1 THEN 'user'
                                  ELSE 'assistant' END || ':' || text, chr(10) ORDER BY k) AS body
  FROM said GROUP BY conv_id
), counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (before IS NOT NULL AND before || c NOT IN ('su', 'ua', 'au')) AS illegal
  FROM judged GROUP BY conv_id
)
SELECT a.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank,
       coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
       a.cost, a.audit, sha256(coalesce(body, '')) AS repaired_sha256
FROM audits a LEFT JOIN counts c ON a.conv_id IS NOT DISTINCT FROM c.conv_id
     LEFT JOIN repaired r ON a.conv_id IS NOT DISTINCT FROM r.conv_id
"""
