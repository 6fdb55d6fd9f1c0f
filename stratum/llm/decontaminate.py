"""Benchmark decontamination with a broadcast hash set of test n-grams.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z
lower-cased.  A window is ``width`` consecutive words of a benchmark item; an
item with fewer words (but not none) is one window.  The windows' rolling
hashes are broadcast; every document window is looked up, each match is
verified word by word, and all words inside an occurrence are hit.

The broadcast is bounded: benchmark items are dealt into parts of at most
about ``part_words`` words, and the documents are scanned once per part (one
part for any usual benchmark), the spans of earlier parts carried along.

Defined cases: null text has no words; an item without words matches nothing;
repeated items count once by ``item_id``, and a null ``item_id`` hits words but
is not listed; an empty benchmark hits nothing; further columns pass through,
and result columns get trailing underscores where the name is taken.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum.llm.common import free_name, table, text_blocks, text_bytes, written

#: Every byte that is not a word byte becomes a space; A-Z become a-z.
WORD_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
                   for c in range(256))
BASE = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(WORD_BYTES).split()


def rolling(ids: np.ndarray, width: int) -> np.ndarray:
    """Hash of every window of ``width`` ids (wraps around modulo 2^64)."""
    n = len(ids) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(width):
        out = out * BASE + ids[j:j + n]
    return out ^ (out >> np.uint64(29))


class NgramSet:
    """The windows of some benchmark items: word ids, and per window length the
    sorted hashes with the item and position each stands for."""

    def __init__(self, items: list[tuple[int | None, bytes]], width: int):
        self.vocab: dict[bytes, int] = {}
        self.item_ids = [i for i, _ in items]
        self.words: list[np.ndarray] = []
        found: dict[int, list[tuple[int, int]]] = {}
        for k, (_, text) in enumerate(items):
            ids = np.array([self.vocab.setdefault(w, len(self.vocab) + 1) for w in words_of(text)], np.uint64)
            self.words.append(ids)
            if len(ids):
                size = min(width, len(ids))
                found.setdefault(size, []).extend((k, p) for p in range(len(ids) - size + 1))
        self.flat = np.concatenate([np.empty(0, np.uint64), *self.words])
        self.offset = np.cumsum([0, *map(len, self.words)])
        self.by_size = {}
        for size, at in found.items():
            item = np.array([k for k, _ in at], np.int64)
            start = np.array([p for _, p in at], np.int64)
            hashes = np.concatenate([rolling(self.words[k], size) for k in dict.fromkeys(item.tolist())])
            order = np.argsort(hashes, kind="stable")
            table_ = np.zeros(1 << 16, bool)
            table_[hashes & np.uint64(0xFFFF)] = True
            self.by_size[size] = (hashes[order], item[order], start[order], table_)

    def occurrences(self, ids: np.ndarray):
        """Verified (first word, size, item) arrays in a run of word ids."""
        for size, (hashes, item, start, maybe) in self.by_size.items():
            h = rolling(ids, size)
            at = np.flatnonzero(maybe[h & np.uint64(0xFFFF)])
            lo = np.searchsorted(hashes, h[at], "left")
            hi = np.searchsorted(hashes, h[at], "right")
            at, lo, hi = at[hi > lo], lo[hi > lo], hi[hi > lo]
            while len(at):
                k = item[lo]
                good = np.ones(len(at), bool)
                for j in range(size):
                    good &= self.flat[self.offset[k] + start[lo] + j] == ids[at + j]
                yield at[good], size, k[good]
                lo = lo + 1
                more = lo < hi
                at, lo, hi = at[more], lo[more], hi[more]


SPANS = "array<struct<start:int,end:int>>"


def _scanner(shared):
    """Column function: spans of hit words (word positions, end exclusive,
    merged) and the items with occurrences, for one part of the benchmark."""

    @F.arrow_udf(f"struct<n_words:bigint,spans:{SPANS},items:array<bigint>>")
    def scan(texts: pa.Array) -> pa.Array:
        grams = shared.value
        get = grams.vocab.get
        counts, spans, items = [], [], []
        for block in text_blocks(texts):
            docs = [words_of(t) for t in text_bytes(block)]
            sizes = [len(d) for d in docs]
            # one run of ids for the block, a zero (no word's id) after each text
            ids = np.fromiter((x for d in docs for x in (*map(get, d, (0,) * len(d)), 0)), np.uint64,
                              sum(sizes) + len(docs))
            first = np.concatenate([[0], np.cumsum(np.array(sizes, np.int64) + 1)])
            hit = np.zeros(len(ids) + 1, np.int64)
            pairs = set()
            for at, size, item in grams.occurrences(ids):
                np.add.at(hit, at, 1)
                np.add.at(hit, at + size, -1)
                doc = np.searchsorted(first, at, "right") - 1
                pairs.update(zip(doc.tolist(), item.tolist()))
            covered = np.cumsum(hit) > 0
            edge = np.flatnonzero(np.diff(np.concatenate([[False], covered, [False]]).astype(np.int8)))
            own: dict[int, list] = {}
            for lo, hi in zip(edge[::2].tolist(), edge[1::2].tolist()):
                d = int(np.searchsorted(first, lo, "right") - 1)
                own.setdefault(d, []).append({"start": lo - int(first[d]), "end": hi - int(first[d])})
            by_doc: dict[int, set] = {}
            for d, k in pairs:
                by_doc.setdefault(d, set()).add(grams.item_ids[k])
            counts += sizes
            spans += [own.get(d, []) for d in range(len(docs))]
            items += [sorted(x for x in by_doc.get(d, ()) if x is not None) for d in range(len(docs))]
        return pa.StructArray.from_arrays(
            [pa.array(counts, pa.int64()),
             pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
             pa.array(items, pa.list_(pa.int64()))], ["n_words", "spans", "items"])
    return scan


def scan_documents(docs: DataFrame, benchmark: DataFrame, width: int = 10, part_words: int = 2_000_000,
                   text: str = "text") -> DataFrame:
    """``docs`` plus ``hits``: n_words, spans (one list, possibly overlapping
    where the benchmark came in several parts) and items."""
    spark = docs.sparkSession
    size = F.length("text")
    chars = benchmark.agg(F.sum(size)).first()[0] or 0
    parts = max(1, math.ceil(chars / (6 * part_words)))
    name = free_name(docs.columns, "hits")
    out = docs
    for part in range(parts):
        own = benchmark.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part) if parts > 1 else benchmark
        items = [(r[0], (r[1] or "").encode()) for r in own.select("item_id", "text").distinct().collect()]
        scan = _scanner(spark.sparkContext.broadcast(NgramSet(items, width)))
        found = scan(F.col(text).cast("string"))
        if part == 0:
            out = out.withColumn(name, found)
        else:
            new = free_name(out.columns, "more")
            out = out.withColumn(new, found).withColumn(name, F.struct(
                F.col(name)["n_words"].alias("n_words"),
                F.concat(F.col(name)["spans"], F.col(new)["spans"]).alias("spans"),
                F.array_distinct(F.concat(F.col(name)["items"], F.col(new)["items"])).alias("items"))).drop(new)
        if part + 1 < parts:
            out = written(out, "bench-part")
    return out


@F.arrow_udf(T.LongType())
def _covered(spans: pa.Array) -> pa.Array:
    """Positions inside at least one span."""
    out = []
    for own in spans.to_pylist():
        total, reach = 0, 0
        for lo, hi in sorted((s["start"], s["end"]) for s in own or ()):
            total += max(0, hi - max(lo, reach))
            reach = max(reach, hi)
        out.append(total)
    return pa.array(out, pa.int64())


@F.arrow_udf(T.StringType())
def _cut(texts: pa.Array, spans: pa.Array) -> pa.Array:
    """The text without its hit words; everything between words stays."""
    out = []
    for text, own in zip(texts.to_pylist(), spans.to_pylist()):
        if not own:
            out.append(text)
            continue
        raw, kept, at, k = text.encode(), [], 0, -1
        drop = {i for s in own for i in range(s["start"], s["end"])}
        shown = raw.translate(WORD_BYTES)
        for word in shown.split():
            k += 1
            lo = shown.index(word, at)
            kept.append(raw[at:lo] + (b"" if k in drop else raw[lo:lo + len(word)]))
            at = lo + len(word)
        out.append((b"".join(kept) + raw[at:]).decode())
    return pa.array(out, pa.string())


def decontaminate(docs: DataFrame, benchmark: DataFrame, width: int = 10, remove: str = "documents") -> DataFrame:
    """``docs`` free of benchmark windows: ``remove='documents'`` drops every
    document with a hit, ``'spans'`` cuts the hit words out of its text."""
    scanned = scan_documents(docs, benchmark, width)
    hits = F.col(scanned.columns[-1])
    if remove == "documents":
        return scanned.where(F.size(hits["spans"]) == 0).select(*docs.columns)
    if remove != "spans":
        raise ValueError(f"remove: 'documents' or 'spans', not {remove!r}")
    return scanned.withColumn("text", _cut(F.col("text"), hits["spans"])).select(*docs.columns)


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark words and items found in every whole text of ``documents``."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scanned = scan_documents(docs, table(spark, sf_dir, "benchmark"))
    hits = F.col(scanned.columns[-1])
    ids = F.array_sort(F.transform(hits["items"], lambda x: x.cast("string")))
    return scanned.select("doc_id", hits["n_words"].alias("n_words"), _covered(hits["spans"]).alias("n_hit"),
                          F.size(hits["items"]).cast("bigint").alias("n_items"),
                          F.sha2(F.array_join(ids, ",").cast("binary"), 256).alias("items_sha256")) \
        .withColumn("contaminated", F.col("n_hit") > 0)


#: One window column per word of a window: exact, for the small tables only.
OP8_SQL = """
WITH dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents
), bw AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark
), grams AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n, unnest([array_to_string(w[i:i + least(10, len(w)) - 1], ' ')
           FOR i IN range(1, len(w) - least(10, len(w)) + 2)]) AS g
  FROM bw WHERE len(w) > 0
), sizes AS (SELECT DISTINCT n FROM grams), dg AS (
  SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS i,
         unnest([array_to_string(w[i:i + n - 1], ' ') FOR i IN range(1, len(w) - n + 2)]) AS g
  FROM dw JOIN sizes ON len(w) >= n
), found AS (
  SELECT dg.doc_id, dg.i, dg.n, grams.item_id FROM dg JOIN grams ON dg.n = grams.n AND dg.g = grams.g
), hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM found) GROUP BY 1
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY 1
)
SELECT dw.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""
