"""SimHash near-duplicates by a binary-trie self-join.

*Fingerprint*: words ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z lower-cased,
``shingle``-word shingles joined by one space (repeats included; a shorter
text is one shingle; no word: fingerprint zero), XXH64 (seed 42) of each; a bit
is 1 if it is set in over half of the hashes.

*Join*: distinct fingerprints are the leaves of binary tries.  Two fingerprints
that differ in at most ``d`` bits differ in at most ``d // 2`` bits of one of
their two halves, so two tries are walked, one led by each half: node pairs
descend together, differing bits accumulate, and a pair is pruned as soon as
it exceeds ``d // 2`` errors within the leading half or ``d`` in all.  The top
``p`` levels are walked by Spark (a fingerprint goes to the node pairs its
prefix forms within the budget, chosen by XOR masks); below them one task
walks a pair of subtrees with numpy, in chunks of bounded size.

A task returns a spanning forest of the links it finds, never all pairs, and
skips node pairs whose leaves it has already joined into one component, so a
dense group of near copies costs about its size, not its square.  The forests'
components are then joined across tasks with :func:`connected_components`.

Defined cases: null text counts as empty; documents with the zero fingerprint
link like any other; repeated rows share a fingerprint and a component; a null
``doc_id`` is never the smallest of its component (all null: null component);
further columns pass through, and result columns get trailing underscores
where the name is taken.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum.llm.common import connected_components, free_name, table, text_blocks, text_bytes, written

#: Shingles whose bits are summed at a time.
SHINGLES = 1 << 15
#: Leaf comparisons (or node pairs) held at a time.
CHUNK = 1 << 18
#: Node pairs with at most so many leaf pairs are compared directly.
BUCKET = 48


def fingerprint(text: bytes, shingle: int = 4) -> int:
    """64-bit SimHash of one whole text."""
    words = text.lower().split()
    n = len(words)
    if not n:
        return 0
    line = b" ".join(words)
    if n <= shingle:
        return xxhash.xxh64_intdigest(line, 42)
    sizes = np.fromiter(map(len, words), np.int64, n)
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    count = n - shingle + 1
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for lo in range(0, count, SHINGLES):
        hi = min(count, lo + SHINGLES)
        h = np.fromiter((digest(line[s:e], 42) for s, e in
                         zip(starts[lo:hi].tolist(), ends[lo + shingle - 1:hi + shingle - 1].tolist())),
                        ">u8", hi - lo)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > count).tobytes(), "big")


@F.arrow_udf(T.LongType())
def _fingerprints(texts: pa.Array, shingle: pa.Array) -> pa.Array:
    width = shingle[0].as_py() if len(shingle) else 4
    out = [fingerprint(t, width) for block in text_blocks(texts) for t in text_bytes(block)]
    return pa.array(np.array(out, np.uint64).view(np.int64))


class _Forest:
    """Labels of a task's leaves; ``changes`` tells which ranges are uniform."""

    def __init__(self, n: int):
        self.label = np.arange(n)
        self.changes = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        moved = False
        while True:
            la, lb = self.label[a], self.label[b]
            apart = la != lb
            if not apart.any():
                break
            a, b, la, lb = a[apart], b[apart], la[apart], lb[apart]
            parent = np.arange(len(self.label))
            np.minimum.at(parent, np.maximum(la, lb), np.minimum(la, lb))
            while (up := parent[parent], not np.array_equal(up, parent))[1]:
                parent = up
            self.label, moved = parent[self.label], True
        if moved:
            self.changes = np.concatenate([[0], np.cumsum(self.label[1:] != self.label[:-1])])

    def one(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        return self.changes[lo] == self.changes[hi - 1]


def _ranges(lo: np.ndarray, n: np.ndarray) -> np.ndarray:
    """lo[0], lo[0]+1, ... (n[0] of them), then lo[1], ..."""
    ends = np.cumsum(n)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(lo - (ends - n), n)


def walk(keys: np.ndarray, split: int, depth: int, errors: int, lead: int, total: int) -> np.ndarray:
    """Labels after joining all linked leaves of two subtrees.

    ``keys``: sorted distinct uint64 of the first subtree (``[:split]``), then
    of the second; with ``split == len(keys)`` the subtree is joined with
    itself.  Both subtrees start at ``depth`` with ``errors`` differing bits;
    within the leading 32 bits ``lead`` errors are allowed, ``total`` in all.
    """
    n = len(keys)
    forest = _Forest(n)
    own = split == n
    root = (np.array([0]), np.array([split]), np.array([0 if own else split]), np.array([n]), np.array([errors]))
    stack = [(depth, root)]
    while stack:
        d, (alo, ahi, blo, bhi, err) = stack.pop()
        if len(alo) > CHUNK:
            half = len(alo) // 2
            stack += [(d, tuple(x[half:] for x in (alo, ahi, blo, bhi, err))),
                      (d, tuple(x[:half] for x in (alo, ahi, blo, bhi, err)))]
            continue
        done = forest.one(alo, ahi) & forest.one(blo, bhi) & (forest.label[alo] == forest.label[blo])
        small = (ahi - alo) * (bhi - blo) <= BUCKET
        small |= d == 64
        leaf = small & ~done
        if leaf.any():
            _compare(keys, forest, alo[leaf], ahi[leaf], blo[leaf], bhi[leaf], lead, total)
        go = ~small & ~done
        if not go.any():
            continue
        alo, ahi, blo, bhi, err = alo[go], ahi[go], blo[go], bhi[go], err[go]
        amid, bmid = _middle(keys, alo, ahi, d), _middle(keys, blo, bhi, d)
        parts = []
        mirror = (alo == blo) & (ahi == bhi)
        for x, y in itertools.product((0, 1), (0, 1)):
            clo, chi = (alo, amid) if x == 0 else (amid, ahi)
            elo, ehi = (blo, bmid) if y == 0 else (bmid, bhi)
            e = err + (x != y)
            ok = (chi > clo) & (ehi > elo) & (e <= (lead if d < 32 else total))
            if x > y:
                ok &= ~mirror
            parts.append((clo[ok], chi[ok], elo[ok], ehi[ok], e[ok]))
        nxt = tuple(np.concatenate(x) for x in zip(*parts))
        if len(nxt[0]):
            stack.append((d + 1, nxt))
    return forest.label


def _middle(keys: np.ndarray, lo: np.ndarray, hi: np.ndarray, depth: int) -> np.ndarray:
    """Where the leaves with bit ``depth`` set begin, in each node's range
    (a range lies wholly in one of the two sorted parts of ``keys``)."""
    bit = np.uint64(1) << np.uint64(63 - depth)
    left, right = lo.copy(), hi.copy()
    while (left < right).any():
        mid = (left + right) // 2
        open_ = left < right
        one = (keys[np.minimum(mid, len(keys) - 1)] & bit) != 0
        right = np.where(open_ & one, mid, right)
        left = np.where(open_ & ~one, mid + 1, left)
    return left


def _compare(keys, forest, alo, ahi, blo, bhi, lead, total) -> None:
    """Exact check of all leaf pairs below the node pairs, in chunks."""
    na, nb = ahi - alo, bhi - blo
    cuts = np.flatnonzero(np.diff(np.cumsum(na * nb) // CHUNK)) + 1
    for lo, hi in zip([0, *cuts], [*cuts, len(na)]):
        a = _ranges(alo[lo:hi], na[lo:hi])
        reps = np.repeat(nb[lo:hi], na[lo:hi])
        b = _ranges(np.repeat(blo[lo:hi], na[lo:hi]), reps)
        a = np.repeat(a, reps)
        differ = keys[a] ^ keys[b]
        near = (np.bitwise_count(differ) <= total) & (np.bitwise_count(differ >> np.uint64(32)) <= lead)
        forest.join(a[near], b[near])


def _rotated(key: np.ndarray) -> np.ndarray:
    return (key << np.uint64(32)) | (key >> np.uint64(32))


def _subtree_task(bits: int, lead: int, total: int):
    def links(key, frame: pd.DataFrame) -> pd.DataFrame:
        trie, _, mask = key
        first = np.unique(frame.loc[frame["side"] == 0, "fp"].to_numpy().view(np.uint64))
        second = np.unique(frame.loc[frame["side"] == 1, "fp"].to_numpy().view(np.uint64))
        if mask and not (len(first) and len(second)):
            return pd.DataFrame({"u": [], "v": []}, dtype="int64")
        keys = np.concatenate([first, second])
        label = walk(keys, len(first) if mask else len(keys), bits, int(mask).bit_count(), lead, total)
        at = np.flatnonzero(label != np.arange(len(keys)))
        back = _rotated if trie else (lambda x: x)
        return pd.DataFrame({"u": back(keys[at]).view(np.int64), "v": back(keys[label[at]]).view(np.int64)})
    return links


def trie_links(prints: DataFrame, n: int, max_bits: int = 4, leaves: int = 1 << 14) -> DataFrame:
    """Links (``u``, ``v``) that connect exactly the fingerprints (distinct
    longs, column ``fp``, ``n`` of them) within ``max_bits`` of each other,
    directly or over others.  ``leaves``: mean fingerprints below a top node."""
    lead = max_bits // 2
    bits = min(24, max(4, math.ceil(math.log2(max(1, n) / leaves))))
    masks = [0]
    for e in range(1, lead + 1):
        masks += [sum(1 << b for b in c) for c in itertools.combinations(range(bits), e)]
    turned = F.expr("shiftleft(fp, 32) | shiftrightunsigned(fp, 32)")
    both = prints.select(F.explode(F.array(
        F.struct(F.lit(0).alias("trie"), F.col("fp").alias("fp")),
        F.struct(F.lit(1).alias("trie"), turned.alias("fp")))).alias("x")).select("x.trie", "x.fp")
    node = F.shiftrightunsigned("fp", 64 - bits).cast("int")
    pairs = both.withColumn("node", node) \
        .withColumn("mask", F.explode(F.array(*[F.lit(m) for m in masks]))) \
        .withColumn("low", F.least(F.col("node"), F.col("node").bitwiseXOR(F.col("mask")))) \
        .select("trie", "low", "mask", (F.col("node") > F.col("low")).cast("int").alias("side"), "fp")
    return pairs.groupBy("trie", "low", "mask") \
        .applyInPandas(_subtree_task(bits, lead, max_bits), "u bigint, v bigint")


def simhash_components(docs: DataFrame, shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """``docs`` plus ``fingerprint`` (16 hex digits) and ``component_id`` (the
    smallest ``doc_id`` reachable over links, itself included)."""
    names = docs.columns
    # never null: told to the planner, it does not compute the column twice to check a join's key
    fp = F.coalesce(_fingerprints(docs["text"].cast("string"), F.lit(shingle)), F.lit(0))
    hashed = docs.select(F.struct(*[docs[c] for c in names]).alias("row"), fp.alias("fp"))
    slim = written(hashed.select(F.col("row.doc_id").cast("bigint").alias("doc"), "fp"), "simhash")
    prints = written(slim.groupBy("fp").agg(F.min("doc").alias("first_doc")), "simhash-prints")
    links = trie_links(prints.select("fp"), prints.count(), max_bits)
    comps = connected_components(links)
    member = written(prints.join(comps.withColumnRenamed("node", "fp"), "fp", "left")
                     .select("fp", "first_doc", F.coalesce("label", "fp").alias("label")), "simhash-members")
    # written, so that the join on a label that many fingerprints share can be split
    smallest = written(member.groupBy("label").agg(F.min("first_doc").alias("component")), "simhash-smallest")
    known = member.join(smallest, "label").select("fp", "component")
    if set(names) == {"doc_id"} or set(names) == {"doc_id", "text"}:
        # ids only are needed: the texts are not read again
        out = slim.join(known, "fp").select(F.col("doc").alias("doc_id"), "fp", "component")
        keep = [F.col("doc_id")]
    else:
        out = hashed.join(known, "fp")
        keep = [F.col("row")[c].alias(c) for c in names]
    return out.select(*keep, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias(free_name(names, "fingerprint")),
                      F.col("component").alias(free_name(names, "component_id")))


def op7_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash components of all ``documents``."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash_components(docs).select("doc_id", "fingerprint", "component_id")
