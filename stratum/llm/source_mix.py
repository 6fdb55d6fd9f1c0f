"""Mixing sources to target weights, block by block.

*Pack*: the words of every source form one stream (documents in a fixed order),
cut into blocks of ``block`` words.  The stream is laid out without a global
sort: documents are dealt by a hash of ``doc_id`` into buckets, each bucket is
packed by itself (its last block may be short) and the buckets' block counts,
summed up, number a source's blocks from 0.

*Draw*: the mix takes ``n`` blocks from each source, so that their words come
to its target.  Output shards of ``shard`` slots draw their source counts from
the multinomial distribution given those totals (the multivariate
hypergeometric), shard by shard from a fixed seed.

*Map*: a source's ``i``-th slot goes to block ``perm_e(i mod blocks)``, where
``e = i // blocks`` is the pass over the source and ``perm_e`` a keyed Feistel
permutation of the block numbers, so each pass takes a block at most once.
Slots then meet blocks in one equi-join by (source, block number).

*Targets*: sources in code point order, null last, weigh 5, 2, 1, repeating,
and share ``budget`` times all words; a target stops at ``max_passes`` times
its source's size and the excess is reshared by weight.  One row per source
reaches the driver (sources are a catalogue, not data).

Defined cases: null, empty and blank texts have size 0, are in no block and
are taken 0 times; null is a source of its own; repeated rows are packed one
after the other; an empty table or only empty texts: targets 0, nothing taken;
further columns pass through, and result columns get trailing underscores where
the name is taken.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum.llm.common import free_name, table, text_blocks, text_bytes, written

WEIGHTS = (5.0, 2.0, 1.0)


@F.arrow_udf(T.LongType())
def word_count(texts: pa.Array) -> pa.Array:
    out = [len(t.split()) for block in text_blocks(texts) for t in text_bytes(block)]
    return pa.array(out, pa.int64())


def targets(sizes: list[tuple[str | None, int]], budget: float = 1.5, max_passes: float = 2.0,
            weights: tuple[float, ...] = WEIGHTS) -> dict[str | None, float]:
    """Words the mix should take of each source."""
    order = sorted(sizes, key=lambda s: (s[0] is None, s[0] or ""))
    weight = {s: weights[i % len(weights)] for i, (s, _) in enumerate(order)}
    limit = {s: max_passes * n for s, n in order}
    left, out = budget * sum(n for _, n in order), {}
    free = [s for s, _ in order]
    while free:
        unit = left / sum(weight[s] for s in free)
        full = [s for s in free if weight[s] * unit > limit[s]]
        if not full:
            out.update({s: weight[s] * unit for s in free})
            break
        for s in full:
            out[s] = limit[s]
            left -= limit[s]
        free = [s for s in free if s not in out]
    return out


def draw_shards(slots: list[int], shard: int, seed: int) -> Iterator[np.ndarray]:
    """Source counts of each output shard, given the slots of each source."""
    rng = np.random.default_rng(seed)
    left = np.array(slots, np.int64)
    while (total := int(left.sum())) > 0:
        take = rng.multivariate_hypergeometric(left, min(shard, total), method="marginals")
        left = left - take
        yield take


def permuted(i: np.ndarray, n: np.ndarray, key: np.ndarray, rounds: int = 4) -> np.ndarray:
    """Keyed permutation of 0 .. n-1 at ``i``: a Feistel network over the next
    even number of bits, walked until it lands inside."""
    bits = np.maximum(2, np.ceil(np.log2(np.maximum(n, 2))).astype(np.uint64))
    half = (bits + np.uint64(1)) // np.uint64(2)
    mask = (np.uint64(1) << half) - np.uint64(1)
    out, todo = i.astype(np.uint64), np.arange(len(i))
    while len(todo):
        h, m, k = half[todo], mask[todo], key[todo]
        left, right = out[todo] >> h, out[todo] & m
        for r in range(rounds):
            x = (right + k + np.uint64(r)) * np.uint64(0x9E3779B97F4A7C15)
            x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            left, right = right, left ^ ((x ^ (x >> np.uint64(32))) & m)
        out[todo] = (left << h) | right
        todo = todo[out[todo] >= n[todo].astype(np.uint64)]
    return out.astype(np.int64)


class Mix:
    """The packing and the drawn slots of one mix of ``docs``.

    ``catalogue``: a row per source with its number, name, size and target.
    ``slots``: shard, slot in the shard, source number, block number.
    """

    def __init__(self, docs, slim, number, bases, catalogue, slots, block):
        self.docs, self.slim, self.number, self.bases = docs, slim, number, bases
        self.catalogue, self.slots, self.block = catalogue, slots, block

    def placed(self, rows: DataFrame) -> DataFrame:
        """``rows`` (a struct ``row`` and the columns of :func:`_sized`) with
        their first word in the bucket's stream and the bucket's first block."""
        order = Window.partitionBy("source_no", "bucket").orderBy("doc", "tie", "size") \
            .rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return _dealt(rows, self.number).withColumn("first", F.sum("size").over(order) - F.col("size")) \
            .join(self.bases, ["source_no", "bucket"])

    def local_blocks(self) -> Column:
        b = F.lit(self.block)
        return F.sequence(F.floor(F.col("first") / b), F.floor((F.col("first") + F.col("size") - 1) / b))

    def span(self) -> tuple[Column, Column]:
        """Words of the document in its bucket's block ``local``: from, to."""
        b = F.lit(self.block)
        return (F.greatest(F.lit(0), F.col("local") * b - F.col("first")),
                F.least(F.col("size"), (F.col("local") + 1) * b - F.col("first")))

    def taken(self) -> DataFrame:
        """Per row of ``docs``: doc (its id), source_no, size and the words the
        mix takes of it, repeats counted."""
        rows = self.placed(self.slim)
        uses = self.slots.groupBy("source_no", "block_no").agg(F.count("*").alias("uses")).hint("merge")
        lo, hi = self.span()
        words = rows.where("size > 0").withColumn("local", F.explode(self.local_blocks())) \
            .withColumn("words", hi - lo).withColumn("block_no", F.col("base") + F.col("local")) \
            .join(uses, ["source_no", "block_no"], "left") \
            .groupBy("source_no", "bucket", "first") \
            .agg(F.min("doc").alias("doc"), F.min("size").alias("size"),
                 F.sum(F.col("words") * F.coalesce("uses", F.lit(0))).cast("bigint").alias("taken"))
        none = _dealt(self.slim, self.number).where("size = 0") \
            .select("doc", "source_no", "size", F.lit(0).cast("bigint").alias("taken"))
        return words.select("doc", "source_no", "size", "taken").union(none)

    def blocks(self) -> DataFrame:
        """The mix itself: per slot and document in it, the words taken as
        ``text`` (joined by a space), ordered by shard, slot and piece."""
        names = self.docs.columns
        rows = self.placed(_sized(self.docs, names)).where("size > 0")
        cut = _pieces(F.col("row.text").cast("string"), F.col("first"), F.lit(self.block))
        # the whole text is left behind before the pieces are made rows; each text has a piece, and the
        # outer form spares the planner's check for it, which would cut all texts a second time
        head = F.struct(*[F.col("row")[c].alias(c) for c in names if c != "text"]).alias("row")
        pieces = rows.select(head, "source_no", "base", cut.alias("cut")) \
            .withColumn("p", F.explode_outer("cut")).select(
                "row", "source_no", (F.col("base") + F.col("p.local")).alias("block_no"),
                F.col("p.at").alias("piece"), F.col("p.words").alias("words"), F.col("p.text").alias("text"))
        # slots grow with the corpus: never broadcast, whatever the planner guesses of their size
        out = pieces.join(self.slots.hint("merge"), ["source_no", "block_no"])
        taken = [c for c in names if c != "text"]
        return out.select(F.col("shard").alias(free_name(names, "shard")), F.col("slot").alias(free_name(names, "slot")),
                          F.col("piece").alias(free_name(names, "piece")), *[F.col("row")[c].alias(c) for c in taken],
                          F.col("words").alias(free_name(names, "words")), "text")


@F.arrow_udf(T.ArrayType(T.StructType().add("local", T.LongType()).add("at", T.IntegerType())
                         .add("words", T.IntegerType()).add("text", T.StringType())))
def _pieces(texts: pa.Array, first: pa.Array, block: pa.Array) -> pa.Array:
    """A text cut at its bucket's block borders; ``at``: where in the block."""
    kind = pa.list_(pa.struct([("local", pa.int64()), ("at", pa.int32()), ("words", pa.int32()), ("text", pa.string())]))
    width, at, chunks = (block[0].as_py() if len(block) else 1), 0, [pa.array([], kind)]
    for part in text_blocks(texts):
        out = []
        for text, start in zip(text_bytes(part), first.slice(at, len(part)).to_pylist()):
            words, pieces, done = text.split(), [], 0
            while done < len(words):
                local, offset = divmod(start + done, width)
                own = words[done:done + width - offset]
                pieces.append({"local": local, "at": offset, "words": len(own), "text": b" ".join(own).decode()})
                done += len(own)
            out.append(pieces)
        chunks.append(pa.array(out, kind))
        at += len(part)
    return pa.concat_arrays(chunks)


def _sized(docs: DataFrame, keep: list[str]) -> DataFrame:
    """What packing needs of each row; ``row`` carries the columns ``keep``."""
    return docs.select(
        *([F.struct(*[docs[c] for c in keep]).alias("row")] if keep else []),
        docs["source"].cast("string").alias("source"), word_count(docs["text"].cast("string")).alias("size"),
        F.xxhash64(docs["doc_id"], docs["text"]).alias("tie"), docs["doc_id"].alias("doc"))


def _dealt(rows: DataFrame, number: DataFrame) -> DataFrame:
    """Rows with their source's number and their bucket in the source."""
    return rows.withColumnRenamed("source", "name").join(F.broadcast(number), F.expr("name <=> source")) \
        .withColumn("bucket", F.expr("pmod(tie, buckets)")).drop("name", "source", "buckets")


def plan_mix(docs: DataFrame, block: int = 64, shards: int = 256, bucket_rows: int = 2000, seed: int = 11,
             budget: float = 1.5, max_passes: float = 2.0) -> Mix:
    """Pack ``docs`` (doc_id, source, text, further columns) and draw the mix.
    ``shards``: output shards; ``bucket_rows``: mean rows packed together."""
    spark = docs.sparkSession
    slim = written(_sized(docs, []), "mix-sizes")
    per_source = [tuple(r) for r in slim.groupBy("source").agg(F.sum("size"), F.count("*")).collect()]
    per_source.sort(key=lambda r: (r[0] is None, r[0] or ""))
    goal = targets([(s, n) for s, n, _ in per_source], budget, max_passes)
    number = spark.createDataFrame(
        [(i, s, max(1, rows // bucket_rows)) for i, (s, _, rows) in enumerate(per_source)],
        "source_no int, source string, buckets bigint")
    count = _dealt(slim, number).groupBy("source_no", "bucket") \
        .agg(F.ceil(F.sum("size") / F.lit(block)).alias("blocks"))
    ahead = Window.partitionBy("source_no").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = written(count.withColumn("base", F.coalesce(F.sum("blocks").over(ahead), F.lit(0))), "mix-bases")
    total = dict(bases.groupBy("source_no").agg(F.sum("blocks")).collect())
    slots, blocks = [], []
    for i, (s, size, _) in enumerate(per_source):
        n = int(total.get(i) or 0)
        blocks.append(n)
        slots.append(min(int(max_passes * n), round(n * goal[s] / size)) if size else 0)
    catalogue = spark.createDataFrame([(i, s, int(size or 0), float(goal[s])) for i, (s, size, _) in
                                       enumerate(per_source)],
                                      "source_no int, source string, source_size bigint, target double")
    return Mix(docs, slim, number, bases.select("source_no", "bucket", "base"), catalogue,
               _slots(spark, slots, blocks, shards, seed), block)


def _slots(spark: SparkSession, slots: list[int], blocks: list[int], shards: int, seed: int,
           run: int = 1 << 16) -> DataFrame:
    """shard, slot, source_no, block_no of every slot of the mix."""
    shard = max(1, -(-sum(slots) // shards))
    drawn, before = [], np.zeros(len(slots), np.int64)
    for k, take in enumerate(draw_shards(slots, shard, seed)):
        at = np.concatenate([[0], np.cumsum(take)])
        drawn += [(k, i, int(at[i]), int(take[i]), int(before[i]), blocks[i]) for i in np.flatnonzero(take).tolist()]
        before = before + take
    runs = spark.createDataFrame(drawn, "shard int, source_no int, at bigint, n bigint, before bigint, blocks bigint")

    @F.pandas_udf("bigint")
    def block_of(source: pd.Series, i: pd.Series, n: pd.Series) -> pd.Series:
        i, n = i.to_numpy().astype(np.int64), n.to_numpy().astype(np.int64)
        key = (source.to_numpy().astype(np.uint64) + np.uint64(seed * 1009)) * np.uint64(0xD6E8FEB86659FD93) \
            + (i // n).astype(np.uint64)
        return pd.Series(permuted(i % n, n, key * np.uint64(0x9FB21C651E98DF25)))

    # a stated number of parts: the planner would merge the few short rows of runs into one task
    each = runs.withColumn("lo", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1, F.lit(run)))) \
        .repartition(max(1, -(-sum(slots) // (16 * run))), "shard", "source_no", "lo") \
        .withColumn("j", F.explode(F.sequence("lo", F.least(F.col("n"), F.col("lo") + run) - 1)))
    # never null: told to the planner, it does not compute the column twice to check a join's key
    return each.select("shard", (F.col("at") + F.col("j")).alias("slot"), "source_no",
                       F.coalesce(block_of("source_no", F.col("before") + F.col("j"), "blocks"), F.lit(0)).alias("block_no"))


def mix_sources(docs: DataFrame, **params) -> DataFrame:
    """The mixed blocks of ``docs``, piece by piece."""
    return plan_mix(docs, **params).blocks()


def op6_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of each of ``documents``."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    mix = plan_mix(docs)
    return mix.taken().join(F.broadcast(mix.catalogue), "source_no").select(
        F.col("doc").alias("doc_id"), "size", "source_size", "target", "taken")
