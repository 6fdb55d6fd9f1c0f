"""Language-model scoring with Brown class-based bigrams.

``P(w_i | w_{i-1}) = P(c_i | c_{i-1}) * P(w_i | c_i)``: exchange clustering
assigns every word to one of ``classes`` classes; transitions and emissions are
smoothed relative frequencies over all training documents.

*Counting*: word counts over all training tokens (a table that grows with the
corpus; tasks add up their own words before the shuffle, so frequent words cost
one row per task).

*Clustering units*: every word seen at least ``least`` times in training is a
unit of its own, so the units grow with the corpus; every other word, seen or
not, belongs to the unit of its ending (last four bytes, hashed to ``endings``
units), as a rare word by itself shows too few neighbours.  Tasks know the
``head`` most frequent words from a broadcast, and the next ``more`` of them by a
62-bit hash only, as a sorted array (equal hashes share a unit).  Where even that
leaves out words seen ``least`` times, a filter of ``FILTER_BITS`` bits, set by
their hashes, tells them from rare words; they go by the hash, and only what
involves one of them is joined to the table of their classes.

*Bigrams*: one pass over the training texts counts neighbouring units, as one row
per unit with the units beside it and their counts; pairs that involve a hash are
a table of rows.  All rounds work on these two tables.

*Exchange*: each round adds up, for every unit, the classes left and right of it.
These sums decide the moves: a unit is taken out of its class and put where the
likelihood of the class bigrams is highest.  The ``frequent`` most frequent words,
the endings and the end move on the driver, one after the other by falling count;
then all other units, in ``BATCHES`` batches whose units move at once.  A last
pass counts the transitions of the final classes.

*Scoring*: one pass over all texts.  Counts of the most frequent ``head`` words
are broadcast; the other words of a document are joined to the count table, so
the vocabulary is never held in one place, and no frequent word meets the join.

Words: ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased, then one end per text.
Defined cases: null text counts as empty (its only token is the end); a null
``doc_id`` is not learnt from; repeated rows each count; without training
documents every probability comes from the smoothing alone; further columns are
kept, and result columns get trailing underscores where the name is taken.
"""

from __future__ import annotations

from collections import Counter
from copy import copy
from functools import reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.llm.common import crc_mod, drop, free_name, table, text_blocks, text_bytes, written

#: Distinct words a counting task holds before it passes their counts on.
HELD_WORDS = 300_000
#: Additive smoothing of word probabilities, as in the base score.
DELTA = 0.1
#: Weight of the class frequencies in the transitions.
PRIOR = 5.0
END_WORD = b""
#: Batches of units that move at once, in a round.
BATCHES = 4
#: Units whose neighbour counts a task holds, about.
HELD_UNITS = 50_000
#: Distinct bigrams that a counting task holds before it passes them on.
HELD_PAIRS = 700_000
#: Bits of the filter of words beyond the head (8 MB), and of one of its parts,
#: as the engine's bitmap functions have it.
FILTER_BITS = 1 << 26
BITMAP_BITS = 32768


def _count_words(batches):
    counts: Counter = Counter()

    def out():
        batch = pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.binary()), pa.array(counts.values(), pa.int64())],
                                           ["word", "n"])
        counts.clear()
        return batch
    for batch in batches:
        for block in text_blocks(batch.column(0)):
            for text in text_bytes(block):
                counts.update(text.lower().split())
            counts[END_WORD] += len(block)
            if len(counts) > HELD_WORDS:
                yield out()
    yield out()


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, n) over a text column; the end of a text is the empty word."""
    return texts.mapInArrow(_count_words, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def most_frequent(counts: DataFrame, most: int) -> list[tuple[bytes, int]]:
    """At most ``most`` words with the highest counts, by falling count; words
    whose counts agree to 0.1 % are taken together or not at all."""
    level = F.floor(F.log(F.col("n").cast("double")) * 1000).cast("int")
    words = counts.where(F.length("word") > 0)
    above, least = 0, None
    for lv, n in sorted(((r[0], r[1]) for r in words.groupBy(level.alias("lv")).count().collect()), reverse=True):
        if above + n > most:
            break
        above, least = above + n, lv
    if least is None:
        return []
    got = words.where(level >= least).toArrow()
    return sorted(zip(got.column(0).to_pylist(), got.column(1).to_pylist()), key=lambda r: (-r[1], r[0]))


class Units:
    """Clustering units of words, and the counts of the head words.

    Units from 0: the frequent words, the endings, the end (the core, moved on
    the driver), then the head's other words seen ``least`` times, then the words
    of the sorted keys ``more``.  Negative: words beyond these that pass the
    filter ``bits`` (None: none do), see :meth:`key`."""

    def __init__(self, head: list[tuple[bytes, int]], frequent: int, endings: int, least: int):
        self.index = {w: i for i, (w, _) in enumerate(head)}
        self.counts = np.array([n for _, n in head], np.int64)
        own = int((self.counts >= least).sum())
        self.frequent, self.endings, self.least = min(frequent, own), endings, least
        self.bits: bytes | None = None
        self.core = self.frequent + endings + 1
        self.end = self.core - 1
        self.size = self.core + own - self.frequent
        self.of_head = np.array([i if i < self.frequent else self.core + i - self.frequent if i < own else self.of_ending(w)
                                 for i, (w, _) in enumerate(head)], np.int64)
        #: hashes of the units beyond the core
        self.keys = np.array([self.key(w) for w, _ in head[self.frequent:own]], np.int64)
        self.more = np.empty(0, np.int64)

    def know(self, keys: np.ndarray) -> None:
        """Give the words of these keys units of their own, after all others."""
        self.more = np.sort(keys)
        self.keys = np.concatenate([self.keys, self.more])
        self.size += len(keys)

    def light(self) -> Units:
        """The units without their words, for tasks that only see numbers."""
        out = copy(self)
        out.index, out.bits, out.counts, out.of_head, out.more = {}, None, self.counts[:0], self.of_head[:0], self.more[:0]
        return out

    def of_ending(self, word: bytes) -> int:
        return self.frequent + xxhash.xxh64_intdigest(word[-4:]) % self.endings

    def key(self, word: bytes) -> int:
        """A negative number that tells the word's ending, too."""
        own = xxhash.xxh64_intdigest(word) % ((1 << 62) // self.endings)
        return -1 - (own * self.endings + self.of_ending(word) - self.frequent)

    def keys_of(self, words) -> np.ndarray:
        """:meth:`key` of many words."""
        digest, endings, owns = xxhash.xxh64_intdigest, self.endings, (1 << 62) // self.endings
        return np.array([-1 - (digest(w) % owns * endings + digest(w[-4:]) % endings) for w in words], np.int64)

    def ending_of_key(self, key: np.ndarray) -> np.ndarray:
        return self.frequent + (-1 - key) % self.endings

    def beyond(self, keys: np.ndarray) -> np.ndarray:
        """Units of words that the head lacks, by their keys: one of ``more``, the
        key itself if it passes the filter, else that of the ending."""
        unit = self.ending_of_key(keys)
        if len(self.more):
            at = np.minimum(np.searchsorted(self.more, keys), len(self.more) - 1)
            unit = np.where(self.more[at] == keys, self.size - len(self.more) + at, unit)
        if self.bits is not None:
            at = (-1 - keys) // self.endings % FILTER_BITS
            passed = (np.frombuffer(self.bits, np.uint8)[at >> 3] >> (at & 7)) & 1 == 1
            unit = np.where(passed & (unit < self.core), keys, unit)
        return unit

    def of_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(unit, number in the head or -1) of words."""
        at = np.fromiter(map(self.index.get, words, repeat(-1)), np.int64, len(words))
        unit = self.of_head[at] if len(self.of_head) else np.zeros(len(words), np.int64)
        other = np.flatnonzero(at < 0)
        if len(other):
            place: dict[bytes, int] = {}
            own = np.array([place.setdefault(words[i], len(place)) for i in other.tolist()])
            unit[other] = self.beyond(self.keys_of(place))[own]
        return unit, at


def far_filter(far: DataFrame, endings: int) -> bytes | None:
    """The filter of the units beyond the head (column ``unit``): at most
    FILTER_BITS / BITMAP_BITS rows of 4 KB come to the driver."""
    at = F.expr(f"pmod((-1 - unit) div {endings}, {FILTER_BITS})")
    got = far.select(at.alias("at")).groupBy(F.expr(f"at div {BITMAP_BITS}").alias("part")) \
        .agg(F.bitmap_construct_agg(F.expr(f"at % {BITMAP_BITS}")).alias("bits")).collect()
    if not got:
        return None
    out = bytearray(FILTER_BITS // 8)
    step = BITMAP_BITS // 8
    for r in got:
        out[r["part"] * step:(r["part"] + 1) * step] = r["bits"]
    return bytes(out)


def _line_up(units: Units, texts: list[bytes]):
    """Units of all texts of a block, an end before, between and after them."""
    words, sizes = [], []
    for t in texts:
        own = t.lower().split()
        words += own
        sizes.append(len(own))
    unit, at = units.of_words(words)
    place = np.arange(len(words)) + np.repeat(np.arange(len(texts)), sizes) + 1
    line = np.full(len(words) + len(texts) + 1, units.end, np.int64)
    line[place] = unit
    return words, sizes, at, place, line


NEIGHBOURS = "unit bigint, code array<int>, n array<bigint>"
BATCHED = NEIGHBOURS + ", batch int"
#: A task's entries of all units of a bucket; counts of one task fit an int.
BUCKETS = "bucket int, unit array<int>, code array<int>, n array<int>"
#: Entries that a merging task takes in before it adds them up.
HELD_ENTRIES = 2_000_000


def _lists(units: np.ndarray, grid: np.ndarray, step: int = 8192):
    """Rows (unit, code, n) of the counts of a grid that are not 0."""
    for lo in range(0, len(units), step):
        part = grid[lo:lo + step]
        seen = np.flatnonzero(part.any(axis=1))
        row, code = np.nonzero(part[seen])
        ends = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(seen)))]).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [pa.array(units[lo:lo + step][seen].astype(np.int64)),
             pa.ListArray.from_arrays(pa.array(ends), pa.array(code.astype(np.int32))),
             pa.ListArray.from_arrays(pa.array(ends), pa.array(part[seen][row, code].astype(np.int64)))],
            ["unit", "code", "n"])


def _grid(codes: pa.Array, counts: pa.Array, width: int) -> np.ndarray:
    sizes = np.diff(codes.offsets.to_numpy())
    grid = np.zeros((len(sizes), width), np.int64)
    np.add.at(grid, (np.repeat(np.arange(len(sizes)), sizes), codes.flatten().to_numpy(zero_copy_only=False)),
              counts.flatten().to_numpy(zero_copy_only=False))
    return grid


def _pair_lists(units: np.ndarray, codes: np.ndarray, counts: np.ndarray, step: int = 1 << 17):
    """Rows (unit, code, n) of entries sorted by unit; about ``step`` entries a batch."""
    first = np.flatnonzero(np.concatenate([[True], units[1:] != units[:-1]])) if len(units) else np.empty(0, np.int64)
    ends = np.append(first[1:], len(units))
    cuts = np.flatnonzero(np.diff(ends // step)) + 1
    for lo, hi in zip([0, *cuts], [*cuts, len(first)]):
        if lo == hi:
            continue
        s, e = first[lo], ends[hi - 1]
        offsets = pa.array(np.append(first[lo:hi], e) - s, pa.int32())
        yield pa.RecordBatch.from_arrays(
            [pa.array(units[first[lo:hi]].astype(np.int64)),
             pa.ListArray.from_arrays(offsets, pa.array(codes[s:e].astype(np.int32))),
             pa.ListArray.from_arrays(offsets, pa.array(counts[s:e].astype(np.int64)))], ["unit", "code", "n"])


def _summed(codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes, sorted, and their sums."""
    order = np.argsort(codes, kind="stable")
    codes, counts = codes[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]])) if len(codes) else np.empty(0, np.int64)
    return codes[first], np.add.reduceat(counts, first) if len(first) else counts


def _bucket_rows(buckets: int, unit: np.ndarray, code: np.ndarray, n: np.ndarray):
    """One row per bucket (unit modulo ``buckets``) of the entries."""
    bucket = (unit % buckets).astype(np.uint16)
    order = np.argsort(bucket, kind="stable")
    first = np.flatnonzero(np.diff(bucket[order], prepend=-1)) if len(order) else np.empty(0, np.int64)
    offsets = pa.array(np.append(first, len(order)), pa.int32())
    yield pa.RecordBatch.from_arrays(
        [pa.array(bucket[order][first].astype(np.int32)),
         *[pa.ListArray.from_arrays(offsets, pa.array(x[order].astype(np.int32))) for x in (unit, code, n)]],
        ["bucket", "unit", "code", "n"])


def _bigrams(shared: Broadcast, buckets: int):
    """Per task: units beside every unit (code: the unit to the left, or size + the
    unit to the right), where both words' units are known."""
    def rows(batches):
        units = shared.value
        size = units.size
        codes, counts, parts, pending = np.empty(0, np.int64), np.empty(0, np.int32), [], 0

        def merged():
            return _summed(np.concatenate([codes, *[p[0] for p in parts]]), np.concatenate([counts, *[p[1] for p in parts]]))

        def out():
            yield from _bucket_rows(buckets, codes // size, size + codes % size, counts)
            yield from _bucket_rows(buckets, codes % size, codes // size, counts)
        for batch in batches:
            for block in text_blocks(batch.column(0)):
                *_, line = _line_up(units, text_bytes(block))
                left, right = line[:-1], line[1:]
                if units.bits is not None:
                    known = (left >= 0) & (right >= 0)
                    left, right = left[known], right[known]
                code, n = np.unique(left * size + right, return_counts=True)
                parts.append((code, n.astype(np.int32)))
                pending += len(code)
                if pending > HELD_PAIRS:
                    codes, counts = merged()
                    parts, pending = [], 0
                    if len(codes) > HELD_PAIRS:
                        yield from out()
                        codes, counts = codes[:0].copy(), counts[:0].copy()
        codes, counts = merged()
        parts = []
        yield from out()
    return rows


def _merge_buckets(size: int):
    """One row (unit, code, n) per unit.  Entries are added up whenever
    HELD_ENTRIES have come, so a task holds about its units' distinct ones."""
    def rows(batches):
        keys, counts, parts, pending = np.empty(0, np.int64), np.empty(0, np.int64), [], 0

        def merged():
            return _summed(np.concatenate([keys, *[p[0] for p in parts]]), np.concatenate([counts, *[p[1] for p in parts]]))
        for batch in batches:
            unit, code, n = (batch.column(i).flatten().to_numpy().astype(np.int64) for i in (1, 2, 3))
            parts.append((unit * (2 * size) + code, n))
            pending += len(n)
            if pending > HELD_ENTRIES:
                keys, counts = merged()
                parts, pending = [], 0
        keys, counts = merged()
        parts = []
        yield from _pair_lists(keys // (2 * size), keys % (2 * size), counts)
    return rows


def _batch_of(units: Units, unit: np.ndarray) -> np.ndarray:
    """The batch that a unit moves in (-1: the core, on the driver)."""
    key = unit.copy()
    beyond = unit >= units.core
    key[beyond] = units.keys[unit[beyond] - units.core]
    return np.where(key < 0, (-1 - key) // units.endings // 1024 % BATCHES, -1).astype(np.int32)


def _class_counts(shared: Broadcast, classes: int):
    """How often a class stands left (codes under ``classes + 1``) and right of a
    unit, from the units beside it; and the unit's batch."""
    def rows(batches):
        units, class_of = shared.value
        width = classes + 1
        of_code = np.concatenate([class_of, width + class_of]).astype(np.int32)
        for batch in batches:
            if not batch.num_rows:
                continue
            code, n = batch.column(1), batch.column(2)
            sizes = np.diff(code.offsets.to_numpy())
            at = np.repeat(np.arange(len(sizes)), sizes) * (2 * width) + of_code[code.flatten().to_numpy()]
            grid = np.bincount(at, n.flatten().to_numpy(), len(sizes) * 2 * width).astype(np.int64)
            for out in _lists(batch.column(0).to_numpy(), grid.reshape(len(sizes), -1)):
                yield out.append_column("batch", pa.array(_batch_of(units, out.column(0).to_numpy())))
    return rows


def _open_pairs(shared: Broadcast):
    """Neighbours of which at least one lies beyond the head: (l, r, n)."""
    def rows(batches):
        units = shared.value
        for batch in batches:
            for block in text_blocks(batch.column(0)):
                _, _, _, _, line = _line_up(units, text_bytes(block))
                pair = np.stack([line[:-1], line[1:]], axis=1)
                pair, n = np.unique(pair[(pair < 0).any(axis=1)], axis=0, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(pair[:, 0]), pa.array(pair[:, 1]), pa.array(n.astype(np.int64))], ["l", "r", "n"])
    return rows


def _closed(shared: Broadcast, classes: int):
    """(unit, code, n) of pairs (l, r, n, lc, rc); a class beyond the head is
    null where the word is seen too rarely for a unit of its own."""
    def rows(batches):
        units, class_of = shared.value
        for batch in batches:
            n = batch.column(2)
            sides = []
            for key, cls in ((0, 3), (1, 4)):
                unit = batch.column(key).to_numpy()
                own = batch.column(cls).fill_null(-1).to_numpy()
                unit = np.where((unit < 0) & (own < 0), units.ending_of_key(unit), unit)
                sides.append((unit, np.where(unit < 0, own, class_of[np.maximum(unit, 0)])))
            (l, lc), (r, rc) = sides
            for unit, code in ((r, lc), (l, classes + 1 + rc)):
                yield pa.RecordBatch.from_arrays([pa.array(unit), pa.array(code.astype(np.int32)), n], ["unit", "code", "n"])
    return rows


def _add_up(shared: Broadcast, width: int):
    """One row (unit, code, n, batch) per unit of a task's rows."""
    def rows(batches):
        units, _ = shared.value
        place: dict[int, int] = {}
        grid = np.zeros((1024, width), np.int64)
        for batch in batches:
            unit, own = np.unique(batch.column(0).to_numpy(), return_inverse=True)
            at = np.array([place.setdefault(u, len(place)) for u in unit.tolist()], np.int64)
            while len(place) > len(grid):
                grid = np.concatenate([grid, np.zeros_like(grid)])
            np.add.at(grid, at[own], _grid(batch.column(1), batch.column(2), width))
        for out in _lists(np.fromiter(place, np.int64, len(place)), grid[:len(place)]):
            yield out.append_column("batch", pa.array(_batch_of(units, out.column(0).to_numpy())))
    return rows


class Clustering:
    """The classes of all units, and their neighbour counts.  ``class_of``:
    core and head; ``far``: a table (unit, c) of the units beyond the head."""

    def __init__(self, texts: DataFrame, units: Units, classes: int, far_words: DataFrame | None, tokens: int):
        self.units, self.classes, self.width = units, classes, classes + 1
        self.spark = texts.sparkSession
        self.class_of = np.arange(units.size) % classes
        self.class_of[units.end] = classes
        # by the word's hash: its key modulo a number hangs on the ending
        self.class_of[units.core:] = (-1 - units.keys) // units.endings % classes
        shared = self.spark.sparkContext.broadcast(units)
        deal = max(8, tokens >> 20)
        self.bigrams = written(texts.mapInArrow(_bigrams(shared, min(8 * deal, 1 << 16)), BUCKETS).repartition(deal, "bucket")
                               .mapInArrow(_merge_buckets(units.size), NEIGHBOURS), "lm-bigrams")
        self.far = self.pairs = self.summed = None
        self.old: list[DataFrame] = []
        far = 0
        if far_words is not None:
            self.far = far_words.select("unit", F.expr(f"cast((-1 - unit) div {units.endings} % {classes} as int)").alias("c"))
            self.pairs = written(texts.mapInArrow(_open_pairs(shared), "l bigint, r bigint, n bigint")
                                 .groupBy("l", "r").agg(F.sum("n").alias("n")), "lm-pairs")
            far = far_words.count()
        shared.destroy()
        self.parts = max(8, (units.size + far) // HELD_UNITS + 1)

    def count(self) -> None:
        """Neighbour counts under the present classes: ``seen`` of the core,
        the table ``rest`` of all others."""
        shared = self.spark.sparkContext.broadcast((self.units.light(), self.class_of))
        rows = self.bigrams.mapInArrow(_class_counts(shared, self.classes), BATCHED)
        if self.pairs is not None:
            near = self.pairs
            for side in "lr":
                own = self.far.select(F.col("unit").alias(side), F.col("c").alias(side + "c"))
                near = near.join(own, side, "left")
            more = near.select("l", "r", "n", "lc", "rc") \
                .mapInArrow(_closed(shared, self.classes), "unit bigint, code int, n bigint") \
                .groupBy("unit", "code").agg(F.sum("n").alias("n"))
            rows = rows.drop("batch").union(more.select("unit", F.array("code"), F.array("n"))) \
                .repartition(self.parts, "unit").mapInArrow(_add_up(shared, 2 * self.width), BATCHED)
        summed = written(rows, "lm-neighbours")
        shared.destroy()
        drop(self.summed)
        self.summed = summed
        core = summed.where("batch < 0").toArrow().combine_chunks()
        self.seen = np.zeros((self.units.core, 2 * self.width))
        for b in core.to_batches():
            self.seen[b.column(0).to_numpy()] = _grid(b.column(1), b.column(2), 2 * self.width)
        self.seen = self.seen.reshape(-1, 2, self.width)
        rest = summed.where("batch >= 0")
        self.rest = rest.join(self.far, "unit", "left") if self.far is not None else \
            rest.withColumn("c", F.lit(None).cast("int"))

    def close(self) -> None:
        """Delete what only the rounds have read."""
        drop(self.bigrams, self.pairs, self.summed)

    def moved(self, batch: int | None, sums: np.ndarray | None) -> tuple[DataFrame, np.ndarray]:
        """New classes (unit, c) of a batch of ``rest``, and what its moves
        change in the sums of classes; without a batch, those sums."""
        rows = self.rest if batch is None else self.rest.where(F.col("batch") == batch)
        # the core's classes decide nothing here
        of_head = self.class_of[self.units.core:].astype(np.int16)
        out = written(rows.select("unit", "code", "n", "c").mapInArrow(
            _moves(of_head, self.units.core, self.classes, sums), "unit bigint, c int, sums binary"), "lm-moves")
        change = np.zeros((2, self.width, self.width))
        for r in out.where("unit IS NULL").select("sums").collect():
            change += np.frombuffer(r[0]).reshape(change.shape)
        if batch is None:
            drop(out)
        else:
            self.old.append(out)
        return out.where("unit IS NOT NULL").select("unit", "c"), change

    def sums(self, others: np.ndarray) -> np.ndarray:
        """[left or right, class, class beside it] over all units."""
        return others + class_sums(self.seen, self.class_of[:self.units.core], self.width)

    def round(self) -> None:
        before, self.old = self.old, []
        self.count()
        _, others = self.moved(None, None)
        self.class_of[:self.units.core] = exchange(self.seen, self.class_of[:self.units.core], self.classes, others)
        done = []
        for batch in range(BATCHES):
            classes, change = self.moved(batch, self.sums(others))
            others = others + change
            done.append(classes)
        new = reduce(DataFrame.union, done)
        head = new.where("unit >= 0").toArrow()
        self.class_of[head.column(0).to_numpy()] = head.column(1).to_numpy()
        if self.far is not None:
            self.far = new.where("unit < 0")
        drop(*before)


def _far_words(shared: Broadcast):
    """(word, n, unit): the hash of a word beyond the head and ``more`` that the
    filter passes (any, while there is no filter), null for all others."""
    def rows(batches):
        units = shared.value
        for batch in batches:
            unit = np.zeros(batch.num_rows, np.int64)
            words = batch.column(0).to_pylist()
            other = [i for i, w in enumerate(words) if w and w not in units.index]
            keys = units.keys_of(words[i] for i in other)
            unit[other] = keys if units.bits is None else np.minimum(units.beyond(keys), 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(unit, mask=unit >= 0)], ["word", "n", "unit"])
    return rows


def most_seen(far: DataFrame, most: int) -> np.ndarray:
    """Keys (column ``unit``) of at most ``most`` words with the highest counts;
    words whose counts agree to 0.1 % are taken together or not at all."""
    level = F.floor(F.log(F.col("n").cast("double")) * 1000).cast("int")
    above, least = 0, None
    for lv, n in sorted(((r[0], r[1]) for r in far.groupBy(level.alias("lv")).count().collect()), reverse=True):
        if above + n > most:
            break
        above, least = above + n, lv
    if least is None:
        return np.empty(0, np.int64)
    return far.where(level >= least).select("unit").toArrow().column(0).to_numpy()


def _moves(of_head: np.ndarray, core: int, classes: int, sums: np.ndarray | None, step: int = 512):
    """Best class of every unit by the same ``sums``; a last row holds the
    change of the sums (without ``sums``: the task's share of them)."""
    def rows(batches):
        width = classes + 1
        change = np.zeros((2, width, width))
        for batch in batches:
            unit = batch.column(0).to_numpy()
            old = batch.column(3).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            near = unit >= 0
            old[near] = of_head[unit[near] - core]
            seen = _grid(batch.column(1), batch.column(2), 2 * width).reshape(-1, 2, width).astype(float)
            if sums is None:
                change += class_sums(seen, old, width)
                continue
            new = np.concatenate([best_classes(seen[i:i + step], old[i:i + step], sums, classes)
                                  for i in range(0, len(unit), step)] or [old])
            change += class_sums(seen, new, width) - class_sums(seen, old, width)
            yield pa.RecordBatch.from_arrays(
                [pa.array(unit), pa.array(new.astype(np.int32)), pa.nulls(len(unit), pa.binary())], ["unit", "c", "sums"])
        yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, pa.int32()),
                                          pa.array([change.tobytes()], pa.binary())], ["unit", "c", "sums"])
    return rows


def class_sums(seen: np.ndarray, class_of: np.ndarray, width: int) -> np.ndarray:
    out = np.zeros((2, width, width))
    for side in (0, 1):
        np.add.at(out[side], class_of, seen[:, side])
    return out


def best_classes(seen: np.ndarray, old: np.ndarray, sums: np.ndarray, classes: int) -> np.ndarray:
    """The class of highest likelihood of each unit, all others unmoved."""
    gain, at = np.zeros((len(seen), classes)), np.arange(len(seen))
    for side in (0, 1):
        own = seen[:, side]
        a = np.repeat(sums[side][None, :classes], len(seen), axis=0)
        a[at, old] -= own
        total, n = a.sum(axis=2), own.sum(axis=1)[:, None]
        gain += (_xlogx(a + own[:, None]) - _xlogx(a)).sum(axis=2) - _xlogx(total + n) + _xlogx(total)
    new = gain.argmax(axis=1)
    return np.where(gain[at, new] <= gain[at, old] + 1e-9, old, new)


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1.0))


def exchange(seen: np.ndarray, class_of: np.ndarray, classes: int, others: np.ndarray | None = None) -> np.ndarray:
    """New classes after one sweep over all units (the last, the end, stays in
    the last class).  ``seen``: neighbour counts under ``class_of``;
    ``others``: sums of the classes over units that do not move here."""
    class_of = class_of.copy()
    left, right = seen[:, 0], seen[:, 1]
    # [class, class before it], [class, class after it]
    into, onto = class_sums(seen, class_of, classes + 1) + (0 if others is None else others)
    for u in np.argsort(-left[:-1].sum(axis=1), kind="stable").tolist():
        if not left[u].any():
            break  # never seen: keeps its first class
        old = class_of[u]
        into[old] -= left[u]
        onto[old] -= right[u]
        a, b = into[:classes], onto[:classes]
        gain = (_xlogx(a + left[u]) - _xlogx(a)).sum(axis=1) + (_xlogx(b + right[u]) - _xlogx(b)).sum(axis=1)
        na, nb = a.sum(axis=1), b.sum(axis=1)
        gain -= _xlogx(na + left[u].sum()) - _xlogx(na) + _xlogx(nb + right[u].sum()) - _xlogx(nb)
        new = int(gain.argmax())
        if gain[new] <= gain[old] + 1e-9:
            new = old
        class_of[u] = new
        into[new] += left[u]
        onto[new] += right[u]
    return class_of


class ClassModel:
    """Transitions and emissions; everything but the rare words' counts."""

    def __init__(self, units, class_of, transitions, class_tokens, class_words, tokens, vocabulary, end_count):
        self.units, self.class_of = units, class_of
        share = (transitions.sum(axis=0) + 1) / (transitions.sum() + len(transitions))
        self.step = np.log10((transitions + PRIOR * share) / (transitions.sum(axis=1, keepdims=True) + PRIOR))
        #: log10 of the denominators of a class's emissions
        self.below = np.log10(class_tokens + DELTA * (class_words + 1))
        self.tokens, self.vocabulary, self.end_count = tokens, vocabulary, end_count
        self.base_below = float(np.log10(tokens + DELTA * (vocabulary + 1)))


def _per_class(shared: Broadcast, classes: int):
    def rows(batches):
        units, class_of = shared.value
        n, words = np.zeros(classes, np.int64), np.zeros(classes, np.int64)
        for batch in batches:
            unit, _ = units.of_words(batch.column(0).to_pylist())
            count = batch.column(1).to_numpy(zero_copy_only=False)
            here = (unit >= 0) | (count < units.least)  # other words are in the table of their classes
            unit, count = unit[here], count[here]
            cls = class_of[np.where(unit < 0, units.ending_of_key(unit), unit)]
            n += np.bincount(cls, count, classes).astype(np.int64)
            words += np.bincount(cls, minlength=classes)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(classes)), pa.array(n), pa.array(words)], ["c", "n", "words"])
    return rows


KEYED = "word binary, n bigint, unit bigint"


def train(texts: DataFrame, counts: DataFrame, classes: int = 32, frequent: int = 8192, endings: int = 4096,
          head: int = 1 << 17, rounds: int = 3, least: int = 20, more: int = 1 << 21) -> tuple[ClassModel, DataFrame, DataFrame | None]:
    """``texts``: one column, the training texts; ``counts``: their word counts.
    The model, ``counts`` with the class ``own`` of words beyond the head that have
    units of their own, and these units' classes (unit, c), if there are any."""
    spark = texts.sparkSession
    tokens, vocabulary, ends = counts.agg(
        F.sum("n"), F.count("*"), F.sum(F.when(F.length("word") == 0, F.col("n")).otherwise(0))).first()
    known = most_frequent(counts, head)
    many = counts.where((F.length("word") > 0) & (F.col("n") >= least)).count()
    units = Units(known, frequent, endings, least)
    far_words = None
    if many > sum(n >= least for _, n in known):
        shared = spark.sparkContext.broadcast(units)
        far_words = written(counts.where(F.col("n") >= least).mapInArrow(_far_words(shared), KEYED)
                            .where("unit IS NOT NULL").groupBy("unit").agg(F.sum("n").alias("n"), F.count("*").alias("words")),
                            "lm-far")
        shared.destroy()
        units.know(most_seen(far_words, more))
        if len(units.more) < far_words.count():
            known_ones = spark.createDataFrame(pa.table({"unit": units.more}))
            far_words = written(far_words.join(known_ones, "unit", "left_anti"), "lm-far")
            units.bits = far_filter(far_words, endings)
        else:
            far_words = None
    clustering = Clustering(texts, units, classes, far_words, int(tokens or 0))
    for _ in range(rounds):
        clustering.round()
    clustering.count()
    transitions = clustering.sums(clustering.moved(None, None)[1])[1]
    class_of = clustering.class_of
    shared = spark.sparkContext.broadcast((units, class_of))
    n, words = np.zeros(classes), np.zeros(classes)
    for c, s, w in counts.where(F.length("word") > 0).mapInArrow(_per_class(shared, classes), "c bigint, n bigint, words bigint") \
            .groupBy("c").agg(F.sum("n"), F.sum("words")).collect():
        n[c], words[c] = s, w
    classed = counts.withColumn("own", F.lit(None).cast("int"))
    if far_words is not None:
        far = written(clustering.far, "lm-far-classes")
        for c, s, w in far.join(far_words, "unit").groupBy("c").agg(F.sum("n"), F.sum("words")).collect():
            n[c] += s
            words[c] += w
        keys = spark.sparkContext.broadcast(units)
        keyed = counts.mapInArrow(_far_words(keys), KEYED)
        own = keyed.where("unit IS NOT NULL").join(far, "unit", "left").select("word", "n", F.col("c").alias("own"))
        classed = written(keyed.where("unit IS NULL").select("word", "n", F.lit(None).cast("int").alias("own")).union(own),
                          "lm-classed")
        model_far = far
    else:
        model_far = None
    clustering.close()
    drop(*clustering.old)
    # a text's end is its class's only word; without any text nothing is known
    model = ClassModel(units, class_of, transitions, n, words, int(tokens or 0), int(vocabulary or 0) if ends else 0,
                       int(ends or 0))
    return model, classed, model_far


def _score_rows(shared: Broadcast):
    def rows(batches):
        m: ClassModel = shared.value
        head_log = np.log10(m.units.counts + DELTA)
        end_log = float(np.log10(m.end_count + DELTA)) - m.base_below
        for batch in batches:
            at_row = 0
            for block in text_blocks(batch.column(1)):
                words, sizes, at, place, line = _line_up(m.units, text_bytes(block))
                # a class, or the key of a word beyond the head
                cls = np.where(line < 0, line, m.class_of[np.maximum(line, 0)])
                n_docs = len(sizes)
                doc = np.repeat(np.arange(n_docs), sizes)
                # the transition into position i belongs to the text that i ends or lies in
                owner = np.repeat(np.arange(n_docs), np.array(sizes, np.int64) + 1)
                told = (cls[:-1] >= 0) & (cls[1:] >= 0)
                score = np.bincount(owner[told], m.step[cls[:-1][told], cls[1:][told]], n_docs).astype(float)
                word_class = cls[place]
                known = at >= 0
                log_n = head_log[at[known]] if known.any() else np.empty(0)
                score += np.bincount(doc[known], log_n - m.below[word_class[known]], n_docs)
                base = np.bincount(doc[known], log_n - m.base_below, n_docs) + end_log
                known_n = np.bincount(doc[known], minlength=n_docs)
                rest: list[dict] = [{} for _ in sizes]
                rare_at = np.flatnonzero(~known)
                for i, d in zip(rare_at.tolist(), doc[rare_at].tolist()):
                    own, w = rest[d], words[i]
                    own[w] = own.get(w, 0) + 1
                flat_w = [w for own in rest for w in own]
                flat_n = [n for own in rest for n in own.values()]
                # a word beyond all broadcasts has the class of its ending until it is joined
                unit = line[place[rare_at]]
                rare_class = m.class_of[np.where(unit < 0, m.units.ending_of_key(unit), unit)]
                class_here = dict(zip((words[i] for i in rare_at.tolist()), rare_class.tolist()))
                flat_c = np.fromiter(map(class_here.get, flat_w), np.int32, len(flat_w))
                ends = np.concatenate([[0], np.cumsum([len(own) for own in rest])]).astype(np.int32)
                rare = pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays(
                    [pa.array(flat_w, pa.binary()), pa.array(flat_n, pa.int64()), pa.array(flat_c, pa.int32())],
                    ["word", "k", "c"]))
                more = []
                if m.units.bits is not None:
                    more = [_open_steps(owner[~told], cls[:-1][~told], cls[1:][~told], n_docs, m)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at_row, n_docs), pa.array(np.array(sizes, np.int64) + 1),
                     pa.array(known_n.astype(np.int64) + (1 if m.end_count else 0)), pa.array(base), pa.array(score), rare, *more],
                    ["id", "n_tokens", "n_known", "base", "score", "rare", "steps"][:6 + len(more)])
                at_row += n_docs
    return rows


def _open_steps(owner: np.ndarray, left: np.ndarray, right: np.ndarray, n_docs: int, m: ClassModel) -> pa.Array:
    """Per text: (l, r, lc, rc) of steps from or to a word beyond the head:
    its key, and the class (of its ending, where it is beyond the head)."""
    ends = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=n_docs))]).astype(np.int32)
    cls = [np.where(x < 0, m.class_of[m.units.ending_of_key(np.minimum(x, -1))], x).astype(np.int32) for x in (left, right)]
    return pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays(
        [pa.array(left), pa.array(right), pa.array(cls[0]), pa.array(cls[1])], ["l", "r", "lc", "rc"]))


def _far_steps(first: DataFrame, far: DataFrame, model: ClassModel) -> DataFrame:
    """(id, far_score): log10 of the transitions that involve a word beyond the head."""
    steps = first.select(F.col("id.id").alias("id"), F.explode("steps").alias("s")).select("id", "s.*")
    for side in "lr":
        own = far.select(F.col("unit").alias(side), F.col("c").alias("own"))
        # a class is no key and meets nothing
        steps = steps.join(own, side, "left").withColumn(side + "c", F.coalesce("own", side + "c")).drop("own")
    n = len(model.step)
    table_ = first.sparkSession.createDataFrame(
        [(i, j, float(model.step[i, j])) for i in range(n) for j in range(n)], "lc int, rc int, step double")
    return steps.join(F.broadcast(table_), ["lc", "rc"]).groupBy("id").agg(F.sum("step").alias("far_score"))


def score_documents(docs: DataFrame, learn: Column, **params) -> DataFrame:
    """``docs`` (without ``text``) plus n_tokens, n_known, train_tokens,
    base_score, score (log10 probabilities) and perplexity."""
    spark = docs.sparkSession
    texts = docs.where(learn).select(F.col("text").cast("string").alias("text"))
    counts = written(word_counts(texts), "lm-counts")
    model, classed, far = train(texts, counts, **params)
    names = [c for c in docs.columns if c != "text"]
    rowed = docs.select(F.monotonically_increasing_id().alias("id"), F.struct(*[docs[c] for c in names]).alias("row"),
                        F.col("text").cast("string").alias("text"))
    keyed = F.struct("id", "row")
    shared = spark.sparkContext.broadcast(model)
    kind = rowed.select(keyed.alias("x")).schema["x"].dataType
    first = written(rowed.select(keyed.alias("key"), "text").mapInArrow(
        _score_rows(shared), f"id {kind.simpleString()}, n_tokens bigint, n_known bigint, base double, score double, "
                             "rare array<struct<word:binary,k:bigint,c:int>>"
                             + ("" if far is None else ", steps array<struct<l:bigint,r:bigint,lc:int,rc:int>>")), "lm-first")
    below = F.array(*[F.lit(float(b)) for b in model.below])
    rare = first.select(F.col("id.id").alias("id"), F.explode("rare").alias("r")).select("id", "r.*")
    rare = rare.join(classed, "word", "left").withColumn("c", F.coalesce("own", "c")) \
        .withColumn("log_n", F.log10(F.coalesce("n", F.lit(0)) + F.lit(DELTA))) \
        .groupBy("id").agg(
            F.sum(F.when(F.col("n").isNotNull(), F.col("k")).otherwise(0)).alias("more_known"),
            F.sum(F.col("k") * (F.col("log_n") - F.lit(model.base_below))).alias("more_base"),
            F.sum(F.col("k") * (F.col("log_n") - F.element_at(below, F.col("c") + 1))).alias("more_score"))
    slim = first.select(F.col("id.id").alias("id"), F.col("id.row").alias("row"), "n_tokens", "n_known", "base", "score")
    zero = F.lit(0.0)
    more = F.coalesce("more_score", zero)
    if far is not None:
        slim = slim.join(_far_steps(first, far, model), "id", "left")
        more = more + F.coalesce("far_score", zero)
    out = slim.join(rare, "id", "left").select(
        "row", "n_tokens", (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(model.tokens).cast("bigint").alias("train_tokens"),
        (F.col("base") + F.coalesce("more_base", zero)).alias("base_score"),
        (F.col("score") + more).alias("score"))
    out = out.withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))
    return out.select(*[F.col("row")[c].alias(c) for c in names], *[
        F.col(c).alias(free_name(names, c))
        for c in ("n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity")])


def op5_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class-bigram score of all ``documents``."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score_documents(docs, crc_mod("doc_id", 10) != 0)
    return scored.select("doc_id", (crc_mod("doc_id", 10) == 0).alias("held_out"), "n_tokens", "n_known",
                         "train_tokens", "base_score", "score", "perplexity")
