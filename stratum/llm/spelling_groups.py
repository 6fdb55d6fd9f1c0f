"""Spelling variants: words one edit apart, found in a frequency-vector trie.

Words are the maximal runs of ``[A-Za-z\\u00C0-\\u00FF]`` with A-Z lower-cased.  A
word's vector holds its length, then its counts of letters by *letter group*
(code point mod 32, so a to z are apart); groups come by falling variance over
all words.  Arranged by successive counts the vectors form a trie.  One replaced
code point raises one count by one and lowers one by one (or changes none), one
inserted code point raises length and one count: two subtrees are walked
together with a budget of one surplus and one deficit (a surplus only, where the
second is a letter longer), and a pair of nodes is dropped when it is overspent.
What is left when a pair of nodes holds few words is verified on the words.

*Spark* walks the upper levels: tables of counted nodes and of node pairs, one
level at a time, extending only pairs of existing nodes that still hold more than
``leaves`` words; the words below every other pair meet in one task, which walks
on depth-first with numpy, chunk by chunk.  A pair of words is found once, its
two words are credited within the task, and their sums are added up by word.
Forms are followed to their roots by pointer doubling: a form is at least twice
as frequent as its word, so chains are short.

Defined cases: a null text has no words; a null ``doc_id`` counts as empty text in
the deletion rule; repeated rows each count; an empty table gives an empty
table; other columns are not read.  Counts are over all documents.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.llm.common import table, written

LETTER = "[A-Za-z\\u00C0-\\u00FF]"
GROUPS = 32
#: Node pairs, or word pairs, that a task expands at a time.
CHUNK = 1 << 17
#: Word pairs below a node pair that are verified without descending further.
FEW = 16
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


# ------------------------------------------------------------------ words
def spelled(doc_id: Column, run: Column, every: int) -> Column:
    """The run with a code point deleted where crc32(``doc_id:run``) is divisible
    by ``every`` (the code point at crc32 mod length)."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = (h % F.char_length(run)).cast("int")
    return F.when(h % every == 0, F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.char_length(run)))) \
        .otherwise(run)


def count_words(docs: DataFrame, min_chars: int = 5, min_count: int = 3, every: int = 97) -> DataFrame:
    """(``word``, ``n``) of all words of at least ``min_chars`` code points seen
    at least ``min_count`` times."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    # runs that are too short before a deletion are too short after it
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all(text, F.lit(f"{LETTER}{{{min_chars},}}"), F.lit(0)))
                       .alias("run"))
    words = runs.select("doc_id", F.translate("run", UPPER, LOWER).alias("run"))
    words = words.select(spelled(F.col("doc_id"), F.col("run"), every).alias("word"))
    return words.groupBy("word").agg(F.count("*").alias("n")) \
        .where((F.col("n") >= min_count) & (F.char_length("word") >= min_chars))


# ------------------------------------------------------- node pairs in Spark
def letters(group: int) -> str:
    """The letters of a group."""
    alphabet = [*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100)]
    return "".join(chr(c) for c in alphabet if c % GROUPS == group)


def with_vectors(words: DataFrame) -> DataFrame:
    """``words`` (word, n) plus ``size`` and ``counts``, groups by falling variance."""
    size = F.char_length("word")
    count = [(size - F.char_length(F.translate("word", letters(g), ""))).cast("int") for g in range(GROUPS)]
    counted = written(words.select("word", "n", size.cast("int").alias("size"), F.array(*count).alias("counts")),
                      "spelling-counts")
    spread = counted.agg(*[F.coalesce(F.var_pop(F.col("counts")[g]), F.lit(0.0)).alias(f"g{g}")
                           for g in range(GROUPS)]).first()
    order = sorted(range(GROUPS), key=lambda g: (-spread[g], g))
    return counted.withColumn("counts", F.array(*[F.col("counts")[g] for g in order]))


def node_of(depth: int) -> Column:
    """A word's node: its length and the first ``depth`` counts, as text."""
    return F.concat_ws(",", F.col("size").cast("string"), F.slice("counts", 1, depth).cast("array<string>")) \
        if depth else F.col("size").cast("string")


def _sized(words: DataFrame, depth: int) -> DataFrame:
    """Existing nodes of a level: ``node``, its ``parent``, last count ``c``, ``words``."""
    count = F.col("counts")[depth - 1] if depth else F.lit(0)
    parent = node_of(depth - 1) if depth else F.lit("")
    return words.groupBy(node_of(depth).alias("node"), parent.alias("parent"), count.alias("c"), "size") \
        .agg(F.count("*").alias("words"))


def node_pairs(words: DataFrame, leaves: int) -> DataFrame:
    """Pairs (``depth``, ``a``, ``b``, ``longer``) of nodes whose words must meet:
    nodes with at most ``leaves`` words in both, or of the last level.
    ``longer``: 1 where b's words are a letter longer than a's, else 0; a pair of
    equally long nodes comes once."""
    nodes = written(_sized(words, 0), "spelling-nodes")
    pairs = nodes.select(F.col("node").alias("a"), F.col("words").alias("na"), "size",
                         F.explode(F.array(F.lit(0), F.lit(1))).alias("longer")) \
        .select("a", "na", "longer", (F.col("size") + F.col("longer")).alias("size")) \
        .join(nodes.select(F.col("node").alias("b"), F.col("words").alias("nb"), "size"), "size") \
        .select("a", "b", "na", "nb", "longer", F.lit(1).alias("surplus"), (1 - F.col("longer")).alias("deficit"))
    found, depth = None, 0
    while True:
        pairs = written(pairs, "spelling-pairs")
        small = F.lit(depth == GROUPS) | (F.col("na") + F.col("nb") <= leaves)
        done = pairs.where(small).select(F.lit(depth).alias("depth"), "a", "b", "longer")
        found = done if found is None else found.union(done)
        crowded = pairs.where(~small)
        if depth == GROUPS or not crowded.take(1):
            return found
        depth += 1
        nodes = written(_sized(words, depth), "spelling-nodes")
        first = nodes.select(F.col("parent").alias("a"), F.col("node").alias("a2"), F.col("c").alias("ca"),
                             F.col("words").alias("na2"))
        second = nodes.select(F.col("parent").alias("b"), F.col("node").alias("b2"), F.col("c").alias("cb"),
                              F.col("words").alias("nb2"))
        more = F.col("cb") - F.col("ca")
        pairs = crowded.join(first, "a").join(second, "b") \
            .withColumn("surplus", F.col("surplus") - F.greatest(more, F.lit(0))) \
            .withColumn("deficit", F.col("deficit") + F.least(more, F.lit(0))) \
            .where("surplus >= 0 and deficit >= 0 and (a <> b or a2 <= b2)") \
            .select(F.col("a2").alias("a"), F.col("b2").alias("b"), F.col("na2").alias("na"), F.col("nb2").alias("nb"),
                    "longer", "surplus", "deficit")


# ------------------------------------------------------- the walk in a task
class Trie:
    """Sorted vectors as a trie: per level the first row of every node, and of
    every node its first child."""

    def __init__(self, vectors: np.ndarray):
        n, depth = vectors.shape
        fresh = np.zeros(n, bool)
        if n:
            fresh[0] = True
        self.rows, self.first, self.value = [np.array([0, n])], [], []
        for d in range(depth):
            if n > 1:
                fresh[1:] |= vectors[1:, d] != vectors[:-1, d]
            ids = np.cumsum(fresh)
            start = np.flatnonzero(fresh)
            self.first.append(np.append(ids[self.rows[-1][:-1]] - 1, len(start)))
            self.value.append(vectors[start, d])
            self.rows.append(np.append(start, n))


def _product(first_a, na, first_b, nb):
    """All (a, b) of the ranges first_a[i] + [0, na[i]) and first_b[i] + [0, nb[i]),
    and the i they come from."""
    size = na * nb
    at = np.repeat(np.arange(len(size)), size)
    k = np.arange(len(at)) - np.repeat(np.cumsum(size) - size, size)
    return first_a[at] + k // nb[at], first_b[at] + k % nb[at], at


def walk(a: Trie, b: Trie, surplus: int, deficit: int):
    """Row pairs below all node pairs within the budget, as blocks of (rows of
    a, rows of b).  Depth-first over blocks of at most CHUNK node pairs."""
    depth = len(a.first)
    one = np.array([0])
    stack = [(0, one, one, np.array([surplus]), np.array([deficit]))]
    while stack:
        d, x, y, up, down = stack.pop()
        if len(x) > CHUNK:
            half = len(x) // 2
            stack += [(d, x[half:], y[half:], up[half:], down[half:]), (d, x[:half], y[:half], up[:half], down[:half])]
            continue
        lo_a, lo_b = a.rows[d][x], b.rows[d][y]
        na, nb = a.rows[d][x + 1] - lo_a, b.rows[d][y + 1] - lo_b
        leaf = (na * nb <= FEW) | (d == depth)
        if leaf.any():
            yield from _blocks(lo_a[leaf], na[leaf], lo_b[leaf], nb[leaf])
        if leaf.all():
            continue
        x, y, up, down = x[~leaf], y[~leaf], up[~leaf], down[~leaf]
        ca, cb = a.first[d][x], b.first[d][y]
        x, y, at = _product(ca, a.first[d][x + 1] - ca, cb, b.first[d][y + 1] - cb)
        more = b.value[d][y].astype(np.int64) - a.value[d][x]
        up, down = up[at] - np.maximum(more, 0), down[at] + np.minimum(more, 0)
        fits = (up >= 0) & (down >= 0)
        if fits.any():
            stack.append((d + 1, x[fits], y[fits], up[fits], down[fits]))


def _blocks(lo_a, na, lo_b, nb):
    """The ranges' row pairs, about CHUNK at a time; a larger product is cut."""
    size = na * nb
    big = size > CHUNK
    for la, n, lb, m in zip(lo_a[big], na[big], lo_b[big], nb[big]):
        step = max(1, CHUNK // int(m))
        for k in range(0, int(n), step):
            x, y, _ = _product(np.array([la + k]), np.array([min(step, int(n) - k)]), np.array([lb]), np.array([m]))
            yield x, y
    lo_a, na, lo_b, nb, size = lo_a[~big], na[~big], lo_b[~big], nb[~big], size[~big]
    part = np.cumsum(size) // CHUNK
    cuts = np.flatnonzero(np.diff(part)) + 1
    for lo, hi in zip([0, *cuts], [*cuts, len(size)]):
        if lo < hi:
            x, y, _ = _product(lo_a[lo:hi], na[lo:hi], lo_b[lo:hi], nb[lo:hi])
            yield x, y


def one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which rows of two letter matrices differ by exactly one replaced letter
    (equal widths) or by one letter that b has more."""
    width = a.shape[1]
    if b.shape[1] == width:
        return (a != b).sum(axis=1) == 1
    front = np.logical_and.accumulate(a == b[:, :-1], axis=1).sum(axis=1)
    back = np.logical_and.accumulate((a == b[:, 1:])[:, ::-1], axis=1).sum(axis=1)
    return front + back >= width


def _side(words: list[bytes], n: np.ndarray, counts: np.ndarray, own: np.ndarray):
    order = np.lexsort(counts.T[::-1]) if len(words) else np.array([], np.int64)
    width = len(words[0]) if words else 0
    text = np.frombuffer(b"".join(words), np.uint8).reshape(len(words), width)
    return text[order], n[order], counts[order], own[order]


def near_words(first, second, longer: int, budget: int = 1):
    """Positions (in the sorted sides) of all pairs one edit apart."""
    a, _, va, _ = first
    b, _, vb, own = second
    if not len(a) or not len(b):
        return
    step = max(1, (8 << 20) // max(1, a.shape[1]))
    for x, y in walk(Trie(va), Trie(vb), budget, budget - longer):
        for lo in range(0, len(x), step):
            i, j = x[lo:lo + step], y[lo:lo + step]
            near = one_edit(a[i], b[j])
            i, j = i[near], j[near]
            if not longer and len(i):  # within one node every pair is met twice
                keep = ~own[j] | _before(a[i], b[j])
                i, j = i[keep], j[keep]
            if len(i):
                yield i, j


def _before(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether row a < row b, for rows that differ."""
    at = np.argmax(a != b, axis=1)[:, None]
    return (np.take_along_axis(a, at, 1) < np.take_along_axis(b, at, 1))[:, 0]


class _Credit:
    """Per word of a side: near words, and the best of them by (n, smaller word)."""

    def __init__(self, text: np.ndarray):
        self.text = text
        self.near = np.zeros(len(text), np.int64)
        self.best_n = np.zeros(len(text), np.int64)
        self.best = np.zeros(len(text), "S1").astype(object)

    def add(self, at: np.ndarray, n: np.ndarray, other: np.ndarray) -> None:
        np.add.at(self.near, at, 1)
        most = self.best_n.copy()
        np.maximum.at(most, at, n)
        top = np.flatnonzero(n == most[at])  # candidates for a word's best near word
        for k in top.tolist():
            w, i = other[k].tobytes(), at[k]
            if n[k] > self.best_n[i] or w < self.best[i]:
                self.best_n[i], self.best[i] = n[k], w

    def rows(self):
        hit = np.flatnonzero(self.near)
        return [self.text[i].tobytes().decode("latin-1") for i in hit], self.near[hit], self.best_n[hit], \
            [self.best[i].decode("latin-1") for i in hit]


RESULT = "word string, near bigint, best_n bigint, best string"


def _meet(table_: pa.Table) -> pa.Table:
    """Credits of one group: the words of a node (side 0) against the words of all
    nodes that it is paired with (side 1)."""
    side = table_["side"].to_numpy()
    words = [w.encode("latin-1") for w in table_["word"].to_pylist()]
    n = table_["n"].to_numpy()
    own = table_["own"].to_numpy(zero_copy_only=False)
    flat = table_["counts"].combine_chunks().flatten().to_numpy()
    counts = flat.reshape(len(words), -1) if words else np.zeros((0, 1), np.int32)
    parts = []
    for s in (0, 1):
        at = np.flatnonzero(side == s)
        parts.append(_side([words[i] for i in at], n[at], counts[at], own[at]))
    first, second = parts
    credit = _Credit(first[0]), _Credit(second[0])
    for i, j in near_words(first, second, int(table_["longer"][0].as_py())):
        credit[0].add(i, second[1][j], second[0][j])
        credit[1].add(j, first[1][i], first[0][i])
    cols = [list(x[0]) + list(x[1]) for x in zip(credit[0].rows(), credit[1].rows())]
    return pa.table({"word": pa.array(cols[0], pa.string()), "near": pa.array(cols[1], pa.int64()),
                     "best_n": pa.array(cols[2], pa.int64()), "best": pa.array(cols[3], pa.string())})


def near_counts(words: DataFrame, leaves: int = 1 << 13) -> DataFrame:
    """Per word with near words: ``word``, ``near`` (their number), ``best_n`` and
    ``best`` (most frequent, then smallest).  ``words``: distinct (word, n) of
    letters; ``leaves``: words below a pair of nodes that one task walks."""
    words = written(with_vectors(words), "spelling-vectors")
    pairs = written(node_pairs(words, leaves), "spelling-node-pairs")
    depths = [r[0] for r in pairs.select("depth").distinct().collect()]  # at most GROUPS + 1
    if not depths:
        return words.sparkSession.createDataFrame([], RESULT)
    nodes = F.explode(F.array(*[F.struct(F.lit(d).alias("depth"), node_of(d).alias("node")) for d in sorted(depths)]))
    keyed = words.select("word", "n", "counts", nodes.alias("k")).select("word", "n", "counts", "k.depth", "k.node")
    first = keyed.withColumnRenamed("node", "a").join(pairs.select("depth", "a", "longer").distinct(), ["depth", "a"]) \
        .select("depth", "a", "longer", F.lit(0).alias("side"), F.lit(False).alias("own"), "word", "n", "counts")
    second = keyed.withColumnRenamed("node", "b").join(pairs, ["depth", "b"]) \
        .select("depth", "a", "longer", F.lit(1).alias("side"), (F.col("a") == F.col("b")).alias("own"),
                "word", "n", "counts")
    met = first.union(second).groupBy("depth", "a", "longer").applyInArrow(_meet, RESULT)
    best = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("w")))
    return met.groupBy("word").agg(F.sum("near").alias("near"), best.alias("b")) \
        .select("word", "near", (-F.col("b.n")).alias("best_n"), F.col("b.w").alias("best"))


# ------------------------------------------------------------------ forms
def follow(forms: DataFrame) -> DataFrame:
    """(``word``, ``root``) of (``word``, ``form``), forms followed to the last one.
    Every round doubles the steps taken; a form is at least twice as frequent as
    its word, so chains have at most log2(max n) steps."""
    at = written(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        nxt = written(at.alias("x").join(at.select(F.col("word").alias("at"), F.col("root").alias("on")),
                                         F.col("x.root") == F.col("at"), "left")
                      .select("x.word", F.coalesce("on", "x.root").alias("root"), F.col("on").isNotNull().alias("moved")),
                      "spelling-roots")
        if not nxt.where("moved").take(1):
            return nxt.select("word", "root")
        at = nxt.select("word", "root")


def spelling_groups(words: DataFrame, leaves: int = 1 << 13) -> DataFrame:
    """``words`` (word, n) plus ``form``, ``root``, ``n_near`` and ``form_n``."""
    words = written(words.select("word", "n"), "spelling-words")
    near = near_counts(words, leaves)
    known = words.join(near, "word", "left")
    with_form = known.withColumn("is_form", F.coalesce(F.col("best_n") >= 2 * F.col("n"), F.lit(False)))
    out = written(with_form.select(
        "word", "n", F.when(F.col("is_form"), F.col("best")).alias("form"), F.coalesce("near", F.lit(0)).alias("n_near"),
        F.when(F.col("is_form"), F.col("best_n")).alias("form_n")), "spelling-forms")
    roots = follow(out.where("form is not null").select("word", "form"))
    return out.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near",
                                                  "form_n")


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spelling variants among the words of all ``documents``."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return spelling_groups(count_words(docs))


OP13_SQL = r"""
WITH RECURSIVE runs AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS k
  FROM (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]{5,}')) AS run FROM documents)
  GROUP BY ALL
), coded AS (
  SELECT run, k, xor(4294967295, list_reduce(
           list_prepend(CAST(4294967295 AS BIGINT), flatten([
             CASE WHEN unicode(c) < 128 THEN [CAST(unicode(c) AS BIGINT)]
                  ELSE [CAST(192 + (unicode(c) >> 6) AS BIGINT), CAST(128 + (unicode(c) & 63) AS BIGINT)] END
             FOR c IN string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run, '')])),
           lambda crc, b: list_reduce([xor(crc, b), 0, 0, 0, 0, 0, 0, 0, 0],
                                      lambda x, i: xor(x >> 1, 3988292384 * (x & 1))))) AS h
  FROM runs
), words AS (
  SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word,
         CAST(sum(k) AS BIGINT) AS n
  FROM coded GROUP BY 1 HAVING sum(k) >= 3 AND length(word) >= 5
), cut AS (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
), pairs AS (
  SELECT DISTINCT a.word, b.word AS near, b.n FROM cut a JOIN cut b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT DISTINCT a.word, b.word, b.n FROM cut a JOIN words b ON a.rest = b.word
  UNION SELECT DISTINCT b.word, a.word, a.n FROM cut a JOIN words b ON a.rest = b.word
), best AS (
  SELECT word, count(*) AS n_near, min(row(-n, near)) AS b FROM pairs GROUP BY word
), formed AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN -b[1] >= 2 * w.n THEN b[2] END AS form,
         CASE WHEN -b[1] >= 2 * w.n THEN -b[1] END AS form_n
  FROM words w LEFT JOIN best USING (word)
), chain AS (
  SELECT word, word AS last_word, 0 AS step FROM formed
  UNION ALL
  SELECT c.word, f.form, c.step + 1 FROM chain c JOIN formed f ON f.word = c.last_word WHERE f.form IS NOT NULL
)
SELECT f.word, f.form, r.root, f.n, f.n_near, CAST(f.form_n AS BIGINT) AS form_n
FROM formed f JOIN (SELECT word, arg_max(last_word, step) AS root FROM chain GROUP BY word) r ON r.word = f.word
"""
