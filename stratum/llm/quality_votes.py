"""Quality rules by weak supervision, with DataFrame functions only.

Every rule reads statistics of a whole text and votes *good* (1), *bad* (-1) or
abstains (0).  The rules' votes are the only evidence: expectation-maximisation
over all documents estimates how often documents are good and how often each
rule, where it votes, is right on good and on bad ones; a document's posterior
probability of being good, from its votes and those accuracies, replaces the
demand that it pass every rule.

*Spark*: one pass computes the statistics and writes them with the votes (no
texts).  Documents are then counted by their pattern of votes, at most
3 ** rules rows however many documents there are (59,049 for the ten rules
below); the driver iterates over these counts, and the posterior is a column
expression over the written votes.

Words are ``[^\\x20\\x09-\\x0D]+``, lines are split at ``\\n``.  ``n_repeat_words``
counts the words inside 3-word windows that a text holds twice or more: the
windows are sorted with their places, so equal ones are neighbours, and the
places that they cover are counted once.

Defined cases: a null text has no words, no lines with a word, and fails the base
rules; a null ``doc_id`` is scored like any other; repeated rows each count and
each get a row; an empty table gives an empty table (and the rules' prior
accuracies); result columns get trailing underscores where an input column has
the name.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.llm.common import free_name, table, written

WORD = r"[^\x20\x09-\x0D]"
SPACE = r"[\x20\x09-\x0D]+"
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50


# ------------------------------------------------------------- statistics
def _windows(words: Column, make) -> Column:
    """``make`` of every 3-word window of an array of words, in order."""
    firsts = F.slice(words, F.lit(1), F.greatest(F.size(words) - 2, F.lit(0)))
    return F.transform(firsts, lambda x, i: make(x, F.get(words, i + 1), F.get(words, i + 2), i))


def statistics(docs: DataFrame, text: Column) -> DataFrame:
    """``docs`` plus a struct column ``stat`` of the text's statistics."""
    d = docs.withColumn("t", F.coalesce(text.cast("string"), F.lit("")))
    d = d.withColumn("words", F.split("t", SPACE)) \
        .withColumn("words", F.filter("words", lambda w: w != "")) \
        .withColumn("lines", F.filter(F.split("t", "\n", -1), lambda x: F.rlike(x, F.lit(WORD))))
    # a text whose windows all hash apart repeats none; only the others' windows are sorted
    d = d.withColumn("hashes", _windows(F.col("words"), lambda x, y, z, i: F.xxhash64(x, y, z)))
    d = d.withColumn("sorted", F.when(
        F.size("hashes") > F.size(F.array_distinct("hashes")),
        F.sort_array(_windows(F.col("words"), lambda x, y, z, i: F.struct(F.concat_ws(" ", x, y, z).alias("w"), i.alias("at")))))
        .otherwise(F.expr("cast(array() as array<struct<w:string,at:int>>)")))
    s = F.col("sorted")
    d = d.withColumn("places", F.filter(F.transform(s, lambda x, k: F.when(
        (x["w"] == F.get(s, k - 1)["w"]) | (x["w"] == F.get(s, k + 1)["w"]), x["at"])), lambda at: at.isNotNull()))
    at = F.col("places")
    covered = F.size(F.array_distinct(F.concat(at, F.transform(at, lambda i: i + 1), F.transform(at, lambda i: i + 2))))

    def long(c: Column, name: str) -> Column:
        return c.cast("bigint").alias(name)
    def count(pattern: str, name: str) -> Column:
        return long(F.regexp_count("t", F.lit(pattern)), name)
    stat = F.struct(
        long(F.size("words"), "n_words"), long(F.char_length(F.array_join("words", "")), "word_chars"),
        count("[#*$%&|<>]", "n_symbols"), long(F.size("lines") - F.size(F.array_distinct("lines")), "n_dup_lines"),
        long(covered, "n_repeat_words"), long(F.size("lines"), "n_lines"),
        long(F.size(F.array_distinct("words")), "n_distinct"), count("[A-ZÀ-Þ]{2,}", "n_capitals"), count("!", "n_calls"),
        count(r"[.?](?=[\x20\x09-\x0D]|$)", "n_ends"), count(r"([^\p{L}\p{N}\s])\1", "n_doubled"),
        count(r"(?<=\s)[^\p{L}\p{N}\s]+(?=\s)", "n_lone"),
        count(r"[\p{L}\p{N}][^\p{L}\p{N}\s.,;:!?'’)\-]", "n_odd_ends"))
    return d.withColumn("stat", stat).drop("t", "words", "lines", "hashes", "sorted", "places")


# ------------------------------------------------------------------ rules
def _per_word(name: str) -> Column:
    return F.col(f"stat.{name}") / F.greatest(F.col("stat.n_words"), F.lit(1))


def _low(value: Column, good: float, bad: float) -> Column:
    """Good up to ``good``, bad from ``bad``, else no vote."""
    return F.when(value <= good, 1).when(value >= bad, -1).otherwise(0)


def _high(value: Column, bad: float, good: float) -> Column:
    return F.when(value >= good, 1).when(value <= bad, -1).otherwise(0)


def rules() -> dict[str, Column]:
    """The rules' votes over ``stat``; the bounds are parameters of this set.
    Several rules look at each kind of fault, as a fault that one rule alone
    sees cannot be told from that rule's error."""
    lines, words = F.col("stat.n_lines"), F.col("stat.n_words")
    return {
        "symbols": _low(_per_word("n_symbols"), 0.02, 0.1),           # marks and tables
        "doubled": _low(_per_word("n_doubled"), 0.02, 0.1),           # "!!", "###"
        "lone": _low(_per_word("n_lone"), 0.03, 0.15),                # words without a letter or digit
        "odd_ends": _low(_per_word("n_odd_ends"), 0.03, 0.15),        # words that end in other marks
        "repeats": _low(_per_word("n_repeat_words"), 0.2, 0.5),       # copied passages
        "variety": F.when((words < 20) | (words > 1000), 0).otherwise(_high(_per_word("n_distinct"), 0.25, 0.4)),
        "dup_lines": F.when(lines < 4, 0).otherwise(_low(F.col("stat.n_dup_lines") / lines, 0.1, 0.3)),
        "capitals": _low(_per_word("n_capitals"), 0.05, 0.25),
        "calls": _low(_per_word("n_calls"), 0.05, 0.2),
        "ends": F.when(words < 20, 0).otherwise(_high(_per_word("n_ends"), 0.005, 0.03)),
    }


# --------------------------------------------------------------- the model
@dataclass(frozen=True)
class Accuracies:
    """Share of good documents, and per rule how often its vote is right on good
    (``good``) and on bad documents (``bad``)."""
    prior: float
    good: tuple[float, ...]
    bad: tuple[float, ...]

    def log_odds(self, votes) -> float:
        out = math.log(self.prior / (1 - self.prior))
        for v, g, b in zip(votes, self.good, self.bad):
            if v:
                out += math.log(g / (1 - b)) if v > 0 else math.log((1 - g) / b)
        return out


START = 0.98, 0.3   # assumed accuracy on good and on bad documents before any is seen: a rule sees some kinds of fault only
LEAST, MOST = 1e-4, 1 - 1e-4


def estimate(patterns: list[tuple[tuple[int, ...], int]], n_rules: int, rounds: int = 200, weight: float = 1.0) -> Accuracies:
    """Expectation-maximisation over (votes, documents) counts.  ``weight``:
    documents that the assumed accuracies count for."""
    patterns = sorted(patterns)
    model = Accuracies(0.8, (START[0],) * n_rules, (START[1],) * n_rules)

    def share(hits: float, of: float, start: float) -> float:
        return min(MOST, max(LEAST, (hits + weight * start) / (of + weight)))

    for _ in range(rounds):
        held, n_good, n_all = [[0.0] * 4 for _ in range(n_rules)], 0.0, 0
        for votes, n in patterns:
            p = 1 / (1 + math.exp(-max(-700.0, min(700.0, model.log_odds(votes)))))
            n_good, n_all = n_good + n * p, n_all + n
            for h, v in zip(held, votes):
                if v:
                    h[0] += n * p                      # votes on good documents, and the right ones of them
                    h[1] += n * p if v > 0 else 0.0
                    h[2] += n * (1 - p)
                    h[3] += n * (1 - p) if v < 0 else 0.0
        nxt = Accuracies(share(n_good, n_all, 0.8), tuple(share(h[1], h[0], START[0]) for h in held),
                         tuple(share(h[3], h[2], START[1]) for h in held))
        moved = max(abs(a - b) for a, b in zip((nxt.prior, *nxt.good, *nxt.bad), (model.prior, *model.good, *model.bad)))
        model = nxt
        if moved < 1e-9:
            break
    return model


def fit(voted: DataFrame, names: list[str]) -> Accuracies:
    """Accuracies from all rows of ``voted`` (struct column ``votes``)."""
    counts = voted.groupBy(*[F.col("votes")[n].alias(n) for n in names]).agg(F.count("*").alias("documents"))
    return estimate([(tuple(r[:-1]), r[-1]) for r in counts.collect()], len(names))


def posterior(model: Accuracies, names: list[str]) -> Column:
    odds = F.lit(math.log(model.prior / (1 - model.prior)))
    for n, g, b in zip(names, model.good, model.bad):
        v = F.col("votes")[n]
        odds = odds + F.when(v > 0, math.log(g / (1 - b))).when(v < 0, math.log((1 - g) / b)).otherwise(0.0)
    return 1 / (1 + F.exp(-odds))


BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _voted(docs: DataFrame, names: list[str]) -> DataFrame:
    """Written rows: ``row`` (the columns named), ``stat`` and ``votes``."""
    row = F.struct(*[docs[c] for c in names]) if names else F.struct(F.lit(0).alias("none"))
    stat = statistics(docs.select(row.alias("row"), docs["text"].alias("own")), F.col("own")).drop("own")
    return written(stat.withColumn("votes", F.struct(*[v.alias(n) for n, v in rules().items()])), "quality-votes")


def _verdict(voted: DataFrame, least: float) -> tuple[Column, Column, Column]:
    """(base rules failed, kept, posterior) over written votes."""
    names = list(rules())
    n, p = F.col("stat.n_words"), posterior(fit(voted, names), names)
    failed = (n < MIN_WORDS) | (100 * F.col("stat.n_repeat_words") > MAX_REPEAT_PERCENT * n)
    return failed, ~failed & (p >= least), p


def judge(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """``docs`` (but ``text``) plus the base statistics, ``base_failed``, ``kept``
    and ``posterior`` (probability of being good)."""
    names = [c for c in docs.columns if c != "text"]
    voted = _voted(docs, names)
    failed, kept, p = _verdict(voted, least)
    out = {**{c: F.col("stat")[c] for c in BASE}, "base_failed": failed, "kept": kept, "posterior": p}
    return voted.select(*[F.col("row")[c].alias(c) for c in names], *[v.alias(free_name(names, c)) for c, v in out.items()])


def kept_documents(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that the rules keep, whole (written once with their votes)."""
    voted = _voted(docs, docs.columns)
    _, kept, _ = _verdict(voted, least)
    return voted.where(kept).select(*[F.col("row")[c].alias(c) for c in docs.columns])


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality rules over every whole text of ``documents``."""
    return judge(table(spark, sf_dir, "documents").select("doc_id", "text"))
