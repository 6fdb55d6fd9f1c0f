"""Quality rules: base columns and posteriors against a plain version, the
model's estimates against known accuracies, labels, edges, a native plan."""

import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from stratum.llm import quality_votes as qv

SF = "/root/testdata/sf0.001"
SPACE = re.compile(r"[\x20\x09-\x0D]+")


def plain(text):
    """A text's statistics."""
    text = text or ""
    words = [w for w in SPACE.split(text) if w]
    lines = [x for x in text.split("\n") if SPACE.sub("", x)]
    at = {}
    for i in range(len(words) - 2):
        at.setdefault(tuple(words[i:i + 3]), []).append(i)
    again = {j for places in at.values() if len(places) > 1 for i in places for j in (i, i + 1, i + 2)}
    mark = re.compile(r"[^\W_]", re.UNICODE)
    return {"n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(c in "#*$%&|<>" for c in text),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(again), "n_lines": len(lines),
            "n_distinct": len(set(words)), "n_capitals": len(re.findall("[A-ZÀ-Þ]{2,}", text)), "n_calls": text.count("!"),
            "n_ends": len(re.findall(r"[.?](?=[\x20\x09-\x0D]|\Z)", text)),
            "n_lone": sum(not mark.search(w) for w in words[1:-1])}


def votes(s):
    n, lines = s["n_words"], s["n_lines"]

    def low(v, good, bad):
        return 1 if v <= good else -1 if v >= bad else 0

    def high(v, bad, good):
        return 1 if v >= good else -1 if v <= bad else 0

    def per(c):
        return s[c] / max(n, 1)
    return {"symbols": low(per("n_symbols"), .02, .1), "lone": low(per("n_lone"), .03, .15),
            "repeats": low(per("n_repeat_words"), .2, .5),
            "variety": 0 if n < 20 or n > 1000 else high(per("n_distinct"), .25, .4),
            "dup_lines": 0 if lines < 4 else low(s["n_dup_lines"] / lines, .1, .3),
            "capitals": low(per("n_capitals"), .05, .25), "calls": low(per("n_calls"), .05, .2),
            "ends": 0 if n < 20 else high(per("n_ends"), .005, .03)}


def rates(v, rounds=200):
    """Expectation-maximisation over a matrix of votes, a row per document."""
    v = np.array(v)
    k = v.shape[1]
    prior, good, bad = .8, np.full(k, qv.START[0]), np.full(k, qv.START[1])
    for _ in range(rounds):
        odds = math.log(prior / (1 - prior)) + (v > 0) @ np.log(good / (1 - bad)) + (v < 0) @ np.log((1 - good) / bad)
        p = 1 / (1 + np.exp(-odds))
        clip = lambda x: np.clip(x, qv.LEAST, qv.MOST)
        old = np.concatenate([[prior], good, bad])
        prior = float(clip((p.sum() + .8) / (len(v) + 1)))
        good = clip((p @ (v > 0) + qv.START[0]) / (p @ (v != 0) + 1))
        bad = clip(((1 - p) @ (v < 0) + qv.START[1]) / ((1 - p) @ (v != 0) + 1))
        if np.abs(old - np.concatenate([[prior], good, bad])).max() < 1e-9:
            break
    return prior, good, bad, p


@pytest.fixture(scope="module")
def judged(spark):
    return {r.doc_id: r for r in queries()["op12_quality_rules"](spark, SF).collect()}


@pytest.fixture(scope="module")
def documents(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def test_statistics_and_votes_equal_a_plain_version(spark, documents):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    got = qv.statistics(docs, F.col("text")).withColumn("votes", F.struct(*[v.alias(n) for n, v in qv.rules().items()]))
    for r in got.select("doc_id", "stat", "votes").collect():
        want = plain(documents[r.doc_id])
        stat = r.stat.asDict()
        assert {c: stat[c] for c in want} == want
        assert stat["n_doubled"] == len(re.findall(r"([^\w\s]|_)\1", documents[r.doc_id]))
        own = votes(stat)
        assert {c: r.votes[c] for c in own} == own


def test_query_equals_plain_version(spark, judged, documents):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    names = list(qv.rules())
    rows = qv.statistics(docs, F.col("text")).select("doc_id", *[v.alias(n) for n, v in qv.rules().items()]).collect()
    *_, p = rates([[r[n] for n in names] for r in rows])
    assert len(judged) == len(documents)
    for r, good in zip(rows, p):
        j, want = judged[r.doc_id], plain(documents[r.doc_id])
        assert {c: j[c] for c in qv.BASE} == {c: want[c] for c in qv.BASE}
        assert j.base_failed == (want["n_words"] < 50 or 100 * want["n_repeat_words"] > 50 * want["n_words"])
        assert j.posterior == pytest.approx(good, abs=1e-6)
        assert j.kept == (not j.base_failed and j.posterior >= .5)


def test_estimates_known_accuracies():
    rng = random.Random(1)
    good, bad = (.97, .99, .95, .98, .99), (.6, .4, .5, .7, .3)
    counts = {}
    for _ in range(40_000):
        y = rng.random() < .8
        v = tuple(0 if rng.random() < .2 else (1 if rng.random() < g else -1) if y else (-1 if rng.random() < b else 1)
                  for g, b in zip(good, bad))
        counts[v] = counts.get(v, 0) + 1
    m = qv.estimate(list(counts.items()), 5)
    assert m.prior == pytest.approx(.8, abs=.03)
    assert m.good == pytest.approx(good, abs=.03) and m.bad == pytest.approx(bad, abs=.06)
    assert qv.estimate(list(counts.items())[::-1], 5) == m      # the order of the counts is of no matter


def test_labels_are_met(spark):
    """No label is an input: of the documents that pass the base rules the good
    ones stay and the bad ones go."""
    sf = "/root/testdata/sf0.01"
    got = queries()["op12_quality_rules"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    share = {r.quality: (r.kept, r.n) for r in got.where("not base_failed").groupBy("quality")
             .agg(F.avg(F.col("kept").cast("int")).alias("kept"), F.count("*").alias("n")).collect()}
    assert share[1][1] > 250 and share[1][0] >= .99
    assert share[0][1] > 15 and share[0][0] <= .05


def test_edges(spark):
    fine = "\n".join(f"Line {i} gives item{i} with cost{i * 7} for user{i * 13} today{i}." for i in range(12))
    long = " ".join(f"word{i % 977}" for i in range(200_000))
    rows = [(1, None), (2, ""), (3, " \n\t\n"), (4, fine), (4, fine), (None, fine), (5, long), (6, "one two"),
            (7, "a b c a b c"), (8, "same line\nsame line\n\nsame line"), (9, "x" * 100_000)]
    df = spark.createDataFrame([(i, t, "mine", 5) for i, t in rows], "doc_id bigint, text string, kept string, n_words int")
    out = qv.judge(df)
    assert out.columns == ["doc_id", "kept", "n_words", "n_words_", *qv.BASE[1:], "base_failed", "kept_", "posterior"]
    got = {}
    for r in out.collect():
        assert r.kept == "mine" and r.n_words == 5
        got.setdefault(r.doc_id, []).append(r)
    assert len(got[4]) == 2 and len(got) == 10
    for i, t in rows:
        want = plain(t)
        for r in got[i]:
            assert (r.n_words_, *[r[c] for c in qv.BASE[1:]]) == tuple(want[c] for c in qv.BASE)
    assert got[1][0].base_failed and not got[1][0].kept_ and got[7][0].n_repeat_words == 6
    assert got[8][0].n_dup_lines == 2 and got[5][0].n_repeat_words == 200_000 and got[5][0].base_failed
    assert not got[4][0].base_failed
    kept = qv.kept_documents(df)
    assert kept.columns == df.columns and sorted(kept.collect(), key=str) == sorted(
        [r for r in df.collect() if got[r.doc_id][0].kept_], key=str)
    empty = qv.judge(df.limit(0))
    assert empty.count() == 0 and empty.columns == out.columns
    assert qv.judge(spark.createDataFrame([(None,)], "text string")).columns[0] == "n_words"


def test_native(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    plans = [qv.statistics(docs, F.col("text")), qv.judge(docs), qv.kept_documents(docs)]
    for df in plans:
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow", plan)
