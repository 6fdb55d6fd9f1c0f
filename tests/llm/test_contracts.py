"""The registered queries against brute-force versions in plain Python, over the
whole small tables."""

import hashlib
import os
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
import xxhash

import corpus_pipeline
from stratum.llm.queries import ORACLE, QUERIES
from stratum.session import DEFAULTS

SF = os.environ.get("STRATUM_TEST_SF", "/root/testdata/sf0.001")
TABLES = ["documents", "embeddings", "benchmark", "labels", "conversations"]
SPACE = re.compile("[^\x20\x09-\x0d]+")

pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="test tables not present")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.fixture(scope="module")
def texts(duck):
    return dict(duck.execute("SELECT doc_id, text FROM documents").fetchall())


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def rows(spark, name):
    return QUERIES[name](spark, SF).collect()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF)
    cur = duck.execute(ORACLE[name])
    cols = sorted(c[0] for c in cur.description)
    assert sorted(df.columns) == cols
    at = {c[0]: i for i, c in enumerate(cur.description)}
    want = sorted((tuple(r[at[c]] for c in cols) for r in cur.fetchall()), key=repr)  # nulls have no order
    assert sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr) == want


def brute_base(text):
    found = []
    assign = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    for m in re.finditer(assign, text, re.I | re.A):
        if len(m[2]) >= 6:
            found.append((m.start(), 0, m.end(), "assign"))
    for m in re.finditer(r"AKIA[A-Z0-9]+", text):
        if m.end() - m.start() >= 20:
            found.append((m.start(), 1, m.end(), "access"))
    for m in re.finditer(r"[0-9a-f]+", text):
        if m.end() - m.start() >= 24:
            found.append((m.start(), 2, m.end(), "hex"))
    return sorted(found)


def test_secrets(spark, texts):
    got = rows(spark, "op2_secrets")
    assert len(got) == len(texts)
    for r in got:
        base = brute_base(texts[r.doc_id] or "")
        kinds = Counter(b[3] for b in base)
        assert (r.n_assign, r.n_access, r.n_hex) == (kinds["assign"], kinds["access"], kinds["hex"])
        assert r.base_sha256 == sha(",".join(f"{k}:{s}:{e}" for s, _, e, k in base))
        all_ = r.spans.split(",") if r.spans else []
        assert [x for x in all_ if not x.startswith("random")] == [f"{k}:{s}:{e}" for s, _, e, k in base]


def test_quality(spark, duck, texts):
    labels = dict(duck.execute("SELECT doc_id, quality FROM labels").fetchall())
    got = rows(spark, "op4_quality")
    assert len(got) == len(texts)
    right = 0
    held = [r for r in got if r.held_out and r.doc_id in labels]
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    right = sum(r.predicted == labels[r.doc_id] for r in held)
    assert right >= 0.85 * len(held)


def test_class_lm(spark, texts):
    got = rows(spark, "op5_class_lm")
    assert len(got) == len(texts)
    tokens = {d: [*SPACE.findall(lower(t or "")), ""] for d, t in texts.items()}
    counts = Counter(w for d, own in tokens.items() if zlib.crc32(str(d).encode()) % 10 for w in own)
    n, v = sum(counts.values()), len(counts)
    for r in got:
        own = tokens[r.doc_id]
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 10 == 0)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(own), sum(counts[w] > 0 for w in own), n)
        base = sum(np.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in own)
        assert r.base_score == pytest.approx(base, rel=1e-9)
        assert r.score < 0
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_mix(spark, duck, texts):
    got = rows(spark, "op6_mix")
    source = dict(duck.execute("SELECT doc_id, source FROM documents").fetchall())
    assert sorted(r.doc_id for r in got) == sorted(texts)
    size = {d: len(SPACE.findall(t or "")) for d, t in texts.items()}
    total = defaultdict(int)
    for d, n in size.items():
        total[source[d]] += n
    order = sorted(total, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    left, free, goal = 1.5 * sum(total.values()), list(order), {}
    while free:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 2 * total[s]]
        if not over:
            goal.update(share)
            break
        for s in over:
            goal[s] = 2.0 * total[s]
            left -= goal[s]
            free.remove(s)
    taken = defaultdict(int)
    for r in got:
        assert r["size"] == size[r.doc_id] and r.source_size == total[source[r.doc_id]]
        assert r.target == pytest.approx(goal[source[r.doc_id]], rel=1e-12)
        assert 0 <= r.taken <= 2 * r["size"]
        taken[source[r.doc_id]] += r.taken
    for s in order:
        assert abs(taken[s] - goal[s]) <= 64 + 0.01 * goal[s]
    again = {r.doc_id: r.taken for r in rows(spark, "op6_mix")}
    assert again == {r.doc_id: r.taken for r in got}


def brute_print(text):
    words = SPACE.findall(lower(text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    """{doc: component} by comparing all pairs."""
    ids = list(prints)
    up = {d: d for d in ids}

    def top(d):
        while up[d] != d:
            d = up[d]
        return d
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if (prints[a] ^ prints[b]).bit_count() <= 4:
                x, y = sorted((top(a), top(b)))
                up[y] = x
    return {d: top(d) for d in ids}


def test_simhash(spark, texts):
    got = {r.doc_id: r for r in rows(spark, "op7_simhash_dedup")}
    prints = {d: brute_print(t) for d, t in texts.items()}
    assert {d: r.fingerprint for d, r in got.items()} == {d: f"{p:016x}" for d, p in prints.items()}
    assert {d: r.component_id for d, r in got.items()} == brute_components(prints)


def test_licenses(spark, texts):
    named = {"Licensed under CC BY-NC 4.0.": "CC-BY-NC", "Released under the MIT License.": "MIT",
             "Licensed under the Apache License, Version 2.0.": "Apache-2.0", "All rights reserved.": "proprietary",
             "This work is licensed under the GNU General Public License, version 3.": "GPL"}
    for r in rows(spark, "op1_licenses"):
        lines = (texts[r.doc_id] or "").split("\n")
        want = [f"{i}:{named[line]}" for i, line in enumerate(lines) if line in named]
        assert (r.paragraphs.split(",") if r.paragraphs else []) == want


def test_pipeline_stages(spark, duck, texts, tmp_path):
    """Every stage's decision, held against the queries' results on its input."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        out = spark.read.parquet(str(tmp_path / name))
        if name != "mix":
            assert out.columns == columns
            kept[name] = {r.doc_id: r.text for r in out.collect()}
            docs = out
    scores = {r.doc_id: r.predicted for r in rows(spark, "op4_quality")}
    assert set(kept["quality"]) == {d for d, p in scores.items() if p}
    # lines: brute force over what the classifier kept
    held = defaultdict(set)
    for d, t in kept["quality"].items():
        for line in (t or "").split("\n"):
            held[lower(line.strip(" \t\n\x0b\x0c\r"))].add(d)
    want = {d: "\n".join(x for x in (t or "").split("\n")
                         if len(k := lower(x.strip(" \t\n\x0b\x0c\r"))) < 10 or min(held[k]) == d)
            for d, t in kept["quality"].items()}
    assert {d: t or "" for d, t in kept["line_dedup"].items()} == want
    comps = brute_components({d: brute_print(t) for d, t in kept["line_dedup"].items()})
    assert set(kept["simhash_dedup"]) == set(comps.values())
    bad = {d for d, t in kept["simhash_dedup"].items() if brute_hit(t, duck)}
    assert set(kept["decontaminate"]) == set(kept["simhash_dedup"]) - bad
    mixed = out.collect()
    words = {d: SPACE.findall(t or "") for d, t in kept["decontaminate"].items()}
    taken = Counter()
    for r in mixed:
        own = r.text.split()
        assert len(own) == r.words
        taken[r.doc_id] += r.words
    assert set(taken) <= set(words) and all(n <= 2 * len(words[d]) for d, n in taken.items())
    assert abs(sum(taken.values()) - 1.5 * sum(map(len, words.values()))) <= 0.02 * sum(taken.values()) + 64 * 20
    slots = Counter()
    for r in mixed:
        slots[r.shard, r.slot] += r.words
    assert max(slots.values()) <= 64


def brute_hit(text, duck):
    word = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
    windows = set()
    for _, t in duck.execute("SELECT item_id, text FROM benchmark").fetchall():
        w = word.findall(lower(t or ""))
        if w:
            windows |= {tuple(w[i:i + 10]) for i in range(max(1, len(w) - 9))}
    w = word.findall(lower(text or ""))
    return any(tuple(w[i:i + n]) in windows for n in {len(x) for x in windows} for i in range(len(w) - n + 1))


def test_python_columns_are_computed_once(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, column in (("mix", "_pieces("), ("mix", "block_of("), ("simhash_dedup", "_fingerprints(")):
        plan = dict(corpus_pipeline.STAGES)[name](spark, docs, SF)._jdf.queryExecution().executedPlan().toString()
        assert sum(column in line and "ArrowEvalPython" in line for line in plan.splitlines()) == 1, (name, column)


def test_a_stage_by_itself_sets_the_session_defaults(spark):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)
    spark.conf.unset(key)
    try:
        corpus_pipeline.decontaminate(spark, spark.read.parquet(f"{SF}/documents.parquet"), SF)
        assert spark.conf.get(key) == DEFAULTS[key]
    finally:
        if before is not None:
            spark.conf.set(key, before)
