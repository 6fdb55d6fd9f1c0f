"""Spelling variants: brute force over all pairs of words, the walk, edges."""

import random
import zlib

import numpy as np
import pytest

from stratum.llm import spelling_groups as sg


def near(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(words):
    out, form = {}, {}
    for w, n in words.items():
        others = sorted((-m, v) for v, m in words.items() if v != w and near(w, v))
        best = others[0] if others and -others[0][0] >= 2 * n else None
        form[w] = best[1] if best else None
        out[w] = [form[w], None, n, len(others), -best[0] if best else None]
    for w in words:
        at = w
        while form[at]:
            at = form[at]
        out[w][1] = at
    return {w: tuple(v) for w, v in out.items()}


def made_up(rng, n):
    """Words of few letters, so that many are near each other, with long chains of forms."""
    out = {}
    while len(out) < n:
        w = "".join(rng.choice("abcéÀq") for _ in range(rng.randint(1, 8)))
        out[w] = 3 * 2 ** rng.randint(0, 9) + rng.randint(0, 2)
    return out


@pytest.mark.parametrize("leaves", [3, 40, 1 << 13])
def test_groups_equal_brute_force(spark, leaves):
    words = made_up(random.Random(11), 400)
    words["x" * 3000], words["x" * 2999 + "y"], words["x" * 3001] = 3, 9, 50   # very long words
    df = spark.createDataFrame(list(words.items()), "word string, n bigint")
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in sg.spelling_groups(df, leaves).collect()}
    assert got == brute(words)


def test_node_pairs_keep_every_near_pair(spark):
    words = made_up(random.Random(2), 250)
    vectors = sg.with_vectors(spark.createDataFrame(list(words.items()), "word string, n bigint")).cache()
    pairs = sg.node_pairs(vectors, 6).collect()
    keys = {d: dict(vectors.select("word", sg.node_of(d)).collect()) for d in {p.depth for p in pairs}}
    met = set()
    for p in pairs:
        for a in (w for w, k in keys[p.depth].items() if k == p.a):
            met.update((a, b) for b, k in keys[p.depth].items() if k == p.b)
    for a in words:
        for b in words:
            if a < b and near(a, b):
                assert (a, b) in met or (b, a) in met
    assert len({p.depth for p in pairs}) > 2 and len(met) < len(words) ** 2 / 4   # the walk prunes


def test_walk_in_small_blocks(monkeypatch):
    monkeypatch.setattr(sg, "CHUNK", 7)
    rng = np.random.default_rng(4)
    va, vb = (np.unique(rng.integers(0, 3, (60, 5)), axis=0) for _ in range(2))
    got = set()
    for x, y in sg.walk(sg.Trie(va), sg.Trie(vb), 1, 1):
        assert len(x) <= 16
        got.update(zip(x.tolist(), y.tolist()))
    for i, a in enumerate(va):
        for j, b in enumerate(vb):
            more = b - a
            if more[more > 0].sum() <= 1 and -more[more < 0].sum() <= 1:
                assert (i, j) in got


def test_counting_and_edges(spark):
    docs = [(i, "Hello, hello HELLO\nÉtés été") for i in range(40)] + \
           [(None, "hello " * 5), (50, None), (51, ""), (51, "abcd " * 9), (52, "naïve×façade " * 4), (52, "naïve×façade " * 4)]
    df = spark.createDataFrame([(i, t, 1, "clash") for i, t in docs], "doc_id bigint, text string, n int, word string")
    want = {}
    for i, t in docs:
        run = ""
        for c in (t or "") + " ":
            if "a" <= c.lower() <= "z" and c.isascii() or 0xC0 <= ord(c) <= 0xFF:
                run += c.lower() if c.isascii() else c
                continue
            if run:
                h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
                w = run[:h % len(run)] + run[h % len(run) + 1:] if h % 97 == 0 else run
                want[w] = want.get(w, 0) + 1
            run = ""
    want = {w: n for w, n in want.items() if len(w) >= 5 and n >= 3}
    assert "naïve×façade" in want and "hello" in want
    counted = sg.count_words(df)
    assert dict((r.word, r.n) for r in counted.collect()) == want
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in sg.spelling_groups(counted).collect()}
    assert got == brute(want)
    empty = sg.spelling_groups(sg.count_words(df.limit(0)))
    assert empty.columns == ["word", "form", "root", "n", "n_near", "form_n"] and empty.count() == 0


def test_deleted_letter(spark):
    docs = spark.createDataFrame([(i, "spelling") for i in range(2000)], "doc_id bigint, text string")
    hit = [h for i in range(2000) if (h := zlib.crc32(f"{i}:spelling".encode())) % 97 == 0]
    want = {}
    for h in hit:
        w = "spelling"[:h % 8] + "spelling"[h % 8 + 1:]
        want[w] = want.get(w, 0) + 1
    want = {w: n for w, n in want.items() if n >= 3} | {"spelling": 2000 - len(hit)}
    assert len(hit) > 10 and dict((r.word, r.n) for r in sg.count_words(docs).collect()) == want
