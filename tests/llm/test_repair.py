"""Conversation repair: brute force over all edits, order of audits, edges."""

import hashlib
import itertools
import random

import pytest

from stratum.llm import conversation_repair as cr

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
SPACE = " \t\n\x0b\x0c\r"


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        bare = text.strip(SPACE)
        out.append("blank" if not bare else "duplicate" if (role, text) in seen
                   else "truncated" if bare[-1] not in ".!?" else None)
        seen.add((role, text))
    return out


def brute(rows):
    """Cheapest, then ASCII-least, of all edit strings (at most two inserts in a place)."""
    found = faults(rows)
    best = None
    gaps = ["", "I", "II"]
    for edits in itertools.product("KRD", repeat=len(rows)):
        if any(f in ("blank", "duplicate") and e != "D" for f, e in zip(found, edits)):
            continue
        base = sum(cr.COST[e] for e in edits) + sum(f == "truncated" and e != "D" for f, e in zip(found, edits))
        for ins in itertools.product(gaps, repeat=len(rows) + 1):
            cost = base + 2 * sum(map(len, ins))
            if best and cost > best[0]:
                continue
            audit = ins[0] + "".join(e + i for e, i in zip(edits, ins[1:]))
            made = replay(rows, audit)
            if made is not None and (best is None or (cost, audit) < best[:2]):
                best = (cost, audit, "\n".join(f"{r}:{t}" for r, t in made))
    return best


def replay(rows, audit):
    """The repaired turns of an audit, None where its roles are not as asked."""
    out, left = [], iter(rows)
    for e in audit:
        role, text = ("", "") if e == "I" else next(left)
        if e == "D":
            continue
        after = out[-1][0][0] if out else ""
        need = "a" if after == "u" else "u"
        if e == "K":
            if role[:1] != need and not (not out and role[:1] == "s"):
                return None
            out.append((role, text))
        else:
            out.append(({"u": "user", "a": "assistant"}[need], text))
    return out if not out or out[-1][0][0] == "a" else None


def repaired(rows):
    run = cr.Repair()
    for k, (role, text) in enumerate(rows):
        run.add(k, role, text)
    return run.result()


def test_equals_brute_force():
    rng = random.Random(3)
    texts = ["Fine.", "Cut off", "", " \n", "Why?", "Fine."]
    for _ in range(250):
        rows = [(rng.choice(["system", "user", "assistant", "assistant", "tool", ""]), rng.choice(texts))
                for _ in range(rng.randint(0, 4))]
        cost, audit, body = brute(rows)
        got = repaired(rows)
        assert (got["cost"], got["audit"]) == (cost, audit), rows
        assert got["repaired_sha256"] == hashlib.sha256(body.encode()).hexdigest()


@pytest.mark.parametrize("prime", [(1 << 61) - 1, 7])  # a small modulus: nearly all hashes collide
def test_order_of_audits(monkeypatch, prime):
    monkeypatch.setattr(cr, "PRIME", prime)
    rng = random.Random(5)
    nodes = [cr.Node("", None)]
    for _ in range(400):
        nodes.append(cr.Node(rng.choice("DIK"), rng.choice(nodes[-40:])))
    for _ in range(3000):
        a, b = rng.choice(nodes), rng.choice(nodes)
        assert cr.smaller(a, b) == (cr.audit_text(a) < cr.audit_text(b))


def test_long_conversation_keeps_its_order(spark):
    n = 20_000
    rows = [(5, i, "user" if i % 2 == 0 else "assistant", f"Said {i}.") for i in range(n)]
    got = cr.repair_conversations(spark.createDataFrame(rows, SCHEMA)).first()
    body = "\n".join(f"{r}:{t}" for _, _, r, t in rows)
    assert got.audit == "K" * n and got.cost == 0 and got.gaps == 0
    assert got.repaired_sha256 == hashlib.sha256(body.encode()).hexdigest()


def test_edges(spark):
    rows = [(1, None, "user", "No turn."), (1, 3, "assistant", "Yes."), (1, 3, "assistant", "Yes."), (1, 7, None, None),
            (None, 0, "user", "Null id?"), (None, 1, "assistant", "Its own."), (2, 0, "user", "Gone."),
            (3, 0, "system", "x" * 200_000 + "."), (3, 1, "user", "Short"), (4, 0, "User", "Case."), (4, 5, "user", "\n")]
    df = spark.createDataFrame([(*r, r[0] != 2, "clash") for r in rows], SCHEMA + ", here boolean, audit string")
    got = {r.conv_id: r.asDict() for r in cr.repair_conversations(df, "here").collect()}
    assert set(got) == {1, 2, 3, 4, None}
    one = got[1]
    assert (one["gaps"], one["blank"], one["duplicate"], one["truncated"], one["illegal"]) == (3, 1, 1, 0, 2)
    assert one["audit"] == "KKDD" and one["cost"] == 6
    assert got[None]["audit"] == "KK" and got[None]["gaps"] == 0
    none = got[2]
    assert none["audit"] == "" and none["repaired_sha256"] == hashlib.sha256(b"").hexdigest()
    assert all(none[c] == 0 for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost"))
    assert got[3]["audit"] == "KKI" and got[3]["cost"] == 3 and got[3]["truncated"] == 1
    assert got[4]["gaps"] == 4 and got[4]["audit"] == "DD"  # a reroled turn would need an insert as well
    assert cr.repair_conversations(df.limit(0), "here").count() == 0


def test_repaired_turns_give_the_digest(spark):
    rng = random.Random(9)
    rows = [(c if c % 7 else None, t, rng.choice(["system", "user", "assistant"]),
             rng.choice(["Good.", "So it is!", "cut", "", f"Own {t}."])) for c in range(40) for t in range(rng.randint(1, 7))]
    df = cr.damaged(spark.createDataFrame(rows, SCHEMA))
    audits = cr.repair_conversations(df, "present")
    bodies = {}
    for r in sorted(cr.repaired_turns(df, audits, "present").collect(), key=lambda r: (str(r.conv_id), r.position)):
        bodies.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    for r in audits.collect():
        body = "\n".join(bodies.get(r.conv_id, []))
        assert hashlib.sha256(body.encode()).hexdigest() == r.repaired_sha256
