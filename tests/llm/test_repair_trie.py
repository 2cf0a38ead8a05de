"""Conversation repair and the prefix trie against plain versions."""

from __future__ import annotations

import hashlib
import random
import re
from collections import defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from souk.llm import order, repair, trie

PATTERN = re.compile(r"(s?(ua)+)?")
TURNS = "conv_id long, turn long, role string, text string, at string, fault int"


def plain_repair(codes, start=0, ends=(0, 3)):
    """Cheapest, then least, edits by a dynamic programme over rows with at most two inserts at a time."""
    nxt, after = "uuau", {"s": 1, "u": 2, "a": 3}

    def with_inserts(states):
        out = dict(states)
        for state, (cost, edits) in states.items():
            for k in (1, 2):
                cost, edits, state = cost + 5, edits + "I", after[nxt[state]]
                out[state] = min(out.get(state, (1 << 30, "")), (cost, edits))
        return out

    now = {start: (0, "")}
    for c in codes:
        new = {}

        def add(state, value):
            new[state] = min(new.get(state, (1 << 30, "")), value)

        for state, (cost, edits) in with_inserts(now).items():
            add(state, (cost + 2, edits + "D"))
            if c != "d":
                more = 5 if c.isupper() else 0
                if c.lower() == nxt[state] or (c.lower() == "s" and state == 0):
                    add(after[c.lower()], (cost + more, edits + "K"))
                add(after[nxt[state]], (cost + more + 1, edits + "R"))
        now = new
    if ends == (0, 3):
        now = with_inserts(now)
    good = [now[s] for s in ends if s in now]
    return min(good) if good else None


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="suaxSUAXd", max_size=14), st.integers(0, 3), st.sampled_from([(0, 3), (0,), (1,), (2,), (3,)]))
def test_search_is_cheapest_and_least(codes, start, ends):
    if not codes and ends != (0, 3):
        return
    found = repair.search(codes, start, ends)
    assert found == plain_repair(codes, start, ends)
    if found:
        roles, end = repair.roles_of(found[1], codes, start)
        assert end in ends
        if start == 0 and ends == (0, 3):
            assert PATTERN.fullmatch(roles.replace("-", ""))


def test_search_of_long_rows():
    rng = random.Random(3)
    for n in (256, 300):
        codes = "".join(rng.choice("uauauauaUAdsx") for _ in range(n))
        assert repair.search(codes) == plain_repair(codes)
    assert repair.search("x" * 200) == plain_repair("x" * 200)


def odd_conversations(rng):
    rows = []
    for c in range(30):
        for k in range(rng.randint(0, 9)):
            role = rng.choice(["user", "assistant", "assistant", "user", "system", "tool", "", None])
            text = rng.choice(["hi.", "so?", "cut off", "", " \t\n", None, "end! \n", "é.", f"t{rng.randint(0, 5)}."])
            rows.append((c, k if rng.random() < 0.9 else rng.choice([None, k, k + 4]), role, text))
    rows += [(40, 0, "user", "a."), (40, 0, "user", "a."), (40, 0, "assistant", "b."), (None, 1, "user", "no id."), (None, None, "assistant", "x")]
    rows += [(50, k, "user" if k % 2 == 0 else "assistant", f"word {k} {'.' if k % 7 else ''}") for k in range(90) if k % 11]
    rows += [(51, 0, "assistant", "x " * 50000 + ".")]
    return rows


def plain_faults(turns):
    out, seen = [], set()
    for _, role, text in turns:
        body = text.strip(" \t\n\x0b\f\r")
        fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else None
        seen.add((role, text))
        out.append(fault)
    return out


def test_repair_equals_plain_version(spark):
    rows = odd_conversations(random.Random(11))
    table = spark.createDataFrame([(*r, "x", 1) for r in rows], TURNS).repartition(3)
    by = defaultdict(list)
    for c, turn, role, text in rows:
        by[c].append((turn is not None, turn or 0, " " if role is None else role, " " if text is None else text))
    inspected = order.stored(repair.inspect(table))
    told = {r.conv_id: r for r in repair.report(inspected).collect()}
    small, whole = (sorted(repair.repair(inspected, n).collect(), key=lambda r: (repr(r.conv_id), r.chunk, r.place)) for n in (7, repair.CHUNK))
    strip = lambda out: [(r.conv_id, r.edit, r.role, r.text) for r in out]
    assert strip(small) == strip(whole)
    assert sum(r.cost for r in small) == sum(r.cost for r in whole)
    got = defaultdict(list)
    for r in small:
        got[r.conv_id].append(r)
    assert set(got) == set(by) == set(told)
    for c, turns in by.items():
        turns = [(t[1] if t[0] else None, t[2], t[3]) for t in sorted(turns)]
        faults = plain_faults(turns)
        initials = [role[:1] for _, role, _ in turns]
        codes = "".join("d" if f in ("blank", "duplicate") else (i if i and i in "sua" else "x").upper() if f else (i if i and i in "sua" else "x") for f, i in zip(faults, initials))
        cost, edits = plain_repair(codes)
        assert ("".join(r.edit for r in got[c]), sum(r.cost for r in got[c])) == (edits, cost)
        at, state, lines = 0, 0, []
        for e in edits:
            role = None if e == "D" else {"I": ["user", "user", "assistant", "user"][state], "R": ["user", "user", "assistant", "user"][state]}.get(e) or turns[at][1]
            if role:
                lines.append((role, "" if e == "I" else turns[at][2]))
                state = {"s": 1, "u": 2, "a": 3}[role[0]]
            at += e != "I"
        assert [(r.role, r.text) for r in got[c] if r.role is not None] == lines
        numbers = [t for t, _, _ in turns if t is not None]
        r = told[c]
        assert (r.blank, r.duplicate, r.truncated) == tuple(faults.count(f) for f in ("blank", "duplicate", "truncated"))
        assert r.gaps == (max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0)
        assert r.illegal == sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    none = repair.inspect(table.limit(0))
    assert none.count() == repair.repair(none).count() == repair.report(none).count() == 0


def test_numbered_places(spark):
    rows = [(k % 3 if k % 5 else None, k * 7 % 50) for k in range(200)]
    got = order.numbered(spark.createDataFrame(rows, "g long, v long").repartition(5), ["g"], [F.col("v")]).collect()
    by = defaultdict(list)
    for r in sorted(got, key=lambda r: r.at):
        by[r.g].append((r.v, r.at))
    for g, out in by.items():
        assert [v for v, _ in out] == sorted(v for x, v in rows if x == g)
        assert [at for _, at in out] == list(range(1, len(out) + 1))


def plain_trie(convs):
    """(depth, smallest member, parent's, members, children, leaves, saved, ends) of every node."""
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    out = []
    for node, held in members.items():
        below = [n for n in members if n[: len(node)] == node]
        leaf = lambda n: not any(len(m) == len(n) + 1 and m[: len(n)] == n for m in members)
        saved = sum((len(members[n]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", n[-1][1])) for n in below if n)
        ends = sorted(c for c in held if len(convs[c]) == len(node))
        out.append((
            len(node), min(held), min(members[node[:-1]]) if node else None, len(held),
            sum(len(n) == len(node) + 1 for n in below), sum(map(leaf, below)), saved, tuple(ends),
        ))
    return sorted(out, key=repr)


def test_trie_equals_plain_version(spark):
    rng = random.Random(5)
    rows = [(c, k, rng.choice(["user", "assistant"]), rng.choice(["a b", "a  b", "c\nd e", ""])) for c in range(40) for k in range(rng.randint(0, 5))]
    rows += [(100 + c, k, "user", f"same {k}") for c in range(30) for k in range(3)]  # copies
    rows += [(200, k, "user", f"long {k % 9}") for k in range(150)] + [(201, k, "user", f"long {k % 9}") for k in range(140)]  # over block ends
    rows += [(202, k, "user", f"long {k % 9}") for k in range(64)] + [(203, None, None, None), (203, 5, "b", "c"), (204, 5, "bc", ""), (204, 6, "b", "c"), (204, 6, "b", "c"), (None, 0, "user", "lost")]
    table = spark.createDataFrame([(*r, "x", 1) for r in rows], TURNS).repartition(3)
    turns = order.stored(trie.ordered_turns(table))
    ids = spark.createDataFrame([(c,) for c in sorted({r[0] for r in rows if r[0] is not None} | set(range(40)))], "conv_id long")
    by = {r.conv_id: [] for r in ids.collect()}
    for c, turn, role, text in rows:
        if c is not None:
            by[c].append((turn is not None, turn or 0, role or "", text or ""))
    want = plain_trie({c: [t[2:] for t in sorted(v)] for c, v in by.items()})
    for size in (trie.SHARD, 8):
        nodes, ends = trie.trie(turns, ids, size)
        assert all(len(r.ends) <= size for r in ends.collect())
        held = defaultdict(list)
        for r in sorted(ends.collect(), key=lambda r: r.shard):
            held[r.node] += r.ends
        found = {r.node: r for r in nodes.collect()}
        got = sorted(((
            r.depth, r.conv_id, found[r.parent].conv_id if r.parent else None, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, tuple(held[r.node]),
        ) for r in found.values()), key=repr)
        assert got == want
    nodes, ends = trie.trie(turns.limit(0), ids.limit(0))
    assert nodes.count() == ends.count() == 0
    nodes, ends = trie.trie(turns.limit(0), ids)
    assert [(r.depth, r.n_convs, r.n_leaves) for r in nodes.collect()] == [(0, ids.count(), 1)]


def test_rebuilt_openings(spark):
    from souk.llm import registry

    rows = [(c, k, "user", f"{c}.{k}") for c in (0, 3, 7, 19, 20, 41, 42, 43, 44) for k in range(c % 5 + 1)]
    turns = trie.ordered_turns(spark.createDataFrame([(*r, "x", 1) for r in rows], TURNS))
    ids = turns.select("conv_id").distinct()
    by = defaultdict(list)
    for c, _, _, text in rows:
        by[c].append(text)
    import zlib

    got = defaultdict(list)
    for r in sorted(registry.rebuilt(turns, ids).collect(), key=lambda r: r.at):
        got[r.conv_id].append(r.text)
        assert r.at == len(got[r.conv_id])
    for c, own in by.items():
        h = zlib.crc32(str(c).encode()) % 4
        assert got[c] == by.get(c - c % 20, [])[:h] + own[h:]
    assert hashlib.sha256(b"").hexdigest() == spark.range(1).select(F.sha2(F.lit(""), 256).alias("x")).first().x
