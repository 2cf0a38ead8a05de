"""Repair of a conversation's structure by iterative-deepening A*.

A repaired conversation has the role initials ``(s?(ua)+)?``.  Its edits, in
the order of the rows, are D (delete, cost 2), I (insert an empty user or
assistant turn, 5), K (keep, 0) and R (change the role to user or assistant,
1).  Blank and repeated rows must be deleted; a truncated row that stays
costs 5 more.

A depth-first search tries the edits in ASCII order under a cost bound, that
starts at a lower bound of the cost and grows by one.  A table holds, for
each (rows used, pattern state), the largest budget that is known to fail,
and goes on from bound to bound.  The first path that is accepted is the
cheapest and, of these, the ASCII-least.

The search of a conversation is cut into chunks of ``CHUNK`` rows.  A
conversation of one chunk is searched at once.  A longer one, of any length,
is searched per chunk for each pair of pattern states at its two ends; of a
chunk only these costs, and the order of its paths, meet those of the others.
A chunk's path ends with the edit of its last row (inserts belong to the row
after them), so no path is the beginning of another, and the ASCII-least path
is found chunk by chunk.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from souk.llm.order import numbered, stored

#: Rows that are searched at a time.
CHUNK = 256
DELETE, INSERT, REROLE, TRUNCATED = 2, 5, 1, 5
EDITS = "DIKR"

# --- search ----------------------------------------------------------------------
# A row's code: s, u, a or x (another role), in upper case if truncated, or d: must be deleted.
# Pattern states: 0 nothing yet, 1 after s, 2 after u, 3 after a.

NEXT = "uuau"  # the role that insert and rerole give, by state
AFTER = {"s": 1, "u": 2, "a": 3}
WHOLE = (0, 3)


def _fits(state: int, role: str) -> bool:
    return role == NEXT[state] or (role == "s" and state == 0)


class _Bound:
    """Lower bounds of the cost of rows i.. from a state.

    Rows that must go or are truncated cost 2 or more each.  Of the others,
    two neighbours that can't follow each other need one edit at least; as
    many such pairs as share no row are counted.  The state and, for a whole
    conversation, the end count as neighbours too.
    """

    def __init__(self, codes: str, ends: tuple[int, ...]) -> None:
        n = self.n = len(codes)
        self.codes, self.ends = codes, ends
        self.bare = max(ends) < 2  # nothing but one s can stay
        self.forced, self.near = [0] * (n + 1), [n] * (n + 1)
        self.pairs, self.rest = [0] * (n + 1), [0] * (n + 1)  # pairs from a row on, and from the row after it
        for i in range(n - 1, -1, -1):
            c = codes[i]
            clean = c in "suax"
            self.forced[i] = self.forced[i + 1] + (0 if clean else DELETE)
            self.near[i] = i if clean else self.near[i + 1]
            if clean:
                j = self.near[i + 1]
                state = AFTER.get(c)
                wrong = state is None or self._wrong(state, j)
                self.rest[i] = self.pairs[j]
                self.pairs[i] = max(self.pairs[j], wrong + self.rest[j])
            else:
                self.pairs[i], self.rest[i] = self.pairs[i + 1], self.rest[i + 1]

    def _wrong(self, state: int, j: int) -> bool:
        if j == self.n:
            return self.ends == WHOLE and state not in WHOLE
        return not _fits(state, self.codes[j])

    def __call__(self, i: int, state: int) -> int:
        if self.bare:
            return DELETE * max(0, self.n - i - (state == 0 and self.ends == (1,)))
        j = self.near[i]
        return self.forced[i] + max(self.pairs[j], self._wrong(state, j) + self.rest[j])


def search(codes: str, start: int = 0, ends: tuple[int, ...] = WHOLE) -> tuple[int, str] | None:
    """Cost and edits of the cheapest, then ASCII-least, path over all rows; None if there is none.

    ends: states to end in; ``WHOLE`` (a conversation's or its last chunk's
    end) allows inserts after the last row, others don't.
    """
    n, bound_of = len(codes), _Bound(codes, ends)
    least = min(ends)
    if max(ends) < 2 and (start > least or (start < least and not set(codes) & set("sS"))):
        return None
    failed: dict[tuple[int, int], int] = {}

    def step(i: int, state: int, k: int) -> tuple[int, int, int] | None:
        """Cost, row and state after edit k."""
        if k == 1:
            return (INSERT, i, AFTER[NEXT[state]]) if i < n or ends == WHOLE else None
        if i == n:
            return None
        c = codes[i]
        if k == 0:
            return DELETE, i + 1, state
        if c == "d":
            return None
        extra = TRUNCATED if c.isupper() else 0
        if k == 2:
            role = c.lower()
            return (extra, i + 1, AFTER[role]) if _fits(state, role) else None
        return extra + REROLE, i + 1, AFTER[NEXT[state]]

    for bound in range(bound_of(0, start), DELETE * n + 2 * INSERT + TRUNCATED + 1):
        path: list[str] = []
        stack = [(0, start, bound, 0)]
        while stack:
            i, state, left, k = stack.pop()
            if k == 0:
                if i == n and state in ends and (n == 0 or ends == WHOLE or path[-1] != "I"):
                    return bound, "".join(path)
                if bound_of(i, state) > left or failed.get((i, state), -1) >= left:
                    path[-1:] = []
                    continue
            for k in range(k, 4):
                to = step(i, state, k)
                if to and to[0] <= left:
                    stack.append((i, state, left, k + 1))
                    stack.append((to[1], to[2], left - to[0], 0))
                    path.append(EDITS[k])
                    break
            else:
                failed[i, state] = max(left, failed.get((i, state), -1))
                path[-1:] = []
    return None


def roles_of(edits: str, codes: str, start: int = 0) -> tuple[str, int]:
    """Role initial that each edit leaves (- for none), and the state at the end."""
    out, i, state = [], 0, start
    for e in edits:
        if e == "D":
            out.append("-")
        else:
            role = codes[i].lower() if e == "K" else NEXT[state]
            out.append(role)
            state = AFTER[role]
        i += e != "I"
    return "".join(out), state


def solve(codes: str, first: bool, last: bool) -> list[dict]:
    """The best path of a chunk from each state it may start in to each state it may end in (-1: the conversation's end)."""
    out = []
    for start in (0,) if first else range(4):
        paths = []
        for end in (-1,) if last else range(4):
            found = search(codes, start, WHOLE if last else (end,))
            if found:
                paths.append((found[1], end, found[0]))
        for order, (edits, end, cost) in enumerate(sorted(paths)):
            out.append({"start": start, "end": end, "cost": cost, "order": order, "edits": edits, "roles": roles_of(edits, codes, start)[0]})
    return out


def solver():
    """``solve`` with the answers of a task kept; equal code strings are common."""
    known: dict[tuple, list[dict]] = {}

    def answer(codes: str, first: bool, last: bool) -> list[dict]:
        if len(known) >= 1 << 14:
            known.clear()
        key = (codes, first, last)
        if key not in known:
            known[key] = solve(*key)
        return known[key]

    return answer


SOLUTION = "array<struct<start int, end int, cost int, order int, edits string, roles string>>"


def _compose(rows: pd.DataFrame) -> pd.DataFrame:
    """Of each chunk the start and end state on the best path; rows hold the costs of one conversation's chunks."""
    rows = rows.sort_values("chunk", kind="stable")
    by = [(chunk, part[["start", "end", "cost", "order"]].to_numpy().tolist()) for chunk, part in rows.groupby("chunk", sort=True)]
    after: dict[int, int] = {-1: 0}
    best = []  # cost of all chunks from k on, by start state
    for _, paths in reversed(by):
        now: dict[int, int] = {}
        for start, end, cost, _ in paths:
            if end in after:
                now[start] = min(now.get(start, 1 << 60), cost + after[end])
        best.append(now)
        after = now
    best = [*best[::-1], {-1: 0}]
    state, out = 0, []
    for k, (chunk, paths) in enumerate(by):
        _, end = min((order, end) for start, end, cost, order in paths if start == state and end in best[k + 1] and cost + best[k + 1][end] == best[k][state])
        out.append((chunk, state, end))
        state = end
    conv = rows["conv_id"].iloc[0]
    return pd.DataFrame({"conv_id": [conv] * len(out), "chunk": [c for c, _, _ in out], "start": [s for _, s, _ in out], "end": [e for _, _, e in out]})


# --- tables ----------------------------------------------------------------------

_BLANK = r"[^\x20\x09-\x0D]"
_SPACES = " \t\n\x0b\f\r"


def inspect(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``turn``, ``role``, ``text``, ``at`` (place from 1), ``initial`` and ``fault`` of every row.

    Rows go by turn, null first, then role and text, so repeated rows are
    neighbours.  A null role or text reads as one space; rows with a null
    ``conv_id`` form one conversation.  A row's fault is the first that holds
    of blank (no character but ASCII white space), duplicate (role and text
    stand in an earlier row of the conversation) and truncated (the last such
    character is none of . ! ?), else null.  initial is the role's first
    character ('' for an empty role).  Other columns are ignored; an empty
    table gives an empty table.
    """
    space = F.lit(" ")
    rows = conversations.select("conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"))
    rows = numbered(rows, ["conv_id"], [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")])
    rows = rows.withColumns({"__h": F.xxhash64("role", "text"), "__g": F.xxhash64(F.lit(1), "text", "role")})
    seen = rows.groupBy(F.col("conv_id").alias("__c"), F.col("__h").alias("__h2"), F.col("__g").alias("__g2")).agg(F.min("at").alias("__first"))
    rows = rows.join(seen, F.col("conv_id").eqNullSafe(F.col("__c")) & (F.col("__h") == F.col("__h2")) & (F.col("__g") == F.col("__g2")))
    end = F.right(F.rtrim("text", F.lit(_SPACES)), F.lit(1))
    fault = (
        F.when(~F.col("text").rlike(_BLANK), "blank")
        .when(F.col("at") > F.col("__first"), "duplicate")
        .when(~end.isin(".", "!", "?"), "truncated")
    )
    return rows.select("conv_id", "turn", "role", "text", "at", F.substring("role", 1, 1).alias("initial"), fault.alias("fault"))


def report(inspected: DataFrame) -> DataFrame:
    """Per conversation: ``gaps``, ``blank``, ``duplicate``, ``truncated``, ``illegal`` of ``inspect``'s rows.

    gaps: turn numbers missing between the smallest and largest (0 if all are
    null); illegal: neighbours whose initials are not su, ua or au.
    """
    turns = inspected.groupBy("conv_id", "turn").agg(F.count("*").alias("rows"), *(F.count_if(F.col("fault") == f).alias(f) for f in ("blank", "duplicate", "truncated")))
    by = turns.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).alias("gaps"),
        *(F.sum(f).alias(f) for f in ("blank", "duplicate", "truncated")),
    )
    before = inspected.select(F.col("conv_id").alias("__c"), (F.col("at") + 1).alias("__at"), F.col("initial").alias("__i"))
    pairs = inspected.select("conv_id", "at", "initial").join(before, F.col("conv_id").eqNullSafe(F.col("__c")) & (F.col("at") == F.col("__at")))
    legal = ((F.col("__i") == "s") & (F.col("initial") == "u")) | ((F.col("__i") == "u") & (F.col("initial") == "a")) | ((F.col("__i") == "a") & (F.col("initial") == "u"))
    wrong = pairs.filter(~legal).groupBy(F.col("conv_id").alias("__c")).agg(F.count("*").alias("illegal"))
    return by.join(wrong, F.col("conv_id").eqNullSafe(F.col("__c")), "left").drop("__c").withColumn("illegal", F.coalesce("illegal", F.lit(0)))


def repair(inspected: DataFrame, chunk_rows: int = CHUNK) -> DataFrame:
    """The edits of every conversation of ``inspect``'s rows: ``conv_id``, ``chunk``, ``place``, ``edit``, ``cost``, ``role``, ``text``.

    (chunk, place) is the edits' order within a conversation; role and text
    are what the edit leaves, null if it deletes.  An empty table gives an
    empty table.
    """
    initial = F.when(F.col("initial").isin("s", "u", "a"), F.col("initial")).otherwise("x")
    code = F.when(F.col("fault").isin("blank", "duplicate"), "d").when(F.col("fault") == "truncated", F.upper(initial)).otherwise(initial)
    rows = inspected.select("conv_id", "at", F.floor((F.col("at") - 1) / chunk_rows).alias("chunk"), code.alias("code"))
    chunks = rows.groupBy("conv_id", "chunk").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "code"))), lambda r: r["code"]), "").alias("codes")
    )
    sizes = rows.groupBy(F.col("conv_id").alias("__c")).agg(F.max("chunk").alias("__last"))
    chunks = chunks.join(sizes, F.col("conv_id").eqNullSafe(F.col("__c")))
    best_paths = F.udf(solver(), SOLUTION, useArrow=True)
    solved = stored(
        chunks.select("conv_id", "chunk", (F.col("__last") == 0).alias("alone"), F.col("codes"), F.explode(best_paths("codes", F.col("chunk") == 0, F.col("chunk") == F.col("__last"))).alias("s"))
        .select("conv_id", "chunk", "alone", "codes", "s.*")
    )
    many = solved.filter("not alone")
    chosen = many.select("conv_id", "chunk", "start", "end", "cost", "order").groupBy("conv_id").applyInPandas(_compose, "conv_id long, chunk long, start int, end int")
    chosen = chosen.select(*(F.col(c).alias(f"__{c}") for c in chosen.columns))
    same = F.col("conv_id").eqNullSafe(F.col("__conv_id")) & (F.col("chunk") == F.col("__chunk")) & (F.col("start") == F.col("__start")) & (F.col("end") == F.col("__end"))
    best = solved.filter("alone").unionByName(many.join(chosen, same, "left_semi"))
    edits = best.select("conv_id", "chunk", "cost", "edits", "roles", F.posexplode(F.split("edits", "")).alias("place", "edit"))
    used = F.length(F.replace(F.substring("edits", F.lit(1), F.col("place") + 1), F.lit("I"), F.lit("")))
    role = F.substring("roles", F.col("place") + 1, F.lit(1))
    edits = edits.select(
        F.col("conv_id").alias("__c"), "chunk", "place", "edit", F.when(F.col("place") == 0, F.col("cost")).otherwise(0).cast("long").alias("cost"),
        F.when(F.col("edit") != "I", F.col("chunk") * chunk_rows + used).alias("__at"),
        F.when(F.col("edit").isin("I", "R"), F.when(role == "u", "user").otherwise("assistant")).alias("__role"),
    )
    out = edits.join(inspected.select("conv_id", "at", "role", "text"), F.col("__c").eqNullSafe(F.col("conv_id")) & (F.col("__at") == F.col("at")), "left")
    gone = F.col("edit") == "D"
    return out.select(
        F.col("__c").alias("conv_id"), "chunk", "place", "edit", "cost",
        F.when(~gone, F.coalesce("__role", "role")).alias("role"),
        F.when(F.col("edit") == "I", "").when(~gone, F.col("text")).alias("text"),
    )
