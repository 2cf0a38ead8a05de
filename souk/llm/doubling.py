"""Byte-exact removal of repeats by distributed prefix doubling.

A byte goes if a string of ``length`` bytes (100) that covers it also starts
earlier: in a row with smaller doc_id, or earlier in the same one.

Prefix doubling ranks text positions by their first h bytes, sorts pairs of
ranks (at p and at p + h) to rank by 2h bytes, and goes on until a position
is unique or h is past the threshold.  The first rank here is that of h =
length / 2 bytes, and the pair (p, p + length - h) of it is past the
threshold, so there are two sorts of the shrinking set of positions:

1. h bytes.  Of every window of ``length`` bytes one position counts, the one
   whose h bytes have the least hash (its anchor); equal windows have equal
   anchors at equal places.  An anchor stands for the run of windows that it
   is least in.  Spark sorts the anchors by (rank of the h bytes, rank of the
   run's whole text).  Runs with equal text are equal throughout: all but the
   first are repeats.  An h-rank with one text is unique and leaves.
2. 2h bytes.  The windows of the texts that are left, one by one, sorted by
   the pair (rank at p, rank at p + length - h).  All but the first of a
   pair are repeats.

Ranks are 64-bit hashes, always compared in pairs; equal strings always have
equal ranks.  A task drops what is repeated within its own rows before the
shuffle, so a group of copies gives each later task one row per earlier task,
however large it is.  h-ranks that stand in many different texts (found on a
hashed share of the documents; this decides only where rows go) are spread
over tasks by the text's rank.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from souk.llm.order import stored
from souk.llm.text import BASE, BYTE_VALUE, CHUNK_BYTES, INVERSE, U64, empty_text, mixed, pieces, powers, utf8

#: Bytes of a string that counts as a repeat.
LENGTH = 100
#: Rows that a task holds before it drops repeats among them.
HELD = 1 << 21
#: Share of the documents (one in so many) in which ranks with many texts are looked for, and how many texts are many.
LOOKED, MANY = 64, 32

# --- ranks -----------------------------------------------------------------------


class _Hash:
    """64-bit ranks of the substrings of some bytes."""

    def __init__(self, data: np.ndarray) -> None:
        n = len(data)
        power, self.inverse = _powers(n)
        self.sums = np.zeros(n + 1, U64)
        np.cumsum(BYTE_VALUE[data] * power[:n], dtype=U64, out=self.sums[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * self.inverse[start] + (end - start).astype(U64))

    def every(self, size: int) -> np.ndarray:
        """The rank of the ``size`` bytes at each place."""
        n = len(self.sums) - size
        return mixed((self.sums[size:] - self.sums[:n]) * self.inverse[:n] + U64(size))


class _Tables:
    def __init__(self) -> None:
        self.tables = (np.zeros(0, U64), np.zeros(0, U64))

    def __reduce__(self):
        return _Tables, ()

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.tables[0]) < n + 1:
            self.tables = powers(BASE, n + 1), powers(INVERSE, n + 1)
        return self.tables


_powers = _Tables()


def _least(keys: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbouring keys."""
    out, have = keys, 1
    while have * 2 <= width:
        out, have = np.minimum(out[:-have], out[have:]), have * 2
    return np.minimum(out[: len(out) - (width - have)], out[width - have :]) if width > have else out


def stretches(offsets: np.ndarray, data: np.ndarray, length: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, place in its text, offsets, bytes) of parts to work on; parts of a longer text overlap by length - 1 bytes."""
    for i, j in pieces(offsets, CHUNK_BYTES):
        lo, hi = int(offsets[i]), int(offsets[j])
        if j > i + 1 or hi - lo <= 2 * CHUNK_BYTES:
            yield i, 0, offsets[i : j + 1] - lo, data[lo:hi]
            continue
        for at in range(lo, hi - length + 1, CHUNK_BYTES):
            part = data[at : min(hi, at + CHUNK_BYTES + length - 1)]
            yield i, at - lo, np.array([0, len(part)]), part


def anchors(offsets: np.ndarray, data: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Runs of windows with one anchor: row, first window's place in the row, windows, h-rank and rank of the run's text."""
    h = (length + 1) // 2
    if len(data) < length:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, U64),) * 2
    ranks = _Hash(data)
    grams = ranks.every(h)
    key = (grams >> U64(24) << U64(24)) | np.arange(len(grams), dtype=U64)  # places tell ties apart, the leftmost is least
    best = _least(key, length - h + 1)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[: len(best)]
    inside = np.arange(length, length + len(best)) <= offsets[row + 1]
    other = (best[1:] != best[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(inside & np.concatenate(([True], other | ~inside[:-1])))
    last = np.flatnonzero(inside & np.concatenate((other | ~inside[1:], [True])))
    at = (best[first] & U64(0xFFFFFF)).astype(np.int64)
    text = mixed(ranks(first, last + length) + (at - first).astype(U64) * U64(INVERSE) + (last - first).astype(U64))
    return row[first], first - offsets[row[first]], last - first + 1, grams[at], text


# --- rounds ----------------------------------------------------------------------
# Rows of a round: a and b (the ranks), a document (known: 0 if its id is null, doc_id, tie), the first window's
# place and the number of windows.  kind: RANKED to be sorted, REPEAT a repeat already.

RANKED, REPEAT = 0, 1
ROW = "kind int, a long, b long, known int, doc_id long, tie long, place long, windows long, spread boolean"
ARROW_ROW = pa.schema([
    ("kind", pa.int32()), ("a", pa.int64()), ("b", pa.int64()), ("known", pa.int32()), ("doc_id", pa.int64()),
    ("tie", pa.int64()), ("place", pa.int64()), ("windows", pa.int64()), ("spread", pa.bool_()),
])


class _Held:
    """Rows of a task; repeats among them leave before the shuffle."""

    def __init__(self, spread: np.ndarray) -> None:
        self.spread = spread  # sorted h-ranks whose rows go by the text's rank
        self.docs: list[tuple[int, int, int]] = []
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.n = 0

    def add(self, doc: np.ndarray, place: np.ndarray, windows: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
        self.parts.append((doc, place, windows, a, b))
        self.n += len(doc)

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self.n:
            return
        doc, place, windows, a, b = (np.concatenate(x) for x in zip(*self.parts))
        docs = np.array(self.docs, np.int64).reshape(-1, 3)
        by = np.lexsort((docs[:, 2], docs[:, 1], docs[:, 0]))
        rank = np.empty(len(docs), np.int64)
        rank[by] = np.arange(len(docs))
        order = np.lexsort((place, rank[doc]))
        order = order[np.argsort(b[order], kind="stable")]
        doc, place, windows, a, b = doc[order], place[order], windows[order], a[order], b[order]
        again = np.concatenate(([False], (a[1:] == a[:-1]) & (b[1:] == b[:-1]) & (windows[1:] == windows[:-1])))
        yield from self._rows(docs, RANKED, *(x[~again] for x in (doc, place, windows, a, b)))
        doc, place, windows = doc[again], place[again], windows[again]
        order = np.lexsort((place, doc))
        doc, place, windows = doc[order], place[order], windows[order]
        if len(doc):  # neighbouring runs of one document as one row
            starts = np.flatnonzero(np.concatenate(([True], (doc[1:] != doc[:-1]) | (place[1:] != place[:-1] + windows[:-1]))))
            total = np.add.reduceat(windows, starts)
            none = np.zeros(len(starts), U64)
            yield from self._rows(docs, REPEAT, doc[starts], place[starts], total, mixed(doc[starts].astype(U64)), none)
        self.docs, self.parts, self.n = [], [], 0

    def _rows(self, docs, kind, doc, place, windows, a, b) -> Iterator[pa.RecordBatch]:
        for i in range(0, len(doc), 1 << 17):
            s = slice(i, i + (1 << 17))
            d = docs[doc[s]]
            spread = np.isin(a[s], self.spread) if len(self.spread) else np.zeros(len(d), bool)
            columns = [np.full(len(d), kind, np.int32), a[s].view(np.int64), b[s].view(np.int64), d[:, 0].astype(np.int32), d[:, 1], d[:, 2], place[s], windows[s], spread]
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in columns], schema=ARROW_ROW)


def _documents(batch: pa.RecordBatch) -> list[tuple[int, int, int]]:
    return list(zip(*(batch.column(c).to_pylist() for c in ("known", "doc_id", "tie"))))


def _ranked_anchors(docs: DataFrame, length: int, spread: list[int]) -> DataFrame:
    hot = np.sort(np.array(spread, np.int64).view(U64))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Held(hot)
        for batch in batches:
            base = len(held.docs)
            held.docs += _documents(batch)
            offsets, data = utf8(batch.column("text"))
            for i, skip, part, raw in stretches(offsets, data, length):
                row, place, windows, a, b = anchors(part, raw, length)
                held.add(base + i + row, place + skip, windows, a, b)
                if held.n >= HELD:
                    docs_now = held.docs
                    yield from held.flush()
                    held.docs = docs_now
        yield from held.flush()

    return docs.mapInArrow(work, ROW)


def _ranked_windows(runs: DataFrame, length: int) -> DataFrame:
    """Every window of ``runs`` (a document's text with its runs' places and windows) by its pair of ranks."""
    h = (length + 1) // 2

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Held(np.zeros(0, U64))
        for batch in batches:
            base = len(held.docs)
            held.docs += _documents(batch)
            offsets, data = utf8(batch.column("text"))
            lists = batch.column("runs")
            run_of = lists.offsets.to_numpy().astype(np.int64)
            flat = lists.values
            places, counts = flat.field("place").to_numpy(), flat.field("windows").to_numpy()
            for i, skip, part, raw in stretches(offsets, data, length):
                if len(raw) < length:
                    continue
                ranks = _Hash(raw)
                s = slice(run_of[i], run_of[i + len(part) - 1])
                row = np.repeat(np.arange(len(part) - 1), np.diff(run_of[i : i + len(part)]))
                n = counts[s]
                at = np.repeat(places[s] - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())  # a run's windows one by one
                row = np.repeat(row, n)
                here = (at >= skip) & (at - skip + length <= np.diff(part)[row])
                at, row = at[here], row[here]
                p = part[row] + at - skip
                held.add(base + i + row, at, np.ones(len(at), np.int64), ranks(p, p + h), ranks(p + length - h, p + length))
                if held.n >= HELD:
                    docs_now = held.docs
                    yield from held.flush()
                    held.docs = docs_now
        yield from held.flush()

    return runs.mapInArrow(work, ROW)


def _sorted_round(rows: DataFrame, last: bool = False) -> DataFrame:
    """Repeats, and (unless it is the last round) the first of every (a, b) whose a has several b or is spread, of all tasks' rows."""
    key = F.xxhash64("a", "b") if last else F.when(F.col("spread"), F.xxhash64("a", "b")).otherwise(F.col("a"))
    dealt = rows.repartition(key).sortWithinPartitions("kind", "a", "b", "windows", "known", "doc_id", "tie", "place")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before: pa.RecordBatch | None = None  # of the last a: its first row if that is alone so far, or two rows that tell that it isn't
        done = 0  # rows of these that went out already
        for batch in batches:
            table = batch if before is None else pa.concat_batches([before, batch])
            n = table.num_rows
            kind, a, b, w = (table.column(c).to_numpy() for c in ("kind", "a", "b", "windows"))
            ranked = kind == RANKED
            same_a = np.concatenate(([False], (a[1:] == a[:-1]) & ranked[1:] & ranked[:-1]))
            same = same_a & np.concatenate(([False], (b[1:] == b[:-1]) & (w[1:] == w[:-1])))
            group = np.cumsum(~same_a) - 1
            texts = np.bincount(group, weights=~same)
            out = ~ranked | same
            if not last:
                out |= (texts[group] > 1) | table.column("spread").to_numpy(zero_copy_only=False)
            out[:done] = False
            if out.any():
                columns = table.columns
                columns[0] = pa.array(np.where(same, REPEAT, kind).astype(np.int32))
                yield pa.RecordBatch.from_arrays(columns, schema=table.schema).filter(pa.array(out))
            if not ranked[-1]:
                before, done = table.slice(n - 1, 1), 1
                continue
            first = np.flatnonzero(group == group[-1])
            heads = first[~same[first]]
            keep = heads[-1:] if len(heads) == 1 else heads[[0, -1]]
            before = table.take(pa.array(keep))
            done = 2 if len(heads) > 1 else int(bool(out[keep[0]]) or keep[0] < done)

    return dealt.mapInArrow(work, ROW)


# --- the operator ------------------------------------------------------------------

DOC = ["known", "doc_id", "tie"]


def _with_documents(docs: DataFrame, lists: DataFrame, how: str) -> DataFrame:
    """Documents with what was gathered for each; the lists are the side that is held, texts are not sorted."""
    return docs.join(lists.hint("shuffle_hash"), DOC, how)


def find(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Repeated windows: ``known``, ``doc_id``, ``tie``, ``place``, ``windows`` (neighbouring windows from a byte place on).

    docs: ``known`` (0 if the id is null), ``doc_id`` (0 then), ``tie`` and
    ``text``, no two rows with equal (known, doc_id, tie); rows go in this
    order.
    """
    some = docs.filter(F.pmod(F.xxhash64(*DOC), F.lit(LOOKED)) == 0)
    seen = stored(_ranked_anchors(some, length, []).filter(f"kind = {RANKED}").select("a", "b").distinct())
    many = max(MANY, seen.count() >> 14)  # so at most 2^14 ranks have as many
    spread = [r.a for r in seen.groupBy("a").count().filter(F.col("count") >= many).select("a").collect()]
    first = stored(_sorted_round(_ranked_anchors(docs, length, spread)).select("kind", *DOC, "place", "windows"))
    runs = first.filter(f"kind = {RANKED}").groupBy(*DOC).agg(F.collect_list(F.struct("place", "windows")).alias("runs"))
    windows = _sorted_round(_ranked_windows(_with_documents(docs, runs, "inner"), length), last=True)
    repeats = first.filter(f"kind = {REPEAT}").select(*DOC, "place", "windows")
    return repeats.unionByName(stored(windows.filter(f"kind = {REPEAT}").select(*DOC, "place", "windows")))


RESULT = "known int, doc_id long, tie long, copies long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary"


def _cut(docs: DataFrame, length: int) -> DataFrame:
    """Spans and what is kept of documents with their repeats; one row more for further copies of a row."""

    def spans(places: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        by = np.argsort(places, kind="stable")
        start, end = places[by], np.maximum.accumulate((places + counts - 1 + length)[by])
        new = np.flatnonzero(np.concatenate(([True], start[1:] > end[:-1])))
        return start[new], end[np.append(new[1:], len(end)) - 1]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets, data = utf8(batch.column("text"))
            lists = batch.column("repeats")
            at = lists.offsets.to_numpy()
            places, counts = lists.values.field("place").to_numpy(), lists.values.field("windows").to_numpy()
            out: list[tuple] = []
            for i, (known, doc, tie, copies) in enumerate(zip(*(batch.column(c).to_pylist() for c in (*DOC, "copies")))):
                raw = data[offsets[i] : offsets[i + 1]]
                s = slice(at[i], at[i + 1])
                start, end = spans(places[s], counts[s]) if at[i + 1] > at[i] else (np.zeros(0, np.int64),) * 2
                left, right = np.append(0, end), np.append(start, len(raw))
                kept = b"".join(raw[x:y].tobytes() for x, y in zip(left.tolist(), right.tolist()))
                told = [{"start": x, "end": y} for x, y in zip(start.tolist(), end.tolist())]
                out.append((known, doc, tie, 1, len(raw), told, kept))
                if copies > 1:
                    whole = len(raw) >= length
                    out.append((known, doc, tie, copies - 1, len(raw), [{"start": 0, "end": len(raw)}] if whole else [], b"" if whole else kept))
            schema = pa.schema([
                ("known", pa.int32()), ("doc_id", pa.int64()), ("tie", pa.int64()), ("copies", pa.int64()), ("n_bytes", pa.int64()),
                ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("kept", pa.binary()),
            ])
            columns = list(zip(*out)) or [[]] * len(schema)
            yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema)

    return docs.mapInArrow(work, RESULT)


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``spans`` (removed bytes, end exclusive) and ``kept`` (the bytes left) of every document.

    Texts are taken as UTF-8, whole and of any length; a null text is empty.
    Bytes covered by a string of ``length`` bytes that also starts earlier
    go: earlier is a smaller doc_id (null first), then a smaller hash of the
    text, then an earlier place.  Of rows equal in id and text the first is
    judged like any row, the others are repeats throughout.  Every row gives
    one row; other columns are ignored; an empty table gives an empty table.
    """
    rows = docs.select(
        F.col("doc_id").isNotNull().cast("int").alias("known"), F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("doc_id"), empty_text("text").alias("text")
    ).withColumn("tie", F.xxhash64("text"))
    again = rows.groupBy(*DOC).agg(F.count("*").alias("copies")).filter("copies > 1")
    again = stored(again)
    if not again.isEmpty():  # rows that come twice are judged once
        key = [F.col(c).alias(f"__{c}") for c in DOC]
        same = (F.col("known") == F.col("__known")) & (F.col("doc_id") == F.col("__doc_id")) & (F.col("tie") == F.col("__tie"))
        once = rows.join(again.select(*key), same, "left_semi").dropDuplicates(DOC)
        rows = stored(rows.join(again.select(*key), same, "left_anti").unionByName(once))
    repeats = find(rows, length).groupBy(*DOC).agg(F.collect_list(F.struct("place", "windows")).alias("repeats"))
    lists = repeats.join(again, DOC, "full")
    none = F.array().cast("array<struct<place:bigint,windows:bigint>>")
    told = _with_documents(rows, lists, "left").withColumns({"copies": F.coalesce("copies", F.lit(1)).cast("long"), "repeats": F.coalesce("repeats", none)})
    out = _cut(told.select(*DOC, "text", "copies", "repeats"), length)
    block = 1 << 16
    many = F.explode(F.transform(F.sequence(F.lit(0), F.floor((F.col("copies") - 1) / block)), lambda k: F.least(F.col("copies") - k * block, F.lit(block))))
    each = out.withColumn("n", many).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n"))))
    return each.select(F.when(F.col("known") == 1, F.col("doc_id")).alias("doc_id"), "n_bytes", "spans", "kept")
