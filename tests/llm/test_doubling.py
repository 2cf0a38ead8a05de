"""Byte-exact removal of repeats against a plain version."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from souk.llm import doubling

LENGTH = 20


def plain(rows, length):
    """(doc_id, bytes, spans, kept) of every row; rows in order of doc_id (null first), text's hash."""
    seen, out = set(), []
    for doc, _, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1])):
        raw = (text or "").encode()
        gone, own = bytearray(len(raw)), []
        for p in range(len(raw) - length + 1):
            s = raw[p : p + length]
            if s in seen:
                gone[p : p + length] = b"\1" * length
            seen.add(s)
        edges = [i for i in range(len(raw) + 1) if (i < len(raw) and gone[i]) != (i > 0 and gone[i - 1])]
        own = list(zip(edges[::2], edges[1::2]))
        out.append((doc, len(raw), own, bytes(b for b, g in zip(raw, gone) if not g)))
    return sorted(out, key=repr)


def texts(rng):
    word = lambda: "".join(rng.choice("abcé") for _ in range(rng.randint(1, 4)))
    base = [" ".join(word() for _ in range(rng.randint(0, 60))) for _ in range(60)]
    line = "a passage that many share: it is long enough"
    out = base + [base[3], base[4][5:80], base[7] + base[8] + base[7], "a" * 300, "ab" * 100, "b" * 19, "b" * 20, "b" * 21, "", None, "é" * 40]
    out += [word() * rng.randint(0, 2) + line + " " + word() + word() for _ in range(50)] + [base[11]] * 20
    edited = base[12].split()
    out += [" ".join(edited[:k] + ["zz"] + edited[k + 1 :]) for k in range(3, 12)]
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_plain_version(spark, seed, monkeypatch):
    rng = random.Random(seed)
    rows = list(enumerate(texts(rng)))
    rng.shuffle(rows)
    rows += [(None, "null id " * 9), (None, "null id " * 9), (None, "null id " * 9), (5, "another text under a used id " * 2), (rows[0][0], rows[0][1]), (None, None), (900, "a" * 20)]
    table = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], "doc_id long, text string, n_bytes long, kept string, tie int").repartition(5)
    tied = [(r.doc_id, r.t, r.text) for r in table.withColumn("t", F.xxhash64(F.coalesce("text", F.lit("")))).collect()]
    want = plain(tied, LENGTH)
    if seed == 2:  # few held rows, every rank looked at
        monkeypatch.setattr(doubling, "HELD", 50)
        monkeypatch.setattr(doubling, "LOOKED", 1)
        monkeypatch.setattr(doubling, "MANY", 3)
    got = sorted(((r.doc_id, r.n_bytes, [(s.start, s.end) for s in r.spans], bytes(r.kept)) for r in doubling.remove_repeats(table, LENGTH).collect()), key=repr)
    assert got == want


def test_long_texts_are_cut_into_parts(spark, monkeypatch):
    monkeypatch.setattr(doubling, "CHUNK_BYTES", 64)
    rng = random.Random(4)
    rows = [(k, "".join(rng.choice("abcdefgh ") for _ in range(rng.randint(100, 700)))) for k in range(20)]
    rows += [(100, rows[3][1][50:500] + "x" + rows[4][1][10:300]), (101, rows[5][1]), (102, "abc" * 200)]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(((r.doc_id, r.n_bytes, [(s.start, s.end) for s in r.spans], bytes(r.kept)) for r in doubling.remove_repeats(table, LENGTH).collect()), key=repr)
    assert got == plain([(d, 0, t) for d, t in rows], LENGTH)


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string, extra int")
    assert doubling.remove_repeats(none).count() == 0
