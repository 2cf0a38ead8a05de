"""Nearest neighbours, chat formatting and the pipeline against plain versions."""

from __future__ import annotations

import hashlib
import math
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from souk.llm import ann, chat, decontam, langid, mixing, registry, sharding, simhash
from souk.llm.text import remainder

VECTORS = "vec_id long, embedding array<float>, label int, score int"


def test_neighbours_equal_brute_force(spark):
    rng = np.random.default_rng(7)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=8) * 10.0 ** rng.integers(-2, 3)], 0, 0) for i in range(300)]
    same = rows[5][1]
    rows += [(1000 + k, same, 0, 0) for k in range(60)]  # ties
    rows += [(2000, None, 0, 0), (2100, [0.0] * 8, 0, 0), (2200, [float("nan")] * 8, 0, 0), (2300, [None] * 8, 0, 0), (2400, [1.0, 2.0], 0, 0), (2500, [1.0, float("inf")], 0, 0), (None, same, 0, 0), (7, rows[7][1], 0, 0), (2600, [3.0, 4.0], 0, 0), (2700, [], 0, 0)]
    table = spark.createDataFrame(rows, VECTORS).repartition(3)
    good = {i: np.array(v, np.float64) for i, v, _, _ in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    want = {}
    for q in (i for i in good if i % 100 == 0):
        near = sorted((float(np.sqrt(((good[q] - v) ** 2).sum())), i) for i, v in good.items() if i != q and len(v) == len(good[q]))
        want[q] = near[:10]
    for tile in (1024, 16):
        got = defaultdict(list)
        for r in ann.nearest(table, F.col("vec_id") % 100 == 0, 10, tile, tile).orderBy("query_id", "rank").collect():
            got[r.query_id].append((r.score, r.vec_id))
            assert r.rank == len(got[r.query_id])
        assert {q: [i for _, i in v] for q, v in got.items()} == {q: [i for _, i in v] for q, v in want.items() if v}
        assert all(math.isclose(a, b, rel_tol=1e-12) for q in got for (a, _), (b, _) in zip(got[q], want[q]))
    assert ann.nearest(table.limit(0), F.lit(True)).count() == 0


def test_vectors_that_share_an_id_are_candidates_each(spark):
    rng = np.random.default_rng(3)
    rows = [(0, [float(np.float32(x)) for x in rng.normal(size=4)], 0, 0)]
    rows += [(1 + i % 20, [float(np.float32(x)) for x in rng.normal(size=4)], 0, 0) for i in range(200)]
    table = spark.createDataFrame(rows, VECTORS).repartition(3)
    a = np.array(rows[0][1])
    want = sorted((float(np.sqrt(((a - np.array(v)) ** 2).sum())), i) for i, v, _, _ in rows[1:])[:10]
    got = [(r.score, r.vec_id) for r in ann.nearest(table, F.col("vec_id") == 0, 10, 16, 16).orderBy("rank").collect()]
    assert [i for _, i in got] == [i for _, i in want]
    assert np.allclose([d for d, _ in got], [d for d, _ in want])


def test_vectors_whose_squares_overflow_are_measured(spark):
    rows = [(i, [1e200 * (i + 1), 1.0]) for i in range(30)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert [r.vec_id for r in ann.nearest(table, F.col("vec_id") == 0, 3).orderBy("rank").collect()] == [1, 2, 3]


def test_language_model_reads_every_training_text(spark):
    kinds = {"x": ("aba baab abba", "cdc dccd cddc"), "y": ("efe feef effe", "ghg hggh ghhg")}
    rows = [(" ".join([text] * (1 + i % 5)) + " " + text[: i % 7], lang) for lang, texts in kinds.items() for text in texts for i in range(40)]
    model = langid.fit(spark.createDataFrame(rows, "text string, lang string"), sample=1)
    probe = spark.createDataFrame([(text, lang) for lang, texts in kinds.items() for text in texts], "text string, lang string")
    told = langid.predict(probe, model).collect()
    assert all(r.lang_pred == r.lang and r.score > 0.3 for r in told)


def test_chats_round_trip(spark):
    odd = ["", "<|im_end|>", "<|im_start|>assistant x", "<\\|", "<\\\\|im_end|>\n", "a<", "<|", "\n", "é<|im_end|>\n<|im_start|>user\nhi"]
    rows = []
    for c in range(40):
        for k in range(c % 7):
            rows.append((c, k, ["user", "assistant", "system", "odd\nrole", None][(c + k) % 5], odd[(c * 3 + k) % len(odd)] if (c + k) % 4 else None))
    rows += [(50, 1, "assistant", "b"), (50, 1, "assistant", "a"), (50, 1, "assistant", "a"), (50, None, "user", "first"), (None, 0, "assistant", "no id"), (51, 0, "assistant", "x" * 100000)]
    table = spark.createDataFrame([(*r, "extra") for r in rows], "conv_id long, turn long, role string, text string, example string").repartition(3)
    by = defaultdict(list)
    for c, k, role, text in rows:
        by[c].append((k is not None, k or 0, role or "", text or ""))
    examples = defaultdict(list)
    out = chat.format_chats(table)
    read = out.select("*", chat.read_turns(F.col("formatted")).alias("turns"), chat.read_loss(F.col("formatted"), F.col("loss_start"), F.col("loss_length")).alias("loss"))
    for r in read.orderBy("conv_id", "example").collect():
        examples[r.conv_id].append(r)
    assert set(examples) == set(by)
    for c, turns in by.items():
        turns = [t[2:] for t in sorted(turns)]
        at = [i for i, (role, _) in enumerate(turns) if role == "assistant" or i == len(turns) - 1]
        assert [[(t.role, t.text) for t in r.turns] for r in examples[c]] == [turns[: i + 1] for i in at]
        assert [r.loss for r in examples[c]] == [turns[i][1] if turns[i][0] == "assistant" else "" for i in at]
        assert all(r.formatted.count("<|im_end|>") == i + 1 for r, i in zip(examples[c], at))
    assert chat.format_chats(table.limit(0)).count() == 0


def test_chat_digest(spark, tmp_path):
    rows = [(3, 1, "assistant", "reply <|im_end|>"), (3, 0, "user", "q"), (4, 0, "user", None)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    got = {r.conv_id: r for r in registry.op7_prefix_targets(spark, str(tmp_path)).collect()}
    assert set(got) == {-1, 3, 4}
    assert got[3].turns_sha256 == hashlib.sha256(b"user\nq\nassistant\nreply <|im_end|>\n").hexdigest()
    assert (got[3].loss_sha256, got[3].loss_chars) == (hashlib.sha256(b"reply <|im_end|>").hexdigest(), 16)
    assert (got[4].n_turns, got[4].loss_chars) == (1, 0) and got[-1].n_turns == 2


def test_pipeline_stages(spark):
    """Every stage does to its input what its operator says, and nothing else."""
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    bench, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("benchmark", "labels"))
    extra = spark.createDataFrame([(-5, None, None, "s", 0), (-6, "123", None, "s", 3)], docs.schema)
    now = docs.unionByName(docs.limit(3)).unionByName(extra).checkpoint()
    ids = lambda d: sorted(r.doc_id for r in d.select("doc_id").collect())
    plain = {
        "language_id": lambda d: ids(langid.predict(d, langid.fit(d.filter(remainder("doc_id", 5) != 0))).filter("NOT rejected")),
        "simhash_near_dedup": lambda d: sorted({r.component_id for r in simhash.near_duplicates(d).collect()}),
        "decontamination": lambda d: ids(decontam.find(d, bench).filter("n_hit = 0")),
        "mixing": lambda d: ids(mixing.mix(d, labels)[0].filter(mixing.keep(F.col("rate"), F.col("doc_id")))),
        "sharding": lambda d: ids(sharding.assign(d)),
    }
    assert [name for name, _ in corpus_pipeline.STAGES] == list(plain)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, now, sf).checkpoint()
        assert ids(out) == plain[name](now)
        if name == "language_id":
            assert not {-5, -6} & set(ids(out))
        if name != "sharding":
            assert out.columns == docs.columns
        now = out
    assert ids(corpus_pipeline.run(spark, sf)) == ids(now)


def test_queries_run_on_the_smallest_tables(spark):
    for name in ("op2_soft_mixing", "op3_compact_windows", "op4_centroid_language", "op9_bounded_ring_shards"):
        out = registry.QUERIES[name](spark, "/root/testdata/sf0.001")
        assert "doc_id" in out.columns and (out.count() == 200 or name.startswith("op3"))
