"""Language identification: nearest of several centroids per language.

Texts become TF-IDF vectors of byte n-grams (1 to 3 bytes of the UTF-8 text,
not across word gaps) hashed to ``DIMS`` columns, with log frequencies and
unit length.  The vectors of each language's training sample are clustered
by spherical k-means; a text gets the language of the centroid with the
largest cosine.  A text is rejected if its distance is far beyond that of
training texts of its length, or if it has no letter.

Document frequencies, centroids and distance limits come from every training
row.  A sample (about ``SAMPLE`` distinct texts per language, chosen by a hash,
one of every language at least) only tells where the centroids start; then
``PASSES`` rounds of the k-means read all rows, and all are measured for the
limits.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from souk.llm.text import LOWER, Shared, empty_text, pieces, utf8

DIMS = 4096
#: Expected distinct training texts per language that tell where the centroids start.
SAMPLE = 400
#: Rounds of the k-means over all training rows.
PASSES = 3
CLUSTERS = 4
ROUNDS = 12
#: A text is rejected below this part of the low quantile of its length's training cosines.
SLACK = 0.5
LOW_QUANTILE = 0.01
#: Training texts are also cut to so many bytes, to learn the distances of short texts.
CUTS = tuple(1 << k for k in range(2, 14))

#: Letters' bytes in lower case (bytes above \x7F stay); all else reads as a gap.
FOLD = np.where(((LOWER >= 97) & (LOWER <= 122)) | (LOWER >= 128), LOWER, 32).astype(np.uint8)
MULTIPLIER = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA6B), np.uint32(0xC2B2AE35))


def ngram_counts(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, columns and counts of the n-grams of some texts (columns of ``DIMS``)."""
    n = len(offsets) - 1
    size = np.diff(offsets)
    text = np.full(len(data) + n + 2, 32, np.uint8)
    text[np.arange(len(data)) + np.repeat(np.arange(1, n + 1), size)] = FOLD[data]
    solid = text != 32
    at = np.flatnonzero(solid)
    row = np.repeat(np.arange(n), size + 1)[at - 1]  # a text's bytes and the gap after them
    b, a, c = text[at].astype(np.uint32), text[at - 1].astype(np.uint32), text[at + 1].astype(np.uint32)
    shift = np.uint32(32 - (DIMS.bit_length() - 1))
    one = (b + np.uint32(1)) * MULTIPLIER[0]
    two = (b + np.uint32(1) + (c << np.uint32(9))) * MULTIPLIER[1]
    three = (a + np.uint32(1) + (b << np.uint32(9)) + (c << np.uint32(18))) * MULTIPLIER[2]
    base = row.astype(np.int64) * DIMS
    total = np.zeros(n * DIMS, np.int64)
    for h in (one, two, three):
        h ^= h >> np.uint32(15)
        h *= MULTIPLIER[0]
        total += np.bincount(base + (h >> shift), minlength=n * DIMS)
    hit = np.flatnonzero(total)
    return hit // DIMS, hit % DIMS, total[hit]


def vectors(offsets: np.ndarray, data: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """TF-IDF rows of unit length (zero for texts without n-grams)."""
    rows, cols, counts = ngram_counts(offsets, data)
    out = np.zeros((len(offsets) - 1, DIMS), np.float32)
    out[rows, cols] = np.log1p(counts) * idf[cols]
    norm = np.sqrt(np.einsum("ij,ij->i", out, out))
    return out / np.where(norm > 0, norm, 1)[:, None]


@dataclass
class Model:
    idf: np.ndarray
    languages: list[str]
    owner: np.ndarray  # language index of each centroid
    centroids: np.ndarray
    limits: np.ndarray  # least cosine by length class

    def predict(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Language index (-1: none learned), cosine and length class of each text."""
        offsets, data = utf8(texts)
        n = len(offsets) - 1
        best, score = np.full(n, -1), np.zeros(n, np.float64)
        size = np.diff(offsets)
        if len(self.owner):
            for i, j in pieces(offsets, 1 << 20, 128):
                near = vectors(offsets[i : j + 1] - offsets[i], data[offsets[i] : offsets[j]], self.idf) @ self.centroids.T
                by = np.stack([near[:, self.owner == k].max(axis=1) for k in range(len(self.languages))], axis=1)
                best[i:j], score[i:j] = by.argmax(axis=1), by.max(axis=1)
        return best, np.clip(score, 0, 1), length_class(size)


def length_class(size: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(np.maximum(size, 1)).astype(np.int64), 31)


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = ROUNDS) -> np.ndarray:
    """At most ``k`` unit centroids of unit rows; starts from rows far from each other."""
    chosen = [0]
    while len(chosen) < min(k, len(x)):
        chosen.append(int((x @ x[chosen].T).max(axis=1).argmin()))
    c = x[chosen]
    for _ in range(rounds):
        near = (x @ c.T).argmax(axis=1)
        c = np.stack([x[near == i].sum(axis=0) if (near == i).any() else c[i] for i in range(len(c))])
        c = c / np.maximum(np.sqrt((c * c).sum(axis=1)), 1e-12)[:, None]
    return c


def _document_frequencies(train: DataFrame) -> tuple[np.ndarray, int]:
    """Texts holding each column's n-grams, and texts, over all training rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(DIMS + 1, np.int64)
        for batch in batches:
            offsets, data = utf8(batch.column("text"))
            held[DIMS] += len(offsets) - 1
            for i, j in pieces(offsets, 1 << 20, 128):
                _, cols, _ = ngram_counts(offsets[i : j + 1] - offsets[i], data[offsets[i] : offsets[j]])
                held[:DIMS] += np.bincount(cols, minlength=DIMS)
        at = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(held[at])], names=["column", "n"])

    rows = train.select("text").mapInArrow(count, "column long, n long").groupBy("column").agg(F.sum("n").alias("n")).collect()
    held = np.zeros(DIMS + 1, np.int64)
    for r in rows:
        held[r["column"]] = r["n"]
    return held[:DIMS], int(held[DIMS])


def fit(train: DataFrame, sample: int = SAMPLE, clusters: int = CLUSTERS) -> Model:
    """Learns from ``text`` and ``lang`` of the rows with a non-null ``lang``.

    Texts without a letter teach nothing; a language that has no others is
    not learned, every other one is, however few or alike its texts are.
    Without any row to learn from the model knows no language.
    """
    train = train.select(empty_text("text").alias("text"), "lang").filter(F.col("lang").isNotNull() & has_letter(F.col("text")))
    held, n = _document_frequencies(train)
    idf = (np.log((1 + n) / (1 + held)) + 1).astype(np.float32)
    place = F.shiftrightunsigned(F.xxhash64("lang", "text"), 11)
    rows = train.groupBy("lang").agg(F.count_distinct(place).alias("n"), F.min(place).alias("first")).collect()
    if not rows:
        return Model(idf, [], np.zeros(0, np.int64), np.zeros((0, DIMS), np.float32), np.zeros(32))
    upto = F.create_map(*(x for r in rows for x in (F.lit(r["lang"]), F.lit(max(r["first"], int(min(1.0, sample / r["n"]) * (1 << 53)))))))
    some = train.filter(place <= upto[F.col("lang")]).dropDuplicates(["lang", "text"])

    def embed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets, data = utf8(batch.column("text"))
            for i, j in pieces(offsets, 1 << 20, 128):
                x = vectors(offsets[i : j + 1] - offsets[i], data[offsets[i] : offsets[j]], idf)
                yield pa.RecordBatch.from_arrays([batch.column("lang").slice(i, j - i), pa.array([v.tobytes() for v in x], pa.binary())], names=["lang", "vector"])

    def cluster(table: pa.Table) -> pa.Table:
        x = np.stack([np.frombuffer(v, np.float32) for v in sorted(table.column("vector").to_pylist())])
        c = spherical_kmeans(x, clusters)
        return pa.table({"lang": pa.array([table.column("lang")[0].as_py()] * len(c), pa.string()), "centroid": pa.array([v.tobytes() for v in c], pa.binary())})

    found = some.mapInArrow(embed, "lang string, vector binary").groupBy("lang").applyInArrow(cluster, "lang string, centroid binary").collect()
    found = sorted(found, key=lambda r: (r["lang"], bytes(r["centroid"])))
    languages = sorted({r["lang"] for r in found})
    owner = np.array([languages.index(r["lang"]) for r in found], np.int64)
    model = Model(idf, languages, owner, np.stack([np.frombuffer(r["centroid"], np.float32) for r in found]), np.zeros(32))
    for _ in range(PASSES):
        model.centroids = _moved(train, model)
    model.limits = _limits(train, model)
    return model


def _moved(train: DataFrame, model: Model) -> np.ndarray:
    """Centroids after one round of the k-means over all rows; one that no text is nearest to stays."""
    of = {name: np.flatnonzero(model.owner == k) for k, name in enumerate(model.languages)}

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            offsets, data = utf8(batch.column("text"))
            own = np.array([of[name][0] for name in batch.column("lang").to_pylist()], np.int64)
            for i, j in pieces(offsets, 1 << 20, 128):
                x = vectors(offsets[i : j + 1] - offsets[i], data[offsets[i] : offsets[j]], model.idf)
                for first in np.unique(own[i:j]).tolist():  # a language's centroids are neighbours
                    mine = x[own[i:j] == first]
                    here = of[model.languages[model.owner[first]]]
                    near = here[(mine @ model.centroids[here].T).argmax(axis=1)]
                    for c in np.unique(near).tolist():
                        sums[c] = sums.get(c, 0.0) + mine[near == c].sum(axis=0, dtype=np.float64)
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int64()), pa.array([v.tobytes() for v in sums.values()], pa.binary())], names=["centroid", "total"])

    def total(table: pa.Table) -> pa.Table:
        v = np.sum([np.frombuffer(b, np.float64) for b in sorted(table.column("total").to_pylist())], axis=0)
        return pa.table({"centroid": table.column("centroid").slice(0, 1), "total": pa.array([v.tobytes()], pa.binary())})

    moved = model.centroids.copy()
    for r in train.mapInArrow(add, "centroid long, total binary").groupBy("centroid").applyInArrow(total, "centroid long, total binary").collect():
        v = np.frombuffer(r["total"], np.float64)
        moved[r["centroid"]] = v / max(np.sqrt(v @ v), 1e-12)
    return moved


def _limits(train: DataFrame, model: Model) -> np.ndarray:
    """Least cosine that is not rejected, by length class, from all training texts and the cuts of the longer ones.

    A class that they lack has the limit of the nearest shorter one
    (cosines grow with the length); those below all that it has reject nothing.
    """

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cut in (*CUTS, None):
                texts = batch.column("text")
                if cut is not None:
                    texts = pc.utf8_slice_codeunits(texts.filter(pc.greater(pc.utf8_length(texts), cut)), 0, cut)
                texts = texts.filter(pc.match_substring_regex(texts, r"\p{L}"))
                _, score, size = model.predict(texts)
                yield pa.RecordBatch.from_arrays([pa.array(size), pa.array(score)], names=["size", "score"])

    rows = train.select("text").mapInArrow(measure, "size long, score double").groupBy("size").agg(
        F.percentile_approx("score", LOW_QUANTILE, 1000).alias("low")
    ).collect()
    limits = np.zeros(32)
    known = {r["size"]: SLACK * r["low"] for r in rows}
    for size in range(32):
        limits[size] = known.get(size, limits[size - 1] if size else 0.0)
    return limits


def has_letter(text: Column) -> Column:
    return text.rlike(r"\p{L}")


ANSWER = T.StructType([T.StructField("lang", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("far", T.BooleanType())])
ARROW_ANSWER = pa.struct([("lang", pa.string()), ("score", pa.float64()), ("far", pa.bool_())])


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` (cosine, 0 to 1) and ``rejected``.

    ``lang_pred`` is a learned language, or ``und`` (score 0, rejected) for a
    null text, a text without a letter, or if no language was learned.  Equal
    cosines go to the language that sorts first.  Whole texts of any length
    count; rows are neither dropped nor merged.  Columns of the three names
    are replaced; an empty table gives an empty table.
    """
    shared = Shared(docs.sparkSession, model)

    @F.arrow_udf(ANSWER)
    def answer(texts: pa.Array) -> pa.Array:
        m = shared.value
        best, score, size = m.predict(texts)
        names = [m.languages[k] if k >= 0 else None for k in best.tolist()]
        return pa.StructArray.from_arrays(
            [pa.array(names, pa.string()), pa.array(score), pa.array(score < m.limits[size])], fields=list(ARROW_ANSWER)
        )

    text = empty_text("text")
    known = has_letter(text) & F.col("__a.lang").isNotNull()
    return (
        docs.withColumn("__a", answer.asNondeterministic()(text))
        .withColumn("lang_pred", F.when(known, F.col("__a.lang")).otherwise("und"))
        .withColumn("score", F.when(known, F.col("__a.score")).otherwise(0.0))
        .withColumn("rejected", F.when(known, F.col("__a.far")).otherwise(True))
        .drop("__a")
    )
