"""Mixing documents to target weights with soft domain memberships.

1. A labelled table teaches a classifier the domains: a softmax regression
   on the words and byte pairs of whole texts.  Only this
   fit uses a sample: about ``SAMPLE`` labelled rows per domain, chosen by
   a hash of the id; the domains' shares count all labelled rows.
2. Every document gets posteriors p over the domains, from its text alone.
3. Nonnegative document rates r are fitted by projected gradient least
   squares on the expected domain token totals A_k = sum_i r_i n_i p_ik:
   minimise sum_k w_k (A_k - T_k)^2 from r = 1 on.  Gradients are taken in
   the metric of the token counts, so a step is r_i <- max(0, r_i - eta *
   sum_k w_k p_ik (A_k - T_k)); w_k scales each domain by its own mass and
   eta is one over the largest eigenvalue of the scaled K x K moment matrix
   sum_i n_i p_i p_i'.  An iteration is one aggregate of K totals over the
   (n, p) table.  Rates need no table of their own: they are a function of
   (n, p) and the K-number residuals so far.
4. The main domain stays whole and sets the budget, N_main / weight_main; the
   other domains' weights are ceilings: T_k = min(N_k, weight_k * budget).
   So a domain that is rare thins no other one.  Without the main domain
   the budget is the largest that needs no domain twice.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from souk.llm.decontam import WORD_BYTE
from souk.llm.text import LOWER, Shared, checkpointed, empty_text, pieces, utf8, word_bounds, word_hashes

#: Production targets: domains of the labels table and their share of the tokens.
#: Poor texts are thinned to about one token in nineteen good ones at most, toxic ones go.
TARGETS = {"good": 0.95, "poor": 0.05, "toxic": 0.0}
#: The domain that sets the budget.
MAIN = "good"
#: Words that the classifier looks at: those that tell the sample's domains apart best.
VOCABULARY = 2048
#: A word must be in so many of the sample's texts.
LEAST_TEXTS = 4
PAIR_DIMS = 1024
#: Expected labelled rows per domain that the classifier is fitted on.
SAMPLE = 1500
STEPS, RATE, DECAY = 250, 4.0, 1e-5
#: The fit ends once no domain's total is off by more than this part of all target tokens,
#: or once a step lessens the objective by less than ``STALLED`` of it (targets out of reach).
TOLERANCE = 2e-3
STALLED = 1e-2


def domain(quality: Column, toxic: Column) -> Column:
    """Domain of a labelled row; null labels read as good and clean."""
    return F.when(toxic == 1, "toxic").when(quality == 0, "poor").otherwise("good")


def features(offsets: np.ndarray, data: np.ndarray, vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit rows of log counts of the vocabulary's words and of byte pairs, and words per text."""
    n, v = len(offsets) - 1, len(vocabulary)
    rows, hashes, counts = words_of(offsets, data)
    slot = np.minimum(np.searchsorted(vocabulary, hashes), max(v - 1, 0))
    known = vocabulary[slot] == hashes if v else np.zeros(len(hashes), bool)
    pair_row = np.repeat(np.arange(n), np.maximum(np.diff(offsets) - 1, 0))
    out = np.zeros((n, v + PAIR_DIMS), np.float32)
    for base, width, row, column in ((0, v, rows[known], slot[known]), (v, PAIR_DIMS, pair_row, _pairs(data, offsets))):
        if not width:
            continue
        part = np.log1p(np.bincount(row * width + column, minlength=n * width).reshape(n, width)).astype(np.float32)
        norm = np.sqrt((part * part).sum(axis=1, keepdims=True))
        out[:, base : base + width] = part / np.where(norm > 0, norm, 1)
    return out, counts


def words_of(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text index and hash of every lower-cased word, and words per text."""
    lower = LOWER[data]
    starts, ends, counts = word_bounds(lower, offsets, WORD_BYTE)
    return np.repeat(np.arange(len(counts)), counts), word_hashes(lower, starts, ends), counts


def _pairs(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A hash of each pair of neighbouring bytes within one text; letters alike, so signs and case stand out."""
    kind = PAIR_KIND[data].astype(np.uint64)
    pair = kind[:-1] * np.uint64(257) + kind[1:] if len(kind) else kind
    cut = offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < len(data))] - 1
    inside = np.ones(len(pair), bool)
    inside[cut] = False
    return ((pair[inside] * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - (PAIR_DIMS.bit_length() - 1))).astype(np.int64)


PAIR_KIND = np.arange(256, dtype=np.uint8)
PAIR_KIND[97:123] = 97
PAIR_KIND[65:91] = 65
PAIR_KIND[128:] = 97


@dataclass
class Classifier:
    domains: list[str]
    vocabulary: np.ndarray  # sorted word hashes
    weights: np.ndarray  # (words + pairs + 1) x domains

    def posteriors(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Tokens and domain posteriors of each text."""
        offsets, data = utf8(texts)
        n, p = np.zeros(len(offsets) - 1, np.int64), np.zeros((len(offsets) - 1, len(self.domains)))
        for i, j in pieces(offsets, 1 << 20, 128):
            x, n[i:j] = features(offsets[i : j + 1] - offsets[i], data[offsets[i] : offsets[j]], self.vocabulary)
            p[i:j] = _softmax((x @ self.weights[:-1] + self.weights[-1]).astype(np.float64))
        return n, p


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def choose_words(rows: np.ndarray, hashes: np.ndarray, y: np.ndarray, k: int) -> np.ndarray:
    """The words whose share of texts differs most between domains (each domain weighs alike)."""
    texts = np.unique(np.stack([hashes, rows.astype(np.uint64)], axis=1), axis=0)
    words, which = np.unique(texts[:, 0], return_inverse=True)
    held = np.bincount(which * k + y[texts[:, 1].astype(np.int64)], minlength=len(words) * k).reshape(-1, k)
    size = np.maximum(np.bincount(y, minlength=k), 1)
    share = held / size
    spread = ((share - share.mean(axis=1, keepdims=True)) ** 2 / (share.mean(axis=1, keepdims=True) + 1 / len(y))).sum(axis=1)
    spread[held.sum(axis=1) < LEAST_TEXTS] = -1
    best = np.lexsort((words, -spread))[:VOCABULARY]
    return np.sort(words[best[spread[best] > 0]])


def fit_softmax(x: np.ndarray, y: np.ndarray, prior: np.ndarray) -> np.ndarray:
    """Softmax regression by accelerated gradient steps; the last row is the bias.

    Domains weigh alike in the fit; the bias then moves to their true shares.
    """
    k = len(prior)
    x = np.concatenate([x, np.ones((len(x), 1), np.float32)], axis=1)
    target = np.eye(k, dtype=np.float32)[y]
    weight = ((1 / np.maximum(target.sum(axis=0), 1))[y][:, None] / k).astype(np.float32)
    w = np.zeros((x.shape[1], k), np.float32)
    ahead, last = w.copy(), w.copy()
    for step in range(STEPS):
        grad = x.T @ ((_softmax(x @ ahead) - target) * weight) + np.float32(DECAY) * ahead
        w = ahead - np.float32(RATE) * grad
        ahead, last = w + np.float32(step / (step + 3)) * (w - last), w
    w[-1] += np.log(prior * k)
    return w.astype(np.float32)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Classifier:
    """Learns the domains of the labelled documents; a document labelled twice counts as its worst label."""
    named = labels.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min("quality").alias("quality"))
    named = named.select("doc_id", domain(F.col("quality"), F.col("toxic")).alias("domain"))
    rows = {r["domain"]: r["n"] for r in named.groupBy("domain").agg(F.count("*").alias("n")).collect()}
    domains = sorted(rows) or ["good"]
    if len(domains) < 2:
        return Classifier(domains, np.zeros(0, np.uint64), np.zeros((PAIR_DIMS + 1, 1), np.float32))
    prior = np.array([rows[d] for d in domains]) / sum(rows.values())
    chance = F.shiftrightunsigned(F.xxhash64("doc_id"), 11) / float(1 << 53)
    rate = F.create_map(*(x for k in domains for x in (F.lit(k), F.lit(min(1.0, sample / rows[k])))))
    # about `sample` ids per domain: bounded by that parameter
    some = F.broadcast(named.filter(chance < rate[F.col("domain")]))
    texts = docs.select("doc_id", empty_text("text").alias("text")).join(some, "doc_id").select("domain", "text")

    def learn(table: pa.Table) -> pa.Table:
        order = np.array(sorted(range(len(table)), key=lambda i: (table["domain"][i].as_py(), table["text"][i].as_py())))
        offsets, data = utf8(table["text"].combine_chunks().take(pa.array(order)))
        y = np.array([domains.index(d) for d in table["domain"].take(pa.array(order)).to_pylist()])
        found = [words_of(offsets[i : j + 1] - offsets[i], data[offsets[i] : offsets[j]]) + (i,) for i, j in pieces(offsets)]
        vocabulary = choose_words(np.concatenate([r + i for r, _, _, i in found]), np.concatenate([h for _, h, _, _ in found]), y, len(domains))
        x = np.concatenate([features(offsets[i : j + 1] - offsets[i], data[offsets[i] : offsets[j]], vocabulary)[0] for i, j in pieces(offsets, 1 << 20, 128)])
        w = fit_softmax(x, y, prior)
        return pa.table({"words": pa.array([vocabulary.tobytes()], pa.binary()), "w": pa.array([w.tobytes()], pa.binary())})

    # one task: about sample * domains texts, whatever the input
    found = texts.groupBy(F.lit("all").alias("one")).applyInArrow(learn, "words binary, w binary").collect()
    if not found:
        return Classifier(domains, np.zeros(0, np.uint64), np.tile(np.log(prior), (PAIR_DIMS + 1, 1)).astype(np.float32) * (np.arange(PAIR_DIMS + 1) == PAIR_DIMS)[:, None])
    return Classifier(domains, np.frombuffer(found[0]["words"], np.uint64), np.frombuffer(found[0]["w"], np.float32).reshape(-1, len(domains)))


ANSWER = T.StructType([T.StructField("n_tokens", T.LongType()), T.StructField("posterior", T.ArrayType(T.DoubleType()))])


def with_posteriors(docs: DataFrame, model: Classifier) -> DataFrame:
    """``docs`` with ``n_tokens`` and ``posterior`` (by ``model.domains``); a text without tokens has the bias's posterior."""
    shared = Shared(docs.sparkSession, model)

    @F.arrow_udf(ANSWER)
    def answer(texts: pa.Array) -> pa.Array:
        n, p = shared.value.posteriors(texts)
        flat = pa.ListArray.from_arrays(pa.array(np.arange(0, p.size + 1, p.shape[1]), pa.int32()), pa.array(p.ravel()))
        return pa.StructArray.from_arrays([pa.array(n), flat], names=["n_tokens", "posterior"])

    return (
        docs.drop("n_tokens", "posterior").withColumn("__a", answer.asNondeterministic()(empty_text("text")))
        .withColumns({"n_tokens": F.col("__a.n_tokens"), "posterior": F.col("__a.posterior")}).drop("__a")
    )


@dataclass
class Mix:
    """Rates as a function of posteriors: the steps of the fit, each a K-vector times the posterior."""

    domains: list[str]
    targets: np.ndarray  # tokens
    steps: list[np.ndarray] = field(default_factory=list)
    totals: np.ndarray | None = None  # expected tokens under the fitted rates

    def rate(self, posterior: Column) -> Column:
        """The fitted rate: the projected steps replayed on a document's posterior."""
        if not self.steps:
            return F.lit(1.0)
        k = len(self.domains)
        steps = F.from_json(F.lit(str([s.tolist() for s in self.steps])), "array<array<double>>")
        return F.aggregate(
            steps, F.lit(1.0),
            lambda r, g: F.greatest(F.lit(0.0), r - sum((posterior[i] * g[i] for i in range(1, k)), posterior[0] * g[0])),
        )


def fit_rates(memberships: DataFrame, domains: list[str], targets: dict[str, float]) -> Mix:
    """Projected-gradient least squares over ``n_tokens`` and ``posterior`` rows."""
    k = len(domains)
    n, p = F.col("n_tokens").cast("double"), [F.col("posterior")[i] for i in range(k)]
    first = memberships.agg(
        *(F.coalesce(F.sum(n * p[i]), F.lit(0.0)).alias(f"t{i}") for i in range(k)),
        *(F.coalesce(F.sum(n * p[i] * p[j]), F.lit(0.0)).alias(f"m{i}_{j}") for i in range(k) for j in range(i, k)),
    ).first()
    total = np.array([first[f"t{i}"] for i in range(k)])
    moment = np.array([[first[f"m{min(i, j)}_{max(i, j)}"] for j in range(k)] for i in range(k)])
    want = np.array([targets.get(d, 0.0) for d in domains])
    want = want / want.sum() if want.sum() > 0 else np.full(k, 1 / k)
    live = (want > 0) & (total > 0)
    main = live & (np.array(domains) == MAIN)
    budget = (total[live] / want[live])[main[live] if main.any() else slice(None)].min() if live.any() else 0.0
    mix = Mix(domains, np.minimum(want * budget, total))
    if not total.sum():
        mix.totals = total
        return mix
    scale = 1 / np.maximum(np.diag(moment), 1e-9 * total.sum())
    eta = 1 / np.linalg.eigvalsh(np.sqrt(scale)[:, None] * moment * np.sqrt(scale)[None, :]).max()
    now, before = total, None
    while True:
        off = now - mix.targets
        value = float((scale * off * off).sum())
        if np.abs(off).max() <= TOLERANCE * mix.targets.sum() or before is not None and before - value <= STALLED * before:
            break
        before = value
        mix.steps.append(eta * scale * off)
        rate = mix.rate(F.col("posterior"))
        got = memberships.withColumn("r", rate).agg(*(F.sum(F.col("r") * n * p[i]).alias(f"t{i}") for i in range(k))).first()
        now = np.array([got[f"t{i}"] for i in range(k)])
    mix.totals = now
    return mix


def mix(docs: DataFrame, labels: DataFrame, targets: dict[str, float] = TARGETS) -> tuple[DataFrame, Mix]:
    """``docs`` with ``n_tokens``, ``posterior`` and ``rate``, and the fit.

    rate: expected copies of the document in the mix, not negative.  Every
    row counts, repeated ones too; null and empty texts have no tokens and
    so no say in the totals, but get the rate of their posterior.  Labels of
    unknown documents are ignored; without labels, or with one domain only,
    that domain's weight is all there is.  Columns of the three names are
    replaced; an empty table gives an empty table.
    """
    docs = docs.drop("n_tokens", "posterior", "rate")
    model = fit(docs, labels)
    told = with_posteriors(docs, model)
    found = fit_rates(checkpointed(told.select("n_tokens", "posterior")), model.domains, targets)
    return told.withColumn("rate", found.rate(F.col("posterior"))), found


def rates(docs: DataFrame, labels: DataFrame, targets: dict[str, float] = TARGETS) -> tuple[DataFrame, Mix]:
    """``mix`` without the ``text`` column: the posteriors are written once and read again for the rates."""
    docs = docs.drop("n_tokens", "posterior", "rate")
    model = fit(docs, labels)
    told = checkpointed(with_posteriors(docs, model).drop("text"))
    found = fit_rates(told.select("n_tokens", "posterior"), model.domains, targets)
    return told.withColumn("rate", found.rate(F.col("posterior"))), found


def keep(rate: Column, doc_id: Column) -> Column:
    """Whether a document with this rate stays when none is repeated: by a hash of its id, so the same on any run."""
    key = F.xxhash64(F.coalesce(doc_id.cast("string"), F.lit("null")), F.lit("mix"))
    return F.shiftrightunsigned(key, 11) / float(1 << 53) < rate
