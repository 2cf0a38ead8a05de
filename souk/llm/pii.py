"""Personal data: regular kinds by pattern, further identifiers by bootstrapping.

Native: DataFrame functions only.  Base spans are the leftmost
non-overlapping matches of a pattern per kind, kept if they pass the kind's
check.  The bootstrapping then looks at identifier tokens (tokens with a
digit or an at sign, wherever they stand):

1. A token's contexts (its shape with the two words before it, or with the
   word on either side) are its lexical patterns.  Tokens that base spans
   cover are seed entities.
2. Patterns and instances form a graph.  In each of ``ROUNDS`` rounds a
   pattern's confidence is the mean score of its distinct instances
   (smoothed by ``PRIOR``), and an instance that is no seed gets
   1 - prod(1 - confidence) over the patterns that hold it.
3. Patterns of ``CONFIDENCE`` or more that hold at least ``SUPPORT`` seeds
   mark every token in their context that no base span touches, as the kind
   most of their seeds have.

The patterns are written so that they never walk back over a text: a run
is taken whole (possessively), or only from its start.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from souk.llm.text import checkpointed, empty_text

KINDS = ("email", "ip", "card", "phone")
ROUNDS = 3
CONFIDENCE = 0.7
SUPPORT = 3
PRIOR = 1.0
#: Characters beside a token in which its neighbouring words are looked for.
REACH = 64
#: Matches per step of the running offsets.
BLOCK = 256

EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
BYTE = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
TOKEN = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+"


def matches(text: Column, pattern: str) -> Column:
    """All matches of ``pattern`` with their place: array of (start, end, text, before, after), in code points.

    before and after: the text up to the neighbouring match or the ends.
    """
    both = F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"), F.split(text, pattern, -1).alias("gaps"))

    def steps(p: Column) -> Column:
        return F.transform(
            p["found"],
            lambda m, i: F.struct(
                F.length(F.get(p["gaps"], i)).alias("gap"), F.length(m).alias("n"), m.alias("text"),
                F.right(F.get(p["gaps"], i), F.lit(REACH)).alias("before"), F.left(F.get(p["gaps"], i + 1), F.lit(REACH)).alias("after"),
            ),
        )

    return let(let(both, steps), _placed)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once (a lambda's inner expressions run for each element)."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _placed(steps: Column) -> Column:
    """Starts and ends from gaps and lengths, by blocks so that long lists stay cheap."""
    last = F.greatest(F.ceil(F.size(steps) / BLOCK).cast("int") - 1, F.lit(0))
    blocks = F.transform(F.sequence(F.lit(0), last), lambda b: F.slice(steps, b * BLOCK + 1, F.lit(BLOCK)))
    empty = F.array().cast("array<struct<start:int,end:int,text:string,before:string,after:string>>")

    def place(part: Column, first: Column) -> Column:
        def step(a: Column, s: Column) -> Column:
            start = a["at"] + s["gap"]
            one = F.struct(start.alias("start"), (start + s["n"]).alias("end"), s["text"].alias("text"), s["before"].alias("before"), s["after"].alias("after"))
            return F.struct((start + s["n"]).alias("at"), F.concat(a["out"], F.array(one)).alias("out"))

        return F.aggregate(part, F.struct(first.alias("at"), empty.alias("out")), step)["out"]

    def whole(p: Column) -> Column:
        first = lambda b: F.aggregate(F.slice(p["sizes"], F.lit(1), b), F.lit(0), lambda a, n: a + n)
        return F.flatten(F.transform(p["blocks"], lambda part, b: place(part, first(b))))

    size = lambda part: F.aggregate(part, F.lit(0), lambda a, s: a + s["gap"] + s["n"])
    return let(let(blocks, lambda p: F.struct(p.alias("blocks"), F.transform(p, size).alias("sizes"))), whole)


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    back = F.reverse(digits)
    value = F.aggregate(
        F.sequence(F.lit(1), F.length(digits)), F.lit(0),
        lambda a, i: a
        + F.when(i % 2 == 1, back.substr(i, F.lit(1)).cast("int")).otherwise(
            (back.substr(i, F.lit(1)).cast("int") * 2) % 10 + F.floor(back.substr(i, F.lit(1)).cast("int") / 5).cast("int")
        ),
    )
    return value % 10 == 0


def _as_kind(k: int) -> Callable[[Column], Column]:
    return lambda m: F.struct(m["start"].alias("start"), F.lit(k).alias("kind"), m["end"].alias("end"))


def _is_kind(k: int) -> Callable[[Column], Column]:
    return lambda s: s["kind"] == k


def base_spans(text: Column) -> Column:
    """Checked matches of all kinds: array of (start, kind number, end), sorted."""
    n_digits = lambda m: F.length(_digits(m["text"]))
    kinds = (
        (EMAIL, text.contains("@"), lambda m: F.lit(True)),
        (IP, text.rlike(r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]"), lambda m: m["text"].rlike(rf"^{BYTE}(?:\.{BYTE}){{3}}$")),
        (CARD, text.rlike(r"[0-9](?:[\x20-]?[0-9]){13}"), lambda m: F.when(n_digits(m).between(14, 19), luhn(_digits(m["text"]))).otherwise(False)),
        (PHONE, text.contains("+"), lambda m: n_digits(m).between(10, 15)),
    )
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    parts = [
        F.when(
            likely,
            F.transform(F.filter(matches(text, pattern), check), _as_kind(k)),
        ).otherwise(none)
        for k, (pattern, likely, check) in enumerate(kinds)
    ]
    return F.array_sort(F.concat(*parts))


def _stripped(m: Column) -> Column:
    """A token without the signs around it."""
    lead = F.length(m["text"]) - F.length(F.regexp_replace(m["text"], r"^[^A-Za-z0-9@+]++", ""))
    core = F.regexp_replace(F.regexp_replace(m["text"], r"^[^A-Za-z0-9@+]++", ""), r"[^A-Za-z0-9]++$", "")
    return F.struct((m["start"] + lead).alias("start"), (m["start"] + lead + F.length(core)).alias("end"), core.alias("text"), m["before"].alias("before"), m["after"].alias("after"))


def _tokens(text: Column) -> Column:
    """Identifier tokens with their contexts: array of (start, end, text, patterns)."""
    word = lambda part, k: F.lower(F.coalesce(F.get(F.filter(F.split(part, r"[\x20\x09-\x0D]++", -1), lambda w: w != ""), k), F.lit("")))
    # words before a token, the nearest first
    back = lambda part, k: F.lower(F.coalesce(F.get(F.reverse(F.filter(F.split(part, r"[\x20\x09-\x0D]++", -1), lambda w: w != "")), k), F.lit("")))
    shape = lambda t: F.left(F.regexp_replace(F.regexp_replace(t, "[A-Za-z]+", "a"), "[0-9]+", "9"), F.lit(32))

    slot = lambda m: F.concat(F.lit("<"), shape(m["text"]), F.lit(">"))

    def told(m: Column) -> Column:
        near, far, next_word = back(m["before"], F.lit(0)), back(m["before"], F.lit(1)), word(m["after"], F.lit(0))
        return F.struct(
            m["start"].alias("start"), m["end"].alias("end"), m["text"].alias("text"),
            F.filter(
                F.array(
                    F.when(near != "", F.concat_ws(" ", far, near, slot(m))), F.when((near != "") | (next_word != ""), F.concat_ws(" ", near, slot(m), next_word))
                ),
                lambda p: p.isNotNull(),
            ).alias("patterns"),
        )

    none = F.array().cast("array<struct<start:int,end:int,text:string,patterns:array<string>>>")
    cores = F.filter(F.transform(matches(text, TOKEN), _stripped), lambda m: m["text"].rlike("[0-9@]"))
    return F.when(text.rlike("[0-9@]"), F.transform(cores, told)).otherwise(none)


def _confidence(edges: DataFrame, instances: DataFrame) -> DataFrame:
    return edges.join(instances, "instance").groupBy("pattern").agg(
        (F.sum("score") / (F.count("*") + PRIOR)).alias("confidence"), F.sum(F.col("seed").cast("long")).alias("seeds")
    )


def learn(tokens: DataFrame) -> DataFrame:
    """Confident patterns with their kind: ``pattern``, ``kind``, ``confidence``.

    tokens: ``instance``, ``pattern`` and ``seed_kind`` (null if no base span covers the token).
    """
    kinds = [F.sum((F.col("seed_kind") == k).cast("long")) for k in range(len(KINDS))]
    edges = checkpointed(
        tokens.groupBy("pattern", "instance").agg(*(F.coalesce(n, F.lit(0)).alias(f"k{k}") for k, n in enumerate(kinds)))
    )
    by_kind = [F.sum(f"k{k}").alias(f"k{k}") for k in range(len(KINDS))]
    total = reduce(lambda a, b: a + b, (F.col(f"k{k}") for k in range(len(KINDS))))
    instances = checkpointed(
        edges.groupBy("instance").agg(F.sum(total).alias("n")).select("instance", (F.col("n") > 0).alias("seed"), F.when(F.col("n") > 0, 1.0).otherwise(0.0).alias("score"))
    )
    for _ in range(ROUNDS - 1):
        missed = F.sum(F.log(F.lit(1.0) - F.least(F.col("confidence"), F.lit(0.999999))))
        reached = edges.select("pattern", "instance").join(_confidence(edges, instances), "pattern").groupBy("instance").agg((1 - F.exp(missed)).alias("reached"))
        instances = checkpointed(
            instances.join(reached, "instance").select("instance", "seed", F.when(F.col("seed"), 1.0).otherwise(F.col("reached")).alias("score"))
        )
    sums = edges.groupBy("pattern").agg(*by_kind)
    most = F.greatest(*(F.col(f"k{k}") for k in range(len(KINDS))))
    kind = F.coalesce(*(F.when(F.col(f"k{k}") == most, F.lit(k)) for k in range(len(KINDS))))
    good = _confidence(edges, instances).filter((F.col("confidence") >= CONFIDENCE) & (F.col("seeds") >= SUPPORT))
    return good.join(sums.select("pattern", kind.alias("kind")), "pattern").select("pattern", "kind", "confidence")


def find(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``base`` and ``spans`` (arrays of start, kind number, end in code points) of every row.

    spans holds the base spans and those that confident patterns add; both
    are sorted by start and kind.  A token that several patterns mark gets
    the kind of the most confident one (then the first kind).  Null texts
    read as empty and give no spans; equal rows give equal spans, each its
    own row; rows without ``doc_id`` are searched like any other.  Other
    columns are ignored; an empty table gives an empty table.
    """
    text = empty_text("text")
    key = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.xxhash64(text).cast("string"), F.length(text).cast("string"))
    rows = checkpointed(docs.select("doc_id", key.alias("key"), base_spans(text).alias("base"), _tokens(text).alias("tokens")))
    touching = lambda t: F.filter(F.col("base"), lambda s: (s["start"] < t["end"]) & (t["start"] < s["end"]))
    tokens = rows.dropDuplicates(["key"]).select("key", F.explode(
        F.transform("tokens", lambda t: F.struct(t["start"].alias("start"), t["end"].alias("end"), t["text"].alias("instance"), t["patterns"].alias("patterns"), F.get(touching(t)["kind"], F.lit(0)).alias("seed_kind")))
    ).alias("t")).select("key", "t.start", "t.end", "t.instance", F.explode(F.array_distinct("t.patterns")).alias("pattern"), "t.seed_kind")
    tokens = checkpointed(tokens)
    best = tokens.filter("seed_kind IS NULL").join(learn(tokens), "pattern").groupBy("key", "start", "end").agg(
        F.min(F.struct((-F.col("confidence")).alias("c"), "kind")).alias("best")
    )
    added = best.groupBy("key").agg(F.collect_list(F.struct("start", F.col("best.kind").alias("kind"), "end")).alias("added"))
    both = F.array_sort(F.concat("base", F.coalesce("added", F.array().cast("array<struct<start:int,kind:int,end:int>>"))))
    return rows.join(added, "key", "left").select("doc_id", "base", both.alias("spans"))


def _written(spans: Column) -> Column:
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest(found: DataFrame) -> DataFrame:
    """Counts of base spans by kind, their digest, and all spans as text."""
    count = [F.size(F.filter("base", _is_kind(k))).cast("long").alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return found.select("doc_id", *count, F.sha2(_written(F.col("base")), 256).alias("base_sha256"), _written(F.col("spans")).alias("spans"))
