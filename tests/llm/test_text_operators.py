"""Operators on documents against plain versions, with odd rows and empty tables."""

from __future__ import annotations

import hashlib
import math
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from souk.llm import decontam, langid, lm, mixing, pii, sharding, simhash, substring
from souk.llm.text import LOWER, TOKEN_BYTE, remainder, utf8, word_bounds, word_hashes


def lower(text):
    return (text or "").translate({i: i + 32 for i in range(65, 91)})


# --- words -----------------------------------------------------------------------


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="aB \n\té|", max_size=30), max_size=6))
def test_words_of_a_batch(texts):
    offsets, data = utf8(pa.array(texts, pa.string()))
    data = LOWER[data]
    starts, ends, counts = word_bounds(data, offsets, TOKEN_BYTE)
    got = [bytes(data[a:b]) for a, b in zip(starts, ends)]
    assert got == [w for t in texts for w in t.encode().lower().split()]
    assert counts.tolist() == [len(t.encode().split()) for t in texts]
    hashes = word_hashes(data, starts, ends).tolist()
    assert all((x == y) == (a == b) for x, a in zip(hashes, got) for y, b in zip(hashes, got))


# --- decontamination ---------------------------------------------------------------


def brute_windows(docs, bench):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = defaultdict(set)
    for item, text in bench:
        w = word.findall(lower(text))
        n = min(10, len(w))
        for k in range(len(w) - n + 1) if n else ():
            windows[tuple(w[k : k + n])].add(item)
    out = []
    for doc, text in docs:
        w, items, hit = word.findall(lower(text)), set(), set()
        for n in {len(k) for k in windows}:
            for k in range(len(w) - n + 1):
                if found := windows.get(tuple(w[k : k + n])):
                    items |= found
                    hit |= set(range(k, k + n))
        out.append((doc, len(w), len(hit), tuple(sorted(str(i) for i in items if i is not None))))
    return sorted(out, key=repr)


def test_decontamination_equals_brute_force(spark, odd_docs):
    docs = [(r.doc_id, r.text) for r in odd_docs.collect()]
    bench = [(1, docs[0][1]), (2, "Zz"), (3, None), (4, "..."), (10, " ".join((docs[5][1] or "a b").split()[2:40])), (2, "zz ZZ zz"), (None, "w5x w6x")]
    extra = [(900, f"x {bench[0][1]} y. {bench[0][1]}"), (901, "zz-zz"), (902, "w5x,W6X")]
    both = odd_docs.select("doc_id", "text").unionByName(spark.createDataFrame(extra, "doc_id long, text string"))
    table = spark.createDataFrame(bench, "item_id long, text string")
    for block_bytes in (decontam.BLOCK_BYTES, 64):  # one block, several blocks
        got = decontam.find(both, table, block_bytes=block_bytes).collect()
        assert sorted(((r.doc_id, r.n_words, r.n_hit, tuple(r.items)) for r in got), key=repr) == brute_windows([*docs, *extra], bench)
    longest = max((m for r in decontam.find(both, table).filter("doc_id = 900").collect() for m in r.matches), key=lambda m: m.words)
    assert (longest.start, longest.item, longest.item_start) == (1, "1", 0)
    clean = decontam.decontaminate(both, table)
    assert clean.columns == both.columns and clean.filter("doc_id >= 900").count() == 0


def test_decontamination_of_empty_tables(spark, odd_docs, no_docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontam.find(odd_docs, none).filter("n_hit > 0").count() == 0
    assert decontam.decontaminate(no_docs, none).count() == 0


# --- SimHash -----------------------------------------------------------------------


def plain_fingerprint(text):
    w = (text or "").encode().lower().split()
    parts = [b" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    h = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(values, reach):
    parent = list(range(len(values)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= reach:
                parent[root(i)] = root(j)
    return [root(i) for i in range(len(values))]


def test_near_duplicates_equal_all_pairs(odd_docs):
    rows = [(r.doc_id, plain_fingerprint(r.text)) for r in odd_docs.collect()]
    root = plain_components([f for _, f in rows], 3)
    least = {}
    for (doc, _), k in zip(rows, root):
        if doc is not None:
            least[k] = min(least.get(k, doc), doc)
    want = sorted(((d, f"{f:016x}", least.get(k)) for (d, f), k in zip(rows, root)), key=repr)
    got = simhash.near_duplicates(odd_docs).collect()
    assert sorted(((r.doc_id, r.fingerprint, r.component_id) for r in got), key=repr) == want
    kept = simhash.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns and kept.count() == len(set(root))


def test_hot_shards_are_split_without_losing_links(spark):
    rng = np.random.default_rng(3)
    base = int(rng.integers(1, 1 << 62))
    values = {base}
    for _ in range(400):  # a cloud of values a few bits apart, and strangers
        v = base
        for b in rng.integers(0, 38, rng.integers(1, 5)):
            v ^= 1 << int(b)
        values.add(v)
    values |= {int(x) for x in rng.integers(-(1 << 62), 1 << 62, 200)}
    values = sorted(values)
    table = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "doc_id long, fingerprint long")
    from souk.llm.graph import components

    label = {r.node: r.component for r in components(simhash.links(table, tree_size=16)).collect()}
    root = plain_components([v & (2**64 - 1) for v in values], 3)
    for i in range(len(values)):
        for j in range(i):
            assert (label.get(values[i], values[i]) == label.get(values[j], values[j])) == (root[i] == root[j])


def test_bk_tree_finds_all_within_the_radius():
    rng = np.random.default_rng(1)
    values = np.unique(rng.integers(0, 256, 120).astype(np.int64))
    q, t = simhash.BKTree(values).search(values, 3)
    want = {(i, j) for i in range(len(values)) for j in range(len(values)) if int(values[i] ^ values[j]).bit_count() <= 3}
    assert set(zip(q.tolist(), t.tolist())) == want


def test_near_duplicates_of_an_empty_table(no_docs):
    assert simhash.near_duplicates(no_docs).count() == 0 and simhash.keep_one(no_docs).count() == 0


# --- sharding ----------------------------------------------------------------------


def test_shards_are_even_gapless_and_whole(odd_docs, no_docs):
    out = sharding.assign(odd_docs).collect()
    assert len(out) == odd_docs.count()
    by = defaultdict(list)
    for r in out:
        by[r.shard].append(r.slot)
        assert r.size == len((r.text or "").encode()) + 1 and r.text_crc32 == zlib.crc32((r.text or "").encode())
    sizes = [len(by.get(s, [])) for s in range(16)]
    assert max(sizes) - min(sizes) <= 1 and all(sorted(v) == list(range(len(v))) for v in by.values())
    again = sharding.assign(odd_docs.repartition(7)).collect()
    assert Counter((r.doc_id, r.text, r.shard) for r in again) == Counter((r.doc_id, r.text, r.shard) for r in out)
    assert sharding.assign(no_docs).count() == 0


@settings(max_examples=80, deadline=None)
@given(st.dictionaries(st.integers(0, 63), st.integers(0, 40), max_size=30), st.integers(1, 6), st.randoms())
def test_ring_plan(counts, shards, rnd):
    owners = {c: k % shards for k, c in enumerate(rnd.sample(range(64), max(shards, 8)))}
    plan = sharding.plan(counts, owners, shards)
    covered = Counter((c, i) for c, a, b, _, _ in plan for i in range(a, b))
    assert covered == Counter((c, i) for c, n in counts.items() for i in range(n))
    slots = defaultdict(list)
    for _, a, b, s, slot in plan:
        slots[s] += range(slot, slot + b - a)
    sizes = [len(slots[s]) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1 and all(sorted(v) == list(range(len(v))) for v in slots.values())


# --- language ----------------------------------------------------------------------


LANGS = {"xx": "abcdef", "yy": "ghijkl", "zz": "éèüöñß"}


@pytest.fixture(scope="module")
def lang_docs(spark):
    import random

    from tests.llm.conftest import words

    rng = random.Random(2)
    rows = [(i, words(rng, rng.choice([1, 3, 30, 200]), a), k) for i, (k, a) in enumerate(list(LANGS.items()) * 60)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_language_of_held_out_texts(spark, lang_docs, odd_docs):
    held_out = remainder("doc_id", 5) == 0
    model = langid.fit(lang_docs.filter(~held_out))
    out = langid.predict(lang_docs.filter(held_out), model).collect()
    assert sum(r.lang == r.lang_pred for r in out) >= 0.97 * len(out) and not any(r.rejected for r in out)
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "123 --- 4"), (4, "qzq qzq wvx zwx qxz " * 40), (5, "abcdef " * 200000)], "doc_id long, text string")
    got = {r.doc_id: r for r in langid.predict(odd, model).collect()}
    assert all(got[i].lang_pred == "und" and got[i].score == 0 and got[i].rejected for i in (1, 2, 3))
    assert got[4].rejected and got[4].lang_pred in LANGS and got[5].lang_pred == "xx"
    assert langid.predict(odd_docs, model).count() == odd_docs.count()
    assert all(0 <= r.score <= 1 for r in out)


def test_language_without_training_rows(spark, lang_docs):
    none = spark.createDataFrame([], "doc_id long, text string, lang string")
    model = langid.fit(none)
    assert {r.lang_pred for r in langid.predict(lang_docs, model).collect()} == {"und"}
    assert langid.predict(none, model).count() == 0


# --- mixing ------------------------------------------------------------------------


def test_mixing_meets_reachable_targets(spark, odd_docs, no_docs):
    import random

    from tests.llm.conftest import words

    rng = random.Random(4)
    rows = [(i, words(rng, 80) + (" awful filth" * 3 if i % 5 == 0 else " ### |" * 10 if i % 5 == 1 else "")) for i in range(500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 5 != 1), int(i % 5 == 0)) for i in range(0, 500, 2)] + [(7, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    told, fit = mixing.mix(docs, labels)
    share = fit.totals / fit.totals.sum()
    assert np.abs(fit.totals - fit.targets).max() <= 0.02 * fit.targets.sum() and fit.domains == ["good", "poor", "toxic"]
    got = {r.doc_id: r for r in told.collect()}
    assert all(abs(sum(r.posterior) - 1) < 1e-9 and r.rate >= 0 for r in got.values())
    assert np.mean([got[i].rate for i in got if i % 5 == 0]) < 0.2 < 0.9 < np.mean([got[i].rate for i in got if i % 5 > 1])
    assert share[2] < 0.05
    # the fitted rates are the projected gradient steps themselves
    p = np.array([got[i].posterior for i in range(500)])
    r = np.ones(500)
    for s in fit.steps:
        r = np.maximum(0, r - p @ s)
    assert np.allclose(r, [got[i].rate for i in range(500)])
    assert mixing.mix(odd_docs, labels)[0].count() == odd_docs.count()
    assert mixing.mix(no_docs, labels)[0].count() == 0
    assert {x.rate for x in mixing.rates(docs, labels.limit(0))[0].collect()} == {1.0}


def test_mixing_keeps_a_clean_corpus(spark):
    import random

    from tests.llm.conftest import words

    rng = random.Random(8)
    kind = ["toxic" if i % 250 == 0 else "poor" if i % 100 == 1 else "good" for i in range(1500)]
    rows = [(i, words(rng, 80) + {"toxic": " awful filth" * 12, "poor": " ### |" * 20, "good": ""}[k]) for i, k in enumerate(kind)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(k != "poor"), int(k == "toxic")) for i, k in enumerate(kind)], "doc_id long, quality int, toxic int")
    told, fit = mixing.mix(docs, labels)
    kept = {r.doc_id for r in told.filter(mixing.keep(F.col("rate"), F.col("doc_id"))).collect()}
    share = {d: np.mean([i in kept for i, k in enumerate(kind) if k == d]) for d in fit.domains}
    assert share["good"] >= 0.95 and share["poor"] >= 0.8 and share["toxic"] == 0


# --- repeated passages ---------------------------------------------------------------


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 24), max_size=4), st.integers(1, 7), st.randoms())
def test_compact_windows_cover_each_subsequence_once(sizes, t, rnd):
    m = np.array(sizes, np.int64)
    h = np.array([rnd.randint(0, 9) << 40 for _ in range(int(m.sum()))], np.uint64)
    text, left, centre, right = substring.compact_windows(h, m, t)
    first = np.cumsum(m) - m
    for d in range(len(m)):
        x = h[first[d] : first[d] + m[d]].tolist()
        got = Counter()
        for k in np.flatnonzero(text == d):
            for i in range(left[k], centre[k] + 1):
                got.update((i, j, int(centre[k])) for j in range(max(centre[k], i + t - 1), right[k] + 1))
        assert got == Counter((i, j, min(range(i, j + 1), key=lambda q: (x[q], q))) for i in range(len(x)) for j in range(i + t - 1, len(x)))


def test_repeated_passages(spark, odd_docs, no_docs):
    import random

    from tests.llm.conftest import words

    rng = random.Random(9)
    passage = words(rng, 70)
    edited = passage.split()
    edited[35] = "changed"
    rows = [(k, f"{words(rng, 60)} {passage if k % 3 else ' '.join(edited)} {words(rng, 90)}") for k in range(1000, 1030)]
    rows += [(2000 + k, words(rng, 200) + " a line that many share and no more than that") for k in range(40)]
    found = substring.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    text = dict(rows)
    for r in found:
        assert r.doc_id > r.other_id and r.end - r.start >= 50
        a, b = ([w[i : i + 5] for i in range(len(w) - 4)] for w in (text[r.doc_id].split()[r.start : r.end], text[r.other_id].split()[r.other_start : r.other_end]))
        a, b = {tuple(x) for x in a}, {tuple(x) for x in b}
        assert math.isclose(len(a & b) / len(a | b), r.similarity) and r.similarity >= 0.8
    assert {r.doc_id for r in found} | {r.other_id for r in found} == set(range(1000, 1030))
    assert len(found) <= 3 * 30  # linear in a group of copies
    odd = substring.repeated_passages(odd_docs).collect()
    held = {r.doc_id for r in odd} | {r.other_id for r in odd}
    text = dict((r.doc_id, r.text) for r in odd_docs.collect())
    if len(text[7].split()) >= 50:
        assert set(range(200, 230)) <= held
    assert substring.repeated_passages(no_docs).count() == 0


def test_passages_whose_signatures_lead_elsewhere(spark):
    """Documents with smaller and larger ids hold the passage's shingles, each on its own, and so lead its signatures."""
    import random

    from tests.llm.conftest import words

    rng = random.Random(11)
    passage = words(rng, 70)
    w = passage.split()
    scattered = lambda: " ".join(f"{words(rng, 45)} {' '.join(w[i : i + 5])}" for i in range(len(w) - 4))
    rows = [(k, scattered()) for k in [*range(12), *range(900, 912)]] + [(k, f"{words(rng, 60)} {passage} {words(rng, 60)}") for k in (100, 101, 102)]
    found = substring.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    linked = {(r.doc_id, r.other_id): (r.start, r.end, r.other_start, r.other_end) for r in found}
    assert set(linked) == {(101, 100), (102, 100), (102, 101)}
    assert all(a <= 60 and b >= 130 and c <= 60 and d >= 130 for a, b, c, d in linked.values())


@pytest.mark.parametrize("n", [50, 54, 60, 70, 90, 130])
def test_edited_passages_of_any_length_and_place(n):
    rng = np.random.default_rng(n)
    t = substring.WORDS - substring.SHINGLE + 1

    def both(passage, edited):
        texts = [" ".join(f"w{k}" for k in np.concatenate([rng.integers(1000, 1 << 40, 30), p, rng.integers(1000, 1 << 40, 40)])) for p in (passage, edited)]
        return substring._contents(pa.array(texts))

    for place in range(0, n, 3):
        for edit in ([999], [], [998, 999]):  # a word changed, left out, put in
            passage = np.arange(n)
            edited = np.concatenate([passage[:place], edit, passage[place + (len(edit) < 2) :]]).astype(np.int64)
            if len(edit) == 2:
                edited = np.concatenate([passage[:place], [999], passage[place:]])
            p, q = ({tuple(x[i : i + 5]) for i in range(len(x) - 4)} for x in (passage, edited))
            if min(len(passage), len(edited)) < 50 or len(p & q) < 0.8 * len(p | q):
                continue
            a, b = both(passage, edited)
            found = substring.verified(a, b, t)
            assert len(found) == 1, (place, edit)
            i, j, s, e, value = found[0]
            mine, other = set(a[i:j].tolist()), set(b[s:e].tolist())
            assert min(j - i, e - s) >= t and math.isclose(value, len(mine & other) / len(mine | other)) and value >= 0.8
            assert j - i >= len(p) - 10 and i <= 30 + 10 and j >= 30 + len(p) - 10


def test_verification_finds_what_all_stretches_hold():
    rng, seen = np.random.default_rng(2), Counter()
    for _ in range(250):
        x, y = rng.integers(100, 1 << 30, 17), rng.integers(100, 1 << 30, 17)
        y[3:14] = x[3:14]
        for k in rng.integers(0, 15, rng.integers(0, 3)):
            y = np.delete(y, k) if rng.random() < 0.3 else np.insert(y, k, 7) if rng.random() < 0.5 else np.where(np.arange(len(y)) == k, 8, y)
        x, y = x.astype(np.uint32), y.astype(np.uint32)
        spans = lambda v: [set(v[i:j].tolist()) for i in range(len(v)) for j in range(i + 10, len(v) + 1)]
        want = any(len(p & q) >= 0.8 * len(p | q) for p in spans(x) for q in spans(y))
        assert bool(substring.verified(x, y, 10)) == want
        seen[want] += 1
    assert min(seen[True], seen[False]) > 20


# --- personal data -------------------------------------------------------------------

KINDS = (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]",
)


def plain_spans(text):
    out = []
    for k, pattern in enumerate(KINDS):
        for m in re.finditer(pattern, text or ""):
            d = re.sub(r"\D", "", m[0])
            even = sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d)))
            ok = (True, k == 1 and all(int(x) <= 255 for x in m[0].split(".")), 14 <= len(d) <= 19 and even % 10 == 0, 10 <= len(d) <= 15)[k]
            out += [(m.start(), k, m.end())] * ok
    return sorted(out)


def test_personal_data(spark, odd_docs, no_docs):
    import random

    rng = random.Random(6)
    parts = ["a@b.cd", "x.y@m-1.example.org", "1.2.3.4", "001.255.0.9", "256.1.1.1", "4111 1111-1111 1111", "4111111111111112", "+1 (017) 555-7713", "+1", "..", "é", "@", "\n", "word", "%", "-", "12", "5555555555554444"]
    rows = [(k, "".join(rng.choice(parts) + rng.choice(["", " ", " "]) for _ in range(12))) for k in range(300)]
    rows += [(900, "a@b" + ".c" * 9000 + " " + "1 " * 9000 + "2" * 9000 + "z" * 90000), (901, None), (902, ""), (902, "+49 30 1234567 again")]
    # a pattern that mostly holds known addresses finds one the base pattern does not know
    rows += [(1000 + k, f"please write to user{k}@host{k}.org today") for k in range(12)] + [(1100, "please write to user77@intranet today")]
    found = pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    got = Counter((r.doc_id, tuple((s.start, s.kind, s.end) for s in r.base)) for r in found)
    assert got == Counter((i, tuple(plain_spans(t))) for i, t in rows)
    assert all(set(r.base) <= set(r.spans) and r.spans == sorted(r.spans, key=lambda s: (s.start, s.kind, s.end)) for r in found)
    digest = {r.doc_id: r for r in pii.digest(spark.createDataFrame(found, "doc_id long, base array<struct<start:int,kind:int,end:int>>, spans array<struct<start:int,kind:int,end:int>>")).collect()}
    assert digest[1000].base_sha256 == hashlib.sha256(b"email:16:31").hexdigest() and digest[1000].n_email == 1
    assert digest[901].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert pii.find(odd_docs).count() == odd_docs.count() and pii.find(no_docs).count() == 0


# --- language model --------------------------------------------------------------------


def test_base_scores_and_perplexity(spark, odd_docs, no_docs, monkeypatch):
    monkeypatch.setattr(lm, "CLASSES", 20)
    training = remainder("doc_id", 5) != 1
    rows = [(r.doc_id, (r.text or "").encode().lower().split()) for r in odd_docs.collect()]
    learned = Counter()
    for i, w in rows:
        if zlib.crc32(("" if i is None else str(i)).encode()) % 5 != 1:
            learned.update([*w, "end"])
    n, v = sum(learned.values()), len(learned)
    want = Counter()
    for i, w in rows:
        w = [*w, "end"]
        base = sum(math.log10((learned[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w)
        want[i, len(w), sum(learned[x] > 0 for x in w), n, round(base, 6)] += 1
    scores = []
    for top in (1 << 18, 40):  # frequent words in the tasks, and most words by the join
        monkeypatch.setattr(lm, "TOP", top)
        out = lm.score(odd_docs, training).collect()
        assert Counter((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in out) == want
        scores.append(sorted((repr(r.doc_id), r.n_tokens, r.score) for r in out))
    for one, two in zip(*scores, strict=True):  # the two ways add up a text's words in different orders
        assert one[:2] == two[:2] and math.isclose(one[2], two[2], rel_tol=1e-9)
    assert lm.score(no_docs, training).count() == 0
    assert all(abs(r.base_score) < 1e-9 for r in lm.score(odd_docs, F.lit(False)).collect())


def test_class_probabilities_sum_to_one():
    rng = np.random.default_rng(0)
    code = np.unique(rng.integers(0, 49, 60))
    n = rng.integers(1, 200, len(code))
    keys = [code // 7, code % 7]
    levels = lm.hierarchy(keys, n, 7)
    for _ in range(5):
        lm.sweep(levels, 1 / 7, rng)
        table = lm.predictive_table(keys, levels, 7).reshape(7, 7)
        assert np.allclose(table.sum(axis=1), 1) and (table > 0).all()
        assert all((level.tables >= 1).all() and (level.tables <= level.customers).all() for level in levels)


def test_tables_are_drawn_from_their_conditional():
    def partitions(n):
        if not n:
            yield []
            return
        for p in partitions(n - 1):
            yield from ([*p[:i], p[i] + 1, *p[i + 1 :]] for i in range(len(p)))
            yield [*p, 1]

    c, others, p0, d, draws = 5, 3, 0.3, 0.4, 40000
    want = np.zeros(c)
    for p in partitions(c):
        new = math.prod((lm.STRENGTH + d * (others + i)) * p0 for i in range(len(p)))
        want[len(p) - 1] += new * math.prod(j - d for size in p for j in range(1, size))
    got = lm.draw_tables(np.full(draws, c), np.full(draws, others), np.full(draws, p0), d, np.arange(draws).astype(np.uint64))
    assert np.abs(np.bincount(got, minlength=c + 1)[1:] / draws - want / want.sum()).max() < 0.01
    many = lm.draw_tables(np.array([1, 2, 100_000]), np.array([0, 5, 50]), np.array([0.5, 1e-9, 0.1]), d, np.arange(3).astype(np.uint64))
    assert many[0] == 1 and 1 <= many[1] <= 2 and 1 < many[2] < 100_000


def test_every_word_is_a_context(spark, monkeypatch):
    """However rare a word is, what follows it in training is likelier after it."""
    monkeypatch.setattr(lm, "CLASSES", 2)
    monkeypatch.setattr(lm, "TOP", 8)
    rows = [(i, " ".join(f"left{i} right{i}" if k % 2 else "the and" for k in range(4))) for i in range(30)]
    rows += [(1000 + i, f"left{i} right{i}") for i in range(30)] + [(2000 + i, f"left{i} right{(i + 1) % 30}") for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.score for r in lm.score(docs, F.col("doc_id") < 1000).collect()}
    assert all(got[1000 + i] > got[2000 + i] + 0.5 for i in range(30))
    _, _, words, root = lm.fit(docs.filter("doc_id < 1000"))
    assert math.isclose(sum(10**r.log_p for r in words.collect()) + root.p_new, 1)


def test_repeated_shingles_cost_little():
    rng = np.random.default_rng(1)
    t = substring.WORDS - substring.SHINGLE + 1
    a, b = (rng.integers(0, 500, 1000).astype(np.uint32) for _ in range(2))  # each shingle about twice in both
    b = np.concatenate([b[:400], a[300:420], b[400:]])
    substring.verified(a, b, t)
    began = time.process_time()
    found = substring.verified(a, b, t)
    assert time.process_time() - began < 0.5
    assert any(i <= 305 and j >= 415 and abs((i - k) - (300 - 400)) <= 30 for i, j, k, *_ in found)


def test_language_sample_holds_every_language(spark):
    rng = np.random.default_rng(3)
    word = lambda letters: "".join(rng.choice(list(letters), 4))
    text = lambda letters, n: " ".join(word(letters) for _ in range(n))
    one = text("abcdef", 40)
    rows = [(one, "xx")] * 5000 + [(text("uvwxyz", 40), "yy") for _ in range(50)] + [(None, "zz"), ("", "zz"), ("12", "zz"), (text("abc", 5), None)]
    table = spark.createDataFrame(rows, "text string, lang string").repartition(3)
    model = langid.fit(table)
    assert model.languages == ["xx", "yy"]
    told = {r.text: r.lang_pred for r in langid.predict(table.select("text").distinct(), model).collect() if r.text}
    assert told[one] == "xx" and all(told[t] == "yy" for t, k in rows[5000:5050])
    copies = langid.fit(table.filter("lang = 'xx'"))  # copies of one text only
    assert copies.languages == ["xx"]
    nothing = langid.fit(table.filter("lang = 'zz'"))
    assert nothing.languages == [] and {r.lang_pred for r in langid.predict(table, nothing).collect()} == {"und"}


def test_limits_of_lengths_that_the_sample_lacks(spark):
    rng = np.random.default_rng(4)
    text = lambda letters, n: " ".join("".join(rng.choice(list(letters), 4)) for _ in range(n))
    short = spark.createDataFrame([(text("abcdefgh", 4), "xx") for _ in range(400)], "text string, lang string")
    model = langid.fit(short)
    top = max(k for k in range(32) if k == 0 or model.limits[k] != model.limits[k - 1])
    assert all(model.limits[k] == model.limits[top] > 0 for k in range(top, 32))
    far = spark.createDataFrame([(text("uvwxyz", 400),), (text("abcdefgh", 400),)], "text string")
    assert [r.rejected for r in langid.predict(far, model).collect()] == [True, False]


def test_a_common_line_makes_no_candidates(spark):
    """Documents that share a line, but no passage, are not compared one by one; those that share a passage beside it are."""
    rng = np.random.default_rng(12)
    prose = lambda n: [f"w{k}" for k in rng.integers(0, 5000, n)]
    line = [f"line{k}" for k in range(13)]
    rows = [(i, " ".join(prose(60) + line + prose(60))) for i in range(80)]
    passage = prose(60)
    rows[40], rows[50] = (40, " ".join(prose(60) + line + passage)), (50, " ".join(prose(60) + line + passage))
    texts = spark.createDataFrame(rows, "doc_id long, text string")
    t = substring.WORDS - substring.SHINGLE + 1
    shared = substring._shared_windows(texts, t).filter("doc <> lo AND doc <> hi")
    line_only = shared.select("sig", "doc", "at", F.lit(0).cast("long").alias("lo"), F.lit(99).cast("long").alias("hi"))
    none = spark.createDataFrame([], substring.PASSAGE)
    assert line_only.select("doc").distinct().count() > 40
    assert {(r.doc, r.leader) for r in substring._others(texts, line_only, none, t).collect()} <= {(50, 40)}
    found = {(r.doc_id, r.other_id) for r in substring.repeated_passages(texts).collect()}
    assert found == {(50, 40)}


def test_similar_stretches_share_a_run():
    """The least run is there in random stretches that are similar enough."""
    assert [substring.least_run(t) for t in (4, 10, 46)] == [4, 9, 19]
    rng = np.random.default_rng(13)
    similar = 0
    for _ in range(3000):
        a = rng.integers(0, 1 << 30, int(rng.integers(50, 160)))
        b = a.copy()
        for _ in range(int(rng.integers(1, 7))):
            at = int(rng.integers(0, len(b)))
            b = [np.append(b[:at], b[at + 1 :]), np.insert(b, at, 1 << 31), np.concatenate([b[at:], b[:at]])][int(rng.integers(0, 3))]
        x, y = (np.array([hash(tuple(v[i : i + 5].tolist())) & (2**32 - 1) for i in range(len(v) - 4)], np.uint32) for v in (a, b))
        if min(len(x), len(y)) >= 46 and substring._similarity(x, y) >= substring.SIMILARITY:
            similar += 1
            assert substring._runs(x, y, np.argsort(y, kind="stable"))[2].max() >= 19
    assert similar > 200


def test_periodic_texts_are_compared_fast():
    """Two texts that repeat a line of 51 shingles, with words changed: every part was measured one by one before."""
    rng = np.random.default_rng(14)
    period = rng.integers(0, 1 << 30, 51).astype(np.uint32)
    other = period.copy()
    other[5:12] += 1
    other[30:37] += 1
    start = time.process_time()
    a, b = (np.append(np.tile(v, 60), np.full(60, k, np.uint32)) for v, k in ((period, 77), (other, 88)))
    assert substring.verified(a, b, 46) == [(3046, 3092, 3046, 3092, 0.875)]
    v = rng.integers(0, 9, 300).astype(np.uint32)
    hits = np.concatenate(([0], np.cumsum(v < 5)))
    p, g = np.array([0, 7, 7, 100]), np.array([40, 8, 300, 290])
    mine, hit = substring._distinct(v, hits, p, g)
    assert mine.tolist() == [len(set(v[i:j].tolist())) for i, j in zip(p, g)]
    assert hit.tolist() == [len({k for k in v[i:j].tolist() if k < 5}) for i, j in zip(p, g)]
    assert time.process_time() - start < 6
