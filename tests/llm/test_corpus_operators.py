"""Phrase mining, the filter audit and decontamination against brute force and on edges."""

import hashlib
import random
import re
from collections import Counter
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from stylograph.llm import bitmaps, filter_audit, phrases, winnowing

SPACE = re.compile("[^\x20\x09-\x0d]+")


def low(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


# ---- phrases ---------------------------------------------------------------------------------


def mined(rows, least, top=2_000):
    """(lang, rank, phrase, a, l, r, n, score) by counting every run of words."""
    f, n = {}, Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", low(text)):
            words = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(words)
            for i in range(len(words)):
                for m in range(1, min(5, len(words) - i) + 1):
                    f.setdefault(lang, Counter())[tuple(words[i : i + m])] += 1
    out = []
    for lang, counts in f.items():
        often = {p: c for p, c in counts.items() if c >= least}
        found = []
        for p, a in often.items():
            if len(p) < 2 or any(
                len(q) > len(p) and c >= a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1)) for q, c in often.items()
            ):
                continue
            score, k = min((1000 * a * n[lang] // (often[p[:k]] * often[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), often[p[:k]], often[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def corpus():
    rng = random.Random(9)
    vocabulary = ["the", "of", "New", "York", "Éa", "😀", "x", "yy", "zz q", "W"] + [f"r{i}" for i in range(300)]
    weights = [30, 20, 10, 10, 5, 5, 5, 5, 3, 3] + [0.2] * 300
    rows = []
    for i in range(240):
        words = rng.choices(vocabulary, weights, k=rng.randint(0, 90))
        if i % 3 == 0:
            words[5:5] = "to be or not to be".split()
        if i % 4 == 0:
            words[9:9] = ["the", "of"] + rng.choices(vocabulary, k=3)
        text = " ".join(w + rng.choice(["", "", "", "", ".", ",", "\n", "\t", "  "]) for w in words)
        rows.append((text, rng.choice(["en", "en", "de", None])))
    return rows + [(None, "en"), ("", None), (" .,\n", "xx"), ("one two one two one two one two", "xx")] + [("a b c d e f g", "fr")] * 12


@pytest.mark.parametrize("options", [{}, {"heaviest": 0, "chunk": 50}, {"heaviest": 5, "chunk": 100_000}])
def test_phrases_equal_brute_force(spark, options):
    rows = corpus()
    frame = spark.createDataFrame(rows, "text string, lang string").withColumn("n", F.lit("clash")).withColumn("phrase", F.lit(1))
    got = phrases.collocations(frame.repartition(5), least=8, **options)
    assert sorted(map(tuple, got.collect())) == mined(rows, 8)


def test_phrases_top_and_ties(spark):
    rows = corpus()
    got = phrases.collocations(spark.createDataFrame(rows, "text string, lang string"), least=8, top=3)
    assert sorted(map(tuple, got.collect())) == mined(rows, 8, 3)


def test_phrases_of_nothing(spark):
    empty = spark.createDataFrame([], "text string, lang string")
    assert phrases.collocations(empty).count() == 0
    nulls = spark.createDataFrame([(None, None), ("", "en")], "text string, lang string")
    assert phrases.collocations(nulls, least=1).count() == 0


def test_phrase_scores_beyond_64_bits(spark):
    big = 10**15
    found = spark.createDataFrame([("en", "a", 1, big), ("en", "b", 1, big - 1), ("en", "a b", 2, big - 7)], "lang string, phrase string, words int, n long")
    totals = spark.createDataFrame([("en", 10**17 - 1)], "lang string, n long")
    row = phrases.scored(found, totals).first()
    assert row.score == 1000 * (big - 7) * (10**17 - 1) // (big * (big - 1))


def test_quicksort_counts_groups():
    rng = np.random.default_rng(3)
    words = rng.integers(0, 4, (500, 3))
    words[rng.random(500) < 0.2, 2] = -1
    n = rng.integers(1, 4, 500)
    want = Counter()
    for row, k in zip(words.tolist(), n.tolist()):
        for depth in (1, 2, 3):
            if -1 not in row[:depth]:
                want[tuple(row[:depth])] += k
    got = {tuple(words[at, :depth].tolist()): total for at, depth, total in phrases.quicksorted(words, n, 20)}
    assert got == {k: v for k, v in want.items() if v >= 20}


def test_hashes_are_those_of_spark(spark):
    s = phrases.Stretch("en", phrases.words_of("Éa b, c \U0001f600".encode()))
    words = [w for w in s.words if w != phrases.MARK]
    want = [r[0] for r in spark.createDataFrame([(w.decode(),) for w in words], "w string").select(F.xxhash64(F.lit("en"), "w")).collect()]
    assert s.hashes(words).view(np.int64).tolist() == want


def test_bitmaps_lose_nothing(spark):
    rng = np.random.default_rng(4)
    kept, others = rng.integers(-(2**63), 2**63, (2, 3_000))
    bitmap = bitmaps.build(spark.createDataFrame([(int(x),) for x in kept], "h long"), "h")
    assert bitmaps.holds(bitmap, kept.view(np.uint64)).all()
    assert bitmaps.holds(bitmap, others.view(np.uint64)).mean() < 0.02


# ---- filter audit ----------------------------------------------------------------------------


def audited(rows, labels):
    """Every row of the audit by applying the filters one after the other."""
    least, good, toxic = {}, set(), set()
    for doc_id, text, _ in rows:
        if doc_id is not None:
            least[text or ""] = min(least.get(text or "", doc_id), doc_id)
    for doc_id, quality, bad in labels:
        good |= {doc_id} if quality == 1 and doc_id is not None else set()
        toxic |= {doc_id} if bad == 1 and doc_id is not None else set()
    parts = {}
    for doc_id, text, source in rows:
        t = text or ""
        words = SPACE.findall(t)
        fails = {
            "A": len(words) < 50, "B": 100 * len(set(words)) < 65 * len(words), "C": 100 * len(re.findall("[A-Z]", t)) > 5 * len(t),
            "D": bool(re.search("[#$%&*|]", t)), "E": doc_id is not None and doc_id > least[t],
        }
        parts.setdefault(source or "", []).append((doc_id, {k for k, v in fails.items() if v}))
    out = {}
    for part, docs in parts.items():
        shapley = Counter()
        for order in permutations("ABCDE"):
            left = docs
            for step, x in enumerate(order, 1):
                gone = [d for d in left if x in d[1]]
                kept = [d for d in left if x not in d[1]]
                fail = sum(x in d[1] for d in docs)
                shapley[x] += len(gone)
                out[part, "".join(order), step] = [
                    len(kept), len(gone), fail - len(gone), sum(d[1] == {x} for d in docs), sum(d[0] in good for d in gone), sum(d[0] in toxic for d in gone)
                ]
                left = kept
        for order in permutations("ABCDE"):
            for step, x in enumerate(order, 1):
                out[part, "".join(order), step].append(shapley[x])
    return out


def audit_rows():
    rng = random.Random(2)
    rows = [(1, None, "a"), (2, "", "b"), (3, None, None), (None, "", "a"), (None, "own", ""), (4, "é" * 30 + " A", "a"), (4, "é" * 30 + " A", "a"), (4, "é" * 30 + " A", "b")]
    for i in range(60):
        words = [rng.choice(["alpha", "beta", "Gamma", "#", "x\x1cy", "z z"]) + str(rng.randint(0, 200)) for _ in range(rng.randint(30, 90))]
        rows.append((10 + i, " ".join(words), rng.choice("abc")))
    return rows + [(100 + i, rows[20 + i % 5][1], "c") for i in range(15)] + [(99, "word " * 20_000, "d")]


def test_audit_equals_brute_force(spark):
    rows = audit_rows()
    labels = [(i, i % 2, int(i % 7 == 0)) for i in range(0, 120, 3)] + [(4, 0, 0), (4, 1, 0), (None, 1, 1), (5, None, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("mask", F.lit("x")).withColumn("part", F.lit(1))
    got = filter_audit.audit(frame, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    assert {(r.part, r.filter_order, r.step): list(r[3:]) for r in got} == audited(rows, labels)
    assert len(got) == 5 * 600  # a, b, c, d and the empty part


def test_audit_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(docs, labels).count() == 0


def test_states_are_survivors():
    counts = np.random.default_rng(1).integers(0, 50, (4, 3, 32))
    cell = np.arange(32)
    want = np.stack([counts[..., cell & s == 0].sum(axis=-1) for s in range(32)], axis=-1)
    assert (filter_audit.states(counts) == want).all()


# ---- decontamination -------------------------------------------------------------------------

ITEM_WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def held(docs, items, span):
    """Per document n_words, n_hit and the items met, by looking for every window."""
    windows = {}
    for item, text in items:
        words = ITEM_WORD.findall(low(text))
        length = min(span, len(words))
        if item is not None and length:
            for i in range(len(words) - length + 1):
                windows.setdefault(tuple(words[i : i + length]), set()).add(str(item))
    out = []
    for doc_id, text in docs:
        words, hit, met = ITEM_WORD.findall(low(text)), set(), set()
        for length in {len(w) for w in windows}:
            for i in range(len(words) - length + 1):
                if (w := tuple(words[i : i + length])) in windows:
                    hit |= set(range(i, i + length))
                    met |= windows[w]
        out.append((doc_id, len(words), len(hit), sorted(met), bool(hit)))
    return out


def contamination_rows():
    rng = random.Random(6)
    vocabulary = [rng.choice(["é", "a", "B7", "ñ", "z"]) + str(i % 40) for i in range(60)]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, text(rng.choice([1, 2, 5, 9, 10, 11, 25, 40])) + rng.choice(["", ".", "_Q"])) for i in range(5, 60)]
    items = [x for x in items if len(x[1].split()) > 1] + [(70, None), (71, ""), (72, "-- !!"), (None, text(12)), (5, text(14)), (73, items[0][1])]
    docs = [(None, None), (1, ""), (2, "?!"), (3, text(4))]
    for i in range(80):
        parts = [text(rng.randint(0, 30))]
        for _ in range(rng.randint(0, 3)):
            words = (rng.choice(items)[1] or "").split()
            a = rng.randint(0, max(0, len(words) - 3))
            parts += [rng.choice([" ".join(words), " ".join(words[a:]), ", ".join(words).upper()]), text(rng.randint(0, 6))]
        docs.append((10 + i // 2, " ".join(parts)))  # ids occur twice
    return docs + [(200, text(60_000) + " " + items[3][1])], items


@pytest.mark.parametrize("span", [10, 4])
def test_decontamination_equals_brute_force(spark, span):
    docs, items = contamination_rows()
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumn("row", F.lit("x")).withColumn("n_hit", F.lit(1))
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("item", F.lit(0))
    got = winnowing.contaminated(frame, bench, span=span).collect()
    key = lambda r: (str(r[0]), *r[1:])
    assert sorted(map(tuple, got), key=key) == sorted(held(docs, items, span), key=key)


def test_decontamination_of_nothing(spark):
    docs = spark.createDataFrame([(1, "a b c"), (None, None)], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert winnowing.contaminated(docs.limit(0), items).count() == 0
    clean = winnowing.contaminated(docs, items.limit(0)).collect()
    assert sorted((r.n_words, r.n_hit, r["items"], r.contaminated) for r in clean) == [(0, 0, [], False), (3, 0, [], False)]
    assert [r.n_hit for r in winnowing.contaminated(docs.filter("doc_id = 1"), items).collect()] == [3]


def test_winnowing_keeps_few_and_misses_none():
    rng = np.random.default_rng(8)
    words = rng.integers(0, 2**63, 5_000).astype(np.uint64)
    ends = np.full(5_000, 5_000)
    place, fps = winnowing.winnowed(words, ends, 10)
    assert len(place) < 0.32 * len(words)
    for a in range(0, 4_900, 97):
        own = winnowing.winnowed(words[a : a + 10], np.full(10, 10), 10)[1]
        assert len(own) == 1 and own[0] in fps


def test_digest_of_items(spark):
    rows = winnowing.op13_decontaminate(spark, "/root/testdata/sf0.001").collect()
    assert any(r.n_items for r in rows)
    clean = next(r for r in rows if not r.n_items)
    assert clean.items_sha256 == hashlib.sha256(b"").hexdigest() and not clean.contaminated and clean.n_hit == 0
