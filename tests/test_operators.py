"""Skew-safe helpers, samples, splits, metrics and runs against plain Python."""

import hashlib
import json
import math
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from stylograph.functions import patterns as P
from stylograph.functions.hashing import seeded_digest
from stylograph.operators import clean, compare, curate, evaluate, grams, packed, runs, skew, tfidf, tokens
from stylograph.operators.quantiles import quantiles_of_counts, quantiles_of_wide
from stylograph.sources import tables


def md5(s):
    return hashlib.md5(s.encode()).hexdigest()


@pytest.fixture(scope="module")
def rows(spark):
    """3,000 rows; one prompt and one family hold a third of them."""
    data = []
    for i in range(3000):
        family = "GPT" if i % 3 == 0 else P.FAMILIES[i % 8]
        data.append((i, "hot" if i % 3 == 1 else f"p{i // 2}", family, f"text {i % 50}"))
    return spark.createDataFrame(data, "row_id long, prompt_id string, family string, output string").cache()


def test_lookup_of_hot_and_cold_keys(spark, rows):
    totals = rows.groupBy("prompt_id").agg(F.count("*").alias("n"), F.max("row_id").alias("top"))
    got = skew.lookup_by_key(rows, totals, "prompt_id", "n", "row_id", hot_keys=1).collect()
    want = {r.prompt_id: (r.n, r.top) for r in totals.collect()}
    assert len(got) == 3000 and all((r.n, r.top) == want[r.prompt_id] for r in got)


def test_lookup_by_two_keys(spark, rows):
    keys = ["prompt_id", "family"]
    some = rows.withColumn("family", F.when(F.col("row_id") % 7 > 0, F.col("family")))
    totals = some.groupBy(*keys).agg(F.count("*").alias("n"), F.max("row_id").alias("top"))
    got = skew.lookup_by_key(some, totals, keys, "n", "row_id", hot_keys=2).collect()
    want = {(r.prompt_id, r.family): (r.n, r.top) for r in totals.collect()}
    # keys with a null in them find nothing
    assert len(got) == 3000
    assert all((r.n, r.top) == (want[r.prompt_id, r.family] if r.family else (None, None)) for r in got)


def test_bitmap_misses_no_key(spark, rows):
    wanted = rows.filter("row_id % 10 = 0").select("prompt_id").distinct()
    keys = {r.prompt_id for r in wanted.collect()}
    got = skew.flag_held(rows, "prompt_id", wanted, "held").collect()
    assert len(got) == 3000 and all(r.held for r in got if r.prompt_id in keys)
    assert sum(r.held for r in got if r.prompt_id not in keys) < 10
    assert not any(r.held for r in skew.flag_held(rows, "prompt_id", wanted.limit(0), "held").collect())


def test_char_counts_from_longest_grams(spark):
    texts = ["", "a", "ab", "abc", "abca", "abcab", "ab  ab\n\nab", "😀b😀bc", "aaaaaaaa", "x\ny", "abcabcabc" * 30, None]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    uses, rows_ = Counter(), Counter()
    for t in texts:
        flat = re.sub(r"\s\s+", " ", t or "")
        grams = [flat[i : i + n] for n in range(2, 6) for i in range(len(flat) - n + 1)]
        uses.update(grams)
        rows_.update(set(grams))
    got = {r.term: (r.df, r.total) for r in tfidf._counts(df, "text", tfidf.CHARS).collect()}
    assert got == {g: (rows_[g], uses[g]) for g in uses}
    listed = tfidf.with_terms(df, "text", tfidf.CHARS, "grams").select(F.explode("grams").alias("g")).collect()
    assert Counter(r.g for r in listed) == uses


def test_salt_stays_in_the_join(spark, rows):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        totals = rows.groupBy("prompt_id").agg(F.count("*").alias("n"))
        plan = skew.lookup_by_key(rows, totals, "prompt_id", "n", "row_id")._jdf.queryExecution().toString()
        joins = [x for x in plan.splitlines() if "SortMergeJoin" in x]
        assert joins and all("_salt" in j.split("LeftOuter")[0] for j in joins)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_matched_pair_counts_families(rows):
    got = clean.matched_pair(rows, "row_id")
    families = defaultdict(set)
    for r in rows.collect():
        families[r.prompt_id].add(r.family)
    assert {(r.row_id, r.matched_pair) for r in got.collect()} == {
        (r.row_id, len(families[r.prompt_id]) == 2) for r in rows.collect()
    }


def test_balanced_sample_takes_the_lowest_digests(rows):
    got = curate.balanced_sample(rows, cap=100, seed=5, key=["row_id"]).collect()
    by = defaultdict(list)
    for r in rows.collect():
        by[r.family].append((md5(f"5|{r.row_id}"), r.row_id))
    n = min(100, min(map(len, by.values())))
    want = {i for v in by.values() for _, i in sorted(v)[:n]}
    assert {r.row_id for r in got} == want and len(got) == n * len(by)


def test_balanced_sample_minimum_and_whole_classes(rows):
    sizes = Counter(r.family for r in rows.collect())
    minimum = sorted(sizes.values())[-2]
    got = Counter(r.family for r in curate.balanced_sample(rows, 10**9, key=["row_id"], minimum=minimum).collect())
    kept = {f for f, n in sizes.items() if n >= minimum}
    assert set(got) == kept and set(got.values()) == {min(sizes[f] for f in kept)}


def test_size_matched_sample_may_fall_short(spark, rows):
    size = spark.createDataFrame([(2000,)], "n long")
    got = Counter(r.family for r in compare.size_matched_sample(rows, size, 1, ["row_id"]).collect())
    sizes = Counter(r.family for r in rows.collect())
    assert got == {f: min(n, 2000 // len(sizes)) for f, n in sizes.items()}


def test_dense_index_numbers_every_row_once(rows):
    numbered = skew.dense_index(rows.withColumn("_d", seeded_digest(3, "row_id")), "_d", "row_id", "place").collect()
    order = sorted(range(3000), key=lambda i: md5(f"3|{i}"))
    assert [r.row_id for r in sorted(numbered, key=lambda r: r.place)] == order


def test_quantiles(spark):
    rng = np.random.default_rng(0)
    wide = [int(x) for x in rng.integers(0, 10**15, 997)] + [7] * 500
    df = spark.createDataFrame([("a", v) for v in wide] + [("b", 3)], "g string, v long")
    got = {(r.g, r.prob): r["quantile"] for r in quantiles_of_wide(df, "v", [0.0, 0.25, 0.5, 1.0], "g", 10**12).collect()}
    for p in (0.0, 0.25, 0.5, 1.0):
        assert got["a", p] == pytest.approx(np.quantile(wide, p)) and got["b", p] == 3
    few = [int(x) for x in rng.integers(0, 40, 1001)]
    small = spark.createDataFrame([(v,) for v in few], "v long")
    assert quantiles_of_counts(small, "v", [0.25, 0.5, 0.75]).first()[0] == pytest.approx(list(np.quantile(few, [0.25, 0.5, 0.75])))


def test_dedup_keeps_the_first(spark):
    data = [(i, "same" if i % 3 else f"t{i}", "m") for i in range(300)]
    df = spark.createDataFrame(data, "id long, t string, m string")
    got = curate.dedup_exact(df, ["t", "m"], ["id"]).collect()
    assert sorted(r.id for r in got) == sorted([1, *range(0, 300, 3)])


def test_splits_share_no_prompt(rows):
    split = clean.assign_split(rows)
    clean.assert_no_group_leak(split)
    share = {r.split: r.n / 3000 for r in clean.split_sizes(split.filter("prompt_id != 'hot'")).collect()}
    assert share["train"] == pytest.approx(0.7 * 2 / 3, abs=0.05)
    with pytest.raises(ValueError):
        clean.assert_no_group_leak(rows.withColumn("split", F.col("family")))


def test_holdout_parts_are_disjoint(rows):
    df = rows.withColumn("domain", F.when(F.col("row_id") % 2 == 0, "code").otherwise("math"))
    parts = {k: {r.row_id for r in v.collect()} for k, v in compare.domain_holdout(df, "code", 0).items()}
    assert sum(map(len, parts.values())) == 3000 == len(set().union(*parts.values()))


def test_metrics_by_hand(spark):
    data = [("r", "GPT", "GPT"), ("r", "GPT", "Qwen"), ("r", "Qwen", "Qwen"), ("r", "Grok", "Qwen")]
    preds = spark.createDataFrame(data, "run string, true string, pred string")
    labels = ["GPT", "Qwen", "Grok", "Llama"]
    matrix = evaluate.confusion(preds, labels, ["run"])
    assert matrix.count() == 16 and matrix.agg(F.sum("n")).first()[0] == 4
    assert evaluate.macro_f1(matrix, ["run"]).first().macro_f1 == pytest.approx((2 / 3 + 0.5) / 4)
    assert evaluate.macro_f1(matrix, ["run"], seen_only=True).first().macro_f1 == pytest.approx((2 / 3 + 0.5) / 3)
    got = {(r.metric, r["class"]): r.value for r in evaluate.metrics(preds, labels, ["run"]).collect()}
    assert got["accuracy", None] == 0.5 and got["n", None] == 4
    assert [got["recall", x] for x in labels] == [0.5, 1.0, 0.0, 0.0]


def test_proportion_test(spark):
    df = spark.createDataFrame([(0.55, 400), (0.5, 400)], "accuracy double, n long")
    got = [r.p_value for r in compare.proportion_test(df, 0.5).orderBy("accuracy").collect()]
    assert got == pytest.approx([1.0, math.erfc(2 / math.sqrt(2))], abs=1e-6)


def test_vocabulary_and_encoding(spark):
    df = spark.createDataFrame([(1, "b b a a c", "q"), (2, "", ""), (3, "b zz a", "b")], "row_id long, output string, input string")
    vocab = tokens.build_vocab(df, "output", "word", 3, 2)
    assert [(r.token, r.id) for r in vocab.orderBy("id").collect()] == [("a", 3), ("b", 4)]

    def ids(mode, n):
        got = tokens.encode_fields(df, "row_id", vocab, "word", mode, n).orderBy("row_id").collect()
        return [r.ids for r in got]

    assert ids("output", 4) == [[4, 4, 3, 3], [1], [4, 1, 3]]
    assert ids("both", 4) == [[1, 2, 4, 4], [2], [4, 2, 4, 1]]
    plain = tokens.encode_tokens(df, "row_id", F.split("output", " "), vocab, 2).orderBy("row_id").collect()
    assert [r.ids for r in plain] == [[4, 4], [1], [4, 1]]


def test_tfidf_against_arithmetic(spark):
    docs = ["a b a", "b c", "a c c c d", "b"]
    df = spark.createDataFrame(list(enumerate(docs)), "row_id int, t string")
    block = tfidf.Block("word", (1, 1), 3, 2)
    got = {(r.row_id, r.term): r.weight for r in tfidf.tfidf(df, "row_id", "t", (block,), F.col("row_id") < 3).collect()}
    train = [Counter(d.split()) for d in docs[:3]]
    idf = {t: math.log(4 / (1 + sum(t in d for d in train))) + 1 for t in "abc"}
    want = {}
    for i, d in enumerate(docs):
        w = {t: (1 + math.log(n)) * idf[t] for t, n in Counter(d.split()).items() if t in idf}
        length = math.sqrt(sum(x * x for x in w.values()))
        want.update({(i, t): x / length for t, x in w.items()})
    assert got == pytest.approx(want)


def test_fingerprint_ignores_order_and_sees_changes(spark, rows):
    def of(df):
        return runs.dataset_fingerprint(df, ["family", "output"]).first().fingerprint

    assert of(rows) == of(rows.orderBy(F.desc("row_id")).repartition(3))
    assert of(rows) != of(rows.filter("row_id > 0"))
    assert of(rows) != of(rows.withColumn("output", F.concat("output", F.lit(" "))))


def test_battles_from_json_lines(spark):
    battle = {
        "id": "b1", "language": None, "model_a": "gpt-4.1", "model_b": "claude-3",
        "conversation_a": [{"role": "user", "content": "q"}, {"role": "assistant", "content": [{"type": "text", "text": "x"}, {"text": "y"}]}],
        "conversation_b": [{"role": "user", "content": "[not parts"}, {"role": "assistant", "content": "z"}],
        "category_tag": {"math_v0.1": {"math": True}}, "is_code": None, "timestamp": "2025-05-01T10:00:00",
    }
    raw = spark.createDataFrame([(json.dumps(battle),)], "value string")
    sides = curate.single_turn_pair(curate.label_families(curate.unpivot_sides(tables.battles_from_raw_json(raw))))
    got = {r.side: (r.family, r.input, r.output, r.math) for r in sides.collect()}
    assert got == {"a": ("GPT", "q", "xy", True), "b": ("Claude", "[not parts", "z", True)}


def test_turn_rows_to_pairs(spark):
    data = [(1, 5, "user", " q "), (1, 9, "assistant", "a"), (2, 0, "assistant", "a"), (2, 1, "user", "q"), (3, 0, "user", "x")]
    turns = spark.createDataFrame(data + [(4, i, "user", "t") for i in range(500)], "c long, turn int, role string, text string")
    assert [tuple(r) for r in curate.turns_to_conversations(turns, "c", "turn").collect()] == [(1, "q", "a")]


def test_narrow_operators_run_on_streams(spark, tmp_path):
    """Cleaning and splitting need no change for a streaming table."""
    rows = spark.createDataFrame(
        [("p1", "gpt-4.1", "GPT", "ask ChatGPT", "<think>x</think>I'm sorry, but OpenAI says no.")],
        "prompt_id string, model string, family string, input string, output string",
    )
    rows.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    out = clean.assign_split(clean.clean_texts(stream))
    q = out.writeStream.format("memory").queryName("cleaned").option("checkpointLocation", str(tmp_path / "cp")).start()
    q.processAllAvailable()
    q.stop()
    got = spark.table("cleaned").first()
    assert (got.output, got.input, got.refusal, got.self_id) == ("I'm sorry, but [MODEL] says no.", "ask [MODEL]", True, True)


@pytest.mark.parametrize("most, cells", [(1 << 62, 1 << 22), (1, 0)])
def test_char_grams_are_counted_and_found_in_arrays(monkeypatch, most, cells):
    """Also where keys are numbered anew at every size, and where beginnings are searched."""
    monkeypatch.setattr(grams, "MOST", most)
    monkeypatch.setattr(grams, "CELLS", cells)
    texts = ["aXa🚀a🚀a", "", "é", "aXa\0b\0", "漢字 漢字 " * 40, *["a" * i for i in range(9)]]
    held = [Counter(t[i : i + n] for n in range(2, 6) for i in range(len(t) - n + 1)) for t in texts]
    rows, uses = Counter(g for c in held for g in c), sum(held, Counter())
    got = {g: (a, b) for some in grams.count(texts, (2, 5)) for g, a, b in zip(some[0], some[1].tolist(), some[2].tolist())}
    assert got == {g: (rows[g], uses[g]) for g in uses}
    terms = sorted(uses)[::3]
    found = zip(*(x.tolist() for x in grams.Finder(terms).counts(texts)))
    assert list(found) == [(i, k, c[t]) for i, c in enumerate(held) for k, t in enumerate(terms) if c[t]]


def test_char_counts_send_a_stretch_once(spark):
    """Copies of a text in a stretch are one row a gram before the shuffle; they were a row a use."""
    df = spark.range(2000, numPartitions=1).select(F.lit("no end of words").alias("text"))
    counted = tfidf._counts(df, "text", tfidf.CHARS)
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "Generate" not in plan
    assert {(r.df, r.total) for r in counted.filter("length(term) = 5").collect()} == {(2000, 2000)}


def test_word_grams_are_counted_and_found_in_arrays():
    """As lists of tokens: words were told apart in the JVM, a row for every use."""
    lists = [["a", "b", "a", "b"], [], None, ["🚀"], ["b", "a"], ["c", "a", "b"]]
    held = [Counter(" ".join(t[i : i + n]) for n in (1, 2) for i in range(len(t) - n + 1)) for t in (x or [] for x in lists)]
    rows, uses = Counter(g for c in held for g in c), sum(held, Counter())
    tokens = pa.array(lists, pa.list_(pa.string()))
    counted = grams.count_words(tokens, (1, 2))
    got = {g: (a, b) for terms, *some in counted for g, a, b in zip(terms.to_pylist(), *(x.tolist() for x in some))}
    assert got == {g: (rows[g], uses[g]) for g in uses}
    terms = sorted(uses)[::2]
    found = zip(*(x.tolist() for x in grams.WordFinder(terms).counts(tokens)))
    assert list(found) == [(i, k, c[t]) for i, c in enumerate(held) for k, t in enumerate(terms) if c[t]]


def test_found_terms_go_on_stretch_by_stretch(monkeypatch):
    """What is found in a batch of rows came back as one batch, however much it was."""
    monkeypatch.setattr(tfidf, "FOUND", 40)
    texts = ["x" * 25, None, "y" * 25, "", "z" * 100, "a"]
    columns = {"_base_char": pa.array(texts), "_base_word": pa.array([[t] if t else None for t in texts], pa.list_(pa.string()))}
    parts = list(tfidf._in_stretches(pa.record_batch(columns), ["word", "char"]))
    assert [part.num_rows for part, _ in parts] == [3, 2, 1]
    assert [t for _, (_, chars) in parts for t in chars] == [t or "" for t in texts]


def test_blocks_are_written_and_read_as_they_are():
    rng = np.random.default_rng(1)
    for most in (3, 70_000):
        dense = rng.integers(0, 2, (6, 9)) * rng.integers(1, most, (6, 9))
        segment, index = np.nonzero(dense)
        cuts, uses, idf = packed.cuts_of(segment, 6), dense[segment, index], rng.random(9) + 1
        (block,) = packed.decoded(packed.encoded(np.array([0.0, 2.0, 1.0]), cuts, index, uses, idf))
        assert (block["index"] == index).all() and (block["uses"] == uses).all() and (block["cuts"] == cuts).all()
        terms = np.repeat(block["terms"], np.diff(block["starts"], append=len(index)))
        again = np.zeros_like(dense)
        again[block["segments"], terms] = block["uses_by_term"]
        assert (again == dense).all()
        values = np.where(dense > 0, 1 + np.log(np.maximum(dense, 1)), 0) * idf
        values /= np.maximum(np.linalg.norm(values, axis=1), 1e-9)[:, None]
        weights, intercepts = rng.standard_normal((9, 4)), rng.standard_normal(4)
        want = intercepts + (values @ weights)[:3] + (values @ weights)[3:]
        assert np.allclose(packed.margins(cuts, index, uses, idf, weights, intercepts, 3), want)
        sums = packed._Sums(9, 4, True)
        sums.add(block, (idf[:, None] * weights).astype(np.float32), intercepts)
        shares = np.exp(want) / np.exp(want).sum(axis=1)[:, None]
        off = shares - np.eye(4)[[0, 2, 1]]
        assert np.allclose(sums.terms * idf[:, None], values[:3].T @ off + values[3:].T @ off, atol=1e-5)
        assert np.isclose(sums.loss, -np.log(shares[[0, 1, 2], [0, 2, 1]]).sum(), atol=1e-5) and np.allclose(sums.intercepts, off.sum(axis=0), atol=1e-5)
        assert np.allclose(sums.squares * idf**2, (values**2).sum(axis=0), atol=1e-5)
