"""Mixing, sharding, packing, training order and search against brute force and round trips."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stylograph.llm import bitslice, mixing, packing, sharding, tokens, training_order
from stylograph.llm.tokens import Encoder, tokenizer_path


def test_mix(docs, edge, empty):
    for df in (docs, edge):
        got = mixing.mix(df).select("_row.*", F.col("size").alias("n"), "source_size", F.col("target").alias("goal"), F.col("copies").alias("times")) if df is docs else None
        out = mixing.mix(df).collect()
        assert len(out) == df.count() and (got is None or got.count() == len(out))
        words, taken, goal, largest = defaultdict(int), defaultdict(int), {}, defaultdict(int)
        for r in out:
            s = r["_row"].source
            assert r["size"] == len((r["_row"].text or "").encode().split()) and 0 <= r.copies <= 3
            words[s] += r["size"]
            taken[s] += r["size"] * r.copies
            goal[s] = r.target
            largest[s] = max(largest[s], r["size"])
        order = sorted(words, key=lambda s: (s is None, s or ""))
        weight = {s: 1 + i % 3 for i, s in enumerate(order)}
        total = sum(words.values())
        # sharing again, round by round
        want, free, left = {}, set(order), total
        while free:
            share = {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
            full = {s for s in free if share[s] > 3 * words[s]}
            if not full:
                want.update(share)
                break
            for s in full:
                want[s] = 3.0 * words[s]
            left -= sum(want[s] for s in full)
            free -= full
        for s in order:
            assert goal[s] == pytest.approx(want[s]) and abs(taken[s] - goal[s]) <= largest[s]
    assert mixing.mix(empty).count() == 0
    again = Counter((r["_row"].doc_id, r.copies) for r in mixing.mix(docs).collect())
    assert again == Counter((r["_row"].doc_id, r.copies) for r in mixing.mix(docs.repartition(5)).collect())
    emitted = mixing.emitted(edge)
    assert emitted.columns == edge.columns


def test_shards(spark, docs, edge, empty):
    hot = docs.unionByName(spark.range(120).select((F.col("id") + 10_000).alias("doc_id"), F.lit("one text " * 300).alias("text"), F.lit("a").alias("source")))
    for df in (docs, hot, edge):
        out = sharding.shard_documents(df).collect()
        assert len(out) == df.count()
        sizes, slots = Counter(), defaultdict(list)
        for r in out:
            raw = (r.text or "").encode()
            assert r["size"] == len(raw) + 1 and r.text_crc32 == zlib.crc32(raw)
            sizes[r.shard] += r["size"]
            slots[r.shard].append(r.slot)
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())
        most = max(r["size"] for r in out)
        mean = sum(sizes.values()) / 8
        assert all(abs(sizes[i] - mean) <= most + 0.01 * mean for i in range(8))
    groups = defaultdict(set)
    for r in sharding.shard_documents(docs).collect():
        groups[r.text].add(r.shard)
    assert sum(len(s) > 1 for s in groups.values()) <= 7
    assert sharding.shard_documents(empty).count() == 0


def test_splitters_cut_heavy_keys_only():
    sample = [(i, 5) for i in range(100)] + [(50, t) for t in range(100)]
    found = sharding.splitters_from(sample, 10)
    assert [t for k, t in found if k != 50] == [-(2**63)] * sum(k != 50 for k, _ in found) and sum(k == 50 for k, _ in found) >= 3
    assert sharding.splitters_from([], 10) == []


@given(st.lists(st.integers(1, 64), min_size=1, max_size=200))
@settings(max_examples=60, deadline=None)
def test_best_fit_takes_the_tightest_open_sequence(lengths):
    lengths = np.array(lengths)
    sequence, offset = packing.best_fit_decreasing(lengths, 64)
    rooms, used = [], Counter()
    for n in sorted(lengths.tolist(), reverse=True):
        fitting = [i for i, r in enumerate(rooms) if r >= n]
        if fitting:
            i = min(fitting, key=lambda i: rooms[i])
            rooms[i] -= n
        else:
            rooms.append(64 - n)
    ends = defaultdict(list)
    for s, o, n in zip(sequence, offset, lengths):
        ends[s].append((o, n))
        used[s] += n
    assert sorted(64 - u for u in used.values()) == sorted(rooms)
    for items in ends.values():
        at = 0
        for o, n in sorted(items):
            assert o == at
            at += n


def encoded(text):
    return Encoder.of(tokenizer_path()).direct(text or "") + b"\0\0"


def test_pack(docs, edge, empty):
    for df in (docs, edge):
        ids = Counter()
        for r in df.collect():
            raw = np.frombuffer(encoded(r.text), "<u2").astype("<u4")
            for p in range(math.ceil(len(raw) / 2_048)):
                cut = raw[2_048 * p : 2_048 * (p + 1)]
                ids[r.doc_id, p, 2_048 * p, len(cut), zlib.crc32(cut.tobytes())] += 1
        out = packing.pack(df).collect()
        assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out) == ids
        fill = defaultdict(list)
        for r in out:
            fill[r.sequence_id].append((r.offset, r.length))
        for items in fill.values():
            at = 0
            for o, n in sorted(items):
                assert o == at
                at += n
            assert at <= 2_048
        total = sum(r.length for r in out)
        assert len(fill) <= math.ceil(total / 2_048) + 2
    assert packing.pack(empty).count() == 0
    blocks = packing.pack(docs, block=40)
    assert blocks.groupBy("sequence_id").agg(F.sum("length").alias("n")).filter("n > 2048").count() == 0


@given(st.lists(st.text(max_size=40), max_size=20))
@settings(max_examples=60, deadline=None)
def test_remembered_ids_equal_the_tokenizer(texts):
    e = Encoder.of(tokenizer_path())
    texts = texts + ["it's we'll 12½ ²³ ... a!!b", "İ ΑΣΣ", "x\x1cy", "<|endoftext|> hi", "Straße ŉ ǅ"]
    assert e.encode(texts) == [e.direct(t) for t in texts]


def test_common_chunks_need_no_pattern(monkeypatch):
    plain = [chr(c) for c in range(0x21, 0x250) if not tokens.careful(chr(c))]
    chunks = [w + c for w in ("word", "é", "it's", "") for c in plain] + ["we'll", "12½", "a!!b", "don't,"]
    chunks = [c for x in chunks for c in x.lower().split()]
    assert [list(tokens.cut_chunk(c)) for c in chunks] == [tokens.PIECE.findall(c) for c in chunks]
    monkeypatch.setattr(tokens, "PIECE", None)
    # a tokenizer of its own: nothing is remembered
    assert Encoder(tokenizer_path()).encode(["one, two. three"])[0] + b"\0\0" == encoded("one, two. three")


def test_what_is_remembered_is_bounded(monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 3)
    e = Encoder(tokenizer_path())
    for texts in (["a b c d"], ["e, f g a", "h e,"], ["h e, \x01", "d"]):
        assert e.encode(texts) == [e.direct(t) for t in texts]
    assert set(e.chunks) == {"a", "b", "c", "d"}


@pytest.mark.parametrize("n", [1, 2, 3, 17, 1_000, 4_097])
def test_permutation(n):
    slots = training_order.permuted(np.arange(n), n, 9)
    assert sorted(slots.tolist()) == list(range(n))
    assert n < 17 or (slots != training_order.permuted(np.arange(n), n, 10)).any()


def test_training_order_round_trip(spark, docs, edge, empty, tmp_path):
    for name, df in (("docs", docs), ("edge", edge)):
        folder = str(tmp_path / name)
        n = training_order.write_shards(df, folder, length=64, per_shard=500)
        out = training_order.read_from(spark, folder, length=64, per_shard=500, ids=True).collect()
        assert sorted(r.slot for r in out) == list(range(n)) and all(r.byte_offset == r.slot % 500 * training_order.stride(64) for r in out)
        back = Counter((r.doc_id, r.start, tuple(r.ids)) for r in out)
        want = Counter()
        for r in df.collect():
            raw = np.frombuffer(encoded(r.text), "<u2")
            want.update((r.doc_id, i, tuple(raw[i : i + 64].tolist())) for i in range(0, len(raw), 64))
        assert back == want
        at = n // 2
        rest = training_order.read_from(spark, folder, slot=at, length=64, per_shard=500).collect()
        assert sorted(r.slot for r in rest) == list(range(at, n))
    assert training_order.write_shards(empty, str(tmp_path / "none")) == 0


def brute_force(vectors, k):
    ints = {i: np.floor(256.0 * np.array(x, float)).astype(np.int64) for i, x in vectors.items()}
    out = []
    for q in (i for i in ints if i % 50 == 0):
        found = []
        for i, x in ints.items():
            if i != q:
                m = min(len(x), len(ints[q]))
                found.append((-int(x[:m] @ ints[q][:m]), i))
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(sorted(found)[:k])]
    return sorted(out)


@pytest.mark.parametrize("spread", [0.1, 3.0])
def test_search(spark, spread):
    rng = np.random.default_rng(2)
    vectors = {i: rng.normal(0, spread, 24).tolist() for i in range(300)}
    for i in range(60, 160):
        vectors[i] = vectors[60]  # ties
    vectors[7] = [0.0] * 24
    vectors[8] = [1.5] * 5
    bad = [(900, None), (950, [float("nan")] * 24), (1000, [1.0, float("inf")]), (1050, [1.0, None]), (None, [1.0] * 24)]
    rows = [*vectors.items(), (11, vectors[11]), *bad]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("x", F.lit(1)).repartition(4)
    got = sorted(map(tuple, bitslice.search(df, F.col("vec_id") % 50 == 0, rows=64, at_once=4).collect()))
    assert got == brute_force(vectors, 5)
    few = df.filter("vec_id in (0, 1, 2)")
    assert sorted(map(tuple, bitslice.search(few, F.col("vec_id") % 50 == 0).collect())) == brute_force({i: vectors[i] for i in (0, 1, 2)}, 5)
    assert bitslice.search(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


@given(st.integers(1, 6), st.integers(1, 5), st.integers(0, 1000))
@settings(max_examples=40, deadline=None)
def test_bitmap_sums(bits, dims, seed):
    rng = np.random.default_rng(seed)
    rows, queries = 100, 3
    values = rng.integers(0, 1 << bits, (dims, 128))
    weights = rng.integers(-9, 10, (queries, dims))
    slices = np.stack([np.packbits(((values >> j) & 1).astype(np.uint8), axis=1, bitorder="little").view(np.uint64) for j in range(bits)])
    total = bitslice.add_up(slices, weights)
    planes = np.unpackbits(total.view(np.uint8), axis=2, bitorder="little").astype(np.int64)
    sums = (planes << np.arange(len(total))[:, None, None]).sum(axis=0)
    turned = np.where(weights[:, :, None] < 0, (1 << bits) - 1 - values[None], values[None])
    want = (np.abs(weights)[:, :, None] * turned).sum(axis=1)
    assert (sums == want).all()
    valid = np.zeros(128, np.uint8)
    valid[:rows] = 1
    candidates = np.repeat(np.packbits(valid, bitorder="little").view(np.uint64)[None], queries, axis=0)
    kth = bitslice.select(total, candidates, 5)
    assert (kth == np.sort(want[:, :rows], axis=1)[:, -5]).all()
    reached = np.unpackbits(bitslice.at_least(total, candidates, kth).view(np.uint8), axis=1, bitorder="little").astype(bool)
    assert (reached[:, :rows] == (want[:, :rows] >= kth[:, None])).all()
