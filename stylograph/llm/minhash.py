"""Near duplicates by a chosen-path set similarity join.

Documents with the same set of word shingles form a class.  Each class gets a MinHash signature, and independent
trees branch the classes: a node selects one place of the signature by its own hash, and the token
there decides the child.  The first levels are walked inside each row, as nodes near the root
are always large, the more levels the more classes there are.  Every node then links its classes to its smallest
one; links are confirmed on the full sets and joined into groups.  Nodes that hold several groups are looked at
again: the classes outside the node's largest group are compared with all classes of other groups if that is little
work, else the node branches on, twice, and what is left at the last level is compared however much it is.
Pairs inside a group need no further comparison, so a large group of near copies costs a link per member and tree,
not a pair.  A 128-bit sketch of the signatures rules out unlike pairs inside the join, before they become rows.

Enough trees are walked that a pair at the threshold meets in one with probability ``recall``, given that all of them
draw on one signature and that its nodes may branch as often as any do.

Nulls and empty texts have the empty set, which is linked with nothing.  Texts are read whole,
whatever their length.  Equal rows share a class; a null doc_id counts as larger than all others in its group.
An empty table gives no rows.  Extra columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..session import materialize
from . import common as C
from . import words as V
from .linking import components

WIDTH = 5  # words per shingle, unless a caller says otherwise
PERCENT = 80  # least similarity
RECALL = 0.9999
LEVELS = 3  # least number of levels walked before nodes are looked at
FEW, FANOUT = 1_000, 20  # a level more for every FANOUT times as many classes beyond FEW * FANOUT**2
DEEPER = 6  # levels that nodes branch on at most
ROUNDS = (4, 8, 12)  # members of a group that one outside it meets, round by round
WORK = 4_000_000  # comparisons in a node that need no branching
PLACES = 128  # tokens in a signature; a sketch has two bits of each
CERTAIN = 5.2  # standard deviations by which a sketch may miss its expectation

RNG = np.random.default_rng(448)
FLIPS = RNG.integers(0, 2**63, PLACES, dtype=np.uint64)
FACTORS = RNG.integers(0, 2**63, PLACES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def trees_for(recall: float, similarity: float, levels: int, deeper: int = DEEPER) -> int:
    """Trees that a pair needs to meet in one, also if it must survive ``deeper`` times branching in two.

    Given the share of places in which its signatures agree, trees are independent; the share is binomial.
    """
    share = np.arange(PLACES + 1) / PLACES
    weight = np.array([math.comb(PLACES, k) * similarity**k * (1 - similarity) ** (PLACES - k) for k in range(PLACES + 1)])
    if weight[0] >= 1 - recall:
        raise ValueError(f"signatures of {PLACES} places cannot reach a recall of {recall} at a similarity of {similarity}")
    stays = np.ones(PLACES + 1)
    for _ in range(deeper):
        stays = 1 - (1 - share * stays) ** 2
    missed = 1 - share**levels * stays
    enough = lambda n: (weight * missed**n).sum() <= 1 - recall
    most = 1
    while not enough(most):
        most *= 2
    return next(n for n in range(most // 2, most + 1) if n and enough(n))


def shingle_sets(texts: list[str | None], width: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted hashes of its different shingles)."""
    for start, _, lists in V.stretches(texts, lower=True):
        numbers, different, bounds = V.codes(lists)
        word = V.hashes(different)[numbers] if len(numbers) else np.empty(0, np.uint64)
        runs = V.windows(word, width)
        for k, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
            if b - a >= width:
                yield start + k, np.unique(runs[a : b - width + 1])
            elif b > a:
                yield start + k, V.windows(word[a:b], b - a)
            else:
                yield start + k, np.empty(0, np.uint64)


def signature(tokens: np.ndarray) -> np.ndarray:
    """The low 16 bits of the smallest token under each of the orders."""
    low = np.full(PLACES, np.uint64(2**64 - 1), np.uint64)
    for i in range(0, len(tokens), 2_000):
        part = tokens[i : i + 2_000, None]
        low = np.minimum(low, ((part ^ FLIPS) * FACTORS).min(axis=0))
    return V.mixed(low).astype("<u2")


def signed(docs: DataFrame, text: str, doc_id: str, width: int) -> DataFrame:
    """(doc_id, key, n, set, sign); ``set`` is a hash of all shingles, null for the empty set, ``key`` one of doc_id and text."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            n, key, signs = [], [], []
            for _, tokens in shingle_sets(batch["text"].tolist(), width):
                n.append(len(tokens))
                key.append(xxhash.xxh3_64_intdigest(tokens.tobytes()) - 2**63 if len(tokens) else None)
                signs.append(signature(tokens).tobytes() if len(tokens) else None)
            keys = pd.Series(key, dtype="Int64", index=batch.index)
            yield pd.DataFrame({"doc_id": batch["doc_id"], "key": batch["key"], "n": n, "set": keys, "sign": signs})

    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(doc_id, text).alias("key"), F.col(text).alias("text")
    )
    return rows.mapInPandas(run, "doc_id long, key long, n long, set long, sign binary")


def _step(path: np.ndarray, signs: np.ndarray, salt: int) -> np.ndarray:
    """From nodes to the children that the selected tokens lead to."""
    chosen = (V.mixed(path + np.uint64(salt)) >> np.uint64(32)) % np.uint64(PLACES)
    token = signs[np.arange(len(path)), chosen.astype(np.int64)].astype(np.uint64)
    return V.mixed(path * V.A + (token + np.uint64(65_536 * (salt + 1))) * V.B)


def _signs(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), "<u2").reshape(len(column), PLACES)


SKETCH = ["s0", "s1", "s2", "s3"]


def _sketches(signs: np.ndarray) -> dict[str, np.ndarray]:
    """Two bits of every token of the signature."""
    bits = [((signs >> i) & 1).astype(np.uint8) for i in (0, 1)]
    packed = np.concatenate([np.packbits(b, axis=1, bitorder="little").view(np.int64) for b in bits], axis=1)
    return {name: packed[:, i] for i, name in enumerate(SKETCH)}


MEMBERS = ["node", "set", "n", *SKETCH]
MEMBER = ", ".join(f"{c} long" for c in MEMBERS)


def nodes(classes: DataFrame, trees: int, levels: int) -> DataFrame:
    """(node, set, n, *SKETCH): the node of every class in every tree after the first levels."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            signs = _signs(batch["sign"])
            own = _sketches(signs)
            for tree in range(trees):
                path = V.mixed(np.full(len(batch), tree + 1, np.uint64))
                for _ in range(levels):
                    path = _step(path, signs, 0)
                yield pd.DataFrame({"node": path.view(np.int64), "set": batch["set"], "n": batch["n"], **own})

    return classes.select("set", "n", "sign").mapInPandas(run, MEMBER)


def children(members: DataFrame) -> DataFrame:
    """Both children of every (node, set, sign)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            signs, path = _signs(batch["sign"]), batch["node"].to_numpy().view(np.uint64)
            for salt in (1, 2):
                to = _step(path, signs, salt)
                yield batch[MEMBERS[1:]].assign(node=to.view(np.int64))[MEMBERS]

    return members.select(*MEMBERS, "sign").mapInPandas(run, MEMBER)


def _near_in_size(a: str, b: str, percent: int):
    return F.least(F.col(a), F.col(b)) * 100 >= F.greatest(F.col(a), F.col(b)) * percent


def alike(a: str, b: str, percent: int) -> Column:
    """Whether the sketches of two members (structs) differ in no more bits than those of similar sets do.

    A place with unlike tokens has 0, 1 or 2 unlike bits: one on average, and 1.5 for the square.
    """
    p = 1 - percent / 100
    most = math.floor(PLACES * p + CERTAIN * math.sqrt(PLACES * (1.5 * p - p * p)))
    unlike = [F.bit_count(F.col(f"{a}.{x}").bitwiseXOR(F.col(f"{b}.{x}"))) for x in SKETCH]
    return (sum(unlike[1:], unlike[0]) <= most) & _near_in_size(f"{a}.n", f"{b}.n", percent)


def confirmed(pairs: DataFrame, classes: DataFrame, docs: DataFrame, text: str, doc_id: str, width: int, percent: int) -> DataFrame:
    """Pairs (a, b) whose full sets are similar enough."""
    wanted = pairs.select(F.col("a").alias("set")).union(pairs.select("b")).distinct()
    holders = classes.join(wanted, "set", "left_semi").select(F.col("first.doc_id").alias("_holder"))
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    texts = texts.join(holders, F.col("doc_id").eqNullSafe(F.col("_holder")), "left_semi")

    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [t for _, t in shingle_sets(batch["text"].tolist(), width)]
            keys = [xxhash.xxh3_64_intdigest(t.tobytes()) - 2**63 for t in found]
            yield pd.DataFrame({"set": keys, "tokens": [t.tobytes() for t in found]})

    full = texts.filter("text is not null").mapInPandas(sets, "set long, tokens binary")
    # equal rows hold the same set
    full = materialize(full.join(wanted, "set", "left_semi").dropDuplicates(["set"]), "shingle-sets")

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keep = []
            for x, y in zip(batch["x"], batch["y"]):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * common >= percent * (len(x) + len(y) - common))
            yield batch.loc[keep, ["a", "b"]]

    a = full.select(F.col("set").alias("a"), F.col("tokens").alias("x"))
    b = full.select(F.col("set").alias("b"), F.col("tokens").alias("y"))
    return pairs.join(a, "a").join(b, "b").mapInPandas(compare, "a long, b long")


def grouped(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", width: int = WIDTH,
    percent: int = PERCENT, recall: float = RECALL, work: int = WORK, deeper: int = DEEPER,
) -> DataFrame:
    """(doc_id, key, n, first): a row per document; ``first`` is the smallest document of its group, null if it has no set."""
    rows = materialize(signed(docs, text, doc_id, width), "signed")
    classes = rows.filter("set is not null").groupBy("set").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "key")).alias("first"),
        F.first("n").alias("n"), F.first("sign").alias("sign"),
    )
    classes = materialize(classes, "classes")
    levels = max(LEVELS, math.ceil(math.log(max(1, classes.count() / FEW), FANOUT)))
    trees = trees_for(recall, percent / 100, levels, deeper)

    def links(pairs: DataFrame) -> DataFrame:
        pairs = materialize(pairs.select("a", "b").distinct(), "pairs")
        return materialize(confirmed(pairs, classes, docs, text, doc_id, width, percent), "links")

    walked = nodes(classes, trees, levels)
    shared = walked.groupBy("node").agg(F.count("*").alias("size")).filter("size > 1").drop("size")
    meeting = materialize(walked.join(shared, "node"), "nodes")
    member = F.struct("set", "n", *SKETCH, "root")

    def stars(members: DataFrame, order: Column) -> DataFrame:
        """Every member of a node with the node's first one, if they may be linked and are not in one group."""
        first = members.groupBy("node").agg(F.min(F.struct(order.alias("o"), member.alias("m")))["m"].alias("x"))
        pairs = members.select("node", member.alias("y")).join(first, "node")
        return pairs.filter((F.col("x.root") != F.col("y.root")) & alike("x", "y", percent)).select(
            F.least("x.set", "y.set").alias("a"), F.greatest("x.set", "y.set").alias("b")
        )

    # the same first member in all trees
    found = links(stars(meeting.withColumn("root", F.col("set")), F.col("set")))
    groups = components(found)

    def open_nodes(members: DataFrame) -> DataFrame:
        """Members of nodes with several groups, with the largest group (home) and the work to compare the others with all."""
        told = members.join(groups.withColumnRenamed("item", "set"), "set", "left")
        told = told.withColumn("root", F.coalesce("root", "set"))
        sizes = told.groupBy("node", "root").agg(F.count("*").alias("c"))
        of = sizes.groupBy("node").agg(F.sum("c").alias("size"), F.max(F.struct("c", "root")).alias("top"))
        of = of.filter(F.col("size") > F.col("top.c"))
        of = of.select("node", F.col("top.root").alias("home"), ((F.col("size") - F.col("top.c")) * F.col("size")).alias("work"))
        return materialize(told.join(of, "node"), "open-nodes")

    def across(members: DataFrame) -> DataFrame:
        """Likely pairs of different groups that meet in a node."""
        x = members.filter("root != home").select("node", member.alias("x"))
        y = members.select("node", "home", member.alias("y"))
        once = (F.col("y.root") == F.col("home")) | (F.col("x.set") < F.col("y.set"))
        apart = once & (F.col("x.root") != F.col("y.root")) & alike("x", "y", percent)
        pairs = x.join(y, "node").filter(apart)
        return pairs.select(F.least("x.set", "y.set").alias("a"), F.greatest("x.set", "y.set").alias("b")).distinct()

    def partners(members: DataFrame, again: int, most: int) -> DataFrame:
        """Every member outside its node's largest group with a member of that, in ``most`` of its nodes at most."""
        at_home = members.filter("root = home")
        chosen = at_home.groupBy("node").agg(F.min_by(member, F.xxhash64("set", "node", F.lit(again))).alias("x"))
        outside = members.filter("root != home").select("node", "set", member.alias("y"))
        turn = F.row_number().over(W.partitionBy("set").orderBy(F.xxhash64("node", F.lit(again)), "node"))
        outside = outside.withColumn("_turn", turn).filter(F.col("_turn") <= most)
        pairs = outside.join(chosen, "node").filter(alike("x", "y", percent))
        return pairs.select(F.least("x.set", "y.set").alias("a"), F.greatest("x.set", "y.set").alias("b"))

    rest = open_nodes(meeting)
    # members that their node's first one does not reach meet others of its largest group: a few at a time, as most are linked soon
    for again, most in enumerate(ROUNDS):
        tried = links(partners(rest, again, most))
        if tried.isEmpty():
            break
        found = found.unionByName(tried)
        groups = components(found)
        rest = open_nodes(meeting)
    pairs = across(rest.filter(F.col("work") <= work))
    large = rest.filter(F.col("work") > work)
    for level in range(deeper + 1):
        if large.isEmpty():
            break
        if level == deeper:
            pairs = pairs.unionByName(across(large))
            break
        below = children(large.select(*MEMBERS).join(classes.select("set", "sign"), "set"))
        rest = open_nodes(below)
        pairs = pairs.unionByName(across(rest.filter(F.col("work") <= work)))
        large = rest.filter(F.col("work") > work)
    more = links(pairs)
    if not more.isEmpty():
        groups = components(found.unionByName(more))

    ids = classes.select("set", "first").join(groups.withColumnRenamed("item", "set"), "set", "left")
    ids = ids.withColumn("root", F.coalesce("root", "set"))
    smallest = ids.groupBy("root").agg(F.min("first").alias("first"))
    by_set = ids.select("set", "root").join(smallest, "root").select(F.col("set").alias("_set"), "first")
    return rows.join(by_set, F.col("set") == F.col("_set"), "left").select("doc_id", "key", "n", "first")


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", **options) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept): a row per document; ``options`` as for ``grouped``."""
    rows = grouped(docs, text, doc_id, **options)
    component = F.when(F.col("first").isNull(), F.col("doc_id")).otherwise(F.col("first.doc_id"))
    kept = F.col("first").isNull() | F.col("doc_id").eqNullSafe(F.col("first.doc_id"))
    return rows.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), kept.alias("kept"))


def one_of_each(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", **options) -> DataFrame:
    """The documents without near duplicates: of each group the one with the smallest id, once."""
    told = grouped(docs, text, doc_id, **options).filter("first is not null")
    told = told.groupBy("key").agg(F.first(F.col("key") == F.col("first.key")).alias("_first"))
    rows = docs.select(C.packed(docs), F.xxhash64(doc_id, text).alias("_key"))
    rows = rows.join(told, F.col("_key") == F.col("key"), "left")
    # rows equal in doc_id and text are told apart by their number only
    rows = rows.withColumn("_copy", F.row_number().over(W.partitionBy("_key").orderBy("_key")))
    return rows.filter(F.col("_first").isNull() | (F.col("_first") & (F.col("_copy") == 1))).select("_row.*")


def op4_near_duplicates(spark, sf_dir):
    return near_duplicates(C.documents(spark, sf_dir).select("doc_id", "text"), width=2)
