import random

import pytest

from stylograph.llm.queries import importable

SF = "/root/testdata/sf0.001"
CLASHING = "size long, shard int, slot string, row long, key string, _row int, line string, target string, kept boolean, copies int"


@pytest.fixture(scope="session", autouse=True)
def _importable(spark):
    importable(spark)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "source").cache()


@pytest.fixture(scope="session")
def rows(docs):
    return docs.collect()


def edge_rows():
    """Nulls, empty and long texts, ties and repeated rows."""
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(400)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    base, long = text(60), "\n".join(text(40) for _ in range(300))
    near = base.split()
    near[30] = "changed"
    out = [
        (1, base, "a"), (2, base, "a"), (2, base, "a"), (3, " ".join(near), "b"), (4, None, "b"), (5, "", None), (6, " \t\n", None),
        (7, long, "a"), (8, long, None), (None, text(50), "b"), (None, None, None), (9, "one", "c"), (10, "One", "c"), (11, "é ß 😀 İ", "c"),
    ]
    return out + [(100 + i, text(30 + i), "abc"[i % 3]) for i in range(20)]


@pytest.fixture(scope="session")
def edge(spark):
    rows = [(*r, 7, 1, "s", 2, "k", 3, "l", "t", True, 4) for r in edge_rows()]
    return spark.createDataFrame(rows, f"doc_id long, text string, source string, {CLASHING}").cache()


@pytest.fixture(scope="session")
def empty(edge):
    return edge.limit(0)
