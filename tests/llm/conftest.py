import random

import pytest

WORDS = [f"w{i}" if i % 3 else f"Wör{i}" for i in range(400)]


def prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="session")
def edge_rows():
    """Ids and texts: nulls, empty and long texts, copies, near copies, shared
    passages, repeated rows and a row without an id."""
    rng = random.Random(5)
    base = prose(rng, 150)
    words = base.split()
    near = [" ".join([*words[:i], "changed", *words[i + 1 :]]) for i in (10, 60, 140)]
    passage = prose(rng, 45)
    rows = [
        (1, base),
        (2, base),
        (3, base.upper()),
        *[(10 + i, text) for i, text in enumerate(near)],
        *[(20 + i, f"{prose(rng, 30 + i)}\n{passage}\t{prose(rng, 20)}") for i in range(6)],
        (40, passage + " " + passage),
        (41, ""),
        (42, None),
        (43, " \n\t "),
        (44, "one"),
        (45, "one two"),
        (46, "one two"),
        (47, "ONE two"),
        (48, "a " * 300),
        (49, "漢字 かな Ünïcode   \x1c text 😀 " * 4),
        (50, prose(rng, 20_000)),
        (51, "x" * 3000),
        (52, prose(rng, 19)),
        (53, prose(rng, 60)),
    ]
    rows += [(60 + i, prose(rng, rng.randint(0, 80))) for i in range(30)]
    rows += [(None, passage), (1, base)]
    return rows


@pytest.fixture(scope="session")
def edge_documents(spark, edge_rows):
    """The rows with columns whose names clash with those of the operators."""
    rows = [(i, t, "en", "s", 1, 2, 3) for i, t in edge_rows]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, hits int, ids int"
    )


@pytest.fixture(scope="session")
def no_documents(edge_documents):
    return edge_documents.limit(0)


@pytest.fixture(scope="session")
def some_documents(spark):
    """The smallest of the given tables of documents, whole."""
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
