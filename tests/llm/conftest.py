import random

import pytest

from kglake.llm import shared


@pytest.fixture(autouse=True, scope="session")
def shipped(spark):
    shared.ship_package(spark)


def words(r: random.Random, n: int) -> list[str]:
    return ["".join(r.choices(["an", "be", "con", "do", "é", "ß", "fa", "go", "hi"], k=r.randint(1, 4))) for _ in range(n)]


@pytest.fixture(scope="session")
def texts():
    """Ids and texts: prose of many lengths, exact and near copies, junk, nulls, blanks, a long text."""
    r = random.Random(3)
    rows: list[tuple[int, str | None, str | None]] = []

    def add(text, source="a"):
        rows.append((len(rows), text, source))

    for n in [1, 3, 4, 5, 6, 7, 9, 12, 30, 31, 32, 60, 64, 65, 90, 128, 200, 255, 256, 257, 300, 420]:
        base = words(r, n)
        add(" ".join(base).capitalize() + ".", r.choice(["a", "b", "C", None, "ä"]))
        add(" ".join(base).capitalize() + ".", "b")
        for edits in (1, max(1, n // 40), max(1, n // 16), max(1, n // 6)):
            near = list(base)
            for _ in range(edits):
                near[r.randrange(n)] = "".join(words(r, 1)) + "x"
            add(" \n".join(near), r.choice(["a", "b", None]))
        add(" ".join(base + words(r, max(1, n // 7))), "b")
        add(" ".join(base[: max(1, n - n // 8)]).upper(), "C")
    hot = " ".join(words(r, 60))
    for _ in range(25):  # a passage that many documents share
        add(hot + " " + " ".join(words(r, 30)))
    family = words(r, 80)
    for _ in range(40):  # a group of near copies
        near = list(family)
        near[r.randrange(80)] = "y" + words(r, 1)[0]
        add(" ".join(near))
    for blank in (None, "", " \t\n", "!", "a\x1fb   c", "<|endoftext|> x <|endoftext|>", "\n\n a \n\n"):
        add(blank, None)
    add(" ".join(words(r, 4000)), "b")
    return rows


SCHEMA = "doc_id long, text string, source string, lang string, n_chars long, rank int, size string, kept string, code string"


@pytest.fixture(scope="session")
def docs(spark, texts):
    """The texts with columns whose names operators use themselves."""
    rows = [(i, t, s, "xx", len(t or ""), 1, "s", "k", "c") for i, t, s in texts]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def repeated_docs(spark):
    """Rows that repeat, with null ids."""
    text = "one two three four five six seven. " * 20
    return spark.createDataFrame([(1, text, "a", "xx", 5, 1, "s", "k", "c")] * 3 + [(None, text, None, "xx", 5, 1, "s", "k", "c")] * 2
                                 + [(None, None, None, None, None, None, None, None, None)], SCHEMA)
