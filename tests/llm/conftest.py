import random

import pytest

from sluicebox.llm.common import ship_package

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, score string, name string, key string, n_words string, hits string, _id string, _hash string, _nth string, _clean string, _order string, _spans string, doc string, hash string"


@pytest.fixture(scope="session")
def ready(spark, tmp_path_factory):
    ship_package(spark)
    return spark


@pytest.fixture(scope="session")
def awkward_rows():
    """Nulls, empty and blank texts, ties, repeated rows, copies, near copies and a long text."""
    dice = random.Random(5)
    words = [f"{a}{b}" for a in "ba ke li mo nu pa re si to vu".split() for b in "ran len mit dos sul".split()]

    def prose(n):
        return " ".join(dice.choice(words) for _ in range(n))

    base = prose(160)
    near = base.split()
    near[40] = "changed"
    tail = prose(90)
    texts = [
        (1, None), (2, ""), (3, "  \n\t "), (4, base), (5, base), (4, base), (6, " ".join(near)), (None, base), (None, None),
        (7, prose(12000)), (8, "one two"), (9, "ONE TWO"), (10, "é" * 900), (11, "x" * 3000), (12, "start " + tail), (13, "begin other " + tail),
        (14, "a b c d e"), (15, "A B  C\td e"), (16, "menu | home | about\nA good line of plain words ends here.\nmenu | home | about"),
        (17, "漢字 かな <|endoftext|> it's 12 ▁ tab\x00 😀"), (18, (prose(9) + "\n") * 20), (19, "mail a.b@c.de or +1 (234) 555-6789, 10.0.0.1 4111 1111 1111 1111"),
    ]
    return [(i, t, "en", "s", None, *["clash"] * 13) for i, t in texts]


@pytest.fixture(scope="session")
def awkward(ready, awkward_rows):
    return ready.createDataFrame(awkward_rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(ready):
    return ready.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(ready, data):
    return ready.read.parquet(f"{data}/documents.parquet")


def by_row(rows):
    """Rows without regard to order; None sorts first."""
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((x is not None, x) for x in r))
