import random

import pytest

SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, "
    "row bigint, name string, kept string, score double, node bigint, hash string"
)


def prose(seed: int, n: int) -> str:
    """n invented words, each as good as never the same in another text."""
    letters = random.Random(seed)
    return " ".join("".join(letters.choices("abcdefghiklmnoprstuvw", k=letters.randint(2, 9))) for _ in range(n))


def frame(spark, rows):
    """Documents with columns whose names the operators use inside."""
    full = [(i, t, "en", "s", None if t is None else len(t), 1, "x", "y", 0.5, 7, "h") for i, t in rows]
    return spark.createDataFrame(full, SCHEMA)


def odd_texts() -> list:
    """Nulls, empty and blank texts, a long one, repeated rows, equal texts, near copies, marks of all sorts."""
    base = prose(1, 300)
    words = base.split()
    changed = " ".join([*words[:150], "other", *words[151:]])
    half = " ".join([*words[:150], *prose(2, 150).split()])
    long = prose(3, 30_000)
    return [
        (1, None),
        (2, ""),
        (3, " \t\n"),
        (4, base),
        (5, base),
        (6, changed),
        (7, half),
        (8, long),
        (9, prose(4, 3)),
        (10, prose(4, 3)),
        (11, base.upper()),
        (12, "one"),
        (13, "a b c d e " * 30),
        (13, "a b c d e " * 30),
        (None, prose(5, 60)),
        (None, prose(5, 60)),
        (None, None),
        (14, "Ünïcödé ß 中文 😀 " + prose(6, 50)),
        (15, "  doubled  blanks\n\nand lines \r\n" + prose(7, 40) + " "),
        (16, f"{prose(8, 40)} {' '.join(words[20:80])} {prose(9, 40)}"),
    ]


@pytest.fixture(scope="session")
def odd(spark):
    return frame(spark, odd_texts())


@pytest.fixture(scope="session")
def nothing(spark):
    return frame(spark, [])
