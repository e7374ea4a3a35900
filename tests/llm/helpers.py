"""A small documents table with everything that a table may hold."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, node string, label string, score string, length int, words int, pos int, `_row` string, `_text` string"


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice(["an", "er", "tion", "the", "re", "ou", "ß", "é"]) for _ in range(r.randint(1, 4))) for _ in range(n))


def edge_rows() -> list[tuple]:
    base = prose(1, 120)
    texts = [
        (1, base), (2, base), (3, base.upper()), (4, base.replace(" ", "\n", 3)), (5, " ".join(base.split()[:-2] + ["x", "y"])),
        (6, None), (7, ""), (8, " \n\t "), (9, "word"), (10, "two words"), (11, "a b c"), (12, "a b c d"), (13, prose(2, 60)), (13, prose(2, 60)), (13, prose(3, 50)),
        (None, prose(4, 40)), (None, None), (14, prose(5, 30_000)), (15, "z" * 120_000), (16, "1" * 60_000), (17, " ".join(["a"] * 9000)), (18, "line\n" * 300 + "end"), (19, "日本語 текст ελληνικά 🙂 " * 20), (-3, base),
    ]
    return [(i, t, None if k % 5 == 0 else "en", None if k % 7 == 3 else f"src{k % 4}", None if t is None else len(t), "n", "l", "s", 1, 2, 3, "r", "t") for k, (i, t) in enumerate(texts)]


def edge_docs(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA)


def empty_docs(spark):
    return spark.createDataFrame([], SCHEMA)
