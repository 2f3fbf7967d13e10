"""Odd tables that every operator must take: nulls, empty and long texts, ties, repeated rows, clashing columns."""

from __future__ import annotations

import random

import pytest

# Names that operators use for themselves; none of them may be read or disturb.
CLASHING = "size long, first string, spans int, component_id long, copies int, letter string, range string, rank int, at int, n string"
SCHEMA = f"doc_id long, text string, lang string, source string, n_chars long, {CLASHING}"


def words(rng: random.Random, n: int, letters: str = "abcdefghij") -> str:
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 7))) for _ in range(n))


def odd_rows() -> list[tuple]:
    rng = random.Random(5)
    base = words(rng, 60)
    near = base.split()
    near[30] = "changed"
    long = words(rng, 20_000)
    shared = words(rng, 25)
    rows = [
        (1, base, "en", "a"), (2, base.upper(), "en", "a"), (3, " ".join(near), "en", None), (4, None, "en", "b"),
        (5, "", "de", "b"), (6, " \t\n\r ", None, "b"), (7, "one", None, "c"), (8, "One", "en", "c"),
        (9, "two words here", "en", "c"), (10, long, "de", "c"), (11, long + " tail", "de", "\U0001F600"),
        (12, f"{words(rng, 30)} {shared} {words(rng, 30)}", "en", "￿"), (13, f"{words(rng, 9)}\n{shared}\n{words(rng, 9)}", "en", ""),
        (14, "123 456 -- 7", "en", "a"), (15, "déjà vu ßtraße 漢字   😀 \x00 end", "fr", "a"), (16, f"{shared} {shared}", "en", "a"),
        (17, "line\nsame line\nnext line\nlast", "en", "a"), (18, "other\r\nsame line\nnext line\n\nend", "en", "a"),
        (None, base, "en", "a"), (None, None, None, None), (7, "one", None, "c"), (20, words(rng, 50), "en", "a"),
        (20, words(rng, 50), "en", "a"), (21, "w " * 100, "en", "a"), (-3, base, "en", "d"),
    ]
    return [row + (len(row[1] or ""), -1, "x", 3, -7, 9, "y", "z", 0, 2, "n") for row in rows]


@pytest.fixture(scope="session")
def odd(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("odd") / "documents.parquet")
    spark.createDataFrame(odd_rows(), SCHEMA).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def plain_words(text: str | None) -> list[str]:
    return [w.decode() for w in (text or "").encode().split()]
