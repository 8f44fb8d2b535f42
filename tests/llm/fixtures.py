"""Small hand-made tables and brute-force versions of the operators."""

from __future__ import annotations

import random
import re

from pyspark.sql import DataFrame, SparkSession

WORD = re.compile(r"[^\x20\x09-\x0D]+")
# Columns beside those of documents; the names are ones the operators use inside.
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, size bigint, fp bigint, block bigint, tokens string, row int"


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def lower(text: str | None) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def prose(seed: int, n: int, alphabet: int = 400) -> str:
    """Random words with some punctuation and line breaks."""
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        out.append("w" + format(rng.randrange(alphabet), "x") + rng.choice(["", "", "", ".", ","]))
        out.append(rng.choice([" ", " ", " ", "  ", "\n", "\t"]))
    return "".join(out)


def rows() -> list[tuple[int | None, str | None, str | None]]:
    """(doc_id, text, source) with every edge case."""
    passage = prose(99, 70)
    near = prose(5, 300).split(" ")
    twin = " ".join([*near[:150], "changed", *near[151:]])
    tricky = "É ÀB \x0b a\x1cb  ﬁ \U0001f600 İ"
    given = [
        (1, prose(1, 120), "a"), (2, prose(2, 200) + passage, "a"), (3, passage + prose(3, 90), "b"),
        (4, prose(1, 120), "b"), (5, " ".join(near), "a"), (6, twin, "b"), (7, "", "a"), (8, None, "a"),
        (9, "one two", None), (10, " \n\t ", "c"), (11, "spam and eggs " * 60, "c"), (12, prose(12, 6000, 3000), "a"),
        (13, tricky * 9, None), (14, "line one here\n" * 30, "a"), (15, None, None), (None, prose(15, 80), "a"),
        (None, None, None), (16, prose(16, 150), "d"), (16, prose(16, 150), "d"), (17, prose(17, 150), ""),
        (18, passage, "a"), (19, "the " * 120, "a"), (20, "<|endoftext|> a<|endoftext|>b <|startoftext|>", "a"),
    ]
    return given


def documents(spark: SparkSession, given: list | None = None) -> DataFrame:
    given = rows() if given is None else given
    full = [(i, t, "en", s, len(t or ""), 7, 3, 1, "x", 2) for i, t, s in given]
    return spark.createDataFrame(full, SCHEMA)


def empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)
