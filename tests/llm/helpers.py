"""Fixtures and plain versions that the tests of touchline.llm share."""

from __future__ import annotations

import random

import duckdb

SF = "/root/testdata/sf0.001"


def documents(name: str = "documents", sf_dir: str = SF) -> list[tuple]:
    return duckdb.sql(f"select * from '{sf_dir}/{name}.parquet'").fetchall()


def docs(spark, rows, extra: bool = True):
    """doc_id, text, lang of the rows, with further columns whose names the operators use themselves."""
    rows = [(*r, "en")[:3] for r in rows]
    if not extra:
        return spark.createDataFrame(rows, "doc_id long, text string, lang string")
    return spark.createDataFrame([(*r, i, "x", 1) for i, r in enumerate(rows)],
                                 "doc_id long, text string, lang string, row int, node string, length int")


#: Null and empty texts, null and repeated doc_ids, repeated rows, ties, blanks, and a very long text.
ODD = [
    (1, "alpha beta gamma delta epsilon zeta eta theta"), (1, "alpha beta gamma delta epsilon zeta eta theta"), (1, "other words here"),
    (2, None), (3, ""), (4, " \n\t "), (None, "alpha beta gamma delta epsilon zeta eta theta"), (None, None),
    (5, "ÄÖ ÄÖ é 漢字 \U0001f600 İ ſ K"), (6, "word " * 30_000), (7, "<|endoftext|> it's don't"), (8, "a\x00b \x1c c"),
]


def prose(seed: int, n: int, words: int = 400) -> str:
    r = random.Random(seed)
    return " ".join(f"{r.choice('bcdfg')}{r.choice('aeiou')}{r.choice('klmn')}{r.randrange(words)}" for _ in range(n))
