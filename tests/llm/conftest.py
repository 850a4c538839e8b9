from __future__ import annotations

import random

import duckdb
import pandas as pd
import pytest
from pyspark.sql import types as T

#: Columns of other meaning whose names the operators use inside or return.
CLASHES = ("line", "n", "set", "gram", "h", "k", "n_lines", "component_id", "size", "score", "__x", "items", "kept", "row", "word")


def word(rng):
    return "".join(rng.choice(["la", "to", "ri", "ne", "su", "ka", "Ö", "ß"]) for _ in range(rng.randint(1, 4)))


def prose(rng, n):
    return "".join(word(rng) + rng.choice([" ", " ", " ", "  ", "\n", "\t", ". "]) for _ in range(n))


def edge_rows():
    """(doc_id, text, source): nulls, empty and long texts, ties, copies, near copies, shared lines and passages."""
    rng = random.Random(7)
    base = prose(rng, 120)
    near = [base.replace(base.split()[k], "xx", 1) for k in (3, 50, 90)]
    passage = " ".join(word(rng) for _ in range(60))
    line = "A line that stands in very many documents, word for word"
    rows = [(None, base, "s1"), (None, None, None), (0, None, "s1"), (1, "", None), (2, " \n\t ", "s2"), (3, "one two", "s1"), (4, "two one", "s1")]
    rows += [(5, "One TWO", "s3"), (6, base, "s1"), (7, base, "s2"), (7, base, "s2"), (8, base.upper(), "s1"), (9, near[0], "é"), (10, near[1], "s1")]
    rows += [(11, near[2], "s1"), (12, "abc " * 3000, "s1"), (13, prose(rng, 20000), "s2"), (14, "x" * 150 + "y" * 150 + "x" * 150, "s1")]
    rows += [(20 + k, f"{prose(rng, 30)}\n{'  ' if k % 2 else ''}{line}\t\n{prose(rng, 5)}\n{passage}", f"s{k % 4}") for k in range(9)]
    rows += [(30 + k, prose(rng, 40), "s1") for k in range(6)]
    rows += [(40, "\n".join([line] * 3), "s2"), (-5, line.upper(), "s1"), (41, "a \x00 b\x0bc d e", "s9"), (42, "1 2 3 4", "s1"), (43, "4 3 2 1", "s1")]
    return rows


def frame(spark, rows, clashes=True):
    extra = CLASHES if clashes else ()
    schema = T.StructType(
        [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("source", T.StringType())]
        + [T.StructField(c, T.StringType()) for c in extra]
    )
    return spark.createDataFrame([(*r, *["?"] * len(extra)) for r in rows], schema).repartition(3)


@pytest.fixture(scope="session")
def edges():
    return edge_rows()


@pytest.fixture(scope="session")
def docs(spark, edges):
    return frame(spark, edges)


@pytest.fixture(scope="session")
def no_docs(spark):
    return frame(spark, [])


def duck(sql, **tables):
    con = duckdb.connect()
    for name, rows in tables.items():
        cols = {"docs": ["doc_id", "text", "source"], "items": ["item_id", "text"]}[name]
        con.register(name, pd.DataFrame(rows, columns=cols).astype({cols[0]: "Int64", **{c: object for c in cols[1:]}}))
    for name in tables:
        sql = sql.replace("{" + name + "}", name)
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    return sorted((tuple(r[names.index(c)] for c in sorted(names)) for r in cur.fetchall()), key=repr)


def plain(df):
    return sorted((tuple(r[c] for c in sorted(df.columns)) for r in df.collect()), key=repr)
