"""Mixing sources to target weights, with DataFrame functions only.

Documents get a hash-random key. Within a source they are ordered by that key;
the first hex digits of the key are its range, so a source of any size is dealt
over many ranges. Words are summed by (source, range), the range sums are added
up in key order, and only then are documents sorted inside their range: prefix
sums without any source passing through one task. Each source is cut where its
exact budget of words ends; a target above the source's size repeats whole
epochs first.

Cases: a null or empty text has size 0 and is taken 0 times; a null source is a
source of its own, ordered last; null ids share one key and are ordered by size;
repeated rows are separate documents (equal ones are interchangeable); an empty
table gives an empty result; columns other than doc_id, text and source are not
read by :func:`plan_mix`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ._store import written

WORD = r"[^\x20\x09-\x0D]+"
#: Hex digits of a key that name its range: 16**3 ranges a source.
RANGE_DIGITS = 3


def sizes(docs: DataFrame, seed: str = "0") -> DataFrame:
    """(doc_id, source, size, key): words of the whole text and the hash-random key."""
    return docs.select(
        "doc_id",
        "source",
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))).alias("key"),
    )


def targets(by_source: DataFrame, weights: tuple[int, ...], share: float, cap: int) -> DataFrame:
    """(source, source_size, target) from (source, source_size): one row a source.

    Sources by code point, null last, take the weights in turn. A target is
    lambda * weight, at most cap * size; lambda is where the targets add up to
    share * all sizes. Sources reach their cap in order of size / weight, so the
    first one that stays below its cap fixes lambda.
    """
    order = W.orderBy(F.col("source").asc_nulls_last())
    fill = W.orderBy("ratio", F.col("source").asc_nulls_last())
    every = W.partitionBy()
    turn = F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    s = by_source.withColumn("weight", turn.cast("double")).withColumn("ratio", F.col("source_size") / F.col("weight"))
    s = s.withColumns(
        {
            "most": F.col("source_size").cast("double") * cap,
            "place": F.row_number().over(fill),
            "need": F.sum(F.col("source_size")).over(every) * F.lit(float(share))
            - F.coalesce(F.sum(F.col("source_size")).over(fill.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)) * cap,
            "rest": F.sum("weight").over(fill.rowsBetween(0, W.unboundedFollowing)),
        }
    )
    s = s.withColumn("free", F.min(F.when(F.col("weight") * F.col("need") <= F.col("rest") * F.col("most"), F.col("place"))).over(every))
    at = lambda c: F.max(F.when(F.col("place") == F.col("free"), F.col(c))).over(every)
    s = s.withColumns({"need_free": at("need"), "rest_free": at("rest")})
    return s.select(
        "source",
        "source_size",
        F.when(F.col("place") >= F.col("free"), F.col("weight") * F.col("need_free") / F.col("rest_free"))
        .otherwise(F.col("most"))
        .alias("target"),
    )


def plan_mix(
    docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, cap: int = 2, seed: str = "0"
) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken): words that the mix takes of each document.

    ``taken`` counts repeats: epochs * size, plus the part of one more epoch that
    the source's budget (its target without the fraction) still pays for; the
    document at the cut gives only its first words.
    """
    base = written(sizes(docs, seed), "mix-sizes").withColumn("part", F.substring("key", 1, RANGE_DIGITS))
    ranges = base.groupBy("source", "part").agg(F.sum("size").alias("part_size"))
    goal = targets(ranges.groupBy("source").agg(F.sum("part_size").alias("source_size")), weights, share, cap)
    before = W.partitionBy("source").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    ranges = ranges.withColumn("part_before", F.coalesce(F.sum("part_size").over(before), F.lit(0)))
    r, g, b = ranges.alias("r"), goal.alias("g"), base.alias("b")
    cuts = r.join(g, F.col("r.source").eqNullSafe(F.col("g.source"))).select("r.source", "r.part", "part_before", "source_size", "target").alias("c")
    inside = W.partitionBy("source", "part").orderBy("key", "size").rowsBetween(W.unboundedPreceding, -1)
    rows = b.join(cuts, F.col("b.source").eqNullSafe(F.col("c.source")) & (F.col("b.part") == F.col("c.part"))).select(
        "doc_id", "b.source", "size", "key", "b.part", "part_before", "source_size", "target"
    )
    budget = F.floor("target")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(F.lit(0))
    ahead = F.col("part_before") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    rows = rows.withColumn("ahead", ahead)
    left = budget - epochs * F.col("source_size") - F.col("ahead")
    taken = epochs * F.col("size") + F.least(F.col("size"), F.greatest(F.lit(0), left))
    return rows.select("doc_id", "source", "size", "source_size", "target", taken.cast("long").alias("taken"))


def mixture(docs: DataFrame, **params) -> DataFrame:
    """The mixed documents themselves: documents' columns and ``copy`` (from 1), one row a repeat.

    The last repeat of the document at a cut holds only the words still paid
    for, joined by single spaces. Rows whose doc_id is null are left out; rows
    that share a doc_id each follow that id's largest plan.
    """
    plan = plan_mix(docs, **params).filter("taken > 0").groupBy("doc_id").agg(F.max("taken").alias("__taken"), F.max("size").alias("__size"))
    rows = docs.join(plan, "doc_id").withColumn("copy", F.explode(F.sequence(F.lit(1), F.ceil(F.col("__taken") / F.col("__size")).cast("int"))))
    words = F.least(F.col("__size"), F.col("__taken") - (F.col("copy") - 1) * F.col("__size"))
    cut = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(f"({WORD})")), F.lit(1), words.cast("int")), " ")
    return rows.withColumn("text", F.when(words < F.col("__size"), cut).otherwise(F.col("text"))).drop("__taken", "__size")
