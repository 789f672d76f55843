"""Which quotes stand in which texts of their thread, through an index of anchors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agorascope.session import cut

#: The least words of a quote that has an anchor: its first and last may be parts of words in the text, two stand between.
LEAST = 4


def _pairs(words: Column) -> Column:
    """Hashes of each two words in a row, each once."""
    n = F.greatest(F.lit(0), F.size(words) - 1)
    return F.array_distinct(F.zip_with(F.slice(words, 1, n), F.slice(words, 2, n), lambda a, b: F.xxhash64(a, b)))


def candidates(needles: DataFrame, texts: DataFrame, flag: str) -> DataFrame:
    """(id, needle, said, ``flag``): of each needle the texts that are searched for it.

    Equal needles and equal texts of a thread are looked at once. Each needle of ``LEAST`` words or more is looked up by its
    anchor: of its inner word pairs the one that the fewest texts of the thread have; a pair that none has settles it.
    Only the texts with the anchor are searched, so a thread's quotes don't meet all its comments. Shorter needles do.
    """
    asked = needles.select("id", "needle").where("needle is not null").distinct()
    asked = cut(asked.withColumn("words", F.split("needle", " ")).withColumn("long", F.size("words") >= LEAST))
    said = texts.where("said is not null and said <> ''").groupBy("id", "said").agg(F.bool_or(flag).alias(flag))
    said = cut(said.withColumn("text", F.xxhash64("said")))
    inner = F.slice("words", 2, F.greatest(F.lit(0), F.size("words") - 2))
    of_needle = asked.where("long").select("id", "needle", F.explode(_pairs(inner)).alias("gram"))
    wanted = of_needle.select("id", "gram").distinct()
    # the index: for each thread the pairs that some quote asks for, and the texts that have them
    index = cut(said.select("id", "text", F.explode(_pairs(F.split("said", " "))).alias("gram")).join(wanted, ["id", "gram"], "left_semi"))
    counts = index.groupBy("id", "gram").agg(F.count(F.lit(1)).alias("n"))
    anchors = of_needle.join(counts, ["id", "gram"], "left").groupBy("id", "needle").agg(
        F.min(F.struct("n", "gram")).alias("best"), F.bool_or(F.col("n").isNull()).alias("nowhere"),
    ).where("not nowhere").select("id", "needle", F.col("best.gram").alias("gram"))
    near = anchors.join(index, ["id", "gram"]).join(said, ["id", "text"]).select("id", "needle", "said", flag)
    short = asked.where("not long").select("id", "needle").join(said, "id").select("id", "needle", "said", flag)
    return near.unionByName(short)


def contained(needles: DataFrame, texts: DataFrame, flag: str) -> DataFrame:
    """(id, needle, ``flag``): the needles that stand in a text of the same id, with the texts' flags or-ed.

    needles: (id, needle), texts: (id, said, ``flag``), both in normal form, with single spaces between words.
    """
    found = candidates(needles, texts, flag).where(F.instr("said", F.col("needle")) > 0)
    return found.groupBy("id", "needle").agg(F.bool_or(flag).alias(flag))
