"""Checks of segmented works."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from narrative_spark.functions import prefix
from narrative_spark.functions.text import count_of
from narrative_spark.sources.stages import stored

PREVIEW, SPOTS = 220, 10
#: Lines or units that one sort takes together.
BLOCK = 1 << 14


def check_orders(units: DataFrame) -> DataFrame:
    """Whether a work's orders are 1 to n."""
    n = F.count(F.lit(1))
    return units.groupBy("work_id").agg(n.alias("units"), F.min("ord").alias("first"), F.max("ord").alias("last"), ((n == F.count_distinct("ord")) & (F.min("ord") == 1) & (F.max("ord") == n)).alias("ok"))


def _numbered_lines(labelled: DataFrame, units: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(the lines outside headers, the units' lines): work_id, at (from 1 in each work), line. Numbers are counted block by block."""
    body = labelled.where(~F.col("is_header")).select("work_id", "line_no", "line")
    placed = prefix.scan(body.select("work_id", "line_no", F.floor(F.col("line_no") / BLOCK).alias("block")), "work_id", "block", [F.col("line_no")], sums={"earlier": F.lit(1)})
    left = body.join(placed.select("work_id", "line_no", (F.col("earlier") + 1).alias("at")), ["work_id", "line_no"]).select("work_id", "at", "line")
    lines = F.split("text", "\n", -1)
    sizes = units.select("work_id", "ord", F.floor(F.col("ord") / BLOCK).alias("block"), F.size(lines).cast("long").alias("n"))
    before = prefix.scan(sizes, "work_id", "block", [F.col("ord")], sums={"earlier": F.col("n")}).select("work_id", "ord", "earlier")
    right = units.select("work_id", "ord", F.posexplode(lines).alias("k", "line")).join(before, ["work_id", "ord"]).select("work_id", (F.col("earlier") + F.col("k") + 1).alias("at"), "line")
    return left, right


def check_lossless(labelled: DataFrame, units: DataFrame) -> DataFrame:
    """Whether the lines outside headers are the units' lines, in their order; lengths as of both joined by line feeds.

    A work's lines are summed up by two 64-bit hashes of each line with its place, so that no line meets another; where works differ, lossless_differences tells the lines.
    """
    size = (F.coalesce(F.sum(F.length("line")), F.lit(0)) + F.greatest(F.count("line") - 1, F.lit(0))).cast("long")
    both = [df.groupBy("work_id").agg(size.alias(f"{n}_chars"), F.struct(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("at", "line")).alias("a"), F.bit_xor(F.xxhash64("line", "at", F.lit(7))).alias("b")).alias(n)) for n, df in zip(("body", "unit"), _numbered_lines(labelled, units), strict=True)]
    none = lambda n: F.coalesce(f"{n}_chars", F.lit(0).cast("long")).alias(f"{n}_chars")
    return both[0].join(both[1], "work_id", "full_outer").select("work_id", none("body"), none("unit"), F.col("body").eqNullSafe(F.col("unit")).alias("ok"))


def lossless_differences(labelled: DataFrame, units: DataFrame, most: int = 8) -> DataFrame:
    """work_id, at, body, unit: the first lines that differ (null where there is none) of each work that isn't kept whole; only such works are compared line by line."""
    bad = stored(check_lossless(labelled, units).where("not ok").select("work_id"), "differing")
    left, right = (df.join(bad, "work_id", "left_semi").select("work_id", "at", F.col("line").alias(n)) for n, df in zip(("body", "unit"), _numbered_lines(labelled, units), strict=True))
    rows = left.join(right, ["work_id", "at"], "full_outer").where(~F.col("body").eqNullSafe(F.col("unit")))
    return rows.withColumn("rank", F.row_number().over(W.partitionBy("work_id").orderBy("at"))).where(F.col("rank") <= most).select("work_id", "at", "body", "unit")


def check_headers(units: DataFrame, headers: DataFrame) -> DataFrame:
    """Registered headers under which no unit stands."""
    return headers.distinct().join(units.select("work_id", F.col("chapter_name").alias("header")).distinct(), ["work_id", "header"], "left_anti")


def check_provenance(units: DataFrame) -> DataFrame:
    """Units whose line range isn't 0 < start <= end."""
    return units.where(~(F.coalesce((F.col("start_line") > 0) & (F.col("start_line") <= F.col("end_line")), F.lit(False)))).select("work_id", "unit_id", "start_line", "end_line")


def units_per_chapter(units: DataFrame) -> DataFrame:
    return units.groupBy("work_id", "chapter_name").agg(F.count(F.lit(1)).alias("unit_count"))


def spot_check(units: DataFrame, spots: int = SPOTS) -> DataFrame:
    """Units spread evenly over each work, all where it has no more than spots; previews of at most PREVIEW signs. Orders must be 1 to n."""
    count = units.groupBy("work_id").agg(F.count(F.lit(1)).alias("n"))
    n = F.col("n")
    places = F.when(n <= spots, F.sequence(F.lit(1).cast("long"), n)).otherwise(F.array_distinct(F.transform(F.sequence(F.lit(0), F.lit(spots - 1)), lambda i: F.rint(i * (n - 1) / (spots - 1)).cast("long") + 1)))
    picked = count.select("work_id", F.explode(places).alias("ord"))
    flat = F.replace("text", F.lit("\n"), F.lit(" / "))
    cut = F.when(F.length(flat) > PREVIEW, F.concat(F.substring(flat, 1, PREVIEW), F.lit(" ……"))).otherwise(flat)
    return units.join(picked, ["work_id", "ord"]).select("work_id", "ord", "unit_id", "chapter_name", "start_line", "end_line", "chars", cut.alias("preview"))


def validation_report(labelled: DataFrame, units: DataFrame, headers: DataFrame) -> DataFrame:
    """work_id, check, passed for each check, and for all of them together."""
    works = units.select("work_id").distinct()
    named = lambda df, name: df.withColumn("check", F.lit(name)).select("work_id", "check", F.col("ok").alias("passed"))
    none_of = lambda bad: works.join(bad.select("work_id").distinct().withColumn("bad", F.lit(True)), "work_id", "left").select("work_id", F.col("bad").isNull().alias("ok"))
    parts = [named(check_orders(units), "orders"), named(check_lossless(labelled, units), "lossless"), named(none_of(check_headers(units, headers)), "headers"), named(none_of(check_provenance(units)), "provenance")]
    rows = reduce(DataFrame.unionByName, parts)
    every = rows.groupBy("work_id").agg(F.bool_and("passed").alias("passed")).withColumn("check", F.lit("all")).select("work_id", "check", "passed")
    return rows.unionByName(every)


def corpus_profile(lines: DataFrame, terms: list[str]) -> DataFrame:
    """Lines of each work, median, 90th percentile and most of their lengths, and how often each term stands in them."""
    size = F.length("line")
    return lines.groupBy("work_id").agg(F.count(F.lit(1)).alias("line_count"), F.percentile(size, 0.5).alias("median_chars"), F.percentile(size, 0.9).alias("p90_chars"), F.max(size).alias("max_chars"), *[F.sum(count_of(F.col("line"), F.lit(t))).cast("long").alias(f"n_{t}") for t in terms])
