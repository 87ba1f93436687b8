"""Lines to chapters and scene units.

A unit begins at a chapter's first line and at each line longer than the threshold; shorter lines join the unit before
them. units: work_id, unit_id, ord (from 1), chapter_idx, chapter_name, start_line, end_line, text, chars.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from narrative_spark.functions import prefix
from narrative_spark.sources.stages import stored

THRESHOLD = 80
#: Lines that one sort takes together.
BLOCK = 1 << 14


def label_chapters(body: DataFrame, headers: DataFrame) -> DataFrame:
    """body with line_chars, is_header, chapter_idx and chapter_name; headers: work_id, header. Lines before the first header are chapter 0 without a name.

    Only lines that are short enough to be a header meet the headers, and only numbers and header lines are counted through; body should be stored, as
    it is read twice.
    """
    known = headers.select(F.col("work_id"), F.col("header").alias("line")).distinct().withColumn("is_header", F.lit(True))
    longest = known.agg(F.max(F.length("line"))).first()[0] or 0
    lines = body.select("work_id", "line_no", F.floor(F.col("line_no") / BLOCK).alias("block"), F.when(F.length("line") <= longest, F.col("line")).alias("line"))
    short = lines.where("line is not null").join(known, ["work_id", "line"], "left")
    marks = short.select("work_id", "line_no", "block", F.when(F.col("is_header"), F.col("line")).alias("name"))
    marks = stored(marks.unionByName(lines.where("line is null").withColumnRenamed("line", "name")), "marks")
    hit = F.col("name").isNotNull()
    labels = prefix.scan(marks, "work_id", "block", [F.col("line_no")], sums={"earlier": hit.cast("long")}, latest={"last": F.col("name")})
    labels = labels.select("work_id", "line_no", hit.alias("is_header"), (F.col("earlier") + hit.cast("long")).cast("int").alias("chapter_idx"), F.coalesce("name", "last", F.lit("")).alias("chapter_name"))
    # Sizes are taken before the join, so that who needs no more than them doesn't shuffle lines.
    return body.withColumn("line_chars", F.length("line")).join(labels, ["work_id", "line_no"]).select(*body.columns, "line_chars", "is_header", "chapter_idx", "chapter_name")


def segment_units(labelled: DataFrame, works: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """Units of every work, from lines as label_chapters gives them. A chapter without lines has none; a header that comes again is a chapter again.

    Numbers of lines are counted through first and stored; texts then move to their units once.
    """
    lines = labelled.where(~F.col("is_header"))
    numbers = stored(lines.select("work_id", "line_no", "chapter_idx", F.floor(F.col("line_no") / BLOCK).alias("block"), (F.col("line_chars") > threshold).alias("long")), "numbers")
    after = prefix.scan(numbers, "work_id", "block", [F.col("line_no")], latest={"before": F.col("chapter_idx")})
    begun = after.withColumn("begins", (F.col("long") | ~F.col("before").eqNullSafe(F.col("chapter_idx"))).cast("long"))
    placed = prefix.scan(begun, "work_id", "block", [F.col("line_no")], sums={"earlier": F.col("begins")})
    rows = lines.join(placed.select("work_id", "line_no", (F.col("earlier") + F.col("begins")).alias("ord")), ["work_id", "line_no"])
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("line_no", "line"))), lambda x: x["line"]), "\n")
    made = rows.groupBy("work_id", "ord").agg(F.min("chapter_idx").alias("chapter_idx"), F.min("chapter_name").alias("chapter_name"), F.min("line_no").alias("start_line"), F.max("line_no").alias("end_line"), text.alias("text"))
    made = made.join(works.select("work_id", F.coalesce("work_short", F.substring("work_id", 1, 2)).alias("work_short")), "work_id", "left")
    short = F.coalesce("work_short", F.substring("work_id", 1, 2))
    return made.select("work_id", F.format_string("%s-%04d", short, "ord").alias("unit_id"), "ord", "chapter_idx", "chapter_name", "start_line", "end_line", "text", F.length("text").alias("chars"))


def chapter_stats(units: DataFrame) -> DataFrame:
    return units.groupBy("work_id", "chapter_idx").agg(F.min_by("chapter_name", "ord").alias("chapter_name"), F.count(F.lit(1)).alias("unit_count"), F.sum("chars").cast("long").alias("char_count"))


def segment_warnings(labelled: DataFrame, headers: DataFrame) -> DataFrame:
    """Works in which header lines and registered headers differ in number."""
    hits = labelled.where("is_header").groupBy("work_id").agg(F.count(F.lit(1)).alias("found"))
    want = headers.distinct().groupBy("work_id").agg(F.count(F.lit(1)).alias("expected"))
    both = want.join(hits, "work_id", "full_outer").select("work_id", F.coalesce("expected", F.lit(0)).alias("expected"), F.coalesce("found", F.lit(0)).alias("found"))
    return both.where("expected <> found")
