"""Raw text to numbered lines.

raw: work_id, part (order of a work's files), text. lines: work_id, part, line_no (from 1 through the whole work, blank lines
counted), line.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from narrative_spark.functions.text import ustrip


def normalize_lines(raw: DataFrame) -> DataFrame:
    """Lines that aren't blank, stripped, with their original numbers. Only line feeds end a line, after other newlines are made so."""
    text = F.coalesce("text", F.lit(""))
    text = F.when(text.contains("\r"), F.regexp_replace(text, r"\r\n?", "\n")).otherwise(text)
    parts = raw.select("work_id", "part", text.alias("text"))
    n = F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1
    first = parts.groupBy("work_id", "part").agg(F.sum(n).alias("n")).select("work_id", "part", F.coalesce(F.sum("n").over(W.partitionBy("work_id").orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("first"))
    rows = parts.join(first, ["work_id", "part"]).select("work_id", "part", "first", F.posexplode(F.split("text", "\n", -1)).alias("at", "line"))
    return rows.select("work_id", "part", (F.col("first") + F.col("at") + 1).cast("long").alias("line_no"), ustrip(F.col("line")).alias("line")).where("line <> ''")


def split_title(lines: DataFrame, works: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(body lines, titles): the first line is the title's where title_is_first_line is true or not set; the registry's title comes first."""
    first = lines.groupBy("work_id").agg(F.min_by(F.struct("line_no", "line"), "line_no").alias("f"))
    titles = first.join(works.select("work_id", "title", "title_is_first_line"), "work_id", "left")
    own = F.coalesce("title_is_first_line", F.lit(True))
    titles = titles.select("work_id", F.coalesce("title", "f.line").alias("title"), F.when(own, F.col("f.line_no")).alias("title_line"))
    body = lines.join(titles.select("work_id", "title_line"), "work_id").where("title_line is null or line_no > title_line").drop("title_line")
    return body, titles


def normalize_stats(body: DataFrame) -> DataFrame:
    """Lines of each work, and code points of its body with a line feed between lines."""
    return body.groupBy("work_id").agg(F.count(F.lit(1)).alias("line_count_body"), (F.sum(F.length("line")) + F.count(F.lit(1)) - 1).cast("long").alias("char_count_body"))
