"""The given tables in the shapes that the operators take."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from narrative_spark.operators import normalize, segment
from narrative_spark.sources import stages


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as the files of a work for each source, each under a header line of its own."""
    docs = table(spark, sf_dir, "documents")
    return docs.select(F.col("source").alias("work_id"), F.col("doc_id").alias("part"), F.concat(F.format_string("== %d ==\n", "doc_id"), F.coalesce("text", F.lit(""))).alias("text"))


def works(spark: SparkSession, sf_dir: str, title_first: bool = False) -> DataFrame:
    return table(spark, sf_dir, "documents").select(F.col("source").alias("work_id")).distinct().withColumns({"title": F.lit(None).cast("string"), "title_is_first_line": F.lit(title_first), "work_short": F.col("work_id")})


def headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(F.col("source").alias("work_id"), F.format_string("== %d ==", "doc_id").alias("header"))


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize.normalize_lines(raw(spark, sf_dir))


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    body, _ = normalize.split_title(stages.stored(lines(spark, sf_dir), "lines"), works(spark, sf_dir))
    return segment.label_chapters(body, headers(spark, sf_dir))


def units(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    """Units, from labelled lines where a job has them already."""
    return segment.segment_units(labelled(spark, sf_dir) if lines is None else lines, works(spark, sf_dir))


def queries(spark: SparkSession, sf_dir: str, units: DataFrame, whole: bool = False) -> DataFrame:
    """Whole benchmark items asked of a work each: three of four within a quarter, a half or three quarters of its units; whole: all of them of all units."""
    item = F.col("item_id")
    asked = table(spark, sf_dir, "benchmark").select(item, item.cast("string").alias("query_id"), F.concat(F.lit("src"), (item % 20).cast("string")).alias("work_id"), F.col("text").alias("query"), F.lit(None).cast("string").alias("chapter"))
    if whole:
        return asked.withColumn("max_order", F.lit(None).cast("long")).drop("item_id")
    last = units.groupBy("work_id").agg(F.max("ord").alias("last"))
    return asked.join(last, "work_id", "left").withColumn("max_order", F.when(item % 4 != 0, F.floor(F.col("last") * (item % 4) / 4))).drop("item_id", "last")


def talk_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as works: a turn is a unit, a run of one role a chapter."""
    talks = table(spark, sf_dir, "conversations")
    order = W.partitionBy("conv_id").orderBy("turn")
    rows = talks.withColumn("new", F.when(F.lag("role").over(order).eqNullSafe(F.col("role")), 0).otherwise(1))
    return rows.select(F.col("conv_id").cast("string").alias("work_id"), F.format_string("%d-%04d", "conv_id", F.col("turn") + 1).alias("unit_id"), (F.col("turn") + 1).alias("ord"), F.sum("new").over(order).cast("int").alias("chapter_idx"), F.col("role").alias("chapter_name"), (F.col("turn") + 1).alias("start_line"), (F.col("turn") + 1).alias("end_line"), "text", F.length("text").alias("chars"))


def delta_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as the deltas of a work for each user."""
    order = W.partitionBy("user_id").orderBy("ts", "event_id")
    key = F.regexp_extract("props", r"(\d+)", 1).cast("long") % 10
    rows = table(spark, sf_dir, "events").withColumns({"ord": F.row_number().over(order).cast("long"), "k": F.coalesce(key, F.lit(0))})
    kind = F.element_at(F.array(F.lit("character"), F.lit("object"), F.lit("location")), (F.col("event_id") % 3 + 1).cast("int"))
    entity = F.struct(F.col("event_type").alias("name"), kind.alias("type"), F.when(F.col("event_id") % 3 == 0, F.lit("")).otherwise(F.col("event_id").cast("string")).alias("status"), F.when(F.col("event_id") % 2 == 0, F.concat(F.lit("n"), F.col("event_id").cast("string"))).otherwise(F.lit("")).alias("note"), F.lit(None).cast("array<string>").alias("aliases"), F.lit(None).cast("string").alias("kind"))
    action = F.when(F.col("event_type") == "signup", "open").when(F.col("event_type") == "purchase", "close").otherwise("advance")
    plot = F.struct(action.alias("action"), F.concat(F.lit("k"), F.col("k").cast("string")).alias("title"), F.when(F.col("event_id") % 2 == 1, F.concat(F.lit("p"), F.col("event_id").cast("string"))).otherwise(F.lit("")).alias("note"))
    event = F.when(F.col("event_type") != "view", F.struct(F.concat_ws(" ", "event_type", F.col("event_id").cast("string")).alias("text")))
    chapter = F.floor((F.col("ord") - 1) / 20).cast("int")
    return rows.select(F.col("user_id").cast("string").alias("work_id"), F.format_string("u%d-%04d", "user_id", "ord").alias("unit_id"), "ord", chapter.alias("chapter_idx"), F.format_string("part %d", chapter).alias("chapter_name"), F.concat_ws(" ", "event_type", "props").alias("text"), F.array(entity).alias("entity_updates"), F.array(plot).alias("plotline_updates"), event.alias("recent_event"), (F.col("event_type") == "error").alias("degraded"))
