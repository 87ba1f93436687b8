"""Stored stage tables, raw files and unit files."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType

from narrative_spark.functions import prefix

#: Decoders in the order in which they are tried.
LADDER = ("utf-8-sig", "utf-8", "gb18030", "gbk", "big5")
UNIT_SCHEMA = "work_id string, unit_id string, ord long, chapter_idx int, chapter_name string, start_line long, end_line long, text string, chars int, summary string, characters array<string>, locations array<string>, key_terms array<string>, entity_updates array<struct<name:string,type:string,status:string,note:string,aliases:array<string>,kind:string>>, plotline_updates array<struct<action:string,title:string,note:string>>, context_refs array<string>, recent_event struct<text:string>, state_snapshot string, degraded boolean"


_PLACES: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Deletes at its end the folders that stored and place made inside: for jobs whose result is written elsewhere by then."""
    _PLACES.append([])
    try:
        yield
    finally:
        for path in _PLACES.pop():
            for name in (path, f"{path}-out", f"{path}-checkpoint"):
                there = spark._jvm.org.apache.hadoop.fs.Path(name)
                there.getFileSystem(spark._jsc.hadoopConfiguration()).delete(there, True)


def place(spark: SparkSession, label: str) -> str:
    """A folder of its own under the one that the cluster names in spark.checkpoint.dir."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="spark-shared-")
        spark.conf.set("spark.checkpoint.dir", root)
    path = f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    if _PLACES:
        _PLACES[-1].append(path)
    return path


def stored(df: DataFrame, label: str) -> DataFrame:
    """df written to the folder that the cluster names in spark.checkpoint.dir, and read back: later steps read it instead of making it again."""
    path = place(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """Raw files: source_file, source_bytes, encoding, text with line feeds only, error. The first decoder that takes all bytes wins; none leaves encoding and text null."""

    @F.pandas_udf("struct<text:string,encoding:string>")
    def decode(content: pd.Series) -> pd.DataFrame:
        def one(raw: bytes) -> tuple[str | None, str | None]:
            for name in LADDER:
                try:
                    return raw.decode(name), name
                except UnicodeDecodeError:
                    continue
            return None, None

        return pd.DataFrame([one(bytes(x)) for x in content], columns=["text", "encoding"])

    files = spark.read.format("binaryFile").load(path).withColumn("d", decode("content"))
    text = F.regexp_replace("d.text", r"\r\n?", "\n")
    return files.select(F.col("path").alias("source_file"), F.col("length").alias("source_bytes"), F.col("d.encoding").alias("encoding"), text.alias("text"), F.when(F.col("d.encoding").isNull(), "undecodable").alias("error"))


def source_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Size and SHA-256 of each source file."""
    return spark.read.format("binaryFile").load(path).select(F.col("path").alias("source_file"), F.col("length").alias("source_bytes"), F.sha2("content", 256).alias("source_sha256"))


def work_manifest(files: DataFrame) -> DataFrame:
    """work_id, files, source_bytes, source_sha256 of each work, from its files (work_id, source_file, source_bytes, source_sha256): one hash that changes with any name or content.

    Files meet in 256 groups by the hash of their names, each in the order of the names, and the groups' hashes in theirs, so that a work of any number of files is hashed in parts.
    """
    group = F.substring(F.sha2("source_file", 256), 1, 2)
    listed = lambda a, b: F.sha2(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(a, b))), lambda x: F.concat(x[a], F.lit("\t"), x[b])), "\n"), 256)
    some = files.withColumn("group", group).groupBy("work_id", "group").agg(F.count(F.lit(1)).alias("files"), F.sum("source_bytes").alias("source_bytes"), listed("source_file", "source_sha256").alias("hash"))
    return some.groupBy("work_id").agg(F.sum("files").alias("files"), F.sum("source_bytes").alias("source_bytes"), listed("group", "hash").alias("source_sha256"))


@F.pandas_udf(LongType())
def _decoders(lines: pd.Series) -> pd.Series:
    """A bit for each decoder of the ladder that takes a line's bytes."""

    def takes(raw: bytes, name: str) -> bool:
        try:
            raw.decode(name)
        except UnicodeDecodeError:
            return False
        return True

    return pd.Series([sum(takes(bytes(x), name) << k for k, name in enumerate(LADDER)) for x in lines], dtype="int64")


@F.pandas_udf(StringType())
def _decoded(lines: pd.Series, names: pd.Series, first: pd.Series) -> pd.Series:
    def one(raw: bytes, name: str | None, begins: bool) -> str | None:
        return None if name is None else bytes(raw).decode("utf-8" if name == "utf-8-sig" and not begins else name)

    return pd.Series([one(*x) for x in zip(lines, names, first, strict=True)], dtype=object)


def read_raw_lines(spark: SparkSession, path: str) -> DataFrame:
    """source_file, encoding, line_no, line of raw files of any size, as read_raw's texts cut at line feeds; null lines (and encoding) for a file that no decoder takes.

    Spark deals byte ranges of files to tasks, which end at line feeds: no encoding of the ladder has that byte inside a character, so that characters stay whole. Each range tells which
    decoders take its lines; the first that takes all lines of a file is used for it. Returns that end a line, or stand alone, count as line feeds. Lines are numbered from 1 in each file.
    """
    raw = spark.read.option("lineSep", "\n").text(path).select(F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"), F.col("value").cast("binary").alias("raw"))
    raw = stored(raw, "raw")
    every = raw.groupBy("source_file").agg(F.bit_and(_decoders("raw")).alias("takes"))
    name = F.coalesce(*[F.when(F.col("takes").bitwiseAND(1 << k) != 0, F.lit(n)) for k, n in enumerate(LADDER)])
    files = every.select("source_file", name.alias("encoding"))
    starts = raw.groupBy("source_file").agg(F.min(F.struct("block", "at")).alias("start"))
    rows = raw.join(files, "source_file").join(starts, "source_file")
    text = _decoded("raw", "encoding", F.struct("block", "at") == F.col("start"))
    pieces = F.split(F.regexp_replace(F.col("text"), r"\r\z", ""), r"\r", -1)
    lines = rows.withColumn("text", text).select("source_file", "encoding", "block", "at", F.posexplode_outer(pieces).alias("k", "line"))
    lines = stored(lines.withColumn("k", F.coalesce("k", F.lit(0))), "lines")
    placed = prefix.scan(lines.select("source_file", "block", "at", "k"), "source_file", "block", [F.col("at"), F.col("k")], sums={"earlier": F.lit(1)})
    return lines.join(placed, ["source_file", "block", "at", "k"]).select("source_file", "encoding", (F.col("earlier") + 1).alias("line_no"), "line")


def read_units(spark: SparkSession, path: str) -> DataFrame:
    """Unit files (JSON lines) with defaults for what a line leaves out: empty lists and texts, 0, chars from the text, not degraded."""
    units = spark.read.schema(UNIT_SCHEMA).json(path).where("work_id is not null").select(*[f.split()[0] for f in UNIT_SCHEMA.split(", ")])
    kinds = dict(units.dtypes)
    default = {"string": F.lit(""), "int": F.lit(0), "bigint": F.lit(0).cast("long"), "boolean": F.lit(False)}
    keep = {"recent_event", "state_snapshot", "chars"}
    columns = [F.coalesce(c, F.array().cast(t) if t.startswith("array") else default[t]).alias(c) if c not in keep else F.col(c) for c, t in kinds.items()]
    return units.select(*columns).withColumn("chars", F.when(F.coalesce("chars", F.lit(0)) == 0, F.length("text")).otherwise(F.col("chars")))


def write_units(units: DataFrame, path: str) -> None:
    """Unit files (JSON lines), a folder for each work, as read_units reads them: the fields of UNIT_SCHEMA that units has."""
    names = [f.split()[0] for f in UNIT_SCHEMA.split(", ") if f.split()[0] in units.columns]
    units.select(*names, F.col("work_id").alias("work")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("work").json(path)


def write_stage(df: DataFrame, path: str) -> None:
    """One folder for each work; only the works in df are replaced."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("work_id").parquet(path)


def resolve_units(extracted: DataFrame, segmented: DataFrame) -> DataFrame:
    """Extracted units, and segmented ones of works without extracted units."""
    rest = segmented.join(extracted.select("work_id").distinct(), "work_id", "left_anti")
    return extracted.unionByName(rest, allowMissingColumns=True)
