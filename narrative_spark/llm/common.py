"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Keys that may count as hot, and rows that a key may have without counting as hot.
HOT_KEYS, HOT_ROWS = 10_000, 10_000


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, as spark.checkpoint.dir names it. Where it is unset, a local session (tests) gets one of its own; a cluster has none."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.conf.get("spark.master", "").startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="spark-shared-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


_WRITTEN: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Deletes at its end the tables that materialize writes inside: for steps whose result is written elsewhere by then."""
    _WRITTEN.append([])
    try:
        yield
    finally:
        drop(spark, _WRITTEN.pop())


def drop(spark: SparkSession, paths: list[str]) -> None:
    """Delete folders that this session wrote."""
    for path in paths:
        there = spark._jvm.org.apache.hadoop.fs.Path(path)
        there.getFileSystem(spark._jsc.hadoopConfiguration()).delete(there, True)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write df as Parquet into the shared folder and read it back: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    if _WRITTEN:
        _WRITTEN[-1].append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def tidy(work):
    """A map over Arrow batches that gives freed memory back when its task ends: worker processes stay, and would keep it from later stages."""

    def run(batches):
        yield from work(batches)
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL("libc.so.6").malloc_trim(0)
        except (OSError, AttributeError):  # another C library
            pass

    return run


def text_or_empty(col: Column | str) -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def let(value: Column, body) -> Column:
    """body(x) with x bound to value, which is then evaluated once for each row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def unused(columns: list[str], wish: str) -> str:
    """wish, or wish with as many underscores behind it as it takes to be none of columns (case counts for nothing)."""
    taken = {c.lower() for c in columns}
    while wish.lower() in taken:
        wish += "_"
    return wish


def join_dealt(rows: DataFrame, one: DataFrame, key: str, count: str, by: Column, how: str = "left") -> DataFrame:
    """rows joined on key with one, which has a row for each key and in count how many of rows have it; key and count are dropped from one.

    A hot key has more than HOT_ROWS rows and more than a HOT_KEYS-th of all, so that there are HOT_KEYS of them at most: these few
    are sent to all tasks, their rows are dealt to shares by the hash of by, and only their row in one is repeated.
    """
    total = one.agg(F.sum(count)).first()[0] or 0
    most = max(HOT_ROWS, total // HOT_KEYS)
    taken = [*rows.columns, *one.columns]
    shares, salt = unused(taken, "shares"), unused(taken, "salt")
    dealt = one.withColumn(shares, F.greatest(F.lit(1), F.ceil(F.col(count) / most)).cast("int"))
    hot = F.broadcast(dealt.where(F.col(shares) > 1).select(key, shares))
    left = rows.join(hot, key, "left").withColumn(salt, F.pmod(F.xxhash64(by), F.coalesce(shares, F.lit(1))).cast("int")).drop(shares)
    right = dealt.withColumn(salt, F.explode(F.sequence(F.lit(0), F.col(shares) - 1))).drop(shares, count)
    return left.join(right, [key, salt], how).drop(salt)


def join_hot(rows: DataFrame, one: DataFrame, key: str | list[str], by: Column, total: int, how: str = "left") -> DataFrame:
    """rows joined on key with one, which has a row for each key; total: rows, or more. Hot keys as in join_dealt, but counted here; rows should be stored."""
    keys = [key] if isinstance(key, str) else key
    if total <= HOT_ROWS:
        return rows.join(one, keys, how)
    most = max(HOT_ROWS, total // HOT_KEYS)
    taken = [*rows.columns, *one.columns]
    shares, salt, count = (unused(taken, x) for x in ("shares", "salt", "rows_of_key"))
    counted = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias(count)).where(F.col(count) > most)
    hot = F.broadcast(counted.select(*keys, F.ceil(F.col(count) / most).cast("int").alias(shares)))
    own = F.coalesce(shares, F.lit(1))
    left = rows.join(hot, keys, "left").withColumn(salt, F.pmod(F.xxhash64(by), own.cast("long")).cast("int")).drop(shares)
    right = one.join(hot, keys, "left").withColumn(salt, F.explode(F.sequence(F.lit(0), own - 1))).drop(shares)
    return left.join(right, [*keys, salt], how).drop(salt)
