"""Running sums and last values over ordered rows of keys that may be of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def scan(df: DataFrame, key: str, block: str, within: list[Column], sums: dict[str, Column] | None = None, latest: dict[str, Column] | None = None) -> DataFrame:
    """df with, over all earlier rows of the same key, the sum of each column in sums and the last value that isn't null of each in latest.

    Rows are ordered by block, then by within. Only blocks are sorted by themselves; their ends, one row for each block, are what a key gathers. df is read
    for its rows and for those ends, so it should hold little but numbers.
    """
    sums, latest = sums or {}, latest or {}
    inner = W.partitionBy(key, block).orderBy(*within).rowsBetween(W.unboundedPreceding, -1)
    outer = W.partitionBy(key).orderBy(block).rowsBetween(W.unboundedPreceding, -1)
    inside = {f"{n}__in": F.coalesce(F.sum(c).over(inner), F.lit(0)) for n, c in sums.items()} | {f"{n}__in": F.last(c, ignorenulls=True).over(inner) for n, c in latest.items()}
    ends = df.groupBy(key, block).agg(*[F.sum(c).alias(f"{n}__end") for n, c in sums.items()], *[F.max_by(c, F.when(c.isNotNull(), F.struct(*within))).alias(f"{n}__end") for n, c in latest.items()])
    ends = ends.select(key, block, *[F.coalesce(F.sum(f"{n}__end").over(outer), F.lit(0)).alias(f"{n}__out") for n in sums], *[F.last(f"{n}__end", ignorenulls=True).over(outer).alias(f"{n}__out") for n in latest])
    joined = df.withColumns(inside).join(ends, [key, block])
    both = [(F.col(f"{n}__in") + F.col(f"{n}__out")).cast("long").alias(n) for n in sums] + [F.coalesce(f"{n}__in", f"{n}__out").alias(n) for n in latest]
    return joined.select(*[df[c] for c in df.columns], *both)
