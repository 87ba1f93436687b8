"""The cache of a chain of results: each depends on the state that all results before it left.

A row of the cache holds what a result was made from (key, from the state's fingerprint before the unit and the unit's own inputs) and the fingerprint that the state had after it.
Whether a unit hits can be told only where all units before it hit. So blocks of a work's units first find out side by side where each fingerprint that
may come in leads; the blocks' answers, one row for each, then meet in order; and units on the way that was taken are hits.
"""

from __future__ import annotations

import hashlib
import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from narrative_spark.functions import prefix
from narrative_spark.operators.extract import cache_key
from narrative_spark.operators.state import Story
from narrative_spark.sources.stages import stored

#: Units of a work that one task follows.
BLOCK = 4096
CACHE = "namespace string, work_id string, ord long, own string, before string, key string, after string, fields_json string"


def namespace(identity: dict) -> str:
    """The part of the cache for one way of extracting: digest of its identity (model, versions and whatever changes results)."""
    return hashlib.sha256(json.dumps(identity, ensure_ascii=False, sort_keys=True).encode()).hexdigest()[:16]


def chain_key(version: str, before: Column, text: Column, earlier: Column, related_version: str, related: Column) -> Column:
    """Key of a result: version, fingerprint of the state before it, text, texts of the units before it (array), and related history, joined by line feeds."""
    return cache_key(F.lit(version), before, text, F.when(F.size(earlier) > 0, F.array_join(F.transform(earlier, lambda t: F.coalesce(t, F.lit(""))), "\n")), F.lit(related_version), related)


@F.pandas_udf(StringType())
def _empty_state(works: pd.Series) -> pd.Series:
    return works.map(lambda w: hashlib.sha256(Story(w).snapshot().encode()).hexdigest())


def keyed(units: DataFrame, version: str, related_version: str = "") -> DataFrame:
    """units (work_id, ord, text, earlier: texts of the units before, related) with own: digest of a unit's inputs but for the state."""
    inputs = chain_key(version, F.lit(""), F.col("text"), F.col("earlier"), related_version, F.col("related"))
    return units.withColumn("own", inputs)


def states_around(snapshots: DataFrame) -> DataFrame:
    """work_id, ord, before, after: fingerprints of the state around each unit, from the fold's (work_id, ord, fingerprint); that before the first unit is the empty state's."""
    rows = stored(snapshots.select("work_id", "ord", "fingerprint", F.floor(F.col("ord") / BLOCK).alias("block")), "fingerprints")
    earlier = prefix.scan(rows, "work_id", "block", [F.col("ord")], latest={"earlier": F.col("fingerprint")})
    return earlier.select("work_id", "ord", F.coalesce("earlier", _empty_state("work_id")).alias("before"), F.col("fingerprint").alias("after"))


def chain_append(results: DataFrame, name: str, version: str, related_version: str = "") -> DataFrame:
    """Rows for the cache from results (keyed units with fields_json, degraded, before, after). Degraded results are never kept."""
    key = chain_key(version, F.col("before"), F.col("text"), F.col("earlier"), related_version, F.col("related"))
    return results.where(~F.coalesce("degraded", F.lit(False))).select(F.lit(name).alias("namespace"), "work_id", "ord", "own", "before", key.alias("key"), "after", "fields_json")


def _walk(rows: list[tuple], start: str, first: int, last: int) -> tuple[list[tuple], str | None]:
    """(the rows (ord, before, after, ...) on the way from the state start through the places first to last, the state at its end; null where the way ends before)."""
    at = {(r[0], r[1]): r for r in rows}
    way, now = [], start
    for place in range(first, last + 1):
        row = at.get((place, now))
        if row is None:
            return way, None
        way.append(row)
        now = row[2]
    return way, now


def chain_split(units: DataFrame, cache: DataFrame, name: str, force: bool = False, size: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """(hits: the units with key and fields_json, misses) of keyed units: of each work the longest run of first units whose results are all in the cache, each made from the state that
    the one before left. The first miss makes all later units misses, as its result isn't known. force finds no hit."""
    numbers = stored(units.select("work_id", "ord", "own", F.floor(F.col("ord") / size).alias("given")), "keyed")
    placed = prefix.scan(numbers, "work_id", "given", [F.col("ord")], sums={"place": F.lit(1)}).drop("given").withColumn("block", F.floor(F.col("place") / size))
    known = cache.where((F.col("namespace") == name) & F.lit(not force)).groupBy("work_id", "ord", "own", "before").agg(F.max(F.struct("key", "after")).alias("k"))
    placed = stored(placed, "placed")
    found = stored(placed.join(known, ["work_id", "ord", "own"]).select("work_id", "block", "place", "before", "k.after", "k.key"), "found")
    ends = placed.groupBy("work_id", "block").agg(F.min("place").alias("first"), F.max("place").alias("last"))
    rows = found.join(ends, ["work_id", "block"])

    def lead(part: pd.DataFrame) -> pd.DataFrame:
        """Where each state that may come in at the block's first unit leads."""
        items = list(part[["place", "before", "after"]].itertuples(index=False, name=None))
        first, last = int(part["first"].iloc[0]), int(part["last"].iloc[0])
        came = [r[1] for r in items if r[0] == first]
        return pd.DataFrame([(part["work_id"].iloc[0], int(part["block"].iloc[0]), b, _walk(items, b, first, last)[1]) for b in came], columns=["work_id", "block", "came", "went"])

    leads = rows.groupBy("work_id", "block").applyInPandas(lead, "work_id string, block long, came string, went string")

    def follow(part: pd.DataFrame) -> pd.DataFrame:
        """The state with which each block is reached, block by block."""
        now = part["empty"].iloc[0]
        ways = {(int(b), c): w for b, c, w in part[["block", "came", "went"]].itertuples(index=False, name=None)}
        out = []
        for block in range(int(part["block"].max()) + 1):
            if (block, now) not in ways:
                break
            out.append((part["work_id"].iloc[0], block, now))
            now = ways[block, now]
        return pd.DataFrame(out, columns=["work_id", "block", "reached"])

    reached = leads.withColumn("empty", _empty_state("work_id")).groupBy("work_id").applyInPandas(follow, "work_id string, block long, reached string")

    def take(part: pd.DataFrame) -> pd.DataFrame:
        items = list(part[["place", "before", "after", "key"]].itertuples(index=False, name=None))
        way, _ = _walk(items, part["reached"].iloc[0], int(part["first"].iloc[0]), int(part["last"].iloc[0]))
        return pd.DataFrame([(part["work_id"].iloc[0], int(r[0]), r[3]) for r in way], columns=["work_id", "place", "key"])

    rows = rows.toDF(*rows.columns).join(stored(reached, "reached"), ["work_id", "block"])
    taken = rows.groupBy("work_id", "block").applyInPandas(take, "work_id string, place long, key string")
    hits = stored(taken.join(placed.select("work_id", "place", "ord"), ["work_id", "place"]).select("work_id", "ord", "key"), "hits")
    fields = cache.where(F.col("namespace") == name).groupBy("work_id", "key").agg(F.max("fields_json").alias("fields_json"))
    return units.join(hits, ["work_id", "ord"]).join(fields, ["work_id", "key"]), units.join(hits, ["work_id", "ord"], "left_anti")
