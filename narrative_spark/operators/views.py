"""What a reader may see: views of works, units and states up to the reader's position."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from narrative_spark.functions import prefix
from narrative_spark.sources.stages import stored

RECENT = 5
#: Fields of a snapshot that hold an order, and its lists of records.
ORDER_FIELDS = frozenset("order last_order first_seen_order last_seen_order opened_order closed_order".split())
RECORDS = ("characters", "objects", "locations", "plotlines", "recent", "backdrop_buffer")
#: Orders that one sort, or one join of a range, takes together.
BLOCK = 4096


def list_works(units: DataFrame, works: DataFrame, lexical: DataFrame | None = None, vector: DataFrame | None = None) -> DataFrame:
    """Works with their unit counts, titles, and whether they are among the works of a lexical and of a vector index."""
    rows = units.groupBy("work_id").agg(F.count(F.lit(1)).alias("unit_count")).join(works.select("work_id", "title"), "work_id", "left")
    for name, index in (("has_index", lexical), ("has_vector_index", vector)):
        if index is None:
            rows = rows.withColumn(name, F.lit(False))
        else:
            known = index.select("work_id").distinct().withColumn(name, F.lit(True))
            rows = rows.join(known, "work_id", "left").withColumn(name, F.coalesce(name, F.lit(False)))
    return rows


def reading_locations(units: DataFrame) -> DataFrame:
    """Runs of one chapter in reading order, without anything of their content."""
    rows = units.select("work_id", "ord", "chapter_idx", "chapter_name", "start_line", "end_line", F.floor(F.col("ord") / BLOCK).alias("block"))
    chapter = F.struct("chapter_idx", "chapter_name")
    after = prefix.scan(rows, "work_id", "block", [F.col("ord")], latest={"before": chapter})
    fresh = after.withColumn("fresh", (~F.col("before").eqNullSafe(chapter)).cast("long")).drop("before")
    runs = prefix.scan(fresh, "work_id", "block", [F.col("ord")], sums={"run": F.col("fresh")}).withColumn("run", F.col("run") + F.col("fresh"))
    rows = runs.groupBy("work_id", "run", "chapter_idx", "chapter_name").agg(F.min("ord").alias("start_order"), F.max("ord").alias("end_order"), F.min_by("start_line", "ord").alias("start_line"), F.max_by("end_line", "ord").alias("end_line"), F.count(F.lit(1)).alias("unit_count"))
    label = F.when(F.coalesce("chapter_name", F.lit("")) != "", F.col("chapter_name")).otherwise(F.concat(F.lit("第 "), F.col("chapter_idx").cast("string"), F.lit(" 章")))
    return rows.select("work_id", F.format_string("chapter-%02d", "chapter_idx").alias("location_id"), label.alias("label"), "start_order", "end_order", "start_line", "end_line", "unit_count")


def get_units(units: DataFrame, wanted: DataFrame) -> DataFrame:
    """Units by work and id."""
    return units.join(wanted.select("work_id", "unit_id").distinct(), ["work_id", "unit_id"], "left_semi")


def get_range(units: DataFrame, ranges: DataFrame) -> DataFrame:
    """Units of each asked range (range_id, work_id, low, high). Ranges meet only the blocks of units that they reach into."""
    block = lambda c: F.floor(c / BLOCK)
    ends = units.groupBy("work_id").agg(F.min("ord").alias("first__"), F.max("ord").alias("last__"))
    low, high = F.greatest("low", "first__"), F.least("high", "last__")
    asked = ranges.join(ends, "work_id").where(low <= high).withColumn("block__", F.explode(F.sequence(block(low), block(high)))).drop("first__", "last__")
    return asked.join(units.withColumn("block__", block(F.col("ord"))), ["work_id", "block__"]).where(F.col("ord").between(F.col("low"), F.col("high"))).drop("block__")


@F.pandas_udf(StringType())
def _fault(snapshot: pd.Series, work: pd.Series, order: pd.Series) -> pd.Series:
    """What is wrong with a snapshot, or null. Types are checked in the JSON itself, where a boolean is no order."""

    def inside(n: object) -> bool:
        return type(n) is int and 0 <= n <= now

    def orders(x: object) -> bool:
        if isinstance(x, list):
            return all(map(orders, x))
        if not isinstance(x, dict):
            return True
        for key, value in x.items():
            if key in ORDER_FIELDS:
                ok = value is None or inside(value)
            elif key == "key_orders":
                ok = isinstance(value, list) and all(map(inside, value))
            else:
                ok = orders(value)
            if not ok:
                return False
        return True

    out: list[str | None] = []
    for raw, own, now in zip(snapshot, work, order, strict=True):
        try:
            s = json.loads(raw) if raw else None
        except (ValueError, RecursionError):  # nested too deeply to be a snapshot
            s = None
        if not isinstance(s, dict):
            out.append("missing_snapshot")
        elif s.get("work_id") != own or s.get("last_order") != now:
            out.append("snapshot_identity")
        elif not isinstance(s.get("backdrop", ""), str):
            out.append("invalid_backdrop")
        elif not all(isinstance(s.get(g, []), list) and all(isinstance(r, dict) for r in s.get(g, [])) for g in RECORDS):
            out.append("invalid_group")
        else:
            out.append(None if orders(s) else "future_or_invalid_order")
    return pd.Series(out, dtype=object)


def validate_snapshots(snapshots: DataFrame) -> DataFrame:
    """snapshots (work_id, ord, snapshot, degraded) with reason; a degraded unit is named as such first."""
    fault = _fault("snapshot", "work_id", "ord")
    return snapshots.withColumn("fault__", fault).withColumn("reason", F.when(F.coalesce("degraded", F.lit(False)), "degraded_snapshot").otherwise(F.col("fault__"))).drop("fault__")


def read_units(units: DataFrame, readers: DataFrame) -> DataFrame:
    """work_id, max_order, ord: the last unit at or before each position that readers (work_id, max_order) stand at; ord is null where there is none.

    Only numbers are sorted, block by block.
    """
    seen = units.where("ord > 0").select("work_id", F.col("ord").alias("at"), F.lit(0).alias("side"), F.col("ord").alias("mine"))
    asked = readers.select("work_id", F.col("max_order").cast("long").alias("at"), F.lit(1).alias("side"), F.lit(None).cast("long").alias("mine")).distinct()
    both = seen.unionByName(asked).withColumn("block", F.floor(F.col("at") / BLOCK))
    found = prefix.scan(both, "work_id", "block", [F.col("at"), F.col("side")], latest={"ord": F.col("mine")})
    return found.where("side = 1").select("work_id", F.col("at").alias("max_order"), "ord")


def as_of(snapshots: DataFrame, readers: DataFrame) -> DataFrame:
    """readers (reader_id, work_id, max_order) with the last row of snapshots at or before their position: the place is found first, the row is then fetched."""
    asked = readers.select(F.col("reader_id").cast("string").alias("reader_id"), "work_id", F.col("max_order").cast("long").alias("max_order"))
    placed = asked.join(read_units(snapshots, readers), ["work_id", "max_order"], "left")
    return placed.join(snapshots, ["work_id", "ord"], "left").select("reader_id", "work_id", "max_order", "ord", *[c for c in snapshots.columns if c not in ("work_id", "ord")])


def progressive_view(snapshots: DataFrame, readers: DataFrame, units: DataFrame | None = None) -> DataFrame:
    """One row for each reader: status ok, invalid or unavailable, reason, snapshot order and snapshot. No older snapshot stands in for a bad one.

    With units, also provenance of a snapshot that is ok: kind, unit_id, order_range, chapter, and snapshot_line_range where units have lines.
    """
    seen = as_of(validate_snapshots(snapshots), readers)
    ok = F.col("ord").isNotNull() & F.col("reason").isNull()
    status = F.when(F.col("ord").isNull(), "unavailable").when(ok, "ok").otherwise("invalid")
    reason = F.when(F.col("ord").isNull(), "no_completed_unit").otherwise(F.col("reason"))
    more = []
    if units is not None:
        line = lambda c: units[c] if c in units.columns else F.lit(None).cast("long")
        source = units.select("work_id", "ord", F.struct(F.lit("progressive_snapshot").alias("kind"), units["unit_id"], F.array(F.lit(1).cast("long"), units["ord"]).alias("order_range"), units["chapter_name"].alias("chapter"), F.array(line("start_line"), line("end_line")).alias("snapshot_line_range")).alias("source__"))
        seen = seen.join(source, ["work_id", "ord"], "left")
        more = [F.when(ok, F.col("source__")).alias("provenance")]
    return seen.select("reader_id", "work_id", "max_order", status.alias("status"), reason.alias("reason"), F.col("ord").alias("snapshot_order"), F.when(ok, F.col("snapshot")).alias("snapshot"), *more)


def recap(snapshots: DataFrame, readers: DataFrame, recent: int = RECENT) -> DataFrame:
    """Backdrop and last events as of each reader; empty where nothing is readable or recent is 0."""
    s = F.from_json("snapshot", "backdrop string, recent array<struct<order:bigint,text:string>>")
    rows = as_of(snapshots, readers).withColumn("s__", s)
    items = F.coalesce("s__.recent", F.array().cast("array<struct<order:bigint,text:string>>"))
    last = F.slice(items, F.greatest(F.size(items) - recent + 1, F.lit(1)), recent) if recent > 0 else F.slice(items, 1, 0)
    return rows.select("reader_id", "work_id", "max_order", F.coalesce("s__.backdrop", F.lit("")).alias("backdrop"), last.alias("recent"))


def _grams(text: Column) -> Column:
    """Distinct pairs of neighbouring signs and single signs of text."""
    every = F.split(text, "")
    two = F.zip_with(F.slice(every, 1, F.size(every) - 1), F.slice(every, 2, F.size(every) - 1), lambda a, b: F.concat(a, b))
    return F.array_distinct(F.concat(every, two))


def _inside(small: DataFrame, large: DataFrame) -> DataFrame:
    """work_id, small, large: pairs of a work of which one text stands in the other, from (work_id, small) and (work_id, large), both distinct and not empty.

    Texts are indexed by their pairs of signs; the small one meets those only that hold its rarest pair (its sign, where it has but one), and is then looked for in them.
    """
    index = large.select("work_id", "large", F.explode(_grams(F.col("large"))).alias("gram"))
    spread = index.groupBy("work_id", "gram").agg(F.count(F.lit(1)).alias("n"))
    wanted = small.select("work_id", "small", F.explode(F.filter(_grams(F.col("small")), lambda g: F.length(g) == F.least(F.length("small"), F.lit(2)))).alias("gram"))
    rarest = wanted.join(spread, ["work_id", "gram"], "left").groupBy("work_id", "small").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram")).alias("least")).where("least.n > 0")
    rows = rarest.select("work_id", "small", F.col("least.gram").alias("gram")).join(index, ["work_id", "gram"])
    return rows.where(F.col("large").contains(F.col("small"))).select("work_id", "small", "large")


def _history(units: DataFrame, requests: DataFrame, column: str, field: str) -> DataFrame:
    """Updates whose name holds the asked name or is held by it. Requests are matched with the distinct names of their work first, by the signs they share."""
    rows = units.select("work_id", "unit_id", "ord", F.posexplode(column).alias("pos", "u")).withColumn("name", F.col("u")[field])
    names = stored(rows.select("work_id", "name").where("name <> ''").distinct(), "names")
    asked = requests.withColumn("asked", F.trim("name")).drop("name").where("asked <> ''")
    texts = stored(asked.select("work_id", "asked").distinct(), "asked")
    side = lambda df, c, to: df.select("work_id", F.col(c).alias(to))
    holds = _inside(side(texts, "asked", "small"), side(names, "name", "large")).select("work_id", F.col("small").alias("asked"), F.col("large").alias("name"))
    held = _inside(side(names, "name", "small"), side(texts, "asked", "large")).select("work_id", F.col("large").alias("asked"), F.col("small").alias("name"))
    pairs = asked.join(holds.unionByName(held).distinct(), ["work_id", "asked"]).select("request_id", "work_id", "max_order", "name")
    return pairs.join(rows, ["work_id", "name"]).where(F.col("ord") <= F.col("max_order")).select("request_id", "work_id", "ord", "unit_id", "pos", F.col("u").alias("update"))


def entity_history(units: DataFrame, requests: DataFrame) -> DataFrame:
    """requests (request_id, work_id, name, max_order) with each readable update of the entity."""
    return _history(units, requests, "entity_updates", "name")


def plotline_history(units: DataFrame, requests: DataFrame) -> DataFrame:
    """The same over plotline titles."""
    return _history(units, requests, "plotline_updates", "title")


def _grouped(records: Column, group: str) -> Column:
    return F.transform(records, lambda r: r.withField("group", F.lit(group)))


def _matching(snapshots: DataFrame, requests: DataFrame, schema: str, lists: tuple[str, ...], name: str) -> DataFrame:
    """request_id, work_id, c: the first record whose name holds the asked one or is held by it, list by list, in the last readable snapshot."""
    asked = requests.select(F.col("request_id").cast("string").alias("reader_id"), F.trim("name").alias("asked")).where("asked <> ''")
    seen = as_of(snapshots, requests.withColumnRenamed("request_id", "reader_id")).withColumn("s__", F.from_json("snapshot", schema)).join(asked, "reader_id")
    match = lambda r: (r[name] != "") & (r[name].contains(F.col("asked")) | F.col("asked").contains(r[name]))
    named = [_grouped(F.filter(F.col(f"s__.{g}"), match), g) for g in lists]
    found = F.concat(*[F.coalesce(x, F.array()) for x in named])
    return seen.select(F.col("reader_id").alias("request_id"), "work_id", F.get(found, F.lit(0)).alias("c")).where("c is not null")


def entity_current(snapshots: DataFrame, requests: DataFrame) -> DataFrame:
    """The entity's whole record in the last readable snapshot: first match in characters, then objects, then locations."""
    record = "array<struct<name:string,aliases:array<string>,kind:string,status:string,note:string,first_seen_order:bigint,last_seen_order:bigint>>"
    return _matching(snapshots, requests, f"characters {record}, objects {record}, locations {record}", ("characters", "objects", "locations"), "name").select("request_id", "work_id", "c.*")


def plotline_current(snapshots: DataFrame, requests: DataFrame) -> DataFrame:
    """The plotline's whole record in the last readable snapshot: the first whose title matches."""
    record = "array<struct<title:string,status:string,opened_order:bigint,closed_order:bigint,key_orders:array<bigint>,summary:string>>"
    return _matching(snapshots, requests, f"plotlines {record}", ("plotlines",), "title").select("request_id", "work_id", "c.*").drop("group")
