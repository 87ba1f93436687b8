"""The state fold of works of any size: blocks of units side by side, each from the state before it.

What stands before a block is an aggregate over earlier units: entities by the names that were used (the first use of each, in order, decides which record it
names), plotlines by title, the last events, those pushed out and not yet digested, and the digests so far. Blocks hand on partial aggregates of their own
units only; for the blocks that hold an asked unit these are summed, and one task folds one block.
"""

from __future__ import annotations

import json
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from narrative_spark.functions import prefix
from narrative_spark.functions.text import ustrip
from narrative_spark.operators import state as S
from narrative_spark.sources.stages import stored

#: Orders of a block, and orders from which on a work is folded in blocks: shorter ones take one task less time than what stands before blocks would.
BLOCK, LONG = 4096, 1 << 15
BEFORE = "work_id string, block long, kind string, ord long, pos int, body string"


def ended(units: DataFrame, size: int = BLOCK) -> DataFrame:
    """work_id, ord, block, chapter_idx, degraded, ends (the unit is the last of a run of its chapter)."""
    rows = units.select("work_id", "ord", F.floor(F.col("ord") / size).alias("block"), "chapter_idx", F.coalesce("degraded", F.lit(False)).alias("degraded"))
    back = stored(rows, "units").withColumn("back", -F.col("block"))
    after = prefix.scan(back, "work_id", "back", [-F.col("ord")], latest={"after": F.col("chapter_idx")})
    return after.withColumn("ends", ~F.col("after").eqNullSafe(F.col("chapter_idx")) | F.col("after").isNull()).drop("back", "after")


def numbered(units: DataFrame, size: int = BLOCK) -> DataFrame:
    """ended, with run: a number for each run of a chapter."""
    return stored(prefix.scan(ended(units, size), "work_id", "block", [F.col("ord")], sums={"run": F.col("ends").cast("long")}), "numbers")


def _digested(compress: Callable[[list[dict]], str]):
    @F.pandas_udf("struct<done:boolean,digest:string>")
    def digest(events: pd.Series) -> pd.DataFrame:
        out = []
        for items in events:
            try:
                out.append((True, compress([{"order": int(e["order"]), "text": e["text"]} for e in items]).strip()))
            except Exception:  # noqa: BLE001
                out.append((False, None))
        return pd.DataFrame(out, columns=["done", "digest"])

    return digest


def pushed_out(units: DataFrame, numbers: DataFrame, compress: Callable[[list[dict]], str], n: int = S.RECENT, reads: int | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(events with place, events that n later ones pushed out: work_id, ord, event, push (the order at which that happened), archived (the order at whose
    chapter end they were digested, null where none was), archives: work_id, ord, chapter_idx, digest).

    A compressor that fails leaves events for the next chapter's end; only chapters that failed are tried again. reads: events of a chapter that the compressor looks at, where it
    doesn't read all.
    """
    events = stored(S._numbered(S._events(units)), "events")
    pushes = events.select("work_id", (F.col("place") - n).alias("place"), F.col("ord").alias("push"))
    pushed = events.select("work_id", "place", "ord", "event").join(pushes, ["work_id", "place"])
    pushed = pushed.join(numbers.select("work_id", F.col("ord").alias("push"), "run"), ["work_id", "push"])
    last = stored(numbers.where("ends").select("work_id", "run", F.col("ord").alias("at"), "chapter_idx"), "runs")
    waiting = stored(pushed.select("work_id", "ord", "event", "push", "run"), "pushed")
    every, known = waiting, None
    while True:
        rows = waiting
        if reads is not None:
            rows = rows.withColumn("rank", F.row_number().over(W.partitionBy("work_id", "run").orderBy("ord"))).where(F.col("rank") <= reads)
        made = rows.groupBy("work_id", "run").agg(F.sort_array(F.collect_list(F.struct(F.col("ord").alias("order"), F.col("event").alias("text")))).alias("events"))
        made = made.select("work_id", "run", _digested(compress)("events").alias("d")).select("work_id", "run", "d.*")
        known = stored(made if known is None else known.unionByName(made), "digests")
        # Of the chapters that failed the first of each work: its events wait for the next end of a chapter, whatever was found there.
        nexts = last.select("work_id", (F.col("run") - 1).alias("run"), F.col("run").alias("next"))
        failed = known.where("not done").join(nexts, ["work_id", "run"])
        first = stored(failed.groupBy("work_id").agg(F.min("run").alias("run"), F.min("next").alias("next")), "retried")
        if not first.limit(1).count():
            break
        every = stored(every.join(first, ["work_id", "run"], "left").withColumn("run", F.coalesce("next", "run")).drop("next"), "pushed")
        gone = first.select("work_id", F.explode(F.array("run", "next")).alias("run"))
        known = known.join(gone, ["work_id", "run"], "left_anti")
        waiting = every.join(first.select("work_id", F.col("next").alias("run")), ["work_id", "run"], "left_semi")
    done = known.where("done")
    archives = done.join(last, ["work_id", "run"]).select("work_id", F.col("at").alias("ord"), "chapter_idx", "digest", "run")
    placed = every.join(archives.select("work_id", "run", F.col("ord").alias("archived")), ["work_id", "run"], "left").drop("run")
    return events, placed, archives.drop("run")


def _partials(units: DataFrame, size: int) -> dict[str, DataFrame]:
    """Of each block: its entities by group and name, its plotlines by title, its last order."""
    live = units.where(~F.coalesce("degraded", F.lit(False))).withColumn("block", F.floor(F.col("ord") / size))
    text = lambda c: ustrip(F.coalesce(c, F.lit("")))
    at = F.struct("ord", "pos")
    latest = lambda c: F.max(F.when(F.col(c) != "", F.struct("ord", "pos", F.col(c).alias("value")))).alias(c)
    first = lambda *more: F.min(F.struct("ord", "pos", *more)).alias("first")
    kind = text(F.coalesce("u.type", F.lit("character")))
    e = live.select("work_id", "block", "ord", F.posexplode("entity_updates").alias("pos", "u"))
    e = e.select("work_id", "block", "ord", "pos", F.when(kind.isin(*S.GROUPS), kind).otherwise("character").alias("group"), text(F.col("u.name")).alias("name"), text(F.col("u.status")).alias("status"), text(F.col("u.note")).alias("note"), text(F.when(F.col("u.kind") != "", F.col("u.kind")).otherwise("object")).alias("kind"), F.col("u.aliases").alias("aliases")).where("name <> ''")
    place = F.col("group") == "location"
    e = e.withColumns({"note": F.when(place & (F.col("note") == ""), F.col("status")).otherwise(F.col("note")), "status": F.when(place, "").otherwise(F.col("status")), "kind": F.when(F.col("group") == "object", F.col("kind")).otherwise("")})
    entities = e.groupBy("work_id", "block", "group", "name").agg(first("aliases"), F.max("ord").alias("last"), latest("status"), latest("note"), latest("kind"))
    p = live.select("work_id", "block", "ord", F.posexplode("plotline_updates").alias("pos", "u"))
    p = p.select("work_id", "block", "ord", "pos", text(F.col("u.title")).alias("title"), text(F.coalesce("u.action", F.lit("advance"))).alias("action"), text(F.col("u.note")).alias("note")).where("title <> ''")
    plots = p.groupBy("work_id", "block", "title").agg(F.min(at).alias("first"), F.max(F.when(F.col("action") == "close", F.col("ord"))).alias("closed"), F.array_sort(F.collect_set("ord")).alias("orders"), latest("note"))
    last = live.groupBy("work_id", "block").agg(F.max("ord").alias("last"))
    return {"entity": entities, "plot": plots, "last": last}


def before_blocks(units: DataFrame, numbers: DataFrame, wanted: DataFrame, compress: Callable[[list[dict]], str], size: int = BLOCK, reads: int | None = None) -> DataFrame:
    """The state before each wanted block (work_id, block), as rows of its parts: kind, ord and pos (their order), body (JSON)."""
    asked = wanted.groupBy("work_id").agg(F.sort_array(F.collect_set("block")).alias("asked__"))
    later = lambda rows, test: rows.join(asked, "work_id").withColumn("w", F.explode(F.filter("asked__", test))).drop("asked__")
    parts = {k: later(df, lambda w: w > F.col("block")).drop("block") for k, df in _partials(units, size).items()}
    events, pushed, archives = pushed_out(units, numbers, compress, reads=reads)
    row = lambda kind, at, pos, *body: [F.col("w").alias("block"), F.lit(kind).alias("kind"), at.cast("long").alias("ord"), pos.cast("int").alias("pos"), F.to_json(F.struct(*body)).alias("body")]
    zero = F.lit(0)
    entities = parts["entity"].groupBy("work_id", "w", "group", "name").agg(F.min("first").alias("first"), F.max("last").alias("last"), *[F.max(c).alias(c) for c in ("status", "note", "kind")])
    entities = entities.select("work_id", *row("entity", F.col("first.ord"), F.col("first.pos"), "group", "name", F.col("first.aliases").alias("aliases"), "last", "status", "note", "kind"))
    plots = parts["plot"].groupBy("work_id", "w", "title").agg(F.min("first").alias("first"), F.max("closed").alias("closed"), F.array_sort(F.flatten(F.collect_list("orders"))).alias("orders"), F.max("note").alias("note"))
    plots = plots.select("work_id", *row("plot", F.col("first.ord"), F.col("first.pos"), "title", "closed", "orders", "note"))
    lasts = parts["last"].groupBy("work_id", "w").agg(F.max("last").alias("last")).select("work_id", *row("last", zero, zero, "last"))
    block = lambda c: F.floor(F.col(c) / size)
    each = lambda df: df.select("work_id", *row("event", F.col("ord"), zero, F.col("ord").alias("order"), F.col("event").alias("text"), "held"))
    held = later(pushed.withColumns({"from": block("push"), "upto": F.coalesce(block("archived"), F.lit(1 << 62))}), lambda w: (w > F.col("from")) & (w <= F.col("upto")))
    counted = later(events.groupBy("work_id", block("ord").alias("block")).agg(F.count(F.lit(1)).alias("n")), lambda w: w > F.col("block")).groupBy("work_id", "w").agg(F.sum("n").alias("n"))
    places = counted.select("work_id", "w", F.explode(F.sequence(F.greatest(F.col("n") - S.RECENT + 1, F.lit(1)), F.col("n"))).alias("place"))
    recent = places.join(events, ["work_id", "place"])
    # Each digest takes two signs of the backdrop at least.
    early = archives.where("digest <> ''").withColumn("rank", F.row_number().over(W.partitionBy("work_id").orderBy("ord"))).where(F.col("rank") <= S.BACKDROP // 2 + 1)
    digests = later(early.withColumn("block", block("ord")), lambda w: w > F.col("block")).select("work_id", *row("digest", F.col("ord"), zero, "digest"))
    out = [entities, plots, lasts, each(held.withColumn("held", F.lit(True))), each(recent.withColumn("held", F.lit(False))), digests]
    made = out[0]
    for more in out[1:]:
        made = made.unionByName(more)
    return made


def restored(work_id: str, rows: list[tuple[str, int, int, str]]) -> S.Story:
    """A story from the rows (kind, ord, pos, body) of the state before a block."""
    story, fields, digests = S.Story(work_id), {}, []
    state = story.state
    for kind, order, _, body in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        b = json.loads(body)
        if kind == "entity":
            group = S.GROUPS[b["group"]]
            records = state[group]
            k = story.index.get((group, b["name"]))
            if k is None:
                k = len(records)
                records.append({"name": b["name"], "aliases": [str(a) for a in b.get("aliases") or []] if group == "characters" else [], "first_seen_order": order, "last_seen_order": order})
                story._name(group, k, records[k])
            records[k]["last_seen_order"] = max(records[k]["last_seen_order"], b["last"])
            for field in ("status", "note", "kind"):
                if b.get(field):
                    found = (b[field]["ord"], b[field]["pos"], b[field]["value"])
                    fields[group, k, field] = max(found, fields.get((group, k, field), found))
        elif kind == "plot":
            line = {"title": b["title"], "status": "closed" if b.get("closed") else "open", "opened_order": order, "closed_order": b.get("closed"), "key_orders": b["orders"], "summary": (b.get("note") or {}).get("value", "")}
            state["plotlines"].append(line)
            story.titles[b["title"]] = line
        elif kind == "event":
            state["backdrop_buffer" if b["held"] else "recent"].append({"order": b["order"], "text": b["text"]})
        elif kind == "digest":
            digests.append(b["digest"])
        else:
            state["last_order"] = b["last"]
    for (group, k, field), (_, _, value) in fields.items():
        state[group][k][field] = value
    state["backdrop"] = "；".join(digests)[: S.BACKDROP]
    return story


def fold_blocks(units: DataFrame, compress: Callable[[list[dict]], str] = S.joined, keep: str = "unit", marked: DataFrame | None = None, size: int = BLOCK) -> DataFrame:
    """As state.fold_state, in blocks of size orders: no task holds more than one of them and the state before it. The same snapshots."""
    numbers = numbered(units, size)
    if marked is not None:
        numbers = numbers.join(marked.select("work_id", "ord").distinct().withColumn("marked", F.lit(True)), ["work_id", "ord"], "left").withColumn("marked", F.coalesce("marked", F.lit(False)))
    final = numbers.groupBy("work_id").agg(F.max("ord").alias("ord"))
    asked: dict[str, Callable[[], DataFrame]] = {"unit": lambda: numbers, "chapter": lambda: numbers.where("ends"), "work": lambda: numbers.join(final, ["work_id", "ord"], "left_semi"), "marked": lambda: numbers.where("marked")}
    wanted = stored(asked[keep]().select("work_id", "block").distinct(), "wanted")
    rows = units.select("work_id", "ord", "entity_updates", "plotline_updates", "recent_event")
    flags = numbers.join(final.select("work_id", F.col("ord").alias("final")), "work_id").withColumn("final", F.col("ord") == F.col("final"))
    rows = rows.join(flags.join(wanted, ["work_id", "block"], "left_semi"), ["work_id", "ord"])
    # Works of one block have nothing before it.
    starts = numbers.groupBy("work_id").agg(F.min("block").alias("first"))
    wide = wanted.join(starts, "work_id").where("block > first").select("work_id", "block")
    before = None
    if wide.limit(1).count():
        large = wide.select("work_id").distinct()
        before = before_blocks(units.join(large, "work_id", "left_semi"), numbers.join(large, "work_id", "left_semi"), wide, compress, size, getattr(compress, "reads", None))

    def fold(now: pd.DataFrame, then: pd.DataFrame | None = None) -> pd.DataFrame:
        out: list[tuple] = []
        if len(now):
            found = now.sort_values("ord").to_dict("records")
            story = restored(found[0]["work_id"], list(then[["kind", "ord", "pos", "body"]].itertuples(index=False, name=None)) if then is not None else [])
            for r in found:
                # The chapter after the last one is whatever makes it end, or not.
                after = None if r["ends"] else r["chapter_idx"]
                out += S.fold_rows(story, [r], compress, bool(r["final"]), after, keep)
        return pd.DataFrame(out, columns=[x.split()[0] for x in S.SNAPSHOTS.split(", ")])

    if before is None:
        return rows.groupBy("work_id", "block").applyInPandas(lambda now: fold(now), S.SNAPSHOTS)
    # Columns of their own, as both come from the same units.
    rows, before = rows.toDF(*rows.columns), before.toDF(*before.columns)
    return rows.groupBy("work_id", "block").cogroup(before.groupBy("work_id", "block")).applyInPandas(fold, S.SNAPSHOTS)


def archived(units: DataFrame, compress: Callable[[list[dict]], str] = S.joined, size: int = BLOCK) -> DataFrame:
    """work_id, ord, chapter_idx, digest, backdrop after each end of a chapter at which a compressor digested what n later events had pushed out; one that fails leaves events
    for the next chapter's end."""
    _, _, archives = pushed_out(units, numbered(units, size), compress, reads=getattr(compress, "reads", None))
    archives = stored(archives, "archives")
    early = archives.where("digest <> ''").withColumn("rank", F.row_number().over(W.partitionBy("work_id").orderBy("ord"))).where(F.col("rank") <= S.BACKDROP // 2 + 1)
    early = early.groupBy("work_id").agg(F.sort_array(F.collect_list(F.struct("ord", "digest"))).alias("early"))
    so_far: Column = F.array_join(F.transform(F.filter("early", lambda x: x["ord"] <= F.col("ord")), lambda x: x["digest"]), "；")
    return archives.join(early, "work_id", "left").select("work_id", "ord", "chapter_idx", "digest", F.substring(F.coalesce(so_far, F.lit("")), 1, S.BACKDROP).alias("backdrop"))


def fold(units: DataFrame, compress: Callable[[list[dict]], str] = S.joined, keep: str = "unit", marked: DataFrame | None = None, size: int = BLOCK, long: int = LONG) -> DataFrame:
    """As state.fold_state: whole works side by side where none reaches long orders, else in blocks of size. units should be cheap to read, as they are read more than once."""
    longest = units.agg(F.max("ord")).first()[0] or 0
    return S.fold_state(units, compress, keep, marked) if longest < long else fold_blocks(units, compress, keep, marked, size)
