"""Story state: ordered deltas of a work folded to what is known after each unit.

Two forms of the same state. The aggregates below need no order of work inside a task and suit deltas without aliases; the fold keeps
whole snapshots and knows aliases. Degraded units change nothing.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from narrative_spark.functions import prefix
from narrative_spark.functions.text import ustrip
from narrative_spark.sources.stages import stored

#: Orders that one sort takes together.
BLOCK = 4096
RECENT, EVENT, BACKDROP, DIGEST = 5, 120, 300, 200
GROUPS = {"character": "characters", "object": "objects", "location": "locations"}


def _updates(units: DataFrame, column: str) -> DataFrame:
    return units.where(~F.coalesce("degraded", F.lit(False))).select("work_id", "ord", F.posexplode(column).alias("pos", "u"))


def entity_timeline(units: DataFrame) -> DataFrame:
    """Entities of each work by group and name: latest status and note that aren't empty, first and last order."""
    kind = F.when(F.col("u.type").isin(*GROUPS), F.col("u.type")).otherwise("character")
    rows = _updates(units, "entity_updates").select("work_id", kind.alias("type"), F.trim("u.name").alias("name"), F.trim(F.coalesce("u.status", F.lit(""))).alias("status"), F.trim(F.coalesce("u.note", F.lit(""))).alias("note"), "ord", F.struct("ord", "pos").alias("at")).where("name <> ''")
    text = F.when((F.col("type") == "location") & (F.col("note") == ""), F.col("status")).otherwise(F.col("note"))
    rows = rows.withColumn("note", text).withColumn("status", F.when(F.col("type") != "location", F.col("status")).otherwise(""))
    latest = lambda c: F.max_by(F.when(F.col(c) != "", F.col(c)), F.when(F.col(c) != "", F.col("at")))
    return rows.groupBy("work_id", "type", "name").agg(latest("status").alias("status"), latest("note").alias("note"), F.min("ord").alias("first_seen_order"), F.max("ord").alias("last_seen_order"))


def plotline_timeline(units: DataFrame) -> DataFrame:
    """Plotlines of each work by title: closed once closed, orders in which they moved, latest note that isn't empty."""
    rows = _updates(units, "plotline_updates").select("work_id", F.trim("u.title").alias("title"), F.col("u.action").alias("action"), F.trim(F.coalesce("u.note", F.lit(""))).alias("note"), "ord", F.struct("ord", "pos").alias("at")).where("title <> ''")
    closed = F.max(F.when(F.col("action") == "close", F.col("ord")))
    return rows.groupBy("work_id", "title").agg(F.when(closed.isNotNull(), "closed").otherwise("open").alias("status"), F.min("ord").alias("opened_order"), closed.alias("closed_order"), F.array_sort(F.collect_set("ord")).alias("key_orders"), F.coalesce(F.max_by(F.when(F.col("note") != "", F.col("note")), F.when(F.col("note") != "", F.col("at"))), F.lit("")).alias("summary"))


def _events(units: DataFrame) -> DataFrame:
    text = F.trim(F.coalesce("recent_event.text", F.lit("")))
    return units.where(~F.coalesce("degraded", F.lit(False))).select("work_id", "ord", "chapter_idx", F.substring(text, 1, EVENT).alias("event")).where("event <> ''")


def _numbered(events: DataFrame) -> DataFrame:
    """events (work_id, ord, ...) with place, from 1 in each work."""
    rows = prefix.scan(events.select("work_id", "ord", F.floor(F.col("ord") / BLOCK).alias("block__")), "work_id", "block__", [F.col("ord")], sums={"n__": F.lit(1)})
    return events.join(rows.select("work_id", "ord", (F.col("n__") + 1).alias("place")), ["work_id", "ord"])


def recent_events(units: DataFrame, n: int = RECENT) -> DataFrame:
    """work_id, ord, recent: the last n events (order, text) as of each unit. Units find the place of their last event, then fetch the n events up to it."""
    events = stored(_numbered(_events(units)).select("work_id", "ord", "place", F.struct(F.col("ord").alias("order"), F.col("event").alias("text")).alias("e")), "events")
    marked = units.select("work_id", "ord", F.floor(F.col("ord") / BLOCK).alias("block__")).join(events.select("work_id", "ord", "place"), ["work_id", "ord"], "left")
    last = prefix.scan(marked, "work_id", "block__", [F.col("ord")], latest={"before__": F.col("place")}).select("work_id", "ord", F.coalesce("place", "before__").alias("last"))
    wanted = last.where("last is not null").select("work_id", "ord", F.explode(F.sequence(F.greatest(F.col("last") - n + 1, F.lit(1).cast("long")), F.col("last"))).alias("place"))
    found = wanted.join(events.select("work_id", "place", "e"), ["work_id", "place"]).groupBy("work_id", "ord").agg(F.sort_array(F.collect_list("e")).alias("recent"))
    return units.select("work_id", "ord").join(found, ["work_id", "ord"], "left").withColumn("recent", F.coalesce("recent", F.array().cast(found.schema["recent"].dataType)))


def archive_backdrop(units: DataFrame, n: int = RECENT) -> DataFrame:
    """work_id, chapter_idx, digest, backdrop after each chapter: events that n later ones have pushed out, in the chapter in which that
    happened; joined and cut to DIGEST, then added to the backdrop, whose head is kept.

    As both are cut, a chapter needs its first events only, and a work its first digests: each is five signs long at least, with what joins it to the next.
    """
    events = stored(_numbered(_events(units)), "events")
    pushing = events.select("work_id", (F.col("place") - n).alias("place"), "chapter_idx")
    line = F.concat(F.lit("@"), F.col("ord").cast("string"), F.lit(" "), F.col("event")).alias("line")
    pushed = events.select("work_id", "place", "ord", line).join(pushing, ["work_id", "place"])
    first = lambda rows, by, order, most: rows.withColumn("rank", F.row_number().over(W.partitionBy(*by).orderBy(order))).where(F.col("rank") <= most)
    texts = lambda c, order: F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(order, c))), lambda x: x[c]), "；")
    heads = first(pushed, ["work_id", "chapter_idx"], "ord", DIGEST // 5 + 1)
    chapters = stored(heads.groupBy("work_id", "chapter_idx").agg(ustrip(F.substring(texts("line", "ord"), 1, DIGEST)).alias("digest")), "digests")
    most = BACKDROP // 5 + 1
    early = first(chapters, ["work_id"], "chapter_idx", most).groupBy("work_id").agg(F.sort_array(F.collect_list(F.struct("chapter_idx", "digest"))).alias("early"))
    so_far = F.array_join(F.transform(F.filter("early", lambda x: x["chapter_idx"] <= F.col("chapter_idx")), lambda x: x["digest"]), "；")
    return chapters.join(early, "work_id").select("work_id", "chapter_idx", "digest", F.substring(so_far, 1, BACKDROP).alias("backdrop"))


class Story:
    """One work's state while its units are folded in order. Records are found by name or alias; the first record with either wins."""

    def __init__(self, work_id: str, saved: str | None = None):
        self.state = json.loads(saved) if saved else {"schema_version": "1", "work_id": work_id, "last_order": 0, "characters": [], "objects": [], "locations": [], "plotlines": [], "recent": [], "backdrop": "", "backdrop_buffer": []}
        self.index: dict[tuple[str, str], int] = {}
        for group in GROUPS.values():
            for k, record in enumerate(self.state[group]):
                self._name(group, k, record)
        self.titles = {p["title"]: p for p in self.state["plotlines"]}

    def _name(self, group: str, k: int, record: dict) -> None:
        for name in (record["name"], *record["aliases"]):
            self.index.setdefault((group, name), k)

    def _entity(self, e: dict, order: int) -> None:
        name, status, note = (str(e.get(k) or "").strip() for k in ("name", "status", "note"))
        if not name:
            return
        group = GROUPS.get(str(e.get("type") or "character").strip(), "characters")
        fields = {"characters": {"status": status, "note": note}, "locations": {"note": note or status}, "objects": {"kind": str(e.get("kind") or "object").strip(), "status": status, "note": note}}[group]
        fields = {k: v for k, v in fields.items() if v}
        records = self.state[group]
        k = self.index.get((group, name))
        if k is None:
            aliases = [str(a) for a in e.get("aliases")] if group == "characters" and e.get("aliases") is not None else []
            records.append({"name": name, "aliases": aliases, "first_seen_order": order, "last_seen_order": order, **fields})
            self._name(group, len(records) - 1, records[-1])
        else:
            records[k] |= {**fields, "last_seen_order": order}

    def _plotline(self, p: dict, order: int) -> None:
        title, note, action = str(p.get("title") or "").strip(), str(p.get("note") or "").strip(), str(p.get("action") or "advance").strip()
        if not title:
            return
        line = self.titles.get(title)
        if line is None:
            line = {"title": title, "status": "open", "opened_order": order, "closed_order": None, "key_orders": [], "summary": ""}
            self.titles[title] = line
            self.state["plotlines"].append(line)
        if not line["key_orders"] or line["key_orders"][-1] != order:
            line["key_orders"].append(order)
        if action == "close":
            line["status"], line["closed_order"] = "closed", order
        line["summary"] = note or line["summary"]

    def apply(self, order: int, entities: list[dict], plotlines: list[dict], event: str) -> None:
        for e in entities:
            self._entity(e, order)
        for p in plotlines:
            self._plotline(p, order)
        if event.strip():
            self.state["recent"].append({"order": order, "text": event.strip()[:EVENT]})
            while len(self.state["recent"]) > RECENT:
                self.state["backdrop_buffer"].append(self.state["recent"].pop(0))
        self.state["last_order"] = order

    def archive(self, compress: Callable[[list[dict]], str]) -> None:
        """The end of a chapter: pushed-out events are digested into the backdrop. A compressor that fails leaves them where they are."""
        if self.state["backdrop_buffer"]:
            try:
                text = compress(self.state["backdrop_buffer"]).strip()
            except Exception:  # noqa: BLE001
                return
            self.state["backdrop"] = "；".join(x for x in (self.state["backdrop"], text) if x)[:BACKDROP]
            self.state["backdrop_buffer"] = []

    def snapshot(self) -> str:
        """Canonical JSON: sorted keys, no spaces."""
        return json.dumps(self.state, ensure_ascii=False, sort_keys=True, separators=(",", ":"))


def joined(events: list[dict]) -> str:
    """The plain compressor."""
    return "；".join(f"@{e['order']} {e['text']}" for e in events)[:DIGEST]


#: Events that it looks at: each is five signs long at least, with what joins it to the next.
joined.reads = DIGEST // 5 + 1


def fold_rows(story: Story, rows: list[dict], compress: Callable[[list[dict]], str], last: bool, after: int | None, keep: str = "unit") -> Iterator[tuple]:
    """(work_id, ord, chapter_idx, snapshot, fingerprint, degraded) for units in order; last: the work ends with them, else after is the next unit's chapter.

    keep: the units whose snapshots are written: each "unit", the last of each run of a "chapter", the last of a "work", or those "marked"."""
    for k, row in enumerate(rows):
        if not row["degraded"]:
            event = row["recent_event"]
            story.apply(int(row["ord"]), [dict(x) for x in (row["entity_updates"] if row["entity_updates"] is not None else [])], [dict(x) for x in (row["plotline_updates"] if row["plotline_updates"] is not None else [])], str((event or {}).get("text") or ""))
        final = last and k + 1 == len(rows)
        ends = final or (after if k + 1 == len(rows) else rows[k + 1]["chapter_idx"]) != row["chapter_idx"]
        if ends:
            story.archive(compress)
        if {"unit": True, "chapter": ends, "work": final, "marked": bool(row.get("marked"))}[keep]:
            text = story.snapshot()
            yield row["work_id"], int(row["ord"]), int(row["chapter_idx"]), text, hashlib.sha256(text.encode()).hexdigest(), bool(row["degraded"])


SNAPSHOTS = "work_id string, ord long, chapter_idx int, snapshot string, fingerprint string, degraded boolean"
_NAMES = [x.split()[0] for x in SNAPSHOTS.split(", ")]
#: Letters of snapshots that a task holds before it hands them on.
HANDED = 4_000_000


def fold_state(units: DataFrame, compress: Callable[[list[dict]], str] = joined, keep: str = "unit", marked: DataFrame | None = None) -> DataFrame:
    """A snapshot and its fingerprint for every unit, or for those that keep names (fold_rows); marked: work_id, ord of the units for keep "marked".

    Works side by side, a work's units in order in one task, as each needs the state before it; Spark sorts them, and the task holds one
    state and one batch of units, whatever the size of the work.
    """

    def fold(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        story, held = None, []
        out, size = [], 0

        def folded(rows: list[dict]) -> Iterator[tuple]:
            """The rows, but for the last one, which waits for its successor."""
            nonlocal story, held
            start = 0
            for k in range(1, len(rows) + 1):
                ended = k < len(rows) and rows[k]["work_id"] != rows[start]["work_id"]
                if not ended and k < len(rows):
                    continue
                story = story or Story(rows[start]["work_id"])
                if ended:
                    yield from fold_rows(story, rows[start:k], compress, True, None, keep)
                    story, start = None, k
                else:
                    held = rows[k - 1 :]
                    yield from fold_rows(story, rows[start : k - 1], compress, False, held[0]["chapter_idx"], keep)

        def rest() -> Iterator[tuple]:
            for frame in frames:
                yield from folded(held + frame.to_dict("records"))
            if held:
                yield from fold_rows(story, held, compress, True, None, keep)

        for row in rest():
            out.append(row)
            size += len(row[3])
            if size >= HANDED:
                yield pd.DataFrame(out, columns=_NAMES)
                out, size = [], 0
        yield pd.DataFrame(out, columns=_NAMES)

    columns = ["work_id", "ord", "chapter_idx", "entity_updates", "plotline_updates", "recent_event", F.coalesce("degraded", F.lit(False)).alias("degraded")]
    rows = units.select(*columns)
    if marked is not None:
        rows = rows.join(marked.select("work_id", "ord").distinct().withColumn("marked", F.lit(True)), ["work_id", "ord"], "left").withColumn("marked", F.coalesce("marked", F.lit(False)))
    return rows.repartition("work_id").sortWithinPartitions("work_id", "ord").mapInPandas(fold, SNAPSHOTS)


def checkpoints(snapshots: DataFrame) -> DataFrame:
    """The last snapshot of each chapter."""
    by = W.partitionBy("work_id", "chapter_idx").orderBy(F.desc("ord"))
    return snapshots.withColumn("rank", F.row_number().over(by)).where("rank = 1").drop("rank")


def final_state(snapshots: DataFrame) -> DataFrame:
    """The last snapshot of each work."""
    return snapshots.groupBy("work_id").agg(F.max_by(F.struct("ord", "snapshot", "fingerprint"), "ord").alias("s")).select("work_id", "s.*")


def prefix_consistency(full: DataFrame, runs: DataFrame, fields: list[str], most: int = 8) -> DataFrame:
    """For each prefix in runs (prefix, work_id, ord, fields): rows whose fields differ from the full run or that it lacks, and the first of them."""
    right = full.select("work_id", "ord", F.struct(*fields).alias("stored"))
    rows = runs.select("prefix", "work_id", "ord", F.struct(*fields).alias("again")).join(right, ["work_id", "ord"], "left")
    bad = ~F.col("again").eqNullSafe(F.col("stored"))
    return rows.groupBy("prefix", "work_id").agg(F.count_if(bad).alias("differences"), F.slice(F.array_sort(F.collect_list(F.when(bad, F.col("ord")))), 1, most).alias("first"), (F.count_if(bad) == 0).alias("ok"))


def render_state_view(snapshots: DataFrame) -> DataFrame:
    """snapshots with view: a short text of the state as of each unit."""
    record = "array<struct<name:string,kind:string,status:string,note:string>>"
    s = F.from_json("snapshot", f"last_order long, characters {record}, objects {record}, locations {record}, plotlines array<struct<title:string,status:string,opened_order:bigint,closed_order:bigint,summary:string>>, recent array<struct<order:bigint,text:string>>, backdrop string")
    rows = snapshots.withColumn("s__", s)
    c = lambda n: F.col(f"s__.{n}")
    tail = lambda items, n: F.slice(items, F.greatest(F.size(items) - n + 1, F.lit(1)), n)
    some = lambda *cols: F.coalesce(*[F.nullif(x, F.lit("")) for x in cols])
    people = F.array_join(F.transform(tail(c("characters"), 80), lambda x: F.concat_ws("：", x["name"], some(x["status"], x["note"]))), "；")
    things = F.array_join(F.transform(tail(c("objects"), 80), lambda x: F.concat(x["name"], F.lit("（"), F.coalesce(some(x["status"], x["note"], x["kind"]), F.lit("object")), F.lit("）"))), "；")
    places = F.array_join(F.transform(tail(c("locations"), 40), lambda x: x["name"]), "、")
    is_open = lambda p: p["status"] == "open"
    lines = F.concat(F.filter(c("plotlines"), is_open), tail(F.filter(c("plotlines"), lambda p: ~is_open(p)), 2))
    lines = F.array_join(F.transform(lines, lambda p: F.concat(p["title"], F.lit("["), F.when(is_open(p), "进行中").otherwise("已结束"), F.lit("@"), p["opened_order"].cast("string"), F.coalesce(F.concat(F.lit("→"), p["closed_order"].cast("string")), F.lit("")), F.lit("]："), F.coalesce(p["summary"], F.lit("")))), "；")
    recent = F.array_join(F.transform(tail(c("recent"), 5), lambda e: F.concat(F.lit("@"), e["order"].cast("string"), F.lit(" "), e["text"])), "；")
    part = lambda name, text: F.when(text != "", F.concat(F.lit(name), text))
    head = F.concat(F.lit("（故事状态，截至第 "), c("last_order").cast("string"), F.lit(" 段）"))
    return rows.withColumn("view", F.concat_ws("\n", head, part("人物：", people), part("物件/设定：", things), part("地点：", places), part("事件线：", lines), part("最近发生：", recent), part("更早背景：", c("backdrop")))).drop("s__")
