"""The state fold over a stream of released units."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from narrative_spark.operators.blocks import BLOCK, ended
from narrative_spark.operators.state import GROUPS, Story, joined

#: kind: "snapshot" of a unit in its turn; "late" for a unit whose order was folded before, "repeated" for one whose order waits already.
ROWS = "work_id string, ord long, kind string, chapter_idx int, snapshot string, fingerprint string, degraded boolean"
_NAMES = [x.split()[0] for x in ROWS.split(", ")]
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Letters of snapshots that are handed on together, items of a page, and letters of a state that is kept as one page.
HANDED, PAGE, SMALL = 4_000_000, 64, 1 << 14


class Fold(StatefulProcessor):
    """A work's state in parts: a value for what is short, and map entries for pages of records, plotlines, events and waiting units, so that a batch writes the pages that it
    changed; lists of SMALL letters together are one page. A work that gets no unit in its turn only has its waiting units written."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.short = handle.getValueState("short", "next long, late long, last_order long, backdrop string, held long")
        self.pages = handle.getMapState("pages", "kind string, page long", "body string")
        self.waiting = handle.getMapState("waiting", "page long", "body string")

    def _load(self, work: str, last: int, backdrop: str) -> tuple[Story, dict]:
        kept = {key: body[0] for key, body in self.pages.iterator()}
        parts = {"work_id": work, "schema_version": "1", "last_order": last, "backdrop": backdrop} | {name: [] for name in self.lists}
        if self.whole in kept:
            parts |= json.loads(kept[self.whole])
        else:
            for kind, page in sorted(kept):
                parts[kind] += json.loads(kept[kind, page])
        return Story(work, json.dumps(parts)), kept

    #: The lists of a state.
    lists = (*GROUPS.values(), "plotlines", "recent", "backdrop_buffer")
    #: The page of a small state.
    whole = ("whole", 0)

    def _save(self, story: Story, kept: dict) -> None:
        """Write the pages that changed, and remove those that went."""
        now = {}
        for kind in self.lists:
            items = story.state[kind]
            now |= {(kind, first // PAGE): json.dumps(items[first : first + PAGE], ensure_ascii=False) for first in range(0, len(items), PAGE)}
        if sum(map(len, now.values())) <= SMALL:
            now = {self.whole: json.dumps({kind: story.state[kind] for kind in self.lists}, ensure_ascii=False)}
        for key, body in now.items():
            if kept.get(key) != body:
                self.pages.updateValue(key, (body,))
        for key in kept.keys() - now.keys():
            self.pages.removeKey(key)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        work = key[0]
        now, late, last, backdrop, held = self.short.get() or (1, 0, 0, "", 0)
        pages: dict[int, dict[str, list]] = {}
        there: set[int] = set()
        changed: set[int] = set()
        before = held

        def page(order: int) -> dict[str, list]:
            """The waiting units (chapter, ends, deltas, degraded) of orders near this one; where none waited, the state isn't asked."""
            k = order // PAGE
            if k not in pages:
                found = self.waiting.getValue((k,)) if before else None
                pages[k] = json.loads(found[0]) if found else {}
                there.update([k] if found else [])
            return pages[k]

        out: list[tuple] = []
        for frame in rows:
            for r in frame.to_dict("records"):
                order = int(r["ord"])
                again = "late" if order < now else "repeated" if str(order) in page(order) else None
                if again:
                    late += 1
                    out.append((work, order, again, int(r["chapter_idx"]), None, None, bool(r["degraded"])))
                else:
                    page(order)[str(order)] = [int(r["chapter_idx"]), bool(r["ends_chapter"]), r["deltas_json"], bool(r["degraded"])]
                    changed.add(order // PAGE)
                    held += 1
        story = kept = None
        size = 0
        while held and str(now) in page(now):
            if story is None:
                story, kept = self._load(work, last, backdrop)
            chapter, ends, deltas, degraded = page(now).pop(str(now))
            changed.add(now // PAGE)
            held -= 1
            if not degraded:
                d = json.loads(deltas)
                story.apply(now, d.get("entity_updates") or [], d.get("plotline_updates") or [], (d.get("recent_event") or {}).get("text") or "")
            if ends:
                story.archive(joined)
            text = story.snapshot()
            out.append((work, now, "snapshot", chapter, text, hashlib.sha256(text.encode()).hexdigest(), degraded))
            now, size = now + 1, size + len(text)
            if size >= HANDED:
                yield pd.DataFrame(out, columns=_NAMES)
                out, size = [], 0
        for k in changed:
            if pages[k]:
                self.waiting.updateValue((k,), (json.dumps(pages[k], ensure_ascii=False),))
            elif k in there:
                self.waiting.removeKey((k,))
        if story is not None:
            self._save(story, kept)
            last, backdrop = story.state["last_order"], story.state["backdrop"]
        self.short.update((now, late, last, backdrop, held))
        yield pd.DataFrame(out, columns=_NAMES)

    def close(self) -> None:
        pass


def stream_state(units: DataFrame) -> DataFrame:
    """Snapshots of a stream of units (work_id, ord, chapter_idx, ends_chapter, deltas_json, degraded), the same as the batch fold's, and a row for each unit that came again or too late.

    Orders of a work run from 1. A unit that comes before its turn waits in the state until the gap closes; one whose order was folded or waits already is dropped
    and told of (kind). ends_chapter marks the last unit of a chapter or work. The session must keep state in RocksDB (use_rocks).
    """
    return units.groupBy("work_id").transformWithStateInPandas(Fold(), ROWS, "append", "none")


def use_rocks(spark: SparkSession) -> None:
    """Keep the state of streams in RocksDB, which holds maps larger than memory and writes what changed."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


def as_stream_rows(units: DataFrame, size: int = BLOCK) -> DataFrame:
    """Batch units in the shape of the stream; the ends of chapters are found block by block."""
    ends = ended(units, size).select("work_id", "ord", F.col("ends").alias("ends_chapter"))
    return units.join(ends, ["work_id", "ord"]).select("work_id", "ord", "chapter_idx", "ends_chapter", F.to_json(F.struct("entity_updates", "plotline_updates", "recent_event")).alias("deltas_json"), F.coalesce("degraded", F.lit(False)).alias("degraded"))


def run_available(spark: SparkSession, source: str, schema, sink: str, checkpoint: str, files: int = 2) -> DataFrame:
    """Fold all stream rows that lie in source, some files in a batch, write what comes out to sink, and read its snapshots."""
    use_rocks(spark)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(source)
    query = stream_state(stream).writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(ROWS).parquet(sink).where("kind = 'snapshot'").drop("kind")


def dropped(spark: SparkSession, sink: str) -> DataFrame:
    """work_id, ord, kind, chapter_idx of the units that run_available dropped: late ones and repeated ones, a row for each time."""
    return spark.read.schema(ROWS).parquet(sink).where("kind <> 'snapshot'").select("work_id", "ord", "kind", "chapter_idx")
