"""Records of WARC files, read by byte ranges, and the fixity audit of two copies of them.

Tasks look for record headers in ranges of files. What looks like a header may stand inside a payload; the true records are those that are met when one goes
from the first to the end that its length gives, and on. Where a header's length leads nowhere, as a damaged one's does, the next header found counts. Ranges
find out side by side where each way through them ends; the few ways that meet at their borders are followed in order; then each range keeps the records on its way, and tasks
hash these, a piece at a time.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from narrative_spark.functions import prefix
from narrative_spark.llm import merkle
from narrative_spark.llm.common import materialize, tidy
from narrative_spark.llm.separators import _place

RANGE, PIECE = 64 << 20, 1 << 20
#: Longest header that is looked through.
HEADER = 1 << 16
#: Bits of an offset in the number of a record.
OFFSET_BITS = 44
_BEGIN = re.compile(rb"(?:\A|(?<=\r\n\r\n))WARC/[0-9]+\.[0-9]+\r\n")
_FOUND = "file string, range long, offset long, next long, record_id string, kind string, uri string"
_RECORD = "file string, ordinal long, offset long, length long, record_id string, kind string, uri string, hash string"


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines) if v}


def _headers(spark: SparkSession, path: str, size: int) -> DataFrame:
    """What looks like a record's beginning, in each range: its offset, where the next one should be, and what it says of itself."""
    files = spark.read.format("binaryFile").load(path).select("path", "length").where("length > 0")
    ranges = files.select("path", "length", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("length") - 1) / size))).alias("range"))
    ranges = ranges.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "path", "range")

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, length, number in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                store, inner = _place(name)
                rows = []
                with store.open_input_file(inner) as opened:
                    for first in range(number * size, min((number + 1) * size, length), PIECE):
                        start, end = max(0, first - 4), min(first + PIECE, (number + 1) * size)
                        raw = opened.read_at(min(end + HEADER, length) - start, start)
                        for m in _BEGIN.finditer(raw):
                            at = start + m.start()
                            close = raw.find(b"\r\n\r\n", m.start())
                            if not first <= at < end or (m.start() == 0 and start) or close < 0:
                                continue
                            said = _fields(raw[m.start() : close])
                            if said.get("content-length", "").isdigit():
                                rows.append((name, number, at, start + close + 8 + int(said["content-length"]), said.get("warc-record-id"), said.get("warc-type"), said.get("warc-target-uri")))
                yield pa.RecordBatch.from_pydict({n.split()[0]: [r[k] for r in rows] for k, n in enumerate(_FOUND.split(", "))}, pa.schema([(n.split()[0], pa.int64() if n.endswith("long") else pa.string()) for n in _FOUND.split(", ")]))

    return ranges.mapInArrow(tidy(look), _FOUND)


def read_records(spark: SparkSession, path: str, size: int = RANGE) -> DataFrame:
    """file, ordinal (from 1), offset, length, record_id, kind, uri and hash (SHA-256 of the whole record, header and closing lines among them) of the records of plain WARC files.

    Files of any size, as no task holds more than a piece of one; records of any length; a header of more than HEADER bytes, or without a length, begins no record. A damaged
    length ends its record where the next header is found. Empty files have no records. Files must lie where pyarrow can open them, as those of separators.
    """
    found = materialize(_headers(spark, path, size), "headers")
    there = found.select("file", F.col("offset").alias("next"), F.lit(True).alias("true"))
    back = found.select("file", "offset", (-F.col("range")).alias("back"))
    after = prefix.scan(back, "file", "back", [-F.col("offset")], latest={"after": F.col("offset")}).select("file", "offset", "after")
    rows = found.join(there, ["file", "next"], "left").join(after, ["file", "offset"])
    # Past the last header the file's end is next, whatever its length says.
    rows = materialize(rows.select("file", "range", "offset", F.when(F.col("true"), F.col("next")).otherwise(F.coalesce("after", F.lit(1 << 62))).alias("next"), F.col("next").alias("said")), "steps")

    def ways(part: pd.DataFrame) -> pd.DataFrame:
        """Where the way from each header leaves the range."""
        part = part.sort_values("offset", ascending=False)
        out: dict[int, int] = {}
        for at, to in zip(part["offset"], part["next"], strict=True):
            out[at] = out.get(to, to)
        return pd.DataFrame({"file": part["file"], "range": part["range"], "offset": list(out), "went": list(out.values())})

    leave = materialize(rows.groupBy("file", "range").applyInPandas(ways, "file string, range long, offset long, went long"), "ways")
    first = leave.groupBy("file").agg(F.min("offset").alias("offset"))
    enters = leave.select("file", F.col("went").alias("offset")).unionByName(first).distinct()
    few = materialize(leave.join(enters, ["file", "offset"]), "enters")

    def follow(part: pd.DataFrame) -> pd.DataFrame:
        went = dict(zip(part["offset"], part["went"], strict=True))
        of = dict(zip(part["offset"], part["range"], strict=True))
        now, out = min(went), []
        while now in went:
            out.append((part["file"].iloc[0], of[now], now))
            now = went[now]
        return pd.DataFrame(out, columns=["file", "range", "entered"])

    entered = materialize(few.groupBy("file").applyInPandas(follow, "file string, range long, entered long"), "entered")

    def keep(part: pd.DataFrame) -> pd.DataFrame:
        to = dict(zip(part["offset"], part["next"], strict=True))
        now, out = int(part["entered"].iloc[0]), []
        while now in to:
            out.append(now)
            now = to[now]
        return pd.DataFrame({"file": part["file"].iloc[0], "offset": out})

    steps = rows.toDF(*rows.columns).join(entered, ["file", "range"])
    true = steps.groupBy("file", "range").applyInPandas(keep, "file string, offset long")
    known = materialize(found.join(true, ["file", "offset"]).join(rows.select("file", "offset", F.col("next").alias("to"), "said"), ["file", "offset"]), "known")
    # The last record ends where it says.
    known = known.withColumn("length", F.when(F.col("to") == 1 << 62, F.col("said")).otherwise(F.col("to")) - F.col("offset"))
    number = prefix.scan(known.select("file", "offset", "range"), "file", "range", [F.col("offset")], sums={"earlier": F.lit(1)})
    known = known.join(number.select("file", "offset", (F.col("earlier") + 1).alias("ordinal")), ["file", "offset"])
    names = [n.split()[0] for n in _RECORD.split(", ")]

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = []
            for name, at, length in zip(*(batch.column(c).to_pylist() for c in ("file", "offset", "length")), strict=True):
                store, inner = _place(name)
                made = hashlib.sha256()
                with store.open_input_file(inner) as opened:
                    for first in range(at, at + length, PIECE):
                        made.update(opened.read_at(min(PIECE, at + length - first), first))
                hashes.append(made.hexdigest())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names[:-1]), pa.array(hashes, pa.string())], names=names)

    return known.select(*names[:-1]).mapInArrow(tidy(digest), _RECORD)


def audit_files(spark: SparkSession, left: str, right: str, size: int = RANGE) -> DataFrame:
    """Records that differ between two copies of WARC files: file, offset, length, record_id, status, hash_left, hash_right.

    Copies have the same file names in two folders and are compared by name and offset, down two trees over the ordered offsets, so that only what differs is followed. A record that has moved is missing
    where it was and extra where it is. Folders without files, and equal copies, give no rows.
    """
    sides = [materialize(read_records(spark, p, size).withColumn("name", F.regexp_extract("file", "[^/]+$", 0)), "records") for p in (left, right)]
    # A number for each file: as many as files, which Spark lists on the driver anyway.
    names = sorted({r.name for s in sides for r in s.select("name").distinct().collect()})
    numbers = spark.createDataFrame(list(enumerate(names)), "place long, name string")
    placed = [s.join(F.broadcast(numbers), "name").withColumn("key", F.col("place") * (1 << OFFSET_BITS) + F.col("offset")) for s in sides]
    found = merkle.compare(*[p.select("key", "hash", F.col("length").alias("bytes")) for p in placed])
    of = placed[0].select("key", "name", "offset", "length", "record_id").unionByName(placed[1].join(placed[0].select("key"), "key", "left_anti").select("key", "name", "offset", "length", "record_id"))
    return found.select("key", "status", "hash_left", "hash_right").join(of, "key").select(F.col("name").alias("file"), "offset", "length", "record_id", "status", "hash_left", "hash_right")
