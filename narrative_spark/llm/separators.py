"""Operator 1: token counts of documents in flat token files without an index.

A file is a plain run of ids in which an end-of-document id closes each document. Files of any size are read as blocks, by byte ranges
that tasks share; each block is searched for the id by one vectorised comparison, which leaves its length and the places found.
A two-level prefix scan over those small rows (blocks of a group, then groups of a file) carries token offsets,
document ordinals and the last separator across block borders, so that a document may span many blocks.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from narrative_spark.llm.common import materialize, shared_dir, tidy
from narrative_spark.llm.tokens import UnitTokenizer

BLOCK_TOKENS, GROUP = 1 << 16, 1024
#: Blocks that a task reads one after the other from one place of a file.
RUN = 64
BLOCKS = "file string, block long, tokens binary"
FILES = "file string, first long, doc_ids array<long>"
_KINDS = {2: "<u2", 4: "<u4"}


def _name(column: str) -> Column:
    """A file's name without its folders."""
    return F.regexp_extract(column, "[^/]+$", 0)


def _place(path: str) -> tuple[FileSystem, str]:
    """File system and path in it; Spark names local files file:/x."""
    return FileSystem.from_uri("file://" + path.removeprefix("file:") if path.startswith("file:/") and not path.startswith("file://") else path)


def read_token_files(spark: SparkSession, path: str, id_bytes: int = 4, block_tokens: int = BLOCK_TOKENS, only: DataFrame | None = None) -> DataFrame:
    """Flat token files as blocks: file, block, tokens. Spark lists the files with their lengths; tasks then read runs of blocks by byte range, so that a
    file may be larger than a task's memory.

    only: names (file) of those that count, where others lie beside them. Empty files have no blocks. The last bytes of a file that aren't a whole id are left out. Files must lie where pyarrow can open them (local or shared
    folders, HDFS, object stores).
    """
    step = block_tokens * id_bytes
    files = spark.read.format("binaryFile").load(path).select("path", (F.col("length") - F.col("length") % id_bytes).alias("length")).where("length > 0")
    if only is not None:
        files = files.join(only.select(_name("file").alias("name")).distinct(), _name("path") == F.col("name"), "left_semi")
    runs = files.select("path", "length", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("length") - 1) / (step * RUN)))).alias("run"))
    runs = runs.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "path", "run")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, length, run in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                files, inner = _place(name)
                with files.open_input_file(inner) as opened:
                    for block in range(run * RUN, min((run + 1) * RUN, -(-length // step))):
                        raw = opened.read_at(min(step, length - block * step), block * step)
                        yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([block], pa.int64()), pa.array([raw], pa.binary())], names=["file", "block", "tokens"])

    return runs.mapInArrow(tidy(cut), BLOCKS)


def write_token_files(docs: DataFrame, tokenizer: str, separator: int, folder: str, id_bytes: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Flat files of docs' ids in folder, one for each task; of each: file, first, doc_ids, the documents in their order from number first on.

    The result is written too, and only files that it names count: a task that runs again after an executor was lost writes a file of another name. A
    separator id inside a text can't come up, as its string is ordinary text. Null and empty texts are documents of no tokens; very long
    texts are written whole; repeated rows are written each for itself; an empty table gives no files.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, name, count, opened = UnitTokenizer.loaded(tokenizer, True), f"{folder}/part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.bin", 0, None
        for batch in batches:
            names = batch.column(0)
            for at, ids, off in coder.texts(batch.column(1)):
                if opened is None:
                    files, inner = _place(name)
                    opened = files.open_output_stream(inner)
                opened.write(np.insert(ids, off[1:], separator).astype(_KINDS[id_bytes]).tobytes())
                n = len(off) - 1
                yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([count], pa.int64()), pa.array([names.slice(at, n).to_pylist()], pa.list_(pa.int64()))], names=["file", "first", "doc_ids"])
                count += n
        if opened is not None:
            opened.close()

    spark = docs.sparkSession
    there = spark._jvm.org.apache.hadoop.fs.Path(folder)
    there.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(there)
    return materialize(docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text")).mapInArrow(tidy(write), FILES), "files")


def count_tokens(docs: DataFrame, tokenizer: str, separator: int, id_bytes: int = 2) -> DataFrame:
    """Documents as flat files in the shared folder, and the scan of those files: file, ordinal, start, n_tokens, terminated, doc_id.

    A file is named by the part of docs that it holds, so that the same parts give the same rows. Null and empty texts are documents of no tokens; very long texts span blocks; repeated rows count
    each; null ids stay; an empty table gives no rows; other columns aren't read.
    """
    spark = docs.sparkSession
    folder = f"{shared_dir(spark)}/tokens-{uuid.uuid4().hex}"
    files = write_token_files(docs, tokenizer, separator, folder, id_bytes)
    known = files.select("file", "first", F.posexplode("doc_ids").alias("k", "doc_id")).select(_name("file").alias("file"), (F.col("first") + F.col("k")).alias("ordinal"), "doc_id")
    blocks = read_token_files(spark, folder, id_bytes, only=files)
    found = scan(blocks.withColumn("file", _name("file")), separator, id_bytes)
    return known.join(found, ["file", "ordinal"], "left").select(F.regexp_extract("file", "^part-[0-9]+", 0).alias("file"), "ordinal", "start", "n_tokens", "terminated", "doc_id")


def scan(blocks: DataFrame, separator: int, id_bytes: int = 4) -> DataFrame:
    """One row for each document: file, ordinal, start (in tokens), n_tokens (without the separator), terminated.

    Tokens after a file's last separator are a document that isn't terminated. A block without separators, empty blocks and files,
    separators side by side (documents of no tokens) and null tokens (an empty block) are allowed; blocks may come in any order and
    documents may be longer than any block. A repeated block counts as often as it comes; an empty table gives no documents; other columns aren't read.
    """
    kind = _KINDS[id_bytes]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, places = [], []
            for raw in batch.column("tokens"):
                ids = np.frombuffer(raw.as_buffer() or b"", kind)
                sizes.append(len(ids))
                places.append(np.flatnonzero(ids == separator))
            yield pa.RecordBatch.from_arrays([batch.column("file"), batch.column("block"), pa.array(sizes, pa.int64()), pa.array(places, pa.list_(pa.int64()))], names=["file", "block", "size", "places"])

    found = blocks.select("file", "block", "tokens").mapInArrow(tidy(search), "file string, block long, size long, places array<long>")
    # Small rows, which both levels of the scan read.
    found = materialize(found, "separators").withColumn("group", F.floor(F.col("block") / GROUP))
    before = lambda *by: W.partitionBy(*by).rowsBetween(W.unboundedPreceding, -1)
    sums: dict[str, tuple[Column, str]] = {"size": (F.col("size"), "tokens_before"), "count": (F.size("places"), "docs_before")}
    inner, outer = before("file", "group").orderBy("block"), before("file").orderBy("group")
    rows = found.select("*", *[F.coalesce(F.sum(c).over(inner), F.lit(0)).alias(f"in_{n}") for c, n in sums.values()])
    rows = rows.withColumn("in_last", F.last(F.when(F.size("places") > 0, F.col("in_tokens_before") + F.array_max("places")), ignorenulls=True).over(inner))
    top = rows.groupBy("file", "group").agg(F.sum("size").alias("size"), F.sum(F.size("places")).alias("count"), F.max(F.when(F.size("places") > 0, F.col("in_tokens_before") + F.array_max("places"))).alias("last"), F.max("block").alias("end"))
    top = top.select("file", "group", "last", *[F.coalesce(F.sum(F.col(k)).over(outer), F.lit(0)).alias(f"out_{n}") for k, (_, n) in sums.items()], (F.max("end").over(W.partitionBy("file"))).alias("end"))
    top = top.withColumn("out_last", F.last(F.col("out_tokens_before") + F.col("last"), ignorenulls=True).over(outer)).withColumnsRenamed({"file": "top_file", "group": "top_group"})
    rows = rows.join(top.drop("last"), (rows["file"].eqNullSafe(top["top_file"])) & (rows["group"] == top["top_group"]))
    base = F.col("out_tokens_before") + F.col("in_tokens_before")
    open_at = F.coalesce(F.col("out_tokens_before") + F.col("in_last"), F.col("out_last"), F.lit(-1).cast("long")) + 1
    tail = (F.col("block") == F.col("end")) & (F.coalesce(F.array_max("places") + base + 1, open_at) < base + F.col("size"))
    ends = F.concat(F.transform("places", lambda p: F.struct((p + base).alias("at"), F.lit(True).alias("terminated"))), F.when(tail, F.array(F.struct((base + F.col("size")).alias("at"), F.lit(False).alias("terminated")))).otherwise(F.array().cast("array<struct<at:bigint,terminated:boolean>>")))
    rows = rows.select("file", (F.col("out_docs_before") + F.col("in_docs_before")).alias("docs_before"), open_at.alias("open_at"), ends.alias("ends")).where(F.size("ends") > 0)
    rows = rows.select("file", "docs_before", F.posexplode(F.transform("ends", lambda e, k: F.struct(F.when(k == 0, F.col("open_at")).otherwise(F.get(F.col("ends"), k - 1)["at"] + 1).alias("start"), e["at"].alias("at"), e["terminated"].alias("terminated")))).alias("k", "d"))
    return rows.select("file", (F.col("docs_before") + F.col("k")).alias("ordinal"), F.col("d.start"), (F.col("d.at") - F.col("d.start")).alias("n_tokens"), F.col("d.terminated"))
