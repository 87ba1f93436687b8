"""Operator 13: near-duplicates by SimHash fingerprints and covering locality-sensitive hashing.

Each of the 64 places of a fingerprint gets a code of RADIUS + 1 bits; each table v keeps the places whose code has an odd overlap with v. The codes of
RADIUS places never span all codes, so that for each pair within the radius some table keeps none of the places in which the two differ: they agree there on
all that is kept. No pair is lost, whatever the data.

Equal fingerprints are one node. Pairs alone in a bucket are compared where they are counted. The nodes of larger buckets meet in blocks; a bucket of several blocks whose nodes
then still belong to several components has its smaller components meet all of its nodes, so that its largest one never meets itself. Only links that join
components are handed on, at most one for a node and block.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from narrative_spark.llm import bytetext
from narrative_spark.llm.common import join_dealt, materialize, tidy
from narrative_spark.llm.components import components

WIDTH, SEED, BITS, RADIUS = 4, 42, 64, 4
TABLES = (1 << (RADIUS + 1)) - 1
#: Nodes of a bucket that meet in one task, and those that one task holds against a block of the smaller components.
BLOCK, HELD = 2048, 1 << 16
#: Shingles whose bits are counted at a time.
SLICE = 1 << 17


def table_masks(bits: int = BITS, radius: int = RADIUS) -> list[int]:
    """The places that each table keeps. Codes go round through all but zero, so that each table keeps about half."""
    tables = (1 << (radius + 1)) - 1
    codes = [k % tables + 1 for k in range(bits)]
    return [sum(1 << k for k, code in enumerate(codes) if (code & v).bit_count() % 2) for v in range(1, tables + 1)]


def _shingle_hashes(text: bytes) -> np.ndarray:
    """XXH64 of each run of WIDTH words, joined by spaces; of all words where there are fewer, none without words."""
    words = text.split()
    if not words:
        return np.zeros(0, np.uint64)
    width = min(WIDTH, len(words))
    runs = zip(*(islice(words, k, None) for k in range(width)), strict=False)  # the last starts have too few words behind them
    return np.fromiter((xxhash.xxh64_intdigest(b" ".join(run), SEED) for run in runs), np.uint64, len(words) - width + 1)


def _bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each bit. Bits are summed as bytes, 255 at a time and eight in a word."""
    total = np.zeros(BITS, np.int64)
    for first in range(0, len(hashes), SLICE):
        some = hashes[first : first + SLICE]
        padded = np.zeros(-(-len(some) // 255) * 255, "<u8")
        padded[: len(some)] = some
        lanes = np.unpackbits(padded.view(np.uint8), bitorder="little").view(np.uint64).reshape(-1, 255, 8)
        total += lanes.sum(1).view(np.uint8).reshape(-1, BITS).sum(0, dtype=np.int64)
    return total


def fingerprint(text: bytes) -> int:
    """The fingerprint of a text in UTF-8 whose letters A-Z are lower-case: each bit as more than half of its shingles' hashes have it."""
    hashes = _shingle_hashes(text)
    return int(np.packbits(2 * _bit_counts(hashes) > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, print (the 64 bits as a signed long) for every row of docs."""
    lower = bytes(bytetext.LOWER)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint((x.as_buffer().to_pybytes() if x.is_valid else b"").translate(lower)) for x in batch.column(1)], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints.view(np.int64))], names=["id", "print"])

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(tidy(run), "id long, print long")


def distance(a: Column | str, b: Column | str) -> Column:
    return F.bit_count((F.col(a) if isinstance(a, str) else a).bitwiseXOR(F.col(b) if isinstance(b, str) else b))


def _stars(prints: np.ndarray, group: np.ndarray, others: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(node, node) links that join groups: prints within RADIUS of each other, or only those of others against the rest. Nodes of one group count as joined."""
    left, right, label = [], [], group.copy()
    for i in np.arange(len(prints)) if others is None else others:
        rest = slice(i + 1, None) if others is None else slice(None)
        at = np.flatnonzero((np.bitwise_count(prints[rest] ^ prints[i]) <= RADIUS) & (label[rest] != label[i])) + (i + 1 if others is None else 0)
        _, first = np.unique(label[at], return_index=True)
        left += [i] * len(first)
        right += at[first].tolist()
        for old in label[at[first]]:
            label[label == old] = label[i]
    return np.array(left, np.int64), np.array(right, np.int64)


def _links(rows: DataFrame, keys: list[str]) -> DataFrame:
    """a, b of the links within each group of rows (print, label, asks); groups whole in one task, many of them in a batch of it. asks: null where all
    nodes of the group meet, else whether a node meets all others."""
    names = [*keys, "print", "label", "asks"]
    rows = rows.select(*names).repartition(*keys).sortWithinPartitions(*keys, "print")

    def close(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        prints = table["print"].to_numpy()
        group = np.unique(table["label"].to_numpy(), return_inverse=True)[1]
        asks = table["asks"].to_numpy(zero_copy_only=False)
        i, j = _stars(prints.view(np.uint64), group, None if asks[0] is None else np.flatnonzero(asks.astype(bool)))
        return prints[i], prints[j]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None

        def made(table: pa.Table, edges: np.ndarray) -> pa.RecordBatch:
            pairs = [close(table.slice(a, b - a)) for a, b in zip(edges[:-1], edges[1:], strict=True) if b - a > 1]
            a, b = (np.concatenate([p[k] for p in pairs]) if pairs else np.zeros(0, np.int64) for k in (0, 1))
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if held is None else pa.concat_tables([held, table])
            new = np.zeros(table.num_rows, bool)
            for k in keys:
                c = table[k].to_numpy()
                new[1:] |= c[1:] != c[:-1]
            edges = np.concatenate(([0], np.flatnonzero(new)))
            yield made(table, edges)  # the last group may go on
            held = table.slice(edges[-1])
        if held is not None:
            yield made(held, np.array([0, held.num_rows]))

    return rows.mapInArrow(tidy(run), "a long, b long").distinct()


def _keyed(nodes: DataFrame) -> DataFrame:
    """table, kept, and the columns of nodes: each node in every table."""
    masks = F.array(*[F.lit(m - (1 << 64) if m >> 63 else m).cast("long") for m in table_masks()])
    return nodes.select("*", F.posexplode(masks).alias("table", "mask")).select("table", F.col("print").bitwiseAND(F.col("mask")).alias("kept"), *nodes.columns)


def join_near(nodes: DataFrame) -> DataFrame:
    """node, label: every node (print) with a node within RADIUS of it, and the least node that can be reached from it through such links."""
    bucket = ["table", "kept"]
    buckets = materialize(_keyed(nodes.select("print")).groupBy(*bucket).agg(F.count(F.lit(1)).alias("n"), F.min("print").alias("a"), F.max("print").alias("b")).where("n > 1"), "buckets")
    links = buckets.where((F.col("n") == 2) & (distance("a", "b") <= RADIUS)).select("a", "b").distinct()
    large = buckets.where("n > 2").select(*bucket, "n")
    if not large.limit(1).count():
        return components(links)
    name = F.struct(*bucket)
    keyed = _keyed(nodes.select("print")).withColumn("bucket", name).drop(*bucket)
    members = join_dealt(keyed, large.select(name.alias("bucket"), F.col("n"), F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")), "bucket", "n", F.col("print"), "inner")
    members = materialize(members.select("bucket.table", "bucket.kept", "print", "blocks", F.pmod(F.xxhash64("print"), F.col("blocks").cast("long")).cast("int").alias("block")), "members")
    inside = _links(members.select(*bucket, "block", "print", F.col("print").alias("label"), F.lit(None).cast("boolean").alias("asks")), [*bucket, "block"])
    links = materialize(links.unionByName(inside).distinct(), "links")
    found = components(links)
    wide = members.where("blocks > 1")
    if not wide.limit(1).count():
        return found
    return _across(wide, found)


def _across(wide: DataFrame, found: DataFrame) -> DataFrame:
    """found after the buckets of several blocks are compared across them. wide: table, kept, print; found: node, label."""
    bucket = ["table", "kept"]
    labels = found.select(F.col("node").alias("print"), "label")
    named = materialize(wide.select(*bucket, "print").join(labels, "print", "left").withColumn("label", F.coalesce("label", "print")), "named")
    sizes = materialize(named.groupBy(*bucket, "label").agg(F.count(F.lit(1)).alias("n")), "sizes")
    per = sizes.groupBy(*bucket).agg(F.max_by("label", F.struct("n", "label")).alias("largest"), (F.sum("n") - F.max("n")).alias("asking"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("parts"))
    per = per.where("parts > 1").select(F.struct(*bucket).alias("bucket"), "largest", F.ceil(F.col("asking") / BLOCK).cast("int").alias("asks_in"), F.ceil(F.col("n") / HELD).cast("int").alias("held_in"), "n")
    rows = join_dealt(named.select(F.struct(*bucket).alias("bucket"), "print", "label"), per, "bucket", "n", F.col("print"), "inner")
    own = lambda salt, parts: F.pmod(F.xxhash64("print", F.lit(salt)), F.col(parts).cast("long")).cast("int")
    every = lambda parts: F.explode(F.sequence(F.lit(0), F.col(parts) - 1))
    asking = rows.where(F.col("label") != F.col("largest")).withColumns({"ask": own(1, "asks_in")}).withColumn("held", every("held_in")).withColumn("asks", F.lit(True))
    asked = rows.withColumn("held", own(2, "held_in")).withColumn("ask", every("asks_in")).withColumn("asks", F.lit(False))
    both = asking.unionByName(asked, allowMissingColumns=True).select("bucket.table", "bucket.kept", "ask", "held", "print", "label", "asks")
    links = materialize(_links(both, [*bucket, "ask", "held"]), "links")
    # What they join is a graph of components.
    label = lambda x: labels.select(F.col("print").alias(x), F.col("label").alias(f"label_{x}"))
    of = links.join(label("a"), "a", "left").join(label("b"), "b", "left").select(F.coalesce("label_a", "a").alias("a"), F.coalesce("label_b", "b").alias("b"))
    joined = components(of.where("a <> b").distinct())
    ends = links.select(F.col("a").alias("node")).unionByName(links.select(F.col("b").alias("node"))).distinct()
    nodes = ends.join(found, "node", "full_outer").select("node", F.coalesce("label", "node").alias("label"))
    counts = nodes.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    moved = counts.join(joined.select(F.col("node").alias("label"), F.col("label").alias("to")), "label", "left")
    return materialize(join_dealt(nodes, moved, "label", "n", F.col("node")).select("node", F.coalesce("to", "label").alias("label")), "labels")


def components_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, print, component_id for every row of docs: its fingerprint, and the least id that can be reached through fingerprints that differ in RADIUS places at most.

    Null and empty texts, and texts without words, have fingerprint 0, which links like any other; texts of fewer than WIDTH words have one shingle; very long
    texts are read whole. Repeated rows and ids are all returned. Null ids stand for nothing: where a component has no other, its id is null. An empty table gives an empty result;
    other columns aren't read.
    """
    printed = materialize(fingerprints(docs, id_col, text_col), "prints")
    nodes = materialize(printed.groupBy("print").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("rows")), "nodes")
    found = join_near(nodes)
    placed = materialize(nodes.join(found.select(F.col("node").alias("print"), "label"), "print", "left").withColumn("label", F.coalesce("label", "print")), "placed")
    heads = placed.groupBy("label").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("n"))
    per = join_dealt(placed.select("print", "rows", "label"), heads, "label", "n", F.col("print"))
    return join_dealt(printed, per.select("print", "rows", "component_id"), "print", "rows", F.monotonically_increasing_id()).select("id", "print", "component_id")


def hexadecimal(column: str = "print") -> Column:
    """A fingerprint as 16 lower-case digits."""
    return F.lower(F.lpad(F.hex(column), 16, "0"))
