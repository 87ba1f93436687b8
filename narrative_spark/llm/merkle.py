"""Operator 8: Merkle audit of archive replicas.

Records are ordered by a number (their place in the archive). A node covers a power of FANOUT of numbers, which is
a range of byte offsets; its hash is that of its children's hashes in order. Levels that would hardly have fewer nodes than the
one below, as of sparse numbers, are skipped. Two replicas are compared from the root down, and only branches whose hashes
differ are followed, to the records that differ. Offsets come from the byte sums that nodes hold, added up on the way down.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from narrative_spark.llm.common import materialize

BITS, SKIP = 4, 3
FANOUT = 1 << BITS
#: The number that stands for a missing one.
NONE = -(1 << 63)


def leaves(records: DataFrame, key: str, payload: str) -> DataFrame:
    """key, hash, bytes for each record number. Rows of one number are one record: equal ones with their count, others in the order of their hashes."""
    body = F.col(payload).cast("binary")
    one = records.select(F.coalesce(F.col(key).cast("long"), F.lit(NONE)).alias("key"), F.coalesce(F.sha2(body, 256), F.lit("null")).alias("hash"), F.coalesce(F.octet_length(body), F.lit(0)).cast("long").alias("bytes"))
    same = one.groupBy("key", "hash").agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes"))
    parts = F.sort_array(F.collect_list(F.concat_ws(":", "hash", F.col("n").cast("string"))))
    single = (F.count(F.lit(1)) == 1) & (F.min("n") == 1)
    return same.groupBy("key").agg(F.when(single, F.min("hash")).otherwise(F.sha2(F.array_join(parts, ","), 256)).alias("hash"), F.sum("bytes").alias("bytes"))


def shifts(*leaf_tables: DataFrame) -> list[int]:
    """Bits that each level takes off the numbers, from 0 (records) to 64 (the root). A level has at most half as many nodes as the one below, or takes
    SKIP times BITS more bits than it, so that no node has more than FANOUT ** SKIP children."""
    steps = range(BITS, 64, BITS)
    counts = [t.agg(F.count(F.lit(1)), *[F.approx_count_distinct(F.shiftright("key", k)) for k in steps]).first() for t in leaf_tables]
    nodes = dict(zip((0, *steps), map(max, *counts) if len(counts) > 1 else counts[0], strict=True))
    made = [0]
    for k in steps:
        if 2 * nodes[k] <= nodes[made[-1]] or k - made[-1] == SKIP * BITS:
            made.append(k)
        if nodes[k] <= FANOUT:
            break
    return [*made, 64]


def levels(leaf: DataFrame, shift: list[int]) -> list[DataFrame]:
    """Nodes of each level: node, parent, hash, bytes, records, before (bytes of the same parent's earlier children)."""
    made, now = [], leaf.select(F.col("key").alias("node"), "key", "hash", "bytes", F.lit(1).cast("long").alias("records"))
    for bits in [*shift[1:], None]:
        parent = F.lit(0).cast("long") if bits is None or bits == 64 else F.shiftright("key", bits)
        named = now.withColumn("parent", parent)
        before = F.coalesce(F.sum("bytes").over(W.partitionBy("parent").orderBy("node").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
        # Written, as the level above and the comparison both read it.
        named = materialize(named.withColumn("before", before), "nodes")
        made.append(named.drop("key"))
        children = F.transform(F.sort_array(F.collect_list(F.struct("node", "hash"))), lambda c: F.concat_ws(":", c["node"].cast("string"), c["hash"]))
        now = named.groupBy("parent").agg(F.sha2(F.array_join(children, ","), 256).alias("hash"), F.sum("bytes").alias("bytes"), F.sum("records").alias("records"), F.min("key").alias("key")).withColumnRenamed("parent", "node")
    return made


def audit(left: DataFrame, right: DataFrame, key: str, payload: str) -> DataFrame:
    """Records that differ between two replicas: key, status (corrupt, missing or extra on the right), offset and length on the left, hash_left, hash_right.

    Null numbers are one record, before all others (as is the least long, which has no place of its own); a null payload differs from an
    empty one; very long payloads are hashed whole; repeated rows are one record with their count, whatever their order;
    equal replicas and two empty tables give no rows; extra columns are not read. Leaves are written to the
    shared folder once, and each level joins only the children of nodes that differ.
    """
    return compare(leaves(left, key, payload), leaves(right, key, payload))


def compare(left: DataFrame, right: DataFrame) -> DataFrame:
    """As audit, of leaves (key, hash, bytes), a row for each number."""
    leaf = [materialize(x, "leaves") for x in (left, right)]
    shift = shifts(*leaf)
    a, b = (levels(x, shift) for x in leaf)
    open_ = None
    for level in range(len(shift) - 1, -1, -1):
        x, y = a[level], b[level]
        x = x.select("node", "parent", F.col("hash").alias("hash_left"), F.col("bytes").alias("length"), "before")
        y = y.select("node", "parent", F.col("hash").alias("hash_right"))
        if open_ is not None:
            x, y = (t.join(open_.select(F.col("node").alias("parent")), "parent", "left_semi") for t in (x, y))
        found = x.join(y, ["node", "parent"], "full_outer").where(~F.col("hash_left").eqNullSafe(F.col("hash_right")))
        if open_ is None:
            found = found.withColumn("offset", F.lit(0).cast("long"))
        else:
            above = open_.select(F.col("node").alias("parent"), F.col("offset").alias("base"))
            found = found.join(above, "parent").withColumn("offset", F.col("base") + F.col("before"))
        open_ = materialize(found.select("node", "offset", "length", "hash_left", "hash_right"), "branches")
    status = F.when(F.col("hash_right").isNull(), "missing").when(F.col("hash_left").isNull(), "extra").otherwise("corrupt")
    return open_.select(F.when(F.col("node") != NONE, F.col("node")).alias("key"), status.alias("status"), "offset", "length", "hash_left", "hash_right")
