"""Operator 12: how filters act on each other, for every order of them.

Every document has a mask of the filters that it fails. For each part and label, 2^FILTERS signed parity sums of the masks (a Walsh-Hadamard transform) are
aggregated; as the transform inverts exactly, they give the number of documents of each mask, and from these few cells follow all orders and shares.
"""

from __future__ import annotations

from functools import reduce
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from narrative_spark.llm.common import join_dealt, materialize

FILTERS = "ABCDE"
MASKS = 1 << len(FILTERS)
#: Bounds of the filters and the signs of D.
LEAST_WORDS, DISTINCT_PERCENT, CAPITAL_PERCENT, SIGNS = 50, 65, 5, r"[#$%&*|]"


def text_failures(text: Column) -> Column:
    """Mask of the filters that look at one text alone: A is bit 0, B bit 1, C bit 2, D bit 3."""
    whole = F.coalesce(text, F.lit(""))
    words = F.filter(F.split(whole, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    capitals = F.length(whole) - F.length(F.translate(whole, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    tests = [F.size(words) < LEAST_WORDS, 100 * F.size(F.array_distinct(words)).cast("long") < DISTINCT_PERCENT * F.size(words).cast("long"), 100 * capitals.cast("long") > CAPITAL_PERCENT * F.length(whole).cast("long"), whole.rlike(SIGNS)]
    return _sum([F.when(t, 1 << k).otherwise(0) for k, t in enumerate(tests)]).cast("int")


def _sum(items: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, items)


def failures(docs: DataFrame, good: DataFrame, toxic: DataFrame, id_col: str, text_col: str, part_col: str) -> DataFrame:
    """part, good, toxic, mask, n: documents by what they fail; good and toxic: one column of ids each.

    Texts are compared by SHA-256. Equal rows are counted before they are shuffled, then documents of one text, part and label; only these counts meet the
    text's least id, and those of a text of many parts are dealt to shares.
    """
    flag = lambda ids, name: ids.select(F.col(ids.columns[0]).alias("id")).where("id is not null").distinct().withColumn(name, F.lit(True))
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), F.unhex(F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256)).alias("same"), text_failures(F.col(text_col)).alias("mask"))
    rows = rows.groupBy("id", "part", "same", "mask").agg(F.count(F.lit(1)).alias("n"))
    marked = rows.join(flag(good, "good"), "id", "left").join(flag(toxic, "toxic"), "id", "left").withColumns({c: F.coalesce(c, F.lit(False)) for c in ("good", "toxic")})
    known = F.col("id").isNotNull()
    least = F.min(F.when(known, F.struct("id", "n")))
    counts = materialize(marked.groupBy("same", "mask", "part", "good", "toxic").agg(F.sum("n").alias("n"), F.coalesce(F.sum(F.when(known, F.col("n"))), F.lit(0)).alias("known"), least.alias("least")), "counts")
    first = counts.groupBy("same").agg(F.min("least.id").alias("first"), F.count(F.lit(1)).alias("rows"))
    both = join_dealt(counts, first, "same", "rows", F.struct("part", "good", "toxic"))
    fresh = F.when(F.col("least.id") == F.col("first"), F.col("least.n")).otherwise(0)
    copies = F.col("known") - F.coalesce(fresh, F.lit(0))
    two = F.array(F.struct(F.col("mask"), (F.col("n") - copies).alias("n")), F.struct((F.col("mask") + MASKS // 2).alias("mask"), copies.alias("n")))
    return both.select("part", "good", "toxic", F.inline(two)).where("n > 0")


def parity_sums(counted: DataFrame, keys: list[str]) -> DataFrame:
    """keys, sums: array of the signed parity sums of n over the masks, one for each set of filters."""
    sign = lambda s: F.when(F.bit_count(F.col("mask").bitwiseAND(s)) % 2 == 0, F.col("n")).otherwise(-F.col("n"))
    return counted.groupBy(*keys).agg(*[F.sum(sign(s)).alias(f"s{s}") for s in range(MASKS)]).select(*keys, F.array(*[f"s{s}" for s in range(MASKS)]).alias("sums"))


def cells(sums: Column) -> Column:
    """Rows of each mask from the parity sums: the same transform again, over the number of masks."""
    every = F.sequence(F.lit(0), F.lit(MASKS - 1))
    signed = lambda m: F.aggregate(F.zip_with(sums, every, lambda v, s: F.when(F.bit_count(s.bitwiseAND(m)) % 2 == 0, v).otherwise(-v)), F.lit(0).cast("long"), lambda a, v: a + v)
    return F.transform(every, lambda m: F.shiftright(signed(m), len(FILTERS)))


def orders(counts: DataFrame) -> DataFrame:
    """part, filter_order, step and the counts of that step, for every order of the filters; counts: part and total, good, toxic, arrays over masks."""
    names = " ".join("".join(p) for p in permutations(FILTERS))
    rows = counts.select("*", F.explode(F.split(F.lit(names), " ")).alias("filter_order"))
    rows = rows.select("*", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))).alias("step"))
    rows = rows.withColumns({"own": _bits(F.substring("filter_order", F.col("step"), F.lit(1))), "before": _bits(F.substring("filter_order", F.lit(1), F.col("step") - 1))})
    every, own, before = F.sequence(F.lit(0), F.lit(MASKS - 1)), F.col("own"), F.col("before")
    over = lambda of, weigh: F.aggregate(F.zip_with(of, every, lambda v, m: v * weigh(m)), F.lit(0).cast("long"), lambda a, v: a + v)
    one = lambda test: F.when(test, 1).otherwise(0)
    fails, gone = lambda m: m.bitwiseAND(own) != 0, lambda m: m.bitwiseAND(before) != 0
    removed = lambda of: over(of, lambda m: one(fails(m) & ~gone(m)))
    share = lambda m: F.when(fails(m), (F.lit(factorial(len(FILTERS))) / F.bit_count(m)).cast("int")).otherwise(0)
    return rows.select("part", "filter_order", "step", over("total", lambda m: one(~fails(m) & ~gone(m))).alias("kept"), removed("total").alias("removed"), over("total", lambda m: one(fails(m) & gone(m))).alias("redundant"), over("total", lambda m: one(m == own)).alias("unique_fails"), removed("good").alias("good_lost"), removed("toxic").alias("toxic_lost"), over("total", share).alias("shapley"))


def _bits(letters: Column) -> Column:
    return _sum([F.when(letters.contains(x), 1 << k).otherwise(0) for k, x in enumerate(FILTERS)]).cast("int")


def audit(docs: DataFrame, good: DataFrame, toxic: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """For each part, order of the filters and step: documents kept after it, removed by it, failing it but removed before, failing it alone, good and toxic
    ones removed by it, and its removals summed over all orders. good, toxic: one column of document ids each, in which nulls and repeated ids count for nothing.

    A null part is the empty one; null and empty texts are the same text of no words, which fail A (and E, if a smaller id has one). Very long texts are read whole. Repeated
    rows count each; rows of one id aren't copies of each other. Null ids are in no label, and are neither copies nor have any. Just at a bound a filter is passed. An empty table
    gives no parts. Other columns aren't read.
    """
    counted = failures(docs, good, toxic, id_col, text_col, part_col)
    by = parity_sums(counted, ["part", "good", "toxic"]).select("part", "good", "toxic", cells(F.col("sums")).alias("cells"))
    of = lambda test, name: F.array(*[F.coalesce(F.sum(F.when(test, F.col("cells")[m])), F.lit(0)) for m in range(MASKS)]).alias(name)
    counts = by.groupBy("part").agg(of(F.lit(True), "total"), of(F.col("good"), "good"), of(F.col("toxic"), "toxic"))
    return orders(counts)
