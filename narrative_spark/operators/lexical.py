"""Lexical index tables and BM25 over them, made for one search or kept in a folder.

postings: work_id, term, ord, unit_id, chapter_name, tf, size. stats: work_id, n_units, mean_size. Two tokenizers: "pair" takes pairs of
neighbouring letters or digits (other signs between them don't count), "run" takes whole runs of them, without the marks of Latin letters. Both fold
case; a unit's size is the number of its letters and digits, or of its runs. Queries are analysed by the tokenizer of the postings they meet.
"""

from __future__ import annotations

import unicodedata
import uuid
from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from narrative_spark.functions import prefix
from narrative_spark.functions.text import content_signs, counted, pairs, signs, without_marks
from narrative_spark.sources.stages import stored

K1, B, LEAST_IDF, MOST = 1.2, 0.75, 1e-6, 200
#: Units whose pairs are counted together.
UNITS = 1000
#: Signs (or runs) that a slot of a kept index holds, slots at most (of a larger index each holds more), and asked terms that are sent to all tasks at most; beyond it, they are joined by a shuffle.
SLOT_SIGNS, SLOTS, SENT_TERMS = 8_000_000, 20_000, 1_000_000
#: Signs whose postings one task sorts, about.
SORTED_SIGNS = 2_000_000
#: Orders that one sort takes together.
BLOCK = 4096


def analyze_queries(queries: DataFrame, tokenizer: str = "pair") -> DataFrame:
    """queries with terms: distinct pairs of content signs in order, or the sorted signs where there is no pair; empty without signs. "run": distinct runs in order."""
    if tokenizer == "run":
        return queries.withColumn("terms", F.array_distinct(_tokens(F.coalesce("query", F.lit("")), tokenizer))).withColumn("single", F.lit(False))
    every = content_signs(F.coalesce("query", F.lit("")))
    return queries.withColumn("terms", F.when(F.size(every) >= 2, pairs(every)).otherwise(F.sort_array(F.array_distinct(every)))).withColumn("single", F.size(every) < 2)


def _tokens(text: Column, tokenizer: str) -> Column:
    folded = F.lower(text)
    if tokenizer == "run":
        return F.regexp_extract_all(without_marks(folded), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))
    found = signs(folded)
    left = F.slice(found, 1, F.greatest(F.size(found) - 1, F.lit(0)))
    return F.zip_with(left, F.slice(found, 2, F.greatest(F.size(found) - 1, F.lit(0))), lambda a, b: F.concat(a, b))


def _summary(units: DataFrame) -> Column:
    return F.coalesce("summary", F.lit("")) if "summary" in units.columns else F.lit("")


def _size(text: Column, tokenizer: str) -> Column:
    return F.length(F.regexp_replace(text, r"[^\p{L}\p{N}]+", "")) if tokenizer == "pair" else F.size(_tokens(text, tokenizer))


@cache
def _is_sign() -> np.ndarray:
    """Whether each code point is a letter or a digit."""
    return np.array([unicodedata.category(chr(k))[0] in "LN" for k in range(0x110000)])


def _pair_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (the columns but for text and summary, term, tf) from batches whose last columns are text and summary: pairs as numbers, counted for many units in one sort."""
    for whole in batches:
        for first in range(0, whole.num_rows, UNITS):
            batch = whole.slice(first, UNITS)
            parts = [t for pair in zip(batch.column(-2).to_pylist(), batch.column(-1).to_pylist(), strict=True) for t in pair]
            codes = np.frombuffer("".join(parts).encode("utf-32-le"), "<u4").astype(np.int64)
            part = np.repeat(np.arange(len(parts)), [len(t) for t in parts])
            signs_ = _is_sign()[codes]
            codes, part = codes[signs_], part[signs_]
            same = part[1:] == part[:-1]
            found, tf = np.unique((part[1:][same] // 2 << 42) | (codes[:-1][same] << 21) | codes[1:][same], return_counts=True)
            pair, place = np.unique(found & ((1 << 42) - 1), return_inverse=True)
            terms = pa.array([chr(p >> 21) + chr(p & ((1 << 21) - 1)) for p in pair.tolist()], pa.string())
            unit = pa.array(found >> 42)
            kept = [batch.column(k).take(unit) for k in range(batch.num_columns - 2)]
            yield pa.RecordBatch.from_arrays([*kept, terms.take(pa.array(place)), pa.array(tf.astype(np.int64))], names=[*batch.schema.names[:-2], "term", "tf"])


def build_postings(units: DataFrame, tokenizer: str = "pair") -> DataFrame:
    """Occurrences of each term in each unit, over text and summary, counted where the unit stands."""
    text, summary = F.coalesce("text", F.lit("")), _summary(units)
    size = (_size(text, tokenizer) + _size(summary, tokenizer)).cast("long").alias("size")
    names = ["work_id", "term", "ord", "unit_id", "chapter_name", "size", "tf"]
    if tokenizer == "pair":
        rows = units.select("work_id", "ord", "unit_id", "chapter_name", size, F.lower(text).alias("text"), F.lower(summary).alias("summary"))
        schema = ", ".join(f"{n} {t}" for n, t in rows.dtypes[:-2])
        return rows.mapInArrow(_pair_counts, f"{schema}, term string, tf long").select(*names)
    rows = units.select("work_id", "unit_id", "ord", "chapter_name", size, F.explode(counted(F.concat(_tokens(text, tokenizer), _tokens(summary, tokenizer)))).alias("t"))
    return rows.select("work_id", "t.term", "ord", "unit_id", "chapter_name", "size", "t.tf")


def index_stats(units: DataFrame, tokenizer: str = "pair") -> DataFrame:
    """Units of each work and their mean size."""
    text, summary = F.coalesce("text", F.lit("")), _summary(units)
    return units.groupBy("work_id").agg(F.count(F.lit(1)).alias("n_units"), F.avg(_size(text, tokenizer) + _size(summary, tokenizer)).alias("mean_size"))


_POSTING = "work_id string, term string, ord long, unit_id string, chapter_name string, size long, tf long, slot int"


class Index(NamedTuple):
    """A kept index. postings and terms (work_id, term, n) lie in folders by slot, sorted by work and term; works: work_id, n_units, mean_size, spread; sizes: work_id, ord, size."""

    postings: DataFrame
    terms: DataFrame
    works: DataFrame
    sizes: DataFrame
    slots: int
    signs: int  # from which on a work takes another slot
    tokenizer: str


def _slot(slots: int) -> Column:
    """Where a term of a work lies: a work's own slot, and as many after it as its size asks for (spread)."""
    return F.pmod(F.xxhash64("work_id") + F.pmod(F.xxhash64("term"), F.col("spread").cast("long")), F.lit(slots).cast("long")).cast("int").alias("slot")


def _indexed(units: DataFrame, tokenizer: str) -> tuple[DataFrame, DataFrame]:
    """(sizes, works without spread) of units."""
    text, summary = F.coalesce("text", F.lit("")), _summary(units)
    sizes = stored(units.select("work_id", "ord", (_size(text, tokenizer) + _size(summary, tokenizer)).cast("long").alias("size")), "sizes")
    return sizes, sizes.groupBy("work_id").agg(F.count(F.lit(1)).alias("n_units"), F.avg("size").alias("mean_size"))


def _spread(works: DataFrame, slots: int, signs_: int) -> DataFrame:
    """works with the number of slots that each takes: more than one for as many works as there are slots at most."""
    return works.withColumn("spread", F.least(F.greatest(F.ceil(F.col("n_units") * F.col("mean_size") / signs_), F.lit(1)), F.lit(slots)).cast("int"))


def _placed(units: DataFrame, works: DataFrame, slots: int, tokenizer: str) -> DataFrame:
    """postings with their slots."""
    large = works.where("spread > 1").select("work_id", "spread")
    return build_postings(units, tokenizer).join(F.broadcast(large), "work_id", "left").withColumn("spread", F.coalesce("spread", F.lit(1))).select("*", _slot(slots)).drop("spread")


def _counted(postings: DataFrame) -> DataFrame:
    return postings.groupBy("work_id", "term", "slot").agg(F.count(F.lit(1)).alias("n"))


def _written(rows: DataFrame, path: str, slots: int, signs_: int = 0) -> None:
    """rows in folders by slot; a slot of so many signs is dealt to tasks by blocks of orders, so that all terms of a unit lie in one file."""
    order = [c for c in ("work_id", "term", "ord") if c in rows.columns]
    share = max(1, -(-signs_ // SORTED_SIGNS))
    deal = [F.pmod(F.xxhash64("work_id", F.floor(F.col("ord") / BLOCK)), F.lit(share).cast("long"))] if "ord" in order else []
    rows.repartition(slots * share, "slot", *deal).sortWithinPartitions("slot", *order).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("slot").parquet(path)


def write_index(units: DataFrame, path: str, tokenizer: str = "pair", slots: int | None = None) -> Index:
    """An index of units in a folder, ready to be searched. A work lies in one slot, a work of more signs than a slot's share (SLOT_SIGNS at least) in several; units should be
    cheap to read, as they are read three times."""
    spark = units.sparkSession
    sizes, works = _indexed(units, tokenizer)
    total = sizes.agg(F.sum("size")).first()[0] or 0
    slots = slots or min(SLOTS, max(8, -(-total // SLOT_SIGNS)))
    signs_ = max(SLOT_SIGNS, -(-total // slots))
    works = stored(_spread(works, slots, signs_), "works")
    _written(_placed(units, works, slots, tokenizer), f"{path}/postings", slots, total // slots)
    _written(_counted(spark.read.schema(_POSTING).parquet(f"{path}/postings")), f"{path}/terms", slots)
    works.write.mode("overwrite").parquet(f"{path}/works")
    sizes.write.mode("overwrite").parquet(f"{path}/sizes")
    spark.createDataFrame([(slots, signs_, tokenizer)], "slots int, signs long, tokenizer string").write.mode("overwrite").parquet(f"{path}/kind")
    return read_index(spark, path)


def read_index(spark: SparkSession, path: str) -> Index:
    kind = spark.read.parquet(f"{path}/kind").first()
    read = lambda name, schema: spark.read.schema(schema).parquet(f"{path}/{name}")
    return Index(read("postings", _POSTING), read("terms", "work_id string, term string, n long, slot int"), read("works", "work_id string, n_units long, mean_size double, spread int"), read("sizes", "work_id string, ord long, size long"), kind.slots, kind.signs, kind.tokenizer)


def refresh_index(units: DataFrame, path: str, gone: DataFrame | None = None) -> Index:
    """The index after the works in units were written anew and those in gone (work_id) taken out. Only the slots that hold or get one of them are rewritten."""
    spark = units.sparkSession
    old = read_index(spark, path)
    sizes, works = _indexed(units, old.tokenizer)
    works = stored(_spread(works, old.slots, old.signs), "works")
    changed = works.select("work_id")
    changed = stored((changed if gone is None else changed.unionByName(gone.select("work_id"))).distinct(), "changed")
    fresh = _placed(units, works, old.slots, old.tokenizer)
    both = old.works.join(changed, "work_id", "left_semi").select("work_id", "spread").unionByName(works.select("work_id", "spread"))
    touched = both.select(F.explode(F.transform(F.sequence(F.lit(0), F.col("spread") - 1), lambda k: F.pmod(F.xxhash64("work_id") + k, F.lit(old.slots).cast("long")).cast("int"))).alias("slot")).distinct()
    slots = [r.slot for r in touched.collect()]  # as many as there are slots at most
    kept = old.postings.where(F.col("slot").isin(slots)).join(F.broadcast(changed) if changed.count() <= SENT_TERMS else changed, "work_id", "left_anti")
    # Written once, beside the slots that they replace, as those are read for it.
    new = f"{path}/new-{uuid.uuid4().hex}"
    total = int(sum(df.agg(F.sum(F.col("n_units") * F.col("mean_size"))).first()[0] or 0 for df in (old.works, works)))
    _written(kept.unionByName(fresh.select(*kept.columns)), f"{new}/postings", old.slots, total // old.slots)
    _written(_counted(spark.read.schema(_POSTING).parquet(f"{new}/postings")), f"{new}/terms", old.slots)
    at = spark._jvm.org.apache.hadoop.fs.Path
    files = at(path).getFileSystem(spark._jsc.hadoopConfiguration())
    for k in slots:
        for name in ("postings", "terms"):
            files.delete(at(f"{path}/{name}/slot={k}"), True)
            if files.exists(at(f"{new}/{name}/slot={k}")) and not files.rename(at(f"{new}/{name}/slot={k}"), at(f"{path}/{name}/slot={k}")):
                raise OSError(f"{new}/{name}/slot={k} can't take the place of the old slot")
    files.delete(at(new), True)
    for name, now, fresh_rows in (("works", old.works, works), ("sizes", old.sizes, sizes)):
        stored(now.join(changed, "work_id", "left_anti").unionByName(fresh_rows), name).write.mode("overwrite").parquet(f"{path}/{name}")
    return read_index(spark, path)


def readable(queries: DataFrame) -> Column:
    """The progress boundary and the chapter filter, as part of a join."""
    return (F.col("ord") <= F.coalesce("max_order", F.lit(2**62))) & F.col("chapter_name").contains(F.coalesce("chapter", F.lit("")))


def ranked(scored: DataFrame, most: int = MOST) -> DataFrame:
    """The best rows of each query by score, then order. Scores that agree to nine places count as equal."""
    by = W.partitionBy("query_id").orderBy(F.round("score", 9).desc(), "ord", "unit_id")
    return scored.withColumn("place", F.row_number().over(by)).where(F.col("place") <= most)


def _asked(queries: DataFrame, tokenizer: str) -> DataFrame:
    return analyze_queries(queries, tokenizer).select("query_id", "work_id", "max_order", "chapter", F.explode(F.array_distinct(F.transform("terms", lambda t: F.lower(t)))).alias("term"))


def _scored(rows: DataFrame, most: int) -> DataFrame:
    """The ranked units of rows (query_id, work_id, unit_id, ord, tf, size, n, n_units, mean_size)."""
    idf = F.log((F.col("n_units") - F.col("n") + 0.5) / (F.col("n") + 0.5))
    weight = F.when(idf <= 0, LEAST_IDF).otherwise(idf)
    part = weight * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("size") / F.col("mean_size")))
    return ranked(rows.groupBy("query_id", "work_id", "unit_id", "ord").agg(F.sum(part).alias("score")), most)


def search_bm25(queries: DataFrame, postings: DataFrame, stats: DataFrame, most: int = MOST, tokenizer: str = "pair") -> DataFrame:
    """query_id, work_id, unit_id, ord, score, place of units that hold a term of the query, inside its boundary. Frequencies are over the whole work."""
    asked = _asked(queries, tokenizer)
    # Only terms that are asked for are counted.
    wanted = postings.join(asked.select("work_id", "term").distinct(), ["work_id", "term"], "left_semi")
    spread = wanted.groupBy("work_id", "term").agg(F.count(F.lit(1)).alias("n"))
    rows = asked.join(spread, ["work_id", "term"]).join(stats, "work_id").join(wanted, ["work_id", "term"]).where(readable(queries))
    return _scored(rows, most)


def search_index(queries: DataFrame, index: Index, most: int = MOST, stats_scope: str = "work") -> DataFrame:
    """As search_bm25, over a kept index: only slots that hold an asked term are read, and their postings meet the asked terms where they lie, without a shuffle.

    stats_scope: frequencies and mean sizes over the whole "work", or only over its units up to the query's "boundary", so that what isn't read yet has no influence.
    """
    asked = _asked(queries, index.tokenizer).join(index.works, "work_id")
    asked = stored(asked.select("*", _slot(index.slots)).drop("spread"), "asked")
    sent = (lambda df: F.broadcast(df)) if asked.count() <= SENT_TERMS else (lambda df: df)
    slots = [r.slot for r in asked.select("slot").distinct().collect()]  # as many as there are slots at most
    here = lambda df: df.where(F.col("slot").isin(slots))
    at = ["slot", "work_id", "term"]
    if stats_scope == "boundary":
        asked = stored(_bounded(asked, here(index.postings), index.sizes, sent), "asked")
    else:
        asked = stored(here(index.terms).join(sent(asked), at), "asked")
    return _scored(here(index.postings).join(sent(asked), at).where(readable(queries)), most)


def _bounded(asked: DataFrame, postings: DataFrame, sizes: DataFrame, sent) -> DataFrame:
    """asked with n, n_units and mean_size as of each query's boundary: running counts of postings and of units, block by block, read off where a query stands."""
    limit = F.coalesce("max_order", F.lit(2**62)).cast("long")
    block = F.floor(F.col("at") / BLOCK)
    own = asked.withColumn("at", limit).drop("n_units", "mean_size")
    term = F.struct("work_id", "term").alias("key")
    names = ["slot", "work_id", "term"]
    seen = postings.join(sent(asked.select(*names).distinct()), names, "left_semi").select(term, F.col("ord").alias("at"), F.lit(0).alias("side"))
    marks = seen.unionByName(own.select(term, "at", F.lit(1).alias("side")).distinct()).withColumn("block", block)
    counts = prefix.scan(marks, "key", "block", [F.col("at"), F.col("side")], sums={"n": 1 - F.col("side")}).where("side = 1").select("key.work_id", "key.term", "at", "n")
    units = sizes.join(asked.select("work_id").distinct(), "work_id", "left_semi").select("work_id", F.col("ord").alias("at"), F.lit(0).alias("side"), "size")
    places = units.unionByName(own.select("work_id", "at", F.lit(1).alias("side"), F.lit(0).cast("long").alias("size")).distinct()).withColumn("block", block)
    works = prefix.scan(places, "work_id", "block", [F.col("at"), F.col("side")], sums={"n_units": 1 - F.col("side"), "total": F.col("size")}).where("side = 1")
    works = works.select("work_id", "at", "n_units", (F.col("total") / F.nullif("n_units", F.lit(0))).alias("mean_size"))
    return own.join(counts, ["work_id", "term", "at"]).join(works, ["work_id", "at"]).where("n > 0").drop("at")
