"""Boundary-safe search for many queries at once, with its routes, diagnostics and evidence rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from narrative_spark.functions import prefix
from narrative_spark.functions import variants as V
from narrative_spark.functions.text import ustrip
from narrative_spark.operators.direct import search_units
from narrative_spark.operators.lexical import MOST, SENT_TERMS, UNITS, Index, analyze_queries, ranked, readable, search_bm25, search_index
from narrative_spark.operators.views import BLOCK, read_units
from narrative_spark.sources.stages import stored

TOP = 8


def eligible(queries: DataFrame, units: DataFrame) -> DataFrame:
    """query_id, eligible_units: how many units each query may see, where there are any.

    Without a chapter filter that is the number of units up to the boundary, counted once for each work; only queries with a filter meet the units of the
    chapters that it lets through.
    """
    block = lambda c: F.floor(c / BLOCK)
    limit = F.coalesce("max_order", F.lit(2**62)).cast("long")
    asked = queries.select("query_id", "work_id", limit.alias("max_order"), F.coalesce("chapter", F.lit("")).alias("chapter"))
    plain = asked.where("chapter = ''")
    numbered = prefix.scan(units.select("work_id", "ord", block(F.col("ord")).alias("block")), "work_id", "block", [F.col("ord")], sums={"n": F.lit(1)})
    placed = read_units(units, plain).join(numbered.select("work_id", "ord", F.col("n") + 1), ["work_id", "ord"]).toDF("work_id", "ord", "max_order", "eligible_units")
    counts = plain.join(placed, ["work_id", "max_order"]).select("query_id", "eligible_units")
    within = asked.where("chapter <> ''")
    names = units.select("work_id", "chapter_name").distinct()
    open_ = within.join(names, "work_id").where(F.col("chapter_name").contains(F.col("chapter")))
    some = open_.join(units.select("work_id", "chapter_name", "ord"), ["work_id", "chapter_name"]).where("ord <= max_order")
    return counts.unionByName(some.groupBy("query_id").agg(F.count(F.lit(1)).alias("eligible_units")))


def _codes(terms: list[str]) -> np.ndarray:
    """Terms of one or two signs as numbers."""
    return np.unique(np.array([ord(t[0]) if len(t) == 1 else ord(t[0]) << 21 | ord(t[1]) for t in terms], np.int64))


def raw_counts(units: DataFrame, terms: list[str] | None, single: bool) -> DataFrame:
    """work_id, ord, unit_id, chapter_name, term, n: for each pair of neighbouring signs of a unit, as they are written, twice its occurrences in the text that don't overlap and once those in the
    summary; with single, also n = 1 for each sign of the text. terms: those that are asked for, null for all."""
    text, summary = F.coalesce("text", F.lit("")), F.coalesce("summary", F.lit("")) if "summary" in units.columns else F.lit("")
    sent = units.sparkSession.sparkContext.broadcast(None if terms is None else _codes(terms))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for first in range(0, whole.num_rows, UNITS):
                batch = whole.slice(first, UNITS)
                parts = [t for pair in zip(batch.column(-2).to_pylist(), batch.column(-1).to_pylist(), strict=True) for t in pair]
                codes = np.frombuffer("".join(parts).encode("utf-32-le"), "<u4").astype(np.int64)
                part = np.repeat(np.arange(len(parts)), [len(t) for t in parts])
                # In a run of one sign only every second pair counts.
                begins = np.ones(len(codes), bool)
                begins[1:] = (codes[1:] != codes[:-1]) | (part[1:] != part[:-1])
                at = np.arange(len(codes))
                even = (at - np.maximum.accumulate(np.where(begins, at, 0))) % 2 == 0
                ok = (part[1:] == part[:-1]) & ((codes[1:] != codes[:-1]) | even[:-1])
                term, owner = (codes[:-1] << 21 | codes[1:])[ok], part[:-1][ok]
                weight = 2 - owner % 2
                if single:
                    alone = np.unique((part[part % 2 == 0] << 21) | codes[part % 2 == 0])
                    term, owner, weight = np.append(term, alone & ((1 << 21) - 1)), np.append(owner, alone >> 21), np.append(weight, np.ones(len(alone), np.int64))
                if sent.value is not None:
                    ok = np.isin(term, sent.value)
                    term, owner, weight = term[ok], owner[ok], weight[ok]
                by = np.lexsort((term, owner // 2))
                term, owner, weight = term[by], owner[by] // 2, weight[by]
                new = np.ones(len(term), bool)
                new[1:] = (term[1:] != term[:-1]) | (owner[1:] != owner[:-1])
                start = np.flatnonzero(new)
                n = np.add.reduceat(weight, start) if len(start) else weight
                known, place = np.unique(term[start], return_inverse=True)
                names = pa.array([chr(c) if c < 1 << 21 else chr(c >> 21) + chr(c & ((1 << 21) - 1)) for c in known.tolist()], pa.string())
                kept = [batch.column(k).take(pa.array(owner[start])) for k in range(4)]
                yield pa.RecordBatch.from_arrays([*kept, names.take(pa.array(place)), pa.array(n)], names=["work_id", "ord", "unit_id", "chapter_name", "term", "n"])

    return units.select("work_id", F.col("ord").cast("long").alias("ord"), "unit_id", "chapter_name", text.alias("text"), summary.alias("summary")).mapInArrow(count, "work_id string, ord long, unit_id string, chapter_name string, term string, n long")


def search_scan(queries: DataFrame, units: DataFrame, most: int = MOST) -> DataFrame:
    """Units by counted occurrences of the query's pairs (twice in the text, once in the summary), or of its signs where it has no pair. Pairs are counted once in each unit, whatever the number of queries."""
    asked = stored(analyze_queries(queries).select("query_id", "work_id", "max_order", "chapter", "single", F.explode("terms").alias("term")), "asked")
    terms = asked.select("term").distinct()
    few = terms.count() <= SENT_TERMS
    single = asked.where("single").limit(1).count() > 0
    counts = raw_counts(units, [r.term for r in terms.toLocalIterator()] if few else None, single)
    sent = asked.drop("single")
    rows = counts.join(F.broadcast(sent) if few and asked.count() <= SENT_TERMS else sent, ["work_id", "term"]).where(readable(queries))
    return ranked(rows.groupBy("query_id", "work_id", "unit_id", "ord").agg(F.sum("n").cast("double").alias("score")), most)


def search(queries: DataFrame, units: DataFrame, postings: DataFrame | Index | None = None, stats: DataFrame | None = None, vector_rows: DataFrame | None = None, vector_works: DataFrame | None = None, retrieval: str = "auto", tokenizer: str = "pair") -> DataFrame:
    """Ranked rows with the route they came by: vector where the work's vector index is current, else lexical, else scan.

    A lexical search without a hit falls on to the scan; a vector search without a hit doesn't. retrieval: auto, fts or vector; tokenizer: that of the postings.
    postings: a table, with stats, a kept index, which needs neither, or nothing: then units are scored where they stand.
    """
    asked = queries.join(units.select("work_id").distinct(), "work_id", "left_semi")
    by_vector = None
    if retrieval in ("auto", "vector") and vector_rows is not None and vector_works is not None:
        by_vector = vector_rows.withColumn("used", F.lit("vector"))
        asked = asked.join(vector_works.select("work_id").distinct(), "work_id", "left_anti")
    if retrieval == "vector":
        return by_vector if by_vector is not None else search_scan(asked, units).withColumn("used", F.lit("none")).limit(0)
    # Written, at most MOST rows for each query, as the queries without a hit are told by them too.
    if postings is None:
        found = search_units(asked, units, tokenizer=tokenizer)
    else:
        found = search_index(asked, postings) if isinstance(postings, Index) else search_bm25(asked, postings, stats, tokenizer=tokenizer)
    lexical = stored(found, "lexical").withColumn("used", F.lit("fts"))
    missed = asked.join(lexical.select("query_id").distinct(), "query_id", "left_anti")
    rows = lexical.unionByName(search_scan(missed, units).withColumn("used", F.lit("scan")))
    return rows if by_vector is None else rows.unionByName(by_vector)


def search_diagnostics(queries: DataFrame, units: DataFrame, rows: DataFrame, vector_works: DataFrame | None = None, retrieval: str = "auto", manifest: DataFrame | None = None) -> DataFrame:
    """One row for each query: requested and used route, reason of a fall-back, units it may see, candidates before the top is cut, and the version of its
    work's source where a manifest (work_id, source_sha256) is given."""
    known = units.select("work_id").distinct().withColumn("known", F.lit(True))
    seen = eligible(queries, units)
    got = rows.groupBy("query_id").agg(F.count(F.lit(1)).alias("candidates"), F.min("used").alias("used"))
    out = queries.join(known, "work_id", "left").join(seen, "query_id", "left").join(got, "query_id", "left")
    version = F.lit(None).cast("string")
    if manifest is not None:
        out, version = out.join(manifest.select("work_id", F.col("source_sha256").alias("version__")), "work_id", "left"), F.col("version__")
    has_vector = F.lit(False)
    if vector_works is not None:
        out = out.join(vector_works.select("work_id").distinct().withColumn("has_vector", F.lit(True)), "work_id", "left")
        has_vector = F.coalesce("has_vector", F.lit(False))
    known_work = F.coalesce("known", F.lit(False))
    fell = {"auto": "vector_then_fts_unavailable_or_no_match", "fts": "fts_unavailable_or_no_match", "vector": "vector_unavailable_or_stale"}[retrieval]
    first = F.lit("vector_unavailable_or_stale") if retrieval == "auto" else F.lit(None).cast("string")
    by_vector = has_vector & F.lit(retrieval in ("auto", "vector"))
    reason = F.when(~known_work, "work_not_found_or_empty").when(by_vector, F.lit(None)).when(F.col("used") == "fts", first).otherwise(F.lit(fell))
    route = F.when(~known_work, "none").when(by_vector, "vector").when(F.lit(retrieval == "vector"), "none").otherwise(F.coalesce("used", F.lit("scan")))
    return out.select("query_id", F.lit(retrieval).alias("requested"), route.alias("used"), reason.alias("fallback_reason"), F.coalesce("eligible_units", F.lit(0)).alias("eligible_units"), F.coalesce("candidates", F.lit(0)).alias("candidates"), version.alias("source_version"))


def normalize_refs(raw: Column) -> Column:
    """Names from a JSON array of strings and {entity} objects: stripped, blank ones and other kinds dropped, distinct in order; null when none is left."""
    said = lambda x: F.when(V.kind(x) == "STRING", V.text(x))
    name = lambda x: F.when(V.kind(x) == "OBJECT", said(V.part(x, "entity"))).otherwise(said(x))
    names = F.array_distinct(F.filter(F.transform(V.items(F.try_parse_json(raw)), lambda x: ustrip(name(x))), lambda x: F.coalesce(x, F.lit("")) != ""))
    return F.when(F.size(names) > 0, names)


def to_evidence(rows: DataFrame, units: DataFrame, top: int = TOP) -> DataFrame:
    """The first rows of each query with their source units: raw text, rounded score and a metadata struct."""
    have = set(units.columns)
    none = F.array().cast("array<string>")
    field = lambda n, default: F.col(n) if n in have else default
    metadata = F.struct(F.col("chapter_name").alias("chapter"), "chapter_idx", "start_line", "end_line", *[field(n, none).alias(n) for n in ("characters", "locations", "key_terms")], field("context_refs", F.lit(None).cast("array<string>")).alias("context_refs"))
    source = units.select("work_id", "unit_id", F.col("text").alias("raw_text"), field("summary", F.lit("")).alias("summary"), metadata.alias("metadata"))
    first = rows.where(F.col("place") <= max(0, top))
    return first.join(source, ["work_id", "unit_id"]).select("query_id", "work_id", "unit_id", "ord", "raw_text", "summary", F.round("score", 4).alias("score"), "metadata", "place", *[c for c in ("used",) if c in rows.columns])


def evaluate_retrieval(evidence: DataFrame, cases: DataFrame, k: int = 5) -> DataFrame:
    """Recall over cases (query_id, max_order, relevant): a hit is any relevant order among the first k; cases without relevant orders only count violations of the boundary."""
    got = evidence.where(F.col("place") <= k).groupBy("query_id").agg(F.array_sort(F.collect_set("ord")).alias("found"))
    every = evidence.groupBy("query_id").agg(F.max("ord").alias("furthest"))
    rows = cases.join(got, "query_id", "left").join(every, "query_id", "left")
    scored = F.size(F.coalesce("relevant", F.array().cast("array<bigint>"))) > 0
    hit = scored & F.coalesce(F.arrays_overlap("found", "relevant"), F.lit(False))
    spoiled = F.coalesce(F.col("furthest") > F.col("max_order"), F.lit(False))
    return rows.agg(F.count(F.lit(1)).alias("cases"), F.count_if(scored).alias("scored"), F.count_if(hit).alias("hits"), F.count_if(spoiled).alias("violations"), F.coalesce(F.try_divide(F.count_if(hit), F.count_if(scored)), F.lit(0.0)).alias("recall"))
