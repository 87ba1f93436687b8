"""BM25 straight from units, for searches that keep no index: no posting is ever a row.

Units are read twice. First each task counts in how many of its units an asked term stands; then it scores its units against the queries of their works as
products of matrices and hands on the best of each query. The rows are those of search_bm25 and search_index over the same units.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from narrative_spark.functions.text import MARKS
from narrative_spark.operators import lexical as L
from narrative_spark.sources.stages import place, stored

#: Queries that are scored together, units and signs that are counted together, and best rows that a task holds before it hands them on.
SLICE, UNITS, SIGNS, HELD = 256, 1000, 1_000_000, 2_000_000
FAR = 2**62
COUNTS, FOUND = "asker int, term int, n long", "query_id string, work_id string, unit_id string, ord long, score double, rank long"


class Askers(NamedTuple):
    """What one work is asked: limit (the boundary at which its frequencies end), terms (sorted numbers of words)."""

    number: int
    limit: int
    terms: np.ndarray


class Asked(NamedTuple):
    """Queries of a work that are scored together: their ids, boundaries and chapters, and as triples the terms, who asks them and their weights."""

    number: int
    mean: float
    ids: list[str]
    limits: np.ndarray
    chapters: list[str]
    terms: np.ndarray
    who: np.ndarray
    weights: np.ndarray


#: Runs of letters and digits.
RUN = re.compile(r"[^\W_]+")


def _pieces(batch: pa.RecordBatch, units: int, signs: int) -> Iterator[pa.RecordBatch]:
    """Parts of a batch (text and summary are its last columns) of at most so many units and about so many signs."""
    sizes = np.array([len(a) + len(b) for a, b in zip(batch.column(-2).to_pylist(), batch.column(-1).to_pylist(), strict=True)], np.int64)
    first = 0
    while first < len(sizes):
        n = max(1, int(np.searchsorted(np.cumsum(sizes[first : first + units]), signs, "right")))
        yield batch.slice(first, n)
        first += n


def _terms(texts: list[str], summaries: list[str], words: np.ndarray | dict[str, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(unit, word, tf, in order of unit and word, of the asked words; the size of each unit). words: sorted pairs as numbers, or runs with their numbers."""
    n = len(texts)
    if isinstance(words, dict):
        found = [RUN.findall(a) + RUN.findall(b) for a, b in zip(texts, summaries, strict=True)]
        sizes = np.array([len(f) for f in found], np.int64)
        word = np.fromiter((words.get(t if t.isascii() else t.translate(MARKS), -1) for f in found for t in f), np.int64, int(sizes.sum()))
        unit = np.repeat(np.arange(n), sizes)
    else:
        parts = [t for pair in zip(texts, summaries, strict=True) for t in pair]
        codes = np.frombuffer("".join(parts).encode("utf-32-le"), "<u4").astype(np.int64)
        part = np.repeat(np.arange(len(parts)), [len(t) for t in parts])
        signs = L._is_sign()[codes]
        codes, part = codes[signs], part[signs]
        sizes = np.bincount(part // 2, minlength=n)
        same = part[1:] == part[:-1]
        pair, unit = (codes[:-1][same] << 21) | codes[1:][same], part[1:][same] // 2
        word = np.minimum(np.searchsorted(words, pair), max(len(words) - 1, 0))
        word = np.where(words[word] == pair, word, -1) if len(words) else np.full(len(pair), -1)
    known = word >= 0
    key, tf = np.unique((unit[known] << 32) | word[known], return_counts=True)
    return key >> 32, key & 0xFFFFFFFF, tf, sizes


def _by_work(piece: pa.RecordBatch, works: dict, words: np.ndarray | dict[str, int]) -> Iterator[tuple]:
    """(what a work is asked, its rows in the piece, their orders and sizes, and row among them, word and tf) for each work of the piece that is asked."""
    names = np.array(piece.column(0).to_pylist(), object)
    wanted = np.flatnonzero([x in works for x in names])
    if not len(wanted):
        return
    piece, names = piece.take(pa.array(wanted)), names[wanted]
    unit, word, tf, sizes = _terms(piece.column(-2).to_pylist(), piece.column(-1).to_pylist(), words)
    order = piece.column(1).to_numpy()
    for name in set(names.tolist()):
        rows = np.flatnonzero(names == name)
        own = np.full(len(names), -1)
        own[rows] = np.arange(len(rows))
        here = own[unit]
        yield works[name], piece.take(pa.array(rows)), order[rows], sizes[rows], here[here >= 0], word[here >= 0], tf[here >= 0]


def _best(held: list[tuple], most: int, n: int) -> tuple[tuple, np.ndarray]:
    """(the best rows (who, rank, ord, score, unit_id) of each query, and what ties with the last of them; the rank of each query's last, -1 where it has fewer)."""
    who, rank, order, score, unit = (np.concatenate(x) for x in zip(*held, strict=True))
    by = np.lexsort((order, -rank, who))
    who, rank, order = who[by], rank[by], order[by]
    start = np.searchsorted(who, np.arange(n))
    size = np.diff(np.append(start, len(who)))
    last = np.minimum(start + most - 1, max(len(who) - 1, 0))[who]
    keep = (np.arange(len(who)) <= last) | (size[who] <= most) | ((rank == rank[last]) & (order == order[last]))
    full = size >= most
    least = np.full(n, -1)
    least[full] = rank[start[full] + most - 1]
    return (who[keep], rank[keep], order[keep], score[by][keep], unit[by][keep]), least


def search_units(queries: DataFrame, units: DataFrame, most: int = L.MOST, tokenizer: str = "pair", stats_scope: str = "work") -> DataFrame:
    """As search_bm25 (stats_scope "boundary": as search_index with it), over units, which should be cheap to read. Queries of more than SENT_TERMS terms in all go by postings."""
    spark = units.sparkSession
    asked = stored(L._asked(queries, tokenizer).where("work_id is not null"), "asked")
    if asked.count() > L.SENT_TERMS:
        if stats_scope == "boundary":
            return L.search_index(queries, L.write_index(units, place(spark, "index"), tokenizer), most, stats_scope)
        return L.search_bm25(queries, L.build_postings(units, tokenizer), L.index_stats(units, tokenizer), most, tokenizer)
    rows = asked.toArrow().to_pandas()
    rows["limit"] = rows["max_order"].fillna(FAR).astype("int64")
    rows["chapter"] = rows["chapter"].fillna("")
    if tokenizer == "pair":
        # Terms of one sign stand in no posting.
        rows = rows[rows["term"].str.len() == 2].copy()
        rows["code"] = [ord(t[0]) << 21 | ord(t[1]) for t in rows["term"]]
        words = np.unique(rows["code"].to_numpy(np.int64))
        rows["word"] = np.searchsorted(words, rows["code"].to_numpy(np.int64))
    else:
        names = sorted(set(rows["term"]))
        words = {t: k for k, t in enumerate(names)}
        rows["word"] = rows["term"].map(words).astype("int64")
    upto = rows["limit"] if stats_scope == "boundary" else pd.Series(FAR, rows.index)
    rows["asker"] = rows.assign(upto=upto).groupby(["work_id", "upto"], sort=True).ngroup() if len(rows) else pd.Series(0, rows.index, dtype="int64")
    works: dict[str, list[Askers]] = {}
    for (number, work), some in rows.assign(upto=upto).groupby(["asker", "work_id"], sort=True):
        works.setdefault(work, []).append(Askers(int(number), int(some["upto"].iloc[0]), np.unique(some["word"].to_numpy(np.int64))))
    texts = units.select("work_id", F.coalesce(F.col("ord").cast("long"), F.lit(FAR + 1)).alias("ord"), "unit_id", "chapter_name", F.lower(F.coalesce("text", F.lit(""))).alias("text"), F.lower(L._summary(units)).alias("summary"))
    sent = spark.sparkContext.broadcast((works, words))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        works, words = sent.value
        made: dict[int, np.ndarray] = {}
        terms = {a.number: a.terms for askers in works.values() for a in askers}
        for batch in batches:
            for piece in _pieces(batch, UNITS, SIGNS):
                for askers, _, order, sizes, unit, word, _ in _by_work(piece, works, words):
                    for a in askers:
                        seen = order <= a.limit if a.limit < FAR else np.ones(len(order), bool)
                        # Words, then units and their signs.
                        n = made.setdefault(a.number, np.zeros(len(a.terms) + 2, np.int64))
                        at = np.minimum(np.searchsorted(a.terms, word), len(a.terms) - 1)
                        n[:-2] += np.bincount(at[(a.terms[at] == word) & seen[unit]], minlength=len(a.terms))
                        n[-2:] += (seen.sum(), sizes[seen].sum())
        for number, n in made.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(n), number, np.int32)), pa.array(np.append(terms[number], (-1, -2)).astype(np.int32)), pa.array(n)], names=["asker", "term", "n"])

    counted = texts.mapInArrow(count, COUNTS).where("n > 0").groupBy("asker", "term").agg(F.sum("n").alias("n")).toArrow().to_pandas()
    whole = counted[counted["term"] < 0].pivot(index="asker", columns="term", values="n").reindex(columns=[-1, -2]).fillna(0)
    rows = rows.merge(counted, left_on=["asker", "word"], right_on=["asker", "term"], suffixes=("", "_"))
    total = rows["asker"].map(whole[-1]).to_numpy(np.float64)
    idf = np.log((total - rows["n"] + 0.5) / (rows["n"] + 0.5))
    rows["weight"] = np.where(idf <= 0, L.LEAST_IDF, idf)
    blocks: dict[str, list[Asked]] = {}
    number = 0
    for (asker, work), some in rows.groupby(["asker", "work_id"], sort=True):
        who, heads = some.groupby(["query_id", "limit", "chapter"], sort=True).ngroup().to_numpy(), some[["query_id", "limit", "chapter"]].drop_duplicates().sort_values(["query_id", "limit", "chapter"])
        for first in range(0, len(heads), SLICE):
            here, head = (who >= first) & (who < first + SLICE), heads.iloc[first : first + SLICE]
            mean = whole.loc[asker, -2] / whole.loc[asker, -1]
            blocks.setdefault(work, []).append(Asked(number, float(mean), head["query_id"].tolist(), head["limit"].to_numpy(np.int64), head["chapter"].tolist(), some["word"].to_numpy(np.int64)[here], who[here] - first, some["weight"].to_numpy(np.float64)[here]))
            number += 1
    scored = spark.sparkContext.broadcast((blocks, words))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks, words = scored.value
        every = {b.number: (work, b) for work, some in blocks.items() for b in some}
        held: dict[int, list[tuple]] = {}
        sizes_: dict[int, int] = {}
        least = {k: np.full(len(b.ids), -1) for k, (_, b) in every.items()}

        def cut(k: int) -> None:
            best, least[k] = _best(held[k], most, len(every[k][1].ids))
            held[k], sizes_[k] = [best], len(best[0])

        def told() -> Iterator[pa.RecordBatch]:
            for k in list(held):
                cut(k)
                (who, rank, order, found, unit), (work, b) = held.pop(k)[0], every[k]
                sizes_.pop(k)
                if len(who):
                    ids = pa.array(b.ids, pa.string()).take(pa.array(who))
                    yield pa.RecordBatch.from_arrays([ids, pa.array([work] * len(who), pa.string()), pa.array(unit, pa.string()), pa.array(order), pa.array(found), pa.array(rank)], names=["query_id", "work_id", "unit_id", "ord", "score", "rank"])

        for batch in batches:
            for piece in _pieces(batch, UNITS, SIGNS):
                for some, own, order, sizes, unit, word, tf in _by_work(piece, blocks, words):
                    names, chapters = np.array(own.column(2).to_pylist(), object), own.column(3).to_pylist()
                    named = np.array([c is not None for c in chapters], bool)
                    known, column = np.unique(word, return_inverse=True)
                    for b in some:
                        at = np.minimum(np.searchsorted(known, b.terms), max(len(known) - 1, 0))
                        ok = known[at] == b.terms if len(known) else np.zeros(len(at), bool)
                        if not ok.any():
                            continue
                        weights = np.zeros((len(known), len(b.ids)))
                        weights[at[ok], b.who[ok]] = b.weights[ok]
                        parts = np.zeros((len(order), len(known)))
                        parts[unit, column] = tf * (L.K1 + 1) / (tf + L.K1 * (1 - L.B + L.B * sizes[unit] / b.mean))
                        near = parts @ weights
                        rank = np.floor(near * 1e9 + 0.5).astype(np.int64)
                        hit = (near > 0) & (order[:, None] <= b.limits[None, :]) & named[:, None] & (rank >= least[b.number][None, :])
                        for j, chapter in enumerate(b.chapters):
                            if chapter:
                                hit[:, j] &= np.array([chapter in (c or "") for c in chapters], bool)
                        row, who = np.nonzero(hit)
                        if len(row):
                            held.setdefault(b.number, []).append((who, rank[row, who], order[row], near[row, who], names[row]))
                            sizes_[b.number] = sizes_.get(b.number, 0) + len(row)
                            if sizes_[b.number] > 4 * most * len(b.ids) + UNITS:
                                cut(b.number)
                if sum(sizes_.values()) > HELD:
                    for k in list(held):
                        cut(k)
                    # What is handed on early isn't held; what the best so far have passed stays known.
                    if sum(sizes_.values()) > HELD // 2:
                        yield from told()
        yield from told()

    found = texts.mapInArrow(score, FOUND)
    by = W.partitionBy("query_id").orderBy(F.col("rank").desc(), "ord", "unit_id")
    return found.withColumn("place", F.row_number().over(by)).where(F.col("place") <= most).drop("rank")
