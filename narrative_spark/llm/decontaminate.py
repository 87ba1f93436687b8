"""Operator 4: benchmark decontamination by an FM-index for each shard of documents.

Test phrases (windows of WINDOW consecutive words of an item; a shorter item is one window) form the alphabet.
A shard is a run of whole documents inside a task; its words become symbols of that alphabet, any other word separates, and stretches too
short for a window are left out, which changes no result. The index finds all windows at once by backward
search; sampled suffix positions give the places, which are merged to removal spans for each document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from narrative_spark.llm import bytetext
from narrative_spark.llm.common import materialize, text_or_empty, tidy, unused
from narrative_spark.llm.fmindex import FMIndex

WINDOW = 13
#: Bytes of phrases that one pass sends to the executors; a larger benchmark takes several passes.
PHRASE_BYTES = 16 << 20
_SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
_OUT = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("items", T.ArrayType(T.StringType())), T.StructField("word_spans", _SPANS), T.StructField("char_spans", _SPANS)])


class Phrases:
    """Windows of benchmark items over a numbered alphabet: a matrix of their numbers for each size, and of each window the items that have it, as places in names."""

    def __init__(self, items: list[tuple[str, str]], window: int):
        self.window = window
        hashes, sizes = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for _, data, edges in bytetext.chunks(pa.array([t for _, t in items], pa.large_string())):
            words = bytetext.words_of(data, edges, bytetext.ALNUM, True)
            hashes.append(words.hash)
            sizes.append(np.diff(words.doc_words))
        self.alphabet, symbols = np.unique(np.concatenate(hashes), return_inverse=True)
        symbols, size = (symbols + 1).astype(np.int32), np.concatenate(sizes)
        begin = np.cumsum(size) - size
        self.names = sorted({name for name, _ in items})
        rank = {name: k for k, name in enumerate(self.names)}
        named = np.array([rank[name] for name, _ in items], np.int64)
        wide = np.minimum(size, window)
        self.shortest = int(min(wide[wide > 0], default=window))
        self.sets: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for w in np.unique(wide[wide > 0]):
            own = np.flatnonzero(wide == w)
            count = size[own] - w + 1
            item = np.repeat(own, count)
            start = begin[item] + np.arange(len(item)) - np.repeat(np.cumsum(count) - count, count)
            rows = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(symbols, w)[start])
            _, first, one = np.unique(rows.view(np.dtype((np.void, rows.itemsize * w))).ravel(), return_index=True, return_inverse=True)
            pair = np.unique(one.ravel() * len(self.names) + named[item])
            self.sets.append((rows[first], np.searchsorted(pair, np.arange(len(first) + 1) * len(self.names)), (pair % len(self.names)).astype(np.int32)))
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[(self.alphabet & np.uint64(len(self.maybe) - 1)).astype(np.int64)] = True

    def symbols(self, hashes: np.ndarray) -> np.ndarray:
        """Number of each word in the alphabet, 0 for others."""
        out = np.zeros(len(hashes), np.int64)
        if len(self.alphabet):
            near = np.flatnonzero(self.maybe[(hashes & np.uint64(len(self.maybe) - 1)).astype(np.int64)])
            at = np.minimum(np.searchsorted(self.alphabet, hashes[near]), len(self.alphabet) - 1)
            out[near] = np.where(self.alphabet[at] == hashes[near], at + 1, 0)
        return out

    def occurrences(self, words: bytetext.Words) -> Iterator[tuple[np.ndarray, int, list[str]]]:
        """(word places, words, items) of each window that occurs in a shard."""
        symbols = self.symbols(words.hash)
        text, place = _stretches(symbols, words.doc_words, self.shortest)
        if not len(text):
            return
        index = FMIndex(text, len(self.alphabet) + 1)
        for patterns, cut, of in self.sets:
            low, high = index.search(patterns)
            found = np.flatnonzero(high > low)
            many = high[found] - low[found]
            edges = np.concatenate(([0], np.cumsum(many)))
            at = place[index.locate(np.repeat(low[found] - edges[:-1], many) + np.arange(edges[-1]))]
            for k, one in enumerate(found):
                yield at[edges[k] : edges[k + 1]], patterns.shape[1], [self.names[i] for i in of[cut[one] : cut[one + 1]]]


def _stretches(symbols: np.ndarray, doc_words: np.ndarray, shortest: int) -> tuple[np.ndarray, np.ndarray]:
    """Runs of at least shortest words of the alphabet inside a document, each closed by 0; and each symbol's word place."""
    known = symbols > 0
    begins, ends = known.copy(), known.copy()
    edge = np.zeros(len(symbols) + 1, bool)
    edge[doc_words] = True
    begins[1:] &= ~known[:-1] | edge[1:-1]
    ends[:-1] &= ~known[1:] | edge[1:-1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    long = end - start >= shortest
    start, size = start[long], (end - start)[long]
    to = np.cumsum(size + 1)
    place = np.repeat(start - (to - size - 1), size + 1) + np.arange(to[-1] if len(to) else 0)
    text = np.zeros(len(place), np.int64)
    real = np.ones(len(place), bool)
    real[to - 1] = False
    text[real] = symbols[place[real]]
    return text, place


def _merged(hit: np.ndarray, words: bytetext.Words, d: int) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """Spans of the words marked in hit (those of text d), by word and by code point."""
    step = np.diff(np.concatenate(([0], hit.astype(np.int8), [0])))
    start, end = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    base = words.doc_words[d]
    return list(zip(start.tolist(), end.tolist(), strict=True)), list(zip(words.code_points(d, words.start[base + start]).tolist(), words.code_points(d, words.end[base + end - 1]).tolist(), strict=True))


def _scan(docs: DataFrame, phrases: Phrases, text_col: str, result: str, earlier: str | None) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(phrases)
    schema = T.StructType([*[f for f in docs.schema if f.name != earlier], T.StructField(result, _OUT)])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyspark.sql.pandas.types as types

        kind = types.to_arrow_schema(T.StructType([T.StructField("x", _OUT)])).field("x").type
        for batch in batches:
            out: list[dict] = []
            before = batch.column(earlier).to_pylist() if earlier else None
            for first, data, edges in bytetext.chunks(batch.column(text_col)):
                words = bytetext.words_of(data, edges, bytetext.ALNUM, True)
                change, items = np.zeros(len(words.hash) + 1, np.int64), {}
                for at, size, names in sent.value.occurrences(words):
                    np.add.at(change, at, 1)
                    np.add.at(change, at + size, -1)
                    for d in np.unique(np.searchsorted(words.doc_words, at, "right") - 1).tolist():
                        items.setdefault(d, set()).update(names)
                hit = np.cumsum(change[:-1]) > 0
                for d in range(len(edges) - 1):
                    a, b = words.doc_words[d], words.doc_words[d + 1]
                    names, own = items.get(d, set()), hit[a:b]
                    if before and before[first + d]["items"]:
                        names = names | set(before[first + d]["items"])
                        for x in before[first + d]["word_spans"]:
                            own[x["start"] : x["end"]] = True
                    spans, chars = _merged(own, words, d) if names else ([], [])
                    out.append({"n_words": int(b - a), "items": sorted(names), "word_spans": [{"start": x, "end": y} for x, y in spans], "char_spans": [{"start": x, "end": y} for x, y in chars]})
            columns = [c for c, f in zip(batch.columns, batch.schema.names, strict=True) if f != earlier]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(out, kind)], names=schema.names)

    return docs.mapInArrow(tidy(search), schema)


def find_overlaps(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", result: str = "overlap", phrase_bytes: int = PHRASE_BYTES) -> DataFrame:
    """docs with a struct result: n_words, items (ids whose windows occur, sorted as strings), word_spans and char_spans (merged, end exclusive).

    Words count as equal where their 64-bit hashes are. Null and empty texts have no words, no items and no spans; very long texts are
    indexed whole; overlapping and touching windows are one span; items without words or without an id never match; repeated items
    and windows count once; repeated documents are judged each for itself; empty tables on either side are fine.
    Extra columns pass through; result must be a new name.
    The phrases go to every task: their size is measured first, and a benchmark of more than phrase_bytes takes as many passes
    as it needs, each adding to the spans of the one before.
    """
    items = benchmark.select(benchmark[item_col].cast("string").alias("id"), text_or_empty(benchmark[item_text_col]).alias("text")).where("id is not null and text <> ''")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    passes = 1 + int(total // phrase_bytes)
    out, earlier = docs, None
    for k in range(passes):
        some = items if passes == 1 else items.where(F.pmod(F.xxhash64("id", "text"), F.lit(passes)) == k)
        name = result if k == passes - 1 else unused([*docs.columns, result], f"{result}__{k}")
        out, earlier = _scan(out, Phrases([(r.id, r.text) for r in some.collect()], window), text_col, name, earlier), name
        if k < passes - 1:
            out = materialize(out, "overlaps")
    return out


def verdict(result: str = "overlap") -> dict[str, Column]:
    """Digest columns of a result struct."""
    r = F.col(result)
    hit = F.aggregate(r["word_spans"], F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return {"n_words": r["n_words"], "n_hit": hit, "n_items": F.size(r["items"]).cast("long"), "items_sha256": F.sha2(F.array_join(r["items"], ","), 256), "contaminated": (hit > 0) & (20 * hit >= r["n_words"])}


def cut_spans(text_col: str = "text", result: str = "overlap") -> Column:
    """The text without its removal spans."""
    spans, text = F.col(result)["char_spans"], text_or_empty(text_col)
    edges = F.concat(F.array(F.struct(F.lit(0).cast("long").alias("start"), F.lit(0).cast("long").alias("end"))), spans)
    parts = F.transform(edges, lambda s, k: F.substring(text, (s["end"] + 1).cast("int"), (F.coalesce(F.get(spans, k)["start"], F.length(text).cast("long")) - s["end"]).cast("int")))
    return F.array_join(parts, "")
