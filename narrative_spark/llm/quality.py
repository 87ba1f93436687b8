"""Operator 5: supervised subword embeddings for document quality.

A document is the average of learned vectors of its hashed words, word pairs and character n-grams inside words; a softmax over
that average gives its label. Vectors and softmax are trained by numpy stochastic gradient descent on a bounded sample of labelled
rows, some at a time, each feature's step shrinking with the gradients that it has seen (AdaGrad). As the average and the output are linear, scoring needs one number for each feature, so that whole texts are scored
by table look-ups.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from narrative_spark.llm import bytetext
from narrative_spark.llm.common import tidy

#: Labelled rows that training sees at most, picked by a hash of their id, and bytes of their texts together; texts are taken whole or not at all.
MAX_ROWS, MAX_BYTES = 3000, 24 << 20
BUCKETS, WIDTH, EPOCHS, RATE = 1 << 18, 16, 6, 0.2
#: Texts of a step.
BATCH = 16
NGRAMS = (2, 3, 4)
_SAME = np.uint64(0x5851F42D4C957F2D)


def features(data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, text) of every feature occurrence: words, pairs of neighbouring words (all pairs of equal words are one feature), n-grams."""
    words = bytetext.words_of(data, edges, bytetext.SOLID, False)
    count = np.diff(words.doc_words)
    doc = np.repeat(np.arange(len(count)), count)
    h, found = words.hash, [words.hash]
    docs = [doc]
    pair = np.flatnonzero(doc[1:] == doc[:-1])
    both = bytetext.mix(h[pair] * np.uint64(0x9E3779B97F4A7C15) + h[pair + 1])
    found.append(np.where(h[pair] == h[pair + 1], _SAME, both))
    docs.append(doc[pair])
    # Code points: where each begins, and the word it lies in.
    begin = np.flatnonzero((words.data & 0xC0) != 0x80)
    owner = np.searchsorted(words.start, begin, "right") - 1
    inside = np.flatnonzero((owner >= 0) & (begin < words.end[np.maximum(owner, 0)])) if len(words.end) else np.zeros(0, np.int64)
    begin = np.append(begin, np.full(max(NGRAMS), len(words.data)))
    for n in NGRAMS:
        at, to, own = begin[inside], begin[inside + n], owner[inside]
        ok = (to <= words.end[own]) & (inside + n <= len(owner)) if len(own) else np.zeros(0, bool)
        found.append(words.span_hash(at[ok], to[ok]) + np.uint64(n))
        docs.append(doc[own[ok]])
    return (np.concatenate(found) % np.uint64(BUCKETS)).astype(np.int64), np.concatenate(docs)


def train(texts: pa.Array, labels: np.ndarray, seed: int = 5) -> tuple[np.ndarray, float]:
    """(log-odds of label 1 that each feature brings, bias). Without rows of both labels the bias tells all."""
    if not len(labels) or labels.min() == labels.max():
        share = (labels.sum() + 1) / (len(labels) + 2)
        return np.zeros(BUCKETS, np.float32), float(np.log(share / (1 - share)))
    rows: list[tuple[np.ndarray, np.ndarray]] = []
    for _, data, edges in bytetext.chunks(texts):
        bucket, doc = features(data, edges)
        key, n = np.unique(doc * BUCKETS + bucket, return_counts=True)
        cut = np.searchsorted(key, np.arange(len(edges)) * BUCKETS)
        for a, b in zip(cut[:-1], cut[1:], strict=True):
            rows.append(((key[a:b] % BUCKETS).astype(np.int32), (n[a:b] / max(1, n[a:b].sum())).astype(np.float32)))
    draw = np.random.default_rng(seed)
    vectors = draw.uniform(-1 / WIDTH, 1 / WIDTH, (BUCKETS, WIDTH)).astype(np.float32)
    out, bias = np.zeros((2, WIDTH), np.float32), np.zeros(2, np.float32)
    seen, seen_out, seen_bias = np.full(BUCKETS, 1e-12, np.float32), np.full((2, WIDTH), 1e-12, np.float32), np.full(2, 1e-12, np.float32)
    step, steps = 0, EPOCHS * -(-len(rows) // BATCH)
    for _ in range(EPOCHS):
        order = draw.permutation(len(rows))
        for first in range(0, len(rows), BATCH):
            some = order[first : first + BATCH]
            rate = RATE * (1 - step / steps)
            step += 1
            at, share = (np.concatenate([rows[k][j] for k in some]) for j in (0, 1))
            size = np.array([len(rows[k][0]) for k in some])
            text = np.repeat(np.arange(len(some)), size)
            hidden = np.zeros((len(some), WIDTH), np.float32)
            starts = np.cumsum(size) - size
            hidden[size > 0] = np.add.reduceat(share[:, None] * vectors[at], starts[size > 0]) if len(at) else 0
            odds = hidden @ out.T + bias
            p = np.exp(odds - odds.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(some)), labels[some]] -= 1
            # The gradients of the batch's loss: of a feature's vector the sum of share * back over its texts, of the output and bias those of p * hidden and p.
            back = p @ out
            by = np.argsort(at, kind="stable")
            at, lead = at[by], np.flatnonzero(np.diff(at[by], prepend=-1))
            which = at[lead]
            pull = np.add.reduceat(share[by, None] * back[text[by]], lead) if len(at) else np.zeros((0, WIDTH), np.float32)
            seen[which] += (pull * pull).sum(1)
            vectors[which] -= rate * pull / np.sqrt(seen[which])[:, None]
            turn, lean = p.T @ hidden, p.sum(0)
            seen_out += turn * turn
            out -= rate * turn / np.sqrt(seen_out)
            seen_bias += lean * lean
            bias -= rate * lean / np.sqrt(seen_bias)
    return vectors @ (out[1] - out[0]), float(bias[1] - bias[0])


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that training never sees: crc32 of the id as text leaves 1 when divided by 3. A null id is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, label_col: str, id_col: str = "doc_id", text_col: str = "text", rows: int = MAX_ROWS, most: int = MAX_BYTES) -> tuple[pa.Array, np.ndarray]:
    """Texts and labels of at most rows labelled documents that are not held out, in the order of a hash of their ids as long as they fit into most bytes."""
    picked = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(id_col)).select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
    picked = picked.groupBy("id").agg(F.max("label").alias("label")).orderBy(F.xxhash64("id"), "id").limit(rows)
    known = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(picked), "id")
    # Lengths first: rows numbers at most. An id that stands for several documents counts with all of them.
    sizes = known.groupBy("id").agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0))).alias("bytes"), F.count(F.lit(1)).alias("n")).orderBy(F.xxhash64("id"), "id").collect()
    fits, total, count = [], 0, 0
    for r in sizes:
        if total + r.bytes <= most and count + r.n <= rows:
            fits, total, count = [*fits, r.id], total + r.bytes, count + r.n
    texts = known.where(F.col("id").isin(fits)).orderBy("id", F.xxhash64("text")).select("text", "label").toArrow()
    return texts.column("text").combine_chunks() if texts.num_rows else pa.array([], pa.string()), texts.column("label").to_numpy().astype(np.int64)


def score(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted for every row of docs.

    Null and empty texts have no features and score as the bias says; very long texts are scored whole, and count for training where they fit
    into MAX_BYTES; ties at 0.5 are predicted 1; repeated rows score alike, each
    for itself; rows with null labels or ids aren't trained on, and of conflicting labels 1 counts; without labels all score
    0.5; an empty table gives an empty result; other columns are not read.
    """
    weights, bias = train(*sample(docs, labels, label_col, id_col, text_col))
    sent = docs.sparkSession.sparkContext.broadcast((weights, bias))

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, base = sent.value
        for batch in batches:
            out = []
            for _, data, edges in bytetext.chunks(batch.column(1), 1 << 20):
                bucket, doc = features(data, edges)
                n = len(edges) - 1
                total = np.bincount(doc, table[bucket], n) / np.maximum(np.bincount(doc, minlength=n), 1)
                out.append(1 / (1 + np.exp(-np.clip(total + base, -500, 500))))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate(out) if out else [], pa.float64())], names=["doc_id", "score"])

    scored = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(tidy(rate), "doc_id long, score double")
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
