"""Operator 7: near-duplicates by improved consistent weighted sampling over TF-IDF shingles.

Shingles are runs of five words. Their weights grow with the logarithms of their count in the text and of their
rarity in the corpus (document frequency over hashed buckets, as many at every size of the corpus). Each text gets SAMPLES consistent
weighted samples; BANDS groups of them are sorted, so that texts that share a group stand side by side and
meet their next neighbours: a linear number of candidates whatever the size of a group of copies. Candidates whose samples
agree enough are verified by weighted Jaccard similarity of their whole shingle sets, and verified links are joined to
classes. Groups that then still hold texts of several classes are compared in full, all but their largest class with itself: blocks of sketches
of the other classes meet blocks of all, for the texts that have a partner there by class, size and sketch, the whole sets are fetched, and a pair of blocks returns
only the links that join classes. Equal word sequences are one text throughout.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from narrative_spark.llm import bytetext
from narrative_spark.llm.common import join_dealt, join_hot, materialize, tidy, unused
from narrative_spark.llm.components import components, roots

WIDTH, SIMILAR = 5, 0.8
BANDS, ROWS = 16, 3
SAMPLES = BANDS * ROWS
#: Neighbours that a text meets in each band. Sampled similarity that a candidate needs; a pair at 0.8 falls below it once in ten thousand times.
NEIGHBOURS, LIKELY = 3, 0.55
#: Buckets of the document frequencies.
BUCKETS = 1 << 18
#: Texts in a block of a group that is compared in full, and bytes of their whole sets; of each text, about 250 bytes meet the other blocks.
BLOCK, BLOCK_BYTES = 512, 8 << 20
#: Words of 64 row numbers that are sent to all tasks at most (64 million rows); beyond it, texts meet them by a shuffle.
SENT_WORDS = 1_000_000
_POOL = 1 << 14
_DRAW = np.random.default_rng(11)
_R = (_DRAW.gamma(2.0, 1.0, _POOL)).astype(np.float32)
_BETA = _DRAW.random(_POOL).astype(np.float32)
_G = (np.log(_DRAW.gamma(2.0, 1.0, _POOL)) + _R * _BETA - _R).astype(np.float32)
_INVERSE = (1 / _R).astype(np.float32)
_TURNS = _DRAW.integers(1, 2**63, SAMPLES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class Sets:
    """The distinct shingles of a run of texts: hash and count, sorted by text and hash. keys: digests of the word sequences, empty without words."""

    def __init__(self, data: np.ndarray, edges: np.ndarray):
        words = bytetext.words_of(data, edges, bytetext.ALNUM, True)
        h, doc = bytetext.shingles(words, WIDTH)
        by = np.argsort(h, kind="stable")
        by = by[np.argsort(doc[by], kind="stable")]
        h, doc = h[by], doc[by]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
        at = np.flatnonzero(new)
        self.hash, self.doc, self.count = h[at], doc[at], np.diff(np.append(at, len(h)))
        self.edges = np.searchsorted(self.doc, np.arange(len(edges)))
        raw, d = words.hash.tobytes(), words.doc_words
        self.keys = [hashlib.blake2b(raw[8 * d[k] : 8 * d[k + 1]], digest_size=16).digest() if d[k + 1] > d[k] else None for k in range(len(edges) - 1)]


def _bucket(h: np.ndarray) -> np.ndarray:
    return (h & np.uint64(BUCKETS - 1)).astype(np.int64)


def log_weight(h: np.ndarray, count: np.ndarray, rare: np.ndarray) -> np.ndarray:
    """Logarithm of the weights (1 + ln tf)(1 + idf)."""
    return np.log1p(np.log(count)).astype(np.float32) + rare[_bucket(h)]


def document_frequencies(docs: DataFrame, text_col: str) -> np.ndarray:
    """ln(1 + idf) of each bucket, from all documents; idf is ln((n + 1) / (df + 1)) as a share of ln(n + 1), so that it lies between 0 and 1
    whatever the corpus' size. BUCKETS numbers reach the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, total = np.zeros(BUCKETS, np.int64), 0
        for batch in batches:
            for _, data, edges in bytetext.chunks(batch.column(0)):
                sets = Sets(data, edges)
                pair = np.unique(sets.doc * BUCKETS + _bucket(sets.hash))
                seen += np.bincount(pair % BUCKETS, minlength=BUCKETS)
                total += sum(k is not None for k in sets.keys)
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(seen[at], total))], names=["bucket", "n"])

    rows = docs.select(text_col).mapInArrow(tidy(count), "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    at, n = rows.column("bucket").to_numpy(), rows.column("n").to_numpy().astype(np.int64)
    seen, total = np.zeros(BUCKETS, np.int64), int(n[at == -1].sum())
    seen[at[at >= 0]] = n[at >= 0]
    idf = np.log((total + 1) / (np.minimum(seen, total) + 1)) / max(np.log(total + 1), 1e-9)
    return np.log1p(idf).astype(np.float32)


def _samples(sets: Sets, weight: np.ndarray) -> np.ndarray:
    """SAMPLES numbers for each text that has shingles; two texts agree in one with the probability of their weighted similarity. weight: logarithms."""
    starts = sets.edges[:-1][np.diff(sets.edges) > 0]
    size = np.diff(np.append(starts, len(sets.hash)))
    out = np.zeros((len(starts), SAMPLES), np.uint64)
    for k, turn in enumerate(_TURNS):
        at = ((sets.hash * turn) >> np.uint64(50)).astype(np.int64)
        step = np.floor(weight * _INVERSE[at] + _BETA[at])
        value = _G[at] - _R[at] * step
        least = np.flatnonzero(value == np.repeat(np.minimum.reduceat(value, starts), size))
        owner = np.searchsorted(starts, least, "right")
        first = least[np.concatenate(([True], owner[1:] != owner[:-1]))]  # of equal ones the least hash
        out[:, k] = bytetext.mix(sets.hash[first] + step[first].astype(np.int64).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + turn)
    return out


def signatures(docs: DataFrame, row: str, id_col: str, text_col: str, rare: np.ndarray) -> DataFrame:
    """row, id, key (null without words), bands (array<long>), sketch (two bytes of each sample), size (sum of the weights)."""
    sent = docs.sparkSession.sparkContext.broadcast(rare)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, edges in bytetext.chunks(batch.column(2)):
                sets = Sets(data, edges)
                bands: list = [None] * len(sets.keys)
                sketch: list = [None] * len(sets.keys)
                weight = log_weight(sets.hash, sets.count, sent.value)
                size = np.bincount(sets.doc, np.exp(weight.astype(np.float64)), len(sets.keys)).astype(np.float64)  # whole numbers where there is no shingle
                if len(sets.hash):
                    got = _samples(sets, weight)
                    short = (got >> np.uint64(16)).astype("<u2")
                    mixed = np.zeros((len(got), BANDS), np.uint64)
                    for j in range(ROWS):
                        mixed = bytetext.mix(mixed * np.uint64(0xD6E8FEB86659FD93) + got[:, j::ROWS])
                    mixed = bytetext.mix(mixed + np.arange(BANDS, dtype=np.uint64)).view(np.int64)
                    for j, k in enumerate(np.flatnonzero(np.diff(sets.edges))):
                        bands[k], sketch[k] = mixed[j], short[j].tobytes()
                n = len(sets.keys)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, n), batch.column(1).slice(first, n), pa.array(sets.keys, pa.binary()), pa.array(bands, pa.list_(pa.int64())), pa.array(sketch, pa.binary()), pa.array(size)], names=["row", "id", "key", "bands", "sketch", "size"])

    return docs.select(F.col(row).alias("row"), F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(tidy(sign), "row long, id long, key binary, bands array<long>, sketch binary, size double")


def _neighbours(nodes: DataFrame) -> DataFrame:
    """Pairs a < b of texts that stand close in some band. A band's rows are sorted over all tasks, so that no group meets in one."""
    k = F.col("k")
    rows = nodes.select("key", F.posexplode("bands").alias("k", "band"), "bands").select("band", F.get(F.col("bands"), F.pmod(k + 1, F.lit(BANDS))).alias("next"), "key")
    parts = rows.sparkSession.conf.get("spark.sql.shuffle.partitions")
    rows = rows.repartitionByRange(int(parts), "band", "next", "key").sortWithinPartitions("band", "next", "key")

    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tail_bands, tail_keys = np.zeros(0, np.int64), []
        for batch in batches:
            bands = np.concatenate([tail_bands, batch.column(0).to_numpy()])
            keys = np.array(tail_keys + batch.column(1).to_pylist(), object)
            old, a, b = len(tail_keys), [], []
            for gap in range(1, NEIGHBOURS + 1):
                at = np.flatnonzero(bands[gap:] == bands[:-gap])
                at = at[at + gap >= old]
                a.append(keys[at])
                b.append(keys[at + gap])
            a, b = np.concatenate(a), np.concatenate(b)
            low = a < b
            yield pa.RecordBatch.from_arrays([pa.array(np.where(low, a, b), pa.binary()), pa.array(np.where(low, b, a), pa.binary())], names=["a", "b"])
            tail_bands, tail_keys = bands[-NEIGHBOURS:], keys[-NEIGHBOURS:].tolist()

    return rows.select("band", "key").mapInArrow(tidy(pair), "a binary, b binary").where("a <> b").distinct()


def _likely(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """a, b, agree: the pairs whose samples agree in LIKELY of all places."""
    sketch = lambda x: nodes.select(F.col("key").alias(x), F.col("sketch").alias(f"sketch_{x}"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (np.frombuffer(b"".join(c.to_pylist()), "<u2").reshape(-1, SAMPLES) for c in batch.columns[2:])
            agree = (x == y).sum(1)
            ok = pa.array(agree >= LIKELY * SAMPLES)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(ok), batch.column(1).filter(ok), pa.array(agree).filter(ok)], names=["a", "b", "agree"])

    return pairs.join(sketch("a"), "a").join(sketch("b"), "b").select("a", "b", "sketch_a", "sketch_b").mapInArrow(tidy(compare), "a binary, b binary, agree long")


def _marked(docs: DataFrame, row: str, wanted: DataFrame, there: bool) -> DataFrame:
    """The rows of docs whose number is in wanted (row), or those whose number isn't. Numbers are sent as words of 64 bits, so that texts stay where they lie."""
    word, bits = (unused([*docs.columns, "row"], x) for x in ("near__word", "near__bits"))
    place = lambda x: (F.shiftright(x, 6), F.col(x).bitwiseAND(63).cast("int"))
    of, at = place("row")
    words = wanted.groupBy(of.alias(word)).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), at)).alias(bits))
    words = materialize(words, "marked")
    of, at = place(row)
    both = docs.join(F.broadcast(words) if words.count() <= SENT_WORDS else words, of == F.col(word), "left")
    return both.where(F.coalesce(F.getbit(bits, at), F.lit(0)) == int(there)).select(*docs.columns)


def _features(docs: DataFrame, row: str, text_col: str, wanted: DataFrame, rare: np.ndarray) -> DataFrame:
    """key, hashes (sorted, 8 bytes each), weights (4 bytes each) of the texts in wanted (row): read again, as most texts are in no pair."""
    sent = docs.sparkSession.sparkContext.broadcast(rare)
    own = _marked(docs.select(F.col(row).alias("row"), F.col(text_col).alias("text")), "row", wanted, True)

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, data, edges in bytetext.chunks(batch.column(0)):
                sets = Sets(data, edges)
                weight = np.exp(log_weight(sets.hash, sets.count, sent.value))
                cut = lambda x, e=sets.edges: [x[e[k] : e[k + 1]].tobytes() for k in range(len(e) - 1)]
                yield pa.RecordBatch.from_arrays([pa.array(sets.keys, pa.binary()), pa.array(cut(sets.hash.astype("<u8")), pa.binary()), pa.array(cut(weight.astype("<f4")), pa.binary())], names=["key", "hashes", "weights"])

    return own.select("text").mapInArrow(tidy(collect), "key binary, hashes binary, weights binary")


def weighted_jaccard(left: tuple[bytes, bytes], right: tuple[bytes, bytes]) -> float:
    """Similarity of two texts from their (hashes, weights)."""
    (h, w), (g, v) = ((np.frombuffer(a, "<u8"), np.frombuffer(b, "<f4").astype(np.float64)) for a, b in (left, right))
    at = np.minimum(np.searchsorted(g, h), len(g) - 1)
    same = g[at] == h
    low = np.minimum(w[same], v[at[same]]).sum()
    return float(low / (w.sum() + v.sum() - low))


def _verified(pairs: DataFrame, features: DataFrame) -> DataFrame:
    """a, b, similarity of the pairs that reach SIMILAR on their whole sets."""
    side = lambda x: features.select(F.col("key").alias(x), F.struct("hashes", "weights").alias(f"set_{x}"))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            (h, w), (g, v) = ((c.field(0), c.field(1)) for c in batch.columns[2:])
            near = [weighted_jaccard((h[k].as_buffer(), w[k].as_buffer()), (g[k].as_buffer(), v[k].as_buffer())) for k in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(near, pa.float64())], names=["a", "b", "similarity"])

    return pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b").select("a", "b", "set_a", "set_b").mapInArrow(tidy(verify), "a binary, b binary, similarity double").where(F.col("similarity") >= SIMILAR)


def _open_groups(nodes: DataFrame, labels: DataFrame) -> DataFrame:
    """band, k, key, label, most, ask, held, of the members of the groups of several classes. Small ones count too, as the border between two tasks may have kept neighbours apart.

    most: the group's largest class. The texts of its other classes are dealt to ask blocks, all of its texts to held blocks.
    """
    rows = nodes.select("key", "bands", "size").join(labels.select("key", "label"), "key").select("key", "label", "size", F.posexplode("bands").alias("k", "band"))
    own = rows.groupBy("band", "k", "label").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("weight"))
    largest = F.max(F.struct("n", "label", "weight"))
    sums = own.groupBy("band", "k").agg(F.sum("n").alias("n"), F.sum("weight").alias("weight"), largest.alias("most"), F.count(F.lit(1)).alias("classes")).where("classes > 1")
    # A shingle takes 12 bytes and weighs 1 at least.
    blocks = lambda n, weight: F.greatest(F.lit(1), F.ceil(n / BLOCK), F.ceil(weight * 12 / BLOCK_BYTES)).cast("int")
    sums = sums.select("band", "k", F.col("most.label").alias("most"), blocks(F.col("n") - F.col("most.n"), F.col("weight") - F.col("most.weight")).alias("asking"), blocks(F.col("n"), F.col("weight")).alias("holding"), "n")
    return join_dealt(rows.select(F.struct("band", "k").alias("group"), "key", "label"), materialize(sums.select(F.struct("band", "k").alias("group"), "most", "asking", "holding", "n"), "open"), "group", "n", F.col("key"), "inner").select("group.band", "group.k", "key", "label", "most", "asking", "holding")


_PAIR = ["band", "k", "ask", "held"]
_MEMBER = "band long, k int, ask int, held int, asks boolean, most binary, key binary, label binary, bands array<long>, sketch binary, size double"


class _Part:
    """The texts of an ask block and of a held block of one group, by key."""

    def __init__(self, part: pa.Table):
        self.part = part = part.sort_by([("key", "ascending"), ("asks", "ascending")])
        self.k, self.size = part["k"][0].as_py(), part["size"].to_numpy()
        asks = part["asks"].to_numpy(zero_copy_only=False).astype(bool)
        self.asking, self.held = np.flatnonzero(asks), np.flatnonzero(~asks)
        self.sketch = np.frombuffer(b"".join(part["sketch"].to_pylist()), "<u2").reshape(-1, SAMPLES)
        self.bands = np.array(part["bands"].to_pylist(), np.int64)
        labels = part["label"].to_pylist()
        number = {x: i for i, x in enumerate(sorted(set(labels)))}
        self.group = np.array([number[x] for x in labels])
        self.first = self.group.copy()
        self.first[self.group == number.get(part["most"][0].as_py(), -1)] = len(number)  # the largest class never asks

    def partners(self, i: int) -> np.ndarray:
        """The held texts of later classes that size and sketch let through, if this is the first group that the two share; those whose samples agree most come first."""
        at = self.held[(self.first[self.held] > self.first[i]) & (np.minimum(self.size[self.held], self.size[i]) >= SIMILAR * 0.999 * np.maximum(self.size[self.held], self.size[i]))]
        agree = (self.sketch[at] == self.sketch[i]).sum(1)
        ok = (agree >= LIKELY * SAMPLES) & ~(self.bands[at, : self.k] == self.bands[i, : self.k]).any(1)
        return at[ok][np.argsort(-agree[ok], kind="stable")]


def _sent(members: DataFrame, nodes: DataFrame) -> DataFrame:
    """The rows that meet: texts of all but a group's largest class in their ask block, for each held block, and all texts in their held block, for each ask block. Only
    keys, classes, sizes and sketches are sent."""
    own = lambda salt, n: F.pmod(F.xxhash64("key", "band", F.lit(salt)), F.col(n).cast("long")).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    asking = members.where(F.col("label") != F.col("most")).withColumn("ask", own(1, "asking")).withColumn("held", every("holding")).withColumn("asks", F.lit(True))
    held = members.withColumn("held", own(2, "holding")).withColumn("ask", every("asking")).withColumn("asks", F.lit(False))
    return asking.unionByName(held, allowMissingColumns=True).drop("asking", "holding").join(nodes.select("key", "bands", "sketch", "size"), "key").select(*[x.split()[0] for x in _MEMBER.split(", ")])


def _with_partners(members: DataFrame, nodes: DataFrame) -> DataFrame:
    """The rows of _sent that have a partner where they meet."""

    def keep(part: pa.Table) -> pa.Table:
        texts = _Part(part)
        kept = np.zeros(part.num_rows, bool)
        for i in texts.asking:
            at = texts.partners(i)
            kept[at] = True
            kept[i] |= len(at) > 0
        return texts.part.filter(pa.array(kept))

    return _sent(members, nodes).groupBy(*_PAIR).applyInArrow(keep, _MEMBER)


def _joins(members: DataFrame, features: DataFrame) -> DataFrame:
    """a, b, label_a, label_b: verified links that join the classes within each pair of blocks."""

    def compare(part: pa.Table) -> pa.Table:
        texts = _Part(part)
        part, group = texts.part, texts.group.copy()
        sets = list(zip(*([x.as_buffer() for x in part[c].combine_chunks()] for c in ("hashes", "weights")), strict=True))
        left, right = [], []
        for i in texts.asking:
            for j in texts.partners(i):
                if group[i] != group[j] and weighted_jaccard(sets[i], sets[j]) >= SIMILAR:
                    left, right = [*left, i], [*right, j]
                    group[group == group[j]] = group[i]
        take = lambda name, rows: part[name].take(pa.array(rows, pa.int64()))
        return pa.Table.from_arrays([take("key", left), take("key", right), take("label", left), take("label", right)], names=["a", "b", "label_a", "label_b"])

    return members.join(features, "key").select(*[x.split()[0] for x in _MEMBER.split(", ")], "hashes", "weights").groupBy(*_PAIR).applyInArrow(compare, "a binary, b binary, label_a binary, label_b binary")


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", row: str | None = None) -> DataFrame:
    """row, id, class_row, class_id, n_links for every row of docs.

    A class is a set of texts joined by links of similarity SIMILAR or more; class_id is its least id and class_row the row
    that has it. n_links: other texts with which a link was verified (pairs that other links have joined aren't looked at again); equal word
    sequences are one text and count no link. Texts
    of fewer than five words have one shingle, all their words; null texts and texts without words are classes of
    their own; very long texts are read whole. Null ids come last; repeated rows fall into one class, and of rows of one id the
    first in the table stands for the class; an empty table gives an empty result; other columns aren't read. row: a column that numbers
    the rows, where docs is a stored table that has one; else rows are numbered and written once, as numbers made again could differ where a table is split otherwise.
    """
    named = docs
    if row is None:
        row = unused([id_col, text_col], "near__row")
        named = numbered(docs.select(id_col, text_col), row)
    rare = document_frequencies(named, text_col)
    signed = materialize(signatures(named, row, id_col, text_col, rare), "signatures")
    first = F.min(F.struct(F.col("id").isNull().alias("none"), F.col("id"), F.col("row"))).alias("best")
    nodes = materialize(signed.where("key is not null").groupBy("key").agg(first, F.count(F.lit(1)).alias("rows"), *[F.first(c).alias(c) for c in ("bands", "sketch", "size")]), "nodes")
    likely = materialize(_likely(_neighbours(nodes), nodes), "likely")
    ends = likely.select(F.col("a").alias("key")).unionByName(likely.select(F.col("b").alias("key"))).distinct()
    features = materialize(_features(named, row, text_col, nodes.join(ends, "key").select(F.col("best.row").alias("row")), rare), "features")
    # First each text with the lesser neighbour that agrees best: a forest, whose trees are found by their roots.
    best = likely.groupBy("b").agg(F.max_by("a", F.struct("agree", F.xxhash64("a", "b"))).alias("a"))
    links = materialize(_verified(best, features), "links")
    trees = roots(links.select(F.col("b").alias("node"), F.col("a").alias("parent")))
    # Then only pairs of different trees; what they join is a graph of trees.
    tree = lambda x: trees.select(F.col("node").alias(x), F.col("root").alias(f"root_{x}"))
    apart = likely.join(best, ["a", "b"], "left_anti").join(tree("a"), "a", "left").join(tree("b"), "b", "left")
    apart = apart.select("a", "b", F.coalesce("root_a", "a").alias("root_a"), F.coalesce("root_b", "b").alias("root_b")).where("root_a <> root_b")
    apart = materialize(apart, "apart")
    more = materialize(_verified(apart, features), "links")
    joined = components(apart.join(more, ["a", "b"]).select(F.col("root_a").alias("a"), F.col("root_b").alias("b")))
    links = links.unionByName(more)
    degree = links.select("a").unionByName(links.select(F.col("b").alias("a"))).groupBy(F.col("a").alias("key")).agg(F.count(F.lit(1)).alias("n_links"))
    labelled = nodes.select("key", "best").join(trees.withColumnRenamed("node", "key"), "key", "left").join(degree, "key", "left")
    labelled = materialize(labelled.withColumn("root", F.coalesce("root", "key")), "rooted")
    labelled = join_hot(labelled, joined.withColumnRenamed("node", "root"), "root", F.col("key"), labelled.count())
    labelled = materialize(labelled.select("key", "best", F.coalesce("label", "root").alias("label"), F.coalesce("n_links", F.lit(0)).alias("n_links")), "labelled")
    labelled = _whole_groups(labelled, nodes, features, ends, named, row, text_col, rare)
    heads = materialize(labelled.groupBy("label").agg(F.min("best").alias("head"), F.count(F.lit(1)).alias("keys")), "heads")
    per_key = join_dealt(labelled.select("key", "label", "n_links"), heads, "label", "keys", F.col("key"), "inner")
    per_key = materialize(per_key.join(nodes.select("key", "rows"), "key").select("key", "rows", "head", "n_links"), "keys")
    joined = join_dealt(signed.select("row", "id", "key"), per_key, "key", "rows", F.col("row"))
    return joined.select("row", "id", F.coalesce("head.row", "row").alias("class_row"), F.coalesce("head.id", F.when(F.col("head").isNull(), F.col("id"))).alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def _whole_groups(labelled: DataFrame, nodes: DataFrame, features: DataFrame, ends: DataFrame, named: DataFrame, row: str, text_col: str, rare: np.ndarray) -> DataFrame:
    """labelled after the groups that hold several classes are compared in full."""
    members = materialize(_open_groups(nodes, labelled), "members")
    if not members.limit(1).count():
        return labelled
    members = materialize(_with_partners(members, nodes), "partners")
    inside = members.select("key").distinct()
    unread = nodes.join(inside, "key", "left_semi").join(ends, "key", "left_anti").select(F.col("best.row").alias("row"))
    features = features.unionByName(materialize(_features(named, row, text_col, unread, rare), "features"))
    links = materialize(_joins(members, features), "links")
    joined = components(links.select(F.col("label_a").alias("a"), F.col("label_b").alias("b")))
    degree = links.select("a").unionByName(links.select(F.col("b").alias("a"))).groupBy(F.col("a").alias("key")).agg(F.count(F.lit(1)).alias("further"))
    moved = join_hot(labelled, joined.select(F.col("node").alias("label"), F.col("label").alias("joined")), "label", F.col("key"), labelled.count())
    moved = moved.join(degree, "key", "left")
    return materialize(moved.select("key", "best", F.coalesce("joined", "label").alias("label"), (F.col("n_links") + F.coalesce("further", F.lit(0))).alias("n_links")), "labelled")


def numbered(docs: DataFrame, row: str) -> DataFrame:
    """docs with row, a number for each row, written once to the shared folder."""
    return materialize(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")


def placed(docs: DataFrame, row: str) -> DataFrame:
    """docs with row, a number for each row by its file (in the order of their names) and its place there: nothing is written, and the numbers
    are the same however the files are split. docs: a table as it is read from its Parquet files; of any other table's rows, see numbered."""
    file, n = (unused([*docs.columns, row], x) for x in ("near__file", "near__files"))
    place = docs.metadataColumn("_metadata")
    names = sorted(r[0] for r in docs.select(place["file_path"]).distinct().collect())
    files = docs.sparkSession.createDataFrame([*enumerate(names)], f"{n} long, {file} string")
    at = docs.select("*", place["file_path"].alias(file), place["row_index"].alias(row))
    return at.join(F.broadcast(files), file).select(*docs.columns, (F.shiftleft(n, 40) + F.col(row)).alias(row))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stored: bool = False) -> DataFrame:
    """docs with one row of each class, the one with the least id; all of its columns as they were. Else as classes.

    stored: docs is a table as it is read from its files, whose rows are told by their places; without it, or where the files tell no places, docs is written once with numbers.
    """
    row = unused(docs.columns, "near__row")
    try:
        named = placed(docs, row) if stored else numbered(docs, row)
    except AnalysisException:
        named = numbered(docs, row)
    copies = classes(named, id_col, text_col, row).where("row <> class_row").select("row")
    return _marked(named, row, copies, False).select(*docs.columns)
