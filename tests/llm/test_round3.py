"""Whitening, the filter audit and SimHash against brute force, and on odd rows."""

import hashlib
import re
import time
from collections import Counter
from itertools import combinations, permutations

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from narrative_spark.llm import bytetext, common, decontaminate, filteraudit, html, near, quality, queries, separators, simhash, warc, whitening
from narrative_spark.llm.tokens import tokenizer_path
from tests.llm.test_operators import CLASHES, lower
from tests.llm.test_whole_results import plain_features
from tests.oracle import both


def brute_whitening(vectors):
    """id -> (deviation, centred x), and the fit, by numpy in one place."""
    x = [(i, [int(np.floor(256 * float(c))) for c in v]) for i, v in vectors]
    fit = np.array(sorted({tuple(v) for _, v in x}), object)
    n, sums = len(fit), fit.sum(0)
    z = ((fit * n - sums) / n).astype(float)
    return x, n, sums, z.T @ z / n


def test_whitening_of_a_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    x, n, sums, cov = brute_whitening(rows)
    values = np.sort(np.linalg.eigvalsh(cov))[::-1]
    got = queries.op11_whitening(spark, sf).toPandas()
    assert len(got) == 4 * len(rows) and set(got["n"]) == {n} and got["identity_error"].nunique() == 1 and got["identity_error"][0] < 1e-9
    assert {i: sum(int(n * c - s) ** 2 for c, s in zip(v, sums, strict=True)) for i, v in x} == dict(zip(got["vec_id"], got["deviation"], strict=True))
    wide = got.pivot_table(index="vec_id", columns="component", values="whitened").loc[[i for i, _ in x]].to_numpy()
    z = np.array([v for _, v in x], float) - np.array(sums / n, float)
    for k in range(4):
        assert np.allclose(got[got.component == k + 1]["explained"], values[k] / np.trace(cov), rtol=1e-9)
        direction = np.linalg.lstsq(z, wide[:, k] * np.sqrt(values[k]), rcond=None)[0]
        assert np.allclose(cov @ direction, values[k] * direction, atol=1e-6 * values[0]) and abs(direction @ direction - 1) < 1e-6


def test_whitening_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, -0.25]), (1, [0.5, -0.25]), (2, [0.501, -0.25]), (3, None), (4, [1.0, None]), (5, [nan, 1.0]), (6, [1.0, inf]), (None, [-1.0, 3.0]), (7, []), (8, [1.0, 2.0, 3.0]), (9, [-0.0, 0.0]), (10, [1e30, 0.0]), (11, [1e9, -1e9])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found, model = whitening.whiten(df.withColumns({c: F.lit("x") for c in [*CLASHES, "x", "v", "deviation"]}))
    got = found.collect()
    assert sorted((r.vec_id for r in got), key=str) == [1, 1, 11, 2, 9, None] and model.n == 4  # 2 falls on 1
    _, n, sums, _ = brute_whitening([(0, v) for v in ([0.5, -0.25], [-1.0, 3.0], [0.0, 0.0], [1e9, -1e9])])
    assert model.sums == sums.tolist() and all(len(r.whitened) == 2 for r in got)
    assert {r.vec_id: r.deviation for r in got}[9] is None  # beyond a long
    assert whitening.whiten(df.limit(0))[0].count() == 0 and whitening.whiten(df.where("vec_id = 3"))[0].count() == 0
    same, model = whitening.whiten(spark.createDataFrame([(1, [0.5, 1.0]), (2, [0.5, 1.0])], "vec_id long, embedding array<float>"))
    assert [(r.deviation, r.whitened) for r in same.collect()] == [(0, [None, None])] * 2 and model.explained().tolist() == [0, 0]


def test_whitening_is_exact_far_from_zero(spark):
    """Large whole parts, over which a covariance of sums of squares would lose all digits."""
    draw = np.random.default_rng(4)
    points = (draw.integers(0, 50, (300, 3)) + np.array([4e9, -7e9, 1e10])) / 256
    found, model = whitening.whiten(spark.createDataFrame([(k, [float(c) for c in v]) for k, v in enumerate(points)], "vec_id long, embedding array<double>"))
    x, n, sums, cov = brute_whitening(list(enumerate(points.tolist())))
    assert model.error < 1e-9 and np.allclose(model.values, np.sort(np.linalg.eigvalsh(cov))[::-1], rtol=1e-9)
    assert {r.vec_id: r.deviation for r in found.collect()} == {i: sum(int(n * c - s) ** 2 for c, s in zip(v, sums, strict=True)) for i, v in x}


def brute_audit(docs, good, toxic):
    sets = []
    for i, text, part in docs:
        t, w = text or "", re.findall(r"[^\x20\x09-\x0D]+", text or "")
        copies = i is not None and any(j is not None and j < i and (o or "") == t for j, o, _ in docs)
        tests = [len(w) < 50, 100 * len(set(w)) < 65 * len(w), 100 * len(re.findall("[A-Z]", t)) > 5 * len(t), bool(re.search("[#$%&*|]", t)), copies]
        sets.append((part or "", {x for x, bad in zip("ABCDE", tests, strict=True) if bad}, i in good, i in toxic))
    out = []
    for part in {s[0] for s in sets}:
        own, shapley = [s for s in sets if s[0] == part], dict.fromkeys("ABCDE", 0)
        rows = []
        for order in map("".join, permutations("ABCDE")):
            for k, x in enumerate(order):
                gone = [bool(s[1] & set(order[:k])) for s in own]
                cut = [s for s, g in zip(own, gone, strict=True) if x in s[1] and not g]
                shapley[x] += len(cut)
                rows.append((order, k + 1, x, sum(not s[1] & set(order[: k + 1]) for s in own), len(cut), sum(x in s[1] and g for s, g in zip(own, gone, strict=True)), sum(s[1] == {x} for s in own), sum(s[2] for s in cut), sum(s[3] for s in cut)))
        out += [(part, o, k, *n, shapley[x]) for o, k, x, *n in rows]
    return sorted(out)


def audit_rows(df):
    return sorted((r.part, r.filter_order, r.step, r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in df.collect())


def test_audit_of_odd_rows_is_that_of_brute_force(spark):
    w = [f"w{k}" for k in range(60)]
    docs = [(1, None, "a"), (2, "", "a"), (3, " ".join(w), "a"), (3, " ".join(w), "a"), (4, " ".join(w), "b"), (None, " ".join(w), "b"), (None, "x # y", None), (5, " ".join(w[:50]), None), (6, " ".join(w[:49]), ""), (7, "A " * 3 + "b" * 114, "c"), (8, "A " * 3 + "b" * 113, "c")]
    docs += [(9, " ".join(w[:39] + ["r"] * 21), "c"), (10, " ".join(w[:38] + ["r"] * 22), "c"), (11, "x" * 200_000 + " %", "c"), (12, "\x0b".join(w), "d"), (13, "É é ".join(w), "d"), (14, "same same", "d"), (15, "same same", "e"), (16, "same same", "e")]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    ids = lambda *x: spark.createDataFrame([(i,) for i in x], "doc_id long")
    good, toxic = ids(3, 4, 4, None, 16, 99), ids(7, 8, 16)
    want = brute_audit(docs, {3, 4, 16, 99}, {7, 8, 16})
    assert audit_rows(filteraudit.audit(df, good, toxic)) == want
    clashes = {c: F.lit("x") for c in [*CLASHES, "part", "mask", "good", "toxic", "same", "n", "least", "first", "known"]}
    assert audit_rows(filteraudit.audit(df.withColumns(clashes), good, toxic)) == want
    assert filteraudit.audit(df.limit(0), good, toxic).count() == 0


def test_audit_equals_its_sql_on_a_larger_table(spark):
    sf = "/root/testdata/sf0.01"
    left, right = both(queries.op12_filter_audit(spark, sf), queries.ORACLE_SQL["op12_filter_audit"], sf)
    assert left == right


def test_masks_cover_every_pair_within_the_radius():
    for bits, radius in ((8, 2), (13, 3), (20, 4)):
        masks = simhash.table_masks(bits, radius)
        for size in range(radius + 1):
            for places in combinations(range(bits), size):
                apart = sum(1 << p for p in places)
                assert any(apart & m == 0 for m in masks)
    masks = simhash.table_masks()
    assert len(masks) == simhash.TABLES and all(30 <= m.bit_count() <= 35 for m in masks)


def brute_print(text):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", lower(text)) if x]
    h = [xxhash.xxh64_intdigest(" ".join(w[i : i + 4]).encode(), 42) for i in range(max(1, len(w) - 3))] if w else []
    return sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h)) if h else 0


def brute_components(prints):
    """Label of each fingerprint: the least one that can be reached."""
    x, label = np.array(sorted(prints), np.uint64), {}
    for p in x:
        if int(p) not in label:
            found, wave = {int(p)}, [p]
            while wave:
                near = {int(q) for v in wave for q in x[np.bitwise_count(x ^ v) <= simhash.RADIUS]} - found
                found, wave = found | near, [np.uint64(q) for q in near]
            label |= dict.fromkeys(found, int(p))
    return label


def check_components(rows, every):
    prints = {i: brute_print(t) for i, t in every.items()}
    assert {r.doc_id: r.fingerprint for r in rows} == {i: f"{p:016x}" for i, p in prints.items()}
    label, least = brute_components(set(prints.values())), {}
    for i, p in prints.items():
        least[label[p]] = min(i, least.get(label[p], i))
    assert {r.doc_id: r.component_id for r in rows} == {i: least[label[p]] for i, p in prints.items()}


def test_simhash_of_a_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    check_components(queries.op13_simhash(spark, sf).collect(), {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()})


def spread(draw, centre, n, flips):
    out = set()
    while len(out) < n:
        out.add(int(centre) ^ sum(1 << int(p) for p in draw.choice(64, draw.integers(0, flips + 1), replace=False)))
    return out


@pytest.mark.parametrize("block", [simhash.BLOCK, 8])
def test_links_of_crowded_buckets_are_those_of_brute_force(spark, monkeypatch, block):
    """Clouds of fingerprints about the radius apart, in buckets of one block and of many."""
    monkeypatch.setattr(simhash, "BLOCK", block)
    monkeypatch.setattr(simhash, "HELD", 4 * block)
    draw = np.random.default_rng(5)
    prints = {0, (1 << 64) - 1}
    for n, flips in ((120, 3), (150, 6), (60, 9), (40, 12)):
        prints |= spread(draw, draw.integers(0, 1 << 63), n, flips)
    nodes = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in prints], "print long").repartition(3)
    found = {r.node % (1 << 64): r.label % (1 << 64) for r in simhash.join_near(nodes).collect()}
    label = brute_components(prints)
    groups = lambda of: {frozenset(p for p in prints if of(p) == v) for v in {of(p) for p in prints}}
    assert groups(lambda p: found.get(p, p)) == groups(label.get)
    assert len(groups(label.get)) > 20


def test_simhash_of_odd_rows(spark):
    long = " ".join(f"word{k % 977}x{k}" for k in range(60_000))
    docs = {1: None, 2: "", 3: " \n\t ", 4: "short", 5: "SHORT", 6: "one two three", 7: long, 8: long + " end", 9: "É é ß", 10: "É É ß"}
    df = spark.createDataFrame([*docs.items(), (None, "short"), (None, "alone here"), (4, "short")], "doc_id long, text string").coalesce(2)
    rows = simhash.components_of(df.withColumns({c: F.lit("x") for c in [*CLASHES, "print", "least", "rows"]})).select(F.col("id").alias("doc_id"), simhash.hexadecimal().alias("fingerprint"), "component_id").collect()
    assert len(rows) == 13
    check_components([r for r in rows if r.doc_id], docs)
    assert sorted((r.component_id for r in rows if r.doc_id is None), key=str) == [4, None]
    assert simhash.components_of(df.limit(0)).count() == 0


def test_near_duplicates_stay_when_cores_change(spark, monkeypatch):
    """The table is split otherwise between the scans of classes, and between classes and the fetch of what stays."""
    conf = "spark.sql.leafNodeDefaultParallelism"
    docs = common.materialize(spark.read.parquet("/root/testdata/sf0.01/documents.parquet").repartition(24, "doc_id"), "files")
    kept, every = near.keep_one(docs).collect(), near.classes(docs).collect()
    least = {}
    for r in every:
        least[r.class_id] = min(r.id, least.get(r.class_id, r.id))
    assert {r.doc_id for r in kept} == set(least.values())

    def then(name, cores):
        made = getattr(near, name)

        def run(*args, **more):
            out = made(*args, **more)
            spark.conf.set(conf, cores)
            return out

        monkeypatch.setattr(near, name, run)

    then("document_frequencies", "3")
    then("signatures", "7")
    then("_whole_groups", "2")
    then("classes", "5")
    spark.conf.set(conf, "16")
    try:
        assert {(r.id, r.class_id, r.n_links) for r in near.classes(docs).collect()} == {(r.id, r.class_id, r.n_links) for r in every}
        spark.conf.set(conf, "16")
        assert sorted(map(repr, near.keep_one(docs).collect())) == sorted(map(repr, kept))
    finally:
        spark.conf.unset(conf)


@pytest.mark.parametrize("strangers", [1, 3, 20])
def test_rows_sent_for_a_large_class_and_strangers(spark, monkeypatch, strangers):
    monkeypatch.setattr(near, "BLOCK", 16)
    n, key = 600, lambda k: k.to_bytes(4, "big")
    nodes = spark.createDataFrame([(bytearray(key(k)), [7] * near.BANDS, bytearray(2 * near.SAMPLES), 1.0) for k in range(n + strangers)], "key binary, bands array<long>, sketch binary, size double")
    labels = spark.createDataFrame([(bytearray(key(k)), bytearray(key(max(0, k - n + 1)))) for k in range(n + strangers)], "key binary, label binary")
    members = near._open_groups(nodes, labels)
    held, asking = -(-(n + strangers) // 16), -(-strangers // 16)
    assert near._sent(members, nodes).count() == near.BANDS * ((n + strangers) * asking + strangers * held)
    met = {}
    for r in near._with_partners(members, nodes).select("band", "k", "ask", "held", "asks", "key", "label").collect():
        met.setdefault((r.k, r.ask, r.held), []).append(r)
    asked = [(bytes(x.key), bytes(y.key)) for (k, *_), rows in met.items() if not k for x in rows if x.asks for y in rows if not y.asks and bytes(y.label) == key(0)]
    assert len(asked) == len(set(asked)) == strangers * n  # each stranger meets the whole class once


@pytest.mark.parametrize(
    ("inner", "wanted"),
    [
        ('<article><p class="advertisement">Buy</p><p>LONG</p><p class="cookie-notice">We use</p></article>', ["LONG"]),
        ('<article><p hidden>gone</p><p>LONG</p><p style="display: none">gone</p><p aria-hidden="true">gone</p></article>', ["LONG"]),
        ('<article><p>LONG</p><ul><li class="comment">Great <p>really</p> read<li>kept</li></ul></article>', ["LONG", "kept"]),
        ('<article><p>LONG</p><table><tr class="navigation"><td>a<td>b<tr><td class="sidebar">side<td>cell</table></article>', ["LONG", "cell"]),
        ('<article><p>LONG one <span class="ad">Ad <span>in</span> it</span> two <i hidden>x</i>three</p></article>', ["LONG one two three"]),
        ("<article><p>LONG <span class=ad>never closed<p>next</p></article>", ["LONG", "next"]),
        ("<article><p class=ad>Buy this<p>LONG<ul><li class=promo>Sale<ul><li>more</li></ul>still<li>keep</ul></article>", ["LONG", "keep"]),
        ('<div class=text><p>LONG</p></div><div class="discussion"><p>TALK</p></div>', ["LONG"]),
        ('<header class="post-header"><h1>Title</h1><p>by me</p></header><div class="body"><p>LONG</p></div>', ["Title", "LONG"]),
        ('<div class=page><header class="entry-header"><div><h1>Title</h1></div></header><div class="body"><p>LONG</p></div></div>', ["Title", "LONG"]),
        ('<header class="site-header"><h1>Site</h1></header><div class="body"><p>LONG</p></div>', ["LONG"]),
        ('<article><h1 class="page-header">Head</h1><p>LONG</p><pre><span class="hljs-comment">// note</span> x</pre></article>', ["Head", "LONG", "// note x"]),
        ('<div><p class="share">LONG</p></div>', ["LONG"]),
        ('<div><p><span class="social">LONG</span></p></div>', ["LONG"]),
        ("<article><p class=no-ads>LONG</p><p class=post-header>in</p></article>", ["LONG", "in"]),
    ],
)
def test_what_leaves_and_inline_elements_say(inner, wanted):
    long = "Words of the story go on and on. " * 9
    page = f"<html><body><nav><a href=/>Home</a></nav>{inner}<footer>me</footer></body></html>".replace("LONG", long).replace("TALK", long * 2)
    text = html.cut(html.read(page), [])[0]
    assert text == "\n\n".join(wanted).replace("LONG ", long).replace("LONG", long.strip())


def test_marked_leaves_are_read_in_linear_time():
    for page in ("<p class=ad>x" * 60_000, "<li class=ad><ul>" * 30_000, "<span class=ad>" * 60_000 + "x", "<h1 class=ad>" * 60_000, "<td class=ad>" * 60_000 + "</td>" * 60_000, "<p class=ad><li class=ad><td class=ad>" * 20_000 + "</p></li>" * 20_000):
        began = time.time()
        html.cut(html.read(page), [])
        assert time.time() - began < 5


def test_n_grams_are_of_characters():
    texts = ["é", "éa ñ", "日本語 x", "", None, "  ", "a b", "😀é"]
    for t in texts:
        for _, data, edges in bytetext.chunks(pa.array([t, "tail"])):
            bucket, doc = quality.features(data, edges)
            assert Counter(bucket[doc == 0].tolist()) == plain_features(t), t


def test_token_rows_are_the_same_in_every_run(spark):
    docs = common.materialize(spark.createDataFrame([(k, f"some text {k} " * k) for k in range(40)], "doc_id long, text string").repartition(4, "doc_id"), "docs")
    rows = [sorted(map(repr, separators.count_tokens(docs, tokenizer_path(), queries.SEPARATOR, 2).collect())) for _ in range(2)]
    assert rows[0] == rows[1] and len(rows[0]) == 40


def test_files_of_other_attempts_are_not_read(spark, tmp_path):
    docs = spark.createDataFrame([(k, f"text {k}") for k in range(6)], "doc_id long, text string").repartition(2)
    files = separators.write_token_files(docs, tokenizer_path(), queries.SEPARATOR, f"file://{tmp_path}", 2)
    (tmp_path / "part-000000-other.bin").write_bytes(b"\x01\x00" * 9)
    assert separators.read_token_files(spark, str(tmp_path), 2, only=files).count() == files.select("file").distinct().count() < separators.read_token_files(spark, str(tmp_path), 2).count()


def test_windows_of_many_items_are_a_matrix():
    """Windows against tuples of words, items that share them, repeated and short items; and their size in memory."""
    draw = np.random.default_rng(5)
    items = [(str(k % 70), " ".join(f"w{x}" for x in draw.integers(0, 6, draw.integers(0, 9)))) for k in range(90)]
    want = {}
    for name, text in items:
        w = text.split()
        for k in range(max(1, len(w) - 3) if w else 0):
            want.setdefault(tuple(w[k : k + 4]), set()).add(name)
    words = sorted({x for g in want for x in g})
    place = {w: int(decontaminate.Phrases([("x", w)], 4).alphabet[0]) for w in words}
    phrases = decontaminate.Phrases(items, 4)
    back = {int(np.searchsorted(phrases.alphabet, np.uint64(h))) + 1: w for w, h in place.items()}
    found = {tuple(back[int(x)] for x in row): {phrases.names[i] for i in of[cut[j] : cut[j + 1]]} for rows, cut, of in phrases.sets for j, row in enumerate(rows)}
    assert found == want
    many = decontaminate.Phrases([("a", " ".join(f"w{k}" for k in range(200_000)))], 13)
    assert sum(rows.nbytes + cut.nbytes + of.nbytes for rows, cut, of in many.sets) < 70 * 200_000 and decontaminate.Phrases([], 13).sets == []


def warc_record(k, payload, name="WARC/1.0", length=None):
    head = f"{name}\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:x:{k}>\r\nWARC-Target-URI: http://a.b/{k}\r\nContent-Length: {len(payload) if length is None else length}\r\n\r\n"
    return head.encode() + payload + b"\r\n\r\n"


def warc_file(seed, n):
    """Records of many sizes, some of which hold records themselves."""
    draw = np.random.default_rng(seed)
    out = []
    for k in range(n):
        payload = bytes(draw.integers(0, 256, int(draw.choice([0, 5, 300, 4000])), dtype=np.uint8))
        if k % 5 == 2:
            payload = b"x\r\n\r\n" + warc_record(f"in{k}", b"inner") + warc_record(f"in{k}b", b"", length=999) + payload
        out.append(warc_record(k, payload, "WARC/1.1" if k % 3 else "WARC/1.0"))
    return out


@pytest.mark.parametrize("size", [700, 5000, warc.RANGE])
def test_records_of_files_in_ranges(spark, tmp_path, size):
    files = {"a.warc": warc_file(1, 60), "b.warc": warc_file(2, 9), "none.warc": []}
    for name, records in files.items():
        (tmp_path / name).write_bytes(b"".join(records))
    got = {}
    for r in warc.read_records(spark, str(tmp_path), size).collect():
        got.setdefault(r.file.rsplit("/", 1)[1], []).append((r.ordinal, r.offset, r.length, r.record_id, r.hash))
    for name, records in files.items():
        at = np.cumsum([0, *map(len, records)]).tolist()
        assert sorted(got.get(name, [])) == [(k + 1, at[k], len(x), f"<urn:x:{k}>", hashlib.sha256(x).hexdigest()) for k, x in enumerate(records)]


def test_audit_of_two_copies_of_warc_files(spark, tmp_path):
    """Flipped bytes in payloads, a header whose length is damaged, a file that lacks its end, and one that is whole."""
    files = {"a.warc": warc_file(3, 40), "b.warc": warc_file(4, 12), "c.warc": warc_file(5, 6)}
    for side in ("l", "r"):
        (tmp_path / side).mkdir()
        for name, records in files.items():
            records = list(records)
            if side == "r" and name == "a.warc":
                records[7] = records[7][:-6] + b"#" + records[7][-5:]
                at = records[20].index(b"Content-Length: ") + 16
                records[20] = records[20][:at] + (b"9" if records[20][at : at + 1] != b"9" else b"8") + records[20][at + 1 :]
            if side == "r" and name == "b.warc":
                records = records[:-2]
            (tmp_path / side / name).write_bytes(b"".join(records))
    got = {(r.file, r.record_id): r.status for r in warc.audit_files(spark, str(tmp_path / "l"), str(tmp_path / "r"), 3000).collect()}
    want = {("a.warc", "<urn:x:7>"): "corrupt", ("a.warc", "<urn:x:20>"): "corrupt", ("b.warc", "<urn:x:10>"): "missing", ("b.warc", "<urn:x:11>"): "missing"}
    assert got == want
    assert warc.audit_files(spark, str(tmp_path / "l"), str(tmp_path / "l")).count() == 0
