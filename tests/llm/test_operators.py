"""Each operator against a brute-force version, and on nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import hashlib
import re
import time
import zlib
from collections import Counter
from html.parser import HTMLParser
from itertools import combinations
from urllib.parse import urlsplit

import numpy as np
import pytest
from pyspark.sql import functions as F

from narrative_spark.llm import common, components, decontaminate, fmindex, html, merkle, near, packing, pii, quality, queries, rules, secrets, separators, spans, weak
from narrative_spark.llm.tokens import UnitTokenizer, tokenizer_path
from tests.oracle import both

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
#: Names that operators use inside.
CLASHES = ["shares", "found", "hot", "owner", "repo", "path", "id", "row", "key", "label", "words", "hash", "size", "kind", "base", "salt", "task", "n", "votes", "file", "block"]


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


@pytest.fixture(scope="module")
def odd(spark):
    long = " ".join(f"word{k % 977}x{k}" for k in range(60_000))
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "short"), (5, "one two three four five six"), (5, "one two three four five six"), (None, "no id, mail a@b.co or +1 (222) 333-4444"), (7, long), (8, "<|endoftext|> it's ÉÄ ½ 😀 password = hunter2secret"), (9, "password = hunter2secret")]
    return spark.createDataFrame([(i, t, None, None, None) for i, t in rows], DOCS)


@pytest.fixture(scope="module")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="module")
def texts(documents):
    return {r.doc_id: r.text for r in documents.collect()}


def clashing(df):
    return df.withColumns({c: F.lit("x") for c in CLASHES})


OPERATORS = {
    "rules": lambda d: rules.judge(d),
    "secrets": lambda d: secrets.find(d, "source", "doc_id"),
    "pii": lambda d: pii.find(d),
    "redact": lambda d: pii.redact(d),
    "near": lambda d: near.classes(d),
    "keep_one": lambda d: near.keep_one(d),
    "decontaminate": lambda d: decontaminate.find_overlaps(d, d.sparkSession.createDataFrame([(1, "one two three"), (2, None), (None, "short")], "item_id long, text string")),
    "quality": lambda d: quality.score(d, d.sparkSession.createDataFrame([(4, 1), (5, 0), (5, None), (None, 1)], "doc_id long, quality int")),
    "packing": lambda d: packing.pack(d, tokenizer_path()),
    "separators": lambda d: separators.count_tokens(d, tokenizer_path(), 49407),
    "html": lambda d: html.extract(d.withColumnRenamed("text", "html").withColumn("url", F.lit("http://a.b/c"))),
    "merkle": lambda d: merkle.audit(d, d.where("doc_id <> 7"), "doc_id", "text"),
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_odd_rows_empty_tables_and_clashing_columns(spark, odd, name):
    stored = odd.coalesce(2)
    got = OPERATORS[name](stored).collect()
    again = OPERATORS[name](clashing(stored)).collect()
    assert len(got) == len(again)
    assert len(got) == {"packing": len(got), "merkle": 2, "keep_one": 9}.get(name, 10)
    assert OPERATORS[name](odd.limit(0)).count() == 0


@pytest.mark.parametrize("name", ["quality", "separators", "html", "secrets", "near"])
def test_tables_without_a_word(spark, odd, name):
    assert OPERATORS[name](odd.where("doc_id <= 3").coalesce(1)).count() == 3


def test_count_of_quality_rules(documents, texts):
    def brute(text):
        w, seen = re.findall(r"[^\x20\x09-\x0D]+", text or ""), {}
        for i in range(len(w) - 7):
            seen.setdefault(tuple(w[i : i + 8]), []).append(i)
        cover = {k for v in seen.values() if len(v) > 1 for i in v for k in range(i, i + 8)}
        lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(cover)

    for r in rules.judge(documents).select("doc_id", "quality_rules.*").collect():
        n = brute(texts[r.doc_id])
        assert n == (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        assert r.base_failed == (n[0] < 20 or 100 * n[4] > 30 * n[0]) and not (r.base_failed and r.kept)


def test_repeated_windows_that_overlap(spark):
    df = spark.createDataFrame([("a " * 20,), ("a b " * 8,), (" ".join("abcdefgh") + " x " + " ".join("abcdefgh"),), (" ".join("abcdefgh"),)], "text string")
    assert [r.n_repeat_words for r in rules.measures(df).collect()] == [20, 16, 16, 0]


def test_fit_finds_who_is_right(spark):
    draw = np.random.default_rng(1)
    truth = draw.random(4000) < 0.8
    votes = [[int(t) if draw.random() < a else int(not t) for a in (0.95, 0.9, 0.6, 0.85, 0.8)] for t in truth]
    df = spark.createDataFrame([tuple(v) for v in votes], "a int, b int, c int, d int, e int")
    model = weak.fitted(weak.fit(weak.patterns(df, list("abcde")), 5, 0.7, 0.8, 0.7))
    assert abs(model.prior - 0.8) < 0.05 and model.yes[0] > model.yes[1] > model.yes[2] and abs(model.no[0] - 0.95) < 0.06


def test_rules_keep_good_documents(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    found = rules.judge(docs).select("doc_id", "quality_rules.*").join(labels, "doc_id").where("not base_failed").collect()
    good, bad = [r.kept for r in found if r.quality == 1], [r.kept for r in found if r.quality == 0]
    assert sum(good) >= 0.98 * len(good) and sum(bad) <= 0.1 * len(bad)


def base_pii(text):
    digits = lambda s: [int(c) for c in s if c.isdigit()]
    luhn = lambda d: sum(x if i % 2 == 0 else 2 * x - 9 * (x > 4) for i, x in enumerate(d[::-1])) % 10 == 0
    kinds = (
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(x) <= 255 for x in s.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda s: 13 <= len(digits(s)) <= 19 and luhn(digits(s))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 9 <= len(digits(s)) <= 15),
    )
    return [f"{k}:{m.start()}:{m.end()}" for k, p, ok in kinds for m in re.finditer(p, text or "") if ok(m[0])]


TRICKY = ["a@b.c%d@e.f x@y .@. %@a.b-c.d@e.f.g", "1.2.3.4.5.6.7.8 0001.2.3.255 1.2.3.256 a1.2.3", "4111 1111 1111 1111 4111-1111-1111-1112 41111111111111111111111 4 1 1 1", "+1 (222) 333-4444 +12 +1234567 +1..........2345678 ++49 30 123456", "😀 é a@b.co 😀 10.0.0.1"]


def test_base_spans_of_personal_data(spark, texts):
    every = {**texts, **{-k - 1: t for k, t in enumerate(TRICKY)}}
    df = spark.createDataFrame(list(every.items()), "doc_id long, text string")
    for r in pii.find(df).select("doc_id", spans.listed(F.col("pii.base")).alias("s"), spans.listed(F.col("pii.all")).alias("a")).collect():
        assert r.s == ",".join(base_pii(every[r.doc_id])), every[r.doc_id][:200]
        assert r.a.startswith(r.s)


def test_redaction_leaves_clean_texts(spark):
    df = spark.createDataFrame([(1, "write to a@b.co or +1 (222) 333-4444 now"), (2, "nothing here 12"), (3, None)], "doc_id long, text string")
    assert [r.text for r in pii.redact(df).orderBy("doc_id").collect()] == ["write to [EMAIL] or [PHONE] now", "nothing here 12", None]


def base_secrets(text):
    kinds = (("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), lambda m: len(m[2]) >= 6), ("access", re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20), ("hex", re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 24))
    found = sorted((m.start(), k, f"{name}:{m.start()}:{m.end()}") for k, (name, p, ok) in enumerate(kinds) for m in p.finditer(text or "") if ok(m))
    return [x[2] for x in found]


def test_base_spans_of_secrets(spark, texts):
    hard = ["token=token:abcdefgh secret = 'x' PASSWORD:\"abc.def=\" api_key=apikey=1234567", "AKIAAKIA" + "B" * 12 + " xAKIA" + "0" * 16, "f" * 23 + "g" + "0a" * 12 + "G" + "0" * 30, "😀 passwd: zzzzzz"]
    every = {**texts, **{-k - 1: t for k, t in enumerate(hard)}}
    df = spark.createDataFrame([(k, t, "o") for k, t in every.items()], "doc_id long, text string, source string")
    base = F.filter("secrets", lambda s: s["kind"].isin(*secrets.BASE))
    for r in secrets.find(df, "source", "doc_id").select("doc_id", spans.listed(base).alias("s")).collect():
        assert r.s == ",".join(base_secrets(every[r.doc_id])), r


#: Texts that make patterns recurse, spans crowd, or runs never end.
HARD = {
    "labels": "x@b" + ".b" * 100_000,
    "local part": "a" * 100_000 + "@b.com",
    "digits": "7" * 100_000,
    "signs": "+1 " * 30_000 + "." * 30_000,
    "mails": "mail a@b.co " * 20_000,
    "numbers": "1.2.3.4 +1 (222) 333-4444 " * 10_000,
    "wide": "😀a" * 50_000 + " a@b.co 10.0.0.1 token=abcdefgh",
    "secrets": ("token=abcdefg1 " + "ab12" * 8 + " ") * 10_000,
}


def cut_out(text, spans_):
    """Brute force of redaction."""
    out, at = [], 0
    for start, end, kind in sorted(spans_):
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join(out) + text[at:]


def test_long_words_and_many_spans(spark):
    df = spark.createDataFrame([(k, t, "o") for k, t in HARD.items()], "doc_id string, text string, source string").repartition(4)
    found = {r.doc_id: r.pii for r in pii.find(df).collect()}
    clean = {r.doc_id: r.text for r in pii.redact(df).collect()}
    for k, t in HARD.items():
        assert [f"{s.kind}:{s.start}:{s.end}" for s in found[k].base] == base_pii(t), k
        assert clean[k] == cut_out(t, [(s.start, s.end, s.kind) for s in found[k].all]), k
    for r in secrets.find(df, "source", "doc_id").collect():
        assert [f"{s.kind}:{s.start}:{s.end}" for s in r.secrets if s.kind in secrets.BASE] == base_secrets(HARD[r.doc_id]), r.doc_id


def test_pieces_and_overlaps(spark):
    draw = np.random.default_rng(8)
    text = "".join(draw.choice(list("aé😀 "), 5000))
    cuts = np.sort(draw.integers(0, 5001, (200, 2)), 1).tolist() + [[0, 1024], [1024, 2048], [0, 5000], [7, 7], [1023, 1025]]
    a, b = ([(int(x), int(x + n)) for x, n in zip(draw.integers(0, 900, 60), draw.integers(1, 12, 60), strict=True)] for _ in range(2))
    df = spark.createDataFrame([(text, cuts, a, b)], "t string, c array<array<int>>, a array<struct<start:long,end:long>>, b array<struct<start:long,end:long>>")
    ranges = F.transform("c", lambda x: F.struct(x[0].cast("long").alias("start"), x[1].cast("long").alias("end")))
    row = df.select(spans.pieces(F.col("t"), ranges).alias("p"), spans.outside(F.col("a"), F.col("b")).alias("o"), spans.running(F.transform("a", lambda x: x["start"]), lambda x, y: x + y).alias("r")).first()
    assert row.p == [text[x:y] for x, y in cuts]
    assert [(s.start, s.end) for s in row.o] == [s for s in a if not any(s[0] < o[1] and o[0] < s[1] for o in b)]
    assert row.r == np.cumsum([x for x, _ in a]).tolist()


def test_own_names_of_the_operators_stay(spark):
    own = ["pii__found", "pii__kinds", "pii__redact", "secrets__kinds", "secrets__row", "secrets__row_of", "secrets__row_found", "near__row", "overlap__0", "main_path_host", "main_path_won"]
    df = spark.createDataFrame([(1, "mail a@b.co token=abcdefgh", "o")], "doc_id long, text string, source string").withColumns({c: F.lit(c) for c in own})
    for got in (pii.find(df), pii.redact(df), secrets.find(df, "source", "doc_id"), near.keep_one(_same(df)), html.extract(df.withColumns({"url": F.lit("http://a.b"), "html": F.col("text")}))):
        row = got.first()
        assert all(row[c] == c for c in own)


def _same(df):
    from narrative_spark.llm.common import materialize

    return materialize(df, "test")


def test_ownership_tells_live_from_copied(spark):
    live, copied = "Zx9" + "aB3dE5gH7" * 4, "Qw8" + "xY2zA4bC6" * 4
    rows = [(1, f"see {live} here", "a"), (2, f"see {live} here", "a")] + [(10 + k, f"see {copied} here", f"o{k}") for k in range(6)]
    got = {r.doc_id: [(s.kind, s.n_owners, s.live) for s in r.secrets] for r in secrets.find(spark.createDataFrame(rows, "doc_id long, text string, source string"), "source", "doc_id").collect()}
    assert got[1] == [("opaque", 1, True)] and got[10] == []


def test_suffix_order_and_index():
    draw = np.random.default_rng(3)
    for n, signs in ((1, 3), (50, 2), (400, 3), (400, 30)):
        text = np.append(draw.integers(0, signs, n), 0)
        order = sorted(range(len(text)), key=lambda i: [(int(x), j if x == 0 else 0) for j, x in enumerate(text[i:].tolist(), i)])  # noqa: B023
        assert fmindex.suffix_order(text).tolist() == order
        index = fmindex.FMIndex(text, signs + 1, sample=4)
        for size in (1, 2, 5):
            patterns = draw.integers(1, signs + 1, (30, size))
            low, high = index.search(patterns)
            for p, a, b in zip(patterns, low, high, strict=True):
                want = [i for i in range(len(text) - size + 1) if (text[i : i + size] == p).all()]
                assert sorted(index.locate(np.arange(a, max(a, b))).tolist()) == want


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_its_sql(spark, sf_dir, name):
    left, right = both(queries.QUERIES[name](spark, sf_dir), queries.ORACLE_SQL[name], sf_dir)
    assert left == right


def test_several_passes_find_the_same(documents, spark, sf_dir):
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    one, many = (decontaminate.find_overlaps(documents, items, phrase_bytes=b).select("doc_id", "overlap").collect() for b in (1 << 24, 1500))
    assert sorted(map(repr, one)) == sorted(map(repr, many))
    cut = decontaminate.find_overlaps(spark.createDataFrame([("keep this: Alpha beta, gamma! and that",)], "text string"), spark.createDataFrame([(1, "alpha BETA gamma")], "item_id long, text string"))
    assert cut.select(decontaminate.cut_spans().alias("t")).first().t == "keep this: ! and that"


def shingle_counts(text):
    w = WORD.findall(lower(text))
    return Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def weighted_pairs(every):
    """(similarity, i, j) of all pairs of different texts, by whole TF-IDF sets."""
    counts = {i: shingle_counts(t) for i, t in every.items()}
    df, n = Counter(s for c in counts.values() for s in c), sum(bool(c) for c in counts.values())
    weight = {i: {s: (1 + np.log(k)) * (1 + np.log((n + 1) / (df[s] + 1)) / np.log(n + 1)) for s, k in c.items()} for i, c in counts.items()}
    total = {i: sum(w.values()) for i, w in weight.items()}
    for i, j in combinations([i for i in every if counts[i]], 2):
        if min(total[i], total[j]) >= 0.7 * max(total[i], total[j]):
            low = sum(min(x, weight[j][s]) for s, x in weight[i].items() if s in weight[j])
            if low:
                yield low / (total[i] + total[j] - low), i, j


def linked(ids, links):
    """Least id of each id's class, by joining the links one by one."""
    label = {i: i for i in ids}
    for i, j in links:
        a, b = sorted((label[i], label[j]))
        if a != b:
            label = {k: a if x == b else x for k, x in label.items()}
    return label


def check_classes(got, every):
    """Every pair clearly above the threshold is in one class, and classes hang together by pairs that aren't clearly below it."""
    pairs = [p for p in weighted_pairs(every) if p[0] >= near.SIMILAR - 0.01]
    lost = [p for p in pairs if p[0] >= near.SIMILAR + 0.01 and got[p[1]] != got[p[2]]]
    assert not lost
    loose = linked(every, [(i, j) for _, i, j in pairs])
    assert all(loose[i] == loose[c] for i, c in got.items() if every[i])
    assert all(c == min(i for i in got if got[i] == c) for c in set(got.values()))
    return pairs


def test_near_duplicates_are_those_of_brute_force(spark, documents, texts):
    base = [t for t in texts.values() if len(t.split()) > 60][:12]
    planted = {}
    for k, t in enumerate(base):
        w = t.split()
        for j in range(4):
            v = list(w)
            v[(7 * j + 3) % len(w)] = f"changed{j}"
            planted[10_000 + 10 * k + j] = " ".join(v)
    every = {**texts, **planted}
    got = {r.id: r.class_id for r in near.classes(_stored(spark, every)).collect()}
    assert len(check_classes(got, every)) > 30


def test_near_duplicates_of_a_whole_table(spark):
    """Pairs drawn without sketches: all pairs of the 1,000 documents."""
    every = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    got = {r.doc_id: r.class_id for r in queries.op7_near_duplicates(spark, "/root/testdata/sf0.01").collect()}
    check_classes(got, every)


def test_large_groups_of_several_classes_are_compared_in_full(spark, monkeypatch):
    """Texts about as far apart as the threshold: neighbours alone leave links, whole groups in small blocks don't; nor do borders between tasks."""
    monkeypatch.setattr(near, "BLOCK", 16)
    monkeypatch.setattr(near, "NEIGHBOURS", 1)
    draw, common = np.random.default_rng(3), [f"word{i}" for i in range(120)]
    every = {}
    for k in range(90):
        w = list(common)
        for at in draw.choice(24, 2 + k % 3, replace=False) * 5:
            w[at] = f"own{draw.integers(3)}x{at}"
        every[k] = " ".join(w)
    got = {r.id: r.class_id for r in near.classes(_stored(spark, every)).collect()}
    assert len(check_classes(got, every)) > 30


def _stored(spark, every):
    from narrative_spark.llm.common import materialize

    return materialize(spark.createDataFrame(list(every.items()), "doc_id long, text string").repartition(5), "test")


def test_components_of_chains_and_stars(spark):
    edges = [(k, k + 1) for k in range(1, 40)] + [(100, k) for k in range(101, 160)] + [(500, 501)]
    got = {r.node: r.label for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(1, 41), 1), **dict.fromkeys(range(100, 160), 100), 500: 500, 501: 500}
    trees = components.roots(spark.createDataFrame([(k + 1, k) for k in range(1, 40)], "node long, parent long"))
    assert {r.root for r in trees.collect()} == {1} and trees.count() == 39


def test_quality_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = quality.score(spark.read.parquet(f"{sf}/documents.parquet"), labels).join(labels, "doc_id").collect()
    out = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows) and all(0 <= r.score <= 1 for r in rows)
    assert sum(r.predicted == r.quality for r in out) >= 0.95 * len(out)


PAGE = """<html><body><nav><a href=/>Home</a></nav><div class="cookie-notice">We use cookies</div><div class="content-12"><article>
<header><h1>Big&nbsp;news</h1><p>by X</p></header><p>First   para<br>goes &amp; goes on <b>for <i>long enough</p><p>Second para <a href=x>link</a> text.</p>
<script>var a = "<p>no</p>";</script><aside>Related</aside><form><p>Sign up</p></form><ul><li>One</li><li>Two</ul></article>
<div id="comments"><p>Great read, thanks a lot, really, I mean it, this is a long comment that goes on and on and on and on and on.</p></div></div><footer>&copy; me</footer>"""


def test_main_text_of_a_page():
    text, path = html.cut(html.read(PAGE), [])
    assert text == "Big news\n\nFirst para goes & goes on for long enough\n\nSecond para link text.\n\nOne\n\nTwo" and path == "html body div.content article"


@pytest.mark.parametrize(
    ("inner", "wanted", "path"),
    [
        ("<article><header><h1>T</h1></header><div class=body><p>LONG</p></div></article>", ["T", "LONG"], "html body article"),
        ("<article><h1>T</h1><p>lead</p><div class=content><p>LONG</p></div></article>", ["T", "lead", "LONG"], "html body article"),
        ("<article><section class=intro><p>lead</p></section><section class=body><p>LONG</p></section></article>", ["lead", "LONG"], "html body article"),
        ("<article><p>lead</p><ul><li>LONG</li></ul><blockquote>said</blockquote></article>", ["lead", "LONG", "said"], "html body article"),
        ("<main><h1>T</h1><div class=body><p>LONG</p></div></main>", ["T", "LONG"], "html body main"),
        ("<div class=story><h1>T</h1><div class=in><div class=body><p>LONG</p></div></div></div>", ["T", "LONG"], "html body div.story"),
        ("<div class=page><div class=body><p>LONG</p></div><div class=more><a href=x>Another page of ours</a></div></div>", ["LONG"], "html body div.page div.body"),
    ],
)
def test_text_beside_the_best_container_stays(inner, wanted, path):
    long = "Words of the story go on and on. " * 9
    page = f"<html><body><nav><a href=/>Home</a></nav>{inner}<footer>me</footer></body></html>".replace("LONG", long)
    assert html.cut(html.read(page), []) == ("\n\n".join(wanted).replace("LONG", long.strip()), path)


@pytest.mark.parametrize(
    ("inner", "wanted", "path"),
    [
        ("<main><h1>T</h1><article><p>LONG</p></article></main>", ["T", "LONG"], "html body main"),
        ("<main><div><article><p>LONG</p></article></div><article><p>Other story</p></article></main>", ["LONG"], "html body main div article"),
        ("<main><article><p>LONG</p></article><ul><li><a href=x>Another page of ours</a></li></ul></main>", ["LONG"], "html body main article"),
    ],
)
def test_headline_of_main_stays_with_its_article(inner, wanted, path):
    long = "Words of the story go on and on. " * 9
    assert html.cut(html.read(f"<html><body>{inner}</body></html>".replace("LONG", long)), []) == ("\n\n".join(wanted).replace("LONG", long.strip()), path)


@pytest.mark.parametrize(
    ("inner", "wanted"),
    [
        ("<div class='wrap has-sidebar'><h1>T</h1><p>LONG</p><div class=sidebar><p>Other</p></div></div>", ["T", "LONG"]),
        ("<div id=ad-free-content><p>LONG</p></div>", ["LONG"]),
        ("<form id=aspnetForm><div class=a><h1>T</h1><p>LONG</p></div><div class=search><p>Find</p></div></form>", ["T", "LONG"]),
        ("<div class=no-sidebar><div class=content-with-header><p>LONG</p></div></div>", ["LONG"]),
        ("<article><div class=entry-header><h1>T</h1></div><p>LONG</p><form><p>Sign up</p></form></article>", ["T", "LONG"]),
        ("<div class=header-and-main><main><h1>T</h1><p>LONG</p></main></div>", ["T", "LONG"]),
        ("<article><header><div class=top><h1>T</h1></div><nav><h2>Parts</h2></nav></header><p>LONG</p></article>", ["T", "LONG"]),
        ("<div class='post category-social'><p>LONG</p></div><div id=comments><article class=comment-body><p>MANY</p></article></div>", ["LONG"]),
        ("<article><p>LONG</p></article><section class=related-posts><article><p>Another</p></article></section>", ["LONG"]),
        ("<div class=siteHeader><p>Us</p></div><div class=text><p>LONG</p></div><div class=adSlot><p>Buy</p></div>", ["LONG"]),
        ("<div class=sidebar><p>LONG</p></div>", ["LONG"]),
    ],
)
def test_names_are_hints_only(inner, wanted):
    long = "Words of the story go on and on. " * 9
    page = f"<html><body><nav><a href=/>Home</a></nav>{inner}<footer>me</footer></body></html>".replace("LONG", long).replace("MANY", long * 3)
    assert html.cut(html.read(page), [])[0] == "\n\n".join(wanted).replace("LONG", long.strip())


BROKEN = {
    "names": "<a" * 500_000,
    "open tag": "<p>kept</p><x" + "y" * 1_000_000,
    "open attribute": "<p>kept</p><x a='" + "y" * 1_000_000,
    "open attributes": "<p>kept</p>" + "<x a=\"" * 150_001 + ">",
    "quotes in turn": "<x a=\"'><y b='\">" * 60_000 + "<x a='\">" * 60_000,
    "signs": "< <" * 330_000,
    "deep": "<div class=a>x" * 60_000,
    "closers": "<div>" * 60_000 + "</b></section></i>" * 40_000,
    "comment": "<p>kept</p><!--" * 60_000,
    "script": "<p>kept</p><script>" + "<script " * 100_000,
    "spaces": "<p " + " " * 1_000_000 + ">kept",
    "equals": "<p " + "a=" * 400_000 + ">kept",
}


@pytest.mark.parametrize("name", sorted(BROKEN))
def test_broken_pages_are_read_in_linear_time(name):
    began = time.process_time()
    text, _ = html.cut(html.read(BROKEN[name]), [])
    assert time.process_time() - began < 5
    assert "kept" not in BROKEN[name] or text.startswith("kept")


#: Lists of its own, for what the given pages hold.
WALK_INLINE = set("a abbr b br cite code em i img input small span strong sub sup time u".split())
WALK_LEAVES = set("p h1 h2 h3 h4 h5 h6 li dt dd pre td th hr tr tbody thead figcaption".split())
WALK_VOID = set("br hr img input link meta".split())
WALK_NAMES = set("ad ads advert banner comment comments cookie footer header menu nav navbar newsletter promo related share sidebar social".split())
WALK_BOILERPLATE = set("aside button footer form head header nav noscript script select style svg template textarea title".split())


class Walk(HTMLParser):
    """Plain reading of a page: (path, text, letters in links, good) of each block, paths as tuples."""

    def __init__(self, page):
        super().__init__()
        self.stack, self.out, self.text, self.links, self.link, self.leaf = [], [], "", 0, False, ""
        self.feed(page or "")
        self.close()
        self.flush()

    def flush(self):
        if text := " ".join(self.text.split()):
            own = [t for t, _ in self.stack]
            bad = any(b for _, b in self.stack)
            self.out.append((tuple(own), text, self.links, not bad))
        self.text, self.links = "", 0

    def handle_starttag(self, tag, attrs):
        if tag in WALK_INLINE:
            self.text += " " * (tag == "br")
            self.link = self.link or tag == "a"
            return
        self.flush()
        if tag in WALK_LEAVES:
            self.leaf = tag
        elif tag not in WALK_VOID:
            a = dict(attrs)
            hint = any(w in WALK_NAMES for w in re.split(r"[-_\s]", (a.get("class") or "") + " " + (a.get("id") or "")))
            name = ".".join([tag, *sorted(re.sub(r"\d", "", w) for w in (a.get("class") or "").split())])
            self.stack.append((name, tag in WALK_BOILERPLATE or hint))

    def handle_endtag(self, tag):
        if tag in WALK_INLINE:
            self.link = self.link and tag != "a"
            return
        self.flush()
        tags = [t.split(".")[0] for t, _ in self.stack]
        if tag in tags:
            del self.stack[len(tags) - 1 - tags[::-1].index(tag) :]

    def handle_data(self, data):
        self.text += data
        self.links += len(data) if self.link else 0


def plain_vote(found):
    """The best container of a page, by comparing paths outright; up to the article around it."""
    scores = {}
    for path, text, links, good in found:
        if good and len(text) > links:
            for up in range(min(4, len(path))):
                scores[path[: len(path) - up]] = scores.get(path[: len(path) - up], 0) + (len(text) - links) / 2**up
    if not scores:
        return ()
    best = max(scores, key=lambda p: (scores[p], len(p)))
    return max((best[:k] for k in range(1, len(best) + 1) if best[k - 1].split(".")[0] in ("article", "main")), key=len, default=best)


def test_main_text_of_all_pages_equals_a_plain_walk(spark):
    """The whole table: pages voted on and cut by comparing tuples, read by Python's own parser."""
    sf = "/root/testdata/sf0.01"
    pages = spark.read.parquet(f"{sf}/pages.parquet").collect()
    walked = {r.page_id: Walk(r.html).out for r in pages}
    host = {r.page_id: urlsplit(r.url or "").hostname or "" for r in pages}
    votes = {}
    for i, found in walked.items():
        if vote := plain_vote(found):
            votes.setdefault(host[i], Counter())[vote] += 1
    for r in queries.op3_main_text(spark, sf).collect():
        found, cast = walked[r.page_id], votes.get(host[r.page_id], Counter())
        won = [p for p, n in cast.most_common() if n >= html.SHARE * cast.total()]
        path = plain_vote(found)
        path = path if path in won else next((p for p in won if any(b[3] and b[0][: len(p)] == p for b in found)), path)
        text = "\n\n".join(b[1] for b in found if b[3] and b[0][: len(path)] == path)
        assert (r.text, r.n_chars, r.path) == (text, len(text), " ".join(path)), r.page_id


def test_large_hosts_are_dealt_to_shares(spark, monkeypatch):
    """Winners joined by a shuffle, a hot host's pages over many shares: the same rows as with winners sent to all tasks."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").withColumn("url", F.when(F.col("page_id") % 3 == 0, F.lit("http://hot.example/x")).otherwise(F.col("url")))
    rows = lambda: sorted(map(repr, html.extract(pages.select("page_id", "url", "html")).collect()))
    sent = rows()
    monkeypatch.setattr(html, "SENT_BYTES", -1)
    monkeypatch.setattr(common, "HOT_ROWS", 10)
    assert rows() == sent


def test_widening_needs_the_votes_of_the_host(spark):
    page = lambda extra: f"<html><body><div class=wrap>{extra}<div class=story><p>{'Story text here. ' * 5}</p></div></div></body></html>"
    odd_one = page(f"<div class=strange><p>{'Injected words. ' * 30}</p></div>")
    head = lambda k: page(f"<h1>Head {k}</h1>").replace("story", "text")
    rows = [(k, "http://plain.example/x", page("")) for k in range(20)] + [(99, "http://plain.example/y", odd_one)] + [(100 + k, "http://headed.example/x", head(k)) for k in range(5)]
    got = {r.page_id: r.main_text for r in html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[99] == got[1] == ("Story text here. " * 5).strip() and got[103].startswith("Head 3\n\nStory")


def test_host_consensus_wins(spark):
    page = lambda inner: f"<html><body>{inner}<div class=story><p>{'Story text here. ' * 5}</p></div></body></html>"
    odd_one = page(f"<div class=strange><p>{'Injected words everywhere. ' * 30}</p></div>")
    rows = [(k, "https://u@host.example:8/x", page("")) for k in range(20)] + [(99, "https://host.example/y", odd_one)]
    got = {r.page_id: r.main_text for r in html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[99] == got[1] == ("Story text here. " * 5).strip()


def test_audit_finds_what_differs(spark):
    left = spark.createDataFrame([(k, f"record {k}" * (k % 5 + 1)) for k in range(700)], "k long, p string")
    right = left.where("k <> 300").withColumn("p", F.when(F.col("k").isin(17, 512), "rot").otherwise(F.col("p"))).unionByName(spark.createDataFrame([(9000, "new")], "k long, p string"))
    got = {r.key: (r.status, r.offset) for r in merkle.audit(left, right, "k", "p").collect()}
    at = np.concatenate([[0], np.cumsum([len(f"record {k}" * (k % 5 + 1)) for k in range(700)])])
    assert {k: v[0] for k, v in got.items()} == {17: "corrupt", 512: "corrupt", 300: "missing", 9000: "extra"}
    assert all(got[k][1] == at[k] for k in (17, 300, 512))
    assert merkle.audit(left, left, "k", "p").count() == 0


def test_audit_of_sparse_and_missing_numbers(spark):
    draw = np.random.default_rng(6)
    numbers = [*(int(x) for x in draw.integers(-(1 << 62), 1 << 62, 400)), *range(-20, 300), None, None]
    left = spark.createDataFrame([(k, f"r{j}") for j, k in enumerate(numbers)], "k long, p string")
    bad = [numbers[3], numbers[200], 7, -1]
    right = left.withColumn("p", F.when(F.col("k").isin(bad), "rot").when(F.col("k").isNull() & (F.col("p") == f"r{len(numbers) - 1}"), "rot").otherwise(F.col("p")))
    ordered = sorted((k if k is not None else -(1 << 63), f"r{j}") for j, k in enumerate(numbers))
    at = dict(zip([k for k, _ in ordered], np.cumsum([0] + [len(p) for _, p in ordered[:-1]]), strict=True)) | {-(1 << 63): 0}
    assert len(merkle.shifts(merkle.leaves(left, "k", "p"))) <= 9
    assert {r.key: (r.status, r.offset) for r in merkle.audit(left, right, "k", "p").collect()} == {k: ("corrupt", at[k]) for k in bad} | {None: ("corrupt", 0)}


def test_pieces_rebuild_all_ids(documents, texts):
    inner = UnitTokenizer(tokenizer_path()).inner
    rows = packing.pack(documents.repartition(7), tokenizer_path()).collect()
    by_doc, by_window = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_window.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == set(texts)
    for i, mine in by_doc.items():
        ids, at = np.array([*inner.encode(texts[i], add_special_tokens=False).ids, 1], "<u4"), 0
        for r in sorted(mine, key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    padding = 0
    for mine in by_window.values():
        at = 0
        for r in sorted(mine, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert 0 < at <= 2048
        padding += 0 if at & (at - 1) == 0 else 2048 - at
    assert padding == 0


def test_units_give_the_tokenizers_ids():
    import pyarrow as pa

    draw = np.random.default_rng(9)
    signs = list("ab Zé'sß×÷œİ́  \n\t.,<|endoftext|>123Σ中😀'll \x1c\x00'RE")
    made = ["".join(draw.choice(signs, draw.integers(0, 50))) for _ in range(1500)] + ["", "<|endoftext|> x<|endoftext|>'s"]
    for plain in (False, True):
        coder = UnitTokenizer(tokenizer_path(), plain)
        for first, ids, off in coder.texts(pa.array(made)):
            for k in range(len(off) - 1):
                assert coder.inner.encode(made[first + k], add_special_tokens=False).ids == ids[off[k] : off[k + 1]].tolist()


def test_separator_scan_over_block_borders(spark):
    draw = np.random.default_rng(4)
    files = {f"f{k}": draw.choice([9, 1, 2, 3], n, p=[0.1, 0.3, 0.3, 0.3]) for k, n in enumerate((0, 1, 64, 1000, 5000))}
    files["none"] = np.full(300, 2)
    files["all"] = np.full(70, 9)
    rows = [(f, b, x[b * 16 : b * 16 + 16].astype("<u4").tobytes()) for f, x in files.items() for b in range(-(-len(x) // 16))]
    got = {}
    for r in separators.scan(spark.createDataFrame(rows, separators.BLOCKS).repartition(4), 9).collect():
        got.setdefault(r.file, []).append((r.ordinal, r.start, r.n_tokens, r.terminated))
    for f, x in files.items():
        want, start = [], 0
        for p in np.flatnonzero(x == 9):
            want.append((len(want), start, int(p) - start, True))
            start = int(p) + 1
        if start < len(x):
            want.append((len(want), start, len(x) - start, False))
        assert sorted(got.get(f, [])) == want, f


def test_counts_are_the_tokenizers(spark, documents, texts, sf_dir):
    inner = UnitTokenizer(tokenizer_path(), True).inner
    rows = queries.op1_token_counts(spark, sf_dir).collect()
    assert {r.doc_id: r.n_tokens for r in rows} == {i: len(inner.encode(t or "", add_special_tokens=False).ids) for i, t in texts.items()} and len(rows) == len(texts)
    by_file = {}
    for r in rows:
        by_file.setdefault(r.file, []).append((r.ordinal, r.start, r.n_tokens))
    for mine in by_file.values():
        mine.sort()
        assert [o for o, _, _ in mine] == list(range(len(mine))) and all(a[1] + a[2] + 1 == b[1] for a, b in zip(mine, mine[1:], strict=False))


def test_a_text_with_more_units_than_the_table_holds(monkeypatch):
    from narrative_spark.llm import tokens

    monkeypatch.setattr(tokens, "MAX_UNITS", 100)
    import pyarrow as pa

    coder = UnitTokenizer(tokenizer_path())
    coder.clear(0)
    coder.mask = 63
    coder.keys, coder.slots = np.zeros(64, np.uint64), np.zeros(64, np.int32)
    text = " ".join(f"u{k}x" for k in range(3000))
    for _, ids, _ in coder.texts(pa.array([text, "short one", text])):
        pass
    assert coder.mask + 1 >= 2 * len(coder.first)
    assert coder.inner.encode(text, add_special_tokens=False).ids == [int(x) for x in next(iter(coder.texts(pa.array([text]))))[1]]


def test_one_file_is_read_by_many_ranges(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(separators, "RUN", 2)
    ids = np.random.default_rng(2).choice([9, 1, 2], 5001, p=[0.01, 0.5, 0.49]).astype("<u2")
    (tmp_path / "a.bin").write_bytes(ids.tobytes() + b"x")
    blocks = separators.read_token_files(spark, str(tmp_path), 2, 100)
    assert sorted((r.block, len(r.tokens)) for r in blocks.collect()) == [(k, 200) for k in range(50)] + [(50, 2)]
    assert separators.scan(blocks, 9, 2).agg(F.sum("n_tokens")).first()[0] == (ids != 9).sum()


def test_token_files_are_read_in_blocks(spark, tmp_path):
    ids = np.array([5, 9, 6, 6, 9, 7], "<u2")
    (tmp_path / "a.bin").write_bytes(ids.tobytes())
    got = separators.scan(separators.read_token_files(spark, str(tmp_path), 2, 4), 9, 2).orderBy("ordinal").collect()
    assert [(r.start, r.n_tokens, r.terminated) for r in got] == [(0, 1, True), (2, 2, True), (5, 1, False)]


def test_digest_of_items(documents, spark, sf_dir):
    row = queries.op4_decontamination(spark, sf_dir).where("n_items = 0").first()
    assert row.items_sha256 == hashlib.sha256(b"").hexdigest() and not row.contaminated
