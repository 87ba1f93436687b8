"""Whole results of queries that SQL can't express, against plain Python."""

import hashlib
import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa

from narrative_spark.llm import bytetext, pii, quality, queries, secrets
from tests.llm.test_operators import base_pii, base_secrets

SF = "/root/testdata/sf0.01"


def rows_of(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet").collect()


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


def find(pattern, text):
    """Leftmost matches by Python; possessive and look-behind parts mean the same there."""
    return list(re.compile(pattern.replace(r"\G", "(?!)"), re.A).finditer(text or ""))


def test_secrets_of_a_whole_table(spark):
    """Base spans, further spans and ownership, counted in dictionaries."""
    docs = rows_of(spark, "documents")
    more = (("prefixed", secrets.PREFIXED), ("jwt", secrets.JWT), ("pem", secrets.PEM), ("opaque", secrets.OPAQUE))
    found, owners, repos = {}, {}, {}
    for r in docs:
        mine = []
        for s in base_secrets(r.text):
            kind, a, b = s.split(":")
            text = r.text[int(a) : int(b)]
            mine.append((int(a), int(b), kind, re.search(secrets.ASSIGN[4:], text, re.I | re.A)[1] if kind == "assign" else text))
        for kind, pattern in more:
            for m in find(pattern, r.text):
                ok = kind != "opaque" or (re.search("[0-9].*[0-9]", m[0]) and re.search("[a-z]", m[0]) and re.search("[A-Z]", m[0]))
                if ok and not any(m.start() < b and a < m.end() for a, b, k, _ in mine if k in secrets.BASE):
                    mine.append((m.start(), m.end(), kind, m[0]))
        found[r.doc_id] = mine
        for *_, value in mine:
            owners.setdefault(value, set()).add(r.source)
            repos.setdefault(value, set()).add(r.doc_id)
    order = [*secrets.BASE, *secrets.MORE]

    def live(value):
        return len(owners[value]) <= secrets.MAX_OWNERS and len(repos[value]) <= secrets.MAX_REPOS and not re.search(secrets.PLACEHOLDER[4:], value, re.I) and len(set(value)) >= 8

    for r in queries.op2_secret_scan(spark, SF).collect():
        kept = sorted((a, order.index(k), b, v) for a, b, k, v in found[r.doc_id] if k in secrets.BASE or live(v))
        text = lambda some: ",".join(f"{order[k]}:{a}:{b}" for a, k, b, _ in some)
        assert r.spans == text(kept) and r.n_live == sum(live(v) for *_, v in kept)
        assert r.base_sha256 == sha(text([x for x in kept if x[1] < 3])) and [r.n_assign, r.n_access, r.n_hex] == [sum(x[1] == k for x in kept) for k in range(3)]


def votes_of(kind, x, before):
    """The labelers' votes in plain Python."""
    digits = re.sub("[^0-9]", "", x)
    form = names = sums = None
    if kind == "email":
        local, domain = x.split("@", 1)
        form = int(x[0].isalnum() and ".." not in local and bool(re.search(r"\.[A-Za-z]{2,}$", domain)))
        names = 1 if x.rsplit(".", 1)[1].lower() in pii.DOMAINS else None
    elif kind == "ip":
        parts = x.split(".")
        form = int(not any(p[0] == "0" and len(p) > 1 for p in parts))
        names = int(not re.match(r"(?:0|10|127|22[4-9]|23[0-9]|24[0-9]|25[0-5]|192\.168|169\.254)\.", x))
    elif kind in ("card", "number"):
        form = int(bool(re.fullmatch(r"[0-9]{13,19}|[0-9]{4}([\x20-])[0-9]{4}\1[0-9]{4}\1[0-9]{4}|[0-9]{4}([\x20-])[0-9]{6}\2[0-9]{5}", x)))
        names, sums = int(bool(re.match("4|5[1-5]|2[2-7]|3[47]|6(?:011|5)", digits))), int(kind == "card")
    elif kind == "phone":
        form, names = int(10 <= len(digits) <= 15), int(bool(re.match(pii.CALLING_CODES, digits)))
    elif kind == "local_phone":
        form, names = 1, int(bool(re.match("[2-9][0-9]{2}[2-9]", digits)))
    elif kind == "ssn":
        form, names = 1, int(not re.search("^(?:000|666|9)|^.{3}00|0000$", digits))
    else:
        form, names = int(15 <= len(x.replace(" ", "")) <= 34), int(bool(re.match(f"(?:{pii.IBAN_COUNTRIES})", x)))
    context = 0 if re.search(pii.AGAINST_WORDS, before) else 1 if re.search(pii.FOR_WORDS, before) else None
    return form, names, sums, context, None if kind == "email" else int(len(set(digits)) >= 4)


def em(patterns, prior, yes, no, rounds=30, weight=10.0):
    """Expectation-maximisation over counted votes."""
    n = len(next(iter(patterns), ()))
    accuracies, share = [[yes, no] for _ in range(n)], prior
    for _ in range(rounds):
        p = {v: posterior(v, accuracies, share) for v in patterns}
        fresh = []
        for j in range(n):
            right = [sum(c * (p[v] if side == 1 else 1 - p[v]) for v, c in patterns.items() if v[j] == side) for side in (1, 0)]
            voted = [sum(c * (p[v] if side == 1 else 1 - p[v]) for v, c in patterns.items() if v[j] is not None) for side in (1, 0)]
            a, b = (max(0.02, min(0.998, (r + weight * s) / (k + weight))) for r, k, s in zip(right, voted, (yes, no), strict=True))
            fresh.append([a, max(b, 1.02 - a)])
        share = max(0.01, min(0.99, (sum(c * p[v] for v, c in patterns.items()) + weight * prior) / (sum(patterns.values()) + weight)))
        accuracies = fresh
    return accuracies, share


def posterior(votes, accuracies, share):
    odds = math.log(share / (1 - share))
    for v, (a, b) in zip(votes, accuracies, strict=True):
        odds += 0 if v is None else math.log(a / (1 - b)) if v else math.log((1 - a) / b)
    return 1 / (1 + math.exp(-odds))


def test_personal_data_of_a_whole_table(spark):
    """Candidates, labelers, their reliabilities, the classifier and its verdicts, all in plain Python."""
    docs, found = rows_of(spark, "documents"), {}
    luhn = lambda d: sum(int(x) if i % 2 == 0 else 2 * int(x) - 9 * (int(x) > 4) for i, x in enumerate(d[::-1])) % 10 == 0
    for r in docs:
        base = [(k, int(a), int(b)) for k, a, b in (s.split(":") for s in base_pii(r.text))]
        more = [("local_phone", m) for m in find(pii.LOCAL_PHONE, r.text)] + [("ssn", m) for m in find(pii.SSN, r.text)] + [("iban", m) for m in find(pii.IBAN, r.text)]
        more += [("number", m) for m in find(pii.CARD, r.text) if 13 <= len(d := re.sub("[^0-9]", "", m[0])) <= 19 and not luhn(d)]
        free = [(k, *m.span()) for k, m in more if not any(m.start() < b and a < m.end() for _, a, b in base)]
        found[r.doc_id] = [(k, a, b, votes_of(k, r.text[a:b], r.text[max(0, a - 32) : a]), r.text[max(0, a - 32) : a], b - a) for k, a, b in base + free]
    every = [s for mine in found.values() for s in mine]
    accuracies, share = em(Counter(s[3] for s in every), pii.PRIOR, pii.YES, pii.NO)

    def features(s):
        kind, _, _, votes, before, size = s
        sign = "start" if not before else "space" if before[-1] in " \n" else "mark" if before[-1] in ":=(<\"'" else "other"
        return [(kind,), (kind, "size", min(size // 4, pii.LENGTHS - 1)), (kind, "sign", sign)] + [(kind, j, v) for j, v in enumerate(votes)]

    yes, seen, personal = 0.0, Counter(), Counter()
    for s in every:
        p = posterior(s[3], accuracies, share)
        yes += p
        for f in features(s):
            seen[f] += 1
            personal[f] += p
    yes, no = yes + 1, len(every) - yes + 1
    odds = {f: math.log(((personal[f] + 0.5) / yes) / ((seen[f] - personal[f] + 0.5) / no)) for f in seen}
    for r in queries.op9_pii(spark, SF).collect():
        kept = [s for s in found[r.doc_id] if s[0] in pii.BASE or math.log(yes / no) + sum(odds[f] for f in features(s)) >= 0]
        text = lambda some: ",".join(f"{s[0]}:{s[1]}:{s[2]}" for s in some)
        assert r.spans == text(kept), r.doc_id
        assert r.base_sha256 == sha(text([s for s in kept if s[0] in pii.BASE])) and [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in kept) for k in pii.BASE]


def plain_features(text):
    """Counts of a text's features, word by word."""
    mask = 2**64 - 1

    def mix(h):
        h ^= h >> 31
        h = h * 0xBF58476D1CE4E5B9 & mask
        return h ^ (h >> 29)

    code = [int(c) for c in bytetext._CODES]
    hashed = lambda raw: mix(sum(code[b] * pow(bytetext._P, i, 2**64) for i, b in enumerate(raw)) & mask)
    words = [w for w in re.split(rb"[\x20\x09-\x0D]+", (text or "").encode()) if w]
    found = [hashed(w) for w in words]
    pairs = [int(quality._SAME) if a == b else mix((a * 0x9E3779B97F4A7C15 + b) & mask) for a, b in zip(found, found[1:], strict=False)]
    grams = [(hashed(w[i : i + n].encode()) + n) & mask for n in quality.NGRAMS for w in (x.decode() for x in words) for i in range(len(w) - n + 1)]
    return Counter(h % quality.BUCKETS for h in found + pairs + grams)


def test_scores_of_a_whole_table(spark):
    """Scores are the softmax of the averaged vectors, whole texts counted word by word; held-out rows never reach the training."""
    sf = "/root/testdata/sf0.001"
    docs, labels = (spark.read.parquet(f"{sf}/{n}.parquet") for n in ("documents", "labels"))
    weights, bias = quality.train(*quality.sample(docs, labels, "quality"))
    got = {r.doc_id: r for r in queries.op5_quality_score(spark, sf).collect()}
    for r in docs.collect():
        counts = plain_features(r.text)
        odds = sum(n * float(weights[k]) for k, n in counts.items()) / max(1, sum(counts.values())) + bias
        assert abs(got[r.doc_id].score - 1 / (1 + math.exp(-odds))) < 1e-4 and got[r.doc_id].predicted == (got[r.doc_id].score >= 0.5)
    turned = labels.withColumn("quality", quality.F.when(quality.held_out(), 1 - quality.F.col("quality")).otherwise(quality.F.col("quality")))
    assert {r.doc_id: r.score for r in quality.score(docs, turned).collect()} == {i: r.score for i, r in got.items()}


def test_sample_takes_whole_texts_within_its_bounds(spark):
    docs = spark.createDataFrame([(k, "x" * (10 * k)) for k in range(200)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(200)], "doc_id long, quality int")
    for rows, most in ((50, 1 << 20), (200, 5000), (200, 5)):
        texts, marks = quality.sample(docs, labels, "quality", rows=rows, most=most)
        assert len(texts) == len(marks) <= rows and sum(len(t) for t in texts.to_pylist()) <= most
        assert all(len(t) % 10 == 0 for t in texts.to_pylist())


def test_training_follows_the_gradient_of_its_loss(monkeypatch):
    """One step from the start moves each number against the sign of the loss's numerical gradient."""
    monkeypatch.setattr(quality, "EPOCHS", 1)
    monkeypatch.setattr(quality, "RATE", 1e-4)
    texts, labels = pa.array(["good words here", "bad bad 12"]), np.array([1, 0])
    weights, bias = quality.train(texts, labels, seed=3)
    monkeypatch.setattr(quality, "RATE", 0.0)
    start, _ = quality.train(texts, labels, seed=3)
    # Outputs begin at zero: vectors don't move before the outputs do, and the bias follows the labels.
    assert np.abs(weights).max() > 0 and np.abs(start).max() == 0 and abs(bias) <= 4e-4
    rate = lambda t: sum(weights[k] * n for k, n in plain_features(t).items())
    assert rate("good words here") > rate("bad bad 12")
