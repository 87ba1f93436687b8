"""Operator 9: personal data by aggregated weak labels, with SQL functions only.

Patterns propose spans. Labelers (form, gazetteer, checksum, context, variety) vote on each: personal, not, or abstain;
expectation-maximisation over the vote patterns of the corpus estimates how reliable each is. The posteriors are soft labels, from
which a naive Bayes classifier over the span's own features is trained; it decides on all spans beyond the base
kinds. Base spans (email, ip, card, phone) always stay.
"""

from __future__ import annotations

from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from narrative_spark.llm import spans, weak
from narrative_spark.llm.common import materialize, text_or_empty, unused

BASE = ("email", "ip", "card", "phone")
MORE = ("local_phone", "ssn", "iban", "number")
KINDS = (*BASE, *MORE)
KEEP, PRIOR, YES, NO = 0.5, 0.7, 0.8, 0.7
#: Forms that the base kinds are found by. Possessive runs and the look-behinds change no match: they only spare second tries inside a run, and a stack that grows with it.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?[0-9]){12,}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
LOCAL_PHONE = r"(?<![0-9A-Za-z+.-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[.-][0-9]{4}(?![0-9A-Za-z.-])"
SSN = r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
_PART = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})"
#: Gazetteers and context words.
DOMAINS = ["com", "org", "net", "edu", "gov", "io", "co", "de", "fr", "es", "it", "uk", "us", "eu", "ch", "at", "nl", "be", "pl", "pt", "se", "no", "dk", "fi", "ca", "au", "jp", "cn", "in", "br", "mx", "ru", "info", "biz", "me", "app", "dev"]
CALLING_CODES = "1|7|20|27|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|21[1-8]|35[0-9]|37[0-9]|38[0-9]|42[0-9]|97[0-9]"
IBAN_COUNTRIES = "DE|FR|ES|IT|NL|BE|AT|CH|PT|PL|GB|IE|LU|DK|SE|NO|FI|CZ|SK|HU|GR|RO|BG|HR|SI|EE|LV|LT|TR"
FOR_WORDS = r"(?i)(?:e-?mail|contact|write to|reach|call|phone|tel|mobile|fax|whatsapp|card|visa|mastercard|amex|address|host|server|login from|ssn|social security|iban|account|konto|correo|courriel|kontakt)[^.\n]{0,20}$"
AGAINST_WORDS = r"(?i)(?:version|release|build|isbn|order|invoice|sku|sha|hash|commit|id|no\.|nr\.|ref)[\x20:#=]{0,3}$"


def _found(text: Column) -> dict[str, Column]:
    """Spans of each pattern, with what stands before them."""
    digit = text.rlike("[0-9]")
    where = {
        "email": (EMAIL, text.contains("@")),
        "ip": (IP, digit & text.contains(".")),
        "chain": (CARD, digit),
        "phone": (PHONE, text.contains("+")),
        "local_phone": (LOCAL_PHONE, digit),
        "ssn": (SSN, digit & text.contains("-")),
        "iban": (IBAN, digit & text.rlike("[A-Z]{2}[0-9]{2}")),
    }
    return {name: spans.matches(text, pattern, only_if, before=True) for name, (pattern, only_if) in where.items()}


def _candidates(found: dict[str, Column]) -> dict[str, Column]:
    """Spans of each kind."""
    luhn = lambda s: F.call_function("luhn_check", F.regexp_replace(s["text"], r"[\x20-]", ""))
    digits = lambda s: F.length(F.regexp_replace(s["text"], "[^0-9]", ""))
    return {
        "email": found["email"],
        "ip": F.filter(found["ip"], lambda s: s["text"].rlike(rf"^{_PART}(?:\.{_PART}){{3}}$")),
        "card": F.filter(found["chain"], lambda s: digits(s).between(13, 19) & luhn(s)),
        "phone": F.filter(found["phone"], lambda s: digits(s).between(9, 15)),
        "local_phone": found["local_phone"],
        "ssn": found["ssn"],
        "iban": found["iban"],
        "number": F.filter(found["chain"], lambda s: digits(s).between(13, 19) & ~luhn(s)),
    }


def _votes(kind: str, s: Column, before: Column) -> list[Column]:
    """form, gazetteer, checksum, context and variety: 1 personal, 0 not, null abstains."""
    x = s["text"]
    digits = F.regexp_replace(x, "[^0-9]", "")
    none = F.lit(None).cast("int")
    yes_no = lambda c: F.when(c, 1).otherwise(0)
    form, names, sums = none, none, none
    if kind == "email":
        form = yes_no(x.rlike(r"^[A-Za-z0-9][A-Za-z0-9._%+-]*+@[A-Za-z0-9.-]*\.[A-Za-z]{2,}$") & ~F.substring_index(x, "@", 1).contains(".."))
        names = F.when(F.lower(F.substring_index(x, ".", -1)).isin(DOMAINS), 1)
    elif kind == "ip":
        form = yes_no(~x.rlike(r"(?:^|\.)0[0-9]"))
        names = F.when(x.rlike(r"^(?:0|10|127|22[4-9]|23[0-9]|24[0-9]|25[0-5]|192\.168|169\.254)\."), 0).otherwise(1)
    elif kind in ("card", "number"):
        form = yes_no(x.rlike(r"^(?:[0-9]{13,19}|[0-9]{4}([\x20-])[0-9]{4}\1[0-9]{4}\1[0-9]{4}|[0-9]{4}([\x20-])[0-9]{6}\2[0-9]{5})$"))
        names = yes_no(digits.rlike("^(?:4|5[1-5]|2[2-7]|3[47]|6(?:011|5))"))
        sums = F.lit(1 if kind == "card" else 0)
    elif kind == "phone":
        form = yes_no(F.length(digits).between(10, 15))
        names = yes_no(digits.rlike(f"^(?:{CALLING_CODES})"))
    elif kind == "local_phone":
        form, names = F.lit(1), yes_no(digits.rlike("^[2-9][0-9]{2}[2-9]"))
    elif kind == "ssn":
        form, names = F.lit(1), yes_no(~digits.rlike("^(?:000|666|9)|^.{3}00|0000$"))
    elif kind == "iban":
        form, names = yes_no(F.length(F.regexp_replace(x, " ", "")).between(15, 34)), yes_no(x.rlike(f"^(?:{IBAN_COUNTRIES})"))
    context = F.when(before.rlike(AGAINST_WORDS), 0).when(before.rlike(FOR_WORDS), 1)
    variety = yes_no(F.size(F.array_distinct(F.split(digits, ""))) >= 4) if kind != "email" else none
    return [v.cast("int") for v in (form, names, sums, context, variety)]


VOTERS = 5


#: Places of a kind's features in the table of weights: the kind itself, three values of each vote, lengths by four code points (the last stands for all longer ones), the sign before.
LENGTHS, SIGNS = 24, 4
WIDTH = 1 + 3 * VOTERS + LENGTHS + SIGNS


def _features(kind: str, s: Column, votes: Column) -> Column:
    """Numbers of what the classifier goes by, each kind's apart."""
    first, before = KINDS.index(kind) * WIDTH, s["before"]
    voted = F.transform(votes, lambda v, j: F.lit(first + 1) + 3 * j + F.coalesce(v + 1, F.lit(0)))
    size = first + 1 + 3 * VOTERS + F.least(F.floor(F.length(s["text"]) / 4).cast("int"), F.lit(LENGTHS - 1))
    sign = first + 1 + 3 * VOTERS + LENGTHS + F.when(F.length(before) == 0, 0).when(before.rlike(r"[\x20\n]$"), 1).when(before.rlike("[:=(<\"']$"), 2).otherwise(3)
    return F.concat(F.array(F.lit(first)), voted, F.array(size, sign))


def propose(docs: DataFrame, text_col: str, out: str) -> DataFrame:
    """docs with base (spans of the base kinds) and more (candidates outside them) in a struct out."""
    held, named = unused([*docs.columns, out], "pii__found"), unused([*docs.columns, out], "pii__kinds")
    made = docs.withColumn(held, F.struct(*[c.alias(k) for k, c in _found(text_or_empty(text_col)).items()]))

    def rows(kind: str, spans_: Column) -> Column:
        def row(s: Column) -> Column:
            votes = F.array(*_votes(kind, s, s["before"]))
            return F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), votes.alias("votes"), _features(kind, s, votes).alias("features"))

        return F.transform(spans_, row)

    kinds = _candidates({k: F.col(held)[k] for k in ("email", "ip", "chain", "phone", "local_phone", "ssn", "iban")})
    made = made.withColumn(named, F.struct(*[rows(kind, kinds[kind]).alias(kind) for kind in KINDS]))
    base, more = (F.concat(*[F.col(named)[kind] for kind in some]) for some in (BASE, MORE))
    return made.select(*docs.columns, F.struct(base.alias("base"), spans.outside(more, base).alias("more")).alias(out))


def train(proposed: DataFrame, out: str) -> tuple[float, list[float]]:
    """(prior log-odds, log-odds of each feature), learned from the labelers' posteriors. There are WIDTH features of each kind, whatever the corpus."""
    each = proposed.select(F.explode(F.concat(F.col(out)["base"], F.col(out)["more"])).alias("s"))
    counted = each.groupBy(F.col("s.votes").alias("votes")).agg(F.count(F.lit(1)).alias("n"))
    model = weak.fitted(weak.fit(counted, VOTERS, PRIOR, YES, NO))
    p = weak.probability([F.col("s.votes")[j] for j in range(VOTERS)], model)
    sums = each.select(p.alias("p"), F.explode(F.concat(F.array(F.lit(-1)), F.col("s.features"))).alias("feature")).groupBy("feature").agg(F.sum("p").alias("yes"), F.count(F.lit(1)).alias("n")).collect()
    seen = {r.feature: (r.yes, r.n) for r in sums}
    yes, n = seen.pop(-1, (0.0, 0))
    no, yes = n - yes + 1, yes + 1
    odds = [0.0] * (WIDTH * len(KINDS))
    for feature, (y, n) in seen.items():
        odds[feature] = round(log(((y + 0.5) / yes) / ((n - y + 0.5) / no)), 6)
    return round(log(yes / no), 6), odds


def find(docs: DataFrame, text_col: str = "text", result: str = "pii", keep: list[str] | None = None) -> DataFrame:
    """docs (the columns in keep, or all) with a struct result: base and all, arrays of kind, start, end by kind, then start.

    Null and empty texts have no spans; very long texts, words and lists of spans are read whole, in time near their length; ties (a
    span proposed twice, probability just at KEEP) keep the base kind and count as personal; repeated rows are handled each for
    itself; an empty table gives an empty result; other columns pass through whatever their names, but result must be a new one.
    """
    carried = docs.columns if keep is None else keep
    proposed = materialize(propose(docs, text_col, result).select(*carried, result), "pii")
    prior, odds = train(proposed, result)
    table = F.array(*[F.lit(x) for x in odds])
    base, more = F.col(result)["base"], F.col(result)["more"]
    score = lambda s: F.aggregate(s["features"], F.lit(prior), lambda t, f: t + F.get(table, f))
    plain = lambda a: F.transform(a, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    added = F.filter(more, lambda s: score(s) >= log(KEEP / (1 - KEEP)))
    return proposed.select(*carried, F.struct(plain(base).alias("base"), F.concat(plain(base), plain(added)).alias("all")).alias(result))


def counts(result: str = "pii") -> dict[str, Column]:
    base = F.col(result)["base"]
    return {f"n_{kind}": _count(base, kind) for kind in BASE}


def _count(base: Column, kind: str) -> Column:
    return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long")


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs with every span of personal data replaced by its kind in brackets; texts without any, and null ones, are as they were. Else as find."""
    found_col = unused(docs.columns, "pii__redact")
    found = find(docs, text_col, found_col)
    text = spans.replaced(F.col(text_col), F.col(found_col)["all"])
    return found.select(*[text.alias(c) if c == text_col else found[c] for c in docs.columns])
