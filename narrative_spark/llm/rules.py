"""Operator 6: quality rules as weak supervision, with SQL functions only.

Each rule votes good, bad or abstains; expectation-maximisation over the corpus' vote patterns estimates how often each is right; a
document is kept where the posterior probability of good quality reaches KEEP, instead of where it passes all
rules. Two hard limits stay in front: too few words, or too much of the text in repeated windows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from narrative_spark.llm import weak
from narrative_spark.llm.common import let, materialize, text_or_empty

KEEP, PRIOR, MIN_WORDS, MAX_REPEAT, REPEAT_WINDOW = 0.5, 0.9, 20, 30, 8
#: Where the fit begins: how often a rule spares a good document, and catches a bad one.
SPARES, CATCHES = 0.97, 0.4
SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
#: A word of signs alone: no letter, digit or sign beyond ASCII.
BARE = r"(?:^|[\x20\x09-\x0D])[\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+(?=[\x20\x09-\x0D]|\z)"
#: Frequent function words of the languages at hand.
STOP_WORDS = ["the", "of", "and", "to", "in", "that", "is", "de", "la", "le", "et", "les", "des", "que", "el", "en", "los", "y", "der", "die", "und", "das", "ein", "mit"]


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE), "")


def n_repeat_words(hashes: Column, width: int = REPEAT_WINDOW) -> Column:
    """Words inside windows of width words that stand twice or more in the text, the first included, from the words' hashes.

    Windows are told apart by 64-bit hashes, made by doubling: of 2, 4 and 8 words.
    """

    def doubled(step: int):
        def pairs(h: Column) -> Column:
            left = F.greatest(F.size(h) - step, F.lit(0))
            return F.zip_with(F.slice(h, 1, left), F.slice(h, step + 1, left), lambda a, b: F.xxhash64(a, b))

        return pairs

    grown, step = hashes, 1
    while step < width:
        grown, step = let(grown, doubled(step)), step * 2

    def covered(h: Column) -> Column:
        ordered = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        twice = let(ordered, lambda o: F.filter(o, lambda s, j: F.coalesce(F.get(o, j - 1)["h"] == s["h"], F.lit(False)) | F.coalesce(F.get(o, j + 1)["h"] == s["h"], F.lit(False))))
        places = F.sort_array(F.transform(twice, lambda s: s["i"]))
        return let(places, lambda p: F.aggregate(F.transform(p, lambda x, j: F.least(F.lit(width), F.coalesce(F.get(p, j + 1) - x, F.lit(width)))), F.lit(0).cast("long"), lambda a, b: a + b))

    none = F.lit(0).cast("long")
    return F.when(F.size(hashes) > width, let(grown, lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), covered(h)).otherwise(none))).otherwise(none)


def measures(docs: DataFrame, text_col: str = "text", prefix: str = "") -> DataFrame:
    """docs with the counts that the rules go by, each under prefix + its name."""
    name = lambda x: prefix + x
    c = lambda x: F.col(name(x))
    text = text_or_empty(text_col)
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    out = docs.withColumn(name("words"), words_of(text)).withColumn(name("hashes"), F.transform(name("words"), lambda w: F.xxhash64(w)))
    out = out.withColumns({
        name("n_words"): F.size(c("words")).cast("long"),
        name("word_chars"): F.length(F.array_join(c("words"), "")).cast("long"),
        name("n_symbols"): F.regexp_count(text, F.lit(SYMBOLS)).cast("long"),
        name("lines"): lines,
        name("n_repeat_words"): n_repeat_words(c("hashes")),
        name("n_distinct"): F.size(F.array_distinct(c("hashes"))).cast("long"),
        name("n_stops"): F.size(F.array_intersect(c("hashes"), F.array(*[F.xxhash64(F.lit(w)) for w in STOP_WORDS]))).cast("long"),
        name("n_capitals"): F.regexp_count(text, F.lit(r"[A-Z]")).cast("long"),
        name("n_bare"): F.regexp_count(text, F.lit(BARE)).cast("long"),
    })
    return out.withColumns({
        name("n_lines"): F.size(c("lines")).cast("long"),
        name("n_dup_lines"): (F.size(c("lines")) - F.size(F.array_distinct(c("lines")))).cast("long"),
    }).drop(name("words"), name("lines"), name("hashes"))


def rules(prefix: str = "") -> dict[str, Column]:
    """Votes: 1 good, 0 bad, null abstains. Every ratio abstains on texts without words."""
    c = lambda x: F.col(prefix + x)
    n = c("n_words")

    def vote(good: Column, bad: Column) -> Column:
        return F.when(n == 0, F.lit(None)).when(bad, 0).when(good, 1).cast("int")

    return {
        "length": vote(n >= 50, n < 20),
        "word_length": vote((c("word_chars") >= 3 * n) & (c("word_chars") <= 9 * n), (2 * c("word_chars") < 5 * n) | (c("word_chars") > 12 * n)),
        "symbols": vote(50 * c("n_symbols") < n, 5 * c("n_symbols") > n),
        "symbol_share": vote(100 * c("n_symbols") < c("word_chars"), 10 * c("n_symbols") > c("word_chars")),
        "bare_words": vote(50 * c("n_bare") < n, 10 * c("n_bare") > n),
        "lines": vote(10 * c("n_dup_lines") < c("n_lines"), 2 * c("n_dup_lines") > c("n_lines")),
        "repeats": vote(20 * c("n_repeat_words") <= n, 4 * c("n_repeat_words") > n),
        "capitals": vote(20 * c("n_capitals") < c("word_chars"), 4 * c("n_capitals") > c("word_chars")),
        "stop_words": vote(c("n_stops") >= 2, (c("n_stops") == 0) & (n >= 30)),
        "variety": vote(F.when(n <= 500, 3 * c("n_distinct") > n).otherwise(c("n_distinct") > 150), F.when(n <= 500, 5 * c("n_distinct") < n).otherwise(c("n_distinct") < 100)),
    }


def base_failed(prefix: str = "") -> Column:
    c = lambda x: F.col(prefix + x)
    return (c("n_words") < MIN_WORDS) | (100 * c("n_repeat_words") > MAX_REPEAT * c("n_words"))


def judge(docs: DataFrame, text_col: str = "text", result: str = "quality_rules", keep: list[str] | None = None) -> DataFrame:
    """docs (the columns in keep, or all) with a struct result: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, good (posterior), kept.

    Null and empty texts have no words: all rules abstain and base_failed rejects them. Very long texts are read whole, in time near their length. Ties at KEEP are kept; repeated rows are judged
    alike, each for itself; an empty table gives an empty result; other columns pass through, and result must be a new name.
    Counts are made once and written to the shared folder, as the fit needs all of them before the first verdict.
    """
    prefix, carried = result + "__", docs.columns if keep is None else keep
    measured = measures(docs, text_col, prefix)
    measured = materialize(measured.select(*carried, *[c for c in measured.columns if c not in docs.columns]), "measures")
    votes = rules(prefix)
    names = list(votes)
    counted = weak.patterns(measured.select(*[v.alias(k) for k, v in votes.items()]), names)
    model = weak.fitted(weak.fit(counted, len(names), PRIOR, SPARES, CATCHES))
    good, failed = weak.probability(list(votes.values()), model), base_failed(prefix)
    shown = [F.col(prefix + x).alias(x) for x in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    return measured.select(*carried, F.struct(*shown, failed.alias("base_failed"), good.alias("good"), (~failed & (good >= KEEP)).alias("kept")).alias(result))
