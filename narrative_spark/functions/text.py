"""Column helpers over text."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Unicode white space, as stripped from both ends of a line.
SPACE = r"[\x{09}-\x{0d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
#: Signs that carry no meaning in a query.
STOP_SIGNS = "的了么吗呢啊吧嘛呀哦嗯唉咦之与及和或但而却并且也又再就都只还很最更被把让从向给在是有这那要会能可以应该怎什为哪谁何哪些这个"

#: Latin letters with marks, and the same without them.
_MARKED = [c for c in map(chr, range(0xC0, 0x250)) if unicodedata.category(c).startswith("L") and not unicodedata.normalize("NFD", c)[0] == c]
_PLAIN = [unicodedata.normalize("NFD", c)[0] for c in _MARKED]
#: For str.translate, as without_marks.
MARKS = str.maketrans(dict(zip(_MARKED, _PLAIN, strict=True)))


def without_marks(text: Column) -> Column:
    """text with Latin letters without their marks."""
    return F.translate(text, "".join(_MARKED), "".join(_PLAIN))


def ustrip(text: Column) -> Column:
    """text without white space at both ends; most texts have none, which a look at their ends tells."""
    ends = F.concat(F.left(text, F.lit(1)), F.right(text, F.lit(1))).rlike(SPACE)
    return F.when(ends, F.regexp_replace(text, f"^{SPACE}++|{SPACE}++$", "")).otherwise(text)


def count_of(text: Column, part: Column) -> Column:
    """Non-overlapping occurrences of part; 0 for an empty part."""
    return F.when(F.length(part) > 0, ((F.length(text) - F.length(F.replace(text, part, F.lit("")))) / F.length(part)).cast("long")).otherwise(F.lit(0).cast("long"))


def signs(text: Column) -> Column:
    """Letters and digits of text, in order."""
    return F.regexp_extract_all(text, F.lit(r"[\p{L}\p{N}]"), F.lit(0))


def content_signs(text: Column) -> Column:
    """Signs without stop signs; all of them where fewer than two would stay."""
    every = signs(text)
    kept = F.filter(every, lambda c: ~F.lit(STOP_SIGNS).contains(c))
    return F.when(F.size(kept) >= 2, kept).otherwise(every)


def pairs(items: Column) -> Column:
    """Distinct pairs of neighbours, in order of their first place."""
    left = F.slice(items, 1, F.greatest(F.size(items) - 1, F.lit(0)))
    right = F.slice(items, 2, F.greatest(F.size(items) - 1, F.lit(0)))
    return F.array_distinct(F.zip_with(left, right, lambda a, b: F.concat(a, b)))


def counted(items: Column) -> Column:
    """Distinct items, sorted, each with how often it comes: array of term, tf."""

    def runs(s: Column) -> Column:
        ends = F.filter(F.transform(s, lambda x, i: F.struct(x.alias("term"), (i + 1).alias("end"))), lambda e: ~F.coalesce(F.get(s, e["end"]) == e["term"], F.lit(False)))
        tf = lambda e: F.transform(e, lambda x, i: F.struct(x["term"].alias("term"), (x["end"] - F.coalesce(F.get(e, i - 1)["end"], F.lit(0))).cast("long").alias("tf")))
        return F.flatten(F.transform(F.array(ends), tf))

    return F.flatten(F.transform(F.array(F.sort_array(items)), runs))
