"""Places of regular-expression matches and pieces of texts, with SQL functions only.

Everything here takes time in proportion to a text's length and to n log n of its n spans: positions come from running sums made by
doubling, and pieces are cut from blocks of a text, never by walking through it anew for each span. Patterns must not
recurse for each character: loops whose body varies in length are possessive.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from narrative_spark.llm.common import let

#: Code points of a block that pieces are cut from.
BLOCK = 1024
#: Code points that context reaches back, and matches that so many code points can hold at most, each being five or more long.
CONTEXT, REACH = 32, 7


def running(values: Column, add: Callable[[Column, Column], Column]) -> Column:
    """For each place the fold of all values up to it; add must be associative. Reach doubles with each step."""
    steps = F.when(F.size(values) > 1, F.sequence(F.lit(0), F.ceil(F.log2(F.size(values))).cast("int") - 1)).otherwise(F.array().cast("array<int>"))
    far = lambda k: F.call_function("shiftleft", F.lit(1), k)
    widen = lambda now, k: F.transform(now, lambda x, i: F.when(i >= far(k), add(F.get(now, i - far(k)), x)).otherwise(x))
    return F.aggregate(steps, values, widen)


def matches(text: Column, pattern: str, only_if: Column, before: bool = False) -> Column:
    """start, end (code points, end exclusive) and text of the leftmost non-overlapping matches, where only_if holds; before: also the last CONTEXT code points in front of each.

    The gaps between matches and the matches themselves come from one pattern; running sums of their lengths give the places. The
    pattern must not match the empty string; with before, no match may be shorter than five code points.
    """
    both = F.struct(F.split(text, pattern, -1).alias("gaps"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"))
    tail = lambda x: F.right(x, F.lit(CONTEXT))

    def placed(gaps: Column, found: Column) -> Column:
        sums = running(F.transform(found, lambda m, i: (F.length(F.get(gaps, i)) + F.length(m)).cast("long")), lambda a, b: a + b)
        tails = F.transform(gaps, tail) if before else F.array().cast("array<string>")

        def context(tails: Column, i: Column) -> Column:
            part = lambda k: F.concat(F.get(tails, k), F.when(k < i, tail(F.get(found, k))).otherwise(""))
            return tail(F.array_join(F.transform(F.sequence(F.greatest(i - REACH, F.lit(0)), i), part), ""))

        def one(x: Column, m: Column, i: Column) -> Column:
            end = F.get(x["sums"], i)
            more = [context(x["tails"], i).alias("before")] if before else []
            return F.struct((end - F.length(m)).alias("start"), end.alias("end"), m.alias("text"), *more)

        return let(F.struct(sums.alias("sums"), tails.alias("tails")), lambda x: F.transform(found, lambda m, i: one(x, m, i)))

    none = F.array().cast(f"array<struct<start:bigint,end:bigint,text:string{',before:string' if before else ''}>>")
    return F.when(only_if, let(both, lambda x: F.when(F.size(x["found"]) > 0, placed(x["gaps"], x["found"])).otherwise(none))).otherwise(none)


def outside(spans: Column, others: Column) -> Column:
    """The spans that overlap none of the others, in their order.

    A span overlaps another if, of those that start before its end, the one that ends last ends behind its start: one sort and a running maximum.
    """
    marks = F.concat(
        F.transform(others, lambda o: F.struct(o["start"].alias("at"), F.lit(1).alias("other"), o["end"].alias("end"), F.lit(-1).alias("i"))),
        F.transform(spans, lambda s, i: F.struct(s["end"].alias("at"), F.lit(0).alias("other"), F.lit(-1).cast("long").alias("end"), i.alias("i"))),
    )

    def kept(order: Column) -> Column:
        furthest = running(F.transform(order, lambda m: m["end"]), F.greatest)
        pairs = F.zip_with(order, furthest, lambda m, end: F.struct(m["i"].alias("i"), end.alias("end")))
        mine = F.sort_array(F.filter(pairs, lambda p: p["i"] >= 0))
        return let(mine, lambda own: F.filter(spans, lambda s, i: F.get(own, i)["end"] <= s["start"]))

    return F.when((F.size(spans) == 0) | (F.size(others) == 0), spans).otherwise(let(F.sort_array(marks), kept))


def listed(spans: Column) -> Column:
    """kind:start:end, comma-joined in the given order."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def pieces(text: Column, ranges: Column) -> Column:
    """The substrings at ranges (start, end in code points, end exclusive), put together from blocks of the text."""
    blocks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}+"), F.lit(0))

    def cut(all_: Column, r: Column) -> Column:
        block = lambda at: F.floor(at / BLOCK).cast("int")
        inside = lambda at: (at % BLOCK).cast("int")
        a, b, last = block(r["start"]), block(r["end"]), inside(r["end"])
        head = F.when(a == b, F.substring(F.get(all_, a), inside(r["start"]) + 1, last - inside(r["start"]))).otherwise(F.substring(F.get(all_, a), inside(r["start"]) + 1, F.lit(BLOCK)))
        rest = F.when(a < b, F.concat(F.array_join(F.slice(all_, a + 2, F.greatest(b - a - 1, F.lit(0))), ""), F.when(last > 0, F.substring(F.get(all_, b), F.lit(1), last)).otherwise(""))).otherwise("")
        return F.when(r["start"] < r["end"], F.concat(head, rest)).otherwise("")

    return let(blocks, lambda all_: F.transform(ranges, lambda r: cut(all_, r)))


def replaced(text: Column, spans: Column) -> Column:
    """text with each stretch covered by spans replaced by its first kind in brackets; text itself where there is no span."""
    ordered = F.sort_array(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))

    def made(order: Column) -> Column:
        furthest = running(F.transform(order, lambda s: s["end"]), F.greatest)
        # before: where the stretches so far end. A span that starts there or later begins a stretch of its own.
        with_before = let(furthest, lambda f: F.transform(order, lambda s, i: F.struct(F.coalesce(F.get(f, i - 1), F.lit(0).cast("long")).alias("before"), s["start"].alias("start"), s["kind"].alias("kind"))))
        fresh = F.filter(with_before, lambda s: s["start"] >= s["before"])
        end = F.array_max(F.transform(order, lambda s: s["end"]))
        ranges = lambda f: F.concat(F.transform(f, lambda s: F.struct(s["before"].alias("start"), s["start"].alias("end"))), F.array(F.struct(end.alias("start"), F.length(text).cast("long").alias("end"))))
        join = lambda f: let(pieces(text, ranges(f)), lambda p: F.array_join(F.transform(p, lambda x, i: F.concat(x, F.coalesce(F.concat(F.lit("["), F.upper(F.get(f, i)["kind"]), F.lit("]")), F.lit("")))), ""))
        return let(fresh, join)

    return F.when(F.size(spans) > 0, let(ordered, made)).otherwise(text)
