"""Column helpers over JSON values of any kind (VARIANT), so that a text is never taken for what it looks like."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parsed(text: Column) -> Column:
    """The object between the first { and the last } of model text, code fences off; null where there is none."""
    body = F.regexp_extract(F.regexp_replace(F.coalesce(text, F.lit("")), r"```(?:json)?", ""), r"(?s)\{.*\}", 0)
    return F.try_parse_json(F.nullif(body, F.lit("")))


def kind(value: Column) -> Column:
    """OBJECT, ARRAY, STRING, BOOLEAN, VOID, or a kind of number; VOID for what isn't there."""
    return F.coalesce(F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0), F.lit("VOID"))


def part(value: Column, key: str) -> Column:
    """The value of a key; null unless value is an object that has it."""
    return F.try_variant_get(value, f"$.{key}", "variant")


def items(value: Column) -> Column:
    """The values of an array; empty for all else."""
    return F.coalesce(F.try_variant_get(value, "$", "array<variant>"), F.array().cast("array<variant>"))


def text(value: Column) -> Column:
    """value as text, true and false with a capital; null for null."""
    plain = F.try_variant_get(value, "$", "string")
    return F.when(kind(value) == "BOOLEAN", F.initcap(plain)).when(kind(value) != "VOID", plain)


def is_empty(value: Column) -> Column:
    """Whether value counts as nothing: missing, null, false, 0, or an empty text or collection."""
    plain, what = F.try_variant_get(value, "$", "string"), kind(value)
    number = F.coalesce(F.try_variant_get(value, "$", "double") == 0, F.lit(False))
    return (what == "VOID") | ((what == "BOOLEAN") & (plain == "false")) | plain.isin("", "[]", "{}") | (~what.isin("STRING", "BOOLEAN", "VOID", "OBJECT", "ARRAY") & number)


def solid(value: Column) -> Column:
    """value as text; null where it counts as nothing."""
    return F.when(~is_empty(value), text(value))
