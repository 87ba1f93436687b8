"""Deltas of units: fall-back extraction, coercion of model output, review patches, context and the result cache."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType, StructField, StructType

from narrative_spark.functions import prefix
from narrative_spark.functions import variants as V
from narrative_spark.functions.text import content_signs, ustrip

#: Units of a work that one task compares with as many others.
BLOCK = 1024
SEPARATORS = ("。", "！", "？", "；", "\n")
HEAD = 60
#: Most items and longest strings of coerced fields.
MOST = {"entity_updates": 30, "plotline_updates": 20, "context_refs": 30}
SUMMARY, NAME, TITLE, STATUS, EVENT = 300, 40, 60, 80, 120
ENTITY = "struct<name:string,type:string,status:string,note:string,aliases:array<string>,kind:string>"
PLOTLINE = "struct<action:string,title:string,note:string>"


def first_sentence(text: Column, separators: tuple[str, ...] = SEPARATORS) -> Column:
    """Text before the first separator, the whole text where it has none; only where nothing stands before it, the next separator is tried. Cut to HEAD signs."""
    whole = F.coalesce(text, F.lit(""))
    stripped = ustrip(whole)
    head = F.coalesce(*[F.nullif(F.substring_index(stripped, s, 1), F.lit("")) for s in separators], F.substring(whole, 1, HEAD))
    return F.when(F.length(head) > HEAD, F.concat(F.substring(head, 1, HEAD), F.lit("……"))).otherwise(head)


def _fallback(separators: tuple[str, ...]) -> dict[str, Column]:
    head = first_sentence(F.col("text"), separators)
    empty = lambda kind: F.array().cast(f"array<{kind}>")
    return {"summary": head, "entity_updates": empty(ENTITY), "plotline_updates": empty(PLOTLINE), "context_refs": empty("string"), "recent_event": F.when(head != "", F.struct(head.alias("text")))}


def fallback_extract(units: DataFrame, separators: tuple[str, ...] = SEPARATORS) -> DataFrame:
    """units with summary, empty updates and a recent event, all from the first sentence."""
    return units.withColumns(_fallback(separators))


def _cut(value: Column, size: int) -> Column:
    return F.substring(ustrip(F.coalesce(value, F.lit(""))), 1, size)


def coerce_fields(outputs: DataFrame, col: str = "output") -> DataFrame:
    """outputs with parse_error, summary, entity_updates, plotline_updates, context_refs, recent_event from model text: fences
    off, first { to last }, wrong collections refused, items cut to the most allowed before bad ones are dropped, unknown kinds and actions
    set to character and advance. A null counts as missing; other values count as text where text is asked for.
    """
    rows = outputs.withColumn("raw__", V.parsed(F.col(col)))
    r = lambda n: V.part(F.col("raw__"), n)
    objects = lambda n, needed: F.filter(F.slice(V.items(r(n)), 1, MOST[n]), lambda x: (V.kind(x) == "OBJECT") & (_cut(V.text(V.part(x, needed)), NAME) != ""))
    one_of = lambda x, known, other: F.when(ustrip(V.text(x)).isin(*known), ustrip(V.text(x))).otherwise(other)
    note = lambda x, key: _cut(V.solid(V.part(x, key)), STATUS)
    entities = F.transform(objects("entity_updates", "name"), lambda x: F.struct(_cut(V.text(V.part(x, "name")), NAME).alias("name"), one_of(V.part(x, "type"), ("character", "object", "location"), "character").alias("type"), note(x, "status").alias("status"), note(x, "note").alias("note"), F.lit(None).cast("array<string>").alias("aliases"), F.lit(None).cast("string").alias("kind")))
    plots = F.transform(objects("plotline_updates", "title"), lambda x: F.struct(one_of(V.part(x, "action"), ("open", "advance", "close"), "advance").alias("action"), _cut(V.text(V.part(x, "title")), TITLE).alias("title"), note(x, "note").alias("note")))
    name = lambda x: F.when(V.kind(x) == "STRING", V.text(x)).when(V.kind(x) == "OBJECT", V.text(V.part(x, "entity")))
    refs = F.filter(F.transform(F.slice(V.items(r("context_refs")), 1, MOST["context_refs"]), lambda x: _cut(name(x), STATUS)), lambda x: x != "")
    told = r("recent_event")
    event = _cut(F.when(V.kind(told) == "STRING", V.text(told)).when(V.kind(told) == "OBJECT", V.solid(V.part(told, "text"))), EVENT)
    summary = _cut(V.solid(r("summary")), SUMMARY)
    error = F.when(F.col("raw__").isNull(), "not_json").when(summary == "", "no_summary")
    for n in MOST:
        error = error.when((V.kind(r(n)) != "ARRAY") & ~V.is_empty(r(n)), n)
    rows = rows.withColumn("parse_error", error)
    ok = F.col("parse_error").isNull()
    return rows.withColumns({"summary": F.when(ok, summary), "entity_updates": F.when(ok, entities), "plotline_updates": F.when(ok, plots), "context_refs": F.when(ok, refs), "recent_event": F.when(ok & (event != ""), F.struct(event.alias("text")))}).drop("raw__")


#: Most items of a review patch; those of its lists that hold texts.
PATCH_MOST = {"rename_entities": 10, "entity_status_updates": 20, "plotline_fixes": 10, "remove_entities": 20, "context_ref_additions": 20}
PATCH_TEXTS = ("remove_entities", "context_ref_additions")
PATCH_NAME, PATCH_NOTE = 80, 120


def coerce_patch(outputs: DataFrame, col: str = "output") -> DataFrame:
    """outputs with parse_error and patch (as apply_patch takes it, null where there is an error) from the text of a review: items cut to the most allowed before bad ones are
    dropped, strings cut, a collection of another kind refused; for lists of texts only null and the empty text count as none. A null counts as missing."""
    rows = outputs.withColumn("raw__", V.parsed(F.col(col)))
    r = lambda n: V.part(F.col("raw__"), n)
    items = lambda n: F.slice(V.items(r(n)), 1, PATCH_MOST[n])
    part = lambda x, key, size: _cut(V.text(V.part(x, key)), size)
    objects = lambda n, *needed: F.filter(items(n), lambda x: reduce(lambda a, b: a & b, [part(x, k, PATCH_NAME) != "" for k in needed], V.kind(x) == "OBJECT"))
    strings = lambda n: F.filter(F.transform(items(n), lambda x: _cut(V.text(x), PATCH_NAME)), lambda x: x != "")
    renames = F.transform(objects("rename_entities", "from", "to"), lambda x: F.struct(part(x, "from", PATCH_NAME).alias("from"), part(x, "to", PATCH_NAME).alias("to")))
    updates = F.transform(objects("entity_status_updates", "name"), lambda x: F.struct(part(x, "name", PATCH_NAME).alias("name"), part(x, "status", PATCH_NOTE).alias("status"), part(x, "note", PATCH_NOTE).alias("note")))
    action = lambda x: F.coalesce(ustrip(V.text(V.part(x, "action"))), F.lit("advance"))
    fixes = F.transform(objects("plotline_fixes", "title"), lambda x: F.struct(action(x).alias("action"), part(x, "title", TITLE).alias("title"), part(x, "note", PATCH_NOTE).alias("note")))
    patch = F.struct(_cut(V.solid(r("summary_replacement")), SUMMARY).alias("summary_replacement"), _cut(V.solid(r("recent_event_replacement")), EVENT).alias("recent_event_replacement"), renames.alias("rename_entities"), updates.alias("entity_status_updates"), strings("remove_entities").alias("remove_entities"), fixes.alias("plotline_fixes"), strings("context_ref_additions").alias("context_ref_additions"))
    error = F.when(F.col("raw__").isNull(), F.lit("not_json"))
    for n in PATCH_MOST:
        none = (V.kind(r(n)) == "VOID") | F.coalesce((V.kind(r(n)) == "STRING") & (V.text(r(n)) == ""), F.lit(False)) if n in PATCH_TEXTS else V.is_empty(r(n))
        error = error.when((V.kind(r(n)) != "ARRAY") & ~none, n)
    rows = rows.withColumn("parse_error", error)
    return rows.withColumn("patch", F.when(F.col("parse_error").isNull(), patch)).drop("raw__")


def apply_patch(fields: DataFrame, patches: DataFrame) -> DataFrame:
    """fields (work_id, ord, summary, entity_updates, plotline_updates, context_refs, recent_event) after review patches (work_id, ord, patch).

    patch: summary_replacement, recent_event_replacement, rename_entities (array of from, to), entity_status_updates (name, status, note; by the new
    name; of several of a name the last status and the last note that aren't empty count), remove_entities, plotline_fixes (action, title, note; the first of a title and action stays), context_ref_additions. Null parts and missing patches change nothing.
    """
    rows = fields.join(patches.select("work_id", "ord", "patch"), ["work_id", "ord"], "left")
    p = lambda n: F.col("patch")[n]
    last = lambda items, test: F.try_element_at(F.filter(items, test), F.lit(-1))
    found = lambda items, test: F.coalesce(F.size(F.filter(items, test)) > 0, F.lit(False))
    renamed = lambda e: F.when(found(p("rename_entities"), lambda r: r["from"] == e["name"]), last(p("rename_entities"), lambda r: r["from"] == e["name"])["to"]).otherwise(e["name"])
    rebuilt = lambda e, name, status, note: F.struct(name.alias("name"), e["type"].alias("type"), status.alias("status"), note.alias("note"), e["aliases"].alias("aliases"), e["kind"].alias("kind"))
    named = F.transform("entity_updates", lambda e: rebuilt(e, renamed(e), e["status"], e["note"]))
    rows = rows.withColumn("named__", named)
    mine = lambda e: (lambda u: u["name"] == e["name"])
    pick = lambda e, key: F.coalesce(F.try_element_at(F.filter(p("entity_status_updates"), lambda u: mine(e)(u) & (u[key] != "")), F.lit(-1))[key], e[key])
    updated = F.transform("named__", lambda e: F.when(found(p("entity_status_updates"), mine(e)), rebuilt(e, e["name"], pick(e, "status"), pick(e, "note"))).otherwise(e))
    kept = F.filter(updated, lambda e: ~F.coalesce(F.array_contains(p("remove_entities"), e["name"]), F.lit(False)))
    every = F.concat("plotline_updates", F.coalesce(p("plotline_fixes"), F.array().cast(f"array<{PLOTLINE}>")))
    same = lambda a, b: (a["title"] == b["title"]) & (a["action"] == b["action"])
    plots = F.filter(every, lambda x, i: ~F.exists(F.slice(every, 1, i), lambda y: same(x, y)))
    refs = F.array_distinct(F.concat("context_refs", F.coalesce(p("context_ref_additions"), F.array().cast("array<string>"))))
    text = lambda n: F.nullif(F.coalesce(p(n), F.lit("")), F.lit(""))
    return rows.select("work_id", "ord", F.coalesce(text("summary_replacement"), "summary").alias("summary"), kept.alias("entity_updates"), plots.alias("plotline_updates"), refs.alias("context_refs"), F.when(text("recent_event_replacement").isNotNull(), F.struct(text("recent_event_replacement").alias("text"))).otherwise(F.col("recent_event")).alias("recent_event"))


def derive_tags(units: DataFrame) -> DataFrame:
    """units with characters, locations and key_terms: names by the kind of update, repeated ones kept; no kind counts as character."""
    names = lambda kind: F.transform(F.filter("entity_updates", lambda e: F.coalesce(e["type"], F.lit("character")) == kind), lambda e: e["name"])
    return units.withColumns({"characters": names("character"), "locations": names("location"), "key_terms": names("object")})


def _placed(units: DataFrame) -> DataFrame:
    """work_id, ord, place: a unit's number in its work, from 1."""
    numbers = units.select("work_id", "ord", F.floor(F.col("ord") / BLOCK).alias("group"))
    return prefix.scan(numbers, "work_id", "group", [F.col("ord")], sums={"earlier": F.lit(1)}).select("work_id", "ord", (F.col("earlier") + 1).alias("place"))


def recent_context(units: DataFrame, n: int = 2) -> DataFrame:
    """units with recent_text: texts of the n units before. Blocks of a work are sorted by themselves; the last n units of a block stand before the next one too."""
    block = F.floor(F.col("place__") / BLOCK)
    rows = units.join(_placed(units).withColumnRenamed("place", "place__"), ["work_id", "ord"]).withColumn("own__", block)
    near = F.floor((F.col("place__") + n) / BLOCK)
    rows = rows.withColumn("block__", F.explode(F.sequence(F.col("own__"), near)))
    before = W.partitionBy("work_id", "block__").orderBy("place__").rowsBetween(-n, -1)
    rows = rows.withColumn("recent_text", F.array_join(F.collect_list("text").over(before), "\n"))
    return rows.where("own__ = block__").select(*units.columns, "recent_text")


def related_context(units: DataFrame, top: int = 3, most_chars: int = 1800) -> DataFrame:
    """work_id, ord, related: earlier units, the last two left out, that share most content signs with the unit; best three, cut to most_chars.

    Blocks of a work's units meet in pairs, each pair in a task of its own: one matrix product counts what their units share, and a unit keeps the best of
    each block, so that no pair of units is ever a row.
    """
    found = F.array_distinct(content_signs(F.coalesce("text", F.lit(""))))
    shape = units.select("work_id", "ord", "chapter_name", "text", F.array_join(found, "").alias("signs")).join(_placed(units), ["work_id", "ord"])
    block, last = F.floor(F.col("place") / BLOCK).cast("int"), F.floor(F.col("n") / BLOCK).cast("int")
    signs = shape.select("work_id", "place", "signs").join(shape.groupBy("work_id").agg(F.count(F.lit(1)).alias("n")), "work_id")
    now = signs.where(F.length("signs") >= 2).select("work_id", "place", "signs", block.alias("now"), F.explode(F.sequence(F.lit(0), block)).alias("then"))
    then = signs.select("work_id", "place", "signs", block.alias("then"), F.explode(F.sequence(block, last)).alias("now"))

    def best(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            alphabet = {c: k for k, c in enumerate(sorted(set("".join(left["signs"]) + "".join(right["signs"]))))}
            marked = [np.zeros((len(part), len(alphabet)), np.float32) for part in (left, right)]
            for m, part in zip(marked, (left, right), strict=True):
                for k, signs in enumerate(part["signs"]):
                    m[k, [alphabet[c] for c in signs]] = 1
            shared, places = marked[0] @ marked[1].T, right["place"].to_numpy()
            for k, place in enumerate(left["place"]):
                at = np.flatnonzero((shared[k] > 0) & (places <= place - 3))
                at = at[np.lexsort((-places[at], -shared[k, at]))][:top]
                out.append(pd.DataFrame({"work_id": left["work_id"].iloc[0], "now": place, "place": places[at], "score": shared[k, at].astype(np.int64)}))
        out = [o for o in out if len(o)]
        return pd.concat(out) if out else pd.DataFrame({c: pd.Series(dtype=t) for c, t in (("work_id", object), ("now", "int64"), ("place", "int64"), ("score", "int64"))})

    keys = ["work_id", "now", "then"]
    shared = now.toDF(*now.columns).groupBy(*keys).cogroup(then.groupBy(*keys)).applyInPandas(best, "work_id string, now long, place long, score long")
    best_ = shared.withColumn("rank", F.row_number().over(W.partitionBy("work_id", "now").orderBy(F.desc("score"), F.desc("place")))).where(F.col("rank") <= top)
    piece = F.concat(F.lit("@"), F.col("ord").cast("string"), F.lit("（"), F.col("chapter_name"), F.lit("，相关度"), F.col("score").cast("string"), F.lit("）："), ustrip(F.col("text")))
    rows = best_.join(shape.select("work_id", "place", "ord", "chapter_name", "text"), ["work_id", "place"]).select("work_id", "now", "rank", piece.alias("piece"))
    used = F.coalesce(F.sum(F.length("piece") + 1).over(W.partitionBy("work_id", "now").orderBy("rank").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    rows = rows.withColumn("cut", F.substring("piece", F.lit(1), F.greatest(most_chars - used, F.lit(0)).cast("int"))).where("cut <> ''")
    text = rows.groupBy("work_id", "now").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("rank", "cut"))), lambda x: x["cut"]), "\n").alias("related"))
    return shape.select("work_id", "ord", F.col("place").alias("now")).join(text, ["work_id", "now"], "left").select("work_id", "ord", F.coalesce("related", F.lit("")).alias("related"))


def cache_key(*parts: Column) -> Column:
    """Key of a result: hash of its inputs, joined by line feeds."""
    return F.sha2(F.concat_ws("\n", *[F.coalesce(p, F.lit("")) for p in parts]), 256)


def cache_split(inputs: DataFrame, cache: DataFrame, namespace: str, force: bool = False) -> tuple[DataFrame, DataFrame]:
    """(hits with fields_json, misses) of inputs by their key column; force finds no hit."""
    own = cache.where((F.col("namespace") == namespace) & F.lit(not force)).groupBy("key").agg(F.max("fields_json").alias("fields_json"))
    return inputs.join(own, "key"), inputs.join(own, "key", "left_anti")


def cache_append(results: DataFrame, namespace: str) -> DataFrame:
    """Rows to be added to the cache: degraded results never are."""
    return results.where(~F.col("degraded")).select(F.lit(namespace).alias("namespace"), "key", "fields_json")


def extract_units(inputs: DataFrame, extractor: Callable[[dict], str], attempts: int = 3) -> DataFrame:
    """inputs with output (model text) and error, made by a callable on the executors; tried again up to attempts times. A unit that fails has a null output."""
    schema = StructType([*inputs.schema.fields, StructField("output", StringType()), StructField("error", StringType())])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            got: list[tuple[str | None, str | None]] = []
            for row in frame.to_dict("records"):
                output, error = None, None
                for _ in range(attempts):
                    try:
                        output, error = extractor(row), None
                        break
                    except Exception as e:  # noqa: BLE001
                        error = repr(e)
                got.append((output, error))
            yield frame.assign(output=[g[0] for g in got], error=[g[1] for g in got])

    return inputs.mapInPandas(run, schema)


TASKS = "outputs map<string,string>, errors array<struct<task:string,attempt:int,error:string>>"


def object_of(answer: str) -> dict:
    """The object between the first { and the last } of model text; raises where there is none."""
    body = answer.replace("```json", "").replace("```", "")
    found = json.loads(body[body.index("{") : body.rindex("}") + 1])
    if not isinstance(found, dict):
        raise ValueError("no object")
    return found


def extract_tasks(inputs: DataFrame, extractors: dict[str, Callable[[dict], str]], mandatory: tuple[str, ...] = ("summary",), attempts: int = 3, check: Callable[[str], object] | None = None) -> DataFrame:
    """inputs with outputs (text by task), errors (one for each failed attempt) and failed: whether a mandatory task found no answer. Every task is tried up to attempts times by its own
    callable on the executors, and again where check refuses its answer (object_of, say) by an exception; an optional one that fails is left out of outputs."""
    schema = StructType([*inputs.schema.fields, *StructType.fromDDL(TASKS).fields, StructField("failed", BooleanType())])

    def one(row: dict) -> tuple[dict, list, bool]:
        outputs, errors = {}, []
        for task, extractor in extractors.items():
            for attempt in range(1, attempts + 1):
                try:
                    answer = extractor(row)
                    if check is not None:
                        check(answer)
                    outputs[task] = answer
                    break
                except Exception as e:  # noqa: BLE001
                    errors.append({"task": task, "attempt": attempt, "error": repr(e)})
            if task in mandatory and task not in outputs:
                return {}, errors, True
        return outputs, errors, False

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            got = [one(row) for row in frame.to_dict("records")]
            yield frame.assign(outputs=[g[0] for g in got], errors=[g[1] for g in got], failed=[g[2] for g in got])

    return inputs.mapInPandas(run, schema)


#: The fields that each task answers.
ANSWERS = {"summary": ("summary", "recent_event"), "entity": ("entity_updates",), "relation": ("plotline_updates", "context_refs")}


def merged_tasks(tasks: DataFrame, answers: dict[str, tuple[str, ...]] = ANSWERS) -> DataFrame:
    """tasks (extract_tasks) with output: one object of the fields that each task answers, as coerce_fields takes it; null where a mandatory task failed. What a task left out stays out."""
    said = [F.concat(F.lit(f'"{field}":'), F.to_json(V.part(V.parsed(F.col("outputs")[task]), field))) for task, fields in answers.items() for field in fields]
    return tasks.withColumn("output", F.when(~F.col("failed"), F.concat(F.lit("{"), F.concat_ws(",", *said), F.lit("}"))))


def with_fallback(coerced: DataFrame, separators: tuple[str, ...] = SEPARATORS) -> DataFrame:
    """Units with coerced fields (coerce_fields) and degraded: a unit with a parse_error gets the fields of its first sentence instead, and none of the model's."""
    bad = F.col("parse_error").isNotNull()
    return coerced.withColumns({n: F.when(bad, c).otherwise(F.col(n)) for n, c in _fallback(separators).items()} | {"degraded": bad})


def run_report(extracted: DataFrame, errors: DataFrame | None = None, usage: DataFrame | None = None, compressions: DataFrame | None = None) -> DataFrame:
    """Units, cached, fresh and degraded of each work; with errors (work_id, a row for each failed attempt) also their number, with usage (work_id, prompt_tokens, completion_tokens, a
    row for each request) requests and sums of tokens, with compressions (work_id, cached, a row for each archived chapter) how many came from the cache."""
    report = extracted.groupBy("work_id").agg(F.count(F.lit(1)).alias("units"), F.count_if("cached").alias("cached"), F.count_if(~F.col("cached")).alias("fresh"), F.count_if("degraded").alias("degraded"))
    parts: list[DataFrame] = []
    if errors is not None:
        parts.append(errors.groupBy("work_id").agg(F.count(F.lit(1)).alias("errors")))
    if usage is not None:
        n = lambda c: F.coalesce(F.col(c), F.lit(0))
        parts.append(usage.groupBy("work_id").agg(F.count(F.lit(1)).alias("requests"), F.sum(n("prompt_tokens")).alias("prompt_tokens"), F.sum(n("completion_tokens")).alias("completion_tokens"), F.sum(n("prompt_tokens") + n("completion_tokens")).alias("total_tokens")))
    if compressions is not None:
        parts.append(compressions.groupBy("work_id").agg(F.count_if("cached").alias("compress_cached"), F.count_if(~F.col("cached")).alias("compress_fresh")))
    for part in parts:
        report = report.join(part, "work_id", "left").fillna(0, [c for c in part.columns if c != "work_id"])
    return report
