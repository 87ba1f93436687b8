import json

import numpy as np
from pyspark.sql import functions as F

from narrative_spark.operators import extract, lexical, normalize, search, segment, state, validate, vectors, views
from narrative_spark.sources import stages
from narrative_spark.streaming import fold


def units_of(spark, rows):
    return spark.createDataFrame([(w, f"{w}-{o:04d}", o, c, n, t) for w, o, c, n, t in rows], "work_id string, unit_id string, ord long, chapter_idx int, chapter_name string, text string").withColumns({"start_line": F.col("ord"), "end_line": F.col("ord"), "chars": F.length("text")})


def test_segmentation_keeps_lines_and_numbers(spark):
    raw = spark.createDataFrame([("w", 1, "Title\r\n\r\n　early　\n# A\nshort\n" + "x" * 81 + "\nmore\n# B\n# C\nend")], "work_id string, part int, text string")
    works = spark.createDataFrame([("w", None, None, "wk")], "work_id string, title string, title_is_first_line boolean, work_short string")
    body, titles = normalize.split_title(normalize.normalize_lines(raw), works)
    assert titles.first().title == "Title"
    heads = spark.createDataFrame([("w", h) for h in ("# A", "# B", "# C", "# D")], "work_id string, header string")
    marked = segment.label_chapters(body, heads)
    got = [tuple(r) for r in segment.segment_units(marked, works).orderBy("ord").select("unit_id", "chapter_idx", "chapter_name", "start_line", "end_line", "text").collect()]
    assert got == [("wk-0001", 0, "", 3, 3, "early"), ("wk-0002", 1, "# A", 5, 5, "short"), ("wk-0003", 1, "# A", 6, 7, "x" * 81 + "\nmore"), ("wk-0004", 3, "# C", 10, 10, "end")]
    assert [tuple(r) for r in segment.segment_warnings(marked, heads).collect()] == [("w", 4, 3)]
    units = segment.segment_units(marked, works)
    assert {r.header for r in validate.check_headers(units, heads).collect()} == {"# B", "# D"}
    assert validate.check_lossless(marked, units).first().ok


def test_fallback_takes_the_first_sentence(spark):
    df = spark.createDataFrame([("第一句。第二句",), ("。！真的",), ("a" * 70,), ("",), (None,)], "text string")
    assert [r.s for r in df.select(extract.first_sentence(F.col("text")).alias("s")).collect()] == ["第一句", "。", "a" * 60 + "……", "", ""]


def test_coercion_repairs_and_refuses(spark):
    outputs = [
        '```json\n{"summary": " ok ", "entity_updates": [{"name": "A", "type": "robot"}, {"name": " "}, 5, {"name": "B", "type": "object", "status": null}], "plotline_updates": [{"title": "T", "action": "jump"}], "context_refs": ["x", " ", 5, {"entity": "y"}], "recent_event": "went"}\n```',
        '{"summary": "s", "entity_updates": {"name": "A"}}',
        '{"summary": ""}',
        "no json",
        None,
    ]
    rows = extract.coerce_fields(spark.createDataFrame([(k, o) for k, o in enumerate(outputs)], "id int, output string")).orderBy("id").collect()
    assert [r.parse_error for r in rows] == [None, "entity_updates", "no_summary", "not_json", "not_json"]
    one = rows[0]
    assert one.summary == "ok" and [(e.name, e.type, e.status) for e in one.entity_updates] == [("A", "character", ""), ("B", "object", "")]
    assert [(p.title, p.action) for p in one.plotline_updates] == [("T", "advance")] and one.recent_event.text == "went"
    assert one.context_refs[0] == "x" and one.context_refs[-1] == "y"


def test_failing_extractor_leaves_an_error(spark):
    def sometimes(row):
        if row["k"] == 1:
            raise ValueError("no")
        return "done"

    rows = extract.extract_units(spark.createDataFrame([(0,), (1,)], "k long"), sometimes, 2).orderBy("k").collect()
    assert [(r.output, r.error is None) for r in rows] == [("done", True), (None, False)]


def test_query_terms(spark):
    q = spark.createDataFrame([("1", "发动机 的 发动"), ("2", "的"), ("3", "…"), ("4", None)], "query_id string, query string")
    assert [r.terms for r in lexical.analyze_queries(q).orderBy("query_id").collect()] == [["发动", "动机", "机发"], ["的"], [], []]


def test_routes_and_diagnostics(spark):
    units = units_of(spark, [("w", 1, 1, "A", "发动机启动"), ("w", 2, 1, "A", "发动机停了"), ("v", 1, 1, "A", "别的")])
    asked = spark.createDataFrame([("hit", "w", "发动机", 1, None), ("none", "w", "月球", None, None), ("gone", "x", "月球", None, None)], "query_id string, work_id string, query string, max_order long, chapter string")
    rows = search.search(asked, units, lexical.build_postings(units), lexical.index_stats(units))
    assert {(r.query_id, r.unit_id, r.used) for r in rows.collect()} == {("hit", "w-0001", "fts")}
    got = {r.query_id: (r.used, r.fallback_reason, r.eligible_units, r.candidates) for r in search.search_diagnostics(asked, units, rows).collect()}
    assert got == {"hit": ("fts", "vector_unavailable_or_stale", 1, 1), "none": ("scan", "vector_then_fts_unavailable_or_no_match", 2, 0), "gone": ("none", "work_not_found_or_empty", 0, 0)}
    assert search.to_evidence(rows, units, 0).count() == 0


def test_references_are_names_only(spark):
    raw = spark.createDataFrame([('[" a ", "", null, 5, {"entity": "b"}, "a"]',), ("[]",), (None,)], "r string")
    assert [r.n for r in raw.select(search.normalize_refs(F.col("r")).alias("n")).collect()] == [["a", "b"], None, None]


def test_vectors_keep_to_the_boundary(spark):
    units = units_of(spark, [("w", 1, 1, "A", "发动机"), ("w", 2, 1, "A", "加代子"), ("w", 3, 1, "B", "发动机")])
    encode = lambda texts: [[float("发动机" in t) + 0.01, float("加代子" in t) + 0.01] for t in texts]
    made = units.join(vectors.build_vectors(vectors.retrieval_text(units), encode).drop("content"), ["work_id", "unit_id"])
    asked = spark.createDataFrame([("q", "w", 2, None, [1.0, 0.0]), ("c", "w", None, "B", [1.0, 0.0])], "query_id string, work_id string, max_order long, chapter string, vector array<double>")
    assert [(r.query_id, r.ord) for r in vectors.search_vector(asked, made).orderBy("query_id", "place").collect()] == [("c", 3), ("q", 1), ("q", 2)]
    now = spark.createDataFrame([("w", "new")], "work_id string, source_sha256 string")
    old = spark.createDataFrame([("w", "old")], "work_id string, source_sha256 string")
    assert not vectors.index_status(vectors.index_meta(made, old), now).first().current
    assert vectors.index_status(vectors.index_meta(made, now), now).first().current


DELTA = "work_id string, ord long, chapter_idx int, entity_updates array<struct<name:string,type:string,status:string,note:string,aliases:array<string>,kind:string>>, plotline_updates array<struct<action:string,title:string,note:string>>, recent_event struct<text:string>, degraded boolean"


def deltas(spark):
    rows = [("w", k, 1 if k <= 6 else 2, [("A", "character", f"s{k}", "", ["Al"] if k == 1 else None, None)], [("close" if k == 3 else "advance", "P", "")], (f"e{k}",), k == 5) for k in range(1, 8)]
    rows.append(("w", 8, 2, [("Al", "character", "", "known", None, None), ("H", "location", "far", "", None, None)], [], None, False))
    return spark.createDataFrame(rows, DELTA)


def test_fold_follows_aliases_and_skips_degraded_units(spark):
    got = {r.ord: json.loads(r.snapshot) for r in state.fold_state(deltas(spark)).collect()}
    assert got[5] == got[4] and got[4]["last_order"] == 4
    assert got[8]["characters"] == [{"name": "A", "aliases": ["Al"], "status": "s7", "note": "known", "first_seen_order": 1, "last_seen_order": 8}]
    assert got[8]["locations"][0]["note"] == "far"
    assert got[8]["plotlines"][0]["status"] == "closed" and got[8]["plotlines"][0]["closed_order"] == 3 and got[8]["plotlines"][0]["key_orders"] == [1, 2, 3, 4, 6, 7]
    assert got[6]["backdrop"] == "" and got[7]["backdrop_buffer"] == [{"order": 1, "text": "e1"}] and got[8]["backdrop"] == "@1 e1"


def test_fold_holds_a_batch_and_writes_only_the_asked_snapshots(spark):
    copies = deltas(spark).drop("work_id").crossJoin(spark.createDataFrame([(f"w{k}",) for k in range(7)], "work_id string"))
    want = {}
    by_work: dict[str, list[dict]] = {}
    for r in copies.orderBy("work_id", "ord").collect():
        by_work.setdefault(r.work_id, []).append(r.asDict(recursive=True))
    for work, rows in by_work.items():
        want |= {(r[0], r[1]): r[3] for r in state.fold_rows(state.Story(work), rows, state.joined, True, None)}
    marked = copies.where("ord in (2, 5)").select("work_id", "ord")
    for size in ("1", "2", "3", "1000"):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
        try:
            for keep, orders in (("unit", range(1, 9)), ("chapter", (6, 8)), ("work", (8,)), ("marked", (2, 5))):
                made = state.fold_state(copies, keep=keep, marked=marked if keep == "marked" else None)
                assert "FlatMapGroupsInPandas" not in made._jdf.queryExecution().toString()
                assert {(r.work_id, r.ord): r.snapshot for r in made.collect()} == {k: v for k, v in want.items() if k[1] in orders}
        finally:
            spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_stream_waits_for_gaps_and_drops_late_units(spark, tmp_path):
    rows = fold.as_stream_rows(deltas(spark)).cache()
    for name, orders in (("a", [2, 1]), ("b", [2, 4]), ("c", [3, 5, 6, 7, 8])):
        rows.where(F.col("ord").isin(orders)).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        got = fold.run_available(spark, str(tmp_path / "in"), rows.schema, str(tmp_path / "out"), str(tmp_path / "ck"))
    batch = {r.ord: r.fingerprint for r in state.fold_state(deltas(spark)).collect()}
    assert {r.ord: r.fingerprint for r in got.collect()} == batch and got.count() == 8


def test_views_fail_closed(spark):
    good = {"work_id": "w", "last_order": 2, "backdrop": "", "characters": [{"name": "A", "first_seen_order": 1}]}
    bad = {"identity": {"last_order": 3}, "type": {"last_order": True}, "backdrop": {"backdrop": 5}, "group": {"characters": {}}, "future": {"characters": [{"first_seen_order": 9}]}, "ok": {}}
    rows = spark.createDataFrame([(k, 2, json.dumps({**good, "work_id": k, **v}), False) for k, v in bad.items()] + [("none", 2, None, False), ("bent", 2, "{}", True)], "work_id string, ord long, snapshot string, degraded boolean")
    got = {r.work_id: r.reason for r in views.validate_snapshots(rows).collect()}
    assert got == {"identity": "snapshot_identity", "type": "snapshot_identity", "backdrop": "invalid_backdrop", "group": "invalid_group", "future": "future_or_invalid_order", "ok": None, "none": "missing_snapshot", "bent": "degraded_snapshot"}
    readers = spark.createDataFrame([("r1", "ok", 1), ("r2", "ok", 5), ("r3", "future", 5)], "reader_id string, work_id string, max_order long")
    assert {r.reader_id: r.status for r in views.progressive_view(rows, readers).collect()} == {"r1": "unavailable", "r2": "ok", "r3": "invalid"}


def test_each_fault_of_a_snapshot_has_its_code(spark):
    """Only the named order fields may be null; booleans are no orders; other fields that end in _order aren't looked at."""
    good = {"work_id": "w", "last_order": 1}
    cases = [
        (None, "missing_snapshot"), ("no json", "missing_snapshot"), ("[]", "missing_snapshot"), ("{}", "snapshot_identity"), ({"last_order": True}, "future_or_invalid_order"), ({"last_order": 2}, "snapshot_identity"), ({"last_order": None}, "snapshot_identity"),
        ({"backdrop": None}, "invalid_backdrop"), ({"recent": None}, "invalid_group"), ({"objects": [1]}, "invalid_group"), ({"characters": [{"first_seen_order": None}]}, None), ({"characters": [{"last_seen_order": 2}]}, "future_or_invalid_order"),
        ({"plotlines": [{"key_orders": [0, 1], "closed_order": None}]}, None), ({"plotlines": [{"key_orders": None}]}, "future_or_invalid_order"), ({"plotlines": [{"key_orders": [1.0]}]}, "future_or_invalid_order"), ({"plotlines": [{"opened_order": -1}]}, "future_or_invalid_order"),
        ({"backdrop_buffer": [{"order": "1"}]}, "future_or_invalid_order"), ({"more": {"deep": [{"order": 9}]}}, "future_or_invalid_order"), ({"sort_order": 99, "line_orders": "x"}, None),
    ]
    rows = [(k, "w", 1, x if x is None or isinstance(x, str) else json.dumps({**good, **x}), False) for k, (x, _) in enumerate(cases)]
    got = {r.k: r.reason for r in views.validate_snapshots(spark.createDataFrame(rows, "k int, work_id string, ord long, snapshot string, degraded boolean")).collect()}
    assert got == {k: reason for k, (_, reason) in enumerate(cases)}


def test_review_patches_are_coerced_and_applied(spark):
    outputs = [
        '```json\n{"summary_replacement": " new ", "rename_entities": [{"from": "A", "to": "B"}, {"from": "A"}, "x"], "entity_status_updates": [{"name": "B", "status": "well"}], "remove_entities": ["C", 5, ""], "plotline_fixes": [{"title": "T"}], "context_ref_additions": ["r"]}\n```',
        '{"remove_entities": {"a": 1}}',
        "no json",
        '{"rename_entities": null}',
    ]
    rows = extract.coerce_patch(spark.createDataFrame([("w", k, o) for k, o in enumerate(outputs)], "work_id string, ord long, output string"))
    got = {r.ord: r for r in rows.collect()}
    assert [got[k].parse_error for k in range(4)] == [None, "remove_entities", "not_json", None]
    assert got[1].patch is None and got[3].patch.rename_entities == [] and got[3].patch.summary_replacement == ""
    fields = spark.createDataFrame([("w", k, "s", [("A", "character", "", "", None, None), ("C", "character", "", "", None, None)], [("advance", "T", "")], ["q"], None) for k in range(4)], f"work_id string, ord long, summary string, entity_updates array<{extract.ENTITY}>, plotline_updates array<{extract.PLOTLINE}>, context_refs array<string>, recent_event struct<text:string>")
    done = {r.ord: r for r in extract.apply_patch(fields, rows).collect()}
    assert (done[0].summary, [(e.name, e.status) for e in done[0].entity_updates], len(done[0].plotline_updates), done[0].context_refs) == ("new", [("B", "well")], 1, ["q", "r"])
    assert all((done[k].summary, len(done[k].entity_updates)) == ("s", 2) for k in (1, 2, 3))


def test_tasks_fail_each_for_itself(spark):
    def summary(row):
        if row["k"] == 1:
            raise ValueError("no")
        return '{"summary": "fine"}'

    def entity(row):
        raise KeyError(row["k"])

    got = {r.k: r for r in extract.extract_tasks(spark.createDataFrame([(0,), (1,)], "k long"), {"summary": summary, "entity": entity}, attempts=2).collect()}
    assert got[0].outputs == {"summary": '{"summary": "fine"}'} and not got[0].failed and [(e.task, e.attempt) for e in got[0].errors] == [("entity", 1), ("entity", 2)]
    assert got[1].outputs == {} and got[1].failed and [(e.task, e.attempt) for e in got[1].errors] == [("summary", 1), ("summary", 2)]


def test_bad_output_falls_back_to_the_first_sentence(spark):
    rows = spark.createDataFrame([(0, "One. Two", '{"summary": "s", "entity_updates": [{"name": "A"}]}'), (1, "One. Two", "sorry"), (2, "", None)], "k long, text string, output string")
    got = {r.k: r for r in extract.with_fallback(extract.coerce_fields(rows), (".",)).collect()}
    assert (got[0].summary, got[0].degraded, len(got[0].entity_updates)) == ("s", False, 1)
    assert (got[1].summary, got[1].degraded, got[1].entity_updates, got[1].recent_event.text) == ("One", True, [], "One")
    assert (got[2].summary, got[2].degraded, got[2].recent_event) == ("", True, None)


def test_runs_of_letters_meet_queries_without_their_marks(spark):
    units = units_of(spark, [("w", 1, 1, "A", "Über die Brücke"), ("w", 2, 1, "A", "Eine Brucke"), ("w", 3, 1, "A", "nichts")])
    asked = spark.createDataFrame([("q", "w", "BRÜCKE, über", None, None)], "query_id string, work_id string, query string, max_order long, chapter string")
    got = lexical.search_bm25(asked, lexical.build_postings(units, "run"), lexical.index_stats(units, "run"), tokenizer="run").orderBy("place").collect()
    assert [r.ord for r in got] == [1, 2]


def test_blocks_of_vectors_and_units_lose_nothing(spark, monkeypatch):
    """Small blocks, many of them, against one block."""
    draw = np.random.default_rng(5)
    stored = spark.createDataFrame([(f"w{k % 2}", f"u{k}", k, "A", draw.normal(size=4).tolist()) for k in range(60)], "work_id string, unit_id string, ord long, chapter_name string, vector array<double>")
    asked = stored.where("ord % 3 = 0").selectExpr("unit_id query_id", "work_id", "ord max_order", "cast(null as string) chapter", "vector")
    talk = units_of(spark, [("w", k, 1, "A", "".join(draw.choice(list("abcdefgh"), 4))) for k in range(1, 40)] + [("v", k, 1, "A", "xyz") for k in range(1, 6)])
    positions = spark.createDataFrame([(f"r{k}", "w0", k) for k in (-1, 0, 1, 7, 30, 2**62)], "reader_id string, work_id string, max_order long")
    spread = stored.where("work_id = 'w0'")
    ranges = spark.createDataFrame([("a", "w0", 3, 11), ("b", "w0", 50, 2**62), ("c", "w1", -5, 1), ("d", "w0", 9, 8)], "range_id string, work_id string, low long, high long")

    def rows():
        events = talk.withColumns({"recent_event": F.when(F.col("ord") % 4 > 0, F.struct(F.concat(F.lit("e"), F.col("ord").cast("string")).alias("text"))), "degraded": F.lit(False), "chapter_idx": F.floor(F.col("ord") / 7).cast("int")})
        made = [extract.recent_context(talk), views.reading_locations(events), state.recent_events(events), state.archive_backdrop(events), vectors.search_vector(asked, stored, 5), extract.related_context(talk), views.read_units(spread, positions), views.as_of(spread, positions).drop("vector"), views.get_range(stored, ranges).drop("vector")]
        return [sorted(map(repr, m.collect())) for m in made]

    whole = rows()
    for module, names in ((vectors, {"QUERIES": 7, "VECTORS": 11, "SLICE": 2}), (extract, {"BLOCK": 4}), (views, {"BLOCK": 4}), (state, {"BLOCK": 4})):
        for name, size in names.items():
            monkeypatch.setattr(module, name, size)
    assert rows() == whole and all(whole)


def test_raw_files_and_units(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw/a.txt").write_bytes("一\r\n二".encode("gb18030"))
    (tmp_path / "raw/b.txt").write_bytes(b"\xef\xbb\xbfabc")
    got = {r.source_file.rsplit("/", 1)[1]: (r.encoding, r.text) for r in stages.read_raw(spark, str(tmp_path / "raw")).collect()}
    assert got == {"a.txt": ("gb18030", "一\n二"), "b.txt": ("utf-8-sig", "abc")}
    assert stages.source_manifest(spark, str(tmp_path / "raw")).count() == 2
    (tmp_path / "u.jsonl").write_text('{"work_id": "w", "unit_id": "w-1", "text": "four"}\n\n')
    stages.write_units(stages.read_units(spark, str(tmp_path / "u.jsonl")), str(tmp_path / "units"))
    assert [r.asDict() for r in stages.read_units(spark, str(tmp_path / "units")).collect()] == [r.asDict() for r in stages.read_units(spark, str(tmp_path / "u.jsonl")).collect()]
    unit = stages.read_units(spark, str(tmp_path / "u.jsonl")).first()
    assert unit.chars == 4 and unit.characters == [] and unit.degraded is False and unit.recent_event is None
    stages.write_stage(spark.createDataFrame([("w", 1), ("v", 1)], "work_id string, x int"), str(tmp_path / "stage"))
    stages.write_stage(spark.createDataFrame([("w", 2)], "work_id string, x int"), str(tmp_path / "stage"))
    assert {(r.work_id, r.x) for r in spark.read.parquet(str(tmp_path / "stage")).collect()} == {("w", 2), ("v", 1)}
