"""Findings of the fourth round."""

import numpy as np
import pytest

from narrative_spark.operators import direct, lexical

ASKED = "query_id string, work_id string, query string, max_order long, chapter string"


def drawn(spark, seed=3, n=400):
    """Units of three works, some without signs, many with the same score; and queries with and without a boundary, a chapter or a hit."""
    draw = np.random.default_rng(seed)
    words = ["Über", "Brücke", "brucke", "the", "then", "ende", "発動機", "x", "7", "...", "a-b"]
    rows = [(f"w{k % 3}", f"w{k % 3}-{k:04d}", k, None if k % 41 == 5 else f"part {k % 4}", " ".join(draw.choice(words, draw.integers(0, 6)))) for k in range(1, n)]
    asked = [(f"q{k}", f"w{k % 4}", " ".join(draw.choice(words, 3)), [None, 40, 200, 0][k % 4], [None, "", "part 1", "none"][k % 5 % 4]) for k in range(24)]
    return spark.createDataFrame(rows, "work_id string, unit_id string, ord long, chapter_name string, text string"), spark.createDataFrame(asked, ASKED)


def told(rows):
    return sorted((r.query_id, r.place, r.work_id, r.unit_id, r.ord, round(r.score, 9)) for r in rows.collect())


@pytest.mark.parametrize("tokenizer", ["pair", "run"])
def test_direct_search_equals_that_by_postings(spark, monkeypatch, tokenizer):
    """F2, F8-F16: the same rows, however units are dealt, with no posting written or shuffled."""
    units, asked = drawn(spark)
    want = told(lexical.search_bm25(asked, lexical.build_postings(units, tokenizer), lexical.index_stats(units, tokenizer), 9, tokenizer))
    assert told(direct.search_units(asked, units, 9, tokenizer)) == want and len({r[0] for r in want}) > 8
    for name, value in (("SLICE", 2), ("UNITS", 7), ("SIGNS", 60), ("HELD", 20)):
        monkeypatch.setattr(direct, name, value)
    assert told(direct.search_units(asked, units.repartition(5), 9, tokenizer)) == want


def test_direct_search_bounds_frequencies(spark, tmp_path):
    units, asked = drawn(spark)
    want = told(lexical.search_index(asked, lexical.write_index(units, f"{tmp_path}/i"), 9, "boundary"))
    assert told(direct.search_units(asked, units, 9, stats_scope="boundary")) == want and want
    assert want != told(direct.search_units(asked, units, 9))


def test_direct_search_of_many_terms_goes_by_postings(spark, monkeypatch):
    units, asked = drawn(spark)
    want = told(direct.search_units(asked, units, 9))
    monkeypatch.setattr(lexical, "SENT_TERMS", 5)
    assert told(direct.search_units(asked, units, 9)) == want


def test_direct_search_without_queries_or_units(spark):
    units, asked = drawn(spark)
    assert direct.search_units(asked.limit(0), units).count() == direct.search_units(asked, units.limit(0)).count() == 0


@pytest.mark.parametrize("name", ["search_run", "search_bm25", "search_bounded", "search", "search_routes"])
def test_searches_shuffle_no_postings(spark, sf_dir, name):
    """Before, each of these wrote or shuffled a row for each pair of letters of each unit."""
    from narrative_spark.jobs import catalog
    from narrative_spark.sources import stages

    made, place = [], stages.place
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(stages, "place", lambda s, label: made.append(label) or place(s, label))
        plan = catalog.QUERIES[name](spark, sf_dir)._jdf.queryExecution().toString()
    assert "index" not in made and "size#" not in plan


def test_runs_are_of_letters_and_digits():
    signs = lexical._is_sign()
    assert all((direct.RUN.match(chr(k)) is not None) == signs[k] for k in range(0x110000))


def test_a_slot_is_dealt_to_tasks_and_refreshed_by_one_write(spark, tmp_path, monkeypatch):
    """a slot of many signs lies in several files, each with all terms of its units; a refresh writes no postings but those of the slots, and leaves nothing beside them."""
    import os

    from narrative_spark.sources import stages

    monkeypatch.setattr(lexical, "SORTED_SIGNS", 900)
    monkeypatch.setattr(lexical, "BLOCK", 16)
    rows = [(f"w{k % 2}", f"w{k % 2}-{k:04d}", k, "c", f"some words {k} and more of them") for k in range(1, 200)]
    units = spark.createDataFrame(rows, "work_id string, unit_id string, ord long, chapter_name string, text string")
    lexical.write_index(units.where("work_id = 'w0' or ord % 4 = 1"), f"{tmp_path}/i", slots=2)
    made, stored = [], stages.stored
    monkeypatch.setattr(lexical, "stored", lambda df, label: made.append(label) or stored(df, label))
    index = lexical.refresh_index(units.where("work_id = 'w1'"), f"{tmp_path}/i")
    assert "postings" not in made and sorted(x for x in os.listdir(f"{tmp_path}/i") if x.startswith("new")) == []
    files = index.postings.selectExpr("input_file_name() f", "slot", "unit_id").distinct().collect()
    assert len({r.f for r in files}) > len({r.slot for r in files}) and len(files) == len(rows)
    asked = spark.createDataFrame([("q", "w1", "some words 77", None, None), ("r", "w0", "more", 60, None)], ASKED)
    assert told(lexical.search_index(asked, index)) == told(direct.search_units(asked, units)) != []
