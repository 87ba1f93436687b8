"""The pipeline's stages against what they promise."""

import zlib

import corpus_pipeline
import numpy as np
from pyspark.sql import functions as F

from narrative_spark.llm import decontaminate, near, pii, rules
from narrative_spark.llm.common import materialize
from narrative_spark.llm.tokens import UnitTokenizer, tokenizer_path
from tests.llm.test_operators import WORD, cut_out, lower


def test_stages_keep_columns_and_clean_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    now = docs
    for name, stage in corpus_pipeline.STAGES:
        made = materialize(stage(spark, now, sf_dir), f"test-{name}")
        if name == "quality_rules":
            want = {r.doc_id for r in rules.judge(now).where("quality_rules.kept").collect()}
        elif name == "near_duplicates":
            want = {r.class_id for r in near.classes(now).collect()}
        elif name == "decontamination":
            bad = decontaminate.verdict()["contaminated"]
            want = {r.doc_id for r in decontaminate.find_overlaps(now, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).where(~bad).collect()}
        else:
            want = {r.doc_id for r in now.collect()}
        assert {r.doc_id for r in made.select("doc_id").collect()} == want, name
        if name != "packing":
            assert made.columns == docs.columns
            if name != "pii":
                assert made.exceptAll(now).count() == 0
            now = made
    assert np.isin([r.doc_id for r in made.collect()], [r.doc_id for r in docs.collect()]).all()


def test_run_equals_stages(spark, sf_dir):
    """run against its stages by brute force: rules and classes by their operators, contamination and redaction in plain Python, ids by the tokenizer."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = materialize(rules.judge(docs).where("quality_rules.kept").select("doc_id", "text"), "test-run")
    ids = {r.class_id for r in near.classes(kept).collect()}
    items = {tuple(w[k : k + 13]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect() if (w := words(r.text)) for k in range(max(1, len(w) - 12))}
    clean = {}
    for r in kept.collect():
        if r.doc_id in ids:
            w = words(r.text)
            hit = {p for size in {len(x) for x in items} for k in range(len(w) - size + 1) if tuple(w[k : k + size]) in items for p in range(k, k + size)}
            if not (hit and 20 * len(hit) >= len(w)):
                clean[r.doc_id] = r.text
    table = materialize(spark.createDataFrame(list(clean.items()), "doc_id long, text string"), "test-run")
    redacted = {r.doc_id: cut_out(clean[r.doc_id], [(s.start, s.end, s.kind) for s in r.pii.all]) for r in pii.find(table).collect()}
    inner, pieces = UnitTokenizer(tokenizer_path()).inner, {}
    for r in corpus_pipeline.run(spark, sf_dir).collect():
        pieces.setdefault(r.doc_id, []).append(r)
    assert set(pieces) == set(clean)
    for i, mine in pieces.items():
        want, at = np.array([*inner.encode(redacted[i], add_special_tokens=False).ids, 1], "<u4"), 0
        for r in sorted(mine, key=lambda r: r.start):
            assert r.start == at and r.ids_crc32 == zlib.crc32(want[at : at + r.length].tobytes())
            at += r.length
        assert at == len(want)


def words(text):
    return WORD.findall(lower(text))


def test_empty_documents(spark, tmp_path, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name in ("documents", "benchmark"):
        spark.read.parquet(f"{sf_dir}/{name}.parquet").limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    nulls = spark.createDataFrame([(None, None, None, None, None)] * 2, docs.schema)
    for _, stage in corpus_pipeline.STAGES:
        stage(spark, nulls.coalesce(1), sf_dir).collect()


def test_near_duplicates_copy_and_shuffle_no_texts(spark, sf_dir, monkeypatch, capsys):
    """The stage tells rows by their places in the files: it writes no texts, its result joins none by a shuffle, and both ways of meeting give the same rows however files are split."""
    docs, split = spark.read.parquet(f"{sf_dir}/documents.parquet"), "spark.sql.files.maxPartitionBytes"
    docs = materialize(docs.withColumn("_metadata", F.lit("own")).repartition(6, "doc_id"), "test-stored")
    want = sorted(map(repr, near.keep_one(docs).collect()))
    assert 0 < len(want) < docs.count()
    written, made = [], near.materialize
    monkeypatch.setattr(near, "materialize", lambda df, label: written.append(df.columns) or made(df, label))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for words, size in ((near.SENT_WORDS, "128m"), (0, "64k")):
            monkeypatch.setattr(near, "SENT_WORDS", words)
            spark.conf.set(split, size)
            got = corpus_pipeline.near_duplicates(spark, docs, sf_dir)
            spark.conf.set(split, "32k")
            assert sorted(map(repr, got.collect())) == want
            capsys.readouterr()
            got.explain()
            assert ("hashpartitioning" in capsys.readouterr().out) == (words == 0)
    finally:
        spark.conf.unset(split)
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert written and not any("text" in c for c in written)


def test_row_numbers_of_any_size(spark):
    rows = [0, 1, 62, 63, 64, 127, (1 << 33) + 63, (5 << 40) + 31, (1 << 62) + 32]
    docs = spark.createDataFrame([(x, str(x)) for x in rows], "n long, text string").coalesce(2)
    for some in (rows[::2], rows, []):
        wanted = spark.createDataFrame([(x,) for x in some], "row long")
        assert {r.n for r in near._marked(docs, "n", wanted, True).collect()} == set(some)
        assert {r.n for r in near._marked(docs, "n", wanted, False).collect()} == set(rows) - set(some)
