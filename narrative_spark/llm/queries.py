"""The registered queries of this package: each operator over its whole table, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from narrative_spark.llm import decontaminate, filteraudit, html, merkle, near, oracles, packing, pii, quality, rules, secrets, separators, simhash, spans, whitening
from narrative_spark.llm.common import table
from narrative_spark.llm.tokens import tokenizer_path

#: <|endoftext|> of the word BPE.
SEPARATOR = 49407


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, counted in flat files of 16-bit ids that are made of all documents."""
    return separators.count_tokens(table(spark, sf_dir, "documents"), tokenizer_path(), SEPARATOR)


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document; a document counts as a repository, its source as the owner."""
    found = secrets.find(table(spark, sf_dir, "documents"), owner_col="source", repo_col="doc_id", keep=["doc_id"])
    base = F.filter("secrets", lambda s: s["kind"].isin(*secrets.BASE))
    many = lambda c: F.size(c).cast("long")
    counts = [many(F.filter(base, _is(kind))).alias(f"n_{kind}") for kind in secrets.BASE]
    return found.select("doc_id", *counts, F.sha2(spans.listed(base), 256).alias("base_sha256"), spans.listed(F.col("secrets")).alias("spans"), many(F.filter("secrets", lambda s: s["live"])).alias("n_live"))


def _is(kind: str):
    return lambda s: s["kind"] == kind


def op3_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    found = html.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.select("page_id", "url", F.col("main_text").alias("text"), F.length("main_text").cast("long").alias("n_chars"), F.col("main_path").alias("path"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document against every benchmark item."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_overlaps(docs, table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", *[c.alias(n) for n, c in decontaminate.verdict().items()])


def op5_quality_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document scored for quality."""
    return quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document judged by the fitted rules."""
    return rules.judge(table(spark, sf_dir, "documents"), keep=["doc_id"]).select("doc_id", "quality_rules.*").drop("good")


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of near-duplicates of every document."""
    return near.classes(table(spark, sf_dir, "documents")).select(F.col("id").alias("doc_id"), "class_id", "n_links")


def op8_merkle_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages as an archive against a replica in which some records rotted and some are gone."""
    pages = table(spark, sf_dir, "pages").select("page_id", "html")
    rotted = F.when(F.col("page_id") % 97 == 13, F.concat(F.lit("~"), F.substring("html", 2, 1 << 30))).otherwise(F.col("html"))
    replica = pages.where(F.coalesce(F.col("page_id") % 101 != 50, F.lit(True))).withColumn("html", rotted)
    return merkle.audit(pages, replica, "page_id", "html").withColumnRenamed("key", "page_id")


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    found = pii.find(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return found.select("doc_id", *[c.alias(n) for n, c in pii.counts().items()], F.sha2(spans.listed(F.col("pii.base")), 256).alias("base_sha256"), spans.listed(F.col("pii.all")).alias("spans"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document packed into windows of 2048 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every usable vector along the first four components of all of them."""
    found, model = whitening.whiten(table(spark, sf_dir, "embeddings"), most=4)
    shares = [float(v) for v in model.explained()[:4]] if model else []
    entry = F.posexplode("whitened").alias("k", "whitened")
    n, error = (model.n, model.error) if model else (0, 0.0)
    explained = F.element_at(F.array(*[F.lit(v) for v in shares]).cast("array<double>"), F.col("component"))
    rows = found.select("vec_id", "deviation", entry).withColumn("component", F.col("k") + 1)
    return rows.select("vec_id", "component", F.lit(n).cast("long").alias("n"), "deviation", "whitened", explained.alias("explained"), F.lit(error).alias("identity_error"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five filters over every document, in all orders."""
    labels = table(spark, sf_dir, "labels")
    return filteraudit.audit(table(spark, sf_dir, "documents"), labels.where("quality = 1").select("doc_id"), labels.where("toxic = 1").select("doc_id"))


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = simhash.components_of(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), simhash.hexadecimal().alias("fingerprint"), "component_id")


QUERIES = {
    "op1_token_counts": op1_token_counts,
    "op2_secret_scan": op2_secret_scan,
    "op3_main_text": op3_main_text,
    "op4_decontamination": op4_decontamination,
    "op5_quality_score": op5_quality_score,
    "op6_quality_rules": op6_quality_rules,
    "op7_near_duplicates": op7_near_duplicates,
    "op8_merkle_audit": op8_merkle_audit,
    "op9_pii": op9_pii,
    "op10_packing": op10_packing,
    "op11_whitening": op11_whitening,
    "op12_filter_audit": op12_filter_audit,
    "op13_simhash": op13_simhash,
}
ORACLE_SQL = oracles.ORACLE_SQL
