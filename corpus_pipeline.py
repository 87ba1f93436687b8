"""Documents to training sequences: quality rules, near-duplicates, benchmark passages, personal data, packing.

Each stage takes (spark, docs, sf_dir), docs being a stored table, and all but the last return the columns of docs. All of them pass other columns
through whatever their names, handle repeated rows as each stage says, and make an empty table of an empty one.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from narrative_spark.llm import decontaminate, near, packing, pii, rules
from narrative_spark.llm.common import drop, scratch, shared_dir, table, unused
from narrative_spark.llm.tokens import tokenizer_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the fitted rules keep, as they were.

    Null and empty texts have no words and go; very long texts are judged whole; a document just at the limit stays; repeated rows stay or go together.
    """
    name = unused(docs.columns, "pipeline__rules")
    return rules.judge(docs, result=name).where(f"{name}.kept").drop(name)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates, as it was: the one with the least id.

    Null texts and texts without words are no copies of anything and stay; very long texts are compared whole; of rows with one id, or without any, the
    first in the table stays; null ids come last.
    """
    return near.keep_one(docs, stored=True)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the benchmark contaminates go; the others stay as they are.

    Null and empty texts stay; very long texts are searched whole; a document with just a twentieth of its words hit goes; repeated rows stay or go
    together; without a benchmark all stay.
    """
    name = unused(docs.columns, "pipeline__overlap")
    found = decontaminate.find_overlaps(docs, table(spark, sf_dir, "benchmark"), result=name)
    return found.where(~decontaminate.verdict(name)["contaminated"]).drop(name)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind; n_chars follows the text. No document goes.

    Null texts stay null, with a null n_chars; very long texts and lists of spans are handled whole; of overlapping spans the first gives the kind;
    repeated rows are changed alike.
    """
    clean = pii.redact(docs)
    return clean.select(*[F.length("text").cast("long").alias(c) if c == "n_chars" else clean[c] for c in docs.columns])


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed windows.

    Null and empty texts have the end id alone; very long texts fill windows of their own; repeated rows are packed each for itself; null ids stay null.
    """
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("pii", personal_data),
    ("packing", packed),
]
#: The last stage returns ids of a tokenizer, which SQL can't make.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each is written to the shared folder and read again, and what it wrote on its way is deleted."""
    docs, before = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES[:-1]:
        with scratch(spark):
            made = stage(spark, docs, sf_dir)
            path = f"{shared_dir(spark)}/stage-{name}-{uuid.uuid4().hex}"
            made.write.parquet(path)
        docs = spark.read.schema(made.schema).parquet(path)
        drop(spark, before)
        before = [path]
    return STAGES[-1][1](spark, docs, sf_dir)
