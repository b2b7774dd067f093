"""From documents to packed training sequences: five stages, each written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm.common import table
from corpusmill.llm.decontaminate import find_leaks
from corpusmill.llm.lines import dedup_lines
from corpusmill.llm.ngramjoin import linked_documents
from corpusmill.llm.packing import pack_documents
from corpusmill.llm.rules import judge, labelled_statistics, learn_rules
from corpusmill.session import materialize


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule or the learned decision list rejects go."""
    rules = learn_rules(labelled_statistics(docs, table(spark, sf_dir, "labels")))
    return judge(docs, rules).where("kept").select("row.*")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that several documents hold stay in the first of them; ``n_chars`` follows the text."""
    done = dedup_lines(docs)
    changed = {"text": F.col("kept"), "n_chars": F.length("kept").cast("bigint")}
    return done.select(*[changed.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest id stays. Rows without an id stay."""
    losers = linked_documents(docs).where("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(losers, "doc_id", "left_anti").select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go. Rows without an id stay."""
    leaks = find_leaks(docs, table(spark, sf_dir, "benchmark")).select("doc_id").distinct()
    return docs.join(leaks, "doc_id", "left_anti").select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in the sequences."""
    return pack_documents(docs).drop("ids")


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("best-fit packing", packing),
]

#: The first stage is learned, the fourth samples hash tables, the last needs a tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's result is a table in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
