"""Line deduplication over a whole corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.text import bind, line_hash, terminated_lines


def _hashed_lines(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    lines = docs.select(doc_id, F.posexplode(terminated_lines(F.col(text))).alias("pos", "line"))
    return lines.select(doc_id, "pos", F.unhex(line_hash(F.col("line"))).alias("line_hash"))


def line_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """How often each line occurs, repeats within a document included."""
    counts = _hashed_lines(docs, doc_id, text).groupBy("line_hash").agg(F.count("*").alias("n"))
    return counts.select(F.lower(F.hex("line_hash")).alias("line_hash"), "n")


def exact_line_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Drop every line that occurs more than once in the corpus, all copies of it.

    The only occurrence of a line that is kept has the smallest document and position of
    its hash, so the count's own aggregation names the survivors: no line is joined back
    to its count, and a line that fills a third of the corpus is combined before it is
    shuffled. Documents that lose every line stay, empty.
    """
    once = (
        _hashed_lines(docs, doc_id, text)
        .groupBy("line_hash")
        .agg(F.count("*").alias("n"), F.min(doc_id).alias(doc_id), F.min("pos").alias("pos"))
        .where("n = 1")
    )
    kept = once.groupBy(doc_id).agg(F.sort_array(F.collect_list("pos")).alias("_kept"))
    joined = bind(docs.join(kept, doc_id, "left"), _lines=terminated_lines(F.col(text)))
    survivors = F.transform("_kept", lambda pos: F.get("_lines", pos))
    rebuilt = F.coalesce(F.array_join(survivors, ""), F.lit(""))
    return joined.withColumn(text, rebuilt).select(*docs.columns)
