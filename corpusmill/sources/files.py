"""Text files in, text files and tables out."""

from __future__ import annotations

from fnmatch import translate

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.operators.ranks import running_offsets
from corpusmill.sources.listing import list_tree, read_contents

# Fixed value: the line that ends a document in a corpus file.
END_OF_TEXT = "<|endoftext|>"


def read_table(spark: SparkSession, folder: str, name: str, key: str | None = None) -> DataFrame:
    """A Parquet table. One in fewer pieces than there are cores is spread over them by
    ``key``; a large one is read as it lies."""
    table = spark.read.parquet(f"{folder}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    if key and table.rdd.getNumPartitions() < cores:
        return table.repartition(cores, key)
    return table


def scan_documents(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """One file is one document: ``path, file_name, text``. Every kind of line end is
    read as ``\\n``; empty files are empty documents. Files are listed and read by tasks."""
    listed = list_tree(spark, folder, hidden=False)
    name = F.regexp_extract("path", "[^/]*$", 0)
    wanted = listed.where(name.rlike(f"(?s){translate(pattern)}"))
    uri = F.when(F.contains("path", F.lit("://")), F.col("path")).otherwise(F.concat(F.lit("file://"), F.col("path")))
    text = F.regexp_replace(F.col("content").cast("string"), "\r\n?", "\n")
    return read_contents(wanted).select(uri.alias("path"), name.alias("file_name"), text.alias("text"))


def scan_url_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of a text file, gzip or not, stripped: ``line_no, url``. Line numbers are
    unique, not dense."""
    lines = spark.read.text(path)
    stripped = F.regexp_replace("value", r"^[\s\p{Z}]+|[\s\p{Z}]+$", "")
    return lines.select(F.monotonically_increasing_id().alias("line_no"), stripped.alias("url"))


def shard_files(files: DataFrame, start: int, num_files: int, path: str = "path") -> DataFrame:
    """Files ``[start, start + num_files)`` of the list sorted by path: ``path, position``."""
    named = files.select(path).distinct().withColumn("_one", F.lit(1))
    placed = running_offsets(named, path, "_one", "position")
    return placed.where(F.col("position").between(start, start + num_files - 1))


def corpus_record(text: Column) -> Column:
    """A document as it stands in a corpus file, without the last line end."""
    return F.concat(text, F.lit(f"\n{END_OF_TEXT}"))


def sink_corpus(docs: DataFrame, folder: str, text: str = "text") -> None:
    """Append documents to a corpus, in no fixed order; the writer adds the line end."""
    docs.select(corpus_record(F.col(text))).write.mode("append").text(folder)


def read_corpus(spark: SparkSession, folder: str) -> DataFrame:
    """The documents of a corpus folder: ``text``."""
    lines = spark.read.text(folder, lineSep=f"\n{END_OF_TEXT}\n")
    return lines.select(F.col("value").alias("text"))


def sink_documents(docs: DataFrame, folder: str) -> None:
    """Write whole documents under their own id or name; empty ones are written too."""
    docs.write.mode("overwrite").parquet(folder)


def labelled_line(label: Column, text: Column) -> Column:
    return F.concat_ws(" ", label, text)


def sink_labelled_lines(examples: DataFrame, folder: str, label: str = "label", text: str = "text") -> None:
    """Append ``label text`` lines."""
    examples.select(labelled_line(F.col(label), F.col(text))).write.mode("append").text(folder)


def read_labelled_lines(spark: SparkSession, folder: str) -> DataFrame:
    """``label, text`` of labelled lines."""
    parts = F.split("value", " ", 2)
    return spark.read.text(folder).select(parts[0].alias("label"), F.coalesce(F.get(parts, 1), F.lit("")).alias("text"))


def sink_tokens(encoded: DataFrame, folder: str, tokens: str = "tokens") -> DataFrame:
    """Write token ids in place of what the folder holds, and return a one-row table with their
    number. Ids have 16 bits."""
    fits = F.forall(tokens, lambda t: t.between(0, 65535))
    checked = encoded.withColumn(
        tokens, F.when(fits, F.col(tokens)).otherwise(F.raise_error(F.lit("token id over 16 bits")))
    )
    checked.write.mode("overwrite").parquet(folder)
    written = encoded.sparkSession.read.schema(encoded.schema).parquet(folder)
    return written.agg(F.coalesce(F.sum(F.size(tokens)), F.lit(0)).cast("bigint").alias("total_tokens"))
