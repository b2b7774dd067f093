"""Whole jobs from files to files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.api import extract_text_from_html_bytes
from corpusmill.functions.quality import gopher_filter
from corpusmill.operators import classify, sampling, tokens
from corpusmill.operators.ranks import running_offsets
from corpusmill.plans import curate
from corpusmill.session import materialize
from corpusmill.sources import archives, files

POSITIVE, NEGATIVE = "__label__wiki", "__label__cc"


def crawl_documents(spark: SparkSession, folder: str, suffix: str = archives.ARCHIVE_SUFFIX, **slice_: int) -> DataFrame:
    """``file, record_no, url, text`` of the pages of a folder of archives."""
    records = archives.scan_records(spark, folder, suffix, **slice_)
    return extract_text_from_html_bytes(records.select("file", "record_no", "url", "content"))


def curate_crawl(
    spark: SparkSession,
    folder: str,
    corpus: str,
    quality_model: str,
    language_model: str,
    toxicity_model: str,
    first: int = 0,
    count: int | None = None,
) -> DataFrame:
    """Curate a slice of the archives, append the kept text to ``corpus`` and return the
    funnel per archive. Pages are judged once; corpus and funnel read the result."""
    models = [classify.load_model(path) for path in (quality_model, language_model, toxicity_model)]
    judged = curate.judge(crawl_documents(spark, folder, first=first, count=count), *models)
    judged = judged.select("file", "reason", F.when(F.col("reason").isNull(), F.col("text")).alias("text"))
    judged = materialize(judged, "judged")
    files.sink_corpus(judged.where("reason is null"), corpus)
    return curate.funnel(judged, "file")


def choose_urls(spark: SparkSession, lines: str, folder: str, samples: int, num_files: int = 1, seed: int = 0) -> None:
    """Draw URLs and write them in even parts: ``folder/part=0`` and so on."""
    urls = files.scan_url_lines(spark, lines)
    size = min(samples, urls.count())
    drawn = sampling.sample_k(urls, samples, "line_no", seed)
    parts = sampling.split_even(drawn, size, num_files)
    parts.select("part", "url").repartition("part").write.partitionBy("part").mode("overwrite").text(folder)


def page_documents(spark: SparkSession, archives_: DataFrame) -> DataFrame:
    """``doc_id, path, text`` of the pages of listed archives."""
    pages = extract_text_from_html_bytes(archives.read_archives(archives_).select("file", "record_no", "content"))
    key = F.concat_ws(":", "file", F.col("record_no").cast("string"))
    return pages.select(key.alias("doc_id"), F.col("file").alias("path"), "text")


def documents_from_archives(
    spark: SparkSession,
    archives_: DataFrame,
    language_model: str | None = None,
    max_len: int | None = None,
    quality_filter: bool = False,
    seed: int | None = None,
) -> DataFrame:
    """``doc_id, path, text`` of the pages of listed archives, with ``quality_filter`` those that pass the
    length and symbol rules and are English. With ``max_len`` archives are read in order of their
    path (with ``seed``, in random order) until there are so many; later ones are not opened."""
    model = classify.load_model(language_model) if quality_filter else None

    def accept(part: DataFrame) -> DataFrame:
        docs = page_documents(spark, part.select("path", "n_bytes"))
        if model is None:
            return docs
        kept = classify.score(gopher_filter(docs), model, "language").where("language = 'en'")
        return kept.select("doc_id", "path", "text")

    if not max_len:
        return materialize(accept(archives_), "pages")
    if seed is None:
        order = running_offsets(archives_.withColumn("_one", F.lit(1)), "path", "_one", "position")
        order = order.withColumn("position", F.col("position") + 1)
    else:
        order = sampling.random_file_order(archives_, seed=seed)
    listed = archives_.join(order, "path")
    return sampling.first_accepted(listed, accept, max_len, ["doc_id"]).drop("position")


def create_dataset(
    spark: SparkSession,
    positive_folder: str,
    negative_folder: str,
    lines: str,
    language_model: str,
    valid: str | None = None,
    seed: int = 0,
) -> None:
    """Labelled lines of the good pages of two folders of archives, as many negatives as
    positives; with ``valid``, a quarter of them goes there. The negatives' archives are read in
    random order, and no more of them than it takes."""
    good = documents_from_archives(spark, archives.scan_archives(spark, positive_folder, ".gz"), language_model, quality_filter=True)
    wanted, listed = good.count(), archives.scan_archives(spark, negative_folder, ".gz")
    bad = documents_from_archives(spark, listed, language_model, wanted, True, seed) if wanted else good
    examples = sampling.balanced_training_set(good, bad, POSITIVE, NEGATIVE, seed)
    if valid:
        part = sampling.train_or_valid("doc_id", seed)
        files.sink_labelled_lines(examples.where(part == "valid"), valid)
        examples = examples.where(part == "train")
    files.sink_labelled_lines(examples, lines)


def shuffle_dataset(spark: SparkSession, lines: str, folder: str, seed: int = 0) -> None:
    """Write the lines of both classes in turn, sorted by position."""
    read = spark.read.text(lines).select(F.monotonically_increasing_id().alias("line_no"), F.col("value").alias("line"))
    turns = sampling.interleave_classes(materialize(read, "lines"), NEGATIVE, POSITIVE, "line_no", seed=seed)
    turns.orderBy("position").select("line").write.mode("overwrite").text(folder)


def train_model(spark: SparkSession, lines: str, valid: str, model: str) -> DataFrame:
    """Train on labelled lines, save, and return the figures on the validation lines."""

    def examples(path: str) -> DataFrame:
        read = files.read_labelled_lines(spark, path)
        return read.withColumn("label", F.regexp_replace("label", "^__label__", ""))

    fitted = classify.train_classifier(examples(lines))
    classify.save_model(fitted, model)
    return classify.evaluate_classifier(classify.score(examples(valid), fitted, "prediction"))


def tokenize_corpus(spark: SparkSession, corpus: str, folder: str, vocabulary: int = tokens.VOCABULARY) -> DataFrame:
    """Encode a corpus folder with its own vocabulary; return the number of tokens."""
    docs = files.read_corpus(spark, corpus).withColumn("doc_id", F.monotonically_increasing_id())
    vocab = materialize(tokens.build_vocab(docs, vocabulary), "vocabulary")
    return files.sink_tokens(tokens.encode_tokens(docs, vocab), folder)
