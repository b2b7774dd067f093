"""The public functions under their usual names, each from DataFrame to DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.functions import pii
from corpusmill.functions.html import decode_bytes, html_to_text
from corpusmill.functions.quality import with_gopher
from corpusmill.operators import classify, lines, minhash


def extract_text_from_html_bytes(pages: DataFrame, content: str = "content", text: str = "text") -> DataFrame:
    """Replace page bytes by their visible text."""
    decoded = pages.withColumn("_html", decode_bytes(F.col(content)))
    return decoded.withColumn(text, html_to_text(F.col("_html"))).drop("_html", content)


def identify_language(docs: DataFrame, model: classify.Model, text: str = "text") -> DataFrame:
    return classify.classify_language(docs, model, text)


def detect_nsfw(docs: DataFrame, model: classify.Model, text: str = "text") -> DataFrame:
    return classify.classify_nsfw(docs, model, text)


def detect_toxic(docs: DataFrame, model: classify.Model, text: str = "text") -> DataFrame:
    return classify.classify_toxic(docs, model, text)


def detect_quality(docs: DataFrame, model: classify.Model, text: str = "text") -> DataFrame:
    return classify.classify_quality(docs, model, text)


def mask_emails(docs: DataFrame, text: str = "text", n: str = "n") -> DataFrame:
    return pii.with_mask(docs, pii.mask_emails, text, n)


def mask_phone_numbers(docs: DataFrame, text: str = "text", n: str = "n") -> DataFrame:
    return pii.with_mask(docs, pii.mask_phones, text, n)


def mask_ip_addresses(docs: DataFrame, text: str = "text", n: str = "n") -> DataFrame:
    return pii.with_mask(docs, pii.mask_ips, text, n)


def is_gopher_quality(docs: DataFrame, text: str = "text", ok: str = "gopher_ok") -> DataFrame:
    return with_gopher(docs, text, ok)


def exact_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    return lines.exact_line_dedup(docs, doc_id, text)


def minhash_dedup(
    docs: DataFrame,
    num_hashes: int,
    num_bands: int,
    ngrams: int,
    jaccard_threshold: float,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    return minhash.fuzzy_dedup(
        docs, num_hashes, num_bands, ngrams, jaccard_threshold, doc_id=doc_id, text=text
    )
