"""The curation job and its report.

The rules all look at the unmodified text and form a conjunction, so the kept set does
not depend on their order. ``curate`` takes the rules that need no join and no model
first; the funnel charges a document to the first rule it fails in the order quality,
language, toxicity, symbols and lengths, personal data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.pii import mask_pii, pii_limit
from corpusmill.functions.quality import gopher_filter, gopher_ok, gopher_stats, with_gopher
from corpusmill.functions.text import bind, drop_short_lines
from corpusmill.operators.classify import Model, score
from corpusmill.operators.ranks import running_offsets
from corpusmill.session import materialize

REASONS = ("quality", "language", "toxic", "gopher", "pii")
PII_LIMIT = 50


def _shorten(docs: DataFrame, text: str) -> DataFrame:
    shortened = bind(docs, _short=drop_short_lines(F.col(text)))
    return shortened.drop(text).withColumnRenamed("_short", text).select(*docs.columns)


def finish(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rewriting end of the job: short lines out, personal data masked and limited."""
    return pii_limit(_shorten(docs, text), PII_LIMIT, text).drop("n_pii")


def curate(
    docs: DataFrame,
    verdicts: DataFrame | None = None,
    language: Column | str = "lang",
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Curate documents whose verdicts are at hand: a language column, and a table
    ``doc_id, quality, toxicity`` in which a missing document passes."""
    column = F.col(language) if isinstance(language, str) else language
    kept = gopher_filter(docs.where(column == "en"), text)
    if verdicts is not None:
        bad = verdicts.where("quality <> 'wiki' or toxicity <> 'non-toxic'").select(doc_id)
        kept = kept.join(bad, doc_id, "left_anti")
    return finish(kept, text)


def curate_scored(
    docs: DataFrame,
    quality: Model,
    language: Model,
    toxicity: Model,
    text: str = "text",
) -> DataFrame:
    """Curate with models. Each scores only what the rules before it have left."""
    kept = gopher_filter(docs, text)
    for model, good in ((quality, "wiki"), (language, "en"), (toxicity, "non-toxic")):
        kept = score(kept, model, "_verdict", text=text).where(F.col("_verdict") == good).drop("_verdict")
    return finish(kept, text)


def reject_reason(
    docs: DataFrame,
    verdicts: DataFrame,
    language: str = "lang",
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Add ``reason``, the first rule a document fails, null if it passes them all.

    The rules run in stages: what the verdicts reject is given no text to the length and symbol
    rules, and what those reject none to the masks, whose patterns pass over missing texts.
    """
    known = docs.join(verdicts, doc_id, "left")
    early = (
        F.when(F.col("quality") != "wiki", "quality")
        .when(F.col(language) != "en", "language")
        .when(F.col("toxicity") != "non-toxic", "toxic")
    )
    known = bind(known, _early=early).withColumn(text, F.when(F.col("_early").isNull(), F.col(text)))
    judged = with_gopher(known, text)
    reached = judged.withColumn(text, F.when(F.col("gopher_ok"), F.col(text)))
    masked = mask_pii(_shorten(reached, text), text).drop(text)
    late = F.when(~F.col("gopher_ok"), "gopher").when(F.col("n_pii") > PII_LIMIT, "pii")
    return masked.withColumn("reason", F.coalesce("_early", late)).drop("_early")


def judge(
    docs: DataFrame,
    quality: Model,
    language: Model,
    toxicity: Model,
    text: str = "text",
) -> DataFrame:
    """Finish every document and add the ``reason`` for which it is to be rejected, by
    models. A model is given an empty text for documents that are rejected already."""
    out = docs.withColumn("reason", F.lit(None).cast("string"))
    for model, good, reason in (
        (quality, "wiki", "quality"),
        (language, "en", "language"),
        (toxicity, "non-toxic", "toxic"),
    ):
        asked = out.withColumn("_asked", F.when(F.col("reason").isNull(), F.col(text)).otherwise(""))
        out = score(asked, model, "_verdict", text="_asked").withColumn(
            "reason", F.coalesce("reason", F.when(F.col("_verdict") != good, reason))
        )
        out = out.drop("_asked", "_verdict")
    masked = mask_pii(_shorten(with_gopher(out, text), text), text)
    late = F.when(~F.col("gopher_ok"), "gopher").when(F.col("n_pii") > PII_LIMIT, "pii")
    return masked.withColumn("reason", F.coalesce("reason", late)).drop("gopher_ok", "n_pii")


def funnel(reasons: DataFrame, by: str = "source") -> DataFrame:
    """Per source: total, rejects by rule, passed."""
    rejected = [F.count_if(F.col("reason") == reason).alias(reason) for reason in REASONS]
    return reasons.groupBy(by).agg(
        F.count("*").alias("total"), *rejected, F.count_if(F.col("reason").isNull()).alias("passed")
    )


def curation_funnel(docs: DataFrame, verdicts: DataFrame, by: str = "source", **names: str) -> DataFrame:
    return funnel(reject_reason(docs, verdicts, **names), by)


def english_gopher_docs(
    docs: DataFrame,
    max_len: int | None = None,
    language: str = "lang",
    doc_id: str = "doc_id",
    text: str = "text",
    quality_filter: bool = True,
) -> DataFrame:
    """Documents that pass the symbol and length rules and are English, or all of them without
    ``quality_filter``; at most ``max_len`` in id order, none or 0 means all. Ids must be unique."""
    kept = gopher_filter(docs.where(F.col(language) == "en"), text) if quality_filter else docs
    if not max_len:
        return kept
    kept = materialize(kept, "kept")
    # Ranks within ranges of ids; the rows are not sorted as a whole.
    places = running_offsets(kept.select(doc_id, F.lit(1).alias("_one")), doc_id, "_one", "_place")
    return kept.join(places.where(F.col("_place") < max_len).select(doc_id), doc_id, "left_semi")


def english_gopher_rejects(docs: DataFrame, language: str = "lang", text: str = "text") -> DataFrame:
    """``accepted, rejected`` as one row."""
    good = gopher_stats(docs, text).select((gopher_ok() & (F.col(language) == "en")).alias("ok"))
    return good.agg(F.count_if("ok").alias("accepted"), F.count_if(~F.col("ok")).alias("rejected"))
