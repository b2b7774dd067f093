"""The length and symbol rules for documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.text import (
    ALPHABETIC_TOKEN,
    LINE_BREAK,
    LINE_START,
    SPACE,
    TOKEN,
    bind,
)

STATS = ("n_tokens", "mean_token_chars", "ellipsis_share", "alphabetic_share")


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("bigint")


def gopher_stats(df: DataFrame, text: str = "text") -> DataFrame:
    """Add the four statistics of the rules.

    Counts are taken by pattern, without building word or line arrays. Tokens cover
    every character that is not white space, so their total length is the text's
    length without white space.
    """
    body = F.col(text)
    counted = bind(
        df,
        _tokens=_count(body, TOKEN),
        _alphabetic=_count(body, ALPHABETIC_TOKEN),
        _chars=F.length(F.regexp_replace(body, rf"[{SPACE}]+", "")),
        _lines=_count(body, LINE_START),
        _ellipses=_count(body, rf"\.\.\.(?=[{LINE_BREAK}]|\z)"),
    )
    share = {
        "n_tokens": F.col("_tokens"),
        "mean_token_chars": F.coalesce(F.try_divide("_chars", "_tokens"), F.lit(0.0)),
        "ellipsis_share": F.coalesce(F.try_divide("_ellipses", "_lines"), F.lit(1.0)),
        "alphabetic_share": F.coalesce(F.try_divide("_alphabetic", "_tokens"), F.lit(0.0)),
    }
    return counted.select(*df.columns, *[expr.alias(name) for name, expr in share.items()])


def gopher_ok() -> Column:
    """The verdict over the columns of ``gopher_stats``. Bounds on count and mean are
    inclusive, those on the shares are strict."""
    return (
        F.col("n_tokens").between(50, 100_000)
        & F.col("mean_token_chars").between(3, 10)
        & (F.col("ellipsis_share") < 0.3)
        & (F.col("alphabetic_share") > 0.8)
    )


def with_gopher(df: DataFrame, text: str = "text", ok: str = "gopher_ok") -> DataFrame:
    """Add the verdict alone."""
    return gopher_stats(df, text).withColumn(ok, gopher_ok()).drop(*STATS)


def gopher_filter(df: DataFrame, text: str = "text") -> DataFrame:
    return gopher_stats(df, text).where(gopher_ok()).drop(*STATS)
