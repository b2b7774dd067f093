"""Masking of e-mail addresses, IP addresses and phone numbers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.text import bind

# Masks and patterns.
EMAIL_MASK = "|||EMAIL_ADDRESS|||"
PHONE_MASK = "|||PHONE_NUMBER|||"
IP_MASK = "|||IP_ADDRESS|||"

# ``(?<!local)|\G`` lets a match start only where a run of local-part characters starts
# or where the last match ended. Those are the only places where a leftmost match can
# start, and without it a long run that has no @ is scanned again from each character.
_LOCAL = "[a-zA-Z0-9._%+-]"
EMAIL = rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[a-zA-Z0-9.-]+\.[a-zA-Z]{{2,}}"
# \p{Nd} is the decimal digit of any script; the look-arounds of IP are a Unicode \b.
# The leading look-aheads only reject quickly where no match can start.
IP = r"(?=\p{Nd})(?<![\p{L}\p{N}_])(?:\p{Nd}{1,3}\.){3}\p{Nd}{1,3}(?![\p{L}\p{N}_])"
PHONE = (
    r"(?=[+(\p{Nd}])(?<!\p{Nd})(?:\+?\p{Nd}{1,3}[- ]?)?\(?\p{Nd}{3}\)?[- ]?\p{Nd}{3}[- ]?\p{Nd}{4}(?!\p{Nd})"
)


def _replace(text: Column, pattern: str, mask: str, needs: str | None) -> Column:
    replaced = F.regexp_replace(text, pattern, mask)
    return F.when(F.contains(text, F.lit(needs)), replaced).otherwise(text) if needs else replaced


def _count(text: Column, pattern: str, needs: str | None) -> Column:
    n = F.regexp_count(text, F.lit(pattern)).cast("bigint")
    return F.when(F.contains(text, F.lit(needs)), n).otherwise(F.lit(0).cast("bigint")) if needs else n


def mask_emails(text: Column) -> tuple[Column, Column]:
    """The masked text and the number of masks set by this call."""
    return _replace(text, EMAIL, EMAIL_MASK, "@"), _count(text, EMAIL, "@")


def mask_phones(text: Column) -> tuple[Column, Column]:
    return _replace(text, PHONE, PHONE_MASK, None), _count(text, PHONE, None)


def mask_ips(text: Column) -> tuple[Column, Column]:
    return _replace(text, IP, IP_MASK, "."), _count(text, IP, ".")


Masker = Callable[[Column], tuple[Column, Column]]


def with_mask(df: DataFrame, masker: Masker, text: str = "text", n: str = "n") -> DataFrame:
    """Replace ``text`` by its masked form and add the count ``n``."""
    masked, count = masker(F.col(text))
    bound = bind(df, _masked=masked, _n=count)
    others = [c for c in df.columns if c != text]
    return bound.select(*others, F.col("_masked").alias(text), F.col("_n").alias(n))


def mask_pii(df: DataFrame, text: str = "text", n: str = "n_pii") -> DataFrame:
    """E-mail, then IP, then phone, each on the output of the one before."""
    out = with_mask(df, mask_emails, text, "_n_emails")
    out = with_mask(out, mask_ips, text, "_n_ips")
    out = with_mask(out, mask_phones, text, "_n_phones")
    total = F.col("_n_emails") + F.col("_n_ips") + F.col("_n_phones")
    return out.withColumn(n, total).drop("_n_emails", "_n_ips", "_n_phones")


def pii_limit(df: DataFrame, limit: int = 50, text: str = "text", n: str = "n_pii") -> DataFrame:
    """Mask, then drop documents that held more than ``limit`` addresses and numbers."""
    return mask_pii(df, text, n).where(F.col(n) <= limit)
