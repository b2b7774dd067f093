"""Text as columns: normalisation, words, lines, n-grams.

Java's ``\\w``, ``\\d`` and ``\\s`` are ASCII only, so every class is spelled out
with Unicode categories. Group repetitions are possessive: a greedy one recurses
once per repetition in Java and overflows the stack on long runs such as ``a.a.a…``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What a regular expression over Unicode text counts as white space and as a line break,
# and white space within a line. ASCII members come first: Java tests them fastest.
SPACE = r" \n\s\x0b\x1c-\x1f\x85\p{Z}"
LINE_BREAK = r"\n\r\x0b\x0c\x1c-\x1e\x85\x{2028}\x{2029}"
BLANK = r" \t\x1f\p{Zs}"

# A word is letters, marks, digits and underscore, joined by single inner . ' ’ or -.
WORD = r"a-zA-Z0-9_\p{L}\p{M}\p{N}"
TOKEN = rf"[{WORD}]++(?:[.'’-][{WORD}]++)*+|\.{{2,}}+|[^{WORD}{SPACE}]"
# From the first letter of a word to its end: one match per word that has a letter.
ALPHABETIC_TOKEN = rf"[a-zA-Z\p{{L}}][{WORD}]*+(?:[.'’-][{WORD}]++)*+"
# The start of a line that has something other than white space.
LINE_START = rf"(?:\A|[{LINE_BREAK}])[{BLANK}]*+[^{SPACE}]"


def bind(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are computed once per row.

    Catalyst pastes the expression of a plain ``withColumn`` into every later filter
    and projection that names it; a costly pattern would then run several times per
    row. A generator of one row is a fence that filters are not pushed through.
    """
    row = F.struct(*[expr.alias(name) for name, expr in columns.items()])
    return df.select("*", F.inline(F.array(row)))


def word_tokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))


def nonblank_lines(text: Column) -> Column:
    """Lines with something other than white space, trailing blanks kept."""
    pieces = F.split(text, rf"\r\n|[{LINE_BREAK}]")
    return F.filter(pieces, lambda line: line.rlike(rf"[^{SPACE}]"))


def terminated_lines(text: Column) -> Column:
    """Lines with their ``\\n``; no empty line follows a final ``\\n``."""
    return F.filter(F.split(text, r"(?<=\n)"), lambda line: line != "")


def drop_short_lines(text: Column, longer_than: int = 50) -> Column:
    """Keep lines of more than ``longer_than`` characters; may leave an empty text."""
    kept = F.regexp_extract_all(text, F.lit(rf"(?dm)^[^\n]{{{longer_than + 1},}}+"), F.lit(0))
    return F.array_join(kept, "\n")


def flatten_text(text: Column) -> Column:
    """One line for a training file: ``\\n`` becomes a blank, ``\\r`` goes."""
    return F.translate(text, "\n\r", " ")


def flatten_for_scoring(text: Column) -> Column:
    return F.translate(text, "\n", " ")


def normalize_text(text: Column) -> Column:
    """Lower case, no accents, no punctuation, single blanks."""
    # Canonical decomposition (NFD), by a library that ships with Spark. Marks then fall
    # to the same pattern as punctuation: they are neither letters nor digits.
    decomposed = F.reflect(
        F.lit("com.ibm.icu.text.Normalizer"), F.lit("decompose"), F.lower(text), F.lit(False)
    )
    bare = F.regexp_replace(decomposed, rf"[^a-zA-Z0-9\p{{L}}\p{{N}}_{SPACE}]+", "")
    return F.trim(F.regexp_replace(bare, rf"[{SPACE}]+", " "))


def line_hash(line: Column) -> Column:
    return F.md5(line)


def word_ngrams(words: Column, n: int) -> Column:
    """All runs of ``n`` words, joined by a blank; empty when there are fewer."""
    starts = F.when(F.size(words) >= n, F.sequence(F.lit(1), F.size(words) - (n - 1)))
    grams = F.transform(starts, lambda i: F.array_join(F.slice(words, i, n), " "))
    return F.coalesce(grams, F.array().cast("array<string>"))


def explode_ngrams(df: DataFrame, words: str, n: int, gram: str = "gram") -> DataFrame:
    """One row per n-gram of the word list, which is dropped.

    The places are exploded and the words picked up by plain expressions, which stay in
    generated code; building the list of n-grams first takes more than twice as long.
    """
    others = [c for c in df.columns if c != words]
    enough = df.where(F.size(words) >= n)
    places = enough.select("*", F.explode(F.sequence(F.lit(0), F.size(words) - n)).alias("_at"))
    picked = F.concat_ws(" ", *[F.get(words, F.col("_at") + i) for i in range(n)])
    return places.select(*others, picked.alias(gram))
