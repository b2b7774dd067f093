"""Samples, splits and labelled training sets.

Every random choice is a seeded hash order, so that a lost task draws the same rows again.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.functions.text import flatten_text
from corpusmill.operators.ranks import hash_rank, seeded_hash
from corpusmill.session import materialize


def sample_k(df: DataFrame, k: int, key: str, seed: int = 0, rank: str = "rank") -> DataFrame:
    """A uniform sample of exactly ``k`` rows, or all when there are fewer, with their
    place in the sample. ``key`` must be unique."""
    return hash_rank(df, key, seed, limit=k, rank=rank)


def split_even(sample: DataFrame, size: int, num_files: int, rank: str = "rank") -> DataFrame:
    """Cut a ranked sample of ``size`` rows into ``num_files`` equal parts, numbered from
    0; the remainder is dropped."""
    part = size // num_files
    if part == 0:
        return sample.where(F.lit(False)).withColumn("part", F.lit(0).cast("bigint"))
    numbered = sample.withColumn("part", F.floor((F.col(rank) - 1) / part).cast("bigint"))
    return numbered.where(F.col("part") < num_files)


def sample_records(records: DataFrame, k: int, key: str, content: str = "content", seed: int = 0) -> DataFrame:
    """``k`` records at random, then without the empty ones; an error if there are fewer."""
    found = records.count()
    if found < k:
        raise ValueError(f"{k} records asked for, {found} found")
    return sample_k(records, k, key, seed).where(F.length(content) > 0)


def random_file_order(files: DataFrame, path: str = "path", seed: int = 0) -> DataFrame:
    """``path, position``: the distinct files in random order, from 1."""
    return hash_rank(files.select(path).distinct(), path, seed, rank="position")


def balanced_training_set(
    positives: DataFrame,
    negatives: DataFrame,
    pos_label: str = "__label__wiki",
    neg_label: str = "__label__cc",
    seed: int = 0,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``key, label, text``: all positives and as many negatives, chosen at random, or all
    negatives when there are fewer. Both sides are expected to have passed the filters."""
    wanted = positives.count()
    chosen = hash_rank(negatives, key, seed, limit=wanted)

    def labelled(df: DataFrame, label: str) -> DataFrame:
        return df.select(key, F.lit(label).alias("label"), flatten_text(F.col(text)).alias("text"))

    return labelled(positives, pos_label).unionByName(labelled(chosen, neg_label))


def first_accepted(
    files: DataFrame, accept: Callable[[DataFrame], DataFrame], limit: int, order: list[str], path: str = "path", first: int = 8
) -> DataFrame:
    """The first ``limit`` rows that ``accept`` makes of files, in order of ``files.position`` and
    within a file of the columns ``order``; all if there are fewer. ``accept`` gets the rows of
    ``files`` that it is to read, and keeps the column ``path``.

    Files are read a slice at a time: ``first`` of them, then as many as the rows accepted so far
    let expect to be needed, and at least twice as many as before. The rows accepted from each
    file are counted; a prefix sum over these counts says in which file the limit falls, and only
    that one is cut. Files of later slices are never read.
    """
    files = materialize(files, "files")
    taken, done, have, step = [], 0, 0, first
    total = files.count()
    while done < total and have < limit:
        part = files.where(F.col("position").between(done + 1, done + step))
        rows = materialize(accept(part).join(part.select(path, "position"), path), "accepted")
        counts = rows.groupBy("position").agg(F.count("*").alias("n"))
        before = Window.orderBy("position").rowsBetween(Window.unboundedPreceding, -1)
        # One row per file of the slice.
        counts = counts.withColumn("_before", F.coalesce(F.sum("n").over(before), F.lit(0)))
        counts = materialize(counts, "counts")
        need = limit - have
        whole = counts.where(F.col("_before") + F.col("n") <= need).select("position")
        taken.append(rows.join(whole, "position", "left_semi"))
        cut = counts.where((F.col("_before") < need) & (F.col("_before") + F.col("n") > need)).first()
        if cut:
            # A bounded top of one file's rows.
            last = rows.where(F.col("position") == cut["position"]).orderBy(*order).limit(int(need - cut["_before"]))
            taken.append(last)
        have += min(need, rows.count())
        done += step
        rate = max(have, 1) / done
        step = max(2 * step, math.ceil((limit - have) / rate))
    if not taken:
        return accept(files).where(F.lit(False)).withColumn("position", F.lit(0).cast("bigint"))
    return reduce(DataFrame.unionByName, taken)


def train_or_valid(key: str = "doc_id", seed: int = 0, train_parts: int = 3, parts: int = 4):
    """``train`` for ``train_parts`` of ``parts`` of the keys, ``valid`` for the others."""
    bucket = F.conv(F.substring(seeded_hash(key, seed), 1, 8), 16, 10).cast("bigint") % parts
    return F.when(bucket < train_parts, "train").otherwise("valid")


def interleave_classes(
    lines: DataFrame,
    first: str = "__label__cc",
    second: str = "__label__wiki",
    key: str = "doc_id",
    line: str = "line",
    seed: int = 0,
) -> DataFrame:
    """``position, line``: lines of the two classes in turn, from 0, until the shorter
    class ends. A line belongs to a class if it holds its label anywhere."""
    one, other = (
        hash_rank(lines.where(F.contains(line, F.lit(label))).select(key, line), key, seed, rank="rank")
        for label in (first, second)
    )
    one = one.select("rank", F.col(line).alias("_first"))
    other = other.select("rank", F.col(line).alias("_second"))
    turns = one.join(other, "rank")
    at = (F.col("rank") - 1) * 2
    both = F.array(
        F.struct(at.alias("position"), F.col("_first").alias(line)),
        F.struct((at + 1).alias("position"), F.col("_second").alias(line)),
    )
    return turns.select(F.inline(both))
