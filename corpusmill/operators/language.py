"""Languages by runs of three characters: naive Bayes whose model is a table of counts."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.functions.text import flatten_for_scoring
from corpusmill.operators.batches import few_texts, text_slices
from corpusmill.operators.linear import MOST_LABELS
from corpusmill.session import materialize

# Workers get this code by value: the package need not be installed on them.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Runs in the model; what a logarithm of one is written as.
MOST_GRAMS, UNIT = 1 << 16, 1_000_000
_BITS = 21
# Runs that a task holds before it passes their counts on, about.
_HELD = 1 << 19


def gram_codes(text: str) -> np.ndarray:
    """Every run of three code points as one number."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    return points[:-2] << 2 * _BITS | points[1:-1] << _BITS | points[2:]


def _grams(codes: np.ndarray) -> list[str]:
    points = np.stack([codes >> k * _BITS & (1 << _BITS) - 1 for k in (2, 1, 0)], axis=1).astype(np.uint32)
    runs = points.tobytes().decode("utf-32-le", "surrogatepass")
    return [runs[i : i + 3] for i in range(0, len(runs), 3)]


def _tally(codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct codes with the sums of their counts."""
    order = np.argsort(codes, kind="stable")
    codes = codes[order]
    first = np.flatnonzero(np.diff(codes, prepend=-1))
    return codes[first], np.add.reduceat(counts[order], first) if len(first) else counts[:0]


def count_grams(examples: DataFrame, label: str = "label", text: str = "text") -> DataFrame:
    """``label, gram, n``: how often each run of three characters occurs in a label's texts."""

    def passed_on(found):
        for name, (codes, counts) in found.items():
            columns = [pa.array([name] * len(codes), pa.string()), pa.array(_grams(codes), pa.string()), pa.array(counts)]
            yield pa.RecordBatch.from_arrays(columns, names=["label", "gram", "n"])

    def count(batches):
        found: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for batch in text_slices(batches, 1 << 20):
            new: dict[str, list[np.ndarray]] = {}
            for name, body in zip(batch.column("label").to_pylist(), batch.column("text").to_pylist(), strict=True):
                new.setdefault(name, []).append(gram_codes(body))
            for name, parts in new.items():
                codes = np.sort(np.concatenate(parts))
                first = np.flatnonzero(np.diff(codes, prepend=-1))
                codes, counts = codes[first], np.diff(first, append=len(codes))
                if name in found:
                    codes, counts = (np.concatenate(x) for x in zip(found[name], (codes, counts), strict=True))
                found[name] = _tally(codes, counts)
            if sum(len(codes) for codes, _ in found.values()) > _HELD:
                yield from passed_on(found)
                found = {}
        yield from passed_on(found)

    flat = examples.select(F.col(label).cast("string").alias("label"), flatten_for_scoring(F.col(text)).alias("text"))
    counted = flat.where("label is not null and text is not null").mapInArrow(count, "label string, gram string, n bigint")
    return counted.groupBy("label", "gram").agg(F.sum("n").alias("n"))


@dataclass
class LanguageModel:
    """``table``: ``gram, label, weight``, the logarithm of a run's smoothed share among the
    label's runs, in millionths, so that sums do not depend on their order."""

    table: DataFrame


def train_language(examples: DataFrame, label: str = "label", text: str = "text") -> LanguageModel:
    """Counts of the ``MOST_GRAMS`` most frequent runs in all texts that have a label, one added to
    each. Labels count alike, however many texts they have."""
    counts = materialize(count_grams(examples, label, text), "grams")
    if counts.isEmpty():
        raise ValueError("no labelled texts")
    kept = counts.groupBy("gram").agg(F.sum("n").alias("all")).orderBy(F.desc("all"), "gram").limit(MOST_GRAMS)
    # At most MOST_GRAMS rows of three characters.
    kept = F.broadcast(materialize(kept.select("gram"), "kept-grams"))
    counts = counts.join(kept, "gram")
    totals = counts.groupBy("label").agg(F.sum("n").alias("total")).orderBy("label").limit(MOST_LABELS + 1).collect()
    if len(totals) > MOST_LABELS:
        raise ValueError(f"more than {MOST_LABELS} labels")
    size = kept.count()
    each = F.array(*[F.struct(F.lit(r.label).alias("label"), F.lit(r.total).alias("total")) for r in totals])
    cells = kept.select("gram", F.inline(each)).join(counts, ["gram", "label"], "left")
    share = (F.coalesce("n", F.lit(0)) + 1) / (F.col("total") + size)
    weight = F.round(F.log(share) * UNIT).cast("bigint").alias("weight")
    return LanguageModel(materialize(cells.select("gram", "label", weight), "language"))


def best_language(text: Column, model: LanguageModel) -> Column:
    """``label, confidence``: the likeliest label of a text without line ends, by the runs that the
    model holds; ties go to the first label.

    The table, at most ``MOST_GRAMS`` runs by ``MOST_LABELS`` labels, goes to all tasks as a sorted
    list of runs; texts stay where they are.
    """
    cells = model.table.toPandas()
    labels = sorted(cells["label"].unique())
    grams = np.unique(np.concatenate([np.zeros(0, np.int64), *[gram_codes(g) for g in cells["gram"].unique()]]))
    weights = np.zeros((len(grams) + 1, len(labels)), np.int64)
    row = np.searchsorted(grams, np.array([gram_codes(g)[0] for g in cells["gram"]], np.int64))
    weights[row, np.searchsorted(labels, cells["label"])] = cells["weight"]
    shared = SparkSession.active().sparkContext.broadcast((labels, grams, weights))

    @F.arrow_udf("label string, confidence double")
    def best(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        names, known, cost = shared.value
        for column in batches:
            found, chance = [], []
            for body in (body for texts in few_texts(column) for body in texts):
                sums = np.zeros(len(names), np.int64)
                codes = gram_codes(body)
                # Some at a time, so a long text takes no more memory.
                for a in range(0, len(codes), 1 << 16):
                    part = codes[a : a + (1 << 16)]
                    at = np.searchsorted(known, part)
                    at[at == len(known)] = 0
                    at = np.where(known[at] == part, at, len(known)) if len(known) else at * 0
                    sums += cost.take(at, axis=0).sum(axis=0)
                k = int(sums.argmax())
                found.append(names[k])
                chance.append(float(1 / np.exp((sums - sums[k]) / UNIT).sum()))
            yield pa.StructArray.from_arrays([pa.array(found, pa.string()), pa.array(chance, pa.float64())], ["label", "confidence"])

    return best(text)
