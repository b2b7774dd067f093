"""A linear classifier over averaged vectors of hashed words and parts of words."""

from __future__ import annotations

import sys
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, groupby, pairwise
from math import isqrt

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.operators.batches import few_texts, text_slices
from corpusmill.operators.ranks import seeded_hash
from corpusmill.session import materialize, release, written

# Workers get this code by value: the package need not be installed on them.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Buckets of words and parts, length of a vector, letters of a part of a word.
BUCKETS, SIZE, PART = 1 << 18, 8, 4
# Rounds of training; texts of a step; texts of a partition, as long as there are few partitions;
# least steps a partition takes in a round; partitions from which on they grow, too.
ROUNDS, STEP, SHARE, LEAST_STEPS, FEW_PARTS = 8, 32, 1000, 64, 16
# Texts of a label at most, for the queries that are to learn from a ``bounded_sample``.
MOST_TEXTS = 20_000
# A bucket is used if so many texts hold it and a label has it more often than the others by so
# many standard deviations.
LEAST_TEXTS, LEAST_DEVIATIONS = 3, 2.0
MOST_LABELS = 64
# Pieces in which parameters travel; texts whose rows are one value, a multiple of those of a step.
PIECES, TEXTS = 32, 8 * STEP
_REMEMBERED = 1 << 16


def _bucket(name: str) -> int:
    return xxhash.xxh3_64_intdigest(name.encode("utf-8", "surrogatepass")) % BUCKETS


class _Parts(dict):
    """Remembers the buckets of parts met; there are far fewer of them than words."""

    def __missing__(self, part: str) -> int:
        if len(self) >= _REMEMBERED:
            self.clear()
        value = self[part] = _bucket(f"\0{part}")
        return value


_PARTS = _Parts()


class _Buckets(dict):
    """Numbers the words met, and remembers their buckets end to end: those of the word itself and of
    its runs of ``PART`` letters."""

    def __init__(self):
        self.pool, self.begin = array("i"), array("q", [0])

    def __missing__(self, word: str) -> int:
        marked = f"<{word}>"
        self.pool.append(_bucket(word))
        self.pool.extend([_PARTS[marked[i : i + PART]] for i in range(len(marked) - PART + 1)])
        self.begin.append(len(self.pool))
        number = self[word] = len(self)
        return number

    def clear(self) -> None:
        super().clear()
        self.__init__()


_MET = _Buckets()


def bucket_lists(texts: list[str], row_of: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The distinct buckets of each text, in order, all end to end, and how many each text has. How
    often one occurs does not count, so a few telling words show in a long text. With ``row_of``,
    a bucket's number there instead; buckets with a negative one are left out."""
    if len(_MET) >= _REMEMBERED:
        _MET.clear()
    words = [[*map(_MET.__getitem__, set(text.split()))] for text in texts]
    counts = np.fromiter(map(len, words), np.int64, len(words))
    word = np.fromiter(chain.from_iterable(words), np.int64, counts.sum())
    pool, begin = np.array(_MET.pool, np.int32), np.array(_MET.begin, np.int64)
    if row_of is not None:
        pool = row_of[pool]
        known = pool >= 0
        begin = np.concatenate([np.zeros(1, np.int64), np.cumsum(known)])[begin]
        pool = pool[known]
    size = np.diff(begin)[word]
    at = np.arange(size.sum()) + np.repeat(begin[word] - np.cumsum(size) + size, size)
    owner = np.repeat(np.repeat(np.arange(len(texts)), counts), size)
    both = np.sort(owner << 32 | pool[at])
    both = both[np.diff(both, prepend=-1) != 0]
    return both & 0xFFFFFFFF, np.bincount(both >> 32, minlength=len(texts))


def bounded_sample(examples: DataFrame, label: str, most: int, key: str | None = None, seed: int = 0) -> DataFrame:
    """Rows with a label, about ``most`` of a label that has more: those of least hash of
    ``key``, else drawn at random. One row per label is collected."""
    counts = examples.where(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("_n")).collect()
    if len(counts) > MOST_LABELS:
        raise ValueError(f"more than {MOST_LABELS} labels")
    draw = F.rand(seed)
    if key:
        draw = F.conv(F.substring(seeded_hash(key, seed), 1, 8), 16, 10).cast("bigint") / F.lit(1 << 32)
    keep = F.lit(False)
    for row in counts:
        keep = F.when(F.col(label) == row[label], (row["_n"] <= most) | (draw < most / row["_n"])).otherwise(keep)
    return examples.where(keep)


@dataclass
class LinearModel:
    """``vectors`` of the used buckets, whose numbers and scales are ``used`` and ``scale``;
    ``weights`` and ``bias`` of the labels."""

    labels: list[str]
    used: np.ndarray
    scale: np.ndarray
    vectors: np.ndarray
    weights: np.ndarray
    bias: np.ndarray

    def rows(self, ids: np.ndarray) -> np.ndarray:
        """The rows of a text's used buckets."""
        at = np.searchsorted(self.used, ids)
        at[at == len(self.used)] = 0
        return at[self.used[at] == ids] if len(self.used) else at[:0]

    def mean(self, ids: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """``spread`` of the buckets of several texts."""
        ids = [self.rows(i) for i in ids]
        return self.spread(np.concatenate([np.zeros(0, np.int64), *ids]), np.fromiter(map(len, ids), np.int64, len(ids)))

    def spread(self, flat: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The rows of several texts end to end, the text of each, its share by its scale, and the
        sums of vectors by share."""
        owner = np.repeat(np.arange(len(counts)), counts)
        scale = self.scale[flat]
        share = scale / np.sqrt(np.bincount(owner, scale**2, len(counts)))[owner].astype(np.float32)
        sums = np.zeros((len(counts), SIZE), np.float32)
        some = counts > 0
        if len(flat):
            begins = (np.cumsum(counts) - counts)[some]
            sums[some] = np.add.reduceat(self.vectors.take(flat, axis=0) * share[:, None], begins, axis=0)
        return flat, owner, share, sums

    def chances(self, sums: np.ndarray) -> np.ndarray:
        logits = sums @ self.weights + self.bias
        odds = np.exp(logits - logits.max(axis=1, keepdims=True))
        return odds / odds.sum(axis=1, keepdims=True)

    def learn(self, ids: list[np.ndarray], truth: np.ndarray, worth: np.ndarray, seen: np.ndarray, rate: float) -> None:
        """One step along the gradient; ``seen`` sums up what each bucket has moved by so far."""
        self.step(self.mean(ids), truth, worth, seen, rate)

    def step(self, spread: tuple[np.ndarray, ...], truth: np.ndarray, worth: np.ndarray, seen: np.ndarray, rate: float) -> None:
        flat, owner, share, sums = spread
        slope = self.chances(sums)
        slope[np.arange(len(truth)), truth] -= 1
        slope = (slope * (worth[truth] / len(truth))[:, None]).astype(np.float32)
        back = slope @ self.weights.T
        self.weights -= rate * sums.T @ slope
        self.bias -= rate * slope.sum(axis=0)
        if not len(flat):
            return
        order = np.argsort(flat, kind="stable")
        rows = flat[order]
        first = np.flatnonzero(np.diff(rows, prepend=-1))
        at = rows[first]
        moves = np.add.reduceat((back.take(owner, axis=0) * share[:, None]).take(order, axis=0), first, axis=0)
        moved = seen.take(at) + (moves * moves).sum(axis=1) / SIZE
        seen[at] = moved
        self.vectors[at] = self.vectors.take(at, axis=0) - moves * (rate / 5 / np.sqrt(moved))[:, None].astype(moves.dtype)


def _row_of(used: np.ndarray) -> np.ndarray:
    """The row of each bucket, -1 for those that are not used."""
    rows = np.full(BUCKETS, -1, np.int32)
    rows[used] = np.arange(len(used))
    return rows


def _steps(flat: np.ndarray, counts: np.ndarray) -> Iterator[tuple[np.ndarray, slice]]:
    """The rows of ``STEP`` texts at a time, and which texts these are."""
    edges = np.concatenate([np.zeros(1, np.int64), np.cumsum(counts)])
    for a in range(0, len(counts), STEP):
        some = slice(a, min(a + STEP, len(counts)))
        yield flat[edges[some.start] : edges[some.stop]], some


_BEST = "label string, confidence double"


def best_label(text: Column, model: LinearModel) -> Column:
    """``label, confidence``: the likeliest label of a text without line ends."""
    context = SparkSession.active().sparkContext
    shared = context.broadcast(model)

    @F.arrow_udf(_BEST)
    def best(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = shared.value
        row_of = _row_of(own.used)
        for column in batches:
            # A few texts at a time: long ones have many buckets.
            rows = [np.zeros((0, len(own.labels)))]
            for texts in few_texts(column):
                flat, counts = bucket_lists(texts, row_of)
                for part, some in _steps(flat, counts):
                    rows.append(own.chances(own.spread(part, counts[some])[3]))
            chance = np.concatenate(rows)
            labels = pa.array(own.labels, pa.string()).take(pa.array(chance.argmax(axis=1)))
            yield pa.StructArray.from_arrays([labels, pa.array(chance.max(axis=1, initial=0).astype(np.float64))], ["label", "confidence"])

    return best(text)


def _pack(model: LinearModel, seen: np.ndarray) -> list[tuple[int, bytes]]:
    """The parameters in pieces; the last holds weights and bias."""
    both = np.concatenate([model.vectors, seen[:, None]], axis=1).astype(np.float32)
    head = np.concatenate([model.weights.ravel(), model.bias]).astype(np.float32)
    return [*((k, part.tobytes()) for k, part in enumerate(np.array_split(both, PIECES))), (PIECES, head.tobytes())]


def _unpack(pieces: dict[int, bytes], like: LinearModel) -> tuple[LinearModel, np.ndarray]:
    both = np.concatenate([np.frombuffer(pieces[k], np.float32).reshape(-1, SIZE + 1) for k in range(PIECES)])
    head = np.frombuffer(pieces[PIECES], np.float32)
    n = len(like.labels)
    weights, bias = head[:-n].reshape(SIZE, n).copy(), head[-n:].copy()
    return LinearModel(like.labels, like.used, like.scale, both[:, :SIZE].copy(), weights, bias), both[:, SIZE].copy()


def train_linear(examples: DataFrame, label: str = "label", text: str = "text", seed: int = 0) -> LinearModel:
    """A model of all texts that have a label.

    The buckets of each text are written once, and then, as rows of the model, those that
    count. In every round the partitions learn by themselves from the same parameters, which are
    then averaged piece by piece; what comes back to the driver is one set of parameters, whatever
    the number of partitions. Partitions have some ``SHARE`` texts; beyond ``FEW_PARTS`` of them both
    their number and their size grow with the root of the texts, so that parameters
    are ever less of what is moved. Every label has the same total worth. A bucket counts by how far
    its share of texts differs between a label and the others, in standard deviations beyond
    ``LEAST_DEVIATIONS``; there are at most ``BUCKETS`` of them.
    """
    spark = examples.sparkSession
    # ``flatten_for_scoring`` only changes white space, which words are cut at.
    known = examples.where(F.col(label).isNotNull()).select(
        F.col(label).cast("string").alias("label"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )

    def prepare(batches):
        for batch in text_slices(batches, 1 << 20):
            ids, each = bucket_lists(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("label"), _lists(ids, each)], names=["label", "ids"])

    ready = known.mapInArrow(prepare, "label string, ids array<int>")
    ready, path = written(ready.withColumn("at", F.xxhash64("label", "ids")), "buckets")
    counts = {r.label: r.n for r in ready.groupBy("label").agg(F.count("*").alias("n")).limit(MOST_LABELS + 1).collect()}
    if len(counts) > MOST_LABELS:
        raise ValueError(f"more than {MOST_LABELS} labels")
    labels, total = sorted(counts), sum(counts.values())
    if not labels:
        raise ValueError("no labelled texts")
    worth = np.array([total / (len(labels) * counts[name]) for name in labels])
    used = _telling(ready, counts)
    numbers = used["id"].to_numpy(np.int64)
    shared = spark.sparkContext.broadcast(_row_of(numbers))

    def choose(batches):
        for batch in (b.slice(a, TEXTS) for b in batches for a in range(0, b.num_rows, TEXTS)):
            ids = batch.column("ids")
            rows, each = shared.value[ids.flatten().to_numpy()], np.asarray(pc.list_value_length(ids), np.int64)
            kept = np.concatenate([np.zeros(1, np.int64), np.cumsum(rows >= 0)])
            each = np.diff(kept[np.concatenate([np.zeros(1, np.int64), np.cumsum(each)])])
            yield pa.RecordBatch.from_arrays([batch.column("part"), batch.column("label"), batch.column("at"), _lists(rows[rows >= 0], each)], names=["part", "label", "at", "ids"])

    def pack(batches):
        for batch in batches:
            part = batch.column("part").to_numpy()
            for a, b in pairwise([0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(part)]):
                for some in (batch.slice(c, min(TEXTS, b - c)) for c in range(a, b, TEXTS)):
                    ids = some.column("ids")
                    columns = [some.column("label"), pc.list_value_length(ids)]
                    columns = [some.column("part").slice(0, 1), *(pa.ListArray.from_arrays([0, len(c)], c) for c in columns)]
                    # As bytes: Spark's reader holds several numbers for each of a list.
                    columns.append(pa.array([ids.flatten().to_numpy().tobytes()]))
                    yield pa.RecordBatch.from_arrays(columns, names=["part", "labels", "counts", "rows"])

    parts = max(1, total // SHARE)
    parts = min(parts, isqrt(FEW_PARTS * parts))
    dealt = ready.withColumn("part", F.pmod("at", F.lit(parts)))
    chosen = dealt.mapInArrow(choose, "part bigint, label string, at bigint, ids array<int>").repartition(parts, "part")
    # The texts of a partition stay together in a file, in order, so that no round has to move them.
    chosen = chosen.sortWithinPartitions("part", "at")
    chosen = chosen.mapInArrow(pack, "part bigint, labels array<string>, counts array<int>, rows binary")
    chosen = materialize(chosen, "chosen-buckets")
    release(spark, path)
    shared.destroy()
    rng = np.random.default_rng(seed)
    start = rng.uniform(-1 / SIZE, 1 / SIZE, (len(used), SIZE)).astype(np.float32)
    none = np.zeros((SIZE + 1, len(labels)), np.float32)
    model = LinearModel(labels, numbers, used["scale"].to_numpy(np.float32), start, none[:SIZE], none[SIZE])
    seen = np.full(len(used), 1e-6, np.float32)
    for turn in range(ROUNDS):
        shared = spark.sparkContext.broadcast((model, seen))
        model, seen = _round(chosen, shared, worth, 0.5 * (1 - turn / ROUNDS))
        shared.destroy()
        # Spark removes the shuffle files of a round once the JVM has collected what refers to them.
        spark.sparkContext._jvm.System.gc()
    return model


def _lists(flat: np.ndarray, counts: np.ndarray) -> pa.ListArray:
    ends = np.cumsum(counts).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(np.concatenate([np.zeros(1, np.int32), ends])), pa.array(flat.astype(np.int32)))


def _telling(ready: DataFrame, counts: dict[str, int]) -> pd.DataFrame:
    """``id, scale`` of the buckets that the labels differ in, by number."""
    total = sum(counts.values())
    held = ready.select("label", F.explode("ids").alias("id")).groupBy("id")
    held = held.agg(F.count("*").alias("n"), *[F.count_if(F.col("label") == c).alias(f"n{k}") for k, c in enumerate(counts)])
    common = (F.col("n") + 1) / F.lit(total + 2)
    far = [F.lit(0.0)]
    for k, own in enumerate(counts.values()):
        others = total - own
        if others:
            gap = F.abs(F.col(f"n{k}") / own - (F.col("n") - F.col(f"n{k}")) / others)
            far.append(gap / F.sqrt(common * (1 - common) * (1 / own + 1 / others)))
    scale = F.greatest(*far, F.lit(0.0)) - LEAST_DEVIATIONS
    found = held.where((F.col("n") >= LEAST_TEXTS) & (scale > 0)).select("id", scale.cast("float").alias("scale"))
    return found.toPandas().sort_values("id")


def _round(chosen: DataFrame, shared, worth: np.ndarray, rate: float) -> tuple[LinearModel, np.ndarray]:
    """All partitions learn, their parameters are averaged."""

    def learn(batches):
        values = ([c[k] for c in b.columns] for b in batches for k in range(b.num_rows))
        for _, own in groupby(values, lambda row: row[0].as_py()):
            model, seen = shared.value
            model, seen = _unpack(dict(_pack(model, seen)), model)
            number = {name: k for k, name in enumerate(model.labels)}

            def go_through(truth, counts, flat, model=model, seen=seen):
                for part, some in _steps(flat, counts):
                    model.step(model.spread(part, counts[some]), truth[some], worth, seen, rate)

            held, texts = [], 0
            for _, labels, counts, flat in own:
                truth = np.array([number[name] for name in labels.values.to_pylist()])
                held.append((truth, counts.values.to_numpy().astype(np.int64), np.frombuffer(flat.as_py(), np.int32)))
                texts += len(truth)
                if 2 * texts > LEAST_STEPS * STEP:
                    for some in held:
                        go_through(*some)
                    held = []
            # Small sets are gone through several times a round.
            for some in held * (LEAST_STEPS * STEP // texts):
                go_through(*some)
            pieces = _pack(model, seen)
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in pieces], pa.int32()), pa.array([b for _, b in pieces])], names=["piece", "body"])

    def average(_, rows):
        bodies = rows.column("body").to_pylist()
        total = sum(np.frombuffer(b, np.float32).astype(np.float64) for b in bodies)
        return pa.table({"piece": rows.column("piece").slice(0, 1), "body": [(total / len(bodies)).astype(np.float32).tobytes()]})

    learned = chosen.mapInArrow(learn, "piece int, body binary")
    pieces = learned.groupBy("piece").applyInArrow(average, "piece int, body binary").collect()
    model, _ = shared.value
    return _unpack({r.piece: bytes(r.body) for r in pieces}, model)


def save_linear(model: LinearModel, folder: str) -> None:
    """A table of the pieces, the labels and the used buckets."""
    pieces = _pack(model, np.zeros(len(model.used), np.float32))
    names = [(-1, model.labels, model.used.astype(np.int64).tobytes()), (-2, None, model.scale.tobytes())]
    rows = [(k, None, bytes(b)) for k, b in pieces] + names
    spark = SparkSession.active()
    spark.createDataFrame(rows, "piece int, labels array<string>, body binary").write.mode("overwrite").parquet(folder)


def load_linear(rows: DataFrame) -> LinearModel:
    held = {r.piece: r for r in rows.collect()}
    used, scale = np.frombuffer(held[-1].body, np.int64), np.frombuffer(held[-2].body, np.float32)
    none = np.zeros((0, 0))
    like = LinearModel(list(held[-1].labels), used, scale, none, none, none)
    return _unpack({k: bytes(r.body) for k, r in held.items() if k >= 0}, like)[0]
