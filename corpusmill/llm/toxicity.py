"""Operator 5: toxicity by a bidirectional gated recurrent network, trained in numpy."""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import id_and_text, table, text_slices

# Window and step in words; sizes of the input vectors, the hidden state of a direction and
# the attention; buckets for runs of three bytes.
WINDOW, STEP = 40, 30
INPUT, HIDDEN, ATTEND = 16, 8, 8
BUCKETS = 4096
# The training sample: toxic documents at most, clean ones for each of these, characters of one
# at most, windows in the first epoch at most, and how many epochs follow it.
TOXIC, CLEAN, MOST_CHARACTERS, FIRST_WINDOWS, EPOCHS, BATCH = 1000, 4, 20_000, 24_000, 8, 256
# Of a clean text so many windows that the network finds most toxic.
CLEAN_WINDOWS = 2
REMEMBERED = 1 << 19
_CHUNK = 4096


def word_runs(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the words' runs of three bytes, with marks at their ends, end to end, and how
    many each word has."""
    data = np.frombuffer(("<" + "><".join(words) + ">").encode("utf-8", "surrogatepass"), np.uint8).astype(np.uint32)
    sizes = np.fromiter((len(w.encode("utf-8", "surrogatepass")) for w in words), np.int64, len(words)) + 2
    runs = (data[:-2] * np.uint32(31) + data[1:-1]) * np.uint32(31) + data[2:]
    runs = ((runs * np.uint32(2654435761)) >> np.uint32(20)) % BUCKETS + 1
    inside = np.ones(len(data), bool)
    ends = np.cumsum(sizes)
    inside[ends - 1] = inside[ends - 2] = False
    return runs[inside[: len(runs)]].astype(np.int64), sizes - 2


def gather_sum(index: np.ndarray, rows: np.ndarray, size: int) -> np.ndarray:
    """Sums of ``rows`` by ``index``, in an array of ``size``."""
    out = np.zeros((size, rows.shape[1]), np.float32)
    if len(index):
        order = np.argsort(index, kind="stable")
        ordered = index[order]
        starts = np.flatnonzero(np.diff(ordered, prepend=-1))
        out[ordered[starts]] = np.add.reduceat(rows[order], starts, axis=0)
    return out


def window_places(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Owner and first word of all windows: every ``STEP`` words, and one that ends with the text."""
    full = np.maximum(-(-(lengths - WINDOW) // STEP), 0) + 1
    owner = np.repeat(np.arange(len(lengths)), full)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(full) - full, full)
    return owner, np.minimum(nth * STEP, np.maximum(lengths[owner] - WINDOW, 0))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


class Network:
    """Word and character vectors, a gated recurrent layer in each direction, attention, logit."""

    def __init__(self, vocabulary: dict[str, int], seed: int = 1) -> None:
        rng = np.random.default_rng(seed)
        self.vocabulary = vocabulary

        def weights(*shape, scale):
            return rng.normal(0, scale, shape).astype(np.float32)

        self.p = {
            "word": weights(len(vocabulary) + 1, INPUT, scale=0.1),
            "run": weights(BUCKETS + 1, INPUT, scale=0.1),
            "in": weights(2, INPUT, 3 * HIDDEN, scale=INPUT**-0.5),
            "back": weights(2, HIDDEN, 3 * HIDDEN, scale=HIDDEN**-0.5),
            "bias": np.zeros((2, 3 * HIDDEN), np.float32),
            "look": weights(2 * HIDDEN, ATTEND, scale=(2 * HIDDEN) ** -0.5),
            "look_bias": np.zeros(ATTEND, np.float32),
            "aim": weights(ATTEND, scale=ATTEND**-0.5),
            "out": weights(2 * HIDDEN, scale=(2 * HIDDEN) ** -0.5),
            "out_bias": np.zeros(1, np.float32),
        }
        self.p["word"][0] = 0
        self.moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in self.p.items()}
        self.steps = 0

    def describe(self, words: list[str]):
        """Each word's place in the vocabulary (0: not in it), its runs, and how many they are."""
        return np.fromiter((self.vocabulary.get(w, 0) for w in words), np.int64, len(words)), *word_runs(words)

    def vectors(self, place: np.ndarray, runs: np.ndarray, counts: np.ndarray) -> np.ndarray:
        sums = np.add.reduceat(self.p["run"][runs], np.cumsum(counts) - counts, axis=0)
        return self.p["word"][place] + sums / counts[:, None].astype(np.float32)

    def project(self, vectors: np.ndarray) -> np.ndarray:
        """Both directions' inputs of each word; a row of zeros for no word comes first."""
        both = [vectors @ self.p["in"][d] + self.p["bias"][d] for d in (0, 1)]
        rows = np.concatenate(both, axis=1)
        return np.concatenate([np.zeros((1, rows.shape[1]), np.float32), rows]).astype(np.float32)

    def forward(self, inputs: np.ndarray, ids: np.ndarray, keep: bool = False):
        """Logits of windows, given projected inputs and the windows' words (0: none)."""
        n, steps = ids.shape
        states = np.zeros((steps, n, 2 * HIDDEN), np.float32)
        trace = [[None] * steps, [None] * steps]
        for d in (0, 1):
            h, recur = np.zeros((n, HIDDEN), np.float32), self.p["back"][d]
            part = inputs[:, d * 3 * HIDDEN : (d + 1) * 3 * HIDDEN]
            for t in range(steps) if d == 0 else range(steps - 1, -1, -1):
                x, q = part[ids[:, t]], h @ recur
                gates = _sigmoid(x[:, : 2 * HIDDEN] + q[:, : 2 * HIDDEN])
                z, r = gates[:, :HIDDEN], gates[:, HIDDEN:]
                new = np.tanh(x[:, 2 * HIDDEN :] + r * q[:, 2 * HIDDEN :])
                before, h = h, new + z * (h - new)
                states[t, :, d * HIDDEN : (d + 1) * HIDDEN] = h
                if keep:
                    trace[d][t] = (before, q[:, 2 * HIDDEN :], z, r, new)
        seen = np.tanh(states @ self.p["look"] + self.p["look_bias"])
        weight = seen @ self.p["aim"]
        absent = (ids == 0).T
        absent[0] &= (ids != 0).any(axis=1)  # a text without words looks at its first place
        weight[absent] = -1e9
        weight = np.exp(weight - weight.max(axis=0))
        weight /= weight.sum(axis=0)
        pooled = np.einsum("tn,tnh->nh", weight, states)
        logit = pooled @ self.p["out"] + self.p["out_bias"]
        return (logit, (states, trace, seen, weight, pooled)) if keep else logit

    def train_on(self, words: tuple, ids: np.ndarray, target: np.ndarray, rate: float) -> None:
        """One step of Adam on the mean logistic loss of windows over described words, from 1 on."""
        place, runs, counts = words
        vectors = self.vectors(place, runs, counts)
        inputs = self.project(vectors)
        logit, (states, trace, seen, weight, pooled) = self.forward(inputs, ids, keep=True)
        n, steps = ids.shape
        p, g = self.p, {k: np.zeros_like(v) for k, v in self.p.items() if k not in ("word", "run")}
        error = ((_sigmoid(logit) - target) / n).astype(np.float32)
        g["out"], g["out_bias"] = pooled.T @ error, np.array([error.sum()], np.float32)
        to_pooled = error[:, None] * p["out"]
        to_states = weight[:, :, None] * to_pooled
        to_weight = np.einsum("tnh,nh->tn", states, to_pooled)
        to_weight = weight * (to_weight - (weight * to_weight).sum(axis=0))
        g["aim"] = np.einsum("tn,tna->a", to_weight, seen)
        to_seen = to_weight[:, :, None] * p["aim"] * (1 - seen**2)
        g["look"], g["look_bias"] = np.einsum("tnh,tna->ha", states, to_seen), to_seen.sum(axis=(0, 1))
        to_states = to_states + to_seen @ p["look"].T
        to_inputs = np.zeros_like(inputs)
        for d in (0, 1):
            dh, recur = np.zeros((n, HIDDEN), np.float32), p["back"][d]
            columns = slice(d * 3 * HIDDEN, (d + 1) * 3 * HIDDEN)
            gathered = np.zeros((steps, n, 3 * HIDDEN), np.float32)
            for t in range(steps - 1, -1, -1) if d == 0 else range(steps):
                before, q, z, r, new = trace[d][t]
                dh = dh + to_states[t, :, d * HIDDEN : (d + 1) * HIDDEN]
                dn = dh * (1 - z) * (1 - new**2)
                dz = dh * (before - new) * z * (1 - z)
                dr = dn * q * r * (1 - r)
                dx = np.concatenate([dz, dr, dn], axis=1)
                dq = np.concatenate([dz, dr, dn * r], axis=1)
                gathered[t] = dx
                g["back"][d] += before.T @ dq
                dh = dh * z + dq @ recur.T
            to_inputs[:, columns] = gather_sum(ids.T.reshape(-1), gathered.reshape(-1, 3 * HIDDEN), len(inputs))
        to_inputs = to_inputs[1:]
        to_vectors = np.zeros_like(vectors)
        for d in (0, 1):
            part = to_inputs[:, d * 3 * HIDDEN : (d + 1) * 3 * HIDDEN]
            g["in"][d], g["bias"][d] = vectors.T @ part, part.sum(axis=0)
            to_vectors += part @ p["in"][d].T
        g["word"] = gather_sum(place, to_vectors, len(p["word"]))
        g["run"] = gather_sum(runs, np.repeat(to_vectors / counts[:, None], counts, axis=0), len(p["run"]))
        g["word"][0] = 0
        self.steps += 1
        for k, grad in g.items():
            m, v = self.moments[k]
            m += 0.1 * (grad - m)
            v += 0.001 * (grad**2 - v)
            self.p[k] -= rate * (m / (1 - 0.9**self.steps)) / (np.sqrt(v / (1 - 0.999**self.steps)) + 1e-8)


def words_of(text: str) -> list[str]:
    return text.lower().split()


def _windows(owner: np.ndarray, first: np.ndarray, begin: np.ndarray, lengths: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """The words of windows; 0 where a short text has ended."""
    inside = np.arange(WINDOW)
    at = np.minimum(begin[owner][:, None] + first[:, None] + inside, max(len(ids) - 1, 0))
    there = first[:, None] + inside < lengths[owner][:, None]
    return np.where(there, ids[at] if len(ids) else 0, 0)


def train(texts: list[str], toxic: list[int], seed: int = 1) -> Network | None:
    """Fit a network to whole labelled texts; nothing if there is only one class.

    A text's score is its highest window's. The first epoch takes a text's windows with its
    label; in the others each text trains by the windows that the network finds most toxic.
    """
    if len(set(toxic)) < 2:
        return None
    rng = np.random.default_rng(seed)
    target = np.array(toxic, np.float32)
    split = [words_of(t) for t in texts]
    holders = Counter(w for words in split for w in set(words))
    network = Network({w: i + 1 for i, w in enumerate(sorted(w for w, n in holders.items() if n >= 3))}, seed)
    distinct = sorted(holders)
    number = {w: i + 1 for i, w in enumerate(distinct)}
    place, runs, counts = network.describe(distinct)
    run_ends = np.cumsum(counts)
    lengths = np.array([len(w) for w in split], np.int64)
    begin = np.cumsum(lengths) - lengths
    ids = np.array([number[w] for words in split for w in words], np.int64)
    owner, first = window_places(lengths)
    windows = _windows(owner, first, begin, lengths, ids)

    def epoch(chosen: np.ndarray, rate: float) -> None:
        rng.shuffle(chosen)
        for a in range(0, len(chosen), BATCH):
            part = chosen[a : a + BATCH]
            used, local = np.unique(windows[part], return_inverse=True)
            local = local.reshape(len(part), WINDOW)
            if used[0] == 0:
                used = used[1:]
            else:
                local = local + 1
            at = used - 1
            their = np.concatenate([runs[run_ends[i] - counts[i] : run_ends[i]] for i in at.tolist()] or [runs[:0]])
            if len(at):
                network.train_on((place[at], their, counts[at]), local, target[owner[part]], rate)

    def score_windows() -> np.ndarray:
        inputs = network.project(network.vectors(place, runs, counts))
        parts = [network.forward(inputs, windows[a : a + _CHUNK]) for a in range(0, len(windows), _CHUNK)]
        return np.concatenate(parts)

    epoch(rng.permutation(len(windows))[:FIRST_WINDOWS], 0.02)
    for turn in range(EPOCHS):
        order = np.lexsort((-score_windows(), owner))
        nth = np.arange(len(order)) - np.searchsorted(owner[order], owner[order])
        best = order[nth < np.where(target[owner[order]] > 0, 1, CLEAN_WINDOWS)]
        # Small samples get as many steps as large ones.
        for _ in range(max(1, 2400 // max(len(best), 1))):
            epoch(best.copy(), 0.01 if turn < EPOCHS - 1 else 0.003)
    return network


class Scorer:
    """Scores of whole texts, with the projected inputs of words seen so far."""

    def __init__(self, network: Network) -> None:
        self.network = network
        self._forget()

    def _forget(self) -> None:
        self.number: dict[str, int] = {}
        self.inputs = np.zeros((1 << 14, 6 * HIDDEN), np.float32)

    def _learn(self, words: list[str]) -> None:
        first = len(self.number) + 1
        last = first + len(words)
        if last > len(self.inputs):
            grown = np.zeros((2 * last, 6 * HIDDEN), np.float32)
            grown[:first] = self.inputs[:first]
            self.inputs = grown
        self.number.update(zip(words, range(first, last), strict=True))
        for a in range(0, len(words), _CHUNK):
            part = words[a : a + _CHUNK]
            rows = self.network.project(self.network.vectors(*self.network.describe(part)))[1:]
            self.inputs[first + a : first + a + len(part)] = rows

    def score(self, texts: list[str]) -> np.ndarray:
        if len(self.number) > REMEMBERED:
            self._forget()
        number, split = self.number, [words_of(t) for t in texts]
        fresh = list({w for words in split for w in words}.difference(number))
        if fresh:
            self._learn(fresh)
        lengths = np.array([len(w) for w in split], np.int64)
        begin = np.cumsum(lengths) - lengths
        ids = np.array([i for words in split for i in map(number.__getitem__, words)], np.int64)
        owner, first = window_places(lengths)
        best = np.full(len(texts), -np.inf)
        for a in range(0, len(owner), _CHUNK):
            part = slice(a, a + _CHUNK)
            logit = self.network.forward(self.inputs, _windows(owner[part], first[part], begin, lengths, ids))
            np.maximum.at(best, owner[part], logit.astype(np.float64))
        return _sigmoid(best)


def training_sample(docs: DataFrame, labels: DataFrame, toxic: int = TOXIC) -> list:
    """``text, toxic`` of at most ``toxic`` toxic documents and ``CLEAN`` times as many others, in a
    fixed hash order, that are not held out and not longer than ``MOST_CHARACTERS``."""
    wanted = {1: toxic, 0: CLEAN * toxic}
    known = labels.where("toxic is not null and doc_id is not null").where(~held_out())
    known = known.select("doc_id", "toxic").distinct()
    # A third more than wanted, since long documents fall out.
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = [known.where(F.col("toxic") == c).orderBy(*order).limit(n * 4 // 3) for c, n in wanted.items()]
    ids = F.broadcast(chosen[0].unionByName(chosen[1]))
    found = id_and_text(docs).where(F.length("text") <= MOST_CHARACTERS).join(ids, "doc_id")
    rows = found.select("doc_id", "text", "toxic").collect()
    rows.sort(key=lambda r: (zlib.crc32(str(r.doc_id).encode()), r.doc_id))
    return [r for c, n in wanted.items() for r in [x for x in rows if x.toxic == c][:n]]


def held_out(doc_id: str = "doc_id"):
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0


def score_toxicity(docs: DataFrame, network: Network | None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, score``: one row per input row, between 0 and 1; every overlapping window of every
    text is scored. A missing or empty text is scored as one window without words; repeated
    rows score alike; without a network all scores are 0. No shuffle; the network, whose size
    its parameters and the training sample bound, is sent to the tasks."""
    rows = id_and_text(docs, doc_id, text)
    if network is None:
        return rows.select("doc_id", F.lit(0.0).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast((network.vocabulary, network.p))

    def score(batches):
        vocabulary, parameters = shared.value
        net = Network.__new__(Network)
        net.vocabulary, net.p = vocabulary, parameters
        scorer = Scorer(net)
        for batch in text_slices(batches):
            scores = scorer.score(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores)], names=["doc_id", "score"])

    return rows.mapInArrow(score, "doc_id bigint, score double")


def op5_toxicity(spark, folder: str) -> DataFrame:
    """``score_toxicity`` over all documents, by a network trained on labels that are not held out."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    sample = training_sample(docs, table(spark, folder, "labels"))
    network = train([r.text for r in sample], [r.toxic for r in sample])
    scored = score_toxicity(docs, network)
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
