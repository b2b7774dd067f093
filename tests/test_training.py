import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from corpusmill.operators import classify, ranks, sampling, tokens


def order(keys, seed):
    return sorted(keys, key=lambda k: hashlib.md5(f"{seed}:{k}".encode()).hexdigest())


def test_sample(spark):
    df = spark.range(5000).withColumnRenamed("id", "k")
    got = {r["rank"]: r.k for r in sampling.sample_k(df, 1234, "k", 3).collect()}
    assert got == dict(enumerate(order(range(5000), 3)[:1234], 1))
    assert sampling.sample_k(df, 9999, "k").count() == 5000
    assert sampling.sample_k(df, 0, "k").count() == 0


def test_split_even_drops_the_remainder(spark):
    sample = sampling.sample_k(spark.range(23), 23, "id")
    parts = Counter(r.part for r in sampling.split_even(sample, 23, 5).collect())
    assert parts == {i: 4 for i in range(5)}
    assert sampling.split_even(sample, 3, 5).count() == 0


def test_sample_records(spark):
    df = spark.createDataFrame([(i, b"x" * (i % 2)) for i in range(10)], "id bigint, content binary")
    assert sampling.sample_records(df, 10, "id").count() == 5
    with pytest.raises(ValueError):
        sampling.sample_records(df, 11, "id")


def test_balanced_and_interleaved(spark):
    docs = spark.range(100).select(F.col("id").alias("doc_id"), F.lit("a\r\nb").alias("text"))
    good, bad = docs.where("doc_id < 10"), docs.where("doc_id >= 10")
    both = sampling.balanced_training_set(good, bad)
    assert Counter(r.label for r in both.collect()) == {"__label__wiki": 10, "__label__cc": 10}
    assert {r.text for r in both.collect()} == {"a b"}
    assert Counter(r.label for r in sampling.balanced_training_set(bad, good).collect()) == {"__label__wiki": 90, "__label__cc": 10}
    assert sampling.balanced_training_set(good.limit(0), bad).count() == 0
    lines = sampling.balanced_training_set(bad, good).select("doc_id", F.concat_ws(" ", "label", "text").alias("line"))
    turns = sampling.interleave_classes(lines).orderBy("position").collect()
    assert [r.position for r in turns] == list(range(20))
    assert [r.line.split()[0] for r in turns] == ["__label__cc", "__label__wiki"] * 10


def test_file_order(spark):
    df = spark.createDataFrame([("a",), ("b",), ("c",), ("a",)], "path string")
    got = {r.position: r.path for r in sampling.random_file_order(df, seed=9).collect()}
    assert got == dict(enumerate(order("abc", 9), 1))


def test_offsets(spark):
    df = spark.range(1000).select((F.col("id") * 7 % 1000).alias("k"), (F.col("id") % 5).alias("n"))
    rows = sorted((r.k, r.n) for r in df.collect())
    want, total = {}, 0
    for k, n in rows:
        want[k] = total
        total += n
    for buckets in (1, 3, 50):
        assert {r.k: r.offset for r in ranks.running_offsets(df, "k", "n", buckets=buckets).collect()} == want


def test_vocabulary_and_windows(spark, tmp_path):
    docs = spark.createDataFrame([(3, "b a a"), (1, "a, a b c"), (2, ""), (4, "z " * 50)], "doc_id bigint, text string")
    vocab = tokens.build_vocab(docs, 5)
    assert [(r.token, r.n, r.id) for r in vocab.orderBy("id").collect()] == [("z", 50, 2), ("a", 4, 3), ("b", 2, 4)]
    encoded = tokens.encode_tokens(docs, vocab)
    ids = {r.doc_id: r.tokens for r in encoded.collect()}
    assert ids == {1: [3, 0, 3, 4, 0, 1], 2: [1], 3: [4, 3, 3, 1], 4: [2] * 50 + [1]}
    stream = [t for k in sorted(ids) for t in ids[k]]
    assert tokens.token_totals(encoded).first().total_tokens == len(stream)
    for context in (1, 4, 61, 62):
        got = {r.window_id: (r.x, r.y) for r in tokens.token_windows(encoded, context).collect()}
        count = (len(stream) - 1) // context
        assert got == {
            w: (stream[w * context : (w + 1) * context], stream[w * context + 1 : (w + 1) * context + 1]) for w in range(count)
        }
    assert tokens.sample_windows(tokens.token_windows(encoded, 4), 3).count() == 3

    # Windows at any place, from files of which only those touched are read.
    encoded.repartition(4, "doc_id").write.parquet(f"{tmp_path}/encoded")
    index = tokens.index_tokens(spark.read.parquet(f"{tmp_path}/encoded"))
    for context in (1, 5, 60, 61):
        drawn = tokens.random_starts(index, 40, context, 3)
        starts = {r.window_id: r.start for r in drawn.collect()}
        assert len(starts) == 40 and all(0 <= s < len(stream) - context for s in starts.values())
        got = {r.window_id: (r.x, r.y) for r in tokens.read_windows(index, drawn, context).collect()}
        assert got == {w: (stream[s : s + context], stream[s + 1 : s + context + 1]) for w, s in starts.items()}
    assert tokens.random_starts(index, 40, 62).count() == 0
    far = index.where("doc_id = 4").first()
    for path in (tmp_path / "encoded").glob("*.parquet"):
        if not far.file.endswith(path.name):
            path.unlink()
    one = spark.createDataFrame([(0, far.offset + 3)], "window_id bigint, start bigint")
    assert tokens.read_windows(index, one, 5).first().x == [2] * 5
    with pytest.raises(ValueError):
        tokens.build_vocab(docs, 70_000)


def test_classifier(spark, tmp_path):
    words = {"en": "the cat and the dog", "de": "der hund und die katze"}
    rows = [(i, f"{text}\nx{i}", label) for i in range(40) for label, text in words.items()]
    examples = spark.createDataFrame(rows, "doc_id bigint, text string, label string")
    for method in ("linear", "language", "bayes", "logistic"):
        model = classify.train_classifier(examples, method=method)
        scored = classify.score(examples, model, "prediction", "confidence")
        row = classify.evaluate_classifier(scored).first()
        assert (row.n, row.precision_at_1, row.recall_at_1) == (80, 1.0, 1.0)
        assert scored.where("confidence <= 0.5 or confidence > 1").count() == 0
        classify.save_model(model, str(tmp_path / method))
        again = classify.score(examples, classify.load_model(str(tmp_path / method)), "prediction")
        assert classify.confusion(again).count() == 2


def test_train_and_valid_parts(spark):
    part = sampling.train_or_valid("id", 1).alias("part")
    counts = {r.part: r["count"] for r in spark.range(4000).select(part).groupBy("part").count().collect()}
    assert abs(counts["train"] - 3000) < 150 and sum(counts.values()) == 4000
