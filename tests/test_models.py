"""The linear model and the language table beyond what one line of SQL can check."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from checks import queries
from corpusmill.operators import classify, language, linear

FOLDER = "/root/testdata/sf0.01"


def test_the_step_follows_the_gradient():
    rng = np.random.default_rng(1)
    ids = [rng.choice(40, n, replace=False).astype(np.int64) for n in (3, 0, 9, 20)]
    truth, worth = np.array([0, 1, 2, 1]), np.array([1.0, 2.0, 0.5])

    def model():
        r = np.random.default_rng(2)
        used = np.arange(0, 40, 2)
        shapes = [(20, linear.SIZE), (linear.SIZE, 3), (3,)]
        return linear.LinearModel(list("abc"), used, r.random(20).astype(np.float32), *[r.normal(size=s).astype(np.float64) for s in shapes])

    def loss(m):
        chance = m.chances(m.mean(ids)[3].astype(np.float64))
        return (-np.log(chance[np.arange(4), truth]) * worth[truth]).mean()

    # With a step of one, weights move by their gradient.
    after, before = model(), model()
    after.learn(ids, truth, worth, np.full(20, 1e-6), 1.0)
    for at in [(0, 0), (3, 2), (7, 1)]:
        up, down = model(), model()
        up.weights[at] += 1e-4
        down.weights[at] -= 1e-4
        slope = (loss(up) - loss(down)) / 2e-4
        assert before.weights[at] - after.weights[at] == pytest.approx(slope, abs=1e-3)
    # Vectors move against theirs.
    for at in [(0, 0), (5, 3), (19, 7)]:
        up, down = model(), model()
        up.vectors[at] += 1e-2
        down.vectors[at] -= 1e-2
        slope = (loss(up) - loss(down)) / 2e-2
        assert abs(slope) < 1e-4 or np.sign(before.vectors[at] - after.vectors[at]) == np.sign(slope)


def test_partitions_learn_as_one(spark, monkeypatch):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(200)]

    def some(n, extra):
        return " ".join(rng.choice(words) for _ in range(n)) + f" {extra} " + " ".join(rng.choice(words) for _ in range(n))

    # A long text of a kind has one telling word among many.
    kinds = {"good": "pleasant", "bad": "awful", "odd": "strange"}
    rows = [(i, some(rng.choice([2, 400]), word), name) for i in range(150) for name, word in kinds.items()]
    rows += [(-1, None, "good"), (-2, "", "bad"), (-3, "no label", None)]
    examples = spark.createDataFrame(rows, "doc_id int, text string, label string")
    monkeypatch.setattr(linear, "SHARE", 60)
    model = classify.train_classifier(examples.where("doc_id < 100"))
    scored = classify.score(examples.where("doc_id >= 100"), model, "prediction", "confidence")
    assert scored.count() == 150 and scored.where("prediction = label and confidence > 0.5").count() >= 148
    odd = classify.score(examples.where("doc_id < 0"), model, "prediction", "confidence").collect()
    assert len(odd) == 3 and all(r.prediction in kinds and 0 < r.confidence <= 1 for r in odd)
    with pytest.raises(ValueError):
        classify.train_classifier(examples.where("label is null"))
    many = spark.range(100).select(F.col("id").cast("string").alias("label"), F.lit("x").alias("text"))
    with pytest.raises(ValueError):
        classify.train_classifier(many)


def test_models_learn_from_all_texts(spark, monkeypatch):
    rng = random.Random(5)
    rows = [(i, f"x{i % 7} " + ("pleasant" if i % 2 else "awful") * (rng.random() < 0.5), "good" if i % 2 else "bad") for i in range(400)]
    # Words of few texts, which a part of the texts would lack.
    rows += [(1000 + i, f"seldom{i // 5} x{i % 7}", ("good", "bad")[i // 5 % 2]) for i in range(40)]
    examples = spark.createDataFrame(rows, "doc_id int, text string, label string")
    monkeypatch.setattr(linear, "SHARE", 30)
    models = []
    for most, few in ((20_000, 64), (20, 64), (20, 4)):
        monkeypatch.setattr(linear, "MOST_TEXTS", most)
        # With few partitions these grow; their number is the root of 14 times 4.
        monkeypatch.setattr(linear, "FEW_PARTS", few, raising=False)
        models.append(classify.train_classifier(examples, key="doc_id"))
    whole, bounded, grown = models
    assert np.array_equal(whole.used, bounded.used) and np.array_equal(whole.used, grown.used)
    assert np.allclose(whole.vectors, bounded.vectors, atol=1e-4) and np.allclose(whole.weights, bounded.weights, atol=1e-4)
    scored = classify.score(examples.where("doc_id >= 1000"), grown, "prediction")
    assert scored.where("prediction = label").count() == 40


def test_curation_with_models_learns_from_all_labels(spark, monkeypatch, tmp_path):
    rng = random.Random(7)
    rows = [(i, " ".join(rng.choice(["the", "words", "written", "about", "gardens"]) for _ in range(80)), "en" if i % 3 else "de") for i in range(60)]
    spark.createDataFrame([*rows, (60, None, None)], "doc_id bigint, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, int(i % 4 != 0), int(i % 5 == 0)) for i in range(50)]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    learned, train = [], {"linear": classify.train_linear, "language": classify.train_language}

    def spy(kind):
        def trained(examples, label, text, *rest):
            learned.append((kind, examples.where(F.col(label).isNotNull()).count()))
            return train[kind](examples, label, text, *rest)

        return trained

    monkeypatch.setattr(classify, "train_linear", spy("linear"))
    monkeypatch.setattr(classify, "train_language", spy("language"))
    monkeypatch.setattr(linear, "MOST_TEXTS", 5)
    monkeypatch.setattr(language, "MOST_TEXTS", 5, raising=False)
    done = queries.curate_scored(spark, str(tmp_path))
    assert learned == [("linear", 50), ("linear", 50), ("language", 60)]
    assert done.count() <= 60
    # The model counts the runs of all texts.
    docs = queries.documents(spark, str(tmp_path), "text", F.col("lang").alias("label"))
    counted = language.count_grams(docs).groupBy("label").agg(F.sum("n").alias("n")).collect()
    model = classify.train_classifier(docs, method="language", key="doc_id")
    size = model.table.select("gram").distinct().count()
    for r in counted:
        shares = sum(np.exp(c.weight / language.UNIT) * (r.n + size) - 1 for c in model.table.where(F.col("label") == r.label).collect())
        assert shares == pytest.approx(r.n, rel=1e-3)


def test_runs_of_several_slices_are_added_up(spark, monkeypatch):
    rng = random.Random(8)
    rows = [("ab"[i % 2], "".join(rng.choice("xyzé😀 ") for _ in range(rng.randrange(3000)))) for i in range(40)]
    plain = {}
    for label, body in rows:
        for i in range(len(body) - 2):
            plain[label, body[i : i + 3]] = plain.get((label, body[i : i + 3]), 0) + 1
    examples = spark.createDataFrame(rows * 30, "label string, text string").coalesce(1)
    for held in (10, 1 << 19):
        monkeypatch.setattr(language, "_HELD", held)
        counted = {(r.label, r.gram): r.n for r in language.count_grams(examples).collect()}
        assert counted == {k: 30 * n for k, n in plain.items()}


def test_buckets_are_those_of_each_text_alone(monkeypatch):
    import xxhash

    def plain(text):
        found = set()
        for word in text.split():
            marked = f"<{word}>"
            names = [word, *("\0" + marked[i : i + linear.PART] for i in range(len(marked) - linear.PART + 1))]
            found |= {xxhash.xxh3_64_intdigest(n.encode()) % linear.BUCKETS for n in names}
        return sorted(found)

    rng = random.Random(6)
    texts = ["", " \n\t", "a", "é😀 \xa0b\x85c", "same same", "x" * 900]
    texts += [" ".join("".join(rng.choice("abcé") for _ in range(rng.randrange(1, 7))) for _ in range(rng.randrange(80))) for _ in range(60)]
    row_of = np.where(np.arange(linear.BUCKETS) % 3 == 0, np.arange(linear.BUCKETS) // 3, -1).astype(np.int32)
    for remembered in (10, 1 << 16):
        monkeypatch.setattr(linear, "_REMEMBERED", remembered)
        for a in range(0, len(texts), 7):
            part = texts[a : a + 7]
            want = [plain(t) for t in part]
            flat, counts = linear.bucket_lists(part)
            assert flat.tolist() == sum(want, []) and counts.tolist() == [*map(len, want)]
            flat, counts = linear.bucket_lists(part, row_of)
            want = [[b // 3 for b in w if b % 3 == 0] for w in want]
            assert flat.tolist() == sum(want, []) and counts.tolist() == [*map(len, want)]
    assert [len(x) for x in linear.bucket_lists([])] == [0, 0]


def test_held_out_documents_are_found(spark):
    known = queries.examples(spark, "toxic", FOLDER)
    scored = classify.score(known, queries.trained(spark, "toxic", FOLDER), "prediction")
    held = {(r.label, r.prediction): r.n for r in classify.confusion(scored.where("part = 'valid'")).collect()}
    assert held["non-toxic", "non-toxic"] >= 69 and held["toxic", "toxic"] >= 6


def test_short_texts_have_a_language(spark):
    texts = {
        "en": "the cat sat on the mat and this is what they said\nwhen it was over",
        "de": "der Hund und die Katze sind nicht auf der Straße\nwenn es regnet",
        "fr": "le chat est sur la table et les enfants sont dans le jardin\nquand il pleut",
    }
    examples = spark.createDataFrame([(k, v) for k, v in texts.items() for _ in range(3)], "label string, text string")
    model = classify.train_classifier(examples, method="language")
    short = [("the mat", "en"), ("der Straße", "de"), ("les enfants", "fr"), ("this is", "en"), ("nicht\nwenn", "de"), ("😀😀 la table", "fr")]
    docs = spark.createDataFrame([*short, ("", "de"), (None, "de"), ("zq", "de"), ("ЖЖЖЖ", "de")], "text string, wanted string")
    got = classify.classify_language(docs, model).collect()
    # Without a known run all labels are as likely, and the first is taken.
    assert all(r.language == r.wanted for r in got)
    assert [round(r.confidence, 6) for r in got if r.text in ("", None, "zq", "ЖЖЖЖ")] == [0.333333] * 4


def test_runs_are_counted_as_in_a_plain_loop(spark):
    rng = random.Random(4)
    rows = [(rng.choice("ab"), "".join(rng.choice("xyé😀\n ") for _ in range(rng.randrange(30)))) for _ in range(200)]
    rows += [("a", None), (None, "xyz")]
    plain = {}
    for label, body in rows:
        flat = (body or "").replace("\n", " ")
        for i in range(len(flat) - 2):
            if label:
                plain[label, flat[i : i + 3]] = plain.get((label, flat[i : i + 3]), 0) + 1
    counted = language.count_grams(spark.createDataFrame(rows, "label string, text string")).collect()
    assert {(r.label, r.gram): r.n for r in counted} == plain and len(counted) == len(plain)


def test_long_batches_are_cut():
    import pyarrow as pa

    from corpusmill.operators.batches import cut, few_texts, text_slices

    texts = ["x" * 400, None, "", "y" * 5000, *["z" * 300] * 40]
    parts = list(few_texts(pa.array(texts), 1000))
    assert [t for part in parts for t in part] == [t or "" for t in texts]
    assert all(len(part) == 1 or sum(map(len, part)) <= 2000 for part in parts if "y" * 5000 not in part)
    batch = pa.RecordBatch.from_arrays([pa.array(range(44)), pa.array(texts)], names=["n", "text"])
    slices = list(text_slices([batch, batch.slice(0, 0)], 1000))
    assert len(slices) > 10 and sum(s.num_rows for s in slices) == 44
    assert cut(np.zeros(0, np.int64), 5) == [] and cut(np.array([0, 0, 9, 1]), 5)[-1][1] == 4
