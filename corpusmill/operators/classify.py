"""Classifiers: training, evaluation, scoring, saving.

Three kinds, told apart by their models: linear over averaged vectors (the default), languages
by a table of character runs, and Spark's own over bags of words.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, NaiveBayes
from pyspark.ml.feature import HashingTF, IndexToString, RegexTokenizer, StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.functions.text import flatten_for_scoring
from corpusmill.operators.language import LanguageModel, best_language, train_language
from corpusmill.operators.linear import LinearModel, best_label, bounded_sample, load_linear, save_linear, train_linear

Model = LinearModel | LanguageModel | PipelineModel

FEATURES = 1 << 18


def _weighted(examples: DataFrame, label: str) -> DataFrame:
    """Give each class the same total weight. There is one row per class in the counts."""
    counts = examples.groupBy(label).agg(F.count("*").alias("_n")).collect()
    total = sum(row["_n"] for row in counts)
    weight = F.lit(1.0)
    for row in counts:
        share = total / (len(counts) * row["_n"])
        weight = F.when(F.col(label) == row[label], share).otherwise(weight)
    return examples.withColumn("_weight", weight)


def train_classifier(
    examples: DataFrame,
    label: str = "label",
    text: str = "text",
    method: str = "linear",
    key: str | None = None,
    most: int | None = None,
) -> Model:
    """Fit texts to labels, which must be a small set.

    ``linear`` is a linear model over averaged vectors of words and parts of words, ``language``
    a table of runs of characters. ``logistic`` looks at which words occur, unscaled, ``bayes``
    at how often they occur. All texts are learned from, unless ``most`` asks for about so many of
    a label at most, drawn by the hash of the column ``key``.
    """
    if most:
        examples = bounded_sample(examples, label, most, key)
    if method == "linear":
        return train_linear(examples, label, text)
    if method == "language":
        return train_language(examples, label, text)
    flat = examples.select(F.col(label), flatten_for_scoring(F.col(text)).alias("_flat"))
    flat = _weighted(flat, label)
    index = StringIndexer(inputCol=label, outputCol="_class", stringOrderType="alphabetAsc").fit(flat)
    words = RegexTokenizer(inputCol="_flat", outputCol="_words", pattern=r"\s+")
    counts = HashingTF(inputCol="_words", outputCol="_counts", numFeatures=FEATURES)
    counts.setBinary(method == "logistic")
    kind = {"logistic": LogisticRegression, "bayes": NaiveBayes}[method]
    options = {"maxIter": 30, "regParam": 0.001, "standardization": False} if method == "logistic" else {}
    fit = kind(featuresCol="_counts", labelCol="_class", weightCol="_weight", **options)
    named = IndexToString(inputCol="prediction", outputCol="_label", labels=index.labels)
    fitted = Pipeline(stages=[words, counts, fit]).fit(index.transform(flat))
    return PipelineModel(stages=[*fitted.stages, named])


def score(
    docs: DataFrame, model: Model, label: str, confidence: str | None = None, text: str = "text"
) -> DataFrame:
    """Add the most likely label and its probability. Line ends are flattened first."""
    if isinstance(model, PipelineModel):
        scored = model.transform(docs.withColumn("_flat", flatten_for_scoring(F.col(text))))
        scored = scored.withColumn("_best", F.array_max(vector_to_array("probability")))
        columns = [*docs.columns, F.col("_label").alias(label)]
        return scored.select(*columns, *([F.col("_best").alias(confidence)] if confidence else []))
    best = best_language if isinstance(model, LanguageModel) else best_label
    scored = docs.withColumn("_best", best(flatten_for_scoring(F.col(text)), model))
    found = [F.col("_best.label").alias(label), *([F.col("_best.confidence").alias(confidence)] if confidence else [])]
    return scored.select(*docs.columns, *found)


def classify_language(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    return score(docs, model, "language", "confidence", text)


def classify_nsfw(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    return score(docs, model, "nsfw", "confidence", text)


def classify_toxic(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    return score(docs, model, "toxicity", "confidence", text)


def classify_quality(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    return score(docs, model, "quality", "confidence", text)


def evaluate_classifier(scored: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """``n, precision_at_1, recall_at_1`` as one row. With one label and one prediction
    per example both shares are the accuracy."""
    hits = F.count_if(F.col(label) == F.col(prediction)) / F.count("*")
    return scored.agg(
        F.count("*").alias("n"), hits.alias("precision_at_1"), hits.alias("recall_at_1")
    )


def confusion(scored: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """How often each label was given each prediction."""
    return scored.groupBy(label, prediction).agg(F.count("*").alias("n"))


def save_model(model: Model, folder: str) -> None:
    if isinstance(model, PipelineModel):
        model.write().overwrite().save(folder)
    elif isinstance(model, LanguageModel):
        model.table.write.mode("overwrite").parquet(folder)
    else:
        save_linear(model, folder)


def load_model(folder: str) -> Model:
    """What ``save_model`` wrote: a table, or a folder of Spark's own."""
    spark = SparkSession.active()
    try:
        rows = spark.read.parquet(folder)
    except AnalysisException:
        return PipelineModel.load(folder)
    return LanguageModel(rows) if "gram" in rows.columns else load_linear(rows)
