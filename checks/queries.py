"""One query per operator, over whole tables. Arrays are rendered as strings so that two
engines can be compared by value."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusmill.functions import html, pii, quality, text
from corpusmill.operators import classify, lines, minhash, sampling, tokens
from corpusmill.operators.linear import MOST_TEXTS
from corpusmill.plans import curate
from corpusmill.session import materialize, scratch_path
from corpusmill.sources import archives, files, named

NUM_HASHES, NUM_BANDS, NGRAMS, THRESHOLD = 20, 5, 5, 0.8
SAMPLE, PARTS, RECORDS, SEED, CONTEXT, BATCH = 100, 7, 20, 7, 128, 64
SHARD_START, SHARD_FILES = 5, 10
HASH_INDEX = 3


def documents(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    return files.read_table(spark, folder, "documents", "doc_id").select("doc_id", *(columns or ("text",)))


def pages(spark: SparkSession, folder: str) -> DataFrame:
    return files.read_table(spark, folder, "pages", "page_id")


def verdicts(spark: SparkSession, folder: str) -> DataFrame:
    return files.read_table(spark, folder, "labels").select(
        "doc_id",
        F.when(F.col("quality") == 1, "wiki").otherwise("cc").alias("quality"),
        F.when(F.col("toxic") == 1, "toxic").otherwise("non-toxic").alias("toxicity"),
    )


def joined(values: Column, separator: str = " ") -> Column:
    return F.array_join(F.transform(values, lambda v: v.cast("string")), separator)


# Sources and sinks ------------------------------------------------------------------


ARCHIVES = 16


def warc_record(kind: str, block: Column) -> Column:
    return F.concat(
        F.lit(f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <urn:page:"),
        F.col("page_id").cast("string"),
        F.lit(">\r\nWARC-Target-URI: "),
        F.col("url"),
        F.lit(f"\r\nContent-Type: application/http; msgtype={kind}\r\nContent-Length: "),
        F.octet_length(block).cast("string"),
        F.lit("\r\n\r\n"),
        block,
    )


def warc_records() -> Column:
    body = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"), F.col("html"))
    return F.array(warc_record("request", F.lit("GET / HTTP/1.1\r\n\r\n")), warc_record("response", body))


def write_archives(spark: SparkSession, folder: str) -> str:
    """All pages as archives: a request and a response record each."""
    target = scratch_path(spark, "archives")
    rendered = pages(spark, folder).select(F.explode(warc_records()).alias("value"))
    rendered.write.option("lineSep", "\r\n\r\n").option("compression", "gzip").text(target)
    return target


def scan_archives(spark, folder):
    """One file for the pages of a part, not packed, so that its size can be told from the pages."""
    target = scratch_path(spark, "plain-archives")
    part = F.pmod("page_id", F.lit(ARCHIVES)).alias("part")
    rendered = pages(spark, folder).select(part, F.explode(warc_records()).alias("value")).repartition("part")
    rendered.write.partitionBy("part").option("lineSep", "\r\n\r\n").text(target)
    found = archives.scan_archives(spark, target, ".txt")
    return found.select(F.regexp_extract("path", r"part=(\d+)", 1).cast("bigint").alias("part"), "n_bytes")


def scan_records(spark, folder):
    records = archives.scan_records(spark, write_archives(spark, folder), ".gz")
    number = F.regexp_extract(F.element_at("headers", "WARC-Record-ID"), r"(\d+)", 1).cast("bigint")
    return records.select(number.alias("page_id"), "url", html.decode_bytes(F.col("content")).alias("html"))


def index_records(spark, folder):
    index = archives.index_records(archives.scan_archives(spark, write_archives(spark, folder), ".gz"))
    return index.select("url", "warc_type", "length", "missing")


def shard_files(spark, folder):
    listed = documents(spark, folder, "source")
    return files.shard_files(listed, SHARD_START, SHARD_FILES, "source")


#: Folders that the documents to be scanned are dealt to.
FOLDERS = 256


def scan_documents(spark, folder):
    """One file per document, in few folders: what a document costs is its file."""
    target = scratch_path(spark, "documents")
    texts = F.array_join(F.collect_list(F.coalesce("text", F.lit(""))), "\n")
    whole = documents(spark, folder).groupBy("doc_id").agg(F.concat(texts, F.lit("\n")).alias("text"))
    place = F.concat(F.pmod("doc_id", F.lit(FOLDERS)), F.lit("/doc_id="), "doc_id", F.lit(".txt"))
    named.sink_named_documents(whole.withColumn("file_name", place), target)
    found = files.scan_documents(spark, target)
    number = F.regexp_extract("path", r"doc_id=(\d+)", 1).cast("bigint")
    return found.select(number.alias("doc_id"), F.regexp_replace("text", r"\n\z", "").alias("text"))


def scan_url_lines(spark, folder):
    target = scratch_path(spark, "urls")
    padded = pages(spark, folder).select(F.concat(F.lit("  "), "url", F.lit("\t")))
    padded.write.option("compression", "gzip").text(target)
    return files.scan_url_lines(spark, target).select("url")


def sink_corpus(spark, folder):
    target = scratch_path(spark, "corpus")
    files.sink_corpus(documents(spark, folder), target)
    return files.read_corpus(spark, target).select(files.corpus_record(F.col("text")).alias("record"))


def sink_documents(spark, folder):
    target = scratch_path(spark, "kept")
    files.sink_documents(lines.exact_line_dedup(documents(spark, folder)), target)
    return spark.read.schema("doc_id bigint, text string").parquet(target)


def sink_named_documents(spark, folder):
    """Every document in a file of its own name, read back."""
    target = scratch_path(spark, "named")
    numbered = documents(spark, folder).withColumn("file_name", F.concat(F.col("doc_id") % 10, F.lit("/"), "doc_id", F.lit(".txt")))
    named.sink_named_documents(numbered, target)
    found = files.scan_documents(spark, target, "*.txt")
    return found.select(F.regexp_extract("file_name", r"\d+", 0).cast("bigint").alias("doc_id"), "text")


def labelled_documents(spark, folder) -> DataFrame:
    """``doc_id, text, quality`` of the English documents that pass the rules."""
    kept = curate.english_gopher_docs(documents(spark, folder, "text", "lang"))
    return kept.join(verdicts(spark, folder), "doc_id").select("doc_id", "text", "quality")


def training_set(spark, folder) -> DataFrame:
    kept = materialize(labelled_documents(spark, folder), "labelled")
    good, bad = kept.where("quality = 'wiki'"), kept.where("quality = 'cc'")
    return sampling.balanced_training_set(good, bad, seed=SEED)


def sink_labelled_lines(spark, folder):
    target = scratch_path(spark, "examples")
    files.sink_labelled_lines(training_set(spark, folder), target)
    return files.read_labelled_lines(spark, target)


def vocabulary(spark, folder) -> DataFrame:
    return tokens.build_vocab(documents(spark, folder))


def encoded(spark, folder) -> DataFrame:
    return tokens.encode_tokens(documents(spark, folder), vocabulary(spark, folder))


def sink_tokens(spark, folder):
    return files.sink_tokens(encoded(spark, folder), scratch_path(spark, "tokens"))


def model_io(spark, folder):
    target = scratch_path(spark, "model")
    classify.save_model(language_model(spark, folder, MOST_TEXTS), target)
    docs = documents(spark, folder)
    return classify.score(docs, classify.load_model(target), "language").select("doc_id", "language")


# Text ---------------------------------------------------------------------------------


def html_to_text(spark, folder):
    return pages(spark, folder).select("page_id", html.html_to_text(F.col("html")).alias("text"))


def html_strip(spark, folder):
    return pages(spark, folder).select("page_id", html.html_strip(F.col("html")).alias("text"))


def mask_emails(spark, folder):
    return pii.with_mask(documents(spark, folder), pii.mask_emails)


def mask_phones(spark, folder):
    return pii.with_mask(documents(spark, folder), pii.mask_phones)


def mask_ips(spark, folder):
    return pii.with_mask(documents(spark, folder), pii.mask_ips)


def mask_pii(spark, folder):
    return pii.mask_pii(documents(spark, folder))


def drop_short_lines(spark, folder):
    return documents(spark, folder).select("doc_id", text.drop_short_lines(F.col("text")).alias("text"))


def flatten_text(spark, folder):
    return documents(spark, folder).select("doc_id", text.flatten_text(F.col("text")).alias("text"))


def normalize_text(spark, folder):
    return documents(spark, folder).select("doc_id", text.normalize_text(F.col("text")).alias("text"))


def word_tokens(spark, folder):
    cut = text.bind(documents(spark, folder), words=text.word_tokens(F.col("text")))
    return cut.select("doc_id", F.size("words").cast("bigint").alias("n"), joined(F.col("words")).alias("tokens"))


def nonblank_lines(spark, folder):
    cut = text.bind(documents(spark, folder), kept=text.nonblank_lines(F.col("text")))
    return cut.select("doc_id", F.size("kept").cast("bigint").alias("n"), joined(F.col("kept"), "\n").alias("lines"))


def line_hash(spark, folder):
    cut = documents(spark, folder).select("doc_id", F.posexplode(text.terminated_lines(F.col("text"))).alias("p", "line"))
    return cut.select("doc_id", F.col("p").cast("bigint").alias("pos"), text.line_hash(F.col("line")).alias("line_hash"))


def _words(spark, folder) -> DataFrame:
    return documents(spark, folder).select("doc_id", F.split(text.normalize_text(F.col("text")), " ").alias("words"))


def word_ngrams(spark, folder):
    grams = text.bind(_words(spark, folder), grams=text.word_ngrams(F.col("words"), NGRAMS))
    return grams.select(
        "doc_id", F.size("grams").cast("bigint").alias("n"), F.md5(F.array_join("grams", "|")).alias("grams_md5")
    )


def ngram_hash(spark, folder):
    gram = text.explode_ngrams(_words(spark, folder), "words", NGRAMS)
    hashed = gram.select("doc_id", minhash.ngram_hash(F.col("gram"), HASH_INDEX).alias("h"))
    return hashed.groupBy("doc_id").agg(
        F.count("*").alias("n"), F.sum("h").alias("total"), F.min("h").alias("least"), F.max("h").alias("most")
    )


# Filters and classifiers --------------------------------------------------------------


def gopher_stats(spark, folder):
    stats = quality.gopher_stats(documents(spark, folder))
    shares = [F.round(name, 6).alias(name) for name in quality.STATS[1:]]
    return stats.select("doc_id", "n_tokens", *shares)


def gopher_filter(spark, folder):
    return quality.gopher_filter(documents(spark, folder))


def with_labels(spark, kind, folder, docs) -> DataFrame:
    """``docs`` with ``label, part``, both empty where none is known."""
    label = F.col("quality" if kind == "quality" else "toxicity")
    if kind == "nsfw":
        label = F.when(label == "toxic", "nsfw").when(label == "non-toxic", "non-nsfw")
    known = docs.join(verdicts(spark, folder).select("doc_id", label.alias("label")), "doc_id", "left")
    return known.withColumn("part", F.when(F.col("label").isNotNull(), sampling.train_or_valid("doc_id", SEED)))


def examples(spark, kind, folder) -> DataFrame:
    """``doc_id, text, label, part`` of all documents, label and part empty where none is known."""
    return with_labels(spark, kind, folder, documents(spark, folder))


def trained(spark, kind, folder, whole=False):
    """A model of three quarters of the labelled documents, all that are not held out; or of the ``whole``."""
    # Without ``part``, of which Spark cannot tell that it needs the id alone: other texts stay where they are.
    train = F.lit(True) if whole else sampling.train_or_valid("doc_id", SEED) == "train"
    return classify.train_classifier(examples(spark, kind, folder).where(F.col("label").isNotNull() & train))


def language_model(spark, folder, most=None):
    labelled = documents(spark, folder, "text", F.col("lang").alias("label"))
    return classify.train_classifier(labelled, method="language", key="doc_id", most=most)


def classify_language(spark, folder):
    scored = classify.classify_language(documents(spark, folder), language_model(spark, folder, MOST_TEXTS))
    return scored.select("doc_id", "language", F.round("confidence", 6).alias("confidence"))


#: The share of the held-out documents of a label that must be found. The smallest table holds out
#: four documents of one rarer label and one of the other, hence their low floors.
FLOORS = {"wiki": 0.9, "cc": 0.25, "non-toxic": 0.9, "toxic": 0.25, "non-nsfw": 0.9, "nsfw": 0.25}


def floors_reached(spark, kind, folder, classifier, prediction) -> DataFrame:
    """Every document is scored; per label: how many were held out, whether enough of them were
    found, and how many documents of the whole table got a label and a probability."""
    # Texts are scored where they are; what is joined with the labels has none.
    scored = classifier(documents(spark, folder), trained(spark, kind, folder)).drop("text")
    scored = with_labels(spark, kind, folder, scored)
    sound = F.col(prediction).isin(list(FLOORS)) & F.col("confidence").between(0.5, 1)
    held = F.col("part") == "valid"
    tall = scored.groupBy("label").agg(
        F.count_if(held).alias("n_held_out"),
        F.count_if(held & (F.col(prediction) == F.col("label"))).alias("n_found"),
        F.count_if(sound).alias("n_sound"),
    )
    floor = F.element_at(F.create_map(*[F.lit(x) for pair in FLOORS.items() for x in pair]), F.col("label"))
    return tall.select("label", "n_held_out", "n_sound", (F.col("n_found") >= floor * F.col("n_held_out")).alias("floor_reached"))


def classify_nsfw(spark, folder):
    """No table labels this kind of text; the toxicity label stands in."""
    return floors_reached(spark, "nsfw", folder, classify.classify_nsfw, "nsfw")


def classify_toxic(spark, folder):
    return floors_reached(spark, "toxic", folder, classify.classify_toxic, "toxicity")


def classify_quality(spark, folder):
    return floors_reached(spark, "quality", folder, classify.classify_quality, "quality")


def pii_limit(spark, folder):
    return pii.pii_limit(documents(spark, folder))


def curated(spark, folder):
    docs = documents(spark, folder, "text", "lang")
    kept = curate.curate(docs, verdicts(spark, folder))
    return kept.select("doc_id", "text", files.corpus_record(F.col("text")).alias("record"))


def curate_scored(spark, folder):
    """No document is held out, so the models learn from all that have a label."""
    quality, toxic = (trained(spark, kind, folder, whole=True) for kind in ("quality", "toxic"))
    return curate.curate_scored(documents(spark, folder), quality, language_model(spark, folder), toxic)


def curation_funnel(spark, folder):
    docs = documents(spark, folder, "text", "lang", "source")
    return curate.curation_funnel(docs, verdicts(spark, folder))


def english_gopher_docs(spark, folder):
    return curate.english_gopher_docs(documents(spark, folder, "text", "lang")).select("doc_id", "text")


def english_gopher_rejects(spark, folder):
    return curate.english_gopher_rejects(documents(spark, folder, "text", "lang"))


# Deduplication ------------------------------------------------------------------------


def line_counts(spark, folder):
    return lines.line_counts(documents(spark, folder))


def exact_line_dedup(spark, folder):
    return lines.exact_line_dedup(documents(spark, folder))


def signatures(spark, folder) -> DataFrame:
    return minhash.minhash_signatures(documents(spark, folder), NUM_HASHES, NGRAMS)


def minhash_signature(spark, folder):
    return signatures(spark, folder).select("doc_id", joined(F.col("sig"), ",").alias("sig"))


def lsh_buckets(spark, folder):
    buckets = minhash.lsh_buckets(signatures(spark, folder), NUM_HASHES, NUM_BANDS)
    return buckets.select("doc_id", F.col("band").cast("bigint").alias("band"), "key")


def candidate_pairs(spark, folder):
    found = materialize(signatures(spark, folder), "signatures")
    return minhash.candidate_pairs(found, NUM_HASHES, NUM_BANDS)


def signature_jaccard(spark, folder):
    found = materialize(signatures(spark, folder), "signatures")
    pairs = minhash.candidate_pairs(found, NUM_HASHES, NUM_BANDS)
    left = found.select(F.col("doc_id").alias("src"), F.col("sig").alias("left"))
    right = found.select(F.col("doc_id").alias("dst"), F.col("sig").alias("right"))
    both = pairs.join(left, "src").join(right, "dst")
    return both.select("src", "dst", F.round(minhash.signature_jaccard("left", "right"), 6).alias("jaccard"))


def duplicate_pairs(spark, folder):
    found = minhash.duplicate_pairs(signatures(spark, folder), NUM_HASHES, NUM_BANDS, THRESHOLD)
    return found.withColumn("jaccard", F.round("jaccard", 6))


def duplicate_clusters(spark, folder):
    return minhash.duplicate_clusters(signatures(spark, folder), NUM_HASHES, NUM_BANDS, THRESHOLD)


def fuzzy_dedup(spark, folder):
    return minhash.fuzzy_dedup(documents(spark, folder), NUM_HASHES, NUM_BANDS, NGRAMS, THRESHOLD)


# Sampling and training sets -------------------------------------------------------------


def sample_k(spark, folder):
    return sampling.sample_k(pages(spark, folder), SAMPLE, "page_id", SEED).select("page_id", "url", "rank")


def split_even(spark, folder):
    table = pages(spark, folder)
    sample = sampling.sample_k(table, SAMPLE, "page_id", SEED)
    size = min(SAMPLE, table.count())
    return sampling.split_even(sample, size, PARTS).select("page_id", "url", "part")


def sample_records(spark, folder):
    drawn = sampling.sample_records(pages(spark, folder), RECORDS, "page_id", "html", SEED)
    return drawn.select("page_id", "html")


def balanced_training_set(spark, folder):
    part = sampling.train_or_valid("doc_id", SEED).alias("part")
    return training_set(spark, folder).select("doc_id", "label", "text", part)


def interleave_classes(spark, folder):
    labelled = materialize(training_set(spark, folder), "examples")
    rendered = labelled.select("doc_id", files.labelled_line(F.col("label"), F.col("text")).alias("line"))
    return sampling.interleave_classes(rendered, seed=SEED)


def random_file_order(spark, folder):
    return sampling.random_file_order(documents(spark, folder, "source"), "source", SEED)


def train_classifier(spark, folder):
    """A model of three quarters of the labelled documents, on the other quarter: per label the
    held-out documents, and whether the model beats the guess that all have the commonest label
    in the mean share found per label."""
    known = examples(spark, "quality", folder).where("label is not null")
    scored = classify.score(known, trained(spark, "quality", folder), "prediction", "confidence")
    held = F.col("part") == "valid"
    found = F.count_if(held & (F.col("prediction") == F.col("label"))) / F.greatest(F.count_if(held), F.lit(1))
    per = scored.groupBy("label").agg(F.count_if(~held).alias("n_train"), F.count_if(held).alias("n_held_out"), found.alias("found"))
    mean = F.avg("found").over(Window.partitionBy())
    return per.select("label", "n_train", "n_held_out", (mean > 0.5).alias("beats_guess"))


def evaluate_classifier(spark, folder):
    """The symbol and length rules as a predictor of the quality label."""
    judged = quality.with_gopher(documents(spark, folder)).join(verdicts(spark, folder), "doc_id")
    guess = F.when(F.col("gopher_ok"), "wiki").otherwise("cc")
    result = classify.evaluate_classifier(judged.select(F.col("quality").alias("label"), guess.alias("prediction")))
    return result.select("n", *[F.round(c, 6).alias(c) for c in ("precision_at_1", "recall_at_1")])


# Tokens ---------------------------------------------------------------------------------


def build_vocab(spark, folder):
    return vocabulary(spark, folder).select("token", "n", F.col("id").cast("bigint").alias("id"))


def encode_tokens(spark, folder):
    return encoded(spark, folder).select("doc_id", joined(F.col("tokens")).alias("tokens"))


def token_totals(spark, folder):
    return tokens.token_totals(encoded(spark, folder))


def token_windows(spark, folder):
    windows = tokens.token_windows(materialize(encoded(spark, folder), "encoded"), CONTEXT)
    return windows.select("window_id", joined(F.col("x")).alias("x"), joined(F.col("y")).alias("y"))


def random_windows(spark, folder):
    """A batch of windows that begin at drawn places of the whole stream."""
    index = tokens.index_tokens(materialize(encoded(spark, folder), "encoded"))
    windows = tokens.read_windows(index, tokens.random_starts(index, BATCH, CONTEXT, SEED), CONTEXT)
    return windows.select("window_id", "start", joined(F.col("x")).alias("x"), joined(F.col("y")).alias("y"))


QUERIES = {
    "scan_archives": scan_archives,
    "scan_records": scan_records,
    "index_records": index_records,
    "shard_files": shard_files,
    "scan_documents": scan_documents,
    "scan_url_lines": scan_url_lines,
    "sink_corpus": sink_corpus,
    "sink_documents": sink_documents,
    "sink_named_documents": sink_named_documents,
    "sink_labelled_lines": sink_labelled_lines,
    "sink_tokens": sink_tokens,
    "model_io": model_io,
    "html_to_text": html_to_text,
    "html_strip": html_strip,
    "mask_emails": mask_emails,
    "mask_phones": mask_phones,
    "mask_ips": mask_ips,
    "mask_pii": mask_pii,
    "drop_short_lines": drop_short_lines,
    "flatten_text": flatten_text,
    "normalize_text": normalize_text,
    "word_tokens": word_tokens,
    "nonblank_lines": nonblank_lines,
    "line_hash": line_hash,
    "word_ngrams": word_ngrams,
    "ngram_hash": ngram_hash,
    "gopher_stats": gopher_stats,
    "gopher_filter": gopher_filter,
    "classify_language": classify_language,
    "classify_nsfw": classify_nsfw,
    "classify_toxic": classify_toxic,
    "classify_quality": classify_quality,
    "pii_limit": pii_limit,
    "curate": curated,
    "curate_scored": curate_scored,
    "curation_funnel": curation_funnel,
    "english_gopher_docs": english_gopher_docs,
    "english_gopher_rejects": english_gopher_rejects,
    "line_counts": line_counts,
    "exact_line_dedup": exact_line_dedup,
    "minhash_signature": minhash_signature,
    "lsh_buckets": lsh_buckets,
    "candidate_pairs": candidate_pairs,
    "signature_jaccard": signature_jaccard,
    "duplicate_pairs": duplicate_pairs,
    "duplicate_clusters": duplicate_clusters,
    "fuzzy_dedup": fuzzy_dedup,
    "sample_k": sample_k,
    "split_even": split_even,
    "sample_records": sample_records,
    "balanced_training_set": balanced_training_set,
    "interleave_classes": interleave_classes,
    "random_file_order": random_file_order,
    "train_classifier": train_classifier,
    "evaluate_classifier": evaluate_classifier,
    "build_vocab": build_vocab,
    "encode_tokens": encode_tokens,
    "token_totals": token_totals,
    "token_windows": token_windows,
    "random_windows": random_windows,
}
