import gzip

import pytest
from pyspark.sql import functions as F

from corpusmill.__main__ import main, parser
from corpusmill.operators import classify, sampling, tokens
from corpusmill.plans import curate, jobs
from corpusmill.sources import archives, files

ENGLISH = "This is a plain English sentence which is long enough to pass every rule of the filter. "
GERMAN = "Das ist ein einfacher deutscher Satz, der lang genug ist, um jede Regel zu bestehen. "


def page(kind, i):
    body = {
        "good": ENGLISH * 8 + f"<p>Write to user{i}@mail.example about this page if you would like to know more.</p><p>short</p>",
        "german": GERMAN * 8,
        "toxic": ENGLISH * 8 + "moron " * 5,
        "junk": "buy now cheap " * 40,
        "short": "Read the plain English sentence.",
        "pii": "<br>".join([ENGLISH] * 8 + [f"the host at address 10.0.{j}.1 answers to a plain English request" for j in range(60)]),
    }[kind]
    return f"<html><head><title>t</title></head><body><p>{body}</p></body></html>"


def write(path, kinds):
    path.parent.mkdir(parents=True, exist_ok=True)
    with open(path, "wb") as out:
        for i, kind in enumerate(kinds):
            block = b"HTTP/1.1 200 OK\r\n\r\n" + page(kind, i).encode()
            head = (
                f"WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: http://x/{kind}/{i}\r\n"
                f"Content-Type: application/http\r\nContent-Length: {len(block)}\r\n\r\n"
            )
            out.write(gzip.compress(head.encode() + block + b"\r\n\r\n"))


@pytest.fixture(scope="module")
def models(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("models")
    sets = {
        "language": [("en", ENGLISH), ("en", "buy now cheap moron read the"), ("de", GERMAN)],
        "quality": [("wiki", ENGLISH), ("wiki", GERMAN), ("wiki", "moron the host at address"), ("cc", "buy now cheap")],
        "toxic": [("non-toxic", ENGLISH), ("non-toxic", GERMAN), ("non-toxic", "buy now cheap"), ("toxic", "moron " * 5 + ENGLISH)],
    }
    for name, rows in sets.items():
        df = spark.createDataFrame(rows * 10, "label string, text string")
        classify.save_model(classify.train_classifier(df), str(root / name))
    return {name: str(root / name) for name in sets}


def test_curate_crawl(spark, models, tmp_path):
    write(tmp_path / "in" / "a.warc.filtered.gz", ["good", "good", "german", "toxic", "junk", "short", "pii"])
    write(tmp_path / "in" / "deep" / "b.warc.filtered.gz", ["good", "junk"])
    report = jobs.curate_crawl(
        spark, str(tmp_path / "in"), str(tmp_path / "corpus"), models["quality"], models["language"], models["toxic"]
    )
    rows = {r.file.rsplit("/", 1)[1][0]: r.asDict() for r in report.collect()}
    for row in rows.values():
        row.pop("file")
    assert rows == {
        "a": {"total": 7, "quality": 1, "language": 1, "toxic": 1, "gopher": 1, "pii": 1, "passed": 2},
        "b": {"total": 2, "quality": 1, "language": 0, "toxic": 0, "gopher": 0, "pii": 0, "passed": 1},
    }
    kept = [r.text for r in files.read_corpus(spark, str(tmp_path / "corpus")).collect()]
    assert len(kept) == 3
    assert all("|||EMAIL_ADDRESS|||" in t and "@" not in t and "short" not in t for t in kept)

    loaded = [classify.load_model(models[k]) for k in ("quality", "language", "toxic")]
    docs = jobs.crawl_documents(spark, str(tmp_path / "in"))
    assert sorted(r.text for r in curate.curate_scored(docs, *loaded).collect()) == sorted(kept)

    total = jobs.tokenize_corpus(spark, str(tmp_path / "corpus"), str(tmp_path / "tokens")).first().total_tokens
    written = spark.read.parquet(str(tmp_path / "tokens"))
    assert total == tokens.token_totals(written).first().total_tokens > 100


def test_training_jobs(spark, models, tmp_path):
    write(tmp_path / "pos" / "p.warc.gz", ["good"] * 6 + ["german"] * 3)
    write(tmp_path / "neg" / "n.warc.gz", ["toxic"] * 20 + ["short"] * 3)
    lines, turns = str(tmp_path / "lines"), str(tmp_path / "turns")
    jobs.create_dataset(spark, str(tmp_path / "pos"), str(tmp_path / "neg"), lines, models["language"])
    written = [r.value for r in spark.read.text(lines).collect()]
    assert sorted(w.split()[0] for w in written) == ["__label__cc"] * 6 + ["__label__wiki"] * 6
    jobs.shuffle_dataset(spark, lines, turns)
    assert sorted(r.value for r in spark.read.text(turns).collect()) == sorted(written)
    row = jobs.train_model(spark, turns, lines, str(tmp_path / "model")).first()
    assert (row.n, row.precision_at_1) == (12, 1.0)


def test_archives_beyond_the_limit_are_not_read(spark, models, tmp_path):
    for i in range(60):
        write(tmp_path / "in" / f"{i:02}.warc.gz", ["good", "toxic", "short", "german"])
    # Whoever opens one of these fails.
    for i in range(50, 60):
        (tmp_path / "in" / f"{i:02}.warc.gz").write_bytes(gzip.compress(b"WARC/1.0\r\nWARC-Type: response\r\nContent-Length: 99\r\n\r\nshort"))
    listed = archives.scan_archives(spark, str(tmp_path / "in"), ".gz")
    with pytest.raises(Exception, match="ends .* bytes before"):
        jobs.documents_from_archives(spark, listed).count()

    def found(**options):
        return [r.doc_id.rsplit("/", 1)[1] for r in jobs.documents_from_archives(spark, listed, models["language"], **options).collect()]

    plain = found(max_len=41)
    assert len(plain) == 41 and {d[:2] for d in plain} == {f"{i:02}" for i in range(11)}
    assert sum(d.startswith("10") for d in plain) == 1
    judged = found(max_len=41, quality_filter=True)
    assert len(judged) == 41 and {d[:2] for d in judged} == {f"{i:02}" for i in range(21)}


def test_files_read_are_counted(spark, tmp_path):
    files_ = spark.range(1, 401).select(F.concat(F.lit("f"), "id").alias("path"), F.col("id").alias("position"))
    seen = spark.sparkContext.accumulator(0)

    def accept(part):
        def read(batches):
            for batch in batches:
                seen.add(batch.num_rows)
                yield batch

        rows = part.select("path", "position").coalesce(1).mapInArrow(read, "path string, position bigint")
        # Every third file gives three rows, others none.
        return rows.where("position % 3 = 0").select("path", F.explode(F.sequence(F.lit(1), F.lit(3))).alias("doc_id"))

    got = sampling.first_accepted(files_, accept, 31, ["doc_id"]).collect()
    want = [(p, d) for p in range(3, 401, 3) for d in (1, 2, 3)][:31]
    assert sorted((r.position, r.doc_id) for r in got) == want
    assert 33 <= seen.value < 100
    assert sampling.first_accepted(files_, accept, 10_000, ["doc_id"]).count() == 399
    assert sampling.first_accepted(files_, accept, 0, ["doc_id"]).count() == 0


def test_first_documents_in_id_order(spark):
    docs = spark.range(1000).select(F.col("id").alias("doc_id"), F.lit("en").alias("lang"), F.lit("x").alias("text"))
    got = curate.english_gopher_docs(docs.repartition(7), 123, quality_filter=False)
    assert sorted(r.doc_id for r in got.collect()) == list(range(123))
    assert curate.english_gopher_docs(docs, 123).count() == 0


def test_choose_urls_from_the_command_line(spark, tmp_path):
    with gzip.open(tmp_path / "urls.gz", "wt") as out:
        out.write("\n".join(f" http://x/{i} " for i in range(100)))
    main(["choose-urls", "--lines", str(tmp_path / "urls.gz"), "--folder", str(tmp_path / "parts"), "--samples", "50", "--num-files", "7"])
    rows = spark.read.text(str(tmp_path / "parts")).collect()
    counts = [sum(r.part == p for r in rows) for p in range(7)]
    assert counts == [7] * 7 and len({r.value for r in rows}) == 49


def test_every_job_has_options():
    assert parser().parse_args(["train-model", "--lines", "a", "--valid", "b", "--model", "c"]).model == "c"
