import gzip
import os

import pyarrow as pa
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from corpusmill.sources import archives, files, listing, named


def record(i, kind="response"):
    body = f"<p>page {i}</p>" * (i % 40) + ("\r\n\r\n" if i % 3 else "")
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n{body}".encode()
    head = (
        f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Target-URI: http://site.example/{i}\r\n"
        f"Content-Type: application/http; msgtype={kind}\r\nContent-Length: {len(block)}\r\n\r\n"
    )
    return body.encode(), head.encode() + block + b"\r\n\r\n"


@pytest.fixture(scope="module")
def crawl(tmp_path_factory):
    root = tmp_path_factory.mktemp("crawl")
    (root / "b" / "c").mkdir(parents=True)
    with open(root / "b" / "many.warc.filtered.gz", "wb") as out:
        for i in range(400):
            out.write(gzip.compress(record(i, "response" if i % 4 else "request")[1]))
    with gzip.open(root / "b" / "c" / "one.warc.filtered.gz", "wb") as out:
        for i in range(400, 600):
            out.write(record(i)[1])
    with gzip.open(root / "plain.gz", "wb") as out:
        out.write(b" http://a.example \nhttp://b.example\t\n\n")
    return root


def test_listing(spark, crawl):
    found = archives.scan_archives(spark, str(crawl)).collect()
    assert [r.path for r in found] == [
        f"{crawl}/b/c/one.warc.filtered.gz",
        f"{crawl}/b/many.warc.filtered.gz",
    ]
    assert archives.scan_archives(spark, f"file://{crawl}", ".gz").count() == 3


@pytest.mark.parametrize("split", [1 << 27, 4096, 700])
def test_records_do_not_depend_on_the_splits(spark, crawl, split):
    read = archives.scan_records(spark, str(crawl), split_bytes=split)
    got = read.select("url", "content", "file", "record_no").collect()
    want = {f"http://site.example/{i}": record(i)[0] for i in range(600) if i >= 400 or i % 4}
    assert {r.url: bytes(r.content) for r in got} == want
    assert len(got) == len(want) == len({(r.file, r.record_no) for r in got})


def test_all_types_and_slices(spark, crawl):
    assert archives.scan_records(spark, str(crawl), warc_type=None).count() == 600
    assert archives.scan_records(spark, str(crawl), first=1).count() == 300
    assert archives.scan_records(spark, str(crawl), first=0, count=1).count() == 200


def test_url_lines(spark, crawl):
    lines = files.scan_url_lines(spark, f"{crawl}/plain.gz")
    assert [r.url for r in lines.orderBy("line_no").collect()] == ["http://a.example", "http://b.example", ""]


def test_documents(spark, tmp_path):
    (tmp_path / "x.txt").write_bytes(b"one\r\ntwo\rthree\n")
    (tmp_path / "empty.txt").write_bytes(b"")
    got = {r.file_name: r.text for r in files.scan_documents(spark, str(tmp_path)).collect()}
    assert got == {"x.txt": "one\ntwo\nthree\n", "empty.txt": ""}


def test_shards(spark):
    paths = spark.createDataFrame([(f"d/{i:03}",) for i in range(50)] * 2, "path string")
    got = sorted(tuple(r) for r in files.shard_files(paths, 10, 5).collect())
    assert got == [(f"d/{i:03}", i) for i in range(10, 15)]


def test_corpus_is_appended(spark, tmp_path):
    docs = spark.createDataFrame([("a\n\nb",), ("",), ("c <|endoftext|> d",)], "text string")
    for _ in range(2):
        files.sink_corpus(docs, str(tmp_path / "corpus"))
    got = sorted(r.text for r in files.read_corpus(spark, str(tmp_path / "corpus")).collect())
    assert got == sorted(["a\n\nb", "", "c <|endoftext|> d"] * 2)


def test_labelled_lines(spark, tmp_path):
    rows = [("__label__wiki", "a b"), ("__label__cc", "")]
    files.sink_labelled_lines(spark.createDataFrame(rows, "label string, text string"), str(tmp_path / "l"))
    assert sorted(tuple(r) for r in files.read_labelled_lines(spark, str(tmp_path / "l")).collect()) == sorted(rows)


def test_tokens_have_16_bits(spark, tmp_path):
    good = spark.createDataFrame([(1, [0, 65535]), (2, [])], "doc_id bigint, tokens array<int>")
    for _ in range(2):
        assert files.sink_tokens(good, str(tmp_path / "t")).first().total_tokens == 2
    bad = good.withColumn("tokens", F.array(F.lit(65536)))
    with pytest.raises(Exception, match="16 bits"):
        files.sink_tokens(bad, str(tmp_path / "u")).collect()


def test_indexed_records_are_read_alone(spark, crawl, tmp_path):
    listed = archives.scan_archives(spark, str(crawl))
    index = archives.index_records(listed, split_bytes=4096)
    every = {(r.file, r.record_no): r for r in archives.scan_records(spark, str(crawl), warc_type=None).collect()}
    rows = index.collect()
    assert {(r.file, r.record_no) for r in rows} == set(every) and all(r.missing == 0 for r in rows)
    again = archives.read_indexed(index).collect()
    assert {(r.file, r.record_no): r for r in again} == every and len(again) == len(every)

    # After the index is made, all but the drawn members are overwritten: no other is unpacked.
    copy = tmp_path / "many.warc.filtered.gz"
    data = bytearray((crawl / "b" / "many.warc.filtered.gz").read_bytes())
    copy.write_bytes(data)
    index = archives.index_records(archives.scan_archives(spark, str(tmp_path))).collect()
    drawn = [r for r in index if r.warc_type == "response"][5:300:37]
    ends = {r.member: e.member for r, e in zip(index, index[1:])} | {index[-1].member: len(data)}
    blank = bytearray(len(data))
    for r in drawn:
        blank[r.member : ends[r.member]] = data[r.member : ends[r.member]]
    copy.write_bytes(blank)
    got = archives.read_indexed(spark.createDataFrame(drawn, archives._INDEX)).collect()
    assert {r.url: bytes(r.content) for r in got} == {r.url: record(int(r.url.rsplit("/", 1)[1]))[0] for r in drawn}


def test_drawn_records(spark, crawl):
    listed = archives.scan_archives(spark, str(crawl))
    got = archives.sample_archives(listed, 30, seed=3).collect()
    assert len({(r.file, r.record_no) for r in got}) == 30
    assert all(bytes(r.content) == record(int(r.url.rsplit("/", 1)[1]))[0] for r in got)
    assert archives.sample_archives(listed, 30, seed=3).count() == 30
    assert archives.sample_archives(listed, 10_000).count() == 500


@pytest.mark.parametrize("cut", [5, 40, 90])
def test_cut_off_records_are_an_error_or_counted(spark, tmp_path, cut):
    members = [gzip.compress(record(i)[1]) for i in range(1, 6)]
    (tmp_path / "a.warc.filtered.gz").write_bytes(b"".join(members)[: -len(members[-1]) + cut])
    listed = archives.scan_archives(spark, str(tmp_path))
    index = archives.index_records(listed).collect()
    assert [r.missing > 0 for r in index] == [False] * 4 + [True]
    with pytest.raises(Exception, match="ends .* bytes before"):
        archives.scan_records(spark, str(tmp_path)).collect()
    assert archives.scan_records(spark, str(tmp_path), truncated="skip").count() == 4


def test_trees_are_listed_by_tasks(spark, tmp_path):
    for i in range(40):
        folder = tmp_path / f"d{i % 7}" / f"e{i % 3}"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"f{i}.txt").write_text("x" * i)
    (tmp_path / "_skipped").mkdir()
    (tmp_path / "_skipped" / "g.txt").write_text("no")
    (tmp_path / "empty").mkdir()
    listed = listing.list_tree(spark, str(tmp_path), hidden=False).collect()
    assert {r.path.rsplit("/", 1)[1]: r.n_bytes for r in listed} == {f"f{i}.txt": i for i in range(40)}
    assert listing.list_tree(spark, str(tmp_path)).count() == 41
    assert listing.list_tree(spark, f"{tmp_path}/_skipped/g.txt").count() == 1
    docs = files.scan_documents(spark, str(tmp_path), "f?.txt").collect()
    assert {r.file_name: r.text for r in docs} == {f"f{i}.txt": "x" * i for i in range(10)}


def test_documents_under_their_own_names(spark, tmp_path):
    target = tmp_path / "out"
    target.mkdir()
    (target / "other.txt").write_text("stays")
    rows = [(f"d{i % 3}/doc {i}.txt", "é" * i if i % 5 else ("" if i % 2 else None)) for i in range(60)]
    docs = spark.createDataFrame(rows, "file_name string, text string")
    named.sink_named_documents(docs, str(target), tasks=7)
    found = {str(p.relative_to(target)): p.read_text() for p in target.rglob("*.txt")}
    assert found == {n: t or "" for n, t in rows} | {"other.txt": "stays"}
    assert sorted(p.name for p in target.iterdir()) == ["_SUCCESS", "d0", "d1", "d2", "other.txt"]
    # Again with other texts: whole files take the place of the old ones.
    named.sink_named_documents(docs.withColumn("text", F.lit("new")), str(target))
    assert {p.read_text() for p in target.rglob("doc*.txt")} == {"new"}
    for bad in ["", "/abs", "../up", "a//b", None]:
        with pytest.raises(Exception, match="name"):
            named.sink_named_documents(spark.createDataFrame([(bad, "x"), ("ok", "y")], docs.schema), str(tmp_path / "bad"))
    with pytest.raises(ValueError, match="name"):
        named.sink_named_documents(docs.unionAll(docs.limit(1)), str(tmp_path / "bad"))
    assert all(p.name.startswith("_staging-") for p in (tmp_path / "bad").glob("*"))
    assert not (tmp_path / "up").exists() and files.scan_documents(spark, str(target), "other.txt").count() == 1


def test_a_failed_attempt_leaves_nothing(spark, tmp_path):
    """The first attempt of a task writes some files and ends in an error; the second one goes through."""
    writer = named.StagingWriter({"path": f"{tmp_path}/out/_staging"})
    rows = [Row(name=f"{i}.txt", content=b"x" * i) for i in range(10)]

    def failing():
        yield from rows[:4]
        raise OSError("lost")

    with pytest.raises(OSError):
        writer.write(failing())
    messages = [writer.write(iter(rows)), writer.write(iter([])), None]
    writer.commit(messages)
    # Moved twice, as a repeated task would.
    for _ in range(2):
        list(named._move(f"{tmp_path}/out")([pa.record_batch({"staged": [messages[0].folder]})]))
    assert sorted(p.name for p in (tmp_path / "out").glob("*.txt")) == [f"{i}.txt" for i in range(10)]
    assert all((tmp_path / "out" / f"{i}.txt").read_bytes() == b"x" * i for i in range(10))
    writer.abort(messages)
    assert not (tmp_path / "out" / "_staging").exists()


def test_scanned_documents_lie_in_few_folders(spark, tmp_path):
    from urllib.parse import urlparse

    from checks.queries import FOLDERS, QUERIES
    from corpusmill.session import scratch_root

    rows = [(i, f"text {i}\nof two lines") for i in range(600)] + [(600, None), (601, ""), (602, "ends\n"), (603, "a\r\nb")]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    root = urlparse(scratch_root(spark)).path
    before = set(os.listdir(root))
    found = {r.doc_id: r.text for r in QUERIES["scan_documents"](spark, str(tmp_path)).collect()}
    assert found == dict(rows) | {600: "", 603: "a\nb"}
    made = [name for name in set(os.listdir(root)) - before if name.startswith("documents")]
    assert 0 < sum(len(folders) for name in made for _, folders, _ in os.walk(os.path.join(root, name))) <= FOLDERS
