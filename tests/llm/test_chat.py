"""Conversations against a plain formatter, with odd inputs."""

from __future__ import annotations

import random

import duckdb
import pytest

from checks.compare import bag
from corpusmill.llm import chat

SCHEMA = "conv_id bigint, turn bigint, role string, text string, formatted string, said string"
BITS = ["### ", "</turn>", "<turn/>", "\\", "\\\\", "\n", ":", "a", "é", "😀", "#", "<", "user", " "]


def said(rng, most=12):
    return "".join(rng.choice(BITS) for _ in range(rng.randrange(most)))


def conversations(rng):
    rows = []
    for conv in range(60):
        for turn in range(rng.choice([1, 2, 5, 9, 600 if conv == 3 else 3])):
            role = rng.choice(["user", "assistant", "assistant", "system", said(rng, 4), None, ""])
            rows.append((conv, rng.choice([turn, turn, None]), role, rng.choice([said(rng), said(rng), None]), "x", None))
    rows += rows[:5]
    return rows + [(None, 1, "assistant", "alone", None, None), (None, 1, "assistant", "alone", None, None)]


def in_order(rows):
    def place(row):
        _, turn, role, text, *_ = row
        return turn is not None, turn or 0, role is not None, role or "", text or ""

    out: dict = {}
    for n, row in enumerate(rows):
        out.setdefault(("alone", n) if row[0] is None else row[0], []).append(row)
    return {k: sorted(v, key=place) for k, v in out.items()}


@pytest.fixture(scope="module")
def formatted(spark):
    rows = conversations(random.Random(5))
    done = chat.format_conversations(spark.createDataFrame(rows, SCHEMA))
    done = done.select(
        "*", chat.read_turns(done.formatted).alias("turns"), chat.read_loss(done.formatted, done.loss_spans).alias("loss")
    )
    return rows, done.collect()


def test_every_turn_is_read_back(formatted):
    rows, done = formatted
    wanted = sorted(repr((v[0][0], [(r[2], r[3] or "") for r in v])) for v in in_order(rows).values())
    assert sorted(repr((r.conv_id, [(t.role, t.text) for t in r.turns])) for r in done) == wanted


def test_the_loss_mask_covers_the_trained_texts_alone(formatted):
    rows, done = formatted
    wanted = sorted(repr((v[0][0], [r[3] or "" for r in v if r[2] == "assistant"])) for v in in_order(rows).values())
    assert sorted(repr((r.conv_id, r.loss)) for r in done) == wanted
    for r in done:
        ends = [0, *(s.start + s.length for s in r.loss_spans)]
        assert all(a < s.start for a, s in zip(ends, r.loss_spans, strict=False)) and ends[-1] <= len(r.formatted)


def test_one_pair_of_marks_for_turns_of_one_role_in_a_row(formatted):
    rows, done = formatted
    for r in done:
        roles = [t.role for t in r.turns]
        runs = sum(n == 0 or roles[n - 1] != role for n, role in enumerate(roles))
        assert r.formatted.count(f"\n{chat.CLOSE}\n") == runs


def test_long_runs_of_backslashes_and_an_empty_table(spark):
    text = "\\" * 300_000 + "x" + "\\" * 300_000 + "</turn>" + "### " * 50_000
    done = chat.format_conversations(spark.createDataFrame([(1, 1, "assistant", text, None, None)], SCHEMA))
    assert done.select(chat.read_loss(done.formatted, done.loss_spans).alias("loss")).first().loss == [text]
    assert chat.format_conversations(spark.createDataFrame([], SCHEMA)).count() == 0


def test_digests_equal_the_sql(spark, tmp_path):
    rows = [r for r in conversations(random.Random(6)) if r[0] is not None and r[2] in ("user", "assistant", "system", None)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    got = chat.op13_chat_formatting(spark, str(tmp_path))
    database = duckdb.connect()
    database.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    cursor = database.execute(chat.SQL)
    wanted, columns = cursor.fetchall(), [c[0] for c in cursor.description]
    assert bag(got.columns, got.collect()) == bag(columns, wanted)
