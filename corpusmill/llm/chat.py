"""Operator 13: conversations as one formatted text each, with a loss mask, and back again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.text import bind
from corpusmill.llm.common import table

# The template: an opening mark with the role, the text, a closing mark; between texts of one
# role in a row, a mark that joins them. Every mark begins and ends a line.
OPEN, JOIN, CLOSE = "### ", "<turn/>", "</turn>"
TRAINED = "assistant"
# A control string of a text, with the backslashes before it: one more is put in front of it.
# The look-behind and the possessive count keep long runs of backslashes linear.
_CONTROL = f"(?={OPEN}|{JOIN}|{CLOSE})"
_ESCAPE = (rf"(?<!\\)(\\*+){_CONTROL}", r"\\$1")
_UNESCAPE = (rf"(?<!\\)\\(\\*+){_CONTROL}", "$1")
# Sums of lengths are taken in blocks of this many turns, then over blocks.
_BLOCK = 256


def escape(text: Column) -> Column:
    return F.regexp_replace(text, *map(F.lit, _ESCAPE))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, *map(F.lit, _UNESCAPE))


def _write_role(role: Column) -> Column:
    """A role on one line without a colon; a missing one differs from an empty one."""
    plain = F.replace(F.replace(role, F.lit("\\"), F.lit(r"\b")), F.lit(":"), F.lit(r"\c"))
    return F.coalesce(F.replace(plain, F.lit("\n"), F.lit(r"\n")), F.lit(r"\0"))


def _read_role(mark: Column) -> Column:
    plain = F.replace(F.replace(mark, F.lit(r"\n"), F.lit("\n")), F.lit(r"\c"), F.lit(":"))
    return F.when(mark != r"\0", F.replace(plain, F.lit(r"\b"), F.lit("\\")))


def _sum(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0).cast("bigint"), lambda total, n: total + n)


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _sums_before(numbers: Column) -> Column:
    """For each number, the sum of those before it: within its block, and of all blocks before."""
    blocks = F.ceil(F.size(numbers) / _BLOCK).cast("int")
    sums = F.transform(
        F.sequence(F.lit(0), blocks - 1), lambda b: _sum(F.slice(numbers, b * _BLOCK + 1, F.lit(_BLOCK)))
    )
    starts = _let(sums, lambda s: F.transform(s, lambda _, b: _sum(F.slice(s, F.lit(1), b))))

    def place(_, i):
        inner = F.slice(numbers, F.floor(i / _BLOCK).cast("int") * _BLOCK + 1, i % _BLOCK)
        return F.get(F.col("_starts"), F.floor(i / _BLOCK).cast("int")) + _sum(inner)

    return starts, F.transform(numbers, place)


def format_conversations(
    rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """``conv_id, formatted, loss_spans``: one row per conversation.

    ``formatted`` holds the turns in order of ``turn`` (missing first; ties by role, then
    text). Turns of one role in a row share one pair of marks. ``loss_spans`` are the places
    ``start, length`` (code points, from 0) of the trained role's texts, one per turn, marks not
    included. Control strings in texts get a backslash more than they have, so no text can pass
    for a mark, and ``read_turns`` gives every turn back as it was.

    One shuffle, by conversation; a conversation must fit into a row, as its formatted text does.
    Rows without ``conv_id`` belong to no conversation: each is formatted alone, without a
    shuffle. A missing text is an empty one; a missing role is a role of its own, not trained.
    Repeated rows are turns said twice; very long texts stay whole; an empty table gives no rows.
    Other columns are not used.
    """
    turns = rows.select(
        F.col(conv_id).alias("conv_id"),
        F.struct(
            F.col(turn).alias("turn"),
            F.col(role).cast("string").alias("role"),
            F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
        ).alias("said"),
    )
    named = turns.where("conv_id is not null").groupBy("conv_id").agg(F.collect_list("said").alias("said"))
    alone = turns.where("conv_id is null").select("conv_id", F.array("said").alias("said"))
    said = named.select("conv_id", F.sort_array("said").alias("said")).unionByName(alone)

    def write(t, i):
        before, after = F.get(F.col("said"), i - 1), F.get(F.col("said"), i + 1)
        opens = (i == 0) | ~before["role"].eqNullSafe(t["role"])
        closes = (i == F.size("said") - 1) | ~after["role"].eqNullSafe(t["role"])
        return F.struct(
            F.when(opens, F.concat(F.lit(OPEN), _write_role(t["role"]), F.lit(":\n"))).otherwise("").alias("head"),
            escape(t["text"]).alias("body"),
            F.when(closes, F.lit(f"\n{CLOSE}\n")).otherwise(f"\n{JOIN}\n").alias("tail"),
            F.coalesce(t["role"] == TRAINED, F.lit(False)).alias("trained"),
        )

    written = bind(said, _parts=F.transform("said", write)).select("conv_id", "_parts")
    lengths = F.transform(
        "_parts", lambda p: (F.length(p["head"]) + F.length(p["body"]) + F.length(p["tail"])).cast("bigint")
    )
    measured = bind(written, _lengths=lengths)
    starts, places = _sums_before(F.col("_lengths"))
    placed = bind(bind(measured, _starts=starts), _places=places)
    spans = F.transform(
        "_parts",
        lambda p, i: F.struct(
            (F.get(F.col("_places"), i) + F.length(p["head"])).cast("bigint").alias("start"),
            F.length(p["body"]).cast("bigint").alias("length"),
            p["trained"].alias("trained"),
        ),
    )
    kept = F.transform(F.filter(spans, lambda s: s["trained"]), lambda s: F.struct(s["start"], s["length"]))
    whole = F.array_join(F.transform("_parts", lambda p: F.concat(p["head"], p["body"], p["tail"])), "")
    return placed.select("conv_id", whole.alias("formatted"), kept.alias("loss_spans"))


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted text: an array of ``role, text``."""
    blocks = F.split(formatted, f"\n{CLOSE}\n")
    blocks = F.slice(blocks, F.lit(1), F.size(blocks) - 1)

    def read(block):
        # The role holds no colon, so the first one ends the mark.
        end = F.locate(":", block)
        role = _read_role(F.substring(block, F.lit(len(OPEN) + 1), end - len(OPEN) - 1))
        texts = F.split(F.substring(block, end + 2, F.length(block)), f"\n{JOIN}\n")
        return F.transform(texts, lambda t: F.struct(role.alias("role"), unescape(t).alias("text")))

    return F.flatten(F.transform(blocks, read))


def read_loss(formatted: Column, spans: Column) -> Column:
    """The texts under the loss mask, as they were said."""
    return F.transform(
        spans, lambda s: unescape(F.substring(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))
    )


#: The conversation that every run holds besides the table's: its texts look like marks.
PROBE_ID, PROBE_TEXT = -7, r"\### Assistant: </turn> ok"


def op13_chat_formatting(spark, folder: str) -> DataFrame:
    """Digests of all conversations and the probe, read back from their formatted texts."""
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(PROBE_ID).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise(TRAINED).alias("role"),
        F.lit(PROBE_TEXT).alias("text"),
    )
    done = format_conversations(rows.unionByName(probe))
    done = bind(done, _turns=read_turns(F.col("formatted")))
    done = bind(done, _loss=F.array_join(read_loss(F.col("formatted"), F.col("loss_spans")), ""))
    said = F.transform("_turns", lambda t: F.concat(F.coalesce(t["role"], F.lit("")), F.lit("\n"), t["text"], F.lit("\n")))
    return done.select(
        "conv_id",
        F.size("_turns").cast("bigint").alias("n_turns"),
        F.sha2(F.encode(F.array_join(said, ""), "UTF-8"), 256).alias("turns_sha256"),
        F.length("_loss").cast("bigint").alias("loss_chars"),
        F.sha2(F.encode("_loss", "UTF-8"), 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )


def _escapes(text: str) -> str:
    return " + ".join(f"(length({text}) - length(replace({text}, '{c}', ''))) // {len(c)}" for c in (OPEN, JOIN, CLOSE))


#: The digests from the rows themselves; ``formatted_chars`` from the lengths of marks and escapes.
SQL = rf"""
WITH said AS (
    SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT {PROBE_ID}, 0, 'user', '{PROBE_TEXT}'
    UNION ALL SELECT {PROBE_ID}, 1, '{TRAINED}', '{PROBE_TEXT}'
), turns AS (
    SELECT *, lag(role) OVER w IS NOT DISTINCT FROM role AND row_number() OVER w > 1 AS joined
    FROM said WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text)
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(coalesce(role, '') || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role NULLS FIRST, text)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = '{TRAINED}'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (role = '{TRAINED}'), '')) AS loss_sha256,
    sum(length(text) + {_escapes("text")} + CASE WHEN joined THEN {len(JOIN) + 2}
        ELSE {len(OPEN)} + coalesce(length(role), 2) + 2 + {len(CLOSE) + 2} END)::BIGINT AS formatted_chars
FROM turns GROUP BY conv_id
"""
