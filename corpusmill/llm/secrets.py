"""Operator 1: secrets in texts, found by one automaton for all rules."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from corpusmill.llm.automaton import Automaton, Rule
from corpusmill.llm.common import id_and_text, record_batch, table, text_bytes, text_slices

# What the contract calls a secret.
_VALUE = "[A-Za-z0-9+/_.=-]"


def _either_case(words: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in words)


_KEY = f"({_either_case('password|passwd|secret|token|api_?key')})" + r"[\"']?\x20*[:=]\x20*[\"']?"
BASE = (
    Rule("assign", _KEY + _VALUE + "+", _KEY + _VALUE + "{8,}"),
    Rule("access", "AKIA[A-Z0-9]+", "AKIA[A-Z0-9]{12,}"),
    Rule("hex", "[0-9a-f]+", "[0-9a-f]{32,}", quiet=True),
)
# Publicly documented forms of credentials.
MORE = (
    Rule("github", "gh[opsu]_[A-Za-z0-9]+", "gh[opsu]_[A-Za-z0-9]{36,}"),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]+", "xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", "AIza[A-Za-z0-9_-]+", "AIza[A-Za-z0-9_-]{35,}"),
    Rule("payment", "sk_live_[A-Za-z0-9]+", "sk_live_[A-Za-z0-9]{16,}"),
    Rule("private_key", "-----BEGIN [A-Z ]*PRIVATE KEY-----", "-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)
RULES = BASE + MORE

_SCHEMA = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("kind", pa.list_(pa.string())),
        ("start", pa.list_(pa.int64())),
        ("end", pa.list_(pa.int64())),
        ("match", pa.list_(pa.string())),
    ]
)
_FOUND = T.StructType(
    [T.StructField("doc_id", T.LongType())]
    + [T.StructField(n, T.ArrayType(T.StringType() if n in ("kind", "match") else T.LongType())) for n in ("kind", "start", "end", "match")]
)


def scan_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, kind, start, end, match``: one row per input row, with parallel arrays of the
    secrets found, by start and then by the rules' order. Places are code points, end exclusive.

    No shuffle, one pass over the bytes. A missing or empty text has empty arrays; repeated
    rows give repeated results; other columns are ignored. The automaton is compiled on the
    driver and sent to the tasks; its size depends on the rules alone.
    """
    shared = docs.sparkSession.sparkContext.broadcast(Automaton(rules))

    def scan(batches):
        automaton = shared.value
        for batch in text_slices(batches):
            data, offsets = text_bytes(batch.column(1))
            count = len(offsets) - 1
            # A byte that no text holds ends each text.
            spread = np.full(len(data) + count, 0xFF, np.uint8)
            spread[np.arange(len(data)) + np.repeat(np.arange(count), np.diff(offsets))] = data
            begin = offsets[:-1] + np.arange(count)
            places, masks = automaton.events(spread)
            rows: list[list] = [[] for _ in range(count)]
            owner = np.searchsorted(begin, places, side="right") - 1
            edges = np.flatnonzero(np.diff(owner, prepend=-1, append=-1))
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                row = int(owner[a])
                raw = data[offsets[row] : offsets[row + 1]].tobytes()
                points = np.concatenate([[0], np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)])
                ends = zip((places[a:b] - begin[row]).tolist(), masks[a:b].tolist(), strict=True)
                rows[row] = [
                    (rules[k].name, int(points[s]), int(points[e]), raw[s:e].decode())
                    for s, k, e in automaton.spans(raw, list(ends))
                ]
            columns = [[[span[i] for span in row] for row in rows] for i in range(4)]
            yield record_batch(_SCHEMA, batch.column(0), *columns)

    return id_and_text(docs, doc_id, text).mapInArrow(scan, _FOUND)


_DIGEST = T.StructType(
    [T.StructField("doc_id", T.LongType())]
    + [T.StructField(f"n_{r.name}", T.LongType()) for r in BASE]
    + [T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType())]
)


def op1_secrets(spark, folder: str) -> DataFrame:
    """The digest of ``scan_secrets`` over all documents."""
    names = [r.name for r in BASE]

    def digest(batches):
        for batch in batches:
            out: list[list] = [[] for _ in range(6)]
            for row in batch.to_pylist():
                spans = list(zip(row["kind"], row["start"], row["end"], strict=True))
                base = [s for s in spans if s[0] in names]
                for column, value in zip(
                    out,
                    [
                        row["doc_id"],
                        *(sum(s[0] == n for s in base) for n in names),
                        hashlib.sha256(",".join("%s:%d:%d" % s for s in base).encode()).hexdigest(),
                        ",".join("%s:%d:%d" % s for s in spans),
                    ],
                    strict=True,
                ):
                    column.append(value)
            kinds = [pa.int64()] * 4 + [pa.string()] * 2
            arrays = [pa.array(c, k) for c, k in zip(out, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=_DIGEST.names)

    return scan_secrets(table(spark, folder, "documents")).mapInArrow(digest, _DIGEST)


def _sql() -> str:
    """Matches between two marks that no text holds; what stands before a mark gives its place."""
    parts = []
    # RE2 has the same syntax; repeated marks of groups do no harm.
    for order, rule in enumerate(RULES):
        pattern, keep = (p.replace("'", "''") for p in (rule.pattern, rule.keep))
        parts.append(
            f"""SELECT doc_id, {order} AS rule, '{rule.name}' AS kind, u.piece, u.pos,
            regexp_full_match(split_part(u.piece, chr(57345), 1), '{keep}') AS fits
            FROM (SELECT doc_id, string_split(regexp_replace(text, '({pattern})', chr(57344) || '\\1' || chr(57345), 'g'),
            chr(57344)) AS pieces FROM d), LATERAL (SELECT unnest(pieces) AS piece, generate_subscripts(pieces, 1) AS pos) u"""
        )
    return f"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
    pieces AS ({' UNION ALL '.join(parts)}),
    placed AS (SELECT *, length(split_part(piece, chr(57345), 1)) AS size,
        coalesce(sum(length(replace(piece, chr(57345), ''))) OVER (PARTITION BY doc_id, rule ORDER BY pos
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS s FROM pieces),
    spans AS (SELECT doc_id, rule, kind, s, kind || ':' || s || ':' || (s + size) AS span
        FROM placed WHERE pos > 1 AND fits)
    SELECT d.doc_id, count(*) FILTER (WHERE kind = 'assign') AS n_assign, count(*) FILTER (WHERE kind = 'access') AS n_access,
        count(*) FILTER (WHERE kind = 'hex') AS n_hex,
        sha256(coalesce(string_agg(span, ',' ORDER BY s, rule) FILTER (WHERE rule < 3), '')) AS base_sha256,
        coalesce(string_agg(span, ',' ORDER BY s, rule), '') AS spans
    FROM d LEFT JOIN spans USING (doc_id) GROUP BY d.doc_id"""


SQL = _sql()
