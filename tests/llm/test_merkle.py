"""Hash trees against plain ones, with odd inputs."""

from __future__ import annotations

import random
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from corpusmill.llm import merkle

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, place int, grp string, node string"


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def plain_leaf(doc, text, lang, source, n):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc, source, lang, n, text)))


def plain_tree(nodes):
    """The root, and for each leaf the digests before and after it at every level."""
    ways, places = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for leaf, at in enumerate(places):
            first = at // 8 * 8
            ways[leaf].append(("".join(nodes[first:at]), "".join(nodes[at + 1 : first + 8])))
        nodes = [h(*nodes[i : i + 8]) for i in range(0, len(nodes), 8)]
        places = [at // 8 for at in places]
    return (nodes[0] if nodes else None), ways


def plain_manifest(rows):
    groups: dict = {}
    for doc, text, lang, source, n, *_ in rows:
        groups.setdefault(lang, []).append((doc is not None, doc or 0, plain_leaf(doc, text, lang, source, n)))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: plain_tree([leaf for *_, leaf in sorted(groups[g])]) for g in names}
    root, above = plain_tree([trees[g][0] for g in names])
    out = []
    for g, up in zip(names, above, strict=True):
        for (has, doc, leaf), way in zip(sorted(groups[g]), trees[g][1], strict=True):
            out.append((doc if has else None, leaf, trees[g][0], root, tuple(way + up)))
    return out


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "g", "n") for r in rows], SCHEMA)


def got(manifest):
    rows = merkle.proofs(manifest).collect()
    return [(r.key, r.leaf, r.subroot, r.root, tuple((s.before, s.after) for s in r.way)) for r in rows]


def some_rows(rng, sizes):
    rows = []
    for lang, size in sizes.items():
        rows += [(rng.randrange(10**6), rng.choice(["Text é", "a", "", None, "B" * 50]), lang, rng.choice(["web", None]), rng.choice([1, -5, None])) for _ in range(size)]
    return rows


@pytest.mark.parametrize("height", [1, 2])
def test_proofs_are_those_of_a_plain_tree(spark, height):
    rng = random.Random(height)
    # Full and broken runs on every level; a missing, an empty and a non-ASCII group; ties; repeated rows.
    rows = some_rows(rng, {"en": 1100, None: 9, "": 1, "é": 8, "z": 64, "zz": 65, "Z": 513})
    rows += [(None, "no id", "en", None, None)] * 3 + rows[:4] + [(5, "x" * 300_000, "de", "s", 1)]
    manifest = merkle.build_manifest(table(spark, rows), merkle.FIELDS, height=height)
    assert sorted(map(repr, got(manifest))) == sorted(map(repr, plain_manifest(rows)))


def test_many_groups_and_one_leaf(spark):
    rows = some_rows(random.Random(3), {f"g{i}": 1 + i % 3 for i in range(150)})
    assert sorted(map(repr, got(merkle.build_manifest(table(spark, rows), merkle.FIELDS, height=1)))) == sorted(map(repr, plain_manifest(rows)))
    one = [(7, "alone", None, None, None)]
    row = merkle.check_rows(merkle.build_manifest(table(spark, one), merkle.FIELDS)).first()
    assert row.leaf == row.subroot == row.root == row.folded_root == plain_leaf(*one[0]) and row.proof_sha256 == h("")
    assert merkle.check_rows(merkle.build_manifest(table(spark, []), merkle.FIELDS)).count() == 0


def test_a_changed_row_is_found_and_no_other(spark):
    rows = some_rows(random.Random(4), {"en": 700, "de": 30})
    changed = F.when(F.col("doc_id") % 5 == 0, F.lower("text"))
    done = merkle.check_rows(merkle.build_manifest(table(spark, rows), merkle.FIELDS, changed=changed, height=2)).collect()
    at = {plain_leaf(*r): r for r in rows}
    plain = {leaf: (root, way) for _, leaf, _, root, way in plain_manifest(rows)}
    for r in done:
        doc, text, *rest = at[r.leaf]
        now = text.lower() if text is not None and doc % 5 == 0 else text
        assert r.verified == (now == text)
        root, way = plain[r.leaf]
        if list(at).count(r.leaf) == 1 and sum(x.leaf == r.leaf for x in done) == 1:
            assert r.folded_root == merkle.fold(plain_leaf(doc, now, *rest), way)
            assert r.proof_sha256 == h(*(b + a for b, a in way)) and r.root == root
