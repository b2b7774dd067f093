"""Operator 11: a hash tree over a table, with each row's proof, by a butterfly exchange."""

from __future__ import annotations

from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from corpusmill.llm.common import partitions, record_batch, table
from corpusmill.session import materialize

# Children of a node, and the levels of a block: the leaves that one task hashes alone.
FANOUT, HEIGHT = 8, 4
_LEVEL = "struct<before:string, after:string>"
_UPPER = f"array<{_LEVEL}>"


def _h(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def _levels(n: int) -> int:
    """The levels above ``n`` nodes."""
    count = 0
    while n > 1:
        n, count = -(-n // FANOUT), count + 1
    return count


def _parents(nodes: list[str]) -> list[str]:
    return [_h("".join(nodes[i : i + FANOUT])) for i in range(0, len(nodes), FANOUT)]


def leaf_hash(*fields: Column) -> Column:
    """The digest of a row: each field as ``-`` if missing, else its byte count, a colon and itself."""
    texts = [f.cast("string") for f in fields]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.encode(F.concat(*parts), "UTF-8"), 256)


def _numbered(leaves: DataFrame) -> DataFrame:
    """Each leaf's ``place`` in its group and the group's size ``n``: places within ranges of the
    whole order, and a table of one row per range and group that says where each begins."""

    def number(batches):
        last, count = None, 0
        for batch in batches:
            places = []
            for name in batch.column("grp").to_pylist():
                last, count = name, count + 1 if name == last else 0
                places.append(count)
            yield batch.append_column("inner", pa.array(places, pa.int64()))

    # The tie comes last, so a crowd of equal rows is spread over ranges too.
    tied = materialize(leaves.withColumn("tie", F.monotonically_increasing_id()), "merkle-leaves")
    order = ("grp", "key", "leaf", "tie")
    ranged = tied.repartitionByRange(partitions(leaves.sparkSession), *order).sortWithinPartitions(*order)
    ranged = ranged.drop("tie").withColumn("span", F.spark_partition_id())
    schema = ranged.withColumn("inner", F.lit(0).cast("bigint")).schema
    ranged = materialize(ranged.mapInArrow(number, schema), "merkle-ranges")
    sizes = ranged.groupBy("span", "grp").agg(F.count("*").alias("rows"))
    of = Window.partitionBy("grp")
    before = of.orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        "span", "grp", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("begin"), F.sum("rows").over(of).alias("n")
    )
    placed = ranged.join(starts, ["span", "grp"])
    return placed.withColumn("place", F.col("begin") + F.col("inner")).drop("span", "inner", "begin")


def _blocks(placed: DataFrame, height: int) -> DataFrame:
    """One row for each ``FANOUT ** height`` leaves in a row: they, and the root of their subtree."""
    kind = placed.schema["key"].dataType.simpleString()
    schema = (
        f"grp string, block bigint, n bigint, keys array<{kind}>, leaves array<binary>, changed array<binary>, node string"
    )

    def gather(key, rows):
        rows = rows.sort_by("place")
        n = rows.column("n")[0].as_py()
        nodes = [leaf.hex() for leaf in rows.column("leaf").to_pylist()]
        for _ in range(min(height, _levels(n))):
            nodes = _parents(nodes)
        lists = [pa.array([rows.column(c).to_pylist()], pa.list_(rows.schema.field(c).type)) for c in ("key", "leaf", "changed")]
        return pa.table([rows.column("grp").slice(0, 1).combine_chunks(), [key[1].as_py()], [n], *lists, nodes], names)

    names = [part.split()[0] for part in schema.split(", ")]
    numbered = placed.withColumn("block", F.floor(F.col("place") / FANOUT**height).cast("bigint"))
    return numbered.groupBy("grp", "block").applyInArrow(gather, schema)


def _exchange(state: DataFrame, level: int) -> DataFrame:
    """One round: groups of ``FANOUT`` nodes of this level swap their roots, so that every block
    below learns its node's siblings and hashes the parent itself.

    A block meets those blocks of the other nodes that lie at the same place in theirs. The
    last node of a level may have fewer blocks; they stand in for the missing ones.
    """
    width = FANOUT**level
    open_ = state.where(F.col("blocks") > width)
    child = F.floor(F.col("block") / width).cast("bigint")
    low = F.col("block") % width
    held = F.least(F.col("blocks") - child * width, F.lit(width))
    # Others of its group ask for it only if there are any before it.
    lone = (held == width) | (child % FANOUT == 0)
    calls = F.when(lone, F.array(low)).otherwise(F.sequence(low, F.lit(width - 1).cast("bigint"), held))
    sent = open_.select(
        "*", child.alias("child"), F.floor(child / FANOUT).cast("bigint").alias("parent"), low.alias("own"), F.explode(calls).alias("low")
    )
    me = F.struct("block", "blocks", "child", "upper")
    met = sent.groupBy("grp", "parent", "low").agg(
        F.sort_array(F.collect_list(F.struct("child", "node"))).alias("nodes"),
        F.collect_list(F.when(F.col("low") == F.col("own"), me)).alias("members"),
    )
    joined = F.array_join(F.transform("nodes", lambda x: x["node"]), "")
    met = met.select("grp", "nodes", F.sha2(F.encode(joined, "UTF-8"), 256).alias("node"), F.explode("members").alias("m"))

    def side(keep):
        return F.array_join(F.transform(F.filter("nodes", lambda x: keep(x["child"])), lambda x: x["node"]), "")

    step = F.struct(
        side(lambda c: c < F.col("m.child")).alias("before"), side(lambda c: c > F.col("m.child")).alias("after")
    )
    met = met.select("grp", "m.block", "m.blocks", "node", F.concat("m.upper", F.array(step)).alias("upper"))
    return met.unionByName(state.where(F.col("blocks") <= width))


def _forest(leaves: DataFrame, height: int) -> DataFrame:
    """A tree for each ``grp`` over its leaves in order of ``key``: one row per block, with the
    way from its root up (``upper``) to the tree's root (``top``)."""
    blocks = materialize(_blocks(_numbered(leaves), height), "merkle-blocks")
    count = F.ceil(F.col("n") / FANOUT**height).cast("bigint")
    state = blocks.select("grp", "block", count.alias("blocks"), "node", F.array().cast(_UPPER).alias("upper"))
    most, level = state.agg(F.max("blocks")).first()[0] or 0, 0
    while FANOUT**level < most:
        state = materialize(_exchange(state, level), "merkle-round")
        level += 1
    upper = state.select("grp", "block", "upper", F.col("node").alias("top"))
    return blocks.join(upper, ["grp", "block"]).withColumn("height", F.lit(height))


def _members(block: dict):
    """``key, leaf, changed, way`` for the leaves of a block; ``way`` holds for every level up to
    the root the digests before and after the node in its run."""
    nodes, ways = [leaf.hex() for leaf in block["leaves"]], []
    for _ in range(min(block["height"], _levels(block["n"]))):
        level = []
        for i in range(0, len(nodes), FANOUT):
            run = nodes[i : i + FANOUT]
            level += [("".join(run[:j]), "".join(run[j + 1 :])) for j in range(len(run))]
        ways.append(level)
        nodes = _parents(nodes)
    above = [(step["before"], step["after"]) for step in block["upper"]]
    for i, (key, leaf, changed) in enumerate(zip(block["keys"], block["leaves"], block["changed"], strict=True)):
        way = [level[i // FANOUT**k] for k, level in enumerate(ways)]
        yield key, leaf.hex(), changed.hex() if changed is not None else None, way + above


def fold(leaf: str, way: list[tuple[str, str]]) -> str:
    """The root that a leaf and its siblings lead to."""
    for before, after in way:
        leaf = _h(before + leaf + after)
    return leaf


def _emit(blocks: DataFrame, schema: str, row) -> DataFrame:
    """One row for every leaf of every block."""

    def run(batches):
        kinds = pa.schema(arrow)
        for batch in batches:
            for n in range(batch.num_rows):
                block = batch.slice(n, 1).to_pylist()[0]
                rows = [row(block, *member) for member in _members(block)]
                yield record_batch(kinds, *zip(*rows, strict=True))

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    arrow = to_arrow_schema(StructType.fromDDL(schema))
    return blocks.mapInArrow(run, schema)


def build_manifest(
    rows: DataFrame, fields: list[str], group: str = "lang", key: str = "doc_id", changed: Column | None = None,
    text: str = "text", height: int = HEIGHT,
) -> DataFrame:
    """The hash tree of a table, as blocks of leaves with the way from each block to the root.

    A leaf is ``leaf_hash`` of a row's ``fields``. For each value of ``group`` the leaves in order
    of the integer ``key`` (missing first; ties by digest) make a tree of ``FANOUT`` children a
    node; the trees' roots, in order of the group's UTF-8 bytes (missing first), make one tree.
    ``changed`` may give another content of column ``text`` for some rows: its leaf goes along, the tree
    is that of the rows as they are. ``proofs`` and ``check_rows`` read the blocks.

    Digests are made where rows lie; 100 bytes a row are then sorted by range, numbered without
    a sort of everything, and gathered into blocks of ``FANOUT ** height`` leaves, whatever a group's size. Blocks then
    exchange roots in one small shuffle a level, at most eight rows a key. All steps end in
    written tables. Missing values have a digest of their own; repeated rows are several leaves;
    texts of any length are hashed whole; an empty table has no blocks; other columns are not used.
    """
    leaf = leaf_hash(*[F.col(f) for f in fields])
    other = F.lit(None)
    if changed is not None:
        other = F.when(changed.isNotNull(), leaf_hash(*[changed if f == text else F.col(f) for f in fields]))
    leaves = rows.select(
        # Sorts as the group does, missing first, and is never null.
        F.coalesce(F.concat(F.lit("1"), F.col(group).cast("string")), F.lit("0")).alias("grp"),
        F.col(key).cast("bigint").alias("key"),
        F.unhex(leaf).alias("leaf"),
        F.unhex(other).alias("changed"),
    )
    trees = materialize(_forest(leaves, height), "merkle-trees")
    roots = trees.where("block = 0").select(
        F.lit("").alias("grp"), F.col("grp").alias("key"), F.unhex("top").alias("leaf"), F.lit(None).cast("binary").alias("changed")
    )
    tops = _emit(_forest(roots, height), f"grp string, root string, above {_UPPER}", _top)
    whole = trees.join(tops, "grp").withColumnRenamed("top", "subroot")
    return whole.withColumn("upper", F.concat("upper", "above")).drop("above", "grp", "node", "block")


def _steps(way):
    return [{"before": before, "after": after} for before, after in way]


def _top(block, key, leaf, changed, way):
    return key, block["top"], _steps(way)


def proofs(manifest: DataFrame) -> DataFrame:
    """``key, leaf, subroot, root, way``: each row's digest and all it takes to verify it."""

    def row(block, key, leaf, changed, way):
        return key, leaf, block["subroot"], block["root"], _steps(way)

    return _emit(manifest, f"key bigint, leaf string, subroot string, root string, way {_UPPER}", row)


def check_rows(manifest: DataFrame) -> DataFrame:
    """``key, leaf, subroot, root, proof_sha256, folded_root, verified``: the root that each row as
    it is now (``changed``, else as it was) leads to with its siblings, and whether it is the root."""

    def row(block, key, leaf, changed, way):
        folded = fold(changed or leaf, way)
        proof = _h("".join(before + after for before, after in way))
        return key, leaf, block["subroot"], block["root"], proof, folded, folded == block["root"]

    schema = "key bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    return _emit(manifest, schema, row)


FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
_UPPERS, _LOWERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def op11_merkle_manifest(spark, folder: str) -> DataFrame:
    """The manifest of all documents, and every row checked after some texts were lower-cased."""
    docs = table(spark, folder, "documents")
    picked = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    changed = F.when(picked, F.translate("text", _UPPERS, _LOWERS))
    done = check_rows(build_manifest(docs, FIELDS, changed=changed))
    return done.withColumnRenamed("key", "doc_id")


def _sql(deep: int = 8, wide: int = 3) -> str:
    """The same by unrolled levels: enough for ``8 ** deep`` rows of a group and ``8 ** wide`` groups."""

    def fields(text):
        texts = [text if f == "text" else f"{f}::VARCHAR" for f in FIELDS]
        return "sha256(" + " || ".join(f"coalesce(octet_length(encode({t})) || ':' || {t}, '-')" for t in texts) + ")"

    def level(name, number, by):
        run = f"PARTITION BY {by}, p // 8 ORDER BY p ROWS BETWEEN"
        return f"""{name}{number}s AS (
    SELECT *, coalesce(string_agg(h, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS bef,
        coalesce(string_agg(h, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS aft,
        count(*) OVER (PARTITION BY {by}) AS c FROM {name}{number}
), {name}{number + 1} AS (
    SELECT {by}, p // 8 AS p, CASE WHEN any_value(c) = 1 THEN any_value(h) ELSE sha256(string_agg(h, '' ORDER BY p)) END AS h
    FROM {name}{number}s GROUP BY {by}, p // 8
)"""

    parts = [level("t", k, "lang") for k in range(deep)]
    parts.append(f"r0 AS (SELECT 0 AS one, lang, h, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS p FROM t{deep})")
    parts += [level("r", k, "one") for k in range(wide)]
    steps, at = [], "leaves"
    for k in range(deep):
        steps.append(f"""w{k} AS (SELECT a.* EXCLUDE (p, folded, proof), a.p // 8 AS p, proof || bef || aft AS proof,
    CASE WHEN c = 1 THEN folded ELSE sha256(bef || folded || aft) END AS folded
    FROM {at} a JOIN t{k}s s ON a.lang IS NOT DISTINCT FROM s.lang AND a.p = s.p)""")
        at = f"w{k}"
    steps.append(f"v0 AS (SELECT a.* EXCLUDE (p), r0.p, r0.h AS subroot FROM {at} a JOIN r0 ON a.lang IS NOT DISTINCT FROM r0.lang)")
    for k in range(wide):
        steps.append(f"""v{k + 1} AS (SELECT a.* EXCLUDE (p, folded, proof), a.p // 8 AS p, proof || bef || aft AS proof,
    CASE WHEN c = 1 THEN folded ELSE sha256(bef || folded || aft) END AS folded FROM v{k} a JOIN r{k}s s ON a.p = s.p)""")
    lowered = f"CASE WHEN crc % 3 = 0 THEN translate(text, '{_UPPERS}', '{_LOWERS}') ELSE text END"
    return f"""
WITH crcs AS (
    SELECT list(list_reduce(list_prepend(b, range(8)),
        lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) ORDER BY b) AS tab
    FROM range(256) t(b)
), summed AS (
    SELECT documents.*, xor(list_reduce(
        list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ord(x)::BIGINT)),
        lambda c, x: xor(c // 256, tab[xor(c % 256, x) + 1])), 4294967295) AS crc
    FROM documents, crcs
), hashed AS (
    SELECT doc_id, lang, {fields("text")} AS leaf, {fields(f"({lowered})")} AS folded FROM summed
), leaves AS (
    SELECT *, '' AS proof, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p FROM hashed
), t0 AS (SELECT lang, p, leaf AS h FROM leaves), {", ".join(parts)}, {", ".join(steps)}
SELECT doc_id, leaf, subroot, h AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = h AS verified
FROM v{wide}, r{wide}
"""


SQL = _sql()
