"""Near-duplicate removal: MinHash signatures, banding, links, clusters, survivors.

Documents with the same signature are one row from banding on; the copies come back
by their representative, the smallest id among them. No step lists all pairs of a group
that grows with the data: see ``compared_pairs``.
"""

from __future__ import annotations

import random
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.text import explode_ngrams, normalize_text
from corpusmill.operators.components import connected_components
from corpusmill.operators.forest import spanning_forest
from corpusmill.operators.skew import join_counted
from corpusmill.session import materialize

PRIME = 2**31 - 1
# A bucket of up to this many signatures is compared pair by pair.
PAIR_LIMIT = 100


def hash_family(num_hashes: int, seed: int = 1) -> list[tuple[int, int]]:
    """Multipliers and offsets of ``h -> (a * h + b) % PRIME``; products stay below 2**62."""
    rng = random.Random(seed)
    return [(rng.randrange(1, PRIME), rng.randrange(PRIME)) for _ in range(num_hashes)]


def gram_hash(gram: Column) -> Column:
    return F.conv(F.substring(F.md5(gram), 1, 8), 16, 10).cast("bigint") % PRIME


def ngram_hash(gram: Column, index: int, seed: int = 1) -> Column:
    """Member ``index`` of the hash family on an n-gram."""
    a, b = hash_family(index + 1, seed)[index]
    return (gram_hash(gram) * a + b) % PRIME


def minhash_signatures(
    docs: DataFrame,
    num_hashes: int = 20,
    ngrams: int = 5,
    seed: int = 1,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``doc_id, sig``: the minimum of each hash over a document's n-grams.

    Documents with fewer than ``ngrams`` words get no signature. The n-grams of a
    document are exploded in one task and combined there, so that one row per document
    is shuffled.
    """
    words = docs.select(doc_id, F.split(normalize_text(F.col(text)), " ").alias("words"))
    grams = explode_ngrams(words, "words", ngrams)
    hashed = grams.select(doc_id, gram_hash(F.col("gram")).alias("h"))
    minima = [
        F.min((F.col("h") * a + b) % PRIME).alias(f"_{i}")
        for i, (a, b) in enumerate(hash_family(num_hashes, seed))
    ]
    per_doc = hashed.groupBy(doc_id).agg(*minima)
    return per_doc.select(doc_id, F.array(*[f"_{i}" for i in range(num_hashes)]).alias("sig"))


def _key(band: int, values: Column) -> Column:
    joined = F.concat_ws(",", F.lit(str(band)), F.transform(values, lambda v: v.cast("string")))
    return F.conv(F.substring(F.md5(joined), 1, 15), 16, 10).cast("bigint")


def lsh_buckets(sigs: DataFrame, num_hashes: int, num_bands: int, doc_id: str = "doc_id") -> DataFrame:
    """``doc_id, band, key``: equal keys mean an equal slice of the signature.

    Hashes left over when ``num_bands`` does not divide ``num_hashes`` are in no band.
    """
    width = num_hashes // num_bands
    bands = [
        F.struct(F.lit(b).alias("band"), _key(b, F.slice("sig", b * width + 1, width)).alias("key"))
        for b in range(num_bands)
    ]
    return sigs.select(doc_id, F.inline(F.array(*bands)))


def distinct_signatures(sigs: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """``doc_id, sig, n``: one row per signature with its smallest document and its count."""
    grouped = sigs.groupBy("sig").agg(F.min(doc_id).alias(doc_id), F.count("*").alias("n"))
    return grouped.select(doc_id, "sig", "n")


def copy_links(sigs: DataFrame, reps: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """``src, dst``: from the smallest document of a signature to each of its copies."""
    finger = F.xxhash64("sig").alias("finger")
    copied = reps.where("n > 1").select(finger, F.col("sig").alias("rep_sig"), F.col(doc_id).alias("src"), "n")
    docs = sigs.select(F.col(doc_id).alias("dst"), "sig", finger)
    linked = join_counted(docs, copied, "finger", max(sigs.count(), 1)).where("sig = rep_sig and src <> dst")
    return linked.select("src", "dst")


def _matches(left: str, right: str) -> Column:
    same = F.filter(F.zip_with(left, right, lambda a, b: a == b), lambda hit: hit)
    return F.size(same)


def signature_jaccard(left: str, right: str) -> Column:
    """Share of equal positions of two signatures."""
    return _matches(left, right) / F.size(left)


def _required(num_hashes: int, threshold: float) -> int:
    """The least number of equal positions whose share exceeds the threshold."""
    return next((k for k in range(num_hashes + 1) if k / num_hashes > threshold), num_hashes + 1)


def _bounded_pairs(groups: DataFrame) -> DataFrame:
    """All pairs within groups already known to hold at most ``pair_limit`` members."""
    lists = groups.groupBy("gid").agg(F.sort_array(F.collect_list("member")).alias("m"))
    firsts = lists.select(F.posexplode("m").alias("i", "left"), "m")
    rests = firsts.select("left", F.explode(F.slice(F.col("m"), F.col("i") + 2, F.size("m"))).alias("right"))
    return rests


def compared_pairs(
    reps: DataFrame,
    num_hashes: int,
    num_bands: int,
    threshold: float,
    doc_id: str = "doc_id",
    pair_limit: int = PAIR_LIMIT,
) -> DataFrame:
    """``src, dst, matches``: pairs of distinct signatures that share a bucket.

    Signatures that share a bucket of at most ``pair_limit`` members are compared pair by
    pair, and all these pairs are listed. A larger bucket would give a quadratic number of
    pairs; of those only pairs over the threshold are listed, and only as many as it takes
    to connect what all of them would connect:

    1. every member is compared with one pivot of its bucket, and labelled with the
       component that all links found so far put it in;
    2. a bucket in one component is done. A bucket with at most ``pair_limit`` members
       outside its largest component compares those few with all members, which settles it;
    3. in other buckets the signature positions that are not yet fixed are cut into
       ``m + 1`` blocks, where ``m`` is the number of positions in which a duplicate pair
       may differ. At least one block of such a pair is equal, so each block's value
       makes a smaller bucket, and every duplicate pair meets again in one of them.

    It ends because the fixed positions grow until they alone exceed the threshold, at
    which point the pivot links the whole bucket. The listed links have the connected
    components of all pairs that share a bucket and exceed the threshold; where no bucket
    is over the limit they are exactly those pairs.
    """
    required = _required(num_hashes, threshold)
    # Where nothing can exceed the threshold, pairs are still compared, as for the highest that can.
    slack = max(num_hashes - required, 0)
    buckets = lsh_buckets(reps, num_hashes, num_bands, doc_id)
    buckets = buckets.select(F.col("key").alias("gid"), "band", F.col(doc_id).alias("id"))
    sizes = materialize(buckets.groupBy("gid").agg(F.count("*").alias("n")).where("n > 1"), "sizes")
    total = sizes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    shared = join_counted(buckets, sizes, "gid", max(total, 1))
    small = shared.where(F.col("n") <= pair_limit).select("gid", F.col("id").alias("member"))
    pairs = _bounded_pairs(small).select(F.col("left").alias("src"), F.col("right").alias("dst")).distinct()
    signature = reps.select(F.col(doc_id).alias("id"), "sig")
    compared = (
        pairs.join(signature.toDF("src", "src_sig"), "src")
        .join(signature.toDF("dst", "dst_sig"), "dst")
        .select("src", "dst", _matches("src_sig", "dst_sig").alias("matches"))
    )
    found = [materialize(compared, "compared")]
    width = num_hashes // num_bands
    start = F.col("band") * width
    unfixed = F.concat(F.slice("sig", 1, start), F.slice("sig", start + width + 1, num_hashes))
    big = shared.where(F.col("n") > pair_limit).join(signature, "id")
    groups = big.select("gid", "id", unfixed.alias("rest"))
    while True:
        groups = materialize(groups, "groups")
        total = groups.count()
        if total == 0:
            break
        pivots = groups.groupBy("gid").agg(
            F.min_by(F.struct("id", "rest"), F.xxhash64("id", "gid")).alias("pivot"), F.count("*").alias("n")
        )
        pivots = materialize(pivots.where("n > 1"), "pivots")
        paired = join_counted(groups, pivots, "gid", total).where("id <> pivot.id")
        found.append(_over(paired, "pivot", num_hashes, required))

        labelled = _label(groups, found, required)
        shares = labelled.groupBy("gid", "component").agg(F.count("*").alias("share"))
        shape = shares.groupBy("gid").agg(
            F.sum("share").alias("n"), F.max("share").alias("most"), F.max_by("component", "share").alias("main")
        )
        shape = materialize(shape.where("n > most"), "shape")
        open_groups = materialize(join_counted(labelled, shape, "gid", total), "open")
        outside = F.col("n") - F.col("most")
        near = open_groups.where(outside <= pair_limit)
        few = near.where("component <> main").groupBy("gid").agg(
            F.collect_list(F.struct("id", "component", "rest")).alias("few"), F.first("n").alias("n")
        )
        few = materialize(few, "few")
        met = join_counted(near.drop("n"), few, "gid", total).withColumn("other", F.explode("few"))
        found.append(_over(met.where("component <> other.component"), "other", num_hashes, required))

        rest_size = F.size("rest")
        cut = [F.floor(rest_size * j / (slack + 1)).cast("int") for j in range(slack + 2)]
        children = [
            F.struct(
                F.xxhash64("gid", F.lit(j), F.slice("rest", cut[j] + 1, cut[j + 1] - cut[j])).alias("gid"),
                F.concat(F.slice("rest", 1, cut[j]), F.slice("rest", cut[j + 1] + 1, rest_size)).alias("rest"),
            )
            for j in range(slack + 1)
        ]
        wide = open_groups.where(outside > pair_limit).where(rest_size > slack)
        groups = wide.select("id", F.inline(F.array(*children)))
    return reduce(DataFrame.unionByName, found).distinct()


def _over(pairs: DataFrame, other: str, num_hashes: int, required: int) -> DataFrame:
    """Links between ``id`` and ``other.id``, whose unfixed positions are in ``rest``."""
    links = pairs.select(
        F.least("id", f"{other}.id").alias("src"),
        F.greatest("id", f"{other}.id").alias("dst"),
        (num_hashes - F.size("rest") + _matches("rest", f"{other}.rest")).alias("matches"),
    )
    return materialize(links.where(F.col("matches") >= required).distinct(), "compared")


def _label(groups: DataFrame, found: list[DataFrame], required: int) -> DataFrame:
    """Add the component that the links found so far put each ``id`` in."""
    links = reduce(DataFrame.unionByName, found).where(F.col("matches") >= required)
    components = connected_components(links).withColumnRenamed("node", "id")
    labelled = groups.join(components, "id", "left")
    return materialize(labelled.withColumn("component", F.coalesce("component", "id")), "labelled")


def candidate_pairs(sigs: DataFrame, num_hashes: int, num_bands: int, doc_id: str = "doc_id") -> DataFrame:
    """``src, dst``: the smallest document of each bucket with each other one of it, once.

    Buckets hold distinct signatures, each by its smallest document. One row per member
    at most, whatever the size of a bucket.
    """
    buckets = lsh_buckets(distinct_signatures(sigs, doc_id), num_hashes, num_bands, doc_id)
    buckets = materialize(buckets.select("key", F.col(doc_id).alias("dst")), "buckets")
    firsts = buckets.groupBy("key").agg(F.min("dst").alias("src"), F.count("*").alias("n")).where("n > 1")
    linked = join_counted(buckets, materialize(firsts, "firsts"), "key", max(buckets.count(), 1))
    return linked.where("src <> dst").select("src", "dst").distinct()


def duplicate_pairs(
    sigs: DataFrame, num_hashes: int, num_bands: int, threshold: float, doc_id: str = "doc_id", **options
) -> DataFrame:
    """``src, dst, jaccard``: pairs whose estimate exceeds the threshold and that connect every
    cluster, one fewer than it has documents: a spanning forest of the verified links.

    Among different signatures they are the likest pairs that do so (ties by ids; of buckets over
    the pair limit, among the links that settle them). A copy is linked to the smallest document
    of its signature.
    """
    if threshold >= 1:
        return sigs.select(F.col(doc_id).alias("src"), F.col(doc_id).alias("dst"), F.lit(1.0).alias("jaccard")).where(F.lit(False))
    sigs = materialize(sigs, "signatures")
    reps = materialize(distinct_signatures(sigs, doc_id), "representatives")
    links = _similar(reps, num_hashes, num_bands, threshold, doc_id, **options)
    forest = spanning_forest(links, weight="matches")
    copies = copy_links(sigs, reps, doc_id).withColumn("jaccard", F.lit(1.0))
    return forest.select("src", "dst", (F.col("weight") / num_hashes).alias("jaccard")).unionByName(copies)


def _similar(reps, num_hashes, num_bands, threshold, doc_id, **options) -> DataFrame:
    compared = compared_pairs(reps, num_hashes, num_bands, threshold, doc_id, **options)
    return compared.where(F.col("matches") >= _required(num_hashes, threshold))


def duplicate_clusters(
    sigs: DataFrame, num_hashes: int, num_bands: int, threshold: float, doc_id: str = "doc_id", **options
) -> DataFrame:
    """``doc_id, component`` of every document that has a duplicate.

    Components are found among distinct signatures; copies then take the component of
    their representative, so they never enter the loop. No estimate exceeds a threshold of
    1, not even that of copies.
    """
    if threshold >= 1:
        node = sigs.select(doc_id, F.col(doc_id).alias("component"))
        return node.where(F.lit(False))
    sigs = materialize(sigs, "signatures")
    reps = materialize(distinct_signatures(sigs, doc_id), "representatives")
    components = connected_components(_similar(reps, num_hashes, num_bands, threshold, doc_id, **options))
    components = materialize(components, "components")
    # A signature with copies, by its hash, with its component. Rows of a signature, its smallest
    # document among them, meet it in one skew-safe join.
    finger = F.xxhash64("sig").alias("finger")
    named = components.withColumnRenamed("node", doc_id)
    copied = reps.where("n > 1").join(named, doc_id, "left")
    copied = copied.select(finger, F.col("sig").alias("rep_sig"), F.coalesce("component", doc_id).alias("component"), "n")
    docs = sigs.select(F.col(doc_id).alias("node"), "sig", finger)
    found = join_counted(docs, materialize(copied, "copied"), "finger", max(sigs.count(), 1)).where("sig = rep_sig")
    every = components.unionByName(found.select("node", "component")).distinct()
    return every.withColumnRenamed("node", doc_id)


def fuzzy_dedup(
    docs: DataFrame,
    num_hashes: int = 20,
    num_bands: int = 5,
    ngrams: int = 5,
    threshold: float = 0.8,
    seed: int = 1,
    doc_id: str = "doc_id",
    text: str = "text",
    **options,
) -> DataFrame:
    """Keep the smallest document of each cluster and every document outside clusters."""
    sigs = minhash_signatures(docs, num_hashes, ngrams, seed, doc_id, text)
    clusters = duplicate_clusters(sigs, num_hashes, num_bands, threshold, doc_id, **options)
    losers = materialize(clusters.where(F.col(doc_id) != F.col("component")).select(doc_id), "losers")
    return docs.join(losers, doc_id, "left_anti")
