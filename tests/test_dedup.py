import random

import pytest
from pyspark.sql import functions as F

from corpusmill import api
from corpusmill.operators import minhash
from corpusmill.operators.components import connected_components
from corpusmill.operators.forest import spanning_forest
from corpusmill.operators.lines import line_counts
from corpusmill.operators.skew import join_counted

SHARED = ["A notice that two files hold alike, and nothing besides.\n", "- start\n", "- next\n"]
FILES = [
    (1, SHARED[0]),
    (2, SHARED[0]),
    (3, SHARED[1] + SHARED[2] + "- last\nBody of the third file.\n"),
    (4, SHARED[1] + SHARED[2] + "Body of the fourth file.\n"),
    (5, "The fifth file repeats no line.\n"),
]


def table(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, text string")


def as_dict(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_line_dedup(spark):
    assert as_dict(api.exact_dedup(table(spark, FILES))) == {
        1: "",
        2: "",
        3: "- last\nBody of the third file.\n",
        4: "Body of the fourth file.\n",
        5: FILES[4][1],
    }


def test_line_dedup_against_counting(spark):
    rng = random.Random(1)
    rows = [(i, "".join(rng.choice("abcdefgh") + "\n" * rng.randrange(3) for _ in range(rng.randrange(6)))) for i in range(60)]
    # One line fills a third of the corpus.
    rows += [(1000 + i, f"the same line\nown line {i}\n\n") for i in range(300)]
    counts = {}
    for _, text in rows:
        for line in text.splitlines(keepends=True):
            counts[line] = counts.get(line, 0) + 1
    want = {i: "".join(x for x in t.splitlines(keepends=True) if counts[x] == 1) for i, t in rows}
    assert as_dict(api.exact_dedup(table(spark, rows))) == want
    assert sorted(r.n for r in line_counts(table(spark, rows)).collect()) == sorted(counts.values())


def test_copies(spark):
    kept = as_dict(api.minhash_dedup(table(spark, FILES), 100, 10, 5, 0.8))
    assert kept == {i: t for i, t in FILES if i != 2}


def test_near_copies(spark):
    rng = random.Random(2)
    words = [f"word{i}" for i in range(400)]
    base = [rng.choice(words) for _ in range(300)]
    close = list(base)
    close[10] = "changed"
    other = [rng.choice(words) for _ in range(300)]
    rows = [(1, " ".join(base)), (2, "\n".join(close)), (3, " ".join(other)), (4, "three words only"), (5, "")]
    kept = as_dict(api.minhash_dedup(table(spark, rows), 500, 50, 5, 0.8))
    assert sorted(kept) == [1, 3, 4, 5]


def brute_components(pairs):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in parent}


def brute_pairs(sigs, hashes, bands, threshold):
    width = hashes // bands
    ids = sorted(sigs)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            x, y = sigs[a], sigs[b]
            shared = any(x[k * width : (k + 1) * width] == y[k * width : (k + 1) * width] for k in range(bands))
            if shared and sum(p == q for p, q in zip(x, y)) / hashes > threshold:
                yield a, b


def families(seed, hashes, n, values):
    rng = random.Random(seed)
    bases = [[rng.randrange(1000) for _ in range(hashes)] for _ in range(4)]
    sigs = {}
    for i in range(n):
        sig = list(rng.choice(bases))
        for _ in range(rng.choice([0, 0, 1, 2, 3, 4, 6, 8])):
            sig[rng.randrange(hashes)] = rng.randrange(values)
        sigs[i] = sig
    return sigs


@pytest.mark.parametrize("hashes, bands, threshold, limit", [(20, 5, 0.8, 4), (11, 3, 0.5, 3), (6, 2, 0.3, 2)])
def test_clusters_do_not_depend_on_the_bucket_limit(spark, hashes, bands, threshold, limit):
    sigs = families(limit, hashes, 70, 5)
    df = spark.createDataFrame(list(sigs.items()), "doc_id bigint, sig array<bigint>")
    got = minhash.duplicate_clusters(df, hashes, bands, threshold, pair_limit=limit).collect()
    want = brute_components(brute_pairs(sigs, hashes, bands, threshold))
    assert {r.doc_id: r.component for r in got} == want
    assert len(got) == len(want)


def least_of_buckets(sigs, hashes, bands):
    """Each bucket's smallest member with each other one."""
    width = hashes // bands
    found = {}
    for i, s in sigs.items():
        for k in range(bands):
            found.setdefault((k, tuple(s[k * width : (k + 1) * width])), []).append(i)
    return {(min(m), x) for m in found.values() for x in m if x != min(m)}


@pytest.mark.parametrize("size", [100, 101, 250])
def test_pairs_follow_one_rule_at_any_bucket_size(spark, size):
    # One band is shared, nothing else; then families of near copies.
    sigs = {i: [1, 2, 3, 4] + [100 * i + k for k in range(16)] for i in range(size)}
    sigs |= {1000 + i: s for i, s in families(size, 20, 120, 5).items()}
    df = spark.createDataFrame(list(sigs.items()), "doc_id bigint, sig array<bigint>")
    first = {}
    for i in sorted(sigs):
        first.setdefault(tuple(sigs[i]), i)
    reps = {i: list(s) for s, i in first.items()}
    got = [(r.src, r.dst) for r in minhash.candidate_pairs(df, 20, 5).collect()]
    assert set(got) == least_of_buckets(reps, 20, 5) and len(got) == len(set(got))

    clusters = brute_components(brute_pairs(sigs, 20, 5, 0.8))
    pairs = minhash.duplicate_pairs(df, 20, 5, 0.8).collect()
    # A forest of links over the threshold, with the components of all of them.
    assert all(r.jaccard == sum(p == q for p, q in zip(sigs[r.src], sigs[r.dst])) / 20 > 0.8 for r in pairs)
    assert brute_components((r.src, r.dst) for r in pairs) == clusters
    assert len(pairs) == len(clusters) - len(set(clusters.values()))


def test_the_forest_is_the_heaviest(spark):
    rng = random.Random(9)
    links = {}
    # A hub with a third of all links, chains, parallel links both ways, a loop, many ties.
    for i in range(200):
        a, b = rng.sample(range(40), 2)
        links[min(a, b), max(a, b)] = rng.randrange(4)
    links |= {(100, i): 1 for i in range(101, 260)} | {(i, i + 1): i % 7 for i in range(300, 420)}
    rows = [(b, a, w) if rng.random() < 0.5 else (a, b, w) for (a, b), w in links.items()] + [(7, 7, 9)]
    parent, want = {}, set()

    def root(x):
        while parent.get(x, x) != x:
            x = parent[x]
        return x

    for (a, b), w in sorted(links.items(), key=lambda e: (-e[1], e[0])):
        if root(a) != root(b):
            parent[root(a)] = root(b)
            want.add((a, b, w))
    got = spanning_forest(spark.createDataFrame(rows, "src bigint, dst bigint, weight int")).collect()
    assert {(r.src, r.dst, r.weight) for r in got} == want and len(got) == len(want)
    assert spanning_forest(spark.createDataFrame([(1, 1, 1)], "src bigint, dst bigint, weight int")).count() == 0


def test_components(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(90)]
    edges += [(i, i + 1) for i in range(1000, 1030)] + [(2000, 2000 + i) for i in range(1, 100)] + [(5, 5)]
    got = connected_components(spark.createDataFrame(edges, "src bigint, dst bigint")).collect()
    want = brute_components((a, b) for a, b in edges if a != b)
    assert {r.node: r.component for r in got} == want and len(got) == len(want)


def test_skewed_join_splits_heavy_keys(spark):
    rows = spark.range(30_000).withColumn("k", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")))
    counted = rows.groupBy("k").agg(F.count("*").alias("n"))
    plain = join_counted(rows, counted, "k", 30_000)
    split = join_counted(rows, counted, "k", 30_000)
    assert sorted(plain.collect()) == sorted(split.select(*plain.columns).collect())
    assert split.count() == 30_000


def test_no_estimate_exceeds_one(spark):
    rows = [(i, "one two three four five six seven") for i in range(3)] + [(9, "a b c d e f g h")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert minhash.fuzzy_dedup(docs, 20, 5, 5, 1.0).count() == 4
    assert minhash.fuzzy_dedup(docs, 20, 5, 5, 0.9).count() == 2


def test_stars_apart_from_others_are_finished(spark):
    from corpusmill.operators.components import _unfinished

    # A star at 1, a chain 12-11-10, a node with two arcs at 20 and 21, and a leaf beside it.
    arcs = [(2, 1), (3, 1), (11, 10), (12, 11), (13, 10), (22, 20), (22, 21), (23, 21)]
    got = _unfinished(spark.createDataFrame(arcs, "node bigint, other bigint")).collect()
    assert {r.other for r in got} == {10, 11, 20, 21}
