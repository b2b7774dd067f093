"""Near words against edit distance, with odd inputs."""

from __future__ import annotations

import random
import zlib
from collections import Counter

import numpy as np
import pytest

from corpusmill.llm import spelling

SCHEMA = "doc_id bigint, text string, word string, n string, key string"


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_groups(counts, ratio=10):
    out = {}
    for word, n in counts.items():
        near = sorted((-m, other) for other, m in counts.items() if one_edit(word, other))
        form = near[0][1] if near and -near[0][0] >= ratio * n else None
        out[word] = [form, None, n, len(near), counts[form] if form else None]
    for word, row in out.items():
        root = word
        while out[root][0]:
            root = out[root][0]
        row[1] = root
    return {w: tuple(r) for w, r in out.items()}


def related(rng, letters, sizes, n):
    """Words with many near ones: a few stems, edited again and again."""
    words = ["".join(rng.choice(letters) for _ in range(rng.choice(sizes))) for _ in range(max(2, n // 40))]
    while len(words) < n:
        w = list(rng.choice(words))
        kind, at = rng.randrange(3), rng.randrange(len(w))
        if kind == 0:
            w[at] = rng.choice(letters)
        elif kind == 1:
            w.insert(at, rng.choice(letters))
        elif len(w) > 7:
            del w[at]
        words.append("".join(w))
    return words


@pytest.mark.parametrize("size", [7, 8, 12, 64, 65, 130])
def test_pairs_are_those_of_one_edit(size):
    rng = random.Random(size)
    words, shard = [], []
    # Shards of one word, a few, more than 64 and more than two times 64, in turn.
    for number, n in enumerate([1, 5, 90, 3, 30, 30, 40, 200, 2, 64, 65]):
        own = sorted({w for w in related(rng, "abà", [size, size + 1], n) if len(w) in (size, size + 1)})
        words += own
        shard += [number] * len(own)
    u, v = spelling.near_pairs(words, np.array(shard), size)
    wanted = {
        (i, j)
        for i in range(len(words))
        for j in range(len(words))
        if shard[i] == shard[j] and one_edit(words[i], words[j]) and min(len(words[i]), len(words[j])) == size
    }
    assert len(u) == len(wanted) and set(zip(u.tolist(), v.tolist(), strict=True)) == wanted


@pytest.mark.parametrize("crowd", [3, 40, spelling.CROWD])
def test_forms_and_roots_are_those_of_brute_force(spark, crowd):
    rng = random.Random(8)
    words = set(related(rng, "abç", [7, 8, 9, 15], 500)) | set(related(rng, "abcdefgh", [7, 30, 100], 200))
    # Many words that are like one stem: their shards hold most rows.
    words |= {"crowded" + a + b for a in "abcdefgh" for b in "abcdefgh"} | {"crowded", "crowdeda"}
    counts = {w: rng.choice([2, 3, 30, 300, 300, 5000, 50000]) for w in words}
    table = spark.createDataFrame(list(counts.items()), "word string, n bigint")
    done = spelling.group_spellings(table, crowd=crowd).collect()
    assert {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in done} == plain_groups(counts)
    assert len(done) == len(counts) and any(r.root != r.form for r in done if r.form)


def plain_counts(rows):
    counts: Counter = Counter()
    for doc, text in rows:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        run = ""
        for c in low + " ":
            if "a" <= c <= "z" or "À" <= c <= "ÿ":
                run += c
            elif run:
                h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
                word = run[: h % len(run)] + run[h % len(run) + 1 :] if h % 31 == 0 else run
                if len(word) >= 7:
                    counts[word] += 1
                run = ""
    return counts


def test_words_are_counted_as_in_a_plain_loop(spark, tmp_path):
    rng = random.Random(9)
    pool = related(rng, "abcÀéß", [5, 6, 7, 9], 300) + ["Übergröße", "ÀÉÎõü÷×ÿ", "Ω", "naïveté", "x" * 40_000, "12", "don't"]
    rows = [(i, "".join(rng.choice(pool) + rng.choice([" ", "\n", "-", "Ā"]) for _ in range(rng.randrange(80)))) for i in range(150)]
    rows += [(None, "Someword someword"), (3, None), (4, ""), rows[7], rows[7], (200, "Longword " * 50_000)]
    table = spark.createDataFrame([(*r, "w", "n", None) for r in rows], SCHEMA)
    plain = plain_counts(rows)
    assert {r.word: r.n for r in spelling.count_words(table).collect()} == plain
    table.write.parquet(f"{tmp_path}/documents.parquet")
    done = spelling.op12_spelling_variants(spark, str(tmp_path)).collect()
    wanted = plain_groups({w: n for w, n in plain.items() if n >= 2 and len(w) < 1000})
    long = {w: n for w, n in plain.items() if n >= 2 and len(w) >= 1000}
    assert {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in done if len(r.word) < 1000} == wanted
    assert {r.word: r.n for r in done if len(r.word) >= 1000} == long
    none = spark.createDataFrame([], "word string, n bigint")
    assert spelling.group_spellings(none).count() == 0
