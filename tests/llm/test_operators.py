"""The operators on training data against brute force, with odd inputs."""

from __future__ import annotations

import math
import os
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from corpusmill.llm import decontaminate, lines, lmscore, ngramjoin, packing, perfect, repeats, rules, secrets, tokencount, toxicity
from corpusmill.llm.automaton import Automaton, Rule
from corpusmill.llm.vocabularies import byte_ranks, encoder

SCHEMA = "doc_id bigint, text string, row string, n_lines int, kept string"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + str(rng.randrange(40)) for _ in range(n))


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, repeated rows, ties, columns with names the operators use."""
    rng = random.Random(4)
    base = prose(rng, 120)
    texts = [None, "", " \n\t", "one", base, base, base + " more", prose(rng, 30_000), "Ünïcode line\nΩ", prose(rng, 60) + "\n" + base]
    rows = [(i, t, "x", 1, None) for i, t in enumerate(texts)]
    rows += [rows[4], (None, base, None, None, None), (None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def plain_spans(text):
    key = r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    found = [(m.start(), 0, m.end()) for m in re.finditer(key, text) if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return [("assign access hex".split()[k], s, e) for s, k, e in sorted(found)]


def test_secrets_are_those_of_the_patterns(spark):
    rng = random.Random(1)
    bits = ["token", "secret", "Password", "api_key", "apikey", "=", ": ", "'", '"', " ", "\n", "AKIA", "ABCD1234", "é", "0123456789abcdef", "abcd", "x", "passwd="]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randrange(60))) for _ in range(400)]
    texts += ['token=secret="token=abcdefgh', "secretoken=abcdefghi", "token=secret:abcdefgh", "AKIA" + "A" * 300, "f" * 5000]
    found = secrets.scan_secrets(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    for row in found:
        mine = [s for s in zip(row.kind, row.start, row.end, strict=True) if s[0] in ("assign", "access", "hex")]
        assert mine == plain_spans(texts[row.doc_id]), texts[row.doc_id]
        assert [texts[row.doc_id][s:e] for s, e in zip(row.start, row.end, strict=True)] == row.match


def test_secrets_of_odd_rows(spark, odd, empty):
    rng = random.Random(16)
    long = " ".join("f" * 40 if rng.random() < 0.01 else rng.choice(WORDS) for _ in range(200_000))
    rows = [(100, long, "x", 1, None), (101, "token=abcdefgh1", None, None, None), (101, "token=abcdefgh1", None, None, None)]
    data = odd.unionAll(spark.createDataFrame([*rows, (None, "AKIA" + "Z" * 20, None, None, None)], SCHEMA))
    found = secrets.scan_secrets(data).collect()

    def spans(r):
        return [s for s in zip(r.kind, r.start, r.end, strict=True) if s[0] in ("assign", "access", "hex")]

    wanted = sorted(repr((r.doc_id, plain_spans(r.text or ""))) for r in data.collect())
    assert sorted(repr((r.doc_id, spans(r))) for r in found) == wanted and len(found) == data.count()
    assert secrets.scan_secrets(empty).count() == 0


def test_rules_that_need_to_go_back_are_refused():
    with pytest.raises(ValueError):
        Automaton((Rule("back", "ab(cd)?", "ab"),))


def test_perfect_hash_numbers_without_gaps():
    keys = np.random.default_rng(1).integers(0, 2**63, 5000).astype(np.uint64)
    assert sorted(perfect.PerfectHash.build(keys).number(keys).tolist()) == list(range(len(np.unique(keys))))
    assert len(perfect.PerfectHash.build(keys[:0])) == 0


def plain_lines(rows):
    def key(line):
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))

    holders = {}
    ids = [lines.NO_ID if i is None else i for i, _ in rows]
    for i, (_, text) in zip(ids, rows, strict=True):
        for line in (text or "").split("\n"):
            holders.setdefault(key(line), set()).add(i)
    out = []
    for i, (_, text) in zip(ids, rows, strict=True):
        parts = (text or "").split("\n")
        kept = [x for x in parts if len(key(x)) < 10 or len(holders[key(x)]) < 2 or min(holders[key(x)]) == i]
        out.append((i, len(parts), len(parts) - len(kept), "\n".join(kept)))
    return sorted(out)


def test_lines_are_dropped_as_by_brute_force(spark, odd, empty):
    rng = random.Random(3)
    pool = [prose(rng, 3) for _ in range(40)] + ["short", "", "  Ending Line here ", "ending line HERE"]
    rows = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randrange(1, 12)))) for i in range(300)]
    for data in (spark.createDataFrame(rows, "doc_id long, text string"), odd):
        plain = [(r.doc_id, r.text) for r in data.select("doc_id", "text").collect()]
        done = lines.dedup_lines(data).select("row.doc_id", "n_lines", "n_dropped", "kept").collect()
        assert sorted((lines.NO_ID if d is None else d, n, k, t) for d, n, k, t in done) == plain_lines(plain)
    assert lines.dedup_lines(empty).count() == 0


def test_pieces_are_gapless_and_round_trip(odd, empty):
    packed = packing.pack_documents(odd, context=64, ids=True).collect()
    encode = encoder(packing.VOCABULARY)
    bodies = sorted([*encode(r.text or ""), 2] for r in odd.collect())
    by_row = {}
    for r in sorted(packed, key=lambda r: (r.doc_id is None, r.doc_id, r.piece)):
        assert r.length == len(r.ids) <= 64 and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        by_row.setdefault((r.doc_id, r.start), []).append(r.ids)
    assert sum(len(r.ids) for r in packed) == sum(map(len, bodies))
    places = {}
    for r in packed:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in places.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 64
    least = -(-sum(r.length for r in packed) // 64)
    assert len(places) <= 1.1 * least + 1
    assert packing.pack_documents(empty).count() == 0


def test_plan_places_every_rank_once():
    rng = random.Random(2)
    histogram = {length: rng.randrange(1, 400) for length in range(1, 101)}
    plan = packing.best_fit_plan(histogram, 100)
    for length, count in histogram.items():
        ranks = sorted((low, high) for n, low, high, *_ in plan if n == length)
        assert ranks[0][0] == 0 and ranks[-1][1] == count and all(a[1] == b[0] for a, b in zip(ranks, ranks[1:], strict=False))


def test_counts_are_the_librarys(odd, empty):
    from tokenizers import Tokenizer

    from corpusmill.llm.vocabularies import place

    library = Tokenizer.from_file(place(tokencount.VOCABULARY))
    for row in tokencount.count_tokens(odd).join(odd.select("doc_id", "text"), "doc_id").collect():
        assert row.n_tokens == len(library.encode(row.text or "", add_special_tokens=False).ids)
        assert row.n_bytes == len((row.text or "").encode()) and row.over_limit == (row.n_tokens > 1024)
    counts = tokencount.WordCounts(tokencount.VOCABULARY)
    for text in ("a<|endoftext|>b", "  x  ", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "don't\n\n\n  stop", "日本語 Ωmega", "q" * 3000):
        assert counts.of(text) == len(library.encode(text, add_special_tokens=False).ids), text
    assert tokencount.count_tokens(odd).count() == 13 and tokencount.count_tokens(empty).count() == 0
    assert tokencount.merged_count(b"", byte_ranks(tokencount.VOCABULARY)[0]) == 0


def test_toxicity_learns_words_and_scores_every_window(spark, odd, empty):
    rng = random.Random(5)
    texts, labels = [], []
    for i in range(1100):
        words = prose(rng, rng.randrange(20, 200)).split()
        if i % 3 == 0:
            words[rng.randrange(len(words))] = rng.choice(["vileword", "nastyword"])
        texts.append(" ".join(words))
        labels.append(int(i % 3 == 0))
    network = toxicity.train(texts[:900], labels[:900])
    scores = toxicity.Scorer(network).score(texts[900:])
    assert np.mean((scores >= 0.5) == np.array(labels[900:], bool)) >= 0.9
    out = toxicity.score_toxicity(odd, network).collect()
    assert len(out) == 13 and all(0 <= r.score <= 1 for r in out)
    assert toxicity.score_toxicity(empty, network).count() == 0
    assert toxicity.train(texts[:5], [0] * 5) is None
    owner, first = toxicity.window_places(np.array([0, 5, toxicity.WINDOW, 3 * toxicity.WINDOW + 1]))
    assert first[owner == 3].max() == 2 * toxicity.WINDOW + 1 and (np.diff(first[owner == 3]) <= toxicity.STEP).all()


def test_edited_benchmark_items_are_found(spark, odd, empty):
    rng = random.Random(6)
    items = [(i, prose(rng, rng.randrange(8, 60))) for i in range(30)]
    docs, wanted = [], set()
    for i in range(200):
        words = prose(rng, rng.randrange(50, 300)).split()
        if i % 2:
            item, text = rng.choice(items)
            part = text.split()
            for _ in range(decontaminate.edits_of(len(part)) // 2):
                part[rng.randrange(len(part))] = "changed"
            at = rng.randrange(len(words))
            words[at:at] = part
            wanted.add((i, item))
        docs.append((i, " ".join(words)))
    table = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), table).collect()
    pairs = {(r.doc_id, r.item_id) for r in found}
    assert pairs <= wanted and len(pairs) >= 0.95 * len(wanted)
    assert all(r.distance <= decontaminate.edits_of(r.n_item_words) for r in found)
    assert decontaminate.find_leaks(odd, table).count() == 0
    assert decontaminate.find_leaks(empty, table).count() == 0
    assert decontaminate.find_leaks(odd, table.where("item_id < 0")).count() == 0


def test_tables_reach_the_recall_in_every_size_class():
    rng, other = random.Random(11), np.random.default_rng(12)
    items = [prose(rng, size) for size in range(15, 62) for _ in range(2)]
    for recall in (decontaminate.RECALL, 0.999):
        index = decontaminate.ItemIndex(list(range(len(items))), items, recall)
        for group in index.classes:
            trials = [m for m in group.items for _ in range(4000 // len(group.items))]
            edited = [index._edited(index.items[m], other, len(index.vocabulary) + 1) for m in trials]
            missed = np.ones(len(trials), bool)
            for walk, choices, _ in group.tables:
                own = decontaminate.embed_all([index.items[m] for m in trials], walk)
                tried = decontaminate.embed_all(edited, walk)
                for places in choices:
                    missed &= index._keys(own, places) != index._keys(tried, places)
            # Three standard deviations of a share measured twice.
            assert missed.mean() <= 1 - recall + 3 * math.sqrt(2 * (1 - recall) / len(trials)), (group.least, recall)


def test_edit_distance_is_exact():
    rng = random.Random(7)

    def plain(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a):
            new = [i + 1]
            for j, y in enumerate(b):
                new.append(min(row[j] + (x != y), row[j + 1] + 1, new[j] + 1))
            row = new
        return row[-1]

    for _ in range(30):
        a = [rng.randrange(4) for _ in range(rng.randrange(1, 7))]
        b = [rng.randrange(4) for _ in range(rng.randrange(1, 12))]
        distance, start, end = decontaminate.best_run(np.array(a), np.array(b))
        assert distance == min(plain(a, b[i:j]) for i in range(len(b) + 1) for j in range(i, len(b) + 1)) == plain(a, b[start:end])


def plain_statistics(text):
    words = [w for w in re.split(r"[\x20\x09-\x0d]+", text) if w]
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    counts = Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if counts[g] > 1 for k in range(3)}
    seen, again = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0d]", line):
            again += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in rules.SYMBOLS for c in text), again, len(covered)


def test_statistics_and_the_learned_list(spark, odd, empty):
    rng = random.Random(8)
    rows = [(i, prose(rng, rng.randrange(0, 90)) + (" # %" * 20 if i % 4 == 0 else "")) for i in range(400)]
    rows += [(1000 + i, "\n".join(rng.choice(["a b c", "d e f g", " ", "x"]) for _ in range(60))) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 != 0)) for i in range(0, 400)], "doc_id long, quality int")
    learned = rules.learn_rules(rules.labelled_statistics(docs, labels))
    assert learned
    for r in rules.judge(docs, learned).where("row.doc_id < 1000 and not base_failed").collect():
        assert r.kept == (r.row.doc_id % 4 != 0)
    columns = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    for data in (docs, odd):
        for r in rules.judge(data, learned).collect():
            text = r.row.text or ""
            stats = plain_statistics(text)
            assert stats == tuple(r[c] for c in columns), text[:80]
            assert r.base_failed == (stats[0] < 50 or 100 * stats[4] > 50 * stats[0])
            assert not (r.base_failed and r.kept)
    assert rules.judge(empty, learned).count() == 0
    assert rules.learn_rules(rules.labelled_statistics(docs, labels.where("quality = 1"))) == []


def test_texts_without_words_pass_through_learned_rules(spark, tmp_path):
    rng = random.Random(21)
    texts = [None, "", " \n\t", "one", prose(rng, 80), "\n".join([prose(rng, 60), ""] * 3)]
    spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents")
    docs = spark.read.parquet(f"{tmp_path}/documents")
    for feature in rules._features():
        above, below = rules.Condition(feature, True, 1e9), rules.Condition(feature, False, -1.0)
        for learned in ([], [(above,)], [(above, below)], [(above,), (below,)]):
            judged = rules.judge(docs, learned)
            assert {r.row.doc_id for r in judged.where("kept").collect()} == {4}, (feature, learned)
            assert [r.doc_id for r in judged.where("kept").select("row.*").collect()] == [4]
            assert judged.where("not kept").count() == 5


def test_shared_passages(spark, odd, empty):
    rng = random.Random(9)

    def sentences(n):
        return " ".join(prose(rng, rng.randrange(5, 10)).capitalize() + "." for _ in range(n))

    passage = sentences(10)
    docs = [(i, sentences(8)) for i in range(40)]
    docs += [(100 + i, sentences(3)[:-1] + " " + passage + " " + sentences(3)) for i in range(6)]
    found = repeats.shared_passages(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    texts = dict(docs)
    assert {r.doc_id for r in found} == set(range(100, 106))
    assert all(r.first_doc_id == 100 and r.removed == (r.doc_id != 100) for r in found)
    assert all(texts[r.doc_id][r.start : r.end] in passage for r in found)
    assert repeats.shared_passages(empty).count() == 0
    found = repeats.shared_passages(odd).collect()
    ids = {r.doc_id for r in found}
    # The text of 120 words stands in these; a row without an id may be one more. No other shares anything.
    assert {4, 5, 6, 9} <= ids <= {4, 5, 6, 9, None}
    assert all(not r.removed for r in found if r.doc_id == 4) and all(r.removed for r in found if r.doc_id in (5, 6, 9))
    assert all(r.n_words >= 100 for r in found if r.doc_id in (4, 5, 6, 9))


def plain_components(rows):
    sets = []
    for _, text in rows:
        words = (text or "").encode().lower().split()
        sets.append({tuple(words[i : i + 4]) for i in range(max(1, len(words) - 3))} if words else set())
    group = list(range(len(rows)))

    def find(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            same_row = rows[i][0] is not None and rows[i][0] == rows[j][0]
            shared = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * shared >= 85 * len(sets[i] | sets[j]) and not same_row:
                group[find(i)] = find(j)
    return [(rows[i][0], len(sets[i]), min(rows[j][0] for j in range(len(rows)) if find(j) == find(i))) for i in range(len(rows))]


def test_links_are_those_of_brute_force(spark, odd, empty):
    rng = random.Random(10)
    rows = []
    for i in range(30):
        words = prose(rng, rng.randrange(4, 200)).split()
        for k in range(6):
            for _ in range(k % 4):
                words[rng.randrange(len(words))] = rng.choice(WORDS)
            rows.append((len(rows), " ".join(words)))
    rows += [(500, None), (501, ""), (502, "One two"), (503, "one TWO"), (504, "one two three")]
    out = ngramjoin.linked_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, out)) == sorted(plain_components(rows))
    assert ngramjoin.linked_documents(empty).count() == 0
    assert ngramjoin.linked_documents(odd).count() == 13


def test_links_of_near_copies_and_of_rows_without_ids(spark):
    rng = random.Random(8)
    base = prose(rng, 200).split()
    rows = []
    for i in range(300):
        words = list(base)
        for _ in range(rng.randrange(9)):
            words[rng.randrange(len(words))] = "new" + str(rng.randrange(10**6))
        rows.append((i, " ".join(words)))
    schema = "doc_id bigint, text string"
    out = ngramjoin.linked_documents(spark.createDataFrame(rows, schema)).collect()
    assert sorted(map(tuple, out)) == sorted(plain_components(rows))
    # Without ids every second row: sizes stay, and a component is named by an id that is there.
    some = [(i if i % 2 else None, t) for i, t in rows]
    found = {(r.doc_id, r.n_shingles, r.component_id) for r in ngramjoin.linked_documents(spark.createDataFrame(some, schema)).collect()}
    root = {i: c for i, _, c in plain_components(rows)}
    least = {c: min((i for i, d in root.items() if d == c and i % 2), default=None) for c in set(root.values())}
    assert {(i, c) for i, _, c in found if i is not None} == {(i, least[root[i]]) for i, _ in rows if i % 2}


def test_divide_skip_is_exact():
    rng = np.random.default_rng(3)
    for _ in range(50):
        query = np.unique(rng.integers(0, 60, 40)).astype(np.uint64)
        sets = [np.unique(np.where(rng.random(len(query)) < 0.1, rng.integers(0, 60, len(query)), query)).astype(np.uint64) for _ in range(12)]
        wanted = [i for i, s in enumerate(sets) if 100 * len(np.intersect1d(s, query)) >= 85 * len(np.union1d(s, query))]
        assert ngramjoin.divide_skip(query, sets) == wanted


def test_search_of_blocks_connects_what_all_links_connect():
    rng = np.random.default_rng(4)
    for case in range(30):
        base = np.unique(rng.integers(0, 10**6, 50))
        sets = [np.unique(np.where(rng.random(len(base)) < rng.choice([0, 0.05, 0.2]), rng.integers(0, 10**6, len(base)), base)).astype(np.uint64) for _ in range(25)]
        block = rng.integers(0, 2, 25) if case % 2 else np.zeros(25, int)
        asks, listed = block == 0, block == (case % 2)
        components = list(range(25)) if case % 3 else [i // 2 for i in range(25)]

        def joined(pairs, components=components):
            root = list(components)
            for i, j in pairs:
                root = [root[i] if r == root[j] else r for r in root]
            return {tuple(k for k in range(25) if root[k] == r) for r in root}

        links = [(i, j) for i in range(25) for j in range(25) if i != j and asks[i] and listed[j]
                 and 100 * len(np.intersect1d(sets[i], sets[j])) >= 85 * len(np.union1d(sets[i], sets[j]))]
        found = list(ngramjoin.search_block(sets, components, asks, listed)) if asks.any() and listed.any() else []
        assert set(found) <= set(links) and joined(found) == joined(links)


@pytest.mark.parametrize("split", [0, 60, 1 << 40])
def test_scores_are_those_of_the_formula(spark, odd, empty, monkeypatch, split):
    # The words' share of all tokens lies on both sides of 60; the model is one and the same.
    monkeypatch.setattr(lmscore, "SPLIT", split)
    monkeypatch.setattr(lmscore, "BLOCK_BYTES", 2000)
    rng = random.Random(11)
    often = [w for i, w in enumerate(WORDS) for _ in range(1 + i)]
    rows = [(i, " ".join(rng.choice(often) for _ in range(rng.randrange(0, 60)))) for i in range(120)] + [(900, None)]
    rows += [(i, prose(rng, 40) + " new" + str(i)) for i in range(300, 330)]
    texts = {i: (t or "").encode().lower().split() + [None] for i, t in rows}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in texts}
    single, pair, triple, context = Counter(), Counter(), Counter(), Counter()
    train = [t for i, t in texts.items() if not held[i]]
    for t in train:
        single.update(t)
    total, vocabulary = sum(single.values()), len(single)

    def times(word):
        return len(train) if word == "<" else single[word]

    def grams(t):
        for i, c in enumerate(t):
            yield t[i - 2] if i > 1 else "<", t[i - 1] if i else "<", c

    for t in train:
        for a, b, c in grams(t):
            pair[b, c] += 1
            triple[a, b, c] += 1
            context[a, b] += 1
    for r in lmscore.score_texts(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect():
        base = score = 0.0
        for a, b, c in grams(texts[r.doc_id]):
            p = (single[c] + 1) / (total + vocabulary + 1)
            base += math.log10(p)
            if times(b):
                p = lmscore.SECOND * pair[b, c] / times(b) + (1 - lmscore.SECOND) * p
            if context[a, b]:
                p = lmscore.THIRD * triple[a, b, c] / context[a, b] + (1 - lmscore.THIRD) * p
            score += math.log10(p)
        assert (r.held_out, r.n_tokens, r.train_tokens) == (held[r.doc_id], len(texts[r.doc_id]), total)
        assert r.n_known == sum(single[w] > 0 for w in texts[r.doc_id])
        assert r.base_score == pytest.approx(base) and r.score == pytest.approx(score, rel=2e-3)
    assert lmscore.score_texts(odd).count() == 13 and lmscore.score_texts(empty).count() == 0


def test_sets_without_a_like_neighbour_are_left_out(spark):
    shared = [(1, 40, g) for g in range(9)] + [(2, 44, g) for g in range(9)]
    alone = [(3, 40, g) for g in range(100, 109)]
    unlike = [(4, 400, g) for g in range(9)]
    heads = spark.createDataFrame(shared + alone + unlike, "key bigint, n bigint, gram bigint")
    assert {r.key for r in ngramjoin._active(heads).collect()} == {1, 2}


def test_any_passage_of_fifty_words_holds_a_paragraph():
    rng = random.Random(10)

    def text(n, ends):
        return [w.capitalize() + "." * (rng.random() < ends) if rng.random() < ends else w for w in prose(rng, n).split()]

    for trial in range(400):
        ends = rng.choice([0, 0, 0.02, 0.05, 0.1, 0.3, 1])
        passage = text(50, ends) if trial % 20 else rng.choice(WORDS).split() * 50
        around = [(text(rng.randrange(90), e), text(rng.randrange(90), e)) for e in (ends, rng.choice([0, 0.1, 1]))]
        bodies = [" ".join(before + passage + after) for before, after in around]
        _, _, owner, starts, ends_at, begin = repeats._cut(bodies)
        held = [set(), set()]
        for who, start, end in zip(owner.tolist(), (starts - begin[owner]).tolist(), (ends_at - begin[owner]).tolist(), strict=True):
            low = len(around[who][0])
            if low <= start and end <= low + len(passage):
                held[who].add(" ".join(passage[start - low : end - low]))
        assert held[0] & held[1], bodies
    # A text of one word, or of few in turn, has no more paragraphs than others.
    for some in (1, 3):
        assert len(repeats._cut([" ".join(WORDS[:some] * (9000 // some))])[2]) < 1500


def test_shared_passages_without_capitals_and_marks(spark):
    rng = random.Random(13)
    passages = [prose(rng, 51), prose(rng, 300), prose(rng, 25) + ". Then " + prose(rng, 30)]
    docs = [(i, prose(rng, 200)) for i in range(20)]
    docs += [(100 + i, prose(rng, 70) + " " + passages[i % 3] + " " + prose(rng, 90)) for i in range(9)]
    found = repeats.shared_passages(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r.doc_id for r in found} == set(range(100, 109))
    assert all(r.first_doc_id == 100 + (r.doc_id - 100) % 3 for r in found)
    long = [r for r in found if r.doc_id in (101, 104, 107)]
    assert len(long) == 3 and all(r.n_words > 250 and r.removed == (r.doc_id > 101) for r in long)


def test_items_at_the_ends_of_texts_lack_words(spark):
    rng = random.Random(14)
    items = [(i, prose(rng, 30)) for i in range(4)]
    bodies, wanted = [], set()
    for item, text in items:
        part = text.split()
        for cut in (0, 1, 2, 3):
            bodies += [" ".join(part[cut:]), "", " ".join(part[: len(part) - cut]), prose(rng, 20) + " " + " ".join(part[: len(part) - cut])]
            wanted |= {(len(bodies) - k, item) for k in (1, 2, 4)}
    docs = spark.createDataFrame(list(enumerate(bodies)), "doc_id long, text string")
    table = spark.createDataFrame(items, "item_id long, text string")
    whole = decontaminate.find_leaks(docs.coalesce(1), table).collect()
    assert {(r.doc_id, r.item_id) for r in whole} == wanted
    for row in whole:
        # Each run begins and ends at a word of its own text.
        assert 0 <= row.start < row.end <= len(bodies[row.doc_id])
        assert not bodies[row.doc_id][row.start : row.end].startswith(" ") and row.distance <= 3
    assert sorted(decontaminate.find_leaks(docs.repartition(40), table).collect()) == sorted(whole)


def test_stages_keep_and_drop_what_they_should(spark, tmp_path):
    import corpus_pipeline

    rng = random.Random(15)
    item = prose(rng, 40)
    same = prose(rng, 200)
    texts = {
        0: same, 1: same, 2: same + " end", 3: None, 4: "", 5: "too short",
        6: prose(rng, 100) + " " + item + " " + prose(rng, 90),
        # Without its first line, which 8 holds too, the text begins with an item's second word.
        7: "a line that several documents hold\n" + item.split(" ", 1)[1] + " " + prose(rng, 90),
        8: "a line that several documents hold\n" + prose(rng, 120),
    }
    texts |= {i: prose(rng, 150) for i in range(9, 60)}
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, row string, n_lines int, kept string"
    rows = [(i, t, "en", None, None if t is None else len(t), "x", 1, None) for i, t in texts.items()]
    # A repeated row, and one without an id.
    rows += [rows[20], (None, prose(rng, 130), None, None, None, None, None, None)]
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    labels = [(i, int(t is not None and len(t) > 50), 0) for i, t in texts.items()]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs, after = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        done = stage(spark, docs, str(tmp_path))
        if number < 4:
            assert done.columns == docs.columns
        done.write.parquet(f"{tmp_path}/{number}")
        docs = spark.read.parquet(f"{tmp_path}/{number}")
        after[name] = {r.doc_id: r for r in docs.collect()}
    ids = set(after["quality rules"])
    assert ids == {None, *texts} - {3, 4, 5}
    assert "several" in after["line dedup"][7].text and after["line dedup"][8].text.count("\n") == 0
    assert after["line dedup"][8].n_chars == len(after["line dedup"][8].text)
    # Line deduplication empties the copy, and a text without words is linked with nothing.
    assert after["line dedup"][1].text == ""
    assert set(after["n-gram Jaccard join"]) == set(after["line dedup"]) - {2}
    assert set(after["n-gram Jaccard join"]) - set(after["benchmark decontamination"]) == {6, 7}
    assert set(after["best-fit packing"]) == set(after["benchmark decontamination"])
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES[1:], 1):
        none = spark.createDataFrame([], schema)
        assert stage(spark, none, str(tmp_path)).count() == 0, number


def test_long_runs_have_the_ids_of_the_library(spark):
    from tokenizers import Tokenizer

    from corpusmill.llm.vocabularies import place

    library = Tokenizer.from_file(place(packing.VOCABULARY))
    texts = [c * 1_000_000 for c in " \t\n"] + ["a" * 300_000, "x" + " " * 900_000 + "y <|endoftext|>", "short  text\n\n é", ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for row in packing.cut_pieces(docs, context=1 << 24, ids=True).collect():
        assert row.ids == [*library.encode(texts[row.doc_id], add_special_tokens=False).ids, 2]


def test_chains_of_like_passages_stay_together(spark):
    rng = random.Random(15)
    docs, wanted = [], set()
    for chain in range(6):
        words = [f"{w}{i}" for i, w in enumerate(prose(rng, 64).split())]
        for k in range(12):
            # Each is like the next two only: they share 34 and 32 of 36 shingles.
            docs.append((100 * chain + k, " ".join(words[2 * k : 2 * k + 40])))
            wanted.add((100 * chain + k, 100 * chain))
    found = repeats.shared_passages(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.first_doc_id) for r in found} == wanted


def test_like_pairs_connect_what_all_pairs_connect():
    rng = np.random.default_rng(16)

    def components(n, pairs):
        group = list(range(n))
        for i, j in pairs:
            low, high = sorted((group[i], group[j]))
            group = [low if g == high else g for g in group]
        return group

    for trial in range(30):
        n, shapes = int(rng.integers(1, 90)), [rng.choice(60, 20, replace=False) for _ in range(3)]
        classes, sets = np.sort(rng.integers(0, 3, n)), []
        for _ in range(n):
            one = shapes[rng.integers(3)].copy()
            one[rng.choice(20, 3, replace=False)] = rng.integers(100, 160, 3)
            sets.append(np.unique(one).astype(np.uint64))
        shared = {(i, j): len(np.intersect1d(sets[i], sets[j])) for i in range(n) for j in range(i) if classes[i] == classes[j]}
        plain = [(i, j) for (i, j), s in shared.items() if 100 * s >= 80 * (len(sets[i]) + len(sets[j]) - s)]
        assert components(n, plain) == components(n, zip(*(side.tolist() for side in repeats.like_pairs(classes, sets)), strict=True)), trial


def test_scoring_leaves_no_tables_that_nothing_reads(spark):
    from urllib.parse import urlparse

    from corpusmill.session import scratch_root

    rng = random.Random(17)
    docs = spark.createDataFrame([(i, prose(rng, 40)) for i in range(60)], "doc_id long, text string")
    folder = urlparse(scratch_root(spark)).path
    before = set(os.listdir(folder))
    assert lmscore.score_texts(docs).count() == 60
    left = {name.split("-")[0] for name in set(os.listdir(folder)) - before}
    assert not left & {"blocks", "lexicon", "totals"}


def test_blocks_go_once_no_step_reads_them(spark):
    from urllib.parse import urlparse

    from corpusmill.session import scratch_root

    rng = random.Random(18)
    docs = spark.createDataFrame([(i, prose(rng, 40)) for i in range(60)] + [(None, "a b")], "doc_id long, text string")
    folder = urlparse(scratch_root(spark)).path
    before = set(os.listdir(folder))
    scored = lmscore.score_texts(docs)
    left = {name.split("-")[0] for name in set(os.listdir(folder)) - before}
    assert scored.count() == 61 and not left & {"ready", "asking"}


def test_words_of_slices_are_coded_as_they_are_split():
    from corpusmill.llm.common import coded_words, hashed_words, split_words

    texts = ["", "  ", " a B  c\x0b\x0c\r\n\t d ", "Ü É x y z\x1c\x1d q\x85r", "\x00 \x01", "a a B b"] * 3
    for low, size in ((0, 18), (3, 9), (1, 1), (2, 3)):
        column = pa.array(texts).slice(low, size)
        hashes, which, counts = coded_words(column)
        words, expected = hashed_words([split_words(t) for t in column.to_pylist()])
        assert (counts == expected).all() and (hashes[which] == words).all()


@pytest.mark.parametrize("top", [5, 1 << 20, 1 << 40])
def test_distinct_rows_are_those_of_tuples(top):
    from corpusmill.llm.trie import distinct_rows

    rng = np.random.default_rng(3)
    values = np.append(rng.integers(0, top, 6), [-2, 0])
    columns = [rng.choice(values, 400) for _ in range(3)]
    found, which = distinct_rows(*columns)
    rows = list(zip(*(c.tolist() for c in columns), strict=True))
    distinct = list(zip(*(c.tolist() for c in found), strict=True))
    assert distinct == sorted(set(rows)) and [distinct[i] for i in which] == rows
    assert all(len(c) == 0 for c in distinct_rows(*(c[:0] for c in columns))[0])


@pytest.mark.parametrize("routed", [1, 1 << 17])
def test_buckets_that_several_texts_meet_in(spark, monkeypatch, routed):
    monkeypatch.setattr(repeats, "ROUTED", routed)
    rng = random.Random(19)
    rows = [(rng.randrange(9), rng.randrange(12), *(b * 100 + rng.randrange(-9, 40) for b in range(repeats.BANDS))) for _ in range(150)]
    occur = spark.createDataFrame(rows, "row long, content long, " + ", ".join(f"{k} long" for k in repeats._KEYS)).repartition(3)
    texts = {}
    for row, content, *buckets in rows:
        for bucket in buckets:
            texts.setdefault(bucket, set()).add((row, content))
    expected = sorted({(b, c) for b, held in texts.items() for _, c in held if len({r for r, _ in held}) > 1})
    assert sorted(map(tuple, repeats._shared_buckets(occur).collect())) == expected
