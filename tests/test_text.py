import random
import re

import pytest
from pyspark.sql import functions as F

from corpusmill import api
from corpusmill.functions import pii, text
from corpusmill.functions.quality import gopher_stats


def column(spark, values, *exprs):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, text string")
    return [tuple(r)[1:] for r in df.select("i", *exprs).orderBy("i").collect()]


def one(spark, values, expr):
    return [r[0] for r in column(spark, values, expr)]


EMAIL = r"[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}"
PHONE = r"(?<!\d)(\+?\d{1,3}[- ]?)?\(?\d{3}\)?[- ]?\d{3}[- ]?\d{4}(?!\d)"
IP = r"\b(?:\d{1,3}\.){3}\d{1,3}\b"


@pytest.mark.parametrize(
    "masker, pattern, mask",
    [
        (pii.mask_emails, EMAIL, pii.EMAIL_MASK),
        (pii.mask_phones, PHONE, pii.PHONE_MASK),
        (pii.mask_ips, IP, pii.IP_MASK),
    ],
)
def test_masks_agree_with_the_plain_patterns(spark, masker, pattern, mask):
    rng = random.Random(5)
    pieces = ["a@b.co", "x.y@z-1.org", "@", ".", "_", "a", "é", "1", "22", "333", "4444", " ", "-", "(", ")", "+",
              "10.0.0.1", "555-123-4567", "(555) 123 4567", "٣", "\n", "|", "a@b.c", "q@w.ee_r@t.yy"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randrange(1, 25))) for _ in range(3000)]
    masked, n = masker(F.col("text"))
    for given, (got, count) in zip(texts, column(spark, texts, masked, n)):
        assert (got, count) == re.subn(pattern, mask, given), given


def test_mask_cases(spark):
    texts = [
        "Write to ann@mail.example today.",
        "ann@mail.example and |||EMAIL_ADDRESS||| and bob@mail.example",
    ]
    masked, n = pii.mask_emails(F.col("text"))
    assert column(spark, texts, masked, n) == [
        ("Write to |||EMAIL_ADDRESS||| today.", 1),
        ("|||EMAIL_ADDRESS||| and |||EMAIL_ADDRESS||| and |||EMAIL_ADDRESS|||", 2),
    ]
    numbers = ["5551234567", "(555)-123-4567", "(555) 123 4567", "555-123-4567"]
    masked, n = pii.mask_phones(F.col("text"))
    got = column(spark, [f"Call {x} now." for x in numbers], masked, n)
    assert got == [("Call |||PHONE_NUMBER||| now.", 1)] * 4
    masked, n = pii.mask_ips(F.col("text"))
    assert column(spark, ["Host 10.20.30.40."], masked, n) == [("Host |||IP_ADDRESS|||.", 1)]


def test_masking_twice_changes_nothing_and_the_limit_is_inclusive(spark):
    texts = ["x 10.0.0.1 " * 50, "x 10.0.0.1 " * 51, "12@x.org 5551234567"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    once = pii.mask_pii(df)
    assert [r.n_pii for r in once.orderBy("i").collect()] == [50, 51, 2]
    again = pii.mask_pii(once.drop("n_pii"))
    assert {(r.i, r.text) for r in again.collect()} == {(r.i, r.text) for r in once.collect()}
    assert sorted(r.i for r in pii.pii_limit(df).collect()) == [0, 2]


def test_api_names_keep_other_columns(spark):
    df = spark.createDataFrame([(7, "a@b.org 10.0.0.1 555-123-4567")], "k int, text string")
    assert api.mask_emails(df).first().asDict() == {"k": 7, "text": "|||EMAIL_ADDRESS||| 10.0.0.1 555-123-4567", "n": 1}
    assert api.mask_ip_addresses(df).first().n == 1
    assert api.mask_phone_numbers(df).first().n == 1
    assert api.is_gopher_quality(df).first().gopher_ok is False


def test_normalize_text(spark):
    texts = ["Héllo,  Wörld!\n\tx_y", "Łódź đŁ ŧ", "a b c\x1fd", "İstanbul ΑΣ", "한국어 텍스트", "ñ ñ z",
             "हिन्दी भाषा", "é-f", "ﬁ ½ ²", "", " . "]
    # Decomposed letters, without their marks.
    want = [
        'hello world x_y',
        'łodz đł ŧ',
        'a b c d',
        'istanbul ας',
        '\u1112\u1161\u11ab\u1100\u116e\u11a8\u110b\u1165 \u1110\u1166\u11a8\u1109\u1173\u1110\u1173',
        'n n z',
        'हनद भष',
        'ef',
        'ﬁ ½ ²',
        '',
        '',
    ]
    assert one(spark, texts, text.normalize_text(F.col("text"))) == want


def test_words_and_lines(spark):
    got = one(spark, ["It's text.The end... (a-b) 3.5% ’", "a.b.c..d"], text.word_tokens(F.col("text")))
    assert got[0] == ["It's", "text.The", "end", "...", "(", "a-b", ")", "3.5", "%", "’"]
    assert got[1] == ["a.b.c", "..", "d"]
    lines = one(spark, ["a \r\n \n\rb c\x0bd\n", ""], text.nonblank_lines(F.col("text")))
    assert lines == [["a ", "b", "c", "d"], []]
    ends = one(spark, ["a\n\nb", "a\n", ""], text.terminated_lines(F.col("text")))
    assert ends == [["a\n", "\n", "b"], ["a\n"], []]


def test_drop_short_lines(spark):
    texts = ["x" * 51 + "\n" + "y" * 50 + "\n\n" + "é" * 60, "short", "\r" + "z" * 50 + " " * 5, "𝒳" * 51]
    want = ["\n".join(line for line in t.split("\n") if len(line) > 50) for t in texts]
    assert one(spark, texts, text.drop_short_lines(F.col("text"))) == want


def test_ngrams(spark):
    words = F.split("text", " ")
    assert one(spark, ["a b c d", "a b c", "a"], text.word_ngrams(words, 3)) == [["a b c", "b c d"], ["a b c"], []]


def test_flatten(spark):
    assert one(spark, ["a\r\nb\nc"], text.flatten_text(F.col("text"))) == ["a b c"]
    assert one(spark, ["a\r\nb"], text.flatten_for_scoring(F.col("text"))) == ["a\r b"]


GOPHER = [
    ("Plain prose that the rules should accept without any doubt. " * 60, True),
    ("Too few words to be kept.", False),
    ("word " * 49, False),
    ("word " * 50, True),
    ("word " * 100_000, True),
    ("word " * 100_001, False),
    ("an ox " * 100, False),
    ("an oxen " * 100, True),
    ("the " + "incomprehensible " * 100, False),
    ("tenletters " * 100, True),
    ("\n".join(["A line that trails off..."] * 30 + ["A whole line that has a good number of words in it."] * 70), False),
    ("\n".join(["A line that trails off..."] * 29 + ["A whole line that has a good number of words in it."] * 71), True),
    ("word " * 80 + "12345 " * 20, False),
    ("word " * 81 + "12345 " * 19, True),
    ("", False),
]


def test_gopher_rules(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(GOPHER)], "i int, text string")
    got = {r.i: r.gopher_ok for r in api.is_gopher_quality(df).collect()}
    assert [got[i] for i in range(len(GOPHER))] == [ok for _, ok in GOPHER]


def test_gopher_counts_agree_with_arrays(spark):
    rng = random.Random(3)
    pieces = ["ab", "1", "é", "_", ".", "..", "...", "'", "’", "-", " ", "\n", "\r\n", " ", " ", "中", "!", "\x1f"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randrange(30))) for _ in range(2000)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    stats = {r.i: r for r in gopher_stats(df).collect()}
    lists = df.select("i", text.word_tokens(F.col("text")).alias("w"), text.nonblank_lines(F.col("text")).alias("l"))
    for row in lists.collect():
        got, words, lines = stats[row.i], row.w, row.l
        assert got.n_tokens == len(words)
        n = len(words) or 1
        assert got.mean_token_chars == pytest.approx(sum(map(len, words)) / n)
        assert got.alphabetic_share == pytest.approx(sum(any(c.isalpha() for c in w) for w in words) / n)
        trailing = sum(line.endswith("...") for line in lines) / len(lines) if lines else 1
        assert got.ellipsis_share == pytest.approx(trailing)


def test_long_runs_neither_overflow_nor_crawl(spark):
    texts = ["a." * 300_000, "1-" * 300_000, "a" * 1_000_000, "\n" * 100_000 + " " * 100_000, "+" * 300_000, "1.1." * 100_000]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    assert gopher_stats(pii.mask_pii(df)).count() == len(texts)
