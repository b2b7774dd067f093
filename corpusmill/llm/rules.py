"""Operator 7: a learned decision list over text statistics, in Spark expressions alone."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from itertools import pairwise

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.text import bind
from corpusmill.llm.common import table
from corpusmill.session import materialize

# Fixed values of the contract: white space, symbols, and the base rule's limits.
BLANK = r"\x20\x09-\x0D"
SYMBOLS = "#*$%&|<>"
LEAST_WORDS, MOST_REPEATED = 50, 50
# Repeated windows of a text up to which they are looked up one by one.
SHORT_LIST = 64

# The learner: labelled rows at most, cuts per statistic, rules at most, conditions in a rule at
# most, the share of bad rows that a rule must have where it was grown and where it was
# pruned, and the rows that it must cover where it was grown.
SAMPLE, CUTS, MOST_RULES, MOST_CONDITIONS, PURITY, LEAST_COVER = 20_000, 24, 8, 4, 0.97, 8


def text_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """All columns in a struct ``row``, with the statistics beside it. A missing text has no words.

    Everything stays within a row: no shuffle. Three-word windows are hashed and counted as an
    array; only where two are equal are their places sorted out.
    """
    blank = F.lit(" \t\n\x0b\x0c\r")
    rows = docs.select(F.struct("*").alias("row"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_text"))
    trimmed = F.btrim("_text", blank)
    no_words, no_hashes = F.array().cast("array<string>"), F.array().cast("array<bigint>")
    rows = bind(
        rows,
        _words=F.when(trimmed != "", F.split(trimmed, f"[{BLANK}]+")).otherwise(no_words),
        _lines=F.filter(F.split("_text", "\n"), lambda line: line.rlike(f"[^{BLANK}]")),
    )
    places = F.when(F.size("_words") >= 3, F.sequence(F.lit(0), F.size("_words") - 3)).otherwise(F.array().cast("array<int>"))
    rows = bind(rows, _windows=F.transform(places, lambda i: F.xxhash64(*[F.get("_words", i + k) for k in range(3)])))
    again = F.size(F.array_distinct("_windows")) < F.size("_windows")
    rows = bind(rows, _ordered=F.when(again, F.sort_array("_windows")))
    twice = F.array_distinct(F.filter("_ordered", lambda w, k: F.coalesce(w == F.get("_ordered", k + 1), F.lit(False))))
    rows = bind(rows, _twice=twice)
    # Their places: by looking each window up in a short list, or by sorting windows with places.
    few = F.size("_twice") <= SHORT_LIST
    rows = bind(
        rows,
        _sorted=F.when(~few, F.sort_array(F.transform("_windows", lambda w, i: F.struct(w.alias("w"), i.alias("i"))))),
        _places=F.when(
            few,
            F.filter(
                F.transform("_windows", lambda w, i: F.when(F.array_contains("_twice", w), i)), lambda i: i.isNotNull()
            ),
        ),
    )

    def like(x: Column, k: Column) -> Column:
        return F.coalesce(x.w == F.get("_sorted", k).w, F.lit(False))

    found = F.transform("_sorted", lambda x, k: F.when(like(x, k - 1) | like(x, k + 1), x.i))
    found = F.sort_array(F.filter(found, lambda i: i.isNotNull()))
    rows = bind(rows, _found=F.coalesce("_places", found))
    # Each place covers three words; what the place before has covered counts once.
    covered = F.aggregate(
        "_found",
        F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")),
        lambda a, p: F.struct((a.n + F.least(F.lit(3), p - a.last)).alias("n"), p.alias("last")),
        lambda a: a.n,
    )
    upper = F.length("_text") - F.length(F.regexp_replace("_text", r"\p{Lu}+", ""))
    return rows.select(
        "row",
        F.size("_words").cast("bigint").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("bigint").alias("word_chars"),
        F.length(F.regexp_replace("_text", f"[^{SYMBOLS}]++", "")).cast("bigint").alias("n_symbols"),
        F.size("_lines").cast("bigint").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("bigint").alias("n_repeat_words"),
        upper.cast("bigint").alias("n_upper"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def _features() -> dict[str, Column]:
    def share(part: str, of: str) -> Column:
        # Spark may work this out for texts without words too, before the base rule rejects them.
        return F.coalesce(F.try_divide(part, of), F.lit(0.0))

    return {
        "n_words": F.col("n_words").cast("double"),
        "word_length": share("word_chars", "n_words"),
        "symbols_per_word": share("n_symbols", "n_words"),
        "repeated_lines": share("n_dup_lines", "n_lines"),
        "repeated_words": share("n_repeat_words", "n_words"),
        "words_per_line": share("n_words", "n_lines"),
        "upper_case": share("n_upper", "word_chars"),
    }


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        value = _features()[self.feature]
        return value > self.threshold if self.above else value <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


def verdict(rules: list[Rule]) -> Column:
    """Whether the list keeps a row: the first rule that holds rejects it."""
    column = F.lit(True)
    for rule in reversed(rules):
        column = F.when(reduce(Column.__and__, [c.column() for c in rule]), F.lit(False)).otherwise(column)
    return column


def _steps(rows: DataFrame, cuts: dict[str, list[float]]) -> dict[tuple[str, bool, float], tuple[int, int]]:
    """Bad and good rows under each condition, by one aggregation over the cuts they lie between."""
    bins = [
        F.struct(F.lit(name).alias("feature"), sum(((F.col(name) > t).cast("int") for t in values), F.lit(0)).alias("bin"))
        for name, values in cuts.items()
    ]
    cells = rows.select("bad", F.inline(F.array(*bins))).groupBy("feature", "bin").agg(
        F.count_if("bad").alias("bad"), F.count_if(~F.col("bad")).alias("good")
    )
    counted: dict[str, dict[int, tuple[int, int]]] = {}
    for cell in cells.collect():
        counted.setdefault(cell.feature, {})[cell.bin] = (cell.bad, cell.good)
    out = {}
    for name, found in counted.items():
        for k, t in enumerate(cuts[name]):
            for above in (False, True):
                parts = [n for b, n in found.items() if (b > k) == above]
                out[name, above, t] = (sum(p[0] for p in parts), sum(p[1] for p in parts))
    return out


def learn_rules(labelled: DataFrame) -> list[Rule]:
    """A decision list from ``bad`` and statistics of labelled rows.

    Sequential covering: grow a conjunction on two thirds of the rows, one condition at a time,
    until it covers (nearly) bad rows only; prune its last conditions on the other third while
    that does not hurt; keep it if it is pure there too; go on with the rows it does not
    cover. Counts come from aggregations; the driver sees one number per cut.
    """
    features = _features()
    # The base rule comes first, so the list is for what it leaves.
    part = F.pmod(F.xxhash64("row.doc_id", F.lit(7)), F.lit(3)) < 2
    rows = labelled.where(~base_failed()).select("bad", part.alias("grow"), *[c.alias(n) for n, c in features.items()])
    # Repartitioned after the scan, which keeps its tasks: what is left is the bounded sample.
    rows = materialize(rows.repartition(4), "statistics")
    shares = F.array(*[F.lit((k + 0.5) / CUTS) for k in range(CUTS)])
    # Cuts among all rows and among the bad ones, which may be few.
    points = [
        F.array_distinct(F.concat(F.percentile(n, shares), F.coalesce(F.percentile(F.when(F.col("bad"), F.col(n)), shares), F.array().cast("array<double>")))).alias(n)
        for n in features
    ]
    found = rows.agg(*points, F.count_if("bad").alias("n_bad"), F.count("*").alias("n")).first()
    if not found.n_bad or found.n_bad == found.n:
        return []
    # Half way between two values that occur, so that no rule hangs on a value itself.
    cuts = {n: [(a + b) / 2 for a, b in pairwise(sorted(found[n]))] for n in features}
    rules: list[Rule] = []
    left = rows

    def holds(rule: Rule) -> Column:
        return reduce(Column.__and__, [F.col(c.feature) > c.threshold if c.above else F.col(c.feature) <= c.threshold for c in rule])

    while len(rules) < MOST_RULES:
        rule: Rule = ()
        inside = left.where("grow")
        while len(rule) < MOST_CONDITIONS:
            options = _steps(inside, cuts)
            enough = {k: v for k, v in options.items() if v[0] >= LEAST_COVER}
            if not enough:
                break

            def worth(n: tuple[int, int]) -> float:
                # Purity first, then cover: both matter while a rule is still broad.
                return ((n[0] + 0.5) / (n[0] + n[1] + 1)) ** 4 * n[0]

            best = max(enough, key=lambda k: (worth(enough[k]), k))
            name, above, threshold = best
            rule = (*rule, Condition(name, above, threshold))
            inside = inside.where(holds(rule[-1:]))
            if enough[best][1] == 0:
                break
        if not rule:
            break
        # One aggregation for all prefixes of the rule, on the rows it was not grown on.
        prefixes = [rule[: k + 1] for k in range(len(rule))]
        grown = [F.count_if(holds(p) & F.col("grow") & (F.col("bad") == b)) for p in prefixes for b in (True, False)]
        other = [F.count_if(holds(p) & ~F.col("grow") & (F.col("bad") == b)) for p in prefixes for b in (True, False)]
        tallies = list(left.agg(*[c.alias(f"c{i}") for i, c in enumerate([*grown, *other])]).first())
        half = 2 * len(prefixes)
        scored = []
        for k, prefix in enumerate(prefixes):
            (gb, gg), (ob, og) = tallies[2 * k : 2 * k + 2], tallies[half + 2 * k : half + 2 * k + 2]
            if gb >= PURITY * (gb + gg) and ob >= PURITY * (ob + og):
                scored.append((ob - og, -len(prefix), prefix))
        if not scored:
            break
        chosen = max(scored, key=lambda s: s[:2])[2]
        rules.append(chosen)
        left = left.where(~holds(chosen))
    return rules


def labelled_statistics(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Statistics and ``bad`` of at most ``sample`` labelled documents, by a fixed hash order."""
    chosen = labels.where("quality is not null").select("doc_id", (F.col("quality") == 0).alias("bad"))
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    # At most ``sample`` ids.
    found = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    return text_statistics(found).withColumn("bad", F.col("row.bad"))


def judge(docs: DataFrame, rules: list[Rule], text: str = "text") -> DataFrame:
    """``row``, the statistics, ``base_failed`` and ``kept`` of every row."""
    judged = text_statistics(docs, text).withColumn("base_failed", base_failed())
    return judged.withColumn("kept", ~F.col("base_failed") & verdict(rules))


def op7_quality_rules(spark, folder: str) -> DataFrame:
    """Statistics and verdicts of all documents, by a list learned from the labels. A missing
    text has no words and fails; repeated rows are judged alike; without labels of both kinds
    only the base rule rejects."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    rules = learn_rules(labelled_statistics(docs, table(spark, folder, "labels")))
    return judge(docs, rules).select(
        "row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )
