"""Quality rules: a decision list learnt by sequential covering from labelled statistics.

Everything is DataFrame functions. Each text is reduced to a few counts inside its
row. For learning, the counts of labelled documents become shares in whole
thousandths. A rule is a conjunction of thresholds that marks documents of label
0: conditions are added by information gain on two thirds of the rows, taken off
again while the remaining third does not object, and a rule is kept if it is
precise there. Its rows are then set aside and the next rule is sought. Each
question to the data is one aggregation, whose result has at most SCALE + 1 rows
for each feature. The list becomes one conditional expression.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.session import stage_table

SCALE = 1000
SPACE = r"[\x20\x09-\x0D]+"
WINDOW = 8

# Shares that rules may ask about: numerator, denominator, factor.
FEATURES = {
    "symbol_share": ("n_symbols", "word_chars"),
    "capital_share": ("n_capitals", "word_chars"),
    "digit_share": ("n_digits", "word_chars"),
    "exclamation_share": ("n_exclamations", "word_chars"),
    "repeat_share": ("n_repeat_words", "n_words"),
    "distinct_share": ("n_distinct_words", "n_words"),
    "dup_line_share": ("n_dup_lines", "n_lines"),
}
STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
_MORE = ["n_capitals", "n_digits", "n_exclamations", "n_distinct_words", "n_lines"]


def _let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once, though a lambda uses it often."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _ahead(values: Column, by: int, n: Column) -> Column:
    """Pair hashes of each entry and the one ``by`` places on (nothing past the end)."""
    return F.zip_with(values, F.slice(values, by + 1, F.greatest(n, F.lit(1))), lambda a, b: F.xxhash64(a, b))


def _covered(windows: Column) -> Column:
    """Words in windows that occur more than once; ``windows`` holds one hash for each start."""
    pairs = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    twins = _let(
        pairs,
        lambda s: F.filter(s, lambda e, i: F.coalesce(F.get(s, i - 1)["h"] == e["h"], F.lit(False)) | F.coalesce(F.get(s, i + 1)["h"] == e["h"], F.lit(False))),
    )
    places = F.sort_array(F.transform(twins, lambda e: e["i"]))
    start = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).cast("bigint").alias("n"))
    return F.aggregate(
        places,
        start,
        lambda acc, p: F.struct(p.alias("last"), (acc["n"] + F.least(F.lit(WINDOW), p - acc["last"])).alias("n")),
        lambda acc: acc["n"],
    )


def _left(text: Column, others: str) -> Column:
    """How many characters stay when those of the class ``others`` go."""
    return F.length(F.regexp_replace(text, others, "")).cast("bigint")


def statistics(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """The columns of ``keep`` and the counts of each whole text (null: empty).

    Windows of eight words are compared by chained 64-bit hashes of their words.
    """
    t = F.coalesce(F.col("_text"), F.lit(""))
    step = docs.select(*keep, F.col(text).alias("_text")).select(
        *keep,
        F.array_remove(F.split(t, SPACE), "").alias("_words"),
        F.filter(F.split(t, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("_lines"),
        _left(t, r"[^#*$%&|<>]+").alias("n_symbols"),
        _left(t, r"[^A-Z]+").alias("n_capitals"),
        _left(t, r"[^0-9]+").alias("n_digits"),
        _left(t, r"[^!]+").alias("n_exclamations"),
    )
    rest = ["n_symbols", "n_capitals", "n_digits", "n_exclamations"]
    step = step.select(
        *keep,
        *rest,
        F.size("_words").cast("bigint").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("bigint").alias("word_chars"),
        F.size(F.array_distinct("_words")).cast("bigint").alias("n_distinct_words"),
        F.size("_lines").cast("bigint").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint").alias("n_dup_lines"),
        F.transform("_words", lambda w: F.xxhash64(w)).alias("_h"),
    )
    rest += ["n_words", "word_chars", "n_distinct_words", "n_lines", "n_dup_lines"]
    n = F.col("n_words").cast("int")
    for by in (1, 2, 4):
        step = step.select(*keep, *rest, _ahead(F.col("_h"), by, n).alias("_h"))
    step = step.select(*keep, *rest, F.slice("_h", 1, F.greatest(n - (WINDOW - 1), F.lit(0))).alias("_h"))
    found = F.when(F.size(F.array_distinct("_h")) < F.size("_h"), _covered(F.col("_h"))).otherwise(F.lit(0).cast("bigint"))
    return step.select(*keep, *rest, found.alias("n_repeat_words"))


def _where(stats: DataFrame, condition: Column) -> DataFrame:
    """Rows whose counts meet a condition, which Spark must not work out again below the counts.

    A filter is not pushed below a projection that numbers rows.
    """
    numbered = stats.withColumn("_at", F.monotonically_increasing_id())
    return numbered.filter((F.col("_at") >= 0) & condition).drop("_at")


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def _feature(name: str) -> Column:
    top, bottom = FEATURES[name]
    return F.floor(SCALE * F.col(top) / F.greatest(F.col(bottom), F.lit(1))).cast("int")


@dataclass(frozen=True)
class Condition:
    """feature > threshold (``above``) or feature <= threshold, in thousandths."""

    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        value = F.col(self.feature)
        return value > self.threshold if self.above else value <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold / SCALE:g}"


Rule = tuple[Condition, ...]


def _all(rule: Rule) -> Column:
    return reduce(lambda a, b: a & b, (c.column() for c in rule), F.lit(True))


def _tally(rows: DataFrame) -> dict[str, list[tuple[int, int, int]]]:
    """Per feature: (value, rows to mark, rows to leave), by value."""
    values = F.explode(F.array(*[F.struct(F.lit(f).alias("f"), F.col(f).alias("v")) for f in FEATURES]))
    counts = rows.select("bad", values.alias("x")).groupBy("x.f", "x.v").agg(F.sum("bad").alias("p"), F.sum(1 - F.col("bad")).alias("n"))
    out: dict[str, list[tuple[int, int, int]]] = {f: [] for f in FEATURES}
    for r in counts.collect():
        out[r["f"]].append((r["v"], r["p"], r["n"]))
    return {f: sorted(x) for f, x in out.items()}


def _best(tally: dict[str, list[tuple[int, int, int]]], least: int) -> tuple[Condition | None, int, int]:
    """The condition of the largest gain, and what it covers; thresholds lie midway between values."""
    best, covered, score = None, (0, 0), 0.0
    for feature, counts in tally.items():
        p0, n0 = sum(c[1] for c in counts), sum(c[2] for c in counts)
        p = n = 0
        for (value, a, b), (after, _, _) in zip(counts, counts[1:], strict=False):
            p, n = p + a, n + b
            for above, x, y in ((True, p0 - p, n0 - n), (False, p, n)):
                if x < least:
                    continue
                gain = x * (log2(x / (x + y)) - log2(p0 / (p0 + n0)))
                if gain > score + 1e-9:
                    best, covered, score = Condition(feature, above, (value + after) / 2), (x, y), gain
    return best, *covered


def learn(labelled: DataFrame, most_rules: int = 8, most_conditions: int = 3, precision: float = 0.95, least: int = 5) -> list[Rule]:
    """Rules that mark bad rows; ``labelled`` has the features, ``bad`` (0 or 1) and ``part`` (0 or 1 to grow, 2 to prune).

    Rows with equal values fall on the same side of every threshold. Without rows
    of both kinds there are no rules.
    """
    rules: list[Rule] = []
    while len(rules) < most_rules:
        open_ = labelled.filter(~reduce(lambda a, b: a | b, (_all(r) for r in rules), F.lit(False)))
        rule: Rule = ()
        while len(rule) < most_conditions:
            condition, p, n = _best(_tally(open_.filter((F.col("part") < 2) & _all(rule))), least)
            if condition is None:
                break
            rule += (condition,)
            if n == 0:
                break
        if not rule:
            break
        # What each shorter form of the rule covers of the rows kept back.
        sums = []
        for k in range(1, len(rule) + 1):
            hit = _all(rule[:k])
            sums += [F.sum(F.when(hit, F.col("bad")).otherwise(0)).alias(f"p{k}"), F.sum(F.when(hit, 1 - F.col("bad")).otherwise(0)).alias(f"n{k}")]
        row = open_.filter("part = 2").agg(*sums).first()
        worth = [((row[f"p{k}"] or 0) - (row[f"n{k}"] or 0)) / max(1, (row[f"p{k}"] or 0) + (row[f"n{k}"] or 0)) for k in range(1, len(rule) + 1)]
        k = max(range(len(worth)), key=lambda i: (worth[i], -i)) + 1
        p, n = row[f"p{k}"] or 0, row[f"n{k}"] or 0
        if p == 0 or p / (p + n) < precision:
            break
        rules.append(rule[:k])
    return rules


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality", most_labelled: int = 20_000) -> list[Rule]:
    """Rules from at most ``most_labelled`` labelled documents, those of the smallest id hashes.

    A document labelled more than once is bad if any label says so; documents that
    fail the base rules teach nothing. Without labels there are no rules.
    """
    known = labels.filter(F.col(label).isNotNull() & F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).alias("_id")).agg(F.max((F.col(label) == 0).cast("int")).alias("bad"))
    known = known.orderBy(F.xxhash64("_id"), "_id").limit(most_labelled)
    rows = docs.select(F.col(doc_id).alias("_doc"), F.col(text).alias("text")).join(F.broadcast(known), F.col("_doc") == F.col("_id"))
    part = F.pmod(F.xxhash64("_doc"), F.lit(3)).cast("int").alias("part")
    stats = _where(statistics(rows.select("_doc", "bad", "text"), ["_doc", "bad"]), ~base_failed())
    return learn(stage_table(stats.select("bad", part, *[_feature(f).alias(f) for f in FEATURES]), "labelled"))


def verdict(rules: list[Rule]) -> Column:
    """The number of the first rule that marks a row (from 1), or null."""
    out = F.when(F.lit(False), F.lit(0))
    for i, rule in enumerate(rules, 1):
        marks = ((_feature(c.feature) > c.threshold) if c.above else (_feature(c.feature) <= c.threshold) for c in rule)
        out = out.when(reduce(lambda a, b: a & b, marks), F.lit(i))
    return out


def judge(docs: DataFrame, rules: list[Rule], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, the base counts, base_failed, rule (first that marks the row, or null) and kept.

    A null or empty text has no word and fails the base rules. Rows are judged one
    by one, so repeated rows get the same verdict. Other columns are ignored.
    """
    stats = statistics(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("_t")), ["doc_id"], "_t")
    return stats.select("doc_id", *STATS, base_failed().alias("base_failed"), verdict(rules).alias("rule")).withColumn(
        "kept", ~F.col("base_failed") & F.col("rule").isNull()
    )


def keep_good(docs: DataFrame, rules: list[Rule], text: str = "text") -> DataFrame:
    """The rows, with all their columns, that neither the base rules nor the list reject."""
    stats = statistics(docs.select(F.struct("*").alias("_row"), F.col(text).alias("_t")), ["_row"], "_t")
    return _where(stats, ~base_failed() & verdict(rules).isNull()).select("_row.*")
