"""Quality rules: text statistics, and ordered decision lists learned from labelled ones. Native expressions alone."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACES, WORD, let, text_or_empty

#: Characters that count as symbols (fixed by the contract).
SYMBOLS = "#*$%&|<>"

#: Learned conditions compare these; each is a ratio or a size that a reader can check by hand.
FEATURES = ("n_words", "mean_word", "symbols_per_word", "dup_line_share", "repeat_share", "upper_share", "mark_share", "digit_share", "words_per_line")


def _repeat_words(words: Column) -> Column:
    """Words inside 3-word windows that occur twice or more, the first included; linear but for one sort.

    Windows are compared by 64-bit hash within one text. Most texts repeat none: a hash set settles
    those, and only the others are sorted.
    """

    def covered(windows: Column) -> Column:
        ordered = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def places(s: Column) -> Column:
            twice = F.filter(
                F.transform(s, lambda e, j: F.when((F.get(s, j - 1)["h"] == e["h"]) | (F.get(s, j + 1)["h"] == e["h"]), e["i"])),
                lambda p: p.isNotNull(),
            )
            return let(F.sort_array(twice), lambda p: F.aggregate(F.transform(p, lambda v, j: F.coalesce(F.least(F.lit(3), F.get(p, j + 1) - v), F.lit(3))), F.lit(0), lambda a, x: a + x))

        return let(ordered, places)

    windows = F.transform(F.sequence(F.lit(0), F.size(words) - 3), lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))
    some = let(windows, lambda w: F.when(F.size(F.array_distinct(w)) < F.size(w), covered(w)).otherwise(0))
    return F.when(F.size(words) >= 3, some).otherwise(0)


def _without(text: Column, characters: str) -> Column:
    return F.length(F.translate(text, characters, ""))


def text_statistics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs with one struct column `stats`; null texts count as empty. No shuffle, no Python.

    n_words, word_chars (code points in words), n_symbols, n_dup_lines (lines with a word, equal to
    an earlier line), n_repeat_words (words in 3-word windows found twice or more, first included),
    and counts of upper-case letters, exclamation marks, digits and lines with a word.
    """
    text = text_or_empty(text_col)

    def of(t: Column) -> Column:
        lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(WORD))
        words = let(F.regexp_extract_all(t, F.lit(WORD), F.lit(0)), lambda w: F.struct(F.size(w).cast("long").alias("n"), _repeat_words(w).cast("long").alias("r")))
        counted = let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("d")))
        whole = F.length(t)
        return let(
            F.struct(words.alias("w"), counted.alias("l")),
            lambda s: F.struct(
                s["w"]["n"].alias("n_words"),
                _without(t, SPACES).cast("long").alias("word_chars"),
                (whole - _without(t, SYMBOLS)).cast("long").alias("n_symbols"),
                s["l"]["d"].alias("n_dup_lines"),
                s["w"]["r"].alias("n_repeat_words"),
                (whole - _without(t, "ABCDEFGHIJKLMNOPQRSTUVWXYZ")).cast("long").alias("n_upper"),
                (whole - _without(t, "!")).cast("long").alias("n_marks"),
                (whole - _without(t, "0123456789")).cast("long").alias("n_digits"),
                s["l"]["n"].alias("n_lines"),
            ),
        )

    return docs.withColumn("stats", let(text, of))


def base_failed(stats: Column) -> Column:
    return (stats["n_words"] < 50) | (100 * stats["n_repeat_words"] > 50 * stats["n_words"])


def features(stats: Column) -> dict[str, Column]:
    def share(a: str, b: str) -> Column:
        return F.coalesce(F.try_divide(stats[a].cast("double"), stats[b].cast("double")), F.lit(0.0))

    return {
        "n_words": stats["n_words"].cast("double"), "mean_word": share("word_chars", "n_words"), "symbols_per_word": share("n_symbols", "n_words"),
        "dup_line_share": share("n_dup_lines", "n_lines"), "repeat_share": share("n_repeat_words", "n_words"), "upper_share": share("n_upper", "word_chars"),
        "mark_share": share("n_marks", "n_words"), "digit_share": share("n_digits", "word_chars"), "words_per_line": share("n_words", "n_lines"),
    }


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def holds(self, row: dict[str, float]) -> bool:
        return row[self.feature] >= self.threshold if self.above else row[self.feature] <= self.threshold

    def column(self, of: dict[str, Column]) -> Column:
        return of[self.feature] >= F.lit(self.threshold) if self.above else of[self.feature] <= F.lit(self.threshold)


Rule = tuple[Condition, ...]


def _matches(rule: Rule, row: dict[str, float]) -> bool:
    return all(c.holds(row) for c in rule)


def _best_condition(bad: list[dict], good: list[dict]) -> Condition | None:
    """The threshold of most information gain; a sweep over each feature's sorted values."""
    p0, n0 = len(bad), len(good)
    before, best, gain = math.log2(p0 / (p0 + n0)), None, 1e-9
    for name in FEATURES:
        values = sorted([(r[name], 1) for r in bad] + [(r[name], 0) for r in good])
        p = n = 0
        for i, (v, is_bad) in enumerate(values):
            p, n = p + is_bad, n + 1 - is_bad
            if i + 1 < len(values) and values[i + 1][0] > v:
                middle = (v + values[i + 1][0]) / 2
                for above, pp, nn in ((False, p, n), (True, p0 - p, n0 - n)):
                    if pp and pp * (math.log2(pp / (pp + nn)) - before) > gain:
                        gain, best = pp * (math.log2(pp / (pp + nn)) - before), Condition(name, above, middle)
    return best


def learn(rows: list[dict], max_rules: int = 12, max_conditions: int = 4, min_precision: float = 0.9, min_cover: int = 5) -> list[Rule]:
    """Sequential covering. rows: feature values and `bad`; returns rules in order, each rejecting.

    Two thirds of the rows, dealt in the given order, grow a rule condition by condition until it
    covers no good row; the other third prunes its last conditions away while (p - n) / (p + n) does
    not fall. A rule stays if it covers enough rows and its smoothed precision over all remaining rows
    suffices; the rows that it covers then go. No bad or no good rows: no rules.
    """
    rules: list[Rule] = []
    left = list(rows)
    while len(rules) < max_rules:
        grow, prune = [r for i, r in enumerate(left) if i % 3], left[::3]
        bad, good = [r for r in grow if r["bad"]], [r for r in grow if not r["bad"]]
        rule: Rule = ()
        while bad and good and len(rule) < max_conditions and (c := _best_condition(bad, good)):
            rule = (*rule, c)
            bad, good = [r for r in bad if c.holds(r)], [r for r in good if c.holds(r)]

        def worth(x: Rule) -> float:
            hit = [r["bad"] for r in prune if _matches(x, r)]
            return (2 * sum(hit) - len(hit)) / len(hit) if hit else -1.0

        while len(rule) > 1 and worth(rule[:-1]) >= worth(rule):
            rule = rule[:-1]
        hit = [r["bad"] for r in left if rule and _matches(rule, r)]
        if len(hit) < min_cover or (sum(hit) + 1) / (len(hit) + 2) < min_precision:
            break
        rules.append(rule)
        left = [r for r in left if not _matches(rule, r)]
    return rules


def decision(rules: list[Rule], stats: Column) -> Column:
    """The number of the first rule that holds, from 1; 0 if none does: one ordered conditional expression."""
    of = features(stats)
    out = None
    for i, rule in enumerate(rules, 1):
        both = rule[0].column(of)
        for c in rule[1:]:
            both &= c.column(of)
        out = F.when(both, i) if out is None else out.when(both, i)
    return F.lit(0) if out is None else out.otherwise(0)


def labelled_sample(docs: DataFrame, labels: DataFrame, max_labelled: int, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> list[dict]:
    """Feature rows of at most max_labelled labelled documents, the same ones each time: those of lowest id hash.

    Contradictory and null labels do not count; a repeated id counts once.
    """
    own = labels.groupBy(F.col(id_col).alias("__id")).agg(F.min(label_col).alias("low"), F.max(label_col).alias("high"))
    own = own.filter("__id is not null and low = high").select("__id", (F.col("low") == 0).alias("bad"))
    own = own.orderBy(F.xxhash64("__id"), "__id").limit(max_labelled)
    picked = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text")).join(F.broadcast(own), "__id")
    rows = text_statistics(picked, "__text").select("__id", "bad", *[v.alias(k) for k, v in features(F.col("stats")).items()], F.xxhash64("__text").alias("__h"))
    rows = rows.groupBy("__id", "bad").agg(F.min(F.struct("__h", *FEATURES)).alias("f")).select("__id", "bad", "f.*")
    return [r.asDict() for r in rows.orderBy(F.xxhash64("__id"), "__id").limit(max_labelled).collect()]


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", max_labelled: int = 4000) -> DataFrame:
    """docs with `stats`, `base_failed`, `rule` (the rejecting rule's number or 0) and `kept`.

    The list is learned from at most max_labelled labelled rows whose base rules pass; without
    labels only the base rules reject. Null and empty texts have no words and fail. Rows, repeated
    ones too, and columns stay; a column of docs named like one of these four is replaced.
    """
    rows = labelled_sample(docs, labels, max_labelled, id_col, text_col, label_col)
    rules = learn([r for r in rows if r["n_words"] >= 50 and r["repeat_share"] <= 0.5])
    out = text_statistics(docs.drop("stats", "base_failed", "rule", "kept"), text_col)
    out = out.withColumn("base_failed", base_failed(F.col("stats")))
    out = out.withColumn("rule", decision(rules, F.col("stats")))
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0))
