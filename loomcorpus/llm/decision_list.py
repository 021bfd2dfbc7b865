"""Quality rules: learned decision lists.

Sequential covering over labelled statistics: each rule grows greedily by the threshold
condition of most information gain (FOIL's measure, over all thresholds) on two thirds of the rows, then
loses trailing conditions while that helps on the rest, and the rows it covers leave. It ends
with the first rule that isn't pure enough, or covers no more than chance would give the best of all
thresholds. The ordered rules become one chained Spark `when` over built-in columns, so that a
corpus of any size is filtered without Python. Statistics are columns of their own, made once for a row.
"""

from __future__ import annotations

import math
import re

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import durable, labelled_sample, unused

#: Bound of the labelled rows that the list is fitted on.
FIT_ROWS = 20_000
#: A rule rejects if so many of the labelled rows that it covers are bad.
PRECISION = 0.9
#: Rules and markers must be beyond chance at this level, for all candidates together.
LEVEL = 0.05
#: A marker is a word head that occurs with rejected documents beyond chance, and hardly elsewhere.
MARKER_HEAD, MARKER_PURITY = 4, 0.97


def mine_markers(rows: DataFrame, head: int = MARKER_HEAD) -> list[str]:
    """Word heads (of letters) that all but never occur in good documents. rows: text, bad.

    Counted where the texts are; the driver gets the heads that qualify, which the sample bounds.
    """
    base = rows.agg(F.avg(F.col("bad").cast("int"))).first()[0] or 0
    if not 0 < base < 1:
        return []
    found = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(rf"(?<!\p{{L}})\p{{L}}{{{head}}}"), F.lit(0)))
    counts = durable(rows.select(F.explode(found).alias("x"), F.col("bad").cast("int").alias("b")).groupBy("x").agg(F.count("*").alias("n"), F.sum("b").alias("hit")))
    need = math.log(max(counts.count(), 1) / LEVEL) / math.log(1 / base)
    return sorted(r["x"] for r in counts.where((F.col("hit") >= need) & (F.col("hit") >= MARKER_PURITY * F.col("n"))).collect())


def trie_pattern(words: list[str]) -> str:
    """One regular expression for all the words, sharing their heads."""
    root: dict = {}
    for w in words:
        at = root
        for c in w:
            at = at.setdefault(c, {})

    def show(node: dict) -> str:
        parts = [re.escape(c) + show(n) for c, n in sorted(node.items())]
        return "" if not parts else parts[0] if len(parts) == 1 else "(?:" + "|".join(parts) + ")"

    return show(root)


def with_statistics(docs: DataFrame, markers: list[str]) -> tuple[DataFrame, dict[str, str]]:
    """docs with the statistics that rules are made of, and their columns' names; a null text counts as empty."""
    text = F.coalesce(F.col("text"), F.lit(""))
    names: dict[str, str] = {}

    def name(x: str) -> str:
        names[x] = unused([*docs.columns, *names.values()], f"__{x}")
        return names[x]

    # What several statistics share comes first, so that it is made once.
    shared = docs.withColumns({name("words"): F.filter(F.split(text, r"\s+"), lambda w: w != ""), name("lines"): F.split(text, "\n", -1)})
    words, lines = F.col(names["words"]), F.col(names["lines"])
    n = F.greatest(F.length(text), F.lit(1)).cast("double")
    per_word = F.greatest(F.size(words), F.lit(1)).cast("double")
    share = lambda p: (F.length(text) - F.length(F.regexp_replace(text, p, ""))) / n
    stats = {
        "n_chars": F.length(text).cast("double"),
        "n_words": F.size(words).cast("double"),
        "word_length": F.length(F.regexp_replace(text, r"\s+", "")) / per_word,
        "symbol_share": share(r"[^\p{L}\p{N}\s.,;:'\"()-]+"),
        "upper_share": share(r"\p{Lu}+"),
        "digit_share": share(r"[0-9]+"),
        "distinct_words": F.size(F.array_distinct(words)) / per_word,
        "bar_share": (F.length(text) - F.length(F.replace(text, F.lit("|"), F.lit("")))) / n,
        "same_lines": 1 - F.size(F.array_distinct(lines)) / F.size(lines),
        "marker_words": (F.regexp_count(F.lower(text), F.lit(r"(?<!\p{L})" + trie_pattern(markers))) if markers else F.lit(0)).cast("double"),
    }
    out = shared.withColumns({name(k): c for k, c in stats.items()})
    return out, {k: names[k] for k in stats}


class Rule:
    """A conjunction of (statistic, "<=" or ">", threshold) conditions."""

    def __init__(self, conditions=()):
        self.conditions = tuple(conditions)

    def covers(self, x: dict[str, np.ndarray]) -> np.ndarray:
        out = np.ones(len(next(iter(x.values()))), bool)
        for name, op, at in self.conditions:
            out &= x[name] <= at if op == "<=" else x[name] > at
        return out

    def column(self, stats: dict[str, str]) -> Column:
        out = F.lit(True)
        for name, op, at in self.conditions:
            v = F.col(stats[name])
            out &= v <= F.lit(float(at)) if op == "<=" else v > F.lit(float(at))
        return out

    def __str__(self):
        return " and ".join(f"{a} {op} {at:.6g}" for a, op, at in self.conditions)


def _best_condition(v: np.ndarray, bad: np.ndarray) -> tuple[float, str, float]:
    """(gain, op, threshold) of the best of all thresholds between neighbouring values; gain 0 if there is none."""
    order = np.argsort(v, kind="stable")
    v, hit = v[order], np.cumsum(bad[order])
    at = np.flatnonzero(v[1:] > v[:-1])
    if not len(at):
        return 0.0, "<=", 0.0
    p0, n0 = float(hit[-1]), float(len(v))
    best = (0.0, "<=", 0.0)
    for op, p, n in (("<=", hit[at].astype(float), at + 1.0), (">", p0 - hit[at], n0 - at - 1.0)):
        gain = p * (np.log2(np.maximum(p, 1e-300) / n) - math.log2(p0 / n0))
        k = int(np.argmax(gain))
        if gain[k] > best[0] + 1e-9:
            best = (float(gain[k]), op, float((v[at[k]] + v[at[k] + 1]) / 2))
    return best


def _grow(x: dict[str, np.ndarray], bad: np.ndarray) -> Rule:
    rule, inside = Rule(), np.ones(len(bad), bool)
    while (~bad[inside]).any():
        gain, name, op, at = max(((g, k, o, t) for k, v in x.items() for g, o, t in [_best_condition(v[inside], bad[inside])]), key=lambda c: c[0])
        if gain <= 1e-9:
            break
        rule = Rule((*rule.conditions, (name, op, at)))
        inside = rule.covers(x)
    return rule


def _prune(rule: Rule, x: dict[str, np.ndarray], bad: np.ndarray) -> Rule:
    def worth(r: Rule) -> float:
        c = r.covers(x)
        p, n = int((c & bad).sum()), int((c & ~bad).sum())
        return (p - n) / (p + n) if p + n else -1.0

    best, value = rule, worth(rule)
    for k in range(len(rule.conditions) - 1, 0, -1):
        short = Rule(rule.conditions[:k])
        if (w := worth(short)) >= value:
            best, value = short, w
    return best


def learn(x: dict[str, np.ndarray], bad: np.ndarray, precision: float = PRECISION) -> list[Rule]:
    """Ordered rules for rejection. Stops where a rule isn't `precision` pure on all rows or covers too few."""
    rules: list[Rule] = []
    order = np.random.default_rng(7).permutation(len(bad))
    x, bad = {k: v[order] for k, v in x.items()}, bad[order]
    candidates = sum(2 * len(np.unique(v)) for v in x.values())
    while 0 < bad.sum() < len(bad):
        need = math.log(candidates / LEVEL) / math.log(len(bad) / bad.sum())
        third = np.arange(len(bad)) % 3 == 2
        pick = lambda m: {k: v[m] for k, v in x.items()}  # noqa: E731, B023
        if not bad[~third].any():
            break
        rule = _prune(_grow(pick(~third), bad[~third]), pick(third), bad[third])
        c = rule.covers(x)
        if not rule.conditions or bad[c].sum() < need or bad[c].mean() < precision:
            break
        rules.append(rule)
        x, bad = pick(~c), bad[~c]
    return rules


class DecisionList:
    """Markers and ordered rules, fitted on at most FIT_ROWS labelled documents.

    A document is bad if it is toxic or of low quality. No labels, or labels of one
    kind only, give an empty list, which rejects nothing.
    """

    def __init__(self, docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS):
        sample = labelled_sample(docs, labels, fit_rows).select("doc_id", "text", ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad"))
        sample = durable(sample)
        self.markers = mine_markers(sample)
        stats, names = with_statistics(sample, self.markers)
        rows = stats.select("doc_id", "bad", *names.values()).toArrow().sort_by("doc_id")  # numbers, no texts
        bad = np.array(rows.column("bad").to_pylist(), bool)
        self.rules: list[Rule] = learn({k: rows.column(c).to_numpy().astype(float) for k, c in names.items()}, bad) if 0 < bad.sum() < len(bad) else []

    def judged(self, docs: DataFrame, name: str) -> DataFrame:
        """docs and, as column `name`, the number of the first rule that holds, from 1; 0 if none does."""
        if not self.rules:
            return docs.withColumn(name, F.lit(0))
        stats, names = with_statistics(docs, self.markers)
        out = F.lit(0)
        for k in range(len(self.rules), 0, -1):
            out = F.when(self.rules[k - 1].column(names), F.lit(k)).otherwise(out)
        return stats.withColumn(name, out).select(*[F.col(f"`{c}`") for c in docs.columns], name)


def judge(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """(doc_id, rule, keep): the rule that rejects each document, 0 and keep=true where none does.

    Row by row, so repeated rows repeat, null ids stay null; null and empty texts have
    statistics of 0 and are judged by the same rules, as are texts of any length. An empty table
    gives no rows. Extra columns are ignored.
    """
    rows = DecisionList(docs, labels, fit_rows).judged(docs.select("doc_id", "text"), "rule")
    return rows.select("doc_id", "rule", (F.col("rule") == 0).alias("keep"))


def keep_good(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """Documents that no rule rejects, all columns as they are.

    Null and empty texts are judged like others, by statistics of 0; rows of equal text are judged alike. An
    empty table gives an empty one; extra columns pass through under any name.
    """
    rule = unused(docs.columns, "__rule")
    return DecisionList(docs, labels, fit_rows).judged(docs, rule).where(F.col(rule) == 0).select(*[f"`{c}`" for c in docs.columns])
