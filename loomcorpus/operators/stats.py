"""Corpus statistics: counts, token volumes, distributions, docstring attributes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ATTRIBUTES = ("params", "outlier_params", "returns", "raises", "others")


def volume(df: DataFrame, by: str, docstring: str) -> DataFrame:
    """Rows, and rows without documentation (null or blank)."""
    blank = F.coalesce(~F.col(docstring).rlike(r"\S"), F.lit(True))
    return df.groupBy(by).agg(F.count("*").alias("n"), F.count_if(blank).alias("none_docstring"))


def token_volume(df: DataFrame, by: str, tokens: str) -> DataFrame:
    """All and distinct tokens. Distinct ones are counted over (group, token) pairs, which combine before the shuffle."""
    pairs = df.select(by, F.explode(tokens).alias("t")).groupBy(by, "t").count()
    return pairs.groupBy(by).agg(F.sum("count").alias("all_tokens"), F.count("*").alias("unique_tokens"))


def union_of_tokens(df: DataFrame, tokens: str) -> DataFrame:
    return df.select(F.explode(tokens).alias("t")).distinct().agg(F.count("*").alias("unique_tokens"))


def summary(df: DataFrame, by: str, value: str) -> DataFrame:
    v = F.col(value)
    return df.groupBy(by).agg(F.avg(v).alias("mean"), F.median(v).alias("median"), F.max(v).alias("max"), F.min(v).alias("min"), F.stddev_pop(v).alias("std"), F.count(v).alias("n"))


def quartiles(df: DataFrame, by: str, value: str) -> DataFrame:
    q = F.percentile(value, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    return df.groupBy(by).agg(q.alias("q"), F.avg(value).alias("mean")).select(by, *[F.col("q")[k].alias(f"q{k + 1}") for k in range(3)], "mean")


def histogram(df: DataFrame, by: str, value: str, most: int) -> DataFrame:
    return df.where(F.col(value) <= most).groupBy(by, value).agg(F.count("*").alias("n")).orderBy(by, value)


def length_distribution(df: DataFrame, by: str, tokens: str) -> DataFrame:
    """(group, length, rows): the distribution as counts, which stay small however many rows there are."""
    return df.groupBy(by, F.size(tokens).alias("length")).agg(F.count("*").alias("n"))


def breakdown(raw: DataFrame, clean: DataFrame, by: str) -> DataFrame:
    """raw: (by, n, none_docstring); clean: (by, n). What was filtered, was noise, had no documentation; and totals."""
    both = raw.join(clean.select(by, F.col("n").alias("clean")), by, "left").withColumn("clean", F.coalesce("clean", F.lit(0)))
    noise = F.col("n") - F.col("none_docstring") - F.col("clean")
    each = both.select(by, "n", "none_docstring", "clean", noise.alias("noise"))
    total = each.agg(F.lit("total").alias(by), *[F.sum(c).alias(c) for c in ("n", "none_docstring", "clean", "noise")])
    return each.unionByName(total).withColumn("ratio", F.col("clean") / F.col("n"))


def attribute_count(params: Column) -> Column:
    """Entries of a docstring_params struct."""
    out = F.lit(0)
    for name in ATTRIBUTES:
        out = out + F.coalesce(F.size(params[name]), F.lit(0))
    return out


def documented_parts(params: Column) -> Column:
    """Returns, raises, others and outliers, and parameters with a text that isn't blank."""
    named = F.size(F.filter(params["params"], lambda p: F.coalesce(p["docstring"].rlike(r"\S"), F.lit(False))))
    out = F.coalesce(named, F.lit(0))
    for name in ATTRIBUTES[1:]:
        out = out + F.coalesce(F.size(params[name]), F.lit(0))
    return out


def documented(df: DataFrame, by: str, params: str = "docstring_params") -> DataFrame:
    return df.groupBy(by).agg(F.count("*").alias("n"), F.count_if(documented_parts(F.col(params)) > 0).alias("with_parts"), F.sum(attribute_count(F.col(params))).alias("attributes"))
