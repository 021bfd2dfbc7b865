"""Licence and length policies: filters, per-condition counts and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import predicates as P


def conditions(license: str = "license", docs: str = "n_docstring_tokens", code: str = "n_code_tokens") -> dict[str, Column]:
    return {"has_valid_license": P.licensed(F.col(license)), "valid_docstring_tokens_num": P.documentation_fits(F.col(docs)), "valid_code_tokens_num": P.code_fits(F.col(code))}


def keep_valid(df: DataFrame, tests: dict[str, Column]) -> DataFrame:
    """Rows that pass all; a test that can't be made (null) keeps its row."""
    for test in tests.values():
        df = df.where(F.coalesce(test, F.lit(True)))
    return df


def report(df: DataFrame, tests: dict[str, Column], *by: str) -> DataFrame:
    """Rows, rows that pass each test by itself, rows that pass all, and the share that is left."""
    all_of = F.lit(True)
    for test in tests.values():
        all_of &= F.coalesce(test, F.lit(True))
    n, kept = F.count("*"), F.count_if(all_of)
    return df.groupBy(*by).agg(n.alias("original"), *[F.count_if(t).alias(k) for k, t in tests.items()], kept.alias("filtered"), (kept * 100 / n).alias("percent"))


def invalid(df: DataFrame, license: str = "license") -> DataFrame:
    """Rows with a licence that isn't allowed, or none known."""
    return df.where(~F.coalesce(P.licensed(F.col(license)), F.lit(False)))


def invalid_names(df: DataFrame, license: str = "license") -> DataFrame:
    return df.select(F.explode(license).alias("license")).where(~F.col("license").isin(P.LICENSES)).distinct()
