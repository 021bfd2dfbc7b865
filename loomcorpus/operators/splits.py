"""Keep-first dedup, decile bins, and splits that keep a repository in one set."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

TEST_SIZE, SMALL, MEDIUM = 20_000, 0.05, 0.25
DECILES = [k / 10 for k in range(1, 10)]


def with_id(df: DataFrame, code: str = "code", to: str = "id") -> DataFrame:
    return df.withColumn(to, F.sha2(F.col(code), 256))


def keep_first(df: DataFrame, key: str | list[str], order: list) -> DataFrame:
    """The first row of each key. min_by over whole rows: partial aggregation, no sort of a hot key.

    Long texts are grouped by their digest of 128 bits, so that they are shuffled once, in the row.
    """
    types = dict(df.dtypes)
    keys = [F.md5(k).alias(f"__k{i}") if types[k] == "string" else F.col(k) for i, k in enumerate([key] if isinstance(key, str) else key)]
    first = df.groupBy(*keys).agg(F.min_by(F.struct(*df.columns), F.struct(*order)).alias("row"))
    return first.select("row.*")


def by_repo(df: DataFrame, repo: str, *lengths: str) -> DataFrame:
    return df.groupBy(repo).agg(*[F.avg(c).alias(f"mean_{c}") for c in lengths], F.count("*").alias("n"))


def quantile_bins(df: DataFrame, value: str, to: str = "bin") -> DataFrame:
    """Right-closed bins between exact deciles, from 0. The edges are one row, so the join broadcasts them."""
    edges = df.agg(F.percentile(value, F.array(*map(F.lit, DECILES))).alias("__edges"))
    n = F.aggregate("__edges", F.lit(0), lambda a, e: a + F.when(F.col(value) > e, 1).otherwise(0))
    return df.crossJoin(F.broadcast(edges)).withColumn(to, n).drop("__edges")


def split_repos(df: DataFrame, repo: str, length: str, shares: dict[str, Column | float], rest: str = "train", seed: int = 42) -> DataFrame:
    """(repo, set_name): in each decile of mean length, repositories in order of a seeded hash fill the sets in turn.

    shares: the part of repositories that each set takes, in order; the others are `rest`.
    """
    binned = quantile_bins(by_repo(df, repo, length), f"mean_{length}")
    w = Window.partitionBy("bin")
    place = F.row_number().over(w.orderBy(F.md5(F.concat(F.lit(f"{seed}:"), F.col(repo))), repo)) / F.count("*").over(w)
    name, upto = F.lit(None).cast("string"), F.lit(0.0)
    for s, share in shares.items():
        upto = upto + share
        name = F.coalesce(name, F.when(place <= upto, F.lit(s)))
    return binned.select(repo, F.coalesce(name, F.lit(rest)).alias("set_name"))


def train_eval_test(df: DataFrame, repo: str, length: str, size: int = TEST_SIZE) -> DataFrame:
    """Every row with its set: about `size` rows each go to eval and test."""
    share = size / max(df.count(), 1)
    return df.join(split_repos(df, repo, length, {"test": share, "eval": share}), repo)


def train_sizes(df: DataFrame, repo: str, length: str) -> DataFrame:
    """Every row of a train set as small_train, medium_train or large_train."""
    return df.join(split_repos(df, repo, length, {"small_train": SMALL, "medium_train": MEDIUM}, "large_train"), repo)


def assign(content: DataFrame, sets: DataFrame, key: str = "id") -> DataFrame:
    """Content with its set; what no list names is train. Names without content are dropped."""
    return content.join(sets.select(key, "set_name"), key, "left").withColumn("set_name", F.coalesce("set_name", F.lit("train")))


def full_train(df: DataFrame) -> DataFrame:
    return df.where(~F.col("set_name").isin("eval", "test"))
