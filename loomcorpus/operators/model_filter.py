"""Model filter: keep (docstring, code) pairs that a classifier doesn't call class 0.

The model is any function of two pandas series; batches go through Arrow. A stand-in
that needs nothing but labelled rows is a logistic regression on hashed words.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BATCH = 256


def keep_by_model(df: DataFrame, predict: Callable[[pd.Series, pd.Series], pd.Series], first: str = "docstring", second: str = "code") -> DataFrame:
    """Rows for which predict gives anything but 0. Nulls are given as empty texts."""

    @F.pandas_udf("int")
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        parts = [pd.Series(predict(a[i : i + BATCH], b[i : i + BATCH])) for i in range(0, len(a), BATCH)]
        return pd.concat(parts, ignore_index=True) if parts else pd.Series([], dtype="int32")

    empty = F.lit("")
    return df.where(run(F.coalesce(F.col(first), empty), F.coalesce(F.col(second), empty)) != 0)


def trained_classifier(df: DataFrame, label: str, text: str, features: int = 1 << 16):
    """A pyspark.ml pipeline: words, hashed counts, logistic regression."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import HashingTF, RegexTokenizer

    words = RegexTokenizer(inputCol=text, outputCol="__words", pattern=r"\s+")
    hashed = HashingTF(inputCol="__words", outputCol="__features", numFeatures=features)
    model = LogisticRegression(featuresCol="__features", labelCol=label, predictionCol="prediction", maxIter=20, regParam=0.01)
    return Pipeline(stages=[words, hashed, model]).fit(df)
