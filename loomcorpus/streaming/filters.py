"""The same cleaning over a stream of records, and running counts of what it keeps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import predicates as P
from ..operators.clean import cleaned


def read(spark: SparkSession, path: str, schema: StructType | str, files_a_trigger: int = 1000) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_a_trigger).json(path)


def keep_clean(stream: DataFrame, text: str, loose: bool = False) -> DataFrame:
    """Rows whose cleaned text isn't rejected; stateless, so it runs on any trigger. The cheap test comes first."""
    out = stream.where(~P.not_english(F.col(text))).withColumn("docstring", cleaned(F.col(text), loose))
    return out.where("docstring is not null")


def count_by(stream: DataFrame, time: str, by: str, width: str, late: str) -> DataFrame:
    """Rows of each window and group, closed `late` after their end."""
    return stream.withWatermark(time, late).groupBy(F.window(time, width), by).count()


def first_seen(stream: DataFrame, key: str, time: str, late: str) -> DataFrame:
    """The first row of each key within the watermark, whose state is bounded by it."""
    return stream.withWatermark(time, late).dropDuplicatesWithinWatermark([key])


def write(df: DataFrame, path: str, checkpoint: str):
    return df.writeStream.format("json").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
