"""Readers and writers: JSON lines, CSV, Parquet, text; field mappings; routed and report sinks."""

from __future__ import annotations

import re
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

MAIN_FIELDS = ("code", "repo", "path", "language")
CORRUPT = "_corrupt_record"
#: Field mappings of common sources: canonical name -> source field.
MAPPINGS = {
    "codeparrot": {"code": "code", "repo": "repo_name", "path": "path", "language": "language", "license": "license", "size": "size"},
    "records": {c: c for c in "code repo path language identifier parameters code_tokens original_docstring comment".split()},
    "csn": {"code": "original_string", "repo": "repo", "path": "path", "language": "language"},
    "stack": {"code": "content", "repo": "max_stars_repo_name", "path": "max_stars_repo_path", "language": "lang", "license": "max_stars_repo_licenses", "hexsha": "hexsha", "ext": "ext", "size": "size", "stars_count": "max_stars_count", "issues_count": "max_issues_count", "forks_count": "max_forks_count"},
}


def read_mapping(path: str) -> dict[str, str]:
    """`name: field` lines of a mapping file; nesting is ignored, comments and quotes are dropped."""
    found = {}
    for line in Path(path).read_text().splitlines():
        m = re.match(r"\s*-?\s*([\w-]+)\s*:\s*['\"]?([\w.-]+)['\"]?\s*(?:#.*)?$", line)
        if m:
            found[m[1]] = m[2]
    return found


def project(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Canonical columns. The four main fields must be mapped, and all mapped fields be there."""
    lost = [k for k in MAIN_FIELDS if k not in mapping] + [v for v in mapping.values() if v.split(".")[0] not in df.columns]
    if lost:
        raise KeyError(f"not mapped or not in the source: {lost}")
    return df.select(*[F.col(field).alias(name) for name, field in mapping.items()])


def read_jsonl(spark: SparkSession, path: str | list[str], schema: StructType | str, bad: str = "drop") -> DataFrame:
    """JSON lines. bad: "drop" lines that don't parse, "keep" them (fields null, the line in _corrupt_record), or "fail"."""
    for p in [path] if isinstance(path, str) else path:
        if Path(p).suffix and not p.endswith(("json", "jsonl")):
            raise ValueError(f"expected .json or .jsonl: {p}")
    if bad == "fail":
        return spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    if bad == "drop":
        return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)
    fields = schema.simpleString()[7:-1] if isinstance(schema, StructType) else schema
    return spark.read.schema(f"{fields}, {CORRUPT} string").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).json(path)


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.text(path)


def read_csv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def read_parquet(spark: SparkSession, path: str, language: str | None = None) -> DataFrame:
    """A table, of one language if asked; the condition prunes partitions or reaches the scan."""
    df = spark.read.parquet(path)
    return df if language is None else df.where(F.col("language") == language)


def flatten_benchmark(df: DataFrame) -> DataFrame:
    """(id, docstring, code) of benchmark items that have declaration and canonical_solution."""
    return df.select(F.coalesce(*[F.col(c).cast("string") for c in ("id", "task_id", "problem_id") if c in df.columns]).alias("id"), F.col("docstring"), F.concat("declaration", "canonical_solution").alias("code"))


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).json(path)


def write_same_name(df: DataFrame, source: str, folder: str) -> str:
    """JSON lines in `folder`, under the source's own name. Returns the path."""
    path = f"{folder.rstrip('/')}/{source.rstrip('/').rpartition('/')[2]}"
    write_jsonl(df, path)
    return path


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).csv(path)


def write_if_absent(df: DataFrame, path: str) -> None:
    df.write.mode("ignore").json(path)


def write_sets(df: DataFrame, path: str) -> None:
    """One folder for each set_name, in one pass."""
    df.write.mode("overwrite").partitionBy("set_name").json(path)


def write_report(df: DataFrame, path: str) -> None:
    """A small result as one file."""
    df.coalesce(1).write.mode("overwrite").json(path)


def chunks(df: DataFrame, rows: int | None, parts: int, order: list[str]) -> DataFrame:
    """The first `rows` rows by `order`, if given, in `parts` partitions."""
    return (df if rows is None else df.orderBy(*order).limit(rows)).repartition(max(1, parts))
