"""From source files to records, in stages that are only computed when asked for."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import predicates as P
from ..functions.transforms import first_sentence
from ..operators.clean import cleaned
from ..operators.docstyles import STYLES, parsed_docstring
from ..operators.extract import extract
from ..operators.splits import with_id
from ..sources.tables import project, write_jsonl


def raw(files: DataFrame, mapping: dict[str, str] | None = None, level: str = "function") -> DataFrame:
    source = files if mapping is None else project(files, mapping)
    return extract(source.withColumn("license", F.to_json("license") if dict(source.dtypes).get("license", "string") != "string" else F.col("license") if "license" in source.columns else F.lit(None).cast("string")), level)


def filtered(records: DataFrame, loose: bool = True) -> DataFrame:
    """Records with a cleaned docstring; tokens stay those of the original."""
    some = records.where(F.col("original_docstring").isNotNull())
    return some.withColumn("docstring", cleaned(F.col("original_docstring"), loose)).where("docstring is not null")


def filtered_inline(records: DataFrame) -> DataFrame:
    return records.withColumn("comment", cleaned(F.col("original_comment"))).where("comment is not null")


def extracted(records: DataFrame) -> DataFrame:
    """Filtered records with the parts of their docstring; languages without a style drop out."""
    known = records.where(F.col("language").isin(*STYLES))
    parsed = known.withColumn("__p", parsed_docstring(F.col("original_docstring"), F.col("parameters"), F.col("language"))).where("__p.docstring is not null")
    return parsed.drop("docstring", "docstring_tokens").select("*", "__p.*").drop("__p")


#: Columns of a finished record, by the kind of their type.
COLUMNS = {"repo": "string", "path": "string", "language": "string", "license": None, "identifier": None, "parameters": "map", "code": "string", "code_tokens": "array", "comment": None, "docstring": "string", "docstring_tokens": "array", "docstring_params": "struct", "short_docstring": "string", "short_docstring_tokens": "array"}


def check_schema(records: DataFrame) -> None:
    """Finished records have all COLUMNS, of their types."""
    types = dict(records.dtypes)
    wrong = [c for c, kind in COLUMNS.items() if c not in types or (kind and not types[c].startswith(kind))]
    if wrong:
        raise TypeError(f"missing, or of another type: {wrong}")


def valid(records: DataFrame) -> DataFrame:
    """Records whose typed columns, those of COLUMNS that are there, aren't null, and whose code and docstring aren't empty."""
    ok = F.lit(True)
    for c in (c for c, kind in COLUMNS.items() if kind and c in records.columns):
        ok &= F.col(c).isNotNull()
    return records.where(ok & (F.col("docstring") != "") & (F.col("code") != ""))


def run(files: DataFrame, path: str, mapping: dict[str, str] | None = None, level: str = "function", upto: str = "extracted", loose: bool = True) -> dict[str, int]:
    """Write each stage and go on from what is written, so that extraction runs once. Returns rows by stage."""
    spark, counts = files.sparkSession, {}
    steps = [("raw", lambda df: raw(df, mapping, level)), ("filtered", filtered_inline if level == "inline" else lambda df: filtered(df, loose))]
    if level != "inline":
        steps.append(("extracted", lambda df: valid(extracted(df))))
    df = files
    for name, step in steps:
        out = step(df)
        write_jsonl(out, f"{path}/{name}")
        df = spark.read.schema(out.schema).json(f"{path}/{name}")
        counts[name] = df.count()
        if name == upto:
            break
    return counts


def merged(records: DataFrame) -> DataFrame:
    """Records with an id and a short docstring, where it was missing."""
    df = with_id(records)
    short = F.col("short_docstring") if "short_docstring" in df.columns else F.lit(None).cast("string")
    return df.withColumn("short_docstring", F.coalesce(short, first_sentence(F.col("docstring"))))


def split_meta(records: DataFrame) -> DataFrame:
    return records.select(F.col("id").alias("ID"), F.col("repo").alias("Repo Name"), F.length("code").cast("bigint").alias("Code Length"), F.length("docstring").cast("bigint").alias("Docs Length"))


def kept_by_language(docs: DataFrame) -> DataFrame:
    """Flagship: documents by language, kept and rejected by the cheapest rules."""
    t = F.col("text")
    bad = P.not_english(t) | P.few_letters(t) | P.bad_length(t)
    return docs.groupBy("lang").agg(F.count_if(~bad).alias("kept"), F.count_if(bad).alias("rejected"))
