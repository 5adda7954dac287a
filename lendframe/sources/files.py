"""CSV scans with their checks, and the sinks."""

import json
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendframe import schema as S
from lendframe.operators.cleaning import normalize_columns
from lendframe.operators.profiling import missing_columns, row_count_gate


def _exists(spark: SparkSession, path: str):
    try:
        files = spark.read.format("binaryFile").load(path).select("path", "length").limit(1).collect()
    except Exception as problem:
        if "PATH_NOT_FOUND" in str(problem):
            raise FileNotFoundError(f"input not found: {path}") from problem
        raise
    return files


def read_text_csv(spark: SparkSession, path: str | list[str], encoding: str = "UTF-8",
                  multiline: bool = False) -> DataFrame:
    """All columns as text. Files are split among tasks unless values hold line breaks."""
    return spark.read.csv(path, header=True, inferSchema=False, encoding=encoding,
                          quote='"', escape='"', multiLine=multiline,
                          ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
                          nullValue="", emptyValue="")


def null_tokens_to_null(df: DataFrame) -> DataFrame:
    return df.withColumns({
        f.name: F.when(~F.col(f.name).isin(S.CSV_NULL_TOKENS), F.col(f.name))
        for f in df.schema if isinstance(f.dataType, T.StringType)
    })


def files_by_encoding(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """The files that are not UTF-8, and the others; told by their bytes, file by file."""
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.is_valid_utf8("value").alias("valid"))
    bad = {r.file for r in lines.filter(~F.col("valid")).select("file").distinct().collect()}
    if not bad:
        return {"UTF-8": [path]}
    known = spark.read.format("binaryFile").load(path).select("path", F.col("_metadata.file_path").alias("file")).collect()
    split = {"UTF-8": [r.path for r in known if r.file not in bad], "ISO-8859-1": [r.path for r in known if r.file in bad]}
    return {encoding: paths for encoding, paths in split.items() if paths}


def scan_validated(spark: SparkSession, path: str, validate: bool = True,
                   minimum: int = S.MIN_TRAINING_ROWS, multiline: bool = False,
                   encoding: str | None = None) -> DataFrame:
    """Checked scan: file there, ``.csv``, not empty, columns complete, enough rows.

    With no encoding given, files whose bytes are not UTF-8 are read as Latin-1, the
    others as UTF-8, so a damaged file leaves the others alone.
    """
    if not re.search(r"\.csv/?$", path.lower()):
        raise ValueError(f"expected a .csv input, got {path}")
    if not _exists(spark, path):
        raise ValueError(f"file is empty: {path}")
    split = {encoding: [path]} if encoding else files_by_encoding(spark, path)
    readings = [read_text_csv(spark, paths, name, multiline) for name, paths in split.items()]
    df = readings[0] if len(readings) == 1 else readings[0].unionByName(readings[1], allowMissingColumns=True)
    df = null_tokens_to_null(normalize_columns(df))
    gate = row_count_gate(df, minimum if validate else 1)
    if gate["empty"]:
        raise ValueError(f"file has no rows: {path}")
    if validate:
        missing = missing_columns(df)
        if missing:
            raise ValueError(f"missing expected columns: {missing}")
        if not gate["enough"]:
            raise ValueError(f"too few rows: at least {minimum} expected")
    return df


def scan_batch(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    if not _exists(spark, path):
        raise ValueError(f"batch file is empty: {path}")
    df = null_tokens_to_null(normalize_columns(read_text_csv(spark, path, multiline=multiline)))
    if df.isEmpty():
        raise ValueError(f"batch file is empty: {path}")
    return df


def safe_run_id(run_id) -> Column:
    c = F.col(run_id) if isinstance(run_id, str) else run_id
    return F.translate(c, ":+/", "___")


def batch_date(path) -> Column:
    """Date in a file name such as ``features_2024-01-31.csv``."""
    c = F.col(path) if isinstance(path, str) else path
    return F.to_date(F.regexp_extract(c, r"(\d{4}-\d{2}-\d{2})", 1))


def write_predictions(df: DataFrame, root: str, date: str, run_id: str, fmt: str = "parquet",
                      again: bool = False) -> str:
    """One folder per date and run. An existing one is an error, unless the very run is
    repeated (``again``): it then replaces what its earlier attempt left."""
    run = re.sub(r"[:+/]", "_", run_id)
    path = f"{root.rstrip('/')}/batch_date={date}/run_id={run}"
    writer = df.write.mode("overwrite" if again else "errorifexists")
    (writer.option("header", True).csv if fmt == "csv" else writer.parquet)(path)
    return path


def write_feature_names(df: DataFrame, path: str) -> list[str]:
    """The numeric feature columns of a table, as a JSON list beside it."""
    from lendframe.plans.encoder import numeric_features

    names = numeric_features(df)
    rows = df.sparkSession.createDataFrame([(json.dumps(names),)], "value string")
    rows.coalesce(1).write.mode("overwrite").text(path)
    return names


def write_table(df: DataFrame, path: str, fmt: str = "parquet") -> DataFrame:
    df.write.mode("errorifexists").format(fmt).save(path)
    return df.sparkSession.read.format(fmt).schema(df.schema).load(path)
