"""Readers."""

from __future__ import annotations

import json
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from casewright import fixed_values as fv
from casewright.operators.joins import latest_by_key

PREDICTION_SCHEMA = T.StructType([
    T.StructField("ticket_id", T.LongType()),
    T.StructField("input_text", T.StringType()),
    T.StructField("complaint_pred_raw", T.StringType()),
    T.StructField("complaint_pred", T.StringType()),
    T.StructField("severity_pred", T.StringType()),
    T.StructField("sentiment_pred", T.StringType()),
    T.StructField("action_required_pred", T.StringType()),
    T.StructField("root_cause_pred", T.StringType()),
    T.StructField("raw_response", T.StringType()),
    T.StructField("error", T.StringType()),
    T.StructField("row_key", T.StringType()),
    T.StructField("written_at", T.TimestampType()),
])


def exists(spark: SparkSession, path: str) -> bool:
    """Whether the path is there, on whatever file system it names."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def _missing_to_null(df: DataFrame) -> DataFrame:
    return df.withColumns({
        f.name: F.when(~F.col(f.name).isin(fv.CSV_NULL_STRINGS), F.col(f.name))
        for f in df.schema.fields if isinstance(f.dataType, T.StringType)
    })


def read_csv(spark: SparkSession, path: str, multi_line: bool = True, infer: bool = False) -> DataFrame:
    """CSV with a header, every column a string unless ``infer``; the usual missing-value marks become null.

    Quoted line breaks need ``multi_line``, which reads each file in one task. For
    large files without them pass False, so files are split.
    """
    return _missing_to_null(
        spark.read.options(
            header=True, multiLine=multi_line, quote='"', escape='"', encoding="UTF-8", inferSchema=infer,
        ).csv(path)
    )


def read_tickets_csv(spark: SparkSession, path: str, multi_line: bool = True, infer: bool = False) -> DataFrame:
    return read_csv(spark, path, multi_line, infer)


def read_labels_csv(
    spark: SparkSession, path: str, required: Sequence[str] = ("clean_text",), multi_line: bool = True,
) -> DataFrame:
    """Labels, after a check that the required columns are there."""
    labels = read_csv(spark, path, multi_line)
    absent = [c for c in required if c not in labels.columns]
    if absent:
        raise ValueError(f"columns {absent} not found in the labels; available columns: {labels.columns}")
    return labels


def read_predictions(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame | None:
    """Predictions from parquet or CSV by suffix; None if the path is not there, so the run is skipped."""
    if not exists(spark, path):
        return None
    if path.rstrip("/").endswith((".parquet", ".pq")):
        return spark.read.parquet(path)
    return read_csv(spark, path, multi_line)


def read_vector_index(spark: SparkSession, path: str) -> DataFrame:
    """The index table; vectors, texts and labels are rows of one table, so they cannot drift apart."""
    if not exists(spark, path):
        raise FileNotFoundError(f"no vector index at {path}; build it first")
    index = spark.read.parquet(path)
    absent = {"row_index", "embedding", "text"} - set(index.columns)
    if absent:
        raise ValueError(f"vector index at {path} lacks {sorted(absent)}")
    return index


def children(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a path, sorted; none if it is not there."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in system.listStatus(hadoop_path)) if system.exists(hadoop_path) else []


#: Conditions under which a file is not a readable parquet file. Anything else is raised.
_UNREADABLE = ("CANNOT_READ_FILE_FOOTER", "FAILED_READ_FILE", "UNABLE_TO_INFER_SCHEMA")


def _own_schema(spark: SparkSession, path: str) -> tuple[str, T.StructType | None, str | None]:
    try:
        return path, spark.read.parquet(path).schema, None
    except (PySparkException, Py4JJavaError) as failure:
        why = next((line for line in str(failure).split("\n") if any(name in line for name in _UNREADABLE)), None)
        if why is None:
            raise
        return path, None, why[why.index("["):][:300] if "[" in why else why[:300]


def partial_files(spark: SparkSession, path: str, threads: int = 16) -> tuple[dict[str, list[str]], list[tuple[str, str]]]:
    """(files by their own schema as JSON, unreadable files with the reason) below ``path``.

    Listing and footers only: a few bytes a file come to the driver, and files are looked at side by side.
    """
    listed = spark.read.format("binaryFile").options(recursiveFileLookup=True, pathGlobFilter="*.parquet").load(path)
    files = [r["path"] for r in listed.select("path").toLocalIterator()]
    by_schema: dict[str, list[str]] = {}
    unreadable = []
    with ThreadPoolExecutor(threads) as pool:
        for file, schema, reason in pool.map(lambda f: _own_schema(spark, f), sorted(files)):
            if schema is None:
                unreadable.append((file, reason))
            else:
                by_schema.setdefault(schema.json(), []).append(file)
    return by_schema, unreadable


def _common_schema(schemas: list[T.StructType]) -> T.StructType:
    """Every column of any schema; a column whose type differs is a string."""
    kinds: dict[str, set[str]] = {}
    for schema in schemas:
        for field in schema.fields:
            kinds.setdefault(field.name, set()).add(field.dataType.json())
    first = {f.name: f.dataType for schema in reversed(schemas) for f in schema.fields}
    return T.StructType([T.StructField(n, first[n] if len(k) == 1 else T.StringType()) for n, k in kinds.items()])


def checked_partials(
    spark: SparkSession, path: str, schema: T.StructType | None = PREDICTION_SCHEMA, key: str = "ticket_id", latest: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """(rows of all readable checkpoint files below ``path``, quarantine table of the others: path, reason).

    Columns and types may differ from file to file: files of one schema are read together and cast to ``schema`` (None: all
    columns found; one whose types differ becomes a string). What a file lacks is null, as is a value that has no
    counterpart in the wanted type, so no row is lost to a drifting type. Rows of quarantined files are simply done again.
    """
    by_schema, unreadable = partial_files(spark, path) if exists(spark, path) else ({}, [])
    own = {text: T.StructType.fromJson(json.loads(text)) for text in by_schema}
    wanted = schema or (_common_schema(list(own.values())) if own else PREDICTION_SCHEMA)
    rows = empty_result(spark, wanted)
    for text, files in by_schema.items():
        have = {f.name: f.dataType for f in own[text].fields}
        cast = [F.col(f.name) if have.get(f.name) == f.dataType else
                (F.col(f.name).try_cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name) for f in wanted.fields]
        part = spark.read.schema(own[text]).parquet(*files).select(*cast)
        rows = rows.unionByName(part)
    quarantine = spark.createDataFrame(unreadable, "path string, reason string")
    return (latest_by_key(rows, key) if latest else rows), quarantine


def read_partials(
    spark: SparkSession, path: str, schema: T.StructType | None = PREDICTION_SCHEMA, key: str = "ticket_id", latest: bool = True,
) -> DataFrame:
    """The rows of ``checked_partials``."""
    return checked_partials(spark, path, schema, key, latest)[0]


def empty_result(spark: SparkSession, schema: T.StructType = PREDICTION_SCHEMA) -> DataFrame:
    return spark.createDataFrame([], schema)


def read_label_mappings(spark: SparkSession, path: str) -> DataFrame:
    """The JSON label dictionary as (domain, variant, canonical)."""
    pairs = T.MapType(T.StringType(), T.StringType())
    schema = T.StructType([T.StructField(name, pairs) for name in fv.LABEL_DICTIONARY])
    whole = spark.read.option("multiLine", True).schema(schema).json(path)
    entries = None
    for name in fv.LABEL_DICTIONARY:
        part = whole.select(
            F.lit(name.removesuffix("_mapping")).alias("domain"), F.explode(name).alias("variant", "canonical"))
        entries = part if entries is None else entries.unionByName(part)
    return entries


def label_mappings(spark: SparkSession) -> DataFrame:
    """The built-in label dictionary, same columns."""
    rows = [
        (name.removesuffix("_mapping"), variant, canonical)
        for name, pairs in fv.LABEL_DICTIONARY.items() for variant, canonical in pairs.items()
    ]
    return spark.createDataFrame(rows, "domain string, variant string, canonical string")
