"""Landing-zone CSV scans: one headered CSV file, or a folder of them, per table.

Everything is read as text: no inference pass.  Columns are found by the header's
names, in any order; columns that the registry does not know are ignored, a missing
one fails the load, and so does a file of a folder whose header differs from the
others'.  Quoted fields may hold commas, doubled quotes and, with ``multi_line``,
line breaks (a file is then read by one task; turn it off for files that are too
large for that and have none).  Rows with too few or too many fields come back in
``CORRUPT`` with their text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.registry import TableSpec

CORRUPT = "_corrupt_row"


def landing_path(landing_dir: str, table: str) -> str:
    return f"{landing_dir.rstrip('/')}/{table}.csv"


def _configured(reader, multi_line: bool):
    return (reader.option("header", True).option("quote", '"').option("escape", '"')
            .option("multiLine", multi_line).option("pathGlobFilter", "*.csv"))


def landing_schema(spark: SparkSession, spec: TableSpec, path: str, multi_line: bool = True,
                   recursive: bool = False) -> T.StructType:
    """The header's columns as text, checked against the registry, plus ``CORRUPT``."""
    names = _configured(spark.read, multi_line).option("recursiveFileLookup", recursive).csv(path).columns
    missing = [c for c in spec.column_names if c not in names]
    if missing:
        raise ValueError(f"{path}: header lacks {missing} of table {spec.name}")
    return T.StructType([T.StructField(n, T.StringType()) for n in [*names, CORRUPT]])


def configured_reader(reader, schema: T.StructType, multi_line: bool = True):
    """A batch or stream reader with the landing options."""
    return (_configured(reader, multi_line).schema(schema)
            .option("enforceSchema", False)
            .option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT)
            .option("columnPruning", False))


def landing_columns(df: DataFrame, spec: TableSpec) -> DataFrame:
    return df.select(*spec.column_names, F.col("_metadata.file_name").alias("_source_file"),
                     F.col("_metadata.file_path").alias("_source_path"), CORRUPT)


def read_landing(spark: SparkSession, spec: TableSpec, path: str, multi_line: bool = True) -> DataFrame:
    """Declared columns as text, ``_source_file`` (the file's name), ``_source_path``
    and ``CORRUPT`` (null for whole rows)."""
    schema = landing_schema(spark, spec, path, multi_line)
    return landing_columns(configured_reader(spark.read, schema, multi_line).csv(path), spec)
