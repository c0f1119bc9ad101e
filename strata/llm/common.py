"""Small helpers shared by the operators of this folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The six ASCII white-space characters.
ASCII_SPACES = " \t\n\x0b\x0c\r"


ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # Python workers import this package from where the driver has it, unless the
    # cluster has it installed or was given a path of its own.
    spark.sparkContext.environment.setdefault("PYTHONPATH", ROOT)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (``spark.checkpoint.dir``).

    Only a local session may go without the setting; it gets a scratch folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    own = tempfile.mkdtemp(prefix="strata-llm-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.conf.set("spark.checkpoint.dir", own)
    return own


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: a lost executor
    costs no recomputation, and the planner knows the table's real size."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


# What this process, a Python worker, keeps from task to task.
_KEPT: dict[tuple, object] = {}


def kept(key: tuple, make: Callable[[], object]) -> object:
    """``make()``, kept for the worker's next tasks until another key is asked for: workers
    serve one operator after the other, and hold what one of them needs, not all."""
    if key not in _KEPT:
        release()
        _KEPT[key] = make()
    return _KEPT[key]


def release() -> None:
    """Give back what an earlier operator's tasks kept; for operators that keep nothing."""
    if _KEPT:
        import gc

        import pyarrow as pa
        _KEPT.clear()
        gc.collect()
        pa.default_memory_pool().release_unused()


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind ``value`` to a lambda variable, so that ``body`` may use it many
    times (also inside other lambdas) while it is computed once per row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def text_of(column: str) -> Column:
    """A text column with null read as the empty text."""
    return F.coalesce(F.col(column), F.lit(""))


def free_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have (names differ in more than case)."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base
