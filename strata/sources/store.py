"""Layered table store on any Hadoop-compatible file system.

* ``bronze`` tables and the control logs (``LOGS``) are append-only parquet
  directories in either format; new loads never rewrite old files.
* every other table is a sequence of immutable parquet snapshots
  ``<root>/<layer>/<table>/v00000001``; a snapshot counts once Spark's
  commit marker ``_SUCCESS`` is in it, and readers take the newest one.  A
  merge therefore reads version n and writes version n+1: a path is never
  overwritten while it is read, and a failed write leaves no visible trace.
* a merge into a table written with ``partition_by`` rewrites only the
  partitions it touches: those that hold a replaced row or receive a row.
  The new version holds these alone, and its file ``_parts`` names, for every
  live partition, the version that holds it.  A version begun that way counts
  once ``_parts`` is there.  After ``MAX_LIVE`` versions the table is
  rewritten whole, so a read unites few folders.
* ``stage`` materialises an intermediate result as parquet in the cluster's
  shared checkpoint folder (``spark.checkpoint.dir``) to cut lineage.

Single writer per table is assumed (one pipeline run at a time).

With ``format="delta"`` (needs the Delta Lake package on the cluster) the
same API writes Delta tables and ``upsert`` is a Delta ``MERGE``, which
rewrites only the files holding matched keys instead of the whole table.
"""

from __future__ import annotations

import json
import re
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.merge import (
    effective_rows,
    hashable,
    kept_rows,
    key_matches,
    merge_upsert,
    require_unique,
)
from strata.session import ensure_checkpoint_dir, parquet_codec

LAYERS = ("bronze", "silver", "gold", "control")
_VERSION = re.compile(r"^v(\d{8})$")
# Versions that may hold partitions of one table before it is rewritten whole.
MAX_LIVE = 8
# Partition columns of this prefix belong to the store: ``read`` leaves them out.
HIDDEN = "__p_"
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
# Control tables that are only ever appended to.
LOGS = frozenset({"silver_watermark", "gold_changes", "rejected_rows", "stream_files"})


def is_append_only(layer: str, table: str) -> bool:
    """One notion for ``exists``, ``read`` and ``append``."""
    return layer == "bronze" or layer == "control" and table.split("/")[0] in LOGS


def delta_available(spark: SparkSession) -> bool:
    """True when the Delta Lake Python package and JVM classes are present."""
    try:
        import delta.tables  # noqa: F401
        spark.sparkContext._jvm.java.lang.Class.forName("io.delta.tables.DeltaTable")
        return True
    except Exception:
        return False


def rebalanced(df: DataFrame, partition_by: list[str] | None = None) -> DataFrame:
    """Rows dealt so that AQE writes files near its advisory partition size (the
    target file size), by table partition where there is one; large partitions
    are split, small ones merged."""
    return df.hint("rebalance", *(partition_by or []))


class TableStore:
    def __init__(self, spark: SparkSession, root: str, format: str = "parquet"):
        if format not in ("parquet", "delta"):
            raise ValueError(f"format must be parquet or delta, got {format!r}")
        if format == "delta" and not delta_available(spark):
            raise RuntimeError("format='delta' needs the Delta Lake package on the cluster")
        self.spark = spark
        self.root = root.rstrip("/")
        self.format = format
        self._staged: list[str] = []

    # ------------------------------------------------------------ paths --
    def path(self, layer: str, table: str) -> str:
        return f"{self.root}/{layer}/{table}"

    def _hpath(self, path: str):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        return fs, p

    def _exists(self, path: str) -> bool:
        fs, p = self._hpath(path)
        return bool(fs.exists(p))

    def path_exists(self, path: str) -> bool:
        """Whether any file system path (e.g. a landing file) exists."""
        return self._exists(path)

    def list_names(self, path: str) -> list[str]:
        """Names in a folder (empty when there is none)."""
        fs, p = self._hpath(path)
        return [st.getPath().getName() for st in fs.listStatus(p)] if fs.exists(p) else []

    def ensure_layers(self) -> None:
        """Create the layer folders (the namespaces of the lake)."""
        for layer in LAYERS:
            fs, p = self._hpath(f"{self.root}/{layer}")
            fs.mkdirs(p)

    # -------------------------------------------------------- snapshots --
    def versions(self, layer: str, table: str) -> list[int]:
        """Committed snapshot numbers, oldest first."""
        base = self.path(layer, table)
        fs, p = self._hpath(base)
        if not fs.exists(p):
            return []
        out = []
        for st in fs.listStatus(p):
            m = _VERSION.match(st.getPath().getName())
            if not m or not st.isDirectory():
                continue
            has = lambda f: self._exists(f"{base}/{st.getPath().getName()}/{f}")  # noqa: B023, E731
            if has("_SUCCESS") and (has("_parts") or not has("_partial")):
                out.append(int(m.group(1)))
        return sorted(out)

    def exists(self, layer: str, table: str) -> bool:
        if is_append_only(layer, table):
            return self._exists(self.path(layer, table))
        if self.format == "delta":
            return self._exists(f"{self.path(layer, table)}/_delta_log")
        return bool(self.versions(layer, table))

    def snapshot_path(self, layer: str, table: str, version: int | None = None) -> str:
        if version is None:
            vs = self.versions(layer, table)
            if not vs:
                raise FileNotFoundError(f"no snapshot of {layer}.{table} under {self.root}")
            version = vs[-1]
        return f"{self.path(layer, table)}/v{version:08d}"

    def read(self, layer: str, table: str, schema: T.StructType | None = None,
             version: int | None = None) -> DataFrame:
        reader = self.spark.read
        if schema is not None:
            reader = reader.schema(schema)
        if is_append_only(layer, table):
            return reader.parquet(self.path(layer, table))
        if self.format == "delta":
            if version is not None:
                reader = reader.option("versionAsOf", version)
            return reader.format("delta").load(self.path(layer, table))
        parts = self._parts(layer, table, version)
        if parts is None:
            df = reader.parquet(self.snapshot_path(layer, table, version))
        else:
            df = self._read_parts(layer, table, schema or parts[0], parts[1])
        return df.drop(*[c for c in df.columns if c.startswith(HIDDEN)])

    # ------------------------------------------------------- partitions --
    def _parts(self, layer: str, table: str, version: int | None = None) -> tuple[T.StructType, dict[str, int]] | None:
        """Schema, and partition folder -> version that holds it, of a snapshot that names them."""
        fs, p = self._hpath(f"{self.snapshot_path(layer, table, version)}/_parts")
        if not fs.exists(p):
            return None
        stream = fs.open(p)
        try:
            text = self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        found = json.loads(text)
        return T.StructType.fromJson(found["schema"]), found["live"]

    def _put(self, path: str, text: str) -> None:
        """A small file, visible when whole."""
        fs, p = self._hpath(path)
        _, begun = self._hpath(f"{path}.begun")
        out = fs.create(begun, True)
        out.write(bytearray(text, "utf-8"))
        out.close()
        fs.rename(begun, p)

    def _partition_folders(self, path: str, depth: int) -> list[str]:
        """Relative ``a=1/b=2`` folders below ``path``."""
        level = [""]
        for _ in range(depth):
            level = [f"{at}/{name}".lstrip("/") for at in level
                     for name in self.list_names(f"{path}/{at}") if "=" in name]
        return sorted(level)

    def _read_parts(self, layer: str, table: str, schema: T.StructType, live: dict[str, int]) -> DataFrame:
        """The union of the versions' folders; partition filters reach each of them."""
        frames = []
        for version in sorted(set(live.values())):
            base = f"{self.path(layer, table)}/v{version:08d}"
            frames.append(self.spark.read.schema(schema).option("basePath", base).parquet(
                *[f"{base}/{p}" for p, v in sorted(live.items()) if v == version]))
        return reduce(DataFrame.unionByName, frames) if frames else self.spark.createDataFrame([], schema)

    def _folder_of(self, names: list[str], row) -> str:
        escape = self.spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
        return "/".join(f"{n}={NULL_PARTITION if row[n] is None else escape(str(row[n]))}" for n in names)

    def _merge_touched(self, layer: str, table: str, incoming: DataFrame, keys: list[str],
                       hash_col: str | None, null_safe: bool, partition_by: list[str], dealt: bool) -> None:
        """Merge ``incoming`` and write the touched partitions as the next version."""
        schema, live = self._live(layer, table, partition_by)
        target = self._read_parts(layer, table, schema, live) if live else self.read(layer, table)
        whole = not live or len(set(live.values())) >= MAX_LIVE
        if not whole and hash_col is None and self._merge_all(layer, table, target, incoming, keys, null_safe,
                                                              partition_by, dealt, schema, live):
            return
        require_unique(incoming, keys, null_safe)
        if whole:
            # A table that was written without partitions stays so.
            merged = merge_upsert(target, incoming, keys, hash_col, null_safe)
            self.write_snapshot(layer, table, merged, partition_by if live else None)
            return
        rows, replaced = effective_rows(target, incoming, keys, hash_col, null_safe, partition_by)
        rows, replaced = self.stage(rows, f"{table}-rows"), self.stage(replaced, f"{table}-replaced")
        # One row per partition comes to the driver.
        touched = {self._folder_of(partition_by, r) for r in
                   rows.select(*partition_by).unionByName(replaced).distinct().collect()}
        if not touched:
            return
        old = self._read_parts(layer, table, schema, {p: v for p, v in live.items() if p in touched})
        self._write_touched(layer, table, merge_upsert(old, rows, keys, hash_col, null_safe), touched,
                            schema, live, partition_by)

    def _merge_all(self, layer: str, table: str, target: DataFrame, incoming: DataFrame, keys: list[str],
                   null_safe: bool, partition_by: list[str], dealt: bool, schema: T.StructType,
                   live: dict[str, int]) -> bool:
        """A merge that takes every incoming row: nothing wide moves but the touched partitions'
        other rows, and the incoming ones where they are not dealt yet.  False (and nothing is
        done) where it does not apply: other column types, or a key (or key hash) that is
        repeated on either side."""
        types = {f.name: f.dataType for f in incoming.schema}
        if any(types.get(f.name) != f.dataType for f in target.schema) or not all(hashable(types[k]) for k in keys):
            return False
        matches = self.stage(key_matches(target, incoming, keys, null_safe, partition_by), f"{table}-matches")
        if not matches.where("n_s > 1 OR n_t > 1").isEmpty():
            return False
        # One row per partition comes to the driver.
        places = incoming.select(*partition_by).unionByName(
            matches.select(*[F.col(f"t_{p}").alias(p) for p in partition_by]))
        touched = {self._folder_of(partition_by, r) for r in places.distinct().collect()}
        if touched:
            old = self._read_parts(layer, table, schema, {p: v for p, v in live.items() if p in touched})
            kept = kept_rows(old, incoming, matches, keys, null_safe, partition_by)
            kept = rebalanced(kept, partition_by) if dealt else kept
            self._write_touched(layer, table, kept.unionByName(incoming.select(*target.columns)), touched, schema,
                                live, partition_by, dealt)
        return True

    def _live(self, layer: str, table: str, partition_by: list[str]) -> tuple[T.StructType, dict[str, int]]:
        """Schema, and partition folder -> version that holds it, of the newest snapshot."""
        named = self._parts(layer, table)
        if named is not None:
            return named
        whole = self.snapshot_path(layer, table)
        folders = self._partition_folders(whole, len(partition_by))
        return self.spark.read.parquet(whole).schema, dict.fromkeys(folders, self.versions(layer, table)[-1])

    def _write_touched(self, layer: str, table: str, df: DataFrame, touched: set[str], schema: T.StructType,
                       live: dict[str, int], partition_by: list[str], dealt: bool = False) -> None:
        """The next version: ``df`` in place of the ``touched`` partitions, the others as they are."""
        version = self.versions(layer, table)[-1] + 1
        path = f"{self.path(layer, table)}/v{version:08d}"
        if self._exists(path):  # left by a failed merge: never visible
            fs, p = self._hpath(path)
            fs.delete(p, True)
        self._put(f"{path}/_partial", "")
        df = df if dealt else rebalanced(df, partition_by)
        df.write.mode("append").partitionBy(*partition_by).parquet(path, compression=parquet_codec(self.spark))
        now = {p: v for p, v in live.items() if p not in touched}
        now.update(dict.fromkeys(self._partition_folders(path, len(partition_by)), version))
        self._put(f"{path}/_parts", json.dumps({"schema": schema.jsonValue(), "live": now}, sort_keys=True))

    def partition_versions(self, layer: str, table: str, partition_by: list[str]) -> dict[str, int] | None:
        """Partition folder -> version that wrote it: a partition has changed exactly when its
        number has (a whole rewrite renumbers all).  None where the table has no such
        folders: it was written unpartitioned, or as Delta."""
        if self.format == "delta":
            return None
        return self._live(layer, table, partition_by)[1] or None

    def read_partitions(self, layer: str, table: str, partition_by: list[str], folders: set[str]) -> DataFrame:
        """These partitions alone, the store's own columns included."""
        schema, live = self._live(layer, table, partition_by)
        return self._read_parts(layer, table, schema, {p: v for p, v in live.items() if p in folders})

    def replace_partitions(self, layer: str, table: str, df: DataFrame, partition_by: list[str],
                           folders: set[str], dealt: bool = False) -> None:
        """``df`` takes the place of the partitions ``folders``, which must include all that it
        has rows in; a folder without rows goes.  One version, visible when whole.
        ``dealt``: see ``upsert``."""
        if not self.exists(layer, table):
            self.write_snapshot(layer, table, df, partition_by, dealt)
            return
        schema, live = self._live(layer, table, partition_by)
        kept = {p: v for p, v in live.items() if p not in folders}
        if not live or len(set(live.values())) >= MAX_LIVE:
            whole = self._read_parts(layer, table, schema, kept).unionByName(df) if kept else df
            self.write_snapshot(layer, table, whole, partition_by)
        else:
            self._write_touched(layer, table, df.select(*schema.fieldNames()), folders, schema, live, partition_by,
                                dealt)
        self.vacuum(layer, table)

    def write_snapshot(self, layer: str, table: str, df: DataFrame,
                       partition_by: list[str] | None = None, dealt: bool = False) -> int:
        """Write ``df`` as the next snapshot; returns its version number.  ``dealt``: see ``upsert``."""
        if self.format == "delta":
            w = df.write.format("delta").mode("overwrite").option("overwriteSchema", True)
            if partition_by:
                w = w.partitionBy(*partition_by)
            w.save(self.path(layer, table))
            return -1
        vs = self.versions(layer, table)
        version = (vs[-1] + 1) if vs else 1
        w = (df if dealt else rebalanced(df, partition_by)).write.mode("errorifexists")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(f"{self.path(layer, table)}/v{version:08d}", compression=parquet_codec(self.spark))
        return version

    def append(self, layer: str, table: str, df: DataFrame,
               partition_by: list[str] | None = None) -> None:
        """Append files to an append-only table (bronze, control logs)."""
        if not is_append_only(layer, table):
            raise ValueError(f"{layer}.{table} is not append-only")
        w = rebalanced(df, partition_by).write.mode("append")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(self.path(layer, table))

    def upsert(self, layer: str, table: str, incoming: DataFrame, keys: list[str],
               hash_col: str | None = None, null_safe: bool = True,
               partition_by: list[str] | None = None, dealt: bool = False) -> None:
        """Create the table from ``incoming``, or merge ``incoming`` into it
        (see ``operators.merge.merge_upsert`` for the semantics; ``incoming`` is
        read several times, so stage it).  Fails when a key occurs twice in it.
        Old snapshots but the last two go.
        ``dealt``: each task of ``incoming`` holds few partitions (it is a staged
        ``rebalanced``), so its rows are written without another shuffle."""
        if partition_by and self.format != "delta" and self.exists(layer, table):
            self._merge_touched(layer, table, incoming, keys, hash_col, null_safe, partition_by, dealt)
            self.vacuum(layer, table)
            return
        require_unique(incoming, keys, null_safe)
        if not self.exists(layer, table):
            self.write_snapshot(layer, table, incoming, partition_by, dealt)
        elif self.format == "delta":
            _delta_merge(self.spark, self.path(layer, table), incoming, keys, hash_col, null_safe)
        else:
            merged = merge_upsert(self.read(layer, table), incoming, keys, hash_col, null_safe)
            self.write_snapshot(layer, table, merged, partition_by)
            self.vacuum(layer, table)

    # ------------------------------------------------------------ views --
    def register(self, layer: str, table: str, schema: T.StructType | None = None) -> str:
        """Temp view ``<layer>_<table>`` over the current contents."""
        name = f"{layer}_{table}"
        self.read(layer, table, schema).createOrReplaceTempView(name)
        return name

    # ---------------------------------------------------------- staging --
    def stage(self, df: DataFrame, label: str = "stage") -> DataFrame:
        """Materialise ``df`` as parquet in the shared checkpoint folder and
        return a frame that reads it back (lineage cut; survives executor loss)."""
        base = ensure_checkpoint_dir(self.spark).rstrip("/")
        path = f"{base}/strata-stage/{label}-{uuid.uuid4().hex}"
        df.write.mode("errorifexists").parquet(path, compression=parquet_codec(self.spark))
        self._staged.append(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop_staged(self) -> None:
        """Delete what ``stage`` wrote (call once nothing reads it any more)."""
        while self._staged:
            fs, p = self._hpath(self._staged.pop())
            fs.delete(p, True)

    def vacuum(self, layer: str, table: str, keep: int = 2) -> list[int]:
        """Delete all but the newest ``keep`` snapshots; returns the removed ones."""
        if self.format == "delta" or is_append_only(layer, table):
            return []
        versions = self.versions(layer, table)
        old, kept = (versions[:-keep], versions[-keep:]) if keep > 0 else ([], versions)
        in_use: set[tuple[int, str]] = set()
        for v in kept:
            named = self._parts(layer, table, v)
            in_use |= {(held, p) for p, held in (named[1] if named else {}).items()}
        gone = []
        for v in old:
            path = self.snapshot_path(layer, table, v)
            needed = {p for held, p in in_use if held == v}
            if not needed:
                fs, p = self._hpath(path)
                fs.delete(p, True)
                gone.append(v)
                continue
            # A kept snapshot reads some partitions from here: the others go.
            depth = next(iter(needed)).count("/") + 1
            for part in set(self._partition_folders(path, depth)) - needed:
                fs, p = self._hpath(f"{path}/{part}")
                fs.delete(p, True)
        return gone


def _delta_merge(spark: SparkSession, path: str, incoming: DataFrame, keys: list[str],
                 hash_col: str | None, null_safe: bool) -> None:
    from delta.tables import DeltaTable
    op = "<=>" if null_safe else "="
    cond = " AND ".join(f"t.`{k}` {op} s.`{k}`" for k in keys)
    m = DeltaTable.forPath(spark, path).alias("t").merge(incoming.alias("s"), cond)
    m = (m.whenMatchedUpdateAll(f"t.`{hash_col}` <> s.`{hash_col}`") if hash_col
         else m.whenMatchedUpdateAll())
    m.whenNotMatchedInsertAll().execute()
