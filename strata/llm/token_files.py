"""Token ids as flat binary files with 64-bit document offsets.

The corpus is dealt by ranges of the document id (ties by a hash of the text and the
row's number, so that a repeated id or row does not land in one task), sorted inside
each range and encoded there.  Every task writes one shard:

* ``ids-<n>.bin``: the ids, flat, as little-endian unsigned integers of the least
  width (16 or 32 bits) that holds the tokenizer's vocabulary;
* ``docs-<n>.idx``: 64-bit little-endian integers: the number of documents, their
  offsets in the shard (one more than documents) and their ids.

A shard is written under a name of its own attempt and renamed when whole; a task
that runs again writes the same bytes.  The driver gets one row of totals per shard;
their prefix sums are the shards' bases, kept in ``manifest.json``.  Readers map the
files into memory (files of a store that cannot be mapped are read as streams).

The folder may lie in any store that ``pyarrow.fs`` reaches and must be shared.

Defined results: a null text is the empty text; null ids come first; rows of equal
id come in the order of their text's hash; further columns are ignored.
An empty table makes an empty manifest.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.tokens import encoder

NO_ID = -(1 << 63)  # stands for a null id in the index


def _store(uri: str):
    """(file system, path) of a folder's address."""
    from pyarrow import fs
    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def _address(path: str) -> str:
    return path.replace("file:/", "file:///", 1) if path.startswith("file:/") and not path.startswith("file://") else path


def write_token_files(docs: DataFrame, folder: str, tokenizer_path: str, *, kind: str = "byte", end_id: int = 0,
                      id_col: str = "doc_id", text_col: str = "text") -> dict:
    """Write the shards and the manifest; returns the manifest."""
    spark = docs.sparkSession
    folder = _address(folder)
    store, root = _store(folder)
    store.create_dir(root, recursive=True)

    def written(batches) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        encode = encoder(tokenizer_path, kind)
        width = 2 if max(encode.lib.get_vocab_size(), end_id + 1) <= 1 << 16 else 4
        dtype = f"<u{width}"
        end = end_id.to_bytes(width, "little")
        shard = TaskContext.get().partitionId()
        store, root = _store(folder)
        mine = f"{root}/.{uuid.uuid4().hex}"
        names: list[int] = []
        ends: list[int] = [0]
        sink = None
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                if sink is None:
                    sink = store.open_output_stream(f"{mine}.bin")
                for doc_id, ids in zip(part.column(0).to_pylist(), encode.ids(part.column(1).to_pylist())):
                    data = np.frombuffer(ids, "<u4").astype(dtype).tobytes() + end if width == 2 else ids + end
                    sink.write(data)
                    names.append(NO_ID if doc_id is None else doc_id)
                    ends.append(ends[-1] + len(data) // width)
        if sink is None:
            return
        sink.close()
        with store.open_output_stream(f"{mine}.idx") as index:
            index.write(np.array([len(names), *ends, *names], dtype="<i8").tobytes())
        store.move(f"{mine}.bin", f"{root}/ids-{shard:06d}.bin")
        store.move(f"{mine}.idx", f"{root}/docs-{shard:06d}.idx")
        yield pa.RecordBatch.from_pydict({"shard": [shard], "docs": [len(names)], "ids": [ends[-1]], "width": [width]})

    slim = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("t")) \
        .withColumns({"h": F.xxhash64("t"), "salt": F.monotonically_increasing_id()})
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = slim.repartitionByRange(shards, "id", "h", "salt").sortWithinPartitions("id", "h", "salt").select("id", "t")
    # One row per task comes back.
    rows = sorted(dealt.mapInArrow(written, "shard long, docs long, ids long, width long").collect())
    base = 0
    manifest = {"width": rows[0]["width"] if rows else 2, "end_id": end_id, "shards": []}
    for r in rows:
        manifest["shards"].append({"shard": r["shard"], "docs": r["docs"], "ids": r["ids"], "base": base})
        base += r["ids"]
    manifest["ids"] = base
    with store.open_output_stream(f"{root}/manifest.json") as out:
        out.write(json.dumps(manifest).encode())
    return manifest


def _mapped(store, path: str):
    """A whole file as a buffer: memory-mapped where the store is a local or mounted
    file system, else read."""
    import pyarrow as pa
    from pyarrow import fs
    if isinstance(store, fs.LocalFileSystem):
        return pa.memory_map(path).read_buffer()
    with store.open_input_file(path) as f:
        return f.read_buffer()


def read_token_files(spark: SparkSession, folder: str, id_name: str = "doc_id") -> DataFrame:
    """One row per document, from the files: id, start (ids of all documents before),
    n_tokens, ids_crc32 (of the ids as little-endian unsigned 32-bit integers)."""
    folder = _address(folder)
    store, root = _store(folder)
    with store.open_input_stream(f"{root}/manifest.json") as f:
        manifest = json.loads(f.read())
    width = manifest["width"]
    schema = f"{id_name} long, start long, n_tokens long, ids_crc32 long"
    if not manifest["shards"]:
        return spark.createDataFrame([], schema)
    shards = spark.createDataFrame([(s["shard"], s["base"]) for s in manifest["shards"]], "shard long, base long")

    def documents(batches) -> Iterator:
        import pyarrow as pa
        store, root = _store(folder)
        for batch in batches:
            for row in batch.to_pylist():
                index = np.frombuffer(_mapped(store, f"{root}/docs-{row['shard']:06d}.idx"), "<i8")
                n = int(index[0])
                ends, names = index[1:n + 2], index[n + 2:]
                ids = np.frombuffer(_mapped(store, f"{root}/ids-{row['shard']:06d}.bin"), f"<u{width}")
                for at in range(0, n, 4096):
                    cut = ends[at:min(n, at + 4096) + 1]
                    crc = [zlib.crc32(ids[a:b].astype("<u4")) for a, b in zip(cut[:-1].tolist(), cut[1:].tolist())]
                    own = names[at:at + 4096]
                    yield pa.RecordBatch.from_arrays([
                        pa.array(own, pa.int64(), mask=own == NO_ID), pa.array(cut[:-1] + row["base"], pa.int64()),
                        pa.array(np.diff(cut), pa.int64()), pa.array(crc, pa.int64())],
                        [id_name, "start", "n_tokens", "ids_crc32"])

    return shards.repartition(len(manifest["shards"]), "shard").mapInArrow(documents, schema)
