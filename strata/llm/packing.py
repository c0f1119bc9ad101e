"""Packing token ids into sequences by Karmarkar-Karp multiway differencing.

Documents are encoded in their tasks (whole texts, an end id after each).  A
document's whole windows of ``capacity`` ids become sequences of their own; what is
left of it is one item.  The items of a block (about ``BLOCK_WINDOWS`` windows) are
dealt to the least possible number of windows by differencing: every item starts as
a partial partition; the two partial partitions of the widest spread merge, the
fullest bins of one with the emptiest of the other, until one is left, whose bins
are nearly equal.  If a window exceeds the capacity by more than ``SURPLUS`` ids, the
window count rises and the block is dealt again; smaller surpluses are cut off the
end of a window's last piece and fill the room in other windows.  So only the last
part of a block's last window is padding.

Nothing is shuffled and a block bounds a task's memory.  Sequence ids are the task's
partition number and a running number, so that a task that is run again gives the
same ids.

Defined results: a null text is the empty text (its end id alone); repeated rows and
null ids are documents of their own; further columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.tokens import TABLE_BYTES, encoder

CAPACITY = 2048
BLOCK_WINDOWS = 256
SURPLUS = 256

Bin = tuple[int, list[int]]  # ids, items


def karmarkar_karp(sizes: list[int], k: int) -> list[Bin]:
    """``sizes`` dealt to at most ``k`` nearly equal bins, lightest first (bins that
    stay empty are left out)."""
    heap: list[tuple[int, int, list[Bin]]] = [(-s, i, [(s, [i])]) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    turn = len(heap)
    while len(heap) > 1:
        _, _, a = heapq.heappop(heap)
        _, _, b = heapq.heappop(heap)
        # Partial partitions are kept without their empty bins.  Only as many bins
        # meet as do not fit beside each other: the lightest, in opposite order.
        meet = max(0, len(a) + len(b) - k)
        bins = [(a[j][0] + b[meet - 1 - j][0], a[j][1] + b[meet - 1 - j][1]) for j in range(meet)]
        bins += a[meet:]
        bins += b[meet:]
        bins.sort(key=lambda x: x[0])
        lightest = bins[0][0] if len(bins) == k else 0
        heapq.heappush(heap, (lightest - bins[-1][0], turn, bins))
        turn += 1
    return heap[0][2] if heap else []


def fill_windows(sizes: list[int], capacity: int, surplus: int = SURPLUS) -> list[list[tuple[int, int, int]]]:
    """Windows of pieces (item, first id of the item, ids); at most ``capacity`` each."""
    k = -(-sum(sizes) // capacity)
    bins = karmarkar_karp(sizes, k)
    while bins and bins[-1][0] > capacity + surplus:
        k += 1
        bins = karmarkar_karp(sizes, k)
    windows = [[(i, 0, sizes[i]) for i in items] for _, items in bins]
    windows += [[] for _ in range(k - len(windows))]
    spare: list[tuple[int, int, int]] = []
    for window, (size, _) in zip(windows, bins):
        over = size - capacity
        while over > 0:
            item, start, n = window.pop()
            cut = min(n, over)
            if n > cut:
                window.append((item, start, n - cut))
            spare.append((item, start + n - cut, cut))
            over -= cut
    for window in windows:
        room = capacity - sum(n for _, _, n in window)
        while spare and room > 0:
            item, start, n = spare.pop()
            cut = min(n, room)
            if n > cut:
                spare.append((item, start + cut, n - cut))
            window.append((item, start, cut))
            room -= cut
    return [w for w in windows if w]


def pack(docs: DataFrame, tokenizer_path: str, *, kind: str = "word", end_id: int = 1, capacity: int = CAPACITY,
         block_windows: int = BLOCK_WINDOWS, id_col: str = "doc_id", text_col: str = "text",
         table_bytes: int = TABLE_BYTES) -> DataFrame:
    """One row per piece: id, start, length, ids (little-endian unsigned 32-bit),
    doc_tokens, sequence_id, offset.  ``table_bytes``: memory of a worker for encoded words."""
    schema = T.StructType([
        T.StructField("id", docs.schema[id_col].dataType), T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()), T.StructField("ids", T.BinaryType()),
        T.StructField("doc_tokens", T.LongType()), T.StructField("sequence_id", T.LongType()),
        T.StructField("offset", T.LongType())])
    end = end_id.to_bytes(4, "little")

    def packed(batches) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        encode = encoder(tokenizer_path, kind, table_bytes)
        sequence = TaskContext.get().partitionId() << 40
        rows: list[tuple] = []  # (id, start, ids, doc_tokens, sequence, offset)
        items: list[tuple] = []  # (id, start in the document, ids, doc_tokens)
        held = 0

        def out():
            columns = list(zip(*rows)) or [()] * 6
            ids, start, data, total, seq, offset = columns
            batch = pa.RecordBatch.from_arrays([
                pa.array(ids, id_type), pa.array(start, pa.int64()), pa.array([len(x) // 4 for x in data], pa.int64()),
                pa.array(data, pa.binary()), pa.array(total, pa.int64()), pa.array(seq, pa.int64()),
                pa.array(offset, pa.int64())],
                ["id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])
            rows.clear()
            return batch

        def deal():
            nonlocal sequence
            for window in fill_windows([len(x[2]) // 4 for x in items], capacity):
                offset = 0
                for item, start, n in window:
                    doc_id, first, data, total = items[item]
                    rows.append((doc_id, first + start, data[4 * start:4 * (start + n)], total, sequence, offset))
                    offset += n
                sequence += 1
            items.clear()

        for batch in batches:
            id_type = batch.schema.field(0).type
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                for doc_id, data in zip(part.column(0).to_pylist(), encode.ids(part.column(1).to_pylist())):
                    data += end
                    total = len(data) // 4
                    whole = total - total % capacity
                    for start in range(0, whole, capacity):
                        rows.append((doc_id, start, data[4 * start:4 * (start + capacity)], total, sequence, 0))
                        sequence += 1
                    if total > whole:
                        items.append((doc_id, whole, data[4 * whole:], total))
                        held += total - whole
                    if held >= block_windows * capacity:
                        deal()
                        held = 0
                if rows:
                    yield out()
        deal()
        if rows:
            yield out()

    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"))
    return slim.mapInArrow(packed, schema).withColumnRenamed("id", id_col)
