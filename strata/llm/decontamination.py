"""Benchmark decontamination by CGK embeddings and bit-sampling LSH.

Texts and benchmark items are sequences of lower-case words (runs of letters and
digits, any non-ASCII character counting as a letter).  The CGK random walk
(Chakraborty, Goldenberg, Koucky) reads a sequence from a start: at every step it
emits the word under its pointer, and a random bit of (step, word) says whether the
pointer moves on.  Two walks over similar sequences fall into step again after an
edit, so edit distance becomes Hamming distance between the emitted words.

Windows of a document start at every fourth word and have the size class of the
items; an item is indexed from each of its words from which a whole window fits, so
that a passage is met wherever it stands.  ``WALKS`` walks, each sampled ``SAMPLES``
times at a few steps, give the hash keys; windows that share a key and at least half
of the emitted words are candidates.  For each candidate the exact least edit
distance (in words) between the whole item and any stretch of the document around
it is computed; the document holds the item if that is at most ``MAX_EDITS`` of the
item's words (similarity 0.8).  Items of fewer than ``WINDOW_WORDS`` words may not
differ in a word: every stretch of their own length is looked up and compared.

The items are shipped in blocks of bounded size; a larger benchmark takes more
passes over the documents.  Documents are never shuffled.

Defined results: null texts and items and those without a word match nothing, nor do
items of fewer than ``min_words`` words (1: all are searched; who takes a short item
for no evidence names more); items of equal words are all reported, a repeated
benchmark row once; repeated rows each report; further columns are ignored or passed
through.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import kept

MAX_EDITS = 0.2
# Items of so many words are searched by walks, shorter ones word by word.
WINDOW_WORDS = 5
WALKS, SAMPLES = 4, 4
BLOCK_BYTES = 1 << 20
# Per size class: steps of the walk, stride of the documents' windows, least
# words of an item, sampled steps, least common steps.
CLASSES = ((16, 4, 22, 4, 8), (9, 2, 12, 4, 5), (5, 1, WINDOW_WORDS, 3, 3))
TABLE_BITS = 20

_TO_SPACE = bytes(x if x >= 128 or chr(x).isalnum() else 32 for x in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").lower().encode("utf-8", "replace").translate(_TO_SPACE).split()


def hashes_of(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(zlib.crc32, words), dtype=np.uint32, count=len(words))


def allowed_edits(n_words: int) -> int:
    return int(MAX_EDITS * n_words)


def least_distance(item: list[bytes], stretch: list[bytes]) -> tuple[int, int]:
    """Least edit distance between ``item`` and any part of ``stretch``, and the end
    of the first such part (bit-parallel dynamic programme, exact)."""
    m = len(item)
    where: dict[bytes, int] = {}
    for i, w in enumerate(item):
        where[w] = where.get(w, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score = full, 0, m
    best = (m, 0)
    for j, w in enumerate(stretch):
        eq = where.get(w, 0)
        xv = eq | minus
        xh = (((eq & plus) + plus) ^ plus) | eq
        ph = minus | (~(xh | plus) & full)
        mh = plus & xh
        score += bool(ph & top) - bool(mh & top)
        ph = (ph << 1) & full
        mh = (mh << 1) & full
        plus = mh | (~(xv | ph) & full)
        minus = ph & xv
        if score < best[0]:
            best = (score, j + 1)
    return best


def missing(item: list[bytes], words: set[bytes]) -> int:
    return len([w for w in item if w not in words])


class SizeClass:
    """The index of the items of one size class."""

    def __init__(self, shape: tuple[int, int, int, int, int], items: list[tuple[int, np.ndarray]]):
        self.steps, self.stride, _, sampled, self.common = shape
        rng = np.random.default_rng(20240229 + self.steps)
        self.turn = (rng.integers(0, 1 << 31, size=(WALKS, self.steps), dtype=np.uint32) << np.uint32(1)) | np.uint32(1)
        self.picks = [[np.sort(rng.choice(self.steps, sampled, replace=False)) for _ in range(SAMPLES)]
                      for _ in range(WALKS)]
        self.mix = (rng.integers(0, 1 << 31, size=sampled, dtype=np.uint32) << np.uint32(1)) | np.uint32(1)
        self.entry_item = np.concatenate([np.full(len(h) - self.steps + 1, i) for i, h in items])
        self.entry_at = np.concatenate([np.arange(len(h) - self.steps + 1) for _, h in items])
        base = np.cumsum([0] + [len(h) for _, h in items])
        flat = np.concatenate([h for _, h in items])
        starts = np.concatenate([b + np.arange(len(h) - self.steps + 1) for b, (_, h) in zip(base, items)])
        self.walks = [self.walk(flat, starts, w) for w in range(WALKS)]
        self.keys = []
        for w in range(WALKS):
            for pick in self.picks[w]:
                key = self.key(self.walks[w], pick)
                order = np.argsort(key, kind="stable")
                seen = np.zeros(1 << TABLE_BITS, dtype=bool)
                seen[key >> np.uint32(32 - TABLE_BITS)] = True
                self.keys.append((key[order], order, seen))

    def walk(self, x: np.ndarray, starts: np.ndarray, w: int) -> np.ndarray:
        """The words that walk ``w`` emits from each start, by step."""
        at = starts.astype(np.int64)
        out = np.empty((self.steps, len(at)), dtype=np.uint32)
        for t in range(self.steps):
            out[t] = c = x[at]
            at += (c * self.turn[w, t]) >> np.uint32(31)
        return out

    def key(self, emitted: np.ndarray, pick: np.ndarray) -> np.ndarray:
        key = np.zeros(emitted.shape[1], dtype=np.uint32)
        for t, m in zip(pick, self.mix):
            key ^= key >> np.uint32(15)
            key = (key + emitted[t]) * m
        return key

    def candidates(self, x: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, item, word of the item) of windows that meet an item's window."""
        n_items, n_words = int(self.entry_item.max()) + 1, int(self.entry_at.max()) + 1
        found = [np.zeros(0, dtype=np.int64)]
        for w in range(WALKS):
            emitted = self.walk(x, starts, w)
            for s, pick in enumerate(self.picks[w]):
                keys, order, seen = self.keys[w * SAMPLES + s]
                key = self.key(emitted, pick)
                hit = np.flatnonzero(seen[key >> np.uint32(32 - TABLE_BITS)])
                low = np.searchsorted(keys, key[hit], "left")
                n = np.searchsorted(keys, key[hit], "right") - low
                hit, low, n = hit[n > 0], low[n > 0], n[n > 0]
                window = np.repeat(hit, n)
                entry = order[np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())]
                same = (emitted[:, window] == self.walks[w][:, entry]).sum(axis=0)
                ok = same >= self.common
                found.append((starts[window[ok]] * n_items + self.entry_item[entry[ok]]) * n_words
                             + self.entry_at[entry[ok]])
        place, word = np.divmod(np.unique(np.concatenate(found)), n_words)
        return place // n_items, place % n_items, word


class ShortItems:
    """The items of one length below ``WINDOW_WORDS``, looked up exactly."""

    def __init__(self, length: int, items: list[tuple[int, list[bytes]]]):
        self.length = length
        keys = np.array([self.key(hashes_of(words), np.zeros(1, dtype=np.int64))[0] for _, words in items])
        self.order = np.argsort(keys, kind="stable")
        self.keys = keys[self.order]
        self.numbers = np.array([i for i, _ in items])[self.order]

    def key(self, x: np.ndarray, starts: np.ndarray) -> np.ndarray:
        key = np.zeros(len(starts), dtype=np.uint64)
        for t in range(self.length):
            key = (key ^ (key >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + x[starts + t]
        return key

    def places(self, x: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(start, item) of all stretches with an item's key, ascending by start."""
        key = self.key(x, starts)
        low = np.searchsorted(self.keys, key, "left")
        n = np.searchsorted(self.keys, key, "right") - low
        hit = np.flatnonzero(n)
        low, n = low[hit], n[hit]
        return np.repeat(starts[hit], n), self.numbers[np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())]


class Index:
    """Searches texts for the items ``[(item id, text)]``."""

    def __init__(self, items: list[tuple[int, str | None]], min_words: int = 1):
        by_words: dict[tuple[bytes, ...], list[int]] = {}
        for item_id, text in items:
            words = tuple(words_of(text))
            if len(words) >= max(min_words, 1):
                by_words.setdefault(words, []).append(item_id)
        self.items = [list(w) for w in by_words]
        self.ids = list(by_words.values())
        self.short = [ShortItems(n, own) for n in range(1, WINDOW_WORDS)
                      if (own := [(i, w) for i, w in enumerate(self.items) if len(w) == n])]
        self.classes = []
        low = [c[2] for c in CLASSES]
        for k, shape in enumerate(CLASSES):
            own = [(i, hashes_of(w)) for i, w in enumerate(self.items)
                   if len(w) >= low[k] and (k == 0 or len(w) < low[k - 1])]
            if own:
                self.classes.append(SizeClass(shape, own))

    def search(self, texts: list[str | None]) -> Iterator[tuple[int, int, int, int, int]]:
        """(row, item id, distance, words of the item, end word) of all that is held."""
        block: list[tuple[int, list[bytes]]] = []
        size = 0
        for row, text in enumerate(texts):
            words = words_of(text)
            block.append((row, words))
            size += len(words)
            if size > 200_000:
                yield from self._block(block)
                block, size = [], 0
        if block:
            yield from self._block(block)

    def _short(self, block: list[tuple[int, list[bytes]]], x: np.ndarray,
               bases: np.ndarray, lengths: np.ndarray) -> Iterator[tuple[int, int, int, int, int]]:
        """The first place of every short item in every text."""
        starts = np.repeat(bases - np.cumsum(lengths) + lengths, lengths) + np.arange(lengths.sum())
        for short in self.short:
            at, item = short.places(x, starts)
            doc = np.searchsorted(bases, at, "right") - 1
            order = np.lexsort((at, item, doc))
            done = (-1, -1)
            for k in order.tolist():
                d, i = int(doc[k]), int(item[k])
                begin = int(at[k] - bases[d])
                (row, words), end = block[d], begin + short.length
                # Equal keys are compared, so the first true place is found among all.
                if (d, i) != done and words[begin:end] == self.items[i]:
                    done = (d, i)
                    for item_id in self.ids[i]:
                        yield row, item_id, 0, short.length, end

    def _block(self, block: list[tuple[int, list[bytes]]]) -> Iterator[tuple[int, int, int, int, int]]:
        if not self.classes and not self.short:
            return
        pad = np.zeros(max([c.steps for c in self.classes] + [WINDOW_WORDS]) + 1, dtype=np.uint32)
        x = np.concatenate([p for _, words in block for p in (hashes_of(words), pad)])
        lengths = np.array([len(words) for _, words in block])
        bases = np.cumsum(np.concatenate(([0], lengths + len(pad))))[:-1]
        yield from self._short(block, x, bases, lengths)
        near: dict[tuple[int, int], list[int]] = {}
        for c in self.classes:
            n = (lengths + c.stride - 1) // c.stride
            starts = np.repeat(bases - c.stride * (np.cumsum(n) - n), n) + c.stride * np.arange(n.sum())
            at, item, word = c.candidates(x, starts)
            doc = np.searchsorted(bases, at, "right") - 1
            for d, i, begin in zip(doc.tolist(), item.tolist(), (at - bases[doc] - word).tolist()):
                near.setdefault((d, i), []).append(begin)
        last, present = -1, set()
        for (d, i), begins in sorted(near.items()):
            (row, words), item = block[d], self.items[i]
            slack = allowed_edits(len(item))
            if d != last:
                last, present = d, set(words)
            # Every word of the item that is nowhere near costs an edit of its own.
            if missing(item, present) > slack:
                continue
            best, reach = (len(item) + 1, 0), -1
            # Candidate places that overlap are searched as one stretch.
            stretches: list[list[int]] = []
            for b in sorted(set(begins)):
                low, high = max(0, b - slack), min(len(words), b + len(item) + 2 * slack)
                if stretches and low <= reach:
                    stretches[-1][1] = reach = max(reach, high)
                else:
                    stretches.append([low, high])
                    reach = high
            for low, high in stretches:
                stretch = words[low:high]
                if missing(item, set(stretch)) <= slack:
                    distance, end = least_distance(item, stretch)
                    best = min(best, (distance, low + end))
            if best[0] <= slack:
                for item_id in self.ids[i]:
                    yield row, item_id, best[0], len(item), best[1]


def index_of(items: tuple[tuple[int, str | None], ...], min_words: int) -> Index:
    """One index per worker process and block of items."""
    return kept(("index", hash((items, min_words))), lambda: Index(list(items), min_words))


def item_blocks(benchmark: DataFrame, item_id_col: str, item_text_col: str,
                block_bytes: int = BLOCK_BYTES) -> Iterator[tuple[tuple[int, str | None], ...]]:
    """The benchmark in blocks of about ``block_bytes`` of text, one at a time."""
    items = benchmark.select(F.col(item_id_col).alias("i"), F.col(item_text_col).alias("t")) \
        .filter("t is not null").distinct()
    total = items.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    n = int(total // block_bytes) + 1
    for k in range(n):
        part = items.filter(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == k) if n > 1 else items
        yield tuple(sorted(((r["i"], r["t"]) for r in part.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1])))


def leaks(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
          item_id_col: str = "item_id", item_text_col: str = "text", block_bytes: int = BLOCK_BYTES,
          min_words: int = 1) -> DataFrame:
    """One row per document and benchmark item that it holds: id, item_id, distance
    (word edits), item_words, end_word (place in the document's words)."""
    id_type = docs.schema[id_col].dataType
    schema = T.StructType([
        T.StructField("id", id_type), T.StructField("item_id", T.LongType()), T.StructField("distance", T.IntegerType()),
        T.StructField("item_words", T.IntegerType()), T.StructField("end_word", T.IntegerType())])
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"))
    out = None
    for items in item_blocks(benchmark, item_id_col, item_text_col, block_bytes):
        def find(batches, items=items):
            import pyarrow as pa
            index = index_of(items, min_words)
            for batch in batches:
                rows = list(index.search(batch.column(1).to_pylist()))
                ids = batch.column(0).take(pa.array([r[0] for r in rows], pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array([r[1] for r in rows], pa.int64())]
                    + [pa.array([r[k] for r in rows], pa.int32()) for k in (2, 3, 4)],
                    ["id", "item_id", "distance", "item_words", "end_word"])

        part = slim.mapInArrow(find, schema)
        out = part if out is None else out.unionByName(part)
    return out.withColumnRenamed("id", id_col)


def drop_leaking(docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text", item_id_col: str = "item_id",
                 item_text_col: str = "text", block_bytes: int = BLOCK_BYTES, min_words: int = 1) -> DataFrame:
    """The documents that hold no benchmark item, with their own columns."""
    for items in item_blocks(benchmark, item_id_col, item_text_col, block_bytes):
        @F.pandas_udf(T.BooleanType())
        def holds(texts, items=items):
            import pandas as pd
            out = np.zeros(len(texts), dtype=bool)
            out[[r[0] for r in index_of(items, min_words).search(texts.tolist())]] = True
            return pd.Series(out)

        docs = docs.filter(~holds(F.col(text_col)))
    return docs
