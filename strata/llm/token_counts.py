"""Token counts by rank-synchronous array merging.

Texts are cut into pre-tokens; distinct ones of a batch are laid end to end as one
ragged numpy array of byte symbols.  In every round all sequences look up the merge
rank of each neighbouring pair, every sequence takes its lowest, and all its
occurrences are merged at once, for all sequences together; sequences without a pair
that merges leave with the number of symbols they have left.  A merge of a learned
vocabulary never makes a pair of lower rank than its own, so this gives the tokens of
merging one by one.

The counts of pieces (a word with the space before it) are kept per worker in a
table that is emptied when it is full, so memory is bounded and no text is cut short.

Defined results: a null text is the empty text (0 bytes, 0 tokens); strings of
special tokens inside a text count as one token each; repeated rows and null ids keep
their rows; further columns are ignored.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import kept
from strata.llm.tokens import BYTE_LEVEL_PIECES, MAX_PIECE_CHARS, WHITE

# Pre-token pattern of byte-level BPE.
PRE_TOKENS = (rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{WHITE}\p{{L}}\p{{N}}]+"
              rf"|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+")
NEVER = np.int32(2 ** 31 - 1)
# Entries of a worker's tables of counts.
MAX_PIECES = 400_000


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary:
    printable Latin-1 bytes stand for themselves, the others follow from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    out, extra = [], 256
    for b in range(256):
        if b in plain:
            out.append(chr(b))
        else:
            out.append(chr(extra))
            extra += 1
    return out


class Merger:
    """Token counts of byte strings by the merges of a byte-level BPE file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.first = np.array([vocab[c] for c in byte_symbols()], dtype=np.int64)
        self.size = max(vocab.values()) + 1
        left = np.array([vocab[a] for a, _ in merges], dtype=np.int64)
        right = np.array([vocab[b] for _, b in merges], dtype=np.int64)
        key = left * self.size + right
        made = np.array([vocab[a + b] for a, b in merges], dtype=np.int64)
        order = np.argsort(key, kind="stable")
        self.key, self.rank, self.made = key[order], order.astype(np.int32), made[order]
        # Most pairs never merge: a bit per hash of the pair spares their look-up.
        self.may = np.zeros(1 << 22, dtype=bool)
        self.may[self._slot(key)] = True

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return (key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(42)

    def _ranks(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per neighbouring pair its rank (or NEVER) and its place among the merges."""
        key = symbols[:-1] * self.size + symbols[1:]
        rank, place = np.full(len(key), NEVER, dtype=np.int32), np.zeros(len(key), dtype=np.int64)
        ask = np.flatnonzero(self.may[self._slot(key)])
        at = np.minimum(np.searchsorted(self.key, key[ask]), len(self.key) - 1)
        hit = self.key[at] == key[ask]
        ask, at = ask[hit], at[hit]
        rank[ask], place[ask] = self.rank[at], at
        return rank, place

    def counts(self, sequences: list[bytes]) -> np.ndarray:
        out = np.fromiter(map(len, sequences), dtype=np.int64, count=len(sequences))
        alive = np.flatnonzero(out > 1)
        size = out[alive]
        symbols = self.first[np.frombuffer(b"".join([sequences[i] for i in alive]), dtype=np.uint8)]
        while len(alive):
            starts = np.cumsum(size) - size
            rank, place = self._ranks(symbols)
            rank[starts[1:] - 1] = NEVER  # pairs across sequences
            rank = np.append(rank, NEVER)
            least = np.minimum.reduceat(rank, starts)
            merge = (rank == np.repeat(least, size)) & (rank != NEVER)
            # A pair of equal symbols may overlap itself: of a run, every second.
            run = np.flatnonzero(merge[1:] & merge[:-1])
            if len(run):
                at = np.arange(len(merge))
                begin = np.maximum.accumulate(np.where(merge & ~np.concatenate(([False], merge[:-1])), at, 0))
                merge &= (at - begin) % 2 == 0
            where = np.flatnonzero(merge)
            symbols[where] = self.made[place[where]]
            keep = np.ones(len(symbols), dtype=bool)
            keep[where + 1] = False
            size = np.add.reduceat(keep, starts, dtype=np.int64)
            out[alive] = size
            # Sequences without a merge, or down to one symbol, are done.
            going = (least != NEVER) & (size > 1)
            keep &= np.repeat(going, np.diff(np.append(starts, len(keep))))
            symbols, alive, size = symbols[keep], alive[going], size[going]
        return out


class Counter:
    """Token counts of whole texts; one per worker process and tokenizer file."""

    def __init__(self, path: str):
        import regex
        self.merger = Merger(path)
        self.cut = regex.compile(PRE_TOKENS).findall
        self.special = regex.compile("|".join(map(regex.escape, self.merger.special))) if self.merger.special else None
        self.pieces: dict[str, int] = {}
        self.tokens: dict[str, int] = {}

    def _learn(self, pieces: set[str]) -> dict[str, int]:
        parts = {p: self.cut(p) for p in pieces}
        if len(self.tokens) > MAX_PIECES:
            self.tokens.clear()
        new = list({x for xs in parts.values() for x in xs if x not in self.tokens})
        self.tokens.update(zip(new, self.merger.counts([x.encode() for x in new]).tolist()))
        out = {p: sum([self.tokens[x] for x in xs]) for p, xs in parts.items()}
        for x in new:
            if len(x) > MAX_PIECE_CHARS:
                del self.tokens[x]
        return out

    def counts(self, texts: list[str | None]) -> list[int]:
        cut, extra = [], []
        for t in texts:
            sections = [t or ""]
            if self.special and any(s in sections[0] for s in self.merger.special):
                sections = self.special.split(sections[0])
            cut.append([p for s in sections for p in BYTE_LEVEL_PIECES.findall(s)] if len(sections) > 1
                       else BYTE_LEVEL_PIECES.findall(sections[0]))
            extra.append(len(sections) - 1)
        if len(self.pieces) > MAX_PIECES:
            self.pieces.clear()
        known = self.pieces
        fresh = self._learn({p for ps in cut for p in ps if p not in known})
        known.update(fresh)
        out = [sum(map(known.__getitem__, ps)) + n for ps, n in zip(cut, extra)]
        for p in fresh:
            if len(p) > MAX_PIECE_CHARS:
                del known[p]
        return out


def counter(path: str) -> Counter:
    return kept(("counter", path), lambda: Counter(path))


def token_counts(docs: DataFrame, tokenizer_path: str, *, limit: int = 512, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """One row per document: id, n_bytes (UTF-8), n_tokens, over_limit."""
    schema = T.StructType([
        T.StructField("id", docs.schema[id_col].dataType), T.StructField("n_bytes", T.LongType()),
        T.StructField("n_tokens", T.LongType()), T.StructField("over_limit", T.BooleanType())])

    def counted(batches) -> Iterator:
        import pyarrow as pa
        count = counter(tokenizer_path)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                n = count.counts(part.column(2).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(n, pa.int64()),
                     pa.array([x > limit for x in n], pa.bool_())], ["id", "n_bytes", "n_tokens", "over_limit"])

    slim = docs.select(F.col(id_col).alias("id"),
                       F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n"),
                       F.col(text_col).alias("t"))
    return slim.mapInArrow(counted, schema).withColumnRenamed("id", id_col)
