"""Token ids of whole texts by the ``tokenizers`` library, piece by piece.

A text is cut only where the tokenizer's own pre-tokenizer always cuts, each
distinct piece is encoded once per worker, and a text's ids are its pieces' ids
joined.  The memory per worker is bounded in bytes: a table has two generations, and
when the newer one is full the older one goes (this changes no result).
"""

from __future__ import annotations

import os
import re
from array import array
from itertools import chain

import numpy as np

from strata.llm.common import kept

# The characters that the tokenizers' \\s matches (White_Space).
WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"  # for a character class
# Bytes of a worker's table, both generations; an entry counts its strings and ENTRY.
TABLE_BYTES = 480 << 20
ENTRY = 190
MAX_PIECE_CHARS = 64

# Both kinds also cut between a Latin letter and ASCII punctuation other than the
# apostrophe; this makes far fewer distinct pieces to encode.  A CUT goes there first.
CUT = "\0"
MARK_AFTER_LETTER = re.compile(r"(?<=[A-Za-zÀ-ÖØ-öø-ÿ])[!-&(-/:-@\[-`{-~]")
# Byte-level BPE: a run of non-spaces takes one space before it along; of a run
# of white space before it, the rest stands alone.
BYTE_LEVEL_PIECES = re.compile(rf" ?[^{WHITE}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+")
BYTE_LEVEL_PARTS = re.compile(rf" ?[^{WHITE}{CUT}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+")
# Word BPE: white space only separates.
WORD_PARTS = re.compile(rf"[^{WHITE}{CUT}]+")


class Table:
    """Bytes by piece in two generations of at most ``limit`` bytes together.  What is
    used again moves to the newer one, so frequent pieces always stay."""

    def __init__(self, limit: int):
        self.half = limit // 2
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.size = 0

    def missing(self, keys: set[str]) -> set[str]:
        """The keys to ``add``; all others are in ``new`` then, until the next call."""
        if self.size > self.half:
            self.old, self.new, self.size = self.new, {}, 0
        out = keys.difference(self.new)
        if self.old:
            again = out.intersection(self.old)
            self.add(again, list(map(self.old.__getitem__, again)))
            out -= again
        return out

    def add(self, keys, values: list[bytes]) -> None:
        self.new.update(zip(keys, values))
        self.size += ENTRY * len(values) + sum(map(len, keys)) + sum(map(len, values))

    def forget_long(self, keys) -> None:
        """Long pieces are not kept."""
        for k in [k for k in keys if len(k) > MAX_PIECE_CHARS]:
            self.size -= ENTRY + len(k) + len(self.new.pop(k))


class Encoder:
    """``ids(texts)``: each text's ids as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str, kind: str, table_bytes: int = TABLE_BYTES):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.lib = Tokenizer.from_file(path)
        self.lib.no_padding()
        self.lib.no_truncation()
        added = sorted((i, t.content) for i, t in self.lib.get_added_tokens_decoder().items())
        self.special = [content for _, content in added]
        self.mark = added[0][0]
        self.cut = (BYTE_LEVEL_PARTS if kind == "byte" else WORD_PARTS).findall
        self.known = Table(table_bytes)

    def _encode(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.lib.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode_pieces(self, pieces: list[str]) -> list[bytes]:
        """As ``_encode``, for texts without special strings: one of these stands
        between the pieces, where the library parts them and leaves its id."""
        out: list[bytes] = []
        for at in range(0, len(pieces), 1024):
            some = pieces[at:at + 1024]
            ids = self._encode([self.special[0].join(some)])[0]
            here = 0
            for cut in np.flatnonzero(np.frombuffer(ids, "<u4") == self.mark).tolist():
                out.append(ids[4 * here:4 * cut])
                here = cut + 1
            out.append(ids[4 * here:])
        return out

    def ids(self, texts: list[str | None]) -> list[bytes]:
        out: list[bytes] = []
        for at in range(0, len(texts), 256):
            out += self._block([t or "" for t in texts[at:at + 256]])
        return out

    def _block(self, texts: list[str]) -> list[bytes]:
        # A special string makes the library cut the text first: such texts go to it whole.
        whole = [CUT in t or any(s in t for s in self.special) for t in texts]
        parts = [[] if w else self.cut(MARK_AFTER_LETTER.sub(CUT + r"\g<0>", t)) for t, w in zip(texts, whole)]
        new = list(self.known.missing(set(chain.from_iterable(parts))))
        self.known.add(new, self._encode_pieces(new))
        done = [b"".join(map(self.known.new.__getitem__, ps)) for ps in parts]
        self.known.forget_long(new)
        for i, w in enumerate(whole):
            if w:
                done[i] = self._encode([texts[i]])[0]
        return done


def encoder(path: str, kind: str, table_bytes: int = TABLE_BYTES) -> Encoder:
    """One encoder per worker process; another tokenizer or size replaces it."""
    return kept(("encoder", path, kind, table_bytes), lambda: Encoder(path, kind, table_bytes))
