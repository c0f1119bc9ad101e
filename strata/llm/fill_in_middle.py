"""Fill-in-middle transformation by repeated-capture matching.

A text is a row of units, each a run of Latin letters or one other character.  One
``fullmatch`` of ``(unit)*`` retains every repetition of the group, so ``ends(1)`` is
the place where each unit ends: its length is the number of units ``n``, and the two
cuts are two of its entries.  No unit is looked at in Python.

Per repetition the regex library keeps some hundred bytes, so a text of more than
``BLOCK_CHARS`` characters is matched block by block, each block ending where a unit
ends (a run of letters that reaches over the end goes along); the cuts are the same.

Four draws from a hash of the document's id choose the cuts and the form: ``plain``
(the text itself), ``psm`` (prefix, suffix, middle) or ``spm`` (suffix, prefix,
middle), each part behind its mark.  A text that holds a mark stays plain, so
``restored`` always gives the exact text back.

Map-only: nothing is shuffled, and a task holds a few documents at a time.

Defined results: a null text is the empty text (plain, 0 units); a null id draws as an
empty string; rows of equal id get equal draws; further columns are ignored; an empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import text_of

# Marks, units, salt of the draws, shares in per cent.
PREFIX, SUFFIX, MIDDLE = MARKS = ("<P>", "<S>", "<M>")
UNIT = r"[A-Za-z]+|[^A-Za-z]"
SALT = "1:"
FIM_PERCENT = 90
SPM_PERCENT = 20
# Memory bounds: characters of one match, characters of one batch that leaves a task.
BLOCK_CHARS = 1 << 17
BATCH_CHARS = 1 << 22


def draws(id_col: str, salt: str = SALT, n: int = 4) -> list[Column]:
    """``n`` unsigned 32-bit integers from the SHA-256 of the salt and the decimal id."""
    digest = F.sha2(F.concat(F.lit(salt), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(n)]


class Cutter:
    """``cut(text, h1, h2)``: the number of units, and the ends of prefix and middle."""

    def __init__(self, block: int = BLOCK_CHARS):
        import regex
        self.units = regex.compile(f"({UNIT})*")
        self.letters = regex.compile("[A-Za-z]*")
        self.block = block

    def cut(self, text: str, h1: int, h2: int) -> tuple[int, int, int]:
        if len(text) <= self.block:
            ends = self.units.fullmatch(text).ends(1)
            n = len(ends)
            low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
            return n, ends[low - 1] if low else 0, ends[high - 1] if high else 0
        blocks, n, at = [], 0, 0  # (units before, first character, last character)
        while at < len(text):
            to = min(at + self.block, len(text))
            if to < len(text) and self.letters.match(text, to - 1, to).end() == to:
                to = self.letters.match(text, to).end()
            blocks.append((n, at, to))
            n += len(self.units.fullmatch(text, at, to).ends(1))
            at = to
        low, high = sorted((h1 % (n + 1), h2 % (n + 1)))

        def end(k: int) -> int:
            if not k:
                return 0
            before, first, last = next(b for b in reversed(blocks) if b[0] < k)
            return self.units.fullmatch(text, first, last).ends(1)[k - before - 1]

        return n, end(low), end(high)


def fill_in_middle(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                   block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per document: id, n, form, prefix_chars, middle_chars (null if plain), output."""
    schema = T.StructType([
        T.StructField("id", docs.schema[id_col].dataType), T.StructField("n", T.LongType()),
        T.StructField("form", T.StringType()), T.StructField("prefix_chars", T.LongType()),
        T.StructField("middle_chars", T.LongType()), T.StructField("output", T.StringType())])

    def transformed(batches) -> Iterator:
        import pyarrow as pa
        cutter = Cutter(block_chars)

        def one(text: str, h1: int, h2: int, h3: int, h4: int) -> tuple:
            n, a, b = cutter.cut(text, h1, h2)
            if not text or h3 % 100 >= FIM_PERCENT or any(m in text for m in MARKS):
                return n, "plain", None, None, text
            if h4 % 100 < SPM_PERCENT:
                return n, "spm", a, b - a, "".join((SUFFIX, text[b:], PREFIX, text[:a], MIDDLE, text[a:b]))
            return n, "psm", a, b - a, "".join((PREFIX, text[:a], SUFFIX, text[b:], MIDDLE, text[a:b]))

        def batch_of(rows: list[tuple]):
            columns = list(zip(*rows))
            return pa.RecordBatch.from_arrays(
                [pa.array(columns[0], id_type), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.string()),
                 pa.array(columns[3], pa.int64()), pa.array(columns[4], pa.int64()), pa.array(columns[5], pa.string())],
                schema.names)

        for batch in batches:
            id_type = batch.schema.field(0).type
            rows, held = [], 0
            for at in range(0, batch.num_rows, 64):
                for doc_id, text, *h in zip(*(c.to_pylist() for c in batch.slice(at, 64).columns)):
                    rows.append((doc_id, *one(text, *h)))
                    held += len(text)
                if held > BATCH_CHARS:
                    yield batch_of(rows)
                    rows, held = [], 0
            if rows:
                yield batch_of(rows)

    slim = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("t"),
                       *[h.alias(f"h{i}") for i, h in enumerate(draws(id_col))])
    return slim.mapInArrow(transformed, schema).withColumnRenamed("id", id_col)


def restored(form: str = "form", output: str = "output") -> Column:
    """The exact text, rebuilt from form and output alone."""
    part = F.split(F.col(output), "<[PSM]>")  # a text with marks of its own is plain
    return F.when(F.col(form) == "psm", F.concat(F.get(part, F.lit(1)), F.get(part, F.lit(3)), F.get(part, F.lit(2)))) \
        .when(F.col(form) == "spm", F.concat(F.get(part, F.lit(2)), F.get(part, F.lit(3)), F.get(part, F.lit(1)))) \
        .otherwise(F.col(output))
