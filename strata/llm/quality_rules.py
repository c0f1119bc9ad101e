"""Quality rules with risk-controlled cutoffs (native expressions only).

Per document a few counts are taken over the whole text.  Fixed base rules
reject very short and very repetitive texts.  On top of them every stratum
(language) climbs a fixed ladder of rungs: a rung gives each metric a cutoff, a
higher rung none that is laxer.  The labelled clean documents prove how far:

* the labelled holdout of a stratum has ``n`` distinct clean texts, of which
  ``k`` exceed some cutoff of a rung;
* the rung is certified if ``P(Bin(n, risk) <= k) <= delta / strata``, that is
  if the exact (Clopper-Pearson) upper bound of the rate at which the whole rung
  rejects clean texts is below ``risk``;
* rungs are tested from the laxest up and the first failure ends the climb
  (fixed-sequence testing: no error budget is divided within a stratum); between
  the strata the budget ``delta`` is divided (Bonferroni).  So with probability
  ``1 - delta`` no stratum loses more than ``risk`` of its clean texts.

A language is a stratum of its own if it has ``MIN_TEXTS`` clean labelled texts
and a thousandth of them all (so there are at most a thousand); the others share
the stratum ``other``.  Copies of a text are one trial, in the smallest of its
languages.  Too few labels certify nothing, and then only the base rules reject.
Three-word windows and labelled texts are told apart by their 64-bit hashes.

Defined results: a null text is the empty text; a null language belongs to the
stratum ``other``; labels with nulls are ignored, repeated labels of one
document count once, by their worst values; repeated rows and ids each get
their own row; further columns, whatever their names, are ignored by
``quality_report`` and passed through by ``filter_documents``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import ASCII_SPACES, free_name, let, stage, text_of

# Base rules and what counts as a symbol.
SYMBOLS = "#*$%&|<>"
SPACE_RUN = r"[\x20\x09-\x0D]+"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
REPEAT_WINDOW = 3
# Up to so many repeated windows are looked up one by one (speed only).
FEW_REPEATS = 24

OTHER = "other"
MIN_TEXTS = 100
# Metrics are whole thousandths, so that both sides of a comparison are exact.
METRICS = {
    "symbols": ("n_symbols", "word_chars"),
    "duplicate_lines": ("n_dup_lines", "n_lines"),
    "repeats": ("n_repeat_words", "n_words"),
    "capitals": ("n_capitals", "word_chars"),
}
# Cutoffs of the metrics by rung; the last ones are about those of published web filters.
LADDER = (
    (600, 900, 490, 900),
    (500, 800, 480, 800),
    (400, 700, 460, 700),
    (300, 600, 440, 600),
    (200, 500, 420, 500),
    (150, 450, 410, 400),
    (100, 400, 400, 300),
)
STRATUM_RISK = 0.03
DELTA = 0.05
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals")


def _repeated_words(words: Column) -> Column:
    """Words covered by windows of three words that occur at least twice.

    The sorted hashes of all windows show which ones occur again.  With few of
    these their places are looked up directly; else the hashes are sorted with
    their places, so that equal windows stand side by side.  No pairs are formed.
    """
    w = REPEAT_WINDOW

    def hashes(a: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(a) - w),
                           lambda i: F.xxhash64(*[F.get(a, i + k) for k in range(w)]))

    def again(s: Column) -> Column:
        return F.array_distinct(F.filter(s, lambda x, j: F.get(s, j - 1) == x))

    def few(h: Column, d: Column) -> Column:
        return F.filter(F.transform(h, lambda x, i: F.when(F.array_contains(d, x), i)), lambda i: i.isNotNull())

    def many(h: Column) -> Column:
        placed = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return let(placed, lambda s: F.array_sort(F.transform(
            F.filter(s, lambda x, j: (F.get(s, j - 1)["h"] == x["h"]) | (F.get(s, j + 1)["h"] == x["h"])),
            lambda x: x["i"])))

    def covered(p: Column) -> Column:
        return F.aggregate(
            F.transform(p, lambda x, j: F.least(F.lit(w), F.coalesce(F.get(p, j + 1) - x, F.lit(w)))),
            F.lit(0), lambda a, x: a + x)

    def counted(h: Column) -> Column:
        return let(let(F.sort_array(h), again), lambda d: F.when(F.size(d) == 0, F.lit(0)).otherwise(
            let(F.when(F.size(d) <= FEW_REPEATS, few(h, d)).otherwise(many(h)), covered)))

    return F.when(F.size(words) < w, F.lit(0)).otherwise(let(hashes(words), counted))


def rule_counts(docs: DataFrame, text_col: str = "text", name: str = "rules") -> DataFrame:
    """``docs`` with the counts of the rules (``COUNTS``, long) in one struct ``name``."""
    text = text_of(text_col)
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    counts = let(
        F.struct(text.alias("t"), F.array_remove(F.split(text, SPACE_RUN), "").alias("w"), lines.alias("l")),
        lambda d: F.struct(
            F.size(d["w"]).cast("long").alias("n_words"),
            F.length(F.translate(d["t"], ASCII_SPACES, "")).cast("long").alias("word_chars"),
            (F.length(d["t"]) - F.length(F.translate(d["t"], SYMBOLS, ""))).cast("long").alias("n_symbols"),
            (F.size(d["l"]) - F.size(F.array_distinct(d["l"]))).cast("long").alias("n_dup_lines"),
            _repeated_words(d["w"]).cast("long").alias("n_repeat_words"),
            F.size(d["l"]).cast("long").alias("n_lines"),
            F.length(F.regexp_replace(d["t"], "[^A-Z]+", "")).cast("long").alias("n_capitals")))
    return docs.withColumn(name, counts)


def base_failed(r: Column) -> Column:
    return (r["n_words"] < MIN_WORDS) | (100 * r["n_repeat_words"] > MAX_REPEAT_PERCENT * r["n_words"])


def metric(r: Column, name: str) -> Column:
    part, whole = METRICS[name]
    return F.when(r[whole] > 0, F.floor(1000 * r[part] / r[whole])).otherwise(F.lit(0)).cast("long")


def binomial_cdf(k: int, n: int, p: float) -> float:
    """P(Bin(n, p) <= k) for k below the mean, summed from its largest term down."""
    term = math.exp(math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)
                    + k * math.log(p) + (n - k) * math.log1p(-p))
    total = 0.0
    for j in range(k, -1, -1):
        total += term
        if term < total * 1e-17:
            break
        term *= j * (1 - p) / ((n - j + 1) * p)
    return total


def certified(k: int, n: int, risk: float, level: float) -> bool:
    """True if the exact upper confidence bound of the rate k/n is below ``risk``."""
    return n > 0 and k < risk * n and binomial_cdf(k, n, risk) <= level


def counted(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
            lang_col: str = "lang") -> DataFrame:
    """(id, lang, rules, text_hash) per document, staged: a few numbers each."""
    slim = docs.select(F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"),
                       F.col(text_col).alias("text"))
    return stage(rule_counts(slim).select("id", "lang", "rules", F.xxhash64(text_of("text")).alias("text_hash")),
                 "rule-counts")


def exceeds(r: Column, cutoffs) -> Column:
    """True if some metric is over its cutoff."""
    hit = F.lit(False)
    for m, c in zip(METRICS, cutoffs):
        hit = hit | (metric(r, m) > c)
    return hit


def climb(n: int, over: list[int], risk: float, level: float) -> int:
    """The highest rung reached, from 1; 0 if the first is not certified."""
    for rung, k in enumerate(over):
        if not certified(k, n, risk, level):
            return rung
    return len(over)


def learn_rungs(counts: DataFrame, labels: DataFrame, *, label_id_col: str = "doc_id",
                stratum_risk: float = STRATUM_RISK, delta: float = DELTA) -> dict[str, int]:
    """stratum -> its rung, over all labelled documents.

    ``counts`` comes from ``counted``.  The driver gets one row per stratum, of
    which there are at most a thousand and ``other``.
    """
    r = F.col("rules")
    clean = labels.groupBy(F.col(label_id_col).alias("id")) \
        .agg(F.min("quality").alias("q"), F.max("toxic").alias("x")) \
        .filter((F.col("q") == 1) & (F.col("x") == 0)).select("id")
    texts = counts.filter(~base_failed(r)).join(clean, "id", "left_semi").groupBy("text_hash") \
        .agg(F.min(F.coalesce("lang", F.lit(OTHER))).alias("lang"), F.min("rules").alias("rules"))
    sums = [F.sum(exceeds(r, c).cast("long")).alias(f"k{i}") for i, c in enumerate(LADDER)]
    langs = stage(texts.groupBy("lang").agg(F.count("*").alias("n"), *sums), "rule-trials")
    total = langs.agg(F.sum("n")).first()[0] or 0
    own = (F.col("lang") != OTHER) & (F.col("n") >= MIN_TEXTS) & (1000 * F.col("n") >= total)
    rows = langs.groupBy(F.when(own, F.col("lang")).otherwise(F.lit(OTHER)).alias("lang")) \
        .agg(F.sum("n").alias("n"), *[F.sum(f"k{i}").alias(f"k{i}") for i in range(len(LADDER))]).collect()
    level = delta / (len({row["lang"] for row in rows} | {OTHER}))
    return {OTHER: 0} | {row["lang"]: climb(row["n"], [row[f"k{i}"] for i in range(len(LADDER))], stratum_risk, level)
                         for row in rows}


def stratum(lang: Column, rungs: dict[str, int]) -> Column:
    return F.when(lang.isin(*rungs), lang).otherwise(F.lit(OTHER))


def kept(r: Column, lang: Column, rungs: dict[str, int]) -> Column:
    pairs = [F.lit(x) for item in sorted(rungs.items()) for x in item]
    rung = F.element_at(F.create_map(*pairs), stratum(lang, rungs))
    over = F.lit(False)
    for i, m in enumerate(METRICS):
        cutoff = F.get(F.array(*[F.lit(c[i]) for c in LADDER]), rung - 1)
        over = over | F.coalesce(metric(r, m) > cutoff, F.lit(False))
    return ~base_failed(r) & ~over


def quality_report(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                   lang_col: str = "lang", **risk) -> DataFrame:
    """One row per document: id, the counts, stratum, ``base_failed`` and ``kept``."""
    r = F.col("rules")
    counts = counted(docs, id_col=id_col, text_col=text_col, lang_col=lang_col)
    rungs = learn_rungs(counts, labels, **risk)
    return counts.select(
        F.col("id").alias(id_col), *[r[c].alias(c) for c in COUNTS], stratum(F.col("lang"), rungs).alias("stratum"),
        base_failed(r).alias("base_failed"), kept(r, F.col("lang"), rungs).alias("kept"))


def filter_documents(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                     lang_col: str = "lang", **risk) -> DataFrame:
    """The documents that pass all rules, with their own columns unchanged.

    The documents are staged with their counts, so that every text is counted once;
    learning reads the small columns of that table alone.
    """
    name = free_name(docs, "rules")
    full = stage(rule_counts(docs, text_col, name), "ruled")
    slim = full.select(F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"),
                       F.col(name).alias("rules"), F.xxhash64(text_of(text_col)).alias("text_hash"))
    rungs = learn_rungs(slim, labels, **risk)
    return full.filter(kept(F.col(name), F.col(lang_col).cast("string"), rungs)).drop(name)
