"""Quality classifier by co-training of two views.

View one is the text: shape figures and the presence of telling words (hashed
words whose frequency differs most between good and bad labelled documents).
View two is the page's metadata: language, source and recorded length.  Each view
gets a ridge logistic regression.  Over some rounds each view scores all unlabelled
documents and labels every one it is sure of, as measured on held-out labels, for the
*other* view's training set (Blum & Mitchell; a document keeps the first label that a
view is given).  The Newton steps of a refit take the sums of gradient and Hessian
over all these documents from Spark; the documents labelled by a view count less
where there are many, so that together they weigh at most as much as the labelled
ones.  Both views are then calibrated on the held-out labels and combined.

Only the labelled rows of the fit are bounded: ``FIT_ROWS`` documents, drawn by the
hash of their id; everything else sees all rows.  Each text is read once for its
digest (what both views need of it), which all rounds, the cutoff and
``quality_scores`` use; ``filter_documents`` reads the texts again to pass them on.

A document is good if its label says quality 1 and toxic 0.  It is kept if its
combined score reaches the cutoff.  All labelled documents whose labels fitted
neither view are scored and counted by score, exactly per bin of 1/``BINS``.  The
cutoff is the median of 1/2, the highest bin that rejects at most
``MAX_FALSE_REJECTION`` of their good documents and the lowest that keeps at most
``MAX_KEPT_TOXIC`` of their toxic ones: 1/2 if that meets both bounds, else the
nearest that does, and if none does it goes from 1/2 towards the broken bound only
as far as the other one is met.

Defined results: a null text is the empty text; null or unseen metadata is a level
of its own; repeated labels count once, by their worst values, and labels with
nulls are ignored; with fewer than ``MIN_CLASS`` good or bad labelled documents
nothing is learnt: scores are null and all documents are kept.  Repeated rows each
get a row; further columns are ignored or passed through.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import free_name, release, stage

FIT_ROWS = 6000
ROUNDS = 3
TELLING_WORDS = 256
# Of the many words of a sample some differ by chance; fewer than one reaches this.
TELLING_Z = 4.5
SURE = 0.98
# Newton steps of a refit end when no weight moves by so much (the error left is of
# the order of its square).
STEP_ENDS = 0.01
MAX_STEPS = 12
PENALTY = 0.1
MIN_CLASS = 10
MAX_FALSE_REJECTION = 0.002
MAX_KEPT_TOXIC = 0.01
BINS = 10_000

_MARKS = b"#*$%&|<>!"
_TO_SPACE = bytes(x if x >= 128 or chr(x).isalnum() else 32 for x in range(256))
_UPPER = bytes(range(65, 91))
_DIGITS = bytes(range(48, 58))
SHAPES = 8
PREFIXES = (5, 6, 7, 8)  # bytes


def words_and_shape(text: str | None) -> tuple[set[bytes], list[float]]:
    """The distinct words of a whole text, and its shape figures."""
    raw = (text or "").encode("utf-8", "replace")
    words = raw.lower().translate(_TO_SPACE).split()
    n, size = len(words), max(1, len(raw))
    distinct = set(words)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    return distinct, [
        math.log1p(n),
        (size - len(raw.translate(None, _MARKS))) / size,
        (size - len(raw.translate(None, _UPPER))) / size,
        (size - len(raw.translate(None, _DIGITS))) / size,
        len(distinct) / max(1, math.sqrt(n)) / 10,
        1 - len(distinct) / max(1, n),
        1 - len(set(lines)) / max(1, len(lines)),
        sum(map(len, words)) / max(1, n) / 10,
    ]


def word_features(words: set[bytes]) -> np.ndarray:
    """Hashes of distinct words and of their beginnings (inflected and compound words
    share these), each once."""
    out = list(map(zlib.crc32, words))
    for k in PREFIXES:
        out += [zlib.crc32(p, k) for p in {w[:k] for w in words if len(w) > k}]
    return np.unique(np.array(out, dtype=np.uint32))


def meta_row(lang: str | None, source: str | None, n_chars: int | None) -> list[float]:
    """Metadata as one-hot levels (16 by the language's hash, 64 by the source's)
    and the recorded length."""
    row = [0.0] * 83
    row[zlib.crc32((lang or "").encode()) % 16 if lang is not None else 16] = 1.0
    row[17 + (zlib.crc32(source.encode()) % 64 if source is not None else 64)] = 1.0
    row[82] = math.log1p(max(0, n_chars or 0)) / 10
    return row


@dataclass
class Ridge:
    """Logistic regression with ridge penalty, fitted by Newton steps."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, steps: int = 25) -> Ridge:
        mean, scale = x.mean(axis=0), x.std(axis=0)
        scale[scale < 1e-9] = 1.0
        model = cls(mean, scale, np.zeros(x.shape[1] + 1))
        for _ in range(steps):
            model, moved = model.stepped(model.sums(x, y))
            if moved < 1e-6:
                break
        return model

    def sums(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Gradient (first row) and Hessian of the log-likelihood of some rows."""
        z = np.hstack([(x - self.mean) / self.scale, np.ones((len(x), 1))])
        p = _sigmoid(z @ self.weights)
        return np.vstack([z.T @ (y - p), (z.T * np.maximum(p * (1 - p), 1e-6)) @ z])

    def stepped(self, sums: np.ndarray) -> tuple[Ridge, float]:
        """The model after a Newton step with the sums of all rows, and how far it went."""
        ridge = np.full(len(self.weights), PENALTY)
        ridge[-1] = 1e-6
        step = np.linalg.solve(sums[1:] + np.diag(ridge), sums[0] - ridge * self.weights)
        moved = float(np.abs(step).max())
        return Ridge(self.mean, self.scale, self.weights + step * min(1.0, 5.0 / max(1e-9, moved))), moved

    def logit(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.scale) @ self.weights[:-1] + self.weights[-1]


def _sigmoid(v: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(v, -40, 40)))


def _text_row(features: np.ndarray, shape: list[float], telling: np.ndarray) -> np.ndarray:
    row = np.zeros(SHAPES + len(telling))
    row[:SHAPES] = shape
    row[SHAPES:] = np.isin(telling, features, assume_unique=True)
    return row


@dataclass
class CoTrained:
    telling: np.ndarray  # sorted hashes of telling words and beginnings
    text: Ridge | None = None
    meta: Ridge | None = None
    calibrated_text: Ridge | None = None
    calibrated_meta: Ridge | None = None
    combined: Ridge | None = None
    cutoff: float = 0.5
    traded: list[tuple[int, int]] = field(default_factory=list)

    def text_rows(self, texts: Iterable[str | None]) -> np.ndarray:
        out = []
        for t in texts:
            words, shape = words_and_shape(t)
            out.append(_text_row(word_features(words), shape, self.telling))
        return np.array(out).reshape(len(out), SHAPES + len(self.telling))

    def score(self, texts, langs, sources, lengths) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Calibrated probability "good" of the text view, the metadata view, both."""
        x = self.text_rows(texts)
        m = np.array([meta_row(*r) for r in zip(langs, sources, lengths)]).reshape(len(x), 83)
        return self.score_views(x, m)

    def score_views(self, x: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``score`` of the rows of the text view and of the metadata view."""
        a, b = self.text.logit(x)[:, None], self.meta.logit(m)[:, None]
        return (_sigmoid(self.calibrated_text.logit(a)), _sigmoid(self.calibrated_meta.logit(b)),
                _sigmoid(self.combined.logit(np.hstack([a, b]))))


def _sure(held: np.ndarray, y: np.ndarray, good: bool) -> float:
    """From which probability of its side on a view labels surely: the loosest (a half
    of the held-out rows at most) at which its held-out labels are right."""
    side = held if good else 1 - held
    right = (y == 1) if good else (y == 0)
    order = np.argsort(-side)
    hits = np.cumsum(right[order]) / np.arange(1, len(order) + 1)
    allowed = np.flatnonzero((hits >= SURE) & (np.arange(len(order)) < len(order) / 2) & (side[order] > 0.5))
    if not len(allowed) or allowed[-1] < 4:
        return math.inf
    return float(side[order[allowed[-1]]])


@dataclass
class Round:
    """Both views at the begin of a round, and from which probability on each is sure
    that a document is good and that it is bad."""

    views: list[Ridge]
    sure: list[tuple[float, float]]


def given_labels(rows: tuple[np.ndarray, np.ndarray], rounds: list[Round]) -> list[np.ndarray]:
    """For each view the labels that the other one gave some rows in the rounds so far:
    the first that it was sure of, -1 for none."""
    given = [np.full(len(rows[0]), -1), np.full(len(rows[0]), -1)]
    for r in rounds:
        for me, other in ((0, 1), (1, 0)):
            p = _sigmoid(r.views[me].logit(rows[me]))
            for side, least, label in ((p, r.sure[me][0], 1), (1 - p, r.sure[me][1], 0)):
                given[other][(given[other] < 0) & (side >= least)] = label
    return given


def unlabelled_sums(table: DataFrame, telling: np.ndarray, views: list[Ridge], rounds: list[Round]) -> list:
    """For each view: how many unlabelled digests have a label by now, and their sums."""
    sizes = [len(v.weights) for v in views]

    def add(total: list, part: list) -> None:
        for t, p in zip(total, part):
            t[0] += p[0]
            t[1] += p[1]

    def zero() -> list:
        return [[0, np.zeros((n + 1, n))] for n in sizes]

    def batch_of(total: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([0, 1], pa.int32()), pa.array([int(n) for n, _ in total], pa.int64()),
             pa.array([m.tobytes() for _, m in total], pa.binary())], ["view", "n", "sums"])

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = zero()
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                rows = views_of(batch.slice(at, 4096), telling)
                given = given_labels(rows, rounds)
                add(total, [(np.sum(g >= 0), v.sums(x[g >= 0], g[g >= 0])) for x, g, v in zip(rows, given, views)])
        yield batch_of(total)

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = zero()
        for batch in batches:
            for k, n, m in zip(*(batch.column(c).to_pylist() for c in ("view", "n", "sums"))):
                total[k][0] += n
                total[k][1] += np.frombuffer(m).reshape(total[k][1].shape)
        yield batch_of(total)

    kind = "view int, n long, sums binary"
    parts = table.filter("q is null").mapInArrow(summed, kind)
    total = zero()
    for r in parts.repartition(8).mapInArrow(merged, kind).collect():  # one matrix per view and partition
        total[r["view"]][0] += r["n"]
        total[r["view"]][1] += np.frombuffer(bytes(r["sums"])).reshape(total[r["view"]][1].shape)
    return total


def refit(table: DataFrame, telling: np.ndarray, views: list[Ridge], rounds: list[Round],
          own: list[np.ndarray], y: np.ndarray) -> tuple[list[Ridge], tuple[int, int]]:
    """Both views fitted to the labelled rows ``own`` and to all unlabelled digests with
    the labels of the rounds so far, and how many of these there are."""
    active = [True, True]
    for _ in range(MAX_STEPS):
        found = unlabelled_sums(table, telling, views, rounds)
        for k in (0, 1):
            if active[k]:
                n, sums = found[k]
                views[k], moved = views[k].stepped(views[k].sums(own[k], y) + sums * min(1.0, len(y) / max(1, n)))
                # Sums come in any order: without their last digits all runs are equal.
                views[k].weights = np.round(views[k].weights, 8)
                active[k] = moved >= STEP_ENDS
        if not any(active):
            break
    return views, (found[0][0], found[1][0])


def _telling(words: list[np.ndarray], y: np.ndarray, limit: int) -> np.ndarray:
    """Hashed features by the difference of their document frequencies (z score)."""
    flat = np.concatenate(words)
    owner = np.repeat(y, [len(w) for w in words])
    ids, inverse = np.unique(flat, return_inverse=True)
    good = np.bincount(inverse, weights=owner, minlength=len(ids))
    bad = np.bincount(inverse, minlength=len(ids)) - good
    n1, n0 = max(1, int(y.sum())), max(1, int((1 - y).sum()))
    rate = (good + bad) / (n1 + n0)
    z = (good / n1 - bad / n0) / np.sqrt(rate * (1 - rate + 1e-9) * (1 / n1 + 1 / n0) + 1e-12)
    use = np.flatnonzero((good + bad >= 3) & (np.abs(z) >= TELLING_Z))
    return np.sort(ids[use[np.lexsort((ids[use], -np.abs(z[use])))][:limit]])


def _known(labels: DataFrame, id_col: str) -> DataFrame:
    """(id, q, x) once per labelled document, by its worst values."""
    return labels.filter(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")) \
        .agg(F.min("quality").alias("q"), F.max("toxic").alias("x")).filter("q is not null and x is not null")


def _sample(docs: DataFrame, labels: DataFrame, fit_rows: int, id_col: str, text_col: str,
            lang_col: str, source_col: str, length_col: str) -> list:
    """The bounded labelled rows, with hashed words and shape in place of the text."""
    known = _known(labels, id_col)
    order = F.xxhash64("id", F.lit("fit"))
    ids = docs.filter(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"))
    chosen = known.join(ids, "id", "left_semi").orderBy(order, "id").limit(fit_rows) \
        .select("id", ((F.col("q") == 1) & (F.col("x") == 0)).cast("int").alias("y"), "q", "x")  # pairs of numbers

    @F.udf("struct<w: binary, s: array<double>>")
    def digest(text):
        words, shape = words_and_shape(text)
        return word_features(words).tobytes(), shape

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"), F.col(lang_col).alias("l"),
                       F.col(source_col).alias("src"), F.col(length_col).alias("n")) \
        .join(F.broadcast(chosen), "id").dropDuplicates(["id"])
    return rows.select("id", "y", "q", "x", "l", "src", "n", digest("t").alias("d")).collect()


def digests(docs: DataFrame, labels: DataFrame, fitted: list, telling: np.ndarray, *, id_col: str, text_col: str,
            lang_col: str, source_col: str, length_col: str) -> DataFrame:
    """One row per document, staged: id, what both views need of it (the telling words
    as bits ``w``, the shape ``s``, the metadata's levels ``ml``, ``ms`` and length
    ``mn``), its label ``q``, ``x`` (null if none) and whether its id is in ``fitted``."""
    id_type = docs.schema[id_col].dataType
    schema = T.StructType([T.StructField("id", id_type)]) \
        .add("w", "binary").add("s", T.ArrayType(T.DoubleType())).add("ml", "integer").add("ms", "integer").add("mn", "double")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            w, shapes = [], []
            for text in batch.column(1).to_pylist():
                words, shape = words_and_shape(text)
                w.append(np.packbits(np.isin(telling, word_features(words), assume_unique=True)).tobytes())
                shapes.append(shape)
            meta = [meta_row(*r) for r in zip(*(batch.column(k).to_pylist() for k in (2, 3, 4)))]
            levels = np.array(meta).reshape(len(meta), 83)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(w, pa.binary()), pa.array(shapes, pa.list_(pa.float64())),
                 pa.array(levels[:, :17].argmax(axis=1), pa.int32()),
                 pa.array(levels[:, 17:82].argmax(axis=1) + 17, pa.int32()), pa.array(levels[:, 82], pa.float64())],
                ["id", "w", "s", "ml", "ms", "mn"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"), F.col(lang_col).cast("string").alias("l"),
                       F.col(source_col).cast("string").alias("src"), F.col(length_col).cast("double").alias("n")) \
        .mapInArrow(digest, schema)
    sample = docs.sparkSession.createDataFrame([(i,) for i in fitted], T.StructType([T.StructField("id", id_type)]))
    known = _known(labels, id_col).join(F.broadcast(sample.withColumn("fitted", F.lit(True))), "id", "left")
    return stage(rows.join(known, "id", "left"), "digests")


def views_of(batch: pa.RecordBatch, telling: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The text view's and the metadata view's rows of a batch of digests."""
    n = batch.num_rows
    bits = np.frombuffer(b"".join(batch.column("w").to_pylist()), dtype=np.uint8).reshape(n, -(-len(telling) // 8))
    shape = batch.column("s").flatten().to_numpy(zero_copy_only=False).reshape(n, SHAPES)
    text = np.hstack([shape, np.unpackbits(bits, axis=1, count=len(telling)).astype(float)])
    meta = np.zeros((n, 83))
    for k in ("ml", "ms"):
        meta[np.arange(n), batch.column(k).to_numpy()] = 1.0
    meta[:, 82] = batch.column("mn").to_numpy()
    return text, meta


def _bins(scores: np.ndarray) -> np.ndarray:
    return np.floor(scores * BINS).astype(np.int64)


def _cutoff(good: np.ndarray, toxic: np.ndarray) -> float:
    """The cutoff for the numbers of good and of toxic documents per score bin."""
    below = np.concatenate(([0], np.cumsum(good)))  # rejected by a cutoff at each bin
    above = toxic.sum() - np.concatenate(([0], np.cumsum(toxic)))
    high = np.flatnonzero(below <= MAX_FALSE_REJECTION * good.sum())[-1]
    low = np.flatnonzero(above <= MAX_KEPT_TOXIC * toxic.sum())[0] if toxic.sum() else 0
    return sorted((BINS // 2, int(high), int(low)))[1] / BINS


def learn_cutoff(model: CoTrained, table: DataFrame, held: list[tuple[float, int, int]]) -> float:
    """The cutoff over ``held`` (score, quality, toxic) and all labelled digests that
    are not in the sample.  The driver gets one number per score bin and class."""
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                yield pa.RecordBatch.from_arrays(
                    [part.column("x"), pa.array(_bins(model.score_views(*views_of(part, model.telling))[2]))], ["x", "bin"])

    rest = table.filter("fitted is null and (x = 0 and q = 1 or x = 1)").withColumn("x", F.col("x").cast("int"))
    counts = np.zeros((2, BINS + 1), dtype=np.int64)
    for r in rest.mapInArrow(of, "x int, bin long").groupBy("x", "bin").count().collect():
        counts[r["x"], r["bin"]] += r["count"]
    for score, quality, toxic in held:
        if toxic == 1 or toxic == 0 and quality == 1:
            counts[int(toxic), int(_bins(np.array(score)))] += 1
    return _cutoff(counts[0], counts[1])


def train(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", **settings) -> CoTrained | None:
    return _train(docs, labels, id_col=id_col, **settings)[0]


def _train(docs: DataFrame, labels: DataFrame, *, fit_rows: int = FIT_ROWS, pool_rows: int | None = None,
           rounds: int = ROUNDS, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
           source_col: str = "source", length_col: str = "n_chars") -> tuple[CoTrained | None, DataFrame | None]:
    """The model and the digests of all documents.  Co-training takes all unlabelled
    documents, or if a caller names ``pool_rows`` so many of them."""
    rows = _sample(docs, labels, fit_rows, id_col, text_col, lang_col, source_col, length_col)
    rows.sort(key=lambda r: (zlib.crc32(str(r["id"]).encode()), r["id"]))
    held, own = rows[::3], [r for i, r in enumerate(rows) if i % 3]
    y_own, y_held = (np.array([r["y"] for r in part], dtype=np.int64) for part in (own, held))
    if min(y_own.sum(), (1 - y_own).sum()) < MIN_CLASS or min(y_held.sum(), (1 - y_held).sum()) < MIN_CLASS // 3:
        return None, None
    features = lambda r: np.frombuffer(bytes(r["d"]["w"]), dtype=np.uint32)
    model = CoTrained(_telling([features(r) for r in own], y_own, TELLING_WORDS))
    table = digests(docs, labels, [r["id"] for r in rows], model.telling, id_col=id_col, text_col=text_col,
                    lang_col=lang_col, source_col=source_col, length_col=length_col)

    def text_of(part) -> np.ndarray:
        return np.array([_text_row(features(r), r["d"]["s"], model.telling) for r in part]) \
            .reshape(len(part), SHAPES + len(model.telling))

    def meta_of(part) -> np.ndarray:
        return np.array([meta_row(r["l"], r["src"], r["n"]) for r in part]).reshape(len(part), 83)

    views = [(text_of(own), text_of(held)), (meta_of(own), meta_of(held))]
    pool = table.filter("q is null")
    if pool_rows is not None:
        some = pool.filter("id is not null").select("id").distinct().orderBy(F.xxhash64("id", F.lit("fit")), "id")
        pool = pool.join(F.broadcast(some.limit(pool_rows)), "id", "left_semi")
    fitted = [Ridge.fit(x, y_own) for x, _ in views]
    turns: list[Round] = []
    for _ in range(rounds):
        at_held = [_sigmoid(f.logit(h)) for f, (_, h) in zip(fitted, views)]
        turns.append(Round(list(fitted), [(_sure(p, y_held, True), _sure(p, y_held, False)) for p in at_held]))
        fitted, traded = refit(pool, model.telling, fitted, turns, [x for x, _ in views], y_own)
        model.traded.append(traded)
    model.text, model.meta = fitted
    a, b = (f.logit(v[1])[:, None] for f, v in zip(fitted, views))
    model.calibrated_text, model.calibrated_meta = Ridge.fit(a, y_held), Ridge.fit(b, y_held)
    model.combined = Ridge.fit(np.hstack([a, b]), y_held)
    score = _sigmoid(model.combined.logit(np.hstack([a, b]))).tolist()
    model.cutoff = learn_cutoff(model, table, [(s, r["q"], r["x"]) for s, r in zip(score, held)])
    return model, table


def scored(docs: DataFrame, model: CoTrained | None, name: str, *, text_col: str = "text", lang_col: str = "lang",
           source_col: str = "source", length_col: str = "n_chars") -> DataFrame:
    """``docs`` with a struct ``name``: text_score, meta_score, score, keep."""
    kind = "text_score double, meta_score double, score double, keep boolean"
    if model is None:
        return docs.withColumn(name, F.lit(None).cast("double").alias("x")).withColumn(name, F.struct(
            F.col(name).alias("text_score"), F.col(name).alias("meta_score"), F.col(name).alias("score"),
            F.lit(True).alias("keep")))

    @F.pandas_udf(kind)
    def of(texts, langs, sources, lengths):
        import pandas as pd
        release()
        blank = lambda s: [None if pd.isna(v) else v for v in s]
        parts = []
        for at in range(0, len(texts), 256):
            some = slice(at, at + 256)
            parts.append(np.array(model.score(blank(texts[some]), blank(langs[some]), blank(sources[some]),
                                              blank(lengths[some]))))
        t, m, s = np.hstack(parts) if parts else np.zeros((3, 0))
        return pd.DataFrame({"text_score": t, "meta_score": m, "score": s, "keep": s >= model.cutoff})

    return docs.withColumn(name, of(F.col(text_col), F.col(lang_col).cast("string"),
                                    F.col(source_col).cast("string"), F.col(length_col).cast("double")))


def quality_scores(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", **settings) -> DataFrame:
    """One row per document: id, text_score, meta_score, score, keep."""
    model, table = _train(docs, labels, id_col=id_col, **settings)
    if model is None:
        name = free_name(docs, "_scored")
        return scored(docs, None, name).select(id_col, f"{name}.*")

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                t, m, s = model.score_views(*views_of(part, model.telling))
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(t), pa.array(m), pa.array(s),
                                                  pa.array(s >= model.cutoff)],
                                                 [id_col, "text_score", "meta_score", "score", "keep"])

    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType)]) \
        .add("text_score", "double").add("meta_score", "double").add("score", "double").add("keep", "boolean")
    return table.mapInArrow(of, schema)


def filter_documents(docs: DataFrame, labels: DataFrame, **settings) -> DataFrame:
    """The documents that the classifier keeps, with their own columns."""
    model = train(docs, labels, **settings)
    columns = {k: v for k, v in settings.items() if k.endswith("_col") and k != "id_col"}
    name = free_name(docs, "_scored")
    return scored(docs, model, name, **columns).filter(F.col(name)["keep"]).drop(name)
