"""Quality classifier: a generalised additive model with pairwise interactions.

Measurements of a text are cut into quantile bins.  Cyclic boosting visits the features in
turn, fits a shallow tree to the current gradient over that feature's bins, and adds it,
shrunk, to the feature's lookup table; then the pairs of features that explain most of what is
left get tables in the same way.  A score is the sigmoid of one table entry per feature and
pair: vectorised lookups and additions, in one pass over the texts.

Training sees a bounded sample (`max_train` labelled rows, lowest hash first); its tables
hold at most bins**2 numbers per pair.  Everything else is per row.

Defined cases: null or empty texts have all measurements 0 and get the score of those bins; labels
that are null, or of unknown documents, are ignored; a document with several labels is sampled with
each; with no label, or only one kind, the score is that of the mean label (0.5 without any);
repeated rows get equal scores; empty tables give empty results; other columns are ignored.
"""

import math
from collections.abc import Iterator
from dataclasses import dataclass, field
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import in_slices

FEATURES = (
    "log_words", "word_length", "lower", "upper", "digits", "symbols", "pipes", "exclaims", "stops",
    "commas", "lines_per_word", "wide", "repeats", "distinct", "top_word", "symbol_words",
)
MAX_TRAIN = 20_000
THRESHOLD = 0.3

_SYMBOLS = np.frombuffer(b"#*$%&<>@^~=+\\{}[]", np.uint8)


def features(text: str) -> list[float]:
    """The measurements of a whole text, in the order of FEATURES."""
    data = text.encode()
    words = data.split()
    n, size = len(words), len(data)
    if not n:
        return [0.0] * len(FEATURES)
    count = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    solid = size - count[9:14].sum() - count[32]
    distinct: dict[bytes, int] = {}
    for word in words:
        distinct[word] = distinct.get(word, 0) + 1
    symbols = int(count[_SYMBOLS].sum())
    return [
        math.log(n),
        solid / n,
        count[97:123].sum() / solid,
        count[65:91].sum() / solid,
        count[48:58].sum() / solid,
        symbols / solid,
        count[124] / n,
        count[33] / n,
        count[46] / n,
        count[44] / n,
        count[10] / n,
        count[128:].sum() / solid,
        sum(map(eq, words, words[1:])) / n,
        len(distinct) / n,
        max(distinct.values()) / n,
        symbols / n,
    ]


@dataclass
class Model:
    """Cut points per feature, one table per feature, one per chosen pair."""

    cuts: list[np.ndarray]
    intercept: float = 0.0
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack(
            [np.searchsorted(c, x[:, f], side="right") for f, c in enumerate(self.cuts)], axis=1
        )

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probabilities of label 1."""
        b = self.bins(x)
        total = np.full(len(x), self.intercept)
        for f, table in enumerate(self.tables):
            total += table[b[:, f]]
        for (f, g), table in zip(self.pairs, self.pair_tables, strict=True):
            total += table[b[:, f], b[:, g]]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _leaf(gradient, hessian, ridge: float = 1.0):
    return gradient / (hessian + ridge)


def _tree(gradient: np.ndarray, hessian: np.ndarray, depth: int) -> np.ndarray:
    """The values per bin of a tree of `depth` over ordered bins, by best split."""
    value = np.full(len(gradient), _leaf(gradient.sum(), hessian.sum()))
    if depth == 0 or len(gradient) < 2:
        return value
    gl, hl = np.cumsum(gradient)[:-1], np.cumsum(hessian)[:-1]
    gr, hr = gradient.sum() - gl, hessian.sum() - hl
    gain = gl * _leaf(gl, hl) + gr * _leaf(gr, hr)
    gain[(hl < 1e-3) | (hr < 1e-3)] = -np.inf
    cut = int(np.argmax(gain)) + 1
    if not np.isfinite(gain[cut - 1]):
        return value
    return np.concatenate(
        [_tree(gradient[:cut], hessian[:cut], depth - 1), _tree(gradient[cut:], hessian[cut:], depth - 1)]
    )


def _pair_tree(gradient: np.ndarray, hessian: np.ndarray) -> tuple[np.ndarray, float]:
    """The best cross of one cut in either direction: its values, and what it gains."""
    def corner(a):
        return np.cumsum(np.cumsum(a, axis=0), axis=1)[:-1, :-1]

    g, h = corner(gradient), corner(hessian)
    rows = [np.cumsum(a.sum(axis=1))[:-1, None] for a in (gradient, hessian)]
    cols = [np.cumsum(a.sum(axis=0))[None, :-1] for a in (gradient, hessian)]
    total = gradient.sum(), hessian.sum()
    quarters = [
        (g, h),
        (rows[0] - g, rows[1] - h),
        (cols[0] - g, cols[1] - h),
        (total[0] - rows[0] - cols[0] + g, total[1] - rows[1] - cols[1] + h),
    ]
    gain = sum(a * _leaf(a, b) for a, b in quarters)
    i, j = np.unravel_index(int(np.argmax(gain)), gain.shape)
    values = [float(_leaf(a[i, j], b[i, j])) for a, b in quarters]
    table = np.empty_like(gradient)
    table[: i + 1, : j + 1], table[: i + 1, j + 1 :] = values[0], values[1]
    table[i + 1 :, : j + 1], table[i + 1 :, j + 1 :] = values[2], values[3]
    return table, float(gain[i, j])


def fit(
    x: np.ndarray, y: np.ndarray, bins: int = 32, rounds: int = 120, n_pairs: int = 6, pair_rounds: int = 40,
    rate: float = 0.15, depth: int = 2,
) -> Model:
    """Cyclic boosting of the features' tables, then of the best pairs'."""
    quantiles = np.linspace(0, 1, bins + 1)[1:-1]
    model = Model([np.unique(np.quantile(x[:, f], quantiles)) if len(x) else np.empty(0) for f in range(x.shape[1])])
    sizes = [len(c) + 1 for c in model.cuts]
    model.tables = [np.zeros(s) for s in sizes]
    share = (y.sum() + 0.5) / (len(y) + 1)
    model.intercept = float(np.log(share / (1 - share)))
    if len(np.unique(y)) < 2:
        return model
    b = model.bins(x)
    total = np.full(len(y), model.intercept)

    def slopes():
        p = 1 / (1 + np.exp(-total))
        return y - p, np.maximum(p * (1 - p), 1e-6)

    for _ in range(rounds):
        for f, size in enumerate(sizes):
            gradient, hessian = slopes()
            step = rate * _tree(
                np.bincount(b[:, f], gradient, size), np.bincount(b[:, f], hessian, size), depth
            )
            model.tables[f] += step
            total += step[b[:, f]]

    def of_pair(f, g):
        gradient, hessian = slopes()
        cell, shape = b[:, f] * sizes[g] + b[:, g], (sizes[f], sizes[g])
        return _pair_tree(*(np.bincount(cell, a, shape[0] * shape[1]).reshape(shape) for a in (gradient, hessian)))

    wide = [f for f, size in enumerate(sizes) if size > 1]
    gains = {(f, g): of_pair(f, g)[1] for i, f in enumerate(wide) for g in wide[i + 1 :]}
    model.pairs = sorted(gains, key=lambda p: (-gains[p], p))[:n_pairs]
    model.pair_tables = [np.zeros((sizes[f], sizes[g])) for f, g in model.pairs]
    for _ in range(pair_rounds):
        for k, (f, g) in enumerate(model.pairs):
            step = rate * of_pair(f, g)[0]
            model.pair_tables[k] += step
            total += step[b[:, f], b[:, g]]
    return model


def held_out(doc_id: Column) -> Column:
    """Documents that training never sees: crc32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in in_slices(batches):
        x = np.array([features(t.as_py() or "") for t in batch.column("text")])
        yield batch, x.reshape(batch.num_rows, len(FEATURES))


def train(
    docs: DataFrame,
    labels: DataFrame,
    max_train: int = MAX_TRAIN,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
) -> Model:
    """A model from at most `max_train` labelled rows outside the held-out fold.

    The sample of labels is bounded, so it is sent to the documents; a document that repeats often
    is cut to the same bound again, after its measurements.
    """
    usable = labels.select(
        labels[id_col].cast("long").alias("id"), labels[label_col].cast("double").alias("label")
    ).where("id IS NOT NULL AND label IS NOT NULL")
    sample = (
        usable.where(~held_out(F.col("id"))).orderBy(F.xxhash64("id"), "id", "label").limit(max_train)
    )
    texts = docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].cast("string").alias("text"))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, x in _measured(batches):
            column = pa.array(list(x), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), column], ["id", "label", "x"])

    measured = texts.join(F.broadcast(sample), "id").mapInArrow(measure, "id long, label double, x array<double>")
    rows = measured.orderBy(F.xxhash64("id"), "id", "label").limit(max_train).toPandas()
    x = np.array(rows["x"].tolist(), float).reshape(len(rows), len(FEATURES))
    return fit(x, (rows["label"].to_numpy() > 0.5).astype(float))


def score(
    docs: DataFrame, model: Model, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row of `docs`: doc_id, held_out, score, predicted."""

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, x in _measured(batches):
            s = model.scores(x)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(s), pa.array((s >= threshold).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"],
            )

    rows = docs.select(
        docs[id_col].cast("long").alias("doc_id"),
        held_out(docs[id_col]).alias("held_out"),
        docs[text_col].cast("string").alias("text"),
    )
    return rows.mapInArrow(scored, "doc_id long, held_out boolean, score double, predicted int")


def accepted(
    docs: DataFrame, model: Model, threshold: float = THRESHOLD, text_col: str = "text"
) -> DataFrame:
    """The rows of `docs`, with all their columns, that the model does not reject."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, text_col):
            x = np.array([features(t.as_py() or "") for t in batch.column(text_col)])
            good = model.scores(x.reshape(batch.num_rows, len(FEATURES))) >= threshold
            yield batch.filter(pa.array(good))

    return docs.mapInArrow(keep, docs.schema)
