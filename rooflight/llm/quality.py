"""A quality classifier: Naive Bayes features under a linear support vector machine.

Features are indicators of hashed n-grams over the whole text: of its bytes (lengths 1 to 3), of the
shapes of its words, and of whether words repeat the word before. They are scaled by the log-count ratio of the two classes, made unit length, and given
to a linear hinge-loss model that dual coordinate descent fits; the weights are then pulled towards
their mean (so that the scaled features alone, Naive Bayes, keep a say). A logistic curve fitted on
rows that the model did not see turns margins into scores.

The model is fitted on a bounded sample, ``MAX_FIT_ROWS`` labelled rows (of ``MAX_FIT_FEATURES``
features together) that come first in a seeded order of ids; every text is scored. Labels other than 0 and 1 are left out; ids labelled more than
once take the majority, 1 on a tie.

Edge cases: a null or empty text has no features and gets the score of the bias; with no label, or
labels of one class only, every score is the share of 1 (0.5 without labels); repeated rows are
scored each; a null id counts as empty text in the fold; texts of any length are read whole, in pieces
that share their borders; extra columns, of any name, are ignored (kept by ``keep_good``); an empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructType

from rooflight.llm.shared import as_row, held_out, written

#: The sample that the model is fitted on: rows, and the sum of their features (four bytes each on the driver).
MAX_FIT_ROWS = 12_000
MAX_FIT_FEATURES = 24_000_000
BUCKETS = 1 << 17
THRESHOLD = 0.3
SMOOTH, PENALTY, ROUNDS, BLEND = 1.0, 1.0, 30, 0.75
_PIECE = 1 << 20
_SHAPES = bytes(
    1 if 48 <= b <= 57 else 2 if 65 <= b <= 90 else 3 if 97 <= b <= 122 or b >= 128 else 0 if b in b" \t\n\x0b\x0c\r" else b for b in range(256)
)


def _runs(x: np.ndarray) -> np.ndarray:
    """Bytes without those that repeat the one before."""
    return x[np.r_[True, x[1:] != x[:-1]]] if len(x) else x


def _grams(x: np.ndarray, salt: int, longest: int) -> list[np.ndarray]:
    x = x.astype(np.uint64)
    out = []
    for n in range(1, longest + 1):
        if len(x) < n:
            break
        code = np.zeros(len(x) - n + 1, np.uint64)
        for i in range(n):
            code = code * np.uint64(257) + x[i : len(x) - n + 1 + i] + np.uint64(1)
        with np.errstate(over="ignore"):
            code = (code + np.uint64(salt * 4 + n) * np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xD6E8FEB86659FD93)
        out.append((code >> np.uint64(32)) % np.uint64(BUCKETS))
    return out


def features(text: str | None) -> np.ndarray:
    """Sorted ids of the features the whole text has."""
    data = (text or "").encode("utf-8", "surrogatepass")
    if not data:
        return np.empty(0, np.int32)
    flags = np.zeros(BUCKETS, bool)
    before = np.empty(0, np.uint8)  # the last three runs of shapes: a run may be of any length
    for a in range(0, len(data), _PIECE):
        raw = np.frombuffer(data[a : a + _PIECE + 2], np.uint8)
        shape = _runs(np.concatenate([before, np.frombuffer(data[a : a + _PIECE].translate(_SHAPES), np.uint8)]))
        before = shape[-3:]
        for ids in _grams(raw, 1, 3) + _grams(shape, 2, 4):
            flags[ids.astype(np.int64)] = True
    words = data.split()
    again = np.fromiter((a == b for a, b in zip(words, words[1:], strict=False)), np.uint8, max(0, len(words) - 1))
    for ids in _grams(again, 3, 4):
        flags[ids.astype(np.int64)] = True
    return np.flatnonzero(flags).astype(np.int32)


class Model:
    """ratio and weight by feature, bias, and the logistic curve (slope, shift)."""

    def __init__(self, ratio, weight, bias, slope, shift):
        self.ratio, self.weight, self.bias, self.slope, self.shift = ratio, weight, bias, slope, shift

    def margin(self, ids: np.ndarray) -> float:
        r = self.ratio[ids]
        length = np.sqrt(r @ r)
        return float(r @ self.weight[ids] / length + self.bias) if length > 0 else self.bias

    def score(self, margin: float) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -30, 30))))


def _apart(flat: np.ndarray, sizes: np.ndarray) -> list[np.ndarray]:
    """Rows as views of one array: many small arrays would stay with the process after their use."""
    ends = np.cumsum(sizes).tolist()
    return [flat[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]


def _log_count_ratio(rows: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    count = [np.bincount(np.concatenate([r for r, k in zip(rows, y, strict=True) if k == c] or [np.empty(0, np.int32)]), minlength=BUCKETS) + SMOOTH for c in (1, 0)]
    return np.log(count[0] / count[0].sum()) - np.log(count[1] / count[1].sum())


def _descend(rows: list[np.ndarray], values: list[np.ndarray], y: np.ndarray) -> tuple[np.ndarray, float]:
    """Dual coordinate descent for the L1 hinge loss; the bias is one more feature. Classes weigh alike."""
    sign = np.where(y == 1, 1.0, -1.0)
    cost = np.where(y == 1, PENALTY * len(y) / (2 * max(1, (y == 1).sum())), PENALTY * len(y) / (2 * max(1, (y == 0).sum())))
    weight, bias, alpha = np.zeros(BUCKETS), 0.0, np.zeros(len(y))
    square = np.array([v @ v + 1 for v in values])
    order = np.random.Generator(np.random.PCG64(1))
    for _ in range(ROUNDS):
        moved = 0.0
        for i in order.permutation(len(y)):
            slope = sign[i] * (values[i] @ weight[rows[i]] + bias) - 1
            new = min(max(alpha[i] - slope / square[i], 0.0), cost[i])
            if new != alpha[i]:
                step = (new - alpha[i]) * sign[i]
                weight[rows[i]] += step * values[i]
                bias += step
                moved = max(moved, abs(new - alpha[i]))
                alpha[i] = new
        if moved < 1e-3:
            break
    return weight, bias


def _curve(margins: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve, by Newton steps with a slight penalty."""
    x, w = np.stack([margins, np.ones_like(margins)], axis=1), np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - y) + 1e-3 * w
        hess = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        w = w - np.clip(np.linalg.solve(hess, grad), -5, 5)
    return float(max(w[0], 1e-3)), float(w[1])


def fit(rows: list[np.ndarray], y: np.ndarray) -> Model:
    zero = np.zeros(BUCKETS)
    if len(set(y.tolist())) < 2:
        share = float(y.mean()) if len(y) else 0.5
        return Model(zero, zero, 0.0, 1.0, float(np.log((share + 1e-6) / (1 - share + 1e-6))))
    aside = np.arange(len(y)) % 4 == 0
    if len(set(y[aside].tolist())) < 2 or len(set(y[~aside].tolist())) < 2:
        aside[:] = False
    kept = np.flatnonzero(~aside)
    ratio = _log_count_ratio([rows[i] for i in kept], y[kept])

    sizes = np.array([len(rows[i]) for i in kept])
    values = _apart(np.empty(sizes.sum(), np.float32), sizes)
    for i, v in zip(kept, values, strict=True):
        x = ratio[rows[i]]
        v[:] = x / (np.sqrt(x @ x) or 1)
    weight, bias = _descend([rows[i] for i in kept], values, y[kept])
    weight = (1 - BLEND) * np.abs(weight).mean() + BLEND * weight
    model = Model(ratio, weight, bias, 1.0, 0.0)
    seen = np.flatnonzero(aside) if aside.any() else kept
    model.slope, model.shift = _curve(np.array([model.margin(rows[i]) for i in seen]), y[seen].astype(float))
    return model


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_FIT_ROWS) -> Model:
    """Fit on at most ``max_rows`` labelled documents. labels: doc_id, quality."""
    wanted = (
        labels.where("quality in (0, 1) and doc_id is not null")
        .where(~held_out(5, 0))
        .groupBy(F.col("doc_id").alias("label_id"))
        .agg((F.avg("quality") >= 0.5).cast("int").alias("label"))
        .orderBy(F.xxhash64("label_id"), "label_id")
        .limit(max_rows)
    )

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [features(t).tobytes() for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["label"], pa.array(ids, pa.binary())], ["doc_id", "label", "ids"])

    joined = docs.select("doc_id", "text").join(F.broadcast(wanted), F.col("doc_id") == F.col("label_id")).select(F.col("doc_id").cast("long").alias("doc_id"), "label", "text")
    seen = written(joined.mapInArrow(extract, "doc_id long, label int, ids binary").withColumn("n", F.length("ids") / 4).withColumn("h", F.xxhash64("ids")), "fit-rows")
    order = [F.xxhash64("doc_id"), F.col("doc_id"), F.col("h")]
    sizes = seen.select("doc_id", "h", "n").orderBy(*order).limit(max_rows).toArrow()["n"].to_numpy()  # ids may repeat in docs
    held = int(np.searchsorted(np.cumsum(sizes), MAX_FIT_FEATURES, side="right"))
    table = seen.orderBy(*order).limit(max(1, held)).select("label", "ids").toArrow()  # one copy of the features
    mixed = np.random.Generator(np.random.PCG64(2)).permutation(table.num_rows)
    found = [np.frombuffer(table["ids"][i].as_buffer(), np.int32) for i in mixed.tolist()]
    label = table["label"].to_numpy()[mixed].astype(np.int64)
    if found:
        found = _apart(np.concatenate(found), np.array([len(r) for r in found]))
    del table
    model = fit(found, label)
    del found
    pa.default_memory_pool().release_unused()
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(row, quality_score): the columns of ``docs`` as a struct, and the score of its text."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(as_row(docs))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = sent.value
            scores = [m.score(m.margin(features(t.as_py()))) for t in batch.column(0).field("text")]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], schema=batch.schema.append(pa.field("quality_score", pa.float64())))

    return rows.mapInArrow(each, StructType([*rows.schema.fields]).add("quality_score", DoubleType()))


def rate(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    scored = score(docs.select("doc_id", "text"), train(docs, labels))
    s = F.col("quality_score")
    return scored.select("row.doc_id", held_out(5, 0, "row.doc_id").alias("held_out"), s.alias("score"), (s >= THRESHOLD).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the classifier does not reject; columns unchanged."""
    return score(docs, train(docs, labels)).where(F.col("quality_score") >= THRESHOLD).select("row.*")
