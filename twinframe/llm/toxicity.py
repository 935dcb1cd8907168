"""Toxicity grades by cumulative-link (proportional odds) ordinal regression over sparse hashed words.

One weight vector w is shared by all ordered thresholds t_1 <= t_2 <= ...: P(grade <= k) = sigmoid(t_k - w.x). x marks which words of the
whole text (lower-cased A-Z, runs of non-space bytes without ASCII punctuation) and which beginnings of STEM bytes of longer words there are, hashed into
2 ** BITS places. Only places that tell grades apart in the sample (by the likelihood ratio of their presence with any grade above 0, in LEAST texts at
least) have a weight. The score is the expected grade, sum over k of P(grade >= k).

The model is fitted on at most `sample_rows` labelled documents (by the hash of their id, so the same ones at every partitioning); scoring
covers all documents and needs only the weights, an array of fixed size. Nothing is shuffled but the sample.

Grades come from `labels`: 0 not toxic, 1 toxic, 2 toxic and of low quality. Nulls in a label's id or flags drop the label; of repeated
labels the highest grade counts. Without labels, or with one grade only, no text is rejected. A null or empty text scores grade 0.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinframe.llm.common import lower_ascii, map_slices, mix, run_hashes, runs, text_bytes

BITS = 18
SAMPLE_ROWS = 8000
GRADES = 3
STEM = 5
#: Sample texts that a place must occur in, places that have weights at most, and their least likelihood ratio.
LEAST, PLACES, RATIO = 5, 2048, 6.6
REJECT_AT = 0.5
_IS_TERM = np.ones(256, bool)
_IS_TERM[: 0x30] = _IS_TERM[0x3A:0x41] = _IS_TERM[0x5B:0x61] = _IS_TERM[0x7B:0x80] = False


@dataclass
class Model:
    weights: np.ndarray
    thresholds: np.ndarray

    def at_least(self, z: np.ndarray) -> np.ndarray:
        """P(grade >= k) for each row and k = 1 .. GRADES - 1."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - z[:, None], -500, 500)))


def features(rows: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and places of the features of a batch, sorted, each once."""
    data, offsets = text_bytes(rows.column(rows.schema.get_field_index("text")))
    data = lower_ascii(data)
    starts, ends = runs(_IS_TERM[data], offsets)
    row = np.searchsorted(offsets, starts, side="right") - 1
    stem = np.flatnonzero(ends - starts > STEM)
    words, stems = run_hashes(data, starts, ends), mix(run_hashes(data, starts[stem], starts[stem] + STEM), 7)
    place = (np.concatenate([words, stems]) >> np.uint64(64 - BITS)).astype(np.int64)
    key = np.unique(np.concatenate([row, row[stem]]) << BITS | place)
    return key >> BITS, key & ((1 << BITS) - 1)


def telling(row: np.ndarray, place: np.ndarray, grade: np.ndarray) -> np.ndarray:
    """The places that tell grade 0 from the others, as a mask."""
    bad = grade > 0
    n1, n0 = int(bad.sum()), int((~bad).sum())
    a, b = (np.bincount(place, x[row], 1 << BITS) for x in (bad, ~bad))
    t, n = a + b, max(1, n1 + n0)
    part = lambda x, e: np.where(x > 0, x * np.log(np.maximum(x, 1) / np.maximum(e, 1e-12)), 0)
    ratio = 2 * (part(a, t * n1 / n) + part(b, t * n0 / n) + part(n1 - a, (n - t) * n1 / n) + part(n0 - b, (n - t) * n0 / n))
    ratio[t < min(LEAST, n1)] = 0
    keep = np.zeros(1 << BITS, bool)
    keep[np.argsort(-ratio, kind="stable")[:PLACES]] = True
    return keep & (ratio >= RATIO)


def fit(row: np.ndarray, place: np.ndarray, value: np.ndarray, grade: np.ndarray, grades: int = GRADES, steps: int = 150, rate: float = 0.1, ridge: float = 1e-4) -> Model:
    """Full-batch Adam on the penalised likelihood of P(y) = P(<= y) - P(<= y - 1); deterministic."""
    n = len(grade)
    model = Model(np.zeros(1 << BITS), np.full(grades - 1, 30.0))
    if n == 0 or len(np.unique(grade)) < 2:
        return model
    used, place = np.unique(place, return_inverse=True)
    below = np.array([(grade <= k).mean() for k in range(grades - 1)])
    below = np.clip(below, 1 / (n + 2), 1 - 1 / (n + 2))
    first = np.log(below / (1 - below))
    # thresholds: the first one, then logs of the gaps, so that they stay ordered
    p = np.concatenate([np.zeros(len(used)), first[:1], np.log(np.maximum(np.diff(first), 1e-3))])
    m, v, size = np.zeros_like(p), np.zeros_like(p), len(used)
    for t in range(1, steps + 1):
        w, gaps = p[:size], np.exp(p[size + 1 :])
        theta = p[size] + np.concatenate([[0.0], np.cumsum(gaps)])
        z = np.bincount(row, value * w[place], n)
        upper = np.where(grade < grades - 1, theta[np.minimum(grade, grades - 2)] - z, np.inf)
        lower = np.where(grade > 0, theta[np.maximum(grade - 1, 0)] - z, -np.inf)
        su, sl = 1 / (1 + np.exp(-np.clip(upper, -500, 500))), 1 / (1 + np.exp(-np.clip(lower, -500, 500)))
        su, sl = np.where(np.isinf(upper), 1.0, su), np.where(np.isinf(lower), 0.0, sl)
        prob = np.maximum(su - sl, 1e-12)
        du, dl = su * (1 - su) / prob, sl * (1 - sl) / prob  # d log P / d upper, - d log P / d lower
        g = np.zeros_like(p)
        g[:size] = np.bincount(place, value * (du - dl)[row], size) / n + ridge * w
        by = np.zeros(grades - 1)
        np.add.at(by, np.minimum(grade, grades - 2)[grade < grades - 1], -du[grade < grades - 1] / n)
        np.add.at(by, (grade - 1)[grade > 0], dl[grade > 0] / n)
        g[size] = by.sum()
        g[size + 1 :] = np.cumsum(by[::-1])[::-1][1:] * gaps
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        p -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    model.weights[used] = p[:size]
    model.thresholds = p[size] + np.concatenate([[0.0], np.cumsum(np.exp(p[size + 1 :]))])
    return model


def grade_of() -> Column:
    return F.when(F.col("toxic") == 1, F.when(F.col("quality") == 0, 2).otherwise(1)).otherwise(0)


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Fits on at most `sample_rows` labelled rows of docs."""
    own = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy(F.col("doc_id").alias("_id")).agg(F.max(grade_of()).alias("grade"))
    own = own.orderBy(F.xxhash64("_id"), "_id").limit(sample_rows)
    sample = docs.select("doc_id", "text").join(F.broadcast(own), F.col("doc_id") == F.col("_id")).select("doc_id", "text", F.col("grade").cast("long").alias("grade"))

    def step(rows: pa.RecordBatch) -> pa.RecordBatch:
        row, place = features(rows)
        cut = np.searchsorted(row, np.arange(rows.num_rows + 1))
        packed = [place[a:b].astype("<i4").tobytes() for a, b in zip(cut[:-1], cut[1:], strict=True)]
        return pa.record_batch([rows.column(0), rows.column(2), pa.array(packed, pa.binary())], ["doc_id", "grade", "place"])

    got = map_slices(sample, ["doc_id", "text", "grade"], step, "doc_id long, grade long, place binary").toArrow().sort_by("doc_id")
    each = [np.frombuffer(x, "<i4") for x in got["place"].to_pylist()]
    row = np.repeat(np.arange(len(each)), [len(x) for x in each]) if each else np.zeros(0, np.int64)
    place, grade = np.concatenate([np.zeros(0, np.int64), *each]).astype(np.int64), np.array(got["grade"].to_pylist(), np.int64)
    keep = telling(row, place, grade)[place]
    return fit(row[keep], place[keep], np.ones(int(keep.sum())), grade)


def score(docs: DataFrame, model: Model, keep: list[str] | None = None, reject_at: float = REJECT_AT) -> DataFrame:
    """The columns in `keep` (doc_id by default), then expected_severity, grade (the likeliest), p_toxic = P(grade >= 1) and rejected (p_toxic >= reject_at)."""
    keep = keep or ["doc_id"]
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = [*keep, *(["text"] if "text" not in keep else [])]

    def step(rows: pa.RecordBatch) -> pa.RecordBatch:
        model = shared.value
        row, place = features(rows)
        z = np.bincount(row, model.weights[place], rows.num_rows)
        p = model.at_least(z)
        p[np.bincount(row, minlength=rows.num_rows) == 0] = 0
        each = np.diff(np.concatenate([np.zeros((len(p), 1)), 1 - p, np.ones((len(p), 1))], axis=1), axis=1)
        return pa.record_batch(
            [*(rows.column(names.index(c)) for c in keep), pa.array(p.sum(axis=1)), pa.array(each.argmax(axis=1).astype(np.int64)), pa.array(p[:, 0]), pa.array(p[:, 0] >= reject_at)],
            [*keep, "expected_severity", "grade", "p_toxic", "rejected"],
        )

    fields = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    return map_slices(docs, names, step, f"{fields}, expected_severity double, grade long, p_toxic double, rejected boolean")


def keep_clean(docs: DataFrame, model: Model, reject_at: float = REJECT_AT) -> DataFrame:
    """docs (same columns) without the rejected rows."""
    shared, columns = docs.sparkSession.sparkContext.broadcast(model), docs.columns

    def step(rows: pa.RecordBatch) -> pa.RecordBatch:
        model = shared.value
        row, place = features(rows)
        z = np.bincount(row, model.weights[place], rows.num_rows)
        bad = (model.at_least(z)[:, 0] >= reject_at) & (np.bincount(row, minlength=rows.num_rows) > 0)
        return rows.filter(pa.array(~bad))

    return map_slices(docs, columns, step, docs.schema)
