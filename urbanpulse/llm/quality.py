"""Quality classifier by positive-unlabelled learning.

A linear model over character-class statistics is fitted by minimising the
non-negative unbiased risk

    prior * R_p(+) + max(0, R_u(-) - prior * R_p(-))

with the logistic loss: trusted positives (label 1) against unlabelled web text,
where a mini-batch whose second term falls below zero is stepped back instead.
The class prior is the share of label 1 among the labelled training rows.  The
margin is mapped to a probability by Platt scaling on those rows.

Bound of the fit: ``max_rows`` trusted positives, ``max_rows`` unlabelled and
``max_rows`` labelled rows for scaling, each the first by a hash of the id, so a
hot source has its share.  Of rows that share an id, the text with the least hash
counts.  Their feature vectors (not their texts) reach the driver.
Scores cover every whole text.

Labels, language, source and ids are no features.  Nulls and empty texts: the
score of a text without characters.  Repeated rows score alike.  Labels: rows
without id or label are ignored, repeated rows of an id are averaged.  Without any
usable positive label the score is the prior (0.5 if unknown).  An empty table
gives an empty result.  Extra columns are left alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from .common import seal, text_hash, texts, whole_text

MAX_ROWS = 8_000
THRESHOLD = 0.7
_CHUNK = 1 << 18
_ROWS = 512  # texts whose features are held at once


def _byte_classes() -> np.ndarray:
    kind = np.zeros(256, dtype=np.int64)  # other control characters
    groups = (b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t",
              b"\n\r", b".", b",", b"!?", b"|", b"#$%&*~^", b"@_/\\", b"'\"`", b":;-=+", b"()[]{}<>")
    for k, members in enumerate(groups, 1):
        kind[list(members)] = k
    kind[128:] = len(groups) + 1
    return kind


CLASSES = 16
_KIND = _byte_classes()
WIDTH = CLASSES * CLASSES + CLASSES + 8


def _pairs(parts: list[bytes]) -> np.ndarray:
    """Counts of neighbouring byte classes (newline between texts is not counted)."""
    sizes = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts))
    out = np.zeros(len(parts) * CLASSES * CLASSES, dtype=np.int64)
    kind = _KIND[np.frombuffer(b"".join(parts), dtype=np.uint8)]
    if len(kind) > 1:
        owner = np.repeat(np.arange(len(parts)), sizes)
        inside = owner[1:] == owner[:-1]
        key = owner[1:] * (CLASSES * CLASSES) + kind[:-1] * CLASSES + kind[1:]
        out += np.bincount(key[inside], minlength=len(out))
    return out.reshape(len(parts), -1)


def _pair_counts(parts: list[bytes]) -> np.ndarray:
    """As ``_pairs``, in pieces of bounded size."""
    out = np.zeros((len(parts), CLASSES * CLASSES), dtype=np.int64)
    at = 0
    while at < len(parts):
        if len(parts[at]) > _CHUNK:
            for start in range(0, len(parts[at]), _CHUNK):
                out[at] += _pairs([parts[at][start:start + _CHUNK + 1]])[0]
            at += 1
            continue
        to, size = at, 0
        while to < len(parts) and (size := size + len(parts[to])) <= _CHUNK:
            to += 1
        out[at:to] = _pairs(parts[at:to])
        at = to
    return out


def _shape(text: bytes) -> tuple[float, ...]:
    """Length, word and repetition statistics."""
    words = text.split()
    lines = text.split(b"\n")
    n = max(1, len(words))
    unique = len(set(words))
    lengths = np.fromiter(map(len, words), dtype=np.float64, count=len(words)) if words else np.zeros(1)
    return (np.log1p(len(text)), np.log1p(len(words)), unique / n, np.log1p(unique) - np.log1p(n),
            float(lengths.mean()) / 10, float(lengths.std()) / 10,
            len(set(lines)) / len(lines), len(lines) / n)


def features(parts: list[bytes]) -> np.ndarray:
    """One row of float32 features for each text."""
    if not parts:
        return np.zeros((0, WIDTH), dtype=np.float32)
    pairs = _pair_counts(parts)
    share = np.sqrt(pairs / np.maximum(1, pairs.sum(axis=1))[:, None])
    single = pairs.reshape(-1, CLASSES, CLASSES).sum(axis=2)
    share1 = np.sqrt(single / np.maximum(1, single.sum(axis=1))[:, None])
    shape = np.array([_shape(t) for t in parts])
    return np.concatenate([share, share1, shape], axis=1).astype(np.float32)


class Model:
    """A fitted linear model: probability of label 1 from features."""

    def __init__(self, mean, scale, weights, bias, slope=1.0, offset=0.0):
        self.mean, self.scale, self.weights, self.bias = mean, scale, weights, bias
        self.slope, self.offset = slope, offset

    def margin(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x.astype(np.float64) - self.mean) / self.scale, -10, 10)
        # rows one by one in a fixed order: equal texts score alike in any batch
        return np.einsum("ij,j->i", z, self.weights) + self.bias

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.margin(x) + self.offset, -40, 40)))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit_nnpu(positive: np.ndarray, unlabelled: np.ndarray, prior: float, epochs: int = 120,
             batch: int = 512, rate: float = 0.01, decay: float = 1e-4, seed: int = 7) -> Model:
    """Minimise the non-negative unbiased risk by Adam."""
    both = np.concatenate([positive, unlabelled]).astype(np.float64)
    mean, scale = both.mean(axis=0), np.maximum(both.std(axis=0), 1e-3)
    p = np.clip((positive - mean) / scale, -10, 10)
    u = np.clip((unlabelled - mean) / scale, -10, 10)
    rng = np.random.default_rng(seed)
    w = np.zeros(p.shape[1] + 1)
    w[-1] = np.log(prior / (1 - prior))
    first, second, step = np.zeros_like(w), np.zeros_like(w), 0
    turns = max(1, len(u) // batch)
    for epoch in range(epochs):
        up, uu = rng.permutation(len(p)), rng.permutation(len(u))
        for i in range(turns):
            xp = p[np.take(up, np.arange(i * batch, (i + 1) * batch), mode="wrap")]
            xu = u[np.take(uu, np.arange(i * batch, (i + 1) * batch), mode="wrap")]
            fp, fu = xp @ w[:-1] + w[-1], xu @ w[:-1] + w[-1]
            # risk of unlabelled text as negatives, less the positives among it
            negative = np.logaddexp(0, fu).mean() - prior * np.logaddexp(0, fp).mean()
            gu, gp = _sigmoid(fu) / len(fu), _sigmoid(fp) / len(fp)
            slope_n = np.r_[gu @ xu - prior * (gp @ xp), gu.sum() - prior * gp.sum()]
            if negative >= 0:
                gplus = -prior * _sigmoid(-fp) / len(fp)
                gradient = slope_n + np.r_[gplus @ xp, gplus.sum()]
            else:
                gradient = -slope_n
            gradient[:-1] += decay * w[:-1]
            step += 1
            first = 0.9 * first + 0.1 * gradient
            second = 0.999 * second + 0.001 * gradient**2
            now = rate * 0.5 * (1 + np.cos(np.pi * epoch / epochs))
            w -= now * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return Model(mean, scale, w[:-1], w[-1])


def platt(margin: np.ndarray, label: np.ndarray, turns: int = 50) -> tuple[float, float]:
    """Slope and offset of a probability over margins (Newton steps, smoothed targets)."""
    ones, zeros = label.sum(), len(label) - label.sum()
    target = np.where(label == 1, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    x = np.stack([margin, np.ones_like(margin)], axis=1)
    w = np.array([1.0, 0.0])
    for _ in range(turns):
        q = _sigmoid(x @ w)
        hessian = (x * (q * (1 - q))[:, None]).T @ x + 1e-6 * np.eye(2)
        move = np.linalg.solve(hessian, x.T @ (q - target))
        w -= np.clip(move, -2, 2)
        if np.abs(move).max() < 1e-8:
            break
    return (float(w[0]), float(w[1])) if w[0] > 0 else (1.0, 0.0)


def held_out(id_col: str = "doc_id") -> Column:
    """True for rows whose labels are never learnt from."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % 4 == 2


def _sample(rows: DataFrame, n: int) -> DataFrame:
    """The first ``n`` rows by a hash of the id: a fixed random sample."""
    return rows.orderBy(F.xxhash64(F.lit(3), "_id"), "_id").limit(n)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_id_col: str = "doc_id", label_col: str = "quality",
        max_rows: int = MAX_ROWS) -> Model:
    """Fit on trusted positives of ``labels`` and unlabelled rows of ``docs``."""
    known = (labels.select(F.col(label_id_col).alias("_id"), F.col(label_col).cast("double").alias("_y"))
             .where("_id is not null and _y is not null").where(~held_out("_id"))
             .groupBy("_id").agg((F.avg("_y") >= 0.5).cast("int").alias("_y")))
    ids = docs.select(F.col(id_col).alias("_id")).where("_id is not null").where(~held_out("_id"))
    total = known.agg(F.count("_y"), F.sum("_y")).first()
    scaling = _sample(known, max_rows).select("_id", "_y", F.lit("scale").alias("_part"))
    trusted = _sample(known.where("_y = 1"), max_rows).select("_id", "_y", F.lit("p").alias("_part"))
    web = _sample(ids.distinct(), max_rows).select("_id", F.lit(-1).alias("_y"), F.lit("u").alias("_part"))
    chosen = scaling.unionByName(trusted).unionByName(web).groupBy("_id").agg(
        F.max("_y").alias("_y"), F.collect_set("_part").alias("_part"))
    # at most 3 * max_rows ids, and a row of each: a bound that does not grow with the data
    rows = docs.select(F.col(id_col).alias("_id"), whole_text(text_col).alias("_text")).join(
        F.broadcast(chosen), "_id").select("_id", "_y", F.array_join("_part", ",").alias("_part"), "_text",
                                           text_hash("_text").alias("_hash"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, _ROWS):
                batch = whole.slice(at, _ROWS)
                x = features(list(texts(batch.column(3))))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), batch.column(2), batch.column(4),
                     pa.array([r.tobytes() for r in x], type=pa.binary())], names=["_id", "_y", "_part", "_hash", "x"])

    id_type = rows.schema["_id"].dataType.simpleString()
    # one per id behind the features: vectors are shuffled, not texts, and one per task and id
    found = (rows.mapInArrow(run, f"_id {id_type}, _y int, _part string, _hash long, x binary")
             .groupBy("_id", "_y", "_part").agg(F.min(F.struct("_hash", "x")).alias("_of"))
             .select("_id", "_y", "_part", "_of.x").orderBy("_id", "x").toArrow())
    x = np.frombuffer(b"".join(found["x"].to_pylist()), dtype=np.float32).reshape(-1, WIDTH)
    y = found["_y"].to_numpy()
    part = np.array(found["_part"].to_pylist(), dtype=object)
    of = {k: np.array([k in p.split(",") for p in part], dtype=bool) for k in ("p", "u", "scale")}
    share = (total[1] + 1) / (total[0] + 2) if total[0] else 0.5
    prior = float(np.clip(share, 0.02, 0.98))
    if not of["p"].any() or not of["u"].any():
        return Model(np.zeros(WIDTH), np.ones(WIDTH), np.zeros(WIDTH), np.log(prior / (1 - prior)))
    model = fit_nnpu(x[of["p"]], x[of["u"]], prior)
    if len(set(y[of["scale"]])) == 2:
        model.slope, model.offset = platt(model.margin(x[of["scale"]]), y[of["scale"]])
    return model


def score(model: Model, text_col: str = "text") -> Column:
    """Column expression: probability of label 1."""

    @arrow_udf("double")
    def run(column: pa.Array) -> pa.Array:
        parts = [model.score(features(list(texts(column.slice(at, _ROWS))))) for at in range(0, len(column), _ROWS)]
        return pa.array(np.concatenate(parts) if parts else np.zeros(0))

    return run(whole_text(text_col))


def keep_good(docs: DataFrame, model: Model, text_col: str = "text",
              threshold: float = THRESHOLD) -> DataFrame:
    """The rows that score at least ``threshold``."""
    docs, (text_col,), unseal = seal(docs, text_col)
    return unseal(docs.where(score(model, text_col) >= threshold))
