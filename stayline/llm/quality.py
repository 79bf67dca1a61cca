"""Quality classifier by compression: zstandard dictionaries built from good and from bad text.

A text is cut into windows, and each window is compressed with either dictionary. The normalised
difference of the two sizes says which dictionary knows the text better; together with the compressed
share (repetition compresses well under both) and the length it is calibrated to a probability.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayline.llm.common import boxed, boxed_text, text_of

#: Labelled documents per class that are used at most, chosen by a hash of their id; half of them
#: build the dictionaries, half calibrate.
SAMPLE = 3000
#: Labelled documents with more characters are not learned from (they are scored like all others).
SAMPLE_CHARS = 1 << 18
#: Bytes per window.
WINDOW = 512
DICTIONARY = 112 << 10
LEVEL = 3
#: Weight of the penalty on the calibration's coefficients.
RIDGE = 0.3
THRESHOLD = 0.3


@dataclass
class Model:
    """Two dictionaries and the calibration; some 250 KB, whatever the corpus."""

    good: bytes
    bad: bytes
    mean: list[float]
    scale: list[float]
    weights: list[float]
    constant: float | None = None  # the score where a class has no labelled row

    def compressors(self) -> tuple:
        made = []
        for data in (self.good, self.bad):
            kept = zstandard.ZstdCompressionDict(data)
            kept.precompute_compress(level=LEVEL)
            made.append(zstandard.ZstdCompressor(
                level=LEVEL, dict_data=kept, write_content_size=False, write_checksum=False, write_dict_id=False))
        return tuple(made)


def windows(text: str) -> list[bytes]:
    data = text.encode()
    return [data[i : i + WINDOW] for i in range(0, len(data), WINDOW)] or [b""]


def measures(texts, compressors) -> np.ndarray:
    """Per text: normalised size difference, compressed share, log length. All windows count."""
    good, bad = (c.compress for c in compressors)
    out = np.empty((len(texts), 3))
    for i, text in enumerate(texts):
        cut = windows(text)
        a, b = sum(len(good(w)) for w in cut), sum(len(bad(w)) for w in cut)
        n = max(1, sum(map(len, cut)))
        out[i] = (b - a) / max(a, b), a / n, np.log(n)
    return out


def _terms(x: np.ndarray, mean, scale) -> np.ndarray:
    z = np.clip((x - np.array(mean)) / np.array(scale), -4, 4)
    pairs = [z[:, i] * z[:, j] for i in range(z.shape[1]) for j in range(i + 1)]
    return np.column_stack([np.ones(len(z)), z, *pairs])


def _probability(logit: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


def calibrate(x: np.ndarray, y: np.ndarray, importance: np.ndarray) -> tuple[list, list, list]:
    """Ridge logistic regression on the measures and their products."""
    mean, scale = x.mean(0), x.std(0) + 1e-9
    a = _terms(x, mean, scale)
    w = np.zeros(a.shape[1])
    penalty = RIDGE * np.eye(len(w))
    for _ in range(50):
        p = _probability(a @ w)
        grad = a.T @ (importance * (p - y)) + penalty @ w
        step = np.linalg.solve((a * (importance * p * (1 - p))[:, None]).T @ a + penalty, grad)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return mean.tolist(), scale.tolist(), w.tolist()


def _dictionary(texts: list[str]) -> bytes:
    parts = [w for t in texts for w in windows(t) if w]
    try:
        return zstandard.train_dictionary(DICTIONARY, parts, level=LEVEL).as_bytes()
    except zstandard.ZstdError:  # too little text to train on: the text itself serves
        return b"".join(parts)[-DICTIONARY:]


def fit(samples: dict[int, list[str]], share_good: float) -> Model:
    """The model from texts of label 0 and 1; ``share_good`` is the share of label 1 among all labelled rows."""
    if not samples.get(0) or not samples.get(1):
        return Model(b"", b"", [], [], [], constant=1.0 if samples.get(1) or not samples.get(0) else 0.0)
    build = {q: t[::2] for q, t in samples.items()}
    check = {q: t[1::2] or t for q, t in samples.items()}
    model = Model(_dictionary(build[1]), _dictionary(build[0]), [], [], [])
    x = measures([*check[0], *check[1]], model.compressors())
    y = np.repeat([0.0, 1.0], [len(check[0]), len(check[1])])
    total = len(y)
    importance = np.where(y == 1, share_good * total / len(check[1]), (1 - share_good) * total / len(check[0]))
    model.mean, model.scale, model.weights = calibrate(x, y, importance)
    return model


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "quality",
          usable: Column | None = None, sample: int = SAMPLE) -> Model:
    """Fit on at most ``sample`` labelled documents per class.

    ``usable`` tells which rows of ``labels`` may be learned from. Null labels are left out.
    """
    marked = labels.where(F.col(label).isin(0, 1))
    if usable is not None:
        marked = marked.where(usable)
    marked = marked.select(F.col(f"`{id_col}`").alias("_id"), F.col(label).cast("int").alias("_label")).distinct()
    counts = {r["_label"]: r["n"] for r in marked.groupBy("_label").agg(F.count(F.lit(1)).alias("n")).collect()}
    order = F.xxhash64("_id")
    chosen = None
    for q in (0, 1):
        part = marked.where(F.col("_label") == q).orderBy(order, "_id").limit(sample)
        chosen = part if chosen is None else chosen.unionByName(part)
    # At most 2 * sample ids by construction.
    texts = docs.select(F.col(f"`{id_col}`").alias("_own"), text_of(text).alias("_t"))
    texts = texts.where(F.length("_t") <= SAMPLE_CHARS)
    short = texts.join(F.broadcast(chosen), F.col("_own") == F.col("_id"))
    once = short.groupBy("_id", "_label").agg(F.min("_t").alias("t"))
    found = once.orderBy(F.xxhash64("_id"), "_id").collect()
    samples = {q: [r["t"] for r in found if r["_label"] == q] for q in (0, 1)}
    total = sum(counts.values())
    return fit(samples, min(0.99, max(0.01, counts.get(1, 0) / total)) if total else 1.0)


def scorer(model: Model):
    """A column function: text -> score."""

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        if model.constant is not None:
            return pd.Series(model.constant, index=texts.index, dtype="float64")
        x = measures(texts.tolist(), model.compressors())
        return pd.Series(_probability(_terms(x, model.mean, model.scale) @ np.array(model.weights)), index=texts.index)

    return score


def score(docs: DataFrame, model: Model, text: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with ``name`` added (or replaced), 0 to 1; a null text scores as an empty one."""
    return docs.withColumn(name, scorer(model)(text_of(text)))


def accepted(docs: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that reach the threshold, with all their columns."""
    return boxed(docs).where(scorer(model)(boxed_text(text)) >= threshold).select("doc.*")
