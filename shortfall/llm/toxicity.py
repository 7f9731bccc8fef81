"""Toxicity by compression distance between two dictionaries."""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field
from zlib import crc32

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shortfall.llm.base import crc_mod, sample_texts_of_ids

OTHER = re.compile(r"[\W\d_]+")


def words(text: str | None) -> list[str]:
    return OTHER.sub(" ", (text or "").lower()).split()


@dataclass
class ToxicityModel:
    """Dictionaries of toxic and ordinary text, thresholds and weights.

    A window's difference is its encoded length with the ordinary dictionary
    less that with the toxic one. The threshold on it and the weights of the
    text's features are calibrated on labelled rows.
    """

    toxic: bytes
    ordinary: bytes
    window: int = 8
    threshold: int = 3
    weights: tuple[float, ...] = (-3.0, 0.0, 0.0, 0.0, 0.0)
    _coders: list = field(default_factory=list, repr=False)

    def __getstate__(self):
        return {**self.__dict__, "_coders": []}

    def coders(self) -> list:
        if not self._coders:
            params = zstandard.ZstdCompressionParameters.from_level(
                3, window_log=17, min_match=4, strategy=zstandard.STRATEGY_BTOPT,
                write_content_size=False, write_dict_id=False, write_checksum=False,
            )
            for content in (self.ordinary, self.toxic):
                data = zstandard.ZstdCompressionDict(
                    content, dict_type=zstandard.DICT_TYPE_RAWCONTENT
                )
                data.precompute_compress(compression_params=params)
                self._coders.append(
                    zstandard.ZstdCompressor(dict_data=data, compression_params=params)
                )
        return self._coders

    def differences(self, text: str | None) -> np.ndarray:
        """One difference for each window of words."""
        ordinary, toxic = self.coders()
        got = words(text)
        windows = [
            (" " + " ".join(got[i : i + self.window]) + " ").encode()
            for i in range(0, len(got), self.window)
        ]
        return np.array(
            [len(ordinary.compress(w)) - len(toxic.compress(w)) for w in windows], np.int64
        )

    def features(self, text: str | None) -> np.ndarray:
        return self.summary(self.differences(text))

    def summary(self, diff: np.ndarray) -> np.ndarray:
        hits = int((diff >= self.threshold).sum())
        share = hits / len(diff) if len(diff) else 0.0
        mean = float(np.clip(diff, -8, 12).mean()) if len(diff) else 0.0
        certain = mean * np.sqrt(len(diff))
        return np.array([1.0, np.log1p(hits), np.log1p(100 * share), mean, certain])

    def score(self, text: str | None) -> float:
        return float(1 / (1 + np.exp(-self.features(text) @ np.array(self.weights))))


def without_copies(texts: list[str]) -> list[str]:
    """Texts that share less than half of their smallest 3-word hashes with any earlier one.

    Copies would make the words of one text look typical of its class.
    """
    holders: dict[int, list[int]] = {}
    kept = []
    for number, text in enumerate(texts):
        got = words(text)
        marks = sorted({crc32(" ".join(w).encode()) for w in zip(got, got[1:], got[2:])})[:16]
        common = Counter(other for mark in marks for other in holders.get(mark, ()))
        if max(common.values(), default=0) * 2 <= len(marks):
            kept.append(text)
            for mark in marks:
                holders.setdefault(mark, []).append(number)
    return kept


def distinctive(of: Counter, n_of: int, against: Counter, n_against: int, most: int) -> list[str]:
    """Words in more of the documents of one class than of the other, most telling last."""
    scored = []
    for word, count in of.items():
        if count < 3 or len(word) < 4:
            continue
        p, q = (count + 0.5) / (n_of + 1), (against[word] + 0.5) / (n_against + 1)
        pooled = (count + against[word] + 1) / (n_of + n_against + 2)
        z = (p - q) / np.sqrt(pooled * (1 - pooled) * (1 / (n_of + 1) + 1 / (n_against + 1)))
        if z > 4 and p > 8 * q:
            scored.append((z, word))
    return [word for _, word in sorted(scored)[-most:]]


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 0.3) -> np.ndarray:
    """Weights of a logistic regression by Newton's method."""
    w = np.zeros(x.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (weight * (y - p)) - ridge * w
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(x.shape[1])
        step = np.linalg.solve(hess, grad)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(toxic: list[str], ordinary: list[str], prior: float, content: int = 24_000) -> ToxicityModel:
    """Train the dictionaries on one half of each class and calibrate on the other."""
    toxic, ordinary = without_copies(toxic), without_copies(ordinary)
    train_t, held_t = toxic[::2], toxic[1::2]
    train_o, held_o = ordinary[::2], ordinary[1::2]
    df_t, df_o = Counter(), Counter()
    for texts, df in ((train_t, df_t), (train_o, df_o)):
        for text in texts:
            df.update(set(words(text)))
    common = [w for w, _ in sorted((df_t + df_o).items(), key=lambda x: (x[1], x[0]))[-3000:]]
    shared = (" " + " ".join(common))[-content:]
    telling_t = distinctive(df_t, len(train_t), df_o, len(train_o), 400)
    telling_o = distinctive(df_o, len(train_o), df_t, len(train_t), 400)
    avoid = set(telling_t)
    shared = " " + " ".join(w for w in shared.split() if w not in avoid) + " "
    model = ToxicityModel(
        # what both share stands last, at equal distances from a window
        toxic=(" " + " ".join(telling_t) + shared).encode(),
        ordinary=(" " + " ".join(telling_o) + shared).encode(),
    )
    if not telling_t or not held_t or not held_o:
        return model
    diffs = [model.differences(t) for t in held_t + held_o]
    y = np.r_[np.ones(len(held_t)), np.zeros(len(held_o))]
    weight = np.where(y == 1, prior / len(held_t), (1 - prior) / len(held_o)) * len(y)
    best = None
    for threshold in range(1, 8):
        model.threshold = threshold
        x = np.array([model.summary(d) for d in diffs])
        w = logistic(x, y, weight)
        p = np.clip(1 / (1 + np.exp(-x @ w)), 1e-9, 1 - 1e-9)
        loss = -float((weight * (y * np.log(p) + (1 - y) * np.log(1 - p))).sum())
        if best is None or loss < best[0] - 1e-9:
            best = (loss, threshold, tuple(w))
    model.threshold, model.weights = best[1], best[2]
    return model


def train(
    docs: DataFrame,
    labels: DataFrame,
    toxic_rows: int = 2000,
    ordinary_rows: int = 4000,
    most_chars: int = 20_000,
) -> ToxicityModel:
    """Model from a bounded sample: ``toxic_rows`` and ``ordinary_rows`` different labelled texts at most.

    Of a sampled text at most ``most_chars`` characters are learned from. The
    class shares come from all training labels.
    """
    labels = (
        labels.select("doc_id", "toxic")
        .filter("doc_id is not null and toxic in (0, 1)")
        .filter(crc_mod(F.col("doc_id"), 5) != 0)
    )
    shares = {r.toxic: r["count"] for r in labels.groupBy("toxic").count().collect()}
    most = max(toxic_rows, ordinary_rows)
    sample = sample_texts_of_ids(docs, labels.distinct(), "toxic", most, most_chars).collect()
    # in the order of a hash, which says nothing about a text
    sample.sort(key=lambda r: (crc32(r.text.encode()), r.text))
    toxic = [r.text for r in sample if r.toxic == 1][:toxic_rows]
    ordinary = [r.text for r in sample if r.toxic == 0][:ordinary_rows]
    total = sum(shares.values())
    prior = min(max(shares.get(1, 0) / total, 1e-4), 1 - 1e-4) if total else 0.05
    return fit(toxic, ordinary, prior)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows (doc_id, held_out, score, predicted), one for each row of ``docs``.

    Whole texts are scored, window by window; null and empty texts have no
    window and get the base score of such texts. Labels with a null id or a
    value other than 0 and 1 are ignored; a repeated label counts again. No
    labels give a low constant score; an empty table gives no rows. Columns
    other than doc_id and text are not looked at.
    """
    docs = docs.select("doc_id", "text")
    model = train(docs, labels)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series([model.score(t) for t in texts], dtype="float64")

    scored = docs.select(
        "doc_id", (crc_mod(F.col("doc_id"), 5) == 0).alias("held_out"), score("text").alias("score")
    )
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
