"""Toxicity by compression distance between two zstandard dictionaries.

Words are written as fixed-length codes of their beginnings, so a dictionary
matches words and not letters that words share. Both dictionaries begin with
the same part, trained by zstandard on ordinary text. The toxic one ends in
the words that set toxic text apart; the ordinary one with as many codes that
stand for no word, so that both are alike in all but the words. A window that
compresses shorter with the toxic dictionary speaks for toxicity. The mean
and the largest differences of a text's windows are calibrated to a
probability.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.labelled import held_out, sample, sigmoid, words_of

BEGINNING = 4
WINDOW = 16
DICTIONARY_BYTES = 8192
DISTINCT_WORDS = 256
_OPENERS = "\"'([{<*#-_¡¿“‘"
_BATCH_ROWS = 500


def _codes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Words per text and the 8-byte code of each word."""
    import xxhash

    counts, words, codes = words_of(texts)
    coded = [xxhash.xxh3_64_intdigest(w.lower().lstrip(_OPENERS)[:BEGINNING]) for w in words]
    return counts, np.array(coded, np.uint64)[codes] if words else np.zeros(0, np.uint64)


def _windows(coded: np.ndarray) -> list[bytes]:
    data = coded.tobytes()
    return [data[i : i + 8 * WINDOW] for i in range(0, len(data), 8 * WINDOW)]


@dataclass(frozen=True)
class Dictionaries:
    ordinary: bytes
    toxic: bytes


def _split(texts: list[str]) -> list[np.ndarray]:
    counts, coded = _codes(pa.array(texts, pa.string()))
    return np.split(coded, np.cumsum(counts)[:-1]) if len(counts) else []


def train(toxic: list[np.ndarray], ordinary: list[np.ndarray]) -> Dictionaries:
    """Dictionaries from coded texts of the two kinds."""
    import zstandard

    n, m = max(1, len(toxic)), max(1, len(ordinary))
    seen = Counter(c for t in toxic for c in np.unique(t).tolist())
    usual = Counter(c for t in ordinary for c in np.unique(t).tolist())
    base, needed = n / (n + m), np.log(max(2, len(seen)))

    def evidence(code: int) -> float:
        """Log likelihood ratio of the code's share in toxic texts against the share of toxic texts."""
        k, u = seen[code], usual[code]
        share = k / (k + u)
        if share <= base:
            return 0.0
        return k * np.log(share / base) + (u * np.log((1 - share) / (1 - base)) if u else 0.0)

    # Less than chance gives among so many words, or than a tenth of the best, tells more about the sample than about toxicity.
    apart = {c: e for c in seen if (e := evidence(c)) > needed and seen[c] / n > 5 * usual[c] / m}
    apart = {c: e for c, e in apart.items() if e > max(apart.values()) / 10}
    chosen = sorted(apart, key=lambda c: (-apart[c], c))[:DISTINCT_WORDS]
    own = np.array(chosen[::-1], np.uint64).tobytes()
    filler = np.random.default_rng(7).bytes(len(own))
    try:
        common = zstandard.train_dictionary(DICTIONARY_BYTES, [w for t in ordinary for w in _windows(t)[:60]]).as_bytes()
    except (zstandard.ZstdError, ValueError):  # too little text
        common = b"".join(w for t in ordinary[:64] for w in _windows(t)[:1])
    return Dictionaries(common + filler, common + own)


class Distance:
    """Features of coded texts under two dictionaries."""

    def __init__(self, dictionaries: Dictionaries) -> None:
        import zstandard

        level = zstandard.ZstdCompressionParameters.from_level(
            3, write_content_size=False, write_checksum=False, write_dict_id=False, window_log=17
        )
        raw = lambda d: zstandard.ZstdCompressionDict(d, dict_type=zstandard.DICT_TYPE_RAWCONTENT) if len(d) >= 8 else None
        self._ordinary = zstandard.ZstdCompressor(compression_params=level, dict_data=raw(dictionaries.ordinary))
        self._toxic = zstandard.ZstdCompressor(compression_params=level, dict_data=raw(dictionaries.toxic))

    def features(self, coded: np.ndarray) -> tuple[float, float, float]:
        """Mean difference per word, largest difference, mean of the three largest; zeros for a text without words."""
        if not len(coded):
            return 0.0, 0.0, 0.0
        one, two = self._ordinary.compress, self._toxic.compress
        gains = np.array([len(one(w)) - len(two(w)) for w in _windows(coded)], float)
        top = np.sort(gains)[::-1][:3]
        return float(gains.sum() / len(coded)), float(top[0]), float(top.sum() / 3)


@dataclass(frozen=True)
class Model:
    dictionaries: Dictionaries
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def probability(self, features: np.ndarray) -> np.ndarray:
        x = (features - self.mean) / self.scale
        return sigmoid(np.concatenate([x, np.ones((len(x), 1))], axis=1) @ self.weights)


def fit(texts: dict[int, list[str]], counts: dict[int, int]) -> Model:
    """Model from texts labelled 0 and 1. Without texts of both kinds it gives every text the share of label 1."""
    kinds = [_split(texts.get(0, [])), _split(texts.get(1, []))]
    total = max(1, counts.get(0, 0) + counts.get(1, 0))
    share = min(max(counts.get(1, 0) / total, 1e-6), 1 - 1e-6)
    if not kinds[0] or not kinds[1]:
        flat = np.array([0, 0, 0, np.log(share / (1 - share))])
        return Model(Dictionaries(b"", b""), np.zeros(3), np.ones(3), flat)
    dictionaries = train(kinds[1], kinds[0])
    distance = Distance(dictionaries)
    rows = [distance.features(t) for kind in kinds for t in kind]
    marks = np.repeat([0, 1], [len(kinds[0]), len(kinds[1])])
    x, y = np.array(rows, float), np.array(marks, float)
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    x = np.concatenate([(x - mean) / scale, np.ones((len(x), 1))], axis=1)
    # Each kind weighs as much as it has labelled rows.
    each = np.where(y == 1, share / max(y.mean(), 1e-9), (1 - share) / max(1 - y.mean(), 1e-9))
    weights, ridge = np.zeros(x.shape[1]), np.diag([1e-2 * len(y) / 100] * 3 + [1e-6])
    for _ in range(30):
        p = sigmoid(x @ weights)
        slope = x.T @ (each * (p - y)) + ridge @ weights
        bend = (x * (each * p * (1 - p))[:, None]).T @ x + ridge
        weights = weights - np.linalg.solve(bend + 1e-9 * np.eye(len(weights)), slope)
    return Model(dictionaries, mean, scale, weights)


def fit_on(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic") -> Model:
    """Model from the bounded sample of :func:`touchline.llm.labelled.sample`, without held-out rows."""
    return fit(*sample(docs, labels, label, key, text))


def score(model: Model, docs: DataFrame, text: str = "text") -> Column:
    """Probability that a text is toxic, from the whole text; null and empty texts get that of no windows."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        distance, rows = Distance(shared.value.dictionaries), []
        for at in range(0, len(texts), _BATCH_ROWS):
            counts, coded = _codes(texts.slice(at, _BATCH_ROWS))
            rows += [distance.features(t) for t in np.split(coded, np.cumsum(counts)[:-1])]
        return pa.array(shared.value.probability(np.array(rows, float).reshape(-1, 3)))

    return scored(F.col(text))


def classify(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, ``held_out``, ``score`` and ``predicted`` (1 from one half on).

    Nulls count as empty texts, repeated rows get equal scores, a row without a
    key is not held out, other columns are left out, and an empty table gives
    an empty table.
    """
    rows = docs.select(key, text)
    scored = rows.withColumn("score", score(fit_on(docs, labels, key, text), rows, text))
    predicted = F.when(F.col("score") >= 0.5, 1).otherwise(0)
    return scored.select(key, F.coalesce(held_out(F.col(key)), F.lit(False)).alias("held_out"), "score", predicted.alias("predicted"))
