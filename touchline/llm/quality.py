"""Document quality by ordinal cumulative-link regression on graded ratings.

All grades share one weight per hashed text feature; ordered thresholds cut
the weighted sum into grades: the probability of at most grade ``k`` is the
logistic function of threshold ``k`` less the sum. Features are word shapes,
pairs of neighbouring shapes and word endings, as shares of the words, and
levels of repetition and word length, all hashed into one vector.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.labelled import held_out, sample, sigmoid, words_of

SIZE = 1 << 14
STEPS = 200
THRESHOLD = 0.5
_BATCH_ROWS = 1000
_TABLE = 1 << 24
_SHAPES = ((r"\p{Lu}+", "X"), (r"\p{Ll}+", "x"), (r"[^\P{L}Xx]+", "y"), (r"\p{Nd}+", "0"), (r"([^Xxy0])[^Xxy0]*", r"\1"))


def shapes_of(words: pa.Array) -> pa.Array:
    """Runs of upper case as X, lower as x, other letters as y, digits as 0; of a run of signs the first."""
    for pattern, sign in _SHAPES:
        words = pc.replace_substring_regex(words, pattern, sign)
    return pc.utf8_slice_codeunits(words, 0, 16)


def _place(*names: str) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest("\x00".join(names)) % SIZE


def _distinct(values: pa.Array, codes: np.ndarray) -> tuple[list[str], np.ndarray]:
    """Distinct values, and which of them each word has."""
    coded = values.dictionary_encode()
    number = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    return coded.dictionary.to_pylist(), number[codes] if len(codes) else np.zeros(0, np.int64)


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, places and values of the features of each text."""
    counts, words, codes = words_of(texts)
    listed = pa.array(words, pa.string())
    shape_names, own = _distinct(shapes_of(listed), codes)
    ending_names, ending = _distinct(pc.utf8_lower(pc.utf8_slice_codeunits(listed, -2)), codes)
    single = np.array([_place("shape", s) for s in shape_names], np.int64)[own] if len(codes) else own
    ending = np.array([_place("end", e) for e in ending_names], np.int64)[ending] if len(codes) else own
    doc = np.repeat(np.arange(len(counts)), counts)
    share = 1 / np.maximum(counts, 1)[doc]
    pair = np.flatnonzero(doc[1:] == doc[:-1])
    code = own[pair] * len(shape_names) + own[pair + 1]
    if len(shape_names) ** 2 <= _TABLE:
        both = np.flatnonzero(np.bincount(code, minlength=1))
        where = np.zeros(int(code.max(initial=0)) + 1, np.int64)
        where[both] = np.arange(len(both))
        inverse = where[code]
    else:
        both, inverse = np.unique(code, return_inverse=True)
    names = [_place("pair", shape_names[c // len(shape_names)], shape_names[c % len(shape_names)]) for c in both.tolist()]
    paired = np.array(names, np.int64)[inverse] if names else pair
    distinct = np.bincount(np.unique(doc * max(1, len(words)) + codes) // max(1, len(words)), minlength=len(counts))
    lengths = pc.utf8_length(listed).to_numpy(zero_copy_only=False).astype(float)[codes] if len(codes) else np.zeros(0)
    mean = np.bincount(doc, lengths, len(counts)) / np.maximum(counts, 1)
    # How many words repeat depends on how many there are.
    repeated = np.minimum(9, (10 * distinct / np.maximum(1, counts)).astype(int))
    level = [
        (_place("repeat", str(r), str(len(bin(int(c))))), _place("distinct", str(r)), _place("length", str(min(int(x), 20))))
        for r, c, x in zip(repeated, counts, mean, strict=True)
    ]
    rows = np.concatenate([doc, doc, doc[pair], np.repeat(np.arange(len(counts)), 3)])
    places = np.concatenate([single, ending, paired, np.array(level, np.int64).reshape(-1)])
    values = np.concatenate([share, share, share[pair], np.full(3 * len(counts), 0.3)])
    return rows, places, values


@dataclass(frozen=True)
class Model:
    """``thresholds`` rise; one fewer than ``grades``."""

    weights: np.ndarray
    thresholds: np.ndarray
    grades: tuple[int, ...]

    def sums(self, texts: pa.Array) -> np.ndarray:
        rows, places, values = features(texts)
        return np.bincount(rows, self.weights[places] * values, len(texts))

    def grade(self, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Expected grade, and probability of the highest grade."""
        below = sigmoid(self.thresholds[None] - sums[:, None])
        edges = np.concatenate([np.zeros((len(sums), 1)), below, np.ones((len(sums), 1))], axis=1)
        return np.diff(edges, axis=1) @ np.array(self.grades, float), 1 - edges[:, -2]


def _cells(body: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Summed features per (text, place), from slices of ``_BATCH_ROWS`` texts, so raw features of one slice are held at a time.

    Rows rise from slice to slice, so the joined cells are in the same order as from all texts at once.
    """
    cells, values = [np.zeros(0, np.int64)], [np.zeros(0)]
    for at in range(0, len(body), _BATCH_ROWS):
        rows, places, found = features(pa.array(body[at : at + _BATCH_ROWS], pa.string()))
        own, place = np.unique((rows + at) * SIZE + places, return_inverse=True)
        cells.append(own)
        values.append(np.bincount(place, found, len(own)))
    joined = np.concatenate(cells)
    return joined // SIZE, joined % SIZE, np.concatenate(values)


def fit(texts: dict[int, list[str]], counts: dict[int, int], steps: int = STEPS) -> Model:
    """Model from rated texts. A single grade, or none, gives a model that rates every text so."""
    grades = tuple(sorted(g for g, t in texts.items() if t))
    if len(grades) < 2:
        return Model(np.zeros(SIZE), np.zeros(0), grades or (0,))
    body = [t for g in grades for t in texts[g]]
    y = np.repeat(np.arange(len(grades)), [len(texts[g]) for g in grades])
    # Each grade weighs as much as it has rated rows.
    total = sum(counts[g] for g in grades)
    each = np.array([counts[g] / total / len(texts[g]) for g in grades])[y]
    rows, places, values = _cells(body)
    used, column = np.unique(places, return_inverse=True)
    below = np.cumsum([counts[g] for g in grades])[:-1] / total
    first = np.log(below / (1 - below))
    # Free parameters: weights, the first threshold, logarithms of the steps between thresholds.
    theta = np.concatenate([np.zeros(len(used)), first[:1], np.log(np.maximum(np.diff(first), 1e-3))])
    m, v, n = np.zeros_like(theta), np.zeros_like(theta), len(used)
    for step in range(1, steps + 1):
        cuts = theta[n] + np.concatenate([[0], np.cumsum(np.exp(theta[n + 1 :]))])
        sums = np.bincount(rows, theta[:n][column] * values, len(y))
        edges = np.concatenate([[-np.inf], cuts, [np.inf]])
        upper, lower = sigmoid(edges[y + 1] - sums), sigmoid(edges[y] - sums)
        inside = np.maximum(upper - lower, 1e-12)
        up, low = upper * (1 - upper) / inside, lower * (1 - lower) / inside
        slope = np.zeros_like(theta)
        slope[:n] = np.bincount(column, (each * (up - low))[rows] * values, n) + 2e-5 * theta[:n]
        by_cut = np.array([(each * low)[y == k + 1].sum() - (each * up)[y == k].sum() for k in range(len(cuts))])
        slope[n] = by_cut.sum()
        for k in range(1, len(cuts)):
            slope[n + k] = by_cut[k:].sum() * np.exp(theta[n + k])
        m, v = 0.9 * m + 0.1 * slope, 0.99 * v + 0.01 * slope**2
        theta = theta - 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    weights = np.zeros(SIZE)
    weights[used] = theta[:n]
    return Model(weights, theta[n] + np.concatenate([[0], np.cumsum(np.exp(theta[n + 1 :]))]), grades)


def fit_on(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality") -> Model:
    """Model from the bounded sample of :func:`touchline.llm.labelled.sample`, without held-out rows."""
    return fit(*sample(docs, labels, label, key, text))


def graded(model: Model, docs: DataFrame, text: str = "text") -> Column:
    """Struct of ``expected_grade`` and ``top_probability`` from the whole text; nulls count as empty texts."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("struct<expected_grade:double,top_probability:double>")
    def rate(texts: pa.Array) -> pa.Array:
        parts = [shared.value.sums(texts.slice(i, _BATCH_ROWS)) for i in range(0, len(texts), _BATCH_ROWS)]
        expected, top = shared.value.grade(np.concatenate([np.zeros(0), *parts]))
        return pa.StructArray.from_arrays([pa.array(expected), pa.array(top)], ["expected_grade", "top_probability"])

    return rate(F.col(text))


def rate(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Per row: key, ``held_out``, ``expected_grade``, ``top_probability`` and ``kept`` (probability from the threshold on).

    Nulls count as empty texts, repeated rows get equal grades, a row without a
    key is not held out, other columns are left out, and an empty table gives
    an empty table.
    """
    rows = docs.select(key, text)
    done = rows.withColumn("__llm_rate", graded(fit_on(docs, labels, key, text), rows, text))
    hidden = F.coalesce(held_out(F.col(key)), F.lit(False)).alias("held_out")
    kept = (F.col("__llm_rate.top_probability") >= threshold).alias("kept")
    return done.select(key, hidden, "__llm_rate.expected_grade", "__llm_rate.top_probability", kept)
