"""Document quality from a linear-chain conditional random field over lines.

Every line is good or bad. Its features are proportions of its own characters and words, and those of the lines
before and after it; two states and four transition weights make the chain. Forward-backward passes run over many
documents at once, and a document's score is the mean probability of its lines being good, weighted by length.
Neither labels nor language, source or id are features.

The weights are fitted on a bounded number of labelled documents; scoring reads every text whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallyloom.llm.tables import released, slices

#: How many labelled documents the weights are fitted on; a bound for the driver, part of the method.
SAMPLE_DOCS = 3_000
#: Bytes of text scored at once, which bounds a task's memory.
SLICE = 1_000_000
LOWER, UPPER, DIGIT, BLANK, STOP, SHOUT, PIPE, SYMBOL, BREAK, OTHER = range(10)
NEIGHBOURS = ["lower", "upper", "shouts", "pipes", "symbols", "repeats"]
OWN = ["chars", "lower", "upper", "digit", "stops", "other", "shouts", "pipes", "symbols", "word_length", "capitals", "repeats", "ends", "empty"]
FEATURES = [*OWN, *(f"previous {x}" for x in NEIGHBOURS), *(f"next {x}" for x in NEIGHBOURS), "first", "last", "bias"]


def _classes() -> np.ndarray:
    """The class of every character of the basic plane; later planes count as other."""

    def of(c: str) -> int:
        if c.isupper():
            return UPPER
        if c.isalpha():
            return LOWER
        if c.isnumeric():
            return DIGIT
        return BREAK if c == "\n" else BLANK if c.isspace() else OTHER

    table = np.array([of(chr(i)) for i in range(0x10000)], np.uint8)
    for kind, characters in ((STOP, ".,;:?'\""), (SHOUT, "!"), (PIPE, "|"), (SYMBOL, "#*$%&<>=_/\\@^~{}[]+")):
        table[[ord(c) for c in characters]] = kind
    return table


_CLASSES = _classes()
_POWERS = np.cumprod(np.full(256, 0x9E3779B97F4A7C15, np.uint64))


def _repeats(codes: np.ndarray, blank: np.ndarray, word_start: np.ndarray) -> np.ndarray:
    """1 where a word begins that equals the word before it; words are compared by a hash of their characters."""
    begins = np.flatnonzero(word_start)
    found = np.zeros(len(codes), bool)
    if len(begins):
        place = np.arange(len(codes)) - begins[np.maximum(np.cumsum(word_start) - 1, 0)]
        terms = np.where(blank, 0, codes * _POWERS[np.clip(place, 0, 255)])
        hashes = np.add.reduceat(terms, begins)
        found[begins[1:]] = hashes[1:] == hashes[:-1]
    return found


def line_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features and lengths of all lines of ``texts`` in order, and where each text's lines begin (and the end)."""
    codes = np.frombuffer(("\n".join(texts) + "\n").encode("utf-32-le", "surrogatepass"), np.uint32)
    kinds = _CLASSES[np.minimum(codes, 0xFFFF)]
    ends = np.flatnonzero(kinds == BREAK)
    starts = np.concatenate(([0], ends[:-1] + 1))
    bounds = np.concatenate(([0], np.cumsum([t.count("\n") + 1 for t in texts])))

    def per_line(mask: np.ndarray) -> np.ndarray:
        return np.add.reduceat(mask, starts, dtype=np.int64).astype(np.float64)

    blank = (kinds == BLANK) | (kinds == BREAK)
    word_start = ~blank
    word_start[1:] &= blank[:-1]
    chars, n_words = (ends - starts).astype(np.float64), per_line(word_start)
    some, some_words = np.maximum(chars, 1), np.maximum(n_words, 1)
    n = {kind: per_line(kinds == kind) for kind in (LOWER, UPPER, DIGIT, BLANK, STOP, SHOUT, PIPE, SYMBOL, OTHER)}
    final = kinds[np.maximum(ends - 1, 0)]
    own = {
        "chars": np.log1p(chars) / 5,
        "lower": n[LOWER] / some,
        "upper": n[UPPER] / some,
        "digit": n[DIGIT] / some,
        "stops": n[STOP] / some_words,
        "other": n[OTHER] / some,
        "shouts": np.minimum(n[SHOUT] / some_words, 2),
        "pipes": np.minimum(n[PIPE] / some_words, 2),
        "symbols": np.minimum(n[SYMBOL] / some_words, 4),
        "word_length": np.minimum((chars - n[BLANK]) / some_words / 10, 3),
        "capitals": per_line(word_start & (kinds == UPPER)) / some_words,
        "repeats": per_line(_repeats(codes, blank, word_start)) / some_words,
        "ends": ((final == STOP) | (final == SHOUT)) & (chars > 0),
        "empty": chars == 0,
    }
    first, last = np.zeros(len(ends)), np.zeros(len(ends))
    first[bounds[:-1]], last[bounds[1:] - 1] = 1, 1
    around = [own[x] for x in NEIGHBOURS]
    before = [np.where(first, 0, np.concatenate(([0], x[:-1]))) for x in around]
    after = [np.where(last, 0, np.concatenate((x[1:], [0]))) for x in around]
    columns = [*(own[x] for x in OWN), *before, *after, first, last, np.ones(len(ends))]
    return np.stack(columns, axis=1).astype(np.float32), np.maximum(chars, 1), bounds


def features_of(texts: list[str], at_once: int = 1_000_000) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``line_features`` of many texts, worked out for about ``at_once`` characters at a time."""
    parts, first, size = [], 0, 0
    for i, text in enumerate(texts, 1):
        size += len(text)
        if size >= at_once or i == len(texts):
            parts.append(line_features(texts[first:i]))
            first, size = i, 0
    sizes = np.concatenate([np.diff(bounds) for _, _, bounds in parts])
    features, lengths = (np.concatenate([p[k] for p in parts]) for k in (0, 1))
    return features, lengths, np.concatenate(([0], np.cumsum(sizes)))


def forward_backward(good: np.ndarray, moves: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log forward and backward messages of all lines. ``good`` is the log potential of the good state (the bad one
    has 0), ``moves`` the 2 x 2 log transitions. Step t of all chains that are long enough is taken at once."""
    sizes = np.diff(bounds)
    order = np.argsort(-sizes, kind="stable")
    starts, sizes = bounds[:-1][order], sizes[order]
    alpha = np.stack((np.zeros_like(good), good), axis=1)
    beta = np.zeros_like(alpha)
    longest = int(sizes[0]) if len(sizes) else 0
    live = np.searchsorted(-sizes, -np.arange(longest), side="left")  # chains with more than t lines
    for t in range(1, longest):
        at = starts[: live[t]] + t
        left = alpha[at - 1]
        for state in (0, 1):
            alpha[at, state] += np.logaddexp(left[:, 0] + moves[0, state], left[:, 1] + moves[1, state])
    for t in range(longest - 1, 0, -1):
        at = starts[: live[t]] + t
        right = beta[at].copy()
        right[:, 1] += good[at]
        for state in (0, 1):
            beta[at - 1, state] = np.logaddexp(right[:, 0] + moves[state, 0], right[:, 1] + moves[state, 1])
    return alpha, beta


@dataclass(frozen=True)
class LineCrf:
    weights: np.ndarray
    moves: np.ndarray
    scale: float = 1.0
    shift: float = 0.0

    def marginals(self, features: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        alpha, beta = forward_backward(features @ self.weights, self.moves, bounds)
        both = alpha + beta
        return 1 / (1 + np.exp(np.clip(both[:, 0] - both[:, 1], -700, 700)))

    def log_odds(self, texts: list[str]) -> np.ndarray:
        """Of the length-weighted mean of the lines' marginals."""
        features, lengths, bounds = features_of(texts)
        good = self.marginals(features.astype(np.float64), bounds)
        mean = np.add.reduceat(good * lengths, bounds[:-1]) / np.add.reduceat(lengths, bounds[:-1])
        mean = np.clip(mean, 1e-6, 1 - 1e-6)
        return np.log(mean / (1 - mean))

    def scores(self, texts: list[str]) -> np.ndarray:
        """The mean marginal, mapped to the probability of label 1 by a logistic curve."""
        return 1 / (1 + np.exp(-(self.scale * self.log_odds(texts) + self.shift)))


def _calibrated(model: LineCrf, texts: list[str], labels: list[int], ridge: float = 1e-2) -> LineCrf:
    """Fit the logistic curve by Newton's method; it never falls."""
    x, y = np.stack((model.log_odds(texts), np.ones(len(texts))), axis=1), np.array(labels, np.float64)
    theta = np.array([1.0, 0.0])
    for _ in range(25):
        p = 1 / (1 + np.exp(-x @ theta))
        bend = (x * (p * (1 - p))[:, None]).T @ x / len(y) + ridge * np.eye(2)
        theta = theta + np.linalg.solve(bend, x.T @ (y - p) / len(y) - ridge * (theta - [1.0, 0.0]))
        theta[0] = max(theta[0], 0.1)
    return LineCrf(model.weights, model.moves, float(theta[0]), float(theta[1]))


def fit(texts: list[str], labels: list[int], steps: int = 120, rate: float = 0.2, ridge: float = 1e-3) -> LineCrf:
    """Maximum likelihood with a ridge penalty; every line carries the label of its document."""
    if not texts:
        return LineCrf(np.zeros(len(FEATURES)), np.zeros((2, 2)))
    features, _, bounds = features_of(texts)
    x, n = features.astype(np.float64), len(features)
    y = np.repeat(np.array(labels, np.float64), np.diff(bounds))
    inner = np.ones(n, bool)
    inner[bounds[:-1]] = False
    at = np.flatnonzero(inner)  # lines that have one before them in their text
    seen = np.array([[np.sum((y[at - 1] == i) & (y[at] == j)) for j in (0, 1)] for i in (0, 1)], np.float64)
    theta = np.zeros(len(FEATURES) + 4)
    mean, square = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        weights, moves = theta[:-4], theta[-4:].reshape(2, 2)
        good = x @ weights
        alpha, beta = forward_backward(good, moves, bounds)
        total = np.logaddexp(alpha[:, 0] + beta[:, 0], alpha[:, 1] + beta[:, 1])
        p = np.exp(alpha[:, 1] + beta[:, 1] - total)
        pairs = np.empty((2, 2))
        for i in (0, 1):
            for j in (0, 1):
                here = beta[at, j] + (good[at] if j else 0)
                pairs[i, j] = np.exp(alpha[at - 1, i] + moves[i, j] + here - total[at]).sum()
        slope = np.concatenate((x.T @ (y - p), (seen - pairs).ravel())) / n - ridge * theta
        mean, square = 0.9 * mean + 0.1 * slope, 0.99 * square + 0.01 * slope**2
        theta = theta + rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    return _calibrated(LineCrf(theta[:-4].copy(), theta[-4:].reshape(2, 2).copy()), texts, labels)


def held_out(doc_id):
    """Rows that never take part in learning: a fifth by the checksum of the id."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(5)) == 0


def train(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS) -> LineCrf:
    """Fit on at most ``sample_docs`` labelled documents that are not held out, taken in the order of a hash of
    their ids. Conflicting labels of a document count as the lowest; without labelled documents every score is 0.5."""
    usable = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out(F.col("doc_id")))
    marked = usable.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    chosen = marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_docs)
    # At most sample_docs rows of an id and a label are broadcast.
    rows = (
        docs.select("doc_id", "text")
        .join(F.broadcast(chosen), "doc_id")
        .groupBy("doc_id")
        .agg(F.min(F.coalesce("text", F.lit(""))).alias("text"), F.min("quality").alias("quality"))
        .collect()
    )
    rows.sort(key=lambda r: r["doc_id"])
    return fit([r["text"] for r in rows], [int(r["quality"] > 0) for r in rows])


def score_documents(docs: DataFrame, model: LineCrf) -> DataFrame:
    """``docs`` plus ``score``, the probability of good quality from 0 to 1. Null and empty texts score as one empty
    line. An input column named ``score`` is replaced."""
    docs = docs.drop("score")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            scores = model.scores(texts) if texts else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], [*batch.schema.names, "score"])

    return docs.mapInArrow(lambda batches: released(run(batches)), f"{fields}, score double")
