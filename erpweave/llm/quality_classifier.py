"""Quality classifier: a weak-label model trains a hashed linear scorer.

Overlapping heuristic labellers vote good, bad or abstain on a bounded sample of documents.
Expectation-maximisation estimates their accuracies from agreement alone (no given label is read);
the posterior label of each sample document is the target of a logistic model over hashed token
shapes ("Aa", "a,", "a#") and binned document figures. All documents are then scored in one pass over
their whole texts; nothing is shuffled. The only data-sized state is the model: ``BUCKETS`` weights.

Defined results: NULL and blank texts have score 0 and are rejected; repeated rows get equal
scores; an empty table gives no rows (and a model of zeros is never needed).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from erpweave.llm.quality_rules import fit
from erpweave.llm.worker import Cache, bounded_sample, bucket, focus

SAMPLE_ROWS = 20_000  # bound of the fitting sample
BUCKETS = 4096
BINS = 64  # places behind the hashed shapes for binned document figures
LABELLERS = ("prose", "symbols", "tables", "shouting", "echo", "lines", "variety")

PLAIN, SYMBOL, LOUD, PIPE = 1, 2, 4, 8


def _shape(token: bytes) -> int:
    """Hash bucket of the token's shape in the high bits, four flags in the low ones."""
    word = token.decode("utf-8", "replace")
    shape, last = [], ""
    for ch in word:
        kind = "A" if ch.isupper() else "a" if ch.isalpha() else "0" if ch.isdigit() else ch
        if kind != last:
            shape.append(kind)
            last = kind
    text = "".join(shape)
    letters = [c for c in text if c in "Aa"]
    flags = 0
    if text.rstrip(".,;:!?")[-1:] in ("a", "A") and len(letters) == len(text.rstrip(".,;:!?")) and len(text) - len(letters) <= 1:
        flags |= PLAIN
    if any(c in "#*$%&|<>" for c in text):
        flags |= SYMBOL
    if letters and "a" not in letters and len(word) > 1 and word[:2].isupper():
        flags |= LOUD
    if text == "|":
        flags |= PIPE
    return bucket(text.encode(), BUCKETS) << 4 | flags


_SHAPES = Cache(_shape, 150_000)


def _read(text: bytes) -> tuple[np.ndarray, np.ndarray, list[float]] | None:
    """Hashed shapes with their share of the tokens, and the document figures."""
    tokens = text.split()
    if not tokens:
        return None
    codes = np.fromiter(map(_SHAPES.__getitem__, tokens), np.int64, len(tokens))
    n = len(codes)
    shapes, counts = np.unique(codes >> 4, return_counts=True)
    share = [float(np.count_nonzero(codes & flag)) / n for flag in (PLAIN, SYMBOL, LOUD, PIPE)]
    lines = [x for x in text.split(b"\n") if x.strip()]
    echo = sum(map(bytes.__eq__, tokens, tokens[1:])) / n
    again = 1.0 - len(set(lines)) / max(len(lines), 1)
    return shapes, counts / n, [*share, echo, again, len(set(tokens)) / n, float(n)]


def _votes(figures: list[float]) -> list[int]:
    plain, symbol, loud, pipe, echo, again, variety, n = figures
    flat = variety < (0.3 if n < 500 else 0.15)
    return [
        -1 if plain < 0.6 else 1 if plain > 0.85 and not flat else 0,
        -1 if symbol > 0.2 else 0, -1 if pipe > 0.15 else 0, -1 if loud > 0.3 else 0,
        -1 if echo > 0.2 else 0, -1 if again > 0.3 else 0, -1 if flat and n >= 8 else 0,
    ]


def _binned(figures: list[float]) -> list[int]:
    """Places of the seven shares in eight bins each, then the length class."""
    shares = [BUCKETS + 8 * i + min(int(v * 8), 7) for i, v in enumerate(figures[:7])]
    return [*shares, BUCKETS + 56 + min(int(np.log10(figures[7])), 7)]


def _examples(batches):
    for batch in batches:
        rows: dict[str, list] = {"places": [], "values": [], "votes": []}
        for text in batch.column("text").to_pylist():
            if text and (got := _read(text)):
                shapes, values, figures = got
                bins = _binned(figures)
                rows["places"].append([*shapes.tolist(), *bins])
                rows["values"].append([*values.tolist(), *[1.0] * len(bins)])
                rows["votes"].append(_votes(figures))
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows["places"], pa.list_(pa.int32())), pa.array(rows["values"], pa.list_(pa.float64())),
             pa.array(rows["votes"], pa.list_(pa.int32()))], ["places", "values", "votes"])


def logistic(place: np.ndarray, value: np.ndarray, row: np.ndarray, target: np.ndarray, size: int,
             rounds: int = 300, rate: float = 0.3, decay: float = 1e-4) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic model on sparse rows, by Adagrad over the whole sample."""
    w, b = np.zeros(size), 0.0
    gw, gb = np.full(size, 1e-8), 1e-8
    n = max(len(target), 1)
    for _ in range(rounds):
        z = np.bincount(row, w[place] * value, len(target)) + b
        miss = 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30))) - target
        g = np.bincount(place, miss[row] * value, size) / n + decay * w
        gw += g * g
        w -= rate * g / np.sqrt(gw)
        d = miss.mean() if len(target) else 0.0
        gb += d * d
        b -= rate * d / np.sqrt(gb)
    return w, b


def train(docs: DataFrame, rows: int = SAMPLE_ROWS) -> tuple[np.ndarray, float]:
    """Label model and scorer from a bounded sample of ``docs``."""
    sample = bounded_sample(docs.select("doc_id", F.col("text").cast("binary").alias("text")), rows, "doc_id")
    got = sample.select("text").mapInArrow(
        _examples, "places array<int>, values array<double>, votes array<int>").toArrow()
    if not got.num_rows:
        return np.zeros(BUCKETS + BINS), 0.0
    votes = np.array(got["votes"].to_pylist())
    patterns, which, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    bias, odds = fit(patterns, counts.astype(float))
    posterior = 1.0 / (1.0 + np.exp(-(bias + patterns @ odds)))
    places = got["places"].combine_chunks()
    lengths = np.diff(places.offsets.to_numpy())
    return logistic(
        places.flatten().to_numpy(), got["values"].combine_chunks().flatten().to_numpy(),
        np.repeat(np.arange(len(lengths)), lengths), posterior[which.ravel()], BUCKETS + BINS)


def scorer(weights: np.ndarray, bias: float):
    """Arrow UDF: probability of good quality of a binary text."""

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        focus(_SHAPES)
        out = []
        for text in texts.to_pylist():
            got = _read(text) if text else None
            if got is None:
                out.append(0.0)
                continue
            shapes, values, figures = got
            z = bias + float(weights[shapes] @ values) + float(weights[_binned(figures)].sum())
            out.append(float(1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))))
        return pa.array(out, pa.float64())

    return score


def quality(docs: DataFrame, rows: int = SAMPLE_ROWS) -> Column:
    """Column over ``docs``: probability that a document is good, by a model fitted on ``docs``."""
    weights, bias = train(docs, rows)
    return scorer(weights, bias)(F.col("text").cast("binary"))


def classified(docs: DataFrame, threshold: float = 0.5, rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, quality, kept for every row."""
    return docs.select("doc_id", quality(docs, rows).alias("quality")).select(
        "doc_id", "quality", (F.col("quality") >= threshold).alias("kept"))


def keep_good(docs: DataFrame, threshold: float = 0.5, rows: int = SAMPLE_ROWS) -> DataFrame:
    """The rows of ``docs`` that the classifier accepts, columns unchanged."""
    return docs.where(quality(docs, rows) >= threshold)
