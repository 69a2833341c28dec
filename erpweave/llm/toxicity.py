"""Toxicity by classifier chains.

Categories are predicted in a fixed order. The model of each category is linear over hashed word
features plus the probabilities of the categories before it; in training those probabilities
are out-of-fold predictions, so later models see them as they will be for new documents.

Word features are the word and its stems of 5 to 7 letters, so inflected forms count, and the marks
around it. The fit uses a bounded sample of labelled rows: class counts per feature choose the
features whose presence speaks for a category; the chain is then trained on how many different
words of the document have each.
Scoring is one pass over whole texts, without a shuffle; the model is at most ``FEATURES`` weights
per category.

Defined results: NULL and blank texts get the probabilities of a text without features; repeated
rows get equal ones; labels without a document are ignored; without labelled rows of both
kinds all probabilities are 0; an empty table gives no rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from erpweave.llm.quality_classifier import logistic
from erpweave.llm.worker import Cache, bounded_sample, bucket, focus

SAMPLE_ROWS = 20_000  # bound of the labelled fitting sample
SPACE = 1 << 20
FEATURES = 3_000
SUPPORT = 0.01  # share of a category's documents that a feature must be in
FOLDS = 5
MARKS = b".,;:!?#*$%&|<>\"'()[]"

# Categories in chain order, over the two label columns. The last one is the verdict: it reads a document's own words
# and what the links before it found, which look for abuse in one kind of text each.
CATEGORIES: Mapping[str, str] = {
    "abuse_in_prose": "toxic = 1 AND quality = 1",
    "abuse_in_junk": "toxic = 1 AND quality = 0",
    "abuse": "toxic = 1",
}


def _features(token: bytes) -> tuple[int, ...]:
    word = token.strip(MARKS)
    found = [bucket(b"m" + token[len(word):], SPACE)] if word != token and not token.startswith(word) else []
    if word:
        found += [bucket(b"w" + word, SPACE), *(bucket(b"s" + word[:k], SPACE) for k in (5, 6, 7) if len(word) >= k)]
    return tuple(found)


_FEATURES = Cache(_features, 100_000)


def _present(text: bytes | None) -> set[int]:
    return set().union(*map(_FEATURES.__getitem__, set(text.lower().split()))) if text else set()


def _graded(look, text: bytes | None) -> tuple[np.ndarray, np.ndarray]:
    """Places of the chosen features in a text, and log2(1 + different words with the feature)."""
    hits = list(chain.from_iterable(filter(None, map(look, set(text.lower().split()))))) if text else []
    places, counts = np.unique(np.array(hits, np.int64), return_counts=True)
    return places, np.log2(1.0 + counts)


def _class_counts(n_classes: int):
    """(feature, class, documents) of a partition, one row per feature and class."""

    def count(batches):
        counts = np.zeros((n_classes, SPACE), np.int32)
        for batch in batches:
            for text, kind in zip(batch.column("text").to_pylist(), batch.column("kind").to_pylist(), strict=True):
                counts[kind, list(_present(text))] += 1
        kinds, places = np.nonzero(counts)
        for at in range(0, len(places), 100_000):
            k, p = kinds[at:at + 100_000], places[at:at + 100_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(p, pa.int32()), pa.array(k, pa.int32()), pa.array(counts[k, p], pa.int64())],
                ["feature", "kind", "n"])

    return count


def _chosen_rows(index: dict[int, int]):
    def rows(batches):
        for batch in batches:
            look = lambda token: [index[f] for f in _FEATURES[token] if f in index]
            found = [_graded(look, t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([p for p, _ in found], pa.list_(pa.int32())),
                 pa.array([v for _, v in found], pa.list_(pa.float64())), batch.column("kind"), batch.column("fold")],
                ["places", "values", "kind", "fold"])

    return rows


_HITS: dict[str, Cache] = {}  # of the model in use


class Chain:
    """Feature index and, per category, weights of features and of earlier categories."""

    def __init__(self, names: Sequence[str], index: dict[int, int], models: list[tuple[np.ndarray, float]]):
        self.names, self.index, self.models = tuple(names), index, models
        self.key = uuid.uuid4().hex

    def hits(self, token: bytes) -> tuple[int, ...]:
        """Chosen features of a token; nearly always none."""
        return tuple(self.index[f] for f in _features(token) if f in self.index)

    def probabilities(self, text: bytes | None) -> list[float]:
        if self.key not in _HITS:
            _HITS.clear()
            _HITS[self.key] = Cache(self.hits, 300_000)
        places, values = _graded(_HITS[self.key].__getitem__, text)
        known: list[float] = []
        for w, b in self.models:
            own = len(w) - len(known)
            z = b + float(w[places] @ values) + float(np.dot(w[own:], known))
            known.append(float(1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))))
        return known


def _with_known(place, value, row, known: list[np.ndarray], width: int):
    """Sparse rows with the earlier categories' probabilities as further features."""
    n = len(known[0]) if known else 0
    return (
        np.concatenate([place, *[np.full(n, width + i) for i in range(len(known))]]),
        np.concatenate([value, *known]) if known else value,
        np.concatenate([row, *[np.arange(n)] * len(known)]),
    )


def _predict(model, place, value, row, n: int) -> np.ndarray:
    w, b = model
    return 1.0 / (1.0 + np.exp(-np.clip(np.bincount(row, w[place] * value, n) + b, -30, 30)))


def train(docs: DataFrame, labels: DataFrame, categories: Mapping[str, str] = CATEGORIES, rows: int = SAMPLE_ROWS) -> Chain:
    """Fit the chain on at most about ``rows`` labelled rows."""
    names = list(categories)
    # The combination of categories is one number; every label row has one.
    code = sum((F.coalesce(F.expr(e).cast("int"), F.lit(0)) * (1 << i) for i, e in enumerate(categories.values())), F.lit(0))
    known = labels.groupBy("doc_id").agg(F.max(code).cast("int").alias("kind")).where("doc_id is not null")
    sample = bounded_sample(known, rows, "doc_id")
    fitted = (
        docs.select("doc_id", F.col("text").cast("binary").alias("text"))
        .join(F.broadcast(sample), "doc_id")
        .select("text", "kind", F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(FOLDS)).cast("int").alias("fold"))
    )
    classes = 1 << len(names)
    counted = (
        fitted.mapInArrow(_class_counts(classes), "feature int, kind int, n long")
        .groupBy("feature", "kind").agg(F.sum("n").alias("n")).where(F.col("n") >= 3).toPandas()
    )
    totals = {r["kind"]: r["n"] for r in sample.groupBy("kind").agg(F.count("*").alias("n")).collect()}
    chosen: set[int] = set()
    for i in range(len(names)):
        yes = sum(n for k, n in totals.items() if k >> i & 1)
        no = sum(totals.values()) - yes
        of = counted[counted["kind"].to_numpy() >> i & 1 == 1].groupby("feature")["n"].sum()
        rest = counted[counted["kind"].to_numpy() >> i & 1 == 0].groupby("feature")["n"].sum()
        other = rest.reindex(of.index, fill_value=0)
        odds = np.log((of + 0.5) / (yes + 1.0)) - np.log((other + 0.5) / (no + 1.0))
        strong = (odds * np.sqrt(of))[(odds > 2.0) & (of >= max(6.0, SUPPORT * yes))]
        chosen |= set(strong.nlargest(FEATURES // max(len(names), 1)).index.tolist())
    index = {int(f): j for j, f in enumerate(sorted(chosen))}
    got = fitted.mapInArrow(_chosen_rows(index), "places array<int>, values array<double>, kind int, fold int").toArrow()
    kinds, folds = got["kind"].to_numpy(), got["fold"].to_numpy()
    if not got.num_rows or not index:
        return Chain(names, {}, [(np.zeros(i), -30.0) for i in range(len(names))])
    lists = got["places"].combine_chunks()
    lengths = np.diff(lists.offsets.to_numpy())
    place, row = lists.flatten().to_numpy().astype(np.int64), np.repeat(np.arange(len(lengths)), lengths)
    value, n = got["values"].combine_chunks().flatten().to_numpy(), len(kinds)
    models, known_p = [], []
    for i in range(len(names)):
        y = (kinds >> i & 1).astype(float)
        p, v, r = _with_known(place, value, row, known_p, len(index))
        width = len(index) + len(known_p)
        held = np.zeros(n)
        for fold in range(FOLDS):
            inside = folds != fold
            number = np.cumsum(inside) - 1
            use = inside[r]
            model = logistic(p[use], v[use], number[r[use]], y[inside], width, rate=1.0, decay=1e-5)
            held[~inside] = _predict(model, p, v, r, n)[~inside]
        models.append(logistic(p, v, r, y, width, rate=1.0, decay=1e-5))
        known_p.append(held)
    return Chain(names, index, models)


def scorer(chain: Chain):
    """Arrow UDF: struct of probabilities of a binary text, in chain order."""

    @F.arrow_udf(", ".join(f"{name} double" for name in chain.names))
    def score(texts: pa.Array) -> pa.Array:
        focus(*_HITS.values())
        rows = [chain.probabilities(t) for t in texts.to_pylist()]
        columns = [pa.array([r[i] for r in rows], pa.float64()) for i in range(len(chain.names))]
        return pa.StructArray.from_arrays(columns, list(chain.names))

    return score


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, toxic and the probability of every category for each row of ``docs``.

    ``toxic`` is the verdict of the chain's last link, which reads the probabilities of all links before it.
    """
    model = train(docs, labels, rows=rows)
    scores: Column = scorer(model)(F.col("text").cast("binary"))
    scored = docs.select("doc_id", scores.alias("p"))
    return scored.select(
        "doc_id", (F.col(f"p.{model.names[-1]}") >= threshold).alias("toxic"),
        *[F.col(f"p.{name}").alias(f"p_{name}") for name in model.names],
    )
