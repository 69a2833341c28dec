"""Personal data by a skip-chain conditional random field over the mentions of a document.

Base spans come from fixed patterns with their checks. The field adds mentions that the patterns miss
and that the document itself identifies: a number or address that repeats, or nearly repeats, one
found elsewhere in the text in another notation.

Nodes are the mentions of a document: base spans, whose label is observed, and number-like or
at-like runs, whose label is open. Words without a digit or an at sign can only be "none", so they
separate the chain and need no node. Edges are the chain between neighbours and skip edges
between distant mentions with the same content ("equal") or the same ending ("similar"); each
mention is linked to the last one before it with the same key, so a value repeated n times has
n - 1 edges, not all pairs. Loopy sum-product passes messages over both kinds of edges; an open mention
becomes a span when the marginal of a kind reaches ``THRESHOLD`` and a skip edge ties it to others.

Node and chain weights are fitted on a bounded sample of documents, with base labels as distant
supervision; whatever a pattern check decides (check digits, the plus sign) is no node feature, so the
field cannot merely learn the patterns back.

Defined results: NULL text is empty, without spans; repeated rows get equal results; an empty table gives
no rows; texts are read whole, in time linear in their length.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from erpweave.llm.worker import bounded_sample, bucket, focus

# Kinds in the order they are listed.
KINDS = ("email", "ip", "card", "phone")
NONE = len(KINDS)
LABELS = len(KINDS) + 1
SAMPLE_ROWS = 20_000  # bound of the fitting sample
SPACE = 4096
ROUNDS = 12
THRESHOLD = 0.9

_ANY = re.compile(r"[0-9@]")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NUMBER = re.compile(r"(?<![0-9A-Za-z.])\(?[0-9][0-9 ().\-/]*[0-9](?![0-9A-Za-z])")
_AT = re.compile(r"[A-Za-z0-9._%+-]+ ?(?:\(at\)|\[at\]|@) ?[A-Za-z0-9-]+(?: ?(?:\.|\(dot\)|\[dot\]) ?[A-Za-z0-9-]+)*")


def _luhn(digits: str) -> bool:
    total = 0
    for i, ch in enumerate(reversed(digits)):
        d = int(ch)
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches of local part, at sign and dotted domain, found from the at signs outwards."""
    found, end = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > end and _LOCAL.match(text[start - 1]):
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at and at >= end else None
        if domain:
            found.append((start, domain.end()))
            end = domain.end()
        at = text.find("@", max(at + 1, end))
    return found


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) by kind, then start."""
    if not _ANY.search(text):
        return []
    spans = [(0, a, b) for a, b in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part[-4:]) <= 255 for part in m[0].split(".")):
            spans.append((1, *m.span()))
    for m in _CARD.finditer(text):
        digits = _digits(m[0])
        if 13 <= len(digits) <= 19 and _luhn(digits):
            spans.append((2, *m.span()))
    for m in _PHONE.finditer(text):
        if 9 <= len(_digits(m[0])) <= 15:
            spans.append((3, *m.span()))
    return spans


def _open_mentions(text: str, spans: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Number-like and at-like runs that touch no base span."""
    taken = sorted((a, b) for _, a, b in spans)
    starts, reach, top = [a for a, _ in taken], [], 0
    for _, b in taken:
        top = max(top, b)
        reach.append(top)
    free = []
    for pattern in (_AT, _NUMBER):
        for m in pattern.finditer(text):
            a, b = m.span()
            if pattern is _NUMBER and len(_digits(m[0])) < 7:
                continue
            i = bisect_right(starts, b - 1) - 1
            if i < 0 or reach[i] <= a:
                free.append((a, b))
    free.sort()
    kept: list[tuple[int, int]] = []
    for a, b in free:
        if not kept or a >= kept[-1][1]:
            kept.append((a, b))
    return kept


def _key(mention: str) -> tuple[str, str]:
    """What makes two mentions equal, and what makes them similar."""
    if "@" in mention or "at)" in mention or "at]" in mention:
        plain = re.sub(r" ?(?:\(at\)|\[at\]|@) ?", "@", mention)
        plain = re.sub(r" ?(?:\(dot\)|\[dot\]) ?", ".", plain).lower().replace(" ", "")
        return plain, plain.split("@")[0]
    digits = _digits(mention)
    return digits, digits[-9:]


def _features(text: str, start: int, end: int) -> list[int]:
    """Hashed node features: size, grouping and the words around; none that a pattern check decides."""
    mention = text[start:end]
    groups = [str(min(len(g), 6)) for g in re.split(r"[^0-9]+", mention) if g]
    before = text[max(0, start - 24):start].split()
    names = [
        f"at{'@' in mention}", f"n{min(len(_digits(mention)), 20)}", f"g{'-'.join(groups[:6])}",
        f"dots{min(mention.count('.'), 4)}", f"before{before[-1].lower() if before else ''}",
    ]
    return sorted({bucket(n.encode(), SPACE) for n in names})


class Graph:
    """Nodes and edges of one document."""

    def __init__(self, text: str):
        self.spans = base_spans(text)
        free = _open_mentions(text, self.spans)
        nodes = sorted([(a, b, k) for k, a, b in self.spans] + [(a, b, -1) for a, b in free])
        self.nodes = nodes
        self.features = [_features(text, a, b) for a, b, _ in nodes]
        self.chain = [(i, i + 1) for i in range(len(nodes) - 1)
                      if nodes[i + 1][0] - nodes[i][1] < 80 and "\n" not in text[nodes[i][1]:nodes[i + 1][0]]]
        self.equal, self.similar = [], []
        last: tuple[dict, dict] = ({}, {})
        for i, (a, b, _) in enumerate(nodes):
            for place, key, edges in zip(last, _key(text[a:b]), (self.equal, self.similar), strict=True):
                if len(key) >= 5:
                    if key in place:
                        edges.append((place[key], i))
                    place[key] = i
        same = set(self.equal)
        self.similar = [e for e in self.similar if e not in same]
        self.tied = {i for e in (*self.equal, *self.similar) for i in e}


class Field:
    """Weights: node weights [SPACE, LABELS] and log potentials of the three edge kinds [LABELS, LABELS]."""

    def __init__(self, node: np.ndarray, bias: np.ndarray, chain: np.ndarray, equal: np.ndarray, similar: np.ndarray):
        self.node, self.bias, self.chain, self.equal, self.similar = node, bias, chain, equal, similar

    def marginals(self, graph: Graph) -> np.ndarray:
        """Loopy sum-product with synchronous, damped messages in the log domain."""
        n = len(graph.nodes)
        unary = np.stack([self.node[f].sum(axis=0) for f in graph.features]) + self.bias
        for i, (_, _, kind) in enumerate(graph.nodes):
            if kind >= 0:
                unary[i] = -50.0
                unary[i, kind] = 0.0
        pairs = [(e, w) for w, es in ((self.chain, graph.chain), (self.equal, graph.equal), (self.similar, graph.similar))
                 for e in es]
        if pairs:
            source = np.array([e[0] for e, _ in pairs] + [e[1] for e, _ in pairs])
            target = np.array([e[1] for e, _ in pairs] + [e[0] for e, _ in pairs])
            tables = np.stack([w for _, w in pairs] + [w.T for _, w in pairs])
            back = np.concatenate([np.arange(len(pairs), 2 * len(pairs)), np.arange(len(pairs))])
            messages = np.zeros((len(source), LABELS))
            for _ in range(ROUNDS):
                inbox = np.zeros((n, LABELS))
                np.add.at(inbox, target, messages)
                outgoing = (unary + inbox)[source] - messages[back]
                fresh = np.logaddexp.reduce(outgoing[:, :, None] + tables, axis=1)
                fresh -= np.logaddexp.reduce(fresh, axis=1, keepdims=True)
                messages = 0.5 * messages + 0.5 * fresh
            inbox = np.zeros((n, LABELS))
            np.add.at(inbox, target, messages)
            unary = unary + inbox
        unary -= unary.max(axis=1, keepdims=True)
        p = np.exp(unary)
        return p / p.sum(axis=1, keepdims=True)

    def spans(self, text: str | None) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
        """Base spans, and all spans in the same order."""
        if not text or not _ANY.search(text):
            return [], []
        graph = Graph(text)
        base = graph.spans
        # Open mentions are judged where they are tied, to observed ones or to each other.
        if not any(graph.nodes[i][2] < 0 for i in graph.tied):
            return base, base
        p = self.marginals(graph)
        added = [(int(p[i, :NONE].argmax()), a, b) for i, (a, b, kind) in enumerate(graph.nodes)
                 if kind < 0 and i in graph.tied and p[i, :NONE].max() >= THRESHOLD]
        return base, sorted(base + added)


def _examples(batches):
    """Per document: features and label of every node; label pairs of neighbouring nodes."""
    for batch in batches:
        out: dict[str, list] = {"features": [], "label": [], "pair": []}
        for text in batch.column("text").to_pylist():
            if not text or not _ANY.search(text):
                continue
            graph = Graph(text)
            label = [k if k >= 0 else NONE for _, _, k in graph.nodes]
            for f, y in zip(graph.features, label, strict=True):
                out["features"].append(f), out["label"].append(y), out["pair"].append(-1)
            for (a, b), n in Counter((label[i], label[j]) for i, j in graph.chain).items():
                out["features"].append([n]), out["label"].append(-1), out["pair"].append(a * LABELS + b)
        yield pa.RecordBatch.from_arrays(
            [pa.array(out["features"], pa.list_(pa.int32())), pa.array(out["label"], pa.int32()),
             pa.array(out["pair"], pa.int32())], ["features", "label", "pair"])


def train(docs: DataFrame, rows: int = SAMPLE_ROWS) -> Field:
    """Node and chain weights by distant supervision on a bounded sample of ``docs``.

    Skip potentials are fixed: they state the consistency that the field is there for.
    """
    sample = bounded_sample(docs.where(F.regexp_like("text", F.lit("[0-9@]"))).select("doc_id", "text"), rows, "doc_id")
    got = (
        sample.select("text").mapInArrow(_examples, "features array<int>, label int, pair int")
        .groupBy("features", "label", "pair").agg(F.count("*").alias("n")).toPandas()
    )
    nodes = got[got["label"] >= 0]
    seen = np.full((SPACE, LABELS), 0.0)
    base = np.bincount(nodes["label"], nodes["n"], LABELS) + 1.0
    for features, label, n in zip(nodes["features"], nodes["label"], nodes["n"], strict=True):
        seen[np.asarray(features, int), label] += n
    # Class-conditional weights, shrunk to the class shares; few features, so half their sum is enough.
    share = base / base.sum()
    node = 0.5 * (np.log(seen + 4.0 * share) - np.log(seen.sum(axis=1, keepdims=True) + 4.0) - np.log(share))
    # The share of open mentions that are personal data is unknown; the prior does not decide.
    bias = np.log(np.maximum(share, 0.05))
    pairs = np.ones((LABELS, LABELS))
    for features, pair, n in zip(*(got[got["label"] < 0][c] for c in ("features", "pair", "n")), strict=True):
        pairs[divmod(int(pair), LABELS)] += features[0] * n
    together = pairs / pairs.sum()
    chain = 0.25 * np.log(together / (together.sum(1, keepdims=True) * together.sum(0, keepdims=True)))
    return Field(node, bias, chain, 6.0 * np.eye(LABELS), 3.0 * np.eye(LABELS))


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


def finder(field: Field):
    """Arrow UDF: counts of base spans, their hash and all spans of a text."""

    @F.arrow_udf("n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")
    def find(texts: pa.Array) -> pa.Array:
        counts: list[list[int]] = [[] for _ in KINDS]
        hashes, spans = [], []
        focus()
        for text in texts.to_pylist():
            base, every = field.spans(text)
            for k, column in enumerate(counts):
                column.append(sum(s[0] == k for s in base))
            hashes.append(hashlib.sha256(_joined(base).encode()).hexdigest())
            spans.append(_joined(every))
        return pa.StructArray.from_arrays(
            [*(pa.array(c, pa.int64()) for c in counts), pa.array(hashes, pa.string()), pa.array(spans, pa.string())],
            ["n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"])

    return find


def find_pii(docs: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id with the spans of every row."""
    found: Column = finder(train(docs, rows))(F.col("text"))
    return docs.select("doc_id", found.alias("f")).select("doc_id", "f.*")


def masked_text(text: str, spans: list[tuple[int, int, int]]) -> str:
    """Every span replaced by its kind; of overlapping spans the first, longest names the kind."""
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], f"[{KINDS[kind]}]"]
            at = b
        else:
            at = max(at, b)
    return "".join([*out, text[at:]])


def mask_pii(docs: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """``docs`` with every span masked and ``n_chars``, where there is one, counted again; columns unchanged."""
    field = train(docs, rows)

    @F.arrow_udf("string")
    def mask(texts: pa.Array) -> pa.Array:
        focus()
        return pa.array([t if t is None else masked_text(t, field.spans(t)[1]) for t in texts.to_pylist()], pa.string())

    masked = docs.withColumn("text", mask(F.col("text")))
    if "n_chars" in docs.columns:
        masked = masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return masked
