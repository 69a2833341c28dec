"""Spelling variants grouped with a frequency-vector trie.

Words (letter runs, A-Z lower-cased, seen often enough) become vectors of letter counts: the letters are dealt to
``GROUPS`` groups of like weight, and a word's place in the trie is its count in each group, one level after the other. One edit
changes at most one count up and one down, so the words near a word lie at leaves that a search from the root reaches
while it spends a budget of one surplus and one deficit. Leaf words are verified letter by letter.

The trie is not built in one place. It starts as one subtree; a subtree of more than ``LIMIT`` words is cut at its next ``STEP`` levels, again
and again. Its words stay in their part and ask in the other parts the budget reaches, each pair of parts in one direction, so a
pair of words meets once. A leaf still above the limit is cut by the half of the word that one edit leaves alone. A subtree asked by
very many is copied to several tasks that share the askers. A task searches its subtree with all its askers at once: two tries
are walked together, so words of one prefix share the way.

Every word keeps its nearest-by-count form only, combined before the shuffle; roots follow forms by pointer doubling over
the stored table, and end because a form is at least ``RATIO`` times as frequent as the word.

Defined results: NULL and empty texts have no words; a NULL id counts as an empty one in the checksum; repeated rows count each
time; an empty table gives no rows; further columns do not matter.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from erpweave.llm.worker import focus
from erpweave.session import materialize

RUN = "[a-zÀ-ÿ]"
LETTERS = "abcdefghijklmnopqrstuvwxyz" + "".join(map(chr, range(0xC0, 0x100)))
MIN_LENGTH, MIN_COUNT, RATIO, EVERY = 6, 5, 5, 199
GROUPS, STEP, LIMIT = 12, 3, 20_000
HELD = 300_000  # distinct words a task adds up before it sends them on
_SUBTREE = "word string, n long, counts binary, block binary, left int"
_NEAR = "word string, n_near long, best struct<below: long, word: string>"


def _occurrences(min_length: int, every: int):
    runs = re.compile(RUN + "{%d,}" % min_length)

    def send(held: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])

    def run(batches):
        focus()
        held: Counter = Counter()
        for batch in batches:
            for key, text in zip(batch.column("id").to_pylist(), batch.column("text"), strict=True):
                start = zlib.crc32(f"{key}:".encode())
                for word, n in Counter(runs.findall(text.as_py().lower().decode())).items():
                    h = zlib.crc32(word.encode(), start)
                    if h % every == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1:]
                        if len(word) < min_length:
                            continue
                    held[word] += n
                if len(held) > HELD:
                    yield send(held)
                    held = Counter()
        yield send(held)

    return run


def vocabulary(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, every: int = EVERY) -> DataFrame:
    """word, n: letter runs of all texts with at least ``min_length`` code points and ``min_count`` occurrences.

    A run whose checksum with the document id ``every`` divides loses one code point first.
    """
    # Only A-Z are lower-cased: that is what lowering UTF-8 bytes does.
    texts = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
                        F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))
    counted = texts.mapInArrow(_occurrences(min_length, every), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def letter_groups(words: DataFrame, groups: int = GROUPS) -> dict[str, int]:
    """Group of every letter: letters by falling frequency are dealt back and forth over the groups."""
    letters = words.select(F.explode(F.split("word", "")).alias("letter")).groupBy("letter").count()
    found = dict(letters.where(F.col("letter").isin(*LETTERS)).collect())  # as many rows as letters at most
    ordered = sorted(LETTERS, key=lambda c: (-found.get(c, 0), c))
    return {c: (i % groups if i // groups % 2 == 0 else groups - 1 - i % groups) for i, c in enumerate(ordered)}


def reached(counts: bytes, start: int, stop: int, surplus: int, deficit: int) -> list[tuple[bytes, int, int]]:
    """Ways from level ``start`` to ``stop`` that ``counts`` may go within its budget, with what is left of it."""
    ways = [(b"", surplus, deficit)]
    for c in counts[start:stop]:
        longer = []
        for way, more, less in ways:
            longer.append((way + bytes([c]), more, less))
            if more and c < 255:
                longer.append((way + bytes([c + 1]), 0, less))
            if less and c:
                longer.append((way + bytes([c - 1]), more, 0))
        ways = longer
    return ways


def _cut(groups: int, step: int):
    """Members stay in their part of a subtree and ask in later parts; askers go on to all they reach."""
    def run(batches):
        for batch in batches:
            out: list[tuple] = []
            for word, n, counts, block, left in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                depth = len(block)
                stop = min(depth + step, groups)
                if left < 0:
                    own = counts[depth:stop]
                    out.append((word, n, counts, block + own, -1))
                    out.extend((word, n, counts, block + way, more + 2 * less)
                               for way, more, less in reached(counts, depth, stop, 1, 1) if way > own)
                else:
                    out.extend((word, n, counts, block + way, more + 2 * less)
                               for way, more, less in reached(counts, depth, stop, left & 1, left >> 1))
            yield _rows(out)

    return run


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (("word", pa.string()), ("n", pa.int64()), ("counts", pa.binary()), ("block", pa.binary()), ("left", pa.int32()))
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, (_, t) in enumerate(kinds)], [k for k, _ in kinds])


def halves(word: str, shorter: int) -> tuple[str, str]:
    """The beginning and the end of a word, one of which it shares with a near word; ``shorter`` is the lesser length of both."""
    h = shorter // 2
    return word[:h], word[len(word) - (shorter - h):]


def _cut_leaf(batches):
    """Parts of an over-full leaf: words that share a beginning or an end."""
    for batch in batches:
        out: list[tuple] = []
        for word, n, counts, block, left in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            length = sum(block)  # of the leaf's words
            lengths = (length, length - 1) if left < 0 else (min(length, len(word)),)
            for shorter in lengths:
                for side, half in zip(b"PS", halves(word, shorter), strict=True):
                    key = block + bytes([side]) + shorter.to_bytes(4, "big") + half.encode()
                    out.append((word, n, counts, key, left))
        yield _rows(out)


def near(u: str, v: str) -> bool:
    """Exactly one code point inserted, deleted or replaced."""
    if len(u) > len(v):
        u, v = v, u
    if len(v) - len(u) > 1 or u == v:
        return False
    at = next((i for i, (a, b) in enumerate(zip(u, v, strict=False)) if a != b), len(u))
    return u[at + (len(u) == len(v)):] == v[at + 1:]


def near_pairs(asked: list[str], asking: list[str]):
    """Near pairs (asked, asking) of two leaves: few words are compared, many meet by what one deletion leaves."""
    if len(asked) * len(asking) <= 8 * (len(asked) + len(asking)):
        for u in asking:
            begin, end = u[:3], u[-3:]
            for v in asked:
                # One edit leaves three code points at one end alone, in words of six or more.
                if (v[:3] == begin or v[-3:] == end or len(u) < 6 or len(v) < 6) and near(u, v):
                    yield v, u
        return
    words, without, anywhere = set(asked), defaultdict(list), defaultdict(set)
    for v in asked:
        for i in range(len(v)):
            short = v[:i] + v[i + 1:]
            without[i, short].append(v)
            anywhere[short].add(v)
    for u in asking:
        found = set(anywhere.get(u, ()))
        for i in range(len(u)):
            short = u[:i] + u[i + 1:]
            found.update(v for v in without.get((i, short), ()) if v != u)
            if short in words:
                found.add(short)
        for v in found:
            yield v, u


def _trie(rows: list[tuple[bytes, str]], depth: int) -> dict | list:
    """Nested counts of the levels from ``depth`` on, with word lists at the leaves."""
    if rows and depth >= len(rows[0][0]):
        return [word for _, word in rows]
    root: dict = {}
    for counts, word in rows:
        node = root
        for c in counts[depth:-1]:
            node = node.setdefault(c, {})
        node.setdefault(counts[-1], []).append(word)
    return root


def _walk(asked, asking, surplus: int, deficit: int):
    """Leaf pairs of two subtries that the budget allows."""
    if isinstance(asked, list):
        yield asked, asking
        return
    for c, child in asking.items():
        if c in asked:
            yield from _walk(asked[c], child, surplus, deficit)
        if surplus and c + 1 in asked:
            yield from _walk(asked[c + 1], child, 0, deficit)
        if deficit and c - 1 in asked:
            yield from _walk(asked[c - 1], child, surplus, 0)


def _search(groups: int):
    """One subtree: its words among themselves and with those that ask."""
    def run(table: pa.Table) -> pa.Table:
        rows = list(zip(*(table.column(c).to_pylist() for c in ("word", "n", "counts", "block", "left", "piece")), strict=True))
        block, first = rows[0][3], rows[0][5] == 0
        depth, half = min(len(block), groups), block[groups:]
        shorter = int.from_bytes(half[1:5], "big")
        size = {r[0]: r[1] for r in rows}
        sides: dict[int, list] = defaultdict(list)
        for word, _, counts, _, left, _ in rows:
            sides[left].append((counts, word))
        members = sides.pop(-1, [])
        found: dict[str, list] = {}  # word: [number of near words, (-n, word) of the best]

        def add(word: str, other: str) -> None:
            entry = found.setdefault(word, [0, (1, "")])
            entry[0] += 1
            entry[1] = min(entry[1], (-size[other], other))

        def meet(left: int, own: bool, asking: list) -> None:
            for leaf, askers in _walk(_trie(members, depth), _trie(asking, depth), left & 1, left >> 1):
                for v, u in near_pairs(leaf, askers):
                    if own and v > u:
                        continue  # met from its other side
                    if half[:1] == b"S" and halves(u, shorter)[0] == halves(v, shorter)[0]:
                        continue  # met by the beginning
                    add(u, v)
                    add(v, u)

        if members:
            if first and (not half or shorter == sum(block[:groups])):
                meet(3, True, members)
            for left, asking in sides.items():
                meet(left, False, asking)
        best = pa.StructArray.from_arrays(
            [pa.array([e[1][0] for e in found.values()], pa.int64()), pa.array([e[1][1] for e in found.values()], pa.string())], ["below", "word"])
        return pa.table({"word": pa.array(list(found), pa.string()), "n_near": pa.array([e[0] for e in found.values()], pa.int64()), "best": best})

    return run


def near_words(words: DataFrame, groups: int = GROUPS, step: int = STEP, limit: int = LIMIT) -> DataFrame:
    """word, n_near and best (its near word of largest n, ties to the smallest) for every word that has near words."""
    spark = words.sparkSession
    dealt = letter_groups(words, groups)

    @F.arrow_udf("binary")
    def vector(texts: pa.Array) -> pa.Array:
        out = []
        for word in texts.to_pylist():
            counts = [0] * groups
            for c in word:
                counts[dealt[c]] += 1
            out.append(bytes(min(c, 255) for c in counts))
        return pa.array(out, pa.binary())

    member, closed, pieces = F.col("left") < 0, [], []
    rows = words.select("word", "n", vector("word").alias("counts"), F.lit(b"").alias("block"), F.lit(-1).alias("left"))
    for cut in [_cut(groups, step)] * -(-groups // step) + [_cut_leaf, None]:
        sizes = rows.groupBy("block").agg(F.count_if(member).alias("held"), F.count_if(~member).alias("asking"))
        # Parts without words of their own answer nothing.
        sized = rows.join(sizes.where("held > 0 AND held + asking > 1"), "block")
        rows = materialize(sized.withColumn("over", F.col("held") > limit), "spelling-subtrees")
        closed.append(rows if cut is None else rows.where("NOT over"))
        if cut is None or rows.where("over").limit(1).count() == 0:
            break
        rows = rows.where("over").select("word", "n", "counts", "block", "left").mapInArrow(cut, _SUBTREE)
    for part in closed:
        tasks = F.ceil(F.col("asking") / F.lit(4 * limit)).cast("int")
        tasks = F.greatest(tasks, F.lit(1))
        to = F.when(member, F.sequence(F.lit(0), tasks - 1)).otherwise(F.array(F.pmod(F.xxhash64("word"), tasks).cast("int")))
        pieces.append(part.select("word", "n", "counts", "block", "left", F.explode(to).alias("piece")))
    every = pieces[0]
    for part in pieces[1:]:
        every = every.unionByName(part)
    found = every.groupBy("block", "piece").applyInArrow(_search(groups), _NEAR)
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min("best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """word, root of a table of word, form in which following forms ends: the pointers double every round."""
    pointers = forms.select("word", F.col("form").alias("root"))
    while True:
        pointers = materialize(pointers, "spelling-roots")
        beyond = pointers.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if pointers.join(beyond, "root", "left_semi").limit(1).count() == 0:
            return pointers
        pointers = pointers.join(beyond, "root", "left").select("word", F.coalesce("next", "root").alias("root"))


def variants(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, every: int = EVERY,
             ratio: int = RATIO, limit: int = LIMIT) -> DataFrame:
    """word, form, root, n, n_near, form_n for every word of the vocabulary of ``docs``."""
    words = materialize(vocabulary(docs, min_length, min_count, every), "spelling-words")
    near_n = -F.col("best.below")
    fits = near_n >= ratio * F.col("n")
    joined = words.join(near_words(words, limit=limit), "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(fits, F.col("best.word")).alias("form"), F.when(fits, near_n).alias("form_n"))
    table = materialize(joined, "spelling-forms")
    ends = roots(table.where("form IS NOT NULL"))
    return table.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
