"""N-gram Jaccard join: documents whose word 5-gram sets are alike, and their components.

Rare-first prefix filtering. The shingles of a document are ordered by corpus frequency, rarest first; two sets
with Jaccard similarity t or more share a shingle among their first n - ceil(t n) + 1. Only these
prefixes are shuffled, by shingle, and lists of one document end there. Length and positional filters
act inside the lists, a suffix filter (parities of hash classes, about one per shingle, bound the overlap) on
the distinct pairs, and what is left is verified once, on whole sets, read from the texts asked for.

The frequency order needs no join: documents per hash bucket of shingles are counted over the whole
corpus into a table of fixed size, and a shingle is ranked by its bucket. Any fixed order gives
right results; shared buckets only make a rare shingle look less rare.

Equal sets are one node from the start, so groups of copies cost one row. Inside a list not all pairs
are formed: first every entry meets only the entry before it and a head, the entry so far that has
fewest rarer shingles, which of near copies is the one nearest to what they were copied from; verified
pairs are contracted to components; then only pairs of different components are left. If lists still
hold many of these, the meeting is repeated in other orders, as long as it contracts, before the rest is
paired exhaustively.
So no link between components is lost, and a large group of near copies costs a few rows per member.

Verified are sets of 40-bit hashes of the shingles (two different shingles of a pair of 600 coincide with
probability 2e-7); nodes are known by 64-bit hashes of their sets.

Defined results: NULL and blank texts have no shingles and are a component of their own; texts of fewer
words than a shingle have one shingle; repeated rows are rows of one node; an empty table gives no rows.
"""

from __future__ import annotations

import itertools
import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from erpweave.llm.components import components
from erpweave.llm.worker import focus, release
from erpweave.session import materialize

SHINGLE = 5
PERCENT = 80  # Jaccard similarity of linked documents, in percent
RANK_BITS = 20  # buckets of the frequency table
NEED_BITS = 24  # buckets of the table of sets that verification needs
BLOCK = 4096
BLOCKS = "block int, data binary"
MEETINGS = 5  # rounds of meetings at most
MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def _mix(h: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes (shift-multiply), so that any bits of them are uniform."""
    h = (h ^ (h >> np.uint64(30))) * MIX[1]
    h = (h ^ (h >> np.uint64(27))) * MIX[2]
    return h ^ (h >> np.uint64(31))


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[bytes], np.ndarray]:
    """Hash of every word (A-Z lower-cased, between ASCII blanks) of all texts behind one another.

    Words are split and numbered by Arrow; only distinct ones are hashed. Returns the hashes, the ends of
    the texts, the distinct words and the word numbers.
    """
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    words = lists.flatten().dictionary_encode()
    distinct = words.dictionary.cast(pa.binary()).to_pylist()
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, distinct), np.uint64, len(distinct))
    numbers = words.indices.to_numpy()
    ends = lists.offsets.to_numpy() - lists.offsets[0].as_py()
    if b"" in distinct:  # blanks at the ends of a text
        real = numbers != distinct.index(b"")
        ends = np.concatenate([[0], np.cumsum(real)])[ends]
        numbers = numbers[real]
    return hashes[numbers], ends, distinct, numbers


def shingle_sets(texts: pa.Array) -> list[np.ndarray]:
    """Sorted distinct hashes of every text's shingles; all texts are hashed as one array."""
    w, ends, distinct, numbers = word_hashes(texts)
    h = np.zeros(max(len(w) - SHINGLE + 1, 0), np.uint64)
    for k in range(SHINGLE if len(h) else 0):
        h = h * MIX[0] + w[k:len(w) - SHINGLE + 1 + k]
    h = _mix(h)
    out = []
    for a, b in itertools.pairwise(ends.tolist()):
        if b - a >= SHINGLE:
            s = np.sort(h[a:b - SHINGLE + 1])
            out.append(s[np.concatenate([[True], s[1:] != s[:-1]])])
        elif b > a:
            whole = b" ".join(distinct[i] for i in numbers[a:b].tolist())
            out.append(np.array([xxhash.xxh64_intdigest(whole, seed=1)], np.uint64))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def node(hashes: np.ndarray) -> int:
    """Signed 64-bit hash of a set."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(hashes.tobytes())).astype(np.int64))


def _slices(batches, size: int = 2_000_000) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Parts of the batches with some megabytes of text, and their shingle sets."""
    focus()
    for batch in batches:
        lengths = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy())
        start = 0
        while start < batch.num_rows:
            before = lengths[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(lengths, before + size, side="right")))
            part = batch.slice(start, stop - start)
            yield part, shingle_sets(part.column("text"))
            start = stop
    release()


class Buckets:
    """Counts per hash bucket, in compressed blocks: of one task while it reads, and added up over tasks."""

    def __init__(self, bits: int):
        self.shift, self.table = np.uint64(64 - bits), np.zeros(1 << bits, np.uint32)

    def add(self, hashes: np.ndarray) -> None:
        np.add.at(self.table, (hashes >> self.shift).astype(np.int64), np.uint32(1))

    def blocks(self) -> Iterator[tuple[int, bytes]]:
        for block in range(len(self.table) // BLOCK):
            part = self.table[block * BLOCK:(block + 1) * BLOCK]
            if part.any():
                yield block, zlib.compress(part.tobytes(), 1)


def _add_blocks(batches):
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, data in zip(batch.column("block").to_pylist(), batch.column("data"), strict=True):
            part = np.frombuffer(zlib.decompress(data.as_py()), np.uint32)
            sums[block] = sums.get(block, 0) + part.astype(np.uint64)
    for block, part in sums.items():
        total = np.minimum(part, 0xFFFFFFFF).astype(np.uint32)
        yield pa.RecordBatch.from_arrays(
            [pa.array([block], pa.int32()), pa.array([zlib.compress(total.tobytes(), 1)], pa.binary())], ["block", "data"])


def bucket_table(blocks: DataFrame, bits: int) -> np.ndarray:
    """The sum of ``blocks(block, data)`` on the driver: 2 ** bits counts, whatever the data."""
    total = blocks.repartition("block").mapInArrow(_add_blocks, BLOCKS).toArrow()
    table = np.zeros(1 << bits, np.uint32)
    for block, data in zip(total["block"].to_pylist(), total["data"], strict=True):
        table[block * BLOCK:(block + 1) * BLOCK] = np.frombuffer(zlib.decompress(data.as_py()), np.uint32)
    return table


def sketch(hashes: np.ndarray) -> bytes:
    """Bit k: is the number of shingles in hash class k odd? A power of two of classes, one or two a shingle."""
    classes = max(64, 1 << (len(hashes) - 1).bit_length())
    counts = np.bincount((hashes & np.uint64(classes - 1)).astype(np.int64), minlength=classes)
    return np.packbits((counts & 1).astype(bool)).tobytes()


def apart(a: bytes, b: bytes) -> int:
    """Least number of shingles in one of two sets only, by their sketches; the longer one is folded."""
    x, y = sorted((np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)), key=len)
    while len(y) > len(x):
        y = y[:len(y) // 2] ^ y[len(y) // 2:]
    return int(np.bitwise_count(x ^ y).sum())


def _sets(id_type: pa.DataType):
    """One reading of the texts: (doc_id, node, n, sketch) of every document, then the task's shingle counts."""
    names = ["doc_id", "node", "n", "sketch", "block", "data"]

    def run(batches):
        counts = Buckets(RANK_BITS)
        for part, sets in _slices(batches):
            none = pa.nulls(len(sets))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array([node(s) if len(s) else None for s in sets], pa.int64()),
                 pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([sketch(s) if len(s) else None for s in sets], pa.binary()),
                 none.cast(pa.int32()), none.cast(pa.binary())], names)
            counts.add(np.concatenate(sets))
        for block, data in counts.blocks():
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(1, id_type), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()),
                 pa.array([block], pa.int32()), pa.array([data], pa.binary())], names)

    return run


def _set_bits(places) -> Iterator[pa.RecordBatch]:
    """The bits at the places that a task has seen, as compressed blocks."""
    seen = np.zeros(1 << NEED_BITS, bool)
    for at in places:
        seen[at] = True
    bits = np.packbits(seen)
    for block in range(len(bits) // BLOCK):
        part = bits[block * BLOCK:(block + 1) * BLOCK]
        if part.any():
            yield pa.RecordBatch.from_arrays(
                [pa.array([block], pa.int32()), pa.array([zlib.compress(part.tobytes(), 1)], pa.binary())], ["block", "data"])


def _node_bits(batches):
    return _set_bits(_need_bucket(batch.column("node").to_numpy()) for batch in batches)


def _asked_ids(need: np.ndarray):
    """Bits of the id buckets of rows whose node falls into a bucket of ``need``."""
    return lambda batches: _set_bits(batch.column("bucket").to_numpy() for batch in _among(need)(batches))


def _or_blocks(batches):
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, data in zip(batch.column("block").to_pylist(), batch.column("data"), strict=True):
            sums[block] = sums.get(block, 0) | np.frombuffer(zlib.decompress(data.as_py()), np.uint8)
    for block, part in sums.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([block], pa.int32()), pa.array([zlib.compress(part.tobytes(), 1)], pa.binary())], ["block", "data"])


def _need_bucket(nodes: np.ndarray) -> np.ndarray:
    return (_mix(nodes.astype(np.uint64)) >> np.uint64(64 - NEED_BITS)).astype(np.int64)


def bit_table(blocks: DataFrame) -> np.ndarray:
    """The union of ``blocks(block, data)`` on the driver: 2 ** NEED_BITS / 8 bytes, whatever the data."""
    found = blocks.repartition("block").mapInArrow(_or_blocks, BLOCKS).toArrow()
    bits = np.zeros((1 << NEED_BITS) // 8, np.uint8)
    for block, data in zip(found["block"].to_pylist(), found["data"], strict=True):
        bits[block * BLOCK:(block + 1) * BLOCK] = np.frombuffer(zlib.decompress(data.as_py()), np.uint8)
    return bits


def need_bits(nodes: DataFrame) -> np.ndarray:
    """Bits of the buckets that ``nodes`` fall into."""
    return bit_table(nodes.mapInArrow(_node_bits, BLOCKS))


def prefix_length(n: int) -> int:
    return n - -(-PERCENT * n // 100) + 1


def _prefixes(ranks: np.ndarray):
    """(h, n, node, at): the rarest shingles of every set, with their places in its order.

    ``h`` has the rank in its high bits, so the order of the numbers is the order of rarity.
    """

    def run(batches):
        seen: set[int] = set()  # copies met again in this task; bounded, only saves rows
        shift = np.uint64(64 - RANK_BITS)
        high = ranks.astype(np.uint64) << np.uint64(56)
        for _, sets in _slices(batches):
            hs, ns, nodes, places = [], [], [], []
            for s in sets:
                if not len(s):
                    continue
                name = node(s)
                if name in seen:
                    continue
                if len(seen) < 200_000:
                    seen.add(name)
                p = prefix_length(len(s))
                hs.append(np.sort(high[(s >> shift).astype(np.int64)] | (s >> np.uint64(8)))[:p])
                ns.append(np.full(p, len(s)))
                nodes.append(np.full(p, name))
                places.append(np.arange(p))
            if hs:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(hs).astype(np.int64)), pa.array(np.concatenate(ns).astype(np.int32)),
                     pa.array(np.concatenate(nodes)), pa.array(np.concatenate(places).astype(np.int32))],
                    ["h", "n", "node", "at"])

    return run


def _may_link(n: int, at: int, m: int, bt: int) -> bool:
    """Length and positional filters for sets of n and m shingles that share the ones at these places."""
    if PERCENT * max(n, m) > 100 * min(n, m):
        return False
    needed = -(-PERCENT * (n + m) // (100 + PERCENT))
    return 1 + min(n - at, m - bt) - 1 >= needed


def _meet(by_size: bool):
    """Lists sorted by shingle: every entry with the entry before it and with its head.

    Entries of lists of one are dropped. Holds one row back, whatever the length of a list. With
    ``by_size`` the lists ascend in size and place; a new head starts where the size range ends, or at an entry
    that the list's shingle is earlier of.
    """
    names = ["h", "n", "node", "at", "root", "before", "head"]

    def run(batches):
        held: tuple | None = None  # the row not yet known to have a follower
        follows = False  # the held row belongs to a list that has begun
        head: tuple | None = None
        for batch in batches:
            columns = [batch.column(c).to_numpy() for c in names[:5]]
            h = columns[0]
            # Rows that stand alone in the middle of the batch need no look.
            alone = np.zeros(len(h), bool)
            if len(h) > 2:
                alone[1:-1] = (h[1:-1] != h[:-2]) & (h[1:-1] != h[2:])
            out: list[tuple] = []
            for row in zip(*(c[~alone].tolist() for c in columns), strict=True):
                if held is None or row[0] != held[0]:
                    held, head, follows = row, row, False
                    continue
                if row[2] == held[2]:
                    continue
                if not follows:
                    out.append((*held, None, None))
                if by_size and PERCENT * row[1] > 100 * head[1]:
                    head = row
                pair = [
                    other[2] if other[2] != row[2] and other[4] != row[4] and _may_link(row[1], row[3], other[1], other[3])
                    else None for other in (held, head)
                ]
                out.append((*row, pair[0], pair[1] if pair[1] != pair[0] else None))
                held, follows = row, True
                if by_size and row[3] < head[3]:
                    head = row
            if len(h) and len(alone) and alone.any() and held is not None and h[-1] != held[0]:
                held = None
            if out:
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)

    return run


def _pair_rest(batches):
    """Lists sorted by shingle, size and place: all pairs of different components that pass the filters.

    Entries of a size are kept by component, in the order of their places, so only such pairs are looked at.
    """
    names = ["h", "n", "node", "at", "root"]
    window: deque = deque()  # (size, {component: [(place, node)]})
    current = None
    said: set[tuple[int, int]] = set()  # saves repeats; bounded
    for batch in batches:
        out: list[tuple[int, int]] = []
        for row in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
            h, n, name, at, root = row
            if h != current:
                current = h
                window.clear()
            while window and PERCENT * n > 100 * window[0][0]:
                window.popleft()
            for m, groups in window:
                needed = -(-PERCENT * (n + m) // (100 + PERCENT))
                if n - at < needed:
                    continue
                for other_root, entries in groups.items():
                    if m - entries[0][0] < needed:
                        break
                    if other_root == root:
                        continue
                    for bt, other in entries:
                        if m - bt < needed:
                            break
                        pair = (name, other) if name > other else (other, name)
                        if pair not in said:
                            if len(said) > 100_000:
                                said.clear()
                            said.add(pair)
                            out.append(pair)
            if not window or window[-1][0] != n:
                window.append((n, {}))
            window[-1][1].setdefault(root, []).append((at, name))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in out], pa.int64()), pa.array([p[1] for p in out], pa.int64())], ["a", "b"])


def _wanted_sets(need: np.ndarray, ids: np.ndarray):
    """(node, data) of sets that verification may ask for: five bytes per shingle, ascending.

    ``ids`` are the bits of the id buckets to read, ``need`` those of the nodes.
    """

    def asked(batches):
        for batch in batches:
            yield batch.filter(_has(ids, batch.column("bucket").to_numpy()))

    def run(batches):
        seen: set[int] = set()
        for _, sets in _slices(asked(batches)):
            sets = [s for s in sets if len(s)]
            names = [node(s) for s in sets]
            wanted = _has(need, _need_bucket(np.array(names, np.int64))).to_pylist()
            nodes, data = [], []
            for s, name, yes in zip(sets, names, wanted, strict=True):
                if not yes or name in seen:
                    continue
                if len(seen) < 200_000:
                    seen.add(name)
                nodes.append(name)
                data.append((s >> np.uint64(24)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5].tobytes())
            if nodes:
                yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(data, pa.binary())], ["node", "data"])

    return run


def _unpack(data: bytes) -> np.ndarray:
    wide = np.zeros((len(data) // 5, 8), np.uint8)
    wide[:, :5] = np.frombuffer(data, np.uint8).reshape(-1, 5)
    return wide.view("<u8").ravel()


def _has(bits: np.ndarray, at: np.ndarray) -> pa.Array:
    """Whether the bits at these places are set."""
    return pa.array(((bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1).astype(bool))


def _among(bits: np.ndarray):
    """Rows whose node falls into a bucket of ``bits``."""

    def run(batches):
        for batch in batches:
            yield batch.filter(_has(bits, _need_bucket(batch.column("node").to_numpy())))

    return run


def _close(batches):
    """Pairs that their sketches do not rule out."""
    for batch in batches:
        total = (batch.column("n_a").to_numpy() + batch.column("n_b").to_numpy()).tolist()
        # Overlap is at most (total - apart) / 2, and at least PERCENT / (100 + PERCENT) of the total is needed.
        kept = [(100 + PERCENT) * (t - apart(x.as_py(), y.as_py())) >= 2 * PERCENT * t
                for t, x, y in zip(total, batch.column("s_a"), batch.column("s_b"), strict=True)]
        yield batch.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))


def _verify(batches):
    """Pairs whose whole sets are alike."""
    for batch in batches:
        good = []
        for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
            a, b = _unpack(x.as_py()), _unpack(y.as_py())
            both = len(np.intersect1d(a, b, assume_unique=True))
            good.append(100 * both >= PERCENT * (len(a) + len(b) - both))
        kept = np.flatnonzero(good)
        yield pa.RecordBatch.from_arrays(
            [batch.column("a").take(pa.array(kept)), batch.column("b").take(pa.array(kept))], ["u", "v"])


def _id_bucket():
    return F.pmod(F.xxhash64("doc_id"), F.lit(1 << NEED_BITS)).alias("bucket")


def verified(pairs: DataFrame, sizes: DataFrame, read: DataFrame) -> DataFrame:
    """Links among distinct ``pairs(a, b)``: suffix filter on sketches, then whole sets of the documents asked for."""
    ends = lambda df: df.select(F.explode(F.array("a", "b")).alias("node"))
    asked = sizes.mapInArrow(_among(need_bits(ends(pairs))), sizes.schema)
    side = lambda name: asked.select(F.col("node").alias(name), F.col("n").alias(f"n_{name}"),
                                     F.col("sketch").alias(f"s_{name}"))
    close = materialize(pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(_close, "a long, b long"), "close-pairs")
    # Only the sets of these pairs are made and shuffled.
    need = need_bits(ends(close))
    ids = bit_table(sizes.select("node", _id_bucket()).mapInArrow(_asked_ids(need), BLOCKS))
    bodies = materialize(read.select("text", _id_bucket()).mapInArrow(_wanted_sets(need, ids), "node long, data binary"), "sets") \
        .dropDuplicates(["node"])
    return (
        close.join(bodies.select(F.col("node").alias("a"), F.col("data").alias("x")), "a")
        .join(bodies.select(F.col("node").alias("b"), F.col("data").alias("y")), "b")
        .select("a", "b", "x", "y").mapInArrow(_verify, "u long, v long")
    )


def _ordered(a: str, b: str) -> list:
    return [F.greatest(a, b).alias("a"), F.least(a, b).alias("b")]


def linked(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(doc_id, node, n) of every row, and (node, root) of the nodes that links join to a smaller one."""
    read = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = docs.schema["doc_id"].dataType
    counted = materialize(
        read.mapInArrow(_sets(to_arrow_type(kind)),
                        f"doc_id {kind.simpleString()}, node long, n long, sketch binary, {BLOCKS}"),
        "shingle-sets")
    sets = counted.where("block is null").select("doc_id", "node", "n", "sketch")
    frequency = bucket_table(counted.where("block is not null").select("block", "data"), RANK_BITS)
    ranks = np.floor(np.log2(frequency.astype(float) + 1.0)).astype(np.uint8)
    schema = "h long, n int, node long, at int, root long, before long, head long"
    lists = materialize(
        read.select("text").mapInArrow(_prefixes(ranks), "h long, n int, node long, at int")
        .repartition("h").sortWithinPartitions("h", "n", "at", "node").withColumn("root", F.col("node"))
        .mapInArrow(_meet(True), schema), "lists")
    rows = lists.count()
    # One document of every node that lists are about.
    listed = need_bits(lists.select("node"))
    sizes = materialize(
        sets.where("node is not null").mapInArrow(_among(listed), sets.schema).dropDuplicates(["node"]), "sizes")

    met = lists
    pairs = roots = None
    # Pairs of different components inside lists, at first of different nodes.
    k = F.count("*").cast("double")
    before = lists.groupBy("h").agg((k * (k - 1) / 2).alias("k")).agg(F.sum("k")).first()[0] or 0.0
    for meeting in range(MEETINGS + 1):
        fresh = met.select(F.explode(F.array("before", "head")).alias("other"), "node").where("other is not null") \
            .select(*_ordered("node", "other")).distinct()
        if pairs is not None:
            fresh = fresh.join(pairs, ["a", "b"], "left_anti")
        fresh = materialize(fresh, "pairs")
        pairs = fresh if pairs is None else pairs.unionByName(fresh)
        found = materialize(verified(fresh, sizes, read), "links")
        # Earlier links are in the roots: stars, to which only the new links are added.
        if roots is not None:
            found = found.unionByName(roots.select(F.col("node").alias("u"), F.col("root").alias("v")))
        roots = components(found)
        rooted = lists.select("h", "n", "node", "at").join(roots, "node", "left").select(
            "h", "n", "node", "at", F.coalesce("root", "node").alias("root"))
        # Lists of one component are done.
        open_lists = rooted.groupBy("h", "root").agg(F.count("*").cast("double").alias("k")).groupBy("h").agg(
            ((F.sum("k") * F.sum("k") - F.sum(F.col("k") * F.col("k"))) / 2).alias("cross")).where("cross > 0")
        rooted = materialize(rooted.join(open_lists, "h").drop("cross"), "open-lists")
        cross = open_lists.agg(F.sum("cross").alias("all")).first()["all"] or 0.0
        if not cross:
            return sets.select("doc_id", "node", "n"), roots
        # Another meeting pays while it contracts: near copies of one text do, texts that share a passage do not.
        if cross <= 5.0 * rows + 100_000 or cross > 0.7 * before or meeting == MEETINGS:
            break
        before = cross
        met = rooted.repartition("h").sortWithinPartitions("h", F.xxhash64("node", F.lit(meeting))) \
            .mapInArrow(_meet(False), schema)
    rest = rooted.repartition("h").sortWithinPartitions("h", "n", "at", "node").mapInArrow(_pair_rest, "a long, b long") \
        .distinct().join(pairs, ["a", "b"], "left_anti")
    last = materialize(verified(materialize(rest, "pairs"), sizes, read), "links")
    return sets.select("doc_id", "node", "n"), components(roots.select(F.col("node").alias("u"), F.col("root").alias("v"))
                                                          .unionByName(last))


def joined(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id (least doc_id of the component) of every row."""
    rows, roots = linked(docs)
    rooted = rows.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = rooted.where("root is not null").groupBy("root").agg(F.min("doc_id").alias("least"))
    return rooted.join(least, "root", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("least", "doc_id").alias("component_id"))


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of each component, the one with the least id; columns unchanged. Empty texts all stay."""
    out = joined(docs).where("n_shingles > 0 and component_id <> doc_id").select("doc_id").distinct()
    return docs.join(out, "doc_id", "left_anti").select(*docs.columns)
