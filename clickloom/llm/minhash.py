"""Near-duplicates by the similarity of their word shingles.

Two texts are linked if the sets of their five-word shingles have a Jaccard
similarity of 0.8 or more. Candidates share one of ``BANDS`` keys, each made of
``ROWS`` least hashes; every candidate pair is then decided on the two sets. A
pair of similarity s is a candidate with a chance of 1 - (1 - s^5)^20: 0.9996 at
0.8.

Texts with equal sets are one node. Keys with up to ``SMALL`` nodes give all
their pairs. In a larger key a node first meets only the ``NEXT`` following ones,
in the order of the next band's key: that joins families of mutual copies with
as many pairs as nodes. What such keys may still hide is then found exactly: all
nodes of large keys go through a prefix filter. In any one order of the shingles
(here rare ones first) two sets of similarity s share one of their first
``size - s * size + 1`` shingles; nodes that share such a shingle and are not in
one component yet are compared, unless their places in that order or the
parities of their shingles in ``PARITY_BITS`` cells rule the similarity out (two
sets differ in at least as many shingles as their parities do).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import keyed_texts, map_batches
from clickloom.llm.components import components
from clickloom.llm.simhash import shingles
from clickloom.session import cut_lineage

SHINGLE_WORDS = 5
SIMILARITY = 0.8
BANDS = 20
ROWS = 5
SMALL = 16
NEXT = 4
RANK_BITS = 20
PARITY_BITS = 512
SEED = 42
CHUNK = 4096
_FLIP, _ODD = np.random.default_rng(SEED).integers(
    0, 1 << 64, (2, BANDS * ROWS, 1), np.uint64
)
_ODD |= np.uint64(1)


def shingle_set(text: bytes, n: int = SHINGLE_WORDS) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles."""
    found = shingles(text, n)
    digest = xxhash.xxh64_intdigest
    return np.unique(np.fromiter((digest(s, SEED) for s in found), "<u8", len(found)))


def band_keys(found: np.ndarray) -> np.ndarray:
    """One key per band; equal sets have equal keys."""
    least = np.full(BANDS * ROWS, 2**64 - 1, np.uint64)
    for at in range(0, len(found), CHUNK):
        mixed = (found[None, at : at + CHUNK] ^ _FLIP) * _ODD
        np.minimum(least, mixed.min(1), out=least)
    raw = least.tobytes()
    width = ROWS * 8
    keys = [
        xxhash.xxh64_intdigest(raw[k * width : (k + 1) * width], k)
        for k in range(BANDS)
    ]
    return np.array(keys, np.uint64)


def _node(found: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh64_intdigest(found.tobytes(), SEED)).view(np.int64))


def nodes_of(docs: DataFrame, n: int) -> DataFrame:
    """(doc_id, mark, node, size, bands) of every row (doc_id, text, mark); bands
    is null without words."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t, n) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(2),
                    pa.array([_node(s) for s in sets], pa.int64()),
                    pa.array([len(s) for s in sets], pa.int32()),
                    pa.array(
                        [band_keys(s).tobytes() if len(s) else None for s in sets],
                        pa.binary(),
                    ),
                ],
                ["doc_id", "mark", "node", "size", "bands"],
            )

    schema = "doc_id long, mark long, node long, size int, bands binary"
    return map_batches(docs, task, schema)


def band_rows(nodes: DataFrame) -> DataFrame:
    """(key, near, node, size) per band; near is the next band's key."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            raw = b"".join(batch.column(2).to_pylist())
            keys = np.frombuffer(raw, np.int64).reshape(-1, BANDS)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(keys.ravel()),
                    pa.array(np.roll(keys, -1, 1).ravel()),
                    *(
                        pa.array(np.repeat(batch.column(i).to_numpy(), BANDS))
                        for i in (0, 1)
                    ),
                ],
                ["key", "near", "node", "size"],
            )

    worded = nodes.filter("bands IS NOT NULL").select("node", "size", "bands")
    return map_batches(worded, task, "key long, near long, node long, size int")


def candidate_pairs(dealt: DataFrame, similarity: float) -> DataFrame:
    """(a, b) from rows sorted by key; sets of too different sizes are left out."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, node, size, rank = (np.empty(0, np.int64) for _ in range(4))
        for batch in batches:
            if not batch.num_rows:
                continue
            old = len(key)
            key = np.r_[key, batch.column(0).to_numpy()]
            node = np.r_[node, batch.column(2).to_numpy()]
            size = np.r_[size, batch.column(3).to_numpy()]
            place = np.arange(len(key))
            start = np.r_[True, key[1:] != key[:-1]]
            offset = rank[0] if old else 0
            rank = place - np.maximum.accumulate(np.where(start, place, 0))
            rank[key == key[0]] += offset
            left, right = [], []
            for step in range(1, SMALL):
                b = np.arange(max(old, step), len(key))
                a = b - step
                small, large = np.minimum(size[a], size[b]), np.maximum(size[a], size[b])
                met = (key[a] == key[b]) & (small >= similarity * large - 1e-9)
                met &= (step <= NEXT) | (rank[b] < SMALL)
                left.append(node[a[met]])
                right.append(node[b[met]])
            pair = np.stack([np.concatenate(left), np.concatenate(right)], 1)
            if len(pair):
                pair = np.unique(np.sort(pair, 1), axis=0)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(pair[:, 0]), pa.array(pair[:, 1])], ["a", "b"]
                )
            key, node, size, rank = (x[-SMALL + 1 :] for x in (key, node, size, rank))

    return map_batches(dealt, task, "a long, b long")


def similar(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs whose sets have the similarity; both sets are read whole."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                a, b = np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8")
                both = len(np.intersect1d(a, b, assume_unique=True))
                good.append(both >= similarity * (len(a) + len(b) - both) - 1e-9)
            yield batch.select([0, 1]).filter(pa.array(good, pa.bool_()))

    one = sets.select(F.col("node").alias("a"), F.col("found").alias("found_a"))
    two = sets.select(F.col("node").alias("b"), F.col("found").alias("found_b"))
    whole = pairs.join(one, "a").join(two, "b").select("a", "b", "found_a", "found_b")
    return map_batches(whole, task, "a long, b long")


def large_key_nodes(nodes: DataFrame) -> DataFrame:
    """(node) of every node that has a key with more than ``SMALL`` nodes."""
    bands = band_rows(nodes).select("key", "node")
    large = bands.groupBy("key").count().filter(F.col("count") > SMALL)
    return bands.join(large.select("key"), "key", "left_semi").select("node").distinct()


def shingle_ranks(sets: DataFrame) -> np.ndarray:
    """How often the shingles of each of 2^20 buckets occur, about.

    It only has to be one order for all tasks: which one changes the number of
    candidates, never the pairs found. So a task leaves out what it saw once,
    and what reaches the driver is at most one number per bucket.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(1 << RANK_BITS, np.int64)
        for batch in batches:
            for raw in batch.column(0).to_pylist():
                np.add.at(seen, _bucket(np.frombuffer(raw, "<u8")), 1)
        often = np.flatnonzero(seen > 1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(often), pa.array(seen[often])], ["bucket", "n"]
        )

    counted = map_batches(sets.select("found"), task, "bucket long, n long")
    table = counted.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    ranks = np.zeros(1 << RANK_BITS, np.int64)
    ranks[table["bucket"].to_numpy()] = table["n"].to_numpy()
    return ranks


def _bucket(found: np.ndarray) -> np.ndarray:
    return (found >> np.uint64(64 - RANK_BITS)).astype(np.int64)


def parities(found: np.ndarray) -> bytes:
    """One bit per cell: whether an odd number of the shingles falls into it."""
    cell = ((found >> np.uint64(13)) % np.uint64(PARITY_BITS)).astype(np.int64)
    odd = np.bincount(cell, minlength=PARITY_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def prefixes(sets: DataFrame, similarity: float) -> DataFrame:
    """(shingle, node, root, size, place, parity): the first shingles of each
    set, rare first, and where they stand."""
    sent = sets.sparkSession.sparkContext.broadcast(shingle_ranks(sets))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = sent.value
        for batch in batches:
            node, root = (batch.column(i).to_numpy() for i in (0, 1))
            taken, sizes, bits = [], [], []
            for raw in batch.column(2).to_pylist():
                found = np.frombuffer(raw, "<u8")
                order = np.lexsort((found, ranks[_bucket(found)]))
                keep = len(found) - int(np.ceil(similarity * len(found) - 1e-9)) + 1
                taken.append(found[order[:keep]])
                sizes.append(len(found))
                bits.append(parities(found))
            if not taken:
                continue
            many = [len(t) for t in taken]
            row = np.repeat(np.arange(len(many)), many)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate(taken).view(np.int64)),
                    *(pa.array(np.asarray(x, np.int64)[row]) for x in (node, root, sizes)),
                    pa.array(np.concatenate([np.arange(m) for m in many])),
                    pa.array(bits, pa.binary()).take(pa.array(row)),
                ],
                ["shingle", "node", "root", "size", "place", "parity"],
            )

    rows = sets.select("node", "root", "found")
    schema = "shingle long, node long, root long, size long, place long, parity binary"
    return map_batches(rows, task, schema)


def apart_pairs(rows: DataFrame, similarity: float) -> DataFrame:
    """(a, b) from rows sorted by shingle and root: nodes of different roots that
    share a shingle and may be similar.

    If the shared shingle is the first one they share, they share no more than
    what is left of either set from it on; the pair is given there or nowhere.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((5, 0), np.int64)
        parity = np.zeros((0, PARITY_BITS // 64), np.uint64)

        def pairs(group: np.ndarray, parity: np.ndarray) -> Iterator[pa.RecordBatch]:
            _, node, root, size, place = group
            left = size - place
            edges = np.flatnonzero(np.r_[True, root[1:] != root[:-1]])
            for low, high in zip(edges, np.r_[edges[1:], len(node)]):
                for at in range(low, high) if high < len(node) else ():
                    both = size[high:] + size[at]
                    least = similarity / (1 + similarity) * both - 1e-9
                    fit = high + np.flatnonzero(np.minimum(left[high:], left[at]) >= least)
                    spare = both[fit - high] - 2 * least[fit - high]
                    apart = np.bitwise_count(parity[fit] ^ parity[at]).sum(axis=1)
                    other = node[fit[apart <= spare]]
                    if len(other):
                        one = np.full(len(other), node[at])
                        ends = np.minimum(one, other), np.maximum(one, other)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(x) for x in ends], ["a", "b"]
                        )

        def groups(held: np.ndarray, parity: np.ndarray) -> Iterator[pa.RecordBatch]:
            """Only groups of more than one root are looked at."""
            shingle, root = held[0], held[2]
            new = np.flatnonzero(np.r_[True, shingle[1:] != shingle[:-1]])
            for low, high in zip(new, np.r_[new[1:], held.shape[1]]):
                if root[low] != root[high - 1]:
                    yield from pairs(held[:, low:high], parity[low:high])

        for batch in batches:
            if not batch.num_rows:
                continue
            numbers = np.stack([c.to_numpy() for c in batch.columns[:5]])
            bits = np.frombuffer(b"".join(batch.column(5).to_pylist()), np.uint64)
            held = np.hstack([held, numbers])
            parity = np.vstack([parity, bits.reshape(batch.num_rows, -1)])
            last = int(np.searchsorted(held[0], held[0, -1]))
            if last:
                yield from groups(held[:, :last], parity[:last])
                held, parity = held[:, last:], parity[last:]
        if held.shape[1]:
            yield from groups(held, parity)

    return map_batches(rows, task, "a long, b long")


def near_duplicates(
    docs: DataFrame, n: int = SHINGLE_WORDS, similarity: float = SIMILARITY
) -> DataFrame:
    """(doc_id, component_id) of every row that has an id.

    component_id is the least doc_id that a chain of links leads to. Texts of
    fewer than ``n`` words have one shingle, all their words; texts without
    words are equal. Rows that share an id but not the text are one row each.
    Other columns are ignored.
    """
    return group_texts(docs, n, similarity).select("doc_id", "component_id")


def text_mark(text: Column) -> Column:
    """Tells apart rows that share an id but not the text."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def group_texts(
    docs: DataFrame, n: int = SHINGLE_WORDS, similarity: float = SIMILARITY
) -> DataFrame:
    """(doc_id, mark, root, component_id) of every row that has an id; root
    names the component, also where two have the same least id."""
    texts = keyed_texts(docs, text_mark(F.col("text")).alias("mark"))
    texts = texts.filter("doc_id IS NOT NULL")
    texts = texts.withColumn("text", F.col("text").cast("binary"))
    rows = cut_lineage(nodes_of(texts, n))
    nodes = rows.groupBy("node").agg(
        F.min("doc_id").alias("least"),
        F.first("size").alias("size"),
        F.first("bands").alias("bands"),
    )
    least = rows.groupBy("node").agg(F.min("doc_id").alias("doc_id"))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t, n) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([_node(s) for s in sets], pa.int64()),
                    pa.array([s.tobytes() for s in sets], pa.binary()),
                ],
                ["node", "found"],
            )

    def sets_of(wanted: DataFrame) -> DataFrame:
        ids = least.join(wanted, "node", "left_semi").select("doc_id").distinct()
        chosen = texts.select("doc_id", "text").join(ids, "doc_id", "left_semi")
        return map_batches(chosen, task, "node long, found binary").dropDuplicates(["node"])

    def true_links(pairs: DataFrame) -> DataFrame:
        met = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        return cut_lineage(similar(pairs, sets_of(met), similarity))

    dealt = band_rows(nodes).repartition("key").sortWithinPartitions("key", "near", "node")
    links = true_links(cut_lineage(candidate_pairs(dealt, similarity).distinct()))
    roots = components(links)
    large = cut_lineage(large_key_nodes(nodes))
    if not large.isEmpty():
        rooted = large.join(roots, "node", "left").select(
            "node", F.coalesce("root", "node").alias("root")
        )
        sets = cut_lineage(sets_of(large).join(rooted, "node"))
        first = prefixes(sets, similarity).repartition("shingle")
        first = first.sortWithinPartitions("shingle", "root", "node")
        pairs = cut_lineage(apart_pairs(first, similarity).distinct())
        roots = components(links.unionAll(true_links(pairs)))
    joined = least.join(roots, "node", "left").select(
        "node", "doc_id", F.coalesce("root", "node").alias("root")
    )
    joined = cut_lineage(joined)
    first = joined.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    of_node = joined.join(first, "root").select("node", "root", "component_id")
    rows = rows.select("doc_id", "mark", "node")
    return rows.join(of_node, "node").select("doc_id", "mark", "root", "component_id")
