"""SimHash near-duplicates by ball hashing.

Two fingerprints within three bits meet in the middle: with one of three bit
blocks masked out they differ in at most two of the other bits (a third one can
be masked), so variants of both within one bit coincide. Each distinct
fingerprint emits these 131 variants; equal variants are sorted together and
colliding pairs are verified where they meet. Of a group only a forest of its
links leaves the task, never its pairs.

Comparing a group's members costs each of them as many steps as it has members.
Where that is more than the whole ball of radius two has variants (2081), the
members emit that ball instead: all that share a variant with a member at
distance one or less are linked to that member, without comparing pairs. Both
ways are exact; the bound is where their costs meet.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import keyed_texts, map_batches
from clickloom.llm.components import components
from clickloom.operators.lookup import left_lookup
from clickloom.session import cut_lineage

RADIUS = 3
SHINGLE_WORDS = 3
SEED = 42
SMALL = 1 + 64 + 64 * 63 // 2  # variants of a whole ball
BLOCKS = (21, 21, 22)
VARIANT_FPS = 4096
VARIANT_BYTES = 131 * 17
TASK_BYTES = 16 << 20
ROWS_PER_SALT = 2_000


def fingerprint(shingles: list[bytes]) -> int:
    """Bits set in over half of the hashes; for one text, written plainly."""
    hashes = [xxhash.xxh64_intdigest(s, SEED) for s in shingles]
    bits = [2 * sum(h >> i & 1 for h in hashes) > len(hashes) for i in range(64)]
    return sum(1 << i for i in range(64) if bits[i])


def shingles(text: bytes, n: int = SHINGLE_WORDS) -> list[bytes]:
    """``n`` words each, repeats included; all words of a shorter text."""
    words = text.lower().split()
    if len(words) < n:
        return [b" ".join(words)] if words else []
    return list(map(b" ".join, zip(*(words[i:] for i in range(n)))))


def fingerprints(texts: list[bytes], n: int = SHINGLE_WORDS) -> np.ndarray:
    """Signed 64-bit fingerprints of many texts; 0 for texts without words."""
    digest = xxhash.xxh64_intdigest
    out = np.zeros(len(texts), np.uint64)
    weights = np.uint64(1) << np.arange(64, dtype=np.uint64)
    for i, text in enumerate(texts):
        found = shingles(text, n)
        if not found:
            continue
        hashes = np.fromiter((digest(s, SEED) for s in found), "<u8", len(found))
        counts = np.zeros(64, np.int64)
        for at in range(0, len(hashes), 1 << 16):
            part = hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8)
            counts += np.unpackbits(part, axis=1, bitorder="little").sum(0, np.int64)
        out[i] = weights[2 * counts > len(hashes)].sum(dtype=np.uint64)
    return out.view(np.int64)


def fingerprint_documents(docs: DataFrame, *more: Column) -> DataFrame:
    """(doc_id, fp) of every row, and ``more`` long columns."""
    texts = keyed_texts(docs, *more).withColumn("text", F.col("text").cast("binary"))
    carried = texts.columns[2:]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = fingerprints(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found), *batch.columns[2:]],
                ["doc_id", "fp", *carried],
            )

    schema = "doc_id long, fp long" + "".join(f", {name} long" for name in carried)
    return map_batches(texts, task, schema)


def _masked_variants() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each of the 131 variants: bits kept, bit flipped, mark of the mask."""
    keep, flip, mark, low = [], [], [], 0
    for number, width in enumerate(BLOCKS):
        block = ((1 << width) - 1) << low
        rest = [i for i in range(64) if not block >> i & 1]
        for bit in [None, *rest]:
            keep.append(~block & (2**64 - 1))
            flip.append(0 if bit is None else 1 << bit)
            mark.append(number << low)
        low += width
    return tuple(np.array(x, np.uint64) for x in (keep, flip, mark))


def _ball() -> tuple[np.ndarray, np.ndarray]:
    """Bits flipped by the variants within distance two, and the distances."""
    flips = [0]
    for n in (1, 2):
        flips += [sum(1 << i for i in c) for c in combinations(range(64), n)]
    return np.array(flips, np.uint64), np.array([0] + [1] * 64 + [2] * 2016, np.int32)


def masked_variants(nodes: DataFrame) -> DataFrame:
    """(key, fp): the variants of every fingerprint with a block masked out."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep, flip, mark = _masked_variants()
        for batch in batches:
            every = batch.column(0).to_numpy().view(np.uint64)
            for at in range(0, len(every), VARIANT_FPS):
                fps = every[at : at + VARIANT_FPS]
                keys = ((fps[:, None] & keep) ^ flip) | mark
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(keys.ravel().view(np.int64)),
                        pa.array(np.repeat(fps, len(keep)).view(np.int64)),
                    ],
                    ["key", "fp"],
                )

    return map_batches(nodes.select("fp"), task, "key long, fp long")


def _joined(label: np.ndarray, left: np.ndarray, right: np.ndarray) -> list[int]:
    """Join the trees of linked positions; which of the links did so."""
    kept = []
    for k in np.flatnonzero(label[left] != label[right]).tolist():
        one, two = label[left[k]], label[right[k]]
        if one != two:
            label[label == two] = one
            kept.append(k)
    return kept


def verified_links(variants: DataFrame) -> DataFrame:
    """(a, b) from rows sorted by key: links of small groups as a forest, and
    (fp, null) for every member of a larger one, which is never held."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, fp, large = np.empty(0, np.int64), np.empty(0, np.int64), None

        def checked(key: np.ndarray, fp: np.ndarray) -> pa.RecordBatch | None:
            edge = np.flatnonzero(np.diff(key)) + 1
            size = np.diff(np.r_[0, edge, len(key)])
            of_row = np.repeat(size, size)
            big = np.unique(fp[of_row > SMALL])
            at = np.flatnonzero((of_row > 1) & (of_row <= SMALL))
            label, a, b = np.arange(len(key)), [], []
            for step in range(1, SMALL):
                at = at[at + step < len(key)]
                at = at[key[at] == key[at + step]]
                if not len(at):
                    break
                apart = np.bitwise_count((fp[at] ^ fp[at + step]).view(np.uint64))
                near = at[(apart <= RADIUS) & (apart > 0)]
                near = near[_joined(label, near, near + step)]
                a += fp[near].tolist()
                b += fp[near + step].tolist()
            if not len(big) and not a:
                return None
            none = pa.nulls(len(big), pa.int64())
            first = pa.concat_arrays([pa.array(a, pa.int64()), pa.array(big)])
            second = pa.concat_arrays([pa.array(b, pa.int64()), none])
            return pa.RecordBatch.from_arrays([first, second], ["a", "b"])

        for batch in batches:
            new_key, new_fp = (batch.column(i).to_numpy() for i in (0, 1))
            if large is not None:  # the rest of a group that was cut before
                rest = new_key == large
                if rest.any():
                    found = pa.array(np.unique(new_fp[rest]))
                    none = pa.nulls(len(found), pa.int64())
                    yield pa.RecordBatch.from_arrays([found, none], ["a", "b"])
                    new_key, new_fp = new_key[~rest], new_fp[~rest]
                if not len(new_key):
                    continue
                large = None
            key, fp = np.r_[key, new_key], np.r_[fp, new_fp]
            last = int(np.searchsorted(key == key[-1], True))
            if len(key) - last > SMALL:
                large, last = key[-1], len(key)
            out = checked(key[:last], fp[:last]) if last else None
            key, fp = key[last:], fp[last:]
            if out:
                yield out
        if len(key) and (out := checked(key, fp)):
            yield out

    return map_batches(variants, task, "a long, b long")


def ball_links(members: DataFrame) -> DataFrame:
    """Links of fingerprints by whole balls: each variant's members are linked
    to its first one if that lies within distance one."""

    def variants(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flips, far = _ball()
        for batch in batches:
            every = batch.column(0).to_numpy().view(np.uint64)
            for at in range(0, len(every), 256):
                fps = every[at : at + 256]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array((fps[:, None] ^ flips).ravel().view(np.int64)),
                        pa.array(np.tile(far, len(fps))),
                        pa.array(np.repeat(fps, len(flips)).view(np.int64)),
                    ],
                    ["key", "far", "fp"],
                )

    def stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, hub, near = None, 0, False
        for batch in batches:
            keys, far, fps = (batch.column(i).to_numpy() for i in range(3))
            if not len(keys):
                continue
            starts = np.flatnonzero(np.r_[keys[0] != key, keys[1:] != keys[:-1]])
            if len(starts) and starts[0] == 0:
                hubs, close = fps[starts], far[starts] <= 1
                size = np.diff(np.r_[starts, len(keys)])
            else:
                hubs, close = np.r_[hub, fps[starts]], np.r_[near, far[starts] <= 1]
                size = np.diff(np.r_[0, starts, len(keys)])
            pair = np.stack([fps, np.repeat(hubs, size)], 1)
            pair = pair[np.repeat(close, size) & (pair[:, 0] != pair[:, 1])]
            if len(pair):
                pair = np.unique(pair, axis=0)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(pair[:, 0]), pa.array(pair[:, 1])], ["a", "b"]
                )
            key, hub, near = keys[-1], hubs[-1], bool(close[-1])

    spread = map_batches(members, variants, "key long, far int, fp long")
    dealt = spread.repartition("key").sortWithinPartitions("key", "far", "fp")
    return map_batches(dealt, stars, "a long, b long").distinct()


def links(nodes: DataFrame) -> DataFrame:
    """(a, b) between distinct fingerprints: true links that join all those
    which a chain of links joins."""
    tasks = 1 + nodes.count() * VARIANT_BYTES // TASK_BYTES
    spread = nodes.select("fp").repartition(tasks, "fp")  # sized by what comes out
    dealt = masked_variants(spread).repartition("key").sortWithinPartitions("key", "fp")
    found = cut_lineage(verified_links(dealt).distinct())
    members = found.filter("b IS NULL").select(F.col("a").alias("fp"))
    pairs = found.filter("b IS NOT NULL")
    if members.isEmpty():
        return pairs
    return pairs.unionAll(ball_links(members))


def fingerprint_roots(rows: DataFrame) -> DataFrame:
    """(fp, least, root) of every distinct fingerprint of ``rows`` (doc_id, fp):
    its least id and the fingerprint that names its component."""
    nodes = cut_lineage(rows.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = components(links(nodes))
    joined = nodes.join(roots, nodes["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    return cut_lineage(joined)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Every row's fingerprint and the least doc_id its links lead to.

    Copies share a fingerprint, so only distinct ones are compared, and a group
    of copies of any size is one node. Texts without words have fingerprint
    zero. A row with a null id is linked like any other but names no component
    unless the whole of it has null ids; repeated rows come back as they are;
    an empty table gives no rows; other columns are ignored.
    """
    rows = cut_lineage(fingerprint_documents(docs))
    joined = fingerprint_roots(rows)
    least = joined.groupBy("root").agg(F.min("least").alias("component_id"))
    hot = {"small": False, "rows_per_salt": ROWS_PER_SALT}
    of_fp = left_lookup(joined.select("fp", "root"), least, ["root"], **hot)
    found = left_lookup(rows, of_fp.select("fp", "component_id"), ["fp"], **hot)
    return found.select(
        "doc_id",
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id",
    )
