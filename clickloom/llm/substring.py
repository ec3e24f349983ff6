"""Repeated passages by super-k-mers.

Consecutive windows of a document that share a minimiser (the least hash of the
short word groups in a window) form one packed string, so that words travel
about three times and not thirteen. The minimiser names the bucket; in a bucket
every distinct window is matched exactly, by its words. The windows of a
minimiser that is too frequent for one bucket travel singly, each to the bucket
that a hash of all its words names, so that equal ones still meet.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import keyed_texts, map_batches

WINDOW = 13
GROUP = 3
BUCKET_BYTES = 1 << 20
LEAST_BUCKETS = 64
#: A minimiser of about so many windows is dealt out by whole windows. They are
#: counted in one of COUNT_SHARE texts; a task holds COUNTED counts.
HEAVY_WINDOWS = 1 << 20
COUNT_SHARE = 8
COUNTED = 1 << 16
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


def group_hashes(words: list[bytes]) -> np.ndarray:
    """A mixed hash of every ``GROUP`` consecutive words."""
    crc = np.fromiter(map(zlib.crc32, words), np.uint64, len(words))
    count = len(words) - GROUP + 1
    h = np.zeros(count, np.uint64)
    for k in range(GROUP):
        h = (h ^ crc[k : k + count]) * _ODD[k]
        h ^= h >> np.uint64(29)
    return h


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Least of every ``width`` consecutive values, by doubling."""
    have = 1
    while have * 2 <= width:
        values = np.minimum(values[:-have], values[have:])
        have *= 2
    rest = width - have
    return np.minimum(values[:-rest], values[rest:]) if rest else values


def super_kmers(
    texts: list[bytes], heavy: np.ndarray | None = None
) -> tuple[list[bytes], np.ndarray]:
    """Packed strings and, per string, (text, first window, windows, minimiser).

    Windows of the ``heavy`` minimisers are strings of their own, with a hash of
    the whole window for a minimiser.
    """
    split = [text.split() for text in texts]
    sizes = np.array([len(s) for s in split])
    words = [w for s in split for w in s]
    none = np.empty((0, 4), np.uint64)
    if len(words) < WINDOW:
        return [], none
    least = sliding_min(group_hashes(words), WINDOW - GROUP + 1)
    owner = np.repeat(np.arange(len(texts)), sizes)
    whole = owner[: len(least)] == owner[WINDOW - 1 :]
    fresh = np.ones(len(least), bool)
    fresh[1:] = (least[1:] != least[:-1]) | (owner[1 : len(least)] != owner[: len(least) - 1])
    if heavy is not None and len(heavy):
        single = np.isin(least, heavy)
        fresh |= single
        fresh[1:] |= single[:-1]
    first = np.flatnonzero(whole & fresh)
    if not len(first):
        return [], none
    alone = np.flatnonzero(~whole)
    # a run ends before the next one begins or before the text's last words
    end = np.minimum(
        np.r_[first[1:], len(least)],
        np.r_[alone, len(least)][np.searchsorted(alone, first)],
    )
    begin = np.cumsum(sizes) - sizes
    packed = [
        b" ".join(words[a:b]) for a, b in zip(first.tolist(), (end + WINDOW - 1).tolist())
    ]
    text = owner[first]
    marked = least[first]
    if heavy is not None and len(heavy):
        for i in np.flatnonzero(single[first]).tolist():
            marked[i] = xxhash.xxh64_intdigest(packed[i])
    columns = (text, first - begin[text], end - first, marked)
    return packed, np.stack([c.astype(np.uint64) for c in columns], 1)


def _planes(values: np.ndarray, kind: str) -> bytes:
    """Differences of a column, their first bytes first: small when packed."""
    steps = np.diff(values.astype("<i8"), prepend=0).astype(kind)
    return steps.view(np.uint8).reshape(-1, steps.itemsize).T.tobytes()


def _column(body: bytes, at: int, n: int, kind: str) -> tuple[np.ndarray, int]:
    width = np.dtype(kind).itemsize
    planes = np.frombuffer(body, np.uint8, n * width, at).reshape(width, n)
    steps = np.ascontiguousarray(planes.T).view(kind).ravel()
    return np.cumsum(steps, dtype=np.int64), at + n * width


def _blob(head: np.ndarray, ids: np.ndarray, packed: list[bytes]) -> bytes:
    """head: (row of ids, first window, windows) per string."""
    body = struct.pack("<II", len(head), len(ids))
    body += b"".join(_planes(head[:, k], "<i4") for k in range(3))
    body += b"".join(_planes(ids[:, k], "<i8") for k in range(2))
    return zstandard.ZstdCompressor(level=6).compress(body + b"\n".join(packed))


def _open(blob: bytes) -> tuple[np.ndarray, np.ndarray, bytes]:
    body = zstandard.ZstdDecompressor().decompress(blob)
    (n, m), at = struct.unpack_from("<II", body), 8
    columns = []
    for size, kind in ((n, "<i4"),) * 3 + ((m, "<i8"),) * 2:
        column, at = _column(body, at, size, kind)
        columns.append(column)
    return np.stack(columns[:3], 1), np.stack(columns[3:], 1), body[at:]


def heavy_minimisers(
    texts: DataFrame, most: int | None = None, share: int | None = None
) -> np.ndarray:
    """Minimisers of about ``most`` windows or more.

    Windows are counted in one of ``share`` texts. A task keeps the most frequent
    minimisers and takes the count of the first one it drops off the others, so
    it may count too few, by a share of its windows of one in ``COUNTED``. What
    is missed or found here moves windows between buckets; results are the same.
    """
    most, share = most or HEAVY_WINDOWS, share or COUNT_SHARE
    held = COUNTED

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, n = np.empty(0, np.uint64), np.empty(0, np.int64)
        for batch in batches:
            _, found = super_kmers(batch.column(0).to_pylist())
            key = np.r_[key, found[:, 3]]
            n = np.r_[n, found[:, 2].astype(np.int64)]
            key, row = np.unique(key, return_inverse=True)
            n = np.bincount(row, n, len(key)).astype(np.int64)
            if len(key) > held:
                n -= np.partition(n, -held - 1)[-held - 1]
                key, n = key[n > 0], n[n > 0]
        if len(key):
            yield pa.RecordBatch.from_arrays(
                [pa.array(key.view(np.int64)), pa.array(n)], ["key", "n"]
            )

    some = texts.filter(F.pmod(F.xxhash64("doc_id", "text"), F.lit(share)) == 0)
    counts = map_batches(some.select("text"), task, "key long, n long")
    total = counts.groupBy("key").agg(F.sum("n").alias("n"))
    found = total.filter(F.col("n") * share >= most).select("key").collect()
    return np.array([r[0] for r in found], np.int64).view(np.uint64)


def packed_windows(
    texts: DataFrame, buckets: int, heavy: np.ndarray | None = None
) -> DataFrame:
    """(bucket, marks, blob): one row per bucket and batch.

    Of equal strings in a batch only the one of the smallest id travels; the
    others are covered by it, and only the places of their windows travel on.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            order = np.argsort(batch.column(0).to_numpy(), kind="stable")
            batch = batch.take(pa.array(order))
            keys = np.stack([batch.column(i).to_numpy() for i in (0, 1)], 1)
            packed, found = super_kmers(batch.column(2).to_pylist(), heavy)
            if not packed:
                continue
            text, first, count = found[:, :3].astype(np.int64).T
            least, covered = {}, np.zeros(len(packed), bool)
            for i, (s, t) in enumerate(zip(packed, keys[text, 0].tolist())):
                covered[i] = least.setdefault(s, t) < t
            bucket = (found[:, 3] % np.uint64(buckets)).astype(np.int64)
            spread = keys[text, 0] % buckets
            bucket = np.where(covered, spread, bucket) * 2 + covered
            order = np.argsort(bucket, kind="stable")
            cuts = np.flatnonzero(np.diff(bucket[order])) + 1
            where, blobs = [], []
            for part in np.split(order, cuts):
                mark = bool(covered[part[0]])
                used, row = np.unique(text[part], return_inverse=True)
                head = np.stack([row, first[part], count[part]], 1)
                strings = [] if mark else [packed[i] for i in part.tolist()]
                blobs.append(_blob(head, keys[used], strings))
                where.append(int(bucket[part[0]]))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([w >> 1 for w in where], pa.int64()),
                    pa.array([bool(w & 1) for w in where]),
                    pa.array(blobs, pa.binary()),
                ],
                ["bucket", "marks", "blob"],
            )

    return map_batches(texts, task, "bucket long, marks boolean, blob binary")


def _windows(head: np.ndarray, body: bytes) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Every window of the strings in ``body``, its id row and its place."""
    raw = np.frombuffer(body, np.uint8)
    stop = np.r_[np.flatnonzero((raw == 32) | (raw == 10)), len(raw)]
    begin = np.r_[0, stop[:-1] + 1]
    count = head[:, 2]
    base = np.cumsum(count + WINDOW - 1) - (count + WINDOW - 1)
    step = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    at = np.repeat(base, count) + step
    spans = zip(begin[at].tolist(), stop[at + WINDOW - 1].tolist())
    return (
        [body[a:b] for a, b in spans],
        np.repeat(head[:, 0], count),
        np.repeat(head[:, 1], count) + step,
    )


def repeated_ranges(packed: DataFrame) -> DataFrame:
    """(doc_id, hash, start, n): windows that a smaller id has too.

    A bucket holds each distinct window once, with the smallest id so far and the
    place of that row; any other occurrence is given out as soon as it is known,
    in whatever order the documents come.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, seen, again = None, {}, {}

        def ranges(ids: list[int], codes: list[int]) -> pa.RecordBatch:
            doc, code = np.array(ids, np.int64), np.array(codes, np.int64)
            order = np.lexsort((code, doc))
            doc, code = doc[order], code[order]
            fresh = np.r_[True, (np.diff(code) != 0) | (np.diff(doc) != 0)]
            doc, code = doc[fresh], code[fresh]
            first = np.flatnonzero(np.r_[True, (np.diff(code) != 1) | (np.diff(doc) != 0)])
            n = np.diff(np.r_[first, len(code)])
            columns = (code[first] >> 32, code[first] & 0xFFFFFFFF, n)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(doc[first]),
                    *(pa.array(x.astype(np.int32)) for x in columns),
                ],
                ["doc_id", "hash", "start", "n"],
            )

        for batch in batches:
            for bucket, marks, blob in zip(*(c.to_pylist() for c in batch.columns)):
                if bucket != current:
                    current, seen, again = bucket, {}, {}
                head, keys, body = _open(blob)
                ids, out = [], []
                if marks:
                    for r, start, n in head.tolist():
                        at = int(keys[r, 1]) << 32 | start
                        ids += [int(keys[r, 0])] * n
                        out += range(at, at + n)
                    yield ranges(ids, out)
                    continue
                windows, row, place = _windows(head, body)
                codes = (keys[row, 1] << 32 | place).tolist()
                for window, a, code in zip(windows, keys[row, 0].tolist(), codes):
                    held = seen.get(window)
                    if held is None:
                        seen[window] = a, code
                        continue
                    b = held[0]
                    if a > b:
                        ids.append(a)
                        out.append(code)
                    elif a < b:
                        more = again.pop(window, ())
                        ids += [b] * (1 + len(more))
                        out += (held[1], *more)
                        seen[window] = a, code
                    else:
                        again.setdefault(window, []).append(code)
                if out:
                    yield ranges(ids, out)

    dealt = packed.repartition("bucket").sortWithinPartitions("bucket")
    return map_batches(dealt, task, "doc_id long, hash int, start int, n int")


def bucket_count(texts: DataFrame) -> int:
    """So many buckets that each holds about ``BUCKET_BYTES`` of text."""
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(LEAST_BUCKETS, size // BUCKET_BYTES)


def remove_repeats(docs: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, n_words, n_removed, text, \\*carry): words of repeated windows gone.

    A word goes if a window of ``WINDOW`` words covers it that also starts in a
    row of smaller doc_id; every window is judged on the input. ``text`` is the
    kept words, joined by one space, or the input itself if nothing went.

    Null texts have no words. Rows with a null id lose nothing and take nothing
    from others; rows of equal id take nothing from each other
    (sixteen bits of a hash tell their texts apart); repeated rows
    come back as often as they came; an empty table gives no rows; columns that
    are neither named nor carried are ignored.
    """
    kept = keyed_texts(docs, *(F.col(c).alias(f"carry_{c}") for c in carry)).withColumn(
        "hash", F.pmod(F.xxhash64("text"), F.lit(1 << 16)).cast("int")
    )
    texts = kept.filter("doc_id IS NOT NULL").select(
        "doc_id", "hash", F.col("text").cast("binary").alias("text")
    )
    packed = packed_windows(texts, bucket_count(texts), heavy_minimisers(texts))
    ranges = repeated_ranges(packed)
    of_row = ranges.groupBy("doc_id", "hash").agg(
        F.collect_list(F.struct("start", "n")).alias("found")
    )
    joined = kept.join(of_row, ["doc_id", "hash"], "left").select(
        "doc_id",
        F.col("text").cast("binary").alias("text"),
        F.col("found.start").alias("starts"),
        F.col("found.n").alias("counts"),
        *(f"carry_{c}" for c in carry),
    )

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, removed, out = [], [], []
            for text, starts, counts in zip(*(batch.column(i) for i in (1, 2, 3))):
                words = (text := text.as_py()).split()
                sizes.append(len(words))
                if not starts.is_valid:
                    removed.append(0)
                    out.append(text)
                    continue
                gone = np.zeros(len(words) + WINDOW, np.int32)
                first = starts.values.to_numpy()
                np.add.at(gone, first, 1)
                np.add.at(gone, first + counts.values.to_numpy() + WINDOW - 1, -1)
                gone = np.cumsum(gone)[: len(words)] > 0
                removed.append(int(gone.sum()))
                out.append(b" ".join(w for w, g in zip(words, gone.tolist()) if not g))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(sizes, pa.int64()),
                    pa.array(removed, pa.int64()),
                    pa.array(out, pa.binary()),
                    *batch.columns[4:],
                ],
                ["doc_id", "n_words", "n_removed", "text", *batch.schema.names[4:]],
            )

    types = dict(joined.dtypes)
    schema = "doc_id long, n_words long, n_removed long, text binary"
    schema += "".join(f", carry_{c} {types[f'carry_{c}']}" for c in carry)
    done = map_batches(joined, task, schema)
    return done.select(
        "doc_id",
        "n_words",
        "n_removed",
        F.col("text").cast("string").alias("text"),
        *(F.col(f"carry_{c}").alias(c) for c in carry),
    )


def digests(docs: DataFrame) -> DataFrame:
    """Counts and the digest of the kept words, joined by one space."""
    plain = F.trim(F.regexp_replace("text", r"[\x20\x09-\x0D]+", " "))
    kept = F.when(F.col("n_removed") > 0, F.col("text")).otherwise(plain)
    return remove_repeats(docs).select(
        "doc_id",
        "n_words",
        "n_removed",
        F.sha2(kept.cast("binary"), 256).alias("kept_sha256"),
    )
