"""Substring dedup: Rabin-Karp hashes of every window of words, counted over the whole corpus.

The corpus is dealt into ranges of doc_id (``ranges.in_split_ranges``; rows of a heavy id, or of none, are spread over parts of one range). Each range sends the distinct hashes of its windows, sorted
and cut by hash into buckets; a bucket meets in one task, which finds for every hash the ranges that an earlier range also
has, and answers with one bit per hash. A range then knows of each of its windows whether a smaller doc_id has it, in an
earlier range or in the same one, and merges the windows to remove into maximal intervals.

A null or short text has no windows. A row with a null doc_id is neither cut nor does it cut others. Rows of one doc_id do not
cut each other, whether their texts are equal or not. An empty table gives no rows; other columns are ignored.
Hashes have 64 bits: a window is taken for another one with a chance of (number of windows) / 2^64.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .common import partitions
from .ranges import in_split_ranges
from .rolling import window_hashes, word_hashes

WINDOW = 50
#: Buckets of hashes for each shuffle partition.
BUCKETS_PER_TASK = 2
PART_BYTES = 8 << 20
RESULT = "doc_id long, n_words long, n_removed long, removed array<struct<start: long, stop: long>>, kept_sha256 string"


def _pack(values: np.ndarray) -> bytes:
    """Rising numbers as differences, byte planes apart, so that the shuffle's compression drops the empty high bytes."""
    steps = np.diff(values, prepend=np.uint64(0))
    return np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes()


def _unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


class _Part:
    """The windows of one range of documents, in order of doc_id."""

    def __init__(self, table: pa.Table, width: int):
        table = table.take(pc.sort_indices(table, [("doc_id", "ascending")], null_placement="at_start"))
        self.ids, self.width = table.column("doc_id").to_pylist(), width
        self.texts = [t.encode() for t in table.column("text").to_pylist()]
        words, self.counts = word_hashes(self.texts)
        self.starts = np.cumsum(self.counts) - self.counts
        hashes = window_hashes(words, width)
        # Windows of two documents, and of those without an id, are none.
        doc = np.repeat(np.arange(len(self.ids)), self.counts)
        known = np.array([i is not None for i in self.ids], bool)
        self.places = np.flatnonzero((doc[: len(hashes)] == doc[width - 1 :]) & known[doc[: len(hashes)]]) if len(hashes) else np.zeros(0, np.int64)
        self.hashes, first, self.which = np.unique(hashes[self.places], return_index=True, return_inverse=True)
        ids = np.array([i or 0 for i in self.ids], np.int64)[doc[self.places]] if len(self.places) else np.zeros(0, np.int64)
        # unique() gives the first place of each hash, hence its smallest doc_id here.
        self.later = ids > ids[first][self.which] if len(ids) else np.zeros(0, bool)

    def bucket_stops(self, buckets: int) -> np.ndarray:
        bounds = np.array([(i << 64) // buckets for i in range(1, buckets)], np.uint64)
        return np.array([*np.searchsorted(self.hashes, bounds), len(self.hashes)])

    def removed(self, earlier: np.ndarray) -> np.ndarray:
        """For each word of the part, whether a window to remove covers it."""
        edges = np.zeros(int(self.counts.sum()) + self.width + 1, np.int32)
        hit = self.places[earlier[self.which] | self.later]
        edges[hit] += 1
        edges[hit + self.width] -= 1
        return np.cumsum(edges)[: int(self.counts.sum())] > 0


def _intervals(mask: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(mask.astype(np.int8), prepend=0, append=0))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist()))


def dedup_substrings(docs: DataFrame, width: int = WINDOW, part_bytes: int = PART_BYTES) -> DataFrame:
    """Per document its words, the maximal intervals of removed words, and the hash of what is kept."""
    n = partitions(docs.sparkSession)
    rows, starts = in_split_ranges(docs, part_bytes)
    by_part = rows.repartition(n, "part")
    # By the tasks, not by the parts, so that the rows sent grow with the corpus and not with its square.
    buckets = BUCKETS_PER_TASK * n

    def send(table: pa.Table) -> pa.Table:
        part = _Part(table, width)
        stops = part.bucket_stops(buckets)
        found = [(b, stop - size, stop) for b, (stop, size) in enumerate(zip(stops, np.diff(stops, prepend=0))) if size]
        number = table.column("part")[0].as_py()
        return pa.table(
            {
                "bucket": pa.array([b for b, _, _ in found], pa.int32()),
                "part": pa.array([number] * len(found), pa.int32()),
                "hashes": pa.array([_pack(part.hashes[a:z]) for _, a, z in found], pa.binary()),
            }
        )

    def answer(table: pa.Table) -> pa.Table:
        table = table.sort_by("part")
        lists = [_unpack(x) for x in table.column("hashes").to_pylist()]
        hashes = np.concatenate(lists)
        order = np.argsort(hashes, kind="stable")  # of equal hashes, the earliest part comes first
        new = np.diff(hashes[order], prepend=~hashes[order[:1]]) != 0
        # Parts of one range do not cut each other: it then is of one id.
        ranges = np.searchsorted(starts, table.column("part").to_numpy(), "right")
        ranges = np.repeat(ranges, [len(x) for x in lists])[order]
        earlier = np.zeros(len(hashes), bool)
        earlier[order] = ranges > ranges[np.flatnonzero(new)][np.cumsum(new) - 1]
        bits = [np.packbits(x).tobytes() for x in np.split(earlier, np.cumsum([len(x) for x in lists])[:-1])]
        return pa.table({"bucket": table.column("bucket"), "part": table.column("part"), "bits": pa.array(bits, pa.binary())})

    def cut(table: pa.Table, answers: pa.Table) -> pa.Table:
        part = _Part(table, width)
        earlier = np.zeros(len(part.hashes), bool)
        stops = [0, *part.bucket_stops(buckets).tolist()]
        for bucket, bits in zip(answers.column("bucket").to_pylist(), answers.column("bits").to_pylist()):
            a, z = stops[bucket], stops[bucket + 1]
            earlier[a:z] = np.unpackbits(np.frombuffer(bits, np.uint8), count=z - a)
        mask = part.removed(earlier)
        spans, kept = [], []
        for text, start, count in zip(part.texts, part.starts.tolist(), part.counts.tolist()):
            own = mask[start : start + count]
            words = text.split()
            spans.append(_intervals(own) if own.any() else [])
            if spans[-1]:
                words = [w for w, gone in zip(words, own.tolist()) if not gone]
            kept.append(hashlib.sha256(b" ".join(words)).hexdigest())
        kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
        return pa.table(
            {
                "doc_id": pa.array(part.ids, pa.int64()),
                "n_words": pa.array(part.counts, pa.int64()),
                "n_removed": pa.array([sum(z - a for a, z in s) for s in spans], pa.int64()),
                "removed": pa.array([[{"start": a, "stop": z} for a, z in s] for s in spans], kind),
                "kept_sha256": pa.array(kept, pa.string()),
            }
        )

    sent = by_part.groupBy("part").applyInArrow(send, "bucket int, part int, hashes binary")
    answers = sent.repartition(n, "bucket").groupBy("bucket").applyInArrow(answer, "bucket int, part int, bits binary")
    return by_part.groupBy("part").cogroup(answers.repartition(n, "part").groupBy("part")).applyInArrow(cut, RESULT)
