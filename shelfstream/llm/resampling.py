"""Drawing documents towards a target distribution by importance weights of hashed words, summed bit by bit.

A feature is a run of words and falls into one of ``BUCKETS`` buckets. A bucket's gain is the scaled logarithm of how much
commoner it is in the target than in the documents, both smoothed by one; a document's weight is the sum of its features'
gains. The sum is exact and free of multiplication: a document's counts per bucket become planes of one bit per bucket
(plane k holds bit k of every count), the gains become planes in two's complement, and every pair of planes adds the number of
bits that both have, times a power of two, the last gain plane with a minus sign. A hash of the id adds Gumbel noise, so that the
highest scores are a sample without repetition in proportion to the exponential of the weight.

A null or wordless text has no features and weight 0; a null doc_id hashes as the empty string and sorts after all ids;
repeated rows are drawn one by one, in any order among themselves; an empty target has flat counts; an empty table gives
no rows; other columns ride along only if named in ``keep``, in a struct of their own.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_steps, settled, steps, texts

BUCKETS = 10_000
LONGEST = 1
SCALE = 1000
SEED = 2024
MIN_WORDS = 20
PERCENT = 10
#: Documents whose planes are held at once: 10,000 buckets take 10 KB a document while they are filled.
BLOCK_DOCS = 256

# Word characters are ASCII letters, digits and every byte of a longer character; capitals are folded, the rest separates.
_FOLDED = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def feature_buckets(text: str, longest: int = LONGEST, buckets: int = BUCKETS) -> tuple[int, np.ndarray]:
    """Number of words, and the bucket of every run of 1 to ``longest`` words."""
    words = text.encode().translate(_FOLDED).split()
    runs = [words, *((b" ".join(words[i : i + n]) for i in range(len(words) - n + 1)) for n in range(2, longest + 1))]
    return len(words), np.fromiter(map(zlib.crc32, chain(*runs)), np.uint32) % np.uint32(buckets)


def bucket_counts(rows: DataFrame, longest: int = LONGEST, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n) over all texts; every task sends at most one row per bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, np.int64)
        for batch in (step for batch in batches for step in steps(batch)):
            found = [feature_buckets(t, longest, buckets)[1] for t in batch.column("text").to_pylist()]
            counts += np.bincount(np.concatenate(found), minlength=buckets)
        held = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int64()), pa.array(counts[held])], ["bucket", "n"])

    return texts(rows).mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(docs: DataFrame, target: DataFrame, longest: int = LONGEST, buckets: int = BUCKETS) -> np.ndarray:
    """Signed gain of every bucket, learnt from all texts of both tables; the driver gets one row per bucket at most."""
    sides = [bucket_counts(rows, longest, buckets).withColumn("side", F.lit(i)) for i, rows in enumerate((docs, target))]
    counts = np.zeros((2, buckets), np.int64)
    for row in sides[0].unionByName(sides[1]).collect():
        counts[row.side, row.bucket] = row.n
    own, wanted = (float(n) for n in counts.sum(axis=1))
    ratios = ((t + 1.0) * (own + buckets) / ((s + 1.0) * (wanted + buckets)) for s, t in zip(*counts.tolist()))
    return np.array([math.floor(SCALE * math.log(r)) for r in ratios], np.int64)


def bit_planes(values: np.ndarray, width: int) -> np.ndarray:
    """``width`` rows of 64-bit words: row k has bit k of every value, in two's complement if values are negative."""
    padded = np.zeros((width, -(-len(values) // 64) * 64), bool)
    padded[:, : len(values)] = values >> np.arange(width)[:, None] & 1
    return np.packbits(padded, axis=1).view(np.uint64)


class GainPlanes:
    """The gains as bit planes, and the exact sum of gains over counted buckets."""

    def __init__(self, gains: np.ndarray):
        width = max(int(gains.max(initial=0)).bit_length(), int(-gains.min(initial=0) - 1).bit_length()) + 1
        self.buckets, self.planes = len(gains), bit_planes(gains, width)
        self.powers = [1 << j for j in range(width - 1)] + [-1 << (width - 1)]

    def sums(self, doc: np.ndarray, bucket: np.ndarray, docs: int) -> np.ndarray:
        """Sum of the gains of each document's buckets; ``doc`` rises from 0 to ``docs`` - 1 and may leave numbers out."""
        out = np.zeros(docs, np.int64)
        for first in range(0, docs, BLOCK_DOCS):
            low, high = np.searchsorted(doc, [first, first + BLOCK_DOCS])
            slots, counts = np.unique((doc[low:high] - first) * self.buckets + bucket[low:high], return_counts=True)
            for k in range(int(counts.max(initial=0)).bit_length()):
                self._add(out[first : first + BLOCK_DOCS], slots[counts >> k & 1 == 1], k)
        return out

    def _add(self, out: np.ndarray, slots: np.ndarray, k: int) -> None:
        """Adds what plane ``k`` of the counts gives; ``slots`` are the set bits, document by document."""
        owners, row = np.unique(slots // self.buckets, return_inverse=True)
        plane = np.zeros((len(owners), 64 * self.planes.shape[1]), bool)
        plane[row, slots % self.buckets] = True
        words = np.packbits(plane, axis=1).view(np.uint64)
        for power, gains in zip(self.powers, self.planes):
            out[owners] += (power << k) * np.bitwise_count(words & gains).sum(axis=1, dtype=np.int64)


def importance_weights(docs: DataFrame, gains: np.ndarray, longest: int = LONGEST, keep: Sequence[str] = ()) -> DataFrame:
    """(doc_id, n_words, n_features, weight, kept) of every row; ``kept`` is a struct of the ``keep`` columns, null without any."""
    kept = F.struct(*(F.col(f"`{c}`") for c in keep)) if keep else F.lit(None).cast("string")
    rows = texts(docs, F.col("doc_id").cast("long").alias("doc_id"), kept.alias("kept"))
    planes = GainPlanes(gains)

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        words, found = zip(*(feature_buckets(t, longest, len(gains)) for t in batch.column("text").to_pylist()))
        features = np.array([len(f) for f in found], np.int64)
        doc = np.repeat(np.arange(len(found)), features)
        weights = planes.sums(doc, np.concatenate(found).astype(np.int64), len(found))
        columns = [batch.column("doc_id"), pa.array(words, pa.int64()), pa.array(features), pa.array(weights), batch.column("kept")]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "n_features", "weight", "kept"])

    numbers = [T.StructField(c, T.LongType()) for c in ("doc_id", "n_words", "n_features", "weight")]
    return map_steps(rows, run, T.StructType([*numbers, rows.schema["kept"]]))


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Scaled Gumbel noise from the first 32 bits of a hash of the id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    hashed = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-float(SCALE) * F.log(-F.log((hashed + 0.5) / float(1 << 32)))).cast("long")


def ranked(scored: DataFrame, eligible: Column, percent: int = PERCENT) -> DataFrame:
    """``scored`` with the ``rank`` of the highest ``percent`` of a hundred eligible rows by (score, smaller doc_id); null for the rest.

    Rows are sorted over all tasks; a row's rank is its place in its part and the sizes of the parts before, so the driver gets
    one number per part and no task sees more than its own. The place in the unsorted table parts rows that tie in all else.
    """
    rows = settled(scored.withColumn("eligible", eligible)).withColumn("tie", F.monotonically_increasing_id())
    in_order = settled(rows.orderBy(F.desc("eligible"), F.desc("score"), F.asc_nulls_last("doc_id"), "tie").drop("tie"))
    in_order = in_order.withColumns({"part": F.spark_partition_id(), "place": F.monotonically_increasing_id()})
    sizes = in_order.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.count_if("eligible").alias("n_eligible")).orderBy("part").collect()
    drawn = sum(s.n_eligible for s in sizes) * percent // 100
    before, starts = 0, []
    for s in sizes:
        starts.append((s.part, before))
        before += s.n
    parts = scored.sparkSession.createDataFrame(starts, "part int, before long")
    # One row per part of a shuffle, so it is small at any size of the table.
    placed = in_order.join(F.broadcast(parts), "part", "left").withColumn("rank", F.col("before") + F.col("place").bitwiseAND(F.lit((1 << 33) - 1)) + 1)
    return placed.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank"))).drop("part", "before", "place", "eligible")


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, seed: int = SEED, longest: int = LONGEST, keep: Sequence[str] = ()) -> DataFrame:
    """(doc_id, n_words, n_features, weight, kept, score, rank) of every row of ``docs``; drawn rows have a rank."""
    weighted = importance_weights(docs, bucket_gains(docs, target, longest), longest, keep)
    return ranked(weighted.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed)), F.col("n_words") >= min_words, percent)
