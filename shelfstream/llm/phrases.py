"""Document fingerprints by locally consistent parsing.

A text is a row of symbols. At each level, runs of one symbol become one symbol; deterministic coin tossing then turns every
symbol into a small number by the lowest bit in which it differs from its left neighbour, again and again, until fewer than
six values are left; the local maxima of these open the phrases, and a phrase is named by the hash of its symbols. Names are
the symbols of the next level. Where a phrase begins depends only on a few symbols around, so equal substrings get
equal names inside, at any offset.

The fingerprint keeps, for each of a fixed number of bins, one byte of the smallest hash of a name in that bin (00: no
name): 64 bins for the names of level 1 and 192 for those of higher levels. Likeness is the share of equal bins.

A null text is empty; an empty text has no names, and two such are alike (1.0). The next document follows by doc_id, rows of one id
by their text; rows without an id come first. An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import partitions
from .ranges import in_ranges
from .rolling import BASE, INVERSE, mixed, powers

LOW_BINS, HIGH_BINS = 64, 192
#: Filled bins of higher levels from which they alone decide likeness.
ENOUGH = 24
MAX_LEVEL = 8
PART_BYTES = 4 << 20
STEP_BYTES = 1 << 20
#: Ranges the corpus is cut into at most; rows stream, so a range may be of any size.
MOST_PARTS = 20_000
RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
)
_BYTES = np.random.default_rng(20240301).integers(0, 1 << 64, 256, np.uint64, endpoint=False)


def _toss(values: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Twice the place of the lowest bit that differs from the left neighbour, plus that bit."""
    differ = values ^ left
    lowest = differ & (~differ + differ.dtype.type(1))
    place = np.log2(lowest.astype(np.float64)).astype(values.dtype)
    return (place << values.dtype.type(1)) | ((values & lowest) != 0)


def _toss_table(bits: int) -> np.ndarray:
    """``_toss`` of all pairs of small values; equal pairs do not occur next to each other."""
    size = 1 << bits
    pairs = np.arange(size * size, dtype=np.uint32)
    values, left = pairs >> np.uint32(bits), pairs & np.uint32(size - 1)
    return np.where(values == left, 0, _toss(values, np.where(values == left, left ^ np.uint32(1), left))).astype(np.uint8)


#: For bytes, and for what one toss leaves of bytes (0 to 15) or of 64-bit names (0 to 127).
_TOSS_BYTE, _TOSS_7, _TOSS_4 = _toss_table(8), _toss_table(7), _toss_table(4)


def _openings(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Whether a phrase opens at each symbol; neighbours within a document differ. ``first`` marks the documents' first symbols.

    A document's first symbol is tossed against its complement's lowest bit, which depends on nothing outside.
    """
    left = np.empty_like(values)
    left[1:] = values[:-1]
    left[first] = values[first] ^ values.dtype.type(1)
    if values.dtype == np.uint8:
        small = _TOSS_BYTE[(values.astype(np.uint32) << np.uint32(8)) | left]
    else:
        small = _toss(values, left).astype(np.uint8)
    # 256 values become 16 and 2^64 become 128; further tosses leave 14, then 8, then 6.
    for table, bits in [(_TOSS_7, 7)] * (values.dtype != np.uint8) + [(_TOSS_4, 4)] * 3:
        left = np.empty_like(small)
        left[1:] = small[:-1]
        left[first] = small[first] ^ np.uint8(1)
        small = table[(small.astype(np.uint16) << np.uint16(bits)) | left]
    before, after = np.zeros_like(small), np.zeros_like(small)
    before[1:], after[:-1] = small[:-1], small[1:]
    before[first] = 0
    after[np.append(first[1:], False)] = 0
    return ((small > before) & (small >= after)) | first


def _level(values: np.ndarray, names: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names of the phrases of one level, and which of them is its document's first."""
    fresh = first.copy()
    fresh[1:] |= values[1:] != values[:-1]
    at = np.flatnonzero(fresh)
    runs = np.diff(at, append=len(values)).astype(np.uint64)
    first = first[at]
    symbols = np.where(runs > 1, mixed(names[at] + runs), names[at])
    opens = _openings(values[at], first)
    starts = np.flatnonzero(opens)
    sums = np.zeros(len(at) + 1, np.uint64)
    np.cumsum(symbols * powers(BASE, len(at)), dtype=np.uint64, out=sums[1:])
    stops = np.append(starts[1:], len(at))
    named = mixed((sums[stops] - sums[starts]) * powers(INVERSE, len(at) + 1)[starts])
    return named, first[starts]


def _sketch(sketches: np.ndarray, docs: np.ndarray, names: np.ndarray, at: int, bins: int) -> None:
    """Lowers the bins ``at`` .. ``at + bins`` of each document to the smallest hash of its names."""
    hashes = mixed(names + np.uint64(0x51ED2701))
    place = docs * sketches.shape[1] + at + ((hashes >> np.uint64(32)) % np.uint64(bins)).astype(np.int64)
    np.minimum.at(sketches.reshape(-1), place, (hashes & np.uint64(0xFFFFFFFF)).astype(np.uint32))


def fingerprints(texts: list[bytes]) -> np.ndarray:
    """(texts, bins) bytes."""
    sketches = np.full((len(texts), LOW_BINS + HIGH_BINS), 0xFFFFFFFF, np.uint32)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    full = np.flatnonzero(sizes)
    values = np.frombuffer(b"".join(texts), np.uint8)
    first = np.zeros(len(values), bool)
    first[(np.cumsum(sizes) - sizes)[full]] = True
    names = _BYTES[values]
    for level in range(1, MAX_LEVEL + 1):
        if not len(values):
            break
        names, first = _level(values, names, first)
        which = np.cumsum(first) - 1
        own = full[which]
        _sketch(sketches, own, names + np.uint64(level), *((0, LOW_BINS) if level == 1 else (LOW_BINS, HIGH_BINS)))
        # A document of one phrase is done.
        more = np.diff(np.flatnonzero(first), append=len(first)) > 1
        full, open_symbols = full[more], more[which]
        names, first = names[open_symbols], first[open_symbols]
        values = names
    return np.where(sketches == 0xFFFFFFFF, 0, 1 + sketches % 255).astype(np.uint8)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The share of equal bins among those that either has, row by row; of the higher levels alone where they suffice."""
    same, either = (a == b) & (a > 0), (a > 0) | (b > 0)
    high = np.minimum((a[:, LOW_BINS:] > 0).sum(1), (b[:, LOW_BINS:] > 0).sum(1)) >= ENOUGH
    n_same = np.where(high, same[:, LOW_BINS:].sum(1), same.sum(1))
    n_either = np.where(high, either[:, LOW_BINS:].sum(1), either.sum(1))
    return np.where(n_either > 0, n_same / np.maximum(1, n_either), 1.0)


def _edited(text: str, following: str) -> str:
    cut = len(text) // 4
    return text[: len(text) - cut] + following[:cut]


def _compared(rows: list[tuple[int | None, str]], following: tuple[int | None, str]) -> pa.RecordBatch:
    said = [text for _, text in rows]
    edits = [_edited(a, b) for a, b in zip(said, [*said[1:], following[1]])]
    marks = fingerprints([t.encode() for t in [*said, following[1]]])
    changed = fingerprints([t.encode() for t in edits])
    own = marks[:-1]
    columns = [
        pa.array([i for i, _ in rows], pa.int64()),
        pa.array([len(t) for t in said], pa.int64()),
        pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edits]),
        pa.array([m.tobytes().hex() for m in own]),
        pa.array([m.tobytes().hex() for m in changed]),
        pa.array(likeness(own, changed)),
        pa.array(likeness(own, marks[1:])),
    ]
    return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in RESULT.split(", ")])


def fingerprint_edits(docs: DataFrame, part_bytes: int = PART_BYTES) -> DataFrame:
    """Fingerprints of every text and of the text edited with the start of the next document's, and their likeness.

    One shuffle deals the documents into ranges of doc_id; the first row of a range also goes to the range before it (that of the
    first range to the last), as what follows that one's last row. Rows stream through in order, a step of text at a time.
    """
    spark = docs.sparkSession
    rows, _ = in_ranges(docs, part_bytes, MOST_PARTS)
    rows = rows.withColumn("mark", F.xxhash64("text"))
    # One row for each range, so at most MOST_PARTS.
    firsts = sorted(rows.groupBy("part").agg(F.min(F.struct("doc_id", "mark")).alias("low")).collect(), key=lambda r: r["part"])
    leads = [(r["part"], r["low"]["doc_id"], r["low"]["mark"], firsts[i - 1]["part"]) for i, r in enumerate(firsts)]
    lead_rows = spark.createDataFrame(leads, "own_part int, low_id long, low_mark long, before int")
    is_low = (F.col("part") == F.col("own_part")) & F.col("doc_id").eqNullSafe(F.col("low_id")) & (F.col("mark") == F.col("low_mark"))
    here = F.struct(F.col("part").alias("part"), F.lit(False).alias("lead"))
    there = F.struct(F.col("before").alias("part"), F.lit(True).alias("lead"))
    sent = rows.join(F.broadcast(lead_rows), is_low, "left").select(
        "doc_id", "text", "mark", F.explode(F.when(F.col("before").isNull(), F.array(here)).otherwise(F.array(here, there))).alias("to")
    )
    dealt = sent.select("to.part", "to.lead", "doc_id", "mark", "text").repartition(partitions(spark), "part")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int | None, str]] = []
        size, ended = 0, True
        for batch in batches:
            for lead, doc_id, text in zip(*(batch.column(c).to_pylist() for c in ("lead", "doc_id", "text"))):
                if lead and ended:
                    continue  # a repeat of the row that closed the range
                if held and (lead or size > STEP_BYTES):
                    yield _compared(held, (doc_id, text))
                    held, size = [], 0
                ended = lead
                if not lead:
                    held.append((doc_id, text))
                    size += len(text)

    return dealt.sortWithinPartitions("part", "lead", "doc_id", "mark", "text").mapInArrow(run, RESULT)
