"""SimHash near-dedup: Golay-code fuzzy hashing finds all fingerprints within two bits.

A 64-bit fingerprint is cut into segments of 23, 23 and 18 bits. Two differing bits leave at least one of three segments without
error, and the segment after it has two errors at most. The perfect Golay code of 23 bits gives that segment up to six
codeword indices, one for each codeword nearest to a word within one bit of it: segments within two bits share at least one
of them. A key is (error-free segment, codeword index of the next), so a fingerprint has at most 18 keys.

A null or wordless text has fingerprint zero and is linked like any other; a null doc_id keeps its row but is never the name
of a component (which is null if no member has an id); repeated rows share a component; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_steps, settled, texts
from .components import components

SHINGLE = 3
SEED = 42
SEGMENTS = ((0, 23), (23, 23), (46, 18))
#: Fingerprints under one key that are compared pair by pair; a fuller key is linked through centres (``_crowded_links``).
CROWD = 64
#: Generator polynomial of the Golay code: x^11 + x^9 + x^7 + x^6 + x^5 + x + 1.
GENERATOR = 0b101011100011
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def shingle_hashes(text: str, width: int = SHINGLE) -> list[int]:
    """XXH64 of every ``width``-word shingle, repeats included; of the whole sequence if it is shorter; none without words."""
    from xxhash import xxh64_intdigest

    words = text.encode().translate(_LOWER).split()
    if not words:
        return []
    joined = b" ".join(words)
    if len(words) <= width:
        return [xxh64_intdigest(joined, SEED)]
    stops = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1).tolist()
    starts = [0, *stops[: -width]]
    return [xxh64_intdigest(joined[a : b - 1], SEED) for a, b in zip(starts, stops[width - 1 :])]


def fingerprint(hashes: list[int]) -> int:
    """Bit by bit what over half of the hashes have; a long text is counted in parts of bounded size."""
    counts = np.zeros(64, np.int64)
    values = np.array(hashes, ">u8")
    for start in range(0, len(values), 1 << 16):
        part = np.unpackbits(values[start : start + (1 << 16)].view(np.uint8)).reshape(-1, 64)
        counts += part.sum(0, dtype=np.uint32)
    return int(np.packbits(2 * counts > len(values)).view(">u8")[0]) if len(values) else 0


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, mark, fp) of every row; mark is a hash of the text, fp the fingerprint as a signed long."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        marks = np.array([fingerprint(shingle_hashes(t)) for t in batch.column("text").to_pylist()], np.uint64)
        columns = [batch.column("doc_id"), batch.column("mark"), pa.array(marks.view(np.int64))]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "mark", "fp"])

    rows = texts(docs, F.col("doc_id").cast("long").alias("doc_id"), _mark("text").alias("mark"))
    return map_steps(rows, run, "doc_id long, mark long, fp long")


def _mark(text: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def _remainder(words: np.ndarray) -> np.ndarray:
    """Remainders of 23-bit words by the generator polynomial."""
    words = words.astype(np.int64)
    for bit in range(22, 10, -1):
        words = np.where(words >> bit & 1, words ^ (GENERATOR << (bit - 11)), words)
    return words


def _corrections() -> np.ndarray:
    """The error pattern of up to three bits for each of the 2048 remainders; the code is perfect, so each has one."""
    bits = [1 << i for i in range(23)]
    errors = [0, *bits]
    errors += [a | b for i, a in enumerate(bits) for b in bits[:i]]
    errors += [a | b | c for i, a in enumerate(bits) for j, b in enumerate(bits[:i]) for c in bits[:j]]
    errors = np.array(errors)
    table = np.zeros(2048, np.int64)
    table[_remainder(errors)] = errors
    return table


def codeword_indices(words: np.ndarray, corrections: np.ndarray) -> np.ndarray:
    """(words, 24) indices of the codewords nearest to each 23-bit word and to its 23 neighbours."""
    near = words[:, None].astype(np.int64) ^ np.array([0, *(1 << i for i in range(23))])
    return (near ^ corrections[_remainder(near)]) >> 11


def fuzzy_keys(distinct: DataFrame) -> DataFrame:
    """(key, fp): the Golay keys of each fingerprint in column ``fp``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        corrections = _corrections()
        for whole in batches:
            for start in range(0, whole.num_rows, 4096):
                marks = whole.column("fp").slice(start, 4096).to_numpy(zero_copy_only=False)
                segments = [(marks.view(np.uint64) >> np.uint64(at) & np.uint64((1 << n) - 1)).astype(np.int64) for at, n in SEGMENTS]
                for i, exact in enumerate(segments):
                    found = np.sort(codeword_indices(segments[(i + 1) % 3], corrections), axis=1)
                    new = np.ones(found.shape, bool)
                    new[:, 1:] = found[:, 1:] != found[:, :-1]
                    row, column = np.nonzero(new)
                    keys = (i << 36) | (exact[row] << 12) | found[row, column]
                    yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(marks[row])], ["key", "fp"])

    return distinct.select("fp").mapInArrow(run, "key long, fp long")


def near_links(distinct: DataFrame, crowd: int = CROWD) -> DataFrame:
    """Links (a, b) that join the same fingerprints into groups as all pairs within two bits would."""
    keys = settled(fuzzy_keys(distinct))
    sizes = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = keys.join(sizes, "key")
    listed = shared.where(F.col("n") <= crowd).groupBy("key").agg(F.sort_array(F.collect_list("fp")).alias("fps"))
    pairs = (
        listed.select("fps", F.posexplode("fps").alias("i", "a"))
        .withColumn("b", F.explode(F.filter(F.expr("slice(fps, i + 2, size(fps))"), lambda b: F.bit_count(F.col("a").bitwiseXOR(b)) <= 2)))
        .select("a", "b")
    )
    return pairs.union(_crowded_links(shared.where(F.col("n") > crowd).select("fp").distinct()))


def _crowded_links(crowded: DataFrame) -> DataFrame:
    """Exact links for fingerprints of crowded keys, in numbers that grow with the fingerprints and not with their pairs.

    Two fingerprints are within two bits exactly if some centre is within one bit of both, so all that share a centre are
    linked to the smallest of them.
    """
    centres = crowded.select(
        "fp", F.explode(F.array(F.col("fp"), *(F.col("fp").bitwiseXOR(F.lit(1 << i if i < 63 else -(1 << 63))) for i in range(64)))).alias("centre")
    )
    lowest = centres.groupBy("centre").agg(F.min("fp").alias("low"), F.count(F.lit(1)).alias("n")).where("n > 1")
    return centres.join(lowest, "centre").where("fp <> low").select(F.col("fp").alias("a"), F.col("low").alias("b")).distinct()


def near_duplicates(docs: DataFrame, crowd: int = CROWD) -> DataFrame:
    """(doc_id, mark, fp, component, component_id) of every row of ``docs``; component names a group even if no member has an id."""
    marked = settled(fingerprints(docs))
    distinct = marked.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    grouped = components(near_links(distinct, crowd))
    named = distinct.join(grouped, distinct["fp"] == grouped["node"], "left").select(
        F.col("fp").alias("named_fp"), "first_id", F.coalesce("component", "fp").alias("component")
    )
    ids = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    by_fp = named.join(ids, "component").select("named_fp", "component", "component_id")
    return marked.join(by_fp, marked["fp"] == by_fp["named_fp"]).drop("named_fp")


def one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group of near duplicates: the first by doc_id, then by hash of the text; ids before null."""
    return first_of_groups(docs, near_duplicates(docs))


def first_of_groups(docs: DataFrame, grouped: DataFrame) -> DataFrame:
    """The first row of each component of ``grouped`` (doc_id, mark, component of every row of ``docs``)."""
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "mark")
    first = grouped.groupBy("component").agg(F.min(order).alias("low"))
    first = first.select(F.col("low.doc_id").alias("kept_id"), F.col("low.mark").alias("kept_mark"))
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    rows = rows.withColumn("own_id", F.col("row.doc_id").cast("long")).withColumn("own_mark", _mark("row.text"))
    kept = rows.join(first, F.col("own_id").eqNullSafe(F.col("kept_id")) & (F.col("own_mark") == F.col("kept_mark")), "left_semi")
    # What is left twice now is a repeated row.
    return kept.dropDuplicates(["own_id", "own_mark"]).select("row.*")
