"""Alignment of the tokens of two tokenizers by the bytes that they cover.

Tokenizer A is a byte-level BPE and gets a space before the text; tokenizer B is a SentencePiece model, which adds that space
itself. Both streams of tokens cover the same bytes. Two pointers walk over them: the pair under the pointers overlaps, so it is a
link; the pointer whose token ends first moves on, and where both end together there is a cut and both move. All documents of a
step are walked in lockstep: one vector holds the pointers of every document, each turn emits a link (and perhaps a cut) for
each of them, and documents that are done are compacted away. A long document enters as several lanes, parted at cuts that are looked
for near every ``LANE`` tokens, so that the number of turns does not follow the longest text.

Counts of id pairs are corpus-wide: tasks add up their own links before anything is shuffled. The frequent pairs, at most
``FREQUENT`` by proof (each has at least that share of all links), are joined by broadcast; only links of rarer pairs are shuffled.

A text that is null, empty, or not covered by either tokenizer's bytes has no tokens: zeros and an empty ``groups``. A null
doc_id stays null, repeated rows are aligned each and all count, an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import map_steps, stored, texts
from .sentence_pieces import MARKER, chunk_table

STEP_BYTES = 2 << 20
LANE = 1024
#: Tokens after every ``LANE`` among which a cut is looked for; without one the lane goes on.
LOOK = 64
FREQUENT = 1 << 18
ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, a array<int>, b array<int>, n array<int>"


def byte_alphabet() -> dict[str, int]:
    """The character that byte-level vocabularies write for each byte: printable ones stand for themselves, the rest follow from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class Aligner:
    """Both tokenizers, the bytes of their entries, and the names of the entries as they stand in ``groups``."""

    def __init__(self, byte_path: str, piece_path: str, pattern: str):
        import tiktoken

        with open(byte_path, encoding="utf-8") as file:
            vocabulary = json.load(file)
        alphabet, special = byte_alphabet(), {t["id"] for t in vocabulary["added_tokens"]}
        entries = {bytes(map(alphabet.__getitem__, t)): i for t, i in vocabulary["model"]["vocab"].items() if i not in special}
        _refuse_other_merges(vocabulary["model"]["merges"], alphabet, entries)
        self.a = tiktoken.Encoding("a", pat_str=pattern, mergeable_ranks=entries, special_tokens={})
        self.b = chunk_table(piece_path)
        model = self.b.model
        pieces = [(model.id_to_piece(i), model.is_byte(i)) for i in range(model.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if is_byte else p.replace(MARKER, " ").encode() for p, is_byte in pieces]
        self.a_lengths = np.ones(max(entries.values()) + 1, np.int64)
        self.a_lengths[list(entries.values())] = list(map(len, entries))
        self.b_lengths = np.array(list(map(len, self.b_bytes)), np.int64)
        self.a_names, self.b_names = (_names(n, last) for n, last in ((len(self.a_lengths), "|"), (len(self.b_lengths), ";")))

    def tokens(self, batch: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of both tokenizers, without any for texts that they do not both cover."""
        none = np.empty(0, np.int64)
        found_a, found_b = [], []
        for text, piece_ids in zip(batch, self.b(batch)):
            b = np.frombuffer(piece_ids, "<i4").astype(np.int64)
            a = self.a.encode_ordinary(" " + text) if text else []
            marked = (" " + text).encode()
            whole = self.a.decode_bytes(a) == marked == b"".join(map(self.b_bytes.__getitem__, b.tolist()))
            found_a.append(np.array(a, np.int64) if whole else none)
            found_b.append(b if whole else none)
        return found_a, found_b


def _refuse_other_merges(merges: list, alphabet: dict[str, int], entries: dict[bytes, int]) -> None:
    """Ids must follow the order of the merges, as they serve as ranks."""
    pairs = (m.split(" ") if isinstance(m, str) else m for m in merges)
    ranks = [entries[bytes(alphabet[c] for c in left + right)] for left, right in pairs]
    if ranks != sorted(ranks):
        raise ValueError("the ids of this vocabulary do not follow the order of its merges")


def _names(size: int, last: str) -> np.ndarray:
    """Entry 2 * id is the id and a comma, entry 2 * id + 1 the id and what ends its part of a group."""
    return np.array([f"{i}{end}" for i in range(size) for end in (",", last)], object)


@lru_cache(maxsize=1)
def _aligner(byte_path: str, piece_path: str, pattern: str) -> Aligner:
    return Aligner(byte_path, piece_path, pattern)


def _starts(sizes: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(sizes)])


def _lanes(a_ends: np.ndarray, b_ends: np.ndarray, a_start: np.ndarray, b_start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First A and B token of every lane; lanes begin where documents do, and in long ones at a cut near every ``LANE`` tokens."""
    i, j = [a_start[:-1]], [b_start[:-1]]
    for doc in np.flatnonzero(np.diff(a_start) > 2 * LANE):
        own_a, own_b = a_ends[a_start[doc] : a_start[doc + 1]], b_ends[b_start[doc] : b_start[doc + 1]]
        look = np.arange(LANE, len(own_a) - LOOK, LANE)[:, None] + np.arange(LOOK)
        at = np.searchsorted(own_b, own_a[look])
        shared = own_b[at] == own_a[look]
        first, rows = shared.argmax(axis=1), shared.any(axis=1)
        i.append(a_start[doc] + look[rows, first[rows]] + 1)
        j.append(b_start[doc] + at[rows, first[rows]] + 1)
    return np.sort(np.concatenate(i)), np.sort(np.concatenate(j))


def lockstep(a_ends: np.ndarray, b_ends: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(A token, B token, whether both end there) of every link, by walking all lanes at once.

    Lane k goes from tokens ``i[k]`` and ``j[k]`` to those of the next lane; ends must rise from lane to lane as well.
    """
    stop = np.append(i[1:], len(a_ends))
    i, j, stop = (x[i < stop] for x in (i, j, stop))
    links_a, links_b, cuts = [], [], []
    while len(i):
        end_a, end_b = a_ends[i], b_ends[j]
        links_a.append(i)
        links_b.append(j)
        cuts.append(end_a == end_b)
        i, j = i + (end_a <= end_b), j + (end_b <= end_a)
        going = i < stop
        if not going.all():
            i, j, stop = i[going], j[going], stop[going]
    if not links_a:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)
    return np.concatenate(links_a), np.concatenate(links_b), np.concatenate(cuts)


def _group_texts(aligner: Aligner, a: np.ndarray, b: np.ndarray, a_last: np.ndarray, b_last: np.ndarray, stops: np.ndarray) -> list[str]:
    """Per document ``a1,a2|b1;a3|b2,b3``: groups in order, A ids before B ids. ``stops`` are where documents end in both streams together."""
    a_stops, b_stops = np.flatnonzero(a_last) + 1, np.flatnonzero(b_last) + 1
    a_group, b_group = np.cumsum(a_last) - a_last, np.cumsum(b_last) - b_last
    names = np.empty(len(a) + len(b), object)
    names[np.arange(len(a)) + np.append(0, b_stops)[a_group]] = aligner.a_names[2 * a + a_last]
    names[np.arange(len(b)) + np.append(a_stops, 0)[b_group]] = aligner.b_names[2 * b + b_last]
    listed = names.tolist()
    return ["".join(listed[s:e])[:-1] for s, e in zip(stops[:-1].tolist(), stops[1:].tolist())]


def align_step(aligner: Aligner, batch: list[str]) -> list[pa.Array]:
    """The columns of ``ALIGNED`` behind the id, for the texts of one step."""
    of_a, of_b = aligner.tokens(batch)
    a, b = np.concatenate(of_a), np.concatenate(of_b)
    a_start, b_start = (_starts(np.array(list(map(len, ids)))) for ids in (of_a, of_b))
    a_ends, b_ends = np.cumsum(aligner.a_lengths[a]), np.cumsum(aligner.b_lengths[b])
    link_a, link_b, cut = lockstep(a_ends, b_ends, *_lanes(a_ends, b_ends, a_start, b_start))
    a_last, b_last = np.zeros(len(a), bool), np.zeros(len(b), bool)
    a_last[link_a[cut]] = True
    b_last[link_b[cut]] = True
    groups = _group_texts(aligner, a, b, a_last, b_last, a_start + b_start)
    # A document's links of one id pair become one entry and their number.
    doc = np.searchsorted(a_start, link_a, side="right") - 1
    pairs, times = np.unique(doc << 40 | a[link_a] << 20 | b[link_b], return_counts=True)
    offsets = pa.array(np.searchsorted(pairs >> 40, np.arange(len(batch) + 1)), pa.int32())
    columns = (pairs >> 20 & (1 << 20) - 1, pairs & (1 << 20) - 1, times)
    counted = [np.diff(a_start), np.diff(b_start), np.diff(_starts(a_last)[a_start]), np.bincount(doc, minlength=len(batch))]
    return [
        *(pa.array(c, pa.int64()) for c in counted),
        pa.array(groups, pa.string()),
        *(pa.ListArray.from_arrays(offsets, pa.array(c, pa.int32())) for c in columns),
    ]


def align(docs: DataFrame, byte_path: str, piece_path: str, pattern: str) -> DataFrame:
    """The columns of ``ALIGNED``: per document its groups, and its links as id pairs (``a``, ``b``) with their number ``n``.

    ``byte_path`` and ``piece_path`` are opened by every worker and must be files of the installation; ``pattern`` is A's rule for
    cutting a text into words.
    """

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        columns = align_step(_aligner(byte_path, piece_path, pattern), batch.column("text").to_pylist())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], [c.split()[0] for c in ALIGNED.split(", ")])

    return map_steps(texts(docs, F.col("doc_id").cast("long").alias("doc_id")), run, ALIGNED, most=STEP_BYTES)


def _links(aligned: DataFrame) -> DataFrame:
    """(place, pair, n): the links of each row, the pair as one number."""
    pair = F.shiftleft(F.col("link.a").cast("long"), 20).bitwiseOR(F.col("link.b").cast("long"))
    return aligned.select("place", F.explode(F.arrays_zip("a", "b", "n")).alias("link")).select("place", pair.alias("pair"), F.col("link.n").alias("n"))


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, links, best): number of links of every id pair, and whether no pair of its B id has more."""
    counts = _links(aligned).groupBy("pair").agg(F.sum("n").alias("links"))
    # A B id meets at most as many A ids as the vocabulary has.
    of_b = Window.partitionBy(F.col("pair").bitwiseAND(F.lit((1 << 20) - 1)))
    return counts.withColumn("best", F.col("links") == F.max("links").over(of_b))


def align_and_count(docs: DataFrame, byte_path: str, piece_path: str, pattern: str, frequent: int = FREQUENT) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every document."""
    found = align(docs, byte_path, piece_path, pattern)
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    aligned = stored(found.withColumn("groups_sha256", digest).drop("groups").withColumn("place", F.monotonically_increasing_id()))
    counts = stored(pair_counts(aligned))
    links = aligned.agg(F.sum("n_links")).first()[0] or 0
    # At most ``frequent`` pairs can have that many links.
    often = F.broadcast(counts.where(F.col("links") >= max(1, -(-links // frequent))))
    often = often.select(F.col("pair").alias("often"), "links", "best")
    joined = _links(aligned).join(often, F.col("pair") == F.col("often"), "left")
    rare = joined.where("often is null").select("place", "pair", "n").join(counts, "pair").select("place", "n", "links", "best")
    summed = (
        joined.where("often is not null")
        .select("place", "n", "links", "best")
        .union(rare)
        .groupBy("place")
        .agg(F.sum(F.col("n") * F.col("best").cast("long")).alias("n_best"), F.sum(F.col("n") * F.col("links")).alias("count_sum"))
    )
    numbers = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_best", "count_sum")]
    return aligned.join(summed, "place", "left").select("doc_id", "n_a", "n_b", "n_groups", "n_links", *numbers, "groups_sha256")
