"""Suffix-array dedup: every byte covered by a string of ``length`` bytes that also starts elsewhere goes.

Strings meet by content. Each string of ``length`` bytes has an anchor, its piece of ``ANCHOR`` bytes with the smallest hash; equal
strings have equal anchors. Neighbouring strings with one anchor form a context of less than twice the length. Parts of the documents, dealt by place,
first count their anchors in hash buckets; contexts whose anchor occurs once in the corpus stay behind. The others meet by
anchor, whole anchors at a time, as one text of about ``BATCH_BYTES``, whose Burrows-Wheeler transform is searched: breadth-first
backward extension finds the common prefixes of neighbouring suffixes by increasing value and stops at ``length``. Suffixes
with no boundary between them share that many bytes.

An anchor with more than ``CROWD`` contexts sends them cut into single strings, which are counted by 128 bits of hash (anchor and
string) without their bytes; so no task holds an unbounded group.

A null or short text has no strings and stays whole; a null doc_id stays null; repeated rows are copies of each other like any; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import partitions
from .ranges import dealt
from .rolling import BASE, INVERSE, mixed, powers
from .substring import _intervals, _pack, _unpack

LENGTH = 200
ANCHOR = 64
CROWD = 2_000
#: Buckets of anchors for each shuffle partition.
BUCKETS_PER_TASK = 2
PART_BYTES = 8 << 20
SLICE_BYTES = 1 << 20
BATCH_BYTES = 1 << 20
PLACE_BITS = 24
#: Elements that one step of a breadth-first level expands.
STEP = 1 << 22
RESULT = "doc_id long, n_bytes long, n_removed long, removed array<struct<start: long, stop: long>>, kept_sha256 string"
_BYTES = np.random.default_rng(20240302).integers(0, 1 << 64, 256, np.uint64, endpoint=False)


class _Contexts:
    """The contexts of some texts: anchor and content hash, first string and number of strings, as places in the joined bytes."""

    def __init__(self, texts: list[bytes], length: int, anchor: int):
        self.data, self.count = b"".join(texts), len(texts)
        self.length = length
        codes = np.frombuffer(self.data, np.uint8)
        n = len(codes)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTES[codes] * powers(BASE, n), dtype=np.uint64, out=self.sums[1:])
        self.back = powers(INVERSE, n + 1)
        empty = np.zeros(0, np.int64)
        self.anchors, self.contents, self.starts, self.sizes = empty.astype(np.uint64), empty.astype(np.uint64), empty, empty
        strings = n - length + 1
        if strings <= 0:
            return
        pieces = self.hashes(np.arange(n - anchor + 1), anchor)
        # As many bits for the place in every slice, so that equal strings choose alike whatever lies around them.
        bits = np.uint64(max(PLACE_BITS, n.bit_length()))
        # The smallest hash, of equal ones the leftmost, over each string's pieces.
        least = (pieces >> bits << bits) | np.arange(len(pieces), dtype=np.uint64)
        width, done = length - anchor + 1, 1
        while 2 * done <= width:
            least = np.minimum(least[:-done], least[done:])
            done *= 2
        if width > done:
            least = np.minimum(least[: strings], least[width - done : width - done + strings])
        at = (least[:strings] & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
        ends = np.cumsum([len(t) for t in texts])
        doc = np.searchsorted(ends, np.arange(strings), side="right")
        inside = np.arange(strings) + length <= ends[np.minimum(doc, len(ends) - 1)]
        at[~inside] = -1
        fresh = np.ones(strings, bool)
        fresh[1:] = (at[1:] != at[:-1]) | (doc[1:] != doc[:-1])
        starts = np.flatnonzero(fresh)
        sizes = np.diff(starts, append=strings)
        kept = at[starts] >= 0
        self.starts, self.sizes = starts[kept], sizes[kept]
        place = at[self.starts]
        self.anchors = pieces[place]
        shape = self.sizes.astype(np.uint64) * np.uint64(0x2545F4914F6CDD1D) + (place - self.starts).astype(np.uint64)
        self.contents = mixed(self.hashes(self.starts, self.sizes + length - 1) + mixed(shape))

    def hashes(self, starts: np.ndarray, sizes: np.ndarray | int) -> np.ndarray:
        return mixed((self.sums[starts + sizes] - self.sums[starts]) * self.back[starts])

    def strings(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the single strings of the given contexts, and whose they are."""
        sizes = self.sizes[which]
        owner = np.repeat(which, sizes)
        within = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        return self.starts[owner] + within, owner

    def single_keys(self, places: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Key and hash of single strings of crowded anchors."""
        own = self.hashes(places, self.length)
        return mixed(self.anchors[owners] ^ (own << np.uint64(1))), own


def _sliced(texts: list[bytes], length: int, anchor: int) -> Iterator[tuple[int, _Contexts]]:
    """(number of the first text, contexts) of slices of about SLICE_BYTES."""
    start = size = 0
    for i, text in enumerate(texts):
        if i > start and size + len(text) > SLICE_BYTES:
            yield start, _Contexts(texts[start:i], length, anchor)
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, _Contexts(texts[start:], length, anchor)


def _tally(keys: np.ndarray, contents: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (key, content) in order, how often each occurs, and whether it is the first of its key."""
    order = np.lexsort((contents, keys))
    keys, contents = keys[order], contents[order]
    first = np.ones(len(keys), bool)
    first[1:] = keys[1:] != keys[:-1]
    fresh = first.copy()
    fresh[1:] |= contents[1:] != contents[:-1]
    at = np.flatnonzero(fresh)
    return keys[at], contents[at], np.diff(at, append=len(keys)), first[at]


def _answers(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys, contents and bits (a row of bytes each) of the answers of a range, by rising content."""
    keys = table.column("key").to_numpy().astype(np.int64).view(np.uint64)
    contents = table.column("content").to_numpy().astype(np.int64).view(np.uint64)
    packed = table.column("bits").to_pylist()
    wide = max(map(len, packed), default=1)
    bits = np.frombuffer(b"".join(b.ljust(wide, b"\0") for b in packed), np.uint8).reshape(len(packed), wide)
    order = np.argsort(contents, kind="stable")
    return keys[order], contents[order], bits[order]


def _ordered(table: pa.Table) -> pa.Table:
    return table.sort_by([("doc_id", "ascending"), ("text", "ascending")])


def _texts(table: pa.Table) -> list[bytes]:
    return [t.encode() for t in table.column("text").to_pylist()]


def repeated_strings(contents: list[bytes], weights: list[int], length: int) -> list[np.ndarray]:
    """For each content, which of its strings of ``length`` bytes occur at least twice, counting a content ``weight`` times."""
    sizes = np.fromiter(map(len, contents), np.int64, len(contents))
    # Symbols 1 to 256 are bytes; 0 ends a content, so no string that counts holds it.
    symbols = np.frombuffer(b"\0".join(contents) + b"\0", np.uint8).astype(np.int64) + 1
    ends = np.cumsum(sizes + 1) - 1
    symbols[ends] = 0
    order = _suffix_order(symbols, length)
    starts = ends - sizes
    n = len(symbols)
    owner = np.repeat(np.arange(len(contents)), sizes + 1)
    whole = np.arange(n) + length <= ends[owner]
    bounds = _boundaries(symbols, order, length)
    groups = np.cumsum(bounds[:-1]) - 1
    weight = np.where(whole, np.array(weights, np.int64)[owner], 0)[order]
    totals = np.bincount(groups, weight)
    hit = np.zeros(n, bool)
    hit[order] = (totals[groups] >= 2) & (weight > 0)
    return [hit[a : a + max(0, s - length + 1)] for a, s in zip(starts.tolist(), sizes.tolist())]


def _suffix_order(symbols: np.ndarray, length: int) -> np.ndarray:
    """Suffixes sorted by at least their first ``length`` + 1 symbols, by prefix doubling from seven symbols on."""
    n = len(symbols)
    padded = np.append(symbols, np.zeros(7, np.int64))
    key = np.zeros(n, np.int64)
    for i in range(7):
        key = (key << 9) | padded[i : i + n]
    known = 7
    while True:
        order = np.argsort(key)
        ordered = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.append(True, ordered[1:] != ordered[:-1]))
        if known > length or rank[order[-1]] == n:
            return order
        after = np.zeros(n, np.int64)
        after[:-known] = rank[known:]
        key = rank * (n + 1) + after
        known *= 2


def _boundaries(symbols: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """Where suffix ``i`` shares less than ``length`` symbols with suffix ``i - 1`` (n + 1 places, the ends included)."""
    n = len(symbols)
    transform = symbols[order - 1]
    by_symbol = np.argsort(transform.astype(np.uint16), kind="stable")
    step_back = np.empty(n, np.int64)  # from a suffix to the one a symbol longer
    step_back[by_symbol] = np.arange(n)
    places = transform[by_symbol] * n + by_symbol
    following = np.full(n, n, np.int64)  # the next place with the same symbol
    same = transform[by_symbol[1:]] == transform[by_symbol[:-1]]
    following[by_symbol[:-1][same]] = by_symbol[1:][same]
    known = np.zeros(n + 1, bool)
    known[[0, n]] = True
    low, high = np.array([0]), np.array([n])  # half-open intervals of suffixes with a common prefix
    for _ in range(length):
        found_low, found_high = [], []
        sizes = high - low
        cuts = np.searchsorted(np.cumsum(sizes), np.arange(STEP, int(sizes.sum()) + STEP, STEP), side="left") + 1
        begin = 0
        for cut in [*np.unique(np.minimum(cuts, len(sizes))).tolist()]:
            lows, highs, own = low[begin:cut], high[begin:cut], sizes[begin:cut]
            begin = cut
            which = np.repeat(np.arange(len(own)), own)
            at = np.arange(len(which)) - np.repeat(np.cumsum(own) - own, own) + lows[which]
            last = following[at] >= highs[which]
            at, which = at[last], which[last]
            ends = step_back[at] + 1
            fresh = ~known[ends]
            at, which, ends = at[fresh], which[fresh], ends[fresh]
            known[ends] = True
            found_low.append(np.searchsorted(places, transform[at] * n + lows[which]))
            found_high.append(ends)
        if not found_low:
            break
        low, high = np.concatenate(found_low), np.concatenate(found_high)
        if not len(low):
            break
    return known


def _search(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Answers rows that come by rising (key, content): which strings of each context are repeated, for those with any."""
    held: list[tuple] = []
    size, last = 0, None

    def answered() -> Iterator[pa.RecordBatch]:
        distinct: dict[tuple[int, int], list] = {}
        for key, content, part, n, text in held:
            own = distinct.setdefault((key, content), [text, 0, []])
            own[1] += n
            own[2].append(part)
        # A context that is the only one of its anchor has no other to share strings with, unless it holds one twice itself.
        alone = Counter(key for key, _ in distinct)
        texted, hits = {}, {}
        for k, v in distinct.items():
            if v[0] is None or alone[k[0]] == 1 and v[1] >= 2:
                hits[k] = np.full(1 if v[0] is None else len(v[0]) - length + 1, v[1] >= 2)
            else:
                texted[k] = v
        if texted:
            hits |= zip(texted, repeated_strings([v[0] for v in texted.values()], [v[1] for v in texted.values()], length))
        rows = [(part, *k, np.packbits(hits[k]).tobytes()) for k, v in distinct.items() if hits[k].any() for part in v[2]]
        if rows:
            kinds = (pa.int32(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["part", "key", "content", "bits"])

    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in ("key", "content", "part", "n", "text"))):
            if row[0] != last and size >= BATCH_BYTES:
                yield from answered()
                held, size = [], 0
            if row[:2] != (held[-1][:2] if held else None):
                size += len(row[4]) if row[4] is not None else 16
            last = row[0]
            held.append(row)
    if held:
        yield from answered()


def dedup_bytes(docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR, part_bytes: int = PART_BYTES, crowd: int = CROWD) -> DataFrame:
    """Per document its bytes, the maximal removed runs, and the hash of the bytes that stay."""
    n_tasks = partitions(docs.sparkSession)
    rows, _ = dealt(docs, part_bytes)
    by_part = rows.repartition(n_tasks, "part")
    # By the tasks, not by the parts, so that the rows sent grow with the corpus and not with its square.
    buckets = BUCKETS_PER_TASK * n_tasks
    bounds = np.array([(i << 64) // buckets for i in range(1, buckets)], np.uint64)

    def send(table: pa.Table) -> pa.Table:
        found = [c for _, c in _sliced(_texts(_ordered(table)), length, anchor)]
        anchors = np.concatenate([c.anchors for c in found])
        anchors, _, occur, first = _tally(anchors, np.concatenate([c.contents for c in found]))
        begins = np.flatnonzero(first)
        own, contexts = anchors[begins], np.diff(begins, append=len(anchors))
        occur = np.add.reduceat(occur, begins) if len(begins) else occur
        stops = np.append(np.searchsorted(own, bounds), len(own))
        spans = [(b, z - s, z) for b, (z, s) in enumerate(zip(stops.tolist(), np.diff(stops, prepend=0).tolist())) if s]
        number = table.column("part")[0].as_py()
        return pa.table(
            {
                "bucket": pa.array([b for b, _, _ in spans], pa.int32()),
                "part": pa.array([number] * len(spans), pa.int32()),
                "anchors": pa.array([_pack(own[a:z]) for _, a, z in spans], pa.binary()),
                "occur": pa.array([np.minimum(occur[a:z], 2).astype(np.uint8).tobytes() for _, a, z in spans], pa.binary()),
                "contexts": pa.array([contexts[a:z].astype(np.uint32).tobytes() for _, a, z in spans], pa.binary()),
            }
        )

    def answer(table: pa.Table) -> pa.Table:
        lists = [_unpack(x) for x in table.column("anchors").to_pylist()]
        occur = np.frombuffer(b"".join(table.column("occur").to_pylist()), np.uint8)
        contexts = np.frombuffer(b"".join(table.column("contexts").to_pylist()), np.uint32)
        _, which = np.unique(np.concatenate(lists), return_inverse=True)
        crowded = np.bincount(which, contexts) > crowd
        state = ((np.bincount(which, occur) >= 2) * (1 + crowded)).astype(np.uint8)[which]
        states = [s.tobytes() for s in np.split(state, np.cumsum([len(x) for x in lists])[:-1])]
        return pa.table({"bucket": table.column("bucket"), "part": table.column("part"), "states": pa.array(states, pa.binary())})

    def states_of(anchors: np.ndarray, answers: pa.Table) -> np.ndarray:
        """0, 1 or 2 for each anchor: alone, repeated, crowded."""
        own, which = np.unique(anchors, return_inverse=True)
        stops = [0, *np.searchsorted(own, bounds).tolist(), len(own)]
        state = np.zeros(len(own), np.uint8)
        for bucket, states in zip(answers.column("bucket").to_pylist(), answers.column("states").to_pylist()):
            state[stops[bucket] : stops[bucket + 1]] = np.frombuffer(states, np.uint8)
        return state[which]

    def emit(table: pa.Table, answers: pa.Table) -> pa.Table:
        found = [c for _, c in _sliced(_texts(_ordered(table)), length, anchor)]
        state = states_of(np.concatenate([c.anchors for c in found]), answers) if found else np.zeros(0, np.uint8)
        held: dict[tuple[int, int], list] = {}
        at = 0
        for c in found:
            own = state[at : at + len(c.anchors)]
            at += len(c.anchors)
            for i in np.flatnonzero(own == 1).tolist():
                k = (int(c.anchors[i]), int(c.contents[i]))
                if k in held:
                    held[k][0] += 1
                else:
                    begin = int(c.starts[i])
                    held[k] = [1, c.data[begin : begin + int(c.sizes[i]) + length - 1]]
            crowded = np.flatnonzero(own == 2)
            if len(crowded):
                # A row with content 0 tells the range on its way back which anchors were cut into single strings.
                held |= {(key, 0): [2, None] for key in np.unique(c.anchors[crowded]).tolist()}
                keys, contents, counts, _ = _tally(*c.single_keys(*c.strings(crowded)))
                for key, content, n in zip(keys.tolist(), contents.tolist(), counts.tolist()):
                    held.setdefault((key, content), [0, None])[0] += n
        number = table.column("part")[0].as_py() if len(table) else 0
        signed = lambda values: pa.array(np.array(values, np.uint64).view(np.int64))
        return pa.table(
            {
                "key": signed([k for k, _ in held]),
                "content": signed([c for _, c in held]),
                "part": pa.array([number] * len(held), pa.int32()),
                "n": pa.array([min(2, v[0]) for v in held.values()], pa.int32()),
                "text": pa.array([v[1] for v in held.values()], pa.binary()),
            }
        )

    def cut(table: pa.Table, answers: pa.Table) -> pa.Table:
        table = _ordered(table)
        texts = _texts(table)
        keys, contents, bits = _answers(answers)
        spans, kept = [], []
        for begin, c in _sliced(texts, length, anchor):
            edges = np.zeros(len(c.data) + length + 1, np.int32)
            row = np.minimum(np.searchsorted(contents, c.contents), max(0, len(contents) - 1))
            known = np.flatnonzero((contents[row] == c.contents) & (keys[row] == c.anchors)) if len(contents) else row[:0]
            which, within = np.nonzero(np.unpackbits(bits[row[known]], axis=1))
            at = c.starts[known][which] + within
            np.add.at(edges, at, 1)
            np.add.at(edges, at + length, -1)
            crowded = np.flatnonzero(np.isin(c.anchors, keys[contents == 0]))
            places, owners = c.strings(crowded)
            single = np.isin(c.single_keys(places, owners)[0], keys) if len(places) else np.zeros(0, bool)
            np.add.at(edges, places[single], 1)
            np.add.at(edges, places[single] + length, -1)
            mask = np.cumsum(edges)[: len(c.data)] > 0
            at = 0
            for text in texts[begin : begin + c.count]:
                own = mask[at : at + len(text)]
                at += len(text)
                spans.append(_intervals(own) if own.any() else [])
                stays = np.frombuffer(text, np.uint8)[~own].tobytes() if spans[-1] else text
                kept.append(hashlib.sha256(stays).hexdigest())
        kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
        return pa.table(
            {
                "doc_id": table.column("doc_id"),
                "n_bytes": pa.array([len(t) for t in texts], pa.int64()),
                "n_removed": pa.array([sum(z - a for a, z in s) for s in spans], pa.int64()),
                "removed": pa.array([[{"start": a, "stop": z} for a, z in s] for s in spans], kind),
                "kept_sha256": pa.array(kept, pa.string()),
            }
        )

    sent = by_part.groupBy("part").applyInArrow(send, "bucket int, part int, anchors binary, occur binary, contexts binary")
    states = sent.repartition(n_tasks, "bucket").groupBy("bucket").applyInArrow(answer, "bucket int, part int, states binary")
    texted = by_part.groupBy("part").cogroup(states.repartition(n_tasks, "part").groupBy("part"))
    contexts = texted.applyInArrow(emit, "key long, content long, part int, n int, text binary")
    met = contexts.repartition(n_tasks, "key").sortWithinPartitions("key", "content")
    found = met.mapInArrow(lambda batches: _search(batches, length), "part int, key long, content long, bits binary")
    return by_part.groupBy("part").cogroup(found.repartition(n_tasks, "part").groupBy("part")).applyInArrow(cut, RESULT)
