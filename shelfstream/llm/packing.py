"""Best-fit packing of tokenized documents into fixed-length sequences.

A null text is an empty document (its end token alone); a null doc_id stays null; repeated rows are packed as often as they
come; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import settled, steps, texts

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
#: Pieces that are packed together. A group leaves about half a sequence open, so more pieces to a group waste less.
GROUP_PIECES = 16_384
#: Bytes of words and ids that a task remembers; beyond it the memory starts anew.
MEMORY_BYTES = 400 << 20

_MARKED = re.compile(rb"[A-Z][\x80-\xff]")
# How tokenizers with word ends cut a text, and the same for folded ASCII words.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_RUNS = re.compile(rb"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")


class LetterRuns:
    """Ids of many runs of the letters a to z at once, by a BPE that marks the end of a word.

    A capital stands for the letter with the mark. The entries of letters alone then are a byte-level vocabulary whose ids serve
    as ranks, as they follow the order of the merges.
    """

    @staticmethod
    def of(path: str) -> LetterRuns | None:
        """None if the tokenizer at ``path`` cuts or numbers words in another way."""
        with open(path, encoding="utf-8") as file:
            rules = json.load(file)
        model, cuts = rules["model"], json.dumps(rules["pre_tokenizer"])
        mark = model.get("end_of_word_suffix")
        if not mark or json.dumps(WORD_PATTERN) not in cuts:
            return None
        merged = [model["vocab"]["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
        return LetterRuns(model["vocab"], mark) if merged == sorted(merged) else None

    def __init__(self, vocabulary: dict[str, int], mark: str):
        import tiktoken

        ranks = {}
        for entry, number in vocabulary.items():
            run = entry.removesuffix(mark)
            if run and run.isascii() and run.isalpha() and run.islower():
                ranks[(run if run == entry else run[:-1] + run[-1].upper()).encode()] = number
        size = max(vocabulary.values()) + 1
        self.ends = np.zeros(size + 256, bool)
        self.ends[[number for run, number in ranks.items() if run[-1:].isupper()]] = True
        # Every byte needs a rank; those that no run has come last.
        ranks |= {bytes([b]): size + b for b in range(256) if bytes([b]) not in ranks}
        self.bpe = tiktoken.Encoding("runs", pat_str="[a-z]*[A-Z]", mergeable_ranks=ranks, special_tokens={})

    def __call__(self, runs: list[bytes]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each run."""
        ids = np.array(self.bpe.encode_ordinary(b"".join(r[:-1] + r[-1:].upper() for r in runs).decode()), "<u4")
        data, stops = ids.tobytes(), (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
        return [data[a:z] for a, z in zip([0, *stops], stops)]


class WordIds:
    """Token ids of texts by a tokenizer that never merges across ASCII white space, remembered word by word.

    ``boundary`` is one of its special tokens; new words are encoded in one text with that token between them. With ``folds`` the
    tokenizer must fold case and split letters from punctuation, as words are then looked up in lower case, and a closing stop or comma apart.
    """

    def __init__(self, path: str, boundary: str, folds: bool = True, memory_bytes: int = MEMORY_BYTES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.boundary, self.boundary_id = boundary, self.tokenizer.token_to_id(boundary)
        self.specials = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.starts = {s[:2] for s in self.specials}
        self.folds, self.memory_bytes = folds, memory_bytes
        self.letters = LetterRuns.of(path) if folds else None
        self.known: dict[bytes, bytes] = {}
        self.held = 0

    def _words(self, text: str) -> list[bytes]:
        raw = text.encode()
        # Folding could make or break a special token, so texts that hold its start stay as they are.
        if not self.folds or any(start in raw for start in self.starts):
            return raw.split()
        # The tokenizer composes characters before it folds: a capital before a combining mark is not folded here.
        if _MARKED.search(raw):
            return [w.lower() if w.isascii() else w for w in raw.split()]
        return raw.lower().split()

    def _learn(self, words: list[bytes]) -> None:
        if self.folds:
            # A stop or comma after a letter is a word of its own to the tokenizer.
            whole = [w for w in words if w[-1:] in (b".", b",") and w[-2:-1].isalpha()]
            self._encode(list({w for w in (w[:-1] for w in whole)}.union((b".", b","), words).difference(whole, self.known)))
            self.known.update((w, self.known[w[:-1]] + self.known[w[-1:]]) for w in whole)
            self.held += sum(5 * len(w) + 100 for w in whole)
        else:
            self._encode(words)

    def _encode(self, words: list[bytes]) -> None:
        if self.letters:
            # Folded ASCII words fall into runs, most of which are letters.
            plain = [w for w in words if w.isascii() and w == w.lower()]
            if any(start in b" ".join(plain) for start in self.starts):
                plain = [w for w in plain if not any(start in w for start in self.starts)]
            split = dict(zip(plain, map(_RUNS.findall, plain)))
            runs = {r for own in split.values() for r in own}.difference(self.known)
            letters = [r for r in runs if r.isalpha()]
            self.known.update(zip(letters, self.letters(letters)))
            self.held += sum(map(len, letters)) + 200 * len(letters)
            self._encode_by_library([*runs.difference(letters), *(w for w in words if w not in split)])
            parted = {w: b"".join(map(self.known.__getitem__, own)) for w, own in split.items() if w not in self.known}
            self.known |= parted
            self.held += sum(5 * len(w) + 180 for w in parted)
        else:
            self._encode_by_library(words)

    def _encode_by_library(self, words: list[bytes]) -> None:
        odd = []
        for start in range(0, len(words), 2048):
            part = words[start : start + 2048]
            if any(start in b" ".join(part) for start in self.starts):
                odd += [w for w in part if any(start in w for start in self.starts)]
                part = list(set(part).difference(odd))
            text = b" ".join(part).decode().replace(" ", self.boundary)
            ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
            stops = [*(4 * np.flatnonzero(ids == self.boundary_id)).tolist(), 4 * len(ids)]
            data, at = ids.tobytes(), 0
            for word, stop in zip(part, stops, strict=True) if part else ():
                self.known[word] = data[at:stop]
                at = stop + 4
            self.held += sum(map(len, part)) + 4 * len(ids) + 180 * len(part)
        for word in odd:
            self.known[word] = np.array(self.tokenizer.encode(word.decode(), add_special_tokens=False).ids, "<u4").tobytes()
            self.held += 5 * len(word) + 180

    def __call__(self, batch: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        if self.held > self.memory_bytes:
            self.known, self.held = {}, 0
        split = [self._words(text) for text in batch]
        found = [list(map(self.known.get, words)) for words in split]
        gaps = [[at for at, ids in enumerate(own) if ids is None] for own in found]
        self._learn(list({words[at] for words, places in zip(split, gaps) for at in places}))
        for words, own, places in zip(split, found, gaps):
            for at in places:
                own[at] = self.known[words[at]]
        return [b"".join(ids) for ids in found]


@lru_cache(maxsize=1)
def _word_ids(path: str, boundary: str) -> WordIds:
    """One memory for all tasks that a Python worker runs."""
    return WordIds(path, boundary)


def tokenized_pieces(docs: DataFrame, tokenizer_path: str, boundary: str = "<|endoftext|>", sequence_length: int = 4096, end_id: int = 1) -> DataFrame:
    """Pieces of at most ``sequence_length`` ids per document, its end id included; only longer documents are cut.

    ``tokenizer_path`` is opened by every task and must be a file of the installation.
    """
    end = end_id.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = _word_ids(tokenizer_path, boundary)
        for batch in (step for batch in batches for step in steps(batch)):
            rows = []
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), ids_of(batch.column("text").to_pylist())):
                ids += end
                for piece, at in enumerate(range(0, len(ids), 4 * sequence_length)):
                    part = ids[at : at + 4 * sequence_length]
                    rows.append((doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part)))
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], [c.split()[0] for c in PIECES.split(", ")]
            )

    return texts(docs, F.col("doc_id").cast("long").alias("doc_id")).mapInArrow(run, PIECES)


class OpenBins:
    """Bins by remaining capacity under a segment tree that counts the bins of each capacity.

    ``take`` finds the tightest bin that holds a length in one walk up and down the tree.
    """

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.bins: dict[int, list[int]] = {}

    def put(self, remaining: int, number: int) -> None:
        self.bins.setdefault(remaining, []).append(number)
        self._add(remaining, 1)

    def take(self, length: int) -> tuple[int, int] | None:
        """(bin, its remaining capacity) of the smallest remaining capacity that is at least ``length``."""
        at = length + self.leaves
        if not self.count[at]:
            while at > 1 and (at & 1 or not self.count[at + 1]):
                at >>= 1
            if at <= 1:
                return None
            at += 1
            while at < self.leaves:
                at = 2 * at if self.count[2 * at] else 2 * at + 1
        remaining = at - self.leaves
        self._add(remaining, -1)
        return self.bins[remaining].pop(), remaining

    def _add(self, remaining: int, change: int) -> None:
        at = remaining + self.leaves
        while at:
            self.count[at] += change
            at >>= 1


def best_fit_decreasing(lengths: list[int], capacity: int) -> tuple[list[int], list[int]]:
    """Bin and offset of each length; ``lengths`` must fall."""
    bins, offsets, tree, made = [], [], OpenBins(capacity), 0
    for length in lengths:
        found = tree.take(length)
        if found is None:
            found, made = (made, capacity), made + 1
        number, remaining = found
        bins.append(number)
        offsets.append(capacity - remaining)
        if remaining > length:
            tree.put(remaining - length, number)
    return bins, offsets


def pack(pieces: DataFrame, sequence_length: int = 4096, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """``pieces`` (with ``length`` from 1 to ``sequence_length``) with ``sequence_id`` and a gapless ``offset``.

    Pieces are dealt by hash into groups of about ``group_pieces``; each group is packed by best fit decreasing on its own, so
    no task holds more than a group and all sequences but about one per group are as full as a whole-table run leaves them.
    """
    pieces = settled(pieces)
    groups = max(1, -(-pieces.count() // group_pieces))
    schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in pieces.schema)}, sequence_id long, offset long"

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "doc_id", "piece"], ascending=[False, True, True], ignore_index=True)
        bins, offsets = best_fit_decreasing(rows["length"].tolist(), sequence_length)
        rows["sequence_id"] = pd.Series(bins, dtype="int64") + (int(key[0]) << 32)
        rows["offset"] = pd.Series(offsets, dtype="int64")
        return rows.drop(columns="packing_group")

    # By place in the settled frame, as ids can repeat or lack; a hash of its own, since the shuffle deals groups by another.
    dealt = pieces.withColumn("packing_group", F.pmod(F.xxhash64(F.lit(7), F.monotonically_increasing_id()), F.lit(groups)))
    return dealt.groupBy("packing_group").applyInPandas(run, schema)
