"""Resampling, SentencePiece tables and token alignment against plain versions."""

import hashlib
import json
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shelfstream.llm import queries, resampling, sentence_pieces, token_alignment

PIECES, BYTES = queries.PIECE_MODEL, queries.BYTE_TOKENIZER


def _texts(seed, n):
    rng = random.Random(seed)
    parts = ["the", "Of", "naïve", "日本語", "x9", "don't", "<|endoftext|>", "</s>", "a,b", "é", "\n", "\t", "ab\r\n", "🙂🙂", "१२", "wordy", "ﬁn", "\x00", " "]
    gaps = [" ", " ", " ", "  ", "", "   ", "\n ", " \n"]
    texts = ["".join(rng.choice(parts) + rng.choice(gaps) for _ in range(rng.randint(1, 40))) for _ in range(n)]
    return [*texts, "", None, " ", "   ", "a", "a▁b", "▁", " lead", "tail ", "x" * 3000, " ".join(rng.choices(parts, k=6000)), texts[0], texts[0]]


def _docs(spark, texts):
    rows = [(None if i == 3 else i, t, i, "x", [1], "g") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, place int, groups string, ids array<int>, weight string")


def test_encoding_equals_the_library(spark):
    texts = _texts(1, 60)
    docs = _docs(spark, texts)
    found = sentence_pieces.decode(sentence_pieces.encode(docs, PIECES), PIECES)
    assert sorted(found.columns) == sorted([*docs.columns, "decoded"])
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    got = found.collect()
    assert len(got) == len(texts)
    for row in got:
        ids = model.encode(texts[row.place] or "", add_eos=True)
        assert (row.ids, row.decoded) == (ids, model.decode(ids)), row.text
    assert sentence_pieces.encode(docs.where("false"), PIECES).count() == 0
    assert [r.decoded for r in sentence_pieces.decode(docs.limit(1).withColumn("ids", F.lit(None).cast("array<int>")), PIECES).collect()] == [""]


def test_chunk_table_keeps_common_chunks_and_stays_small():
    table, texts = sentence_pieces.ChunkTable(PIECES, table_bytes=4000), [f"the word{i} of" for i in range(300)]
    asked, segment = [], table._segment
    table._segment = lambda chunks: asked.extend(chunks) or segment(chunks)
    for text in texts:
        table([text])
        # A step may take the newer half over its share by its own chunks.
        assert sum(len(c) + len(i) + 200 for half in (table.known, table.older) for c, i in half.items()) <= 4000 + 2 * 3 * 220
    assert asked.count("the") == asked.count("of") == 1 and len(asked) == 302


def test_decoding_takes_bounded_numbers_of_ids(monkeypatch):
    monkeypatch.setattr(sentence_pieces, "STEP_IDS", 10, raising=False)
    lists = [[1] * n for n in (3, 7, 0, 1, 25, 9, 2)] + [None, [4]]
    batch = pa.RecordBatch.from_arrays([pa.array(lists, pa.list_(pa.int32()))], ["needed"])
    got = [step.column("needed").to_pylist() for step in sentence_pieces._steps_of_ids(batch)]
    assert sum(got, []) == lists
    assert all(len(step) == 1 or sum(len(ids or []) for ids in step) <= 10 for step in got)
    assert list(sentence_pieces._steps_of_ids(batch.slice(0, 0))) == []


def test_chunk_table_starts_anew_when_full():
    table = sentence_pieces.ChunkTable(PIECES, table_bytes=2000)
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    for seed in range(6):
        texts = [t or "" for t in _texts(seed, 5)]
        assert [np.frombuffer(i, "<i4").tolist() for i in table(texts)] == model.encode(texts)
    assert all(len(chunk) <= sentence_pieces.LONG_CHUNK for chunk in table.known)


def _aligned(texts):
    """Rows of align_and_count behind the id, from all overlaps of byte ranges."""
    tokenizer = Tokenizer.from_file(BYTES)
    tokenizer.encode_special_tokens = True
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    alphabet = token_alignment.byte_alphabet()
    names = {i: t for t, i in json.load(open(BYTES, encoding="utf-8"))["model"]["vocab"].items()}
    found = []
    for text in texts:
        a = tokenizer.encode(" " + text, add_special_tokens=False).ids if text else []
        b = model.encode(text) if text else []
        a_bytes = [bytes(alphabet[c] for c in names[i]) for i in a]
        b_bytes = [bytes([int(p[3:5], 16)]) if re.fullmatch("<0x..>", p) else p.replace("▁", " ").encode() for p in map(model.id_to_piece, b)]
        if not text or not b"".join(a_bytes) == b"".join(b_bytes) == f" {text}".encode():
            found.append(([], [], [], []))
            continue
        a_ends, b_ends = np.cumsum([len(x) for x in a_bytes]).tolist(), np.cumsum([len(x) for x in b_bytes]).tolist()
        links = [
            (x, y)
            for x, a_end, a_start in zip(a, a_ends, [0, *a_ends])
            for y, b_end, b_start in zip(b, b_ends, [0, *b_ends])
            if a_start < b_end and b_start < a_end
        ]
        groups, start = [], 0
        for cut in sorted(set(a_ends) & set(b_ends)):
            inside = [",".join(str(x) for x, end in zip(ids, ends) if start < end <= cut) for ids, ends in ((a, a_ends), (b, b_ends))]
            groups.append("|".join(inside))
            start = cut
        found.append((a, b, links, groups))
    counts = Counter(link for *_, links, _ in found for link in links)
    best = {}
    for (_, b), n in counts.items():
        best[b] = max(n, best.get(b, 0))
    return [
        (
            len(a), len(b), len(groups), len(links), sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links),
            hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "",
        )
        for a, b, links, groups in found
    ]


@pytest.mark.parametrize("frequent", [1 << 18, 40])
def test_alignment_equals_all_overlaps(spark, monkeypatch, frequent):
    texts = [t if t is None or len(t) < 5000 else t[:1500] for t in _texts(2, 40)]
    docs = _docs(spark, texts)
    found = token_alignment.align_and_count(docs, BYTES, PIECES, public_tokenizers.PATTERN, frequent)
    numbers = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    ids = [None if i == 3 else i for i in range(len(texts))]
    want = [(i, *row) for i, row in zip(ids, _aligned(texts))]
    assert sorted(map(tuple, found.select("doc_id", *numbers).collect()), key=repr) == sorted(want, key=repr)
    assert token_alignment.align_and_count(docs.where("false"), BYTES, PIECES, public_tokenizers.PATTERN).count() == 0


def test_long_documents_are_walked_in_lanes():
    aligner = token_alignment.Aligner(BYTES, PIECES, public_tokenizers.PATTERN)
    rng = random.Random(3)
    texts = [" ".join("".join(rng.choices("abcdeé", k=rng.randint(1, 9))) for _ in range(4000)), "short one", "", "z" * 9000]
    of_a, of_b = aligner.tokens(texts)
    a, b = np.concatenate(of_a), np.concatenate(of_b)
    a_start, b_start = (np.cumsum([0, *map(len, ids)]) for ids in (of_a, of_b))
    a_ends, b_ends = np.cumsum(aligner.a_lengths[a]), np.cumsum(aligner.b_lengths[b])
    lanes = token_alignment._lanes(a_ends, b_ends, a_start, b_start)
    assert len(lanes[0]) > 8 and len(lanes[0]) == len(lanes[1])
    in_lanes = token_alignment.lockstep(a_ends, b_ends, *lanes)
    whole = token_alignment.lockstep(a_ends, b_ends, a_start[:-1], b_start[:-1])
    assert sorted(zip(*map(np.ndarray.tolist, in_lanes))) == sorted(zip(*map(np.ndarray.tolist, whole)))


def _buckets(text):
    folded = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [zlib.crc32(w.encode()) % 10000 for w in re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", folded)]


def _resampled(rows, target, percent=10):
    s, t = (Counter(b for text in texts for b in _buckets(text)) for texts in ([x for _, x in rows], target))
    total_s, total_t = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (total_s + 10000) / ((s[b] + 1) * (total_t + 10000)))) for b in s}
    scored = []
    for doc_id, text in rows:
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in _buckets(text))
        scored.append((doc_id, len(_buckets(text)), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in scored if r[1] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    drawn = len(able) * percent // 100
    return sorted([(*r, i + 1 if i < drawn else None) for i, r in enumerate(able)] + [(*r, None) for r in scored if r[1] < 20], key=repr)


@pytest.mark.parametrize("percent", [10, 55, 100])
def test_resampling_by_plain_sums(spark, percent):
    rng = random.Random(6)
    words = ["The", "ÉCOLE", "école", "x-y", "42", "日本", "o'clock", "zeta", "eta", "THETA", "iota_kappa"]
    texts = [" ".join(rng.choices(words, k=rng.choice([3, 12, 30, 400]))) for _ in range(90)]
    texts += [None, "", "the " * 5000, "\x00", texts[0], texts[0], texts[0]]
    rows = [(None if i in (5, 6) else 7 if i > 92 else i, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame([(i, t, 0, "p") for i, t in rows], "doc_id long, text string, score int, eligible string").repartition(5)
    target = spark.createDataFrame([("theta école theta 42",), (None,), ("",)], "text string")
    found = resampling.resample(docs, target, percent, keep=["text", "score"])
    got = found.select("doc_id", "n_features", "weight", "score", "rank").collect()
    assert sorted(map(tuple, got), key=repr) == _resampled(rows, ["theta école theta 42", None, ""], percent)
    assert sorted((r.doc_id, r.kept.text) for r in found.where("doc_id is not null").collect() if r.kept.text) == sorted((i, t) for i, t in rows if i is not None and t)
    assert resampling.resample(docs.where("false"), target).count() == 0
    flat = resampling.resample(docs, target.where("false"), percent).collect()
    assert len(flat) == len(rows)


def test_planes_sum_exactly():
    rng = np.random.default_rng(3)
    for low, high in ((-9000, 12000), (-5, 0), (0, 1), (-1, 0), (-(1 << 40), 1 << 40)):
        gains = rng.integers(low, high + 1, 1000)
        doc, bucket = np.sort(rng.integers(0, 600, 20000)), rng.integers(0, 1000, 20000)
        doc, bucket = np.append(doc, np.full(5000, 600)), np.append(bucket, np.full(5000, 17))
        want = np.zeros(601, np.int64)
        np.add.at(want, doc, gains[bucket])
        assert (resampling.GainPlanes(gains).sums(doc, bucket, 601) == want).all()


def test_runs_of_several_words_are_features():
    n, found = resampling.feature_buckets("One two, THREE", longest=2)
    assert n == 3 and found.tolist() == [zlib.crc32(w) % 10000 for w in (b"one", b"two", b"three", b"one two", b"two three")]
