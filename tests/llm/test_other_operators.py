"""Search, mixing, toxicity, chat formatting and the pipeline."""

import hashlib
import math
import os
import random

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from check import TABLES, compare
from shelfstream.llm import chat, mixing, queries, topk, toxicity

from . import brute

SF_DIR = "/root/testdata/sf0.001"
sample_tables = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="sample tables are not here")


@pytest.mark.parametrize("shard_rows", [7, 8192])
def test_top_k(spark, shard_rows):
    rng = random.Random(4)
    rows = [(i, [rng.uniform(-2, 2) for _ in range(5)], "x") for i in range(60)]
    rows += [(100 + i, [0.5, 0.5, 0.5, 0.5, 0.5], "x") for i in range(80)]  # ties
    rows += [(3, [1.0] * 5, "x"), (300, [1.0, None, 0.0, 0.0, 0.0], "x"), (301, [math.inf] * 5, "x"), (302, [math.nan] * 5, "x")]
    rows += [(303, None, "x"), (304, [], "x"), (None, [1.0] * 5, "x"), (305, [1.0, 2.0], "x"), (310, [3.0, 2.0], "x")]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score string")
    asked = {0, 7, 50, 100, 150, 300, 310}
    got = topk.top_k(frame, frame.where(frame.vec_id.isin(*asked)), 10, shard_rows).collect()
    assert sorted(map(tuple, got)) == sorted(brute.top_k([(i, v) for i, v, _ in rows], asked, 10))
    none = frame.where("false")
    assert topk.top_k(none, none).count() == 0


def test_kd_tree_opens_few_boxes_in_low_dimensions():
    import numpy as np

    rng = np.random.default_rng(1)
    vectors = rng.integers(-1000, 1000, (5000, 2))
    tree = topk.KDTree(np.arange(5000), vectors)
    query = np.array([3, 5])
    (bounds,), (sizes,) = tree.bounds(query[None])
    best = tree.search(query, bounds, sizes, 5, -1, topk.NONE_YET)
    assert [s for s, _ in best] == sorted((vectors @ query).tolist(), reverse=True)[:5]
    assert (bounds >= best[-1][0]).sum() < len(bounds) / 4


def test_spaces_are_even_and_few_are_reached():
    import numpy as np

    rng = np.random.default_rng(3)
    vectors, asked = rng.integers(-1000, 1000, (5000, 2)), rng.integers(-1000, 1000, (40, 2))
    places = topk._placed(vectors, topk._cuts(vectors[::5], 50))
    counts = np.bincount(places)
    assert len(counts) == 50 and counts.min() > 40 and counts.max() < 200
    low, high = (np.array([f(vectors[places == p], 0) for p in range(50)]) for f in (np.min, np.max))
    bounds, _ = topk._bounds(asked, low, high, np.maximum(abs(low), abs(high)))
    scores = asked @ vectors.T
    fifth = np.sort(scores, 1)[:, -5]
    reached = topk._promising(bounds, fifth)
    assert all(reached[q, p] for q in range(40) for p in np.unique(places[scores[q] >= fifth[q]]))
    assert reached.mean() < 0.25
    # Equal vectors cannot be cut; nearly equal ones are, at the value that differs.
    assert topk._cuts(np.ones((9, 2), np.int64), 4) == 0
    assert topk._cuts(np.array([[1, 1]] * 8 + [[5, 1]]), 2) == (0, 5, 0, 1)


def test_top_k_of_large_components(spark):
    rng = random.Random(2)
    rows = [(0, [1.0, 1.0]), (1, [70000.0, 0.0]), (2, [90000.0, -1.0]), (3, [80000.0, 5.0])]
    rows += [(10 + i, [rng.uniform(-1, 1) * 2 ** rng.randint(-3, 21) for _ in range(2)]) for i in range(80)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = topk.top_k(frame, frame.where("vec_id % 10 = 0"), 3, 20).collect()
    assert sorted(map(tuple, got)) == sorted(brute.top_k(rows, {i for i, _ in rows if i % 10 == 0}, 3))
    assert [r.vec_id for r in sorted(got, key=lambda r: r["rank"]) if r.query_id == 0][:1] != [1]
    # Scores beyond a long end at its ends, and terms beyond it that cancel out do not disturb the score.
    far = [(0, [1e15, 1e15, 1.0]), (1, [1e15, -1e15, 2.0]), (2, [1e15, 1e15, 0.0]), (3, [-1e15, -1e15, 0.0]), (4, [0.0, 0.0, 3.0])]
    frame = spark.createDataFrame(far, "vec_id long, embedding array<double>")
    got = topk.top_k(frame, frame.where("vec_id = 0"), 4).orderBy("rank").collect()
    assert [(r.vec_id, r.score) for r in got] == [(2, (1 << 63) - 1), (4, 3 << 20), (1, 2 << 20), (3, -(1 << 63))]


@pytest.mark.parametrize("salted", [False, True])
def test_mixing_draws_by_inverse_poisson(spark, salted, monkeypatch):
    if salted:
        monkeypatch.setattr(mixing, "BROADCAST_ROWS", 0)
    rows = [(i, "a" if i % 3 else "b", f"t{i}", 1) for i in range(3000)] + [(None, None, None, 1), (5, "a", "t5", 1), (7, "c", "", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string, copies int")
    weights = spark.createDataFrame([("a", 1.0), ("b", 3.0), ("gone", 1.0)], "source string, weight double")
    got = mixing.mix(docs, weights, size=2.0)
    assert got.columns == docs.columns
    counts = {}
    for r in got.collect():
        counts[tuple(r)] = counts.get(tuple(r), 0) + 1

    def drawn(doc_id, rate):
        u = (int(hashlib.md5(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:12], 16) + 0.5) / 2**48
        k, p = 0, math.exp(-rate)
        below = p
        while below < u:
            k += 1
            p *= rate / k
            below += p
        return k

    n = {"a": 2001, "b": 1000}
    total = len(rows) * 2.0
    want = {}
    for row in rows:
        share = {"a": 0.25, "b": 0.75}.get(row[1], 0)
        count = drawn(row[0], share * total / n[row[1]]) if share else 0
        if count:
            want[row] = want.get(row, 0) + count
    assert counts == want
    assert mixing.mix(docs.where("false"), weights).count() == 0
    rare = mixing.mix(docs.where("source is null"), size=2000.0).count()
    assert 1700 < rare < 2300  # a rate beyond the range of exp(-rate)


def test_mixing_spreads_the_copies_of_one_row(spark):
    docs = spark.createDataFrame([(i, "a", f"t{i}") for i in range(20000)] + [(-1, "b", "only")], "doc_id long, source string, text string")
    mixed = mixing.mix(docs)
    assert 9500 < mixed.where("source = 'b'").count() < 10500
    # The copies come out of the parts of the rate, each of at most 500 on average, in several tasks.
    rates = {r.rate_source: r.parts for r in mixing.source_rates(docs).collect()}
    assert rates == {"a": 1, "b": 21}
    assert mixed.where("source = 'b'").select(F.spark_partition_id().alias("p")).distinct().count() > 1


def test_maximal_segments_in_linear_time():
    import time

    found = [(40 * i, 1.0 + (i % 7) / 10) for i in range(100_000)]
    start = time.process_time()
    assert len(toxicity.maximal_segments(found, 0.05)) == 100_000
    rising = [(i, 1.0) for i in range(0, 200_000, 2)]
    assert len(toxicity.maximal_segments(rising, 0.05)) == 1
    assert time.process_time() - start < 2


def test_maximal_segments_by_brute_force():
    rng = random.Random(9)
    for _ in range(300):
        n, drift = rng.randint(1, 12), rng.choice([0.5, 1.0])
        found = [(i, float(rng.randint(-3, 5))) for i in range(n) if rng.random() < 0.6]
        scores = [-drift] * n
        for i, s in found:
            scores[i] += s
        got = toxicity.maximal_segments(found, drift)

        def split(a, z):
            """The best segment (shortest, then first), then the same left and right of it."""
            best = max(((sum(scores[i:j]), -(j - i), -i) for i in range(a, z) for j in range(i + 1, z + 1)), default=(0,))
            if best[0] <= 0:
                return []
            i = -best[2]
            j = i - best[1]
            return [*split(a, i), (i, j, best[0]), *split(j, z)]

        assert [(a, z) for a, z, _ in got] == [(a, z) for a, z, _ in split(0, n)]
        assert [s for *_, s in got] == pytest.approx([s for *_, s in split(0, n)])


def test_toxicity_on_held_out_rows(spark):
    rng = random.Random(5)
    words = [f"{a}{b}{c}" for a in "bdfg" for b in "aeiou" for c in ("na", "ri", "to", "lem")]
    said = []
    for i in range(900):
        text = rng.choices(words, k=rng.randint(5, 60))
        for _ in range(rng.randint(1, 3) if i % 4 == 0 else 0):
            text.insert(rng.randint(0, len(text)), rng.choice(["vileness", "vilest", "vilify", "scum"]))
        said.append((i, " ".join(text), int(i % 4 == 0)))
    docs = spark.createDataFrame([(i, t, 1.0) for i, t, _ in said] + [(None, None, 1.0), (5000, "", 1.0), (7, said[7][1], 1.0)], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(i, l) for i, _, l in said] + [(None, 1), (3, None), (8, 0)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels.where(~toxicity.is_held_out()))
    got = toxicity.score(docs, model).collect()
    assert len(got) == len(said) + 3
    by_id = {r.doc_id: r for r in got}
    wrong = sum(by_id[i].predicted != label for i, _, label in said)
    assert wrong <= 9 and by_id[5000].score < 0.3 and by_id[None].score == by_id[5000].score
    hit = by_id[4].passages
    assert hit and any(w[:3] in ("vil", "scu") for p in hit for w in toxicity.tokens(said[4][1])[p.start : p.stop])
    kept = toxicity.reject_toxic(docs, model)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted((r.doc_id for r in got if not r.predicted), key=repr)
    none = docs.where("false")
    assert toxicity.score(none, toxicity.train(none, labels.where("false"))).count() == 0
    assert {r.score for r in toxicity.score(docs, toxicity.train(docs, labels.where("toxic = 1"))).collect()} == {1.0}


def test_chat_round_trip_with_control_strings(spark):
    turns = [
        (1, 0, "system", "be <|im_end|>\n"), (1, 1, "user", "<\\|im_start|>"), (1, 2, "assistant", "<|<|\\<\\\\|x"), (1, 3, "assistant", ""),
        (2, 0, "assistant", "first"), (2, 1, "tool\n\\<|x", "é日"), (2, 1, "tool\n\\<|x", "é日"), (3, 0, None, None), (None, None, "user", "<"),
    ]
    frame = spark.createDataFrame([(*t, 1, True) for t in turns], "conv_id long, turn long, role string, text string, segment int, loss boolean")
    segments = chat.format_chat(frame)
    got = {r.conv_id: r for r in chat.read_back(segments).collect()}
    formatted = {}
    for r in segments.collect():
        formatted.setdefault(r.conv_id, []).append(r)
    for conv in (1, 2, 3, None):
        own = sorted((t for t in turns if t[0] == conv), key=lambda t: (t[1] or 0, t[2] or "", t[3] or ""))
        whole = "".join(s.text for s in sorted(formatted[conv], key=lambda s: s.segment))
        assert whole.count("<|") == 2 * len(own) and got[conv].formatted_chars == len(whole)
        assert got[conv].n_turns == len(own)
        assert got[conv].turns_sha256 == brute.sha("".join(f"{r or ''}\n{x or ''}\n" for *_, r, x in own).encode())
        said = "".join(x or "" for *_, r, x in own if r == "assistant")
        assert (got[conv].loss_chars, got[conv].loss_sha256) == (len(said), brute.sha(said.encode()))
    assert [got[c].n_unexpected for c in (1, 2, 3)] == [1, 3, 1]
    assert chat.read_back(chat.format_chat(frame.where("false"))).count() == 0


@sample_tables
@pytest.mark.parametrize("name", queries.ORACLE)
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for table in TABLES.split():
        con.execute(f"create view {table} as select * from '{SF_DIR}/{table}.parquet'")
    verdict, _ = compare(spark, con, name, SF_DIR)
    assert verdict.startswith("ok") and verdict != "ok (0)", verdict


@sample_tables
def test_pipeline_stages(spark, tmp_path):
    """Each stage against its plain version on what the stage before it wrote."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, kept = docs.columns, {}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF_DIR).write.parquet(str(tmp_path / str(i)))
        docs = spark.read.parquet(str(tmp_path / str(i)))
        kept[name] = docs.collect()
        if i < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns
    start = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    model = toxicity.train(spark.read.parquet(f"{SF_DIR}/documents.parquet"), spark.read.parquet(f"{SF_DIR}/labels.parquet"))
    clean = [r for r in start if model.probability(sum(p[3] for p in model.passages(r.text))) < toxicity.THRESHOLD]
    assert sorted(r.doc_id for r in kept["toxicity"]) == sorted(r.doc_id for r in clean)
    alone = {c for c in brute.component_ids([(r.doc_id, r.text) for r in clean])}
    assert sorted(r.doc_id for r in kept["simhash near-dedup"]) == sorted(alone)
    before = {r.doc_id: r.text for r in kept["simhash near-dedup"]}
    for r in kept["pii"]:
        assert not brute.private(r.text)
        changed = r.text != before[r.doc_id]
        assert changed or not brute.private(before[r.doc_id])
        assert not changed or r.n_chars == len(r.text)
    assert {r.doc_id for r in kept["mixing"]} <= {r.doc_id for r in kept["pii"]}
    assert 0.7 < len(kept["mixing"]) / len(kept["pii"]) < 1.3
    assert sum(r.piece == 0 for r in kept["packing"]) == len(kept["mixing"])
    filled = {}
    for r in kept["packing"]:
        filled[r.sequence_id] = filled.get(r.sequence_id, 0) + r.length
    assert max(filled.values()) <= 4096 and len(filled) <= sum(filled.values()) / 4096 + 2
