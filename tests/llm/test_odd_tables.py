"""Odd tables: nulls everywhere, empty tables, clashing names and single texts of great length."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from shelfstream.llm import chat, pii, queries, simhash, suffixes, toxicity

from . import brute

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that the stages and operators use themselves.
OWN = ["row", "component", "score", "rank", "place", "copy", "part", "length", "mark", "spans", "ids", "kept"]


@pytest.fixture
def tables(spark, tmp_path):
    rng = random.Random(31)
    words = ["".join(rng.choices("abcdefghilmnorstu", k=rng.randint(3, 9))) for _ in range(400)]
    rows = []
    for i in range(120):
        text = " ".join(rng.choices(words, k=rng.randint(20, 80)))
        toxic = i % 4 == 0
        text = f"{text} vileness vilest vilify scum {rng.choice(words)}" if toxic else text
        rows.append((i, f"{text} jo{i}@mail.org", "en", "a" if i % 3 else "b", 1, int(toxic)))
    rows += [(None, None, None, None, None, 0), (None, "no id at all here", "en", None, 1, 0), (200, "", "en", "a", 0, 0), (200, "", "en", "a", 0, 0)]
    rows += [(300 + i, rows[1][1], "en", "b", 1, 0) for i in range(5)] + [rows[2]] * 3
    docs = spark.createDataFrame([r[:5] for r in rows], COLUMNS)
    labels = spark.createDataFrame([(r[0], 1, r[5]) for r in rows if r[0] is not None], "doc_id long, quality int, toxic int")
    labels.dropDuplicates(["doc_id"]).write.parquet(str(tmp_path / "labels.parquet"))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    return rows, docs, str(tmp_path)


def _staged(spark, docs, folder, out):
    """What each stage leaves, with its columns."""
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        found = stage(spark, docs, folder)
        if i < len(corpus_pipeline.STAGES) - 1:
            assert found.columns == docs.columns, name
        found.write.parquet(f"{out}/{i}")
        docs = spark.read.parquet(f"{out}/{i}")
        yield name, docs


def test_pipeline_over_nulls_repeats_and_clashing_names(spark, tables, tmp_path):
    rows, docs, folder = tables
    clashing = docs.select("*", *(F.lit(i).alias(c) for i, c in enumerate(OWN)))
    plain = {name: found.collect() for name, found in _staged(spark, docs, folder, tmp_path / "plain")}
    odd = {name: found for name, found in _staged(spark, clashing, folder, tmp_path / "odd")}
    clean = [r for r in rows if not r[5]]
    assert sorted((r.doc_id, r.text) for r in plain["toxicity"] if r.text and r.doc_id is not None) == sorted((r[0], r[1]) for r in clean if r[1] and r[0] is not None)
    assert sum(r.doc_id is None for r in plain["toxicity"]) == 2
    groups = brute.linked([brute.simhash(r.text) for r in plain["toxicity"]])
    assert len(plain["simhash near-dedup"]) == len(set(groups))
    assert not any(brute.private(r.text) for r in plain["pii"]) and len(plain["pii"]) == len(set(groups))
    for name, _ in corpus_pipeline.STAGES[:-1]:
        got = odd[name].collect()
        assert sorted((r.doc_id, r.text) for r in got if r.doc_id is not None) == sorted((r.doc_id, r.text) for r in plain[name] if r.doc_id is not None)
        assert all(tuple(r[c] for c in OWN) == tuple(range(len(OWN))) for r in got)
    assert sum(r.piece == 0 for r in odd["packing"].collect()) == len(plain["mixing"])


def test_pipeline_over_an_empty_table(spark, tables, tmp_path):
    _, docs, folder = tables
    for name, found in _staged(spark, docs.where("false"), folder, tmp_path / "none"):
        assert found.count() == 0, name


def test_training_on_null_texts_alone(spark):
    docs = spark.createDataFrame([(i, None) for i in range(20)] + [(None, None)], "doc_id long, text string")
    assert pii.find(docs, pii.train(docs)).where("size(spans) > 0").count() == 0
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)], "doc_id long, toxic int")
    got = toxicity.score(docs, toxicity.train(docs, labels)).collect()
    assert len(got) == 21 and len({r.score for r in got}) == 1 and 0 <= got[0].score <= 1


def test_turns_without_a_conversation_over_several_batches(spark):
    said = [(None, i, "user" if i % 2 == 0 else "assistant", f"t{i}<|") for i in range(300)]
    turns = spark.createDataFrame(said, "conv_id long, turn long, role string, text string").repartition(7)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 40)
    try:
        (row,) = chat.read_back(chat.format_chat(turns)).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert (row.conv_id, row.n_turns, row.n_unexpected) == (None, 300, 0)
    assert row.turns_sha256 == brute.sha("".join(f"{r}\n{t}\n" for _, _, r, t in said).encode())
    assert row.loss_sha256 == brute.sha("".join(t for _, _, r, t in said if r == "assistant").encode())


def test_single_texts_of_great_length(spark):
    rng = random.Random(3)
    long = " ".join("".join(rng.choices("abcdef", k=6)) for _ in range(150_000))
    docs = spark.createDataFrame([(1, long), (2, long[400_000:400_700]), (3, "short")], "doc_id long, text string")
    got = {r.doc_id: r for r in suffixes.dedup_bytes(docs).collect()}
    assert [got[i].n_removed for i in (1, 2, 3)] == [700, 700, 0] and got[1].n_bytes == len(long)
    model = toxicity.Model(base=0.1, scores={"abc~": 2.0}, log_k=-5.0, slope=1.0)
    assert toxicity.score(docs, model).count() == 3
    assert simhash.near_duplicates(docs).select("component_id").distinct().count() == 3
    assert queries.QUERIES.keys() >= {f"op{n}_{name}" for n, name in ((11, "importance_resampling"), (12, "sentence_pieces"), (13, "token_alignment"))}
