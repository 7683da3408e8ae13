"""Rows without an id and rows of one id spread over parts."""

import random

import pytest

from shelfstream.llm import ranges, substring, suffixes

from . import brute


@pytest.fixture(scope="module")
def skewed():
    rng = random.Random(9)
    words = [f"w{i}" for i in range(300)]
    texts = [" ".join(rng.choices(words, k=40)) for _ in range(40)]
    texts += [f"{rng.choice(texts)} {' '.join(rng.choices(words, k=20))}" for _ in range(140)]
    return [(None if i % 3 == 0 else 50 if i % 3 == 1 else i, t) for i, t in enumerate(texts)]


def test_hot_and_null_ids_do_not_share_one_part(spark, skewed):
    docs = spark.createDataFrame(skewed, "doc_id long, text string")
    for rows in (ranges.dealt(docs, 1000)[0], ranges.in_split_ranges(docs, 1000)[0]):
        sizes = [r[1] for r in rows.selectExpr("part", "length(text) n").groupBy("part").sum("n").collect()]
        assert max(sizes) < 6000 < sum(len(t) for _, t in skewed) / 5


def test_results_with_hot_and_null_ids(spark, skewed):
    docs = spark.createDataFrame(skewed, "doc_id long, text string")
    got = substring.dedup_substrings(docs, 10, 1000).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(brute.substring_dedup(skewed, 10), key=repr)
    got = suffixes.dedup_bytes(docs, 60, 20, 1000).selectExpr("doc_id", "n_bytes", "n_removed", "size(removed) n", "kept_sha256").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(brute.byte_dedup(skewed, 60), key=repr)


def test_heavy_ids_that_doubles_cannot_tell_apart(spark):
    shared = " ".join(f"s{i}" for i in range(120))
    rows = [((1 << 60) + i, f"{shared} " + " ".join(f"o{i}-{j}" for j in range(200))) for i in range(6)] + [(None, shared), ((1 << 63) - 1, shared)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = substring.dedup_substrings(docs, 10, 500).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(brute.substring_dedup(rows, 10), key=repr)
