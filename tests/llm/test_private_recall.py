"""Recall of wider forms of personal data among the sample documents, and numbers that are to be left alone."""

import os
import random

import pytest
from pyspark.sql import functions as F

from shelfstream.llm import pii

SF_DIR = "/root/testdata/sf0.01"
N = 20


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="sample tables are not here")
def test_planted_forms_are_found_and_plain_numbers_stay(spark):
    rng = random.Random(3)
    word = lambda: rng.choice(["jane", "bob", "carla", "dmitri", "elena"])
    host = lambda: rng.choice(["mail", "post", "web", "inbox"])
    top = lambda: rng.choice(["org", "com", "net", "de"])
    digits = lambda n: str(rng.randint(2, 9)) + "".join(rng.choices("0123456789", k=n - 1))
    private = [
        lambda: f"{word()}.{word()} (at) {host()} (dot) {top()}",
        lambda: f"{word()}{digits(2)} @ {host()}.{top()}",
        lambda: f"({digits(3)}) {digits(3)}-{digits(4)}",
        lambda: f"{digits(3)}-{digits(3)}-{digits(4)}",
        lambda: f"{digits(2)} {digits(3)} {digits(3)} {digits(4)}",
        lambda: "password=" + "".join(rng.choices("abcdefXYZ0123456789", k=16)),
        lambda: "key: " + "".join(rng.choices("abcdef0123456789", k=32)),
    ]
    plain = [
        lambda: f"20{rng.randint(10, 24)}-0{rng.randint(1, 9)}-1{rng.randint(0, 9)}",
        lambda: f"{digits(16)}",
        lambda: f"{digits(8)}",
        lambda: f"{digits(1)}.{digits(2)}",
    ]
    said = [f"the river runs {make()} along the fields" for make in private + plain for _ in range(N)]
    planted = spark.createDataFrame([(10**9 + i, text) for i, text in enumerate(said)], "doc_id long, text string")
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")
    trees = pii.train(docs.unionByName(planted))
    found = {r.doc_id - 10**9 for r in pii.find(planted, trees).where("size(spans) > 0").select("row.doc_id").collect()}
    shares = [sum(form * N + i in found for i in range(N)) / N for form in range(len(private) + len(plain))]
    assert min(shares[: len(private)]) >= 0.9, shares
    assert shares[len(private)] == 0 and shares[-2:] == [0, 0], shares
    # A tenth of random digits passes the card's check and is a base span.
    assert shares[len(private) + 1] <= 0.4, shares


def test_trees_learn_from_every_proposal(spark, monkeypatch):
    """More proposals than the 20,000 that training once took; each counts in what the trees are fitted to."""
    kept, settled = [], pii.settled
    monkeypatch.setattr(pii, "settled", lambda frame: kept.append(settled(frame)) or kept[-1])
    # A phone is proposed as written, without its country code, and so with dashes; the eight digits are proposed once.
    text = F.concat(F.lit("so +1 (988) 555-"), F.lpad(F.col("id").cast("string"), 4, "0"), F.lit(" and 12345678 then"))
    docs = spark.range(6_000).select(F.col("id").alias("doc_id"), text.alias("text"))
    trees = pii.train(docs)
    (frame,) = kept
    n = F.sum("n") if "n" in frame.columns else F.count(F.lit(1))
    assert frame.agg(n).first()[0] == 4 * 6_000
    assert pii.find(docs, trees).where(pii.listed("spans") != pii.listed("base")).count() == 0
