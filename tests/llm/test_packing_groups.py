"""Packing groups of repeated and missing ids, and words that folding would change."""

import pytest
from pyspark.sql import functions as F

from shelfstream.llm import packing

TOKENIZER = pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")


@pytest.mark.parametrize("doc_id", [None, 5])
def test_packing_groups_are_bounded_for_one_id(spark, doc_id):
    pieces = spark.range(600).select(F.lit(doc_id).cast("long").alias("doc_id"), F.lit(0).alias("piece"), F.lit(0).cast("long").alias("start"), F.lit(1000).cast("long").alias("length"))
    sizes = packing.pack(pieces, 4096, 50).groupBy(F.col("sequence_id").bitwiseAND(-1 << 32)).count().collect()
    assert sum(r[1] for r in sizes) == 600 and max(r[1] for r in sizes) < 100


@pytest.mark.parametrize("text", ["T\u0308a", "H\u0331 Plain", "J\u030c.", "W\u030a É Élan"])
def test_capitals_with_combining_marks_keep_the_tokenizers_ids(text):
    import numpy as np

    ids = packing.WordIds(TOKENIZER, "<|endoftext|>")
    assert np.frombuffer(ids([text])[0], "<u4").tolist() == ids.tokenizer.encode(text, add_special_tokens=False).ids


def test_letter_runs_give_the_ids_of_the_tokenizer():
    import random

    import numpy as np
    from tokenizers import Tokenizer

    from shelfstream.llm import queries
    from shelfstream.llm.packing import LetterRuns, WordIds

    assert LetterRuns.of(queries.TOKENIZER) and LetterRuns.of(queries.BYTE_TOKENIZER) is None
    rng, library = random.Random(8), Tokenizer.from_file(queries.TOKENIZER)
    parts = ["don't", "we'll", "'s", "A", "zz", "x1y22", "--", "\"'tis", "e.g.,", "It's.", "naïve", "\x01b", "\x1cq", "<|end", "<|endoftext|>", "%%%", "é'd", "'", "12.5,"]
    texts = [" ".join(rng.choice(parts) + "".join(rng.choices("abcdefghijklmnoprstuvw'.,-3", k=rng.randint(0, 12))) for _ in range(60)) for _ in range(60)]
    found = WordIds(queries.TOKENIZER, "<|endoftext|>")(texts)
    assert [np.frombuffer(f, "<u4").tolist() for f in found] == [library.encode(t, add_special_tokens=False).ids for t in texts]
