"""A training-text pipeline over the documents table: each stage works on all rows that the stage before it kept.

Null texts count as empty, null ids stay, and an empty table gives an empty result at every stage; what each stage does with
ties and repeated rows stands in the module of its operator.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from shelfstream.llm import mixing, packing, pii, simhash, toxicity
from shelfstream.llm.common import settled, table


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a model of the labelled ones does not find toxic."""
    # The model learns from labelled rows of the table itself, so that it is the same whatever came before this stage.
    model = toxicity.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return toxicity.reject_toxic(docs, model)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that SimHash fingerprints of three-word shingles within two bits join."""
    return simhash.one_of_each(docs)


def redact_private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by its kind; the character count follows."""
    return pii.redact(docs, pii.train(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated at random, so that every source has the same expected share."""
    return mixing.mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces in sequences of at most 4096."""
    return packing.pack(packing.tokenized_pieces(docs, public_tokenizers.path("word_bpe_49k.json")))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", reject_toxic),
    ("simhash near-dedup", drop_near_copies),
    ("pii", redact_private),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Trained trees, segment scans and a tokenizer are beyond SQL; the tests compare the stages with plain versions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        # Each stage reads its input more than once, so it is computed once and kept in the checkpoint folder.
        docs = stage(spark, settled(docs) if i else docs, sf_dir)
    return docs
