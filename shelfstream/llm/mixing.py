"""Mixing sources to target weights by Poisson replication.

A document of a source with share ``n_s / n`` and target weight ``w_s`` repeats at the mean rate ``w_s * size / n_s``. Its count
is the inverse of that Poisson distribution at a number that the hash of its id gives, so a rerun gives the same
mixture. Documents with a null source form a source of their own; sources without a target weight get none of their
documents (weight 0) if ``weights`` is given, and equal weights otherwise. A null doc_id hashes as the empty string, repeated
rows draw the same count each, an empty table gives no rows, and other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import partitions, settled

#: A table of rates up to this size is broadcast; a larger one is joined on salted keys.
BROADCAST_ROWS = 10_000
SALTS = 64


def uniform(doc_id: Column, seed: int) -> Column:
    """A number in (0, 1) from the hash of the id: 48 bits, which a double holds exactly, at the middle of their step."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))))
    return (F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") + 0.5) / float(1 << 48)


def poisson_steps(rate: Column) -> Column:
    """P(count <= k) for k = 0, 1, ... until the tail is below any value that ``uniform`` can give."""
    last = F.ceil(rate + 12 * F.sqrt(rate) + 40).cast("int")
    start = F.struct(F.exp(-rate).alias("p"), F.array(F.exp(-rate)).alias("below"))
    return F.aggregate(
        F.sequence(F.lit(1), last),
        start,
        lambda acc, k: F.struct(
            (acc["p"] * rate / k).alias("p"),
            F.concat(acc["below"], F.array(F.element_at(acc["below"], -1) + acc["p"] * rate / k)).alias("below"),
        ),
        lambda acc: acc["below"],
    )


def source_rates(docs: DataFrame, weights: DataFrame | None = None, size: float = 1.0) -> DataFrame:
    """Rate and Poisson steps per source. ``weights`` has (source, weight), any positive scale; ``size`` is the mixture's length
    as a multiple of the input's.

    Rates over 500 are split into equal parts whose counts add up, because exp(-rate) would underflow.
    """
    counts = docs.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    if weights is None:
        weighted = counts.withColumn("weight", F.lit(1.0))
    else:
        wanted = weights.select(F.col("source").alias("wanted"), F.col("weight").cast("double").alias("weight"))
        weighted = counts.join(wanted, F.col("source").eqNullSafe(F.col("wanted")), "left").select(
            "source", "n", F.coalesce("weight", F.lit(0.0)).alias("weight")
        )
    weighted = settled(weighted)
    total = weighted.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("weight"), F.lit(0.0)).alias("weight")).first()
    rate = F.col("weight") / F.lit(total["weight"]) * F.lit(total["n"] * size) / F.col("n") if total["weight"] else F.lit(0.0)
    rates = weighted.select(F.col("source").alias("rate_source"), rate.alias("rate"))
    parts = F.greatest(F.lit(1), F.ceil(F.col("rate") / 500)).cast("int")
    return rates.withColumn("parts", parts).withColumn("below", poisson_steps(F.col("rate") / F.col("parts")))


def mix(docs: DataFrame, weights: DataFrame | None = None, size: float = 1.0, seed: int = 7) -> DataFrame:
    """``docs`` replicated to the target weights and shuffled globally, in the columns of ``docs``.

    The rates are broadcast if there are at most ``BROADCAST_ROWS`` sources; otherwise they are joined on keys with a salt,
    so that a source with a third of all rows is spread over ``SALTS`` tasks.
    """
    n = partitions(docs.sparkSession)
    rates = settled(source_rates(docs, weights, size))
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    same_source = F.col("row.source").eqNullSafe(F.col("rate_source"))
    if rates.count() <= BROADCAST_ROWS:
        joined = rows.join(F.broadcast(rates), same_source)
    else:
        salted = rates.withColumn("rate_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        spread = rows.withColumn("row_salt", F.pmod(F.xxhash64("row.doc_id"), F.lit(SALTS)).cast("int"))
        joined = spread.join(salted, same_source & (F.col("row_salt") == F.col("rate_salt")))
    # A row with a very high rate goes to as many tasks as its rate has parts; each draws and writes the copies of its part.
    few = joined.where("parts = 1").withColumn("part", F.lit(1))
    many = joined.where("parts > 1").withColumn("part", F.explode(F.sequence(F.lit(1), F.col("parts"))))
    spread = few.unionByName(many.repartition(n, F.xxhash64(F.col("row.doc_id"), F.col("part"))))
    drawn = spread.withColumn("copies", _count(F.col("row.doc_id"), seed)).where("copies > 0")
    copies = drawn.select("row", "part", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
    # The hash of id, text and copy is the place in the new order; rows without an id spread by their text.
    text = [F.col("row.text")] if "text" in docs.columns else []
    placed = copies.withColumn("place", F.xxhash64(F.lit(seed), "row.doc_id", "part", "copy", *text))
    return placed.repartition(n, "place").sortWithinPartitions("place").select("row.*")


def _count(doc_id: Column, seed: int) -> Column:
    """Copies of a part: the first part uses the id's own number, further parts of a very high rate numbers of their own."""
    own = uniform(doc_id, seed)
    further = uniform(F.concat_ws("/", doc_id.cast("string"), F.col("part").cast("string")), seed)
    drawn = F.when(F.col("part") == 1, own).otherwise(further)
    return F.size(F.filter(F.col("below"), lambda b: b < drawn))
