"""Cutting a table of documents into ranges of doc_id that hold about the same bytes of text."""

from __future__ import annotations

import math
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import texts

LAST_ID = (1 << 63) - 1


def _bucketed(rows: DataFrame, bounds: list[float], name: str) -> DataFrame:
    """``rows`` with the number of bounds that are at most ``place``."""
    if not bounds:
        return rows.withColumn(name, F.lit(0))
    cut = Bucketizer(splits=[-math.inf, *bounds, math.inf], inputCol="place", outputCol=name)
    return cut.transform(rows).withColumn(name, F.col(name).cast("int"))


def in_ranges(docs: DataFrame, part_bytes: int, most_parts: int | None = None) -> tuple[DataFrame, int]:
    """(doc_id, text, part) of every row and the number of parts; parts rise with doc_id and hold about ``part_bytes``.

    With ``most_parts`` the parts of a large corpus are made larger instead of more. Rows of one doc_id share a part; rows without one are in the first. Ids are cut at approximate quantiles into ranges finer
    than a part, whose bytes are then summed; the driver gets one number for each.
    """
    rows = texts(docs, F.col("doc_id").cast("long").alias("doc_id")).withColumn("place", F.coalesce(F.col("doc_id").cast("double"), F.lit(-1e300)))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    if most_parts:
        part_bytes = max(part_bytes, 2 * total // most_parts)
    fine = 4 * (total // part_bytes + 1)
    ids = rows.where("doc_id is not null")
    cuts = sorted(set(ids.approxQuantile("place", [i / fine for i in range(1, fine)], 1 / (4 * fine)))) if total > part_bytes else []
    held = dict(_bucketed(rows, cuts, "fine").groupBy("fine").agg(F.sum(F.octet_length("text"))).collect()) if cuts else {}
    bounds, size = [], held.get(0, 0)
    for i, cut in enumerate(cuts, 1):
        if size and size + held.get(i, 0) > part_bytes:
            bounds.append(cut)
            size = 0
        size += held.get(i, 0)
    return _bucketed(rows, bounds, "part").drop("place"), len(bounds) + 1


def dealt(docs: DataFrame, part_bytes: int) -> tuple[DataFrame, int]:
    """(doc_id, text, part) of every row and the number of parts; rows are dealt by their place, whatever their id and text.

    ``docs`` must give its rows in the same order whenever it is read, as files and checkpoints do.
    """
    rows = texts(docs, F.col("doc_id").cast("long").alias("doc_id"))
    parts = (rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // part_bytes + 1
    return rows.withColumn("part", _lot(parts)), parts


def _lot(parts: int | Column) -> Column:
    parts = parts if isinstance(parts, Column) else F.lit(parts)
    return F.pmod(F.xxhash64(F.monotonically_increasing_id()), parts).cast("int")


def _by_bounds(rows: DataFrame, bounds: list[int], name: str) -> DataFrame:
    """``rows`` with the number of bounds that are at most ``doc_id``, compared as longs; rows without an id count as the lowest."""
    limits = np.array(bounds, np.int64)

    @F.pandas_udf("int")
    def number(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(limits, ids.to_numpy(), "right"))

    # Without nulls, as pandas would make doubles of longs.
    return rows.withColumn(name, number(F.coalesce("doc_id", F.lit(-LAST_ID - 1))))


def in_split_ranges(docs: DataFrame, part_bytes: int) -> tuple[DataFrame, list[int]]:
    """(doc_id, text, part) of every row and the first part of each range; ranges rise with doc_id, those without an id come first.

    A range is one part of about ``part_bytes``, but rows without an id, and those of one id with more bytes than that, are a range of
    their own that is dealt by place into as many parts as they need. ``docs`` must give its rows in the same order whenever it is
    read. The driver gets one number for each part.
    """
    rows = texts(docs, F.col("doc_id").cast("long").alias("doc_id"))
    size = F.sum(F.octet_length("text")).alias("size")
    nameless = rows.where("doc_id is null").agg(size).first()[0] or 0
    heavy = dict(rows.where("doc_id is not null").groupBy("doc_id").agg(size).where(F.col("size") > part_bytes).collect())
    rest = rows.where("doc_id is not null").where(~F.col("doc_id").isin(*heavy)) if heavy else rows.where("doc_id is not null")
    total = rest.agg(size).first()[0] or 0
    fine = 4 * (total // part_bytes + 1)
    quantiles = rest.approxQuantile("doc_id", [i / fine for i in range(1, fine)], 1 / (4 * fine)) if total > part_bytes else []
    alone = {i: -(-held // part_bytes) for i, held in heavy.items()}
    ends = {i + 1 for i in alone if i < LAST_ID}
    cuts = sorted(ends.union(alone, (min(int(q), LAST_ID) for q in quantiles)))
    held = dict(_by_bounds(rest, cuts, "fine").groupBy("fine").agg(size).collect()) if cuts else {}
    bounds, full, splits = [], held.get(0, 0), [-(-nameless // part_bytes) or 1, 1]
    for i, cut in enumerate(cuts, 1):
        if cut in alone or cut in ends or full and full + held.get(i, 0) > part_bytes:
            bounds.append(cut)
            splits.append(alone.get(cut, 1))
            full = 0
        full += held.get(i, 0)
    starts = [0, *accumulate(splits)][:-1]
    placed = _by_bounds(rows, bounds, "range")
    rank = F.when(F.col("doc_id").isNull(), 0).otherwise(F.col("range") + 1)
    many = {i: n for i, n in enumerate(splits) if n > 1}
    sub = F.lit(0)
    for i, n in many.items():
        sub = F.when(F.col("rank") == i, _lot(n)).otherwise(sub)
    part = F.element_at(F.lit(starts), F.col("rank") + 1).cast("int") + sub
    return placed.withColumn("rank", rank).withColumn("part", part).select("doc_id", "text", "part"), starts
