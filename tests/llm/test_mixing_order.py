"""The order of a mixture and the spread of rows without an id."""

from pyspark.sql import functions as F

from shelfstream.llm import mixing


def test_mixture_is_not_in_the_order_of_the_input(spark):
    rows = [(i, "a" if i < 500 else "b", f"t{i}") for i in range(1000)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string").coalesce(1)
    parts = mixing.mix(docs).select(F.spark_partition_id(), "source").collect()
    changes = sum(x[0] == y[0] and x[1] != y[1] for x, y in zip(parts, parts[1:]))
    assert changes > len(parts) / 4


def test_rows_without_an_id_spread(spark):
    # Without an id all rows of a source draw the same count; the sources draw by their sizes.
    rows = [(None, f"s{i % 7}", f"t{i}") for i in range(2000 + 3)] + [(None, "few", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    sizes = [r[1] for r in mixing.mix(docs, size=40.0).where("source <> 'few'").groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 4 and max(sizes) < sum(sizes) / 2
