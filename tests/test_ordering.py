"""Two-level positions against brute force, with blocks small enough to have many."""

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from chunkatlas.operators.ordering import delete_batches, with_ordinal, with_ordinal_sorted


@pytest.mark.parametrize("block_bits", [0, 2, 5, 17])
def test_ordinal_and_sums(spark, block_bits):
    rng = random.Random(1)
    ranks = rng.sample(range(-500, 4000), 300)
    sizes = [rng.randrange(0, 9) for _ in ranks]
    table = spark.createDataFrame(list(zip(ranks, sizes)), "search_rank BIGINT, n BIGINT")
    got = with_ordinal(table, base=7, sums={"off": ("n", 100)}, block_bits=block_bits)
    expected, total = [], 100
    for i, (rank, n) in enumerate(sorted(zip(ranks, sizes))):
        expected.append((rank, n, 7 + i, total))
        total += n
    assert rows(got) == sorted(expected, key=repr)
    assert got.columns == ["search_rank", "n", "ordinal", "off"]


def test_ordinal_with_prefix(spark):
    pairs = [(s, r) for s in (2, 0, 1) for r in range(0, 90, 3)]
    table = spark.createDataFrame(pairs, "spec_no INT, search_rank BIGINT")
    got = with_ordinal(table, prefix=["spec_no"], block_bits=3)
    assert rows(got) == sorted([(s, r, i) for i, (s, r) in enumerate(sorted(pairs))], key=repr)


def test_a_third_of_all_rows_with_one_sort_value(spark):
    rng = random.Random(2)
    pairs = [(5 if i % 3 == 0 else rng.randrange(100), i) for i in range(600)]
    table = spark.createDataFrame(pairs, "at INT, search_rank BIGINT")
    got = with_ordinal_sorted(table, ["at", "search_rank"])
    assert rows(got) == sorted([(a, r, i) for i, (a, r) in enumerate(sorted(pairs))], key=repr)
    placed = got.select(F.col("ordinal")).distinct().count()
    assert placed == 600


def test_no_window_over_all_rows(spark):
    """The only single-partition exchange carries block totals."""
    table = spark.range(1000).withColumnRenamed("id", "search_rank")
    plan = with_ordinal(table)._jdf.queryExecution().executedPlan().toString()
    single = plan.split("Exchange SinglePartition")
    assert len(single) == 2
    assert "HashAggregate(keys=[_block" in single[1].split("Scan")[0]


def test_delete_batches(spark):
    keys = spark.createDataFrame([(f"k{i:04d}",) for i in range(25)], "key STRING")
    got = delete_batches(keys, 10).groupBy("batch_no").count()
    assert rows(got) == [(0, 10), (1, 10), (2, 5)]
