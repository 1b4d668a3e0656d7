"""Ranks and row numbers over more rows than one range holds, with partitions left as they are dealt."""

import pytest
from pyspark.sql import functions as F

from tessera.operators import normalize, tables


@pytest.fixture
def many(spark):
    """Keys shuffled over eight partitions that adaptive execution doesn't join."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield spark.range(0, 30000, 1, 8).select(((F.col("id") * 7919) % 30000).alias("k"))
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def last(v):
    """Order with nulls last."""
    return (v is None, 0 if v is None else v)


@pytest.mark.parametrize("nulls", [0, 300])
def test_quantile_norm_over_many_ranges(many, nulls):
    raw = lambda m: F.when(F.col("k") >= nulls, F.pmod(F.xxhash64("k", F.lit(m)), F.lit(700))).alias(m)
    long = tables.measurements(many.select(F.col("k").alias("cell_id"), *[raw(m) for m in "ABC"]), list("ABC"))
    values = {}
    for cell, marker, v in long.collect():
        values.setdefault(marker, []).append((last(v), cell, v))
    columns = {m: sorted(v) for m, v in values.items()}
    want = {}
    for at in zip(*columns.values()):
        there = [v for _, _, v in at if v is not None]
        for m, (_, cell, _) in zip(columns, at):
            want[cell, m] = sum(there) / len(there) if there else None
    got = normalize.quantile_norm(long).collect()
    assert len(got) == len(want) == 90000
    assert {(r.cell_id, r.marker): r.norm for r in got} == want


@pytest.mark.parametrize("nulls", [0, 300])
def test_positional_join_over_many_ranges(many, nulls):
    key = F.when(F.col("k") >= nulls, F.col("k"))
    a = many.select(key.alias("k"), (F.col("k") * 2).alias("v"))
    b = many.where("k < 25000").select((F.col("k") * 3).alias("w"), F.format_string("%08d", F.col("k")).alias("s"))
    got = tables.positional_join(a, b, ["k", "v"], ["s"]).select("row_idx", "k", "v", "w", "s").collect()
    left = sorted(((None if k < nulls else k, 2 * k) for k in range(30000)), key=lambda r: (last(r[0]), r[1]))
    assert sorted(map(tuple, got)) == [(n, *left[n], 3 * n, f"{n:08d}") for n in range(25000)]


def test_row_index_of_few_rows(spark):
    few = spark.createDataFrame([(2.0, "b"), (None, "d"), (-1.0, "a"), (float("nan"), "c")], "v double, w string")
    assert {r.w: r.row_idx for r in tables.with_row_index(few, ["v"]).collect()} == {"a": 0, "b": 1, "c": 2, "d": 3}
    assert tables.with_row_index(few.where("false"), ["v"]).count() == 0
