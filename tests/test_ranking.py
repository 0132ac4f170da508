"""Distributed ranks against pandas, with heavy ties and hot values."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from shopsight.operators import ranking

BINS = 5


def frame(seed, size, spread):
    rng = np.random.default_rng(seed)
    values = rng.integers(0, spread, size)
    values[: size // 3] = 1  # one value holds a third of the rows
    return pd.DataFrame({"user_id": np.arange(size), "v": rng.permutation(values)})


CASES = [(1, 1, 5), (2, 4, 3), (3, 7, 2), (4, 500, 6), (5, 997, 40), (6, 1000, 10**6)]


@pytest.mark.parametrize("seed,size,spread", CASES)
def test_percent_rank(spark, seed, size, spread):
    pdf = frame(seed, size, spread)
    df = spark.createDataFrame(pdf)
    cuts = ranking.percent_rank_cuts(df, ["v"], BINS)["v"]
    got = df.select("user_id", ranking.value_score(F.col("v"), cuts, BINS).alias("s")).toPandas().set_index("user_id").s
    rank = pdf.v.rank(method="average")
    want = np.clip(-(-(2 * rank * BINS) // (2 * size)), 1, BINS).astype(int)
    assert (got.sort_index().to_numpy() == want.to_numpy()).all()


@pytest.mark.parametrize("seed,size,spread", CASES)
def test_ntile(spark, seed, size, spread):
    pdf = frame(seed, size, spread)
    df = spark.createDataFrame(pdf)
    cuts = ranking.ntile_cuts(df, ["v"], "user_id", BINS)["v"]
    got = df.select("user_id", ranking.ntile_score(F.col("v"), F.col("user_id"), cuts).alias("s")).toPandas()
    ordered = pdf.sort_values(["v", "user_id"]).user_id.to_numpy()
    sizes = [size // BINS + (1 if k < size % BINS else 0) for k in range(BINS)]
    want = dict(zip(ordered, np.repeat(np.arange(1, BINS + 1), sizes)))
    assert dict(zip(got.user_id, got.s)) == want


def test_quantile_bins_match_pandas(spark):
    pdf = pd.DataFrame({"user_id": range(1003), "v": np.random.default_rng(9).integers(0, 10**7, 1003)})
    df = spark.createDataFrame(pdf)
    cuts = ranking.quantile_cuts(df, ["v"], BINS)["v"]
    got = df.select("user_id", ranking.value_score(F.col("v"), cuts, BINS).alias("s")).toPandas()
    want = pd.qcut(pdf.v, BINS, labels=[1, 2, 3, 4, 5]).astype(int)
    assert (got.sort_values("user_id").s.to_numpy() == want.to_numpy()).all()


def test_quantile_bins_refuse_repeated_edges(spark):
    df = spark.createDataFrame([(i, 1 if i < 90 else i) for i in range(100)], "user_id long, v long")
    with pytest.raises(ValueError, match="edges"):
        ranking.quantile_cuts(df, ["v"], BINS)


def test_running_totals(spark):
    rows = [(g, v, (v * 7) % 5 + 1) for g in "ab" for v in range(200)]
    df = spark.createDataFrame(rows, "g string, v long, n long")
    for descending in (False, True):
        got = ranking.running_totals(df, ["v"], ["n"], group=("g",), descending=descending).collect()
        assert len(got) == 400
        for r in got:
            others = [n for g, v, n in rows if g == r.g]
            before = [n for g, v, n in rows if g == r.g and (v > r.v if descending else v < r.v)]
            assert (r.n_before, r.n_total) == (sum(before), sum(others))


def test_null_value_gets_middle_score(spark):
    df = spark.createDataFrame([(None,), (5,)], "v long")
    got = {r.v: r.s for r in df.select("v", ranking.value_score(F.col("v"), [3, 4, 5, 6], 5).alias("s")).collect()}
    assert got == {None: 3, 5: 4}


def test_empty_input(spark):
    df = spark.createDataFrame([], "user_id long, v long")
    assert ranking.percent_rank_cuts(df, ["v"], 5) == {}
    assert ranking.ntile_cuts(df, ["v"], "user_id", 5) == {}
