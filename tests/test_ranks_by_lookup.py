"""Ranks of frequent values are looked up where the row is; the others are shuffled."""

import numpy as np
import pandas as pd
import pytest

from voltweave.operators import ranks as ranks_of
from voltweave.steps.numeric import correlation_matrix


@pytest.mark.parametrize("frequent, counted", [(1 << 21, 1 << 15), (600, 50), (40, 7), (0, 1)])
def test_ranks_do_not_depend_on_what_is_looked_up(spark, monkeypatch, frequent, counted):
    """Half the rows of ``a`` share one value; ``b`` has few values, ``c`` half its rows, ``d`` infinities."""
    rng = np.random.default_rng(3)
    n = 3000
    data = pd.DataFrame({
        "a": np.where(rng.random(n) < 0.5, 0.0, rng.integers(-500, 500, n) / 4), "b": rng.integers(0, 5, n) * 1.0,
        "c": np.where(rng.random(n) < 0.5, np.nan, rng.normal(size=n)), "d": np.where(rng.random(n) < 0.1, np.inf, -rng.integers(0, 90, n)),
    })
    data.loc[7] = np.nan
    frame = spark.createDataFrame([tuple(None if x != x else x for x in r) for r in data.itertuples(index=False, name=None)],
                                  "a double, b double, c double, d double").repartition(5)
    staged = {}
    kept = ranks_of.stage
    monkeypatch.setattr(ranks_of, "FREQUENT", frequent, raising=False)
    monkeypatch.setattr(ranks_of, "COUNTED", counted, raising=False)
    monkeypatch.setattr(ranks_of, "stage", lambda df, name: staged.setdefault(name, kept(df, name)))
    got = ranks_of.tied_ranks(frame, list("abcd")).toPandas()
    expected = data.rank().drop(index=7)
    by = ["a", "b", "c", "d"]
    pd.testing.assert_frame_equal(got.sort_values(by).reset_index(drop=True), expected.sort_values(by).reset_index(drop=True), check_dtype=False)
    # What is shuffled: never a value that half the rows have, nothing where all values fit the table.
    assert ("frequent-ranks" in staged) == (frequent < 2000)
    if frequent == 40:
        assert staged["frequent-ranks"].where("x0 = 0").isEmpty()


def test_spearman_by_both_ways(spark, monkeypatch):
    rng = np.random.default_rng(4)
    x = rng.normal(size=500)
    data = pd.DataFrame({"a": x, "b": np.round(x + rng.normal(size=500)), "c": rng.integers(0, 3, 500) * 1.0})
    frame = spark.createDataFrame(data)
    whole = np.array(correlation_matrix(frame, list("abc")))
    monkeypatch.setattr(ranks_of, "FREQUENT", 30, raising=False)
    assert np.allclose(np.array(correlation_matrix(frame, list("abc"))), whole, atol=1e-9)
    assert np.allclose(whole, data.rank().corr().to_numpy(), atol=1e-9)
