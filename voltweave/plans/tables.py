"""The derived tables: union, transformed columns, daily series, site tables, and their joins.

Small derived tables (one row per date or per site) are stored, so the join to the readings sees
their real size. Target means use all training rows, as the original analysis does; that leaks the
outcome into the folds. ``daily_within_fold`` recomputes them from a fold's analysis rows instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltweave.operators.aggregates import daily_mean, summarise
from voltweave.operators.columns import matching, tag_source
from voltweave.operators.joins import join_daily, join_site
from voltweave.operators.setops import union_by_name
from voltweave.operators.spatial import distinct_sites, geo_cluster
from voltweave.operators.windows import centred_roll, shift_fill_edge, shift_fill_self
from voltweave.sources.staging import stage
from voltweave.steps import GeodesicDistance, ImputeMedian, LogShift, YeoJohnson

MEASURES = [f"V_{i}" for i in range(1, 14)]


def eda_union(train: DataFrame, test: DataFrame) -> DataFrame:
    """Training and scoring rows in one table with a ``dataset`` column."""
    return union_by_name(tag_source(train, "train"), tag_source(test, "test"))


def eda_transformed(eda: DataFrame, strict: bool = False) -> DataFrame:
    """Logs, power transform and imputation of the measures that need them.

    The power transform and the median take several passes, so the union is stored first.
    """
    eda = stage(eda, "eda")
    for step in (
        LogShift(cols=["V_1", "V_6", "V_9", "V_11", "V_12"], shift=0.1),
        YeoJohnson(col="V_8"),
        ImputeMedian("V_5", "V_5 < 0", strict),
    ):
        eda = step.fit(eda).transform(eda)
    return eda


# --- daily series --------------------------------------------------------------------------------

def daily_rolls(train: DataFrame) -> DataFrame:
    """Mean outcome per date with rolling means and three lags and leads."""
    daily = daily_mean(train, ["POWER"])
    return shift_fill_self(centred_roll(daily, ["POWER_mean"]), ["POWER_mean"])


def daily_shifts(df: DataFrame, cols: list[str]) -> DataFrame:
    """Daily means of several columns with five edge-filled lags and leads each."""
    return shift_fill_edge(daily_mean(df, cols), [f"{name}_mean" for name in cols])


def with_log10(df: DataFrame, cols: list[str], shift: float = 0.0) -> DataFrame:
    """Add ``{col}_log10``; null where the shifted value is not positive."""
    return df.withColumns({f"{name}_log10": F.log10(F.col(name) + F.lit(shift)) for name in cols})


def daily_power_log(train: DataFrame) -> DataFrame:
    return daily_shifts(with_log10(train, ["POWER"]), ["POWER", "POWER_log10"])


def daily_measures(eda: DataFrame) -> DataFrame:
    """All measures and their logs: 26 series with their shifts."""
    cols = matching(eda.columns, r"^V_[0-9]{1,2}$")
    return daily_shifts(with_log10(eda, cols, 10.0), [*cols, *[f"{name}_log10" for name in cols]])


# --- site tables ---------------------------------------------------------------------------------

def site_groups(eda: DataFrame, k: int = 10) -> DataFrame:
    return geo_cluster(distinct_sites(eda), k)


def site_targets(eda: DataFrame, k: int = 10) -> DataFrame:
    """Group of every training site, with outcome and measure statistics of its group."""
    grouped = stage(join_site(
        eda.where("dataset = 'train'").select("LAT", "LON", "POWER", "V_1", "V_2", "V_3"), site_groups(eda, k)
    ), "grouped")
    fns = ["mean", "median", "sd", "min", "max"]
    stats = summarise(grouped, ["Geo_Group"], ["POWER", "V_1", "V_2", "V_3"], fns, "Geo_by_{col}_{fn}")
    sites = grouped.select("LAT", "LON", "Geo_Group").distinct()
    return sites.join(stage(stats, "groups"), "Geo_Group", "left").select(
        "LAT", "LON", "Geo_Group", *[name for name in stats.columns if name != "Geo_Group"]
    )


def site_distances(eda: DataFrame, k: int = 10) -> DataFrame:
    """Group of every site and log10 of its ellipsoidal distance to a fixed place in the east."""
    # The reference position.
    distance = GeodesicDistance(name="dist_shanghai", ref_lat=31.2304, ref_lon=121.4737, log10=True)
    return distance.fit(eda).transform(site_groups(eda, k))


# --- joined feature tables -----------------------------------------------------------------------

def feature_tables_v1(train: DataFrame, test: DataFrame) -> tuple[DataFrame, DataFrame]:
    daily = stage(daily_rolls(train), "daily")
    sites = stage(site_groups(eda_union(train, test)), "sites")
    return tuple(join_site(join_daily(df, daily), sites) for df in (train, test))


def feature_tables_v2(train: DataFrame, test: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Sites come from training rows only, so a site seen first in scoring has nulls."""
    daily = stage(daily_shifts(train, ["POWER", "V_1"]), "daily")
    sites = stage(site_targets(eda_union(train, test)), "sites")
    return tuple(join_site(join_daily(df, daily), sites) for df in (train, test))


def feature_tables_v3(train: DataFrame, test: DataFrame) -> tuple[DataFrame, DataFrame]:
    eda = eda_union(train, test)
    power = stage(daily_power_log(train), "daily")
    measures = stage(daily_measures(eda), "daily")
    sites = stage(site_distances(eda), "sites")
    return tuple(join_daily(join_daily(join_site(df, sites), power), measures) for df in (train, test))


def daily_within_fold(analysis: DataFrame, rows: DataFrame) -> DataFrame:
    """Replace the daily outcome columns of ``rows`` by ones computed from ``analysis`` only."""
    daily = daily_rolls(analysis.select("DATE", "POWER"))
    stale = [name for name in daily.columns if name != "DATE"]
    return join_daily(rows.drop(*stale), stage(daily, "daily"))
