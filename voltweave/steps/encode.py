"""Calendar features and categorical encodings.

The ordered levels of a categorical column are kept in the column's metadata, where later steps find them; only
columns without them are scanned. Up to ``INLINE_LEVELS`` they are a list, beyond that a *dictionary*: a stored table
of level and code, numbered by a distributed sort, that steps join to the rows. Spark picks the kind of that
join from the size of the table.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltweave.functions import calendar
from voltweave.functions.sql import quoted, text_literal
from voltweave.operators.order import row_index
from voltweave.sources.staging import stage, staging_root
from voltweave.steps.base import FeatureStep, columns_of

INLINE_LEVELS = 1000
MAX_COLUMNS = 5000  # default of ``max_levels`` of DummyEncode, which makes a column per level
DICTIONARY = "level string, code int"

Levels = list[str] | str  # a list in order, or the path of a dictionary


def known_levels(df: DataFrame, col: str) -> Levels | None:
    return df.schema[col].metadata.get("levels")


def learn_levels(df: DataFrame, cols: list[str], inline: int = INLINE_LEVELS) -> dict[str, Levels]:
    """The distinct text values of each column in text order: a list, or beyond ``inline`` the path of a dictionary.

    The columns are scanned once. Codes of a dictionary are positions in the order of all levels, from 1.
    """
    if not cols:
        return {}
    cells = ", ".join(f"struct({text_literal(c)} AS col, string({quoted(c)}) AS level)" for c in cols)
    distinct = stage(df.selectExpr(f"inline(array({cells}))").where("level IS NOT NULL").distinct(), "levels")
    counts = {row["col"]: row["count"] for row in distinct.groupBy("col").count().collect()}  # a row per column
    found: dict[str, Levels] = {c: [] for c in cols}
    for row in distinct.where(F.col("col").isin([c for c in cols if counts.get(c, 0) <= inline])).collect():  # inline rows per column
        found[row["col"]].append(row["level"])
    found = {c: sorted(levels) for c, levels in found.items()}
    for c in cols:
        if counts.get(c, 0) > inline:
            numbered = row_index(distinct.where(F.col("col") == c).select("level"), ["level"], name="code")
            found[c] = f"{staging_root(df.sparkSession)}/voltweave/dictionary-{uuid.uuid4().hex}"
            numbered.select("level", (F.col("code") + 1).cast("int").alias("code")).write.parquet(found[c])
    return found


def with_levels(df: DataFrame, levels: dict[str, Levels]) -> DataFrame:
    for col, order in levels.items():
        df = df.withMetadata(col, {"levels": order})
    return df


def encoded(df: DataFrame, col: str, path: str) -> DataFrame:
    """``col`` replaced by its code in the dictionary at ``path``; 0 where it has none, null stays null."""
    names = df.columns
    codes = df.sparkSession.read.schema(DICTIONARY).parquet(path).withColumnsRenamed({"level": "__level", "code": "__code"})
    # Nulls would all meet in one partition of a shuffled join: they take texts by their rows' hashes that no level has.
    text = F.coalesce(F.col(quoted(col)).cast("string"), F.concat(F.lit("\x00"), F.xxhash64(*[F.col(quoted(c)) for c in names]).cast("string")))
    known = df.withColumn("__text", text).join(codes, F.col("__text") == F.col("__level"), "left")
    code = F.when(F.col(quoted(col)).isNotNull(), F.coalesce("__code", F.lit(0)))
    return known.withColumn(col, code).select(*[F.col(quoted(c)) for c in names])


class Mutate(FeatureStep):
    """Add or replace columns by SQL expressions: ``Mutate(exprs={"name": "sql"})``."""

    @staticmethod
    def apply(df: DataFrame, config: dict, state: dict) -> DataFrame:
        return df.withColumns({name: F.expr(text) for name, text in config["exprs"].items()})


class DateFeatures(FeatureStep):
    """Month and weekday labels, seven-day week number and day of year of a date column."""

    @staticmethod
    def apply(df: DataFrame, config: dict, state: dict) -> DataFrame:
        col = config.get("col", "DATE")
        date = F.col(col)
        made = {
            "month": calendar.month_label(date),
            "week": calendar.week_of_year_sevens(date),
            "dow": calendar.weekday_label(date),
            "doy": F.dayofyear(date),
        }
        features = config.get("features", ["month", "week", "dow", "doy"])
        out = df.withColumns({f"{col}_{name}": made[name] for name in features})
        labels = {"month": calendar.MONTH_LABELS, "dow": calendar.WEEKDAY_LABELS}
        out = with_levels(out, {f"{col}_{name}": labels[name] for name in features if name in labels})
        return out if config.get("keep", False) else out.drop(col)


class LevelOrder(FeatureStep):
    """Make columns categorical: text values whose levels are in text order."""

    @staticmethod
    def learn(df: DataFrame, config: dict, roles) -> dict:
        return {"levels": learn_levels(df, columns_of(config, df, roles), config.get("inline", INLINE_LEVELS))}

    @staticmethod
    def apply(df: DataFrame, config: dict, state: dict) -> DataFrame:
        levels = state["levels"]
        out = df.withColumns({c: F.expr(f"string({quoted(c)})") for c in levels}) if levels else df
        return with_levels(out, levels)


def _levels_for(df: DataFrame, cols: list[str], inline: int) -> dict[str, Levels]:
    levels = {c: known_levels(df, c) for c in cols}
    levels.update(learn_levels(df, [c for c in cols if levels[c] is None], inline))
    return {c: levels[c] for c in cols}


class IntegerEncode(FeatureStep):
    """Levels to 1..k in level order; a new level gives 0 and null stays null."""

    @staticmethod
    def learn(df: DataFrame, config: dict, roles) -> dict:
        return {"levels": _levels_for(df, columns_of(config, df, roles), config.get("inline", INLINE_LEVELS))}

    @staticmethod
    def apply(df: DataFrame, config: dict, state: dict) -> DataFrame:
        few = {c: levels for c, levels in state["levels"].items() if not isinstance(levels, str)}
        out = df.withColumns({
            c: F.expr(f"int(array_position(array({', '.join(text_literal(v) for v in levels)}), string({quoted(c)})))")
            for c, levels in few.items()
        }) if few else df
        for c, levels in state["levels"].items():
            if c not in few:
                out = encoded(out, c, levels)
        return out


def dummy_name(col: str, level: str) -> str:
    """Column name of an indicator; a level that is no valid name on its own gets an ``X``."""
    safe = "".join(ch if ch.isalnum() or ch in "._" else "." for ch in level)
    return f"{col}_{safe if safe[:1].isalpha() else 'X' + safe}"


class DummyEncode(FeatureStep):
    """One 0/1 column per level but the first; a new or null level gives nulls.

    As every level is a column, more than ``max_levels`` are an error.
    """

    @staticmethod
    def learn(df: DataFrame, config: dict, roles) -> dict:
        most = config.get("max_levels", MAX_COLUMNS)
        levels = _levels_for(df, columns_of(config, df, roles), most)
        for c, found in levels.items():
            if isinstance(found, str):  # a dictionary of an earlier step
                codes = df.sparkSession.read.schema(DICTIONARY).parquet(found)
                levels[c] = [row["level"] for row in codes.orderBy("code").limit(most + 1).collect()]
        large = [c for c, found in levels.items() if len(found) > most or isinstance(found, str)]
        if large:
            raise ValueError(f"more than {most} levels in {large}")
        return {"levels": levels}

    @staticmethod
    def apply(df: DataFrame, config: dict, state: dict) -> DataFrame:
        made, codes = [], []
        for k, (c, levels) in enumerate(state["levels"].items()):
            known = ", ".join(text_literal(v) for v in levels)
            codes.append(f"nullif(int(array_position(array({known}), string({quoted(c)}))), 0) AS __code{k}")
            made += [f"int(__code{k} = {i}) AS {quoted(dummy_name(c, level))}" for i, level in enumerate(levels[1:], 2)]
        rest = [quoted(c) for c in df.columns if c not in state["levels"]]
        return df.selectExpr("*", *codes).selectExpr(*rest, *made)
