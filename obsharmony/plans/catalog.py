"""Registry of queries: a DataFrame builder and, where SQL can say it, the same in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Builder = Callable[[SparkSession, str], DataFrame]

BUILDERS: dict[str, Builder] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Builder], Builder]:
    """Register a builder under its function name, with its SQL counterpart."""

    def add(fn: Builder) -> Builder:
        key = name or fn.__name__
        if key in BUILDERS:
            raise ValueError(f"query {key} registered twice")
        BUILDERS[key] = fn
        if sql is not None:
            ORACLES[key] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def steady(c: Column | str, digits: int = 6) -> Column:
    """Rounded value whose ties a different summation order cannot split."""
    c = F.col(c) if isinstance(c, str) else c
    scale = F.lit(10.0**digits)
    return F.floor(c * scale + F.lit(0.500001)) / scale


def steady_sql(expr: str, digits: int = 6) -> str:
    return f"floor(({expr}) * 1e{digits} + 0.500001e0) / 1e{digits}"


# Observations derived from the events table, in text both engines read alike.
OBSERVATIONS = """
SELECT event_id AS uid,
       'survey_' || (user_id % 3) AS Study,
       'S' || (user_id % 20) AS SITE_ID,
       event_type AS ANALYTE,
       CASE WHEN user_id % 4 > 0 THEN 'M' || (user_id % 2) END AS METHOD,
       CASE WHEN event_id % 29 = 0 THEN 'none' WHEN event_type = 'click' THEN 'mg/L'
            WHEN event_type = 'view' THEN 'ug/L' WHEN event_type = 'purchase' THEN '%'
            WHEN event_type = 'error' THEN 'NTU' ELSE 'ug.P/L' END AS UNITS,
       ts AS sampleDateTimeUTC,
       41e0 + (user_id % 97) * 5e-2 AS Latitude,
       -88e0 + (user_id % 31) * 1e-1 AS Longitude,
       CAST(event_id % 61 AS DOUBLE) AS sampleDepth,
       CASE WHEN event_id % 7 = 0 THEN NULL WHEN event_id % 17 = 0 THEN 0e0
            WHEN event_id % 19 = 0 THEN 0e0 - value ELSE value END AS RESULT,
       CASE event_id % 11 WHEN 0 THEN 'ND' WHEN 1 THEN 'Q, H' WHEN 2 THEN 'E' END AS QAcode,
       CASE event_id % 13 WHEN 0 THEN 'below reporting limit'
                          WHEN 1 THEN 'held too long; recheck' END AS QAcomment
FROM {events}
"""


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(OBSERVATIONS, events=table(spark, sf_dir, "events"))


def with_obs(sql: str) -> str:
    """SQL text that starts from the observation view as `obs`."""
    return f"WITH obs AS ({OBSERVATIONS.format(events='events')}){sql}"
