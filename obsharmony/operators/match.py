"""Nearest observation in time, space and depth, without comparing all pairs.

Candidates are summarised in grid cells. A query first meets cell summaries,
not candidates: a cell whose lowest possible distance exceeds the distance to
some known candidate cannot hold the answer and is dropped. Cells that are
still crowded are cut finer, for the remaining queries only, until every cell
holds few distinct positions. The distance to the best known candidate goes
along; it is learnt from pairs that are reduced where they are made, so pairs
beyond it are never shuffled. Only then are distances to candidates computed.
The result is the exact minimum, ties going to the smallest id, however many
candidates share one place.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.nulls import all_of
from ..functions.numeric import gamma_cdf
from ..functions.times import epoch_micros
from ..session import durable

DAY_MICROS = 86_400_000_000

# Depth window (m) below and above the 30 m mark, and the depth curve.
SHALLOW_WINDOW, DEEP_WINDOW, DEEP_FROM = 5.0, 15.0, 30.0
CURVE_SHAPE, CURVE_SCALE = 10, 1.5

_AXES = ["lat", "lon", "t", "depth"]
_POSITION = ["lat", "lon", "t", "depth"]
_CELL = [f"c_{a}" for a in _AXES]
# Cells are a little larger than the search box, so rounding never skips a neighbour.
_MARGIN = 1.001
_LON_CELLS = 16
_FINER = 4  # cells per parent and axis; a power of two keeps parents exact


@dataclass(frozen=True)
class Limits:
    """Search box: days, degrees, optional longitude limit; crowding limit of a cell."""

    days: float = 6.0
    degrees: float = 0.01
    lon_degrees: float | None = None
    cell_rows: int = 64
    max_level: int = 12

    @property
    def micros(self) -> int:
        return int(self.days * DAY_MICROS)


def _distance(lim: Limits, dlat: Column, dlon: Column, dg: Column, dt: Column, window: Column) -> Column:
    away = F.sqrt(dlat * dlat + dlon * dlon)
    return (
        F.lit(1.0 / lim.degrees) * away
        + (F.lit(1.0) / window) * F.abs(dg)
        + F.lit(1.0 / lim.days) * (F.abs(dt).cast("double") / F.lit(float(DAY_MICROS)))
    )


def _units(lim: Limits) -> dict[str, Column]:
    """Position in units of the level-0 cell."""
    return {
        "lat": F.col("lat") / F.lit(lim.degrees * _MARGIN),
        "lon": F.col("lon") / F.lit(lim.degrees * _MARGIN * _LON_CELLS),
        "t": F.col("t").cast("double") / F.lit(lim.micros * _MARGIN),
        "depth": F.col("depth") / F.lit(DEEP_WINDOW * _MARGIN),
    }


def _cells(lim: Limits, level: int) -> dict[str, Column]:
    scale = F.lit(float(_FINER**level))
    return {f"c_{a}": F.floor(u * scale) for a, u in _units(lim).items()}


def _summary(points: DataFrame, lim: Limits, level: int) -> DataFrame:
    """One row per occupied cell: extent, number of positions, one real member."""
    ranges = [
        agg(a).alias(f"{label}_{a}")
        for a in [*_AXES, "g"]
        for label, agg in (("min", F.min), ("max", F.max))
    ]
    member = F.min_by(F.struct(*_AXES, "g"), "id").alias("member")
    return (
        points.withColumns(_cells(lim, level))
        .groupBy(*_CELL)
        .agg(F.count("*").alias("n"), member, *ranges)
    )


def _q(a: str) -> Column:
    return F.col(f"q_{a}")


def _in_box(lim: Limits, point) -> Column:
    """`point(axis)` lies in the query's box."""
    tests = [
        point("t").between(_q("t") - F.lit(lim.micros), _q("t") + F.lit(lim.micros)),
        point("lat").between(_q("lat") - F.lit(lim.degrees), _q("lat") + F.lit(lim.degrees)),
        point("depth").between(_q("depth") - F.col("window"), _q("depth") + F.col("window")),
    ]
    if lim.lon_degrees is not None:
        reach = F.lit(lim.lon_degrees)
        tests.append(point("lon").between(_q("lon") - reach, _q("lon") + reach))
    return all_of(tests)


def _bounded(pairs: DataFrame, lim: Limits) -> DataFrame:
    """Drop cells outside the box or beyond the best known candidate; add the lowest and one reachable distance per cell."""

    def nearest(a: str) -> Column:
        return F.least(F.greatest(_q(a), F.col(f"min_{a}")), F.col(f"max_{a}"))

    def member(a: str) -> Column:
        return F.col("member")[a]

    def distance(point) -> Column:
        return _distance(
            lim,
            _q("lat") - point("lat"),
            _q("lon") - point("lon"),
            _q("g") - point("g"),
            _q("t") - point("t"),
            F.col("window"),
        )

    return (
        pairs.filter(_in_box(lim, nearest))
        .withColumn("low", distance(nearest))
        .filter(_may_hold("low"))
        .withColumn("reach", F.when(_in_box(lim, member), distance(member)))
        .select(*_QUERY, *_CELL, "n", "low", "reach", "best", "level")
    )


_QUERY = [f"q_{a}" for a in [*_AXES, "g"]] + ["window"]
_QUERY_KEY = [f"q_{a}" for a in _POSITION]


def _may_hold(distance: str) -> Column:
    """Not beyond the best known candidate of the query."""
    return F.col("best").isNull() | (F.col(distance) <= F.col("best"))


def _reached(pairs: DataFrame) -> DataFrame:
    """The best known candidate of each query. Only one row a query and task is shuffled, not the pairs."""
    return pairs.groupBy(*_QUERY_KEY).agg(F.min("reach").alias("reached"))


def _children(points: DataFrame, lim: Limits, level: int) -> DataFrame:
    """Occupied cells of `level` with their parents."""
    up = {f"p_{a}": F.floor(F.col(f"c_{a}") / F.lit(_FINER)) for a in _AXES}
    return _summary(points, lim, level).withColumns(up)


def _neighbours(cells: DataFrame) -> DataFrame:
    """Every cell listed under the 27 cells around it, longitude left open."""
    shifts = F.explode(F.array(F.lit(-1), F.lit(0), F.lit(1)))
    for a in ("lat", "t", "depth"):
        cells = cells.withColumn("__s", shifts).withColumn(
            f"n_{a}", F.col(f"c_{a}") + F.col("__s")
        )
    return cells.drop("__s")


def _start(queries: DataFrame, points: DataFrame, lim: Limits) -> DataFrame:
    """Cells around each query that may hold its answer.

    Two sets of pairs, both made and reduced in place, bound the query first: its own cell's
    children, whose members are close, and the cells around it. Only then are pairs kept.
    """
    own = _cells(lim, 0).items()
    asked = queries.withColumns({k.replace("c_", "n_"): c for k, c in own} | {"level": F.lit(0), "best": F.lit(None).cast("double")})
    asked = asked.withColumnsRenamed({a: f"q_{a}" for a in [*_AXES, "g"]})
    # Listed 27 times, cells take little room in a file but much in the driver: they are not to be broadcast.
    cells = durable(_neighbours(_summary(points, lim, 0)), "match-cells").hint("merge")
    near = ["n_lat", "n_t", "n_depth"]
    around = _bounded(asked.join(cells, near), lim)
    inside = _children(points, lim, 1).withColumnsRenamed({f"p_{a}": f"n_{a}" for a in _AXES})
    inside = _bounded(asked.join(inside, [f"n_{a}" for a in _AXES]), lim)
    known = _reached(around.unionByName(inside)).withColumnRenamed("reached", "best")
    return _bounded(asked.drop("best").join(known, _QUERY_KEY).join(cells, near), lim).drop("reach")


def _refine(frontier: DataFrame, points: DataFrame, lim: Limits, level: int) -> DataFrame:
    """Replace crowded cells of `level` by their occupied children that may hold the answer."""
    crowded = (F.col("level") == level) & (F.col("n") > lim.cell_rows)
    hot = frontier.filter(crowded).select(*_CELL).distinct()
    inside = points.withColumns(_cells(lim, level)).join(hot, _CELL, "left_semi")
    children = durable(_children(inside.drop(*_CELL), lim, level + 1), "match-cells")

    def finer(cells: DataFrame) -> DataFrame:
        parents = cells.filter(crowded).select(*_QUERY, *_CELL, "best")
        parents = parents.withColumnsRenamed({f"c_{a}": f"p_{a}" for a in _AXES})
        pairs = parents.join(children, [f"p_{a}" for a in _AXES])
        return _bounded(pairs.withColumn("level", F.lit(level + 1)), lim)

    known = frontier.join(_reached(finer(frontier)), _QUERY_KEY, "left")
    known = known.withColumn("best", F.least("best", "reached")).drop("reached").filter(_may_hold("low"))
    return known.filter(~crowded).unionByName(finer(known).drop("reach"))


def _crowded_rows(df: DataFrame, lim: Limits) -> bool:
    top = df.agg(F.max("n")).first()[0]
    return top is not None and top > lim.cell_rows


def nearest_values(queries: DataFrame, candidates: DataFrame, lim: Limits) -> DataFrame:
    """Value of the nearest candidate per distinct query position.

    queries: lat, lon, t, depth. candidates: the same plus id and value.
    Result: q_lat, q_lon, q_t, q_depth, match_id, match_value, match_distance.
    """
    curve = gamma_cdf("depth", CURVE_SHAPE, CURVE_SCALE)
    window = F.when(F.col("depth") > DEEP_FROM, F.lit(DEEP_WINDOW)).otherwise(F.lit(SHALLOW_WINDOW))
    asked = (
        queries.select(*_POSITION)
        .dropna()
        .distinct()
        .withColumns({"g": curve, "window": window})
    )
    # Equal positions have equal distances: the smallest id stands for all of them.
    points = (
        candidates.dropna(subset=_POSITION)
        .groupBy(*_POSITION)
        .agg(F.min_by("value", "id").alias("value"), F.min("id").alias("id"))
        .withColumn("g", curve)
    )

    frontier = _start(asked, points, lim)
    level = 0
    if _crowded_rows(_summary(points, lim, 0), lim):
        frontier = durable(frontier)
        while level < lim.max_level and _crowded_rows(
            frontier.filter(F.col("level") == level), lim
        ):
            frontier = durable(_refine(frontier, points, lim, level))
            level += 1

    found = None
    for step in range(level + 1):
        here = points.withColumns(_cells(lim, step))
        pairs = frontier.filter(F.col("level") == step).join(here, _CELL)
        found = pairs if found is None else found.unionByName(pairs)
    distance = _distance(
        lim,
        _q("lat") - F.col("lat"),
        _q("lon") - F.col("lon"),
        _q("g") - F.col("g"),
        _q("t") - F.col("t"),
        F.col("window"),
    )
    best = F.min_by(F.struct("id", "value", "distance"), F.struct("distance", "id"))
    return (
        found.filter(_in_box(lim, F.col))
        .withColumn("distance", distance)
        .filter(_may_hold("distance"))
        .groupBy(*_QUERY_KEY)
        .agg(best.alias("m"))
        .select(
            *_QUERY_KEY,
            F.col("m.id").alias("match_id"),
            F.col("m.value").alias("match_value"),
            F.col("m.distance").alias("match_distance"),
        )
    )


def fill_nearest(
    df: DataFrame,
    column: str,
    outcome: str,
    id_column: str,
    limits: Limits | None = None,
    lat: str = "Latitude",
    lon: str = "Longitude",
    time: str = "sampleDateTimeUTC",
    depth: str = "sampleDepth",
) -> DataFrame:
    """Fill NULLs of `column`, where `outcome` is known, from the nearest known value."""
    lim = limits or Limits()
    place = {
        "lat": F.col(lat).cast("double"),
        "lon": F.col(lon).cast("double"),
        "t": epoch_micros(time),
        "depth": F.col(depth).cast("double"),
    }
    known = F.col(column).isNotNull()
    wanted = ~known & F.col(outcome).isNotNull()
    position = [c.alias(a) for a, c in place.items()]
    matches = nearest_values(
        df.filter(wanted).select(*position),
        df.filter(known).select(
            *position, F.col(id_column).alias("id"), F.col(column).alias("value")
        ),
        lim,
    )
    condition = all_of([c == _q(a) for a, c in place.items()])
    filled = (
        df.filter(wanted)
        .join(matches.drop("match_id", "match_distance"), condition, "left")
        .withColumn(column, F.col("match_value"))
        .select(*df.columns)
    )
    return df.filter(known | F.col(outcome).isNull()).unionByName(filled)
