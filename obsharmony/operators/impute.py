"""Filling censored and missing results."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.nulls import any_of, matches
from ..functions.numeric import seeded_uniform
from ..functions.times import epoch_micros
from ..session import durable
from . import cells
from .groups import collapse_texts, with_group_stats, with_group_stats_shuffled
from .joins import null_safe_join
from .reshape import pivot_wide

POSITION = ["Latitude", "Longitude", "sampleDateTimeUTC", "CodeName", "sampleDepth"]


def _merge_positions(df: DataFrame, order: str) -> DataFrame:
    """One mean RESULT, MDL and RL and joined texts per position and code."""
    means = df.groupBy(*POSITION).agg(
        *[F.avg(c).alias(f"__{c}") for c in ("RESULT", "MDL", "RL")]
    )
    texts = ["Study", "Unified_Flag", "Unified_Comment"]
    joined = collapse_texts(df, POSITION, texts, order).withColumnsRenamed(
        {c: f"__{c}" for c in texts}
    )
    table = null_safe_join(means, joined, POSITION, "inner")
    out = null_safe_join(df, table, POSITION)
    replaced = ["RESULT", "MDL", "RL", *texts]
    return out.withColumns({c: F.col(f"__{c}") for c in replaced}).drop(
        *[f"__{c}" for c in replaced]
    )


def detection_limit_fill(
    df: DataFrame, order: str, method: str | None = None, seed: int = 0
) -> DataFrame:
    """Fill missing results from detection and reporting limits.

    Positions are merged first, then limits are averaged per study, year and
    code. A missing result flagged N, with a known MDL or more than one observed
    result in its group, takes the smallest of the limits and results of the
    group; otherwise the MDL, otherwise the RL. `method`: "halfMDL" halves that
    value, "uniform" draws below it (repeatable, per row), None keeps it.
    `order` gives the first-seen order of joined texts and stays out of the
    result's row identity.
    """
    merged = _merge_positions(df, order)
    merged = merged.drop(order).distinct().withColumn("Year", F.year("sampleDateTimeUTC"))
    group = ["Study", "Year", "CodeName"]
    out = with_group_stats_shuffled(
        merged,
        group,
        __mdl=F.avg("MDL"),
        __rl=F.avg("RL"),
        __seen=F.count("RESULT"),
        __low=F.min("RESULT"),
    )
    mdl, rl, result = F.col("__mdl"), F.col("__rl"), F.col("RESULT")

    kinds = dict(df.dtypes)
    # Millionths of a unit and microseconds spell a position alike everywhere.
    spelled = {"double": lambda c: F.round(F.col(c) * 1e6).cast("bigint"), "timestamp_ntz": epoch_micros}
    drawn_by = [spelled[kinds[c]](c) if kinds[c] in spelled else F.col(c) for c in POSITION]

    def censored(limit: Column) -> Column:
        if method == "halfMDL":
            return limit / 2
        if method == "uniform":
            return limit * seeded_uniform(seed, *drawn_by, "Study")
        return limit

    # A joined flag text spells a missing flag 'NA'; that is not an N.
    flag = F.regexp_replace("Unified_Flag", r"\bNA\b", "")
    non_detect = matches(flag, "N") & (mdl.isNotNull() | (F.col("__seen") > 1))
    value = (
        F.when(result.isNotNull(), result)
        .when(non_detect, censored(F.least(mdl, rl, F.col("__low"))))
        .when(mdl.isNotNull(), censored(mdl))
        .when(rl.isNotNull(), censored(rl))
    )
    return out.withColumns({"RESULT": value, "MDL": mdl, "RL": rl}).drop(
        "__mdl", "__rl", "__seen", "__low"
    )


def mean_limit_fill(df: DataFrame) -> DataFrame:
    """Missing result becomes the code's mean MDL."""
    out = with_group_stats(df, ["CodeName"], __mdl=F.avg("MDL"))
    return out.withColumn("RESULT", F.coalesce("RESULT", "__mdl")).drop("__mdl")


WIDE_IDS = ["Latitude", "Longitude", "sampleDateTimeUTC", "sampleDepth", "stationDepth", "SITE_ID"]


def exact_pivot(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """One row per position, one mean column per CodeName_Units; incomplete positions go."""
    wide = pivot_wide(df, WIDE_IDS, list(names), ["CodeName", "Units"])
    return wide.dropna(subset=["Latitude", "sampleDateTimeUTC", "sampleDepth"])


def missing_counts(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Observed and missing results per group."""
    return df.groupBy(*by).agg(
        F.count("RESULT").alias("measureCount"),
        F.count_if(F.col("RESULT").isNull()).alias("missingCount"),
    )


def fill_report(before: DataFrame, after: DataFrame, columns: Sequence[str], outcome: str) -> DataFrame:
    """Share of rows missing each column while the outcome is known, before and after."""

    def shares(df: DataFrame, step: str) -> DataFrame:
        wanted = F.col(outcome).isNotNull()
        return df.agg(
            *[F.avg((F.col(c).isNull() & wanted).cast("int")).alias(c) for c in columns]
        ).select(F.lit(step).alias("step"), *columns)

    return shares(before, "before").unionByName(shares(after, "after"))


def low_missing_columns(df: DataFrame, columns: Sequence[str], outcome: str, slack: float = 1.05) -> list[str]:
    """Columns whose share of NULLs is below that of the outcome times `slack`."""
    row = df.agg(
        *[F.avg(F.col(c).isNull().cast("int")).alias(c) for c in dict.fromkeys([*columns, outcome])]
    ).first()
    if row is None or row[outcome] is None:
        return []
    return [c for c in columns if row[c] < row[outcome] * slack]


def _forest(label: str, inputs: Sequence[str], trees: int, depth: int, seed: int):
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import RandomForestRegressor

    held = VectorAssembler(inputCols=list(inputs), outputCol="__in", handleInvalid="error")
    grown = RandomForestRegressor(
        featuresCol="__in", labelCol=label, predictionCol="__out", numTrees=trees, maxDepth=depth, seed=seed
    )
    return Pipeline(stages=[held, grown])


def forest_fill(
    df: DataFrame,
    columns: Sequence[str],
    rounds: int = 10,
    trees: int = 20,
    depth: int = 8,
    seed: int = 0,
) -> DataFrame:
    """Random-forest imputation: every column is predicted from the others, round by round.

    Starts from column means. Trains on all rows that have the column, and never changes an
    observed value. Stops with the first round that changes the values more than the round
    before did (squared change over squared values, as missForest) and returns the round before;
    `rounds` is the most there are, ten as in missForest. Rows with the same gaps and the same
    bins elsewhere get the same values in every round, so rounds work on cells of such rows; filled
    columns are doubles. Where the columns' bins make too many cells (`cells.MOST_CELLS`), forests see rows.
    """
    columns = list(columns)
    df = durable(df, "forest-rows")
    seen = df.agg(
        *[F.avg(c).alias(f"mean_{c}") for c in columns],
        *[F.avg(F.col(c).isNull().cast("int")).alias(f"share_{c}") for c in columns],
        *[F.sum(F.col(c) ** 2).alias(f"square_{c}") for c in columns],
    ).first()
    shares = {c: 1.0 if seen[f"share_{c}"] is None else seen[f"share_{c}"] for c in columns}
    gaps = sorted((c for c in columns if 0 < shares[c] < 1), key=lambda c: (shares[c], c))
    if not gaps:
        return df
    # A column without any value can neither be predicted nor help to predict.
    usable = [c for c in columns if shares[c] < 1]
    space = cells.Space(cells.cuts_of(df, usable), gaps)
    observed = sum(seen[f"square_{c}"] for c in usable)
    means = {c: float(seen[f"mean_{c}"]) for c in gaps}
    if space.most([usable.index(c) for c in gaps]) <= cells.MOST_CELLS:
        return _filled_by_cells(df, space, means, observed, rounds, trees, depth, seed)
    return _filled_by_rows(df, gaps, usable, means, observed, rounds, trees, depth, seed)


def _filled_by_cells(
    df: DataFrame, space: cells.Space, means: dict[str, float], observed: float, rounds: int, trees: int, depth: int, seed: int
) -> DataFrame:
    gaps = [space.columns.index(c) for c in means]  # from the fullest column on
    start = np.array(list(means.values()))

    def tally(values):
        codes = space.codes([values[c] for c in space.columns])
        some = np.logical_or.reduce([codes[g] == space.bins[g] for g in gaps])
        yield -1, space.keys([c[some] for c in codes]), [np.ones(int(some.sum())), *[np.zeros(int(some.sum()))] * (2 * trees)]
        for g, mean in zip(gaps, start):
            seen = codes[g] < space.bins[g]
            # A whole row's own bin plays no part; the other gaps of a row follow from all that is seen of it.
            own = np.where(some, codes[g], 0)
            keys = space.keys([(own if j == g else c)[seen] for j, c in enumerate(codes)])
            drawn = cells.draws(values[cells.PLACE][seen], trees, g).astype(float)
            sums = drawn * (values[space.columns[g]][seen] - mean)[:, None]
            yield g, keys, [np.ones(len(keys)), *drawn.T, *sums.T]

    read = cells.placed(df.select(*[F.col(c).cast("double").alias(c) for c in space.columns]), seed)
    table = cells.tallied(read, [*space.columns, cells.PLACE], tally, 1 + 2 * trees)
    keys, n = cells.cells_of(table, -1)
    n, codes = n[:, 0], space.decoded(keys)
    missing = codes[:, gaps] == np.array(space.bins)[gaps]
    values = np.where(missing, start, 0.0)

    def filled(rows: np.ndarray, own: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Codes with the bins of the values now in their gaps; `at` has the gap cell of each row in `rows`."""
        out = own.copy()
        for i, g in enumerate(gaps):
            hole = rows[own[rows, g] == space.bins[g]]
            out[hole, g] = np.searchsorted(space.cuts[g], values[at[own[rows, g] == space.bins[g]], i])
        return out

    training = {}
    for i, g in enumerate(gaps):
        own_keys, sums = cells.cells_of(table, g)
        own = space.decoded(own_keys)
        holes = np.flatnonzero((own[:, gaps] == np.array(space.bins)[gaps]).any(1))
        training[i] = own, holes, np.searchsorted(keys, own_keys[holes]), sums[:, 1 : 1 + trees], sums[:, 1 + trees :]
    every = np.arange(len(keys))
    least = float("inf")
    for _ in range(rounds):
        before = values.copy()
        for i, g in enumerate(gaps):
            inputs = [j for j in range(len(space.columns)) if j != g]
            bins = [space.bins[j] for j in inputs]
            own, holes, at, drawn, sums = training[i]
            grower = cells.CellForest(numTrees=trees, maxDepth=depth, seed=seed)
            model = grower.fit((filled(holes, own, at)[:, inputs], bins, drawn, sums))
            hole = missing[:, i]
            values[hole, i] = start[i] + model.predict(filled(every, codes, every)[:, inputs][hole])
        moved = (n @ (values - before) ** 2).sum()
        change = moved / total if (total := (n @ values**2).sum() + observed) else 0.0
        if change >= least:
            values = before
            break
        least = change

    names = [space.columns[g] for g in gaps]

    @F.pandas_udf(", ".join(f"g{i} double" for i in range(len(gaps))))
    def of_cell(*parts: pd.Series) -> pd.DataFrame:
        at = np.searchsorted(keys, space.keys(space.codes([x.to_numpy(float) for x in parts])))
        return pd.DataFrame({f"g{i}": values[at, i] for i in range(len(gaps))})

    some = any_of(F.col(c).isNull() for c in names)
    kept = df.withColumns({c: F.col(c).cast("double") for c in names})
    new = kept.filter(some).withColumn("__new", of_cell(*[F.col(c).cast("double") for c in space.columns]))
    new = new.withColumns({c: F.coalesce(F.col(c), F.col(f"__new.g{i}")) for i, c in enumerate(names)})
    return kept.filter(~some).unionByName(new.drop("__new"))


def _filled_by_rows(
    df: DataFrame,
    gaps: list[str],
    usable: list[str],
    means: dict[str, float],
    observed: float,
    rounds: int,
    trees: int,
    depth: int,
    seed: int,
) -> DataFrame:
    """Spark ML over rows. Rows without a gap are written once; a round writes only the rows with gaps."""
    flags = {f"__gap_{c}": F.col(c).isNull() for c in gaps}
    flagged = df.withColumns(flags)
    some = any_of(F.col(f) for f in flags)
    whole = flagged.filter(~some)
    work = durable(flagged.filter(some).fillna(means), "forest-gaps")
    least = float("inf")
    for _ in range(rounds):
        before = work
        work = work.withColumns({f"__old_{c}": F.col(c) for c in gaps})
        for c in gaps:
            training = whole.unionByName(work.filter(~F.col(f"__gap_{c}")), allowMissingColumns=True)
            model = _forest(c, [x for x in usable if x != c], trees, depth, seed).fit(training)
            new = F.when(F.col(f"__gap_{c}"), F.col("__out")).otherwise(F.col(c))
            work = durable(model.transform(work).withColumn(c, new).drop("__in", "__out"), "forest-gaps")
        filled = F.lit(0.0)
        moved = F.lit(0.0)
        for c in gaps:
            moved = moved + F.sum((F.col(c) - F.col(f"__old_{c}")) ** 2)
            filled = filled + F.coalesce(F.sum(F.when(F.col(f"__gap_{c}"), F.col(c) ** 2)), F.lit(0.0))
        change = work.agg(F.try_divide(moved, filled + observed).alias("x")).first().x or 0.0
        work = work.drop(*[f"__old_{c}" for c in gaps])
        if change >= least:
            work = before
            break
        least = change
    return whole.unionByName(work).drop(*flags)


def forest_error(
    before: DataFrame,
    filled: DataFrame,
    columns: Sequence[str],
    key: Sequence[str],
    trees: int = 20,
    depth: int = 8,
    seed: int = 0,
    folds: int = 5,
) -> DataFrame:
    """Out-of-bag error of the forest of each column that had gaps.

    The forest is grown in `folds` parts. A row belongs to the bags of all parts but one, which
    a hash of its key names; that part predicts it. So every observed value is predicted once by
    trees that never saw it. Result: variable, n values, mse, and nrmse (root of the mean
    squared error over the standard deviation). `key` identifies rows of both tables.
    """
    columns = list(columns)
    known = before.select(*key, *[F.col(c).isNotNull().alias(f"__known_{c}") for c in columns])
    fold = F.pmod(F.xxhash64(F.lit(seed), *key), F.lit(folds))
    rows = null_safe_join(filled.select(*key, *columns), known, key, "inner").withColumn("__fold", fold)
    rows = durable(rows.select(*columns, *[f"__known_{c}" for c in columns], "__fold"), "forest-bags")
    counts = rows.agg(
        *[F.count_if(F.col(f"__known_{c}")).alias(c) for c in columns],
        *[F.avg(F.when(F.col(f"__known_{c}"), F.col(c))).alias(f"mean_{c}") for c in columns],
        F.count("*").alias("__n"),
    ).first()
    wanted = [c for c in columns if 0 < counts[c] < counts["__n"]]
    usable = [c for c in columns if counts[c]]
    part = -(-trees // folds)
    if wanted:
        space = cells.Space(cells.cuts_of(rows, usable), [])
        if space.most([usable.index(c) for c in wanted]) <= cells.MOST_CELLS:
            return _errors_by_cells(rows, space, {c: float(counts[f"mean_{c}"]) for c in wanted}, part, depth, seed, folds)
    errors = None
    for c in wanted:
        inputs = [x for x in usable if x != c]
        seen = rows.filter(F.col(f"__known_{c}"))
        predicted = None
        for k in range(folds):
            grower = _forest(c, inputs, part, depth, seed + k)
            out = grower.fit(seen.filter(F.col("__fold") != k)).transform(seen.filter(F.col("__fold") == k)).select(c, "__out")
            predicted = out if predicted is None else predicted.unionAll(out)
        mse = F.avg((F.col(c) - F.col("__out")) ** 2)
        one = predicted.agg(F.count("*").alias("n"), mse.alias("mse"), F.sqrt(F.try_divide(mse, F.var_pop(c))).alias("nrmse"))
        one = one.select(F.lit(c).alias("variable"), "n", "mse", "nrmse")
        errors = one if errors is None else errors.unionAll(one)
    if errors is None:
        return before.sparkSession.createDataFrame([], _ERRORS)
    return errors


_ERRORS = "variable string, n bigint, mse double, nrmse double"


def _errors_by_cells(
    rows: DataFrame, space: cells.Space, means: dict[str, float], part: int, depth: int, seed: int, folds: int
) -> DataFrame:
    """As over rows: an observed value's error follows from its cell's rows of its fold, their sum and sum of squares."""
    trees = part * folds
    labels = {space.columns.index(c): c for c in means}

    def tally(values):
        codes = space.codes([values[c] for c in space.columns])
        if any((x == b).any() for x, b in zip(codes, space.bins)):
            raise ValueError("the filled table has missing values")
        for g, c in labels.items():
            seen = values[f"__known_{c}"].astype(bool)
            keys = space.keys([(0 * x if j == g else x)[seen] for j, x in enumerate(codes)])
            off = values[c][seen] - means[c]
            inside = values["__fold"][seen][:, None] == np.arange(folds)
            drawn = cells.draws(values[cells.PLACE][seen], trees, g) * ~np.repeat(inside, part, 1)
            per_fold = [inside.T * x for x in (np.ones(len(off)), off, off**2)]
            yield g, keys, [*drawn.T.astype(float), *(drawn * off[:, None]).T, *np.concatenate(per_fold)]

    known = [f"__known_{c}" for c in means]
    read = cells.placed(rows.select(*[F.col(c).cast("double").alias(c) for c in space.columns], *known, "__fold"), seed)
    table = cells.tallied(read, [*space.columns, *known, "__fold", cells.PLACE], tally, 2 * trees + 3 * folds)
    errors = []
    for g, c in labels.items():
        keys, sums = cells.cells_of(table, g)
        inputs = [j for j in range(len(space.columns)) if j != g]
        codes, bins = space.decoded(keys)[:, inputs], [space.bins[j] for j in inputs]
        n, total, squares = np.split(sums[:, 2 * trees :], 3, 1)
        wrong = 0.0
        for k in range(folds):
            own = slice(k * part, (k + 1) * part)
            grower = cells.CellForest(numTrees=part, maxDepth=depth, seed=seed + k)
            out = grower.fit((codes, bins, sums[:, :trees][:, own], sums[:, trees : 2 * trees][:, own])).predict(codes)
            mean = np.divide(total[:, k], n[:, k], out=np.zeros(len(out)), where=n[:, k] > 0)
            within = np.maximum(squares[:, k] - mean * total[:, k], 0.0)
            wrong += float((within + n[:, k] * (out - mean) ** 2).sum())
        count = float(n.sum())
        mse, spread = wrong / count, float(squares.sum()) / count - (float(total.sum()) / count) ** 2
        errors.append((c, round(count), mse, (mse / spread) ** 0.5 if spread > 0 else None))
    return rows.sparkSession.createDataFrame(errors, _ERRORS)
