"""Depth profiles (casts): trimming, despiking, binning, file names to site and date."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.nulls import as_col, matches
from ..functions.numeric import round_half_even
from ..functions.text import base_name, extract, remove_all, split_part, strip_extension
from ..functions.times import calendar_date, day_of_year_date
from .joins import join_statistics
from .ordered import quantiles, with_position

# Sensors kept from a cast, in output order.
CAST_SENSORS = ["temperature", "cpar", "oxygen", "specificConductance", "pH"]

# Ordered site patterns; the first that matches the file name gives the site.
SITE_PATTERNS = [
    r"alpha|beta|omega|gh[0-9]{2,3}|midlk|sbe|c1|d1|e1",
    r"m10|m15|m20|m25|m30|m45|m110|leg_*[a-zA-Z][0-9]*",
    r"station*[abcd]1*|sta_*[abcd]1*|raw0[0-9]*",
    r"100mbuoy|ds-7|ds7",
    r"muskegon|muskla*k|muskmid|midmusk|musk|ml",
    r"m*offshor|x2|gvsubuoy|hope[0-9]*|raw|tb|temp",
]

# Month names, long before short, as they appear in folder names.
MONTHS = [
    "january", "february", "march", "april", "may", "june",
    "july", "august", "september", "october", "november", "december",
]

# Fixed values: (path piece, pattern, order) tried in turn; doy = day of year and 2-digit year.
DATE_PATTERNS = [
    (1, "[0-9]{3}-[0-9]{2}", "doy"),
    (1, "[0-9]{1,2}-[0-9]{1,2}-[0-9]{2}", "mdy"),
    (2, "[0-9]{3}-[0-9]{2}", "doy"),
    (2, "[0-9]{1,2}-[0-9]{1,2}-[0-9]{2}", "mdy"),
    (2, "[0-9]{1,2}_[0-9]{1,2}_[0-9]{2}", "mdy"),
    (2, "[0-9]{3}_[0-9]{2}", "doy"),
    (3, "[0-9]{3}-[0-9]{2}", "doy"),
    (3, "[0-9]{1,2}-[0-9]{1,2}-[0-9]{2}", "mdy"),
    (3, "[0-9]{2,3}_[0-9]{2}", "doy"),
    (4, "[0-9]{2,3}-[0-9]{2}", "doy"),
    (4, "[0-9]{1,2}_[0-9]{1,2}_[0-9]{2}", "mdy"),
    (4, "^[0-9]{1,2}-[0-9]{1,2}-[0-9]{2}$", "mdy"),
    (4, "[0-9]{2,3}_[0-9]{2}", "doy"),
]

# Fixed value: spelling of the fourth and third piece joined, tried last.
LAST_RESORT = r"^[0-9]{1,2}[-_][0-9]{1,2}-[0-9]{2}$"

_CHUNK = 4096


def _frame_median(c: str, frame) -> Column:
    """Median of the few values in a sliding frame; NULL values do not count."""
    values = F.sort_array(F.collect_list(c).over(frame))
    n = F.size(values)
    low = F.get(values, F.floor((n - 1) / F.lit(2)).cast("int"))
    return (low + F.get(values, F.floor(n / F.lit(2)).cast("int"))) / F.lit(2.0)


def downcast(df: DataFrame, cast: Sequence[str], scan: str, depth: str) -> DataFrame:
    """Scans up to the first one at the greatest depth."""
    turn = df.groupBy(*cast).agg(
        F.min_by(scan, F.struct(-F.col(depth), F.col(scan))).alias("__turn")
    )
    return (
        join_statistics(df, turn, list(cast))
        .filter(F.col(scan) <= F.col("__turn"))
        .drop("__turn")
    )


def despike(
    df: DataFrame,
    cast: Sequence[str],
    scan: str,
    columns: Sequence[str],
    half_width: int = 3,
    spread: float = 4.0,
) -> DataFrame:
    """Replace values far from their running median by that median.

    Far means more than `spread` standard deviations of the difference over the
    whole cast. Long casts are worked in chunks that overlap by the half width,
    so one cast may be of any length.
    """
    by = list(cast)
    placed = with_position(df, by, scan, "__pos")
    chunk = F.floor(F.col("__pos") / F.lit(_CHUNK))
    within = F.col("__pos") % F.lit(_CHUNK)
    touched = F.array_compact(
        F.array(
            chunk,
            F.when((within < half_width) & (chunk > 0), chunk - 1),
            F.when(within >= _CHUNK - half_width, chunk + 1),
        )
    )
    frame = (
        W.partitionBy(*by, "__chunk").orderBy("__pos").rowsBetween(-half_width, half_width)
    )
    medians = (
        placed.withColumn("__chunk", F.explode(touched))
        .withColumns({f"__ref_{c}": _frame_median(c, frame) for c in columns})
        .filter(F.col("__chunk") == chunk)
        .drop("__chunk", "__pos")
    )
    spreads = medians.groupBy(*by).agg(
        *[F.stddev_samp(F.col(c) - F.col(f"__ref_{c}")).alias(f"__sd_{c}") for c in columns]
    )
    out = join_statistics(medians, spreads, by)
    return out.select(
        *[
            (
                F.when(
                    F.abs(F.col(c) - F.col(f"__ref_{c}")) > F.lit(float(spread)) * F.col(f"__sd_{c}"),
                    F.col(f"__ref_{c}"),
                )
                .otherwise(F.col(c))
                .alias(c)
                if c in columns
                else F.col(c)
            )
            for c in df.columns
        ]
    )


def metre_bins(
    df: DataFrame, cast: Sequence[str], depth: str, columns: Sequence[str], start: float = 0.5
) -> DataFrame:
    """Mean per 1 m bin from `start`, labelled by the whole metre in its middle."""
    label = F.floor(F.col(depth) - F.lit(start)) + 1
    return (
        df.filter(F.col(depth) >= start)
        .groupBy(*cast, label.cast("double").alias(depth))
        .agg(*[F.avg(c).alias(c) for c in columns])
    )


def whole_metre_bins(
    df: DataFrame, cast: Sequence[str], depth: str, value: str, time: str
) -> DataFrame:
    """Mean value and first time per depth rounded half to even; the surface bin is dropped."""
    return (
        df.withColumn(depth, round_half_even(F.col(depth)))
        .filter(F.col(depth) != 0)
        .groupBy(*cast, depth)
        .agg(F.avg(value).alias(value), F.min(time).alias(time))
    )


def usable_scans(df: DataFrame, depth: str, surface: float = 0.1) -> DataFrame:
    """Scans below the surface."""
    return df.filter(F.col(depth) > surface)


def path_site(path: Column | str) -> Column:
    """Site from a cast file name by ordered patterns, NULL when none matches."""
    name = F.lower(base_name(path))
    name = remove_all(remove_all(name, ".cnv|.bin"), r"\s")
    found = _once(name, lambda n: F.array(*[F.regexp_extract(n, p, 0) for p in SITE_PATTERNS]))
    return F.get(F.filter(found, lambda x: x != ""), F.lit(0))


def _months_to_numbers(text: Column) -> Column:
    names = [(m, i) for group in (MONTHS, [m[:3] for m in MONTHS]) for i, m in enumerate(group, start=1)]
    table = F.array(*[F.struct(F.lit(m).alias("name"), F.lit(f"-{i:02d}-").alias("number")) for m, i in names])
    return F.aggregate(table, text, lambda t, m: F.replace(t, m["name"], m["number"]))


def _date_piece(piece: Column) -> Column:
    """Path piece with months as numbers and name parts removed; NULL without any digit."""
    text = _months_to_numbers(F.lower(piece))
    for noise in ("[a-zA-Z]+_+", "_+[a-zA-Z]+", r"\s", "m[0-9]+_"):
        text = remove_all(text, noise)
    # No date pattern can match a piece that had no digit, and most pieces have none.
    return F.when(piece.rlike("[0-9]"), text)


def _once(value: Column, use) -> Column:
    """use(value), with the value worked out once however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _date_of(hit: Column, by_day: Column) -> Column:
    """Date of a hit: day of year and year, or month, day and year; years have two digits."""

    def dated(parts: Column) -> Column:
        first, second, year = (F.get(parts, F.lit(i)) for i in range(3))
        return F.when(by_day, day_of_year_date(first, second)).otherwise(calendar_date(year, first, second))

    return _once(F.split(hit, "[-_]"), dated)


def path_date(path: Column | str) -> Column:
    """Date from the folders and name of a cast file, by the first pattern that gives a real date.

    The patterns are a table that one expression walks until a date is found, so each
    piece is tidied once and each order has one parser."""
    last = strip_extension(split_part(path, "/", -1))
    raw = F.array(split_part(path, "/", 2), last, split_part(path, "/", 3), split_part(path, "/", 4))
    rows = [*DATE_PATTERNS, (5, LAST_RESORT, "mdy")]
    table = F.array(
        *[F.struct(F.lit(p).alias("piece"), F.lit(x).alias("pattern"), F.lit(o == "doy").alias("by_day")) for p, x, o in rows]
    )

    def walked(pieces: Column) -> Column:
        def digits(i: int) -> Column:
            return remove_all(remove_all(F.get(pieces, F.lit(i)), "[a-zA-Z]"), "-$")

        joined = F.concat(digits(3), F.lit("-"), digits(2))

        def step(found: Column, row: Column) -> Column:
            text = F.when(row["piece"] == 5, joined).otherwise(F.get(pieces, row["piece"] - 1))
            # A call by name, as the function's Python form takes no pattern out of a column of a lambda.
            hit = F.call_function("regexp_substr", text, row["pattern"])
            return F.coalesce(found, _date_of(hit, row["by_day"]))

        return F.aggregate(table, F.lit(None).cast("date"), step)

    return _once(F.transform(raw, _date_piece), walked)


def with_path_date(df: DataFrame, path: str, name: str = "sampleDate") -> DataFrame:
    """The rows with the date that path_date finds in their path."""
    return df.withColumn(name, path_date(path))


def prefer_instrument(df: DataFrame, suffix: str = "_ctd") -> DataFrame:
    """Instrument metadata wins over metadata from the file path; instrument columns go."""
    own = [c for c in df.columns if c.endswith(suffix)]
    return df.withColumns(
        {c.removesuffix(suffix): F.coalesce(F.col(c), F.col(c.removesuffix(suffix))) for c in own}
    ).drop(*own)


# Number words in depth codes, and codes merged into layers.
DEPTH_WORDS = [
    ("five", "5"), ("ten", "10"), ("twenty", "20"), ("thirty", "30"), ("forty", "40"),
    ("fifty", "50"), ("one hundred", "100"), ("two hundred", "200"),
]
LAYERS = {
    "Epilimnion": ["Surface", "Mid Epilimnion", "Lower Epilimnion"],
    "Hypolimnion": ["Mid Hypolimnion", "Upper Hypolimnion"],
}


def depth_words_to_numbers(code: Column | str) -> Column:
    """Depth code with a number word becomes the number, as text; first word listed wins."""
    code = as_col(code)
    words = F.array(*[F.struct(F.lit(w).alias("word"), F.lit(n).alias("number")) for w, n in DEPTH_WORDS])
    said = F.filter(words, lambda w: F.contains(F.lower(code), w["word"]))
    return F.coalesce(F.get(said, F.lit(0))["number"], code)


def named_layers(df: DataFrame, code: str) -> DataFrame:
    """Only depth codes that name a layer (no number, no bottom), plus the simpler layer."""
    named = ~matches(code, r"^\s*\d+(\.\d*)?\s*$|^\.$|^Not Applicable$|(?i:bottom)")
    df = df.withColumn(code, depth_words_to_numbers(code)).filter(F.col(code).isNotNull() & named)
    simpler = F.create_map(*[F.lit(x) for name, codes in LAYERS.items() for c in codes for x in (c, name)])
    return df.withColumn("layer", F.coalesce(simpler[F.col(code)], F.col(code)))


def depth_bands(df: DataFrame, code: str, depth: str, probs: dict[str, float] | None = None) -> DataFrame:
    """Depth quantiles per code; order by the median for the natural code order."""
    probs = probs or {"minimum": 0.0, "p025": 0.025, "p50": 0.5, "p975": 0.975, "maximum": 1.0}
    return quantiles(df.filter(F.col(code).isNotNull()), [code], depth, probs)
