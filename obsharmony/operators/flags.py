"""Limit flags, flag unification by a regex table, censoring."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.nulls import any_of, blank_to_null, matches, na_text
from ..functions.text import remove_all, replace_first
from ..session import durable
from .joins import null_safe_join

# Fixed value: stands for "no code" or "no comment" on both sides of the flag join.
NO_TEXT = "XXXX"

# The columns a flag-table row contributes.
FLAG_FIELDS = ["Definition", "Unified_Flag", "Unified_Comment", "Retain", "Action"]

# Longest pieces of text that are indexed.
_GRAM = 3


def limit_flags(df: DataFrame) -> DataFrame:
    """Append limit labels to QAcode and QAcomment, clamp negative light, flag light over 100 %.

    Labels, in this order: 'MDL' below the detection limit, 'RL' below the
    reporting limit, 'Estimated' between them inclusive, then light over the
    surface value. An unknown limit gives no label; without labels the texts
    stay, except that the text 'NA' becomes NULL.
    """
    result, mdl, rl = F.col("RESULT"), F.col("MDL"), F.col("RL")
    light = F.col("CodeName") == "CPAR"
    over = light & (result > 100)
    limits = [
        (result < mdl, "MDL"),
        (result < rl, "RL"),
        ((result >= mdl) & (result <= rl), "Estimated"),
    ]

    def labelled(column: str, light_label: str) -> Column:
        labels = [*limits, (over, light_label)]
        some = any_of([F.coalesce(c, F.lit(False)) for c, _ in labels])
        text = F.concat_ws("; ", na_text(column), *[F.when(c, F.lit(x)) for c, x in labels])
        return F.when(some, text).otherwise(F.nullif(F.col(column), F.lit("NA")))

    return df.withColumns(
        {
            "QAcode": labelled("QAcode", "PAR"),
            "QAcomment": labelled("QAcomment", "Underwater PAR exceeds surface PAR"),
            "RESULT": F.when(light & (result < 0), F.lit(0.0)).otherwise(result),
        }
    )


def _cleaned(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "QAcode": remove_all(F.regexp_replace("QAcode", ",", ";"), "^NA; "),
            "QAcomment": remove_all("QAcomment", "^NA; "),
        }
    )


def _with_placeholder(text: Column, sep: str) -> Column:
    return F.coalesce(F.concat(text, F.lit(sep + NO_TEXT)), F.lit(NO_TEXT))


def prepare_flag_table(flags: DataFrame) -> DataFrame:
    """Flag table rows made distinct and total; `flag_row` keeps the table order."""
    named = flags.select(
        F.col("Study").alias("__study"),
        F.coalesce("QAcode", F.lit(NO_TEXT)).alias("__code"),
        F.coalesce("QAcomment", F.lit(NO_TEXT)).alias("__comment"),
        *FLAG_FIELDS,
        "flag_row",
    )
    keys = [c for c in named.columns if c != "flag_row"]
    return named.groupBy(*keys).agg(F.min("flag_row").alias("flag_row"))


def required_grams(regex: Column) -> Column:
    """Pieces of up to three characters that any match of a regex holds; none if that is not plain.

    Letters, digits and the like stand for themselves; classes, groups, escapes, anchors and
    what a quantifier makes optional are cut out. Alternatives, inline modes and escapes that
    take an argument leave nothing."""
    gap = "\u0001"
    plain = F.regexp_replace(regex, r"\\.", gap)
    plain = F.regexp_replace(plain, r"\[.*\]|\(.*\)", gap)
    plain = F.regexp_replace(plain, r".(?:[?*]|\{[^}]*\})", gap)
    plain = F.regexp_replace(plain, r"[.^$+?*(){}\[\]]", gap)
    vague = regex.rlike(r"\[.*\(|\(.*\[|\||\(\?|\\[^dDsSwWbB\W_]|\\[0-9]|\[[^\]]*\[") | regex.isNull()
    pieces = F.filter(F.split(plain, gap), lambda x: x != "")
    return F.when(vague, F.array().cast("array<string>")).otherwise(
        F.array_distinct(F.flatten(F.transform(pieces, lambda x: _grams(x, F.least(F.length(x), F.lit(_GRAM))))))
    )


def _grams(text: Column, size: Column) -> Column:
    """All pieces of a text of one size (none of an empty text)."""
    starts = F.when(F.length(text) >= size, F.sequence(F.lit(1), F.length(text) - size + 1))
    return F.coalesce(F.transform(starts, lambda i: F.substr(text, i, size)), F.array().cast("array<string>"))


def _tagged(grams: Column, side: str) -> Column:
    return F.transform(grams, lambda g: F.concat(F.lit(side), g))


def _indexed(texts: DataFrame) -> DataFrame:
    """Each text under every piece of one to three characters of its code (c) and comment (m)."""
    sizes = range(1, _GRAM + 1)
    pieces = [
        _tagged(F.array_distinct(F.flatten(F.array(*[_grams(F.col(t), F.lit(n)) for n in sizes]))), side)
        for side, t in (("c", "__c"), ("m", "__m"))
    ]
    pieces = F.flatten(F.array(*pieces))
    # The bare side name is a piece of every text, for flags that require nothing.
    return texts.withColumn("__gram", F.explode(F.array_append(pieces, F.lit("c"))))


def match_vocabulary(vocabulary: DataFrame, flags: DataFrame) -> DataFrame:
    """Regex left join of distinct (study, code, comment) texts with the flag table.

    Both regexes of a flag require pieces of text. Each flag stands in an inverted index under
    the rarest of them in its study, so a text meets only flags whose rarest piece it holds, by an
    equi-join; the regexes decide. A flag whose piece no text holds meets none.
    """
    texts = vocabulary.withColumns(
        {
            "__c": _with_placeholder(blank_to_null(remove_all("QAcode", r"\s")), ";"),
            "__m": _with_placeholder(blank_to_null(remove_all("QAcomment", "^; ")), "; "),
        }
    )
    texts = durable(texts, "texts")
    index = _indexed(texts)
    spread = index.groupBy("Study", "__gram").agg(F.count("*").alias("__n"))
    required = [_tagged(required_grams(F.col(r)), side) for side, r in (("c", "__code"), ("m", "__comment"))]
    required = F.flatten(F.array(*required))
    pieces = flags.withColumn("__need", F.explode(F.array_append(required, F.lit("c"))))
    held = pieces.join(
        spread.withColumnRenamed("Study", "__in"), (F.col("__study") == F.col("__in")) & (F.col("__need") == F.col("__gram")), "left"
    )
    rarest = held.groupBy(*flags.columns).agg(
        F.min(F.struct(F.coalesce("__n", F.lit(0)).alias("n"), F.col("__need").alias("piece"))).alias("__rare")
    )
    under = rarest.filter(F.col("__rare.n") > 0).withColumn("__piece", F.col("__rare.piece")).drop("__rare")
    met = index.join(under, (F.col("Study") == F.col("__study")) & (F.col("__gram") == F.col("__piece"))).filter(
        F.expr("__c RLIKE __code AND __m RLIKE __comment")
    )
    keys = ["Study", "QAcode", "QAcomment"]
    return null_safe_join(texts.select(*keys), met.select(*keys, *FLAG_FIELDS, "flag_row"), keys)


def _joined(field: str) -> Column:
    """Distinct values of one field over the matched flag rows, in flag-table order."""
    matched = F.sort_array(F.collect_list(F.struct("flag_row", *FLAG_FIELDS)))
    texts = F.transform(matched, lambda m: F.coalesce(m[field], F.lit("NA")))
    return F.array_join(F.array_distinct(texts), ", ")


def _without_na(c: str) -> Column:
    known = F.nullif(F.col(c), F.lit("NA"))
    return remove_all(remove_all(known, "NA, "), ", NA")


def match_flags(df: DataFrame, flags: DataFrame) -> DataFrame:
    """Add the unified flag fields to every row and drop rows marked for removal.

    Flag codes and comments are regexes tested by containment. The regexes run
    once per distinct text, in a first pass that reads only the text columns; a
    text's matches are merged in flag-table order and written, so the optimizer knows
    their size when it joins them to the rows. Rows without a text have no match; a number
    of their own keeps a shuffle from gathering them.
    """
    keys = ["Study", "QAcode", "QAcomment"]
    df = _cleaned(df)
    texts = df.filter(~no_flag()).select(*keys).distinct()
    matched = match_vocabulary(texts, prepare_flag_table(flags))
    merged = durable(
        matched.groupBy(*keys)
        .agg(*[_joined(f).alias(f) for f in FLAG_FIELDS])
        .withColumns({c: _without_na(c) for c in ("Unified_Flag", "Unified_Comment")})
        .withColumn("__drop", matches("Retain", "remove", ignore_case=True))
        .withColumn("__part", F.lit(0)),
        "flags",
    )
    numbers = [c for c, t in df.dtypes if t in ("double", "bigint", "int")]
    part = F.when(no_flag(), F.pmod(F.xxhash64(*numbers), F.lit(1 << 20)).cast("int") + 1).otherwise(F.lit(0))
    out = null_safe_join(df.withColumn("__part", part), merged, [*keys, "__part"])
    return out.filter(~F.coalesce("__drop", F.lit(False))).drop("__drop", "__part")


def no_flag() -> Column:
    return F.col("QAcode").isNull() & F.col("QAcomment").isNull()


def unify_flags(df: DataFrame, flags: DataFrame) -> DataFrame:
    """Matched flags, with rows that carry a code or comment kept once.

    Rows without either keep their number of repeats.
    """
    out = match_flags(df, flags)
    counted = out.groupBy(*out.columns).agg(F.count("*").alias("__n"))
    repeats = F.when(no_flag(), F.col("__n")).otherwise(F.lit(1))
    return counted.withColumn(
        "__i", F.explode(F.sequence(F.lit(1).cast("bigint"), repeats))
    ).drop("__n", "__i")


def censor(result: Column | str = "RESULT", flag: Column | str = "Unified_Flag") -> Column:
    """Result after the unified flag, first rule wins: N hides, E keeps, R and B hide."""
    result = F.col(result) if isinstance(result, str) else result
    flag = F.col(flag) if isinstance(flag, str) else flag
    hidden = F.lit(None).cast("double")
    return (
        F.when(flag.isNull(), result)
        .when(flag.contains("N"), hidden)
        .when(flag.contains("E"), result)
        .when(flag.contains("R"), hidden)
        .when(flag.contains("B"), hidden)
        .otherwise(result)
    )


def clean_qa_text(df: DataFrame) -> DataFrame:
    """Tidy codes and comments of one survey: separators, trailing ';', 'NA' pieces, blanks."""
    code = replace_first("QAcode", ",", ";")
    code = remove_all(replace_first(code, ";$"), "NA;")
    code = remove_all(F.regexp_replace(code, ";", ","), " ")
    comment = remove_all(remove_all(replace_first("QAcomment", ";$"), "NA;"), ": ")
    return df.withColumns(
        {"QAcode": F.nullif(code, F.lit("NA")), "QAcomment": blank_to_null(comment)}
    )


def flag_vocabulary(df: DataFrame) -> DataFrame:
    """Distinct single codes and comments per study, split out of the joined texts."""
    pieces = (
        df.select("Study", "QAcode", "QAcomment")
        .distinct()
        .withColumn("QAcode", F.explode_outer(F.split("QAcode", "[;,]")))
        .withColumn("QAcomment", F.explode_outer(F.split("QAcomment", ";")))
        .distinct()
    )
    code = F.trim(remove_all("QAcode", "NA,"))
    comment = F.trim(remove_all(remove_all("QAcomment", "NA,"), ",? NA"))
    na_start = "(?i)^NA"
    pieces = pieces.withColumns(
        {
            "QAcode": F.when(~code.rlike(na_start), code),
            "QAcomment": F.when(~comment.rlike(na_start), comment),
        }
    ).filter(F.col("QAcode").isNotNull() | F.col("QAcomment").isNotNull())
    no_units = F.col("QAcode").isNull() & matches("QAcomment", "no reported units", True)
    pieces = pieces.withColumn("QAcode", F.when(no_units, F.lit("U")).otherwise(F.col("QAcode")))
    assumed = (F.col("QAcode") == "U") & F.col("QAcomment").isNull()
    return pieces.withColumn(
        "QAcomment",
        F.when(
            assumed,
            F.lit("No reported units, so assumed most common units for this given analyte-year"),
        ).otherwise(F.col("QAcomment")),
    ).distinct()
