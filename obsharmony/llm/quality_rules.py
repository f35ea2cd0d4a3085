"""Host-level quality rules: failures by host, shrunk by an empirical beta prior.

DataFrame functions only. Each text is measured once, inside its row; hosts are
counted by partial aggregates; verdicts go back by a join whose host key is salted,
so a host that holds a third of all rows is spread over SALTS keys.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, words_of
from .common import kept as durable

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
SYMBOLS = "#*$%&|<>"
SALTS = 64


@dataclass(frozen=True)
class Rules:
    """Limits of one document's rules, and the shrunk failure rate at which a host is rejected."""

    min_words: int = 50
    repeat_percent: int = 50
    symbol_percent: int = 20
    dup_line_percent: int = 30
    host_rate: float = 0.5
    max_strength: float = 1e6


def _count(text, characters: str):
    """How many of the given one-byte characters a text holds."""
    return F.octet_length(F.regexp_replace(text, f"[^{characters}]+", ""))


def measure(docs: DataFrame, rules: Rules = Rules(), text: str = "text") -> DataFrame:
    """Every row with the measures of its whole text, base_failed and rule_failed.

    A missing or empty text has no words, so base_failed holds. Columns of the input whose
    names clash with the measures are replaced by them. Repeated windows are found by one
    sort per text of (window hash, position) packed into a long; neighbours with equal hashes
    are compared word by word. Write the result (common.kept) before filtering on a measure:
    a filter pushed below these projections would compute their arrays again for each word.
    """
    out = docs.drop(*MEASURES, "n_lines", "base_failed", "rule_failed")
    t = F.coalesce(F.col(text), F.lit(""))
    out = out.withColumns(
        {
            "__words": words_of(F.col(text)),
            "__lines": F.filter(F.split(t, "\n"), lambda x: F.ltrim(x, F.lit(BLANKS)) != ""),
            "word_chars": (F.length(t) - _count(t, "\\x20\\x09-\\x0D")).cast("long"),
            "n_symbols": _count(t, SYMBOLS).cast("long"),
        }
    )
    out = out.withColumns(
        {
            "n_words": F.size("__words").cast("long"),
            "n_lines": F.size("__lines").cast("long"),
            "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
            "__bits": F.length(F.bin(F.size("__words").cast("long"))),
        }
    )
    out = out.withColumn(
        "__grams",
        F.expr(
            "transform(slice(__words, 1, greatest(size(__words) - 2, 0)), "
            "(x, i) -> xxhash64(x, __words[i + 1], __words[i + 2]))"
        ),
    )
    # Most texts repeat no window; only the others are sorted.
    packed = F.expr(
        "if(size(array_distinct(__grams)) < size(__grams), "
        "sort_array(transform(__grams, (x, i) -> shiftleft(x, __bits) | cast(i as bigint))), cast(array() as array<bigint>))"
    )
    out = out.withColumn("__packed", packed).withColumn("__mask", F.expr("shiftleft(1L, __bits) - 1L"))

    def same(other: str) -> str:
        where = [f"cast({x} & __mask as int)" for x in ("x", other)]
        alike = " AND ".join(f"__words[{where[0]} + {k}] = __words[{where[1]} + {k}]" for k in range(3))
        return f"(shiftrightunsigned(x, __bits) = shiftrightunsigned({other}, __bits) AND {alike})"

    repeats = F.expr(
        "sort_array(transform(filter(__packed, (x, i) -> "
        f"(i > 0 AND {same('__packed[i - 1]')}) OR (i + 1 < size(__packed) AND {same('__packed[i + 1]')})), "
        "x -> x & __mask))"
    )
    covered = "aggregate(transform(__repeats, (x, i) -> least(3L, x - if(i = 0, x - 3L, __repeats[i - 1]))), 0L, (a, x) -> a + x)"
    out = out.withColumn("__repeats", repeats).withColumn("n_repeat_words", F.expr(covered))
    base = (F.col("n_words") < rules.min_words) | (100 * F.col("n_repeat_words") > rules.repeat_percent * F.col("n_words"))
    symbols = 100 * F.col("n_symbols") > rules.symbol_percent * F.col("word_chars")
    lines = 100 * F.col("n_dup_lines") > rules.dup_line_percent * F.col("n_lines")
    out = out.withColumns({"base_failed": base, "rule_failed": base | symbols | lines})
    return out.drop("__words", "__lines", "__bits", "__grams", "__packed", "__mask", "__repeats")


def host_verdicts(measured: DataFrame, rules: Rules = Rules(), host: str = "source") -> DataFrame:
    """One row per host: documents, failures, shrunk failure rate, host_rejected.

    The beta prior comes from the hosts by the method of moments: its mean is the share of
    failing documents, its strength follows from the spread of the hosts' rates beyond what
    counting alone explains. Rows without a host take no part.
    """
    hosts = (
        measured.where(F.col(host).isNotNull())
        .groupBy(F.col(host).alias("__host"))
        .agg(F.count("*").alias("documents"), F.sum(F.col("rule_failed").cast("long")).alias("failures"))
    )
    total = hosts.agg(
        F.count("*").alias("hosts"),
        F.sum("documents").alias("n"),
        F.sum("failures").alias("f"),
        F.sum(F.col("failures") * F.col("failures") / F.col("documents")).alias("ff"),
    ).first()
    alpha, beta = prior(total.hosts, total.n or 0, total.f or 0, total.ff or 0.0, rules.max_strength)
    rate = (F.col("failures") + F.lit(alpha)) / (F.col("documents") + F.lit(alpha + beta))
    return hosts.withColumn("rate", rate).withColumn("host_rejected", F.col("rate") >= rules.host_rate)


def prior(hosts: int, n: int, f: int, ff: float, most: float) -> tuple[float, float]:
    """alpha and beta of the prior from sums over hosts; ff sums failures squared by documents."""
    if n == 0:
        return 0.5, 0.5
    mean = f / n
    noise = mean * (1 - mean)
    # Weighted spread of the rates; (hosts - 1) parts of it are noise of counting.
    spread = (ff - n * mean * mean - (hosts - 1) * noise) / max(n - 1, 1)
    strength = most if spread <= 0 or noise == 0 else min(max(noise / spread - 1, 1.0), most)
    return mean * strength, (1 - mean) * strength


def with_verdicts(measured: DataFrame, rules: Rules = Rules(), host: str = "source") -> DataFrame:
    """Every measured row with host_rejected and kept.

    kept is false for base_failed and for every document of a rejected host; a row without a
    host is judged by its own rules alone. Repeated rows are judged each for itself.
    """
    verdicts = (
        host_verdicts(measured, rules, host)
        .where("host_rejected")
        .select("__host", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("__salt"), F.lit(True).alias("__rejected"))
    )
    rows = measured.drop("host_rejected", "kept").withColumns(
        {"__host": F.col(host), "__salt": F.pmod(F.xxhash64(F.lit(7), *_spread(measured)), F.lit(SALTS)).cast("int")}
    )
    out = rows.join(verdicts, ["__host", "__salt"], "left")
    out = out.withColumn("host_rejected", F.coalesce("__rejected", F.lit(False)))
    return out.withColumn("kept", ~F.col("base_failed") & ~F.col("host_rejected")).drop("__host", "__salt", "__rejected")


def _spread(df: DataFrame) -> list:
    return [F.col(c) for c in ("doc_id", "n_words", "word_chars", "n_symbols") if c in df.columns]


def quality_filter(docs: DataFrame, rules: Rules = Rules(), host: str = "source") -> DataFrame:
    """The documents that are kept, with their own columns."""
    columns = docs.columns
    measured = durable(measure(docs, rules), "quality")
    return with_verdicts(measured, rules, host).where("kept").select(*columns)
