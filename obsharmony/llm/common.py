"""What the corpus operators share: durable tables, words, hashes."""

from __future__ import annotations

import uuid

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from obsharmony.session import _ensure_checkpoint_dir

#: A word is a longest run of characters other than these: space, tab to carriage return.
BLANKS = " \t\n\x0b\f\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def kept(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared checkpoint folder and read it back: the lineage ends there,
    and every later branch sees the very same rows after the loss of an executor."""
    spark = df.sparkSession
    _ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stored(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """As kept, with the path, so that a table which later ones replace can go."""
    spark = df.sparkSession
    _ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def forget(spark: SparkSession, path: str) -> None:
    """Delete a table that `stored` wrote and no later result reads."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def words_of(text: Column) -> Column:
    """Words of a text as an array; none for a missing text."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")


def word_hashes(words: list[bytes]) -> np.ndarray:
    """One 64-bit hash per word, alike on every machine."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """Finalising mix of 64-bit values (public-domain constants of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def window_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of k consecutive words (of the whole sequence if it is shorter)."""
    k = min(k, len(hashes))
    if k == 0:
        return hashes
    n = len(hashes) - k + 1
    out = np.full(n, 0x9E3779B97F4A7C15, np.uint64)
    for i in range(k):
        out = mixed(out * np.uint64(0x100000001B3) + hashes[i : i + n])
    return out
