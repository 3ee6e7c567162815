"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import stage

# Word separators of the corpus contracts: space, tab and the line breaks between them.
SPACES = " \t\n\x0b\x0c\r"
WORD = "[^\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def col(name: str) -> Column:
    """A top-level column by its exact name, dots and spaces included."""
    return F.col("`" + name.replace("`", "``") + "`")


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """Names like `wanted` that clash with no column of `df`, whatever their case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name = f"{name}_"
        taken.add(name.lower())
        out.append(name)
    return out


def without(df: DataFrame, names: Sequence[str]) -> list[Column]:
    """All columns but those that an operator is about to write, whatever their case."""
    out = {n.lower() for n in names}
    return [col(c) for c in df.columns if c.lower() not in out]


def text_of(name: str) -> Column:
    """The text with null read as empty."""
    return F.coalesce(col(name).cast("string"), F.lit(""))


def file_stage(df: DataFrame, name: str, **options: str) -> DataFrame:
    """`df` written once below the shared folder, so that joins against it start from a scan."""
    return stage(df, name, **options)


def joined_digest(parts: Column) -> Column:
    """Lowercase hex SHA-256 of an array of strings joined by commas."""
    return F.sha2(F.array_join(parts, ","), 256)


def held_out(doc_id: Column) -> Column:
    """Rows kept from every fit: crc32 of the id as text leaves 2 when divided by 4.

    A null id counts as the empty text.
    """
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(4)) == 2


def run_at(array: Column, first: Column, length: int) -> list[Column]:
    """`length` elements from the 1-based place `first` on; each is read in constant time, which a
    slice inside a lambda is not."""
    return [F.get(array, first + (k - 1)) for k in range(length)]
