"""What several operators of this subpackage share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# The words of the contracts, as Java, Python and RE2 patterns alike. What is left out is listed one by
# one: Java looks such a class up in a table, and is several times slower over a negated class of ranges.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x20\x09\x0A\x0B\x0C\x0D]+"
ALNUM_WORD = "[^" + "".join(f"\\x{c:02X}" for c in range(0x80) if chr(c) not in "0123456789" + LOWER) + "]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def lowered(text: Column) -> Column:
    """A-Z only, as the contracts say; other letters stay. Texts of one byte a letter have no others."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def fold(key: Column, n: int) -> Column:
    """crc32 of the key as text, modulo ``n``; a null key counts as the empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % n


def text_bytes(docs: DataFrame, text_col: str = "text") -> int:
    """UTF-8 bytes of all texts: sizes the number of blocks of the Python stages."""
    return docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0


def bounded_sample(rows: DataFrame, key: Column, most: int) -> DataFrame:
    """About ``most`` rows by a hash of ``key``, for fitting a model; all of them where there are fewer."""
    n = rows.count()
    return rows if n <= most else rows.where(F.pmod(F.xxhash64(key), F.lit(n)) < most)
