"""Shared helpers: table reading, and the contracts' exact text rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType

from ..functions.text import let
from ..sources.shared import arrow_batches, scratch, written

#: Word separators of every contract: space and \t \n \v \f \r.
SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"

__all__ = ["SPACES", "WORD", "arrow_batches", "ascii_lower", "let", "lower_words", "row_type", "scratch", "spread_join", "table", "text_or_empty", "word_count", "words", "written"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def row_type(**fields: str | DataType) -> StructType:
    """A row's type from names and types; a column's own type is taken as it is, since fields inside it may have any name."""
    return StructType([StructField(name, StructType.fromDDL(f"x {kind}")[0].dataType if isinstance(kind, str) else kind) for name, kind in fields.items()])


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z alone, as the contracts ask; lower() would touch other scripts. It is many times faster where there are none."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


def lower_words(text: Column) -> Column:
    """The contract's words of a text, A-Z lower-cased: whole texts of ASCII at once, others word by word."""
    own = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    return F.when(F.octet_length(text) == F.char_length(text), F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))).otherwise(F.transform(own, ascii_lower))


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def words(text: str) -> list[bytes]:
    """The contract's words of a text, A-Z lower-cased: bytes.lower() and bytes.split() know ASCII alone."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def spread_join(left: DataFrame, right: DataFrame, on: list[str], by: Column, how: str = "inner", parts: int = 16) -> DataFrame:
    """Join on columns of which one value may hold many of the left rows: these are dealt to so many parts by the hash of `by`, and the right ones stand in each."""
    dealt = left.withColumn("__part", F.pmod(F.xxhash64(by), F.lit(parts)).cast("int"))
    return dealt.join(right.withColumn("__part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))), [*on, "__part"], how).drop("__part")
