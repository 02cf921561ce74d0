"""Text and array expressions with Python's string semantics, all native."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What Python's str.strip() removes, and the line ends of str.splitlines() beside \r\n (fixed by Python).
PY_SPACE = "".join(map(chr, [*range(9, 14), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
_LINE_END = r"\r\n|[\n\x0b\x0c\r\x1c-\x1e\x85\x{2028}\x{2029}]"


def let(value: Column, body) -> Column:
    """body(value) with value computed once a row: the optimizer would copy a plain column into every use, and copies of copies grow without bound."""
    return F.transform(F.array(value), body)[0]


def py_strip(text: Column) -> Column:
    return F.btrim(text, F.lit(PY_SPACE))


def normalized_code(text: Column) -> Column:
    """Stripped, one kind of line end, no white space at line ends. Linear in the text."""

    def lines(stripped: Column) -> Column:
        return F.array_join(F.transform(F.split(stripped, _LINE_END), lambda line: F.rtrim(line, F.lit(PY_SPACE))), "\n")

    return let(py_strip(text), lines)


def stable_hash(text: Column) -> Column:
    """SHA-256 of the normalized text: copies that differ in outer or trailing white space have one hash."""
    return F.sha2(normalized_code(text), 256)


def split_identifier(value: Column) -> Column:
    """CamelCase and snake_case as lower-case words; runs of capitals stay together."""
    spaced = F.regexp_replace(F.replace(value, F.lit("_"), F.lit(" ")), r"(?<=[\p{Ll}\p{Nd}])(?=\p{Lu})", " ")
    return F.lower(F.trim(F.regexp_replace(spaced, r"\s+", " ")))


def readable_join(values: Column) -> Column:
    """a; a and b; a, b, and c."""

    def joined(v: Column) -> Column:
        n = F.size(v)
        longer = F.concat(F.array_join(F.slice(v, F.lit(1), F.greatest(n - 1, F.lit(0))), ", "), F.lit(", and "), F.element_at(v, -1))
        return F.when(n <= 0, "").when(n == 1, F.get(v, F.lit(0))).when(n == 2, F.array_join(v, " and ")).otherwise(longer)

    return let(values, joined)


def ordered_unique(values: Column) -> Column:
    """Distinct values in first-seen order, without nulls and empty strings."""
    return F.array_distinct(F.filter(values, lambda v: v.isNotNull() & (v != "")))


def build_code(*parts: Column) -> Column:
    """Non-blank parts, stripped, with an empty line between them and a line end after the last."""
    kept = F.filter(F.transform(F.array(*parts), py_strip), lambda p: p.isNotNull() & (p != ""))
    return F.concat(F.array_join(kept, "\n\n"), F.lit("\n"))
