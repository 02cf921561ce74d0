"""Chat rows: first message of a role, training text, checks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import py_strip


def first_of(messages: Column, role: str) -> Column:
    """Content of the first message of a role, or null."""
    return F.get(F.filter(messages, lambda m: m["role"] == role), F.lit(0))["content"]


def pair(user: Column, assistant: Column) -> Column:
    return F.array(
        F.struct(F.lit("user").alias("role"), user.alias("content")),
        F.struct(F.lit("assistant").alias("role"), assistant.alias("content")),
    )


def training_text(user: Column, assistant: Column) -> Column:
    return F.concat(F.lit("### Instruction:\n"), user, F.lit("\n\n### Response:\n"), assistant)


def filled(text: Column) -> Column:
    """Neither null nor blank."""
    return F.coalesce(py_strip(text) != "", F.lit(False))
