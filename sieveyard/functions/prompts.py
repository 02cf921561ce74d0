"""Prompt texts as expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import let, ordered_unique, readable_join, split_identifier

# Wording by category, and the templates in order.
PRIMARY = {"graphs": "Visualize ", "geometry": "Create ", "text": "Show "}
PRIMARY_ELSE = "Create a Manim animation showing "
SUBJECTS = {"math": "mathematical expressions", "physics": "a physics concept", "3d": "a 3D visualization"}
TEMPLATES = ("Create a Manim scene showing {}", "Write Manim code for {}", "Animate {}", "Build a concise Manim animation showing {}")


def description(category: Column, objects: Column, animations: Column, name: Column) -> Column:
    """What a unit shows: by category, else its first objects, else its first animations, else its name."""
    parts = F.struct(
        category.alias("category"), F.lower(readable_join(F.slice(objects, 1, 3))).alias("named"), readable_join(F.slice(animations, 1, 2)).alias("moves"),
        (F.array_contains(objects, "Axes") | F.array_contains(objects, "NumberPlane")).alias("axes"), split_identifier(name).alias("name"),
    )

    def worded(s: Column) -> Column:
        named, moves = s["named"], s["moves"]
        subject = F.when(s["category"] == "graphs", F.when(s["axes"], "a graph with axes").otherwise("a mathematical graph"))
        subject = subject.when(s["category"] == "geometry", F.when(named != "", F.concat(F.lit("a "), named, F.lit(" scene"))).otherwise("a geometric scene"))
        for key, text in SUBJECTS.items():
            subject = subject.when(s["category"] == key, text)
        subject = subject.when(named != "", named)
        moved = let(subject, lambda x: F.when(moves != "", F.concat(x, F.lit(" using "), moves)).otherwise(x))
        return F.coalesce(moved, F.when(moves != "", F.concat(F.lit("uses "), moves)), F.concat(F.lit("illustrates "), s["name"]))

    return let(parts, worded)


def primary_prompt(category: Column, text: Column) -> Column:
    out = F.lit(PRIMARY_ELSE)
    for key, start in PRIMARY.items():
        out = F.when(category == key, start).otherwise(out)
    return F.concat(out, text)


def prompts(category: Column, text: Column, key: Column, count: int, seed: int) -> Column:
    """The primary prompt and `count` templates, distinct, in order.

    Templates are drawn by the order of SHA-256 of seed, key and template: each unit draws alike in
    whatever order and on whatever machine units come.
    """
    take = min(max(count, 0), len(TEMPLATES))

    def worded(s: Column) -> Column:
        first = F.array(primary_prompt(s["category"], s["text"]))
        if not take:
            return first
        drawn = F.array_sort(F.array(*[F.struct(F.sha2(F.concat_ws("|", F.lit(str(seed)), s["key"], F.lit(t)), 256).alias("h"), F.lit(i).alias("i")) for i, t in enumerate(TEMPLATES)]))
        filled = F.array(*[F.concat(F.lit(t.split("{}")[0]), s["text"], F.lit(t.split("{}")[1])) for t in TEMPLATES])
        return F.concat(first, F.transform(F.slice(drawn, 1, take), lambda d: F.get(filled, d["i"])))

    return ordered_unique(let(F.struct(category.alias("category"), text.alias("text"), key.alias("key")), worded))
