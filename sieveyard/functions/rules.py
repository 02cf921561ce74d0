"""Rule-based tags, category, difficulty and quality as expressions over parameters."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import let, ordered_unique

# The domain's names and words.
OBJECTS = (
    "Angle", "Annulus", "Arrow", "Axes", "BarChart", "Brace", "Circle", "ComplexPlane", "DecimalNumber", "Dot", "Ellipse", "FunctionGraph", "Graph",
    "ImageMobject", "Integer", "Line", "MathTex", "Matrix", "NumberLine", "NumberPlane", "ParametricFunction", "Paragraph", "Polygon", "Rectangle",
    "RegularPolygon", "Sector", "Sphere", "Square", "Surface", "SurroundingRectangle", "Table", "Tex", "Text", "ThreeDAxes", "Triangle",
    "ValueTracker", "Vector", "VGroup",
)
ANIMATIONS = (
    "AddTextLetterByLetter", "ApplyMethod", "ApplyWave", "Circumscribe", "Create", "DrawBorderThenFill", "FadeIn", "FadeOut", "FadeTransform",
    "Flash", "FocusOn", "GrowArrow", "GrowFromCenter", "Indicate", "LaggedStart", "MoveAlongPath", "ReplacementTransform", "Restore", "Rotate",
    "ShowCreation", "ShowIncreasingSubsets", "ShowPassingFlash", "Transform", "TransformFromCopy", "Uncreate", "Unwrite", "UpdateFromAlphaFunc",
    "Wiggle", "Write",
)
IMPORT_MARKS = ("from manim import", "import manim")


@dataclass(frozen=True)
class TagRule:
    """A tag holds if an object, a base or a word of the lower-cased text is one of these."""

    tag: str
    objects: tuple[str, ...] = ()
    words: tuple[str, ...] = ()
    bases: tuple[str, ...] = ()
    any_animation: bool = False


# Tags in output order, and categories in order of precedence with the tag that each follows.
TAG_RULES = (
    TagRule("graphs", ("Axes", "NumberPlane", "Graph", "FunctionGraph"), ("plot(",)),
    TagRule("math", ("MathTex", "Tex")),
    TagRule("geometry", ("Circle", "Square", "Triangle", "Polygon", "Line", "Angle")),
    TagRule("linear-algebra", ("Vector", "Arrow", "Matrix")),
    TagRule("physics", (), ("velocity", "force", "mass", "field", "wave", "pendulum")),
    TagRule("3d", ("ThreeDAxes", "Surface", "Sphere"), (), ("ThreeDScene",)),
    TagRule("animation", any_animation=True),
    TagRule("text", ("Text", "MarkupText", "Paragraph")),
)
CATEGORIES = (("graphs", "graphs"), ("3d", "3d"), ("physics", "physics"), ("geometry", "geometry"), ("math", "math"), ("text", "text"), ("animation", "animations"))


@dataclass(frozen=True)
class RuleSet:
    tags: tuple[TagRule, ...] = TAG_RULES
    categories: tuple[tuple[str, str], ...] = CATEGORIES
    default: str = "general"
    # Fixed values of the score: weights in this order of addition, and the levels' upper bounds.
    weights: tuple[float, float, float, float] = (0.04, 0.8, 1.0, 0.12)
    levels: tuple[tuple[float, str], ...] = ((6.0, "beginner"), (16.0, "intermediate"))
    top_level: str = "advanced"
    import_marks: tuple[str, ...] = field(default=IMPORT_MARKS)


def of_vocabulary(values: Column, vocabulary: Sequence[str]) -> Column:
    """The values that the vocabulary has, distinct, in first-seen order. Vocabularies are small; large ones are a semi-join's work."""
    return ordered_unique(F.filter(values, lambda v: v.isin(*vocabulary)))


def tags(objects: Column, animations: Column, bases: Column, text: Column, rules: RuleSet = RuleSet()) -> Column:

    def found(s: Column) -> Column:
        out = []
        for rule in rules.tags:
            holds = F.lit(False)
            if rule.objects:
                holds |= F.arrays_overlap(s["objects"], F.array(*map(F.lit, rule.objects)))
            if rule.bases:
                holds |= F.arrays_overlap(s["bases"], F.array(*map(F.lit, rule.bases)))
            for word in rule.words:
                holds |= s["low"].contains(word)
            if rule.any_animation:
                holds |= F.size(s["animations"]) > 0
            out.append(F.when(holds, F.lit(rule.tag)))
        return F.array_compact(F.array(*out))

    return let(F.struct(objects.alias("objects"), animations.alias("animations"), bases.alias("bases"), F.lower(text).alias("low")), found)


def category(tags_: Column, rules: RuleSet = RuleSet()) -> Column:

    def first(t: Column) -> Column:
        out = F.lit(rules.default)
        for tag, name in reversed(rules.categories):
            out = F.when(F.array_contains(t, tag), name).otherwise(out)
        return out

    return let(tags_, first)


def score(lines: Column, objects: Column, animations: Column, calls: Column, rules: RuleSet = RuleSet()) -> Column:
    """Doubles, added in the weights' order: sums that touch a level's bound depend on both."""
    a, b, c, d = (F.lit(float(w)) for w in rules.weights)
    return lines * a + objects * b + animations * c + calls * d


def difficulty(points: Column, rules: RuleSet = RuleSet()) -> Column:

    def level(p: Column) -> Column:
        out = F.lit(rules.top_level)
        for bound, name in reversed(rules.levels):
            out = F.when(p < F.lit(bound), name).otherwise(out)
        return out

    return let(points, level)


def quality(has_construct: Column, n_objects: Column, n_animations: Column, lines: Column, code: Column, rules: RuleSet = RuleSet()) -> Column:
    """Fixed shares for what a good unit has, at most 1, to three places."""
    marked = F.lit(False)
    for mark in rules.import_marks:
        marked |= code.contains(mark)
    total = F.lit(0.25)
    for holds, share in ((has_construct, 0.25), (n_objects > 0, 0.15), (n_animations > 0, 0.15), (lines >= 5, 0.1), (marked, 0.1)):
        total = total + F.when(holds, F.lit(share)).otherwise(F.lit(0.0))
    return F.round(F.least(total, F.lit(1.0)), 3)


def complexity(line_start: Column, line_end: Column, objects: Column, animations: Column, calls: Column, has_construct: Column) -> Column:
    return F.struct(
        F.greatest(F.lit(0), line_end - line_start + 1).cast("int").alias("line_count"),
        F.size(objects).alias("object_count"),
        F.size(animations).alias("animation_count"),
        F.size(F.array_distinct(calls)).alias("call_count"),
        has_construct.alias("has_construct"),
    )
