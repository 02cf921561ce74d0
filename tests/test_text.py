import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sieveyard.functions import prompts as P
from sieveyard.functions import rules as R
from sieveyard.functions.text import build_code, normalized_code, ordered_unique, py_strip, readable_join, split_identifier, stable_hash


def expected_hash(text: str) -> str:
    lines = [line.rstrip() for line in text.strip().splitlines()]
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


ODD = ["a\r\nb", "a\rb ", "a \x0b b\x0c", " x ", "a b  ", "  ", "", "x  \n\n  y\t\n", "　 z\x85", "a \x1c b\x1d\x1e"]


def test_stable_hash_follows_python(spark):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(ODD)], "id int, text string").select("id", stable_hash(F.col("text")).alias("h")).collect()
    assert {r.id: r.h for r in rows} == {i: expected_hash(t) for i, t in enumerate(ODD)}


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("ab \t\n\r\x0b\x1c\x85  "), max_size=30), min_size=1, max_size=40))
def test_stable_hash_on_random_white_space(spark, texts):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string").select("id", stable_hash(F.col("text")).alias("h")).collect()
    assert {r.id: r.h for r in rows} == {i: expected_hash(t) for i, t in enumerate(texts)}


def test_long_blank_runs_are_linear(spark):
    text = "a" + " " * 200_000 + "b" + " " * 200_000 + "\nc"
    assert spark.createDataFrame([(text,)], "t string").select(F.length(normalized_code(F.col("t")))).first()[0] == 200_004


@pytest.mark.parametrize(("name", "words"), [("SineWaveScene", "sine wave scene"), ("HTTPServer", "httpserver"), ("my_scene2D", "my scene2 d"), ("ÀbcÉd", "àbc éd"), ("", ""), ("__a__b", "a b")])
def test_split_identifier(spark, name, words):
    assert spark.createDataFrame([(name,)], "v string").select(split_identifier(F.col("v"))).first()[0] == words


def test_joins_and_unique(spark):
    df = spark.createDataFrame([(["a", "", None, "b", "a", "c"],)], "v array<string>")
    row = df.select(ordered_unique(F.col("v")).alias("u"), readable_join(ordered_unique(F.col("v"))).alias("three"), readable_join(F.slice("v", 1, 1)).alias("one"), readable_join(F.array(F.lit("x"), F.lit("y"))).alias("two"), readable_join(F.array().cast("array<string>")).alias("none"))
    assert row.first().asDict() == {"u": ["a", "b", "c"], "three": "a, b, and c", "one": "a", "two": "x and y", "none": ""}


def test_build_code_drops_blank_parts(spark):
    df = spark.createDataFrame([(" import x \n", "  ", "class A: pass\n")], "a string, b string, c string")
    assert df.select(build_code("a", "b", F.col("c"))).first()[0] == "import x\n\nclass A: pass\n"
    assert df.select(py_strip(F.col("a"))).first()[0] == "import x"


def test_every_tag_and_precedence(spark):
    cases = [
        (["Axes"], [], [], "", ["graphs"], "graphs"), ([], [], [], "ax.PLOT(x)", ["graphs"], "graphs"), (["Tex"], [], [], "", ["math"], "math"), (["Circle", "Tex"], [], [], "", ["math", "geometry"], "geometry"),
        (["Vector"], [], [], "", ["linear-algebra"], "general"), ([], [], [], "Reinforced", ["physics"], "physics"), ([], [], ["ThreeDScene"], "", ["3d"], "3d"), ([], [], ["manim.ThreeDScene"], "", [], "general"),
        ([], ["Write"], [], "", ["animation"], "animations"), (["Text"], ["Write"], [], "", ["animation", "text"], "text"), (["Sphere", "Axes"], [], [], "mass", ["graphs", "physics", "3d"], "graphs"),
    ]
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, o array<string>, a array<string>, b array<string>, t string, want array<string>, cat string")
    df = df.withColumn("tags", R.tags(F.col("o"), F.col("a"), F.col("b"), F.col("t"))).withColumn("category", R.category(F.col("tags")))
    assert df.filter("tags <> want or category <> cat").count() == 0


def test_difficulty_uses_doubles_in_order(spark):
    cases = [(15, 0, 0, 45), (150, 0, 0, 0), (0, 0, 6, 0), (0, 0, 16, 0), (10, 2, 1, 3), (25, 10, 5, 17)]
    df = spark.createDataFrame(cases, "l int, o int, a int, c int")
    got = [r[0] for r in df.select(R.difficulty(R.score(F.col("l"), F.col("o"), F.col("a"), F.col("c")))).collect()]
    points = [x * 0.04 + o * 0.8 + a * 1.0 + c * 0.12 for x, o, a, c in cases]
    assert got == ["beginner" if p < 6 else "intermediate" if p < 16 else "advanced" for p in points]
    assert got[0] == "beginner"  # 5.999999999999999


def test_quality_and_descriptions(spark):
    df = spark.createDataFrame([("graphs", ["NumberPlane"], [], "S"), ("geometry", [], ["Write"], "S"), ("general", [], ["Write", "FadeIn", "Flash"], "S"), ("general", [], [], "MyScene"), ("general", ["Dot", "Table", "Brace", "Sector"], [], "S"), ("text", ["Text"], [], "S")], "c string, o array<string>, a array<string>, n string")
    df = df.withColumn("d", P.description(F.col("c"), F.col("o"), F.col("a"), F.col("n"))).withColumn("p", P.primary_prompt(F.col("c"), F.col("d")))
    assert [r.p for r in df.collect()] == [
        "Visualize a graph with axes", "Create a geometric scene using Write", "Create a Manim animation showing uses Write and FadeIn", "Create a Manim animation showing illustrates my scene",
        "Create a Manim animation showing dot, table, and brace", "Show text",
    ]
    top = spark.range(1).select(R.quality(F.lit(True), F.lit(1), F.lit(1), F.lit(5), F.lit("import manim")).alias("a"), R.quality(F.lit(False), F.lit(0), F.lit(0), F.lit(4), F.lit("")).alias("b")).first()
    assert (top.a, top.b) == (1.0, 0.25)


def test_prompts_are_distinct_and_keyed(spark):
    df = spark.createDataFrame([("general", "dots", f"k{i}") for i in range(20)], "c string, d string, k string")
    rows = df.select("k", P.prompts(F.col("c"), F.col("d"), F.col("k"), 2, 42).alias("p")).collect()
    again = df.repartition(3).select("k", P.prompts(F.col("c"), F.col("d"), F.col("k"), 2, 42).alias("p")).collect()
    assert all(len(r.p) == 3 and len(set(r.p)) == 3 for r in rows) and len({tuple(r.p) for r in rows}) > 3
    assert {r.k: r.p for r in rows} == {r.k: r.p for r in again}
    assert len(df.select(P.prompts(F.col("c"), F.col("d"), F.col("k"), 9, 1).alias("p")).first().p) == 5
