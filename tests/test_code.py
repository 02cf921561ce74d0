import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from sieveyard.operators.code_units import imports, parse, parse_files, register, scenes
from sieveyard.operators.maintenance import safety_reason
from sieveyard.operators.metadata import usable, with_metadata, with_validation
from sieveyard.plans.config import ExtractConfig
from sieveyard.plans.extract import extract, plan, statistics
from sieveyard.plans.model_ready import build_model_ready
from sieveyard.plans.queries import HELPERS, WAVES
from sieveyard.sources.code_files import batches, candidates, decode, read_code, walk
from sieveyard.sources.json_lines import read_lines

SCENE = "class S(Scene):\n    def construct(self):\n        self.add({})\n"


def unit(source, **options):
    error, _, units = parse(source, **options)
    assert error is None
    return units[-1]


def test_dependencies_come_in_source_order():
    source = "from manim import *\nSCALE = 2\ndef make_label(t):\n    return Text(t).scale(SCALE)\nclass HelperScene(Scene):\n    pass\nclass MainScene(HelperScene):\n    def construct(self):\n        self.add(make_label('x'))\n"
    u = unit(source)
    code = u["dependency_code"]
    assert u["dependency_names"] == ["HelperScene", "make_label", "SCALE"] and u["missing_symbols"] == []
    assert code.index("SCALE = 2") < code.index("def make_label") < code.index("class HelperScene")
    assert dict(u["dependency_tree"]) == {"HelperScene": [], "make_label": ["SCALE"], "SCALE": []}
    bare = unit(source, with_dependencies=False)
    assert bare["dependency_code"] == "" and bare["dependency_names"] == []


@pytest.mark.parametrize(("source", "needs", "missing"), [
    ("x = 1\nx += 1\n" + SCENE.format("x"), ["x"], ["Scene"]),
    ("a, b = 1, 2\n" + SCENE.format("b"), ["b"], ["Scene"]),
    ("def f():\n    return f()\n" + SCENE.format("f()"), ["f"], ["Scene"]),
    ("def f():\n    return g()\ndef g():\n    return f()\n" + SCENE.format("f()"), ["f", "g"], ["Scene"]),
    ("from m import x as y\n" + SCENE.format("y"), [], ["Scene", "y"]),
    ("import m as n\n" + SCENE.format("n.q"), [], ["Scene"]),
    ("if True:\n    z = 1\n" + SCENE.format("z, _hidden, len"), [], ["Scene", "z"]),
    ("from m import *\n" + SCENE.format("anything"), [], []),
    ("o = 1\no.attr = 2\n" + SCENE.format("o"), ["o"], ["Scene"]),
])
def test_resolution_quirks(source, needs, missing):
    u = unit(source)
    assert (u["dependency_names"], u["missing_symbols"]) == (needs, missing)


def test_last_definition_wins_and_positional_only_names_are_not_local():
    assert unit("x = 1\nx += 1\n" + SCENE.format("x"))["dependency_code"] == "x += 1"
    u = unit("p = 1\nclass S(Scene):\n    def construct(self, p, /):\n        self.add(p)\n")
    assert u["dependency_names"] == ["p"]


def test_which_classes_are_units():
    source = (
        "@deco\nclass A(manim.MyScene):\n    async def construct(self): ...\nclass B(Generic[T], Base()): ...\nclass C(make().Scene[int]):\n    def construct(self): ...\n"
        "if 1:\n    class D(Scene): ...\nclass E(Scene):\n    class F(Scene): ...\n"
    )
    _, _, units = parse(source)
    assert [(u["scene_name"], u["bases"], u["has_construct"]) for u in units] == [("A", ["manim.MyScene"], False), ("C", ["make.Scene"], True), ("E", ["Scene"], False)]
    assert units[0]["class_code"].startswith("class A") and units[0]["line_start"] == 2
    assert [u["scene_name"] for u in parse("class A(Own): ...", ["Own"])[2]] == ["A"]


def test_imports_and_errors():
    assert unit("import numpy\nimport numpy\n" + SCENE.format("1"))["imports_code"] == "from manim import *\nimport numpy"
    assert unit("from manimlib import *\n" + SCENE.format("1"))["imports_code"] == "from manimlib import *"
    assert unit("from __future__ import annotations\n" + SCENE.format("1"))["imports_code"].splitlines() == ["from manim import *", "from __future__ import annotations"]
    for bad in ("class A(Scene:\n", "﻿x = 1\n", "print(1)  # type: int\n", "a\0b"):
        assert parse(bad)[0]
    assert parse("") == parse(None) == (None, [], [])


def test_files_to_scenes(spark):
    files = spark.createDataFrame([("w.py", WAVES), ("h.py", HELPERS), ("b.py", "class B(Scene:"), ("e.py", ""), ("n.py", None)], "path string, source string")
    parsed = parse_files(files)
    assert parsed.filter("error is not null").count() == 1 and imports(parsed).count() == 3
    rows = {r.scene_name: r for r in with_validation(with_metadata(scenes(parsed), "repo"), strict=True).collect()}
    assert rows["SineWaveScene"].content_hash == "16610ad3db0b585e92b7a7e36471995810ceeb909a94ef8e6904fbbcd9c2134e"
    assert rows["MainScene"].validation.errors == ["Unresolved dependency symbols: unknown_thing"]
    assert rows["HelperScene"].validation.errors == ["Scene class has no construct() method."]
    assert rows["SineWaveScene"].md.source_repo == "repo" and rows["SineWaveScene"].md.complexity.call_count == 6
    assert usable(with_validation(with_metadata(scenes(parsed))), 0.95).count() == 1


def test_import_warning(spark):
    files = spark.createDataFrame([("a.py", "from manimlib import *\n" + SCENE.format("1")), ("b.py", "import manimlib\n" + SCENE.format("1"))], "path string, source string")
    rows = with_validation(with_metadata(scenes(parse_files(files)))).orderBy("source_path").collect()
    assert [r.validation.warnings for r in rows] == [["No explicit Manim import found."], []]


def test_table_function(spark):
    register(spark)
    spark.createDataFrame([("w.py", WAVES), ("n.py", "x")], "path string, source string").createOrReplaceTempView("files")
    rows = spark.sql("select path, s.scene_name from files, lateral extract_scenes(path, source) s order by 2").collect()
    assert [tuple(r) for r in rows] == [("w.py", "RotatingSquareScene"), ("w.py", "SineWaveScene")]


@pytest.fixture
def tree(tmp_path):
    for name in ("a.py", "a/b.py", "a-b.py", "_2018/b.py", "sub/__init__.py", ".hid/c.py", ".x.py", "node_modules/deep/i.py", "sub/build/e.py", "f.PY"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(b"x = 1\r\n")
    (tmp_path / "latin.py").write_bytes(b"s = '\xe9'\n")
    return tmp_path


def test_scan(spark, tree):
    scan = walk([str(tree), str(tree), str(tree / "a.py"), str(tree / "missing")])
    names = [p[len(str(tree)) + 1 :] for p in scan.files]
    assert names == [".hid/c.py", "_2018/b.py", "a/b.py", "a-b.py", "a.py", "latin.py", "sub/__init__.py"] and scan.skipped_directories == 2
    rows = read_code(spark, [str(tree)], batch_size=2)
    assert sorted(r.path for r in rows.collect()) == sorted(scan.files) and rows.rdd.getNumPartitions() == 4
    assert {r.source for r in rows.collect()} == {"x = 1\n", "s = 'é'\n"}
    paths = spark.createDataFrame([("a/b.py",), ("a/.b.py",), ("build/c.py",), ("a.txt",)], "path string")
    assert [r.path for r in candidates(paths).collect()] == ["a/b.py"]
    assert walk([str(tree / "node_modules")]).files == []
    assert list(batches(list("abcde"), 2)) == [["a", "b"], ["c", "d"], ["e"]] and decode(b"\xff\r\r\n") == "ÿ\n\n"


def test_cleanup_reasons(spark):
    df = spark.createDataFrame([("/r", "/r/src/extractor/core", True, "src/extractor/core")], "root string, path string, there boolean, rel string")
    assert df.select(safety_reason(F.col("root"), F.col("path"), F.col("there"), F.col("rel"))).first()[0] == "protected source/configuration path"


def test_config():
    ExtractConfig(("a",), "o").validate()
    bad = ({"input_paths": ()}, {"max_workers": 0}, {"batch_size": 0}, {"validation_ratio": 1.0}, {"test_ratio": -0.1}, {"validation_ratio": 0.5, "test_ratio": 0.5}, {"prompt_augmentation_count": -1})
    for change in bad:
        with pytest.raises(ValueError):
            ExtractConfig(**({"input_paths": ("a",), "output_dir": "o"} | change)).validate()


def test_extract_end_to_end(spark, tmp_path):
    repo = tmp_path / "repo"
    repo.mkdir()
    (repo / "waves.py").write_text(WAVES)
    (repo / "copy.py").write_text(WAVES)
    (repo / "bad.py").write_text("class (")
    paths = extract(spark, ExtractConfig((str(repo),), str(tmp_path / "out"), prompt_augmentation_count=1))
    rows = [json.loads(line) for f in Path(paths["dataset"]).rglob("part-*.json") for line in f.read_text().splitlines()]
    stats, report = json.loads(Path(paths["stats"]).read_text()), json.loads(Path(paths["report"]).read_text())
    assert stats["scanned_files"] == 3 and stats["failed_files"] == 1 and stats["discovered_scenes"] == 4 and stats["valid_scenes"] == 4 and stats["categories"] == {"geometry": 2, "graphs": 2}
    assert stats["exported_examples"] == len(rows) and report["leakage_count"] == 0
    assert all(r["metadata"]["source_repo"] is None and [m["role"] for m in r["messages"]] == ["user", "assistant"] for r in rows)
    assert list(rows[0]["metadata"])[:5] == ["scene_name", "category", "objects", "animations", "difficulty"]


def test_leakage_raises_before_writing(spark, tmp_path):
    repo = tmp_path / "repo"
    repo.mkdir()
    (repo / "waves.py").write_text("".join(WAVES.replace("SineWave", f"W{i}") for i in range(3)))
    config = ExtractConfig((str(repo),), str(tmp_path / "out"), prompt_augmentation_count=4, split_by_content_hash=False, validation_ratio=0.3, test_ratio=0.3)
    with pytest.raises(ValueError, match="leakage"):
        extract(spark, config)
    assert not (tmp_path / "out").exists()


def test_model_ready(spark, tmp_path):
    row = lambda h, missing: {"messages": [{"role": "user", "content": "p"}, {"role": "assistant", "content": "c"}], "metadata": {"content_hash": h, "other": {"deep": 1}, "extraction_diagnostics": {"missing_symbols": missing}}}
    source = tmp_path / "in/source-a"
    source.mkdir(parents=True)
    (source / "train.jsonl").write_text("\n".join([json.dumps(row("hash-a", [])), "", "{broken", json.dumps(row("hash-b", ["X"])), json.dumps(row("", ["X"]))]) + "\n")
    (source / "validation.jsonl").write_text("")
    stats = build_model_ready(spark, str(tmp_path / "in"), str(tmp_path / "out"), ["source-a", "absent"], 8)
    assert (stats["totalRows"], stats["exportedRows"], stats["excluded"]) == (3, 1, {"missing_symbols": 1, "missing_hash": 1})
    text = "".join(f.read_text() for f in (tmp_path / "out/train").glob("part-*"))
    assert json.loads(text)["metadata"] == {"model_ready_source": "source-a", **row("hash-a", [])["metadata"]}
    (source / "test.jsonl").write_text(json.dumps(row("hash-a", [])) + "\n")
    with pytest.raises(ValueError, match="leakage"):
        build_model_ready(spark, str(tmp_path / "in"), str(tmp_path / "out"), ["source-a"], 8)
    assert (tmp_path / "out/test").exists()


def test_extract_feeds_model_ready(spark, tmp_path):
    """The two plans chain: what extract() writes is a source of build_model_ready()."""
    for name, text in (("a", WAVES), ("b", HELPERS)):
        (tmp_path / name).mkdir()
        (tmp_path / name / "m.py").write_text(text)
        extract(spark, ExtractConfig((str(tmp_path / name),), str(tmp_path / "proc" / name), prompt_augmentation_count=2))
    stats = build_model_ready(spark, str(tmp_path / "proc"), str(tmp_path / "out"), ["b", "a", "none"], 3)
    rows = [json.loads(line) for f in sorted((tmp_path / "out").glob("*/part-*.txt")) if "small" not in str(f) for line in f.read_text().splitlines()]
    assert stats["totalRows"] == 9 and stats["excluded"] == {"missing_symbols": 3, "missing_hash": 0} and stats["exportedRows"] == len(rows) == 6 and stats["splits"]["train"] == 6
    assert {r["metadata"]["model_ready_source"] for r in rows} == {"a"} and list(rows[0]["metadata"])[-1] == "model_ready_source"
    assert stats["trainSmallRows"] == 3 == sum(len(f.read_text().splitlines()) for f in (tmp_path / "out/train_small").glob("part-*"))


@pytest.mark.parametrize("name", ["we$1rd", "back\\slash", "qu'o\"te", "sp ace+%20", "é漢"])
def test_tag_by_structure(spark, tmp_path, name):
    folder = tmp_path / "in" / name
    folder.mkdir(parents=True)
    meta = {"content_hash": "h", "metadata": {"inner": 1}, "extraction_diagnostics": {"missing_symbols": []}, "n": 1.50, "big": 2**70}
    rows = [{"metadata": meta, "messages": [{"role": "user", "content": '"metadata": {$'}]}, {"messages": [], "metadata": {"model_ready_source": "old"} | meta}]
    (folder / "train.jsonl").write_text("\n".join(json.dumps(r, ensure_ascii=False) for r in rows))
    build_model_ready(spark, str(tmp_path / "in"), str(tmp_path / "out"), [name])
    out = [line for f in sorted((tmp_path / "out/train").glob("part-*")) for line in f.read_text().splitlines()]
    for row in rows:
        row["metadata"]["model_ready_source"] = name
    assert out == [json.dumps(r, ensure_ascii=False) for r in rows]


def test_lines_are_numbered_by_name_not_size(spark, tmp_path):
    (tmp_path / "a.txt").write_text("one\n")
    (tmp_path / "b.txt").write_text("".join(f"line {i}\n" for i in range(5000)))
    (tmp_path / "c d+%.txt").write_text("\nlast")
    got = [(r.line_no, r.value) for r in read_lines(spark, str(tmp_path)).orderBy("line_no").collect()]
    assert got == list(enumerate(["one", *(f"line {i}" for i in range(5000)), "", "last"], 1))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10000")
    try:
        assert [(r.line_no, r.value) for r in read_lines(spark, str(tmp_path)).orderBy("line_no").collect()] == got
        assert read_lines(spark, str(tmp_path), 3).count() == 3
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_files_are_parsed_once(spark):
    files = spark.createDataFrame([("w.py", WAVES), ("h.py", HELPERS)], "path string, source string")
    text = statistics(spark, plan(files, ExtractConfig(("lib",), "out")))._jdf.queryExecution().executedPlan().toString()
    assert "InArrow" not in text and "Python" not in text
