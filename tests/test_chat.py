import json

from sieveyard.operators.chat_rows import check_rows, profile, to_json_rows, to_training_text
from sieveyard.sources.json_lines import MODEL_READY, read_jsonl, read_lines, write_json
from sieveyard.streaming.ingest import stream_first_rows, stream_rows


def line(user="hi", assistant="code", meta=None, **more):
    messages = [{"role": r, "content": c} for r, c in (("user", user), ("assistant", assistant)) if c is not None]
    return json.dumps({"messages": messages, "metadata": {"category": "c", "difficulty": "d"} if meta is None else meta} | more)


LINES = [line(), line(user=None), line(assistant="   "), line(meta={"category": None}), line(meta={}), line(meta="text"), "", "{broken", json.dumps({"metadata": {}}), line(user="abcd", assistant="xyz")]


def test_profile(spark):
    checked = check_rows(spark.createDataFrame([(v,) for v in LINES], "value string"))
    assert [r.bad for r in checked.collect()] == [False, True, True, False, False, True, True, True, True, False]
    got = profile(checked).first().asDict(True)
    assert (got["rows_checked"], got["bad_rows"], got["max_code_chars"]) == (10, 6, 4)
    assert got["avg_prompt_chars"] == round((2 * 4 + 4) / 5, 2) and got["categories"] == {"None": 1, "c": 2, "unknown": 1}
    none = profile(check_rows(spark.createDataFrame([], "value string"))).first()
    assert (none.rows_checked, none.avg_code_chars, none.max_code_chars, none.categories) == (0, 0.0, 0, {})


def test_jsonl_in(spark, tmp_path):
    path = tmp_path / "a.jsonl"
    path.write_text("\n".join(LINES[:1] + ["", "  ", "{broken", LINES[9]]) + "\n")
    assert read_jsonl(spark, str(path), MODEL_READY).count() == 2
    assert read_jsonl(spark, str(tmp_path / "none.jsonl")).count() == 0
    assert [r.line_no for r in read_lines(spark, str(path)).collect()] == [1, 2, 3, 4, 5]
    assert read_lines(spark, str(path), 2).count() == 2
    write_json(spark, str(tmp_path / "x.json"), {"p": path, "é": 1})
    assert json.loads((tmp_path / "x.json").read_text()) == {"p": str(path), "é": 1}


def test_rows_out(spark):
    df = spark.createDataFrame([([("user", "q"), ("assistant", "a")], (None, "é"))], "messages array<struct<role string, content string>>, metadata struct<source_repo string, name string>")
    assert json.loads(to_json_rows(df).first().value) == {"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}], "metadata": {"source_repo": None, "name": "é"}}
    assert to_training_text(df).first().text == "### Instruction:\nq\n\n### Response:\na"


def test_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.txt").write_text("\n".join([line(), line(), line(user="other"), "bad"]) + "\n")
    query = stream_first_rows(stream_rows(spark, str(tmp_path / "in"))).writeStream.format("memory").queryName("first_rows").outputMode("append").option("checkpointLocation", str(tmp_path / "cp")).start()
    query.processAllAvailable()
    query.stop()
    assert sorted(r.user for r in spark.table("first_rows").collect()) == ["hi", "other"]


def test_command_line(spark, tmp_path, capsys):
    from sieveyard.__main__ import arguments, config, main

    path = tmp_path / "rows.jsonl"
    path.write_text("\n".join(LINES[:2]) + "\n")
    main(["profile", str(path), "--max-rows", "1"])
    assert json.loads(capsys.readouterr().out)["rows_checked"] == 1
    args = arguments().parse_args(["extract", "a", "b", "--output-dir", "o", "--seed", "7", "--row-wise-split"])
    own = config(args)
    assert (own.input_paths, own.seed, own.split_by_content_hash, own.batch_size) == (("a", "b"), 7, False, 256)
