"""Records found by byte ranges, against a parser of whole files."""

import json
import random

import pytest

from inkprint.sources import corpus, json_records

HARD = ['plain', 'a } b { c [ d ] e', 'quote " and \\ and \\" and }" {"', "\\", "\\\\", "é€😀} {ñ", "", "}{" * 40, "tab\tnew\nline\r}", "{\"k\": [1, {\"z\": \"}\"}]}"]


def written(folder, name, rows, kind):
    texts = [json.dumps(r, ensure_ascii=k % 2 == 0, indent=3 if k % 3 == 0 else None) for k, r in enumerate(rows)]
    body = {"array": "[" + ", ".join(texts) + "]\n", "rows": "\n".join(texts), "ends": "[" + ",".join(texts) + "]"}[kind]
    (folder / name).write_bytes(body.encode())


@pytest.mark.parametrize("kind, size", [("array", 64), ("rows", 300), ("ends", 300), ("array", 1 << 20)])
def test_ranges_equal_whole_files(spark, tmp_path, monkeypatch, kind, size):
    draw = random.Random(size)
    rows = [{"c_code": " ".join(draw.choices(HARD, k=draw.choice([0, 1, 2, 12]))), "extra": {"deep": [{"x": "}"}, {}]}, "model_name": draw.choice(HARD), "prompt": None if k % 5 == 0 else f"p{k}"}
            for k in range(24)]
    written(tmp_path, "a.json", rows[:15], kind)
    written(tmp_path, "b.json", rows[15:], kind)
    was = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for key in was:
            spark.conf.set(key, str(size) if "max" in key else "0")
        if size == 64:
            monkeypatch.setattr(json_records, "BROADCAST_RANGES", 0)
            monkeypatch.setattr(corpus, "BROADCAST_FILES", 0)
        found = json_records.records(spark, str(tmp_path))
        starts = found.select("file", "start").distinct().count()
        got = corpus.read_corpus_json(spark, str(tmp_path)).orderBy("row_id").collect()
    finally:
        for key, value in was.items():
            spark.conf.set(key, value)
    assert [(r.row_id, r.code, r.label, r.prompt) for r in got] == [(k, r["c_code"], r["model_name"], r["prompt"]) for k, r in enumerate(rows)]
    assert starts > 6


def test_files_without_records_and_cut_ones(spark, tmp_path):
    for name, body in {"a": "", "b": "[]", "c": "  \n", "d": '[{"c_code": "x"}, {"c_code": "y"', "e": '{"c_code": "z"}'}.items():
        (tmp_path / f"{name}.json").write_text(body)
    rows = corpus.read_corpus_json(spark, str(tmp_path)).orderBy("row_id").collect()
    assert [r.code for r in rows if r.code is not None] == ["x", "z"] and len(rows) == 3


def test_one_file_is_read_by_many_tasks_and_texts_stay(spark, tmp_path):
    (tmp_path / "one.json").write_text(json.dumps([{"c_code": f"int f{k}() {{ return {k}; }}" * 20, "model_name": "m", "prompt": "p"} for k in range(120)]))
    was = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9000")
    try:
        found = json_records.records(spark, str(tmp_path))
        assert spark.read.option("lineSep", "}").text(str(tmp_path)).rdd.getNumPartitions() > 5
        assert found.count() == 120
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", was)
