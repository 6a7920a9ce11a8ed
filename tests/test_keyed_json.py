"""Large keyed JSON objects, read by many tasks, against the json module."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from railloom.operators.columns import SOURCE_ORDER
from railloom.sources import landed
from tests.conftest import rows

NASTY = ["}", '"', '\\"}', "{", "\\", "\\\\", "a}b{c", "é\n}", "},", '":{', "\t", "", "plain", '\\"', "😀}", "null", "]}["]


def entries(n: int, seed: int = 1) -> dict:
    rng = random.Random(seed)
    return {
        f"k{i}{rng.choice(NASTY)}": None if i % 17 == 5 else {"id": str(i), "text": "".join(rng.choices(NASTY, k=rng.randrange(6))), rng.choice(["x", "y"]): rng.choice(NASTY)}
        for i in range(n)
    }


def expected(found: dict) -> list[tuple]:
    return [(r["id"], r["text"] or None, r.get("x") or None, r.get("y") or None) for r in found.values() if r is not None]


def read(spark, path):
    df = landed.read_keyed_json(spark, str(path))
    return [tuple(r) for r in df.orderBy(SOURCE_ORDER).select("id", "text", "x", "y").collect()]


@pytest.mark.parametrize("indent,end", [(None, ""), (2, "\n"), (None, "\n \n")])
def test_entries_across_blocks(spark, tmp_path, indent, end):
    found = entries(800)
    path = tmp_path / "big.json"
    path.write_text("﻿" + json.dumps(found, indent=indent, ensure_ascii=indent is None) + end, encoding="utf-8")
    kept = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        blocks = landed.keyed_records(spark, str(path)).select("block").distinct().count()
        assert blocks > 10
        assert read(spark, path) == expected(found)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", kept[0])
        spark.conf.set("spark.sql.files.openCostInBytes", kept[1])


def test_values_that_are_objects_and_several_files(spark, tmp_path):
    for name in "ab":
        (tmp_path / f"{name}.json").write_text(json.dumps({"1": {"id": name, "text": {"deep": {"er": "}"}}}, "2": {"id": name + "2", "text": [{"a": 1}, "}"]}}))
    (tmp_path / "empty.json").write_text("{}")
    (tmp_path / "nulls.json").write_text('{"a": null, "b}": null}')
    found = landed.read_keyed_json(spark, str(tmp_path), ["id", "text"])
    got = [(r["id"], json.loads(r["text"])) for r in found.orderBy(SOURCE_ORDER).collect()]
    assert got == [(i, v) for n in "ab" for i, v in ((n, {"deep": {"er": "}"}}), (n + "2", [{"a": 1}, "}"]))]


@pytest.mark.parametrize("cut", [3, 60, 61, 75, 100])
def test_a_file_that_breaks_off_keeps_its_whole_entries(spark, tmp_path, cut):
    found = {str(i): {"id": str(i), "text": "}{" * 20} for i in range(20)}
    text = json.dumps(found)
    (tmp_path / "cut.json").write_text(text[:-cut])
    parsed = landed.keyed_rows(spark, str(tmp_path / "cut.json"))
    whole = text[:-cut].count('}"}') + text[:-cut].count('{"}') if cut > 2 else 20
    got = landed.sound_records(parsed, ["id"])
    assert sorted(int(r["id"]) for r in got.collect()) == list(range(got.count())) and got.count() in (whole, 20 - (cut > 2))
    (bad,) = landed.bad_records(parsed).collect() if got.count() < 20 else [{"file": "cut.json", "text": ""}]
    assert bad["file"].endswith("cut.json")


def test_entries_that_are_no_objects_are_bad_records(spark, tmp_path):
    (tmp_path / "x.json").write_text('{"1": {"id": "a"}, "2": 5, "3": {"id": "b"}, "4": {"id": "c"}}')
    parsed = landed.keyed_rows(spark, str(tmp_path / "x.json"))
    assert rows(landed.sound_records(parsed, ["id"]).select("id")) == [("a",), ("c",)]
    (bad,) = landed.bad_records(parsed).collect()
    assert '"2": 5' in bad["text"]


def test_lines_and_too_many_names(spark, tmp_path, monkeypatch):
    (tmp_path / "l.json").write_text('{"id": "a", "n": 1}\n\n{"id": oops\n{"id": "b"}\n')
    parsed = landed.line_rows(spark, str(tmp_path / "l.json"))
    assert rows(landed.sound_records(parsed).select("id", "n")) == [("a", "1"), ("b", None)]
    assert [r["text"] for r in landed.bad_records(parsed).collect()] == ['{"id": oops']
    monkeypatch.setattr(landed, "MOST_COLUMNS", 1)
    with pytest.raises(ValueError, match="more than 1"):
        landed.read_json_lines(spark, str(tmp_path / "l.json"))
