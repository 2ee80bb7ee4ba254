"""Large JSON files cut in many tasks: equal to reading them whole."""

import json
import random

import pytest
from pyspark.sql import functions as F

from conformity.sources import json_ranges
from conformity.sources.extract import read_records


def nasty(rng):
    return rng.choice(["", "a", '"', "\\", '\\"', "\\\\", "{", "}", "[", "]", "é", "日本", "\n", "\t", 'x":[{', "results"])


def record(rng, i):
    text = "".join(nasty(rng) for _ in range(rng.randrange(12)))
    return {"id": i, "t": text, 'k"{': [text[:2]] * rng.randrange(3), "n": {"x": {"y": [{"z": text[::-1]}]}, "e": {}}, "l": [[1, 2], []]}


def shapes(records):
    return {
        "array": records,
        "results": {"paging": {"next": {"a": [{"b": 1}]}}, "other": [{"id": -1}], "results": records, "after": {"c": {"d": 1}}, "x": [{"id": -2}], "results2": [{"id": -3}]},
        "one": records[0] | {"more": {"results": 5}},
    }


@pytest.mark.parametrize("shape", ["array", "results", "one"])
@pytest.mark.parametrize("indent", [None, 1])
def test_ranges_give_the_records_of_the_whole_file(spark, tmp_path, monkeypatch, shape, indent):
    rng = random.Random(5)
    held = shapes([record(rng, i) for i in range(20)])[shape]
    for escaped in (True, False):
        at = tmp_path / f"{escaped}.json"
        at.write_text(json.dumps(held, indent=indent, ensure_ascii=escaped))
        want = sorted(r[0] for r in read_records(spark, f"file://{at}").select(F.to_json(F.struct("*"))).collect())
        assert len(want) == (1 if shape == "one" else 20)
        for size in (397,):
            monkeypatch.setattr(json_ranges, "RANGE_BYTES", size)
            got = read_records(spark, f"file://{at}", split_above=0)
            assert sorted(r[0] for r in got.select(F.to_json(F.struct("*"))).collect()) == want, (escaped, size)


@pytest.mark.parametrize("size", [1, 2, 3, 7, 50])
def test_every_cut_gives_every_record_once(tmp_path, size):
    """The scans alone, with cuts at every byte, inside escapes and between them."""
    rng = random.Random(size)
    records = [record(rng, i) for i in range(12)] + [{}, {"q": "\\" * 9 + '"'}]
    text = json.dumps(records).encode()
    path = tmp_path / "x.json"
    path.write_bytes(text)
    found, inside, depth = [], False, 0
    with json_ranges._open(str(path)) as file:
        for start in range(0, len(text), size):
            found += list(json_ranges.records_of(file, start, size, len(text), inside, depth, 1, -1, len(text)))
            parity, outer, inner = json_ranges.range_moves(file, start, size)
            depth, inside = depth + (inner if inside else outer), inside ^ bool(parity)
    assert [json.loads(r) for r in found] == records and (inside, depth) == (False, 0)


def test_a_large_file_is_many_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(json_ranges, "RANGE_BYTES", 1 << 16)
    path = tmp_path / "big.json"
    path.write_text(json.dumps({"results": [{"id": i, "text": "x" * 200} for i in range(5000)]}))
    lines = json_ranges.json_lines(spark, [f"file://{path}"])
    whole, cut = spark.read.option("multiLine", True).json(f"file://{path}"), spark.read.json(lines)
    assert whole.rdd.getNumPartitions() == 1
    parts = [r["n"] for r in cut.groupBy(F.input_file_name()).agg(F.count("*").alias("n")).collect()]
    assert len(parts) >= path.stat().st_size // (1 << 16) and max(parts) < 400 and sum(parts) == 5000
    assert cut.select("id").distinct().count() == 5000


def test_small_files_and_folders_are_read_whole(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"{i}.json").write_text(json.dumps([{"id": i}]))
    assert json_ranges.large_files(spark, [f"file://{tmp_path}"], 1000) == []
    assert len(json_ranges.large_files(spark, [f"file://{tmp_path}/*.json"], 5)) == 3
    both = [read_records(spark, f"file://{tmp_path}", split_above=n) for n in (0, 1000)]
    assert [sorted(r["id"] for r in df.collect()) for df in both] == [[0, 1, 2]] * 2
