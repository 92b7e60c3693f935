"""The log of processed ids beside an output."""

import glob
import json
import os
import time

from attrspark.sources.id_log import IdLog
from attrspark.sources.tables import prior_ids


def add(output, name, ids, field="id"):
    os.makedirs(output, exist_ok=True)
    with open(f"{output}/{name}", "w") as file:
        file.writelines(json.dumps({field: i}) + "\n" for i in ids)


def ids_of(log):
    return sorted({r.id for r in log.read().collect()})


def test_each_file_is_parsed_once(spark, tmp_path):
    output = str(tmp_path / "results")
    log = IdLog(spark, output)
    assert ids_of(log) == []
    expected = []
    for wave in range(6):
        found = [f"w{wave}-{i}" for i in range(5)]
        add(output, f"part-{wave}.json", found)
        parsed = log.catch_up()
        assert [os.path.basename(p) for p in parsed] == [f"part-{wave}.json"]
        assert log.catch_up() == []
        expected += found
        assert ids_of(log) == sorted(expected)
    assert ids_of(log) == sorted(r.id for r in prior_ids(spark, output).collect())
    # Equal additions fold like the bits of a counter.
    assert len(log._finished()) <= 3


def test_a_large_entry_is_not_rewritten(spark, tmp_path):
    output = str(tmp_path / "results")
    log = IdLog(spark, output)
    add(output, "a.json", range(100))
    log.catch_up()
    add(output, "b.json", range(100, 103))
    log.catch_up()
    assert [(e.first, e.last, e.size) for e in log._finished()] == [(0, 0, 100), (1, 1, 3)]


def test_lost_and_changed_files(spark, tmp_path):
    output = str(tmp_path / "results")
    log = IdLog(spark, output)
    for name in "abc":
        add(output, f"{name}.json", [f"{name}{i}" for i in range(3)])
        log.catch_up()
    os.remove(f"{output}/b.json")
    assert ids_of(log) == ["a0", "a1", "a2", "c0", "c1", "c2"]
    time.sleep(0.01)
    add(output, "c.json", ["c9", "c10", "c11", "c12"])
    assert ids_of(log) == ["a0", "a1", "a2", "c10", "c11", "c12", "c9"]
    for name in "ac":
        os.remove(f"{output}/{name}.json")
    assert ids_of(log) == []
    add(output, "d.json", ["d"])
    assert ids_of(log) == ["d"]


def test_an_unfinished_addition_does_not_count(spark, tmp_path):
    output = str(tmp_path / "results")
    log = IdLog(spark, output)
    add(output, "a.json", [f"a{i}" for i in range(9)])
    log.catch_up()
    add(output, "b.json", ["b"])
    log.catch_up()
    for mark in glob.glob(f"{log.path}/entry=1-*/files/_SUCCESS"):
        os.remove(mark)
    assert [e.name for e in log._finished()] == ["entry=0-0-9"]
    assert [os.path.basename(p) for p in log.catch_up()] == ["b.json"]
    assert ids_of(log) == sorted([*(f"a{i}" for i in range(9)), "b"])


def test_odd_names_lines_and_fields(spark, tmp_path):
    output = str(tmp_path / "results")
    add(output, "part {x}[y]*.json", ["a", None, "a", 7])
    with open(f"{output}/part {{x}}[y]*.json", "a") as file:
        file.write('{"item_id": "other"}\n{bad\n[1]\n\n')
    add(output, "_hidden.json", ["h"])
    add(output, "empty.json", [])
    assert ids_of(IdLog(spark, output)) == ["7", "a", "other"]
    assert ids_of(IdLog(spark, output, ("item_id",))) == ["other"]


def test_an_output_that_is_one_file(spark, tmp_path):
    add(str(tmp_path), "results.json", ["a", "b"])
    assert ids_of(IdLog(spark, f"{tmp_path}/results.json")) == ["a", "b"]
