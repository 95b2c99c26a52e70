"""Objects of JSON arrays, cut by many tasks."""

import gzip
import json
import random

import pytest

from profilerank.schema import ID
from profilerank.sources import arrays, readers

ODD = ['{', '}', '"', '\\', '\\"', '[{"a":1}]', '},{', '\n', '\t', 'é😀', '', '\\\\', "]"]


@pytest.fixture
def small_splits(spark):
    """Files are cut every 2,000 bytes."""
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    yield spark
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def _objects(n, seed=3):
    rng = random.Random(seed)
    odd = lambda: "".join(rng.choice(ODD) for _ in range(rng.randint(0, 6)))
    out = [{"candidate_id": f"C{i}", "profile": {"headline": odd(), "summary": odd()}, odd(): [{"x": odd()}, [1, [odd()]], {}], "empty": {}, "n": None}
           for i in range(n)]
    out[n // 2]["long"] = [odd() for _ in range(4000)]  # over several splits
    out[n // 3]["braceless"] = "x" * 9000  # splits without a brace
    return out


@pytest.mark.parametrize("kind", ["compact", "lines", "indented", "bare", "gz"])
def test_objects_of_many_splits(small_splits, tmp_path, kind):
    spark, wanted = small_splits, _objects(120)
    whole = {"compact": json.dumps(wanted, separators=(",", ":")), "lines": "﻿[\n" + ",\n".join(json.dumps(w, ensure_ascii=False) for w in wanted) + "\n]\n",
             "indented": json.dumps(wanted, indent=2), "bare": "\n".join(json.dumps(w) for w in wanted), "gz": json.dumps(wanted)}[kind]
    path = tmp_path / ("a.json.gz" if kind == "gz" else "a.json")
    path.write_bytes(gzip.compress(whole.encode()) if kind == "gz" else whole.encode())
    found = [json.loads(r["value"]) for r in arrays.array_objects(spark, str(path)).collect()]
    assert sorted(found, key=lambda r: int(r["candidate_id"][1:])) == wanted
    if kind != "gz":
        tasks = arrays._segments(spark, str(path)).rdd.getNumPartitions()
        assert tasks > 10
    rows = readers.scan_pool(spark, str(path), array=True).select(ID, "profile.headline").collect()
    assert {r[ID]: r["headline"] for r in rows} == {w["candidate_id"]: w["profile"]["headline"] for w in wanted}


def test_several_files_and_empty_ones(small_splits, tmp_path):
    parts = [_objects(30, 1), [], _objects(1, 2), [{}, {"a": {}}]]
    for i, part in enumerate(parts):
        (tmp_path / f"{i}.json").write_text(json.dumps(part))
    (tmp_path / "none.json").write_text("")
    found = [json.loads(r["value"]) for r in arrays.array_objects(small_splits, str(tmp_path)).collect()]
    assert sorted(map(json.dumps, found)) == sorted(json.dumps(w) for part in parts for w in part)


def test_broken_arrays_are_refused(small_splits, tmp_path):
    whole = json.dumps(_objects(60))
    for name, text in {"cut": whole[:len(whole) // 2], "open": whole[:-1], "between": whole.replace('}, {"candidate_id": "C20"', '}, oops {"candidate_id": "C20"'),
                       "inner": whole.replace('"n": null', '"n": nul', 1)}.items():
        path = tmp_path / f"{name}.json"
        path.write_text(text)
        with pytest.raises(Exception, match="not JSON"):
            readers.scan_pool(small_splits, str(path)).count()
        assert readers.scan_pool(small_splits, str(path), check=False).count() >= 29, name


def test_changed_splits_are_noticed(small_splits, tmp_path):
    path = tmp_path / "a.json"
    path.write_text(json.dumps(_objects(60)))
    rows = arrays._segments(small_splits, str(path)).mapInArrow(arrays._cut({}), "file string, owner bigint, block bigint, value string")
    with pytest.raises(Exception, match="have changed since"):
        rows.collect()
