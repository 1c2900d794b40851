"""JSON documents read in byte ranges equal the documents parsed whole."""

import json
import os
import random

import pytest

from paysignal.schema import RAW
from paysignal.sources import files
from pyspark.sql import types as T

SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in ("transaction_id", "note", "more")])


def put(folder, name, text):
    folder = folder.replace("file:", "", 1)
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w", encoding="utf-8") as fh:
        fh.write(text)


def records(seed, n):
    rnd = random.Random(seed)
    odd = ['}', '{', '"', "\\", "[", "]", "},{", "é", "\n", " ", "x" * 30, '\\"}', ","]
    word = lambda: "".join(rnd.choices(odd, k=rnd.randint(0, 6)))
    return [{"transaction_id": f"T{seed}-{i}", "note": word(), "more": {"a": word(), "b": [{"c": word()}, [], {}]}} for i in range(n)]


@pytest.mark.parametrize("split", [64, 1000, 1 << 20])
def test_byte_ranges_equal_the_whole_parse(spark, tmp_dir, split):
    base = f"{tmp_dir}/{split}"
    want = {}
    for k, (before, after, indent) in enumerate([("[", "]", None), ('{"data": ', "}", None), ('﻿ {\n"transactions" : ', "\n}\n", 1), ("[", "]\n\n", 2)]):
        mine = records(k, 40)
        text = json.dumps(mine, indent=indent, ensure_ascii=bool(k % 2))
        put(base, f"{k}.json", before + text[1:-1] + after if before == "[" else before + text + after)
        want |= {r["transaction_id"]: r for r in mine}
    put(base, "none.json", "[]")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    try:
        got = {r.transaction_id: r for r in files.read_json_array(spark, base, SCHEMA).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert set(got) == set(want)
    assert all(got[k].note == want[k]["note"] and json.loads(got[k].more) == want[k]["more"] for k in want)


def test_large_documents_are_read_in_ranges_and_other_shapes_raise(spark, tmp_dir, monkeypatch):
    put(tmp_dir, "a.json", json.dumps([{"transaction_id": "A"}, {"transaction_id": "B"}]))
    monkeypatch.setattr(files, "LARGE_DOCUMENT", 10)
    taken = []
    array = files.read_json_array
    monkeypatch.setattr(files, "read_json_array", lambda *a: taken.append(1) or array(*a))
    assert sorted(r.transaction_id for r in files.read_table(spark, f"{tmp_dir}/a.json", schema=RAW).collect()) == ["A", "B"] and taken
    put(f"{tmp_dir}/other", "b.json", json.dumps({"transaction_id": {"x": 1}, "y": 2}))
    with pytest.raises(Exception, match="not an array of records"):
        array(spark, f"{tmp_dir}/other", RAW).collect()


def test_many_byte_ranges_are_few_tasks(spark, tmp_dir):
    mine = records(9, 200)
    put(f"{tmp_dir}/ranges", "a.json", json.dumps({"data": mine}))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200")
    tasks, tracker = [], spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("ranges", "ranges")
    try:
        assert spark.read.text(f"{tmp_dir}/ranges").rdd.getNumPartitions() > 50
        assert files.read_json_array(spark, f"{tmp_dir}/ranges", SCHEMA).count() == 200
        for job in tracker.getJobIdsForGroup("ranges"):
            stages = [tracker.getStageInfo(s) for s in tracker.getJobInfo(job).stageIds]
            tasks += [s.numTasks for s in stages if s is not None]
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert tasks and max(tasks) <= 16
