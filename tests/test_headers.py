"""CSV streams whose header changes from file to file."""

import os

from paysignal.streaming import bronze


def put(folder, name, text):
    os.makedirs(folder.replace("file:", "", 1), exist_ok=True)
    with open(f"{folder}/{name}".replace("file:", "", 1), "w", encoding="utf-8") as fh:
        fh.write(text)


def run(spark, tmp_dir, **kw):
    done = bronze.run_bronze(spark, f"{tmp_dir}/in", f"{tmp_dir}/bronze", f"{tmp_dir}/ckpt", by_own_header=True, state_store="memory", **kw)
    rows = spark.read.parquet(f"{tmp_dir}/bronze").collect()
    return done, {r.transaction_id: r for r in rows}


def test_every_file_by_its_own_header(spark, tmp_dir):
    src = f"{tmp_dir}/in"
    put(src, "a.csv", "transaction_id,amount,status\nA,1.5,SUCCESS\n")
    put(src, "b.csv", '﻿ Status ,note,AMOUNT,transaction_id\nFAILED,"x, y",2.5,B\nFAILED,,,B2\n')
    _, got = run(spark, tmp_dir)
    assert (got["A"].amount, got["A"].status) == ("1.5", "SUCCESS") and (got["B"].amount, got["B"].status) == ("2.5", "FAILED")
    assert got["B2"].amount is None and got["A"].user_id is None and got["B"]._source_file.endswith("b.csv")
    put(src, "c.csv", "user_id,transaction_id\nu,C\n\nu,A\n")  # A came before
    put(src, "d.csv", "transaction_id\n")  # no rows
    done, got = run(spark, tmp_dir, max_files_per_trigger=1)
    assert got["C"].user_id == "u" and got["A"].user_id is None and len(got) == 4 and done["rows"] == 2


def test_header_is_found_in_files_of_many_splits(spark, tmp_dir):
    rows = "".join(f"u{i},T{i}\n" for i in range(3000))
    put(f"{tmp_dir}/in", "a.csv", "user_id,transaction_id\n" + rows)
    put(f"{tmp_dir}/in", "b.csv", "transaction_id,user_id\nX,ux\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        _, got = run(spark, tmp_dir)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(got) == 3001 and all(r.user_id == "u" + t.replace("T", "").replace("X", "x") for t, r in got.items())
