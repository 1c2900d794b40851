"""SCD2: reference case, invariants, no-op, name-only changes, NULL attributes."""

import datetime as dt

from pyspark.sql import functions as F

from paysignal.operators import scd2
from paysignal.schema import CUSTOMER, DIM
from paysignal.sources.storage import TableStore


def dim_rows(spark, rows):
    return spark.createDataFrame(rows, DIM)


def src(spark, rows):
    return spark.createDataFrame(rows, CUSTOMER)


def test_reference_change_expire_and_insert(spark):
    current = dim_rows(spark, [("U1", "Alice", "sbi", "FULL_KYC", "dev-1", "Mumbai", dt.date(2025, 7, 1), None, True, "oldhash")])
    source = src(spark, [("U1", "Alice", "sbi", "FULL_KYC", "dev-2", "Delhi")])
    ch = scd2.detect_changes(source, current, "2025-08-01")
    assert scd2.expire_set(ch).count() == 1 and scd2.insert_set(ch).count() == 1


def base_dim(spark):
    s0 = src(spark, [
        ("U1", "Alice", "sbi", "FULL_KYC", "dev-1", "Mumbai"),
        ("U2", "Bob", "hdfc", "MIN_KYC", "dev-2", "Pune"),
        ("U3", "Cid", "axis", "PENDING", None, "Delhi"),
        ("U4", "Dee", "kotak", "FULL_KYC", "dev-4", "Jaipur"),
    ])
    return scd2.initialize(s0, "2025-01-01")


def test_apply_semantics(spark):
    dim0 = base_dim(spark)
    s1 = src(spark, [
        ("U1", "Alice", "sbi", "FULL_KYC", "dev-9", "Mumbai"),  # device change -> new version
        ("U2", "Robert", "hdfc", "MIN_KYC", "dev-2", "Pune"),  # name only -> no version
        ("U3", "Cid", "axis", "PENDING", None, "Delhi"),  # NULL attribute unchanged
        ("U5", "Eve", "pnb", "MIN_KYC", "dev-5", "Surat"),  # new user
    ])  # U4 missing -> not expired
    dim1 = scd2.apply(dim0, s1, "2025-02-01").cache()
    rows = {(r.user_id, r.is_current): r for r in dim1.collect()}
    assert dim1.count() == 6
    assert rows[("U1", False)].effective_end_date == dt.date(2025, 2, 1)
    assert rows[("U1", True)].device_id == "dev-9" and rows[("U1", True)].effective_start_date == dt.date(2025, 2, 1)
    assert rows[("U2", True)].name == "Bob" and rows[("U4", True)].effective_end_date is None
    assert rows[("U5", True)].effective_end_date is None
    # invariants: one current row per user, versions do not overlap
    assert dim1.filter("is_current").groupBy("user_id").count().filter("count > 1").count() == 0
    assert dim1.filter("effective_end_date < effective_start_date").count() == 0
    # second apply of the same snapshot is a no-op
    assert not scd2.has_changes(s1, dim1, "2025-03-01")
    dim2 = scd2.apply(dim1, s1, "2025-03-01")
    assert sorted(map(tuple, dim2.collect())) == sorted(map(tuple, dim1.collect()))
    dim1.unpersist()


def test_same_day_change_and_duplicate_source_rows(spark):
    dim0 = base_dim(spark)
    s1 = src(spark, [("U4", "Dee", "kotak", "FULL_KYC", "dev-4", "Agra"), ("U4", "Dee", "kotak", "FULL_KYC", "dev-4", "Agra")])
    dim1 = scd2.apply(dim0, s1, "2025-01-01")
    old = dim1.filter((F.col("user_id") == "U4") & ~F.col("is_current")).first()
    assert old.effective_start_date == old.effective_end_date == dt.date(2025, 1, 1)
    assert dim1.filter((F.col("user_id") == "U4") & F.col("is_current")).count() == 1


def test_record_hash_matches_definition(spark):
    r = scd2.initialize(src(spark, [("U1", "A", "sbi", "FULL_KYC", "dev-1", None)]), "2025-01-01").first()
    import hashlib

    assert r.record_hash == hashlib.sha256("dev-1||||sbi||FULL_KYC".encode()).hexdigest()


def test_versioned_store_never_overwrites_current(spark, tmp_dir):
    store = TableStore(spark, tmp_dir)
    dim0 = base_dim(spark)
    assert store.write("dim", dim0) == 1
    nxt = scd2.apply(store.read("dim"), src(spark, [("U1", "Alice", "sbi", "FULL_KYC", "dev-7", "Mumbai")]), "2025-02-01")
    assert store.write("dim", nxt) == 2
    assert store.read("dim", 1).count() == 4 and store.read("dim").count() == 5
    assert store.versions("dim") == [1, 2]


def test_empty_dimension_and_source(spark):
    empty = scd2.empty_dim(spark)
    s = src(spark, [("U1", "A", "b", "c", "d", "e")])
    assert scd2.apply(empty, s, "2025-01-01").count() == 1
    assert scd2.apply(base_dim(spark), spark.createDataFrame([], CUSTOMER), "2025-01-01").count() == 4
