"""Synthetic payment data as Spark jobs (G1-G9), reproducible from a seed.

Every random choice is ``xxhash64(key, seed, salt)`` of the row's own key,
so output does not depend on partitioning, task retries or executor count,
and the work is spread like the input: customers are derived one per row of
a customer table, normal transactions one per row of an event table, and
the planted fraud clusters are seeded by a distributed top-k over hashed
profiles. ``fixture`` rebuilds the deterministic 4,980 + 20 row test fixture
from ``spark.range``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paysignal.schema import CUSTOMER_COLUMNS, RAW_COLUMNS

# Category, bank, city, failure-reason and VPA-suffix lists and
# the KYC weights (70 / 20 / 10) of the synthetic generator.
MERCHANT_CATEGORIES = (
    "grocery", "food_delivery", "utility", "electronics", "travel", "fashion",
    "healthcare", "education", "gaming", "fuel", "marketplace", "subscription",
)
BANKS = ("sbi", "hdfc", "icici", "axis", "kotak", "bob", "pnb", "canara")
CITIES = (
    "Mumbai", "Delhi", "Bengaluru", "Hyderabad", "Chennai", "Pune",
    "Kolkata", "Ahmedabad", "Jaipur", "Lucknow", "Surat", "Indore",
)
FAILURE_REASONS = ("insufficient_balance", "invalid_upi_pin", "beneficiary_not_found", "bank_timeout", "daily_limit_exceeded")
VPA_SUFFIXES = ("upi", "pay", "bank", "wallet", "secure")
KYC_WEIGHTS = (("FULL_KYC", 70), ("MIN_KYC", 20), ("PENDING", 10))

# Fixed values of the deterministic fixture.
FIXTURE_CITIES = ("Mumbai", "Delhi", "Bengaluru", "Hyderabad", "Pune", "Chennai", "Kolkata", "Jaipur")
FIXTURE_MERCHANTS = ("Retail", "Food", "Travel", "Utilities", "Gaming", "Healthcare")


def _h(seed: int, salt: str, *keys) -> Column:
    """Non-negative 63-bit hash of the keys, seed and a salt."""
    return F.abs(F.xxhash64(*keys, F.lit(int(seed)), F.lit(salt)) % F.lit(2**62))


def _pick(values, h: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (h % len(values) + 1).cast("int"))


def _hex(seed: int, salt: str, key: Column, n: int = 12) -> Column:
    return F.substring(F.sha2(F.concat_ws("|", key.cast("string"), F.lit(str(seed)), F.lit(salt)), 256), 1, n)


def customers(customer: DataFrame, seed: int = 42, as_of: str = "2024-02-01") -> DataFrame:
    """One profile per customer row (key ``c_custkey``): bank, city,
    device, KYC (weighted), effective date within a year before ``as_of``,
    sender VPA ``<first name>.<suffix>@<bank>``."""
    key = F.col("c_custkey")
    kyc_h = _h(seed, "kyc", key) % 100
    kyc = F.when(kyc_h < KYC_WEIGHTS[0][1], KYC_WEIGHTS[0][0]).when(
        kyc_h < KYC_WEIGHTS[0][1] + KYC_WEIGHTS[1][1], KYC_WEIGHTS[1][0]
    ).otherwise(KYC_WEIGHTS[2][0])
    bank = _pick(BANKS, _h(seed, "bank", key))
    first = F.lower(F.regexp_replace(F.split(F.col("c_name"), r"[ .#'-]+").getItem(0), r"[^A-Za-z0-9]", ""))
    first = F.when(first == "", F.lit("user")).otherwise(first)
    return customer.select(
        F.format_string("USR%08d", key + 1).alias("user_id"),
        F.col("c_name").alias("name"),
        bank.alias("bank"),
        kyc.alias("kyc_status"),
        F.concat(F.lit("dev-"), _hex(seed, "device", key)).alias("device_id"),
        _pick(CITIES, _h(seed, "city", key)).alias("location_city"),
        F.date_format(F.date_sub(F.lit(as_of).cast("date"), (_h(seed, "eff", key) % 366).cast("int")), "yyyy-MM-dd").alias(
            "effective_date"
        ),
        F.concat(first, F.lit("."), _pick(VPA_SUFFIXES, _h(seed, "vpa", key)), F.lit("@"), bank).alias("sender_vpa"),
    )


def _record(key: Column, seed: int, ts: Column, amount: Column, city: Column, device: Column, status: Column,
            reason: Column, merchant: Column) -> list[Column]:
    """The 13 raw string columns in their fixed order."""
    return [
        F.concat(F.lit("TXN-"), F.upper(_hex(seed, "txn", key, 18))).alias("transaction_id"),
        F.concat(F.lit("UTR"), F.date_format(ts, "yyyyMMddHHmmss"), F.upper(_hex(seed, "utr", key, 10))).alias("utr_number"),
        F.col("user_id"),
        F.date_format(ts, "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
        F.format_string("%.2f", amount).alias("amount"),
        F.col("sender_vpa"),
        F.concat(F.lit("merchant"), (_h(seed, "rcv", key) % 1000).cast("string"), F.lit("@"), _pick(BANKS, _h(seed, "rbank", key))).alias(
            "receiver_vpa"
        ),
        merchant.alias("merchant_category"),
        city.alias("location_city"),
        device.alias("device_id"),
        F.concat_ws(".", *[((_h(seed, f"ip{i}", key) % 255) + 1).cast("string") for i in range(4)]).alias("ip_address"),
        status.alias("status"),
        reason.alias("failure_reason"),
    ]


def normal_transactions(events: DataFrame, profiles: DataFrame, seed: int = 42, as_of: str = "2024-02-01") -> DataFrame:
    """One transaction per event row, for the profile whose customer key
    equals the event's user_id (modulo the profile count is not needed: the
    join drops events without a profile). 30-day spread before ``as_of``,
    93 / 7 success / failure, amount 10-25,000, 15 % another city, 12 % a
    new device."""
    ev = events.select(F.col("event_id").alias("_k"), F.format_string("USR%08d", F.col("user_id") + 1).alias("user_id"))
    joined = ev.join(profiles, on="user_id", how="inner")
    key = F.col("_k")
    secs = _h(seed, "when", key) % (30 * 86400 + 86400)
    ts = F.lit(as_of).cast("timestamp") - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), secs.cast("decimal(18,6)"))
    failed = (_h(seed, "status", key) % 100) < 7
    city = F.when((_h(seed, "move", key) % 100) < 15, _pick(CITIES, _h(seed, "city2", key))).otherwise(F.col("location_city"))
    device = F.when((_h(seed, "newdev", key) % 100) < 12, F.concat(F.lit("dev-"), _hex(seed, "dev2", key))).otherwise(
        F.col("device_id")
    )
    amount = F.lit(10.0) + (_h(seed, "amt", key) % 2499001) / F.lit(100.0)
    return joined.select(
        *_record(
            key, seed, ts, amount, city, device,
            F.when(failed, "FAILED").otherwise("SUCCESS"),
            F.when(failed, _pick(FAILURE_REASONS, _h(seed, "why", key))).otherwise(F.lit("")),
            _pick(MERCHANT_CATEGORIES, _h(seed, "mcc", key)),
        )
    )


def planted_clusters(profiles: DataFrame, seed: int = 42, as_of: str = "2024-02-01", each: int = 8) -> DataFrame:
    """``each`` clusters of every kind for hash-chosen profiles.

    velocity: 6 rows 8 s apart, 8,500-11,000 each; geo: 2 rows 4 min apart in
    two cities; mule: 3 profiles on one new device 3 min apart; brute force:
    5 FAILED then a SUCCESS at 1-minute steps."""
    k = int(each)
    base = F.lit(as_of).cast("timestamp")

    def chosen(kind: str, n: int) -> DataFrame:
        # distributed top-n by hash (TakeOrderedAndProject), then a rank over n rows
        pick = profiles.withColumn("_o", _h(seed, kind, F.col("user_id"))).orderBy("_o").limit(n)
        return pick.withColumn("_c", F.row_number().over(Window.orderBy("_o")) - 1)

    def start(kind: str) -> Column:
        secs = ((_h(seed, kind + "t", F.col("_c")) % 20) + 1) * 86400 + (_h(seed, kind + "h", F.col("_c")) % 21) * 3600
        return base - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), secs.cast("decimal(18,6)"))

    def at(t0: Column, seconds: Column) -> Column:
        return t0 + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds.cast("decimal(18,6)"))

    def rows(df: DataFrame, kind: str, count: int, ts, amount, city, device, status, reason) -> DataFrame:
        d = df.withColumn("_i", F.explode(F.sequence(F.lit(0), F.lit(count - 1))))
        key = F.concat_ws(":", F.lit(kind), F.col("_c").cast("string"), F.col("_i").cast("string"))
        merchant = _pick(MERCHANT_CATEGORIES, _h(seed, kind + "m", key))
        return d.withColumn("_t0", start(kind)).select(
            *_record(key, seed, ts(key), amount(key), city(key), device(key), status(key), reason(key), merchant)
        )

    i = F.col("_i")
    succ, empty = (lambda key: F.lit("SUCCESS")), (lambda key: F.lit(""))
    velocity = rows(
        chosen("velocity", k), "velocity", 6, lambda key: at(F.col("_t0"), i * 8),
        lambda key: F.lit(8500.0) + (_h(seed, "va", key) % 250001) / F.lit(100.0),
        lambda key: F.col("location_city"), lambda key: F.col("device_id"), succ, empty,
    )
    geo = rows(
        chosen("geo", k), "geo", 2, lambda key: at(F.col("_t0"), i * 240),
        lambda key: F.lit(100.0) + (_h(seed, "ga", key) % 390001) / F.lit(100.0),
        lambda key: _pick(CITIES, _h(seed, "gc", F.col("_c").cast("string")) + i * (1 + _h(seed, "gs", F.col("_c")) % (len(CITIES) - 1))),
        lambda key: F.col("device_id"), succ, empty,
    )
    brute = rows(
        chosen("brute", k), "brute", 6, lambda key: at(F.col("_t0"), i * 60),
        lambda key: F.lit(100.0) + (_h(seed, "ba", key) % 40001) / F.lit(100.0),
        lambda key: F.col("location_city"), lambda key: F.col("device_id"),
        lambda key: F.when(i < 5, "FAILED").otherwise("SUCCESS"),
        lambda key: F.when(i < 5, _pick(FAILURE_REASONS, _h(seed, "br", key))).otherwise(F.lit("")),
    )
    mule_profiles = chosen("mule", 3 * k).withColumn("_slot", F.col("_c") % 3).withColumn("_c", (F.col("_c") / 3).cast("long"))
    mule = mule_profiles.withColumn("_t0", start("mule")).select(
        *_record(
            F.concat_ws(":", F.lit("mule"), F.col("_c").cast("string"), F.col("_slot").cast("string")), seed,
            at(F.col("_t0"), F.col("_slot") * 180),
            F.lit(500.0) + (_h(seed, "ma", F.col("user_id"), F.col("_c")) % 650001) / F.lit(100.0),
            _pick(CITIES, _h(seed, "mc", F.col("user_id"), F.col("_c"))),
            F.concat(F.lit("dev-"), _hex(seed, "muledev", F.col("_c"))),
            F.lit("SUCCESS"), F.lit(""),
            _pick(MERCHANT_CATEGORIES, _h(seed, "mm", F.col("user_id"), F.col("_c"))),
        )
    )
    return velocity.unionByName(geo).unionByName(brute).unionByName(mule)


def transactions(
    events: DataFrame,
    customer: DataFrame,
    seed: int = 42,
    as_of: str = "2024-02-01",
    clusters_each: int = 8,
    total_rows: int | None = None,
) -> DataFrame:
    """Normal rows followed by the planted clusters (all raw strings).

    By default one normal row per event row. With ``total_rows`` the output
    has exactly that many rows (when the events suffice): the planted rows
    (first ``total_rows`` of them if fewer) plus the normal rows with the
    smallest transaction ids - a deterministic choice."""
    profiles = customers(customer, seed, as_of)
    normal = normal_transactions(events, profiles, seed, as_of)
    planted = planted_clusters(profiles, seed, as_of, clusters_each)
    if total_rows is not None:
        injected = (6 + 2 + 6 + 3) * int(clusters_each)  # velocity + geo + brute force + mule rows
        planted = planted.orderBy("transaction_id").limit(min(int(total_rows), injected))
        normal = normal.orderBy("transaction_id").limit(max(int(total_rows) - injected, 0))
    return normal.unionByName(planted).select(*RAW_COLUMNS)


def customer_rows(customer: DataFrame, seed: int = 42, as_of: str = "2024-02-01") -> DataFrame:
    """The customer snapshot file's columns in their fixed order."""
    return customers(customer, seed, as_of).select(*CUSTOMER_COLUMNS)


def write_dataset(df: DataFrame, path: str) -> int:
    """CSV with header in the fixed column order; returns rows written
    (counted by an ``Observation`` during the write, no second pass)."""
    from pyspark.sql import Observation

    obs = Observation("rows")
    df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("errorifexists").option("header", True).csv(path)
    return int(obs.get["rows"])


def fixture(spark: SparkSession, unique_rows: int = 4980) -> DataFrame:
    """G1 + T2: the deterministic raw fixture (typed timestamp, double amount):
    ``unique_rows`` rows 17 s apart from 2026-08-30 09:00:00, four planted
    clusters, then the first 20 rows again."""
    i = F.col("id")
    start = F.lit("2026-08-30 09:00:00").cast("timestamp")

    def secs(x: Column) -> Column:
        return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), x.cast("decimal(18,6)"))

    def at(hms: str, offset: Column) -> Column:
        return F.lit(f"2026-08-30 {hms}").cast("timestamp") + secs(offset)

    vel = (i >= 50) & (i <= 55) & F.lit(unique_rows >= 56)
    geo = i.isin(100, 101) & F.lit(unique_rows >= 102)
    mule = i.isin(120, 121, 122) & F.lit(unique_rows >= 123)
    brute = (i >= 130) & (i <= 135) & F.lit(unique_rows >= 136)
    user = (
        F.when(vel, "USR_VELOCITY").when(geo, "USR_GEO")
        .when(mule, F.concat(F.lit("USR_MULE_"), F.element_at(F.array(*[F.lit(c) for c in "ABC"]), (i - 119).cast("int"))))
        .when(brute, "USR_BRUTE").otherwise(F.format_string("USR%06d", i % 850))
    )
    ts = (
        F.when(vel, at("12:00:00", (i - 50) * 8)).when(geo, at("13:00:00", (i - 100) * 240))
        .when(mule, at("14:00:00", (i - 120) * 180)).when(brute, at("15:00:00", (i - 130) * 60))
        .otherwise(start + secs(i * 17))
    )
    amount = F.when(vel, (F.lit(9500) + (i - 50) * 100).cast("double")).otherwise(((i * 7919) % 34991 + 10).cast("double"))
    city = F.when(geo, F.when(i == 100, "Mumbai").otherwise("Delhi")).when(brute, "Pune").otherwise(
        F.element_at(F.array(*[F.lit(c) for c in FIXTURE_CITIES]), (i % 8 + 1).cast("int"))
    )
    failed = F.when(brute, i < 135).otherwise(i % 31 == 0)
    rows = spark.range(unique_rows).select(
        i.alias("_i"),
        F.format_string("TXN-%08d", i).alias("transaction_id"),
        F.format_string("UTR-%08d", i).alias("utr_number"),
        user.alias("user_id"),
        ts.alias("timestamp"),
        amount.alias("amount"),
        F.format_string("user%04d@syntheticupi", i % 850).alias("sender_vpa"),
        F.format_string("merchant%03d@syntheticbank", i % 30).alias("receiver_vpa"),
        F.element_at(F.array(*[F.lit(m) for m in FIXTURE_MERCHANTS]), (i % 6 + 1).cast("int")).alias("merchant_category"),
        city.alias("location_city"),
        F.when(mule, F.lit("dev-MULE")).otherwise(F.format_string("dev-%04d", i % 120)).alias("device_id"),
        F.format_string("10.%d.%d.%d", i % 200 + 1, (i * 3) % 250 + 1, (i * 7) % 250 + 1).alias("ip_address"),
        F.when(failed, "FAILED").otherwise("SUCCESS").alias("status"),
        F.when(failed, "invalid_upi_pin").otherwise("").alias("failure_reason"),
    )
    return rows.unionByName(rows.filter(F.col("_i") < 20)).drop("_i")
