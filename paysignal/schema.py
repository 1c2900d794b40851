"""Declared schemas: raw edge is all strings, typed after standardisation."""

from __future__ import annotations

from pyspark.sql import types as T

# Raw transaction column order and the customer snapshot order.
RAW_COLUMNS = (
    "transaction_id",
    "utr_number",
    "user_id",
    "timestamp",
    "amount",
    "sender_vpa",
    "receiver_vpa",
    "merchant_category",
    "location_city",
    "device_id",
    "ip_address",
    "status",
    "failure_reason",
)
CUSTOMER_COLUMNS = ("user_id", "name", "bank", "kyc_status", "device_id", "location_city", "effective_date")
# Columns the dashboard reader requires (missing ones are added as NULL).
REQUIRED_COLUMNS = (
    "transaction_id",
    "user_id",
    "timestamp",
    "amount",
    "merchant_category",
    "location_city",
    "device_id",
    "status",
)
# The dimension's columns, in order.
DIM_COLUMNS = (
    "user_id",
    "name",
    "bank",
    "kyc_status",
    "device_id",
    "location_city",
    "effective_start_date",
    "effective_end_date",
    "is_current",
    "record_hash",
)

RAW = T.StructType([T.StructField(c, T.StringType(), True) for c in RAW_COLUMNS])

TYPED = T.StructType(
    [
        T.StructField("transaction_id", T.StringType()),
        T.StructField("utr_number", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("sender_vpa", T.StringType()),
        T.StructField("receiver_vpa", T.StringType()),
        T.StructField("merchant_category", T.StringType()),
        T.StructField("location_city", T.StringType()),
        T.StructField("device_id", T.StringType()),
        T.StructField("ip_address", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("failure_reason", T.StringType()),
    ]
)

CUSTOMER_RAW = T.StructType([T.StructField(c, T.StringType(), True) for c in CUSTOMER_COLUMNS])

CUSTOMER = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("bank", T.StringType()),
        T.StructField("kyc_status", T.StringType()),
        T.StructField("device_id", T.StringType()),
        T.StructField("location_city", T.StringType()),
    ]
)

DIM = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("bank", T.StringType()),
        T.StructField("kyc_status", T.StringType()),
        T.StructField("device_id", T.StringType()),
        T.StructField("location_city", T.StringType()),
        T.StructField("effective_start_date", T.DateType()),
        T.StructField("effective_end_date", T.DateType()),
        T.StructField("is_current", T.BooleanType()),
        T.StructField("record_hash", T.StringType()),
    ]
)
