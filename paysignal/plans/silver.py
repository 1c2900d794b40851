"""Bronze -> Silver / Quarantine as lazy DataFrames (no writes here).

Two orders exist (X1):

* ``dedup_first=True``  (notebook order): repeats are dropped by
  transaction_id first, then validated, so one copy of a repeated row
  survives.
* ``dedup_first=False`` (dashboard order): rules run on the raw rows, so
  every copy of a repeated row fails ``utr_unique``; valid rows are then
  deduplicated.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paysignal.config import STRICT, QualityProfile
from paysignal.operators import dedup, quality
from paysignal.operators.standardize import standardize

SILVER_COLUMNS = (
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


@dataclass
class SilverFrames:
    checked: DataFrame
    silver: DataFrame
    quarantine: DataFrame


def build(
    bronze: DataFrame,
    profile: QualityProfile = STRICT,
    as_of=None,
    dedup_first: bool = True,
    standardise: bool | None = None,
) -> SilverFrames:
    """Validate Bronze rows and split them. ``standardise`` defaults to True
    for the lenient (dashboard) profile, which expects standardised input."""
    if standardise is None:
        standardise = profile.empty_is_null
    rows = standardize(bronze) if standardise else bronze
    if dedup_first:
        typed = rows.withColumn("timestamp", quality._ts(rows))
        rows = dedup.keep_first(typed)
    checked = quality.add_quality_rules(rows, profile, as_of)
    valid, invalid = quality.split_valid_invalid(checked)
    if not dedup_first:
        # only the data columns go through the reduce: every valid row has the same flags
        valid = dedup.keep_first(valid.drop(*profile.rules, *quality.DQ_COLUMNS))
    silver = valid.withColumn("status", F.upper("status"))
    return SilverFrames(checked, silver, invalid)
