"""Parameters for the fraud rules and the data-quality profiles.

Thresholds and the as-of time are always parameters; nothing reads the wall
clock unless the caller leaves ``as_of`` unset.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

# Fixed values (must equal the behaviour being rebuilt): rule names in their
# declared order, their score weights, the score cap, and the display labels.
RULE_NAMES = ("velocity_check", "geo_anomaly", "device_mule_check", "failure_burst_check")
RULE_WEIGHTS = {"velocity_check": 40, "geo_anomaly": 25, "device_mule_check": 40, "failure_burst_check": 35}
RULE_LABELS = {
    "velocity_check": "Velocity check",
    "geo_anomaly": "Geo anomaly",
    "device_mule_check": "Device mule check",
    "failure_burst_check": "Failure burst check",
}
NO_RULE_LABEL = "No rule triggered"
SCORE_CAP = 100


@dataclass(frozen=True)
class RuleConfig:
    """Windows (seconds) and limits of the four fraud rules.

    ``bucket_seconds`` is the time slice used to split every user / device
    partition into independent window tasks (see ``operators.rules``). ``None``
    picks ``max(8 * (lookback + lookahead), 3600)`` per stage. Slices of hot
    keys are split further (``split_hot_cells``).
    """

    velocity_window_s: int = 60
    velocity_limit: float = 50000.0
    geo_window_s: int = 300
    mule_window_s: int = 600
    mule_users: int = 3
    burst_failures: int = 5
    burst_window_s: int = 600
    weights: dict = field(default_factory=lambda: dict(RULE_WEIGHTS))
    cap: int = SCORE_CAP
    bucket_seconds: int | None = None
    # Hot cells: a (key, slice) with more than ``hot_cell_rows`` rows is cut
    # into up to ``max_split`` sub-slices. The counting pre-pass runs only when
    # the input's estimated size reaches ``split_min_input_bytes``.
    split_hot_cells: bool = True
    hot_cell_rows: int = 2_000_000
    max_split: int = 64
    split_min_input_bytes: int = 1 << 30

    def with_(self, **kw) -> "RuleConfig":
        return replace(self, **kw)

    @property
    def user_lookback_s(self) -> int:
        return max(self.velocity_window_s, self.geo_window_s, self.burst_window_s)

    @property
    def user_lookahead_s(self) -> int:
        return self.geo_window_s

    def bucket_for(self, lookback: int, lookahead: int) -> int:
        if self.bucket_seconds:
            return int(self.bucket_seconds)
        return max(8 * (lookback + lookahead), 3600)


# Query-time configuration used on the driver's ``events`` table: with the
# reference thresholds velocity and burst never fire there, so the registered
# queries use these (SURVEY 7.2, "config A").
CONFIG_A = RuleConfig(
    velocity_window_s=21600,
    velocity_limit=200.0,
    geo_window_s=3600,
    mule_window_s=43200,
    mule_users=3,
    burst_failures=3,
    burst_window_s=172800,
)


@dataclass(frozen=True)
class QualityProfile:
    """Which data-quality rules run and how strict they are.

    ``strict``  - the 15 Spark rules (lower-cased VPA, ``%+`` allowed,
                  empty-string ids are valid, IP shape and amount range checked).
    ``lenient`` - the 13 dashboard rules (case-sensitive VPA without ``%+``,
                  empty strings count as missing, no IP / amount-range rule).
    """

    name: str
    rules: tuple
    vpa_pattern: str
    vpa_lowercase: bool
    empty_is_null: bool


# Rule names in declared order and the VPA / IP patterns.
STRICT_RULES = (
    "transaction_id_not_null",
    "utr_not_null",
    "utr_unique",
    "amount_positive",
    "sender_vpa_valid",
    "receiver_vpa_valid",
    "timestamp_not_future",
    "user_id_not_null",
    "status_valid",
    "failure_reason_valid",
    "device_id_not_null",
    "ip_address_valid",
    "merchant_category_not_null",
    "location_city_not_null",
    "amount_reasonable",
)
LENIENT_RULES = (
    "transaction_id_not_null",
    "utr_number_not_null",
    "amount_positive",
    "sender_vpa_valid",
    "receiver_vpa_valid",
    "timestamp_not_future",
    "user_id_not_null",
    "status_valid",
    "failure_reason_valid",
    "device_id_not_null",
    "merchant_category_not_null",
    "location_city_not_null",
    "utr_unique",
)
STRICT_VPA = r"^[a-z0-9._%+-]+@[a-z0-9.-]+$"
LENIENT_VPA = r"^[A-Za-z0-9._-]+@[A-Za-z0-9.-]+$"
IP_SHAPE = r"^(\d{1,3}\.){3}\d{1,3}$"
VALID_STATUSES = ("SUCCESS", "FAILED")
AMOUNT_MIN, AMOUNT_MAX = 0.01, 1_000_000

STRICT = QualityProfile("strict", STRICT_RULES, STRICT_VPA, vpa_lowercase=True, empty_is_null=False)
LENIENT = QualityProfile("lenient", LENIENT_RULES, LENIENT_VPA, vpa_lowercase=False, empty_is_null=True)
