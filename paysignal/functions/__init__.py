from paysignal.functions.columns import (
    cents,
    coalesce_false,
    inr_text,
    investigation_status,
    money,
    present,
    record_hash,
    risk_level,
    round_ratio,
    unix_seconds,
)

__all__ = [
    "cents",
    "coalesce_false",
    "inr_text",
    "investigation_status",
    "money",
    "present",
    "record_hash",
    "risk_level",
    "round_ratio",
    "unix_seconds",
]
