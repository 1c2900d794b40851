"""The investigator view's layers as one bundle of lazy DataFrames (E5).

``build_bundle`` standardises a source frame, applies a quality profile
(dashboard default: the 13 lenient rules, then keep-first dedup of valid
rows), scores the Silver rows, and takes Gold from a stored scored output
when one exists (S8) or from the scores. Provenance (labels, notes, refresh
time, which stored outputs exist) is plain metadata; no rows are collected.

A layer is planned when it is first asked for. On a large source the Silver rows
are written to the shared folder once, since scoring reads them several times
(``rules.score`` counts hot cells first), and the plan up to them is not run again
each time.
"""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paysignal.config import LENIENT, RULE_NAMES, QualityProfile, RuleConfig
from paysignal.functions.columns import coalesce_false, round_ratio
from paysignal.operators import dedup, gold, quality, rules
from paysignal.operators.keys import SMALL_INPUT_BYTES, is_small
from paysignal.operators.standardize import standardize
from paysignal.session import shared_dir
from paysignal.sources import files
from paysignal.sources.storage import TableStore

FALLBACK_LABEL = "Built-in fixture"


@dataclass
class Bundle:
    bronze: DataFrame
    profile: QualityProfile
    cfg: RuleConfig
    source_label: str
    source_note: str
    refresh_timestamp: dt.datetime
    as_of: object = None
    label_style: str = "labels"
    stored: DataFrame | None = None
    stored_gold_detected: bool = False
    customer_scd2_available: bool = False
    notes: list = field(default_factory=list)

    @cached_property
    def _small(self) -> int:
        """The bound below which operators skip their counting jobs: one choice for all
        layers (half, as the checked rows read the source twice)."""
        return SMALL_INPUT_BYTES if is_small(self.bronze, SMALL_INPUT_BYTES // 2) else 0

    @cached_property
    def checked(self) -> DataFrame:
        return quality.add_quality_rules(self.bronze, self.profile, self.as_of, small_input_bytes=self._small)

    @cached_property
    def quarantine(self) -> DataFrame:
        return quality.split_valid_invalid(self.checked)[1]

    @cached_property
    def silver(self) -> DataFrame:
        rows = dedup.keep_first(quality.split_valid_invalid(self.checked)[0], small_input_bytes=self._small)
        if self._small or any(isinstance(f.dataType, T.NullType) for f in rows.schema.fields):  # Parquet has no such type
            return rows
        spark = rows.sparkSession
        path = shared_dir(spark, f"paysignal-bundle-{uuid.uuid4().hex[:12]}")
        rows.write.parquet(path)
        return spark.read.schema(rows.schema).parquet(path)

    @cached_property
    def scored(self) -> DataFrame:
        return rules.score(self.silver, self.cfg, label_style=self.label_style)

    @cached_property
    def gold(self) -> DataFrame:
        if self.stored is not None and "is_fraud" in self.stored.columns:
            return stored_scores(self.stored).filter(coalesce_false("is_fraud"))
        return gold.fraud_transactions(self.scored)


def build_bundle(
    source: DataFrame,
    source_label: str = "Uploaded file",
    source_note: str = "",
    as_of=None,
    cfg: RuleConfig | None = None,
    profile: QualityProfile = LENIENT,
    label_style: str = "labels",
    store: TableStore | None = None,
    gold_table: str = "fraud_scored_transactions",
    dim_table: str = "customer_device_scd2",
    precomputed: DataFrame | None = None,
    require_rows: bool = False,
) -> Bundle:
    """Layers for ``source``. ``require_rows`` (uploads) rejects an empty
    source with ``ValueError`` (one ``isEmpty`` job)."""
    if require_rows and source.isEmpty():
        raise ValueError("The source is empty.")
    notes = []
    table = precomputed
    if table is None and store is not None and store.exists(gold_table):
        table = store.read(gold_table)
    if table is not None and "is_fraud" in table.columns:
        notes.append("Fraud rows come from the stored Gold output.")
    refresh = dt.datetime.fromisoformat(str(as_of)) if as_of is not None else dt.datetime.now()
    return Bundle(
        bronze=standardize(source),
        profile=profile,
        cfg=cfg or RuleConfig(),
        source_label=source_label,
        source_note=" ".join([source_note, *notes]).strip(),
        refresh_timestamp=refresh,
        as_of=as_of,
        label_style=label_style,
        stored=table,
        stored_gold_detected=table is not None,
        customer_scd2_available=bool(store is not None and store.exists(dim_table)),
        notes=notes,
    )


SCORE_TYPES = {
    "transaction_date": "date",
    "velocity_amount_1m": "double",
    "device_users_10m": "int",
    **dict.fromkeys(RULE_NAMES, "boolean"),
    "risk_score": "int",
    "is_fraud": "boolean",
}


def stored_scores(table: DataFrame) -> DataFrame:
    """A stored scored output with standard names and types, whatever wrote it
    (from CSV all columns are text)."""
    out = standardize(table)
    return out.withColumns({c: F.col(c).try_cast(kind) for c, kind in SCORE_TYPES.items() if c in out.columns})


def bundle_from_root(spark: SparkSession, root: str, store: TableStore | None = None, **kw) -> Bundle:
    """The primary CSV, else the checked-in sample, else the
    deterministic fixture (G1) as an explicitly labelled fallback. S8: a
    precomputed ``fraud_transactions`` CSV / parquet under the root is
    preferred for Gold when it has ``is_fraud``."""
    from paysignal.operators.generator import fixture

    path, label = files.resolve_source(
        spark,
        [
            (f"{root.rstrip('/')}/sample_data/upi_transactions.csv", "Generated transactions"),
            (f"{root.rstrip('/')}/sample_data/upi_transactions_sample.csv", "Sample transactions"),
        ],
    )
    kw.setdefault("precomputed", files.find_optional_output(spark, root, "fraud_transactions"))
    if path is None:
        note = "Neither transactions file exists; the fixture stands in."
        return build_bundle(fixture(spark), FALLBACK_LABEL, note, store=store, **kw)
    return build_bundle(files.read_csv(spark, path, None), label, f"Loaded {path}", store=store, **kw)


LAYER_METRICS = (
    "bronze_rows", "silver_rows", "quarantine_rows", "gold_rows", "valid_rate_pct", "duplicate_rows", "rule_pass_rate_pct",
)


def layer_counts(b: Bundle) -> DataFrame:
    """D24 as the dashboard shows it: rows per layer, Silver / Bronze valid
    rate %, rows sharing a transaction id, and the mean of the per-rule pass
    rates (each rounded to 2 dp first), as (metric, value) rows."""
    n = F.count(F.lit(1))
    rates = [F.coalesce(round_ratio(F.count_if(F.col(r)) * 100, n), F.lit(100.0)) for r in b.profile.rules]
    hundredths = sum((F.round(r * 100).cast("long") for r in rates[1:]), F.round(rates[0] * 100).cast("long"))
    one = lambda df, *aggs: df.agg(*aggs).withColumn("_k", F.lit(1))
    checked = one(
        b.checked,
        n.alias("bronze_rows"),
        F.count_if(~F.col("_is_valid")).alias("quarantine_rows"),
        # per-rule rates are exact hundredths; averaged exactly, half-up to 2 dp
        round_ratio(hundredths, F.lit(len(rates) * 100)).alias("rule_pass_rate_pct"),
    )
    flagged = [] if b.stored_gold_detected else [F.count_if(coalesce_false("is_fraud")).alias("gold_rows")]
    row = checked.join(one(b.scored, n.alias("silver_rows"), *flagged), "_k")
    if b.stored_gold_detected:
        row = row.join(one(b.gold, n.alias("gold_rows")), "_k")
    row = row.join(dedup.duplicate_rows(b.bronze).withColumn("_k", F.lit(1)), "_k")
    valid = round_ratio(F.col("silver_rows") * 100, F.col("bronze_rows"))
    row = row.withColumn("valid_rate_pct", F.coalesce(valid, F.lit(100.0)))
    stack = ", ".join(f"'{m}', CAST(`{m}` AS DOUBLE)" for m in LAYER_METRICS)
    return row.select(F.expr(f"stack({len(LAYER_METRICS)}, {stack}) AS (metric, value)"))
