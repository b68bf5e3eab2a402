"""Vendor file against internal transactions: the common reconciliation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.config.hub_services import ELSEWHERE_CODES
from tallybook.functions._cols import as_col
from tallybook.functions.dates import Day
from tallybook.functions.labels import label
from tallybook.operators.columns import select_existing, tagged, union_aligned
from tallybook.operators.match import (
    exact,
    inner_match,
    missing_from,
    stripped,
    three_way,
)
from tallybook.operators.rules import (
    LEDGER_RULES,
    MATCHED_ELSEWHERE,
    NOT_IN_PORTAL,
    NOT_IN_VENDOR,
    SETTLED,
    Rule,
    classify,
    statuses_differ,
)
from tallybook.operators.summary import MatchColumns, match_summary
from tallybook.plans.hub_extract import applications_elsewhere, hub_extract
from tallybook.plans.result import Result
from tallybook.plans.vendor_input import prepare_vendor
from tallybook.sources.staging import staged
from tallybook.sources.tables import Tables

# Result columns, in order. Bill columns are left out for two services.
RESULT_COLUMNS = (
    "VENDOR_DATE",
    "TENANT_ID",
    "IHUB_REFERENCE",
    "REFID",
    "IHUB_USERNAME",
    "BBPS_CATEGORY",
    "VENDOR_AMOUNT",
    "HUB_AMOUNT",
    "COMMISSION_AMOUNT",
    "VENDOR_STATUS",
    "IHUB_MASTER_STATUS",
    "{service}_STATUS",
    "SERVICE_DATE",
    "IHUB_LEDGER_STATUS",
    "BILL_FETCH_STATUS",
    "TENANT_LEDGER_STATUS",
    "TRANSACTION_CREDIT",
    "TRANSACTION_DEBIT",
    "COMMISSION_CREDIT",
    "COMMISSION_REVERSAL",
)
BILL_COLUMNS = ("BBPS_CATEGORY", "BILL_FETCH_STATUS")
WITHOUT_BILL_COLUMNS = ("PASSPORT", "INSURANCE_OFFLINE")
RESCUED_SERVICE = "PANNSDL"


def result_columns(service: str) -> list[str]:
    names = [n.format(service=service) for n in RESULT_COLUMNS]
    if service in WITHOUT_BILL_COLUMNS:
        names = [n for n in names if n not in BILL_COLUMNS]
    return names


def match_form(key_mode: str):
    """How the match compares keys: ``strip`` ignores surrounding space, ``reference`` does not."""
    return {"strip": stripped, "reference": exact}[key_mode]


def matched_rows(
    hub: DataFrame,
    vendor: DataFrame,
    rules: Sequence[Rule],
    cols: MatchColumns = MatchColumns(),
    key_mode: str = "strip",
    null_keys_match: bool = False,
) -> DataFrame:
    """Pairs of hub and vendor rows with their bucket in ``CATEGORY``."""
    pairs = inner_match(
        hub, vendor, cols.hub_key, cols.vendor_key, match_form(key_mode), null_keys_match
    )
    bucket = classify(rules, cols.vendor_status, cols.hub_status, cols.ledger)
    return pairs.withColumn("CATEGORY", bucket)


def mismatched_rows(matched: DataFrame, cols: MatchColumns = MatchColumns()) -> DataFrame:
    """Matched rows whose two statuses differ."""
    return matched.where(statuses_differ(cols.hub_status, cols.vendor_status))


def not_in_vendor(
    hub: DataFrame, vendor: DataFrame, cols: MatchColumns = MatchColumns()
) -> DataFrame:
    """Hub rows without a vendor row. Keys are compared stripped in every mode."""
    return missing_from(hub, vendor, cols.hub_key, cols.vendor_key, stripped)


def not_in_portal(
    hub: DataFrame,
    vendor: DataFrame,
    cols: MatchColumns = MatchColumns(),
    key_mode: str = "strip",
) -> DataFrame:
    """Vendor rows without a hub row."""
    return missing_from(
        vendor, hub, cols.vendor_key, cols.hub_key, match_form(key_mode)
    )


def rescue(
    missing: DataFrame, elsewhere: DataFrame, key_mode: str = "strip"
) -> tuple[DataFrame, DataFrame]:
    """``(found in the second system, still missing)`` among vendor rows missing at the hub."""
    form = match_form(key_mode)
    other = elsewhere.withColumn(
        "ITI_PAN_NSDL_STATUS",
        label(F.lower(as_col("service_status").cast("string")), ELSEWHERE_CODES),
    ).drop("service_status")
    found = inner_match(other, missing, "VENDOR_REFERENCE", "REFID", form)
    rest = missing_from(missing, other, "REFID", "VENDOR_REFERENCE", form)
    return found, rest


def buckets(
    hub: DataFrame,
    vendor: DataFrame,
    columns: Sequence[str],
    rules: Sequence[Rule] = LEDGER_RULES,
    cols: MatchColumns = MatchColumns(),
    key_mode: str = "strip",
    elsewhere: DataFrame | None = None,
) -> DataFrame:
    """Every matched pair and every unmatched row, once, under its ``CATEGORY``."""
    names = ["CATEGORY", *columns]
    matched, hub_only, vendor_only = three_way(
        hub, vendor, cols.hub_key, cols.vendor_key, match_form(key_mode)
    )
    if key_mode != "strip":
        hub_only = not_in_vendor(hub, vendor, cols)
    bucket = classify(rules, cols.vendor_status, cols.hub_status, cols.ledger)
    hub_only = hub_only.withColumnRenamed(cols.hub_key, "REFID")
    parts = [matched.withColumn("CATEGORY", bucket), tagged(hub_only, NOT_IN_VENDOR)]
    if elsewhere is not None:
        found, vendor_only = rescue(vendor_only, elsewhere, key_mode)
        parts.append(tagged(found, MATCHED_ELSEWHERE))
    parts.append(tagged(vendor_only, NOT_IN_PORTAL))
    return select_existing(
        union_aligned(*[select_existing(p, names) for p in parts]), names
    )


def reconcile(
    hub: DataFrame,
    vendor: DataFrame,
    service: str,
    key_mode: str = "strip",
    elsewhere: DataFrame | None = None,
    cols: MatchColumns = MatchColumns(),
) -> Result:
    """Both sides prepared; see ``reconcile_service`` for the way from raw inputs."""
    return Result(
        buckets=buckets(
            hub,
            vendor,
            result_columns(service),
            LEDGER_RULES,
            cols,
            key_mode,
            elsewhere,
        ),
        counts=match_summary(hub, vendor, LEDGER_RULES, cols, key_mode),
        settled=SETTLED,
    )


def reconcile_service(
    service: str,
    vendor_file: DataFrame,
    tables: Tables,
    start: Day,
    end: Day,
    transaction_type: str | None = None,
    key_mode: str = "strip",
    only_window: bool = False,
    validate: bool = False,
    stage: bool = False,
) -> Result:
    """Raw vendor file and internal tables to buckets and counts, for the thirteen common services.

    The buckets read each side several times. ``stage`` computes the prepared
    sides once and keeps them in the cluster's shared folder, which pays as soon
    as the extract is more than a scan. It starts the two writing jobs.
    """
    vendor = prepare_vendor(
        vendor_file, service, transaction_type, (start, end) if only_window else None
    )
    hub = hub_extract(
        tables, service, start, end, transaction_type, validate=validate
    )
    elsewhere = None
    if service == RESCUED_SERVICE:
        elsewhere = applications_elsewhere(tables, start, end)
    # Vendor files may carry columns named like hub columns; only the canonical ones are used.
    vendor = select_existing(
        vendor, ["REFID", "VENDOR_DATE", "VENDOR_STATUS", "VENDOR_AMOUNT"]
    )
    if stage:
        hub, vendor = staged(hub), staged(vendor)
    return reconcile(hub, vendor, service, key_mode, elsewhere)
