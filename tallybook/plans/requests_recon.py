"""Application and top-up requests: one row per request key, and a search on other dates."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.config.hub_services import TOPUP_CODES
from tallybook.errors import UnknownServiceError
from tallybook.functions._cols import as_col
from tallybook.functions.dates import Day, in_days
from tallybook.functions.labels import centre_type, label
from tallybook.functions.text import like_text, squeeze
from tallybook.operators.columns import select_existing, tagged, union_aligned
from tallybook.operators.latest import (
    keep_first,
    keep_last,
    keep_newest_with_ties,
    only_keys_missing_from,
)
from tallybook.operators.match import exact, inner_match, lookup, missing_from
from tallybook.operators.rules import (
    MATCHED,
    NOT_IN_PORTAL,
    NOT_IN_VENDOR,
    OTHER_DATE,
)
from tallybook.operators.summary import count_frame, pair_counts
from tallybook.plans.result import Result
from tallybook.plans.vendor_input import prepare_vendor
from tallybook.sources.staging import staged
from tallybook.sources.tables import Tables

# Result columns, in order.
REQUEST_COLUMNS = (
    "EBO_ID",
    "USERNAME",
    "VLE_ID",
    "REFID",
    "SERVICE_CODE",
    "APPLICATION_COUNT",
    "RATE",
    "TOTAL_AMOUNT",
    "JENSEVA_TYPE",
    "VENDOR_DATE",
    "SERVICE_DATE",
    "SUB_DISTRICT",
    "VILLAGE",
)
TOPUP_COLUMNS = (
    "IHUB_USERNAME",
    "NAME",
    "BANK_NAME",
    "REFID",
    "ACC_NO",
    "UTR_NO",
    "AMOUNT",
    "MANUAL_TB_STATUS",
    "SERVICE_DATE",
)

_Frame = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class RequestService:
    """One kind of request: its table, its key, which rows count, and which row per key."""

    table: str
    key: str
    stamp: str
    rows: _Frame
    one_per_key: _Frame
    # which row stands for a key that is found on another date
    one_on_other_date: _Frame
    details: Callable[[DataFrame, Tables], DataFrame]
    columns: tuple[str, ...] = REQUEST_COLUMNS


def _district_details(rows: DataFrame, tables: Tables) -> DataFrame:
    agents = tables["EboDetail"].select(
        F.col("id").alias("AGENT_ID"),
        F.col("Name").alias("USERNAME"),
        F.col("VillageName").alias("VILLAGE"),
        F.col("UserId").alias("AGENT_USER"),
        F.col("SubDistrictId").alias("AGENT_AREA"),
    )
    users = tables["User"].select(
        F.col("id").alias("USER_ID"),
        F.col("UserName").alias("EBO_ID"),
        centre_type("jansevaType").alias("JENSEVA_TYPE"),
    )
    services = tables["UpeDistrictService"].select(
        F.col("id").alias("SERVICE_ID"), F.col("Code").alias("SERVICE_CODE")
    )
    areas = tables["SubDistrict"].select(
        F.col("id").alias("AREA_ID"), F.col("Name").alias("SUB_DISTRICT")
    )
    out = lookup(rows, agents, "EboDetailId", "AGENT_ID")
    out = lookup(out, users, "AGENT_USER", "USER_ID")
    out = lookup(out, services, "UpeDistrictServiceId", "SERVICE_ID")
    out = lookup(out, areas, "AGENT_AREA", "AREA_ID")
    return out.select(
        as_col("__ref").cast("string").alias("VENDOR_REFERENCE"),
        "EBO_ID",
        "USERNAME",
        F.col("VleId").alias("VLE_ID"),
        "SERVICE_CODE",
        F.col("Count").alias("APPLICATION_COUNT"),
        F.col("Commission").alias("RATE"),
        F.col("Amount").alias("TOTAL_AMOUNT"),
        # a request whose agent is unknown has no centre type row either
        F.coalesce("JENSEVA_TYPE", centre_type(F.lit(None).cast("int"))).alias(
            "JENSEVA_TYPE"
        ),
        F.col("CreationTs").cast("date").alias("SERVICE_DATE"),
        "SUB_DISTRICT",
        "VILLAGE",
    )


def _portal_details(rows: DataFrame, tables: Tables) -> DataFrame:
    users = tables["users"].select(
        F.col("id").alias("USER_ID"),
        F.col("apna_id").alias("EBO_ID"),
        F.col("f_name").alias("USERNAME"),
    )
    centres = tables["users_up"].select(
        F.col("users_id").alias("CENTRE_USER"), F.col("vle_id").alias("VLE_ID")
    )
    out = lookup(rows, users, "users_id", "USER_ID")
    out = lookup(out, centres, "users_id", "CENTRE_USER")
    return out.select(
        as_col("__ref").cast("string").alias("VENDOR_REFERENCE"),
        "EBO_ID",
        "USERNAME",
        "VLE_ID",
        F.col("service_code").alias("SERVICE_CODE"),
        F.col("req_app_count").alias("APPLICATION_COUNT"),
        F.col("rate").alias("RATE"),
        F.col("total_amt").alias("TOTAL_AMOUNT"),
        F.col("created_at").cast("date").alias("SERVICE_DATE"),
    )


def _topup_details(rows: DataFrame, tables: Tables) -> DataFrame:
    banks = tables["ManualTbBank"].select(
        F.col("id").alias("BANK_ID"), F.col("Name").alias("BANK_NAME")
    )
    agents = tables["EboDetail"].select(
        F.col("id").alias("AGENT_ID"), F.col("UserId").alias("AGENT_USER")
    )
    users = tables["User"].select(
        F.col("id").alias("USER_ID"),
        F.col("UserName").alias("IHUB_USERNAME"),
        F.col("FirstName").alias("NAME"),
    )
    out = lookup(rows, banks, "manualTbbankId", "BANK_ID")
    out = lookup(out, agents, "EboDetailId", "AGENT_ID")
    out = lookup(out, users, "AGENT_USER", "USER_ID")
    return out.select(
        squeeze("__ref").alias("VENDOR_REFERENCE"),
        "IHUB_USERNAME",
        "NAME",
        "BANK_NAME",
        F.col("AccountNo").alias("ACC_NO"),
        F.col("UtrNo").alias("UTR_NO"),
        F.col("Amount").alias("AMOUNT"),
        label("ManualTbStatusType", TOPUP_CODES).alias("MANUAL_TB_STATUS"),
        F.col("CreationTs").cast("date").alias("SERVICE_DATE"),
    )


def _all(df: DataFrame) -> DataFrame:
    return df


def _first_id(df: DataFrame) -> DataFrame:
    return keep_first(df, "__ref", "id")


def _last_id(df: DataFrame) -> DataFrame:
    return keep_last(df, "__ref", "id")


def _newest(stamp: str) -> _Frame:
    return lambda df: keep_newest_with_ties(df, "__ref", stamp)


def _is_stock(df: DataFrame) -> DataFrame:
    return df.where(F.col("UpeDistrictServiceId") == 1)


def _not_stock(df: DataFrame) -> DataFrame:
    return df.where(F.col("UpeDistrictServiceId") != 1)


def _code_is(df: DataFrame) -> DataFrame:
    return df.where(like_text("service_code", "IS"))


def _code_is_not(df: DataFrame) -> DataFrame:
    return df.where(~like_text("service_code", "IS"))


# Tables, keys and row choice per request service.
REQUEST_SERVICES = {
    "SULTANPURSCA": RequestService(
        table="UpeDistrictTransaction",
        key="ApplicationId",
        stamp="CreationTs",
        rows=_not_stock,
        one_per_key=_first_id,
        one_on_other_date=_newest("CreationTs"),
        details=_district_details,
    ),
    "SULTANPUR_IS": RequestService(
        table="UpeDistrictTransaction",
        key="QuotaId",
        stamp="CreationTs",
        rows=_is_stock,
        one_per_key=_newest("CreationTs"),
        one_on_other_date=_newest("CreationTs"),
        details=_district_details,
    ),
    "CHITRAKOOT_SCA": RequestService(
        table="tb_up_request",
        key="application_no",
        stamp="created_at",
        rows=_code_is_not,
        one_per_key=_last_id,
        one_on_other_date=_last_id,
        details=_portal_details,
    ),
    "CHITRAKOOT_IS": RequestService(
        table="tb_up_request",
        key="quota_id",
        stamp="created_at",
        rows=_code_is,
        one_per_key=_last_id,
        one_on_other_date=_last_id,
        details=_portal_details,
    ),
    "MANUAL_TB": RequestService(
        table="ManualTbTransaction",
        key="VerifiedUtrNo",
        stamp="CreationTs",
        rows=_all,
        one_per_key=_all,
        one_on_other_date=_all,
        details=_topup_details,
        columns=TOPUP_COLUMNS,
    ),
}


def request_service(service: str) -> RequestService:
    if service not in REQUEST_SERVICES:
        raise UnknownServiceError(f"no request service '{service}'")
    return REQUEST_SERVICES[service]


def request_rows(spec: RequestService, tables: Tables) -> DataFrame:
    """All rows of the service, of any date, with the request key as ``__ref``."""
    return spec.rows(tables[spec.table]).withColumn("__ref", as_col(spec.key))


def requests_in_window(
    tables: Tables, service: str, start: Day, end: Day
) -> DataFrame:
    """One row per request key among the requests of the window (all rows for top-ups)."""
    spec = request_service(service)
    rows = request_rows(spec, tables).where(in_days(spec.stamp, start, end))
    return spec.details(spec.one_per_key(rows), tables)


def found_on_other_date(
    tables: Tables, service: str, vendor: DataFrame, hub: DataFrame
) -> DataFrame:
    """Requests of any date for the vendor keys that the window lacks.

    The keys drive a semi join into the request table, so only wanted requests
    are ranked and completed with details.
    """
    spec = request_service(service)
    history = request_rows(spec, tables)
    if service == "MANUAL_TB":
        history = history.withColumn("__ref", squeeze("__ref"))
    present = hub.select(as_col("VENDOR_REFERENCE").alias("__ref"))
    missing = missing_from(vendor, present, "REFID", "__ref", exact)
    wanted = only_keys_missing_from(history, missing, present, "__ref", "REFID")
    return spec.details(spec.one_on_other_date(wanted), tables)


def reconcile_requests(
    service: str,
    vendor_file: DataFrame,
    tables: Tables,
    start: Day,
    end: Day,
    stage: bool = False,
) -> Result:
    """``stage`` keeps the chosen requests, which every bucket reads, in the shared folder."""
    spec = request_service(service)
    vendor = select_existing(
        prepare_vendor(vendor_file, service), ["REFID", "VENDOR_DATE", "VENDOR_STATUS"]
    )
    hub = requests_in_window(tables, service, start, end)
    if stage:
        hub = staged(hub)
    drifted = found_on_other_date(tables, service, vendor, hub)
    if stage:
        drifted = staged(drifted)
    return assemble(hub, vendor, drifted, spec.columns)


def assemble(
    hub: DataFrame,
    vendor: DataFrame,
    drifted: DataFrame,
    columns: tuple[str, ...],
) -> Result:
    """Buckets and counts from the window's requests, the vendor rows and the other-date requests."""
    matched = inner_match(hub, vendor, "VENDOR_REFERENCE", "REFID", exact)
    other_date = inner_match(drifted, vendor, "VENDOR_REFERENCE", "REFID", exact)
    hub_only = missing_from(hub, vendor, "VENDOR_REFERENCE", "REFID", exact)
    known = hub.select("VENDOR_REFERENCE").unionByName(drifted.select("VENDOR_REFERENCE"))
    vendor_only = missing_from(vendor, known, "REFID", "VENDOR_REFERENCE", exact)
    names = ["CATEGORY", *columns]
    parts = (
        tagged(matched, MATCHED),
        tagged(hub_only.withColumnRenamed("VENDOR_REFERENCE", "REFID"), NOT_IN_VENDOR),
        tagged(other_date, OTHER_DATE),
        tagged(vendor_only, NOT_IN_PORTAL),
    )
    rows = select_existing(
        union_aligned(*[select_existing(p, names) for p in parts]), names
    )
    return Result(rows, request_counts(hub, vendor, drifted, hub_only, vendor_only), (MATCHED,))


def request_counts(
    hub: DataFrame,
    vendor: DataFrame,
    drifted: DataFrame,
    hub_only: DataFrame,
    vendor_only: DataFrame,
) -> DataFrame:
    """Success: matched or found on another date. Failed: missing on either side."""
    every = F.lit(True)
    keys = ("VENDOR_REFERENCE", "REFID")
    known = pair_counts(hub, vendor, *keys, {"Total_Success_count": (every, every)})
    other = pair_counts(drifted, vendor, *keys, {"drift": (every, every)})
    drift = other.select(
        F.explode(F.array(F.lit("Total_Success_count"), F.lit("HUB_Value_count"))).alias(
            "metric"
        ),
        "value",
    )
    parts = (
        known,
        drift,
        count_frame(hub, {"HUB_Value_count": every}),
        count_frame(vendor, {"Excel_value_count": every}),
        count_frame(hub_only, {"Total_Failed_count": every}),
        count_frame(vendor_only, {"Total_Failed_count": every}),
    )
    return (
        union_aligned(*parts).groupBy("metric").agg(F.sum("value").alias("value"))
    )
