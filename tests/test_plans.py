import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import rows_of
from tallybook.catalog.extracts import EXTRACTS, detail_table, tables_for
from tallybook.catalog.joins import END, START
from tallybook.catalog.services import request_tables
from tallybook.config.hub_services import HUB_SERVICES
from tallybook.config.vendor_files import VENDOR_FILES
from tallybook.errors import ContractError, DuplicateKeyError, UnknownServiceError
from tallybook.plans import members
from tallybook.plans.dispatch import EmptyWindowError, reconcile
from tallybook.plans.hub_extract import hub_extract, service_transactions
from tallybook.plans.hub_recon import reconcile as reconcile_sides, result_columns
from tallybook.plans.ledger_recon import LEDGER_PLANS, reconcile_ledger
from tallybook.plans.vendor_input import canonical, prepare_vendor, vendor_rejects
from tallybook.sources.tables import Tables


def raw_vendor(source, service):
    """The vendor view under the raw headers of a service's file."""
    spec = VENDOR_FILES[service]
    layout = spec.layouts[0]
    base = source["vendor"].select(
        F.col("REFID"),
        F.date_format(F.col("VENDOR_DATE").cast("timestamp"), layout).alias("VENDOR_DATE"),
        F.col("VENDOR_STATUS"),
        F.col("VENDOR_AMOUNT").cast("string").alias("VENDOR_AMOUNT"),
    )
    df = base.withColumnsRenamed({v: k for k, v in spec.columns.items()})
    if spec.surcharge:
        df = df.withColumn(spec.surcharge, F.lit("1.0"))
    return df


def elsewhere_tables(source):
    tables = tables_for(source, "PANNSDL")
    return Tables(
        **tables._frames,
        pan_nsdl=source["elsewhere"],
        users=source["portal_users"],
    )


@pytest.mark.parametrize("service", sorted(EXTRACTS))
def test_every_common_service_from_raw_file_to_buckets(source, service):
    mode = "2" if service == "AEPS" else None
    tables = elsewhere_tables(source) if service == "PANNSDL" else tables_for(source, service)
    result = reconcile(service, raw_vendor(source, service), tables, START, END, mode)
    sizes = {r["CATEGORY"]: r["n"] for r in result.sizes().collect()}
    counts = {r["metric"]: r["value"] for r in result.counts.collect()}
    assert set(result.buckets.columns) <= {"CATEGORY", *result_columns(service)}
    assert f"{service}_STATUS" in result.buckets.columns
    if service == "PANNSDL":
        # rescued rows are missing at the hub all the same
        sizes["NOT_IN_PORTAL"] += sizes.pop("MATCHED_IN_ITI")
    for category, n in sizes.items():
        assert counts[category] == n, category
    assert counts["Excel_value_count"] == source["vendor"].count()


def test_rescued_rows_leave_the_missing_bucket(source):
    file = raw_vendor(source, "PANNSDL")
    result = reconcile("PANNSDL", file, elsewhere_tables(source), START, END)
    sizes = {r["CATEGORY"]: r["n"] for r in result.sizes().collect()}
    counts = {r["metric"]: r["value"] for r in result.counts.collect()}
    assert sizes["MATCHED_IN_ITI"] > 0
    assert sizes["MATCHED_IN_ITI"] + sizes["NOT_IN_PORTAL"] == counts["NOT_IN_PORTAL"]


def test_request_and_transfer_and_qr_services_from_raw_files(source):
    asked = source["request_vendor"].select(
        F.col("REFID").alias("Application ID"),
        F.date_format(F.col("VENDOR_DATE").cast("timestamp"), "dd/MM/yyyy").alias("Transaction Date"),
    )
    result = reconcile("SULTANPURSCA", asked, request_tables(source), "2024-01-06", "2024-01-20")
    assert {r[0] for r in result.sizes().collect()} == {
        "MATCHED", "NOT_IN_VENDOR", "NOT_IN_PORTAL", "IN_PORTAL_DIFF_DATE",
    }
    tables = Tables(axis_imps_trans=source["transfer_table"], users=source["portal_users"])
    sizes = reconcile("IMPS", raw_vendor(source, "IMPS"), tables, START, END).sizes()
    assert sizes.where("CATEGORY = 'VEND_IHUB_SUC'").count() == 1
    qr = source["qr_vendor"].select(
        "Unique_ID",
        F.col("REFID").alias("TRNSCTN_NMBR"),
        F.date_format(F.col("VENDOR_DATE").cast("timestamp"), "dd/MM/yyyy").alias("CRTD_DATE"),
        F.when(F.col("VENDOR_STATUS") == "success", "Authorised").otherwise("x").alias("STATUS"),
        F.col("VENDOR_AMOUNT").cast("string").alias("Settled_Amount"),
    )
    tables = Tables(
        AxisEpTransaction=source["qr_payments"],
        WhiteLabelSession=source["qr_sessions"],
        EboWalletTransaction=source["wallet"],
    )
    result = reconcile("UPIQR", qr, tables, START, END)
    assert "BANK_REF_NOT_UPDATED" in {r[0] for r in result.sizes().collect()}
    assert result.has_exceptions()


def test_reports_without_buckets(source):
    tables = Tables(EboWalletTransaction=source["wallet"], MasterTransaction=source["master"])
    assert reconcile("IRCTC", None, tables, START, END).count() > 0
    tables = Tables(BBPS_BillFetch=source["bill_fetch"], MasterSubTransaction=source["sub"])
    report = reconcile("BBPS_DATA_ENTRY", source["vendor_file"], tables, START, END)
    assert "MST_ID" in report.columns


def test_contract_and_service_errors(source, frame):
    tables = tables_for(source, "BBPS")
    with pytest.raises(ContractError, match="Transaction Ref ID"):
        reconcile("BBPS", frame("x string", ("1",)), tables, START, END)
    with pytest.raises(UnknownServiceError):
        reconcile("NOPE", frame("x string", ("1",)), tables, START, END)
    with pytest.raises(UnknownServiceError, match="transaction type 3"):
        canonical(source["vendor_file"], "BBPS", "3")
    with pytest.raises(UnknownServiceError, match="not one of"):
        service_transactions(tables_for(source, "AEPS"), "AEPS", START, END, "7")
    with pytest.raises(EmptyWindowError):
        reconcile("BBPS", source["vendor_file"], tables, "2030-01-01", "2030-01-02")
    with pytest.raises(UnknownServiceError):
        reconcile_ledger("NOPE", source["atm_ledger"], source["atm_statement"])
    with pytest.raises(ContractError):
        reconcile_ledger("MATM", source["atm_statement"], source["atm_ledger"])


def test_mini_statement_headers(frame):
    df = frame("SERIALNUMBER string, ADDEDDATE string, DATE string", ("1", "2024-01-02", "x"))
    got = prepare_vendor(df, "AEPS", "3").select("REFID", "VENDOR_DATE")
    assert rows_of(got) == [("1", dt.date(2024, 1, 2))]


def test_key_slices(frame):
    policy = frame("`Policy No` string", ("12345678901234567890XX",))
    assert rows_of(prepare_vendor(policy, "INSURANCE_OFFLINE").select("REFID")) == [("12345678901234567890",)]
    quota = frame("`Quota ID` string", ("'1234567890'x",))
    assert rows_of(prepare_vendor(quota, "SULTANPUR_IS").select("REFID")) == [("1234567890",)]


def test_rows_without_any_id_are_dropped(frame):
    df = frame(
        "RRN string, TID string, DEVICE string",
        (None, None, None), ("1", None, None), (None, "2", None),
    )
    assert prepare_vendor(df, "MATM").count() == 2
    # without all three columns the rule does not apply
    assert prepare_vendor(frame("RRN string", (None,), ("1",)), "MATM").count() == 2


def test_surcharge_needs_both_amounts(frame):
    df = frame(
        "`Tkt. Number` string, `Ticket Amount` string, `Service Tax` string",
        ("a", "10", "2.5"), ("b", "10", None), ("c", "x", "1"),
    )
    got = prepare_vendor(df, "ABHIBUS").select("REFID", "VENDOR_AMOUNT")
    assert rows_of(got) == [("a", 12.5), ("b", None), ("c", None)]
    assert rows_of(vendor_rejects(df, "ABHIBUS").select("REFID", "REASON")) == [("c", "amount")]


def test_window_filter_is_optional(source):
    file = source["vendor_file"]
    everything = prepare_vendor(file, "BBPS").count()
    inside = prepare_vendor(file, "BBPS", window=(START, "1997-12-31")).count()
    assert 0 < inside < everything == file.count()


def test_repeated_hub_reference_is_a_named_error(source):
    tables = tables_for(source, "RECHARGE")
    twice = Tables(**{**tables._frames, "PsRechargeTransaction": (
        lambda d: d.unionByName(d))(detail_table(source, "RECHARGE"))})
    with pytest.raises(DuplicateKeyError, match="RECHARGE extract"):
        hub_extract(twice, "RECHARGE", START, END, validate=True)


def test_empty_hub_means_everything_is_missing(source):
    hub = hub_extract(tables_for(source, "RECHARGE"), "RECHARGE", "2030-01-01", "2030-01-02")
    result = reconcile_sides(hub, source["vendor"], "RECHARGE")
    assert rows_of(result.sizes()) == [("NOT_IN_PORTAL", source["vendor"].count())]


def test_legacy_labels(source):
    tables = tables_for(source, "ABHIBUS")
    new = service_transactions(tables, "ABHIBUS", START, END)
    old = service_transactions(tables, "ABHIBUS", START, END, legacy_labels=True)
    assert new.where("ABHIBUS_STATUS = 'initiated'").count() > 0
    assert old.where("ABHIBUS_STATUS = 'initated'").count() > 0


def test_every_service_is_configured():
    assert len(HUB_SERVICES) == 13
    assert len(VENDOR_FILES) == 21
    assert set(LEDGER_PLANS) == {
        "RECHARGE", "DMT", "AEPS", "MATM", "BBPS", "LIC", "PANUTI", "ABHIBUS",
    }


def test_bill_ledger_without_any_match(frame):
    led = frame(
        "`Chq / Ref No.` string, Debit string, Credit string, Description string, `Transaction Date` string",
        ("KM1", "10", None, "x", "d"),
    )
    stm = frame(
        "`Transaction Ref ID` string, `Transaction Amount(RS.)` string, `NPCI Transaction Desc` string, `Transaction Date` string",
        ("KM2", "10", "Failure", "d"),
    )
    assert rows_of(reconcile_ledger("BBPS", led, stm).sizes()) == [("not_in_ledger", 1), ("not_in_statement", 1)]


def test_bill_amounts_are_cut_to_whole_units_unless_asked(frame):
    from tallybook.plans.ledger_amounts import reconcile_amounts

    led = frame("UTR string, AMOUNT string, `CR/DR` string, DATE string", ("1", "₹ 10.75", "DR", "d"))
    stm = frame("RRN string, AMOUNT string", ("1.0", "10.20"))
    assert rows_of(reconcile_amounts(led, stm).sizes()) == [("matching_trans", 1)]
    assert rows_of(reconcile_amounts(led, stm, "exact").sizes()) == [("amount_mismatch", 1)]


def test_repeated_reference_is_refunded_once_per_row(frame):
    led = frame(
        "`Chq / Ref No.` string, Debit string, Credit string, Description string, `Transaction Date` string",
        ("KM1", "10", None, "x", "d"), ("KM1", "10", None, "x", "d"),
        ("C", None, "10", "AB1-REF-KM1-01/02/2024", "d"),
    )
    stm = frame(
        "`Transaction Ref ID` string, `Transaction Amount(RS.)` string, `NPCI Transaction Desc` string, `Transaction Date` string",
        ("KM1", "10", "Failure", "d"),
    )
    assert rows_of(reconcile_ledger("BBPS", led, stm).sizes()) == [("matching_trans", 2)]


@pytest.mark.parametrize("tenant, status", sorted(members.MEMBER_LISTS))
def test_every_member_list_runs(source, tenant, status):
    from tallybook.catalog.members import tables

    df = members.member_list(tables(source), tenant, status, "1997-06-01", "1999-03-31", "1998-06-15")
    assert {"UserName", "Customer_Name", "Expiry_Date"} <= set(df.columns)
    df.count()


def test_unknown_member_list(source):
    from tallybook.catalog.members import tables

    with pytest.raises(UnknownServiceError):
        members.member_list(tables(source), "I-NET TN Users", "emi-not-paid", "1997-06-01", "1999-03-31")
    with pytest.raises(UnknownServiceError):
        members.expiry_list(tables(source), "nope")


def test_staged_sides_give_the_same_result(source):
    tables, file = tables_for(source, "RECHARGE"), raw_vendor(source, "RECHARGE")
    want = rows_of(reconcile("RECHARGE", file, tables, START, END).sizes())
    result = reconcile("RECHARGE", file, tables, START, END, stage=True)
    assert rows_of(result.sizes()) == want


def test_unreadable_input_gives_no_day_a_verdict(frame):
    ledger = frame(
        "`Balance Date` string, `Used Amount` string",
        ("01-01-2024", "100"),
        ("02-01-2024", "100"),
        ("someday", "500"),
        ("03-01-2024", "x"),
        ("04-01-2024", "7"),
    )
    booking = "`Tkt. Number` string, `Booked Date` string, Status string, `Ticket Amount` string"
    statement = frame(
        booking + ", `Service Tax` string, `Comm.` string, `Comm TDS` string",
        ("a", "01-01-2024 10:00", "success", "100", "0", "0", "0"),
        ("b", "02-01-2024 10:00", "success", "100", "0", "0", "0"),
        ("c", "02-01-2024 10:00", "success", "abc", "0", "0", "0"),
        ("d", "03-01-2024 10:00", "failed", "0", "0", "0", "0"),
    )
    result = reconcile_ledger("ABHIBUS", ledger, statement)
    rows = result.buckets.select("CATEGORY", "`TKT. NUMBER`", "`BOOKED DATE`").collect()
    assert sorted((r[0], r[1] or r[2]) for r in rows) == [
        ("UNCLASSIFIED", "03-01-2024"),
        ("UNCLASSIFIED", "b"),
        ("UNCLASSIFIED", "c"),
        ("UNCLASSIFIED", "d"),
        ("UNCLASSIFIED", "someday"),
        ("matching_trans", "a"),
    ]
    assert result.has_exceptions()
    # a day that only the ledger has
    assert [r.AMOUNT_LEDGER for r in result.days.collect() if r.DAY.day == 4] == [7.0]


def test_unequal_pair_without_commission_is_a_mismatch(frame):
    ledger = frame(
        "TID string, `Reference TID` string, DR string, CR string, Date string",
        ("p", None, "10.00", None, "d"),
        ("q", None, "10.00", None, "d"),
    )
    statement = frame(
        "IMWTID string, Amount string, Date string",
        ("p", "99.00", "d"),
        ("q", "10", "d"),
        ("NA", "1", "d"),
        (None, "2", "d"),
    )
    rows = reconcile_ledger("LIC", ledger, statement).buckets.collect()
    assert sorted((r.CATEGORY, r.LDG_TID or "") for r in rows) == [
        ("MATCHED_NO_COMMISSION", "q"),
        ("UNCLASSIFIED", ""),
        ("UNCLASSIFIED", ""),
        ("amount_mismatch", "p"),
    ]


def test_payments_without_bank_reference_stay_apart(frame):
    from tallybook.plans import qr_recon

    hub = frame(
        "REFERENCE_NO string, VENDOR_REFERENCE string, HUB_AMOUNT double",
        *((f"r{i}", None, 1.0) for i in range(5)),
        ("s1", "bank", 1.0),
        ("s2", "bank", 1.0),
    )
    credits = frame(
        "VendorReferenceId string, IHubReferenceId string, ServiceName string, "
        "EBO_WALLET_CREDIT string, UNIQUE_REFERENCE string, TRANSACTION_TYPE string",
        (None, "r3", "UPI", "Yes", "r3", "MANUAL_REFUND"),
    )
    rows = qr_recon.with_wallet_credit(hub, credits)
    found = sorted((r.REFERENCE_NO, r.EBO_WALLET_CREDIT) for r in rows.collect())
    assert found == [(f"r{i}", "Yes" if i == 3 else None) for i in range(5)] + [("s1", None)]
    shared = qr_recon.shared_bank_ref(hub, rows).collect()
    assert [r.REFERENCE_NO for r in shared] == ["s2"]
    folded = qr_recon.with_wallet_credit(hub, credits, parity=True)
    assert folded.count() == 2
