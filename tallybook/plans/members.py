"""User reports: package expiry lists, and per-tenant lists of active and lapsed users.

``as_of`` stands for today; it is a parameter so that a report can be repeated.
Every list filters packages and users before joining them.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.errors import UnknownServiceError
from tallybook.functions._cols import as_col
from tallybook.functions.dates import (
    Day,
    after_day,
    in_days,
    in_month_before,
    in_month_of,
    to_day,
)
from tallybook.functions.text import like_text
from tallybook.operators.columns import union_aligned
from tallybook.operators.filters import (
    set_and_before,
    set_and_between,
    unset_or_between,
    unset_or_from,
)
from tallybook.operators.match import lookup
from tallybook.sources.tables import Tables

# Roles and package ids of the reports.
ROLE_CENTRE, ROLE_SOCIETY = 2, 1
PAID_PACKAGES = (1, 4)
PORTAL_USER_TYPE = "4"
PORTAL_STATUS_FREE, PORTAL_STATUS_INSTALMENT = 0, 2


def _purchases(tables: Tables, when: Column, packages: tuple[int, ...] = ()) -> DataFrame:
    rows = tables["UserPurchasedPackage"].where(when)
    if packages:
        rows = rows.where(F.col("PackageId").isin(*packages))
    return rows.select(
        "UserId", "PackageId", F.col("ExpireTs").cast("date").alias("Expiry_Date")
    )


def _users(tables: Tables, role: int, name_pattern: str | None = None) -> DataFrame:
    users = tables["User"].where(F.col("UserRoleId") == role)
    return users if name_pattern is None else users.where(
        like_text("UserName", name_pattern)
    )


@dataclass(frozen=True)
class ExpiryList:
    when: Callable[[Column, dt.date], Column]
    name_pattern: str | None = None
    packages: tuple[int, ...] = ()
    with_centre_id: bool = False


# The six lists of the expiry report.
EXPIRY_LISTS = {
    "Active_list": ExpiryList(after_day, packages=PAID_PACKAGES),
    "TN_Active_list": ExpiryList(after_day, "TN%"),
    "UP_Active_list": ExpiryList(after_day, "UP%", with_centre_id=True),
    "AP_Active_list": ExpiryList(after_day, "ap%"),
    "current_month_expiry_list": ExpiryList(in_month_of, with_centre_id=True),
    "last_month_inactive_list": ExpiryList(in_month_before, with_centre_id=True),
}


def expiry_list(tables: Tables, name: str, as_of: Day | None = None) -> DataFrame:
    if name not in EXPIRY_LISTS:
        raise UnknownServiceError(f"no expiry list '{name}'")
    spec = EXPIRY_LISTS[name]
    day = dt.date.today() if as_of is None else to_day(as_of)
    columns = ["UserName", "FirstName", "MobileNo", "Email", "Expiry_Date"]
    if spec.with_centre_id:
        columns.insert(2, "VleId")
    packages = _purchases(tables, spec.when(F.col("ExpireTs"), day), spec.packages)
    users = _users(tables, ROLE_CENTRE, spec.name_pattern)
    return packages.join(users, F.col("UserId") == F.col("id")).select(*columns)


def expiry_report(tables: Tables, as_of: Day | None = None) -> DataFrame:
    """All six lists in one frame, told apart by ``LIST``.

    Packages and users are joined once; each row is then repeated for every
    list it belongs to.
    """
    day = dt.date.today() if as_of is None else to_day(as_of)
    windows = [spec.when(F.col("ExpireTs"), day) for spec in EXPIRY_LISTS.values()]
    bought = tables["UserPurchasedPackage"].where(reduce(Column.__or__, windows))
    rows = bought.join(_users(tables, ROLE_CENTRE), F.col("UserId") == F.col("id"))

    def member_of(name: str, spec: ExpiryList) -> Column:
        test = spec.when(F.col("ExpireTs"), day)
        if spec.packages:
            test = test & F.col("PackageId").isin(*spec.packages)
        if spec.name_pattern:
            test = test & like_text("UserName", spec.name_pattern)
        return F.when(test, F.lit(name))

    lists = F.array_compact(F.array(*[member_of(n, s) for n, s in EXPIRY_LISTS.items()]))
    with_id = [n for n, s in EXPIRY_LISTS.items() if s.with_centre_id]
    return rows.withColumn("LIST", F.explode(lists)).select(
        "LIST",
        "UserName",
        "FirstName",
        F.when(F.col("LIST").isin(*with_id), F.col("VleId")).alias("VleId"),
        "MobileNo",
        "Email",
        F.col("ExpireTs").cast("date").alias("Expiry_Date"),
    )


def _package_users(
    tables: Tables,
    when: Column,
    role: int,
    name_pattern: str | None = None,
    packages: tuple[int, ...] = (),
    with_centre_id: bool = False,
) -> DataFrame:
    names = tables["Package"].select(
        F.col("id").alias("PACKAGE_ID"), F.col("Name").alias("Package_Name")
    )
    bought = lookup(_purchases(tables, when, packages), names, "PackageId", "PACKAGE_ID")
    rows = bought.join(
        _users(tables, role, name_pattern), F.col("UserId") == F.col("id")
    )
    columns = [F.col("UserName")]
    if with_centre_id:
        columns.append(F.col("VleId").alias("Vle_Id"))
    return rows.select(
        *columns,
        F.col("FirstName").alias("Customer_Name"),
        F.col("MobileNo").alias("Phone_Num"),
        F.col("Email"),
        "Package_Name",
        "Expiry_Date",
    )


def _portal_columns(*extra: str) -> list[Column]:
    return [
        F.col("apna_id").alias("UserName"),
        F.col("vle_id").alias("Vle_Id"),
        F.col("f_name").alias("Customer_Name"),
        F.col("phone_no").alias("Phone_Num"),
        F.col("email_id").alias("Email"),
        F.col("next_due_date").cast("date").alias("Expiry_Date"),
        *[F.col(c) for c in extra],
    ]


def _with_centre(tables: Tables, users: DataFrame) -> DataFrame:
    centres = tables["users_up"].select(F.col("users_id").alias("CENTRE_USER"), "vle_id")
    return lookup(users, centres, "id", "CENTRE_USER")


def _with_one_centre(tables: Tables, users: DataFrame) -> DataFrame:
    centres = (
        tables["users_up"]
        .groupBy(F.col("users_id").alias("CENTRE_USER"))
        .agg(F.max("vle_id").alias("vle_id"))
    )
    return lookup(users, centres, "id", "CENTRE_USER")


def _is_instalment_user() -> Column:
    return (
        like_text("apna_id", "%UP%")
        & (F.col("mas_user_type_id").cast("string") == PORTAL_USER_TYPE)
        & (F.col("up_vle_status") == PORTAL_STATUS_INSTALMENT)
    )


def active_portal_users(tables: Tables, as_of: Day) -> DataFrame:
    """Two populations with different rules, appended; a user in both is listed twice."""
    users = tables["users"]
    free = users.where(
        (F.col("mas_user_type_id").cast("string") == PORTAL_USER_TYPE)
        & (F.col("up_vle_status") == PORTAL_STATUS_FREE)
        # the bare due date is compared here, so one later on the same day counts
        & (F.col("next_due_date") > F.lit(to_day(as_of)))
    )
    paying = users.where(_is_instalment_user() & after_day("next_due_date", as_of))
    both = _with_centre(tables, free).unionAll(_with_centre(tables, paying))
    return both.select(*_portal_columns())


def instalment_users(tables: Tables) -> DataFrame:
    """Instalment users with their numbers of instalments: all, paid, unpaid; one row each.

    Instalments are counted per user before any join, so a user with several
    centres is neither repeated nor counted double.
    """
    counted = (
        tables["up_emi_installments"]
        .groupBy(F.col("users_id").alias("EMI_USER"))
        .agg(
            F.count("*").alias("total_due_dates"),
            F.count_if(F.col("payment_sts") == 1).alias("payment_done"),
            F.count_if(F.col("payment_sts") == 0).alias("payment_not_done"),
        )
    )
    users = tables["users"].where(_is_instalment_user())
    rows = users.join(counted, F.col("id") == F.col("EMI_USER"))
    return _with_one_centre(tables, rows).select(
        *_portal_columns("total_due_dates", "payment_done", "payment_not_done")
    )


def _prefixed_portal_users(tables: Tables, when: Column) -> DataFrame:
    users = tables["users"].where(like_text("apna_id", "UPPS%") & when)
    return _with_centre(tables, users).select(*_portal_columns())


_EXPIRY = "ExpireTs"
_DUE = "next_due_date"
ACTIVE, INACTIVE, UNPAID = "active", "inactive", "emi-not-paid"

# Tenant names, their statuses, and the rule behind each list.
# t: tables, a: first day, b: last day, d: today.
MEMBER_LISTS: dict[tuple[str, str], Callable[[Tables, Day, Day, Day], DataFrame]] = {
    ("I-NET TN Users", ACTIVE): lambda t, a, b, d: _package_users(
        t, as_col(_EXPIRY) >= F.lit(to_day(a)), ROLE_CENTRE, "TN%", PAID_PACKAGES
    ),
    ("I-NET TN Users", INACTIVE): lambda t, a, b, d: _package_users(
        t, in_days(_EXPIRY, a, b), ROLE_CENTRE, "TN%", PAID_PACKAGES
    ),
    ("I-NET UP Users", ACTIVE): lambda t, a, b, d: _package_users(
        t, as_col(_EXPIRY) >= F.lit(to_day(a)), ROLE_CENTRE, "up01%", PAID_PACKAGES, True
    ),
    ("I-NET UP Users", INACTIVE): lambda t, a, b, d: _package_users(
        t, in_days(_EXPIRY, a, b), ROLE_CENTRE, "up01%", PAID_PACKAGES, True
    ),
    ("I-NET PACCS Users", ACTIVE): lambda t, a, b, d: _package_users(
        t, as_col(_EXPIRY) >= F.lit(to_day(a)), ROLE_SOCIETY
    ),
    ("I-NET PACCS Users", INACTIVE): lambda t, a, b, d: _package_users(
        t, in_days(_EXPIRY, a, b), ROLE_SOCIETY
    ),
    ("UPe-District Sultanpur PS Users", ACTIVE): lambda t, a, b, d: _package_users(
        t, unset_or_from(_EXPIRY, a), ROLE_CENTRE, "UPPS%"
    ),
    ("UPe-District Sultanpur PS Users", INACTIVE): lambda t, a, b, d: _package_users(
        t, set_and_between(_EXPIRY, a, b), ROLE_CENTRE, "UPPS%"
    ),
    ("ITI UP Users", ACTIVE): lambda t, a, b, d: active_portal_users(t, d),
    ("ITI UP Users", INACTIVE): lambda t, a, b, d: instalment_users(t).where(
        (F.col("payment_not_done") == 0) & in_days("Expiry_Date", a, b)
    ),
    ("ITI UP Users", UNPAID): lambda t, a, b, d: instalment_users(t).where(
        F.col("payment_not_done") != 0
    ),
    ("UPe-District Chitrakoot PS Users", ACTIVE): lambda t, a, b, d: (
        _prefixed_portal_users(t, unset_or_between(_DUE, a, b))
    ),
    ("UPe-District Chitrakoot PS Users", INACTIVE): lambda t, a, b, d: (
        _prefixed_portal_users(t, set_and_before(_DUE, a))
    ),
}


def member_list(
    tables: Tables,
    tenant: str,
    status: str,
    start: Day,
    end: Day,
    as_of: Day | None = None,
) -> DataFrame:
    """Users of a tenant that are active, lapsed, or behind with instalments."""
    if (tenant, status) not in MEMBER_LISTS:
        raise UnknownServiceError(f"no list of {status!r} users for '{tenant}'")
    day = dt.date.today() if as_of is None else to_day(as_of)
    return MEMBER_LISTS[tenant, status](tables, to_day(start), to_day(end), day)


def all_member_lists(
    tables: Tables, start: Day, end: Day, as_of: Day | None = None
) -> DataFrame:
    """Every tenant's lists in one frame."""
    parts = [
        member_list(tables, tenant, status, start, end, as_of)
        .withColumn("TENANT", F.lit(tenant))
        .withColumn("STATUS", F.lit(status))
        for tenant, status in MEMBER_LISTS
    ]
    return union_aligned(*parts)
