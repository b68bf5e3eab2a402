"""User reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.catalog.clean import AS_OF
from tallybook.catalog.registry import query
from tallybook.catalog.views import Source
from tallybook.plans import members
from tallybook.sources.tables import Tables

FIRST, LAST = "1997-06-01", "1999-03-31"
VIEWS = (
    "users",
    "packages_bought",
    "packages",
    "portal_users",
    "portal_centres",
    "instalments",
)


def tables(s: Source) -> Tables:
    return Tables(
        User=s["users"],
        UserPurchasedPackage=s["packages_bought"],
        Package=s["packages"],
        users=s["portal_users"],
        users_up=s["portal_centres"],
        up_emi_installments=s["instalments"],
    )


def _list(name: str, where: str, centre: bool = False) -> str:
    return f"""SELECT '{name}' AS LIST, u.UserName, u.FirstName, {"u.VleId" if centre else "NULL"} AS VleId,
  u.MobileNo, u.Email, CAST(p.ExpireTs AS DATE) AS Expiry_Date
FROM packages_bought p JOIN users u ON u.id = p.UserId WHERE u.UserRoleId = 2 AND {where}"""


AFTER = f"CAST(p.ExpireTs AS DATE) > DATE '{AS_OF}'"


@query(
    "users_lists",
    *VIEWS,
    sql="\nUNION ALL ".join(
        [
            _list("Active_list", f"{AFTER} AND p.PackageId IN (1, 4)"),
            _list("TN_Active_list", f"{AFTER} AND u.UserName ILIKE 'TN%'"),
            _list("UP_Active_list", f"{AFTER} AND u.UserName ILIKE 'UP%'", True),
            _list("AP_Active_list", f"{AFTER} AND u.UserName ILIKE 'ap%'"),
            _list(
                "current_month_expiry_list",
                "month(p.ExpireTs) = 6 AND year(p.ExpireTs) = 1998",
                True,
            ),
            _list(
                "last_month_inactive_list",
                "p.ExpireTs >= TIMESTAMP '1998-05-01' AND p.ExpireTs < TIMESTAMP '1998-06-01'",
                True,
            ),
        ]
    ),
)
def users_lists(s: Source) -> DataFrame:
    return members.expiry_report(tables(s), AS_OF)


def _package_list(tenant: str, status: str, where: str, centre: bool = False) -> str:
    return f"""SELECT '{tenant}' AS TENANT, '{status}' AS STATUS, u.UserName,
  {"u.VleId" if centre else "NULL"} AS Vle_Id, u.FirstName AS Customer_Name, u.MobileNo AS Phone_Num,
  u.Email, k.Name AS Package_Name, CAST(p.ExpireTs AS DATE) AS Expiry_Date,
  NULL AS total_due_dates, NULL AS payment_done, NULL AS payment_not_done
FROM packages_bought p JOIN users u ON u.id = p.UserId LEFT JOIN packages k ON k.id = p.PackageId
WHERE {where}"""


def _portal_list(tenant: str, status: str, where: str) -> str:
    return f"""SELECT '{tenant}', '{status}', u.apna_id, c.vle_id, u.f_name, u.phone_no, u.email_id, NULL,
  CAST(u.next_due_date AS DATE), NULL, NULL, NULL
FROM portal_users u LEFT JOIN portal_centres c ON c.users_id = u.id WHERE {where}"""


def _instalment_list(status: str, where: str) -> str:
    return f"""SELECT 'ITI UP Users', '{status}', u.apna_id, c.vle_id, u.f_name, u.phone_no, u.email_id, NULL,
  CAST(u.next_due_date AS DATE), i.n, i.paid, i.unpaid
FROM ({INSTALMENTS}) i JOIN portal_users u ON u.id = i.users_id
LEFT JOIN portal_centres c ON c.users_id = u.id
WHERE {INSTALMENT_USER} AND {where}"""


INSTALMENTS = """SELECT users_id, count(*) AS n, count(*) FILTER (payment_sts = 1) AS paid,
  count(*) FILTER (payment_sts = 0) AS unpaid FROM instalments GROUP BY users_id"""
INSTALMENT_USER = "u.apna_id ILIKE '%UP%' AND u.mas_user_type_id = 4 AND u.up_vle_status = 2"
FROM_FIRST = f"CAST(p.ExpireTs AS DATE) >= DATE '{FIRST}'"
SPAN = f"BETWEEN DATE '{FIRST}' AND DATE '{LAST}'"
IN_SPAN = f"CAST(p.ExpireTs AS DATE) {SPAN}"
PAID = "u.UserRoleId = 2 AND p.PackageId IN (1, 4)"
FREE = "u.mas_user_type_id = 4 AND u.up_vle_status = 0"
UNION_SQL = "\nUNION ALL ".join(
    [
        _portal_list("ITI UP Users", "active", f"{FREE} AND u.next_due_date > TIMESTAMP '{AS_OF}'"),
        _portal_list(
            "ITI UP Users",
            "active",
            f"{INSTALMENT_USER} AND CAST(u.next_due_date AS DATE) > DATE '{AS_OF}'",
        ),
    ]
)


@query(
    "users_detail",
    *VIEWS,
    sql="\nUNION ALL ".join(
        [
            _package_list(
                "I-NET TN Users", "active", f"{PAID} AND {FROM_FIRST} AND u.UserName ILIKE 'TN%'"
            ),
            _package_list(
                "I-NET TN Users", "inactive", f"{PAID} AND {IN_SPAN} AND u.UserName ILIKE 'TN%'"
            ),
            _package_list(
                "I-NET UP Users",
                "active",
                f"{PAID} AND {FROM_FIRST} AND u.UserName ILIKE 'up01%'",
                True,
            ),
            _package_list(
                "I-NET UP Users",
                "inactive",
                f"{PAID} AND {IN_SPAN} AND u.UserName ILIKE 'up01%'",
                True,
            ),
            _package_list("I-NET PACCS Users", "active", f"u.UserRoleId = 1 AND {FROM_FIRST}"),
            _package_list("I-NET PACCS Users", "inactive", f"u.UserRoleId = 1 AND {IN_SPAN}"),
            _package_list(
                "UPe-District Sultanpur PS Users",
                "active",
                "u.UserRoleId = 2 AND u.UserName ILIKE 'UPPS%'"
                f" AND (year(p.ExpireTs) = 1971 OR {FROM_FIRST})",
            ),
            _package_list(
                "UPe-District Sultanpur PS Users",
                "inactive",
                "u.UserRoleId = 2 AND u.UserName ILIKE 'UPPS%'"
                f" AND year(p.ExpireTs) <> 1971 AND {IN_SPAN}",
            ),
            UNION_SQL,
            _instalment_list("inactive", f"i.unpaid = 0 AND CAST(u.next_due_date AS DATE) {SPAN}"),
            _instalment_list("emi-not-paid", "i.unpaid <> 0"),
            _portal_list(
                "UPe-District Chitrakoot PS Users",
                "active",
                f"u.apna_id ILIKE 'UPPS%' AND (year(u.next_due_date) = 1971 OR CAST(u.next_due_date AS DATE) {SPAN})",
            ),
            _portal_list(
                "UPe-District Chitrakoot PS Users",
                "inactive",
                "u.apna_id ILIKE 'UPPS%' AND year(u.next_due_date) <> 1971"
                f" AND CAST(u.next_due_date AS DATE) < DATE '{FIRST}'",
            ),
        ]
    ),
)
def users_detail(s: Source) -> DataFrame:
    return members.all_member_lists(tables(s), FIRST, LAST, AS_OF)


@query(
    "users_union",
    *VIEWS,
    sql=f"""WITH both_groups(TENANT, STATUS, UserName, Vle_Id, Customer_Name, Phone_Num, Email, pk, Expiry_Date,
  a, b, c) AS ({UNION_SQL})
SELECT UserName, Vle_Id, Customer_Name, Phone_Num, Email, Expiry_Date FROM both_groups""",
)
def users_union(s: Source) -> DataFrame:
    return members.active_portal_users(tables(s), AS_OF)


@query(
    "emi_unpaid",
    *VIEWS,
    sql=f"""SELECT u.apna_id AS UserName, i.n AS total_due_dates, i.paid AS payment_done,
  i.unpaid AS payment_not_done
FROM ({INSTALMENTS}) i JOIN portal_users u ON u.id = i.users_id
WHERE {INSTALMENT_USER} AND i.unpaid <> 0""",
)
def emi_unpaid(s: Source) -> DataFrame:
    return (
        members.instalment_users(tables(s))
        .where(F.col("payment_not_done") != 0)
        .select("UserName", "total_due_dates", "payment_done", "payment_not_done")
    )
