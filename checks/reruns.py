"""Reports of many load dates from one scan, and reports carried from day to day: queries and oracles."""

from __future__ import annotations

import uuid
from datetime import timedelta

from checks import engage, lines, money, platform
from checks.binding import (
    EVENTS_BINDINGS,
    EVENTS_L,
    ORDERS_BINDINGS,
    ORDERS_L,
    USAGE_BINDINGS,
    events_tables,
    oracle_with,
    orders_tables,
    usage_tables,
)
from sublens.plans import booster, customer_base, disconnection, engagement, payments, usage
from sublens.sources.folders import shared_folder

LOAD_DATES = [ORDERS_L - timedelta(days=n) for n in range(30)]
EVENT_LOAD_DATES = [EVENTS_L - timedelta(days=n) for n in range(30)]
CARRIED_DAYS = 3


def usage_day_by_day(spark, sf_dir: str):
    """The usage report of L, carried on from L - 3 one day at a time."""
    tables = usage_tables(spark, sf_dir)
    state = usage.usage_state(spark, f"{shared_folder(spark)}/usage-state-{uuid.uuid4().hex}")
    day = ORDERS_L - timedelta(days=CARRIED_DAYS)
    report = usage.start_usage(tables, state, day)
    while day < ORDERS_L:
        following = day + timedelta(days=1)
        report = usage.advance_usage(tables, state, day, following)
        day = following
    return report


def _chain(last, step):
    """``step(load date, the one before)`` for some days in a row, the first without one before."""
    result, before = None, None
    for n in range(CARRIED_DAYS, -1, -1):
        day = last - timedelta(days=n)
        result, before = step(day, before), day
    return result


def latest_block_day_by_day(spark, sf_dir: str):
    tables, name = events_tables(spark, sf_dir), f"latest_block_{uuid.uuid4().hex}"
    state = customer_base.latest_block_state(spark, name, f"{shared_folder(spark)}/{name}", buckets=8)
    return _chain(EVENTS_L, lambda day, before: customer_base.latest_block_from(tables, state, day, before))


def block_pairing_day_by_day(spark, sf_dir: str):
    tables = events_tables(spark, sf_dir)
    state = disconnection.block_state(spark, f"{shared_folder(spark)}/block-state-{uuid.uuid4().hex}")
    pairs = _chain(EVENTS_L, lambda day, before: disconnection.paired_blocks_from(tables, state, day, before))
    return disconnection.shown_until_load_date(pairs, EVENTS_L)


def countries_day_by_day(spark, sf_dir: str):
    """Countries visited up to L from stored days, of which the last ones were taken in one at a time."""
    tables = events_tables(spark, sf_dir)
    state = engagement.network_state(spark, f"{shared_folder(spark)}/network-state-{uuid.uuid4().hex}")
    day = EVENTS_L - timedelta(days=CARRIED_DAYS)
    engagement.store_networks(tables, state, min(start for start, _ in engagement.roaming_windows(day).values()), day)
    while day < EVENTS_L:
        following = day + timedelta(days=1)
        engagement.store_networks(tables, state, day, following)
        day = following
    return engagement.countries_from(tables, state, EVENTS_L)


QUERIES = {
    "payment_reruns": lambda spark, sf_dir: payments.payments_over_dates(orders_tables(spark, sf_dir), LOAD_DATES),
    "recharge_reruns": lambda spark, sf_dir: payments.wallet_recharges_over_dates(
        orders_tables(spark, sf_dir), LOAD_DATES
    ),
    "usage_reruns": lambda spark, sf_dir: usage.usage_over_dates(usage_tables(spark, sf_dir), LOAD_DATES),
    "booster_reruns": lambda spark, sf_dir: booster.booster_purchases_over_dates(
        orders_tables(spark, sf_dir), LOAD_DATES
    ),
    "usage_day_by_day": usage_day_by_day,
    "latest_block_day_by_day": latest_block_day_by_day,
    "block_pairing_day_by_day": block_pairing_day_by_day,
    "countries_reruns": lambda spark, sf_dir: engagement.countries_over_dates(
        events_tables(spark, sf_dir), EVENT_LOAD_DATES
    ),
    "countries_day_by_day": countries_day_by_day,
}

# Every load date L with the first day of the month of L - 1 (m0) and of its own month (u0). Each oracle sums the
# facts once for every load date, as separate runs would.
_DATES = """
load_dates as (
  select cast(d as date) as L, cast(date_trunc('month', d - interval 1 day) as date) as m0,
    cast(date_trunc('month', d) as date) as u0
  from range(timestamp '1998-06-16', timestamp '1998-07-16', interval 1 day) as r(d))"""

_PAYMENT_WINDOWS = {
    "M_0": ("m0", "L"),
    "M_1": ("m0 - interval 1 month", "m0"),
    "M_2": ("m0 - interval 2 month", "m0 - interval 1 month"),
    "last_30_days": ("L - 31", "L"),
    "last_31_60_days": ("L - 61", "L - 31"),
    "last_61_90_days": ("L - 91", "L - 61"),
}


def _payments_sql() -> str:
    columns = []
    for suffix, (start, end) in _PAYMENT_WINDOWS.items():
        inside = f"paid_on >= {start} and paid_on < {end}"
        columns += [
            f"cast(coalesce(sum(amount) filter (status = 'Success' and {inside}), 0) as double) "
            f"as PAYMENT_TOTAL_AMOUNT_{suffix}",
            f"count(*) filter (status = 'Failed' and {inside}) as PAYMENT_COUNT_FAILED_{suffix}",
        ]
    listed = ",\n  ".join(columns)
    money_since = money._PAYMENTS.replace("1998-04-15", "1998-03-17")
    return f"""{_DATES},{money_since},
held as (
  select s.L, s.m0, s.accountnum, m.CRM_UID as Uid, s.min_date, s.max_date
  from (select L, m0, accountnum, phonenumber, min(snapshotdate) as min_date, max(snapshotdate) as max_date
    from nobill_snapshot_subscription join load_dates on snapshotdate < L group by all) as s
  join customer_master as m on m.MSISDN = s.phonenumber and try_cast(m.IN_ACCOUNT_NUMBER as bigint) = s.accountnum
    and m.FULL_ACTIVATION_DATE::date >= s.min_date and m.FULL_ACTIVATION_DATE::date < s.max_date)
select L - 1 as load_date, accountnum as IN_ACCOUNT_NUMBER, {listed},
  arg_max(channel, (CreationDate, ID)) as PAYMENT_METHOD
from money as p join held as h on h.Uid = p.Uid and p.CreationDate >= h.min_date and p.CreationDate < h.max_date
  and p.paid_on >= h.L - 91 and p.paid_on < h.L
group by L, accountnum"""


def _recharges_sql() -> str:
    columns = ",\n  ".join(
        f"count(*) filter (on_day >= {start} and on_day < {end}) as {name}"
        for window, name in [
            ("M_0", "WALLET_RECHARGE_COUNT_M_0"),
            ("M_1", "WALLET_RECHARGE_COUNT_M_1"),
            ("last_30_days", "WALLET_RECHARGE_COUNT_last_30_days"),
            ("last_31_60_days", "_last_31_60_days"),
            ("last_61_90_days", "_last_61_90_days"),
        ]
        for start, end in [_PAYMENT_WINDOWS[window]]
    )
    return f"""{_DATES},{money._VOUCHERS}
select L as load_date, fad_accountnum, {columns}
from redeemed join load_dates on on_day >= L - 91 and on_day < L group by L, fad_accountnum"""


_USAGE_WINDOWS = {
    "30_days": ("L - 30", "L"),
    "30_60_days": ("L - 60", "L - 30"),
    "60_90_days": ("L - 90", "L - 60"),
    "M_0": ("u0", "L"),
    "M_1": ("u0 - interval 1 month", "u0 - 1"),
    "M_2": ("u0 - interval 2 month", "u0 - interval 1 month - interval 1 day"),
}


def _usage_sql() -> str:
    ctes = []
    for window, (start, end) in _USAGE_WINDOWS.items():
        first, last = money._USAGE_WINDOWS[window]
        one = f"from counted where ad_date between date '{first}' and date '{last}' group by 1"
        every = f"from counted join load_dates on ad_date between {start} and {end} group by all"
        cte = money._window_cte(window)
        assert one in cte
        ctes.append(
            cte.replace(one, every)
            .replace("select ad_accountnum as", "select L, ad_accountnum as")
            .replace("select in_account_number,", "select L, in_account_number,")
        )
    windows = list(_USAGE_WINDOWS)
    joins = " ".join(
        f"left join w_{w} on w_{w}.L = a.L and w_{w}.in_account_number is not distinct from a.in_account_number"
        for w in windows
    )
    columns = ", ".join(f"w_{w}.* exclude (L, in_account_number)" for w in windows)
    accounts = " union ".join(f"select L, in_account_number from w_{w}" for w in windows)
    return f"""{_DATES},{money._USAGE},{",".join(ctes)},
a as ({accounts})
select a.L as load_date, a.in_account_number, {columns} from a {joins}"""


def _boosters_sql() -> str:
    sql = platform._profile_sql()
    for fixed, moving in {
        "date '1998-07-15'": "L",
        "date '1998-07-08'": "L - 7",
        "date '1998-06-15'": "L - 30",
        "date '1998-05-16'": "L - 60",
        "date '1998-04-16'": "L - 90",
        "date '1998-04-14'": "L - 92",
        "date '1998-07-01'": "m0",
        "date '1998-06-01'": "m0 - interval 1 month",
        "date '1998-05-01'": "m0 - interval 2 month",
        "select EVENT_IN_ACCOUNT_NUMBER as": "select L, EVENT_IN_ACCOUNT_NUMBER as",
        "select e.EVENT_IN_ACCOUNT_NUMBER as": "select L, e.EVENT_IN_ACCOUNT_NUMBER as",
        "from event_in_booster where": "from event_in_booster join load_dates on EVENT_IN_DATE < L where",
        "from event_in_booster as e left join": "from load_dates, event_in_booster as e left join",
        "group by 1)": "group by 1, 2)",
        "using (IN_ACCOUNT_NUMBER)": "using (L, IN_ACCOUNT_NUMBER)",
        "select IN_ACCOUNT_NUMBER,": "select L as load_date, IN_ACCOUNT_NUMBER,",
    }.items():
        assert fixed in sql, fixed
        sql = sql.replace(fixed, moving)
    return f"{_DATES},{sql}"


def _countries_sql(first: str, behind: str) -> str:
    counts = ",\n  ".join(
        f"count(distinct country) filter (seen_on >= cast(L - 1 - interval {n} month as date)) as RLH_UNIQUE_COUNTRY_{n}M"
        for n in (1, 3, 6)
    )
    # All messages; the load dates cut them to their own windows.
    window = "and m.DATETIME::date >= date '2023-07-24' and m.DATETIME::date < date '2024-01-25'"
    assert window in engage._MESSAGES
    seen = engage._MESSAGES.replace(window, "").split("moves as")[0].rstrip().rstrip(",")
    return f"""
load_dates as (select cast(d as date) as L from range(timestamp '{first}', timestamp '{behind}', interval 1 day) as r(d)),
{seen}
select L as load_date, MSISDN, {counts}
from messages join load_dates on seen_on >= cast(L - 1 - interval 6 month as date) and seen_on < L
where country <> 'Uae' group by L, MSISDN"""


_MESSAGE_TABLES = "roaming_ussd_received_data dim_roam_country_operator"
_VOUCHER_TABLES = "nobill_fact_adjustment nobill_dim_adjustment_type"
ORACLES = {
    "payment_reruns": oracle_with(ORDERS_BINDINGS, money._PAYMENT_TABLES, _payments_sql()),
    "recharge_reruns": oracle_with(ORDERS_BINDINGS, _VOUCHER_TABLES, _recharges_sql()),
    "usage_reruns": oracle_with(USAGE_BINDINGS, money._USAGE_TABLES, _usage_sql()),
    "booster_reruns": oracle_with(ORDERS_BINDINGS, "event_in_booster po_service_file", _boosters_sql()),
    "usage_day_by_day": money.ORACLES["usage_windows"],
    "latest_block_day_by_day": lines.ORACLES["latest_block"],
    "block_pairing_day_by_day": lines.ORACLES["block_pairing"],
    "countries_reruns": oracle_with(EVENTS_BINDINGS, _MESSAGE_TABLES, _countries_sql("2023-12-27", "2024-01-26")),
    "countries_day_by_day": oracle_with(
        EVENTS_BINDINGS,
        _MESSAGE_TABLES,
        _countries_sql("2024-01-25", "2024-01-26").replace("select L as load_date, MSISDN", "select MSISDN"),
    ),
}
