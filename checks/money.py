"""Payments, vouchers, usage and calls: queries and oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.binding import (
    ORDERS_BINDINGS,
    ORDERS_L,
    USAGE_BINDINGS,
    oracle_with,
    orders_tables,
    usage_tables,
)
from sublens.plans import payments, usage


def _orders(build):
    return lambda spark, sf_dir: build(orders_tables(spark, sf_dir))


def _usage(build):
    return lambda spark, sf_dir: build(usage_tables(spark, sf_dir))


def _classified(tables):
    return payments.classified_payments(tables, ORDERS_L).withColumn("amount", F.col("amount").cast("double"))


def _dated(tables):
    days = payments.daily_payments(tables, ORDERS_L)
    joined = days.join(payments.number_intervals(tables, ORDERS_L), "Uid").where(
        (F.col("paid_on") >= F.col("min_date")) & (F.col("paid_on") < F.col("max_date"))
    )
    return joined.select(
        "Uid", "paid_on", "accountnum", "phonenumber", F.col("amount").cast("double").alias("amount"), "failed"
    )


def _tiers(tables):
    report = usage.usage_window(tables, ORDERS_L, "30_days")
    return report.select("in_account_number", "DATA_USAGE_30_days", "Last_30_days_data_usage")


QUERIES = {
    "payment_windows": _orders(lambda t: payments.payments(t, ORDERS_L)),
    "payment_classes": _orders(_classified),
    "number_intervals": _orders(lambda t: payments.number_intervals(t, ORDERS_L)),
    "payment_interval_join": _orders(_dated),
    "last_method": _orders(
        lambda t: payments.payments(t, ORDERS_L).select("IN_ACCOUNT_NUMBER", "PAYMENT_METHOD")
    ),
    "voucher_summary": _orders(lambda t: payments.vouchers(t, ORDERS_L)),
    "recharge_counts": _orders(lambda t: payments.wallet_recharges(t, ORDERS_L)),
    "usage_windows": _usage(lambda t: usage.usage_all_windows(t, ORDERS_L)),
    "usage_months": _usage(lambda t: usage.usage_all_windows(t, ORDERS_L, ("M_0", "M_1", "M_2"))),
    **{
        f"usage_{window}": _usage(lambda t, w=window: usage.usage_window(t, ORDERS_L, w))
        for window in usage.USAGE_COLUMNS
    },
    "usage_tier": _usage(_tiers),
    "usage_core_metrics": _usage(lambda t: usage.daily_usage(t, "1998-06-15", "1998-07-15")),
    "usage_excluding_test": _usage(
        lambda t: usage.without_test_accounts(
            t.history("nobill_aggr_ws_cost_v3", ORDERS_L).groupBy("ad_accountnum").agg(F.count(F.lit(1)).alias("usage_rows")),
            t,
            "ad_accountnum",
        )
    ),
    "prev_day_usage": _usage(lambda t: usage.previous_day_usage(t, ORDERS_L)),
    "call_ratio": _usage(lambda t: usage.call_directions(t, ORDERS_L)),
}

_PAYMENTS = """
money as (
  select t.ID, t.Uid, t.CreationDate, t.CreationDate::date as paid_on, cast(t.Amount as decimal(18, 2)) as amount,
    case s.Status when 'PaymentConfirmed' then 'Success' when 'PaymentRefunded' then 'Refund' else 'Failed' end
      as status,
    case c.ChannelName when 'Spotii' then 'SPOTII' when 'ApplePayCyberSource' then 'APPLE_PAY'
      when 'CreditCardCyberSource' then 'CYBER_SOURCE' else c.ChannelName end as channel
  from payment_paymenttransactions as t
  join payment_paymentstatus as s on s.ID = t.StatusID
  join payment_paymentchannel as c on c.ID = t.PaymentChannelID
  join ref_payment_error as e on e.payment_error_id = t.ErrorID
  join ref_payment_method as m on m.payment_method_id = t.PaymentMethodID
  join payment_paymentdetails as d on d.PaymentTransactionID = t.ID
  join payment_servicetypes as v on v.ID = d.ServiceTypeID
  where t.CreationDate >= timestamp '1998-04-15' and t.CreationDate < timestamp '1998-07-15'
    and c.ChannelName <> 'Voucher')"""

_HELD = """
held as (
  select s.accountnum, s.phonenumber, m.CRM_UID as Uid, s.min_date, s.max_date
  from (select accountnum, phonenumber, min(snapshotdate) as min_date, max(snapshotdate) as max_date
    from nobill_snapshot_subscription group by all) as s
  join customer_master as m on m.MSISDN = s.phonenumber and try_cast(m.IN_ACCOUNT_NUMBER as bigint) = s.accountnum
    and m.FULL_ACTIVATION_DATE::date >= s.min_date and m.FULL_ACTIVATION_DATE::date < s.max_date),
dated as (
  select p.*, h.accountnum, h.phonenumber from money as p
  join held as h on h.Uid = p.Uid and p.CreationDate >= h.min_date and p.CreationDate < h.max_date)"""

_PAYMENT_TABLES = (
    "payment_paymenttransactions payment_paymentstatus payment_paymentchannel ref_payment_error "
    "ref_payment_method payment_paymentdetails payment_servicetypes nobill_snapshot_subscription customer_master"
)

_PAYMENT_WINDOWS = {
    "M_0": ("1998-07-01", "1998-07-15"),
    "M_1": ("1998-06-01", "1998-07-01"),
    "M_2": ("1998-05-01", "1998-06-01"),
    "last_30_days": ("1998-06-14", "1998-07-15"),
    "last_31_60_days": ("1998-05-15", "1998-06-14"),
    "last_61_90_days": ("1998-04-15", "1998-05-15"),
}


def _payment_report() -> str:
    columns = []
    for suffix, (start, end) in _PAYMENT_WINDOWS.items():
        inside = f"paid_on >= date '{start}' and paid_on < date '{end}'"
        columns += [
            f"cast(coalesce(sum(amount) filter (status = 'Success' and {inside}), 0) as double) "
            f"as PAYMENT_TOTAL_AMOUNT_{suffix}",
            f"count(*) filter (status = 'Failed' and {inside}) as PAYMENT_COUNT_FAILED_{suffix}",
        ]
    listed = ",\n  ".join(columns)
    return f"""{_PAYMENTS},{_HELD}
select date '1998-07-14' as load_date, accountnum as IN_ACCOUNT_NUMBER, {listed},
  arg_max(channel, (CreationDate, ID)) as PAYMENT_METHOD
from dated group by accountnum"""


_VOUCHERS = """
redeemed as (
  select a.fad_accountnum, a.fad_time_stamp, a.fad_time_stamp::date as on_day, a.fad_vouchernum,
    cast(a.fad_amount as decimal(18, 2)) as amount
  from nobill_fact_adjustment as a
  join nobill_dim_adjustment_type as t on t.dad_adjustment_type_id = a.fad_adjustment_type_id
  where t.dad_adjustmenttypename = 'voucher' and a.fad_time_stamp < timestamp '1998-07-15')"""


def _recharge_sql() -> str:
    names = {
        "M_0": "WALLET_RECHARGE_COUNT_M_0",
        "M_1": "WALLET_RECHARGE_COUNT_M_1",
        "last_30_days": "WALLET_RECHARGE_COUNT_last_30_days",
        "last_31_60_days": "_last_31_60_days",
        "last_61_90_days": "_last_61_90_days",
    }
    columns = ",\n  ".join(
        f"count(*) filter (on_day >= date '{_PAYMENT_WINDOWS[w][0]}' and on_day < date '{_PAYMENT_WINDOWS[w][1]}') "
        f"as {name}"
        for w, name in names.items()
    )
    return f"{_VOUCHERS}\nselect fad_accountnum, {columns} from redeemed where on_day >= date '1998-04-15' group by 1"


_USAGE_WINDOWS = {
    "30_days": ("1998-06-15", "1998-07-15"),
    "30_60_days": ("1998-05-16", "1998-06-15"),
    "60_90_days": ("1998-04-16", "1998-05-16"),
    "M_0": ("1998-07-01", "1998-07-31"),
    "M_1": ("1998-06-01", "1998-06-30"),
    "M_2": ("1998-05-01", "1998-05-31"),
}
_USAGE_TABLES = (
    "nobill_aggr_ws_cost_v3 nobill_dim_counter_type nobill_dim_transaction_key nobill_dim_test_accounts "
    "nobill_dim_event"
)


_USAGE = """
counted as (
  select u.*, k.*, c.dcr_category_2, c.dcr_counter_type_name,
    u.ad_terminationreason in (0, 6, 7, 8, 10) as answered,
    cast(u.ad_total_revenue_net as decimal(18, 2)) as net,
    cast(u.ad_total_revenue_received as decimal(18, 2)) - cast(u.ad_total_tax_amount as decimal(18, 2)) as received,
    cast(u.ad_total_revenue_received_expired_bundle as decimal(18, 2))
      - cast(u.ad_total_tax_amount_expired_bundle as decimal(18, 2)) as expired,
    cast(u.ad_total_revenue_received_transfer_bundle as decimal(18, 2))
      - cast(u.ad_total_tax_amount_transfer_bundle as decimal(18, 2)) as transferred,
    cast(u.ad_total_adjustment_amount as decimal(18, 2)) as adjusted
  from nobill_aggr_ws_cost_v3 as u
  join nobill_dim_counter_type as c on c.dcr_counter_type_id = u.ad_counter_type_id
  left join nobill_dim_transaction_key as k on k.transaction_id = u.ad_transaction_id
  where try_cast(c.dcr_category_8 as int) in (0, 1)
    and cast(u.ad_accountnum as varchar) not in (select accountnum from nobill_dim_test_accounts
      where accountnum <> '' and exclusion_flag = 'INCLUDE'))"""

_OUT = "service_group = 'Voice' and service_type = 'MOC' and answered and traffic_national_international"
_IN = "service_group = 'Voice' and service_type = 'MTC' and answered and traffic_national_international"


def _window_cte(window: str) -> str:
    start, end = _USAGE_WINDOWS[window]

    def summed(amount: str, test: str) -> str:
        return f"coalesce(sum({amount}) filter ({test}), 0)"

    return f"""
sums_{window} as (
  select ad_accountnum as in_account_number, cast(sum(net) as double) as revenue,
    {summed('ad_total_data_volume', "service_group = 'Data'")} / cast(1073741824 as double) as gb,
    {summed('ad_total_duration', f"{_OUT} = 'National'")} as nat_out,
    {summed('ad_total_duration', f"{_OUT} = 'International'")} as int_out,
    {summed('ad_total_duration', f"{_OUT} = 'Roaming'")} as roam_out,
    {summed('ad_total_duration', f"{_IN} = 'National'")} as nat_in,
    {summed('ad_total_duration', f"{_IN} = 'International'")} as int_in,
    {summed('ad_total_duration', f"{_IN} = 'Roaming'")} as roam_in
  from counted where ad_date between date '{start}' and date '{end}' group by 1),
w_{window} as (
  select in_account_number, {_window_columns(window)} from sums_{window})"""


def _window_columns(window: str) -> str:
    minutes = {
        "national_out": "nat_out",
        "international_out": "int_out",
        "roaming_out": "roam_out",
        "roaming_in": "roam_in",
        "national": "(nat_out + nat_in)",
        "international": "(int_out + int_in)",
        "all_out": "(nat_out + int_out + roam_out)",
    }
    formulas = {name: f"cast({sql} as double) / 60000" for name, sql in minutes.items()}
    formulas |= {
        "data": "gb",
        "data_daily": "gb / 30",
        "arpu": "revenue / 30",
        "tier": "case when gb <= 5 then '5' when gb <= 10 then '10' when gb <= 15 then '15' "
        "when gb <= 25 then '25' when gb <= 50 then '50' else '>50' end",
    }
    names = usage.USAGE_COLUMNS[window]
    return ", ".join(f"{formulas[r]} as {n.format(w=window)}" for r, n in names.items())


def _side_by_side_sql(windows: list[str]) -> str:
    ctes = ",".join(_window_cte(w) for w in windows)
    joins = " ".join(
        f"left join w_{w} on w_{w}.in_account_number is not distinct from a.in_account_number" for w in windows
    )
    columns = ", ".join(f"w_{w}.* exclude (in_account_number)" for w in windows)
    accounts = " union ".join(f"select in_account_number from w_{w}" for w in windows)
    return f"""{_USAGE},{ctes},
a as ({accounts})
select a.in_account_number, {columns} from a {joins}"""


def _core_metrics_sql() -> str:
    voice, data, sms = ("service_group = '%s'" % g for g in ("Voice", "Data", "SMS"))
    moc, mtc = f"{voice} and service_type = 'MOC'", f"{voice} and service_type = 'MTC'"
    to = "traffic_national_international"
    metrics: dict[str, str] = {"ad_total_revenue_net": "cast(sum(net) as double)"}

    def money(name: str, amount: str, test: str) -> None:
        metrics[name] = f"cast(coalesce(sum({amount}) filter ({test}), 0) as double)"

    def scaled(name: str, amount: str, test: str, unit: int) -> None:
        metrics[name] = f"cast(coalesce(sum({amount}) filter ({test}), 0) as double) / {unit}"

    gb, minute = 1073741824, 60000
    for short, traffic in [("int", "International"), ("nat", "National"), ("roaming", "Roaming")]:
        money(f"total_revenue_net_moc_voice_usage_{short}", "received", f"{moc} and {to} = '{traffic}'")
    for name, classes in [
        ("voice_expired_int", "'Voice Plan Intl', 'Voice Intl Booster'"),
        ("voice_expired_nat", "'Voice Plan Natl', 'Voice Natl Booster'"),
        ("voice_expired_roaming", "'Roaming Voice Bundle'"),
        ("expired_data_nat", "'Data Plan', 'Data Booster'"),
        ("expired_data_roaming", "'Roaming Data Bundle'"),
    ]:
        money(f"total_revenue_net_{name}", "expired", f"class in ({classes})")
    money(
        "total_revenue_net_voice_upfront_int",
        "received",
        f"{voice} and event_name = 'Booster_IntlMin_Unlimited'",
    )
    money("total_revenue_net_voice_expired", "expired", voice)
    money("total_revenue_net_data_expired", "expired", data)
    money("total_revenue_net_transfer_data", "transferred", data)
    money("total_revenue_net_data_usage_nat", "received", f"{data} and {to} = 'National'")
    money("total_revenue_net_data_usage_roaming", "received", f"{data} and {to} = 'Roaming'")
    money("total_revenue_net_sms", "received", sms)
    money("total_revenue_net_mtc", "received", mtc)
    money("total_amount_recharge", "adjusted", "service_group = 'Recharge'")
    metrics["total_count_sms"] = f"cast(coalesce(sum(ad_total_sms) filter ({sms}), 0) as bigint)"
    scaled("total_mins_incoming", "ad_total_duration", f"{mtc} and answered", minute)
    scaled("total_roaming_minutes_outgoing", "ad_total_duration", f"{_OUT} = 'Roaming'", minute)
    for short, long, traffic in [
        ("nat", "national", "National"),
        ("intl", "international", "International"),
        ("roaming", "roaming", "Roaming"),
    ]:
        money(f"total_revenue_net_sms_{short}", "received", f"{sms} and {to} = '{traffic}'")
        money(f"total_revenue_net_mtc_{short}", "received", f"{mtc} and {to} = '{traffic}'")
        metrics[f"total_count_sms_{short}"] = (
            f"cast(coalesce(sum(ad_total_sms) filter ({sms} and {to} = '{traffic}'), 0) as bigint)"
        )
        scaled(f"total_{long}_minutes_incoming", "ad_total_duration", f"{_IN} = '{traffic}'", minute)
        if long != "roaming":
            out = f"{_OUT} = '{traffic}'"
            scaled(f"total_{long}_minutes_outgoing", "ad_total_duration", out, minute)
            scaled(f"total_{long}_minutes_outgoing_pay", "ad_total_duration_payg", out, minute)
            scaled(
                f"total_{long}_minutes_outgoing_bundle",
                "ad_total_duration_counter",
                f"{out} and dcr_category_2 = 'Voice Bundle'",
                minute,
            )
    volume = "ad_total_data_volume"
    scaled("total_volume_data", volume, data, gb)
    scaled("total_data_payg", f"{volume}_payg", data, gb)
    scaled("total_data_usage_national", f"{volume}_counter", f"{data} and {to} = 'National'", gb)
    scaled("total_data_usage_roaming", f"{volume}_counter", f"{data} and {to} = 'Roaming'", gb)
    scaled("total_data_usage_bundle", f"{volume}_counter", f"{data} and dcr_category_2 = 'Data Bundle'", gb)
    scaled(
        "total_data_usage_transfer",
        "ad_total_counter_data_volume_transfer",
        "dcr_counter_type_name = 'AC.Sender_DataCounter'",
        gb,
    )
    listed = ",\n  ".join(f"{sql} as {name}" for name, sql in metrics.items())
    return f"""{_USAGE},
event_classes as (
  select dev_eventid_base, max(dev_category_3) as class, max(dev_event_name) as event_name
  from nobill_dim_event group by 1)
select ad_date, ad_accountnum as IN_ACCOUNT_NUMBER,
  {listed}
from counted left join event_classes on dev_eventid_base = ad_eventid
where ad_date between date '1998-06-15' and date '1998-07-15' group by 1, 2"""


_orders_sql = {
    "payment_windows": (_PAYMENT_TABLES, _payment_report()),
    "payment_classes": (
        _PAYMENT_TABLES,
        f"""{_PAYMENTS}
select ID, Uid, CreationDate, paid_on, status, channel, cast(sum(amount) as double) as amount, count(*) as times
from money group by all""",
    ),
    "number_intervals": (
        _PAYMENT_TABLES,
        f"{_PAYMENTS},{_HELD} select accountnum, phonenumber, min_date, max_date, Uid from held",
    ),
    "payment_interval_join": (
        _PAYMENT_TABLES,
        f"""{_PAYMENTS},{_HELD}
select Uid, paid_on, accountnum, phonenumber,
  cast(coalesce(sum(amount) filter (status = 'Success'), 0) as double) as amount,
  count(*) filter (status = 'Failed') as failed
from dated group by all""",
    ),
    "last_method": (
        _PAYMENT_TABLES,
        f"""{_PAYMENTS},{_HELD}
select accountnum as IN_ACCOUNT_NUMBER, arg_max(channel, (CreationDate, ID)) as PAYMENT_METHOD
from dated group by accountnum""",
    ),
    "voucher_summary": (
        "nobill_fact_adjustment nobill_dim_adjustment_type cas_tx_activations",
        f"""{_VOUCHERS},
owners as (select CRMAccountNo, try_cast(max(NobillAccountNo) as bigint) as acct from cas_tx_activations group by 1),
ranked as (
  select *, row_number() over (partition by fad_accountnum
    order by fad_time_stamp desc, fad_vouchernum desc, amount desc) as place
  from redeemed where on_day >= date '1998-01-16'),
repeated as (select r.*, o.CRMAccountNo from ranked as r left join owners as o on o.acct = r.fad_accountnum)
select date '1998-07-14' as load_date, fad_accountnum as IN_ACCOUNT_NUMBER,
  cast(coalesce(sum(amount) filter (on_day >= date '1998-06-14'), 0) as double) as VOUCHERS_TOTAL_VALUE_REDEEMED,
  count(*) filter (on_day >= date '1998-06-14') as VOUCHERS_TOTAL_COUNT,
  cast(date '1998-07-15' - max(on_day) as int) as VOUCHER_LAST_REDEMPTION_DATE,
  cast(max(amount) filter (place = 1) as double) as VOUCHER_LAST_REDEEMED_AMOUNT
from repeated group by fad_accountnum""",
    ),
    "recharge_counts": ("nobill_fact_adjustment nobill_dim_adjustment_type", _recharge_sql()),
}

_usage_sql = {
    "usage_windows": (_USAGE_TABLES, _side_by_side_sql(list(_USAGE_WINDOWS))),
    "usage_months": (_USAGE_TABLES, _side_by_side_sql(["M_0", "M_1", "M_2"])),
    **{
        f"usage_{w}": (_USAGE_TABLES, f"{_USAGE},{_window_cte(w)} select * from w_{w}")
        for w in _USAGE_WINDOWS
    },
    "usage_tier": (
        _USAGE_TABLES,
        f"""{_USAGE},{_window_cte('30_days')}
select in_account_number, DATA_USAGE_30_days, Last_30_days_data_usage from w_30_days""",
    ),
    "usage_core_metrics": (_USAGE_TABLES, _core_metrics_sql()),
    "usage_excluding_test": (
        "nobill_aggr_ws_cost_v3 nobill_dim_test_accounts",
        """
select ad_accountnum, count(*) as usage_rows from nobill_aggr_ws_cost_v3
where cast(ad_accountnum as varchar) not in (select accountnum from nobill_dim_test_accounts
  where accountnum <> '' and exclusion_flag = 'INCLUDE')
group by 1""",
    ),
    "prev_day_usage": (
        _USAGE_TABLES,
        f"""{_USAGE}
select ad_accountnum as in_account_number,
  coalesce(sum(ad_total_data_volume) filter (service_group = 'Data'), 0) / cast(1073741824 as double)
    as PREVIOUS_DAY_DATA_USAGE
from counted where ad_date = date '1998-07-15' group by 1""",
    ),
    "call_ratio": (
        "nobill_fact_usage nobill_dim_termzone nobill_dim_origzone nobill_ref_terminationreason",
        """
calls as (
  select u.fus_accountnum as account_number, u.fus_call_direction_id as direction
  from nobill_fact_usage as u
  join nobill_dim_termzone as t on t.dtz_termzone_id = u.fus_termzone_id
  join nobill_dim_origzone as o on o.doz_origzone_id = u.fus_origzone_id
  left join (select * from nobill_ref_terminationreason where fus_service_type_id = 1) as r
    on r.fus_terminationreason = u.fus_terminationreason
  where u.fus_time_stamp::date between date '1998-06-15' and date '1998-07-15' and u.fus_service_type_id = 1)
select account_number, count(*) filter (direction = 1) as incoming_count,
  count(*) filter (direction = 2) as outgoing_count,
  coalesce(count(*) filter (direction = 2) / nullif(count(*) filter (direction = 1), 0), 0)
    as INCOMING_OUTGOING_CALLS_PERC
from calls group by 1""",
    ),
}

ORACLES = {
    **{k: oracle_with(ORDERS_BINDINGS, names, sql) for k, (names, sql) in _orders_sql.items()},
    **{k: oracle_with(USAGE_BINDINGS, names, sql) for k, (names, sql) in _usage_sql.items()},
}
