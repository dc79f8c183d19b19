"""Services, boosters, plans, pauses and data sharing: queries and oracles."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from checks.binding import ORDERS_BINDINGS, ORDERS_L, oracle_with, orders_tables
from sublens.plans import booster, engagement, plan, services

# The orders start in 1995; the service platform's own start dates lie later.
HISTORY_SINCE = date(1995, 6, 1)


def _orders(build):
    return lambda spark, sf_dir: build(orders_tables(spark, sf_dir))


def _service_master(tables):
    return services.service_master(tables).withColumn("ServiceCost", F.col("ServiceCost").cast("double"))


def _slots(tables):
    filled = plan.service_slots(plan.plan_actions(tables, ORDERS_L), tables)
    return filled.select(
        "Id", "NobillAccountNo", "Plan_Rank", "NATL_SERVICE", "DATA_SERVICE", "INTL_SERVICE",
        "PLAN_DESCRIPTION", "COMBO_ID",
    )


def _plan_part(*columns):
    return lambda tables: plan.account_plans(tables, ORDERS_L).select("NobillAccountNo", *columns)


def _renewals(tables):
    dated = plan.renewal_dates(plan.account_plans(tables, ORDERS_L), tables, ORDERS_L)
    return dated.select(
        "NobillAccountNo", "Actual_TotalCost", "Remaining_Renewal_Month", "ANNUAL_PLANS_RENEWAL_DATE"
    )


def _doubles(df, *names):
    return df.withColumns({n: F.col(n).cast("double") for n in names})


QUERIES = {
    "service_master": _orders(_service_master),
    "first_event_rows": _orders(
        lambda t: services.first_event_rows(t).select("dev_eventid_base", "dev_event_id", "dev_category_3")
    ),
    "action_payments": _orders(lambda t: _doubles(services.action_payments(t, ORDERS_L), "PaidAmount")),
    "latest_action_per_group": _orders(
        lambda t: services.latest_action_per_group(t, ORDERS_L, HISTORY_SINCE).select(
            "IN_ACCOUNT_NUMBER", "ServiceGroup", "dev_category_3", "Id", "EventId"
        )
    ),
    "service_pivot": _orders(lambda t: services.event_action_history(t, ORDERS_L, HISTORY_SINCE)),
    "booster_buckets": _orders(lambda t: booster.booster_counts(t, ORDERS_L)),
    "purchase_profile": _orders(lambda t: booster.booster_purchases(t, ORDERS_L)),
    "positive_balances": _orders(
        lambda t: _doubles(plan.latest_positive_balances(t, ORDERS_L), "balance")
    ),
    "running_balance": _orders(lambda t: plan.running_balance(t, ORDERS_L)),
    "package_prices": _orders(plan.package_prices),
    "plan_services": _orders(plan.plan_services),
    "product_group": _orders(plan.product_groups),
    "preferred_customers": _orders(
        lambda t: plan.preferred_customers(t).select("NobillAccountNo", "Id", "Renewal_cycle")
    ),
    "payment_split": _orders(
        lambda t: _doubles(
            plan.payment_split(t, ORDERS_L),
            "PaidAmount", "Cashback_PaidAmount", "Loyalty_PaidAmount", "Promotion_PaidAmount",
        )
    ),
    "plan_slots": _orders(_slots),
    "six_month_streak": _orders(
        _plan_part("CONSECUTIVE_6MONTHS_ON_MONTHLY", "CONSECUTIVE_6MONTHS_ON_MONTHLY_AMOUNT_PAID")
    ),
    "plan_change": _orders(_plan_part("PLAN_STATUS", "FLAG_PLAN_CHANGE")),
    "last_plan": _orders(_plan_part("LAST_PLAN_TYPE", "LAST_PLAN_DESCRIPTION", "LAST_RENEWAL_DATE")),
    "prior_plan_types": _orders(
        _plan_part("PLAN_TYPE_15DAYS_PRIOR", "PLAN_TYPE_30DAYS_PRIOR", "PLAN_TYPE_60DAYS_PRIOR")
    ),
    "annual_renewal": _orders(_renewals),
    "tenure_months": _orders(lambda t: plan.tenure_months(t, ORDERS_L)),
    "plan_report": _orders(lambda t: plan.plan_report(t, ORDERS_L)),
    "paused_no_active": _orders(lambda t: plan.plan_paused(t, ORDERS_L)),
    "sharing_balance": _orders(lambda t: engagement.data_sharing(t, ORDERS_L, HISTORY_SINCE)),
}

_EVENT_ROWS = """
event_rows as (
  select * from nobill_dim_event
  qualify row_number() over (partition by dev_eventid_base order by dev_event_id) = 1)"""

_MASTER = f"""{_EVENT_ROWS},
master as (
  select cast(s.Id as bigint) as ServiceId, s.Name as ServiceName, s.ServiceChargingTypeId, s.ServiceTypeId,
    s.ServiceCategoryId, cast(s.ServiceCost as double) as ServiceCost, s.StatusId as ServiceStatusId,
    b.CustomerServiceName, b.CounterId, s.CreationDate as ServiceCreationDate, b.EventId, e.dev_event_desc, e.dev_category_1, e.dev_category_2, e.dev_category_3, e.dev_category_4,
    c.Name as ServiceCategoryName, t.Name as ServiceTypeName, g.Name as ServiceChargingTypeName,
    case when e.dev_category_1 = 'VAS' then 'VAS' when lower(e.dev_category_3) like '%booster%' then 'Booster'
      when lower(e.dev_category_3) like '%roaming%' then 'Roaming' else 'Others' end as ServiceGroup
  from po_po_service as s
  left join po_po_servicecategory as c on c.Id = s.ServiceCategoryId
  left join po_po_servicetype as t on t.Id = s.ServiceTypeId
  left join po_po_servicechargingtype as g on g.Id = s.ServiceChargingTypeId
  left join po_po_bundle as b on b.ServiceId = s.Id
  left join event_rows as e on e.dev_eventid_base = b.EventId)"""
_MASTER_TABLES = (
    "po_po_service po_po_servicecategory po_po_servicetype po_po_servicechargingtype po_po_bundle "
    "nobill_dim_event"
)

_NEWEST_ACTIONS = f"""{_MASTER},
newest as (
  select c.NobillAccountNo as IN_ACCOUNT_NUMBER, m.ServiceGroup, m.dev_category_3, h.Id, m.EventId,
    h.DateTime, h.SubscriptionId
  from po_sre_actionhistory as h
  join master as m on m.ServiceId = try_cast(split_part(h.ServiceIds, ',', 1) as bigint)
  left join po_sre_customer as c on c.Id = h.CustomerId
  where h.DateTime::date >= date '1995-06-01' and h.DateTime::date < date '1998-07-15'
    and length(h.ServiceIds) > 1 and h.StatusId = 2 and h.ActionId <> 30
    and length(h.ServiceIds) - length(replace(h.ServiceIds, ',', '')) < 2
    and m.ServiceGroup <> 'Others'
  qualify row_number() over (partition by c.NobillAccountNo, m.ServiceGroup, m.dev_category_3
    order by h.Id desc, m.EventId) = 1)"""

_PAID_120 = """
paid_120 as (
  select ActionHistoryId, sum(cast(PaidAmount as decimal(18, 2))) as PaidAmount from po_sre_paymenthistory
  where IsSuccess and DateTime >= timestamp '1998-03-17' and DateTime < timestamp '1998-07-15'
    and ActionHistoryId is not null and PaidAmount > 0
  group by ActionHistoryId)"""


def _service_pivot_sql() -> str:
    """One FILTER aggregate per output column."""
    load = "date '1998-07-15'"
    vas = "kind in ('VOIP', 'Netflix', 'Anghami', 'AppleWatch', 'Entertainer')"

    def alive(test: str) -> str:
        return f"cast(coalesce(max(last_day) filter ({test}) >= {load}, false) as int)"

    columns = {
        "VAS_SERVICE_FLAG": alive(vas),
        "VAS_RENEWAL_DATE": f"coalesce(min(last_day) filter ({vas} and last_day >= {load}), "
        f"max(last_day) filter ({vas}))",
        "VAS_TOTAL_AMOUNT": f"cast(sum(case when {vas} and began_at >= timestamp '1998-06-15' "
        "then PaidAmount else 0 end) as double)",
        "VAS_USAGE_RIGHT_FLAG": "0",
        "DAYS_SINCE_LAST_BOOSTER_PURCHASE": f"cast({load} - max(first_day) filter (class = 'Booster') as int)",
        "DAYS_SINCE_BOOSTER_EXPIRY": f"cast({load} - max(last_day) filter (class = 'Booster') as int)",
        "DAYS_TILL_BOOSTER_EXPIRY": f"cast(max(last_day) filter (class = 'Booster') - {load} as int)",
    }
    for flag, renewal, kind in [
        ("VOIP_SERVICE", "VOIP_RENEWAL_DATE", "VOIP"),
        ("BOTIM_SERVICE_FLAG", "BOTIM_RENEWAL_DATE", "VOIP"),
        ("NETFLIX_SERVICE_FLAG", "NETFLIX_RENEWAL_DATE", "Netflix"),
        ("ANGHAMI_SERVICE_FLAG", "ANGHAMI_RENEWAL_DATE", "Anghami"),
        ("APPLE_WATCH_SERVICE", "APPLE_WATCH_RENEWAL_DATE", "AppleWatch"),
        ("ENTERTAINER_SERVICE_FLAG", "ENTERTAINER_RENEWAL_DATE", "Entertainer"),
    ]:
        columns[flag] = alive(f"kind = '{kind}'")
        columns[renewal] = f"max(last_day) filter (kind = '{kind}')"
    for name, kind in [
        ("DATA_ROAMING_BUNDLE", "DATA_ROM"),
        ("VOICE_ROAMING_BUNDLE", "VOICE_OUT_ROM"),
        ("DATA_ROAMING_PASS", "DATA_PASS_ROM"),
        ("VOICE_ROAMING_PASS", "VOICE_PASS_ROM"),
    ]:
        columns[f"LAST_{name}"] = f"max(label) filter (kind = '{kind}')"
        columns[f"LAST_{name}_PURCHASE_DATE"] = f"max(first_day) filter (kind = '{kind}')"
    for name, kind in [("DATA", "DATA"), ("NATL", "VOICE_LCL"), ("INTL", "VOICE_INT")]:
        test = f"class = 'Booster' and kind = '{kind}'"
        columns[f"BOOSTER_LAST_{name}"] = f"max(label) filter ({test})"
        columns[f"BOOSTER_LAST_DATE_{name}"] = f"max(first_day) filter ({test})"
        columns[f"DAYS_SINCE_{name}_BOOSTER_EXPIRY"] = f"cast({load} - max(last_day) filter ({test}) as int)"
        columns[f"DAYS_TILL_{name}_BOOSTER_EXPIRY"] = f"cast(max(last_day) filter ({test}) - {load} as int)"
    listed = ",\n  ".join(f"{sql} as {name}" for name, sql in columns.items())
    return f"""{_NEWEST_ACTIONS},{_PAID_120},
dated as (
  select n.IN_ACCOUNT_NUMBER, f.EXCEL_SERVICE_TYPE as kind, f.EXCEL_SERVICE_CATEGORY as class,
    f.EXCEL_SERVICE_DESCRIPTION as label, s.StartDate::date as first_day, s.EndDate::date as last_day,
    n.DateTime as began_at, p.PaidAmount
  from newest as n
  left join po_service_file as f on f.EXCEL_SERVICE_EVENT_ID = cast(n.EventId as varchar)
  left join po_sre_subscription as s on s.Id = n.SubscriptionId
  left join paid_120 as p on p.ActionHistoryId = n.Id
  where n.EventId <> 109 and length(n.IN_ACCOUNT_NUMBER) > 1 and strpos(n.IN_ACCOUNT_NUMBER, '_') = 0)
select IN_ACCOUNT_NUMBER,
  {listed}
from dated group by IN_ACCOUNT_NUMBER"""


_BOOSTER_WINDOWS = {
    "LAST_7DAYS": ("1998-07-08", "1998-07-15"),
    "LAST_30DAYS": ("1998-06-15", "1998-07-15"),
    "LAST_31_60DAYS": ("1998-05-16", "1998-06-15"),
    "LAST_61_90DAYS": ("1998-04-16", "1998-05-16"),
    "M0": ("1998-07-01", "1998-07-15"),
    "M1": ("1998-06-01", "1998-07-01"),
    "M2": ("1998-05-01", "1998-06-01"),
}


def _booster_sql() -> str:
    """In-life figures and window figures apart, joined per account."""
    life, recent = [], []
    for name, kind in [("NATL", "VOICE_LCL"), ("INTL", "VOICE_INT"), ("DATA", "DATA")]:
        mine = f"EVENT_IN_EVENT_GROUP = 'Booster' and EVENT_IN_SERVICE_TYPE = '{kind}'"
        life += [
            f"cast(coalesce(sum(EVENT_IN_TOTAL_QUANTITY) filter ({mine}), 0) as double) as TOTAL_{name}_BOOSTER_QTY",
            f"max(EVENT_IN_DATE) filter ({mine}) as LAST_{name}_BOOSTER_DATE",
            f"cast(coalesce(sum(EVENT_IN_TOTAL_QUANTITY) filter ({mine} and EVENT_IN_DATE < date '1998-06-15'), 0) "
            f"as double) as TOTAL_{name}_BOOSTER_BEFORE30D_QTY",
        ]
        for suffix, (start, end) in _BOOSTER_WINDOWS.items():
            test = (
                f"e.EVENT_IN_EVENT_GROUP = 'Booster' and f.EXCEL_SERVICE_TYPE = '{kind}' "
                f"and e.EVENT_IN_DATE >= date '{start}' and e.EVENT_IN_DATE < date '{end}'"
            )
            recent.append(
                f"cast(coalesce(sum(e.EVENT_IN_TOTAL_QUANTITY) filter ({test}), 0) as double) "
                f"as BOOSTER_TOTAL_{name}_COUNT_{suffix}"
            )
    lists = (",\n    ".join(life), ",\n    ".join(recent))
    return f"""
life as (
  select EVENT_IN_ACCOUNT_NUMBER as IN_ACCOUNT_NUMBER,
    {lists[0]}
  from event_in_booster where EVENT_IN_EVENT_GROUP in ('Booster', 'Roaming') group by 1),
recent as (
  select e.EVENT_IN_ACCOUNT_NUMBER as IN_ACCOUNT_NUMBER,
    {lists[1]}
  from event_in_booster as e left join po_service_file as f on f.EXCEL_SERVICE_EVENT_ID = e.EVENT_IN_EVENT_ID
  where e.EVENT_IN_EVENT_GROUP in ('Booster', 'Roaming')
    and e.EVENT_IN_DATE >= date '1998-04-14' and e.EVENT_IN_DATE < date '1998-07-15' group by 1),
counts as (select * from life left join recent using (IN_ACCOUNT_NUMBER))"""


def _profile_sql() -> str:
    def profile(name: str) -> str:
        return f"""
  case when TOTAL_{name}_BOOSTER_QTY = 0 then 'Never'
    when BOOSTER_TOTAL_{name}_COUNT_LAST_30DAYS >= 1 then
      case when BOOSTER_TOTAL_{name}_COUNT_LAST_31_60DAYS >= 1 then 'Frequent'
        when TOTAL_{name}_BOOSTER_BEFORE30D_QTY <= 0 then '1st Time' else 'Occasional' end
    when coalesce(BOOSTER_TOTAL_{name}_COUNT_LAST_30DAYS, 0) = 0
      and TOTAL_{name}_BOOSTER_BEFORE30D_QTY = 1 then 'One Time' else 'Occasional' end
    as BOOSTER_PURCHASE_PROFILE_{name}"""

    known = [f"BOOSTER_TOTAL_{n}_COUNT_{w}" for n in ("NATL", "INTL", "DATA") for w in _BOOSTER_WINDOWS]
    fixed = [f"0 as {c}" for c in booster.ZERO_PLACEHOLDERS] + [f"'' as {c}" for c in booster.BLANK_PLACEHOLDERS]
    dates = [c for c in booster.BOOSTER_COLUMNS if c.endswith(("_EXPIRATION_DATE", "_INLIFE"))]
    fixed += [f"date '1900-01-01' as {c}" for c in dates]
    listed = ",\n  ".join(["IN_ACCOUNT_NUMBER", *known, *(profile(n) for n in ("NATL", "INTL", "DATA")), *fixed])
    return f"{_booster_sql()}\nselect {listed} from counts"


_BALANCES = """
balances as (
  select * from nobill_snapshot_daily_balance
  where snapshotdate >= date '1998-04-16' and balance > 0
    and countername in ('AC.AnnualPlanFunds_Counter', 'AC.AnnualPlanPromotions_Ctr')
  qualify row_number() over (partition by account_num, countername
    order by snapshotdate desc, counter_id desc, balance desc) = 1),
counters as (
  select * from nobill_fact_account_counter
  where facc_counter_type_id in (220, 271) and facc_date >= date '1998-04-16' and facc_date < date '1998-07-15'
  qualify row_number() over (partition by facc_counterid order by facc_time_stamp desc nulls last,
    facc_updatetype, facc_postvalue, facc_account_number nulls last) = 1),
running as (
  select cast(coalesce(c.facc_account_number, b.account_num) as varchar) as NobillAccountNo,
    cast(sum(cast(c.facc_postvalue as decimal(18, 2))) as double) as Annual_Counter_Balance
  from counters as c left join balances as b on b.counter_id = c.facc_counterid
  where c.facc_account_number > 1 or b.account_num > 1 group by 1 having sum(c.facc_postvalue) > 0)"""

_PRICES = """
prices as (
  select cast(ProductCode as int) as ProductCode, PackagePriceServices,
    cast(cast(TotalCost as decimal(18, 2)) - cast(DiscountValue as decimal(18, 2)) as double) as TotalCost
  from po_get_package_price
  qualify row_number() over (partition by ProductCode, PackagePriceServices
    order by LastModifiedDate desc, TotalCost desc, DiscountValue desc) = 1)"""

_ALL_SERVICES = f"""{_EVENT_ROWS},
plan_services as (
  select cast(b.ServiceId as varchar) as PO_EXCEL_SERVICE_ID, b.EventId as EVENT_IN_EVENT_ID,
    upper(e.dev_category_6) as EVENT_NAME, upper(e.dev_category_3) as EVENT_CATEGORY
  from po_po_bundle as b left join event_rows as e on e.dev_eventid_base = b.EventId)"""

_SERVICES = f"""{_EVENT_ROWS},
first_services as (
  select cast(b.ServiceId as varchar) as PO_EXCEL_SERVICE_ID, b.EventId as EVENT_IN_EVENT_ID,
    upper(e.dev_category_6) as EVENT_NAME, upper(e.dev_category_3) as EVENT_CATEGORY
  from (select ServiceId, min(EventId) as EventId from po_po_bundle group by ServiceId) as b
  left join event_rows as e on e.dev_eventid_base = b.EventId)"""

_PRODUCTS = r"""
named as (
  select cast(src_product_code as int) as ProductCode,
    case when src_product_code in (168, 193) then 'Monthly_Staff' else coalesce(max(business_product_name), 'Null') end
      as ProductName
  from dim_product group by src_product_code),
products as (
  select ProductCode, ProductName,
    case when ProductName = 'Product Broadband' then 'MBB'
      when contains(ProductName, 'Product Broadband - 12Months') then 'MBB-12 Months'
      when contains(ProductName, 'Tourist') then 'Tourist'
      when contains(ProductName, '6Months') then '6 Months'
      when contains(ProductName, '12Month') or contains(ProductName, '24Month') then '12 Months'
      when regexp_matches(ProductName, 'Product.Staff') or contains(ProductName, 'Product B v') then 'Monthly'
      when contains(ProductName, 'Staff') then 'Staff' else ProductName end as ProductGroup,
    case when regexp_matches(ProductName, '12.*Months') or contains(ProductName, '6 Months') then 'Annual'
      else 'Monthly' end as ProductCategory
  from named)"""

_NUMBERED = """
numbered as (select * from po_sre_customer where regexp_matches(NobillAccountNo, '^[0-9.-]+$'))"""

_PREFERRED = f"""{_NUMBERED},
preferred as (
  select NobillAccountNo, Id, cast(coalesce(RenewalDay, 0) as int) as Renewal_cycle from numbered
  qualify row_number() over (partition by NobillAccountNo
    order by coalesce(RenewalDay, 0) desc, LastUpdateDate desc, SubscribeDate desc, Id desc) = 1)"""

_SPLIT = """
paid as (
  select ActionHistoryId, cast(sum(amount) as double) as PaidAmount,
    cast(sum(case PaymentMethodId when 13 then amount else 0 end) as double) as Cashback_PaidAmount,
    cast(sum(case PaymentMethodId when 15 then amount else 0 end) as double) as Loyalty_PaidAmount,
    cast(sum(case PaymentMethodId when 16 then amount else 0 end) as double) as Promotion_PaidAmount
  from (select *, cast(PaidAmount as decimal(18, 2)) as amount from po_sre_paymenthistory)
  where IsSuccess and ActionHistoryId is not null
    and DateTime >= timestamp '1997-06-15' and DateTime < timestamp '1998-07-15'
  group by ActionHistoryId)"""


def _slot(kind: str, source: str, default: str) -> str:
    picks = " ".join(f"when contains(v{n}.EVENT_CATEGORY, '{kind}') then {source.format(n=n)}" for n in (1, 2, 3))
    return f"case {picks} else '{default}' end"


_HISTORY = f"""{_SERVICES},{_NUMBERED},
day_actions as (
  select h.*, c.NobillAccountNo, h.DateTime::date as on_day
  from po_sre_actionhistory as h join numbered as c on c.Id = h.CustomerId
  where h.ActionId in (1, 3, 4, 13, 14) and h.StatusId = 2
    and h.DateTime >= timestamp '1997-06-15' and h.DateTime < timestamp '1998-07-15'
  qualify row_number() over (partition by c.NobillAccountNo, h.DateTime::date order by h.Id desc) = 1),
slots as (
  select a.*, row_number() over (partition by a.NobillAccountNo order by a.Id desc) as Plan_Rank,
    {_slot('NATL', 'v{n}.EVENT_NAME', 'NO_NATL')} as NATL_SERVICE,
    {_slot('DATA', 'v{n}.EVENT_NAME', 'NO_DATA')} as DATA_SERVICE,
    {_slot('INTL', 'v{n}.EVENT_NAME', 'NO_INTL')} as INTL_SERVICE,
    {_slot('NATL', 'v{n}.PO_EXCEL_SERVICE_ID', '0')} as natl_id,
    {_slot('DATA', 'v{n}.PO_EXCEL_SERVICE_ID', '0')} as data_id,
    {_slot('INTL', 'v{n}.PO_EXCEL_SERVICE_ID', '17')} as intl_id
  from day_actions as a
  left join first_services as v1 on v1.PO_EXCEL_SERVICE_ID = split_part(a.ServiceIds, ',', 1)
  left join first_services as v2 on v2.PO_EXCEL_SERVICE_ID = split_part(a.ServiceIds, ',', 2)
  left join first_services as v3 on v3.PO_EXCEL_SERVICE_ID = split_part(a.ServiceIds, ',', 3)),
combos as (
  select *, NATL_SERVICE || '-' || INTL_SERVICE || '-' || DATA_SERVICE as PLAN_DESCRIPTION,
    case when ProductCode in (190, 194) then data_id else natl_id || ',' || data_id || ',' || intl_id end as COMBO_ID
  from slots)"""

_PLANS = f"""{_HISTORY},{_PRODUCTS},{_SPLIT},
history as (
  select s.Id, s.NobillAccountNo, s.CustomerId, s.ProductCode, s.on_day, s.Plan_Rank, s.NATL_SERVICE,
    s.DATA_SERVICE, s.INTL_SERVICE, s.PLAN_DESCRIPTION, s.COMBO_ID, coalesce(p.ProductName, 'Null') as product,
    coalesce(p.ProductCategory, 'Null') as category, coalesce(p.ProductName, 'Null') = 'PAYGProduct' as payg,
    u.StartDate::date as began, u.EndDate::date as ends, m.PaidAmount
  from combos as s left join products as p on p.ProductCode = s.ProductCode
  left join po_sre_subscription as u on u.Id = s.SubscriptionId
  left join paid as m on m.ActionHistoryId = s.Id),
current_plan as (select * from history where Plan_Rank = 1),
streaks as (
  select NobillAccountNo, cast(sum(cast(PaidAmount as decimal(18, 2))) as double) as amount from history
  where on_day >= date '1998-01-15' and ProductCode in (1, 2)
  group by NobillAccountNo having count(distinct date_trunc('month', on_day)) >= 6),
changes as (
  select a.NobillAccountNo,
    case when a.payg then 2
      when (a.NATL_SERVICE, a.DATA_SERVICE, a.INTL_SERVICE) <> (b.NATL_SERVICE, b.DATA_SERVICE, b.INTL_SERVICE)
      then 1 else 0 end as change
  from current_plan as a join history as b on b.NobillAccountNo = a.NobillAccountNo and b.Plan_Rank = 2
  where a.began = date '1998-07-14'),
last_plans as (
  select NobillAccountNo, product as LAST_PLAN_TYPE, PLAN_DESCRIPTION as LAST_PLAN_DESCRIPTION,
    ends as LAST_RENEWAL_DATE
  from history
  qualify row_number() over (partition by NobillAccountNo order by payg, Plan_Rank) = 1),
priors as (
  select NobillAccountNo,
    arg_min(product, Plan_Rank) filter (began < date '1998-06-30' and began >= date '1998-06-15')
      as PLAN_TYPE_15DAYS_PRIOR,
    arg_min(product, Plan_Rank) filter (began < date '1998-06-15' and began >= date '1998-05-16')
      as PLAN_TYPE_30DAYS_PRIOR,
    arg_min(product, Plan_Rank) filter (began < date '1998-05-16' and began >= date '1998-04-16')
      as PLAN_TYPE_60DAYS_PRIOR
  from history group by NobillAccountNo)"""

_PLAN_TABLES = (
    "po_sre_actionhistory po_sre_customer po_po_bundle nobill_dim_event dim_product po_sre_subscription "
    "po_sre_paymenthistory"
)

_RENEWALS = f"""{_PLANS},{_BALANCES},{_PRICES},
costs as (
  select c.NobillAccountNo, c.ends, coalesce(r.Annual_Counter_Balance, 0) as balance,
    case when c.payg or p.TotalCost is null then 0.0 when c.ProductCode = 4 then p.TotalCost - p.TotalCost * 0.3
      when c.category = 'Annual' then p.TotalCost - p.TotalCost * 0.5 else p.TotalCost end as cost
  from current_plan as c
  left join prices as p on p.ProductCode = c.ProductCode and p.PackagePriceServices = c.COMBO_ID
  left join running as r on r.NobillAccountNo = c.NobillAccountNo),
renewals as (
  select NobillAccountNo, cast(cost as double) as Actual_TotalCost,
    case when balance <= 0 or cost <= 0 then 0 else cast(round(balance / cost) as int) end as Remaining_Renewal_Month,
    ends
  from costs),
renewal_days as (
  select NobillAccountNo, Actual_TotalCost, Remaining_Renewal_Month,
    cast(ends + to_months(Remaining_Renewal_Month) as date) as ANNUAL_PLANS_RENEWAL_DATE
  from renewals)"""
_RENEWAL_TABLES = (
    f"{_PLAN_TABLES} nobill_fact_account_counter nobill_snapshot_daily_balance po_get_package_price"
)

_TENURE = """
first_plans as (
  select CustomerId, min(DateTime)::date as first_day from po_sre_actionhistory
  where ActionId in (1, 3, 4, 13, 14) and StatusId = 2 and SubscriptionId is not null group by CustomerId),
tenure as (
  select p.NobillAccountNo, cast(ceil((date '1998-07-15'
    - coalesce(m.FULL_ACTIVATION_DATE::date, f.first_day)) / 30) as bigint) as TENURE_MONTH
  from preferred as p left join first_plans as f on f.CustomerId = p.Id
  left join customer_master as m on m.IN_ACCOUNT_NUMBER = p.NobillAccountNo)"""

_PREFERRED_ONLY = _PREFERRED[len(_NUMBERED) + 1 :]

_sql = {
    "service_master": (_MASTER_TABLES, f"{_MASTER} select * from master"),
    "first_event_rows": (
        "nobill_dim_event",
        """
select dev_eventid_base, min(dev_event_id) as dev_event_id, arg_min(dev_category_3, dev_event_id) as dev_category_3
from nobill_dim_event group by dev_eventid_base""",
    ),
    "action_payments": (
        "po_sre_paymenthistory",
        f"{_PAID_120} select ActionHistoryId, cast(PaidAmount as double) as PaidAmount from paid_120",
    ),
    "latest_action_per_group": (
        f"{_MASTER_TABLES} po_sre_actionhistory po_sre_customer",
        f"{_NEWEST_ACTIONS} select IN_ACCOUNT_NUMBER, ServiceGroup, dev_category_3, Id, EventId from newest",
    ),
    "service_pivot": (
        f"{_MASTER_TABLES} po_sre_actionhistory po_sre_customer po_service_file po_sre_subscription "
        "po_sre_paymenthistory",
        _service_pivot_sql(),
    ),
    "booster_buckets": ("event_in_booster po_service_file", f"{_booster_sql()} select * from counts"),
    "purchase_profile": ("event_in_booster po_service_file", _profile_sql()),
    "positive_balances": (
        "nobill_snapshot_daily_balance nobill_fact_account_counter",
        f"{_BALANCES} select * from balances",
    ),
    "running_balance": (
        "nobill_snapshot_daily_balance nobill_fact_account_counter",
        f"{_BALANCES} select * from running",
    ),
    "package_prices": (
        "po_get_package_price",
        f"""{_PRICES}
select *, TotalCost - TotalCost * cast(0.3 as double) as TotalCost30P,
  TotalCost - TotalCost * cast(0.5 as double) as TotalCost50P from prices""",
    ),
    "plan_services": ("po_po_bundle nobill_dim_event", f"{_ALL_SERVICES} select * from plan_services"),
    "product_group": ("dim_product", f"{_PRODUCTS} select * from products"),
    "preferred_customers": ("po_sre_customer", f"{_PREFERRED} select * from preferred"),
    "payment_split": ("po_sre_paymenthistory", f"{_SPLIT} select * from paid"),
    "plan_slots": (
        "po_sre_actionhistory po_sre_customer po_po_bundle nobill_dim_event",
        f"""{_HISTORY}
select Id, NobillAccountNo, cast(Plan_Rank as int) as Plan_Rank, NATL_SERVICE, DATA_SERVICE, INTL_SERVICE,
  PLAN_DESCRIPTION, COMBO_ID from combos""",
    ),
    "six_month_streak": (
        _PLAN_TABLES,
        f"""{_PLANS}
select c.NobillAccountNo, cast(s.NobillAccountNo is not null as int) as CONSECUTIVE_6MONTHS_ON_MONTHLY,
  s.amount as CONSECUTIVE_6MONTHS_ON_MONTHLY_AMOUNT_PAID
from current_plan as c left join streaks as s using (NobillAccountNo)""",
    ),
    "plan_change": (
        _PLAN_TABLES,
        f"""{_PLANS}
select c.NobillAccountNo, coalesce(d.change, 0) as FLAG_PLAN_CHANGE,
  case when c.ends >= date '1998-07-15' then case when c.payg then 2 else 1 end else 0 end as PLAN_STATUS
from current_plan as c left join changes as d using (NobillAccountNo)""",
    ),
    "last_plan": (_PLAN_TABLES, f"{_PLANS} select * from last_plans"),
    "prior_plan_types": (_PLAN_TABLES, f"{_PLANS} select * from priors"),
    "annual_renewal": (_RENEWAL_TABLES, f"{_RENEWALS} select * from renewal_days"),
    "tenure_months": (
        "po_sre_customer po_sre_actionhistory customer_master",
        f"{_PREFERRED},{_TENURE} select * from tenure",
    ),
    "plan_report": (
        f"{_RENEWAL_TABLES} customer_master",
        f"""{_RENEWALS},{_PREFERRED_ONLY},{_TENURE}
select t.NobillAccountNo as IN_ACCOUNT_NUMBER, t.TENURE_MONTH,
  case when c.ends >= date '1998-07-15' then case when c.payg then 2 else 1 end
    when c.NobillAccountNo is not null then 0 end as PLAN_STATUS,
  l.LAST_PLAN_TYPE, l.LAST_PLAN_DESCRIPTION, l.LAST_RENEWAL_DATE, c.ends as RENEWAL_PAYMENT_DATE,
  '' as PREVIOUS_PLAN_TYPE, '' as PACKAGE_CHANGE_STATUS, '' as PAYGPLAN, '' as SCHEDULED_UPDATE_PLAN_DATE,
  r.ANNUAL_PLANS_RENEWAL_DATE,
  case when c.NobillAccountNo is not null then cast(s.NobillAccountNo is not null as int) end
    as CONSECUTIVE_6MONTHS_ON_MONTHLY,
  s.amount as CONSECUTIVE_6MONTHS_ON_MONTHLY_AMOUNT_PAID,
  q.PLAN_TYPE_15DAYS_PRIOR, q.PLAN_TYPE_30DAYS_PRIOR, q.PLAN_TYPE_60DAYS_PRIOR,
  case when c.NobillAccountNo is not null then coalesce(d.change, 0) end as FLAG_PLAN_CHANGE,
  c.NATL_SERVICE as PLAN_CHANGE_NATL, c.DATA_SERVICE as PLAN_CHANGE_DATA, c.INTL_SERVICE as PLAN_CHANGE_INTL,
  c.product as LATEST_PLAN_TYPE, c.PLAN_DESCRIPTION as LATEST_PLAN_DESCRIPTION
from tenure as t left join current_plan as c using (NobillAccountNo)
  left join last_plans as l using (NobillAccountNo) left join renewal_days as r using (NobillAccountNo)
  left join streaks as s using (NobillAccountNo) left join priors as q using (NobillAccountNo)
  left join changes as d using (NobillAccountNo)""",
    ),
    "paused_no_active": (
        "po_sre_actionhistory po_sre_action po_sre_subscription po_sre_customer",
        """
active as (
  select h.CustomerId from po_sre_actionhistory as h join po_sre_subscription as u on u.Id = h.SubscriptionId
  where h.DateTime::date between date '1998-05-16' and date '1998-07-14' and h.ActionId in (1, 3, 4, 13, 14)
    and h.StatusId = 2 and u.EndDate::date >= date '1998-07-15')
select c.NobillAccountNo as IN_ACCOUNT_NUMBER, 1 as PAUSE_FLAG
from po_sre_actionhistory as h join po_sre_action as a on a.ID = h.ActionId
  left join po_sre_customer as c on c.Id = h.CustomerId
where contains(a.Name, 'Pause') and h.DateTime::date between date '1998-06-14' and date '1998-07-14'
  and not exists (select 1 from active where active.CustomerId = h.CustomerId)
group by c.NobillAccountNo""",
    ),
    "sharing_balance": (
        "po_sre_actionhistory po_sre_shareplanhistory po_sre_customer po_sre_subscription",
        """
donated as (
  select c.NobillAccountNo as IN_ACCOUNT_NUMBER, h.DateTime::date as DATA_SHARING_DONATION_DATE,
    s.CounterValue / 1048576.0 as DS_SENDER_SEND_VALUE, u.StartDate, u.EndDate
  from po_sre_actionhistory as h join po_sre_shareplanhistory as s on s.ActionHistoryId = h.Id
  left join po_sre_customer as c on c.Id = h.CustomerId
  left join po_sre_subscription as u on u.Id = s.SubscriptionId
  where h.ActionId = 32 and h.StatusId = 2 and s.IsSuccess = 1 and h.DateTime >= timestamp '1995-06-01'
  qualify row_number() over (partition by c.NobillAccountNo
    order by u.EndDate desc nulls last, h.Id desc, s.Id desc, s.CounterValue desc) = 1)
select *, case when DATA_SHARING_DONATION_DATE >= StartDate::date then 10240 - DS_SENDER_SEND_VALUE
  else 0 end as DATA_AVAILABLE_TO_SHARE from donated""",
    ),
}

ORACLES = {k: oracle_with(ORDERS_BINDINGS, names, sql) for k, (names, sql) in _sql.items()}
