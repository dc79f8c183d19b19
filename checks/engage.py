"""Roaming, loyalty and model scores: queries and oracles."""

from __future__ import annotations

from checks.binding import EVENTS_BINDINGS, EVENTS_L, events_tables, oracle_with
from sublens.plans import engagement, scores

# Small blocks, so that the stitching between blocks takes part in the check.
ID_BLOCK = 500


def _events(build):
    return lambda spark, sf_dir: build(events_tables(spark, sf_dir))


QUERIES = {
    "roaming_trips": _events(lambda t: engagement.roaming_trips(t, EVENTS_L, ID_BLOCK)),
    "country_changes": _events(lambda t: engagement.country_changes(t, EVENTS_L, ID_BLOCK)),
    "loyalty_points": _events(lambda t: engagement.loyalty_points(t, EVENTS_L)),
    "loyalty_tier": _events(lambda t: engagement.loyalty_tier(t, EVENTS_L)),
    **{
        name: _events(lambda t, m=model: scores.model_score(t, EVENTS_L, m))
        for name, model in {
            "score_latest": "churn_monthly_payg_results",
            "score_happiness": "happiness_index_results",
            "score_home_internet": "home_internet_affinity_results",
            "score_renewal": "renewal_results",
        }.items()
    },
    "score_attributes": _events(
        lambda t: scores.model_attributes(t, EVENTS_L, "payg_recommendation_results")
    ),
    "score_migration": _events(
        lambda t: scores.model_attributes(t, EVENTS_L, "migration_propensity_results")
    ),
    "product_reco": _events(lambda t: scores.product_recommendation(t, EVENTS_L)),
    "rightsize_plan": _events(lambda t: scores.right_size_plan(t, EVENTS_L)),
    "stepup_plan": _events(lambda t: scores.step_up_plan(t, EVENTS_L)),
}

_MESSAGES = """
messages as (
  select m.ID, m.MSISDN, m.DATETIME::date as seen_on,
    case when m.MCC = '424' then 'Uae' else coalesce(c.country, 'Others') end as country
  from roaming_ussd_received_data as m
  left join (select MCC, max(country) as country from dim_roam_country_operator group by 1) as c using (MCC)
  where regexp_matches(m.MCC, '[0-9]') and m.MCC not in ('000', '901')
    and m.DATETIME::date >= date '2023-07-24' and m.DATETIME::date < date '2024-01-25'),
moves as (
  select *, lag(country) over (partition by MSISDN order by ID) as previous_country from messages
  qualify lag(country) over (partition by MSISDN order by ID) is distinct from country)"""


def _latest(table: str, date_column: str, others: str) -> str:
    order = ", ".join(f"{c} desc nulls last" for c in others.split())
    return f"""
newest as (
  select * from {table} where {date_column} = (select max({date_column}) from {table}
    where {date_column} < date '2024-01-25')
  qualify row_number() over (partition by in_account_number order by {order}) = 1)
select in_account_number as IN_ACCOUNT_NUMBER, {date_column} as LAST_MODEL_REFRESH_DATE, """


def _cut(sql: str) -> str:
    """Two decimals towards zero."""
    return f"cast(trunc(cast({sql} as decimal(28, 10)) * 100) as bigint) / cast(100 as double)"


def _label(word: str) -> str:
    return f"""case which when 1 then cast(cast(trunc(cast(abs(price) as decimal(28, 10))) as bigint) as varchar) || ' {word}'
    when 0 then cast(cast(trunc(cast(abs(spend) as decimal(28, 10))) as bigint) as varchar) || ' {word}' end"""


_FLAG = "case when price is null or spend is null then 2 when spend >= price then 1 else 0 end as which"
_RECO = (
    "predicted_data predicted_natl predicted_intl data_booster_recommended natl_booster_recommended "
    "intl_booster_recommended data_booster_recommended_price natl_booster_recommended_price "
    "intl_booster_recommended_price"
)
_OPTIMUM = (
    'right_size_plan_name current_plan_net_cost right_size_plan_net_cost "60day_avg_money_spent" '
    "right_size_plan_price_change"
)
_STEPUP = (
    "step_up_plan_name current_plan_net_cost step_up_plan_data_change step_up_plan_intl_min_change "
    'step_up_plan_price step_up_plan_price_change "60day_avg_money_spent" step_up_plan_national_min_change '
    "step_up_spent_change"
)


def _score(model: str, score: str) -> tuple[str, str]:
    head = _latest(model, "snapshot_date", f"{score} decile")
    return model, f"{head}'{model}' as MODEL_NAME, {score} as SCORE, decile as DECILE from newest"


def _wrapped(table: str, others: str, inner: str, outer: str) -> tuple[str, str]:
    """A latest-row query whose price and spend changes get names before the flag uses them."""
    rows = _latest(table, "date_dt", others).replace(
        "select in_account_number as IN_ACCOUNT_NUMBER, date_dt as LAST_MODEL_REFRESH_DATE, ", ""
    )
    return table, f"""{rows.rstrip()},
priced as (select *, {inner} from newest),
flagged as (select *, {_FLAG} from priced)
select in_account_number as IN_ACCOUNT_NUMBER, date_dt as LAST_MODEL_REFRESH_DATE, {outer} from flagged"""


_sql = {
    "roaming_trips": (
        "roaming_ussd_received_data dim_roam_country_operator customer_master",
        f"""{_MESSAGES},
trips as (
  select MSISDN, count(*) filter (seen_on >= date '2023-12-24') as RLH_1M,
    count(*) filter (seen_on >= date '2023-10-24') as RLH_3M, count(*) as RLH_6M,
    count(distinct country) as RLH_UNIQUE_COUNTRY_6M
  from moves where country <> 'Uae' group by 1)
select (select max(IN_ACCOUNT_NUMBER) from customer_master as c where c.MSISDN = t.MSISDN) as IN_ACCOUNT_NUMBER,
  t.*, '' as ROAMING_BL from trips as t""",
    ),
    "country_changes": (
        "roaming_ussd_received_data dim_roam_country_operator",
        f"{_MESSAGES} select * from moves",
    ),
    "loyalty_points": (
        "loy_customer_trx_log loy_dim_customer customer_master",
        """
select m.IN_ACCOUNT_NUMBER, cast(sum(cast(l.points as decimal(18, 2))) as double) as points
from loy_customer_trx_log as l left join loy_dim_customer as d on d.ID = l.customer_id
  left join customer_master as m on m.CRM_UID = d.identifier_value
where l.CREATE_DATE::date between date '2023-12-26' and date '2024-01-25' group by 1 order by 1""",
    ),
    "loyalty_tier": (
        "loy_customer_cashback loy_tier loy_dim_customer customer_master",
        """
newest as (
  select customer_id, arg_max(tier_id, (CREATE_DATE, id)) as tier_id from loy_customer_cashback
  where tier_id is not null group by 1)
select m.IN_ACCOUNT_NUMBER, t.name_en from newest as n left join loy_tier as t on t.ID = n.tier_id
  left join loy_dim_customer as d on d.ID = n.customer_id
  left join customer_master as m on m.CRM_UID = d.identifier_value""",
    ),
    "score_latest": _score("churn_monthly_payg_results", "churn_probability"),
    "score_happiness": _score("happiness_index_results", "chi_score"),
    "score_home_internet": _score("home_internet_affinity_results", "MBB_affinity_probability"),
    "score_renewal": _score("renewal_results", "non_renewal_probability"),
    "score_attributes": (
        "payg_recommendation_results",
        _latest("payg_recommendation_results", "snapshot_date", "class proba")
        + "'payg_recommendation_results' as MODEL_NAME, class as AD_ATTRIBUTE_11, proba as AD_ATTRIBUTE_31 "
        "from newest",
    ),
    "score_migration": (
        "migration_propensity_results",
        _latest("migration_propensity_results", "date_cvm", "propensity_to_buy")
        + "'migration_propensity_results' as MODEL_NAME, propensity_to_buy as AD_ATTRIBUTE_31 from newest",
    ),
    "product_reco": (
        "cr_product_recommendation_results",
        _latest("cr_product_recommendation_results", "date_dt", _RECO)
        + f"""'product_recommendation_results' as MODEL_NAME,
  {_cut('predicted_data')} as AD_ATTRIBUTE_31, predicted_natl as AD_ATTRIBUTE_32,
  predicted_intl as AD_ATTRIBUTE_33, data_booster_recommended_price as AD_ATTRIBUTE_34,
  natl_booster_recommended_price as AD_ATTRIBUTE_35, intl_booster_recommended_price as AD_ATTRIBUTE_36,
  data_booster_recommended as AD_ATTRIBUTE_11, natl_booster_recommended as AD_ATTRIBUTE_12,
  intl_booster_recommended as AD_ATTRIBUTE_13 from newest""",
    ),
    "rightsize_plan": _wrapped(
        "cr_optimum_plan_recommendation_results",
        _OPTIMUM,
        'right_size_plan_price_change as price, right_size_plan_net_cost - "60day_avg_money_spent" as spend',
        f"""'optimum_plan_recommendation_results' as MODEL_NAME, right_size_plan_name as AD_ATTRIBUTE_11,
  {_label('Less')} as AD_ATTRIBUTE_12, current_plan_net_cost as AD_ATTRIBUTE_31,
  right_size_plan_net_cost as AD_ATTRIBUTE_32, "60day_avg_money_spent" as AD_ATTRIBUTE_33,
  price as AD_ATTRIBUTE_34, spend as AD_ATTRIBUTE_35, which as AD_ATTRIBUTE_36""",
    ),
    "stepup_plan": _wrapped(
        "cr_upselling_plan_recommendation_results",
        _STEPUP,
        f"{_cut('step_up_plan_price_change')} as price, {_cut('step_up_spent_change')} as spend",
        f"""'upselling_plan_recommendation_results' as MODEL_NAME, step_up_plan_name as AD_ATTRIBUTE_11,
  {_label('More')} as AD_ATTRIBUTE_12, cast(current_plan_net_cost as double) as AD_ATTRIBUTE_31,
  step_up_plan_data_change as AD_ATTRIBUTE_32, step_up_plan_intl_min_change as AD_ATTRIBUTE_33,
  step_up_plan_price as AD_ATTRIBUTE_34, price as AD_ATTRIBUTE_35,
  cast("60day_avg_money_spent" as double) as AD_ATTRIBUTE_36,
  step_up_plan_national_min_change as AD_ATTRIBUTE_37,
  {_cut('step_up_plan_price_change / nullif(current_plan_net_cost, 0)')} as AD_ATTRIBUTE_38,
  spend as AD_ATTRIBUTE_39, {_cut('spend / nullif("60day_avg_money_spent", 0)')} as AD_ATTRIBUTE_40,
  which as AD_ATTRIBUTE_41""",
    ),
}

ORACLES = {k: oracle_with(EVENTS_BINDINGS, names, sql) for k, (names, sql) in _sql.items()}
