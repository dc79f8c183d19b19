"""Latest model scores and recommendations, one row per account."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sublens.functions.decode import spend_flag
from sublens.functions.helpers import ratio, truncate
from sublens.load_date import LoadDate
from sublens.operators.latest import first_per_key, latest_refresh

# Models with a score and a decile, as (date column, score column).
SCORE_MODELS = {
    "churn_monthly_payg_results": ("snapshot_date", "churn_probability"),
    "happiness_index_results": ("snapshot_date", "chi_score"),
    "home_internet_affinity_results": ("snapshot_date", "MBB_affinity_probability"),
    "renewal_results": ("snapshot_date", "non_renewal_probability"),
}
# Models with attributes, as (date column, attribute columns).
ATTRIBUTE_MODELS = {
    "migration_propensity_results": ("date_cvm", {"AD_ATTRIBUTE_31": "propensity_to_buy"}),
    "payg_recommendation_results": (
        "snapshot_date",
        {"AD_ATTRIBUTE_11": "class", "AD_ATTRIBUTE_31": "proba"},
    ),
}


def latest_rows(tables, table: str, date_column: str, load_date) -> DataFrame:
    """Newest refresh before L, one row per account.

    The source does not say which of several rows to take; here it is the greatest by all other
    columns, so that a rerun gives the same answer.
    """
    day = LoadDate.of(load_date)
    rows = latest_refresh(tables[table], date_column, day.day)
    others = [c for c in rows.columns if c not in ("in_account_number", date_column)]
    return first_per_key(rows, ["in_account_number"], [F.desc_nulls_last(f"`{c}`") for c in others])


def _head(model: str, date_column: str) -> list:
    return [
        F.col("in_account_number").alias("IN_ACCOUNT_NUMBER"),
        F.lit(model).alias("MODEL_NAME"),
        F.col(date_column).alias("LAST_MODEL_REFRESH_DATE"),
    ]


def model_score(tables, load_date, model: str) -> DataFrame:
    date_column, score = SCORE_MODELS[model]
    return latest_rows(tables, model, date_column, load_date).select(
        *_head(model, date_column), F.col(score).alias("SCORE"), F.col("decile").alias("DECILE")
    )


def model_attributes(tables, load_date, model: str) -> DataFrame:
    date_column, attributes = ATTRIBUTE_MODELS[model]
    return latest_rows(tables, model, date_column, load_date).select(
        *_head(model, date_column), *[F.col(source).alias(name) for name, source in attributes.items()]
    )


def product_recommendation(tables, load_date) -> DataFrame:
    # Attribute numbers.
    attributes = {
        "AD_ATTRIBUTE_31": truncate(F.col("predicted_data"), 2),
        "AD_ATTRIBUTE_32": F.col("predicted_natl"),
        "AD_ATTRIBUTE_33": F.col("predicted_intl"),
        "AD_ATTRIBUTE_34": F.col("data_booster_recommended_price"),
        "AD_ATTRIBUTE_35": F.col("natl_booster_recommended_price"),
        "AD_ATTRIBUTE_36": F.col("intl_booster_recommended_price"),
        "AD_ATTRIBUTE_11": F.col("data_booster_recommended"),
        "AD_ATTRIBUTE_12": F.col("natl_booster_recommended"),
        "AD_ATTRIBUTE_13": F.col("intl_booster_recommended"),
    }
    rows = latest_rows(tables, "cr_product_recommendation_results", "date_dt", load_date)
    return rows.select(
        *_head("product_recommendation_results", "date_dt"),
        *[column.alias(name) for name, column in attributes.items()],
    )


def _change_label(which, price_change, spend_change, word: str):
    """Whole amount of the change that decided the flag, with a word; NULL without a decision."""
    amount = F.when(which == 1, price_change).when(which == 0, spend_change)
    return F.concat(truncate(F.abs(amount)).cast("string"), F.lit(f" {word}"))


def right_size_plan(tables, load_date) -> DataFrame:
    """A cheaper plan: what it saves against the plan price or against the money really spent."""
    rows = latest_rows(tables, "cr_optimum_plan_recommendation_results", "date_dt", load_date)
    spent = F.col("60day_avg_money_spent")
    price_change = F.col("right_size_plan_price_change")
    spend_change = F.col("right_size_plan_net_cost") - spent
    which = spend_flag(spend_change, price_change)
    return rows.select(
        *_head("optimum_plan_recommendation_results", "date_dt"),
        F.col("right_size_plan_name").alias("AD_ATTRIBUTE_11"),
        _change_label(which, price_change, spend_change, "Less").alias("AD_ATTRIBUTE_12"),
        F.col("current_plan_net_cost").alias("AD_ATTRIBUTE_31"),
        F.col("right_size_plan_net_cost").alias("AD_ATTRIBUTE_32"),
        spent.alias("AD_ATTRIBUTE_33"),
        price_change.alias("AD_ATTRIBUTE_34"),
        spend_change.alias("AD_ATTRIBUTE_35"),
        which.alias("AD_ATTRIBUTE_36"),
    )


def step_up_plan(tables, load_date) -> DataFrame:
    """A bigger plan: what it adds, and its share of the plan price and of the money spent."""
    rows = latest_rows(tables, "cr_upselling_plan_recommendation_results", "date_dt", load_date)
    spent, current = F.col("60day_avg_money_spent"), F.col("current_plan_net_cost")
    price_change = truncate(F.col("step_up_plan_price_change"), 2)
    spend_change = truncate(F.col("step_up_spent_change"), 2)
    which = spend_flag(spend_change, price_change)
    return rows.select(
        *_head("upselling_plan_recommendation_results", "date_dt"),
        F.col("step_up_plan_name").alias("AD_ATTRIBUTE_11"),
        _change_label(which, price_change, spend_change, "More").alias("AD_ATTRIBUTE_12"),
        current.alias("AD_ATTRIBUTE_31"),
        F.col("step_up_plan_data_change").alias("AD_ATTRIBUTE_32"),
        F.col("step_up_plan_intl_min_change").alias("AD_ATTRIBUTE_33"),
        F.col("step_up_plan_price").alias("AD_ATTRIBUTE_34"),
        price_change.alias("AD_ATTRIBUTE_35"),
        spent.alias("AD_ATTRIBUTE_36"),
        F.col("step_up_plan_national_min_change").alias("AD_ATTRIBUTE_37"),
        truncate(ratio(F.col("step_up_plan_price_change"), current), 2).alias("AD_ATTRIBUTE_38"),
        spend_change.alias("AD_ATTRIBUTE_39"),
        truncate(ratio(spend_change, spent), 2).alias("AD_ATTRIBUTE_40"),
        which.alias("AD_ATTRIBUTE_41"),
    )
