"""Plan state of an account: current and last plan, renewal, changes, history and tenure."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sublens.functions import decode
from sublens.functions.helpers import flag
from sublens.load_date import LoadDate, within
from sublens.operators.latest import collapse, first_per_key, newest_first
from sublens.plans.services import first_event_rows

# Fixed values of the plan platform.
PLAN_ACTIONS = [1, 3, 4, 13, 14]
DONE = 2
PAYG_PRODUCT = "PAYGProduct"
MONTHLY_PRODUCTS = [1, 2]
DATA_ONLY_PRODUCTS = [190, 194]
DISCOUNT_PRODUCT = 4
ANNUAL_COUNTERS = ["AC.AnnualPlanFunds_Counter", "AC.AnnualPlanPromotions_Ctr"]
ANNUAL_COUNTER_TYPES = [220, 271]
PAYMENT_METHODS = {"Cashback": 13, "Loyalty": 15, "Promotion": 16}
SLOT_DEFAULT_IDS = {"NATL": "0", "DATA": "0", "INTL": "17"}
HISTORY_MONTHS = 13
STREAK_MONTHS = 6
BALANCE_DAYS = 90
NUMERIC_ACCOUNT = "^[0-9.-]+$"


def latest_positive_balances(tables, load_date) -> DataFrame:
    """Newest positive balance per (account, annual counter)."""
    day = LoadDate.of(load_date)
    balances = tables.history("nobill_snapshot_daily_balance", day).where(
        (F.col("snapshotdate") >= F.lit(day.back(BALANCE_DAYS)))
        & F.col("countername").isin(ANNUAL_COUNTERS)
        & (F.col("balance") > 0)
    )
    return first_per_key(
        balances, ["account_num", "countername"], newest_first("snapshotdate", "counter_id", "balance")
    )


def running_balance(tables, load_date) -> DataFrame:
    """Positive annual balance per account: newest value of each counter, summed.

    A counter row without an account takes the account of the balance snapshot.
    """
    day = LoadDate.of(load_date)
    counters = tables["nobill_fact_account_counter"].where(
        F.col("facc_counter_type_id").isin(ANNUAL_COUNTER_TYPES)
        & within(F.col("facc_date"), day.back(BALANCE_DAYS), day.day)
    )
    newest = first_per_key(
        counters,
        ["facc_counterid"],
        [
            F.desc_nulls_last("facc_time_stamp"),
            F.asc_nulls_last("facc_updatetype"),
            F.asc_nulls_last("facc_postvalue"),
            F.asc_nulls_last("facc_account_number"),
        ],
    )
    owners = latest_positive_balances(tables, day).select(
        F.col("counter_id").alias("facc_counterid"), "account_num"
    )
    known = (F.col("facc_account_number") > 1) | (F.col("account_num") > 1)
    account = F.coalesce("facc_account_number", "account_num").cast("string")
    return (
        newest.join(owners, "facc_counterid", "left")
        .where(known)
        .groupBy(account.alias("NobillAccountNo"))
        .agg(F.sum("facc_postvalue").cast("double").alias("Annual_Counter_Balance"))
        .where(F.col("Annual_Counter_Balance") > 0)
    )


def package_prices(tables) -> DataFrame:
    """Newest price per product and service combination, with the discounted variants."""
    newest = first_per_key(
        tables["po_get_package_price"],
        ["ProductCode", "PackagePriceServices"],
        newest_first("LastModifiedDate", "TotalCost", "DiscountValue"),
    )
    cost = (F.col("TotalCost") - F.col("DiscountValue")).cast("double")
    return newest.select("ProductCode", "PackagePriceServices", cost.alias("TotalCost")).withColumns(
        {
            "TotalCost30P": F.col("TotalCost") - F.col("TotalCost") * 0.3,
            "TotalCost50P": F.col("TotalCost") - F.col("TotalCost") * 0.5,
        }
    )


def plan_services(tables) -> DataFrame:
    """Service id (as text) to event, name and category; a service has a row for each event it is bundled with."""
    return _named_events(tables["po_po_bundle"], tables)


def first_plan_services(tables) -> DataFrame:
    """``plan_services`` with only the first event of a service, for reports that have a service in one row."""
    return _named_events(first_per_key(tables["po_po_bundle"], ["ServiceId"], [F.asc_nulls_last("EventId")]), tables)


def _named_events(bundles: DataFrame, tables) -> DataFrame:
    events = first_event_rows(tables).select(
        F.col("dev_eventid_base").alias("EventId"),
        F.upper("dev_category_6").alias("EVENT_NAME"),
        F.upper("dev_category_3").alias("EVENT_CATEGORY"),
    )
    return bundles.join(events, "EventId", "left").select(
        F.col("ServiceId").cast("string").alias("PO_EXCEL_SERVICE_ID"),
        F.col("EventId").alias("EVENT_IN_EVENT_ID"),
        "EVENT_NAME",
        "EVENT_CATEGORY",
    )


def product_groups(tables) -> DataFrame:
    names = collapse(tables["dim_product"], "src_product_code", name="business_product_name")
    products = names.select(
        F.col("src_product_code").alias("ProductCode"),
        decode.product_name(F.col("src_product_code"), F.col("name")).alias("ProductName"),
    )
    return products.withColumns(
        {
            "ProductGroup": decode.product_group(F.col("ProductName")),
            "ProductCategory": decode.product_category(F.col("ProductName")),
        }
    )


def numbered_customers(tables) -> DataFrame:
    """Plan customers whose account number looks like a number."""
    return tables["po_sre_customer"].where(F.col("NobillAccountNo").rlike(NUMERIC_ACCOUNT))


def preferred_customers(tables) -> DataFrame:
    """One customer row per account: highest renewal day, then last update, then subscription."""
    renewal = F.coalesce("RenewalDay", F.lit(0))
    return first_per_key(
        numbered_customers(tables).withColumn("Renewal_cycle", renewal),
        ["NobillAccountNo"],
        newest_first("Renewal_cycle", "LastUpdateDate", "SubscribeDate", "Id"),
    )


def payment_split(tables, load_date) -> DataFrame:
    """Paid amount per action, in total and by reward method."""
    day = LoadDate.of(load_date)
    paid = tables["po_sre_paymenthistory"].where(
        F.col("IsSuccess")
        & within(F.to_date("DateTime"), day.months_back(HISTORY_MONTHS), day.day)
        & F.col("ActionHistoryId").isNotNull()
    )
    amount = F.col("PaidAmount")
    return paid.groupBy("ActionHistoryId").agg(
        F.sum(amount).alias("PaidAmount"),
        *[
            F.sum(F.when(F.col("PaymentMethodId") == code, amount).otherwise(0)).alias(f"{name}_PaidAmount")
            for name, code in PAYMENT_METHODS.items()
        ],
    )


def plan_actions(tables, load_date, months: int = HISTORY_MONTHS) -> DataFrame:
    """Last plan action per account and day, ranked newest first.

    The history is cut to one action per (customer, day) before the customer join and to one per
    (account, day) after it; both cuts keep one row per key on the map side. What the ranking
    window then sees is at most one row per calendar day of an account.
    """
    day = LoadDate.of(load_date)
    actions = tables["po_sre_actionhistory"].select(
        "Id",
        "CustomerId",
        "ServiceIds",
        "SubscriptionId",
        "ProductCode",
        F.to_date("DateTime").alias("Action_Date"),
        "ActionId",
        "StatusId",
    ).where(
        within(F.col("Action_Date"), day.months_back(months), day.day)
        & F.col("ActionId").isin(PLAN_ACTIONS)
        & (F.col("StatusId") == DONE)
    )
    per_customer = first_per_key(actions, ["CustomerId", "Action_Date"], [F.desc("Id")])
    customers = numbered_customers(tables).select(F.col("Id").alias("CustomerId"), "NobillAccountNo")
    per_account = first_per_key(
        per_customer.join(customers, "CustomerId"), ["NobillAccountNo", "Action_Date"], [F.desc("Id")]
    )
    newest = Window.partitionBy("NobillAccountNo").orderBy(F.desc("Id"))
    return per_account.withColumn("Plan_Rank", F.row_number().over(newest))


def service_slots(actions: DataFrame, tables) -> DataFrame:
    """Split the service list into three, look each up, and fill the NATL / DATA / INTL slots."""
    services = first_plan_services(tables)
    for n in (1, 2, 3):
        lookup = services.select(
            F.col("PO_EXCEL_SERVICE_ID").alias(f"service_{n}"),
            F.col("EVENT_NAME").alias(f"name_{n}"),
            F.col("EVENT_CATEGORY").alias(f"category_{n}"),
        )
        part = F.split_part("ServiceIds", F.lit(","), F.lit(n))
        actions = actions.withColumn(f"service_{n}", part).join(lookup, f"service_{n}", "left")

    def slot(kind: str, source: str, default: str) -> Column:
        chain = F
        for n in (1, 2, 3):
            chain = chain.when(F.col(f"category_{n}").contains(kind), F.col(f"{source}_{n}"))
        return chain.otherwise(default)

    filled = actions.withColumns(
        {f"{kind}_SERVICE": slot(kind, "name", f"NO_{kind}") for kind in SLOT_DEFAULT_IDS}
        | {f"{kind}_SERVICE_ID": slot(kind, "service", default) for kind, default in SLOT_DEFAULT_IDS.items()}
    )
    combo = F.concat(
        "NATL_SERVICE_ID", F.lit(","), "DATA_SERVICE_ID", F.lit(","), "INTL_SERVICE_ID"
    )
    return filled.withColumns(
        {
            "PLAN_DESCRIPTION": F.concat(
                "NATL_SERVICE", F.lit("-"), "INTL_SERVICE", F.lit("-"), "DATA_SERVICE"
            ),
            "COMBO_ID": F.when(
                F.col("ProductCode").isin(DATA_ONLY_PRODUCTS), F.col("DATA_SERVICE_ID")
            ).otherwise(combo),
        }
    ).drop(*[f"{part}_{n}" for part in ("service", "name", "category") for n in (1, 2, 3)])


def prior_bucket(start: Column, day: LoadDate) -> Column:
    """1: last 15 days, 2: 15-30, 3: 30-60, 4: 60-90 days before L, 5: older or unknown."""
    chain = F
    for code, (newer, older) in enumerate([(0, 15), (15, 30), (30, 60), (60, 90)], start=1):
        chain = chain.when(within(start, day.back(older), day.back(newer)), code)
    return chain.otherwise(5)


def plan_action_history(tables, load_date, months: int = HISTORY_MONTHS) -> DataFrame:
    """Ranked plan actions with product, subscription dates, amount paid and service slots."""
    day = LoadDate.of(load_date)
    subscriptions = tables["po_sre_subscription"].select(
        F.col("Id").alias("SubscriptionId"),
        F.to_date("StartDate").alias("Subs_StartDate"),
        F.to_date("EndDate").alias("Subs_EndDate"),
    )
    paid = payment_split(tables, day).select(F.col("ActionHistoryId").alias("Id"), "PaidAmount")
    history = (
        plan_actions(tables, day, months)
        .join(product_groups(tables), "ProductCode", "left")
        .join(subscriptions, "SubscriptionId", "left")
        .join(paid, "Id", "left")
    )
    named = history.withColumns(
        {c: F.coalesce(c, F.lit("Null")) for c in ("ProductName", "ProductGroup", "ProductCategory")}
    )
    return service_slots(named, tables).withColumns(
        {
            "FLAG_PAYG_PLAN": F.when(F.col("ProductName") == PAYG_PRODUCT, "PAYG").otherwise("PLAN"),
            "FLAG_ACTIVE_PLAN": flag(F.col("Subs_EndDate") >= F.lit(day.day)),
            "FLAG_LAST_6M": flag(within(F.col("Action_Date"), day.months_back(STREAK_MONTHS), day.day)),
            "PLAN_TYPE_RANK_PRIOR": prior_bucket(F.col("Subs_StartDate"), day),
        }
    )


def monthly_streak(day: LoadDate) -> dict[str, Column]:
    """Aggregates for "six months on a monthly plan": distinct months as bits, and amount paid."""
    monthly = (F.col("FLAG_LAST_6M") == 1) & F.col("ProductCode").isin(MONTHLY_PRODUCTS)
    base = day.months_back(STREAK_MONTHS)
    month = (F.year("Action_Date") - base.year) * 12 + F.month("Action_Date") - base.month
    return {
        "months_on_monthly": F.bit_count(
            F.bit_or(F.when(monthly, F.call_function("shiftleft", F.lit(1), month)).otherwise(0))
        ),
        "monthly_paid": F.sum(F.when(monthly, F.col("PaidAmount"))),
    }


def account_plans(tables, load_date) -> DataFrame:
    """Everything the report needs of the history, in one aggregate per account."""
    day = LoadDate.of(load_date)
    history = plan_action_history(tables, day)
    rank, payg = F.col("Plan_Rank"), F.col("FLAG_PAYG_PLAN") == "PAYG"
    current = [
        "CustomerId", "ProductCode", "ProductName", "ProductCategory", "PLAN_DESCRIPTION", "COMBO_ID",
        "NATL_SERVICE", "DATA_SERVICE", "INTL_SERVICE", "Subs_StartDate", "Subs_EndDate",
        "FLAG_PAYG_PLAN", "FLAG_ACTIVE_PLAN",
    ]
    slots = ["NATL_SERVICE", "DATA_SERVICE", "INTL_SERVICE"]
    prior = {2: "PLAN_TYPE_15DAYS_PRIOR", 3: "PLAN_TYPE_30DAYS_PRIOR", 4: "PLAN_TYPE_60DAYS_PRIOR"}
    streak = monthly_streak(day)
    last = F.struct(
        flag(payg).alias("payg"), rank, F.col("ProductName"), F.col("PLAN_DESCRIPTION"), F.col("Subs_EndDate")
    )
    plans = history.groupBy("NobillAccountNo").agg(
        F.max(F.when(rank == 1, F.struct(*current))).alias("now"),
        F.max(F.when(rank == 2, F.struct(*slots))).alias("before"),
        F.min(last).alias("last"),
        *[
            F.min_by("ProductName", F.when(F.col("PLAN_TYPE_RANK_PRIOR") == code, rank)).alias(name)
            for code, name in prior.items()
        ],
        *[column.alias(name) for name, column in streak.items()],
    )
    now, before = F.col("now"), F.col("before")
    changed = F.lit(False)
    for slot in slots:
        changed = changed | F.coalesce(now[slot] != before[slot], F.lit(False))
    started_yesterday = (now["Subs_StartDate"] == F.lit(day.previous)) & before.isNotNull()
    on_streak = F.col("months_on_monthly") >= STREAK_MONTHS
    return plans.select(
        "NobillAccountNo",
        *[now[c].alias(c) for c in current],
        F.when(now["FLAG_ACTIVE_PLAN"] == 0, 0)
        .when(now["FLAG_PAYG_PLAN"] == "PAYG", 2)
        .otherwise(1)
        .alias("PLAN_STATUS"),
        F.col("last.ProductName").alias("LAST_PLAN_TYPE"),
        F.col("last.PLAN_DESCRIPTION").alias("LAST_PLAN_DESCRIPTION"),
        F.col("last.Subs_EndDate").alias("LAST_RENEWAL_DATE"),
        *prior.values(),
        flag(on_streak).alias("CONSECUTIVE_6MONTHS_ON_MONTHLY"),
        F.when(on_streak, F.col("monthly_paid").cast("double")).alias(
            "CONSECUTIVE_6MONTHS_ON_MONTHLY_AMOUNT_PAID"
        ),
        F.when(started_yesterday & (now["FLAG_PAYG_PLAN"] == "PAYG"), 2)
        .when(started_yesterday & changed, 1)
        .otherwise(0)
        .alias("FLAG_PLAN_CHANGE"),
    )


def renewal_dates(plans: DataFrame, tables, load_date) -> DataFrame:
    """Months that the annual balance still pays for, and the renewal date after them."""
    priced = package_prices(tables).withColumnRenamed("PackagePriceServices", "COMBO_ID")
    cost = (
        F.when((F.col("FLAG_PAYG_PLAN") == "PAYG") | F.col("TotalCost").isNull(), 0.0)
        .when(F.col("ProductCode") == DISCOUNT_PRODUCT, F.col("TotalCost30P"))
        .when(F.col("ProductCategory") == "Annual", F.col("TotalCost50P"))
        .otherwise(F.col("TotalCost"))
    )
    balance = F.coalesce("Annual_Counter_Balance", F.lit(0.0))
    months = F.when(
        (balance > 0) & (F.col("Actual_TotalCost") > 0),
        F.round(balance / F.col("Actual_TotalCost")).cast("int"),
    ).otherwise(0)
    return (
        plans.join(priced, ["ProductCode", "COMBO_ID"], "left")
        .withColumn("Actual_TotalCost", cost)
        .join(running_balance(tables, load_date), "NobillAccountNo", "left")
        .withColumn("Remaining_Renewal_Month", months)
        .withColumn("ANNUAL_PLANS_RENEWAL_DATE", F.add_months("Subs_EndDate", F.col("Remaining_Renewal_Month")))
    )


def first_plan_dates(tables, load_date) -> DataFrame:
    first = tables.history("po_sre_actionhistory", load_date).where(
        F.col("ActionId").isin(PLAN_ACTIONS)
        & (F.col("StatusId") == DONE)
        & F.col("SubscriptionId").isNotNull()
    )
    return first.groupBy("CustomerId").agg(F.to_date(F.min("DateTime")).alias("FIRST_PLAN_DATE"))


def tenure_months(tables, load_date) -> DataFrame:
    """Started months of 30 days since activation, or else since the first plan."""
    day = LoadDate.of(load_date)
    activations = tables["customer_master"].select(
        F.col("IN_ACCOUNT_NUMBER").alias("NobillAccountNo"),
        F.to_date("FULL_ACTIVATION_DATE").alias("activated"),
    )
    first = first_plan_dates(tables, day).withColumnRenamed("CustomerId", "Id")
    age = F.datediff(F.lit(day.day), F.coalesce("activated", "FIRST_PLAN_DATE"))
    return (
        preferred_customers(tables)
        .select("Id", "NobillAccountNo")
        .join(first, "Id", "left")
        .join(activations, "NobillAccountNo", "left")
        .select("NobillAccountNo", F.ceil(age / 30).alias("TENURE_MONTH"))
    )


def plan_report(tables, load_date) -> DataFrame:
    """The plan features of every account with a numeric account number."""
    day = LoadDate.of(load_date)
    plans = renewal_dates(account_plans(tables, day), tables, day)
    blank = F.lit("")
    return tenure_months(tables, day).join(plans, "NobillAccountNo", "left").select(
        F.col("NobillAccountNo").alias("IN_ACCOUNT_NUMBER"),
        "PLAN_STATUS",
        "LAST_PLAN_TYPE",
        "LAST_PLAN_DESCRIPTION",
        F.col("Subs_EndDate").alias("RENEWAL_PAYMENT_DATE"),
        blank.alias("PREVIOUS_PLAN_TYPE"),
        "ANNUAL_PLANS_RENEWAL_DATE",
        blank.alias("PACKAGE_CHANGE_STATUS"),
        blank.alias("PAYGPLAN"),
        blank.alias("SCHEDULED_UPDATE_PLAN_DATE"),
        "CONSECUTIVE_6MONTHS_ON_MONTHLY",
        "CONSECUTIVE_6MONTHS_ON_MONTHLY_AMOUNT_PAID",
        "LAST_RENEWAL_DATE",
        "PLAN_TYPE_15DAYS_PRIOR",
        "PLAN_TYPE_30DAYS_PRIOR",
        "PLAN_TYPE_60DAYS_PRIOR",
        "FLAG_PLAN_CHANGE",
        F.col("NATL_SERVICE").alias("PLAN_CHANGE_NATL"),
        F.col("DATA_SERVICE").alias("PLAN_CHANGE_DATA"),
        F.col("INTL_SERVICE").alias("PLAN_CHANGE_INTL"),
        F.col("ProductName").alias("LATEST_PLAN_TYPE"),
        F.col("PLAN_DESCRIPTION").alias("LATEST_PLAN_DESCRIPTION"),
        "TENURE_MONTH",
    )


def plan_paused(tables, load_date) -> DataFrame:
    """Accounts of customers that paused within the last month and have no plan running."""
    day = LoadDate.of(load_date)
    history = tables["po_sre_actionhistory"].withColumn("on", F.to_date("DateTime"))
    pause_actions = tables["po_sre_action"].where(F.col("Name").like("%Pause%"))
    pauses = (
        history.where(within(F.col("on"), day.months_back(1, day.previous), day.day))
        .join(pause_actions.select(F.col("ID").alias("ActionId")), "ActionId", "left_semi")
        .select("CustomerId")
        .distinct()
    )
    running = tables["po_sre_subscription"].where(F.to_date("EndDate") >= F.lit(day.day))
    active = (
        history.where(
            within(F.col("on"), day.back(60), day.day)
            & F.col("ActionId").isin(PLAN_ACTIONS)
            & (F.col("StatusId") == DONE)
        )
        .join(running.select(F.col("Id").alias("SubscriptionId")), "SubscriptionId", "left_semi")
        .select("CustomerId")
    )
    customers = tables["po_sre_customer"].select(
        F.col("Id").alias("CustomerId"), F.col("NobillAccountNo").alias("IN_ACCOUNT_NUMBER")
    )
    return (
        pauses.join(active, "CustomerId", "left_anti")
        .join(customers, "CustomerId", "left")
        .select("IN_ACCOUNT_NUMBER")
        .distinct()
        .withColumn("PAUSE_FLAG", F.lit(1))
    )
