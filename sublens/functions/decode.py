"""Code tables and decision rules of the operator's systems."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sublens.functions.helpers import flag

# Fixed values of the source systems.
ID_EXPIRY_BLOCK = "CS.ID_Expiry_1W_Blocking"
BLOCKING_SERVICES = [
    "CS.TRA_Blocking",
    "CS.FRAUD_Blocking",
    "CS.Police_CatA_Blocked_Flag",
    "CS.Police_CatB_Blocked_Flag",
    "CS.ID_Expiry_1W_Blocking",
    "CS.ID_Expiry_2W_Blocking",
    "CS.HardSIM_Capping",
]
SERVICE_ADDED = "accServiceAdded"
SERVICE_REMOVED = "accServiceRemoved"
SPECIAL_SUBSCRIPTIONS = ["VM_AppleWatch", "VM_EventSims"]
PORT_OUT_KEYS = ["numDisassociated", "numDeleted"]
PORT_IN_INFO = "Replace phone number"
NOT_BLOCKED = "not blocked"
ALL_BLOCKED = "all activity blocked"
CHARGED_BLOCKED = "charged activity blocked"
ACTIVE_LINE = 3
CLOSED_LINE = 6


def blocked_label(code: Column) -> Column:
    return (
        F.when(code == 0, NOT_BLOCKED).when(code == 1, ALL_BLOCKED).when(code == 2, CHARGED_BLOCKED)
    )


def number_status(status: Column, blocked: Column) -> Column:
    """State of the number alone; NULL when no rule fits."""
    open_line = status == ACTIVE_LINE
    return (
        F.when(open_line & (blocked == CHARGED_BLOCKED), "SUSPENDED")
        .when(open_line & (blocked == ALL_BLOCKED), "DEACTIVE")
        .when(open_line & (blocked == NOT_BLOCKED), "ACTIVE")
        .when(~open_line, "DEACTIVE")
    )


def line_status(status: Column, blocked: Column, number: Column, block_service: Column) -> Column:
    """State of the line; ``block_service`` is the blocking service in force, or NULL."""
    id_expired = (block_service == ID_EXPIRY_BLOCK) & (status == ACTIVE_LINE)
    return (
        F.when((status == CLOSED_LINE) | (blocked == ALL_BLOCKED), "DEACTIVE")
        .when(id_expired | (number == "SUSPENDED"), "SUSPENDED")
        .when(block_service.isNull() & (number == "ACTIVE"), "ACTIVE")
        .otherwise("DEACTIVE")
    )


def snapshot_line_status(status: Column, blocked: Column, block_service: Column) -> Column:
    """Day-level variant of the line state, on the raw blocked code and a blocking interval."""
    return (
        F.when((status == CLOSED_LINE) | (blocked == 1), "DEACTIVE")
        .when((block_service == ID_EXPIRY_BLOCK) | ((status == ACTIVE_LINE) & (blocked == 2)), "SUSPENDED")
        .when(block_service.isNull() & (status == ACTIVE_LINE) & (blocked == 0), "ACTIVE")
        .otherwise("DEACTIVE")
    )


def port_class(history_key: Column, info: Column) -> Column:
    return (
        F.when(history_key.isin(PORT_OUT_KEYS), "PORT-OUT")
        .when(info == PORT_IN_INFO, "PORT-IN")
        .otherwise("Others")
    )


def resident_class(id_type: Column) -> Column:
    return (
        F.when(id_type == "Emirates id", "Resident")
        .when(id_type.isin("Passport", "GCC id"), "Tourist")
        .otherwise("NA")
    )


def payment_channel_fold(channel: Column) -> Column:
    """Everything but the three delivery channels becomes 'Others'; NULL stays NULL."""
    return F.when(~channel.isin("POS", "POD", "COD"), "Others").otherwise(channel)


def payment_status(name: Column) -> Column:
    return (
        F.when(name == "PaymentRefunded", "Refund")
        .when(name == "PaymentConfirmed", "Success")
        .otherwise("Failed")
    )


# Gateway names that get a report name of their own.
CHANNEL_NAMES = {
    "Spotii": "SPOTII",
    "ApplePayCyberSource": "APPLE_PAY",
    "COD": "COD",
    "POD": "POD",
    "CreditCardCyberSource": "CYBER_SOURCE",
    "POS": "POS",
}


def payment_channel(name: Column) -> Column:
    report_name = F.create_map(*[F.lit(x) for pair in CHANNEL_NAMES.items() for x in pair])
    return F.coalesce(F.try_element_at(report_name, name), name)


def service_group(category_1: Column, category_3: Column) -> Column:
    return (
        F.when(category_1 == "VAS", "VAS")
        .when(category_3.ilike("%Booster%"), "Booster")
        .when(category_3.ilike("%Roaming%"), "Roaming")
        .otherwise("Others")
    )


def purchase_profile(in_life: Column, last_30: Column, days_31_60: Column, before_30: Column) -> Column:
    """How an account buys boosters; the window counts are NULL when it bought none lately."""
    return (
        F.when(in_life == 0, "Never")
        .when((last_30 >= 1) & (days_31_60 >= 1), "Frequent")
        .when((last_30 >= 1) & (before_30 <= 0), "1st Time")
        .when((F.coalesce(last_30, F.lit(0)) == 0) & (before_30 == 1), "One Time")
        .otherwise("Occasional")
    )


def usage_tier(gigabytes: Column) -> Column:
    """Data usage class, named after its upper edge in GB; no usage value counts as '>50'."""
    tier = F.when(gigabytes <= 5, "5")
    for edge in (10, 15, 25, 50):
        tier = tier.when(gigabytes <= edge, str(edge))
    return tier.otherwise(">50")


def spend_flag(spend_change: Column, price_change: Column) -> Column:
    """2 when either change is missing, 1 when spend moves at least as much as price, else 0."""
    missing = spend_change.isNull() | price_change.isNull()
    return F.when(missing, 2).otherwise(flag(spend_change >= price_change))


# Product names by pattern, tested in this order.
PRODUCT_GROUP_LADDER = [
    ("Product Broadband", "MBB"),
    ("%Product Broadband - 12Months%", "MBB-12 Months"),
    ("%Tourist%", "Tourist"),
    ("%6Months%", "6 Months"),
    ("%12Month%", "12 Months"),
    ("%24Month%", "12 Months"),
    ("%Product_Staff%", "Monthly"),
    ("%Product B v%", "Monthly"),
    ("%Staff%", "Staff"),
]
ANNUAL_PATTERNS = ["%12%Months%", "%6 Months%"]
STAFF_PRODUCT_CODES = [168, 193]


def product_name(code: Column, name: Column) -> Column:
    return F.when(code.isin(STAFF_PRODUCT_CODES), "Monthly_Staff").otherwise(
        F.coalesce(name, F.lit("Null"))
    )


def product_group(name: Column) -> Column:
    """First pattern of the ladder that fits; '_' in a pattern stands for any one character."""
    ladder = F
    for pattern, group in PRODUCT_GROUP_LADDER:
        ladder = ladder.when(name.like(pattern), group)
    return ladder.otherwise(name)


def product_category(name: Column) -> Column:
    annual = F.lit(False)
    for pattern in ANNUAL_PATTERNS:
        annual = annual | name.like(pattern)
    return F.when(annual, "Annual").otherwise("Monthly")
