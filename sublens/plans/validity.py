"""Until when a registration is valid, by identity document."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sublens.functions.helpers import flag
from sublens.operators.joins import with_existence
from sublens.operators.latest import collapse, first_per_key, newest_first

# Fixed values of the identity system.
ID_TYPES = {"emiratesid": "Emirates ID", "passport": "Passport", "gccid": "GCC National ID"}
REQUEST_ID_TYPES = {1: "Emirates ID", 2: "Passport", 3: "GCC National ID"}
REQUEST_PROCESSES = [1, 2, 4, 5, 21, 22, 40, 41, 48, 51]
BACKLOG_REASON = "TDRABacklogClearance"
VISA_PAGE = "entrystamppageofthepassport"
HOME_COUNTRY = "United Arab Emirates"
NATIONALITY_FIXES = {"D": "Germany", "RKS": "Kosovo"}


@dataclass(frozen=True)
class ValidityRules:
    gcc_since: date = date(2020, 3, 17)
    extension_reason_since: date = date(2022, 1, 1)
    gcc_days: int = 90
    visa_days: int = 90
    passport_days: int = 30


def _decoded(col: Column, names: dict, otherwise) -> Column:
    chain = F
    for code, name in names.items():
        chain = chain.when(col == code, name)
    return chain.otherwise(otherwise)


def newest_activated_record(tables, load_date) -> DataFrame:
    """Per account, the customer record behind its newest activation.

    Records are cut to the newest per contact before the join, so an account with many
    activations and many records is never multiplied out.
    """
    records = first_per_key(
        tables.history("customerdb_customers", load_date).where(F.col("NobillContactId").isNotNull()),
        ["NobillContactId"],
        newest_first("Id"),
    )
    activations = tables.history("cas_tx_activations", load_date).select(
        F.col("NobillAccountNo").alias("IN_ACCOUNT_NUMBER"),
        F.col("NobillCustomerID").alias("NobillContactId"),
        "ActivationDate",
    )
    newest = first_per_key(
        activations.join(records.select("NobillContactId"), "NobillContactId", "left_semi"),
        ["IN_ACCOUNT_NUMBER"],
        newest_first("ActivationDate", "NobillContactId"),
    )
    return newest.join(records, "NobillContactId")


def newest_verified_record(tables, load_date) -> DataFrame:
    """Of the records with a verification status, the newest per contact."""
    verified = newest_activated_record(tables, load_date).where(F.col("VerificationStatus").isNotNull())
    return first_per_key(verified, ["Contactid"], newest_first("Id", "IN_ACCOUNT_NUMBER"))


def visa_page_holders(tables) -> DataFrame:
    pages = tables["customer_db_documents"].where(
        (F.col("StatusCode") == 1) & (F.col("DocType") == VISA_PAGE)
    )
    return pages.select(F.col("CustomerId").alias("Id")).distinct()


def nationality_code(col: Column) -> Column:
    return _decoded(col, NATIONALITY_FIXES, F.coalesce(col, F.lit("Null")))


def extended_expiry(reporting: Column, id_type: Column, rules: ValidityRules) -> Column:
    """The extension date in force; a clearance of the backlog wipes date and reason first."""
    cleared = F.coalesce(F.col("ExtensionReason") == BACKLOG_REASON, F.lit(False))
    original = F.when(~cleared, F.to_date("ExtendedExpiryDate"))
    no_reason = cleared | F.col("ExtensionReason").isNull()
    dropped = (id_type != "Diplomat ID") & (reporting >= F.lit(rules.extension_reason_since)) & no_reason
    return F.when(~F.coalesce(dropped, F.lit(False)), original)


def capped(reporting: Column, days: int, final: Column) -> Column:
    """``reporting + days`` but not past the document; a missing reporting date stays missing."""
    extended = F.date_add(reporting, days)
    return F.when(extended > final, final).otherwise(extended)


def registration_validity(tables, load_date, rules: ValidityRules = ValidityRules()) -> DataFrame:
    records = with_existence(
        newest_verified_record(tables, load_date), visa_page_holders(tables), "Id", "visa_page", 1, 0
    )
    diplomat = F.coalesce((F.col("IsDiplomat") == 1) & F.col("DiplomaticId").isNotNull(), F.lit(False))
    typed = records.withColumns(
        {
            "diplomat": diplomat,
            "id_type": F.when(diplomat, "Diplomat ID").otherwise(
                _decoded(F.col("IdType"), ID_TYPES, "Null")
            ),
            "reporting": F.to_date(F.coalesce("VerificationDate", "CreatedOn")),
            "expiry": F.to_date("ExpiryDate"),
            "alpha_3": nationality_code(F.col("Nationality")),
        }
    )
    countries = collapse(tables["wsc_countries_lookup"], "alpha_3", country="name")
    dated = (
        typed.join(countries, "alpha_3", "left")
        .withColumn("extended", extended_expiry(F.col("reporting"), F.col("id_type"), rules))
        .withColumn(
            "final",
            F.when(F.col("diplomat"), F.coalesce("extended", "expiry")).otherwise(F.col("expiry")),
        )
    )
    reporting, final, id_type = F.col("reporting"), F.col("final"), F.col("id_type")
    at_home = F.col("diplomat") | (F.col("country") == HOME_COUNTRY) | (id_type == "Emirates ID")
    gcc = F.when(
        reporting > F.lit(rules.gcc_since), capped(reporting, rules.gcc_days, final)
    ).otherwise(final)
    passport = F.when(
        F.col("visa_page") == 1, capped(reporting, rules.visa_days, final)
    ).otherwise(capped(reporting, rules.passport_days, final))
    by_document = (
        F.when(at_home, final).when(id_type == "GCC National ID", gcc).when(id_type == "Passport", passport)
    )
    known = at_home | id_type.isin("GCC National ID", "Passport")
    return dated.select(
        "IN_ACCOUNT_NUMBER",
        F.when(known, F.coalesce(F.col("extended"), by_document)).alias("REGISTRATION_VALIDITY_DATE"),
    )


def verification_requests(tables, load_date) -> DataFrame:
    """Verification requests of the onboarding processes with process, status and id type names."""
    requests = tables.history("cas_id_verification_request", load_date).where(F.col("ProcessID").isin(REQUEST_PROCESSES))
    processes = tables["cas_process"].select(F.col("ID").alias("ProcessID"), F.col("NAME").alias("ProcessNAME"))
    states = tables["cas_id_verification_status"].select(
        F.col("ID").alias("VerificationStatusID"), F.col("Name").alias("STATUSNAME")
    )
    return (
        requests.join(processes, "ProcessID", "left")
        .join(states, "VerificationStatusID", "left")
        .select(
            F.col("ID").alias("IDVERIFICATION_ID"),
            F.col("CreationDate").alias("IDVERIFICATION_DATE"),
            F.col("CustomerID").alias("IDVERIFICATION_CUSTOMERID"),
            F.col("IDExpiryDate").alias("IDVERIFICATION_IDEXPIRYDATE"),
            F.col("IDIssueDate").alias("IDVERIFICATION_ISSUEDDATE"),
            F.col("IDNumber").alias("IDVERIFICATION_IDNUMBER"),
            F.col("NationalityCode").alias("IDVERIFICATION_NATIONALITYCODE"),
            F.col("IDTypeId").alias("IDVERIFICATION_IDTYPEID"),
            _decoded(F.col("IDTypeId"), REQUEST_ID_TYPES, "Null").alias("IDVERIFICATION_IDTYPE_NAME"),
            "ProcessNAME",
            "STATUSNAME",
        )
    )
