"""Line status, profiles, documents and disconnections: queries and oracles."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from checks.binding import (
    EVENTS_BINDINGS,
    EVENTS_L,
    ORDERS_BINDINGS,
    ORDERS_L,
    events_tables,
    oracle_with,
    orders_tables,
)
from sublens.functions import decode, helpers
from sublens.operators.joins import with_existence
from sublens.plans import customer_base as base
from sublens.plans import disconnection, profiles, validity

# The events cover 30 days, so departed accounts are looked for within 20.
DEPARTED_DAYS = 20


def _events(build):
    return lambda spark, sf_dir: build(events_tables(spark, sf_dir))


def _orders(build):
    return lambda spark, sf_dir: build(orders_tables(spark, sf_dir))


def _driver_orders(rule):
    """A rule on a date, with the order date standing in for a birth date."""

    def run(spark, sf_dir):
        orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
        return orders.select("o_orderkey", rule(F.to_date("o_orderdate")))

    return run


def _number_status(tables):
    states = base.number_states(tables, EVENTS_L)
    return states.select("accountnum", "status", "blocked", "blocked_status", "number_status")


def _port_flags(tables):
    numbers = base.port_events(tables, EVENTS_L).groupBy("accountnum", "port_class").agg(
        F.count(F.lit(1)).alias("events")
    )
    days = profiles.port_out_days(tables, EVENTS_L).withColumnRenamed("IN_ACCOUNT_NUMBER", "accountnum")
    typed = with_existence(
        numbers, base.ported_in(tables, EVENTS_L), "accountnum", "ACTIVATION_TYPE", "MNP", "Standard"
    )
    return typed.join(days, "accountnum", "left")


def _customer_rules(tables):
    """Id-type fold, payment channel fold, youth flag, birthday bucket and anniversary of the master."""
    birth = F.col("CUST_DOB")
    on = date(2024, 1, 24)
    return tables["customer_master"].select(
        "IN_ACCOUNT_NUMBER",
        decode.resident_class(F.col("CUST_LATEST_ID_TYPE")).alias("ACTIVATION_ID_TYPE"),
        decode.payment_channel_fold(F.col("FLAG_POD_POS_COD")).alias("ACTIVATION_PAYMENT_CHANNEL"),
        helpers.flag(helpers.age_in_years(birth, on) <= profiles.YOUTH_AGE).alias("YOUTH_FLAG"),
        helpers.birthday_bucket(birth, on).alias("CUSTOMER_DOB"),
        helpers.same_day_of_year(birth, on).alias("NETWORK_ANNIVERSARY_DAY"),
    )


QUERIES = {
    "customer_base": _events(lambda t: base.customer_base(t, EVENTS_L, DEPARTED_DAYS)),
    "number_status": _events(_number_status),
    "line_status": _events(lambda t: base.current_lines(t, EVENTS_L)),
    "latest_block": _events(lambda t: base.latest_block(t, EVENTS_L)),
    "departed_accounts": _events(lambda t: base.departed_accounts(t, EVENTS_L, DEPARTED_DAYS)),
    "port_out_tag": _events(lambda t: base.departed_lines(t, EVENTS_L, DEPARTED_DAYS)),
    "port_class_flags": _events(_port_flags),
    "termination_date": _events(lambda t: base.termination_date(t, EVENTS_L, DEPARTED_DAYS)),
    "acquisition": _events(lambda t: profiles.acquisition(t, EVENTS_L)),
    "account_limit_flag": _events(profiles.account_limit_flags),
    "survey_join": _events(lambda t: profiles.survey_rows(t, EVENTS_L)),
    "survey_latest": _events(lambda t: profiles.survey_latest(t, EVENTS_L)),
    "customer_rules": _events(_customer_rules),
    "demographics": _events(lambda t: profiles.demographics(t, EVENTS_L)),
    "status": _events(lambda t: profiles.status(t, EVENTS_L)),
    "status_all_answers": _events(lambda t: profiles.status(t, EVENTS_L, newest_answer_only=False)),
    "duplicate_audit": _events(lambda t: profiles.duplicate_audit(t, EVENTS_L)),
    "duplicate_audit_fixed": _events(lambda t: profiles.duplicate_audit(t, EVENTS_L, True)),
    "newest_tags": _events(lambda t: profiles.newest_tags(t, EVENTS_L).select("MSISDN", "ID", "SCUserPerID", "DateTime")),
    "birthday_bucket": _driver_orders(
        lambda born: helpers.birthday_bucket(born, date(2024, 1, 24)).alias("CUSTOMER_DOB")
    ),
    "youth_flag": _driver_orders(
        lambda born: helpers.flag(helpers.age_in_years(born, date(2024, 1, 24)) <= profiles.YOUTH_AGE).alias(
            "YOUTH_FLAG"
        )
    ),
    "registered_not_activated": _events(
        lambda t: profiles.registered_not_activated(t, date(2023, 1, 1), date(2023, 9, 21))
    ),
    "tag_cohort": _events(lambda t: profiles.tag_cohort(t, EVENTS_L)),
    "validity_date": _orders(lambda t: validity.registration_validity(t, ORDERS_L)),
    "newest_activated_record": _orders(
        lambda t: validity.newest_activated_record(t, ORDERS_L).select(
            "IN_ACCOUNT_NUMBER", "NobillContactId", "ActivationDate", "Id", "Contactid"
        )
    ),
    "newest_verified_record": _orders(
        lambda t: validity.newest_verified_record(t, ORDERS_L).select("Contactid", "Id", "IN_ACCOUNT_NUMBER")
    ),
    "visa_page_holders": _orders(validity.visa_page_holders),
    "verification_requests": _orders(lambda t: validity.verification_requests(t, ORDERS_L)),
    "block_pairing": _events(lambda t: disconnection.block_intervals(t, EVENTS_L)),
    "interval_join": _events(lambda t: disconnection.snapshots_with_blocks(t, EVENTS_L)),
    "status_change": _events(lambda t: disconnection.status_changes(t, EVENTS_L)),
    "disconnection_date": _events(lambda t: disconnection.disconnection_date(t, EVENTS_L)),
}

_SERVICES = ", ".join(f"'{s}'" for s in decode.BLOCKING_SERVICES)
_ORDINARY = "subscriptiontype not in ('VM_AppleWatch', 'VM_EventSims')"

_BLOCKS = f"""
blocks as (
  select * from (
    select accountnum, additionalinfo, historytypekey, localtstamp from nobill_tx_account_history
    where additionalinfo in ({_SERVICES})
    qualify row_number() over (partition by accountnum
      order by localtstamp desc nulls last, historytypekey desc, additionalinfo desc) = 1)
  where historytypekey = 'accServiceAdded')"""

_PRESENT = f"""{_BLOCKS},
present as (
  select s.accountnum as IN_ACCOUNT_NUMBER,
    case when s.status = 6 or s.blocked = 1 then 'DEACTIVE'
      when s.status = 3 and (s.blocked = 2 or b.additionalinfo = 'CS.ID_Expiry_1W_Blocking') then 'SUSPENDED'
      when s.status = 3 and s.blocked = 0 and b.accountnum is null then 'ACTIVE'
      else 'DEACTIVE' end as STATUS
  from nobill_snapshot_subscription as s left join blocks as b on b.accountnum = s.accountnum
  where s.snapshotdate = date '2024-01-24' and s.{_ORDINARY})"""

_PORTS = """
ports as (
  select accountnum, tstamp,
    case when historytypekey in ('numDisassociated', 'numDeleted') then 'PORT-OUT'
      when additionalinfo = 'Replace phone number' then 'PORT-IN' else 'Others' end as port_class
  from nobill_tx_phonenumber_history where accountnum > 1 and tstamp < timestamp '2024-01-25'),
port_out as (
  select accountnum, max(tstamp) as at, max(tstamp)::date as on_day from ports
  where port_class = 'PORT-OUT' group by accountnum)"""


def _gone(first: str) -> str:
    return f"""
gone as (
  select accountnum from nobill_snapshot_subscription where snapshotdate >= date '{first}' and {_ORDINARY}
  except
  select accountnum from nobill_snapshot_subscription where snapshotdate = date '2024-01-24' and {_ORDINARY}),
left_lines as (
  select g.accountnum as IN_ACCOUNT_NUMBER,
    case when p.accountnum is null then 'TERMINATED' else 'PORT_OUT' end as STATUS
  from gone as g left join port_out as p using (accountnum))"""


_GONE_20, _GONE_91 = _gone("2024-01-05"), _gone("2023-10-26")
_ALL_LINES = f"""{_PRESENT},{_PORTS},{_GONE_91},
all_lines as (select * from present union all select * from left_lines),
master as (select *, try_cast(IN_ACCOUNT_NUMBER as bigint) as acct from customer_master where REGISTRATION_ID <> ''),
answers as (
  select try_cast(regexp_replace(extra_info, '[^0-9]', '', 'g') as bigint) as acct, score,
    cast(_date as timestamp) as answered, campaign_id
  from usabilla_data where length(regexp_replace(extra_info, '[^0-9]', '', 'g')) > 1),
all_answers as (select a.acct, a.score from answers as a left join usabilla_campaigns as c using (campaign_id)),
last_answers as (
  select acct, score from answers
  qualify row_number() over (partition by acct order by answered desc, score desc) = 1),
limits as (
  select CUST_LATEST_ID_NUMBER, cast(count(*) >= 5 as int) as MAX_ACCOUNTS_LIMIT_FLAG from customer_master
  where LATEST_LINE_STATUS = 'ACTIVE' group by CUST_LATEST_ID_NUMBER)"""
_LINE_TABLES = "nobill_snapshot_subscription nobill_tx_account_history nobill_tx_phonenumber_history"
_PROFILE_TABLES = f"{_LINE_TABLES} customer_master usabilla_data usabilla_campaigns"


def _status_sql(answers: str) -> str:
    return f"""{_ALL_LINES},
report as (
  select x.IN_ACCOUNT_NUMBER, x.STATUS as CUSTOMER_STATUS,
    m.CUST_DAYS_SINCE_LAST_ACTIVITY as LAST_ACTIVITY_DATE,
    case when p.accountnum is null then 0 else 1 end as FLAG_PORT_OUT, l.MAX_ACCOUNTS_LIMIT_FLAG,
    a.score as CUSTOMER_SENTIMENT_SCORE, a.score as CUSTOMER_MOOD_SCORE_CSAT
  from all_lines as x
  left join master as m on m.acct = x.IN_ACCOUNT_NUMBER
  left join port_out as p on p.accountnum = x.IN_ACCOUNT_NUMBER
  left join limits as l on l.CUST_LATEST_ID_NUMBER = m.CUST_LATEST_ID_NUMBER
  left join {answers} as a on a.acct = x.IN_ACCOUNT_NUMBER)
"""


_BIRTHDAY = """
case when month(CUST_DOB) = 1 then
    case when weekofyear(CUST_DOB) = 4 then case when day(CUST_DOB) = 24 then 'Today' else 'Current Week' end
      when weekofyear(CUST_DOB) = 5 then 'Upcoming Week' else 'Current Month' end
  when month(CUST_DOB) = 2 then 'Next Month' else 'Later' end"""
_YOUTH = """
case when 2024 - year(CUST_DOB) - case when month(CUST_DOB) * 100 + day(CUST_DOB) > 124 then 1 else 0 end <= 24
  then 1 else 0 end"""
_ID_CLASS = """
case CUST_LATEST_ID_TYPE when 'Emirates id' then 'Resident' when 'Passport' then 'Tourist'
  when 'GCC id' then 'Tourist' else 'NA' end"""
_CHANNEL = """
case when FLAG_POD_POS_COD is null or FLAG_POD_POS_COD in ('POS', 'POD', 'COD') then FLAG_POD_POS_COD
  else 'Others' end"""

_INTERVALS = f"""
pairs as (
  select accountnum, additionalinfo, historytypekey, tstamp,
    row_number() over (partition by accountnum, additionalinfo, historytypekey order by tstamp) as n
  from nobill_tx_account_history
  where additionalinfo in ({_SERVICES}) and historytypekey in ('accServiceAdded', 'accServiceRemoved')),
intervals as (
  select a.accountnum, a.additionalinfo, a.tstamp as add_date,
    coalesce(r.tstamp, timestamp '2024-01-25') as remove_date, r.tstamp is null as is_open
  from (select * from pairs where historytypekey = 'accServiceAdded') as a
  left join (select * from pairs where historytypekey = 'accServiceRemoved') as r
    using (accountnum, additionalinfo, n)),
covered as (
  select s.accountnum, s.snapshotdate, s.status, s.blocked, i.additionalinfo, i.add_date, i.remove_date
  from nobill_snapshot_subscription as s left join intervals as i
    on i.accountnum = s.accountnum and s.snapshotdate + 1 >= i.add_date
      and (i.is_open or s.snapshotdate + 1 < i.remove_date)
  where s.{_ORDINARY}),
days as (
  select accountnum, snapshotdate, max(
    case when status = 6 or blocked = 1 then 'DEACTIVE'
      when additionalinfo = 'CS.ID_Expiry_1W_Blocking' or (status = 3 and blocked = 2) then 'SUSPENDED'
      when additionalinfo is null and status = 3 and blocked = 0 then 'ACTIVE' else 'DEACTIVE' end) as line_status
  from covered group by accountnum, snapshotdate),
changes as (
  select accountnum, snapshotdate, line_status,
    lag(line_status, 1, 'NA') over w as prev_status,
    lag(snapshotdate, 1, date '2017-01-01') over w as prev_status_date
  from days window w as (partition by accountnum order by snapshotdate))"""

_RECORDS = """
records as (
  select * from customerdb_customers where NobillContactId is not null
  qualify row_number() over (partition by NobillContactId order by Id desc) = 1),
activated as (
  select a.NobillAccountNo as IN_ACCOUNT_NUMBER, a.ActivationDate, r.*
  from cas_tx_activations as a join records as r on r.NobillContactId = a.NobillCustomerID
  qualify row_number() over (partition by a.NobillAccountNo
    order by a.ActivationDate desc, r.NobillContactId desc) = 1),
verified as (
  select * from activated where VerificationStatus is not null
  qualify row_number() over (partition by Contactid order by Id desc, IN_ACCOUNT_NUMBER desc) = 1)"""

_events_sql = {
    "customer_base": (
        _LINE_TABLES,
        f"{_PRESENT},{_PORTS},{_GONE_20} select * from present union all select * from left_lines",
    ),
    "number_status": (
        "nobill_snapshot_subscription",
        f"""
select accountnum, status, blocked,
  case blocked when 0 then 'not blocked' when 1 then 'all activity blocked'
    when 2 then 'charged activity blocked' end as blocked_status,
  case when status <> 3 then 'DEACTIVE' when blocked = 0 then 'ACTIVE' when blocked = 1 then 'DEACTIVE'
    when blocked = 2 then 'SUSPENDED' end as number_status
from nobill_snapshot_subscription where snapshotdate = date '2024-01-24' and {_ORDINARY}""",
    ),
    "line_status": (_LINE_TABLES, f"{_PRESENT} select * from present"),
    "latest_block": ("nobill_tx_account_history", f"{_BLOCKS} select * from blocks"),
    "departed_accounts": (_LINE_TABLES, f"{_PORTS},{_GONE_20} select accountnum from gone"),
    "port_out_tag": (_LINE_TABLES, f"{_PORTS},{_GONE_20} select * from left_lines"),
    "port_class_flags": (
        "nobill_tx_phonenumber_history",
        f"""{_PORTS}
select p.accountnum, p.port_class, count(*) as events,
  case when p.accountnum in (select accountnum from ports where port_class = 'PORT-IN') then 'MNP'
    else 'Standard' end as ACTIVATION_TYPE,
  cast(date '2024-01-25' - o.on_day as int) as DAYS_SINCE_PORTOUT
from ports as p left join port_out as o using (accountnum)
group by p.accountnum, p.port_class, o.on_day""",
    ),
    "termination_date": (
        _LINE_TABLES,
        f"""{_PORTS}
select s.accountnum as IN_ACCOUNT_NUMBER,
  max(coalesce(p.at, cast(s.snapshotdate as timestamp))) as TERMINATION_DATE
from nobill_snapshot_subscription as s left join port_out as p using (accountnum)
where s.snapshotdate >= date '2024-01-05' and s.{_ORDINARY}
  and s.accountnum not in (select accountnum from nobill_snapshot_subscription
    where snapshotdate = date '2024-01-24' and {_ORDINARY})
group by s.accountnum""",
    ),
    "acquisition": (
        f"{_PROFILE_TABLES} vmwsc_registration",
        f"""{_ALL_LINES}
select x.IN_ACCOUNT_NUMBER, {_CHANNEL} as ACTIVATION_PAYMENT_CHANNEL,
  m.CUST_REGISTRATION_CHANNEL as EMAIL_REGISTRATION_CHANNEL,
  case when exists (select 1 from ports where ports.accountnum = x.IN_ACCOUNT_NUMBER and port_class = 'PORT-IN')
    then 'MNP' else 'Standard' end as ACTIVATION_TYPE,
  {_ID_CLASS} as ACTIVATION_ID_TYPE, cast(m.FULL_ACTIVATION_DATE as date) as ACTIVATION_DATE,
  m.SALES_CHANNEL as ACTIVATION_CHANNEL,
  cast(date '2024-01-24' - cast(m.CUST_REGISTRATION_DATE as date) as int) as EMAIL_REGISTRATION_DATE,
  cast(null as date) as FUNNEL_EVENT_DATE,
  coalesce(cast(r.IsEmailVerified as int), 0) as EMAIL_VERIFIED_FLAG,
  cast(null as varchar) as FUNNEL_LAST_STEP, cast(null as varchar) as FUNNEL_EVENT_NAME
from all_lines as x left join master as m on m.acct = x.IN_ACCOUNT_NUMBER
  left join vmwsc_registration as r on r.ID = m.REGISTRATION_ID
  left join all_answers as a on a.acct = x.IN_ACCOUNT_NUMBER""",
    ),
    "account_limit_flag": (
        "customer_master",
        """
select CUST_LATEST_ID_NUMBER, case when count(*) < 5 then 0 else 1 end as MAX_ACCOUNTS_LIMIT_FLAG
from customer_master where LATEST_LINE_STATUS = 'ACTIVE' group by all""",
    ),
    "survey_join": (
        "usabilla_data usabilla_campaigns",
        """
select u.score, regexp_replace(u.extra_info, '[^0-9]', '', 'g') as UID
from usabilla_data as u left join usabilla_campaigns as c on c.campaign_id = u.campaign_id
where length(regexp_replace(u.extra_info, '[^0-9]', '', 'g')) > 1""",
    ),
    "survey_latest": (
        "usabilla_data",
        """
select arg_max(score, (cast(_date as timestamp), score)) as score, UID
from (select *, regexp_replace(extra_info, '[^0-9]', '', 'g') as UID from usabilla_data)
where length(UID) > 1 group by UID""",
    ),
    "customer_rules": (
        "customer_master",
        f"""
select IN_ACCOUNT_NUMBER, {_ID_CLASS} as ACTIVATION_ID_TYPE, {_CHANNEL} as ACTIVATION_PAYMENT_CHANNEL,
  {_YOUTH} as YOUTH_FLAG, {_BIRTHDAY} as CUSTOMER_DOB,
  case when month(CUST_DOB) = 1 and day(CUST_DOB) = 24 then 1 else 0 end as NETWORK_ANNIVERSARY_DAY
from customer_master""",
    ),
    "demographics": (
        _PROFILE_TABLES,
        f"""{_ALL_LINES}
select x.IN_ACCOUNT_NUMBER, m.CRM_UID as CUSTOMER_ID, m.REGISTRATION_ID, m.EMAIL, m.MSISDN,
  m.CUST_NATIONALITY_NAME as NATIONALITY, m.CUST_FIRST_NAME || ' ' || m.CUST_LAST_NAME as CUSTOMER_NAME,
  {_YOUTH} as YOUTH_FLAG, {_BIRTHDAY} as CUSTOMER_DOB, m.CUST_LAST_PRODUCT_NAME as USER_TYPE,
  case when month(CUST_DOB) = 1 and day(CUST_DOB) = 24 then 1 else 0 end as NETWORK_ANNIVERSARY_DAY,
  cast(date '2024-01-24' - cast(m.FULL_ACTIVATION_DATE as date) as int) as DAYS_SINCE_REGISTRATION
from all_lines as x left join master as m on m.acct = x.IN_ACCOUNT_NUMBER
  left join all_answers as a on a.acct = x.IN_ACCOUNT_NUMBER""",
    ),
    "status": (_PROFILE_TABLES, _status_sql("last_answers") + "select * from report"),
    "status_all_answers": (_PROFILE_TABLES, _status_sql("all_answers") + "select * from report"),
    "duplicate_audit": (
        _PROFILE_TABLES,
        _status_sql("all_answers")
        + "select IN_ACCOUNT_NUMBER, count(*) as ROW_COUNT from report group by 1 having count(*) > 1",
    ),
    "duplicate_audit_fixed": (
        _PROFILE_TABLES,
        _status_sql("last_answers")
        + "select IN_ACCOUNT_NUMBER, count(*) as ROW_COUNT from report group by 1 having count(*) > 1",
    ),
    "registered_not_activated": (
        "vmwsc_registration cas_tx_activations",
        """
select AccountNumber as CRMAccountNo, Email as REG_EMAIL, DateTime, CustomerID,
  IsEmailVerified as EMAIL_VERIFIED_FLAG, ChannelID as EMAIL_REGISTRATION_CHANNEL
from vmwsc_registration
where IsEmailVerified and DateTime >= timestamp '2023-01-01' and DateTime < timestamp '2023-09-21'
  and not exists (select 1 from cas_tx_activations as a where a.CRMAccountNo = AccountNumber)
order by DateTime desc""",
    ),
    "tag_cohort": (
        "ne_scusertaghistory ne_scuserschannelspermission customer_master",
        """
select m.IN_ACCOUNT_NUMBER from customer_master as m
where m.MSISDN in (select p.MSISDN from ne_scuserschannelspermission as p
  join ne_scusertaghistory as h on h.SCUserPerID = p.ID where h.TagID = 3 and p.MSISDN is not null)""",
    ),
    "newest_tags": (
        "ne_scusertaghistory ne_scuserschannelspermission",
        """
select p.MSISDN, h.ID, h.SCUserPerID, h.DateTime
from ne_scusertaghistory as h left join ne_scuserschannelspermission as p on p.ID = h.SCUserPerID
where h.TagID = 3
qualify row_number() over (partition by p.MSISDN order by h.DateTime desc, h.ID desc) = 1""",
    ),
    "block_pairing": (_LINE_TABLES, f"{_INTERVALS} select accountnum, additionalinfo, add_date, remove_date from intervals"),
    "interval_join": (_LINE_TABLES, f"{_INTERVALS} select * from covered"),
    "status_change": (_LINE_TABLES, f"{_INTERVALS} select * from changes where line_status <> prev_status"),
    "disconnection_date": (
        _LINE_TABLES,
        f"""{_INTERVALS}
select accountnum as IN_ACCOUNT_NUMBER, max(snapshotdate) as DISCONNECTION_DATE from changes
where prev_status = 'ACTIVE' and line_status in ('SUSPENDED', 'DEACTIVE') group by accountnum""",
    ),
}

_REQUEST_FIELDS = """
r.ID as IDVERIFICATION_ID, r.CreationDate as IDVERIFICATION_DATE, r.CustomerID as IDVERIFICATION_CUSTOMERID,
r.IDExpiryDate as IDVERIFICATION_IDEXPIRYDATE, r.IDIssueDate as IDVERIFICATION_ISSUEDDATE,
r.IDNumber as IDVERIFICATION_IDNUMBER, r.NationalityCode as IDVERIFICATION_NATIONALITYCODE,
cast(r.IDTypeId as int) as IDVERIFICATION_IDTYPEID"""

_orders_sql = {
    "newest_activated_record": (
        "customerdb_customers cas_tx_activations",
        f"""{_RECORDS}
select IN_ACCOUNT_NUMBER, NobillContactId, ActivationDate, Id, Contactid from activated""",
    ),
    "newest_verified_record": (
        "customerdb_customers cas_tx_activations",
        f"{_RECORDS} select Contactid, Id, IN_ACCOUNT_NUMBER from verified",
    ),
    "visa_page_holders": (
        "customer_db_documents",
        """
select CustomerId as Id from customer_db_documents
where StatusCode = 1 and DocType = 'entrystamppageofthepassport' group by CustomerId""",
    ),
    "verification_requests": (
        "cas_id_verification_request cas_process cas_id_verification_status",
        f"""
select {_REQUEST_FIELDS},
  case r.IDTypeId when 1 then 'Emirates ID' when 2 then 'Passport' when 3 then 'GCC National ID'
    else 'Null' end as IDVERIFICATION_IDTYPE_NAME,
  p.NAME as ProcessNAME, s.Name as STATUSNAME
from cas_id_verification_request as r left join cas_process as p on p.ID = r.ProcessID
  left join cas_id_verification_status as s on s.ID = r.VerificationStatusID
where r.ProcessID in (1, 2, 4, 5, 21, 22, 40, 41, 48, 51)""",
    ),
    "validity_date": (
        "customerdb_customers cas_tx_activations customer_db_documents wsc_countries_lookup",
        f"""{_RECORDS},
facts as (
  select v.IN_ACCOUNT_NUMBER, v.IsDiplomat = 1 and v.DiplomaticId is not null as diplomat,
    case v.IdType when 'emiratesid' then 'E' when 'passport' then 'P' when 'gccid' then 'G' end as kind,
    cast(coalesce(v.VerificationDate, v.CreatedOn) as date) as reported,
    cast(v.ExpiryDate as date) as expiry,
    nullif(v.ExtensionReason, 'TDRABacklogClearance') as reason,
    case when v.ExtensionReason is distinct from 'TDRABacklogClearance'
      then cast(v.ExtendedExpiryDate as date) end as original,
    (select max(name) from wsc_countries_lookup as c where c.alpha_3 = case v.Nationality
      when 'D' then 'Germany' when 'RKS' then 'Kosovo' else v.Nationality end) as country,
    exists (select 1 from customer_db_documents as d where d.CustomerId = v.Id and d.StatusCode = 1
      and d.DocType = 'entrystamppageofthepassport') as visa
  from verified as v),
extended as (
  select *, case when not diplomat and reason is null and reported >= date '2022-01-01' then null
    else original end as ext
  from facts),
final as (
  select *, case when diplomat then coalesce(ext, expiry) else expiry end as limit_day,
    reported + case when kind = 'P' and not visa then 30 else 90 end as extended_to
  from extended)
select IN_ACCOUNT_NUMBER,
  case when diplomat or kind = 'E' or country = 'United Arab Emirates' then coalesce(ext, limit_day)
    when kind = 'P' or (kind = 'G' and reported > date '2020-03-17') then
      coalesce(ext, case when extended_to > limit_day then limit_day else extended_to end)
    when kind = 'G' then coalesce(ext, limit_day) end as REGISTRATION_VALIDITY_DATE
from final""",
    ),
}

ORACLES = {
    **{k: oracle_with(EVENTS_BINDINGS, names, sql) for k, (names, sql) in _events_sql.items()},
    **{k: oracle_with(ORDERS_BINDINGS, names, sql) for k, (names, sql) in _orders_sql.items()},
    "birthday_bucket": f"""
select o_orderkey, {_BIRTHDAY.replace('CUST_DOB', 'o_orderdate')} as CUSTOMER_DOB from orders""",
    "youth_flag": f"select o_orderkey, {_YOUTH.replace('CUST_DOB', 'o_orderdate')} as YOUTH_FLAG from orders",
}
