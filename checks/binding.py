"""The operator's source tables, derived from the driver's tables.

Each binding is one SELECT in the common subset of Spark SQL and DuckDB. Spark runs it over the
parquet files and hands the result to a pipeline; the oracle puts the same text in front of its
own query as a WITH clause, so both sides start from the same rows.

Two time frames are used, because ``events`` covers January 2024 and ``orders`` / ``lineitem``
the years 1995 to 2001.
"""

from __future__ import annotations

import zlib
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession

from sublens.sources.tables import Tables

EVENTS_L = date(2024, 1, 25)
ORDERS_L = date(1998, 7, 15)

DRIVER_TABLES = "region nation customer supplier part orders lineitem events".split()


def _key(prefix: str, column: str) -> str:
    return f"'{prefix}' || cast({column} as string)"


_BRAND = "cast(substr(p_brand, 7) as int)"

# Ids of the three services of an order, by its lines: 0 mod 3 national, 1 data, 2 international.
_LINES = """(
    select l_orderkey, min(l_partkey) as lo, count(*) as n,
      cast(3 * (min(l_partkey) % 5) as string) as s1,
      cast(3 * (max(l_partkey) % 5) + 1 as string) as s2,
      cast(3 * (count(*) % 5) + 2 as string) as s3
    from {lineitem} group by l_orderkey)"""

_LINE_OF_ACCOUNT = "{lineitem} join {orders} on l_orderkey = o_orderkey"

_CUSTOMER_MASTER = f"""
select {_key('', 'c_custkey')} as IN_ACCOUNT_NUMBER, {_key('U', 'c_custkey')} as CRM_UID,
  case when c_custkey % 11 = 10 then '' when c_custkey % 23 = 22 then null
       else {_key('R', 'c_custkey')} end as REGISTRATION_ID,
  lower(c_name) || '@example.com' as EMAIL, {_key('97150', 'c_custkey')} as MSISDN,
  n_name as CUST_NATIONALITY_NAME, c_mktsegment as CUST_FIRST_NAME,
  case when c_custkey % 9 = 8 then null else c_name end as CUST_LAST_NAME,
  case c_mktsegment when 'BUILDING' then 'Emirates id' when 'MACHINERY' then 'Passport'
       when 'FURNITURE' then 'GCC id' when 'HOUSEHOLD' then 'Visit visa' end as CUST_LATEST_ID_TYPE,
  {_key('ID', 'c_nationkey')} || '-' || cast(cast(floor(c_acctbal / 1000) as int) as string)
    as CUST_LATEST_ID_NUMBER,
  case when c_custkey % 29 = 28 then null
       else date '1960-01-01' + cast(c_custkey * 37 % 18000 as int) end as CUST_DOB,
  {_key('Plan ', 'c_nationkey % 4')} as CUST_LAST_PRODUCT_NAME,
  cast(date '<ACTIVATED>' + cast(c_custkey * 31 % 1400 as int) as timestamp) as FULL_ACTIVATION_DATE,
  cast(date '<ACTIVATED>' + cast(c_custkey * 17 % 900 as int) as timestamp) as CUST_REGISTRATION_DATE,
  case when c_nationkey % 2 = 0 then 'App' else 'Web' end as CUST_REGISTRATION_CHANNEL,
  case c_custkey % 5 when 0 then 'POS' when 1 then 'POD' when 2 then 'COD' when 3 then 'Kiosk' end
    as FLAG_POD_POS_COD,
  {_key('Shop ', 'c_nationkey')} as SALES_CHANNEL,
  {_key('', 'c_custkey % 200')} as CUST_DAYS_SINCE_LAST_ACTIVITY,
  case when c_acctbal > 0 then 'ACTIVE' else 'DEACTIVE' end as LATEST_LINE_STATUS
from {{customer}} left join {{nation}} on c_nationkey = n_nationkey"""


def _scores(event_type: str, date_name: str, columns: str) -> str:
    return f"""
select {_key('', 'user_id')} as in_account_number, cast(ts as date) as {date_name}, {columns}
from {{events}} where event_type = '{event_type}'"""


_DECILE = "cast(floor(value) as int) % 10 + 1 as decile"

EVENTS_BINDINGS = {
    "nobill_snapshot_subscription": f"""
select user_id as accountnum, {_key('97150', 'user_id')} as phonenumber,
  case count(*) % 7 when 6 then 6 when 5 then 4 else 3 end as status,
  case when sum(case when event_type = 'error' then 1 else 0 end) >= 2 then 1
       when sum(case when event_type = 'view' then 1 else 0 end) >= 2 then 2 else 0 end as blocked,
  cast(ts as date) as snapshotdate,
  case when user_id % 13 = 12 then 'VM_AppleWatch' when user_id % 17 = 16 then 'VM_EventSims'
       when user_id % 19 = 18 then null else 'VM_Standard' end as subscriptiontype
from {{events}} group by user_id, cast(ts as date)""",
    "nobill_tx_account_history": """
select user_id as accountnum,
  case event_id % 9 when 0 then 'CS.TRA_Blocking' when 1 then 'CS.FRAUD_Blocking'
    when 2 then 'CS.Police_CatA_Blocked_Flag' when 3 then 'CS.Police_CatB_Blocked_Flag'
    when 4 then 'CS.ID_Expiry_1W_Blocking' when 5 then 'CS.ID_Expiry_2W_Blocking'
    when 6 then 'CS.HardSIM_Capping' else 'CS.Other' end as additionalinfo,
  case event_type when 'error' then 'accServiceAdded' when 'view' then 'accServiceRemoved'
    else 'accUpdated' end as historytypekey,
  ts as localtstamp, ts as tstamp
from {events} where event_type in ('error', 'view', 'click')""",
    "nobill_tx_phonenumber_history": """
select user_id as accountnum,
  case when event_type = 'purchase' and event_id % 50 = 0 then 'numDisassociated'
       when event_type = 'purchase' and event_id % 50 = 1 then 'numDeleted'
       else 'numAssociated' end as historytypekey,
  case when event_type = 'signup' and event_id % 20 = 0 then 'Replace phone number'
       else 'New number' end as additionalinfo,
  ts as tstamp
from {events}""",
    "customer_master": _CUSTOMER_MASTER.replace("<ACTIVATED>", "2020-01-15"),
    "vmwsc_registration": f"""
select {_key('R', 'c_custkey')} as ID, lower(c_name) || '@example.com' as Email,
  cast(date '2023-01-01' + cast(c_custkey * 7 % 400 as int) as timestamp) as DateTime,
  {_key('C', 'c_custkey')} as CustomerID, {_key('A', 'c_custkey')} as AccountNumber,
  c_custkey % 3 <> 0 as IsEmailVerified, c_nationkey as ChannelID
from {{customer}}""",
    "usabilla_data": f"""
select cast(floor(value) as int) % 11 as score,
  {_key('account ', 'user_id')} || ' (web)' as extra_info,
  cast(ts as string) as _date, {_key('', 'event_id % 9')} as campaign_id
from {{events}} where event_type = 'purchase'""",
    "usabilla_campaigns": f"select {_key('', 'n_nationkey % 8')} as campaign_id from {{nation}}",
    "cas_tx_activations": f"""
select case o_orderpriority when '1-URGENT' then 'A' else 'B' end || cast(o_custkey as string)
    as CRMAccountNo,
  {_key('', 'o_custkey')} as NobillAccountNo, {_key('N', 'o_custkey')} as NobillCustomerID,
  o_orderdate as ActivationDate
from {{orders}} where o_orderstatus = 'F' and o_orderpriority in ('1-URGENT', '2-HIGH')""",
    "roaming_ussd_received_data": f"""
select event_id as ID, {_key('97150', 'user_id')} as MSISDN,
  case when event_id * 7 % 40 < 10 then '424' when event_id * 7 % 40 = 10 then '901'
       when event_id * 7 % 40 = 11 then '000' when event_id * 7 % 40 = 12 then 'abc'
       else {_key('', '410 + event_id * 7 % 40')} end as MCC,
  ts as DATETIME
from {{events}}""",
    "dim_roam_country_operator": f"""
select {_key('', '420 + s_nationkey')} as MCC, {_key('Country ', 's_nationkey % 9')} as country
from {{supplier}}""",
    "loy_customer_trx_log": "select user_id as customer_id, value as points, ts as CREATE_DATE from {events}",
    "loy_dim_customer": f"""
select c_custkey as ID, case when c_custkey % 10 = 9 then {_key('none', 'c_custkey')}
  else {_key('U', 'c_custkey')} end as identifier_value
from {{customer}}""",
    "loy_customer_cashback": """
select event_id as id, user_id as customer_id,
  case when cast(floor(value) as int) % 6 < 5 then cast(floor(value) as int) % 6 end as tier_id,
  ts as CREATE_DATE
from {events} where event_type = 'purchase'""",
    "loy_tier": "select r_regionkey as ID, r_name as name_en from {region}",
    "ne_scusertaghistory": """
select event_id as ID, user_id as SCUserPerID,
  case event_type when 'click' then 3 when 'view' then 2 else 1 end as TagID, ts as DateTime
from {events}""",
    "ne_scuserschannelspermission": f"""
select c_custkey as ID, case when c_custkey % 15 = 14 then null else {_key('97150', 'c_custkey')} end as MSISDN
from {{customer}}""",
    "churn_monthly_payg_results": _scores(
        "click", "snapshot_date", f"value as churn_probability, {_DECILE}"
    ),
    "happiness_index_results": _scores("view", "snapshot_date", f"value as chi_score, {_DECILE}"),
    "home_internet_affinity_results": _scores(
        "purchase", "snapshot_date", f"value as MBB_affinity_probability, {_DECILE}"
    ),
    "renewal_results": _scores("signup", "snapshot_date", f"value as non_renewal_probability, {_DECILE}"),
    "migration_propensity_results": _scores("error", "date_cvm", "value as propensity_to_buy"),
    "payg_recommendation_results": _scores("click", "snapshot_date", "props as class, value as proba"),
    "cr_product_recommendation_results": """
select cast(user_id as string) as in_account_number, cast(ts as date) as date_dt,
  value / 7 as predicted_data, value * 2 as predicted_natl, value + 1 as predicted_intl,
  'data ' || event_type as data_booster_recommended, 'natl ' || event_type as natl_booster_recommended,
  case when event_type = 'view' then null else 'intl ' || event_type end as intl_booster_recommended,
  value as data_booster_recommended_price, value + 2 as natl_booster_recommended_price,
  value + 3 as intl_booster_recommended_price
from {events}""",
    "cr_optimum_plan_recommendation_results": """
select cast(user_id as string) as in_account_number, cast(ts as date) as date_dt,
  'Plan ' || event_type as right_size_plan_name, value * 2 as current_plan_net_cost,
  value as right_size_plan_net_cost,
  case when event_id % 13 = 12 then null else cast(event_id % 97 as double) end as "60day_avg_money_spent",
  cast(event_id % 41 - 20 as double) as right_size_plan_price_change
from {events}""",
    "cr_upselling_plan_recommendation_results": """
select cast(user_id as string) as in_account_number, cast(ts as date) as date_dt,
  'Bigger ' || event_type as step_up_plan_name,
  case when event_id % 11 = 10 then 0.0 else cast(event_id % 89 as double) end as current_plan_net_cost,
  value as step_up_plan_data_change, value + 1 as step_up_plan_intl_min_change,
  value * 3 as step_up_plan_price,
  case when event_id % 17 = 16 then null else value / 3 end as step_up_plan_price_change,
  case when event_id % 7 = 6 then 0.0 else cast(event_id % 61 as double) end as "60day_avg_money_spent",
  value + 2 as step_up_plan_national_min_change, value / 2 - 4 as step_up_spent_change
from {events}""",
}

ORDERS_BINDINGS = {
    "customer_master": _CUSTOMER_MASTER.replace("<ACTIVATED>", "1995-06-01"),
    "cas_tx_activations": EVENTS_BINDINGS["cas_tx_activations"],
    "nobill_snapshot_subscription": f"""
select o_custkey as accountnum,
  case when l_linenumber = 7 then {_key('97155', 'o_custkey')} else {_key('97150', 'o_custkey')} end
    as phonenumber,
  3 as status, 0 as blocked, cast(l_shipdate as date) as snapshotdate, 'VM_Standard' as subscriptiontype
from {_LINE_OF_ACCOUNT}""",
    "customerdb_customers": f"""
select o_orderkey as Id, {_key('C', 'cast(floor(o_custkey / 2) as bigint)')} as Contactid,
  case when o_orderkey % 10 = 0 then 1 else 0 end as IsDiplomat,
  {_key('N', 'o_custkey')} as NobillContactId,
  case substr(o_orderpriority, 1, 1) when '1' then 'emiratesid' when '2' then 'passport'
    when '3' then 'gccid' when '4' then 'passport' else 'other' end as IdType,
  cast(cast(o_orderdate as date) + 8000 + cast(o_orderkey * 7 % 200 as int) as timestamp) as ExpiryDate,
  o_orderdate as RegistrationDate,
  case when o_orderstatus = 'P' then null
       else cast(cast(o_orderdate as date) + 8000 as timestamp) end as VerificationDate,
  case when o_orderkey % 33 = 32 then null
       else cast(cast(o_orderdate as date) + 7990 as timestamp) end as CreatedOn,
  case when o_orderkey % 7 = 6 then null else 'verified' end as VerificationStatus,
  case o_orderkey % 6 when 0 then 'TDRABacklogClearance' when 1 then 'Travel' when 2 then 'Other' end
    as ExtensionReason,
  case when o_orderkey % 4 < 2 then null
       else cast(cast(o_orderdate as date) + 8120 as timestamp) end as ExtendedExpiryDate,
  case when o_orderkey % 20 = 0 then {_key('D', 'o_orderkey')} end as DiplomaticId,
  case o_custkey % 30 when 27 then 'D' when 28 then 'RKS' when 29 then null
    else {_key('N', 'o_custkey % 30')} end as Nationality
from {{orders}}""",
    "customer_db_documents": """
select l_orderkey as CustomerId, l_partkey * 10 + l_linenumber as id,
  case when l_linestatus = 'O' then 1 else 0 end as StatusCode,
  case when l_returnflag = 'R' then 'entrystamppageofthepassport' else 'photo' end as DocType
from {lineitem}""",
    "wsc_countries_lookup": f"""
select {_key('N', 's_nationkey')} as alpha_3,
  case when s_nationkey = 7 then 'United Arab Emirates' else {_key('Country ', 's_suppkey')} end as name
from {{supplier}}""",
    "cas_id_verification_request": f"""
select o_orderkey as ID, o_orderdate as CreationDate, {_key('C', 'o_custkey')} as CustomerID,
  cast(cast(o_orderdate as date) + 365 as timestamp) as IDExpiryDate,
  cast(cast(o_orderdate as date) - 30 as timestamp) as IDIssueDate,
  {_key('', 'o_orderkey * 3')} as IDNumber, {_key('N', 'o_custkey % 30')} as NationalityCode,
  o_orderkey % 5 as IDTypeId, o_orderkey % 53 as ProcessID,
  case o_orderstatus when 'F' then 1 when 'O' then 2 else 9 end as VerificationStatusID
from {{orders}}""",
    "cas_process": f"select distinct p_size as ID, {_key('Process ', 'p_size')} as NAME from {{part}}",
    "cas_id_verification_status": """
select distinct case o_orderstatus when 'F' then 1 when 'O' then 2 else 3 end as ID,
  'Status ' || o_orderstatus as Name
from {orders}""",
    "po_sre_customer": f"""
select c_custkey as Id,
  case when c_custkey % 31 = 30 then {_key('X_', 'c_custkey')} when c_custkey % 37 = 36 then null
       when c_custkey % 41 = 40 then 'none'
       else {_key('', 'cast(1000 + floor(c_custkey / 25) as bigint)')} end as NobillAccountNo,
  {_key('97150', 'c_custkey')} as MSISDN,
  cast(date '1994-01-01' + cast(c_custkey * 11 % 800 as int) as timestamp) as SubscribeDate,
  cast(date '1998-01-01' + cast(c_custkey * 13 % 150 as int) as timestamp) as LastUpdateDate,
  case when c_custkey % 3 = 0 then null else c_custkey % 28 end as RenewalDay
from {{customer}}""",
    "po_sre_actionhistory": f"""
select o_orderkey as Id,
  case substr(o_orderpriority, 1, 1) when '1' then 1 when '2' then 3 when '3' then 13 when '4' then 32
    else case o_orderkey % 4 when 0 then 14 when 1 then 30 when 2 then 50 else 4 end end as ActionId,
  o_orderdate as DateTime, o_custkey as CustomerId,
  case when n % 4 = 0 then s1 || ',' || s2 || ',' || s3
       when n % 4 = 1 then s3 || ',' || s1 || ',' || s2
       when n % 4 = 2 then s1 || ',' || s2
       when lo % 3 = 0 then s2
       when lo % 3 = 1 then s1 || ',,' || s3
       when lo % 3 = 2 then s3 || ',' || s1 end as ServiceIds,
  case when o_orderkey % 17 = 16 then null else o_orderkey end as SubscriptionId,
  o_orderdate as LastUpdateDate,
  case when o_orderkey % 10 < 4 then 1 when o_orderkey % 10 < 6 then 2
       when o_orderkey * 7 % 15 = 11 then 168 when o_orderkey * 7 % 15 = 12 then 190
       when o_orderkey * 7 % 15 = 13 then 99 when o_orderkey * 7 % 15 = 14 then null
       else o_orderkey * 7 % 15 end as ProductCode,
  case when o_orderkey % 10 = 9 then 1 else 2 end as StatusId
from {{orders}} left join {_LINES} as of_order on o_orderkey = l_orderkey""",
    "po_sre_action": f"""
select distinct p_size as ID,
  case when p_size in (30, 50) then {_key('Plan Pause ', 'p_size')} else {_key('Action ', 'p_size')} end as Name
from {{part}}""",
    "po_sre_subscription": """
select o_orderkey as Id, o_custkey as CustomerId, 2 as StatusId,
  case when o_orderkey % 2 = 0 and o_orderdate >= timestamp '1998-06-20' and o_orderdate < timestamp '1998-07-15'
    then timestamp '1998-07-14' else o_orderdate end as StartDate,
  cast(cast(o_orderdate as date) + cast(o_orderkey * 13 % 400 as int) as timestamp) as EndDate
from {orders}""",
    "po_sre_paymenthistory": """
select case when l_linenumber = 1 then null else l_orderkey end as ActionHistoryId,
  9 + l_linenumber as PaymentMethodId,
  case when l_discount = 0 then 0.0 else l_extendedprice end as PaidAmount,
  l_linestatus = 'O' as IsSuccess, l_shipdate as DateTime
from {lineitem}""",
    "po_sre_shareplanhistory": """
select l_partkey * 10 + l_linenumber as Id, l_orderkey as ActionHistoryId, l_linenumber as ServiceId,
  case when l_linenumber = 7 then null else l_orderkey end as SubscriptionId,
  cast(l_quantity as bigint) * 104857600 + l_partkey as CounterValue,
  case when l_linestatus = 'O' then 1 else 0 end as IsSuccess
from {lineitem}""",
    "po_po_service": f"""
select {_BRAND} - 1 as Id, min(p_name) as Name, {_BRAND} % 4 as ServiceChargingTypeId,
  {_BRAND} % 6 as ServiceTypeId, {_BRAND} % 7 as ServiceCategoryId, min(p_retailprice) as ServiceCost,
  1 as StatusId, cast(date '1995-01-01' + cast({_BRAND} * 13 % 900 as int) as timestamp) as CreationDate
from {{part}} group by {_BRAND}""",
    "po_po_servicecategory": "select r_regionkey as Id, 'Category ' || r_name as Name from {region}",
    "po_po_servicetype": "select r_regionkey as Id, 'Type ' || r_name as Name from {region}",
    "po_po_servicechargingtype": "select r_regionkey as Id, 'Charge ' || r_name as Name from {region}",
    "po_po_bundle": f"""
select distinct {_BRAND} - 1 as ServiceId,
  100 + {_BRAND} + case when p_type = 'LARGE' then 1 else 0 end as EventId,
  case when {_BRAND} % 6 = 5 then null else 900 + {_BRAND} % 7 end as CounterId,
  case when {_BRAND} % 5 = 4 then null else 'Your ' || p_brand end as CustomerServiceName
from {{part}}""",
    "nobill_dim_event": f"""
select p_partkey as dev_event_id, 100 + {_BRAND} as dev_eventid_base,
  case when p_type = 'PROMO' then 'VAS' else 'Usage' end as dev_category_1,
  p_type as dev_category_2,
  case ({_BRAND} - 1) % 3 when 0 then 'Natl' when 1 then 'Data' else 'Intl' end ||
    case p_type when 'STANDARD' then ' Booster' when 'MEDIUM' then ' Roaming' when 'LARGE' then ' booster plus'
      else ' Plan' end as dev_category_3,
  p_brand as dev_category_4, {_key('Size ', 'p_size')} as dev_category_6,
  p_name as dev_event_name, p_name || ' event' as dev_event_desc
from {{part}}""",
    "po_service_file": f"""
select {_key('', '100 + brand')} as EXCEL_SERVICE_EVENT_ID,
  case (brand + other) % 12 when 0 then 'VOIP' when 1 then 'Netflix' when 2 then 'Anghami'
    when 3 then 'AppleWatch' when 4 then 'Entertainer' when 5 then 'DATA_ROM' when 6 then 'VOICE_OUT_ROM'
    when 7 then 'DATA_PASS_ROM' when 8 then 'VOICE_PASS_ROM' when 9 then 'DATA' when 10 then 'VOICE_LCL'
    else 'VOICE_INT' end as EXCEL_SERVICE_TYPE,
  case when (brand + other) % 12 < 5 then 'VAS' when (brand + other) % 12 < 9 then 'Roaming'
    else 'Booster' end as EXCEL_SERVICE_CATEGORY,
  {_key('Service ', 'brand')} || '/' || cast(other as string) as EXCEL_SERVICE_DESCRIPTION
from (select distinct {_BRAND} as brand, case when p_type = 'LARGE' then 1 else 0 end as other from {{part}}) as x""",
    "po_get_package_price": f"""
select case when p_partkey % 13 = 11 then 168 when p_partkey % 13 = 12 then 190 else p_partkey % 13 end
    as ProductCode,
  {_key('', '3 * (p_partkey % 5)')} || ',' || cast(3 * (p_size % 5) + 1 as string) || ',' ||
    case when p_type = 'PROMO' then '17' else cast(3 * ({_BRAND} % 5) + 2 as string) end
    as PackagePriceServices,
  p_retailprice as TotalCost, cast(p_size as double) as DiscountValue,
  cast(date '1998-01-01' + cast(p_partkey * 3 % 100 as int) as timestamp) as LastModifiedDate
from {{part}}""",
    "dim_product": """
select distinct case when p_partkey % 13 = 11 then 168 when p_partkey % 13 = 12 then 190
    else p_partkey % 13 end as src_product_code,
  case p_partkey % 13 when 0 then 'Product Broadband' when 1 then 'Monthly Basic' when 2 then 'PAYGProduct'
    when 3 then 'Tourist Visitor' when 4 then 'Product B v2' when 5 then 'Plan 6 Months'
    when 6 then 'Plan_6Months' when 7 then 'Plan 12Months' when 8 then 'Plan 24Month'
    when 9 then 'Product_Staff' when 10 then 'Staff 12 Months' when 11 then null
    else 'Product Broadband - 12Months' end as business_product_name
from {part}""",
    "event_in_booster": f"""
select cast(l_shipdate as date) as EVENT_IN_DATE, {_key('', 'o_custkey')} as EVENT_IN_ACCOUNT_NUMBER,
  {_key('', f'100 + {_BRAND}')} as EVENT_IN_EVENT_ID,
  case p_type when 'STANDARD' then 'Booster' when 'MEDIUM' then 'Booster' when 'LARGE' then 'Roaming'
    else 'Other' end as EVENT_IN_EVENT_GROUP,
  case l_returnflag when 'A' then 'DATA' when 'N' then 'VOICE_LCL' else 'VOICE_INT' end
    as EVENT_IN_SERVICE_TYPE,
  case when l_quantity < 25 then cast(0.5 as double) else cast(2 as double) end as EVENT_IN_TOTAL_QUANTITY
from {_LINE_OF_ACCOUNT} join {{part}} on l_partkey = p_partkey""",
    "nobill_fact_account_counter": f"""
select l_orderkey as facc_counterid,
  case when l_returnflag = 'A' then null else cast(1000 + floor(o_custkey / 25) as bigint) end
    as facc_account_number,
  case l_linenumber % 3 when 0 then 220 when 1 then 271 else 300 end as facc_counter_type_id,
  cast(l_shipdate as date) as facc_date, l_shipdate as facc_time_stamp,
  l_linenumber as facc_updatetype, l_quantity * 20 as facc_postvalue
from {_LINE_OF_ACCOUNT}""",
    "nobill_snapshot_daily_balance": """
select o_orderkey as counter_id, cast(1000 + floor(o_custkey / 25) as bigint) as account_num,
  case substr(o_orderpriority, 1, 1) when '1' then 'AC.AnnualPlanFunds_Counter'
    when '2' then 'AC.AnnualPlanPromotions_Ctr' else 'AC.Other' end as countername,
  cast(o_orderdate as date) as snapshotdate,
  case when o_orderstatus = 'P' then 0.0 else o_totalprice end as balance
from {orders}""",
    "payment_paymenttransactions": f"""
select o_orderkey as ID, case o_orderstatus when 'F' then 1 when 'O' then 2 else 3 end as StatusID,
  cast(substr(o_orderpriority, 1, 1) as int) as PaymentChannelID,
  case when o_orderkey % 19 = 18 then null else o_orderkey % 5 end as ErrorID,
  o_orderkey % 30 as PaymentMethodID, {_key('U', 'o_custkey')} as Uid, o_totalprice as Amount,
  o_orderdate as CreationDate
from {{orders}}""",
    "payment_paymentstatus": """
select distinct case o_orderstatus when 'F' then 1 when 'O' then 2 else 3 end as ID,
  case o_orderstatus when 'F' then 'PaymentConfirmed' when 'O' then 'PaymentDeclined'
    else 'PaymentRefunded' end as Status
from {orders}""",
    "payment_paymentchannel": """
select distinct cast(substr(o_orderpriority, 1, 1) as int) as ID,
  case substr(o_orderpriority, 1, 1) when '1' then 'Spotii' when '2' then 'ApplePayCyberSource'
    when '3' then 'Voucher' when '4' then 'CreditCardCyberSource' else 'BankX' end as ChannelName
from {orders}""",
    "payment_paymentdetails": "select l_orderkey as PaymentTransactionID, l_linenumber as ServiceTypeID from {lineitem}",
    "payment_servicetypes": "select distinct l_linenumber as ID from {lineitem} where l_linenumber < 7",
    "ref_payment_error": "select r_regionkey as payment_error_id from {region}",
    "ref_payment_method": "select n_nationkey as payment_method_id from {nation}",
    "nobill_fact_adjustment": f"""
select o_custkey as fad_accountnum, o_orderdate as fad_time_stamp, o_totalprice as fad_amount,
  cast(substr(o_orderpriority, 1, 1) as int) as fad_adjustment_type_id,
  {_key('', 'o_orderkey')} as fad_vouchernum
from {{orders}}""",
    "nobill_dim_adjustment_type": """
select distinct cast(substr(o_orderpriority, 1, 1) as int) as dad_adjustment_type_id,
  case when substr(o_orderpriority, 1, 1) in ('1', '2') then 'voucher' else 'bonus' end
    as dad_adjustmenttypename
from {orders}""",
    "nobill_aggr_ws_cost_v3": f"""
select cast(l_shipdate as date) as ad_date,
  case when l_linenumber = 6 and l_returnflag = 'R' then null else o_custkey end as ad_accountnum,
  101 + l_partkey % 25 as ad_eventid, l_linenumber as ad_counter_type_id, l_suppkey as ad_transaction_id,
  l_partkey % 12 as ad_terminationreason, l_extendedprice as ad_total_revenue_net,
  l_extendedprice as ad_total_revenue_received, l_quantity as ad_total_tax_amount,
  l_quantity + 3 as ad_total_revenue_received_expired_bundle,
  cast(l_linenumber as double) as ad_total_tax_amount_expired_bundle,
  l_quantity + 5 as ad_total_revenue_received_transfer_bundle,
  cast(l_linenumber as double) as ad_total_tax_amount_transfer_bundle,
  cast(l_quantity as bigint) * 61000 as ad_total_duration,
  cast(l_quantity as bigint) * 11000 as ad_total_duration_payg,
  cast(l_quantity as bigint) * 7000 + l_partkey as ad_total_duration_counter,
  cast(floor(l_extendedprice) as bigint) * 600000 as ad_total_data_volume,
  cast(floor(l_extendedprice) as bigint) * 1000 as ad_total_data_volume_counter,
  cast(floor(l_extendedprice) as bigint) * 500 as ad_total_data_volume_payg,
  cast(floor(l_extendedprice) as bigint) * 30 as ad_total_counter_data_volume_transfer,
  cast(l_quantity as bigint) as ad_total_sms, l_extendedprice as ad_total_adjustment_amount
from {_LINE_OF_ACCOUNT}""",
    "nobill_dim_transaction_key": """
select s_suppkey as transaction_id,
  case s_suppkey % 5 when 0 then 'Voice' when 1 then 'Data' when 2 then 'SMS' when 3 then 'Recharge'
    else 'Voice' end as service_group,
  case when s_nationkey % 2 = 0 then 'MOC' else 'MTC' end as service_type,
  case s_nationkey % 3 when 0 then 'National' when 1 then 'International' else 'Roaming' end
    as traffic_national_international
from {supplier}""",
    "nobill_dim_counter_type": """
select distinct l_linenumber as dcr_counter_type_id,
  case when l_linenumber % 2 = 0 then 'Voice Bundle' else 'Data Bundle' end as dcr_category_2,
  case l_linenumber when 1 then '0' when 2 then '1' when 3 then '0' when 4 then '2' when 5 then null
    when 6 then '1' else 'x' end as dcr_category_8,
  case when l_linenumber = 2 then 'AC.Sender_DataCounter' else 'AC.Other' end as dcr_counter_type_name
from {lineitem}""",
    "nobill_dim_test_accounts": f"""
select case when c_custkey % 50 = 49 then '' else {_key('', 'c_custkey')} end as accountnum,
  case when c_mktsegment = 'BUILDING' then 'INCLUDE' else 'EXCLUDE' end as exclusion_flag
from {{customer}}""",
    "nobill_fact_usage": f"""
select o_custkey as fus_accountnum, case when l_linestatus = 'O' then 1 else 2 end as fus_call_direction_id,
  case when l_returnflag = 'A' then 2 else 1 end as fus_service_type_id, l_shipdate as fus_time_stamp,
  l_suppkey % 30 as fus_termzone_id, l_partkey % 25 as fus_origzone_id,
  l_linenumber as fus_terminationreason
from {_LINE_OF_ACCOUNT}""",
    "nobill_dim_termzone": "select n_nationkey as dtz_termzone_id from {nation}",
    "nobill_dim_origzone": "select n_nationkey as doz_origzone_id from {nation}",
    "nobill_ref_terminationreason": """
select p_size % 6 + 1 as fus_terminationreason, case when p_type = 'STANDARD' then 1 else 2 end
    as fus_service_type_id
from (select distinct p_size, p_type from {part}) as x""",
}

# The usage family reads other event categories than the plan family.
USAGE_BINDINGS = {
    **ORDERS_BINDINGS,
    "nobill_dim_event": f"""
select p_partkey as dev_event_id, 100 + {_BRAND} as dev_eventid_base, p_type as dev_category_1,
  p_type as dev_category_2,
  case {_BRAND} % 8 when 0 then 'Voice Plan Intl' when 1 then 'Voice Intl Booster' when 2 then 'Voice Plan Natl'
    when 3 then 'Voice Natl Booster' when 4 then 'Roaming Voice Bundle' when 5 then 'Data Plan'
    when 6 then 'Data Booster' else 'Roaming Data Bundle' end as dev_category_3,
  p_brand as dev_category_4, p_brand as dev_category_6,
  case when {_BRAND} % 4 = 0 then 'Booster_IntlMin_Unlimited' else 'Other' end as dev_event_name,
  p_name as dev_event_desc
from {{part}}""",
}


class BoundTables(Tables):
    """Table resolver over the driver's parquet files; a session opens every file once, as a view."""

    def __init__(self, spark: SparkSession, sf_dir: str, bindings: dict[str, str]):
        super().__init__()
        self._spark, self._bindings = spark, bindings
        self._root = sf_dir.rstrip("/")

    def _view(self, table: str) -> str:
        path = f"{self._root}/{table}.parquet"
        view = f"driver_{table}_{zlib.crc32(path.encode()):08x}"
        if not self._spark.catalog.tableExists(view):
            self._spark.read.parquet(path).createOrReplaceTempView(view)
        return view

    def load(self, name: str) -> DataFrame:
        sql = self._bindings[name]
        used = {t: self._view(t) for t in DRIVER_TABLES if f"{{{t}}}" in sql}
        return self._spark.sql(sql.format(**used).replace('"', "`"))


def events_tables(spark: SparkSession, sf_dir: str) -> BoundTables:
    return BoundTables(spark, sf_dir, EVENTS_BINDINGS)


def orders_tables(spark: SparkSession, sf_dir: str) -> BoundTables:
    return BoundTables(spark, sf_dir, ORDERS_BINDINGS)


def usage_tables(spark: SparkSession, sf_dir: str) -> BoundTables:
    return BoundTables(spark, sf_dir, USAGE_BINDINGS)


# The oracle's own list of dated tables: rows from L on are not known yet, those of L itself are where
# the third field says so.
_DATED = """
nobill_snapshot_subscription snapshotdate
nobill_tx_account_history tstamp
nobill_tx_phonenumber_history tstamp
usabilla_data _date
vmwsc_registration DateTime
cas_tx_activations ActivationDate
customerdb_customers RegistrationDate
cas_id_verification_request CreationDate
po_sre_actionhistory DateTime
po_sre_paymenthistory DateTime
event_in_booster EVENT_IN_DATE
nobill_fact_account_counter facc_date
nobill_snapshot_daily_balance snapshotdate
payment_paymenttransactions CreationDate
nobill_fact_adjustment fad_time_stamp
roaming_ussd_received_data DATETIME
loy_customer_cashback CREATE_DATE
ne_scusertaghistory DateTime
nobill_aggr_ws_cost_v3 ad_date with_L
nobill_fact_usage fus_time_stamp with_L
loy_customer_trx_log CREATE_DATE with_L
"""
_CUTS = {line.split()[0]: line.split()[1:] for line in _DATED.strip().splitlines()}


def _known_at(name: str, select: str, day: date) -> str:
    if name not in _CUTS:
        return select
    column, *with_day = _CUTS[name]
    first_unknown = day + timedelta(days=1) if with_day else day
    return f"select * from ({select}) as every_row where coalesce(cast({column} as timestamp) < timestamp '{first_unknown}', true)"


def oracle_with(bindings: dict[str, str], names: str, body: str) -> str:
    """Put the bindings of ``names``, as known at the load date, in front of an oracle query."""
    plain = {t: t for t in DRIVER_TABLES}
    day = EVENTS_L if bindings is EVENTS_BINDINGS else ORDERS_L
    views = [f"{name} as ({_known_at(name, bindings[name].format(**plain), day)})" for name in names.split()]
    body = body.strip()
    joint = "\n" if body.startswith("select") else ",\n"
    return "with " + ",\n".join(views) + joint + body
