"""Declared input types, one DDL string per table, limited to the columns the pipelines read.

Money is decimal, so that sums do not depend on row order. Timestamps carry no time zone, as in
the source systems. Column names are those of the source systems.
"""

# When a row of a history became known. Pipelines read a history as it stood at the load date L: rows
# dated before L, or up to the end of L where the family's windows are closed. Undated rows stay.
HISTORIES = {
    "nobill_snapshot_subscription": ("snapshotdate", False),
    "nobill_tx_account_history": ("tstamp", False),
    "nobill_tx_phonenumber_history": ("tstamp", False),
    "usabilla_data": ("_date", False),
    "vmwsc_registration": ("DateTime", False),
    "cas_tx_activations": ("ActivationDate", False),
    "customerdb_customers": ("RegistrationDate", False),
    "cas_id_verification_request": ("CreationDate", False),
    "po_sre_actionhistory": ("DateTime", False),
    "po_sre_paymenthistory": ("DateTime", False),
    "event_in_booster": ("EVENT_IN_DATE", False),
    "nobill_fact_account_counter": ("facc_date", False),
    "nobill_snapshot_daily_balance": ("snapshotdate", False),
    "payment_paymenttransactions": ("CreationDate", False),
    "nobill_fact_adjustment": ("fad_time_stamp", False),
    "roaming_ussd_received_data": ("DATETIME", False),
    "loy_customer_cashback": ("CREATE_DATE", False),
    "ne_scusertaghistory": ("DateTime", False),
    "nobill_aggr_ws_cost_v3": ("ad_date", True),
    "nobill_fact_usage": ("fus_time_stamp", True),
    "loy_customer_trx_log": ("CREATE_DATE", True),
}

SCHEMAS = {
    # Subscriber snapshots and histories.
    "nobill_snapshot_subscription": (
        "accountnum bigint, phonenumber string, status int, blocked int, snapshotdate date, "
        "subscriptiontype string"
    ),
    "nobill_tx_account_history": (
        "accountnum bigint, additionalinfo string, historytypekey string, "
        "localtstamp timestamp_ntz, tstamp timestamp_ntz"
    ),
    "nobill_tx_phonenumber_history": (
        "accountnum bigint, historytypekey string, additionalinfo string, tstamp timestamp_ntz"
    ),
    # Customer master, registration and survey.
    "customer_master": (
        "IN_ACCOUNT_NUMBER string, CRM_UID string, REGISTRATION_ID string, EMAIL string, "
        "MSISDN string, CUST_NATIONALITY_NAME string, CUST_FIRST_NAME string, CUST_LAST_NAME string, "
        "CUST_LATEST_ID_TYPE string, CUST_LATEST_ID_NUMBER string, CUST_DOB date, "
        "CUST_LAST_PRODUCT_NAME string, FULL_ACTIVATION_DATE timestamp_ntz, "
        "CUST_REGISTRATION_DATE timestamp_ntz, CUST_REGISTRATION_CHANNEL string, "
        "FLAG_POD_POS_COD string, SALES_CHANNEL string, CUST_DAYS_SINCE_LAST_ACTIVITY string, "
        "LATEST_LINE_STATUS string"
    ),
    "vmwsc_registration": (
        "ID string, Email string, DateTime timestamp_ntz, CustomerID string, AccountNumber string, "
        "IsEmailVerified boolean, ChannelID int"
    ),
    "usabilla_data": "score int, extra_info string, _date string, campaign_id string",
    "usabilla_campaigns": "campaign_id string",
    "cas_tx_activations": (
        "CRMAccountNo string, NobillAccountNo string, NobillCustomerID string, "
        "ActivationDate timestamp_ntz"
    ),
    # Identity documents.
    "customerdb_customers": (
        "Id bigint, Contactid string, IsDiplomat int, NobillContactId string, IdType string, "
        "ExpiryDate timestamp_ntz, RegistrationDate timestamp_ntz, VerificationDate timestamp_ntz, "
        "CreatedOn timestamp_ntz, VerificationStatus string, ExtensionReason string, "
        "ExtendedExpiryDate timestamp_ntz, DiplomaticId string, Nationality string"
    ),
    "customer_db_documents": "CustomerId bigint, id bigint, StatusCode int, DocType string",
    "wsc_countries_lookup": "alpha_3 string, name string",
    "cas_id_verification_request": (
        "ID bigint, CreationDate timestamp_ntz, CustomerID string, IDExpiryDate timestamp_ntz, "
        "IDIssueDate timestamp_ntz, IDNumber string, NationalityCode string, IDTypeId int, "
        "ProcessID int, VerificationStatusID int"
    ),
    "cas_process": "ID int, NAME string",
    "cas_id_verification_status": "ID int, Name string",
    # Plan and service platform.
    "po_sre_actionhistory": (
        "Id bigint, ActionId int, DateTime timestamp_ntz, CustomerId bigint, ServiceIds string, "
        "SubscriptionId bigint, LastUpdateDate timestamp_ntz, ProductCode int, StatusId int"
    ),
    "po_sre_action": "ID int, Name string",
    "po_sre_customer": (
        "Id bigint, NobillAccountNo string, MSISDN string, SubscribeDate timestamp_ntz, "
        "LastUpdateDate timestamp_ntz, RenewalDay int"
    ),
    "po_sre_subscription": (
        "Id bigint, CustomerId bigint, StatusId int, StartDate timestamp_ntz, EndDate timestamp_ntz"
    ),
    "po_sre_paymenthistory": (
        "ActionHistoryId bigint, PaymentMethodId int, PaidAmount decimal(28,10), IsSuccess boolean, "
        "DateTime timestamp_ntz"
    ),
    "po_sre_shareplanhistory": (
        "Id bigint, ActionHistoryId bigint, ServiceId int, SubscriptionId bigint, "
        "CounterValue bigint, IsSuccess int"
    ),
    "po_po_service": (
        "Id bigint, Name string, ServiceChargingTypeId int, ServiceTypeId int, "
        "ServiceCategoryId int, ServiceCost decimal(28,10), StatusId int, CreationDate timestamp_ntz"
    ),
    "po_po_servicecategory": "Id int, Name string",
    "po_po_servicetype": "Id int, Name string",
    "po_po_servicechargingtype": "Id int, Name string",
    "po_po_bundle": "ServiceId bigint, EventId int, CounterId int, CustomerServiceName string",
    "po_service_file": (
        "EXCEL_SERVICE_EVENT_ID string, EXCEL_SERVICE_TYPE string, EXCEL_SERVICE_CATEGORY string, "
        "EXCEL_SERVICE_DESCRIPTION string"
    ),
    "po_get_package_price": (
        "ProductCode int, PackagePriceServices string, TotalCost decimal(28,10), "
        "DiscountValue decimal(28,10), LastModifiedDate timestamp_ntz"
    ),
    "dim_product": "src_product_code int, business_product_name string",
    "nobill_dim_event": (
        "dev_event_id bigint, dev_eventid_base int, dev_category_1 string, dev_category_2 string, "
        "dev_category_3 string, dev_category_4 string, dev_category_6 string, "
        "dev_event_name string, dev_event_desc string"
    ),
    "event_in_booster": (
        "EVENT_IN_DATE date, EVENT_IN_ACCOUNT_NUMBER string, EVENT_IN_EVENT_ID string, "
        "EVENT_IN_EVENT_GROUP string, EVENT_IN_SERVICE_TYPE string, EVENT_IN_TOTAL_QUANTITY decimal(28,10)"
    ),
    "nobill_fact_account_counter": (
        "facc_counterid bigint, facc_account_number bigint, facc_counter_type_id int, facc_date date, "
        "facc_time_stamp timestamp_ntz, facc_updatetype int, facc_postvalue decimal(28,10)"
    ),
    "nobill_snapshot_daily_balance": (
        "counter_id bigint, account_num bigint, countername string, snapshotdate date, "
        "balance decimal(28,10)"
    ),
    # Payments, vouchers.
    "payment_paymenttransactions": (
        "ID bigint, StatusID int, PaymentChannelID int, ErrorID int, PaymentMethodID int, Uid string, "
        "Amount decimal(28,10), CreationDate timestamp_ntz"
    ),
    "payment_paymentstatus": "ID int, Status string",
    "payment_paymentchannel": "ID int, ChannelName string",
    "payment_paymentdetails": "PaymentTransactionID bigint, ServiceTypeID int",
    "payment_servicetypes": "ID int",
    "ref_payment_error": "payment_error_id int",
    "ref_payment_method": "payment_method_id int",
    "nobill_fact_adjustment": (
        "fad_accountnum bigint, fad_time_stamp timestamp_ntz, fad_amount decimal(28,10), "
        "fad_adjustment_type_id int, fad_vouchernum string"
    ),
    "nobill_dim_adjustment_type": "dad_adjustment_type_id int, dad_adjustmenttypename string",
    # Usage.
    "nobill_aggr_ws_cost_v3": (
        "ad_date date, ad_accountnum bigint, ad_eventid int, ad_counter_type_id int, "
        "ad_transaction_id int, ad_terminationreason int, ad_total_revenue_net decimal(28,10), "
        "ad_total_revenue_received decimal(28,10), ad_total_tax_amount decimal(28,10), "
        "ad_total_revenue_received_expired_bundle decimal(28,10), "
        "ad_total_tax_amount_expired_bundle decimal(28,10), "
        "ad_total_revenue_received_transfer_bundle decimal(28,10), "
        "ad_total_tax_amount_transfer_bundle decimal(28,10), ad_total_duration bigint, "
        "ad_total_duration_payg bigint, ad_total_duration_counter bigint, "
        "ad_total_data_volume bigint, ad_total_data_volume_counter bigint, "
        "ad_total_data_volume_payg bigint, ad_total_counter_data_volume_transfer bigint, "
        "ad_total_sms bigint, ad_total_adjustment_amount decimal(28,10)"
    ),
    "nobill_dim_transaction_key": (
        "transaction_id int, service_group string, service_type string, "
        "traffic_national_international string"
    ),
    "nobill_dim_counter_type": (
        "dcr_counter_type_id int, dcr_category_2 string, dcr_category_8 string, "
        "dcr_counter_type_name string"
    ),
    "nobill_dim_test_accounts": "accountnum string, exclusion_flag string",
    "nobill_fact_usage": (
        "fus_accountnum bigint, fus_call_direction_id int, fus_service_type_id int, "
        "fus_time_stamp timestamp_ntz, fus_termzone_id int, fus_origzone_id int, "
        "fus_terminationreason int"
    ),
    "nobill_dim_termzone": "dtz_termzone_id int",
    "nobill_dim_origzone": "doz_origzone_id int",
    "nobill_ref_terminationreason": "fus_terminationreason int, fus_service_type_id int",
    # Roaming, loyalty, notifications.
    "roaming_ussd_received_data": "ID bigint, MSISDN string, MCC string, DATETIME timestamp_ntz",
    "dim_roam_country_operator": "MCC string, country string",
    "loy_customer_trx_log": "customer_id bigint, points decimal(28,10), CREATE_DATE timestamp_ntz",
    "loy_dim_customer": "ID bigint, identifier_value string",
    "loy_customer_cashback": "id bigint, customer_id bigint, tier_id int, CREATE_DATE timestamp_ntz",
    "loy_tier": "ID int, name_en string",
    "ne_scusertaghistory": "ID bigint, SCUserPerID bigint, TagID int, DateTime timestamp_ntz",
    "ne_scuserschannelspermission": "ID bigint, MSISDN string",
    # Model scores.
    "churn_monthly_payg_results": (
        "in_account_number string, snapshot_date date, churn_probability double, decile int"
    ),
    "happiness_index_results": "in_account_number string, snapshot_date date, chi_score double, decile int",
    "home_internet_affinity_results": (
        "in_account_number string, snapshot_date date, MBB_affinity_probability double, decile int"
    ),
    "renewal_results": (
        "in_account_number string, snapshot_date date, non_renewal_probability double, decile int"
    ),
    "migration_propensity_results": "in_account_number string, date_cvm date, propensity_to_buy double",
    "payg_recommendation_results": (
        "in_account_number string, snapshot_date date, class string, proba double"
    ),
    "cr_product_recommendation_results": (
        "in_account_number string, date_dt date, predicted_data double, predicted_natl double, "
        "predicted_intl double, data_booster_recommended string, natl_booster_recommended string, "
        "intl_booster_recommended string, data_booster_recommended_price double, "
        "natl_booster_recommended_price double, intl_booster_recommended_price double"
    ),
    "cr_optimum_plan_recommendation_results": (
        "in_account_number string, date_dt date, right_size_plan_name string, "
        "current_plan_net_cost double, right_size_plan_net_cost double, "
        "`60day_avg_money_spent` double, right_size_plan_price_change double"
    ),
    "cr_upselling_plan_recommendation_results": (
        "in_account_number string, date_dt date, step_up_plan_name string, "
        "current_plan_net_cost double, step_up_plan_data_change double, "
        "step_up_plan_intl_min_change double, step_up_plan_price double, "
        "step_up_plan_price_change double, `60day_avg_money_spent` double, "
        "step_up_plan_national_min_change double, step_up_spent_change double"
    ),
}
