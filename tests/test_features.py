"""Validity, boosters, services, plans, payments, usage and engagement on hand-made rows."""

from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest

from fixtures import HandMade
from sublens.plans import booster, engagement, payments, plan, scores, services, usage, validity

L = date(2023, 6, 15)


def back(days):
    return L - timedelta(days=days)


def at(days, hour=0):
    return datetime.combine(back(days), datetime.min.time()) + timedelta(hours=hour)


def record(i, **columns):
    base = {
        "Id": i, "Contactid": f"c{i}", "NobillContactId": f"n{i}", "VerificationStatus": "ok",
        "CreatedOn": datetime(2022, 6, 1), "ExpiryDate": datetime(2030, 1, 1),
    }
    return {**base, **columns}


def test_registration_validity_rules(spark, rows):
    reported = datetime(2022, 6, 1, 5)
    records = [
        record(1, IdType="emiratesid"),
        record(2, IdType="gccid", VerificationDate=reported),
        record(3, IdType="gccid", VerificationDate=datetime(2020, 3, 17)),
        record(4, IdType="passport", VerificationDate=reported),
        record(5, IdType="passport", VerificationDate=reported),
        record(6, IdType="passport", CreatedOn=None),
        record(7, IdType="passport", VerificationDate=reported, ExpiryDate=datetime(2022, 6, 10)),
        record(8, IdType="passport", IsDiplomat=1, DiplomaticId="d", ExtendedExpiryDate=datetime(2024, 1, 1)),
        record(9, IdType="emiratesid", ExtendedExpiryDate=datetime(2024, 1, 1)),
        record(10, IdType="emiratesid", ExtendedExpiryDate=datetime(2024, 1, 1), ExtensionReason="Travel"),
        record(11, IdType="emiratesid", ExtendedExpiryDate=datetime(2024, 1, 1), ExtensionReason="TDRABacklogClearance"),
        record(12, IdType="other"),
        record(13, IdType="other", Nationality="ARE"),
        record(14, IdType="emiratesid", VerificationStatus=None),
    ]
    tables = HandMade(
        spark,
        customerdb_customers=records,
        cas_tx_activations=[
            {"NobillAccountNo": str(r["Id"]), "NobillCustomerID": r["NobillContactId"], "ActivationDate": at(9)}
            for r in records
        ],
        customer_db_documents=[
            {"CustomerId": 5, "id": 1, "StatusCode": 1, "DocType": "entrystamppageofthepassport"},
            {"CustomerId": 4, "id": 2, "StatusCode": 0, "DocType": "entrystamppageofthepassport"},
        ],
        wsc_countries_lookup=[{"alpha_3": "ARE", "name": "United Arab Emirates"}, {"alpha_3": "ARE", "name": "A"}],
    )
    validity_of = {int(a): d for a, d in rows(validity.registration_validity(tables, L))}
    assert validity_of == {
        1: date(2030, 1, 1),
        2: date(2022, 8, 30),
        3: date(2030, 1, 1),
        4: date(2022, 7, 1),
        5: date(2022, 8, 30),
        6: None,
        7: date(2022, 6, 10),
        8: date(2024, 1, 1),
        9: date(2030, 1, 1),
        10: date(2024, 1, 1),
        11: date(2030, 1, 1),
        12: None,
        13: date(2030, 1, 1),
    }


def test_booster_window_edges(spark):
    def event(days, quantity=1, kind="DATA", group="Booster", account="a"):
        return {
            "EVENT_IN_DATE": back(days), "EVENT_IN_ACCOUNT_NUMBER": account, "EVENT_IN_EVENT_ID": "e",
            "EVENT_IN_EVENT_GROUP": group, "EVENT_IN_SERVICE_TYPE": kind, "EVENT_IN_TOTAL_QUANTITY": quantity,
        }

    days = [0, 1, 7, 8, 30, 31, 60, 61, 90, 91, 92, 93]
    tables = HandMade(
        spark,
        event_in_booster=[
            *[event(d) for d in days],
            event(500, account="old"),
            event(5, group="Roaming", account="roamer"),
            event(5, group="Other", account="nobody"),
        ],
        po_service_file=[{"EXCEL_SERVICE_EVENT_ID": "e", "EXCEL_SERVICE_TYPE": "DATA"}],
    )
    found = {r["IN_ACCOUNT_NUMBER"]: r for r in booster.booster_purchases(tables, L).collect()}
    assert sorted(found) == ["a", "old", "roamer"]
    a = found["a"]
    prefix = "BOOSTER_TOTAL_DATA_COUNT_"
    windows = {w: a[prefix + w] for w in ("LAST_7DAYS", "LAST_30DAYS", "LAST_31_60DAYS", "LAST_61_90DAYS")}
    assert windows == {"LAST_7DAYS": 2, "LAST_30DAYS": 4, "LAST_31_60DAYS": 2, "LAST_61_90DAYS": 2}
    assert a["BOOSTER_PURCHASE_PROFILE_DATA"] == "Frequent"
    assert a["BOOSTER_PURCHASE_PROFILE_NATL"] == "Never"
    assert found["old"][prefix + "LAST_30DAYS"] is None
    assert found["old"]["BOOSTER_PURCHASE_PROFILE_DATA"] == "One Time"
    assert found["roamer"][prefix + "LAST_30DAYS"] == 0
    assert booster.booster_purchases(tables, L).columns == booster.BOOSTER_COLUMNS


def test_repeated_service_file_rows_count_again_in_windows_only(spark):
    tables = HandMade(
        spark,
        event_in_booster=[
            {"EVENT_IN_DATE": back(3), "EVENT_IN_ACCOUNT_NUMBER": "a", "EVENT_IN_EVENT_ID": "e",
             "EVENT_IN_EVENT_GROUP": "Booster", "EVENT_IN_SERVICE_TYPE": "DATA", "EVENT_IN_TOTAL_QUANTITY": 2}
        ],
        po_service_file=[{"EXCEL_SERVICE_EVENT_ID": "e", "EXCEL_SERVICE_TYPE": "DATA"}] * 2,
    )
    counts = booster.booster_counts(tables, L).first()
    assert (counts["TOTAL_DATA_BOOSTER_QTY"], counts["BOOSTER_TOTAL_DATA_COUNT_LAST_7DAYS"]) == (2, 4)


SERVICE_TABLES = {
    "po_po_service": [{"Id": i} for i in (10, 11, 12, 13)],
    "po_po_bundle": [{"ServiceId": i, "EventId": 100 + i} for i in (10, 11, 12)] + [{"ServiceId": 13, "EventId": 109}],
    "nobill_dim_event": [
        {"dev_event_id": 1, "dev_eventid_base": 110, "dev_category_1": "VAS", "dev_category_3": "Natl Vas", "dev_category_6": "natl one"},
        {"dev_event_id": 2, "dev_eventid_base": 111, "dev_category_3": "Data booster", "dev_category_6": "data one"},
        {"dev_event_id": 3, "dev_eventid_base": 112, "dev_category_3": "Intl Plan", "dev_category_6": "intl one"},
        {"dev_event_id": 4, "dev_eventid_base": 109, "dev_category_3": "Roaming", "dev_category_6": "roam"},
        {"dev_event_id": 9, "dev_eventid_base": 110, "dev_category_1": "late", "dev_category_3": "late"},
    ],
}


def test_event_action_history_filters_and_amounts(spark, rows):
    def action(i, services, days=10, **columns):
        base = {"Id": i, "ActionId": 1, "DateTime": at(days), "CustomerId": 1, "ServiceIds": services,
                "SubscriptionId": i, "StatusId": 2}
        return {**base, **columns}

    tables = HandMade(
        spark,
        **SERVICE_TABLES,
        po_sre_actionhistory=[
            action(1, "10", 40),
            action(2, "10", 20),
            action(3, "11,99", 5),
            action(4, "10,11,12", 1),
            action(5, "10", 1, StatusId=1),
            action(6, "10", 1, ActionId=30),
            action(7, "13", 1),
            action(8, "10", 0),
            action(9, "10", 3, CustomerId=2),
            action(10, "10", 3, CustomerId=3),
            action(11, "", 3),
            action(12, None, 3),
        ],
        po_sre_customer=[
            {"Id": 1, "NobillAccountNo": "501"}, {"Id": 2, "NobillAccountNo": "x_1"}, {"Id": 3, "NobillAccountNo": "7"},
        ],
        po_service_file=[
            {"EXCEL_SERVICE_EVENT_ID": "110", "EXCEL_SERVICE_TYPE": "VOIP", "EXCEL_SERVICE_CATEGORY": "VAS"},
            {"EXCEL_SERVICE_EVENT_ID": "111", "EXCEL_SERVICE_TYPE": "DATA", "EXCEL_SERVICE_CATEGORY": "Booster",
             "EXCEL_SERVICE_DESCRIPTION": "1 GB"},
        ],
        po_sre_subscription=[
            {"Id": 2, "StartDate": at(20), "EndDate": at(-10)}, {"Id": 3, "StartDate": at(5), "EndDate": at(2)},
        ],
        po_sre_paymenthistory=[
            {"ActionHistoryId": 2, "PaidAmount": Decimal("5.50"), "IsSuccess": True, "DateTime": at(20)},
            {"ActionHistoryId": 2, "PaidAmount": Decimal("4.50"), "IsSuccess": True, "DateTime": at(19)},
            {"ActionHistoryId": 2, "PaidAmount": Decimal("9.00"), "IsSuccess": False, "DateTime": at(19)},
            {"ActionHistoryId": 1, "PaidAmount": Decimal("7.00"), "IsSuccess": True, "DateTime": at(40)},
        ],
    )
    history = services.event_action_history(tables, L)
    assert history.columns == services.EVENT_ACTION_COLUMNS
    (account,) = history.collect()
    assert account["IN_ACCOUNT_NUMBER"] == "501"
    assert (account["VOIP_SERVICE"], account["VOIP_RENEWAL_DATE"]) == (1, back(-10))
    assert (account["VAS_TOTAL_AMOUNT"], account["VAS_RENEWAL_DATE"]) == (10.0, back(-10))
    assert (account["BOOSTER_LAST_DATA"], account["BOOSTER_LAST_DATE_DATA"]) == ("1 GB", back(5))
    assert (account["DAYS_SINCE_BOOSTER_EXPIRY"], account["DAYS_TILL_BOOSTER_EXPIRY"]) == (2, -2)
    assert (account["NETFLIX_SERVICE_FLAG"], account["LAST_DATA_ROAMING_PASS"]) == (0, None)


def plan_tables(spark, **more):
    return HandMade(
        spark,
        **SERVICE_TABLES,
        dim_product=[
            {"src_product_code": 1, "business_product_name": "Monthly"},
            {"src_product_code": 2, "business_product_name": "PAYGProduct"},
            {"src_product_code": 7, "business_product_name": "Plan 12 Months"},
        ],
        po_sre_customer=[
            {"Id": 1, "NobillAccountNo": "501", "RenewalDay": 3, "LastUpdateDate": at(9)},
            {"Id": 2, "NobillAccountNo": "501", "RenewalDay": None, "LastUpdateDate": at(1)},
            {"Id": 3, "NobillAccountNo": "abc"},
            {"Id": 4, "NobillAccountNo": "502"},
        ],
        **more,
    )


def plan_action(i, days, product=1, services="10,11,12", customer=1):
    return {
        "Id": i, "ActionId": 1, "DateTime": at(days, 8), "CustomerId": customer, "ServiceIds": services,
        "SubscriptionId": i, "ProductCode": product, "StatusId": 2,
    }


def test_plan_report(spark):
    actions = [
        plan_action(1, 75, product=2),
        plan_action(2, 45),
        plan_action(3, 20, product=7),
        plan_action(4, 1, product=1, services="12,,11"),
        plan_action(5, 1, product=7, services="10,11"),
        plan_action(6, 3, customer=3),
    ]
    tables = plan_tables(
        spark,
        po_sre_actionhistory=actions,
        po_sre_subscription=[
            {"Id": a["Id"], "CustomerId": 1, "StartDate": a["DateTime"], "EndDate": at(-30)} for a in actions
        ],
        po_get_package_price=[
            {"ProductCode": 7, "PackagePriceServices": "10,11,17", "TotalCost": Decimal("120"),
             "DiscountValue": Decimal("20"), "LastModifiedDate": at(d)}
            for d in (9, 5)
        ],
        nobill_fact_account_counter=[
            {"facc_counterid": 1, "facc_account_number": 501, "facc_counter_type_id": 220, "facc_date": back(2),
             "facc_time_stamp": at(2, h), "facc_updatetype": 1, "facc_postvalue": Decimal(v)}
            for h, v in [(1, "10"), (5, "100")]
        ],
        customer_master=[{"IN_ACCOUNT_NUMBER": "501", "FULL_ACTIVATION_DATE": at(61)}],
    )
    report = {r["IN_ACCOUNT_NUMBER"]: r for r in plan.plan_report(tables, L).collect()}
    assert sorted(report) == ["501", "502"]
    r = report["501"]
    assert (r["LATEST_PLAN_TYPE"], r["PLAN_STATUS"], r["FLAG_PLAN_CHANGE"]) == ("Plan 12 Months", 1, 1)
    assert r["LATEST_PLAN_DESCRIPTION"] == "NATL ONE-NO_INTL-DATA ONE"
    assert (r["LAST_PLAN_TYPE"], r["LAST_RENEWAL_DATE"]) == ("Plan 12 Months", back(-30))
    # Half of 100 per month, 100 on the counter: two more months.
    assert r["ANNUAL_PLANS_RENEWAL_DATE"] == date(2023, 9, 15)
    assert r["PLAN_TYPE_15DAYS_PRIOR"] == "Plan 12 Months"
    assert (r["PLAN_TYPE_30DAYS_PRIOR"], r["PLAN_TYPE_60DAYS_PRIOR"]) == ("Monthly", "PAYGProduct")
    assert (r["TENURE_MONTH"], r["CONSECUTIVE_6MONTHS_ON_MONTHLY"]) == (3, 0)
    assert report["502"]["PLAN_STATUS"] is None and report["502"]["TENURE_MONTH"] is None


@pytest.mark.parametrize("months, streak", [(5, 0), (6, 1), (7, 1)])
def test_six_distinct_months_within_a_window_that_touches_seven(spark, months, streak):
    days = [date(2022, 12, 20), *(date(2023, m, 10) for m in range(1, 7))][:months]
    actions = [plan_action(n, (L - d).days) for n, d in enumerate(days, start=1)]
    tables = plan_tables(
        spark,
        po_sre_actionhistory=actions + [plan_action(90, (L - date(2022, 12, 14)).days)],
        po_sre_paymenthistory=[
            {"ActionHistoryId": 1, "PaidAmount": Decimal("3"), "IsSuccess": True, "DateTime": at(100)}
        ],
    )
    (account,) = plan.account_plans(tables, L).collect()
    assert account["CONSECUTIVE_6MONTHS_ON_MONTHLY"] == streak
    assert account["CONSECUTIVE_6MONTHS_ON_MONTHLY_AMOUNT_PAID"] == (3.0 if streak else None)


def test_plan_paused(spark, rows):
    tables = plan_tables(
        spark,
        po_sre_action=[{"ID": 50, "Name": "Plan Pause"}, {"ID": 1, "Name": "Buy"}],
        po_sre_actionhistory=[
            {**plan_action(1, 5), "ActionId": 50},
            {**plan_action(2, 5, customer=4), "ActionId": 50},
            plan_action(3, 30, customer=4),
            {**plan_action(4, 40, customer=2), "ActionId": 50},
            {**plan_action(5, 2, customer=77), "ActionId": 50},
        ],
        po_sre_subscription=[{"Id": 3, "EndDate": at(0)}],
    )
    assert rows(plan.plan_paused(tables, L)) == [("501", 1), (None, 1)]


def payment(i, days, **columns):
    base = {"ID": i, "StatusID": 1, "PaymentChannelID": 1, "ErrorID": 0, "PaymentMethodID": 0, "Uid": "u",
            "Amount": Decimal("10"), "CreationDate": at(days, 6)}
    return {**base, **columns}


def test_payments_windows_details_and_dropped_rows(spark):
    listed = [
        payment(1, 2), payment(2, 31), payment(3, 32, StatusID=2), payment(4, 61), payment(5, 91), payment(6, 92),
        payment(7, 0), payment(8, 5, ErrorID=None), payment(9, 5, PaymentChannelID=2), payment(10, 2, StatusID=3),
        payment(11, 2, PaymentChannelID=3, CreationDate=at(2, 7)), payment(12, 200),
    ]
    tables = HandMade(
        spark,
        payment_paymenttransactions=listed,
        payment_paymentstatus=[
            {"ID": 1, "Status": "PaymentConfirmed"}, {"ID": 2, "Status": "Declined"}, {"ID": 3, "Status": "PaymentRefunded"},
        ],
        payment_paymentchannel=[
            {"ID": 1, "ChannelName": "Spotii"}, {"ID": 2, "ChannelName": "Voucher"}, {"ID": 3, "ChannelName": "BankX"},
        ],
        ref_payment_error=[{"payment_error_id": 0}],
        ref_payment_method=[{"payment_method_id": 0}],
        payment_servicetypes=[{"ID": 1}],
        payment_paymentdetails=[
            *[{"PaymentTransactionID": p["ID"], "ServiceTypeID": 1} for p in listed],
            {"PaymentTransactionID": 2, "ServiceTypeID": 1},
            {"PaymentTransactionID": 2, "ServiceTypeID": 9},
        ],
        nobill_snapshot_subscription=[
            {"accountnum": 5, "phonenumber": "n", "snapshotdate": back(d)} for d in (150, 1)
        ],
        customer_master=[
            {"IN_ACCOUNT_NUMBER": "5", "MSISDN": "n", "CRM_UID": "u", "FULL_ACTIVATION_DATE": at(150)},
        ],
    )
    (account,) = payments.payments(tables, L).collect()
    amounts = [account[f"PAYMENT_TOTAL_AMOUNT_last_{w}_days"] for w in ("30", "31_60", "61_90")]
    assert amounts == [40.0, 10.0, 10.0]
    assert [account[f"PAYMENT_COUNT_FAILED_last_{w}_days"] for w in ("30", "31_60", "61_90")] == [0, 1, 0]
    assert (account["PAYMENT_METHOD"], account["load_date"]) == ("BankX", back(1))


def test_vouchers_repeat_per_crm_account_but_not_the_last_one(spark, rows):
    tables = HandMade(
        spark,
        nobill_dim_adjustment_type=[
            {"dad_adjustment_type_id": 1, "dad_adjustmenttypename": "voucher"},
            {"dad_adjustment_type_id": 2, "dad_adjustmenttypename": "bonus"},
        ],
        nobill_fact_adjustment=[
            {"fad_accountnum": a, "fad_time_stamp": at(d), "fad_amount": Decimal(v), "fad_adjustment_type_id": t,
             "fad_vouchernum": str(d)}
            for a, d, v, t in [(1, 31, "5", 1), (1, 32, "7", 1), (1, 3, "9", 2), (1, 0, "9", 1), (2, 180, "4", 1), (3, 181, "4", 1)]
        ],
        cas_tx_activations=[
            {"CRMAccountNo": "A", "NobillAccountNo": "1"}, {"CRMAccountNo": "B", "NobillAccountNo": "1"},
        ],
    )
    assert rows(payments.vouchers(tables, L).drop("load_date")) == [
        (1, 10.0, 2, 31, 5.0),
        (2, 0.0, 0, 180, 4.0),
    ]
    # Both older vouchers of account 1 fall into May (14 and 15), one on each side of the 31 days.
    assert rows(payments.wallet_recharges(tables, L)) == [(1, 0, 2, 1, 1, 0)]


def usage_row(days, account=1, counter=1, volume=2**30, **columns):
    base = {"ad_date": back(days), "ad_accountnum": account, "ad_counter_type_id": counter, "ad_transaction_id": 1,
            "ad_total_revenue_net": Decimal("3"), "ad_total_data_volume": volume}
    return {**base, **columns}


USAGE_DIMS = {
    "nobill_dim_counter_type": [
        {"dcr_counter_type_id": 1, "dcr_category_8": "0"}, {"dcr_counter_type_id": 2, "dcr_category_8": "2"},
        {"dcr_counter_type_id": 3, "dcr_category_8": "x"},
    ],
    "nobill_dim_transaction_key": [
        {"transaction_id": 1, "service_group": "Data"},
        {"transaction_id": 2, "service_group": "Voice", "service_type": "MOC", "traffic_national_international": "National"},
    ],
}


def test_usage_windows_are_closed_and_share_edges(spark):
    tables = HandMade(
        spark,
        **USAGE_DIMS,
        nobill_aggr_ws_cost_v3=[
            *[usage_row(d) for d in (0, 30, 60, 90, 91)],
            usage_row(1, counter=2),
            usage_row(1, counter=3),
            usage_row(2, volume=None, ad_transaction_id=2, ad_total_duration=120000, ad_terminationreason=6),
            usage_row(2, volume=None, ad_transaction_id=2, ad_total_duration=120000, ad_terminationreason=1),
        ],
    )
    (account,) = usage.usage_all_windows(tables, L).collect()
    assert [account[f"DATA_USAGE_{w}"] for w in ("30_days", "30_60_days", "60_90_days")] == [2.0, 2.0, 2.0]
    assert account["Last_30_days_ARPU"] == pytest.approx(12 / 30)
    assert account["NATIONAL_VOICE_USAGE_30_days"] == 2.0
    assert account["Last_30_days_data_usage"] == "5"
    (day,) = usage.previous_day_usage(tables, L).collect()
    assert day["PREVIOUS_DAY_DATA_USAGE"] == 1.0


@pytest.mark.parametrize(
    "tests, kept",
    [([], [1, 2, None]), ([("1", "INCLUDE")], [2]), ([("1", "EXCLUDE"), ("", "INCLUDE"), (None, "INCLUDE")], [1, 2, None])],
)
def test_test_accounts_are_left_out(spark, rows, tests, kept):
    tables = HandMade(
        spark,
        **USAGE_DIMS,
        nobill_aggr_ws_cost_v3=[usage_row(1, account=a) for a in (1, 2, None)],
        nobill_dim_test_accounts=[{"accountnum": a, "exclusion_flag": f} for a, f in tests],
    )
    assert rows(usage.usage_window(tables, L, "30_days"), "in_account_number") == [(a,) for a in kept]


def test_call_ratio_without_incoming_calls_is_zero(spark, rows):
    def call(account, direction, days=1, service=1):
        return {"fus_accountnum": account, "fus_call_direction_id": direction, "fus_service_type_id": service,
                "fus_time_stamp": at(days, 5), "fus_termzone_id": 1, "fus_origzone_id": 1, "fus_terminationreason": 0}

    tables = HandMade(
        spark,
        nobill_fact_usage=[call(1, 2), call(2, 1), call(2, 2), call(2, 2), call(2, 2, 30), call(2, 2, 31), call(2, 1, 1, 2), call(2, 3)],
        nobill_dim_termzone=[{"dtz_termzone_id": 1}],
        nobill_dim_origzone=[{"doz_origzone_id": 1}],
    )
    assert rows(usage.call_directions(tables, L)) == [(1, 0, 1, 0.0), (2, 1, 3, 3.0)]


def test_trips_need_a_change_of_country(spark, rows):
    def message(i, mcc, days, number="m"):
        return {"ID": i, "MSISDN": number, "MCC": mcc, "DATETIME": at(days)}

    tables = HandMade(
        spark,
        roaming_ussd_received_data=[
            message(1, "500", 100), message(2, "500", 99), message(3, "424", 50), message(4, "500", 20),
            message(5, "901", 15), message(6, "777", 10), message(7, "x", 9), message(8, "778", 8), message(9, "500", 0),
            message(10, "424", 9, "home"),
        ],
        dim_roam_country_operator=[{"MCC": "500", "country": "A"}, {"MCC": "500", "country": "B"}],
        customer_master=[{"MSISDN": "m", "IN_ACCOUNT_NUMBER": "1"}, {"MSISDN": "m", "IN_ACCOUNT_NUMBER": "2"}],
    )
    for id_block in (1, 4, 1000):
        assert rows(engagement.roaming_trips(tables, L, id_block)) == [("2", "m", "", 2, 2, 3, 2)]


def test_data_sharing_remainder(spark, rows):
    tables = HandMade(
        spark,
        po_sre_actionhistory=[
            {"Id": i, "ActionId": 32, "DateTime": at(d), "CustomerId": c, "StatusId": 2}
            for i, d, c in [(1, 50, 1), (2, 5, 1), (3, 5, 2)]
        ],
        po_sre_shareplanhistory=[
            {"Id": i, "ActionHistoryId": i, "SubscriptionId": i, "CounterValue": 1024 * 1024 * 240, "IsSuccess": 1}
            for i in (1, 2, 3)
        ],
        po_sre_customer=[{"Id": 1, "NobillAccountNo": "1"}, {"Id": 2, "NobillAccountNo": "2"}],
        po_sre_subscription=[
            {"Id": 1, "StartDate": at(60), "EndDate": at(30)}, {"Id": 2, "StartDate": at(5, 9), "EndDate": at(-25)},
            {"Id": 3, "StartDate": at(1), "EndDate": None},
        ],
    )
    found = engagement.data_sharing(tables, L)
    assert rows(found, "IN_ACCOUNT_NUMBER", "DATA_SHARING_DONATION_DATE", "DATA_AVAILABLE_TO_SHARE") == [
        ("1", back(5), 10000.0),
        ("2", back(5), 0.0),
    ]


def test_loyalty_keeps_the_row_without_account(spark, rows):
    tables = HandMade(
        spark,
        loy_customer_trx_log=[
            {"customer_id": c, "points": Decimal(p), "CREATE_DATE": at(d, 7)}
            for c, p, d in [(1, "5", 0), (1, "6", 30), (1, "7", 31), (2, "8", 3), (None, "1", 3)]
        ],
        loy_dim_customer=[{"ID": 1, "identifier_value": "u1"}, {"ID": 2, "identifier_value": "nobody"}],
        customer_master=[{"CRM_UID": "u1", "IN_ACCOUNT_NUMBER": "11"}],
        loy_customer_cashback=[
            {"id": 1, "customer_id": 1, "tier_id": 1, "CREATE_DATE": at(5)},
            {"id": 2, "customer_id": 1, "tier_id": 2, "CREATE_DATE": at(4)},
            {"id": 3, "customer_id": 1, "tier_id": None, "CREATE_DATE": at(1)},
        ],
        loy_tier=[{"ID": 1, "name_en": "Silver"}, {"ID": 2, "name_en": "Gold"}],
    )
    assert rows(engagement.loyalty_points(tables, L)) == [("11", 11.0), (None, 9.0)]
    assert rows(engagement.loyalty_tier(tables, L)) == [("11", "Gold")]


def test_plan_recommendations(spark):
    def row(table_columns, **columns):
        return {"in_account_number": "1", "date_dt": back(1), **table_columns, **columns}

    tables = HandMade(
        spark,
        cr_optimum_plan_recommendation_results=[
            row({"right_size_plan_net_cost": 50.0, "60day_avg_money_spent": 62.9, "right_size_plan_price_change": -10.5}),
            row({"right_size_plan_net_cost": 50.0, "60day_avg_money_spent": 55.0, "right_size_plan_price_change": -10.5}, in_account_number="2"),
            row({"right_size_plan_price_change": -1.0}, in_account_number="3"),
            row({"right_size_plan_price_change": -1.0}, in_account_number="4", date_dt=back(2)),
            row({"right_size_plan_price_change": -1.0}, in_account_number="5", date_dt=L),
        ],
        cr_upselling_plan_recommendation_results=[
            row({"current_plan_net_cost": 0.0, "step_up_plan_price_change": 12.349, "step_up_spent_change": 7.999,
                 "60day_avg_money_spent": 3.0}),
        ],
    )
    labels = {r["IN_ACCOUNT_NUMBER"]: (r["AD_ATTRIBUTE_12"], r["AD_ATTRIBUTE_36"]) for r in scores.right_size_plan(tables, L).collect()}
    assert labels == {"1": ("12 Less", 0), "2": ("10 Less", 1), "3": (None, 2)}
    (step,) = scores.step_up_plan(tables, L).collect()
    assert (step["AD_ATTRIBUTE_12"], step["AD_ATTRIBUTE_35"], step["AD_ATTRIBUTE_39"]) == ("7 More", 12.34, 7.99)
    assert (step["AD_ATTRIBUTE_38"], step["AD_ATTRIBUTE_40"], step["AD_ATTRIBUTE_41"]) == (None, 2.66, 0)


def test_small_amounts_and_part_quantities_are_not_rounded(spark, rows):
    tables = HandMade(
        spark,
        loy_customer_trx_log=[{"customer_id": 1, "points": Decimal("0.004"), "CREATE_DATE": at(3)} for _ in range(3)],
        loy_dim_customer=[{"ID": 1, "identifier_value": "u1"}],
        customer_master=[{"CRM_UID": "u1", "IN_ACCOUNT_NUMBER": "11"}],
        event_in_booster=[
            {"EVENT_IN_DATE": back(3), "EVENT_IN_ACCOUNT_NUMBER": "a", "EVENT_IN_EVENT_ID": "e", "EVENT_IN_EVENT_GROUP": "Booster",
             "EVENT_IN_SERVICE_TYPE": "DATA", "EVENT_IN_TOTAL_QUANTITY": Decimal("0.5")},
        ],
        po_service_file=[{"EXCEL_SERVICE_EVENT_ID": "e", "EXCEL_SERVICE_TYPE": "DATA"}] * 3,
    )
    assert rows(engagement.loyalty_points(tables, L)) == [("11", 0.012)]
    (account,) = booster.booster_counts(tables, L).collect()
    assert (account["TOTAL_DATA_BOOSTER_QTY"], account["BOOSTER_TOTAL_DATA_COUNT_LAST_7DAYS"]) == (0.5, 1.5)


def test_purchases_balances_and_donations_from_the_load_date_on_are_unknown(spark, rows):
    def event(days):
        return {"EVENT_IN_DATE": back(days), "EVENT_IN_ACCOUNT_NUMBER": "a", "EVENT_IN_EVENT_ID": "e",
                "EVENT_IN_EVENT_GROUP": "Booster", "EVENT_IN_SERVICE_TYPE": "DATA", "EVENT_IN_TOTAL_QUANTITY": 1}

    def balance(days, value):
        return {"counter_id": 1, "account_num": 1, "countername": "AC.AnnualPlanFunds_Counter", "snapshotdate": back(days),
                "balance": Decimal(value)}

    def cashback(i, days):
        return {"id": i, "customer_id": 1, "tier_id": i, "CREATE_DATE": at(days)}

    known = {"event_in_booster": [event(400)], "nobill_snapshot_daily_balance": [balance(1, "5")], "loy_customer_cashback": [cashback(1, 1)]}
    later = {"event_in_booster": [event(0), event(-9)], "nobill_snapshot_daily_balance": [balance(0, "7")], "loy_customer_cashback": [cashback(2, 0)]}
    masters = {"loy_tier": [{"ID": 1, "name_en": "Silver"}, {"ID": 2, "name_en": "Gold"}]}
    before, after = (HandMade(spark, **masters, **t) for t in (known, {k: known[k] + later[k] for k in known}))
    for build in (booster.booster_purchases, plan.latest_positive_balances, engagement.loyalty_tier):
        assert rows(build(after, L)) == rows(build(before, L)) != []
