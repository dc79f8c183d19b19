"""Customer base, profiles, disconnections and terminations on hand-made rows."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from fixtures import HandMade
from sublens.plans import customer_base as base
from sublens.plans import disconnection, profiles

L = date(2023, 6, 15)


def snap(account, days_back, status=3, blocked=0, kind="VM_Standard", number=None):
    return {
        "accountnum": account,
        "phonenumber": number or f"n{account}",
        "status": status,
        "blocked": blocked,
        "snapshotdate": L - timedelta(days=days_back),
        "subscriptiontype": kind,
    }


def block(account, key, info, at):
    return {
        "accountnum": account,
        "additionalinfo": info,
        "historytypekey": key,
        "localtstamp": at,
        "tstamp": at,
    }


def port(account, key="numDisassociated", info=None, at=datetime(2023, 5, 1, 9)):
    return {"accountnum": account, "historytypekey": key, "additionalinfo": info, "tstamp": at}


@pytest.fixture
def tables(spark):
    return HandMade(
        spark,
        nobill_snapshot_subscription=[
            snap(2, 1),
            snap(3, 1, blocked=1),
            snap(4, 1),
            snap(5, 1),
            snap(6, 1, kind="VM_AppleWatch"),
            snap(7, 1, kind=None),
            snap(10, 91),
            snap(11, 91),
            snap(11, 40),
            snap(12, 92),
            snap(13, 0),
        ],
        nobill_tx_account_history=[
            # Account 4: the newest event is a removal, so the older block no longer counts.
            block(4, "accServiceAdded", "CS.TRA_Blocking", datetime(2023, 1, 1)),
            block(4, "accServiceRemoved", "CS.FRAUD_Blocking", datetime(2023, 2, 1)),
            block(5, "accServiceAdded", "CS.ID_Expiry_1W_Blocking", datetime(2023, 3, 1)),
            block(2, "accServiceAdded", "CS.Unrelated", datetime(2023, 3, 1)),
        ],
        nobill_tx_phonenumber_history=[
            port(11),
            port(11, at=datetime(2023, 4, 1)),
            port(10, at=datetime(2023, 6, 15)),
            port(1),
        ],
    )


def test_customer_base(tables, rows):
    assert rows(base.customer_base(tables, L)) == [
        (10, "TERMINATED"),
        (11, "PORT_OUT"),
        (2, "ACTIVE"),
        (3, "DEACTIVE"),
        (4, "ACTIVE"),
        (5, "SUSPENDED"),
    ]


def test_termination_prefers_the_port_out_time(tables, rows):
    assert rows(base.termination_date(tables, L)) == [
        (10, datetime(2023, 3, 16)),
        (11, datetime(2023, 5, 1, 9)),
    ]


def test_missing_account_present_yesterday_empties_terminations_but_not_departures(spark, rows):
    tables = HandMade(spark, nobill_snapshot_subscription=[snap(None, 1), snap(10, 20)])
    assert rows(base.termination_date(tables, L)) == []
    assert rows(base.departed_accounts(tables, L)) == [(10,)]


def test_status_is_unique_and_the_audit_finds_repeated_answers(spark, rows):
    tables = HandMade(
        spark,
        nobill_snapshot_subscription=[snap(22, 1), snap(33, 1)],
        customer_master=[
            {"IN_ACCOUNT_NUMBER": str(a), "REGISTRATION_ID": "r", "CUST_LATEST_ID_NUMBER": "doc",
             "LATEST_LINE_STATUS": "ACTIVE", "CUST_DAYS_SINCE_LAST_ACTIVITY": "4"}
            for a in (22, 33, 44, 55, 66)
        ],
        usabilla_data=[
            {"score": 3, "extra_info": "acct-22", "_date": "2023-01-01 10:00:00", "campaign_id": "c"},
            {"score": 9, "extra_info": "22", "_date": "2023-02-01 10:00:00", "campaign_id": "c"},
            {"score": 1, "extra_info": "x7", "_date": "2023-02-01 10:00:00", "campaign_id": "c"},
        ],
        usabilla_campaigns=[{"campaign_id": "c"}, {"campaign_id": "c"}],
    )
    assert rows(profiles.status(tables, L)) == [
        (22, "ACTIVE", "4", 0, 1, 9, 9),
        (33, "ACTIVE", "4", 0, 1, None, None),
    ]
    assert rows(profiles.duplicate_audit(tables, L)) == [(22, 4)]
    assert rows(profiles.duplicate_audit(tables, L, newest_answer_only=True)) == []
    assert rows(profiles.demographics(tables, L).groupBy("IN_ACCOUNT_NUMBER").count()) == [(22, 4), (33, 1)]
    assert profiles.acquisition(tables, L).count() == 5


def test_every_answer_is_a_row_and_many_answers_are_the_work_of_many_tasks(spark, rows):
    tables = HandMade(
        spark,
        nobill_snapshot_subscription=[snap(22, 1), snap(22, 1), snap(33, 1), snap(None, 1), snap(44, 1)],
        usabilla_data=[
            *[{"score": n % 2, "extra_info": f"acct-0{33}", "_date": "2023-01-01 10:00:00", "campaign_id": "c"} for n in range(300)],
            {"score": 9, "extra_info": "22", "_date": "2023-02-01 10:00:00", "campaign_id": "other"},
            {"score": None, "extra_info": "22", "_date": "2023-02-01 10:00:00", "campaign_id": None},
            {"score": None, "extra_info": "022", "_date": None, "campaign_id": None},
            {"score": 5, "extra_info": "44", "_date": "2023-06-15 00:00:00", "campaign_id": "c"},
        ],
        usabilla_campaigns=[{"campaign_id": "c"}] * 200 + [{"campaign_id": None}] * 7,
    )
    every = profiles.status(tables, L, newest_answer_only=False)
    assert rows(every.groupBy("IN_ACCOUNT_NUMBER", "CUSTOMER_SENTIMENT_SCORE", "CUSTOMER_MOOD_SCORE_CSAT").count()) == sorted([
        (22, 9, 9, 2), (22, None, None, 4), (33, 0, 0, 30000), (33, 1, 1, 30000), (44, None, None, 1), (None, None, None, 1),
    ], key=lambda t: tuple((v is None, str(v)) for v in t))
    made = every.where("IN_ACCOUNT_NUMBER = 33").groupBy(F.spark_partition_id()).count().collect()
    assert len(made) > 3 and max(r["count"] for r in made) < 30000


def test_master_without_registration_is_ignored(spark, rows):
    tables = HandMade(
        spark,
        nobill_snapshot_subscription=[snap(22, 1), snap(33, 1)],
        customer_master=[
            {"IN_ACCOUNT_NUMBER": "22", "REGISTRATION_ID": "", "EMAIL": "a"},
            {"IN_ACCOUNT_NUMBER": "33", "REGISTRATION_ID": None, "EMAIL": "b"},
        ],
    )
    assert rows(profiles.demographics(tables, L), "IN_ACCOUNT_NUMBER", "EMAIL", "CUSTOMER_DOB") == [
        (22, None, "Later"),
        (33, None, "Later"),
    ]


def test_pairing_two_adds_one_remove_and_open_until_load_date(spark, rows):
    info = "CS.TRA_Blocking"
    tables = HandMade(
        spark,
        nobill_tx_account_history=[
            block(1, "accServiceAdded", info, datetime(2023, 1, 1)),
            block(1, "accServiceAdded", info, datetime(2023, 3, 1)),
            block(1, "accServiceRemoved", info, datetime(2023, 2, 1)),
            block(1, "accServiceRemoved", "CS.FRAUD_Blocking", datetime(2023, 2, 2)),
        ],
    )
    assert rows(disconnection.block_intervals(tables, L), "accountnum", "add_date", "remove_date") == [
        (1, datetime(2023, 1, 1), datetime(2023, 2, 1)),
        (1, datetime(2023, 3, 1), datetime(2023, 6, 15)),
    ]


def test_disconnection_is_the_latest_step_out_of_active(spark, rows):
    info = "CS.TRA_Blocking"
    tables = HandMade(
        spark,
        nobill_snapshot_subscription=[
            *[snap(1, d) for d in (10, 9, 8, 7, 6, 5)],
            snap(1, 4, blocked=2),
            snap(2, 9),
            snap(2, 8, status=6),
            snap(2, 7, status=6),
            snap(3, 9),
            snap(4, 9, status=6),
            snap(5, 20),
            snap(5, 3, status=6),
        ],
        nobill_tx_account_history=[
            # Covers the snapshots 9 and 8 days back: the day counts by its end.
            block(1, "accServiceAdded", info, datetime(2023, 6, 6, 8)),
            block(1, "accServiceRemoved", info, datetime(2023, 6, 9)),
        ],
    )
    day = lambda back: L - timedelta(days=back)
    assert rows(disconnection.disconnection_date(tables, L)) == [(1, day(4)), (2, day(8)), (5, day(3))]
    changes = disconnection.status_changes(tables, L)
    assert rows(changes.where("accountnum = 1"), "snapshotdate", "prev_status", "line_status") == [
        (day(10), "NA", "ACTIVE"),
        (day(9), "ACTIVE", "DEACTIVE"),
        (day(7), "DEACTIVE", "ACTIVE"),
        (day(4), "ACTIVE", "SUSPENDED"),
    ]


def test_overlapping_blocks_and_reversed_pairs(spark, rows):
    info, other = "CS.TRA_Blocking", "CS.FRAUD_Blocking"
    tables = HandMade(
        spark,
        nobill_snapshot_subscription=[snap(1, d) for d in (9, 8, 7, 6, 5)],
        nobill_tx_account_history=[
            block(1, "accServiceAdded", info, datetime(2023, 6, 8, 1)),
            block(1, "accServiceRemoved", info, datetime(2023, 6, 9, 1)),
            block(1, "accServiceAdded", other, datetime(2023, 6, 8, 2)),
            block(1, "accServiceRemoved", other, datetime(2023, 6, 10, 1)),
            # A removal that precedes its addition gives an empty interval.
            block(1, "accServiceRemoved", "CS.HardSIM_Capping", datetime(2023, 6, 1)),
            block(1, "accServiceAdded", "CS.HardSIM_Capping", datetime(2023, 6, 11)),
        ],
    )
    assert rows(disconnection.disconnection_date(tables, L)) == [(1, L - timedelta(days=7))]


def test_registered_not_activated_keeps_missing_account_numbers(spark):
    tables = HandMade(
        spark,
        vmwsc_registration=[
            {"Email": e, "DateTime": datetime(2023, 2, d), "IsEmailVerified": v, "AccountNumber": a}
            for e, d, v, a in [("a", 1, True, "A1"), ("b", 3, True, None), ("c", 2, True, "A2"), ("d", 4, False, "A3")]
        ],
        cas_tx_activations=[{"CRMAccountNo": "A1"}, {"CRMAccountNo": None}],
    )
    found = profiles.registered_not_activated(tables, date(2023, 1, 1), date(2023, 3, 21))
    assert [r["REG_EMAIL"] for r in found.collect()] == ["b", "c"]


def test_a_stored_customer_base_gives_the_same_profiles(tables, rows):
    stored = base.customer_base(tables, L)
    for profile in (profiles.acquisition, profiles.demographics, profiles.status):
        assert rows(profile(tables, L, base=stored)) == rows(profile(tables, L))


def test_an_open_block_covers_the_newest_snapshot(spark, rows):
    tables = HandMade(
        spark,
        nobill_snapshot_subscription=[snap(5, 2), snap(5, 1)],
        nobill_tx_account_history=[
            block(5, "accServiceAdded", "CS.TRA_Blocking", datetime(2023, 6, 14, 12)),
            block(5, "accServiceRemoved", "CS.TRA_Blocking", datetime(2023, 6, 15, 1)),
        ],
    )
    assert rows(disconnection.disconnection_date(tables, L)) == [(5, L - timedelta(days=1))]
    assert [r["add_date"] for r in disconnection.snapshots_with_blocks(tables, L).orderBy("snapshotdate").collect()] == [
        None,
        datetime(2023, 6, 14, 12),
    ]


def test_rows_dated_from_the_load_date_on_change_nothing(spark, rows):
    known = {
        "nobill_snapshot_subscription": [snap(2, 3), snap(2, 1), snap(10, 20), snap(4, 1)],
        "nobill_tx_account_history": [block(4, "accServiceAdded", "CS.TRA_Blocking", datetime(2023, 3, 1))],
        "nobill_tx_phonenumber_history": [port(10)],
    }
    later = {
        "nobill_snapshot_subscription": [snap(2, 0, status=6), snap(13, 0), snap(10, -3)],
        "nobill_tx_account_history": [
            block(2, "accServiceAdded", "CS.TRA_Blocking", datetime(2023, 6, 15)),
            block(4, "accServiceRemoved", "CS.TRA_Blocking", datetime(2023, 6, 20)),
        ],
        "nobill_tx_phonenumber_history": [port(10, at=datetime(2023, 6, 15))],
    }
    before, after = HandMade(spark, **known), HandMade(spark, **{k: known[k] + later[k] for k in known})
    for build in (base.customer_base, base.termination_date, base.latest_block, disconnection.block_intervals,
                  disconnection.status_changes, disconnection.disconnection_date):
        assert rows(build(after, L)) == rows(build(before, L))
