"""Golden tests: hand-made inputs holding the edge rows listed in FIXTURES.md section 2."""

import datetime as dt
from decimal import Decimal

from cardflow.functions.dates import BusinessDate
from cardflow.plans import (adjustment_transactions, flagged_delta, interest_adjustments_mtd,
                            new_flagged_accounts, plan_postings_mtd)
from cardflow.plans.adjustment_transactions import ACCOUNTING_FUNCTIONS
from conftest import rows

T = dt.datetime
D = dt.date
M = Decimal


# ------------------------------------------------------------------ RPT-3
TXN_DETAIL = "acct_id long, acct_seq_num int, txn_posted_dt timestamp_ntz, txn_dt date, txn_trans_cd string, " \
             "merch_nm string, txn_amt decimal(18,2)"


def test_interest_adjustments(spark):
    bd = BusinessDate(D(2024, 3, 16))
    data = [
        (1, 0, T(2024, 3, 15), D(2024, 3, 14), "0162", "EPP INTEREST ADJUST", M("1.00")),       # yesterday 00:00: in
        (2, 0, T(2024, 3, 15, 10), D(2024, 3, 14), "0162", "EPP INTEREST ADJUST", M("2.00")),   # yesterday 10:00: out
        (3, 0, T(2024, 3, 1), D(2024, 3, 1), "0162", "AJUST INTÉRÊTS PPE", M("3.00")),          # month start: in
        (4, 0, T(2024, 2, 29, 23, 59), D(2024, 2, 29), "0162", "EPP INTEREST ADJUST", M("4.00")),  # last month
        (5, 0, T(2024, 3, 10), D(2024, 3, 10), "162", "EPP INTEREST ADJUST", M("5.00")),        # code 162
        (6, 1, T(2024, 3, 10), D(2024, 3, 10), "0162", "EPP INTEREST ADJUST", M("6.00")),       # sequence 1
        (7, 0, T(2024, 3, 10), D(2024, 3, 10), "0162", "OTHER MERCHANT", M("7.00")),
        (123456789012, 0, T(2024, 3, 5), D(2024, 3, 5), "0162", "EPP INTEREST ADJUST", M("8.00")),
        (9, 0, T(2024, 3, 5), D(2024, 3, 5), "0162", "EPP INTEREST ADJUST", M("9.00")),
    ]
    out = interest_adjustments_mtd(spark.createDataFrame(data, TXN_DETAIL), bd)
    assert out.columns == ["acct_id", "acct_seq_num", "txn_posted_dt", "txn_dt", "txn_trans_cd", "merch_nm", "txn_amt"]
    assert rows(out, "acct_id", "txn_amt") == [
        ("00000000003", M("3.00")), ("00000000009", M("9.00")), ("12345678901", M("8.00")), ("00000000001", M("1.00"))]


# ------------------------------------------------------------------ RPT-2
PLAN_TXN = "acct_id long, acct_seq_num int, txn_post_dt timestamp_ntz, txn_dt date, txn_exp_dt date, " \
           "txn_amt decimal(18,2), pmt_rte decimal(18,2), txn_lvl_proc_option_set_id string, reasgned_txn_cat_cd string"


def _plan_txn(spark):
    data = [
        (1, 0, T(2024, 3, 1), "10", "2010"),              # month start: in
        (2, 0, T(2024, 3, 15, 23, 59, 59), "10", "2011"),  # last instant of yesterday: in
        (3, 0, T(2024, 3, 16), "10", "2010"),             # today 00:00: out
        (4, 0, T(2024, 3, 5), "10", "2012"),              # category 2012: out
        (5, 0, T(2024, 3, 5), "99", "2010"),              # option set without a code row: out
        (7, 1, T(2024, 3, 7), "20", "2010"),              # tied post date, option set 20
        (6, 0, T(2024, 3, 7), "10", "2010"),              # tied post date, option set 10 first
        (8, 0, T(2024, 3, 7), "10", "2010"),
        (9, 0, T(2024, 2, 29), "10", "2010"),             # previous month
    ]
    full = [(a, s, t, t.date(), D(2025, 1, 1), M("10.00"), M("1.00"), o, c) for a, s, t, o, c in data]
    return spark.createDataFrame(full, PLAN_TXN)


def _plan_code(spark):
    return spark.createDataFrame([("PLAN A", 10, 2010), ("PLAN B", 10, 2011), ("PLAN C", 20, 2010), ("PLAN X", 10, 2012)],
                                 "bt_desc string, tlp_option_set int, tcat_cd int")


def test_plan_postings(spark):
    out = plan_postings_mtd(_plan_txn(spark), _plan_code(spark), BusinessDate(D(2024, 3, 16)))
    assert out.columns == ["epp_desc", "acct_id", "acct_seq_num", "epp_posted_dt", "epp_txn_dt", "epp_expiry_dt",
                           "epp_txn_amt", "monthly_epp_pymt_amt"]
    assert rows(out, "epp_desc", "acct_id") == [
        ("PLAN A", "00000000001"), ("PLAN A", "00000000006"), ("PLAN A", "00000000008"),
        ("PLAN C", "00000000007"), ("PLAN B", "00000000002")]


def test_plan_postings_run_on_first_reports_previous_month(spark):
    out = plan_postings_mtd(_plan_txn(spark), _plan_code(spark), BusinessDate(D(2024, 3, 1)))
    assert rows(out, "acct_id") == [("00000000009",)]


# ------------------------------------------------------------------ RPT-4
TXN_MASTER = "acct_id long, acct_seq_num int, txn_posted_dt date, txn_dt date, outpt_txn_intrnl_cd int, " \
             "acctg_func_cd string, merch_nm string, db_cr_cd string, txn_amt decimal(18,2), txn_src_cd string, " \
             "tm_posted_seq_num long"


def test_adjustment_transactions(spark):
    d = D(2024, 3, 1)
    data = [(100 + i, 0, d, d, 162, code, "M", "D", M("1.00"), "BO", i) for i, code in enumerate(ACCOUNTING_FUNCTIONS)]
    data += [
        (200, 0, d, d, 7, "XYZ", "M", "D", M("2.00"), "BO", 1),          # unknown code: ERROR
        (201, 0, d, d, 7, None, "M", "D", M("2.00"), "BO", 1),           # NULL code: drops
        (202, 0, d, d, 7, "DBT", "M", "D", M("2.00"), "OT", 1),          # other source: drops
        (123456789012, 0, d, d, 12345, "CRT", "M", "C", M("3.00"), "BO", 1),  # long id, long code: cut
        (300, 1, d, d, 7, "DBT", "M", "C", M("5.00"), "BO", 2),          # credit and debit rows, equal amounts
        (300, 1, d, d, 7, "DBT", "M", "D", M("5.00"), "BO", 1),
    ]
    out = adjustment_transactions(spark.createDataFrame(data, TXN_MASTER))
    got = rows(out, "acct_id", "trans_cd", "acctg_func", "txn_amt")
    labels = {r[0]: r[2] for r in got}
    assert "PAYMENT" not in labels.values()  # PAY rows are filtered out
    expected_codes = [c for c in ACCOUNTING_FUNCTIONS if c != "PAY"]
    for i, code in enumerate(ACCOUNTING_FUNCTIONS):
        if code != "PAY":
            assert labels[f"{100 + i:011d}"] == ACCOUNTING_FUNCTIONS[code]
    assert labels["00000000200"] == "ERROR"
    assert "00000000201" not in labels and "00000000202" not in labels
    assert ("12345678901", "1234", "CREDIT", M("3.00")) in got
    assert len(got) == len(expected_codes) + 1 + 1 + 2
    # sorted by padded id, sequence, posted date, posting sequence (hidden)
    tail = rows(out.filter("acct_id = '00000000300'"), "txn_amt")
    assert tail == [(M("5.00"),), (M("5.00"),)]
    assert [r[0] for r in got] == sorted(r[0] for r in got)


# ------------------------------------------------------------------ RPT-1
SNAPSHOT = "acct_id long, acct_seq_num int, acct_open_dt timestamp_ntz, cpc string, inst_credit string, " \
           "lastday_month timestamp_ntz, eff_dt_yymm string"
HISTORY = "acct_id long, acct_seq_num int, acct_open_dt timestamp_ntz, cpc string, cdf21 string, data_bus_dt date, " \
          "data_load_dt date"
MASTER = "acct_id long, acct_seq_num int, name string, name_emboss string, state_prov_code string, " \
         "zip_postal_code string, efftv_from_dt date, efftv_to_dt date"
BD1 = BusinessDate(D(2024, 4, 1))  # month key 2024_03, as-of 2024-03-31


def rpt1_inputs(spark):
    o, lm = T(2020, 1, 1), T(2024, 3, 31)
    snap = [
        (1, 0, o, "C1", "IP", lm, "2024_03"),   # new, one master row
        (2, 0, o, "C2", "IC", lm, "2024_03"),   # in history under another sequence number: drops
        (3, 0, o, "C3", "VP", lm, "2024_03"),   # twice in the batch: both kept
        (3, 0, o, "C3", "VC", lm, "2024_03"),
        (4, 0, o, "C4", "EI", lm, "2024_03"),   # flag outside the set
        (5, 1, o, "C5", "VF", lm, "2024_03"),   # sequence 1
        (6, 0, o, "C6", "VF", lm, "2024_02"),   # other month
        (7, 0, o, "C7", "VF", lm, "2024_03"),   # no master row
        (8, 0, o, "C8", "IP", lm, "2024_03"),   # two master rows valid
        (9, 0, o, "C9", "IP", lm, "2024_03"),   # master validity ends exactly on the as-of date
    ]
    hist = [(2, 1, o, "C2", "IC", D(2024, 1, 31), D(2024, 2, 1))]
    master = [
        (1, 0, "ONE", "ONE E", "ON", "A1", D(2000, 1, 1), D(9999, 12, 31)),
        (3, 0, "THREE", "THREE E", "QC", "A3", D(2000, 1, 1), D(9999, 12, 31)),
        (8, 0, "EIGHT A", "E", "BC", "A8", D(2000, 1, 1), D(9999, 12, 31)),
        (8, 0, "EIGHT B", "E", "BC", "B8", D(2024, 3, 31), D(9999, 12, 31)),
        (9, 0, "NINE", "N", "AB", "A9", D(2000, 1, 1), D(2024, 3, 31)),
        (9, 0, "NINE OLD", "N", "AB", "B9", D(2000, 1, 1), D(2024, 3, 30)),
    ]
    return (spark.createDataFrame(snap, SNAPSHOT), spark.createDataFrame(hist, HISTORY),
            spark.createDataFrame(master, MASTER))


def test_flagged_delta(spark):
    snap, hist, _ = rpt1_inputs(spark)
    delta = flagged_delta(snap, hist, BD1)
    assert delta.columns == ["acct_id", "acct_seq_num", "acct_open_dt", "cpc", "cdf21", "data_bus_dt", "data_load_dt"]
    assert sorted(rows(delta, "acct_id", "cdf21", "data_bus_dt", "data_load_dt")) == [
        (1, "IP", D(2024, 3, 31), D(2024, 4, 1)), (3, "VC", D(2024, 3, 31), D(2024, 4, 1)),
        (3, "VP", D(2024, 3, 31), D(2024, 4, 1)), (7, "VF", D(2024, 3, 31), D(2024, 4, 1)),
        (8, "IP", D(2024, 3, 31), D(2024, 4, 1)), (9, "IP", D(2024, 3, 31), D(2024, 4, 1))]


def test_new_flagged_accounts_report(spark):
    out = new_flagged_accounts(*rpt1_inputs(spark), BD1)
    assert out.columns == ["name", "name_emboss", "prov", "postal_code", "cpc", "cdf21", "acct_open_dt", "acct_id"]
    assert sorted(rows(out, "acct_id", "name", "cdf21", "acct_open_dt"), key=str) == sorted([
        ("00000000001", "ONE", "IP", D(2020, 1, 1)),
        ("00000000003", "THREE", "VP", D(2020, 1, 1)),
        ("00000000003", "THREE", "VC", D(2020, 1, 1)),
        ("00000000007", None, "VF", D(2020, 1, 1)),
        ("00000000008", "EIGHT A", "IP", D(2020, 1, 1)),
        ("00000000008", "EIGHT B", "IP", D(2020, 1, 1)),
        ("00000000009", "NINE", "IP", D(2020, 1, 1)),
    ], key=str)
