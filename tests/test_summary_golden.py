"""Golden test for the daily application summary (RPT-5) with invented site rules."""

import datetime as dt

import pytest

from cardflow.functions.dates import BusinessDate
from cardflow.plans import SummaryRules, daily_application_summary

T, D = dt.datetime, dt.date
BD = BusinessDate(D(2020, 9, 10))  # as-of 2020-09-09
FAR = D(9999, 12, 31)
RULES = SummaryRules(
    excluded_strategy="XSTRAT",
    care_window=(D(2020, 3, 4), D(2020, 3, 19)),
    care_address="192.0.2.1",
    cis_address_prefix="192.0.2.",
    intercept_mail_fragment="@dealer.",
    product_labels=((("AAA",), "LABEL A"), (("WEN",), "WORLD X"), (("RCB", "CCA"), "PLAT")),
    product_cutover=D(2020, 8, 1),
    label_before_cutover="BEFORE",
    label_after_cutover="AFTER",
)

LEGACY_COLS = ["app_num", "dt_entered", "dt_status", "status_field", "acct_cust_data_81", "data_entry_officer",
               "user_20_byte_9", "user_75_byte_1", "acct_cust_data_60", "af_queue_id", "age_bucket",
               "client_product_cd", "acct_cust_data_62", "user_1_byte_12", "test_app_sw", "test_acct_flag"]
LEGACY = ("app_num long, dt_entered timestamp_ntz, dt_status timestamp_ntz, "
          + ", ".join(f"{c} string" for c in LEGACY_COLS[3:]))
APP_COLS = ["appl_id", "entry_dt", "curr_stat_dt", "efftv_from_dt", "efftv_to_dt", "appl_strgy_cd", "appl_stat_cd",
            "acqsn_channel_cd", "appl_queue_id", "appl_age_bucket"]
APP = ("appl_id long, entry_dt timestamp_ntz, curr_stat_dt timestamp_ntz, efftv_from_dt date, efftv_to_dt date, "
       "appl_strgy_cd string, appl_stat_cd string, acqsn_channel_cd string, appl_queue_id string, appl_age_bucket string")


def legacy(app_num, entered, status=None, **kw):
    vals = {"app_num": app_num, "dt_entered": entered, "dt_status": status, **kw}
    return tuple(vals.get(c) for c in LEGACY_COLS)


def app(appl_id, entry, stat_dt=None, frm=D(2020, 1, 1), to=FAR, strategy="STD", **kw):
    vals = {"appl_id": appl_id, "entry_dt": entry, "curr_stat_dt": stat_dt, "efftv_from_dt": frm, "efftv_to_dt": to,
            "appl_strgy_cd": strategy, **kw}
    return tuple(vals.get(c) for c in APP_COLS)


def inputs(spark, excluded=((121,),)):
    e = T(2020, 1, 5, 8)
    legacy_rows = [
        legacy(101, e, T(2020, 1, 10), status_field="NEWACCOUNT", acct_cust_data_81="TCALLCEN", acct_cust_data_60="3XX",
               af_queue_id=" DECSIN ", age_bucket="B", client_product_cd=" WEN ", acct_cust_data_62="C1",
               user_1_byte_12=" D "),
        legacy(103, e, T(2020, 3, 1, 10), status_field="WITHDRAW", acct_cust_data_81="BRANCH"),
        legacy(114, e, T(2020, 5, 1), status_field=None, acct_cust_data_81="BRANCH"),
        legacy(117, T(2020, 7, 31, 23), T(2020, 8, 1), acct_cust_data_81="BRANCH"),
        legacy(118, T(2020, 8, 1), T(2020, 8, 2), acct_cust_data_81="BRANCH"),
        legacy(119, T(2020, 8, 15), T(2020, 8, 16), acct_cust_data_81="BRANCH"),
        legacy(132, e, None, status_field="WITHDRAW", acct_cust_data_81="BRANCH"),
        legacy(133, e, T(2020, 2, 1), status_field="WITHDRAW", acct_cust_data_81="BRANCH"),
        legacy(120, None, None, acct_cust_data_81="BRANCH"),
        legacy(107, T(2020, 1, 1), None, acct_cust_data_81="BRANCH", client_product_cd="AAA"),
        legacy(107, T(2020, 1, 2), None, acct_cust_data_81="BRANCH", client_product_cd="AAA"),
        legacy(108, T(2020, 9, 10), None, acct_cust_data_81="BRANCH"),
        legacy(109, None, None, acct_cust_data_81="BRANCH"),
        legacy(110, e, None, status_field="  ", acct_cust_data_81="BRANCH"),
        legacy(111, e, None, acct_cust_data_81="BRANCH", test_app_sw="Y", test_acct_flag=" Y"),
        legacy(112, e, None, acct_cust_data_81="BRANCH", test_app_sw="Y", test_acct_flag=" "),
        legacy(113, e, None, acct_cust_data_81="BRANCH"),
        legacy(121, e, None, acct_cust_data_81=None, data_entry_officer="OFF"),
        legacy(122, T(2020, 3, 5), None, acct_cust_data_81="TCALLCEN", user_20_byte_9="192.0.2.1"),
        legacy(123, T(2020, 3, 5), None, acct_cust_data_81=" TCALLCEN", user_20_byte_9="192.0.2.77"),
        legacy(124, e, None, acct_cust_data_81="RDEALER", user_75_byte_1="x@dealer.example"),
        legacy(125, e, None, acct_cust_data_81="TMS"),
        legacy(126, e, None, acct_cust_data_81=" ", data_entry_officer=" "),
        legacy(127, T(2020, 3, 25), None, acct_cust_data_81="TCALLCEN", user_20_byte_9="192.0.2.1"),
        legacy(128, e, None, acct_cust_data_81="BRANCH"),
        legacy(129, e, None, acct_cust_data_81="BRANCH", acct_cust_data_60="6"),
        legacy(130, e, None, acct_cust_data_81="BRANCH", acct_cust_data_60="Q1"),
        legacy(131, e, None, acct_cust_data_81="BRANCH", acct_cust_data_60=" 7"),
    ]
    element = [(128, "CHKINCOME", " INCOMERCB"), (128, "OTHER", "INCOMEWEN"), (101, " CHKINCOME", "INCOMERCB")]
    override = [(113, 5, "AAA"), (113, 6, "WEN"), (113, 0, "CCA")]
    app_rows = [
        app(102, T(2020, 2, 1, 9), T(2020, 2, 3), appl_stat_cd=" DECLINE", acqsn_channel_cd=None,
            appl_queue_id="DECSIN", appl_age_bucket=" K"),
        app(103, T(2020, 1, 6, 9), T(2020, 3, 1, 15), appl_stat_cd="NEWACCOUNT", acqsn_channel_cd="INTERNET"),
        app(104, T(2020, 1, 7), T(2020, 1, 8), to=D(2020, 1, 31)),
        app(105, T(2020, 1, 7), T(2020, 1, 8), strategy="  "),
        app(106, T(2020, 1, 7), T(2020, 1, 8), strategy="XSTRAT"),
        app(114, T(2020, 1, 6), T(2020, 4, 1), appl_stat_cd="VOID APP"),
        app(115, T(2020, 1, 6), None, appl_stat_cd="WITHDRAW"),
        app(115, T(2020, 1, 6), T(2020, 6, 1), appl_stat_cd="NEWACCOUNT"),
        app(116, T(2020, 1, 6), T(2020, 6, 1), appl_stat_cd="DECLINE", appl_queue_id="QB"),
        app(116, T(2020, 1, 6), T(2020, 6, 1), appl_stat_cd="DECLINE", appl_queue_id="QA"),
        app(120, T(2020, 1, 1), T(2020, 1, 2), to=D(2020, 1, 31)),
        app(132, T(2020, 1, 6), T(2020, 2, 1), appl_stat_cd="NEWACCOUNT"),
        app(133, T(2020, 1, 6), None, appl_stat_cd="NEWACCOUNT"),
    ]
    decision = [(102, "OFF1", D(2020, 1, 1), FAR)]
    app_element = [(102, "CHKINCOME", "INCOMEWEN", D(2020, 1, 1), D(2020, 9, 9))]
    user_data = [(102, " D", D(2020, 1, 1), FAR)]
    transfer = [(102, 5001, "FCB", D(2020, 1, 1), FAR), (103, 0, "WEN", D(2020, 1, 1), FAR)]
    account = [(102, "6ABC", None, None, D(2020, 1, 1), FAR), (103, "12", "IDVPMO", "RCB", D(2020, 1, 1), FAR)]
    custom = [(5001, 0, "IC", D(2020, 1, 1), FAR), (5001, 1, "IP", D(2020, 1, 1), FAR)]
    c = spark.createDataFrame
    return {
        "legacy_app": c(legacy_rows, LEGACY),
        "legacy_element": c(element, "app_num long, element_name string, alpha_value string"),
        "legacy_override": c(override, "app_num long, ts2_account_id long, client_prod_code string"),
        "app": c(app_rows, APP),
        "app_decision": c(decision, "appl_id long, data_entry_off_num string, efftv_from_dt date, efftv_to_dt date"),
        "app_element": c(app_element, "appl_id long, ele_elmt_nm string, ele_alph_val string, efftv_from_dt date, "
                                      "efftv_to_dt date"),
        "app_user_data": c(user_data, "appl_id long, user_1_byte_12 string, efftv_from_dt date, efftv_to_dt date"),
        "app_transfer": c(transfer, "appl_id long, acct_id long, clnt_prod_cd string, efftv_from_dt date, "
                                    "efftv_to_dt date"),
        "app_account": c(account, "appl_id long, custom_data_60 string, custom_data_62 string, clnt_prod_cd string, "
                                  "efftv_from_dt date, efftv_to_dt date"),
        "account_custom": c(custom, "acct_id long, acct_seq_num int, custom_21_data string, efftv_from_dt date, "
                                    "efftv_to_dt date"),
        "excluded_app": c(list(excluded), "app_num long"),
    }


@pytest.fixture(scope="module")
def result(spark):
    out = daily_application_summary(inputs(spark), BD, RULES)
    return out.columns, [r.asDict() for r in out.collect()]


def by_id(result, appl_id):
    return [r for r in result[1] if r["appl_id"] == appl_id]


def one(result, appl_id):
    got = by_id(result, appl_id)
    assert len(got) == 1, got
    return got[0]


def test_columns(result):
    assert result[0] == ["appl_id", "dt_entered", "dt_status", "app_status", "channel", "category", "stc", "queue",
                         "age_bucket", "adm_cpc", "product_type", "app_entry_method", "inst_cr", "stc_bkdown"]


def test_spine_membership(result):
    ids = {r["appl_id"] for r in result[1]}
    assert {101, 102, 103, 104, 107, 110, 111, 112, 113, 114, 115, 116, 120} <= ids
    assert not ids & {105, 106, 108, 109, 121}  # blank/excluded strategy, entered today, NULL day, listed


def test_legacy_only(result):
    # the income element (INCOMERCB) outranks the application's own product code (WEN)
    r = one(result, 101)
    assert r == {"appl_id": 101, "dt_entered": D(2020, 1, 5), "dt_status": D(2020, 1, 10), "app_status": "APPROVED",
                 "channel": "TCALLCEN", "category": "EMPLOYEE PROGRAM", "stc": "NEWACCOUNT", "queue": "DECSIN",
                 "age_bucket": "21 - 30 DAYS", "adm_cpc": "RCB", "product_type": "PLAT",
                 "app_entry_method": "DE_WEB", "inst_cr": "NON_IC", "stc_bkdown": "APPROVED"}


def test_current_only(result):
    r = one(result, 102)
    assert r == {"appl_id": 102, "dt_entered": D(2020, 2, 1), "dt_status": D(2020, 2, 3), "app_status": "DECLINED",
                 "channel": "OTHER", "category": "ERROR", "stc": "DECLINE", "queue": "DECSIN", "age_bucket": None,
                 "adm_cpc": "FCB", "product_type": "ERROR", "app_entry_method": "ERROR", "inst_cr": "IC",
                 "stc_bkdown": "DECLINED_CREDIT"}


def test_same_status_day_current_wins_and_dealer_override(result):
    r = one(result, 103)
    assert (r["app_status"], r["dt_entered"], r["channel"], r["adm_cpc"], r["product_type"], r["category"]) == (
        "APPROVED", D(2020, 1, 6), "RDEALER", "RCB", "PLAT", "PREAPPROVED")


def test_neither_source_valid(result):
    r = one(result, 104)
    assert (r["app_status"], r["product_type"], r["inst_cr"], r["dt_entered"]) == (None, "ERROR", "NON_IC", None)


def test_newer_legacy_null_value_falls_back(result):
    r = one(result, 114)
    assert (r["dt_status"], r["app_status"], r["stc"], r["stc_bkdown"]) == (
        D(2020, 5, 1), "PENDING", "VOID APP", "DECLINED_OTHER")


def test_null_status_day_on_either_side(result):
    # legacy day NULL: the current source is newer
    assert (one(result, 132)["app_status"], one(result, 132)["dt_status"]) == ("APPROVED", D(2020, 2, 1))
    # current day NULL: the legacy source is newer
    assert (one(result, 133)["app_status"], one(result, 133)["dt_status"]) == ("WITHDRAW APP", D(2020, 2, 1))


def test_null_status_date_ranks_first(result):
    r = one(result, 115)
    assert (r["dt_status"], r["app_status"]) == (None, "WITHDRAW APP")


def test_rank_tie_is_reproducible(result):
    assert one(result, 116)["queue"] == "QA"


def test_product_cutover(result):
    assert one(result, 117)["product_type"] == "BEFORE"
    assert one(result, 118)["product_type"] == "AFTER"
    assert one(result, 119)["product_type"] == "AFTER"
    assert one(result, 120)["product_type"] == "ERROR"  # NULL code and NULL entry day


def test_two_entry_days_and_override_fanout(result):
    assert sorted(r["dt_entered"] for r in by_id(result, 107)) == [D(2020, 1, 1), D(2020, 1, 2)]
    assert sorted(r["adm_cpc"] for r in by_id(result, 113)) == ["AAA", "WEN"]


def test_blank_status_and_test_marks(result):
    r = one(result, 110)
    assert (r["app_status"], r["stc"], r["stc_bkdown"]) == ("PENDING", None, "DECLINED_OTHER")
    assert one(result, 111)["app_status"] is None  # both test marks set: legacy row dropped
    assert one(result, 112)["app_status"] == "PENDING"


def test_legacy_channel_rules(result):
    got = {i: one(result, i)["channel"] for i in (122, 123, 124, 125, 126, 127)}
    assert got == {122: "CARE", 123: "CIS", 124: "INTERCEP", 125: "TCALLCEN", 126: "ERROR", 127: "TCALLCEN"}


def test_categories_and_income_element(result):
    assert [one(result, i)["category"] for i in (129, 130, 131)] == ["ERROR", "ERROR", "PREAPPROVED"]
    assert one(result, 128)["adm_cpc"] == "RCB"
    assert one(result, 110)["category"] == "BLANK APPLICATIONS"


def test_exclusion_listing_with_null_empties(spark):
    out = daily_application_summary(inputs(spark, excluded=((121,), (None,))), BD, RULES)
    assert out.count() == 0
