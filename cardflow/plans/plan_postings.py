"""RPT-2 ``plan_postings_mtd``: month-to-date instalment-plan postings with plan names."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardflow.functions.columns import pad_id
from cardflow.functions.dates import BusinessDate, month_to_date
from cardflow.operators.joins import inner_join
from cardflow.operators.sorting import sort_report

# Fixed values of the original job: the two plan categories.
PLAN_CATEGORIES = (2010, 2011)

OUTPUT = ["epp_desc", "acct_id", "acct_seq_num", "epp_posted_dt", "epp_txn_dt", "epp_expiry_dt",
          "epp_txn_amt", "monthly_epp_pymt_amt"]


def plan_postings_mtd(plan_txn: DataFrame, plan_code: DataFrame, bd: BusinessDate,
                      categories: Sequence[int] = PLAN_CATEGORIES) -> DataFrame:
    """Transactions joined to their plan code on (option set, category) as text, categories in
    ``categories``, posted in ``[month_start, run_date)``; sorted by post time, option set and
    raw account id (the last two are not in the output)."""
    txn = plan_txn.filter(month_to_date("txn_post_dt", bd))
    codes = plan_code.filter(F.col("tcat_cd").isin(list(categories)))
    cond = ((txn["txn_lvl_proc_option_set_id"] == codes["tlp_option_set"].cast("string"))
            & (txn["reasgned_txn_cat_cd"] == codes["tcat_cd"].cast("string")))
    joined = inner_join(txn, codes, cond)
    return sort_report(
        joined,
        [txn["txn_post_dt"], txn["txn_lvl_proc_option_set_id"], txn["acct_id"]],
        [
            codes["bt_desc"].alias("epp_desc"),
            pad_id(txn["acct_id"], 11).alias("acct_id"),
            txn["acct_seq_num"],
            txn["txn_post_dt"].alias("epp_posted_dt"),
            txn["txn_dt"].alias("epp_txn_dt"),
            txn["txn_exp_dt"].alias("epp_expiry_dt"),
            txn["txn_amt"].alias("epp_txn_amt"),
            txn["pmt_rte"].alias("monthly_epp_pymt_amt"),
        ],
    )
