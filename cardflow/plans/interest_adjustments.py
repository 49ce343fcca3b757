"""RPT-3 ``interest_adjustments_mtd``: month-to-date interest adjustments of one table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardflow.functions.columns import pad_id
from cardflow.functions.dates import BusinessDate, month_to_date
from cardflow.operators.sorting import sort_report

# Fixed values of the original job: transaction code and the two merchant spellings.
ADJUSTMENT_CODE = "0162"
ADJUSTMENT_MERCHANTS = ("EPP INTEREST ADJUST", "AJUST INTÉRÊTS PPE")

OUTPUT = ["acct_id", "acct_seq_num", "txn_posted_dt", "txn_dt", "txn_trans_cd", "merch_nm", "txn_amt"]


def interest_adjustments_mtd(txn_detail: DataFrame, bd: BusinessDate,
                             merchants: Sequence[str] = ADJUSTMENT_MERCHANTS,
                             trans_cd: str = ADJUSTMENT_CODE) -> DataFrame:
    """Primary-account rows with the adjustment code and merchant, posted from the month start
    to the business date at midnight (inclusive), sorted by posting time and padded id."""
    rows = txn_detail.filter(
        (F.col("acct_seq_num") == 0)
        & (F.col("txn_trans_cd") == trans_cd)
        & F.col("merch_nm").isin(list(merchants))
        & month_to_date("txn_posted_dt", bd, closed=True)
    )
    out = rows.select(pad_id("acct_id", 11).alias("acct_id"), *OUTPUT[1:])
    # ORDER BY names the output column, so the padded text id orders the rows.
    return sort_report(out, ["txn_posted_dt", "acct_id"])
