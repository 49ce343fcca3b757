"""RPT-4 ``adjustment_transactions``: back-office adjustments with decoded function names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardflow.functions.columns import decode, pad_id
from cardflow.operators.sorting import sort_report

# Fixed values of the original job: accounting-function codes and their labels, in rule order.
ACCOUNTING_FUNCTIONS = {
    "DBT": "DEBIT",
    "CRT": "CREDIT",
    "DRV": "DEBIT REVERSAL",
    "CRV": "CREDIT REVERSAL",
    "DAJ": "DEBIT ADJUSTMENT",
    "CAJ": "CREDIT ADJUSTMENT",
    "DAR": "DEBIT ADJUSTMENT REVERSAL",
    "CAR": "CREDIT ADJUSTMENT REVERSAL",
    "PFC": "PURCHASE FINANCE CHARGE DEBIT",
    "CFC": "CASH FINANCE CHARGE DEBIT",
    "FDA": "FINANCE CHARGE DEBIT ADJUSTMENT",
    "FCA": "FINANCE CHARGE CREDIT ADJUSTMENT",
    "FDV": "FINANCE CHARGE DEBIT ADJUSTMENT REVERSAL",
    "FCV": "FINANCE CHARGE CREDIT ADJUSTMENT REVERSAL",
    "ASD": "AUTO SMALL BALANCE WRITE OFF DEBIT",
    "ASC": "AUTO SMALL BALANCE WRITE OFF CREDIT",
    "MSD": "MANUAL AUTO SMALL BALANCE WRITE OFF DEBIT",
    "MSC": "MANUAL AUTO SMALL BALANCE WRITE OFF CREDIT",
    "RDB": "REBATE DEBIT",
    "RCR": "REBATE CREDIT",
    "CBR": "CREDIT BALANCE REFUND DEBIT",
    "PAY": "PAYMENT",
    "PRV": "PAYMENT REVERSAL",
    "PRF": "PAYMENT REVERSAL WITH RETURNED CHECK FEE",
    "PRN": "PAYMENT REVERSAL - NO RETURNED CHECK FEE",
    "CPF": "PURCHASE FINANCE CHARGE CREDIT",
    "CCF": "CASH FINANCE CHARGE CREDIT",
    "SCR": "CREDIT - SYSTEM GENERATED",
    "WPF": "AUTO WRITE OFF PURCHASE FINANCE CHARGE",
    "WCF": "AUTO WRITE OFF CASH FINANCE CHARGE",
    "CBD": "CREDIT BACKDATED",
}
UNKNOWN_FUNCTION = "ERROR"
BACK_OFFICE_SOURCE = "BO"
EXCLUDED_FUNCTION = "PAY"

OUTPUT = ["acct_id", "acct_seq_num", "txn_posted_dt", "txn_dt", "trans_cd", "acctg_func", "merch_nm", "txn_amt"]


def adjustment_transactions(txn_master: DataFrame) -> DataFrame:
    """Back-office rows except payments (a NULL function code drops too), whole table, sorted
    by padded id, sequence, posted date and posting sequence (the last is not in the output).

    The original projected the amount through a CASE whose branches are equal; it is the plain
    column here (no sign flip is implied by the data).
    """
    rows = txn_master.filter((F.col("txn_src_cd") == BACK_OFFICE_SOURCE)
                             & (F.col("acctg_func_cd") != EXCLUDED_FUNCTION))
    out = rows.select(
        pad_id("acct_id", 11).alias("acct_id"),
        "acct_seq_num",
        "txn_posted_dt",
        "txn_dt",
        pad_id("outpt_txn_intrnl_cd", 4).alias("trans_cd"),
        decode("acctg_func_cd", ACCOUNTING_FUNCTIONS, UNKNOWN_FUNCTION).alias("acctg_func"),
        "merch_nm",
        "txn_amt",
        "tm_posted_seq_num",
    )
    return sort_report(out, ["acct_id", "acct_seq_num", "txn_posted_dt", "tm_posted_seq_num"], OUTPUT)
