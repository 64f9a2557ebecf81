"""Raw, all-text loan, click-stream, attribute and financial tables derived from the given test tables.

Each column is an SQL expression that Spark and DuckDB both read the same way. See FIXTURES.md.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_CUSTOMER = "concat('CUS_', CAST({} AS STRING))"

ATTRIBUTES = {
    "Customer_ID": "concat(' CUS_', CAST(c_custkey AS STRING), ' ')",
    "Age": """CASE WHEN c_custkey % 11 = 0 THEN concat(CAST(c_custkey % 100 AS STRING), '_')
        WHEN c_custkey % 13 = 0 THEN '-500'
        WHEN c_custkey % 17 = 0 THEN NULL
        ELSE CAST(c_custkey % 110 AS STRING) END""",
    "Occupation": """CASE WHEN c_custkey % 7 = 0 THEN '_______'
        WHEN c_custkey % 19 = 0 THEN ''
        WHEN c_custkey % 23 = 0 THEN NULL
        ELSE concat('Media_', c_mktsegment) END""",
    "snapshot_date": """CASE WHEN c_custkey % 37 = 3 THEN '1996/05/01'
        WHEN c_custkey % 41 = 5 THEN NULL
        WHEN c_custkey % 43 = 6 THEN '1996'
        WHEN c_custkey % 47 = 7 THEN '1996-1-1'
        WHEN c_custkey % 12 = 4 THEN '1996-06-01'
        ELSE concat('1996-', lpad(CAST(1 + c_custkey % 12 AS STRING), 2, '0'), '-01') END""",
}

CLICKSTREAM = {
    **{
        f"fe_{k}": f"""CASE WHEN event_id % 103 = {k} THEN NULL
        WHEN event_id % 107 = {k} THEN concat(CAST(event_id % 50 AS STRING), '.7')
        WHEN event_id % 109 = {k} THEN 'n/a'
        WHEN event_id % 113 = {k} THEN '-.5'
        ELSE CAST(CAST(floor(value * {k}) AS BIGINT) - event_id % {k + 3} AS STRING) END"""
        for k in range(1, 21)
    },
    "Customer_ID": _CUSTOMER.format("user_id"),
    "snapshot_date": """CASE WHEN event_id % 197 = 5 THEN '1996-13-01'
        WHEN event_id % 191 = 7 THEN 'unknown'
        WHEN event_id % 24 = 16 THEN '1997-06-01'
        ELSE concat(CAST(1996 + CAST(floor((event_id % 24) / 12) AS INT) AS STRING), '-',
        lpad(CAST(1 + event_id % 12 AS STRING), 2, '0'), '-01') END""",
}

# An order is a loan and its lines are the instalments, two months apart; the tenth month of all has none
_BORROWER = "CAST(1 + l_orderkey % 149 AS STRING)"
_MONTHS = "(l_orderkey % 12 + 2 * l_linenumber + CASE WHEN l_orderkey % 12 + 2 * l_linenumber = 9 THEN 1 ELSE 0 END)"

LOAN_DAILY = {
    "loan_id": f"concat('CUS_', {_BORROWER}, '_', CAST(l_orderkey AS STRING))",
    "Customer_ID": f"concat('CUS_', {_BORROWER})",
    "loan_start_date": """CASE WHEN l_orderkey % 131 = 3 THEN '1995-02-30'
        WHEN l_orderkey % 137 = 4 THEN 'soon' ELSE CAST(CAST(l_shipdate AS DATE) AS STRING) END""",
    "tenure": """CASE WHEN l_orderkey % 61 = 7 THEN '10.0' WHEN l_orderkey % 67 = 8 THEN 'ten'
        WHEN l_orderkey % 71 = 9 THEN NULL WHEN l_linestatus = 'O' THEN '10' ELSE '12' END""",
    "installment_num": """CASE WHEN l_orderkey % 73 = 1 THEN concat(CAST(l_linenumber AS STRING), '.9')
        ELSE CAST(l_linenumber AS STRING) END""",
    "loan_amt": """CASE WHEN l_orderkey % 79 = 2 THEN '-3.0' WHEN l_orderkey % 83 = 3 THEN '12.5_'
        WHEN l_orderkey % 89 = 4 THEN NULL
        ELSE CAST(CAST(floor(l_extendedprice) AS BIGINT) AS STRING) END""",
    "due_amt": """CASE WHEN l_orderkey % 97 = 0 THEN '0.0'
        WHEN l_orderkey % 101 = 5 THEN NULL WHEN l_orderkey % 103 = 6 THEN 'none'
        ELSE CAST(floor(l_extendedprice * 10) / 100 AS STRING) END""",
    "paid_amt": """CASE WHEN l_returnflag = 'R' THEN '0.0'
        WHEN l_returnflag = 'A' THEN CAST(floor(l_extendedprice * 25) / 100 AS STRING)
        ELSE CAST(floor(l_extendedprice * 10) / 100 AS STRING) END""",
    "overdue_amt": """CASE WHEN l_orderkey % 107 = 7 THEN NULL WHEN l_returnflag = 'R'
        THEN CAST(floor(l_extendedprice * 10 * (l_quantity % 5)) / 100 AS STRING) ELSE '0.0' END""",
    "balance": "CAST(floor(l_extendedprice * (1 - l_discount) * 100) / 100 AS STRING)",
    "snapshot_date": f"""CASE WHEN l_linenumber = 2 AND l_orderkey % 53 = 8 THEN 'n.d.'
        ELSE concat(CAST(1995 + CAST(floor({_MONTHS} / 12) AS INT) AS STRING), '-',
        lpad(CAST(1 + {_MONTHS} % 12 AS STRING), 2, '0'), '-01') END""",
}

FINANCIALS = {
    "Customer_ID": _CUSTOMER.format("o_custkey"),
    "Annual_Income": """concat(CAST(floor(o_totalprice * 1000) / 100 AS STRING),
        CASE WHEN o_orderkey % 5 = 0 THEN '_' ELSE '' END)""",
    "Monthly_Inhand_Salary": """CASE WHEN o_orderkey % 29 = 0 THEN '0.0'
        ELSE CAST(floor(o_totalprice * 8) / 100 AS STRING) END""",
    "Changed_Credit_Limit": """CASE WHEN o_orderkey % 31 = 0 THEN '_'
        ELSE CAST(floor(o_totalprice / 10 - 5000) / 100 AS STRING) END""",
    "Outstanding_Debt": "CAST(floor(o_totalprice * 33) / 100 AS STRING)",
    "Credit_Utilization_Ratio": "CAST(o_orderkey % 100 AS STRING)",
    "Total_EMI_per_month": "CAST(o_orderkey % 500 AS STRING)",
    "Amount_invested_monthly": """CASE WHEN o_orderkey % 13 = 0 THEN '__10000__'
        ELSE CAST(floor(o_totalprice) / 100 AS STRING) END""",
    "Monthly_Balance": """CASE WHEN o_orderkey % 37 = 0 THEN NULL
        ELSE CAST(floor(o_totalprice * 2) / 100 AS STRING) END""",
    "Num_Bank_Accounts": "CAST(o_orderkey % 25 AS STRING)",
    "Num_Credit_Card": "CAST(o_orderkey % 9 AS STRING)",
    "Interest_Rate": "CAST(o_orderkey % 34 AS STRING)",
    "Num_of_Loan": """CASE WHEN o_orderkey % 17 = 0 THEN '3_' WHEN o_orderkey % 19 = 0 THEN '-100'
        ELSE CAST(o_orderkey % 40 AS STRING) END""",
    "Delay_from_due_date": "CAST(o_orderkey % 60 - 5 AS STRING)",
    "Num_of_Delayed_Payment": "CASE WHEN o_orderkey % 23 = 0 THEN '8_' ELSE CAST(o_orderkey % 28 AS STRING) END",
    "Num_Credit_Inquiries": "CAST(o_orderkey % 45 AS STRING)",
    "Credit_Mix": """CASE WHEN o_orderkey % 6 = 0 THEN '_' WHEN o_orderkey % 41 = 0 THEN NULL
        WHEN o_orderstatus = 'F' THEN 'Good' ELSE 'Standard' END""",
    "Payment_Behaviour": """CASE WHEN o_orderkey % 14 = 0 THEN '!@9#%8'
        WHEN o_orderkey % 211 = 0 THEN 'Rare_payments'
        ELSE concat('Spent_', replace(o_orderpriority, '-', '_')) END""",
    "Type_of_Loan": """CASE WHEN o_orderkey % 8 = 0 THEN '_' WHEN o_orderkey % 43 = 0 THEN NULL
        ELSE 'Auto Loan, Payday Loan' END""",
    "Credit_History_Age": """CASE WHEN o_orderkey % 10 = 0 THEN 'NA' WHEN o_orderkey % 47 = 0 THEN '_'
        WHEN o_orderkey % 53 = 0 THEN NULL
        ELSE concat(CAST(o_orderkey % 30 AS STRING), ' Years and ', CAST(o_orderkey % 12 AS STRING), ' Months') END""",
    "Payment_of_Min_Amount": """CASE WHEN o_orderkey % 3 = 0 THEN 'NM' WHEN o_orderkey % 59 = 0 THEN '_'
        ELSE 'Yes' END""",
    "snapshot_date": """CASE WHEN o_orderkey % 173 = 9 THEN '95-01'
        WHEN CAST(date_trunc('month', o_orderdate) AS DATE) = DATE '1997-05-01' THEN '1997-06-01'
        ELSE CAST(CAST(date_trunc('month', o_orderdate) AS DATE) AS STRING) END""",
}

# raw table: (test table, columns)
RAW_TABLES = {
    "clickstream": ("events", CLICKSTREAM),
    "attributes": ("customer", ATTRIBUTES),
    "financials": ("orders", FINANCIALS),
    "loan_daily": ("lineitem", LOAN_DAILY),
}


def raw_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    table, columns = RAW_TABLES[name]
    return spark.read.parquet(f"{sf_dir}/{table}.parquet").selectExpr(*[f"{e} AS {c}" for c, e in columns.items()])


def raw_sql(name: str) -> str:
    table, columns = RAW_TABLES[name]
    return f"SELECT {', '.join(f'{e} AS {c}' for c, e in columns.items())} FROM {table}"
