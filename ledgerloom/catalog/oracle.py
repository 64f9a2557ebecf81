"""DuckDB SQL for the registered queries, written on its own from the table definitions.

Relations are named and may use each other; a query's text is its select with the relations it needs in front.
"""

from __future__ import annotations

import re

from ledgerloom import fixed_values as fv
from ledgerloom.catalog.adapters import RAW_TABLES, raw_sql
from ledgerloom.catalog.queries import SHORT

_RELATIONS: dict[str, str] = {}


def _with(select: str) -> str:
    """Put the relations that a select uses, directly or not, in front of it."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in _RELATIONS:
            if name not in needed and re.search(rf"\b{name}\b", text):
                visit(_RELATIONS[name])
                if name not in needed:
                    needed.append(name)

    visit(select)
    parts = ",\n".join(f"{name} AS ({_RELATIONS[name]})" for name in needed)
    return f"WITH {parts}\n{select}" if needed else select


def _columns(*parts: str) -> str:
    return ",\n  ".join(parts)


def _union(selects) -> str:
    return "\nUNION ALL\n".join(selects)


# Silver


def _int(c: str) -> str:
    return rf"""CASE WHEN NOT regexp_matches({c}, '^\s*[+-]?[0-9]*\.[0-9]*\s*$') THEN TRY_CAST({c} AS INTEGER)
      WHEN regexp_matches({c}, '^\s*[+-]?\.') THEN 0
      ELSE TRY_CAST(regexp_extract({c}, '([+-]?[0-9]+)\.', 1) AS INTEGER) END"""


def _date(c: str) -> str:
    """A year, or a year and a month, stand for their first day."""
    return rf"""CASE WHEN regexp_matches({c}, '^\d{{4}}$') THEN TRY_CAST({c} || '-01-01' AS DATE)
      WHEN regexp_matches({c}, '^\d{{4}}-\d{{1,2}}$') THEN TRY_CAST({c} || '-01' AS DATE)
      WHEN regexp_matches({c}, '^\d{{4}}-\d{{1,2}}-\d{{1,2}}$') THEN TRY_CAST({c} AS DATE) END"""


SILVER_COLUMNS = {
    "click": {
        **{c: _int(c) for c in fv.CLICK_FEATURES},
        "Customer_ID": "trim(Customer_ID)",
        "snapshot_date": _date("snapshot_date"),
    },
    "attr": {
        "Customer_ID": "trim(Customer_ID)",
        "Age": r"CASE WHEN regexp_matches(Age, '^-?\d+$') THEN TRY_CAST(Age AS INTEGER) END",
        "Occupation": r"""CASE WHEN regexp_matches(replace(lower(Occupation), '_', ' '), '^\s*$') THEN 'unknown'
            ELSE replace(lower(Occupation), '_', ' ') END""",
        "snapshot_date": _date("snapshot_date"),
    },
    "fin": {
        "Customer_ID": "trim(Customer_ID)",
        **{c: f"TRY_CAST(regexp_replace({c}, '_$', '') AS DOUBLE)" for c in fv.FINANCIAL_AMOUNTS},
        **{c: _int(c) for c in fv.FINANCIAL_COUNTS},
        "Credit_Mix": """CASE WHEN Credit_Mix = '_' OR length(trim(Credit_Mix)) = 0 THEN 'unknown'
            ELSE lower(Credit_Mix) END""",
        "Payment_Behaviour": r"""CASE WHEN regexp_matches(Payment_Behaviour, '^[a-zA-Z0-9_\s-]+$')
            THEN lower(replace(Payment_Behaviour, '_', ' ')) ELSE 'unknown' END""",
        "Type_of_Loan": """CASE WHEN Type_of_Loan IS NULL OR Type_of_Loan IN ('', '_') THEN 'Not Specified'
            ELSE Type_of_Loan END""",
        "Credit_History_Age": "Credit_History_Age",
        "Payment_of_Min_Amount": """CASE WHEN Payment_of_Min_Amount = 'NM' THEN 'Not Measured'
            WHEN Payment_of_Min_Amount IS NULL OR Payment_of_Min_Amount IN ('', '_') THEN 'Unknown'
            ELSE Payment_of_Min_Amount END""",
        "snapshot_date": _date("snapshot_date"),
        "Credit_History_Months": r"""CASE WHEN Credit_History_Age IS NULL OR Credit_History_Age IN ('', '_') THEN NULL
            ELSE 12 * coalesce(TRY_CAST(regexp_extract(Credit_History_Age, '(\d+)\s*Years?', 1) AS INTEGER), 0)
              + coalesce(TRY_CAST(regexp_extract(Credit_History_Age, '(\d+)\s*Months?', 1) AS INTEGER), 0) END""",
    },
    "loan": {
        "loan_id": "loan_id",
        "Customer_ID": "trim(Customer_ID)",
        "loan_start_date": _date("loan_start_date"),
        **{c: _int(c) for c in fv.LOAN_COUNTS},
        **{c: f"TRY_CAST({c} AS DOUBLE)" for c in fv.LOAN_AMOUNTS},
        "snapshot_date": _date("snapshot_date"),
    },
}
KEYS = {short: fv.CUSTOMER_KEY for short in SHORT}
RANGED = {
    "click": fv.CLICK_FEATURES,
    "attr": ("Age",),
    "fin": (*fv.FINANCIAL_AMOUNTS, *fv.FINANCIAL_COUNTS),
    "loan": (*fv.LOAN_COUNTS, *fv.LOAN_AMOUNTS),
}
_STRICT_DECIMAL = r"NOT regexp_matches({0}, '^\d+(\.\d+)?$')"
_LOOSE_DECIMAL = r"NOT regexp_matches(regexp_replace({0}, '_$', ''), '^[0-9]+(\.[0-9]+)?$')"
_INTEGER = r"NOT regexp_matches({0}, '^-?\d+$')"
_DATE = r"NOT regexp_matches({0}, '^\d{{4}}-\d{{2}}-\d{{2}}$')"
BROKEN = {
    "click": {**{c: _INTEGER for c in fv.CLICK_FEATURES}, "snapshot_date": _DATE},
    "attr": {"Age": _INTEGER, "snapshot_date": _DATE},
    "fin": {
        **{c: _LOOSE_DECIMAL for c in fv.FINANCIAL_AMOUNTS},
        **{c: _INTEGER for c in fv.FINANCIAL_COUNTS},
        "snapshot_date": _DATE,
    },
    "loan": {
        **{c: _DATE for c in fv.LOAN_DATES},
        **{c: _INTEGER for c in fv.LOAN_COUNTS},
        **{c: _STRICT_DECIMAL for c in fv.LOAN_AMOUNTS},
    },
}


def _rank(keys, columns) -> str:
    """Position of a row within its key by all other columns, nulls first."""
    rest = ", ".join(f"{c} NULLS FIRST" for c in columns if c not in keys)
    return f"row_number() OVER (PARTITION BY {', '.join(keys)} ORDER BY {rest})"


def _first(relation: str, keys, columns) -> str:
    return f"SELECT {', '.join(columns)} FROM {relation} QUALIFY {_rank(keys, columns)} = 1"


for _short, _name in SHORT.items():
    _RELATIONS[f"raw_{_short}"] = raw_sql(_name)
    _RELATIONS[f"silver_{_short}"] = (
        f"SELECT {_columns(*[f'{e} AS {c}' for c, e in SILVER_COLUMNS[_short].items()])} FROM raw_{_short}"
    )

_RELATIONS["first_fin"] = _first("silver_fin", fv.CUSTOMER_KEY, list(SILVER_COLUMNS["fin"]))
_RELATIONS["first_loan"] = _first("silver_loan", fv.LOAN_KEY, list(SILVER_COLUMNS["loan"]))

# Gold: click-stream

_RELATIONS["stats_click"] = "SELECT {} FROM silver_click".format(
    _columns(
        *[f"avg({c}) AS {c}_mean, nullif(stddev_samp({c}), 0) AS {c}_sd" for c in fv.CLICK_FEATURES]
    )
)


def _sigma(c: str) -> str:
    low, high = f"({c}_mean - 3 * {c}_sd)", f"({c}_mean + 3 * {c}_sd)"
    return _columns(
        f"CAST(CASE WHEN {c} < {low} THEN {low} WHEN {c} > {high} THEN {high} ELSE {c} END AS DOUBLE) AS {c}",
        f"{c} AS {c}_raw",
        f"CAST(CASE WHEN {c} < {low} OR {c} > {high} THEN 1 ELSE 0 END AS INTEGER) AS {c}_is_outlier",
    )


_RELATIONS["gold_click"] = (
    f"SELECT {_columns(*[_sigma(c) for c in fv.CLICK_FEATURES])}, Customer_ID, snapshot_date"
    " FROM silver_click, stats_click"
)

# Gold: attributes

_RELATIONS["gold_attr"] = """SELECT Customer_ID, CASE WHEN Age BETWEEN 18 AND 90 THEN Age END AS Age, Occupation,
  snapshot_date,
  CASE WHEN Age < 18 OR Age > 90 THEN 1 ELSE 0 END AS age_outlier_flag,
  CASE WHEN Age IS NULL OR Age < 18 OR Age > 90 THEN 1 ELSE 0 END AS age_missing_flag,
  CASE WHEN Occupation = 'unknown' THEN 1 ELSE 0 END AS unknown_occupation_flag
FROM silver_attr"""

# Gold: financials

_CAPS = {"Annual_Income": "2000000.0", "Num_of_Loan": "20", "Num_Bank_Accounts": "20", "Num_Credit_Inquiries": "30"}
_RATIOS = {
    "emi_to_income_ratio": ("Total_EMI_per_month", "Monthly_Inhand_Salary"),
    "debt_to_income_ratio": ("Outstanding_Debt", "Annual_Income"),
    "investment_to_income_ratio": ("Amount_invested_monthly", "Monthly_Inhand_Salary"),
    "loan_per_card_ratio": ("Num_of_Loan", "Num_Credit_Card"),
    "credit_inquiries_per_account": ("Num_Credit_Inquiries", "Num_Bank_Accounts"),
    "credit_limit_change_ratio": ("Changed_Credit_Limit", "Monthly_Inhand_Salary"),
}
_IMPUTED = ("Amount_invested_monthly", "Num_of_Loan", "Monthly_Balance")
_FLAGS = {
    **{f"{c.lower()}_outlier_flag": f"{c} > {cap}" for c, cap in _CAPS.items()},
    **{f"{c.lower()}_missing_flag": f"{c} IS NULL" for c in _IMPUTED},
    "credit_mix_unknown_flag": "Credit_Mix = 'unknown'",
    "payment_behaviour_unknown_flag": "Payment_Behaviour = 'unknown'",
    "payment_min_not_measured_flag": "Payment_of_Min_Amount = 'Not Measured'",
}


def _fin_features(relation: str) -> str:
    kept = [
        f"CASE WHEN {c} > {_CAPS[c]} THEN {_CAPS[c]} ELSE {c} END AS {c}" if c in _CAPS else c
        for c in SILVER_COLUMNS["fin"]
        if c != "Credit_History_Age"
    ]
    flags = [f"CASE WHEN {cond} THEN 1 ELSE 0 END AS {name}" for name, cond in _FLAGS.items()]
    derived = [
        f"CASE WHEN {d} > 0 THEN CAST({n} AS DOUBLE) / CAST({d} AS DOUBLE) END AS {name}"
        for name, (n, d) in _RATIOS.items()
    ]
    logs = [f"CASE WHEN {c} + 1 > 0 THEN ln({c} + 1) END AS log_{c}" for c in ("Annual_Income", "Outstanding_Debt")]
    inner = f"SELECT {_columns(*kept, *flags)} FROM {relation}"
    return f"SELECT *, {_columns(*derived, *logs)} FROM ({inner})"


_RELATIONS["features_fin"] = _fin_features("silver_fin")
_RELATIONS["features_first_fin"] = _fin_features("first_fin")
_RELATIONS["categories"] = (
    "SELECT Payment_Behaviour, count(*) AS n FROM silver_fin GROUP BY Payment_Behaviour"
)
_RELATIONS["means"] = f"SELECT {_columns(*[f'avg({c}) AS mean_{c}' for c in _IMPUTED])} FROM features_fin"
_FILL = [f"round(coalesce(CAST({c} AS DOUBLE), mean_{c}), 6) AS {c}" for c in _IMPUTED]
_GROUPED = "CASE WHEN c.n < 100 THEN 'other' ELSE f.Payment_Behaviour END AS Payment_Behaviour_grouped"
_IMPUTE = ", ".join(f"coalesce(CAST(f.{c} AS DOUBLE), mean_{c}) AS {c}" for c in _IMPUTED)
_RELATIONS["gold_fin"] = f"""SELECT f.* REPLACE ({_IMPUTE}), {_GROUPED}
FROM features_first_fin f LEFT JOIN categories c USING (Payment_Behaviour), means"""

# Gold: loans

_LOAN_FEATURES = """SELECT *, round(ratio, 4) AS payment_ratio,
  round(CASE WHEN ratio > 2.0 THEN 2.0 ELSE ratio END, 4) AS payment_ratio_clipped,
  CASE WHEN due_amt > 0 AND paid_amt < due_amt THEN 1 ELSE 0 END AS underpaid_flag,
  CASE WHEN overdue_amt > 0 THEN 1 ELSE 0 END AS has_overdue_flag,
  CASE WHEN balance > 8000 THEN 1 ELSE 0 END AS large_balance_flag,
  CASE WHEN tenure = 10 THEN 1 ELSE 0 END AS constant_tenure_flag,
  round(CASE WHEN loan_amt > 0 THEN paid_amt / loan_amt ELSE 0 END, 4) AS percent_paid,
  round(CASE WHEN overdue_amt + 1 > 0 THEN ln(overdue_amt + 1) END, 4) AS log_overdue_amt,
  round(CASE WHEN loan_amt > 0 THEN balance / loan_amt ELSE 0 END, 4) AS balance_to_loan_ratio
FROM (SELECT *, CAST(CASE WHEN due_amt > 0 THEN paid_amt / due_amt ELSE 0 END AS DOUBLE) AS ratio FROM {})"""
_RELATIONS["loan_rows"] = f"SELECT * EXCLUDE (ratio) FROM ({_LOAN_FEATURES.format('silver_loan')})"
_RELATIONS["gold_loan"] = f"SELECT * EXCLUDE (ratio) FROM ({_LOAN_FEATURES.format('first_loan')})"

# Labels

_REAL = "coalesce(CAST(TRY_CAST({0} AS DOUBLE) AS REAL), 0) AS {0}"
_RELATIONS["lms_typed"] = f"""SELECT loan_id, Customer_ID, {_date('loan_start_date')} AS loan_start_date,
  coalesce({_int('tenure')}, 0) AS tenure, coalesce({_int('installment_num')}, 0) AS installment_num,
  {_columns(*[_REAL.format(c) for c in ('loan_amt', 'due_amt', 'paid_amt', 'overdue_amt', 'balance')])},
  {_date('snapshot_date')} AS snapshot_date,
  coalesce({_int('installment_num')}, 0) AS mob,
  CAST(coalesce(ceil(CAST(CAST(TRY_CAST(overdue_amt AS DOUBLE) AS REAL) AS DOUBLE)
    / nullif(CAST(CAST(TRY_CAST(due_amt AS DOUBLE) AS REAL) AS DOUBLE), 0)), 0) AS INTEGER) AS installments_missed
FROM raw_loan"""
_RELATIONS["lms_missed"] = """SELECT *, CASE WHEN installments_missed > 0
  THEN CAST(snapshot_date - to_months(installments_missed) AS DATE) END AS first_missed_date FROM lms_typed"""
_RELATIONS["lms_silver"] = """SELECT *, CAST(CASE WHEN overdue_amt > 0 THEN snapshot_date - first_missed_date ELSE 0 END
  AS INTEGER) AS dpd FROM lms_missed"""


def _labels(dpd: int, mob: int) -> str:
    return f"""SELECT loan_id, Customer_ID, CASE WHEN dpd >= {dpd} THEN 1 ELSE 0 END AS label,
  '{dpd}dpd_{mob}mob' AS label_def, snapshot_date FROM lms_silver WHERE mob = {mob}"""


_RELATIONS["labels_30_6"] = _labels(30, 6)

# Training table

_FEATURES = {
    "click": [f"{c}{suffix}" for suffix in ("", "_raw", "_is_outlier") for c in fv.CLICK_FEATURES],
    "attr": ["Age", "Occupation", "age_outlier_flag", "age_missing_flag", "unknown_occupation_flag"],
    "fin": [
        *[c for c in SILVER_COLUMNS["fin"] if c not in (*fv.CUSTOMER_KEY, "Credit_History_Age")],
        *_FLAGS,
        *_RATIOS,
        "log_Annual_Income",
        "log_Outstanding_Debt",
        "Payment_Behaviour_grouped",
    ],
    "loan": [
        *[c for c in SILVER_COLUMNS["loan"] if c not in ("loan_id", *fv.CUSTOMER_KEY)],
        *fv.LOAN_SUMMARY_COLUMNS,
        *fv.LOAN_FLAGS,
    ],
}
_ROUNDED = (*fv.CLICK_FEATURES, *_IMPUTED, "log_Annual_Income", "log_Outstanding_Debt")


def _training(as_of: bool) -> str:
    """Labels with each gold table."""
    target = "CAST(snapshot_date - INTERVAL 6 MONTH AS DATE)" if as_of else "snapshot_date"
    joins, columns, parts = [], [], []
    for short, name in SHORT.items():
        keys = ("loan_id", "Customer_ID") if short == "loan" else ("Customer_ID",)
        kept = [*keys, "day", *_FEATURES[short]]
        moved = f"(SELECT * EXCLUDE (snapshot_date), snapshot_date AS day FROM gold_{short} WHERE snapshot_date IS NOT NULL)"
        parts.append(f"t_{short} AS ({_first(moved, (*keys, 'day'), kept)})")
        matched = " AND ".join([f"l.{k} = t_{short}.{k}" for k in keys])
        joins.append(
            f"ASOF LEFT JOIN t_{short} ON {matched} AND l.target >= t_{short}.day"
            if as_of
            else f"LEFT JOIN t_{short} ON {matched} AND l.target = t_{short}.day"
        )
        columns += [
            f"round(t_{short}.{c}, 6) AS {c}" if c in _ROUNDED else f"t_{short}.{c}" for c in _FEATURES[short]
        ]
        columns.append(f"t_{short}.day AS {name}_snapshot_date")
    labels = f"(SELECT * REPLACE (trim(Customer_ID) AS Customer_ID), {target} AS target FROM labels_30_6) l"
    select = f"SELECT l.* EXCLUDE (target), {_columns(*columns)} FROM {labels}\n" + "\n".join(joins)
    return f"WITH {', '.join(parts)} {select}"


# The queries


def _invalid(short: str) -> str:
    return _union(
        f"SELECT '{c}' AS \"column\", CAST(count_if({broken.format(c)}) AS BIGINT) AS invalid FROM raw_{short}"
        for c, broken in BROKEN[short].items()
    )


def _samples(short: str) -> str:
    cells = _union(
        f"SELECT '{c}' AS \"column\", Customer_ID, {c} AS value FROM raw_{short} WHERE {broken.format(c)}"
        for c, broken in BROKEN[short].items()
    )
    position = 'row_number() OVER (PARTITION BY "column" ORDER BY Customer_ID, value)'
    return f"SELECT *, CAST({position} AS INTEGER) AS position FROM ({cells}) QUALIFY position <= 3"


def _nulls(relation: str, columns) -> str:
    return _union(
        f"SELECT '{c}' AS \"column\", CAST(count_if({c} IS NULL) AS BIGINT) AS nulls FROM {relation}" for c in columns
    )


def _duplicates(relation: str, keys) -> str:
    grouped = f"SELECT count(*) AS n FROM {relation} GROUP BY {', '.join(keys)}"
    return f"""SELECT CAST(coalesce(sum(n), 0) AS BIGINT) AS total_rows, count(*) AS distinct_keys,
  CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS duplicate_rows FROM ({grouped})"""


def _missing_months(relation: str) -> str:
    return f"""SELECT m AS missing_month FROM (
    SELECT CAST(unnest(generate_series(CAST(date_trunc('month', min(snapshot_date)) AS TIMESTAMP),
      CAST(max(snapshot_date) AS TIMESTAMP), INTERVAL 1 MONTH)) AS DATE) AS m FROM {relation})
  WHERE m >= (SELECT min(snapshot_date) FROM {relation})
    AND m NOT IN (SELECT snapshot_date FROM {relation} WHERE snapshot_date IS NOT NULL)"""


def _ranges(relation: str, columns) -> str:
    return _union(
        f"SELECT '{c}' AS \"column\", round(CAST(min({c}) AS DOUBLE), 6) AS min,"
        f" round(CAST(max({c}) AS DOUBLE), 6) AS max, round(avg({c}), 6) AS mean FROM {relation}"
        for c in columns
    )


def _summary(relation: str, columns) -> str:
    return _union(
        f"SELECT '{c}' AS \"column\", count({c}) AS count, round(avg({c}), 6) AS mean,"
        f" round(stddev_samp({c}), 6) AS stddev, round(CAST(min({c}) AS DOUBLE), 6) AS min,"
        f" round(CAST(max({c}) AS DOUBLE), 6) AS max FROM {relation}"
        for c in columns
    )


def _quartile_ranks(relation: str, columns) -> str:
    return _union(
        f"SELECT '{c}' AS \"column\", '{q}' AS quartile, count({c}) AS count, true AS within FROM {relation}"
        for c in columns
        for q in ("p25", "p50", "p75")
    )


def _misfit_lines(short: str) -> str:
    """Customers whose number ends in 3 have a field too many, those with 7 one too few."""
    columns = list(RAW_TABLES[SHORT[short]][1])
    digit = "CAST(regexp_extract(Customer_ID, '([0-9]+)', 1) AS BIGINT) % 10"
    return f"""SELECT nullif({columns[0]}, '') AS first_field, CASE {digit} WHEN 3 THEN {len(columns) + 1} ELSE {len(columns) - 1} END
        AS fields, {len(columns)} AS expected, CASE {digit} WHEN 3 THEN 'too many fields' ELSE 'too few fields' END AS reason
        FROM raw_{short} WHERE {digit} IN (3, 7)"""


def _accounts(short: str) -> str:
    name = SHORT[short]
    parts = {"lines": "", "rejects": "WHERE d IN (3, 7)", "bronze": "WHERE d NOT IN (3, 7)"}
    rows = f"(SELECT CAST(regexp_extract(Customer_ID, '([0-9]+)', 1) AS BIGINT) % 10 AS d FROM raw_{short})"
    return _union(f"SELECT '{name}' AS \"table\", '{k}' AS \"where\", count(*) AS rows FROM {rows} {w}" for k, w in parts.items())


def _schema_report() -> str:
    """By the remainder of the month: 0 has no balance, 1 has a channel, 2 has two typed columns, the oldest has 3."""
    casts = {"string": str, "date": _date, "int": _int, "float": "TRY_CAST({} AS DOUBLE)".format}
    typed = {"installment_num": "int", "overdue_amt": "double"}
    parts = []
    for name, wanted in [*fv.LABEL_TYPES.items(), ("channel", None)]:
        if name == "snapshot_date":
            continue
        status, stored, lost = "'same'", "'string'", "0"
        if name == "channel":
            status, stored = "CASE WHEN g = 1 THEN 'added' ELSE 'missing' END", "CASE WHEN g = 1 THEN 'string' END"
        else:
            lost = f"count_if({name} IS NOT NULL AND {casts[wanted](name)} IS NULL)"
        if name == "balance":
            status, stored = "CASE WHEN g = 0 THEN 'missing' ELSE 'same' END", "CASE WHEN g <> 0 THEN 'string' END"
            lost = f"CASE WHEN g = 0 THEN 0 ELSE {lost} END"
        if name in typed:
            status = "CASE WHEN g = 2 THEN 'widened' ELSE 'same' END"
            stored = f"CASE WHEN g = 2 THEN '{typed[name]}' ELSE 'string' END"
            lost = f"CASE WHEN g = 2 THEN 0 ELSE {lost} END"
        wanted = f"'{wanted}'" if wanted else "CAST(NULL AS VARCHAR)"
        parts.append(
            f"""SELECT day AS snapshot_date, '{name}' AS "column", {status} AS status, {stored} AS stored_type,
              'string' AS merged_type, {wanted} AS wanted_type, CAST({lost} AS BIGINT) AS not_castable FROM dated GROUP BY day, g"""
        )
    dated = f"SELECT * EXCLUDE (snapshot_date), {_date('snapshot_date')} AS day, month(day) % 4 AS g FROM raw_loan"
    return f"WITH dated AS (SELECT * FROM ({dated}) WHERE day IS NOT NULL) {_union(parts)}"


def _long(report: str, sql: str, named: str, metrics) -> str:
    """A report as rows (stage, dataset, report, column, metric, value)."""
    stage, dataset, name = report.split("/")
    return _union(
        f"""SELECT '{stage}' AS stage, '{dataset}' AS dataset, '{name}' AS report, {named} AS "column",
          '{m}' AS metric, round(CAST({'1' if m == 'present' else m} AS DOUBLE), 6) AS value FROM ({sql})"""
        for m in metrics
    )


def _reports(found: dict[str, str]) -> str:
    parts, counts = [], ("total_rows", "distinct_keys", "duplicate_rows")
    column, moments = '"column"', ("count", "mean", "stddev", "min", "max")
    for short, name in SHORT.items():
        sample = "concat_ws('|', \"column\", Customer_ID, value)"
        month = "CAST(missing_month AS VARCHAR)"
        parts += [
            _long(f"silver/{name}/invalid", found[f"invalid_summary_{short}"], column, ["invalid"]),
            _long(f"silver/{name}/invalid_samples", found[f"invalid_samples_{short}"], sample, ["position"]),
            _long(f"silver/{name}/nulls", found[f"null_profile_{short}"], column, ["nulls"]),
            _long(f"silver/{name}/duplicates", found[f"dup_keys_{short}"], "''", counts),
            _long(f"silver/{name}/missing_months", found[f"missing_months_{short}"], month, ["present"]),
            _long(f"silver/{name}/ranges", found[f"range_profile_{short}"], column, ("min", "max", "mean")),
        ]
    shape = ("row_count", "features", "raw_values", "outlier_flags")
    flags = ("age_outlier_flag", "age_missing_flag", "unknown_occupation_flag")
    dated = "concat_ws('|', CAST(snapshot_date AS VARCHAR), label_def)"
    cleanup = "SELECT 'snapshot_date=' || snapshot_date AS folder, count(*) AS rows FROM labels_30_6 GROUP BY snapshot_date"
    parts += [
        _long("gold/clickstream/shape", found["click_shape"], "''", shape),
        _long("gold/attributes/flag_totals", found["flag_totals"], "''", flags),
        _long("gold/financials/rates", found["fin_rates"], "condition", ("hits", "total", "rate")),
        _long("gold/financials/null_columns", found["fin_null_columns"], column, ["nulls"]),
        _long("gold/financials/duplicates", found["dup_keys_fin"], "''", counts),
        _long("gold/financials/summary", found["feature_summary_fin"], column, moments),
        _long("gold/loan_daily/duplicates", found["dup_loan_snapshots"], "''", counts),
        _long("gold/loan_daily/summary", found["feature_summary_loan"], column, moments),
        _long("gold/loan_daily/flags", found["loan_flag_distribution"], "flag", ("value", "rows", "pct")),
        _long("label/store/cleanup", cleanup, "folder || '|kept'", ["rows"]),
        _long("label/store/labels", found["label_rate_by_snapshot"], dated, ("loans", "defaults")),
    ]
    return _union(parts)


def all_sql() -> dict[str, str]:
    found: dict[str, str] = {}
    for short in SHORT:
        silver = f"silver_{short}"
        found[f"invalid_{short}"] = _invalid(short)
        found[f"invalid_summary_{short}"] = f"SELECT * FROM ({_invalid(short)}) WHERE invalid > 0"
        found[f"invalid_samples_{short}"] = _samples(short)
        found[silver] = f"SELECT * FROM {silver}"
        found[f"null_profile_{short}"] = _nulls(silver, SILVER_COLUMNS[short])
        found[f"dup_keys_{short}"] = _duplicates(silver, KEYS[short])
        found[f"missing_months_{short}"] = _missing_months(silver)
        found[f"range_profile_{short}"] = _ranges(silver, RANGED[short])
        found[f"csv_rejects_{short}"] = _misfit_lines(short)
        found[f"csv_bronze_{short}"] = "SELECT {} FROM raw_{}".format(
            ", ".join(f"nullif({c}, '') AS {c}" for c in RAW_TABLES[SHORT[short]][1]), short
        )
    keys = "Customer_ID, snapshot_date"
    caps = ", ".join([*_CAPS, *[f"{c.lower()}_outlier_flag" for c in _CAPS]])
    flags = ", ".join(n for n in _FLAGS if not n.endswith("outlier_flag"))
    logs = "round(log_Annual_Income, 6) AS log_Annual_Income, round(log_Outstanding_Debt, 6) AS log_Outstanding_Debt"
    fin_rounded = ", ".join(f"round({c}, 6) AS {c}" for c in (*_IMPUTED, "log_Annual_Income", "log_Outstanding_Debt"))
    stats = [
        part
        for c in fv.CLICK_FEATURES
        for part in (f"round(avg({c}), 6) AS {c}_mean", f"round(stddev_samp({c}), 6) AS {c}_stddev")
    ]
    found |= {
        "dup_loan_snapshots": _duplicates("silver_loan", fv.LOAN_KEY),
        "snapshot_slice": """SELECT * REPLACE (TRY_CAST(snapshot_date AS DATE) AS snapshot_date) FROM raw_loan
            WHERE TRY_CAST(snapshot_date AS DATE) = (SELECT max(snapshot_date) FROM silver_loan)""",
        "label_silver": "SELECT * FROM lms_silver",
        "label_store": "SELECT * FROM labels_30_6",
        "label_store_strict": _labels(60, 4),
        "label_rate_by_snapshot": """SELECT snapshot_date, label_def, count(*) AS loans,
            CAST(sum(label) AS BIGINT) AS defaults FROM labels_30_6 GROUP BY ALL""",
        "month_sequence": """SELECT CAST(unnest(generate_series(
            CAST(date_trunc('month', min(loan_start_date)) AS TIMESTAMP),
            CAST(max(loan_start_date) AS TIMESTAMP), INTERVAL 1 MONTH)) AS DATE) AS snapshot_date FROM silver_loan""",
        "fin_caps": f"SELECT {keys}, {caps} FROM features_fin",
        "fin_flags": f"SELECT {keys}, {flags} FROM features_fin",
        "fin_ratios": f"SELECT {keys}, {', '.join(_RATIOS)} FROM features_fin",
        "fin_logs": f"SELECT {keys}, {logs} FROM features_fin",
        "fin_category_counts": "SELECT Payment_Behaviour, n AS rows FROM categories",
        "fin_rare_groups": f"""SELECT f.Customer_ID, f.snapshot_date, f.Payment_Behaviour, {_GROUPED}
            FROM silver_fin f LEFT JOIN categories c USING (Payment_Behaviour)""",
        "fin_imputed": f"SELECT {keys}, {', '.join(_FILL)} FROM features_fin, means",
        "fin_dedup": "SELECT * FROM first_fin",
        "fin_rates": "SELECT *, round(hits / total, 6) AS rate FROM ({})".format(
            _union(
                f"SELECT '{n}' AS condition, CAST(count_if({c}) AS BIGINT) AS hits, count(*) AS total FROM silver_fin"
                for n, c in _FLAGS.items()
            )
        ),
        "fin_null_columns": "SELECT * FROM ({}) WHERE nulls > 0".format(
            _nulls(
                "features_fin",
                [
                    *[c for c in SILVER_COLUMNS["fin"] if c != "Credit_History_Age"],
                    *_RATIOS,
                    "log_Annual_Income",
                    "log_Outstanding_Debt",
                ],
            )
        ),
        "gold_click": "SELECT * REPLACE ({}) FROM gold_click".format(
            ", ".join(f"round({c}, 6) AS {c}" for c in fv.CLICK_FEATURES)
        ),
        "gold_attr": "SELECT * FROM gold_attr",
        "gold_fin": f"SELECT * REPLACE ({fin_rounded}) FROM gold_fin",
        "gold_loan": "SELECT * FROM gold_loan",
        "loan_features": "SELECT * FROM loan_rows",
        "loan_dedup": "SELECT * FROM first_loan",
        "click_moments": f"SELECT {_columns(*stats)} FROM silver_click",
        "click_shape": """SELECT count(*) AS row_count, 20 AS features, 20 AS raw_values, 20 AS outlier_flags
            FROM silver_click""",
        "flag_totals": "SELECT {} FROM gold_attr".format(
            ", ".join(
                f"CAST(sum({c}) AS BIGINT) AS {c}"
                for c in ("age_outlier_flag", "age_missing_flag", "unknown_occupation_flag")
            )
        ),
        "loan_flag_distribution": _union(
            f"""SELECT '{c}' AS flag, {c} AS value, count(*) AS rows,
              round(100.0::DOUBLE * count(*) / (SELECT count(*) FROM gold_loan), 6) AS pct
              FROM gold_loan GROUP BY {c}"""
            for c in fv.LOAN_FLAGS
        ),
        "feature_summary_fin": _summary("gold_fin", fv.FINANCIAL_SUMMARY_COLUMNS),
        "feature_summary_loan": _summary("gold_loan", fv.LOAN_SUMMARY_COLUMNS),
        "feature_quartiles_fin": _quartile_ranks("gold_fin", fv.FINANCIAL_SUMMARY_COLUMNS),
        "feature_quartiles_loan": _quartile_ranks("gold_loan", fv.LOAN_SUMMARY_COLUMNS),
        "training_exact": _training(as_of=False),
        "training_as_of": _training(as_of=True),
        "csv_accounts": _union(map(_accounts, SHORT)),
        "label_snapshots": "SELECT * FROM labels_30_6",
        "label_snapshots_evolved": """SELECT loan_id, Customer_ID, CASE WHEN dpd >= 30 THEN 1 ELSE 0 END AS label,
            '30dpd_6mob' AS label_def, snapshot_date, CASE WHEN month(snapshot_date) % 4 = 0 THEN 0::REAL ELSE balance END AS balance,
            CASE WHEN month(snapshot_date) % 4 = 1 THEN 'c' || length(loan_id) END AS channel
            FROM lms_silver WHERE mob = 6 AND snapshot_date IS NOT NULL""",
        "schema_report_loan": _schema_report(),
        "prune_empty": """SELECT 'snapshot_date=' || CAST(snapshot_date AS VARCHAR) AS folder, count(*) AS rows,
            'kept' AS status FROM labels_30_6 GROUP BY snapshot_date
            UNION ALL SELECT * FROM (VALUES ('snapshot_date=1900-01-01', 0, 'deleted'),
              ('snapshot_date=1900-02-01', 0, 'deleted'))""",
        "full_run": _training(as_of=False),
        "full_run_as_of": _training(as_of=True),
    }
    found["gold_click_from_state"], found["gold_fin_from_state"] = found["gold_click"], found["gold_fin"]
    found["run_reports"] = _reports(found)
    merged = {name: _with_merged(sql) for name, sql in found.items()}
    return {name: _read_from_csv(sql) if "run" in name.split("_") else sql for name, sql in merged.items()}


def _read_from_csv(sql: str) -> str:
    """The same on raw tables that were CSV files in between, where an empty text becomes null."""
    for short, name in SHORT.items():
        cells = ", ".join(f"nullif({c}, '') AS {c}" for c in RAW_TABLES[name][1])
        raw = _RELATIONS[f"raw_{short}"]
        sql = sql.replace(f"raw_{short} AS ({raw})", f"raw_{short} AS (SELECT {cells} FROM ({raw}))")
    return sql


def _with_merged(sql: str) -> str:
    """Relations first, then the select's own, under one WITH."""
    whole = _with(sql)
    head, _, tail = whole.partition("\nWITH ")
    return f"{head},\n{tail}" if tail else whole
