"""Building blocks of the comparison queries (DuckDB dialect).

Each block is a common table expression written from the rules of the table, not from
the Spark plan.
"""

from lendframe import schema as S
from lendframe.sources.applications import APPLICANTS_SQL

NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def texts(values) -> str:
    return "(" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + ")"


NULLS = texts(S.NULL_STRINGS)
LABELS = texts(S.ACCEPTED_LABELS)


def strip(x: str) -> str:
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def bare(x: str) -> str:
    for mark in S.CURRENCY_MARKS:
        x = f"replace({x}, '{mark}', '')"
    return strip(x)


def currency(x: str) -> str:
    return f"(CASE WHEN {bare(x)} NOT IN {NULLS} THEN {bare(x)} END)"


def number(x: str) -> str:
    return f"(CASE WHEN regexp_matches({strip(x)}, '{NUMBER}') THEN TRY_CAST({strip(x)} AS DOUBLE) END)"


def title(x: str) -> str:
    return (f"array_to_string(list_transform(regexp_extract_all(lower({x}), '([a-z]+|[^a-z]+)'), "
            "lambda w: upper(w[1:1]) || w[2:]), '')")


def mapped(x: str, mapping: dict) -> str:
    arms = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in mapping.items())
    return f"(CASE {x} {arms} ELSE {x} END)"


def clip(x: str, low=None, high=None) -> str:
    arms = "" if low is None else f"WHEN {x} < {low} THEN {low} "
    arms += "" if high is None else f"WHEN {x} > {high} THEN {high} "
    return f"(CASE {arms}ELSE {x} END)"


def bracket(x: str) -> str:
    arms = []
    for bound, label in S.SALARY_BRACKETS:
        arms.append(f"WHEN {x} <= {bound} THEN '{label}'" if bound else f"ELSE '{label}'")
    return f"(CASE WHEN {x} IS NULL OR {x} <= 0 THEN NULL {' '.join(arms)} END)"


def zone(p: str) -> str:
    return f"(CASE WHEN {p} > 0.85 THEN 'auto_approve' WHEN {p} >= 0.40 THEN 'human_review' ELSE 'auto_reject' END)"


def cols(names, prefix="") -> str:
    return ", ".join(f"{prefix}{c}" for c in names)


APPLICANTS = f"applicants AS ({APPLICANTS_SQL.format(orders='orders', customer='customer')})"

_TEXT_NUMBERS = ["age", "monthly_salary"]
DEDUPED = "deduped AS (SELECT DISTINCT * FROM applicants)"
PREPARED = ("prepared AS (SELECT * REPLACE ("
            + ", ".join(f"{number(currency(c))} AS {c}" for c in _TEXT_NUMBERS)
            + ") FROM deduped)")
GATES = ("gates AS (SELECT " + ", ".join(
    f"bool_or({c} IS NULL) AS g_{c}" for c in S.FLAGGED_COLUMNS) + " FROM deduped)")
FLAGGED = ("flagged AS (SELECT prepared.*, " + ", ".join(
    f"CASE WHEN g_{c} AND {c} IS NULL THEN 1 ELSE 0 END AS {c}_missing" for c in S.FLAGGED_COLUMNS)
    + " FROM prepared CROSS JOIN gates)")


def kept(training: bool) -> str:
    label = f"emi_eligibility IN {LABELS} AND " if training else ""
    return (f"kept AS (SELECT * FROM flagged WHERE {label}requested_amount IS NOT NULL "
            "AND requested_tenure IS NOT NULL)")


MEDIANS = """medians AS (SELECT
  median(monthly_rent) FILTER (lower(house_type) = 'rented') AS m_renter, median(age) AS m_age,
  median(family_size) AS m_family, median(monthly_salary) AS m_salary,
  bool_or(monthly_rent IS NULL) AS n_rent, bool_or(bank_balance IS NULL) AS n_bank,
  bool_or(groceries_utilities IS NULL) AS n_groc FROM kept)"""
BRACKETED = f"bracketed AS (SELECT *, {bracket('monthly_salary')} AS sal_bracket FROM kept)"
BRACKET_MEDIANS = """bracket_medians AS (SELECT sal_bracket, median(bank_balance) AS b_bank,
  median(groceries_utilities) AS b_groc FROM bracketed WHERE sal_bracket IS NOT NULL GROUP BY sal_bracket)"""
BRACKET_FILLED = """bracket_filled AS (SELECT b.* REPLACE (
  CASE WHEN n_bank THEN CASE WHEN b.sal_bracket IS NOT NULL THEN coalesce(b.bank_balance, b_bank) END
       ELSE b.bank_balance END AS bank_balance,
  CASE WHEN n_groc THEN CASE WHEN b.sal_bracket IS NOT NULL THEN coalesce(b.groceries_utilities, b_groc) END
       ELSE b.groceries_utilities END AS groceries_utilities)
  FROM bracketed b LEFT JOIN bracket_medians m ON b.sal_bracket = m.sal_bracket CROSS JOIN medians)"""
GLOBALS = """globals AS (SELECT median(bank_balance) AS g_bank, median(groceries_utilities) AS g_groc
  FROM bracket_filled)"""
RENT = (f"CASE WHEN monthly_rent IS NOT NULL THEN monthly_rent "
        f"WHEN house_type IN {texts(S.RENT_FREE_HOUSES)} THEN 0 "
        f"WHEN lower(house_type) = 'rented' THEN coalesce(m_renter, 0) ELSE 0 END")
FILLED = f"""filled AS (SELECT bracket_filled.* EXCLUDE (sal_bracket) REPLACE (
  {RENT} AS monthly_rent, coalesce(credit_score, 300) AS credit_score,
  coalesce(bank_balance, g_bank) AS bank_balance, coalesce(groceries_utilities, g_groc) AS groceries_utilities,
  coalesce(education, 'Unknown') AS education,
  {', '.join(f'coalesce({c}, 0) AS {c}' for c in S.ZERO_FILL_COLUMNS)},
  coalesce(family_size, m_family) AS family_size, coalesce(age, m_age) AS age,
  coalesce(monthly_salary, m_salary) AS monthly_salary)
  FROM bracket_filled CROSS JOIN medians CROSS JOIN globals)"""
STRIPPED = ("stripped AS (SELECT * REPLACE (" + ", ".join(
    f"coalesce({strip(c)}, 'nan') AS {c}" for c in S.CATEGORICAL_COLUMNS + ["emi_eligibility"])
    + ") FROM filled)")
MAPPED = ("mapped AS (SELECT * REPLACE (" + ", ".join(
    f"{mapped(c, m)} AS {c}" for c, m in S.VALUE_MAPS.items()) + ") FROM stripped)")
TITLED = ("titled AS (SELECT * REPLACE (" + ", ".join(
    f"{title(c)} AS {c}" for c in S.TITLE_COLUMNS) + ") FROM mapped)")


def _mode(c: str) -> str:
    if c in ("education", "gender"):
        return "'Unknown'"
    return (f"coalesce((SELECT t2.{c} FROM titled t2 WHERE t2.{c} NOT IN {NULLS} "
            f"GROUP BY t2.{c} ORDER BY count(*) DESC, t2.{c} LIMIT 1), 'Unknown')")


NAMED = ("named AS (SELECT * REPLACE (" + ", ".join(
    f"CASE WHEN {c} IN {NULLS} THEN {_mode(c)} ELSE {c} END AS {c}" for c in S.CATEGORICAL_COLUMNS)
    + ") FROM titled)")
CLIPPED = ("clipped AS (SELECT * REPLACE (" + ", ".join(
    f"{clip(c, low, high)} AS {c}" for c, (low, high) in S.DOMAIN_BOUNDS.items()) + ") FROM named)")
NON_NEGATIVE = ("non_negative AS (SELECT * REPLACE (" + ", ".join(
    f"{clip(c, 0)} AS {c}" for c in S.NON_NEGATIVE_COLUMNS) + ") FROM clipped)")
SALARY = """salaried AS (SELECT * REPLACE (CASE WHEN monthly_salary <= 0 THEN
  (SELECT median(s.monthly_salary) FROM non_negative s WHERE s.monthly_salary > 0) ELSE monthly_salary END
  AS monthly_salary) FROM non_negative)"""
RULED = ("ruled AS (SELECT * REPLACE (" + ", ".join(
    f"CAST(round_even({c}, 0) AS INTEGER) AS {c}" for c in S.INTEGER_COLUMNS) + ") FROM salaried)")
CAPS = ("caps AS (SELECT " + ", ".join(
    f"quantile_cont({c}, 0.01) AS lo_{c}, quantile_cont({c}, 0.99) AS hi_{c}" for c in S.CAP_COLUMNS)
    + " FROM ruled)")
CAPPED = ("capped AS (SELECT ruled.* REPLACE (" + ", ".join(
    f"{clip(c, f'lo_{c}', f'hi_{c}')} AS {c}" for c in S.CAP_COLUMNS) + ") FROM ruled CROSS JOIN caps)")
_TARGET = (f"CASE WHEN emi_eligibility = 'Eligible' THEN 1 WHEN emi_eligibility IN "
           f"{texts(S.NEGATIVE_LABELS)} THEN 0 END")
CLEAN_TRAINING = (f"clean AS (SELECT DISTINCT * FROM (SELECT * REPLACE ({_TARGET} AS emi_eligibility) "
                  "FROM capped) WHERE emi_eligibility IS NOT NULL)")
CLEAN_INFERENCE = "clean AS (SELECT DISTINCT * EXCLUDE (emi_eligibility, max_monthly_emi) FROM capped)"

_CHAIN = [
    "applicants", "deduped", "prepared", "gates", "flagged", "kept", "medians", "bracketed",
    "bracket_medians", "bracket_filled", "globals", "filled", "stripped", "mapped", "titled",
    "named", "clipped", "non_negative", "salaried", "ruled", "caps", "capped", "clean",
    "fallback", "features",
]

EXPENSES = "(" + " + ".join(f"coalesce({c}, 0)" for c in S.EXPENSE_COLUMNS) + ")"


def _ratio(a: str, b: str, low, high, missing) -> str:
    x = f"(({a}) / nullif({b}, 0))"
    return f"coalesce({clip(x, low, high)}, {missing})"


FALLBACK = f"fallback AS (SELECT median({EXPENSES}) AS expense_fallback FROM clean)"
_REQ = "coalesce(requested_amount / nullif(requested_tenure, 0), 0)"
_BAND = ("(CASE WHEN credit_score >= 0 THEN CASE WHEN credit_score <= 599 THEN 'Poor' "
         "WHEN credit_score <= 649 THEN 'Fair' WHEN credit_score <= 749 THEN 'Good' "
         "WHEN credit_score <= 900 THEN 'Excellent' END END)")
_BASE = f"(CASE WHEN {EXPENSES} = 0 THEN expense_fallback ELSE {EXPENSES} END)"
FEATURE_SQL = {
    "expense_ratio": _ratio(EXPENSES, "monthly_salary", 0, 2, 1.0),
    "emi_burden_ratio": _ratio("coalesce(current_emi_amount, 0)", "monthly_salary", 0, 1, 0.0),
    "requested_emi_monthly": _REQ,
    "requested_emi_ratio": _ratio(_REQ, "monthly_salary", 0, 2, 1.0),
    "total_emi_ratio": _ratio(f"coalesce(current_emi_amount, 0) + {_REQ}", "monthly_salary", 0, 2, 1.0),
    "disposable_income": f"coalesce(monthly_salary, 0) - {EXPENSES}",
    "savings_ratio": _ratio("coalesce(bank_balance, 0)", "monthly_salary", 0, 100, 0.0),
    "emergency_months": _ratio("coalesce(emergency_fund, 0)", _BASE, 0, 24, 0.0),
    "credit_score_band": _BAND,
    "credit_score_ord": (f"(CASE {_BAND} WHEN 'Fair' THEN 1 WHEN 'Good' THEN 2 "
                         "WHEN 'Excellent' THEN 3 ELSE 0 END)"),
    "loan_to_income_ratio": _ratio("requested_amount", "monthly_salary * 12", 0, 20, 0.0),
    "loan_to_balance_ratio": _ratio("requested_amount", "bank_balance", 0, 100, 50.0),
    "credit_x_income": "coalesce(credit_score, 0) * coalesce(monthly_salary, 0) / 1e7",
    "employment_stability": clip(
        f"(coalesce(years_of_employment, 0) / {clip('(coalesce(age, 25) - 18)', 1)})", 0, 1),
    "has_emergency_fund": "CAST(coalesce(emergency_fund, 0) > 0 AS INTEGER)",
    "is_renter": "CAST(house_type IS NOT DISTINCT FROM 'Rented' AS INTEGER)",
    "high_credit": "CAST(coalesce(credit_score, 0) >= 750 AS INTEGER)",
    "low_expense_burden": f"CAST({_ratio(EXPENSES, 'monthly_salary', 0, 2, 1.0)} <= 0.5 AS INTEGER)",
    "log_bank_balance": "ln(1 + greatest(coalesce(bank_balance, 0), 0))",
    "log_monthly_salary": "ln(1 + greatest(coalesce(monthly_salary, 0), 0))",
    "log_requested_amount": "ln(1 + greatest(coalesce(requested_amount, 0), 0))",
}
FEATURES = ("features AS (SELECT clean.*, " + ", ".join(
    f"{e} AS {c}" for c, e in FEATURE_SQL.items()) + " FROM clean CROSS JOIN fallback)")

_BLOCKS = {
    "applicants": APPLICANTS, "deduped": DEDUPED, "prepared": PREPARED, "gates": GATES,
    "flagged": FLAGGED, "medians": MEDIANS, "bracketed": BRACKETED,
    "bracket_medians": BRACKET_MEDIANS, "bracket_filled": BRACKET_FILLED, "globals": GLOBALS,
    "filled": FILLED, "stripped": STRIPPED, "mapped": MAPPED, "titled": TITLED, "named": NAMED,
    "clipped": CLIPPED, "non_negative": NON_NEGATIVE, "salaried": SALARY, "ruled": RULED,
    "caps": CAPS, "capped": CAPPED, "fallback": FALLBACK, "features": FEATURES,
}


def query(upto: str, body: str, *extra: str, training: bool = True, recursive: bool = False) -> str:
    """``body`` over the chain of blocks up to ``upto`` and any further blocks."""
    blocks = []
    for name in _CHAIN[: _CHAIN.index(upto) + 1]:
        if name == "kept":
            blocks.append(kept(training))
        elif name == "clean":
            blocks.append(CLEAN_TRAINING if training else CLEAN_INFERENCE)
        else:
            blocks.append(_BLOCKS[name])
    word = "WITH RECURSIVE" if recursive else "WITH"
    return f"{word} " + ",\n".join([*blocks, *extra]) + "\n" + body


def union_all(parts) -> str:
    return "\nUNION ALL\n".join(parts)


def rule_probability(credit=650, expense=0.6, salary=20000) -> str:
    ratio = _ratio(EXPENSES, "monthly_salary", 0, 2, 1.0)
    passed = (f"(CASE WHEN credit_score >= {credit} THEN 1 ELSE 0 END + CASE WHEN {ratio} <= {expense} "
              f"THEN 1 ELSE 0 END + CASE WHEN monthly_salary >= {salary} THEN 1 ELSE 0 END)")
    return f"(CASE {passed} WHEN 3 THEN 0.9 WHEN 2 THEN 0.6 ELSE 0.1 END)"


_P = rule_probability()
SCORED = f"""scored AS (SELECT application_id, customer_id, round_even(CAST({_P} AS DOUBLE), 6) AS clf_proba,
  CASE WHEN {_P} >= 0.5 THEN 1 ELSE 0 END AS clf_label, {zone(_P)} AS conf_zone,
  round_even({clip('(monthly_salary * 0.3)', 500.0, 34750.0)}, 2) AS predicted_emi FROM clean)"""


def seeded(key: str, seed: int) -> str:
    return f"sha256(CAST({key} AS VARCHAR) || ':{seed}')"


REQUESTS = f"""requests AS (SELECT event_id, ts, user_id, event_type AS endpoint,
  CASE WHEN event_type = 'error' THEN '500' ELSE '200' END AS status, value / 100 AS seconds,
  {zone('(value / 100)')} AS conf_zone, value FROM events)"""
# the chain of misses: the next one is the first event a lifetime after the last one
MISSES = """miss_times AS (
  SELECT user_id, min(ts) AS ts FROM events GROUP BY user_id
  UNION ALL
  SELECT e.user_id, min(e.ts) AS ts FROM miss_times m JOIN events e
    ON e.user_id = m.user_id AND e.ts >= m.ts + INTERVAL 24 HOUR GROUP BY e.user_id),
replayed AS (SELECT e.*, NOT (m.ts IS NOT NULL AND e.event_id =
    min(e.event_id) OVER (PARTITION BY e.user_id, e.ts)) AS cache_hit
  FROM events e LEFT JOIN miss_times m ON m.user_id = e.user_id AND m.ts = e.ts)"""


def at_minute(width: str) -> str:
    return f"strftime(time_bucket(INTERVAL {width}, ts), '%Y-%m-%d %H:%M:%S')"
