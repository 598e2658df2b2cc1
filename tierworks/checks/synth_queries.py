"""Synthetic tables generated for the keys of the shared test tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F, types as T

from tierworks.checks import tables as tb
from tierworks.sources import financial, synth

SEED = 7


def _plain_dates(df: DataFrame) -> DataFrame:
    days = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DateType)]
    return df.withColumns({d: F.col(d).cast("string") for d in days}) if days else df


def _made(name: str, spec: synth.Spec, df: DataFrame, number: str) -> DataFrame:
    made = synth.columns(df, number, spec, SEED, name)
    return _plain_dates(financial.finish(name, made))


def synth_branches(spark, sf):
    """A branch for every supplier."""
    return _made("branches", financial.branches(), tb.read(spark, sf, "supplier"), "s_suppkey")


def synth_products(spark, sf):
    """A product for every part: the names repeat in step with their categories."""
    return _made("products", financial.products(), tb.read(spark, sf, "part"), "p_partkey")


def synth_customers(spark, sf):
    return _made("customers", financial.customers(), tb.read(spark, sf, "customer"), "c_custkey")


def synth_accounts(spark, sf):
    return _made("accounts", financial.accounts(), tb.read(spark, sf, "orders"), "o_orderkey")


def synth_transactions(spark, sf):
    return _made("transactions", financial.transactions(), tb.read(spark, sf, "events"), "event_id")


def synth_expression(spark, sf):
    """Columns from SQL over the row number, and days in sequence."""
    spec = {"code": synth.expression("concat('N', id * 3)"), "day": synth.date_sequence("2023-01-01")}
    return _made("numbers", spec, tb.read(spark, sf, "customer"), "c_custkey")


QUERIES = {
    f.__name__: f
    for f in (
        synth_branches, synth_products, synth_customers, synth_accounts, synth_transactions,
        synth_expression,
    )
}


class _Sql:
    """SQL for the columns of one generated table; ``n`` is the row number."""

    def __init__(self, label: str) -> None:
        self.label = label

    def draw(self, column: str) -> str:
        a, b, c, d, e = synth.coefficients(SEED, f"{self.label}.{column}")
        p = synth.PRIME
        low, block = f"(n % {p})", f"(n // {p})"
        inner = f"((({a} * {low} + {b}) % {p}) * {low} + {c}) % {p}"
        return f"((({inner}) * {low} + ({e} * {block}) % {p} + {d}) % {p})"

    def unit(self, column: str) -> str:
        return f"(CAST({self.draw(column)} AS DOUBLE) / {synth.PRIME}.0::DOUBLE)"

    def choice(self, column: str, values: Sequence) -> str:
        options = ", ".join(str(v) if isinstance(v, int) else f"'{v}'" for v in values)
        return f"([{options}])[{self.draw(column)} % {len(values)} + 1]"

    def weighted(self, column: str, weights: Mapping[str, float]) -> str:
        names, total, seen, arms = list(weights), sum(weights.values()), 0.0, ""
        for name in names[:-1]:
            seen += weights[name]
            arms += f" WHEN {self.draw(column)} < {int(synth.PRIME * seen / total)} THEN '{name}'"
        return f"CASE{arms} ELSE '{names[-1]}' END"

    def yes(self, column: str, share: float = 0.5) -> str:
        return self.weighted(column, {"Y": share, "N": 1 - share})

    def whole(self, column: str, low: int, high: int) -> str:
        return f"({self.draw(column)} % {high - low + 1} + {low})"

    def decimal(self, column: str, low: float, high: float, dtype: str = "DOUBLE") -> str:
        span = float(high) - float(low)
        return (f"CAST(round({self.unit(column)} * CAST({span!r} AS DOUBLE) "
                f"+ CAST({float(low)!r} AS DOUBLE), 2) AS {dtype})")

    def day(self, column: str, start: str, days: int) -> str:
        return f"CAST(DATE '{start}' + CAST({self.draw(column)} % {days} AS INTEGER) AS VARCHAR)"

    def key(self, name: str, number: str = "n") -> str:
        key = financial.KEYS[name]
        mixed = f"(({number}) * {synth.KEY_STEP} + 7) % {10 ** key.digits}"
        return f"'{key.prefix}' || lpad(CAST({mixed} AS VARCHAR), {key.digits}, '0')"

    def parent(self, column: str, name: str) -> str:
        return self.key(name, f"{self.draw(column)} % {financial.ROWS[name]}")

    def digits(self, column: str, place: str, size: int) -> str:
        return f"lpad(CAST({self.draw(f'{column}#{place}')} % {10 ** size} AS VARCHAR), {size}, '0')"

    def letters(self, column: str, place: str, size: int) -> str:
        value = f"({self.draw(f'{column}#{place}')} % {26 ** size})"
        return " || ".join(
            f"substr('{synth.LETTERS}', CAST({value} // {26 ** (size - 1 - i)} % 26 AS INTEGER) + 1, 1)"
            for i in range(size)
        )

    def nulls(self, column: str, share: float, value: str) -> str:
        return f"CASE WHEN {self.unit(column + '#null')} >= {share} THEN {value} END"

    def phone(self) -> str:
        c = "phone"
        return (f"'+1 ' || {self.digits(c, '1.0', 3)} || '-' || {self.digits(c, '3.0', 3)} || '-' || "
                f"{self.digits(c, '5.0', 4)}")

    def select(self, table: str, number: str, columns: Mapping[str, str]) -> str:
        listed = ", ".join(f"{sql} AS {name}" for name, sql in columns.items())
        return f"SELECT {listed} FROM (SELECT CAST({number} AS BIGINT) AS n FROM {table})"


def _branches() -> str:
    q, f = _Sql("branches"), financial
    return q.select("supplier", "s_suppkey", {
        "branch_id": q.key("branches"),
        "branch_name": q.choice("branch_name", f.BRANCH_NAMES),
        "branch_type": q.weighted("branch_type", f.BRANCH_TYPES),
        "city": q.choice("city", f.CITIES),
        "region": q.choice("region", f.REGIONS),
        "country": "'United States'",
        "postal_code": q.digits("postal_code", "0.0", 5),
        "phone": q.phone(),
        "manager_name": f"{q.letters('manager_name', '0.0', 6)} || ' ' || {q.letters('manager_name', '2.0', 6)}",
        "num_employees": q.whole("num_employees", 5, 50),
        "opened_date": q.day("opened_date", "2000-01-01", 8000),
        **{c: q.yes(c) for c in ("is_24h_atm", "has_safe_deposit", "has_business_services")},
        "status": q.weighted("status", f.BRANCH_STATUS),
    })


def _products() -> str:
    q, f = _Sql("products"), financial
    names = [n for members in f.PRODUCTS.values() for n in members]
    kinds = [k for k, members in f.PRODUCTS.items() for _ in members]
    step = lambda values: "([" + ", ".join(f"'{v}'" for v in values) + f"])[n % {len(values)} + 1]"
    ints = {
        "min_balance": ([0, 100, 500, 1000, 5000, 10000], 0.5),
        "monthly_fee": ([0, 0, 0, 5, 10, 15, 25], 0.5),
        "annual_fee": ([0, 0, 0, 50, 95, 150, 450], 0.7),
        "term_months": ([6, 12, 24, 36, 60, 120, 180, 360], 0.5),
    }
    floats = {"interest_rate_pct": (0.01, 5.5, 0.4), "apr_pct": (3.5, 24.9, 0.5),
              "reward_rate_pct": (1.0, 5.0, 0.7)}
    return q.select("part", "p_partkey", {
        "product_id": q.key("products"),
        "product_name": step(names),
        "product_category": step(kinds),
        **{c: q.nulls(c, s, q.decimal(c, lo, hi, "FLOAT")) for c, (lo, hi, s) in floats.items()},
        **{c: q.nulls(c, s, q.choice(c, v)) for c, (v, s) in ints.items()},
        "fdic_insured": q.yes("fdic_insured"),
        "min_credit_score": q.nulls("min_credit_score", 0.4, q.whole("min_credit_score", 580, 750)),
        "launch_date": q.day("launch_date", "2010-01-01", 5000),
        "status": q.weighted("status", f.PRODUCT_STATUS),
        "product_type": f"CASE WHEN {step(kinds)} IN ('Savings', 'Checking', 'Investment') "
                        "THEN 'Asset' ELSE 'Liability' END",
    })


def _customers() -> str:
    q, f = _Sql("customers"), financial
    first, last = q.choice("first_name", f.FIRST_NAMES), q.choice("last_name", f.LAST_NAMES)
    e = "email"
    return q.select("customer", "c_custkey", {
        "customer_id": q.key("customers"),
        "first_name": first,
        "last_name": last,
        "email": f"{q.letters(e, '0.0', 6)} || '.' || {q.letters(e, '2.0', 6)} || {q.digits(e, '3.0', 3)}"
                 f" || '@' || {q.letters(e, '5.0', 6)} || '.com'",
        "phone": q.phone(),
        "date_of_birth": q.day("date_of_birth", "1940-01-01", 24000),
        "gender": q.choice("gender", ["M", "F"]),
        "street_address": f"{q.digits('street_address', '0.0', 3)} || ' ' || "
                          f"{q.letters('street_address', '2.0', 6)} || ' Street'",
        "city": q.choice("city", f.CUSTOMER_CITIES),
        "postal_code": q.digits("postal_code", "0.0", 5),
        "country": "'United States'",
        "customer_segment": q.weighted("customer_segment", f.SEGMENTS),
        "credit_score": q.whole("credit_score", 550, 850),
        "annual_income": q.decimal("annual_income", 20000, 500000),
        "employment_status": q.weighted("employment_status", f.EMPLOYMENT),
        "primary_branch_id": q.parent("primary_branch_id", "branches"),
        "customer_since": q.day("customer_since", "2005-01-01", 7000),
        "kyc_verified": q.yes("kyc_verified", 0.95),
        "marketing_consent": q.yes("marketing_consent"),
        "digital_banking_enrolled": q.yes("digital_banking_enrolled", 0.85),
        "status": q.weighted("status", f.CUSTOMER_STATUS),
        "full_name": f"{first} || ' ' || {last}",
    })


def _accounts() -> str:
    q, f = _Sql("accounts"), financial
    number = "account_number"
    return q.select("orders", "o_orderkey", {
        "account_id": q.key("accounts"),
        number: f"{q.digits(number, '0.0', 8)} || {q.digits(number, '0.8', 4)}",
        "customer_id": q.parent("customer_id", "customers"),
        "product_id": q.parent("product_id", "products"),
        "account_type": q.weighted("account_type", f.ACCOUNT_TYPES),
        "currency": "'USD'",
        "current_balance": q.decimal("current_balance", -500, 500000),
        "available_balance": q.decimal("available_balance", 0, 500000),
        "credit_limit": q.nulls("credit_limit", 0.6, q.choice("credit_limit", f.CREDIT_LIMITS)),
        "interest_rate_pct": q.decimal("interest_rate_pct", 0.01, 5.5, "FLOAT"),
        "opened_date": q.day("opened_date", "2010-01-01", 5400),
        "last_activity_date": q.day("last_activity_date", "2023-01-01", 900),
        "branch_id": q.parent("branch_id", "branches"),
        "is_primary": q.yes("is_primary", 0.3),
        "overdraft_protection": q.nulls("overdraft_protection", 0.5, q.yes("overdraft_protection")),
        "paperless_statements": q.yes("paperless_statements", 0.75),
        "status": q.weighted("status", f.ACCOUNT_STATUS),
    })


def _transactions() -> str:
    q, f = _Sql("transactions"), financial
    kind = q.weighted("transaction_type", f.TRANSACTION_TYPES)
    merchant = q.nulls("merchant_name", 0.4, q.choice("merchant_name", f.MERCHANTS))
    second = f"({q.draw('transaction_time')} % 86400)"
    two = lambda v: f"lpad(CAST({v} AS VARCHAR), 2, '0')"
    reference = " || ".join(q.letters("reference_number", f"0.{s}", n) for s, n in [(0, 6), (6, 6), (12, 4)])
    return q.select("events", "event_id", {
        "transaction_id": q.key("transactions"),
        "account_id": q.parent("account_id", "accounts"),
        "transaction_date": q.day("transaction_date", "2023-01-01", 1095),
        "transaction_time": f"{two(f'{second} // 3600')} || ':' || {two(f'{second} // 60 % 60')}"
                            f" || ':' || {two(f'{second} % 60')}",
        "transaction_type": kind,
        "amount": q.decimal("amount", 1, 10000),
        "currency": "'USD'",
        "is_credit": q.yes("is_credit", 0.35),
        "running_balance": q.decimal("running_balance", -1000, 100000),
        "merchant_name": merchant,
        "merchant_category_code": q.nulls(
            "merchant_category_code", 0.4, q.choice("merchant_category_code", f.MERCHANT_CODES)),
        "channel": q.weighted("channel", f.CHANNELS),
        "branch_id": q.nulls("branch_id", 0.8, q.parent("branch_id", "branches")),
        "reference_number": reference,
        "counterparty_account": q.nulls(
            "counterparty_account", 0.8, "'****' || " + q.digits("counterparty_account", "1.0", 4)),
        "is_recurring": q.yes("is_recurring", 0.15),
        "is_international": q.yes("is_international", 0.05),
        "fraud_flag": q.weighted("fraud_flag", f.FRAUD_FLAGS),
        "status": q.weighted("status", f.TRANSACTION_STATUS),
        "description": f"({kind}) || coalesce(' - ' || ({merchant}), '')",
    })


ORACLE = {
    "synth_branches": _branches(),
    "synth_products": _products(),
    "synth_customers": _customers(),
    "synth_accounts": _accounts(),
    "synth_transactions": _transactions(),
    "synth_expression":
        """SELECT 'N' || (c_custkey * 3) AS code,
           CAST(DATE '2023-01-01' + CAST(c_custkey AS INTEGER) AS VARCHAR) AS day FROM customer""",
}
