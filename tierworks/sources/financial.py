"""The six synthetic tables of a retail bank."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

from tierworks.operators.shape import describe_event
from tierworks.plans.products import product_type
from tierworks.sources import sinks, synth
from tierworks.sources.synth import Key, choice, foreign_key, positional, random_date, template, uniform

# ---------------------------------------------------------------------------
# Sizes, value lists, weights, patterns and ranges of the source tables.
ROWS = {"branches": 200, "products": 32, "date_dimensions": 1096, "customers": 50_000,
        "accounts": 75_000, "transactions": 500_000}
PARTITIONS = {"branches": 4, "products": 1, "date_dimensions": 2, "customers": 8, "accounts": 8,
              "transactions": 16}
FIRST_DAY = "2023-01-01"
KEYS = {"branches": Key("BR", 5), "products": Key("PROD", 4), "customers": Key("CUST", 8),
        "accounts": Key("ACC", 10), "transactions": Key("TXN", 12)}

CITIES = [
    "New York", "Los Angeles", "Chicago", "Houston", "Phoenix", "Philadelphia", "San Antonio",
    "San Diego", "Dallas", "Austin", "Jacksonville", "San Jose", "Columbus", "Charlotte",
    "Indianapolis", "San Francisco", "Seattle", "Denver", "Nashville", "Portland", "Boston",
    "Atlanta", "Miami", "Minneapolis",
]
CUSTOMER_CITIES = CITIES[:8]
REGIONS = ["North", "South", "East", "West", "Central", "Metro", "Pacific", "Mountain", "Midwest"]
BRANCH_NAMES = ["Main Street", "Central", "Business Park", "Mall", "Station"]
BRANCH_TYPES = {"Full Service": 0.40, "Express": 0.25, "Digital Hub": 0.15, "Business Center": 0.10,
                "Premium": 0.10}
BRANCH_STATUS = {"Active": 0.95, "Inactive": 0.03, "Renovation": 0.02}
PRODUCTS = {
    "Checking": ["Basic Checking", "Premium Checking", "Student Checking", "Business Checking",
                 "Senior Checking"],
    "Savings": ["Regular Savings", "High-Yield Savings", "Money Market", "CD 6-Month",
                "CD 12-Month", "CD 24-Month"],
    "Credit Card": ["Cashback Card", "Travel Rewards", "Business Card", "Platinum Card",
                    "Student Card", "Secured Card"],
    "Loan": ["Personal Loan", "Auto Loan", "Home Equity", "Business Loan", "Student Loan"],
    "Mortgage": ["Fixed 15-Year", "Fixed 30-Year", "Adjustable Rate", "FHA Loan", "VA Loan"],
    "Investment": ["Brokerage Account", "IRA Traditional", "IRA Roth", "Managed Portfolio",
                   "529 Plan"],
}
PRODUCT_STATUS = {"Active": 0.85, "Discontinued": 0.10, "Limited": 0.05}
FIRST_NAMES = [
    "James", "William", "Oliver", "George", "Harry", "Jack", "Leo", "Oscar", "Charlie", "Henry",
    "Thomas", "Noah", "Arthur", "Theo", "Joshua", "Jacob", "Ethan", "Daniel", "Matthew", "David",
    "Olivia", "Emma", "Charlotte", "Amelia", "Sophia", "Isabella", "Mia", "Evelyn", "Harper",
    "Luna", "Camila", "Sofia", "Emily", "Elizabeth", "Ella", "Avery", "Scarlett", "Grace", "Lily",
    "Victoria",
]
LAST_NAMES = [
    "Smith", "Johnson", "Williams", "Brown", "Jones", "Miller", "Davis", "Garcia", "Rodriguez",
    "Wilson", "Martinez", "Anderson", "Taylor", "Thomas", "Moore", "Jackson", "Martin", "Lee",
    "Thompson", "White", "Harris", "Clark", "Lewis", "Robinson", "Walker", "Hall", "Allen",
    "Young", "King", "Wright",
]
SEGMENTS = {"Mass Market": 0.60, "Mass Affluent": 0.25, "High Net Worth": 0.10,
            "Ultra High Net Worth": 0.03, "Small Business": 0.02}
EMPLOYMENT = {"Employed": 0.65, "Self-Employed": 0.15, "Retired": 0.12, "Student": 0.05,
              "Unemployed": 0.03}
CUSTOMER_STATUS = {"Active": 0.85, "Inactive": 0.08, "Dormant": 0.05, "Closed": 0.02}
ACCOUNT_TYPES = {"Checking": 0.35, "Savings": 0.30, "Credit Card": 0.20, "Investment": 0.15}
ACCOUNT_STATUS = {"Active": 0.88, "Dormant": 0.06, "Frozen": 0.02, "Closed": 0.04}
CREDIT_LIMITS = [1000, 2500, 5000, 10000, 25000, 50000]
TRANSACTION_TYPES = {
    "Deposit": 0.08, "Withdrawal": 0.06, "Transfer Out": 0.05, "Transfer In": 0.05,
    "Bill Payment": 0.10, "Direct Debit": 0.08, "Card Payment": 0.20, "ATM Withdrawal": 0.05,
    "Salary Credit": 0.08, "Refund": 0.03, "Purchase": 0.12, "Interest Credit": 0.05, "Fee": 0.05,
}
MERCHANTS = [
    "Walmart", "Target", "Amazon", "Apple", "Netflix", "Spotify", "Costco", "Kroger", "Starbucks",
    "McDonalds", "Uber", "DoorDash", "Whole Foods", "Home Depot", "Best Buy", "Shell", "Chevron",
    "Verizon", "AT&T", "Comcast",
]
MERCHANT_CODES = ["5411", "5942", "5732", "4899", "5812", "5814", "4121", "5541", "5200", "4814"]
CHANNELS = {"Online Banking": 0.35, "Mobile App": 0.30, "ATM": 0.10, "Branch": 0.08,
            "Phone Banking": 0.02, "Direct Debit": 0.15}
FRAUD_FLAGS = {"N": 0.997, "Suspected": 0.002, "Confirmed": 0.001}
TRANSACTION_STATUS = {"Completed": 0.96, "Pending": 0.02, "Failed": 0.01, "Reversed": 0.01}
POSTAL_CODE = r"\d\d\d\d\d"
PHONE = r"+1 \d\d\d-\d\d\d-\d\d\d\d"
# ---------------------------------------------------------------------------


def weighted(weights: Mapping[str, float]) -> synth.Field:
    return choice(list(weights), list(weights.values()))


def yes_no(yes: float = 0.5) -> synth.Field:
    return weighted({"Y": yes, "N": 1 - yes})


def branches() -> synth.Spec:
    return {
        "branch_id": KEYS["branches"].field(),
        "branch_name": choice(BRANCH_NAMES),
        "branch_type": weighted(BRANCH_TYPES),
        "city": choice(CITIES),
        "region": choice(REGIONS),
        "country": choice(["United States"]),
        "postal_code": template(POSTAL_CODE),
        "phone": template(PHONE),
        "manager_name": template(r"\w+ \w+"),
        "num_employees": uniform(5, 50, "int"),
        "opened_date": random_date("2000-01-01", 8000),
        "is_24h_atm": yes_no(),
        "has_safe_deposit": yes_no(),
        "has_business_services": yes_no(),
        "status": weighted(BRANCH_STATUS),
    }


def products() -> synth.Spec:
    names = [(category, name) for category, members in PRODUCTS.items() for name in members]
    return {
        "product_id": KEYS["products"].field(),
        "product_name": positional([name for _, name in names]),
        "product_category": positional([category for category, _ in names]),
        "interest_rate_pct": uniform(0.01, 5.5, "float").nulls(0.4),
        "apr_pct": uniform(3.5, 24.9, "float").nulls(0.5),
        "min_balance": choice([0, 100, 500, 1000, 5000, 10000], dtype="int").nulls(0.5),
        "monthly_fee": choice([0, 0, 0, 5, 10, 15, 25], dtype="int").nulls(0.5),
        "annual_fee": choice([0, 0, 0, 50, 95, 150, 450], dtype="int").nulls(0.7),
        "reward_rate_pct": uniform(1.0, 5.0, "float").nulls(0.7),
        "term_months": choice([6, 12, 24, 36, 60, 120, 180, 360], dtype="int").nulls(0.5),
        "fdic_insured": yes_no(),
        "min_credit_score": uniform(580, 750, "int").nulls(0.4),
        "launch_date": random_date("2010-01-01", 5000),
        "status": weighted(PRODUCT_STATUS),
    }


def customers(parent_branches: int = ROWS["branches"]) -> synth.Spec:
    return {
        "customer_id": KEYS["customers"].field(),
        "first_name": choice(FIRST_NAMES),
        "last_name": choice(LAST_NAMES),
        "email": template(r"\w+.\w+\d\d\d@\w+.com"),
        "phone": template(PHONE),
        "date_of_birth": random_date("1940-01-01", 24000),
        "gender": choice(["M", "F"]),
        "street_address": template(r"\d\d\d \w+ Street"),
        "city": choice(CUSTOMER_CITIES),
        "postal_code": template(POSTAL_CODE),
        "country": choice(["United States"]),
        "customer_segment": weighted(SEGMENTS),
        "credit_score": uniform(550, 850, "int"),
        "annual_income": uniform(20000, 500000, "double"),
        "employment_status": weighted(EMPLOYMENT),
        "primary_branch_id": foreign_key(KEYS["branches"], parent_branches),
        "customer_since": random_date("2005-01-01", 7000),
        "kyc_verified": yes_no(0.95),
        "marketing_consent": yes_no(),
        "digital_banking_enrolled": yes_no(0.85),
        "status": weighted(CUSTOMER_STATUS),
    }


def accounts(parents: Mapping[str, int] = ROWS) -> synth.Spec:
    return {
        "account_id": KEYS["accounts"].field(),
        "account_number": template(r"\d\d\d\d\d\d\d\d\d\d\d\d"),
        "customer_id": foreign_key(KEYS["customers"], parents["customers"]),
        "product_id": foreign_key(KEYS["products"], parents["products"]),
        "account_type": weighted(ACCOUNT_TYPES),
        "currency": choice(["USD"]),
        "current_balance": uniform(-500, 500000, "double"),
        "available_balance": uniform(0, 500000, "double"),
        "credit_limit": choice(CREDIT_LIMITS, dtype="int").nulls(0.6),
        "interest_rate_pct": uniform(0.01, 5.5, "float"),
        "opened_date": random_date("2010-01-01", 5400),
        "last_activity_date": random_date(FIRST_DAY, 900),
        "branch_id": foreign_key(KEYS["branches"], parents["branches"]),
        "is_primary": yes_no(0.3),
        "overdraft_protection": yes_no().nulls(0.5),
        "paperless_statements": yes_no(0.75),
        "status": weighted(ACCOUNT_STATUS),
    }


def transactions(parents: Mapping[str, int] = ROWS) -> synth.Spec:
    return {
        "transaction_id": KEYS["transactions"].field(),
        "account_id": foreign_key(KEYS["accounts"], parents["accounts"]),
        "transaction_date": random_date(FIRST_DAY, 1095),
        "transaction_time": synth.time_of_day(),
        "transaction_type": weighted(TRANSACTION_TYPES),
        "amount": uniform(1, 10000, "double"),
        "currency": choice(["USD"]),
        "is_credit": yes_no(0.35),
        "running_balance": uniform(-1000, 100000, "double"),
        "merchant_name": choice(MERCHANTS).nulls(0.4),
        "merchant_category_code": choice(MERCHANT_CODES).nulls(0.4),
        "channel": weighted(CHANNELS),
        "branch_id": foreign_key(KEYS["branches"], parents["branches"]).nulls(0.8),
        "reference_number": template(r"\w" * 16),
        "counterparty_account": template(r"****\d\d\d\d").nulls(0.8),
        "is_recurring": yes_no(0.15),
        "is_international": yes_no(0.05),
        "fraud_flag": weighted(FRAUD_FLAGS),
        "status": weighted(TRANSACTION_STATUS),
    }


def finish(name: str, df: DataFrame) -> DataFrame:
    """Columns that follow from generated ones."""
    if name == "customers":
        return df.withColumn("full_name", F.concat_ws(" ", "first_name", "last_name"))
    if name == "products":
        return df.withColumn("product_type", product_type(F.col("product_category")))
    if name == "transactions":
        text = describe_event(F.col("transaction_type"), F.col("merchant_name"))
        return df.withColumn("description", text)
    return df


def table(
    spark: SparkSession, name: str, rows: Mapping[str, int] = ROWS, seed: int = 0,
    partitions: int | None = None,
) -> DataFrame:
    """One of the six tables with ``rows[name]`` rows; children refer to ``rows`` parents."""
    if name not in ROWS:
        raise ValueError(f"{name!r} is not one of {sorted(ROWS)}")
    count, parts = rows[name], partitions or PARTITIONS[name]
    if name == "date_dimensions":
        return synth.date_dimension(spark, FIRST_DAY, count, parts)
    KEYS[name].check(count)
    spec = {
        "branches": branches,
        "products": products,
        "customers": lambda: customers(rows["branches"]),
        "accounts": lambda: accounts(rows),
        "transactions": lambda: transactions(rows),
    }[name]()
    return finish(name, synth.table(spark, spec, count, parts, seed, name))


def write_all(spark: SparkSession, folder: str, rows: Mapping[str, int] = ROWS, seed: int = 0) -> None:
    """All six tables as CSV directories below ``folder``."""
    if not folder:
        raise ValueError("folder must not be empty")
    for name in ROWS:
        sinks.csv(table(spark, name, rows, seed), f"{folder}/{name}")
