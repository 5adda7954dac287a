import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lendframe import schema as S  # noqa: E402
from lendframe.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "tests")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield session
    session.stop()


BASE = dict(
    age="30", gender="Male", marital_status="Married", education="Graduate", monthly_salary="50000",
    employment_type="Private", years_of_employment=5.0, company_type="Mnc", house_type="Own",
    monthly_rent=0.0, family_size=3.0, dependents=1.0, school_fees=0.0, college_fees=0.0,
    travel_expenses=2000.0, groceries_utilities=5000.0, other_monthly_expenses=1000.0,
    existing_loans="No", current_emi_amount=0.0, credit_score=700.0, bank_balance=100000.0,
    emergency_fund=20000.0, emi_scenario="Vehicle EMI", requested_amount=300000.0,
    requested_tenure=36.0, emi_eligibility="Eligible", max_monthly_emi=8000.0,
)
KINDS = {c: "string" if isinstance(v, str) else "double" for c, v in BASE.items()}


@pytest.fixture(scope="session")
def table(spark):
    """Build an application table from overrides of one base row; ids count from 1."""
    def build(*overrides, keyed=True):
        schema = ", ".join(f"{c} {KINDS[c]}" for c in S.EXPECTED_COLUMNS)
        rows = []
        for i, extra in enumerate(overrides, start=1):
            row = BASE | extra
            cells = [row[c] for c in S.EXPECTED_COLUMNS]
            rows.append(([row.get("application_id", i), row.get("customer_id", f"CUST-{i}")] if keyed else []) + cells)
        if keyed:
            schema = "application_id long, customer_id string, " + schema
        return spark.createDataFrame(rows, schema)

    return build


@pytest.fixture(scope="session")
def sample(table):
    """Ten clean applications, five of each label."""
    return table(*[
        dict(age=str(22 + 4 * i), monthly_salary=str(30000 + 7000 * i), credit_score=560.0 + 30 * i,
             gender="Female" if i % 2 else "Male", house_type=["Own", "Rented", "Family"][i % 3],
             monthly_rent=9000.0 if i % 3 == 1 else 0.0, bank_balance=50000.0 + 30000 * i,
             emi_eligibility="Eligible" if i >= 5 else "Not_Eligible", max_monthly_emi=4000.0 + 1500 * i)
        for i in range(10)
    ])
