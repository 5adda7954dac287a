"""Derived loan-application table: one row per order, with planted defects."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Shared by the Spark job and by the comparison queries, so both see the same input.
APPLICANTS_SQL = """
SELECT
  o_orderkey AS application_id,
  concat('CUST-', CAST(o_custkey AS STRING)) AS customer_id,
  o_orderdate AS applied_at,
  CASE WHEN k % 97 = 5 THEN concat(CAST(18 + (k * 7) % 50 AS STRING), '.0.0')
       WHEN k % 89 = 3 THEN '17' ELSE CAST(18 + (k * 7) % 50 AS STRING) END AS age,
  CASE k % 8 WHEN 0 THEN 'Male' WHEN 1 THEN 'Female' WHEN 2 THEN 'M' WHEN 3 THEN 'F'
       WHEN 4 THEN 'male' WHEN 5 THEN 'FEMALE' WHEN 6 THEN 'Male' ELSE 'Female' END AS gender,
  CASE k % 5 WHEN 0 THEN 'Married' WHEN 1 THEN 'SINGLE' WHEN 2 THEN 'single' WHEN 3 THEN ' Married ' ELSE 'Single' END AS marital_status,
  CASE WHEN k % 41 = 7 THEN NULL WHEN k % 4 = 0 THEN 'Graduate' WHEN k % 4 = 1 THEN 'post graduate'
       WHEN k % 4 = 2 THEN 'High School' ELSE 'Professional' END AS education,
  CASE WHEN k % 101 = 9 THEN concat(CAST(15000 + (k * 131) % 110000 AS STRING), '.0.0')
       WHEN k % 103 = 4 THEN concat('₹', CAST(15000 + (k * 131) % 110000 AS STRING))
       WHEN k % 211 = 6 THEN '0'
       ELSE CAST(15000 + (k * 131) % 110000 AS STRING) END AS monthly_salary,
  CASE k % 6 WHEN 0 THEN 'Private' WHEN 1 THEN 'Government' WHEN 2 THEN 'self-employed'
       WHEN 3 THEN 'Private' WHEN 4 THEN 'Self-employed' ELSE 'Government' END AS employment_type,
  CAST((k * 3) % 30 AS DOUBLE) AS years_of_employment,
  CASE k % 7 WHEN 0 THEN 'MNC' WHEN 1 THEN 'Mid-size' WHEN 2 THEN 'Large Indian' WHEN 3 THEN 'Startup'
       WHEN 4 THEN 'Small' WHEN 5 THEN 'mnc' ELSE 'nan' END AS company_type,
  CASE k % 3 WHEN 0 THEN 'Own' WHEN 1 THEN 'Rented' ELSE 'Family' END AS house_type,
  CASE WHEN k % 37 = 2 THEN NULL WHEN k % 3 = 1 THEN CAST(4000 + (k * 17) % 16000 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS monthly_rent,
  CAST(1 + k % 6 AS DOUBLE) AS family_size,
  CAST(k % 4 AS DOUBLE) AS dependents,
  CAST(((k * 11) % 9) * 1000 AS DOUBLE) AS school_fees,
  CAST(((k * 5) % 4) * 3000 AS DOUBLE) AS college_fees,
  CAST(1000 + (k * 19) % 6000 AS DOUBLE) AS travel_expenses,
  CASE WHEN k % 53 = 8 THEN NULL ELSE CAST(3000 + (k * 23) % 12000 AS DOUBLE) END AS groceries_utilities,
  CAST(500 + (k * 29) % 5000 AS DOUBLE) AS other_monthly_expenses,
  CASE WHEN k % 2 = 0 THEN 'yes' ELSE 'No' END AS existing_loans,
  CASE WHEN k % 2 = 0 THEN CAST((k * 31) % 15000 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS current_emi_amount,
  CASE WHEN k % 43 = 1 THEN NULL WHEN k % 83 = 2 THEN CAST(1200 AS DOUBLE) ELSE CAST(300 + (k * 37) % 600 AS DOUBLE) END AS credit_score,
  CASE WHEN k % 47 = 3 THEN NULL ELSE CAST(floor(c_acctbal * 50) AS DOUBLE) END AS bank_balance,
  CASE WHEN k % 59 = 4 THEN NULL WHEN k % 5 = 0 THEN CAST(0 AS DOUBLE) ELSE CAST((k * 41) % 150000 AS DOUBLE) END AS emergency_fund,
  CASE k % 5 WHEN 0 THEN 'Personal Loan EMI' WHEN 1 THEN 'Vehicle EMI' WHEN 2 THEN 'Education EMI'
       WHEN 3 THEN 'E-commerce Shopping EMI' ELSE 'Home Appliances EMI' END AS emi_scenario,
  CASE WHEN k % 61 = 5 THEN NULL ELSE CAST(floor(o_totalprice) AS DOUBLE) END AS requested_amount,
  CASE WHEN k % 67 = 6 THEN NULL ELSE CAST(6 + (k * 43) % 55 AS DOUBLE) END AS requested_tenure,
  CASE WHEN k % 23 = 0 THEN 'High_Risk' WHEN k % 71 = 0 THEN NULL
       WHEN (k * 37) % 600 >= 350 AND (k * 131) % 110000 >= 30000 THEN 'Eligible'
       ELSE 'Not_Eligible' END AS emi_eligibility,
  CAST(500 + ((k * 131) % 110000) * 3 / 10 AS DOUBLE) AS max_monthly_emi
FROM (SELECT o.*, c.c_acctbal, o.o_orderkey AS k FROM {orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey) t
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def applicants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The join side is left to the optimizer: customers are broadcast only if small."""
    return spark.sql(APPLICANTS_SQL, orders=table(spark, sf_dir, "orders"),
                     customer=table(spark, sf_dir, "customer"))


def applicants_with_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applications plus an exact copy of every row whose customer key ends in zero."""
    rows = applicants(spark, sf_dir)
    return rows.unionByName(rows.filter(F.col("customer_id").endswith("0")))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
