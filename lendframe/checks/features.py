"""Engineered features, encoding, scoring, joins and cache table."""

from pyspark.sql import functions as F

from lendframe import schema as S
from lendframe.checks import sql_parts as Q
from lendframe.checks.loading import SPLIT_SQL
from lendframe.checks.registry import check, rounded, sql_rounded
from lendframe.functions import expr as X
from lendframe.operators import cache, leakage, scoring
from lendframe.operators.ranks import exact_quantiles, long_values
from lendframe.plans import features as P
from lendframe.plans.encoder import encode, one_hot_columns, sanitized, vocabulary
from lendframe.sources.store import FeatureStore
from lendframe.staging import staging_path

_INTEGERS = ["credit_score_ord", "has_emergency_fund", "is_renter", "high_credit", "low_expense_burden"]
_REALS = [c for c in S.ENGINEERED_NUMERIC if c not in _INTEGERS]


def _feature_group(name, columns, build):
    reals = [c for c in columns if c in _REALS]
    plain = [c for c in columns if c not in _REALS]
    listed = ", ".join(["application_id", *plain, *([sql_rounded(reals)] if reals else [])])

    @check(name, Q.query("features", f"SELECT {listed} FROM features"))
    def group(t):
        return rounded(t.clean.withColumns(build(t)).select("application_id", *columns), reals)


_feature_group("feat_ratios", S.ENGINEERED_FEATURES[:8], lambda t: P.ratio_features(t.fallback))
_feature_group("feat_band", S.ENGINEERED_FEATURES[8:10], lambda t: P.band_features())
_feature_group("feat_capacity", S.ENGINEERED_FEATURES[10:12], lambda t: P.capacity_features())
_feature_group("feat_interact", S.ENGINEERED_FEATURES[12:14], lambda t: P.interaction_features())
_feature_group("feat_flags", S.ENGINEERED_FEATURES[14:18], lambda t: P.flag_features())
_feature_group("feat_logs", S.ENGINEERED_FEATURES[18:], lambda t: P.log_features())

_ALL_SQL = Q.query("features", f"""SELECT application_id, credit_score_band, {Q.cols(_INTEGERS)},
  {sql_rounded(_REALS)} FROM features""")


@check("features_all", _ALL_SQL)
def features_all(t):
    model = P.FeatureBuilder().fit(t.clean)
    return rounded(model.transform(t.clean).select("application_id", *S.ENGINEERED_FEATURES), _REALS)


@check("fit_expense_fallback", Q.query("fallback", "SELECT round(expense_fallback, 4) AS expense_fallback FROM fallback"))
def fit_expense_fallback(t):
    found = exact_quantiles(long_values(t.clean, {"expenses": P.total_expenses()}), [0.5])
    return found.select(F.round("quantile", 4).alias("expense_fallback"))


@check("save_load_stages", _ALL_SQL)
def save_load_stages(t):
    """Cleaning and features fitted as one set of stages, saved, loaded and applied."""
    from pyspark.ml import Pipeline, PipelineModel

    from lendframe.plans.cleaner import LoanCleaner

    path = staging_path(t.spark, "stages")
    Pipeline(stages=[LoanCleaner(training=True), P.FeatureBuilder()]).fit(t.applicants).write().save(path)
    loaded = PipelineModel.load(path)
    return rounded(loaded.transform(t.applicants).select("application_id", *S.ENGINEERED_FEATURES), _REALS)


# --- encoding ---------------------------------------------------------------
def _levels_sql(c):
    return f"(SELECT min({c}) FROM features WHERE {c} IS NOT NULL)"


@check("one_hot", Q.query("features", Q.union_all([f"""
SELECT '{c}_' || {c} AS "column", count(*) AS ones FROM features
WHERE {c} IS NOT NULL AND {c} > {_levels_sql(c)} GROUP BY {c}""" for c in S.ENCODED_COLUMNS])))
def one_hot(t):
    """Rows with a one per dummy column; the alphabetically first level has none."""
    hot = one_hot_columns(vocabulary(t.features))
    one = t.features.agg(*[F.sum(e).alias(c) for c, e in hot.items()])
    return one.unpivot([], list(hot), "column", "ones")


@check("align_schema", Q.query("features", """
SELECT application_id, age, CASE WHEN gender = 'Male' THEN 1 ELSE 0 END AS "gender_Male",
  CASE WHEN house_type = 'Rented' THEN 1 ELSE 0 END AS "house_type_Rented", 0 AS "company_type_Unseen",
  round(expense_ratio, 6) AS expense_ratio FROM features"""))
def align_schema(t):
    expected = ["age", "gender_Male", "house_type_Rented", "company_type_Unseen", "expense_ratio"]
    vocab = vocabulary(t.features, ["gender", "house_type"])
    return rounded(encode(t.features, vocab, expected, ["application_id"]), ["expense_ratio"])


@check("sanitize_inf", Q.query("clean", """
SELECT application_id, CASE WHEN school_fees = 0 OR bank_balance / school_fees IS NULL THEN 0.0
  ELSE round(bank_balance / school_fees, 6) END AS per_fee, CAST(school_fees > 0 AS INTEGER) AS has_fees FROM clean"""))
def sanitize_inf(t):
    fees = F.col("school_fees")
    rows = t.clean.select(
        "application_id", (fees > 0).alias("has_fees"),
        F.when(fees == 0, F.when(F.col("bank_balance") > 0, float("inf")).otherwise(float("nan")))
        .otherwise(F.try_divide("bank_balance", fees)).alias("per_fee"))
    types = {f.name: f.dataType for f in rows.schema}
    out = rows.select("application_id", *[sanitized(c, types[c]).alias(c) for c in ("per_fee", "has_fees")])
    return rounded(out, ["per_fee"])


# --- scoring ----------------------------------------------------------------
@check("rule_score", Q.query("clean", f"SELECT application_id, CAST({Q.rule_probability()} AS DOUBLE) AS score FROM clean"))
def rule_score(t):
    return t.clean.select("application_id", scoring.rule_probability().alias("score"))


@check("conf_zone", Q.query("clean", """
SELECT application_id, conf_zone FROM scored""", Q.SCORED))
def conf_zone(t):
    return t.clean.select("application_id", X.zone(scoring.rule_probability()).alias("conf_zone"))


@check("score_rows", Q.query("clean", "SELECT * FROM scored", Q.SCORED))
def score_rows(t):
    return t.scored


_ZONE_COUNTS = ", ".join(f"count(*) FILTER (conf_zone = '{z}') AS {z}" for z in scoring.ZONES)


@check("batch_summary", Q.query("clean", f"""
SELECT count(*) AS total_scored, {_ZONE_COUNTS}, round_even(avg(clf_label) * 100, 2) AS eligible_pct,
  round_even(median(predicted_emi) FILTER (clf_label = 1), 2) AS median_emi_inr FROM scored""", Q.SCORED))
def batch_summary(t):
    return scoring.batch_summary(t.scored)


@check("confidence_label", Q.query("clean", """
SELECT application_id, CASE WHEN clf_proba > 0.85 THEN 'Very High' WHEN clf_proba >= 0.4 THEN 'Moderate'
  ELSE 'Low' END AS confidence, CASE WHEN clf_label = 1 THEN 'Eligible' ELSE 'Not Eligible' END AS label
FROM scored""", Q.SCORED))
def confidence_label(t):
    return t.scored.select("application_id", scoring.confidence_label("clf_proba").alias("confidence"),
                           scoring.label_text("clf_label").alias("label"))


@check("zone_counts", Q.query("clean", """
SELECT conf_zone, count(*) AS "rows", round(count(*) * 100.0 / sum(count(*)) OVER (), 2) AS pct
FROM scored GROUP BY conf_zone""", Q.SCORED))
def zone_counts(t):
    return scoring.zone_counts(t.scored)


@check("zone_summary", Q.query("clean", f"""
SELECT {_ZONE_COUNTS}, count(*) AS total, {', '.join(
    f"round(count(*) FILTER (conf_zone = '{z}') * 100.0 / count(*), 1) AS {z}_pct" for z in scoring.ZONES)}
FROM scored""", Q.SCORED))
def zone_summary(t):
    return scoring.zone_summary(t.scored)


# --- joins ------------------------------------------------------------------
def _overlap_sql(copies):
    pick = " UNION ALL SELECT * FROM split WHERE part = 'train' AND application_id % 10 = 0" if copies else ""
    same = " AND ".join(f"a.{c} IS NOT DISTINCT FROM b.{c}" for c in S.REQUEST_COLUMNS)
    return Q.query("clean", f"""
SELECT (SELECT count(*) FROM train_rows a JOIN test_rows b ON {same}) AS overlap_rows,
  (SELECT count(*) FROM train_rows) AS train_rows, (SELECT count(*) FROM test_rows) AS test_rows,
  25 AS cols_compared, {'FALSE' if copies else 'TRUE'} AS passed, '{'FAIL' if copies else 'PASS'}' AS verdict""",
                   SPLIT_SQL, "train_rows AS (SELECT * FROM split WHERE part = 'train')",
                   f"test_rows AS (SELECT * FROM split WHERE part = 'test'{pick})")


@check("overlap_join", _overlap_sql(False))
def overlap_join(t):
    return leakage.overlap(*t.split, S.REQUEST_COLUMNS)


@check("overlap_join_copies", _overlap_sql(True))
def overlap_join_copies(t):
    train, test = t.split
    return leakage.overlap(train, test.unionByName(train.filter("application_id % 10 = 0")), S.REQUEST_COLUMNS)


@check("attach_targets", Q.query("clean", """
SELECT application_id, emi_eligibility, max_monthly_emi FROM split WHERE part = 'test'""", SPLIT_SQL))
def attach_targets(t):
    bare = t.split[1].select("application_id")
    return bare.join(t.clean.select("application_id", S.TARGET_CLASS, S.TARGET_AMOUNT), "application_id")


@check("attach_ids", Q.query("features", """
SELECT application_id, customer_id, round(expense_ratio, 6) AS expense_ratio FROM features"""))
def attach_ids(t):
    """Ids travel with the rows, and can be joined back by key."""
    vectors = t.features.select("application_id", F.round("expense_ratio", 6).alias("expense_ratio"))
    return vectors.join(t.applicants.select(*S.KEY_COLUMNS), "application_id")


@check("broadcast_stats", Q.query("clean", f"""
SELECT c.application_id, round(c.bank_balance - m.med, 4) AS above_median, s.total AS batch_rows
FROM clean c JOIN (SELECT {Q.bracket('monthly_salary')} AS br, median(bank_balance) AS med FROM clean GROUP BY 1) m
  ON {Q.bracket('c.monthly_salary')} = m.br CROSS JOIN (SELECT count(*) AS total FROM clean) s"""))
def broadcast_stats(t):
    """Seven bracket medians and one total, brought to the rows."""
    from lendframe.operators.ranks import group_medians

    rows = t.clean.withColumn("bracket", X.salary_bracket("monthly_salary"))
    stats = group_medians(rows, ["bracket"], ["bank_balance"])
    total = t.clean.count()
    return rows.join(F.broadcast(stats), "bracket", "left").select(
        "application_id", F.round(F.col("bank_balance") - F.col("median_bank_balance"), 4).alias("above_median"),
        F.lit(total).cast("long").alias("batch_rows"))


@check("group_median_transform", Q.query("bracketed", """
SELECT application_id, round(median(bank_balance) OVER (PARTITION BY sal_bracket), 4) AS bracket_median
FROM bracketed WHERE sal_bracket IS NOT NULL"""))
def group_median_transform(t):
    from lendframe.operators.ranks import group_medians

    rows = t.kept.withColumn("bracket", X.salary_bracket("monthly_salary")).filter("bracket is not null")
    # at most one row per salary bracket is broadcast
    return rows.join(F.broadcast(group_medians(rows, ["bracket"], ["bank_balance"])), "bracket").select(
        "application_id", F.round("median_bank_balance", 4).alias("bracket_median"))


# --- cache table ------------------------------------------------------------
_PAYLOAD = ["age", "house_type", "monthly_salary", "expense_ratio", "credit_score_band"]


def _payload_sql(names):
    def cell(c):
        x = f"CAST({c} AS DECIMAL(28,6))" if c in ("monthly_salary", "expense_ratio") else c
        return f"{c}: CAST({x} AS VARCHAR)"

    return "CAST(to_json({" + ", ".join(cell(c) for c in names) + "}) AS VARCHAR)"


def _key_sql(x):
    return f"'emi:features:' || substring(sha256({x}), 1, 16)"


@check("cache_key", Q.query("applicants", f"SELECT application_id, {_key_sql('customer_id')} AS cache_key FROM applicants"))
def cache_key(t):
    return t.applicants.select("application_id", cache.cache_key("customer_id").alias("cache_key"))


@check("cache_payload", Q.query("features", f"SELECT application_id, {_payload_sql(_PAYLOAD)} AS payload FROM features"))
def cache_payload(t):
    return t.features.select("application_id", cache.payload_text(t.features, _PAYLOAD).alias("payload"))


@check("content_key", Q.query("clean", f"""
SELECT application_id, 'UI-' || substring(sha256({_payload_sql(['age', 'house_type', 'monthly_salary'])}), 1, 12)
  AS content_key FROM clean"""))
def content_key(t):
    return t.clean.select("application_id", cache.content_key(
        t.clean, ["monthly_salary", "age", "house_type"]).alias("content_key"))


# every seventh application has a blank customer
_BLANKED = "blanked AS (SELECT * REPLACE (CASE WHEN application_id % 7 = 0 THEN '  ' ELSE customer_id END AS customer_id) FROM features)"
_STORE = f"""store AS (SELECT {_key_sql('customer_id')} AS cache_key, arg_max({_payload_sql(_PAYLOAD)}, application_id) AS payload,
  max(application_id) AS seq FROM blanked WHERE trim(customer_id) <> '' GROUP BY 1)"""


def _blanked(t):
    blank = F.when(F.col("application_id") % 7 == 0, F.lit("  ")).otherwise(F.col("customer_id"))
    return t.features.withColumn("customer_id", blank)


def _at(text):
    return F.lit(text).cast("timestamp")


def _store(t, written="2024-01-01 00:00:00"):
    return cache.batch_write(_blanked(t), _PAYLOAD, written_at=_at(written))


@check("cache_batch_write", Q.query("features", "SELECT * FROM store", _BLANKED, _STORE))
def cache_batch_write(t):
    return _store(t).select("cache_key", "payload", "seq")


@check("cache_write_counts", Q.query("features", """
SELECT count(*) FILTER (trim(customer_id) <> '') AS written, count(*) FILTER (trim(customer_id) = '') AS errors
FROM blanked""", _BLANKED))
def cache_write_counts(t):
    return cache.write_counts(_blanked(t))


_LATER = f"""later AS (SELECT {_key_sql('customer_id')} AS cache_key, max(application_id) AS seq FROM features
  WHERE application_id % 3 = 0 GROUP BY 1)"""


_UPSERTED = Q.query("features", """
SELECT coalesce(l.cache_key, s.cache_key) AS cache_key, coalesce(l.seq, s.seq) AS seq,
  CASE WHEN l.seq IS NOT NULL THEN '2024-01-03 00:00:00' ELSE '2024-01-02 00:00:00' END AS expires_at
FROM store s FULL JOIN later l ON s.cache_key = l.cache_key""", _BLANKED, _STORE, _LATER)


@check("cache_upsert", _UPSERTED)
def cache_upsert(t):
    later = cache.batch_write(t.features.filter("application_id % 3 = 0"), _PAYLOAD, written_at=_at("2024-01-02 00:00:00"))
    return cache.upsert(_store(t), later).select(
        "cache_key", "seq", F.date_format("expires_at", "yyyy-MM-dd HH:mm:ss").alias("expires_at"))


@check("store_upsert", _UPSERTED)
def store_upsert(t):
    """The same in a store on disk, of which only the touched buckets are written."""
    later = cache.batch_write(t.features.filter("application_id % 3 = 0"), _PAYLOAD, written_at=_at("2024-01-02 00:00:00"))
    store = FeatureStore(t.spark, staging_path(t.spark, "store"))
    store.upsert(_store(t))
    store.upsert(later)
    return store.read().select("cache_key", "seq", F.date_format("expires_at", "yyyy-MM-dd HH:mm:ss").alias("expires_at"))


@check("cache_lookup", Q.query("features", f"""
SELECT f.application_id, s.cache_key IS NOT NULL AS cache_hit,
  coalesce(s.payload, {_payload_sql(_PAYLOAD)}) AS payload
FROM features f LEFT JOIN store s ON {_key_sql('f.customer_id')} = s.cache_key""", _BLANKED, _STORE))
def cache_lookup(t):
    """A stored vector where one is alive, a computed one elsewhere."""
    found = cache.lookup(t.features, _store(t), _at("2024-01-01 23:59:59"))
    return found.select("application_id", "cache_hit", F.coalesce(
        "cached", cache.payload_text(t.features, _PAYLOAD)).alias("payload"))


@check("uncached_rows", Q.query("features", f"""
SELECT f.application_id FROM features f
WHERE NOT EXISTS (SELECT 1 FROM store s WHERE s.cache_key = {_key_sql('f.customer_id')})""", _BLANKED, _STORE))
def uncached_rows(t):
    return cache.uncached(t.features, _store(t), _at("2024-01-01 12:00:00")).select("application_id")


_GONE = "gone AS (SELECT DISTINCT " + _key_sql("'CUST-' || c_custkey") + " AS cache_key FROM customer WHERE c_custkey % 10 = 0)"


def _deletions(t):
    from lendframe.sources.applications import table

    return table(t.spark, t.sf_dir, "customer").filter("c_custkey % 10 = 0").select(
        F.concat(F.lit("CUST-"), F.col("c_custkey").cast("string")).alias("customer_id"))


_INVALIDATED = Q.query("features", """
SELECT cache_key, seq FROM store WHERE cache_key NOT IN (SELECT cache_key FROM gone)""", _BLANKED, _STORE, _GONE)


@check("cache_invalidate", _INVALIDATED)
def cache_invalidate(t):
    return cache.invalidate(_store(t), _deletions(t)).select("cache_key", "seq")


@check("store_invalidate", _INVALIDATED)
def store_invalidate(t):
    store = FeatureStore(t.spark, staging_path(t.spark, "store"))
    store.upsert(_store(t))
    store.invalidate(_deletions(t))
    return store.read().select("cache_key", "seq")


@check("cache_invalidated_keys", Q.query("features", """
SELECT cache_key, cache_key IN (SELECT cache_key FROM store) AS deleted FROM gone""", _BLANKED, _STORE, _GONE))
def cache_invalidated_keys(t):
    return cache.invalidated(_store(t), _deletions(t))
