import json

import pytest
from pyspark.sql import functions as F

from lendframe import schema as S
from lendframe.operators import drift
from lendframe.plans import batch
from lendframe.sources import files


def write_csv(path, names, rows, encoding="utf-8"):
    path.write_text("\n".join([",".join(names), *[",".join(map(str, r)) for r in rows]]) + "\n", encoding=encoding)
    return str(path)


def test_missing_file(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        files.scan_validated(spark, str(tmp_path / "absent.csv"))


def test_wrong_extension(spark, tmp_path):
    path = tmp_path / "data.txt"
    path.write_text("a\n1\n")
    with pytest.raises(ValueError, match="csv"):
        files.scan_validated(spark, str(path))


def test_no_rows(spark, tmp_path):
    path = write_csv(tmp_path / "empty.csv", S.EXPECTED_COLUMNS, [])
    with pytest.raises(ValueError, match="no rows"):
        files.scan_validated(spark, path, validate=False)
    with pytest.raises(ValueError, match="empty"):
        files.scan_batch(spark, path)


def test_missing_columns_are_named(spark, tmp_path):
    path = write_csv(tmp_path / "few.csv", ["age", "gender"], [(1, "Male")] * 3)
    with pytest.raises(ValueError, match="monthly_salary"):
        files.scan_validated(spark, path)
    assert files.scan_validated(spark, path, validate=False).count() == 3


def test_row_gate_and_messy_names(spark, tmp_path):
    names = [f" {c.upper()} " for c in S.EXPECTED_COLUMNS]
    path = write_csv(tmp_path / "rows.csv", names, [[1] * len(names)] * 1100)
    df = files.scan_validated(spark, path)
    assert df.columns == S.EXPECTED_COLUMNS and df.count() == 1100
    short = write_csv(tmp_path / "short.csv", names, [[1] * len(names)] * 5)
    with pytest.raises(ValueError, match="too few"):
        files.scan_validated(spark, short)


def test_other_encoding_and_null_texts(spark, tmp_path):
    path = write_csv(tmp_path / "latin.csv", ["name", "note"], [("José", "NA"), ("x", " kept ")], "latin-1")
    rows = files.scan_validated(spark, path, validate=False).collect()
    assert [tuple(r) for r in rows] == [("José", None), ("x", " kept ")]


def test_a_damaged_file_leaves_the_others_alone(spark, tmp_path):
    folder = tmp_path / "many.csv"
    folder.mkdir()
    (folder / "a.csv").write_bytes("name,amount\nJosé,₹500\n".encode())
    (folder / "b 1.csv").write_bytes("name,amount\nJosé,£7\n".encode("latin-1"))
    (folder / "c.csv").write_bytes("name,amount\na\ufffdb,₹9\n".encode())
    rows = files.scan_validated(spark, str(folder), validate=False).collect()
    assert sorted(map(tuple, rows)) == [("José", "£7"), ("José", "₹500"), ("a\ufffdb", "₹9")]


def test_a_repeated_run_replaces_its_own_folder(spark, tmp_path):
    df = spark.createDataFrame([(0.9, 1)], "clf_proba double, clf_label int")
    for _ in range(2):
        path = files.write_predictions(df, str(tmp_path), "2024-01-01", "run-3", again=True)
    assert spark.read.parquet(path).count() == 1


def test_request_spans_of_large_and_negative_ids(spark):
    from lendframe.operators.scoring import id_span

    ids = [9223372036854775499, 499, 500, -1, -500, -501]
    got = [r[0] for r in spark.createDataFrame([(i,) for i in ids], "i long").select(id_span("i", 500)).collect()]
    assert got == [i // 500 for i in ids]


def test_feature_names_are_a_json_list(spark, tmp_path):
    df = spark.createDataFrame([(1, 2.0, "x")], "age int, bank_balance double, gender string")
    assert files.write_feature_names(df, str(tmp_path / "names")) == ["age", "bank_balance"]
    assert json.loads(spark.read.text(str(tmp_path / "names")).first()[0]) == ["age", "bank_balance"]


def test_size_of_an_input(spark, tmp_path):
    from lendframe.operators.profiling import input_bytes

    (tmp_path / "x.csv").write_text("abc\n")
    assert input_bytes(spark, str(tmp_path / "x.csv")) == 4


def test_quoted_commas_and_line_breaks(spark, tmp_path):
    path = tmp_path / "quoted.csv"
    path.write_text('a,b\n"1,200","x ""y"""\n"two\nlines",z\n')
    rows = files.scan_validated(spark, str(path), validate=False, multiline=True).collect()
    assert [tuple(r) for r in rows] == [("1,200", 'x "y"'), ("two\nlines", "z")]


def test_predictions_are_never_overwritten(spark, tmp_path):
    df = spark.createDataFrame([(0.9, 1)], "clf_proba double, clf_label int")
    path = files.write_predictions(df, str(tmp_path / "out"), "2024-01-01", "run:1+00/a")
    assert path.endswith("batch_date=2024-01-01/run_id=run_1_00_a")
    with pytest.raises(Exception, match="ALREADY_EXISTS|already exists"):
        files.write_predictions(df, str(tmp_path / "out"), "2024-01-01", "run:1+00/a")
    files.write_predictions(df, str(tmp_path / "out"), "2024-01-01", "run2", fmt="csv")


def test_date_from_file_name(spark):
    row = spark.createDataFrame([("x/features_2024-02-29.csv",)], "p string").select(
        files.batch_date("p").cast("string")).first()
    assert row[0] == "2024-02-29"


def test_nightly_job(spark, sample, tmp_path):
    out = batch.nightly(sample, str(tmp_path / "out"), "2024-01-31", "manual", 1000.0)
    assert spark.read.parquet(out["path"]).count() == 10
    assert out["summary"].first()["total_scored"] == 10
    reference = batch.featured_batch(sample, 1000.0)
    watched = batch.nightly(sample, str(tmp_path / "out"), "2024-01-31", "again", 1000.0, reference)
    report = watched["drift"].first()
    assert not report["skipped"] and not report["drift_detected"]
    assert batch.nightly(sample.limit(0), str(tmp_path / "none"), "2024-01-31", "r", 1.0) == {
        "skipped": "input is empty"}


# --- drift ------------------------------------------------------------------
def numbers(spark, low, n, step=1.0):
    return spark.range(n).select((F.col("id") * step + low).alias("x"), (F.col("id") % 3).cast("string").alias("g"))


def test_same_distribution_has_no_drift(spark):
    df = numbers(spark, 0, 1200)
    rows = drift.drift_columns(df, df, ["x", "g"]).collect()
    assert [(r["score"], r["drifted"]) for r in rows] == [(0.0, False)] * 2


def test_large_reference_uses_distances(spark):
    rows = {r["column"]: r for r in drift.drift_columns(
        numbers(spark, 0, 1200), numbers(spark, 600, 1200), ["x", "g"]).collect()}
    # a shift by 600 over the spread of 0..1199
    assert rows["x"]["test"] == "wasserstein" and rows["x"]["score"] == pytest.approx(600 / 346.41, abs=1e-4)
    assert rows["x"]["drifted"] and rows["g"]["test"] == "jensenshannon" and not rows["g"]["drifted"]


def test_small_reference_uses_p_values(spark):
    few = spark.range(90).select(
        (F.col("id") * 1.0).alias("x"), (F.col("id") % 3).cast("string").alias("g"),
        (F.col("id") % 2).cast("string").alias("h"), (F.col("id") % 4).cast("double").alias("few"))
    other = few.withColumns({"x": F.col("x") + 60, "h": F.when(F.col("x") < 80, "0").otherwise("1")})
    rows = {r["column"]: r for r in drift.drift_columns(few, other, ["x", "g", "h", "few"]).collect()}
    assert {c: r["test"] for c, r in rows.items()} == {"x": "ks", "g": "chisquare", "h": "z", "few": "chisquare"}
    assert rows["x"]["drifted"] and rows["h"]["drifted"]
    assert rows["g"]["score"] == 1.0 and rows["few"]["score"] == 1.0


def test_two_share_z_value(spark):
    a = spark.range(100).select(F.when(F.col("id") < 50, "u").otherwise("v").alias("h"))
    b = spark.range(100).select(F.when(F.col("id") < 65, "u").otherwise("v").alias("h"))
    row = drift.drift_columns(a, b, ["h"]).first()
    z = 0.15 / (0.575 * 0.425 * 0.02) ** 0.5
    from lendframe.functions.pvalues import normal_two_sided_tail

    assert row["score"] == pytest.approx(normal_two_sided_tail(z), abs=1e-6)


def test_columns_without_values(spark):
    df = numbers(spark, 0, 1200)
    gone = df.withColumns({"x": F.lit(None).cast("double")})
    rows = {r["column"]: r for r in drift.drift_columns(df, gone, ["x", "g"]).collect()}
    assert rows["x"]["drifted"] and rows["x"]["score"] is None and not rows["g"]["drifted"]
    rows = {r["column"]: r for r in drift.drift_columns(gone, gone, ["x", "g"]).collect()}
    assert not rows["x"]["drifted"] and rows["x"]["n_values"] == 0


def test_a_test_of_choice(spark):
    rows = drift.drift_columns(numbers(spark, 0, 1200), numbers(spark, 600, 1200), ["x"], tests={"x": "ks"}).collect()
    assert rows[0]["test"] == "ks" and rows[0]["drifted"]
    with pytest.raises(ValueError, match="unknown"):
        drift.drift_columns(numbers(spark, 0, 5), numbers(spark, 0, 5), ["x"], tests={"x": "psi"})


def test_too_few_shared_columns_are_no_drift(spark):
    df = numbers(spark, 0, 20)
    row = drift.guarded_drift(spark, lambda: df, lambda: df).first()
    assert not row["drift_detected"] and not row["skipped"] and row["layer1_columns"] == []


def test_missing_table_is_a_skipped_row(spark, tmp_path):
    row = drift.guarded_drift(spark, lambda: numbers(spark, 0, 5),
                              lambda: spark.read.parquet(str(tmp_path / "absent"))).first()
    assert row["skipped"] and not row["drift_detected"] and row["skip_reason"]


def test_profiles_stand_for_their_rows_and_merge(spark, tmp_path):
    df = numbers(spark, 1e6, 1500, 0.25).withColumns({"gone": F.lit(None).cast("double"), "blank": F.lit(None).cast("string")})
    current = numbers(spark, 1e6 + 100, 900, 0.25).withColumns({"gone": F.lit(1.0), "blank": F.lit("x")})
    columns = ["x", "g", "gone", "blank"]
    want = drift.drift_columns(df, current, columns).orderBy("column").collect()
    parts = []
    for k in range(2):
        path = str(tmp_path / f"profile{k}")
        drift.Profile.of(df.filter((F.col("x") * 4 % 2) == k), columns).write(path)
        parts.append(drift.Profile.read(spark, path))
    merged = parts[0].merged(parts[1])
    assert merged.kinds == {"x": "double", "gone": "double", "g": "string", "blank": "string"}
    assert merged.numbers.agg(F.sum("n")).first()[0] == 1500
    assert drift.drift_columns(merged, current, columns).orderBy("column").collect() == want
    with pytest.raises(ValueError):
        merged.merged(drift.Profile.of(df, ["x"]))
