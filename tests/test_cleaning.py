import pytest
from pyspark.sql import functions as F

from vitalsieve.contracts import ASTHMA, DIABETES, LUNG, PARKINSONS, STROKE, SURVEY_FLAGS
from vitalsieve.functions import columns as fc
from vitalsieve.operators import cleaning, dedup, profile

LUNG_HEADERS = [
    "GENDER", "AGE", "SMOKING", "YELLOW_FINGERS", "ANXIETY", "PEER_PRESSURE", "CHRONIC DISEASE", "FATIGUE ", "ALLERGY ", "WHEEZING",
    "ALCOHOL CONSUMING", "COUGHING", "SHORTNESS OF BREATH", "SWALLOWING DIFFICULTY", "CHEST PAIN", "LUNG_CANCER",
]


def _lung(spark, **changes):
    rows = []
    for i, (g, y) in enumerate([("MALE", "YES"), (" female ", "no"), ("M", "YES"), ("FEMALE", None)]):
        rows.append((g, 60 + i, *[i % 2] * 13, y))
    rows = rows[:2] if not changes else [rows[changes["row"]]]
    df = spark.createDataFrame(rows, ", ".join(f"`{h}` {'string' if h in ('GENDER', 'LUNG_CANCER') else 'int'}" for h in LUNG_HEADERS))
    return df.withColumn("row_id", F.lit(0).cast("long"))


def test_lung_cleaner(spark):
    rows = cleaning.clean(_lung(spark), LUNG).orderBy("age").collect()
    assert [(r.gender, r.age, r.label) for r in rows] == [(1, 60.0, 1), (0, 61.0, 0)]
    assert rows[0].__fields__ == ["row_id", "gender", "age", *SURVEY_FLAGS, "label"]
    cleaning.check_cleaned(cleaning.clean(_lung(spark), LUNG), LUNG)


def test_unmapped_values_are_errors(spark):
    with pytest.raises(Exception, match="Unexpected value in 'gender'"):
        cleaning.clean(_lung(spark, row=2), LUNG).collect()


def test_contract_checks(spark):
    ready = fc.normalise_headers(_lung(spark))
    cleaning.check_table(ready, LUNG)
    with pytest.raises(cleaning.ContractError, match="missing values in target"):
        cleaning.check_table(fc.normalise_headers(_lung(spark, row=3)), LUNG)
    with pytest.raises(cleaning.ContractError, match="Target column"):
        cleaning.check_table(ready.drop("lung_cancer"), LUNG)
    with pytest.raises(cleaning.ContractError, match="Missing expected columns"):
        cleaning.check_table(ready.drop("age"), LUNG)
    with pytest.raises(cleaning.ContractError, match="Unexpected target classes"):
        cleaning.check_table(ready.withColumn("lung_cancer", F.lit("PERHAPS")), LUNG)


def test_cleaned_structure(spark):
    good = cleaning.clean(_lung(spark), LUNG)
    for broken, said in (
        (good.withColumn("smoking", F.lit(2)), "invalid values"),
        (good.withColumn("age", F.lit(float("inf"))), "missing, infinite or blank"),
        (good.withColumn("age", F.lit(None).cast("double")), "missing, infinite or blank"),
        (good.drop("age"), "Expected exactly 15 features"),
        (good.select("row_id", "age", "gender", *SURVEY_FLAGS, "label"), "order mismatch"),
        (good.withColumnRenamed("age", "lung_cancer"), "accidentally included"),
    ):
        with pytest.raises(cleaning.ContractError, match=said):
            cleaning.check_cleaned(broken, LUNG)


def test_headers_that_meet(spark):
    with pytest.raises(ValueError, match="Duplicate column names"):
        fc.normalise_headers(spark.createDataFrame([(1, 2)], "`A b` int, `a_b ` int"))


def test_zeros_become_missing(spark):
    df = spark.createDataFrame([(1, 0, 85, 0, 0, 0, 0.0, 0.3, 30, 1), (2, 2, 0, 70, 20, 90, 30.1, 0.4, 40, 0)], "row_id long, " + ", ".join(
        f"{c} {'double' if c in ('BMI', 'DiabetesPedigreeFunction') else 'int'}" for c in (*DIABETES.numeric, "Outcome")))
    rows = cleaning.clean(df, DIABETES).orderBy("row_id").collect()
    assert rows[0].Insulin is None and rows[0].BMI is None and rows[0].Pregnancies == 0 and rows[1].Glucose is None
    counts = {r.feature: r.converted for r in cleaning.zero_conversions(df, DIABETES.zero_means_missing).collect()}
    assert counts == {"Glucose": 1, "BloodPressure": 1, "SkinThickness": 1, "Insulin": 1, "BMI": 1}
    cleaning.require_zeros(df, ["Pregnancies"])
    with pytest.raises(cleaning.ContractError, match="Age"):
        cleaning.require_zeros(df, ["Age"])


def _stroke(spark):
    head = ["id", "gender", "age", "hypertension", "heart_disease", "ever_married", "work_type", "Residence_type", "avg_glucose_level", "bmi", "smoking_status", "stroke"]
    rows = [
        ("7", " Female", "61", "0", "0", "Yes ", "Private", "Rural", "202.2", "N/A", "never smoked", "1"),
        ("8", "Other", "30", "0", "1", "No", "Govt_job", "Urban", "90.5", "28.1", "Unknown", "0"),
        ("8", "Other", "30", "0", "1", "No", "Govt_job", "Urban", "90.5", "28.1", "Unknown", "0"),
    ]
    return spark.createDataFrame(rows, ", ".join(f"{h} string" for h in head))


def test_stroke_cleaner_keeps_missing_as_missing(spark):
    rows = cleaning.clean(_stroke(spark), STROKE).orderBy("id").collect()
    assert len(rows) == 2 and rows[0].bmi is None and rows[0].gender == "Female" and rows[1].smoking_status == "Unknown"
    assert rows[0].age == 61.0 and [r.label for r in rows] == [1, 0]


def test_audit(spark):
    _, audit = cleaning.clean(_stroke(spark), STROKE, report=True)
    row = audit.filter("feature = 'bmi'").first()
    assert (row.rows_before, row.rows_after, row.missing_before, row.preserved_pct) == (3, 2, 1, 66.67)


def test_asthma_drops_post_outcome_and_unknown_targets(spark):
    kinds = {**{c: "double" for c in ASTHMA.numeric}, **{c: "string" for c in ASTHMA.categorical}}
    schema = "Patient_ID string, " + ", ".join(f"{c} {t}" for c, t in kinds.items()) + ", Has_Asthma string, Asthma_Control_Level string"
    row = lambda i, y: (f"P{i}", *[1.0] * 7, *["None", "x", "Dust", "x", "x", "x", "N/A"], y, "Poor")
    df = spark.createDataFrame([row(1, "1"), row(2, "0"), row(3, "maybe")], schema)
    out = cleaning.clean(df, ASTHMA)
    assert "Asthma_Control_Level" not in out.columns and out.count() == 2
    assert out.filter(F.col("Comorbidities").isNull()).count() == 2


def test_subjects(spark):
    df = spark.createDataFrame([("phon_R01_S01_1",), ("phon_R01_S02_1",)], "name string")
    assert {r.subject_id for r in fc.subject_id(df, "name").collect()} == {"S01", "S02"}
    mixed = spark.createDataFrame([("phon_R01_S01_1",), ("other_9",)], "name string")
    assert {r.subject_id for r in fc.subject_id(mixed, "name").collect()} == {"phon_R01_S01", "other"}
    kinds = "name string, status int, " + ", ".join(f"`{c}` double" for c in PARKINSONS.numeric)
    voice = spark.createDataFrame([("a_S07_1", 1, *[0.1] * 22)], kinds)
    assert cleaning.clean(voice, PARKINSONS).first().subject_id == "S07"


def test_duplicates_keep_the_first_row(spark):
    df = spark.createDataFrame([(3, "a", None), (1, "a", None), (2, "a", 5), (4, "b", 5)], "row_id int, x string, y int")
    assert sorted(r.row_id for r in dedup.drop_duplicate_rows(df, ["x", "y"], "row_id").collect()) == [1, 2, 4]
    split = spark.createDataFrame([("a|b", "c"), ("a", "b|c"), (None, "x"), ("x", None)], "x string, y string")
    assert dedup.with_group_id(split, ["x", "y"]).select("group_id").distinct().count() == 4


def test_checked_numbers(spark):
    df = spark.createDataFrame([("1", "x"), ("2", None)], "a string, b string")
    assert cleaning.checked_number(df, ["a"]).schema["a"].dataType.simpleString() == "double"
    with pytest.raises(cleaning.ContractError, match="'b'"):
        cleaning.checked_number(df, ["a", "b"])


def test_strict_cast_raises(spark):
    with pytest.raises(Exception):
        spark.createDataFrame([("x",)], "a string").select(F.col("a").cast("int")).collect()


def test_profile_of_awkward_columns(spark):
    df = spark.createDataFrame([(1.0, None, "a", "k"), (1.0, None, None, "k")], "`a b` double, `c.d` double, e string, f string")
    rows = {r.feature: r for r in profile.column_profile(df).collect()}
    assert rows["a b"].std == 0.0 and rows["c.d"].median is None and rows["e"].missing == 1 and rows["e"].mean is None
    assert {r.feature for r in profile.constant_columns(df, df.columns).collect()} == {"a b", "c.d", "f"}
    assert fc.columns_of_type(df, "numeric") == ["a b", "c.d"]
