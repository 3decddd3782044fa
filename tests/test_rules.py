"""Row rules (M1..M6, F1..F9, U1) on hand-made edge rows."""
import math

from pyspark.sql import functions as F

from conftest import frame
from framewatch.config import GateConfig, CAMERA_ID_PATTERN_UNICODE
from framewatch.functions import rules as R

CFG = GateConfig(embedding_dim=8)


def checks(spark, df, cfg=CFG):
    out = R.evaluate_rules(df, cfg).orderBy("seq").collect()
    return {r["seq"]: [(x["column"], x["check"]) for x in r["failed_rules"]] for r in out}


def test_valid_row_passes(spark, make_frames):
    assert checks(spark, make_frames([frame(0)])) == {0: []}


def test_brightness_bounds_inclusive(spark, make_frames):
    rows = [frame(0, b=10.0), frame(1, b=255.0), frame(2, b=9.999), frame(3, b=255.001),
            frame(4, b=1.0), frame(5, b=300.0)]
    got = checks(spark, make_frames(rows))
    assert got[0] == [] and got[1] == []
    for s in (2, 3, 4, 5):
        assert got[s] == [("brightness_avg", "_brightness_valid")]


def test_blur_nonnegative_and_nan_null(spark, make_frames):
    rows = [frame(0, blur=0.0), frame(1, blur=-0.01), frame(2, blur=float("nan")), frame(3, blur=None),
            frame(4, b=float("nan")), frame(5, b=None)]
    got = checks(spark, make_frames(rows))
    assert got[0] == []
    assert got[1] == [("blur_metric", "_blur_valid")]
    # NaN counts as null: the element check is not run on it
    assert got[2] == [("blur_metric", "not_nullable")]
    assert got[3] == [("blur_metric", "not_nullable")]
    assert got[4] == [("brightness_avg", "not_nullable")]
    assert got[5] == [("brightness_avg", "not_nullable")]


def test_camera_id_full_match(spark, make_frames):
    rows = [frame(0, cam="camera_12"), frame(1, cam="camera_1\n"), frame(2, cam="invalid_cam"),
            frame(3, cam="cam_1"), frame(4, cam="camera_x"), frame(5, cam="camera_١"),
            frame(6, cam="xcamera_1")]
    got = checks(spark, make_frames(rows))
    assert got[0] == []
    for s in (1, 2, 3, 4, 5, 6):
        assert got[s] == [("camera_id", "_camera_id_valid")], s
    # Unicode digits pass when the pattern follows Python's \d
    uni = checks(spark, make_frames(rows), CFG.with_(camera_id_pattern=CAMERA_ID_PATTERN_UNICODE))
    assert uni[5] == [] and uni[1] != []


def test_embedding_dimension_and_null(spark, make_frames):
    rows = [frame(0, emb=[0.0] * 8), frame(1, emb=[0.0] * 4), frame(2, emb=None), frame(3, emb=[])]
    got = checks(spark, make_frames(rows))
    assert got[0] == []
    assert got[1] == [("embedding", "_embedding_has_expected_dim")]
    assert got[2] == [("embedding", "not_nullable")]
    assert got[3] == [("embedding", "_embedding_has_expected_dim")]


def test_all_failures_collected(spark, make_frames):
    rows = [frame(0, cam="bad_camera", b=1.0, blur=-0.5, emb=[0.0] * 3)]
    got = checks(spark, make_frames(rows))
    assert got[0] == [("camera_id", "_camera_id_valid"), ("brightness_avg", "_brightness_valid"),
                      ("blur_metric", "_blur_valid"), ("embedding", "_embedding_has_expected_dim")]


def test_failure_case_values(spark, make_frames):
    out = R.evaluate_rules(make_frames([frame(0, b=5.0, emb=[1.0] * 3)]), CFG).collect()[0]
    cases = {r["check"]: r["failure_case"] for r in out["failed_rules"]}
    assert float(cases["_brightness_valid"]) == 5.0
    assert cases["_embedding_has_expected_dim"] == "3"


def test_coercion_text_in_numeric_column(spark):
    df = spark.createDataFrame(
        [(0, "camera_1", 1, "t", "camera_1", "f0", "12.5", 0.1, [0.0] * 8),
         (1, "camera_1", 1, "t", "camera_1", "f1", "bright", 0.1, [0.0] * 8)],
        "seq long, feed_id string, batch_round int, timestamp string, camera_id string, frame_id string, "
        "brightness_avg string, blur_metric double, embedding array<double>")
    out = {r["seq"]: r for r in R.evaluate_rules(df, CFG).collect()}
    assert out[0]["brightness_avg"] == 12.5 and out[0]["is_valid"]
    assert out[1]["brightness_avg"] is None
    assert ("brightness_avg", "coerce_dtype('float64')") in [(x["column"], x["check"]) for x in out[1]["failed_rules"]]


def test_missing_column_is_schema_level(spark, make_frames):
    df = make_frames([frame(0)]).drop("blur_metric")
    v = R.contract_violations(df)
    assert v == [{"column": "blur_metric", "check": "column_in_dataframe", "failure_case": "blur_metric"}]
    # rows themselves stay valid (no row index for a schema-level failure)
    assert R.evaluate_rules(df, CFG).collect()[0]["is_valid"]


def test_array_with_an_unreadable_element_is_a_failure(spark):
    df = spark.createDataFrame([(0, ["1"] * 8), (1, ["1"] * 7 + ["oops"]), (2, ["1"] * 7 + [None])], "seq long, embedding array<string>")
    out = {r["seq"]: r for r in R.evaluate_rules(df, CFG).collect()}
    assert out[0]["is_valid"] and out[0]["embedding"] == [1.0] * 8
    assert [x["check"] for x in out[1]["failed_rules"]][0] == "coerce_dtype('array<double>')"
    assert out[2]["is_valid"]


def test_extra_columns_pass_through(spark, make_frames):
    df = make_frames([frame(0)]).withColumn("extra", F.lit(7))
    out = R.evaluate_rules(df, CFG).collect()[0]
    assert out["extra"] == 7 and out["is_valid"]


def test_custom_rule(spark, make_frames):
    rule = R.custom_rule("brightness_avg", "not_too_bright", "brightness_avg < 200")
    df = make_frames([frame(0, b=100.0), frame(1, b=250.0)])
    out = {r["seq"]: [x["check"] for x in r["failed_rules"]]
           for r in R.evaluate_rules(df, CFG, R.default_rules(CFG) + [rule]).collect()}
    assert out[0] == [] and out[1] == ["not_too_bright"]


def test_clamp_keeps_null_and_nan(spark):
    df = spark.createDataFrame([(1, -5.0), (2, 300.0), (3, None), (4, float("nan")), (5, 20.0)], "k int, x double")
    out = {r["k"]: r["c"] for r in df.select("k", R.clamp(F.col("x"), 10.0, 255.0).alias("c")).collect()}
    assert out[1] == 10.0 and out[2] == 255.0 and out[3] is None and math.isnan(out[4]) and out[5] == 20.0
