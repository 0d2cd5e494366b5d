from emberline.operators import filters

NAN = float("nan")


def test_null_policy(spark):
    df = spark.createDataFrame([(None,), ("l",), ("Low",), ("n",), (" l",)], "confidence string")
    kept = lambda **kw: [r[0] for r in filters.drop_low_confidence(df, **kw).collect()]
    assert kept() == ["n", " l"]
    assert kept(null_policy="keep") == [None, "n", " l"]


def test_without_confidence_power_decides(spark):
    df = spark.createDataFrame([(1.0,), (0.0,), (-2.0,), (None,)], "frp double")
    assert [r[0] for r in filters.drop_low_confidence(df).collect()] == [1.0]


def test_exact_word(spark):
    df = spark.createDataFrame([("low",), ("l",), ("LOW",)], "confidence string")
    assert [r[0] for r in filters.drop_exact_confidence(df).collect()] == ["l", "LOW"]


def test_cleaning_limits(spark):
    data = [
        ("zero", -0.0, 90.0, 180.0),
        ("nan power", NAN, 0.0, 0.0),
        ("null power", None, 0.0, 0.0),
        ("negative", -1.0, 0.0, 0.0),
        ("north", 1.0, 90.0001, 0.0),
        ("nan latitude", 1.0, NAN, 0.0),
        ("null latitude", 1.0, None, 0.0),
        ("west", 1.0, 0.0, -180.5),
    ]
    df = spark.createDataFrame(data, "id string, frp double, latitude double, longitude double")
    assert [r.id for r in filters.clean_detections(df).collect()] == ["zero", "nan power"]
    row = filters.quality_breakdown(df).first().asDict()
    assert row == dict(total=8, bad_frp=2, nan_frp=1, bad_latitude=3, bad_longitude=1, removed=6)


def test_runs_of(spark):
    df = spark.createDataFrame([("polars", "strong"), ("dask", "weak"), ("pandas", "strong")], "backend string, regime string")
    assert filters.runs_of(df, "strong").count() == 2
    assert filters.runs_of(df, "strong", ["polars", "dask"]).count() == 1
    assert filters.runs_of(df).count() == 3
