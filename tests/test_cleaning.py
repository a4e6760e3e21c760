from pyspark.sql import functions as F

from shelfwise.functions import cleaning as C
from shelfwise.plans.preparation import prepare


def column(df, name):
    return [row[name] for row in df.collect()]


def test_prices_from_text(spark):
    texts = ["$25.99", "€18.50", "£22.75", "invalid_price", None, "1,299.00", ".5", "-5", "12."]
    df = C.extract_price(spark.createDataFrame([(t,) for t in texts], "Price string"))
    assert column(df, "price_numeric") == [25.99, 18.5, 22.75, 0.0, 0.0, 1.0, 5.0, 5.0, 12.0]


def test_numeric_price_column(spark):
    df = C.extract_price(spark.createDataFrame([(30.0,), (-5.0,), (float("nan"),), (1e7,), (None,)], "Price double"), 15.0)
    assert column(df, "price_numeric") == [30.0, 5.0, 15.0, 1e7, 15.0]


def test_price_without_column(spark):
    df = spark.createDataFrame([("France",), ("Italy",)], "Country string")
    assert column(C.extract_price(df), "price_numeric") == [0.0, 0.0]
    supplied = spark.createDataFrame([("7.5",), ("x",), (None,)], "price_numeric string")
    assert column(C.extract_price(supplied, 15.0), "price_numeric") == [7.5, 15.0, 15.0]


def test_synthetic_rating_only_where_absent(spark):
    df = prepare(spark.createDataFrame([("France", "$30.00"), ("Italy", "$40.00")], "Country string, Price string"))
    assert column(df, "Rating") == [5.0, 5.0]
    rated = prepare(spark.createDataFrame([("$30.00", 4.2)], "Price string, Rating double"))
    assert column(rated, "Rating") == [4.2]


def test_fill_existing_columns_only(spark):
    df = spark.createDataFrame([("France", "A", None), (None, "B", "Red"), ("Italy", None, "White")], "Country string, Region string, Type string")
    filled = C.fill_categoricals(df)
    assert filled.columns == ["Country", "Region", "Type"]
    assert column(filled, "Country") == ["France", "Unknown", "Italy"]
    assert column(filled, "Region") == ["A", "B", "Unknown"]
    assert column(filled, "Type") == ["Unknown", "Red", "White"]


def test_missing_words(spark):
    df = spark.createDataFrame([("NA",), ("null",), ("",), ("Nancy",), (" NA",)], "Country string")
    assert column(C.normalize_na(df), "Country") == [None, None, None, "Nancy", " NA"]


def test_combined_text_keeps_gaps(spark):
    df = spark.createDataFrame([("fresh", None, "Crisp", "Italy")], "Characteristics string, Grape string, Style string, Country string")
    assert column(C.combined_features(df), "combined_features") == ["fresh  Crisp Italy"]


def test_grade_of_unrounded_score(spark):
    df = spark.createDataFrame([(4.5,), (4.496,), (4.0,), (3.999,)], "s double").select(C.quality_grade(F.col("s")).alias("g"))
    assert column(df, "g") == ["Excellent", "Good", "Good", "Average"]
