import pytest
from pyspark.sql import functions as F

from lodestrata.operators import cleaning, expectations as ex, star, summaries


def test_rating_rule(spark, rows):
    raw = spark.createDataFrame([(i, " ab1 ", v) for i, v in enumerate([-1, 0, 5, 6, None])],
                                "rating_id long, restaurant_identifier string, rating int")
    raw = raw.withColumn("timestamp", F.current_timestamp())
    assert rows(cleaning.clean_ratings(raw), "rating") == [(0,), (5,)]
    violated = ex.with_violations(raw, cleaning.RATING_RULES)
    assert rows(violated, "rating", F.size("violations")) == [
        (-1, 1), (0, 0), (5, 0), (6, 1), (None, 1)]


def test_keys_are_normalised(spark, rows):
    ratings = spark.createDataFrame(
        [(1, " ab1 ", 4, "2024-01-01")],
        "rating_id long, restaurant_identifier string, rating int, rating_timestamp string")
    restaurants = spark.createDataFrame([(7, "AB1", "R")],
                                        "restaurant_id long, cnpj string, name string")
    facts = star.fact_ratings(cleaning.clean_ratings(ratings),
                              cleaning.clean_restaurants(restaurants))
    assert rows(facts, "rating_id", "restaurant_id") == [(1, 7)]


def test_dimension_versions(spark, rows):
    restaurants = spark.createDataFrame(
        [(1, "Old", "a"), (1, "New", "a"), (1, "New", "a")],
        "restaurant_id long, name string, cnpj string")
    dimension = star.dim_restaurant(restaurants)
    assert dimension.count() == 2
    assert rows(star.duplicate_keys(dimension, ["restaurant_id"])) == [(1, 2)]
    latest = star.dim_latest(dimension, ["restaurant_id"], [F.col("restaurant_name").desc()])
    assert rows(latest, "restaurant_name") == [("Old",)]


DIM = "restaurant_id long, restaurant_name string, cuisine_type string, city string, country string"
RATING = "rating_id long, restaurant_id long, rating int"
STOCK = "stock_id long, restaurant_id long, product_id long, quantity_available long, inventory_value double"


def test_city_weights(spark, rows):
    dims = spark.createDataFrame([(1, "a", "x", "c", "z"), (2, "b", "x", "c", "z")], DIM)
    ratings = spark.createDataFrame([(1, 1, 4), (2, 1, 4), (3, 1, 4), (4, 2, 4)], RATING)
    stock = spark.createDataFrame([(1, 1, 1, 1, 10.0), (2, 2, 1, 1, 100.0)], STOCK)
    column = "avg_inventory_value_per_restaurant"
    assert rows(summaries.city_summary(dims, ratings, stock), column) == [(32.5,)]
    assert rows(summaries.city_summary(dims, ratings, stock, True), column) == [(55.0,)]


def test_city_without_ratings(spark, rows):
    dims = spark.createDataFrame([(1, "a", "x", None, "z")], DIM)
    got = rows(summaries.city_summary(dims, spark.createDataFrame([], RATING),
                                      spark.createDataFrame([], STOCK)))
    assert got == [(None, "z", 1, 0, None, None)]


def test_having_ten_ratings(spark, rows):
    dims = spark.createDataFrame([(1, "a", "nine", "c", "z"), (2, "b", "ten", "c", "z")], DIM)
    ratings = spark.createDataFrame(
        [(i, 1, 5) for i in range(9)] + [(i, 2, 5) for i in range(10)], RATING)
    assert rows(summaries.cuisine_summary(ratings, dims), "cuisine_type", "total_ratings") == \
        [("ten", 10)]


def plain_restaurant_summary(ratings, dims):
    joined = ratings.join(dims, "restaurant_id")
    return joined.groupBy("restaurant_id", "restaurant_name").agg(
        F.count("rating_id"), F.round(F.avg("rating"), 2),
        F.count_if(F.col("rating") >= 4), F.count_if(F.col("rating") <= 2))


def test_reduced_facts_equal_plain_joins_with_repeated_dimension_rows(spark, rows):
    dims = spark.createDataFrame(
        [(1, "a", "x", "c", "z"), (1, "a", "y", "c", "z"), (1, "a2", "x", "c", "z"),
         (2, "b", "x", "d", "z"), (3, "c", "x", "d", "z")], DIM)
    ratings = spark.createDataFrame([(i, 1 + i % 2, i % 6) for i in range(50)], RATING)
    ours = summaries.restaurant_summary(ratings, dims)
    regrouped = rows(plain_restaurant_summary(ratings, dims))
    got = rows(ours.groupBy("restaurant_id", "restaurant_name").agg(
        F.sum("total_ratings"), F.max("avg_rating"), F.sum("high_ratings_count"),
        F.sum("low_ratings_count")))
    assert got == regrouped

    products = spark.createDataFrame(
        [(1, "p"), (1, "p"), (2, "q")], "product_id long, product_name string").withColumn(
            "product_type", F.lit("t"))
    stock = spark.createDataFrame(
        [(i, 1 + i % 2, 1 + i % 3, i, float(i)) for i in range(30)], STOCK)
    plain = stock.join(products, "product_id").join(
        dims.select("restaurant_id", "restaurant_name", "city", "country"), "restaurant_id")
    wanted = rows(plain.groupBy("restaurant_id", "restaurant_name", "city", "country").agg(
        F.count_distinct("product_id"), F.sum("quantity_available"),
        F.round(F.sum("inventory_value"), 2), F.round(F.avg("inventory_value"), 2)))
    assert rows(summaries.restaurant_inventory(stock, dims, products)) == wanted


def test_fail_and_warn(spark):
    df = spark.range(5)
    rule = ex.Expectation("small", "id < 3", "fail")
    with pytest.raises(Exception, match="violated: small"):
        ex.enforce(df, [rule]).collect()
    assert ex.enforce(df, [ex.Expectation("small", "id < 3", "warn")]).count() == 5
    with pytest.raises(ValueError):
        ex.Expectation("x", "true", "ignore")


def test_observed_counts(spark):
    from pyspark.sql import Observation
    seen = Observation("seen")
    rules = [ex.Expectation("small", "id < 3"), ex.Expectation("even", "id % 2 = 0", "warn")]
    assert ex.enforce(spark.range(5), rules, seen).count() == 3
    assert seen.get == {"rows": 5, "small": 2, "even": 2}


def test_observed_counts_of_a_stream(spark, tmp_path):
    from lodestrata.sources.tables import append_stream, refresh, stream_table
    refresh(spark.range(5), f"{tmp_path}/in")
    checked = ex.enforce(stream_table(spark, f"{tmp_path}/in"),
                         [ex.Expectation("small", "id < 3")], "checked")
    run = append_stream(checked, f"{tmp_path}/out", f"{tmp_path}/cp")
    run.awaitTermination()
    seen = [p["observedMetrics"]["checked"].asDict() for p in run.recentProgress
            if p["numInputRows"]]
    assert seen == [{"rows": 5, "small": 2}]
