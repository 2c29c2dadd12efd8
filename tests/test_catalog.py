"""Models registered as views."""

from barlake.plans.catalog import register_models
from barlake.sources.seed import seed_from_rows
from test_adhoc import fixture


def test_models_are_registered_under_their_names(spark):
    silver, _ = fixture(spark)
    seed = seed_from_rows(spark, [("A", "a", "Energy", "x"), ("B", "b", "Energy", "x"),
                                  ("C", "c", "Healthcare", "x")])
    views = register_models(spark, silver, seed, prefix="t_")
    for name, df in views.items():
        assert spark.table("t_" + name).count() == df.count()


def test_a_parameter_is_a_value_and_not_text(spark):
    """Ad-hoc SQL over the views takes parameters as arguments."""
    silver, _ = fixture(spark)
    register_models(spark, silver, seed_from_rows(spark, []), prefix="q_")
    got = spark.sql("SELECT count(*) AS n FROM q_silver_stock_prices WHERE ticker = :t", args={"t": "O'X"})
    assert got.first().n == 0
