"""Queries and steps that must take all of their rows, at a cost that grows with them."""


from lakeloom.operators import quality
from lakeloom.plans import registry
from lakeloom.plans.registry import Lake


def test_one_current_user_looks_at_all_users(spark, sf):
    got = {r.user_id_hashed: r.n for r in registry.QUERIES["dq_one_current_user"](spark, sf).collect()}
    assert got == {r.user_id_hashed: 2 for r in Lake(spark, sf).view("dim_users").select("user_id_hashed").collect()}
    assert "substr" not in registry.ORACLE["dq_one_current_user"].rsplit("AS n", 1)[1]
    rows = spark.createDataFrame([("a", True), ("a", False), ("b", True), ("b", True), ("c", False), ("c", False)], "user_id_hashed string, is_current boolean")
    assert [tuple(r) for r in quality.several_current(rows).collect()] == [("b", 2)]


def test_lines_are_parsed_once(spark, sf):
    """A filter on parsed events doesn't carry the making and parsing of the line down to the scan."""
    for name in ("ts_parse", "flatten"):
        plan = registry.QUERIES[name](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("from_json(") == 1 and plan.count("get_json_object(") == 1, name
    plan = registry.QUERIES["snk_dlq"](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 2 and plan.count("get_json_object(") == 2  # a pass for each of the two reasons


def test_products_are_broadcast_by_their_own_size(spark, sf):
    """The planner's size of the products counts their hashed keys; made from the parts on the fly they looked as small as the parts' file."""
    products = Lake(spark, sf).view("dim_products").select("product_key", "sku")
    plan = products._jdf.queryExecution().optimizedPlan()
    assert "sha2(" not in plan.toString() and "parquet" in plan.toString()
    size = int(str(plan.stats().sizeInBytes()))
    assert 5 * size > products.agg({"sku": "count"}).first()[0] * 64  # a key has 64 characters; four other columns in five are left out
