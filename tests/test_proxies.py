"""The proxy views stand for whole tables: no row of what they are made from is left out."""

from pathlib import Path

import pytest

from shelfwright.jobs import proxies

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="needs the driver's tables")


@pytest.mark.parametrize("name", ["px_titles", "px_streams", "px_candidates", "px_src"])
def test_whole(spark, name):
    proxies.register(spark, SF)
    assert proxies.view(spark, name).count() == spark.table("lineitem").count()


def test_discs_grow_with_the_orders(spark):
    proxies.register(spark, SF)
    small = proxies.view(spark, "px_titles").groupBy("disc").count().agg({"disc": "count", "count": "max"}).first()
    proxies.register(spark, SF.replace("0.001", "0.01"))
    large = proxies.view(spark, "px_titles").groupBy("disc").count().agg({"disc": "count", "count": "max"}).first()
    assert large["count(disc)"] > 8 * small["count(disc)"] and large["max(count)"] < 2 * small["max(count)"]


def test_candidates_name_parts_of_the_whole_table(spark):
    proxies.register(spark, SF.replace("0.001", "0.01"))
    parts = spark.table("part").count()
    named = spark.sql(f"WITH {proxies.with_parts(['px_candidates'])} SELECT DISTINCT rk FROM px_candidates WHERE NOT startswith(title, 'Audio')").count()
    others = spark.sql(f"WITH {proxies.with_parts(['px_candidates'])} SELECT DISTINCT p.p_partkey FROM px_candidates c JOIN part p ON startswith(c.title, replace(p.p_name, ' ', '.') || '.S0') AND c.rk <> p.p_partkey").count()
    assert named == parts and others > parts // 2
