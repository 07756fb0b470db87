"""One source holding a third of all edge rows: results stay exact and the
aggregation combines map-side before the shuffle."""

from pyspark.sql import functions as F

from conftest import SF001, has_data
from linkgap.operators import load as ld
from linkgap.operators import transform as tr

pytestmark = has_data


def _skewed(e, share_of_rest: float = 0.5):
    n = e.count()
    hot = e.orderBy("release", "source_id", "target_domain").limit(1)
    copies = hot.select("*", F.explode(F.sequence(F.lit(1), F.lit(int(n * share_of_rest)))).alias("_k")).drop("_k")
    return e.unionByName(copies), n


def test_mart_exact_under_hot_source(spark):
    from linkgap.plans.catalog import ctx
    c = ctx(spark, SF001)
    e, r, s = c.raw()
    skewed, n = _skewed(e)
    assert skewed.count() >= 1.5 * n - 1  # the hot source holds about a third
    base = tr.opportunity_mart(e, r, s, c.targets, c.params)
    hot = tr.opportunity_mart(skewed.repartition(8), r, s, c.targets, c.params)
    assert base.exceptAll(hot).count() == 0 and hot.exceptAll(base).count() == 0
    plan = hot._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan  # flags are combined before the exchange


def test_load_exact_under_hot_source(spark, tmp_path):
    from linkgap.plans.catalog import ctx
    c = ctx(spark, SF001)
    e, _, _ = c.raw()
    e1 = e.where(F.col("release") == "2026-05")
    skewed, _ = _skewed(e1)
    edges = skewed.select("source_id", "target_domain")
    sources = e1.select("source_id", F.col("source_rev_domain").alias("rev_domain")).distinct()
    ranks = spark.createDataFrame([], "rev_domain string, hc_pos long, pr_pos long")
    counts = ld.load_release(spark, str(tmp_path / "w"), "2026-05", edges.repartition(8), sources, ranks, 10)
    assert counts["raw_backlink_edges"] == skewed.count()
