"""Benchmark: the link-gap pipeline on the graph derived from
``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on ``local[$BENCH_CPUS]``.

Times the extract+load of both releases (``etl_load``), then each headline
query fully executed into Spark's ``noop`` sink, and the target filter over
an edge list scaled ``$BENCH_EDGE_COPIES`` times (copies get offset source
ids). Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ["inbound_edges", "source_domains", "staged_edges", "competitor_coverage", "opportunity_mart",
            "ranked_opportunities", "merge_duplicates", "top_opportunities", "report_rows",
            "category_sections", "report_totals", "topic_top25", "opportunities_by_category", "dq_summary"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    copies = int(os.environ.get("BENCH_EDGE_COPIES", "20"))

    from pyspark.sql import functions as F

    from linkgap.operators import extract as ex
    from linkgap.plans import catalog
    from linkgap.session import local_session, new_run_dir

    spark = local_session(cores=cpus, shuffle_partitions=2 * int(cpus) if cpus.isdigit() else 16,
                          app="linkgap-bench")
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}

    errors: dict[str, str] = {}

    def run(name, fn):
        t0 = time.perf_counter()
        try:
            fn()
        except Exception as e:  # noqa: BLE001 — e.g. the report refuses to pad below N companies
            errors[name] = f"{type(e).__name__}: {str(e)[:120]}"
            return
        times[name] = round(time.perf_counter() - t0, 3)

    spark.range(1).count()  # session warm-up, not part of any timing
    c = catalog.ctx(spark, sf_dir, reuse=False)  # a fresh build
    c.build(times)  # graph_convert: derive the graph, write Parquet; etl_load: extract+load, curated, mart
    # Warm rerun: every extraction step is already recorded done and skipped,
    # the loads re-run (idempotent), then the mart is rebuilt from the new runs.
    from linkgap.plans import pipeline as pl
    run("warm_rerun", lambda: (pl.run_releases(spark, c.root, c.releases(), c.targets),
                               c.mart_plan().write.format("noop").mode("overwrite").save()))
    qs = catalog.QUERIES
    for name in HEADLINE:
        run(name, lambda n=name: qs[n](spark, sf_dir).write.format("noop").mode("overwrite").save())

    # Scaled edge list: the extraction filter must stay a map-only scan.
    base = new_run_dir(spark, "bench-edges")
    rel = c.releases()[1]
    rel.edges.write.parquet(base)
    edges = spark.read.parquet(base)
    copied = new_run_dir(spark, "bench-edges-copied")  # written before timing: the timed plan scans every row
    (edges.select("src", "dst", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("k"))
     .select((F.col("src") + F.col("k") * F.lit(100_000_000)).alias("src"), "dst").write.parquet(copied))
    big = spark.read.parquet(copied)
    ids = ex.find_target_ids(rel.vertices, c.targets)
    n_big = edges.count() * copies
    run("inbound_edges_scaled", lambda: ex.inbound_edges(big, ids).write.format("noop").mode("overwrite").save())

    # The transform stage over raw tables with every source copied
    # BENCH_EDGE_COPIES times (new domain names per copy). The copies are
    # written first (not timed) so the timed plan reads ordinary files.
    from linkgap.operators import transform as tr
    e, r, s = c.raw()
    ks = F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("k")
    scaled = new_run_dir(spark, "bench-raw")
    for name, df in (("edges", e), ("ranks", r)):
        (df.select("*", ks).withColumn("source_rev_domain", F.concat("source_rev_domain", F.lit("-"), "k"))
         .drop("k").repartition(2 * (int(cpus) if cpus.isdigit() else 8)).write.parquet(f"{scaled}/{name}"))
    big_e, big_r = spark.read.parquet(f"{scaled}/edges"), spark.read.parquet(f"{scaled}/ranks")
    run("opportunity_mart_scaled", lambda: tr.opportunity_mart(big_e, big_r, s, c.targets, c.params)
        .write.format("noop").mode("overwrite").save())

    end_to_end = (times["graph_convert"] + times["etl_load"]
                  + sum(times.get(q, 0.0) for q in ("opportunity_mart", "merge_duplicates", "report_rows")))
    print(json.dumps({
        "metric": "end_to_end_sec", "value": round(end_to_end, 3), "unit": "sec",
        "queries": times, "sf": float(sf_dir.rsplit("sf", 1)[-1]) if "sf" in sf_dir else None,
        "scaled_edges_rows": n_big, "cpus": cpus, **({"errors": errors} if errors else {}),
    }))


if __name__ == "__main__":
    main()
