"""A web link graph derived from the driver's relational tables.

The driver tables carry no cross-domain links, so the graph is built from
the order data: customers are referring domains, part brands are the
tracked targets, an order line is a link from the ordering customer to the
part's brand, and the order year picks the release. Everything is a lazy
DataFrame over the given tables, so its size grows with them.

Fixture parameters. Every order line is a link and every customer a vertex;
which of them are ranked or curated follows from the customer's market segment:

* customer label by ``c_custkey % 7``: top10, academy, devdocs, dailywire,
  saashub, shop, toolsnews — one per keyword category plus ``other``;
* brand vertex id = 10000000 + brand number, name ``co.brand-<n>``;
* release ``2026-05`` for order years up to 1997, else ``2026-06``;
* customers of the segment MACHINERY get no rank (exercises the unranked
  path); hc/pr positions of the others by order value / order count;
* customers of the segment AUTOMOBILE have a curated category;
* same-company groups: mart rows with equal ``custkey div 10``;
* a broken vertex file lacks ids with ``id % 97 = 0`` (unresolved edges).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Target, Targets
from ..operators.ranking import rank_positions

CUSTOMER_LABELS = ("top10", "academy", "devdocs", "dailywire", "saashub", "shop", "toolsnews")
BRAND_ID_BASE = 10_000_000
RELEASES = ("2026-05", "2026-06")
SPLIT_YEAR = 1997
UNRANKED_SEGMENT = "MACHINERY"
CURATED_SEGMENT = "AUTOMOBILE"
COMPANY_DIV = 10
BROKEN_MOD = 97

# Own brand 1, competitors brands 2-5.
GRAPH_TARGETS = Targets(
    own=Target("own", "brand-1.co"),
    competitors=tuple(Target(f"brand{i}", f"brand-{i}.co") for i in range(2, 6)),
    display_names=tuple(f"Brand {i}" for i in range(2, 6)),
)


@dataclass
class Tables:
    """The driver tables one graph is derived from."""

    customer: DataFrame
    orders: DataFrame
    lineitem: DataFrame
    part: DataFrame

    @classmethod
    def read(cls, spark: SparkSession, sf_dir: str) -> "Tables":
        r = lambda t: spark.read.parquet(f"{sf_dir.rstrip('/')}/{t}.parquet")
        return cls(r("customer"), r("orders"), r("lineitem"), r("part"))


def customer_rev_domain(custkey) -> F.Column:
    k = F.col(custkey) if isinstance(custkey, str) else custkey
    labels = F.array(*[F.lit(x) for x in CUSTOMER_LABELS])
    label = F.element_at(labels, (F.pmod(k, F.lit(len(CUSTOMER_LABELS))) + 1).cast("int"))
    return F.concat(F.lit("com."), label, F.lit("-"), k.cast("string"))


def brand_number(p_brand="p_brand") -> F.Column:
    return F.regexp_extract(F.col(p_brand), r"#(\d+)$", 1).cast("long")


def vertices(t: Tables) -> DataFrame:
    cust = t.customer.select(F.col("c_custkey").alias("id"),
                             customer_rev_domain("c_custkey").alias("rev_domain"))
    brands = (t.part.select(brand_number().alias("n")).distinct()
              .select((F.lit(BRAND_ID_BASE) + F.col("n")).alias("id"),
                      F.concat(F.lit("co.brand-"), F.col("n").cast("string")).alias("rev_domain")))
    return cust.unionByName(brands)


def release_of(orders: DataFrame) -> F.Column:
    bound = F.lit(f"{SPLIT_YEAR + 1}-01-01 00:00:00").cast(orders.schema["o_orderdate"].dataType)
    return (F.when(F.col("o_orderdate") < bound, F.lit(RELEASES[0]))
            .when(F.col("o_orderdate") >= bound, F.lit(RELEASES[1])))


def edges_all(t: Tables) -> DataFrame:
    """(release, src, dst) of every release in one plan."""
    o = t.orders.select("o_orderkey", "o_custkey", release_of(t.orders).alias("release")).where("release IS NOT NULL")
    li = t.lineitem.select("l_orderkey", "l_partkey")
    p = t.part.select("p_partkey", (F.lit(BRAND_ID_BASE) + brand_number()).alias("dst"))
    return (li.join(o, li.l_orderkey == o.o_orderkey)
            .join(p, F.col("l_partkey") == p.p_partkey)
            .select("release", F.col("o_custkey").alias("src"), "dst"))


def ranks_all(t: Tables) -> DataFrame:
    """(release, hc_pos, hc_val, pr_pos, pr_val, rev_domain) of every release;
    positions restart per release (grouped, still distributed)."""
    ranked = t.customer.where(F.col("c_mktsegment") != UNRANKED_SEGMENT).select(F.col("c_custkey").alias("o_custkey"))
    per_cust = (t.orders.select("o_custkey", "o_totalprice", release_of(t.orders).alias("release"))
                .where(F.col("release").isNotNull()).join(ranked, "o_custkey", "left_semi")
                .groupBy("release", "o_custkey")
                .agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("value"),
                     F.count(F.lit(1)).alias("n_orders")))
    hc = rank_positions(per_cust, [F.col("value").desc(), F.col("o_custkey").asc()], "hc_pos", group="release")
    both = rank_positions(hc, [F.col("n_orders").desc(), F.col("o_custkey").asc()], "pr_pos", group="release")
    return both.select("release", "hc_pos", F.col("value").cast("double").alias("hc_val"), "pr_pos",
                       F.col("n_orders").cast("double").alias("pr_val"),
                       customer_rev_domain("o_custkey").alias("rev_domain"))


def convert_graph(spark: SparkSession, t: Tables, out: str, identity: str) -> dict[bool, list]:
    """Write the derived graph once as Parquet — vertices sorted by name,
    edges and ranks of all releases in one job each, partitioned by
    release, edges sorted by destination inside each file — and return the
    per-release inputs for both vertex variants (the broken one is a
    filtered read)."""
    vertices(t).sortWithinPartitions("rev_domain").write.mode("overwrite").parquet(f"{out}/vertices")
    # No repartition by release: that would send a whole release to one
    # task. Each task sorts its own rows and writes one file per release.
    (edges_all(t).sortWithinPartitions("release", "dst", "src")
     .write.mode("overwrite").partitionBy("release").parquet(f"{out}/edges"))
    (ranks_all(t).select("release", "rev_domain", "hc_pos", "pr_pos", "hc_val", "pr_val")
     .write.mode("overwrite").partitionBy("release").parquet(f"{out}/ranks"))
    return graph_inputs(spark, out, identity)


def graph_inputs(spark: SparkSession, out: str, identity: str) -> dict[bool, list]:
    """Per-release inputs over a graph written by ``convert_graph``."""
    from ..plans.pipeline import ReleaseInputs

    def inputs(broken: bool) -> list:
        v = spark.read.parquet(f"{out}/vertices")
        if broken:
            v = v.where(F.pmod(F.col("id"), F.lit(BROKEN_MOD)) != 0)
        out_list = []
        for label in RELEASES:
            e = spark.read.parquet(f"{out}/edges").where(F.col("release") == label).drop("release")
            r = spark.read.parquet(f"{out}/ranks").where(F.col("release") == label).drop("release")
            out_list.append(ReleaseInputs(label, v, e, r, stats_of(v, e),
                                          identity=f"{identity}|{label}|broken={broken}"))
        return out_list
    return {False: inputs(False), True: inputs(True)}


def stats_of(vertices_df: DataFrame, edges_df: DataFrame) -> DataFrame:
    nodes = vertices_df.agg(F.count(F.lit(1)).alias("value")).select(F.lit("nodes").alias("key"), "value")
    arcs = edges_df.agg(F.count(F.lit(1)).alias("value")).select(F.lit("arcs").alias("key"), "value")
    return nodes.unionByName(arcs)


def overrides(t: Tables) -> DataFrame:
    """Curated categories: (source_domain, category)."""
    return (t.customer.where(F.col("c_mktsegment") == CURATED_SEGMENT)
            .select(customer_rev_domain("c_custkey").alias("rev"),
                    F.lower("c_mktsegment").alias("category"))
            .select(_unrev("rev").alias("source_domain"), "category"))


def actions(t: Tables) -> DataFrame:
    """One suggested action per customer domain (text holds commas)."""
    return t.customer.select(
        _unrev(customer_rev_domain("c_custkey")).alias("source_domain"),
        F.concat(F.lit("Contact "), F.col("c_name"), F.lit(", "), F.lower("c_mktsegment"),
                 F.lit(" segment.")).alias("action"))


def custkey_of(domain) -> F.Column:
    d = F.col(domain) if isinstance(domain, str) else domain
    return F.regexp_extract(d, r"-(\d+)\.com$", 1).cast("long")


def duplicates(mart: DataFrame) -> DataFrame:
    """Same-company pairs among mart rows: rows with equal ``custkey div
    10`` are one company; the smallest key is canonical."""
    rows = mart.select("source_domain", custkey_of("source_domain").alias("k"))
    rows = rows.withColumn("g", F.floor(F.col("k") / F.lit(COMPANY_DIV)))
    groups = rows.groupBy("g").agg(F.min("k").alias("canon_k"))
    canon = rows.join(groups, "g").where(F.col("k") != F.col("canon_k"))
    return canon.select(
        _unrev(customer_rev_domain("canon_k")).alias("canonical_domain"),
        F.col("source_domain").alias("duplicate_domain"),
        F.lit("same company").alias("note"))


def _unrev(c) -> F.Column:
    from ..functions.domains import unreverse_domain
    return unreverse_domain(c)
