import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    s = (SparkSession.builder.master("local[*]").appName("linkgap-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    yield s


# A small web graph of our own around the tracked domains (their names are
# fixed values, see linkgap/config.py). Vertex ids follow the reversed names.
OWN_GRAPH = {
    "chart-notes.com": ["sigmacomputing.com", "hex.tech", "lightdash.com"],
    "row-digest.io": ["sigmacomputing.com", "mode.com"],
    "kindhost.dev": ["omni.co", "hex.tech"],
    "llone-link.net": ["mode.com"],
    "elsewhere.org": ["llone-link.net"],
}


def own_graph_frames(spark):
    """(vertices, edges, ranks, stats) of ``OWN_GRAPH``; positions in name order."""
    from linkgap.config import REFERENCE_TARGETS
    def rev(name):
        return ".".join(name.split(".")[::-1])

    names = sorted({rev(d) for d in OWN_GRAPH} | {rev(t.domain) for t in REFERENCE_TARGETS.all})
    ids = {n: i for i, n in enumerate(names)}
    edges = [(ids[rev(a)], ids[rev(b)]) for a, to in OWN_GRAPH.items() for b in to]
    ranks = [(i + 1, 0.5, i + 1, 0.001, n) for n, i in ids.items()]
    return (spark.createDataFrame([(i, n) for n, i in ids.items()], "id long, rev_domain string").coalesce(1),
            spark.createDataFrame(edges, "src long, dst long").coalesce(1),
            spark.createDataFrame(ranks, "hc_pos long, hc_val double, pr_pos long, pr_val double, rev_domain string"),
            spark.createDataFrame([("nodes", len(names)), ("arcs", len(edges))], "key string, value long"))


@pytest.fixture(scope="session")
def toy_files(spark, tmp_path_factory):
    """The own graph in web-graph layout (folders of gzip parts), by the package's writer."""
    from linkgap.sources.graph_files import write_graph_files

    d = str(tmp_path_factory.mktemp("toy"))
    return {**write_graph_files(*own_graph_frames(spark), d), "dir": d}


@pytest.fixture()
def root(tmp_path):
    return str(tmp_path / "warehouse")


SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"
has_data = pytest.mark.skipif(not os.path.exists(SF001), reason="driver test data missing")
