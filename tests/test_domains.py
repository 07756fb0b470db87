from hypothesis import given, settings
from hypothesis import strategies as st

from linkgap.config import REFERENCE_TARGETS
from linkgap.functions.domains import normalize_domain, reverse_domain, unreverse_domain, url_host


def _one(spark, col_fn, value):
    return spark.createDataFrame([(value,)], "x string").select(col_fn("x").alias("y")).first()["y"]


def test_reverse_domain(spark):
    assert _one(spark, reverse_domain, "notes.kindhost.dev") == "dev.kindhost.notes"
    assert _one(spark, reverse_domain, "Dev.Kindhost.") == "kindhost.dev"
    assert _one(spark, reverse_domain, "localhost") == "localhost"


def test_normalize_domain(spark):
    assert _one(spark, normalize_domain, "\tRow-Digest.IO..\n") == "row-digest.io"
    assert _one(spark, normalize_domain, "wwwx.row-digest.io") == "wwwx.row-digest.io"
    assert _one(spark, normalize_domain, "www.www.row.io...") == "www.row.io"  # one www., every dot


def test_unreverse_keeps_empty_labels(spark):
    assert _one(spark, unreverse_domain, "com.Example") == "example.com"
    assert _one(spark, unreverse_domain, "a..b") == "b..a"
    assert _one(spark, unreverse_domain, "com.x.") == ".x.com"
    assert _one(spark, unreverse_domain, "") == ""


def test_url_host(spark):
    assert _one(spark, url_host, "https://blog.Example.com:8080/a?b#c") == "blog.Example.com"
    assert _one(spark, url_host, "no-scheme") == ""
    assert _one(spark, url_host, "https://user:pw@Example.com:8080/a@b") == "Example.com"


_label = st.text(alphabet="abcdefghijklmnopqrstuvwxyz0123456789-", min_size=1, max_size=8)
_name = st.lists(_label, min_size=1, max_size=4).map(".".join)
_messy = st.text(alphabet="abcXYZw.- \t", max_size=16)


@settings(max_examples=40, deadline=None)
@given(st.lists(_name, min_size=1, max_size=20))
def test_reverse_is_self_inverse(spark, names):
    df = spark.createDataFrame([(n,) for n in names], "x string")
    out = df.select("x", reverse_domain(reverse_domain("x")).alias("y")).collect()
    assert all(r["x"] == r["y"] for r in out)


@settings(max_examples=40, deadline=None)
@given(st.lists(_messy, min_size=1, max_size=20))
def test_column_functions_match_the_stated_steps(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    out = df.select("x", normalize_domain("x").alias("n"), reverse_domain("x").alias("r")).collect()
    for r in out:
        plain = r["x"].strip().lower().rstrip(".")
        plain = plain.removeprefix("www.")
        assert r["n"] == plain and r["r"] == ".".join(plain.split(".")[::-1])


def test_reversed_target_names(spark):
    rows = {r["key"]: r["rev_domain"] for r in REFERENCE_TARGETS.to_df(spark).collect()}
    assert rows == {"own": "co.omni", "sigma": "com.sigmacomputing", "hex": "tech.hex", "mode": "com.mode", "lightdash": "com.lightdash"}
