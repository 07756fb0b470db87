"""The README's usage example, executed on the toy graph."""

from pathlib import Path

from conftest import ROOT


def test_readme_usage_runs(spark, tmp_path, toy_files):
    d = tmp_path
    for name, kind in (("domain-vertices.txt.gz", "vertices"), ("domain-edges.txt.gz", "edges"),
                       ("domain-ranks.txt.gz", "ranks"), ("domain.stats", "stats")):
        (d / name).symlink_to(toy_files[kind])
    (d / "category_overrides.csv").write_text("source_domain,category\nchart-notes.com,directory\n"
                                               "row-digest.io,news/media\n")
    (d / "actions.csv").write_text('source_domain,action\nchart-notes.com,"Pitch, politely"\nrow-digest.io,Submit\n')
    (d / "duplicates.csv").write_text("canonical_domain,duplicate_domain,note\n")

    src = (Path(ROOT) / "README.md").read_text()
    code = src.split("## Usage\n\n```python\n")[1].split("```")[0]
    code = code.replace('"<shared folder>/backlinks"', repr(str(d / "root")))
    code = code.replace("rp.top_k(merged, TOP_N)", "rp.top_k(merged, 2)")  # the toy graph has 2 companies
    for n in ("category_overrides.csv", "duplicates.csv", "actions.csv"):
        code = code.replace(f'"{n}"', repr(str(d / n)))
    exec(code, {"spark": spark, "releases": [("2026-05", str(d))]})  # noqa: S102

    rows = spark.read.option("header", "true").csv(str(d / "root" / "report" / "rows")).collect()
    assert [(r["rank"], r["source_domain"], r["action"]) for r in sorted(rows, key=lambda r: r["rank"])] == [
        ("1", "chart-notes.com", "Pitch, politely"), ("2", "row-digest.io", "Submit")]
