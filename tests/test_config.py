import pytest

from linkgap.config import (REFERENCE_RELEASES, REFERENCE_TARGETS, ScoreParams, releases_df,
                            select_releases)


def test_targets_and_releases(spark):
    assert len(REFERENCE_TARGETS.all) == 5
    assert REFERENCE_TARGETS.flag_columns == ["links_sigma", "links_hex", "links_mode", "links_lightdash", "links_own"]
    assert [r.label for r in REFERENCE_RELEASES] == ["2026-05", "2026-06"]
    df = releases_df(spark)
    assert df.count() == 2 and df.schema["crawls"].dataType.simpleString() == "array<string>"
    t = REFERENCE_TARGETS.to_df(spark).collect()
    assert {r["rev_domain"] for r in t} >= {"co.omni", "com.sigmacomputing"}


def test_select_releases():
    assert len(select_releases(REFERENCE_RELEASES)) == 2
    one = select_releases(REFERENCE_RELEASES, REFERENCE_RELEASES[0].id)
    assert [r.id for r in one] == [REFERENCE_RELEASES[0].id]
    with pytest.raises(ValueError) as e:
        select_releases(REFERENCE_RELEASES, "nonexistent")
    assert all(r.id in str(e.value) for r in REFERENCE_RELEASES)


def test_default_params():
    p = ScoreParams()
    assert (p.w_gap, p.w_auth, p.w_pers, p.min_competitors) == (0.5, 0.3, 0.2, 2)
