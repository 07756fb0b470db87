"""The driver contract of __spark_entry__.py."""

import re

import __spark_entry__ as E


def test_contract_shape():
    qs, sql = E.queries(), E.oracle_sql()
    assert callable(E.entry) and len(qs) >= 40
    assert set(sql) <= set(qs)
    added = {k for k in qs if re.match(r"^op\d+_", k) or k == "pipeline"}
    assert set(qs) - set(sql) <= added  # every query of the engine itself has its SQL
    assert not added or {int(re.match(r"op(\d+)_", k)[1]) for k in added - {"pipeline"}} == set(range(1, 14))
    assert all(s.strip().upper().startswith(("WITH", "SELECT")) for s in sql.values())
