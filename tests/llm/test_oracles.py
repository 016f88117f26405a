"""Every training-data query that has SQL against it, on sf0.01."""

import pytest

from helpers import digest
SF01 = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", ["op2_license_scan", "op4_jaccard_join", "op7_chat_format", "op8_quality_rules", "op12_url_filter",
                                  "op13_periodic_runs"])
def test_query_equals_sql(spark, duck, name):
    from ledgerline.llm.queries import ORACLE_SQL, QUERIES

    df = QUERIES[name](spark, SF01)
    rel = duck.execute(ORACLE_SQL[name])
    cols = [d[0] for d in rel.description]
    assert sorted(cols) == sorted(df.columns)
    assert digest([tuple(r) for r in df.collect()], df.columns) == digest(rel.fetchall(), cols)


def test_all_are_registered():
    from ledgerline.llm.queries import QUERIES

    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14))
