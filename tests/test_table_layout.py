"""Tables stored as folders of many files give the same results as single files."""

import pytest
from oracle_check import compare, duck

from __spark_entry__ import oracle_sql, queries
from weirflow.sources.tables import read_table


@pytest.fixture(scope="module")
def folders(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("tables"))
    for name in ("region", "nation", "customer", "part", "orders", "lineitem", "events"):
        table = read_table(spark, "/root/testdata/sf0.001", name)
        table.repartition(3 if table.count() > 100 else 1).write.parquet(f"{root}/{name}.parquet")
    return root


@pytest.mark.parametrize(
    "name",
    [
        "session_product_mix",
        "late_event_audit",
        "stream_tumbling_append",
        "stream_session_append",
        "stream_topn_snapshot",
        "stream_session_product_mix",
    ],
)
def test_folder_tables(spark, folders, name):
    con = duck("/root/testdata/sf0.001")
    assert compare(queries()[name](spark, folders), con, oracle_sql()[name]) is None
