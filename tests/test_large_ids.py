"""Names of frames whose numbers have more digits than the given tables' have."""

import duckdb
import pytest

from frameloom import catalogue


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    """The events and customers of sf0.001, with every second event's id beyond a million."""
    root, data = tmp_path_factory.mktemp("ids"), "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"COPY (SELECT * REPLACE (CASE WHEN event_id % 2 = 0 THEN event_id + 12345670 ELSE event_id END AS event_id) FROM '{data}/events.parquet') TO '{root}/events.parquet'")
    for name in ("customer", "lineitem"):
        con.execute(f"COPY (SELECT * FROM '{data}/{name}.parquet') TO '{root}/{name}.parquet'")
    return str(root)


@pytest.mark.parametrize("name", ["append_history", "apply_frame_updates", "object_name", "glob_filter", "lv1_name", "true_stem"])
def test_names_of_large_ids_equal_sql(spark, folder, name):
    con = duckdb.connect()
    for table in ("events", "customer", "lineitem"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    got = catalogue.QUERIES[name](spark, folder)
    columns = [c for c in got.columns if c not in ("zp", "zp_err", "n")]
    want = con.execute(f"SELECT {', '.join(columns)} FROM ({catalogue.SQL[name]})").fetchall()
    assert sorted(want) == sorted(tuple(r) for r in got.select(*columns).collect()) and len(want) > 500
