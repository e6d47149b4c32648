"""Every registered query against its SQL in DuckDB."""

import math
import os

import duckdb
import pytest

from mapforge import bridge, imports, shapes

QUERIES, ORACLES = bridge.QUERIES | shapes.QUERIES | imports.QUERIES, bridge.ORACLES | shapes.ORACLES | imports.ORACLES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in ("customer", "orders", "supplier", "part", "lineitem", "nation"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6) + 0.0
    return v


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    got = df.collect()
    rel = duck.sql(ORACLES[name])
    assert sorted(df.columns) == sorted(rel.columns)
    cols = sorted(df.columns)
    key = lambda r: tuple((x is None, str(x)) for x in r)
    a = sorted((tuple(plain(r[c]) for c in cols) for r in got), key=key)
    b = sorted((tuple(plain(x[rel.columns.index(c)]) for c in cols) for x in rel.fetchall()), key=key)
    assert len(a) == len(b) and len(a) > 0
    assert a == b


def test_footways_are_chosen_by_tag(spark, monkeypatch):
    """With footways at other numbers the query follows the tag."""
    assert "WHEN 3 THEN 'footway' WHEN 4 THEN 'residential'" in bridge.WAYS
    monkeypatch.setattr(bridge, "WAYS", bridge.WAYS.replace("WHEN 3 THEN 'footway' WHEN 4 THEN 'residential'", "WHEN 3 THEN 'residential' WHEN 4 THEN 'footway'"))
    got = QUERIES["footway_two_tables"](spark, SF).where("tbl = 'minorroads'").collect()
    assert got and {r["osm_id"] % 10 for r in got} == {4} and {r["v"] for r in got} == {"footway"}


def test_generalized_where_is_asked_of_the_area_itself(spark, tmp_path):
    """Rings whose area is a bit above 5000 (the sum's last digits), found at 60 times sf0.1 with shifted keys: rounded first, they would go."""
    parts = {3: [4904637, 4909873, 4915060, 4919260, 4902866], 6: [2608297, 2617932, 2609756, 2605066, 2613059], 9: [1, 2, 3]}
    lines = [(o, i, p) for o, ps in parts.items() for i, p in enumerate(ps)]
    spark.createDataFrame(lines, "l_orderkey long, l_linenumber long, l_partkey long").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(p,) for _, _, p in lines], "p_partkey long").write.parquet(f"{tmp_path}/part.parquet")
    c = duckdb.connect()
    for t in ("lineitem", "part"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tmp_path}/{t}.parquet/*.parquet')")
    want = c.sql(ORACLES["generalized_where"]).fetchall()
    assert sorted(map(tuple, QUERIES["generalized_where"](spark, str(tmp_path)).collect())) == sorted(want) == [(3, 5000.0), (6, 5000.0)]
