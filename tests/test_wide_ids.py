"""Parts whose keys are longer than the six digits of their units' ids."""

import json
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from gridloom import queries, sinks, sources

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def wide(tmp_path_factory):
    """Tables with a second copy of the parts, whose keys are ten times as large plus a million: cut to six digits some are those of others."""
    d = tmp_path_factory.mktemp("wide")
    duckdb.sql(f"COPY (SELECT * FROM '{DATA}/nation.parquet') TO '{d}/nation.parquet'")
    duckdb.sql(f"COPY (SELECT * REPLACE (p_partkey + 100000 + k * (900000 + p_partkey * 9) AS p_partkey, p_name || k AS p_name, (p_size + k * 3) % 50 + 1 AS p_size, 'Brand#' || (p_partkey + k) % 25 AS p_brand) FROM '{DATA}/part.parquet', range(2) r(k)) TO '{d}/part.parquet'")
    duckdb.sql(f"COPY (SELECT * REPLACE (l_partkey + 100000 + k * (900000 + l_partkey * 9) AS l_partkey) FROM '{DATA}/lineitem.parquet', range(2) r(k)) TO '{d}/lineitem.parquet'")
    return str(d)


def rows_of(wide, name):
    con = duckdb.connect()
    for t in ("part", "lineitem", "nation"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{wide}/{t}.parquet'")
    found = con.sql(queries.ORACLES[name])
    return found.columns, found.fetchall()


@pytest.mark.parametrize("name", ["names_build", "lookup_rows", "areas_rollup", "check_b2"])
def test_rows_of_parts_that_share_an_id(spark, wide, name):
    columns, rows = rows_of(wide, name)
    got = queries.QUERIES[name](spark, wide).select(*columns).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, rows))


@pytest.mark.parametrize("name, entry", [("names_json", r'"\d{6}":"[^"]*"'), ("areas_json", r'"\d{6}":\{[^}]*\}')])
def test_documents_of_parts_that_share_an_id(spark, wide, name, entry):
    """The SQL leaves the order of entries with the same id open, so the entries are compared."""
    ((place, text),) = rows_of(wide, name)[1]
    ((got_place, got),) = queries.QUERIES[name](spark, wide).select("geography", "json").collect()
    entries = re.findall(entry, got)
    assert place == got_place and "{" + ",".join(entries) + "}" == got
    assert sorted(entries) == sorted(re.findall(entry, text)) == entries
    assert len({e[:8] for e in entries}) < len(entries)


def test_names_of_one_id_are_in_order_of_the_parts_keys(spark, tmp_path):
    """The whole text of the SQL on one thread, which takes the parts as the table has them; names are such that their texts are in another order."""
    duckdb.sql(f"COPY (SELECT * FROM '{DATA}/nation.parquet') TO '{tmp_path}/nation.parquet'")
    duckdb.sql(f"COPY (SELECT * REPLACE (p_partkey * power(10, k)::bigint + 100000 * power(10, k)::bigint AS p_partkey, 'n' || (p_partkey + k * 7) % 5 || p_name AS p_name) FROM range(3) r(k), '{DATA}/part.parquet' ORDER BY k, p_partkey) TO '{tmp_path}/part.parquet'")
    duckdb.sql(f"COPY (SELECT DISTINCT 41.0 AS l_quantity, p_partkey AS l_partkey, 1 AS l_orderkey, 1 AS l_linenumber, 'A' AS l_returnflag, 'F' AS l_linestatus, TIMESTAMP '1997-01-01' AS l_shipdate FROM '{tmp_path}/part.parquet') TO '{tmp_path}/lineitem.parquet'")
    con = duckdb.connect(config={"threads": 1})
    for t in ("part", "lineitem", "nation"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet'")
    ((_, want),) = con.sql(queries.ORACLES["names_json"]).fetchall()
    ((_, got),) = queries.QUERIES["names_json"](spark, str(tmp_path)).select("geography", "json").collect()
    entries = re.findall(r'"\d{6}":"[^"]*"', got)
    assert got == want
    assert len(entries) == 600 and sorted(entries) != entries


@pytest.mark.parametrize("name", ["lookup_rows", "names_build", "names_json"])
def test_parts_without_a_name_or_type(spark, tmp_path, name):
    """They have no name, not that of a state or type alone; the document leaves them out."""
    for t in ("nation", "lineitem"):
        duckdb.sql(f"COPY (SELECT * FROM '{DATA}/{t}.parquet') TO '{tmp_path}/{t}.parquet'")
    duckdb.sql(f"COPY (SELECT * REPLACE (CASE WHEN p_partkey % 7 > 0 THEN p_name END AS p_name, CASE WHEN p_partkey % 5 > 0 THEN p_type END AS p_type) FROM '{DATA}/part.parquet') TO '{tmp_path}/part.parquet'")
    columns, rows = rows_of(tmp_path, name)
    got = queries.QUERIES[name](spark, str(tmp_path)).select(*columns).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, rows))


def test_parts_without_a_size(spark, tmp_path):
    """They have no area, and the document leaves them out."""
    for t in ("nation", "lineitem"):
        duckdb.sql(f"COPY (SELECT * FROM '{DATA}/{t}.parquet') TO '{tmp_path}/{t}.parquet'")
    duckdb.sql(f"COPY (SELECT * REPLACE (CASE WHEN p_partkey % 7 > 0 THEN p_size END AS p_size) FROM '{DATA}/part.parquet') TO '{tmp_path}/part.parquet'")
    columns, rows = rows_of(tmp_path, "areas_json")
    assert [tuple(r) for r in queries.QUERIES["areas_json"](spark, str(tmp_path)).select(*columns).collect()] == rows


def test_lookup_documents_are_those_of_a_map(spark):
    """Keys of any length and values that need escapes, against one map; and back."""
    ids = [("a", g, v) for g, v in (("1", 'x"y'), ("10", "ü\n"), ("1000", ""), ("10001", "c\\d"), ("10000", "e"), ("2", "f"))] + [("b", "US", "g")]
    df = spark.createDataFrame(ids, "geography string, geo_id string, name string")
    entries = F.array_sort(F.collect_list(F.struct("geo_id", "name")))
    want = {tuple(r) for r in df.groupBy("geography").agg(F.to_json(F.map_from_entries(entries))).collect()}
    found = sinks.lookup_json(df, "name")
    assert {tuple(r) for r in found.select("geography", "json").collect()} == want
    assert {tuple(r) for r in sources.lookup_rows(found).collect()} == set(ids)
    assert all(json.loads(r.json) for r in found.collect())
