"""Queries over the published tables read what they need: pruned folders, pushed filters, few row groups; and checks of files find damage."""

import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom import queries, sources, store
from gridloom.operators import checks, query

DATA = "/root/testdata/sf0.01"


scans = sources.scan_metrics


def test_year_is_a_partition_filter(spark):
    path = f"{queries._published(spark, DATA)}/data"
    whole, years = spark.read.parquet(path).count(), spark.read.parquet(path).select("year").distinct().count()
    [(text, rows, _)] = scans(queries.facet_query(spark, DATA))
    assert re.search(r"PartitionFilters: \[.*dataset.*geography.*year.*1996", text) and re.search(r"PushedFilters: \[.*race_ethnicity", text)
    assert "ReadSchema: struct<geo_id:string,race_ethnicity:string,sex:string,n_noise_postprocessed:double>" in text
    assert 0 < rows <= 1.5 * whole / years


def test_a_place_reads_few_row_groups(spark, tmp_path):
    """In partitions and combined tables sorted by unit, one unit's series touches a small part of the rows."""
    df = spark.range(60_000).select(F.lit("d").alias("dataset"), F.lit("county").alias("geography"), (F.col("id") % 3 + 2000).cast("int").alias("year"), F.lpad((F.col("id") % 400).cast("string"), 5, "0").alias("geo_id"), (F.col("id") % 7).cast("string").alias("sex"), F.lit(1.0).alias("n_noise"), F.lit(1.0).alias("n_noise_postprocessed"))
    sorted_ = lambda d, path, order, partitions: store.write_sorted(d, path, order, partitions, row_group=500)
    sorted_(df, f"{tmp_path}/data", ["geo_id", "sex"], store.PARTITION)
    sorted_(df, f"{tmp_path}/combined", ["geo_id", "year", "sex"], store.PARTITION[:2])
    one = query.query(store.scan(spark, f"{tmp_path}/data", "d", "county", 2001), "n_noise", ["sex"], place="00123")
    [(text, rows, files)] = scans(one)
    assert "EqualTo(geo_id,00123)" in text and 0 < rows <= 20_000 / 10 and files >= 1
    series = query.query(store.scan(spark, f"{tmp_path}/combined", "d", "county"), "n_noise", ["year"], place="00123")
    [(text, rows, _)] = scans(series)
    assert "EqualTo(geo_id,00123)" in text and 0 < rows <= 60_000 / 20
    assert sum(r.value for r in series.collect()) == 150


def test_series_reads_the_combined_table(spark):
    [(text, _, files)] = scans(queries.time_series(spark, DATA))
    assert "/combined" in text and "PushedFilters: [IsNotNull(geo_id), EqualTo(geo_id,02001)]" in text and "struct<geo_id:string,n_noise:double,year:int>" in text


def test_default_year_prunes_while_it_runs(spark):
    path = f"{queries._published(spark, DATA)}/data"
    whole, years = spark.read.parquet(path).count(), spark.read.parquet(path).select("year").distinct().count()
    found = [x for x in scans(queries.newest_year(spark, DATA)) if "n_noise_postprocessed" in x[0]]
    assert len(found) == 1 and "dynamicpruning" in found[0][0] and 0 < found[0][1] <= 2 * whole / years


def test_search_reads_one_gram(spark):
    found = queries.place_search(spark, DATA)
    path = f"{queries._once(spark, DATA, 'search', None)}"
    df = query.place_search(spark, path, "#00000001")
    postings = [x for x in scans(df) if "/postings" in x[0]]
    assert len(postings) == 1 and re.search(r"PushedFilters: \[In\(gram, \[001,\^#0\]\)\]", postings[0][0])
    assert postings[0][1] < spark.read.parquet(f"{path}/postings").count() / 4
    assert found.where("kind = 'dataset'").count() == 2


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_ranks_by_refinement(spark, adaptive):
    rng = np.random.default_rng(4)
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    try:
        for v in (rng.normal(size=5000), np.repeat([1.0, 2.0, 3.0], [4000, 1, 999]), np.concatenate([rng.normal(size=3000) * 1e-12, [1e308, -1e308, 0.0, -0.0]]), np.array([7.0])):
            df = spark.createDataFrame([(float(x),) for x in v], "value double").repartition(7)
            places = sorted({0, len(v) // 3, len(v) // 2, len(v) - 1})
            assert query.at_ranks(df, places) == np.sort(v)[places].tolist()
            assert query.at_ranks(df, places, bins=3) == np.sort(v)[places].tolist()
        assert query.quantile_breaks(df.limit(0)).count() == 0
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_damaged_files_are_found(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(40_000).withColumn("part", F.col("id") % 4).repartition(4, "part").write.partitionBy("part").parquet(path)
    recorded = [tuple(r) for r in sources.file_checksums(spark, path).collect()]
    for p, n, digest in recorded:
        raw = open(p.removeprefix("file:"), "rb").read()
        assert (n, digest) == (len(raw), hashlib.sha256(raw).hexdigest())
    assert sorted(recorded) == sorted(map(tuple, sources.file_checksums(spark, path, whole=1000).collect()))  # in pieces, by Arrow
    catalog = spark.createDataFrame(recorded, "path string, bytes long, sha256 string")
    by = F.regexp_extract("path", "/part=([0-9])/", 1)
    state = lambda df: {r.subject: r.status for r in df.collect()}
    sizes, sums = (lambda: state(checks.catalog_sizes(catalog, sources.file_manifest(spark, path), by))), (lambda: state(checks.catalog_checksums(catalog, sources.file_checksums(spark, path), by)))
    assert set(sizes().values()) == set(sums().values()) == {"pass"}
    at = {p.split("/part=")[1][0]: p.removeprefix("file:") for p, n, _ in sorted(recorded, key=lambda r: r[1])}  # one file of each part, the longest
    raw = bytearray(open(at["1"], "rb").read())
    raw[len(raw) // 2] ^= 1
    open(at["1"], "wb").write(raw)  # one flipped byte
    short = open(at["2"], "rb").read()
    open(at["2"], "wb").write(short[:-10])
    import os

    os.remove(at["3"])
    assert sizes() == {"0": "pass", "1": "pass", "2": "fail", "3": "fail"}
    assert sums() == {"0": "pass", "1": "fail", "2": "fail", "3": "fail"}


def test_drifted_source_fails_its_contract(spark, tmp_path):
    whole = spark.range(5).select(F.col("id").cast("string").alias("a"), F.lit(1.0).alias("b"))
    whole.write.parquet(f"{tmp_path}/x")
    whole.withColumn("b", F.lit(1)).write.parquet(f"{tmp_path}/y")
    whole.withColumn("c", F.lit(1)).limit(2).write.parquet(f"{tmp_path}/z")
    paths = [f"{tmp_path}/{n}" for n in "xyz"]
    columns = sources.schema_by_path(spark, paths, whole.schema).withColumn("subject", F.substring_index("path", "/", -1))
    counts = spark.createDataFrame([("x", 5), ("y", 5), ("z", 2)], "subject string, rows long")
    assert {r.subject: r.status for r in checks.source_contract(columns, counts, 1, 9).collect()} == {"x": "pass", "y": "fail", "z": "warn"}
    assert {r.subject: r.status for r in checks.source_contract(columns, counts, 3, 9).collect()} == {"x": "pass", "y": "fail", "z": "fail"}


def test_pruned_rows_are_held_against_all_rows(spark):
    """What the pruned scan finds stands beside a count of every row that was written."""
    row = queries.rowgroup_prune(spark, DATA).first().asDict()
    whole = queries.write_partition(spark, DATA).where("geo_id = '01003'").count()
    assert row == {"rows": whole, "found": whole, "fewer": True}


@pytest.mark.parametrize("segment", [25_000, 7])
def test_search_index_in_segments(spark, tmp_path, segment):
    """Texts at the beginning, inside and at the end of names, of two characters and more, repeated in a name, with letters that lower case makes longer; a posting for each place in a name."""
    names = [(k % 3, f"U{k}", n) for k, n in enumerate(["Anna", "banana", "an", "n", "", None, "Hanover Bay", "bay an", "\u0130stan", "line\nan"] * 5)]
    query.write_search_index(spark.createDataFrame(names, "level_rank int, geo_id string, name string"), str(tmp_path), segment)
    postings = spark.read.parquet(f"{tmp_path}/postings")
    assert postings.where("not startswith(gram, '^')").count() == sum(max(0, len(n.lower()) - 1) for _, _, n in names if n)
    assert segment > 7 or len(postings.inputFiles()) > 4
    for text in ("an", "AN ", "ana", "anan", "bay an", "u1", "u12", "na", "stan", "ne\nan", "zz", "y", "\u0130s"):
        t = text.strip().lower()
        want = sorted((r, n, g) for r, g, n in set(names) if len(t) > 1 and (n and t in n.lower() or g.lower().startswith(t)) and n is not None)
        got = query.place_search(spark, str(tmp_path), text, most=100, in_all=100).collect()
        assert [(r.level_rank, r.name, r.geo_id) for r in got if r.name is not None] == want, text
