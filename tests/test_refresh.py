"""The refresh job: what it publishes, that it publishes all or nothing, and that it skips what is current."""

import json
import time

import pytest
from pyspark.sql import functions as F

from gridloom import store
from gridloom.operators import rings
from gridloom.plans import refresh as job

ROWS = "grid_lon string, grid_lat string, race_ethnicity string, age_group string, sex string, n_noise double, n_noise_postprocessed double"


def source(spark, folder, dataset, year, factor=1.0):
    rows = [(f"{k % 4}.005", f"{k // 4}.005", "White" if k % 3 else "Black", "Under 18", "F", factor * k, factor * max(k - 2, 0)) for k in range(12)]
    df = spark.createDataFrame(rows, ROWS)
    if dataset == "raceincome":
        df = df.drop("age_group", "sex").withColumn("income_decile", F.lit(3.0))
    df.coalesce(1).write.mode("overwrite").parquet(f"{folder}/{dataset}/{year}")


@pytest.fixture
def inputs(spark, tmp_path):
    for d in ("ageracesex", "raceincome"):
        for y in (2001, 2002):
            source(spark, f"{tmp_path}/in", d, y)
    cells = [(f"{i}.005", f"{j}.005", f"0{1 + i // 2}00{1 + j // 2}", False) for i in range(4) for j in range(3)]
    county = spark.createDataFrame(cells, "grid_lon string, grid_lat string, geo_id string, snapped boolean")
    state = county.withColumn("geo_id", F.substring("geo_id", 1, 2))
    plan = spark.createDataFrame([(d, g, y, y == 2002) for d in ("ageracesex", "raceincome") for g in ("county", "state") for y in (2001, 2002)], "dataset string, geography string, year int, preliminary boolean")
    units = spark.createDataFrame([("county", f"0{i}00{j}", f"C{i}{j}", None, 5 * i, j) for i in (1, 2) for j in (1, 2)] + [("state", f"0{i}", f"S{i}", None, 9, 1) for i in (1, 2)] + [("county", "09009", "no data", None, None, 0)], "geography string, geo_id string, name string, namelsad string, aland_m2 long, awater_m2 long")
    states = spark.createDataFrame([("01", "AA"), ("02", "BB")], "geo_id string, stusps string")
    square = [(f"0{i}", 0, 0, k, float(x + 2 * (i - 1)), float(y)) for i in (1, 2) for k, (x, y) in enumerate(((0, 0), (2, 0), (2, 3), (0, 3)))] + [("72", 0, 0, k, float(x), float(y)) for k, (x, y) in enumerate(((9, 9), (10, 9), (9, 10)))]
    edges = rings.directed_edges(spark.createDataFrame(square, "geo_id string, part int, ring int, seq int, x double, y double"))
    dims = {"ageracesex": ("race_ethnicity", "age_group", "sex"), "raceincome": ("race_ethnicity", "income_decile")}
    return job.Inputs(f"{tmp_path}/in", dims, plan, {"state": state, "county": county}, units, states, {"state": edges, "zcta": edges})


def totals(spark, root, year=2001):
    s = store.current(spark, root)
    return {(r.dataset, r.geography): r.v for d in ("ageracesex", "raceincome") for r in store.read(spark, s, "data", d).where(F.col("year") == year).groupBy("dataset", "geography").agg(F.sum("n_noise").alias("v")).collect()}


def test_refresh_publishes_all_or_nothing_and_skips(spark, tmp_path, inputs):
    root = f"{tmp_path}/out"
    done = job.refresh(spark, root, inputs)
    assert done.log == ["zcta has no map"]
    s = store.current(spark, root)
    assert totals(spark, root) == {(d, g): 66.0 for d in inputs.dims for g in ("county", "state")}
    ledger = {(r.dataset, r.geography, r.year): r for r in store.read(spark, s, "ledger").collect()}
    assert len(ledger) == 8 and all(r.bytes > 0 and len(r.sha256) == 64 and r.rows > 0 and f"{root}/{r.path}" in s.live["data"] for r in ledger.values())
    combined = store.read(spark, s, "combined", "ageracesex").groupBy("geography", "year").agg(F.sum("n_noise").alias("v")).collect()
    assert sorted((r.geography, r.year, r.v) for r in combined) == [(g, y, 66.0) for g in ("county", "state") for y in (2001, 2002)]
    names = {r.geography: json.loads(r.value) for r in store.read_text(spark, s, "names").collect()}
    assert names["county"]["01001"] == "C11, AA" and names["state"] == {"01": "S1", "02": "S2"} and "09009" not in names["county"]
    assert {r.geography: json.loads(r.value) for r in store.read_text(spark, s, "areas").collect()}["state"]["01"] == {"aland_m2": 9, "awater_m2": 1}
    shapes = [json.loads(r.value) for r in store.read_text(spark, s, "boundaries").collect()]
    assert sorted(f["properties"]["geo_id"] for f in shapes) == ["01", "02"]
    entries = [json.loads(r.value) for r in store.read_text(spark, s, "catalog").collect()]
    assert sorted(len(e) for e in entries) == [4, 4] and all({"path", "bytes", "sha256"} <= e.keys() for es in entries for e in es)

    assert job.refresh(spark, root, inputs) is None and store.current(spark, root).number == 1  # nothing is due

    # one source year changes: its partitions are built anew, the others stay where they are
    time.sleep(1.1)
    source(spark, inputs.source, "ageracesex", 2001, 2.0)
    for broken in ("record", "boundaries", "catalog"):  # killed after that stage

        def stop(_, name=broken):
            raise RuntimeError(f"killed after {name}")

        cut = [(n, f) for k, (n, f) in enumerate(job.STAGES)][: [n for n, _ in job.STAGES].index(broken) + 1]
        with pytest.raises(RuntimeError):
            job.refresh(spark, root, inputs, (*cut, ("stop", stop)))
        assert store.current(spark, root).live == s.live and totals(spark, root)["ageracesex", "county"] == 66.0
    again = job.refresh(spark, root, inputs)
    assert {(r.dataset, r.geography, r.year, r.reason) for r in again.due.collect()} == {("ageracesex", g, 2001, "source") for g in ("county", "state")}
    now = store.current(spark, root)
    assert totals(spark, root) == {("ageracesex", "county"): 132.0, ("ageracesex", "state"): 132.0, ("raceincome", "county"): 66.0, ("raceincome", "state"): 66.0}
    assert len(set(now.live["data"]) & set(s.live["data"])) == 6 and now.number == 2
    assert {r.year: r.v for r in store.read(spark, now, "combined", "ageracesex").where("geography = 'state'").groupBy("year").agg(F.sum("n_noise").alias("v")).collect()} == {2001: 132.0, 2002: 66.0}

    # a crosswalk changes: its level only; a version changes: all
    inputs.crosswalks["county"] = inputs.crosswalks["county"].withColumn("geo_id", F.concat(F.substring("geo_id", 1, 4), F.lit("9")))
    third = job.refresh(spark, root, inputs)
    assert {(r.geography, r.reason) for r in third.due.collect()} == {("county", "crosswalk")} and third.due.count() == 4
    inputs.version = "2"
    assert {r.reason for r in job.refresh(spark, root, inputs).due.collect()} == {"version"}
    assert store.vacuum(spark, root) and totals(spark, root)["ageracesex", "county"] == 132.0


def test_refresh_refuses_bad_sources_and_units(spark, tmp_path, inputs):
    root = f"{tmp_path}/out"
    inputs.rows = (1, 11)
    with pytest.raises(ValueError, match="12 rows"):
        job.refresh(spark, root, inputs)
    inputs.rows = (12, 12)
    spark.range(3).select(F.col("id").cast("string").alias("grid_lon")).write.mode("overwrite").parquet(f"{inputs.source}/raceincome/2002")
    with pytest.raises(ValueError, match="2002"):
        job.refresh(spark, root, inputs)
    source(spark, inputs.source, "raceincome", 2002)
    inputs.units = inputs.units.withColumn("aland_m2", F.when(F.col("geo_id") != "01001", F.col("aland_m2")))
    with pytest.raises(ValueError, match="no land area"):
        job.refresh(spark, root, inputs)
    assert store.current(spark, root) is None


def test_commit_takes_each_number_once(spark, tmp_path):
    root = str(tmp_path)
    a, b = store.begin(spark, root), store.begin(spark, root)
    store.commit(spark, a)
    with pytest.raises(Exception, match="exist"):
        store.commit(spark, b)
    (tmp_path / "commits" / "00000002.json").write_text('{"name": "cut o')
    assert store.current(spark, root).name == a.name and store.begin(spark, root).number == 3
