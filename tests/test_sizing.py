"""The tasks of a shuffle follow the rows, whatever the deployment's number of them."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pluvio.operators import sizing
from pluvio.operators.numbering import number_in_groups
from pluvio import fixtures as fx
from pluvio.operators.observations import observed_span, pivot_daily
from pluvio.plans import jobs, registry
from pluvio.schemas import PAGE_ENVELOPE
from pluvio.sinks import compaction, landing, tables
from pluvio.sources import observations as src
from pluvio.staging import scratch

from conftest import SF_SMALL


@pytest.fixture()
def few(spark, monkeypatch):
    """Two shuffle partitions, and tasks of at most twenty rows."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    monkeypatch.setattr(sizing, "ROWS_PER_TASK", 20)
    yield spark
    spark.conf.set("spark.sql.shuffle.partitions", before)


def _observations(spark, rows):
    day = F.date_add(F.lit("2000-01-01").cast("date"), (F.col("id") % 5).cast("int"))
    return spark.range(rows).select(
        F.concat(F.lit("GHCND:S"), F.lpad(F.col("id").cast("string"), 6, "0")).alias("station"),
        F.date_format(day, "yyyy-MM-dd'T'HH:mm:ss").alias("date"),
        F.when(F.floor(F.col("id") / 5) % 2 == 0, "TMAX").otherwise("PRCP").alias("datatype"),
        F.lit("x").alias("attributes"), F.col("id").cast("double").alias("value"))


def test_landing_gets_tasks_by_its_rows(few, tmp_root):  # H1
    observations = _observations(few, 200)
    assert landing.land_observations(observations, tmp_root + "/raw") == {"landed": 200, "rejected": 0}
    landed = few.read.json(tmp_root + "/raw")
    assert landed.select(F.regexp_extract(F.input_file_name(), r"part-(\d+)-", 1)).distinct().count() > 2
    assert landed.agg(F.sum("value")).first()[0] == sum(range(200))
    assert sizing.tasks_for(few, 40) is None and sizing.tasks_for(few, 41) == 3


def test_rows_of_a_large_group_are_numbered_in_many_tasks(few):  # A2, A3
    rows = few.range(205).select(F.when(F.col("id") < 200, "large").when(F.col("id") < 203, "small").alias("k"),
                                 (F.col("id") * 37 % 205).alias("v"))
    with scratch(few) as paths:
        numbered = number_in_groups(rows, ["k"], ["v"], 205)
        tasks = few.read.parquet(paths[-1]).where("k = 'large'").select(F.shiftright("_at", 33)).distinct().count()
        got = [tuple(r) for r in numbered.orderBy("k", "nth").collect()]
    want = []
    for k in (None, "large", "small"):
        values = sorted(r.v for r in rows.where(F.col("k").eqNullSafe(k)).collect())
        want += [(k, v, i + 1, len(values)) for i, v in enumerate(values)]
    assert got == want and tasks > 2


def test_landed_pages_are_filled_in_order(few, monkeypatch):  # A2, A3
    root = registry._land_pages(few, SF_SMALL, "pages-order", page_rows=7)
    got = {(r.datatype, r.request, r.metadata.resultset.offset): r for r in few.read.schema(
        T.StructType([*PAGE_ENVELOPE.fields, T.StructField("datatype", T.StringType()),
                      T.StructField("request", T.StringType())])).json(root).where("request = 'm199705'").collect()}
    obs = fx.fx_raw_observations(few, SF_SMALL).where("date like '1997-05%'").collect()
    for datatype in ("TMAX", "TMIN", "TAVG", "PRCP"):
        rows = sorted((r.station, r.date, r.value) for r in obs if r.datatype == datatype)
        for at in range(0, len(rows), 7):
            page = got.pop((datatype, "m199705", at + 1))
            assert [(r.station, r.date, r.value) for r in page.results] == rows[at:at + 7]
            assert (page.metadata.resultset["count"], page.metadata.resultset.limit) == (len(rows), 7)
    assert not got


def test_compaction_writes_months_by_their_rows_and_stages_them_once(few, tmp_root, monkeypatch):  # H1
    raw, compact = tmp_root + "/raw", tmp_root + "/compact"
    landing.land_observations(_observations(few, 200), raw)
    staged, stage = [], compaction.stage
    monkeypatch.setattr(compaction, "stage", lambda df, spark, label: staged.append(label) or stage(df, spark, label))
    sizes = []
    monkeypatch.setattr(compaction, "spread", lambda df, rows, *keys: sizes.append(rows) or sizing.spread(df, rows, *keys))
    assert compaction.compact_months(few, raw, compact, "2000-01-01", "2000-01-31") == {"months": 2, "rows": 200}
    assert staged == ["compact-days", "compact-kept"] and sizes == [200]  # no second copy of the rows
    # a day is landed again: the other days of its month stay, and are counted
    landing.land_observations(_observations(few, 200).where("datatype = 'TMAX' and date like '2000-01-02%' and value < 50"), raw)
    assert compaction.compact_months(few, raw, compact, "2000-01-01", "2000-01-31") == {"months": 1, "rows": 85}
    got = compaction.scan_landed(few, raw, compact).groupBy("datatype").count().collect()
    assert sorted(map(tuple, got)) == [("PRCP", 100), ("TMAX", 85)]


def test_a_pivot_gets_tasks_by_its_rows(few):  # C1, E1
    observations = _observations(few, 200)
    wide = pivot_daily(observations, 200)
    plan = wide._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and wide.select(F.spark_partition_id()).distinct().count() > 2
    assert sorted(map(tuple, wide.collect())) == sorted(map(tuple, pivot_daily(observations).collect()))


def test_a_first_load_is_staged_once_and_a_later_one_merged(few, tmp_root, monkeypatch):  # H4
    path, staged, stage = tmp_root + "/results", [], tables.stage
    tables.ensure_table(few, path, "transformed_results")
    monkeypatch.setattr(tables, "stage", lambda df, spark, label: staged.append(label) or stage(df, spark, label))
    first = pivot_daily(_observations(few, 200), 200)
    assert tables.upsert_observations(first, path) == {"written": True, "rows": 200}
    assert staged == ["transformed_results-batch"]
    assert len(few.read.parquet(path).inputFiles()) > 2  # one month, in the tasks that its rows need
    assert tables.upsert_observations(first.limit(3).withColumn("tmax", F.lit(-1.0)), path)["rows"] == 3
    got = tables.read_table(few, path, "transformed_results")
    assert staged[1:] == ["transformed_results-batch", "transformed_results-next"]
    assert (got.count(), got.where("tmax = -1").count()) == (200, 3)


def test_touched_months_are_derived_once(few, tmp_root):  # J3
    layout = jobs.Layout(tmp_root)
    tables.ensure_table(few, layout.results, "transformed_results")
    daily = pivot_daily(_observations(few, 20), 20)
    tables.upsert_observations(daily, layout.results)
    jobs.refresh_cube(few, layout)
    read = few.sparkContext.accumulator(0)
    seen = F.udf(lambda d: read.add(1) or d, "date")
    months = daily.select(seen("date").alias("d")).select(F.year("d").alias("year"), F.month("d").alias("month"))
    counted = daily.count()
    assert jobs.refresh_cube(few, layout, months) == 20
    assert read.value <= 2 * counted  # a year and a month of each row, once


def test_folder_names_are_made_after_the_sampled_sort(few, tmp_root, monkeypatch):  # H1
    sorted_by = []

    def seen(df, rows, *keys):
        sorted_by.append((sorted(df.columns), keys))
        return sizing.spread(df, rows, *keys)

    monkeypatch.setattr(landing, "spread", seen)
    undated = few.createDataFrame([("GHCND:S000001", "soon", "TMAX", "x", 1.0), ("GHCND:S000001", None, "TMAX", "x", 1.0)],
                                  "station string, date string, datatype string, attributes string, value double")
    assert landing.land_observations(_observations(few, 200).unionByName(undated), tmp_root + "/raw") == {
        "landed": 200, "rejected": 2}
    assert sorted_by == [(["_day", "attributes", "datatype", "date", "station", "value"], ("datatype", "_day", "station"))]
    got = few.read.json(tmp_root + "/raw")
    assert sorted(got.columns) == ["attributes", "datatype", "date", "day", "month", "station", "value", "year"]
    assert got.where("make_date(year, month, day) != cast(left(date, 10) as date)").isEmpty()


def test_a_load_stages_only_what_the_pivot_uses(few, tmp_root, monkeypatch):  # A4, J1
    layout, staged, stage = jobs.Layout(tmp_root), {}, src.stage
    landing.land_observations(_observations(few, 20), layout.raw_results)
    monkeypatch.setattr(src, "stage", lambda df, spark, label: staged.setdefault(label, df.columns) and stage(df, spark, label))
    few.createDataFrame([('{"station": "X", "attributes": {"a": 1}, "date": "2000-01-01"',)], "value string").write.mode(
        "append").text(layout.raw_results + "/datatype=TMAX/year=2000/month=01/day=01")
    report = jobs.job_transform_observations(few, layout, "2000-01-01", "2000-01-31")
    assert staged["raw-days"] == ["station", "date", "datatype", "value", "year", "month", "day", "usable"]
    assert (report["rows"], report["skipped_days"]) == (16, 1)  # the day of the broken record is left out whole


def test_the_span_parses_each_date_once(spark):  # C1
    rows = [("A", "2000-01-02T00:00:00")] * 500 + [("A", "2000-03-01"), ("A", "soon"), ("A", None), (None, "1999-01-01")]
    raw = spark.createDataFrame(rows, "station string, date string")
    assert tuple(map(str, observed_span(raw).first())) == ("2000-01-02", "2000-03-01")
    plan = registry._observed_span(spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("date_format") == 1  # not in a filter once more


def test_keys_that_share_a_hash_are_compared_themselves(few, monkeypatch):  # H4
    monkeypatch.setattr(tables.F, "xxhash64", lambda *c: F.lit(7).cast("bigint"))
    ids = few.range(50).select(F.col("id").cast("string").alias("id"))
    tables._unique(ids, "id", "ids", 50)
    with pytest.raises(tables.ContractError, match=r"repeated id in ids: \['3'\]"):
        tables._unique(ids.unionByName(ids.where("id = '3'")), "id", "ids", 51)


def test_missing_loads_list_datatypes_by_day_not_by_row(spark):  # B7, J4
    loaded = spark.createDataFrame([("A", "2000-01-01", 1.0, None), ("B", "2000-01-01", 2.0, None), ("A", "2000-02-01", None, 3.0)],
                                   "station string, d string, tmax double, prcp double").withColumn("date", F.to_date("d"))
    periods = spark.sql("select date'2000-01-01' as start, date'2000-01-31' as end union all "
                        "select date'2000-02-01', date'2000-02-29'")
    missing = jobs._missing(periods, loaded, ["TMAX", "PRCP"])
    assert sorted((str(r.start), r.datatype) for r in missing.collect()) == [("2000-01-01", "PRCP"), ("2000-02-01", "TMAX")]
    plan = missing._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate explode(knownnotcontainsnull") < plan.index("max(isnotnull(tmax")  # the day's row first
