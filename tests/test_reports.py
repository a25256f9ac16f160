import datetime as dt

import pytest
from pyspark.sql import functions as F

from recordloom.operators import compare as C
from recordloom.operators import entities as E
from recordloom.operators import listing as L
from recordloom.operators import paging as P
from recordloom.operators import reports as R

T0 = dt.datetime(2024, 1, 1)
RUN = "run_id string, source string, status string, started_at timestamp, finished_at timestamp, duration_seconds double, records_processed long, records_failed long"


def run(n, source="a", status="success", duration=10.0, processed=100, failed=0):
    start = T0 + dt.timedelta(hours=n)
    return (f"r{n}", source, status, start, start + dt.timedelta(seconds=duration or 0), duration, processed, failed)


@pytest.fixture(scope="module")
def runs(spark):
    rows = [run(1), run(2, status="failed", duration=16.0, processed=79, failed=8), run(3, "b", duration=0.0, processed=0, failed=1),
            run(4, duration=None), run(5, "c", "running", None, 0)]
    return spark.createDataFrame(rows, RUN)


def test_summary(runs):
    r = R.run_summary(runs).first()
    assert (r.total_runs, r.successful_runs, r.failed_runs, r.total_records_processed) == (5, 3, 1, 279)
    assert r.average_duration_seconds == 8.67
    assert r.last_success_at == T0 + dt.timedelta(hours=4)
    assert r.last_failure_at == T0 + dt.timedelta(hours=2, seconds=16)


def test_summary_of_nothing(runs):
    r = R.run_summary(runs.limit(0)).first()
    assert tuple(r) == (0, 0, 0, 0, None, None, None)


def test_source_stats(spark, runs):
    unified = spark.createDataFrame([("a",), ("a",), ("z",)], "source string")
    got = {r.source: tuple(r)[1:] for r in R.source_stats(unified, runs).collect()}
    assert got == {"a": (2, T0 + dt.timedelta(hours=4), "success", None, 100), "z": (1, None, None, None, None)}


def test_histogram(runs):
    got = {(r.source, r.le): r.cumulative_count for r in R.duration_histogram(runs).collect()}
    assert got[("a", "10")] == 1 and got[("a", "30")] == 2 and got[("a", "+Inf")] == 2 and got[("b", "0.5")] == 1
    assert len(got) == 20


def test_look_back(runs):
    now = F.lit(T0 + dt.timedelta(days=1, hours=3)).cast("timestamp")
    assert R.recent_runs(runs, 1, now).count() == 3
    with pytest.raises(ValueError):
        R.recent_runs(runs, 91)


def test_compare(runs):
    r = C.compare_runs(runs, "r2", "r1").first()
    assert (r.duration_diff_seconds, r.records_diff) == (6.0, -21)
    assert r.anomalies == ["Duration difference: 60.0%", "Record count difference: 21.0%", "Status changed: success -> failed",
                           "High failure rate in run 1: 8 failed"]
    assert C.compare_runs(runs, "r1", "r3").first().duration_diff_seconds is None
    with pytest.raises(LookupError, match="Run not found: nope"):
        C.compare_runs(runs, "r1", "nope")


def test_consecutive(runs):
    got = {r.run_id: r for r in C.compare_consecutive(runs).collect()}
    assert (got["r2"].previous_run_id, got["r4"].previous_run_id, got["r1"].previous_run_id) == ("r1", "r2", None)
    assert got["r1"].anomalies is None and got["r4"].duration_diff_seconds is None


def test_latest(runs):
    assert L.latest_run(runs).first().last_run_status == "running"
    assert [r.run_id for r in L.run_history(runs, 2, "a").collect()] == ["r4", "r2"]


@pytest.fixture(scope="module")
def records(spark):
    rows = [(f"id{i:03d}", "s", f"cat{i % 2}", f" Title {i} ", f"content {i}", None if i % 3 else "Ann", T0 + dt.timedelta(minutes=i // 2)) for i in range(50)]
    return spark.createDataFrame(rows, "canonical_id string, source string, category string, title string, content string, author string, ingested_at timestamp")


@pytest.mark.parametrize("offset", [0, 7, 45, 60])
def test_pages(records, offset):
    got = [r.canonical_id for r in L.page(records, 10, offset).collect()]
    every = sorted(((-r.ingested_at.timestamp(), r.canonical_id) for r in records.collect()))
    assert got == [c for _, c in every[offset : offset + 10]]
    info = L.page_info(records, 10, offset).first()
    assert (info.total, info.has_more) == (50, offset + len(got) < 50)


@pytest.mark.parametrize("limit, offset", [(200, 0), (0, 0), (10, -1)])
def test_page_bounds(records, limit, offset):
    with pytest.raises(ValueError):
        L.page(records, limit, offset)


def test_filters(records):
    assert L.filter_records(records, author="aN").count() == 17
    assert L.filter_records(records, search="TITLE 1_").count() == 11
    assert L.filter_records(records, category="cat1", source="").count() == 25
    assert L.filter_records(records, start="2024-01-01 00:01:00", end="2024-01-01 00:02:00").count() == 4


def test_equality_and_range_reach_the_scan(spark, records, tmp_path):
    records.write.parquet(str(tmp_path / "r"))
    found = L.filter_records(spark.read.parquet(str(tmp_path / "r")), source="s", start="2024-01-01", search="x")
    plan = found.select("canonical_id")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(source,s)" in plan and "GreaterThanOrEqual(ingested_at" in plan
    assert "author" not in plan.split("ReadSchema")[1]


def test_slices(spark):
    df = spark.range(25).withColumnRenamed("id", "position")
    assert P.offset_slice(df, "20", 10).count() == 5
    assert P.offset_slice(df, "bad", 10).agg(F.min("position")).first()[0] == 0
    assert P.page_slice(df, "3", 10).agg(F.min("position")).first()[0] == 20
    got = [tuple(r) for r in P.offset_batches(df, 10).orderBy("batch_no").collect()]
    assert got == [(0, 10, True, "10"), (1, 10, True, "20"), (2, 5, False, None)]
    got = [tuple(r) for r in P.page_batches(df, 5).orderBy("page").collect()]
    assert got[-1] == (5, 5, True, "6") and len(got) == 5


def test_seen_ids(spark):
    entries = spark.createDataFrame([("a",), ("b,c",), ("",)], "id string")
    seen = spark.createDataFrame([("b",), ("a",)], "id string")
    assert sorted(r.id for r in P.unseen(entries, seen).collect()) == ["", "b,c"]
    assert sorted(r.id for r in P.remember(seen, entries).collect()) == ["a", "b", "b,c"]


def test_agreement_and_collisions(spark):
    rows = [("k", "x", "1", 5.0, 1), ("k", "x", "2", 7.0, 2), ("k", "y", "3", 4.0, 3), ("z", "x", "9", 1.0, 4)]
    df = spark.createDataFrame(rows, "canonical_id string, source string, source_id string, v double, seq int")
    got = {r.canonical_id: tuple(r)[1:] for r in E.source_agreement(df, F.col("v"), ["x", "y"]).collect()}
    assert got == {"k": (7.0, 4.0, 2, 3.0), "z": (1.0, None, 1, None)}
    assert [tuple(r) for r in E.id_collisions(df).collect()] == [("k", "x", 2)]


@pytest.mark.parametrize("kind", ["text", "number"])
def test_pages_through_heavy_ties(spark, monkeypatch, kind):
    """Stretches, instants and leading characters are divided until little is left to sort."""
    monkeypatch.setattr(L, "SORTED", 6)
    monkeypatch.setattr(L, "STRETCHES", 5)
    at = [T0] * 120 + [T0 + dt.timedelta(days=3650 * (i % 3), microseconds=i) for i in range(60)] + [None] * 40
    tie = [f"page/{'same-prefix-' * (i % 2)}{i * 7919 % 997:04d}" if kind == "text" else (i * 7919 % 997 - 500) * 10**15 for i in range(len(at))]
    rows = list(zip(at, tie))
    df = spark.createDataFrame(rows, f"ingested_at timestamp, canonical_id {'string' if kind == 'text' else 'long'}").repartition(3).cache()
    every = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or T0).timestamp(), r[1]))
    for offset, limit in ((0, 9), (30, 10), (55, 20), (118, 30), (175, 12), (178, 4), (181, 30), (215, 20), (400, 5)):
        got = [(r.ingested_at, r.canonical_id) for r in L.page(df, limit, offset).collect()]
        assert got == every[offset : offset + limit], (offset, limit)


def test_a_page_reads_a_range_of_the_files(spark, tmp_path):
    rows = [(f"id{i:06d}", T0 + dt.timedelta(minutes=i)) for i in range(20_000)]
    spark.createDataFrame(rows, "canonical_id string, ingested_at timestamp").coalesce(1).write.parquet(str(tmp_path / "t"))
    found = L.page(spark.read.parquet(str(tmp_path / "t")), 10, 15_000)
    assert [r.canonical_id for r in found.collect()] == [f"id{i:06d}" for i in range(4_999, 4_989, -1)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ingested_at), GreaterThanOrEqual(ingested_at,2024-01-" in plan and "LessThanOrEq" in plan
    assert "Exchange rangepartitioning" not in plan


def test_clustered_tables_are_read_in_part(spark, tmp_path):
    from recordloom.plans import layout

    words = ["alpha", "beta", "gamma", "delta"]
    rows = [(f"c{i}", "t", f"{words[i % 4]} {words[i // 7 % 4]}" + (" needle-Ünïque" if i in (17, 1900) else ""), T0 + dt.timedelta(minutes=i)) for i in range(2_500)]
    df = spark.createDataFrame(rows, "canonical_id string, title string, content string, ingested_at timestamp")
    path, signatures = str(tmp_path / "t"), str(tmp_path / "s")
    layout.write_clustered(df, path)
    layout.write_signatures(spark, path, signatures)
    blocks = spark.read.parquet(signatures)
    assert blocks.count() == 50
    assert layout.possible_blocks(blocks, "NEEDLE-ü").count() == 2 and layout.possible_blocks(blocks, "alpha").count() == 50
    for text in ("NEEDLE-ü", "needle%que", "beta gam", "nothing like it", "al", "t\nalpha"):
        got = sorted(r.canonical_id for r in layout.search_clustered(spark, path, signatures, text).collect())
        assert got == sorted(r.canonical_id for r in L.filter_records(df, search=text).collect()), text
    plan = layout.search_clustered(spark, path, signatures, "needle")._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan
    start, end = T0 + dt.timedelta(minutes=700), T0 + dt.timedelta(minutes=760)
    found = L.filter_records(spark.read.parquet(path), start=start.isoformat(sep=" "), end=end.isoformat(sep=" "))
    groups = _row_groups(path)
    reached = [g for g in groups if g[0] <= end and g[1] >= start]
    assert found.count() == 61 and len(reached) <= 3 < len(groups)


def _row_groups(path):
    """First and last instant of every row group of a table."""
    from pathlib import Path

    import pyarrow.parquet as pq

    out = []
    for file in Path(path).rglob("*.parquet"):
        meta = pq.ParquetFile(file).metadata
        at = meta.schema.names.index("ingested_at")
        out += [(s.min.replace(tzinfo=None), s.max.replace(tzinfo=None)) for s in (meta.row_group(k).column(at).statistics for k in range(meta.num_row_groups))]
    return out
