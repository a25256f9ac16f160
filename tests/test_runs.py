"""Runs end to end: streams, replays, failures, rebuild."""

import datetime as dt
import json
import os
import time
from dataclasses import replace
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from recordloom.operators.upsert import upsert_unified, versioned
from recordloom.plans.ingest import Run, close_run, ingest_batch, ingest_csv, open_run, run_all, run_source, save_checkpoint
from recordloom.plans.rebuild import rebuild, rebuild_unified
from recordloom.plans.tables import Tables
from recordloom.session import shared_dir
from recordloom.sources import csv_feed
from recordloom.sources.json_feed import parse_documents, read_document_stream, read_documents
from recordloom.sources.news_feed import read_news
from recordloom.sources.registry import SOURCES
from recordloom.streaming.ingest import drain, drain_csv, drain_news, unseen_entries
from recordloom.streaming.rate import drain_admission

T0 = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)


def coin(i, price, symbol=None, **extra):
    return {"id": f"id{i}", "name": f"Coin {i}", "symbol": symbol or f"S{i}", "rank": i, "quotes": {"USD": {"price": price}}, **extra}


def land(folder, name, records):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps(r) for r in records) + "\n")


def state(spark, tables):
    rows = tables.unified.current(spark).collect()
    return {r.canonical_id: (r.source, r.title, json.loads(r.extra_data)["price_usd"]) for r in rows}


def test_stream_is_incremental_and_idempotent(spark, tmp_path):
    tables, landing, cp = Tables(str(tmp_path / "t")), tmp_path / "in", str(tmp_path / "cp")
    land(landing, "1.json", [coin(1, 1.0), coin(2, 2.0), {"id": "broken"}])

    def work(run):
        drain(tables, run, read_document_stream(spark, str(landing), 1), cp)

    run_source(spark, tables, Run("coinpaprika", T0), work)
    assert state(spark, tables) == {"s1": ("coinpaprika", "Coin 1", 1.0), "s2": ("coinpaprika", "Coin 2", 2.0)}
    land(landing, "2.json", [coin(2, 5.0), coin(3, 3.0)])
    second = run_source(spark, tables, Run("coinpaprika", T0 + dt.timedelta(hours=1)), work)
    assert state(spark, tables)["s2"] == ("coinpaprika", "Coin 2", 5.0) and len(state(spark, tables)) == 3
    ledger = {r.run_id: r for r in tables.runs.current(spark).collect()}
    counts = sorted((r.records_fetched, r.records_processed, r.records_failed, r.status) for r in ledger.values())
    assert counts == [(2, 2, 0, "success"), (3, 2, 1, "success")]
    assert ledger[second].started_at.hour == 1 and ledger[second].duration_seconds is not None
    assert spark.read.parquet(tables.rejects).first().error.startswith("name: required")
    assert tables.raw_api.current(spark).count() == 4


def test_stream_equals_batch(spark, tmp_path):
    landing = tmp_path / "in"
    for n in range(3):
        land(landing, f"{n}.json", [coin(i, n * 10.0 + i) for i in range(n, n + 4)])
    streamed, batched = Tables(str(tmp_path / "s")), Tables(str(tmp_path / "b"))
    drain(streamed, Run("coinpaprika", T0), read_document_stream(spark, str(landing), 1), str(tmp_path / "cp"))
    docs = read_documents(spark, str(landing))
    run = Run("coinpaprika", T0)
    for n in range(3):
        part = docs.filter(F.col("_row_file.path").endswith(f"{n}.json"))
        ingest_batch(batched, run, part, n + 1)
        ingest_batch(batched, run, part, n + 1)  # a repeated batch replaces itself
    got, expected = state(spark, streamed), state(spark, batched)
    assert set(got) == set(expected) and len(got) == 6
    assert expected["s3"][2] == 23.0


def test_failures_are_recorded_and_isolated(spark, tmp_path):
    tables = Tables(str(tmp_path / "t"))
    path = tmp_path / "p.csv"
    path.write_text("product_id,name,category,price\nP1,n,c,1\nP2,n,c,-1\n")

    def fail(run):
        raise OSError("Connection refused")

    def load(run):
        rows = csv_feed.read_csv(spark, str(path), ["product_id", "name", "category", "price"])
        ingest_batch(tables, run, rows, 1)
        save_checkpoint(spark, tables, run, 1, "2|abc")

    assert run_all(spark, tables, {"coinpaprika": fail, "csv": load, "rss": fail}) == {"coinpaprika": "failed", "csv": "success"}
    ledger = {r.source: r for r in tables.runs.current(spark).collect()}
    assert ledger["coinpaprika"].status == "failed" and "Connection refused" in ledger["coinpaprika"].error_message
    assert (ledger["csv"].records_processed, ledger["csv"].records_failed) == (1, 1)
    assert tables.checkpoints.current(spark).first().last_value == "2|abc"
    raw = tables.raw_csv.current(spark).orderBy("row_number").collect()
    assert [(r.file_name, r.row_number) for r in raw] == [(f"file:{path}", 1), (f"file:{path}", 2)]
    with pytest.raises(OSError):
        run_source(spark, tables, Run("coinpaprika"), fail)


def test_newest_file_of_a_micro_batch_wins(spark, tmp_path):
    """Spark packs files largest first; the order of writes is that of the files."""
    tables, landing = Tables(str(tmp_path / "t")), tmp_path / "in"
    sizes = (300, 5, 900, 1)
    for n, size in enumerate(sizes):
        land(landing, f"{9 - n}.json", [coin(1, float(n))] + [coin(100 + i, 1.0) for i in range(size)])
        os.utime(landing / f"{9 - n}.json", (1_700_000_000 + n, 1_700_000_000 + n))
    drain(tables, Run("coinpaprika", T0), read_document_stream(spark, str(landing)), str(tmp_path / "cp"))
    assert state(spark, tables)["s1"][2] == len(sizes) - 1


def test_csv_runs_go_on_where_they_stopped(spark, tmp_path):
    tables, columns = Tables(str(tmp_path / "t")), ["product_id", "name", "category", "price"]
    head = "product_id,name,category,price\n"
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text(head + "P1,n,c,1\nP2,n,c,2\n")
    fetched = []
    for n in range(4):
        if n == 1:
            (tmp_path / "in" / "b.csv").write_text(head + "P3,n,c,3\n")
        if n == 3:
            (tmp_path / "in" / "a.csv").write_text(head + "P1,n,c,9\nP2,n,c,2\nP4,n,c,4\n")
        run = Run("csv", T0 + dt.timedelta(hours=n))
        run_source(spark, tables, run, lambda r: ingest_csv(spark, tables, r, str(tmp_path / "in"), columns))
        fetched.append(tables.counters.current(spark, run.run_id).first().records_fetched)
    assert fetched == [2, 1, 0, 3]
    marks = {r.source: r.last_value.split("|")[0] for r in tables.checkpoints.current(spark).collect()}
    assert marks == {f"csv:file:{tmp_path}/in/a.csv": "3", f"csv:file:{tmp_path}/in/b.csv": "1"}
    assert {r.source_id for r in tables.unified.current(spark).collect()} == {"P1", "P2", "P3", "P4"}


def test_runs_of_one_instant_both_survive(spark, tmp_path):
    tables = Tables(str(tmp_path / "t"))
    runs = [Run("coinpaprika", T0), Run("coinpaprika", T0)]
    for n, run in enumerate(runs):
        open_run(spark, tables, run)
        land(tmp_path / run.run_id, "d.json", [coin(n, 1.0)])
        ingest_batch(tables, run, read_documents(spark, str(tmp_path / run.run_id)), 1)
        close_run(spark, tables, run, "x" * 5000)
    ledger = tables.runs.current(spark).collect()
    assert {r.run_id for r in ledger} == {r.run_id for r in runs}
    assert all(len(r.error_message) == 5000 and r.records_processed == 1 for r in ledger)
    assert set(state(spark, tables)) == {"s0", "s1"}


def test_widths_are_rejected_before_the_write(spark, tmp_path):
    tables, run = Tables(str(tmp_path / "t")), Run("coinpaprika", T0)
    wide = dict(coin(1, 1.0), id="w" * 300)
    land(tmp_path / "in", "d.json", [wide, coin(2, 2.0), {"id": "broken"}])
    ingest_batch(tables, run, read_documents(spark, str(tmp_path / "in")), 1)
    assert set(state(spark, tables)) == {"s2"}
    reasons = sorted(r.error for r in spark.read.parquet(tables.rejects).collect())
    assert len(reasons) == 2 and any("source_id: longer than" in r for r in reasons)
    counted = tables.counters.current(spark).first()
    assert (counted.records_fetched, counted.records_processed, counted.records_failed) == (3, 1, 2)


def test_a_feed_outside_the_registry(spark, tmp_path):
    tables = Tables(str(tmp_path / "t"))
    spec = replace(SOURCES["coinpaprika"], name="mirror", order=20)
    land(tmp_path / "in", "d.json", [coin(4, 4.0)])

    def load(run):
        ingest_batch(tables, run, read_documents(spark, str(tmp_path / "in")), 1)

    assert run_all(spark, tables, {"mirror": load}, {"mirror": spec}) == {"mirror": "success"}
    assert tables.raw_api.current(spark).first().external_id == "mirror_id4"
    assert tables.runs.current(spark).first().source == "mirror"


def test_rebuild(spark, tmp_path):
    tables = Tables(str(tmp_path / "t"))
    runs = [Run("coinpaprika", T0), Run("coingecko", T0 + dt.timedelta(hours=1)), Run("coinpaprika", T0 + dt.timedelta(hours=2))]
    market = {"id": "m1", "symbol": "s1", "name": "Coin 1", "current_price": 9.0}
    for run, docs in zip(runs, ([coin(1, 1.0), coin(2, 2.0)], [market], [coin(2, 7.0)])):
        land(tmp_path / run.run_id, "d.json", docs)
        ingest_batch(tables, run, read_documents(spark, str(tmp_path / run.run_id)), 1)
    expected = {"s1": ("coingecko", "Coin 1", 9.0), "s2": ("coinpaprika", "Coin 2", 7.0)}
    assert state(spark, tables) == expected
    again = rebuild(spark, tables).collect()
    assert {r.canonical_id: (r.source, r.title, json.loads(r.extra_data)["price_usd"]) for r in again} == expected


def test_rebuild_computes_its_documents_once(spark):
    """Two feeds are read from what was computed for both."""
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = [(f"coinpaprika_{k}", json.dumps({"id": str(k), "name": "n", "symbol": f"s{k}", "rank": 1}), k) for k in range(20)]
    raw = spark.createDataFrame(rows, "external_id string, data string, _last_seq long").withColumn("fetched_at", F.current_timestamp())
    assert rebuild_unified(raw.mapInArrow(counted, raw.schema)).count() == 20 and seen.value == 20


def test_rebuild_of_rows_and_entries(spark, tmp_path):
    tables = Tables(str(tmp_path / "t"))
    (tmp_path / "p.csv").write_text("product_id,name,category,price,colour\nP1,Lamp,home,3.5,red\nP2,,home,1,\n")
    (tmp_path / "n.xml").write_text(
        "<rss><channel><title>Feed</title>\n<item><guid>g</guid><title>One</title><link>http://x/1</link>"
        "<description>d</description><pubDate>Tue, 05 Mar 2024 07:08 GMT</pubDate><category>a</category></item></channel></rss>"
    )
    run = Run("csv", T0)
    ingest_csv(spark, tables, run, str(tmp_path / "p.csv"), ["product_id", "name", "category", "price", "description", "stock_quantity", "created_at"])
    ingest_batch(tables, Run("rss", T0), read_news(spark, str(tmp_path / "n.xml")), 1)
    columns = [c for c in tables.unified.current(spark).columns if c not in ("checksum", "_first_seq", "_last_seq")]
    stored = sorted(map(str, tables.unified.current(spark).select(*columns).collect()))
    assert len(stored) == 3 and sorted(map(str, rebuild(spark, tables).select(*columns).collect())) == stored


def test_stream_dedup(spark, tmp_path):
    schema = "_feed_url string, id string, at timestamp"
    rows = [("f", "a", T0), ("f", "a", T0 + dt.timedelta(minutes=1)), ("f", "b", T0), ("g", "a", T0)]
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    out = unseen_entries(stream, "at", "1 hour")
    query = out.writeStream.format("memory").queryName("dedup").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    query.awaitTermination()
    assert sorted((r._feed_url, r.id) for r in spark.table("dedup").collect()) == [("f", "a"), ("f", "b"), ("g", "a")]


def test_stream_token_bucket(spark, tmp_path):
    from recordloom.operators.rate import token_admission

    rows = [(("hot", "b")[i % 5 == 0], i, T0 + dt.timedelta(milliseconds=300 * i)) for i in range(60)]
    schema = "k string, i int, ts timestamp"
    df = spark.createDataFrame(rows, schema)
    for n in range(3):
        df.filter((F.col("i") >= 20 * n) & (F.col("i") < 20 * n + 20)).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    drain_admission(stream, "k", "ts", ["i"], str(tmp_path / "out"), str(tmp_path / "cp"), 60, 3)
    batch = {r.i: (r.admitted, r.tokens_left) for r in token_admission(df, "k", "ts", ["i"], 60, 3).collect()}
    out = spark.read.parquet(str(tmp_path / "out" / "admitted"))
    assert {r.i: (r.admitted, r.tokens_left) for r in out.collect()} == batch and out.select("commit").distinct().count() == 3


def test_unified_rows_of_both_feeds_meet(spark):
    docs = parse_documents(spark.createDataFrame([(json.dumps(coin(1, 1.0, "BTC")),)], "d string"), "d")
    from recordloom.sources.registry import unify_feeds

    market = parse_documents(spark.createDataFrame([('{"id":"bitcoin","symbol":"btc","name":"Bitcoin"}',)], "d string"), "d")
    rows = unify_feeds({"coinpaprika": docs, "coingecko": market})
    seq = F.when(F.col("source") == "coinpaprika", 1).otherwise(2)
    out = upsert_unified(versioned(rows.withColumns({"written_at": F.current_timestamp(), "seq": seq}))).collect()
    assert [(r.canonical_id, r.source) for r in out] == [("btc", "coingecko")]


def test_folders_with_files_of_one_name(spark, tmp_path):
    tables, columns = Tables(str(tmp_path / "t")), ["product_id", "name", "category", "price"]
    head = "product_id,name,category,price\n"
    for folder, n in (("x", 5), ("y", 3)):
        (tmp_path / "in" / folder).mkdir(parents=True)
        (tmp_path / "in" / folder / "p.csv").write_text(head + "".join(f"{folder}{i},n,c,{i}\n" for i in range(n)))
    paths = [str(tmp_path / "in" / f) for f in ("x", "y")]
    for n in range(2):
        run = Run("csv", T0 + dt.timedelta(hours=n))
        run_source(spark, tables, run, lambda r: ingest_csv(spark, tables, r, paths, columns))
    assert tables.counters.current(spark, run.run_id).first().records_fetched == 0
    assert tables.raw_csv.current(spark).count() == 8 and tables.unified.current(spark).count() == 8
    marks = {r.source.split("/")[-2]: r.last_value.split("|")[0] for r in tables.checkpoints.current(spark).collect()}
    assert marks == {"x": "5", "y": "3"}


def test_a_batch_is_transformed_once(spark, tmp_path):
    calls = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(text):
        calls.add(1)
        return text

    base = SOURCES["coinpaprika"]
    spec = replace(base, name="mirror", transform=lambda df, keep=(): base.transform(df, keep).withColumn("title", counted("title")))
    land(tmp_path / "in", "d.json", [coin(i, 1.0) for i in range(40)] + [{"id": "broken"}])
    tables, run = Tables(str(tmp_path / "t")), Run("mirror", T0, spec=spec)
    ingest_batch(tables, run, read_documents(spark, str(tmp_path / "in")), 1)
    assert calls.value == 41
    counts = tables.counters.current(spark).first()
    assert (counts.records_fetched, counts.records_processed, counts.records_failed) == (41, 40, 1)


def test_csv_files_as_a_stream(spark, tmp_path):
    tables, landing = Tables(str(tmp_path / "t")), tmp_path / "in"
    (landing / "x").mkdir(parents=True)
    (landing / "y").mkdir()
    (landing / "x" / "p.csv").write_text("product_id,name,category,price\nP1,a,c,1\nP2,b,c,-1\n")
    (landing / "y" / "p.csv").write_text("price,colour,name,product_id,category\n5,red,a2,P1,c\n")
    os.utime(landing / "x" / "p.csv", (1_700_000_000, 1_700_000_000))
    columns = ["product_id", "name", "category", "price"]

    def go(hour):
        run = Run("csv", T0 + dt.timedelta(hours=hour))
        run_source(spark, tables, run, lambda r: drain_csv(spark, tables, r, str(landing), columns, str(tmp_path / "cp"), 1))
        return tables.counters.current(spark, run.run_id).agg(F.sum("records_fetched")).first()[0]

    assert go(0) == 3
    (landing / "y" / "q.csv").write_text("product_id,name,category,price\nP3,z,c,9\n")
    assert go(1) == 1
    rows = {r.source_id: (r.title, json.loads(r.extra_data)["price"]) for r in tables.unified.current(spark).collect()}
    assert rows == {"P1": ("a2", 5.0), "P3": ("z", 9.0)}
    raw = sorted((r.file_name.split("/")[-2], r.row_number) for r in tables.raw_csv.current(spark).collect())
    assert raw == [("x", 1), ("x", 2), ("y", 1), ("y", 1)]


def test_news_documents_as_a_stream(spark, tmp_path):
    tables, landing = Tables(str(tmp_path / "t")), tmp_path / "in"
    landing.mkdir()
    rss = "<rss><channel><title>A &amp; B</title><item><guid>g1</guid><title>One</title><link>http://x/1</link><description>d</description></item>{}</channel></rss>"
    atom = '<feed><title>Notes</title><entry><id>u1</id><title>Two</title><link href="http://y/1"/><summary>s</summary><category term="t"/></entry></feed>'
    (landing / "a.xml").write_text(rss.format("<item><title>broken</titel></item>"))

    def go(hour):
        run = Run("rss", T0 + dt.timedelta(hours=hour))
        run_source(spark, tables, run, lambda r: drain_news(spark, tables, r, str(landing), str(tmp_path / "cp"), 1))

    go(0)
    (landing / "b.xml").write_text(atom)
    go(1)
    rows = {r.source_id: (r.title, r.content, r.category, r.updated_at.hour) for r in tables.unified.current(spark).collect()}
    assert rows == {"g1": ("One", "d", None, 0), "u1": ("Two", "s", "news", 1)}


def test_a_store_without_raw_rows_rebuilds_to_nothing(spark, tmp_path):
    empty = rebuild(spark, Tables(str(tmp_path / "t")))
    assert empty.count() == 0 and "canonical_id" in empty.columns


def test_replayed_entries_leave_a_bounded_state(spark):
    from workload.ingest_queries import replay_entries

    path, held = replay_entries(spark, "/root/testdata/sf0.01")
    rows = spark.read.parquet(path)
    total = spark.read.parquet("/root/testdata/sf0.01/orders.parquet").count()
    assert rows.count() == rows.select("id").distinct().count() == total
    assert max(held) < 0.25 * total and held[-1] <= 1.2 * held[1]


def test_a_batch_leaves_neither_cache_nor_staging_and_places_records_across_files(spark, tmp_path):
    """Later files win whatever their names; what a batch is staged in is gone after it."""
    landing, tables = str(tmp_path / "in"), Tables(str(tmp_path / "t"))
    document = '{"id":"c","name":"%s","symbol":"cc","rank":%d}'
    for name, rank in (("zz", 1), ("aa", 2)):
        spark.createDataFrame([(document % (name, rank),), ("broken",)], "doc string").coalesce(1).write.mode("append").text(landing)
        time.sleep(1.1)
    before = len(list(Path(shared_dir(spark).removeprefix("file:")).glob("batch-*")))
    held = spark.sparkContext._jsc.getPersistentRDDs().size()
    raw, cached = read_documents(spark, landing), []
    append = type(tables.unified).append

    def watched(self, rows, *where):
        cached.append(spark.sparkContext._jsc.getPersistentRDDs().size())
        append(self, rows, *where)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(type(tables.unified), "append", watched)
        ingest_batch(tables, Run("coinpaprika"), raw, 1)
    assert set(cached) == {held}
    assert len(list(Path(shared_dir(spark).removeprefix("file:")).glob("batch-*"))) == before
    row = tables.unified.current(spark).first()
    assert (row.title, json.loads(row.extra_data)["rank"]) == ("aa", 2)
    rejects = spark.read.parquet(tables.rejects)
    assert rejects.count() == 2 and {json.loads(r.record)["data"] for r in rejects.collect()} == {"broken"}
