"""Listings, statistics, run comparison, drift and rate control (Q, D, R)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordloom.functions.similarity import name_ratio
from recordloom.operators import compare as C
from recordloom.operators import drift as D
from recordloom.operators import listing as L
from recordloom.operators import rate as A
from recordloom.operators import reports as R
from recordloom.plans import layout
from recordloom.session import scratch_path
from workload import inputs as I
from workload import sqltext as S
from workload.feeds import cte, feed, table
from workload.inputs import ts_text
from workload.registry import query


def _records(spark: SparkSession, sf: str) -> DataFrame:
    return feed(spark, sf, "records")


# --- listings ------------------------------------------------------------------------------------


@query("Q1_equality_filters", cte("records") + " SELECT canonical_id, source, category FROM records WHERE source = 'src3' AND category = 'en'")
def equality_filters(spark: SparkSession, sf: str) -> DataFrame:
    found = L.filter_records(_records(spark, sf), source="src3", category="en", author="")
    return found.select("canonical_id", "source", "category")


@query("Q2_author_filter", cte("records") + " SELECT canonical_id, author FROM records WHERE author ILIKE '%user_1%'")
def author_filter(spark: SparkSession, sf: str) -> DataFrame:
    return L.filter_records(_records(spark, sf), author="user_1").select("canonical_id", "author")


@query("Q3_text_search", cte("records") + " SELECT canonical_id, title FROM records WHERE title ILIKE '%SRC1%' OR content ILIKE '%SRC1%' ")
def text_search(spark: SparkSession, sf: str) -> DataFrame:
    return L.filter_records(_records(spark, sf), search="SRC1").select("canonical_id", "title")


@query("Q3_signature_search", cte("records") + " SELECT canonical_id, title, content FROM records WHERE title ILIKE '%licensed under%' OR content ILIKE '%licensed under%' ")
def signature_search(spark: SparkSession, sf: str) -> DataFrame:
    """The same search over a clustered table, of which only the blocks are read whose signature has all trigrams."""
    path, signatures = scratch_path(spark, "clustered"), scratch_path(spark, "signatures")
    layout.write_clustered(_records(spark, sf), path)
    layout.write_signatures(spark, path, signatures)
    return layout.search_clustered(spark, path, signatures, "Licensed UNDER").select("canonical_id", "title", "content")


@query(
    "Q4_clustered_range",
    cte("records") + f""" SELECT canonical_id, category, {S.ts_text("ingested_at")} AS ingested_at FROM records
    WHERE source = 'src2' AND ingested_at >= TIMESTAMP '2024-01-01 02:00:00' AND ingested_at <= TIMESTAMP '2024-01-01 05:00:00'""",
)
def clustered_range(spark: SparkSession, sf: str) -> DataFrame:
    """A range of a clustered table: row groups outside it are skipped by their statistics."""
    path = scratch_path(spark, "clustered")
    layout.write_clustered(_records(spark, sf), path)
    found = L.filter_records(spark.read.parquet(path), source="src2", start="2024-01-01 02:00:00", end="2024-01-01 05:00:00")
    return found.select("canonical_id", "category", ts_text("ingested_at").alias("ingested_at"))


@query(
    "Q4_date_range",
    cte("records") + f""" SELECT canonical_id, {S.ts_text("ingested_at")} AS ingested_at FROM records
    WHERE ingested_at >= TIMESTAMP '2024-01-01 01:00:00' AND ingested_at <= TIMESTAMP '2024-01-01 09:20:00'""",
)
def date_range(spark: SparkSession, sf: str) -> DataFrame:
    found = L.filter_records(_records(spark, sf), start="2024-01-01 01:00:00", end="2024-01-01 09:20:00")
    return found.select("canonical_id", ts_text("ingested_at").alias("ingested_at"))


@query("Q5_total_count", cte("records") + " SELECT count(*) AS total FROM records WHERE content ILIKE '%the%'")
def total_count(spark: SparkSession, sf: str) -> DataFrame:
    return L.total(L.filter_records(_records(spark, sf), search="the"))


@query(
    "Q6_newest_page",
    cte("records") + f""" SELECT canonical_id, title, {S.ts_text("ingested_at")} AS ingested_at FROM records
    WHERE category = 'en' ORDER BY ingested_at DESC, canonical_id LIMIT 25 OFFSET 50""",
)
def newest_page(spark: SparkSession, sf: str) -> DataFrame:
    found = L.page(L.filter_records(_records(spark, sf), category="en"), limit=25, offset=50)
    return found.select("canonical_id", "title", ts_text("ingested_at").alias("ingested_at"))


@query(
    "Q6_deep_page",
    f"""SELECT o_orderkey, {S.ts_text("o_orderdate")} AS o_orderdate FROM orders ORDER BY o_orderdate DESC, o_orderkey
    LIMIT 40 OFFSET 1000""",
)
def deep_page(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    found = L.page(orders, 40, 1000, "o_orderdate", "o_orderkey")
    return found.select("o_orderkey", ts_text("o_orderdate").alias("o_orderdate"))


@query(
    "Q7_page_info",
    cte("records") + """ SELECT count(*) AS total, 20 AS "limit", 180 AS "offset", 180 + least(20, greatest(count(*) - 180, 0)) < count(*) AS has_more
    FROM records WHERE category = 'fr'""",
)
def page_info(spark: SparkSession, sf: str) -> DataFrame:
    return L.page_info(L.filter_records(_records(spark, sf), category="fr"), limit=20, offset=180)


@query(
    "Q8_public_view",
    cte("records") + f""" SELECT source, source_id, trim(title) AS title, {S.strip("content")} AS content, author, category, url,
    {S.ts_text("external_created_at")} AS external_created_at, {S.ts_text("ingested_at")} AS ingested_at,
    {S.ts_text("updated_at")} AS updated_at, extra_data FROM records""",
)
def public_view(spark: SparkSession, sf: str) -> DataFrame:
    times = ("external_created_at", "ingested_at", "updated_at")
    return L.public_view(_records(spark, sf)).withColumns({c: ts_text(c) for c in times})


_HISTORY = "run_id, source, status, duration_seconds, records_processed"


@query("Q9_run_history", cte("runs") + f" SELECT {_HISTORY} FROM runs WHERE source = 'purchase' ORDER BY started_at DESC, run_id LIMIT 100")
def run_history(spark: SparkSession, sf: str) -> DataFrame:
    return L.run_history(I.runs(spark, sf), limit=100, source="purchase").select(*_HISTORY.split(", "))


@query(
    "Q10_latest_run",
    cte("runs") + f""" SELECT {S.ts_text("started_at")} AS last_run_at, status AS last_run_status,
    duration_seconds AS last_run_duration_seconds, records_processed FROM runs ORDER BY runs.started_at DESC, run_id DESC LIMIT 1""",
)
def latest_run(spark: SparkSession, sf: str) -> DataFrame:
    return L.latest_run(I.runs(spark, sf)).withColumn("last_run_at", ts_text("last_run_at"))


# --- statistics ----------------------------------------------------------------------------------


@query(
    "Q11_run_summary",
    cte("runs") + f""" SELECT count(*) AS total_runs, count_if(status = 'success') AS successful_runs, count_if(status = 'failed') AS failed_runs,
    CAST(coalesce(sum(records_processed), 0) AS BIGINT) AS total_records_processed,
    CASE WHEN avg(duration_seconds) <> 0 THEN round(avg(duration_seconds), 2) END AS average_duration_seconds,
    {S.ts_text("max(finished_at) FILTER (status = 'success')")} AS last_success_at,
    {S.ts_text("max(finished_at) FILTER (status = 'failed')")} AS last_failure_at FROM runs""",
)
def run_summary(spark: SparkSession, sf: str) -> DataFrame:
    out = R.run_summary(I.runs(spark, sf))
    return out.withColumns({c: ts_text(c) for c in ("last_success_at", "last_failure_at")})


@query(
    "Q12_last_outcomes",
    cte("runs") + f""" SELECT {S.ts_text("max(finished_at) FILTER (status = 'success')")} AS last_success_at,
    {S.ts_text("max(finished_at) FILTER (status = 'failed')")} AS last_failure_at FROM runs""",
)
def last_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    out = R.last_outcomes(I.runs(spark, sf))
    return out.withColumns({c: ts_text(c) for c in ("last_success_at", "last_failure_at")})


@query("Q13_distinct_sources", cte("records") + " SELECT DISTINCT source FROM records")
def distinct_sources(spark: SparkSession, sf: str) -> DataFrame:
    return R.distinct_sources(_records(spark, sf))


@query("Q14_records_per_source", cte("records") + " SELECT source, count(*) AS total_records FROM records GROUP BY source")
def records_per_source(spark: SparkSession, sf: str) -> DataFrame:
    return R.records_per_source(_records(spark, sf))


@query(
    "Q15_source_stats",
    cte("runs") + f""", last AS (SELECT source, arg_max(row(started_at, status, duration_seconds, records_processed), row(started_at, run_id)) AS r
        FROM runs GROUP BY source),
    n AS (SELECT event_type AS source, count(*) AS total_records FROM events GROUP BY 1)
    SELECT source, total_records, {S.ts_text("r[1]")} AS last_run_at, r[2] AS last_run_status, r[3] AS last_run_duration_seconds,
    r[4] AS last_records_processed FROM n LEFT JOIN last USING (source)""",
)
def source_stats(spark: SparkSession, sf: str) -> DataFrame:
    """Events as records, with the last run of their source."""
    records = table(spark, sf, "events").select(F.col("event_type").alias("source"))
    return R.source_stats(records, I.runs(spark, sf)).withColumn("last_run_at", ts_text("last_run_at"))


@query(
    "Q16_recent_runs",
    cte("runs") + """ SELECT count(*) AS total_runs, CAST(coalesce(sum(records_processed), 0) AS BIGINT) AS total_records_processed
    FROM runs WHERE started_at >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 7 DAY""",
)
def recent_runs(spark: SparkSession, sf: str) -> DataFrame:
    now = F.lit("2024-01-31 00:00:00").cast("timestamp")
    summary = R.run_summary(R.recent_runs(I.runs(spark, sf), 7, now))
    return summary.select("total_runs", "total_records_processed")


@query("Q17_last_run_epoch", cte("runs") + " SELECT source, epoch(max(started_at)) AS last_run_timestamp FROM runs GROUP BY source")
def last_run_epoch(spark: SparkSession, sf: str) -> DataFrame:
    return R.last_run_epoch(I.runs(spark, sf))


@query("Q18_runs_by_status", cte("runs") + " SELECT source, status, count(*) AS runs_total FROM runs GROUP BY ALL")
def runs_by_status(spark: SparkSession, sf: str) -> DataFrame:
    return R.runs_by_status(I.runs(spark, sf))


@query(
    "Q19_processed_by_source",
    cte("runs") + " SELECT source, CAST(sum(records_processed) AS BIGINT) AS records_processed_total FROM runs GROUP BY source",
)
def processed_by_source(spark: SparkSession, sf: str) -> DataFrame:
    return R.processed_by_source(I.runs(spark, sf))


@query(
    "Q20_duration_histogram",
    cte("runs") + """, b AS (SELECT * FROM (VALUES ('0.5', 0.5), ('1', 1), ('2', 2), ('5', 5), ('10', 10), ('30', 30), ('60', 60),
        ('120', 120), ('300', 300), ('+Inf', 1e18)) v(le, bound))
    SELECT source, le, count_if(duration_seconds <= bound) AS cumulative_count,
    CAST(sum(CAST(duration_seconds AS DECIMAL(38, 6))) AS DOUBLE) AS duration_sum, count(*) AS duration_count
    FROM runs CROSS JOIN b WHERE duration_seconds IS NOT NULL GROUP BY source, le""",
)
def duration_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return R.duration_histogram(I.runs(spark, sf))


# --- comparison ----------------------------------------------------------------------------------


def _compare_sql(one: str, two: str) -> str:
    """Comparison columns of two row aliases."""
    diff = f"CASE WHEN {one}.duration_seconds <> 0 AND {two}.duration_seconds <> 0 THEN round({one}.duration_seconds - {two}.duration_seconds, 2) END"
    rec = f"({one}.records_processed - {two}.records_processed)"
    dur_pct = f"abs({diff}) / {two}.duration_seconds * 100"
    rec_pct = f"abs({rec}) / nullif({two}.records_processed, 0) * 100"
    return f"""{diff} AS duration_diff_seconds, {rec} AS records_diff,
    concat_ws('; ',
        CASE WHEN ({diff}) <> 0 AND {dur_pct} > 50 THEN 'Duration difference: ' || printf('%.1f', {dur_pct}) || '%' END,
        CASE WHEN {rec} <> 0 AND {rec_pct} > 20 THEN 'Record count difference: ' || printf('%.1f', {rec_pct}) || '%' END,
        CASE WHEN {one}.status <> {two}.status THEN 'Status changed: ' || {two}.status || ' -> ' || {one}.status END,
        CASE WHEN {one}.records_failed > {one}.records_processed * 0.1 THEN 'High failure rate in run 1: ' || {one}.records_failed || ' failed' END,
        CASE WHEN {two}.records_failed > {two}.records_processed * 0.1 THEN 'High failure rate in run 2: ' || {two}.records_failed || ' failed' END) AS anomalies"""


# Each run against the run of the mirrored event id, so every pair is far apart in time.
_PAIRS = cte("runs") + """, m AS (SELECT max(event_id) AS m FROM runs),
    p AS (SELECT a.run_id AS run_id_1, 'run-' || CAST(m.m + CASE WHEN a.event_id % 40 = 0 THEN 1 ELSE 0 END - a.event_id AS VARCHAR) AS run_id_2 FROM runs a, m)"""


def _pairs(spark: SparkSession, sf: str) -> DataFrame:
    runs = feed(spark, sf, "runs").select("run_id", "event_id")
    top = runs.agg(F.max("event_id")).scalar()
    bump = F.when(F.col("event_id") % 40 == 0, 1).otherwise(0)
    other = F.concat(F.lit("run-"), (top + bump - F.col("event_id")).cast("string"))
    return runs.select(F.col("run_id").alias("run_id_1"), other.alias("run_id_2"))


def _compared(spark: SparkSession, sf: str) -> DataFrame:
    return C.compare_pairs(I.runs(spark, sf), _pairs(spark, sf))


@query(
    "Q21_run_lookup",
    _PAIRS + """ SELECT run_id_1, run_id_2, CASE WHEN r.run_id IS NULL THEN run_id_2 END AS not_found
    FROM p LEFT JOIN runs r ON r.run_id = run_id_2""",
)
def run_lookup(spark: SparkSession, sf: str) -> DataFrame:
    return _compared(spark, sf).select("run_id_1", "run_id_2", "not_found")


_DIFFS = _PAIRS + f", d AS (SELECT run_id_1, run_id_2, {_compare_sql('a', 'b')} FROM p JOIN runs a ON a.run_id = run_id_1 LEFT JOIN runs b ON b.run_id = run_id_2)"


@query("Q22_run_differences", _DIFFS + " SELECT run_id_1, run_id_2, duration_diff_seconds, records_diff FROM d")
def run_differences(spark: SparkSession, sf: str) -> DataFrame:
    return _compared(spark, sf).select("run_id_1", "run_id_2", "duration_diff_seconds", "records_diff")


def _one_anomaly(prefix: str) -> str:
    return _DIFFS + f""" SELECT run_id_1, run_id_2, regexp_extract(anomalies, '({prefix}[^;]*)', 1) AS anomaly
    FROM d WHERE anomalies LIKE '%{prefix}%' AND records_diff IS NOT NULL"""


def _anomaly(spark: SparkSession, sf: str, prefix: str) -> DataFrame:
    rows = _compared(spark, sf).select("run_id_1", "run_id_2", F.explode("anomalies").alias("anomaly"))
    return rows.filter(F.col("anomaly").startswith(prefix))


@query("Q23_duration_anomaly", _one_anomaly("Duration difference"))
def duration_anomaly(spark: SparkSession, sf: str) -> DataFrame:
    return _anomaly(spark, sf, "Duration difference")


@query("Q24_records_anomaly", _one_anomaly("Record count difference"))
def records_anomaly(spark: SparkSession, sf: str) -> DataFrame:
    return _anomaly(spark, sf, "Record count difference")


@query("Q25_status_anomaly", _one_anomaly("Status changed"))
def status_anomaly(spark: SparkSession, sf: str) -> DataFrame:
    return _anomaly(spark, sf, "Status changed")


@query(
    "Q26_failure_anomaly",
    _DIFFS + """ SELECT run_id_1, run_id_2, unnest(regexp_extract_all(anomalies, 'High failure rate in run [12][^;]*')) AS anomaly
    FROM d WHERE records_diff IS NOT NULL""",
)
def failure_anomaly(spark: SparkSession, sf: str) -> DataFrame:
    """Both rules: the failure rate of either run."""
    return _anomaly(spark, sf, "High failure rate in run")


@query("Q27_run_comparison", _DIFFS + " SELECT run_id_1, run_id_2, duration_diff_seconds, records_diff, anomalies FROM d WHERE records_diff IS NOT NULL")
def run_comparison(spark: SparkSession, sf: str) -> DataFrame:
    found = _compared(spark, sf).filter(F.col("not_found").isNull()).drop("not_found")
    return found.withColumn("anomalies", F.array_join("anomalies", "; "))


@query(
    "Q28_consecutive_runs",
    cte("runs") + f""", o AS (SELECT *, lag(run_id) OVER (PARTITION BY source ORDER BY started_at, run_id) AS previous FROM runs),
    c AS (SELECT a.source, a.run_id, b.run_id AS previous_run_id, {_compare_sql('a', 'b')} FROM o a LEFT JOIN runs b ON b.run_id = a.previous)
    SELECT source, run_id, previous_run_id, duration_diff_seconds, records_diff,
    CASE WHEN previous_run_id IS NOT NULL THEN anomalies END AS anomalies FROM c""",
)
def consecutive_runs(spark: SparkSession, sf: str) -> DataFrame:
    """A first run has nothing to compare with."""
    return C.compare_consecutive(I.runs(spark, sf)).withColumn("anomalies", F.array_join("anomalies", "; "))


# --- drift ---------------------------------------------------------------------------------------

_FIELDS = cte("shapes") + """, k AS (SELECT source, seq, doc, unnest(json_keys(doc)) AS field FROM shapes),
    t AS (SELECT source, seq, field, json_type(doc, '$.' || field) AS jt FROM k),
    f AS (SELECT source, seq, field, CASE WHEN jt IN ('UBIGINT', 'BIGINT') THEN 'int' WHEN jt = 'DOUBLE' THEN 'float' WHEN jt = 'VARCHAR' THEN 'str'
        WHEN jt = 'BOOLEAN' THEN 'bool' WHEN jt = 'ARRAY' THEN 'list' WHEN jt = 'OBJECT' THEN 'dict' ELSE 'NoneType' END AS type FROM t)"""


@query("D1_infer_schema", _FIELDS + " SELECT seq, field, type FROM f")
def infer_schema(spark: SparkSession, sf: str) -> DataFrame:
    return D.infer_fields(I.shapes(spark, sf), "payload", ["seq"])


# Drift per record against the declared shape. ``orderstatus`` is the only rename of order_status.
_DRIFT = _FIELDS + """, e AS (SELECT * FROM (VALUES ('order_key', 'int'), ('order_status', 'str'), ('total_price', 'float'), ('cust_key', 'int')) v(field, type)),
    g AS (SELECT source, seq, list_sort(list(field)) AS names, list(field || ':' || type ORDER BY field) AS shape FROM f GROUP BY ALL),
    c AS (SELECT f.seq, count(*) AS common, count(*) FILTER (NOT (f.type = e.type OR f.type = 'NoneType' OR (e.type IN ('int', 'float') AND f.type IN ('int', 'float')))) AS changes,
        string_agg('Type change in ''' || f.field || ''': ' || e.type || ' -> ' || f.type, '; ' ORDER BY f.field)
            FILTER (NOT (f.type = e.type OR f.type = 'NoneType' OR (e.type IN ('int', 'float') AND f.type IN ('int', 'float')))) AS change_text
        FROM f JOIN e USING (field) GROUP BY f.seq),
    x AS (SELECT g.*, common, changes, change_text, list_contains(names, 'orderstatus') AS renamed,
        list_filter(names, lambda n: n NOT IN ('order_key', 'order_status', 'total_price', 'cust_key', 'orderstatus')) AS new_fields,
        list_filter(['cust_key', 'order_key', 'order_status', 'total_price'], lambda n: NOT list_contains(names, n) AND NOT (n = 'order_status' AND list_contains(names, 'orderstatus'))) AS removed_fields
        FROM g JOIN c USING (seq)),
    d AS (SELECT *, len(new_fields) > 0 OR len(removed_fields) > 0 OR changes > 0 AS has_drift,
        round((common - changes + CAST(renamed AS INT)) / 4, 2) AS confidence_score,
        concat_ws('; ', CASE WHEN len(new_fields) > 0 THEN 'New fields detected: ' || array_to_string(new_fields, ', ') END,
            CASE WHEN len(removed_fields) > 0 THEN 'Missing fields: ' || array_to_string(removed_fields, ', ') END,
            CASE WHEN renamed THEN 'Possible field rename: order_status -> orderstatus (96% similar)' END, change_text) AS warnings FROM x)"""


def _drift(spark: SparkSession, sf: str) -> DataFrame:
    return D.record_drift(I.shapes(spark, sf), D.schema_literal(I.EXPECTED_SHAPE), "payload", ["seq"])


@query("D2_field_changes", _DRIFT + " SELECT seq, array_to_string(new_fields, ',') AS new_fields, array_to_string(removed_fields, ',') AS removed_fields FROM d")
def field_changes(spark: SparkSession, sf: str) -> DataFrame:
    return _drift(spark, sf).select(
        "seq", F.array_join("new_fields", ",").alias("new_fields"), F.array_join("removed_fields", ",").alias("removed_fields")
    )


@query(
    "D3_name_similarity",
    """WITH RECURSIVE pairs AS (SELECT DISTINCT p_name AS a, lower(p_type) AS b FROM part),
    lcs AS (SELECT a, b, 0 AS i, list_transform(range(0, length(b) + 1), lambda z: 0) AS cells FROM pairs
        UNION ALL SELECT a, b, i + 1, list_transform(range(0, length(b) + 1), lambda j:
            CASE WHEN j = 0 THEN 0 ELSE greatest(cells[j + 1], list_max(list_transform(range(1, j + 1), lambda q:
                CASE WHEN substr(b, q, 1) = substr(a, i + 1, 1) THEN cells[q] + 1 ELSE 0 END))) END)
        FROM lcs WHERE i < length(a))
    SELECT a, b, round(200.0 * cells[length(b) + 1] / (length(a) + length(b)), 6) AS similarity FROM lcs WHERE i = length(a)""",
)
def name_similarity(spark: SparkSession, sf: str) -> DataFrame:
    pairs = table(spark, sf, "part").select(F.col("p_name").alias("a"), F.lower("p_type").alias("b")).distinct()
    return pairs.withColumn("similarity", F.round(name_ratio(F.col("a"), F.col("b")), 6))


@query("D4_type_changes", _DRIFT + " SELECT seq, changes, change_text AS text FROM d WHERE changes > 0")
def type_changes(spark: SparkSession, sf: str) -> DataFrame:
    changes = F.col("type_changes")
    texts = F.transform(
        changes,
        lambda c: F.concat(F.lit("Type change in '"), c["field"], F.lit("': "), c["expected_type"], F.lit(" -> "), c["actual_type"]),
    )
    drift = _drift(spark, sf).filter(F.size(changes) > 0)
    return drift.select("seq", F.size(changes).alias("changes"), F.array_join(texts, "; ").alias("text"))


@query("D5_confidence", _DRIFT + " SELECT seq, confidence_score FROM d")
def confidence(spark: SparkSession, sf: str) -> DataFrame:
    return _drift(spark, sf).select("seq", "confidence_score")


@query("D6_has_drift", _DRIFT + " SELECT seq, has_drift, renamed AND NOT has_drift AS rename_only FROM d")
def has_drift(spark: SparkSession, sf: str) -> DataFrame:
    rename_only = (F.size("renames") > 0) & ~F.col("has_drift")
    return _drift(spark, sf).select("seq", "has_drift", rename_only.alias("rename_only"))


@query("D7_warnings", _DRIFT + " SELECT seq, warnings FROM d")
def warnings(spark: SparkSession, sf: str) -> DataFrame:
    return _drift(spark, sf).select("seq", F.array_join("warnings", "; ").alias("warnings"))


@query(
    "D8_batch_drift",
    _DRIFT + """ SELECT source, array_to_string(shape, ',') AS shape, count(*) AS records, min(seq) AS first_seen, max(seq) AS last_seen,
    any_value(has_drift) AS has_drift, any_value(confidence_score) AS confidence_score, any_value(warnings) AS warnings FROM d GROUP BY source, shape""",
)
def batch_drift(spark: SparkSession, sf: str) -> DataFrame:
    shape = F.transform("actual", lambda f: F.concat(f["field"], F.lit(":"), f["type"]))
    drift = D.batch_drift(I.shapes(spark, sf), D.schema_literal(I.EXPECTED_SHAPE))
    return drift.select(
        "source", F.array_join(shape, ",").alias("shape"), "records", "first_seen", "last_seen", "has_drift",
        "confidence_score", F.array_join("warnings", "; ").alias("warnings"),
    )


@query(
    "D9_schema_registry",
    _DRIFT + """, s AS (SELECT source, shape, count(*) AS records, min(seq) AS detected_at FROM d GROUP BY source, shape)
    SELECT source, CAST(row_number() OVER (PARTITION BY source ORDER BY detected_at) AS INT) AS schema_version, detected_at, records,
    '{' || array_to_string([ '"' || replace(x, ':', '":"') || '"' FOR x IN shape ], ',') || '}' AS schema_definition,
    detected_at = max(detected_at) OVER (PARTITION BY source) AS is_active FROM s""",
)
def schema_registry(spark: SparkSession, sf: str) -> DataFrame:
    return D.schema_registry(I.shapes(spark, sf)).select(
        "source", "schema_version", "detected_at", "records", "schema_definition", "is_active"
    )


# --- rate control --------------------------------------------------------------------------------

_PER_MINUTE, _BURST = 30, 5

# The bucket of every key in whole micro-units, one request per step.
_BUCKET = cte("requests").replace("WITH ", "WITH RECURSIVE ", 1) + f""", q AS (SELECT event_id, source, is_error, epoch_us(requested_at) AS us,
        row_number() OVER (PARTITION BY source ORDER BY requested_at, event_id) AS n FROM requests),
    bucket AS (SELECT source, n, us, true AS admitted, CAST({_BURST - 1} * 60000000 AS BIGINT) AS tokens FROM q WHERE n = 1
        UNION ALL SELECT q.source, q.n, q.us,
            least({_BURST} * 60000000, b.tokens + (q.us - b.us) * {_PER_MINUTE}) >= 60000000,
            least({_BURST} * 60000000, b.tokens + (q.us - b.us) * {_PER_MINUTE})
                - CASE WHEN least({_BURST} * 60000000, b.tokens + (q.us - b.us) * {_PER_MINUTE}) >= 60000000 THEN 60000000 ELSE 0 END
        FROM bucket b JOIN q ON q.source = b.source AND q.n = b.n + 1)"""


def _admitted(spark: SparkSession, sf: str) -> DataFrame:
    requests = feed(spark, sf, "requests").select("event_id", "source", "requested_at", "is_error")
    return A.token_admission(requests, "source", "requested_at", ["event_id"], _PER_MINUTE, _BURST)


@query(
    "R1_token_bucket",
    _BUCKET + " SELECT q.event_id, q.source, admitted, round(tokens / 60000000, 6) AS tokens_left FROM bucket JOIN q USING (source, n)",
)
def token_bucket(spark: SparkSession, sf: str) -> DataFrame:
    return _admitted(spark, sf).select("event_id", "source", "admitted", F.round("tokens_left", 6).alias("tokens_left"))


@query(
    "R2_error_backoff",
    cte("requests") + """, i AS (SELECT *, count(*) FILTER (NOT is_error) OVER (PARTITION BY user_id ORDER BY requested_at, event_id) AS island FROM requests),
    n AS (SELECT event_id, user_id, count(*) FILTER (is_error) OVER (PARTITION BY user_id, island ORDER BY requested_at, event_id) AS consecutive_errors FROM i)
    SELECT *, CASE WHEN consecutive_errors = 0 THEN 0.0 ELSE least(power(2.0, consecutive_errors), 300.0) END AS backoff_seconds FROM n""",
)
def error_backoff(spark: SparkSession, sf: str) -> DataFrame:
    out = A.error_backoff(feed(spark, sf, "requests"), "user_id", ["requested_at", "event_id"], F.col("is_error"))
    return out.select("event_id", "user_id", "consecutive_errors", "backoff_seconds")


@query(
    "R3_limiter_stats",
    _BUCKET + """ SELECT source, count(*) AS requests, count_if(admitted) AS admitted, count_if(NOT admitted) AS denied, count_if(is_error) AS errors
    FROM bucket JOIN q USING (source, n) GROUP BY source""",
)
def limiter_stats(spark: SparkSession, sf: str) -> DataFrame:
    return A.limiter_stats(_admitted(spark, sf), "source", F.col("is_error"))
