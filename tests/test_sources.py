import hashlib

from pyspark.sql import functions as F

from recordloom.operators.validate import accepted, rejected
from recordloom.sources import csv_feed as S
from recordloom.sources.news_feed import read_news, unreadable_items
from recordloom.sources.registry import SOURCES

COLUMNS = ["product_id", "name", "category", "price"]


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_csv_values(spark, tmp_path):
    path = write(tmp_path / "p.csv", 'product_id,name,category,price\nP1,"A, ""b""",,10\nP2,short\n\nP3,n,c,1,extra\nP4, pad ,c,2\n')
    rows = S.read_csv(spark, path, COLUMNS).orderBy("_row_number").collect()
    assert [tuple(r)[:4] for r in rows] == [("P1", 'A, "b"', "", "10"), ("P2", "short", None, None), ("P3", "n", "c", "1"), ("P4", " pad ", "c", "2")]
    assert [r._row_number for r in rows] == [1, 2, 3, 4] and {r._file_name for r in rows} == {"p.csv"}
    checked = SOURCES["csv"].validate(S.read_csv(spark, path, COLUMNS))
    assert {r.product_id for r in accepted(checked).collect()} == {"P1", "P4"}
    reasons = {r.product_id: r.error for r in rejected(checked).collect()}
    assert reasons["P3"] == "record: more fields than the header" and "category: required" in reasons["P2"]


def test_row_numbers_over_many_splits(spark, tmp_path):
    for name, n in (("a.csv", 3000), ("b.csv", 10)):
        write(tmp_path / name, "product_id,name,category,price\n" + "".join(f"P{i},n{i},c,{i}\n" for i in range(1, n + 1)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        rows = S.read_csv(spark, str(tmp_path), COLUMNS)
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 1
        wrong = rows.filter(F.concat(F.lit("P"), F.col("_row_number").cast("string")) != F.col("product_id"))
        assert wrong.count() == 0 and rows.count() == 3010
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_columns_go_by_header_name(spark, tmp_path):
    write(tmp_path / "a.csv", "name,colour,product_id\nn1,red,P1\nn2,,P2\n")
    write(tmp_path / "b.csv", "product_id,name,category,price\nP3,n3,c3,3\n")
    rows = {r.product_id: r for r in S.read_csv(spark, str(tmp_path), COLUMNS).collect()}
    assert [(r.name, r.category, r.price, r.colour, r._row_number, r._extra_fields) for r in (rows["P1"], rows["P2"], rows["P3"])] == [
        ("n1", None, None, "red", 1, False), ("n2", None, None, "", 2, False), ("n3", "c3", "3", None, 1, False)
    ]


def test_a_missing_file_has_no_rows(spark, tmp_path):
    gone = str(tmp_path / "gone.csv")
    assert S.read_csv(spark, gone, COLUMNS).collect() == [] and S.content_fingerprints(spark, gone).collect() == []


def test_line_breaks_in_quotes(spark, tmp_path):
    path = write(tmp_path / "m.csv", 'product_id,name,category,price\nP1,"two\nlines",c,1\nP2,n,c,2\n')
    rows = S.read_csv(spark, path, COLUMNS, multi_line=True).orderBy("_row_number").collect()
    assert [(r._row_number, r.name) for r in rows] == [(1, "two\nlines"), (2, "n")]


def test_fingerprints(spark, tmp_path):
    path = write(tmp_path / "f.csv", "x\n1\n2\n")
    assert S.file_fingerprints(spark, path).first().fingerprint == hashlib.md5(b"x\n1\n2\n").hexdigest()
    before = S.content_fingerprints(spark, path).first()
    write(tmp_path / "f.csv", "x\n1\n2\n2\n")
    after = S.content_fingerprints(spark, path).first()
    assert (before.lines, after.lines) == (3, 4) and before.fingerprint != after.fingerprint


def test_resume(spark):
    files = spark.createDataFrame([("a", "h1"), ("b", "h2"), ("c", "h3"), ("d", "h4")], "file string, fingerprint string")
    cps = spark.createDataFrame([("a", "1|h1"), ("b", "5|old"), ("c", "bad|h3")], "file string, last_value string")
    points = S.resume_points(files, cps)
    assert {r.file: r.start_row for r in points.collect()} == {"a": 1, "b": 0, "c": 0, "d": 0}
    rows = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], "_file_path string, _row_number int")
    assert sorted(tuple(r) for r in S.rows_after(rows, points).collect()) == [("a", 2), ("b", 1)]


RSS = """<?xml version="1.0"?>
<rss version="2.0" xmlns:content="http://purl.org/rss/1.0/modules/content/"><channel><title>Feed</title>
<item><guid>g1</guid><title>One &amp; two</title><link>http://x/1</link><description>sum</description>
<content:encoded><![CDATA[<p>full</p>]]></content:encoded><pubDate>Mon, 01 Jan 2024 12:00:00 GMT</pubDate><category>a</category><category>b</category></item>
<item><title>Two</title><link>http://x/2</link><description>only</description></item></channel></rss>"""


def test_news(spark, tmp_path):
    write(tmp_path / "a.xml", RSS)
    one, two = read_news(spark, str(tmp_path)).orderBy("link").collect()
    assert (one.id, one.title, one.content, one.tags) == ("g1", "One & two", "<p>full</p>", ["a", "b"])
    assert (two.id, two.content, two.tags, two.author) == ("http://x/2", "only", [], "")
    assert two._feed_url.endswith("a.xml") and one._feed_title == "Feed"


ATOM = """<?xml version="1.0"?>
<feed xmlns="http://www.w3.org/2005/Atom"><title>Notes &amp; more</title>
<entry><id>urn:1</id><title>First</title><link rel="self" href="http://y/api/1"/><link href="http://y/1"/><author><name>Ann</name></author>
<summary>short</summary><content>long</content><published>2024-02-03T04:05:06Z</published><updated>2024-02-04T00:00:00Z</updated>
<category term="red"/><category term="blue"/></entry></feed>"""


def test_atom_creators_and_broken_items(spark, tmp_path):
    write(tmp_path / "a.xml", ATOM)
    write(tmp_path / "b.xml", RSS.replace("<link>http://x/2</link>", "<link>http://x/2</link><dc:creator>Bo</dc:creator>"))
    write(tmp_path / "c.xml", "<rss><channel><title>Broken</title>\n<item><title>no end</titel></item></channel></rss>")
    rows = {r.link: r for r in read_news(spark, str(tmp_path)).collect()}
    one = rows["http://y/1"]
    assert (one.id, one.title, one.author, one.summary, one.content, one.tags) == ("urn:1", "First", "Ann", "short", "long", ["red", "blue"])
    assert (one._feed_title, one.published, one.updated) == ("Notes & more", "2024-02-03T04:05:06Z", "2024-02-04T00:00:00Z")
    assert rows["http://x/2"].author == "Bo" and set(rows) == {"http://y/1", "http://x/1", "http://x/2"}
    broken = unreadable_items(spark, str(tmp_path)).collect()
    assert {r.feed_url.rsplit("/", 1)[1] for r in broken} == {"c.xml"} and all(r.error.startswith("record: not well-formed") for r in broken)


def test_a_changed_text_of_equal_length_changes_its_file_alone(spark, tmp_path):
    from workload.registry import QUERIES

    import workload.ingest_queries  # noqa: F401

    seen = []
    for k, text in enumerate(("a\nb\\n", "a\\n\nb")):
        rows = [(1, text, None, "s", 5), (2, "other", "en", "s", 5), (3, None, "en", "s", 0)]
        spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/{k}/documents.parquet")
        seen.append({r.file: r.fingerprint for r in QUERIES["S9_text_fingerprints"](spark, f"{tmp_path}/{k}").collect()})
    assert seen[0].keys() == {"0", "1", "2", "whole"}
    assert {f for f in seen[0] if seen[0][f] != seen[1][f]} == {"1", "whole"}


def test_files_of_one_name_are_different_files(spark, tmp_path):
    for folder, n in (("x", 5), ("y", 3)):
        (tmp_path / folder).mkdir()
        write(tmp_path / folder / "p.csv", "product_id,name,category,price\n" + "".join(f"{folder}{i},n,c,{i}\n" for i in range(1, n + 1)))
    rows = S.read_csv(spark, [str(tmp_path / "x"), str(tmp_path / "y")], COLUMNS).collect()
    assert sorted((r._file_path.split("/")[-2], r._row_number, r.product_id) for r in rows) == [("x", i, f"x{i}") for i in range(1, 6)] + [("y", i, f"y{i}") for i in range(1, 4)]
    assert {r._file_name for r in rows} == {"p.csv"}


def test_fingerprint_sees_the_order_of_lines_and_not_the_splits(spark, tmp_path):
    lines = [f"line {i} " + "x" * (i % 40) for i in range(3000)]
    write(tmp_path / "a.txt", "\n".join(lines) + "\n")
    swapped = [lines[1], lines[0], *lines[2:]]
    write(tmp_path / "b.txt", "\n".join(swapped) + "\n")
    write(tmp_path / "c.txt", "\r\n".join(lines) + "\r\n")

    def prints():
        return {r.file.rsplit("/", 1)[1]: (r.lines, r.fingerprint) for r in S.content_fingerprints(spark, str(tmp_path)).collect()}

    whole = prints()
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 8
        assert prints() == whole
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert {n for n, _ in whole.values()} == {3000} and len({f for _, f in whole.values()}) == 3


def test_powers(spark):
    exponents = [0, 1, 63, 64, 12345, (1 << 33) - 1, (1 << 36) - 1]
    df = spark.createDataFrame([(e,) for e in exponents], "e long").select(*[S.power(b, F.col("e")) for b in S.BASES])
    assert [tuple(r) for r in df.collect()] == [tuple(pow(b, e, S.PRIME) for b in S.BASES) for e in exponents]


def test_parts_of_a_folder_are_one_file(spark, tmp_path):
    lines = [f"{k}|{'x' * (k % 7)}" for k in range(50)]
    (tmp_path / "whole").mkdir()
    (tmp_path / "whole" / "a").write_text("\n".join(lines) + "\n")
    (tmp_path / "cut").mkdir()
    for part, (low, high) in enumerate(((0, 7), (7, 30), (30, 50))):
        (tmp_path / "cut" / f"part-{part}").write_text("\n".join(lines[low:high]) + "\n")
    whole, cut = (S.content_fingerprints(spark, str(tmp_path / n), parts=True).collect() for n in ("whole", "cut"))
    assert [(r.lines, r.fingerprint) for r in whole] == [(r.lines, r.fingerprint) for r in cut] and len(cut) == 1
    assert cut[0].file.endswith("/cut")


def test_texts_land_in_parts(spark, tmp_path):
    """A file of the documents is written by several tasks, whole lines of all rows, nulls and copies included."""
    from pathlib import Path

    from workload.ingest_queries import _landed_texts

    rows = [(k % 90 if k % 11 else None, f"text {k % 70}\nmore", "en", "s", k) for k in range(400)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(setting, "false")
    try:
        landed = Path(_landed_texts(spark, str(tmp_path)).removeprefix("file:"))
    finally:
        spark.conf.unset(setting)
    parts = sorted(landed.glob("file=*/*.txt"))
    assert len(parts) > 3 and sum(len(p.read_text().splitlines()) for p in parts) == 400
    for folder in landed.glob("file=*"):
        ids = [int(line.split("|")[0] or -1) for p in sorted(folder.glob("*.txt")) for line in p.read_text().splitlines()]
        assert ids == sorted(ids)


def test_each_folder_of_products_lands_by_a_task_of_its_own(spark):
    from pathlib import Path

    from workload.ingest_queries import _FOLDERS, _landed_products

    landed = Path(_landed_products(spark, "/root/testdata/sf0.001").removeprefix("file:"))
    files = list(landed.glob("folder=*/*.csv"))
    assert len(files) == _FOLDERS == len({f.name.split("-")[1] for f in files})
