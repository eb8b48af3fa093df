"""Sources, sinks and the stream."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import functions as F

from dirlens.operators import crawl
from dirlens.plans import fixtures, pipelines
from dirlens.sources import districts, sinks
from dirlens.streaming import arrivals

LEADS = "district string, school string, first_name string, last_name string, email string, role string, lead_type string, ord int"


def test_export_round_trip(spark, tmp_path: Path):
    body = ",".join(fixtures.EXPORT_HEADERS) + "\n" + "\n".join(",".join(f'"{x}"' for x in r) for r in fixtures.EXPORT)
    (tmp_path / "d.csv").write_text("﻿" + body, encoding="utf-8")
    found = [tuple(r) for r in districts.load_districts(districts.read_export(spark, str(tmp_path / "d.csv"))).collect()]
    assert sorted(found) == sorted(fixtures.EXPECT_DISTRICTS)
    assert [r[1] for r in found] == sorted(r[1] for r in found)


def test_website_column_by_values(spark):
    rows = spark.createDataFrame([("D", f"s{i}.example.org", "x.y") for i in range(5)], "`District Name` string, `Home` string, z string")
    assert districts.website_column(rows) == "Home"
    assert districts.website_column(rows.limit(4)) is None


def test_lead_files(spark, tmp_path: Path):
    leads = spark.createDataFrame([("D", "S", "A", "B", None, "Principal", "School", 0), ("D", None, "C", "D", "c@x.example.org", "Clerk", "Other", 1)], LEADS)
    sinks.write_leads(leads, str(tmp_path / "out"))
    assert sorted(p.name for p in (tmp_path / "out").iterdir()) == ["all_leads", "leads_other", "leads_school"]
    back = spark.read.csv(str(tmp_path / "out/all_leads"), header=True)
    assert back.columns == ["District", "School", "First Name", "Last Name", "Email", "Role", "Lead Type"] and back.count() == 2
    sinks.write_partitioned(leads, str(tmp_path / "parquet"))
    assert spark.read.parquet(str(tmp_path / "parquet")).count() == 2
    sinks.write_single_csv(leads.drop("ord"), str(tmp_path / "one.csv"))
    assert (tmp_path / "one.csv").read_bytes().startswith(b"\xef\xbb\xbfdistrict")
    assert set(sinks.workbook(leads, spark.createDataFrame([("S", ["a", "b"])], "name string, directory_urls array<string>"))) == {"Summary", "All Leads", "School", "Other", "Schools"}
    assert sinks.safe_name("Oak / ISD!") == "Oak__ISD" and sinks.safe_name("!") == "output"


def test_robots_and_variants(spark):
    store = spark.createDataFrame([("u", "s", 200, "text/html", "static"), ("u", "r", 200, "text/html", "rendered"), ("v", "x", 404, "text/html", "static")], "url string, html string, status int, content_type string, variant string")
    assert [tuple(r) for r in crawl.fetched(store).collect()] == [("u", "r")]
    urls = spark.createDataFrame([("https://a.example.org/x/1",), ("https://a.example.org/y",), ("https://b.example.org/x/1",)], "url string")
    rules = spark.createDataFrame([("a.example.org", ["/x/"])], "host string, disallow array<string>")
    assert sorted(r[0] for r in crawl.allowed(urls, rules).collect()) == ["https://a.example.org/y", "https://b.example.org/x/1"]


def test_resolve_profile_and_merge(spark):
    from dirlens.plans.queries import store

    listed = spark.createDataFrame([("", d, "", "", w) for d, w in fixtures.DISTRICTS], "district_number string, district_name string, county string, region string, website string")
    links = pipelines.resolve(listed, store(spark))
    assert {r["district_name"]: r["method"] for r in links.collect()} == {"Oak": "path", "Elm": "crawl", "Gone": "none"}
    styles = {r["district_name"]: (r["dir_style"], r["notes"]) for r in pipelines.profile(links, store(spark)).collect()}
    assert styles["Oak"][1] == "" and styles["Elm"][1] == ""
    merged, gaps = pipelines.merge([spark.createDataFrame([("D", "S", "A", "B", " A@x.example.org", "r", "Other", 0)], LEADS)])
    assert merged.first()["email"] == "a@x.example.org" and gaps.first()["staff"] == 1


def test_stream_of_pages(spark, tmp_path: Path):
    kind = "district string, school string, school_url string, url string, html string, ord int, scraped_at timestamp"
    page = fixtures.PAGES["https://fir.example.org/people/mailto"]
    rows = spark.createDataFrame([("D", "S", "", f"https://fir.example.org/{i}", page, i) for i in range(3)], kind.rsplit(",", 1)[0]).withColumn("scraped_at", F.lit("2024-01-01 10:00:00").cast("timestamp"))
    rows.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(kind).parquet(str(tmp_path / "in"))
    first = arrivals.first_seen(arrivals.people(stream)).writeStream.format("memory").queryName("first_seen").outputMode("append").start()
    first.processAllAvailable()
    first.stop()
    assert spark.table("first_seen").count() == 2
    out = arrivals.people(stream).writeStream.foreachBatch(arrivals.write_batches(str(tmp_path / "out"))).option("checkpointLocation", str(tmp_path / "cp")).start()
    out.processAllAvailable()
    out.stop()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2
    assert arrivals.run_so_far(spark.read.parquet(str(tmp_path / "out"))).count() == 2
    counts = arrivals.yields(arrivals.people(stream)).writeStream.format("memory").queryName("yields").outputMode("complete").start()
    counts.processAllAvailable()
    counts.stop()
    assert [r["n_rows"] for r in spark.table("yields").collect()] == [6]


def test_run_of_batches_keeps_the_first_and_fills_addresses(spark):
    rows = [(0, 1, "D", "S", "Ann Lee", "Clerk", None), (1, 0, "D", "S", "Ann Lee", "Clerk", "a@x.example.org"), (1, 1, "D", "S", "Bo Kim", "Clerk", None), (2, 0, "D", "S", "ann lee", "Clerk", "b@x.example.org"), (2, 1, "D", "T", "Ann Lee", "Clerk", None)]
    found = arrivals.run_so_far(spark.createDataFrame(rows, "batch int, ord int, district string, school string, name string, title string, email string"))
    assert sorted((r["school"], r["name"], r["email"] or "") for r in found.collect()) == [("S", "Ann Lee", "a@x.example.org"), ("S", "Bo Kim", ""), ("S", "ann lee", "b@x.example.org"), ("T", "Ann Lee", "")]


def test_known_address_counts_if_found(spark):
    pages = spark.createDataFrame([], "url string, html string")
    rows = [("A", "https://a.example.org", "https://a.example.org/staff", "found"), ("B", "https://b.example.org", "https://b.example.org/staff", "not_found")]
    found = crawl.fan_out(spark.createDataFrame(rows, "district string, website string, known_url string, status string"), pages)
    assert {r["district"]: r["url"] for r in found.collect()} == {"A": "https://a.example.org/staff", "B": "https://b.example.org"}


def test_small_readers_and_frames(spark, tmp_path: Path):
    """read_table, read_pages, inline_targets, merge_hits, wide, employee_type_counts, email_domain's kin and head."""
    from dirlens.operators import extract, relational

    (tmp_path / "t.csv").write_text("a,b\n1,\n2,x\n")
    assert [tuple(r) for r in districts.read_table(spark, str(tmp_path / "t.csv"), "a int, b string").collect()] == [(1, None), (2, "x")]
    spark.createDataFrame([("u", "<p>")], "url string, html string").write.parquet(str(tmp_path / "p"))
    assert tuple(districts.read_pages(spark, str(tmp_path / "p")).first()) == ("u", "<p>", 200, "text/html", "static")
    assert [tuple(r) for r in districts.inline_targets(spark, [("D", "u")]).collect()] == [("D", "u")]
    hits = spark.createDataFrame([("u", "e", 1, 0, "late"), ("u", "e", 0, 5, "first"), ("v", "e", 1, 0, "other")], "url string, email string, state int, pos int, name string")
    assert sorted(r["name"] for r in extract.merge_hits(hits).collect()) == ["first", "other"]
    people = spark.createDataFrame([("D", "S", "A B", ["x", "y"], "Teacher")], "district string, school string, name string, subjects array<string>, employee_type string").withColumn("scraped_at", F.lit("2024-01-02 03:04:05").cast("timestamp"))
    row = extract.wide(people).first()
    assert len(row) == 22 and row["subjects"] == "x; y" and row["scraped_at"] == "2024-01-02T03:04:05+00:00" and row["room"] is None
    assert sum(r["n"] for r in relational.employee_type_counts(people.withColumn("employee_type", F.lit(relational.TYPES[0]))).collect()) == 1
    numbers = spark.range(10)
    assert [r[0] for r in relational.head(numbers, 3, ["id"]).collect()] == [0, 1, 2] and relational.head(numbers, 0, ["id"]).count() == 10
    assert sorted(r[0] for r in relational.exact_sample(spark.range(5000), 0.1, "id").collect()) == sorted(sorted(range(5000), key=dict((r[0], r[1]) for r in spark.range(5000).select("id", F.xxhash64("id", F.lit(42))).collect()).get)[:500])
