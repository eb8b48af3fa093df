"""What a run keeps of its executors' Python: the workers of a task, and what stands as Python objects in one."""

from __future__ import annotations

import tracemalloc

import pyarrow as pa
from pyspark.sql import functions as F

from dirlens.functions import contacts
from dirlens.html import pages, udfs
from dirlens.plans import fixtures, queries


def python_nodes(df) -> int:
    return df._jdf.queryExecution().sparkPlan().toString().count("EvalPython")


def test_joined_addresses_are_made_once(spark):
    sites = spark.range(3).select(F.concat(F.lit("https://a.example.org/"), "id").alias("website"))
    made = sites.select(contacts.url_join("website", F.lit("/x")).alias("url"))
    assert python_nodes(made.join(spark.range(3).select(F.concat(F.lit("https://a.example.org/x"), "id").alias("url")), "url")) == 1


def test_written_out_rows_need_no_python(spark):
    for df in (queries.store(spark), queries.values(spark, fixtures.KNOWN, "district string, website string, known_url string")):
        assert "RDD" not in df._jdf.queryExecution().sparkPlan().toString()
    assert [r["url"] for r in queries.store(spark).collect()] == list(fixtures.PAGES)
    assert [tuple(r) for r in queries.values(spark, fixtures.KNOWN, "district string, website string, known_url string").collect()] == list(fixtures.KNOWN)


def test_records_of_a_batch_stand_in_pieces(spark, monkeypatch):
    page = '<a href="/a">one</a><a href="b?c">two</a>' * 20 + "x" * 8_000
    html = [page] * 1_500 + [None, "", "<a href='/c'>" + "y" * 400_000, page]
    batch, urls = pa.array(html), pa.array([f"https://{i}.example.org/" for i in range(len(html))])
    monkeypatch.setattr(udfs.F, "arrow_udf", lambda f, kind: lambda *columns: f)
    read = udfs.links("html", "url")
    tracemalloc.start()
    found = read(batch, urls)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 8_000_000
    assert found.slice(1_498).to_pylist() == [pages.links(h, u) for h, u in zip(html[1_498:], urls.to_pylist()[1_498:], strict=True)]
    assert len(found) == len(html) and len(read(batch[:0], urls[:0])) == 0
    assert read(batch[1_499:1_503], urls[1_499:1_503]).equals(found[1_499:1_503])
