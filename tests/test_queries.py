"""Every query of the directory engine against its SQL."""

from __future__ import annotations

import shutil

import pytest
from compare import assert_same

from dirlens.plans import fixtures
from dirlens.plans.queries import QUERIES, SQL

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, name):
    assert_same(QUERIES[name](spark, FOLDER), SQL[name], FOLDER)


def test_fingerprint_covers_all_pages(spark):
    rows = QUERIES["page_fingerprint"](spark, FOLDER).collect()
    assert len(rows) == spark.read.parquet(f"{FOLDER}/pages.parquet").count()
    assert {r["dir_style"] for r in rows} == {"js_or_empty"}


@pytest.mark.parametrize("name", ["page_fingerprint", "dir_style_counts"])
def test_fingerprint_of_staff_pages(spark, tmp_path, name):
    """The given pages hold no staff; those of the fixtures do, in tables, cards and lists of addresses."""
    rows = [(i, url, html) for i, (url, html) in enumerate(fixtures.PAGES.items())]
    spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1).write.parquet(str(tmp_path / "all"))
    next((tmp_path / "all").glob("*.parquet")).rename(tmp_path / "pages.parquet")
    shutil.rmtree(tmp_path / "all")
    assert_same(QUERIES[name](spark, str(tmp_path)), SQL[name], str(tmp_path))


def test_export_is_in_order(spark):
    from dirlens.operators import relational
    from dirlens.plans.queries import typed_leads

    rows = [tuple(r) for r in relational.sorted_leads(typed_leads(spark, FOLDER)).collect()]
    key = [(r[6], r[1], r[3], r[2]) for r in rows]
    assert key == sorted(key)
