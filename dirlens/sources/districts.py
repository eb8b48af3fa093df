"""District lists and page stores from files, and the tolerant reading of exported CSV."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dirlens.functions import contacts, text
from dirlens.functions.sites import any_column
from dirlens.operators.relational import merge_districts
from dirlens.schemas import DISTRICT, PAGE

#: Rows looked at, and hits needed, to find a website column by its values.
SNIFF_ROWS, SNIFF_LEAST = 500, 5


def read_export(spark: SparkSession, path: str) -> DataFrame:
    """A CSV with a header, all columns text, stripped of white space, a byte order mark and leading apostrophes."""
    rows = spark.read.csv(path, header=True, multiLine=True, quote='"', escape='"', encoding="UTF-8")
    return tidy_export(rows.toDF(*[c.lstrip("﻿").strip() for c in rows.columns]))


def tidy_export(rows: DataFrame) -> DataFrame:
    return rows.select(*[F.coalesce(F.regexp_replace(text.strip(F.col(f"`{c}`").cast("string")), "^'+", ""), F.lit("")).alias(c.strip()) for c in rows.columns])


def read_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A CSV of a known schema; empty fields are null."""
    return spark.read.csv(path, header=True, schema=schema, nullValue="", multiLine=True, quote='"', escape='"')


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """A page store in Parquet; columns it lacks are those of a page fetched without fault."""
    rows = spark.read.parquet(path)
    usual = {"status": F.lit(200), "content_type": F.lit("text/html"), "variant": F.lit("static")}
    names = [c.split()[0] for c in PAGE.split(", ")]
    return rows.select(*[F.col(c) if c in rows.columns else usual[c].alias(c) for c in names])


def website_column(rows: DataFrame) -> str | None:
    """The column named for web, url or http, else the one whose values most often look like addresses."""
    named = any_column(rows.columns, "web") or any_column(rows.columns, "url") or any_column(rows.columns, "http")
    if named is not None:
        return named
    scores = rows.limit(SNIFF_ROWS).agg(*[F.count_if(contacts.looks_like_url(F.col(f"`{c}`"))).alias(c) for c in rows.columns]).first()
    best = max(rows.columns, key=lambda c: (scores[c] or 0, -rows.columns.index(c)), default=None)
    return best if best is not None and (scores[best] or 0) >= SNIFF_LEAST else None


def load_districts(rows: DataFrame) -> DataFrame:
    """Districts with a website of an export of schools and districts in file order, by name.

    Columns are found by what their names hold. The column `ord` keeps the order of the rows, if given.
    """
    columns = [c for c in rows.columns if c != "ord"]
    name = any_column(columns, "district", "name")
    if name is None:
        raise ValueError(f"no column holds the district's name; columns: {columns}")
    number = any_column(columns, "district", "number") or any_column(columns, "district", "no") or any_column(columns, "district", "id")
    web = website_column(rows.select(*[F.col(f"`{c}`") for c in columns]))

    def value(c: str | None) -> Column:
        return F.lit("") if c is None else F.col(f"`{c}`")

    ordered = rows if "ord" in rows.columns else rows.withColumn("ord", F.monotonically_increasing_id())
    county, region = any_column(columns, "county"), any_column(columns, "region")
    picked = ordered.select(
        value(number).alias("district_number"), text.strip(value(name)).alias("district_name"), value(county).alias("county"), value(region).alias("region"),
        (contacts.website(value(web)) if web else F.lit(None).cast("string")).alias("website"), "ord",
    )
    return merge_districts(picked).select(*DISTRICT).orderBy("district_name")


def inline_targets(spark: SparkSession, targets: list[tuple[str, str]]) -> DataFrame:
    return spark.createDataFrame(targets, "district string, url string")
