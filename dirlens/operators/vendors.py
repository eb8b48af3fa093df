"""Directories of two vendors: list pages, page counts, campuses and profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dirlens.functions import contacts, names, roles, sites, text
from dirlens.html import udfs
from dirlens.operators.relational import dedupe_foxbright, keep_first


#: Letters of a shown text by which it is looked up.
GRAM = 4


def finalsite_people(pages: DataFrame) -> DataFrame:
    """Leads of vendor list pages (district, school, url, html, page): without junk gate, every card counts."""
    c = F.col
    cards = pages.select("district", "school", "url", "page", F.explode(udfs.vendor_people("html", "url")).alias("p"))
    marked, anywhere = sites.tidy_campus(text.clean(c("p.campus_marked"))), text.clean(c("p.campus_anywhere"))
    found = F.coalesce(F.when(F.length(marked).between(5, 69), marked), F.when(F.length(anywhere).between(5, 69), anywhere))
    placed = cards.withColumn("campus", sites.campus(found, c("p.photo"), c("school"))).withColumn("split", names.split_name(c("p.name")))
    role = roles.infer_role(c("p.name"), c("p.title"), c("p.email"), c("url"), F.coalesce(text.blank_to_null(c("campus")), c("district")))
    typed = placed.withColumn("inferred", role).withColumn("role", F.coalesce(text.blank_to_null(c("p.title")), c("inferred.role")))
    return typed.select(
        "district", c("campus").alias("school"), c("split.first").alias("first_name"), c("split.last").alias("last_name"), c("p.email").alias("email"), "role",
        F.lit("").alias("department"), roles.lead_type(c("role"), c("inferred.role"), c("inferred.type"), c("district"), c("campus")).alias("lead_type"),
        c("p.cid").alias("cid"), c("p.profile").alias("profile"),
        F.coalesce(text.blank_to_null(c("p.cid")), F.concat_ws("|", c("p.name"), F.coalesce(c("p.email"), F.lit("None")))).alias("key"),
        "page", c("p.pos").alias("pos"), c("url").alias("directory_url"),
    )


def new_until_repeated(people: DataFrame) -> DataFrame:
    """People by page, each key once; a directory ends before its first page without a new key."""
    first = keep_first(people, [F.col("district"), F.col("key")], ["page", "pos"])
    fresh = first.groupBy("district", "page").agg(F.count("*").alias("fresh"))
    every = people.groupBy("district", "page").agg(F.lit(1).alias("_one")).join(fresh, ["district", "page"], "left")
    stop = every.where("fresh is null").groupBy("district").agg(F.min("page").alias("stop"))
    return first.join(stop, "district", "left").where("stop is null or page < stop").drop("stop")


def page_urls(seeds: DataFrame, cap: int = 1000) -> DataFrame:
    """district, url and page of every page that the first page (district, url, html) announces."""
    counted = seeds.select("district", "url", F.explode(F.sequence(F.lit(1), sites.vendor_pages(F.col("html"), cap))).alias("page"))
    return counted.withColumn("url", F.when(F.col("page") == 1, F.col("url")).otherwise(contacts.set_page("url", "page")))


def probe_directory(seeds: DataFrame, pages: DataFrame, paths: tuple[str, ...]) -> DataFrame:
    """district, url: the first candidate with staff cards in pages (url, html), else the seed (district, seed)."""
    made = F.concat(F.array(text.blank_to_null(F.col("seed"))), F.transform(text.strings(paths), lambda p: F.concat(contacts.base_site(F.col("seed")), p)))
    candidates = seeds.select("district", "seed", F.posexplode(F.array_distinct(F.filter(made, lambda u: u.isNotNull()))).alias("pos", "url"))
    asked = pages.join(candidates.select("url").distinct(), "url", "left_semi")
    hits = candidates.join(asked.where(udfs.facts("html")["has_vendor_cards"]).select("url"), "url")
    best = hits.groupBy("district").agg(F.min_by("url", "pos").alias("found"))
    return seeds.join(best, "district", "left").select("district", F.coalesce("found", "seed").alias("url"))


def fill_profiles(people: DataFrame, pages: DataFrame, most: int = 600) -> DataFrame:
    """Missing addresses from profile pages: department is taken over, school and role only where they are empty."""
    c = F.col
    needs = c("email").isNull() & (c("profile") != "")
    place = F.row_number().over(Window.partitionBy("directory_url", needs).orderBy("page", "pos"))
    asked = people.withColumn("_asked", F.when(needs & (place <= most), c("profile")))
    found = pages.join(asked.where("_asked is not null").select(c("_asked").alias("url")).distinct(), "url", "left_semi").select(c("url").alias("_asked"), udfs.profile("html").alias("_p"))
    joined = asked.join(found, "_asked", "left")
    empty_role = F.coalesce(c("role"), F.lit("")).isin("", "Staff")
    return (
        joined.withColumn("email", F.coalesce("email", "_p.email"))
        .withColumn("school", F.coalesce(text.blank_to_null(c("school")), c("_p.location"), F.lit("")))
        .withColumn("department", F.coalesce(c("_p.department"), c("department")))
        .withColumn("role", F.when(empty_role, F.coalesce(c("_p.title"), c("role"))).otherwise(c("role")))
        .drop("_asked", "_p")
    )


def match_handles(handles: DataFrame, people: DataFrame) -> DataFrame:
    """handles (district, handle, cid, shown) with the key of the person they belong to.

    By identifier, else the first person whose name contains the text shown. The two meet by the text's first
    GRAM letters, which must stand in the name, so a large district is no product of its handles and people.
    """
    own = people.select("district", F.col("cid"), F.col("key").alias("by_id")).where("cid <> ''")
    step = handles.join(own, ["district", "cid"], "left")
    rest = step.where("by_id is null").select("district", "handle", F.lower("shown").alias("shown")).where("shown <> ''")
    named = people.select("district", "key", "page", "pos", F.lower(F.concat_ws(" ", F.coalesce("first_name", F.lit("None")), F.coalesce("last_name", F.lit("None")))).alias("full"))
    size = F.least(F.length("shown"), F.lit(GRAM))
    asked = rest.withColumn("gram", F.substring("shown", 1, GRAM)).withColumn("size", size)
    grams = F.flatten(F.transform(F.sequence(F.lit(1), F.lit(GRAM)), lambda n: F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.length("full") - n + 1)), lambda i: F.substring(F.col("full"), i, n))))
    indexed = named.withColumn("gram", F.explode(F.array_distinct(grams)))
    near = asked.join(indexed, ["district", "gram"]).where(F.contains("full", F.col("shown")))
    best = near.groupBy("district", "handle").agg(F.min_by("key", F.struct("page", "pos")).alias("by_name"))
    return step.join(best, ["district", "handle"], "left").select("district", "handle", F.coalesce("by_id", "by_name").alias("key"))


def foxbright_pages(starts: DataFrame, cap: int = 40) -> DataFrame:
    """district, url, page: the start page (district, url, html) and the pages up to cap that it links to."""
    linked = F.transform(udfs.links("html", "url"), lambda a: F.regexp_extract(a["href"], r"[?&]page=(\d+)", 1))
    numbers = F.array_sort(F.array_distinct(F.filter(F.transform(linked, lambda x: F.when(x != "", x).cast("int")), lambda n: n.between(2, cap))))
    rows = starts.select("district", "url", F.explode(F.concat(F.array(F.lit(1)), numbers)).alias("page"))
    mark = F.when(F.contains("url", F.lit("?")), "&").otherwise("?")
    return rows.select("district", F.when(F.col("page") == 1, F.col("url")).otherwise(F.concat("url", mark, F.lit("page="), F.col("page").cast("string"))).alias("url"), "page")


def foxbright_people(pages: DataFrame, details: DataFrame) -> DataFrame:
    """Leads of list pages (district, url, html, page); entries without an address look at their detail page (url, html)."""
    c = F.col
    rows = pages.select("district", "page", F.explode(udfs.foxbright_people("html", "url")).alias("p")).select("district", "page", "p.*")
    asked = rows.where("email is null and url <> ''").select("url").distinct()
    found = details.join(asked, "url", "left_semi").select("url", udfs.plain_email("html").alias("_email"))
    filled = rows.join(found, "url", "left").withColumn("email", F.coalesce("email", "_email")).withColumn("ord", F.struct("page", "pos"))
    split = names.split_plain_name(c("name"))
    once = dedupe_foxbright(filled).withColumn("split", split)
    return once.select("district", c("building").alias("school"), c("split.first").alias("first_name"), c("split.last").alias("last_name"), F.coalesce("email", F.lit("")).alias("email"), c("position").alias("role"), roles.foxbright_lead(c("position"), c("building")).alias("lead_type"))
