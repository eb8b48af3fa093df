"""Page-graph traversal over a page store: schools, sitemaps, directories, fan-out, pagination.

Fetching is a join on url with the page store (url, html, status, content_type, variant). Depth is
always bounded, so traversals unroll into joins; each keeps the order in which links stand.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dirlens.functions import contacts, sites, text, words
from dirlens.html import udfs
from dirlens.operators.lineage import cut
from dirlens.operators.relational import capped, keep_first


def fetched(store: DataFrame) -> DataFrame:
    """url, html of what counts as fetched; a rendered variant goes before a static one."""
    rows = store.where(sites.is_fetched(F.col("status"), F.col("content_type")))
    rank = F.when(F.col("variant") == "rendered", 0).when(F.col("variant") == "static", 1).otherwise(2)
    return keep_first(rows.withColumn("_v", rank), [F.col("url")], ["_v"]).select("url", "html")


def allowed(rows: DataFrame, robots: DataFrame) -> DataFrame:
    """rows (url) whose path no rule of their host in robots (host, disallow array) forbids; no rules allow all."""
    path = F.concat(F.lit("/"), F.regexp_replace("url", r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/?", ""))
    known = rows.withColumn("_host", contacts.host(F.col("url"))).join(robots.withColumnRenamed("host", "_host"), "_host", "left")
    stopped = F.exists("disallow", lambda rule: (rule != "") & F.startswith(path, rule))
    return known.where(~F.coalesce(stopped, F.lit(False))).drop("_host", "disallow")


def page_links(pages: DataFrame) -> DataFrame:
    """pages (url, html, ...) as one row a link: pos, href, text, target."""
    rest = [c for c in pages.columns if c != "html"]
    return pages.select(*rest, F.explode(udfs.links("html", "url")).alias("a")).select(*rest, "a.pos", "a.href", F.col("a.text").alias("text"), F.col("a.url").alias("target"))


def _site_root(url: Column) -> Column:
    """scheme://host for an address without a path, else the address."""
    bare = F.rlike(url, F.lit(r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/?(?:[?#].*)?$"))
    return F.when(bare, F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)).otherwise(url)


def linked_schools(homes: DataFrame) -> DataFrame:
    """district, website, url, name, pos of schools that homepages (district, website, html) link to."""
    c = F.col
    links = page_links(homes.withColumn("url", c("website")))
    low = F.lower("text")
    school = text.any_of(low, words.SCHOOL_WORDS) | F.rlike(F.lower("href"), F.lit(words.SCHOOL_LINKS))
    good = links.where(F.length("text").between(3, 100) & ~text.any_of(low, words.SKIPPED_LINKS) & school)
    good = good.where(~text.ends_with_any(F.lower("target"), words.SKIPPED_ENDINGS) & contacts.same_site(c("target"), c("website")))
    named = good.select("district", "website", _site_root(c("target")).alias("url"), c("text").alias("name"), "pos")
    return keep_first(named, [c("district"), c("url")], ["pos"])


def _title(c: Column) -> Column:
    """Each run of letters capitalised."""
    return F.array_join(F.transform(F.regexp_extract_all(c, F.lit(r"[A-Za-z]+|[^A-Za-z]+"), 0), lambda x: F.initcap(x)), "")


def sitemap_schools(districts: DataFrame, pages: DataFrame) -> DataFrame:
    """The same columns from /sitemap.xml in pages (url, html), sitemap indexes one level deep; nested maps first."""
    c = F.col
    roots = districts.select("district", "website", contacts.url_join("website", F.lit("/sitemap.xml")).alias("map"), F.lit(1).alias("level"), F.lit(0).alias("at"))

    def entries(maps: DataFrame) -> DataFrame:
        # only the pages asked for are read
        asked = pages.withColumnRenamed("url", "map").join(maps.select("map").distinct(), "map", "left_semi")
        return maps.join(asked.select("map", udfs.sitemap("html").alias("entries")), "map").select("district", "website", "level", "at", F.explode("entries").alias("e"))

    top = entries(roots)
    nested = entries(top.where("e.kind = 'sitemap'").select("district", "website", c("e.url").alias("map"), F.lit(0).alias("level"), c("e.pos").alias("at")))
    found = top.unionByName(nested).where("e.kind = 'url'").select("district", "website", "level", "at", c("e.url").alias("url"), c("e.pos").alias("p"))
    path = F.regexp_replace(F.regexp_replace("url", r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*", ""), r"[?#].*$", "")
    last = F.element_at(F.filter(F.split(path, "/"), lambda s: s != ""), -1)
    good = found.where(contacts.same_site(c("url"), c("website")) & F.rlike(F.lower("url"), F.lit(words.SCHOOL_LINKS)) & (F.size(F.filter(F.split(path, "/"), lambda s: s != "")) > 0))
    named = good.withColumn("name", _title(F.translate(last, "-_", "  "))).where(F.length("name") > 3)
    once = keep_first(named, [c("district"), c("url")], ["level", "at", "p"])
    return once.select("district", "website", "url", "name", (c("level") * 1_000_000_000 + c("at") * 100_000 + c("p")).alias("pos"))


def discover_schools(districts: DataFrame, pages: DataFrame) -> DataFrame:
    """Schools of districts (district, website): homepage links in order, then those of sitemaps."""
    homes = districts.join(pages.withColumnRenamed("url", "website"), "website")
    linked = linked_schools(homes).withColumn("source", F.lit(0))
    mapped = sitemap_schools(districts, pages).withColumn("source", F.lit(1))
    return keep_first(linked.unionByName(mapped), [F.col("district"), F.col("url")], ["source", "pos"])


def _directory_links(links: DataFrame, site: str) -> DataFrame:
    c = F.col
    useful = ~F.startswith("href", F.lit("#")) & ~F.startswith("href", F.lit("javascript")) & (c("href") != "")
    named = text.any_of(F.lower("text"), words.DIRECTORY_WORDS) | text.any_of(F.lower("href"), words.DIRECTORY_WORDS)
    return links.where(useful & named & ~text.ends_with_any(F.lower("target"), words.SKIPPED_ENDINGS) & contacts.same_site(c("target"), c(site)))


def find_directories(schools: DataFrame, pages: DataFrame, most: int = 8) -> DataFrame:
    """school_id, url, rank of the directories of schools (school_id, school_url), two levels deep, first `most` in order.

    Order is that of a depth-first walk: a page that lists people, then each of its links with what that
    page adds. A page is walked once, from the place that reaches it first.
    """
    c = F.col
    store = pages.select("url", "html")
    first = schools.join(store.withColumnRenamed("url", "school_url"), "school_url").withColumn("url", c("school_url")).withColumn("here", udfs.facts("html")["is_directory"])
    start = first.where("here").select("school_id", "url", F.lit(-1).alias("i"), F.lit(-1).alias("j"))
    links = _directory_links(page_links(first.select("school_id", "school_url", "url", "html")), "school_url").select("school_id", "school_url", c("target").alias("url"), c("pos").alias("i"))
    level1 = links.select("school_id", "url", "i", F.lit(-2).alias("j"))
    walked = keep_first(links, [c("school_id"), c("url")], ["i"]).where("url <> school_url").join(store, "url")
    below = _directory_links(page_links(walked), "school_url").select("school_id", c("target").alias("url"), "i", c("pos").alias("j"))
    order = F.min(F.struct("i", "j")).alias("place")
    found = start.unionByName(level1).unionByName(below).groupBy("school_id", "url").agg(order)
    kept = capped(found, ["school_id"], most, ["place"])
    return kept.select("school_id", "url", F.row_number().over(Window.partitionBy("school_id").orderBy("place")).alias("rank"))


def probe_paths(districts: DataFrame, pages: DataFrame) -> DataFrame:
    """district, url: the first common path of the website whose page lists people."""
    paths = F.posexplode(text.strings(words.DIRECTORY_PATHS))
    made = districts.select("district", "website", paths.alias("pos", "path")).withColumn("url", contacts.url_join("website", "path"))
    asked = pages.join(made.select("url").distinct(), "url", "left_semi")
    hits = made.join(asked.where(udfs.facts("html")["is_directory"]).select("url"), "url")
    return hits.groupBy("district").agg(F.min_by("url", "pos").alias("url"))


def resolve_directories(districts: DataFrame, pages: DataFrame, most: int = 6) -> DataFrame:
    """districts (district, website) with staff_directory_url, method (path, crawl, none) and status."""
    probed = probe_paths(districts, pages).withColumnRenamed("url", "path_url")
    rest = districts.join(probed, "district", "left_anti")
    found = find_directories(rest.select(F.col("district").alias("school_id"), F.col("website").alias("school_url")), pages, most)
    low = F.lower("url")
    score = 2 * F.contains(low, F.lit("staff")).cast("int") + 2 * F.contains(low, F.lit("directory")).cast("int") + F.contains(low, F.lit("faculty")).cast("int")
    best = found.groupBy(F.col("school_id").alias("district")).agg(F.max_by("url", F.struct(score, -F.col("rank"))).alias("crawl_url"))
    joined = districts.join(probed, "district", "left").join(best, "district", "left")
    url = F.coalesce("path_url", "crawl_url")
    method = F.when(F.col("path_url").isNotNull(), "path").when(F.col("crawl_url").isNotNull(), "crawl").otherwise("none")
    return joined.select("district", "website", F.coalesce(url, F.lit("")).alias("staff_directory_url"), method.alias("method"), F.when(url.isNull(), "not_found").otherwise("found").alias("status"))


def fan_out(districts: DataFrame, pages: DataFrame, most_schools: int = 25, most_directories: int = 8) -> DataFrame:
    """district, school, school_url, url, ord of every directory of districts (district, website, known_url) and their campuses.

    Where districts have a status, a known address counts only if that is `found`. A campus that is the district again is left out; a directory counts for the first target that has it.
    """
    c = F.col
    campuses = capped(discover_schools(districts.select("district", "website"), pages), ["district"], most_schools, ["source", "pos"])
    same = (contacts.host(c("url")) == contacts.host(c("website"))) & (c("name") == c("district"))
    targets = campuses.where(~same).select("district", c("name").alias("school"), c("url").alias("school_url"), F.lit(None).cast("string").alias("known_url"), (c("source") + 1).alias("s"), "pos")
    known = F.when(c("status") == "found", c("known_url")) if "status" in districts.columns else c("known_url")
    whole = districts.select("district", c("district").alias("school"), c("website").alias("school_url"), known.alias("known_url"), F.lit(0).alias("s"), F.lit(0).alias("pos"))
    every = whole.unionByName(targets).withColumn("school_id", F.concat_ws("\u0001", "district", "school", "school_url"))
    found = find_directories(every.where("known_url is null").select("school_id", "school_url").distinct(), pages, most_directories)
    rows = every.join(found, "school_id", "left").select("district", "school", "school_url", F.coalesce("known_url", "url", "school_url").alias("url"), "s", "pos", F.coalesce("rank", F.lit(1)).alias("rank"))
    return keep_first(rows, [c("district"), c("url")], ["s", "pos", "rank"]).select("district", "school", "school_url", "url", F.struct("s", "pos", "rank").alias("ord"))


def campus_targets(gaps: DataFrame, pages: DataFrame) -> DataFrame:
    """district_name "district — school", staff_directory_url and cms of the schools of gaps (district, website)."""
    good = gaps.where(F.coalesce(text.strip(F.col("website")), F.lit("")) != "")
    full = F.when(F.startswith(F.lower("website"), F.lit("http")), F.col("website")).otherwise(F.concat(F.lit("https://"), F.col("website")))
    found = discover_schools(good.select("district", full.alias("website")).distinct(), pages)
    return found.where("url <> ''").select(F.concat("district", F.lit(" — "), "name").alias("district_name"), F.col("url").alias("staff_directory_url"), F.lit("finalsite").alias("cms"))


def follow_pages(starts: DataFrame, pages: DataFrame, most: int = 25) -> DataFrame:
    """id, url, page of starts (id, url) and the pages that follow by next links, each once, at most `most`.

    One join a page of depth: only the pages that are reached are read. An address not in pages ends a walk.
    """
    walk = starts.select("id", "url", F.array("url").alias("seen"))
    reached = []
    for page in range(1, most + 1):
        here = walk.join(pages.select("url", "html"), "url")
        onward = F.lit(None).cast("string") if page == most else udfs.directory("html", "url")["next_url"]
        read = cut(here.select("id", "url", "seen", onward.alias("next")))
        reached.append(read.select("id", "url", F.lit(page).alias("page")))
        walk = read.where(F.col("next").isNotNull() & ~F.array_contains("seen", F.col("next"))).select("id", F.col("next").alias("url"), F.array_append("seen", F.col("next")).alias("seen"))
        if page == most or walk.isEmpty():
            break
    return reduce(DataFrame.unionAll, reached)
