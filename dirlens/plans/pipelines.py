"""The runs that a user starts, each as one plan over a district list and a page store."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dirlens.functions import words
from dirlens.operators import crawl, extract, relational, vendors
from dirlens.operators.lineage import cut


def _pages(store: DataFrame, robots: DataFrame | None) -> DataFrame:
    """The fetched pages of a store, without those that robots (host, disallow) forbids."""
    pages = crawl.fetched(store)
    return pages if robots is None else crawl.allowed(pages, robots)


def resolve(districts: DataFrame, store: DataFrame, sample: float | None = None, limit: int = 0, robots: DataFrame | None = None) -> DataFrame:
    """District list to directory links: sample, order, limit, then probing and crawling."""
    rows = districts if sample is None else relational.exact_sample(districts, sample, "district_name")
    rows = relational.head(rows, limit, ["district_name"])
    found = crawl.resolve_directories(rows.select(F.col("district_name").alias("district"), "website"), _pages(store, robots))
    return rows.join(found.drop("website").withColumnRenamed("district", "district_name"), "district_name", "left")


def profile(links: DataFrame, store: DataFrame) -> DataFrame:
    """Directory links to fingerprints; a directory that isn't in the store has notes 'no html'."""
    rows = relational.dedupe_districts(links.where("staff_directory_url <> ''").withColumn("ord", F.col("staff_directory_url")))
    pages = rows.join(crawl.fetched(store).withColumnRenamed("url", "staff_directory_url"), "staff_directory_url", "left").withColumnRenamed("staff_directory_url", "url")
    print_ = extract.fingerprint(pages)
    return print_.withColumnRenamed("url", "staff_directory_url").withColumn("notes", F.when(F.col("n_mailto").isNull(), "no html").otherwise(""))


def leads(districts: DataFrame, store: DataFrame, follow_profiles: bool = True, robots: DataFrame | None = None) -> DataFrame:
    """Districts (district, website, known_url, perhaps status) to deduplicated leads: fan-out, pagination, extraction, profiles."""
    pages = _pages(store, robots)
    directories = cut(crawl.fan_out(districts, pages))
    walks = directories.select(F.struct("district", "url").alias("id"), "url")
    followed = crawl.follow_pages(walks, pages)
    targets = directories.withColumn("id", F.struct("district", "url")).select("id", "district", "school", "school_url", "ord")
    read = followed.join(targets, "id").join(pages, "url").select("district", "school", "school_url", "url", "html", F.struct("ord.s", "ord.pos", "ord.rank", "page").alias("ord"))
    people = extract.employees(extract.raw_people(read))
    if follow_profiles:
        people = extract.fill_emails(people, pages)
    ordered = people.withColumn("ord", F.struct("ord", "pos"))
    return relational.dedupe_people(ordered)


def finalsite(profiles: DataFrame, store: DataFrame, probe: bool = True, names: tuple[str, ...] = (), exact: tuple[str, ...] = (), limit: int = 0, robots: DataFrame | None = None) -> DataFrame:
    """Vendor directories of profiles to deduplicated vendor leads."""
    pages = _pages(store, robots)
    seeds = relational.vendor_targets(profiles, names, exact, limit=limit).select(F.col("district_name").alias("district"), F.col("staff_directory_url").alias("seed"))
    starts = vendors.probe_directory(seeds, pages, words.VENDOR_PATHS) if probe else seeds.withColumnRenamed("seed", "url")
    listed = vendors.page_urls(starts.join(pages, "url"))
    rows = listed.join(pages, "url").select("district", F.lit("").alias("school"), "url", "html", "page")
    people = vendors.fill_profiles(vendors.new_until_repeated(vendors.finalsite_people(rows)), pages)
    return relational.dedupe_vendor(people.withColumn("ord", F.struct("page", "pos")))


def foxbright(targets: DataFrame, store: DataFrame, cap: int = 40, robots: DataFrame | None = None) -> DataFrame:
    """Inline targets (district, url) to leads of the second vendor."""
    pages = _pages(store, robots)
    listed = vendors.foxbright_pages(targets.join(pages, "url"), cap)
    return vendors.foxbright_people(listed.join(pages, "url"), pages)


def merge(parts: list[DataFrame], most_staff: int = 40) -> tuple[DataFrame, DataFrame]:
    """The merged leads of all runs, and the districts whose staff is small."""
    merged = relational.merge_leads(parts)
    return merged, relational.staff_gaps(merged, most_staff).orderBy("staff", "district")
