"""From pages to people: raw records by table function, everything after that as expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dirlens.functions import contacts, names, roles, sites, text, words
from dirlens.html import udfs
from dirlens.operators.relational import keep_first
from dirlens.schemas import EMPLOYEE, LEAD


def raw_people(pages: DataFrame) -> DataFrame:
    """The accepted records of each of pages (district, school, school_url, url, html, ord): one row each.

    A page that can't be read gives one row with its error and no name.
    """
    read = pages.withColumn("page", udfs.directory("html", "url")).drop("html")
    rows = read.select(*[c for c in read.columns if c != "page"], "page.strategy", "page.error", F.posexplode_outer("page.people").alias("pos", "raw"))
    return rows.where("raw is not null or error is not null")


def employees(raw: DataFrame) -> DataFrame:
    """raw (district, school, school_url, url, strategy, pos, raw, ord) as typed employees."""
    c = F.col
    labelled = raw.where("raw is not null").withColumn("n0", names.strip_label(c("raw.name"))).withColumn("t0", names.strip_label(c("raw.title")))
    swapped = F.coalesce((c("t0") != "") & (c("n0") != "") & names.looks_like_person(c("t0")) & ~names.looks_like_person(c("n0")), F.lit(False))
    named = labelled.withColumn("name", F.when(swapped, c("t0")).otherwise(c("n0"))).withColumn("given", F.when(swapped, "Staff").otherwise(c("t0")))
    role = roles.infer_role(c("name"), c("given"), c("raw.email"), c("url"), c("school"))
    typed = named.withColumn("inferred", role).withColumn("split", names.split_name(c("name"))).withColumn("number", contacts.phone(c("raw.phone")))
    given = text.clean(c("given"))
    title = F.when(F.lower(given).isin(*words.NO_TITLE) | names.looks_like_person(given), c("inferred.role")).otherwise(given)
    titled = typed.withColumn("title", title)
    return titled.select(
        "district", "school", text.clean(c("name")).alias("name"), c("split.first").alias("first_name"), c("split.last").alias("last_name"), "title",
        F.coalesce(text.blank_to_null(text.clean(c("raw.dept"))), c("inferred.department")).alias("department"),
        contacts.email(c("raw.email")).alias("email"), "number.phone", "number.extension",
        c("raw.photo").alias("photo_url"), c("raw.profile").alias("profile_url"), "school_url", c("url").alias("directory_url"),
        c("inferred.type").alias("employee_type"),
        roles.lead_type(c("title"), c("inferred.role"), c("inferred.type"), F.coalesce("district", F.lit("")), c("school")).alias("lead_type"),
        "strategy", "pos", "ord",
    )


def is_accepted(name: Column, title: Column, email: Column) -> Column:
    """The gate of html.plain as an expression."""
    n, t = names.strip_label(name), names.strip_label(title)
    swapped = F.coalesce((t != "") & (n != "") & names.looks_like_person(t) & ~names.looks_like_person(n), F.lit(False))
    own = F.coalesce(F.when(swapped, t).otherwise(n), F.lit(""))
    person = names.looks_like_person(own) | F.contains(F.coalesce(email, F.lit("")), F.lit("@")) | (F.size(text.words(own)) >= 2)
    return (F.length(own) >= 3) & ~names.is_junk(own) & person


def leads(people: DataFrame) -> DataFrame:
    """The seven columns of a lead; its role is the title."""
    return people.select(*[F.col("title").alias("role") if c == "role" and "title" in people.columns else F.col(c) for c in LEAD], *[c for c in ("ord", "pos") if c in people.columns])


def wide(people: DataFrame) -> DataFrame:
    """The whole employee frame: columns that people lacks are null, lists are joined, times are ISO 8601 in UTC."""
    blank = F.lit(None).cast("string")
    held = {c: F.col(c) if c in people.columns else blank.alias(c) for c in EMPLOYEE}
    if "subjects" in people.columns:
        held["subjects"] = text.blank_to_null(F.array_join("subjects", "; ")).alias("subjects")
    if "scraped_at" in people.columns:
        held["scraped_at"] = F.date_format(F.to_utc_timestamp("scraped_at", F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'+00:00'").alias("scraped_at")
    return people.select(*[held[c] for c in EMPLOYEE])


def fill_emails(people: DataFrame, pages: DataFrame, most: int = 400) -> DataFrame:
    """people with the address of their profile page in pages (url, html) where they have none.

    For each directory the first `most` such people are looked up.
    """
    missing = people.withColumn("_id", F.monotonically_increasing_id()) if "_id" not in people.columns else people
    needs = F.col("email").isNull() & F.col("profile_url").isNotNull()
    place = F.row_number().over(Window.partitionBy("directory_url", needs).orderBy("ord", "pos"))
    asked = missing.withColumn("_asked", F.when(needs & (place <= most), F.col("profile_url")))
    found = pages.join(asked.where("_asked is not null").select(F.col("_asked").alias("url")).distinct(), "url", "left_semi").select(F.col("url").alias("_asked"), udfs.page_emails("html").alias("_emails"))
    best = contacts.best_email(F.col("_emails"), F.col("first_name"), F.col("last_name"))
    return asked.join(found, "_asked", "left").withColumn("email", F.coalesce("email", best)).drop("_asked", "_emails", "_id")


def fingerprint(pages: DataFrame) -> DataFrame:
    """pages (url, html, ...) with cms, generator, vendor_host, dir_style, austin_like and the counts behind them."""
    c = F.col
    read = pages.withColumn("facts", udfs.facts("html")).withColumn("cms", sites.cms(c("html"), c("url"))).withColumn("vendor_host", sites.vendor(c("html"), c("url"))).drop("html")
    style = sites.directory_style(c("facts.n_mailto"), c("facts.n_table_rows"), c("facts.table_has_mail"), c("facts.n_cards"), c("facts.text_length"))
    styled = read.withColumn("dir_style", style)
    marked = styled.withColumn("austin_like", sites.austin_like(c("dir_style"), c("facts.generator"), c("vendor_host"), c("url")))
    return marked.select(*[x for x in marked.columns if x != "facts"], "facts.generator", "facts.n_mailto", "facts.n_table_rows", "facts.n_cards", "facts.is_directory")


def email_hits(pages: DataFrame) -> DataFrame:
    """url, pos, name, title, email, source of every address on pages (url, html)."""
    return pages.select("url", F.posexplode(udfs.email_hits("html")).alias("pos", "hit")).select("url", "pos", "hit.*")


def merge_hits(states: DataFrame) -> DataFrame:
    """Hits of several states (state) of a page: the first state's hit of each address."""
    return keep_first(states, [F.col("url"), F.col("email")], ["state", "pos"])
