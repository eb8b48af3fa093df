"""Pages that arrive as a stream: extraction by micro-batch, keep-first over the run, windows of yields."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dirlens.operators import extract, relational


def people(pages: DataFrame) -> DataFrame:
    """A stream of pages (district, school, school_url, url, html, ord, scraped_at) as a stream of employees."""
    read = extract.raw_people(pages.withColumn("ord", F.struct("ord", "scraped_at")))
    return extract.employees(read).withColumn("scraped_at", F.col("ord.scraped_at"))


def first_seen(people: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Each person once for the time that late pages may take; state is dropped after it."""
    keyed = people.withColumn("person", relational.person_key())
    return keyed.withWatermark("scraped_at", delay).dropDuplicatesWithinWatermark(["person"])


def yields(people: DataFrame, window: str = "10 minutes", delay: str = "1 hour") -> DataFrame:
    """Rows and rows with an address by district in windows of scrape time."""
    timed = people.withWatermark("scraped_at", delay).groupBy(F.window("scraped_at", window), "district")
    return timed.agg(F.count("*").alias("n_rows"), F.count_if(F.col("email").isNotNull()).alias("n_emails")).select(F.col("window.start").alias("start"), "district", "n_rows", "n_emails")


def write_batches(path: str):
    """A foreachBatch sink: each batch, deduplicated, is a folder of its own that a retry overwrites."""

    def write(batch: DataFrame, number: int) -> None:
        relational.dedupe_people(batch).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return write


def run_so_far(batches: DataFrame) -> DataFrame:
    """The people of all written batches (batch, ...): each once over the whole run, the first batch's row.

    A person whose first row has no address takes that of their first later row that has one.
    """
    c = F.col
    same = [F.coalesce(F.lower(x), F.lit("")) for x in ("district", "school", "name", "title")]
    rows = batches.withColumn("ord", F.struct("batch", "ord"))
    later = rows.where(c("email").isNotNull()).groupBy(*[k.alias(f"_{i}") for i, k in enumerate(same)]).agg(F.min_by("email", "ord").alias("_email"))
    meets = [k == c(f"_{i}") for i, k in enumerate(same)]
    filled = rows.join(later, meets, "left").withColumn("email", F.coalesce("email", "_email"))
    return relational.dedupe_people(filled.select(*rows.columns)).drop("batch")
