"""Keep-first deduplication, merging, gaps, counts and samples of lead tables.

Order never comes from the input: every keep-first takes an explicit order column, and ties beyond it
are broken by the whole row, so results don't depend on partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, VariantType

from dirlens.functions import text
from dirlens.functions.words import LEAD_ORDER, TYPES
from dirlens.schemas import LEAD, LEAD_HEADERS


def keep_first(df: DataFrame, keys: Sequence[Column], order: Sequence[str | Column] = ("ord",)) -> DataFrame:
    """The first row by order for each key, ties by all columns that have an order; Spark prunes to one row a key before the shuffle."""
    rest = [f.name for f in df.schema if not isinstance(f.dataType, (MapType, VariantType)) and f.name not in order]
    place = Window.partitionBy(*keys).orderBy(*order, *[F.col(f"`{c}`") for c in rest])
    return df.withColumn("_rank", F.row_number().over(place)).where("_rank = 1").drop("_rank")


def _key(*parts: Column) -> Column:
    return F.concat_ws("|", *[F.coalesce(p, F.lit("None")) for p in parts])


def person_key() -> Column:
    """district and address, or district, school, name and title where there is no address."""
    c = F.col
    whole = _key(c("district"), c("school"), F.lower(c("name")), F.lower(c("title")))
    return F.when(F.coalesce(c("email"), F.lit("")) != "", _key(c("district"), F.lower("email"))).otherwise(whole)


def vendor_key() -> Column:
    """district and address, or district, names and role, without the school."""
    c = F.col
    return F.when(F.coalesce(c("email"), F.lit("")) != "", _key(c("district"), F.lower("email"))).otherwise(_key(c("district"), c("first_name"), c("last_name"), c("role")))


def dedupe_people(df: DataFrame) -> DataFrame:
    return keep_first(df, [person_key()])


def dedupe_vendor(df: DataFrame) -> DataFrame:
    return keep_first(df, [vendor_key()])


def dedupe_foxbright(df: DataFrame) -> DataFrame:
    """Within a district: address, or name, building and position."""
    c = F.col
    return keep_first(df, [c("district"), F.coalesce(text.blank_to_null(c("email")), _key(c("name"), c("building"), c("position")))])


def dedupe_districts(df: DataFrame) -> DataFrame:
    return keep_first(df, [F.col("district_name")])


def with_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """df with these columns only, those it lacks as ''."""
    return df.select(*[F.col(c) if c in df.columns else F.lit("").alias(c) for c in columns])


def merge_leads(parts: Sequence[DataFrame], email_source: str = "scraped") -> DataFrame:
    """All parts with an address, one row for each address whatever its district: the first part's first row."""
    named = [with_columns(p, (*LEAD, "email_source") if "email_source" in p.columns else LEAD) for p in parts]
    marked = [p if "email_source" in p.columns else p.withColumn("email_source", F.lit(email_source)) for p in named]
    ordered = [m.withColumn("ord", p["ord"] if "ord" in p.columns else F.lit(0)) if "ord" not in p.columns else with_columns(p, [*LEAD, "ord"]).withColumn("email_source", p["email_source"] if "email_source" in p.columns else F.lit(email_source)) for m, p in zip(marked, parts, strict=True)]
    whole = reduce(DataFrame.unionByName, [d.withColumn("part", F.lit(i)) for i, d in enumerate(ordered)])
    clean = whole.withColumn("email", F.lower(text.strip(F.col("email")))).where(F.contains("email", F.lit("@")))
    return keep_first(clean, [F.col("email")], ["part", "ord"]).select(*LEAD, "email_source")


def staff_per_district(leads: DataFrame) -> DataFrame:
    """district, staff (rows, unnamed ones too), emails; rows without a district are left out."""
    return leads.where(F.col("district").isNotNull()).groupBy("district").agg(F.count("*").alias("staff"), F.count_if(F.coalesce(F.contains("email", F.lit("@")), F.lit(False))).alias("emails"))


def staff_gaps(leads: DataFrame, most: int = 40) -> DataFrame:
    """Districts whose staff is so small that only an office was read."""
    return staff_per_district(leads).where(F.col("staff") <= most)


def gaps_with_websites(gaps: DataFrame, districts: DataFrame) -> DataFrame:
    """gaps with the website of each district of the same name in any case; several give several rows."""

    def key(c: str) -> Column:
        return F.lower(text.strip(F.col(c)))

    known = districts.select(key("district").alias("_k"), "website")
    return gaps.withColumn("_k", key("district")).join(known, "_k", "left").drop("_k")


def merge_districts(rows: DataFrame) -> DataFrame:
    """One row for each number or name: the first row's values and the first website of any."""
    key = F.lower(F.coalesce(text.blank_to_null(text.strip(F.col("district_number"))), text.strip(F.col("district_name"))))
    first = F.min_by(F.struct("district_number", "district_name", "county", "region"), "ord")
    merged = rows.where(F.coalesce(text.strip(F.col("district_name")), F.lit("")) != "").groupBy(key.alias("_key")).agg(first.alias("f"), F.min_by("website", F.when(F.col("website").isNotNull(), F.col("ord"))).alias("website"))
    return merged.select("f.*", "website").where("website is not null")


def fixed_counts(df: DataFrame, column: str, domain: Sequence[str]) -> DataFrame:
    """Rows of each value of the domain, in its order, zeros kept: value, rank, n."""
    spark = df.sparkSession
    values = spark.createDataFrame([(v, i) for i, v in enumerate(domain)], f"{column} string, rank int")
    return values.join(df.groupBy(column).count(), column, "left").select(column, "rank", F.coalesce("count", F.lit(0)).alias("n"))


def with_addresses(profiles: DataFrame, least: int = 3) -> DataFrame:
    """Profiles of pages with so many addressed links or more."""
    return profiles.where(F.col("n_mailto") >= least)


def of_style(profiles: DataFrame, style: str) -> DataFrame:
    return profiles.where(F.col("dir_style") == style)


def true_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """For each boolean column, the number of rows where it is true; nulls are not."""
    return df.agg(*[F.count_if(F.coalesce(c, F.lit(False))).alias(c) for c in columns])


def lead_type_counts(leads: DataFrame) -> DataFrame:
    return fixed_counts(leads, "lead_type", LEAD_ORDER)


def employee_type_counts(employees: DataFrame) -> DataFrame:
    return fixed_counts(employees, "employee_type", TYPES)


def value_counts(df: DataFrame, column: str, most: int | None = None) -> DataFrame:
    """Values without null by falling count, at most so many; ties in order of the value."""
    out = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), column)
    return out if most is None else out.limit(most)


def top_values(df: DataFrame, column: str, most: int) -> DataFrame:
    """The most frequent values, ties in order of their first row."""
    return df.where(F.coalesce(F.col(column), F.lit("")) != "").groupBy(column).agg(F.count("*").alias("n"), F.min("ord").alias("first")).orderBy(F.desc("n"), "first").limit(most).select(column, "n")


def yields(df: DataFrame) -> DataFrame:
    """rows, rows with an address, their per cent rounded half to even, districts, schools."""
    held = F.count_if(F.coalesce(F.contains("email", F.lit("@")), F.lit(False)))
    share = F.when(F.count("*") > 0, F.bround(held * 100 / F.count("*"), 1)).otherwise(0.0)
    return df.agg(F.count("*").alias("n_rows"), held.alias("n_emails"), share.alias("per_cent"), F.count_distinct("district").alias("n_districts"), F.count_distinct("district", "school").alias("n_schools"))


def summary(df: DataFrame) -> DataFrame:
    """Metric and count: total, with an address, and each lead type."""
    counts = [("Total", F.count("*")), ("With email", F.count_if(F.coalesce(F.contains("email", F.lit("@")), F.lit(False))))]
    counts += [(t, F.count_if(F.col("lead_type") == t)) for t in LEAD_ORDER]
    pairs = F.array(*[F.struct(F.lit(k).alias("metric"), v.alias("n")) for k, v in counts])
    return df.agg(pairs.alias("pairs")).select(F.inline("pairs"))


def crosstab(df: DataFrame, row: str, column: str, values: Sequence[str]) -> DataFrame:
    return df.groupBy(row).pivot(column, list(values)).count().na.fill(0, list(values))


def sorted_leads(leads: DataFrame) -> DataFrame:
    """In order of lead type by name, school, last and first name, nulls last, under the headers of an export."""
    order = [F.asc_nulls_last(c) for c in ("lead_type", "school", "last_name", "first_name")]
    return leads.orderBy(*order, "ord").select(*[F.col(c).alias(LEAD_HEADERS[c]) for c in LEAD])


def head(df: DataFrame, n: int, order: Sequence[str | Column]) -> DataFrame:
    """The first n rows by order; all if n is 0 or less."""
    return df.orderBy(*order).limit(n) if n > 0 else df.orderBy(*order)


def capped(df: DataFrame, keys: Sequence[str], most: int, order: Sequence[str | Column] = ("ord",)) -> DataFrame:
    """At most so many rows of each key, the first by order."""
    return df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("_rank") <= most).drop("_rank")


def exact_sample(df: DataFrame, fraction: float, key: str, seed: int = 42) -> DataFrame:
    """Exactly max(1, round(n * fraction)) rows, half to even, the same ones each time, in order of key."""
    n = df.count()
    size = max(1, round(n * fraction))
    mark = F.xxhash64(key, F.lit(seed))
    # only rows about the share wanted are sorted: a bound on the hash that leaves too few is raised
    bound, few = fraction, True
    while few and bound < 0.5:
        bound = bound * 1.2 + 100 / max(1, n)
        some = df.where(mark < F.lit(int((2 * min(bound, 0.5) - 1) * 2**63)))
        few = some.count() < size
    return (df if few else some).orderBy(mark, key).limit(size).orderBy(key)


def named_any(df: DataFrame, column: str, parts: Sequence[str]) -> DataFrame:
    """Rows whose column holds one of the parts in any case."""
    return df.where(text.any_of(F.lower(F.col(column)), [p.lower() for p in parts]))


def named_exactly(df: DataFrame, column: str, names: Sequence[str]) -> DataFrame:
    return df.where(F.lower(text.strip(F.col(column))).isin(*[n.strip().lower() for n in names]))


def vendor_targets(profiles: DataFrame, names: Sequence[str] = (), exact: Sequence[str] = (), cms: str = "finalsite", limit: int = 0) -> DataFrame:
    """Directories to read: of the vendor, at most limit; names override both, exact names narrow the rest."""
    rows = profiles.where("staff_directory_url is not null")
    if names:
        rows = named_any(rows, "district_name", names)
    elif "cms" in rows.columns:
        rows = rows.where(F.lower(text.strip(F.col("cms"))) == cms)
    if exact:
        rows = named_exactly(rows, "district_name", exact)
    rows = dedupe_districts(rows)
    return rows if names or limit <= 0 else head(rows, limit, ["ord"])
