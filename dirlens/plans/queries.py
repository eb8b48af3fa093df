"""Queries over the given tables and over small written-out fixtures, with their SQL for comparison."""

from __future__ import annotations

from collections.abc import Callable, Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from dirlens.functions import contacts, names, roles, sites, text, words
from dirlens.operators import crawl, extract, relational, vendors
from dirlens.plans import fixtures, pipelines
from dirlens.sources import districts

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

TITLES = ("Math Teacher", "Principal", "Assistant Principal", "School Nurse", "Director of Finance", "Superintendent", "Bus Driver", "Head Coach", "Registrar", "Band Director", "Officer", "Archivist")


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        key = name or f.__name__
        QUERIES[key] = f
        if sql is not None:
            SQL[key] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def values(spark: SparkSession, rows: Iterable[tuple], schema: str) -> DataFrame:
    """rows as a table within the plan; a list of rows would be read by Python workers, again by each stage that scans it."""
    kind = _parse_datatype_string(schema)
    return spark.createDataFrame(pa.Table.from_pylist([dict(zip(kind.names, r, strict=True)) for r in rows], to_arrow_schema(kind)), kind)


def values_sql(rows: tuple[tuple, ...], columns: str) -> str:
    """rows as a SQL VALUES table named v."""

    def literal(x: object) -> str:
        return "NULL" if x is None else str(x) if isinstance(x, int) else "'" + str(x).replace("'", "''") + "'"

    return f"(VALUES {', '.join('(' + ', '.join(map(literal, r)) + ')' for r in rows)}) AS v({columns})"


# ---- a lead table derived from customer and nation, the same in both engines

_TITLE_SQL = "CASE c_custkey % 12 " + " ".join(f"WHEN {i} THEN '{t}'" for i, t in enumerate(TITLES)) + " END"
LEADS_SQL = f"""leads AS (
  SELECT n_name AS district, 'School ' || CAST(c_custkey % 20 AS VARCHAR) AS school, c_name AS name,
    c_name AS first_name, c_mktsegment AS last_name,
    CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE 'U' || CAST(c_custkey % 700 AS VARCHAR) || '@d' || CAST(c_nationkey AS VARCHAR) || '.example.org' END AS email,
    {_TITLE_SQL} AS title, c_custkey AS ord
  FROM customer JOIN nation ON c_nationkey = n_nationkey)"""


def leads(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    joined = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    address = F.concat(F.lit("U"), (key % 700).cast("string"), F.lit("@d"), F.col("c_nationkey").cast("string"), F.lit(".example.org"))
    return joined.select(
        F.col("n_name").alias("district"), F.concat(F.lit("School "), (key % 20).cast("string")).alias("school"), F.col("c_name").alias("name"),
        F.col("c_name").alias("first_name"), F.col("c_mktsegment").alias("last_name"), F.when(key % 3 != 0, address).alias("email"),
        F.element_at(text.strings(TITLES), (key % 12 + 1).cast("int")).alias("title"), key.alias("ord"),
    )


def typed_leads(spark: SparkSession, sf_dir: str) -> DataFrame:
    inferred = roles.infer_role(F.lit("A B"), F.col("title"), F.col("email"), F.lit(""), F.col("school"))
    typed = leads(spark, sf_dir).withColumn("inferred", inferred).withColumn("role", F.col("inferred.role"))
    return typed.withColumn("lead_type", roles.lead_type(F.col("title"), F.col("role"), F.col("inferred.type"), F.col("district"), F.col("school")))


TYPED_SQL = f"""{LEADS_SQL}, roled AS (
  SELECT *, {roles.infer_role_sql("title", 0)} AS role, {roles.infer_role_sql("title", 1)} AS department, {roles.infer_role_sql("title", 2)} AS type FROM leads
), typed AS (SELECT *, {roles.lead_type_sql("title", "role", "type", "district", "school")} AS lead_type FROM roled)"""

_PERSON_KEY = "CASE WHEN email IS NOT NULL THEN district || '|' || lower(email) ELSE district || '|' || school || '|' || lower(name) || '|' || lower(title) END"
_VENDOR_KEY = "CASE WHEN email IS NOT NULL THEN district || '|' || lower(email) ELSE district || '|' || first_name || '|' || last_name || '|' || title END"


def _first_sql(key: str, source: str = "leads", order: str = "ord") -> str:
    return f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS rn FROM {source}) WHERE rn = 1"


@query(f"WITH {LEADS_SQL} SELECT district, school, name, email, title, ord FROM ({_first_sql(_PERSON_KEY)})")
def leads_dedupe_district_email(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.dedupe_people(leads(spark, sf_dir)).select("district", "school", "name", "email", "title", "ord")


@query(f"WITH {LEADS_SQL} SELECT district, first_name, last_name, email, title AS role, ord FROM ({_first_sql(_VENDOR_KEY)})")
def leads_dedupe_vendor_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.dedupe_vendor(leads(spark, sf_dir).withColumnRenamed("title", "role")).select("district", "first_name", "last_name", "email", "role", "ord")


@query(f"""WITH {TYPED_SQL}, parts AS (
  SELECT *, 0 AS part FROM typed WHERE ord % 2 = 0 UNION ALL SELECT *, 1 AS part FROM typed WHERE ord % 2 = 1)
  SELECT district, school, first_name, last_name, lower(email) AS email, role, lead_type, 'scraped' AS email_source
  FROM ({_first_sql("lower(email)", "(SELECT * FROM parts WHERE contains(email, '@'))", "part, ord")})""")
def leads_merge_email_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = typed_leads(spark, sf_dir)
    return relational.merge_leads([rows.where("ord % 2 = 0"), rows.where("ord % 2 = 1")])


_STAFF = "SELECT district, count(*) AS staff, count(*) FILTER (WHERE contains(email, '@')) AS emails FROM leads WHERE district IS NOT NULL GROUP BY district"


@query(f"WITH {LEADS_SQL} {_STAFF} HAVING count(*) <= 60")
def district_staff_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.staff_gaps(leads(spark, sf_dir), 60)


_SITES = "SELECT n_name AS district, 'https://' || lower(n_name) || '.example.org' AS website FROM nation UNION ALL SELECT upper(n_name), 'https://b.example.org' FROM nation WHERE n_nationkey % 5 = 0"


@query(f"WITH {LEADS_SQL}, gaps AS ({_STAFF}), sites AS ({_SITES}) SELECT g.district, staff, emails, website FROM gaps g LEFT JOIN sites s ON lower(trim(g.district)) = lower(trim(s.district))")
def gaps_join_websites(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    known = nation.select(F.col("n_name").alias("district"), F.concat(F.lit("https://"), F.lower("n_name"), F.lit(".example.org")).alias("website"))
    more = nation.where("n_nationkey % 5 = 0").select(F.upper("n_name").alias("district"), F.lit("https://b.example.org").alias("website"))
    return relational.gaps_with_websites(relational.staff_per_district(leads(spark, sf_dir)), known.unionAll(more))


_DISTRICT_ROWS = """rows AS (SELECT CASE WHEN o_custkey % 4 = 0 THEN '' ELSE CAST(o_custkey AS VARCHAR) END AS district_number, 'District ' || CAST(o_custkey AS VARCHAR) AS district_name,
  o_orderstatus AS county, o_orderpriority AS region, CASE WHEN o_orderkey % 3 = 0 THEN 'https://w' || CAST(o_orderkey AS VARCHAR) || '.example.org' END AS website, o_orderkey AS ord FROM orders)"""


@query(f"""WITH {_DISTRICT_ROWS} SELECT arg_min(district_number, ord) AS district_number, arg_min(district_name, ord) AS district_name, arg_min(county, ord) AS county,
  arg_min(region, ord) AS region, arg_min(website, ord) FILTER (WHERE website IS NOT NULL) AS website
  FROM rows GROUP BY lower(CASE WHEN district_number <> '' THEN district_number ELSE district_name END) HAVING count(website) > 0""")
def district_coalesce_website(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    rows = table(spark, sf_dir, "orders").select(
        F.when(c("o_custkey") % 4 == 0, "").otherwise(c("o_custkey").cast("string")).alias("district_number"), F.concat(F.lit("District "), c("o_custkey").cast("string")).alias("district_name"),
        c("o_orderstatus").alias("county"), c("o_orderpriority").alias("region"), F.when(c("o_orderkey") % 3 == 0, F.concat(F.lit("https://w"), c("o_orderkey").cast("string"), F.lit(".example.org"))).alias("website"), c("o_orderkey").alias("ord"),
    )
    return relational.merge_districts(rows)


@query(f"WITH {TYPED_SQL}, d(lead_type, rank) AS (VALUES ('Dist', 0), ('School', 1), ('Teacher', 2), ('Other', 3)) SELECT d.lead_type, rank, count(t.ord) AS n FROM d LEFT JOIN typed t USING (lead_type) GROUP BY d.lead_type, rank")
def lead_type_counts_fixed_domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.lead_type_counts(typed_leads(spark, sf_dir))


@query(f"WITH {TYPED_SQL} SELECT ord, title, role, department, type, lead_type FROM typed")
def lead_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    return typed_leads(spark, sf_dir).select("ord", "title", "role", "inferred.department", "inferred.type", "lead_type")


@query("""WITH p AS (SELECT CASE p_size % 3 WHEN 0 THEN 'finalsite' WHEN 1 THEN 'edlio' ELSE 'unknown' END AS cms, CASE p_partkey % 3 WHEN 0 THEN 'email_table' WHEN 1 THEN 'unknown' ELSE 'js_or_empty' END AS s FROM part)
  SELECT cms, count(*) FILTER (WHERE s = 'email_table') AS email_table, count(*) FILTER (WHERE s = 'js_or_empty') AS js_or_empty, count(*) FILTER (WHERE s = 'unknown') AS "unknown" FROM p GROUP BY cms""")
def crosstab_cms_style(spark: SparkSession, sf_dir: str) -> DataFrame:
    size, key = F.col("p_size") % 3, F.col("p_partkey") % 3
    rows = table(spark, sf_dir, "part").select(F.when(size == 0, "finalsite").when(size == 1, "edlio").otherwise("unknown").alias("cms"), F.when(key == 0, "email_table").when(key == 1, "unknown").otherwise("js_or_empty").alias("s"))
    return relational.crosstab(rows, "cms", "s", ("email_table", "js_or_empty", "unknown"))


@query("SELECT p_type, count(*) AS n FROM part WHERE p_type IS NOT NULL GROUP BY p_type ORDER BY n DESC, p_type LIMIT 10")
def value_counts_top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.value_counts(table(spark, sf_dir, "part"), "p_type", 10)


@query(f"WITH {LEADS_SQL} SELECT title, count(*) AS n FROM leads GROUP BY title ORDER BY n DESC, min(ord) LIMIT 12")
def top_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.top_values(leads(spark, sf_dir), "title", 12)


@query(f"WITH {LEADS_SQL} SELECT school, count(*) AS n FROM leads GROUP BY school ORDER BY n DESC, min(ord) LIMIT 10")
def top_schools(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.top_values(leads(spark, sf_dir), "school", 10)


@query(f"""WITH {LEADS_SQL} SELECT count(*) AS n_rows, count(email) AS n_emails, round(count(email) * 100.0 / count(*), 1) AS per_cent,
  count(DISTINCT district) AS n_districts, count(DISTINCT (district, school)) AS n_schools FROM leads""")
def lead_yields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.yields(leads(spark, sf_dir))


@query(f"WITH {TYPED_SQL} SELECT 'Total' AS metric, count(*) AS n FROM typed UNION ALL SELECT 'With email', count(email) FROM typed" + "".join(f" UNION ALL SELECT '{t}', count(*) FROM typed WHERE lead_type = '{t}'" for t in words.LEAD_ORDER))
def lead_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.summary(typed_leads(spark, sf_dir))


@query(f"""WITH {TYPED_SQL} SELECT district AS "District", school AS "School", first_name AS "First Name", last_name AS "Last Name", email AS "Email", role AS "Role", lead_type AS "Lead Type" FROM typed""")
def leads_sorted_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.sorted_leads(typed_leads(spark, sf_dir))


@query(f"WITH {LEADS_SQL} SELECT district, name, ord FROM (SELECT *, row_number() OVER (PARTITION BY district ORDER BY ord) AS rn FROM leads) WHERE rn <= 25")
def caps_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.capped(leads(spark, sf_dir), ["district"], 25).select("district", "name", "ord")


@query("SELECT greatest(1, CAST(round_even(count(*) * 0.1, 0) AS BIGINT)) AS n FROM customer")
def exact_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.exact_sample(table(spark, sf_dir, "customer"), 0.1, "c_name").agg(F.count("*").alias("n"))


@query("SELECT c_custkey, c_name FROM customer WHERE (contains(lower(c_name), '00001') OR contains(lower(c_name), '77')) AND lower(trim(c_mktsegment)) IN ('building', 'machinery')")
def name_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = relational.named_any(table(spark, sf_dir, "customer"), "c_name", ("00001", "77"))
    return relational.named_exactly(rows, "c_mktsegment", (" Building", "MACHINERY ")).select("c_custkey", "c_name")


# ---- text of documents and pages


def _found_sql(pattern: str, group: int = 0, flags: str = "") -> str:
    return f"SELECT doc_id, unnest(regexp_extract_all(text, '{flags}{pattern}', {group})) AS hit FROM documents"


_STRICT = f"regexp_full_match(e, '{words.EMAIL}') AND NOT {text.any_of_sql('e', words.BAD_DOMAINS)} AND NOT regexp_matches(e, '\\.(png|jpg|gif|svg|webp)$')"


@query(f"""WITH h AS ({_found_sql(words.EMAIL)}), s AS (SELECT doc_id, hit, lower(trim(hit, '.,;:')) AS e FROM h)
  SELECT doc_id, hit, lower(hit) AS plain, CASE WHEN {_STRICT} THEN e END AS strict FROM s""")
def email_extract_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = table(spark, sf_dir, "documents").select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(f"({words.EMAIL})"), 1)).alias("hit"))
    return hits.select("doc_id", "hit", contacts.email(F.col("hit")).alias("plain"), contacts.strict_email(F.col("hit")).alias("strict"))


@query(f"""WITH h AS ({_found_sql(words.HIDDEN_EMAIL, 0, "(?i)")}), m AS (SELECT DISTINCT doc_id, lower(regexp_replace(hit, '^(?i){words.HIDDEN_EMAIL}$', '\\1@\\2.\\3')) AS email FROM h)
  SELECT doc_id, email FROM m WHERE regexp_full_match(email, '{words.EMAIL}')""")
def obfuscated_email_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.explode(contacts.hidden_emails(F.col("text"))).alias("email"))


@query(f"""WITH h AS ({_found_sql(words.PHONE)}), d AS (SELECT doc_id, hit, regexp_replace(hit, '[^0-9]', '', 'g') AS n FROM h), t AS (SELECT doc_id, hit, CASE WHEN length(n) = 11 AND n[1] = '1' THEN n[2:] ELSE n END AS n FROM d)
  SELECT doc_id, hit, '(' || n[1:3] || ') ' || n[4:6] || '-' || n[7:10] AS phone FROM t""")
def phone_extract_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = table(spark, sf_dir, "documents").select("doc_id", F.explode(contacts.find_phones(F.col("text"))).alias("hit"))
    return hits.select("doc_id", "hit", contacts.phone(F.col("hit"))["phone"].alias("phone"))


_HOST = "lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1))"
_ROOT = f"array_to_string(list_slice(string_split(string_split({_HOST}, ':')[1], '.'), -2, -1), '.')"


@query(f"SELECT page_id, {_HOST} AS host, {_ROOT} AS root, {_ROOT} = 'example.com' AS same_site FROM pages")
def url_domain_root_samesite(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = F.col("url")
    return table(spark, sf_dir, "pages").select("page_id", contacts.host(url).alias("host"), contacts.root_host(url).alias("root"), contacts.same_site(url, F.lit("https://www.example.com/")).alias("same_site"))


def _hay_sql(rules: tuple, otherwise: str) -> str:
    hay = "(lower(coalesce(html, '')) || ' ' || lower(coalesce(url, '')))"
    return text.first_hit_sql([(text.any_of_sql(hay, keys), f"'{name}'") for name, keys in rules], otherwise)


@query(f"""SELECT page_id, {_hay_sql(words.CMS, "'unknown'")} AS cms FROM pages""")
def cms_detect_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", sites.cms(F.col("html"), F.col("url")).alias("cms"))


@query(f"""SELECT page_id, {_hay_sql(words.VENDORS, "''")} AS vendor FROM pages""")
def vendor_host_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", sites.vendor(F.col("html"), F.col("url")).alias("vendor"))


_ROOT_URL = "regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)', 1)"


@query(f"""WITH a AS (SELECT page_id, url, unnest(regexp_extract_all(html, '<a href="([^"]*)">[^<]*</a>', 1)) AS href FROM pages)
  SELECT page_id, href, CASE WHEN href LIKE '/%' THEN {_ROOT_URL} || href ELSE href END AS target, count(*) AS n FROM a GROUP BY ALL""")
def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = crawl.page_links(table(spark, sf_dir, "pages"))
    return links.groupBy("page_id", "href", "target").agg(F.count("*").alias("n"))


def _tags_sql(name: str, attribute: str, value: str) -> str:
    """The tags of this name whose attribute holds the pattern."""
    return f"""regexp_extract_all(html, '(?is)<{name}(?:\\s[^>]*)?\\s{attribute}\\s*=\\s*["\'\']{value}')"""


#: The facts of a page by patterns on its source: right for pages whose scripts and comments hold no such tags.
FACTS_SQL = f"""tables AS (
  SELECT page_id, url, html, regexp_extract_all(html, '(?is)<table.*?</table') AS ts FROM pages
), counted AS (
  SELECT *, list_max([len(regexp_extract_all(t, '(?i)<tr[\\s>]')) for t in ts]) AS most FROM tables
), facts AS (
  SELECT page_id, url, html, CAST(len({_tags_sql("a", "href", "mailto:")}) AS INTEGER) AS n_mailto, CAST(coalesce(most, 0) AS INTEGER) AS n_table_rows,
    CAST(len({_tags_sql("[a-z][a-z0-9]*", "class", "[^\"\'\']*(?:staff|employee|faculty|person|directory-item)")}) AS INTEGER) AS n_cards,
    coalesce([t for t in ts if len(regexp_extract_all(t, '(?i)<tr[\\s>]')) = most][1] ILIKE '%mailto:%', false) AS table_has_mail,
    regexp_extract(html, '(?is)<meta\\s[^>]*name="[^">]*generator[^">]*"[^>]*content="([^">]*)"', 1) AS generator,
    length(trim(regexp_replace(regexp_replace(html, '(?is)<[^>]*>', ' ', 'g'), '\\s+', ' ', 'g'))) AS text_length
  FROM counted
), styled AS (
  SELECT *, {_hay_sql(words.CMS, "'unknown'")} AS cms, {_hay_sql(words.VENDORS, "''")} AS vendor_host,
    CASE WHEN n_table_rows >= 4 AND (table_has_mail OR n_mailto >= 3) THEN 'email_table' WHEN n_cards >= 3 AND n_mailto >= 3 THEN 'card_grid_email'
      WHEN n_cards >= 3 AND n_mailto = 0 THEN 'card_grid_no_email' WHEN n_mailto >= 5 THEN 'mailto_list'
      WHEN text_length < 400 OR (n_cards = 0 AND n_table_rows < 2 AND n_mailto = 0) THEN 'js_or_empty' ELSE 'unknown' END AS dir_style
  FROM facts
)"""


@query(f"""WITH {FACTS_SQL} SELECT page_id, cms, generator, vendor_host, dir_style, n_mailto, n_table_rows, n_cards,
  dir_style = 'email_table' AND (contains(lower(generator), 'drupal') OR vendor_host IN ('austinschools', 'esc_regional') OR rtrim(url, '/') LIKE '%/directory') AS austin_like FROM styled""")
def page_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.fingerprint(table(spark, sf_dir, "pages")).select("page_id", "cms", "generator", "vendor_host", "dir_style", "austin_like", "n_mailto", "n_table_rows", "n_cards")


@query(f"WITH {FACTS_SQL} SELECT dir_style, count(*) AS n FROM styled GROUP BY dir_style")
def dir_style_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.value_counts(extract.fingerprint(table(spark, sf_dir, "pages").select("url", "html")), "dir_style")


# ---- written-out fixtures: the same rows on both sides, what is expected written beside them


def _case(key: str, rows: tuple[tuple, ...], schema: str, columns: tuple[str, ...], made: Callable[[], list[Column]]) -> None:
    """A query of expressions over rows whose last columns are what is expected."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        inputs = [c.split()[0] for c in schema.split(", ")]
        data = values(spark, [r[: len(inputs)] for r in rows], schema)
        return data.select("id", *[c.alias(n) for c, n in zip(made(), columns, strict=True)])

    inputs = [c.split()[0] for c in schema.split(", ")]
    QUERIES[key] = run
    SQL[key] = f"SELECT id, {', '.join(columns)} FROM {values_sql(rows, ', '.join([*inputs, *columns]))}"


c = F.col
_case("name_split", fixtures.NAMES, "id int, name string", ("first", "last"), lambda: [names.split_name(c("name"))["first"], names.split_name(c("name"))["last"]])
_case("junk_name", fixtures.JUNK, "id int, name string", ("junk", "person"), lambda: [names.is_junk(c("name")).cast("int"), names.looks_like_person(c("name")).cast("int")])
_case("label_prefix", fixtures.LABELS, "id int, name string", ("bare",), lambda: [names.strip_label(c("name"))])
_case("phone_normalize", fixtures.PHONES, "id int, phone string", ("shown", "extension"), lambda: [contacts.phone(c("phone"))["phone"], contacts.phone(c("phone"))["extension"]])
_case("email_normalize", fixtures.EMAILS, "id int, email string", ("plain", "strict"), lambda: [contacts.email(c("email")), contacts.strict_email(c("email"))])
_case("cfemail_decode", fixtures.HEX, "id int, hidden string", ("shown",), lambda: [contacts.decode_hex(c("hidden"))])
_case("at_dot_emails", fixtures.AT_DOT, "id int, body string", ("emails",), lambda: [F.array_join(contacts.at_dot_emails(c("body")), ",")])
_case("url_tools", fixtures.URLS, "id int, url string", ("host", "root", "website", "base", "district"), lambda: [contacts.host(c("url")), contacts.root_host(c("url")), contacts.website(c("url")), contacts.base_site(c("url")), contacts.name_of_host(c("url"))])
_case("infer_role", fixtures.ROLES, "id int, name string, title string, email string, url string, school string", ("role", "department", "type"), lambda: [roles.infer_role(c("name"), c("title"), c("email"), c("url"), c("school"))[x] for x in ("role", "department", "type")])
_case("lead_rules", fixtures.LEADS, "id int, title string, role string, type string, district string, school string", ("lead_type",), lambda: [roles.lead_type(c("title"), c("role"), c("type"), c("district"), c("school"))])
_case("campus_code", fixtures.CAMPUS_CODES, "id int, photo string", ("code", "campus"), lambda: [sites.campus_of_photo(c("photo")), sites.readable_campus(sites.campus_of_photo(c("photo")))])
_case("campus_tidy", fixtures.CAMPUS_NAMES, "id int, name string", ("campus",), lambda: [sites.tidy_campus(c("name"))])
_case("vendor_page_counts", fixtures.PAGE_COUNTS, "id int, html string", ("pages",), lambda: [sites.vendor_pages(c("html"))])
_case("fetch_accepts", fixtures.FETCHES, "id int, status int, content_type string", ("ok",), lambda: [sites.is_fetched(c("status"), c("content_type")).cast("int")])
_case("directory_style", fixtures.STYLES, "id int, n_mailto int, n_table_rows int, mail int, n_cards int, length int", ("style",), lambda: [sites.directory_style(c("n_mailto"), c("n_table_rows"), c("mail") == 1, c("n_cards"), c("length"))])
_case("constructed_email", fixtures.CONSTRUCTED, "id int, first string, last string, domain string", ("email", "email_source"), lambda: [contacts.constructed_email("{f}{last}", c("first"), c("last"), c("domain")), F.lit("constructed")])


def store(spark: SparkSession) -> DataFrame:
    return values(spark, [(u, h, 200, "text/html", "static") for u, h in fixtures.PAGES.items()], "url string, html string, status int, content_type string, variant string")


def expected(rows: tuple[tuple, ...], columns: str) -> str:
    return f"SELECT * FROM {values_sql(rows, columns)}"


@query(expected(fixtures.EXPECT_PROBE, "district, website, staff_directory_url, method, status"))
def directory_probe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crawl.resolve_directories(values(spark, fixtures.DISTRICTS, "district string, website string"), crawl.fetched(store(spark)))


@query(expected(fixtures.EXPECT_CRAWL, "school_id, url, rank"))
def directory_crawl(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crawl.find_directories(values(spark, fixtures.DISTRICTS, "school_id string, school_url string"), crawl.fetched(store(spark)))


@query(expected(fixtures.EXPECT_SCHOOLS, "district, url, name"))
def sitemap_harvest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crawl.discover_schools(values(spark, fixtures.DISTRICTS, "district string, website string"), crawl.fetched(store(spark))).select("district", "url", "name")


@query(expected(fixtures.EXPECT_CASCADE, "url, strategy, name, title, email"))
def extract_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = store(spark).where(F.contains("url", F.lit("/people/"))).select(F.lit("D").alias("district"), F.lit("S").alias("school"), F.lit("").alias("school_url"), "url", "html", F.lit(0).alias("ord"))
    return extract.employees(extract.raw_people(pages)).select(F.col("directory_url").alias("url"), "strategy", "name", "title", "email")


@query(expected(fixtures.EXPECT_FOLLOW, "id, url, page"))
def pagination_walk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crawl.follow_pages(values(spark, fixtures.WALKS, "id int, url string"), crawl.fetched(store(spark)))


@query(expected(fixtures.EXPECT_FINALSITE, "school, first_name, last_name, email, role, lead_type"))
def finalsite_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    profiles = values(spark, fixtures.PROFILES, "district_name string, staff_directory_url string, cms string, ord int")
    return pipelines.finalsite(profiles, store(spark)).select("school", "first_name", "last_name", "email", "role", "lead_type")


@query(expected(fixtures.EXPECT_FOXBRIGHT, "district, school, first_name, last_name, email, role, lead_type"))
def foxbright_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pipelines.foxbright(values(spark, fixtures.FOXBRIGHT, "district string, url string"), store(spark))


@query(expected(fixtures.EXPECT_ENRICH, "name, email"))
def enrich_from_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = values(spark, fixtures.PEOPLE, "name string, first_name string, last_name string, email string, profile_url string, directory_url string, ord int, pos int")
    return extract.fill_emails(people, crawl.fetched(store(spark))).select("name", "email")


@query(expected(fixtures.EXPECT_HITS, "email, name, source"))
def email_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.email_hits(store(spark).where(F.endswith("url", F.lit("/hits")))).select("email", "name", "source")


@query(expected(fixtures.EXPECT_STYLES, "url, dir_style, n_mailto, n_table_rows, n_cards"))
def fingerprint_styles(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = extract.fingerprint(store(spark).where(F.contains("url", F.lit("/style/"))).select("url", "html"))
    return rows.select("url", "dir_style", "n_mailto", "n_table_rows", "n_cards")


@query(expected(fixtures.EXPECT_HANDLES, "handle, key"))
def handle_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = values(spark, fixtures.HANDLE_PEOPLE, "district string, cid string, key string, first_name string, last_name string, page int, pos int")
    return vendors.match_handles(values(spark, fixtures.HANDLES, "district string, handle int, cid string, shown string"), people).select("handle", "key")


@query(expected(fixtures.EXPECT_DISTRICTS, "district_number, district_name, county, region, website"))
def district_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.createDataFrame([(*r, i) for i, r in enumerate(fixtures.EXPORT)], [*fixtures.EXPORT_HEADERS, "ord"])
    tidy = districts.tidy_export(rows.drop("ord"))
    return districts.load_districts(tidy.withColumn("ord", F.monotonically_increasing_id()))


@query(expected(fixtures.EXPECT_FAN_OUT, "district, school, url"))
def district_fan_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = values(spark, fixtures.KNOWN, "district string, website string, known_url string")
    return crawl.fan_out(rows, crawl.fetched(store(spark))).select("district", "school", "url")


@query(expected(fixtures.EXPECT_TARGETS, "district_name, staff_directory_url, cms"))
def campus_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crawl.campus_targets(values(spark, fixtures.DISTRICTS, "district string, website string"), crawl.fetched(store(spark)))


@query(expected(fixtures.EXPECT_LEADS, "district, school, first_name, last_name, email, role, lead_type"))
def district_leads(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = values(spark, fixtures.KNOWN, "district string, website string, known_url string")
    return extract.leads(pipelines.leads(rows, store(spark))).select("district", "school", "first_name", "last_name", "email", "role", "lead_type")


_PROFILES_SQL = "p AS (SELECT c_custkey AS id, c_custkey % 7 AS n_mailto, CASE c_custkey % 3 WHEN 0 THEN 'table' WHEN 1 THEN 'cards' END AS dir_style, CASE WHEN c_custkey % 5 > 0 THEN c_custkey % 5 = 1 END AS austin_like FROM customer)"


def _profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    style, like = F.when(key % 3 == 0, "table").when(key % 3 == 1, "cards"), F.when(key % 5 > 0, key % 5 == 1)
    return table(spark, sf_dir, "customer").select(key.alias("id"), (key % 7).alias("n_mailto"), style.alias("dir_style"), like.alias("austin_like"))


@query(f"WITH {_PROFILES_SQL} SELECT id, n_mailto, dir_style FROM p WHERE n_mailto >= 3 AND dir_style = 'table'")
def profile_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.of_style(relational.with_addresses(_profiles(spark, sf_dir)), "table").select("id", "n_mailto", "dir_style")


@query(f"WITH {_PROFILES_SQL} SELECT count(*) FILTER (WHERE austin_like) AS austin_like FROM p")
def profile_austin_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.true_counts(_profiles(spark, sf_dir), ["austin_like"])
