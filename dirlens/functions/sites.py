"""What a page's source and address tell: system, vendor, directory style, campus, page counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from dirlens.functions import text, words


def _haystack(html: Column, url: Column) -> Column:
    return F.concat(F.lower(F.coalesce(html, F.lit(""))), F.lit(" "), F.lower(F.coalesce(url, F.lit(""))))


def cms(html: Column, url: Column) -> Column:
    return text.let(_haystack(html, url), lambda hay: text.first_hit([(text.any_of(hay, keys), F.lit(name)) for name, keys in words.CMS], F.lit("unknown")))


def vendor(html: Column, url: Column) -> Column:
    return text.let(_haystack(html, url), lambda hay: text.first_hit([(text.any_of(hay, keys), F.lit(name)) for name, keys in words.VENDORS], F.lit("")))


def directory_style(n_mailto: Column, n_table_rows: Column, table_has_mail: Column, n_cards: Column, text_length: Column) -> Column:
    stub = (text_length < 400) | ((n_cards == 0) & (n_table_rows < 2) & (n_mailto == 0))
    return text.first_hit(
        [
            ((n_table_rows >= 4) & (table_has_mail | (n_mailto >= 3)), F.lit("email_table")),
            ((n_cards >= 3) & (n_mailto >= 3), F.lit("card_grid_email")),
            ((n_cards >= 3) & (n_mailto == 0), F.lit("card_grid_no_email")),
            (n_mailto >= 5, F.lit("mailto_list")),
            (stub, F.lit("js_or_empty")),
        ],
        F.lit("unknown"),
    )


def austin_like(style: Column, generator: Column, vendor_host: Column, url: Column) -> Column:
    marked = F.contains(F.lower(generator), F.lit("drupal")) | vendor_host.isin("austinschools", "esc_regional") | F.endswith(F.regexp_replace(url, "/+$", ""), F.lit("/directory"))
    return (style == "email_table") & marked


def is_fetched(status: Column, content_type: Column) -> Column:
    """Whether a page store row counts as fetched: no error, and HTML, XML, JSON or no type at all."""
    kind = F.lower(F.coalesce(content_type, F.lit("")))
    return (status < 400) & ((kind == "") | text.any_of(kind, ("html", "xml", "json")))


def campus_of_photo(source: Column) -> Column:
    code = F.trim(F.regexp_extract(source, words.PHOTO_FOLDER, 1))
    return F.when((code != "") & ~F.lower(code).isin(*words.PHOTO_STOP), code)


def readable_campus(code: Column) -> Column:
    """The school level that a campus code tells, or the code itself; '' for null."""
    safe = F.coalesce(code, F.lit(""))
    return text.first_hit([(safe == "", F.lit("")), *[(F.rlike(safe, F.lit(f"(?i){p}")), F.lit(level)) for p, level in words.CAMPUS_LEVELS]], safe)


def tidy_campus(c: Column) -> Column:
    """Without leading role and connecting words, as long as more than two words are left."""
    tokens = text.words(c)
    stop = F.transform(tokens, lambda w: F.array_contains(text.strings(words.CAMPUS_STOP), F.regexp_replace(F.lower(w), r"^[.,]+|[.,]+$", "")))
    size = F.size(tokens)
    first_kept = F.coalesce(F.array_min(F.filter(F.transform(stop, lambda s, i: F.when(~s | (i >= size - 2), i)), lambda i: i.isNotNull())), F.lit(0))
    return F.array_join(F.slice(tokens, first_kept + 1, F.greatest(size, F.lit(1))), " ")


def campus(found: Column, photo: Column, default: Column) -> Column:
    return F.coalesce(text.blank_to_null(found), text.blank_to_null(readable_campus(campus_of_photo(photo))), default, F.lit(""))


def vendor_pages(html: Column, cap: int = 1000) -> Column:
    """Pages of a vendor directory, from "showing 1 - 12 of 4,487" or the highest page linked."""
    shown = r"(?i)showing\s+\d+\s*-\s*(\d+)\s+of\s+([\d,]+)"
    each = F.try_to_number(F.regexp_extract(html, shown, 1), F.lit("999999999")).cast("long")
    total = F.replace(F.regexp_extract(html, shown, 2), F.lit(","), F.lit(""))
    total = F.when(total != "", total).cast("long")
    linked = F.array_max(F.transform(F.regexp_extract_all(html, F.lit(r"const_page=(\d+)"), 1), lambda x: x.cast("long")))
    pages = F.when(each > 0, F.greatest(F.lit(1), F.ceil(total / each))).otherwise(F.coalesce(linked, F.lit(1)))
    return F.least(F.lit(cap), pages).cast("int")


def any_column(columns: list[str], *needles: str) -> str | None:
    """The first column whose name holds all needles, in any case."""
    return next((c for c in columns if all(n in c.lower() for n in needles)), None)


def either(conditions: list[Column]) -> Column:
    return reduce(Column.__or__, conditions)
