"""Addresses, phone numbers and URLs."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any
from urllib.parse import parse_qs, urlencode, urljoin, urlsplit, urlunsplit

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from dirlens.functions import text, words


def email(c: Column) -> Column:
    """Lower-cased address without mailto: and parameters, or null if it is none."""
    bare = text.strip(c)
    bare = F.when(F.startswith(F.lower(bare), F.lit("mailto:")), F.substr(bare, F.lit(8))).otherwise(bare)
    bare = F.lower(text.strip(F.get(F.split(bare, r"\?"), F.lit(0))))
    return F.when(F.rlike(bare, F.lit(f"^{words.EMAIL}$")), bare)


def strict_email(c: Column) -> Column:
    """As found in text: marks at the ends go, and hosts and endings of page parts are refused."""
    bare = F.lower(F.regexp_replace(text.strip(c), r"^[.,;:]+|[.,;:]+$", ""))
    return F.when(F.rlike(bare, F.lit(f"^{words.EMAIL}$")) & ~text.any_of(bare, words.BAD_DOMAINS) & ~text.ends_with_any(bare, words.IMAGE_ENDINGS), bare)


def phone(c: Column) -> Column:
    """struct(phone, extension): (ddd) ddd-dddd, or the cleaned text where there are no ten digits."""
    mark = r"(?:ext|extension|x)\.?\s*(\d+)"
    extension = text.blank_to_null(F.regexp_extract(c, f"(?i){mark}", 1))
    body = F.when(extension.isNotNull(), F.regexp_replace(c, f"(?is){mark}.*$", "")).otherwise(c)
    digits = F.regexp_replace(body, r"\D", "")
    ten = F.when((F.length(digits) == 11) & F.startswith(digits, F.lit("1")), F.substr(digits, F.lit(2))).otherwise(digits)
    shown = F.concat(F.lit("("), F.substring(ten, 1, 3), F.lit(") "), F.substring(ten, 4, 3), F.lit("-"), F.substring(ten, 7, 4))
    out = F.when(F.length(ten) == 10, shown).otherwise(text.blank_to_null(text.clean(body)))
    return F.struct(F.when(c != "", out).alias("phone"), extension.alias("extension"))


def find_phones(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit(f"({words.PHONE})"), 1)


def decode_hex(c: Column) -> Column:
    """The text hidden as hex pairs, each combined by exclusive or with the first; null if it isn't hex."""
    good = F.rlike(c, F.lit("^[0-9a-fA-F]{3,}$"))
    safe = F.when(good, c).otherwise("000")
    key = F.conv(F.substring(safe, 1, 2), 16, 10).cast("int")
    pairs = F.transform(F.sequence(F.lit(3), F.length(safe), F.lit(2)), lambda i: F.char(F.conv(F.substr(safe, i, F.lit(2)), 16, 10).cast("int").bitwiseXOR(key)))
    return F.when(good, F.array_join(pairs, ""))


def hidden_emails(c: Column) -> Column:
    """Addresses written as "user (at) host dot org": valid ones in order, each once."""
    # the pattern goes back and forth over a whole text, so texts without its middle are left out first
    likely = F.when(F.rlike(c, F.lit(r"(?i)@|\[at\]|\(at\)|\sat\s")), c)
    found = F.coalesce(F.regexp_extract_all(likely, F.lit(f"(?i){words.HIDDEN_EMAIL}"), 0), F.array().cast("array<string>"))
    made = F.transform(found, lambda m: email(F.regexp_replace(m, f"(?i)^{words.HIDDEN_EMAIL}$", "$1@$2.$3")))
    return F.array_distinct(F.filter(made, lambda e: e.isNotNull()))


def at_dot_emails(c: Column) -> Column:
    """As hidden_emails, by the looser pattern and the strict test."""
    found = F.regexp_extract_all(c, F.lit(f"(?i){words.AT_DOT}"), 0)

    def one(m: Column) -> Column:
        local = F.regexp_extract(m, f"(?i){words.AT_DOT}", 1)
        host = F.regexp_replace(F.regexp_replace(F.regexp_extract(m, f"(?i){words.AT_DOT}", 2), f"(?i){words.DOT}", "."), r"\s+", "")
        return strict_email(F.concat(local, F.lit("@"), host))

    return F.array_distinct(F.filter(F.transform(found, one), lambda e: e.isNotNull()))


def best_email(emails: Column, first: Column, last: Column) -> Column:
    """The first address whose local part holds the last or the first name, else the first of all."""

    def holds(local: Column, name: Column) -> Column:
        low = F.lower(F.coalesce(name, F.lit("")))
        return (low != "") & F.contains(local, low)

    own = F.filter(emails, lambda e: holds(F.lower(F.split_part(e, F.lit("@"), F.lit(1))), last) | holds(F.lower(F.split_part(e, F.lit("@"), F.lit(1))), first))
    return F.coalesce(F.get(own, F.lit(0)), F.get(emails, F.lit(0)))


def constructed_email(pattern: str, first: Column, last: Column, domain: Column) -> Column:
    """An address by a pattern of {first}, {last}, {f}, {l}; callers flag it as constructed."""
    out = F.lit(pattern)
    for key, value in (("{first}", first), ("{last}", last), ("{f}", F.substring(first, 1, 1)), ("{l}", F.substring(last, 1, 1))):
        out = F.replace(out, F.lit(key), F.regexp_replace(F.lower(value), "[^a-z]", ""))
    return F.concat(out, F.lit("@"), F.lower(domain))


def email_domain(c: Column) -> Column:
    return text.blank_to_null(F.lower(F.split_part(c, F.lit("@"), F.lit(2))))


def host(c: Column) -> Column:
    """Lower-cased network location, port included; '' where there is none."""
    return F.coalesce(F.lower(F.regexp_extract(c, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))


def root_host(c: Column) -> Column:
    """The last two labels of the host."""
    labels = F.split(F.get(F.split(host(c), ":"), F.lit(0)), r"\.")
    return F.array_join(F.slice(labels, -F.least(F.lit(2), F.size(labels)), 2), ".")


def same_site(a: Column, b: Column) -> Column:
    x, y = host(a), host(b)
    inside = F.endswith(x, F.concat(F.lit("."), y)) | F.endswith(y, F.concat(F.lit("."), x))
    return (x != "") & (y != "") & ((x == y) | inside | (root_host(a) == root_host(b)))


def looks_like_url(c: Column) -> Column:
    low = F.lower(F.coalesce(text.strip(c), F.lit("")))
    ends = (".org", ".net", ".com", ".edu", ".us")
    known = text.ends_with_any(low, ends) | text.any_of(low, [f"{e}/" for e in ends])
    bare = F.contains(low, F.lit(".")) & ~F.contains(low, F.lit(" ")) & (F.length(low) > 4) & ~F.contains(low, F.lit("@")) & known
    return F.startswith(low, F.lit("http")) | F.startswith(low, F.lit("www.")) | bare


def website(c: Column) -> Column:
    """With a scheme, https by default; null for addresses and for hosts without a dot."""
    bare = text.strip(c)
    full = F.when(F.startswith(F.lower(bare), F.lit("http")), bare).otherwise(F.concat(F.lit("https://"), F.regexp_replace(bare, "^/+", "")))
    return F.when((bare != "") & ~F.contains(bare, F.lit("@")) & F.contains(host(full), F.lit(".")), full)


def base_site(c: Column) -> Column:
    full = F.when(F.startswith(c, F.lit("http")), c).otherwise(F.concat(F.lit("https://"), c))
    site = F.regexp_extract(full, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]+)", 1)
    return F.when(site != "", F.regexp_replace(site, r"^[A-Z]+", F.lower(F.regexp_extract(site, r"^([A-Za-z]+)", 1)))).otherwise(F.regexp_replace(c, "/+$", ""))


def name_of_host(c: Column) -> Column:
    """A name for a district out of its host: the first label but www, each word capitalised."""
    label = F.get(F.split(F.regexp_replace(host(c), r"^www\.", ""), r"\."), F.lit(0))
    return F.array_join(F.transform(F.regexp_extract_all(label, F.lit(r"[A-Za-z]+|[^A-Za-z]+"), 0), lambda x: F.initcap(x)), "")


def join_url(base: str, address: str) -> str:
    try:
        return urljoin(base, address)
    except ValueError:
        return address


def with_parameter(url: str, key: str, value: str) -> str:
    """url with one query parameter set; of repeated parameters the first value stays."""
    parts = urlsplit(url)
    query = {k: v[0] for k, v in parse_qs(parts.query).items()} | {key: value}
    return urlunsplit(parts._replace(query=urlencode(query)))


def _text_function(make: Callable[[str | None, Any], str]) -> Callable[..., Column]:
    """A column function of two columns; null where the second or, with no base to join to, the first is null."""

    def call(first: Column | str, second: Column | str) -> Column:
        def rows(a: pa.Array, b: pa.Array) -> pa.Array:
            return pa.array([None if y is None else make(x, y) for x, y in zip(a.to_pylist(), b.to_pylist(), strict=True)], pa.string())

        # a join on the result would work it out twice, the first time for its filter of nulls, by a second Python worker
        return F.arrow_udf(rows, "string").asNondeterministic()(first, second)

    return call


url_join = _text_function(lambda base, address: join_url(base or "", address))
#: url with const_page set to the page.
set_page = _text_function(lambda url, page: with_parameter(url or "", "const_page", str(page)))
