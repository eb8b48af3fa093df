"""Person names: labels, splitting, and telling people from schools, titles and menu entries."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from dirlens.functions import text, words


def strip_label(c: Column) -> Column:
    """Each leading label once, in their order; null stays null."""
    def without(shown: Column, label: Column) -> Column:
        return F.when(F.startswith(F.lower(shown), label), text.strip(F.substr(shown, F.length(label) + 1))).otherwise(shown)

    return F.when(c.isNotNull(), F.aggregate(text.strings(words.LABELS), text.clean(c), without))


def _bare(c: Column) -> Column:
    return F.upper(F.regexp_replace(c, r"[.\s]", ""))


def _is_credentials(chunk: Column) -> Column:
    tokens = text.words(chunk)
    return (F.size(tokens) > 0) & F.forall(tokens, lambda t: F.array_contains(text.strings(words.CREDENTIALS), _bare(t)))


def _without_honorific(tokens: Column) -> Column:
    def drop(t: Column) -> Column:
        leads = (F.size(t) >= 2) & F.array_contains(text.strings(words.HONORIFICS), _bare(F.get(t, F.lit(0))))
        return F.when(leads, F.slice(t, 2, F.size(t))).otherwise(t)

    return text.let(tokens, drop)


def split_name(c: Column) -> Column:
    """struct(first, last) of "First Last", "Last, First" and names with trailing credentials."""

    def split(kept: Column) -> Column:
        alone = _without_honorific(text.words(F.get(kept, F.lit(0))))
        after = _without_honorific(text.words(F.get(kept, F.lit(1))))
        swapped = F.size(kept) >= 2
        first = F.when(swapped, F.get(after, F.lit(0))).otherwise(F.get(alone, F.lit(0)))
        rest = text.let(alone, lambda a: F.when(F.size(a) >= 2, F.array_join(F.slice(a, 2, F.greatest(F.size(a), F.lit(1))), " ")))
        return F.struct(first.alias("first"), F.when(swapped, F.get(kept, F.lit(0))).otherwise(rest).alias("last"))

    def kept(chunks: Column) -> Column:
        named = F.array_max(F.transform(chunks, lambda x, i: F.when((i == 0) | ~_is_credentials(x), i + 1)))
        return F.when(F.size(chunks) > 0, F.slice(chunks, 1, F.greatest(F.coalesce(named, F.lit(1)), F.lit(1)))).otherwise(chunks)

    chunks = F.filter(F.transform(F.split(text.clean(c), ","), text.strip), lambda x: x != "")
    return text.let(text.let(chunks, kept), split)


def split_plain_name(c: Column) -> Column:
    """struct(first, last) of the first and the last word; one word is first, and last is ''."""
    tokens = text.words(text.clean(c))
    many = F.size(tokens) >= 2
    return F.struct(F.when(many, F.get(tokens, F.lit(0))).otherwise(text.clean(c)).alias("first"), F.when(many, F.element_at(tokens, -1)).otherwise("").alias("last"))


def is_junk(c: Column) -> Column:
    """Not a name: blank, a country, or what menus and headings hold."""
    countries = text.strings(words.COUNTRIES)

    def test(name: Column) -> Column:
        head = text.strip(F.get(F.split(F.lower(name), r"\s*[&(\-]"), F.lit(0)))
        return (name == "") | F.array_contains(countries, F.lower(name)) | F.coalesce(F.array_contains(countries, head), F.lit(False)) | F.rlike(name, F.lit(words.JUNK_PATTERN))

    return text.let(text.clean(c), test)


def has_role_word(c: Column) -> Column:
    return F.arrays_overlap(F.regexp_extract_all(F.lower(c), F.lit("[a-z]+"), 0), text.strings(words.ROLE_WORDS))


def looks_like_person(c: Column) -> Column:
    def test(name: Column) -> Column:
        wrong = text.let(F.lower(name), lambda low: text.any_of(low, words.SCHOOL_WORDS) | text.any_of(low, words.NOT_PERSON_WORDS))
        many = F.size(text.words(F.replace(name, F.lit(","), F.lit(" ")))) >= 2
        return (name != "") & ~wrong & ~F.coalesce(has_role_word(name), F.lit(False)) & F.rlike(name, F.lit("[A-Za-z]")) & many & (F.length(name) <= 60)

    return text.let(text.clean(c), test)
