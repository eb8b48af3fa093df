"""The page functions as Arrow column functions; each reads a page once and returns plain structs."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import _parse_datatype_string

from dirlens.html import pages, people
from dirlens.html.dom import parse

#: Bytes of pages that are read before their records are turned into Arrow.
PIECE = 256 * 1024


def in_pieces(read: Callable[..., Any], arrow: pa.DataType, html: pa.Array, *rest: pa.Array) -> pa.Array:
    """read of each page of a batch; of its pages and records only a piece stands as Python objects. A larger page stands alone."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(html), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    found, lo = [pa.array([], arrow)], 0
    while lo < len(html):
        before = ends[lo - 1] if lo else 0
        hi = max(lo + 1, min(lo + PIECE // 64, int(np.searchsorted(ends, before + PIECE, "right"))))
        found.append(pa.array([read(*x) for x in zip(*(a.slice(lo, hi - lo).to_pylist() for a in (html, *rest)), strict=True)], arrow))
        lo = hi
    return pa.concat_arrays(found)


def _per_page(kind: str, read: Callable[..., Any]) -> Callable[..., Column]:
    """A column function by read, made when it is called: its type needs a session to be parsed."""

    def call(*columns: Column | str) -> Column:
        arrow = to_arrow_type(_parse_datatype_string(kind))

        def one(a: pa.Array) -> pa.Array:
            return in_pieces(read, arrow, a)

        def two(a: pa.Array, b: pa.Array) -> pa.Array:
            return in_pieces(read, arrow, a, b)

        return F.arrow_udf(two if len(columns) == 2 else one, kind)(*columns)

    return call


PERSON = "struct<name:string,title:string,email:string,phone:string,dept:string,photo:string,profile:string>"
VENDOR_PERSON = "struct<pos:int,name:string,title:string,email:string,cid:string,photo:string,profile:string,campus_marked:string,campus_anywhere:string>"

links = _per_page("array<struct<pos:int,href:string,text:string,url:string>>", pages.links)
facts = _per_page("struct<n_mailto:int,n_table_rows:int,table_has_mail:boolean,n_cards:int,text_length:int,generator:string,is_directory:boolean,has_vendor_cards:boolean>", pages.facts)
directory = _per_page(f"struct<strategy:string,people:array<{PERSON}>,next_url:string,error:string>", people.read_directory)
sitemap = _per_page("array<struct<pos:int,kind:string,url:string>>", pages.sitemap)
vendor_people = _per_page(f"array<{VENDOR_PERSON}>", pages.vendor_people)
profile = _per_page("struct<email:string,department:string,location:string,title:string>", pages.profile)
foxbright_people = _per_page("array<struct<pos:int,name:string,building:string,position:string,email:string,url:string>>", pages.foxbright_people)
email_hits = _per_page("array<struct<name:string,title:string,email:string,source:string>>", people.email_hits)


def _page_emails(html: str | None) -> list[str]:
    return people.emails_of(parse(html))


def _plain_email(html: str | None) -> str | None:
    return pages.plain_email_of(parse(html))


page_emails = _per_page("array<string>", _page_emails)
plain_email = _per_page("string", _plain_email)
