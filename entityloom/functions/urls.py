"""Column functions on links."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from entityloom.functions.text import strip


def origin(url: Column) -> Column:
    """``https://host:port/`` of an absolute link, NULL for anything else."""
    scheme = F.lower(F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*)://", 1))
    authority = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)
    return F.when(scheme != "", F.concat(scheme, F.lit("://"), authority, F.lit("/")))


def host(url: Column) -> Column:
    """Lower-case host without user, port or a leading ``www.``."""
    authority = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.nullif(F.regexp_replace(F.lower(authority), r"^www\.", ""), F.lit(""))


def social_host(url: Column) -> Column:
    """The host of a link that may come without a scheme (``www.t.me/x``, ``t.me/x``)."""
    bare = F.regexp_replace(F.lower(strip(url)), r"^(https?://)?(www\.)?", "")
    return F.nullif(F.regexp_extract(bare, r"^([^/?#:]+)", 1), F.lit(""))


def _without_dots(path: Column) -> Column:
    """Resolve ``.`` and ``..`` segments of an absolute path."""
    segments = F.split(path, "/")
    kept = F.aggregate(
        segments,
        F.array().cast("array<string>"),
        lambda acc, s: F.when(s == ".", acc)
        .when(s == "..", F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(1))))
        .otherwise(F.concat(acc, F.array(s))),
    )
    ends_open = path.rlike(r"/\.{1,2}$")
    joined = F.array_join(kept, "/")
    return F.when(path.rlike(r"/\.{1,2}(/|$)"), F.when(ends_open, F.concat(joined, F.lit("/"))).otherwise(joined)).otherwise(path)


def resolve(base: Column, link: Column) -> Column:
    """Absolute form of ``link`` as found on a page whose address is ``base``."""
    ref = strip(link)
    root = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    scheme = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*:)//", 1)
    path = F.regexp_extract(base, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    folder = F.coalesce(F.nullif(F.regexp_extract(path, r"^(.*/)", 1), F.lit("")), F.lit("/"))
    ref_path = F.regexp_extract(ref, r"^([^?#]*)", 1)
    ref_tail = F.regexp_extract(ref, r"^[^?#]*(.*)$", 1)
    return (
        F.when(ref.isNull() | base.isNull(), None)
        .when(ref.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), ref)
        .when(ref.startswith("//"), F.concat(scheme, ref))
        .when(ref == "", base)
        .when(ref.startswith("?"), F.concat(root, path, ref))
        .when(ref.startswith("#"), F.concat(F.substring_index(base, "#", 1), ref))
        .when(ref.startswith("/"), F.concat(root, _without_dots(ref_path), ref_tail))
        .otherwise(F.concat(root, _without_dots(F.concat(folder, ref_path)), ref_tail))
    )


def before_ampersand(url: Column) -> Column:
    return F.substring_index(url, "&", 1)


def thread_base(url: Column) -> Column:
    """The part of a forum link up to its topic number, NULL where there is none."""
    return F.nullif(F.regexp_extract(url, r"^(.*topic=[0-9]*)", 1), F.lit(""))


def https(url: Column) -> Column:
    return F.replace(url, F.lit("http:"), F.lit("https:"))


def clean_link(url: Column) -> Column:
    """First word of a link field; a blank one is NULL."""
    return F.nullif(F.get(F.split(strip(url), r"\s+"), F.lit(0)), F.lit(""))
