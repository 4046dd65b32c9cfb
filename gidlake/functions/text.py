"""Text expressions: truthiness, normalisation, ids in links, URLs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Label fragments and the record field each one names, in match order.
LABEL_FIELDS = [
    ("project", "project_name"),
    ("operator", "operator"),
    ("commodit", "commodities"),
    ("stage", "stage"),
    ("ticker", "ticker_exchange"),
]


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def coalesce_truthy(*cols: Column) -> Column:
    """First value that is neither null nor ''; the last one is returned as it is."""
    return F.coalesce(*[blank_to_null(c) for c in cols[:-1]], cols[-1])


def collapse_spaces(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def normalize_text(c: Column) -> Column:
    """trimmed, single-spaced, lower case (Unicode spaces included)."""
    return F.lower(collapse_spaces(c))


def proper_case(c: Column) -> Column:
    """F02."""
    return F.initcap(collapse_spaces(c))


def slug(c: Column) -> Column:
    """blanks and slashes become dashes, punctuation goes, '&' is spelled out."""
    kept = F.translate(F.lower(c), " /.,()'\"", "--")
    return F.replace(kept, F.lit("&"), F.lit("and"))


def gid_from_link(link: Column, parameter: str = "gid") -> Column:
    """the digits after `?gid=` / `&gid=` (or another parameter); null without any."""
    return blank_to_null(F.regexp_extract(link, rf"[?&]{parameter}=(\d+)", 1))


def gid_anywhere(link: Column) -> Column:
    """F04, loose form used for ownership cells: `gid=` at any place."""
    return blank_to_null(F.regexp_extract(link, r"gid=(\d+)", 1))


def gid_after(link: Column, marker: str) -> Column:
    """F04, split form: everything between `<marker>?gid=` and the next '&'."""
    return F.when(F.contains(link, F.lit(f"{marker}?gid=")),
                  F.regexp_extract(link, rf"{marker}\?gid=([^&]*)", 1))


def absolute_url(base: Column, href: Column) -> Column:
    """href resolved against base."""
    scheme = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1)
    origin = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    path = F.regexp_extract(base, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    query = F.regexp_extract(base, r"(\?[^#]*)", 1)
    folder = F.regexp_extract(path, r"^(.*/)", 1)
    target = F.when(href.startswith("/"), href).otherwise(
        F.concat(coalesce_truthy(folder, F.lit("/")), href))
    return (
        F.when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), href)
        .when(href.startswith("//"), F.concat(scheme, F.lit(":"), href))
        .when(href == "", base)
        .when(href.startswith("#"), F.concat(origin, path, query, href))
        .when(href.startswith("?"), F.concat(origin, path, href))
        .otherwise(F.concat(origin, _without_dot_segments(target)))
    )


def _without_dot_segments(target: Column) -> Column:
    path = F.regexp_extract(target, r"^([^?#]*)", 1)
    rest = F.regexp_extract(target, r"^[^?#]*(.*)$", 1)

    def step(kept: Column, part: Column) -> Column:
        up = F.slice(kept, F.lit(1), F.greatest(F.size(kept) - 1, F.lit(1)))
        return F.when(part == "..", up).when(part == ".", kept).otherwise(F.array_append(kept, part))

    walked = F.aggregate(F.split(path, "/"), F.array().cast("array<string>"), step)
    ends_in_dots = path.rlike(r"/\.{1,2}$")
    joined = F.concat(F.array_join(walked, "/"), F.when(ends_in_dots, F.lit("/")).otherwise(F.lit("")))
    return F.when(path.rlike(r"/\.{1,2}(/|$)"), F.concat(joined, rest)).otherwise(target)


def dash_to_null(c: Column) -> Column:
    """'' and '-' mean no value."""
    return F.nullif(blank_to_null(c), F.lit("-"))


def label_field(label: Column) -> Column:
    """which record field a cell label names, or null."""
    low = F.lower(label)
    (key, name), *others = LABEL_FIELDS
    first = F.when(F.contains(low, F.lit(key)), F.lit(name))
    return reduce(lambda c, kv: c.when(F.contains(low, F.lit(kv[0])), F.lit(kv[1])), others, first)


def list_to_string(values: Column) -> Column:
    """sorted values joined with ', ' (set order is undefined, so it is fixed here)."""
    return F.array_join(F.sort_array(values), ", ")


def split_list(c: Column) -> Column:
    """F16: comma list -> trimmed, non-empty items."""
    return F.filter(F.transform(F.split(c, ","), lambda t: F.trim(t)), lambda t: t != "")


def location_country(location: Column) -> Column:
    """Last token of a ', ' list; null for null or ''."""
    return F.when(location != "", F.element_at(F.split(location, ", "), -1))


def location_state(location: Column) -> Column:
    """First token, only when the location has more than one."""
    return F.when(F.contains(location, F.lit(", ")), F.element_at(F.split(location, ", "), 1))
