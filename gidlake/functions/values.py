"""Numbers, ids, timestamps, JSON and enum checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gidlake.functions.text import blank_to_null, coalesce_truthy, normalize_text

# Spread of synthetic ids and the address keys that can name a state, in order.
SYNTHETIC_ID_BUCKETS = 100000
STATE_KEYS = ["state", "state_district", "region", "province", "territory"]


def pct_string(part: Column, whole: Column) -> Column:
    """part/whole as '12.3%', rounded half up in integers; '0.0%' for an empty whole."""
    n, d = part.cast("bigint"), whole.cast("bigint")
    tenths = F.floor((n * 2000 + d) / (d * 2)).cast("bigint")
    text = F.concat(F.floor(tenths / 10).cast("bigint").cast("string"), F.lit("."),
                    (tenths % 10).cast("string"), F.lit("%"))
    return F.when(d > 0, text).otherwise(F.lit("0.0%"))


def reverse_key(lat: Column, lon: Column) -> Column:
    """cache key of a coordinate pair."""
    return F.when(lat.isNotNull() & lon.isNotNull(), F.format_string("rev:%.8f,%.8f", lat, lon))


def forward_key(location: Column) -> Column:
    """Cache key of a location text."""
    return F.concat(F.lit("fwd:"), normalize_text(location))


def to_double(c: Column) -> Column:
    """'' and text that is no number become null."""
    return blank_to_null(F.trim(c)).try_cast("double")


def iso_format(ts: Column) -> Column:
    """ISO text of a zone-free timestamp; made from its text, so no session zone can shift it."""
    shown = ts.cast("timestamp_ntz").cast("string")
    return F.concat(F.replace(F.substring(shown, 1, 19), F.lit(" "), F.lit("T")), F.lit("."),
                    F.rpad(F.substring(shown, 21, 6), 6, "0"))


def zone_free_micros(ts: Column) -> Column:
    """Microseconds since 1970 of a zone-free timestamp, whatever the session zone."""
    seconds = F.hour(ts) * 3600 + F.minute(ts) * 60
    fraction = (F.extract(F.lit("SECOND"), ts) * 1000000).cast("bigint")
    return (F.unix_date(ts.cast("date")).cast("bigint") * 86400 + seconds) * 1000000 + fraction


def iso_parse(text: Column) -> Column:
    """ISO text back to a timestamp without zone."""
    return F.to_timestamp_ntz(text)


def run_clock(moment: str) -> Column:
    """the one 'now' of a run, the same literal in every row and on every retry."""
    return F.lit(moment).cast("timestamp_ntz")


def stable_bucket(c: Column) -> Column:
    """repeatable hash of a text modulo 100000."""
    return F.conv(F.substring(F.md5(c), 1, 7), 16, 10).cast("bigint") % SYNTHETIC_ID_BUCKETS


def synthetic_id(name: Column) -> Column:
    return F.concat(F.lit("operator_"), stable_bucket(name).cast("string"))


def to_json_full(c: Column) -> Column:
    """JSON with null fields kept."""
    return F.to_json(c, {"ignoreNullFields": "false"})


def map_get(values: Column, key: str, default: Column) -> Column:
    """a key absent from the map gives the default; a present null stays null."""
    return F.when(F.map_contains_key(values, key), F.try_element_at(values, F.lit(key))).otherwise(default)


def json_get(body: Column, path: str, data_type: str, default: Column) -> Column:
    """F18 on JSON text."""
    return F.coalesce(F.try_variant_get(F.try_parse_json(body), path, data_type), default)


def centroid_longitude(centroid: Column) -> Column:
    """Coordinates are [longitude, latitude]."""
    return F.try_element_at(centroid["coordinates"], F.lit(1))


def centroid_latitude(centroid: Column) -> Column:
    return F.try_element_at(centroid["coordinates"], F.lit(2))


def truthy(c: Column) -> Column:
    return F.coalesce(c != "", F.lit(False))


def needs_map(lat: Column, lon: Column) -> Column:
    """P18."""
    return lat.isNull() | lon.isNull()


def needs_reverse(lat: Column, lon: Column, state: Column) -> Column:
    """P18."""
    return ~needs_map(lat, lon) & ~truthy(state)


def needs_forward(lat: Column, lon: Column, state: Column, location: Column) -> Column:
    """P18."""
    return needs_map(lat, lon) & truthy(location) & ~truthy(state)


def address_state(address: Column) -> Column:
    """First usable state-like field."""
    return coalesce_truthy(*[address[k] for k in STATE_KEYS])


def address_iso(address: Column) -> Column:
    return coalesce_truthy(address["ISO3166-2-lvl4"], address["ISO3166-2-lvl6"])


def validate_enum(c: Column, allowed: list[str], name: str) -> Column:
    """P15, strict: an unknown value stops the job."""
    message = F.concat(F.lit(f"unknown {name}: "), c)
    return F.when(c.isNull() | c.isin(allowed), c).otherwise(F.raise_error(message).cast("string"))


def split_enum(df: DataFrame, column: str, allowed: list[str]) -> tuple[DataFrame, DataFrame]:
    """P15, lenient: (accepted rows, quarantined rows)."""
    known = F.coalesce(F.col(column).isin(allowed), F.lit(False))
    return df.filter(known), df.filter(~known)


def add_source(sources: Column, source: str) -> Column:
    """Set union of one more source."""
    return F.sort_array(F.array_union(F.coalesce(sources, F.array().cast("array<string>")), F.array(F.lit(source))))


def union_sources(one: Column, two: Column) -> Column:
    """The sources of both sets, sorted; nulls left out."""
    return F.sort_array(F.array_compact(F.array_union(one, two)))


def has_items(items: Column) -> Column:
    """whether a list has entries; a null list has none."""
    return F.coalesce(F.size(items), F.lit(0)) > 0


def add_error(errors: Column, error: Column) -> Column:
    """One more error at the end of the list."""
    return F.array_append(F.coalesce(errors, F.array().cast("array<string>")), error)
