"""Column -> Column functions of the document decoders. All run inside the JVM."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def snake_name(name: str) -> str:
    """Plan-time twin of `camel_to_snake` for names known in advance."""
    out = name[:1]
    for letter in name[1:]:
        out += "_" + letter if "A" <= letter <= "Z" else letter
    return out.lower()


def camel_to_snake(name: Column) -> Column:
    """averageHR -> average_h_r, time5K -> time5_k."""
    return F.lower(F.regexp_replace(name, "(?<!^)(?=[A-Z])", "_"))


def epoch_ms_to_timestamp(ms: Column) -> Column:
    """Milliseconds since the epoch (number or text) as an instant; microseconds are kept."""
    return F.timestamp_micros((ms.try_cast("decimal(18,3)") * 1000).cast("bigint"))


def iso_to_utc_timestamp(text: Column) -> Column:
    """ISO text read as UTC wall clock; a zone suffix is dropped, unreadable text gives NULL."""
    return text.try_cast("timestamp_ntz").cast("timestamp")


def iso_to_instant(text: Column) -> Column:
    """ISO text whose offset counts; without an offset it is UTC."""
    return text.try_cast("timestamp")


def timezone_offset_hours(local: Column, utc: Column) -> Column:
    """Local minus UTC in hours; quarter and half hour zones keep their fraction."""
    return (F.unix_micros(local) - F.unix_micros(utc)) / F.lit(3_600_000_000.0)


def derive_end_timestamp(end: Column, start: Column, duration_seconds: Column) -> Column:
    """The stated end, else start plus duration; NULL if neither is known."""
    length = F.round(duration_seconds * F.lit(1_000_000.0)).cast("bigint")
    return F.coalesce(end, F.timestamp_micros(F.unix_micros(start) + length))


def empty_to_null(text: Column) -> Column:
    return F.when(text != "", text)


def lowercase_or_null(text: Column) -> Column:
    return F.lower(empty_to_null(text))


def parse_date_or_null(text: Column) -> Column:
    return empty_to_null(text).try_cast("date")


def first_map_entry(entries: Column) -> Column:
    """First value of a map in document order (not VARIANT: that sorts its keys)."""
    return F.try_element_at(F.map_values(entries), F.lit(1))


def null_safe_difference(end: Column, start: Column) -> Column:
    return end - start


def lookup_label(key: Column, labels: Mapping[int, str]) -> Column:
    """Label of a type id; an unknown id gives NULL and its row stays."""
    pairs = [F.lit(part) for item in labels.items() for part in item]
    return F.try_element_at(F.create_map(*pairs), key)


def conditional_null_reference(reference: Column, kind: Column, without: Iterable[int]) -> Column:
    """NULL for the kinds that refer to nothing."""
    return F.when(~kind.isin(*without), reference)


def numeric_kind(variant: Column) -> Column:
    """TRUE for a number or boolean value; a quoted number is text."""
    kind = F.schema_of_variant(variant)
    return kind.isin("BIGINT", "DOUBLE", "FLOAT", "BOOLEAN") | kind.startswith("DECIMAL")


def numeric_to_double(variant: Column) -> Column:
    """Number or boolean (TRUE = 1.0) as DOUBLE, any other kind NULL."""
    return F.when(numeric_kind(variant), F.try_variant_get(variant, "$", "double"))


# Texts that read as a float: digits may be grouped with single underscores, case does not matter.
_DIGITS = r"\d(?:_?\d)*"
FLOAT_TEXT = (
    rf"(?i)^\s*[+-]?(?:(?:{_DIGITS}(?:\.(?:{_DIGITS})?)?|\.{_DIGITS})(?:e[+-]?{_DIGITS})?"
    r"|inf|infinity|nan)\s*$"
)


# The usual spelling, which needs no closer look: what casts is a float, and so is its text.
PLAIN_TEXT = r"^[-+.0-9eE]+$"


def cast_or_skip(text: Column) -> Column:
    """Text as DOUBLE where it reads as a float, else NULL (callers drop those rows)."""
    plain = F.regexp_replace(F.trim(text), "_", "")
    return F.when(text.rlike(FLOAT_TEXT), plain.try_cast("double"))


def numbered_items(items: Column, name: Column) -> Column:
    """Array -> array of (name_i, item): i counts every element, NULL elements give no entry."""
    tagged = F.transform(
        items,
        lambda item, i: F.struct(
            F.concat(name, F.lit("_"), (i + 1).cast("string")).alias("name"), item.alias("value")
        ),
    )
    return F.filter(tagged, lambda entry: entry["value"].isNotNull())


def error_message_of(rule: Column, detail: Column) -> Column:
    """Short error text of a failed file: the first thing that was wrong with it."""
    return F.concat_ws(": ", rule, detail)


def assign_int(raw: Column) -> Column:
    """Raw JSON text into an integer column: a fraction is rounded, half away from zero."""
    number = raw.try_cast("decimal(30,6)")
    return F.round(number).try_cast("int")


def assign_long(raw: Column) -> Column:
    return F.round(raw.try_cast("decimal(30,6)")).try_cast("bigint")


def assign_double(raw: Column) -> Column:
    return F.when(raw.rlike(PLAIN_TEXT) | raw.rlike(FLOAT_TEXT), raw.try_cast("double"))


def assign_boolean(raw: Column) -> Column:
    return F.when(raw.isin("true", "false"), raw.cast("boolean"))


def assign_date(raw: Column) -> Column:
    return raw.try_cast("date")


def assign(raw: Column, kind: str) -> Column:
    """Raw JSON text -> column of `kind`; NULL if the text does not fit the kind."""
    if kind == "string":
        return raw
    return {
        "int": assign_int,
        "bigint": assign_long,
        "double": assign_double,
        "boolean": assign_boolean,
        "date": assign_date,
    }[kind](raw)


def unfit(raw: Column, kind: str) -> Column:
    """TRUE when a present value does not fit its column; such a value fails its file set."""
    return raw.isNotNull() & assign(raw, kind).isNull()


# The same rules as SQL text: documents have lists of up to a hundred fields, and one expression per
# list is much quicker to build than a hundred column objects.
_ASSIGN_SQL = {
    "string": "{x}",
    "int": "try_cast(round(try_cast({x} as decimal(30,6))) as int)",
    "bigint": "try_cast(round(try_cast({x} as decimal(30,6))) as bigint)",
    "double": "case when {x} rlike r'" + PLAIN_TEXT + "' or {x} rlike r'" + FLOAT_TEXT + "' then try_cast({x} as double) end",
    "boolean": "case when {x} in ('true', 'false') then cast({x} as boolean) end",
    "date": "try_cast({x} as date)",
}


def assign_sql(path: str, kind: str) -> str:
    return _ASSIGN_SQL[kind].replace("{x}", path)


def unfit_sql(path: str, kind: str) -> str:
    return f"({path} is not null and ({assign_sql(path, kind)}) is null)"
