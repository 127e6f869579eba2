"""Column expressions used across operators."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def no_nan(value: Column) -> Column:
    """NaN as null; to be applied once, at the scan."""
    return F.nanvl(value, F.lit(None).cast("double"))


def decimal_comma(text: Column) -> Column:
    """A number written with a decimal comma or point; null if it isn't one."""
    return F.replace(F.trim(text), F.lit(","), F.lit(".")).try_cast("double")


def numeric(text: Column, missing_texts: Iterable[str] = ("***", "")) -> Column:
    """A text as a number; blanks, placeholders and anything else that isn't a number are null."""
    trimmed = F.trim(text)
    return F.when(~trimmed.isin(*missing_texts), trimmed.try_cast("double"))


def normal_key(text: Column) -> Column:
    """Lower case, single spaces, no quotes: how column headings and aliases are compared."""
    return F.lower(F.trim(F.regexp_replace(F.regexp_replace(text, "[\"']", ""), r"\s+", " ")))


def base_name(text: Column) -> Column:
    """Upper case name without its unit in brackets."""
    return F.trim(F.upper(F.regexp_replace(text, r"\(.*$", "")))


def without_copy_suffix(text: Column) -> Column:
    """A heading without the numbers that readers append to repeated headings, however many: HR.1.2 is HR."""
    return F.regexp_replace(text, r"(\.\d+)+$", "")


#: Accented letters and what they are compared as.
_ACCENTED, _PLAIN = "àâäáãåçéèêëíìîïñóòôöõúùûüýÿ", "aaaaaaceeeeiiiinooooouuuuyy"


def folded(text: Column) -> Column:
    """Lower case without accents, other signs as single spaces."""
    plain = F.translate(F.lower(text), _ACCENTED, _PLAIN)
    return F.trim(F.regexp_replace(plain, "[^a-z0-9]+", " "))


def micros(ts: Column) -> Column:
    """Microseconds since 1970 of a timestamp with or without time zone; zones play no part in the latter."""
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ts.cast("timestamp_ntz"))


def local_to_utc(local: Column, zone: str) -> Column:
    """A wall-clock timestamp of a zone as UTC; null where the clock shows that time twice or never.

    Spark alone picks an instant in both cases.
    """
    utc = F.to_utc_timestamp(local, zone)
    exists = F.from_utc_timestamp(utc, zone) == local
    twice = lambda hours: F.from_utc_timestamp(utc + F.expr(f"interval {hours} hour"), zone) == local
    return F.when(exists & ~twice(1) & ~twice(-1), utc)


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def slice_number(name: Column) -> Column:
    """The number of a slice in names like case-3.csv; null without one."""
    return F.regexp_extract(name, r"-(\d+)\.csv$", 1).try_cast("int")


def start_clock(name: Column, zone: str) -> Column:
    """The start in names that hold 1yyMMddHHmmssSSS, wall clock of the zone, as UTC."""
    stamp = F.regexp_extract(name, r"1(\d{12})(\d{3})", 1)
    millis = F.regexp_extract(name, r"1(\d{12})(\d{3})", 2).try_cast("int")
    local = F.try_to_timestamp(F.concat(F.lit("20"), F.nullif(stamp, F.lit(""))), F.lit("yyyyMMddHHmmss"))
    return F.timestamp_micros(F.unix_micros(local_to_utc(local, zone)) + millis * 1000)


def epoch(value: Column) -> Column:
    """A number of seconds or milliseconds since 1970 as a timestamp; the unit follows from its size."""
    return F.when(value > 1e11, F.timestamp_millis(value.cast("long"))).when(value > 1e7, F.timestamp_micros((value * 1e6).cast("long")))


def redacted(path: Column, known: Iterable[str]) -> Column:
    """A path whose segments outside ``known`` are shown by shape only: letters as a, digits as #."""
    shape = lambda s: F.regexp_replace(F.regexp_replace(s, "[A-Za-z]", "a"), r"\d", "#")
    return F.array_join(F.transform(F.split(path, "/"), lambda s: F.when(s.isin(*known), s).otherwise(shape(s))), "/")


def short_hash(text: Column, length: int = 8) -> Column:
    return F.left(F.sha2(text, 256), F.lit(length))


def versioned_key(key: Column, digest: Column) -> Column:
    """A key that never overwrites: the file's extension after .v2-<first 8 of the digest>."""
    extension = F.regexp_extract(key, r"(\.[^./]+)$", 1)
    stem = F.substring(key, F.lit(1), F.length(key) - F.length(extension))
    return F.concat(stem, F.lit(".v2-"), F.left(digest, F.lit(8)), extension)


# French month names, folded.
FRENCH_MONTHS = ("janvier", "fevrier", "mars", "avril", "mai", "juin", "juillet", "aout", "septembre", "octobre", "novembre", "decembre")


def french_date(text: Column) -> Column:
    """The date of a day, French month name and year; null for anything else."""
    plain = folded(text)
    part = lambda i: F.regexp_extract(plain, r"([0-9]{1,2})(?:er)? ([a-z]+)[.]? ([0-9]{4})", i)
    month = F.array_position(F.array(*[F.lit(m) for m in FRENCH_MONTHS]), part(2))
    return F.when(month > 0, F.try_to_date(F.concat_ws("-", part(3), month.cast("string"), part(1)), "yyyy-M-d"))


def block_hash(content: Column, block: int = 4 << 20) -> Column:
    """SHA-256 of the SHA-256 digests of a content's blocks, as cloud stores compute it; a content must fit in a row."""
    n = F.greatest(F.ceil(F.length(content) / block), F.lit(0)).cast("int")
    part = lambda i: F.sha2(F.substring(content, i * block + 1, F.lit(block)), 256)
    digests = F.when(n > 0, F.array_join(F.transform(F.sequence(F.lit(0), n - 1), part), "")).otherwise("")
    return F.sha2(F.unhex(digests), 256)
