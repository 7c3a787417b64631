"""Scalar functions as column expressions; all run inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from placeflow.schemas import NOT_FOUND

# Fixed value: what an hours status says of an open place.
OPEN = "진료 중"

#: Characters that Python's str.strip() removes.
_SPACE = r"[\x{09}-\x{0D}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_str(c: Column | str, default: str = NOT_FOUND, longest: int | None = None) -> Column:
    """Null or empty becomes the default; over `longest` characters are cut and marked by '...'."""
    v = F.coalesce(F.nullif(col(c).cast("string"), F.lit("")), F.lit(default))
    return v if longest is None else F.when(F.length(v) > longest, F.concat(F.left(v, F.lit(longest)), F.lit("..."))).otherwise(v)


def clean_id(c: Column | str) -> Column:
    """The id as text, without a trailing '.0'."""
    return F.regexp_replace(col(c).cast("string"), r"\.0$", "")


def place_id(url: Column | str) -> Column:
    """Digits after /place/; null without them."""
    return F.nullif(F.regexp_extract(col(url), r"/place/(\d+)", 1), F.lit(""))


def place_url(url: Column | str) -> Column:
    """The URL up to the place's id; null without one."""
    return F.nullif(F.regexp_extract(col(url), r"^(.*?/place/\d+)", 1), F.lit(""))


def quote(c: Column | str) -> Column:
    """Percent-encoding that leaves letters, digits, '_.-~' and '/' alone."""
    out = F.url_encode(col(c))
    for a, b in (("+", "%20"), ("%2F", "/"), ("%7E", "~"), ("*", "%2A")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def search_term(location: Column | str, query: Column | str) -> Column:
    return F.concat(col(location), F.lit(" "), col(query))


def strip(c: Column | str) -> Column:
    """Without white space (also beyond ASCII) at both ends."""
    return F.regexp_replace(col(c), f"^{_SPACE}+|{_SPACE}+$", "")


def join_or_na(items: Column | str, sep: str = ", ") -> Column:
    return F.coalesce(F.nullif(F.array_join(col(items), sep), F.lit("")), F.lit(NOT_FOUND))


def first_line(c: Column | str) -> Column:
    return F.substring_index(col(c), "\n", 1)


def without(c: Column | str, part: Column | str) -> Column:
    """c without every occurrence of part, stripped."""
    return strip(F.replace(col(c), col(part), F.lit("")))


def preview(c: Column | str, n: int) -> Column:
    return F.concat(F.left(col(c), F.lit(n)), F.lit("..."))


def has_any(c: Column | str, words: list[str]) -> Column:
    """Whether the text contains one of the words; null counts as the not-found text."""
    return F.exists(F.array(*[F.lit(w) for w in words]), lambda w: F.contains(safe_str(c), w))


def first_of(*ways: Column | str) -> Column:
    """The first of several ways that gives a value (an empty text is none)."""
    return F.coalesce(*[F.nullif(col(w), F.lit("")) for w in ways])


def in_district(address: Column | str, district: str) -> Column:
    """Whether an address names a district; null doesn't."""
    return F.coalesce(F.contains(col(address), F.lit(district)), F.lit(False))


def filled(c: Column | str) -> Column:
    """Whether there is a value: neither null, nor empty, nor the not-found text."""
    return F.coalesce((col(c) != "") & (col(c) != NOT_FOUND), F.lit(False))


def open_now(status: Column | str) -> Column:
    """Whether an hours status says that a place is open."""
    return F.coalesce(F.contains(col(status), F.lit(OPEN)), F.lit(False))


def accessible(flag: Column | str) -> Column:
    """Whether the wheelchair flag is set; null isn't."""
    return F.coalesce(col(flag), F.lit(False))


def has_pattern(c: Column | str, pattern: str) -> Column:
    """Regular expression search; null is false."""
    return F.coalesce(F.rlike(col(c), F.lit(pattern)), F.lit(False))


def dong_key(gu: Column | str, dong: Column | str) -> Column:
    return F.concat_ws("_", col(gu), col(dong))


def json_array(items: Column | str) -> Column:
    """JSON text of an array of strings with ', ' between items and other scripts unescaped; null is the empty array."""
    one = F.transform(col(items), lambda x: F.when(x.isNull(), F.lit("null")).otherwise(F.regexp_extract(F.to_json(F.array(x)), r"(?s)^\[(.*)\]$", 1)))
    return F.concat(F.lit("["), F.array_join(F.coalesce(one, F.array().cast("array<string>")), ", "), F.lit("]"))


def grouped(c: Column | str, decimals: int = 0) -> Column:
    """1234567 as 1,234,567."""
    return F.format_number(col(c), decimals)


def padded(c: Column | str, width: int = 3) -> Column:
    return F.lpad(col(c).cast("string"), width, "0")


def number(c: Column | str) -> Column:
    """The digits of counts written as text ('1,870', '3명') as a number; null without digits."""
    return F.nullif(F.regexp_replace(col(c), r"[^0-9]", ""), F.lit("")).try_cast("bigint")


def mebibytes(c: Column | str) -> Column:
    return col(c) / F.lit(1048576)


def visit_date(c: Column | str) -> Column:
    """month, day and weekday of a date without a year such as '12.11.목'; null if it isn't one."""
    m = [F.regexp_extract(col(c), r"^(\d{1,2})\.(\d{1,2})\.(\D+)$", i) for i in (1, 2, 3)]
    return F.when(m[0] != "", F.struct(m[0].try_cast("int").alias("month"), m[1].try_cast("int").alias("day"), m[2].alias("weekday")))


def stamp(now: Column | None = None, pattern: str = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS") -> Column:
    """The time as text; give `now` where results must repeat."""
    return F.date_format(F.current_timestamp() if now is None else now, pattern)


def parsed_time(c: Column | str) -> Column:
    return F.try_to_timestamp(col(c))
