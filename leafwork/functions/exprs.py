"""Column helpers with the parsing, rounding and formatting rules of the data contracts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Days between 0001-01-01 as day 1 and 1970-01-01.
EPOCH_ORDINAL = 719163


def strip(c: Column) -> Column:
    """Without white space at either end; trim() would take spaces only."""
    return F.regexp_replace(F.regexp_replace(c, r"^\s+", ""), r"\s+$", "")


def blank(c: Column) -> Column:
    return F.coalesce(strip(c.cast("string")) == "", F.lit(True))


def to_float(c: Column) -> Column:
    """A double from text with optional thousands commas; anything else, and what is not finite, is null."""
    text = F.regexp_replace(strip(c), ",", "")
    sane = text.rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$")
    value = F.when(sane, text.try_cast("double"))
    return F.when(~F.isnan(value) & (F.abs(value) < float("inf")), value)


def strict_int(c: Column, least: int = 0) -> Column:
    """An integer of digits only, without sign or leading zero; anything else is null."""
    value = F.when(c.rlike(r"^(0|[1-9][0-9]*)$"), c.try_cast("bigint"))
    return F.when(value >= least, value)


def strict_flag(c: Column) -> Column:
    """'1' and '0' as booleans; anything else is null."""
    return F.when(c.isin("0", "1"), c == "1")


def truthy(c: Column) -> Column:
    # The words that count as true.
    return F.coalesce(F.lower(strip(c)).isin("1", "true", "yes", "valid", "resolved", "accepted"), F.lit(False))


def iso_date(c: Column) -> Column:
    return F.when(c.rlike(r"^\d{4}-\d{2}-\d{2}$"), c.try_cast("date"))


def time_number(c: Column) -> Column:
    """A period as a number: a plain number, an ISO date as its day ordinal, or YYYY-MM as 12 * year + month."""
    text = strip(c)
    day = F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}([T ].*)?$"), F.substring(text, 1, 10).try_cast("date"))
    month = F.when(text.rlike(r"^\d{4}-(0[1-9]|1[0-2])$"), F.substring(text, 1, 4).try_cast("double") * 12 + F.substring(text, 6, 2).try_cast("double"))
    return F.coalesce(to_float(c), (F.unix_date(day) + EPOCH_ORDINAL).cast("double"), month)


def sym_ratio(a: Column, b: Column) -> Column:
    """max(|a/b|, |b/a|); equal values give 1, exactly one zero gives infinity, a null gives null."""
    big, small = F.greatest(F.abs(a), F.abs(b)), F.least(F.abs(a), F.abs(b))
    return F.when(a.isNull() | b.isNull(), None).when(a == b, 1.0).when(small == 0, float("inf")).otherwise(big / small)


def fmt_g(c: Column) -> Column:
    """A double as printf's %g writes it with six significant digits: no trailing zeros, an exponent where it is short."""
    value = c.cast("double")
    shown = F.format_string("%.5e", value)
    exponent = F.regexp_extract(shown, r"e([+-]\d+)$", 1).try_cast("int")
    mantissa = F.regexp_replace(F.regexp_replace(shown, r"e.*$", ""), r"\.?0+$", "")
    places = F.least(F.greatest(F.lit(0), 5 - exponent), F.lit(9))
    exact = F.element_at(F.array(*[F.format_string(f"%.{k}f", value) for k in range(10)]), places + 1)
    plain = F.when(exact.contains("."), F.regexp_replace(exact, r"\.?0+$", "")).otherwise(exact)
    short = F.concat(mantissa, F.regexp_extract(shown, r"(e[+-]\d+)$", 1))
    return F.when(value == 0, "0").when((exponent < -4) | (exponent >= 6), short).otherwise(plain)


def decimal_text(c: Column) -> Column:
    """A decimal without trailing zeros or exponent."""
    text = F.format_string("%s", c.cast("decimal(38,18)"))
    plain = F.when(c == 0, "0").otherwise(text)
    return F.when(plain.contains("."), F.regexp_replace(plain, r"\.?0+$", "")).otherwise(plain)


def wilson(successes: Column, n: Column, z: float = 1.96) -> tuple[Column, Column]:
    """Lower and upper bound of Wilson's interval; 0 and 1 for n = 0."""
    total = F.nullif(n.cast("double"), F.lit(0.0))
    p = successes / total
    middle, wide = p + z * z / (2 * total), z * F.sqrt(p * (1 - p) / total + z * z / (4 * total * total))
    below = 1 + z * z / total
    low, high = F.greatest(F.lit(0.0), (middle - wide) / below), F.least(F.lit(1.0), (middle + wide) / below)
    return F.when(n == 0, 0.0).otherwise(low), F.when(n == 0, 1.0).otherwise(high)


def slug(c: Column) -> Column:
    return F.btrim(F.regexp_replace(F.lower(c), r"[^a-z0-9]+", "_"), F.lit("_"))


def page_id(c: Column) -> Column:
    """struct(path, page) of '<path>.pdf#page=<n>' without a leading 'pdfs/'; null if absolute, with '..', or malformed."""
    text = F.regexp_replace(c, "^pdfs/", "")
    path, page = F.regexp_extract(text, r"^(.+)#page=([1-9][0-9]*)$", 1), F.regexp_extract(text, r"^(.+)#page=([1-9][0-9]*)$", 2)
    sane = text.rlike(r"^[^/\\][^\\]*\.pdf#page=[1-9][0-9]*$") & ~path.rlike(r"(^|/)\.\.(/|$)")
    return F.when(sane, F.struct(path.alias("path"), page.try_cast("int").alias("page")))


def entity_id(*parts: Column) -> Column:
    return F.concat(F.lit("bank:"), F.substring(F.sha2(F.concat_ws("\0", *[F.lower(F.coalesce(p, F.lit(""))) for p in parts]), 256), 1, 24))


def stable_id(prefix: str, size: int, *parts: Column) -> Column:
    """prefix and the first `size` digits of the SHA-256 of the parts, joined by NUL with nulls as empty."""
    return F.concat(F.lit(prefix), F.substring(F.sha2(F.concat_ws("\0", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]), 256), 1, size))


def wave(year: Column, edition: Column) -> Column:
    return (year * 2 + edition).cast("int")


def unwave(w: Column) -> tuple[Column, Column]:
    edition = F.when(F.pmod(w, F.lit(2)) == 0, 2).otherwise(1)
    return ((w - edition) / 2).cast("int"), edition.cast("int")


def sort_key(*parts: Column) -> Column:
    return F.concat_ws("|", *[F.lower(F.trim(p)) for p in parts])


def file_name(url: Column) -> Column:
    """The last path segment of a URL, percent-decoded; without query and fragment."""
    return F.url_decode(F.element_at(F.split(F.coalesce(F.parse_url(url, F.lit("PATH")), F.lit("")), "/"), -1))


def cap(n: Column, share: float, most: int) -> Column:
    """How many of `n` a share allows, at most `most`."""
    return F.least(F.floor(n * F.lit(share).cast("decimal(18,9)")).cast("long"), F.lit(most).cast("long"))
