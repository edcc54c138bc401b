"""Column -> Column helpers (F1-F14). All are built-in Spark expressions, so
they stay inside whole-stage codegen; none is a Python UDF."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NOT_AVAILABLE = "Not_Available"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def device_key(dtype) -> Column:
    """Lookup key of a ``brand/model`` device text.

    The text is trimmed and upper-cased and cut at its first ``/``. If the
    model already contains the brand, the model alone is the key, otherwise
    ``brand + ' ' + model``. Without a ``/`` the whole text is the key, a
    leading ``/`` gives the text after it, null stays null.
    """
    u = F.upper(F.trim(_col(dtype)))
    cut = F.locate("/", u)
    brand = F.when(cut > 0, F.substring_index(u, "/", 1)).otherwise(F.lit(""))
    model = F.when(cut > 0, u.substr(cut + 1, F.length(u))).otherwise(u)
    return F.when(model.contains(brand), model).otherwise(F.concat(brand, F.lit(" "), model))


def device_brand(dtype) -> Column:
    """Text before the first ``/`` of the upper-cased, trimmed device text;
    ``''`` when there is no ``/`` (F10)."""
    u = F.upper(F.trim(_col(dtype)))
    return F.when(F.locate("/", u) > 0, F.substring_index(u, "/", 1)).otherwise(
        F.when(u.isNotNull(), F.lit("")))


def url_sections(url, fixed: bool = False) -> tuple[Column, Column]:
    """First and second URL section, lower-cased and trimmed.

    Default mode keeps the legacy positions exactly: the search for the
    section start begins at character 8, a section counts only when a further
    ``/`` follows it, and when the slashes run out the lookup falls back to
    the text before the first ``/`` (e.g. ``http:``). In ``https://h/a/b/``
    character 8 is the second slash of the scheme, so the sections are ``h``
    and ``a``.

    ``fixed=True`` takes the first two segments of the URL path instead.
    """
    u = _col(url)
    if fixed:
        # try_: under ANSI a malformed URL would fail the job; it gives null instead
        segs = F.split(F.regexp_replace(F.try_parse_url(u, F.lit("PATH")), "^/", ""), "/", -1)
        s1, s2 = F.get(segs, 0), F.get(segs, 1)
        clean = lambda c: F.lower(F.trim(F.coalesce(c, F.lit(""))))
        return (F.when(u.isNull(), None).otherwise(clean(s1)),
                F.when(u.isNull(), None).otherwise(clean(s2)))

    return _sections_from_parts(u, F.split(u, "/", -1), F.size(F.split(F.substring(u, 1, 7), "/", -1)))


def _sections_from_parts(u: Column, parts: Column, first_late: Column) -> tuple[Column, Column]:
    """``parts``: the URL split on ``/``; ``first_late``: ordinal (1-based)
    of the first slash at character 8 or later."""
    slashes = F.size(parts) - 1
    head = F.get(parts, 0)          # text before the first slash
    blank = F.lit("")

    s1 = (F.when(slashes >= first_late + 1, F.get(parts, first_late))
          .when(slashes == first_late, blank)
          .when(slashes >= 1, head)
          .otherwise(blank))
    s2 = (F.when(slashes >= first_late + 2, F.get(parts, first_late + 1))
          .when(slashes == first_late + 1, blank)
          .when(slashes == first_late, head)
          .when(slashes >= 2, F.get(parts, 1))
          .otherwise(blank))
    norm = lambda c: F.when(u.isNull(), None).otherwise(F.lower(F.trim(c)))
    return norm(s1), norm(s2)


def with_url_sections(df: DataFrame, url: str, names: tuple[str, str] = ("col1", "col2"),
                      fixed: bool = False) -> DataFrame:
    """Adds the two URL sections of :func:`url_sections` as columns.

    The split array is computed once in its own projection; written as one
    expression the split is repeated inside every CASE branch and the
    generated code grows past the whole-stage-codegen method limit (2-3x
    slower on 600k URLs)."""
    if fixed:
        s1, s2 = url_sections(F.col(url), fixed=True)
        return df.withColumns({names[0]: s1, names[1]: s2})
    tmp = df.withColumns({"_url_parts": F.split(F.col(url), "/", -1),
                          "_url_first_late": F.size(F.split(F.substring(F.col(url), 1, 7), "/", -1))})
    s1, s2 = _sections_from_parts(F.col(url), F.col("_url_parts"), F.col("_url_first_late"))
    return tmp.withColumns({names[0]: s1, names[1]: s2}).drop("_url_parts", "_url_first_late")


def install_weekday(idate_text, fmt: str = "dd-MM-yyyy") -> Column:
    """English weekday name of a ``dd-MM-yyyy`` text date; null when the text
    does not parse (F12, F14)."""
    return F.date_format(F.try_to_date(_col(idate_text), fmt), "EEEE")


def list_item(list_text, index: int, sep: str = ",") -> Column:
    """``index``-th (0-based) item of a delimited list; null past the end (F2).

    ``get`` is used rather than ``[]`` because ANSI mode raises on an index
    past the end of an array."""
    return F.get(F.split(_col(list_text), sep, -1), index)


def event_date(ts) -> Column:
    """Calendar date of an event time (Q23)."""
    return F.to_date(_col(ts))


def blank_or_null(c) -> Column:
    """``c = '' or c is null``."""
    c = _col(c)
    return c.isNull() | (c == F.lit(""))
