"""Dates of scraped comments, with the current time as a parameter."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FORMAT = "dd-MM-yyyy"


def _back(now: Column, unit: str, n: Column) -> Column:
    zero = F.lit(0)
    parts = {"years": zero, "months": zero, "weeks": zero, "days": zero, "hours": zero, "mins": zero, "secs": zero} | {unit: n}
    return F.date_format(now - F.make_interval(**parts), FORMAT)


def _number(c: Column) -> Column:
    return F.coalesce(F.regexp_extract(c, r"^\s*(\d{1,9})", 1).try_cast("int"), F.lit(0))


def short_relative(c: Column, now: Column) -> Column:
    """'5d', '2w', '3h', '4m', '6s' before now, in UTC+7; other text unchanged."""
    local = now + F.expr("INTERVAL 7 HOURS")
    out = F.when(c.isNull(), None)
    for mark, unit in (("d", "days"), ("w", "weeks"), ("h", "hours"), ("m", "mins"), ("s", "secs")):
        out = out.when(c.rlike(rf"^\d+{mark}$"), _back(local, unit, _number(c)))
    return out.otherwise(c)


def ago(c: Column, now: Column, exact: bool = False) -> Column:
    """'N unit ago' before now, in UTC+7; hyphenated dates reordered; null is 'No date'.

    Units are tested as substrings in the order s, m, h, d, w, mo, y, so '2 days ago' counts as
    seconds; exact=True reads the unit word instead.
    """
    local, parts, n = now + F.expr("INTERVAL 7 HOURS"), F.split(c, "-"), _number(c)
    out = F.when(c.isNull(), "No date").when(F.contains(c, F.lit("-")) & (F.size(parts) == 2), F.concat_ws("-", parts[1], parts[0], F.year(now).cast("string")))
    out = out.when(F.contains(c, F.lit("-")) & (F.size(parts) == 3), F.concat_ws("-", F.get(parts, F.lit(2)), F.get(parts, F.lit(1)), F.get(parts, F.lit(0))))
    is_ago = F.contains(F.lower(c), F.lit("ago"))
    units = (("s", "secs"), ("m", "mins"), ("h", "hours"), ("d", "days"), ("w", "weeks"), ("mo", "months"), ("y", "years"))
    names = {"secs": "s(ec(ond)?s?)?", "mins": "m(in(ute)?s?)?", "hours": "h((ou)?rs?)?", "days": "d(ays?)?", "weeks": "w(eeks?|ks?)?", "months": "mo(nths?|s)?", "years": "y(ears?|rs?)?"}
    for mark, unit in units:
        fits = c.rlike(rf"(?i)^\s*\d+\s*{names[unit]}\s+ago") if exact else F.contains(c, F.lit(mark)) & (~F.contains(c, F.lit("mo")) if mark == "m" else F.lit(True))
        out = out.when(is_ago & fits, _back(local, unit, n))
    return out.when(is_ago, F.date_format(local, FORMAT)).otherwise(c)


def vietnamese(c: Column, now: Column) -> Column:
    """'N ngày trước' and the like before now; other text unchanged."""
    out = F.when(c.isNull(), None)
    for word, unit in (("ngày", "days"), ("tuần", "weeks"), ("tháng", "months"), ("năm", "years"), ("giờ", "hours"), ("phút", "mins")):
        out = out.when(c.rlike(rf"^\d+\s+{word}\s+trước$"), _back(now, unit, _number(c)))
    return out.otherwise(c)


def iso(c: Column) -> Column:
    """An ISO date and time as dd-mm-yyyy; '' for missing, the text itself where it is none."""
    return F.when(c.isNull() | (c == ""), "").otherwise(F.coalesce(F.date_format(F.try_to_timestamp(c), FORMAT), c))


def as_date(c: Column) -> Column:
    return F.try_to_date(c, FORMAT)


def run_stamp(now: Column) -> Column:
    return F.date_format(now, "yyyyMMdd_HHmmss")
