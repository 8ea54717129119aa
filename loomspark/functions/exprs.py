"""Column expressions: coercion, arithmetic that gives null for what isn't defined, and row-wise summaries.

All of them are built-in functions, so they stay within code generation. Text is never cast without a guard.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

Operand = Column | str


def c(name: str) -> Column:
    """The column of exactly this name, whatever characters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def _of(x: Operand) -> Column:
    return c(x) if isinstance(x, str) else x


# --- text ----------------------------------------------------------------------------------------------------------

_EDGES = r"(?U)^\s+|\s+$"
_NUMBER = r"^\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\s*$"


def strip(x: Operand) -> Column:
    """Trimmed of all Unicode white space, less no-break spaces within; nothing left is null."""
    text = F.regexp_replace(F.regexp_replace(_of(x).cast("string"), _EDGES, ""), "\u00a0", "")
    return F.when(text != "", text)


def key_text(x: Operand) -> Column:
    """A join key: as text, trimmed, null where nothing is left."""
    text = F.regexp_replace(_of(x).cast("string"), _EDGES, "")
    # nullif() would be planned as a column of its own for each use; this is found to be the same wherever it is.
    return F.when(text != "", text)


def status(x: Operand, aliases: dict[str, str] | None = None) -> Column:
    """For comparing free text: lower case, trimmed, single spaces, then the alias if there is one."""
    text = F.regexp_replace(F.lower(F.regexp_replace(_of(x).cast("string"), _EDGES, "")), r"(?U)\s+", " ")
    return F.coalesce(mapped(text, aliases), text) if aliases else text


def mapped(x: Operand, pairs: dict[str, str]) -> Column:
    """The value that pairs has for x; null for others."""
    if not pairs:
        return F.lit(None).cast("string")
    return F.element_at(F.create_map(*(F.lit(v) for kv in pairs.items() for v in kv)), _of(x).cast("string")) if len(pairs) > 30 else reduce(lambda e, kv: F.when(_of(x) == kv[0], kv[1]).otherwise(e), pairs.items(), F.lit(None).cast("string"))


# --- numbers -------------------------------------------------------------------------------------------------------


def finite(x: Operand) -> Column:
    """Null for NaN and infinities."""
    x = _of(x)
    return F.when(~F.isnan(x) & (F.abs(x) != float("inf")), x)


def number(x: Operand) -> Column:
    """Text that is a plain decimal number, as double; null for anything else, infinities included."""
    text = _of(x).cast("string")
    return finite(F.when(text.rlike(_NUMBER), F.trim(text).try_cast("double")))


def as_double(x: Operand, kind: str = "string") -> Column:
    """x as double: text through number(), other types by casting."""
    return number(x) if kind == "string" else finite(_of(x).cast("double"))


def safe_div(a: Operand, b: Operand) -> Column:
    """Null where b is zero or the quotient isn't finite."""
    return finite(F.try_divide(_of(a).cast("double"), _of(b).cast("double")))


def log10(x: Operand) -> Column:
    return F.when(_of(x) > 0, F.log10(_of(x)))


def log1p(x: Operand) -> Column:
    return F.when(_of(x) > -1, F.log1p(_of(x)))


_CENSORED = r"^\s*([<>])\s*(-?\d+(?:[.,]\d+)?)\s*$"
CENSORED_POLICIES = ("limit", "half", "missing")


def is_censored(x: Operand) -> Column:
    """Whether a cell gives a limit (<5, >2,5) instead of a value; null for an empty one."""
    return _of(x).cast("string").rlike(_CENSORED)


def censored_number(x: Operand, policy: str = "limit") -> Column:
    """A number, or for a limit what the policy says; only limits may have a decimal comma."""
    if policy not in CENSORED_POLICIES:
        raise ValueError(f"censored policy {policy!r}: one of {', '.join(CENSORED_POLICIES)}")
    text = _of(x).cast("string")
    limit = F.replace(F.regexp_extract(text, _CENSORED, 2), F.lit(","), F.lit(".")).try_cast("double")
    said = {"limit": limit, "half": limit / 2, "missing": F.lit(None).cast("double")}[policy]
    return F.when(text.rlike(_CENSORED), said).otherwise(number(text))


def european_number(x: Operand) -> Column:
    """Decimal comma read as a point; a percentage as a fraction."""
    text = F.replace(_of(x).cast("string"), F.lit(","), F.lit("."))
    value = number(F.replace(text, F.lit("%"), F.lit("")))
    return F.when(F.contains(text, F.lit("%")), value / 100).otherwise(value)


_BELOW = r"^\s*<\s*([\d.,]+)"


def below_limit(x: Operand) -> Column:
    """1 for a value below the limit of quantification, 0 for another, null for an empty cell."""
    return _of(x).cast("string").rlike(_BELOW).cast("int")


def limit_of(x: Operand) -> Column:
    return number(F.replace(F.regexp_extract(_of(x).cast("string"), _BELOW, 1), F.lit(","), F.lit(".")))


def ratio_right(x: Operand) -> Column:
    """What follows the first colon, trimmed; the text itself without one."""
    text = _of(x).cast("string")
    return F.when(F.instr(text, ":") > 0, F.trim(F.regexp_extract(text, r"(?s)^[^:]*:(.*)$", 1))).otherwise(text)


# --- times ---------------------------------------------------------------------------------------------------------

#: The formats that are tried in this order, with what a text must look like.
DATE_FORMATS = (
    ("y-M-d", r"^\d{4}-\d{1,2}-\d{1,2}$"),
    ("H:m", r"^\d{1,2}:\d{1,2}$"),
    ("H:m:s", r"^\d{1,2}:\d{1,2}:\d{1,2}$"),
    ("y-M-d H:m:s.SSSSSS", r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}\.\d{1,6}$"),
    ("y-M-d H:m:s", r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}$"),
)
#: A time without a date is placed on 1900-01-01; Spark's parser places it on 1970-01-01.
_DAYS_BACK = 25567


def moment(x: Operand) -> Column:
    """A timestamp from the first format that fits the whole text."""
    text = F.regexp_replace(_of(x).cast("string"), _EDGES, "")
    # The width of the fraction varies: it is padded to the six digits that one pattern reads.
    padded = F.when(text.rlike(DATE_FORMATS[3][1]), F.substring(F.concat(text, F.lit("000000")), F.lit(1), F.instr(text, ".") + 6)).otherwise(text)
    tried = []
    for pattern, shape in DATE_FORMATS:
        t = F.try_to_timestamp(padded, F.lit(pattern))
        tried.append(F.when(text.rlike(shape), t - F.expr(f"interval {_DAYS_BACK} days") if pattern[0] == "H" else t))
    return F.coalesce(*tried)


_CLOCK = r"^\s*(\d+):(\d{1,2})(?::(\d{1,2}))?\s*$"
MINUTES = {"minutes": 1.0, "hours": 60.0, "seconds": 1 / 60, "days": 1440.0}


def duration_minutes(x: Operand, unit: str = "minutes") -> Column:
    """H:MM[:SS] exactly; a bare number, decimal comma allowed, in the given unit."""
    text = _of(x).cast("string")
    part = lambda k: F.nullif(F.regexp_extract(text, _CLOCK, k), F.lit("")).try_cast("double")
    clock = part(1) * 60 + part(2) + F.coalesce(part(3), F.lit(0.0)) / 60
    return F.when(text.rlike(_CLOCK), clock).otherwise(number(F.replace(text, F.lit(","), F.lit("."))) * MINUTES[unit])


def minutes_between(later: Operand, earlier: Operand) -> Column:
    """Timestamps with or without a time zone; the latter are in the session's."""
    micros = lambda x: F.unix_micros(_of(x).cast("timestamp"))
    return (micros(later) - micros(earlier)) / 6e7


def seconds_of_day(x: Operand) -> Column:
    """Of a timestamp, or of text that holds a time with or without a date."""
    t = moment(F.regexp_replace(_of(x).cast("string"), r"^(\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2})$", "$1:00"))
    return F.hour(t) * 3600 + F.minute(t) * 60 + F.second(t)


# --- rows ----------------------------------------------------------------------------------------------------------


def row_count(xs: Sequence[Operand]) -> Column:
    return reduce(lambda a, b: a + b, (_of(x).isNotNull().cast("int") for x in xs), F.lit(0))


def row_sum(xs: Sequence[Operand]) -> Column:
    """Sum of what is there; null where nothing is."""
    if not xs:
        return F.lit(None).cast("double")
    total = reduce(lambda a, b: a + b, (F.coalesce(_of(x), F.lit(0.0)) for x in xs))
    return F.when(F.coalesce(*map(_of, xs)).isNotNull(), total)


def row_mean(xs: Sequence[Operand]) -> Column:
    return F.try_divide(row_sum(xs), row_count(xs)) if xs else F.lit(None).cast("double")


def row_least(xs: Sequence[Operand]) -> Column:
    return F.least(*map(_of, xs)) if len(xs) > 1 else _of(xs[0])


def row_greatest(xs: Sequence[Operand]) -> Column:
    return F.greatest(*map(_of, xs)) if len(xs) > 1 else _of(xs[0])


def row_slope(days: Sequence[float], xs: Sequence[Operand]) -> Column:
    """Least-squares slope over the days with a reading; null with fewer than two. Closed form, no loop over rows."""
    if len(xs) < 2:
        return F.lit(None).cast("double")
    pick = lambda x, e: F.when(_of(x).isNotNull(), e).otherwise(0.0)
    total = lambda f: reduce(lambda a, b: a + b, (pick(x, f(float(d), _of(x))) for d, x in zip(days, xs)))
    n, sx, sy = row_count(xs), total(lambda d, x: F.lit(d)), total(lambda d, x: x)
    sxx, sxy = total(lambda d, x: F.lit(d * d)), total(lambda d, x: x * d)
    return F.when(n >= 2, F.try_divide(n * sxy - sx * sy, n * sxx - sx * sx))


def row_auc(days: Sequence[float], xs: Sequence[Operand]) -> Column:
    """Trapezoidal area over the days with a reading, bridging gaps; null with fewer than two."""
    if len(xs) < 2:
        return F.lit(None).cast("double")
    area, spans = F.lit(0.0), []
    for i in range(len(xs)):
        for j in range(i + 1, len(xs)):
            there = reduce(lambda a, b: a & b, (_of(xs[k]).isNull() for k in range(i + 1, j)), _of(xs[i]).isNotNull() & _of(xs[j]).isNotNull())
            spans.append(F.when(there, (_of(xs[i]) + _of(xs[j])) * (float(days[j]) - float(days[i])) / 2).otherwise(0.0))
    return F.when(row_count(xs) >= 2, reduce(lambda a, b: a + b, spans, area))


#: Texts that say no.
NEGATIVES = ("n", "no", "false", "f", "0", "none", "no clumps", "absent")


def yes_no(x: Operand, kind: str = "string") -> Column:
    """1.0 or 0.0: the negatives are listed, whatever else is there is a yes."""
    x = _of(x)
    if kind != "string":
        return (x.cast("double") != 0).cast("double")
    return F.when(F.lower(F.trim(x)).isin(*NEGATIVES), 0.0).when(x.isNotNull(), 1.0)


# --- hashing -------------------------------------------------------------------------------------------------------


def bucket_and_sign(column: str, value: Operand, buckets: int) -> tuple[Column, Column]:
    """Where the hashing encoder puts a value of a column, and with which sign: from md5 of column, NUL, value."""
    digest = F.md5(F.concat(F.lit(column + "\0"), _of(value).cast("string")))
    bucket = (F.conv(F.substring(digest, 1, 16), 16, 10).cast("decimal(20,0)") % buckets).cast("int")
    sign = F.when(F.conv(F.substring(digest, 17, 2), 16, 10).cast("int") % 2 == 0, 1).otherwise(-1)
    return bucket, sign
