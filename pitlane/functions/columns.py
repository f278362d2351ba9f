from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from pitlane import fixed_values as V

_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
_WHOLE = r"^\s*[+-]?\d+\s*$"


def _text(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def coerce_double(c) -> Column:
    """Text to double, null where it is no plain number ("12d" and "NaN" are none)."""
    text = _text(c)
    return F.when(text.rlike(_NUMBER), text.try_cast("double"))


def coerce_integer(c) -> Column:
    """Text to bigint: "12" and "12.0" are 12; text that is no whole number is null.

    Whole-number text is cast directly, so ids beyond 2^53 keep every digit. A fraction is never
    cut off; `loses_fraction` finds those values.
    """
    text = _text(c)
    number = coerce_double(text)
    return F.when(text.rlike(_WHOLE), F.trim(text).try_cast("bigint")).when(
        number == F.floor(number), number.try_cast("bigint")
    )


def loses_fraction(c) -> Column:
    """True where a number is present but is not whole, so `coerce_integer` gave null."""
    number = coerce_double(c)
    return F.coalesce(number != F.floor(number), F.lit(False))


def feed_timestamp(c) -> Column:
    """Parse the 12-hour feed time. The zone is part of the parse, so the session zone is not."""
    return F.to_timestamp(F.concat(_text(c), F.lit(" Z")), V.FEED_TIME_FORMAT + " X")


def percent_decode(c) -> Column:
    """Percent-decode a name. A plus stays a plus and a broken sequence stays as written."""
    guarded = F.regexp_replace(_text(c), r"%(?![0-9A-Fa-f]{2})", "%25")
    return F.url_decode(F.replace(guarded, F.lit("+"), F.lit("%2B")))


def contains_fold(c, text: str) -> Column:
    """Case-insensitive LIKE '%text%': % and _ in the text are wildcards, a backslash is not."""
    column = F.col(c) if isinstance(c, str) else c
    return column.ilike("%" + text.replace("\\", "\\\\") + "%")


def number_in_url(c, before: str, after: str) -> Column:
    """The digits between what two patterns match in a URL, null where there are none."""
    column = F.col(c) if isinstance(c, str) else c
    digits = F.regexp_extract(column, before + r"(\d+)" + after, 1)
    return F.when(digits != "", digits.try_cast("bigint"))


def exact_mean(c, scale: int) -> Column:
    """Mean of values that hold at most `scale` decimals, summed as decimals.

    A decimal sum does not depend on the order in which partitions arrive, so a mean that falls
    on a rounding boundary rounds the same way in every run.
    """
    column = F.col(c) if isinstance(c, str) else c
    return F.sum(column.cast(f"decimal(18,{scale})")) / F.count(column)


def all_of(conditions) -> Column:
    return reduce(and_, conditions, F.lit(True))


def any_of(conditions) -> Column:
    return reduce(or_, conditions, F.lit(False))


def any_null(names) -> Column:
    return reduce(or_, [F.col(n).isNull() for n in names])


def change_sign(c) -> Column:
    """positive / negative / zero / missing."""
    column = F.col(c) if isinstance(c, str) else c
    return (
        F.when(column.isNull(), "missing").when(column > 0, "positive")
        .when(column < 0, "negative").otherwise("zero")
    )


def movement_label(c) -> Column:
    """'+2 places', '-1 place'; null where nothing moved or nothing can be compared."""
    column = F.col(c) if isinstance(c, str) else c
    unit = F.when(F.abs(column) == 1, "place").otherwise("places")
    return F.when(column != 0, F.format_string("%+d %s", column, unit))


def as_json(names) -> Column:
    """One record as JSON text with explicit nulls."""
    return F.to_json(F.struct(*names), {"ignoreNullFields": "false"})
