"""Column-level cleaning of labels, unit codes, regions and dates.

All functions return native ``Column`` expressions, so they stay inside
whole-stage code generation; nothing here runs Python per row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values (label conventions of the source system).
NA = "NA"
REGION_UNSPECIFIED = "SENSEESPECIFICAR_SE"
REGION_DEFAULT = "RS:SENSEESPECIFICAR_SE"
UNIT_WIDTH = 5
CLASS_GROUPS = {
    "PRESENCIAL": ("C9C", "C9R", "CALTRE"),
    "DOMICILIARIA": ("D9D", "DALTRE"),
    "TELEFONICA": ("9T",),
}

# Every character Python's str.strip() removes (derived by rule, not listed).
WHITESPACE = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Remove leading and trailing white space (``trim`` only removes spaces)."""
    return F.btrim(_c(c).cast("string"), F.lit(WHITESPACE))


def blank_to_null(c: Column | str) -> Column:
    return F.nullif(strip(c), F.lit(""))


def has_text(c: Column | str) -> Column:
    """Non-null and not blank after stripping: exactly when ``pad_unit_code``
    and ``blank_to_null`` give a value. One trim per row, so it stays cheap
    when Catalyst pushes it down to the scan."""
    return strip(c) != F.lit("")


def clean_label(c: Column | str) -> Column:
    """null -> NA, strip, '' -> NA."""
    return F.coalesce(blank_to_null(c), F.lit(NA))


def zfill(c: Column | str, width: int = UNIT_WIDTH) -> Column:
    """Left-pad with zeros to ``width``; never truncates; a leading sign stays
    first (``-12`` -> ``-0012``), like Python's ``str.zfill``."""
    s = _c(c)
    n = F.length(s)
    signed = s.startswith("+") | s.startswith("-")
    return (
        F.when(signed, F.concat(s.substr(F.lit(1), F.lit(1)),
                                F.lpad(s.substr(F.lit(2), n), F.greatest(n - 1, F.lit(width - 1)), "0")))
        .otherwise(F.lpad(s, F.greatest(n, F.lit(width)), "0"))
    )


def pad_unit_code(c: Column | str, width: int = UNIT_WIDTH) -> Column:
    """Strip then zero-pad a unit code (P3); blank or null stays null. A code of
    plain letters and digits has nothing to strip and no sign: it is padded as it is."""
    raw = _c(c).cast("string")
    s = blank_to_null(c)
    return F.when(raw.rlike(r"^[A-Za-z0-9]+\z"), F.lpad(raw, F.greatest(F.length(raw), F.lit(width)), "0")).otherwise(
        F.when(s.isNotNull(), zfill(s, width)))


def unit_label(c: Column | str, width: int = UNIT_WIDTH) -> Column:
    """Unit code used as a demand group: padded, null/blank -> NA."""
    return F.coalesce(pad_unit_code(c, width), F.lit(NA))


def visit_class(c: Column | str | None) -> Column:
    """TIPUS_CLASS: clean label, upper case; constant NA when absent (P5)."""
    if c is None:
        return F.lit(NA)
    return F.upper(clean_label(c))


def visit_class_group(cls: Column | str) -> Column:
    """Visit class -> PRESENCIAL / DOMICILIARIA / TELEFONICA / NA."""
    cls = _c(cls)
    out = None
    for group, members in CLASS_GROUPS.items():
        cond = cls.isin(*members)
        out = F.when(cond, F.lit(group)) if out is None else out.when(cond, F.lit(group))
    return out.otherwise(F.lit(NA))


def region_label(c: Column | str) -> Column:
    """Region after the lookup: null or the bare unspecified marker become
    ``RS:SENSEESPECIFICAR_SE`` (P7)."""
    s = strip(c)
    return F.when(s.isNull() | (s == REGION_UNSPECIFIED), F.lit(REGION_DEFAULT)).otherwise(s)


def day_of(df: DataFrame, name: str, formats: Sequence[str] | None = None) -> Column:
    """Parse to a calendar day; unparsable -> null.

    Timestamps and dates are truncated to the day. Text is tried against each
    format in order (the first that parses wins, X30); without formats the
    generic timestamp parser is used. ANSI mode is on, hence the ``try_`` forms.
    """
    dtype = df.schema[name].dataType
    col = F.col(name)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return F.to_date(col)
    if isinstance(dtype, T.StringType):
        text = strip(col)
        if formats:
            return F.to_date(F.coalesce(*[F.try_to_timestamp(text, F.lit(f)) for f in formats]))
        return F.to_date(F.try_to_timestamp(text))
    return F.to_date(col.cast("timestamp"))


def to_count(c: Column | str) -> Column:
    """Numeric coercion of a stored matrix cell; bad text -> null."""
    return _c(c).try_cast("bigint")
