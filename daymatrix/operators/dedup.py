"""Latest-wins dedup and unions.

Latest-wins is an aggregation, ``max_by(row, order)``, not a window: the
partial aggregate keeps one candidate per key and map task, so a key holding
a third of all rows never lands whole in one task. ``dropDuplicates`` is not
used because it keeps an arbitrary row.

Spark aggregates by hash only where the buffer has fixed-width values. So rows of
a few such columns are picked column by column under one numeric order (all columns
see the same rows in the same sequence, so they agree on the row, ties included);
rows with text are picked as one struct, which Spark aggregates by sorting.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daymatrix.functions.names import qcol


#: Columns that are picked one by one; each adds its value and the order to the buffer.
MAX_FIXED = 64
FIXED = (T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType,
         T.DateType, T.TimestampType, T.TimestampNTZType)
BITS = {T.ByteType: 8, T.ShortType: 16, T.IntegerType: 32, T.LongType: 64}


def _packed(df: DataFrame, cols: Sequence[str]) -> Column | None:
    """One number in the order of ``(cols...)``, null least, or None if the columns
    are not integers or do not fit 38 digits."""
    bits = [BITS.get(type(df.schema[c].dataType)) for c in cols]
    if None in bits or sum(bits) > 120:
        return None
    big = "decimal(38,0)"
    out = F.lit(0).cast(big)
    for c, n in zip(cols, bits):
        place = F.coalesce(qcol(c).cast(big) + F.lit(str(2 ** (n - 1) + 1)).cast(big), F.lit(0).cast(big))
        out = ((out * F.lit(str(2**n + 1)).cast(big)).cast(big) + place).cast(big)
    return out


def latest_wins(df: DataFrame, keys: Sequence[str], order: Sequence[str] | str = "batch_id") -> DataFrame:
    """One row per ``keys``: the one with the greatest ``order`` value(s).

    ``order`` must make rows of a key unique (e.g. a batch sequence); file or
    arrival order is never relied on. Null key parts are grouped together.
    """
    order_cols = [order] if isinstance(order, str) else list(order)
    payload = [c for c in df.columns if c not in keys]
    fixed = len(payload) <= MAX_FIXED and all(isinstance(df.schema[c].dataType, FIXED) for c in [*payload, *order_cols])
    number = (qcol(order_cols[0]) if len(order_cols) == 1 else _packed(df, order_cols)) if fixed and payload else None
    if number is not None:
        ranked = df.select(*[qcol(c) for c in df.columns], number.alias("__order"))
        picked = ranked.groupBy(*[qcol(k) for k in keys]).agg(*[F.max_by(qcol(c), F.col("__order")).alias(c) for c in payload])
        return picked.select(*[qcol(c) for c in [*keys, *payload]])
    order_expr = F.struct(*[qcol(c) for c in order_cols]) if len(order_cols) > 1 else qcol(order_cols[0])
    picked = df.groupBy(*[qcol(k) for k in keys]).agg(
        F.max_by(F.struct(*[qcol(c) for c in payload]), order_expr).alias("__row")
    )
    return picked.select(*[qcol(k) for k in keys], *[F.col("__row").getField(c).alias(c) for c in payload])


def union_batches(frames: Sequence[DataFrame]) -> DataFrame:
    """Union of batches whose columns differ; absent columns are null."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def data_id(*cols: str) -> "F.Column":
    """Composite record key as one text column, ``timestamp|code|unit``.
    Different keys have different ids: a null part is ``\\N``, and bars and
    backslashes inside a part are escaped. Dedup itself groups on the key
    columns; this is for export."""
    def part(c: str) -> "F.Column":
        text = F.replace(qcol(c).cast("string"), F.lit("\\"), F.lit("\\\\"))
        return F.coalesce(F.replace(text, F.lit("|"), F.lit("\\|")), F.lit("\\N"))

    return F.concat_ws("|", *[part(c) for c in cols])
