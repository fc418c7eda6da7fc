"""Latest-record selection.

``latest_per_key`` is ROW_NUMBER() = 1 per key, newest first.  Catalyst turns
it into a partial WindowGroupLimit before the shuffle and a final one after,
so a key holding a large share of the rows is cut to one row per input
partition before anything moves.  Ties are broken on the emitted columns
(greatest first, NULLs last) so the choice is deterministic.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], order: str = "extract_date",
                   tiebreak: Sequence[str] = ()) -> DataFrame:
    ordering = [F.col(order).desc_nulls_last()] + [F.col(c).desc_nulls_last() for c in tiebreak]
    w = Window.partitionBy(*[F.col(k) for k in keys]).orderBy(*ordering)
    return (df.withColumn("__rn", F.row_number().over(w))
              .where(F.col("__rn") == 1)
              .drop("__rn"))


def merge_latest(stored: DataFrame | None, new: DataFrame, keys: Sequence[str], order: str = "extract_date",
                 tiebreak: Sequence[str] = ()) -> DataFrame:
    """(keys, order, tiebreak): the latest record per key of stored records and new ones.

    ``stored`` is an earlier result (None at first), so each load reads only
    its own rows and one record per key.  Ranking is by MAX of a struct, where NULL is
    least: the record that ``latest_per_key`` picks from all rows loaded so far, in
    whatever portions or order they came, and however often a portion is loaded again.
    """
    cols = [*keys, order, *tiebreak]
    rows = new.select(*cols) if stored is None else stored.select(*cols).unionByName(new.select(*cols))
    latest = rows.groupBy(*keys).agg(F.max(F.struct(order, *tiebreak)).alias("__latest"))
    return latest.select(*keys, *[F.col(f"__latest.{c}").alias(c) for c in (order, *tiebreak)])


def latest_snapshot(df: DataFrame, col: str = "extract_date") -> DataFrame:
    """Rows of the newest full snapshot: ``col = (SELECT MAX(col))``.

    The maximum is an uncorrelated scalar subquery, run once; the equality is
    pushed to the scan (partition pruning when the table is laid out by
    ``col``).
    """
    newest = df.select(F.max(col)).scalar()
    return df.where(F.col(col) == newest)
