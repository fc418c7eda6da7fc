"""Joins of unit lists and fact tables that stay balanced when one unit is hot.

A dimension (one row per unit) LEFT JOIN a fact table is the commonest shape
in the reports.  Executed as one sort-merge outer join, a unit holding a
third of the fact rows lands in one task: AQE cannot split the fact side
of a left outer join.  ``keep_left_join`` has two ways, by the planner's size estimate of the units:

* small units (below Spark's broadcast threshold): an inner join, which moves
  no fact, and the units without facts by an anti join against the distinct fact keys;
* larger ones: a left join on the key and a salt.  A key with more than
  ``HOT_ROWS`` facts gets one salt per ``HOT_ROWS`` of them, and only its unit
  is repeated, once per salt; all other keys have the one salt 0.

Hot keys are found without a shuffle by key (``hot_keys``): every task keeps
a frequent-items sketch, the sketches are merged, and the candidates are
counted exactly.  Nothing is counted on the driver, and both ways equal the left
outer join row for row.

``grid_full_join`` is the full outer join of two lists that may both hold many
rows of one key.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Facts per key and task that need no split.
HOT_ROWS = 1_000_000
#: Candidates taken from the merged sketches, and items a sketch tracks.  Any key with more than
#: 1 / CANDIDATES of all rows is among the candidates (the sketch errs by at most 3.5 / TRACKED of them); a
#: key below that is a small part of one task's share wherever there are that many tasks.
CANDIDATES, TRACKED = 10_000, 65_536
#: Tasks that merge sketches before the last merge.
MERGERS = 64
#: Joined rows per task of a key that many rows share on both sides.
GRID_PAIRS = 4_000_000


def _and(conds: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conds)


def _present(keys: Sequence[str]) -> Column:
    return _and([F.col(k).isNotNull() for k in keys])


def _named(keys: Sequence[str]) -> list[Column]:
    return [F.col(k).alias(f"__key{i}") for i, k in enumerate(keys)]


def _on(df: DataFrame, keys: Sequence[str], counts: DataFrame) -> Column:
    return _and([df[k] == counts[f"__key{i}"] for i, k in enumerate(keys)])


def hot_keys(facts: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS, candidates: int = CANDIDATES,
             tracked: int = TRACKED) -> DataFrame:
    """(__key0.., __n): the non-NULL keys with more than ``hot_rows`` rows, with their exact number.

    One pass sketches the hash of the keys (a sketch per task, merged in two
    steps), a second one counts the rows of the sketch's heaviest hashes, at
    most ``candidates``, by key.  Neither shuffles by key: what moves are sketches, and one row per candidate and task.
    """
    own = facts.where(_present(keys)).select(*_named(keys))
    own = own.withColumn("__hash", F.xxhash64(*own.columns))
    sketches = own.groupBy(F.pmod(F.spark_partition_id(), F.lit(MERGERS)).alias("__merger")) \
        .agg(F.expr(f"approx_top_k_accumulate(__hash, {tracked})").alias("__sketch"))
    # Grouped by a constant: a task without sketches then gives no empty one, which could not be merged.
    heaviest = sketches.groupBy(F.lit(0).alias("__all")).agg(F.expr(f"approx_top_k_combine(__sketch, {tracked})").alias("__sketch")) \
        .select(F.explode(F.expr(f"approx_top_k_estimate(__sketch, {candidates})")).alias("__top"))
    # The estimates may be off by the sketch's error, so they only say which keys to count.
    heaviest = heaviest.select(F.col("__top.item").alias("__candidate"))
    counted = own.join(F.broadcast(heaviest), own["__hash"] == heaviest["__candidate"], "left_semi")
    return counted.groupBy(*[f"__key{i}" for i in range(len(keys))]).agg(F.count("*").alias("__n")).where(F.col("__n") > hot_rows)


def _salts(counts: DataFrame, hot_rows: int) -> DataFrame:
    """The hot keys with their number of salts."""
    return counts.where(F.col("__n") > hot_rows).withColumn("__salts", F.ceil(F.col("__n") / F.lit(hot_rows)).cast("int")).drop("__n")


def _spread(df: DataFrame) -> Column:
    """A number of a row.  Equal rows differ in their partition, so they spread as well; a retried
    task gives its rows the same numbers, in whatever order they come."""
    return F.xxhash64(*[F.col(c) for c in df.columns], F.spark_partition_id())


def _salted(facts: DataFrame, keys: Sequence[str], hot: DataFrame) -> DataFrame:
    """Facts with ``__salt_f``."""
    numbered = facts.withColumn("__spread", _spread(facts))
    salt = F.pmod(F.col("__spread"), F.coalesce(F.col("__salts"), F.lit(1))).cast("int")
    return numbered.join(F.broadcast(hot), _on(numbered, keys, hot), "left").select(*facts.columns, salt.alias("__salt_f"))


def _repeated(units: DataFrame, keys: Sequence[str], hot: DataFrame) -> DataFrame:
    """Units with ``__salts`` (NULL unless hot), once per ``__salt_u``."""
    return units.join(F.broadcast(hot), _on(units, keys, hot), "left").select(
        *units.columns, "__salts", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("__salts"), F.lit(1)) - 1)).alias("__salt_u"))


def split_inner_join(units: DataFrame, facts: DataFrame, unit_keys: Sequence[str], fact_keys: Sequence[str],
                     counts: DataFrame | None = None, hot_rows: int = HOT_ROWS) -> DataFrame:
    """``units INNER JOIN facts`` with hot keys spread over salts (columns of both sides).

    ``counts`` (__key0.., __n), if the caller has them, spare the look for hot keys.
    """
    hot = _salts(hot_keys(facts, fact_keys, hot_rows) if counts is None else counts, hot_rows)
    left, right = _repeated(units, unit_keys, hot), _salted(facts, fact_keys, hot)
    cond = _and([F.col(u) == F.col(f) for u, f in zip(unit_keys, fact_keys)] + [F.col("__salt_u") == F.col("__salt_f")])
    return left.join(right, cond).select(*units.columns, *facts.columns)


def is_small(df: DataFrame) -> bool:
    """Whether Spark's estimate of ``df`` is below its own broadcast threshold (no job runs)."""
    session = df.sparkSession
    threshold = session._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) <= threshold


def _inner(units: DataFrame, facts: DataFrame, unit_keys: Sequence[str], fact_keys: Sequence[str]) -> DataFrame:
    return units.join(facts, _and([units[u] == facts[f] for u, f in zip(unit_keys, fact_keys)]))


def _without_facts(units: DataFrame, facts: DataFrame) -> DataFrame:
    return units.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in facts.schema.fields])


def _check(left: DataFrame, right: DataFrame) -> None:
    if clash := set(left.columns) & set(right.columns):
        raise ValueError(f"column names on both sides: {sorted(clash)}")


def keep_left_join(left: DataFrame, right: DataFrame, left_keys: Sequence[str], right_keys: Sequence[str],
                   hot_rows: int = HOT_ROWS, derived: Column | None = None, keys_from: DataFrame | None = None) -> DataFrame:
    """``left LEFT JOIN right ON left_keys = right_keys``, balanced on ``right``; column names must be distinct.

    ``derived`` says which left rows took their key from the facts themselves: they
    have facts unless the key is NULL.  ``keys_from`` gives the fact keys of the other
    left rows under ``right_keys``, where that is cheaper than ``right`` itself.
    """
    _check(left, right)
    if is_small(left):
        matched = _inner(left, right, left_keys, right_keys)
        sure = F.lit(False) if derived is None else F.coalesce(derived, F.lit(False)) & _present(left_keys)
        keys = (right if keys_from is None else keys_from).where(_present(right_keys)).select(*_named(right_keys)).distinct()
        rest = left.where(~sure)
        return matched.unionByName(_without_facts(rest.join(keys, _on(rest, left_keys, keys), "left_anti"), right))
    hot = _salts(hot_keys(right, right_keys, hot_rows), hot_rows)
    units, facts = _repeated(left, left_keys, hot), _salted(right, right_keys, hot)
    cond = _and([F.col(u) == F.col(f) for u, f in zip(left_keys, right_keys)] + [F.col("__salt_u") == F.col("__salt_f")])
    # A salt of a hot unit may have drawn no fact; the unit has some, so that row of NULLs goes.
    return units.join(facts, cond, "left").where(F.col("__salt_f").isNotNull() | F.col("__salts").isNull()) \
        .select(*left.columns, *right.columns)


def self_dim_left_join(dim: DataFrame, fact: DataFrame, dim_key: str, fact_key: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """``dim LEFT JOIN fact`` when ``dim`` was derived from ``fact`` itself.

    Every non-NULL dimension key then occurs in the fact table, so the only
    unmatched dimension rows are those with a NULL key: the result is the
    inner join plus those rows.
    """
    _check(dim, fact)
    matched = _inner(dim, fact, [dim_key], [fact_key]) if is_small(dim) else split_inner_join(dim, fact, [dim_key], [fact_key], None, hot_rows)
    return matched.unionByName(_without_facts(dim.where(F.col(dim_key).isNull()), fact))


def grid_full_join(left: DataFrame, right: DataFrame, left_keys: Sequence[str], right_keys: Sequence[str],
                   pairs: int = GRID_PAIRS, hot_rows: int = HOT_ROWS) -> DataFrame:
    """``left FULL OUTER JOIN right ON left_keys = right_keys`` when one key may have very many rows on both sides.

    A key with m left and n right rows joins to m x n rows, which is the
    defined result.  Keys with more than ``pairs`` of them, or more than
    ``hot_rows`` rows on a side, leave the plain join: if both sides have
    them, they meet in an inner join over a grid of salts, each cell of about ``pairs`` rows or
    less (left rows repeated along one axis, right rows along the other); if
    only one side has them, its rows need no join.  A NULL key matches nothing and goes around the
    join.  Both inputs are read several times: give written tables.
    """
    _check(left, right)
    counted = [df.where(_present(keys)).groupBy(*_named(keys)).agg(F.count("*").alias(n))
               for df, keys, n in ((left, left_keys, "__m"), (right, right_keys, "__r"))]
    both = counted[0].join(counted[1], [f"__key{i}" for i in range(len(left_keys))], "full").na.fill(0, ["__m", "__r"])
    heavy = both.where((F.col("__m") * F.col("__r") > pairs) | (F.greatest("__m", "__r") > hot_rows))
    # Rows of a cell: sqrt(pairs) of each side, or as many as the shorter side leaves room for.
    side = F.sqrt(F.lit(float(pairs)))
    cell_left = F.greatest(F.lit(1.0), F.least(F.lit(float(pairs)) / F.least(F.greatest(F.col("__r"), F.lit(1)), side), F.lit(float(hot_rows))))
    cell_right = F.greatest(F.lit(1.0), F.least(F.lit(float(pairs)) / F.least(F.greatest(F.col("__m"), F.lit(1)), side), F.lit(float(hot_rows))))
    heavy = heavy.withColumn("__a", F.ceil(F.col("__m") / cell_left).cast("int")).withColumn("__b", F.ceil(F.col("__r") / cell_right).cast("int"))

    def dealt(df: DataFrame, keys: Sequence[str]) -> DataFrame:
        numbered = df.withColumn("__spread", _spread(df))
        return numbered.join(F.broadcast(heavy), _on(numbered, keys, heavy), "left")

    def single(df: DataFrame, keys: Sequence[str], other: str) -> DataFrame:
        """Rows that need no join: their key is NULL, or heavy and missing on the other side."""
        return df.where((~_present(keys)) | (F.col(other) == 0))

    l, r = dealt(left, left_keys), dealt(right, right_keys)
    light = F.col("__m").isNull()
    plain = l.where(light & _present(left_keys)).select(*left.columns).join(
        r.where(light & _present(right_keys)).select(*right.columns), _and([F.col(a) == F.col(b) for a, b in zip(left_keys, right_keys)]), "full")
    met = (F.col("__m") > 0) & (F.col("__r") > 0)
    cells_l = l.where(met).select(*left.columns, F.pmod("__spread", F.col("__a")).cast("int").alias("__i"),
                                  F.explode(F.sequence(F.lit(0), F.col("__b") - 1)).alias("__j"))
    cells_r = r.where(met).select(*right.columns, F.pmod("__spread", F.col("__b")).cast("int").alias("__rj"),
                                  F.explode(F.sequence(F.lit(0), F.col("__a") - 1)).alias("__ri"))
    grid = cells_l.join(cells_r, _and([F.col(a) == F.col(b) for a, b in zip(left_keys, right_keys)]
                                      + [F.col("__i") == F.col("__ri"), F.col("__j") == F.col("__rj")])).select(*left.columns, *right.columns)
    return plain.select(*left.columns, *right.columns).unionByName(grid) \
        .unionByName(single(l, left_keys, "__r").select(*left.columns), allowMissingColumns=True) \
        .unionByName(single(r, right_keys, "__m").select(*right.columns), allowMissingColumns=True)
