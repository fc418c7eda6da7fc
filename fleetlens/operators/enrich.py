"""Register enrichment and sibling-based attribute imputation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.functions.text import norm

IMPUTED = ("model", "class", "egi_equipment_description")


def attach_register(rows: DataFrame, register: DataFrame) -> DataFrame:
    """rows LEFT JOIN register ON UPPER(TRIM(id)) = reg.id AND UPPER(TRIM(maker)) = reg.maker.

    A plain left join: ``rows`` are unit lists or unit-days, and the exchanges
    stand right under the join, so AQE can split a hot key of ``rows``.
    Duplicate register rows for one unit multiply the unit's rows, as in the
    reports.
    """
    reg = register.withColumnRenamed("idNumber", "__reg_id").withColumnRenamed("manufacture", "__reg_maker")
    keyed = rows.withColumn("__row_id", norm("idNumber")).withColumn("__row_maker", norm("manufacture"))
    joined = keyed.join(reg, (keyed["__row_id"] == reg["__reg_id"]) & (keyed["__row_maker"] == reg["__reg_maker"]), "left")
    return joined.drop("__row_id", "__row_maker", "__reg_id", "__reg_maker")


def vehicle_master(joined: DataFrame, keys: Sequence[str] = ("manufacture", "vehicleType")) -> DataFrame:
    """Per (maker, type): MAX of model, class and description over rows that
    carry both model and class.  The maxima are independent of each other.

    MAX of text sorts its input, so the rows are first reduced to their
    distinct values (a hash aggregate, mostly on the map side).  Their count
    takes part in the MAX, else the optimizer would merge the two steps."""
    distinct = (joined.where(F.col("model").isNotNull() & F.col("class").isNotNull())
                      .groupBy(*keys, *IMPUTED).agg(F.count("*").alias("__rows")))
    return distinct.groupBy(*keys).agg(*[F.max(F.when(F.col("__rows") > 0, F.col(c))).alias(c) for c in IMPUTED])


def impute_from_master(joined: DataFrame, master: DataFrame, normalized: bool = False,
                       keys: Sequence[str] = ("manufacture", "vehicleType")) -> DataFrame:
    """joined LEFT JOIN master on (maker, type); adds ``vm_<attr>`` columns.

    ``normalized`` compares UPPER(TRIM()) of both sides (the fuel report does,
    while its master is grouped on raw values, so raw variants that normalize
    equal match several master rows).
    """
    m = master.select(*[F.col(k).alias(f"__vm_{k}") for k in keys],
                      *[F.col(c).alias(f"vm_{c}") for c in IMPUTED])
    if normalized:
        left = joined.select("*", *[norm(k).alias(f"__jk_{k}") for k in keys])
        m = m.select("*", *[norm(f"__vm_{k}").alias(f"__mk_{k}") for k in keys])
        left_keys, master_keys = [f"__jk_{k}" for k in keys], [f"__mk_{k}" for k in keys]
        drop = left_keys + master_keys
    else:
        left = joined
        left_keys, master_keys = list(keys), [f"__vm_{k}" for k in keys]
        drop = []
    # few, very large (maker, type) groups on the left, which AQE can split
    cond = [left[a] == m[b] for a, b in zip(left_keys, master_keys)]
    out = left.join(m, cond, "left")
    return out.drop(*drop, *[f"__vm_{k}" for k in keys])
