"""Joins of event tables.

No side is forced to be broadcast: Spark broadcasts a side only when its measured size is under
`spark.sql.autoBroadcastJoinThreshold`, and otherwise shuffles both sides and splits skewed partitions.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eddyline.operators.blocks import Width, block_start, running


def full_outer(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Equi full outer join as left outer plus the right rows without partner.

    Adaptive execution can split a skewed left side of an outer or anti join, but not of a full join.
    """
    matched = left.join(right, list(on), "left")
    keys = left.select(*on).distinct()
    return matched.unionByName(right.join(keys, list(on), "left_anti"), allowMissingColumns=True)


def interval(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_t: str,
    right_t: str,
    lower: int,
    upper: int,
    how: str = "inner",
    upper_inclusive: bool = True,
) -> DataFrame:
    """Rows with equal keys and right.t + lower <= left.t <= right.t + upper.

    Left rows stay in their own time bucket, right rows are copied to the (at most two) buckets their
    interval touches, and the bucket joins the equality keys. A hot key is thus spread over time, no left row is
    duplicated, so semi, anti and left outer joins are exact too. Put the smaller side on the right. For a right outer join swap the
    sides and turn the interval; for a full one add the unmatched rows of a left_anti join.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"an interval join can't be {how}: swap the sides, or add the rows of a left_anti join")
    width = max(upper - lower, 1)
    lt, rt = F.col(left_t), F.col(right_t)
    lefts = left.withColumn("_bucket", block_start(lt, width))
    step = F.lit(width).cast("long")
    rights = right.withColumn(
        "_bucket", F.explode(F.sequence(block_start(rt + lower, width), block_start(rt + upper, width), step))
    )
    distance = F.col(f"l.{left_t}") - F.col(f"r.{right_t}")
    within = (distance >= lower) & ((distance <= upper) if upper_inclusive else (distance < upper))
    equal = [F.col(f"l.{k}") == F.col(f"r.{k}") for k in [*keys, "_bucket"]]
    joined = lefts.alias("l").join(rights.alias("r"), [*equal, within], how)
    if how in ("left_semi", "left_anti"):
        return joined.drop("_bucket")
    kept = [c for c in right.columns if c not in keys]
    return joined.select(*[F.col(f"l.{c}") for c in left.columns], *[F.col(f"r.{c}") for c in kept])


def windowed(df: DataFrame, ts: str, size: str) -> DataFrame:
    """Replace the time column by its tumbling window, ready for a join on (key, window)."""
    return df.withColumn("win", F.window(ts, size)).drop(ts)


def window_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join two `windowed` inputs on key and window. Semi and anti joins look at distinct partners only."""
    on = [*keys, "win"]
    if how in ("left_semi", "left_anti"):
        right = right.select(*on).distinct()
    if how == "full":
        return full_outer(left, right, on)
    return left.join(right, on, how)


def window_cogroup(
    left: DataFrame, right: DataFrame, keys: Sequence[str], left_aggs: Sequence[Column], right_aggs: Sequence[Column]
) -> DataFrame:
    """Both sides of every key and window, even if one is empty, as one aggregate row per side.

    Each side is aggregated before it is shuffled; the row lists themselves are never collected.
    """
    on = [*keys, "win"]
    return left.groupBy(*on).agg(*left_aggs).join(right.groupBy(*on).agg(*right_aggs), on, "full")


def lookup(facts: DataFrame, dimension: DataFrame, fact_key: str, dim_key: str, defaults: dict[str, Column]) -> DataFrame:
    """Left join to a dimension with unique keys; `defaults` names the columns to add and their fallback."""
    wanted = dimension.select(F.col(dim_key).alias("_k"), *[F.col(c).alias(f"_d_{c}") for c in defaults])
    joined = facts.join(wanted, facts[fact_key] == F.col("_k"), "left").drop("_k")
    for c, fallback in defaults.items():
        joined = joined.withColumn(c, F.coalesce(F.col(f"_d_{c}"), fallback)).drop(f"_d_{c}")
    return joined


def lookup_roles(
    facts: DataFrame, dimension: DataFrame, dim_key: str, roles: dict[str, tuple[str, str]], fallback: str = ""
) -> DataFrame:
    """Look one dimension up once per role: output column -> (fact key, dimension column)."""
    out = facts
    for name, (fact_key, column) in roles.items():
        role = dimension.select(F.col(dim_key).alias(f"_k_{name}"), F.col(column).alias(f"_v_{name}"))
        out = out.join(role, out[fact_key] == F.col(f"_k_{name}"), "left").withColumn(
            name, F.coalesce(F.col(f"_v_{name}"), F.lit(fallback))
        )
    return out.drop(*[f"_k_{n}" for n in roles], *[f"_v_{n}" for n in roles])


def as_of(
    facts: DataFrame,
    versions: DataFrame,
    keys: Sequence[str],
    t: str,
    payload: Sequence[str],
    width: Width,
    tie: str,
    deleted: str | None = None,
) -> DataFrame:
    """Add to each fact the version of its key valid at its time; facts without a version are dropped.

    `versions` have the keys, `t`, `tie` (order among versions of one instant), the payload and optionally a
    boolean `deleted` that ends a version. Both sides are stacked and the latest version is carried along the key's rows, so
    the cost is one shuffle, not a range product. A version at the time of a fact is valid for it.
    """
    body = F.struct(*payload, (F.col(deleted) if deleted else F.lit(False)).alias("_deleted"))
    v = versions.select(*keys, F.col(t), F.lit(0).alias("_side"), F.col(tie).alias("_tie"), body.alias("_version"))
    f = facts.withColumns({"_side": F.lit(1), "_tie": F.lit(0).cast("long"), "_fact": F.lit(True)})
    stacked = f.unionByName(v.withColumn("_tie", F.col("_tie").cast("long")), allowMissingColumns=True)
    found = running(stacked, keys, [t, "_side", "_tie"], {"_valid": ("last", F.col("_version"))}, width)
    return (
        found.where(F.col("_fact") & F.col("_valid").isNotNull() & ~F.col("_valid._deleted"))
        .select(*facts.columns, *[F.col(f"_valid.{c}").alias(c) for c in payload])
    )


def roles_as_of(
    facts: DataFrame, versions: DataFrame, fact_id: str, position: str, person: str, value: str, roles: Mapping[str, str], width: Width, fallback: str = ""
) -> DataFrame:
    """Each fact with the values that the persons in its roles have when it arrives: (fact_id, position, one column per role).

    `versions` are (person, position, value); a version at a fact's own position counts. `roles` maps an output column to the fact's column with the person.
    A fact is one row per role, keyed by person and stacked with the versions; the latest version is carried along each person's rows, and
    the roles meet again by fact: two shuffles, however many roles. A role without a person or without a version yet has the fallback.
    """
    asked = None
    for role, column in roles.items():
        part = facts.select(F.col(column).cast("long").alias("_person"), F.col(position).cast("long").alias("_at"), F.lit(1).alias("_side"), F.col(fact_id).alias("_fact"), F.lit(role).alias("_role"))
        asked = part if asked is None else asked.unionByName(part)
    told = versions.select(F.col(person).cast("long").alias("_person"), F.col(position).cast("long").alias("_at"), F.lit(0).alias("_side"), F.struct(F.col(value).alias("v")).alias("_version"))
    stacked = asked.unionByName(told, allowMissingColumns=True)
    found = running(stacked, ["_person"], ["_at", "_side"], {"_valid": ("last", F.col("_version"))}, width).where("_side = 1")
    return regrouped(found.withColumn("_value", F.when(F.col("_person").isNotNull(), F.col("_valid.v"))), roles, fact_id, position, fallback)


def regrouped(found: DataFrame, roles: Iterable[str], fact_id: str, position: str, fallback: str) -> DataFrame:
    """(_fact, _at, _role, _value) rows to one row per fact."""
    columns = [F.coalesce(F.max(F.when(F.col("_role") == role, F.col("_value"))), F.lit(fallback)).alias(role) for role in roles]
    return found.groupBy(F.col("_fact").alias(fact_id), F.col("_at").alias(position)).agg(*columns)
