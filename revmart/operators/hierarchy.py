"""Manager chains: the managers above every user, up to a fixed number of levels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revmart.operators.lookups import Lookup, enrich, exists_flag, fits_broadcast

MANAGER_ATTRS = {"user_id": "user_id", "user_name": "name", "title": "title"}


def level_column(level: int, attr: str) -> str:
    return f"manager_level_{level}_{attr}"


def with_manager_flag(users: DataFrame) -> DataFrame:
    """Add ``is_manager_flag``: whether some user reports to this one."""
    managers = users.select(F.col("manager_id").alias("_manager"))
    return exists_flag(users, managers, "user_id", "_manager", "is_manager_flag")


def manager_chain(users: DataFrame, levels: int = 7) -> DataFrame:
    """Add ``manager_level_<k>_{user_id,name,title}`` for every level.

    ``users`` needs ``user_id, manager_id, user_name, title`` with unique ids.  A chain ends at the first manager that
    is missing; a cycle fills all levels.  Users that may be broadcast are looked up once per level, without a shuffle; chains of
    more users are doubled: three joins of narrow rows give seven levels, and the wide rows move once.
    """
    # Every level's join counts the broadcast users as its own memory.
    if fits_broadcast(users, ["manager_id", *MANAGER_ATTRS], times=levels):
        return _chain_by_level(users, levels)
    above = doubled_chains(users, levels)
    named = [F.get("_above", F.lit(k - 1))[a].alias(level_column(k, b)) for k in range(1, levels + 1) for a, b in MANAGER_ATTRS.items()]
    chains = above.select(F.col("user_id").alias("_chain_of"), *named).hint("merge")
    return users.join(chains, F.col("user_id") == F.col("_chain_of"), "left").drop("_chain_of")


def _chain_by_level(users: DataFrame, levels: int) -> DataFrame:
    out = users
    for level in range(1, levels + 1):
        fk = "manager_id" if level == 1 else f"_next_{level - 1}"
        attrs = {a: level_column(level, b) for a, b in MANAGER_ATTRS.items()} | {"manager_id": f"_next_{level}"}
        out = enrich(out, [Lookup(users, fk, "user_id", attrs)])
    return out.drop(*[f"_next_{level}" for level in range(1, levels + 1)])


def doubled_chains(users: DataFrame, levels: int) -> DataFrame:
    """``user_id, _above``: the users above each user in order, at least ``levels`` of them where the chain is that long.

    A row holds a stretch of the chain, the user first, and who comes after it.  A join appends the stretch that
    begins there, so stretches double until they are long enough.
    """
    person = F.struct(*MANAGER_ATTRS)
    chains = users.where(F.col("user_id").isNotNull()).select("user_id", F.array(person).alias("_chain"), F.col("manager_id").alias("_next"))
    length = 1
    while length <= levels:
        # Sorted rows spill where they outgrow a task's memory; broadcast stretches would be held whole, twice as long every time.
        ahead = chains.select(F.col("user_id").alias("_of"), F.col("_chain").alias("_more"), F.col("_next").alias("_after")).hint("merge")
        # Ended chains meet nobody; with their own user as the key they spread over the tasks, unlike NULLs.
        met = (F.coalesce("_next", "user_id") == F.col("_of")) & F.col("_next").isNotNull()
        joined = chains.join(ahead, met, "left")
        more = F.coalesce(F.col("_more"), F.array().cast(chains.schema["_chain"].dataType))
        chains = joined.select("user_id", F.concat("_chain", more).alias("_chain"), F.col("_after").alias("_next"))
        length *= 2
    return chains.select("user_id", F.slice("_chain", 2, levels).alias("_above"))


def chain_depth(levels: int = 7) -> Column:
    """Deepest level that resolves to a manager, 0 without one."""
    depth = F.lit(0)
    for level in range(1, levels + 1):
        depth = F.when(F.col(level_column(level, "user_id")).isNotNull(), level).otherwise(depth)
    return depth


def top_value(attr: str, levels: int = 7) -> Column:
    """The attribute's value at the deepest level that has one."""
    return F.coalesce(*[F.col(level_column(level, attr)) for level in range(levels, 0, -1)])
