"""Strict groups, in which every member pairs with every other: by components of the pairs first, then within each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored


def components(pairs: DataFrame) -> DataFrame:
    """(id, component) of all ids of pairs (left_id, right_id): the least id that can be reached.

    Each round takes the least component among an id and its partners, then that of that id; rounds end when none changes.
    """
    both = pairs.select(F.col("left_id").alias("id"), F.col("right_id").alias("other"))
    both = stored(both.unionByName(both.select(F.col("other").alias("id"), F.col("id").alias("other"))).distinct(), "partners")
    now = stored(both.groupBy("id").agg(F.least(F.min("other"), F.col("id")).alias("component")), "components")
    while True:
        offers = both.join(now.select(F.col("id").alias("other"), F.col("component").alias("offer")), "other").groupBy("id").agg(F.min("offer").alias("offer"))
        least = stored(now.join(offers, "id").select("id", F.least("component", "offer").alias("component"), F.col("component").alias("before")), "offers")
        further = least.select(F.col("id").alias("component"), F.col("component").alias("further"))
        after = stored(least.join(further, "component", "left").select("id", F.coalesce("further", "component").alias("component"), "before"), "components")
        if after.where("component <> before").isEmpty():
            return after.select("id", "component")
        now = after.select("id", "component")


def complete_link_groups(items: DataFrame, pairs: DataFrame, id_col: str, group_by: str) -> DataFrame:
    """(group_by, id, group_id, component_size): ids in ascending order join the first group all of whose members they pair with.

    Groups never reach beyond a component of the pairs (left_id < right_id) of one group_by, so components are found by
    joins, and only inside one does the order of ids decide, in one task a component: component_size says how many ids
    that task has. An id without a pair is a group of its own and goes through no Python. Pairs across group_by, of an id
    with itself, or of ids that items lack have no effect; repeated ones neither. A group's id is its least member.
    """
    own = items.select(group_by, F.col(id_col).alias("id")).distinct()
    kind, by = (dict(own.dtypes)[c] for c in ("id", group_by))
    side = lambda c: own.select(F.col("id").alias(c), F.col(group_by).alias(f"{c}_of"))
    inside = pairs.select("left_id", "right_id").where("left_id <> right_id").join(side("left_id"), "left_id").join(side("right_id"), "right_id").where("left_id_of <=> right_id_of")
    inside = stored(inside.select(F.least("left_id", "right_id").alias("left_id"), F.greatest("left_id", "right_id").alias("right_id")).distinct(), "pairs")
    of = stored(components(inside), "component-of")
    earlier = inside.groupBy(F.col("right_id").alias("id")).agg(F.collect_list("left_id").alias("earlier"))
    members = of.join(earlier, "id", "left")

    def assign(frame):
        import pandas as pd

        groups: list[set] = []
        least: list = []
        of: dict = {}
        frame = frame.sort_values("id")
        for i, earlier in zip(frame["id"], frame["earlier"]):
            partners = set(earlier if earlier is not None else ())
            fit = min((k for k in {of[p] for p in partners} if groups[k] <= partners), default=None)
            if fit is None:
                fit = len(groups)
                groups.append(set())
                least.append(i)
            groups[fit].add(i)
            of[i] = fit
        return pd.DataFrame({"id": frame["id"].to_numpy(), "group_id": [least[of[i]] for i in frame["id"]], "component_size": len(frame)})

    grouped = members.groupBy("component").applyInPandas(assign, f"id {kind}, group_id {kind}, component_size long")
    out = own.join(grouped, "id", "left")
    return out.select(F.col(group_by).cast(by), "id", F.coalesce("group_id", "id").alias("group_id"), F.coalesce("component_size", F.lit(1)).cast("long").alias("component_size"))
