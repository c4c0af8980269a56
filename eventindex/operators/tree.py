"""The hierarchy of groups, from the dictionary of dataset names: which subtrees a search can need.

A search by part of a name or by a pattern says nothing about groups. The dictionary does: the groups
of the names that match are found there, those that lie inside another of them are left out, and what
remains bounds the leaf rows to be read, as conditions that the scan evaluates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from eventindex.operators.select import name_condition

MOST_SUBTREES = 32   # subtrees written as conditions of the scan; more of them are joined


def dataset_groups(leaf: DataFrame) -> DataFrame:
    """Each dataset name with its group, once: the dictionary this module works on."""
    return leaf.select("dataset_name", "group_name").distinct()


def ancestors(group: Column) -> Column:
    """The groups around a group, the root first, itself not among them."""
    parts = F.filter(F.split(group, "/"), lambda p: p != "")
    proper = F.transform(F.sequence(F.lit(1), F.greatest(F.size(parts), F.lit(1))), lambda n: F.when(
        n < F.size(parts) + 1, F.concat(F.lit("/"), F.array_join(F.slice(parts, 1, n - 1), "/"))))
    return F.when(F.size(parts) > 0, F.array_compact(proper)).otherwise(F.array().cast("array<string>"))


def matched_subtrees(groups: DataFrame, name: str, match: str) -> DataFrame:
    """`group_name` of the groups that hold a matching dataset and lie in no other such group."""
    found = groups.where(name_condition(name, match)).select("group_name").distinct()
    # found is read twice: each group is sought among the ancestors' side of the join
    around = found.select("group_name", F.explode(ancestors(F.col("group_name"))).alias("around"))
    inner = around.join(found.select(F.col("group_name").alias("around")), "around", "left_semi")
    return found.join(inner.select("group_name"), "group_name", "left_anti")


def below(group: str) -> Column:
    """The group itself or a descendant, as conditions that the scan can evaluate."""
    name = F.col("group_name")
    return (name == group) | name.startswith(group if group.endswith("/") else group + "/")


def in_subtrees(leaf: DataFrame, groups: DataFrame, name: str, match: str) -> DataFrame:
    """Leaf rows that a group expansion of the matching datasets can need."""
    tops = matched_subtrees(groups, name, match)
    some = [r[0] for r in tops.orderBy("group_name").limit(MOST_SUBTREES + 1).collect()]
    if len(some) <= MOST_SUBTREES:
        condition = F.lit(False)
        for group in some:
            condition = condition | below(group)
        return leaf.where(condition)
    # the dictionary's groups below one of the many subtrees
    every = groups.select("group_name").distinct()
    reach = every.select("group_name", F.explode(F.concat(
        ancestors(F.col("group_name")), F.array("group_name"))).alias("top"))
    needed = reach.join(tops.select(F.col("group_name").alias("top")), "top", "left_semi").select("group_name").distinct()
    return leaf.join(needed, "group_name", "left_semi").select(*leaf.columns)
