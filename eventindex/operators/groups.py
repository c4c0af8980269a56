"""Whole groups of datasets per event."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from eventindex.functions.names import parent_group
from eventindex.functions.values import missing_to_null
from eventindex.operators.cuts import Cut, all_pass, any_cut_name, cut_aggregates
from eventindex.operators.select import EVENT, first_of, fresh_keys, name_condition


def in_group(group: str):
    """The group itself or a descendant, as conditions the scan can evaluate."""
    name = F.col("group_name")
    below = group if group.endswith("/") else group + "/"
    return (name == group) | name.startswith(below)


def anchor_events(leaf: DataFrame, dataset_name: str, match: str = "equals",
                  cuts: list[Cut] | None = None, strict: bool = False, missing: str = "pass"
                  ) -> DataFrame:
    """(event_key, anchor_group) of the events that hold the dataset and pass the cuts, in one
    aggregation over the rows of these datasets only. `anchor_group` is the group of the
    dataset's first row."""
    cuts, is_anchor = cuts or [], name_condition(dataset_name, match)
    relevant = is_anchor | any_cut_name(cuts, match) if cuts else is_anchor
    firsts = [agg.alias(c) for c, agg in cut_aggregates(cuts, match).items()]
    # a full dataset path names its group; otherwise the group is read from the row
    group = (F.lit(parent_group(dataset_name)) if match == "equals"
             else first_of(F.col("group_name"), is_anchor))
    return (leaf.where(relevant).groupBy("event_key")
            .agg(F.count_if(is_anchor).alias("_held"), *firsts, group.alias("anchor_group"))
            .where((F.col("_held") > 0) & all_pass(cuts, strict, missing))
            .select("event_key", "anchor_group"))


def expand_group(leaf: DataFrame, dataset_name: str, match: str = "equals",
                 anchors: DataFrame | None = None) -> DataFrame:
    """All leaf rows of the dataset's parent group and its subgroups, in the anchor events (by
    default every event holding the dataset)."""
    if anchors is None:
        anchors = anchor_events(leaf, dataset_name, match)
    anchors = fresh_keys(anchors)
    if match == "equals":
        # the group is known, so the scan skips all others and only the event is joined
        return leaf.where(in_group(parent_group(dataset_name))).join(anchors, "event_key")
    group, anchor = F.col("group_name"), F.col("anchor_group")
    below = F.when(F.endswith(anchor, F.lit("/")), anchor).otherwise(F.concat(anchor, F.lit("/")))
    return (leaf.join(anchors, "event_key")
            .where((group == anchor) | F.startswith(group, below)))


def group_values(leaf: DataFrame, dataset_name: str, match: str = "equals",
                 anchors: DataFrame | None = None) -> DataFrame:
    """First value of every dataset of the group, one row per event and dataset."""
    return (expand_group(leaf, dataset_name, match, anchors)
            .groupBy(*EVENT, "anchor_group", "dataset_name")
            .agg(F.min_by(missing_to_null(F.col("value")), "seq").alias("value")))


def group_metadata(leaf: DataFrame, dataset_name: str, match: str = "equals",
                   anchors: DataFrame | None = None) -> DataFrame:
    """One map per event. Names are unique after group_values, so a map holds at most the
    datasets of one group, however many rows the event has."""
    entry = F.struct("dataset_name", "value")
    return (group_values(leaf, dataset_name, match, anchors)
            .groupBy(*EVENT, F.col("anchor_group").alias("group_name"))
            .agg(F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("metadata")))
