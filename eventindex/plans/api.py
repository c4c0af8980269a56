"""The calls users make: find datasets, restrict events, load columns, groups or arrays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from eventindex.functions.names import parent_group
from eventindex.functions.times import day_dir, whole_hours
from eventindex.operators.cuts import all_pass, any_cut_name, apply_cuts, cut_aggregates, parse_cuts
from eventindex.operators.dictionaries import matched_names
from eventindex.operators.frames import prepare_frames
from eventindex.operators.groups import anchor_events, group_metadata, group_values
from eventindex.operators.locate import fetch_entries
from eventindex.operators.ordinals import select_ordinals
from eventindex.operators.payload import attach_payload, missing_payload
from eventindex.operators.select import EVENT, name_condition, pivot_columns, time_range
from eventindex.operators.shortlist import keep_operating, shortlist, with_facts
from eventindex.operators.spectra import BINS, peak_frequency
from eventindex.operators.tree import in_subtrees
from eventindex.operators.wide import pivot_wide
from eventindex.session import configure
from eventindex.sources.containers import Decoder, payload_rows, read_decoded
from eventindex.sources.dictionaries import read_dictionaries
from eventindex.sources.index import read_groups, read_leaf, read_ranks


def event_path(root: str, extension: str = "h5") -> Column:
    """Path of an event's container file, from its day and key alone."""
    return F.concat(F.lit(root.rstrip("/") + "/"), day_dir(F.col("event_date")), F.lit("/"),
                    F.col("event_key"), F.lit("." + extension))


class EventIndex:
    """An index and its dictionaries. Loaders return lazy DataFrames. Collected are only the list of
    dataset names to load, as it becomes the columns of the result, and, where positions of events
    are asked for, the numbers of events per hour (`ranks`, or counted).
    """

    def __init__(self, events: DataFrame, leaf: DataFrame, names: DataFrame,
                 comments: DataFrame, payload: DataFrame | None = None, root: str = "",
                 match: str = "equals", strict: bool = False, missing: str = "pass",
                 ranks: DataFrame | None = None, groups: DataFrame | None = None):
        self.ranks, self.groups = ranks, groups
        self.events, self.leaf, self.payload = events, leaf, payload
        self.names, self.comments, self.root = names, comments, root
        self.match, self.strict, self.missing = match, strict, missing

    @classmethod
    def open(cls, spark: SparkSession, path: str, root: str = "", **options) -> "EventIndex":
        configure(spark)
        stored = read_dictionaries(spark, f"{path}/dictionaries")
        return cls(spark.read.parquet(f"{path}/events"), read_leaf(spark, f"{path}/leaf"),
                   stored.names, stored.comments,
                   payload_rows(read_decoded(spark, f"{path}/decoded")), root,
                   ranks=read_ranks(spark, path), groups=read_groups(spark, path), **options)

    def find(self, keywords: str = "", comment: str = "") -> DataFrame:
        """Dataset names found by keyword or comment."""
        return matched_names(self.names, self.comments, keywords, comment)

    def resolve(self, keywords: str = "", comment: str = "", pick: str | None = None) -> list[str]:
        """Names to load: all found, or those at the picked positions in name order."""
        return [r["dataset_name"] for r in self._found(keywords, comment, pick).collect()]

    def _found(self, keywords: str, comment: str, pick: str | None) -> DataFrame:
        found = self.find(keywords, comment).select("dataset_name")
        if pick is not None:
            found = select_ordinals(found, pick, ("dataset_name",)).drop("ordinal")
        return found.orderBy("dataset_name")

    def _resolve_one(self, keywords: str, comment: str, pick: str | None) -> str | None:
        found = [r["dataset_name"] for r in self._found(keywords, comment, pick).limit(2).collect()]
        if len(found) > 1:
            raise ValueError("several datasets match, pick one by position: "
                             + ", ".join(found) + ", ...")
        return found[0] if found else None

    def listing(self, start: str, end: str) -> DataFrame:
        """Events in the time range; positions given to the loaders refer to this listing in
        (event_ts, event_key) order."""
        return time_range(self.events, start, end)

    def _with_path(self, rows: DataFrame, start: str, end: str) -> DataFrame:
        """Rows with the path of the event's file, as it was listed; of several files of one event
        the first by name. A path that is not known is made from day and key. The join goes away
        where the path is not asked for, as its right side holds each key once."""
        made = event_path(self.root)
        if "path" not in self.events.columns:
            return rows.withColumn("path", made)
        listed = (self.listing(start, end).groupBy("event_date", "event_key")
                  .agg(F.min("path").alias("_listed")))
        return (rows.join(listed, ["event_date", "event_key"], "left").withColumn("path", F.coalesce("_listed", made))
                .select(*rows.columns, "path"))

    def _pick(self, rows: DataFrame, start: str, end: str, picked: str | None) -> DataFrame:
        """Rows of the events at the picked positions of the listing."""
        if picked is None:
            return rows
        chosen = select_ordinals(self.listing(start, end).select("event_date", "event_ts", "event_key"), picked,
                                 directory=self.ranks, inner=whole_hours(start, end))
        return rows.join(chosen.select("event_key"), "event_key", "left_semi")

    def load_column(self, keywords: str = "", comment: str = "", start: str = "", end: str = "",
                    cuts: str = "", datasets: str | None = None, events: str | None = None,
                    numeric: bool = False, max_columns: int = 10_000) -> DataFrame:
        """One row per event: time, one column per dataset, file path. Cuts and columns are
        taken in the same aggregation, so the leaf rows are shuffled once. `numeric` loads the
        numbers instead of the stored text. A table wider than `max_columns` is an error, not a
        shortened table."""
        names = [r["dataset_name"] for r in self._found(keywords, comment, datasets)
                 .limit(max_columns + 1).collect()]
        if len(names) > max_columns:
            raise ValueError(f"more than {max_columns} columns; pick some, or raise max_columns")
        return self.load_named(dict(zip(names, names)), start, end, cuts, events, numeric)

    def load_named(self, names: dict[str, str], start: str, end: str, cuts: str = "",
                   events: str | None = None, numeric: bool = False) -> DataFrame:
        """load_column for known datasets; `names` maps output columns to dataset names."""
        wanted = parse_cuts(cuts)
        rows = self._pick(time_range(self.leaf, start, end), start, end, events)
        if not names:
            return self._with_path(rows.select(*EVENT).where(F.lit(False)), start, end)
        relevant = name_condition(list(names.values()), self.match)
        if wanted:
            relevant = relevant | any_cut_name(wanted, self.match)
        table = pivot_columns(rows.where(relevant), names,
                              "value_num" if numeric else "value", self.match,
                              extra=cut_aggregates(wanted, self.match))
        keep = all_pass(wanted, self.strict, self.missing) & (F.col("_found") > 0)
        columns = [F.col(f"`{c}`") for c in names]
        return self._with_path(table.where(keep).select(*EVENT, *columns), start, end)

    def load_wide(self, names: dict[str, str], start: str, end: str, cuts: str = "",
                  events: str | None = None, numeric: bool = False) -> DataFrame:
        """As load_named for thousands of datasets, matched by equality: the work does not grow with
        rows times columns. Cuts are judged by themselves, in a further aggregation."""
        rows = self._pick(time_range(self.leaf, start, end), start, end, events)
        if not names:
            return self._with_path(rows.select(*EVENT).where(F.lit(False)), start, end)
        table = pivot_wide(rows, names, "value_num" if numeric else "value")
        kept = apply_cuts(table, time_range(self.leaf, start, end), parse_cuts(cuts), self.match, self.strict,
                          self.missing)
        return self._with_path(kept.select(*table.columns), start, end)

    def _group(self, name: str | None, start: str, end: str, cuts: str, events: str | None
               ) -> dict:
        """Arguments of the group loaders: leaf rows, dataset, and the events to load it from."""
        leaf = time_range(self.leaf, start, end)
        if name is None:  # an unmatched search loads nothing, but with the usual columns
            return {"leaf": leaf.where(F.lit(False)), "dataset_name": "/", "match": self.match}
        anchors = anchor_events(leaf, name, self.match, parse_cuts(cuts), self.strict,
                                self.missing)
        if self.match != "equals" and self.groups is not None:
            leaf = in_subtrees(leaf, self.groups, name, self.match)
        return {"leaf": leaf, "dataset_name": name, "match": self.match,
                "anchors": self._pick(anchors, start, end, events)}

    def load_group_metadata(self, keywords: str = "", comment: str = "", start: str = "",
                            end: str = "", cuts: str = "", datasets: str | None = None,
                            events: str | None = None) -> DataFrame:
        """The group of one dataset, per event as a map of dataset name to value."""
        name = self._resolve_one(keywords, comment, datasets)
        found = group_metadata(**self._group(name, start, end, cuts, events))
        return self._with_path(found.withColumn("dataset_name", F.lit(name)), start, end)

    def _arrays(self, name: str | None, start: str, end: str) -> DataFrame:
        """Payload in the days of the range; of the dataset's group only, where that is known."""
        days = self.payload
        if start:
            days = days.where(F.col("event_date") >= F.lit(start[:10]).cast("date"))
        if end:
            days = days.where(F.col("event_date") <= F.lit(end[:10]).cast("date"))
        if name is None or self.match != "equals":
            return days
        return days.where(F.col("dataset_name").startswith(parent_group(name).rstrip("/") + "/"))

    def search(self, keywords: str = "", comment: str = "", start: str = "", end: str = "",
               cuts: str = "", datasets: str | None = None, events: str | None = None,
               decoder: Decoder | None = None) -> DataFrame:
        """The group of one dataset with its arrays: a row per event and dataset, holding the
        value or the array. With a decoder, arrays are read from the event files that the listing
        names, and no payload need be stored; `missing` then tells why an array is not there."""
        name = self._resolve_one(keywords, comment, datasets)
        rows = group_values(**self._group(name, start, end, cuts, events))
        if decoder is not None:
            return fetch_entries(rows, self.listing(start, end), decoder)
        return attach_payload(self._with_path(rows, start, end), self._arrays(name, start, end))

    def rejects(self, found: DataFrame) -> DataFrame:
        """Rows of a search whose array is not stored."""
        return missing_payload(found.drop("data"), self.payload)

    def frames(self, keywords: str = "", comment: str = "", start: str = "", end: str = "",
               cuts: str = "", datasets: str | None = None, events: str | None = None,
               decoder: Decoder | None = None) -> DataFrame:
        """Median-filtered frames of one image dataset, for events whose group metadata gives
        width and height. With a decoder, pixels are read from the event files."""
        name = self._resolve_one(keywords, comment, datasets)
        images = group_metadata(**self._group(name, start, end, cuts, events))
        if decoder is not None:
            sought = images.withColumns({"dataset_name": F.lit(name), "value": F.lit(None).cast("string")})
            found = fetch_entries(sought, self.listing(start, end), decoder)
            return prepare_frames(found.where("data IS NOT NULL").drop("value", "missing"))
        arrays = self._arrays(name, start, end).where(F.col("dataset_name") == F.lit(name))
        joined = images.join(arrays, ["event_date", "event_key"])
        return prepare_frames(joined)

    def peak_frequencies(self, image: str, axis: str, width: int, height: int, start: str,
                         end: str, cuts: str = "", events: str | None = None, bins: int = BINS
                         ) -> DataFrame:
        """Strongest frequency of one image dataset per event, over the time axis stored in
        another dataset; both arrays come from the payload."""
        anchors = self._group(image, start, end, cuts, events)["anchors"].select("event_key")
        frames, axes = (
            self._arrays(name, start, end).where(F.col("dataset_name") == F.lit(name))
            .select("event_date", "event_key", F.col("data").alias(column))
            for name, column in ((image, "data"), (axis, "axis")))
        joined = (frames.join(anchors, "event_key", "left_semi")
                  .join(axes, ["event_date", "event_key"])
                  .withColumns({"width": F.lit(width), "height": F.lit(height)}))
        return peak_frequency(joined, bins=bins)

    def streak_shortlist(self, names: dict[str, str], start: str, end: str, cuts: str = "",
                         **wanted) -> DataFrame:
        """Events recorded with open shutter in operate mode, and with the given settings.
        `names` must have an `info` column holding the free text."""
        table = self.load_named(names, start, end, cuts)
        return shortlist(keep_operating(with_facts(table)), **wanted)
