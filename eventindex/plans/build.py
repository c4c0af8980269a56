"""From a tree of container files to a stored index, at once or by what has changed."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, functions as F

from eventindex.operators.constants import STATE, constant_state, constants_of, merge_states
from eventindex.operators.dictionaries import comment_dictionary, merge_comments, merge_names, number_constants
from eventindex.operators.ranks import rank_directory
from eventindex.operators.tree import dataset_groups
from eventindex.session import configure, materialise, new_path
from eventindex.sources.containers import (Decoder, decode_files, decode_paths, leaf_rows, read_decoded,
                                           undecodable, write_decoded)
from eventindex.sources.dictionaries import Dictionaries, read_dictionaries, write_dictionaries
from eventindex.sources.files import binary_files, events_of, rejected_names, scan_files
from eventindex.sources.index import read_leaf, write_leaf
from eventindex.sources.ledger import listing, read_ledger


def build_index(spark: SparkSession, root: str, out: str, decoder: Decoder,
                extension: str = "h5", arrays: bool = True, attrs: bool = True,
                merge_with: str | None = None) -> None:
    """Index every event file below root. Files are decoded once, into `decoded`, of which the
    array payload is one partition; all further tables are made from its other columns.

    Days below root replace those days of an index already at `out`, in every table; its other
    days stay, and the dictionaries are made from all days. A day indexed anew without arrays
    keeps its earlier arrays. `merge_with` is an older index whose names, comments and constants are
    carried over; its leaves are not read.
    """
    configure(spark)
    found = materialise(listing(spark, root, extension))
    write_decoded(decode_files(binary_files(spark, root, extension), decoder, arrays), f"{out}/decoded")
    rejected_names(scan_files(spark, root, extension).select("path")).write.mode("overwrite").parquet(f"{out}/rejected_names")
    _write_days(spark, out, found, found.select("event_date").distinct(), attrs)
    _write_dictionaries(spark, out, merge_with)


class Changes(NamedTuple):
    """Files that an update has decoded, and files that it has taken out."""
    decoded: int
    removed: int


def update_index(spark: SparkSession, root: str, out: str, decoder: Decoder, extension: str = "h5",
                 arrays: bool = True, attrs: bool = True, start: str = "", end: str = "") -> Changes:
    """Bring the index at `out` up to date, from nothing if there is none. Files are compared with the
    ledger by path, length and time: only new and changed ones are opened. Rows of a changed file
    replace its earlier ones, those of a file that is gone are taken out. With a first or last day
    (yyyy-mm-dd) only these day folders are listed, and files of other days stay as they are.

    Days with new files only are added to; a day with replaced files is rewritten. The ledger is
    written last, so an update that was broken off is done again by the next one.
    """
    configure(spark)
    now, ledger = materialise(listing(spark, root, extension, start, end)), read_ledger(spark, out)
    known = ledger
    if start:
        known = known.where(F.col("event_date") >= F.lit(start).cast("date"))
    if end:
        known = known.where(F.col("event_date") <= F.lit(end).cast("date"))
    fresh = materialise(now.join(ledger, ["path", "length", "modificationTime"], "left_anti"))
    gone = materialise(known.join(now, "path", "left_anti"))
    done = Changes(fresh.count(), gone.count())
    if done == (0, 0):
        return done

    # the days concerned: as many rows as the calendar has days
    touched = fresh.unionByName(gone)
    days = touched.select("event_date").distinct()
    picked = F.col("event_date").isin([r[0] for r in days.collect()])
    kept = ledger.where(picked).join(touched.select("path"), "path", "left_anti")
    ledger_now = materialise(kept.unionByName(fresh))
    _replace_decoded(spark, out, fresh, touched, decoder, arrays, picked)
    _write_days(spark, out, ledger_now, days, attrs)
    _write_dictionaries(spark, out, None)
    return done


def _replace_decoded(spark: SparkSession, out: str, fresh: DataFrame, touched: DataFrame,
                     decoder: Decoder, arrays: bool, picked) -> None:
    """Decode the fresh files. Where the stored rows hold one of the touched files, also after an
    update that was broken off, its day is rewritten; elsewhere rows are added."""
    path = f"{out}/decoded"
    stored = read_decoded(spark, path).where(picked) if _exists(spark, path) else None
    rewrite: list = []
    if stored is not None:
        rewrite = [r[0] for r in stored.select("path", "event_date")
                   .join(touched.select("path"), "path", "left_semi").select("event_date").distinct().collect()]
    in_rewrite = F.col("event_date").isin(rewrite) if rewrite else F.lit(False)
    added, replacing = fresh.where(~in_rewrite), fresh.where(in_rewrite)
    write_decoded(decode_paths(added, decoder, arrays), path, "append")
    if rewrite:
        # the rows that stay are copied apart first, since their own folder is overwritten
        aside = new_path(spark, "update")
        decoded = decode_paths(replacing, decoder, arrays)
        (stored.where(in_rewrite).join(touched.select("path"), "path", "left_anti")
         .unionByName(decoded.select(*stored.columns)).write.parquet(aside))
        rows = spark.read.schema(stored.schema).parquet(aside)
        write_decoded(rows, path)
        left = {(r[0], r[1]) for r in rows.select("has_data", "event_date").distinct().collect()}
        _drop_folders(spark, [f"{path}/has_data={str(h).lower()}/event_date={d}"
                              for h in (True, False) for d in rewrite if (h, d) not in left])


def _write_days(spark: SparkSession, out: str, files: DataFrame, days: DataFrame, attrs: bool) -> None:
    """Write all tables of some days anew; `files` are the ledger rows of these days."""
    decoded = read_decoded(spark, f"{out}/decoded")
    # as many as the calendar has; as values they choose folders, and no row is shuffled by its day
    wanted = [r[0] for r in days.where("event_date IS NOT NULL").collect()]
    rows = decoded.where(F.col("event_date").isin(wanted))
    events = events_of(files.select("path"))
    _write_by_day(events, f"{out}/events")
    _write_by_day(rank_directory(events, "event_date"), f"{out}/ranks")
    write_leaf(leaf_rows(rows), f"{out}/leaf", attrs=attrs)
    undecodable(decoded).write.mode("overwrite").parquet(f"{out}/undecodable")
    # days that hold nothing any more have no rows to overwrite them with
    held = {r[0] for r in files.select("event_date").distinct().collect()}
    emptied = [d for d in wanted if d not in held]
    _drop_folders(spark, [f"{out}/{t}/event_date={d}" for d in emptied
                          for t in ("events", "ranks", "leaf", "constants_state", "ledger")])
    leaf = read_leaf(spark, f"{out}/leaf").where(F.col("event_date").isin(wanted))
    state = constant_state(leaf, by=("event_date",)).select(*STATE.names)
    _write_by_day(state, f"{out}/constants_state")
    dataset_groups(read_leaf(spark, f"{out}/leaf")).write.mode("overwrite").parquet(f"{out}/groups")
    _write_by_day(files, f"{out}/ledger")


def _write_by_day(rows: DataFrame, path: str) -> None:
    (rows.write.mode("overwrite").partitionBy("event_date")
     .option("partitionOverwriteMode", "dynamic").parquet(path))


def read_constants_state(spark: SparkSession, out: str) -> DataFrame:
    """The state of constants of an index, by day."""
    return spark.read.schema(STATE).parquet(f"{out}/constants_state")


def _write_dictionaries(spark: SparkSession, out: str, merge_with: str | None) -> None:
    """Names and constants come from the merged state, comments from the leaf rows that have one."""
    states = read_constants_state(spark, out)
    comments = comment_dictionary(read_leaf(spark, f"{out}/leaf"))
    if merge_with and merge_with.rstrip("/") != out.rstrip("/"):
        states = states.unionByName(read_constants_state(spark, merge_with))
    state = materialise(merge_states(states))
    names = state.select("dataset_name")
    if merge_with:
        old = read_dictionaries(spark, f"{merge_with}/dictionaries")
        # computed before anything is overwritten, for the older index may be this one
        names = materialise(merge_names(old.names, names))
        comments = materialise(merge_comments(old.comments, comments))
    constants = number_constants(constants_of(state))
    write_dictionaries(Dictionaries(names, comments, constants), f"{out}/dictionaries")


def _folder(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()), found


def _exists(spark: SparkSession, path: str) -> bool:
    fs, folder = _folder(spark, path)
    return fs.exists(folder)


def _drop_folders(spark: SparkSession, paths: list[str]) -> None:
    for path in paths:
        fs, folder = _folder(spark, path)
        fs.delete(folder, True)
