"""Windows, top-k and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from shelfwright.functions import text as T
from shelfwright.operators.common import PER_PART, with_previous, with_running_sum


def rank_candidates(guarded: DataFrame, most: int = 6) -> DataFrame:
    """Best score first, the provider's order on ties, the first `most` of each item."""
    order = Window.partitionBy("rk").orderBy(F.desc("score"), "provider_rank", "cand_id")
    return guarded.withColumn("place", F.row_number().over(order)).where(F.col("place") <= most)


def pick_subtitle(tracks: DataFrame) -> DataFrame:
    """Each item's tracks, the fullest one that is not forced (or null there) picked, the others duplicates."""
    order = Window.partitionBy("rk").orderBy(F.desc("cues"), F.desc("ordinal"))
    return tracks.where(~F.coalesce("forced", F.lit(False))).withColumn("picked", F.row_number().over(order) == 1)


def best_card_frame(frames: DataFrame, files: DataFrame, floor: float = 0.6) -> DataFrame:
    """The frame that shows most of a file's title, the earliest of equals; OK, MISMATCH or SKIP (no title)."""
    scored = frames.join(files, "file_id").withColumn("score", T.card_score(F.col("title"), F.col("text")))
    best = scored.groupBy("file_id", "title").agg(F.min_by(F.struct("score", "t"), F.struct(-F.col("score"), F.col("t"))).alias("b"))
    verdict = F.when(F.coalesce("title", F.lit("")) == "", "SKIP").when(F.col("b.score") >= floor, "OK").otherwise("MISMATCH")
    return best.select("file_id", F.col("b.score").alias("score"), F.when(F.col("b.score") > 0, F.col("b.t")).alias("t"), verdict.alias("verdict"))


def longest_titles(titles: DataFrame, n: int = 3) -> DataFrame:
    """The n longest titles of each disc."""
    return titles.withColumn("place", F.row_number().over(Window.partitionBy("disc").orderBy(F.desc("sec"), "title"))).where(F.col("place") <= n)


def commentary_positions(titles: DataFrame) -> DataFrame:
    """Titles with one audio track more than both neighbours on their disc."""
    w = Window.partitionBy("disc").orderBy("title")
    rows = titles.withColumns({"before": F.lag("audio").over(w), "after": F.lead("audio").over(w)})
    return rows.where((F.col("audio") == F.col("before") + 1) & (F.col("audio") == F.col("after") + 1)).select("disc", "title", "audio")


def append_specials(existing: DataFrame, new: DataFrame) -> DataFrame:
    """New extras numbered on from the last one; what exists keeps its number."""
    last = existing.groupBy("show").agg(F.max("idx").alias("last"))
    place = F.row_number().over(Window.partitionBy("show").orderBy("name"))
    return new.join(last, "show", "left").withColumn("idx", F.coalesce("last", F.lit(0)) + place).drop("last")


def uniform_shift(agent: DataFrame, files: DataFrame) -> DataFrame:
    """Seasons whose files all stand off by the same number, not 0, from the agent's places of their titles."""
    # Titles that repeat meet once: of a title's pairs only the outermost places and the number count.
    def ends(rows: DataFrame, side: str) -> DataFrame:
        by = rows.groupBy("show", "season", T.normalize_title(F.col("title")).alias("t"))
        return by.agg(F.min("idx").alias(f"{side}_lo"), F.max("idx").alias(f"{side}_hi"), F.count("*").alias(f"{side}_n"))

    met = ends(agent, "a").join(ends(files, "b"), ["show", "season", "t"])
    spans = met.groupBy("show", "season").agg(F.min(F.col("a_lo") - F.col("b_hi")).alias("shift"), F.max(F.col("a_hi") - F.col("b_lo")).alias("hi"), F.sum(F.col("a_n") * F.col("b_n")).alias("n"))
    return spans.where("shift = hi and shift <> 0 and n > 1").drop("hi")


def rename_plan(files: DataFrame, shifts: DataFrame) -> DataFrame:
    """New numbers in the order in which renaming collides with nothing: from the far end of the shift."""
    rows = files.join(shifts, ["show", "season"]).withColumn("new_idx", F.col("idx") + F.col("shift"))
    order = F.row_number().over(Window.partitionBy("show", "season").orderBy(F.when(F.col("shift") > 0, -F.col("idx")).otherwise(F.col("idx"))))
    return rows.withColumn("step", order)


def subset_renumber(cues: DataFrame, lo: float, hi: float) -> DataFrame:
    """Cues that begin in [lo, hi), numbered from 1 in each file."""
    part = cues.where((F.col("start_s") >= lo) & (F.col("start_s") < hi))
    return part.withColumn("n", F.row_number().over(Window.partitionBy("file_id").orderBy("start_s", "cue")))


def failure_runs(log: DataFrame, n: int = 15, failure: str = "search_fail", per_part: int = PER_PART) -> DataFrame:
    """Runs of failures in a row by key, and whether one is long enough to abort; a success ends a run. A key with more than
    per_part rows is scanned in parts."""
    rows = with_running_sum(log, ["rk"], ["ts", "event_id"], F.when(F.col("event") != failure, 1).otherwise(0), "run", per_part)
    runs = rows.where(F.col("event") == failure).groupBy("rk", "run").agg(F.count("*").alias("failures"), F.min("event_id").alias("first_event"))
    return runs.withColumn("abort", F.col("failures") >= n)


def transitions(obs: DataFrame, per_part: int = PER_PART) -> DataFrame:
    """Rows whose status differs from the one before. A key with more than per_part rows is scanned in parts."""
    return with_previous(obs, ["rk"], ["ts", "event_id"], "event", "before", per_part).where(~F.col("event").eqNullSafe(F.col("before")))


def first_plausible(attempts: DataFrame, bound: float = 30.0) -> DataFrame:
    """Per item the first detector with a result within the bound, else the last one tried."""
    ok = F.col("offset").isNotNull() & (F.abs("offset") < bound)
    took = F.struct("detector", "offset")
    return attempts.groupBy("rk").agg(F.coalesce(F.min_by(F.when(ok, took), F.when(ok, F.col("detector"))), F.max_by(took, "detector")).alias("x")).select("rk", "x.detector", "x.offset")


def merge_state(old: DataFrame, new: DataFrame) -> DataFrame:
    """O2: the latest row of each key of both; of equal times the one that was added later."""
    both = old.withColumn("_age", F.lit(0)).unionByName(new.withColumn("_age", F.lit(1)))
    names = [c for c in old.columns if c != "rk"]
    latest = both.groupBy("rk").agg(F.max_by(F.struct(*names), F.struct("ts", "_age", *[c for c in names if c != "ts"])).alias("x"))
    return latest.select("rk", *(F.col(f"x.{c}").alias(c) for c in names))


def empty_folders(folders: DataFrame, files: DataFrame, now, quiet_s: int = 300) -> DataFrame:
    """Folders with neither files nor folders that were quiet for a while and could be listed; a report, nothing is removed."""
    parents = folders.select(F.col("parent").alias("folder"))
    bare = folders.where("listed").join(files.select("folder"), "folder", "left_anti").join(parents, "folder", "left_anti")
    return bare.where(F.col("modified") < F.lit(now) - F.expr(f"INTERVAL {quiet_s} SECONDS"))
