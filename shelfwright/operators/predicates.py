"""Filters and classifications: each returns rows with a verdict."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfwright.operators.common import PER_PART, dealt, key_sizes, median_over, with_rint_median
from shelfwright.session import stored

# Codecs of text subtitles; reasons that identify nothing.
TEXT_CODECS = ["srt", "ass", "ssa", "subrip", "webvtt"]
NO_REASON = r"(?i)^(too short|short|duplicate|dupe|not needed|n/?a|junk|skip)\.?$"


def needs_subtitles(items: DataFrame, streams: DataFrame, lang: str = "en") -> DataFrame:
    """Items without a text stream of the language that is not forced; image streams do not count.

    The language is the code, or where that is missing or empty the language's name (column language, if there is one), in
    any case; a null forced is not forced.
    """
    name = F.col("language") if "language" in streams.columns else F.lit(None)
    code = F.lower(F.coalesce(F.nullif("language_code", F.lit("")), name, F.lit("")))
    usable = streams.where((F.col("stream_type") == 3) & F.col("codec").isin(TEXT_CODECS) & ~F.coalesce("forced", F.lit(False)) & F.startswith(code, F.lit(lang)))
    return items.join(usable, "rk", "left_anti")


def cover_band(last_cue: Column, dur: Column, cues: Column) -> Column:
    """Fit, rescale or null by last cue over running time; the rescale band below is tested after fit and never holds alone."""
    cover = F.when(cues > 0, last_cue / dur).otherwise(0.0)
    return F.when(cues < 20, F.lit(None)).when(cover.between(0.85, 1.02), "fit").when(cover.between(1.021, 1.075) | cover.between(0.930, 0.975), "rescale")


def boilerplate_durations(probed: DataFrame) -> DataFrame:
    """A3: durations (3 places) below 600 s that occur on 3 discs or more; all titles count."""
    sec3 = F.bround("sec", 3).alias("sec3")
    once = probed.where("sec < 600").select(sec3, "disc").distinct()
    return once.groupBy("sec3").agg(F.count("*").alias("discs")).where("discs >= 3")


def classify_probed_titles(probed: DataFrame, per_part: int = PER_PART) -> DataFrame:
    """Every title with a running time labelled ARTIFACT, BOILERPLATE, PLAYALL?, EPISODE? or REVIEW; none is dropped."""
    real = F.col("has_video") & (F.col("sec") > 15) & ~(F.col("phantom") & (F.col("sec") < 120))
    probed = stored(probed.select("disc", "title", "sec", F.bround("sec", 3).alias("sec3"), real.alias("real")), "probed")  # read by each step below
    rows = probed.where("sec > 0")
    total, largest = key_sizes(rows, ["disc"])
    if largest <= per_part:
        # Each disc whole in one task, which scans it by windows.
        own, known = Window.partitionBy("disc"), F.col("disc").isNotNull()
        rows = dealt(rows, ["disc"], total).withColumn("place", F.row_number().over(own.orderBy(F.desc("real"), F.desc("sec"), "title")))
        of = lambda place, c: F.when(known, F.max(F.when(F.col("real") & (F.col("place") == place), F.col(c))).over(own))
        rows = rows.withColumns({"head": of(1, "title"), "second": of(2, "sec")})
    else:
        # The two longest of a disc: each task hands on two rows of it at most, however many it has.
        longest = F.row_number().over(Window.partitionBy("disc").orderBy(F.desc("sec"), "title"))
        two = rows.where("real").select("disc", "title", "sec", longest.alias("place")).where("place <= 2")
        heads = two.groupBy("disc").agg(F.max(F.when(F.col("place") == 1, F.col("title"))).alias("head"), F.max(F.when(F.col("place") == 2, F.col("sec"))).alias("second"))
        rows = rows.join(heads, "disc", "left")
    rows = rows.withColumn("is_head", F.col("real") & F.col("title").eqNullSafe(F.col("head")))
    judged = F.col("real") & ~F.col("is_head")
    rows = median_over(rows, ["disc"], "sec", "median", judged) if largest <= per_part else with_rint_median(rows, ["disc"], "sec", "median", judged, per_part)
    # Durations from 0 to 600 s in thousandths: 600,000 rows at most.
    reels = boilerplate_durations(probed).where("sec3 >= 0").select("sec3", F.lit(True).alias("reel"))
    rows = rows.join(F.broadcast(reels), "sec3", "left")
    med = F.coalesce("median", F.lit(0.0))
    label = (
        F.when(~F.col("real"), "ARTIFACT")
        .when(F.col("reel"), "BOILERPLATE")
        .when(F.col("is_head") & (F.col("sec") >= 1.5 * F.col("second")), "PLAYALL?")
        .when((med > 0) & (F.abs(F.col("sec") - med) <= 0.25 * med), "EPISODE?")
        .otherwise("REVIEW")
    )
    return rows.withColumn("label", label).select("disc", "title", "sec", "label")


def bad_exclusions(dispositions: DataFrame) -> DataFrame:
    """P10: exclusions whose note is missing, shorter than 8 characters or no identification."""
    note = F.trim(F.coalesce("note", F.lit("")))
    return dispositions.where((F.col("kind") == "exclude") & ((F.length(note) < 8) | note.rlike(NO_REASON)))


def offset_verdict(alignments: DataFrame) -> DataFrame:
    """What a measured offset is worth; a value at the search bound is no measurement."""
    off = F.col("offset")
    verdict = (
        F.when(off.isNull(), "align_fail")
        .when(F.abs(F.abs(off) - 60) < 3, "align_railed")
        .when(F.abs(off) > 30, "needs_review")
        .when((F.abs(off) < 0.15) & (F.abs(F.col("scale") - 1) <= 0.0002), "already_aligned")
        .otherwise("refine")
    )
    return alignments.withColumn("verdict", verdict)


def keep_audio(tracks: DataFrame, original: Column, explicit: Column | None = None) -> DataFrame:
    """(file_id, kept): ordinals of the audio tracks to keep, the original language first, then English.

    Of one track it is kept. An English original keeps English and untagged ones; if nothing fits, all stay. explicit: a
    list of ordinals that overrides all this, in its own order, where a file has one.
    """
    english = F.coalesce("lang", F.lit("")).isin("eng", "en", "und", "")
    rank = F.when(~original.isin("eng", "en") & (F.col("lang") == original), 0).when(english, 1)
    said = F.lit(None).cast("array<int>") if explicit is None else explicit
    rows = tracks.withColumns({"_rank": rank, "_said": said}).groupBy("file_id").agg(
        F.max("_said").alias("said"), F.array_sort(F.collect_list(F.when(F.col("_rank").isNotNull(), F.struct("_rank", "ordinal")))).alias("fit"), F.array_sort(F.collect_list("ordinal")).alias("every")
    )
    return rows.select("file_id", F.when(F.size("said") > 0, F.col("said")).when((F.size("every") == 1) | (F.size("fit") == 0), F.col("every")).otherwise(F.transform("fit", lambda x: x["ordinal"])).alias("kept"))


def select_track(wanted: DataFrame, streams: DataFrame) -> DataFrame:
    """(file_id, ordinal, verdict) by a tag, a number or none; a tag that is missing is an abort, never the first track."""
    spec = F.coalesce("sub_track", F.lit("eng"))
    tags = streams.groupBy("file_id", "lang").agg(F.min("ordinal").alias("ordinal"))
    counts = streams.groupBy("file_id").agg(F.count("*").alias("n"))
    rows = wanted.withColumn("spec", spec).join(tags.withColumnRenamed("lang", "spec"), ["file_id", "spec"], "left").join(counts, "file_id", "left")
    number = F.col("spec").rlike(r"^\d+$")
    chosen = F.when(F.col("spec") == "none", F.lit(None)).when(number, F.col("spec").try_cast("int")).otherwise(F.col("ordinal"))
    verdict = F.when(F.col("spec") == "none", "NONE").when(number | F.col("ordinal").isNotNull(), "OK").when(F.coalesce("n", F.lit(0)) == 0, "NONE").otherwise("ABORT")
    return rows.select("file_id", "spec", chosen.cast("int").alias("ordinal"), verdict.alias("verdict"))


def label_audio(kept: DataFrame, tracks: DataFrame, manifest: DataFrame) -> DataFrame:
    """(file_id, place, ordinal, language, title, disposition) of each kept track in its output order.

    kept (file_id, kept), tracks (file_id, ordinal, lang), manifest (file_id, orig_lang, audio_langs, commentary,
    description; the last two arrays of (idx, title)). A language is the manifest's for that place, else the original one
    for the first track of a foreign work, else the source's tag, else eng. Several unnamed commentaries or descriptions
    are numbered; of a track that is both, the description counts.
    """
    rows = kept.select("file_id", F.posexplode("kept").alias("place", "ordinal")).join(tracks.select("file_id", "ordinal", "lang"), ["file_id", "ordinal"], "left").join(manifest, "file_id", "left")
    tag = F.when(F.coalesce("lang", F.lit("")).isin("", "und"), "eng").otherwise(F.col("lang"))
    first = (F.col("place") == 0) & ~F.coalesce("orig_lang", F.lit("eng")).isin("eng", "en", "")
    language = F.coalesce(F.get("audio_langs", F.col("place")), F.when(first, F.col("orig_lang")), tag)

    def named(entries: str, plain: str) -> Column:
        """The title of the last entry for the track; an unnamed one is plain, with its number where there are several."""
        several = F.when(F.size(entries) > 1, F.lit(1))
        title = lambda x, i: F.coalesce(x["title"], F.when(several.isNotNull(), F.concat(F.lit(f"{plain} "), (i + 1).cast("string"))), F.lit(plain))
        numbered = F.transform(entries, lambda x, i: F.struct(x["idx"].alias("idx"), title(x, i).alias("title")))
        return F.try_element_at(F.filter(numbered, lambda x: x["idx"] == F.col("ordinal")), F.lit(-1))["title"]

    rows = rows.withColumns({"_c": F.when(F.size("commentary") > 0, named("commentary", "Audio Commentary")), "_d": F.when(F.size("description") > 0, named("description", "Audio Description"))})
    disposition = F.when(F.col("_d").isNotNull(), "visual_impaired").when(F.col("_c").isNotNull(), "comment")
    return rows.select("file_id", "place", "ordinal", language.alias("language"), F.coalesce("_d", "_c").alias("title"), disposition.alias("disposition"))


def geometry_flags(titles: DataFrame) -> DataFrame:
    """Standard definition, interlaced, a Blu-ray item with a standard source (an abort), and trailers by definition.

    titles (.., name, kind, width, height, field_order); an unknown field order is not interlaced.
    """
    sd = (F.col("width") <= 720) & (F.col("height") <= 576)
    order = F.coalesce("field_order", F.lit(""))
    trailer = F.when(F.col("name").rlike("(?i)(trailer|teaser)"), F.when(sd, "SD trailer").otherwise("HD trailer"))
    return titles.withColumns({"is_sd": sd, "interlaced": ~order.isin("progressive", "unknown", ""), "abort": sd & (F.col("kind") == "BD"), "trailer": trailer})


def layout_violations(listing: DataFrame) -> DataFrame:
    """Folders of films with several editions, and extras of series in folders that only films have."""
    edition = F.regexp_extract("name", r"\{edition-([^}]*)\}", 1)
    many = listing.where("kind = 'movie'").groupBy("dir").agg(F.count_distinct(F.when(edition != "", edition)).alias("n")).where("n > 1").select("dir", F.lit("several editions").alias("reason"))
    wrong = listing.where((F.col("kind") == "tv") & F.col("dir").rlike(r"(?i)/(featurettes|behind the scenes|deleted scenes|interviews|scenes|shorts|trailers|other)$")).select("dir", F.lit("film extras folder").alias("reason")).distinct()
    return many.unionByName(wrong)
