"""Audits of discs, files and the index against each other."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfwright.functions import text as T


def audio_review(tracks: DataFrame) -> DataFrame:
    """Per file its untitled tracks and the tracks that share levels with another one; unknown levels are never equal."""
    level = F.when(F.col("mean_db").isNotNull() & F.col("max_db").isNotNull(), F.concat_ws("/", "mean_db", "max_db"))
    same = F.count("*").over(Window.partitionBy("file_id", "level"))
    rows = tracks.withColumn("level", level).withColumn("same", F.when(F.col("level").isNotNull(), same).otherwise(1))
    out = rows.groupBy("file_id").agg(F.count("*").alias("tracks"), F.count_if(F.coalesce("title", F.lit("")) == "").alias("untitled"), F.count_if(F.col("same") > 1).alias("alike"))
    return out.withColumn("verdict", F.when(F.col("alike") > 0, "DUPLICATE?").when((F.col("untitled") > 0) & (F.col("tracks") > 1), "UNTITLED").otherwise("ok"))


def playlist_runtime(playlists: DataFrame, clips: DataFrame, idents: float = 2.0) -> DataFrame:
    """The running time of a playlist from its clips, short idents apart. playlists (disc, playlist, expected, clips)."""
    each = playlists.select("disc", "playlist", "expected", F.posexplode("clips").alias("pos", "clip")).join(clips, ["disc", "clip"], "left")
    real = F.col("sec") > idents
    out = each.groupBy("disc", "playlist", "expected").agg(F.sum(F.when(real, F.col("sec"))).alias("total"), F.count_if(~real).alias("idents"), F.count_if(F.col("sec").isNull()).alias("unknown"))
    return out.withColumn("excess", F.bround(F.col("total") - F.col("expected"), 3))


def distinct_stream_count(raw: DataFrame) -> DataFrame:
    """Streams of a source that lists some twice: distinct numeric indices."""
    return raw.groupBy("file_id").agg(F.count_distinct(F.when(F.col("index").rlike(r"^\d+$"), F.col("index").try_cast("int"))).alias("streams"))


def title_set_crosscheck(listing: DataFrame, rips: DataFrame) -> DataFrame:
    """Discs with fewer ripped titles than programme sets."""
    sets = listing.groupBy("disc").agg(F.count_distinct("title_set").alias("sets"))
    made = rips.groupBy("disc").agg(F.count_distinct("title").alias("ripped"))
    out = sets.join(made, "disc", "left").na.fill(0, ["ripped"])
    return out.withColumn("verdict", F.when(F.col("ripped") < F.col("sets"), "REVIEW").otherwise("ok"))


def audit_applied_fixes(log: DataFrame) -> DataFrame:
    """Applied fixes by tens of seconds of their offset, and how many of them rest on an anchor at the search bound."""
    railed = (F.abs(F.abs("oa") - 15) < 0.6) | (F.abs(F.abs("ob") - 15) < 0.6) | (F.abs(F.abs("offset") - 60) < 3)
    return log.groupBy(F.floor(F.col("offset") / 10).cast("int").alias("bin")).agg(F.count("*").alias("fixes"), F.count_if(railed).alias("railed"))


def disc_kind(listing: DataFrame) -> DataFrame:
    """What a backup folder holds, by its files; count and bytes."""
    of = lambda e: F.count_if(F.col("ext") == e)
    rows = listing.groupBy("disc").agg(of("m2ts").alias("m2ts"), of("vob").alias("vob"), of("iso").alias("iso"), F.count("*").alias("files"), F.sum("bytes").alias("bytes"))
    kind = F.when(F.col("m2ts") > 0, "Blu-ray").when(F.col("vob") > 0, "DVD").when(F.col("iso") == 1, "ISO").when(F.col("iso") > 1, "several ISOs").otherwise("unusable")
    return rows.select("disc", kind.alias("kind"), "files", "bytes")


def compare_enumerations(a: DataFrame, b: DataFrame, tol: float = 20.0) -> DataFrame:
    """Two tools' titles of a disc by ordinal: UNRELIABLE if they count differently, USE_OTHER if one is short, ok."""
    readable = a.where("sec is not null").groupBy("disc").agg(F.count("*").alias("na")).join(b.groupBy("disc").agg(F.count("*").alias("nb")), "disc", "full_outer").na.fill(0)
    met = a.withColumnRenamed("sec", "sa").join(b.withColumnRenamed("sec", "sb"), ["disc", "n"])
    bad = met.groupBy("disc").agg(F.count_if(F.col("sa").isNull() | (F.col("sb") - F.col("sa") > tol)).alias("short"))
    out = readable.join(bad, "disc", "left").na.fill(0, ["short"])
    return out.withColumn("verdict", F.when(F.col("na") != F.col("nb"), "UNRELIABLE").when(F.col("short") > 0, "USE_OTHER").otherwise("ok"))


def reconcile_durations(claimed: DataFrame, measured: DataFrame, tol: float = 30.0, least: float = 60.0) -> DataFrame:
    """(disc, claimed, measured): each claim, ascending, takes the first measured title left within tol; null: an orphan.

    The matching is one fold over both sorted lists of a disc, which hold some hundred titles, with the place in either as state.
    Lengths that are null or below `least` take no part.
    """
    lists = lambda df, name: df.where(F.col("sec") >= least).groupBy("disc").agg(F.array_sort(F.collect_list(F.col("sec").cast("double"))).alias(name))
    both = lists(claimed, "c").join(lists(measured, "m"), "disc", "left").withColumn("m", F.coalesce("m", F.array().cast("array<double>")))
    start = F.struct(F.lit(0).alias("i"), F.lit(0).alias("j"), F.array().cast("array<struct<claimed:double,measured:double>>").alias("out"))

    def step(at: Column, _: Column) -> Column:
        c, m = F.get("c", at["i"]), F.get("m", at["j"])
        short, hit = F.coalesce(m < c - tol, F.lit(False)), F.coalesce(m <= c + tol, F.lit(False))
        said = F.concat(at["out"], F.array(F.struct(c.alias("claimed"), F.when(hit, m).alias("measured"))))
        # A measured title too short for this claim is so for all after it.
        on = F.struct((at["i"] + F.when(short, 0).otherwise(1)).alias("i"), (at["j"] + F.when(hit, 1).otherwise(0)).alias("j"), F.when(short, at["out"]).otherwise(said).alias("out"))
        return F.when(at["i"] < F.size("c"), on).otherwise(at)

    matched = F.aggregate(F.sequence(F.lit(1), F.size("c") + F.size("m")), start, step, lambda at: at["out"])
    return both.select("disc", F.explode(matched).alias("x")).select("disc", "x.claimed", "x.measured")


def longest_vs_shipped(titles: DataFrame, shipped: DataFrame, n: int = 3) -> DataFrame:
    """The n longest titles of a disc against its longest shipped file, in minutes; within half a minute is ok."""
    top = titles.withColumn("place", F.row_number().over(Window.partitionBy("disc").orderBy(F.desc("sec"), "title"))).where(F.col("place") <= n)
    file = shipped.groupBy("disc").agg(F.max("sec").alias("shipped_sec"))
    delta = F.bround((F.col("sec") - F.col("shipped_sec")) / 60, 1)
    return top.join(file, "disc", "left").select("disc", "title", "place", delta.alias("delta"), F.when(F.col("shipped_sec").isNull(), "NOT SHIPPED").when(F.abs(F.col("sec") - F.col("shipped_sec")) <= 30, "ok").otherwise("DIFFERS").alias("verdict"))


def audit_specials(agent: DataFrame, since=None) -> DataFrame:
    """(show, rk, verdict, minutes) of specials as the agent names them: placeholder, contradicts its file, UNVERIFIED,
    NOTE (not locked), ok.

    agent (show, rk, title, file, locked, duration_ms, updated). since: only shows that were updated from then on.
    """
    if since is not None:
        agent = agent.join(agent.where(F.col("updated") >= since).select("show").distinct(), "show", "left_semi")
    name = T.parse_episode_name(F.col("file"))["title"]
    plain = lambda c: F.regexp_replace(F.lower(c), r"\W", "")
    rows = agent.withColumn("file_title", F.coalesce(name, F.lit("")))
    verdict = (
        F.when(F.col("title").rlike(r"(?i)^Episode\s+\d+$"), "placeholder")
        .when((F.col("file_title") != "") & (plain(F.col("file_title")) != plain(F.col("title"))), "contradicts")
        .when(F.col("file_title") == "", "UNVERIFIED")
        .when(~F.col("locked"), "NOTE")
        .otherwise("ok")
    )
    return rows.select("show", "rk", verdict.alias("verdict"), F.bround(F.col("duration_ms") / 60000, 1).alias("minutes"))


def specials_by_show(audited: DataFrame) -> DataFrame:
    """Of each show its specials, those at fault (placeholder or contradiction), unverified and merely not locked."""
    of = lambda *v: F.count_if(F.col("verdict").isin(*v))
    return audited.groupBy("show").agg(F.count("*").alias("specials"), of("placeholder", "contradicts").alias("faults"), of("UNVERIFIED").alias("unverified"), of("NOTE").alias("notes"))


def unindexed_extras(shipped: DataFrame, indexed: DataFrame) -> DataFrame:
    """Extras on disk that the index lacks, for works where it counts fewer; by base name in any case, local entries only."""
    base = F.regexp_replace(T.leaf(F.col("path")), r"\.[^.]+$", "")
    a, b = shipped.withColumn("base", base), indexed.where("local").withColumn("base", base)
    short = a.groupBy("work").agg(F.count("*").alias("n")).join(b.groupBy("work").agg(F.count("*").alias("m")), "work", "left").na.fill(0, ["m"]).where("m < n")
    seen = b.select("work", F.lower("base").alias("_seen"))
    met = a.join(short.select("work"), "work", "left_semi").withColumn("_seen", F.lower("base"))
    return met.join(seen, ["work", "_seen"], "left_anti").select("work", "base")


def match_by_basename(agent: DataFrame, listing: DataFrame) -> DataFrame:
    """The agent's rows with local files of the same leaf name."""
    return agent.withColumn("leaf", T.leaf(F.col("file"))).join(listing.select(T.leaf(F.col("rel")).alias("leaf"), "rel"), "leaf")


def verify_stream_copy(src: DataFrame, out: DataFrame, tol: float = 1.0) -> DataFrame:
    """Source and copy by running time and streams of each type. Rows (file_id, sec, type)."""
    def shape(df: DataFrame, p: str) -> DataFrame:
        return df.groupBy("file_id").agg(F.max("sec").alias(f"{p}_sec"), *(F.count_if(F.col("type") == t).alias(f"{p}_{t}") for t in ("video", "audio", "subtitle")))

    met = shape(src, "s").join(shape(out, "o"), "file_id", "left")
    same = (F.abs(F.col("s_sec") - F.col("o_sec")) <= tol) & (F.col("s_video") == F.col("o_video")) & (F.col("s_audio") == F.col("o_audio")) & (F.col("s_subtitle") == F.col("o_subtitle"))
    return met.select("file_id", F.when(F.col("o_sec").isNull(), "MISSING").when(same, "ok").otherwise("DIFFERS").alias("verdict"))


def staged_without_manifest(staged: DataFrame, manifests: DataFrame, root: str) -> DataFrame:
    """Staged folders that no manifest reads. A manifest's folder is the one below the staging root, however deep its source
    lies in it (a Blu-ray's stream file), or the source itself (a whole disc); both are compared in any case."""
    plain = lambda c: F.lower(F.replace(c, F.lit("\\"), F.lit("/")))
    top = F.lower(F.lit(root.replace("\\", "/").rstrip("/") + "/"))
    src = plain(F.col("src"))
    read = manifests.where(F.startswith(src, top)).select(F.substring_index(F.substr(src, F.length(top) + 1), "/", 1).alias("_folder"))
    return staged.select("folder").distinct().join(read, plain(F.col("folder")) == F.col("_folder"), "left_anti")


def track_identity(tracks: DataFrame, transcripts: DataFrame) -> DataFrame:
    """What each audio track is by what is said on it, and whether another track of the file says the same."""
    met = tracks.join(transcripts, ["file_id", "track"], "left").withColumn("said", F.trim(T.norm_ascii(F.col("text"))))
    same = F.count(F.when(F.col("text").isNotNull(), 1)).over(Window.partitionBy("file_id", "said"))
    hint = T.commentary_hints(F.col("text"), F.col("heard"))["verdict"]
    return met.withColumn("same", same).select("file_id", "track", F.when(F.col("text").isNull(), "UNHEARD").when(F.col("same") > 1, "SAME LINES").otherwise(hint).alias("verdict"))


def survey_subtitles(files: DataFrame, streams: DataFrame, image_codecs: list[str], text_codecs: list[str]) -> DataFrame:
    """The largest root file of a film and the first episode of a season, with whether its images need reading."""
    video = files.where(F.lower("ext").isin("mkv", "mp4", "m4v", "avi"))
    film = Window.partitionBy("kind", "work").orderBy(F.desc("bytes"), "rel")
    season = Window.partitionBy("kind", "work", "grp").orderBy("rel")
    main = video.withColumn("place", F.when(F.col("kind") == "tv", F.row_number().over(season)).otherwise(F.row_number().over(film))).where("place = 1")
    counts = streams.groupBy("rel").agg(F.count_if(F.col("codec").isin(image_codecs)).alias("bitmap_subs"), F.count_if(F.col("codec").isin(text_codecs)).alias("text_subs"))
    rows = main.join(counts, "rel", "left").na.fill(0, ["bitmap_subs", "text_subs"])
    need = F.when((F.col("bitmap_subs") > 0) & (F.col("text_subs") == 0), "YES").when(F.col("bitmap_subs") > F.col("text_subs"), "partial").otherwise("no")
    return rows.select("rel", "bitmap_subs", "text_subs", need.alias("needs_ocr"))


# Codecs of image subtitles.
IMAGE_CODECS = ["dvd_subtitle", "hdmv_pgs_subtitle"]


def bitmap_populated(media: DataFrame, streams: DataFrame, read: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """P5: (rel, cache_key, verdict) of files with image subtitles: populated, empty (no packets), or exhausted (read before
    with nothing found).

    media (rel, bytes, modified), streams (rel, codec, packets), read (rel, cues). The key holds path, size and time of
    writing: a verdict of `known` (cache_key, verdict) stands for as long as the file is not written anew.
    """
    key = F.md5(F.concat_ws("|", "rel", F.col("bytes").cast("string"), F.unix_micros(F.col("modified").cast("timestamp")).cast("string")))
    found = streams.where(F.col("codec").isin(IMAGE_CODECS)).groupBy("rel").agg(F.sum("packets").alias("packets"))
    done = read.where("cues = 0").select("rel", F.lit(True).alias("tried")).distinct()
    rows = media.withColumn("cache_key", key).join(found, "rel").join(done, "rel", "left")
    verdict = F.when(F.coalesce("packets", F.lit(0)) == 0, "empty").when(F.col("tried"), "exhausted").otherwise("populated")
    if known is not None:
        rows = rows.join(known.select("cache_key", F.col("verdict").alias("known")), "cache_key", "left")
        verdict = F.coalesce("known", verdict)
    return rows.select("rel", "cache_key", verdict.alias("verdict"))


def metadata_mismatch(items: DataFrame, minutes: float = 10.0, sim: float = 0.5) -> DataFrame:
    """Items whose year, running time or folder disagrees with what they were matched to."""
    year = F.col("year") != F.year("aired")
    far = F.abs(F.col("sec") - F.col("matched_sec")) > minutes * 60
    unlike = T.title_sim(F.col("title"), F.col("folder")) < sim
    yes = lambda c: F.coalesce(c, F.lit(False))
    return items.withColumns({"bad_year": yes(year), "bad_runtime": yes(far), "bad_folder": yes(unlike)}).where("bad_year or bad_runtime or bad_folder")


def double_slot_files(files: DataFrame, agent: DataFrame, tol: float = 180.0) -> DataFrame:
    """Files that last as long as two consecutive slots and not as one. files (show, season, idx, sec)."""
    two = agent.withColumn("next_sec", F.lead("sec").over(Window.partitionBy("show", "season").orderBy("idx"))).withColumnRenamed("sec", "slot_sec")
    met = files.join(two, ["show", "season", "idx"])
    return met.where((F.abs(F.col("sec") - F.col("slot_sec") - F.col("next_sec")) <= tol) & (F.abs(F.col("sec") - F.col("slot_sec")) > tol)).select("show", "season", "idx", F.format_string("E%02d-E%02d", "idx", F.col("idx") + 1).alias("form"))


def union_after_merge(old: DataFrame, new: DataFrame, after: DataFrame) -> DataFrame:
    """Names that a merge without overwriting lost or made up: the difference of after and the union of old and new."""
    seen = lambda df, want: df.select("rel", F.lit(want).alias("want"), F.lit(not want).alias("there"))
    each = seen(old, True).unionByName(seen(new, True)).unionByName(seen(after, False)).groupBy("rel").agg(F.max("want").alias("want"), F.max("there").alias("there"))
    none = F.col("rel").isNull()  # equals no other name
    lost, unexpected = F.when(F.col("want") & (~F.col("there") | none), "LOST"), F.when(F.col("there") & (~F.col("want") | none), "UNEXPECTED")
    return each.select("rel", F.explode(F.array_compact(F.array(lost, unexpected))).alias("verdict"))


def hit_share(hits: Column, total: Column) -> Column:
    return F.when(total > 0, F.bround(hits / total, 4))


def audit_kept(kept: DataFrame, items: DataFrame) -> DataFrame:
    """Kept subtitles scored again on show and episode title; per show how many fit neither."""
    met = kept.join(items, "rk").withColumn("sim", F.greatest(T.title_sim(F.col("show"), F.col("title")), T.title_sim(F.col("ep_title"), F.col("title"))))
    out = met.groupBy("show").agg(F.count("*").alias("kept"), F.count_if(F.col("sim") < 0.3).alias("wrong"))
    return out.withColumn("wrong_rate", hit_share(F.col("wrong"), F.col("kept")))
