"""Joins that reconcile what there is with what was decided, shipped or indexed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfwright.functions import text as T
from shelfwright.operators.common import PER_PART, key_sizes, with_nearest, with_previous
from shelfwright.session import stored


def unaccounted_titles(titles: DataFrame, dispositions: DataFrame) -> DataFrame:
    """Catalogued titles that nobody decided on."""
    return titles.join(dispositions, ["disc", "title"], "left_anti")


def staged_complete(staged: DataFrame, source: DataFrame, done: DataFrame) -> DataFrame:
    """Per folder COMPLETE if files and bytes equal the source's, SHORT if not; without a source DONE or UNKNOWN; NOT STAGED if only
    the source has it, with no files and no bytes staged."""
    total = lambda df, p: df.groupBy("folder").agg(F.count("*").alias(f"{p}_files"), F.sum("bytes").alias(f"{p}_bytes"))
    both = total(staged, "s").join(total(source, "t"), "folder", "full_outer").join(done.select("folder", F.lit(True).alias("done")).distinct(), "folder", "left")
    same = (F.col("s_files") == F.col("t_files")) & (F.col("s_bytes") == F.col("t_bytes"))
    gone = F.when(F.col("done"), "DONE").otherwise("UNKNOWN")
    verdict = F.when(F.col("s_files").isNull(), "NOT STAGED").when(F.col("t_files").isNull(), gone).when(same, "COMPLETE").otherwise("SHORT")
    return both.withColumn("verdict", verdict).na.fill(0, ["s_files", "s_bytes"])


def verify_copies(src: DataFrame, dst: DataFrame, scratch: str = "_titlecards") -> DataFrame:
    """Every source file: OK, SIZE or MISSING on the target. Files in a folder named `scratch`, in any case, are not asked for."""
    there = dst.select("rel", F.col("bytes").alias("dst_bytes"))
    inside = F.array_contains(F.split(F.lower(F.regexp_replace("rel", r"[/\\]?[^/\\]*$", "")), r"[/\\]"), scratch.lower())
    out = src.where(~inside).join(there, "rel", "left")
    return out.withColumn("verdict", F.when(F.col("dst_bytes").isNull(), "MISSING").when(F.col("dst_bytes") != F.col("bytes"), "SIZE").otherwise("OK"))


def copy_plan(src: DataFrame, dst: DataFrame, overwrite: bool = False) -> DataFrame:
    """K5: files still to copy: those that the target lacks, with overwrite those of another size, too."""
    if not overwrite:
        return src.join(dst, "rel", "left_anti")
    return verify_copies(src, dst).where("verdict <> 'OK'").drop("dst_bytes", "verdict")


def match_by_runtime(files: DataFrame, canon: DataFrame, per_part: int = PER_PART) -> DataFrame:
    """The canonical episode of the file's season nearest in minutes, the distance, and the gap to the runner-up, with a verdict.

    files (file_id, show, season, file_mins), canon (show, season, idx, mins). Of equally near episodes the one with the
    least idx counts. Episodes and files of a season are put in one order of minutes, where a file's nearest ones stand
    next to it: no pairs of a season are made, and a season of more than per_part rows is put in order in parts.
    """
    key = ["show", "season"]
    if key_sizes(canon.select(*key).unionByName(files.select(*key)), key)[1] <= per_part:
        per_part = None
    each = canon.where("mins is not null").groupBy(*key, "mins").agg(F.min("idx").alias("idx"), F.count("*").alias("n"))
    each = each.withColumns({"e": F.struct("mins", "idx", "n"), "back": -F.col("mins")})
    each = with_previous(with_previous(each, key, ["mins"], "e", "e_before", per_part), key, ["back"], "e", "e_after", per_part)
    each = each.withColumn("near", F.array("e", "e_before", "e_after"))
    none = F.lit(None)
    rows = each.select(*key, "mins", none.cast(files.schema["file_id"].dataType).alias("file_id"), "near").unionByName(
        files.where("file_mins is not null").select(*key, F.col("file_mins").alias("mins"), "file_id", none.cast(each.schema["near"].dataType).alias("near"))
    )
    rows = rows.withColumn("is_file", F.col("file_id").isNotNull())
    met = with_nearest(rows, key, ["mins", "is_file", "file_id"], "near", "lower", "upper", per_part).where("is_file")
    no_near = F.array().cast(each.schema["near"].dataType)
    around = F.concat(F.coalesce("lower", no_near), F.coalesce("upper", no_near))
    met = met.withColumn("around", F.array_distinct(F.filter(around, lambda x: x.isNotNull())))
    best = F.array_sort(F.transform("around", lambda x: F.struct(F.abs(F.col("mins") - x["mins"]).alias("d"), x["idx"].alias("idx"), x["n"].alias("n"))))
    two = met.withColumn("b", best).select("file_id", F.get("b", 0)["idx"].alias("idx"), F.get("b", 0)["d"].alias("d1"), F.when(F.get("b", 0)["n"] > 1, F.get("b", 0)["d"]).otherwise(F.get("b", 1)["d"]).alias("d2"))
    delta = F.bround("d1", 1)
    gap = F.when(F.col("d2").isNull(), 99.0).otherwise(F.bround(F.col("d2") - delta, 1))
    out = files.select("file_id", "file_mins").join(two, "file_id", "left").withColumns({"delta": delta, "gap": F.when(F.col("idx").isNotNull(), gap)})
    verdict = F.when(F.col("file_mins").isNull(), "NO DURATION").when(F.col("idx").isNull() | (F.col("delta") > 3), "NO CLOSE MATCH").when(F.col("gap") < 1, "AMBIGUOUS").otherwise("ok")
    return out.select("file_id", "idx", "delta", "gap", verdict.alias("verdict"))


def raw_stream_duplicates(titles: DataFrame) -> DataFrame:
    """Raw streams whose running time equals that of a playlist on their disc; others are no duplicates."""
    lists = titles.where("is_playlist").select("disc", F.bround("sec", 0).alias("s"))
    raw = titles.where("not is_playlist").withColumn("s", F.bround("sec", 0))
    return raw.join(lists, ["disc", "s"], "left_semi").select("disc", "title", "sec")


def guard_candidates(items: DataFrame, candidates: DataFrame, blocklist: DataFrame) -> DataFrame:
    """Candidates that may belong to their item, with the similarity that decided.

    Only srt; no commentary, karaoke or lyrics; nothing blocked, by key or label, in any case; no other SxxEyy than the item's. The better of the
    similarities to show and episode title must reach 0.6, or 0.3 with the exact SxxEyy; none known passes.
    The block list is a curated table of some rows, so Spark may send it to all tasks if it is small.
    """
    named = candidates.where((F.col("format") == "srt") & ~F.col("title").rlike("(?i)commentary|karaoke|lyrics"))
    # What similarity needs is worked out once: of an item before it meets its candidates, of a candidate after the cheap tests.
    asked = items.where("duration >= 60").withColumns({"_show": T.sig_words(F.col("show")), "_ep": F.when(T.usable_title(F.col("ep_title")), T.sig_words(F.col("ep_title")))})
    met = named.join(asked, "rk")
    label = "label" if "label" in items.columns else "show"
    has = F.contains(F.lower(met["title"]), F.lower(blocklist["pattern"]))
    blocked = met.join(blocklist, (blocklist["key"] == met["rk"].cast("string")) & has, "left_anti").join(blocklist, (blocklist["key"] == met[label]) & has, "left_anti")
    se = T.se_tokens(F.col("title"))
    exact = F.exists("_se", lambda x: (x["season"] == F.col("season")) & (x["ep"] == F.col("ep")))
    rows = blocked.withColumn("_se", se).withColumn("_exact", exact).where((F.size("_se") == 0) | F.col("_exact"))
    of_title = F.array(F.struct(F.regexp_replace(T.norm_ascii(F.col("title")), " ", "").alias("flat"), T.has_content(F.col("title")).alias("content")))
    best = F.transform(of_title, lambda x: F.greatest(T.sim_of(F.col("_show"), x["flat"], x["content"]), F.when(F.col("_ep").isNotNull(), T.sim_of(F.col("_ep"), x["flat"], x["content"]))))[0]
    floor = F.when(F.col("_exact"), 0.3).otherwise(0.6)
    return rows.withColumn("sim", best).where(F.coalesce("sim", F.lit(1.0)) >= floor).drop("_se", "_exact", "_show", "_ep")


def verify_episode_slots(agent: DataFrame, files: DataFrame) -> DataFrame:
    """Each slot of the agent against the name of its file: NOFILE, OK(combined), OK, OK(normalised), NOTITLE, MISMATCH.

    slot_ok says apart whether the slot's number is among the file's.
    """
    met = agent.join(files, "rk", "left").withColumn("p", T.parse_episode_name(F.col("file")))
    inside = F.col("idx").between(F.col("p.ep_from"), F.col("p.ep_to"))
    verdict = (
        F.when(F.col("file").isNull(), "NOFILE")
        .when(inside & (F.col("p.ep_to") > F.col("p.ep_from")), "OK(combined)")
        .when(F.lower("p.title") == F.lower("title"), "OK")
        .when((F.col("p.title") != "") & T.same_episode(F.col("p.title"), F.col("title")), "OK(normalised)")
        .when(F.coalesce("p.title", F.lit("")) == "", "NOTITLE")
        .otherwise("MISMATCH")
    )
    return met.select(*agent.columns, "file", verdict.alias("verdict"), F.coalesce(inside, F.lit(False)).alias("slot_ok"))


def merge_ocr(timings: DataFrame, texts: DataFrame) -> DataFrame:
    """Cues with their texts, blank ones dropped, renumbered from 1."""
    met = timings.join(texts, ["file_id", "cue"]).where(F.trim("text") != "")
    return met.withColumn("n", F.row_number().over(Window.partitionBy("file_id").orderBy("cue")))


def compare_orderings(seasons: DataFrame, a: str, b: str) -> DataFrame:
    """Places where two orderings of a show disagree; a title that only one has counts."""
    side = lambda o, t: seasons.where(F.col("ordering") == o).select("show", "season", "idx", F.col("title").alias(t))
    return side(a, "title_a").join(side(b, "title_b"), ["show", "season", "idx"], "full_outer").where(~F.col("title_a").eqNullSafe(F.col("title_b")))


def todo(work: DataFrame, state: DataFrame, keys: list | None = None, limit: int | None = None, size: str = "bytes") -> DataFrame:
    """Work not yet decided, smallest first; named keys are taken whatever was decided."""
    named = None if keys is None else work.sparkSession.createDataFrame([(k,) for k in keys], f"rk {work.schema['rk'].dataType.simpleString()}")
    open_work = work.join(state, "rk", "left_anti") if named is None else work.join(named, "rk", "left_semi")
    ordered = open_work.orderBy(size, "rk")
    return ordered if limit is None else ordered.limit(limit)


#: Pairs of a file's cues and landmarks from which it is no longer compared line by line.
PER_FILE = 1 << 22


def _off() -> Column:
    return F.col("start_s") - F.col("t")


def _by_word(cues: DataFrame, marks: DataFrame) -> DataFrame:
    """(file_id, landmark, error) of landmarks that have a whole word (`words`): their lines meet the cues that hold the word of theirs
    which fewest cues of the file hold. Words move as hashes and without texts; a line that many landmarks share meets each cue once."""
    hashes = lambda c: F.array_distinct(F.transform(c, lambda w: F.xxhash64(w)))
    lines = marks.select("file_id", "line", hashes("words").alias("words")).dropDuplicates(["file_id", "line"])
    asked = lines.select("file_id", "line", F.explode("words").alias("word"))
    each = cues.select("file_id", "start_s", F.explode(hashes(F.split("text", r"\s+"))).alias("word"))
    held = each.join(asked.select("file_id", "word").distinct(), ["file_id", "word"], "left_semi")
    counts = held.groupBy("file_id", "word").agg(F.count("*").alias("n"))
    # A word that no cue holds settles it: the line is in none.
    rarest = asked.join(counts, ["file_id", "word"], "left").groupBy("file_id", "line").agg(F.min_by(F.struct("word", "n"), F.struct(F.coalesce("n", F.lit(0)), "word")).alias("w"))
    near = rarest.where("w.n is not null").select("file_id", "line", F.col("w.word").alias("word")).join(held, ["file_id", "word"]).select("file_id", "line", "start_s").distinct()
    met = near.join(cues, ["file_id", "start_s"]).where(F.contains("text", "line")).select("file_id", "line", F.col("start_s").alias("at"), F.col("start_s").alias("hit")).distinct()
    rows = met.withColumns({"is_mark": F.lit(False), "landmark": F.lit(None).cast(marks.schema["landmark"].dataType)})
    rows = stored(rows.unionByName(marks.select("file_id", "line", F.col("t").alias("at"), F.lit(None).cast("double").alias("hit"), F.lit(True).alias("is_mark"), "landmark")), "lines")
    both = with_nearest(rows, ["file_id", "line"], ["at", "is_mark", "landmark"], "hit", "lower", "upper").where("is_mark")
    low, high = F.col("lower") - F.col("at"), F.col("upper") - F.col("at")
    error = F.when(low.isNull() | (F.abs(high) < F.abs(low)), high).otherwise(low)
    return both.select("file_id", "landmark", error.alias("error")).where("error is not null")


def _by_file(cues: DataFrame, marks: DataFrame) -> DataFrame:
    """(file_id, landmark, error) of landmarks in files of few pairs: texts and lines move once, each line is looked up in its file's cues."""
    met = cues.join(marks.select("file_id", "landmark", "t", "line"), "file_id").where(F.contains("text", "line"))
    return met.groupBy("file_id", "landmark").agg(F.min_by(_off(), F.struct(F.abs(_off()), F.col("start_s"))).alias("error"))


def _by_rings(cues: DataFrame, marks: DataFrame, first_s: float) -> list[DataFrame]:
    """(file_id, landmark, error) of landmarks without a whole word, ring by ring: a landmark meets the cues of its own stretch of time and
    the two beside it; what is found within one stretch's length is nearest, all others go on with stretches four times as long."""
    found, left, width = [], stored(marks.select("file_id", "landmark", "t", "line"), "marks"), first_s
    low, high = cues.agg(F.min("start_s"), F.max("start_s")).first()
    while low is not None and not left.isEmpty():
        span = left.agg(F.greatest(F.max("t") - F.lit(low), F.lit(high) - F.min("t"))).first()[0]
        at = lambda c: F.floor(F.col(c) / width).alias("at")
        near = left.select("*", F.explode(F.array(*(at("t") + k for k in (-1, 0, 1)))).alias("at"))
        met = near.join(cues.select("file_id", "start_s", "text", at("start_s")), ["file_id", "at"]).where(F.contains("text", "line"))
        best = met.where(F.abs(_off()) <= width).groupBy("file_id", "landmark").agg(F.min_by(_off(), F.struct(F.abs(_off()), F.col("start_s"))).alias("error"))
        found.append(stored(best, "ring"))
        if width >= span:
            break
        left, width = stored(left.join(found[-1], ["file_id", "landmark"], "left_anti"), "marks"), width * 4
    return found


def nearest_cue(cues: DataFrame, landmarks: DataFrame, first_s: float = 60.0, per_file: int = PER_FILE) -> DataFrame:
    """(file_id, landmark, error): for each landmark the nearest cue, however far, that carries its line in any case, the earlier of
    two as near; null without one, and where t or line is null.

    Files of at most per_file pairs of a cue and a landmark are compared line by line. In others no product is made: a line of
    three words or more meets cues by its rarest inner word, which must stand whole in a cue that carries it; shorter ones go
    outwards in time (first_s seconds first).
    """
    low = cues.select("file_id", F.col("start_s").cast("double").alias("start_s"), F.lower("text").alias("text")).where("start_s is not null and text is not null")
    words = F.split(F.lower("line"), r"\s+")
    marks = landmarks.where("t is not null and line is not null").select("file_id", "landmark", F.col("t").cast("double").alias("t"), F.lower("line").alias("line"), F.array_distinct(F.slice(words, 2, F.greatest(F.lit(0), F.size(words) - 2))).alias("words"))
    marks = marks.withColumn("words", F.filter("words", lambda w: w != ""))
    pairs = low.groupBy("file_id").agg(F.count("*").alias("c")).join(marks.groupBy("file_id").agg(F.count("*").alias("m")), "file_id")
    large = stored(pairs.where(F.col("c") * F.col("m") > per_file).select("file_id"), "large")
    if large.isEmpty():
        found = [_by_file(low, marks)]
    else:
        found = [_by_file(low.join(large, "file_id", "left_anti"), marks.join(large, "file_id", "left_anti"))]
        low, marks = (stored(df.join(large, "file_id", "left_semi"), "large") for df in (low, marks))
        found.append(_by_word(low, marks.where(F.size("words") > 0)))
        found += _by_rings(low, marks.where(F.size("words") == 0), first_s)
    each = landmarks.select("file_id", "landmark", F.lit(None).cast("double").alias("error"))
    for part in found:
        each = each.unionByName(part)
    return each.groupBy("file_id", "landmark").agg(F.min_by("error", F.when(F.col("error").isNotNull(), F.struct(F.abs("error"), "error"))).alias("error"))


def landmark_verdict(errors: DataFrame) -> DataFrame:
    """Two or more errors of a file: correct, pure shift or different cut."""
    spans = errors.groupBy("file_id").agg(F.count("error").alias("n"), F.min("error").alias("lo"), F.max("error").alias("hi"))
    verdict = F.when(F.col("n") < 2, "too few").when((F.abs("lo") <= 1) & (F.abs("hi") <= 1), "correct").when(F.col("hi") - F.col("lo") <= 1, "pure shift").otherwise("different cut")
    return spans.withColumn("verdict", verdict)


def verify_rips(requested: DataFrame, produced: DataFrame) -> DataFrame:
    """Asked titles against files: NO FILE, CHECK (over 3 s off), SIZE, ok.

    SIZE: the file is over a tenth (what containers add) off the size that the enumeration gave, a text such as "4.7 GB" in
    size_text: the numbering of titles has moved between the two. Where either side has no size, none is compared.
    """
    has_sizes = "size_text" in requested.columns and "bytes" in produced.columns
    files = produced.select("disc", "title", F.col("sec").alias("got"), *(["bytes"] if has_sizes else []))
    met = requested.join(files, ["disc", "title"], "left")
    want = T.size_to_gb(F.col("size_text")) * (1 << 30) if has_sizes else F.lit(None)
    off = F.coalesce(F.abs(F.col("bytes") - want) > want * 0.1, F.lit(False)) if has_sizes else F.lit(False)
    return met.withColumn("verdict", F.when(F.col("got").isNull(), "NO FILE").when(F.abs(F.col("got") - F.col("sec")) > 3, "CHECK").when(off, "SIZE").otherwise("ok"))


def duplicate_prompts(titles: DataFrame) -> DataFrame:
    """Titles of a disc with equal running time, as one REVIEW prompt a group: the first title and how many share it.

    Equal durations are a prompt to look, never proof. Groups are reported whole instead of all their pairs.
    """
    return titles.groupBy("disc", "sec").agg(F.min("title").alias("first_title"), F.count("*").alias("titles")).where("titles > 1").withColumn("verdict", F.lit("REVIEW"))


def truncated_streams(manifest: DataFrame, titles: DataFrame, playlists: DataFrame) -> DataFrame:
    """Raw streams shorter by over 20 s than a playlist of their disc that contains them.

    manifest (disc, stem, sec), titles (disc, playlist, sec), playlists (disc, playlist, clips). A playlist that is longer and can't be
    read, with null clips or without a row, proves nothing either way and is reported, too; a null playlist is none. Clips
    are exploded, so the containment is an equality join. Where the manifest has a column allow_raw_stream, its rows
    that are true are let through; with a column manifest besides, so are all rows of the manifest that holds one.
    """
    if "allow_raw_stream" in manifest.columns:
        if "manifest" in manifest.columns:
            manifest = manifest.join(manifest.where("allow_raw_stream").select("manifest").distinct(), "manifest", "left_anti")
        else:
            manifest = manifest.where(~F.coalesce("allow_raw_stream", F.lit(False)))
    asked = manifest.select("disc", "stem", "sec")
    lists = titles.where("playlist is not null").select("disc", "playlist", F.col("sec").alias("list_sec"))
    known = playlists.where("clips is not null")
    clips = known.select("disc", "playlist", F.explode(F.array_distinct("clips")).alias("stem"))
    sure = asked.join(clips, ["disc", "stem"]).join(lists, ["disc", "playlist"]).where("list_sec > sec + 20").select("disc", "stem", "playlist", "list_sec", F.lit("TRUNCATED").alias("verdict"))
    blind = lists.join(known, ["disc", "playlist"], "left_anti")
    met = asked.join(blind, "disc").where("list_sec > sec + 20")
    return sure.unionByName(met.select("disc", "stem", "playlist", "list_sec", F.lit("UNREADABLE").alias("verdict")))


def orphan_sidecars(spans: DataFrame, media: DataFrame, tolerance: float = 120.0) -> DataFrame:
    """Subtitles without media, or ending far from where the media ends."""
    met = spans.join(media, "file_id", "left")
    far = F.abs(F.col("dur") - F.col("last_end")) > tolerance
    return met.withColumn("verdict", F.when(F.col("dur").isNull(), "NO MEDIA").when(far, "FAR FROM END").otherwise("ok"))


def incomplete_title_sets(declared: DataFrame, present: DataFrame) -> DataFrame:
    """Discs that declare more title sets than there are."""
    have = present.groupBy("disc").agg(F.count_distinct("title_set").alias("present"))
    return declared.join(have, "disc", "left").withColumn("present", F.coalesce("present", F.lit(0).cast("long"))).where("declared > present")


def title_sets_without_backup(listing: DataFrame) -> DataFrame:
    """(disc, title_set) whose index file has no backup file beside it: the mark of a copy that stopped. listing (disc, name)."""
    number = lambda ending: F.regexp_extract("name", rf"(?i)^VTS_(\d+)_0\.{ending}$", 1)
    of = lambda ending: listing.select("disc", number(ending).alias("title_set")).where("title_set <> ''").distinct()
    return of("IFO").join(of("BUP"), ["disc", "title_set"], "left_anti")


def playall_containment(titles: DataFrame, members: DataFrame, hashes: DataFrame) -> DataFrame:
    """Whether a reel holds the parts that are also there one by one, as a row for each reel with its parts' sum.

    titles (disc, title, sec), members (disc, reel, title), hashes (disc, title, offset_s, h) of windows of sound or
    text. A part is inside if one of its windows is one of the reel's; hits in the reel's last third count as late, since
    its head always fits. CONTAINED: every part is inside and one is late; PARTLY; APART. excess: seconds of the reel
    beyond its parts. A verdict is a prompt to look, nothing is dropped.
    """
    sec = titles.select("disc", "title", "sec")
    reels = members.select("disc", "reel").distinct().join(sec.withColumnsRenamed({"title": "reel", "sec": "reel_sec"}), ["disc", "reel"])
    windows = hashes.select("disc", F.col("title").alias("reel"), F.col("offset_s").alias("at"), "h").join(reels, ["disc", "reel"])
    own = members.join(hashes.select("disc", "title", "h").distinct(), ["disc", "title"])
    hits = own.join(windows, ["disc", "reel", "h"]).groupBy("disc", "reel", "title").agg(F.bool_or(F.col("at") * 3 >= F.col("reel_sec") * 2).alias("late"))
    parts = members.join(sec, ["disc", "title"]).join(hits, ["disc", "reel", "title"], "left")
    sums = parts.groupBy("disc", "reel").agg(F.count("*").alias("parts"), F.count("late").alias("inside"), F.count_if(F.coalesce("late", F.lit(False))).alias("late"), F.sum("sec").alias("parts_sec"))
    verdict = F.when((F.col("inside") == F.col("parts")) & (F.col("late") > 0), "CONTAINED").when(F.col("inside") > 0, "PARTLY").otherwise("APART")
    return reels.join(sums, ["disc", "reel"]).select("disc", "reel", "parts", "inside", "late", F.bround(F.col("reel_sec") - F.col("parts_sec"), 3).alias("excess"), verdict.alias("verdict"))


def awaiting_sidecar(media: DataFrame, sidecars: DataFrame) -> DataFrame:
    """Files with populated image subtitles and no text file beside them; without a duration one is still encoding."""
    need = media.where("populated").join(sidecars.select("base").distinct(), "base", "left_anti")
    return need.withColumn("verdict", F.when(F.col("dur").isNull(), "ENCODING").otherwise("AWAITING"))


def missing_names(shipped: DataFrame, indexed: DataFrame) -> DataFrame:
    """O3: shipped except indexed, with multiplicity."""
    return shipped.exceptAll(indexed)


