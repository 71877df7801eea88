"""Chains of operators that users call as one job."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfwright.functions import text as T
from shelfwright.operators import aggregates as A, audits as U, predicates as P, ranking as W, reconcile as J
from shelfwright.session import stored
from shelfwright.sources import readers as S
from shelfwright.sources.state import StateTable
from shelfwright.sources.writers import write_catalogue, write_manifest, write_run, write_srt


def subtitle_search(items: DataFrame, streams: DataFrame, decided: DataFrame, candidates: DataFrame, blocklist: DataFrame, spans: DataFrame) -> DataFrame:
    """(rk, cand_id, place, band, verdict) for each item that lacks subtitles and is not decided.

    Candidates pass the guards, the best six of an item are looked at in order, and the first whose cues cover the
    running time is kept. spans (cand_id, last_end, cues) are those of the candidates' texts.
    """
    wanted = P.needs_subtitles(items, streams).join(decided, "rk", "left_anti")
    ranked = W.rank_candidates(J.guard_candidates(wanted, candidates, blocklist))
    met = ranked.join(spans, "cand_id", "left").withColumn("band", P.cover_band(F.col("last_end"), F.col("duration"), F.coalesce("cues", F.lit(0))))
    first = met.where("band is not null").groupBy("rk").agg(F.min_by(F.struct("cand_id", "place", "band"), "place").alias("x"))
    tried = met.groupBy("rk").agg(F.count("*").alias("tried"))
    out = wanted.select("rk").join(tried, "rk", "left").join(first, "rk", "left")
    verdict = F.when(F.col("x").isNotNull(), "kept").when(F.col("tried") > 0, "none fits").otherwise("no candidate")
    return out.select("rk", "x.cand_id", "x.place", "x.band", verdict.alias("verdict"))


STATE = "rk {key}, r string, label string, tried array<struct<t:string,score:bigint,sim:double,cover:double,cues:bigint,kind:string>>, kept string, cover double, cues bigint, kind string, ts timestamp"


def search_verdicts(wanted: DataFrame, candidates: DataFrame, blocklist: DataFrame, spans: DataFrame, now: dt.datetime) -> DataFrame:
    """C1's rows for the state: one for each wanted item, with what was tried up to the candidate that fits.

    r is skip_no_duration (under 60 s), no_candidates (none passes the guards), matched or no_match.
    """
    ranked = W.rank_candidates(J.guard_candidates(wanted, candidates, blocklist))
    met = ranked.join(spans, "cand_id", "left")
    n = F.coalesce("cues", F.lit(0)).cast("long")
    cover = F.bround(F.when(n > 0, F.col("last_end") / F.col("duration")).otherwise(0.0), 3)
    one = F.struct("place", F.struct(F.col("title").alias("t"), F.col("score").cast("long").alias("score"), F.col("sim").cast("double").alias("sim"), cover.alias("cover"), n.alias("cues"), P.cover_band(F.col("last_end"), F.col("duration"), n).alias("kind")).alias("x"))
    lists = met.groupBy("rk").agg(F.array_sort(F.collect_list(one)).alias("all"), F.min(F.when(one["x"]["kind"].isNotNull(), F.col("place"))).alias("fit"))
    tried = F.transform(F.filter("all", lambda x: F.col("fit").isNull() | (x["place"] <= F.col("fit"))), lambda x: x["x"])
    out = wanted.select("rk", F.col("show").alias("label"), "duration").join(lists, "rk", "left").withColumn("tried", tried)
    r = F.when(F.coalesce("duration", F.lit(0.0)) < 60, "skip_no_duration").when(F.col("all").isNull(), "no_candidates").when(F.col("fit").isNotNull(), "matched").otherwise("no_match")
    kept = F.when(F.col("fit").isNotNull(), F.element_at("tried", -1))
    return out.select("rk", r.alias("r"), "label", "tried", kept["t"].alias("kept"), kept["cover"].alias("cover"), kept["cues"].alias("cues"), kept["kind"].alias("kind"), F.lit(now).alias("ts"))


def subtitle_search_job(state: StateTable, items: DataFrame, streams: DataFrame, candidates: DataFrame, blocklist: DataFrame, spans: DataFrame, now: dt.datetime, log: str | None = None, keys: list | None = None, limit: int | None = None) -> int:
    """C1 with its state: decides what lacks subtitles and is not decided (or the named keys), shortest first; the state's version.

    The log's rows are written under the version that is to come, then the state moves there. So a run that stops on the
    way decides nothing, and the next one decides the same, whose log rows take the place of those left; a run with
    nothing to do adds no version.
    """
    work = stored(J.todo(P.needs_subtitles(items, streams), state.read(), keys, limit, size="duration"), "work")
    if work.isEmpty():  # before a candidate is looked at
        return state.version()
    verdicts = stored(search_verdicts(work, candidates, blocklist, spans, now), "verdicts")
    if log:
        write_run(verdicts.select("rk", F.col("r").alias("event"), "label", "kept", "cover", "cues", "kind", "ts"), log, f"v{state.version() + 1}")
    return state.commit(verdicts)


RESYNC = "rk {key}, r string, offset double, why string, scale2 double, shift double, ts timestamp"


def resync_job(state: StateTable, found: DataFrame, tracks: DataFrame, cues: DataFrame, alignments: DataFrame, anchors: DataFrame, now: dt.datetime, log: str | None = None, keys: list | None = None, limit: int | None = None) -> DataFrame:
    """C4 with its state: aligns the tracks of items that the search's state (found) has matched and that are not decided (or the
    named keys), in order of label; the corrected cues of this run, as write_srt() takes them. Stops and repeats as subtitle_search_job()."""
    matched = found.select("rk", "label") if keys is not None else found.where("r = 'matched'").select("rk", "label")
    work = stored(J.todo(matched, state.read(), keys, limit, size="label").select("rk"), "work")
    own = lambda df: df.join(work, "rk", "left_semi")
    verdicts, moved = resync(stored(own(tracks), "tracks"), cues, own(alignments), anchors)  # cues are those of the tracks that are left
    verdicts = stored(work.join(verdicts, "rk", "left").select("rk", F.coalesce("r", F.lit("no_usable_sub")).alias("r"), "offset", "why", "scale2", "shift", F.lit(now).alias("ts")), "verdicts")
    moved = stored(moved, "moved")
    if not verdicts.isEmpty():
        if log:
            write_run(verdicts.select("rk", F.col("r").alias("event"), "offset", "why", "ts"), log, f"v{state.version() + 1}")
        state.commit(verdicts)
    return moved


def disc_accounting(titles: DataFrame, dispositions: DataFrame, discs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Per disc whether all titles are accounted for, and the titles that are not, with what they look like."""
    labelled = P.classify_probed_titles(titles)
    missing = J.unaccounted_titles(titles, dispositions)
    gate = A.disc_gate(discs, missing, P.bad_exclusions(dispositions))
    return gate, J.unaccounted_titles(labelled, dispositions)


def disc_accounting_job(spark: SparkSession, logs: str, dispositions: str, playlists: str, out: str, min_length: int = 10) -> tuple[DataFrame, DataFrame, DataFrame]:
    """C2 from files to files: (gate, missing, counts), and the discs' catalogues written to `out`, many to a file.

    logs are enumerations made with a floor of min_length seconds, one for each disc. missing are titles that nobody decided on, with
    label, geometry, and the number of clips of the playlist that they come from; counts are decisions by kind.
    """
    return account_discs(*read_discs(spark, logs, dispositions, playlists, out, min_length), min_length)


def read_discs(spark: SparkSession, logs: str, dispositions: str, playlists: str, out: str, min_length: int = 10) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The part of C2 that looks at each disc alone, so that some discs may be read after others: (facts, decided, lists) for
    account_discs(), and the catalogues. facts are titles with what their logs say and whether nobody decided on them."""
    titles, streams = S.read_robot_log(spark, logs, once=True)  # used by every step
    decided = stored(S.read_dispositions(spark, dispositions), "decided")
    lists = S.read_playlists(spark, playlists).select("disc", "playlist", F.size("clips").alias("clips"))
    seen = streams.groupBy("disc", "title").agg(F.bool_or(F.coalesce(F.col("type") == "Video", F.lit(False))).alias("has_video"), F.count_if(F.col("type") == "Audio").cast("int").alias("audio"), F.max(F.when(F.col("type") == "Video", F.col("resolution"))).alias("size"))
    facts = titles.join(seen, ["disc", "title"], "left").withColumn("has_video", F.coalesce("has_video", F.lit(False)))
    # Merged here and below: the stored tables are small on disk, not in memory.
    facts = facts.join(decided.select("disc", "title", F.lit(False).alias("open")).distinct().hint("merge"), ["disc", "title"], "left").withColumn("open", F.coalesce("open", F.lit(True)))
    side = lambda k: F.regexp_extract("size", r"^(\d+)x(\d+)", k).try_cast("int")
    kind = F.when(F.col("source").rlike(r"(?i)\.(mpls|m2ts)$"), "BD").otherwise("DVD").alias("kind")
    shape = P.geometry_flags(facts.select("disc", "title", "sec", "has_video", "audio", "open", F.col("out_name").alias("name"), kind, side(1).alias("width"), side(2).alias("height"), F.lit(None).cast("string").alias("field_order"), "source"))
    write_catalogue(titles.withColumn("min_length", F.lit(min_length)), streams, out)
    return stored(shape.select("disc", "title", "sec", "has_video", "audio", "is_sd", F.regexp_replace("source", r"\.mpls$", "").alias("playlist"), "open"), "facts"), decided, lists


def account_discs(facts: DataFrame, decided: DataFrame, lists: DataFrame, min_length: int = 10) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The part of C2 that looks at all discs: (gate, missing, counts) of the tables of read_discs()."""
    labels = P.classify_probed_titles(facts.select("disc", "title", "sec", "has_video", "audio", F.lit(False).alias("phantom")))
    undecided = facts.where("open").select("disc", "title", "is_sd", "playlist")
    missing = undecided.join(labels.hint("merge"), ["disc", "title"], "left").join(lists, ["disc", "playlist"], "left").select("disc", "title", "sec", "label", "is_sd", "clips")
    gate = A.disc_gate(facts.select("disc").distinct().withColumn("min_length", F.lit(min_length)), undecided, P.bad_exclusions(decided))
    return gate, missing, A.verdict_counts(decided, "kind")


def ocr_publish_job(spark: SparkSession, readings: str, timings: DataFrame, probes: DataFrame, dictionary: DataFrame | None, media: DataFrame, local: DataFrame, remote: DataFrame, out: str) -> tuple[DataFrame, DataFrame]:
    """C3 from files to files: texts read from pictures below `readings` become subtitle files in `out`; (status, verified).

    status is each work's, as in ocr_publish(); verified compares every file written with what lies in `out`, by name and bytes.
    """
    texts = S.read_ocr_results(spark, readings)
    cues, _, status, _ = ocr_publish(timings, texts, probes, dictionary, media, local, remote)
    written = write_srt(cues, out)
    there = S.read_listing(spark, out).select("rel", "bytes")
    return status, J.verify_copies(written.withColumnRenamed("name", "rel"), there)


def manifest_job(spark: SparkSession, table: str, streams: DataFrame, playlists: DataFrame, lists: DataFrame, out: str, root: str, src_root: str, disc_form: str) -> DataFrame:
    """C6 from files to files: the pipe table's rows become manifests in `out`, one item a line; the rows that abort, with the reason.

    The table has the columns of manifest(); what it leaves out or leaves empty is null.
    """
    raw = S.read_pipe_table(spark, table)
    kinds = {"file_id": "long", "disc": "long", "year": "int", "season": "int", "ep": "int", "sec": "double", "width": "int", "height": "int"}
    names = ["file_id", "disc", "show", "year", "season", "ep", "name", "kind", "clip", "sec", "width", "height", "field_order", "orig_lang", "sub_track"]
    rows = raw.select(*((F.nullif(F.col(c), F.lit("")) if c in raw.columns else F.lit(None)).try_cast(kinds.get(c, "string")).alias(c) for c in names))
    items, aborts = manifest(stored(rows, "table"), streams, playlists, lists, root, src_root, disc_form)
    write_manifest(items.drop("file_id"), out)
    return aborts


def ocr_publish(timings: DataFrame, texts: DataFrame, probes: DataFrame, dictionary: DataFrame | None, media: DataFrame, local: DataFrame, remote: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """From read pictures to what may be copied: (cues, gates, status, plan).

    timings (file_id, cue, start_s, end_s), texts (file_id, cue, text), probes (file_id, sec, max_packets), media (base,
    populated, dur), local (work, rel, base, bytes), remote (rel, bytes). cues are those of files that pass the gates,
    repaired and numbered, as write_srt() takes them; a work with a file that still waits for its subtitles is held; the
    plan has the files of works that are ready.
    """
    merged = J.merge_ocr(timings, texts).withColumn("text", T.repair_pipes(F.col("text"))["text"])
    span = F.concat(T.sec_to_srt(F.col("start_s")), F.lit(" --> "), T.sec_to_srt(F.col("end_s")))
    block = F.concat_ws("\n", F.col("n").cast("string"), span, "text", F.lit(""))
    whole = merged.groupBy("file_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", block.alias("b")))), lambda x: x["b"]), "\n").alias("text"))
    gates = A.ocr_gates(whole, probes, dictionary)
    passed = gates.where("verdict = 'ok'").select("file_id")
    waiting = J.awaiting_sidecar(media, passed.select(F.col("file_id").cast(media.schema["base"].dataType).alias("base")))
    held = local.join(waiting.select("base"), "base", "left_semi").select("rel")
    status = A.work_status(local.drop("base"), remote, held)
    ready = local.join(status.where("verdict = 'READY'").select("work"), "work", "left_semi")
    return merged.join(passed, "file_id", "left_semi"), gates, status, J.copy_plan(ready, remote, overwrite=True)


def resync(tracks: DataFrame, cues: DataFrame, alignments: DataFrame, anchors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """C4: (state, moved): what became of each item's subtitle, and the cues of those that were corrected.

    tracks (rk, ordinal, cues, forced), cues (rk, ordinal, cue, start_s, end_s, text), alignments (rk, offset, scale), anchors
    (file_id = rk, dur, oa, ob). The fullest track that is not forced is taken. A correction is proposed by the
    alignment and has to be borne out by both anchors; else it is left for review with the reason.
    """
    picked = W.pick_subtitle(tracks).where("picked").select("rk", "ordinal")
    judged = P.offset_verdict(alignments)
    wanted = judged.where("verdict = 'refine'").select("rk")
    # Cues meet once, without texts, one row of each track that is judged.
    own = picked.join(wanted, "rk", "left_semi").withColumnRenamed("rk", "file_id").join(anchors, "file_id")
    times = cues.select(F.col("rk").alias("file_id"), "ordinal", "start_s")
    fit = stored(A.anchor_fit(times, own, ["file_id", "ordinal"]).withColumnRenamed("file_id", "rk").withColumnRenamed("scale", "scale2"), "fit")
    rows = tracks.select("rk").distinct().join(picked, "rk", "left").join(judged.select("rk", "offset", "verdict"), "rk", "left").join(fit, "rk", "left")
    r = (
        F.when(F.col("ordinal").isNull(), "no_usable_sub").when(F.col("verdict").isNull(), "align_fail").when(F.col("verdict") != "refine", F.col("verdict"))
        .when(F.col("reason") == "ok", "resynced").otherwise("needs_review")
    )
    state = rows.select("rk", r.alias("r"), "offset", F.when(F.col("verdict") == "refine", F.coalesce("reason", F.lit("too_few_cues"))).alias("why"), "scale2", "shift")
    moved = cues.join(picked.join(state.where("r = 'resynced'").select("rk", "scale2", "shift"), "rk"), ["rk", "ordinal"])
    at = lambda c: T.shift_scaled(F.col(c), F.col("scale2"), F.col("shift")).alias(c)
    return state, moved.select("rk", "ordinal", "cue", at("start_s"), at("end_s"), "text")


def episode_identity(orderings: DataFrame, a: str, b: str, files: DataFrame, agent: DataFrame, frames: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(evidence, shifted, plan): what speaks for and against each file's place, and how to rename what is shifted.

    orderings (show, ordering, season, idx, title, mins), files (file_id = rk, show, season, idx, file, title, file_mins),
    agent (rk, show, season, idx, title), frames (file_id, t, text). Evidence of a file: whether the orderings disagree at
    its place, the canonical episode of its running time, the verdicts of its slot and of its title card.
    """
    torn = J.compare_orderings(orderings, a, b).select("show", "season", "idx").distinct().withColumn("torn", F.lit(True))
    near = J.match_by_runtime(files, orderings.where(F.col("ordering") == a)).select("file_id", F.col("idx").alias("near_idx"), F.col("verdict").alias("runtime"))
    slots = J.verify_episode_slots(agent, files.select(F.col("file_id").alias("rk"), "file")).select(F.col("rk").alias("file_id"), F.col("verdict").alias("slot"))
    cards = W.best_card_frame(frames, files.select("file_id", "title")).select("file_id", F.col("verdict").alias("card"))
    evidence = files.select("file_id", "show", "season", "idx").join(near, "file_id", "left").join(slots, "file_id", "left").join(cards, "file_id", "left").join(torn, ["show", "season", "idx"], "left")
    shifted = W.uniform_shift(agent, files)
    plan = W.rename_plan(files.select("show", "season", "idx"), shifted.select("show", "season", "shift"))
    return evidence.withColumn("torn", F.coalesce("torn", F.lit(False))), shifted, plan


def manifest(table: DataFrame, streams: DataFrame, playlists: DataFrame, lists: DataFrame, root: str, src_root: str, disc_form: str) -> tuple[DataFrame, DataFrame]:
    """(rows, aborts): manifest rows with paths, subtitle track and labelled audio, and what a preflight holds against them.

    table (file_id, disc, show, year, season, ep, name, kind, clip, sec, width, height, field_order, orig_lang, sub_track), streams
    (file_id, ordinal, kind: audio or subtitle, lang), playlists (disc, playlist, clips), lists (disc, playlist, sec). A row
    that aborts (a truncated stream, a standard source as Blu-ray, a wanted subtitle tag that is missing) is not in rows.
    """
    cut = J.truncated_streams(table.select("disc", F.col("clip").alias("stem"), "sec"), lists, playlists).select("disc", F.col("stem").alias("clip")).distinct()
    short = table.join(cut, ["disc", "clip"], "left_semi").select("file_id", F.lit("truncated stream").alias("reason"))
    standard = P.geometry_flags(table).where("abort").select("file_id", F.lit("standard source as BD").alias("reason"))
    subs = P.select_track(table.select("file_id", "sub_track"), streams.where("kind = 'subtitle'"))
    untagged = subs.where("verdict = 'ABORT'").select("file_id", F.lit("no such subtitle").alias("reason"))
    aborts = short.unionByName(standard).unionByName(untagged)
    good = table.join(aborts, "file_id", "left_anti")
    audio = streams.where("kind = 'audio'").join(good.select("file_id", "orig_lang"), "file_id")
    entry = "array<struct<idx:int,title:string>>"
    none = lambda kind: F.lit(None).cast(kind)
    kept = P.keep_audio(audio, F.coalesce("orig_lang", F.lit("eng")))
    labels = P.label_audio(kept, audio.drop("orig_lang"), good.select("file_id", "orig_lang", none("array<string>").alias("audio_langs"), none(entry).alias("commentary"), none(entry).alias("description")))
    tracks = labels.groupBy("file_id").agg(F.array_sort(F.collect_list(F.struct("place", "ordinal", "language"))).alias("a"))
    rows = good.join(tracks, "file_id", "left").join(subs.select("file_id", F.col("ordinal").alias("subTrack")), "file_id", "left")
    out = T.library_path(F.lit(root), F.col("show"), F.col("season"), F.col("ep"), F.col("name"), F.col("year") if "year" in table.columns else None)
    src = T.source_path(F.lit(src_root), F.lit(disc_form), F.col("disc").cast("string"), F.col("kind"), F.col("clip"))
    pick = lambda f: F.transform("a", lambda x: x[f])
    return rows.select("file_id", out.alias("out"), src.alias("src"), "kind", F.col("subTrack").cast("string").alias("subTrack"), pick("ordinal").alias("audioTracks"), pick("language").alias("audioLangs")), aborts


def library_audit(listing: DataFrame, streams: DataFrame, probes: DataFrame, agent: DataFrame, shipped: DataFrame, indexed: DataFrame, tracks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(findings, rollup): every finding of the audits as (check, key, verdict), and files and GB by kind and day.

    listing (file_id, kind, work, grp, rel, dir, name, ext, bytes, created), the others as their audits take them.
    """
    row = lambda df, check, key, verdict: df.select(F.lit(check).alias("check"), F.col(key).cast("string").alias("key"), F.col(verdict).alias("verdict"))
    findings = [
        row(U.survey_subtitles(listing, streams, U.IMAGE_CODECS, P.TEXT_CODECS).where("needs_ocr <> 'no'"), "subtitles", "rel", "needs_ocr"),
        row(A.stub_inventory(listing, probes).where("verdict not like 'ok%'"), "stub", "file_id", "verdict"),
        row(U.audit_specials(agent).where("verdict not in ('ok', 'NOTE')"), "special", "rk", "verdict"),
        row(U.unindexed_extras(shipped, indexed).withColumn("verdict", F.lit("not indexed")), "extra", "base", "verdict"),
        row(P.layout_violations(listing), "layout", "dir", "reason"),
        row(U.audio_review(tracks).where("verdict <> 'ok'"), "audio", "file_id", "verdict"),
    ]
    out = findings[0]
    for df in findings[1:]:
        out = out.unionByName(df)
    return out, A.inventory_rollup(listing)
