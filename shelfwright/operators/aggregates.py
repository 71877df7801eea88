"""Aggregations with verdicts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfwright.functions import text as T
from shelfwright.operators.common import PER_PART, dealt, key_sizes, median_over, with_previous, with_rint_median
from shelfwright.session import stored

# Frequent words of English, and of the languages that a failed reading shows instead.
ENGLISH = "the and you that this with have not for but what are was his her him she they there would your from all been will has had who when were".split()
FOREIGN = (
    "de la el los las una que por para del esta pero todo lo les des du une pour avec dans qui mais cette vous nous der das und ist nicht "
    "fur für mit ein eine sich von dem den het een niet voor zijn"
).split()


def cue_span(cues: DataFrame) -> DataFrame:
    """A1: last end and number of cues of each file."""
    return cues.groupBy("file_id").agg(F.max("end_s").alias("last_end"), F.count("*").alias("cues"))


def _any_word(c: Column, words: list[str]) -> Column:
    tokens = F.regexp_extract_all(F.lower(c), F.lit(r"([a-zà-ÿ]+)"), F.lit(1))
    return F.arrays_overlap(tokens, F.array(*map(F.lit, words)))


#: Bits of a bucket of the sieve (what bitmap_construct_agg makes), bits for each word, bits that a word sets.
_BUCKET, _PER_WORD, _SET = 1 << 15, 12, 4
#: The largest sieve: 8 MB to every executor.
SIEVE_BITS = 1 << 26
#: Words and characters of the largest dictionary that goes to every executor whole.
WHOLE_WORDS, WHOLE_CHARS = 1 << 19, 1 << 23


def _places(word: str) -> list[Column]:
    h = F.xxhash64(F.col(word), F.lit(1))
    return [F.pmod(F.shiftrightunsigned(h, 15 * k), F.lit(_BUCKET)) for k in range(_SET)]


def likely(rows: DataFrame, word: str, known: DataFrame, most_bits: int = SIEVE_BITS) -> DataFrame:
    """rows without those whose word is certainly not among known (word, distinct): a Bloom filter in buckets, all bits of a word in one.

    The filter is built by an aggregate and goes to every task, so that only rows that it passes, about one in a hundred of the
    others among them, move to an exact join. Its size is counted first: 12 bits a word; beyond most_bits rows are passed as they are.
    """
    buckets = max(1, -(-known.count() * _PER_WORD // _BUCKET))
    if buckets * _BUCKET > most_bits:
        return rows
    bucket = lambda c: F.pmod(F.xxhash64(F.col(c)), F.lit(buckets))
    bits = known.select(bucket("word").alias("_bucket"), F.explode(F.array(*_places("word"))).alias("p")).groupBy("_bucket").agg(F.bitmap_construct_agg("p").alias("_bits"))
    # The byte of a place, its bit from the low end.
    is_set = lambda p: F.getbit(F.conv(F.hex(F.substr("_bits", F.floor(p / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("long"), (p % 8).cast("int")) == 1
    passes = is_set(_places(word)[0])
    for p in _places(word)[1:]:
        passes = passes & is_set(p)
    return rows.withColumn("_of", bucket(word)).join(F.broadcast(bits), (F.col("_of") == F.col("_bucket")) & passes, "left_semi").drop("_of")


def ocr_gates(texts: DataFrame, probes: DataFrame, dictionary: DataFrame | None, lang: str = "eng", sieve_bits: int = SIEVE_BITS, whole_words: int = WHOLE_WORDS) -> DataFrame:
    """A2: whether the text read from each file's image subtitles may be used, with the first reason against it.

    texts (file_id, text of a whole subtitle file), probes (file_id, sec, max_packets), dictionary (word) or None.
    A dictionary of whole_words at most goes to the tokens, which do not move. With a larger one tokens are counted by file and word
    before they meet it, and only likely hits move to it (likely()).
    """
    lines = texts.select("file_id", F.explode(F.split("text", "\n", -1)).alias("line"))
    lines = lines.withColumn("line", F.regexp_replace("line", "\r$", ""))
    digits, trimmed = F.col("line").rlike(r"^\d+\s*$"), F.trim("line")
    said = (trimmed != "") & ~digits & ~F.contains("line", F.lit("-->"))
    sound = F.col("line").rlike(r"^\s*[\(\[][^\)\]]{2,}[\)\]]\s*$")
    good = F.length(F.regexp_replace(trimmed, r"[^\p{L} ]", "")) / F.length(trimmed)
    junk = (F.length(trimmed) <= 2) | (good < 0.65)
    by_line = lines.groupBy("file_id").agg(
        F.count_if(digits).alias("cues"), F.count_if(said).alias("lines"), F.count_if(said & junk).alias("junk"), F.count_if(said & ~sound).alias("judgeable"),
        F.count_if(said & ~sound & _any_word(F.col("line"), ENGLISH)).alias("english"), F.count_if(said & _any_word(F.col("line"), FOREIGN)).alias("foreign"),
    )
    share = lambda a, b: F.when(F.col(b) > 0, F.bround(100 * F.col(a) / F.col(b), 0))
    rows = by_line.withColumns({"junk_pct": F.coalesce(share("junk", "lines"), F.lit(100.0)), "english_pct": F.coalesce(share("english", "judgeable"), F.lit(0.0)), "foreign_pct": F.coalesce(share("foreign", "lines"), F.lit(0.0))})
    if dictionary is not None:
        token = F.explode(F.regexp_extract_all("line", F.lit(r"([A-Za-z][A-Za-z']{2,})"), F.lit(1)))
        words = lines.where(said & ~sound).select("file_id", token.alias("w")).select("file_id", F.trim(F.col("w"), F.lit("'")).alias("w"))
        words = words.where((F.length("w") >= 3) & F.col("w").rlike("^[a-z]")).select("file_id", F.lower("w").alias("w"))
        known = stored(dictionary.select(F.lower("word").alias("word")).where("word is not null").distinct(), "words")  # read by each step below
        n, chars = known.agg(F.count("*"), F.coalesce(F.sum(F.length("word")), F.lit(0))).first()
        # A word counts if it is there whole or by its stem before a mark.
        if n <= whole_words and chars <= WHOLE_CHARS:
            there = lambda c: F.broadcast(known.select(F.col("word").alias(c), F.lit(True).alias(f"_{c}")))
            met = words.withColumn("stem", F.substring_index("w", "'", 1)).join(there("w"), "w", "left").join(there("stem"), "stem", "left")
            totals = met.groupBy("file_id").agg(F.count("*").alias("tokens"), F.count_if(F.col("_w").isNotNull() | F.col("_stem").isNotNull()).alias("known"))
        else:
            words = words.groupBy("file_id", "w").agg(F.count("*").alias("n"))
            # What the sieve knows to be absent stays where it is.
            asked = words.select("file_id", "w", "n", F.explode(F.array_distinct(F.array("w", F.substring_index("w", "'", 1)))).alias("word"))
            hits = likely(asked, "word", known, sieve_bits).join(known, "word").select("file_id", "w", "n").distinct()
            totals = words.groupBy("file_id").agg(F.sum("n").alias("tokens"))
            totals = totals.join(hits.groupBy("file_id").agg(F.sum("n").alias("known")), "file_id", "left").na.fill(0, ["known"])
        rows = rows.join(totals, "file_id", "left").withColumns({"tokens": F.coalesce("tokens", F.lit(0).cast("long")), "dict_pct": F.when(F.col("tokens") > 0, F.bround(100 * F.col("known") / F.col("tokens"), 1)).otherwise(0.0)})
    else:
        rows = rows.withColumns({"tokens": F.lit(0).cast("long"), "dict_pct": F.lit(100.0)})
    rows = rows.join(probes, "file_id")
    minutes = F.col("sec") / 60
    floor = F.when(minutes > 5, F.floor(minutes / 4)).otherwise(F.greatest(F.lit(1), F.least(F.lit(5), F.floor(F.col("sec") / 15))))
    floor = F.when(F.col("cues") < floor, F.least(floor, F.greatest(F.lit(1), F.ceil(F.col("max_packets") / 2)))).otherwise(floor)
    eng, short, checked = F.lit(lang == "eng"), F.col("judgeable") < 10, F.lit(dictionary is not None)
    reason = (
        F.when(F.col("cues") < floor, "too few cues")
        .when(F.col("junk_pct") > 30, "junk")
        .when(eng & ~short & (F.col("english_pct") < 15), "function words")
        .when(eng & checked & short & (F.col("foreign_pct") >= 25), "foreign words")
        .when(eng & checked & short & (F.col("tokens") >= 3) & (F.col("dict_pct") < 85), "dictionary (short)")
        .when(eng & checked & ~short & (F.col("tokens") >= 200) & (F.col("dict_pct") < 95), "dictionary")
    )
    return rows.select("file_id", "cues", "lines", "junk_pct", "english_pct", "foreign_pct", "tokens", "dict_pct", F.coalesce(reason, F.lit("ok")).alias("verdict"))


def stub_inventory(listing: DataFrame, probes: DataFrame) -> DataFrame:
    """A4: files suspiciously small, alone or in their folder, judged by running time against what their role needs."""
    rows = with_rint_median(listing, ["dir"], "bytes", "median")
    mb, frac = F.bround(F.col("bytes") / 1048576, 2), F.when(F.col("median") == 0, 1.0).otherwise(F.bround(F.col("bytes") / F.col("median"), 3))
    rows = rows.withColumns({"mb": mb, "frac": frac, "role": T.file_role(T.leaf(F.col("dir")), F.col("name"))}).join(probes, "file_id", "left")
    suspect = (F.col("mb") < 20) | ((F.col("frac") < 0.25) & (F.col("median") > 50 * 1048576))
    floor = F.when(F.col("role") == "Feature", 30.0).when(F.col("role") == "Episode", 10.0).when(F.col("role") == "Part", 2.0).otherwise(0.2)
    mins = F.bround(F.col("sec") / 60, 2)
    verdict = F.when(~suspect, "ok").when(F.col("sec").isNull(), "STUB unreadable").when(mins < floor / 3, "STUB").when(mins < floor, "SUSPECT").otherwise("ok(small)")
    return rows.select("file_id", "role", "mb", "frac", verdict.alias("verdict"))


def shared_soundtracks(titles: DataFrame) -> DataFrame:
    """A5: sound fingerprints of whole titles that several titles of a disc have."""
    whole = titles.where("audio_md5 is not null and probe_scope = 'title'")
    return whole.groupBy("disc", "audio_md5").agg(F.count("*").alias("n"), F.min("title").alias("first_title"), F.max("title").alias("last_title")).where("n > 1")


def commentary_verdict(hashes: DataFrame, a: int = 0, b: int = 1) -> DataFrame:
    """Two tracks' window hashes: COMMENTARY if any differ, DUPLICATE if all agree, TOO SHORT without a pair."""
    by = hashes.where(F.col("track").isin(a, b)).groupBy("file_id", "offset_s").agg(
        F.max(F.when(F.col("track") == a, F.col("h"))).alias("x"), F.max(F.when(F.col("track") == b, F.col("h"))).alias("y")
    )
    both = F.col("x").isNotNull() & F.col("y").isNotNull()
    out = by.groupBy("file_id").agg(F.count_if(both).alias("windows"), F.count_if(both & (F.col("x") != F.col("y"))).alias("differ"))
    return out.withColumn("verdict", F.when(F.col("windows") == 0, "TOO SHORT").when(F.col("differ") > 0, "COMMENTARY").otherwise("DUPLICATE"))


def audio_gaps(packets: DataFrame, probes: DataFrame | None = None, start: float = 1800.0, dur: float = 60.0, fail: float = 1.0, least: int = 50, per_part: int = PER_PART) -> DataFrame:
    """Cadence of packets in a window of each track: frame length, missing share, gaps and their period, FLAG or ok.

    Without probes the window begins at 0 for all. Tracks with under `least` packets or 10 usual distances are left out. A track with more
    than per_part packets in its window is scanned in parts.
    """
    if probes is None:
        rows = packets.where(F.col("pts").between(0.0, dur))
    else:
        met = packets.join(probes, "file_id").withColumn("from_s", F.when(F.col("sec") < start + dur, F.rint(F.col("sec") * 0.25)).otherwise(start))
        rows = met.where(F.col("pts").between(F.col("from_s"), F.col("from_s") + dur))
    key, own = ["file_id", "track"], Window.partitionBy("file_id", "track")
    rows = stored(rows.where("file_id is not null and track is not null").select(*key, "pts"), "packets")  # read by each step below
    total, largest = key_sizes(rows, key)
    usual = F.col("d") < 1.5 * F.col("approx")
    gap = F.col("d") > 1.5 * F.col("frame")
    facts = [F.count_if(usual).alias("usual"), F.min("prev").alias("first"), F.max("pts").alias("last"), F.count("*").alias("present")]
    of_gaps = lambda when: [F.count_if(when).alias("gaps"), F.min(F.when(when, F.col("prev"))).alias("g0"), F.max(F.when(when, F.col("prev"))).alias("g1")]
    if largest <= per_part:
        # Each track whole in one task, which scans it by windows: no joins, one row a track at the end.
        rows = with_previous(dealt(rows, key, total), key, ["pts"], "pts", "prev", None).withColumn("n", F.count("*").over(own)).where(F.col("n") >= least)
        deltas = median_over(rows.where("prev is not null").withColumn("d", F.col("pts") - F.col("prev")), key, "d", "approx", F.lit(True)).where("approx > 0")
        deltas = deltas.withColumn("frame", F.avg(F.when(usual, F.col("d"))).over(own))
        frame = deltas.groupBy(*key, "frame").agg(*facts, *of_gaps(gap)).where("usual >= 10")
    else:
        enough = rows.groupBy(*key).agg(F.count("*").alias("n")).where(F.col("n") >= least).drop("n")
        rows = with_previous(rows.join(enough, key, "left_semi"), key, ["pts"], "pts", "prev", per_part)
        deltas = rows.where("prev is not null").withColumn("d", F.col("pts") - F.col("prev"))
        deltas = stored(with_rint_median(deltas, key, "d", "approx", per_part=per_part).where("approx > 0"), "deltas")
        frame = stored(deltas.groupBy(*key).agg(F.avg(F.when(usual, F.col("d"))).alias("frame"), *facts).where("usual >= 10"), "frame")
        frame = frame.join(deltas.join(frame.select(*key, "frame"), key).where(gap).groupBy(*key).agg(*of_gaps(F.lit(True))), key, "left")
    out = frame.withColumn("expect", F.bround((F.col("last") - F.col("first")) / F.col("frame"), 0))
    missing = 100 * (F.col("expect") - F.col("present")) / F.col("expect")
    n = F.coalesce("gaps", F.lit(0).cast("long"))
    return out.select(*key, F.bround("frame", 6).alias("frame"), F.bround(missing, 3).alias("missing_pct"), n.alias("gaps"), F.when(n >= 2, F.bround((F.col("g1") - F.col("g0")) / (n - 1), 4)).otherwise(0.0).alias("period"), F.when(missing >= fail, "FLAG").otherwise("ok").alias("verdict"))


def crop_vote(samples: DataFrame, default: str = "1440:1080:240:0") -> DataFrame:
    """The modal crop of a file (of equal ones the smallest text), made even; the default if it fits no full side."""
    counts = samples.groupBy("file_id", "crop").agg(F.count("*").alias("n"))
    mode = counts.groupBy("file_id").agg(F.min_by("crop", F.struct(-F.col("n"), F.col("crop"))).alias("mode"))
    p = F.split("mode", ":")
    w, h, x, y = (p[k].try_cast("int") for k in range(4))
    fits = ((w >= 1900) | (h >= 1060)) & w.between(1280, 1920) & h.between(600, 1080)
    made = F.concat_ws(":", w, h, x - x % 2, y - y % 2)
    return mode.select("file_id", F.when(fits, made).otherwise(default).alias("crop"), F.coalesce(~fits, F.lit(True)).alias("defaulted"))


def verdict_counts(df: DataFrame, *cols: str) -> DataFrame:
    """A10: rows by verdict."""
    return df.groupBy(*cols).agg(F.count("*").alias("n"))


def inventory_rollup(listing: DataFrame) -> DataFrame:
    """Files and GB of all, of each kind, and of each kind and day; level tells which."""
    rows = listing.withColumn("day", F.to_date("created").cast("string"))
    out = rows.rollup("kind", "day").agg(F.count("*").alias("files"), (F.sum("bytes") / 1e9).alias("gb"), F.grouping_id().alias("level"))
    return out


def anchor_fit(cues: DataFrame, anchors: DataFrame, on: list[str] | None = None) -> DataFrame:
    """Scale and shift from two anchors, or the first reason why not. anchors: file_id, dur, oa, ob; on: what cues and anchors
    have in common, if that is more than file_id."""
    met = cues.join(anchors, on or ["file_id"])
    a, b = (F.col("start_s") >= 0) & (F.col("start_s") < 0.30 * F.col("dur")), (F.col("start_s") >= 0.70 * F.col("dur")) & (F.col("start_s") < F.col("dur"))
    rows = met.groupBy("file_id", "dur", "oa", "ob").agg(
        F.count("*").alias("cues"), F.count_if(a).alias("na"), F.count_if(b).alias("nb"), F.avg(F.when(a, F.col("start_s"))).alias("ta"), F.avg(F.when(b, F.col("start_s"))).alias("tb")
    )
    railed = lambda c: F.abs(F.abs(F.col(c)) - 15) < 0.6
    reason = (
        F.when(F.col("cues") < 80, "too_few_cues").when(F.col("na") < 30, "sparse_a").when(F.col("oa").isNull(), "anchor_a_failed").when(F.col("nb") < 30, "sparse_b")
        .when(F.col("ob").isNull(), "anchor_b_failed").when(railed("oa"), "anchor_a_railed").when(railed("ob"), "anchor_b_railed")
        .when((F.abs(F.col("ob") - F.col("oa")) > 5) | (F.col("tb") - F.col("ta") < 300), "anchors_inconsistent").otherwise("ok")
    )
    scale = 1 + (F.col("ob") - F.col("oa")) / (F.col("tb") - F.col("ta"))
    out = rows.withColumn("reason", reason).withColumn("scale", F.when(F.col("reason") == "ok", scale))
    return out.select("file_id", "reason", F.bround("scale", 6).alias("scale"), F.bround(F.col("oa") - (F.col("scale") - 1) * F.col("ta"), 4).alias("shift"))


def disc_gate(catalogued: DataFrame, unaccounted: DataFrame, bad: DataFrame, floor_s: int = 10) -> DataFrame:
    """Per disc the first reason against it, else ACCOUNTED. catalogued: disc, min_length (null: no catalogue)."""
    count = lambda df, name: df.groupBy("disc").agg(F.count("*").alias(name))
    rows = catalogued.join(count(unaccounted, "missing"), "disc", "left").join(count(bad, "bad"), "disc", "left").na.fill(0, ["missing", "bad"])
    reason = F.when(F.col("min_length").isNull(), "no catalogue").when(F.col("min_length") > floor_s, "enumeration floor").when(F.col("missing") > 0, "missing titles").when(F.col("bad") > 0, "bad reasons")
    return rows.withColumn("verdict", F.coalesce(reason, F.lit("ACCOUNTED")))


def work_status(local: DataFrame, remote: DataFrame, held: DataFrame) -> DataFrame:
    """Per work READY, BLOCKED or DONE; one file missing or differing there needs a publish, one held blocks the work."""
    met = local.join(remote.select("rel", F.col("bytes").alias("there")), "rel", "left").join(held.select("rel", F.lit(True).alias("hold")).distinct(), "rel", "left")
    rows = met.groupBy("work").agg(F.bool_or(F.col("there").isNull() | (F.col("there") != F.col("bytes"))).alias("needs"), F.bool_or(F.coalesce("hold", F.lit(False))).alias("hold"))
    return rows.withColumn("verdict", F.when(F.col("needs") & F.col("hold"), "BLOCKED").when(F.col("needs"), "READY").otherwise("DONE"))


def engine_agreement(a: DataFrame, b: DataFrame) -> DataFrame:
    """Two readings of the same cues: equal, punctuation only, or words differ; counts of each."""
    met = a.withColumnRenamed("text", "x").join(b.withColumnRenamed("text", "y"), ["file_id", "cue"])
    kind = F.when(F.col("x") == F.col("y"), "equal").when(F.trim(T.norm_ascii(F.col("x"))) == F.trim(T.norm_ascii(F.col("y"))), "punctuation").otherwise("words")
    return met.groupBy(kind.alias("kind")).agg(F.count("*").alias("n"))


def subtitle_kinds(items: DataFrame, streams: DataFrame, text_codecs: list[str]) -> DataFrame:
    """Items with kind: none (without subtitles), image only, or text."""
    subs = streams.where("stream_type = 3").groupBy("rk").agg(F.bool_or(F.col("codec").isin(text_codecs)).alias("text"))
    kind = F.when(F.col("text").isNull(), "none").when(F.col("text"), "text").otherwise("image only")
    return items.join(subs, "rk", "left").withColumn("kind", kind).drop("text")


def library_subtitle_stats(items: DataFrame, streams: DataFrame, text_codecs: list[str]) -> DataFrame:
    """Items without subtitles, with images only, with text; and their shares."""
    counts = subtitle_kinds(items, streams, text_codecs).groupBy("kind").agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("total"))
    return counts.crossJoin(F.broadcast(total)).select("kind", "n", F.bround(100 * F.col("n") / F.col("total"), 2).alias("pct"))  # at most three rows by one


def subtitle_sketches(items: DataFrame, streams: DataFrame, text_codecs: list[str], by: list[str], lg: int = 12) -> DataFrame:
    """(by.., kind, sketch): sketches of the different items of each kind, to be stored for each library and merged later.

    2 ** lg registers a sketch, about 1.04 / sqrt(2 ** lg) standard error (1.6 %).
    """
    return subtitle_kinds(items, streams, text_codecs).groupBy(*by, "kind").agg(F.hll_sketch_agg("rk", F.lit(lg)).alias("sketch"))


def sketched_shares(sketches: DataFrame, by: list[str] | None = None) -> DataFrame:
    """(by.., kind, n, pct): about how many different items of each kind the libraries of each `by` hold together (all libraries,
    without one). An item that several libraries hold counts once; no item is looked at again."""
    keys = by or []
    merged = sketches.groupBy(*keys, "kind").agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("n"))
    total = F.sum("n").over(Window.partitionBy(*keys))  # three rows a key
    return merged.select(*keys, "kind", "n", F.bround(100 * F.col("n") / total, 2).alias("pct"))


def ink_weight(palettes: DataFrame) -> DataFrame:
    """Whether a disc's subtitle palette hides anti-aliasing that must be repaired. Arrays of 4 (indices) and 16 (colours)."""
    entry = F.transform(F.sequence(F.lit(0), F.lit(3)), lambda k: F.struct(k.alias("k"), F.get("pal_idx", k).alias("e"), F.get("palette", F.get("pal_idx", k)).alias("rgb"), F.get("hist", k).alias("n"), (F.get("alpha", k) > 0).alias("seen")))
    # In thousandths: as doubles, equal lumas and a distance of just 32 depend on how the sums are rounded.
    luma = lambda c: 299 * F.shiftright(c, 16) + 587 * (F.shiftright(c, 8) % 256) + 114 * (c % 256)
    rows = palettes.withColumn("v", F.transform(F.filter(entry, lambda x: x["seen"]), lambda x: F.struct(luma(x["rgb"]).alias("l"), x["k"].alias("k"), x["e"].alias("e"), x["rgb"].alias("rgb"), x["n"].alias("n"))))
    rows = rows.withColumn("low", F.array_min(F.transform("v", lambda x: x["l"])))
    rows = rows.withColumn("ink", F.filter("v", lambda x: x["l"] - F.col("low") > 32_000)).withColumn("fill", F.array_max("ink"))
    total = F.aggregate("ink", F.lit(0).cast("long"), lambda acc, x: acc + x["n"])
    ratio = F.when((F.size("v") >= 2) & (F.size("ink") >= 2) & (F.col("fill.n") > 0), (total - F.col("fill.n")) / F.col("fill.n"))
    kept = F.transform(F.filter("v", lambda x: x["l"] - F.col("low") <= 32_000), lambda x: x["e"])
    changed = F.size(F.filter("ink", lambda x: (x["e"] != F.col("fill.e")) & ~F.array_contains(kept, x["e"]) & (x["rgb"] != F.col("fill.rgb"))))
    return rows.select("disc", F.bround(ratio, 2).alias("ratio"), F.when(ratio.isNull() | (ratio < 0.15) | (changed == 0), "skip").otherwise("repair").alias("verdict"))
