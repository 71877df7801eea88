"""Text, time and size expressions (Column -> Column), all native."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, functions as F

# Words that carry no title, and words of release names.
STOP_WORDS = "the a an of and or to in at on for with from part disc is it my me you we they he she his her their episode".split()
NOISE_WORDS = """bluray blu ray brrip bdrip dvdrip dvd webrip web hdtv hdrip remux uhd hdr sdr x264 x265 h264 h265 hevc xvid divx
avc aac ac3 dts hdma ddp eac3 flac mp3 truehd atmos 1080p 720p 2160p 480p 576p 1080i 4k fps ntsc pal repack proper extended
uncut theatrical internal limited unrated remastered anniversary edition cut version subs sub subtitles eng english en srt hi
nonhi sdh forced track disc disk cd yts yify rarbg ettv mess part chapter final directors director special""".split()
# Phrases of people who talk about a film.
TALK = (
    r"(?i)\b(we (shot|filmed|had|were|wanted)|the scene|this shot|the film|the movie|the director|the script|the sequence|originally|actually"
    r"|you can see|i remember|the studio|the set|camera|takes?|edit|footage|screenplay|producer)\b"
)
# Folders whose files are extras.
EXTRA_FOLDERS = ["featurettes", "behind the scenes", "deleted scenes", "interviews", "scenes", "shorts", "trailers", "other", "extras"]
# Letters that decompose into a letter a-z and marks, and that letter.
_FOLDED = {chr(k): d[0] for k in range(0xC0, 0x2200) if len(d := unicodedata.normalize("NFD", chr(k))) > 1 and "a" <= d[0] <= "z" and all(map(unicodedata.combining, d[1:]))}
ACCENTED, BASE = "".join(_FOLDED), "".join(_FOLDED.values())


def _words(c: Column) -> Column:
    return F.filter(F.split(c, " "), lambda w: w != "")


def norm_ascii(c: Column) -> Column:
    """Small letters; every run of anything but a-z and 0-9 is one space. Null is empty."""
    return F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), "[^a-z0-9]+", " ")


def sig_words(c: Column) -> Column:
    """Words of three characters or more that are no stop words."""
    return F.filter(_words(norm_ascii(c)), lambda w: (F.length(w) >= 3) & ~w.isin(STOP_WORDS))


def content_words(c: Column) -> Column:
    """Significant words without release noise, numbers of 3 or 4 digits and running times."""
    return F.filter(sig_words(c), lambda w: ~w.isin(NOISE_WORDS) & ~w.rlike(r"^\d{3,4}$") & ~w.rlike(r"^[\dhms_.]+$"))


def usable_title(c: Column) -> Column:
    """Whether a title has a word that is neither stop word nor noise nor number."""
    tokens = F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit("([a-z0-9']+)"), F.lit(1))
    return F.exists(tokens, lambda w: ~w.isin(STOP_WORDS) & ~w.isin(NOISE_WORDS) & ~w.rlike(r"^\d+$"))


def title_sim(want: Column, cand: Column) -> Column:
    """T4: share of the wanted words found in the candidate without its spaces.

    1.0 if nothing is wanted; null if the candidate says nothing (such a one passes).
    """
    asked = sig_words(want)
    flat = F.regexp_replace(norm_ascii(cand), " ", "")
    return sim_of(asked, flat, has_content(cand))


def has_content(c: Column) -> Column:
    """Whether there is a content word; looks no further than the first."""
    return F.exists(_words(norm_ascii(c)), lambda w: (F.length(w) >= 3) & ~w.isin(STOP_WORDS) & ~w.isin(NOISE_WORDS) & ~w.rlike(r"^\d{3,4}$") & ~w.rlike(r"^[\dhms_.]+$"))


def sim_of(asked: Column, flat: Column, content: Column) -> Column:
    """T4 from what is worked out once: the wanted words, the candidate without spaces, and whether it has content."""
    share = F.size(F.filter(asked, lambda w: F.contains(flat, w))) / F.size(asked)
    return F.when(F.size(asked) == 0, 1.0).when(~content, F.lit(None)).otherwise(share)


def se_tokens(c: Column) -> Column:
    """T5: every (season, episode) token of a name."""
    pattern = F.lit(r"[sS](\d{1,2})[ ._-]?[eExX](\d{1,3})")
    number = lambda a: F.transform(a, lambda x: x.cast("int"))
    pairs = F.arrays_zip(number(F.regexp_extract_all(c, pattern, F.lit(1))).alias("season"), number(F.regexp_extract_all(c, pattern, F.lit(2))).alias("ep"))
    return F.transform(pairs, lambda x: F.struct(x["season"].alias("season"), x["ep"].alias("ep")))


def parse_episode_name(c: Column) -> Column:
    """Season, ep_from, ep_to and title of a file name; the form without a title is tried first. Null if neither fits."""
    bare, titled = r"(?i)S(\d+)E(\d+)(?:-E(\d+))?\.[^.]+$", r"(?i)S(\d+)E(\d+)(?:-E(\d+))?\s*-\s*(.+)\.[^.]+$"

    def of(pattern: str, title: Column) -> Column:
        part = lambda k: F.regexp_extract(c, pattern, k)
        last = F.when(part(3) != "", part(3)).otherwise(part(2))
        return F.struct(part(1).try_cast("int").alias("season"), part(2).try_cast("int").alias("ep_from"), last.try_cast("int").alias("ep_to"), title.alias("title"))

    return F.when(c.rlike(bare), of(bare, F.lit(""))).when(c.rlike(titled), of(titled, F.regexp_extract(c, titled, 4)))


def normalize_title(c: Column) -> Column:
    """Small letters without accents (as letters decompose) and anything but a-z and 0-9, and without one leading article."""
    plain = F.regexp_replace(F.translate(F.lower(F.coalesce(c, F.lit(""))), ACCENTED, BASE), "[^a-z0-9]", "")
    return F.regexp_replace(plain, "^(the|a|an)", "")


# How a title names its part.
_PARTS = [r"(?i),?\s*part\s+(one|i)\b", r"(?i),?\s*part\s+(two|ii)\b", r"(?i),?\s*part\s+(three|iii)\b"]


def split_part_number(c: Column) -> Column:
    """Normalised base of a title and its part number, if it has one."""
    ending = r"\((\d+)\)\s*$"
    made = lambda base, part: F.struct(normalize_title(base).alias("base"), part.try_cast("int").alias("part"))
    out = F.when(c.rlike(ending), made(F.regexp_replace(c, ending, ""), F.regexp_extract(c, ending, 1)))
    for k, p in enumerate(_PARTS, 1):
        out = out.when(c.rlike(p), made(F.regexp_replace(c, p, ""), F.lit(k)))
    return out.otherwise(made(c, F.lit(None)))


def same_episode(a: Column, b: Column) -> Column:
    """Bases equal, and parts equal where both have one."""
    x, y = split_part_number(a), split_part_number(b)
    return (x["base"] == y["base"]) & F.coalesce(x["part"] == y["part"], F.lit(True))


def _card_words(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), "[^a-z0-9 ]", " "), " +", " "))


def card_score(expected: Column, read: Column) -> Column:
    """Share of the expected words (long ones and numerals) that the text of a title card contains, to 2 places."""
    # Fixed value: which short words count, as numerals.
    asked = F.filter(_words(_card_words(expected)), lambda w: (F.length(w) > 2) | w.rlike(r"^(\d+|i{1,3}|iv|v|vi{0,3}|ix|x)$"))
    seen = _card_words(read)
    return F.when(F.size(asked) == 0, 0.0).otherwise(F.bround(F.size(F.filter(asked, lambda w: F.contains(seen, w))) / F.size(asked), 2))


def hms_to_sec(c: Column) -> Column:
    """H:MM:SS as seconds; null for any other form."""
    part = lambda k: F.get(F.split(c, ":"), k).try_cast("double")
    return F.when(c.rlike(r"^\s*\d+:\d+:\d+(\.\d+)?\s*$"), part(0) * 3600 + part(1) * 60 + part(2))


def srt_to_sec(c: Column) -> Column:
    """HH:MM:SS,mmm (or a point) as seconds."""
    return hms_to_sec(F.regexp_replace(c, ",", "."))


def sec_to_srt(c: Column) -> Column:
    """Seconds as HH:MM:SS,mmm, not below zero, milliseconds rounded with carry."""
    ms = F.bround(F.greatest(c, F.lit(0.0)) * 1000, 0).cast("long")
    return F.format_string("%02d:%02d:%02d,%03d", F.floor(ms / 3_600_000), F.floor(ms / 60_000) % 60, F.floor(ms / 1000) % 60, ms % 1000)


def shift_scaled(t: Column, scale: Column, shift: Column) -> Column:
    """A time in seconds, scaled and shifted, not below zero."""
    return F.greatest(t * scale + shift, F.lit(0.0))


def shift_ms(t: Column, offset_ms: Column) -> Column:
    """A time in seconds moved by whole milliseconds, not below zero."""
    return F.greatest(F.bround(t * 1000, 0).cast("long") + offset_ms, F.lit(0)) / 1000.0


def size_to_gb(c: Column) -> Column:
    """T12: '33.2 GB' or '812 MB' in GB; null if neither."""
    n = F.regexp_extract(c, r"([\d.]+)", 1)
    return F.when(c.rlike(r"(?i)[\d.]+\s*GB"), n.try_cast("double")).when(c.rlike(r"(?i)[\d.]+\s*MB"), n.try_cast("double") / 1024)


def repair_pipes(c: Column) -> Column:
    """Bars become I in lines of text, never in number or time lines; the text and the number of repairs."""
    def line(x: Column) -> Column:
        return F.when(x.rlike(r"^\d+\s*$") | F.contains(x, F.lit("-->")), x).otherwise(F.replace(x, F.lit("|"), F.lit("I")))

    text = F.array_join(F.transform(F.split(c, "\n", -1), line), "\n")
    bars = lambda x: F.length(x) - F.length(F.replace(x, F.lit("|"), F.lit("")))
    return F.struct(text.alias("text"), (bars(c) - bars(text)).alias("n"))


def file_role(folder: Column, name: Column) -> Column:
    """Extra, Special, Episode, Part or Feature."""
    # How names tell roles.
    return (
        F.when(F.lower(folder).isin(EXTRA_FOLDERS) | name.rlike("(?i)(trailer|teaser)"), "Extra")
        .when(name.rlike(r"(?i)s00e\d+"), "Special")
        .when(name.rlike(r"(?i)s\d+e\d+"), "Episode")
        .when(name.rlike(r"(?i)[ -]pt\d+\."), "Part")
        .otherwise("Feature")
    )


def library_path(root: Column, show: Column, season: Column, ep: Column, name: Column, year: Column | None = None) -> Column:
    """root/Show (Year)/Season SS/Show (Year) - SssEee - name.mkv; without a year (or where it is null) the bare show."""
    title = show if year is None else F.concat(show, F.coalesce(F.concat(F.lit(" ("), year.cast("string"), F.lit(")")), F.lit("")))
    return F.concat(F.replace(root, F.lit("\\"), F.lit("/")), F.lit("/"), title, F.format_string("/Season %02d/", season), title, F.format_string(" - S%02dE%02d - ", season, ep), name, F.lit(".mkv"))


def source_path(root: Column, disc_form: Column, disc: Column, kind: Column, clip: Column) -> Column:
    """Where an item is read from: the disc's folder, and on a Blu-ray the clip's stream file below it."""
    folder = F.concat(F.replace(root, F.lit("\\"), F.lit("/")), F.lit("/"), F.replace(disc_form, F.lit("{disc}"), disc))
    return F.when(kind == "BD", F.concat(folder, F.lit("/BDMV/STREAM/"), clip, F.lit(".m2ts"))).otherwise(folder)


def decode_bytes(c: Column) -> Column:
    """Bytes as text by the first encoding that fits: UTF-8 (a mark in front goes), cp1252, Latin-1."""
    plain = c.cast("string")
    latin = F.decode(c, "ISO-8859-1")
    # Of 0x80-0x9F cp1252 has characters of its own, but for five that it lacks.
    own = {chr(k): bytes([k]).decode("cp1252", "ignore") for k in range(0x80, 0xA0)}
    windows = F.translate(latin, "".join(k for k, v in own.items() if v), "".join(own.values()))
    lacking = "[" + "".join(k for k, v in own.items() if not v) + "]"
    return F.regexp_replace(F.when(F.is_valid_utf8(plain), plain).when(latin.rlike(lacking), latin).otherwise(windows), "^\ufeff+", "")


def leaf(c: Column) -> Column:
    """The last part of a path of either kind."""
    return F.substring_index(F.replace(c, F.lit("\\"), F.lit("/")), "/", -1)


def map_path(c: Column, maps: list[tuple[str, str]]) -> Column:
    """The first prefix that fits is rewritten."""
    out = F.when(F.lit(False), c)
    for old, new in maps:
        out = out.when(F.startswith(c, F.lit(old)), F.concat(F.lit(new), F.substring(c, len(old) + 1, 1 << 30)))
    return out.otherwise(c)


def safe_name(c: Column) -> Column:
    """What is no letter, digit, point, dash or underscore becomes one underscore; 80 characters at most."""
    return F.substring(F.regexp_replace(c, r"[^A-Za-z0-9._-]+", "_"), 1, 80)


def commentary_hints(text: Column, lang: Column) -> Column:
    """How often people talk about the film, and COMMENTARY? from two in English on."""
    n = F.regexp_count(F.coalesce(text, F.lit("")), F.lit(TALK))
    return F.struct(n.alias("hints"), F.when((lang == "en") & (n >= 2), "COMMENTARY?").otherwise("dialogue").alias("verdict"))
