"""Known values of the text expressions."""

import pytest
from pyspark.sql import functions as F

from shelfwright.functions import text as T


def one(spark, make, *values):
    df = spark.createDataFrame([values], ", ".join(f"c{k} {'double' if isinstance(v, float) else 'string'}" for k, v in enumerate(values)))
    return df.select(make(*(F.col(f"c{k}") for k in range(len(values)))).alias("x")).first().x


@pytest.mark.parametrize(
    ("want", "cand", "sim"),
    [
        ("Star Trek: Deep Space Nine", "Star.Trek.DS9", 0.4), ("Grange Hill", "King of the Hill", 0.5), ("Danger Man", "Henry Danger", 0.5), ("Public Eye", "Queer Eye", 0.5), ("The Killing", "Forbrydelsen", 0.0),
        ("Dirty Harry", "Dirty.Harry.Dead.Pool.1988", 1.0), ("A Murder of Quality", "A.Murder.of.Crows.1998", 0.5), ("Anything", "English_ 23_975 fps_ 1h57m36s", None), ("The", "x", 1.0),
    ],
)
def test_title_sim(spark, want, cand, sim):
    assert one(spark, T.title_sim, want, cand) == sim


def test_titles(spark):
    assert one(spark, T.usable_title, "Episode 7") is False and one(spark, T.usable_title, "Luck") is True
    assert one(spark, T.same_episode, "LUCK OF THE IRISH", "The Luck of the Irish") is True
    assert one(spark, T.same_episode, "Lights of London (1)", "Lights of London (2)") is False
    assert one(spark, T.same_episode, "Ends, Part Two", "Ends (2)") is True
    assert one(spark, T.normalize_title, "Élan vital!") == "elanvital"


def test_names(spark):
    r = one(spark, T.parse_episode_name, "Show S05E12-E13.mkv")
    assert (r.season, r.ep_from, r.ep_to, r.title) == (5, 12, 13, "")
    r = one(spark, T.parse_episode_name, "Show S01E02 - A - B.mkv")
    assert (r.ep_from, r.ep_to, r.title) == (2, 2, "A - B")
    assert one(spark, T.parse_episode_name, "Film.mkv") is None
    assert [tuple(x) for x in one(spark, T.se_tokens, "a.S01E02.s1x03")] == [(1, 2), (1, 3)]


def test_cards(spark):
    assert one(spark, T.card_score, "Lights of London (1)", "LIGHTS OF LONDON 1") == 1.0
    assert one(spark, T.card_score, "Lights of London (2)", "LIGHTS OF LONDON 1") == 0.67


def test_times_and_sizes(spark):
    assert one(spark, T.hms_to_sec, "1:34:58") == 5698.0 and one(spark, T.sec_to_srt, 3661.9996) == "01:01:02,000" and one(spark, T.sec_to_srt, -4.0) == "00:00:00,000"
    assert one(spark, lambda c: T.sec_to_srt(T.srt_to_sec(c)), "00:59:59,123") == "00:59:59,123"
    assert one(spark, T.size_to_gb, "33.2 GB") == 33.2 and one(spark, T.size_to_gb, "512 MB") == 0.5 and one(spark, T.size_to_gb, "x") is None


def test_pipes_and_paths(spark):
    r = one(spark, T.repair_pipes, "1\n00:00:01,000 --> 00:00:02,000 |\n| am |\n")
    assert r.text == "1\n00:00:01,000 --> 00:00:02,000 |\nI am I\n" and r.n == 2
    assert one(spark, T.leaf, "D:\\a\\b.mkv") == "b.mkv" and one(spark, T.safe_name, "a b/c") == "a_b_c"
    assert one(spark, T.file_role, "Featurettes", "x.mkv") == "Extra" and one(spark, T.file_role, "Film", "Show s00e1.mkv") == "Special"
    assert one(spark, lambda c: T.map_path(c, [("/a/", "/b/"), ("/", "/z/")]), "/a/x") == "/b/x"
