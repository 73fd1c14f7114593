"""Layer 3: hand-made inputs for the text readers (quoting, headers, rejects)."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import functions as F

from cadenza.functions.packed import dangling_count, unpack_pairs
from cadenza.sources import readers


def _write(text: str, name: str = "part-0.csv") -> str:
    d = tempfile.mkdtemp(prefix="cadenza-test-")
    with open(os.path.join(d, name), "w") as f:
        f.write(text)
    return d


SONG_HEADER = ("track_id,title,song_id,release,artist_id,artist_mbid,artist_name,duration,"
               "artist_familiarity,artist_hotttnesss,year,track_7digitalid,shs_perf,shs_work\n")


def test_quoted_comma_in_title_is_one_row(spark):
    d = _write(SONG_HEADER + 'T1,"Hello, World",S1,R,A1,M1,Artist,200.5,0.5,0.4,2001,7,1,2\n')
    rows, rejects = readers.read_songs_csv(spark, d)
    got = rows.collect()
    assert len(got) == 1 and got[0]["title"] == "Hello, World" and got[0]["year"] == 2001
    assert rejects.count() == 0


def test_data_line_containing_track_id_is_kept(spark):
    d = _write(SONG_HEADER + "track_id_9,x,S,R,A,M,N,1.0,0.1,0.1,2000,1,1,1\n")
    rows, _ = readers.read_songs_csv(spark, d)
    assert [r["track_id"] for r in rows.collect()] == ["track_id_9"]


def test_bad_number_goes_to_rejects(spark):
    d = _write("track_id,danceability,energy,key,loudness,tempo,time_signature\n"
               "T1,0.5,0.6,3,-5.0,120.0,4\nT2,abc,0.6,3,-5.0,120.0,4\n")
    rows, rejects = readers.read_attributes_csv(spark, d)
    assert [r["track_id"] for r in rows.collect()] == ["T1"]
    assert rejects.count() == 1


def test_similarity_line_with_tid_and_packed_list(spark):
    d = _write('tid,target\nTRtid9,"A,0.5,B,0.25"\nT2,"x,0.5,y"\n')
    long = readers.read_similar_long(spark, d)
    got = sorted((r["tid"], r["target"], r["score"]) for r in long.collect())
    assert got == [("T2", "x", 0.5), ("TRtid9", "A", 0.5), ("TRtid9", "B", 0.25)]
    raw, rejects = readers.read_similar_csv(spark, d)
    assert [r.reason for r in rejects.collect()] == ["odd tail"]
    dang = {r["tid"]: r["d"] for r in raw.select("tid", dangling_count("target").alias("d"))
            .collect()}
    assert dang == {"TRtid9": 0, "T2": 1}


def test_empty_packed_list_yields_nothing(spark):
    df = spark.createDataFrame([("T", ""), ("U", None)], "tid string, target string")
    assert unpack_pairs(df).count() == 0


def test_genre_file_comments_header_and_unknown_genre(spark):
    nums = ",".join(["1.5"] * 30)
    d = _write("# note\n%genre,track_id,artist_name,title,...\n"
               f"folk,T1,A,Song,{nums}\npolka,T2,B,Other,{nums}\n")
    rows, rejects = readers.read_genre_file(spark, d)
    got = rows.collect()
    assert len(got) == 1 and got[0]["genre"] == "folk" and got[0]["label"] == 0
    assert got[0]["var_timbre12"] == 1.5
    assert rejects.count() == 1


def test_triplet_variants_and_rejects(spark):
    d = _write("u1\ts1\t3\nu2\ts2\tx\nu3\ts3\n")
    rows, rejects = readers.read_triplets(spark, d, "tab_int")
    assert [(r.user_id, r.play_count) for r in rows.collect()] == [("u1", 3)]
    assert rejects.count() == 2
    d2 = _write("u1  s1\t2.5\n")
    rows2, _ = readers.read_triplets(spark, d2, "whitespace_float")
    assert [(r.user_id, r.song_id, r.play_count) for r in rows2.collect()] == [("u1", "s1", 2.5)]


def test_typed_columns(spark):
    d = _write(SONG_HEADER + "T1,t,S1,R,A1,M1,Artist,200.5,0.5,0.4,2001,7,1,2\n")
    rows, _ = readers.read_songs_csv(spark, d)
    types = dict(rows.dtypes)
    assert types["duration"] == "double" and types["year"] == "int"
    assert rows.where(F.col("shs_work") == 2).count() == 1


ATTR_HEADER = "track_id,danceability,energy,key,loudness,tempo,time_signature\n"


def test_reordered_header_is_followed(spark):
    d = _write("track_id,energy,danceability,key,loudness,tempo,time_signature\nT1,0.9,0.1,3,-5.0,120.0,4\n")
    rows, rejects = readers.read_attributes_csv(spark, d)
    r = rows.first()
    assert (r.danceability, r.energy) == (0.1, 0.9) and rejects.count() == 0


def test_extra_and_missing_fields_are_rejected(spark):
    d = _write(ATTR_HEADER + "T1,0.5,0.6,3,-5.0,120.0,4\nT2,0.5,0.6,3,-5.0,120.0,4,extra\nT3,0.5\n")
    rows, rejects = readers.read_attributes_csv(spark, d)
    assert [r.track_id for r in rows.collect()] == ["T1"] and rejects.count() == 2


def test_doubled_quotes(spark):
    d = _write(SONG_HEADER + 'T1,"Say ""Hi"", now",S1,R,A1,M1,Artist,200.5,0.5,0.4,2001,7,1,2\n')
    rows, rejects = readers.read_songs_csv(spark, d)
    assert rows.first().title == 'Say "Hi", now' and rejects.count() == 0


def test_similarity_lines_quoted_or_not(spark):
    d = _write('tid,target\nT1,A,0.9,B,0.5\nT2,"A,0.25"\n"T3","A,0.75"\n,A,0.5\nT5,A,high\nT6,A,0.5,C\nT7,\n')
    rows, rejects = readers.read_similar_csv(spark, d)
    long = sorted((r.tid, r.target, r.score) for r in unpack_pairs(rows).collect())
    assert long == [("T1", "A", 0.9), ("T1", "B", 0.5), ("T2", "A", 0.25), ("T3", "A", 0.75), ("T6", "A", 0.5)]
    assert sorted(r.reason for r in rejects.collect()) == ["bad score", "no id", "odd tail"]
    # seven lines: two unreadable, the others are rows (one with its odd tail reported)
    assert rows.count() == 5


def test_empty_genre_is_rejected_not_lost(spark):
    nums = ",".join(["1.5"] * 30)
    d = _write(f"# note\n%genre,track_id\nfolk,T1,A,Song,{nums}\n,T2,B,Other,{nums}\n")
    rows, rejects = readers.read_genre_file(spark, d)
    assert rows.count() == 1 and rejects.count() >= 1
