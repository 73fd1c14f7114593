"""Independent DuckDB SQL for every SQL-expressible query.

Written from the base tables (the driver registers ``lineitem``, ``orders``,
``part``, ``embeddings`` ... as views).  Shared derived views are CTE
fragments; each query adds its own final steps.  Conventions: doubles rounded
to 6 places, counts and ranks as BIGINT, every ranking ends in an id
tie-break, ``md5`` prefixes read as 28-bit integers.
"""

from __future__ import annotations

PLAYS = """plays AS (
  SELECT CAST(o.o_custkey AS VARCHAR) AS user_id, CAST(l.l_partkey AS VARCHAR) AS song_id,
         CAST(count(*) AS BIGINT) AS play_count
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  GROUP BY 1, 2)"""

PLAYS_QTY = """plays_qty AS (
  SELECT CAST(o.o_custkey AS VARCHAR) AS user_id, CAST(l.l_partkey AS VARCHAR) AS song_id,
         CAST(sum(l.l_quantity) AS DOUBLE) AS play_count
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  GROUP BY 1, 2)"""

SONGS = """songs AS (
  SELECT CAST(p_partkey AS VARCHAR) AS track_id, CAST(p_partkey AS VARCHAR) AS song_id,
         p_name AS title, p_brand AS artist_name, p_type AS release,
         CAST(p_retailprice AS DOUBLE) AS duration, CAST(1970 + p_size AS INTEGER) AS year
  FROM part)"""

ATTRS = """attrs AS (
  SELECT CAST(p.p_partkey AS VARCHAR) AS track_id,
         abs(CAST(e.embedding[1] AS DOUBLE)) AS danceability,
         abs(CAST(e.embedding[2] AS DOUBLE)) AS energy,
         CAST(floor(abs(CAST(e.embedding[3] AS DOUBLE)) * 100) AS INTEGER) % 12 AS key,
         CAST(e.embedding[4] AS DOUBLE) * 60 AS loudness,
         60 + abs(CAST(e.embedding[5] AS DOUBLE)) * 200 AS tempo,
         3 + CAST(floor(abs(CAST(e.embedding[6] AS DOUBLE)) * 10) AS INTEGER) % 3 AS time_signature
  FROM part p JOIN embeddings e ON p.p_partkey % (SELECT count(*) FROM embeddings) = e.vec_id)"""

SIM = """line_seq AS (
  SELECT l_orderkey, l_partkey,
         row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) AS pos
  FROM lineitem),
adj AS (
  SELECT a.l_partkey AS a, b.l_partkey AS b
  FROM line_seq a JOIN line_seq b ON b.pos = a.pos + 1 AND b.l_orderkey = a.l_orderkey
  WHERE a.l_partkey <> b.l_partkey),
sim AS (
  SELECT CAST(a AS VARCHAR) AS tid, CAST(b AS VARCHAR) AS target,
         CAST(count(*) AS DOUBLE) AS score
  FROM (SELECT a, b FROM adj UNION ALL SELECT b AS a, a AS b FROM adj) u
  GROUP BY 1, 2)"""

HIST = """hist AS (
  SELECT user_id, song_id, track_id, title, play_count, artist_name, duration, year FROM (
    SELECT p.user_id, s.song_id, s.track_id, s.title, p.play_count, s.artist_name,
           s.duration, s.year,
           row_number() OVER (PARTITION BY p.user_id, s.title, s.artist_name
                              ORDER BY p.play_count DESC, s.track_id) AS rn
    FROM plays p JOIN songs s ON p.song_id = s.song_id) x
  WHERE rn = 1)"""

GENRE = """genre AS (
  SELECT CASE e.label WHEN 0 THEN 'folk' WHEN 1 THEN 'jazz and blues'
           WHEN 2 THEN 'classic pop and rock' WHEN 3 THEN 'classical' WHEN 4 THEN 'punk'
           WHEN 5 THEN 'metal' WHEN 6 THEN 'pop' WHEN 7 THEN 'dance and electronica'
           WHEN 8 THEN 'hip-hop' WHEN 9 THEN 'soul and reggae' END AS genre,
         CAST(e.vec_id AS VARCHAR) AS track_id,
         coalesce(p.p_brand, 'unknown') AS artist_name,
         coalesce(p.p_name, 'unknown') AS title,
         CAST(e.embedding[1:30] AS DOUBLE[]) AS f
  FROM embeddings e LEFT JOIN part p ON e.vec_id = p.p_partkey)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def _rank_top(k_cand: int, k: int) -> str:
    return f"""cand AS (
  SELECT h.user_id, m.target, sum(m.score * h.play_count) AS raw_score
  FROM hist h JOIN sim m ON m.tid = h.track_id GROUP BY 1, 2),
top AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id
                 ORDER BY raw_score DESC, target) AS rn FROM cand) x WHERE rn <= {k_cand}),
scaled AS (
  SELECT user_id, target AS track_id,
         CASE WHEN max(raw_score) OVER (PARTITION BY user_id) > 0
              THEN raw_score * 10 / max(raw_score) OVER (PARTITION BY user_id) END
           AS predicted_score
  FROM top),
enriched AS (
  SELECT c.user_id, s.track_id, s.title, s.artist_name, s.duration, s.year, c.predicted_score
  FROM scaled c JOIN songs s ON s.track_id = c.track_id),
dedup AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id, title, artist_name
                 ORDER BY predicted_score DESC, track_id) AS rn FROM enriched) x WHERE rn = 1),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY predicted_score DESC, track_id) AS rk
  FROM dedup)"""


SQL: dict[str, str] = {}

SQL["similar_items_topk"] = with_(PLAYS, SONGS, SIM, HIST, _rank_top(50, 20)) + """
SELECT user_id, CAST(rk AS BIGINT) AS rank, track_id, title, artist_name, duration, year,
       round(predicted_score, 6) AS predicted_score
FROM ranked WHERE rk <= 20"""


def _split(seed: int, *keys: str, fraction: float = 0.8) -> str:
    """The md5-bucket split flag, as in ``cadenza.operators.ratings``."""
    limit = int(round(fraction * (1 << 28)))
    ks = ", ".join(keys)
    return f"(('0x' || substr(md5(concat_ws('|', '{seed}', {ks})), 1, 7))::BIGINT < {limit})"


def _h28(expr: str) -> str:
    return f"('0x' || substr(md5({expr}), 1, 7))::BIGINT"


SQL["listening_history"] = with_(PLAYS, SONGS, HIST) + """
SELECT user_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY play_count DESC, track_id)
       AS BIGINT) AS rank, song_id, track_id, title, play_count, artist_name,
       round(duration, 6) AS duration, year
FROM hist
QUALIFY rank <= 30"""

SQL["norm_by_user_max"] = with_(PLAYS_QTY) + """
SELECT user_id, song_id, round(play_count, 6) AS play_count,
       round(CASE WHEN greatest(max(play_count) OVER (PARTITION BY user_id), 0) = 0 THEN NULL
             ELSE play_count * 10 / greatest(max(play_count) OVER (PARTITION BY user_id), 0)
             END, 6) AS norm_value
FROM plays_qty"""

_MINMAX = """mm AS (
  SELECT user_id, song_id, play_count,
         CASE WHEN max(play_count) OVER (PARTITION BY user_id)
                   > min(play_count) OVER (PARTITION BY user_id)
              THEN (play_count - min(play_count) OVER (PARTITION BY user_id))
                   / (max(play_count) OVER (PARTITION BY user_id)
                      - min(play_count) OVER (PARTITION BY user_id)) END AS norm_value
  FROM plays_qty)"""

SQL["norm_min_max"] = with_(PLAYS_QTY, _MINMAX) + """
SELECT user_id, song_id, round(play_count, 6) AS play_count, round(norm_value, 6) AS norm_value
FROM mm"""

SQL["positive_scores"] = with_(PLAYS_QTY, _MINMAX) + """
SELECT user_id, song_id, round(play_count, 6) AS play_count, round(norm_value, 6) AS norm_value
FROM mm WHERE norm_value > 0"""

SQL["dataset_profile"] = with_(PLAYS) + """
SELECT CAST(count(*) AS BIGINT) AS n_plays, CAST(count(DISTINCT user_id) AS BIGINT) AS n_users,
       CAST(count(DISTINCT song_id) AS BIGINT) AS n_songs
FROM plays"""

SQL["id_hash"] = with_(SONGS) + f"""
SELECT DISTINCT song_id, {_h28('song_id')} AS hash_id FROM songs"""

SQL["id_collisions"] = with_(PLAYS) + f"""
, keys AS (SELECT DISTINCT user_id || ':' || song_id AS song_id,
                  {_h28("user_id || ':' || song_id")} AS hash_id FROM plays),
n AS (SELECT hash_id, count(DISTINCT song_id) AS n_ids FROM keys GROUP BY hash_id
      HAVING count(DISTINCT song_id) > 1)
SELECT k.hash_id, k.song_id, CAST(n.n_ids AS BIGINT) AS n_ids
FROM keys k JOIN n ON k.hash_id = n.hash_id"""

SQL["id_unhash_join"] = with_(PLAYS, SONGS) + f"""
, dim AS (SELECT DISTINCT song_id, {_h28('song_id')} AS hash_id FROM songs)
SELECT p.user_id, {_h28('p.song_id')} AS product, CAST(p.play_count AS DOUBLE) AS rating,
       d.song_id
FROM plays p JOIN dim d ON {_h28('p.song_id')} = d.hash_id"""

SQL["triplet_struct"] = with_(PLAYS) + f"""
SELECT user_id, {_h28('user_id')} AS user_hash, song_id, {_h28('song_id')} AS song_hash,
       CAST(play_count AS DOUBLE) AS rating
FROM plays"""

SQL["triplet_reader"] = with_(PLAYS) + """
SELECT user_id, song_id, CAST(play_count AS INTEGER) AS play_count FROM plays"""

SQL["triplet_reader_ws"] = with_(PLAYS) + """
SELECT user_id, song_id, CAST(play_count AS DOUBLE) AS play_count FROM plays"""

SQL["triplet_stream_ingest"] = SQL["triplet_reader"]

SONGS_FULL = """songs_full AS (
  SELECT CAST(p_partkey AS VARCHAR) AS track_id, p_name AS title,
         CAST(p_partkey AS VARCHAR) AS song_id, p_type AS release, p_brand AS artist_id,
         'mb-' || p_brand AS artist_mbid, p_brand AS artist_name,
         CAST(p_retailprice AS DOUBLE) AS duration, p_size / 50.0 AS artist_familiarity,
         (p_size % 10) / 10.0 AS artist_hotttnesss, CAST(1970 + p_size AS INTEGER) AS year,
         CAST(p_partkey AS INTEGER) AS track_7digitalid, CAST(p_size AS INTEGER) AS shs_perf,
         CAST(p_size % 7 AS INTEGER) AS shs_work
  FROM part)"""

SQL["songs_csv_join"] = with_(SONGS_FULL, ATTRS) + """
SELECT s.track_id, s.title, s.song_id, s.release, s.artist_id, s.artist_mbid, s.artist_name,
       round(s.duration, 6) AS duration, round(s.artist_familiarity, 6) AS artist_familiarity,
       round(s.artist_hotttnesss, 6) AS artist_hotttnesss, s.year, s.track_7digitalid,
       s.shs_perf, s.shs_work, round(a.danceability, 6) AS danceability,
       round(a.energy, 6) AS energy, a.key, round(a.loudness, 6) AS loudness,
       round(a.tempo, 6) AS tempo, a.time_signature
FROM songs_full s JOIN attrs a ON s.track_id = a.track_id"""

SQL["similar_csv_reader"] = with_(SIM) + """
SELECT tid, target, round(score, 6) AS score FROM sim"""

_GENRE_COLS = ["loudness", "tempo", "time_signature", "key", "mode", "duration"] + \
    [f"avg_timbre{i}" for i in range(1, 13)] + [f"var_timbre{i}" for i in range(1, 13)]
_GENRE_WIDE = ", ".join(f"round(f[{i + 1}], 6) AS {c}" for i, c in enumerate(_GENRE_COLS))

SQL["genre_reader"] = with_(GENRE) + f"""
SELECT genre, track_id, artist_name, title, {_GENRE_WIDE},
       CASE genre WHEN 'folk' THEN 0 WHEN 'jazz and blues' THEN 1
         WHEN 'classic pop and rock' THEN 2 WHEN 'classical' THEN 3 WHEN 'punk' THEN 4
         WHEN 'metal' THEN 5 WHEN 'pop' THEN 6 WHEN 'dance and electronica' THEN 7
         WHEN 'hip-hop' THEN 8 WHEN 'soul and reggae' THEN 9 END AS label
FROM genre"""

SQL["parquet_roundtrip"] = with_(SONGS, ATTRS) + """
SELECT s.track_id, s.song_id, s.title, s.artist_name, s.release, round(s.duration, 6) AS duration,
       s.year, round(a.danceability, 6) AS danceability, round(a.energy, 6) AS energy, a.key,
       round(a.loudness, 6) AS loudness, round(a.tempo, 6) AS tempo, a.time_signature
FROM songs s JOIN attrs a ON s.track_id = a.track_id"""

SQL["feature_extract"] = with_(SONGS_FULL, ATTRS) + """
, rec AS (
  SELECT s.song_id, s.track_id, s.artist_name, s.title, a.danceability,
         s.artist_hotttnesss AS song_hotttnesss, s.duration, a.tempo, a.energy, a.key,
         a.loudness, a.time_signature,
         row_number() OVER (PARTITION BY s.year, CAST(s.track_id AS BIGINT) % 4 ORDER BY s.track_id) AS rn
  FROM songs_full s JOIN attrs a ON s.track_id = a.track_id)
SELECT song_id, track_id, artist_name, title, round(danceability, 6) AS danceability,
       round(song_hotttnesss, 6) AS song_hotttnesss, round(duration, 6) AS duration,
       round(tempo, 6) AS tempo, round(energy, 6) AS energy, key,
       round(loudness, 6) AS loudness, time_signature
FROM rec WHERE rn = 1"""

SQL["year_split"] = with_(SONGS) + """
SELECT track_id, title, artist_name, year,
       CASE WHEN year <= 2009 THEN 'known' ELSE 'new' END AS segment
FROM songs WHERE year IS NOT NULL"""

SQL["known_unknown_users"] = with_(PLAYS) + """
SELECT CAST(c.c_custkey AS VARCHAR) AS user_id,
       CASE WHEN EXISTS (SELECT 1 FROM plays p WHERE p.user_id = CAST(c.c_custkey AS VARCHAR))
            THEN 'known' ELSE 'unknown' END AS status
FROM customer c"""

SQL["hash_split"] = with_(PLAYS) + f"""
SELECT user_id, song_id, play_count,
       CASE WHEN {_split(1, 'user_id', 'song_id')} THEN 'train' ELSE 'test' END AS part
FROM plays"""

SQL["bag_difference"] = with_(PLAYS) + f"""
, tr AS (SELECT user_id, play_count FROM plays WHERE {_split(1, 'user_id', 'song_id')})
SELECT l.user_id, l.play_count FROM plays l
WHERE NOT EXISTS (SELECT 1 FROM tr r WHERE r.user_id IS NOT DISTINCT FROM l.user_id
                  AND r.play_count IS NOT DISTINCT FROM l.play_count)"""

SQL["set_difference"] = with_(PLAYS) + f"""
SELECT user_id, play_count FROM plays
EXCEPT
SELECT user_id, play_count FROM plays WHERE {_split(1, 'user_id', 'song_id')}"""

SQL["dedupe_title_artist"] = with_(SONGS) + """
SELECT track_id, title, artist_name, round(duration, 6) AS duration, year FROM (
  SELECT *, row_number() OVER (PARTITION BY title, artist_name
                               ORDER BY duration DESC, track_id) AS rn FROM songs) x
WHERE rn = 1"""

SQL["distinct_rows"] = with_(SONGS) + """
SELECT DISTINCT artist_name, release, year FROM songs"""

SQL["union_sources"] = with_(PLAYS, SONGS, SIM, HIST, _rank_top(50, 20)) + """
SELECT user_id, CAST(rk AS BIGINT) AS rank, track_id, title, artist_name,
       round(duration, 6) AS duration, year, round(predicted_score, 6) AS predicted_score,
       'similar' AS source
FROM ranked WHERE rk <= 20
UNION ALL
SELECT user_id, rank, track_id, title, artist_name, round(duration, 6), year,
       CAST(play_count AS DOUBLE), 'history'
FROM (SELECT *, CAST(row_number() OVER (PARTITION BY user_id ORDER BY play_count DESC, track_id)
             AS BIGINT) AS rank FROM hist) h
WHERE rank <= 30"""

_CONTENT = """content AS (
  SELECT track_id, danceability * 10 AS f_dance, energy * 10 AS f_energy,
         CAST(key AS DOUBLE) AS f_key, CAST(loudness AS DOUBLE) AS f_loudness,
         CAST(tempo AS DOUBLE) AS f_tempo, CAST(time_signature AS DOUBLE) AS f_time_sig
  FROM attrs)"""

SQL["content_features"] = with_(ATTRS, _CONTENT) + """
SELECT track_id, round(f_dance, 6) AS f_dance, round(f_energy, 6) AS f_energy,
       round(f_key, 6) AS f_key, round(f_loudness, 6) AS f_loudness,
       round(f_tempo, 6) AS f_tempo, round(f_time_sig, 6) AS f_time_sig
FROM content"""

SQL["score_class"] = with_(PLAYS_QTY) + """
, n AS (
  SELECT user_id, song_id,
         CASE WHEN greatest(max(play_count) OVER (PARTITION BY user_id), 0) = 0 THEN NULL
              ELSE play_count * 10 / greatest(max(play_count) OVER (PARTITION BY user_id), 0)
         END AS norm_value
  FROM plays_qty)
SELECT user_id, song_id, round(norm_value, 6) AS norm_value,
       CAST(trunc(norm_value) AS INTEGER) AS score_class
FROM n"""

_LABEL = """CAST(CASE genre WHEN 'folk' THEN 0 WHEN 'jazz and blues' THEN 1
         WHEN 'classic pop and rock' THEN 2 WHEN 'classical' THEN 3 WHEN 'punk' THEN 4
         WHEN 'metal' THEN 5 WHEN 'pop' THEN 6 WHEN 'dance and electronica' THEN 7
         WHEN 'hip-hop' THEN 8 WHEN 'soul and reggae' THEN 9 END AS DOUBLE)"""

SQL["genre_features"] = with_(GENRE) + f"""
SELECT track_id, genre, {_LABEL} AS label, list_transform(f, lambda x: round(x, 6)) AS features
FROM genre"""

SQL["genre_features_nonneg"] = with_(GENRE) + f"""
SELECT track_id, genre, {_LABEL} AS label,
       [round(greatest(f[1], 0.0), 6), round(greatest(f[2], 0.0), 6),
        round(greatest(f[3], 0.0), 6), round(greatest(f[4], 0.0), 6),
        round(greatest(f[5], 0.0), 6), round(greatest(f[6], 0.0), 6)] AS f6
FROM genre"""

SQL["genre_label_map"] = with_(GENRE) + f"""
SELECT track_id, genre, CAST({_LABEL} AS INTEGER) AS label FROM genre"""

SQL["genre_distribution"] = with_(GENRE) + """
SELECT genre, CAST(count(*) AS BIGINT) AS n,
       round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS pct
FROM genre GROUP BY genre"""

_INDEX = """idx AS (
  SELECT genre, CAST(row_number() OVER (ORDER BY count(*) DESC, genre) - 1 AS DOUBLE) AS label_index
  FROM genre GROUP BY genre)"""

SQL["label_index"] = with_(GENRE, _INDEX) + """
SELECT g.track_id, g.genre, i.label_index FROM genre g JOIN idx i ON g.genre = i.genre"""

SQL["label_unindex"] = with_(GENRE) + """
SELECT track_id, genre, genre AS genre_back FROM genre"""

SQL["rating_errors"] = with_(PLAYS_QTY) + f"""
, s AS (SELECT *, {_split(5, 'user_id', 'song_id')} AS tr FROM plays_qty),
um AS (SELECT user_id, avg(play_count) AS predicted FROM s WHERE tr GROUP BY user_id),
j AS (SELECT t.play_count AS actual, um.predicted FROM s t JOIN um ON t.user_id = um.user_id
      WHERE NOT t.tr)
SELECT CAST(count(*) AS BIGINT) AS n, round(avg(pow(actual - predicted, 2)), 6) AS mse,
       round(sqrt(avg(pow(actual - predicted, 2))), 6) AS rmse,
       round(avg(abs(abs(actual) - abs(predicted))), 6) AS mae
FROM j"""

_NB = f"""nb_rows AS (
  SELECT track_id, {_LABEL} AS label,
         greatest(f[1], 0.0) AS x1, greatest(f[2], 0.0) AS x2, greatest(f[3], 0.0) AS x3,
         greatest(f[4], 0.0) AS x4, greatest(f[5], 0.0) AS x5, greatest(f[6], 0.0) AS x6,
         {_split(7, 'track_id')} AS tr
  FROM genre),
cls AS (
  SELECT label, count(*) AS n, sum(x1) AS s1, sum(x2) AS s2, sum(x3) AS s3, sum(x4) AS s4,
         sum(x5) AS s5, sum(x6) AS s6
  FROM nb_rows WHERE tr GROUP BY label),
tot AS (SELECT sum(n) AS n_all, count(*) AS k FROM cls),
params AS (
  SELECT c.label, ln(c.n + 1.0) - ln(t.n_all + t.k * 1.0) AS pi,
         ln(c.s1 + 1.0) - ln(c.s1 + c.s2 + c.s3 + c.s4 + c.s5 + c.s6 + 6.0) AS t1,
         ln(c.s2 + 1.0) - ln(c.s1 + c.s2 + c.s3 + c.s4 + c.s5 + c.s6 + 6.0) AS t2,
         ln(c.s3 + 1.0) - ln(c.s1 + c.s2 + c.s3 + c.s4 + c.s5 + c.s6 + 6.0) AS t3,
         ln(c.s4 + 1.0) - ln(c.s1 + c.s2 + c.s3 + c.s4 + c.s5 + c.s6 + 6.0) AS t4,
         ln(c.s5 + 1.0) - ln(c.s1 + c.s2 + c.s3 + c.s4 + c.s5 + c.s6 + 6.0) AS t5,
         ln(c.s6 + 1.0) - ln(c.s1 + c.s2 + c.s3 + c.s4 + c.s5 + c.s6 + 6.0) AS t6
  FROM cls c CROSS JOIN tot t),
nb_scores AS (
  SELECT r.track_id, r.label, p.label AS cls,
         (p.t1 * r.x1 + p.t2 * r.x2 + p.t3 * r.x3 + p.t4 * r.x4 + p.t5 * r.x5 + p.t6 * r.x6)
           + p.pi AS raw
  FROM nb_rows r CROSS JOIN params p WHERE NOT r.tr),
nb_pred AS (
  SELECT track_id, label, cls AS prediction FROM (
    SELECT *, row_number() OVER (PARTITION BY track_id ORDER BY raw DESC, cls) AS rn
    FROM nb_scores) x WHERE rn = 1)"""

SQL["genre_naive_bayes"] = with_(GENRE, _NB) + """
SELECT track_id, label, prediction FROM nb_pred"""

SQL["class_accuracy"] = with_(GENRE, _NB) + """
SELECT CAST(count(*) AS BIGINT) AS n,
       round(avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END), 6) AS accuracy,
       round(1.0 - avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END), 6) AS error
FROM nb_pred"""

SQL["ragged_slice"] = """WITH offs AS (
  SELECT vec_id AS file, CAST(embedding AS DOUBLE[]) AS e, 0 AS start, -1 AS i, 0 AS twice FROM embeddings
  UNION ALL
  SELECT vec_id, CAST(embedding AS DOUBLE[]), i * (4 + label), i, t FROM (
    SELECT *, unnest(range(0, CAST(floor((len(embedding) - 1) / (4 + label)) AS BIGINT) + 1)) AS i FROM embeddings),
    (VALUES (0), (1)) v(t) WHERE t = 0 OR i % 3 = 2
  UNION ALL
  SELECT vec_id, CAST(embedding AS DOUBLE[]), len(embedding), 1000000, 0 FROM embeddings),
bounds AS (
  SELECT file, e, start, row_number() OVER w - 1 AS rec, coalesce(lead(start) OVER w, len(e)) AS stop
  FROM offs WINDOW w AS (PARTITION BY file ORDER BY i, twice))
SELECT file, CAST(rec AS BIGINT) AS rec, CAST(stop - start AS BIGINT) AS n,
       list_transform(e[start + 1:stop], lambda x: round(x, 6)) AS vals
FROM bounds"""

SQL["timbre_mean"] = with_(GENRE) + """
SELECT track_id, round((f[7] + f[8] + f[9] + f[10] + f[11] + f[12] + f[13] + f[14] + f[15]
                        + f[16] + f[17] + f[18]) / 12, 6) AS timbre_mean
FROM genre"""

SQL["timbre_stats"] = """WITH v AS (
  SELECT vec_id, p % 12 + 1 AS dim, p // 12 AS seg, CAST(emb[p + 1] AS DOUBLE) AS v FROM (
    SELECT vec_id, embedding AS emb, UNNEST(range(0, len(embedding))) AS p FROM embeddings) x),
m AS (SELECT vec_id, dim, avg(v) AS avg_i FROM v GROUP BY ALL),
c AS (SELECT a.vec_id, a.dim AS i, b.dim AS j, covar_pop(a.v, b.v) AS cov
      FROM v a JOIN v b ON a.vec_id = b.vec_id AND a.seg = b.seg AND a.dim <= b.dim GROUP BY ALL)
SELECT c.vec_id, CAST(i AS BIGINT) AS i, CAST(j AS BIGINT) AS j, round(avg_i, 6) AS avg_i, round(cov, 6) AS cov
FROM c JOIN m ON m.vec_id = c.vec_id AND m.dim = c.i"""

_SWG = """swg AS (
  SELECT s.track_id, g.f[1] AS loudness, g.f[2] AS tempo
  FROM songs s LEFT JOIN genre g ON s.track_id = g.track_id)"""

SQL["impute_midrange"] = with_(SONGS, GENRE, _SWG) + """
SELECT track_id, round(coalesce(loudness, 0.0), 6) AS loudness, round(coalesce(tempo, 0.5), 6) AS tempo
FROM swg"""

SQL["drop_missing"] = with_(SONGS, GENRE, _SWG) + """
SELECT track_id, round(loudness, 6) AS loudness, round(tempo, 6) AS tempo FROM swg
WHERE loudness IS NOT NULL AND tempo IS NOT NULL"""

SQL["user_profile"] = with_(PLAYS, ATTRS, _CONTENT) + """
SELECT p.user_id,
  round(sum(c.f_dance * p.play_count) / sum(CAST(p.play_count AS DOUBLE)), 6) AS profile_f_dance,
  round(sum(c.f_energy * p.play_count) / sum(CAST(p.play_count AS DOUBLE)), 6) AS profile_f_energy,
  round(sum(c.f_key * p.play_count) / sum(CAST(p.play_count AS DOUBLE)), 6) AS profile_f_key,
  round(sum(c.f_loudness * p.play_count) / sum(CAST(p.play_count AS DOUBLE)), 6)
    AS profile_f_loudness,
  round(sum(c.f_tempo * p.play_count) / sum(CAST(p.play_count AS DOUBLE)), 6) AS profile_f_tempo,
  round(sum(c.f_time_sig * p.play_count) / sum(CAST(p.play_count AS DOUBLE)), 6)
    AS profile_f_time_sig
FROM plays p JOIN content c ON p.song_id = c.track_id
GROUP BY p.user_id"""


def _rank_metrics(k_list: int, ks: list[int], users: str = "true", extra: str = "") -> str:
    plays_train = f"""plays_all AS (
  SELECT CAST(o.o_custkey AS VARCHAR) AS user_id, CAST(l.l_partkey AS VARCHAR) AS song_id,
         CAST(count(*) AS BIGINT) AS play_count
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  GROUP BY 1, 2),
plays AS (SELECT * FROM plays_all WHERE {_split(3, 'user_id', 'song_id')}),
test AS (SELECT * FROM plays_all WHERE NOT {_split(3, 'user_id', 'song_id')})"""
    kvals = ", ".join(f"({k})" for k in ks)
    # similarity from the lines of training plays only
    sim = SIM.replace("FROM lineitem)", """FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN plays ON plays.user_id = CAST(o_custkey AS VARCHAR) AND plays.song_id = CAST(l_partkey AS VARCHAR))""")
    return with_(plays_train, SONGS, sim, HIST, _rank_top(50, k_list)) + f"""
, recs AS (SELECT r.user_id, s.song_id, r.rk FROM ranked r JOIN songs s ON r.track_id = s.track_id
           WHERE r.rk <= {k_list}),
rel AS (SELECT DISTINCT user_id, song_id FROM test WHERE {users}),
nrel AS (SELECT user_id, count(*) AS n_rel FROM rel GROUP BY user_id),
kk AS (SELECT * FROM (VALUES {kvals}) t(k)),
hits AS (SELECT r.user_id, r.rk FROM recs r JOIN rel t ON r.user_id = t.user_id
         AND r.song_id = t.song_id),
pu AS (SELECT h.user_id, kk.k, count(*) AS hits, sum(1.0 / log2(h.rk + 1)) AS dcg
       FROM hits h JOIN kk ON h.rk <= kk.k GROUP BY h.user_id, kk.k),
full_t AS (SELECT n.user_id, n.n_rel, kk.k, coalesce(pu.hits, 0) AS hits,
                  coalesce(pu.dcg, 0.0) AS dcg
           FROM nrel n CROSS JOIN kk LEFT JOIN pu ON pu.user_id = n.user_id AND pu.k = kk.k),
ideal AS (SELECT f.user_id, f.k, (SELECT sum(1.0 / log2(i + 1))
                                  FROM range(1, least(f.k, f.n_rel) + 1) t(i)) AS idcg
          FROM full_t f)
SELECT {extra}CAST(f.k AS BIGINT) AS k, CAST(count(*) AS BIGINT) AS n_users,
       round(avg(f.hits * 1.0 / f.k), 6) AS precision_at_k,
       round(avg(f.hits * 1.0 / f.n_rel), 6) AS recall_at_k,
       round(avg(f.dcg / i.idcg), 6) AS ndcg_at_k
FROM full_t f JOIN ideal i ON f.user_id = i.user_id AND f.k = i.k
GROUP BY f.k"""


SQL["rank_metrics_at_k"] = _rank_metrics(20, [20])
SQL["recall_curve"] = _rank_metrics(50, [1, 5, 10, 20, 50])
SQL["recall_by_method_similar"] = _rank_metrics(
    50, [1, 5, 10, 20, 50], "CAST(user_id AS BIGINT) % 50 = 0", "'similar' AS method, ")

SQL["similar_items_bucketed"] = SQL["similar_items_topk"]   # other tables, the same rows

SQL["single_user_history"] = with_(PLAYS, SONGS) + """
, req AS (SELECT user_id FROM (SELECT user_id, sum(play_count) AS n FROM plays GROUP BY user_id)
          ORDER BY n DESC, user_id LIMIT 1),
""" + HIST.replace("FROM plays p JOIN songs s", "FROM (SELECT * FROM plays WHERE user_id IN "
                   "(SELECT user_id FROM req)) p JOIN songs s") + """
SELECT user_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY play_count DESC, track_id)
       AS BIGINT) AS rank, song_id, track_id, title, play_count, artist_name,
       round(duration, 6) AS duration, year
FROM hist
QUALIFY rank <= 30"""

SQL["top_plays_show"] = with_(PLAYS) + """
SELECT user_id, song_id, play_count FROM plays ORDER BY play_count DESC, user_id, song_id LIMIT 30"""

SQL["ingest_catalogue"] = with_(PLAYS, SONGS, ATTRS, SIM) + """
SELECT 'triplets_data' AS "table", CAST(count(*) AS BIGINT) AS n_rows FROM plays
UNION ALL SELECT 'songs_data', CAST(count(*) AS BIGINT) FROM songs s JOIN attrs a
  ON s.track_id = a.track_id
UNION ALL SELECT 'song_similarity', CAST(count(*) AS BIGINT) FROM sim
UNION ALL SELECT 'song_hash_id', CAST(count(DISTINCT song_id) AS BIGINT) FROM songs
UNION ALL SELECT 'triplets_rejects', CAST(2 * count(*) AS BIGINT) FROM region
UNION ALL SELECT 'songs_rejects', CAST(2 * count(*) AS BIGINT) FROM region
UNION ALL SELECT 'attributes_rejects', CAST(count(*) AS BIGINT) FROM region
UNION ALL SELECT 'similarity_rejects', CAST(3 * count(*) AS BIGINT) FROM region"""

SQL["user_cosine"] = with_(PLAYS_QTY) + """
, req AS (SELECT user_id FROM (SELECT user_id, sum(play_count) AS n FROM plays_qty
          GROUP BY user_id) ORDER BY n DESC, user_id LIMIT 1),
j AS (SELECT m.user_id, o.user_id AS other_user_id, m.play_count AS a, o.play_count AS b
      FROM plays_qty m JOIN plays_qty o ON m.song_id = o.song_id
      WHERE m.user_id IN (SELECT user_id FROM req) AND o.user_id <> m.user_id)
SELECT user_id, other_user_id, CAST(count(*) AS BIGINT) AS n_common,
       round(sum(a * b) / sqrt(sum(a * a) * sum(b * b)), 6) AS cosine
FROM j GROUP BY user_id, other_user_id"""

SQL["user_neighbours"] = with_(PLAYS_QTY) + """
, j AS (SELECT m.user_id, o.user_id AS other_user_id, m.play_count AS a, o.play_count AS b
      FROM plays_qty m JOIN plays_qty o ON m.song_id = o.song_id
      WHERE CAST(m.user_id AS BIGINT) % 50 = 0 AND o.user_id <> m.user_id),
near AS (SELECT user_id, other_user_id, CAST(count(*) AS BIGINT) AS n_common,
       round(sum(a * b) / sqrt(sum(a * a) * sum(b * b)), 6) AS cosine FROM j GROUP BY user_id, other_user_id)
SELECT user_id, other_user_id, n_common, cosine, CAST(row_number() OVER (
         PARTITION BY user_id ORDER BY cosine DESC, n_common DESC, other_user_id) AS BIGINT) AS rank
FROM near QUALIFY rank <= 20"""

_NB_MINMAX_ROWS = f"""nb_rows AS (
  SELECT track_id, {_LABEL} AS label,
         {', '.join(
             f"CASE WHEN mx{i} <> mn{i} THEN (f[{i}] - mn{i}) / (mx{i} - mn{i}) * 1.0 + 0.0 "
             f"ELSE 0.5 END AS x{i}" for i in range(1, 7))},
         {_split(7, 'track_id')} AS tr
  FROM genre CROSS JOIN (SELECT {', '.join(f'min(f[{i}]) AS mn{i}, max(f[{i}]) AS mx{i}'
                                           for i in range(1, 7))} FROM genre) r)"""

SQL["genre_naive_bayes_minmax"] = with_(GENRE, _NB.replace(
    _NB[:_NB.index("cls AS (")].rstrip().rstrip(","), _NB_MINMAX_ROWS)) + """
SELECT track_id, label, prediction FROM nb_pred"""

SQL["normalize_rejects"] = with_(PLAYS_QTY) + """
SELECT user_id, CAST(count(*) AS BIGINT) AS n_rows, 'non-positive maximum' AS reason
FROM (SELECT user_id, play_count FROM plays_qty
      UNION ALL SELECT 'zero-' || c_custkey, unnest([0.0, 0.0]) FROM customer WHERE c_custkey % 7 = 0)
GROUP BY user_id HAVING NOT (max(play_count) > 0) OR max(play_count) IS NULL"""


SQL["hybrid_history_similar"] = with_(PLAYS, SONGS, SIM, HIST, _rank_top(50, 40)) + """
, lists AS (
  SELECT user_id, track_id, title, artist_name, duration, year, predicted_score, 'similar' AS source
  FROM ranked WHERE rk <= 40
  UNION ALL
  SELECT user_id, track_id, title, artist_name, duration, year, CAST(play_count AS DOUBLE), 'history' FROM hist)
SELECT user_id, track_id, title, artist_name, round(duration, 6) AS duration, year,
       round(predicted_score, 6) AS predicted_score, source,
       row_number() OVER (PARTITION BY user_id ORDER BY predicted_score DESC NULLS LAST, track_id, source) AS rank
FROM lists QUALIFY rank <= 40"""

SQL["als_list_shape"] = with_(PLAYS) + """
SELECT DISTINCT user_id, CAST(20 AS BIGINT) AS n, 10.0 AS best, true AS ranks_ok, CAST(0 AS BIGINT) AS repeated
FROM plays WHERE CAST(user_id AS BIGINT) % 50 = 0"""

SQL["als_pairs_scored"] = with_(PLAYS) + f"""
, s AS (SELECT user_id, song_id, {_split(12345, 'user_id', 'song_id', fraction=0.9)} AS tr FROM plays)
SELECT user_id, song_id FROM s WHERE NOT tr
  AND user_id IN (SELECT user_id FROM s WHERE tr) AND song_id IN (SELECT song_id FROM s WHERE tr)"""

SQL["als_save_load"] = with_(PLAYS) + """
SELECT user_id, song_id, true AS same_score FROM plays"""
