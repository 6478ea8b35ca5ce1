"""Independent DuckDB SQL for each registered query, over the provided tables as views.

Written from the semantics (see ``FIXTURES.md``), not generated from the Spark plans.
"""

from __future__ import annotations

# Shared CTEs: observations, the latest-viral-per-id store, the counters after the last poll and
# the raw ranked-list items.
BASE = r"""
base AS (
  SELECT event_id, event_type, user_id, value, props, ts,
         CAST((event_id // 120) * 30 + event_id % 30 AS VARCHAR) AS id,
         CAST(event_id // 30 + 1 AS INTEGER) AS batch,
         CAST(event_id % 30 AS INTEGER) AS list_rank,
         epoch_us(ts) / 1e6 AS obs_s,
         CAST(floor(epoch_us(ts) / 1e6) AS BIGINT) - (event_id % 30 % 24) * 1800 AS unix_time
  FROM events),
scored AS (
  SELECT id, event_type || ' post ' || CAST(event_id AS VARCHAR) AS title,
         CAST(floor(value * 10) AS INTEGER) AS score,
         CAST(json_extract(props, '$.k') AS INTEGER) AS comments,
         'user_' || CAST(user_id AS VARCHAR) AS author, 'events' AS source, event_type AS subreddit,
         obs_s, ts AS observed_at, unix_time, batch, list_rank
  FROM base),
posts AS (
  SELECT *, viral_score > 50 AS is_viral,
         strftime(observed_at, '%Y-%m-%dT%H:%M:%S.%f') AS "timestamp"
  FROM (SELECT *, round((CAST(score AS DOUBLE) + CAST(comments AS DOUBLE) * 2)
                        / pow(greatest(1.0, (obs_s - unix_time) / 3600) + 2, 1.5), 2) AS viral_score
        FROM scored)),
serving AS (
  SELECT id, title, score, comments, viral_score, source, author, observed_at AS "timestamp",
         batch AS batch_num
  FROM posts WHERE is_viral
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY batch DESC) = 1),
per_poll AS (
  SELECT batch, count(*) AS total_processed, CAST(count_if(is_viral) AS BIGINT) AS viral_detected,
         max(observed_at) AS updated_at
  FROM posts GROUP BY batch),
last_poll AS (SELECT * FROM per_poll ORDER BY batch DESC LIMIT 1),
stats AS (
  SELECT 'total_processed' AS stat_key, CAST(total_processed AS VARCHAR) AS stat_value, updated_at FROM last_poll
  UNION ALL SELECT 'viral_detected', CAST(viral_detected AS VARCHAR), updated_at FROM last_poll
  UNION ALL SELECT 'last_batch_time', CAST(batch - 1 AS VARCHAR), updated_at FROM last_poll),
items AS (
  SELECT CAST(id AS BIGINT) AS id,
         CASE WHEN event_type = 'error' THEN 'job' ELSE 'story' END AS "type",
         CASE WHEN event_id % 17 = 0 THEN '' ELSE event_type || ' post ' || CAST(event_id AS VARCHAR) END AS title,
         CASE WHEN event_id % 11 = 0 THEN NULL ELSE CAST(floor(value * 10) AS INTEGER) END AS score,
         CASE WHEN event_id % 13 = 0 THEN NULL ELSE CAST(json_extract(props, '$.k') AS INTEGER) END AS descendants,
         CASE WHEN event_id % 19 = 0 THEN NULL ELSE 'user_' || CAST(user_id AS VARCHAR) END AS "by",
         CAST(NULL AS VARCHAR) AS url, unix_time AS "time", batch, list_rank, ts AS observed_at
  FROM base),
fetched AS (
  SELECT CAST(id AS VARCHAR) AS id, batch, title, coalesce(score, 0) AS score,
         coalesce(descendants, 0) AS comments, coalesce("by", 'unknown') AS author
  FROM items WHERE list_rank < 5 AND title IS NOT NULL AND title <> ''),
normalised AS (
  SELECT CAST(id AS VARCHAR) AS id, title, coalesce(score, 0) AS score, coalesce(descendants, 0) AS comments,
         coalesce("by", 'unknown') AS author, coalesce(url, '') AS url, 'hackernews' AS source,
         (['technology', 'programming', 'MachineLearning', 'datascience', 'artificial', 'Python'])
           [CAST(('0x' || substr(md5(CAST(id AS VARCHAR)), 1, 15))::BIGINT % 6 AS INTEGER) + 1] AS topic,
         coalesce("time", CAST(floor(epoch(observed_at)) AS BIGINT)) AS unix_time, batch, list_rank,
         observed_at
  FROM items WHERE "type" = 'story' AND title IS NOT NULL AND title <> ''),
item_posts AS (
  SELECT *, viral_score > 50 AS is_viral
  FROM (SELECT *, round((CAST(score AS DOUBLE) + CAST(comments AS DOUBLE) * 2)
                        / pow(greatest(1.0, (epoch_us(observed_at) / 1e6 - unix_time) / 3600) + 2, 1.5), 2)
                  AS viral_score
        FROM normalised WHERE list_rank < 30))
"""


def round2(col: str) -> str:
    """Half-up 2-place mean on exact cents."""
    c = f"sum(CAST(round({col} * 100) AS BIGINT))"
    n = f"nullif(count({col}), 0)"
    return f"CAST((2 * {c} + {n}) // (2 * {n}) AS DOUBLE) / 100"


def mean_exact(col: str) -> str:
    return f"CAST(sum(CAST(round({col} * 100) AS BIGINT)) AS DOUBLE) / CAST(nullif(count({col}), 0) * 100 AS DOUBLE)"


def mean_int(col: str) -> str:
    return f"CAST(sum(CAST({col} AS BIGINT)) AS DOUBLE) / CAST(nullif(count({col}), 0) AS DOUBLE)"


def ny(ts: str) -> str:
    return f"timezone('America/New_York', timezone('UTC', {ts}))"


def iso_ny(ts: str) -> str:
    off = f"date_diff('minute', {ts}, {ny(ts)})"
    return (f"strftime({ny(ts)}, '%Y-%m-%dT%H:%M:%S.%f') || CASE WHEN {off} < 0 THEN '-' ELSE '+' END"
            f" || lpad(CAST(abs({off}) // 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST(abs({off}) % 60 AS VARCHAR), 2, '0')")


TIER = """CASE WHEN viral_score >= 100 THEN 'MEGA VIRAL (100+)'
               WHEN viral_score >= 75 THEN 'HIGH VIRAL (75-100)'
               WHEN viral_score >= 50 THEN 'VIRAL (50-75)'
               ELSE 'TRENDING (<50)' END"""
LABEL = """CASE WHEN viral_score >= 100 THEN '🔥 MEGA VIRAL'
                WHEN viral_score >= 75 THEN '⚡ HIGH VIRAL'
                WHEN viral_score >= 50 THEN '📈 VIRAL'
                ELSE '🌱 TRENDING' END"""
STATS_JSON = "(SELECT to_json(map_from_entries(list(struct_pack(k := stat_key, v := stat_value) ORDER BY stat_key))) FROM stats)"
NOW = "(SELECT max(updated_at) FROM stats)"


def _q(body: str) -> str:
    return "WITH " + BASE.strip() + "\n" + body.strip()


SQL: dict[str, str] = {
    "viral_score": _q("SELECT id, batch, score, comments, unix_time, viral_score, is_viral FROM posts"),
    "head_of_list": _q("SELECT CAST(id AS BIGINT) AS id, batch, list_rank, \"type\", title FROM items WHERE list_rank < 5"),
    "normalise_items": _q("SELECT id, batch, title, score, comments, author, url, source, unix_time "
                          "FROM normalised"),
    "fetch_posts": _q("SELECT id, batch, title, score, comments, author FROM fetched"),
    "score_items": _q("SELECT id, batch, topic AS subreddit, score, comments, author, unix_time, "
                      "strftime(observed_at, '%Y-%m-%dT%H:%M:%S.%f') AS \"timestamp\", viral_score, is_viral "
                      "FROM item_posts"),
    "assign_topic": _q("SELECT id, batch, topic FROM normalised"),
    "publish_envelope": _q("""
SELECT CASE WHEN id IS NOT NULL AND id <> '' THEN id END AS "key",
       CAST(json_object('id', id, 'title', title, 'score', score, 'comments', comments, 'author', author,
                        'url', '', 'source', source, 'subreddit', subreddit, 'timestamp', "timestamp",
                        'unix_time', unix_time, 'viral_score', viral_score, 'is_viral', is_viral,
                        'batch', batch) AS VARCHAR) AS "value"
FROM posts"""),
    "parse_posts": _q("""
SELECT id, title, score, comments, author, source, subreddit, viral_score, is_viral, "timestamp", unix_time, batch,
       strftime(observed_at, '%Y-%m-%dT%H:%M:%S.%f') AS observed_at
FROM posts"""),
    "viral_posts_view": _q("SELECT id, title, score, viral_score, author, \"timestamp\" "
                           "FROM posts WHERE viral_score > 50"),
    "tier_distribution": _q(f"SELECT {TIER} AS category, count(*) AS post_count, "
                            f"{round2('viral_score')} AS avg_score FROM posts GROUP BY 1"),
    "tier_distribution_serving": _q(f"SELECT {TIER} AS category, count(*) AS post_count, "
                                    f"{round2('viral_score')} AS avg_score FROM serving GROUP BY 1"),
    "author_leaderboard": _q(f"""
SELECT author, count(*) AS viral_posts, {round2('viral_score')} AS avg_viral_score, max(score) AS best_score
FROM serving GROUP BY author ORDER BY avg_viral_score DESC, author ASC NULLS LAST LIMIT 5"""),
    "topic_leaderboard": _q(f"""
SELECT subreddit, count(*) AS post_count, {mean_int('score')} AS avg_score,
       {mean_exact('viral_score')} AS avg_viral_score, CAST(sum(comments) AS BIGINT) AS total_comments,
       max(viral_score) AS peak_viral_score
FROM posts WHERE is_viral GROUP BY subreddit"""),
    "top_viral_posts": _q("""
SELECT id, substr(title, 1, 50) AS title_preview, score, viral_score
FROM serving ORDER BY viral_score DESC, id ASC LIMIT 5"""),
    "poll_summary": _q("""
SELECT batch, count(*) AS sent, CAST(count_if(is_viral) AS BIGINT) AS viral,
       substr(arg_min(title, list_rank), 1, 60) AS top_title, arg_min(score, list_rank) AS top_score
FROM posts GROUP BY batch"""),
    "hourly_rollup": _q(f"""
SELECT strftime(observed_at, '%Y-%m-%d %H:00') AS hour_bucket, count(*) AS total_posts,
       CAST(count_if(is_viral) AS BIGINT) AS viral_posts, {round2('viral_score')} AS avg_viral_score,
       arg_max(title, (viral_score, batch, id)) AS top_title
FROM posts GROUP BY 1"""),
    "windowed_topics": _q(f"""
SELECT subreddit AS topic, strftime(date_trunc('hour', observed_at), '%Y-%m-%d %H:%M:%S') AS window_start,
       count(*) AS post_count, {mean_int('score')} AS avg_score, {mean_exact('viral_score')} AS avg_viral_score,
       CAST(sum(comments) AS BIGINT) AS total_comments
FROM posts GROUP BY 1, 2"""),
    "viral_posts_latest": _q("""
SELECT id, title, score, comments, viral_score, source, author,
       strftime("timestamp", '%Y-%m-%dT%H:%M:%S.%f') AS "timestamp", batch_num
FROM serving"""),
    "pipeline_stats": _q("SELECT stat_key, stat_value, "
                         "strftime(updated_at, '%Y-%m-%dT%H:%M:%S.%f') AS updated_at FROM stats"),
    "stats_map": _q("""
SELECT coalesce(max(stat_value) FILTER (WHERE stat_key = 'total_processed'), 'N/A') AS total_processed,
       coalesce(max(stat_value) FILTER (WHERE stat_key = 'viral_detected'), 'N/A') AS viral_detected,
       coalesce(max(stat_value) FILTER (WHERE stat_key = 'last_batch_time'), 'N/A') AS last_batch_time
FROM stats"""),
    "stats_summary": _q(f"""
SELECT (SELECT count(*) FROM serving) AS total_viral_posts,
       coalesce((SELECT stat_value FROM stats WHERE stat_key = 'total_processed'), '0') AS total_processed,
       coalesce((SELECT stat_value FROM stats WHERE stat_key = 'viral_detected'), '0') AS viral_detected,
       coalesce((SELECT {round2('viral_score')} FROM serving), 0.0) AS avg_viral_score,
       coalesce((SELECT round(max(viral_score), 2) FROM serving), 0.0) AS peak_viral_score,
       'ACTIVE' AS pipeline_health, 'live' AS source"""),
    "store_audit": _q("""
SELECT (SELECT count(*) FROM serving) AS stored_posts,
       coalesce((SELECT stat_value FROM stats WHERE stat_key = 'total_processed'), 'N/A') AS total_processed,
       coalesce((SELECT stat_value FROM stats WHERE stat_key = 'viral_detected'), 'N/A') AS viral_detected,
       coalesce((SELECT stat_value FROM stats WHERE stat_key = 'last_batch_time'), 'N/A') AS last_batch_time"""),
    "trending_board": _q(f""", top AS (
  SELECT *, row_number() OVER (ORDER BY viral_score DESC, id ASC) AS "rank"
  FROM serving ORDER BY viral_score DESC, id ASC LIMIT 20)
SELECT CAST("rank" AS INTEGER) AS "rank", id, title, {LABEL} AS tier_label,
       printf('%.1f', CAST((CAST(round(viral_score * 100) AS BIGINT) + 5) // 10 AS DOUBLE) / 10) AS score_1dp,
       CAST((CAST(round(viral_score * 100) AS BIGINT) + 50) // 100 AS VARCHAR) AS score_0dp,
       least(100.0, viral_score) AS bar_width, author, score, comments, source
FROM top"""),
    "trending_top20": _q(""", top AS (
  SELECT *, row_number() OVER (ORDER BY viral_score DESC, id ASC) AS "rank"
  FROM serving ORDER BY viral_score DESC, id ASC LIMIT 20)
SELECT id, title, score, comments, viral_score, author, source, CAST("rank" AS INTEGER) AS "rank" FROM top"""),
    "trending_payload": _q(f""", top AS (SELECT * FROM serving ORDER BY viral_score DESC, id ASC LIMIT 20)
SELECT {iso_ny(NOW)} AS generated_at, (SELECT count(*) FROM serving) AS total_viral_posts, 'live' AS source,
       {STATS_JSON} AS pipeline_stats,
       (SELECT to_json(list(struct_pack(id := id, title := title, score := score, comments := comments,
                                        viral_score := viral_score, author := author, source := source)
                            ORDER BY viral_score DESC, id ASC)) FROM top) AS trending"""),
    "trend_report": _q(f""", top AS (SELECT * FROM serving ORDER BY viral_score DESC, id ASC LIMIT 3)
SELECT {iso_ny(NOW)} AS generated_at, strftime({ny(NOW)}, '%Y-%m-%d %H:00') AS hour,
       (SELECT count(*) FROM serving) AS total_viral_posts, {STATS_JSON} AS pipeline_stats,
       (SELECT to_json(list(struct_pack(title := title, score := score, viral_score := viral_score)
                            ORDER BY viral_score DESC, id ASC)) FROM top) AS top_viral,
       strftime({ny(NOW)}, '%Y%m%d_%H') AS report_hour"""),
    "analytics_report": _q(f""", top AS (SELECT * FROM serving ORDER BY viral_score DESC, id ASC LIMIT 5)
SELECT {iso_ny(NOW)} AS generated_at, (SELECT count(*) FROM serving) AS total_viral_posts,
       {STATS_JSON} AS pipeline_stats,
       (SELECT to_json(list(struct_pack(id := id, title := title, viral_score := viral_score)
                            ORDER BY viral_score DESC, id ASC)) FROM top) AS top_posts"""),
    "report_hour": _q(f"""
SELECT id, batch, {iso_ny('observed_at')} AS generated_at,
       strftime({ny('observed_at')}, '%Y-%m-%d %H:00') AS hour,
       strftime({ny('observed_at')}, '%Y%m%d_%H') AS report_hour
FROM posts"""),
}

# The same results reached through the stream, the raw CSV table and the ORC table.
SQL["stream_viral_latest"] = SQL["viral_posts_latest"]
SQL["stream_ingest_counts"] = _q("SELECT count(*) AS total_processed, "
                                 "CAST(count_if(is_viral) AS BIGINT) AS viral_detected FROM posts")
SQL["stream_windowed_topics"] = SQL["windowed_topics"]
# The replay takes 4 ranges of consecutive polls, one micro-batch each (epochs 0-3); the counters
# are those of the last range.
SQL["stream_pipeline_stats"] = _q("""
, bounds AS (SELECT min(batch) AS lo, (max(batch) - min(batch)) // 4 + 1 AS step FROM posts),
last_drop AS (SELECT * FROM posts WHERE batch >= (SELECT lo + 3 * step FROM bounds))
SELECT 'total_processed' AS stat_key, CAST(count(*) AS VARCHAR) AS stat_value FROM last_drop
UNION ALL SELECT 'viral_detected', CAST(count_if(is_viral) AS VARCHAR) FROM last_drop
UNION ALL SELECT 'last_batch_time', '3'""")
SQL["raw_posts_topic_view"] = SQL["topic_leaderboard"]
SQL["raw_posts_viral_view"] = SQL["viral_posts_view"]
SQL["hourly_stats_orc"] = SQL["hourly_rollup"]
for _name in ("hourly_incremental", "catalog_hourly"):
    SQL[_name] = SQL["hourly_rollup"]
SQL["catalog_topic_leaderboard"] = SQL["topic_leaderboard"]
SQL["catalog_viral_posts"] = SQL["viral_posts_view"]
SQL["rebuilt_viral_latest"] = SQL["viral_posts_latest"]
SQL["landed_items"] = SQL["normalise_items"]
SQL["stream_score_items"] = SQL["score_items"]
SQL["analytics_file"] = SQL["analytics_report"]
SQL["batch_tag"] = _q("SELECT id, list_rank, title, CAST(7 AS INTEGER) AS batch FROM items")

# The producer restarts after half of the polls: poll numbers begin again, the order of sending goes on.
SQL["stream_restart_order"] = _q("""
, half AS (SELECT max(batch) // 2 AS h FROM posts)
SELECT id, title, score, comments, viral_score, source, author,
       strftime(observed_at, '%Y-%m-%dT%H:%M:%S.%f') AS "timestamp",
       CAST(CASE WHEN batch > h THEN batch - h ELSE batch END AS INTEGER) AS batch_num
FROM posts, half WHERE is_viral
QUALIFY row_number() OVER (PARTITION BY id ORDER BY batch * 30 + list_rank DESC) = 1""")

# Two report hours: all polls, then the first half (written last, so it stays where the hours agree).
SQL["report_files"] = _q(f"""
, versions AS (SELECT 1 AS step, max(batch) AS upto FROM posts UNION ALL SELECT 2, max(batch) // 2 FROM posts),
seen AS (SELECT step, p.* FROM versions v JOIN posts p ON p.batch <= v.upto),
stored AS (SELECT * FROM seen WHERE is_viral QUALIFY row_number() OVER (PARTITION BY step, id ORDER BY batch DESC) = 1),
tops AS (SELECT * FROM stored QUALIFY row_number() OVER (PARTITION BY step ORDER BY viral_score DESC, id ASC) <= 3),
polls AS (
  SELECT step, batch, count(*) AS total, count_if(is_viral) AS viral, max(observed_at) AS seen_at FROM seen GROUP BY step, batch
  QUALIFY row_number() OVER (PARTITION BY step ORDER BY batch DESC) = 1),
reports AS (
  SELECT step, seen_at, (SELECT count(*) FROM stored s WHERE s.step = polls.step) AS total_viral_posts,
         '{{"last_batch_time":"' || (batch - 1) || '","total_processed":"' || total || '","viral_detected":"' || CAST(viral AS BIGINT) || '"}}'
           AS pipeline_stats,
         (SELECT to_json(list(struct_pack(title := title, score := score, viral_score := viral_score)
                              ORDER BY viral_score DESC, id ASC)) FROM tops t WHERE t.step = polls.step) AS top_viral
  FROM polls)
SELECT {iso_ny('seen_at')} AS generated_at, strftime({ny('seen_at')}, '%Y-%m-%d %H:00') AS hour, total_viral_posts, pipeline_stats, top_viral,
       strftime({ny('seen_at')}, '%Y%m%d_%H') AS report_hour
FROM reports QUALIFY row_number() OVER (PARTITION BY strftime({ny('seen_at')}, '%Y%m%d_%H') ORDER BY step DESC) = 1""")

# Live: one micro-batch of everything (epoch 0). Cached: the payload over the last poll. Empty: nothing.
ONE_BATCH = """'{"last_batch_time":"0","total_processed":"' || (SELECT count(*) FROM posts) || '","viral_detected":"'
       || (SELECT CAST(count_if(is_viral) AS BIGINT) FROM posts) || '"}'"""
SQL["serving_trending"] = _q(f"""
, top AS (SELECT * FROM serving ORDER BY viral_score DESC, id ASC LIMIT 20),
board AS (SELECT to_json(list(struct_pack(id := id, title := title, score := score, comments := comments,
                                          viral_score := viral_score, author := author, source := source)
                              ORDER BY viral_score DESC, id ASC)) AS trending FROM top),
total AS (SELECT count(*) AS n FROM serving)
SELECT 'live' AS source, n AS total_viral_posts, {ONE_BATCH} AS pipeline_stats, CAST(trending AS VARCHAR) AS trending FROM total, board
UNION ALL SELECT 'cached', n, CAST({STATS_JSON} AS VARCHAR), CAST(trending AS VARCHAR) FROM total, board
UNION ALL SELECT 'empty', 0, NULL, '[]'""")
SQL["serving_stats"] = _q(f"""
, figures AS (SELECT count(*) AS n, {round2('viral_score')} AS average, round(max(viral_score), 2) AS peak FROM serving)
SELECT 'live' AS source, n AS total_viral_posts, (SELECT CAST(count(*) AS VARCHAR) FROM posts) AS total_processed,
       (SELECT CAST(CAST(count_if(is_viral) AS BIGINT) AS VARCHAR) FROM posts) AS viral_detected,
       average AS avg_viral_score, peak AS peak_viral_score, 'ACTIVE' AS pipeline_health FROM figures
UNION ALL SELECT 'cached', n, (SELECT stat_value FROM stats WHERE stat_key = 'total_processed'),
       (SELECT stat_value FROM stats WHERE stat_key = 'viral_detected'), average, peak, 'ACTIVE' FROM figures
UNION ALL SELECT 'empty', 0, NULL, NULL, NULL, NULL, 'CACHED'""")
