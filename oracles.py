"""The same results in DuckDB SQL, written independently of the Spark code."""

from __future__ import annotations

from reelmeter.fixed_values import QUESTION_WEIGHTS, QUESTIONS, SHOT_PROMPTS, SUBJECT_BUCKETS

EVENT_FRAMES = """
 ef AS (SELECT user_id AS clip_id, ts, event_id, value AS score, event_type AS label,
               row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS sample_no
        FROM events)
"""
EVENT_META = """
 em AS (SELECT user_id AS clip_id, count(*)::INT AS total_frames, 2.0::DOUBLE AS fps FROM events GROUP BY 1)
"""
PART_META = """
 pm AS (SELECT p_partkey AS clip_id, p_size::DOUBLE AS fps, trunc(p_retailprice)::INT AS total_frames,
               p_size * 16 AS width, p_size * 9 + 1 AS height,
               CASE WHEN p_size > 0 THEN trunc(p_retailprice) / p_size::DOUBLE ELSE 0.0::DOUBLE END AS d
        FROM part)
"""
DETECTIONS = """
 det AS (SELECT o_custkey AS clip_id, l_orderkey AS frame_no, p_name AS label, l_quantity / 50 AS conf
         FROM lineitem JOIN part ON p_partkey = l_partkey JOIN orders ON o_orderkey = l_orderkey
         WHERE l_quantity / 50 > 0.25::DOUBLE)
"""
GRAY = """
 gray AS (SELECT label AS clip_id, vec_id,
                 (row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1) AS sample_no,
                 list_transform(embedding, lambda x: least(255, greatest(0, floor((x::DOUBLE + 0.55::DOUBLE) * 232)::INT))) AS g
          FROM embeddings),
 bright AS (SELECT clip_id, sample_no::INT AS frame_no, g,
                   list_transform(range(0, 8), lambda r: len(list_filter(g[r * 8 + 1 : r * 8 + 8], lambda x: x >= 127))) AS b
            FROM gray),
 lines AS (SELECT clip_id, frame_no, g,
                  (16 - (b[1] + b[2])) / 16.0 >= 0.5 AS black_top,
                  (16 - (b[7] + b[8])) / 16.0 >= 0.5 AS black_bottom,
                  CASE WHEN b[1] >= 4 THEN 0 WHEN b[2] >= 4 THEN 1 WHEN b[3] >= 4 THEN 2 WHEN b[4] >= 4 THEN 3 ELSE 0 END::INT AS smart_top,
                  CASE WHEN b[8] >= 4 THEN 7 WHEN b[7] >= 4 THEN 6 WHEN b[6] >= 4 THEN 5 WHEN b[5] >= 4 THEN 4 ELSE 7 END::INT AS smart_bottom
           FROM bright),
 counts AS (SELECT label AS clip_id, count(*)::BIGINT AS total FROM embeddings GROUP BY 1),
 picks AS (SELECT clip_id, CASE WHEN i = least(5, total) - 1 THEN total - 1
                                ELSE floor(i * ((total - 1)::DOUBLE / (least(5, total) - 1))) END::INT AS frame_no
           FROM counts, unnest(range(0, least(5, total))) AS t(i)),
 sampled AS (SELECT lines.* FROM lines JOIN picks USING (clip_id, frame_no))
"""
COLOURS = """
 px AS (SELECT vec_id, i, list_transform([1000, 10000, 100000], lambda k: ((floor(embedding[i + 1]::DOUBLE * k)::INT % 256) + 256) % 256) AS c
        FROM embeddings, unnest(range(0, 64)) AS u(i))
"""
SMART_PLAN = """
 plan AS (SELECT clip_id, trunc(median(smart_top))::INT AS start_y, trunc(median(smart_bottom))::INT AS end_y
          FROM sampled GROUP BY 1)
"""
RUN_LOG = """
 lg AS (SELECT 'm' || (user_id % 3)::VARCHAR AS metric, user_id::VARCHAR AS video_id, event_id AS seq,
               epoch_us(ts) - floor(value * 1000000)::BIGINT AS started, epoch_us(ts) AS finished,
               CASE WHEN event_type = 'error' THEN 'failed with ' || repeat(props, 12) END AS error
        FROM events)
"""
CUSTOM_BUCKET = """CASE WHEN regexp_matches({c}, 'red|hot') THEN 'warm' WHEN regexp_matches({c}, 'blue|cold') THEN 'cool'
 WHEN regexp_matches({c}, 'large') THEN 'big' WHEN regexp_matches({c}, 'small') THEN 'little' ELSE 'others' END"""
FIXED_BUCKET = (
    "CASE "
    + " ".join(f"WHEN regexp_matches({{c}}, '{'|'.join(words)}') THEN '{name}'" for name, words in SUBJECT_BUCKETS)
    + " ELSE 'others' END"
)
KEPT = [(i, q, w) for i, (q, w) in enumerate(zip(QUESTIONS, QUESTION_WEIGHTS)) if "[[prompt]]" not in q]
QUESTION_ROWS = ", ".join(f"({i}, '{q.replace(chr(39), chr(39) * 2)}', {w!r}::DOUBLE)" for i, q, w in KEPT)
PROMPT_ROWS = ", ".join(f"({i}, '{p}')" for i, p in enumerate(SHOT_PROMPTS))
ANSWERS = """
 pa AS (SELECT conv_id // 10 AS clip_id, conv_id AS frame_no, turn::INT AS p_idx,
               CASE WHEN role = 'assistant'
                    THEN regexp_replace(regexp_replace(text || ' ', '^\\s+', ''), '\\s+$', '') ELSE text END AS answer
        FROM conversations)
"""


def _dot(weights, bias, inputs):
    return " + ".join([f"({w}::DOUBLE) * {x}" for w, x in zip(weights, inputs)] + [f"({bias}::DOUBLE)"])


def _watermark() -> str:
    from query_set import LAYERS

    (w1, b1), (w2, b2) = LAYERS
    x = [f"embedding[{j + 1}]::DOUBLE" for j in range(64)]
    hidden = ", ".join(f"greatest(0.0::DOUBLE, {_dot(w, b, x)}) AS h{i}" for i, (w, b) in enumerate(zip(w1, b1)))
    out = ", ".join(f"{_dot(w, b, ['h0', 'h1', 'h2'])} AS o{i}" for i, (w, b) in enumerate(zip(w2, b2)))
    return f"""
 hid AS (SELECT label AS clip_id, vec_id, {hidden} FROM embeddings),
 lgt AS (SELECT clip_id, vec_id, {out} FROM hid),
 wm AS (SELECT clip_id, vec_id, exp(o0) / (exp(o0) + exp(o1)) AS score FROM lgt)
"""


_WINDOWS = f"""WITH {RUN_LOG},
 r AS (SELECT *, coalesce(sum((error IS NULL)::INT) OVER (PARTITION BY metric ORDER BY finished, seq
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before FROM lg),
 w AS (SELECT metric, before // 50 AS window_no, count(*) AS items, sum((error IS NULL)::INT)::BIGINT AS successes,
              max(finished) AS fin, min(started) AS st FROM r GROUP BY 1, 2),
 t AS (SELECT *, (fin - coalesce(lag(fin) OVER (PARTITION BY metric ORDER BY window_no), st)) / 1e6::DOUBLE AS seconds FROM w)
SELECT metric, window_no, items, successes, round(seconds, 6) AS seconds, round(seconds / items, 6) AS s_per_item,
       round(CASE WHEN seconds <> 0 THEN items / seconds END, 6) AS items_per_s FROM t"""

_DENSE = f"WITH {EVENT_FRAMES} SELECT clip_id, event_id, sample_no FROM ef"

ORACLES: dict[str, str] = {
    "clean_title": "SELECT page_id, translate(url, ' /:.', '____') AS clean_title FROM pages",
    "scene_id": """SELECT page_id, split_part(string_split(url, '/')[-1], '.', 1) || '_' || translate(url, ' /:.', '____') AS video_id
        FROM pages""",
    "url_video_id": "SELECT page_id, string_split(url, '?page=')[-1] AS video_id FROM pages",
    "first_link": """SELECT regexp_extract(url, '^https?://([^/]+)', 1) AS yt_clip_title, arg_min(url, page_id) AS yt_clip_link,
        min(page_id) AS ord FROM pages GROUP BY 1""",
    "scene_manifest": """WITH c AS (SELECT page_id, url, translate(url, ' /:.', '____') AS clean_title FROM pages),
        t AS (SELECT clean_title, min(url) AS title FROM c GROUP BY 1),
        f AS (SELECT clean_title, printf('scene_%03d', k) AS scene FROM c, unnest(range(0, page_id % 3 + 1)) AS u(k))
        SELECT scene || '_' || clean_title AS video_id, title, clean_title, scene,
               '/scenes/' || clean_title || '/' || scene || '.x.mp4' AS path FROM f JOIN t USING (clean_title)""",
    "title_collisions": """WITH n AS (SELECT p_name AS t FROM part UNION SELECT replace(p_name, ' ', '.') FROM part)
        SELECT translate(t, ' /:.', '____') AS clean_title, count(*) AS n_titles FROM n GROUP BY 1 HAVING count(*) > 1""",
    "image_files": """WITH p AS (SELECT '/frames/' || source AS clip_id, doc_id,
          '/frames/' || source || printf('/%012d.', doc_id) || ['jpg', 'PNG', 'txt', 'webp'][doc_id % 4 + 1] AS path FROM documents)
        SELECT clip_id, row_number() OVER (PARTITION BY clip_id ORDER BY path) - 1 AS frame_no, path
        FROM p WHERE doc_id % 4 <> 2""",
    "global_index": "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS idx FROM orders",
    "range_slice": """SELECT * FROM (SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_orderkey) - 1 AS idx FROM orders)
        WHERE idx >= 500 AND idx < 10000""",
    "range_slice_selected": """SELECT * FROM (SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_totalprice, o_orderkey) - 1 AS idx
        FROM orders) WHERE idx >= 300""",
    "seeded_shuffle": """SELECT o_orderkey, md5('2025:' || o_orderkey::VARCHAR) AS shuffle_key,
        row_number() OVER (ORDER BY md5('2025:' || o_orderkey::VARCHAR), o_orderkey) - 1 AS position FROM orders""",
    "skip_processed": """SELECT o_orderkey AS video_id, o_totalprice FROM orders
        WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)""",
    "limit_run": "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 100",
    "merge_results": """SELECT o_orderkey AS video_id, CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE o_totalprice + 1 END AS score
        FROM orders""",
    "dense_index": _DENSE,
    "dense_index_segmented": _DENSE,
    "video_info": f"""WITH {PART_META} SELECT clip_id, round(d, 6) AS duration_seconds, total_frames, fps, width, height,
        width::VARCHAR || 'x' || height::VARCHAR AS resolution FROM pm""",
    "fit_dims": f"""WITH {PART_META}, r AS (SELECT *, least(512.0::DOUBLE / width, 288.0::DOUBLE / height) AS ratio FROM pm)
        SELECT clip_id, trunc(width * ratio)::INT AS width, trunc(height * ratio)::INT AS height FROM r""",
    "trim_plan": f"""WITH {PART_META} SELECT clip_id, CASE WHEN d - 40 > 0 THEN 'trimmed' ELSE 'failed' END AS status,
        CASE WHEN d - 40 > 0 THEN trunc((d - 40) * fps)::INT END AS frames_to_keep FROM pm""",
    "trim_summary": f"""WITH {PART_META} SELECT count(*) FILTER (WHERE d - 40 > 0) AS successful,
        count(*) FILTER (WHERE NOT d - 40 > 0) AS failed, count(*) AS total FROM pm""",
    "apply_trim": f"""WITH {EVENT_FRAMES}, {EVENT_META}
        SELECT clip_id, sample_no AS frame_no, score FROM ef JOIN em USING (clip_id)
        WHERE total_frames / fps - 25 <= 0 OR sample_no < trunc((total_frames / fps - 25) * fps)""",
    "sample_uniform": f"""WITH {PART_META} SELECT clip_id, i AS sample_no, i::DOUBLE AS t_s, round_even(i * fps, 0)::INT AS frame_no
        FROM pm, unnest(range(0, ceil(d)::BIGINT + 2)) AS u(i) WHERE i < d AND round_even(i * fps, 0) < total_frames""",
    "sample_uniform_fps": f"""WITH RECURSIVE {PART_META},
        top AS (SELECT max(d) AS m FROM pm),
        grid(k, t) AS (SELECT 0::BIGINT, 0.0::DOUBLE UNION ALL SELECT k + 1, t + 0.1::DOUBLE FROM grid WHERE t < (SELECT m FROM top)),
        smp AS (SELECT clip_id, k, round_even(t * fps, 0)::BIGINT AS f, total_frames FROM pm JOIN grid ON t < d)
        SELECT clip_id, count(*) AS n, sum(f)::BIGINT AS sum_frames, sum(f * (k + 1))::BIGINT AS weighted_frames
        FROM smp WHERE f < total_frames GROUP BY 1""",
    "sample_uniform_discard": f"""WITH {PART_META} SELECT clip_id, i AS sample_no, i::DOUBLE AS t_s, round_even(i * fps, 0)::INT AS frame_no
        FROM pm, unnest(range(0, ceil(d)::BIGINT + 2)) AS u(i)
        WHERE i < d AND i <= d - 30 AND round_even(i * fps, 0) < total_frames""",
    "sample_timestamped": f"""WITH {PART_META},
        smp AS (SELECT clip_id, i, floor(i * 0.5::DOUBLE)::BIGINT AS sec, round_even(i * 0.5::DOUBLE * fps, 0)::INT AS frame_no
                FROM pm, unnest(range(0, ceil(d * 2)::BIGINT + 2)) AS u(i)
                WHERE i * 0.5::DOUBLE <= d AND round_even(i * 0.5::DOUBLE * fps, 0) < total_frames)
        SELECT clip_id, printf('frame_%02d:%02d.png', sec // 60, sec % 60) AS label, arg_max(frame_no, i) AS frame_no
        FROM smp GROUP BY clip_id, sec""",
    "fetch_frames": (_FETCHED := f"""WITH {EVENT_FRAMES}, {EVENT_META},
        smp AS (SELECT clip_id, i AS sample_no, round_even(i * fps, 0)::INT AS frame_no
                FROM em, unnest(range(0, ceil(total_frames / fps)::BIGINT + 1)) AS u(i)
                WHERE i < total_frames / fps AND round_even(i * fps, 0) < total_frames)
        SELECT smp.clip_id, smp.sample_no, smp.frame_no, score FROM smp
        JOIN ef ON ef.clip_id = smp.clip_id AND ef.sample_no = smp.frame_no"""),
    "sample_frames": _FETCHED.replace("smp.frame_no, score", "smp.frame_no::BIGINT AS frame_no, score"),
    "sample_frames_fps": f"""WITH RECURSIVE {EVENT_META},
        rates(fps, step) AS (VALUES (3, 1 / 3::DOUBLE), (10, 1 / 10::DOUBLE), (24, 1 / 24::DOUBLE), (30, 1 / 30::DOUBLE)),
        top AS (SELECT max(total_frames / fps) AS m FROM em),
        grid(rate, step, k, t) AS (SELECT fps, step, 0::BIGINT, 0.0::DOUBLE FROM rates
          UNION ALL SELECT rate, step, k + 1, t + step FROM grid WHERE t < (SELECT m FROM top))
        SELECT rate AS fps, clip_id, k AS sample_no, round_even(t * em.fps, 0)::BIGINT AS frame_no, round(t, 9) AS t_s
        FROM em JOIN grid ON t < total_frames / em.fps WHERE round_even(t * em.fps, 0) < total_frames""",
    "score_by_cost": "SELECT doc_id, length(text)::DOUBLE AS score, NULL::VARCHAR AS error FROM documents",
    "cost_balance": """WITH s AS (SELECT count(*) AS n, sum(n_chars)::BIGINT AS c FROM documents)
        SELECT 'even' AS kind, n AS rows, c AS cost, true AS balanced FROM s UNION ALL SELECT 'hot', n + 1, c + c // 2, true FROM s""",
    "keyframes": "SELECT user_id AS clip_id, event_id AS frame_no, true AS is_key FROM events WHERE event_type = 'view'",
    "stride": f"WITH {EVENT_FRAMES} SELECT clip_id, sample_no // 3 AS sample_no, score FROM ef WHERE sample_no % 3 = 0",
    "sample_linspace": f"""WITH {PART_META}, n AS (SELECT clip_id, total_frames AS total, least(5, total_frames) AS n FROM pm WHERE total_frames > 0)
        SELECT clip_id, i AS sample_no, CASE WHEN n = 1 THEN 0 WHEN i = n - 1 THEN total - 1
          ELSE floor(i * ((total - 1)::DOUBLE / (n - 1))) END::INT AS frame_no FROM n, unnest(range(0, n)) AS u(i)""",
    "sample_linspace_repeat": """SELECT p_partkey AS clip_id, i AS sample_no, CASE WHEN i = 23 THEN p_size - 1
          ELSE floor(i * ((p_size - 1)::DOUBLE / 23)) END::INT AS frame_no FROM part, unnest(range(0, 24)) AS u(i) WHERE p_size > 0""",
    "sample_nearest_second": """WITH f AS (SELECT user_id AS clip_id, event_id AS frame_no,
            (epoch_us(ts) - 1704067200000000) / 3600000000.0::DOUBLE AS ts_s FROM events),
        m AS (SELECT clip_id, least(floor(max(ts_s))::BIGINT + 1, 24) AS n FROM f GROUP BY 1),
        g AS (SELECT clip_id, s::INT AS sec FROM m, unnest(range(0, n)) AS u(s)),
        r AS (SELECT clip_id, sec, frame_no, row_number() OVER (PARTITION BY clip_id, sec ORDER BY abs(ts_s - sec), frame_no) AS rn
              FROM g JOIN f USING (clip_id))
        SELECT clip_id, sec, frame_no FROM r WHERE rn = 1""",
    "sample_dir_stride": """WITH p AS (SELECT '/frames/' || source AS clip_id, doc_id,
          '/frames/' || source || printf('/%012d.', doc_id) || ['jpg', 'PNG', 'txt', 'webp'][doc_id % 4 + 1] AS path FROM documents),
        r AS (SELECT clip_id, path, row_number() OVER (PARTITION BY clip_id ORDER BY path) - 1 AS frame_no,
                     greatest(count(*) OVER (PARTITION BY clip_id) // 24, 1) AS step FROM p WHERE doc_id % 4 <> 2)
        SELECT clip_id, frame_no // step AS sample_no, frame_no, path FROM r WHERE frame_no % step = 0 AND frame_no // step < 24""",
    "to_gray": f"""WITH {COLOURS}
        SELECT vec_id, string_agg(printf('%02X', (4899 * c[3] + 9617 * c[2] + 1868 * c[1] + 8192) >> 14), '' ORDER BY i) AS gray FROM px GROUP BY 1""",
    "black_region": f"WITH {GRAY} SELECT clip_id, frame_no, black_top AS \"top\", black_bottom AS bottom FROM lines",
    "crop_boundary": f"WITH {GRAY} SELECT clip_id, frame_no, smart_top AS \"top\", smart_bottom AS bottom FROM lines",
    "frame_crop": f"""WITH {GRAY} SELECT clip_id, frame_no, CASE WHEN black_top THEN 2 END::INT AS top_crop,
        CASE WHEN black_bottom THEN 6 END::INT AS bottom_crop FROM lines""",
    "median_crop": f"""WITH {GRAY} SELECT clip_id, trunc(median(smart_top))::INT AS top_crop,
        trunc(median(smart_bottom))::INT AS bottom_crop FROM lines GROUP BY 1""",
    "clip_crop_plan": f"""WITH {GRAY}, {SMART_PLAN}
        SELECT clip_id, start_y, end_y, CASE WHEN end_y - start_y <= 0 THEN 'invalid' ELSE 'cropped' END AS status FROM plan""",
    "apply_crop": f"""WITH {GRAY}, {SMART_PLAN},
        px AS (SELECT clip_id, frame_no, end_y - start_y AS height, start_y, end_y, g FROM lines JOIN plan USING (clip_id))
        SELECT clip_id, frame_no, height,
          list_aggregate(list_transform(g[start_y * 8 + 1 : end_y * 8], lambda x: printf('%02X', x)), 'string_agg', '') AS pixels FROM px""",
    "crop_clips": f"""WITH {GRAY},
        plan AS (SELECT clip_id, coalesce(trunc(median(CASE WHEN black_bottom THEN 6 END))::INT, 8) AS end_y FROM sampled GROUP BY 1)
        SELECT clip_id, frame_no, end_y AS height,
          list_aggregate(list_transform(g[1 : end_y * 8], lambda x: printf('%02X', x)), 'string_agg', '') AS pixels
        FROM lines JOIN plan USING (clip_id)""",
    "stored_frames": f"""WITH {GRAY} SELECT clip_id, (frame_no // 2)::BIGINT AS sample_no, frame_no,
          list_aggregate(list_transform(g, lambda x: printf('%02X', x)), 'string_agg', '') AS pixels FROM lines WHERE frame_no % 2 = 0""",
    "stored_trim": f"""WITH {GRAY} SELECT clip_id, frame_no,
          list_aggregate(list_transform(g, lambda x: printf('%02X', x)), 'string_agg', '') AS pixels FROM lines JOIN counts USING (clip_id)
        WHERE total / 2.0 - 3 <= 0 OR frame_no < trunc((total / 2.0 - 3) * 2)""",
    "frame_store_scan": f"""WITH {GRAY} SELECT clip_id, frame_no, 8 AS height, 8 AS width, CASE WHEN frame_no < 16 THEN 'early' ELSE 'late' END AS part,
          list_aggregate(list_transform(g, lambda x: printf('%02X', x)), 'string_agg', '') AS pixels FROM lines""",
    "frame_pairs": f"""WITH {EVENT_FRAMES},
        p AS (SELECT clip_id, sample_no - 1 AS pair_no, lag(score) OVER (PARTITION BY clip_id ORDER BY sample_no) AS prev_score, score FROM ef)
        SELECT * FROM p WHERE pair_no >= 0""",
    "block_flow": f"""WITH {GRAY},
        p AS (SELECT clip_id, sample_no - 1 AS pair_no, lag(g) OVER (PARTITION BY clip_id ORDER BY sample_no) AS a, g AS b FROM gray),
        px AS (SELECT clip_id, pair_no, (r // 4) * 2 + c // 4 AS block,
                 (a[r * 8 + c + 2] - a[r * 8 + c]) / 2.0::DOUBLE AS ix, (a[(r + 1) * 8 + c + 1] - a[(r - 1) * 8 + c + 1]) / 2.0::DOUBLE AS iy,
                 (b[r * 8 + c + 1] - a[r * 8 + c + 1])::DOUBLE AS dt
               FROM p, unnest(range(1, 7)) AS u(r), unnest(range(1, 7)) AS v(c) WHERE pair_no >= 0),
        s AS (SELECT clip_id, pair_no, block::INT AS block, sum(ix * ix) AS xx, sum(ix * iy) AS xy, sum(iy * iy) AS yy,
                     sum(ix * dt) AS xt, sum(iy * dt) AS yt FROM px GROUP BY 1, 2, 3),
        d AS (SELECT *, xx * yy - xy * xy AS det FROM s)
        SELECT clip_id, pair_no, block, round(CASE WHEN det = 0 THEN 0 ELSE (xy * yt - yy * xt) / det END, 6) AS u,
               round(CASE WHEN det = 0 THEN 0 ELSE (xy * xt - xx * yt) / det END, 6) AS v FROM d""",
    "flow_plug_in": f"""WITH {GRAY},
        p AS (SELECT clip_id, sample_no - 1 AS pair_no, lag(g) OVER (PARTITION BY clip_id ORDER BY sample_no) AS a, g AS b FROM gray)
        SELECT clip_id, pair_no, i::INT AS cell, (b[i + 1] - a[i + 1])::DOUBLE AS u, (a[i + 1] - b[i + 1])::DOUBLE AS v
        FROM p, unnest(range(0, 64)) AS t(i) WHERE pair_no >= 0""",
    "flow_polar": """WITH f AS (SELECT label AS clip_id, vec_id AS pair_no, i::INT AS cell, embedding[i + 1]::DOUBLE AS u,
            (embedding[64 - i] * 0.5)::FLOAT::DOUBLE AS v FROM embeddings, unnest(range(0, 64)) AS t(i))
        SELECT clip_id, pair_no, cell, round(sqrt(u * u + v * v), 6) AS magnitude,
          round(CASE WHEN atan2(v, u) < 0 THEN atan2(v, u) + 2 * pi() ELSE atan2(v, u) END, 6) AS angle FROM f""",
    "downscale_flow": """WITH f AS (SELECT label AS clip_id, vec_id AS pair_no, ((i // 16) * 4 + (i % 8) // 2)::INT AS cell, embedding[i + 1]::DOUBLE AS u,
            (embedding[64 - i] * 0.5)::FLOAT::DOUBLE AS v FROM embeddings, unnest(range(0, 64)) AS t(i))
        SELECT clip_id, pair_no, 4 AS height, 4 AS width, cell, round((sum(u) / 4)::FLOAT::DOUBLE, 6) AS u,
          round((sum(v) / 4)::FLOAT::DOUBLE, 6) AS v FROM f GROUP BY 1, 2, 5""",
    "motion_score": """WITH f AS (SELECT label AS clip_id, embedding[i + 1]::DOUBLE + (embedding[64 - i] * 0.5)::FLOAT::DOUBLE AS s
            FROM embeddings, unnest(range(0, 64)) AS t(i)),
        m AS (SELECT clip_id, sum(s) / (2 * count(*)) AS m FROM f GROUP BY 1)
        SELECT c_custkey::INT AS clip_id, round(coalesce(m, 'NaN'::DOUBLE), 6) AS motion_flow FROM customer LEFT JOIN m ON clip_id = c_custkey""",
    "track_motion": """WITH t AS (SELECT user_id AS clip_id, value, min(CASE WHEN event_type = 'error' THEN 0 ELSE 1 END)
              OVER (PARTITION BY user_id, event_id % 3 ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS alive FROM events),
        m AS (SELECT clip_id, avg(sqrt(value * value + (value / 2) * (value / 2))) AS m FROM t WHERE alive = 1 GROUP BY 1)
        SELECT c_custkey AS clip_id, round(coalesce(m, 0), 6) AS motion_tracks FROM customer LEFT JOIN m ON clip_id = c_custkey""",
    "aesthetic_head": """WITH e AS (SELECT vec_id, i, embedding[i + 1]::DOUBLE AS x FROM embeddings, unnest(range(0, 64)) AS t(i))
        SELECT vec_id, round(sum(x * i / 64.0::DOUBLE) / sqrt(sum(x * x)) + 5, 6) AS score FROM e GROUP BY 1""",
    "watermark_head": f"WITH {_watermark()} SELECT vec_id, round(score, 6) AS score FROM wm",
    "argmax_label": "SELECT vec_id, 'label' || (list_position(embedding, list_max(embedding)) - 1) AS label FROM embeddings",
    "image_normalise": f"""WITH {COLOURS}
        SELECT vec_id, (3 * i + k - 1)::INT AS pos, round(((c[k] / 255.0::DOUBLE - [0.485, 0.456, 0.406][k]::DOUBLE)
          / [0.229, 0.224, 0.225][k]::DOUBLE)::FLOAT::DOUBLE, 4) AS x FROM px, unnest(range(1, 4)) AS t(k)""",
    "score_batches": """SELECT doc_id, CASE WHEN lang <> 'fr' THEN length(text)::DOUBLE END AS score,
        CASE WHEN lang = 'fr' THEN 'ValueError: language not supported' END AS error FROM documents""",
    "error_rows": "SELECT doc_id, 'ValueError: refused' AS error FROM labels WHERE toxic = 1",
    "prompt_fanout": f"SELECT doc_id, p_idx, prompt FROM documents, (VALUES {PROMPT_ROWS}) AS p(p_idx, prompt)",
    "question_fanout": f"""SELECT c_custkey AS clip_id, q_idx, question, weight FROM customer,
        (VALUES {QUESTION_ROWS}) AS q(q_idx, question, weight)""",
    "avg_aesthetic": """WITH m AS (SELECT user_id, avg(value) AS m FROM events GROUP BY 1)
        SELECT c_custkey AS clip_id, round(coalesce(m, 'NaN'::DOUBLE), 6) AS avg_aesthetic_score FROM customer LEFT JOIN m ON user_id = c_custkey""",
    "aesthetics": f"""WITH {EVENT_FRAMES}, m AS (SELECT clip_id, avg(score) AS m FROM ef GROUP BY 1)
        SELECT c_custkey AS clip_id, (coalesce(sample_no, 0) // 16)::INT AS part_no,
          round(coalesce(m, 'NaN'::DOUBLE), 6) AS avg_aesthetic_score, sample_no::INT AS frame, score
        FROM customer LEFT JOIN m ON m.clip_id = c_custkey LEFT JOIN ef ON ef.clip_id = c_custkey""",
    "nsfw_share": """WITH m AS (SELECT source, avg(coalesce(toxic = 1, false)::INT) AS m FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1)
        SELECT source AS clip_id, round(coalesce(m, 'NaN'::DOUBLE), 6) AS avg_nsfw_score
        FROM (SELECT DISTINCT source FROM documents) LEFT JOIN m USING (source)""",
    "nsfw": """WITH l AS (SELECT source, doc_id::VARCHAR || '.jpg' AS file, CASE toxic WHEN 1 THEN 'nsfw' WHEN 0 THEN 'normal' ELSE 'unknown' END AS label
            FROM documents LEFT JOIN labels USING (doc_id)),
        m AS (SELECT source, avg((label = 'nsfw')::INT) AS m FROM l GROUP BY 1)
        SELECT source AS clip_id, round(coalesce(m, 'NaN'::DOUBLE), 6) AS avg_nsfw_score, file, label
        FROM (SELECT DISTINCT source FROM documents) LEFT JOIN m USING (source) LEFT JOIN l USING (source)""",
    "watermark_avg": f"""WITH {_watermark()}, m AS (SELECT clip_id, avg(score) AS m FROM wm GROUP BY 1)
        SELECT c_custkey::INT AS clip_id, round(coalesce(m, 'NaN'::DOUBLE), 6) AS avg_watermark_score
        FROM customer LEFT JOIN m ON clip_id = c_custkey""",
    "watermark": f"""WITH {_watermark()}
        SELECT clip_id, round(avg(score) OVER (PARTITION BY clip_id), 6) AS avg_watermark_score,
          vec_id::VARCHAR || '.jpg' AS file, round(score, 6) AS score FROM wm""",
    "confidence_filter": f"WITH {DETECTIONS} SELECT clip_id, frame_no, label, conf FROM det",
    "part_bucket": f"SELECT p_partkey, {CUSTOM_BUCKET.format(c='p_name')} AS bucket FROM part",
    "subject_bucket": f"SELECT doc_id, {FIXED_BUCKET.format(c='lower(text)')} AS bucket FROM documents",
    "raw_counts": f"""WITH {DETECTIONS}, c AS (SELECT clip_id, frame_no, lower(label) AS label, count(*)::INT AS n FROM det GROUP BY ALL),
        t AS (SELECT clip_id, frame_no, sum(n)::INT AS n FROM c GROUP BY ALL)
        SELECT clip_id, frame_no, label, n FROM c
        UNION ALL SELECT o_custkey, o_orderkey, 'total', coalesce(n, 0) FROM orders
          LEFT JOIN t ON t.clip_id = o_custkey AND t.frame_no = o_orderkey""",
    "bucketed_counts": f"""WITH {DETECTIONS}, b AS (SELECT clip_id, frame_no, {CUSTOM_BUCKET.format(c='label')} AS b FROM det)
        SELECT o_custkey AS clip_id, o_orderkey AS frame_no, count(*) FILTER (WHERE b = 'warm') AS warm,
          count(*) FILTER (WHERE b = 'cool') AS cool, count(*) FILTER (WHERE b = 'big') AS big,
          count(*) FILTER (WHERE b = 'little') AS little, count(*) FILTER (WHERE b = 'others') AS others, count(b) AS total
        FROM orders LEFT JOIN b ON b.clip_id = o_custkey AND b.frame_no = o_orderkey GROUP BY 1, 2""",
    "subject_averages": f"""WITH {DETECTIONS}, b AS (SELECT clip_id, frame_no, {CUSTOM_BUCKET.format(c='label')} AS b FROM det),
        f AS (SELECT o_custkey, o_orderkey, count(b) AS t, count(*) FILTER (WHERE b = 'warm') AS w, count(*) FILTER (WHERE b = 'cool') AS c
              FROM orders LEFT JOIN b ON b.clip_id = o_custkey AND b.frame_no = o_orderkey GROUP BY 1, 2)
        SELECT c_custkey AS clip_id, round(coalesce(avg(t), 0), 6) AS avg_subjects, round(coalesce(avg(w), 0), 6) AS avg_warm,
          round(coalesce(avg(c), 0), 6) AS avg_cool FROM customer LEFT JOIN f ON o_custkey = c_custkey GROUP BY 1""",
    "subjects": f"""WITH {DETECTIONS}, b AS (SELECT clip_id, frame_no, {FIXED_BUCKET.format(c='lower(label)')} AS b FROM det),
        f AS (SELECT o_custkey, o_orderkey, count(b) AS t, count(*) FILTER (WHERE b = 'humans') AS h,
                count(*) FILTER (WHERE b = 'animals') AS a, count(*) FILTER (WHERE b = 'others') AS o
              FROM orders LEFT JOIN b ON b.clip_id = o_custkey AND b.frame_no = o_orderkey GROUP BY 1, 2),
        m AS (SELECT o_custkey, avg(t) AS t, avg(h) AS h, avg(a) AS a FROM f GROUP BY 1)
        SELECT c_custkey AS clip_id, round(coalesce(m.t, 0), 6) AS avg_subjects, round(coalesce(m.h, 0), 6) AS avg_humans,
          round(coalesce(m.a, 0), 6) AS avg_animals, o_orderkey::INT AS frame_no, f.t::INT AS raw_total, f.o::INT AS others, f.t::INT AS total
        FROM customer LEFT JOIN m ON m.o_custkey = c_custkey LEFT JOIN f ON f.o_custkey = c_custkey""",
    "strip_pad": f"WITH {ANSWERS} SELECT frame_no, p_idx, md5(answer) AS answer FROM pa",
    "shot_categories": f"""WITH {ANSWERS}, r AS (SELECT clip_id, frame_no::INT AS frame_no,
            (row_number() OVER (PARTITION BY clip_id, frame_no ORDER BY p_idx) - 1)::INT AS pos, md5(answer) AS answer FROM pa)
        SELECT clip_id, frame_no, pos, answer FROM r
        UNION ALL SELECT c_custkey, NULL, NULL, NULL FROM customer WHERE c_custkey NOT IN (SELECT clip_id FROM r)""",
    "vision_reward": f"""WITH q AS (SELECT * FROM (VALUES {QUESTION_ROWS}) AS q(q_idx, question, weight)),
        n AS (SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS k FROM events),
        a AS (SELECT user_id || '-' || (k // 26) AS clip_id, event_type, k % 26 + 3 AS q_idx FROM n),
        v AS (SELECT clip_id, q_idx, weight, CASE WHEN event_type = 'click' THEN 1 ELSE -1 END AS sign FROM a JOIN q USING (q_idx))
        SELECT clip_id, round(avg(sign * weight), 9) AS avg_vision_reward, string_agg(sign::VARCHAR, ',' ORDER BY q_idx) AS signs
        FROM v GROUP BY 1""",
    "run_summary": f"""WITH {RUN_LOG}, r AS (SELECT metric, count(*) FILTER (WHERE error IS NULL) AS processed,
            (max(finished) - min(started)) / 1e6::DOUBLE AS total_s, sum(finished - started)::DOUBLE / count(*) / 1e6 AS busy_s FROM lg GROUP BY 1)
        SELECT metric, processed, round(total_s, 6) AS total_s, round(processed / total_s, 6) AS items_per_s,
          round(total_s / processed, 6) AS s_per_item, round(processed / (total_s / busy_s), 6) AS speedup,
          round(processed / (total_s / busy_s) / 4 * 100, 6) AS efficiency_pct FROM r""",
    "checkpoint_windows": _WINDOWS,
    "checkpoint_windows_segmented": _WINDOWS,
    "error_summary": f"""WITH {RUN_LOG} SELECT seq, video_id, left(error, 100) AS message,
          (SELECT count(*) FROM lg WHERE error IS NOT NULL) AS n_errors
        FROM lg WHERE error IS NOT NULL ORDER BY seq LIMIT 5""",
    "metric_timing": f"""WITH {RUN_LOG}, t AS (SELECT metric, (max(finished) - min(started)) / 1e6::DOUBLE AS seconds FROM lg GROUP BY 1)
        SELECT metric, round(seconds, 6) AS seconds, round((SELECT avg(seconds) FROM t), 6) AS mean_seconds FROM t""",
    "resumed_run": """WITH m AS (SELECT user_id, avg(value) AS m FROM events GROUP BY 1)
        SELECT c_custkey AS video_id, round(coalesce(m, 'NaN'::DOUBLE), 6) AS avg_aesthetic_score,
          CASE WHEN c_custkey % 2 = 0 THEN 'run-1' ELSE 'run-2' END AS run_id
        FROM customer LEFT JOIN m ON user_id = c_custkey""",
    "resumed_chunks": """WITH c AS (SELECT c_custkey, ((row_number() OVER (ORDER BY c_custkey) - 1) // ((SELECT count(*) FROM customer) // 5 + 1))::INT AS chunk_no FROM customer),
        m AS (SELECT user_id, avg(value) AS m, count(*) AS n FROM events GROUP BY 1)
        SELECT c_custkey AS video_id, chunk_no, round(coalesce(m, 'NaN'::DOUBLE), 6) AS score, coalesce(n, 0)::BIGINT AS n_scored
        FROM c LEFT JOIN m ON user_id = c_custkey""",
    "score_stream_seen": "SELECT event_id AS video_id, round(value * 2 + 1, 6) AS score, 1::BIGINT AS times FROM events",
    "stream_dedupe_batches": "SELECT event_id AS video_id FROM events",
    "score_stream": "SELECT event_id AS video_id, round(value * 2 + 1, 6) AS score FROM events",
    "stream_throughput": "SELECT epoch_us(date_trunc('day', ts)) AS window_us, count(*) AS items FROM events GROUP BY 1",
    "stream_running_mean": "SELECT user_id AS clip_id, count(*) AS n, round(avg(value), 6) AS mean_score FROM events GROUP BY 1",
    "stream_dedupe": "SELECT DISTINCT user_id AS video_id FROM events",
}
ORACLES["stored_crop"] = ORACLES["apply_crop"]
for _name in ("stream_mean_state", "stream_mean_windows"):
    ORACLES[_name] = "SELECT user_id AS clip_id, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1"
ORACLES["stream_throughput_batches"] = ORACLES["stream_throughput"]
