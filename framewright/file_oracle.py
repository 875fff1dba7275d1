"""SQL for the queries over trees of page files and of videos made from conversations."""

_VIDEOS = "SELECT conv_id, count(*) AS n FROM conversations GROUP BY conv_id"
_FRAMES = f"SELECT conv_id, n, unnest(range(n)) AS f FROM ({_VIDEOS})"
_PIXELS = f"SELECT conv_id, n, f, p, (conv_id * 7 + f * 13 + p * 5) % 256 AS q FROM ({_FRAMES}), range(48) t(p)"
_SUMS = f"SELECT conv_id, n, f, sum(q)::BIGINT AS total FROM ({_PIXELS}) GROUP BY ALL"
_VISIBLE = "SELECT page_id, url, 'a b/' || page_id || ['.mp4', '.MP4', '.txt'][page_id % 3 + 1] AS name, strlen(coalesce(url, '')) AS length FROM pages WHERE page_id % 7 <> 0"
_SEGMENT = "'Chunk_' || conv_id % 3 AS chunk, 'd' || conv_id % 4 AS drive, conv_id::VARCHAR AS segment"
_PLACED = f"SELECT conv_id, (n + 1) // 2 AS k, row_number() OVER (ORDER BY conv_id) - 1 AS pos, ntile(3) OVER (ORDER BY conv_id) - 1 AS w FROM ({_VIDEOS})"

FILE_SQL: dict[str, str] = {
    "list_videos": f"SELECT name, length FROM ({_VISIBLE}) WHERE page_id % 3 = 0",
    "list_videos_any_case": f"SELECT name, length FROM ({_VISIBLE}) WHERE page_id % 3 < 2",
    "walk_videos": """
    SELECT CASE WHEN page_id % 7 = 0 THEN '_hidden/' ELSE 'a b/' END || page_id || '.mp4' AS name, strlen(coalesce(url, '')) AS length FROM pages WHERE page_id % 3 = 0""",
    "sharded_listing": f"""
    SELECT name, node, ntile(2) OVER (PARTITION BY node ORDER BY name) - 1 AS worker
    FROM (SELECT name, ntile(3) OVER (ORDER BY name) - 1 AS node FROM ({_VISIBLE}) WHERE page_id % 3 = 0)""",
    "file_task": f"""
    SELECT name, CASE WHEN length % 5 <> 0 THEN length END AS n, CASE WHEN length % 5 <> 0 THEN substr(url, 1, 4) END AS head,
           CASE WHEN length % 5 = 0 THEN 'ValueError: five' END AS error FROM ({_VISIBLE})""",
    "dashcam_listing": f"SELECT {_SEGMENT} FROM ({_VIDEOS}) WHERE conv_id % 6 <> 5",
    "dashcam_chunks": f"SELECT {_SEGMENT}, f // 3 AS i, count(*) AS n_frames, count(*) * 18 AS bytes FROM ({_FRAMES}) WHERE conv_id % 6 <> 5 GROUP BY conv_id, f // 3",
    "zip_members": f"""
    SELECT 'Chunk_' || conv_id % 3 || '.zip' AS archive, 'd/' || conv_id || '.txt' AS member, 'content ' || conv_id AS content FROM ({_VIDEOS}) WHERE conv_id % 3 <> 2""",
    "decode_listing": f"""
    SELECT conv_id, f AS frame_idx, 4 AS height, 4 AS width, 3 AS channels, total, false AS failed FROM ({_SUMS}) WHERE conv_id % 5 <> 0 AND f % 2 = 0
    UNION ALL SELECT conv_id, NULL, NULL, NULL, NULL, NULL, true FROM ({_VIDEOS}) WHERE conv_id % 5 = 0""",
    "first_stream": f"SELECT conv_id, count(*) AS n_frames, sum(total)::BIGINT AS total FROM ({_SUMS}) GROUP BY conv_id",
    "image_tree": f"""
    SELECT w || '/' || printf('%06d/%04d.png', g // 5, g % 5) AS name
    FROM (SELECT w, first + unnest(range(k)) AS g FROM (SELECT w, k, (sum(k) OVER (PARTITION BY w ORDER BY pos) - k)::BIGINT AS first FROM ({_PLACED})))""",
    "image_tree_by_video": f"SELECT pos || '/' || printf('%06d/%04d.png', g // 2, g % 2) AS name FROM (SELECT pos, unnest(range(k)) AS g FROM ({_PLACED}))",
    "image_tree_flat": f"SELECT pos || '/' || printf('%06d.png', g) AS name FROM (SELECT pos, unnest(range(k)) AS g FROM ({_PLACED}))",
    "tensor_chunks": f"SELECT conv_id, f // 3 AS split_ind, f % 3 AS idx_in_split, total FROM ({_SUMS})",
    "window_stream": f"""
    SELECT conv_id, printf('%06d.mp4', conv_id) AS vid_name, f // 2 AS idx_in_vid, (f // 2 * 2 - 1)::BIGINT AS start_frame, (f // 2 * 2 + 1)::BIGINT AS end_frame,
           (f // 2 * 2 - 1)::DOUBLE / 30 AS start_ts, (f // 2 * 2 + 1)::DOUBLE / 30 AS end_ts, '2x4x4x3' AS shape, sum(total)::BIGINT AS total
    FROM ({_SUMS}) WHERE f // 2 < n // 2 GROUP BY conv_id, f // 2""",
    # {a} and {b} are the two rounded steps to -1..1
    "latent_stream": f"""
    SELECT conv_id, f // 2 AS idx_in_vid, f % 2 AS frame, (p // 12 // 2 * 2 + p // 3 % 4 // 2)::BIGINT AS p, round(avg(b)::FLOAT::DOUBLE, 4) + 0::DOUBLE AS v
    FROM (SELECT *, {{b}} AS b FROM (SELECT *, {{a}} AS a FROM ({_PIXELS}))) WHERE f // 2 < n // 2 GROUP BY conv_id, f, p // 12 // 2 * 2 + p // 3 % 4 // 2""",
    # the pixels whose depth bytes are summed
    "depth_image_job": f"""
    SELECT conv_id AS vec_id, p // 3 AS p, (sum(q ORDER BY p) / 3.0::DOUBLE)::FLOAT::DOUBLE AS v FROM ({_PIXELS}) WHERE f = 0 GROUP BY conv_id, p // 3""",
}
