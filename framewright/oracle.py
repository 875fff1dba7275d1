"""The registered queries in SQL for DuckDB."""

from .file_oracle import FILE_SQL

_FRAMES = "SELECT user_id, event_id, ts, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS i FROM events"
_DOCS = "SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS pos, count(*) OVER () AS total FROM documents"
_VECS = "SELECT vec_id, label, embedding::DOUBLE[] AS x, row_number() OVER (ORDER BY vec_id) - 1 AS pos FROM embeddings"
_PIX = f"SELECT vec_id, label, pos, unnest(x) AS v, generate_subscripts(x, 1) - 1 AS p FROM ({_VECS})"
_BYTES = f"SELECT vec_id, pos, p, greatest(0, least(255, floor((v + 1) * 127.5)))::INT AS q FROM ({_PIX})"


def _windows(stride: int, size: int, rate: float, source: str, video: str) -> str:
    return f"""
    SELECT {video}, j // {size} AS idx_in_vid, (max(j) * {stride} - {size * stride})::BIGINT AS start_frame, (max(j) * {stride})::BIGINT AS end_frame,
           (max(j) * {stride} - {size * stride})::DOUBLE / {rate} AS start_ts, (max(j) * {stride})::DOUBLE / {rate} AS end_ts
    FROM (SELECT *, i // {stride} AS j FROM ({source}) WHERE i % {stride} = 0) GROUP BY {video}, j // {size} HAVING count(*) = {size}"""


def _resize(step_y: str, step_x: str) -> str:
    return f"""
    WITH o AS (SELECT y * 7 + x AS p, {step_y} AS fy, {step_x} AS fx FROM range(5) t(y), range(7) u(x)),
     g AS (SELECT p, least(floor(fy), 7)::INT AS y0, least(floor(fx), 7)::INT AS x0, least(floor(fy) + 1, 7)::INT AS y1, least(floor(fx) + 1, 7)::INT AS x1,
                  fy - least(floor(fy), 7) AS dy, fx - least(floor(fx), 7) AS dx FROM o)
    SELECT vec_id, p::BIGINT AS p, round((x[y0 * 8 + x0 + 1] * (1 - dx) + x[y0 * 8 + x1 + 1] * dx) * (1 - dy)
           + (x[y1 * 8 + x0 + 1] * (1 - dx) + x[y1 * 8 + x1 + 1] * dx) * dy, 6) AS v
    FROM ({_VECS}), g"""


def _batch(size: int, low: str, high: str) -> str:
    return f"""
    WITH b AS (SELECT vec_id, p, pos // {size} AS b, (v - 100.0::DOUBLE) / 100.0::DOUBLE AS v FROM ({_PIX})),
     r AS (SELECT b, {low} AS lo, {high} AS hi FROM b GROUP BY b)
    SELECT vec_id, p::BIGINT AS p, CASE WHEN hi > lo THEN floor((v - lo) / (hi - lo) * 255)::BIGINT ELSE 0 END AS v FROM b JOIN r USING (b)"""


def _t12(source: str) -> str:
    """Depth bytes of (vec_id, p, v)."""
    return f"""
    WITH x AS ({source}), m AS (SELECT vec_id, median(v) AS med FROM x GROUP BY vec_id),
     s AS (SELECT vec_id, any_value(med) AS med, sum(abs(v - med) ORDER BY p) / count(*) AS mad FROM x JOIN m USING (vec_id) GROUP BY vec_id),
     d AS (SELECT vec_id, p, CASE WHEN mad > 0 THEN (v - med) / mad ELSE 0 END AS d FROM x JOIN s USING (vec_id)),
     r AS (SELECT vec_id, min(d) AS lo, max(d) AS hi FROM d GROUP BY vec_id)
    SELECT vec_id, p::BIGINT AS p, floor((d - lo) / (hi - lo + 1e-8::DOUBLE) * 255)::BIGINT AS v FROM d JOIN r USING (vec_id)"""


def _bf(x: str) -> str:
    """Eight significant bits."""
    return f"CASE WHEN {x} = 0 THEN 0::DOUBLE ELSE round_even(({x}) * pow(2::DOUBLE, 7 - floor(log2(abs({x})))), 0) / pow(2::DOUBLE, 7 - floor(log2(abs({x})))) END"


_STEPS = f"SELECT *, {_bf('a * 2 - 1')} AS b FROM (SELECT *, {_bf('q / 255.0::DOUBLE')} AS a FROM ({_BYTES}))"
_FLOATS = f"SELECT *, (((q / 255.0::DOUBLE)::FLOAT::DOUBLE * 2)::FLOAT::DOUBLE - 1)::FLOAT::DOUBLE AS v FROM ({_BYTES})"
_LABELLED = "SELECT doc_id FROM labels WHERE quality IS NOT NULL"


def _source(at: str, size: str) -> str:
    return f"(({at} + 0.5::DOUBLE) * ({size}) - 0.5)::FLOAT"


SQL: dict[str, str] = {
    "stride_filter": f"SELECT user_id, event_id, i, i // 3 AS j FROM ({_FRAMES}) WHERE i % 3 = 0",
    "skip_filter": f"SELECT user_id, event_id, i, i // 4 AS j FROM ({_FRAMES}) WHERE i % 4 = 0",
    "seeded_offset": """
    SELECT conv_id, turn AS i, turn - o AS k
    FROM (SELECT conv_id, turn, concat('0x', substr(md5('7:' || conv_id), 1, 8))::BIGINT % 5 AS o FROM conversations) WHERE turn >= o""",
    "chunk_keep_tail": f"""
    SELECT user_id, i // 16 AS chunk, count(*) AS n_frames, min(i) AS first_frame, max(i) AS last_frame
    FROM ({_FRAMES}) GROUP BY user_id, i // 16""",
    "window_drop_tail": _windows(2, 4, 15, _FRAMES, "user_id"),
    "window_conversations": _windows(1, 2, 30, "SELECT conv_id, turn AS i FROM conversations", "conv_id"),
    "window_true_times": _windows(2, 4, 30, _FRAMES, "user_id"),
    "frame_address": """
    SELECT event_id, printf('%06d', g // 1000) AS subdir, printf('%04d.jpg', g % 1000) AS name
    FROM (SELECT event_id, row_number() OVER (ORDER BY user_id, event_id) - 1 AS g FROM events)""",
    "ordered_collect": f"""
    SELECT user_id, i // 16 AS chunk, string_agg(event_id::VARCHAR, ',' ORDER BY i) AS events FROM ({_FRAMES}) GROUP BY user_id, i // 16""",
    "window_ordinal": f"SELECT event_id, i // 16 AS idx_in_vid, i % 16 AS slot FROM ({_FRAMES})",
    "balanced_split": "SELECT doc_id, ntile(7) OVER (ORDER BY doc_id) - 1 AS shard FROM documents",
    "ceil_shard": f"SELECT doc_id, floor(pos / ceil(total / 7.0))::BIGINT AS shard FROM ({_DOCS})",
    "two_level_shard": """
    SELECT doc_id, node, ntile(4) OVER (PARTITION BY node ORDER BY doc_id) - 1 AS worker
    FROM (SELECT doc_id, ntile(3) OVER (ORDER BY doc_id) - 1 AS node FROM documents)""",
    "round_robin": f"SELECT doc_id, pos % 8 AS worker FROM ({_DOCS})",
    "seeded_shuffle": "SELECT doc_id, row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id) - 1 AS pos FROM documents",
    "block_shuffle": f"SELECT doc_id, pos, row_number() OVER (ORDER BY pos // 64, md5('42:' || doc_id), doc_id) - 1 AS shuffled FROM ({_DOCS})",
    "random_draws": f"""
    SELECT draw, doc_id FROM (
      SELECT d AS draw, concat('0x', substr(md5('42:' || d), 1, 8))::BIGINT % (SELECT count(*) FROM documents) AS pos FROM range(500) t(d))
    JOIN ({_DOCS}) USING (pos)""",
    "first_batches": f"SELECT doc_id, pos // 32 AS batch_id FROM ({_DOCS}) WHERE pos < 352",
    "pair_join": "SELECT doc_id, source, quality, toxic FROM documents JOIN labels USING (doc_id)",
    "sibling_exists": "SELECT doc_id, source FROM documents d WHERE EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)",
    "anti_skip": "SELECT doc_id, source FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)",
    "triple_todo": """
    SELECT doc_id, source, quality, toxic FROM documents JOIN labels USING (doc_id)
    WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 1)""",
    "folder_skip": """
    SELECT source, count(*) AS n_docs FROM documents
    WHERE source NOT IN (SELECT source FROM documents JOIN labels USING (doc_id) WHERE quality = 0) GROUP BY source""",
    "fan_in": "SELECT event_id, event_type, event_id % 3 AS worker FROM events",
    "tar_address": """
    WITH a AS (SELECT doc_id, ntile(4) OVER (ORDER BY md5('42:' || doc_id), doc_id) - 1 AS rank FROM documents JOIN labels USING (doc_id)),
     b AS (SELECT doc_id, rank, row_number() OVER (PARTITION BY rank ORDER BY md5('7:' || doc_id), doc_id) - 1 AS p FROM a)
    SELECT doc_id, rank, p // 10 // 4 AS subdir, p // 10 % 4 AS tar, p % 10 AS member,
           printf('%01d/%04d/%04d.tar', rank, p // 10 // 4, p // 10 % 4) AS key FROM b""",
    "running_total": "SELECT event_id, count(*) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS running FROM events",
    "interval_rate": """
    SELECT day::VARCHAR AS day, n, n - lag(n) OVER (ORDER BY day) AS delta, round((n - lag(n) OVER (ORDER BY day)) / 86400.0::DOUBLE, 9) AS per_second
    FROM (SELECT ts::DATE AS day, count(*) AS n FROM events GROUP BY 1)""",
    "count_suffix": """
    SELECT count(*) FILTER (WHERE p LIKE '%.jpg' OR p LIKE '%.jpeg') AS n_images,
           count(*) FILTER (WHERE (p LIKE '%.jpg' OR p LIKE '%.jpeg') AND p NOT LIKE '%.depth.jpg') AS n_rgb
    FROM (SELECT lower(url || CASE page_id % 3 WHEN 0 THEN '.JPG' WHEN 1 THEN '.depth.jpg' ELSE '' END) AS p FROM pages)""",
    "throughput": """
    SELECT event_type, n, CASE WHEN us > 0 THEN round(n / (us / 1e6::DOUBLE), 9) END AS per_second, CASE WHEN us > 0 THEN round(n * 8 / (us / 1e6::DOUBLE), 9) END AS estimated
    FROM (SELECT event_type, count(*) AS n, epoch_us(max(ts)) - epoch_us(min(ts)) AS us FROM events GROUP BY 1)""",
    "path_parts": r"""
    SELECT page_id, base, dir, stem, stem || '.depth.jpg' AS depth_path, replace(url, '.html', '_depth.pt') AS swapped
    FROM (SELECT page_id, url, list_last(string_split(url, '/')) AS base, regexp_extract(url, '^(.*)/[^/]*$', 1, 's') AS dir,
                 CASE WHEN regexp_matches(url, '[^/.]\.[^./]*$') THEN regexp_replace(url, '\.[^./]*$', '') ELSE url END AS stem FROM pages)""",
    "suffix_filter": "SELECT page_id, url FROM pages WHERE lower(url) LIKE '%.html' AND lower(url) NOT LIKE '%.depth.jpg'",
    "digit_folder": r"""
    SELECT page_id, name::BIGINT AS number
    FROM (SELECT page_id, list_last(string_split(regexp_extract(url, '^([^?#]*)', 1), '/')) AS name FROM pages)
    WHERE regexp_full_match(name, '[0-9]+') AND TRY_CAST(name AS BIGINT) BETWEEN 0 AND 999""",
    "padded_name": "SELECT doc_id, printf('%06d', doc_id) AS name, printf('%08d_rgb', doc_id) AS chunk_name FROM documents",
    "depth_normalise": _t12(f"SELECT vec_id, p, v FROM ({_PIX})"),
    "batch_normalise": _batch(32, "min(v)", "max(v)"),
    "batch_normalise_padded": _batch(48, "CASE WHEN count(*) < 48 * 64 THEN least(min(v), -1) ELSE min(v) END", "CASE WHEN count(*) < 48 * 64 THEN greatest(max(v), -1) ELSE max(v) END"),
    "collate": f"""
    SELECT vec_id, pos // 32 AS batch_id, pos % 32 AS row_in_batch, (p % 4 * 16 + p // 4)::BIGINT AS p, round(q / 255.0::DOUBLE * 2 - 1, 9) AS v FROM ({_BYTES})""",
    "permute": f"SELECT vec_id, (p % 4 * 16 + p // 4)::BIGINT AS p, v FROM ({_PIX})",
    "flip_channels": f"SELECT vec_id, (p - p % 3 + 2 - p % 3)::BIGINT AS p, v FROM ({_PIX}) WHERE p < 48",
    "channel_concat": f"SELECT vec_id, p::BIGINT AS p, round(q / 255.0::DOUBLE * 2 - 1, 9) AS v FROM ({_BYTES})",
    "standardise": f"""
    SELECT vec_id, p::BIGINT AS p, round((((q / 255.0::DOUBLE * 2 - 1) + 1) / 2 - [0.485, 0.456, 0.406][p // 16 + 1]::DOUBLE) / [0.229, 0.224, 0.225][p // 16 + 1]::DOUBLE, 9) AS v
    FROM ({_BYTES}) WHERE p < 48""",
    "centre_crop": f"SELECT vec_id, (p - 16)::BIGINT AS p, v FROM ({_PIX}) WHERE p BETWEEN 16 AND 47",
    "resize_half": _resize("greatest(0.0::DOUBLE, (y + 0.5::DOUBLE) * (8 / 5.0::DOUBLE) - 0.5)", "greatest(0.0::DOUBLE, (x + 0.5::DOUBLE) * (8 / 7.0::DOUBLE) - 0.5)"),
    "resize_corners": _resize("y * (7 / 4.0::DOUBLE)", "x * (7 / 6.0::DOUBLE)"),
    "tensor_stats": f"SELECT label, min(v) AS low, max(v) AS high, round(avg(v), 9) AS mean, count(*) AS n_values FROM ({_PIX}) GROUP BY label",
    "padded_batch": f"SELECT pos // 128 AS batch_id, count(*) AS n_rows, 128 - count(*) AS n_pad FROM ({_VECS}) GROUP BY 1",
    "encode_batches": f"""
    SELECT vec_id, (p // 8 // 4 * 2 + p % 8 // 4)::BIGINT AS p, round(avg(v)::FLOAT::DOUBLE, 4) + 0::DOUBLE AS v FROM ({_PIX}) GROUP BY vec_id, p // 8 // 4 * 2 + p % 8 // 4""",
    "depth_batches": f"SELECT vec_id, (p % 16)::BIGINT AS p, round(avg(v)::FLOAT::DOUBLE, 4) + 0::DOUBLE AS v FROM ({_PIX}) GROUP BY vec_id, p % 16",
    "stream_windows": f"""
    SELECT user_id, i // 16 AS idx_in_vid, min_by(event_id, i) AS first_event, max_by(event_id, i) AS last_event, count(*) AS n_frames
    FROM ({_FRAMES}) GROUP BY user_id, i // 16 HAVING count(*) = 16""",
    "stream_counts": "SELECT event_type, count(*) AS n FROM events GROUP BY event_type",
    "stream_encode": f"""
    SELECT vec_id, (p // 8 // 4 * 2 + p % 8 // 4)::BIGINT AS p, round(avg(v)::FLOAT::DOUBLE, 4) + 0::DOUBLE AS v FROM ({_PIX}) GROUP BY vec_id, p // 8 // 4 * 2 + p % 8 // 4""",
    "window_offset": f"""
    SELECT user_id, k // 4 AS idx_in_vid, (max(j) * 2 - 8)::BIGINT AS start_frame, (max(j) * 2)::BIGINT AS end_frame,
           (max(j) * 2 - 8)::DOUBLE / 15 AS start_ts, (max(j) * 2)::DOUBLE / 15 AS end_ts
    FROM (SELECT *, j - concat('0x', substr(md5('7:' || user_id), 1, 8))::BIGINT % 5 AS k FROM (SELECT user_id, i // 2 AS j FROM ({_FRAMES}) WHERE i % 2 = 0))
    WHERE k >= 0 GROUP BY user_id, k // 4 HAVING count(*) = 4""",
    "positional_zip": f"""
    SELECT pos, doc_id, label_id FROM ({_DOCS}) JOIN (SELECT doc_id AS label_id, row_number() OVER (ORDER BY doc_id DESC) - 1 AS pos FROM labels) USING (pos)""",
    "competing_consumers": "SELECT event_id, 1 AS deliveries, 1 AS known FROM events",
    "clamped_workers": "SELECT source, least(40, count(*)) AS workers FROM documents GROUP BY source",
    "throughput_at_once": """
    SELECT user_id, CASE WHEN us > 0 THEN round(n / (us / 1e6::DOUBLE), 9) ELSE 'inf'::DOUBLE END AS per_second,
           CASE WHEN us > 0 THEN round(n / (us / 1e6::DOUBLE), 9) ELSE 0 END AS guarded
    FROM (SELECT user_id, count(*) AS n, epoch_us(max(ts)) - epoch_us(min(ts)) AS us FROM events GROUP BY 1)""",
    "average_fps": """
    SELECT user_id, CASE WHEN us > 0 THEN round((n - 1) / (us / 1e6::DOUBLE), 9) END AS fps
    FROM (SELECT user_id, count(*) AS n, epoch_us(max(ts)) - epoch_us(min(ts)) AS us FROM events GROUP BY 1)""",
    "suffix_case": "SELECT page_id, url FROM pages WHERE page_id % 2 <> 0 AND url LIKE '%.html'",
    "resize_antialias": f"""
    WITH w AS (SELECT size, o, i, greatest(0, 1 - abs((i + 0.5::DOUBLE - (o + 0.5::DOUBLE) * 8 / size) / (8 / size::DOUBLE))) AS w
               FROM (VALUES (5), (3)) s(size), range(5) t(o), range(8) u(i) WHERE o < size),
     n AS (SELECT size, o, i, w / sum(w) OVER (PARTITION BY size, o) AS w FROM w)
    SELECT vec_id, (y.o * 3 + x.o)::BIGINT AS p, round(sum(y.w * x.w * v), 6) + 0::DOUBLE AS v
    FROM ({_PIX}) px JOIN n y ON y.size = 5 AND y.i = px.p // 8 JOIN n x ON x.size = 3 AND x.i = px.p % 8 GROUP BY vec_id, y.o, x.o""",
    "resize_fixed": f"""
    WITH s AS (SELECT 'y' AS d, o, {_source("o", "8 / 5.0::DOUBLE")} AS place FROM range(5) t(o) UNION ALL SELECT 'x', o, {_source("o", "8 / 7.0::DOUBLE")} FROM range(7) t(o)),
     w AS (SELECT d, o, floor(place)::INT AS low, CASE WHEN floor(place) < 0 OR floor(place) >= 7 THEN 0 ELSE (place - floor(place))::FLOAT::DOUBLE END AS part FROM s),
     c AS (SELECT d, o, greatest(0, least(7, low)) AS i0, least(greatest(0, least(7, low)) + 1, 7) AS i1,
                  round_even((1 - part) * 2048, 0)::BIGINT AS w0, round_even(part * 2048, 0)::BIGINT AS w1 FROM w),
     b AS (SELECT vec_id, list(q::BIGINT ORDER BY p) AS q FROM ({_BYTES}) GROUP BY vec_id),
     l AS (SELECT vec_id, y.o AS oy, x.o AS ox, y.w0, y.w1, (q[y.i0 * 8 + x.i0 + 1] * x.w0 + q[y.i0 * 8 + x.i1 + 1] * x.w1) // 16 AS top,
                  (q[y.i1 * 8 + x.i0 + 1] * x.w0 + q[y.i1 * 8 + x.i1 + 1] * x.w1) // 16 AS low FROM b, c y, c x WHERE y.d = 'y' AND x.d = 'x')
    SELECT vec_id, (oy * 7 + ox)::BIGINT AS p, ((w0 * top) // 65536 + (w1 * low) // 65536 + 2) // 4 AS v FROM l""",
    "channel_axis": "SELECT vec_id, '1x8x8' AS shape, len(embedding) AS n FROM embeddings",
    "bfloat16_cast": f"SELECT vec_id, p::BIGINT AS p, {_bf('v')} AS v FROM ({_PIX})",
    "unit_range_float": f"SELECT vec_id, p::BIGINT AS p, round(v, 9) AS v FROM ({_FLOATS})",
    "unit_range_bfloat16": f"SELECT vec_id, p::BIGINT AS p, round(b, 9) AS v FROM ({_STEPS})",
    "preprocess_rgbd": f"SELECT vec_id, p::BIGINT AS p, round({_bf('v')}, 9) AS v FROM ({_FLOATS})",
    "aligned_concat": f"""
    SELECT vec_id, p::BIGINT AS p, v FROM ({_PIX}) JOIN (SELECT vec_id, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS i FROM embeddings) USING (vec_id) WHERE i % 3 > 0""",
    "collate_metadata": f"""
    SELECT pos // 32 AS batch_id, count(DISTINCT pos) AS n, string_agg(vec_id::VARCHAR, ',' ORDER BY pos) FILTER (WHERE p = 0) AS ids,
           string_agg(label::VARCHAR, ',' ORDER BY pos) FILTER (WHERE p = 0) AS labels,
           round(arg_min(q, pos) FILTER (WHERE p = 0) / 255.0::DOUBLE * 2 - 1, 9) AS first, round(arg_max(q, pos) FILTER (WHERE p = 63) / 255.0::DOUBLE * 2 - 1, 9) AS last
    FROM ({_BYTES}) JOIN (SELECT vec_id, label FROM embeddings) USING (vec_id) GROUP BY pos // 32""",
    "depth_single": _t12(f"SELECT vec_id, p, ((x[p + 1] + x[p + 17] + x[p + 33] + x[p + 49]) / 4)::FLOAT::DOUBLE AS v FROM ({_VECS}), range(16) t(p)"),
    # over files
    "image_read": f"""
    SELECT vec_id, CASE WHEN good THEN 4 END AS height, CASE WHEN good THEN 4 END AS width, CASE WHEN good THEN 3 END AS channels,
           CASE WHEN good THEN total END AS total, CASE WHEN good THEN blue END AS blue, CASE WHEN NOT good THEN 'unreadable' END AS error
    FROM (SELECT vec_id, vec_id % 9 > 0 AS good, sum(q)::BIGINT AS total, any_value(q) FILTER (WHERE p = 2)::BIGINT AS blue FROM ({_BYTES}) WHERE p < 48 GROUP BY vec_id)""",
    "array_read": f"SELECT vec_id, '4x16' AS shape, 'float64' AS dtype, x[1] AS first, x[64] AS last FROM ({_VECS})",
    "depth_tensor_job": f"""
    WITH d AS (
      SELECT vec_id, pos, p, ((((a / 255.0::DOUBLE)::FLOAT::DOUBLE - 0.485::DOUBLE) / 0.229::DOUBLE + ((b / 255.0::DOUBLE)::FLOAT::DOUBLE - 0.456::DOUBLE) / 0.224::DOUBLE
             + ((c / 255.0::DOUBLE)::FLOAT::DOUBLE - 0.406::DOUBLE) / 0.225::DOUBLE) / 3)::FLOAT::DOUBLE AS v
      FROM (SELECT vec_id, pos, p % 16 AS p, any_value(q) FILTER (WHERE p < 16) AS a, any_value(q) FILTER (WHERE p BETWEEN 16 AND 31) AS b, any_value(q) FILTER (WHERE p BETWEEN 32 AND 47) AS c
            FROM ({_BYTES}) GROUP BY vec_id, pos, p % 16)),
     b AS (SELECT vec_id, p, pos // 32 AS b, (v - 100.0::DOUBLE) / 100.0::DOUBLE AS v FROM d), r AS (SELECT b, min(v) AS lo, max(v) AS hi FROM b GROUP BY b)
    SELECT vec_id, p::BIGINT AS p, CASE WHEN hi > lo THEN floor((v - lo) / (hi - lo) * 255)::BIGINT ELSE 0 END AS v FROM b JOIN r USING (b)""",
    "depth_latent_job": f"""
    SELECT vec_id, (p % 16 // 4 // 2 * 2 + p % 4 // 2)::BIGINT AS p, round(avg(b)::FLOAT::DOUBLE, 4) + 0::DOUBLE AS v
    FROM (SELECT *, {_bf('v')} AS b FROM ({_FLOATS})) WHERE vec_id % 5 <> 0 GROUP BY vec_id, p % 16 // 4 // 2 * 2 + p % 4 // 2""",
    "weights_model": f"SELECT vec_id, j::BIGINT AS p, round(sum(q * (p % 3 + j))::DOUBLE, 2) AS v FROM ({_BYTES}), range(2) t(j) GROUP BY vec_id, j",
    "resource_task": "SELECT vec_id, 64 AS n FROM embeddings",
    "payload_projection": f"SELECT vec_id, label, 64 AS n, x[1] AS first FROM ({_VECS})",
    "stream_shuffle": f"""
    SELECT user_id, b * 8 + row_number() OVER (PARTITION BY user_id, b ORDER BY md5('42:' || event_id), event_id) - 1 AS pos, event_id
    FROM (SELECT *, i // 8 AS b, count(*) OVER (PARTITION BY user_id, i // 8) AS c FROM ({_FRAMES})) WHERE c = 8""",
    "stream_progress": 'SELECT count(*) AS "rows" FROM events',
    "indexed_listing": f"""
    SELECT doc_id % 3 AS top, printf('%06d', doc_id // 50) AS subdir, doc_id % 50 * 30 AS number FROM documents
    WHERE doc_id % 50 * 30 < 1000 AND doc_id NOT IN ({_LABELLED})""",
    "tensor_listing": f"SELECT printf('%08d_rgb.pt', doc_id) AS rgb, printf('%08d_depth.pt', doc_id) AS result FROM documents WHERE doc_id NOT IN ({_LABELLED})",
    "latent_listing": """
    SELECT printf('%08d_rgb.pt', doc_id) AS rgb, printf('%08d_depth.pt', doc_id) AS other, printf('%08d_depthlatent.pt', doc_id) AS result FROM labels WHERE quality <> 1""",
    "pair_listing": f"""
    SELECT doc_id || CASE WHEN doc_id % 2 = 0 THEN '.JPG' ELSE '.jpg' END AS rgb_path, doc_id || '.depth.jpg' AS depth_path FROM documents WHERE doc_id IN ({_LABELLED})""",
    "tar_members": """
    SELECT printf('%04d.tar', doc_id // 7) AS archive, printf('%04d.txt', doc_id % 7) AS member, sha256(coalesce(text, '')) AS sha256 FROM documents""",
    "tar_job": f"""
    SELECT printf('%d/%04d/%04d.tar', rank, p // 5 // 3, p // 5 % 3) AS archive, count(*) AS n_rgb, count(*) AS n_depth
    FROM (SELECT rank, row_number() OVER (PARTITION BY rank) - 1 AS p FROM (SELECT ntile(2) OVER (ORDER BY doc_id) - 1 AS rank FROM ({_LABELLED}))) GROUP BY 1""",
    "image_watch": """
    SELECT 0 AS poll, count(*) FILTER (WHERE doc_id % 2 = 0) AS n_images, 0 AS more FROM documents
    UNION ALL SELECT 1, count(*), count(*) FILTER (WHERE doc_id % 2 = 1) FROM documents""",
}
SQL |= FILE_SQL
SQL["latent_stream"] = SQL["latent_stream"].format(a=_bf("q / 255.0::DOUBLE"), b=_bf("a * 2 - 1"))
SQL["depth_image_job"] = f"""
    SELECT vec_id AS conv_id, 4 AS height, 4 AS width, 1 AS channels, sum(v)::BIGINT AS total
    FROM ({_t12(SQL["depth_image_job"])}) GROUP BY vec_id"""
