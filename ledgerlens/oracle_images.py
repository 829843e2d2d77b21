"""DuckDB SQL for the image queries: pixels, resizing, normalisation and Otsu's threshold from the embeddings table."""

from __future__ import annotations

from .oracle_views import with_

SQL: dict[str, str] = {}

# Levels of the components (p), of embeddings with 64 finite components that have a file.
PICTURES = """pictures AS (
  SELECT vec_id, 'vec-' || CAST(vec_id AS VARCHAR) || '.png' AS file_name, vec_id % 97 = 3 AS corrupt,
    list_transform(embedding, lambda x: CAST(least(255, greatest(0, floor(128 + 200 * CAST(x AS DOUBLE)))) AS INTEGER)) AS p
  FROM embeddings WHERE len(embedding) = 64 AND vec_id % 89 <> 5
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)"""

SQL["a4_scan_images"] = with_(PICTURES) + """SELECT file_name, CAST(if(corrupt, 134, 268) AS BIGINT) AS length, TRUE AS all_read,
  file_name AS last_of_path, CASE WHEN NOT corrupt THEN sha256(unhex(array_to_string(list_transform(range(8), lambda y:
    '00' || array_to_string(list_transform(range(8 * y, 8 * y + 8), lambda j: format('{:02x}{:02x}{:02x}',
      p[j + 1], p[(j + 21) % 64 + 1], p[(j + 42) % 64 + 1])), '')), ''))) END AS lines_sha256
FROM pictures"""

# Values of the 6 x 6 pictures in single precision: red, green, blue planes, line by line.
VALUES = """resized AS (
  SELECT vec_id, file_name, corrupt, CAST(i AS INTEGER) AS entry, i // 36 AS c,
    p[(least(7, CAST(floor((i % 36 // 6) * 8 / 6.0) AS INTEGER)) * 8 + least(7, CAST(floor((i % 6) * 8 / 6.0) AS INTEGER))
       + 21 * (i // 36)) % 64 + 1] AS level
  FROM pictures, range(108) t(i)),
pixel_values AS (
  SELECT vec_id, file_name, corrupt, entry, (CAST(level AS FLOAT) / CAST(255 AS FLOAT)
      - CAST(CASE c WHEN 0 THEN 0.485 WHEN 1 THEN 0.456 ELSE 0.406 END AS FLOAT))
      / CAST(CASE c WHEN 0 THEN 0.229 WHEN 1 THEN 0.224 ELSE 0.225 END AS FLOAT) AS value
  FROM resized)"""

SQL["l1_image_table"] = with_(PICTURES, VALUES) + """SELECT file_name, FALSE AS corrupt, 8 AS height, 8 AS width, entry,
  round(CAST(value AS DOUBLE), 5) AS value FROM pixel_values WHERE NOT corrupt
UNION ALL SELECT file_name, TRUE, NULL, NULL, NULL, NULL FROM pictures WHERE corrupt"""

SQL["l2_image_quality"] = with_(PICTURES, """gray AS (
  SELECT file_name, (4899 * p[j + 1] + 9617 * p[(j + 21) % 64 + 1] + 1868 * p[(j + 42) % 64 + 1] + 8192) >> 14 AS bin
  FROM pictures, range(64) t(j) WHERE NOT corrupt)""", """hist AS (
  SELECT f.file_name, b.bin, count(g.bin) AS n FROM pictures f CROSS JOIN range(256) b(bin)
  LEFT JOIN gray g ON g.file_name = f.file_name AND g.bin = b.bin WHERE NOT f.corrupt GROUP BY f.file_name, b.bin)""", """cum AS (
  SELECT file_name, bin, CAST(sum(n) OVER w AS DOUBLE) AS w0, CAST(sum(bin * n) OVER w AS DOUBLE) AS s0,
    CAST(sum(n) OVER a AS DOUBLE) AS n, CAST(sum(bin * n) OVER a AS DOUBLE) AS s
  FROM hist WINDOW w AS (PARTITION BY file_name ORDER BY bin), a AS (PARTITION BY file_name))""", """spread AS (
  SELECT file_name, bin, w0, n, CASE WHEN w0 > 0 AND n - w0 > 0
    THEN (w0 / n) * ((n - w0) / n) * (s0 / w0 - (s - s0) / (n - w0)) * (s0 / w0 - (s - s0) / (n - w0)) ELSE 0.0 END AS var
  FROM cum)""") + """SELECT file_name, CAST(bin AS INTEGER) AS threshold, CAST(n AS BIGINT) AS n_pixels,
  round(w0 / n, 6) AS dark_share, FALSE AS corrupt FROM spread
QUALIFY row_number() OVER (PARTITION BY file_name ORDER BY var DESC, bin) = 1
UNION ALL SELECT file_name, NULL, NULL, NULL, TRUE FROM pictures WHERE corrupt"""

SQL["e2_attach_images"] = with_(PICTURES, VALUES, """totals AS (
  SELECT vec_id, sum(CAST(value AS DOUBLE)) AS total FROM pixel_values WHERE NOT corrupt GROUP BY vec_id)""") + """SELECT e.vec_id,
  e.label, CASE WHEN f.vec_id IS NULL THEN 'missing' WHEN f.corrupt THEN 'corrupt' ELSE 'found' END AS image_state,
  t.vec_id IS NULL AS is_null, CAST(108 AS INTEGER) AS n_values, round(coalesce(t.total, 0.0), 4) AS total
FROM embeddings e LEFT JOIN pictures f ON f.vec_id = e.vec_id LEFT JOIN totals t ON t.vec_id = e.vec_id"""
