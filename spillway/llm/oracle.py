"""DuckDB SQL for the queries that SQL can express (op5)."""

from __future__ import annotations

_URL = r"""
WITH parts AS (
  SELECT page_id,
    CASE WHEN strpos(url, '://') > 0 THEN translate(regexp_extract(substr(url, strpos(url, '://') + 3), '^[^/?#]*'),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END AS host,
    CASE WHEN strpos(url, '://') > 0 THEN regexp_extract(substr(url, strpos(url, '://') + 3), '^[^/?#]*([^?#]*)', 1) ELSE '' END AS path
  FROM pages),
rules(rhost, rpath, v) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
best AS (
  SELECT page_id, host, path, max({'n': length(rhost || rpath), 'rule': rhost || rpath, 'v': v})
    FILTER ((host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)) AS b
  FROM parts CROSS JOIN rules GROUP BY page_id, host, path)
SELECT page_id, host, path, b.rule AS rule, coalesce(b.v, 'allow') AS verdict FROM best
"""

SQL: dict[str, str] = {"op5_url_filter": _URL}
