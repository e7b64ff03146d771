"""DuckDB SQL for the registered queries, over views named like the tables."""

from __future__ import annotations

from catamill.functions import texts as T
from catamill.functions import urls as U


def _q(pattern: str) -> str:
    """A pattern as an SQL text."""
    return "'" + pattern.replace("'", "''") + "'"


def host(u: str) -> str:
    return f"regexp_replace(lower(regexp_extract({u}, '^[^:/?#]+://([^/?#]*)', 1)), '^www\\.', '')"


def path(u: str) -> str:
    return f"regexp_extract({u}, '^[^:/?#]+://[^/?#]*([^?#]*)', 1)"


def canonical(u: str) -> str:
    volatile = ", ".join(_q(v) for v in U.VOLATILE)
    kept = f"list_sort(list_filter(string_split(regexp_extract({u}, '^[^?#]*\\?([^#]*)', 1), '&'), lambda p: p <> '' AND NOT regexp_matches(p, {_q(U.TRACKING)}) AND NOT list_contains([{volatile}], lower(split_part(p, '=', 1)))))"
    at = f"CASE WHEN {path(u)} = '/' THEN '/' ELSE rtrim({path(u)}, '/') END"
    return f"'https://' || {host(u)} || {at} || CASE WHEN len({kept}) > 0 THEN '?' || array_to_string({kept}, '&') ELSE '' END"


def alike(pairs: str) -> str:
    """The pairs (m, n and more columns) with their token-set ratio by insertions and deletions, the longest common
    subsequence reckoned row by row."""
    sides = f"SELECT *, list_sort(list_distinct(string_split(m, ' '))) AS x, list_sort(list_distinct(string_split(n, ' '))) AS y FROM ({pairs})"
    parts = f"SELECT *, list_sort(list_intersect(x, y)) AS c FROM ({sides})"
    own = lambda z: f"trim(array_to_string(list_concat(c, list_filter({z}, lambda w: NOT list_contains(c, w))), ' '))"
    texts = f"SELECT *, array_to_string(c, ' ') AS sc, {own('x')} AS sx, {own('y')} AS sy FROM ({parts})"
    codes = (
        f"SELECT *, list_transform(string_split(sx, ''), lambda w: [CAST(unicode(w) AS BIGINT)]) AS px, list_transform(string_split(sy, ''), lambda w: CAST(unicode(w) AS BIGINT)) AS py,"
        f" list_transform(range(1, length(sy) + 1), lambda j: [j]) AS places, list_transform(range(0, length(sy) + 1), lambda j: CAST(0 AS BIGINT)) AS zeros FROM ({texts})"
    )
    common = (
        "list_reduce(px, lambda r, ch: list_reduce(places, lambda o, j: list_append(o, CASE WHEN py[j[1]] = ch[1] THEN r[j[1]] + 1 ELSE greatest(r[j[1] + 1], o[j[1]]) END), [CAST(0 AS BIGINT)]), zeros)[length(sy) + 1]"
    )
    one = lambda z: f"CASE WHEN len(c) > 0 THEN 2 * length(sc) / (length(sc) + length({z})) ELSE 0 END"
    return f"SELECT *, CASE WHEN len(c) > 0 AND (len(c) = len(x) OR len(c) = len(y)) THEN 1.0 ELSE greatest(2 * {common} / (length(sx) + length(sy)), {one('sx')}, {one('sy')}) END AS ratio FROM ({codes})"


def page_text(h: str) -> str:
    bare = f"regexp_replace(regexp_replace({h}, '(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>', ' ', 'g'), '(?s)<[^>]+>', ' ', 'g')"
    return f"trim(regexp_replace({bare}, '\\s+', ' ', 'g'))"


def status(t: str) -> str:
    return (
        f"CASE WHEN {t} = '' THEN 'empty' WHEN length({t}) < 1200 AND regexp_matches(lower({t}), 'sign in|log ?in|password') THEN 'login_wall'"
        f" WHEN length({t}) < 200 AND NOT regexp_matches(lower({t}), 'camp|register|session|program') THEN 'needs_js' ELSE 'ok' END"
    )


_ANCHOR = _q(r"""(?is)<a\b[^>]*?\bhref\s*=\s*["']([^"']*)["'][^>]*>(.*?)</a>""")
_REGISTRATION = f"(regexp_matches(lower(url), {_q('|'.join(h.replace('.', chr(92) + '.') for h in U.REGISTRATION_HOSTS))}) OR regexp_matches(lower(url), {_q(U.REGISTRATION_PATH)}))"
#: Links of pages: all hrefs of these pages start with a slash.
LINKS = f"""
  SELECT page_id, pos, url, label, CASE WHEN {_REGISTRATION} THEN 60 WHEN regexp_matches({path('url')}, {_q('(?i)' + U.JUNK_PATH)}) THEN -1
    WHEN regexp_matches(lower(url) || ' ' || lower(label), 'summer-?camp|day-?camp|lexplor') THEN 50
    WHEN regexp_matches(lower(url) || ' ' || lower(label), '\\bcamp\\b|/camps?(?:/|$)|summer|register|registration|program|enroll|activit') THEN 40 ELSE 10 END AS score
  FROM (SELECT page_id, pos - 1 AS pos, regexp_extract(base, '^([^:/?#]+://[^/?#]*)', 1) || href AS url, trim(regexp_replace(regexp_replace(inner_html, '(?s)<[^>]+>', ' ', 'g'), '\\s+', ' ', 'g')) AS label
        FROM (SELECT page_id, url AS base, unnest(regexp_extract_all(html, {_ANCHOR}, 1)) AS href, unnest(regexp_extract_all(html, {_ANCHOR}, 2)) AS inner_html, unnest(range(1, len(regexp_extract_all(html, {_ANCHOR}, 1)) + 1)) AS pos FROM pages)
        WHERE href LIKE '/%')"""

_SYMBOLS = "length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) * 20"
_CAPITALS = "length(regexp_replace(text, '[^A-Z]', '', 'g')) * 4"
_ATTEMPTS = "SELECT user_id AS hole_id, max(ts) AS searched_at, count(*) AS attempts, max_by(event_type = 'purchase', ts) AS found FROM events GROUP BY 1"
_SESSIONS = """SELECT c_custkey AS ord, n_name, c_mktsegment, CASE WHEN c_acctbal > 9500 THEN 'parent_ready' WHEN c_acctbal < 0 THEN 'brochure_only' ELSE 'unverified' END AS v,
  lower(replace(c_name, '#', '-')) || '.example.com' AS host FROM customer JOIN nation ON c_nationkey = n_nationkey"""
_MATRIX = f"""SELECT n.n_name AS category, CASE WHEN n_regionkey < 3 THEN 'core' ELSE 'long_tail' END AS tier, CAST(n_nationkey % 8 AS BIGINT) AS demand, count(*) FILTER (v = 'parent_ready') AS ready_count,
  count(*) FILTER (v = 'brochure_only') AS brochure_count, CASE WHEN count(*) FILTER (v = 'parent_ready') > 0 THEN 'covered' ELSE 'hole' END AS status,
  coalesce(CASE WHEN count(*) FILTER (v = 'parent_ready') > 0 THEN min_by(host, ord) FILTER (v = 'parent_ready') ELSE min_by(host, ord) FILTER (v = 'brochure_only') END, '') AS example_provider
  FROM nation n LEFT JOIN ({_SESSIONS}) s ON s.n_name = n.n_name GROUP BY n.n_name, n_regionkey, n_nationkey"""
_LOW = "month(d) * 31 + day(d)"

ORACLES: dict[str, str] = {
    "host_rollup_page_status": f"""
      WITH p AS (SELECT page_id, url, {page_text('html')} AS t, row_number() OVER (PARTITION BY {canonical('url')} ORDER BY page_id) AS r FROM pages)
      SELECT {host('url')} AS host, {status('t')} AS status, count(*) AS n_pages, CAST(sum(length(t)) AS BIGINT) AS n_text FROM p WHERE r = 1 GROUP BY 1, 2""",
    "canonical_url_pages": f"SELECT page_id, {canonical('url')} AS canonical_url, {host('url')} AS host, regexp_extract({host('url')}, '([^.]+\\.[^.]+)$', 1) AS domain FROM pages",
    "duplicate_pages_by_url": f"SELECT {canonical('url')} AS canonical_url, count(*) AS n, min(page_id) AS first_page FROM pages GROUP BY 1 HAVING count(*) > 1",
    "page_links": f"SELECT page_id, CAST(pos AS BIGINT) AS pos, url, label, CAST(score AS BIGINT) AS score FROM ({LINKS})",
    "frontier_topk": f"""
      WITH l AS (SELECT {host('p.url')} AS host, k.url, max(score) AS score FROM ({LINKS}) k JOIN pages p USING (page_id) WHERE score >= 1 GROUP BY 1, 2)
      SELECT host, url, CAST(score AS BIGINT) AS score, rank FROM (SELECT *, row_number() OVER (PARTITION BY host ORDER BY score DESC, url) AS rank FROM l) WHERE rank <= 3""",
    "one_seed_per_host": f"""
      WITH p AS (SELECT page_id, url, {host('url')} AS host, CASE WHEN {_REGISTRATION} THEN 4 WHEN regexp_matches(lower({path('url')}), 'summer-?camps?|/camps?(?:/|$)') THEN 3
        WHEN regexp_matches(lower({path('url')}), 'summer|program') THEN 2 WHEN {path('url')} IN ('', '/') THEN 1 ELSE 0 END AS s FROM pages)
      SELECT host, url, page_id FROM (SELECT *, row_number() OVER (PARTITION BY host ORDER BY s DESC, page_id) AS r FROM p) WHERE r = 1""",
    "breadth_first_pages": f"""
      WITH p AS (SELECT page_id, {host('url')} AS host, row_number() OVER (PARTITION BY {host('url')} ORDER BY page_id) AS turn FROM pages)
      SELECT page_id, host FROM p ORDER BY CASE WHEN turn > 1 THEN 1 ELSE 0 END, page_id LIMIT 100""",
    "ingest_new_pages": f"""
      WITH p AS (SELECT page_id, url, {canonical('url')} AS key FROM pages), n AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY page_id) AS r FROM p WHERE page_id % 2 = 1 AND key NOT IN (SELECT key FROM p WHERE page_id % 2 = 0))
      SELECT url, page_id FROM n WHERE r = 1""",
    "link_slop": f"""
      SELECT CASE WHEN regexp_matches(lower({path('url')}), {_q(U.MEDIA)}) THEN 'media' WHEN regexp_matches({path('url')}, {_q('(?i)' + U.JUNK_PATH)}) THEN 'junk path'
        WHEN n = '' OR n IN ({', '.join(_q(x) for x in T.CHROME_LABELS)}) OR regexp_matches(n, '^(?:(?:skip|back|jump) to\\b.*|toggle\\b.*|open\\b.*menu|close\\b.*menu)$')
          OR regexp_matches(n, '\\.(?:png|jpe?g|gif|svg|webp|pdf|docx?|xlsx?|css|js)$') OR regexp_matches(n, '^[#\\-\\s]*\\d[\\d\\s\\-#]*$') THEN 'chrome label' ELSE 'kept' END AS reason, count(*) AS n
      FROM (SELECT url, lower(regexp_replace(label, '^[.:|–-]+|[.:|–-]+$', '', 'g')) AS n FROM ({LINKS})) GROUP BY 1""",
    "page_host_link_shape": f"""
      WITH n AS (SELECT page_id, count(*) AS n_links FROM ({LINKS}) GROUP BY 1)
      SELECT {host('url')} AS host, count(*) AS pages, CAST(sum(coalesce(n_links, 0)) AS BIGINT) AS links, count(*) FILTER (coalesce(n_links, 0) >= 5) AS grids FROM pages LEFT JOIN n USING (page_id) GROUP BY 1""",
    "season_filter_orders": "SELECT o_orderstatus, CAST(year(o_orderdate) AS BIGINT) AS year, month(o_orderdate) BETWEEN 6 AND 8 AS in_season, count(*) AS n FROM orders GROUP BY ALL",
    "date_readings_orders": f"""
      SELECT o_orderkey, month(d) BETWEEN 6 AND 8 AS summer, CAST(d AS VARCHAR) AS first_date, CAST(d AS VARCHAR) AS span_first, CAST(e AS VARCHAR) AS span_last, least({_LOW}, {_LOW.replace('(d)', '(e)')}) AS lo, greatest({_LOW}, {_LOW.replace('(d)', '(e)')}) AS hi
      FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, CAST(o_orderdate AS DATE) + 9 AS e FROM orders)""",
    "rule_chain_documents": f"""
      SELECT CASE WHEN trim(text) = '' THEN 'empty' WHEN length(text) < 300 THEN 'short' WHEN {_SYMBOLS} > length(text) THEN 'symbols' WHEN {_CAPITALS} > length(text) THEN 'capitals'
        WHEN regexp_matches(text, '(?i)\\badults?\\b') THEN 'adult' ELSE 'kept' END AS reason, quality, toxic, count(*) AS n
      FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents) LEFT JOIN labels USING (doc_id) GROUP BY ALL""",
    "gate_with_label_join": """
      WITH j AS (SELECT source, CASE WHEN quality IS NULL THEN 'not labelled' WHEN quality = 0 THEN 'low quality' WHEN toxic = 1 THEN 'toxic' WHEN n_chars < 400 THEN 'too short' END AS r FROM documents LEFT JOIN labels USING (doc_id))
      SELECT source, CASE WHEN r IS NULL THEN 'published' ELSE 'gap' END AS status, coalesce(r, '') AS reason, count(*) AS n FROM j GROUP BY ALL""",
    "dimension_violations": """
      SELECT CAST(p_partkey AS VARCHAR) AS key, 'size at most 45' AS rule FROM part WHERE NOT p_size <= 45
      UNION ALL SELECT CAST(p_partkey AS VARCHAR), 'price over 905' FROM part WHERE NOT p_retailprice > 905
      UNION ALL SELECT CAST(p_partkey AS VARCHAR), 'brand' FROM part WHERE NOT regexp_matches(p_brand, '^Brand#\\d+$')
      UNION ALL SELECT p_name, 'unique p_name' FROM part GROUP BY p_name HAVING count(*) > 1""",
    "enrollability_customers": """
      WITH c AS (SELECT CASE WHEN c_acctbal > 7000 THEN 'r' WHEN c_acctbal < 0 THEN 'b' WHEN c_mktsegment = 'BUILDING' THEN 'f' ELSE 'u' END AS v FROM customer)
      SELECT count(*) AS total, count(*) FILTER (v = 'r') AS ready, count(*) FILTER (v = 'b') AS brochure, count(*) FILTER (v = 'u') AS unverified,
        CAST(round_even(100.0 * (count(*) FILTER (v = 'r') + 0.5 * count(*) FILTER (v = 'u')) / greatest(count(*), 1), 0) AS BIGINT) AS score FROM c""",
    "page_text_status": f"SELECT page_id, length(t) AS n_text, {status('t')} AS status, regexp_matches(html, {_q('(?i)' + T.AFFORDANCE)}) AS affordance FROM (SELECT *, {page_text('html')} AS t FROM pages)",
    "host_cap_rows": "SELECT l_suppkey, count(*) - 60 AS truncated FROM lineitem GROUP BY 1 HAVING count(*) > 60",
    "host_cap_kept": """
      SELECT l_suppkey, count(*) AS n, max(l_orderkey) AS last_order FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey) AS r FROM lineitem) WHERE r <= 60 GROUP BY 1""",
    "nearest_n_per_group": """
      SELECT p_brand, p_partkey, gap, rank FROM (SELECT p_brand, p_partkey, round(abs(p_retailprice - 950), 2) AS gap, row_number() OVER (PARTITION BY p_brand ORDER BY round(abs(p_retailprice - 950), 2), p_partkey) AS rank FROM part) WHERE rank <= 3""",
    "nearest_once_per_group": """
      WITH RECURSIVE p AS (SELECT p_brand AS b, CAST(regexp_extract(p_brand, '(\\d+)', 1) AS INT) AS t, p_type || '|' || p_size AS kind, min(round(abs(p_retailprice - 950), 2)) AS gap FROM part GROUP BY 1, 2, 3),
      o AS (SELECT *, row_number() OVER (ORDER BY t) AS i FROM (SELECT b, t, list(kind ORDER BY gap, kind) AS kinds FROM p GROUP BY 1, 2)),
      s AS (SELECT CAST(0 AS BIGINT) AS i, CAST([] AS VARCHAR[]) AS taken, CAST([] AS VARCHAR[]) AS own UNION ALL
        SELECT o.i, list_concat(s.taken, list_filter(o.kinds, lambda k: NOT list_contains(s.taken, k))[1:3]), list_filter(o.kinds, lambda k: NOT list_contains(s.taken, k))[1:3] FROM s JOIN o ON o.i = s.i + 1)
      SELECT o.b AS p_brand, p.kind, p.gap, CAST(list_position(s.own, p.kind) AS BIGINT) AS rank FROM s JOIN o USING (i) JOIN p ON p.b = o.b AND list_contains(s.own, p.kind)""",
    "snapshot_diff_alarms": """
      WITH g AS (SELECT user_id, event_type, count(*) FILTER (ts < TIMESTAMP '2024-01-16') AS old_n, count(*) FILTER (ts >= TIMESTAMP '2024-01-16') AS new_n FROM events GROUP BY 1, 2)
      SELECT user_id, event_type, old_n, new_n, round((new_n - old_n) / greatest(old_n, 1), 4) AS delta FROM g WHERE abs((new_n - old_n) / greatest(old_n, 1)) > 0.3""",
    "zero_floor": "SELECT n_nationkey AS nation, n_name, count(s_suppkey) AS n FROM nation LEFT JOIN supplier ON s_nationkey = n_nationkey GROUP BY 1, 2 HAVING count(s_suppkey) < 4",
    "yield_stop": """
      WITH e AS (SELECT event_type, event_id, CASE WHEN row_number() OVER (PARTITION BY event_type, user_id ORDER BY event_id) = 1 THEN 1 ELSE 0 END AS fresh, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS place FROM events),
      w AS (SELECT *, sum(fresh) OVER (PARTITION BY event_type ORDER BY event_id ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS s FROM e)
      SELECT event_type, min(event_id) FILTER (s = 0 AND place >= 50 AND place >= 10) AS stop_at, max(place) AS searches FROM w GROUP BY 1""",
    "hole_state_latest": f"SELECT hole_id, strftime(searched_at, '%Y-%m-%d %H:%M:%S') AS searched_at, attempts, CASE WHEN found THEN 'filled' WHEN attempts >= 6 THEN 'exhausted' ELSE 'searched' END AS status FROM ({_ATTEMPTS})",
    "ttl_searchable": f"SELECT hole_id FROM ({_ATTEMPTS}) WHERE NOT TIMESTAMP '2024-01-31' < searched_at + CASE WHEN NOT found AND attempts >= 80 THEN INTERVAL 60 DAY ELSE INTERVAL 1 DAY END",
    "latest_event_per_user": "SELECT user_id, event_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1",
    "first_event_wins": "SELECT user_id, event_type, min(event_id) AS event_id FROM events GROUP BY 1, 2",
    "running_yield": "SELECT user_id, count(*) AS attempts, round(avg(CASE WHEN event_type = 'purchase' THEN 1.0 ELSE 0.0 END), 6) AS mean_yield, max(event_id) FILTER (event_type = 'purchase') AS last_purchase FROM events GROUP BY 1",
    "brochure_only_groups": "SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1 HAVING count(*) >= 2 AND count(*) FILTER (o_orderstatus NOT IN ('O', 'P')) = 0",
    "top_customers": "SELECT o_custkey, round(sum(o_totalprice), 2) AS total, count(*) AS n FROM orders GROUP BY 1 ORDER BY total DESC, o_custkey LIMIT 12",
    "user_set_operations": """
      WITH v AS (SELECT DISTINCT user_id FROM events WHERE event_type = 'view' AND value > 12), c AS (SELECT DISTINCT user_id FROM events WHERE event_type = 'click' AND value > 12)
      SELECT 'union' AS op, count(*) AS n, CAST(coalesce(sum(user_id), 0) AS BIGINT) AS ids FROM (SELECT * FROM v UNION SELECT * FROM c)
      UNION ALL SELECT 'minus', count(*), CAST(coalesce(sum(user_id), 0) AS BIGINT) FROM (SELECT * FROM v EXCEPT SELECT * FROM c)
      UNION ALL SELECT 'both', count(*), CAST(coalesce(sum(user_id), 0) AS BIGINT) FROM (SELECT * FROM v INTERSECT SELECT * FROM c)""",
    "union_dedupe_merge": """
      SELECT coalesce(c_name, s_name) AS name, CASE WHEN c_acctbal > 0 THEN c_mktsegment END AS segment, s_acctbal AS balance,
        CASE WHEN c_name IS NULL THEN 'supplier' WHEN s_name IS NULL THEN 'customer' ELSE 'customer;supplier' END AS via, CAST((c_name IS NOT NULL)::INT + (s_name IS NOT NULL)::INT AS BIGINT) AS n_merged
      FROM customer FULL JOIN supplier ON regexp_extract(c_name, '#0*(\\d+)$', 1) = regexp_extract(s_name, '#0*(\\d+)$', 1)""",
    "reconcile_sources": """
      WITH b AS (SELECT 'customer' AS source, c_custkey AS ord, c_nationkey || '|' || (c_custkey % 97) AS k, 0 AS s FROM customer
        UNION ALL SELECT 'supplier', s_suppkey, s_nationkey || '|' || (((1::BIGINT << 50) + s_suppkey) % 97), 1 FROM supplier),
      r AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY s, ord) AS n FROM b)
      SELECT source, count(*) AS raw, count(*) FILTER (n = 1) AS kept, count(*) FILTER (n > 1) AS collapsed FROM r GROUP BY 1""",
    "short_ids": "SELECT p_partkey, 'prog_' || substr(sha1(p_brand || '|' || p_name), 1, 10) AS program_id FROM part",
    "name_forms": """
      SELECT p_partkey, p_name || ' 3' AS identity, array_to_string(list_sort(list_distinct(string_split(p_name || ' summer camp week 3 2026', ' '))), ' ') AS sorted, p_name || ' summer camp' AS undated,
        replace(p_name, ' ', '_') || '_summer_camp_week_3_2026' AS slug FROM part""",
    "registry_fold": """
      WITH p AS (SELECT *, lower(replace(p_brand, '#', '-')) || '.example.com' AS host, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS k FROM part)
      SELECT host, arg_max(p_name, length(p_name) * 100000000 - p_partkey) AS name, arg_min(p_type, p_partkey) AS town, array_to_string(list_sort(list(DISTINCT p_type)), ';') AS categories, bool_or(p_size > 49) AS parent_ready,
        array_to_string(list('https://' || host || '/' || p_partkey ORDER BY p_partkey) FILTER (k <= 10), ';') AS urls FROM p GROUP BY host""",
    "interval_overlap_match": f"""
      WITH o AS (SELECT o_custkey, o_orderkey, {_LOW.replace('(d)', '(o_orderdate)')} AS lo FROM orders)
      SELECT a.o_custkey, count(*) AS pairs FROM o a JOIN o b ON a.o_custkey = b.o_custkey AND a.o_orderkey < b.o_orderkey AND a.lo <= b.lo + 8 AND b.lo <= a.lo + 8 GROUP BY 1""",
    "coverage_matrix": _MATRIX,
    "coverage_summary": f"""
      SELECT count(*) AS categories, count(*) FILTER (status = 'covered') AS covered, count(*) FILTER (tier = 'core') AS core_total, count(*) FILTER (tier = 'core' AND status = 'covered') AS core_covered,
        CAST(round_even(100.0 * count(*) FILTER (tier = 'core' AND status = 'covered') / greatest(1, count(*) FILTER (tier = 'core')), 0) AS BIGINT) AS core_pct,
        coalesce(array_to_string(list(category ORDER BY category) FILTER (status = 'hole'), ';'), '') AS holes FROM ({_MATRIX})""",
    "gap_audit": f"""
      WITH h AS (SELECT 'missing_category_' || category AS hole_id, 'missing_category' AS kind, category, demand, tier = 'core' AS core, replace(category, '_', ' ') || ' summer camp Anytown' AS query FROM ({_MATRIX}) WHERE status = 'hole'
        UNION ALL SELECT 'brochure_gap_customer-' || o_custkey, 'brochure_gap', '', 0, false, 'register customer-' || o_custkey FROM orders GROUP BY o_custkey HAVING count(*) >= 3 AND count(*) FILTER (o_orderstatus <> 'O') = 0)
      SELECT *, row_number() OVER (ORDER BY core DESC, demand DESC, hole_id) AS priority FROM h""",
    "county_pivot": """
      SELECT n_name, count(*) FILTER (o_orderstatus = 'F') AS n_f, count(*) FILTER (o_orderstatus = 'O') AS n_o, count(*) FILTER (o_orderstatus = 'P') AS n_p
      FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1""",
    "regional_sharing": """
      WITH t AS (SELECT n_nationkey, n_name AS town, 42.0 + floor(n_nationkey / 5) * 0.08 AS lat, -71.0 - (n_nationkey % 5) * 0.09 AS lon FROM nation),
      o AS (SELECT s_name AS host, s_nationkey, unnest([CASE WHEN s_suppkey % 2 = 0 THEN 'swimming' ELSE 'chess' END, CASE WHEN s_suppkey % 7 = 0 THEN 'sailing' ELSE 'arts' END]) AS category FROM supplier WHERE s_acctbal > 5000),
      d AS (SELECT a.town, b.town AS via_town, b.n_nationkey AS k, 2 * 3958.8 * asin(least(1.0, sqrt(pow(sin(radians(b.lat - a.lat) / 2), 2) + cos(radians(a.lat)) * cos(radians(b.lat)) * pow(sin(radians(b.lon - a.lon) / 2), 2)))) AS miles FROM t a, t b)
      SELECT d.town, o.category, arg_min(d.via_town, o.host) AS via_town, min(o.host) AS host FROM d JOIN o ON o.s_nationkey = d.k WHERE miles <= CASE WHEN o.category = 'sailing' THEN 15 ELSE 10 END GROUP BY 1, 2""",
    "category_tags": """
      WITH p AS (SELECT lower(p_name || ' ' || p_type) AS b FROM part), t AS (SELECT * FROM (VALUES (0, 0, 'small_goods', 'small'), (0, 1, 'red_goods', 'red'), (0, 2, 'rings', 'ring'), (0, 3, 'widgets', 'widget'), (1, 4, 'economy', 'economy'), (1, 5, 'standard', 'standard'), (1, 6, 'promo', 'promo')) v(g, k, slug, term)),
      m AS (SELECT p.rowid_, slug, row_number() OVER (PARTITION BY p.rowid_ ORDER BY g, k) AS r FROM (SELECT *, row_number() OVER () AS rowid_ FROM p) p JOIN t ON contains(p.b, t.term))
      SELECT slug AS category, count(*) AS n FROM m WHERE r <= 4 GROUP BY 1""",
    "summary_rollup": "SELECT coalesce(o_orderstatus, 'all') AS o_orderstatus, coalesce(o_orderpriority, 'all') AS o_orderpriority, count(*) AS n FROM orders GROUP BY ROLLUP (o_orderstatus, o_orderpriority)",
    "completeness_report": """
      WITH g AS (SELECT source, count(*) AS n, count(quality) AS labelled, count(*) FILTER (n_chars < 400) AS short, CAST(coalesce(sum(quality), 0) AS BIGINT) AS good FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1)
      SELECT *, CASE WHEN labelled > 0 AND good / labelled >= 0.9 THEN 'A' WHEN labelled > 0 AND good / labelled >= 0.8 THEN 'B' WHEN labelled > 0 AND good / labelled >= 0.7 THEN 'C' ELSE 'D' END AS grade FROM g""",
    "score_recall_precision": f"""
      WITH j AS (SELECT quality = 1 AS good, {_SYMBOLS} <= length(text) AND {_CAPITALS} <= length(text) AS said FROM labels JOIN (SELECT doc_id, coalesce(text, '') AS text FROM documents) USING (doc_id)),
      g AS (SELECT count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (said) AS said, count(*) FILTER (good AND said) AS hit FROM j)
      SELECT *, round(hit / nullif(good, 0), 6) AS recall, round(hit / nullif(said, 0), 6) AS precision FROM g""",
    "provider_regressions": """
      SELECT o_custkey, before, after, after - before AS delta FROM (SELECT o_custkey, count(*) FILTER (year(o_orderdate) = 1996) AS before, count(*) FILTER (year(o_orderdate) = 1997) AS after FROM orders GROUP BY 1) WHERE before + after > 0""",
    "provider_floors": "SELECT s_suppkey, s_name, count(DISTINCT l_orderkey) AS n FROM supplier LEFT JOIN lineitem ON l_suppkey = s_suppkey GROUP BY 1, 2 HAVING count(DISTINCT l_orderkey) < 600",
    "event_payloads": "SELECT event_type, CAST(json_extract(props, '$.k') AS BIGINT) % 10 AS bucket, count(*) AS n, CAST(sum(CAST(json_extract(props, '$.k') AS BIGINT)) AS BIGINT) AS total FROM events GROUP BY 1, 2",
    "item_link_collapse": f"""
      SELECT page_id, lower(regexp_extract(url, '/([^/]*)$', 1)) AS item, arg_max(label, length(label) * 1000000 - pos) AS name, CAST(min(pos) AS BIGINT) AS pos, count(*) AS n FROM ({LINKS}) GROUP BY 1, 2""",
    "stream_event_counts": "SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS hour, event_type, count(*) AS n FROM events GROUP BY 1, 2",
    "stream_first_seen": "SELECT user_id, min(event_id) AS first_event FROM events GROUP BY 1",
    "fuzzy_pairs_blocked": f"""
      WITH s AS (SELECT s_suppkey AS k, s_nationkey AS b, trim(regexp_replace(lower(s_name), '[^a-z0-9]+', ' ', 'g')) AS w FROM supplier), t AS (SELECT k, b, array_to_string(list_sort(list_distinct(string_split(w, ' '))), ' ') AS m FROM s)
      SELECT a, b, ratio FROM ({alike("SELECT x.k AS a, y.k AS b, x.m, y.m AS n FROM t x JOIN t y ON x.b = y.b AND x.k < y.k")}) WHERE ratio >= 0.94""",
}
