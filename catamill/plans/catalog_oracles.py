"""DuckDB SQL for the queries of catalog jobs."""

from __future__ import annotations

from catamill.functions import hosts as H
from catamill.functions import urls as U
from catamill.operators import gates as G
from catamill.operators import relevance as R
from catamill.plans.oracles import LINKS, _q, alike, canonical, host, path

_i = lambda c, p: f"regexp_matches({c}, {_q('(?i)' + p)})"
_any = lambda c, parts: "(" + " OR ".join(f"contains({c}, {_q(p)})" for p in parts) + ")"
_in = lambda xs: "(" + ", ".join(_q(x) for x in xs) + ")"

_PART_ROWS = """SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN 'Summer Camp' WHEN 1 THEN 'Adult Yoga' WHEN 2 THEN 'October' ELSE 'Robots' END || ' ' || p_name || CASE WHEN p_size > 25 THEN ' ages 7-12' ELSE '' END AS b,
  p_size > 25 OR p_partkey % 3 = 0 AS evidence, CASE p_type WHEN 'ECONOMY' THEN 'webtrac' WHEN 'PROMO' THEN 'catalog_grid' ELSE '' END AS platform FROM part"""
_AGED = _i("b", R.ADULT) + " OR " + _i("b", R.ADULT_MINIMUM)
_PAGES = f"SELECT page_id, url, {host('url')} AS host, regexp_extract({host('url')}, '([^.]+\\.[^.]+)$', 1) AS domain, lower({path('url')}) AS pth, lower(regexp_extract(url, '^[^:/?#]+://([^/?#]*)', 1)) AS authority FROM pages"
_CENTRE = _any("authority", H.REC_CENTER_HINTS)
_CAMP_HOST = (
    f"(regexp_matches(pth, {_q(H.CAMP_HOST_PATH)}) OR ({_CENTRE} AND regexp_matches(authority || pth, {_q(H.CAMP_HOST_PATH)})) OR ({_CENTRE} AND pth IN ('', '/') AND {_any('authority', ('daycamp', 'summercamp', 'camp'))})"
    f" OR regexp_matches(authority, {_q(H.CAMP_DOMAIN)}) OR {_any('authority', ('daycamp', 'summercamp', 'camp.org', 'camp.com'))} OR contains(pth, 'program_details.aspx'))"
)
_SCORE = " + ".join(
    [f"CASE WHEN contains(pth, {_q(p)}) THEN 100 ELSE 0 END" for p in H.SKIPPED_PATHS] + [f"CASE WHEN contains(pth, {_q(p)}) THEN -20 ELSE 0 END" for p in H.PREFERRED_PATHS]
    + ["CASE WHEN pth IN ('', '/') THEN 50 ELSE 0 END", f"CASE WHEN {_CAMP_HOST} THEN -40 ELSE 0 END"]
)
_REGISTERS = f"(regexp_matches(lower(url), {_q('|'.join(h.replace('.', chr(92) + '.') for h in U.REGISTRATION_HOSTS))}) OR regexp_matches(lower(url), {_q(U.REGISTRATION_PATH)}))"
_VENDOR = "CASE WHEN contains(authority, 'communityed') THEN 'communityed' " + " ".join(f"WHEN contains(lower(url), {_q(p)}) THEN {_q(v)}" for p, v in H.VENDOR_SIGNATURES) + " ELSE 'unknown' END"
_CLASS = r"/class/(?!category)[^/]+"  # SQL has no look-ahead
_ATTEMPTS = "SELECT user_id AS hole_id, max(ts) AS searched_at, count(*) AS attempts, max_by(event_type = 'purchase', ts) AS found FROM events GROUP BY 1"
_NONCAMP = f"""SELECT CAST(p_size % 7 AS BIGINT) AS kind, ['Counselor wanted', 'Swim lessons', 'Swim lessons camp', 'Newsletter', 'ESL program', 'Learning Center', 'Day camp'][p_size % 7 + 1] AS n,
  p_partkey % 11 = 0 AS careers, p_partkey % 2 = 0 AS summer FROM part"""
_CUSTOMER_ROWS = """SELECT CASE WHEN c_acctbal > 9000 THEN 'parent_ready' WHEN c_acctbal < -900 THEN 'fetch_failed' WHEN c_acctbal < 3000 THEN 'brochure_only' ELSE 'unverified' END AS v,
  'kind_' || (c_custkey % 500) AS category, 'h' || (c_custkey // 3) || '.example.com' AS host, CASE WHEN c_custkey % 500 < 100 THEN 'core' ELSE 'long_tail' END AS tier FROM customer"""
_BY_HOST = f"SELECT host, count(*) AS n, count(*) FILTER (v = 'parent_ready') AS ready, bool_and(v IN ('brochure_only', 'unverified')) AS weak, bool_or(v = 'fetch_failed') AS failed FROM ({_CUSTOMER_ROWS}) GROUP BY 1"
_TOWNS = "SELECT n_name AS town, 42.0 + (n_nationkey // 5) * 0.08 AS lat, -71.0 - (n_nationkey % 5) * 0.09 AS lon FROM nation"
_MILES = "2 * 3958.8 * asin(least(1.0, sqrt(pow(sin(radians(b.lat - a.lat) / 2), 2) + cos(radians(a.lat)) * cos(radians(b.lat)) * pow(sin(radians(b.lon - a.lon) / 2), 2))))"


def _gap(kind: str, words: str, priority: int) -> str:
    return f"'{kind}_' || left(replace(host, '.', '_'), 40) AS hole_id, '{kind}' AS kind, '' AS category, host, CAST({priority} AS BIGINT) AS priority, 'Anytown ' || split_part(host, '.', 1) || ' {words}' AS query"


ORACLES: dict[str, str] = {
    "relevance_parts": f"""
      WITH r AS (SELECT *, CASE WHEN {_AGED} THEN 'adult' WHEN {_i('b', R.NON_PROGRAM)} THEN 'non-program' WHEN {_i('b', R.ADULT_FITNESS)} AND NOT {_i('b', R.YOUTH)} THEN 'adult-fitness'
        WHEN {_i('b', R.OTHER_SEASON)} AND NOT {_i('b', R.SUMMER)} THEN 'off-season' WHEN platform = 'webtrac' THEN 'camp-catalog'
        WHEN {_i('b', R.CAMP_TYPE)} OR {_i('b', R.SUMMER)} OR (platform <> 'catalog_grid' AND {_i('b', R.YOUTH)}) THEN 'youth-summer' WHEN platform <> 'catalog_grid' AND evidence THEN 'registrable-evidence' ELSE 'fail-open' END AS focus_reason FROM ({_PART_ROWS}))
      SELECT platform, focus_reason IN ('camp-catalog', 'youth-summer', 'registrable-evidence', 'fail-open') AS keep, focus_reason, count(*) AS n FROM r GROUP BY 1, 2, 3""",
    "noncamp_parts": f"""
      SELECT kind, CASE WHEN n LIKE 'Counselor%' OR careers THEN 'job' WHEN n = 'Swim lessons' THEN 'lessons' WHEN n = 'Newsletter' THEN 'resource page' WHEN n = 'ESL program' THEN 'school service'
        WHEN NOT summer AND n = 'Learning Center' THEN 'year-round childcare' ELSE 'camp' END AS reason, count(*) AS n FROM ({_NONCAMP}) GROUP BY 1, 2""",
    "publish_gate_documents": """
      WITH l AS (SELECT doc_id % 12 AS m, length('Camp camper kids ' || CASE WHEN doc_id % 12 = 6 THEN 'clinical therapist patients ' ELSE '' END || coalesce(text, '')) AS n FROM labels JOIN documents USING (doc_id)),
      e AS (SELECT CASE WHEN m = 0 THEN 'chrome name' WHEN m = 1 THEN 'out of state' WHEN m = 2 THEN 'info page not fetched' WHEN n < 400 THEN 'info page too short'
        ELSE ['name absent from info page', 'lessons', 'adult evidence', 'clinical context', 'off-season dates', 'no evidence', '', '', ''][m - 2] END AS evidence FROM l),
      b AS (SELECT review, evidence, review AND evidence IN ('lessons', 'adult evidence', 'no evidence') AS soft FROM e, (VALUES (false), (true)) v(review))
      SELECT review, CASE WHEN evidence = '' OR soft THEN 'published' ELSE 'gap' END AS status, CASE WHEN evidence = '' OR soft THEN '' WHEN evidence LIKE 'info page %' THEN 'empty' ELSE 'needs_review' END AS reason, evidence,
        CASE WHEN evidence = '' THEN 'info_confirmed' WHEN soft THEN 'needs_review' ELSE '' END AS verdict, count(*) AS n FROM b GROUP BY ALL""",
    "published_rows_orders": """
      WITH o AS (SELECT CASE o_orderstatus WHEN 'F' THEN 'parent_ready' WHEN 'O' THEN 'brochure_only' ELSE '' END AS v, o_custkey % 5 = 0 AS program, CAST(o_orderdate AS DATE) AS d, o_custkey % 7 = 0 AS senior FROM orders),
      h AS (SELECT v, CASE WHEN v = '' THEN 'unverified' WHEN NOT program AND NOT (d <= DATE '1996-09-30' AND d >= DATE '1996-05-01') THEN 'date_sanity' WHEN senior AND v <> 'parent_ready' THEN 'audience_keyword' ELSE '' END AS held_reason FROM o)
      SELECT held_reason, CASE WHEN held_reason = '' AND v = 'brochure_only' THEN 'brochure_only' ELSE '' END AS label, count(*) AS n FROM h GROUP BY 1, 2""",
    "junk_reasons_customers": """
      WITH c AS (SELECT c_custkey % 5 = 0 AS chrome, c_custkey % 5 = 1 AS number, c_custkey % 7 AS k, c_custkey % 3 = 0 AS program, c_acctbal > 0 AS price FROM customer),
      r AS (SELECT unnest(list_filter([CASE WHEN chrome THEN 'chrome_name' END, CASE WHEN number THEN 'unusable_name' END, CASE WHEN k = 0 THEN 'no_register_url' END, CASE WHEN k = 1 THEN 'offhost_register' END,
        CASE WHEN NOT program AND NOT price THEN 'no_evidence' END, CASE WHEN NOT chrome AND NOT number AND k > 1 AND (program OR price) THEN 'kept' END], lambda x: x IS NOT NULL)) AS reason FROM c)
      SELECT reason, count(*) AS n FROM r GROUP BY 1""",
    "verdict_buckets_orders": """
      WITH o AS (SELECT CASE WHEN o_custkey % 3 = 0 THEN 'MyRec' ELSE '' END AS platform, o_orderkey % 7 = 0 AS pdf, CASE WHEN o_orderstatus = 'F' THEN 'parent_ready' WHEN o_orderstatus = 'O' THEN CASE WHEN o_custkey % 5 = 0 THEN 'brochure_only' ELSE 'unverified' END ELSE '' END AS v FROM orders),
      p AS (SELECT platform, pdf, CASE WHEN platform = 'MyRec' AND v <> 'parent_ready' THEN 'needs_js' ELSE v END AS parent_verdict FROM o)
      SELECT platform, parent_verdict, CASE WHEN parent_verdict = '' THEN CASE WHEN pdf THEN 'wrong_audience' ELSE 'unverified' END WHEN parent_verdict IN ('parent_ready', 'brochure_only') THEN parent_verdict ELSE 'unverified' END AS bucket, count(*) AS n FROM p GROUP BY 1, 2, 3""",
    "register_gate_suppliers": """
      WITH s AS (SELECT s_acctbal > 0 AS ready, CASE WHEN s_suppkey % 3 = 0 THEN 'unchecked' WHEN s_suppkey % 4 = 0 THEN 'register_url 404' WHEN s_suppkey % 2 = 0 THEN '200+affordance' ELSE 'no registration affordance' END AS why FROM supplier),
      g AS (SELECT ready, CASE WHEN ready THEN why ELSE '' END AS gate_reason, NOT ready OR why IN ('unchecked', '200+affordance') AS ok FROM s)
      SELECT ok AS registrable, ok AND ready AS parent_ready, gate_reason, count(*) AS n FROM g GROUP BY 1, 2, 3""",
    "url_triage_links": f"""
      WITH l AS (SELECT url, url || ' ' || label AS b, lower({path('url')}) AS pth, lower(regexp_extract(url, '^[^:/?#]+://([^/?#]*)', 1)) AS authority FROM ({LINKS}))
      SELECT CASE WHEN {_i('url', H.AUTO_DROP)} THEN 'auto_drop' WHEN {_i('url', H.HIGH_CONFIDENCE.replace(_CLASS + '|', ''))} OR ({_i('url', '/class/[^/]+')} AND NOT {_i('url', '/class/category')}) THEN 'high_confidence' WHEN {_i('url', H.NEEDS_REVIEW)} OR authority LIKE '%.gov' THEN 'needs_review' ELSE 'plain' END AS triage,
        NOT {_i('url', H.DROPPED_CANDIDATE)} AND {_i('b', H.SUMMER_SIGNAL)} AND 1 + CASE WHEN {_i('b', H.STRONG_SIGNAL)} THEN 3 ELSE 0 END + CASE WHEN {_i('b', 'register|enroll|sign[\\s-]?up|program_details|iteminfo')} THEN 2 ELSE 0 END
          + CASE WHEN regexp_matches(pth, '/(camp|class|program|course|activity|session)s?/') THEN 1 ELSE 0 END - CASE WHEN {_i('b', H.CARE_OR_TEST)} THEN 4 ELSE 0 END > 0 AS candidate, count(*) AS n FROM l GROUP BY 1, 2""",
    "institution_hosts": f"""
      WITH p AS ({_PAGES}), d AS (SELECT domain, min(page_id) AS k FROM p GROUP BY 1 HAVING min(page_id) % 2 = 0), h AS (SELECT host, domain, count(*) AS n FROM p GROUP BY 1, 2)
      SELECT host, coalesce(CASE WHEN k IS NOT NULL THEN CASE WHEN k % 4 = 0 THEN 'college' ELSE 'public' END END, CASE WHEN host LIKE '%.edu' THEN 'college' WHEN host LIKE '%.k12.ma.us' OR host LIKE '%publicschool%' THEN 'public'
        WHEN host LIKE '%academy%' OR host LIKE '%prepschool%' OR host LIKE '%school.org' THEN 'private' END, 'none') AS institution, n FROM h LEFT JOIN d USING (domain)""",
    "seed_per_domain_pages": f"""
      WITH p AS (SELECT *, {canonical('url')} AS key, {_SCORE} AS score, {_CAMP_HOST} AS camp FROM ({_PAGES})),
      k AS (SELECT *, CASE WHEN page_id % 10 = 0 THEN 'guide' WHEN score >= 100 THEN 'skip' WHEN camp THEN 'camp' ELSE 'directory' END AS kind FROM p),
      r AS (SELECT *, row_number() OVER (PARTITION BY kind, CASE kind WHEN 'camp' THEN key WHEN 'directory' THEN domain ELSE CAST(page_id AS VARCHAR) END ORDER BY CASE WHEN kind = 'directory' THEN score ELSE 0 END, page_id) AS place FROM k)
      SELECT page_id, kind <> 'skip' AND place = 1 AS kept, CASE WHEN kind = 'skip' THEN 'score' WHEN place = 1 THEN kind ELSE 'duplicate' END AS why FROM r""",
    "domain_cap_pages": f"""
      WITH p AS (SELECT page_id, domain, row_number() OVER (PARTITION BY domain ORDER BY CASE WHEN {_REGISTERS} THEN 1 ELSE 0 END DESC, page_id) AS domain_rank FROM ({_PAGES}))
      SELECT page_id, domain, domain_rank FROM p WHERE domain_rank <= 4""",
    "discovered_registry_pages": f"""
      WITH p AS (SELECT regexp_extract(url, '://[^/]*/([a-z]*)', 1) AS town, replace(authority, 'www.', '') AS host, url, page_id, authority FROM ({_PAGES})),
      o AS (SELECT town, host, min_by(url, page_id) AS url, min(page_id) AS ord, min_by(authority, page_id) AS authority FROM p WHERE NOT {_i('host', H.DENY_HOST)} GROUP BY 1, 2),
      v AS (SELECT town, host, url AS seed, {_VENDOR} AS vendor, ord FROM o), r AS (SELECT *, row_number() OVER (PARTITION BY town ORDER BY CASE WHEN vendor = 'unknown' THEN 1 ELSE 0 END, ord) AS rank FROM v)
      SELECT town, host, seed, vendor, rank FROM r WHERE rank <= 10""",
    "venue_tags_customers": """
      WITH c AS (SELECT c_custkey AS k FROM customer), v AS (SELECT CASE k % 4 WHEN 0 THEN '' WHEN 1 THEN '' WHEN 2 THEN CASE WHEN k % 20 < 25 THEN 'Town' || (k % 20) ELSE '' END ELSE '' END AS geo_town, CASE k % 4 WHEN 0 THEN 'MA' WHEN 1 THEN 'NH' WHEN 2 THEN 'MA' ELSE '' END AS geo_state, k % 4 IN (0, 2) AS geo_keep FROM c)
      SELECT geo_town, geo_state, geo_keep, CASE WHEN geo_keep THEN '' WHEN geo_state = '' THEN 'venue not MA (unknown)' ELSE 'venue not MA (' || geo_state || ')' END AS geo_reject, count(*) AS n FROM v GROUP BY 1, 2, 3, 4""",
    "sql_links_by_host": f"""
      WITH l AS (SELECT {host('url')} AS host, {canonical('url')} AS url, pos, label, lower({path('url')}) AS pth FROM ({LINKS})),
      r AS (SELECT *, CASE WHEN {_i('label', G.JOB_NAME.replace('(?!\\s*[-\\s]?in[-\\s]?training)', ''))} OR regexp_matches(pth, {_q(G.JOB_PATH)}) THEN 'job' WHEN pos % 4 = 1 OR {_i('label', G.LESSON_NAME)} THEN 'lessons'
        WHEN {_i('label', G.RESOURCE_NAME)} OR regexp_matches(pth, {_q(G.RESOURCE_PATH)}) THEN 'resource page' WHEN {_i('label', G.SCHOOL_SERVICE)} OR regexp_matches(pth, {_q(G.SCHOOL_PATH)}) THEN 'school service' END AS reason FROM l)
      SELECT host, regexp_extract(host, '([^.]+\\.[^.]+)$', 1) AS domain, count(*) AS n, count(DISTINCT url) AS urls, count(*) FILTER (pos % 3 = 0) AS summer, count(*) FILTER (reason = 'lessons') AS lessons, count(*) FILTER (reason IS NULL) AS camps FROM r GROUP BY host""",
    "domains_by_rules_pages": f"""
      WITH h AS (SELECT {host('url')} AS h FROM pages),
      s AS (SELECT h, CASE WHEN regexp_matches(h, '(^|\\.)(blog|news)\\.example\\.net$') THEN 'example.net' WHEN regexp_matches(h, '\\.example\\.net$') THEN regexp_extract(h, '([^.]+\\.example\\.net)$', 1)
        WHEN regexp_matches(h, '(^|\\.)example\\.com$') THEN 'example.com' ELSE regexp_extract(h, '([^.]+)$', 1) END AS suffix FROM h)
      SELECT suffix, CASE WHEN h = suffix THEN h ELSE regexp_extract(left(h, length(h) - length(suffix) - 1), '([^.]+)$', 1) || '.' || suffix END AS domain, count(*) AS n FROM s GROUP BY 1, 2""",
    "validated_hits_customers": """
      WITH v(m, verdict, reason, source_type, letters) AS (VALUES (0, 'reject', 'aggregator domain: yelp.com', 'aggregator', 21), (1, 'keep', 'chain branch w/ location: codeninjas.com', 'primary', 44), (2, 'reject', 'aggregator domain: codeninjas.com', 'aggregator', 29),
        (3, 'keep', 'chain branch w/ location: codeninjas.com', 'primary', 25), (4, 'reject', 'out of state: location text (NH)', 'irrelevant', 19), (5, 'keep', 'parent guide (mine outbound): macaronikid.com', 'guide', 30), (6, 'reject', 'url path contains /after-school', 'after_school', 27),
        (7, 'reject', 'title/snippet indicates after-school or non-camp', 'after_school', 16), (8, 'keep', 'summer/camp in metadata', 'unknown', 16), (9, 'keep', 'preferred primary source host/path', 'primary', 28), (10, 'keep', 'passed rules; ambiguous', 'unknown', 18), (11, 'reject', 'empty url', 'irrelevant', 0))
      SELECT verdict, reason, source_type, m = 9 AS preferred, count(*) AS n, CAST(sum(letters + CASE WHEN m = 11 THEN 0 ELSE length(CAST(c_custkey AS VARCHAR)) END) AS BIGINT) AS letters FROM customer JOIN v ON c_custkey % 12 = m GROUP BY 1, 2, 3, 4""",
    "gap_counts_orders": """
      WITH g AS (SELECT o_custkey AS p, CASE WHEN o_orderpriority = '5-LOW' THEN '' ELSE o_orderpriority END AS reason FROM orders WHERE o_orderstatus <> 'F')
      SELECT 'reason' AS kind, reason AS key, count(*) AS n FROM g GROUP BY 2 UNION ALL (SELECT 'provider', CAST(p AS VARCHAR), count(*) FROM g GROUP BY p ORDER BY count(*) DESC, p LIMIT 5)""",
    "funnel_orders": """
      SELECT (SELECT count(*) FROM customer) AS candidates, (SELECT count(*) FROM customer WHERE c_acctbal > 0) AS crawled, count(*) AS links, count(*) FILTER (o_orderkey % 5 = 4) AS clean,
        'junk path=' || count(*) FILTER (o_orderkey % 5 = 1) || ';media=' || count(*) FILTER (o_orderkey % 5 = 0) || ';search or login=' || count(*) FILTER (o_orderkey % 5 = 3) || ';social=' || count(*) FILTER (o_orderkey % 5 = 2) AS slop FROM orders""",
    "out_of_state_customers": """
      SELECT ['national camp index (not a local provider)', 'out-of-state host (ymcacky)', 'out-of-state municipal host (.ky.gov)', 'out-of-state host (city+ky in hostname)', 'out-of-state MyRec host (.ky.myrec.com)', 'location text (NH)', 'Central Kentucky', ''][c_custkey % 8 + 1] AS reason, count(*) AS n
      FROM customer GROUP BY 1""",
    "first_names_parts": """
      SELECT provider_id, ord, name FROM (SELECT p_brand AS provider_id, p_partkey AS ord, CASE WHEN p_partkey % 2 = 0 THEN ' ' || upper(p_name) ELSE p_name END AS name, row_number() OVER (PARTITION BY p_brand, lower(p_name) ORDER BY p_partkey) AS r FROM part) WHERE r = 1""",
    "catalog_segments_pages": f"""
      WITH s AS (SELECT {host('url')} AS host, regexp_extract({path('url')}, '^/([^/]+)/', 1) AS segment, count(*) AS n FROM pages GROUP BY 1, 2)
      SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY host ORDER BY n DESC, segment) AS rank FROM s WHERE segment <> '') WHERE rank <= 4""",
    "nested_payloads_customers": """
      SELECT c_mktsegment AS segment, o_orderstatus, count(*) AS items, count(DISTINCT c_custkey) AS customers, count(DISTINCT o_orderkey) AS orders, CAST(sum(l_quantity) AS BIGINT) AS quantity
      FROM customer JOIN orders ON o_custkey = c_custkey JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1, 2""",
    "structured_events_orders": """
      WITH o AS (SELECT o_custkey AS page_id, o_orderkey AS k, strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') AS d, o_orderstatus <> 'P' AS event FROM orders),
      e AS (SELECT page_id, 'jsonld' AS kind, 'Camp ' || (k % 4) AS name, d AS dates, CAST(k % 7 AS VARCHAR) AS price, k FROM o WHERE event UNION ALL SELECT page_id, 'state', 'Item ' || (k % 3), d, '', k FROM o WHERE k % 5 > 0 UNION ALL SELECT page_id, 'state', 'Camp ' || (k % 4), d || ' - ' || d, '', k FROM o),
      f AS (SELECT page_id, kind, name, dates, count(*) AS n, min(price) AS low, max(price) AS high FROM e GROUP BY 1, 2, 3, 4)
      SELECT kind, CASE WHEN kind = 'state' OR low = '0' THEN '' ELSE '$' || low END AS price, count(*) AS n, count(DISTINCT page_id) AS pages, count(DISTINCT (name, dates)) AS events FROM f GROUP BY 1, 2""",
    "embedded_events_orders": """
      WITH o AS (SELECT o_custkey AS page_id, o_orderkey AS k, strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') AS d FROM orders),
      e AS (SELECT DISTINCT page_id, 'Item ' || (k % 3) AS name, d AS dates FROM o WHERE k % 5 > 0 UNION SELECT page_id, 'Camp ' || (k % 4), d || ' - ' || d FROM o)
      SELECT name, count(*) AS n, count(DISTINCT page_id) AS pages, count(DISTINCT dates) AS dates FROM e GROUP BY 1""",
    "heading_programs_orders": """
      WITH o AS (SELECT o_custkey AS page_id, o_orderkey AS k, o_orderstatus <> 'P' AS named, split_part(o_orderpriority, '-', 2) AS word, o_orderkey % 3 = 0 AS linked FROM orders),
      g AS (SELECT *, sum(CASE WHEN linked THEN 1 ELSE 0 END) OVER (PARTITION BY page_id ORDER BY k DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS part FROM o),
      f AS (SELECT page_id, max(k) FILTER (linked) AS id, min(k) FILTER (named) AS first FROM g WHERE part > 0 GROUP BY page_id, part)
      SELECT f.page_id, CAST(id AS VARCHAR) AS set_id, 'Robots ' || word || ' Grades 2-4: ' || first AS name, 'https://www.hisawyer.com/org/schedules/activity-set/' || id AS info_url, 'Grades 2-4' AS ages FROM f JOIN o ON o.k = f.first""",
    "fallback_rows_suppliers": """
      SELECT s_name || ' — Summer Program' AS name, 'https://s' || s_suppkey || '.example.com/' AS register_url, 'program' AS granularity, 'fallback' AS platform FROM supplier
      WHERE s_acctbal > 0 AND s_suppkey NOT IN (SELECT l_suppkey FROM lineitem GROUP BY 1 HAVING 3 * count(*) FILTER (l_returnflag = 'R') > count(*))""",
    "stale_programs_customers": """
      WITH c AS (SELECT c_nationkey, c_nationkey % 3 > 0 OR c_custkey % 4 = 0 AS program FROM customer)
      SELECT 'https://n' || c_nationkey || '.example.com/x' AS source_url, CASE WHEN program THEN 'program' ELSE 'session' END AS granularity, count(*) AS n FROM c
      WHERE NOT program OR c_nationkey NOT IN (SELECT c_nationkey FROM c WHERE NOT program) GROUP BY 1, 2""",
    "provider_rollup_nations": """
      WITH o AS (SELECT o_custkey AS c_custkey, count(*) AS s, count(*) FILTER (o_orderstatus = 'F') AS r FROM orders GROUP BY 1), c AS (SELECT c_nationkey, count(*) AS p, sum(coalesce(s, 0)) AS s, sum(coalesce(r, 0)) AS r FROM customer LEFT JOIN o USING (c_custkey) GROUP BY 1)
      SELECT n_name AS name, CAST(coalesce(p, 0) AS BIGINT) AS programs, CAST(coalesce(s, 0) AS BIGINT) AS sessions, CAST(coalesce(r, 0) AS BIGINT) AS ready FROM nation LEFT JOIN c ON n_nationkey = c_nationkey""",
    "hub_stats_lineitems": """
      WITH l AS (SELECT l_returnflag AS hub, month(CAST(l_shipdate AS DATE)) BETWEEN 6 AND 8 AS season, l_suppkey % 5 > 0 AS geo, l_linenumber = 1 AS lead FROM lineitem)
      SELECT hub, count(*) AS raw, count(*) FILTER (NOT season) AS season_rejected, count(*) FILTER (season AND NOT geo) AS geo_rejected, count(*) FILTER (season AND geo AND NOT lead) AS collapsed, count(*) FILTER (season AND geo AND lead) AS emitted,
        round(count(*) FILTER (season AND geo AND lead) / count(*), 4) AS emit_rate FROM l GROUP BY 1""",
    "town_counts_suppliers": """
      SELECT town, count(*) AS n FROM (SELECT unnest(CASE WHEN s_acctbal < 0 THEN ['_'] WHEN s_acctbal > 5000 THEN ['N' || s_nationkey, 'N' || (s_nationkey + 1)] ELSE ['N' || s_nationkey] END) AS town FROM supplier) GROUP BY 1""",
    "catalog_holes_customers": f"""
      WITH c AS ({_CUSTOMER_ROWS}), h AS ({_BY_HOST}), k AS (SELECT DISTINCT category, tier FROM c)
      SELECT 'missing_category_' || category AS hole_id, 'missing_category' AS kind, category, '' AS host, CAST(CASE WHEN tier = 'core' THEN 1 ELSE 3 END AS BIGINT) AS priority, replace(category, '_', ' ') || ' summer camp Anytown' AS query FROM k
        WHERE category NOT IN (SELECT category FROM c WHERE v = 'parent_ready')
      UNION ALL SELECT {_gap('missing_provider', 'summer camp registration', 2)} FROM (SELECT DISTINCT 'h' || s_suppkey || '.example.com' AS host FROM supplier) WHERE host NOT IN (SELECT host FROM h WHERE ready > 0)
      UNION ALL SELECT {_gap('brochure_gap', 'summer camp register online', 2)} FROM h WHERE weak AND n >= 2
      UNION ALL SELECT {_gap('failed_enrollment', 'youth summer camp registration catalog', 1)} FROM h WHERE failed AND ready = 0""",
    "provider_manifest": f"""
      WITH t AS ({_TOWNS}), s AS (SELECT s_suppkey, s_name, n_name AS town, CASE WHEN s_suppkey % 2 = 0 THEN 'swimming' ELSE 'chess' END AS category, s_acctbal > 5000 AS ready, 's' || s_suppkey || '.example.com' AS host FROM supplier JOIN nation ON s_nationkey = n_nationkey),
      near AS (SELECT a.town, b.town AS via FROM t a JOIN t b ON {_MILES} <= 10),
      first AS (SELECT near.town, category, min_by(via, host) AS via FROM near JOIN s ON s.town = via WHERE ready GROUP BY 1, 2),
      served AS (SELECT host, string_agg(DISTINCT first.town, ';' ORDER BY first.town) AS towns FROM s JOIN first ON first.via = s.town AND first.category = s.category GROUP BY 1)
      SELECT 'https://' || host || '/x' AS url, s_name AS provider_name, host, coalesce(towns, town) AS towns_served, category AS categories, CASE WHEN ready THEN 'parent_ready' ELSE 'info_confirmed' END AS parent_verdict, CAST(CASE WHEN ready THEN 1 ELSE 2 END AS BIGINT) AS priority
      FROM s LEFT JOIN served USING (host)""",
    "baseline_scores_parts": f"""
      WITH p AS (SELECT p_partkey AS k, lower(p_name) AS norm, lower(replace(p_brand, '#', '-')) || '.example.com' AS host, p_size > 45 AS wrong FROM part), b AS (SELECT * FROM p WHERE k % 2 = 0),
      q AS (SELECT k, CASE WHEN k % 5 < 2 THEN norm || 's' WHEN k % 5 = 2 THEN left(norm, 2) || substr(norm, 4) ELSE norm END AS norm, host, wrong FROM p WHERE k % 3 = 0),
      g AS (SELECT host, norm, bool_or(k % 12 = 0) AS by_url FROM b GROUP BY 1, 2), h AS (SELECT *, by_url OR (host, norm) IN (SELECT (host, norm) FROM q) AS hit FROM g),
      near AS (SELECT DISTINCT host, m FROM ({alike("SELECT DISTINCT h.host, h.norm AS m, q.norm AS n FROM h JOIN q ON h.host = q.host WHERE NOT h.hit")}) WHERE ratio >= 0.75),
      m AS (SELECT count(*) AS programs, count(*) FILTER (hit) AS strict, count(*) FILTER (hit OR (host, norm) IN (SELECT (host, m) FROM near)) AS loose FROM h)
      SELECT programs, (SELECT count(*) FROM b) AS sessions, (SELECT count(*) FROM q) AS published, (SELECT count(DISTINCT host) FROM b) AS providers, round(strict / programs, 4) AS recall_strict, round(loose / programs, 4) AS recall_fuzzy,
        (SELECT round(count(*) FILTER (k % 12 = 0) / count(*), 4) FROM b) AS session_recall, (SELECT round(count(*) FILTER (NOT wrong AND host IN (SELECT host FROM b)) / count(*), 4) FROM q) AS precision,
        round((SELECT count(DISTINCT host) FROM q WHERE host IN (SELECT host FROM b)) / (SELECT count(DISTINCT host) FROM b), 4) AS providers_covered FROM m""",
    "score_run_suppliers": """
      WITH s AS (SELECT s_suppkey AS k, s_acctbal > 0 AS pub, s_acctbal > 0 AND s_suppkey % 3 < 2 AS hit FROM supplier)
      SELECT count(*) AS programs, count(*) FILTER (hit) AS programs_found, count(*) FILTER (k % 2 = 0) AS sessions, count(*) FILTER (hit AND k % 4 = 0) AS sessions_found, count(*) FILTER (pub) AS published, count(*) FILTER (hit) AS published_hit,
        round(count(*) FILTER (hit) / count(*), 6) AS program_recall, round(count(*) FILTER (hit AND k % 4 = 0) / count(*) FILTER (k % 2 = 0), 6) AS session_recall, round(count(*) FILTER (hit) / count(*) FILTER (pub), 6) AS precision FROM s""",
    "session_ids_customers": """
      SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'lex.myrec.com|programid|' || (c_custkey % 100) ELSE 'fuzzy|' || lower(c_mktsegment) || '|024' || (20 + c_nationkey) || '|2026-07-06' END AS session_uid FROM customer""",
    "collapsed_sessions_customers": """
      WITH c AS (SELECT c_custkey AS k, c_custkey // 6 AS six, c_custkey % 6 AS m, (c_custkey // 6) % 3 = 1 AS late FROM customer),
      l AS (SELECT *, k - m + CASE WHEN m = 3 THEN 3 WHEN late AND m IN (1, 2, 4) THEN 1 ELSE 0 END AS lead FROM c)
      SELECT lead AS c_custkey, count(*) AS n_merged, string_agg('hub' || m, ';' ORDER BY k) AS via, '024' || (any_value(six) % 25 + 20) AS geo_zip, NOT ((lead % 6 = 0 AND any_value(late)) OR lead % 6 = 3) AS by_name FROM l GROUP BY lead""",
    "merged_catalog_customers": """
      WITH k AS (SELECT c_custkey AS k FROM customer),
      r AS (SELECT 'engine' AS source, '2026-07-06' AS start_date, CASE WHEN k % 8 = 1 THEN '$5' ELSE '' END AS price, CASE WHEN k % 8 = 1 THEN 'engine;shop' ELSE 'engine' END AS via, CASE WHEN k % 8 = 1 THEN 2 ELSE 1 END AS n_merged, 'MA' AS geo_state FROM k WHERE k % 4 < 2
        UNION ALL SELECT 'gap', '2026-08-03', '', CASE WHEN k % 8 = 2 THEN 'gap;search;hub' ELSE 'gap' END, CASE WHEN k % 8 = 2 THEN 2 ELSE 1 END, CASE WHEN k % 8 = 2 THEN 'MA' ELSE '' END FROM k WHERE k % 4 = 2
        UNION ALL SELECT 'part_d', '2026-08-03', '', 'search', 1, 'MA' FROM k WHERE k % 4 = 3 OR k % 8 = 6)
      SELECT source, start_date, price, via, CAST(n_merged AS BIGINT) AS n_merged, geo_state, geo_state = '' AS no_town, count(*) AS n FROM r GROUP BY ALL""",
    "deduped_published_customers": "SELECT c_custkey, c_acctbal FROM (SELECT *, row_number() OVER (PARTITION BY c_custkey % 100 ORDER BY c_acctbal DESC, c_custkey) AS r FROM customer) WHERE r = 1",
    "grouped_programs_orders": "SELECT o_custkey AS provider_id, 'camp ' || lower(o_orderstatus) AS program_key, 'Camp ' || o_orderstatus AS program_name, count(*) AS sessions FROM orders GROUP BY o_custkey, o_orderstatus",
    "section_pages_parts": "SELECT p_partkey FROM part WHERE p_partkey % 10 <> 0 OR p_type NOT IN (SELECT p_type FROM part WHERE p_partkey % 10 <> 0)",
    "files_split_documents": """
      SELECT CASE WHEN n_chars < 400 THEN 'quarantined' WHEN n_chars > 9000 THEN 'held' ELSE 'kept' END AS status, CASE WHEN n_chars < 400 THEN 'short' WHEN n_chars > 9000 THEN 'long' ELSE '' END AS reason, count(*) AS n FROM documents GROUP BY 1, 2""",
    "files_towns_customers": "SELECT n_name AS town, count(*) AS n, CAST(sum(c_custkey) AS BIGINT) AS ids FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_regionkey <> 1 OR c_acctbal > 0 GROUP BY 1",
    "files_ledger_orders": "SELECT o_orderstatus, count(*) AS n, year(CAST(o_orderdate AS DATE)) || '-12-31' AS run_date FROM orders WHERE year(CAST(o_orderdate AS DATE)) BETWEEN 1992 AND 1998 GROUP BY 1, 3",
    "files_layout_rows": """
      SELECT 'providers' AS file, count(*) AS wrote, count(*) AS n, CAST(sum(length(n_name)) AS BIGINT) AS total FROM nation UNION ALL SELECT 'programs', count(*), count(*), CAST(sum(length(s_name)) AS BIGINT) FROM supplier
      UNION ALL SELECT 'sessions', count(*), count(*), CAST(sum(length(c_name) + 7 + c_nationkey) AS BIGINT) FROM customer UNION ALL SELECT 'gaps', count(*), count(*), CAST(sum(length(p_type)) AS BIGINT) FROM part""",
    "files_town_scan": "SELECT 'town ' || s_nationkey AS town, count(*) AS n, (SELECT count(*) FROM supplier) AS hosts FROM supplier GROUP BY s_nationkey",
    "grid_upsert_orders": """
      SELECT o_orderstatus AS category, coalesce(CAST(nullif(count(*) FILTER (o_orderpriority = '1-URGENT' AND o_totalprice > 250000), 0) AS VARCHAR), '') AS urgent, coalesce(CAST(nullif(count(*) FILTER (o_orderpriority = '5-LOW'), 0) AS VARCHAR), '') AS low FROM orders GROUP BY 1""",
    "stream_yield_stop": """
      WITH e AS (SELECT event_type AS g, event_id AS seq, user_id AS k FROM events), f AS (SELECT g, k, min(seq) AS seq FROM e GROUP BY 1, 2),
      p AS (SELECT e.g, e.seq, CASE WHEN f.k IS NULL THEN 0 ELSE 1 END AS fresh, row_number() OVER (PARTITION BY e.g ORDER BY e.seq) AS place FROM e LEFT JOIN f ON e.g = f.g AND e.seq = f.seq),
      d AS (SELECT *, sum(fresh) OVER (PARTITION BY g ORDER BY seq ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS s FROM p)
      SELECT g AS group, min(seq) AS stop_at FROM d WHERE place >= 50 AND s = 0 GROUP BY 1""",
    "stream_latest_pages": f"""
      WITH p AS (SELECT page_id, {host('url')} AS host, row_number() OVER (PARTITION BY {canonical('url')} ORDER BY page_id DESC) AS r FROM pages WHERE trim(html) <> '')
      SELECT host, count(*) AS n, CAST(sum(page_id) AS BIGINT) AS ids FROM p WHERE r = 1 GROUP BY 1""",
    "stream_new_links": f"SELECT DISTINCT {canonical('url')} AS key FROM pages",
    "stream_hole_states": f"""
      SELECT hole_id, strftime(searched_at, '%Y-%m-%d %H:%M:%S') AS searched_at, attempts, CASE WHEN found THEN 'filled' WHEN attempts >= 6 THEN 'exhausted' ELSE 'searched' END AS status FROM ({_ATTEMPTS})""",
    "stream_running_yields": """
      SELECT user_id, count(*) AS attempts, round(avg(CASE WHEN event_type = 'purchase' THEN 1.0 ELSE 0.0 END), 6) AS mean_yield, max(event_id) FILTER (event_type = 'purchase') AS last_purchase FROM events GROUP BY 1""",
    "stream_batches_hole_states": """
      WITH h AS (SELECT user_id AS hole_id, max(ts) AS last_at, count(*) AS attempts, max_by(event_type = 'purchase', ts) AS found FROM events GROUP BY 1), s AS (SELECT *, CASE WHEN found THEN 'filled' WHEN attempts >= 6 THEN 'exhausted' ELSE 'searched' END AS status FROM h)
      SELECT hole_id, strftime(last_at, '%Y-%m-%d %H:%M:%S') AS searched_at, attempts, CASE WHEN last_at + CASE WHEN status = 'exhausted' THEN INTERVAL 2 DAY ELSE INTERVAL 1 DAY END <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR THEN 'due' ELSE status END AS status FROM s""",
    "stream_batches_seen_links": f"SELECT {canonical('url')} AS key, CAST(min(page_id % 6) AS BIGINT) AS batch FROM pages GROUP BY 1",
    "stream_batches_registry": """
      WITH c AS (SELECT c_custkey AS k, 'h' || (c_custkey % 50) || '.org' AS host, c_mktsegment || repeat('x', CAST(c_custkey % 3 AS INT)) AS name, c_mktsegment AS kind, c_acctbal > 9500 AS ready, 'https://h' || (c_custkey % 50) || '.org/' || ((c_custkey // 50) % 14) AS url FROM customer),
      u AS (SELECT host, url, min(k) AS o FROM c GROUP BY 1, 2), f AS (SELECT *, row_number() OVER (PARTITION BY host ORDER BY o) AS r FROM u), l AS (SELECT host, string_agg(url, ';' ORDER BY o) AS urls FROM f WHERE r <= 10 GROUP BY 1)
      SELECT host, arg_max(name, length(name) * 100000000 - k) AS name, 't' || (min(k) % 4) AS town, array_to_string(list_sort(list(DISTINCT kind)), ';') AS categories, bool_or(ready) AS parent_ready, any_value(urls) AS urls FROM c JOIN l USING (host) GROUP BY host""",
    "stream_batches_alarms": """
      WITH e AS (SELECT user_id, event_type, least((day(ts) - 1) // 5, 5) AS p, count(*) AS n FROM events GROUP BY 1, 2, 3),
      d AS (SELECT coalesce(b.p, a.p + 1) AS batch, coalesce(b.event_type, a.event_type) AS event_type, coalesce(a.n, 0) AS old_n, coalesce(b.n, 0) AS new_n FROM e b FULL JOIN e a ON a.user_id = b.user_id AND a.event_type = b.event_type AND a.p = b.p - 1)
      SELECT CAST(batch AS BIGINT) AS batch, event_type, count(*) AS n, CAST(sum(old_n) AS BIGINT) AS old_n, CAST(sum(new_n) AS BIGINT) AS new_n FROM d WHERE batch BETWEEN 1 AND 5 AND abs(new_n - old_n) / greatest(old_n, 1) > 0.3 GROUP BY 1, 2""",
    "stream_batches_finished": """
      WITH l AS (SELECT 's' || l_suppkey AS provider_id, CAST(CASE WHEN l_orderkey % 100 < 2 THEN l_orderkey % 100 ELSE l_orderkey % 4 + 2 END AS BIGINT) AS batch FROM lineitem)
      SELECT provider_id, count(*) AS items, batch FROM l JOIN (SELECT provider_id, min(batch) AS batch FROM l GROUP BY 1) USING (provider_id, batch) GROUP BY 1, 3""",
    "ranked_gaps_customers": "SELECT c_custkey, c_acctbal, row_number() OVER (ORDER BY c_acctbal DESC, c_custkey) AS place FROM customer",
    "seen_places_events": "SELECT event_type, event_id, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS place FROM events",
}
# The same rows however many batches bring them.
ORACLES |= {"stream_batches_yield_stop": ORACLES["stream_yield_stop"], "stream_batches_pages": ORACLES["stream_latest_pages"]}
