"""DuckDB SQL of op7: rules, outcomes of pages by the documents that they hold, and beta-binomial reputations."""

from __future__ import annotations

from collections.abc import Sequence

from catamill.llm.url_filter import IP, LOWER, SECOND_LEVEL, UPPER, Reputation, Rule

_WHITE = r"[\t\n\x0B\f\r \x{00A0}]+"


def _bare(c: str) -> str:
    return f"regexp_replace({c}, '{_WHITE}', '', 'g')"


def _held(html: str) -> str:
    plain = f"regexp_replace({html}, '(?s)<!--.*?-->', '', 'g')"
    inner = "coalesce(" + ", ".join(f"nullif(regexp_extract({plain}, '(?is)<{tag}\\b[^>]*>(.*?)</{tag}\\s*>', 1), '')" for tag in ("article", "main", "body")) + ")"
    text = f"regexp_replace(regexp_replace({inner}, '(?is)^\\s*<h1\\b[^>]*>.*?</h1\\s*>', ''), '<[^>]*>', '', 'g')"
    for name, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&#x27;", "''"), ("&nbsp;", " "), ("&amp;", "&")):
        text = f"replace({text}, '{name}', '{char}')"
    return text


def _strength(by: str, source: str, p: Reputation) -> str:
    """n, k and the prior's strength m of each group."""
    keys = f"{by}, " if by else ""
    rho = "CASE WHEN (n - n2 / n - (j - 1)) * (k / n) * (1 - k / n) > 1e-9 THEN (k2n - k * k / n - (j - 1) * (k / n) * (1 - k / n)) / ((n - n2 / n - (j - 1)) * (k / n) * (1 - k / n)) END"
    bounded = f"greatest({p.rho_low}, least({p.rho_high}, coalesce({rho}, {p.rho_high})))"
    sums = f"SELECT {keys}sum(n)::DOUBLE AS n, sum(k)::DOUBLE AS k, count(*) FILTER (n > 0) AS j, sum(n * n)::DOUBLE AS n2, coalesce(sum(k * k / n) FILTER (n > 0), 0) AS k2n FROM {source}" + (f" GROUP BY {by}" if by else "")
    return f"SELECT {keys}n, k, (1 - {bounded}) / {bounded} AS m FROM (SELECT {keys}n, k, j, n2, k2n FROM ({sums}))".replace("/ n", "/ nullif(n, 0)")


def sql(rules: Sequence[Rule], p: Reputation = Reputation()) -> str:
    fits = sorted(rules, key=lambda r: (-len(r.text), r.text))
    fit = lambda value: "CASE " + " ".join(f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') THEN '{value(r)}'" for r in fits) + " END"
    last = lambda n: f"regexp_extract(bare, '(?:[^.]*\\.){{0,{n - 1}}}[^.]*$', 0)"
    two = f"regexp_extract(bare, '(?:^|\\.)((?:{'|'.join(SECOND_LEVEL)})\\.[a-z]{{2}})$', 1)"
    return f"""
      WITH pg AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS host, regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path, {_bare(_held("coalesce(html, '')"))} AS held FROM pages),
      marks AS (SELECT {_bare("coalesce(text, '')")} AS key, avg(CASE WHEN quality = 0 THEN 1.0 ELSE 0.0 END) >= 0.5 AS bad FROM documents JOIN labels USING (doc_id) WHERE quality IS NOT NULL GROUP BY 1 HAVING key <> ''),
      outcomes AS (SELECT page_id, count(*) AS n, sum(CASE WHEN bad THEN 1 ELSE 0 END) AS k FROM (SELECT DISTINCT page_id, bad FROM pg JOIN marks ON held = key) GROUP BY 1),
      h0 AS (SELECT host, sum(coalesce(n, 0)) AS n, sum(coalesce(k, 0)) AS k, regexp_replace(host, ':\\d*$', '') AS bare FROM pg LEFT JOIN outcomes USING (page_id) GROUP BY host),
      h1 AS (SELECT *, CASE WHEN regexp_matches(bare, '{IP}') THEN bare WHEN {two} <> '' THEN {two} ELSE {last(1)} END AS suffix FROM h0),
      hosts AS (SELECT host, n, k, suffix, CASE WHEN bare = suffix THEN bare WHEN len(string_split(suffix, '.')) = 2 THEN {last(3)} ELSE {last(2)} END AS domain FROM h1),
      d AS ({_strength("suffix, domain", "hosts", p)}), s AS ({_strength("suffix", "d", p)}), t AS ({_strength("", "s", p)}),
      su AS (SELECT suffix, (s.k + t.m * (t.k + 0.5) / (t.n + 1.0)) / (s.n + t.m) AS up, s.m AS um FROM s, t),
      du AS (SELECT suffix, domain, (k + um * up) / (n + um) AS up, m AS um FROM d JOIN su USING (suffix)),
      fame AS (SELECT host, (k + um * up) / (n + um) AS rate, n + um AS total FROM hosts JOIN du USING (suffix, domain)),
      low AS (SELECT host, rate, greatest(0.0, rate - sqrt(ln(1 / {p.error}) / (2 * (total + 1)))) AS low FROM fame)
      SELECT page_id, host, path, {fit(lambda r: r.text)} AS rule, coalesce({fit(lambda r: r.verdict)}, CASE WHEN low > {p.block_rate} THEN 'block' ELSE 'allow' END) AS verdict, round(rate, 6) AS bad_rate, round(low, 6) AS bad_low
      FROM pg JOIN low USING (host)"""
