"""Ordered rule chains over records: every rejected row keeps the reason of the first check that fails."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catamill.functions import dates as D
from catamill.functions import texts as T
from catamill.functions import urls as U
from catamill.functions.common import UI, all_reasons, blank, distinct_hits, first_nonblank, first_reason, matches, strip, text
from catamill.operators.signals import enrollment
from catamill.session import cut

# Markers of what is no youth camp.
CAMP_WORD = r"\b(?:day\s+camp|summer\s+camp|aileycamp|campers?|camps?)\b"
JOB_NAME = (
    r"\bcounselors?\b(?!\s*[-\s]?in[-\s]?training)|\bnow\s+hiring\b|\bwe'?re\s+hiring\b|\bjob\s+opening|\bjoin\s+our\s+team\b|\bemployment\s+opportunit|\bstaff\s+application\b|\bvolunteer\s+application\b"
)
JOB_PATH = r"/(?:careers?|jobs?|employment|join-our-team|join-us|work-(?:for|with)-us|hiring|staff-application|employment-opportunit)(?:/|$|\?|-)"
LESSON_NAME = (
    r"\blessons?\b|\bopen\s+(?:gym|play|swim|skate|pool|hours?)\b|\bdrop[-\s]?in\b|\bpublic\s+skate\b|\bstick\s*(?:&|and)\s*puck\b|\blap\s+swim\b|\bmasters?\s+swim\b|\bpre[-\s]?swim\b|\bswim\s+club\b|\bopen\s+play\b"
)
RESOURCE_NAME = r"\bnewsletter\b|\bmailing\s+list\b|\bannual\s+report\b|\bpodcast\b|\bpress\s+release\b|\bprivacy\s+policy\b|\bpdf\b|\bdownloads?\b|\bfaqs?\b|\bblog\s+post\b"
RESOURCE_PATH = r"/(?:resources?|resource-center|camp-resources|newsroom|press|blog|news|podcasts?|downloads?|faqs?)(?:/|$)"
SCHOOL_SERVICE = (
    r"\benglish\s+(?:as\s+a\s+)?(?:second|supplemental)\s+language\b|\besl\s+program\b|\bsupplemental\s+language\b|\bfarm\s+to\s+school\b|\btransition\b(?:\s*(?:&|and)\s*\w+)?\s+services?\b"
    r"|\bspecial\s+education\b|\bindividualized\s+education\b|\bchange\s+of\s+address\b|\bwelcome\s+services\b|\bproof\s+of\s+residency\b"
)
SCHOOL_PATH = r"/(?:change-of-address|welcome-services|special-education|esl-program)(?:/|$|-)"
CHILDCARE_NAME = r"\bearly\s+learning\s+center\b|\blearning\s+center\b|\bchild\s*care\b|\bday\s*care\b|\bnursery\b"
YEAR_ROUND = (
    r"\byear[-\s]?round\b", r"\bearly\s+learning\s+center\b", r"\bnursery\s+school\b", r"\binfant\s+care\b", r"\bbefore[-\s]?and[-\s]?after[-\s]?school\b",
    r"\b(?:6|six|8|eight)\s+weeks?\s+(?:to|through|old|[-–])\b", r"\bweeks?\s+(?:to|through|[-–])\s+\d+\s+years?\b",
)
HIGHER_ED = (
    r"\bundergraduate\b|\bgraduate\s+program\b|\bdegree\s+program\b|\bbachelor'?s\b|\bmaster'?s\b|\bdoctoral\b|\bph\.?d\b|\badmissions\b|\bstudy\s+abroad\b|\bcontinuing\s+education\b"
    r"|\bprofessional\s+development\b|\bfor\s+credit\b|\bcollege\s+credit\b|\bcredit-?bearing\b|\bfinancial\s+aid\b|\bmatriculat|\balumni\b|\bfaculty\b|\bsemester\b|\benroll\s+in\s+courses\b"
)
YOUTH = (
    r"\byouth\b|\bkids?\b|\bchildren\b|\bteens?\b|\bhigh\s+school\b|\bmiddle\s+school\b|\belementary\b|\bgrades?\s*[k0-9]|\brising\s+(?:[1-9]|k)\b|\bpre-?college\b|\bages?\s*\d|\bcampers?\b|\bk-?12\b"
    r"|\bboys?\b|\bgirls?\b|\bentering\s+grade"
)
YOUTH_AGE = r"ages?\s*:?\s*\d|grades?\s*:?\s*(?:[k0-9]|pre)|\bpre-?k\b|kindergart|\byouth\b|rising\s+(?:[1-9]|k)|preschool|toddler"
ADULT = r"\b(?:adults?\s+only|for\s+adults|18\s*\+|21\s*\+|senior|membership|men'?s\s+league|women'?s\s+league|fundraiser|donation)\b"
ADULT_AUDIENCE = r"\bfor\s+adults?\b|\badults?\s+only\b|\b(?:18|21)\s*\+"
FITNESS = r"\b(yoga|pilates|zumba|aerobics|cardio(?:vascular)?|strength|crossfit|boot\s*camp|pickleball|personal\s+train\w+|group\s+fitness|muscle\s+conditioning|bone\s+health|tai\s+chi)\b"
CLINICAL = r"\b(clinic(?:al|ian)|therap\w+|intervention|diagnos\w+|referral|patients?|psychiat\w+|outpatient|treatment|social\s+work)\b"
OTHER_STATES = (
    "alabama", "alaska", "arizona", "arkansas", "california", "colorado", "connecticut", "delaware", "florida", "georgia", "hawaii", "idaho", "illinois", "indiana", "iowa", "kansas", "kentucky",
    "louisiana", "maine", "maryland", "michigan", "minnesota", "mississippi", "missouri", "montana", "nebraska", "nevada", "new-hampshire", "new-jersey", "new-mexico", "new-york",
    "north-carolina", "north-dakota", "ohio", "oklahoma", "oregon", "pennsylvania", "rhode-island", "south-carolina", "south-dakota", "tennessee", "texas", "utah", "vermont", "virginia",
    "washington", "west-virginia", "wisconsin", "wyoming",
)
STATE_CODES = "al|ak|az|ar|ca|co|ct|de|fl|ga|hi|id|il|in|ia|ks|ky|la|me|md|mi|mn|ms|mo|mt|ne|nv|nh|nj|nm|ny|nc|nd|oh|ok|or|pa|ri|sc|sd|tn|tx|ut|vt|va|wa|wv|wi|wy"
AUDIENCE = r"(?i)(adult|senior|18\+|21\+|parent night|bird walk)"


def has_camp_word(name: Column) -> Column:
    return matches(name, CAMP_WORD) & ~text(name).rlike(r"(?i)^\W*boot\s*camp\W*$")


def other_state(url: Column) -> Column:
    at = F.lower(U.path(url))
    return at.rlike(rf"/(?:{'|'.join(OTHER_STATES)})(?:/|$)") | at.rlike(rf"/(?:{STATE_CODES})/(?=[a-z])")


def noncamp_reason(name: Column, info_url: Column, register_url: Column, page: Column, summer: Column) -> Column:
    """Why a record is no youth summer camp, or null; only the first 4000 characters of the page count."""
    info, register = F.lower(U.path(info_url)), F.lower(U.path(register_url))
    blob = F.concat(text(name), F.lit(" "), F.substring(text(page), 1, 4000))
    markers = sum((F.when(matches(blob, m), 1).otherwise(0) for m in YEAR_ROUND), F.lit(0))
    camp = has_camp_word(name)
    return first_reason([
        ("job", matches(name, JOB_NAME) | info.rlike(JOB_PATH) | register.rlike(JOB_PATH)),
        ("lessons", matches(name, LESSON_NAME) & ~camp),
        ("resource page", matches(name, RESOURCE_NAME) | info.rlike(RESOURCE_PATH)),
        ("school service", matches(blob, SCHOOL_SERVICE) | info.rlike(SCHOOL_PATH) | register.rlike(SCHOOL_PATH)),
        ("year-round childcare", ~summer & ((matches(name, CHILDCARE_NAME) & ~camp) | (markers >= 2) | ((markers >= 1) & ~camp))),
        ("higher education", ~matches(blob, YOUTH) & (distinct_hits(blob, HIGHER_ED) >= 2)),
    ])


#: Sessions whose checks one task works out.
TASK_ROWS = 500


def _tasks(spark: SparkSession, rows: int) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // TASK_ROWS))


def with_page(sessions: DataFrame, pages: DataFrame, asked: DataFrame, key: str, name: str, heavy_rows: int = 1000) -> DataFrame:
    """sessions with the text of the page that their column `key` names, as column `name`; null where there is none. pages:
    key (canonical), text; of several texts of one address the greatest. asked: the keys of all sessions, one row each,
    known before costly columns of sessions are worked out; texts that none of them asks for are not moved.

    Rows come in parts of about TASK_ROWS, however small their table is. Keys that a 64th of the sessions share (and
    heavy_rows of them), and rows without a key, are dealt over 64 of them, so that no task gets all rows of one page."""
    counts = asked.groupBy(key).agg(F.count("*").alias("n"))
    rows = asked.count()
    heavy = [r[0] for r in counts.where(F.col(key).isNotNull() & (F.col("n") >= heavy_rows) & (F.col("n") * 64 >= rows)).select(key).collect()]  # 64 at most
    parts = F.when(F.col(key).isin(heavy), 64).otherwise(1)
    some = counts.where(F.col(key).isNotNull()).select(F.col(key).alias("key"))
    one = pages.join(some, "key", "left_semi").groupBy(F.col("key").alias(key)).agg(F.max("text").alias(name))
    one = one.withColumn("__part", F.explode(F.sequence(F.lit(0), parts - 1))).withColumn("__part", F.col("__part").cast("long"))
    dealt = sessions.withColumn("__part", F.pmod(F.xxhash64(*sessions.columns), F.when(F.col(key).isNull(), 64).otherwise(parts)).cast("long"))
    return dealt.repartition(_tasks(sessions.sparkSession, rows), key, "__part").join(one, [key, "__part"], "left").select(*sessions.columns, name)


#: Evidence of audience, category or none, whose rows a person may still publish.
SOFT = ("adult evidence", "no evidence", "job", "lessons", "resource page", "school service", "year-round childcare", "higher education")


def judged_sessions(sessions: DataFrame, pages: DataFrame, *, min_chars: int = 400, accept_iso: bool = False) -> DataFrame:
    """sessions, with clean ages, and `evidence` (the first check that fails, in a fixed order; null: none) and `ready`
    (null unless all checks pass: whether the register page takes registrations). Checks behind the first that fails are
    not worked out, and only rows that pass all of them meet their register page."""
    name = first_nonblank(F.col("name"), F.col("program_name"))
    # What names and addresses tell needs no page; the rows that they hold back are not joined.
    held = F.coalesce(F.concat(F.lit("program: "), T.bad_name_reason(F.col("program_name"))), T.bad_name_reason(name), F.when(other_state(F.col("info_url")) | other_state(F.col("register_url")), F.lit("out of state")))
    even = sessions.repartition(_tasks(sessions.sparkSession, sessions.count()), *sessions.columns)  # a small table is one task's, but its checks are many
    early = even.withColumn("evidence", held).withColumns({k: F.when(F.col("evidence").isNull(), U.canonical_url(F.col(c))) for k, c in (("info_key", "info_url"), ("register_key", "register_url"))})
    early = cut(early)  # without texts
    refused = early.where(F.col("evidence").isNotNull()).withColumns({"ages": T.clean_age(F.col("ages")), "ready": F.lit(None).cast("boolean")})
    s = asked = early.where(F.col("evidence").isNull()).drop("evidence")
    s = with_page(s, pages, asked, "info_key", "info_text")
    info, n = text("info_text"), F.length(text("info_text"))
    ages = T.clean_age(F.col("ages"))
    summer = D.starts_in_summer(F.col("dates"), accept_iso)
    own = F.concat_ws(" ", text("dates"), ages, text("price"))
    both = F.concat(own, F.lit(" "), F.substring(info, 1, 4000))
    has_dates = ~blank("dates")
    field_evidence = (has_dates & summer) | matches(own, YOUTH_AGE)
    scoped = F.coalesce("camp_scoped", F.lit(False))
    no_youth = ~matches(both, YOUTH_AGE)
    top = F.substring(info, 1, 4000)
    evidence = F.coalesce(
        first_reason([("info page not fetched", F.col("info_text").isNull()), ("info page too short", n < min_chars), ("name absent from info page", ~T.name_in_text(name, info))]),
        noncamp_reason(name, F.col("info_url"), F.col("register_url"), info, has_dates & summer),
        F.when(
            T.is_adult_age(ages) | matches(own, ADULT) | (matches(top, ADULT_AUDIENCE) & no_youth) | (matches(top, ADULT) & no_youth & ~field_evidence & ~scoped)
            | (~scoped & (distinct_hits(top, FITNESS, 1) >= 2) & no_youth), F.lit("adult evidence")),
        F.when(~scoped & (distinct_hits(F.substring(info, 1, 5000), CLINICAL, 1, 7) >= 2), F.lit("clinical context")),
        F.when(has_dates & ~summer, F.lit("off-season dates")),
        F.when(~scoped & ~field_evidence, F.lit("no evidence")),
    )
    s = s.withColumn("evidence", evidence)
    passed = F.col("evidence").isNull()
    s = s.withColumns({"info_text": F.when(passed, F.col("info_text")), "register_key": F.when(passed, F.col("register_key"))})
    s = with_page(s, pages, asked, "register_key", "register_text")
    signals = enrollment(first_nonblank(F.col("register_url"), F.col("info_url")), first_nonblank(F.col("register_text"), F.col("info_text")), name)
    s = s.withColumns({"ready": F.when(passed, F.coalesce(signals["auto_verdict"] == "parent_ready", F.lit(False))), "ages": ages})
    columns = [*sessions.columns, "evidence", "ready"]
    return s.select(*columns).unionByName(refused.select(*columns))


def publish_judged(judged: DataFrame, include_review: Column) -> DataFrame:
    """judged (as judged_sessions gives it) with `status` (published or gap), `reason`, `evidence` and `verdict`; where
    include_review holds, rows that fail for audience, category or evidence are published for review instead."""
    passes, evidence = F.col("evidence").isNull(), F.col("evidence")
    review = F.coalesce(evidence.isin(*SOFT) & include_review, F.lit(False))
    verdict = F.when(passes, F.when(F.col("ready"), "parent_ready").otherwise("info_confirmed")).when(review, "needs_review")
    name = first_nonblank(F.col("name"), F.col("program_name"))
    out = judged.withColumns({
        "status": F.when(verdict.isNotNull(), "published").otherwise("gap"),
        "reason": F.when(verdict.isNull(), F.when(evidence.isin("info page not fetched", "info page too short"), "empty").otherwise("needs_review")),
        "verdict": verdict, "name": F.when(passes, T.prefixed_name(name, F.col("provider_name"))).otherwise(F.col("name")),
    })
    return out.select(*[c for c in judged.columns if c not in ("evidence", "ready")], "status", "reason", "evidence", "verdict")


def publish_gate(sessions: DataFrame, pages: DataFrame, *, min_chars: int = 400, include_review: bool = False, accept_iso: bool = False) -> DataFrame:
    """sessions (program_name, provider_name, name, info_url, register_url, dates, ages, price, camp_scoped) with `status`
    (published or gap), `reason`, `evidence` and `verdict`. Checks run in a fixed order and the first that fails is the
    reason; with include_review, rows that fail for audience, category or evidence are published for review instead."""
    return publish_judged(judged_sessions(sessions, pages, min_chars=min_chars, accept_iso=accept_iso), F.lit(include_review))


def quality_tier(rows: DataFrame) -> DataFrame:
    """rows (name, register_url, source_url, platform, kind, granularity) with quality_tier and quality_reason."""
    url, source = text("register_url"), first_nonblank(F.col("source_url"), F.col("register_url"))
    signup = U.is_registration(url) | (U.stable_id(url) != "")
    bare = lambda c: F.regexp_replace(c, "/+$", "")
    rejected = first_reason([
        ("out of state", other_state(url)),
        ("program hub page", F.lower(U.path(url)).rlike(r"/(?:programs?|activities|recreation)/?$") & ~U.is_registration(url)),
        ("junk register URL", F.lower(url).rlike(r"\.pdf(?:$|\?)|/index\.(?:html?|php)$") | U.is_media(url)),
    ])
    program = text("granularity") == "program"
    weak = first_reason([
        ("provider-level program row", program & (U.registration_priority(url) == 0)),
        ("model session with marketing page as register URL", (text("platform") == "llm") & ~signup & (bare(url) == bare(source))),
        ("model session without platform register URL", (text("platform") == "llm") & ~signup),
        ("portal entry", (text("kind") == "portal") & ~U.is_registration(url) & ~program),
        ("register URL not on known platform", ~program & ~signup & (url != "") & (url != source)),
        ("no registrable URL found", ~program & ~signup),
    ])
    return rows.withColumns({
        "quality_tier": F.when(rejected.isNotNull(), "rejected").when(weak.isNotNull(), "needs_trail").otherwise("registrable"),
        "quality_reason": F.coalesce(rejected, weak, F.when(program, "provider program row with platform register URL").otherwise("platform register URL")),
    })


def publish_rows(rows: DataFrame, *, year: int, allowed: tuple[str, ...] = ("parent_ready", "brochure_only")) -> DataFrame:
    """rows (parent_verdict, granularity, dates, name) with held_reason (null: published) and label."""
    verdict = F.trim(text("parent_verdict"))
    span = D.date_span(F.col("dates"), year)
    sane = F.coalesce((span["first"] <= F.make_date(F.lit(year), F.lit(9), F.lit(30))) & (span["last"] >= F.make_date(F.lit(year), F.lit(5), F.lit(1))), F.lit(False))
    held = first_reason([
        (F.when(verdict == "", "unverified").otherwise(F.concat(F.lit("verdict:"), verdict)), ~verdict.isin(*allowed)),
        ("date_sanity", (first_nonblank(F.col("granularity"), F.lit("session")) == "session") & ~sane),
        ("audience_keyword", text("name").rlike(AUDIENCE) & (verdict != "parent_ready")),
    ])
    return rows.withColumns({"held_reason": held, "label": F.when(held.isNull(), F.when(verdict == "brochure_only", "brochure_only").otherwise(""))})


# Form hosts that take registrations for others, and paths that are never about camps.
REGISTER_HOSTS = (
    "jotform.com", "docs.google.com", "forms.gle", "forms.office.com", "regfox.com", "wufoo.com", "formstack.com", "typeform.com", "eventbrite.com", "signupgenius.com", "campscui.active.com",
)
OFF_TOPIC = r"/(?:research|clinical|psychiatry|imaging|radiology|oncology|pubmed|faculty|publications?|careers?|investor|press|newsroom|patient)\b"


def offhost_register(register_url: Column, *references: Column) -> Column:
    """Whether a registration leaves the domains of its references and is on no known registration or form host."""
    allowed = functools.reduce(lambda x, y: x | y, [F.contains(U.authority(register_url), F.lit(h)) for h in REGISTER_HOSTS])
    domains = F.filter(F.array(*[U.registered_domain(U.authority(r)) for r in references]), lambda d: d != "")
    own = U.registered_domain(U.authority(register_url))
    return (own != "") & ~U.is_registration(register_url) & ~allowed & (F.size(domains) > 0) & ~F.array_contains(domains, own)


def junk_reasons(rows: DataFrame) -> DataFrame:
    """rows (name, register_url, info_url, source_url, granularity, ages, dates, price) with `reasons`, all that apply: names,
    links, evidence (not asked of program rows) and topic."""
    raw = strip(text("name"))
    chrome = F.coalesce(T.bad_name_reason(raw) == "chrome name", F.lit(False))
    unusable = T.bad_name_reason(raw).isNotNull() | F.lower(raw).rlike(r"^[a-z]{18,}$")
    c = lambda n: F.col(n) if n in rows.columns else F.lit("")
    off_topic = functools.reduce(lambda x, y: x | y, [U.path(c(n)).rlike("(?i)" + OFF_TOPIC) for n in ("register_url", "info_url", "source_url")])
    return rows.withColumn("reasons", all_reasons([
        ("chrome_name", chrome), ("unusable_name", ~chrome & unusable), ("no_register_url", blank("register_url")),
        ("offhost_register", ~blank("register_url") & offhost_register(F.col("register_url"), c("info_url"), c("source_url"))),
        ("no_evidence", (text("granularity") != "program") & ~T.has_evidence(F.col("ages"), F.col("dates"), F.col("price"))), ("off_topic", off_topic),
    ]))


def season_filter(rows: DataFrame, *, year: int, first: str = "06-01", last: str = "08-31") -> DataFrame:
    """rows with start_date (parsed), season_source and in_season; undated rows are in season."""
    day = D.first_date(F.concat_ws(" ", *[F.nullif(text(c), F.lit("")) for c in ("start_date", "dates", "details_text") if c in rows.columns]), year)
    # The day is a column first, so that its patterns run once a row.
    dated = rows.withColumn("start_day", day)
    return dated.withColumns({"season_source": F.when(F.col("start_day").isNull(), "undated").otherwise("dated"), "in_season": F.coalesce(D.in_season(F.col("start_day"), first, last), F.lit(True))})


def register_gate(rows: DataFrame, checks: DataFrame) -> DataFrame:
    """rows (register_url, registrable, parent_ready) against one check per address (url, status, html): a failed check
    demotes, a missing one doesn't."""
    one = checks.groupBy("url").agg(F.first("status").alias("c_status"), F.first("html").alias("c_html"))
    j = rows.join(one.withColumnRenamed("url", "register_url"), "register_url", "left")
    asked = F.coalesce("registrable", F.lit(True)) & F.coalesce("parent_ready", F.lit(True))
    status = F.coalesce("c_status", F.lit(0))
    why = F.when(blank("register_url"), F.lit("no register_url")).when(status <= 0, F.lit("unchecked")).when(status >= 400, F.concat(F.lit("register_url "), status)).when(~T.has_affordance(F.col("c_html")), F.lit("no registration affordance")).otherwise("200+affordance")
    ok = ~asked | why.isin("unchecked", "200+affordance")
    return j.select(*[c for c in rows.columns if c not in ("registrable", "parent_ready")], *[F.when(ok, F.col(c)).otherwise(False).alias(c) for c in ("registrable", "parent_ready")], F.when(asked, why).alias("gate_reason"))


def violations(table: DataFrame, key: str, rules: dict[str, Column], unique: str | None = None) -> DataFrame:
    """key, rule for every row that breaks a rule, and for every value of `unique` that stands more than once."""
    out = table.select(F.col(key).cast("string").alias("key"), F.explode(all_reasons([(name, ~F.coalesce(ok, F.lit(False))) for name, ok in rules.items()])).alias("rule"))
    if unique:
        twice = table.groupBy(unique).count().where(F.col("count") > 1)
        out = out.unionByName(twice.select(F.col(unique).cast("string").alias("key"), F.lit(f"unique {unique}").alias("rule")))
    return out
