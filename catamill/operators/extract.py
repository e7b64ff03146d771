"""Extraction of records: payload flattening, embedded structured data, item links, page-level records and batch rules."""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from catamill.functions import dates as D
from catamill.functions import texts as T
from catamill.functions import urls as U
from catamill.functions.common import first_nonblank, text
from catamill.session import cut

EVENT = ArrayType(StructType([StructField(c, StringType()) for c in ("name", "dates", "price", "register_url")]))
#: Types of structured data that are events.
EVENT_TYPES = ("event", "eventseries", "course", "courseinstance", "educationevent", "businessevent", "childrensevent", "socialevent", "camp")


def flatten_payload(rows: DataFrame, column: str, schema: str, explode: str | None = None) -> DataFrame:
    """rows without the JSON text, with the fields of the schema in its place; explode: an array field, one row each."""
    parsed = rows.withColumn(column, F.from_json(column, schema))
    if explode:
        out = parsed.withColumn(column, F.explode(f"{column}.{explode}"))
        return out.select(*[c for c in rows.columns if c != column], f"{column}.*")
    return parsed.select(*[c for c in rows.columns if c != column], f"{column}.*")


def flatten_nested(rows: DataFrame, column: str, schema: str, path: Sequence[str]) -> DataFrame:
    """rows with one row for each entry of the arrays that `path` names, each inside the one before: `orders`, then `lines`
    of an order. Fields beside an array go along, those of inner ones after those of outer ones; entries without an inner
    array, or with an empty one, go. JSON that doesn't parse gives no rows."""
    out = rows.select(*[c for c in rows.columns if c != column], F.from_json(column, schema).alias(column))
    for name in path:
        kept = [f.name for f in out.schema[column].dataType.fields if f.name != name]
        out = out.select(*[c for c in out.columns if c != column], *[F.col(f"{column}.{f}").alias(f) for f in kept], F.explode(f"{column}.{name}").alias(column))
    return out.select(*[c for c in out.columns if c != column], f"{column}.*")


def json_objects(rows: DataFrame, key: str, column: str) -> DataFrame:
    """key, place, node: every object anywhere in the JSON texts of a column (several texts a row: an array), as a variant,
    with the places that lead to it, so that outer objects stand before inner ones. Texts that don't parse are passed over.

    One lateral join a level, as deep as the deepest text; each level's rows are those of the level before, opened."""
    spark, texts = rows.sparkSession, F.col(column)
    texts = texts if dict(rows.dtypes)[column].startswith("array") else F.array(texts)
    # Parsed before they are opened, so that the test for what has something inside doesn't parse them again. It looks at a
    # node's own kind: the schema of a node is that of all that is inside.
    level = rows.select(F.col(key), F.posexplode(F.transform(texts, F.try_parse_json)).alias("at", "node")).select(key, F.array("at").alias("place"), "node")
    is_object = F.try_variant_get("node", "$", "struct<>").isNotNull()
    out = None
    while True:
        level = cut(level.where(is_object | F.try_variant_get("node", "$[0]", "variant").isNotNull()))
        if not level.limit(1).count():
            return out if out is not None else level
        found = level.where(is_object)
        out = found if out is None else out.unionByName(found)
        opened = level.lateralJoin(spark.tvf.variant_explode(F.col("node").outer()))
        level = opened.select(key, F.concat("place", F.array("pos")).alias("place"), F.col("value").alias("node"))


def embedded_state_events(pages: DataFrame) -> DataFrame:
    """page_id, name, dates, price, register_url of every object in a page's embedded application state that has a name or
    title and a start, each (name, dates) of a page once, the first by place. The walk is native, whatever the nesting."""
    some = pages.select("page_id", F.regexp_extract_all(text("html"), F.lit(r"(?is)<script[^>]*application/json[^>]*>(.*?)</script>"), F.lit(1)).alias("blocks"))
    starts, ends = ("startDate", "start_date", "startsAt"), ("endDate", "end_date", "endsAt")
    fields = F.try_variant_get("node", "$", f"struct<{', '.join(f'{n}: variant' for n in ('name', 'title', *starts, *ends, 'price', 'url'))}>")
    get = lambda x, *names: F.coalesce(*[F.nullif(F.try_variant_get(x[n], "$", "string"), F.lit("")) for n in names])
    is_text = lambda x, *names: F.coalesce(*[F.nullif(F.schema_of_variant(x[n]), F.lit("VOID")) for n in names], F.lit("")) == "STRING"
    # A node's fields are taken out of it once; what is no event goes before its texts are made.
    one = F.filter(F.array(fields), lambda x: is_text(x, "name", "title") & is_text(x, *starts))
    e, x = json_objects(some, "page_id", "blocks").select("page_id", "place", F.explode(one).alias("x")), F.col("x")
    dates = F.concat_ws(" - ", F.substring(get(x, *starts), 1, 10), F.substring(get(x, *ends), 1, 10))
    e = e.select("page_id", "place", F.trim(get(x, "name", "title")).alias("name"), dates.alias("dates"), F.coalesce(get(x, "price"), F.lit("")).alias("price"), F.coalesce(get(x, "url"), F.lit("")).alias("register_url"))
    # A page's events come from one task of the walk anyway; dealt by page they are put in order once, not before and after.
    return e.repartition("page_id").groupBy("page_id", F.lower("name").alias("k"), "dates").agg(F.min_by(F.struct("name", "price", "register_url"), "place").alias("f")).select("page_id", "f.name", "dates", "f.price", "f.register_url")


def _nodes(x: object) -> Iterator[dict]:
    """All objects inside parsed JSON, outer ones first."""
    todo = [x]
    while todo:
        x = todo.pop(0)
        if isinstance(x, dict):
            yield x
            todo = list(x.values()) + todo
        elif isinstance(x, list):
            todo = x + todo


def _graph(x: object) -> Iterator[dict]:
    """The objects that a JSON-LD block lists: those of a graph before the object that holds it."""
    if isinstance(x, list):
        for item in x:
            yield from _graph(item)
    elif isinstance(x, dict):
        if isinstance(x.get("@graph"), list):
            yield from _graph(x["@graph"])
        yield x


def _event(node: dict) -> dict | None:
    kinds = node.get("@type")
    kinds = kinds if isinstance(kinds, list) else [kinds]
    name = str(node.get("name") or "").strip()
    if not name or not any(str(k).lower() in EVENT_TYPES for k in kinds):
        return None
    first, last = (str(node.get(k) or "").strip().split("T")[0] for k in ("startDate", "endDate"))
    offer = node.get("offers")
    offer = offer[0] if isinstance(offer, list) and offer else offer
    offer = offer if isinstance(offer, dict) else {}
    amount, currency = offer.get("price") or offer.get("lowPrice"), offer.get("priceCurrency", "")
    return {
        "name": name, "dates": f"{first} – {last}" if first and last and last != first else first or last,
        "price": "" if amount in (None, "") else f"${amount}" if currency in ("", "USD") else f"{currency} {amount}", "register_url": str(offer.get("url") or node.get("url") or ""),
    }


def _state_event(node: dict) -> dict | None:
    name = node.get("name") or node.get("title")
    start = node.get("startDate") or node.get("start_date") or node.get("startsAt")
    if not (isinstance(name, str) and isinstance(start, str)):
        return None
    end = node.get("endDate") or node.get("end_date") or node.get("endsAt") or ""
    return {"name": name.strip(), "dates": " - ".join(str(d)[:10] for d in (start, end) if d), "price": str(node.get("price") or ""), "register_url": str(node.get("url") or "")}


#: The plainer form's types.
PLAIN_TYPES = ("event", "childrensevent", "course", "educationevent", "camp")


def _plain_event(node: dict) -> dict | None:
    """Of fewer types, with the first day alone."""
    e = _event(node) if isinstance(node.get("@type"), (str, list)) else None
    kinds = node.get("@type")
    kinds = kinds if isinstance(kinds, list) else [kinds]
    if e is None or not any(str(k).lower() in PLAIN_TYPES for k in kinds):
        return None
    return {"name": e["name"], "dates": str(node.get("startDate") or "").split("T")[0], "price": "", "register_url": ""}


def _found(blocks: list[str], pick, walk, once: bool = True) -> list[dict]:
    """Events of the blocks that parse, each (name, dates) once, or as often as they stand there."""
    out, seen = [], set()
    for block in blocks:
        try:
            data = json.loads(block)
        except ValueError:
            continue
        for node in walk(data):
            if (e := pick(node)) and ((key := (e["name"].lower(), e["dates"])) not in seen or not once):
                seen.add(key)
                out.append(e)
    return out


@F.pandas_udf(EVENT)
def jsonld_events(blocks: pd.Series) -> pd.Series:
    """Events of a page's JSON-LD blocks (array of texts); blocks that don't parse are passed over."""
    return blocks.map(lambda b: _found(list(b) if b is not None else [], _event, _graph))


@F.pandas_udf(EVENT)
def state_events(blocks: pd.Series) -> pd.Series:
    """Events of embedded application state: any object with a name or title and a start."""
    return blocks.map(lambda b: _found(list(b) if b is not None else [], _state_event, _nodes))


@F.pandas_udf(EVENT)
def plain_jsonld_events(blocks: pd.Series) -> pd.Series:
    """The plainer form: fewer types, the first day alone, repeated events as often as they stand there."""
    return blocks.map(lambda b: _found(list(b) if b is not None else [], _plain_event, _graph, once=False))


def structured_events(pages: DataFrame, plain: bool = False) -> DataFrame:
    """page_id, kind, name, dates, price, register_url of all structured events; pages without blocks never reach Python."""
    parts = []
    for kind, pattern, f in (("jsonld", r"(?is)<script[^>]*application/ld\+json[^>]*>(.*?)</script>", plain_jsonld_events if plain else jsonld_events), ("state", r"(?is)<script[^>]*application/json[^>]*>(.*?)</script>", state_events)):
        some = pages.select("page_id", F.regexp_extract_all(text("html"), F.lit(pattern), F.lit(1)).alias("blocks")).where(F.size("blocks") > 0)
        parts.append(some.select("page_id", F.lit(kind).alias("kind"), F.inline(f("blocks"))))
    return parts[0].union(parts[1])


#: Fixed value: the first line of a page's structured programmes.
SUMMARY_HEAD = "## STRUCTURED PROGRAMS (embedded schema.org data)"


def events_summary(events: DataFrame, key: str = "page_id") -> DataFrame:
    """One line of text per event under a heading, one text per page."""
    line = F.concat(F.lit("- "), F.concat_ws(" | ", "name", *[F.nullif(text(c), F.lit("")) for c in ("dates", "price")]))
    return events.groupBy(key).agg(F.concat(F.lit(SUMMARY_HEAD + "\n"), F.array_join(F.array_sort(F.collect_list(line)), "\n")).alias("summary"))


def collapse_item_links(links: DataFrame, by: Sequence[str]) -> DataFrame:
    """Anchors (url, label, pos) of one item become one: the longest label (the first among equals), first place and address."""
    return links.groupBy(*by).agg(F.max_by("label", F.struct(F.length("label"), -F.col("pos"))).alias("name"), F.min_by("url", "pos").alias("url"), F.min("pos").alias("pos"), F.count("*").alias("n"))


def best_register_link(links: DataFrame, host: Column, least: int = 40) -> DataFrame:
    """Per page the link with the best score, off-host ones only on registration platforms; the first among equals."""
    ok = (U.host_of(F.col("url")) == host) | U.is_registration(F.col("url"))
    return links.where(ok & (F.col("score") >= least)).groupBy("page_id").agg(F.max_by("url", F.struct("score", -F.col("pos"))).alias("register_url"))


def page_record(pages: DataFrame, links: DataFrame) -> DataFrame:
    """One record per page by rules: name from heading, title or address, best register link, first age and summer date, and a status where neither is there."""
    grab = lambda p: T.strip(F.regexp_replace(F.regexp_extract(text("html"), p, 1), r"(?U)(?:<[^>]+>|\s)+", " "))
    slug = F.initcap(F.translate(F.regexp_extract(U.path(F.col("url")), r"/([^/.]+)(?:\.\w+)?/?$", 1), "-_", "  "))
    body = T.html_to_text(F.col("html"))
    p = pages.withColumns({"page_text": body, "name": first_nonblank(grab(r"(?is)<h1[^>]*>(.*?)</h1>"), grab(r"(?is)<title[^>]*>(.*?)</title>"), slug)})
    joined = links.join(p.select("page_id", U.host_of(F.col("url")).alias("page_host")), "page_id")
    p = p.join(best_register_link(joined, F.col("page_host")), "page_id", "left")
    ages = F.regexp_extract("page_text", r"(?i)\b(ages?\s*:?\s*\d{1,2}\s*(?:-|–|to)\s*\d{1,2}|ages?\s*:?\s*\d{1,2}\s*\+)", 1)
    dates = F.regexp_extract("page_text", r"(?i)\b((?:june|july|august)\s+\d{1,2}(?:\s*[-–]\s*(?:[a-z]+\s+)?\d{1,2})?)", 1)
    status = F.when(F.col("register_url").isNull() & (T.page_status(F.col("page_text")) != "ok"), T.page_status(F.col("page_text"))).otherwise("ok")
    return p.select("page_id", "url", "name", F.coalesce("register_url", F.lit("")).alias("register_url"), ages.alias("ages"), dates.alias("dates"), status.alias("status"))


#: Pages of activity sets, headings that name no programme, and grades in names.
ACTIVITY_SET = r"hisawyer\.com/([\w-]+)/schedules/activity-set/(\d+)"
NOISE_HEADING = r"summer camps|new for|returning favorites|program details|frequently asked|add-on|stay connected|unlock|we make"
GRADES = r"(?:gr|grades?)\.?\s*:?\s*(?:rising\s*)?[k0-9][\s\-–toandk0-9]{0,12}"
LONGEST_HEADING = 70


def page_parts(pages: DataFrame, link: str = r"<a\b[^>]*?\bhref\s*=\s*[\"'][^\"']*[\"']", keep: tuple[str, ...] = ()) -> DataFrame:
    """page_id, pos, kind (heading or link), value of a page's headings (h1 to h4, without tags, white space in one) and of
    what matches `link`, in page order, by one pattern; links inside headings come after them. Headings that are blank,
    long or name no programme are left out. keep: columns of the page that its parts carry."""
    heading = r"<h[1-4][^>]*>(?=([\s\S]*?)</h[1-4]>)"
    pattern = F.lit(rf"(?i){heading}|{link}")
    found = F.arrays_zip(F.regexp_extract_all(text("html"), pattern, F.lit(0)).alias("all"), F.regexp_extract_all(text("html"), pattern, F.lit(1)).alias("inner"))
    each = pages.select("page_id", *keep, F.posexplode(found).alias("pos", "p"))
    is_heading = F.col("p.all").rlike(r"(?i)^<h[1-4]")
    name = T.strip(F.regexp_replace(F.regexp_replace("p.inner", "<[^>]+>", " "), r"(?U)\s+", " "))
    out = each.select("page_id", *keep, "pos", F.when(is_heading, "heading").otherwise("link").alias("kind"), F.when(is_heading, name).otherwise(F.col("p.all")).alias("value"))
    return out.where((F.col("kind") == "link") | ((F.col("value") != "") & (F.length("value") <= LONGEST_HEADING) & ~F.col("value").rlike("(?i)" + NOISE_HEADING)))


def heading_programs(pages: DataFrame) -> DataFrame:
    """page_id, set_id, name, info_url, ages: programmes of pages that head each activity set's link with its name."""
    met = enclosing_link(page_parts(pages, ACTIVITY_SET))
    by_set = met.withColumn("set_id", F.regexp_extract("link", ACTIVITY_SET, 2)).groupBy("page_id", "set_id").agg(F.min_by(F.struct("name", "link"), "pos").alias("f"))
    return by_set.select("page_id", "set_id", "f.name", F.concat(F.lit("https://www."), "f.link").alias("info_url"), F.trim(F.regexp_extract("f.name", "(?i)" + GRADES, 0)).alias("ages"))


def enclosing_link(parts: DataFrame) -> DataFrame:
    """parts (page_id, pos, kind: heading or link, value): each heading with the next link on its page; one row per link."""
    after = Window.partitionBy("page_id").orderBy("pos").rowsBetween(1, Window.unboundedFollowing)
    met = parts.withColumn("link", F.first(F.when(F.col("kind") == "link", F.col("value")), ignorenulls=True).over(after)).where((F.col("kind") == "heading") & F.col("link").isNotNull())
    return met.groupBy("page_id", "link").agg(F.min_by("value", "pos").alias("name"), F.min("pos").alias("pos"))


def drop_menu_batches(records: DataFrame, most_share: float = 0.8, least: int = 8) -> DataFrame:
    """Drops records of pages where most of many records agree in dates and ages and have short names: menus, not sessions."""
    by_value = records.groupBy("page_id", text("dates").alias("d"), text("ages").alias("a")).agg(F.count("*").alias("same"), F.min("ord").alias("o"))
    mode = by_value.groupBy("page_id").agg(F.max(F.struct("same", (-F.col("o")).alias("o"))).alias("m"), F.sum("same").alias("all"))
    short = records.groupBy("page_id").agg(F.avg((F.length(text("name")) < 25).cast("int")).alias("short"))
    menu = mode.join(short, "page_id").where((F.col("all") >= least) & (F.col("m.same") >= most_share * F.col("all")) & (F.col("short") >= most_share)).select("page_id")
    return records.join(menu, "page_id", "left_anti")


def drop_section_pages(records: DataFrame) -> DataFrame:
    """Drops records whose address is a parent of another record's address on the same host."""
    r = records.withColumns({"h": U.host_of(F.col("info_url")), "p": F.regexp_replace(U.path(F.col("info_url")), "/+$", "")})
    steps = F.split("p", "/")
    parents = r.select("h", F.explode(F.transform(F.sequence(F.lit(1), F.greatest(F.size(steps) - 1, F.lit(1))), lambda k: F.array_join(F.slice(steps, F.lit(1), k), "/"))).alias("p"), F.col("p").alias("own")).where(F.col("p") != F.col("own")).select("h", "p").where(F.col("p") != "").distinct()
    return r.join(parents, ["h", "p"], "left_anti").drop("h", "p")


def catalog_segments(item_urls: DataFrame, n: int = 4) -> DataFrame:
    """Per host its path segments with the most item links."""
    s = item_urls.select(U.host_of(F.col("url")).alias("host"), F.regexp_extract(U.path(F.col("url")), r"^/([^/]+)/", 1).alias("segment")).where(F.col("segment") != "")
    g = s.groupBy("host", "segment").agg(F.count("*").alias("n"))
    return g.withColumn("rank", F.row_number().over(Window.partitionBy("host").orderBy(F.col("n").desc(), "segment"))).where(F.col("rank") <= n)


def session_dates(rows: DataFrame, year: int) -> DataFrame:
    """rows with the typed side columns of their free texts: start_day, span and price_amount."""
    return rows.withColumns({"start_day": D.first_date(F.col("dates"), year), "span": D.date_span(F.col("dates"), year), "price_amount": T.price_amount(F.col("price"))})
