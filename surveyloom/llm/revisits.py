"""Resolution of not-modified revisits in web archives (operator 5).

A revisit record says that a page was fetched and had not been modified; it has headers but no payload. It is resolved
by an as-of join: of the full responses for the same canonical URL, the latest one earlier than the revisit. Its
validators are checked then: entity tags by weak comparison where both have one, else modification dates where both
have one, and payload digests where both have one. The resolved record has the response's payload, and its headers
with those of the revisit merged in, except fields that describe a message or a connection and not the page.

The join sorts records by URL and time into ranges; within a range a window carries the last response forward, and one
row per URL and range carries it from range to range, so a URL with any number of captures is spread over many tasks.

Defined cases: a response of the same instant is not earlier; of several responses of one instant the highest
record_id counts; a record without a date or a URL resolves nothing and isn't resolved (``no_response``); without a
validator that both have the revisit is resolved as ``unverified``; header names are compared in lower case; repeated
records each get a row; an empty table gives an empty result; columns beyond the needed ones are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from surveyloom.llm.common import in_order, saved, table

# Header fields of a not-modified answer that don't replace those of the stored response, fixed by the protocol.
NOT_MERGED = [
    "connection", "content-encoding", "content-length", "content-range", "content-type", "keep-alive",
    "proxy-authenticate", "proxy-authentication-info", "proxy-authorization", "proxy-connection", "te", "trailer",
    "transfer-encoding", "upgrade",
]
# Query parameters that don't tell pages apart, fixed names.
IGNORED_PARAMETERS = r"^(utm_[a-z]+|ref|gclid|fbclid|sessionid)(=|$)"


def canonical_url(url: Column) -> Column:
    """Host in lower case without ``www.`` and default port, path without index page and last slash, sorted query.

    Scheme, user, fragment and parameters that don't tell pages apart are left out. Null without a host.
    """
    plain = F.regexp_replace(F.trim(url), r"#.*$", "")
    host = F.lower(F.regexp_extract(plain, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?]*)", 1))
    host = F.regexp_replace(F.regexp_replace(F.regexp_replace(host, r"^[^@]*@", ""), r":(80|443)?$", ""), r"^www\.", "")
    path = F.regexp_extract(plain, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?]*([^?]*)", 1)
    path = F.regexp_replace(F.regexp_replace(path, r"/index\.html?$", "/"), r"/+$", "")
    query = F.regexp_extract(plain, r"\?(.*)$", 1)
    kept = F.array_sort(
        F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(IGNORED_PARAMETERS))
    )
    joined = F.array_join(kept, "&")
    return F.when(host != "", F.concat(host, path, F.when(joined != "", F.concat(F.lit("?"), joined)).otherwise("")))


def _lower_names(headers: Column) -> Column:
    """Headers by lower-case name; of names that differ in case alone the first in order of the names counts."""
    return F.map_from_entries(
        F.aggregate(
            F.array_sort(F.map_entries(headers)), F.array().cast("array<struct<key: string, value: string>>"),
            lambda made, e: F.when(F.exists(made, lambda m: m["key"] == F.lower(e["key"])), made).otherwise(
                F.concat(made, F.array(F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value"))))
            ),
        )
    )


def merged_headers(stored: Column, fresh: Column) -> Column:
    """Stored headers with permitted fresh ones in their place."""
    allowed = F.map_filter(fresh, lambda k, _: ~k.isin(NOT_MERGED))
    kept = F.map_filter(stored, lambda k, _: ~F.coalesce(F.map_contains_key(allowed, k), F.lit(False)))
    return F.map_concat(kept, allowed)


def resolve(records: DataFrame) -> DataFrame:
    """Revisits with what resolves them.

    ``records`` has record_id (bigint), url, date (timestamp), kind ('response' or 'revisit'), headers (map of text),
    and payload_digest and payload_bytes (null where there is no payload). The result has a row per revisit: its
    record_id, canonical_url, response_id, status ('resolved', 'unverified', 'mismatch' or 'no_response'), and where
    it is resolved payload_digest, payload_bytes and the merged headers.
    """
    clean = records.select(
        "record_id", canonical_url(F.col("url")).alias("canonical_url"), "date",
        (F.col("kind") == "response").alias("full"),
        _lower_names(F.coalesce("headers", F.create_map().cast("map<string,string>"))).alias("headers"),
        "payload_digest", "payload_bytes",
    ).where("full OR kind = 'revisit'")
    usable = F.col("canonical_url").isNotNull() & F.col("date").isNotNull()
    ranged = in_order(clean.where(usable), ["canonical_url", "date", "full", "record_id"], "captures")
    response = F.when(
        F.col("full"), F.struct("record_id", "headers", "payload_digest", "payload_bytes", "date")
    )
    order = [F.col("date"), F.col("full"), F.col("record_id")]
    here = Window.partitionBy("_range", "canonical_url").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rows = ranged.withColumn("_response", response).withColumn("_seen", F.last("_response", ignorenulls=True).over(here))
    lasts = ranged.withColumn("_response", response).groupBy("canonical_url", "_range").agg(
        F.max_by("_response", F.when(F.col("full"), F.struct("date", "record_id"))).alias("_last")
    )
    earlier = Window.partitionBy("canonical_url").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    carried = lasts.select(
        F.col("canonical_url").alias("_url"), F.col("_range").alias("_at"),
        F.last("_last", ignorenulls=True).over(earlier).alias("_carried"),
    ).where("_carried IS NOT NULL")
    revisits = rows.where(~F.col("full"))
    found = revisits.join(
        carried, (revisits["canonical_url"] == carried["_url"]) & (revisits["_range"] == carried["_at"]), "left"
    ).withColumn("_found", F.coalesce("_seen", "_carried"))
    lost = clean.where(~usable & ~F.col("full")).select(
        "record_id", "canonical_url", "headers", "payload_digest", F.lit(None).cast(found.schema["_found"].dataType).alias("_found")
    )
    every = found.select("record_id", "canonical_url", "headers", "payload_digest", "_found").unionByName(lost)

    def tag(headers: Column) -> Column:
        return F.regexp_replace(headers["etag"], "^W/", "")

    old, new = F.col("_found")["headers"], F.col("headers")
    same_tag, same_date = tag(old) == tag(new), old["last-modified"] == new["last-modified"]
    same_payload = F.col("_found")["payload_digest"] == F.col("payload_digest")
    valid = F.coalesce(same_tag, same_date)
    status = (
        F.when(F.col("_found").isNull(), "no_response")
        .when(~F.coalesce(same_payload, F.lit(True)) | ~F.coalesce(valid, F.lit(True)), "mismatch")
        .when(F.coalesce(valid, same_payload).isNull(), "unverified")
        .otherwise("resolved")
    )
    given = every.withColumn("status", status)
    good = F.col("status").isin("resolved", "unverified")
    return given.select(
        "record_id", "canonical_url", F.col("_found")["record_id"].alias("response_id"), "status",
        F.when(good, F.col("_found")["payload_digest"]).alias("payload_digest"),
        F.when(good, F.col("_found")["payload_bytes"]).alias("payload_bytes"),
        F.when(good, merged_headers(old, new)).alias("headers"),
    )


def captures(pages: DataFrame) -> DataFrame:
    """Records of a crawl made from ``pages``: a full response of each, and a later not-modified revisit of each.

    A page's revisit comes up to 1,000 minutes later, under its URL in another spelling, with the page's validators:
    an entity tag in weak form, for every third page a date alone, for every seventh a tag of other content, and for
    every eleventh none.
    """
    number = F.col("page_id")
    digest = F.sha2(F.col("html"), 256)
    tag = F.concat(F.lit('"'), F.substring(digest, 1, 16), F.lit('"'))
    modified = F.concat(F.lit("day "), (number % 365).cast("string"))
    start = F.timestamp_seconds(F.lit(1_700_000_000) + number * 60)
    later = F.timestamp_seconds(F.lit(1_700_000_000) + (number + 1 + number * 7919 % 1000) * 60)

    def present(*pairs: tuple[str, Column]) -> Column:
        made = F.map_from_entries(F.array(*[F.struct(F.lit(k).alias("key"), v.cast("string").alias("value")) for k, v in pairs]))
        return F.map_filter(made, lambda _, v: v.isNotNull())

    responses = pages.select(
        (number * 2).alias("record_id"), "url", start.alias("date"), F.lit("response").alias("kind"),
        present(
            ("Content-Type", F.lit("text/html")), ("Content-Length", F.octet_length("html")), ("ETag", tag),
            ("Last-Modified", modified), ("Cache-Control", F.lit("max-age=60")), ("X-Page", number),
        ).alias("headers"),
        digest.alias("payload_digest"), F.octet_length("html").cast("bigint").alias("payload_bytes"),
    )
    weak = (
        F.when(number % 11 == 0, None).when(number % 7 == 0, F.lit('"other"')).when(number % 3 == 0, None)
        .otherwise(F.concat(F.lit("W/"), tag))
    )
    date = F.when(number % 11 == 0, None).when(number % 3 == 0, modified)
    revisits = pages.select(
        (number * 2 + 1).alias("record_id"), F.concat(F.col("url"), F.lit("#again")).alias("url"), later.alias("date"),
        F.lit("revisit").alias("kind"),
        present(
            ("etag", weak), ("last-modified", date), ("Cache-Control", F.concat(F.lit("max-age="), (number % 100).cast("string"))),
            ("Content-Length", F.lit("0")), ("Transfer-Encoding", F.lit("chunked")), ("Age", number % 10),
        ).alias("headers"),
        F.lit(None).cast("string").alias("payload_digest"), F.lit(None).cast("bigint").alias("payload_bytes"),
    )
    return responses.unionByName(revisits)


def op5_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = saved(captures(table(spark, sf_dir, "pages")), "records")
    lines = F.array_join(F.transform(F.array_sort(F.map_entries("headers")), lambda e: F.concat(e["key"], F.lit(": "), e["value"])), "\n")
    return resolve(records).select(
        "record_id", "canonical_url", "response_id", "status", "payload_digest", "payload_bytes", lines.alias("headers")
    )


OP5_SQL = r"""
WITH split AS (
    SELECT page_id, html, regexp_replace(trim(url), '#.*$', '') AS plain FROM pages),
parts AS (
    SELECT page_id, html,
        regexp_replace(regexp_replace(regexp_replace(lower(regexp_extract(plain, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?]*)', 1)),
            '^[^@]*@', ''), ':(80|443)?$', ''), '^www\.', '') AS host,
        regexp_replace(regexp_replace(regexp_extract(plain, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?]*([^?]*)', 1),
            '/index\.html?$', '/'), '/+$', '') AS path,
        array_to_string(list_sort(list_filter(string_split(regexp_extract(plain, '\?(.*)$', 1), '&'),
            lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_[a-z]+|ref|gclid|fbclid|sessionid)(=|$)'))), '&') AS query
    FROM split),
known AS (
    SELECT page_id, html, host || path || CASE WHEN query <> '' THEN '?' || query ELSE '' END AS canonical_url,
        sha256(html) AS digest, octet_length(encode(html)) AS n_bytes, page_id AS at,
        page_id + 1 + page_id * 7919 % 1000 AS later, 'day ' || (page_id % 365) AS modified
    FROM parts WHERE host <> ''),
joined AS (
    SELECT v.page_id AS v_id, v.canonical_url, r.page_id AS r_id, r.digest, r.n_bytes, r.modified,
        '"' || substr(r.digest, 1, 16) || '"' AS tag,
        CASE WHEN v.page_id % 11 = 0 THEN NULL WHEN v.page_id % 7 = 0 THEN '"other"' WHEN v.page_id % 3 = 0 THEN NULL
            ELSE 'W/"' || substr(v.digest, 1, 16) || '"' END AS v_tag,
        CASE WHEN v.page_id % 11 = 0 THEN NULL WHEN v.page_id % 3 = 0 THEN v.modified END AS v_modified
    FROM known v ASOF LEFT JOIN known r ON v.canonical_url = r.canonical_url AND v.later > r.at),
judged AS (
    SELECT *, CASE WHEN r_id IS NULL THEN 'no_response'
        WHEN coalesce(tag = replace(v_tag, 'W/', ''), modified = v_modified) IS NULL THEN 'unverified'
        WHEN coalesce(tag = replace(v_tag, 'W/', ''), modified = v_modified) THEN 'resolved' ELSE 'mismatch' END AS status
    FROM joined)
SELECT v_id * 2 + 1 AS record_id, canonical_url, r_id * 2 AS response_id, status,
    CASE WHEN status IN ('resolved', 'unverified') THEN digest END AS payload_digest,
    CASE WHEN status IN ('resolved', 'unverified') THEN n_bytes END AS payload_bytes,
    CASE WHEN status IN ('resolved', 'unverified') THEN
        'age: ' || (v_id % 10) || chr(10) || 'cache-control: max-age=' || (v_id % 100) || chr(10)
        || 'content-length: ' || n_bytes || chr(10) || 'content-type: text/html' || chr(10)
        || 'etag: ' || coalesce(v_tag, tag) || chr(10) || 'last-modified: ' || coalesce(v_modified, modified) || chr(10)
        || 'x-page: ' || r_id END AS headers
FROM judged"""
