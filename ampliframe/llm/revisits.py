"""Resolution of not-modified web captures to the full response they stand for.

A revisit record says that a page had not changed since an earlier capture and holds no body. It
is resolved by an as-of join: the latest full response of the same canonical address that is
earlier than the revisit. The join counts only if the validators agree; the headers of the
response are then updated by those of the revisit that may be updated.

The as-of join works on distinct (address, time) pairs, so rows are reduced before they are
shuffled, and in buckets of time: within a bucket by a window, across buckets by carrying the
last response of earlier buckets forward in a table with a row for each address and bucket. No
address, however often it was captured, is one group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Headers that a not-modified answer does not update
NOT_UPDATED = (
    "connection", "content-encoding", "content-length", "content-range", "content-type",
    "keep-alive", "proxy-authenticate", "proxy-authorization", "te", "trailer",
    "transfer-encoding", "upgrade",
)
#: query parameters that do not change what a page holds
TRACKING = r"^(?i)(utm_[^=]*|ref|sid|phpsessid|jsessionid|fbclid|gclid)(=.*)?$"
BUCKET_SECONDS = 6 * 3600


def canonical_url(url: Column) -> Column:
    """Host in lower case without www. and default port, path without end slash, sorted query.

    Scheme, user, fragment and tracking parameters do not count. Null for a null or blank url.
    """
    plain = F.regexp_replace(F.trim(url), "#.*$", "")
    rest = F.regexp_replace(plain, r"^(?i)[a-z][a-z0-9+.\-]*://", "")
    host = F.lower(F.regexp_extract(rest, r"^([^/?]*)", 1))
    host = F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r":(80|443)$", "")
    host = F.regexp_replace(host, r"^www[0-9]*\.", "")
    path = F.regexp_replace(F.regexp_extract(rest, r"^[^/?]*([^?]*)", 1), r"/+$", "")
    query = F.regexp_extract(rest, r"\?(.*)$", 1)
    parts = F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(TRACKING))
    tail = F.array_join(F.array_sort(parts), "&")
    whole = F.concat(host, path, F.when(tail != "", F.concat(F.lit("?"), tail)).otherwise(""))
    return F.when(whole != "", whole)


def headers_by_name(headers: Column) -> Column:
    """Headers with names in lower case; of names that differ in case only, the first stays."""
    entries = F.transform(
        F.map_entries(F.coalesce(headers, F.create_map().cast("map<string,string>"))),
        lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")),
    )
    names = F.transform(entries, lambda e: e["key"])
    return F.map_from_entries(
        F.filter(entries, lambda e, i: F.array_position(names, e["key"]) == i + 1)
    )


def merged_headers(response: Column, revisit: Column, not_updated: Sequence[str]) -> Column:
    """The response's headers, updated by those of the revisit that may be."""
    fixed = F.array(*[F.lit(n) for n in not_updated])
    new = F.map_filter(
        headers_by_name(revisit), lambda k, v: v.isNotNull() & ~F.array_contains(fixed, k)
    )
    old = F.map_filter(
        headers_by_name(response), lambda k, v: ~F.array_contains(F.map_keys(new), k)
    )
    return F.map_concat(old, new)


def _tag(etag: Column) -> Column:
    """An entity tag for weak comparison; null for a blank one."""
    return F.nullif(F.regexp_replace(F.trim(etag), r'^(W/)?"?|"$', ""), F.lit(""))


def resolve(
    records: DataFrame,
    bucket_seconds: int = BUCKET_SECONDS,
    not_updated: Sequence[str] = NOT_UPDATED,
) -> DataFrame:
    """A row for every revisit in `records`, with the response it stands for.

    `records` has record_id, url, captured_at (seconds, bigint), kind (`response` or `revisit`), status,
    etag, last_modified and headers (map of texts); further columns are ignored. Full responses
    are those of kind `response` and status 200 that have a url and a time. Of several at one
    time the one with the largest id counts; one at the revisit's own time is not earlier.

    `outcome` is `resolved`, `validator_mismatch` (response_id says which response disagrees),
    `no_validator` (neither record pair has a tag or a date in common), `no_response`, or `no_url`
    for a revisit without url or time. Tags are compared weakly, dates only where a tag is missing
    on either side. Headers are null unless resolved. Repeated revisits give repeated rows.
    """
    known = records.select(
        "record_id", canonical_url(F.col("url")).alias("canonical_url"),
        F.col("captured_at").cast("bigint").alias("captured_at"), "kind", "status", _tag(F.col("etag")).alias("tag"),
        F.nullif(F.trim("last_modified"), F.lit("")).alias("modified"), "headers",
    )
    usable = F.col("canonical_url").isNotNull() & F.col("captured_at").isNotNull()
    full = known.filter(usable & (F.col("kind") == "response") & (F.col("status") == 200))
    full = full.filter(F.col("record_id").isNotNull())
    revisits = known.filter(F.col("kind") == "revisit")
    # what is as-of joined are the distinct moments of an address, with the response's id only
    moments = (
        full.select("canonical_url", "captured_at", F.col("record_id").alias("id"))
        .unionByName(
            revisits.filter(usable).select(
                "canonical_url", "captured_at", F.lit(None).cast(full.schema["record_id"].dataType).alias("id")
            )
        )
        .groupBy("canonical_url", "captured_at")
        .agg(F.max("id").alias("id"))
        .withColumn("bucket", F.floor(F.col("captured_at") / bucket_seconds))
    )
    earlier = Window.partitionBy("canonical_url", "bucket").orderBy("captured_at").rowsBetween(
        Window.unboundedPreceding, -1
    )
    within = moments.withColumn("found", F.last("id", ignorenulls=True).over(earlier))
    before = Window.partitionBy("canonical_url").orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    carried = (
        moments.groupBy("canonical_url", "bucket")
        .agg(F.max_by("id", F.when(F.col("id").isNotNull(), F.col("captured_at"))).alias("last"))
        .withColumn("carried", F.last("last", ignorenulls=True).over(before))
        .select("canonical_url", "bucket", "carried")
    )
    matched = (
        within.join(carried, ["canonical_url", "bucket"])
        .select("canonical_url", "captured_at", F.coalesce("found", "carried").alias("response_id"))
        .filter("response_id is not null")
    )
    answers = full.select(
        F.col("record_id").alias("response_id"), F.col("canonical_url").alias("r_url"),
        F.col("tag").alias("r_tag"), F.col("modified").alias("r_modified"),
        F.col("headers").alias("r_headers"),
    ).dropDuplicates(["response_id", "r_url"])
    joined = revisits.join(matched, ["canonical_url", "captured_at"], "left")
    same = (joined["response_id"] == answers["response_id"]) & (
        joined["canonical_url"] == answers["r_url"]
    )
    joined = joined.join(answers.withColumn("r_found", F.lit(True)), same, "left").drop(
        answers["response_id"]
    )
    agrees = F.when(
        F.col("tag").isNotNull() & F.col("r_tag").isNotNull(), F.col("tag") == F.col("r_tag")
    ).when(
        F.col("modified").isNotNull() & F.col("r_modified").isNotNull(),
        F.col("modified") == F.col("r_modified"),
    )
    outcome = (
        F.when(~usable, "no_url")
        .when(F.col("r_found").isNull(), "no_response")
        .when(agrees.isNull(), "no_validator")
        .when(agrees, "resolved")
        .otherwise("validator_mismatch")
    )
    return joined.select(
        "record_id", "canonical_url", "captured_at", outcome.alias("outcome"), "response_id",
        F.when(
            outcome == "resolved",
            merged_headers(F.col("r_headers"), F.col("headers"), not_updated),
        ).alias("headers"),
    )


def captures(pages: DataFrame) -> DataFrame:
    """Capture records derived from the pages table.

    Every page is a full response and has a later revisit under another spelling of its address;
    some revisits lack validators or carry other ones, and every fourth page has a revisit that
    is earlier than its response. Pages of one host and language share few addresses, so that
    these have many responses.
    """
    p = F.col("page_id")
    tag = F.substring(F.md5("html"), 1, 16)
    base = pages.select(
        p,
        F.concat(
            F.regexp_extract("url", r"^(https?://[^/]+/[a-z]+/)", 1), (p % 97).cast("string")
        ).alias("url"),
        (F.lit(1_700_000_000) + (p * 7919) % 2_592_000).alias("captured_at"),
        tag.alias("tag"),
        F.length("html").cast("string").alias("size"),
    )
    quoted = F.concat(F.lit('"'), "tag", F.lit('"'))
    day = F.concat(F.lit("day "), F.floor(p / 3).cast("string"))

    def record(number, url, at, kind, status, etag, modified, headers):
        return F.struct(
            (p * 4 + number).alias("record_id"), url.alias("url"), at.alias("captured_at"),
            F.lit(kind).alias("kind"), F.lit(status).alias("status"), etag.alias("etag"),
            modified.alias("last_modified"),
            F.create_map(*[x for k, v in headers.items() for x in (F.lit(k), v)]).alias("headers"),
        )

    response = record(
        0, F.col("url"), F.col("captured_at"), "response", 200, F.when(p % 11 != 0, quoted),
        F.when(p % 7 != 0, day),
        {
            "Content-Type": F.lit("text/html"), "Content-Length": F.col("size"),
            "Cache-Control": F.concat(F.lit("max-age="), (p % 5).cast("string")),
            "Date": F.col("captured_at").cast("string"),
        },
    )
    other = (
        F.when(p % 5 == 1, F.concat("url", F.lit("/#top")))
        .when(p % 5 == 2, F.concat("url", F.lit("?utm_source=feed")))
        .when(p % 5 == 3, F.regexp_replace("url", "^https?://", "HTTPS://www."))
        .otherwise(F.col("url"))
    )
    later = F.col("captured_at") + 3600 + p % 1000
    again = record(
        1, other, later, "revisit", 304,
        F.when(p % 13 == 0, F.lit('"changed"')).when(p % 3 == 0, F.concat(F.lit("W/"), quoted))
        .when(p % 17 != 0, quoted),
        F.when(p % 7 != 1, day),
        {
            "content-length": F.lit("0"), "cache-control": F.lit("max-age=99"),
            "date": later.cast("string"), "x-cache": F.lit("HIT"),
        },
    )
    early = record(
        2, F.col("url"), F.col("captured_at") - 500, "revisit", 304, quoted, day,
        {"date": (F.col("captured_at") - 500).cast("string")},
    )
    rows = F.when(p % 4 == 0, F.array(response, again, early)).otherwise(F.array(response, again))
    return base.select(F.inline(rows))


def oracle() -> str:
    """The query over the pages table in DuckDB's SQL."""
    return r"""
with base as (
  select page_id as p, regexp_extract(url, '^(https?://[^/]+/[a-z]+/)', 1) || (page_id % 97)::varchar
      as url, 1700000000 + (page_id * 7919) % 2592000 as t, substr(md5(html), 1, 16) as tag,
    length(html)::varchar as size, 'day ' || (page_id // 3)::varchar as d from pages),
full_ as (
  select p * 4 as id, url, t, case when p % 11 <> 0 then tag end as tag,
    case when p % 7 <> 0 then d end as d, size, 'max-age=' || (p % 5)::varchar as cc from base),
rev as (
  select p * 4 + 1 as id, case p % 5 when 1 then url || '/#top' when 2 then url || '?utm_source=feed'
      when 3 then regexp_replace(url, '^https?://', 'HTTPS://www.') else url end as url,
    t + 3600 + p % 1000 as t, case when p % 13 = 0 then 'changed' when p % 3 = 0 or p % 17 <> 0
      then tag end as tag, case when p % 7 <> 1 then d end as d, true as again from base
  union all
  select p * 4 + 2, url, t - 500, tag, d, false from base where p % 4 = 0),
canon as (
  select *, regexp_replace(regexp_replace(regexp_replace(lower(regexp_extract(
    regexp_replace(url, '^[A-Za-z]+://', ''), '^([^/?]*)', 1)), '^www[0-9]*\.', ''), ':80$', ''),
    ':443$', '') as host, regexp_replace(regexp_extract(regexp_replace(regexp_replace(url, '#.*$',
    ''), '^[A-Za-z]+://', ''), '^[^/?]*([^?]*)', 1), '/+$', '') as path from rev),
r as (select *, host || path as c from canon),
s0 as (
  select *, regexp_replace(lower(regexp_extract(url, '://([^/]*)', 1)), '^www[0-9]*\.', '')
    || regexp_extract(url, '://[^/]*(.*)$', 1) as c from full_),
s as (select c, t, max(id) as id from s0 group by c, t),
m as (
  select r.*, s.id as sid from r asof left join s on r.c = s.c and r.t > s.t),
j as (
  select m.*, s0.tag as stag, s0.d as sd, s0.size as ssize, s0.cc as scc, s0.t as st,
    case when m.sid is null then 'no_response'
      when m.tag is not null and s0.tag is not null then
        case when m.tag = s0.tag then 'resolved' else 'validator_mismatch' end
      when m.d is not null and s0.d is not null then
        case when m.d = s0.d then 'resolved' else 'validator_mismatch' end
      else 'no_validator' end as outcome
  from m left join s0 on s0.id = m.sid)
select id as record_id, c as canonical_url, t as captured_at, outcome, sid as response_id,
  case when outcome = 'resolved' then
    'cache-control: ' || case when again then 'max-age=99' else scc end || chr(10)
    || 'content-length: ' || ssize || chr(10) || 'content-type: text/html' || chr(10)
    || 'date: ' || t::varchar || case when again then chr(10) || 'x-cache: HIT' else '' end end
    as headers
from j"""
