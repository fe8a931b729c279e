"""Web archives: records of WARC files, and revisits resolved to the response they stand for.

A revisit says that a page was not modified. It stands for the latest full response (status 200) that
was captured earlier from the same canonical URL. Whether it truly does is checked by validators:
entity tags by weak comparison if both have one, else the time of last modification, else the
payload digest. A resolved revisit takes over the payload, and the stored headers updated by those
that a not-modified answer may carry.

The as-of join sorts nothing by URL alone: rows are dealt by URL and hour. A bucket takes its start
from the latest response of the URL's earlier buckets, which are reduced to one row each first, so
a URL of very many captures spreads over its hours.

Defined results: a revisit without URL, or without an earlier full response, is ``missing``; with a
validator that differs ``changed``; without a common validator ``unverified``; only ``resolved``
ones are merged. Further columns are left out. A response of the same instant is not earlier; of responses of one instant the
greatest record_id counts. NULL times are never earlier than anything. Repeated rows are kept. A NULL
record_id is allowed on both sides: what a revisit stands for depends on its URL and time alone. Ids
may be of any type that can be ordered.

Files are cut at record boundaries while they are read, and pieces are put together again where the
length that a record states says that a boundary was part of its content.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelloom.llm import common as C

# Headers of a not-modified answer that update the stored ones.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")
#: Query parameters that only track visitors.
TRACKING = r"^(?:utm_[^=]*|gclid|fbclid)(?:=|$)"
BUCKET_SECONDS = 3600

RECORD = ("record_id", "kind", "url", "captured_at", "status", "headers", "digest", "payload")


def canonical_url(url: Column) -> Column:
    """Host without www. and default port, path, and query without tracking: one key for http and
    https and for upper and lower case of the host. NULL without ://."""
    rest = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^#]*)", 1)
    authority = F.lower(F.regexp_extract(rest, r"^[^/?]*", 0))
    host = F.regexp_replace(F.regexp_replace(F.regexp_replace(authority, r"^.*@", ""), r":(?:80|443)?$", ""), r"^www\.", "")
    path = F.regexp_extract(rest, r"^[^/?]*([^?]*)", 1)
    query = F.regexp_extract(rest, r"^[^?]*\?(.*)$", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(TRACKING)))
    asked = F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise("")
    return F.when(url.contains("://"), F.concat(host, F.when(path == "", "/").otherwise(path), asked))


def _tag(headers: Column) -> Column:
    """The entity tag without its mark of weakness."""
    return F.regexp_replace(F.try_element_at(headers, F.lit("etag")), r"^W/", "")


def _instant(captured_at: Column) -> Column:
    return F.unix_micros(captured_at.cast("timestamp"))


def _full() -> Column:
    return (F.col("kind") == "response") & (F.col("status") == 200)


def latest_earlier(records: DataFrame) -> DataFrame:
    """(key, at, response_at, response_id) for the URL and instant of each revisit: its URL's latest
    earlier full response."""
    mark = f"struct<at:bigint,record_id:{records.schema['record_id'].dataType.simpleString()}>"
    key = canonical_url(F.col("url"))
    at = _instant(F.col("captured_at"))
    rows = records.where(_full() | (F.col("kind") == "revisit")).select(
        key.alias("key"), at.alias("at"), F.floor(at / (BUCKET_SECONDS * 1_000_000)).alias("bucket"), _full().alias("full"), "record_id"
    )
    rows = rows.where(F.col("key").isNotNull() & F.col("at").isNotNull())
    last = rows.where("full").groupBy("key", "bucket").agg(F.max(F.struct("at", "record_id")).alias("last"))
    marks = last.unionByName(rows.where("NOT full").select("key", "bucket").distinct().withColumn("last", F.lit(None).cast(mark)))
    marks = marks.groupBy("key", "bucket").agg(F.max("last").alias("last"))
    before = Window.partitionBy("key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = marks.select("key", "bucket", F.last("last", ignorenulls=True).over(before).alias("carried")).where("carried IS NOT NULL")
    # A row per bucket starts it; a revisit sees what stands strictly before its instant.
    seen = rows.select("key", "bucket", "at", "full", F.when(F.col("full"), F.struct("at", "record_id")).alias("response"))
    start = carried.select("key", "bucket", F.col("carried.at").alias("at"), F.lit(True).alias("full"), F.col("carried").alias("response"))
    within = Window.partitionBy("key", "bucket").orderBy("at").rangeBetween(Window.unboundedPreceding, -1)
    found = seen.unionByName(start).withColumn("target", F.max("response").over(within)).where("NOT full AND target IS NOT NULL")
    return found.select("key", "at", F.col("target.at").alias("response_at"), F.col("target.record_id").alias("response_id")).distinct()


def resolve_revisits(records: DataFrame) -> DataFrame:
    """Each revisit of ``records`` (columns RECORD; headers is a map with lower-case names) with
    outcome, response_id, merged headers and the payload it stands for."""
    records = records.select(*RECORD)
    placed = records.withColumns({"key": canonical_url(F.col("url")), "at": _instant(F.col("captured_at"))})
    stored = placed.where(_full()).select(
        F.col("key").alias("of_key"), F.col("at").alias("of_at"), F.col("record_id").alias("of_id"),
        F.col("headers").alias("stored_headers"), F.col("digest").alias("stored_digest"), F.col("payload").alias("stored_payload"),
    ).dropDuplicates(["of_key", "of_at", "of_id"])
    meant = (F.col("key") == F.col("of_key")) & (F.col("response_at") == F.col("of_at")) & F.col("response_id").eqNullSafe(F.col("of_id"))
    joined = placed.where("kind = 'revisit'").drop("payload").join(latest_earlier(records), ["key", "at"], "left").join(stored, meant, "left")
    modified = [F.try_element_at(F.col(h), F.lit("last-modified")) for h in ("headers", "stored_headers")]
    checks = [(_tag(F.col("headers")), _tag(F.col("stored_headers"))), tuple(modified), (F.col("digest"), F.col("stored_digest"))]
    outcome = F.lit("unverified")
    for own, other in reversed(checks):
        outcome = F.when(own.isNotNull() & other.isNotNull(), F.when(own == other, "resolved").otherwise("changed")).otherwise(outcome)
    outcome = F.when(F.col("response_at").isNull(), "missing").otherwise(outcome)
    news = F.map_filter("headers", lambda k, v: k.isin(*PERMITTED))
    old = F.map_filter("stored_headers", lambda k, v: ~F.map_contains_key(news, k))
    done = F.col("outcome") == "resolved"
    return joined.withColumn("outcome", outcome).select(
        "record_id",
        "url",
        canonical_url(F.col("url")).alias("url_key"),
        "captured_at",
        "outcome",
        "response_id",
        F.when(done, F.map_concat(old, news)).alias("headers"),
        F.when(done, F.col("stored_payload")).alias("payload"),
    )


#: What separates two records of a file.
BOUNDARY = "\r\n\r\nWARC/1."


def write_warc(records: DataFrame, path: str) -> None:
    """``records`` as WARC files. The block of a record is its HTTP head and its payload, of which
    ``payload_bytes`` is taken first if there is such a column. Times are written in UTC, with their
    fraction if they have one. Fields that are NULL are left out."""
    pairs = F.transform(F.map_entries("headers"), lambda e: F.concat(e["key"], F.lit(": "), e["value"], F.lit("\r\n")))
    head = F.concat(F.lit("HTTP/1.1 "), F.coalesce(F.col("status").cast("string"), F.lit("000")), F.lit("\r\n"), F.coalesce(F.array_join(pairs, ""), F.lit("")), F.lit("\r\n"))
    payloads = [F.col("payload").cast("binary"), F.lit("").cast("binary")]
    if "payload_bytes" in records.columns:
        payloads.insert(0, F.col("payload_bytes"))
    block = F.concat(head.cast("binary"), F.coalesce(*payloads))
    named = F.col("record_id").cast("string")
    uri = F.when(named.contains(":"), named).otherwise(F.concat(F.lit("urn:record:"), named))
    if "record_uri" in records.columns:
        uri = F.coalesce(F.col("record_uri"), uri)
    utc = F.to_utc_timestamp(F.col("captured_at").cast("timestamp"), F.current_timezone())
    split = F.pmod(_instant(F.col("captured_at")), F.lit(1_000_000)) != 0
    date = F.when(split, F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")).otherwise(F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss'Z'"))

    def field(name: str, value: Column) -> Column:
        return F.when(value.isNotNull(), F.concat(F.lit(f"\r\n{name}: "), value)).otherwise("")

    lines = F.concat(
        F.when(split, "1").otherwise("0"),
        field("WARC-Type", F.col("kind")),
        field("WARC-Record-ID", F.concat(F.lit("<"), uri, F.lit(">"))),
        field("WARC-Target-URI", F.col("url")),
        field("WARC-Date", date),
        field("WARC-Payload-Digest", F.col("digest")),
        F.lit("\r\nContent-Type: application/http\r\nContent-Length: "), F.octet_length(block).cast("string"),
        F.lit("\r\n\r\n"),
    )
    records.select(F.concat(lines.cast("binary"), block).cast("string").alias("value")).write.option("lineSep", BOUNDARY).text(path)


def _claimed() -> Column:
    """The bytes of a piece's head and of the content that it states, NULL without a length."""
    size = F.expr(r"try_cast(regexp_extract(substring_index(value, '\r\n\r\n', 1), '(?i)\r\nContent-Length:[ \t]*([0-9]+)', 1) AS BIGINT)")
    return F.octet_length(F.substring_index("value", "\r\n\r\n", 1)) + 4 + size


def _whole_records(pieces: DataFrame) -> DataFrame:
    """(value) from the pieces (value, file, block, nth, part) between boundaries.

    A piece that is shorter than its record states goes on to the boundary at which the stated length
    ends, if there is one (or the file ends there); all pieces up to there are its content. Only files with
    a short piece are looked at, by their pieces' sizes: these are added up within the split of each piece,
    and over the splits. The places of pieces hold for each reading, as files are split the same way.
    """
    sized = pieces.select("file", "block", "nth", "part", F.octet_length("value").cast("long").alias("size"), _claimed().alias("claimed"))
    files = C.checkpointed(sized.where("claimed > size").select("file").distinct())
    if C.is_empty(files):
        return pieces.select("value")
    step = F.col("size") + len(BOUNDARY)
    own = C.checkpointed(sized.join(files, "file", "left_semi"))
    blocks = own.groupBy("file", "block").agg(F.sum(step).alias("total"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = C.checkpointed(blocks.withColumn("base", F.coalesce(F.sum("total").over(earlier), F.lit(0))))
    within = Window.partitionBy("file", "block").orderBy("nth", "part").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("base") + F.coalesce(F.sum(step).over(within), F.lit(0))
    placed = C.checkpointed(own.join(blocks, ["file", "block"]).withColumn("start", start).select("file", "nth", "part", "start", "size", "claimed"))
    # The last record's content ends with its file, or with the blank line behind it.
    ends = blocks.groupBy("file").agg(F.sum("total").alias("end")).select("file", F.explode(F.array(F.col("end"), F.col("end") - 4)).alias("next"))
    starts = placed.select("file", F.col("start").alias("next")).union(ends)
    claims = placed.where("claimed > size").select("file", "nth", "part", (F.col("start") + F.col("claimed") + len(BOUNDARY)).alias("next"))
    kept = claims.join(starts.distinct(), ["file", "next"]).select("file", "nth", "part", "next")
    ordered = placed.join(kept, ["file", "nth", "part"], "left").select("file", "nth", "part", "start", "next")
    columns = ["file", "nth", "part", "start", "owner"]

    def members(batches):
        file, until, owner = None, 0, 0
        for batch in batches:
            rows = []
            for name, nth, part, begin, end in zip(*(batch[c] for c in ("file", "nth", "part", "start", "next"))):
                if name != file:
                    file, until = name, 0
                if begin >= until and end == end:
                    until, owner = int(end), begin
                if begin < until:
                    rows.append((name, nth, part, begin, owner))
            yield pd.DataFrame(rows, columns=columns)

    found = C.with_workers(ordered).repartition("file").sortWithinPartitions("file", "start").mapInPandas(members, "file string, nth long, part int, start long, owner long")
    joined = pieces.join(C.checkpointed(found), ["file", "nth", "part"], "left")
    parts = F.array_sort(F.collect_list(F.struct("start", "value")))
    whole = joined.where("owner IS NOT NULL").groupBy("file", "owner").agg(F.array_join(F.transform(parts, lambda p: p["value"]), BOUNDARY).alias("value"))
    return joined.where("owner IS NULL").select("value").union(whole.select("value"))


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """The records of WARC files (plain or gzip), with ``broken``: NULL or what is wrong with one.

    Files are cut at record boundaries while they are read, so plain files are split over tasks and
    no file is held whole. ``payload_bytes`` is what follows the HTTP head (of other records the whole
    content), as it was stored; ``payload`` is the same as text, NULL if it is no UTF-8. ``record_uri`` is the
    id as written, ``record_id`` the number of ids that ``write_warc`` makes. Times are of any precision and
    in UTC; one that cannot be read is NULL.
    """
    raw = spark.read.option("lineSep", BOUNDARY).text(path)
    pieces = raw.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("nth"))
    # A boundary that lies on the edge of a split may be read over.
    inside = ((F.octet_length("value") - F.octet_length(F.replace("value", F.lit(BOUNDARY), F.lit("")))) / len(BOUNDARY)).cast("int")

    def piece(i: Column) -> Column:
        upto, before = (F.call_function("substring_index", F.col("value"), F.lit(BOUNDARY), n) for n in (i + 1, i))
        begin = F.when(i > 0, F.octet_length(before) + len(BOUNDARY)).otherwise(0)
        # As bytes: splitting a text would change those that are no UTF-8.
        return F.call_function("substring", upto.cast("binary"), begin + 1, F.octet_length(upto)).cast("string")

    each = F.transform(F.sequence(F.lit(0), inside), lambda i: F.struct(i.alias("part"), piece(i).alias("value")))
    pieces = pieces.select("file", "block", "nth", F.explode(each).alias("p")).select("file", "block", "nth", "p.part", "p.value")
    cut = _whole_records(pieces).where(F.length(F.trim("value")) > 0)
    head = F.substring_index("value", "\r\n\r\n", 1)
    body = F.expr(r"substring(CAST(value AS BINARY), octet_length(substring_index(value, '\r\n\r\n', 1)) + 5)")
    # The first record of a file still has its version.
    parts = cut.select(F.regexp_replace(head, r"^WARC/1\.", "").alias("head"), body.alias("body"))

    def field(name: str) -> Column:
        found = F.regexp_extract("head", rf"(?i)\r\n{name}:[ \t]*([^\r\n]*)", 1)
        return F.when(found != "", found)

    parts = parts.withColumn("size", field("Content-Length").try_cast("bigint"))
    parts = parts.withColumn("block", F.expr("substring(body, 1, CAST(least(size, 2147483647) AS INT))"))
    block = F.col("block").cast("string")
    is_http = F.startswith(block, F.lit("HTTP/")) | F.coalesce(F.contains(F.lower(field("Content-Type")), F.lit("application/http")), F.lit(False))
    parts = parts.withColumn("http", F.when(is_http, F.substring_index(block, "\r\n\r\n", 1)))
    content = F.when(F.col("http").isNotNull(), F.expr("substring(block, octet_length(http) + 5)")).otherwise(F.col("block"))
    lines = F.filter(F.split(F.coalesce("http", F.lit("")), "\r\n"), lambda x: x.contains(":"))
    pairs = F.transform(lines, lambda x: F.struct(F.lower(F.trim(F.substring_index(x, ":", 1))).alias("name"), F.trim(F.regexp_replace(x, r"^[^:]*:", "")).alias("value")))
    # Of a header that repeats, the values are joined as HTTP allows.
    names = F.array_distinct(F.transform(pairs, lambda p: p["name"]))
    values = F.transform(names, lambda n: F.array_join(F.transform(F.filter(pairs, lambda p: p["name"] == n), lambda p: p["value"]), ", "))
    broken = F.when(F.col("size").isNull(), "no length").when(F.octet_length("body") < F.col("size"), "shorter than its length")
    uri = F.regexp_extract("head", r"(?i)\r\nWARC-Record-ID:[ \t]*<?([^>\r\n]*)", 1)
    date = field("WARC-Date")
    zoned = F.when(date.rlike(r"T.*(?:Z|[+-][0-9:]+)$"), date).when(date.contains("T"), F.concat(date, F.lit("Z"))).otherwise(F.concat(date, F.lit("T00:00:00Z")))
    text = F.col("payload_bytes").cast("string")
    return parts.select("*", content.alias("payload_bytes")).select(
        F.regexp_extract(uri, "^urn:record:([0-9]+)$", 1).try_cast("bigint").alias("record_id"),
        F.lower(field("WARC-Type")).alias("kind"),
        field("WARC-Target-URI").alias("url"),
        zoned.try_cast("timestamp").alias("captured_at"),
        F.regexp_extract("http", "^HTTP/[0-9.]+ ([0-9]+)", 1).try_cast("int").alias("status"),
        F.map_from_arrays(names, values).alias("headers"),
        field("WARC-Payload-Digest").alias("digest"),
        F.when(F.is_valid_utf8(text), text).alias("payload"),
        broken.alias("broken"),
        F.when(uri != "", uri).alias("record_uri"),
        "payload_bytes",
    )


def captures(pages: DataFrame) -> DataFrame:
    """A crawl derived from ``pages``: each page as a full response (even record_id), and a later
    not-modified visit to a variant of its URL (odd record_id). Of ten visits one has another entity
    tag, one no validator and one only the time of last modification."""
    number, turn = F.col("page_id").cast("long"), F.pmod(F.col("page_id"), F.lit(10))
    tag = F.substring(F.md5(F.coalesce("html", F.lit(""))), 1, 16)
    at = F.lit(1_577_836_800) + number * 60
    stamp = lambda seconds: F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd HH:mm:ss")
    later = at + F.pmod(number * 7919, F.lit(86_400)) + 1
    quoted = F.concat(F.lit('"'), tag, F.lit('"'))
    response = pages.select(
        (number * 2).alias("record_id"),
        F.lit("response").alias("kind"),
        "url",
        F.timestamp_seconds(at).alias("captured_at"),
        F.lit(200).alias("status"),
        F.create_map(F.lit("content-type"), F.lit("text/html"), F.lit("date"), stamp(at), F.lit("etag"), quoted, F.lit("last-modified"), stamp(at - 1000)).alias("headers"),
        F.lit(None).cast("string").alias("digest"),
        F.col("html").alias("payload"),
    )
    dated = F.create_map(F.lit("date"), stamp(later), F.lit("content-type"), F.lit("none"))
    tagged = F.create_map(F.lit("date"), stamp(later), F.lit("content-type"), F.lit("none"), F.lit("etag"), F.concat(F.lit("W/"), F.when(turn == 3, '"other"').otherwise(quoted)))
    modified = F.create_map(F.lit("date"), stamp(later), F.lit("content-type"), F.lit("none"), F.lit("last-modified"), stamp(at - 1000))
    visit = pages.select(
        (number * 2 + 1).alias("record_id"),
        F.lit("revisit").alias("kind"),
        F.concat(F.regexp_replace(F.substring_index("url", "#", 1), "^http:", "https:"), F.when(F.col("url").contains("?"), "&").otherwise("?"), F.lit("utm_campaign=x#again")).alias("url"),
        F.timestamp_seconds(later).alias("captured_at"),
        F.lit(304).alias("status"),
        F.when(turn == 4, dated).when(turn == 5, modified).otherwise(tagged).alias("headers"),
        F.lit(None).cast("string").alias("digest"),
        F.lit(None).cast("string").alias("payload"),
    )
    return response.unionByName(visit)


def revisit_report(pages: DataFrame) -> DataFrame:
    """One row per revisit: outcome, response_id, the merged headers and the payload's digest."""
    out = resolve_revisits(captures(pages))
    header = lambda name: F.try_element_at("headers", F.lit(name)).alias(name.replace("-", "_"))
    return out.select("record_id", "url_key", "outcome", "response_id", *[header(n) for n in ("content-type", "date", "etag", "last-modified")], F.sha2(F.col("payload"), 256).alias("payload_sha256"))


# The same in SQL, over the same derived crawl.
ORACLE = r"""
WITH p AS (SELECT CAST(page_id AS BIGINT) AS n, url, html, substr(md5(coalesce(html, '')), 1, 16) AS tag, 1577836800 + CAST(page_id AS BIGINT) * 60 AS moment FROM pages),
q AS (SELECT *, moment + (n * 7919) % 86400 + 1 AS later FROM p),
r AS (SELECT n * 2 + 1 AS record_id, n, later, moment, tag,
        regexp_replace(split_part(url, '#', 1), '^http:', 'https:') || CASE WHEN contains(url, '?') THEN '&' ELSE '?' END || 'utm_campaign=x#again' AS url FROM q),
u AS (SELECT n * 2 AS id, url FROM q UNION ALL SELECT record_id, url FROM r),
w AS (SELECT id, regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^#]*)', 1) AS rest, url FROM u),
x AS (SELECT id, url,
        regexp_replace(regexp_replace(regexp_replace(lower(regexp_extract(rest, '^[^/?]*', 0)), '^.*@', ''), ':(80|443)?$', ''), '^www\.', '') AS host,
        regexp_extract(rest, '^[^/?]*([^?]*)', 1) AS path,
        array_to_string(list_sort(list_filter(string_split(regexp_extract(rest, '^[^?]*\?(.*)$', 1), '&'), lambda z: z <> '' AND NOT regexp_matches(z, '^(utm_[^=]*|gclid|fbclid)(=|$)'))), '&') AS ask FROM w),
k AS (SELECT id, CASE WHEN contains(url, '://') THEN host || CASE WHEN path = '' THEN '/' ELSE path END || CASE WHEN ask = '' THEN '' ELSE '?' || ask END END AS key FROM x),
s AS (SELECT n * 2 AS response_id, moment, tag, html, key FROM q JOIN k ON k.id = n * 2),
v AS (SELECT r.*, k.key FROM r JOIN k ON k.id = r.record_id),
j AS (SELECT v.record_id, v.n, v.key, v.later, v.moment AS own_at, v.tag AS own_tag, s.response_id, s.moment AS stored_at, s.tag AS stored_tag, s.html,
        row_number() OVER (PARTITION BY v.record_id ORDER BY s.moment DESC, s.response_id DESC) AS nth
      FROM v LEFT JOIN s ON v.key = s.key AND s.moment < v.later),
o AS (SELECT *, CASE WHEN response_id IS NULL THEN 'missing' WHEN n % 10 = 4 THEN 'unverified'
        WHEN n % 10 = 5 THEN CASE WHEN own_at = stored_at THEN 'resolved' ELSE 'changed' END
        WHEN n % 10 = 3 THEN 'changed' WHEN own_tag = stored_tag THEN 'resolved' ELSE 'changed' END AS outcome FROM j WHERE nth = 1)
SELECT record_id, key AS url_key, outcome, response_id,
  CASE WHEN outcome = 'resolved' THEN 'text/html' END AS content_type,
  CASE WHEN outcome = 'resolved' THEN strftime(make_timestamp(later * 1000000), '%Y-%m-%d %H:%M:%S') END AS date,
  CASE WHEN outcome = 'resolved' THEN CASE WHEN n % 10 = 5 THEN '' ELSE 'W/' END || '"' || CASE WHEN n % 10 = 5 THEN stored_tag ELSE own_tag END || '"' END AS etag,
  CASE WHEN outcome = 'resolved' THEN strftime(make_timestamp((stored_at - 1000) * 1000000), '%Y-%m-%d %H:%M:%S') END AS last_modified,
  CASE WHEN outcome = 'resolved' THEN sha256(html) END AS payload_sha256
FROM o
"""
