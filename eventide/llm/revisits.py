"""Not-modified revisits of a web archive, resolved to full responses.

Records are captures of a URL: full responses, and revisits that carry only
headers.  A revisit is resolved by an as-of join on the canonical URL: the
latest full response before it (by time, then record id).  Its validators must
agree (entity tags by weak comparison, else the modification date, else the
payload digest; the first that both sides have decides), and the headers of the
revisit that a not-modified answer may change replace those of the response.

The as-of join runs in two levels: windows within (URL, span of time), and the
last response of each span carried over the spans of a URL.  A URL that holds a
third of all captures is so dealt over its spans, and of a span only one row
travels.  Payloads are not moved: the result names the response.

Null URLs resolve to nothing (they are no response, and their rows are dealt over
spans of their own); a null time comes before all others; null headers
count as none; repeated records are resolved each on its own; an empty table
gives an empty table; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from eventide.session import cut_lineage

#: Seconds of a span.
SPAN = 86_400
# Headers a not-modified answer must not change (those of the
# payload and of the connection).
KEPT_HEADERS = ("connection", "content-encoding", "content-length", "content-range", "content-type",
                "keep-alive", "proxy-authenticate", "proxy-connection", "te", "trailer",
                "transfer-encoding", "upgrade")
# Query parameters that only track.
TRACKING = ("utm_[a-z]+", "ref", "fbclid", "gclid", "sessionid")


def canonical_url(url: Column) -> Column:
    """Scheme, ``www.``, ``m.`` and default ports, the fragment, tracking
    parameters, an ``.html`` ending and the last slash do not tell URLs apart;
    the host is lower case."""
    u = F.regexp_replace(F.btrim(url), "#.*$", "")
    u = F.regexp_replace(u, "(?i)^https?://", "")
    host = F.regexp_replace(F.regexp_replace(F.lower(F.regexp_extract(u, "^[^/?]*", 0)), r"^(?:www|m)\.", ""), ":(?:80|443)$", "")
    path = F.regexp_extract(u, r"^[^/?]*([^?]*)", 1)
    path = F.regexp_replace(F.regexp_replace(path, r"\.html?$", ""), "/+$", "")
    query = F.regexp_extract(u, r"\?(.*)$", 1)
    query = F.regexp_replace(query, f"(?:^|&)(?:{'|'.join(TRACKING)})=[^&]*", "")
    query = F.regexp_replace(query, "^&", "")
    return F.concat(host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(F.lit("")))


def _weak(tag: Column) -> Column:
    return F.regexp_replace(tag, '^W/', "")


def validates(response: Column, revisit: Column) -> Column:
    """Whether the first validator that both have agrees (null: none in common)."""
    checks = [(_weak(response["etag"]), _weak(revisit["etag"])), (response["last_modified"], revisit["last_modified"]),
              (response["digest"], revisit["digest"])]
    out = F.lit(None).cast("boolean")
    for a, b in reversed(checks):
        out = F.when(a.isNotNull() & b.isNotNull(), a == b).otherwise(out)
    return out


def merged_headers(response: Column, revisit: Column) -> Column:
    """Headers of the response, with the permitted ones of the revisit over them
    (names in lower case)."""
    def lower(m: Column) -> Column:
        entries = F.transform(F.map_entries(F.coalesce(m, F.create_map().cast("map<string,string>"))), lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")))
        names = F.array_distinct(F.transform(entries, lambda e: e["key"]))
        # Of names that differ in case only the last one counts.
        return F.map_from_arrays(names, F.transform(names, lambda k: F.element_at(F.filter(entries, lambda e: e["key"] == k), -1)["value"]))
    new = F.map_filter(lower(revisit), lambda k, _: ~k.isin(*KEPT_HEADERS))
    old = lower(response)
    return F.map_concat(F.map_filter(old, lambda k, _: ~F.map_contains_key(new, k)), new)


def resolve(records: DataFrame, span: int = SPAN) -> DataFrame:
    """``records`` has ``record_id, url, ts (timestamp), full (boolean), etag,
    last_modified, digest, headers (map)``.  One row per revisit:
    ``record_id, url, response_id, outcome, headers``; outcome is ``resolved``,
    ``mismatch`` (validators disagree), ``unchecked`` (none in common) or
    ``orphan`` (no earlier response); headers are merged where resolved, the
    revisit's own otherwise."""
    base = records.select(
        "record_id", canonical_url(F.col("url")).alias("u"), F.coalesce(F.unix_micros("ts"), F.lit(-(1 << 62))).alias("at"),
        F.coalesce("full", F.lit(False)).alias("full"), "etag", "last_modified", "digest", "headers")
    lost = F.col("u").isNull()
    base = base.withColumn("span", F.when(lost, F.xxhash64("record_id", "at", "etag", "digest")).otherwise(F.floor(F.col("at") / (span * 1_000_000))))
    answer = F.when(F.col("full") & ~lost, F.struct("at", "record_id", "etag", "last_modified", "digest", "headers"))
    # At the same time a revisit comes first: the response must be earlier.
    order = ["at", F.col("full").cast("int"), "record_id"]
    near = Window.partitionBy("u", "span").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = base.withColumn("near", F.last(answer, ignorenulls=True).over(near)).where("NOT full")
    spans = base.where("full AND u IS NOT NULL").select("u", "span", F.struct("at", "record_id", "etag", "last_modified", "digest", F.map_entries("headers").alias("headers")).alias("r"))
    spans = spans.groupBy("u", "span").agg(F.max_by("r", F.struct(F.col("r.at"), F.col("r.record_id"))).alias("r"))
    open_ = local.where("near IS NULL AND u IS NOT NULL").select("u", "span").distinct().withColumn("r", F.lit(None).cast(spans.schema["r"].dataType))
    earlier = Window.partitionBy("u").orderBy("span").rangeBetween(Window.unboundedPreceding, -1)
    carried = (spans.unionByName(open_).groupBy("u", "span").agg(F.first("r", ignorenulls=True).alias("r"))
               .withColumn("far", F.last("r", ignorenulls=True).over(earlier)).where("far IS NOT NULL").select("u", "span", "far"))
    carried = cut_lineage(carried)
    met = local.join(carried, ["u", "span"], "left")
    far = F.struct(F.col("far.at"), F.col("far.record_id"), F.col("far.etag"), F.col("far.last_modified"), F.col("far.digest"),
                   F.map_from_entries("far.headers").alias("headers"))
    met = met.withColumn("r", F.coalesce("near", F.when(F.col("far").isNotNull(), far)))
    agrees = validates(F.col("r"), F.struct("etag", "last_modified", "digest"))
    met = met.withColumn("outcome", F.when(F.col("r").isNull(), "orphan").when(agrees.isNull(), "unchecked").when(agrees, "resolved").otherwise("mismatch"))
    return met.select("record_id", F.col("u").alias("url"), F.col("r.record_id").alias("response_id"), "outcome",
                      F.when(F.col("outcome") == "resolved", merged_headers(F.col("r.headers"), F.col("headers"))).otherwise(F.col("headers")).alias("headers"))


def captures(pages: DataFrame) -> DataFrame:
    """Crawl records of the pages table: page ``p`` is a full response, captured
    at ``p * 997 % 100000`` minutes, with tag and digest of its html.  Four
    revisits ``k`` of its URL (in another spelling) come at ``(p * 997 + k *
    7919) % 100000`` minutes; the third has a tag of its own, the fourth
    no tag but the digest.  Rows without a page_id make no records."""
    tag = F.md5("html")
    full = pages.where("page_id IS NOT NULL").select("page_id", "url", tag.alias("tag"), F.octet_length("html").alias("size"))
    made = full.withColumn("k", F.explode(F.array(*map(F.lit, range(5)))))
    minute = F.pmod(F.col("page_id") * 997 + F.col("k") * 7919, F.lit(100_000))
    k = F.col("k")
    spelled = F.when(k == 1, F.concat("url", F.lit("#top"))).when(k == 2, F.regexp_replace("url", "^https?://", "HTTPS://www.")).otherwise(F.col("url"))
    headers = F.map_from_entries(F.filter(F.array(
        F.struct(F.lit("ETag").alias("key"), F.col("tag").alias("value")),
        F.struct(F.lit("Date").alias("key"), minute.cast("string").alias("value")),
        F.struct(F.lit("Content-Length").alias("key"), F.when(k == 0, F.col("size").cast("string")).otherwise(F.lit("0")).alias("value")),
        F.struct(F.lit("Server").alias("key"), F.when(k == 0, F.lit("origin")).alias("value")),
        F.struct(F.lit("Age").alias("key"), F.when(k > 0, k.cast("string")).alias("value"))), lambda e: e["value"].isNotNull()))
    return made.select(
        (F.col("page_id") * 5 + k).alias("record_id"), spelled.alias("url"), F.timestamp_seconds(minute * 60).alias("ts"), (k == 0).alias("full"),
        F.when(k == 3, F.concat(F.lit("x"), "tag")).when(k == 4, None).when(k == 2, F.concat(F.lit("W/"), "tag")).otherwise(F.col("tag")).alias("etag"),
        F.lit(None).cast("string").alias("last_modified"), tag_digest().alias("digest"), headers.alias("headers"))


def tag_digest() -> Column:
    return F.when(F.col("k").isin(0, 4), F.col("tag"))
