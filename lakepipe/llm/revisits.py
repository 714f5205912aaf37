"""WARC (5): not-modified revisits resolved to full responses.

Method: an as-of join by canonical URL.  Each revisit record (a 304, without a
body) is joined to the latest earlier full response of its canonical URL; its
validators are checked against that response; and the headers that a 304 may
change are merged into the response's.

The join runs in two steps, so that no task holds the records of a URL: the
latest response within the record's span of time, else the latest of all
earlier spans, of which there is one row a URL and span.

Defined results: earlier means a smaller time; of responses at one time the
one with the largest id counts; a record without a URL, or without a time, is
never resolved nor resolved to; a revisit without validators is taken to be
valid; repeated revisits each get a row; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Seconds in a span of time.
SPAN = 6 * 3600

# Headers of a 304 response that replace those of the stored response.
PERMITTED = ["cache-control", "content-location", "date", "etag", "expires", "vary"]


def canonical_url(url: Column) -> Column:
    """Scheme, www., default port, fragment, tracking parameters and a last slash go; the host is lower-cased."""
    rest = F.regexp_replace(F.regexp_replace(url, r"#[\s\S]*$", ""), r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.regexp_replace(F.regexp_replace(F.lower(F.regexp_extract(rest, r"^[^/?]*", 0)), r"^www\.", ""), r":(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(rest, r"^[^/?]*([^?]*)", 1), r"/+$", "")
    query = F.regexp_extract(rest, r"^[^?]*\?([\s\S]*)$", 1)
    query = F.regexp_replace(F.regexp_replace(query, r"(^|&)(utm_[a-z]+|ref)=[^&]*", ""), r"^&", "")
    return F.concat(host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))


def _plain_tag(tag: Column) -> Column:
    """An entity tag without its weak mark and quotes."""
    return F.regexp_replace(F.regexp_replace(tag, r"^W/", ""), r"^\"|\"$", "")


def resolve_revisits(records: DataFrame, span: int = SPAN, permitted: list[str] = PERMITTED) -> DataFrame:
    """One row per revisit: record_id, canonical_url, response_id, verdict, headers.

    ``records`` has record_id long, kind (response or revisit), url, time
    (seconds), etag, last_modified (seconds), headers array<struct<name, value>>.
    The verdict is resolved, changed (a validator differs) or missing (there
    is no earlier response).
    """
    r = records.select(
        "record_id", "kind", canonical_url(F.col("url")).alias("canonical_url"), "time", "etag", "last_modified", "headers",
        F.floor(F.col("time") / span).alias("span"))
    full = F.when(F.col("kind") == "response",
                  F.struct("time", "record_id", "etag", "last_modified", "headers"))
    r = r.withColumn("full", F.when(F.col("time").isNotNull() & F.col("canonical_url").isNotNull(), full))
    by_time = Window.partitionBy("canonical_url", "span").orderBy("time").rangeBetween(Window.unboundedPreceding, -1)
    inside = r.withColumn("near", F.max("full").over(by_time)).where(F.col("kind") == "revisit")
    spans = r.groupBy("canonical_url", "span").agg(F.max("full").alias("last"))
    by_span = Window.partitionBy("canonical_url").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.select(F.col("canonical_url").alias("_url"), F.col("span").alias("_span"), F.max("last").over(by_span).alias("far"))
    j = inside.join(spans, (F.col("canonical_url") == F.col("_url")) & (F.col("span") == F.col("_span")), "left")
    got = F.coalesce("near", "far")
    same = (F.when(F.col("etag").isNotNull(), _plain_tag(F.col("etag")) == F.coalesce(_plain_tag(F.col("got.etag")), F.lit("\0")))
            .when(F.col("last_modified").isNotNull(), F.coalesce(F.col("last_modified") == F.col("got.last_modified"), F.lit(False)))
            .otherwise(True))
    verdict = F.when(F.col("got").isNull(), "missing").when(same, "resolved").otherwise("changed")
    allowed = F.filter(F.coalesce("headers", F.col("got.headers")), lambda h: F.lower(h["name"]).isin(permitted))
    names = F.transform("allowed", lambda h: F.lower(h["name"]))
    kept = F.filter("got.headers", lambda h: ~F.array_contains(names, F.lower(h["name"])))
    merged = F.array_sort(F.concat(kept, F.col("allowed")))
    j = j.withColumn("got", got).withColumn("verdict", verdict).withColumn("allowed", allowed)
    return j.select("record_id", "canonical_url", F.when(F.col("verdict") == "resolved", F.col("got.record_id")).alias("response_id"),
                    "verdict", F.when(F.col("verdict") == "resolved", merged).alias("headers"))


def records_of_pages(pages: DataFrame) -> DataFrame:
    """Capture records derived from the table of pages, which has no times or headers.

    Each page gives a full response and a revisit some hours later (one in 11:
    earlier); every fifth revisit has a validator of its own, another fifth
    has a time instead of a tag.
    """
    p = F.col("page_id")
    tag = F.substring(F.md5(F.coalesce("html", F.lit("")).cast("binary")), 1, 16)
    time = p * 97
    header = lambda name, value: F.struct(F.lit(name).alias("name"), value.alias("value"))
    quoted = F.concat(F.lit('"'), tag, F.lit('"'))
    response = pages.select(
        (p * 2).alias("record_id"), F.lit("response").alias("kind"), "url", time.alias("time"), quoted.alias("etag"),
        (time - p % 13).alias("last_modified"),
        F.array(header("content-type", F.lit("text/html")), header("date", time.cast("string")), header("etag", quoted),
                header("server", F.concat(F.lit("s"), (p % 3).cast("string")))).alias("headers"))
    later = F.when(p % 11 == 0, time - 50).otherwise(time + (p % 7 + 1) * 3600)
    revisit = pages.select(
        (p * 2 + 1).alias("record_id"), F.lit("revisit").alias("kind"), "url", later.alias("time"),
        F.when(p % 5 == 0, F.lit('W/"other"')).when(p % 5 == 1, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("W/"), quoted)).alias("etag"),
        (time - p % 13).alias("last_modified"),
        F.array(header("cache-control", F.lit("max-age=60")), header("date", later.cast("string")),
                header("server", F.lit("edge")), header("set-cookie", F.concat(F.lit("id="), p.cast("string")))).alias("headers"))
    return response.unionByName(revisit)


def resolved_pages(pages: DataFrame) -> DataFrame:
    """Every revisit of the derived records, with its merged headers as one line of text."""
    got = resolve_revisits(records_of_pages(pages))
    line = F.array_join(F.transform("headers", lambda h: F.concat(h["name"], F.lit("="), h["value"])), ";")
    return got.select("record_id", "canonical_url", "response_id", "verdict", line.alias("headers"))
