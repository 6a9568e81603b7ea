"""URL filter: a blocked Bloom filter of listed canonical URLs, then an exact join of its possible hits.

The filter is a table of 256-bit blocks (four longs); a URL sets eight bits of one block. It has as many blocks as the
list needs at ``bits`` bits a URL. Up to ``broadcast_blocks`` blocks it is broadcast (40 bytes each), beyond that it is
joined by block number. URLs that pass are joined to the list itself, so false positives cost a shuffle row and nothing else.

Columns of the pages are kept as they are; a column of ours whose name they have gets underscores before its name.
Nulls and strings without ``://`` have empty host and path, fit no rule and no listed URL. Repeated rows each get a result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BLOOM_BITS, bloom_filter, bloom_fits, bloom_place, lower_ascii, materialize, own_name, shared_folder, table

#: The query's rules (verdict, host, path).
RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]
#: Query parameters that do not name another page.
TRACKING = "utm_[a-z]+|ref|gclid|fbclid"
BROADCAST_BLOCKS = 1 << 20


def parts(url) -> dict:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    return {"host": F.coalesce(lower_ascii(F.regexp_extract(rest, "^([^/?#]*)", 1)), F.lit("")), "path": F.coalesce(F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1), F.lit("")), "query": F.coalesce(F.regexp_extract(rest, r"^[^?#]*\?([^#]*)", 1), F.lit(""))}


def canonical(host, path, query):
    """host without a leading www. and default port, path without closing slashes, parameters sorted and without tracking; null without a host."""
    h = F.regexp_replace(F.regexp_replace(host, "^www[.]", ""), ":(80|443)$", "")
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(f"^({TRACKING})(=|$)")))
    q = F.array_join(kept, "&")
    return F.when(host != "", F.concat(h, F.regexp_replace(path, "/+$", ""), F.when(q != "", F.concat(F.lit("?"), q)).otherwise("")))


def ruled(df: DataFrame, rules=RULES) -> DataFrame:
    """Adds rule and rule_verdict of the longest rule that fits host and path; few rules, so they are expressions."""
    found = [(v, f"{h}{p}", ((F.col("host") == h) | F.col("host").endswith(f".{h}")) & F.col("path").startswith(p)) for v, h, p in sorted(rules, key=lambda r: -len(r[1] + r[2]))]
    pick = lambda k: reduce(lambda rest, r: F.when(r[2], F.lit(r[k])).otherwise(rest), reversed(found), F.lit(None).cast("string"))
    return df.withColumns({"rule": pick(1), "rule_verdict": pick(0)})


def judge(pages: DataFrame, listed: DataFrame, rules=RULES, bits: int = BLOOM_BITS, broadcast_blocks: int = BROADCAST_BLOCKS) -> DataFrame:
    """pages (with url) plus host, path, canonical, rule, possible (passed the Bloom filter), listed, verdict.

    listed: canonical; null and repeated entries are ignored.
    """
    folder = shared_folder(pages.sparkSession)
    listed = materialize(listed.select("canonical").where("canonical is not null").distinct(), folder, "listed")
    bloom, blocks = bloom_filter(listed, "canonical", listed.count(), bits)
    bloom = materialize(bloom, folder, "bloom")
    if blocks <= broadcast_blocks:
        bloom = F.broadcast(bloom)
    df = pages.select(F.struct(*pages.columns).alias("given")).withColumns(parts(F.col("given.url")))
    df = ruled(df.withColumn("canonical", canonical(F.col("host"), F.col("path"), F.col("query"))).drop("query"), rules)
    df = df.withColumns(bloom_place(F.coalesce("canonical", F.lit("")), blocks)).join(bloom, "block", "left")
    df = df.withColumn("possible", F.coalesce(bloom_fits() & F.col("canonical").isNotNull(), F.lit(False)))
    kept = ["given", "host", "path", "canonical", "rule", "rule_verdict", "possible"]
    hits = df.where("possible").select(kept).join(listed.withColumn("listed", F.lit(True)), "canonical", "left")
    df = df.where("not possible").select(*kept, F.lit(False).alias("listed")).unionByName(hits.select(*kept, F.coalesce("listed", F.lit(False)).alias("listed")))
    df = df.withColumn("verdict", F.coalesce("rule_verdict", F.when(F.col("listed"), "block").otherwise("allow")))
    added = ["host", "path", "canonical", "rule", "possible", "listed", "verdict"]
    return df.select(*[F.col("given").getField(c).alias(c) for c in pages.columns], *[F.col(c).alias(own_name(c, pages.columns)) for c in added])


def op6_url_filter(spark, sf_dir: str) -> DataFrame:
    """The list: canonical URLs of the pages whose page_id is divisible by 50."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    listed = pages.where("page_id % 50 = 0").withColumns(parts(F.col("url"))).select(canonical(F.col("host"), F.col("path"), F.col("query")).alias("canonical"))
    return judge(pages, listed).select("page_id", "host", "path", "rule", "verdict", "listed")


def op6_sql() -> str:
    rules = sorted(RULES, key=lambda r: -len(r[1] + r[2]))
    case = lambda k: "CASE " + " ".join(f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{(v, h + p)[k]}'" for v, h, p in rules) + " END"
    return rf"""
WITH a AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
b AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path, regexp_extract(rest, '^[^?#]*\?([^#]*)', 1) AS query FROM a),
c AS (SELECT *, array_to_string(list_sort(list_filter(string_split(query, '&'), lambda p: p <> '' AND NOT regexp_matches(p, '^({TRACKING})(=|$)'))), '&') AS q FROM b),
d AS (SELECT *, CASE WHEN host <> '' THEN regexp_replace(regexp_replace(host, '^www[.]', ''), ':(80|443)$', '') || regexp_replace(path, '/+$', '') || CASE WHEN q <> '' THEN '?' || q ELSE '' END END AS canonical FROM c),
e AS (SELECT *, coalesce(canonical IN (SELECT canonical FROM d WHERE page_id % 50 = 0 AND canonical IS NOT NULL), false) AS listed FROM d)
SELECT page_id, host, path, {case(1)} AS rule, coalesce({case(0)}, CASE WHEN listed THEN 'block' ELSE 'allow' END) AS verdict, listed FROM e"""
