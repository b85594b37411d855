"""URL filter: written rules first, then a path-template tree per host.

A url's path becomes a template level by level: inside a host and under the
template so far, a segment stays as written while it carries a fair share of
the urls there, and rare segments of a place with many different ones become
``*``.  Levels go on until no place has enough different urls left for a ``*``.
Then, from the deepest place with siblings up to the host, a branch that cannot
be told from the pooled urls of its place (same mix of templates below it, same
labelled rate) is merged with its siblings.  A template is rejected when its smoothed share of urls with a bad
label reaches ``reject_at``; the prior of a template is its host's smoothed
share, the prior of a host is the share over all urls.

Labels come from seed words in host or path.  The written rules are not used
as labels, because they would spread beyond the paths they name.

Everything is aggregates and equi-joins over (host, template) keys, combined
before each shuffle, so a host with a third of all urls stays split.

Defined results: a NULL url or one without ``://`` has an empty host and path
and is judged like any other of that host; repeated rows are judged each; an
empty table gives an empty result; all other input columns are ignored.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarterline.llm import common


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str


# Words of unwanted sites: gambling, adult, pills, spam, adverts and tracking, malware.
SEED_WORDS = ("adult", "porn", "porno", "xxx", "sex", "escort", "casino", "bet", "bets", "betting", "poker", "gambling",
              "jackpot", "pills", "viagra", "cialis", "pharmacy", "spam", "spammer", "ads", "advert", "adserver",
              "doubleclick", "track", "tracker", "tracking", "malware", "phishing", "warez", "torrent", "payday")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(rest, UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(rules: list[Rule], host: Column, path: Column) -> tuple[Column, Column]:
    """(rule text, verdict) of the longest rule that fits, else NULLs."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.host) + len(r.path), r)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        text = F.when(fits, F.lit(r.host + r.path)).otherwise(text)
        verdict = F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    return text, verdict


def seeded(host: Column, path: Column, words: tuple[str, ...] = SEED_WORDS) -> Column:
    """True where a word of the host or the path is a seed word."""
    return F.lower(F.concat(host, F.lit("/"), path)).rlike(r"(?:^|[^a-z0-9])(?:" + "|".join(words) + r")(?:[^a-z0-9]|$)")


def shape(path: Column) -> Column:
    """The path's segments with ids replaced, joined by ``/``."""
    ids = F.regexp_replace(path, r"[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F-]{22}", "{id}")
    ids = F.regexp_replace(ids, r"[0-9]+", "{n}")
    return F.array_join(F.filter(F.split(ids, "/"), lambda s: s != ""), "/")


def templates(urls: DataFrame, min_children: int = 16, min_share: float = 0.01, min_rows: int = 5,
              far: float = 0.2, weight: float = 5.0) -> DataFrame:
    """``(host, shape, template, purity)`` from ``urls(host, shape, bad BOOLEAN)``."""
    t = urls.groupBy("host", "shape").agg(F.count("*").alias("n"), F.sum(F.col("bad").cast("long")).alias("bad"))
    parts = F.filter(F.split("shape", "/"), lambda x: x != "")
    t = common.staged(t.select("host", "shape", "n", "bad", parts.alias("segs")), "url-shapes")
    live, done, depth = t.withColumn("place", F.lit("")), [], 0
    while depth == 0 or not live.isEmpty():
        live = live.withColumn("s", F.coalesce(F.get("segs", F.lit(depth)), F.lit("")))  # "" where the path ends
        child = live.groupBy("host", "place", "s").agg(F.sum("n").alias("_c"), F.count("*").alias("_shapes"))
        place = child.groupBy("host", "place").agg(F.sum("_c").alias("_all"), F.count("*").alias("_kinds"))
        rare = ((F.col("s") != "") & (F.col("_kinds") >= min_children)
                & ((F.col("_c") < min_rows) | (F.col("_c") < min_share * F.col("_all"))))
        child = child.join(place, ["host", "place"]).withColumn("g", F.when(rare, "*").otherwise(F.col("s")))
        below = child.groupBy("host", "place", "g").agg(F.sum("_shapes").alias("_below"))
        child = child.join(below, ["host", "place", "g"]).select(
            "host", "place", "s", "g", ((F.col("s") != "") & (F.col("_below") >= min_children)).alias("_open"))  # else no "*" below
        live = live.join(child, ["host", "place", "s"])
        new = F.concat(F.slice("segs", 1, depth), F.array("g"), F.slice("segs", depth + 2, F.greatest(F.size("segs"), F.lit(1))))
        live = common.staged(live.select("host", "shape", "n", "bad", F.when(F.col("s") != "", new).otherwise(F.col("segs")).alias("segs"),
                                         F.concat_ws("/", "place", "g").alias("place"), "_open"), f"url-level-{depth}")
        done.append(live.filter("not _open").drop("place", "_open"))
        live = live.filter("_open").drop("_open")
        depth += 1
    t = done[0]
    for d in done[1:]:
        t = t.union(d)

    # depths at which some place has siblings, by hashes of the segments above
    steps = F.transform(F.sequence(F.lit(0), F.size("segs")), lambda i: F.struct(
        i.alias("depth"), F.xxhash64(F.slice("segs", F.lit(1), i)).alias("head"), F.coalesce(F.get("segs", i), F.lit("")).alias("s")))
    heads = t.select("host", F.explode(steps).alias("at")).groupBy("host", "at.depth", "at.head").agg(F.min("at.s").alias("lo"), F.max("at.s").alias("hi"))
    depths = sorted((r[0] for r in heads.filter("lo <> hi").select("depth").distinct().collect()), reverse=True)
    for d in depths:
        t = common.staged(_merged(t, d, far), f"url-merged-{d}")
    bad, every = t.agg(F.coalesce(F.sum("bad"), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0))).first()
    hosts = t.groupBy("host").agg(F.sum("n").alias("hn"), F.sum("bad").alias("hb"))
    by_host = hosts.select("host", ((F.col("hb") + weight * bad / max(1, every)) / (F.col("hn") + weight)).alias("prior"))
    t = t.select("host", "shape", "n", "bad", F.array_join("segs", "/").alias("path"))
    whole = t.groupBy("host", "path").agg(F.sum("n").alias("tn"), F.sum("bad").alias("tb"))
    purity = (F.col("tb") + weight * F.col("prior")) / (F.col("tn") + weight)
    whole = whole.join(by_host, "host").select("host", "path", purity.alias("purity"))
    return t.join(whole, ["host", "path"]).select("host", "shape", F.concat("host", F.lit("/"), "path").alias("template"), "purity")


def _merged(t: DataFrame, depth: int, far: float) -> DataFrame:
    """``t`` with ``*`` for the segment at ``depth`` of every branch that is like the pool of its place."""
    t = t.select("*", F.array_join(F.slice("segs", 1, depth), "/").alias("place"), (F.size("segs") >= depth).alias("_there"),
                 F.coalesce(F.get("segs", F.lit(depth)), F.lit("")).alias("s"),
                 F.array_join(F.slice("segs", depth + 2, F.greatest(F.size("segs"), F.lit(1))), "/").alias("below"))
    leaf = t.filter("_there").groupBy("host", "place", "s", "below").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    branch = leaf.groupBy("host", "place", "s").agg(F.sum("n").alias("bn"), F.sum("bad").alias("bb"))
    places = branch.groupBy("host", "place").agg(F.sum("bn").alias("hn"), F.sum("bb").alias("hb"), F.count("*").alias("kinds"))
    pooled = leaf.groupBy("host", "place", "below").agg(F.sum("n").alias("pn"))
    rate, share = F.col("hb") / F.col("hn"), F.col("bb") / F.col("bn")
    noise = 3 * F.sqrt(rate * (1 - rate) / F.col("bn")) + 1 / F.col("bn")
    like = (leaf.join(pooled, ["host", "place", "below"]).join(branch, ["host", "place", "s"]).join(places.filter("kinds > 1"), ["host", "place"])
            .groupBy("host", "place", "s", "bn", "bb", "hn", "hb")
            .agg(F.sum(F.least(F.col("n") / F.col("bn"), F.col("pn") / F.col("hn"))).alias("overlap"))
            .filter((F.col("s") != "") & (F.col("overlap") >= 1 - far) & (F.abs(share - rate) <= noise))
            .select("host", "place", "s", F.lit(True).alias("_like")))
    new = F.concat(F.slice("segs", 1, depth), F.array(F.lit("*")), F.slice("segs", depth + 2, F.greatest(F.size("segs"), F.lit(1))))
    return t.join(like, ["host", "place", "s"], "left").select(
        "host", "shape", "n", "bad", F.when(F.col("_like") & F.col("_there"), new).otherwise(F.col("segs")).alias("segs"))


def judge(pages: DataFrame, rules: list[Rule], words: tuple[str, ...] = SEED_WORDS, reject_at: float = 0.5,
          id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """``(page_id, host, path, rule, verdict, template, purity)`` for every row of ``pages``."""
    host, path = host_of(F.col(url_col)), path_of(F.col(url_col))
    urls = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    rule, written = rule_of(rules, F.col("host"), F.col("path"))
    urls = urls.withColumn("shape", shape(F.col("path")))
    known = templates(urls.select("host", "shape", seeded(F.col("host"), F.col("path"), words).alias("bad")))
    learned = F.when(F.col("purity") >= reject_at, "block").otherwise("allow")
    return urls.join(known, ["host", "shape"]).select(
        "page_id", "host", "path", rule.alias("rule"), F.coalesce(written, learned).alias("verdict"), "template", "purity")
