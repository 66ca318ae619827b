"""URL filters by host-suffix and path-prefix expressions and short hash prefixes.

A URL is expanded into every host suffix joined with every path prefix a rule could have. An
expression meets a rule on the first four bytes of its digest; the full digests then have to
agree, and of the rules that fit the longest decides. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crmweave.llm.common import pick
from crmweave.session import write_table

PREFIX_BYTES = 4
ALLOW, BLOCK = "allow", "block"
# The ASCII letters that a host's case folding covers.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case."""
    return F.translate(F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1)


def _with_digest(df: DataFrame) -> DataFrame:
    # A tab cannot be part of a host, so host and path cannot run into each other.
    digest = F.unhex(F.sha2(F.concat_ws("\t", "host", "path"), 256))
    return df.withColumn("digest", digest).withColumn("prefix", F.substring("digest", 1, PREFIX_BYTES))


def url_verdicts(urls: DataFrame, rules: DataFrame, default: str = ALLOW) -> DataFrame:
    """``(url, host, path, rule, verdict)`` for every distinct ``url``.

    ``rules`` has ``(host, path, verdict)``. A rule fits its host and all subdomains whose
    path starts with the rule's; the longest text ``host + path`` wins, then the longest host,
    then ``block``. A null host, path or verdict makes a rule void; an empty host fits every
    URL. Without a rule that fits, ``rule`` is null and the verdict is ``default``. A null
    url, or one without ``://``, has an empty host and path. Work grows with the distinct
    URLs: a hot URL is expanded once.
    """
    distinct = pick(urls, "url").distinct()
    parsed = distinct.select(
        "url",
        F.coalesce(host_of(F.col("url")), F.lit("")).alias("host"),
        F.coalesce(path_of(F.col("url")), F.lit("")).alias("path"),
    )
    listed = pick(rules, "host", "path", "verdict").na.drop().distinct()
    # Path lengths that occur, at most as many as the longest rule path has characters.
    lengths = listed.agg(F.sort_array(F.collect_set(F.length("path")))).scalar()
    labels = F.split("host", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels) - i + 1), "."),
    )
    hosts = F.array_distinct(F.concat(suffixes, F.array(F.lit(""))))
    fitting = F.filter("lengths", lambda n: n <= F.length("path"))
    expressions = (
        parsed.withColumn("lengths", lengths)
        .select("url", "path", F.explode(hosts).alias("host"), fitting.alias("lengths"))
        .select("url", "host", F.explode("lengths").alias("n"), "path")
        .select("url", "host", F.expr("left(path, n)").alias("path"))
    )
    keyed = _with_digest(listed).select(
        "prefix", F.col("digest").alias("rule_digest"), F.concat("host", "path").alias("rule"),
        F.length("host").alias("host_length"), "verdict",
    )
    confirmed = _with_digest(expressions).join(keyed, "prefix").where("digest = rule_digest")
    rank = F.struct(F.length("rule"), "host_length", F.col("verdict") == BLOCK, "rule", "verdict")
    best = confirmed.groupBy("url").agg(F.max(rank).alias("best"))
    # The aggregate's url is a new name, and null-safe: a null url has expressions as well.
    best = best.select(F.col("url").alias("found"), "best.rule", "best.verdict")
    return parsed.join(best, F.col("url").eqNullSafe(F.col("found")), "left").select(
        "url", "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict")
    )


def filter_urls(pages: DataFrame, rules: DataFrame, default: str = ALLOW) -> DataFrame:
    """``(page_id, host, path, rule, verdict)`` for every row of ``pages``.

    Repeated rows and rows with a null id stay. Only ``page_id`` and ``url`` are read. The
    verdicts are written before they are joined: their side of the join then is a plain
    exchange, and the rows of a hot URL, or of none, can be dealt over several tasks.
    """
    rows = pick(pages, "page_id", "url")
    verdicts = write_table(url_verdicts(rows, rules, default), "verdicts").withColumnRenamed("url", "__url")
    joined = rows.join(verdicts, F.col("url").eqNullSafe(F.col("__url")))
    return joined.select("page_id", "host", "path", "rule", "verdict")
