"""URL filters: rules on a host with its subdomains and a path prefix, found by hash equi-joins.

A URL is expanded into host-suffix + path-prefix expressions (prefixes end at slashes; the rest of a
rule's path is compared after the join). Expressions meet rules on the first 32 bits of a SHA-256
digest; a hit counts only if the full digests agree. The work is done once per distinct (host, path).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lower_ascii, text_or_empty

PREFIX_HEX = 8


def host_and_path(url: Column | str) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path: then up to
    ``?``, ``#`` or the end. Both are empty for a null url and for one without ``://``."""
    url = text_or_empty(url)
    at = F.instr(url, "://")
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest.substr(F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return lower_ascii(host), path


def _directory(path: Column) -> Column:
    """The path up to its last slash, with it; empty without a slash."""
    return F.regexp_extract(path, r"(?s)^.*/", 0)


def prepare_rules(rules: DataFrame) -> DataFrame:
    """Rules (host, path, action) with digest, label and depth; of rules for the same host and path, block wins.

    Rows with a null or empty host are left out: they name no host. A null path is an empty one.
    """
    host, path = lower_ascii(F.trim(F.col("host"))), text_or_empty("path")
    named = (rules.where(F.length(F.trim(F.col("host"))) > 0).select(host.alias("rule_host"), path.alias("rule_path"), "action")
             .groupBy("rule_host", "rule_path").agg(F.max(F.col("action") == "block").alias("blocks")))
    directory = _directory(F.col("rule_path"))
    return named.select(
        "rule_path", F.concat("rule_host", "rule_path").alias("rule"), F.when(F.col("blocks"), "block").otherwise("allow").alias("action"),
        F.length("rule_host").alias("host_length"), F.size(F.split("rule_host", r"\.")).alias("labels"),
        (F.size(F.split(directory, "/")) - 1).alias("depth"),
        F.sha2(F.concat(F.col("rule_host"), F.lit("\n"), directory), 256).alias("rule_digest"))


def expressions(host: Column, path: Column, labels: int, depth: int) -> Column:
    """All host suffixes of at most ``labels`` labels with all slash-ended path prefixes of at most ``depth`` slashes."""
    parts, slashes = F.split(host, r"\."), F.size(F.split(path, "/")) - 1
    suffixes = F.transform(F.sequence(F.lit(1), F.least(F.size(parts), F.lit(max(labels, 1)))),
                           lambda n: F.array_join(F.slice(parts, F.size(parts) - n + 1, n), "."))
    prefixes = F.transform(F.sequence(F.lit(0), F.least(slashes, F.lit(depth))), lambda n: F.when(n == 0, "").otherwise(
        F.concat(F.array_join(F.slice(F.split(path, "/"), F.lit(1), n), "/"), F.lit("/"))))
    return F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: F.concat(s, F.lit("\n"), p))))


def judge(pages: DataFrame, rules: DataFrame, page_id: str = "page_id", url: str = "url", default: str = "allow") -> DataFrame:
    """One row per page: ``page_id``, host, path, rule (the longest that fits; else null), verdict.

    Longest: host plus path together, then the longer host. Null urls and urls without ``://`` have an
    empty host, fit no rule and get ``default``, as all do with an empty rule table. Repeated rows are
    judged alike. The numbers of labels and slashes to expand come from the rules, so no rule is missed.
    """
    rules = prepare_rules(rules)
    shape = rules.agg(F.max("labels"), F.max("depth")).first()
    host, path = host_and_path(F.col(url))
    rows = pages.select(F.col(page_id).alias("page_id"), host.alias("host"), path.alias("path"))
    expanded = (rows.select("host", "path").distinct()
                .withColumn("expression", F.explode(expressions(F.col("host"), F.col("path"), shape[0] or 1, shape[1] or 0)))
                .withColumn("digest", F.sha2("expression", 256)))
    keyed = rules.withColumn("prefix", F.substring("rule_digest", 1, PREFIX_HEX))
    hits = (expanded.withColumn("prefix", F.substring("digest", 1, PREFIX_HEX)).join(keyed, "prefix")
            .where((F.col("digest") == F.col("rule_digest")) & F.startswith("path", F.col("rule_path"))))
    best = (hits.groupBy("host", "path").agg(F.max(F.struct(
        F.length("rule").alias("length"), "host_length", "rule", "action")).alias("best"))
        .select(F.col("host").alias("h"), F.col("path").alias("p"), "best"))
    return (rows.join(best, (F.col("host") == F.col("h")) & (F.col("path") == F.col("p")), "left")
            .select("page_id", "host", "path", F.col("best.rule").alias("rule"),
                    F.coalesce("best.action", F.lit(default)).alias("verdict")))
