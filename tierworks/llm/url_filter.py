"""URL filters: domain rules by longest fit, then pattern rules found through their rarest literal token.

Pattern rules are written with literals, ``*`` (anything), ``^`` (one character that is no letter or digit, or
an end of the url) and ``|`` at an end (anchor). A token of a rule is usable when both its neighbours in the
pattern are literals other than letters and digits, ``^`` or ``|``: then each matching url holds it as a whole
token. Each rule is indexed by that usable token which the fewest urls hold; rules without one are tried on
every url. All of it is DataFrame code; nothing runs in Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tierworks.llm.carry import packed, unpacked
from tierworks.plans.workspace import settle

#: Up to so many rules the index is broadcast; beyond, both sides are shuffled by token.
BROADCAST_RULES = 100_000

#: The pattern rules of the registered query, verdict and pattern.
PATTERN_RULES = (
    ("block", "^wp-login.php^"),
    ("block", "^xmlrpc.php^"),
    ("block", "^casino^"),
    ("block", "^porn^"),
    ("block", "^adserver^*^click^"),
    ("block", "^cart^checkout^"),
    ("block", "^calendar^*date="),
    ("block", "sessionid="),
    ("allow", "^casino^history^"),
)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty for other urls."""
    return F.translate(_after(url, r"(?s)^.*?://([^/?#]*)"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return _after(url, r"(?s)^.*?://[^/?#]*([^?#]*)")


def _after(url: Column, pattern: str) -> Column:
    return F.coalesce(F.regexp_extract(url, pattern, 1), F.lit(""))


def tokens_of(text: Column) -> Column:
    return F.array_distinct(F.filter(F.split(F.lower(text), "[^a-z0-9]+"), lambda t: t != ""))


def regex_of(pattern: Column) -> Column:
    """The regular expression of a rule."""
    escaped = F.regexp_replace(F.lower(pattern), r"([.+?$()\[\]{}\\])", r"\\$1")
    anchored = F.regexp_replace(F.regexp_replace(escaped, r"^\|", "\u0001"), r"\|$", "\u0002")
    plain = F.replace(F.replace(anchored, F.lit("|"), F.lit(r"\|")), F.lit("*"), F.lit(".*"))
    sep = F.replace(plain, F.lit("^"), F.lit("(?:[^a-z0-9]|^|$)"))
    return F.concat(F.lit("(?s)"), F.replace(F.replace(sep, F.lit("\u0001"), F.lit("^")), F.lit("\u0002"), F.lit("$")))


def usable_tokens(pattern: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(pattern), F.lit(r"(?<=[^a-z0-9*])([a-z0-9]+)(?=[^a-z0-9*])"), 1))


def rule_index(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``rules`` (``rule_id, verdict, pattern``) with regex and rarest usable token (NULL: none).

    ``urls`` (``url``) is the set over which rarity is counted, in whole.
    """
    usable = rules.select("rule_id", F.explode(usable_tokens(F.col("pattern"))).alias("token"))
    known = usable.select("token").distinct()
    held = urls.select(F.explode(tokens_of(F.col("url"))).alias("token")).join(_small(known, rules), "token", "left_semi")
    counts = held.groupBy("token").agg(F.count("*").alias("n"))
    rarest = (
        usable.join(counts, "token", "left")
        .groupBy("rule_id")
        .agg(F.min(F.struct(F.coalesce("n", F.lit(0)), "token")).getField("token").alias("token"))
    )
    return rules.join(rarest, "rule_id", "left").withColumn("regex", regex_of(F.col("pattern")))


def _small(df: DataFrame, rules: DataFrame) -> DataFrame:
    """``df`` has a few rows for each rule: broadcast it while the rules are few."""
    return F.broadcast(df) if rules.limit(BROADCAST_RULES + 1).count() <= BROADCAST_RULES else df


def pattern_matches(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``url, blocked, allowed``: distinct urls that a pattern rule fits. NULL urls fit none."""
    # Rules without a usable token stand under the empty one, which every url has besides its own.
    index = rule_index(urls, rules).select(F.coalesce("token", F.lit("")).alias("token"), "regex", "verdict")
    return (
        urls.select("url", F.explode(F.array_append(tokens_of(F.col("url")), F.lit(""))).alias("token"))
        .join(_small(index, rules), "token")
        .filter(F.expr("lower(url) rlike regex"))
        .groupBy("url")
        .agg(F.bool_or(F.col("verdict") == "block").alias("blocked"), F.bool_or(F.col("verdict") == "allow").alias("allowed"))
    )


def domain_matches(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``url, rule, rule_verdict``: the longest domain rule (``host, path, verdict``) that fits each url."""
    labels = F.split(F.col("host"), r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))
    known = rules.select(F.col("host").alias("suffix"), F.col("path").alias("rule_path"), F.col("verdict").alias("rule_verdict"))
    best = F.struct(F.length(F.concat("suffix", "rule_path")).alias("n"), F.concat("suffix", "rule_path").alias("rule"), "rule_verdict")
    return (
        urls.select("url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
        .filter(F.col("host") != "")
        .select("url", "path", F.explode(suffixes).alias("suffix"))
        .join(_small(known, rules), "suffix")
        .filter(F.col("path").startswith(F.col("rule_path")))
        .groupBy("url")
        .agg(F.max(best).alias("best"))
        .select("url", "best.rule", "best.rule_verdict")
    )


def filter_urls(pages: DataFrame, domain_rules: DataFrame, pattern_rules: DataFrame, url: str = "url") -> DataFrame:
    """Each row of ``pages`` (other columns kept) with ``host, path, rule, verdict``.

    The longest fitting domain rule decides; else a pattern rule: ``block`` when one fits and no ``allow`` pattern
    does, ``allow`` otherwise. NULL urls, urls without ``://`` and empty tables give ``allow`` and no rule. Rows
    with one url are judged once and all get the verdict. Columns of ``pages`` that are called like an added
    one are replaced, all others come back as they are, whatever they are called. A url that many rows hold is a hot key of
    the last join only; the verdicts are stored before it, so that adaptive execution can split it.
    """
    added = {"host", "path", "rule", "verdict"} - {url}
    kept = packed(pages, url)
    urls = kept.select(F.col("text").alias("url")).filter(F.col("url").isNotNull()).distinct()
    judged = domain_matches(urls, domain_rules).join(pattern_matches(urls, pattern_rules), "url", "full_outer")
    judged = judged.select(
        "url",
        "rule",
        F.coalesce("rule_verdict", F.when(F.col("blocked") & ~F.col("allowed"), "block").otherwise("allow")).alias("verdict"),
    )
    return kept.join(settle(judged), F.col("text") == F.col("url"), "left").select(
        *unpacked([c for c in pages.columns if c not in added], url),
        host_of(F.col("text")).alias("host"),
        path_of(F.col("text")).alias("path"),
        "rule",
        F.coalesce("verdict", F.lit("allow")).alias("verdict"),
    )
