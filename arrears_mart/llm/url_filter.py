"""URL filter: fixed rules first, then gradient-boosted trees on lexical features. DataFrame operations only."""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arrears_mart.llm import boosting
from arrears_mart.llm.columns import ascii_lower, broadcast_if_small
from arrears_mart.stages import stage_table

#: Fixed by the contract: verdict, host, path.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
FEATURES = ("length", "depth", "digits", "entropy", "parameters", "labels", "hyphens", "secure", "top", "site", "section")


def host(url: Column) -> Column:
    return ascii_lower(F.regexp_extract(_rest(url), "^([^/?#]*)", 1))


def path(url: Column) -> Column:
    return F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    """What follows the first `://`; empty without one."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def rule_of(host_: Column, path_: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> Column:
    """(name, verdict) of the longest rule that fits; null if none does."""
    chosen = F.lit(None).cast("struct<name:string,verdict:string>")
    for verdict, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host_ == h) | host_.endswith(f".{h}")) & path_.startswith(p)
        chosen = F.when(fits, F.struct(F.lit(h + p).alias("name"), F.lit(verdict).alias("verdict"))).otherwise(chosen)
    return chosen


def _count(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, characters, ""))


def _entropy(text: Column) -> Column:
    """Bits a character over letters, digits and one class of all others, A-Z taken as a-z."""
    low = F.lower(text)
    size = F.length(text)
    counts = [size - F.length(F.replace(low, F.lit(c), F.lit(""))) for c in string.ascii_lowercase + string.digits]
    rest = size
    for c in counts:
        rest = rest - c
    total = sum((F.when(c > 0, c * F.log2(c)).otherwise(0.0) for c in (*counts, rest)), F.lit(0.0))
    return F.when(size > 0, F.log2(size) - total / size).otherwise(0.0)


def _suffix(host_: Column, labels: int) -> Column:
    return F.substring_index(host_, ".", -labels)


def lexical(urls: DataFrame) -> DataFrame:
    """`urls` (url) with host, path, suffixes and all features but the suffix statistics, in few bins."""
    url = F.coalesce(F.col("url"), F.lit(""))
    parts = urls.withColumns({"host": host(F.col("url")), "path": path(F.col("url"))})
    ratio = lambda n: F.floor(20 * n / F.greatest(F.length(url), F.lit(1)))
    return parts.withColumns(
        {
            "length": F.least(F.floor(F.length(url) / 4), F.lit(31)),
            "depth": F.least(_count(F.col("path"), "/"), F.lit(15)),
            "digits": ratio(_count(url, string.digits)),
            "entropy": F.floor(4 * _entropy(url)),
            "parameters": F.least(_count(url, "="), F.lit(15)),
            "labels": F.least(_count(F.col("host"), "."), F.lit(15)),
            "hyphens": F.least(_count(F.col("host"), "-"), F.lit(7)),
            "secure": url.startswith("https:").cast("int"),
            "_top": _suffix(F.col("host"), 1),
            "_site": _suffix(F.col("host"), 3),
            "_section": F.regexp_extract(F.col("path"), "^/([^/]*)/", 1),
        }
    )


def suffix_statistics(labelled: DataFrame, suffix: str, name: str) -> DataFrame:
    """Stored (suffix, name): the smoothed share of blocked among a suffix's labelled URLs, in 21 steps."""
    share = (F.sum("blocked") + 1) / (F.count(F.lit(1)) + 2)
    found = labelled.groupBy(suffix).agg(F.floor(20 * share).cast("int").alias(name))
    return stage_table(found, f"url-{name}")


def best_threshold(counts: Sequence[tuple[int, int, int]]) -> float:
    """The score from which on blocking judges most set-aside URLs right; of equal ones the highest. `counts` has (score in
    hundredths, blocked, number). One half if they are all of one kind, or if blocking none of them is best."""
    best, threshold, worth = 0, 0.5, 0
    if not 0 < sum(c[1] for c in counts) < sum(c[2] for c in counts):
        return threshold
    for step in sorted({c[0] for c in counts}, reverse=True):
        worth += sum(2 * c[1] - c[2] for c in counts if c[0] == step)
        if worth > best:
            best, threshold = worth, step / 100
    return threshold


def judge_urls(
    pages: DataFrame,
    labelled: DataFrame | None = None,
    rules: Sequence[tuple[str, str, str]] = RULES,
    threshold: float | None = None,
    url_col: str = "url",
    id_col: str = "page_id",
) -> DataFrame:
    """Per row of `pages`: page_id, host, path, rule, score (probability of block) and verdict.

    `labelled` has url and blocked (0/1); without it, the URLs that a rule judges are the labelled ones. Four fifths of
    them, by a hash of the URL, give the statistics of host suffixes and first path segments and train; the last fifth sets the score from which on a URL
    without a rule is blocked (`best_threshold`), unless `threshold` states it. A suffix or segment without a labelled
    URL has the share of all labelled ones. Null URLs and such without `://` have empty host and path, fit no rule and are judged by the
    trees. Rows with a null label do not train; repeated rows are judged alike. Long URLs are read whole. Other columns are
    not read, whatever their names; an empty table gives an empty result, and without labels every URL gets one half.
    """
    rows = lexical(pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url")))
    rows = rows.withColumn("_rule", rule_of(F.col("host"), F.col("path"), rules))
    aside = F.pmod(F.xxhash64("url"), F.lit(5)) == 0
    rows = stage_table(rows.withColumn("_aside", aside).drop("url"), "url-rows")
    if labelled is None:
        known = rows.where(F.col("_rule").isNotNull()).withColumn("blocked", (F.col("_rule.verdict") == "block").cast("int"))
    else:
        known = lexical(labelled.where(F.col("blocked").isNotNull()).select("url", F.col("blocked").cast("int").alias("blocked")))
        known = stage_table(known.withColumn("_aside", aside), "url-labelled")
    share = known.where(~F.col("_aside")).agg(F.floor(20 * (F.sum("blocked") + 1) / (F.count(F.lit(1)) + 2))).first()[0]
    usual = F.lit(10 if share is None else share)
    for suffix, name in (("_top", "top"), ("_site", "site"), ("_section", "section")):
        found = broadcast_if_small(suffix_statistics(known.where(~F.col("_aside")), suffix, name))
        rows, known = (df.join(found, suffix, "left").withColumn(name, F.coalesce(name, usual)) for df in (rows, known))
    model = boosting.fit(known.where(~F.col("_aside")), FEATURES, "blocked")
    score = model.probability(lambda f: F.coalesce(F.col(f).cast("int"), F.lit(-1)))
    if threshold is None:
        step = F.floor(score * 100).cast("int").alias("step")
        counts = known.where("_aside").groupBy(step).agg(F.sum("blocked").alias("blocked"), F.count(F.lit(1)).alias("n"))
        threshold = best_threshold([tuple(r) for r in counts.collect()])  # at most 101 rows
    judged = rows.withColumn("score", score)
    verdict = F.coalesce(F.col("_rule.verdict"), F.when(F.col("score") >= threshold, "block").otherwise("allow"))
    return judged.select("page_id", "host", "path", F.col("_rule.name").alias("rule"), "score", verdict.alias("verdict"))
