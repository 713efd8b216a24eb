"""URL filter: hand-written host and path rules, and association rules for the URLs that no such rule fits.

Hand-written rules are looked up by their text; the longest that fits a URL decides. The URLs they decide are at the same time
labelled examples. Each URL is a set of tokens (host labels, path segments with numbers blanked, names of query fields, a
fragment). Spark's FP-growth finds the token sets that are frequent among the labelled URLs, once with and once without the
verdict; their quotient is the confidence of the rule "tokens imply verdict". A rule stays if support and confidence reach
their bounds and leaving out any of its tokens lowers the confidence. Rules are filed in an inverted index under their rarest
token: a URL meets the rules of its own tokens only, and each distinct token set is judged once. Of the rules whose tokens it
holds all, the most confident one decides, then the one with more support, then with more tokens, then by tokens. Without any,
the verdict most common among the labels does, or "allow" if there are no labels.

Contract: null URLs and URLs without "://" have an empty host and path and no tokens. Host letters A-Z are lower-cased, nothing
else is changed. Rows with null or repeated ids and repeated URLs all stay. All tokens of every labelled URL are mined: a URL of
n tokens holds 2^n sets, so where one has more than ``MINED_TOKENS``, rules are grown a token at a time, which gives the same
rules without listing the sets that cannot be one. Empty tables give no rows. Only the id and the URL column are read.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandloom.session import cut

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
VERDICTS = ("block", "allow")
MIN_SUPPORT = 0.005
MIN_CONFIDENCE = 0.9
MINED_TOKENS = 12


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


# The rules of the registered query.
RULES = (
    Rule("block", "net", "/"),
    Rule("allow", "example.net", "/en/"),
    Rule("block", "example.com", "/de/"),
    Rule("allow", "org", "/fr/"),
)


# ---- parts of a URL -------------------------------------------------------------------------------------------------

def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise("")


def host(url: Column) -> Column:
    """What follows the first "://" up to "/", "?", "#" or the end, A-Z lower-cased."""
    return F.translate(F.coalesce(F.regexp_extract(_after_scheme(url), r"^([^/?#]*+)", 1), F.lit("")), UPPER, LOWER)


def path(url: Column) -> Column:
    """What follows the host up to "?", "#" or the end."""
    return F.coalesce(F.regexp_extract(_after_scheme(url), r"^[^/?#]*+([^?#]*+)", 1), F.lit(""))


def tokens(url: Column) -> Column:
    """Distinct tokens: labels of the host, path segments with numbers as #, names of query fields, a fragment."""
    def named(kind: str, parts: Column) -> Column:
        return F.transform(F.filter(parts, lambda p: p != ""), lambda p: F.concat(F.lit(kind), p))

    rest = _after_scheme(url)
    query = F.regexp_extract(rest, r"^[^?#]*+\?([^#]*+)", 1)
    fields = F.transform(F.split(query, "&"), lambda f: F.substring_index(f, "=", 1))
    found = F.concat(
        named("host:", F.split(host(url), r"\.")), named("path:", F.split(F.regexp_replace(path(url), "[0-9]+", "#"), "/")),
        named("field:", fields), F.when(F.contains(rest, F.lit("#")), F.array(F.lit("fragment"))).otherwise(F.array().cast("array<string>")),
    )
    return F.array_sort(F.array_distinct(F.when(F.instr(url, "://") > 0, found).otherwise(F.array().cast("array<string>"))))


def fits(rule: Rule, host: Column, path: Column) -> Column:
    """The host is the rule's or a subdomain of it, and the path starts with the rule's."""
    return ((host == rule.host) | F.endswith(host, F.lit("." + rule.host))) & F.startswith(path, F.lit(rule.path))


def with_rules(pages: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """(page_id, host, path, rule, ruled, tokens): the longest rule that fits, its verdict, and the tokens."""
    best, ruled = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):  # the last one wins
        hit = fits(rule, F.col("host"), F.col("path"))
        best, ruled = F.when(hit, rule.text).otherwise(best), F.when(hit, rule.verdict).otherwise(ruled)
    parts = pages.select("page_id", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"), tokens(F.col("url")).alias("tokens"))
    return parts.select("page_id", "host", "path", best.alias("rule"), ruled.alias("ruled"), "tokens")


# ---- mining ---------------------------------------------------------------------------------------------------------

def _grown(labelled: DataFrame, min_support: float) -> DataFrame:
    """Rules (tokens, verdict, support, confidence) grown token by token, over whole rows of any width.

    A set is grown only while each of its tokens parts it from rows of the other verdict. One that does not makes the rule no more
    confident, and the same holds for every larger set, so no rule that would stay is missed, and tokens that always come
    together do not multiply.
    """
    sets = cut(labelled.groupBy(F.array_sort("tokens").alias("tokens")).agg(*[F.count_if(F.col("label") == v).alias(v) for v in VERDICTS]))
    need = max(math.ceil(min_support * labelled.count()), 1)
    both = F.inline(F.array(*[F.struct(F.lit(v).alias("verdict"), F.col(v).alias("support"), F.col(o).alias("others"))
                              for v, o in (VERDICTS, VERDICTS[::-1])]))
    singles = sets.select(F.explode("tokens").alias("token"), *VERDICTS).groupBy("token").agg(*[F.sum(v).alias(v) for v in VERDICTS])
    level = cut(singles.select(F.array("token").alias("tokens"), F.struct((F.col(VERDICTS[0]) + F.col(VERDICTS[1])).alias("n"), "token").alias("rarest"), both)
                .where(F.col("support") >= need))
    levels, size = [], 1
    while not level.isEmpty():
        levels.append(level)
        size += 1
        open_ = level.where("others > 0").withColumns({"head": F.slice("tokens", 1, size - 2), "tail": F.element_at("tokens", -1)})
        a, b = open_.alias("a"), open_.alias("b")
        wider = a.join(b, (F.col("a.verdict") == F.col("b.verdict")) & (F.col("a.head") == F.col("b.head")) & (F.col("a.tail") < F.col("b.tail"))).select(
            F.concat("a.tokens", F.array("b.tail")).alias("rule_tokens"), "a.verdict", F.least("a.rarest", "b.rarest").alias("rarest"))
        parts = wider.withColumn("without", F.explode("rule_tokens")).withColumn("tokens", F.filter("rule_tokens", lambda t: t != F.col("without")))
        tried = parts.join(open_.select("tokens", "verdict", "others"), ["tokens", "verdict"]).groupBy("rule_tokens", "verdict").agg(
            F.first("rarest").alias("rarest"), F.count("*").alias("known"), F.min("others").alias("before")).where(F.col("known") == size)
        met = sets.withColumn("token", F.explode("tokens")).join(tried.withColumn("token", F.col("rarest.token")), "token").where(
            F.size(F.array_except("rule_tokens", "tokens")) == 0)
        own, other = [F.when(F.col("verdict") == VERDICTS[0], F.col(x)).otherwise(F.col(y)) for x, y in (VERDICTS, VERDICTS[::-1])]
        level = cut(met.groupBy(F.col("rule_tokens").alias("tokens"), "verdict").agg(
            F.first("rarest").alias("rarest"), F.sum(own).alias("support"), F.sum(other).alias("others"), F.first("before").alias("before"))
            .where((F.col("support") >= need) & (F.col("others") < F.col("before"))).select("tokens", "rarest", "verdict", "support", "others"))
    found = reduce(DataFrame.unionByName, levels or [level])
    return found.select("tokens", "verdict", "support", (F.col("support") / (F.col("support") + F.col("others"))).alias("confidence"))


def _frequent(labelled: DataFrame, min_support: float) -> DataFrame:
    """Rules (tokens, verdict, support, confidence) of all token sets that FP-growth finds."""
    marks = [f"={v}" for v in VERDICTS]  # no token begins so
    baskets = labelled.select(F.concat("tokens", F.array(F.concat(F.lit("="), F.col("label")))).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=min_support, numPartitions=labelled.sparkSession.sparkContext.defaultParallelism).fit(baskets)
    sets = cut(model.freqItemsets.select(F.array_sort("items").alias("items"), "freq"))
    plain = F.filter("items", lambda i: ~i.isin(marks))
    mark = F.element_at(F.filter("items", lambda i: i.isin(marks)), 1)
    marked = sets.where(F.size(plain) < F.size("items")).select(
        plain.alias("tokens"), F.substring(mark, 2, 100).alias("verdict"), F.col("freq").alias("support"))
    total = sets.where(F.size(plain) == F.size("items")).select(F.col("items").alias("tokens"), F.col("freq").alias("n"))
    return marked.where(F.size("tokens") > 0).join(total, "tokens").withColumn("confidence", F.col("support") / F.col("n")).drop("n")


def mine(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE,
         mined_tokens: int = MINED_TOKENS) -> DataFrame:
    """Rules (tokens, verdict, support, confidence) from rows (label, tokens). ``support`` counts rows with tokens and verdict.

    Where a row has more than ``mined_tokens`` tokens, the rules are grown instead of taken from all frequent sets.
    """
    rows = labelled.select("label", "tokens")
    wide = not rows.where(F.size("tokens") > mined_tokens).isEmpty()
    found = cut(_grown(rows, min_support) if wide else _frequent(rows, min_support))

    # A rule goes if it is as confident without one of its tokens.
    shorter = found.where(F.size("tokens") > 1).select("tokens", "verdict", "confidence", F.explode("tokens").alias("without")).select(
        F.col("tokens").alias("longer"), "verdict", F.col("confidence").alias("own"),
        F.filter("tokens", lambda t: t != F.col("without")).alias("tokens"))
    needless = shorter.join(found, ["tokens", "verdict"]).where(F.col("confidence") >= F.col("own")).select(
        F.col("longer").alias("tokens"), "verdict").distinct()
    return found.where(F.col("confidence") >= min_confidence).join(needless, ["tokens", "verdict"], "left_anti")


# ---- matching -------------------------------------------------------------------------------------------------------

def inverted_index(rules: DataFrame) -> DataFrame:
    """Rules under their rarest token, as (token, rule_tokens, verdict, support, confidence)."""
    use = rules.select(F.explode("tokens").alias("token"), "support").groupBy("token").agg(F.max("support").alias("most"))
    filed = rules.select("*", F.explode("tokens").alias("token")).join(use, "token").groupBy("tokens", "verdict", "support", "confidence").agg(
        F.min(F.struct("most", "token"))["token"].alias("token"))
    return filed.withColumnRenamed("tokens", "rule_tokens")


def judge(token_sets: DataFrame, rules: DataFrame) -> DataFrame:
    """(tokens, mined, mined_verdict) of the distinct token sets that some rule fits."""
    sets = token_sets.where(F.size("tokens") > 0).select("tokens").distinct()
    met = sets.withColumn("token", F.explode("tokens")).join(inverted_index(rules), "token")
    held = met.where(F.size(F.array_except("rule_tokens", "tokens")) == 0)
    order = F.struct("confidence", "support", F.size("rule_tokens").alias("size"), F.col("rule_tokens"), "verdict")
    best = held.groupBy("tokens").agg(F.max(order).alias("best"))
    return best.select("tokens", F.array_join("best.rule_tokens", " ").alias("mined"), F.col("best.verdict").alias("mined_verdict"))


def filter_urls(pages: DataFrame, rules: Sequence[Rule] = RULES, labels: DataFrame | None = None,
                min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """(page_id, host, path, rule, verdict, mined) of every row; ``mined`` names the tokens of the association rule that decided.

    ``labels`` (url, label) are examples to learn from; without them, the pages that ``rules`` decide are.
    """
    parts = cut(with_rules(pages.select("page_id", "url"), rules))
    if labels is None:
        labelled = parts.where("ruled is not null").select(F.col("ruled").alias("label"), "tokens")
    else:
        labelled = labels.where(F.col("label").isin(*VERDICTS)).select("label", tokens(F.col("url")).alias("tokens"))
    mined = cut(mine(labelled, min_support, min_confidence))
    common = labelled.groupBy("label").agg(F.count("*").alias("n")).agg(F.max_by("label", F.struct("n", "label")).alias("label")).first()["label"]
    judged = judge(parts.where("rule is null"), mined)
    open_pages = parts.where("rule is null").join(judged, "tokens", "left").select(
        "page_id", "host", "path", "rule", F.coalesce("mined_verdict", F.lit(common or "allow")).alias("verdict"), "mined")
    ruled = parts.where("rule is not null").select(
        "page_id", "host", "path", "rule", F.col("ruled").alias("verdict"), F.lit(None).cast("string").alias("mined"))
    return ruled.unionByName(open_pages)
