"""URL filters: a fixed policy of hosts and paths, and association rules mined from labelled URLs.

FP-growth finds combinations of URL tokens that occur together with a label. Rules that are
supported and confident enough, and not implied by a shorter rule of the same verdict, form an
inverted index from token to rule; a URL fits a rule when it has all its tokens.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.llm.rows import field, packed, unpacked, written

# Upper and lower case of the ASCII letters.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
AFTER_SCHEME = r"^[\s\S]*?://([^/?#]*)([^?#]*)"
LABEL = "label="


@dataclass(frozen=True)
class PolicyRule:
    """Verdict for a host with all its subdomains, on paths that start with ``path``."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path

    def fits(self, host: Column, path: Column) -> Column:
        own = (host == self.host) | F.endswith(host, F.lit("." + self.host))
        return own & F.startswith(path, F.lit(self.path))


@dataclass(frozen=True)
class Mining:
    """A rule holds for ``least`` labelled URLs, whatever their number, and in ``confidence`` of
    those with its tokens; ``support`` can ask for a share of all labelled URLs besides.

    Tokens that fewer labelled URLs have are left out first, and tokens that the same labelled URLs
    have count as one, so that deep paths do not multiply combinations.
    """

    support: float = 0.0
    least: int = 20
    confidence: float = 0.8


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; else empty."""
    return F.coalesce(F.translate(F.regexp_extract(url, AFTER_SCHEME, 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, AFTER_SCHEME, 2), F.lit(""))


def policy_rule(policy: list[PolicyRule], host: Column, path: Column) -> Column:
    """Name and verdict of the longest rule that fits, else null; equally long ones by name."""
    found = F.lit(None).cast("struct<name:string,verdict:string>")
    for rule in sorted(policy, key=lambda r: (-len(r.name), r.name), reverse=True):
        this = F.struct(F.lit(rule.name).alias("name"), F.lit(rule.verdict).alias("verdict"))
        found = F.when(rule.fits(host, path), this).otherwise(found)
    return found


def url_tokens(host: Column, path: Column, url: Column) -> Column:
    """What a URL is made of, each once: all host labels and folders, ending, query keys and values.

    The first and the last labels and the first two folders also count by place; numbers count as one.
    """
    plain = lambda s: F.regexp_replace(s, "[0-9]+", "0")
    labels = F.filter(F.split(host, r"\."), lambda s: s != "")
    folders = F.filter(F.split(path, "/"), lambda s: s != "")
    query = F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)
    pairs = F.filter(F.split(query, "&"), lambda s: s != "")
    parts = F.array(
        F.concat(F.lit("top:"), F.element_at(labels, -1)),
        F.concat(F.lit("site:"), F.array_join(F.slice(labels, F.greatest(F.size(labels) - 2, F.lit(1)), 3), ".")),
        F.concat(F.lit("sub:"), F.when(F.size(labels) > 2, F.get(labels, F.lit(0)))),
        F.concat(F.lit("folder:"), plain(F.get(folders, F.lit(0)))),
        F.concat(F.lit("second:"), plain(F.get(folders, F.lit(1)))),
        F.concat(F.lit("end:"), F.nullif(F.regexp_extract(path, r"\.([A-Za-z]+)$", 1), F.lit(""))),
        F.concat(F.lit("mark:"), F.when(F.contains(url, F.lit("#")), F.lit("yes"))),
    )
    every = F.concat(
        parts,
        F.transform(labels, lambda s: F.concat(F.lit("label:"), plain(s))),
        F.transform(folders, lambda s: F.concat(F.lit("path:"), plain(s))),
        F.transform(pairs, lambda s: F.concat(F.lit("query:"), F.substring_index(s, "=", 1))),
        F.transform(pairs, lambda s: F.concat(F.lit("value:"), plain(s))),
    )
    return F.array_distinct(F.array_compact(every))


def token_classes(labelled: DataFrame, least: int) -> DataFrame:
    """token, class: tokens of ``least`` labelled URLs; those that the same URLs have share a class.

    Two sums of hashes stand for the set of URLs that have a token.
    """
    numbered = written(labelled.select(F.monotonically_increasing_id().alias("row"), "tokens"), "labelled")
    sums = [F.sum(F.shiftrightunsigned(F.xxhash64("row", F.lit(i)), 24)).alias(f"sum{i}") for i in (0, 1)]
    of = numbered.select("row", F.explode("tokens").alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n"), *sums)
    frequent = written(of.where(F.col("n") >= least), "tokens")
    names = frequent.groupBy("n", "sum0", "sum1").agg(F.min("token").alias("class"))
    return frequent.join(names, ["n", "sum0", "sum1"]).select("token", "class")


def in_classes(urls: DataFrame, classes: DataFrame, *key: str) -> DataFrame:
    """Rows with ``tokens`` in place of which their classes stand; each row has its own ``key``."""
    found = urls.select(*key, F.explode_outer("tokens").alias("token")).join(classes, "token", "left")
    return found.groupBy(*key).agg(F.collect_set("class").alias("tokens"))


def mine(labelled: DataFrame, mining: Mining) -> DataFrame:
    """rule, tokens, verdict, confidence, support from rows ``tokens`` and ``verdict``."""
    items = labelled.select(F.array_append("tokens", F.concat(F.lit(LABEL), "verdict")).alias("items"))
    # Half a URL less than ``least``: the share is multiplied and rounded up again.
    support = max(mining.support, min(1.0, (mining.least - 0.5) / max(1, items.count())))
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=mining.confidence).fit(items)
    token_only = F.size(F.filter("antecedent", lambda t: F.startswith(t, F.lit(LABEL)))) == 0
    rules = model.associationRules.where(F.startswith(F.get("consequent", F.lit(0)), F.lit(LABEL)) & token_only)
    rules = rules.select(
        F.array_sort("antecedent").alias("tokens"),
        F.substr(F.get("consequent", F.lit(0)), F.lit(len(LABEL) + 1)).alias("verdict"),
        "confidence",
        "support",
    )
    return written(rules.withColumn("rule", F.xxhash64("tokens", "verdict")), "rules")


def pruned(rules: DataFrame) -> DataFrame:
    """Rules but those that a rule of fewer of their tokens makes with no less confidence."""
    tokens = F.col("tokens")
    power = lambda n: F.call_function("shiftleft", F.lit(1).cast("long"), n)
    # Every proper part of the tokens by the bits of a number; parts keep the order of the tokens.
    numbers = F.sequence(F.lit(1).cast("long"), power(F.size(tokens)) - 2)
    longer = rules.where(F.size(tokens) > 1).select("rule", "verdict", "confidence", "tokens", F.explode(numbers).alias("bits"))
    part = F.filter(tokens, lambda _, i: F.col("bits").bitwiseAND(power(i)) != 0)
    parts = longer.select("rule", "confidence", F.xxhash64(part, "verdict").alias("part"))
    shorter = rules.select(F.col("rule").alias("part"), F.col("confidence").alias("other_confidence"))
    implied = parts.join(shorter, "part").where("confidence <= other_confidence").select("rule").distinct()
    return written(rules.join(implied, "rule", "left_anti"), "pruned-rules")


def matched(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """url, mined: the most confident rule of every URL that has all tokens of one.

    ``urls`` has distinct ``url`` with ``tokens``. Rules of equal confidence go by number of tokens,
    more first, then verdict, ``block`` last and so preferred.
    """
    index = rules.select(
        "rule", "verdict", "confidence", "support", F.size("tokens").alias("n"), F.explode("tokens").alias("token")
    )
    hits = urls.select("url", F.explode("tokens").alias("token")).join(index, "token")
    whole = hits.groupBy("url", "rule", "verdict", "confidence", "support", "n").count().where("count = n")
    best = F.max(F.struct("confidence", "n", "verdict", "support", "rule")).alias("mined")
    return whole.groupBy("url").agg(best)


def judge_urls(
    pages: DataFrame,
    policy: list[PolicyRule],
    labelled: DataFrame | None = None,
    mining: Mining = Mining(),
    default: str = "allow",
    url: str = "url",
) -> DataFrame:
    """Every input row with ``host``, ``path``, ``rule``, ``verdict`` and ``confidence``.

    The policy's longest rule decides; else the best mined rule; else ``default``. ``labelled`` has
    ``url`` and ``verdict``, the more frequent one of a URL counts, the later by name of equally
    frequent ones; without it the rules are mined from the URLs that the policy covers.
    Null URLs and those without ``://`` have an empty host and path and get the default. Repeated
    URLs are judged once and count once in mining. Without labelled URLs no rule is mined. Input
    columns named like an output are replaced.
    """
    parsed = pages.select(F.col(url).alias("url")).where("url IS NOT NULL").distinct()
    parsed = parsed.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    parsed = parsed.select(
        "url",
        url_tokens(F.col("host"), F.col("path"), F.col("url")).alias("tokens"),
        policy_rule(policy, F.col("host"), F.col("path")).alias("fixed"),
        (F.col("host") != "").alias("whole"),
    )
    urls = written(parsed.where("whole"), "urls")
    if labelled is None:
        known = urls.where("fixed IS NOT NULL").select("url", "tokens", F.col("fixed.verdict").alias("verdict"))
    else:
        votes = labelled.where("url IS NOT NULL AND verdict IS NOT NULL").groupBy("url", "verdict").count()
        given = votes.groupBy("url").agg(F.max(F.struct("count", "verdict")).alias("v")).select("url", "v.verdict")
        known = given.select(
            "url", url_tokens(host_of(F.col("url")), path_of(F.col("url")), F.col("url")).alias("tokens"), "verdict"
        )
    # A URL has a class if it has any of its tokens: rules over classes stand for those over tokens.
    classes = token_classes(known, mining.least)
    rules = pruned(mine(written(in_classes(known, classes, "url", "verdict"), "known"), mining))
    mined = matched(in_classes(urls.where("fixed IS NULL"), classes, "url"), rules)
    rows = packed(
        pages,
        F.col(url).alias("u"),
        host_of(F.col(url)).alias("host"),
        path_of(F.col(url)).alias("path"),
    ).withColumn("fixed", policy_rule(policy, F.col("host"), F.col("path")))
    judged = rows.join(mined, F.col("u") == F.col("url"), "left")
    return unpacked(
        judged,
        host=F.col("host"),
        path=F.col("path"),
        rule=F.col("fixed.name"),
        verdict=F.coalesce("fixed.verdict", "mined.verdict", F.lit(default)),
        confidence=F.when(F.col("fixed").isNull(), F.col("mined.confidence")),
    )
