"""URL filters: listed rules, and association rules mined from what they decide.

Everything here is DataFrame and SQL expressions; mining is Spark's FP-growth.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beaconflow.session import shared_table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Share of the labelled URLs that a mined rule must hold for, and how often it must be right.
SUPPORT, CONFIDENCE = 0.01, 0.9
#: Verdict where no rule matches.
DEFAULT = "allow"

_LABEL = "\x01label="


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://`` or for null."""
    return F.translate(F.regexp_extract(_after(url), r"^[^/?#]*", 0), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_after(url), r"^[^/?#]*([^?#]*)", 1)


def _after(url: Column) -> Column:
    at = F.locate("://", F.coalesce(url, F.lit("")))
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def listed_rule(host: Column, path: Column, rules: Iterable[tuple[str, str]]) -> Column:
    """Struct (rule, verdict) of the longest listed rule that fits, null if none does.

    ``rules`` are (verdict, rule) with a rule of host and path, such as
    ``("block", "example.org/es/")``. One fits its host and all subdomains, if
    the path starts with its path. Of equally long ones block wins. The list is
    an index by host: a URL looks up the suffixes of its own host only.
    """
    by_host: dict[str, list[tuple[str, str, str]]] = {}
    for verdict, rule in rules:
        own, slash, rest = rule.partition("/")
        own = own.translate(str.maketrans(UPPER, LOWER))
        by_host.setdefault(own, []).append((slash + rest, rule, verdict))
    if not by_host:
        return F.lit(None).cast("struct<rule:string,verdict:string>")
    entry = lambda e: F.struct(
        F.lit(len(e[1])).alias("length"), F.lit(e[2]).alias("verdict"), F.lit(e[1]).alias("rule"), F.lit(e[0]).alias("path")
    )
    index = F.create_map(*[x for h, es in sorted(by_host.items()) for x in (F.lit(h), F.array(*[entry(e) for e in sorted(es)]))])
    labels = F.split(host, r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    listed = F.flatten(F.filter(F.transform(suffixes, lambda s: F.try_element_at(index, s)), lambda e: e.isNotNull()))
    best = F.array_max(F.filter(listed, lambda e: F.startswith(path, e["path"])))
    return F.when(best.isNotNull(), F.struct(best["rule"].alias("rule"), best["verdict"].alias("verdict")))


def url_tokens(host: Column, path: Column, url: Column) -> Column:
    """Distinct tokens of a URL: its scheme, the labels of its host, the pairs at its end, path segments, keys and fragment.

    Digits are folded to one sign, so numbered pages share tokens. A prefix
    tells the parts apart. No host (also null): no tokens.
    """
    labels, parts = F.split(host, r"\."), F.split(path, "/")
    query = F.split(F.regexp_extract(F.coalesce(url, F.lit("")), r"\?([^#]*)", 1), "[&;]")
    named = lambda kind, xs: F.transform(F.filter(xs, lambda x: x != ""), lambda x: F.concat(F.lit(kind), F.regexp_replace(x, "[0-9]+", "0")))
    tokens = F.concat(
        named("s:", F.array(F.substring_index(url, "://", 1))),
        named("h:", labels),
        named("e:", F.array(F.substring_index(host, ".", -2))),
        named("p:", parts),
        named("q:", F.transform(query, lambda q: F.substring_index(q, "=", 1))),
        named("f:", F.array(F.regexp_extract(F.coalesce(url, F.lit("")), "#(.*)", 1))),
    )
    return F.when(host != "", F.array_distinct(tokens)).otherwise(F.array().cast("array<string>"))


def _expanded(rules: DataFrame, groups: DataFrame) -> DataFrame:
    """Rules over items as rules over tokens: one for each choice of a token from the group of every item."""
    one = rules.select(F.monotonically_increasing_id().alias("rule"), "*")
    one = shared_table(one, "item_rules")
    member = one.select("rule", F.explode("items").alias("item")).join(groups, "item")
    lists = member.groupBy("rule").agg(F.collect_list("members").alias("lists"))
    start = F.array(F.array().cast("array<string>"))
    add = lambda done, more: F.flatten(F.transform(done, lambda d: F.transform(more, lambda t: F.array_append(d, t))))
    choices = one.join(lists, "rule").select("verdict", "confidence", "support", F.explode(F.aggregate("lists", start, add)).alias("tokens"))
    return choices.select(F.array_sort("tokens").alias("tokens"), "verdict", "confidence", "support")


def mine_rules(labelled: DataFrame) -> DataFrame:
    """(tokens, verdict, confidence, support) of the association rules of ``labelled`` (tokens array, verdict string).

    FP-growth mines combinations of all frequent tokens together with the
    verdicts; kept are rules from tokens to a verdict with enough support and
    confidence that no rule of one token less equals or beats. Every distinct
    URL counts once, so one that is repeated very often proves nothing.

    Two steps keep the combinations few and lose no rule. A token whose URLs all
    have one verdict is a rule by itself, which any rule that holds it and more
    only equals: such tokens are not mined. Tokens that are in exactly the same
    labelled URLs are mined as one item; a rule of items stands for one rule for
    each choice of their tokens, as more than one of an item's tokens adds nothing.
    """
    spark = labelled.sparkSession
    rows = labelled.where("verdict is not null and size(tokens) > 0").select("verdict", F.array_distinct("tokens").alias("tokens"))
    rows = shared_table(rows.withColumn("id", F.monotonically_increasing_id()), "labelled_urls")
    n = rows.count()
    if not n:
        return spark.createDataFrame([], "tokens array<string>, verdict string, confidence double, support double")
    item = rows.select("id", "verdict", F.explode("tokens").alias("token"))
    # two sums of independent 64-bit hashes tell sets of URLs apart
    marks = [F.sum(F.xxhash64(F.lit(k), "id").cast("decimal(38,0)")).alias(f"mark{k}") for k in range(2)]
    sides = [F.min("verdict").alias("least"), F.max("verdict").alias("most")]
    seen = shared_table(item.groupBy("token").agg(F.count("*").alias("seen"), *marks, *sides).where(F.col("seen") >= SUPPORT * n), "url_tokens_seen")
    pure = seen.where("least = most").select(F.array("token").alias("tokens"), F.col("least").alias("verdict"), F.lit(1.0).alias("confidence"), (F.col("seen") / n).alias("support"))

    groups = seen.where("least < most").groupBy("seen", "mark0", "mark1").agg(F.min("token").alias("item"), F.collect_set("token").alias("members"))
    groups = shared_table(groups.select("item", "members"), "url_items")
    chosen = item.join(groups.select(F.col("item").alias("token")), "token", "left_semi").groupBy("id").agg(F.collect_list("token").alias("chosen"))
    label = F.array(F.concat(F.lit(_LABEL), "verdict"))
    baskets = rows.select("id", "verdict").join(chosen, "id", "left")
    baskets = baskets.select(F.concat(F.coalesce("chosen", F.array().cast("array<string>")), label).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=SUPPORT, minConfidence=CONFIDENCE).fit(baskets)
    to_verdict = F.startswith(F.col("consequent")[0], F.lit(_LABEL)) & ~F.exists("antecedent", lambda t: F.startswith(t, F.lit(_LABEL)))
    rules = model.associationRules.where(to_verdict).select(
        F.array_sort("antecedent").alias("items"), F.expr(f"substring(consequent[0], {len(_LABEL) + 1})").alias("verdict"), "confidence", "support"
    )
    rules = shared_table(rules, "url_rules")
    simpler = rules.select("verdict", F.col("items").alias("__less"), F.col("confidence").alias("simpler"))
    less = rules.select("*", F.explode("items").alias("__out")).select("*", F.array_remove("items", F.col("__out")).alias("__less"))
    beaten = less.join(simpler, ["verdict", "__less"]).where("simpler >= confidence")
    kept = rules.join(beaten.select("items", "verdict").distinct(), ["items", "verdict"], "left_anti")
    return pure.unionByName(_expanded(kept, groups))


def match_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(url, verdict, matched) of the distinct ``urls`` (url, tokens) that a rule matches.

    An inverted index: each rule is posted under the one of its tokens that
    fewest rules have; a URL looks up its tokens and a rule found is checked for
    its others. The most confident, then best supported rule decides, then the
    longest; between equals block wins.
    """
    rules = rules.select("tokens", "verdict", "confidence", "support")
    posted = rules.select("*", F.explode("tokens").alias("token"))
    rarity = posted.groupBy("token").agg(F.count("*").alias("postings"))
    key = posted.join(rarity, "token").groupBy("tokens", "verdict").agg(F.min_by("token", F.struct("postings", "token")).alias("token"))
    index = shared_table(rules.join(key, ["tokens", "verdict"]).withColumnRenamed("tokens", "needed"), "url_index")
    found = urls.select("url", "tokens", F.explode("tokens").alias("token")).join(index, "token")
    found = found.where(F.size(F.array_except("needed", "tokens")) == 0)
    rank = F.struct("confidence", "support", F.size("needed").alias("length"), "verdict", F.array_join("needed", " ").alias("matched"))
    return found.groupBy("url").agg(F.max(rank).alias("best")).select("url", "best.verdict", "best.matched")


def filter_urls(pages: DataFrame, rules: Iterable[tuple[str, str]]) -> DataFrame:
    """page_id, host, path, rule, verdict and matched (the mined rule's tokens) of each page.

    A listed rule decides the URLs that it fits; they are the labels from which
    association rules are mined, and these decide the others. A URL that no
    rule matches is allowed.

    Null URLs or such without ``://``: empty host and path, no rule, allowed.
    Repeated URLs are matched once and get one answer; repeated rows a result
    each. Very long URLs are matched whole. Empty table, or no labels: nothing
    is mined. Columns other than page_id and url are not read.
    """
    url = F.col("url")
    rows = pages.select("page_id", "url", host_of(url).alias("host"), path_of(url).alias("path"))
    rows = rows.withColumn("__listed", listed_rule(F.col("host"), F.col("path"), rules))
    distinct = rows.where("url is not null").groupBy("url").agg(F.first("host").alias("host"), F.first("path").alias("path"), F.first("__listed.verdict").alias("verdict"))
    tokens = shared_table(distinct.select("url", "verdict", url_tokens(F.col("host"), F.col("path"), url).alias("tokens")), "url_tokens")
    mined = mine_rules(tokens.where("verdict is not null"))
    found = match_rules(tokens.where("verdict is null"), mined).select(F.col("url").alias("__url"), F.col("verdict").alias("__mined"), "matched")
    out = rows.join(found, rows["url"] == found["__url"], "left")
    return out.select("page_id", "host", "path", F.col("__listed.rule").alias("rule"), F.coalesce("__listed.verdict", "__mined", F.lit(DEFAULT)).alias("verdict"), "matched")
