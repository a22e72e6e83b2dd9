"""Links of documents inside a package: where they lead, and which missing ones a review has made optional."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed value: schemes whose links lead nowhere.
_NOWHERE = ("data", "mailto", "tel")


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def scheme(url: str | Column) -> Column:
    return F.lower(F.regexp_extract(_col(url), r"^([A-Za-z][A-Za-z0-9+.-]*):", 1))


def host(url: str | Column) -> Column:
    return F.regexp_extract(_col(url), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1)


def path(url: str | Column) -> Column:
    """The path of an address, with percent signs decoded where they can be; '+' stays a plus."""
    bare = F.regexp_replace(F.regexp_replace(_col(url), "[?#].*$", ""), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/]*)?", "")
    return F.coalesce(F.try_url_decode(F.replace(bare, F.lit("+"), F.lit("%2B"))), bare)


def normal(path: str | Column) -> Column:
    """A path without empty parts, '.' and '..': a fold over its parts. What goes above a relative path's start stays '..',
    above the root it is dropped; nothing left is '.'."""
    p = _col(path)
    rooted = p.startswith("/")

    def step(done: Column, part: Column) -> Column:
        up = (part == "..") & (F.size(done) > 0) & (F.element_at(F.concat(F.array(F.lit("")), done), -1) != "..")
        above = (part == "..") & (F.size(done) == 0) & rooted
        return F.when(part.isin("", ".") | above, done).when(up, F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0)))).otherwise(F.concat(done, F.array(part)))

    parts = F.aggregate(F.split(p, "/"), F.array().cast("array<string>"), step)
    text = F.concat(F.when(rooted, F.lit("/")).otherwise(F.lit("")), F.array_join(parts, "/"))
    return F.when(text == "", ".").otherwise(text)


def resolved(location: str | Column, url: str | Column) -> Column:
    """The member of the package that a relative address in the document ``location`` names."""
    target = path(url)
    folder = F.regexp_replace(_col(location), "[^/]*$", "")
    return normal(F.when(target.startswith("/"), target).otherwise(F.concat(folder, target)))


def dependencies(links: DataFrame, members: DataFrame, known: DataFrame) -> DataFrame:
    """links (location, url and more) with ``resolved`` and ``status``: nowhere, member, missing member, captured or external.

    members (path) are files of the package, known (url) addresses that were captured. Addresses with a scheme or a host
    lead out of the package; their fragments do not count.
    """
    outside = (scheme("url") != "") | (host("url") != "")
    empty = ~outside & (path("url") == "")
    nowhere = F.col("url").startswith("#") | scheme("url").isin(*_NOWHERE) | empty
    target = F.when(nowhere, F.lit(None)).when(outside, F.regexp_replace("url", "#.*$", "")).otherwise(resolved("location", "url"))
    df = links.withColumn("resolved", target).withColumn("__out", outside)
    there = members.select(F.col("path").alias("resolved"), F.lit(False).alias("__out")).union(known.select("url", F.lit(True))).distinct().withColumn("__there", F.lit(True))
    df = df.join(there, ["resolved", "__out"], "left")
    status = F.when(F.col("resolved").isNull(), "nowhere").when(F.col("__out"), F.when(F.col("__there"), "captured").otherwise("external")).when(F.col("__there"), "member").otherwise("missing member")
    return df.withColumn("status", status).drop("__out", "__there")


def reviewed(missing: DataFrame, rules: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Missing links split by review rules, and what is wrong with the rules.

    missing (document, tag, attribute, url, kind); rules (rule_id, document, tag, attribute, url, classification, reason,
    expected). A link is optional if one rule names its document, tag, attribute and address exactly. Problems: a link that
    two rules name, a link of another kind than a cross-reference, a rule that does not meet as many links as it expects.
    """
    keys = ["document", "tag", "attribute", "url"]
    by = rules.groupBy(*keys).agg(F.count("*").alias("n"), F.min("rule_id").alias("rule_id"), F.min("classification").alias("classification"), F.min("reason").alias("reason"))
    rows = missing.join(by, keys, "left")
    split = rows.select(*keys, "kind", F.when(F.col("n").isNull(), "required").otherwise(F.col("classification")).alias("classification"), "reason")
    named = rows.where("n = 1").groupBy("rule_id").agg(F.count("*").alias("met"))
    count = rules.select("rule_id", "expected").join(named, "rule_id", "left").where(F.coalesce("met", F.lit(0)) != F.col("expected"))
    problem = lambda df, text: df.select(F.col("rule_id"), F.lit(text).alias("problem"))
    wrong = problem(rows.where("n > 1"), "two rules name a link").union(problem(rows.where("n = 1 AND kind <> 'cross-reference'"), "not a cross-reference")).union(problem(count, "other number of links"))
    return split, wrong.distinct()
