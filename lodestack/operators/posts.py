"""Question-and-answer posts: classification by rules given as data, answers to keep, comments, duplicates."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import order

#: Words that make a short comment worth keeping, and comments that are thanks only.
WARNING_WORDS = "warning|caution|unsafe|security|deprecated|obsolete|incorrect|bug|fails?|broken|instead|correction|do not|don't|not|only|requires?|since|removed"
_THANKS = r"(?i)^(thanks|thank you|\+1)[.!\s]*$"
_OLD = r"(?i)\b(old|older|legacy|ancient)\b"


@dataclass(frozen=True)
class Versions:
    """Version numbers that ``pattern`` captures in titles of posts with one of ``tags``; some majors are legacy."""

    name: str
    tags: tuple[str, ...]
    pattern: str
    legacy_major: tuple[int, ...]


@dataclass(frozen=True)
class Rules:
    deny_tags: tuple[str, ...] = ()
    allow_tags: tuple[str, ...] = ()
    legacy_tags: tuple[str, ...] = ()
    excluded_ids: tuple[int, ...] = ()
    legacy_ids: tuple[int, ...] = ()
    durable_ids: tuple[int, ...] = ()
    versions: tuple[Versions, ...] = field(default_factory=tuple)


def _any_of(tags: Column, wanted: tuple[str, ...]) -> Column:
    return F.arrays_overlap(tags, F.lit(list(wanted))) if wanted else F.lit(False)


def _count_in(numbers: Column, wanted: tuple[int, ...]) -> Column:
    return F.size(F.filter(numbers, lambda m: m.isin(*wanted)))


def classify(posts: DataFrame, rules: Rules) -> DataFrame:
    """Adds bucket (durable, legacy, review or null) and reason to posts (id, type, score, answers, tags, title).

    Tags come as '<a><b>'. Order of precedence: unanswered, excluded, explicitly legacy, version rules with
    ambiguous ones for review, durable topics, out of scope.
    """
    tags = F.regexp_extract_all(F.coalesce("tags", F.lit("")), F.lit("<([^>]+)>"), F.lit(1))
    title = F.coalesce("title", F.lit(""))
    ident = lambda ids: F.col("id").isin(*ids) if ids else F.lit(False)
    legacy, mixed = F.lit(False), F.lit(False)
    for v in rules.versions:
        majors = F.transform(F.regexp_extract_all(title, F.lit(f"(?i){v.pattern}"), F.lit(1)), lambda x: F.get(F.split(x, r"\."), F.lit(0)).cast("int"))
        old = _count_in(majors, v.legacy_major)
        own = _any_of(tags, v.tags) & (old > 0)
        legacy, mixed = legacy | (own & (old == F.size(majors))), mixed | (own & (old < F.size(majors)))
    wording = title.rlike(_OLD) & ~legacy & ~mixed
    ambiguous, versioned = mixed | wording, legacy | mixed | wording
    scope = ident(rules.durable_ids) | _any_of(tags, rules.allow_tags) | versioned
    none = F.lit(None).cast("string")
    unanswered = F.coalesce((F.col("type") != 1) | (F.col("score") < 1) | (F.col("answers") < 1), F.lit(True))
    steps = [
        (unanswered, none, "unanswered, or score below one"),
        (ident(rules.excluded_ids) | _any_of(tags, rules.deny_tags), none, "explicit exclusion"),
        (ident(rules.legacy_ids) | _any_of(tags, rules.legacy_tags), F.lit("legacy"), "explicit legacy classification"),
        (ambiguous & scope, F.lit("review"), "version is not clear"),
        (versioned, F.lit("legacy"), "legacy version"),
        (scope, F.lit("durable"), "durable topic"),
    ]
    bucket, reason = none, F.lit("outside the selection")
    for test, b, r in reversed(steps):
        bucket, reason = F.when(test, b).otherwise(bucket), F.when(test, F.lit(r)).otherwise(reason)
    return posts.withColumn("bucket", bucket).withColumn("reason", reason)


def best(classified: DataFrame, n: int) -> DataFrame:
    """The first ``n`` of each bucket by score, then id."""
    w = Window.partitionBy("bucket").orderBy(F.desc("score"), "id")
    return classified.where("bucket IS NOT NULL").withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def substantive(text: str | Column) -> Column:
    """Whether a comment says something: long enough prose, or a shorter warning; thanks never do."""
    t = F.trim(F.col(text) if isinstance(text, str) else text)
    words = F.size(F.filter(F.split(t, r"\s+"), lambda w: w != ""))
    warning = t.rlike(rf"(?i)\b({WARNING_WORDS})\b")
    return ~t.rlike(_THANKS) & (((F.length(t) >= 40) & (words >= 6)) | (warning & (F.length(t) >= 12) & (words >= 3)))


def answers(questions: DataFrame, replies: DataFrame, alternatives: int = 2) -> DataFrame:
    """(question_id, answer_id, accepted, rank): the accepted answer, if its score is not negative, then the best
    others of positive score. questions (id, accepted_id), replies (id, parent_id, score)."""
    own = replies.join(questions.select(F.col("id").alias("parent_id"), "accepted_id"), "parent_id")
    accepted = F.coalesce((F.col("id") == F.col("accepted_id")) & (F.col("score") >= 0), F.lit(False))
    kept = own.withColumn("accepted", accepted).where("accepted OR score > 0")
    n = F.row_number().over(Window.partitionBy("parent_id", "accepted").orderBy(F.desc("score"), "id"))
    kept = kept.withColumn("n", n).where(F.col("accepted") | (F.col("n") <= alternatives))
    rank = F.row_number().over(Window.partitionBy("parent_id").orderBy(F.desc("accepted"), "n"))
    return kept.select(F.col("parent_id").alias("question_id"), F.col("id").alias("answer_id"), "accepted", rank.alias("rank"))


def canonical(links: DataFrame, nodes: DataFrame) -> DataFrame:
    """(id, canonical, problem): follows each post's single duplicate link to the end, however far that is.

    links (id, target); a post with several targets on the way, or a cycle, has no canonical post but a problem.
    """
    found = order.canonical(links, nodes)
    return found.select("id", "canonical", F.when(F.col("problem") == "cycle", "cycle or too long").otherwise(F.col("problem")).alias("problem"))
