"""Rule classification with weighted pattern tables that are data, not code.

A vocabulary is {section: [(weight, pattern), ...]}; patterns are Java regular expressions and get the
flags for Unicode case folding. Sections keep the order they are given in.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HINT_BONUS, MOST_WEAK = 4, 2


def matches(text: Column, pattern: str) -> Column:
    return F.rlike(text, F.lit(f"(?iu){pattern}"))


def scores(text: Column, vocabulary: dict, hinted: Column | None = None) -> dict[str, Column]:
    """Each section's sum of the weights that match, and a bonus for a hinted section that has any."""
    out = {}
    for section, table in vocabulary.items():
        total = F.lit(0)
        for weight, pattern in table:
            total = total + F.when(matches(text, pattern), weight).otherwise(0)
        out[section] = total
    if hinted is not None:
        out = {s: c + F.when((c > 0) & (hinted == s), HINT_BONUS).otherwise(0) for s, c in out.items()}
    return out


def with_scores(rows: DataFrame, text: Column, vocabulary: dict, hinted: Column | None = None) -> DataFrame:
    """One column for each section, made in steps so that generated code stays small, and `ranked`."""
    for section, total in scores(text, vocabulary, hinted).items():
        rows = rows.withColumn(f"s_{section}", total)
    order = [F.struct((-F.col(f"s_{s}")).alias("minus"), F.lit(i).alias("i"), F.lit(s).alias("section")) for i, s in enumerate(vocabulary)]
    return rows.withColumn("ranked", F.array_sort(F.array(*order)))


def classified(rows: DataFrame, text: Column, vocabulary: dict, weakest: str, hinted: Column | None = None, tag: Column | None = None, vetoed: Column | None = None, hard: list | None = None, residual: list | None = None) -> DataFrame:
    """section and score, by precedence.

    A veto gives none; a hard rule (pattern, section) gives its section at 6; a publisher's tag wins
    with at least 4 unless a section other than the weakest scores 5 or more and the tag's own nothing;
    the best section but the weakest at 3 or more; the weakest section if it scores; a weak section; the
    outlet's hint at 1; the residual rules at 0.
    """
    scored = with_scores(rows, text, vocabulary, hinted)
    top = F.element_at(F.filter("ranked", lambda r: r["section"] != weakest), 1)
    scored = scored.withColumn("__top", top["section"]).withColumn("__best", -top["minus"])
    decided = [(vetoed if vetoed is not None else F.lit(False), F.lit(None).cast("string"), F.lit(0))]
    for pattern, section in hard or []:
        decided.append((matches(text, pattern), F.lit(section), F.lit(6)))
    if tag is not None:
        own = F.coalesce(*[F.when(tag == s, F.col(f"s_{s}")) for s in vocabulary], F.lit(0))
        leading = -F.get("ranked", F.lit(0))["minus"]
        decided.append((tag.isNotNull() & ~((F.col("__top") != tag) & (F.col("__best") >= 5) & (own == 0)), tag, F.greatest(F.lit(4), leading)))
    decided.append((F.col("__best") >= 3, F.col("__top"), F.col("__best")))
    decided.append((F.col(f"s_{weakest}") > 0, F.lit(weakest), F.col(f"s_{weakest}")))
    decided.append((F.col("__best") > 0, F.col("__top"), F.col("__best")))
    if hinted is not None:
        decided.append((hinted.isNotNull(), hinted, F.lit(1)))
    for pattern, section in residual or []:
        decided.append((matches(text, pattern), F.lit(section), F.lit(0)))
    section = score = None
    for when, name, value in decided:
        section = F.when(when, name) if section is None else section.when(when, name)
        score = F.when(when, value) if score is None else score.when(when, value)
    return scored.withColumn("section", section).withColumn("score", F.coalesce(score, F.lit(0))).drop("__top", "__best")


def first_section(tags: Column, table: list) -> Column:
    """The first row of an ordered map (tag pattern, section) that any tag matches: the map's order decides."""
    return F.coalesce(*[F.when(F.exists(tags, lambda t, p=pattern: F.rlike(t, F.lit(f"(?iu){p}"))), section) for pattern, section in table])


def suppressed(rules: list) -> Column:
    """The name of the first rule (name, condition) that holds: an ordered decision list."""
    out = None
    for name, condition in rules:
        out = F.when(condition, name) if out is None else out.when(condition, name)
    return out if out is not None else F.lit(None).cast("string")


def signals(headline: Column, text: Column, opinion: str, report: str, document: str, least: int = 80) -> Column:
    """Report or comment, null where the text is too short to tell (unknown is not false)."""
    comment, plain = F.regexp_count(text, F.lit(f"(?iu){opinion}")), F.regexp_count(text, F.lit(f"(?iu){report}"))
    found = F.struct(F.when(comment > plain, "comment").otherwise("report").alias("kind"), comment.alias("comment_score"), plain.alias("report_score"), F.rlike(F.concat(headline, F.lit(" "), text), F.lit(f"(?iu){document}")).alias("primary_doc"))
    return F.when(F.char_length(text) >= least, found)


def reach(n: Column) -> Column:
    return F.when(n > 1, F.least(F.lit(7), F.round(3 * F.log2(n.cast("double"))).cast("int"))).otherwise(0)


def importance(n: Column, tier: Column, outcome: Column, future: Column, process: Column, comment: Column, scale: Column, source_tier: Column, followed: Column, score: Column, age: Column, window: Column, signal_comment: Column, signal_document: Column, small_market: Column) -> Column:
    """The sum that ranks a lead; signals count only where they are known."""
    one = lambda c, v: F.when(c, v).otherwise(0)
    spread = F.when(small_market, F.greatest(reach(n), F.lit(3))).otherwise(reach(n))
    stage = F.when(outcome & ~future, 8).when(process | future, 3).otherwise(0)
    fresh = F.when(age <= window / 3, 2).when(age > window * 4 / 3, -2).otherwise(0)
    return spread + F.least(F.lit(9), 3 * tier) + stage - one(comment, 2) + one(scale, 3) + one(source_tier, 4) + one(followed, 5) + F.least(F.lit(6), score) + F.coalesce(fresh, F.lit(0)) - one(signal_comment, 4) + one(signal_document, 4)
