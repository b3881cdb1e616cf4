"""Clusters over pairs: greedy stars, connected components, folds with a head check."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.dedupe import discarded, written


def stars(nodes: DataFrame, pairs: DataFrame) -> DataFrame:
    """(id, lead): in ascending id, a row not yet taken leads and takes all later untaken rows it pairs with.

    Leaders are the lexicographically first maximal independent set: round by round, an undecided
    node whose smaller neighbours are all decided members leads, and its undecided neighbours become
    members. Each member goes to its least leader.
    """
    edges = live = written(pairs.select("a", "b"), "star-edges")
    undecided = written(nodes.select("id").distinct(), "star-nodes")
    leaders = None
    while True:
        won = written(undecided.join(live.select(F.col("b").alias("id")).distinct(), "id", "left_anti"), "star-leaders")
        leaders = won if leaders is None else leaders.union(won)
        taken = live.join(won.withColumnRenamed("id", "a"), "a", "left_semi").select(F.col("b").alias("id")).distinct()
        before, undecided = undecided, written(undecided.join(won, "id", "left_anti").join(taken, "id", "left_anti"), "star-left")
        discarded(before)
        # edges shrink with the nodes; all of them are read once more for the members
        spent, live = live, written(live.join(undecided.withColumnRenamed("id", "a"), "a", "left_semi").join(undecided.withColumnRenamed("id", "b"), "b", "left_semi"), "star-live")
        if spent is not edges:
            discarded(spent)
        if undecided.isEmpty():
            break
    discarded(undecided)
    discarded(live)
    lead = leaders.select(F.col("id").alias("a"))
    members = written(edges.join(lead, "a", "left_semi").groupBy("b").agg(F.min("a").alias("lead")), "star-members")
    discarded(edges)
    members = members.join(leaders.select(F.col("id").alias("b")), "b", "left_anti")
    return leaders.select("id", F.col("id").alias("lead")).union(members.select(F.col("b").alias("id"), "lead"))


def components(nodes: DataFrame, pairs: DataFrame) -> DataFrame:
    """(id, component): the least id of each connected component.

    Every node goes to its least smaller neighbour (and on to that one's), nodes that met are then one, and
    edges lie between what is left, until there are none; the least node of a component never goes.
    """
    edges = written(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b"), "component-edges")
    labels = written(nodes.select("id", F.col("id").alias("label")).distinct(), "component-labels")
    while not edges.isEmpty():
        least = written(edges.groupBy("b").agg(F.min("a").alias("a")), "component-least")
        above = least.select(F.col("b").alias("a"), F.col("a").alias("above"))
        steps = written(least.join(above, "a", "left").select("b", F.coalesce("above", "a").alias("to")), "component-steps")
        low, high = steps.select(F.col("b").alias("a"), F.col("to").alias("low")), steps.select("b", F.col("to").alias("high"))
        moved = edges.join(high, "b").where("high <> a").select("a", "high").join(low, "a", "left").select(F.coalesce("low", "a").alias("x"), F.col("high").alias("y"))
        moved = moved.where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
        was, edges = edges, written(moved, "component-edges")
        before, labels = labels, written(labels.join(steps.select(F.col("b").alias("label"), "to"), "label", "left").select("id", F.coalesce("to", "label").alias("label")), "component-labels")
        for table in (was, before, least, steps):
            discarded(table)
    discarded(edges)
    return labels.select("id", F.col("label").alias("component"))


def headed(groups: DataFrame, sets: DataFrame, least: int) -> DataFrame:
    """(component, id): members that share `least` words with their group's first row; groups of one go."""
    rows = groups.join(sets, "id")
    heads = rows.where("id = component").select("component", F.col("w").alias("head"))
    kept = rows.join(heads, "component").where((F.col("id") == F.col("component")) | (F.size(F.array_intersect("w", "head")) >= least)).select("component", "id")
    sizes = kept.groupBy("component").agg(F.count("*").alias("size"))
    return kept.join(sizes, "component").where("size > 1")


def event_edges(items: DataFrame, low: int = 2, high: int = 150) -> DataFrame:
    """(a, b) that join up rows (id, names, events) sharing a name of low to high rows and an event word: links to each pair's least id."""
    named = items.select("id", "events", F.explode(F.array_distinct("names")).alias("name"))
    usual = named.groupBy("name").agg(F.count("*").alias("df")).where(F.col("df").between(low, high)).select("name")
    posts = written(named.join(usual, "name", "left_semi").select("name", "id", F.explode(F.array_distinct("events")).alias("event")), "event-postings")
    first = posts.groupBy("name", "event").agg(F.min("id").alias("a"))
    return posts.join(first, ["name", "event"]).where("a < id").select("a", F.col("id").alias("b")).distinct()


def event_sizes(items: DataFrame, low: int = 2, high: int = 150) -> DataFrame:
    """(id, component, size) of the named event of every row (id, names, events)."""
    found = written(components(items.select("id"), event_edges(items, low, high)), "events")
    return found.join(found.groupBy("component").agg(F.count("*").alias("size")), "component").select("id", "component", "size")
