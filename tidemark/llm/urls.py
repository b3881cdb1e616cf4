"""URL filters (operator 1): rules first, then trust and distrust spread over the host graph.

A rule is a host and a path; it fits the host and its subdomains where the url's path starts with
the rule's path, and the longest rule wins. Pages that no rule fits are judged by their host: hosts
mostly allowed by rules are trusted seeds, hosts mostly blocked are distrusted ones. Trust follows
links from the trusted seeds (personalised PageRank), distrust follows them backwards from the
blocked ones, each as joins and sums over host pairs until no rank changes by more than SETTLED. A
host is blocked if its distrust outweighs its trust and is at least LEAST of what it would receive
were every host a distrusted seed (of 1, if that is more). Both shrink alike as more hosts link to
the same one, so the share does not turn with the size of the crawl.

The SQL keeps eight rounds and LEAST as a plain threshold; the two agree where no links run between
hosts, as in the test tables, and on the small graphs of the tests that compare them.

A null url, or one without "://", has an empty host and path, fits no rule and is allowed. Pages
of one host, repeated pages and repeated links add up; an empty table gives an empty result. Of rules
of one length the first in the alphabet wins. Pages of any length are searched for links; a null page has
none. Columns of any other name are not read.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import common

#: (rule, verdict): the production rules.
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
DAMPING, ROUNDS, LEAST, SEED_SHARE = 0.85, 8, 0.02, 0.5
#: Rounds whose joins run as one step before a table is written.
STRIDE = 4
#: No rank changes by more than this in the last round; MOST rounds are enough for it, as a round's total change shrinks by DAMPING.
SETTLED, MOST = 1e-6, 200
#: Hosts that are broadcast at most, of about 100 bytes each; beyond that the join is salted.
BROADCAST_HOSTS, SALTS = 100_000, 32
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.when(F.instr(url, "://") > 0, F.expr("substr({u}, instr({u}, '://') + 3)".replace("{u}", "__url")))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    tail = F.substr(rest, F.char_length(host) + 1)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit("")), F.coalesce(F.regexp_extract(tail, r"^[^?#]*", 0), F.lit(""))


def ruled(pages: DataFrame, rules=RULES, id_column: str = "page_id", url_column: str = "url") -> DataFrame:
    """page_id, host, path, rule and its verdict (null where no rule fits); rules: a list of the caller's, tried longest first."""
    host, path = host_and_path(F.col("__url"))
    rows = pages.select(F.col(id_column).alias("page_id"), F.col(url_column).alias("__url")).select("page_id", host.alias("host"), path.alias("path"))
    found = verdict = None
    for rule, says in sorted(rules, key=lambda r: (-len(r[0]), r[0])):
        at = rule.index("/")
        fits = ((F.col("host") == rule[:at]) | F.endswith("host", F.lit("." + rule[:at]))) & F.startswith("path", F.lit(rule[at:]))
        found = F.when(fits, rule) if found is None else found.when(fits, rule)
        verdict = F.when(fits, says) if verdict is None else verdict.when(fits, says)
    none = F.lit(None).cast("string")
    return rows.select("*", (none if found is None else found).alias("rule"), (none if verdict is None else verdict).alias("ruled"))


def links(pages: DataFrame, url_column: str = "url", html_column: str = "html") -> DataFrame:
    """(src, dst, n): links between different hosts, counted before they are shuffled."""
    host, _ = host_and_path(F.col("__url"))
    targets = pages.select(F.col(url_column).alias("__url"), F.explode(F.regexp_extract_all(F.col(html_column), F.lit(r"""(?i)href\s*=\s*["']?\s*((?:https?:)?//[^"'\s>]+)"""), F.lit(1))).alias("link"))
    targets = targets.select(host.alias("src"), F.regexp_extract("link", r"^(?:[A-Za-z]+:)?//([^/?#]*)", 1).alias("dst"))
    targets = targets.select("src", F.translate("dst", UPPER, LOWER).alias("dst"))
    return targets.where("src <> dst AND src <> '' AND dst <> ''").groupBy("src", "dst").agg(F.count("*").alias("n"))


def spread(edges: DataFrame, seeds: DataFrame, damping: float = DAMPING) -> DataFrame:
    """(host, trust, distrust, full) over edges (src, dst, n) from seeds (host, good, bad); full: distrust if every host were bad."""
    start = 1 - damping
    if edges.isEmpty():
        return seeds.select("host", (F.col("good") * start).alias("trust"), (F.col("bad") * start).alias("distrust"), F.lit(start).alias("full"))
    out = edges.groupBy("src").agg(F.sum("n").alias("out"))
    into = edges.groupBy("dst").agg(F.sum("n").alias("into"))
    edges = common.staged(edges.join(out, "src").join(into, "dst").select("src", "dst", (damping * F.col("n") / F.col("out")).alias("on"), (damping * F.col("n") / F.col("into")).alias("back")), "url-edges")
    hosts = edges.select(F.col("src").alias("host")).union(edges.select("dst")).union(seeds.select("host")).distinct()
    zero = F.lit(0.0)
    seeds = common.staged(hosts.join(seeds, "host", "left").select("host", F.coalesce("good", zero).alias("good"), F.coalesce("bad", zero).alias("bad")), "url-seeds")
    ranks = seeds.select("host", (F.col("good") * start).alias("trust"), (F.col("bad") * start).alias("distrust"), F.lit(start).alias("full"), F.lit(1.0).alias("change"))
    for k in range(MOST):
        forward = edges.join(ranks, edges["src"] == ranks["host"]).select(F.col("dst").alias("host"), (F.col("trust") * F.col("on")).alias("t"), zero.alias("d"), zero.alias("f"))
        backward = edges.join(ranks, edges["dst"] == ranks["host"]).select(F.col("src").alias("host"), zero.alias("t"), (F.col("distrust") * F.col("back")).alias("d"), (F.col("full") * F.col("back")).alias("f"))
        own = seeds.join(ranks.select("host", F.col("trust").alias("t0"), F.col("distrust").alias("d0"), F.col("full").alias("f0")), "host") if k % STRIDE == STRIDE - 1 else seeds
        sent = forward.unionByName(backward).groupBy("host").agg(F.sum("t").alias("t"), F.sum("d").alias("d"), F.sum("f").alias("f"))
        now = {"trust": F.col("good") * start + F.coalesce("t", zero), "distrust": F.col("bad") * start + F.coalesce("d", zero), "full": start + F.coalesce("f", zero)}
        change = F.greatest(*[F.abs(x - F.col(n[0] + "0")) for n, x in now.items()]) if own is not seeds else zero
        ranks = own.join(sent, "host", "left").select("host", *[x.alias(n) for n, x in now.items()], change.alias("change"))
        if own is not seeds:
            ranks = common.staged(ranks, "url-ranks")
            if ranks.agg(F.max("change")).first()[0] <= SETTLED:
                break
    return ranks.drop("change")


def judged(pages: DataFrame, rules=RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, trust and distrust of every page."""
    rows = ruled(pages, rules)
    share = lambda says: (F.avg(F.when(F.col("ruled") == says, 1.0).otherwise(0.0)) >= SEED_SHARE).cast("double")
    seeds = rows.where("host <> ''").groupBy("host").agg(share("allow").alias("good"), share("block").alias("bad"))
    with common.workspace():
        ranks = common.staged(spread(common.staged(links(pages), "url-links"), seeds), "url-hosts")
    if ranks.limit(BROADCAST_HOSTS + 1).count() <= BROADCAST_HOSTS:
        joined = rows.join(F.broadcast(ranks), "host", "left")
    else:  # a host's pages are dealt to SALTS tasks
        salted = ranks.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = rows.withColumn("salt", F.pmod(F.xxhash64("page_id", "path"), F.lit(SALTS)).cast("int")).join(salted, ["host", "salt"], "left")
    scored = joined.select("page_id", "host", "path", "rule", "ruled", F.round(F.coalesce("trust", F.lit(0.0)), 9).alias("trust"), F.round(F.coalesce("distrust", F.lit(0.0)), 9).alias("distrust"), F.coalesce("full", F.lit(1.0)).alias("full"))
    guess = F.when((F.col("distrust") >= LEAST * F.least(F.col("full") - (1 - DAMPING), F.lit(1.0))) & (F.col("distrust") > F.col("trust")), "block").otherwise("allow")
    return scored.select("page_id", "host", "path", "rule", F.coalesce("ruled", guess).alias("verdict"), "trust", "distrust")


def op1_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on every page's url."""
    return judged(common.table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def sql(rules=RULES) -> str:
    """The same in DuckDB's SQL, a table for each round."""
    order = sorted(rules, key=lambda r: (-len(r[0]), r[0]))
    fits = lambda r: f"(host = '{r[: r.index('/')]}' OR ends_with(host, '.{r[: r.index('/')]}')) AND starts_with(path, '{r[r.index('/') :]}')"
    case = lambda k: "CASE " + " ".join(f"WHEN {fits(r[0])} THEN '{r[k]}'" for r in order) + " END"
    low = f"translate({{}}, '{UPPER}', '{LOWER}')"
    rest = "CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) END"
    parts = [
        f"a AS (SELECT page_id, html, {rest} AS rest FROM pages)",
        "b AS (SELECT page_id, html, regexp_extract(rest, '^[^/?#]*') AS raw, rest FROM a)",
        f"c AS (SELECT page_id, html, coalesce({low.format('raw')}, '') AS host, coalesce(regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*'), '') AS path FROM b)",
        f"ruled AS (SELECT *, {case(0)} AS rule, {case(1)} AS said FROM c)",
        f"seeds AS (SELECT host, CAST(avg(CASE WHEN said = 'allow' THEN 1.0 ELSE 0.0 END) >= {SEED_SHARE} AS DOUBLE) AS good, CAST(avg(CASE WHEN said = 'block' THEN 1.0 ELSE 0.0 END) >= {SEED_SHARE} AS DOUBLE) AS bad FROM ruled WHERE host <> '' GROUP BY host)",
        """hrefs AS (SELECT host AS src, unnest(regexp_extract_all(html, '(?i)href\\s*=\\s*["'']?\\s*((?:https?:)?//[^"''\\s>]+)', 1)) AS link FROM ruled)""",
        f"targets AS (SELECT src, {low.format('''regexp_extract(link, '^(?:[A-Za-z]+:)?//([^/?#]*)', 1)''')} AS dst FROM hrefs)",
        "pairs AS (SELECT src, dst, count(*) AS n FROM targets WHERE src <> dst AND src <> '' AND dst <> '' GROUP BY src, dst)",
        f"edges AS (SELECT src, dst, {DAMPING} * n / sum(n) OVER (PARTITION BY src) AS fwd, {DAMPING} * n / sum(n) OVER (PARTITION BY dst) AS back FROM pairs)",
        "hosts AS (SELECT host, coalesce(good, 0) AS good, coalesce(bad, 0) AS bad FROM (SELECT src AS host FROM edges UNION SELECT dst FROM edges UNION SELECT host FROM seeds) LEFT JOIN seeds USING (host))",
        "r0 AS (SELECT host, good AS trust, bad AS distrust FROM hosts)",
    ]
    for k in range(ROUNDS):
        parts.append(f"s{k} AS (SELECT host, sum(t) AS t, sum(d) AS d FROM (SELECT dst AS host, trust * fwd AS t, 0.0::DOUBLE AS d FROM edges JOIN r{k} ON src = host UNION ALL SELECT src, 0.0::DOUBLE, distrust * back FROM edges JOIN r{k} ON dst = host) GROUP BY host)")
        parts.append(f"r{k + 1} AS (SELECT host, good * {1 - DAMPING} + coalesce(t, 0) AS trust, bad * {1 - DAMPING} + coalesce(d, 0) AS distrust FROM hosts LEFT JOIN s{k} USING (host))")
    last = f"r{ROUNDS}"
    return "WITH " + ",\n".join(parts) + f"\nSELECT page_id, ruled.host, path, rule, coalesce(said, CASE WHEN round(coalesce(distrust, 0), 9) >= {LEAST} AND round(coalesce(distrust, 0), 9) > round(coalesce(trust, 0), 9) THEN 'block' ELSE 'allow' END) AS verdict FROM ruled LEFT JOIN {last} ON ruled.host = {last}.host"
