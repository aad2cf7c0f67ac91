"""URL verdicts by rules and by trust that passes along links between hosts.

Only built-in DataFrame functions.  Rules decide the urls they fit.  All others go
by the link graph: trust starts at the hosts with allowed urls and follows the
links (personalised PageRank); distrust starts at the hosts with blocked urls and
follows the links backwards, as a site that links to spam is suspect.  A rule
speaks for its own paths only, so a host's own start mass isn't held against its
other urls: what counts is the mass that reaches it through links.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.scratch import cut, keep

DAMPING = 0.85
TOLERANCE = 1e-6  # of each host's scores; its verdict needs more, see propagate
FADING = 0.84  # just below the damping, so that masses that come in turns of several rounds fade as well
ROUNDING = 1e-13  # a share of a host's scores below which their order is rounding
MARGIN = 0.0  # a host is blocked if its distrust is above its trust by more than this

#: (verdict, host, path prefix)
RULES = (("block", "com", "/en/"), ("allow", "example.com", "/en/7"), ("allow", "net", "/de/"), ("block", "example.net", "/de/8"), ("block", "org", "/es/"))

_LINK = r"(?i)<a\s[^>]*?href\s*=\s*[\"']?(?:https?:)?//([^/?#\"'\s>]+)"


def lower_host(url: Column) -> Column:
    """The host of a url with A-Z in lower case; empty for null or without ``://``."""
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), letters, letters.lower())


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?`` or ``#``; empty for null or without ``://``."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: tuple[tuple[str, str, str], ...]) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict, both null if none fits.

    Of equally long rules the one that blocks comes first, then the smaller text.
    The rules are settings, given in the program, not a table that grows.
    """
    texts, verdicts = [], []
    for verdict, rule_host, rule_path in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[0] != "block", r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        texts.append(F.when(fits, F.lit(rule_host + rule_path)))
        verdicts.append(F.when(fits, F.lit(verdict)))
    nothing = F.lit(None).cast("string")
    return F.coalesce(*texts, nothing), F.coalesce(*verdicts, nothing)


def propagate(edges: DataFrame, seeds: DataFrame, damping: float = DAMPING, margin: float = MARGIN) -> DataFrame:
    """(host, trust, distrust): the PageRank masses that reach hosts through links.

    ``edges`` are (kind, src, dst, share), the shares of one kind and source adding
    up to 1; ``seeds`` are (kind, host, start), the starts of one kind adding up to
    1; kinds are ``allow`` and ``block``.  Mass of hosts without links is not passed
    on.  Each round passes on what the last one brought, until no new host is
    reached, every score is within ``TOLERANCE``, and every host's distrust is
    provably on its side of trust + ``margin``.  Two bounds say what can still come
    to a host.  All later rounds together bring at most mass * damping / (1 -
    damping) of the mass under way.  The other is each host's own: let ``lately`` be
    what came to it, earlier rounds counting ``FADING`` less each.  If no host's
    ``lately`` is above r < 1 times that of the round before, later rounds bring a
    host at most r / (1 - r) of its ``lately``, as passing on keeps such an order.
    Sides that differ by less than doubles can tell are as they come.  So rounds
    end at any size of graph and of scores; a chain of n hosts takes n rounds.
    """
    nothing = F.lit(0.0)
    state = seeds.select("kind", "host", nothing.alias("score"), (F.col("start") * (1 - damping)).alias("came"), (F.col("start") * (1 - damping)).alias("lately"))
    while True:
        going = state.where("came > 0").select("kind", F.col("host").alias("src"), "came")
        passed = edges.join(going, ["kind", "src"]).groupBy("kind", F.col("dst").alias("host")).agg(F.sum(F.col("came") * F.col("share") * damping).alias("came"))
        rows = state.select("kind", "host", "score", nothing.alias("came"), F.col("lately").alias("before")).unionByName(passed.select("kind", "host", nothing.alias("score"), "came", nothing.alias("before")))
        rows = rows.groupBy("kind", "host").agg(F.sum("score").alias("old"), F.sum("came").alias("came"), F.sum("before").alias("before"))
        state = cut(rows.withColumn("score", F.col("old") + F.col("came")).withColumn("lately", F.col("came") + F.col("before") * FADING))
        grown = F.when(F.col("lately") > 0, F.when(F.col("before") > 0, F.col("lately") / F.col("before")).otherwise(float("inf")))
        stats = state.groupBy("kind").agg(F.sum("came").alias("mass"), F.max(grown).alias("grown"), F.sum(F.expr("int(came > 0 and old = 0)")).alias("fresh"), F.max("lately").alias("most")).collect()
        if not any(r["mass"] for r in stats):
            break
        if any(r["fresh"] for r in stats):
            continue
        still, most = nothing, 0.0
        for r in stats:
            whole = r["mass"] * damping / (1 - damping)
            bound, highest = F.lit(whole), whole
            if r["grown"] is not None and r["grown"] < 1:
                factor = r["grown"] / (1 - r["grown"])
                bound, highest = F.least(bound, F.col("lately") * factor), min(whole, r["most"] * factor)
            still, most = F.when(F.col("kind") == r["kind"], bound).otherwise(still), max(most, highest)
        if most <= TOLERANCE and _sides(state.withColumn("still", still), margin).where("not decided").isEmpty():
            break
    by = [F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("score"))), nothing).alias(name) for k, name in (("allow", "trust"), ("block", "distrust"))]
    return state.where("score > 0").groupBy("host").agg(*by)


def _sides(state: DataFrame, margin: float) -> DataFrame:
    """(host, decided): whether what can ``still`` come to a host leaves it on its side."""

    def of(kind: str, column: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col(column))), F.lit(0.0))

    side = of("block", "score") - of("allow", "score") - margin
    hosts = state.where("score > 0").groupBy("host").agg(side.alias("side"), of("allow", "still").alias("up"), of("block", "still").alias("down"), F.sum("score").alias("scores"))
    kept = F.when(F.col("side") > 0, F.col("side") > F.col("up")).otherwise(-F.col("side") >= F.col("down"))
    return hosts.select("host", (kept | (F.col("up") + F.col("down") <= F.col("scores") * ROUNDING)).alias("decided"))


def judge(pages: DataFrame, rules: tuple[tuple[str, str, str], ...] = RULES, margin: float = MARGIN) -> DataFrame:
    """(page_id, host, path, rule, verdict, trust, distrust) of each page.

    Links are the absolute ``href`` targets in the whole html; a link to the own
    host adds nothing.  A null url has an empty host and path, fits no rule, and is
    allowed unless links say otherwise.  A null html has no links, and pages of any
    length are searched whole.  Repeated rows stay; other columns are not read,
    whatever their names, and an empty table gives an empty result.
    """
    host, path = lower_host(F.col("url")), path_of(F.col("url"))
    urls = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    judged = urls.withColumn("rule", rule).withColumn("by_rule", verdict)

    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    links = pages.select(host.alias("src"), F.explode(F.regexp_extract_all(F.coalesce(F.col("html"), F.lit("")), F.lit(_LINK), F.lit(1))).alias("dst"))
    links = links.withColumn("dst", F.translate("dst", letters, letters.lower())).where("src <> dst and src <> ''")
    counts = keep(links.groupBy("src", "dst").agg(F.count("*").alias("n")))

    def shares(kind: str, source: str, target: str) -> DataFrame:
        out = counts.groupBy(F.col(source).alias("src")).agg(F.sum("n").alias("all"))
        pairs = counts.select(F.col(source).alias("src"), F.col(target).alias("dst"), "n").join(out, "src")
        return pairs.select(F.lit(kind).alias("kind"), "src", "dst", (F.col("n") / F.col("all")).alias("share"))

    edges = cut(shares("allow", "src", "dst").unionByName(shares("block", "dst", "src")))
    seen = cut(judged.where("by_rule is not null").groupBy(F.col("by_rule").alias("kind"), "host").agg(F.count("*").alias("n")))
    totals = {r["kind"]: r["n"] for r in seen.groupBy("kind").agg(F.sum("n").alias("n")).collect()}  # two rows at most
    total = F.when(F.col("kind") == "allow", F.lit(totals.get("allow", 1))).otherwise(F.lit(totals.get("block", 1)))
    hosts = propagate(edges, seen.select("kind", "host", (F.col("n") / total).alias("start")), margin=margin)
    by_links = F.when(F.coalesce(F.col("distrust") - F.col("trust"), F.lit(0.0)) > margin, F.lit("block")).otherwise(F.lit("allow"))
    return judged.join(hosts, "host", "left").select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("by_rule", by_links).alias("verdict"),
        F.coalesce("trust", F.lit(0.0)).alias("trust"),
        F.coalesce("distrust", F.lit(0.0)).alias("distrust"),
    )
