"""URL filters: rules first, then path templates of each host, rejected by labelled purity.

Rules (host, path) decide the urls they fit: host and all subdomains, paths that start
with the rule's.  Of several the longest wins, at equal length the one with the longer
host.  What a rule decides is also the label from which the rest is judged.

Every distinct (host, path) counts once, with its rows, queries and fragments.  Per
host its paths form a tree, built from the root downwards, all hosts at once:

1.  A segment stays as it is if at least ``SUPPORT`` paths and ``SHARE`` of its parent's
    go through it.  All others are variable: they become a wildcard of their kind (digits,
    letters, both, anything; with or without an extension).  So a node has a bounded
    number of branches, however many segments there are.
2.  Branches of a node that are similar are merged: those next to each other, in the
    order of their labels and of what follows them, if the kinds of what follows differ by
    at most ``DISTANCE`` (total variation) and the shares of good labels by no more than
    chance (two proportions, ``Z``).  With labels are not merged with without.
3.  Merged branches are one node of the template, ``{en|es}``.  A node of fewer than
    ``SPLIT`` paths is not opened; what is below it is ``**``.

A node's purity is its share of good labels, smoothed with ``WEIGHT`` labels of its
parent's purity; a host's parent is the whole.  Without labels of its own a node
has its parent's.  Urls of templates below ``PURITY`` are blocked, all others allowed.

Urls that are null or have no ``://`` have an empty host and path, and are a host.
Repeated rows get equal results.  All of it is DataFrame functions.  The number of
rounds is the depth to which ``SPLIT`` paths agree; each stores its rows and joins two
shuffled tables, so Spark can split a hot host.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scholarlake.llm.common import stored

Rule = tuple[str, str]  # a verdict, and what it is for: host/path

ALLOW, BLOCK = "allow", "block"

SUPPORT = 8  # paths
SHARE = 0.02
SPLIT = 16  # paths
DISTANCE = 0.25
Z = 1.96
WEIGHT = 4.0  # labels
PURITY = 0.3

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
EXTENSION = r"\.[A-Za-z0-9]{1,5}\z"
# Kinds of segments; a literal one with such a character is written in its escape.
KINDS = ("", *(f"*{kind}{dot}" for kind in ("num", "word", "id", "any") for dot in ("", ".")))
ESCAPES = {"*": "%2A", "{": "%7B", "|": "%7C", "}": "%7D"}
NEXT = ("end", *KINDS)  # what may follow a segment


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Both empty if there is no ``://``."""
    url = F.coalesce(url.cast("string"), F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """The rule that decides and its verdict; both null where none fits."""
    parts = [(verdict, *rule.partition("/")) for verdict, rule in rules]
    parts.sort(key=lambda p: (-len(p[1]) - len(p[3]), -len(p[1])))
    which, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for decided, of, _, start in reversed(parts):
        fits = ((host == of) | host.endswith("." + of)) & path.startswith("/" + start)
        which = F.when(fits, F.lit(f"{of}/{start}")).otherwise(which)
        verdict = F.when(fits, F.lit(decided)).otherwise(verdict)
    return which, verdict


def kind_of(segment: Column) -> Column:
    """Which of KINDS."""
    stem = F.regexp_replace(segment, EXTENSION, "")
    dot = F.when(stem == segment, "").otherwise(".")
    kind = (
        F.when((stem != "") & (F.translate(stem, "0123456789", "") == ""), "*num")
        .when((stem != "") & ~stem.rlike("[^A-Za-z_-]"), "*word")
        .when((stem != "") & ~stem.rlike("[^A-Za-z0-9_-]"), "*id")
        .otherwise("*any")
    )
    return F.when(segment == "", "").otherwise(F.concat(kind, dot))


def _escaped(segment: Column) -> Column:
    return reduce(lambda s, e: F.replace(s, F.lit(e[0]), F.lit(e[1])), ESCAPES.items(), segment)


def _label(verdict: str) -> Column:
    return F.count_if(F.coalesce(F.col("label") == verdict, F.lit(False)))


def _smoothed(good: Column, bad: Column, parent: Column) -> Column:
    return (good + WEIGHT * parent) / (good + bad + WEIGHT)


def merged(siblings: DataFrame) -> DataFrame:
    """Branches (host, node, token, n, good, bad, next) with the class each is in, by name.

    The branches of a node are as many as SHARE and KINDS allow, so they fit a window.
    """
    labelled = F.col("good") + F.col("bad")
    most = F.array_position("next", F.array_max("next"))
    share = F.coalesce(F.try_divide(F.col("good").cast("double"), labelled), F.lit(0.0))
    ordered = siblings.withColumns({"labelled": labelled, "most": most, "share": share})
    order = Window.partitionBy("host", "node").orderBy(
        (F.col("labelled") > 0).cast("int"), "most", "share", "token"
    )
    own = {c: F.col(c).cast("double") for c in ("n", "good", "labelled")}
    last = {c: F.lag(c).over(order).cast("double") for c in own}
    counts = F.lag("next").over(order)
    apart = F.aggregate(
        F.zip_with("next", counts, lambda a, b: F.abs(a * last["n"] - b * own["n"])),
        F.lit(0.0),
        lambda total, x: total + x,
    )
    alike = apart <= 2 * DISTANCE * own["n"] * last["n"]
    pooled = (own["good"] + last["good"] + 1) / (own["labelled"] + last["labelled"] + 2)
    shares = [F.try_divide(x["good"], x["labelled"]) for x in (own, last)]
    spread = F.try_divide(F.lit(1.0), own["labelled"]) + F.try_divide(F.lit(1.0), last["labelled"])
    gap = (shares[0] - shares[1]) * (shares[0] - shares[1])
    chance = gap <= Z * Z * pooled * (1 - pooled) * spread
    same = (own["labelled"] == 0) & (last["labelled"] == 0) | F.coalesce(chance, F.lit(False))
    new = F.when(F.coalesce(alike & same, F.lit(False)), 0).otherwise(1)
    classes = ordered.withColumn("new", new).withColumn("class", F.sum("new").over(order))
    members = Window.partitionBy("host", "node", "class")
    names = F.sort_array(F.collect_list("token").over(members))
    name = F.when(F.size(names) == 1, names[0]).otherwise(
        F.concat(F.lit("{"), F.array_join(names, "|"), F.lit("}"))
    )
    sums = {c: F.sum(c).over(members) for c in ("n", "good", "bad")}
    return classes.select(
        "host", "node", "token", "purity", name.alias("name"),
        *(column.alias(f"all_{c}") for c, column in sums.items()),
    )


def _opened(live: DataFrame, depth: int) -> DataFrame:
    """(host, node, segment): the node below, its purity and its number of paths."""
    following = F.get(F.col("segments"), F.lit(depth + 1))
    kind = F.when(following.isNull(), "end").otherwise(kind_of(following))
    branches = stored(
        live.withColumns({"segment": F.get("segments", F.lit(depth)), "kind": kind})
        .groupBy("host", "node", "segment")
        .agg(
            F.count(F.lit(1)).alias("n"),
            _label(ALLOW).alias("good"),
            _label(BLOCK).alias("bad"),
            F.array(*(F.count_if(F.col("kind") == k) for k in NEXT)).alias("next"),
            F.max("purity").alias("purity"),
        )
    )
    # The struct is another key than those of the sums below: a node of many segments
    # is split in this join, and combined in each task before it is dealt out again.
    total = branches.groupBy("host", "node").agg(F.sum("n").alias("total")).select(
        F.struct("host", "node").alias("parent"), "total"
    )
    constant = (F.col("n") >= SUPPORT) & (F.col("n") >= SHARE * F.col("total"))
    token = F.when(constant, _escaped(F.col("segment"))).otherwise(kind_of(F.col("segment")))
    tokens = branches.join(total, F.struct("host", "node") == F.col("parent"))
    tokens = tokens.withColumn("token", token)
    siblings = tokens.groupBy("host", "node", "token").agg(
        *(F.sum(c).alias(c) for c in ("n", "good", "bad")),
        F.array(*(F.sum(F.col("next")[i]) for i in range(len(NEXT)))).alias("next"),
        F.max("purity").alias("purity"),
    )
    below = merged(siblings).select(
        "host",
        "node",
        "token",
        F.concat_ws("/", "node", "name").alias("below"),
        _smoothed(F.col("all_good"), F.col("all_bad"), F.col("purity")).alias("its_purity"),
        F.col("all_n").alias("its_size"),
    )
    return tokens.select("host", "node", "token", "segment").join(below, ["host", "node", "token"])


def templates(paths: DataFrame) -> DataFrame:
    """The template and purity of each (host, path, label), label being a verdict or null."""
    hosts = stored(
        paths.groupBy("host").agg(
            F.count(F.lit(1)).alias("size"), _label(ALLOW).alias("good"), _label(BLOCK).alias("bad")
        )
    )
    counts = hosts.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("good", "bad"))).first()
    whole = F.lit((counts.good + 1) / (counts.good + counts.bad + 2))
    roots = hosts.select(
        "host",
        F.lit("").alias("node"),
        _smoothed(F.col("good"), F.col("bad"), whole).alias("purity"),
        "size",
    )
    segments = F.split("path", "/")
    state = paths.join(roots, "host").withColumn(
        "segments", F.slice(segments, F.lit(2), F.size(segments))
    )
    done, depth = [], 0
    while True:
        state = stored(state)
        more = F.size("segments") > depth
        live = more & (F.col("size") >= SPLIT)
        end = F.when(more, F.concat("node", F.lit("/**"))).otherwise(F.col("node"))
        done.append(state.where(~live).select("host", "path", end.alias("template"), "purity"))
        opened = state.where(live)
        if opened.isEmpty():
            return reduce(DataFrame.unionAll, done)
        below = stored(_opened(opened, depth)).drop("token")
        segment = F.get("segments", F.lit(depth))
        state = (
            opened.withColumn("segment", segment)
            .join(below, ["host", "node", "segment"])
            .select(
                "host", "path", "label", F.col("below").alias("node"),
                F.col("its_purity").alias("purity"), F.col("its_size").alias("size"), "segments",
            )
        )
        depth += 1


def judged(pages: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Per row of (page_id, url): page_id, host, path, rule, verdict, template, purity."""
    host, path = host_and_path(F.col("url"))
    urls = pages.select("page_id", host.alias("host"), path.alias("path"))
    _, label = rule_of(F.col("host"), F.col("path"), rules)
    paths = urls.select("host", "path").distinct().withColumn("label", label)
    # Stored, so that the join has a shuffle on either side and Spark can split what
    # a hot url makes of the left one.
    found = stored(templates(paths))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    judged_by_purity = F.when(F.col("purity") < PURITY, BLOCK).otherwise(ALLOW)
    return urls.join(found, ["host", "path"]).select(
        "page_id",
        "host",
        "path",
        rule.alias("rule"),
        F.coalesce(verdict, judged_by_purity).alias("verdict"),
        "template",
        "purity",
    )
