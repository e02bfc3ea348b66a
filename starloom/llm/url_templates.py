"""URL filter by path-template trees (operator 6).

Every URL is split into host and path. Rules (host, path) come first: a rule
fits its host and all subdomains if the path starts with the rule's; of the
rules that fit, the longest wins (host and path together; of equally long ones
the longer host). The URLs that rules fit are at the same time the labels the
templates learn from; more labels can be given.

Per host the paths form a tree of segments. It is generalised level by level:

1. segments with the look of an identifier (numbers, hex, mixtures of digits
   and letters, very long words) become wildcards of their kind;
2. among the words, branches whose labelled share of blocked URLs does differ
   from that of their siblings by a two-proportion z-test, or cannot be compared
   as no sibling has labels, stay on their own;
3. a place is variable if its words are many and none prevails: the effective
   number of branches, (sum of p) ** 2 / sum of p ** 2 with p the different
   generalised paths of a branch, is at least ``min_branches``. It does not
   change if rows are repeated or all branches grow alike. There the branches
   without any label become ``*``, and so do the labelled ones left if at least
   ``min_branches`` words have labels: fewer say too little about the others;
4. the labelled branches left are merged into ``{alike}``, those without any
   label into ``{unlabelled}``.

The first ``depth`` levels are always walked. Further down the walk goes on as
long as a template with labels has several paths, whatever their length, in
steps to the next place where some template's paths differ; a template without
labels or with a single path gets ``/**`` for its rest, as no split can change
its verdict. A template is rejected if its labelled
purity - the share of allowed URLs among the labelled ones, smoothed by
``strength`` pseudo-labels of ``prior`` purity - is below ``min_purity``.

All in DataFrame operations: URLs are first summed up by host and generalised
path, the tree works on those sums, and the verdict is joined back. The join
reads two checkpointed tables, so Spark may split a host that holds a third of
all rows.

Defined results: a null URL or one without ``://`` has empty host and path, no
rule, and is allowed unless its (shared, empty) template is rejected; repeated
rows and ids are judged one by one; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import ascii_lower, cut

# (host, path, verdict)
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
DEPTH = 4  # levels that are walked in any case
MIN_BRANCHES = 8  # a place is variable from so many effective branches on
MAX_WORD = 24
Z = 1.96
PRIOR, STRENGTH, MIN_PURITY = 0.9, 4.0, 0.5


def split_url(url: Column) -> tuple[Column, Column]:
    """(host with A-Z lower-cased, path)."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.coalesce(ascii_lower(host), F.lit("")), F.coalesce(path, F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """(rule as text, its verdict), null where no rule fits."""
    order = sorted(rules, key=lambda r: (-len(r[0] + r[1]), -len(r[0]), r[2] != "block"))
    name = verdict = F.lit(None).cast("string")
    for rule_host, rule_path, rule_verdict in reversed(order):
        fits = ((host == rule_host) | host.endswith(f".{rule_host}")) & path.startswith(rule_path)
        name = F.when(fits, f"{rule_host}{rule_path}").otherwise(name)
        verdict = F.when(fits, rule_verdict).otherwise(verdict)
    return name, verdict


def shape(segment: Column, max_word: int = MAX_WORD) -> Column:
    """Wildcard of the kind a variable-looking segment has, else the segment;
    a file ending of letters stays."""
    end = F.regexp_extract(segment, r"(\.[A-Za-z]{1,5})$", 1)
    stem = F.substring(segment, F.lit(1), F.length(segment) - F.length(end))
    kind = (
        F.when(stem.rlike(r"^[0-9]+$"), "{number}")
        .when(stem.rlike(r"^(?=.*[0-9])[0-9a-fA-F-]{8,}$"), "{hex}")
        .when(stem.rlike(r"[0-9]") & stem.rlike(r"[^0-9]"), "{mixed}")
        .when(F.length(stem) > max_word, "{long}")
    )
    return F.when(kind.isNull(), segment).otherwise(F.concat(kind, end))


def _leaves(urls: DataFrame) -> DataFrame:
    sums = [F.sum("labelled").alias("labelled"), F.sum("blocked").alias("blocked")]
    ones = urls.select("host", "shaped", F.col("bad").isNotNull().cast("long").alias("labelled"), F.coalesce("bad", F.lit(0)).cast("long").alias("blocked"))
    return ones.groupBy("host", "shaped").agg(*sums)


def _level(tree: DataFrame, depth: int, min_branches: int, z: float) -> DataFrame:
    """Appends the segment at ``depth``, generalised, to every template."""
    tree = tree.withColumn("segment", F.get(F.split("shaped", "/", -1), F.lit(depth)))
    branches = cut(
        tree.where("segment is not null").groupBy("host", "template", "segment")
        .agg(F.count(F.lit(1)).cast("double").alias("paths"), F.sum("labelled").alias("labelled"), F.sum("blocked").alias("blocked"))
    )
    word = ~F.col("segment").rlike(r"^(\{|$)")
    family = cut(
        branches.where(word).groupBy("host", "template")
        .agg(
            F.sum("paths").alias("f_paths"), F.sum(F.col("paths") * F.col("paths")).alias("f_squares"), F.count_if(F.col("labelled") > 0).alias("f_known"),
            F.sum("labelled").alias("f_labelled"), F.sum("blocked").alias("f_blocked"),
        )
    )
    both = branches.join(family, ["host", "template"], "left")
    own, rest = F.col("blocked") / F.col("labelled"), F.try_divide(F.col("f_blocked") - F.col("blocked"), F.col("f_labelled") - F.col("labelled"))
    pooled = F.try_divide(F.col("f_blocked"), F.col("f_labelled"))
    spread = F.sqrt(pooled * (1 - pooled) * (F.try_divide(F.lit(1.0), F.col("labelled")) + F.try_divide(F.lit(1.0), F.col("f_labelled") - F.col("labelled"))))
    alike = (F.col("labelled") > 0) & F.coalesce(F.abs(own - rest) <= z * spread, F.lit(False))
    variable = F.col("f_paths") * F.col("f_paths") >= min_branches * F.col("f_squares")
    step = (
        F.when(~word, F.col("segment"))
        .when((F.col("labelled") > 0) & ~alike, F.col("segment"))
        .when(variable & ((F.col("labelled") == 0) | (F.col("f_known") >= min_branches)), "*")
        .when(F.col("labelled") == 0, "{unlabelled}")
        .otherwise("{alike}")
    )
    steps = cut(both.select("host", "template", "segment", step.alias("step")))
    joined = tree.join(steps, ["host", "template", "segment"], "left")
    return cut(joined.withColumn("template", F.when(F.col("segment").isNull(), F.col("template")).otherwise(F.concat("template", F.lit("/"), "step"))).drop("segment", "step"))


def _walked(tree: DataFrame, depth: int, min_branches: int, z: float) -> DataFrame:
    """Goes on from ``depth`` where labelled templates still have several paths."""
    done, at = [], depth
    while True:
        segments = F.split("shaped", "/", -1)
        going = tree.where(F.size(segments) > at)
        whole = F.concat("shaped", F.lit("/"))
        paths = going.groupBy("host", "template").agg(F.count(F.lit(1)).alias("paths"), F.sum("labelled").alias("labelled"), F.min(whole).alias("low"), F.max(whole).alias("high"))
        low, high = F.split("low", "/", -1), F.split("high", "/", -1)
        places = F.sequence(F.lit(0), F.least(F.size(low), F.size(high)) - 1)
        common = F.aggregate(places, F.lit(0), lambda n, i: F.when((n == i) & (F.get(low, i) == F.get(high, i)), n + 1).otherwise(n))
        several = cut(paths.where("paths > 1 and labelled > 0").select("host", "template", common.alias("common")))
        done += [tree.where(F.size(segments) <= at), going.join(several, ["host", "template"], "left_anti").withColumn("template", F.concat("template", F.lit("/**")))]
        differ = several.agg(F.min("common")).first()[0]
        if differ is None:
            return cut(reduce(DataFrame.unionByName, done))
        differ = max(differ, at)
        shared = F.array_join(F.slice(segments, at + 1, differ - at), "/") if differ > at else None
        tree = going.join(several.drop("common"), ["host", "template"])
        if shared is not None:
            tree = tree.withColumn("template", F.concat("template", F.lit("/"), shared))
        tree = _level(tree, differ, min_branches, z)
        at = differ + 1


def judge(
    pages: DataFrame, keep: Sequence[str] = ("page_id",), rules: Sequence[tuple[str, str, str]] = RULES, label: Column | None = None, depth: int = DEPTH,
    min_branches: int = MIN_BRANCHES, z: float = Z, prior: float = PRIOR, strength: float = STRENGTH, min_purity: float = MIN_PURITY,
) -> DataFrame:
    """The columns ``keep`` of pages and host, path, rule, template, labelled,
    purity and verdict. ``label`` (true: bad, false: good, null: none) labels
    URLs that no rule fits."""
    made = {"host", "path", "rule", "template", "labelled", "purity", "verdict"}
    if clash := set(keep) & made:
        raise ValueError(f"columns to keep that this operator sets itself: {sorted(clash)}")
    host, path = split_url(F.col("url"))
    own = [F.col(f"`{k}`").alias(f"_k{i}") for i, k in enumerate(keep)]
    rows = pages.select(*own, host.alias("host"), path.alias("path"), (label if label is not None else F.lit(None)).cast("boolean").alias("given"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    rows = rows.withColumns({"rule": rule, "rule_verdict": verdict})
    shaped = F.array_join(F.transform(F.split(F.regexp_replace("path", "^/", ""), "/", -1), lambda s: shape(s)), "/")
    bad = F.coalesce(F.col("rule_verdict") == "block", F.col("given"))
    rows = cut(rows.withColumns({"shaped": shaped, "bad": bad.cast("int")}).drop("given"))
    tree = _leaves(rows).withColumn("template", F.lit(""))
    for at in range(depth):
        tree = _level(tree, at, min_branches, z)
    tree = _walked(tree, depth, min_branches, z)
    sums = cut(tree.groupBy("host", "template").agg(F.sum("labelled").alias("labelled"), F.sum("blocked").alias("blocked")))
    purity = (F.col("labelled") - F.col("blocked") + F.lit(prior * strength)) / (F.col("labelled") + F.lit(strength))
    scored = sums.select("host", "template", "labelled", purity.alias("purity"))
    by_path = cut(tree.select("host", "shaped", "template").join(scored, ["host", "template"]))
    out = rows.join(by_path, ["host", "shaped"])
    final = F.coalesce("rule_verdict", F.when(F.col("purity") < min_purity, "block").otherwise("allow"))
    return out.select(*[F.col(f"_k{i}").alias(k) for i, k in enumerate(keep)], "host", "path", "rule", "template", "labelled", "purity", final.alias("verdict"))
