"""URL filter: rules first, and a path-template tree for the urls that no rule fits.

The tree is grown level by level below each host, by aggregations keyed by (host, template so far, segment), so that a host with a third of
all urls is still spread over many tasks; no host is collected.

1. Segments that hold digits are generalised by their shape: `46935.html` to `#.html`.
2. At each level, a segment is generalised to `*` if it is one of many (at least `many` siblings, and under `rare` of its parent's urls). What is left
   of a parent's branches is a list of `many + 1 / rare` at most.
3. Branches of a parent that are statistically alike are merged (`merged`): what comes next below them is spread alike (a chi-square test over
   hashed next segments), and their shares of bad urls don't differ by `z` standard errors where both have labels. A branch without labels that is like
   groups that disagree on the labels stays by itself. Branches of fewer than `least` urls aren't tested.
4. A template is rejected if its smoothed purity, (bad + w * prior) / (labelled + w), reaches `reject`; w is `weight` and `carry` for each url of the
   template without a label, so the labels of few urls don't decide over very many others. A template without labels is judged by those of its
   nearest ancestor that has any: each labelled branch below that counts once, by its share of bad urls, so it takes three bad
   branches and no good one to reject it.

The labels are the verdicts of the rules. Segments below `levels` are taken as one. Rules are a short list that is compiled into the plan.

Defined results: a null url, or one without `://`, has an empty host and path and is judged like others of that host; repeated urls are judged
alike; host and path are cut out as the contract says, without decoding; other columns are not returned, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import dropped, written

MOST_RULES = 1000
#: Over how many places what comes next below a branch is counted.
SPREAD = 16
#: The rules of the query (verdict, host and path prefix).
RULES = (("block", "com/en/"), ("allow", "example.com/en/7"), ("allow", "net/de/"), ("block", "example.net/de/8"), ("block", "org/es/"))


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url)))
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(lower, F.lit("")), F.coalesce(path, F.lit(""))


def rule_of(host: Column, path: Column, rules: tuple[tuple[str, str], ...]) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null if none does."""
    if len(rules) > MOST_RULES:
        raise ValueError(f"more than {MOST_RULES} rules")
    rule = verdict = F.lit(None).cast("string")
    for what, text in sorted(rules, key=lambda r: len(r[1])):
        owner, slash, start = text.partition("/")
        fits = ((host == owner) | host.endswith(f".{owner}")) & path.startswith(slash + start)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(what)).otherwise(verdict)
    return rule, verdict


def _sums() -> list[Column]:
    return [F.sum(c).alias(c) for c in ("n", "known", "bad")]


def _alike(a: list[int], b: list[int], z: float) -> bool:
    """Whether two lists of counts don't differ by a chi-square test of homogeneity, at z standard errors by the cube root rule."""
    na, nb = sum(a), sum(b)
    chi, df = 0.0, -1
    for x, y in zip(a, b, strict=True):
        if x + y:
            df += 1
            chi += (x - (x + y) * na / (na + nb)) ** 2 / ((x + y) * na / (na + nb)) + (y - (x + y) * nb / (na + nb)) ** 2 / ((x + y) * nb / (na + nb))
    return df < 1 or (chi / df) ** (1 / 3) - 1 + 2 / (9 * df) < z * math.sqrt(2 / (9 * df))


def _agree(bad_a: int, known_a: int, bad_b: int, known_b: int, z: float) -> bool:
    """Whether two shares of bad urls don't differ; a share of no labels agrees with any."""
    if not known_a or not known_b:
        return True
    pooled = (bad_a + bad_b + 0.5) / (known_a + known_b + 1.0)
    return abs(bad_a / known_a - bad_b / known_b) < z * math.sqrt(pooled * (1 - pooled) * (1 / known_a + 1 / known_b))


def merged(branches: list[tuple[str, int, int, int, list[int]]], least: int = 5, z: float = 1.96) -> dict[str, str]:
    """The general name of each branch (name, urls, labelled, bad, spread of what comes next); those that were merged share one.

    Branches join groups one by one, those with most labels, then most urls first; each joins the first group that it is like.
    """
    groups: list[list] = []
    out = {}
    for name, n, known, bad, spread in sorted(branches, key=lambda x: (-x[2], -x[1], x[0])):
        like = [g for g in groups if n >= least and _alike(spread, g[3], z) and _agree(bad, known, g[2], g[1], z)] if name != "*" else []
        if not known and any(not _agree(g[2], g[1], h[2], h[1], z) for g in like for h in like):
            like = []
        if like:
            like[0][0].append(name)
            like[0][1:] = [like[0][1] + known, like[0][2] + bad, [x + y for x, y in zip(like[0][3], spread, strict=True)]]
        elif n >= least and name != "*":
            groups.append([[name], known, bad, list(spread)])
        else:
            out[name] = name
    for names, *_ in groups:
        # a path holds no question mark, so this is no segment's own name
        out.update(dict.fromkeys(names, names[0] if len(names) == 1 else "?" + "|".join(sorted(names))))
    return out


def _merge_lists(least: int, z: float):
    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple[str, str, str, str]] = []
            for host, template, branches in zip(*(batch.column(c).to_pylist() for c in ("host", "template", "branches")), strict=True):
                names = merged([(x["segment"], x["n"], x["known"], x["bad"], x["spread"]) for x in branches], least, z)
                rows += [(host, template, a, b) for a, b in names.items()]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.string()) for i in range(4)], names=["host", "template", "kept", "general"])

    return merge


def templates(urls: DataFrame, levels: int = 4, many: int = 20, rare: float = 0.02, least: int = 5, z: float = 1.96) -> DataFrame:
    """(host, shape, template) for urls (host, shape, known, bad): shape is the path with segments that hold digits generalised."""
    tree = urls.groupBy("host", "shape").agg(F.count(F.lit(1)).alias("n"), F.sum("known").alias("known"), F.sum("bad").alias("bad"))
    parts = F.split(F.col("shape"), "/", levels + 1)
    tree = written(tree.withColumn("parts", parts).withColumn("template", F.lit("")))
    for level in range(1, levels + 1):
        node = ["host", "template", "segment"]
        tree_now = tree.withColumn("segment", F.get("parts", F.lit(level)))
        bucket = F.pmod(F.xxhash64(F.coalesce(F.get("parts", F.lit(level + 1)), F.lit("?"))), F.lit(SPREAD))
        spread = F.array(*[F.sum(F.when(bucket == j, F.col("n")).otherwise(F.lit(0))) for j in range(SPREAD)])
        children = tree_now.where(F.col("segment").isNotNull()).groupBy(*node).agg(*_sums(), spread.alias("spread"))
        parents = children.groupBy("host", "template").agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("all_n"))
        kept = F.when((F.col("k") >= many) & (F.col("n") < rare * F.col("all_n")), F.lit("*")).otherwise(F.col("segment"))
        children = written(children.join(parents, ["host", "template"]).withColumn("kept", kept).drop("k", "all_n"))
        pooled = F.array(*[F.sum(F.col("spread")[j]) for j in range(SPREAD)])
        few = children.groupBy("host", "template", F.col("kept").alias("segment")).agg(*_sums(), pooled.alias("spread"))
        # many + 1 / rare branches at most
        lists = few.groupBy("host", "template").agg(F.collect_list(F.struct("segment", "n", "known", "bad", "spread")).alias("branches"))
        general = lists.mapInArrow(_merge_lists(least, z), "host string, template string, kept string, general string")
        decided = children.select(*node, "kept").join(general, ["host", "template", "kept"]).select(*node, "general")
        grown = F.when(F.col("segment").isNull(), F.col("template")).otherwise(F.concat("template", F.lit("/"), "general"))
        # a level reads the tree twice, so each is written: the plan stays that of one level
        after = written(tree_now.join(decided, node, "left").withColumn("template", grown).drop("segment", "general"))
        dropped(tree, children)
        tree = after
    return tree.select("host", "shape", "template", "n", "known", "bad")


def borrowed(placed: DataFrame, levels: int) -> DataFrame:
    """(host, template, branches, share) of templates without labels: the labelled branches of the nearest ancestor, and the sum of their shares of bad urls."""
    cut = placed.withColumn("parts", F.split("template", "/", levels + 1)).where(F.size("parts") > 1)
    each = cut.withColumn("depth", F.explode(F.sequence(F.lit(1), F.size("parts") - 1)))
    each = each.withColumn("parent", F.array_join(F.slice("parts", F.lit(1), F.col("depth")), "/"))
    # branches by the shape, not the template: those that were merged into one are still several witnesses
    branch = F.get(F.split("shape", "/", levels + 1), F.col("depth")).alias("branch")
    branches = each.where(F.col("known") > 0).groupBy("host", "parent", branch).agg(F.sum("known").alias("known"), F.sum("bad").alias("bad"))
    branches = branches.groupBy("host", "parent").agg(F.count(F.lit(1)).alias("branches"), F.sum(F.col("bad") / F.col("known")).alias("share"))
    wanting = each.groupBy("host", "template", "parent", "depth").agg(F.sum("known").alias("known")).where(F.col("known") == 0)
    nearest = wanting.join(branches, ["host", "parent"]).groupBy("host", "template").agg(F.max_by(F.struct("branches", "share"), "depth").alias("near"))
    return nearest.select("host", "template", "near.branches", "near.share")


def judged(pages: DataFrame, rules: tuple[tuple[str, str], ...] = RULES, weight: float = 2.0, carry: float = 0.1, prior: float = 0.25, reject: float = 0.7, id_col: str = "page_id", url_col: str = "url", **how) -> DataFrame:
    """Per page: page_id, host, path, rule, verdict (allow or block), template and purity."""
    host, path = host_and_path(F.col(url_col))
    urls = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    shape = F.array_join(F.transform(F.split("path", "/", -1), lambda s: F.when(s.rlike("[0-9]"), F.regexp_replace(s, "[0-9]+", "#")).otherwise(s)), "/")
    urls = urls.withColumn("rule", rule).withColumn("by_rule", verdict).withColumn("shape", shape)
    known = urls.select("host", "shape", F.col("by_rule").isNotNull().cast("long").alias("known"), F.coalesce((F.col("by_rule") == "block"), F.lit(False)).cast("long").alias("bad"))
    placed = templates(known, **how)
    nodes = placed.groupBy("host", "template").agg(*_sums()).join(borrowed(placed, how.get("levels", 4)), ["host", "template"], "left")
    own = weight + carry * (F.col("n") - F.col("known"))
    of_own, of_near = (F.col("bad") + own * prior) / (F.col("known") + own), (F.coalesce("share", F.lit(0)) + weight * prior) / (F.coalesce("branches", F.lit(0)) + weight)
    purity = nodes.select("host", "template", F.when(F.col("known") > 0, of_own).otherwise(of_near).alias("purity"))
    shapes = placed.select("host", "shape", "template").join(purity, ["host", "template"])
    out = urls.join(shapes, ["host", "shape"], "left")
    method = F.when(F.col("purity") >= reject, F.lit("block")).otherwise(F.lit("allow"))
    return out.select("page_id", "host", "path", "rule", F.coalesce("by_rule", method).alias("verdict"), "template", "purity")


def rule_sql(rules: tuple[tuple[str, str], ...] = RULES) -> str:
    """DuckDB SQL for host, path and rule of `pages`, and the rule's verdict."""
    cases = lambda value: " ".join(
        f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{s}{p}') THEN '{value(w, t)}'" for w, t in sorted(rules, key=lambda r: -len(r[1])) for h, s, p in [t.partition("/")]
    )
    return rf"""
WITH u AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) END AS rest FROM pages),
p AS (SELECT page_id, coalesce(translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
  coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM u)
SELECT page_id, host, path, CASE {cases(lambda w, t: t)} END AS rule, CASE {cases(lambda w, t: w)} END AS verdict FROM p
"""
