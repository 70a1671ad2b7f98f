"""URL filter: rules first, then gradient-boosted trees on lexical features. DataFrame functions only.

A rule names a host and the beginning of a path; it fits that host and its subdomains, and the
longest fitting rule decides. URLs that no rule decides are judged by boosted trees, which are
trained from labelled URLs on their length, depth, digit ratio, entropy, parameter counts and so on,
and on statistics of their host suffixes and first path segment (how many labelled URLs have it, and
how many of those are blocked, drawn towards the overall share). Labels of a URL's own host stay out of its
statistics, when it teaches and when it is judged: hosts are dealt into folds, and the other folds are counted.

Training: features are graded (rounded logarithms), cut into bins at exact quantiles, equal binned URLs
are folded into one counted row, and every level of a tree is one grouping of (node, feature, bin). Only such
histograms, bounded by nodes x features x bins, reach the driver. Gradients are added up as whole numbers, so
the trees do not depend on how rows are dealt out. Trees become nested conditions, so scoring is one
projection. All labelled rows count; nothing is sampled.

Edge cases: a null URL, or one without ``://``, has an empty host and path; features of a null URL are
those of an empty text. Without labelled URLs of both kinds all scores are the share of blocked ones,
or 0 (allow) without any.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.frames import column
from millrace.session import stage

BINS, FOLDS = 16, 5
#: Fixed point of gradients, and digits of a graded feature.
GRADIENT_UNIT, GRADE_DIGITS = 1 << 20, 3
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


@dataclass(frozen=True)
class Rule:
    """``host`` and the beginning of a path, such as ``Rule("example.com", "/en/", "block")``."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """What stands behind the first ``://``, up to a slash, question or number sign, in small letters."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), CAPITALS, CAPITALS.lower()), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_for(host: Column, path: Column, rules: list[Rule]) -> Column:
    """Name of the longest rule that fits, null if none does; of equal lengths the first in the list."""
    out = F.lit(None).cast("string")
    for rule in reversed(sorted(rules, key=lambda r: -len(r.name))):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        out = F.when(fits, rule.name).otherwise(out)
    return out


def _occurrences(text: Column, what: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(what), F.lit("")))


def _share(part: Column, whole: Column) -> Column:
    return part / F.greatest(whole, F.lit(1))


def lexical_features(url: Column) -> dict[str, Column]:
    url = F.coalesce(url, F.lit(""))
    size = F.length(url)
    host, path = host_of(url), path_of(url)
    query = F.regexp_extract(url, r"(?s)^[^?#]*\?([^#]*)", 1)
    letters = F.array_distinct(F.split(url, ""))
    shares = F.transform(F.filter(letters, lambda c: c != ""), lambda c: (size - F.length(F.replace(url, c, F.lit("")))) / size)
    entropy = F.aggregate(shares, F.lit(0.0), lambda total, p: total - p * F.log2(p))
    digits = size - F.length(F.regexp_replace(url, "[0-9]", ""))
    return {
        "size": size.cast("double"),
        "host_size": F.length(host).cast("double"),
        "path_size": F.length(path).cast("double"),
        "depth": _occurrences(path, "/").cast("double"),
        "labels": _occurrences(host, ".").cast("double"),
        "hyphens": _occurrences(host, "-").cast("double"),
        "digit_share": _share(digits, size),
        "host_digits": (F.length(host) - F.length(F.regexp_replace(host, "[0-9]", ""))).cast("double"),
        "capital_share": _share(size - F.length(F.translate(url, CAPITALS, "")), size),
        "entropy": F.coalesce(entropy, F.lit(0.0)),
        "parameters": F.when(F.length(query) > 0, _occurrences(query, "&") + 1).otherwise(0).cast("double"),
        "query_size": F.length(query).cast("double"),
        "escapes": _occurrences(url, "%").cast("double"),
        "fragment": url.contains("#").cast("double"),
        "secure": url.startswith("https://").cast("double"),
        "www": host.startswith("www.").cast("double"),
        "first_segment": F.length(F.regexp_extract(path, "^/([^/]*)", 1)).cast("double"),
        "last_segment": F.length(F.regexp_extract(path, "([^/]*)/?$", 1)).cast("double"),
        "extension": F.regexp_like(path, F.lit(r"\.[A-Za-z0-9]{1,5}$")).cast("double"),
    }


#: Parts of a URL of which statistics are kept: the last one and two labels of the host, the first segment of the path.
PARTS = ("suffix1", "suffix2", "segment")


def parts(url: Column) -> dict[str, Column]:
    url = F.coalesce(url, F.lit(""))
    host, path = host_of(url), path_of(url)
    found = (F.regexp_extract(host, r"([^.]*)$", 1), F.regexp_extract(host, r"([^.]*\.[^.]*)$", 1), F.regexp_extract(path, "^/([^/]*)", 1))
    return dict(zip(PARTS, found, strict=True))


@dataclass
class Tree:
    """Splits of each node and values of the leaves, numbered as in a heap from 1."""

    splits: dict[int, tuple[int, int]] = field(default_factory=dict)  # node: feature number, highest bin that goes left
    values: dict[int, float] = field(default_factory=dict)

    def _walk(self, bins: list[Column], node: int, leaf) -> Column:
        if node not in self.splits:
            return leaf(node)
        feature, highest = self.splits[node]
        return F.when(bins[feature] <= highest, self._walk(bins, 2 * node, leaf)).otherwise(self._walk(bins, 2 * node + 1, leaf))

    def node(self, bins: list[Column]) -> Column:
        return self._walk(bins, 1, F.lit)

    def value(self, bins: list[Column]) -> Column:
        return self._walk(bins, 1, lambda node: F.lit(self.values.get(node, 0.0)))


@dataclass
class UrlModel:
    names: list[str]
    cuts: list[list[float]]
    base: float
    trees: list[Tree]
    counts: dict[str, DataFrame]  # of each part: suffix, fold (null: all), n, blocked
    share: float


@dataclass(frozen=True)
class Boosting:
    trees: int = 12
    depth: int = 3
    rate: float = 0.3
    penalty: float = 1.0
    min_rows: float = 5.0
    suffix_weight: float = 20.0


def _graded(value: Column) -> Column:
    """A feature on a scale of some thousand values, in the order it had."""
    return F.round(F.log1p(value), GRADE_DIGITS)


def _fold(url: Column) -> Column:
    return F.pmod(F.xxhash64(host_of(url)), F.lit(FOLDS)).cast("int")


def _part_counts(rows: DataFrame, name: str) -> DataFrame:
    """How many labelled URLs have each part, and how many of them are blocked: all, and of each fold."""
    sums = [F.sum("n").alias("n"), F.sum("blocked").alias("blocked")]
    folds = rows.groupBy(F.col(name).alias("suffix"), "fold").agg(*sums)
    whole = folds.groupBy("suffix").agg(*sums).select("suffix", F.lit(None).cast("int").alias("fold"), "n", "blocked")
    return folds.union(whole)


def _with_features(df: DataFrame, model: UrlModel, settings: Boosting) -> DataFrame:
    """The frame with one column per feature, from its column ``link``."""
    link = F.col("link")
    wide = df.withColumns({**lexical_features(link), **{f"part_{n}": c for n, c in parts(link).items()}, "fold": _fold(link)})
    for name, counted in model.counts.items():
        keyed = counted.withColumnRenamed("suffix", f"part_{name}")
        wide = wide.join(keyed.where("fold is null").drop("fold").toDF(f"part_{name}", "all_n", "all_b"), f"part_{name}", "left")
        wide = wide.join(keyed.where("fold is not null").toDF(f"part_{name}", "fold", "own_n", "own_b"), [f"part_{name}", "fold"], "left")
        n, b = (F.coalesce(f"all_{c}", F.lit(0)) - F.coalesce(f"own_{c}", F.lit(0)) for c in "nb")
        drawn = (b + settings.suffix_weight * model.share) / (n + settings.suffix_weight)
        wide = wide.withColumns({f"{name}_count": n.cast("double"), f"{name}_blocked": drawn}).drop("all_n", "all_b", "own_n", "own_b")
    return wide.withColumns({n: _graded(F.col(n)) for n in model.names})


def _binned(names: list[str], cuts: list[list[float]]) -> Column:
    bins = []
    for name, edges in zip(names, cuts, strict=True):
        bins.append(sum(((F.col(name) > F.lit(e)).cast("int") for e in edges), F.lit(0)))
    return F.array(*bins)


def feature_names() -> list[str]:
    return [*lexical_features(F.lit("")), *(f"{s}_{k}" for s in PARTS for k in ("count", "blocked"))]


def _quantiles(wide: DataFrame, names: list[str]) -> list[list[float]]:
    """For each feature its values at each BINS-th part of the rows; graded features have few values to count."""
    values = wide.select(F.posexplode(F.array(*names)).alias("feature", "value")).groupBy("feature", "value").agg(F.count("*").alias("n"))
    along = Window.partitionBy("feature").orderBy("value")
    placed = values.withColumn("upto", F.sum("n").over(along)).withColumn("whole", F.sum("n").over(Window.partitionBy("feature")))
    steps = [F.floor(c * BINS / F.col("whole")) for c in (F.col("upto") - F.col("n"), F.col("upto"))]
    cuts = placed.where((steps[0] < steps[1]) & (F.col("upto") < F.col("whole"))).select("feature", "value").collect()
    return [sorted(r.value for r in cuts if r.feature == i) for i in range(len(names))]


def train(labelled: DataFrame, url: str, blocked: str, settings: Boosting = Boosting()) -> UrlModel:
    """Model from URLs and a boolean ``blocked``; rows in which either is null teach nothing."""
    rows = labelled.select(column(labelled, url).alias("link"), column(labelled, blocked).cast("int").alias("label")).where(
        "link is not null and label is not null")
    total = rows.agg(F.count("*").alias("n"), F.sum("label").alias("blocked")).first()
    share = (total.blocked or 0) / total.n if total.n else 0.0
    names = feature_names()
    if not 0 < share < 1:
        return UrlModel(names, [[] for _ in names], math.inf if share else -math.inf, [], {}, share)
    link = F.col("link")
    counted = rows.select(_fold(link).alias("fold"), "label", *[c.alias(n) for n, c in parts(link).items()]).groupBy("fold", *PARTS).agg(
        F.count("*").alias("n"), F.sum("label").alias("blocked"))
    counted = stage(counted, "url-parts")
    counts = {name: stage(_part_counts(counted, name), "url-parts") for name in PARTS}
    model = UrlModel(names, [], math.log(share / (1 - share)), [], counts, share)
    wide = stage(_with_features(rows, model, settings).select("label", *names), "url-features")
    model.cuts = _quantiles(wide, names)
    folded = wide.select("label", _binned(names, model.cuts).alias("bins")).groupBy("bins").agg(
        F.count("*").cast("double").alias("n"), F.sum("label").cast("double").alias("y"))
    data = stage(folded.withColumn("margin", F.lit(model.base)), "url-counts")
    for number in range(settings.trees):
        tree = _grown(data, len(names), settings)
        model.trees.append(tree)
        data = data.withColumn("margin", F.col("margin") + tree.value(_places(len(names))))
        if number % 3 == 2:
            data = stage(data, "url-counts")
    return model


def _places(features: int) -> list[Column]:
    return [F.get("bins", F.lit(i)) for i in range(features)]


def _grown(data: DataFrame, features: int, settings: Boosting) -> Tree:
    """A tree for the gradients of the logistic loss; a level costs one grouping."""
    p = 1 / (1 + F.exp(-F.col("margin")))
    whole = [F.round(v * GRADIENT_UNIT).cast("long").alias(n) for n, v in (("g", F.col("y") - F.col("n") * p), ("h", F.col("n") * p * (1 - p)))]
    graded = data.select("bins", *whole, "n")
    tree = Tree()
    active = {1}
    for _ in range(settings.depth):
        node = tree.node(_places(features))
        exploded = graded.select(node.alias("node"), "g", "h", "n", F.posexplode("bins").alias("feature", "bin"))
        sums = exploded.where(F.col("node").isin(list(active))).groupBy("node", "feature", "bin").agg(
            F.sum("g").alias("g"), F.sum("h").alias("h"), F.sum("n").alias("n")).collect()
        grown = set()
        for at in sorted(active):
            own = sorted((r.feature, r.bin, r.g / GRADIENT_UNIT, r.h / GRADIENT_UNIT, r.n) for r in sums if r.node == at)
            split = _best_split(own, settings)
            if split:
                tree.splits[at] = split[0]
                for child, (g, h) in zip((2 * at, 2 * at + 1), split[1], strict=True):
                    tree.values[child] = settings.rate * g / (h + settings.penalty)
                    grown.add(child)
        active = grown
        if not active:
            break
    return tree


def _best_split(rows: list[tuple], settings: Boosting):
    """Feature and highest bin to the left that gain most, with the sums of either side; None if nothing gains."""
    best, out = 1e-6, None
    for feature in sorted({r[0] for r in rows}):
        own = [r for r in rows if r[0] == feature]
        total = [sum(r[i] for r in own) for i in (2, 3, 4)]
        left = [0.0, 0.0, 0.0]
        for _, bin_, g, h, n in own[:-1]:
            left = [left[0] + g, left[1] + h, left[2] + n]
            right = [t - s for t, s in zip(total, left, strict=True)]
            if min(left[2], right[2]) < settings.min_rows:
                continue
            gain = round(sum(side[0] ** 2 / (side[1] + settings.penalty) for side in (left, right))
                         - total[0] ** 2 / (total[1] + settings.penalty), 9)
            if gain > best:
                best, out = gain, ((feature, bin_), (tuple(left[:2]), tuple(right[:2])))
    return out


RESULTS = ("host", "path", "rule", "score", "verdict")


def judge(df: DataFrame, url: str, rules: list[Rule], model: UrlModel, settings: Boosting = Boosting()) -> DataFrame:
    """The frame with host, path, rule, the trees' score (share blocked) and verdict; such columns are replaced."""
    gone = {r.lower() for r in RESULTS}
    kept = [c for c in df.columns if c.lower() not in gone]
    # All columns travel as one, so that none can clash with a name used here.
    rest = [F.struct(*[column(df, c) for c in kept]).alias("rest")] if kept else []
    base = df.select(*rest, column(df, url).alias("link"))
    own = ["rest"] if kept else []
    if model.trees:
        wide = _with_features(base, model, settings)
        base = wide.select(*own, "link", _binned(model.names, model.cuts).alias("bins"))
        margin = sum((t.value(_places(len(model.names))) for t in model.trees), F.lit(model.base))
        score = 1 / (1 + F.exp(-margin))
    else:
        score = F.lit(model.share)
    link = F.col("link")
    scored = base.select(*own, host_of(link).alias("host"), path_of(link).alias("path"), score.alias("score"))
    ruled = scored.withColumn("rule", rule_for(F.col("host"), F.col("path"), rules))
    verdict = F.when(F.col("score") >= 0.5, "block").otherwise("allow")
    for r in rules:
        verdict = F.when(F.col("rule") == r.name, r.verdict).otherwise(verdict)
    ruled = ruled.withColumn("verdict", verdict)
    return ruled.select(*[F.col("rest")[c].alias(c) for c in kept], *RESULTS)


def labelled_by_rules(df: DataFrame, url: str, rules: list[Rule]) -> DataFrame:
    """``url`` and ``blocked`` of the URLs that a rule decides: training data where there are no other labels."""
    link = column(df, url)
    rule = rule_for(host_of(link), path_of(link), rules)
    blocked = F.lit(None).cast("boolean")
    for r in rules:
        blocked = F.when(rule == r.name, F.lit(r.verdict == "block")).otherwise(blocked)
    return df.select(link.alias("url"), blocked.alias("blocked")).where("blocked is not null")
