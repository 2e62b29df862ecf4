"""Recommendation features, rankings and models; graph walks; corpus text."""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce
from itertools import combinations

import numpy as np
from pyspark.ml import Pipeline
from pyspark.ml.feature import IDF, CountVectorizer, FeatureHasher, HashingTF, QuantileDiscretizer, RegexTokenizer, VectorAssembler
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import FMRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from edutide.sources.shared import stored


def binned(df: DataFrame, features: dict[str, int]) -> DataFrame:
    """Each feature's quantile bin, all of them in one pass over the frame."""
    cols = list(features)
    d = QuantileDiscretizer(inputCols=cols, outputCols=[f"{c}_bin" for c in cols], numBucketsArray=list(features.values()), handleInvalid="keep", relativeError=0.001)
    return d.fit(df).transform(df)


def one_hot_words(df: DataFrame, column: str) -> DataFrame:
    """M2: the words of a column as a binary vector."""
    return Pipeline(stages=[RegexTokenizer(inputCol=column, outputCol="_words", pattern=r"\W+"), CountVectorizer(inputCol="_words", outputCol=f"{column}_vec", binary=True)]).fit(df).transform(df).drop("_words")


def ranked(df: DataFrame, key: str | list[str], by: list[Column], limit: int) -> DataFrame:
    """The first rows of each key by several features in turn."""
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(key).orderBy(*by))).where(F.col("rank") <= limit)


def ranked_others(df: DataFrame, asked: DataFrame, name: str, key: str, groups: list[str], by: list[Column], limit: int) -> DataFrame:
    """M4: for each asked row, a key as `name` and its groups, the first rows of its groups but itself. Rows stand in one order
    for all who ask, so a group's first 2 * limit are enough, where a key has at most `limit` of them."""
    first = ranked(df.where(F.col(key).isNotNull()), [key, *groups], by, limit)
    w = Window.partitionBy(*groups).orderBy(*by)
    first = first.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= 2 * limit).drop("rank")
    return ranked(first.join(asked, groups).where(F.col(key) != F.col(name)), name, by, limit)


def with_surprise(df: DataFrame, key: str, by: list[Column], limit: int, surprise: int, depth: int) -> DataFrame:
    """The best limit - surprise rows, and `surprise` ones from a deeper place in the ranking."""
    rank = F.row_number().over(Window.partitionBy(key).orderBy(*by))
    best = limit - surprise
    out = df.withColumn("rank", rank).where((F.col("rank") <= best) | ((F.col("rank") > depth) & (F.col("rank") <= depth + surprise)))
    return out.withColumn("surprise", F.col("rank") > best)


def filtered(df: DataFrame, languages: list[str], blacklist: DataFrame, key: str) -> DataFrame:
    """Rows of some languages that aren't on the blacklist."""
    return df.where(F.col("lang").isin(languages)).join(blacklist, key, "left_anti")


def affinity(edges: DataFrame, top: int) -> DataFrame:
    """Of author-thing edges: support, confidence and lift of the things that go with an author's things, the
    best `top` by summed lift. Lift of (x, y) over authors; pairs are counted from distinct edges."""
    e = edges.distinct()
    authors = e.select("author").distinct().count()
    n = e.groupBy("thing").agg(F.count("*").alias("n"))
    pairs = e.select("author", F.col("thing").alias("x")).join(e.select("author", F.col("thing").alias("y")), "author").where("x != y").groupBy("x", "y").agg(F.count("*").alias("both"))
    rules = pairs.join(n.toDF("x", "nx"), "x").join(n.toDF("y", "ny"), "y").select("x", "y", "both", (F.col("both") / F.col("nx")).alias("confidence"), (F.col("both") * authors / (F.col("nx") * F.col("ny"))).alias("lift"))
    new = e.select("author", F.col("thing").alias("x")).join(rules, "x").join(e.select("author", F.col("thing").alias("y")), ["author", "y"], "left_anti")
    scored = new.groupBy("author", F.col("y").alias("thing")).agg(F.round(F.sum("lift"), 6).alias("lift"))
    return ranked(scored, "author", [F.desc("lift"), F.col("thing")], top)


def facet_lift(edges: DataFrame) -> DataFrame:
    """Of author-thing rows, repeated ones counted: the lift of each thing for each author."""
    both = edges.groupBy("author", "thing").agg(F.count("*").alias("n"))
    authors, things = both.groupBy("author").agg(F.sum("n").alias("na")), both.groupBy("thing").agg(F.sum("n").alias("nt"))
    total = both.agg(F.sum("n").alias("total"))  # one row
    rows = both.join(authors, "author").join(things, "thing").join(F.broadcast(total))
    return rows.select("author", "thing", F.round(F.col("n") * F.col("total") / (F.col("na") * F.col("nt")), 6).alias("lift"))


def combined_facets(facets: dict[str, DataFrame], first: int) -> DataFrame:
    """Each author's first things of every facet by lift, in all combinations (at most first^facets an author), with the sum
    of their lifts and a rank by it."""
    out = None
    for name, f in facets.items():
        best = ranked(f, "author", [F.desc("lift"), F.col("thing")], first).select("author", F.col("thing").alias(name), F.col("lift").alias(f"_{name}"))
        out = best if out is None else out.join(best, "author")
    lift = sum((F.col(f"_{name}") for name in facets), F.lit(0.0))
    out = out.select("author", *facets, F.round(lift, 6).alias("lift"))
    return out.withColumn("rank", F.row_number().over(Window.partitionBy("author").orderBy(F.desc("lift"), *facets)))


def training_frame(df: DataFrame, numeric: list[str], texts: list[str], target: Column) -> DataFrame:
    """M5: features and label (log1p of the target) of each row; hashing needs no pass for a vocabulary."""
    return FeatureHasher(inputCols=[*numeric, *texts], outputCol="features", numFeatures=256).transform(df.withColumn("label", F.log1p(target)))


def split(df: DataFrame, key: str, share: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """Training and test rows by a hash of the key: the same at every run, with no shuffle."""
    at = F.pmod(F.xxhash64(key, F.lit("split")), F.lit(1000)) < int(share * 1000)
    return df.where(at), df.where(~at)


@dataclass
class Factorization:
    """A factorisation machine's weights, a line of factors for each feature; the mean of the labels it was trained on."""

    intercept: float
    linear: list[float]
    factors: list[list[float]]
    mean: float


def factorization(train: DataFrame, features: list[str], label: str = "label", factors: int = 4, steps: int = 60, step: float = 0.3, seed: int = 7, tolerance: float = 1e-6) -> Factorization:
    """M6: what FMRegressor finds by full-batch AdamW steps on the squared error, in one pass over the rows. The intercept starts at 0 and
    moves by about `step` at most in each of `steps`, so their product has to reach the label's mean.

    A machine's value is linear in the products of no, one or two different features, so that the error's gradient at any weights
    follows from the sums of these products' products: steps are taken on those sums, which are as many whatever the rows.
    """
    n = len(features)
    pairs = list(combinations(range(n), 2))
    terms = [(), *[(i,) for i in range(n)], *pairs]
    product = lambda t: reduce(lambda a, i: a * F.col(features[i]), t, F.lit(1.0))
    squares = {tuple(sorted(a + b)) for a in terms for b in terms}
    names = {t: f"s{i}" for i, t in enumerate(sorted(squares))}
    sums = [F.sum(product(t)).alias(c) for t, c in names.items()] + [F.sum(product(t) * F.col(label)).alias(f"y{i}") for i, t in enumerate(terms)]
    found = train.agg(F.count("*").alias("rows"), F.count(label).alias("labels"), *sums).first()
    rows = found["rows"]
    if not rows or found["labels"] != rows or not all(v is not None and math.isfinite(v) for v in found):
        raise ValueError("rows to train on have to be there, with finite features and labels")
    a = np.array([[found[names[tuple(sorted(x + y))]] for y in terms] for x in terms]) / rows
    b = np.array([found[f"y{i}"] for i in range(len(terms))]) / rows

    one = train.sparkSession.createDataFrame([(Vectors.dense([0.0] * n), 0.0)], ["features", "label"])
    start = FMRegressor(factorSize=factors, maxIter=0, seed=seed).fit(one)  # no step: the weights that it starts from
    weights = np.concatenate([start.factors.toArray().ravel(), start.linear.toArray(), [start.intercept]])
    parts = lambda w: (w[: n * factors].reshape(n, factors), w[n * factors : -1], w[-1])

    def gradient(w: np.ndarray) -> np.ndarray:
        v, linear, intercept = parts(w)
        g = 2 * (a @ np.array([intercept, *linear, *[v[i] @ v[j] for i, j in pairs]]) - b)
        of = np.zeros((n, n))
        for (i, j), x in zip(pairs, g[1 + n :]):
            of[i, j] = of[j, i] = x
        return np.concatenate([(of @ v).ravel(), g[1 : 1 + n], g[:1]])

    first, second = np.zeros(len(weights)), np.zeros(len(weights))
    for t in range(1, steps + 1):
        g, before = gradient(weights), weights
        first, second = 0.9 * first + 0.1 * g, 0.999 * second + 0.001 * g * g
        weights = weights - step * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-8)
        if t > 1 and np.linalg.norm(before - weights) < tolerance * max(np.linalg.norm(weights), 1.0):
            break
    v, linear, intercept = parts(weights)
    return Factorization(float(intercept), linear.tolist(), v.tolist(), float(b[0]))


def fm_score(features: list[Column], intercept: float, linear: list[float], factors: list[list[float]]) -> Column:
    """M7: w0 + <w, x> + 0.5 * sum over factors of (xV)^2 - x^2 V^2, of columns, from exported weights."""
    dot = lambda w: sum((x * float(v) for x, v in zip(features, w)), F.lit(0.0))
    square = lambda w: sum((x * x * float(v) * float(v) for x, v in zip(features, w)), F.lit(0.0))
    out = F.lit(float(intercept)) + dot(linear)
    for column in zip(*factors):
        out = out + 0.5 * (dot(column) * dot(column) - square(column))
    return out


def scaled(df: DataFrame, columns: list[str]) -> DataFrame:
    """Columns less their mean, by their standard deviation; rows that have no number in one of them are left out, and a column
    of one value is 0. df is read twice."""
    df = df.where(reduce(lambda a, c: a & F.col(c).isNotNull() & ~F.isnan(c), columns, F.lit(True)))
    found = df.agg(*[f(c).alias(f"{name}{i}") for i, c in enumerate(columns) for name, f in (("mean", F.avg), ("deviation", F.stddev_samp))]).first()
    by = {c: (found[f"mean{i}"] or 0.0, found[f"deviation{i}"] or 0.0) for i, c in enumerate(columns)}
    return df.withColumns({c: (F.col(c) - mean) * (1.0 / deviation if deviation else 0.0) for c, (mean, deviation) in by.items()})


def mean_rows(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """M8."""
    return df.groupBy(key).agg(*[F.avg(c).alias(c) for c in columns])


def regressions(train: DataFrame, test: DataFrame) -> DataFrame:
    """M9: RMSE and r2 on test rows of a linear model and a forest."""
    from pyspark.ml.evaluation import RegressionEvaluator

    models = {"linear": LinearRegression(regParam=0.1), "forest": RandomForestRegressor(numTrees=10, maxDepth=5, seed=7)}
    rows = []
    for name, m in models.items():
        scored = m.fit(train).transform(test)
        rows.append((name, *[RegressionEvaluator(metricName=k).evaluate(scored) for k in ("rmse", "r2")]))
    return train.sparkSession.createDataFrame(rows, "model string, rmse double, r2 double")


def similar_by_distance(edges: DataFrame, sources: DataFrame, cap: int = 6) -> DataFrame:
    """Source, node, d, similarity 1 - d / m, where a distance of `cap` steps or more, or none, counts as cap, and m is the one
    greatest distance of all pairs. d is found by a frontier join a step. edges: u, v both ways, over all nodes; sources: u.

    Pairs that count as cap have similarity 0 and are not listed, so that what comes out grows with the nodes that are near. Only
    where no pair is as far as that is m smaller, and then all pairs are listed.
    """
    nodes = edges.select("u").union(edges.select("v")).distinct().count()
    seen = frontier = sources.distinct().select(F.col("u").alias("source"), F.col("u").alias("node"), F.lit(0).alias("d"))
    for d in range(1, cap):
        nxt = frontier.join(edges, frontier["node"] == edges["u"]).select("source", F.col("v").alias("node")).distinct()
        frontier = stored(nxt.join(seen, ["source", "node"], "left_anti").withColumn("d", F.lit(d)), "frontier")
        seen = seen.unionByName(frontier)
    found = seen.agg(F.count("*").alias("pairs"), F.max("d").alias("most")).first()
    most = cap if found["pairs"] < nodes * sources.distinct().count() else max(found["most"] or 0, 1)
    return seen.withColumn("similarity", 1 - F.col("d") / F.lit(most))


def relevance(concepts: list[str], similar: DataFrame, learners: DataFrame, weights: tuple[float, float, float, float] = (0.33, 0.33, 0.33, 1.0), rounds: int = 5) -> DataFrame:
    """Learner, concept, relevance after `rounds` steps over a weighted sum of four row-normalised matrices of concepts, from equal
    relevance. similar: i, j, w; learners: learner, concept, proficiency, time (either may be null; concepts without a row, too).

    Similarity: w, 0.001 where there is none. Proficiency: how far i is above j, 0.0001 where it is not. Time spent and boosted time
    (1 where there is a proficiency above 0, else 0.01) have the same rows throughout: as relevance sums to 1, a step adds their
    one row, so they stay vectors. Time 1/n where a learner has none in a concept. A learner's matrix never leaves its row:
    there are as many concepts as a curriculum has, and the similarity matrix comes as one constant.
    """
    n, at = len(concepts), {c: i for i, c in enumerate(concepts)}
    total = sum(weights)
    by_similarity, by_proficiency, by_time, by_boost = (w / total for w in weights)
    sim = [[0.001] * n for _ in range(n)]
    for r in similar.where(F.col("i").isin(concepts) & F.col("j").isin(concepts)).collect():  # concepts squared at most
        sim[at[r["i"]]][at[r["j"]]] = float(r["w"])
    constant = F.array(*[F.array(*[F.lit(by_similarity * w / sum(row)) for w in row]) for row in sim])
    zero = F.lit(0.0)
    mine = lambda c, default: F.array(*[F.coalesce(F.try_element_at(c, F.lit(x)), F.lit(default)) for x in concepts])
    maps = learners.where(F.col("concept").isin(concepts)).groupBy("learner").agg(
        F.map_from_entries(F.collect_list(F.when(F.col("proficiency").isNotNull(), F.struct("concept", F.col("proficiency").cast("double"))))).alias("p"),
        F.map_from_entries(F.collect_list(F.when(F.col("time").isNotNull(), F.struct("concept", F.col("time").cast("double"))))).alias("t"),
    )
    rows = maps.select("learner", mine(F.col("p"), 0.0).alias("p"), F.transform(mine(F.col("p"), -1.0), lambda x: F.when(x > 0, 1.0).otherwise(0.01)).alias("b"), mine(F.col("t"), 1.0 / n).alias("t"))
    summed = lambda c: F.aggregate(c, zero, lambda a, x: a + x)
    above = F.transform("p", lambda x: F.transform("p", lambda y: F.when(x - y > 0, x - y).otherwise(0.0001)))
    rows = rows.withColumn("m", F.transform(above, lambda row: F.transform(row, lambda x: x * by_proficiency / summed(row))))
    rows = rows.withColumn("m", F.zip_with("m", constant, lambda a, b: F.zip_with(a, b, lambda x, y: x + y)))
    fixed = F.zip_with(F.transform("t", lambda x: x * by_time / summed(F.col("t"))), F.transform("b", lambda x: x * by_boost / summed(F.col("b"))), lambda x, y: x + y)
    rows = rows.select("learner", "m", fixed.alias("v"), F.array(*[F.lit(1.0 / n)] * n).alias("r"))
    for _ in range(rounds):
        moved = F.aggregate(F.zip_with("r", "m", lambda x, row: F.transform(row, lambda w: x * w)), F.array(*[zero] * n), lambda a, row: F.zip_with(a, row, lambda x, y: x + y))
        rows = rows.select("learner", "m", "v", F.zip_with(moved, F.col("v"), lambda x, y: x + y).alias("r"))
    return rows.select("learner", F.posexplode("r").alias("_i", "relevance")).select("learner", F.element_at(F.array(*[F.lit(c) for c in concepts]), F.col("_i") + 1).alias("concept"), "relevance")


def grade_coverage(rows: DataFrame, edges: DataFrame, grades: list[int]) -> DataFrame:
    """Content counts per concept and grade; a concept without any takes its parent's. rows: concept, grade; edges: concept, parent."""
    own = rows.groupBy("concept").pivot("grade", grades).count().na.fill(0)
    named = [str(g) for g in grades]
    parents = own.select(F.col("concept").alias("parent"), *[F.col(g).alias(f"p_{g}") for g in named])
    out = edges.join(own, "concept", "left").join(parents, "parent", "left")
    missing = F.col(named[0]).isNull()
    return out.select("concept", *[F.coalesce(F.when(missing, F.col(f"p_{g}")).otherwise(F.col(g)), F.lit(0)).alias(f"grade_{g}") for g in named])


def assigned(profiles: DataFrame, definitions: DataFrame, matches: Column) -> DataFrame:
    """Experiments whose conditions a profile meets; definitions are few and hashed into the plan by a broadcast."""
    return profiles.join(F.broadcast(definitions), matches)


#: Words that say little, as the corpus steps leave them out.
STOP_WORDS = ["a", "an", "and", "are", "as", "at", "be", "by", "for", "from", "in", "is", "it", "of", "on", "or", "that", "the", "to", "was", "what", "with"]


def words(text: Column) -> Column:
    """ASCII text: non-letters to space, stop words (as they are written) and single letters out, lower case; other text:
    split at spaces. Words are split at what is no letter, which is a single pass with the same words."""
    parts = F.filter(F.split(text, "[^A-Za-z]+"), lambda w: (F.length(w) > 1) & ~w.isin(STOP_WORDS))
    plain = F.filter(F.split(text, " "), lambda w: w != "")
    return F.when(text.rlike(r"^[\x00-\x7F]*$"), F.transform(parts, F.lower)).otherwise(plain)


def tags(text: Column) -> Column:
    """Comma-separated tags: no white space, lower case, each once."""
    return F.array_distinct(F.transform(F.split(text, ","), lambda t: F.lower(F.regexp_replace(t, r"\s", ""))))


def term_vectors(df: DataFrame, text: str, size: int = 4096) -> DataFrame:
    """TF-IDF vectors by hashing."""
    rows = df.withColumn("_w", words(F.col(text)))
    tf = HashingTF(inputCol="_w", outputCol="_tf", numFeatures=size).transform(rows)
    return IDF(inputCol="_tf", outputCol="vector").fit(tf).transform(tf).drop("_w", "_tf")


def assembled(df: DataFrame, columns: list[str]) -> DataFrame:
    return VectorAssembler(inputCols=columns, outputCol="features", handleInvalid="skip").transform(df)


def normalised(v: Column) -> Column:
    """A vector at length 1; a zero vector as it is. The vector and its length are bound by lambdas: named inside one, they
    would be found again for each component."""
    length = lambda v: F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x.cast("double") * x))
    unit = lambda v, n: F.when(n == 0, F.transform(v, lambda x: x.cast("double"))).otherwise(F.transform(v, lambda x: x.cast("double") / n))
    return _let(v, lambda v: _let(length(v), lambda n: unit(v, n)))


def _let(value: Column, then) -> Column:
    """then(value), with value found once a row."""
    return F.element_at(F.transform(F.array(value), then), 1)


def dense_topics(found: Column, slots: int = 50) -> Column:
    """(topic, weight) pairs as an array with a place for each topic."""
    places = lambda m: F.transform(F.sequence(F.lit(0), F.lit(slots - 1)), lambda i: F.coalesce(F.try_element_at(m, i), F.lit(0.0)))
    return _let(F.map_from_entries(found), places)


def corpus(df: DataFrame, key: str, parts: list[str]) -> DataFrame:
    """One document per key and language: its parts, distinct and in order. Repeated parts go before any row of a key is
    collected, so that a key's document is bounded by its vocabulary."""
    each = df.select(key, "lang", F.explode(F.array(*parts)).alias("part")).where("part IS NOT NULL").distinct()
    return each.groupBy(key, "lang").agg(F.array_join(F.array_sort(F.collect_list("part")), " ").alias("document"))
