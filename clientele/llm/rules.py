"""Quality rules: robust multivariate outliers per language and source.

Counts of every text (words, symbols, repeated lines, repeated runs of words) become a small
vector of rates.  For each language and source, each language, and all rows, the
minimum-covariance-determinant estimate gives the centre and spread of the tighter three
quarters of the rows; a row far from its group's centre by Mahalanobis distance is rejected.

Everything is DataFrame expressions.  The estimate starts twice for each group, from mean
and covariance and from medians and quartiles, and takes concentration steps: distances,
the closest rows up to the quota, their mean and covariance.  A step never sorts or collects
a group: distances go to narrow logarithmic bins, each bin's sums are combined map-side, and
the bins are taken in order until the quota is full.  The start with the smaller determinant
is kept.

Defined results: a NULL or empty text has no words and fails the base rules.  NULL languages
and sources are groups of their own.  A group with fewer than ``least`` usable rows takes its
language's estimate, and that the overall one.  Repeated rows count as often as they come and
are judged alike.  An empty table gives no rows.  Input columns are kept under their names;
one that is called like a result is replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clientele.llm.common import keep

BLANKS = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 5

SMOOTH, WORD_LENGTH = 8, 5
QUOTA = 0.75
STEPS = 3
LEAST = 50
CUTOFF = 26.0  # squared distance; below 1 in 10,000 for four normal statistics
# The least spread of each statistic that counts as unusual, so that a statistic which is 0
# nearly everywhere does not make every other value an outlier.
FLOORS = (0.08, 0.06, 0.15, 0.1)
BINS_PER_OCTAVE = 8
_DIM = len(FLOORS)
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
RESULTS = (*COUNTS, "base_failed", "distance", "kept")


def text_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the counts of the whole text to every row."""
    whole = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(whole, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    words = F.filter(F.split(whole, BLANKS), lambda x: x != "")
    split = docs.withColumns({"_words": words, "_lines": lines})
    runs = F.transform(
        F.sequence(F.lit(1), F.size("_words") - (WINDOW - 1)),
        lambda i: F.struct(F.xxhash64(F.slice("_words", i, WINDOW)).alias("h"), i.alias("i")),
    )
    # Runs of words in the order of their hash: equal ones stand side by side.
    sorted_runs = split.withColumn(
        "_runs", F.when(F.size("_words") >= WINDOW, F.sort_array(runs)).otherwise(F.array().cast("array<struct<h:bigint,i:int>>"))
    )
    twice = F.filter(
        "_runs",
        lambda r, k: F.coalesce(F.get("_runs", k - 1)["h"] == r["h"], F.lit(False))
        | F.coalesce(F.get("_runs", k + 1)["h"] == r["h"], F.lit(False)),
    )
    starts = sorted_runs.withColumn("_starts", F.sort_array(F.transform(twice, lambda r: r["i"])))
    covered = F.transform(
        "_starts", lambda s, k: F.least(F.lit(WINDOW), F.coalesce(F.get("_starts", k + 1) - s, F.lit(WINDOW)))
    )
    return starts.withColumns(
        {
            "n_words": F.size("_words").cast("long"),
            "word_chars": F.length(F.translate(whole, " \t\n\x0b\x0c\r", "")).cast("long"),
            "n_symbols": (F.length(whole) - F.length(F.translate(whole, SYMBOLS, ""))).cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "n_repeat_words": F.aggregate(covered, F.lit(0).cast("long"), lambda a, x: a + x),
            "_n_lines": F.size("_lines").cast("long"),
        }
    ).drop("_words", "_lines", "_runs", "_starts")


def base_failed(least_words: int = 10, most_repeated: int = 20) -> Column:
    """Too few words, or too many of them in repeated runs."""
    return (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > most_repeated * F.col("n_words"))


def statistics() -> list[Column]:
    """Transformed rates: length of words, symbols, repeated lines, repeated runs of words.

    Rates are taken with SMOOTH more words of usual length, without anything unusual, so that
    the mean of a few words does not make a short text an outlier.
    """
    n = (F.col("n_words") + SMOOTH).cast("double")
    return [
        F.log((F.col("word_chars") + SMOOTH * WORD_LENGTH) / n),
        F.log1p(F.col("n_symbols") / n),
        F.col("n_dup_lines") / F.greatest(F.col("_n_lines"), F.lit(1)),
        F.col("n_repeat_words") / n,
    ]


def _consistency() -> float:
    """What the covariance of the closest QUOTA of normal rows is too small by.

    With four statistics squared distances have four degrees of freedom, and both
    distributions needed have closed forms.
    """
    low, high = 0.0, 100.0
    for _ in range(80):
        x = (low + high) / 2
        low, high = (x, high) if 1 - math.exp(-x / 2) * (1 + x / 2) < QUOTA else (low, x)
    return QUOTA / (1 - math.exp(-x / 2) * (1 + x / 2 + x * x / 8))


_PAIRS = [(i, j) for i in range(_DIM) for j in range(i + 1)]


def _sums() -> list[Column]:
    """Number, sums and sums of products of the statistics, for one aggregation."""
    return [
        F.count("*").alias("n"),
        *(F.sum(f"x{i}").alias(f"s{i}") for i in range(_DIM)),
        *(F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"p{i}{j}") for i, j in _PAIRS),
    ]


def _shape(sums: DataFrame, scale: float, keys: list[str]) -> DataFrame:
    """Mean and covariance from sums; the least spread is added to the diagonal."""
    n = F.col("n").cast("double")
    mean = [F.col(f"s{i}") / n for i in range(_DIM)]
    cov = {
        (i, j): scale * (F.col(f"p{i}{j}") / n - mean[i] * mean[j]) + (FLOORS[i] ** 2 if i == j else 0.0)
        for i, j in _PAIRS
    }
    return _factored(
        sums.select(
            *keys,
            *(mean[i].alias(f"m{i}") for i in range(_DIM)),
            *(c.alias(f"c{i}{j}") for (i, j), c in cov.items()),
        )
    )


def _factored(shapes: DataFrame) -> DataFrame:
    """Replace the covariance by its Cholesky factor; add the logarithm of its determinant."""
    out = shapes
    for i in range(_DIM):
        for j in range(i + 1):
            rest = F.col(f"c{i}{j}")
            for k in range(j):
                rest = rest - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            # Rounding may leave a tiny negative square; the floor keeps the factor proper.
            value = F.sqrt(F.greatest(rest, F.lit(FLOORS[i] ** 2 / 4))) if i == j else rest / F.col(f"l{j}{j}")
            out = out.withColumn(f"l{i}{j}", value)
    log_det = sum((F.log(f"l{i}{i}") for i in range(_DIM)), F.lit(0.0))
    return out.withColumn("log_det", log_det).drop(*(f"c{i}{j}" for i, j in _PAIRS))


def _distance() -> Column:
    """Squared Mahalanobis distance by forward substitution."""
    y: list[Column] = []
    for i in range(_DIM):
        rest = F.col(f"x{i}") - F.col(f"m{i}")
        for j in range(i):
            rest = rest - F.col(f"l{i}{j}") * y[j]
        y.append(rest / F.col(f"l{i}{i}"))
    return sum((v * v for v in y), F.lit(0.0))


def _levels(lang: Column, source: Column) -> Column:
    """The groups a row belongs to: overall, its language, its language and source."""
    named = lambda c: F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("-"))
    group = lambda level, a, b: F.struct(F.lit(level).alias("level"), a.alias("a"), b.alias("b"))
    return F.array(
        group(0, F.lit(""), F.lit("")), group(1, named(lang), F.lit("")), group(2, named(lang), named(source))
    )


def _first_shapes(grouped: DataFrame) -> DataFrame:
    """Two starts per group: mean and covariance; medians and quartile distances."""
    keys = ["level", "a", "b"]
    classic = _shape(grouped.groupBy(*keys).agg(*_sums()), 1.0, keys).withColumn("start", F.lit(0))
    step = 128.0
    cells = (
        grouped.select(*keys, F.posexplode(F.array(*(F.col(f"x{i}") for i in range(_DIM)))).alias("dim", "x"))
        .groupBy(*keys, "dim", F.floor(F.col("x") * step).alias("cell"))
        .agg(F.count("*").alias("n"))
    )
    # One row per cell of a statistic that is bounded, so windows stay short.
    whole = Window.partitionBy(*keys, "dim")
    upto = whole.orderBy("cell")
    share = cells.withColumn("share", F.sum("n").over(upto) / F.sum("n").over(whole))
    at = lambda q: F.min(F.when(F.col("share") >= q, (F.col("cell") + 0.5) / step))
    middle = (
        share.groupBy(*keys, "dim")
        .agg(at(0.5).alias("mid"), ((at(0.75) - at(0.25)) / 1.349).alias("wide"))
        .groupBy(*keys)
        .agg(
            *(F.max(F.when(F.col("dim") == i, F.col("mid"))).alias(f"m{i}") for i in range(_DIM)),
            *(
                (F.max(F.when(F.col("dim") == i, F.col("wide") * F.col("wide"))) + FLOORS[i] ** 2).alias(f"c{i}{i}")
                for i in range(_DIM)
            ),
        )
    )
    apart = {f"c{i}{j}": F.lit(0.0) for i, j in _PAIRS if i != j}
    robust = _factored(middle.withColumns(apart)).withColumn("start", F.lit(1))
    return classic.unionByName(robust)


def _concentrate(grouped: DataFrame, shapes: DataFrame) -> DataFrame:
    """One step for all groups and starts: the closest QUOTA of the rows make the next shape."""
    keys = ["start", "level", "a", "b"]
    far = F.floor(F.log2(F.greatest(F.col("d2"), F.lit(1e-6))) * BINS_PER_OCTAVE).cast("int")
    bins = (
        grouped.join(shapes, ["level", "a", "b"])
        .withColumn("d2", _distance())
        .groupBy(*keys, far.alias("bin"))
        .agg(*_sums())
    )
    whole = Window.partitionBy(*keys)
    nearer = whole.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    taken = bins.withColumn("nearer", F.coalesce(F.sum("n").over(nearer), F.lit(0))).withColumn(
        "all", F.sum("n").over(whole)
    ).filter(F.col("nearer") < F.lit(QUOTA) * F.col("all"))
    names = ["n", *(f"s{i}" for i in range(_DIM)), *(f"p{i}{j}" for i, j in _PAIRS)]
    sums = taken.groupBy(*keys).agg(*(F.sum(c).alias(c) for c in names))
    return _shape(sums, _consistency(), keys)


def fit(stats: DataFrame, lang: str = "lang", source: str = "source", least: int = LEAST) -> DataFrame:
    """Shapes per group (level, a, b): mean, Cholesky factor; groups with ``least`` rows or more.

    ``stats`` has the statistics as x0, x1, ... and is read several times: hand in a written
    table.  The result has one row per language and source at most.
    """
    grouped = stats.select(
        F.inline(_levels(F.col(lang), F.col(source))), *(f"x{i}" for i in range(_DIM))
    )
    shapes = keep(_first_shapes(grouped), "shapes")
    for _ in range(STEPS):
        shapes = keep(_concentrate(grouped, shapes), "shapes")
    best = Window.partitionBy("level", "a", "b").orderBy("log_det", "start")
    sizes = grouped.groupBy("level", "a", "b").agg(F.count("*").alias("rows"))
    return (
        shapes.withColumn("_best", F.row_number().over(best))
        .filter("_best = 1")
        .drop("_best", "start", "log_det")
        .join(sizes.filter((F.col("rows") >= least) | (F.col("level") == 0)), ["level", "a", "b"])
    )


def judge(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """Every row with its counts, ``base_failed``, ``distance`` and ``kept``."""
    others = [c for c in docs.columns if c not in (text, *RESULTS)]
    slim = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in others)).alias("_row"),
        F.col(text).alias("text"),
        F.col(lang).alias("lang"),
        F.col(source).alias("source"),
    )
    counted = text_counts(slim).withColumn("base_failed", base_failed())
    stats = keep(
        counted.withColumns({f"x{i}": s for i, s in enumerate(statistics())}).drop("text", "_n_lines"), "statistics"
    )
    shapes = keep(fit(stats.filter(~F.col("base_failed"))), "shapes")
    # The nearest level with an estimate, found among groups and not among rows.
    values = [c for c in shapes.columns if c not in ("level", "a", "b", "rows")]
    groups = stats.select(_levels(F.col("lang"), F.col("source")).alias("levels")).distinct()
    nearest = (
        groups.select("levels", F.inline("levels"))
        .join(shapes, ["level", "a", "b"])
        .groupBy("levels")
        .agg(F.max_by(F.struct(*values), "level").alias("_shape"))
        .select(F.element_at("levels", 3)["a"].alias("_a"), F.element_at("levels", 3)["b"].alias("_b"), "_shape")
    )
    near = keep(nearest, "nearest")
    own = F.element_at(_levels(F.col("lang"), F.col("source")), 3)
    placed = (
        stats.withColumns({"_a": own["a"], "_b": own["b"]})
        .join(near, ["_a", "_b"], "left")
        .select(*stats.columns, *(F.col(f"_shape.{v}").alias(v) for v in values))
        .withColumn("distance", _distance())
    )
    judged = placed.withColumn("kept", ~F.col("base_failed") & F.coalesce(F.col("distance") <= CUTOFF, F.lit(True)))
    return judged.select(*(F.col("_row").getField(c).alias(c) for c in others), *RESULTS)
