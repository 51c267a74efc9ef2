"""Quality classifier by hierarchical empirical Bayes.

A logistic regression on counts of characters and words, and on words that tell good from bad
texts apart, gives each document's evidence: how much its text moves the odds of being good.
Each site (a host, and a path below it) gives the prior odds.  Site rates come from all
labelled documents by grouped aggregation; a path with few labels is shrunk towards its
host, a host towards the overall rate, by a strength estimated from how much hosts, and
paths within hosts, differ beyond chance.  The posterior multiplies both odds.

The regression alone is fitted on a sample: the SAMPLE first labelled ids by their hash.  All
words of the sample that tell enough by a likelihood ratio are used, however many; texts hold
few of them, so they are kept as lists of numbers.
Counts of sites use all labels, and all documents are scored by their whole text.

Defined results: a NULL or empty text gives the evidence of a text without words.  NULL hosts
and paths are sites of their own.  Several labels of one document all count; NULL labels do
not.  Without labels of both kinds there is no evidence, and without any the prior is even.
Repeated rows are scored alike.  Other columns are kept; one that is called like a result is
replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientele.llm.common import keep, small_batches

SAMPLE = 6_000  # labelled documents the regression is fitted on
CUE_Z = 4.0  # signed root of the likelihood ratio from which a word tells good from bad
RIDGE = 1.0
THRESHOLD = 0.5
LEAST_STRENGTH, MOST_STRENGTH = 4.0, 1_000.0
RESULTS = ("evidence", "host_rate", "path_rate", "score", "kept")

# Kinds of bytes: small letter, capital, digit, blank, newline, ! and ?, other punctuation of
# prose, symbols; bytes of non-ASCII characters count as small letters.
_KINDS = 8
_KIND = np.full(256, 7, np.uint8)
_KIND[97:123] = _KIND[128:] = 0
_KIND[65:91] = 1
_KIND[48:58] = 2
_KIND[[9, 11, 12, 13, 32]] = 3
_KIND[10] = 4
_KIND[[ord(c) for c in "!?"]] = 5
_KIND[[ord(c) for c in ".,;:'\"()-"]] = 6
_WORD = re.compile(r"[^\W\d_]+")


def features(texts, cues: dict[str, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rates of kinds of characters and of words, one row per text; and the cues texts hold, as
    numbers of texts and of cues side by side."""
    out = np.zeros((len(texts), _KINDS + 4), np.float32)
    held: list[list[int]] = []
    for row, text in zip(out, texts, strict=True):
        text = text if isinstance(text, str) else ""
        kinds = np.bincount(_KIND[np.frombuffer(text.encode(), np.uint8)], minlength=_KINDS)
        chars = max(1, int(kinds.sum()))
        letters = max(1, int(kinds[0] + kinds[1]))
        row[:_KINDS] = np.sqrt(kinds / chars)
        row[1] = kinds[1] / letters
        words = _WORD.findall(text.lower())
        different = set(words)
        lines = text.split("\n")
        row[_KINDS:] = (
            np.log1p(len(words)),
            letters / max(1, len(words)) / 10,
            len(different) / max(1, len(words)),
            1 - len(set(lines)) / len(lines),
        )
        held.append(sorted(cues[w] for w in different if w in cues))
    at = np.repeat(np.arange(len(held)), [len(h) for h in held])
    return out, at, np.array([c for h in held for c in h], np.int64)


@dataclass
class Model:
    cues: dict[str, int]
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    cue_weights: np.ndarray
    bias: float  # without the sample's own prior odds

    def evidence(self, texts) -> np.ndarray:
        rates, at, cue = features(texts, self.cues)
        held = np.bincount(at, self.cue_weights[cue], minlength=len(rates))
        return ((rates - self.mean) / self.scale).astype(float) @ self.weights + held + self.bias


def _solve(times, diagonal: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Conjugate gradients, the closer the nearer ``wanted`` is to 0."""
    found, rest = np.zeros(len(wanted)), wanted.copy()
    size = np.linalg.norm(wanted)
    enough = size * min(0.1, np.sqrt(size) / 100)
    along = rest / diagonal
    now = rest @ along
    for _ in range(10 * len(wanted)):
        if np.linalg.norm(rest) <= enough:
            break
        image = times(along)
        step = now / (along @ image)
        found += step * along
        rest -= step * image
        before, now = now, rest @ (rest / diagonal)
        along = rest / diagonal + now / before * along
    return found


def _logistic(
    x: np.ndarray, at: np.ndarray, cue: np.ndarray, n_cues: int, y: np.ndarray
) -> tuple[np.ndarray, np.ndarray, float]:
    """Ridge logistic regression by Newton's method on rates and standardized cues: weights of
    the rates, what holding each cue adds, and the rest."""
    n, d = x.shape
    share = np.bincount(cue, minlength=n_cues) / n
    scale = np.maximum(np.sqrt(share * (1 - share)), 1e-2)
    penalty = np.full(d + n_cues + 1, RIDGE)
    penalty[-1] = 1e-6

    def times(w: np.ndarray) -> np.ndarray:
        c = w[d:-1] / scale
        return x @ w[:d] + np.bincount(at, c[cue], minlength=n) - share @ c + w[-1]

    def back(r: np.ndarray) -> np.ndarray:
        return np.concatenate([x.T @ r, (np.bincount(cue, r[at], minlength=n_cues) - share * r.sum()) / scale, [r.sum()]])

    def loss(w: np.ndarray) -> float:
        v = times(w)
        return float(np.logaddexp(0, v).sum() - y @ v + penalty @ (w * w) / 2)

    w = np.zeros(len(penalty))
    best = loss(w)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(times(w), -30, 30)))
        s = p * (1 - p)
        inner = ((1 - 2 * share) * np.bincount(cue, s[at], minlength=n_cues) + share**2 * s.sum()) / scale**2
        diagonal = np.concatenate([(x * x).T @ s, inner, [s.sum()]]) + penalty
        step = _solve(lambda v, s=s: back(s * times(v)) + penalty * v, diagonal, back(y - p) - penalty * w)
        value = loss(w + step)
        while value > best and np.abs(step).max() > 1e-6:
            step = step / 2
            value = loss(w + step)
        w, best = w + step, value
        if np.abs(step).max() < 1e-6:
            break
    added = w[d:-1] / scale
    return w[:d], added, float(w[-1] - share @ added)


def fit(docs: DataFrame, labels: DataFrame, good: Column, doc_id: str = "doc_id", text: str = "text") -> Model | None:
    """Fit the document classifier on a sample of the labels; None without both kinds."""
    spark = docs.sparkSession
    small_batches(spark)
    sample = (
        labels.select(F.col(doc_id).cast("long").alias("id"), good.cast("int").alias("good"))
        .dropna()
        .orderBy(F.xxhash64("id"), "id", "good")
        .limit(SAMPLE)
    )
    # At most SAMPLE rows: a bounded table to broadcast, and as few texts to learn from.
    texts = (
        docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
        .join(F.broadcast(sample), "id")
        .limit(2 * SAMPLE)
    )
    texts = keep(texts, "sample")
    totals = texts.agg(F.coalesce(F.sum("good"), F.lit(0)).alias("good"), F.count("*").alias("n")).first()
    n_good, n_bad = totals["good"], totals["n"] - totals["good"]
    if not n_good or not n_bad:
        return None
    words = F.explode(F.array_distinct(F.split(F.lower("text"), r"[^\p{L}]+")))
    # Twice the log likelihood ratio of "as often in good as in bad texts".  Unlike log odds over
    # their standard error it does not shrink for a word that only one kind of text holds.
    part = lambda k, n, kind: F.when(k > 0, k * F.log(k * n_all / (n * kind))).otherwise(0.0)
    g, b, n_all = F.col("g"), F.col("b"), float(n_good + n_bad)
    ratio = 2 * (
        part(g, g + b, n_good)
        + part(b, g + b, n_bad)
        + part(n_good - g, n_all - g - b, n_good)
        + part(n_bad - b, n_all - g - b, n_bad)
    )
    cues = (
        texts.select("good", words.alias("word"))
        .filter("word <> ''")
        .groupBy("word")
        .agg(F.sum("good").alias("g"), F.sum(1 - F.col("good")).alias("b"))
        .filter(ratio >= CUE_Z**2)
        .select("word")
        .orderBy("word")
    )
    # Words of at most SAMPLE texts.
    cue_no = {r["word"]: k for k, r in enumerate(cues.collect())}

    def measured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x, at, cue = features(batch["text"], cue_no)
            held = np.split(cue.astype(np.int32), np.cumsum(np.bincount(at, minlength=len(x)))[:-1])
            yield pd.DataFrame(
                {"id": batch["id"], "good": batch["good"], "x": [r.tobytes() for r in x], "held": [h.tobytes() for h in held]}
            )

    schema = "id long, good int, x binary, held binary"
    rows = texts.select("id", "good", "text").mapInPandas(measured, schema).toPandas()
    rows = rows.sort_values(["id", "good", "x", "held"], kind="stable")
    x = np.frombuffer(b"".join(rows["x"]), np.float32).reshape(len(rows), -1)
    cue = np.frombuffer(b"".join(rows["held"]), np.int32).astype(np.int64)
    at = np.repeat(np.arange(len(rows)), [len(h) // 4 for h in rows["held"]])
    mean, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-2)
    standard = ((x - mean) / scale).astype(float)
    weights, cue_weights, bias = _logistic(standard, at, cue, len(cue_no), rows["good"].to_numpy(float))
    return Model(cue_no, mean, scale, weights, cue_weights, float(bias - np.log(n_good / n_bad)))


def _strength(groups: DataFrame, rate: Column) -> float:
    """How many labels the parent's rate is worth: large where groups differ only by chance.

    From the spread of the groups' rates around their parents' beyond the binomial one.
    """
    p = F.greatest(F.least(rate, F.lit(0.999)), F.lit(0.001))
    chance = p * (1 - p)
    row = groups.filter("n > 1").agg(
        F.sum(F.pow(F.col("k") / F.col("n") - p, 2) * F.col("n") - chance).alias("extra"),
        F.sum(chance * (F.col("n") - 1)).alias("scale"),
    ).first()
    if row["extra"] is None or row["extra"] <= 0:
        return MOST_STRENGTH
    # Variance between groups as a share of p (1 - p) is 1 / (strength + 1).
    return float(np.clip(row["scale"] / row["extra"] - 1, LEAST_STRENGTH, MOST_STRENGTH))


def _named(column: str) -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col(column).cast("string")), F.lit("-"))


def site_rates(
    docs: DataFrame, labels: DataFrame, good: Column, doc_id: str, host: str, path: str
) -> DataFrame:
    """Shrunken rates of good documents: _host, _path, host_rate, path_rate.

    One row per host and path with a label, and one with an empty path per host, and one with
    both empty for all the rest.
    """
    marked = labels.select(F.col(doc_id).cast("long").alias("_id"), good.cast("int").alias("_good")).dropna()
    sites = docs.select(F.col(doc_id).cast("long").alias("_id"), _named(host).alias("_host"), _named(path).alias("_path"))
    paths = keep(
        sites.join(marked, "_id").groupBy("_host", "_path").agg(F.count("*").alias("n"), F.sum("_good").alias("k")),
        "paths",
    )
    hosts = paths.groupBy("_host").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    total = hosts.agg(F.sum("n").alias("n"), F.sum("k").alias("k")).first()
    overall = (total["k"] + 0.5) / (total["n"] + 1.0) if total["n"] else 0.5
    of_hosts = _strength(hosts, F.lit(overall))
    shrunk = lambda rate, m: (F.col("k") + m * rate) / (F.col("n") + m)
    hosts = keep(hosts.select("_host", shrunk(F.lit(overall), of_hosts).alias("host_rate")), "hosts")
    nested = paths.join(hosts, "_host")
    of_paths = _strength(nested, F.col("host_rate"))
    below = nested.select("_host", "_path", "host_rate", shrunk(F.col("host_rate"), of_paths).alias("path_rate"))
    only_host = hosts.select("_host", F.lit("").alias("_path"), "host_rate", F.col("host_rate").alias("path_rate"))
    rest = docs.sparkSession.createDataFrame(
        [("", "", overall, overall)], "_host string, _path string, host_rate double, path_rate double"
    )
    return keep(below.unionByName(only_host).unionByName(rest), "sites")


def judge(
    docs: DataFrame,
    labels: DataFrame,
    good: Column,
    doc_id: str = "doc_id",
    text: str = "text",
    host: str = "source",
    path: str = "lang",
) -> DataFrame:
    """Every row with evidence, host_rate, path_rate, score (0 to 1) and kept.

    ``good`` is a condition on ``labels``, NULL where it is unknown.
    """
    model = fit(docs, labels, good, doc_id, text)
    rates = site_rates(docs, labels, good, doc_id, host, path)
    others = [c for c in docs.columns if c not in RESULTS]
    evidence = F.lit(0.0)
    if model is not None:

        @F.pandas_udf("double")
        def weigh(texts: pd.Series) -> pd.Series:
            return pd.Series(model.evidence(texts), index=texts.index)

        evidence = weigh(F.col(text))
    rows = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in others)).alias("_row"),
        evidence.alias("evidence"),
        _named(host).alias("_host"),
        _named(path).alias("_path"),
    )
    # The rate of a path without labels is its host's, that of such a host the overall one.
    # Sites are found among sites; rows then meet one small table once.
    seen = docs.select(_named(host).alias("_host"), _named(path).alias("_path")).distinct()
    own = rates.select("_host", "_path", F.struct("host_rate", "path_rate").alias("own"))
    of_host = rates.filter("_path = '' AND _host <> ''").select("_host", F.struct("host_rate", "path_rate").alias("up"))
    top = rates.filter("_host = ''").select(F.struct("host_rate", "path_rate").alias("r"))
    sites = keep(
        seen.join(own, ["_host", "_path"], "left")
        .join(of_host, "_host", "left")
        .select("_host", "_path", F.coalesce("own", "up", top.scalar()).alias("site")),
        "site-rates",
    )
    logit = F.log(F.col("site.path_rate") / (1 - F.col("site.path_rate")))
    scored = rows.join(sites, ["_host", "_path"], "left").withColumn(
        "score", 1 / (1 + F.exp(-(logit + F.greatest(F.least("evidence", F.lit(30.0)), F.lit(-30.0)))))
    )
    return scored.select(
        *(F.col("_row").getField(c).alias(c) for c in others),
        "evidence",
        F.col("site.host_rate").alias("host_rate"),
        F.col("site.path_rate").alias("path_rate"),
        "score",
        (F.col("score") >= THRESHOLD).alias("kept"),
    )
