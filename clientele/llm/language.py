"""Language identification by a string kernel.

Two texts are as alike as the shares of byte 1- to 3-grams present in both: the blended
spectrum kernel over presence, k(x, y) = |G(x) and G(y)| / sqrt(|G(x)| |G(y)|), with the grams
of each order hashed to a fixed number of places.  The kernel to a few landmark texts
(Nystroem) gives features on which one ridge regression per language, against the rest, is
fitted.  Texts are scored by batches: presence times landmarks, times one weight matrix.

The model is fitted on a bounded sample of the labelled rows: the ``sample`` first ones by a
hash of their id, dealt evenly over the languages.  Everything else reads all rows and whole
texts.

A text may be unlike every language.  Its likeness is the kernel to the landmarks of its language
as a share of the most that as many grams can have, so that short and long texts compare; the
least likeness allowed is taken from the learned texts of the language.

Defined results: ``und`` with score 0 where the text is NULL or has no letter, and everywhere
if there is nothing to learn from.  Repeated rows are scored alike.  Rows with a NULL id or
language are scored and not learned from.  Equal scores go to the language that sorts first.
Other columns are kept as they are.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clientele.llm.common import small_batches

ORDERS = (1, 2, 3)
PLACES = 1 << 15
SAMPLE = 2_000
LANDMARKS = 96
RIDGE = 1e-3
LEAST_QUANTILE, LEAST_SHARE = 0.01, 0.75  # a likeness below this share of this quantile is none
BLOCK = 128  # texts whose presence rows are held at once
UNKNOWN = "und"


def present(texts: pd.Series) -> np.ndarray:
    """One row per text: which hashed grams its lowered bytes hold."""
    out = np.zeros((len(texts), PLACES), np.float32)
    for row, text in zip(out, texts, strict=True):
        if not isinstance(text, str) or not text:
            continue
        b = np.frombuffer(text.lower().encode(), np.uint8).astype(np.uint32)
        for order in ORDERS:
            code = np.full(max(0, len(b) - order + 1), order, np.uint32)
            for k in range(order):
                code = (code << np.uint32(8)) | b[k : k + len(code)]
            row[(code * np.uint32(0x9E3779B1)) >> np.uint32(17)] = 1
    return out


def _unit(rows: np.ndarray) -> np.ndarray:
    size = np.sqrt(rows.sum(axis=1, keepdims=True))
    return rows / np.maximum(size, 1)


def _likeness(rows: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """The kernel of presence rows to unit rows of landmarks, from 0 to 1: by the most that as
    many grams can have."""
    centre = marks.sum(axis=0, dtype=np.float64).astype(np.float32)
    most = np.concatenate([[0], np.cumsum(np.sort(centre)[::-1], dtype=np.float64)])
    return rows @ centre / np.maximum(most[rows.sum(axis=1).astype(int)], 1e-9)


@dataclass
class Model:
    languages: list[str]
    landmarks: np.ndarray  # packed presence bits, one row per landmark
    weights: np.ndarray  # landmarks x languages
    owners: np.ndarray  # the language of each landmark, by its place in languages
    least: np.ndarray  # the likeness each language asks for

    def decide(self, texts: pd.Series) -> tuple[np.ndarray, np.ndarray]:
        """The best language of each text and its score from 0 to 1."""
        marks = _unit(np.unpackbits(self.landmarks, axis=1)[:, :PLACES].astype(np.float32))
        weights = self.weights.astype(np.float32)
        values = np.vstack(
            [_unit(present(texts.iloc[a : a + BLOCK])) @ marks.T @ weights for a in range(0, max(len(texts), 1), BLOCK)]
        )
        best = values.argmax(axis=1)
        score = np.clip((1 + values[np.arange(len(best)), best]) / 2, 0, 1)
        return np.array(self.languages, dtype=object)[best], score.astype(float)

    def alike(self, texts: pd.Series, lang: np.ndarray) -> np.ndarray:
        """Whether each text is like the texts learned of the language it is given."""
        marks = _unit(np.unpackbits(self.landmarks, axis=1)[:, :PLACES].astype(np.float32))
        out = np.zeros(len(texts), bool)
        for k, name in enumerate(self.languages):
            of = np.flatnonzero(lang == name)
            for a in range(0, len(of), BLOCK):
                part = of[a : a + BLOCK]
                out[part] = _likeness(present(texts.iloc[part]), marks[self.owners == k]) >= self.least[k]
        return out


def fit(docs: DataFrame, learn: Column, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> Model | None:
    """Fit on a sample of the rows where ``learn`` holds; None without any."""
    small_batches(docs.sparkSession)
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang"), learn.alias("learn")
    ).filter(F.col("learn") & F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.col("text").rlike(r"\p{L}"))
    by_hash = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    picked = (
        rows.select("doc_id", "lang")
        .withColumn("place", F.row_number().over(by_hash))
        .filter(F.col("place") <= SAMPLE)
        .orderBy("place", "lang")
        .limit(SAMPLE)
        .select("doc_id")
    )

    def features(batches):
        for batch in batches:
            parts = [present(batch["text"].iloc[a : a + BLOCK]) > 0 for a in range(0, max(len(batch), 1), BLOCK)]
            bits = np.vstack([np.packbits(p, axis=1) for p in parts])
            yield pd.DataFrame(
                {"doc_id": batch["doc_id"], "lang": batch["lang"], "bits": [b.tobytes() for b in bits]}
            )

    # At most SAMPLE ids: a bounded table to send to every task, and as few feature rows back.
    sample = (
        rows.join(F.broadcast(picked.distinct()), "doc_id", "left_semi")
        .select("doc_id", "lang", "text")
        .mapInPandas(features, "doc_id long, lang string, bits binary")
        .limit(SAMPLE)
        .toPandas()
    )
    if sample.empty:
        return None
    # In the order of a hash of the features, which no task order changes.
    sample = sample.sort_values(["lang", "doc_id", "bits"], kind="stable").reset_index(drop=True)
    packed = np.frombuffer(b"".join(sample["bits"]), np.uint8).reshape(len(sample), -1)
    languages = sorted(sample["lang"].unique())
    turn = sample.groupby("lang").cumcount()
    order = np.lexsort((sample["lang"], turn))
    marks = packed[order[:LANDMARKS]]
    unpack = lambda bits: _unit(np.unpackbits(bits, axis=1)[:, :PLACES].astype(np.float32)).astype(float)
    base = unpack(marks)
    kernel = np.vstack([unpack(packed[a : a + 256]) @ base.T for a in range(0, len(packed), 256)])
    # Nystroem features: the kernel to the landmarks, whitened by the kernel among them.
    value, vector = np.linalg.eigh(base @ base.T)
    white = vector @ np.diag(1 / np.sqrt(np.maximum(value, 1e-6))) @ vector.T
    z = kernel @ white
    y = np.where(sample["lang"].to_numpy()[:, None] == np.array(languages, dtype=object)[None, :], 1.0, -1.0)
    # Every language counts alike, however many of its rows are in the sample.
    weight = 1 / sample.groupby("lang")["lang"].transform("size").to_numpy(float)
    weight *= len(sample) / weight.sum() / len(sample)
    zw = z * weight[:, None]
    ridge = np.linalg.solve(z.T @ zw + RIDGE * np.eye(z.shape[1]), zw.T @ y)
    # Learned texts are measured as new ones are: a landmark without itself.
    code = np.searchsorted(languages, sample["lang"].to_numpy(dtype=object))
    owners, least = code[order[:LANDMARKS]], np.zeros(len(languages))
    for k in range(len(languages)):
        own = order[:LANDMARKS][owners == k]
        rest = np.setdiff1d(np.flatnonzero(code == k), own)
        near, bits = base[owners == k], lambda at: np.unpackbits(packed[at], axis=1)[:, :PLACES].astype(np.float32)
        found = [_likeness(bits(rest[a : a + BLOCK]), near) for a in range(0, len(rest), BLOCK)]
        found += [_likeness(bits(own[i : i + 1]), np.delete(near, i, axis=0)) for i in range(len(own))]
        least[k] = LEAST_SHARE * np.quantile(np.concatenate(found), LEAST_QUANTILE)
    return Model(languages, marks, white @ ridge, owners, least)


def identify(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """Add ``lang_pred`` and ``score`` to every row."""
    small_batches(docs.sparkSession)
    if model is None:
        return docs.withColumn("lang_pred", F.lit(UNKNOWN)).withColumn("score", F.lit(0.0))

    @F.pandas_udf("lang_pred string, score double")
    def decide(texts: pd.Series) -> pd.DataFrame:
        lang, score = model.decide(texts)
        return pd.DataFrame({"lang_pred": lang, "score": score}, index=texts.index)

    known = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    found = docs.withColumn("_found", decide(F.col(text)))
    return found.withColumn("lang_pred", F.when(known, F.col("_found.lang_pred")).otherwise(UNKNOWN)).withColumn(
        "score", F.when(known, F.col("_found.score")).otherwise(0.0)
    ).drop("_found")


def alike(model: Model, text: str = "text", lang: str = "lang_pred") -> Column:
    """Whether a text is like those learned of its language, rather than like no language."""

    @F.pandas_udf("boolean")
    def like(texts: pd.Series, langs: pd.Series) -> pd.Series:
        return pd.Series(model.alike(texts, langs.to_numpy(dtype=object)), index=texts.index)

    return like(F.col(text), F.col(lang))


def held_out(doc_id: Column) -> Column:
    """The fifth of the ids that is kept from learning, by their checksum."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))
