"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Texts are lower-cased, runs of anything but letters become one space, and the n-grams of one to three
characters are hashed into a fixed number of features. Weights are fitted with
follow-the-regularised-leader (per-coordinate steps, elastic-net penalty, so that most weights stay
exactly zero); a temperature fitted on rows kept from training then calibrates the scores.

What is learned from where: inverse document frequencies from all rows given to ``fit``; weights and
temperature from a bounded sample of them, at most ``ROWS_PER_LANGUAGE`` for each language (chosen by
a hash of key and text, equal at every size of the table). Predictions read the text alone, whole.

Null texts and texts without a letter are ``und`` with score 0, as is everything if nothing could be
learned (no labelled row); rows with null language teach nothing. With a single language learned every
text with a letter gets it, with score 1. Ties go to the language that sorts first."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.llm.common import only

#: Features (a power of two), and the bound of the training sample.
BITS = 16
ROWS_PER_LANGUAGE = 1000
#: Passes over the sample, step size, and the two penalties.
PASSES, ALPHA, BETA, L1, L2 = 4, 0.3, 1.0, 0.02, 0.1
#: Of the sample, one row in so many is kept from training, for the temperature.
CALIBRATE_EACH = 5
UNKNOWN = "und"
_OTHER = re.compile(r"[\W\d_]+")
_MULTIPLIERS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))


def ngrams(text: str | None) -> np.ndarray | None:
    """Feature numbers of every n-gram of a text; None without a letter."""
    kept = _OTHER.sub(" ", text.lower()).strip() if text else ""
    if not kept:
        return None
    c = np.frombuffer(f" {kept} ".encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    shift = np.uint64(64 - BITS)
    one = c * _MULTIPLIERS[0]
    two = one[:-1] ^ (c[1:] * _MULTIPLIERS[1])
    three = two[:-1] ^ (c[2:] * _MULTIPLIERS[2])
    return np.concatenate([(x * _MULTIPLIERS[0]) >> shift for x in (one[1:-1], two, three)]).astype(np.int64)


def weighted(features: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(features, values) of one text: (1 + log count) * idf, scaled to length one."""
    counts = np.bincount(features, minlength=1 << BITS)
    at = np.flatnonzero(counts)
    values = (1 + np.log(counts[at])) * idf[at]
    return at, values / max(np.sqrt(values @ values), 1e-12)


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray  # features x languages
    temperature: float

    def predict(self, text: str | None) -> tuple[str, float]:
        features = ngrams(text)
        if features is None or not self.languages:
            return UNKNOWN, 0.0
        at, values = weighted(features, self.idf)
        scores = softmax(values @ self.weights[at] / self.temperature)
        best = int(scores.argmax())
        return self.languages[best], float(scores[best])


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], classes: int) -> np.ndarray:
    """Weights (features x classes) after some passes over rows of (features, values, class)."""
    z, n = np.zeros((1 << BITS, classes)), np.zeros((1 << BITS, classes))

    def weights(at=slice(None)) -> np.ndarray:
        zs = z[at]
        step = (BETA + np.sqrt(n[at])) / ALPHA + L2
        return np.where(np.abs(zs) <= L1, 0.0, (np.sign(zs) * L1 - zs) / step)

    for _ in range(PASSES):
        for at, values, label in rows:
            w = weights(at)
            p = softmax(values @ w)
            p[label] -= 1
            g = values[:, None] * p
            grown = n[at] + g * g
            z[at] += g - (np.sqrt(grown) - np.sqrt(n[at])) / ALPHA * w
            n[at] = grown
    return weights()


def temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature of least negative log likelihood, by golden section over its logarithm."""
    if not len(labels):
        return 1.0

    def loss(log_t: float) -> float:
        p = softmax(logits / np.exp(log_t))[np.arange(len(labels)), labels]
        return -np.log(np.maximum(p, 1e-12)).mean()

    a, b, r = np.log(0.02), np.log(20.0), (5 ** 0.5 - 1) / 2
    for _ in range(40):
        c, d = b - r * (b - a), a + r * (b - a)
        a, b = (a, d) if loss(c) <= loss(d) else (c, b)
    return float(np.exp((a + b) / 2))


def document_frequencies(rows: DataFrame) -> tuple[np.ndarray, int]:
    """In how many texts each feature occurs, and the number of texts with a letter.

    Each task adds up its own rows and hands on one vector in slices; slices are summed over groups
    of tasks first, then over all. Only the final vector, of fixed length, reaches the driver."""
    width = 1 << 12

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, texts = np.zeros(1 << BITS, np.int64), 0
        for batch in batches:
            for x in batch.column(0):
                f = ngrams(x.as_py())
                if f is not None:
                    total[np.unique(f)] += 1
                    texts += 1
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        slices = [total[i:i + width].tobytes() for i in range(0, 1 << BITS, width)] + [np.array([texts]).tobytes()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(slices)), pa.int32()), pa.array([task // 64] * len(slices), pa.int32()), pa.array(slices, pa.binary())],
            names=["k", "g", "v"])

    def add(batch: pd.DataFrame) -> pd.DataFrame:
        v = sum(np.frombuffer(x, np.int64) for x in batch["v"])
        return pd.DataFrame({"k": batch["k"][:1], "g": batch["g"][:1], "v": [v.tobytes()]})

    schema = "k int, g int, v binary"
    parts = rows.select("text").mapInArrow(count, schema)
    parts = parts.groupBy("k", "g").applyInPandas(add, schema).groupBy("k").applyInPandas(add, schema)
    found = {r["k"]: np.frombuffer(r["v"], np.int64) for r in parts.collect()}
    n = (1 << BITS) // width
    if not found:
        return np.zeros(1 << BITS, np.int64), 0
    return np.concatenate([found[k] for k in range(n)]), int(found[n][0])


def sample(rows: DataFrame, per_language: int) -> DataFrame:
    """At most ``per_language`` rows of each language: those of the least hashes. A first cut by hash,
    at twice the share needed, keeps the rows to be ranked few; if it leaves too few (possible only
    where equal rows abound), the sample is smaller."""
    counts = rows.groupBy("lang").agg(F.count("*").alias("__n"))
    share = F.least(F.lit(1.0), 2.0 * per_language / F.col("__n"))
    place = F.xxhash64("key", "text")
    # one row for each class of the model: broadcast, so that rows are thinned out before any shuffle
    near = (rows.join(F.broadcast(counts), "lang").withColumn("__h", place)
            .where(F.pmod("__h", F.lit(1_000_003)) < share * 1_000_003))
    from pyspark.sql import Window

    rank = F.row_number().over(Window.partitionBy("lang").orderBy("__h", "key"))
    return near.withColumn("__r", rank).where(F.col("__r") <= per_language).select("key", "text", "lang")


def fit(docs: DataFrame, per_language: int = ROWS_PER_LANGUAGE) -> Model:
    """Model learned from ``docs(key, text, lang)``. The sample is fitted in one task: its size is
    bounded by ``per_language`` times the number of languages."""
    rows = docs.where("lang is not null and text is not null")
    df, texts = document_frequencies(rows)
    idf = np.log((1 + texts) / (1 + df)) + 1

    def train(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found = []
        for b in batches:
            for text, lang in zip(b["text"], b["lang"]):
                f = ngrams(text)
                if f is not None:
                    found.append((*weighted(f, idf), lang))
        if not found:
            return
        names = sorted({r[2] for r in found})
        number = {x: i for i, x in enumerate(names)}
        found = [(a, v, number[x]) for a, v, x in found]
        order = np.random.default_rng(7).permutation(len(found))
        held = [found[i] for i in order[::CALIBRATE_EACH]] if len(found) >= 10 * CALIBRATE_EACH else []
        learn = [found[i] for k, i in enumerate(order) if not held or k % CALIBRATE_EACH]
        w = ftrl(learn, len(names))
        logits = np.array([v @ w[a] for a, v, _ in held]).reshape(len(held), len(names))
        t = temperature(logits, np.array([y for *_, y in held], int))
        yield pd.DataFrame({"languages": [names], "weights": [w.astype(np.float64).tobytes()], "temperature": [t]})

    chosen = sample(rows, per_language).repartition(1).sortWithinPartitions("lang", F.xxhash64("key", "text"))
    got = chosen.select("text", "lang").mapInPandas(train, "languages array<string>, weights binary, temperature double").collect()
    if not got:
        return Model([], idf, np.zeros((1 << BITS, 0)), 1.0)
    names = list(got[0]["languages"])
    return Model(names, idf, np.frombuffer(got[0]["weights"], np.float64).reshape(1 << BITS, len(names)).copy(), got[0]["temperature"])


def predict(docs: DataFrame, model: Model, text: str = "text", lang: str = "lang_pred", score: str = "score") -> DataFrame:
    """``docs`` with predicted language and calibrated score; further columns pass unchanged."""

    @F.arrow_udf(f"{lang} string, {score} double")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for b in batches:  # texts are read one by one: a batch is never held as Python strings beside its Arrow form
            got = [model.predict(t.as_py()) for t in b]
            yield pa.StructArray.from_arrays([pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())], names=[lang, score])

    run = run.asNondeterministic()  # evaluated once a row, not once for each of its fields
    return docs.withColumn("__lang", run(F.col(text))).select(
        *[F.col(f"`{c}`") for c in docs.columns], F.col(f"__lang.{lang}"), F.col(f"__lang.{score}"))


def labelled(docs: DataFrame) -> DataFrame:
    """The rows that may teach: crc32 of the key as text, modulo 4, is not 2."""
    rows = only(docs, doc_id="bigint", text="string", lang="string")
    return rows.where(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) != 2).withColumnRenamed("doc_id", "key")


def languages(docs: DataFrame) -> DataFrame:
    """The query's rows: a prediction for every document."""
    model = fit(labelled(docs))
    held = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2
    return predict(only(docs, doc_id="bigint", text="string"), model).select(
        "doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "lang_pred", "score")
