"""Operator 6, toxicity: a chain of linear classifiers with out-of-fold predictions.

The categories are 0/1 columns of the label table, in an order. The first model sees the text; each
later one also sees the probabilities of the categories before it. For training these come from
models that were fitted without the row (out of fold), so a later model learns how far an earlier
one can be trusted; for prediction the models fitted on all folds are chained.

Features are shares of a text's words that begin with, or are, a certain string. Per category they
are chosen by a Spark aggregate over the labelled texts (chi-square of a share of MIN_SHARE or more
against the label, at a level that chance does not reach among a million strings). Models are fitted
on at most ``max_labelled`` labelled texts, chosen by hash of the id; with at most ``max_features``
features, that bounds what the driver sees. Scoring covers every text, and whole texts.

Defined results: NULL and empty texts have no words and get the probability of the intercept;
labels that are NULL, or whose document is missing, are not used; equal texts are learned from once, with
the larger label; without both kinds of labels a category has the probability of its mean (0 without
any); repeated rows and equal or NULL ids are scored row by row; an empty table gives an empty
table. ``probabilities`` reads two columns only, and ``keep_clean`` keeps all.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.llm.common import documents, query, small_batches, text_column
from tokenloom.llm.decontamination import words_of
from tokenloom.session import stage
from tokenloom.sources.readers import read_table

#: Labelled texts that the models are fitted on, at most (about; the choice is by hash).
MAX_LABELLED = 12_000
#: Features of one category, at most.
MAX_FEATURES = 128
#: A string is present where this share of the words, or more, begin with it.
MIN_SHARE = 0.004
#: Chi-square (one degree of freedom) from which a string is chosen: one in a million by chance.
MIN_CHI_SQUARE = 24.0
MIN_TEXTS = 3
PREFIXES = range(3, 8)
FOLDS = 3
RIDGE = 0.3
THRESHOLD = 0.5
CACHED_WORDS = 100_000


def strings_of(word: bytes) -> list[bytes]:
    """The prefixes of a word and the word itself, marked as whole."""
    text = word.decode("utf-8", "ignore")
    return [*(text[:size].encode() for size in PREFIXES if size < len(text)), word + b" "]


class Shares(dict):
    """Which of the chosen strings each word counts for, and shares of a text's words."""

    def __init__(self, chosen: Sequence[bytes]):
        super().__init__()
        self.place = {string: i for i, string in enumerate(chosen)}

    def __missing__(self, word: bytes) -> tuple[int, ...]:
        if len(self) >= CACHED_WORDS:
            self.clear()
        found = self[word] = tuple(self.place[s] for s in strings_of(word) if s in self.place)
        return found

    def of(self, words: list[bytes]) -> dict[int, float]:
        """Percent of the words, by place of the string."""
        counts: Counter[int] = Counter(place for word in words for place in self[word])
        return {place: 100.0 * count / len(words) for place, count in counts.items()}


@dataclass
class Link:
    """One model of the chain: strings, their weights, weights of earlier categories, intercept."""

    strings: list[bytes]
    weights: np.ndarray
    earlier: np.ndarray
    intercept: float


@dataclass
class Chain:
    categories: tuple[str, ...]
    links: list[Link]

    def scorer(self):
        """A function from words to the probabilities of the categories."""
        chosen = sorted({s for link in self.links for s in link.strings})
        shares = Shares(chosen)
        dense = []
        for link in self.links:
            weights = np.zeros(len(chosen))
            for string, weight in zip(link.strings, link.weights):
                weights[shares.place[string]] = weight
            dense.append(weights.tolist())

        def score(words: list[bytes]) -> list[float]:
            found = shares.of(words).items()
            known: list[float] = []
            for link, weights in zip(self.links, dense):
                logit = link.intercept + sum(weights[i] * x for i, x in found) + sum(w * p for w, p in zip(link.earlier, known))
                known.append(float(_probability(logit)))
            return known

        return score


def fit_logistic(features: np.ndarray, labels: np.ndarray, ridge: float = RIDGE, turns: int = 25) -> np.ndarray:
    """Weights of a ridge logistic regression by Newton's method; the intercept comes first."""
    x = np.column_stack((np.ones(len(features)), features))
    weights = np.zeros(x.shape[1])
    mean = labels.mean() if len(labels) else 0.0
    if mean in (0.0, 1.0):
        weights[0] = -30.0 if mean == 0.0 else 30.0
        return weights
    penalty = np.full(x.shape[1], ridge)
    penalty[0] = 1e-9
    for _ in range(turns):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (p - labels) + penalty * weights
        curve = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(curve, slope)
        weights -= step
        if np.abs(step).max() < 1e-7:
            break
    return weights


def _probability(logit: np.ndarray | float) -> np.ndarray | float:
    return 1.0 / (1.0 + np.exp(-np.clip(logit, -30, 30)))


def fit_chain(features: list[np.ndarray], labels: np.ndarray, folds: np.ndarray, count: int = FOLDS) -> list[np.ndarray]:
    """Weights per category; columns of earlier categories' probabilities follow the features of a category."""
    earlier = np.zeros((len(labels), 0))
    models = []
    for i, own in enumerate(features):
        x, y = np.column_stack((own, earlier)), labels[:, i]
        models.append(fit_logistic(x, y))
        # What later models see of this category was predicted without the row itself.
        held_out = np.zeros(len(y))
        for fold in range(count):
            inside = folds == fold
            weights = fit_logistic(x[~inside], y[~inside])
            held_out[inside] = _probability(x[inside] @ weights[1:] + weights[0])
        earlier = np.column_stack((earlier, held_out))
    return models


def labelled_texts(docs: DataFrame, labels: DataFrame, categories: dict[str, Column], key: str, text: str, max_labelled: int) -> DataFrame:
    """Rows (words, fold, one column per category) of at most about ``max_labelled`` labelled texts, staged."""
    given = labels.select(F.col(key).alias("key"), *(column.cast("double").alias(f"c{i}") for i, column in enumerate(categories.values()))).dropna()
    count = given.count()
    if count > max_labelled:
        given = given.where(F.pmod(F.xxhash64(F.lit(7), "key"), F.lit(1_000_000)) < int(1_000_000 * max_labelled / count))
    chosen = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text")).join(given, "key")
    names = [f"c{i}" for i in range(len(categories))]
    once = chosen.withColumn("code", F.xxhash64("text")).groupBy("code").agg(F.first("text").alias("text"), *(F.max(n).alias(n) for n in names))
    return stage(once.withColumn("fold", F.pmod("code", F.lit(FOLDS)).cast("int")), "toxicity-labelled")


def choose_strings(sample: DataFrame, category: int, max_features: int = MAX_FEATURES) -> list[bytes]:
    """The strings whose presence says most about a category, best first."""

    def present(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            strings, labels = [], []
            for text, label in zip(text_column(batch), batch.column("label").to_pylist()):
                words = words_of(text)
                counts = Counter(s for word in words for s in strings_of(word))
                own = [s for s, n in counts.items() if n >= MIN_SHARE * len(words)]
                strings += own
                labels += [label] * len(own)
            yield pa.RecordBatch.from_arrays([pa.array(strings, pa.binary()), pa.array(labels, pa.float64())], names=["string", "label"])

    rows = sample.select("text", F.col(f"c{category}").alias("label"))
    total, positive = rows.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    if not 0 < positive < total:
        return []
    rate = positive / total
    counted = rows.mapInArrow(present, "string binary, label double").groupBy("string").agg(F.count("*").alias("n"), F.sum("label").alias("pos"))
    expected = F.col("n") * rate
    scored = counted.where((F.col("n") >= MIN_TEXTS) & (F.col("pos") > expected)).withColumn("score", (F.col("pos") - expected) ** 2 / (expected * (1 - rate)))
    best = scored.where(F.col("score") >= MIN_CHI_SQUARE).orderBy(F.desc("score"), F.length("string"), "string").limit(4 * max_features).collect()
    chosen: dict[tuple, bytes] = {}
    for row in best:
        # Of strings that begin alike and say the same, the shortest will do.
        chosen.setdefault((row.n, row.pos, bytes(row.string).decode("utf-8", "ignore")[:3]), bytes(row.string))
    return list(chosen.values())[:max_features]


def fit(docs: DataFrame, labels: DataFrame, categories: dict[str, Column], key: str = "doc_id", text: str = "text", max_labelled: int = MAX_LABELLED) -> Chain:
    """Fit the chain over ``categories``: name and 0/1 column of the label table, in order."""
    sample = labelled_texts(docs, labels, categories, key, text, max_labelled)
    strings = [choose_strings(sample, i) for i in range(len(categories))]
    every = sorted({s for own in strings for s in own})
    names = [f"c{i}" for i in range(len(categories))]

    def shares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = Shares(every)
        for batch in small_batches(batches, "text"):
            own = [found.of(words_of(text)) for text in text_column(batch)]
            places = pa.array([list(x) for x in own], pa.list_(pa.int32()))
            values = pa.array([list(x.values()) for x in own], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([places, values, *(batch.column(n) for n in ["fold", *names])], names=["places", "values", "fold", *names])

    schema = "places array<int>, values array<double>, fold int, " + ", ".join(f"{n} double" for n in names)
    rows = sample.orderBy("code").select("text", "fold", *names).mapInArrow(shares, schema).collect()
    matrix, answers = np.zeros((len(rows), len(every))), np.array([[r[n] for n in names] for r in rows]).reshape(len(rows), len(names))
    for i, row in enumerate(rows):
        matrix[i, row.places] = row["values"]
    place = {s: i for i, s in enumerate(every)}
    features = [matrix[:, [place[s] for s in own]] for own in strings]
    models = fit_chain(features, answers, np.array([r.fold for r in rows], dtype=int))
    links = [Link(own, m[1 : 1 + len(own)], m[1 + len(own) :], float(m[0])) for own, m in zip(strings, models)]
    return Chain(tuple(categories), links)


def probabilities(docs: DataFrame, chain: Chain, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (key, one probability per category)."""
    held = docs.sparkSession.sparkContext.broadcast(chain)
    names = [f"p{i}" for i in range(len(chain.categories))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = held.value.scorer()
        for batch in small_batches(batches, "text"):
            scores = np.array([score(words_of(text)) for text in text_column(batch)]).reshape(-1, len(names))
            yield pa.RecordBatch.from_arrays([batch.column("key"), *(pa.array(scores[:, i]) for i in range(len(names)))], names=["key", *names])

    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    schema = f"key {rows.schema['key'].dataType.simpleString()}, " + ", ".join(f"{n} double" for n in names)
    return rows.mapInArrow(run, schema).toDF(key, *(f"{name}_probability" for name in chain.categories))


def keep_clean(docs: DataFrame, chain: Chain, category: str, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The documents, all their columns, whose probability of ``category`` is below the threshold."""
    held, at = docs.sparkSession.sparkContext.broadcast(chain), chain.categories.index(category)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = held.value.scorer()
        for batch in small_batches(batches, text):
            yield batch.filter(pa.array([score(words_of(value))[at] < threshold for value in text_column(batch, text)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def default_categories() -> dict[str, Column]:
    """Low quality first: what tells junk from prose helps to judge the words of toxic prose."""
    return {"low_quality": 1 - F.col("quality"), "toxic": F.col("toxic")}


@query("op6_toxicity_chain")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    """Probabilities and verdict for every document."""
    docs = documents(spark, folder)
    chain = fit(docs, read_table(spark, folder, "labels"), default_categories())
    toxic = F.col("toxic_probability") >= THRESHOLD
    return probabilities(docs, chain).select("*", toxic.alias("toxic"), (~toxic).alias("kept"))
