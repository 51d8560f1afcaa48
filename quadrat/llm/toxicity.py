"""Toxicity by a classifier chain.

Categories are predicted one after the other by linear models over the words, and word
beginnings, that a text holds; the model of each category also sees the probabilities of
the categories before it. In training those are out-of-fold predictions, so a later model
meets earlier probabilities as unsure as they will be on new texts. A category's threshold
is the one with the best F1 on out-of-fold predictions.

Bounds: the models are fitted on at most SAMPLE labelled documents, the ones with the
smallest id hashes, and on at most FEATURES features, those whose frequencies differ most
between the classes of any category. Both are parameters. Feature frequencies are counted
by Spark; the driver fits on index arrays of the sample. All documents are scored.

Defined cases: null and empty texts have no features and get the base rate; a null label
leaves its document out; labels that repeat a document count once, as the largest; null
ids have no label but are scored; without labelled documents, or without positive ones,
nothing is rejected; other columns are not looked at, and stay in place in ``keep_clean``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from ..session import cut_lineage, ship_with_tasks

ship_with_tasks(__name__)

SAMPLE, FEATURES, LEAST_TEXTS = 20_000, 8_192, 3
FOLDS, PENALTY, STEPS = 3, 1.0, 60
BEGINNING = 4
WORD = re.compile(r"[^\W_]+")


@dataclass
class Link:
    """One category's model: weights by feature, then by earlier category, and a bias."""

    name: str
    weights: np.ndarray
    earlier: np.ndarray
    bias: float
    threshold: float = 2.0


@dataclass
class Chain:
    features: dict[str, int]
    links: list[Link] = field(default_factory=list)


def features_of(text: str | None) -> set[str]:
    """The distinct words, and word beginnings marked by a caret."""
    words = set(WORD.findall(text.lower())) if text else set()
    return words | {"^" + w[:BEGINNING] for w in words if len(w) > BEGINNING}


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


class Rows:
    """Sparse 0/1 rows, as feature indices and row numbers."""

    def __init__(self, rows: list[np.ndarray], width: int) -> None:
        self.n, self.width = len(rows), width
        self.index = np.concatenate(rows).astype(np.int64) if rows else np.empty(0, np.int64)
        self.row = np.repeat(np.arange(self.n), [len(r) for r in rows])

    def times(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, w[self.index], self.n)

    def transposed(self, r: np.ndarray) -> np.ndarray:
        return np.bincount(self.index, r[self.row], self.width)


def fit_linear(rows: Rows, dense: np.ndarray, y: np.ndarray, use: np.ndarray) -> np.ndarray:
    """Penalised logistic regression by limited-memory BFGS; weights, dense weights, bias."""
    width, m = rows.width, dense.shape[1]
    weight = use.astype(float)
    rate = np.clip((y * weight).sum() / max(weight.sum(), 1), 1e-4, 1 - 1e-4)
    w = np.zeros(width + m + 1)
    w[-1] = np.log(rate / (1 - rate))

    def value(w: np.ndarray) -> tuple[float, np.ndarray]:
        z = rows.times(w[:width]) + dense @ w[width:-1] + w[-1]
        loss = (weight * (np.logaddexp(0, z) - y * z)).sum() + 0.5 * PENALTY * (w[:-1] ** 2).sum()
        r = weight * (_sigmoid(z) - y)
        return loss, np.concatenate([rows.transposed(r), dense.T @ r, [r.sum()]]) + PENALTY * np.append(w[:-1], 0)

    loss, grad = value(w)
    past: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(STEPS):
        q, alphas = grad.copy(), []
        for s, t in reversed(past):
            alphas.append((s @ q) / (t @ s))
            q -= alphas[-1] * t
        if past:
            s, t = past[-1]
            q *= (s @ t) / (t @ t)
        else:
            q /= max(1.0, np.linalg.norm(q))
        for (s, t), a in zip(past, reversed(alphas)):
            q += s * (a - (t @ q) / (t @ s))
        step, slope = 1.0, grad @ q
        while True:
            new, ahead = value(w - step * q)
            if new <= loss - 1e-4 * step * slope or step < 1e-6:
                break
            step /= 2
        s, t = -step * q, ahead - grad
        done = loss - new <= 1e-6 * max(abs(loss), 1)
        w, loss, grad = w + s, new, ahead
        if t @ s > 1e-12:
            past = [*past[-7:], (s, t)]
        if done:
            break
    return w


def best_threshold(p: np.ndarray, y: np.ndarray) -> float:
    """Where F1 is highest, midway to the next probability; above 1 without positives."""
    if not y.any():
        return 2.0
    order = np.argsort(-p, kind="stable")
    hits = np.cumsum(y[order])
    f1 = 2 * hits / (np.arange(1, len(p) + 1) + y.sum())
    edge = np.append(np.diff(p[order]) != 0, True)
    k = int(np.argmax(np.where(edge, f1, -1)))
    after = p[order][k + 1] if k + 1 < len(p) else 0.0
    return float((p[order][k] + after) / 2)


def fit_chain(rows: Rows, labels: dict[str, np.ndarray], folds: np.ndarray) -> list[Link]:
    """The chain's models, in the order of ``labels``; -1 stands for an unknown label."""
    earlier, links = np.empty((rows.n, 0)), []
    for name, label in labels.items():
        known, y = label >= 0, np.maximum(label, 0).astype(float)

        def predict(w: np.ndarray) -> np.ndarray:
            z = rows.times(w[: rows.width]) + earlier @ w[rows.width : -1] + w[-1]
            return _sigmoid(z)

        out = np.zeros(rows.n)
        for f in range(FOLDS):
            held = folds == f
            out[held] = predict(fit_linear(rows, earlier, y, known & ~held))[held]
        w = fit_linear(rows, earlier, y, known)
        links.append(
            Link(
                name,
                w[: rows.width],
                w[rows.width : -1],
                float(w[-1]),
                best_threshold(out[known], y[known]) if known.any() else 2.0,
            )
        )
        earlier = np.column_stack([earlier, out])
    return links


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [sorted(features_of(t)) for t in batch.column("text").to_pylist()]
        kept = [c for c in batch.schema.names if c != "text"]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in kept), pa.array(found, pa.list_(pa.string()))],
            names=[*kept, "features"],
        )


def _indexed(features: dict[str, int], categories: list[str]):
    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                sorted(features[f] for f in found if f in features)
                for found in batch.column("features").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ["fold", *categories]), pa.array(rows, pa.list_(pa.int32()))],
                names=["fold", *categories, "found"],
            )

    return index


def labelled(
    docs: DataFrame, labels: DataFrame, categories: dict[str, Column], sample: int = SAMPLE
) -> DataFrame:
    """(fold, the categories, text) of the labelled documents: at most ``sample`` rows.

    Those with the smallest id hashes; of rows with one id, the one with the smallest text hash.
    """
    names = list(categories)
    marks = [F.max(c.cast("int")).alias(n) for n, c in categories.items()]
    by_hash = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = (
        labels.where(F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(*marks)
        .select("doc_id", F.pmod(F.hash("doc_id"), F.lit(FOLDS)).alias("fold"), *names)
        .orderBy(*by_hash)
        .limit(sample)
    )
    # at most ``sample`` narrow rows
    texts = docs.select("doc_id", "text").join(F.broadcast(cut_lineage(chosen)), "doc_id")
    one = F.min_by("text", F.struct(F.xxhash64("text"), F.col("text"))).alias("text")
    return texts.groupBy("doc_id", "fold", *names).agg(one).select("fold", *names, "text")


def train(
    docs: DataFrame,
    labels: DataFrame,
    categories: dict[str, Column],
    sample: int = SAMPLE,
    width: int = FEATURES,
) -> Chain:
    """Fit the chain on at most ``sample`` labelled documents.

    ``categories`` maps names to 0/1 columns of ``labels``, in the order of the chain.
    """
    names = list(categories)
    texts = labelled(docs, labels, categories, sample)
    kinds = "".join(f", `{n}` int" for n in names)
    rows = cut_lineage(
        texts.mapInArrow(
            _sampled, f"fold int{kinds}, features array<string>"
        )
    )
    features = {r.feature: k for k, r in enumerate(_telling(rows, names, width).collect())}
    table = rows.mapInArrow(_indexed(features, names), f"fold int{kinds}, found array<int>").toArrow()
    found = [np.array(r, np.int64) for r in table.column("found").to_pylist()]
    known = {n: np.array([-1 if v is None else v for v in table.column(n).to_pylist()], int) for n in names}
    folds = np.array(table.column("fold").to_pylist(), int)
    return Chain(features, fit_chain(Rows(found, len(features)), known, folds))


def _telling(rows: DataFrame, names: list[str], width: int) -> DataFrame:
    """The features whose frequency differs most, in deviations, between any two classes."""
    totals = rows.agg(F.count("*").alias("n"), *[F.sum(n).alias(f"n_{n}") for n in names])
    counts = (
        rows.select(*names, F.explode("features").alias("feature"))
        .groupBy("feature")
        .agg(F.count("*").alias("df"), *[F.sum(n).alias(f"df_{n}") for n in names])
        .where(F.col("df") >= LEAST_TEXTS)
    )
    n = totals.first()
    scores = []
    for name in names:
        yes = n[f"n_{name}"] or 0
        if 0 < yes < n["n"]:
            share = F.col("df") / n["n"]
            gap = F.col(f"df_{name}") / yes - (F.col("df") - F.col(f"df_{name}")) / (n["n"] - yes)
            spread = F.sqrt(share * (1 - share) * (1 / yes + 1 / (n["n"] - yes)))
            scores.append(F.when(share < 1, F.abs(gap) / spread).otherwise(0.0))
    score = F.greatest(F.lit(0.0), F.lit(0.0), *scores)
    return counts.orderBy(score.desc(), "feature").limit(width).select("feature")


def _scorer(chain: Chain):
    table = np.array([link.weights for link in chain.links]).reshape(len(chain.links), -1).T

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.zeros((batch.num_rows, len(chain.links)))
            for k, text in enumerate(batch.column("text")):
                found = features_of(text.as_py())
                at = [chain.features[f] for f in found.intersection(chain.features)]
                # summed in one order, whatever the order of the set
                out[k] = table[sorted(at)].sum(axis=0)
            for j, link in enumerate(chain.links):
                out[:, j] = _sigmoid(out[:, j] + out[:, :j] @ link.earlier + link.bias)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc_id", "row")), *map(pa.array, out.T)],
                names=["doc_id", "row", *(f"p_{link.name}" for link in chain.links)],
            )

    return score


def scores(docs: DataFrame, chain: Chain) -> DataFrame:
    """doc_id, row, p_<category>, is_<category>; ``row`` is a hash of id and text."""
    kinds = "".join(f", `p_{link.name}` double" for link in chain.links)
    keyed = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("row"), "text")
    scored = keyed.mapInArrow(_scorer(chain), f"doc_id long, row long{kinds}")
    marks = {f"is_{n.name}": F.col(f"p_{n.name}") >= F.lit(n.threshold) for n in chain.links}
    return scored.withColumns(marks)


def _label_columns() -> dict[str, Column]:
    return {"junk": 1 - F.col("quality"), "toxic": F.col("toxic")}


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, row, p_junk, p_toxic, rejected.

    The labels name two categories, low quality and toxicity; the chain goes from the first
    to the second, and the second rejects.
    """
    chain = train(docs, labels, _label_columns())
    return scores(docs, chain).select(
        "doc_id", "row", "p_junk", "p_toxic", F.col("is_toxic").alias("rejected")
    )


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without what the chain rejects; all columns stay.

    Every row is scored as it passes, so the texts are not shuffled.
    """
    chain = train(docs, labels, _label_columns())
    names = docs.columns
    extra = _unused("p_toxic", names)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = _scorer(chain)
        for batch in batches:
            plain = pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("doc_id"), batch.column("text")],
                names=["doc_id", "row", "text"],
            )
            p = next(score(iter([plain])))
            yield batch.append_column(extra, p.column("p_toxic"))

    schema = StructType([*docs.schema.fields, StructField(extra, DoubleType())])
    kept = docs.mapInArrow(keep, schema).where(F.col(extra) < F.lit(chain.links[-1].threshold))
    return kept.select(*[F.col(f"`{c}`") for c in names])


def _unused(name: str, names: list[str]) -> str:
    while name in names:
        name += "_"
    return name
