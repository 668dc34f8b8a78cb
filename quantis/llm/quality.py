"""Quality classifier by positive-unlabelled learning (operator 5).

Trusted positives are training rows labelled 1; everything without a label is
unlabelled web text; rows labelled 0 are not learned from at all.  The class
prior (the share of good texts among the unlabelled ones) is estimated by
best-bin estimation: a first classifier tells positives from unlabelled
texts, and the prior is the least ratio of the two kinds' shares above a
score, with confidence bounds that keep thin bins out.  The final classifier
minimises the non-negative unbiased risk

    prior * R_p(+1) + max(0, R_u(-1) - prior * R_p(-1))

with logistic loss; while the second part is negative the step goes the other
way, which stops it from fitting unlabelled texts as negatives.

The model is a logistic regression on piecewise linear functions of shape
features (no vocabulary, so it costs a few kilobytes).  It is fitted on the
driver on a bounded sample of either kind: ids whose hash lies below a
threshold that lets about ``sample`` of them through, with one text each (that
of the least hash, where rows share an id).  Every text is scored.

Defined cases: null and empty texts are scored like any other (their features
are 0); rows with a null id are never learned from; labels that are null,
repeated with different values, or of unknown documents are ignored; with no
positives or no unlabelled rows every score is 0.5 and predicted 1; equal
texts get equal scores; an empty table gives an empty result.  Columns of
``docs`` pass through ``scored`` unread, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quantis.llm.rules import SYMBOLS, class_histogram, doubled, duplicate_lines, per_document
from quantis.llm.wordbatch import Words, run_hash, split_words, word_hash
from quantis.llm.work import forget, give_up_shuffles, release

#: Rows of either kind that a model is fitted on.
SAMPLE = 20_000
BATCH = 2_048
#: Rows of a design that are made at a time.
ROWS = 1_024
FEATURES = (
    "log words", "bytes a word", "other", "lower", "upper", "digit", "white space", "punctuation", "symbol", "non-ascii",
    "equal neighbours", "repeated pairs", "repeated fours", "symbol words", "words ending in a symbol", "words ending in !",
    "duplicate lines",
)
KNOTS = (0.01, 0.03, 0.1, 0.25, 0.5, 0.75, 0.85, 0.9, 0.95, 0.98)


def held_out(id_: Column, folds: int = 3, fold: int = 1) -> Column:
    """Whether a row is kept from training: crc32 of its id as text."""
    return F.crc32(F.coalesce(id_.cast("string"), F.lit("")).cast("binary")) % folds == fold


def features(w: Words) -> np.ndarray:
    """Shape of each text of a slice, one row a text."""
    n = np.diff(w.first)
    size = np.diff(w.offsets)
    words, chars = np.maximum(n, 1), np.maximum(size, 1)
    h, doc = word_hash(w), w.doc
    beside = np.zeros(len(h), bool)
    beside[1:] = (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])

    def repeated(k: int) -> np.ndarray:
        runs = run_hash(h, k)
        at = np.flatnonzero(doc[: len(runs)] == doc[k - 1 :]) if len(runs) else np.zeros(0, int)
        return np.bincount(doc[at][doubled(doc[at], runs[at])[1]], minlength=w.n_docs)

    last = w.data[w.end - 1] if len(h) else np.zeros(0, np.uint8)
    single = (w.end - w.start == 1) & SYMBOLS[last]
    lines = per_document(w.data == 0x0A, w.offsets) + 1
    return np.column_stack(
        [
            np.log1p(n), np.minimum(per_document(w.end - w.start, w.first) / words, 100), class_histogram(w) / chars[:, None],
            per_document(beside, w.first) / words, repeated(2) / words, repeated(4) / words, per_document(single, w.first) / words,
            per_document(SYMBOLS[last], w.first) / words, per_document(last == 0x21, w.first) / words, duplicate_lines(w) / lines,
        ]
    ).astype(np.float64)


@dataclass
class Model:
    """Weights over hinge functions of the features; none: nothing learned."""

    knots: np.ndarray | None = None
    scale: np.ndarray | None = None
    weights: np.ndarray | None = None
    prior: float = 0.5

    def design(self, x: np.ndarray) -> np.ndarray:
        out = np.ones((len(x), 1 + self.knots.size))
        for a in range(0, len(x), ROWS):  # what is made on the way stays small beside the result
            hinges = np.maximum(0, x[a : a + ROWS, :, None] - self.knots) / self.scale
            out[a : a + ROWS, 1:] = np.minimum(hinges, 5).reshape(len(hinges), -1)
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(x), 0.5)
        return 1 / (1 + np.exp(-np.clip(self.design(x) @ self.weights, -30, 30)))


def _descend(positive: np.ndarray, unlabelled: np.ndarray, prior: float | None, steps: int, rate: float = 0.02) -> np.ndarray:
    """Adam on the non-negative risk, in batches; without a prior on the plain
    logistic risk of positives against unlabelled rows."""
    w = np.zeros(positive.shape[1])
    m, v = np.zeros_like(w), np.zeros_like(w)
    rng = np.random.Generator(np.random.PCG64(11))
    for step in range(1, steps + 1):
        a = positive[rng.integers(0, len(positive), min(BATCH, len(positive)))]
        b = unlabelled[rng.integers(0, len(unlabelled), min(BATCH, len(unlabelled)))]
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        u = 1 / (1 + np.exp(-np.clip(b @ w, -30, 30)))
        up, down = a.T @ (p - 1) / len(p), a.T @ p / len(p)
        other = b.T @ u / len(u)
        if prior is None:
            g = up + other
        else:
            loss = -np.log1p(-np.minimum(u, 1 - 1e-12)).mean() + prior * np.log1p(-np.minimum(p, 1 - 1e-12)).mean()
            g = prior * up + (other - prior * down) if loss >= 0 else -(other - prior * down)
        g = g + 1e-4 * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - rate * min(1.0, 2 * (1 - step / (steps + 1))) * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return w


def best_bin(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """Share of positives among the unlabelled rows, from scores of both."""
    at = np.unique(np.concatenate([positive, unlabelled]))
    above = lambda x: 1 - np.searchsorted(np.sort(x), at, side="left") / len(x)
    p, u = above(positive), above(unlabelled)
    doubt = np.sqrt(np.log(40) / 2) * (1 / np.sqrt(len(positive)) + 1 / np.sqrt(len(unlabelled)))
    with np.errstate(divide="ignore", invalid="ignore"):
        bound = np.where(p > 0, (u + doubt) / p, np.inf)
    best = int(np.argmin(bound))
    return float(np.clip(u[best] / p[best], 0.01, 0.99))


def fit(positive: np.ndarray, unlabelled: np.ndarray, steps: int = 1500) -> Model:
    """Model from the features of trusted positives and unlabelled texts."""
    if not len(positive) or not len(unlabelled):
        return Model()
    both = np.vstack([positive, unlabelled])
    knots = np.quantile(both, KNOTS, axis=0).T
    knots = np.hstack([np.minimum(both.min(axis=0), 0)[:, None], knots])
    scale = np.maximum(both.std(axis=0), 1e-6)[:, None]
    model = Model(knots, scale)
    p, u = model.design(positive), model.design(unlabelled)
    found = []
    for k in range(2) if min(len(p), len(u)) > 1 else ():  # each half judges the classifier of the other
        w = _descend(p[k::2], u[k::2], None, steps // 3)
        found.append(best_bin(p[1 - k :: 2] @ w, u[1 - k :: 2] @ w))
    model.prior = float(np.mean(found)) if found else 0.5
    model.weights = _descend(p, u, model.prior, steps)
    return model


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for w in split_words(batch.column("text")):
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("positive").slice(w.row, w.n_docs),
                    pa.array([x.tobytes() for x in features(w)], pa.binary()),
                ],
                names=["positive", "shape"],
            )


def share_of(count: int, sample: int) -> int:
    """Threshold (of 2**30) below which about ``sample`` of ``count`` hashes
    lie, four standard deviations below it rather than above."""
    return 1 << 30 if count <= sample else int((1 << 30) * max(sample / 2, sample - 4 * sample**0.5) / count)


def learn(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = SAMPLE
) -> Model:
    """Fits a model on the rows that are not held out."""
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("label")).filter("id is not null and label is not null")
    known = known.groupBy("id").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    training = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).filter(
        F.col("id").isNotNull() & ~held_out(F.col("id"))
    )
    marked = training.select("id").distinct().join(known, "id", "left")
    kinds = marked.select("id", F.when(F.col("low").isNull(), False).when((F.col("low") == 1) & (F.col("high") == 1), True).alias("positive"))
    kinds = kinds.filter("positive is not null")
    n = {r["positive"]: r["n"] for r in kinds.groupBy("positive").agg(F.count(F.lit(1)).alias("n")).collect()}
    # ids below a threshold of their hash: no sorting, and the same ids whatever the order of rows
    share = {kind: share_of(count, sample) for kind, count in n.items()}
    drawn = F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < F.when(F.col("positive"), share.get(True, 0)).otherwise(share.get(False, 0))
    chosen = kinds.filter(drawn)
    # at most 2 * sample ids of a few bytes each, and one text of each
    rows = (
        training.join(F.broadcast(chosen), "id").groupBy("id", "positive").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
        .select("positive", "text").mapInArrow(_features, "positive boolean, shape binary")
    )
    table = rows.toArrow()
    x = np.frombuffer(b"".join(table["shape"].to_pylist()), np.float64).reshape(-1, len(FEATURES))
    # the order of rows must not change the fit
    positive = table["positive"].to_numpy().astype(bool)
    order = np.lexsort(np.column_stack([x, positive]).T) if len(x) else np.zeros(0, int)
    x, positive = x[order], positive[order]
    shuffled = np.random.Generator(np.random.PCG64(7)).permutation(len(x))
    x, positive = x[shuffled], positive[shuffled]
    del table, order, shuffled
    give_up_shuffles(docs.sparkSession)  # those of the sample; the fit takes the driver's memory next
    model = fit(x[positive], x[~positive])
    release()
    return model


def _score(model):
    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        forget()
        for column in columns:
            found = [model.value.score(features(w)) for w in split_words(column)]
            yield pa.array(np.concatenate(found) if found else np.zeros(0), pa.float64())
        release()

    return F.arrow_udf(run, "double")


def scored(docs: DataFrame, model: Model, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``row`` (a struct of the columns ``keep``, all by default) and
    ``score`` of every document.  Only texts go to Python, and only scores
    come back."""
    columns = docs.columns if keep is None else keep
    score = _score(docs.sparkSession.sparkContext.broadcast(model))
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), score(text).alias("score"))


def keep_good(docs: DataFrame, labels: DataFrame, limit: float = 0.5) -> DataFrame:
    """Documents that the classifier accepts, with their columns."""
    return scored(docs, learn(docs, labels)).filter(F.col("score") >= limit).select("row.*")
