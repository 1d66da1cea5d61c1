"""Quality classifier learned from trusted positives and unlabelled text.

A linear model over counts of character classes, pairs of classes, and repeats. It
minimises the non-negative unbiased risk for positive-unlabelled data: the loss of the
negatives is that of the unlabelled texts less the share that the positives have in
them, held at zero where it would turn negative. That share, the class prior, is
estimated from texts the model was not fitted on. Negative labels are never used.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gramrank.llm import textarrays as T

#: Texts the model is fitted on, at most so many of either kind.
TRAIN_POSITIVES = 6_000
TRAIN_UNLABELLED = 12_000

_KINDS = (
    "abcdefghijklmnopqrstuvwxyz",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "0123456789",
    " \t\v\f\r",
    "\n",
    ".",
    ",;:",
    "!?",
    "|",
    "#*$%&",
    "<>",
    "@=+_/\\^~`",
    "'\"()[]{}-",
)
#: Class of a byte: 0 control, 1-13 the kinds above, 14 a character beyond ASCII.
BYTE_CLASS = np.zeros(256, dtype=np.uint8)
for _i, _kind in enumerate(_KINDS):
    BYTE_CLASS[list(_kind.encode())] = _i + 1
BYTE_CLASS[0x80:] = 14
PAIRS = 256
FEATURES = PAIRS + 9


def features(texts: T.Texts) -> np.ndarray:
    """A row of ``FEATURES`` numbers for each text; an empty text has only zeros."""
    n = len(texts)
    out = np.zeros((n, FEATURES), dtype=np.float32)
    classes = BYTE_CLASS[texts.data].astype(np.int64)
    sizes = np.diff(texts.bounds)
    if len(classes) > 1:
        pair = (classes[:-1] << 4) | classes[1:]
        owner = np.repeat(np.arange(n), sizes)
        same = owner[:-1] == owner[1:]
        counts = np.bincount((owner[:-1][same] << 8) | pair[same], minlength=n * PAIRS)
        shares = counts.reshape(n, PAIRS) / np.maximum(sizes - 1, 1)[:, None]
        out[:, :PAIRS] = np.sqrt(shares)
    words = texts.words()
    hashes, widths = words.hashes(T.FOLDED_VALUES), words.ends - words.starts
    for i in range(n):
        a, b = words.bounds[i], words.bounds[i + 1]
        if a == b:
            continue
        own = hashes[a:b]
        runs = own[1:] == own[:-1]
        threes = np.sort(T.windows(own, 3))
        text = texts.data[texts.bounds[i] : texts.bounds[i + 1]].tobytes()
        lines = text.split(b"\n")
        out[i, PAIRS:] = (
            1.0,
            np.log1p(b - a) / 10,
            len(np.unique(own)) / (b - a),
            runs.mean() if len(runs) else 0.0,
            (threes[1:] == threes[:-1]).mean() if len(threes) > 1 else 0.0,
            1 - len(set(lines)) / len(lines),
            np.log1p(widths[a:b].mean()) / 3,
            np.log1p(widths[a:b].std()) / 3,
            np.log1p((b - a) / len(lines)) / 5,
        )
    return out


def sampling_key(doc_id: Column, seed: int) -> Column:
    return F.xxhash64(doc_id.cast("string"), F.lit(seed))


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from; a null id is held out."""
    rest = F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5
    return doc_id.isNull() | (rest == 0)


@dataclass
class Quality:
    """Linear model over standardised features."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float
    prior: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -6, 6) @ self.weights + self.bias

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -30, 30)))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _descend(
    positive: np.ndarray, unlabelled: np.ndarray, prior: float, epochs: int, seed: int
) -> tuple[np.ndarray, float]:
    """Weights of least non-negative risk with the logistic loss, by Adam."""
    draw = np.random.default_rng(seed)
    w = np.zeros(positive.shape[1] + 1)
    first, second, t = np.zeros_like(w), np.zeros_like(w), 0
    one = lambda x: np.hstack([x, np.ones((len(x), 1), x.dtype)])
    positive, unlabelled = one(positive), one(unlabelled)
    batches = max(1, len(unlabelled) // 512)
    for _ in range(epochs):
        of_p = np.array_split(draw.permutation(len(positive)), batches)
        of_u = np.array_split(draw.permutation(len(unlabelled)), batches)
        for p, u in zip(of_p, of_u, strict=True):
            p = p if len(p) else np.arange(len(positive))
            xp, xu = positive[p], unlabelled[u]
            zp, zu = xp @ w, xu @ w
            loss = lambda z: np.logaddexp(0, -z)
            negative = loss(-zu).mean() - prior * loss(-zp).mean()
            of_negative = xu.T @ _sigmoid(zu) / len(xu) - prior * (xp.T @ _sigmoid(zp)) / len(xp)
            of_positive = -prior * (xp.T @ _sigmoid(-zp)) / len(xp)
            # below zero the negatives' risk is an artefact: step back from it
            step = of_positive + of_negative if negative >= 0 else -of_negative
            step = step + 1e-3 * np.append(w[:-1], 0)
            t += 1
            first = 0.9 * first + 0.1 * step
            second = 0.999 * second + 0.001 * step**2
            w -= 0.01 * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-8)
    return w[:-1], float(w[-1])


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """Share of positives among the unlabelled, from margins of texts not fitted on.

    Above any threshold lies at least the prior's share of what the positives have
    there, so the smallest ratio, with room for chance, bounds the prior from above."""
    if not len(positive) or not len(unlabelled):
        return 0.5
    cuts = np.quantile(positive, np.linspace(0.02, 0.9, 45))
    above_p = (positive[:, None] >= cuts).mean(axis=0)
    above_u = (unlabelled[:, None] >= cuts).mean(axis=0)
    chance = np.sqrt(np.log(400) / 2)
    bound = above_u + chance / np.sqrt(len(unlabelled)) + chance / np.sqrt(len(positive))
    best = int(np.argmin(bound / above_p))
    return float(np.clip(above_u[best] / above_p[best], 0.05, 0.95))


def fit(positive: np.ndarray, unlabelled: np.ndarray, epochs: int = 30, seed: int = 3) -> Quality:
    """Model of two sets of feature rows. Without positives every text scores one half.

    Half of either set is fitted against the rest at an even prior, the other half
    gives the prior, then all is fitted anew with it."""
    width = unlabelled.shape[1]
    if not len(positive) or not len(unlabelled):
        return Quality(np.zeros(width), np.ones(width), np.zeros(width), 0.0, 0.5)
    mean = unlabelled.mean(axis=0)
    scale = np.maximum(unlabelled.std(axis=0), 0.02)
    p = np.clip((positive - mean) / scale, -6, 6).astype(np.float64)
    u = np.clip((unlabelled - mean) / scale, -6, 6).astype(np.float64)
    w, b = _descend(p[::2], u[::2], 0.5, epochs, seed)
    prior = estimate_prior(p[1::2] @ w + b, u[1::2] @ w + b)
    w, b = _descend(p, u, prior, epochs, seed)
    return Quality(mean, scale, w, b, prior)


def _feature_rows(texts: DataFrame, limit: int) -> np.ndarray:
    """Features of at most ``limit`` different ``[key, text]`` rows, in order of the key and
    a hash of the text, on the driver."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in T.chunks(batch.column(2)):
                x = features(part)
                values = pa.array([row.tobytes() for row in x], pa.binary())
                keys = [batch.column(i).slice(part.first, len(part)) for i in range(2)]
                yield pa.record_batch([*keys, values], names=["key", "hash", "x"])

    hashed = texts.select("key", F.xxhash64("text").alias("hash"), "text")
    featured = hashed.mapInArrow(rows, "key long, hash long, x binary")
    kept = featured.dropDuplicates(["key", "hash"]).orderBy("key", "hash").limit(limit)
    found = kept.toArrow().sort_by([("key", "ascending"), ("hash", "ascending")])
    if not found.num_rows:
        return np.zeros((0, FEATURES), dtype=np.float32)
    return np.stack([np.frombuffer(x.as_py(), dtype=np.float32) for x in found["x"]])


def train(
    docs: DataFrame,
    labels: DataFrame,
    positives: int = TRAIN_POSITIVES,
    unlabelled: int = TRAIN_UNLABELLED,
    seed: int = 5,
) -> Quality:
    """Model of at most ``positives`` trusted texts and ``unlabelled`` others, those with
    the smallest hash of their id, whose repeated rows count once; held-out rows are not
    among them."""
    key = sampling_key(F.col("doc_id"), seed)
    open_ids = lambda df: df.where(~held_out(F.col("doc_id"))).select(
        "doc_id", key.alias("key")
    )
    trusted = open_ids(labels.where("quality = 1")).distinct().orderBy("key").limit(positives)
    drawn = open_ids(docs).distinct().orderBy("key").limit(unlabelled)
    texts = docs.select("doc_id", "text")
    samples = []
    for ids, limit in ((trusted, positives), (drawn, unlabelled)):
        chosen = F.broadcast(ids)  # bounded by the limit
        samples.append(_feature_rows(texts.join(chosen, "doc_id").select("key", "text"), limit))
    return fit(*samples)


def score_documents(
    docs: DataFrame, model: Quality, carry: list[str] | None = None
) -> DataFrame:
    """``[row, score]``: ``row`` holds the columns ``carry`` of ``docs``, all if not given.
    An empty or null text has a score as any other. A text that is carried goes to the
    tasks once, and rows are handed on a chunk of texts at a time."""
    names = carry or docs.columns
    carried = "text" in names

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row = batch.column("row")
            for part in T.chunks(row.field("text") if carried else batch.column("text")):
                scores = pa.array(model.score(features(part)), pa.float64())
                yield pa.record_batch(
                    [row.slice(part.first, len(part)), scores], names=["row", "score"]
                )

    row = F.struct(*[F.col(f"`{name}`") for name in names])
    plain = docs.select(row.alias("row"), *([] if carried else ["text"]))
    kind = plain.schema["row"].dataType.simpleString()
    return plain.mapInArrow(score, f"row {kind}, score double")


def classify(
    docs: DataFrame,
    labels: DataFrame,
    threshold: float = 0.3,
    carry: list[str] | None = None,
) -> DataFrame:
    """``[row, held_out, score, predicted]`` for each of ``docs``, scored by the text
    alone with a model of trusted positives (``labels.quality = 1``) and unlabelled
    texts; ``carry`` names the columns in ``row`` (``doc_id`` among them), by default all
    of them. Null labels are no labels; repeated rows are scored each for itself; an empty
    table gives no rows."""
    model = train(docs, labels)
    scored = score_documents(docs, model, carry)
    return scored.select(
        "row",
        held_out(F.col("row.doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
