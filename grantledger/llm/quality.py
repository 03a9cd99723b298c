"""Document quality from a linear-chain conditional random field over lines."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grantledger.llm.common import bounded_batches, seeded, with_fields
from grantledger.llm.hashing import joined_bytes, word_hashes

SEED = 6
#: The classifier is fitted on whole labelled documents, at most so many and with so many lines together.
SAMPLE_DOCS = 4000
SAMPLE_LINES = 800_000
STEPS = 300
THRESHOLD = 0.7

# classes of bytes
LOWER, UPPER, DIGIT, BLANK, STOP, BANG, MARKUP, HIGH, OTHER = range(9)
CLASSES = 9


def _classes() -> np.ndarray:
    kinds = np.full(256, OTHER, np.int64)
    kinds[97:123], kinds[65:91], kinds[48:58] = LOWER, UPPER, DIGIT
    kinds[[9, 11, 12, 13, 32]] = BLANK
    kinds[[ord(c) for c in ".,;:'\"()-"]] = STOP
    kinds[[ord(c) for c in "!?"]] = BANG
    kinds[[ord(c) for c in "<>{}[]|\\/=_~^"]] = MARKUP
    kinds[128:] = HIGH
    kinds[10] = CLASSES  # ends a line and counts for none
    return kinds


KIND_OF = _classes()
IN_WORD = ~np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
FEATURES = CLASSES + 9


def batch_lines(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lines of a column of texts: first line of each document (and the end), lengths, own features.

    Every document has a line at least; null counts as empty.
    """
    data, ends = joined_bytes(column)  # with a line break at the end of each document too
    stop = np.flatnonzero(data == 10)
    start = np.concatenate([[0], stop[:-1] + 1])
    length = stop - start
    first = np.concatenate([[0], np.searchsorted(stop, ends) + 1])
    n = len(stop)
    line = np.repeat(np.arange(n), length + 1)
    counts = np.bincount(line * (CLASSES + 1) + KIND_OF[data], minlength=n * (CLASSES + 1))
    counts = counts.reshape(n, CLASSES + 1)[:, :CLASSES].astype(np.float64)
    size = np.maximum(length, 1)[:, None]
    share = counts / size
    words = counts[:, BLANK] + 1
    ended = np.where(length > 0, data[np.maximum(stop - 1, 0)], 0)
    began = np.where(length > 0, data[start], 0)
    at, _, word = word_hashes(data, IN_WORD)
    where = line[at]
    again = np.zeros(len(at), bool)
    again[1:] = (word[1:] == word[:-1]) & (where[1:] == where[:-1])
    repeats = np.bincount(where[again], minlength=n)
    letters = counts[:, LOWER] + counts[:, UPPER] + counts[:, HIGH]
    own = np.column_stack(
        [
            share,
            np.log1p(length) / 8,
            length == 0,
            np.minimum(length / words / 10, 3),
            np.isin(ended, np.frombuffer(b".!?\"'", np.uint8)),
            (began >= 65) & (began <= 90),
            counts[:, UPPER] / np.maximum(letters, 1),
            np.log1p(counts[:, BANG] + counts[:, MARKUP] + counts[:, OTHER]) / 4,
            (counts[:, MARKUP] + counts[:, OTHER] + counts[:, BANG]) / words,
            repeats / words,
        ]
    )
    return first, length, own


def with_neighbours(first: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Each line's features, those of the line before and of the line after (zero beyond a document)."""
    before, after = np.zeros_like(own), np.zeros_like(own)
    before[1:], after[:-1] = own[:-1], own[1:]
    starts = first[:-1]
    before[starts], after[first[1:] - 1] = 0, 0
    return np.hstack([own, before, after])


def chain(first: np.ndarray, odds: np.ndarray, links: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward and backward log odds of "good" for all lines; documents step together, the longest first.

    `links` has the log potentials of neighbouring labels, [before][after].
    """
    sizes = np.diff(first)
    order = np.argsort(-sizes, kind="stable")
    sizes, starts = sizes[order], first[:-1][order]
    active = np.searchsorted(-sizes, -np.arange(1, (sizes[0] if len(sizes) else 0) + 1), side="right")
    forward, backward = odds.copy(), np.zeros_like(odds)
    (bb, bg), (gb, gg) = links
    for t in range(1, len(active)):
        at = starts[: active[t]] + t
        r = forward[at - 1]
        forward[at] += np.logaddexp(gg + r, bg) - np.logaddexp(gb + r, bb)
    for t in range(1, len(active)):
        at = starts[: active[t]] + sizes[: active[t]] - 1 - t
        r = odds[at + 1] + backward[at + 1]
        backward[at] = np.logaddexp(gg + r, gb) - np.logaddexp(bg + r, bb)
    return forward, backward


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(x / 2))


@dataclass(frozen=True)
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float
    links: np.ndarray
    slope: float
    offset: float

    def marginals(self, first: np.ndarray, own: np.ndarray) -> np.ndarray:
        """The chance of "good" for each line, given all lines of its document."""
        x = (with_neighbours(first, own) - self.mean) / self.scale
        forward, backward = chain(first, x @ self.weights + self.bias, self.links)
        return _sigmoid(forward + backward)

    def scores(self, first: np.ndarray, length: np.ndarray, own: np.ndarray) -> np.ndarray:
        return _sigmoid(self.slope * _share(first, length, self.marginals(first, own)) + self.offset)


def _share(first: np.ndarray, length: np.ndarray, good: np.ndarray) -> np.ndarray:
    """The part of each document that is good, lines weighing by their length; 0 for an empty one."""
    weight = np.add.reduceat(length, first[:-1]) if len(first) > 1 else np.zeros(0)
    held = np.add.reduceat(length * good, first[:-1]) if len(first) > 1 else np.zeros(0)
    return held / np.maximum(weight, 1)


def fit(first: np.ndarray, length: np.ndarray, own: np.ndarray, label: np.ndarray, steps: int = STEPS) -> Model:
    """Conditional likelihood by gradient steps; lines take their document's label.

    Without both labels every document gets their share as its score.
    """
    x = with_neighbours(first, own)
    width = x.shape[1]
    if len(set(label.tolist())) < 2:
        share = min(max(float(np.mean(label)) if len(label) else 0.5, 1e-6), 1 - 1e-6)
        return Model(
            np.zeros(width), np.ones(width), np.zeros(width), 0.0, np.zeros((2, 2)), 0.0, float(np.log(share / (1 - share)))
        )
    mean, scale = x.mean(0), np.maximum(x.std(0), 1e-3)
    x = (x - mean) / scale
    y = np.repeat(label.astype(np.float64), np.diff(first))
    inner = np.ones(len(y), bool)
    inner[first[1:] - 1] = False
    left = np.flatnonzero(inner)
    # [bias, weights, links] with Adam's moments
    theta = np.zeros(1 + width + 4)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    pair_y = np.stack([(1 - y[left]) * (1 - y[left + 1]), (1 - y[left]) * y[left + 1],
                       y[left] * (1 - y[left + 1]), y[left] * y[left + 1]], 1).sum(0)
    for step in range(1, steps + 1):
        odds, links = x @ theta[1 : 1 + width] + theta[0], theta[1 + width :].reshape(2, 2)
        forward, backward = chain(first, odds, links)
        miss = y - _sigmoid(forward + backward)
        ahead = odds[left + 1] + backward[left + 1]
        logs = np.stack([np.full(len(left), links[0, 0]), links[0, 1] + ahead, links[1, 0] + forward[left],
                         links[1, 1] + forward[left] + ahead], 1)
        chance = np.exp(logs - logs.max(1, keepdims=True))
        chance /= chance.sum(1, keepdims=True)
        grad = np.concatenate([[miss.sum()], x.T @ miss, pair_y - chance.sum(0)]) / len(y) - 1e-4 * theta
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        theta = theta + 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    model = Model(mean, scale, theta[1 : 1 + width], float(theta[0]), theta[1 + width :].reshape(2, 2), 1.0, 0.0)
    slope, offset = _calibrate(_share(first, length, model.marginals(first, own)), label)
    return Model(model.mean, model.scale, model.weights, model.bias, model.links, slope, offset)


def _calibrate(share: np.ndarray, label: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """A logistic curve from the good part of a document to its label, with a small penalty on its slope."""
    x = np.column_stack([share, np.ones_like(share)])
    beta = np.zeros(2)
    for _ in range(rounds):
        p = _sigmoid(x @ beta)
        hessian = (x * (p * (1 - p))[:, None]).T @ x + np.diag([1e-2, 1e-3])
        beta = beta + np.linalg.solve(hessian, x.T @ (label - p) - np.array([1e-2, 1e-3]) * beta)
    return float(beta[0]), float(beta[1])


def held_out(key: str = "doc_id"):
    """Rows never learnt from: crc32 of the id, as text, leaves 2 when divided by 4."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % 4 == 2


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        first, length, own = batch_lines(batch.column("text"))
        spans = list(zip(first[:-1], first[1:], strict=True))
        yield pa.RecordBatch.from_pydict(
            {
                "quality": batch.column("quality"),
                "lengths": pa.array([length[a:b].tolist() for a, b in spans], pa.list_(pa.int64())),
                "own": pa.array([own[a:b].astype(np.float32).tobytes() for a, b in spans], pa.binary()),
            }
        )


def train(
    docs: DataFrame, labels: DataFrame, sample: int = SAMPLE_DOCS, lines: int = SAMPLE_LINES, seed: int = SEED
) -> Model:
    """A model from at most `sample` labelled documents that are not held out, with `lines` lines together.

    The sample goes by a seeded hash of the id and ends before the document that
    is too much, but has one at least; all lines of its documents are learnt
    from. Rows with a null id or a null label are not. It alone reaches the
    driver, as numbers.
    """
    bounded_batches(docs.sparkSession)
    known = labels.where(~held_out() & F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
    drawn = known.select("doc_id", F.col("quality").cast("int").alias("quality")).dropDuplicates(["doc_id"])
    drawn = drawn.orderBy(seeded(seed, F.col("doc_id")), "doc_id").limit(sample)
    # at most `sample` rows of two numbers
    chosen = docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id")
    held = F.regexp_count(F.coalesce("text", F.lit("")), F.lit("\n")) + 1
    sizes = chosen.groupBy("doc_id").agg(F.sum(held).alias("n")).orderBy(seeded(seed, F.col("doc_id")), "doc_id").collect()
    upto = np.cumsum([r.n for r in sizes])
    if len(sizes) and upto[-1] > lines:
        last = sizes[max(int(np.searchsorted(upto, lines, side="right")) - 1, 0)].doc_id
        place = lambda doc: F.struct(seeded(seed, doc), doc)
        chosen = chosen.where(place(F.col("doc_id")) <= place(F.lit(last).cast(docs.schema["doc_id"].dataType)))
    chosen = chosen.select("quality", "text")
    rows = chosen.mapInArrow(_featured, "quality int, lengths array<bigint>, own binary").collect()
    rows.sort(key=lambda r: (r.quality, bytes(r.own)))
    sizes = [len(r.lengths) for r in rows]
    own = np.frombuffer(b"".join(bytes(r.own) for r in rows), np.float32).astype(np.float64).reshape(-1, FEATURES)
    length = np.array([n for r in rows for n in r.lengths], np.float64)
    label = np.array([r.quality for r in rows], np.float64)
    return fit(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64), length, own, label)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """`docs` with `score`, the chance of good quality from 0 to 1.

    Nothing but the text is looked at. A null text counts as empty; an empty
    document has no good part. Other columns pass through, a column named
    `score` is replaced, an empty table gives an empty table.
    """
    bounded_batches(docs.sparkSession)
    rows = docs.drop("score")

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            found = model.scores(*batch_lines(batch.column("text")))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found, pa.float64())], names=[*batch.schema.names, "score"]
            )

    return rows.mapInArrow(scored, with_fields(rows.schema, ("score", "double")))
