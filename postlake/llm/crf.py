"""Document quality from a linear-chain conditional random field over lines.

Every line is good or bad.  Its score comes from its own features and those
of the lines before and after it; a transition table ties neighbouring
labels.  Forward-backward marginals, weighted by line length, average to the
document's quality.

The field is fitted on the driver on a bounded sample (``fit_docs``
documents, picked by a hash of the id, and of a longer one a run of
``fit_lines`` lines that begins at a hash of the id): a labelled document gives its label to its lines; Adam climbs the conditional
likelihood.  Plan of the scoring: one scan without shuffle; features are
byte counts per line by numpy, the recursions run over all documents of a
batch at once.  The fitted field is a few hundred numbers.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DoubleType

from postlake.llm.common import mix64, pieces, span_hashes, table, utf8, with_fields, without, word_bounds

FIT_DOCS, FIT_LINES, STEPS = 4000, 400, 200
THRESHOLD = 0.7
_PIECE = 2 << 20


def _class(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[np.frombuffer(chars, np.uint8)] = True
    return out


_UPPER, _DIGIT = _class(bytes(range(65, 91))), _class(b"0123456789")
_SYMBOL, _STOP = _class(b"*#%$&@~^=_+<>{}[]\\/"), _class(b".,;:?")
N_FEATURES = 14


def line_features(offsets: np.ndarray, data: np.ndarray):
    """(features float32, line bytes, first line of each document, lines of each document)."""
    feeds = np.flatnonzero(data == 10)
    feed_doc = np.searchsorted(offsets, feeds, "right") - 1
    n_docs = len(offsets) - 1
    count = np.bincount(feed_doc, minlength=n_docs) + 1
    starts = np.sort(np.concatenate([offsets[:-1], feeds + 1]), kind="stable")
    n = len(starts)
    first = np.concatenate([[0], np.cumsum(count)])[:-1]
    last = first + count - 1
    ends = np.empty(n, np.int64)
    ends[:-1] = starts[1:] - 1
    ends[last] = offsets[1:]
    size = ends - starts

    def of(flags):
        sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return (sums[ends] - sums[starts]).astype(np.float64)

    after = np.append(data[1:], 0)
    accented = (data == 0xC3) & (after >= 0x80) & (after <= 0x9E)
    upper = of(_UPPER[data] | accented)
    wstart, wend, _ = word_bounds(offsets, data)
    wline = np.searchsorted(starts, wstart, "right") - 1
    # a word that starts where several empty lines do belongs to the last of them, as searchsorted has it
    words = np.bincount(wline, minlength=n).astype(np.float64)
    hashes = span_hashes(data, wstart, wend)
    same = np.zeros(len(wstart), bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (wline[1:] == wline[:-1])
    _, one = np.unique(mix64(hashes ^ (wline.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))), return_index=True)
    distinct = np.bincount(wline[one], minlength=n)
    head = (_UPPER[data] | accented)[wstart] if len(wstart) else np.zeros(0, bool)
    per_word, per_byte = np.maximum(words, 1), np.maximum(size, 1)
    closing = np.zeros(n)
    full = size > 0
    closing[full] = np.isin(data[ends[full] - 1], np.frombuffer(b".!?", np.uint8))
    columns = [np.log1p(size) / 8, upper / per_byte, of(_DIGIT[data]) / per_byte, of(data == 33) / per_word,
               of(_SYMBOL[data]) / per_word, of(data == 124) / per_word, of(_STOP[data]) / per_word,
               np.bincount(wline[same], minlength=n) / per_word, size / per_word / 10,
               np.bincount(wline[head], minlength=n) / per_word, of(data >= 0x80) / per_byte, closing,
               distinct / per_word, size == 0]
    return np.minimum(np.stack(columns, 1), 3).astype(np.float32), size, first, count


def neighbours(own: np.ndarray, first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Each line's features beside those of the lines before and after it, and whether there are such lines."""
    n = len(own)
    starts, ends = np.zeros(n, bool), np.zeros(n, bool)
    starts[first], ends[first + count - 1] = True, True
    before, after = np.roll(own, 1, 0), np.roll(own, -1, 0)
    before[starts], after[ends] = 0, 0
    return np.concatenate([own, before, after, starts[:, None], ends[:, None]], 1).astype(np.float64)


@dataclass
class Field:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # of state good; state bad scores 0
    bias: float
    links: np.ndarray  # (2, 2) from, to

    def unary(self, own: np.ndarray, first: np.ndarray, count: np.ndarray) -> np.ndarray:
        """What ``neighbours`` of ``own`` score, from a few numbers a line: no line's neighbours are laid beside it."""
        slope = self.weights / self.scale
        own_part, before, after = (own @ slope[:3 * N_FEATURES].reshape(3, N_FEATURES).T).T
        out = own_part + (self.bias - self.mean @ slope)
        out[1:] += before[:-1]
        out[:-1] += after[1:]
        # no line stands before a document's first one, or after its last
        last = first + count - 1
        out[first[1:]] -= before[first[1:] - 1]
        out[last[:-1]] -= after[last[:-1] + 1]
        out[first] += slope[-2]
        out[last] += slope[-1]
        return out


def marginals(unary: np.ndarray, links: np.ndarray, first: np.ndarray, count: np.ndarray):
    """P(good) of every line, and the log messages (forward, backward) of both states."""
    n = len(unary)
    ahead, back = np.zeros((n, 2)), np.zeros((n, 2))
    emit = np.stack([np.zeros(n), unary], 1)
    order = np.argsort(-count, kind="stable")
    first, count = first[order], count[order]
    live = np.searchsorted(-count, -np.arange(count[0] if len(count) else 0), "left")
    for t, m in enumerate(live):
        at = first[:m] + t
        if t == 0:
            ahead[at] = emit[at]
        else:
            a = ahead[at - 1]
            ahead[at] = np.logaddexp(a[:, :1] + links[0], a[:, 1:] + links[1]) + emit[at]
    for t, m in enumerate(live):
        if t:
            at = first[:m] + count[:m] - 1 - t
            b = back[at + 1] + emit[at + 1]
            back[at] = np.logaddexp(b[:, :1] + links[:, 0], b[:, 1:] + links[:, 1])
    odds = (ahead[:, 1] + back[:, 1]) - (ahead[:, 0] + back[:, 0])
    return 1 / (1 + np.exp(-np.clip(odds, -500, 500))), ahead, back


def fit_field(own: np.ndarray, count: np.ndarray, label: np.ndarray, steps: int = STEPS, ridge: float = 1e-3) -> Field:
    """A field for documents of ``count`` lines each, whose lines all have the document's label (0 or 1)."""
    k = 3 * N_FEATURES + 2
    field = Field(np.zeros(k), np.ones(k), np.zeros(k), 0.0, np.zeros((2, 2)))
    if len(count) == 0:
        return field
    first = np.concatenate([[0], np.cumsum(count)])[:-1]
    x = neighbours(own, first, count)
    field.mean, field.scale = x.mean(0), np.maximum(x.std(0), 1e-3)
    z = np.concatenate([(x - field.mean) / field.scale, np.ones((len(x), 1))], 1)
    y = np.repeat(label.astype(np.float64), count)
    weight = np.repeat(1 / len(count) / count, count)  # documents weigh alike, and their lines share that
    inner = np.ones(len(x), bool)
    inner[first + count - 1] = False
    at = np.flatnonzero(inner)
    seen = np.zeros((2, 2))
    for v in (0, 1):
        seen[v, v] = weight[at][y[at] == v].sum()
    theta, m, v = np.zeros(k + 5), np.zeros(k + 5), np.zeros(k + 5)
    for step in range(1, steps + 1):
        unary, links = z @ theta[:k + 1], theta[k + 1:].reshape(2, 2)
        p, ahead, back = marginals(unary, links, first, count)
        grad = np.empty_like(theta)
        grad[:k + 1] = z.T @ (weight * (y - p))
        emit = np.stack([np.zeros(len(at)), unary[at + 1]], 1)
        joint = ahead[at][:, :, None] + links + (emit + back[at + 1])[:, None, :]
        top = joint.max((1, 2), keepdims=True)
        joint = np.exp(joint - top)
        joint *= (weight[at] / joint.sum((1, 2)))[:, None, None]
        grad[k + 1:] = (seen - joint.sum(0)).ravel()
        grad -= ridge * theta
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        theta += 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    field.weights, field.bias, field.links = theta[:k], float(theta[k]), theta[k + 1:].reshape(2, 2)
    return field


def score_texts(field: Field, offsets: np.ndarray, data: np.ndarray) -> np.ndarray:
    if len(offsets) < 2:
        return np.zeros(0)
    own, size, first, count = line_features(offsets, data)
    p, _, _ = marginals(field.unary(own, first, count), field.links, first, count)
    weight = size + 1.0
    return np.clip(np.add.reduceat(p * weight, first) / np.add.reduceat(weight, first), 0, 1)


def _run_of(own: np.ndarray, doc_id: int, fit_lines: int) -> np.ndarray:
    """The lines of a document that are fitted: all, or a run of ``fit_lines`` that its id picks."""
    spare = len(own) - fit_lines
    if spare <= 0:
        return own
    at = int(mix64(np.array([doc_id], np.int64).view(np.uint64))[0] % np.uint64(spare + 1))
    return own[at:at + fit_lines]


def _features(text_col: str, fit_lines: int):
    def run(batches):
        for batch in batches:
            for piece in pieces(batch, text_col, _PIECE):
                own, _, first, count = line_features(*utf8(piece.column(text_col)))
                ids = piece.column("doc_id").cast(pa.int64()).to_pylist()
                rows = [_run_of(own[a:a + c], i, fit_lines).tobytes() for i, a, c in zip(ids, first, count, strict=True)]
                yield pa.record_batch({"doc_id": piece.column("doc_id"), "quality": piece.column("quality"),
                                       "lines": pa.array(rows, pa.binary())})
    return run


def fit(docs: DataFrame, labels: DataFrame, fit_docs: int = FIT_DOCS, steps: int = STEPS,
        fit_lines: int = FIT_LINES) -> Field:
    """A field from ``docs`` (doc_id, text) and ``labels`` (doc_id, quality), a row each of the sample.

    At most ``fit_docs`` x ``fit_lines`` lines (56 bytes each) reach the driver.

    Labels of one document are averaged and rounded (a half is good); null
    labels and ids are left out.  Without any label every score is one half;
    with one kind of label the field leans to that one.
    """
    some = (labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id")
            .agg((F.avg("quality") >= 0.5).cast("int").alias("quality"))
            .orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_docs))
    found = docs.select("doc_id", "text").join(F.broadcast(some), "doc_id").select("doc_id", "quality", "text")
    schema = with_fields(found.select("doc_id", "quality").schema, ("lines", BinaryType()))
    rows = (found.mapInArrow(_features("text", fit_lines), schema)
            .orderBy(F.xxhash64("doc_id"), "doc_id", "lines").limit(fit_docs).collect())
    own = [np.frombuffer(r.lines, np.float32).reshape(-1, N_FEATURES) for r in rows]
    return fit_field(np.concatenate(own) if own else np.zeros((0, N_FEATURES), np.float32),
                     np.array([len(o) for o in own], np.int64), np.array([r.quality for r in rows], np.int64), steps)


def _score(field: Field, text_col: str, keep_text: bool):
    def run(batches):
        for batch in batches:
            for piece in pieces(batch, text_col, _PIECE):
                yield pa.record_batch({c: piece.column(c) for c in piece.schema.names if keep_text or c != text_col}
                                      | {"score": pa.array(score_texts(field, *utf8(piece.column(text_col))))})
    return run


def quality(docs: DataFrame, field: Field, text_col: str = "text", keep_text: bool = True) -> DataFrame:
    """``docs`` with ``score``: 0 to 1, the length-weighted probability that its lines are good.

    Only the text enters.  Null or empty text: one empty line.  Rows that
    repeat score alike; a column ``score`` of the input is replaced; empty
    table: no rows.
    """
    docs = without(docs, "score")
    kept = docs if keep_text else docs.drop(text_col)
    return docs.mapInArrow(_score(field, text_col, keep_text), with_fields(kept.schema, ("score", DoubleType())))


def fold_of(doc_id):
    """The remainder that keeps documents apart: crc32 of the id as text, modulo 4."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 4


def op6(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(fold_of(F.col("doc_id")) != 2)
    scored = quality(docs, fit(docs, labels), keep_text=False)
    return scored.select("doc_id", (fold_of(F.col("doc_id")) == 2).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
