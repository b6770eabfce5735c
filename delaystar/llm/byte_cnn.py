"""Byte-level convolutional quality classifier in numpy.

A document's bytes are cut into chunks of ``CHUNK`` that overlap by ``OVERLAP`` and
together cover all of it.  In each chunk, learned filters over ``WIDTH`` embedded
bytes run at stride ``STRIDE``; every filter keeps its maximum over the chunk, a
hidden layer combines the maxima into the chunk's logit, and the mean logit of all
chunks gives the document's one probability.  Since a filter is linear in embedded
bytes, scoring folds embedding and filter into one table per tap and only looks up
and adds.

Training is plain backpropagation with Adam on chunks of a bounded labelled sample;
only the maxima pass gradients back.

Defined results: null or empty text is one chunk of padding, so it has a score; with
labels of one class only, every score is that class's share (1 without labels); a
text of any length is read whole, in bounded blocks of chunks; equal texts get equal
scores, repeated rows too; a null doc_id is fold 0 (held out) and never learned from; an
empty table gives no rows; other columns, of whatever name, are dropped.  Bytes are the
only input.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaystar.llm.labelled import fold, labelled_samples
from delaystar.llm.tables import map_batches

CHUNK, OVERLAP = 512, 32
WIDTH, STRIDE = 8, 3
EMBED, FILTERS, HIDDEN = 8, 32, 16
#: Byte 256 pads the last chunk; its embedding is learned like the others'.
SYMBOLS, PAD = 257, 256

#: Bounds of training: documents per label, and chunks and short pieces per document.
SAMPLE_PER_CLASS, CHUNKS_PER_DOCUMENT, CROPS_PER_DOCUMENT = 1500, 3, 2
FOLDS, HELD_OUT = 5, 0
EPOCHS, BATCH, RATE, SEED = 12, 64, 3e-3, 7
PREDICT_FROM = 0.3
#: Chunks scored at once: bounds memory whatever the length of a text.
BLOCK = 512

SCHEMA = "doc_id bigint, held_out boolean, score double, predicted int"
_POSITIONS = (CHUNK - WIDTH) // STRIDE + 1


def chunks(raw: bytes) -> np.ndarray:
    """Overlapping chunks that cover all bytes, as symbols; at least one chunk."""
    step = CHUNK - OVERLAP
    n = max(1, -(-(len(raw) - OVERLAP) // step))
    padded = np.full(CHUNK + (n - 1) * step, PAD, np.int16)
    padded[: len(raw)] = np.frombuffer(raw, np.uint8)
    return np.lib.stride_tricks.sliding_window_view(padded, CHUNK)[::step]


def convolve(tables: np.ndarray, block: np.ndarray) -> np.ndarray:
    """Filter responses (chunks, positions, filters) by adding one looked-up row per tap."""
    out = tables[0][block[:, 0 : STRIDE * _POSITIONS : STRIDE]]
    for k in range(1, WIDTH):
        out += tables[k][block[:, k : k + STRIDE * (_POSITIONS - 1) + 1 : STRIDE]]
    return out


@dataclass
class Network:
    """Parameters; ``prior`` replaces them where there was nothing to learn."""

    embed: np.ndarray
    filters: np.ndarray  # (taps, embedding, filters)
    bias: np.ndarray
    hidden: np.ndarray
    hidden_bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray
    prior: float | None = None

    def tables(self) -> np.ndarray:
        return np.einsum("se,kef->ksf", self.embed, self.filters).astype(np.float32)

    def logits(self, block: np.ndarray, tables: np.ndarray) -> np.ndarray:
        pooled = np.maximum(convolve(tables, block).max(1) + self.bias, 0)
        return np.maximum(pooled @ self.hidden + self.hidden_bias, 0) @ self.out + self.out_bias[0]

    def score(self, texts: list[str | None]) -> Iterator[float]:
        """Probability of label 1 for each text, in order."""
        if self.prior is not None:
            yield from (self.prior for _ in texts)
            return
        tables = self.tables()
        for group in _grouped(texts):
            parts = [chunks(t) for t in group]
            sizes = np.array([len(p) for p in parts])
            logits = np.concatenate(
                [self.logits(b, tables) for p in (_stacked(parts)) for b in np.array_split(p, -(-len(p) // BLOCK))]
            )
            mean = np.add.reduceat(logits.astype(np.float64), np.cumsum(sizes) - sizes) / sizes
            yield from (1 / (1 + np.exp(-np.clip(mean, -30, 30)))).tolist()


def _stacked(parts: list[np.ndarray]) -> list[np.ndarray]:
    """Many short texts as one block; a long text stays a view of its own."""
    return [np.concatenate(parts)] if len(parts) > 1 else parts


def _grouped(texts: list[str | None]) -> Iterator[list[bytes]]:
    """Texts in order, in groups of about a block of chunks."""
    group, size = [], 0
    for t in texts:
        raw = (t or "").encode("utf-8", "surrogatepass")
        if group and size + len(raw) > BLOCK * CHUNK // 2:
            yield group
            group, size = [], 0
        group.append(raw)
        size += len(raw)
    if group:
        yield group


def training_chunks(text: str) -> np.ndarray:
    """A bounded number of chunks and short pieces of a document, chosen by a generator seeded by its bytes."""
    raw = text.encode("utf-8", "surrogatepass")
    rng = np.random.default_rng([SEED, zlib.crc32(raw)])
    own = chunks(raw)
    picks = rng.choice(len(own), min(CHUNKS_PER_DOCUMENT, len(own)), replace=False)
    crops = own[rng.integers(len(own), size=CROPS_PER_DOCUMENT)].copy()  # short pieces, so that short documents are no surprise
    for crop in crops:
        crop[int(CHUNK * 24 ** -rng.random()) :] = PAD
    return np.concatenate([own[picks], crops])


def fit(texts: list[str], labels: list[int]) -> Network:
    """Train on chunks of the given documents; deterministic for equal input in equal order."""
    return fit_chunks([training_chunks(t) for t in texts], labels)


def fit_chunks(blocks: list[np.ndarray], labels: list[int]) -> Network:
    """Train on the chunks of each document."""
    rng = np.random.default_rng(SEED)
    init = lambda *shape, scale: rng.normal(0, scale, shape)
    net = Network(
        init(SYMBOLS, EMBED, scale=0.5), init(WIDTH, EMBED, FILTERS, scale=(WIDTH * EMBED) ** -0.5), np.zeros(FILTERS),
        init(FILTERS, HIDDEN, scale=FILTERS**-0.5), np.zeros(HIDDEN), init(HIDDEN, scale=HIDDEN**-0.5), np.zeros(1),
    )
    y = np.array(labels, np.float64)
    if not len(y) or y.min() == y.max():
        net.prior = float(y.mean()) if len(y) else 1.0
        return net
    targets = [label for own, label in zip(blocks, labels, strict=True) for _ in own]
    x, y = np.concatenate(blocks), np.array(targets, np.float64)
    weight = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    names = ("embed", "filters", "bias", "hidden", "hidden_bias", "out", "out_bias")
    moment = {n: (np.zeros_like(getattr(net, n)), np.zeros_like(getattr(net, n))) for n in names}
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(x))
        for at in range(0, len(x), BATCH):
            rows = order[at : at + BATCH]
            step += 1
            for n, g in _gradients(net, x[rows], y[rows], weight[rows]).items():
                m, v = moment[n]
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                scaled = RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
                setattr(net, n, getattr(net, n) - scaled)
    return net


def _gradients(net: Network, block: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
    responses = convolve(net.tables(), block)
    best = responses.argmax(1)  # (chunks, filters): where each filter has its maximum
    pooled_in = np.take_along_axis(responses, best[:, None], 1)[:, 0] + net.bias
    pooled = np.maximum(pooled_in, 0)
    hidden_in = pooled @ net.hidden + net.hidden_bias
    hidden = np.maximum(hidden_in, 0)
    p = 1 / (1 + np.exp(-np.clip(hidden @ net.out + net.out_bias[0], -30, 30)))
    d_logit = weight * (p - y) / len(y)
    d_hidden = np.outer(d_logit, net.out) * (hidden_in > 0)
    d_pooled = (d_hidden @ net.hidden.T) * (pooled_in > 0)
    d_embed, d_filters = np.zeros_like(net.embed), np.zeros_like(net.filters)
    rows = np.arange(len(block))[:, None]
    for k in range(WIDTH):
        symbol = block[rows, best * STRIDE + k].astype(np.int64)  # (chunks, filters)
        table = np.zeros((SYMBOLS, FILTERS))
        np.add.at(table, (symbol, np.arange(FILTERS)[None, :]), d_pooled)
        d_filters[k] = net.embed.T @ table
        d_embed += table @ net.filters[k].T
    return {
        "embed": d_embed, "filters": d_filters, "bias": d_pooled.sum(0), "hidden": pooled.T @ d_hidden,
        "hidden_bias": d_hidden.sum(0), "out": hidden.T @ d_logit, "out_bias": np.array([d_logit.sum()]),
    }


def train(documents: DataFrame, labels: DataFrame) -> Network:
    """Network of a bounded sample of labelled documents, cut in tasks; the held-out fold takes no part."""

    def cut(text: str) -> bytes:
        return training_chunks(text).tobytes()

    sample = labelled_samples(documents, labels, "quality", SAMPLE_PER_CLASS, FOLDS, HELD_OUT, cut)
    return fit_chunks([np.frombuffer(c, np.int16).reshape(-1, CHUNK) for c, _ in sample], [int(q) for _, q in sample])


def score_documents(documents: DataFrame, net: Network) -> DataFrame:
    """doc_id, held_out, score, predicted of every row; other columns are dropped.  Map-only."""

    def rows(batch: pa.RecordBatch) -> dict:
        scores = list(net.score(batch.column("text").to_pylist()))
        return {
            "doc_id": batch.column("doc_id"), "held_out": batch.column("held_out"),
            "score": scores, "predicted": [int(s >= PREDICT_FROM) for s in scores],
        }

    held_out = (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out")
    return map_batches(documents.select("doc_id", "text", held_out), rows, SCHEMA)
