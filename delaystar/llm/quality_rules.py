"""Quality rules: document statistics judged by monotone gradient-boosted trees.

Statistics are taken over whole texts.  The trees are grown here by histograms of
gradients (depth ``DEPTH``) on a bounded labelled sample, with monotonic
constraints: more symbols, repeated lines, repeated words, repeated neighbours or
exclamation marks never raise a score, more distinct words never lower it.  All
trees are flattened into numpy node arrays and scored level by level for a batch.

Defined results: null or empty text has no words, hence ``base_failed`` and not
kept; without labels of both classes there are no trees and the base rules decide
alone; rows are judged one by one, so repeated rows get equal results; texts of any length
are judged whole; a null doc_id passes through and is never learned from; an empty table
gives no rows; other columns, of whatever name, are dropped (kept by the filter).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaystar.llm.labelled import labelled_samples
from delaystar.llm.tables import fresh_name, map_batches

#: FIXED VALUES of the base rules.
SYMBOLS = b"#*$%&|<>"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20

#: Bound of the training sample: documents per label.
SAMPLE_PER_CLASS = 1500
FOLDS, HELD_OUT = 5, 0
TREES, DEPTH, RATE, BINS, MIN_LEAF, RIDGE = 40, 3, 0.3, 64, 5, 1.0
KEEP_FROM = 0.5

#: Features and the direction in which they may move the score (0: free).
FEATURES = (
    ("log_words", 0), ("word_length", 0), ("symbols_per_word", -1), ("dup_lines", -1), ("repeat_words", -1),
    ("repeat_neighbours", -1), ("exclamations_per_word", -1), ("upper", 0), ("distinct_words", 1), ("digits", 0),
)

BASE_SCHEMA = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, "
    "kept boolean, score double"
)

_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def repeat_words(words: list[bytes], hashes: np.ndarray) -> int:
    """Words inside windows of five words that occur twice or more.  Hashes find candidates, the words decide."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    window = np.zeros(n, np.uint64)
    for k in range(WINDOW):
        window += hashes[k : k + n] * _ODD[k]
    order = np.argsort(window, kind="stable")
    ranked = window[order]
    same = ranked[1:] == ranked[:-1]
    if not same.any():
        return 0
    covered = np.zeros(len(words) + 1, np.int64)
    candidates = order[np.concatenate([same, [False]]) | np.concatenate([[False], same])]
    seen: dict[tuple, list[int]] = {}
    for i in candidates.tolist():
        seen.setdefault(tuple(words[i : i + WINDOW]), []).append(i)
    for places in seen.values():
        if len(places) > 1:
            for i in places:
                covered[i] += 1
                covered[i + WINDOW] -= 1
    return int((np.cumsum(covered)[:-1] > 0).sum())


def statistics(text: str) -> tuple[tuple[int, ...], list[float]]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) and the feature vector of a text."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()  # bytes split at exactly the six white-space bytes
    n = len(words)
    blank = len(raw) - sum(map(len, words))
    word_chars = len(text) - blank
    n_symbols = sum(raw.count(c) for c in SYMBOLS)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    n_dup_lines = len(lines) - len(set(lines))
    hashes = np.fromiter(map(hash, words), np.int64, n).view(np.uint64)
    n_repeat = repeat_words(words, hashes)
    at_least = max(n, 1)
    octets = np.frombuffer(raw, np.uint8)
    features = [
        float(np.log1p(n)), word_chars / at_least, n_symbols / at_least, n_dup_lines / max(len(lines), 1), n_repeat / at_least,
        float((hashes[1:] == hashes[:-1]).sum()) / at_least, raw.count(b"!") / at_least,
        float(((octets >= 65) & (octets <= 90)).sum()) / max(len(raw), 1), len(set(words)) / at_least,
        float(((octets >= 48) & (octets <= 57)).sum()) / max(len(raw), 1),
    ]
    return (n, word_chars, n_symbols, n_dup_lines, n_repeat), features


def base_failed(n_words: int, n_repeat_words: int) -> bool:
    return n_words < MIN_WORDS or 100 * n_repeat_words > MAX_REPEAT_PERCENT * n_words


@dataclass(frozen=True)
class Forest:
    """All trees in flat arrays; a leaf points to itself on both sides."""

    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    base: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row of ``x``."""
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for root in self.roots:
            node = np.full(len(x), root)
            for _ in range(DEPTH):
                low = x[rows, self.feature[node]] <= self.threshold[node]
                node = np.where(low, self.left[node], self.right[node])
            total += self.value[node]
        return 1 / (1 + np.exp(-total))


def grow(x: np.ndarray, y: np.ndarray) -> Forest:
    """Boost trees on the logistic loss with per-feature monotonic constraints."""
    nodes: list[list] = []  # feature, threshold, left, right, value
    roots: list[int] = []
    both = len(y) > 0 and 0 < y.mean() < 1
    base = float(np.log(y.mean() / (1 - y.mean()))) if both else 4.0
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS)[1:-1])) for f in range(x.shape[1])] if both else []
    binned = np.stack([np.searchsorted(e, x[:, f], "left") for f, e in enumerate(edges)], 1) if both else None
    total = np.full(len(y), base)

    def leaf(value: float) -> int:
        nodes.append([0, np.inf, len(nodes), len(nodes), RATE * value])
        return len(nodes) - 1

    def split(rows: np.ndarray, g: np.ndarray, h: np.ndarray, low: float, high: float, depth: int) -> int:
        sum_g, sum_h = g[rows].sum(), h[rows].sum()
        own = float(np.clip(sum_g / (sum_h + RIDGE), low, high))
        best = (1e-6, None)
        for f, e in enumerate(edges) if depth < DEPTH and len(rows) >= 2 * MIN_LEAF else ():
            if not len(e):
                continue
            part = binned[rows, f]
            gl = np.cumsum(np.bincount(part, g[rows], len(e) + 1))[:-1]
            hl = np.cumsum(np.bincount(part, h[rows], len(e) + 1))[:-1]
            nl = np.cumsum(np.bincount(part, minlength=len(e) + 1))[:-1]
            wl = np.clip(gl / (hl + RIDGE), low, high)
            wr = np.clip((sum_g - gl) / (sum_h - hl + RIDGE), low, high)
            quality = lambda w, gg, hh: gg * w - 0.5 * (hh + RIDGE) * w * w
            gain = quality(wl, gl, hl) + quality(wr, sum_g - gl, sum_h - hl) - quality(own, sum_g, sum_h)
            allowed = (nl >= MIN_LEAF) & (len(rows) - nl >= MIN_LEAF)
            direction = FEATURES[f][1]
            if direction:
                allowed &= direction * (wr - wl) >= 0
            gain = np.where(allowed, gain, -np.inf)
            k = int(np.argmax(gain))
            if gain[k] > best[0]:
                best = (float(gain[k]), (f, k, float(wl[k]), float(wr[k])))
        if best[1] is None:
            return leaf(own)
        f, k, wl, wr = best[1]
        middle, direction = (wl + wr) / 2, FEATURES[f][1]
        # Below a constrained split each side keeps to its half, so later splits cannot undo the order.
        bounds = {0: ((low, high), (low, high)), 1: ((low, middle), (middle, high)), -1: ((middle, high), (low, middle))}
        goes_left = binned[rows, f] <= k
        at = len(nodes)
        nodes.append([f, edges[f][k], 0, 0, 0.0])
        nodes[at][2] = split(rows[goes_left], g, h, *bounds[direction][0], depth + 1)
        nodes[at][3] = split(rows[~goes_left], g, h, *bounds[direction][1], depth + 1)
        return at

    for _ in range(TREES if both else 0):
        p = 1 / (1 + np.exp(-total))
        first = len(nodes)
        roots.append(split(np.arange(len(y)), y - p, p * (1 - p), -np.inf, np.inf, 0))
        tree = Forest(np.array([roots[-1]]), *_columns(nodes), 0.0)
        odds = tree.score(x)
        total += np.log(odds / (1 - odds))
        assert first <= roots[-1] < len(nodes)
    return Forest(np.array(roots, np.int64), *_columns(nodes), base)


def _columns(nodes: list[list]) -> tuple[np.ndarray, ...]:
    kinds = (np.int64, np.float64, np.int64, np.int64, np.float64)
    return tuple(np.array([n[i] for n in nodes], k) for i, k in enumerate(kinds))


def train(documents: DataFrame, labels: DataFrame) -> Forest:
    """Trees from a bounded sample (``SAMPLE_PER_CLASS`` documents per label, fold 0 held out), their statistics taken in tasks."""

    def features(text: str) -> bytes:
        return np.array(statistics(text)[1], np.float64).tobytes()

    sample = labelled_samples(documents, labels, "quality", SAMPLE_PER_CLASS, FOLDS, HELD_OUT, features)
    x = np.frombuffer(b"".join(f for f, _ in sample), np.float64).reshape(len(sample), len(FEATURES))
    return grow(x, np.array([q for _, q in sample], np.float64))


def judge(texts: list[str | None], forest: Forest) -> dict[str, list]:
    """The columns of ``BASE_SCHEMA`` for a batch of texts."""
    found = [statistics(t or "") for t in texts]
    scores = forest.score(np.array([f for _, f in found], np.float64)).tolist()
    failed = [base_failed(s[0], s[4]) for s, _ in found]
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return {k: [s[i] for s, _ in found] for i, k in enumerate(names)} | {
        "base_failed": failed,
        "kept": [not bad and p >= KEEP_FROM for bad, p in zip(failed, scores, strict=True)],
        "score": scores,
    }


def judge_documents(documents: DataFrame, forest: Forest) -> DataFrame:
    """doc_id with the columns of ``BASE_SCHEMA``; other columns are dropped.  Map-only."""

    def rows(batch: pa.RecordBatch) -> dict:
        return {"doc_id": batch.column("doc_id")} | judge(batch.column("text").to_pylist(), forest)

    return map_batches(documents.select("doc_id", "text"), rows, f"doc_id bigint, {BASE_SCHEMA}")


def keep_documents(documents: DataFrame, forest: Forest) -> DataFrame:
    """The rows of ``documents`` that are kept, all columns as they are."""

    def kept(texts: pd.Series) -> pd.Series:
        return pd.Series(judge(texts.tolist(), forest)["kept"], dtype=bool)

    verdict = F.pandas_udf(kept, "boolean")
    name = fresh_name(documents, "kept")
    columns = [F.col(f"`{c}`") for c in documents.columns]
    return documents.withColumn(name, verdict("text")).where(F.col(name)).select(*columns)

