"""Periodic runs of words, found with a recompression grammar.

A run is a stretch of words with smallest period ``q`` and a length of at least
``max(LEAST, REPEATS * q)`` that cannot be extended.  Documents are rows, so finding is
a map; a task takes a block of whole documents at a time.

1. *Grammar.*  Rounds of block compression (a maximal repetition of one symbol becomes
   one symbol with its run length) alternate with pair compression (symbols are dealt to
   a left and a right side; a left one followed by a right one becomes one symbol), until
   each document is one symbol.  Equal stretches are cut alike but for their borders.
   Sides are dealt by a hash and the better orientation is taken, so that about a quarter
   of all neighbours join each round; unlucky rounds only add rounds.
2. *Extensions.*  How far the words from ``i`` and from ``j`` agree is read off the levels:
   on the way up one symbol (or one run length) is compared where the two cuts differ, on
   the way down one where the symbols above differ.  That is O(log n) a query, and exact.
   The mirrored levels give extensions to the left.  Queries run in batches.
3. *Harmonic grid.*  A run with period ``q`` holds ``i`` and ``i + q`` for some multiple
   ``i`` of ``max(LEAST, REPEATS * q) - q``.  All such pairs (n/3 * (1 + 1/2 + 1/3 + ...)) with
   equal words are extended both ways.  Multiples of the smallest period give the same
   stretch, which keeps its smallest ``q``.

No suffix array is built and no period is left out.  Memory is bounded by a block of
``BLOCK_WORDS`` words, or by the longest document where that is longer; candidates
are made ``BLOCK_CANDIDATES`` at a time.

Defined results: null text and text without words have no runs, four nulls and the digest
of no bytes; a null doc_id gets no planted repetition and passes through; texts of any
length are whole; equal rows give equal rows each; ties for the longest run go to the
smallest start, then period; an empty table gives no rows; other columns are dropped.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from delaystar.llm.tables import arrow_schema, to_batch

#: Shortest run in words, and in periods.
LEAST, REPEATS = 6, 4
#: Words of whole documents that share a grammar, and candidates looked at together.
BLOCK_WORDS, BLOCK_CANDIDATES = 400_000, 2_000_000

SCHEMA = (
    "doc_id bigint, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, "
    "runs_sha256 string, collapsed_sha256 string"
)


@dataclass
class Level:
    """Symbols of one level; ``up`` leads to the parents, ``first`` and ``count`` from a parent to its children."""

    symbols: np.ndarray
    ends: np.ndarray  # end of each document's symbols
    up: np.ndarray | None = None
    first: np.ndarray | None = None
    count: np.ndarray | None = None
    blocks: bool = False  # how the parents are made: of blocks or of pairs


def _sides(symbols: np.ndarray, salt: int) -> np.ndarray:
    x = (symbols.astype(np.uint64) + np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (x >> np.uint64(40)) & np.uint64(1) == 1


def grammar(words: np.ndarray, ends: np.ndarray) -> list[Level]:
    """Levels of the run-length grammar of documents laid end to end (``ends``: where each ends)."""
    levels = [Level(words.astype(np.int64), ends)]
    fresh = int(words.max()) + 1 if len(words) else 0
    documents = int((np.diff(ends, prepend=0) > 0).sum())
    salt = 0
    while len(levels[-1].symbols) > documents:
        salt += 1
        for blocks in (True, False):
            low = levels[-1]
            s, n = low.symbols, len(low.symbols)
            opens = np.zeros(n, bool)  # where a document starts
            opens[0] = True
            opens[low.ends[low.ends < n]] = True
            if blocks:
                joined = np.r_[False, s[1:] == s[:-1]] & ~opens
            else:
                left = _sides(s, salt)
                ways = [np.r_[False, a[:-1] & ~a[1:]] & ~opens for a in (left, ~left)]
                joined = max(ways, key=np.count_nonzero)
            if not joined.any():
                continue
            first = np.flatnonzero(~joined)
            count = np.diff(np.r_[first, n])
            symbols = s[first].copy()
            many = np.flatnonzero(count > 1)
            second = count[many] if blocks else s[first[many] + 1]
            names, symbols[many] = np.unique(symbols[many] << 32 | second, return_inverse=True)
            symbols[many] += fresh
            fresh += len(names)
            low.up, low.first, low.count, low.blocks = np.cumsum(~joined) - 1, first, count, blocks
            levels.append(Level(symbols, np.searchsorted(first, low.ends)))
    return levels


def mirrored(levels: list[Level]) -> list[Level]:
    """The same grammar read from right to left."""
    out = []
    for k, x in enumerate(levels):
        n = len(x.symbols)
        starts = np.r_[0, x.ends[:-1]] if len(x.ends) else x.ends
        y = Level(x.symbols[::-1], (n - starts)[::-1])
        if x.up is not None:
            above = len(levels[k + 1].symbols)
            y.up, y.count, y.blocks = (above - 1 - x.up)[::-1], x.count[::-1], x.blocks
            y.first = (n - x.first - x.count)[::-1]
        out.append(y)
    return out


def extensions(levels: list[Level], i: np.ndarray, j: np.ndarray, document: np.ndarray) -> np.ndarray:
    """How many words agree from ``i`` and from ``j > i`` on, within their document."""
    a, b = i.copy(), j.copy()
    parted = np.full(len(i), -1)  # level at which the symbols at a and b differ; -1: all agree up to the document's end
    live = np.arange(len(i))
    live = live[b < levels[0].ends[document]]
    for t, x in enumerate(levels):
        if not len(live):
            break
        p, q = a[live], b[live]
        if x.up is None:  # one symbol a document: a and b cannot both be inside
            parted[live] = t
            break
        top_p, top_q = x.up[p], x.up[q]
        apart = (x.first[top_p] != p) | (x.first[top_q] != q)
        differ = apart & (x.symbols[p] != x.symbols[q])
        step = apart & ~differ
        if x.blocks:
            more = np.minimum(x.first[top_p] + x.count[top_p] - p, x.first[top_q] + x.count[top_q] - q)
            p, q = p + np.where(step, more, 0), q + np.where(step, more, 0)
        else:
            p, q = p + step, q + step
        inside = q < x.ends[document[live]]
        q_in = np.where(inside, q, 0)
        if x.blocks:  # run lengths that differ part the two inside a block
            differ |= step & inside & ((x.first[x.up[p]] != p) | (x.first[x.up[q_in]] != q_in))
        a[live], b[live] = p, q
        parted[live[differ]] = t
        go = inside & ~differ
        live = live[go]
        a[live], b[live] = x.up[p[go]], x.up[q[go]]
    for t in range(int(parted.max(initial=0)) - 1, -1, -1):
        x = levels[t]
        down = np.flatnonzero(parted > t)
        top_p, top_q = a[down], b[down]
        p, q = x.first[top_p], x.first[top_q]
        same = x.symbols[p] == x.symbols[q]
        step = same * (np.minimum(x.count[top_p], x.count[top_q]) if x.blocks else 1)
        a[down], b[down] = p + step, q + step
        parted[down[b[down] >= x.ends[document[down]]]] = -1
    return np.where(parted >= 0, a - i, levels[0].ends[document] - j)


def _grid(sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(document, i within it, q) of the harmonic grid, in bounded parts."""
    document = np.flatnonzero(sizes >= LEAST)
    most = sizes[document] // REPEATS
    pair_document = np.repeat(document, most)
    period = np.arange(int(most.sum())) - np.repeat(np.cumsum(most) - most, most) + 1
    step = np.maximum(LEAST, REPEATS * period) - period
    points = -(-(sizes[pair_document] - period) // step)
    total = np.cumsum(points)
    at = 0
    while at < len(total):
        done = int(total[at - 1]) if at else 0
        to = max(at + 1, int(np.searchsorted(total, done + BLOCK_CANDIDATES, side="right")))
        c = points[at:to]
        place = np.arange(int(c.sum())) - np.repeat(np.cumsum(c) - c, c)
        yield np.repeat(pair_document[at:to], c), place * np.repeat(step[at:to], c), np.repeat(period[at:to], c)
        at = to


def runs_of(words: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, start, length, period) of every run, by document, start and period.

    ``words`` are the numbered words of documents laid end to end, ``sizes`` their word counts.
    """
    ends = np.cumsum(sizes)
    begin = ends - sizes
    levels = back = None
    found = []
    for document, place, period in _grid(sizes):
        i = begin[document] + place
        equal = words[i] == words[i + period]
        if not equal.any():
            continue
        if levels is None:
            levels = grammar(words, ends)
            back = mirrored(levels)
        document, i, period = document[equal], i[equal], period[equal]
        right = extensions(levels, i, i + period, document)
        # to the left, the words before i + period come first in the mirrored order
        n = len(words)
        left = extensions(back, n - i - period, n - i, len(sizes) - 1 - document)
        length = left + period + right
        keep = length >= np.maximum(LEAST, REPEATS * period)
        found.append(np.stack([document[keep], i[keep] - left[keep] - begin[document[keep]], length[keep], period[keep]]))
    if not found:
        return (np.zeros(0, np.int64),) * 4
    document, start, length, period = np.concatenate(found, axis=1)
    order = np.lexsort((period, length, start, document))
    rows = np.stack([document, start, length, period])[:, order]
    first = np.r_[True, (rows[:3, 1:] != rows[:3, :-1]).any(axis=0)] if rows.shape[1] else np.zeros(0, bool)
    document, start, length, period = rows[:, first]
    order = np.lexsort((period, start, document))
    return document[order], start[order], length[order], period[order]


def planted(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The document's words, with a repetition from word ``a`` on where the hash of doc_id asks for one."""
    n = len(words)
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * (-(-(n - a) // p)))[: n - a]


def _block(ids: list, texts: list[list[bytes]]) -> dict:
    """Columns of ``SCHEMA`` for a block of whole documents."""
    numbers: dict[bytes, int] = {}
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    flat = np.fromiter((numbers.setdefault(w, len(numbers)) for ws in texts for w in ws), np.int64, int(sizes.sum()))
    document, start, length, period = runs_of(flat, sizes)
    bounds = np.searchsorted(document, np.arange(len(texts) + 1))
    out: dict[str, list] = {c.split()[0]: [] for c in SCHEMA.split(", ")}
    for k, words in enumerate(texts):
        runs = list(zip(*(x[bounds[k] : bounds[k + 1]].tolist() for x in (start, length, period)), strict=True))
        best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=(None, None, None))
        if runs:
            change = np.zeros(len(words) + 1, np.int64)
            for s, n, q in runs:
                change[s + q] += 1
                change[s + n] -= 1
            words = [words[w] for w in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]
        listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        row = (ids[k], len(runs), *best, 1000 * best[1] // best[2] if runs else None)
        digests = (hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(b" ".join(words)).hexdigest())
        for column, value in zip(out.values(), row + digests, strict=True):
            column.append(value)
    return out


def periodic_runs(documents: DataFrame, plant: bool = True) -> DataFrame:
    """Runs of every whole text and the digest of the text without their repetitions; ``plant`` adds the stated ones."""
    schema = arrow_schema(SCHEMA)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, held = [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                words = (text.as_py() or "").encode("utf-8", "surrogatepass").split()
                ids.append(doc_id)
                texts.append(planted(words, doc_id) if plant else words)
                held += len(words)
                if held >= BLOCK_WORDS:
                    yield to_batch(_block(ids, texts), schema)
                    ids, texts, held = [], [], 0
        if ids:
            yield to_batch(_block(ids, texts), schema)

    return documents.select("doc_id", "text").mapInArrow(run, SCHEMA)
