r"""Byte-level BPE: words found in a memory-mapped minimal transducer, other words merged exactly.

Lexicon: the tokens of the vocabulary itself, no matter what the texts hold (none is counted
or sampled for it), their ids by exact merging, compiled into one minimal acyclic transducer: an
automaton whose equal suffixes are shared, whose arcs carry numbers that add up to
the word's rank along its path, and a table of ids by rank.  It is written to the
shared folder once; workers memory-map it (from a private unlinked copy where the
folder is not a mounted path).  The lexicon only saves work: a word that it lacks is
merged by the ranks, so ids never depend on what it holds.

Encoding cuts a text at its special tokens, then into units (a word with the space
before it, or a run of white space), looks new units up in batches through the
transducer with vectorised steps, and keeps them in a bounded per-worker cache.

Defined results: null text is empty; empty text has no ids (their digest is that of
no bytes); texts of any length are encoded whole, long words by heap merging in
n log n; equal rows give equal results each; ``doc_id`` passes through, nulls too;
an empty table gives no rows; other columns, of whatever name, are dropped.
"""

from __future__ import annotations

import array
import collections
import functools
import hashlib
import heapq
import itertools
import json
import mmap
import posixpath
import re
import sys
import tempfile
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from delaystar.llm.tables import arrow_schema, map_batches, to_batch
from delaystar.session import scratch_path

TOKENIZER = "byte_bpe_50k.json"
#: The longest word that the lexicon takes.
LEXICON_BYTES = 256
#: Distinct units in each of a worker's cache generations (two for words after a space, two for other units).
CACHE_UNITS = 200_000
#: Units longer than this are encoded but not remembered.
CACHE_CHARS = 64
#: Bytes above which a word is merged by a heap, and cells of the words whose pairs are merged together.
LONG, STEP_CELLS = 48, 1 << 18
#: Distinct units that a task counts before it sends what it has.
COUNT_FLUSH = 200_000

SCHEMA = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"

# FIXED VALUES: white space, and the contractions of the byte-level pre-tokenizer.
SPACE = r"\t-\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"


def _ranges(kind: str) -> str:
    """Character class body of all code points whose general category starts with ``kind``."""
    out, first = [], None
    for cp in range(sys.maxunicode + 2):
        inside = cp <= sys.maxunicode and unicodedata.category(chr(cp))[0] == kind
        if inside and first is None:
            first = cp
        elif not inside and first is not None:
            out.append(f"\\U{first:08x}-\\U{cp - 1:08x}")
            first = None
    return "".join(out)


class _Patterns:
    """Compiled patterns; one instance per worker (``patterns``), as the classes take a while to list."""

    def __init__(self) -> None:
        letter, number = _ranges("L"), _ranges("N")
        self.words = re.compile(
            f"{CONTRACTIONS}| ?[{letter}]+| ?[{number}]+| ?[^{SPACE}{letter}{number}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
        )
        self.units = re.compile(f" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
        self.double_space = re.compile(f"[{SPACE}][{SPACE}]")

    def cut(self, unit: str) -> list[str]:
        """Words of a unit; letters alone, with or without the space before them, are one word."""
        if unit.isalpha() or (unit[:1] == " " and unit[1:].isalpha()):
            return [unit]
        return self.words.findall(unit)


@functools.lru_cache(maxsize=1)
def patterns() -> _Patterns:
    return _Patterns()


def byte_letters() -> dict[str, int]:
    """The vocabulary's letter for each byte: printable Latin-1 stands for itself, the rest are moved past 255."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    moved = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(moved)}


class Vocabulary:
    """Ids, merge ranks and special tokens of a byte-level BPE file."""

    def __init__(self, name: str) -> None:
        with open(public_tokenizers.path(name), encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        vocab = spec["model"]["vocab"]
        raw = lambda token: bytes(letters[c] for c in token)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.id_bytes: dict[int, bytes] = {i: raw(t) for t, i in vocab.items() if t not in self.special}
        self.id_bytes |= {i: t.encode() for t, i in self.special.items()}
        self.byte_ids = [0] * 256
        for i, b in self.id_bytes.items():
            if len(b) == 1:
                self.byte_ids[b[0]] = i
        pairs = (m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"])
        merged = [(vocab[a], vocab[b], vocab[a + b]) for a, b in pairs]
        self.rank = {a << 32 | b: rank for rank, (a, b, _) in enumerate(merged)}
        self.merged = [new for _, _, new in merged]
        keys = np.fromiter(self.rank, np.int64, len(self.rank))
        order = np.argsort(keys)
        # a last key that no pair has, so that every search ends inside
        self.pair_keys, self.pair_ranks = np.r_[keys[order], np.int64(1) << 62], np.r_[order, len(order)].astype(np.int32)
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")

    def merge(self, word: bytes) -> list[int]:
        """Exact ids of one word: always the lowest-ranked pair first, leftmost on ties."""
        ids = [self.byte_ids[b] for b in word]
        if len(ids) > LONG:
            return self._merge_long(ids)
        get, none = self.rank.get, len(self.merged)
        ranks = [get(a << 32 | b, none) for a, b in zip(ids, ids[1:], strict=False)]
        while ranks and (rank := min(ranks)) < none:
            i = ranks.index(rank)
            ids[i] = self.merged[rank]
            del ids[i + 1], ranks[i]
            if i:
                ranks[i - 1] = get(ids[i - 1] << 32 | ids[i], none)
            if i < len(ranks):
                ranks[i] = get(ids[i] << 32 | ids[i + 1], none)
        return ids

    def merge_all(self, words: list[bytes]) -> list[bytes]:
        """``merge`` of many words at once, as little-endian unsigned 32-bit bytes: each step merges one pair of every word."""
        out: list[bytes] = [b""] * len(words)
        order = sorted(range(len(words)), key=lambda i: len(words[i]))
        first = 0
        while first < len(order) and len(words[order[first]]) <= LONG:
            # words of about one length, few enough that a step stays in cache
            most = max(1, STEP_CELLS // max(1, len(words[order[first]])))
            part = [i for i in order[first : first + most] if len(words[i]) <= LONG]
            first += len(part)
            for i, ids in zip(part, self._merge_even([words[i] for i in part]), strict=True):
                out[i] = ids
        for i in order[first:]:
            out[i] = np.array(self.merge(words[i]), "<u4").tobytes()
        return out

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merge rank of pairs, the number of merges where there is none; ids below zero stand for nothing."""
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where((self.pair_keys[at] == key) & (left >= 0) & (right >= 0), self.pair_ranks[at], len(self.merged))

    def _merge_even(self, words: list[bytes]) -> list[bytes]:
        n = np.fromiter(map(len, words), np.int64, len(words))
        width, none = int(n.max(initial=0)) + 1, len(self.merged)
        column = np.arange(width)
        inside = column < n[:, None]
        ids = np.full((len(words), width), -1, np.int64)
        ids[inside] = np.array(self.byte_ids, np.int64)[np.frombuffer(b"".join(words), np.uint8)]
        ranks = self._ranks(ids[:, :-1], ids[:, 1:])
        merged = np.array(self.merged, np.int64)
        live = np.arange(len(words))
        done = ids.copy()
        while len(live):
            at = ranks.argmin(axis=1) if width > 1 else np.zeros(len(live), np.int64)  # the leftmost of the lowest
            row = np.arange(len(live))
            best = ranks[row, at] if width > 1 else np.full(len(live), none)
            more = best < none
            done[live[~more]] = ids[~more]
            live, ids, ranks, at, best = live[more], ids[more], ranks[more], at[more], best[more]
            if not len(live):
                break
            row = np.arange(len(live))
            ids[row, at] = merged[best]
            source = np.minimum(column + (column > at[:, None]), width - 1)
            ids = np.take_along_axis(ids, source, axis=1)
            ids[:, -1] = -1
            ranks = np.take_along_axis(ranks, np.minimum(source[:, :-1], width - 2), axis=1)
            ranks[:, -1] = none
            ranks[row, at] = self._ranks(ids[row, at], ids[row, at + 1])
            before = np.flatnonzero(at > 0)
            ranks[before, at[before] - 1] = self._ranks(ids[before, at[before] - 1], ids[before, at[before]])
        flat = done[done >= 0].astype("<u4").tobytes()
        ends = np.cumsum((done >= 0).sum(axis=1) * 4).tolist()
        return [flat[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same by a heap of pairs over a linked list."""
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        pair = lambda i, j: self.rank.get(ids[i] << 32 | ids[j])
        heap = [(r, i, ids[i], ids[i + 1]) for i in range(n - 1) if (r := pair(i, i + 1)) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue  # one of the two has been merged since
            ids[i], ids[j] = self.merged[rank], -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for left, right in ((before[i], i), (i, after[i])):
                if left >= 0 and right < n and (r := pair(left, right)) is not None:
                    heapq.heappush(heap, (r, left, ids[left], ids[right]))
        return [i for i in ids if i >= 0]


def compile_lexicon(words: Iterable[bytes], vocabulary: Vocabulary) -> dict[str, np.ndarray]:
    """Minimal acyclic transducer of ``words``: arrays of arcs, states and ids by rank.

    Words are added in order; states that can get no more arcs are replaced by an
    equal state met before, so equal suffixes are stored once.  An arc's number is
    how many words its state accepts before that arc, so the numbers along a path
    add up to the word's rank.
    """
    words = sorted({w for w in words if w})
    register: dict[tuple, int] = {}
    states: list[tuple] = []  # (final, ((byte, state), ...)) of every finished state

    def finish(final: bool, arcs: list) -> int:
        key = (final, tuple(arcs))
        if key not in register:
            register[key] = len(states)
            states.append(key)
        return register[key]

    path: list[list] = [[False, []]]  # open states along the last word
    last = b""

    def close(depth: int) -> None:
        while len(path) > depth + 1:
            final, arcs = path.pop()
            path[-1][1].append((last[len(path) - 1], finish(final, arcs)))

    for word in words:
        common = 0
        while common < len(last) and common < len(word) and last[common] == word[common]:
            common += 1
        close(common)
        path.extend([False, []] for _ in range(len(word) - common))
        path[-1][0] = True
        last = word
    close(0)
    start = finish(*path[0])

    count = [0] * len(states)  # words accepted from a state; children come before parents
    keys, targets, adds = [], [], []
    for s, (final, arcs) in enumerate(states):
        n = int(final)
        for byte, target in arcs:
            keys.append(s << 8 | byte)
            targets.append(target)
            adds.append(n)
            n += count[target]
        count[s] = n
    ids = [vocabulary.merge(w) for w in words]
    return {
        "keys": np.array(keys, np.int64),
        "targets": np.array(targets, np.int32),
        "adds": np.array(adds, np.int32),
        "final": np.array([f for f, _ in states], np.int8),
        "start": np.array([start], np.int64),
        "offsets": np.cumsum([0, *map(len, ids)]).astype(np.int32),
        "ids": np.array([i for x in ids for i in x], np.uint32),
    }


def pack_arrays(arrays: dict[str, np.ndarray]) -> bytes:
    """One file: a JSON header line with places, then 8-byte aligned array bytes."""
    at, places, parts = 0, {}, []
    for name, a in arrays.items():
        raw = a.tobytes()
        places[name] = (a.dtype.str, len(a), at)
        parts.append(raw + b"\0" * (-len(raw) % 8))
        at += len(parts[-1])
    head = json.dumps(places).encode()
    head += b" " * (-(len(head) + 1) % 8) + b"\n"
    return head + b"".join(parts)


class Lexicon:
    """A packed transducer over a memory map; looks up many words at once."""

    def __init__(self, data) -> None:
        head = bytes(data[: data.find(b"\n") + 1])
        for name, (kind, n, at) in json.loads(head).items():
            setattr(self, name, np.frombuffer(data, kind, n, len(head) + at))

    @classmethod
    def open(cls, uri: str) -> Lexicon:
        store, path = pafs.FileSystem.from_uri(uri) if "://" in uri else (pafs.LocalFileSystem(), uri)
        if isinstance(store, pafs.LocalFileSystem):
            with open(path, "rb") as f:
                return cls(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ))
        with store.open_input_stream(path) as source, tempfile.TemporaryFile() as f:
            while part := source.read(1 << 20):
                f.write(part)
            f.flush()
            return cls(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ))

    def ranks(self, words: list[bytes]) -> np.ndarray:
        """Rank of each word, or -1; one vectorised step per byte position."""
        n = np.fromiter(map(len, words), np.int64, len(words))
        rank = np.zeros(len(words), np.int64)
        if not len(words) or not len(self.keys):
            return np.full(len(words), -1, np.int64)
        order = np.argsort(-n, kind="stable")
        width = min(int(n.max()), LEXICON_BYTES)
        letters = np.zeros((len(words), max(width, 1)), np.uint8)
        flat = np.frombuffer(b"".join(words), np.uint8)
        row = np.repeat(np.arange(len(words)), n)
        col = np.arange(len(flat)) - np.repeat(np.cumsum(n) - n, n)
        fits = col < width
        letters[row[fits], col[fits]] = flat[fits]
        state = np.full(len(words), self.start[0], np.int64)
        state[n > width] = -1
        for k in range(width):
            live = order[: int(np.searchsorted(-n[order], -k))]  # words longer than k
            live = live[state[live] >= 0]
            if not len(live):
                break
            key = state[live] << 8 | letters[live, k]
            arc = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = self.keys[arc] == key
            rank[live] += np.where(hit, self.adds[arc], 0)
            state[live] = np.where(hit, self.targets[arc], -1)
        found = (state >= 0) & (self.final[np.maximum(state, 0)] == 1)
        return np.where(found, rank, -1)

    def ids_of(self, rank: int) -> bytes:
        return self.ids[self.offsets[rank] : self.offsets[rank + 1]].tobytes()


class Encoder:
    """Whole texts to ids as little-endian unsigned 32-bit bytes, and back."""

    def __init__(self, name: str, lexicon: Lexicon | None) -> None:
        self.vocabulary, self.lexicon, self.patterns = Vocabulary(name), lexicon, patterns()
        self.newline = self.ids_bytes(self.vocabulary.merge(b"\n"))
        self.special = {t: self.ids_bytes([i]) for t, i in self.vocabulary.special.items()}
        self.caches: list[tuple[dict[str, bytes], dict[str, bytes]]] = [({}, {}), ({}, {})]
        tokens = [self.vocabulary.id_bytes.get(i, b"") for i in range(max(self.vocabulary.id_bytes) + 1)]
        self.token_length = np.array([len(t) for t in tokens], np.int64)
        self.token_start = np.cumsum(self.token_length) - self.token_length
        self.token_bytes = np.frombuffer(b"".join(tokens), np.uint8)

    @staticmethod
    def ids_bytes(ids: list[int]) -> bytes:
        return array.array("I", ids).tobytes() if sys.byteorder == "little" else np.array(ids, "<u4").tobytes()

    def learn(self, units: list[str]) -> dict[str, bytes]:
        """Ids of new units: cut into words, transducer first, exact merges for the rest."""
        cut = [[w.encode() for w in self.patterns.cut(u)] for u in units]
        distinct = list(dict.fromkeys(w for ws in cut for w in ws))
        ranks = self.lexicon.ranks(distinct).tolist() if self.lexicon else [-1] * len(distinct)
        known = {w: self.lexicon.ids_of(r) for w, r in zip(distinct, ranks, strict=True) if r >= 0}
        unseen = [w for w, r in zip(distinct, ranks, strict=True) if r < 0]
        known.update(zip(unseen, self.vocabulary.merge_all(unseen), strict=True))
        return {u: b"".join([known[w] for w in ws]) for u, ws in zip(units, cut, strict=True)}

    def lines(self, text: str) -> list[tuple[list[str], list[str]]]:
        """(units, words that follow a space) of each line; lines are joined by the id of a newline.

        Where white space runs occur, the whole text is one line of units.
        """
        if self.patterns.double_space.search(text):
            return [(self.patterns.units.findall(text), [])]
        out = []
        for line in text.split("\n"):
            first, *rest = line.split(" ")
            out.append(([first] if first else [], rest))
        return out

    def _meet(self, kind: int, units: set[str]) -> dict[str, bytes]:
        """Ids of all ``units`` (``kind`` 1: words that follow a space), as a dictionary that has at least these."""
        cache, older = self.caches[kind]
        if len(cache) > CACHE_UNITS:  # units that are not met again while the next generation fills are forgotten
            cache, older = self.caches[kind] = ({}, cache)
        new = [u for u in units if u not in cache]
        found = {u: older[u] for u in new if u in older}
        missing = [u for u in new if u not in found]
        if kind:
            learned = self.learn([" " + u for u in missing])
            found |= {u: learned[" " + u] for u in missing}
        else:
            found |= self.learn(missing)
        cache.update((u, b) for u, b in found.items() if len(u) <= CACHE_CHARS)
        return collections.ChainMap(cache, found) if any(len(u) > CACHE_CHARS for u in new) else cache

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        lined = [[p if p in self.special else self.lines(p) for p in self.vocabulary.cut.split(t)] for t in texts]
        parts = [line for ps in lined for ls in ps if not isinstance(ls, str) for line in ls]
        plain, spaced = (self._meet(k, set(itertools.chain.from_iterable(p[k] for p in parts))).__getitem__ for k in (0, 1))

        def encoded(lines: list[tuple[list[str], list[str]]]) -> bytes:
            return self.newline.join([b"".join([*map(plain, units), *map(spaced, words)]) for units, words in lines])

        return [b"".join([self.special[ls] if isinstance(ls, str) else encoded(ls) for ls in ps]) for ps in lined]

    def decode(self, ids: bytes) -> bytes:
        """UTF-8 bytes of the decoded text; broken sequences become the replacement character."""
        found = np.frombuffer(ids, "<u4")
        length = self.token_length[found]
        shift = self.token_start[found] - (np.cumsum(length) - length)
        raw = self.token_bytes[np.arange(int(length.sum())) + np.repeat(shift, length)].tobytes()
        try:
            raw.decode()
            return raw
        except UnicodeDecodeError:
            return raw.decode(errors="replace").encode()


_WORKER: dict[tuple, Encoder] = {}


def worker_encoder(name: str, lexicon_uri: str | None) -> Encoder:
    """The worker's encoder, kept from task to task."""
    key = (name, lexicon_uri)
    if key not in _WORKER:
        _WORKER.clear()
        _WORKER[key] = Encoder(name, Lexicon.open(lexicon_uri) if lexicon_uri else None)
    return _WORKER[key]


def word_counts(documents: DataFrame) -> DataFrame:
    """Counts of all words of all texts: (word binary, n), summed per task before the shuffle."""
    schema = arrow_schema("word binary, n bigint")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut = patterns().cut
        firsts: collections.Counter = collections.Counter()
        spaced: collections.Counter = collections.Counter()

        def flush() -> pa.RecordBatch:
            words: collections.Counter = collections.Counter()
            for space, units in (("", firsts), (" ", spaced)):
                for unit, n in units.items():
                    for word in cut(space + unit):
                        words[word] += n
                units.clear()
            served = {b: n for w, n in words.items() if len(b := w.encode()) <= LEXICON_BYTES}
            return to_batch({"word": list(served), "n": list(served.values())}, schema)

        for batch in batches:
            for text in batch.column(0).to_pylist():
                first, *rest = (text or "").replace("\n", " ").split(" ")
                firsts[first] += 1
                spaced.update(rest)
                if len(firsts) + len(spaced) > COUNT_FLUSH:
                    yield flush()
        yield flush()

    return documents.select("text").mapInArrow(count, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def build_lexicon(spark: SparkSession, name: str = TOKENIZER) -> str:
    """Compile the vocabulary's own tokens and write the packed transducer to the shared folder."""
    vocabulary = Vocabulary(name)
    words = (w for w in vocabulary.id_bytes.values() if len(w) <= LEXICON_BYTES)
    data = pack_arrays(compile_lexicon(words, vocabulary))
    uri = posixpath.join(scratch_path(spark, "lexicon"), "words.fst")
    store, path = pafs.FileSystem.from_uri(uri) if "://" in uri else (pafs.LocalFileSystem(), uri)
    store.create_dir(posixpath.dirname(path), recursive=True)
    with store.open_output_stream(path) as out:
        out.write(data)
    return uri


def encode_documents(documents: DataFrame, lexicon_uri: str | None, name: str = TOKENIZER) -> DataFrame:
    """doc_id, ids (binary, little-endian unsigned 32-bit) of every text; map-only."""

    def rows(batch: pa.RecordBatch) -> dict:
        texts = [t or "" for t in batch.column("text").to_pylist()]
        return {"doc_id": batch.column("doc_id"), "ids": worker_encoder(name, lexicon_uri).encode_batch(texts)}

    return map_batches(documents.select("doc_id", "text"), rows, "doc_id bigint, ids binary")


def token_digests(documents: DataFrame, name: str = TOKENIZER) -> DataFrame:
    """Encode every whole text, decode the ids again, and return the digests of both."""
    lexicon_uri = build_lexicon(documents.sparkSession, name)

    def rows(batch: pa.RecordBatch) -> dict:
        encoder = worker_encoder(name, lexicon_uri)
        out: dict[str, list] = {"n_tokens": [], "ids_sha256": [], "decoded_sha256": []}
        texts = batch.column("text").to_pylist()
        for at in range(0, len(texts), 256):
            for ids in encoder.encode_batch([t or "" for t in texts[at : at + 256]]):
                out["n_tokens"].append(len(ids) // 4)
                out["ids_sha256"].append(hashlib.sha256(ids).hexdigest())
                out["decoded_sha256"].append(hashlib.sha256(encoder.decode(ids)).hexdigest())
        return {"doc_id": batch.column("doc_id")} | out

    return map_batches(documents.select("doc_id", "text"), rows, SCHEMA)
