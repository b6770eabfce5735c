"""Phrase collocations per language by best-first branch and bound over counted prefixes.

A candidate is a phrase of 2 to ``LONGEST`` words that occurs ``LEAST`` times or more.  Cut after
its first words it scores ``1000 * a * n / (l * r)``: its count, all words of the language, the
counts of both parts; its lowest cut counts.  A candidate goes if some longer candidate around it
occurs as often.  Each language reports its ``TOP`` best.

*Bound.*  The rest of a phrase occurs at least as often as the phrase, so the cut after the first
word caps the score of every phrase that starts with ``w`` at ``1000 * n / f(w)``.  Rare first words
(from ``LEAST`` on) have the highest bounds.

*Rounds.*  A round expands the frontier's best words of all open languages, about ``FRONTIER`` of
them, ties always together.  Growing counts the pairs that start with them, then all
longer phrases that start with a frequent one of these pairs.  Where all words of a language
are expanded, the counts of the parts and the longer phrases around a candidate are among
what has been counted; while some are not, one more pass counts the missing parts and
notes whether every occurrence of a candidate has the same word before or after it (then that
longer phrase occurs as often; phrases longer by more words need no check of their own).
A language is settled, and leaves, once its ``TOP``-th surviving score is above the bound of
its best word not yet expanded; equal is not enough, as ties are ordered further.

*On Spark.*  A pass is a map over whole texts with counts combined per task, then summed by a
shuffle, so a word or phrase that makes up a third of all occurrences is a few rows.  The first
pass sums counts of words, pairs and triples by hash (``HASH_BITS``; capped at ``LEAST``, which
keeps the comparison exact): only words, pairs, and phrases of triples whose hash reaches ``LEAST``
are counted by name.
Words and prefixes reach the tasks as bitmaps of hash bits.  These sizes do not grow with the
data; they only spare work, as named counts are summed exactly before they are compared, and
false hits never reach ``LEAST`` or are removed by an exact join.  Scores are exact
decimals.  The driver sees bitmaps, one frequency per round and the number of open languages.

Defined results: null text is empty; null ``lang`` is ``und`` (together with a ``lang`` of that name);
texts are read whole, in parts that end at piece borders where very long; repeated rows
count again; ties are ordered by score, count, phrase (UTF-8 bytes); languages without
candidates and empty tables give no rows; doc_id and other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from delaystar.llm.tables import LOWER, UPPER, arrow_schema, stored, to_batch

LEAST, LONGEST, TOP = 100, 5, 2000
#: Words expanded in a round (bounds of equal frequency stay together), and hash bits of a bitmap (8 MB).
FRONTIER, BITS = 1_000_000, 26
#: Hash bits of the summed counts of words, pairs and triples (at most a byte each in a task's result), and counts in a row of it.
HASH_BITS, CHUNK = (22, 24, 24), 1 << 18
#: Bytes of text that are cut into words together, and words or counts that a task holds before it sends them.
BLOCK_BYTES, HELD_WORDS, HELD_COUNTS = 8 << 20, 1_000_000, 3_000_000
NO_LANG = "und"
#: Input splits that a counting task reads, while there are more tasks than cores: what repeats is combined over more text.
SPLITS_PER_TASK = 4

# FIXED VALUES: piece borders, and the other separator besides the space.
BORDERS, BLANK = b".,;:!?\n\x0b\x0c\r", b"\t"
_TABLE = bytes.maketrans(UPPER.encode() + BORDERS + BLANK, LOWER.encode() + b"\n" * len(BORDERS) + b" ")

PHRASES = "lang string, phrase string, f bigint"
ASKED = "lang string, phrase string, f bigint, before_lo string, before_hi string, after_lo string, after_hi string"
_ODD = np.uint64(0x9E3779B97F4A7C15)


def seed(lang: str) -> np.uint64:
    return np.uint64(xxhash.xxh3_64_intdigest(lang.encode("utf-8", "surrogatepass")))


def fold(x: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hash of phrases, from the hash of all but their last word and that of the last word."""
    x = (x ^ word) * _ODD
    return x ^ (x >> np.uint64(31)) ^ (x << np.uint64(17))


def _place(hashes: np.ndarray, size: int) -> np.ndarray:
    """Place of a hash in ``size`` places (a power of two)."""
    return (hashes >> np.uint64(65 - size.bit_length())).astype(np.int64)


def within(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    place = _place(hashes, len(bitmap) * 64).astype(np.uint64)
    return (bitmap[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) == 1


class Words(dict):
    """Numbers of the words that a task meets: 0 is a piece border, -1 nothing."""

    def __init__(self) -> None:
        self.reset()

    def reset(self) -> None:
        self.clear()
        self.update({b"": -1, b"\n": 0})
        self.names: list[bytes] = [b""]
        self._hashes = np.zeros(1, np.uint64)

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self.names)
        self.names.append(word)
        return n

    def hashes(self) -> np.ndarray:
        new = self.names[len(self._hashes) :]
        self._hashes = np.r_[self._hashes, np.fromiter(map(xxhash.xxh3_64_intdigest, new), np.uint64, len(new))]
        return self._hashes


def _parts(text: bytes, limit: int) -> Iterator[bytes]:
    """A text with borders as line feeds, in parts of about ``limit`` bytes that end at a border."""
    text, at = text.translate(_TABLE), 0
    while len(text) - at > limit and (end := text.find(b"\n", at + limit)) >= 0:
        yield text[at:end]
        at = end + 1
    yield text[at:] if at else text


def blocks(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[tuple[str, list[bytes]]]:
    """(lang, words with b"" for nothing and a line feed for a border) of whole pieces of many texts."""
    held: dict[str, list[bytes]] = {}
    size = 0

    def cut() -> Iterator[tuple[str, list[bytes]]]:
        for lang, parts in held.items():
            yield lang, b"\n".join(parts).replace(b"\n", b" \n ").split(b" ")

    for batch in batches:
        langs, texts = batch.column("lang").to_pylist(), batch.column("text").cast(pa.binary())
        for lang, text in zip(langs, texts, strict=True):
            for part in _parts(text.as_py() or b"", limit):
                held.setdefault(NO_LANG if lang is None else lang, []).append(part)
                size += len(part)
                if size >= limit:
                    yield from cut()
                    held, size = {}, 0
    yield from cut()


def _numbered(batches: Iterator[pa.RecordBatch], words: Words, limit: int) -> Iterator[tuple[str, np.ndarray]]:
    for lang, tokens in blocks(batches, limit):
        ids = np.fromiter(map(words.__getitem__, tokens), np.int32, len(tokens))
        del tokens
        yield lang, ids[ids >= 0]


def _added(total: np.ndarray, more: np.ndarray, most: int) -> np.ndarray:
    """Sum of capped counts, capped again: it reaches ``most`` exactly where the full sum does."""
    return np.minimum(total.astype(np.uint16) + more, most).astype(np.uint8)


def hashed_counts(documents: DataFrame) -> list[np.ndarray]:
    """Bitmaps of the hashes of words, pairs and triples that occur ``LEAST`` times or more."""
    ddl = "kind int, chunk int, sparse boolean, counts binary"
    schema, most = arrow_schema(ddl), min(LEAST, 255)
    sizes = [1 << bits for bits in HASH_BITS]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        totals = [np.zeros(n, np.uint32) for n in sizes]
        for lang, ids in _numbered(batches, words, BLOCK_BYTES):
            hashes = words.hashes()
            first = fold(np.full(len(hashes), seed(lang)), hashes)
            own = np.bincount(ids, minlength=len(hashes))
            own[0] = 0
            np.add.at(totals[0], _place(first, sizes[0]), own.astype(np.uint32))
            at = np.flatnonzero(ids > 0)
            x = first[ids[at]]
            for kind in range(1, len(sizes)):
                inside = at + kind < len(ids)
                at, x = at[inside], x[inside]
                inside = ids[at + kind] > 0
                at = at[inside]
                x = fold(x[inside], hashes[ids[at + kind]])
                np.add.at(totals[kind], _place(x, sizes[kind]), np.uint32(1))
            if len(words) > HELD_WORDS:
                words.reset()
        for kind, total in enumerate(totals):
            capped = np.minimum(total, most).astype(np.uint8)
            for k in range(0, len(capped), CHUNK):
                part = capped[k : k + CHUNK]
                met = np.flatnonzero(part)
                sparse = 5 * len(met) < len(part)
                data = met.astype("<u4").tobytes() + part[met].tobytes() if sparse else part.tobytes()
                if len(met):
                    yield to_batch({"kind": [kind], "chunk": [k // CHUNK], "sparse": [sparse], "counts": [data]}, schema)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple, np.ndarray] = {}
        for batch in batches:
            for kind, chunk, sparse, data in zip(*(batch.column(c).to_pylist() for c in ("kind", "chunk", "sparse", "counts")), strict=True):
                total = sums.setdefault((kind, chunk), np.zeros(min(CHUNK, sizes[kind]), np.uint8))
                n = len(data) // 5
                at = np.frombuffer(data, "<u4", n) if sparse else slice(None)
                total[at] = _added(total[at], np.frombuffer(data, np.uint8, offset=4 * n if sparse else 0), most)
        for (kind, chunk), total in sums.items():
            bits = np.packbits(total >= most, bitorder="little").tobytes()
            yield to_batch({"kind": [kind], "chunk": [chunk], "sparse": [False], "counts": [bits]}, schema)

    chunks = sum(-(-n // CHUNK) for n in sizes)
    summed = documents.select("lang", "text").mapInArrow(count, ddl).repartition(chunks, "kind", "chunk").mapInArrow(add, ddl)
    out = [np.zeros(n // 8, np.uint8) for n in sizes]
    for kind, chunk, bits in zip(*(c.to_pylist() for c in summed.select("kind", "chunk", "counts").toArrow().columns), strict=True):
        out[kind][chunk * CHUNK // 8 : chunk * CHUNK // 8 + len(bits)] = np.frombuffer(bits, np.uint8)
    return [x.view(np.uint64) for x in out]


def word_counts(documents: DataFrame, likely: np.ndarray) -> DataFrame:
    """(lang, phrase, f) of the words whose hash is among ``likely``; the row with a null phrase counts all words."""
    schema = arrow_schema(PHRASES)
    shared = documents.sparkSession.sparkContext.broadcast(likely)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, counts = Words(), {}

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, found in counts.items():
                found[0] = 0
                chosen = within(shared.value, fold(np.full(len(found), seed(lang)), words.hashes()[: len(found)])) & (found > 0)
                names = [None, *(words.names[i] for i in np.flatnonzero(chosen).tolist())]
                values = [int(found.sum()), *found[chosen].tolist()]
                for k in range(0, len(names), 200_000):
                    some = names[k : k + 200_000]
                    yield to_batch({"lang": [lang] * len(some), "phrase": some, "f": values[k : k + 200_000]}, schema)
            counts.clear()

        for lang, ids in _numbered(batches, words, BLOCK_BYTES):
            own = np.bincount(ids, minlength=len(words.names))
            before = counts.get(lang, own[:0])
            own[: len(before)] += before
            counts[lang] = own
            if len(words) > HELD_WORDS:
                yield from flush()
                words.reset()
        yield from flush()

    return documents.select("lang", "text").mapInArrow(run, PHRASES).groupBy("lang", "phrase").agg(F.sum("f").alias("f"))


def bitmap_of(phrases: DataFrame) -> np.ndarray:
    """Bitmap of the hashes of (lang, phrase) rows; the driver gets at most ``2**BITS / 64`` numbers."""
    ddl = "place bigint, bits bigint"
    schema = arrow_schema(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cut = [p.split(b" ") for p in batch.column("phrase").cast(pa.binary()).to_pylist()]
            langs = batch.column("lang").to_pylist()
            seeds = {x: seed(x) for x in set(langs)}
            x = np.array([seeds[lang] for lang in langs], np.uint64)
            lengths = np.array([len(ws) for ws in cut], np.int64)
            for k in range(int(lengths.max(initial=0))):
                at = np.flatnonzero(lengths > k)
                x[at] = fold(x[at], np.fromiter((xxhash.xxh3_64_intdigest(cut[i][k]) for i in at), np.uint64, len(at)))
            place = x >> np.uint64(64 - BITS)
            bits = (np.uint64(1) << (place & np.uint64(63))).view(np.int64)
            yield to_batch({"place": (place >> np.uint64(6)).astype(np.int64), "bits": bits}, schema)

    found = phrases.select("lang", "phrase").mapInArrow(run, ddl).groupBy("place").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(1 << (BITS - 6), np.uint64)
    out[found.column("place").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return out


def grouped(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, starts) that bring equal rows together."""
    name = ids[:, 0].astype(np.int64) << 32 | ids[:, 1]
    for k in range(2, ids.shape[1]):
        name = np.unique(name, return_inverse=True)[1] << 32 | ids[:, k]
    order = np.argsort(name, kind="stable")
    name = name[order]
    return order, np.flatnonzero(np.r_[True, name[1:] != name[:-1]]) if len(name) else np.zeros(0, np.int64)


def _joined(rows: np.ndarray, names: list[bytes]) -> list[bytes]:
    return [b" ".join([names[i] for i in row]) for row in rows.tolist()]


def _windows(ids: np.ndarray, m: int) -> np.ndarray:
    """Rows of ``m`` following words, borders included."""
    return np.lib.stride_tricks.sliding_window_view(ids, m) if len(ids) >= m else np.zeros((0, m), ids.dtype)


def grown(documents: DataFrame, lengths: tuple[int, ...], starts: np.ndarray, likely: np.ndarray, frequent: np.ndarray) -> DataFrame:
    """(lang, phrase, f) of phrases with f >= LEAST, of pairs or of longer phrases.

    Pairs begin with a word of the bitmap ``starts``, end with a ``frequent`` one and are among
    ``likely``; longer phrases begin with a pair of ``starts`` and have all their triples among ``likely``.
    """
    schema = arrow_schema(PHRASES)
    shared = documents.sparkSession.sparkContext.broadcast((starts, likely, frequent))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts, likely, frequent = shared.value
        words, held, size = Words(), {}, 0

        def merged(parts: list) -> tuple[np.ndarray, np.ndarray]:
            rows, counts = (np.concatenate(x) for x in zip(*parts, strict=True))
            order, begins = grouped(rows)
            return rows[order[begins]], np.add.reduceat(counts[order], begins)

        def flush() -> Iterator[pa.RecordBatch]:
            for (lang, _), parts in held.items():
                rows, counts = merged(parts)
                for k in range(0, len(rows), 200_000):
                    phrases = _joined(rows[k : k + 200_000], words.names)
                    yield to_batch({"lang": [lang] * len(phrases), "phrase": phrases, "f": counts[k : k + 200_000]}, schema)
            held.clear()

        for lang, ids in _numbered(batches, words, BLOCK_BYTES):
            hashes = words.hashes()
            first = fold(np.full(len(hashes), seed(lang)), hashes)  # by word; the border is none
            view = _windows(ids, 2)
            at = np.flatnonzero((view > 0).all(axis=1))
            if lengths == (2,):
                opens, ends = within(starts, first), within(frequent, first)
                at = at[opens[ids[at]] & ends[ids[at + 1]]]
                at = at[within(likely, fold(first[ids[at]], hashes[ids[at + 1]]))]
                follows = None
            else:
                x = fold(first[ids[at]], hashes[ids[at + 1]])
                begin = at[within(starts, x)]
                inside = at + 2 < len(ids)
                at, x = at[inside], x[inside]
                inside = ids[at + 2] > 0
                at = at[inside]
                follows = np.zeros(len(ids) + LONGEST, bool)  # where a likely triple starts
                follows[at[within(likely, fold(x[inside], hashes[ids[at + 2]]))]] = True
                at = begin
            for m in range(2, max(lengths) + 1):
                if m > 2:
                    at = at[follows[at + m - 3]]
                if m in lengths and len(at):
                    rows = _windows(ids, m)[at]
                    order, begins = grouped(rows)
                    held.setdefault((lang, m), []).append((rows[order[begins]], np.diff(np.r_[begins, len(rows)])))
                    size += len(begins)
            if size > HELD_COUNTS:  # what the task has met again shrinks; the rest is sent
                held = {key: [merged(parts)] for key, parts in held.items()}
                size = sum(len(p[0][1]) for p in held.values())
            if size > HELD_COUNTS // 2 or len(words) > HELD_WORDS:
                yield from flush()
                size = 0
            if len(words) > HELD_WORDS:
                words.reset()
        yield from flush()

    counted = documents.select("lang", "text").mapInArrow(run, PHRASES).groupBy("lang", "phrase").agg(F.sum("f").alias("f"))
    return counted.where(F.col("f") >= LEAST)


def asked_counts(documents: DataFrame, asked: DataFrame) -> DataFrame:
    """(lang, phrase, f, and the least and greatest word before and after, empty at a border) of the asked phrases."""
    schema = arrow_schema(ASKED)
    shared = documents.sparkSession.sparkContext.broadcast(bitmap_of(asked))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap, words = shared.value, Words()
        for lang, ids in _numbered(batches, words, BLOCK_BYTES):
            hashes, around = words.hashes(), np.r_[np.zeros(1, ids.dtype), ids, np.zeros(1, ids.dtype)]
            x, at = np.full(len(ids), seed(lang)), np.arange(len(ids))
            for m in range(1, LONGEST):
                at = at[at + m <= len(ids)]
                inside = ids[at + m - 1] > 0
                x, at = x[: len(at)][inside], at[inside]
                x = fold(x, hashes[ids[at + m - 1]])
                if m == 1:
                    continue
                hit = at[within(bitmap, x)]
                order, starts = grouped(_windows(ids, m)[hit]) if len(hit) else (hit, hit)
                if not len(starts):
                    continue
                first = hit[order]
                columns = {"phrase": _joined(_windows(ids, m)[first[starts]], words.names), "f": np.diff(np.r_[starts, len(first)])}
                for side, beside in (("before", around[first]), ("after", around[first + m + 1])):
                    lo, hi = (words_at(f.reduceat(beside, starts), words.names) for f in (np.minimum, np.maximum))
                    columns[f"{side}_lo"], columns[f"{side}_hi"] = map(list, zip(*map(sorted, zip(lo, hi, strict=True)), strict=True))
                yield to_batch(columns | {"lang": [lang] * len(starts)}, schema)
            if len(words) > HELD_WORDS:
                words.reset()

    def words_at(ids: np.ndarray, names: list[bytes]) -> list[bytes]:
        return [names[i] for i in ids.tolist()]

    counted = documents.select("lang", "text").mapInArrow(run, ASKED).groupBy("lang", "phrase").agg(
        F.sum("f").alias("f"), *(f(c).alias(c) for c, f in zip(ASKED.replace(" string", "").split(", ")[3:], (F.min, F.max) * 2, strict=True))
    )
    return counted.join(asked, ["lang", "phrase"], "left_semi")


def expanded(documents: DataFrame, band: DataFrame, likely: list[np.ndarray], frequent: np.ndarray) -> DataFrame:
    """(lang, phrase, m, a) of all candidates that start with a word of ``band``; ``likely``: as ``hashed_counts`` gives it."""
    first = band.select("lang", F.col("phrase").alias("first"))

    def named(found: DataFrame, name: str) -> DataFrame:
        # what only shares a bitmap place with a start of the band is left to its own round
        found = found.withColumn("first", F.substring_index("phrase", " ", 1)).join(first, ["lang", "first"], "left_semi")
        return stored(found.select("lang", "phrase", F.size(F.split("phrase", " ")).alias("m"), F.col("f").alias("a")), name)

    two = named(grown(documents, (2,), bitmap_of(band), likely[1], frequent), "pairs")
    if LONGEST == 2 or two.isEmpty():
        return two
    longer = named(grown(documents, tuple(range(3, LONGEST + 1)), bitmap_of(two), likely[2], frequent), "longer")
    return two.unionByName(longer)


def _text(words: str, start: int | Column, many: int | Column) -> Column:
    return F.array_join(F.slice(words, start, many), " ")


def stood_for(longer: DataFrame) -> DataFrame:
    """(lang, phrase, a) of what is left of each phrase without its first or its last word, with the phrase's count."""
    inner = F.array(_text("ws", 1, F.col("m") - 1), _text("ws", 2, F.col("m") - 1))
    return longer.where("m > 2").withColumn("ws", F.split("phrase", " ")).select("lang", F.explode(inner).alias("phrase"), "a").distinct()


def survivors(
    documents: DataFrame, candidates: DataFrame, counted: DataFrame, words: DataFrame, totals: DataFrame, partial: DataFrame | None
) -> DataFrame:
    """(lang, phrase, a, l, r, n, score) of the candidates that no longer one stands for.

    ``counted`` has the candidates of all rounds.  ``partial`` names the languages with words not
    yet expanded, for which parts and neighbours are counted in one more pass; None: no such language.
    """
    cuts = candidates.withColumn("ws", F.split("phrase", " ")).select("*", F.explode(F.expr("sequence(1, m - 1)")).alias("k"))
    cuts = cuts.select("lang", "phrase", "m", "a", "k", _text("ws", F.lit(1), F.col("k")).alias("left"),
                       _text("ws", F.col("k") + 1, F.col("m") - F.col("k")).alias("right"))
    parts, gone = counted.select("lang", "phrase", F.col("a").alias("f")), stood_for(counted)
    if partial is not None:
        cuts = stored(cuts, "cuts")
        asked = cuts.select("lang", F.col("right").alias("phrase")).where("phrase LIKE '% %'")
        asked = asked.unionByName(candidates.where(F.col("m") < LONGEST).select("lang", "phrase")).join(partial, "lang", "left_semi")
        met = stored(asked_counts(documents, stored(asked.distinct(), "asked")), "met")
        same = "(before_lo = before_hi AND before_lo <> '') OR (after_lo = after_hi AND after_lo <> '')"
        parts = parts.join(partial, "lang", "left_anti").unionByName(met.select("lang", "phrase", "f"))
        gone = gone.join(partial, "lang", "left_anti").unionByName(met.where(same).select("lang", "phrase", F.col("f").alias("a")))
    parts = words.select("lang", "phrase", "f").unionByName(parts)
    part = lambda side, name: parts.select("lang", F.col("phrase").alias(side), F.col("f").alias(name))
    wide = "CAST({} AS DECIMAL(18,0))"
    score = f"(CAST(1000 AS DECIMAL(4,0)) * {wide.format('n')} * CAST(a AS DECIMAL(15,0))) div ({wide.format('l')} * {wide.format('r')})"
    cut = cuts.join(part("left", "l"), ["lang", "left"]).join(part("right", "r"), ["lang", "right"]).join(totals, "lang")
    cut = cut.withColumn("score", F.expr(score))
    best = cut.groupBy("lang", "phrase", "m", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    # a phrase of the greatest length has no longer one around it, and its count is in no such row
    return best.join(gone, ["lang", "phrase", "a"], "left_anti").select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")


def ranked(scored: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return scored.withColumn("rank", F.row_number().over(order).cast("bigint")).where(F.col("rank") <= top)


def next_cutoff(todo: DataFrame) -> int | None:
    """Largest frequency of the next band: the ``FRONTIER`` rarest words and all that tie with them."""
    n, least, most = todo.agg(F.count("*"), F.min("f"), F.max("f")).first()
    if not n or n <= FRONTIER:
        return most
    return max(least, todo.agg(F.percentile_approx("f", FRONTIER / n)).first()[0])


def collocations(documents: DataFrame, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each language's best phrases."""
    splits = documents.rdd.getNumPartitions()
    cores = documents.sparkSession.sparkContext.defaultParallelism
    documents = documents.select("lang", "text").coalesce(max(cores, splits // SPLITS_PER_TASK))
    likely = hashed_counts(documents)
    counts = stored(word_counts(documents, likely[0]).where((F.col("f") >= LEAST) | F.col("phrase").isNull()), "words")
    words = counts.where("phrase IS NOT NULL")
    totals = counts.where("phrase IS NULL").select("lang", F.col("f").alias("n"))
    frequent = bitmap_of(words)
    spark = documents.sparkSession
    scored = spark.createDataFrame([], "lang string, phrase string, a bigint, l bigint, r bigint, n bigint, score bigint")
    counted = spark.createDataFrame([], "lang string, phrase string, m int, a bigint")
    todo = words
    while (cutoff := next_cutoff(todo)) is not None:
        candidates = expanded(documents, todo.where(F.col("f") <= cutoff), likely, frequent)
        counted = counted.unionByName(candidates)
        left = todo.where(F.col("f") > cutoff)
        partial = None if left.isEmpty() else stored(left.select("lang").distinct(), "partial")
        scored = scored.unionByName(stored(survivors(documents, candidates, counted, words, totals, partial), "scored"))
        if partial is None:
            break
        # A language with its TOP-th score above the bound of its best word left is settled.
        bound = left.groupBy("lang").agg(F.min("f").alias("f")).join(totals, "lang").select("lang", F.expr("(1000 * n) div f").alias("bound"))
        last = ranked(scored, top).where(F.col("rank") == top).select("lang", "score")
        settled = bound.join(last, "lang").where("score > bound").select("lang")
        todo = stored(left.join(settled, "lang", "left_anti"), "frontier")
    return ranked(scored, top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def oracle() -> str:
    borders = r"[.,;:!?\x0A-\x0D]"
    grams = " UNION ALL ".join(
        f"SELECT lang, array_to_string(ws[i:i + {m - 1}], ' ') AS phrase, {m} AS m FROM (SELECT lang, ws, unnest(range(1, len(ws) - {m - 2})) AS i FROM pieces WHERE len(ws) >= {m})"
        for m in range(1, LONGEST + 1)
    )
    return rf"""
WITH pieces AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws
  FROM (SELECT coalesce(lang, '{NO_LANG}') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{borders}')) AS piece
        FROM documents)),
totals AS (SELECT lang, CAST(sum(len(ws)) AS HUGEINT) AS n FROM pieces GROUP BY lang),
f AS (SELECT lang, phrase, m, count(*) AS f FROM ({grams}) GROUP BY ALL HAVING count(*) >= {LEAST}),
cand AS (SELECT lang, phrase, m, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE m >= 2),
cuts AS (SELECT *, array_to_string(ws[1:k], ' ') AS first_part, array_to_string(ws[k + 1:m], ' ') AS rest
         FROM (SELECT *, unnest(range(1, m)) AS k FROM cand)),
scored AS (
  SELECT c.lang, c.phrase, c.m, c.a, c.k, x.f AS l, y.f AS r, t.n, (1000::HUGEINT * c.a * t.n) // (x.f::HUGEINT * y.f) AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = c.first_part
  JOIN f y ON y.lang = c.lang AND y.phrase = c.rest JOIN totals t ON t.lang = c.lang),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_phrases AS (
  SELECT DISTINCT lang, array_to_string(ws[i:j], ' ') AS phrase, a
  FROM (SELECT *, unnest(range(i + 1, m + 1)) AS j FROM (SELECT *, unnest(range(1, m)) AS i FROM cand))
  WHERE j - i + 1 < m),
kept AS (SELECT * FROM best b WHERE NOT EXISTS (
  SELECT 1 FROM inner_phrases p WHERE p.lang = b.lang AND p.phrase = b.phrase AND p.a >= b.a)),
numbered AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS "rank" FROM kept)
SELECT lang, "rank", phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score FROM numbered WHERE "rank" <= {TOP}"""
