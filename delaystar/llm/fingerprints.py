"""One-permutation MinHash fingerprints with optimal densification, in native column expressions only.

A text's five-word shingles are hashed once to 64 bits.  The high ``BIN_BITS`` bits
name one of ``BINS`` bins and each bin keeps its smallest hash, so one permutation
serves all bins.  An empty bin takes the value of the first non-empty bin on its own
fixed cycle through all bins (every empty bin draws independently, which is what
makes the densification optimal; the cycle makes it end).  The low ``BITS`` bits of
each bin are packed eight to a 64-bit word.  The likeness of two fingerprints is the
share of equal bins with the chance agreement 2^-BITS taken out.

Next documents: rows are dealt to buckets that follow doc_id (quantile bounds; rows of
one frequent id, and rows without an id, by text hash), so a window per bucket finds
the next row and only the first row of each bucket moves on to the bucket before it.  One shuffle of the texts; no window
over all rows.

Defined results: null text is empty; without words there are no shingles and the
fingerprint is the empty string, which has likeness 1 to its like and 0 to all
others; with fewer than five words the whole sequence is the one shingle; rows sort
by doc_id descending (nulls last), then by text hash and text, so repeated rows
follow each other; a single row is followed by itself; texts of any length are
fingerprinted whole, one row at a time; an empty table gives no rows; other columns,
of whatever name, are dropped.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from delaystar.llm.tables import let

WORDS_PER_SHINGLE = 5
BIN_BITS = 8
BINS = 1 << BIN_BITS
#: Low-order bits kept per bin; ``pack`` and ``equal_bins`` are written for bytes.
BITS = 8
_SHIFT = 64 - BIN_BITS
_LOW = (1 << _SHIFT) - 1
#: Steps on an empty bin's cycle that are tried one by one before all non-empty bins are ranked.
TRIES = 12
#: FIXED VALUES: white space between words.
BLANKS = " \t\n\x0b\f\r"
BLANK_RUN = r"[\x20\x09-\x0D]+"
#: Coarse bounds of the doc_id buckets, and the rows that a bucket is meant to hold.
COARSE, BUCKET_ROWS = 32, 2000
_FINE = 1 << 32


def cycle(i: int) -> tuple[int, int]:
    """Start and odd stride of bin ``i``'s cycle through all bins, from a fixed mixer."""
    z = (i + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1
    z = (z ^ z >> 30) * 0xBF58476D1CE4E5B9 & (1 << 64) - 1
    z ^= z >> 27
    return z >> 8 & BINS - 1, (z >> 24 | 1) & BINS - 1


def _literals(values: Iterable, suffix: str = "") -> Column:
    """An array literal; one parsed expression instead of a column object per value."""
    shown = (f"-{-v}{suffix}" if v < 0 else f"{v}{suffix}" for v in values)
    return F.expr(f"array({', '.join(shown)})")


def words(text: Column) -> Column:
    """Words of a text; null where there are none."""
    bare = F.btrim(text, F.lit(BLANKS))
    return F.when(bare != "", F.split(bare, BLANK_RUN))


def shingle_hashes(word_list: Column) -> Column:
    """64-bit hashes of all shingles, not yet distinct."""
    k = WORDS_PER_SHINGLE
    hashed = F.transform(word_list, lambda w: F.xxhash64(w))
    many = let(
        hashed,
        lambda h: F.transform(F.sequence(F.lit(0), F.size(h) - k), lambda i: F.xxhash64(*(F.get(h, i + j) for j in range(k)))),
    )
    return F.when(F.size(word_list) >= k, many).otherwise(F.array(F.xxhash64(hashed)))


def bin_minima(hashes: Column) -> Column:
    """Smallest hash of each bin in bin order, null for empty bins.

    One marker per bin, the largest value that the bin can hold, joins the hashes;
    after sorting, the first entry of each bin is its minimum or the marker.
    """
    markers = _literals(((j - BINS // 2 << _SHIFT) | _LOW for j in range(BINS)), "L")
    bin_of = lambda h: F.shiftright(h, _SHIFT)
    firsts = let(
        F.sort_array(F.concat(hashes, markers)),
        lambda s: F.filter(s, lambda h, i: ~bin_of(h).eqNullSafe(bin_of(F.get(s, i - 1)))),
    )
    return F.transform(firsts, lambda h: F.when(h.bitwiseAND(F.lit(_LOW)) != _LOW, h))


def densify(minima: Column) -> Column:
    """Every bin with a value: its own, or that of the first non-empty bin on its cycle."""
    starts, strides = zip(*(cycle(i) for i in range(BINS)), strict=True)
    tables = F.struct(
        _literals(starts).alias("start"),
        _literals(strides).alias("stride"),
        _literals(pow(s, -1, BINS) for s in strides).alias("back"),
    )
    wrap = lambda n: n.bitwiseAND(F.lit(BINS - 1))

    def filled(m: Column, full: Column, t: Column) -> Column:
        def value(x: Column, i: Column) -> Column:
            start, stride = F.get(t["start"], i), F.get(t["stride"], i)
            tried = [F.get(m, wrap(start + k * stride)) for k in range(TRIES)]
            step = lambda p: wrap((p["bin"] - start + BINS) * F.get(t["back"], i))
            ranked = F.array_min(F.transform(full, lambda p: F.struct(step(p).alias("step"), p["value"].alias("value"))))
            return F.coalesce(x, *tried, ranked["value"])  # evaluated from left to right, as far as needed

        return F.transform(m, value)

    def with_full(m: Column) -> Column:
        pairs = F.transform(m, lambda x, i: F.struct(i.alias("bin"), x.alias("value")))
        full = F.filter(pairs, lambda p: p["value"].isNotNull())
        return let(full, lambda f: let(tables, lambda t: filled(m, f, t)))

    return let(minima, with_full)


def pack(values: Column) -> Column:
    """Low bits of all bins, eight bins to a 64-bit word."""

    def word(v: Column, w: Column) -> Column:
        out = None
        for j in range(8):
            part = F.shiftleft(F.get(v, w * 8 + j).bitwiseAND(F.lit(255)), 8 * j)
            out = part if out is None else out.bitwiseOR(part)
        return out

    return let(values, lambda v: F.transform(F.sequence(F.lit(0), F.lit(BINS // 8 - 1)), lambda w: word(v, w)))


def fingerprint(text: Column) -> Column:
    """Packed fingerprint (array of 64-bit words); null for a text without words."""
    return let(words(text), lambda w: F.when(w.isNotNull(), pack(densify(bin_minima(shingle_hashes(w))))))


def fingerprint_text(packed: Column) -> Column:
    parts = F.transform(packed, lambda p: F.lpad(F.lower(F.hex(p)), 16, "0"))
    return F.coalesce(F.array_join(parts, ""), F.lit(""))


def equal_bins(a: Column, b: Column) -> Column:
    """Number of bins on which two packed fingerprints agree."""
    nibbles, pairs, ones = (int(f"0x{byte * 8}", 16) for byte in ("0f", "03", "01"))

    def differing(x: Column, y: Column) -> Column:
        def fold(z: Column, shift: int, mask: int) -> Column:
            return z.bitwiseOR(F.shiftrightunsigned(z, shift)).bitwiseAND(F.lit(mask))

        bits = let(x.bitwiseXOR(y), lambda z: fold(z, 4, nibbles))
        return F.bit_count(let(let(bits, lambda z: fold(z, 2, pairs)), lambda z: fold(z, 1, ones)))

    return F.lit(BINS) - F.aggregate(F.zip_with(a, b, differing), F.lit(0), lambda acc, n: acc + n)


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity, with the chance agreement of ``BITS`` bits taken out."""
    chance = 2.0**-BITS
    share = equal_bins(a, b) / F.lit(float(BINS))
    return F.when(a.isNull() | b.isNull(), (a.isNull() & b.isNull()).cast("double")).otherwise(
        F.greatest((share - chance) / (1 - chance), F.lit(0.0))
    )


def bucket_column(documents: DataFrame) -> Column:
    """A bucket number that falls along the order of the rows: doc_id descending (nulls last), then text hash.

    Bounds are ``COARSE`` quantiles of doc_id; between two bounds buckets are even cells up to a quantile
    just below the upper one, beyond which the last cell goes, so single far ids widen no cell.  A bound
    that several quantiles share is an id on many rows: these are dealt by their text's hash.
    So are rows without an id.  Rows of one id and one text have no order of their own and stay together.
    """
    found = documents.agg(F.count("*").alias("n"), F.count_if(F.col("doc_id").isNull()).alias("nulls"), F.min("doc_id").alias("lo")).first()
    none = (F.lit(-_FINE - 1) - _dealt(max(1, found["nulls"] // BUCKET_ROWS))).cast("bigint")
    if found["lo"] is None:
        return none
    shares = [(i + part) / COARSE for i in range(COARSE) for part in (0.0, 0.98)]
    cuts = documents.agg(F.percentile_approx("doc_id", shares, 20_000)).first()[0]
    lows, highs = [found["lo"], *cuts[2::2]], cuts[1::2]
    cells = max(1, (found["n"] - found["nulls"]) // (COARSE * BUCKET_ROWS))
    bounds = sorted(set(lows))
    last = {low: high for low, high in zip(lows, highs, strict=True)}  # of quantiles with one bound the last
    # plain comparisons: the exchange on this number is then the same plan wherever it is used
    at = F.expr(" + ".join(f"CAST(doc_id >= CAST({b!r} AS BIGINT) AS INT)" for b in bounds)) - 1
    width = [max(float(last[b]) - float(b), 1.0) for b in bounds]
    inside = (F.col("doc_id").cast("double") - F.get(_literals(map(float, bounds), "D"), at)) / F.get(_literals(width, "D"), at)
    cell = F.least(F.greatest(F.floor(inside * cells), F.lit(0)), F.lit(cells - 1))
    bucket = at * F.lit(_FINE).cast("bigint") + cell
    often = [(k, b, lows.count(b)) for k, b in enumerate(bounds) if lows.count(b) > 1]
    if often:  # below the other ids of their cell and above the cell before
        branches = " ".join(f"WHEN CAST({b!r} AS BIGINT) THEN {m * cells}" for _, b, m in often)
        places = " ".join(f"WHEN CAST({b!r} AS BIGINT) THEN CAST({k * _FINE - 1} AS BIGINT)" for k, b, _ in often)
        hot = F.expr(f"CASE doc_id {places} END") - _dealt(F.expr(f"CASE doc_id {branches} END"))
        bucket = F.coalesce(hot, bucket)
    return F.when(F.col("doc_id").isNull(), none).otherwise(bucket)


def _dealt(cells: Column | int) -> Column:
    """Cell of the text's hash among ``cells`` even ones, ascending."""
    cells = F.lit(cells) if isinstance(cells, int) else cells
    return F.least(F.floor((F.xxhash64("text") / F.lit(2.0**64) + F.lit(0.5)) * cells), cells - 1)


def next_bucket(buckets: DataFrame) -> DataFrame:
    """(bucket) -> (bucket, next): the next lower bucket that has rows; after the lowest, the highest.

    Buckets of one coarse cell follow each other in a window of that cell; only one
    row per coarse cell (``COARSE`` and one at most) meets in one task.
    """
    coarse = F.floor(F.col("bucket") / _FINE)
    marked = buckets.select("bucket", coarse.alias("coarse"))
    tops = marked.groupBy("coarse").agg(F.max("bucket").alias("top"))
    order = Window.orderBy(F.desc("coarse"))
    following = tops.select(
        "coarse", F.coalesce(F.lead("top").over(order), F.max("top").over(Window.partitionBy())).alias("over")
    )
    inner = F.lead("bucket").over(Window.partitionBy("coarse").orderBy(F.desc("bucket")))
    chained = marked.withColumn("inner", inner).join(following, "coarse")
    return chained.select("bucket", F.coalesce("inner", "over").alias("next"))


def with_next(rows: DataFrame, bucket: Column) -> DataFrame:
    """Rows (doc_id, text) with their fingerprint ``own`` and the text and fingerprint of the next row (``following``).

    The texts are shuffled once, by bucket; the three uses below share that exchange.
    Rows inside a bucket look at the next row; only the first and the last row of each
    bucket take part in the join across buckets.
    """
    # The filter holds for every row; the joins below ask for it, so all three uses must have it to share the exchange.
    dealt = rows.withColumn("bucket", bucket).where(F.col("bucket").isNotNull()).repartition("bucket")
    order = Window.partitionBy("bucket").orderBy(F.desc_nulls_last("doc_id"), F.xxhash64("text"), "text")
    inside = (
        dealt.withColumn("own", fingerprint(F.col("text")))
        .withColumn("following", F.lead(F.struct("text", "own")).over(order))
        .where(F.col("following").isNotNull())
        .drop("bucket")
    )
    placed = dealt.withColumn("place", F.row_number().over(order)).withColumn("more", F.lead(F.lit(1)).over(order))
    edge = lambda frame: frame.withColumn("own", fingerprint(F.col("text")))
    chain = next_bucket(rows.select(bucket.alias("bucket")).distinct())
    heads = (
        edge(placed.where("place = 1"))
        .select(F.col("bucket").alias("next"), F.struct("text", "own").alias("following"))
        .join(chain, "next")
        .drop("next")
    )
    last = edge(placed.where("more IS NULL")).drop("place", "more").join(heads, "bucket").drop("bucket")
    return inside.unionByName(last)


def edited_text(text: Column, following: Column) -> Column:
    """The last third (code points, rounded down) replaced by the first as many of the following text, or all of it."""
    n = F.floor(F.length(text) / 3).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - n), F.substring(following, F.lit(1), n))


def fingerprint_documents(documents: DataFrame) -> DataFrame:
    """Fingerprints of every whole text and of its edited text, with their likenesses."""
    rows = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    paired = with_next(rows, bucket_column(rows))
    edited = paired.select(
        "doc_id", "text", "own", F.col("following.own").alias("next"),
        edited_text(F.col("text"), F.col("following.text")).alias("edited"),
    )
    made = edited.select(
        "doc_id", F.length("text").cast("bigint").alias("n_chars"), F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"),
        "own", "next", fingerprint(F.col("edited")).alias("changed"),
    )
    return made.select(
        "doc_id", "n_chars", "edited_sha256",
        fingerprint_text(F.col("own")).alias("fingerprint"), fingerprint_text(F.col("changed")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("changed")).alias("near_edited"), likeness(F.col("own"), F.col("next")).alias("near_next"),
    )
