"""Exact n-gram Jaccard join with adaptive multi-match prefixes, down to connected components.

Two sets that overlap in at least ``a`` elements share at least ``l`` of their first
``n - a + l`` elements, in any order that all sets use.  Longer prefixes (larger
``l``) cost more index entries but ask for more shared elements before a pair is
looked at.  The join uses this three times:

1. Equal sets are one class; all later work is on classes.
2. Elements in hash order, ``l`` growing with the set: classes whose prefix has too
   few elements in common with any other class drop out.  Most documents do, and
   only their prefixes have been shuffled.
3. For the rest, element frequencies over all their elements.  Elements of one class
   only cannot match, which bounds every overlap; what is left is ordered from rare
   to frequent and each class gets its own ``l``, the cheapest by estimated
   cost (entries scanned, and candidates to verify per shared element asked for).
   A pair must share as many prefix elements as the smaller of its two ``l``.

A group of thousands of near copies would give candidates by the square.  So each
class is first verified against the hub of its prefix elements (the class with the
fewest elements of its own), which links most of such a group by a star.  Only pairs
of different components are then formed, filtered inside the join by size, position
and the distance to a common hub; all these bounds are exact, so no link between
components is lost.  Overlaps are counted on whole sets.

Words are hashed to 64 bits, shingles and sets again; equality of texts is equality
of hashes (chance of an error: about the square of the number of shingles / 2^64).

Defined results: null text and text without words has an empty set and links with
nothing, so its component is its own doc_id; with fewer words than a shingle has,
the whole sequence is the one shingle; repeated rows are copies of each other; a null
doc_id links like others but never names a component unless its whole component has
null ids; texts of any length are read whole, their elements sent on in bounded batches; an
empty table gives no rows; other columns, of whatever name, are dropped (kept by the stage).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from delaystar.llm.tables import arrow_schema, fresh_name, stored, to_batch

#: Shingle width and similarity of the judged query, and of near-duplicate stages elsewhere.
WIDTH, SIMILARITY = 4, (85, 100)
STAGE_WIDTH, STAGE_SIMILARITY = 5, (80, 100)
#: Elements asked for in the hash-order prefix: one, and one more per so many elements.
PER_MATCH = 20
#: Largest ``l`` that the cost estimate may choose, and the set size per unit of verification cost.
MAX_MATCHES, VERIFY_UNIT = 4, 8
#: Classes that a task remembers having sent; only saves work on copies.
SEEN = 100_000

_MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of a 64-bit hash."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """Distinct shingle hashes of a text in ascending order (the hash order of the prefixes)."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # A-Z only; the six white-space bytes
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, n)
    take = min(width, n)
    out = np.full(n - take + 1, take, np.uint64)
    for k in range(take):
        out = mix(out * _MULTIPLIERS[k % 4] + hashed[k : k + n - take + 1])
    return np.unique(out)


def class_key(elements: np.ndarray) -> int:
    """64-bit name of a set."""
    both = np.array([mix(elements).sum(dtype=np.uint64), np.uint64(len(elements))])
    return int(mix(mix(both[:1]) + both[1:])[0].astype(np.int64))


class Similarity:
    """Thresholds of a Jaccard similarity of ``num/den`` at least, as integers."""

    def __init__(self, num: int, den: int) -> None:
        self.num, self.den = num, den

    def least(self, n: int) -> int:
        """Smallest size and overlap of a partner of a set of ``n``."""
        return -(-self.num * n // self.den)

    def matches(self, n: int) -> int:
        return n // PER_MATCH + 1

    def hash_prefix(self, n: int) -> int:
        return n - self.least(n) + self.matches(n)

    def needed(self, n: int) -> int:
        """Prefix elements that a set of ``n`` shares with any partner: those asked for by the smallest one."""
        return self.matches(self.least(n))

    def least_sql(self, n: str) -> str:
        return f"(({self.num} * {n} + {self.den - 1}) div {self.den})"

    def overlap_sql(self, a: str, b: str) -> str:
        """Smallest overlap of linked sets of sizes ``a`` and ``b``."""
        total = self.num + self.den
        return f"(({self.num} * ({a} + {b}) + {total - 1}) div {total})"

    def sizes_sql(self, a: str, b: str) -> str:
        return f"{self.den} * least({a}, {b}) >= {self.num} * greatest({a}, {b})"


def memberships(documents: DataFrame, width: int) -> DataFrame:
    """doc_id, k (class, null for empty sets), n (set size) of every row; map-only."""
    schema = arrow_schema("doc_id bigint, k bigint, n bigint")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t, width) for t in batch.column("text").to_pylist()]
            keys = [class_key(s) if len(s) else None for s in sets]
            yield to_batch({"doc_id": batch.column("doc_id"), "k": keys, "n": list(map(len, sets))}, schema)

    return documents.select("doc_id", "text").mapInArrow(run, "doc_id bigint, k bigint, n bigint")


def _elements(rows: DataFrame, width: int, take, ddl: str, wanted: bool) -> DataFrame:
    """(element, k[, n]) rows of each set's first ``take(n)`` elements; a class once per task.

    With ``wanted`` the rows carry the class key that they are asked for, and others are left out.
    """
    schema = arrow_schema(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            asked = batch.column("k").to_pylist() if wanted else [None] * batch.num_rows
            parts, keys, sizes, held = [], [], [], 0
            for text, k in zip(batch.column("text").to_pylist(), asked, strict=True):
                elements = shingle_set(text, width)
                if not len(elements):
                    continue
                key = class_key(elements)
                if key in seen or (wanted and key != k):
                    continue
                if len(seen) >= SEEN:
                    seen.clear()
                seen.add(key)
                parts.append(elements[: take(len(elements))].view(np.int64))
                keys.append(key)
                sizes.append(len(elements))
                held += len(parts[-1])
                if held > 500_000:
                    yield _element_batch(parts, keys, sizes, schema)
                    parts, keys, sizes, held = [], [], [], 0
            if parts:
                yield _element_batch(parts, keys, sizes, schema)

    return rows.mapInArrow(run, ddl)


def _keyed_texts(rows: DataFrame, width: int) -> DataFrame:
    """(text, k) of the texts with words; a class once per task, so copies do not meet in one."""
    schema = arrow_schema("text string, k bigint")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            texts, keys = [], []
            for text in batch.column("text").to_pylist():
                elements = shingle_set(text, width)
                if not len(elements) or (key := class_key(elements)) in seen:
                    continue
                if len(seen) >= SEEN:
                    seen.clear()
                seen.add(key)
                texts.append(text)
                keys.append(key)
            if texts:
                yield to_batch({"text": texts, "k": keys}, schema)

    return rows.mapInArrow(run, "text string, k bigint")


def _element_batch(parts: list, keys: list[int], sizes: list[int], schema: pa.Schema) -> pa.RecordBatch:
    lengths = [len(p) for p in parts]
    columns = {
        "element": np.concatenate(parts),
        "k": np.repeat(np.array(keys, np.int64), lengths),
        "n": np.repeat(np.array(sizes, np.int64), lengths),
    }
    return to_batch({f.name: columns[f.name] for f in schema}, schema)


def shared_only(rows: DataFrame) -> DataFrame:
    """Rows whose element is in two classes or more."""
    by_element = Window.partitionBy("element")
    marked = rows.withColumn("low", F.min("k").over(by_element)).withColumn("high", F.max("k").over(by_element))
    return marked.where("low <> high").drop("low", "high")


def surviving_classes(documents: DataFrame, classes: DataFrame, width: int, sim: Similarity) -> DataFrame:
    """(k, doc_id) of the classes whose hash-order prefix shares enough elements to have a partner."""
    prefixes = _elements(documents.select("text"), width, sim.hash_prefix, "element bigint, k bigint", wanted=False)
    counted = shared_only(prefixes).groupBy("k").agg(F.count_distinct("element").alias("found"))
    needed = F.expr(f"{sim.least_sql('n')} div {PER_MATCH} + 1")
    return counted.join(classes, "k").where(F.col("found") >= needed).select("k", "doc_id")


def ranked_sets(documents: DataFrame, survivors: DataFrame, width: int, sim: Similarity) -> DataFrame:
    """(k, n, m, shared, matches): shared elements from rare to frequent, and the adaptive ``l`` of each class.

    ``m`` counts the elements that some other class has; classes where it is too
    small for any partner drop out.
    """
    # A merge join at every size: the survivors are a share of the documents, not a small table.
    texts = documents.select("doc_id", "text").join(survivors.hint("merge"), "doc_id").select("text", "k")
    # A class without any doc_id has no id to be fetched by; its texts are named by their class instead.
    nameless = _keyed_texts(documents.where("doc_id IS NULL").select("text"), width)
    asked = survivors.where("doc_id IS NULL").select("k")
    texts = texts.unionByName(nameless.join(asked.hint("merge"), "k").select("text", "k"))
    rows = _elements(texts, width, lambda n: n, "element bigint, k bigint, n bigint", wanted=True)
    frequency = F.count("*").over(Window.partitionBy("element")).cast("int")
    counted = shared_only(rows.withColumn("df", frequency))
    sets = counted.groupBy("k", "n").agg(F.array_sort(F.collect_set(F.struct("df", "element"))).alias("ranked"))
    sized = sets.withColumn("m", F.size("ranked").cast("bigint")).withColumn("least", F.expr(sim.least_sql("n")))
    alive = sized.where("m >= least")
    # Entries scanned with l = 1, 2, ...: the unshared elements come first in the prefix and cost nothing.
    entries = F.aggregate(
        F.slice("ranked", F.lit(1), (F.col("m") - F.col("least") + 1).cast("int")), F.lit(0).cast("bigint"), lambda a, x: a + x["df"]
    )
    options, scanned = [], entries
    for matches in range(1, MAX_MATCHES + 1):
        cost = scanned * (1 + F.col("n") / (VERIFY_UNIT * matches))
        options.append(F.when(F.col("least") >= matches, F.struct(cost.alias("cost"), F.lit(matches).cast("bigint").alias("matches"))))
        scanned = scanned + F.coalesce(F.get("ranked", (F.col("m") - F.col("least") + matches).cast("int"))["df"], F.lit(0))
    chosen = F.array_min(F.filter(F.array(*options), lambda o: o.isNotNull()))["matches"]
    return alive.select("k", "n", "m", F.transform("ranked", lambda x: x["element"]).alias("shared"), chosen.alias("matches"))


def prefix_entries(sets: DataFrame, sim: Similarity) -> DataFrame:
    """(element, k, n, m, matches, rank) for the adaptive prefix of each class."""
    length = F.expr(f"CAST(m - {sim.least_sql('n')} + matches AS INT)")
    return sets.select(
        "k", "n", "m", "matches", F.posexplode(F.slice("shared", F.lit(1), length)).alias("rank", "element")
    )


def overlaps(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b) -> (a, b, overlap, size_a, size_b), counted on the whole sets (unshared elements never match)."""
    side = lambda c: sets.select(F.col("k").alias(c), F.col("shared").alias(f"set_{c}"), F.col("n").alias(f"size_{c}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    overlap = F.size(F.array_intersect("set_a", "set_b")).cast("bigint")
    return both.select("a", "b", overlap.alias("overlap"), "size_a", "size_b")


def linked(counted: DataFrame, sim: Similarity) -> DataFrame:
    return counted.where(f"{sim.den} * overlap >= {sim.num} * (size_a + size_b - overlap)").select("a", "b")


def hub_pairs(entries: DataFrame, sim: Similarity) -> DataFrame:
    """(a, b): each class with the hub of each of its prefix elements, where the bounds allow a link."""
    rank = F.struct((F.col("m") / F.col("n")).alias("share"), F.col("k").alias("k"), F.col("n").alias("n"), F.col("m").alias("m"))
    hubs = entries.groupBy("element").agg(F.max(rank).alias("hub"))
    met = entries.join(hubs, "element").where("k <> hub.k").where(sim.sizes_sql("n", "hub.n"))
    return met.select(F.col("k").alias("a"), F.col("hub.k").alias("b")).distinct()


def hub_distances(counted: DataFrame, sets: DataFrame) -> DataFrame:
    """(k, hub, in_hub): for each class its most used hub and its overlap with it; hubs are their own first."""
    used = counted.groupBy("b").agg(F.count("*").alias("uses"))
    met = counted.join(used, "b").select(F.col("a").alias("k"), "uses", F.col("b").alias("hub"), F.col("overlap").alias("in_hub"))
    own = used.join(sets.select(F.col("k").alias("b"), "m"), "b").select(F.col("b").alias("k"), "uses", F.col("b").alias("hub"), F.col("m").alias("in_hub"))
    best = met.unionByName(own).groupBy("k").agg(F.max(F.struct("uses", "hub", "in_hub")).alias("best"))
    return best.select("k", "best.hub", "best.in_hub")


def remaining_pairs(entries: DataFrame, roots: DataFrame, distances: DataFrame, sim: Similarity) -> DataFrame:
    """(a, b): pairs of different components that share enough prefix elements and that no bound rules out."""
    rows = (
        entries.join(roots, "k", "left")
        .join(distances, "k", "left")
        .select("element", "k", "n", "m", "matches", "rank", F.coalesce("root", "k").alias("root"), "hub", "in_hub")
    )
    # Elements of one component only cannot join two.
    spread = rows.groupBy("element").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high")
    rows = rows.join(spread.select("element"), "element", "left_semi")
    need = sim.overlap_sql("x.n", "y.n")
    fewest = "least(x.matches, y.matches)"
    beyond_hub = "least(x.in_hub, y.in_hub) + least(x.m - x.in_hub, y.m - y.in_hub)"
    condition = " AND ".join(
        (
            "x.element = y.element",
            "x.k < y.k",
            "x.root <> y.root",
            sim.sizes_sql("x.n", "y.n"),
            f"least(x.m, y.m) >= {need}",
            f"{fewest} + least(x.m - x.rank, y.m - y.rank) - 1 >= {need}",
            f"(coalesce(x.hub <> y.hub, true) OR {beyond_hub} >= {need})",
        )
    )
    met = rows.alias("x").join(rows.alias("y"), F.expr(condition))
    counted = met.groupBy(F.col("x.k").alias("a"), F.col("y.k").alias("b")).agg(
        F.count("*").alias("shared"), F.first(F.expr(fewest)).alias("fewest")
    )
    return counted.where("shared >= fewest").select("a", "b")


def components(edges: DataFrame) -> DataFrame:
    """(a, b) -> (k, root): the smallest node of each connected component, by alternating large and small stars.

    Every round is written to the shared folder, so a lost executor costs one round
    and lineage stays short.  Minima are partial aggregates; a hub's edges are joined,
    not gathered.
    """
    current = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    state = None
    while True:
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = large.where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(least, "a").where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        current = stored(small.unionByName(least.select("a", F.col("low").alias("b"))).distinct(), "edges")
        # A round that changes no edge has left only stars.
        now = tuple(current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == state:
            break
        state = now
    roots = current.groupBy("b").agg(F.lit(1).alias("one")).select(F.col("b").alias("k"), F.col("b").alias("root"))
    return current.select(F.col("a").alias("k"), F.col("b").alias("root")).unionByName(roots)


def class_components(documents: DataFrame, members: DataFrame, width: int, sim: Similarity) -> DataFrame:
    """(k, root, component_id) of the classes that have a link to another class."""
    classes = members.where("k IS NOT NULL").groupBy("k").agg(F.min("doc_id").alias("doc_id"), F.max("n").alias("n"))
    survivors = stored(surviving_classes(documents, classes, width, sim), "survivors")
    sets = stored(ranked_sets(documents, survivors, width, sim), "sets")
    entries = stored(prefix_entries(sets, sim), "entries")
    stars = stored(overlaps(stored(hub_pairs(entries, sim), "pairs"), sets), "stars")
    first_links = linked(stars, sim)
    roots = components(first_links)
    rest = stored(remaining_pairs(entries, roots, hub_distances(stars, sets), sim), "pairs")
    links = first_links.unionByName(linked(overlaps(rest, sets), sim))
    final = components(links)
    named = final.join(classes.select("k", "doc_id"), "k")
    smallest = named.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return final.join(smallest, "root").select("k", "root", "component_id")


def jaccard_components(documents: DataFrame, width: int = WIDTH, similarity: tuple[int, int] = SIMILARITY) -> DataFrame:
    """doc_id, n_shingles, component_id of every document."""
    members = stored(memberships(documents, width), "members")
    found = class_components(documents, members, width, Similarity(*similarity))
    return _named(members, found).select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def _named(members: DataFrame, found: DataFrame) -> DataFrame:
    """Members with their component: of their linked class, else the smallest id of their own class, else their own.

    ``root`` tells components apart even where rows of different texts share a doc_id.
    """
    own = members.where("k IS NOT NULL").groupBy("k").agg(F.min("doc_id").alias("own_id"))
    classes = own.join(found, "k", "left").select(
        "k", F.coalesce("root", "k").alias("root"), F.coalesce("component_id", "own_id").alias("component_id")
    )
    return members.join(classes, "k", "left").select(
        "doc_id", "k", "n", "root", F.when(F.col("k").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")
    )


def keep_one_per_group(
    documents: DataFrame, width: int = STAGE_WIDTH, similarity: tuple[int, int] = STAGE_SIMILARITY
) -> DataFrame:
    """``documents`` without the near copies: the smallest doc_id of each component stays; texts without words all stay.

    Rows are dropped by an anti join on the narrow list of dropped ids.  Rows that
    share a doc_id (or have none) are told apart by their text's class; of those with
    one id and class, one stays.
    """
    members = stored(memberships(documents, width), "members")
    named = stored(_named(members, class_components(documents, members, width, Similarity(*similarity))), "named")
    many = named.groupBy("doc_id").agg(F.count("*").alias("rows")).where("rows > 1 OR doc_id IS NULL")
    many_id, dropped_id = fresh_name(documents, "many_id"), fresh_name(documents, "dropped_id")
    many = stored(many.select(F.col("doc_id").alias(many_id)), "repeated")
    out = named.where("k IS NOT NULL AND doc_id <> component_id")
    dropped = stored(out.select(F.col("doc_id").alias(dropped_id)).distinct(), "dropped")
    same = F.col("doc_id").eqNullSafe(F.col(many_id))
    single = documents.join(many, same, "left_anti").join(dropped, F.col("doc_id") == F.col(dropped_id), "left_anti")
    columns = [F.col(f"`{c}`") for c in documents.columns]
    key, place = fresh_name(documents, "class_key"), fresh_name(documents, "place")
    again = documents.join(many, same, "left_semi").withColumn(key, F.pandas_udf(_class_keys(width), "bigint")("text"))
    kept_k, kept_id = fresh_name(documents, "kept_k"), fresh_name(documents, "kept_id")
    keepers = named.where("k IS NOT NULL").groupBy("root", "k", "component_id").agg(F.min("doc_id").alias("first_id"))
    keepers = keepers.where(F.col("first_id").eqNullSafe(F.col("component_id"))).groupBy("root").agg(
        F.min("k").alias(kept_k), F.min("component_id").alias(kept_id)
    ).drop("root")
    matched = again.join(keepers, F.col("doc_id").eqNullSafe(F.col(kept_id)) & (F.col(key) == F.col(kept_k)), "left")
    numbered = matched.withColumn(place, F.row_number().over(Window.partitionBy("doc_id", key).orderBy(*_orderable(documents))))
    repeated = numbered.where(F.col(key).isNull() | (F.col(kept_k).isNotNull() & (F.col(place) == 1)))
    return single.select(*columns).unionByName(repeated.select(*columns))


def _orderable(documents: DataFrame) -> list[Column]:
    return [F.xxhash64(*(F.col(f"`{c}`") for c in documents.columns))]


def _class_keys(width: int):
    def keys(texts: pd.Series) -> pd.Series:
        sets = [shingle_set(t, width) for t in texts.tolist()]
        return pd.Series([class_key(s) if len(s) else None for s in sets], dtype="Int64")

    return keys
