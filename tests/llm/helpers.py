"""Small tables and plain brute-force versions shared by the tests of the llm operators."""

from __future__ import annotations

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCUMENT = "doc_id bigint, text string, lang string, source string, n_chars bigint"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
TO_LOWER = str.maketrans(UPPER, UPPER.lower())


def documents(spark, rows, more: str = ""):
    """Rows of (doc_id, text[, lang[, source]]) as a documents table; ``more`` names extra bigint columns."""
    full = []
    for r in rows:
        doc_id, text, lang, source = (*r, *(None,) * (4 - len(r)))
        extra = tuple(7 for _ in more.split())
        full.append((doc_id, text, lang, source, len(text or ""), *extra))
    schema = DOCUMENT + "".join(f", {c} bigint" for c in more.split())
    return spark.createDataFrame(full, schema)


def words(text):
    return WORD.findall(text or "")


def jaccard_components(rows, width, num, den):
    """{position: (set size, component)} by comparing all pairs."""
    sets = []
    for _, text in rows:
        w = words((text or "").translate(TO_LOWER))
        sets.append(frozenset(tuple(w[i : i + width]) for i in range(len(w) - width + 1)) if len(w) >= width else frozenset([tuple(w)] if w else []))
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j]:
                both = len(sets[i] & sets[j])
                if den * both >= num * (len(sets[i]) + len(sets[j]) - both):
                    parent[find(i)] = find(j)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(find(i), []).append(rows[i][0])
    smallest = {r: min((x for x in ids if x is not None), default=None) for r, ids in groups.items()}
    return {i: (len(sets[i]), smallest[find(i)]) for i in range(len(rows))}


def duckdb_rows(sql, **tables):
    """Rows of a query over pandas frames, as tuples with their column names."""
    import duckdb

    con = duckdb.connect()
    for name, frame in tables.items():
        con.register(name, frame)
    found = con.execute(sql)
    return [d[0] for d in found.description], found.fetchall()
