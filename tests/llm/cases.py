"""Awkward rows that every operator has to take, and brute-force helpers."""

from __future__ import annotations

import zlib

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
# Names that operators use for columns of their own.
CLASHING = "size, part, key, stream, node, root, fp, shard, slot, place, number, block, target, copies".split(", ")
LONG = " ".join(f"w{i % 977}" for i in range(60_000))

ROWS = [
    (1, "The quick brown fox jumps over the lazy dog again and again.", "en", "a"),
    (2, "The quick brown fox jumps over the lazy dog again and again.", "en", "a"),
    (2, "The quick brown fox jumps over the lazy dog again and again.", "en", "a"),
    (3, None, "en", "a"),
    (4, "", "de", None),
    (5, " \t\n ", None, ""),
    (6, LONG, "en", "b"),
    (7, "Über die Brücke und durch den Wald, der nicht dicht ist.", "de", "b"),
    (8, "¿Dónde está la biblioteca de los niños pequeños del mundo?", "es", "c"),
    (9, "Les élèves sont arrivés à la gare avec leurs très grands sacs.", "fr", "c"),
    (None, "a document without an id", "en", "c"),
    (None, None, None, None),
    (10, "12345 67890 !!! ???", "en", "d"),
    (11, "日本語 の テキスト", None, "d"),
    (12, "x", "en", "d"),
    (-13, "one\x0btwo\x0cthree\xa0four five", "en", "e"),
]


def documents(spark, rows=ROWS, extra=True):
    """`rows` as a documents table; `extra` adds columns whose names operators use themselves."""
    full = [(*r, len(r[1]) if r[1] is not None else None) for r in rows]
    df = spark.createDataFrame(full, DOCS)
    if extra:
        for i, name in enumerate(CLASHING):
            df = df.selectExpr("*", f"{i} AS {name}")
    return df


def no_documents(spark):
    return documents(spark, [], extra=False)


def on_disk(df, path):
    """A table, as operators meet it: some tell rows apart by their place in it."""
    df.write.mode("overwrite").parquet(str(path))
    return df.sparkSession.read.parquet(str(path))


def crc(doc_id) -> int:
    return zlib.crc32(str(doc_id).encode() if doc_id is not None else b"")


def union_find(nodes, links):
    """The least node each node reaches."""
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            root[n] = root[root[n]]
            n = root[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}
