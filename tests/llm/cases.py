"""Small tables with the awkward rows: nulls, empty and long texts, ties, repeats, extra columns."""

import re
from itertools import combinations

from pyspark.sql import DataFrame, SparkSession

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def docs(spark: SparkSession, rows, extra: bool = False) -> DataFrame:
    """rows: (doc_id, text[, lang, source]); ``extra`` adds columns whose names the operators use themselves."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s1", None if r[1] is None else len(r[1])) for r in rows]
    df = spark.createDataFrame(full, COLUMNS)
    if extra:
        for c in ("size", "node", "kept", "h", "g", "n", "rank", "copies", "label", "owner", "ids", "spans", "key"):
            df = df.selectExpr("*", f"'x' AS {c}")
    return df


LONG = " ".join(f"w{i * 7919 % 5003}" for i in range(12_000))
AWKWARD = [
    (1, None), (2, ""), (3, " \t\n "), (4, "one"), (5, "one"), (5, "one"), (None, "one"), (None, None),
    (6, LONG), (7, LONG + " tail"), (8, "naïve Ünïcode ǅ 𝒳 text here"), (9, "a b c d e f g h i j k l m n o p q r s t u v", None, None),
    (10, "same line\nsame line\n\nother", "de", None), (11, "Ends here.", None, "s2"),
]


def components(nodes, edges):
    low = {n: n for n in nodes}

    def find(x):
        while low[x] != x:
            x = low[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        low[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def jaccard_edges(sets, num=80, den=100):
    for (a, x), (b, y) in combinations(sets.items(), 2):
        if x and y and den * len(x & y) >= num * len(x | y):
            yield a, b
