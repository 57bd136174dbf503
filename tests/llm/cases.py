"""Small tables with the cases every operator has to survive."""

import random
import re

from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
MORE = "/root/testdata/sf0.01"

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
# Names the operators use for columns of their own.
CLASHES = ["score", "lang_pred", "size", "target", "row", "class", "root", "part", "kept", "n", "h", "c1", "_row", "_host", "_key", "_text",
           "component_id", "n_lines", "level", "positions", "ids", "length", "label_", "key", "t", "w"]


def prose(words, seed, width=12):
    pick = random.Random(seed)
    names = ["".join(pick.choice("abcdefghilmnorstu") for _ in range(pick.randint(2, 9))) for _ in range(400)]
    out = [pick.choice(names) for _ in range(words)]
    return "\n".join(" ".join(out[k : k + width]) for k in range(0, words, width))


def edge_rows():
    base = prose(120, 1)
    return [
        (1, None, "en", "a", None), (2, "", "en", "a", 0), (3, " \t\n \r\n", "de", "a", 6), (4, "one", "en", "b", 3),
        (5, "one two three", None, None, 13), (6, base, "en", "a", None), (7, base, "en", "b", None), (8, base.replace("\n", "  \n\t"), "en", "a", None),
        (9, base.upper(), "de", None, None), (10, base + " further", "en", "a", None), (11, base + " further", "en", "a", None),
        (11, base + " further", "en", "a", None), (12, prose(60_000, 2), "fr", "a", None), (13, "1234 5678 !!! ??? ###", "en", "c", None),
        (14, "日本語 の 文章 です 。 <|endoftext|> it's odd", "ja", "c", None), (None, prose(80, 3), "en", "a", None), (None, None, None, None, None),
        (15, "w" * 300_000, "en", "a", None), (16, "the the the the " * 40, "en", "a", None), (17, prose(90, 4), "en", "", None),
    ]


def edges(spark):
    df = spark.createDataFrame(edge_rows(), SCHEMA).repartition(3)
    return df.withColumns({c: F.lit("x") for c in CLASHES})


def empty(spark):
    return edges(spark).where("false")


def words(text):
    return re.findall("[^\x20\x09-\x0d]+", text or "")


def shingles(text, size):
    upper = {k: k + 32 for k in range(65, 91)}
    w = [x.translate(upper) for x in words(text)]
    if not w:
        return frozenset()
    return frozenset(tuple(w[k : k + size]) for k in range(max(len(w) - size + 1, 1)))


class Union:
    def __init__(self, items):
        self.up = {x: x for x in items}

    def find(self, x):
        while self.up[x] != x:
            x = self.up[x]
        return x

    def link(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)
