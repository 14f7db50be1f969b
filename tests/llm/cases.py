"""Rows that every text operator must cope with, and brute-force counterparts."""

import random
import re
import string

ASCII = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
SCHEMA = "doc_id bigint, text string, Node string, __text int, score string, items int, lang string"


def prose(words: int, seed: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdeé") for _ in range(rng.randint(2, 7))) for _ in range(words))


def documents(spark):
    """Nulls, empties, ties, repeated rows, near copies, a long text and clashing columns."""
    base, other, long = prose(120, 1), prose(90, 2), prose(6000, 3)
    words = base.split(" ")
    near = " ".join([*words[:60], "changed", *words[61:]])
    texts = [
        (1, base), (2, base), (3, near), (4, near.upper()), (5, None), (6, ""), (7, "  \t\n"), (8, "one two three"),
        (9, "One TWO three"), (10, other), (10, other), (10, prose(80, 4)), (None, base), (None, None), (None, prose(40, 5)),
        (11, long), (12, prose(30, 6) + "\n" + long[2000:9000]), (13, "x" * 3000), (14, "é" * 400 + " 中文 \U0001f600"),
        (15, "the Wh 12 !!"), (16, long[:99]), (17, long[:100]), (18, "a\x00b <|endoftext|> it's </s>[INST]"),
    ]
    return spark.createDataFrame([(i, t, "n", 1, "s", 2, None) for i, t in texts], SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def shingles(text) -> frozenset:
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(ASCII))
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def components(sets, alike):
    """Number of the component of each element, by comparing all pairs."""
    label = list(range(len(sets)))
    for i in range(len(sets)):
        for j in range(i):
            if alike(sets[i], sets[j]) and label[i] != label[j]:
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    return label


def least(values):
    return min((v for v in values if v is not None), default=None)
