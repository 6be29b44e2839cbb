"""Small tables with the rows that break things, and brute-force forms."""

import re

from pyspark.sql import functions as F

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use for results or inside; a documents table may have them too.
CLASHING = ["size", "score", "kept", "copies", "n_words", "shard", "slot", "removed_words", "label", "rep", "rank"]


def sentence(n, k=0):
    return " ".join(f"w{(i * 7 + k * 13) % 997}x{k}" for i in range(n)) + "."


def awkward_rows():
    long = " ".join(f"t{i % 5003}y{i % 11}" for i in range(60_000))
    rows = [
        (0, "", "en", "s1"), (1, None, None, None), (2, "   \n\t ", "en", "s1"), (3, "one", None, "s2"),
        (4, "Straße café naïve 　日本 語 " + sentence(30, 1), "de", "s2"),
        (5, sentence(120, 2), "en", None), (6, sentence(120, 2), "en", "s1"), (6, sentence(120, 2), "en", "s1"),
        (7, sentence(120, 2) + " tail of it.", "en", "s3"), (None, sentence(40, 3), "en", "s3"), (None, None, None, None),
        (8, "be " * 300, "en", "s1"), (9, long, "en", "s1"), (10, "x" * 200_000, "en", "s2"),
        (-11, sentence(60, 4) + "\n" + sentence(60, 4), "fr", "s2"), (12, "a b c d", "en", "s1"), (13, "a b c d", "en", "s1"),
        (14, "a b c e", "en", "s1"), (15, "퟿\U0001f600 emoji \U0001f600 line sep", "en", "s9"),
    ]
    return [(i, t, lang, s, len(t) if t is not None else None) for i, t, lang, s in rows]


def documents(spark, rows=None):
    """The awkward rows with a column of each clashing name."""
    df = spark.createDataFrame(awkward_rows() if rows is None else rows, SCHEMA)
    return df.withColumns({c: F.lit("clash") for c in CLASHING})


def empty(spark):
    return documents(spark, []).select("*")


def words(text):
    return WORD.findall(text or "")


_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = words((text or "").translate(_LOWER))
    return {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute_components(rows, percent=75):
    """component of each distinct (doc_id, text) by comparing all pairs."""
    nodes = sorted({(i, t) for i, t in rows if i is not None and shingles(t)}, key=lambda x: (x[0], x[1]))
    sets = [shingles(t) for _, t in nodes]
    parent = list(range(len(nodes)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(nodes)):
        for b in range(a):
            shared = len(sets[a] & sets[b])
            if 100 * shared >= percent * (len(sets[a]) + len(sets[b]) - shared):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {n: nodes[find(k)][0] for k, n in enumerate(nodes)}


def brute_repeats(docs, k=50):
    """{doc_id: flags} of the words in a window of ``k`` that an earlier place has."""
    seen, out = set(), {}
    for i, text in sorted(docs):
        w = words(text)
        gone = [False] * len(w)
        for p in range(len(w) - k + 1):
            g = tuple(w[p:p + k])
            if g in seen:
                gone[p:p + k] = [True] * k
            else:
                seen.add(g)
        out[i] = gone
    return out
