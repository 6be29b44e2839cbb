"""Toxicity from a weighted lexicon, matched by an Aho-Corasick automaton after folding.

Texts are folded first: lower case, look-alike letters to Latin ones, digits and signs
that stand for letters to those letters.  Lexicon entries are words and beginnings of
words with their log odds; hits inside an exception phrase do not count.  The sum of
a text's hits, alone and per word, gives the score.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewright.llm import training as T
from pagewright.llm.common import written

# Letters that look like a Latin letter, by that letter.
HOMOGLYPHS = {
    "a": "аα＠ａ", "b": "ЬｂḃВ", "c": "сϲｃ", "d": "ԁｄ", "e": "еεҽｅ", "g": "ɡｇ", "h": "һｈ", "i": "іιıｉ",
    "j": "јｊ", "k": "кκｋ", "l": "ӏⅼｌ", "m": "мｍ", "n": "ոｎ", "o": "оοօｏ", "p": "рρｐ", "q": "ԛｑ",
    "r": "гｒ", "s": "ѕｓ", "t": "тτｔ", "u": "υսｕ", "v": "ѵνｖ", "w": "ԝωｗ", "x": "хχｘ", "y": "уγｙ", "z": "ｚ",
}
# Digits and signs that stand for a letter inside a word.
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"}
#: Invisible characters that split a word without showing.
INVISIBLE = "​‌‍⁠﻿­"

_TABLE = {ord(c): k for k, cs in HOMOGLYPHS.items() for c in cs} | {ord(c): None for c in INVISIBLE}
_SUBSTITUTED = re.compile(r"(?<=[^\W\d_])[013457@$]+(?=[^\W\d_])|(?<![^\s])[013457@$]+(?=[^\W\d_])|(?<=[^\W\d_])[013457]+(?!\w)")
_LETTERS = str.maketrans(SUBSTITUTES)
_WORD = re.compile(r"[^\W\d_]+")

#: Beginnings of words that may be lexicon entries have these lengths.
PREFIXES = (4, 5, 6)
#: An entry needs so many toxic training documents.
MIN_DOCS = 3
#: Up to so many entries with that support are looked for in the other rows by name; beyond,
#: the entries of both are counted in full and joined.
BY_NAME = 200_000
#: An entry needs this weight (log odds of a toxic against another document).
MIN_WEIGHT = 3.2
#: A phrase around a hit is an exception from so many documents that are not toxic on.
MIN_EXCEPTION = 3
SAMPLE = 6000


def fold(text: str) -> str:
    low = text.lower()
    if not low.isascii():
        low = low.translate(_TABLE)
    return _SUBSTITUTED.sub(lambda m: m[0].translate(_LETTERS), low)


def entries(text: str) -> set[str]:
    """Possible lexicon entries of a text: its words, marked by ``=``, and their beginnings."""
    out: set[str] = set()
    for w in set(_WORD.findall(fold(text))):
        if len(w) >= 3:
            out.add("=" + w)
        out.update(w[:k] for k in PREFIXES if len(w) >= k)
    return out


@dataclass
class Lexicon:
    weights: dict[str, float]
    exceptions: set[str] = field(default_factory=set)
    logistic: tuple[float, float, float] = (1.0, 0.0, -3.0)
    prior: float = 0.5

    def automaton(self):
        by: dict[str, tuple[float, float]] = {}
        for e, w in self.weights.items():
            whole, part = by.get(e.lstrip("="), (0.0, 0.0))
            by[e.lstrip("=")] = (max(whole, w), part) if e[0] == "=" else (whole, max(part, w))
        found = ahocorasick.Automaton()
        for e, ws in by.items():
            found.add_word(e, (e, *ws))
        if by:
            found.make_automaton()
        return found if by else None


def hits(text: str, automaton) -> list[tuple[int, int, float]]:
    """``(start, end, weight)`` of the words of a folded text that the lexicon knows,
    each word once with its highest weight."""
    best: dict[int, float] = {}
    for last, (entry, whole, part) in automaton.iter(text):
        start = last - len(entry) + 1
        if start and text[start - 1].isalpha():
            continue
        ends = last + 1 == len(text) or not text[last + 1].isalpha()
        w = max(part, whole) if ends else part
        if w > best.get(start, 0.0):
            best[start] = w
    return [(s, _WORD.match(text, s).end(), w) for s, w in sorted(best.items())]


def phrases(text: str, start: int, end: int) -> list[str]:
    """The word at a span with the word before it, and with the word after it."""
    end_before = start
    while end_before and not _WORD.match(text[end_before - 1]):
        end_before -= 1
    begin = end_before
    while begin and _WORD.match(text[begin - 1]):
        begin -= 1
    after = _WORD.search(text, end)
    out = [text[begin:end_before] + " " + text[start:end]] if begin < end_before else []
    return out + ([text[start:end] + " " + after[0]] if after else [])


def measure(text: str, automaton, exceptions: set[str]) -> tuple[float, int]:
    """The weights of a text's hits in sum, without those in an exception, and its words."""
    folded = fold(text)
    total = 0.0
    for start, end, w in hits(folded, automaton) if automaton is not None else ():
        if not exceptions or not any(p in exceptions for p in phrases(folded, start, end)):
            total += w
    return total, len(text.split())


def columns(total, words) -> np.ndarray:
    """What the score is a function of: hits, and hits by length."""
    return np.column_stack([np.log1p(total), np.log1p(np.asarray(total) / np.sqrt(np.asarray(words) / 100 + 1))])


def _counted(of):
    """A function over batches that counts, per label, what ``of`` gives for a text."""
    def run(batches):
        seen = (Counter(), Counter())
        for pdf in batches:
            for text, y in zip(pdf["text"], pdf["y"]):
                seen[y].update(of(text))
        yield pd.DataFrame([(k, seen[0][k], seen[1][k]) for k in seen[0].keys() | seen[1].keys()], columns=["entry", "n0", "n1"])

    return run


def _count(rows: DataFrame, of) -> DataFrame:
    return (rows.select("text", "y").mapInPandas(_counted(of), "entry string, n0 long, n1 long")
            .groupBy("entry").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")))


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", folds: int = 4, held_out: int = 2,
        exceptions: set[str] = frozenset(), sample: int = SAMPLE) -> Lexicon:
    """A lexicon from all labelled rows outside the held-out fold.

    Entries are counted and weighed on the executors; those with enough support and weight,
    the lexicon itself, come to the driver.  Only the last step, a logistic regression on two
    numbers, uses a sample of at most ``sample`` rows.  Without labels of both kinds the
    lexicon is empty and every score is the share of toxic rows.  Labels that repeat or have
    no row change nothing; a null text counts as empty.
    """
    wanted = T.training_labels(labels, label, folds, held_out)
    size = {r["y"]: r["n"] for r in wanted.join(docs.select("doc_id"), "doc_id").groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    n0, n1 = size.get(0, 0), size.get(1, 0)
    prior = (n1 + 1) / (n0 + n1 + 2)
    if not n0 or not n1:
        return Lexicon({}, set(exceptions), (0.0, 0.0, float(np.log(prior / (1 - prior)))), prior)
    rows = T.labelled(docs, wanted)
    known = written(_count(rows.where("y = 1"), entries).where(F.col("n1") >= MIN_DOCS).select("entry", "n1"))
    names = {r["entry"] for r in known.select("entry").collect()} if known.count() <= BY_NAME else None
    other = _count(rows.where("y = 0"), entries if names is None else lambda t: entries(t) & names).select("entry", "n0")
    weight = F.log((F.col("n1") + 0.5) / (n1 + 1)) - F.log((F.coalesce("n0", F.lit(0)) + 0.5) / (n0 + 1))
    chosen = known.join(other, "entry", "left").withColumn("w", weight).where(F.col("w") >= MIN_WEIGHT)
    weights = {r["entry"]: r["w"] for r in chosen.collect()}
    lexicon = Lexicon(weights, set(exceptions), prior=prior)

    def around(text):
        folded, automaton = fold(text), _automaton(lexicon)
        return {p for s, e, _ in hits(folded, automaton) for p in phrases(folded, s, e)} if automaton is not None else ()

    # an exception is far more usual around the hits of other rows than of toxic ones
    found = _count(rows, around).where((F.col("n0") >= MIN_EXCEPTION) & (F.col("n0") / n0 > 2.0 * (F.col("n1") + 1) / n1)).collect()
    lexicon.exceptions |= {r["entry"] for r in found}

    known_exceptions, part = lexicon.exceptions, T.labelled(docs, T.bounded_sample(wanted, sample))

    def measured(batches):
        automaton = _automaton(lexicon)
        for pdf in batches:
            got = [measure(t, automaton, known_exceptions) for t in pdf["text"]]
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "y": pdf["y"], "total": [g[0] for g in got], "words": [g[1] for g in got]})

    pdf = part.mapInPandas(measured, "doc_id long, y int, total double, words long").toPandas().sort_values("doc_id", kind="stable")
    if pdf["y"].nunique() == 2:
        lexicon.logistic = tuple(T.logistic(columns(pdf["total"], pdf["words"]), pdf["y"].to_numpy(float)))
    return lexicon


_BUILT: dict[int, tuple[Lexicon, object]] = {}


def _automaton(lexicon: Lexicon):
    """The automaton of a lexicon, built once in each Python worker."""
    if id(lexicon) not in _BUILT:
        _BUILT.clear()
        _BUILT[id(lexicon)] = lexicon, lexicon.automaton()
    return _BUILT[id(lexicon)][1]


def score(docs: DataFrame, lexicon: Lexicon, threshold: float = 0.3) -> DataFrame:
    """``doc_id, score, predicted`` of every row of ``docs``.  Only the text is read;
    a null or empty text has no hits.  Other columns are left out; an empty table gives
    an empty result."""

    def scored(batches):
        automaton, w = _automaton(lexicon), np.array(lexicon.logistic)
        for pdf in batches:
            got = [measure(t, automaton, lexicon.exceptions) for t in pdf["text"]]
            x = columns([g[0] for g in got], [g[1] for g in got]) if got else np.zeros((0, 2))
            p = T.sigmoid(x @ w[:2] + w[2])
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "score": p, "predicted": (p >= threshold).astype(np.int32),
                                "hits": [g[0] for g in got]})

    rows = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return rows.mapInPandas(scored, "doc_id long, score double, predicted int, hits double")
