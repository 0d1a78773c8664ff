"""Toxicity: learnt terms found in spite of misspellings, weighed by their context.

From labelled rows, a bounded sample of ``most_labelled``, terms are learnt that hardly occur in
clean texts: whole words and stems. A trie of the terms is walked together with a
Levenshtein automaton of one edit, so a misspelt word is found as well as an exact one (a
stem needs the start of a word only). Around each hit a window of words tells quotation
from abuse. The evidence, split into plain, quoted and misspelt hits, goes into a logistic score.

Rows whose crc32 of the id is divisible by 5 are held out of everything learnt; a null
id is not held out. Neither ids nor labels nor other columns enter a score. Null and empty
texts have no evidence and get the score of that. Labels may repeat: a document is toxic if any of
its rows says so. Without labels of both kinds nothing is learnt, and every score is the prior.
"""

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from barkeep.llm.batches import Memo, pick, slices, to_batch

MOST_LABELLED, MOST_TERMS, WINDOW = 20_000, 2_000, 6
SHORTEST, LONGEST = 4, 10

# Marks that open or close a quotation.
QUOTES = "\"'“”„‟«»‹›‘’「」"
# Words that report what somebody else said.
REPORTING = frozenset(
    "said says say wrote called calls quote quoted quotes word words term slur insult dit appelé mot "
    "sagte nannte wort dijo llamó palabra".split()
)

_WORD = re.compile(r"[^\W_]+")
SCHEMA = "doc_id long, held_out boolean, score double, predicted int"
_OUT = pa.schema(
    [("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()), ("predicted", pa.int32())]
)


def held_out(column):
    digest = F.crc32(column.cast("string").cast("binary"))
    return F.coalesce(F.pmod(digest, F.lit(5)) == 0, F.lit(False))


class Lexicon:
    """A trie of terms; ``find`` intersects it with the one-edit automaton of a word."""

    def __init__(self, weights):
        """``weights``: term -> weight; a term that ends in * is a stem."""
        self.weights, self.known = dict(weights), None
        self.trie, self.heads, self.cores = {}, set(), set()
        for term in self.weights:
            shown = term.rstrip("*")
            node = self.trie
            for c in shown:
                node = node.setdefault(c, {})
            node[""] = term
            self.heads.add(shown[:2])
            self.cores.add(shown[2:4])

    def may(self, word):
        """Whether one edit may lead to a term: it leaves the first two letters or the next two whole."""
        return word[:2] in self.heads or not self.cores.isdisjoint((word[1:3], word[2:4], word[3:5]))

    def find(self, word):
        """(term, edits) of the best match: fewest edits, then largest weight; None if there is none."""
        best = None
        n = len(word)
        # A state of the automaton: distances of the trie's path to the word's prefixes that are
        # one shorter, as long, and one longer than it. More than one letter apart is out of reach.
        stack = [(self.trie, 0, 9, 0, 1)]
        while stack:
            node, depth, under, even, over = stack.pop()
            term = node.get("")
            if term is not None:
                ends = {depth - 1: under, depth: even, depth + 1: over}
                edits = min(under, even, over) if term.endswith("*") else ends.get(n, 9)
                if edits <= 1:
                    key = (edits, -self.weights[term], term)
                    best = key if best is None else min(best, key)
            here = word[depth : depth + 1]
            last, onward = word[depth - 1 : depth] if depth else "", word[depth + 1 : depth + 2]
            for c, below in node.items():
                if c:
                    new_under = min(even + 1, under + (last != c)) if depth else 1
                    new_even = min(over + 1, new_under + 1, even + (here != c)) if here else 9
                    new_over = min(new_even + 1, over + (onward != c)) if onward else 9
                    if min(new_under, new_even, new_over) <= 1:
                        stack.append((below, depth + 1, new_under, new_even, new_over))
        return None if best is None else (best[2], best[0])

    def matches(self, words):
        """word -> (term, edits) for those words that match."""
        if self.known is None:
            self.known = Memo(self.find)
        known = self.known
        return {word: known[word] for word in filter(self.may, words) if known[word]}


def evidence(lexicon, texts):
    """Per text: summed weights of plain, quoted and misspelt hits, and the largest weight of each."""
    split = [_WORD.findall(text.lower()) for text in texts]
    matches = lexicon.matches(set().union(*split))
    rows = np.zeros((len(texts), 6))
    for i, (text, words) in enumerate(zip(texts, split)):
        if matches.keys().isdisjoint(words):
            continue
        spans = [(m.group(), m.start(), m.end()) for m in _WORD.finditer(text.lower())]
        shown = text.lower()
        for k, (word, start, end) in enumerate(spans):
            hit = matches.get(word)
            if hit is None:
                continue
            left = spans[max(0, k - WINDOW)]
            right = spans[min(len(spans) - 1, k + WINDOW)]
            around = shown[left[1] : start], shown[end : right[2]]
            quoted = all(any(q in part for q in QUOTES if q != "'") for part in around)
            quoted = quoted or any(w in REPORTING for w, _, _ in spans[max(0, k - 2) : k])
            kind = 2 if hit[1] else 1 if quoted else 0
            weight = lexicon.weights[hit[0]]
            rows[i, kind] += weight
            rows[i, 3 + kind] = max(rows[i, 3 + kind], weight)
    rows[:, :3] = np.log1p(rows[:, :3])
    return rows


def _prefixes(text):
    """Words and stems of a text, each once."""
    found = set()
    for word in set(_WORD.findall(text.lower())):
        if len(word) >= SHORTEST:
            found.add(word)
        for n in range(SHORTEST, min(LONGEST, len(word)) + 1):
            found.add(word[:n] + "*")
    return found


def _labelled(texts, labels, most):
    """Toxic flag by id of at most ``most`` labelled rows that are not held out."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    known = known.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    rows = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most).collect()
    return {r["doc_id"]: int(r["toxic"] == 1) for r in rows}


def learn_terms(texts, flags, most_terms=MOST_TERMS):
    """Weights of words and stems that mark toxic texts."""
    schema = pa.schema([("term", pa.string()), ("toxic", pa.int64()), ("clean", pa.int64())])
    known = texts.sparkSession.sparkContext.broadcast(flags)

    def run(batches):
        counts = (Counter(), Counter())
        for batch in batches:
            for rows, raws in slices(batch, "text"):
                for doc, raw in zip(rows.column("doc_id").to_pylist(), raws):
                    if doc in known.value:
                        counts[1 - known.value[doc]].update(_prefixes(raw.decode("utf-8", "replace")))
            if len(counts[0]) + len(counts[1]) > 400_000:
                yield flush(counts)
                counts = (Counter(), Counter())
        yield flush(counts)

    def flush(counts):
        terms = list(counts[0].keys() | counts[1].keys())
        return to_batch(schema, terms, [counts[0][t] for t in terms], [counts[1][t] for t in terms])

    n_toxic = sum(flags.values())
    n_clean = len(flags) - n_toxic
    if not n_toxic or not n_clean:
        return {}
    counted = texts.mapInArrow(run, "term string, toxic long, clean long")
    counted = counted.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    weight = F.log((F.col("toxic") + 0.5) / (n_toxic + 1)) - F.log((F.col("clean") + 0.5) / (n_clean + 1))
    error = F.sqrt(1 / (F.col("toxic") + 0.5) + 1 / (F.col("clean") + 0.5))
    least = max(3, math.ceil(0.01 * n_toxic))
    rows = (
        counted.withColumn("weight", weight)
        .where((F.col("toxic") >= least) & (F.col("weight") > math.log(20)))
        .where(weight - 2 * error > math.log(3))
        .orderBy(F.desc("toxic"), "term")
        .limit(most_terms)
        .collect()
    )
    found = {r["term"]: (r["toxic"], r["weight"]) for r in rows}
    chosen = {}
    for term, (toxic, weight) in found.items():
        # A stem gives way to a longer one, or to a word, that covers nearly the same texts.
        longer = (t for t in found if t != term and t.startswith(term.rstrip("*")) and term.endswith("*"))
        if any(found[t][0] >= 0.9 * toxic for t in longer):
            continue
        chosen[term] = weight
    # What a chosen stem already finds needs no entry of its own.
    stems = {t[:-1] for t in chosen if t.endswith("*")}
    covered = lambda t: any(t.rstrip("*")[:n] in stems for n in range(SHORTEST, len(t.rstrip("*")) + (not t.endswith("*"))))
    return {t: w for t, w in chosen.items() if not covered(t)}


def fit(rows, flags, steps=300, ridge=1.0):
    """Logistic weights (last: the constant) by Newton's steps, drawn towards a small prior."""
    x = np.column_stack([rows, np.ones(len(rows))])
    y = np.asarray(flags, float)
    prior = np.array([1.0, 0.3, 0.3, 0.5, 0.1, 0.1, -3.0])
    w = prior.copy()
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - y) + ridge * (w - prior)
        curve = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(curve, slope)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return w


def toxicity(
    docs, labels, most_labelled=MOST_LABELLED, most_terms=MOST_TERMS, id_col="doc_id", text_col="text"
):
    """One row per row of ``docs``: whether held out, score, and whether that is 0.5 or more."""
    texts = pick(docs, id_col, text_col)
    flags = _labelled(texts, labels, most_labelled)
    lexicon = Lexicon(learn_terms(texts, flags, most_terms))
    known = texts.sparkSession.sparkContext.broadcast(flags)
    names = [f"e{i}" for i in range(6)]
    schema = pa.schema([("toxic", pa.int32()), *((n, pa.float64()) for n in names)])

    def sampled(batches):
        for batch in batches:
            for rows, raws in slices(batch, "text"):
                mine = [
                    (known.value[doc], raw.decode("utf-8", "replace"))
                    for doc, raw in zip(rows.column("doc_id").to_pylist(), raws)
                    if doc in known.value
                ]
                if mine:
                    found = evidence(lexicon, [text for _, text in mine])
                    yield to_batch(schema, [flag for flag, _ in mine], *found.T)

    # Rows of one document may repeat, so the sample is cut again.
    fields = ", ".join(f"{n} double" for n in names)
    sample = texts.mapInArrow(sampled, f"toxic int, {fields}").limit(2 * most_labelled).toPandas()
    if sample["toxic"].nunique() == 2:
        weights = fit(sample[names].to_numpy(), sample["toxic"].to_numpy())
    else:
        weights = np.array([1.0, 0.3, 0.3, 0.5, 0.1, 0.1, -3.0])

    def run(batches):
        for batch in batches:
            for rows, raws in slices(batch, "text"):
                found = evidence(lexicon, [raw.decode("utf-8", "replace") for raw in raws])
                scores = 1 / (1 + np.exp(-np.clip(found @ weights[:-1] + weights[-1], -30, 30)))
                yield to_batch(
                    _OUT, rows.column("doc_id"), rows.column("held_out"), scores, (scores >= 0.5).astype(np.int32)
                )

    return texts.withColumn("held_out", held_out(F.col("doc_id"))).mapInArrow(run, SCHEMA)
