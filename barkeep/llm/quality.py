"""Quality classifier from weak labels.

Heuristic labellers each vote junk, clean, or not at all on a text; several may overlap.
Expectation-maximisation over the counts of vote patterns, taken over all rows, estimates how
often each labeller votes what for junk and for clean texts and how much junk there is. A labeller
that does not vote says nothing. The posterior of its pattern is a text's weak label, and on a bounded sample a linear scorer
of hashed features (byte-class trigrams and ranges of the measured shares) is fitted to it. The sample
is the ``most_fitted`` different texts of least hash, each weighted by how many rows hold it: a text that fills a third of
all rows is drawn at most once, and neither files nor their order matter.
The scorer then judges every text. At most 3^7 patterns, and the features of the sample, come to the driver. No labels, languages or sources are used.

Null and empty texts give no vote and count as clean: there is nothing to reject. Repeated rows are
judged alike; ids are only carried along.
"""

from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from barkeep.llm.batches import pick, slices, to_batch

MOST_FITTED, WIDTH = 5_000, 1024
JUNK, CLEAN, NONE = 1, 0, 2
# Share of clean texts on which a labeller is believed to vote junk, and how firmly, in corpus sizes.
CRIES, BELIEF = 0.002, 50

# Share measured, clean below, junk above (for distinct words the other way round).
LABELLERS = (
    ("marks", 0.15, 0.6),
    ("repeated", 0.08, 0.3),
    ("upper", 0.25, 0.5),
    ("bangs", 0.1, 0.4),
    ("pipes", 0.05, 0.25),
    ("same", 0.75, 0.85),
    ("lines", 0.3, 0.6),
)

_UPPER = bytes(range(65, 91))
_LETTERS = _UPPER + bytes(range(97, 123)) + bytes(range(128, 256))
_MARKS = b"#$%&*<>{}[]\\^~@=_+/"
# Byte classes: lower case and beyond ASCII, upper case, digit, blank, line break, and marks by kind.
_CLASSES = bytes(
    0 if 97 <= c <= 122 or c >= 128
    else 1 if 65 <= c <= 90
    else 2 if 48 <= c <= 57
    else 3 if c in b" \t"
    else 4 if c in b"\r\n"
    else 5 if c in b".,;:"
    else 6 if c in b"!?"
    else 7 if c in b"|"
    else 8 if c in b"\"'()-"
    else 9
    for c in range(256)
)

SCHEMA = "doc_id long, votes string, score double, keep boolean"
_OUT = pa.schema(
    [("doc_id", pa.int64()), ("votes", pa.string()), ("score", pa.float64()), ("keep", pa.bool_())]
)


def shares(raw):
    """What the labellers measure on a text, or None if it has no words."""
    words = raw.split()
    n = len(words)
    if not n:
        return None
    letters = n_of(raw, _LETTERS)
    lines = [line for line in raw.split(b"\n") if line.strip()]
    return (
        n_of(raw, _MARKS) / n,
        sum(map(eq, words, words[1:])) / n,
        n_of(raw, _UPPER) / max(1, letters),
        raw.count(b"!") / n,
        raw.count(b"|") / n,
        1 - len(set(words)) / n if n >= 20 else 0.8,
        1 - len(set(lines)) / len(lines) if len(lines) >= 4 else 0.45,
    )


def n_of(raw, chars):
    return len(raw) - len(raw.translate(None, chars))


def votes_of(found):
    """One figure per labeller: 0 clean, 1 junk, 2 no vote."""
    if found is None:
        return "2" * len(LABELLERS)
    return "".join(
        str(CLEAN if x < clean else JUNK if x > junk else NONE) for x, (_, clean, junk) in zip(found, LABELLERS)
    )


def features(raw, found, width=WIDTH):
    """Hashed features of a text, as shares of its byte trigrams plus one entry per measured range."""
    row = np.zeros(width, np.float32)
    shown = np.frombuffer(raw.translate(_CLASSES), np.uint8).astype(np.int32)
    if len(shown) >= 3:
        codes = shown[:-2] * 10007 + shown[1:-1] * 101 + shown[2:]
        row += np.sqrt(np.bincount(codes % (width - 128), minlength=width) / len(codes)).astype(np.float32)
    for i, x in enumerate(found or ()):
        row[width - 128 + (i * 31 + min(12, int(x * 12)) * 7) % 128] += 0.3
    return row


def posteriors(counts, steps=100):
    """Chance of junk per vote pattern, by expectation-maximisation over their counts."""
    patterns = sorted(counts)
    if not patterns:
        return {}
    table = np.array([[int(c) for c in p] for p in patterns])
    n = np.array([counts[p] for p in patterns], float)
    junk = np.where((table == JUNK).any(axis=1), 0.9, 0.02)
    voted, said = table != NONE, table == JUNK
    # What is believed of a labeller beforehand, as (junk votes, votes): on clean texts it hardly ever
    # cries junk, and that belief outweighs the data, as labellers that each know a kind of junk of their
    # own would otherwise be taken for noise; on junk it may see three cases in ten.
    believed = ((CRIES * BELIEF * n.sum(), BELIEF * n.sum()), (0.6, 2.0))
    for _ in range(steps):
        weight = np.stack([n * (1 - junk), n * junk])
        prior = (weight.sum(axis=1) + 1) / (n.sum() + 2)
        score = np.log(prior)[:, None] + np.zeros(len(n))
        for k in (CLEAN, JUNK):
            cries, votes = believed[k]
            rate = ((weight[k][:, None] * said).sum(axis=0) + cries) / (
                (weight[k][:, None] * voted).sum(axis=0) + votes
            )
            rate = np.clip(rate, 1e-6, 1 - 1e-6)
            score[k] += np.where(voted, np.where(said, np.log(rate), np.log(1 - rate)), 0).sum(axis=1)
        new = 1 / (1 + np.exp(np.clip(score[0] - score[1], -50, 50)))
        done = np.abs(new - junk).max() < 1e-9
        junk = new
        if done:
            break
    # Without any vote there is nothing to go by.
    junk = np.where((table == NONE).all(axis=1), 0.0, junk)
    return dict(zip(patterns, junk.tolist()))


def fit(x, y, n, steps=400, rate=0.3, ridge=1e-4):
    """Weights of a logistic scorer (last: the constant) for labels between 0 and 1, of rows that stand for ``n`` each."""
    x = np.column_stack([x, np.ones(len(x), np.float32)])
    n = n / n.sum()
    w = np.zeros(x.shape[1])
    first, second = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, steps + 1):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ ((p - y) * n) + ridge * w
        first = 0.9 * first + 0.1 * slope
        second = 0.999 * second + 0.001 * slope**2
        w -= rate * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-8)
    return w


def drawn_texts(texts, most_fitted=MOST_FITTED):
    """(text, n): the different texts of least hash, at most ``most_fitted``, and how many rows hold each.

    Texts are told apart by 64-bit hashes; only hashes and counts of all texts are shuffled.
    """
    hashed = texts.select(F.coalesce("text", F.lit("")).alias("text")).withColumn("h", F.xxhash64("text"))
    least = hashed.groupBy("h").count().orderBy("h").limit(most_fitted)
    last = least.agg(F.max("h")).first()[0]
    # Copies of a drawn text become one row before the shuffle.
    return hashed.where(F.col("h") <= last).groupBy("h").agg(F.first("text").alias("text"), F.count("*").alias("n"))


def learn(texts, most_fitted=MOST_FITTED):
    """Weights of the scorer for a table with ``text``."""

    def vote(batches):
        schema = pa.schema([("votes", pa.string())])
        for batch in batches:
            for _, raws in slices(batch, "text"):
                yield to_batch(schema, [votes_of(shares(raw)) for raw in raws])

    counted = texts.select("text").mapInArrow(vote, "votes string").groupBy("votes").count()
    counts = {r["votes"]: r["count"] for r in counted.collect()}
    chance = posteriors(counts)
    if not counts:
        return np.zeros(WIDTH + 1)

    def measure(batches):
        schema = pa.schema([("h", pa.int64()), ("n", pa.int64()), ("junk", pa.float64()), ("row", pa.binary())])
        for batch in batches:
            for rows, raws in slices(batch, "text"):
                found = [shares(raw) for raw in raws]
                yield to_batch(
                    schema,
                    rows.column("h"),
                    rows.column("n"),
                    [chance.get(votes_of(f), 0.0) for f in found],
                    [features(raw, f).tobytes() for raw, f in zip(raws, found)],
                )

    drawn = drawn_texts(texts, most_fitted).select("h", "n", "text")
    rows = drawn.mapInArrow(measure, "h long, n long, junk double, row binary").collect()
    rows.sort(key=lambda r: r["h"])
    x = np.stack([np.frombuffer(r["row"], np.float32) for r in rows])
    return fit(x, np.array([r["junk"] for r in rows]), np.array([float(r["n"]) for r in rows]))


def _scores(weights, raws, found):
    rows = np.stack([features(raw, f) for raw, f in zip(raws, found)])
    junk = 1 / (1 + np.exp(-np.clip(rows @ weights[:-1] + weights[-1], -30, 30)))
    return np.where([f is None for f in found], 1.0, 1 - junk)


def quality(docs, threshold=0.5, most_fitted=MOST_FITTED, id_col="doc_id", text_col="text"):
    """One row per row of ``docs``: votes, score (1: clean) and whether it is kept."""
    texts = pick(docs, id_col, text_col)
    weights = learn(texts, most_fitted)

    def run(batches):
        for batch in batches:
            for rows, raws in slices(batch, "text"):
                found = [shares(raw) for raw in raws]
                scores = _scores(weights, raws, found)
                yield to_batch(
                    _OUT, rows.column("doc_id"), [votes_of(f) for f in found], scores, scores >= threshold
                )

    return texts.mapInArrow(run, SCHEMA)


def keep_quality(docs, threshold=0.5, most_fitted=MOST_FITTED, text_col="text"):
    """The rows of ``docs`` whose texts score ``threshold`` or more, unchanged."""
    texts = docs.select(F.col(f"`{text_col}`").cast("string").alias("text"))
    weights = learn(texts, most_fitted)

    def run(batches):
        for batch in batches:
            for rows, raws in slices(batch, text_col):
                found = [shares(raw) for raw in raws]
                yield rows.filter(pa.array(_scores(weights, raws, found) >= threshold))

    return docs.mapInArrow(run, docs.schema)
