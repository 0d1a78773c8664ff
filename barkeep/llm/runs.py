"""Periodic runs of words, by tiles scaled to the period.

A run is a stretch of words with a smallest period, twice that period long or more (and at least
``SHORTEST`` words), that no neighbouring word extends. Periods fall into octaves: 1 to 7, then 8 to
15, 16 to 31 and so on. For each octave a document is exploded into tiles that overlap by more than
two of the octave's periods, so a run shows in whole or in overlapping parts. Rows carry strips of
neighbouring tiles; strips without a repeated stretch that the octave's runs would need are left out.

A tile is solved alone: a run holds two equal blocks, a period apart, of which the first starts at a multiple of
the block's length. At such boundaries Z-functions forward and backward tell how far the words
agree for every period of the octave. The stretches found are shuffled by document and period,
and those that overlap by a period or more are one run.

Hashes only choose where to look; equality is that of the words themselves. Documents are keyed by
the MD5 of their words, so null and repeated ids do not matter and equal texts share their runs.
Null and empty texts have no words and no runs. Every row of the input gives one row; further
columns are not read.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from barkeep.llm.batches import pick, slices, to_batch
from barkeep.scratch import stage

SHORTEST = 12
# Words of a strip, unless one tile is longer.
STRIP = 4096
# Rows of one text are dealt to so many places, as a text may have any number of copies.
SALTS = 64

_SCANNED = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("key", pa.binary()),
        ("n_words", pa.int64()),
        ("collapsed", pa.string()),
        ("text", pa.string()),
        ("octave", pa.int32()),
        ("at", pa.int32()),
        ("salt", pa.int32()),
        ("codes", pa.binary()),
    ]
)
_PARTS = pa.schema(
    [("key", pa.binary()), ("period", pa.int32()), ("begin", pa.int32()), ("finish", pa.int32())]
)
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_OTHER = np.uint64(0xD6E8FEB86659FD93)


def geometry(octave):
    """(lowest period, first period beyond, block, stride of tiles, overlap of tiles) of an octave."""
    if octave == 0:
        return 1, 8, 3, 36, 18
    low = 4 << octave
    return low, 2 * low, low // 2, 8 * low, 4 * low


def strip_stride(octave):
    stride = geometry(octave)[3]
    return stride * max(1, STRIP // stride)


def word_numbers(words):
    """A number for each word, the same for equal words of the text."""
    last = dict(zip(words, range(len(words))))
    return np.fromiter(map(last.__getitem__, words), np.int32, len(words))


def _mixed(x):
    x = x * _OTHER
    return x ^ (x >> np.uint64(29))


def _joined(left, right, width):
    """Hashes of stretches from those of their first ``width`` words and of the rest."""
    n = len(right) - width
    return _mixed(left[:n] * _FACTOR + right[width:])


def _singles(codes):
    return _mixed((codes.astype(np.uint64) + np.uint64(1)) * _FACTOR)


def stretch_hashes(codes, width):
    """Hash of each stretch of ``width`` words."""
    power, done, found = _singles(codes), 0, None
    size = 1
    while True:
        if width & size:
            found = power if found is None else _joined(found, power, done)
            done += size
        if done == width:
            return found
        power = _joined(power, power, size)
        size *= 2


def live_places(codes):
    """(octave, places) where a run of that octave may lie: equal stretches less than two octaves apart.

    A run of period q agrees with itself q words on over max(q, 12 - q) words or more: over 6 words
    in the first octave, over the octave's lowest period in the others. Places with a longer
    repeated stretch are among those with a shorter one, so they thin out.
    """
    n, octave = len(codes), 0
    if n < SHORTEST:
        return
    hashes, width = stretch_hashes(codes, 6), 6
    ordered = np.sort(hashes)
    if not (ordered[1:] == ordered[:-1]).any():
        return
    places = np.arange(len(hashes))
    while len(places) > 1:
        own = hashes[places]
        order = np.argsort(own, kind="stable")
        same = own[order[1:]] == own[order[:-1]]
        here, there = places[order[:-1][same]], places[order[1:][same]]
        near = here[there - here < geometry(octave)[1]]
        if len(near):
            yield octave, np.sort(near)
        octave += 1
        low = geometry(octave)[0]
        if 2 * low > n:
            return
        hashes = stretch_hashes(codes, low) if octave == 1 else _joined(hashes, hashes, width)
        width = low
        places = np.unique(np.concatenate([here, there]))
        places = places[places < len(hashes)]


def strips(octave, places, n):
    """Starts of the strips that hold any of the places."""
    stride, overlap = strip_stride(octave), geometry(octave)[4]
    number = places // stride
    before = number[(places % stride < overlap) & (number > 0)] - 1
    return [int(s) * stride for s in np.unique(np.concatenate([number, before]))]


def z_values(s, upto):
    """How far ``s`` agrees with itself from each of its first ``upto`` places on."""
    n = len(s)
    z = [0] * min(n, upto)
    left = right = 0
    for i in range(1, len(z)):
        if i < right:
            k = z[i - left]
            if k < right - i:
                z[i] = k
                continue
            k = right - i
        else:
            k = 0
        while i + k < n and s[k] == s[i + k]:
            k += 1
        z[i] = k
        left, right = i, i + k
    return z


def _is_power(codes, begin, period):
    """Whether a stretch of twice the period has a smaller one, which then divides it."""
    rest, prime = period, 2
    while rest > 1:
        if prime * prime > rest:
            prime = rest
        if rest % prime == 0:
            step = period // prime
            if np.array_equal(codes[begin : begin + 2 * period - step], codes[begin + step : begin + 2 * period]):
                return True
            while rest % prime == 0:
                rest //= prime
        prime += 1
    return False


def tile_runs(codes, octave):
    """(period, begin, finish) of the strip's stretches, those of its tiles that overlap joined."""
    low, high, block, stride, overlap = geometry(octave)
    n = len(codes)
    if n < block + low:
        return []
    hashes = stretch_hashes(codes, block)
    boundaries = np.arange(0, len(hashes), block)
    padded = np.concatenate([hashes, np.zeros(high, np.uint64)])
    shifted = np.lib.stride_tricks.sliding_window_view(padded[low:], high - low)[::block][: len(boundaries)]
    row, shift = np.nonzero(shifted == hashes[boundaries][:, None])
    at, period = boundaries[row], shift + low
    inside = at + period + block <= n
    at, period = at[inside], period[inside]
    found, open_runs = [], {}
    for start in range(0, min(n, strip_stride(octave)), stride):
        end = min(n, start + stride + overlap)
        first, last = np.searchsorted(at, [start, start + stride + 1])
        if first == last:
            continue
        tile = codes[start:end].tolist()
        seen = {}
        own_at, own_period = at[first:last], period[first:last]
        edges = np.flatnonzero(np.diff(own_at, prepend=-1))
        for a, b in zip(edges, [*edges[1:], len(own_at)]):
            boundary = int(own_at[a]) - start
            open_periods = [
                q for q in own_period[a:b].tolist() if boundary + q < len(tile) and boundary + q >= seen.get(q, 0)
            ]
            if not open_periods:
                continue
            onward = z_values(tile[boundary:], high)
            before = tile[:boundary][::-1]
            beyond = tile[: boundary + high - 1][::-1]
            back = z_values([*before, -1, *beyond], boundary + 1 + high)
            for q in open_periods:
                forth = onward[q]
                # Where the words before the boundary's shifted place begin, read backward.
                back_q = back[1 + len(beyond) - q] if boundary else 0
                if forth + back_q < max(q, SHORTEST - q):
                    continue
                begin, finish = start + boundary - back_q, start + boundary + q + forth
                seen[q] = finish - start
                held = open_runs.get(q)
                if held and begin + q <= held[1]:
                    held[1] = max(held[1], finish)
                    continue
                if _is_power(codes, begin, q):
                    continue
                if held:
                    found.append((q, *held))
                open_runs[q] = [begin, finish]
    return found + [(q, *held) for q, held in open_runs.items()]


def _scan(batches, rewrite, digest):
    """A row per document, with its whole result if it has no live strip; rows of strips for the others."""
    serial, out, size = 0, [[] for _ in _SCANNED], 0
    for batch in batches:
        for rows, raws in slices(batch, "text"):
            for doc_id, raw in zip(rows.column("doc_id").to_pylist(), raws):
                words = raw.split()
                if rewrite:
                    words = rewrite(doc_id, words)
                n, text = len(words), b" ".join(words)
                key = hashlib.md5(text).digest()
                codes = word_numbers(words)
                made = [
                    (octave, at, codes[at : at + strip_stride(octave) + geometry(octave)[4]].tobytes())
                    for octave, places in live_places(codes)
                    for at in strips(octave, places, n)
                ]
                serial += 1
                salt = serial % SALTS
                whole = None if made else hashlib.sha256(text).hexdigest() if digest else text.decode()
                for column, value in zip(out, (doc_id, key, n, whole, text.decode() if made else None, None, None, salt, None)):
                    column.append(value)
                for octave, at, part in made:
                    for column, value in zip(out, (None, key, None, None, None, octave, at, salt, part)):
                        column.append(value)
                size += len(text) + sum(len(m[2]) for m in made)
                if size > 4_000_000:
                    yield to_batch(_SCANNED, *out)
                    out, size = [[] for _ in _SCANNED], 0
    if out[0]:
        yield to_batch(_SCANNED, *out)


def _solve(batches):
    for batch in batches:
        out = [[] for _ in _PARTS]
        columns = (batch.column(c).to_pylist() for c in ("key", "octave", "at", "codes"))
        for key, octave, at, raw in zip(*columns):
            for period, begin, finish in tile_runs(np.frombuffer(raw, np.int32), octave):
                for column, value in zip(out, (key, period, at + begin, at + finish)):
                    column.append(value)
        yield to_batch(_PARTS, *out)


def stitched(parts):
    """(key, start, length, period): stretches of one period that overlap by a period or more are one run."""
    of_period = Window.partitionBy("key", "period").orderBy("begin", "finish")
    earlier = of_period.rowsBetween(Window.unboundedPreceding, -1)
    reach = F.max("finish").over(earlier)
    fresh = F.when(F.col("begin") + F.col("period") <= reach, 0).otherwise(1)
    return (
        parts.distinct()
        .withColumn("fresh", fresh)
        .withColumn("run", F.sum("fresh").over(of_period.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy("key", "period", "run")
        .agg(F.min("begin").alias("start"), F.max("finish").alias("finish"))
        .select(
            "key",
            F.col("start").cast("long").alias("start"),
            (F.col("finish") - F.col("start")).cast("long").alias("length"),
            F.col("period").cast("long").alias("period"),
        )
    )


def without_repeats(words, runs):
    """The words that no run contains after its first period."""
    drop = np.zeros(len(words), bool)
    for run in runs:
        drop[run["start"] + run["period"] : run["start"] + run["length"]] = True
    return [word for word, gone in zip(words, drop.tolist()) if not gone]


RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"


def periodic_runs(docs, id_col="doc_id", text_col="text", rewrite=None, digest=False):
    """One row per row of ``docs``: ``doc_id``, ``n_words``, ``runs`` and ``collapsed``.

    ``runs`` are (start, length, period) in words, ordered by start, then period. ``collapsed`` is the text's words
    without those that a run contains after its first period, joined by one blank, or with ``digest`` its
    SHA-256. ``rewrite(id, words)``, if given, tells the words (bytes) of a document to go by.
    """
    scanned = stage(
        pick(docs, id_col, text_col).mapInArrow(
            lambda batches: _scan(batches, rewrite, digest),
            "doc_id long, key binary, n_words long, collapsed string, text string, octave int, at int, salt int, codes binary",
        ),
        "scanned",
    )
    tiles = scanned.where("octave is not null").select("key", "octave", "at", "salt", "codes")
    tiles = tiles.repartition("key", "octave", "at", "salt").select("key", "octave", "at", "codes")
    found = stitched(tiles.mapInArrow(_solve, "key binary, period int, begin int, finish int"))
    by_text = found.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("start", "period", "length"))).alias("found"))
    # Staged, so that the join reads plain exchanges and adaptive execution can split a frequent text.
    by_text = stage(
        by_text.select("key", F.expr("transform(found, r -> struct(r.start, r.length, r.period))").alias("runs")), "runs"
    )
    live = scanned.where("octave is null and text is not null").select("doc_id", "key", "n_words", "text")
    live = live.join(by_text, "key", "left").select(
        "doc_id", "n_words", F.coalesce("runs", F.array().cast(RUNS)).alias("runs"), "text"
    )

    def collapse(batches):
        for batch in batches:
            for rows, raws in slices(batch, "text"):
                texts = [b" ".join(without_repeats(raw.split(b" "), runs)) for raw, runs in zip(raws, rows.column("runs").to_pylist())]
                done = [hashlib.sha256(t).hexdigest() if digest else t.decode() for t in texts]
                arrays = [*(rows.column(c) for c in ("doc_id", "n_words", "runs")), pa.array(done, pa.string())]
                yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_words", "runs", "collapsed"])

    changed = live.mapInArrow(collapse, f"doc_id long, n_words long, runs {RUNS}, collapsed string")
    quiet = scanned.where("octave is null and text is null").select(
        "doc_id", "n_words", F.array().cast(RUNS).alias("runs"), "collapsed"
    )
    return quiet.union(changed)
