"""Repeated byte strings across a corpus, by prefix doubling over sampled suffixes.

A byte is repeated if a string of ``least`` bytes over it also starts anywhere else in the
corpus. Three ideas keep Spark's sorts small:

* Of the suffixes only a sample is ranked at first. A string of ``least`` bytes is filed
  under the place in it where the hash of the next ``least // 4`` bytes is smallest. Equal
  strings are filed alike, so a place whose sample is unique settles all starts filed there.
* Starts filed under one place are ranked in blocks of neighbours, by what all strings of the
  block share. Prefixes double: (rank of the sample, next stretch), then (rank of the half,
  rest of the core); Spark groups the pairs, gives new ranks and drops what became unique.
* Blocks that agree beyond the core, in all bytes their strings cover, are settled whole.
  Only the rest is ranked start by start, up to the full length.

Equality is that of 64-bit hashes within equal 64-bit samples. Texts are keyed by their MD5, so
neither null nor repeated ids matter: rows of equal text get equal spans, and rows that share a
text of ``least`` bytes or more are repeated throughout. Null texts count as empty.

The same ranks work on words instead of bytes: each word then stands as the eight bytes of its
hash, and lengths and places count words.
"""

import hashlib
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from barkeep.llm.batches import Memo, slices, tidied, to_batch, unused_names
from barkeep.scratch import stage

LEAST = 400
BLOCK = 32
# Starts whose hashes are held at once, of one text or of several; they take a hundred times their size.
PIECE = 100_000

_PLACES = pa.schema(
    [("th", pa.binary()), ("sample", pa.int64()), ("at", pa.int32()), ("low", pa.int32()), ("high", pa.int32())]
)
_BLOCKS = pa.schema(
    [
        ("th", pa.binary()),
        ("u", pa.int64()),
        ("sample", pa.int64()),
        ("block", pa.int32()),
        ("half", pa.int64()),
        ("rest", pa.int64()),
        ("left", pa.binary()),
        ("right", pa.binary()),
        ("at", pa.int32()),
        ("low", pa.int32()),
        ("high", pa.int32()),
    ]
)
_STEP = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64
_BACK = pow(_STEP, -1, 1 << 64)
_BYTES = np.random.default_rng(400).integers(1, 1 << 63, 256, dtype=np.int64).astype(np.uint64)
_PLACE = np.uint64((1 << 31) - 1)
_powers = {}

# Words stand between blanks; characters of scripts without blanks (kana, Han) are words each.
_WORD = re.compile(rb"[^\s\xe3-\xe9]+|[\xe3-\xe9][\x80-\xbf]*")
_CODE = 8
_codes = Memo(lambda word: xxhash.xxh64_digest(word))


def word_codes(raw):
    """The words of a text, ``_CODE`` bytes each."""
    return b"".join(map(_codes.__getitem__, _WORD.findall(raw)))


def _power(base, n):
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        steps = np.full(size, base, np.uint64)
        steps[0] = 1
        have = np.cumprod(steps, dtype=np.uint64)
        _powers[base] = have
    return have[:n]


def window_hashes(raw, width, words=False):
    """Hash of each ``width`` bytes (or word codes) of a text, by one pass of prefix sums."""
    values = np.frombuffer(raw, np.uint64) if words else _BYTES[np.frombuffer(raw, np.uint8)]
    n = len(values)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * _power(_STEP, n), dtype=np.uint64)])
    found = (sums[width:] - sums[:-width]) * _power(_BACK, n - width + 1)
    found ^= found >> np.uint64(32)
    found *= np.uint64(0xD6E8FEB86659FD93)
    return found ^ (found >> np.uint64(29))


def sliding_least(values, width):
    """Smallest of each ``width`` neighbours."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    rows = padded.reshape(-1, width)
    onward = np.minimum.accumulate(rows, axis=1).ravel()
    back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - width + 1], onward[width - 1 : n])


def places(hashes, width):
    """Where strings are filed: (place, first start, last start) for runs of starts.

    ``hashes`` are of one text's samples, ``width`` the samples in a string. The upper 33 bits
    decide, of equals the leftmost, so the place depends on the string alone.
    """
    keys = (hashes & ~_PLACE) | np.arange(len(hashes), dtype=np.uint64)
    at = (sliding_least(keys, width) & _PLACE).astype(np.int64)
    edges = np.flatnonzero(np.diff(at)) + 1
    starts = np.concatenate([[0], edges])
    ends = np.concatenate([edges, [len(at)]]) - 1
    return at[starts], starts, ends


def _filed(raw, least, sample, words):
    """(hash of the sample, place, first start, last start) of one text of ``least`` or more, piece by piece."""
    unit = _CODE if words else 1
    starts, found = len(raw) // unit - least + 1, []
    for begin in range(0, starts, PIECE):
        part = raw[begin * unit : (min(starts, begin + PIECE) + least - 1) * unit]
        hashes = window_hashes(part, sample, words)
        at, low, high = places(hashes, least - sample + 1)
        mine = [hashes[at], at + begin, low + begin, high + begin]
        if found and found[-1][1][-1] == mine[1][0]:
            # The starts on either side of a cut are filed under one place.
            mine[2][0] = found[-1][2][-1]
            found[-1] = [column[:-1] for column in found[-1]]
        found.append(mine)
    return [np.concatenate(column) for column in zip(*found)]


def _file_strings(batches, least, sample, words):
    unit = _CODE if words else 1
    for batch in batches:
        for rows, raws in slices(batch, "text", PIECE):
            keys, out = rows.column("th").to_pylist(), ([], [], [], [], [])
            raws = [word_codes(raw) for raw in raws] if words else raws
            together = sum(map(len, raws)) <= 2 * PIECE * unit
            whole = window_hashes(b"".join(raws) + bytes(sample * unit), sample, words) if together else None
            start = 0
            for key, raw in zip(keys, raws):
                size = len(raw) // unit
                if size >= least:
                    if together:
                        hashes = whole[start : start + size - sample + 1]
                        at, low, high = places(hashes, least - sample + 1)
                        filed = (hashes[at], at, low, high)
                    else:
                        filed = _filed(raw, least, sample, words)
                    for column, part in zip(out, ([key] * len(filed[1]), filed[0].view(np.int64), *filed[1:])):
                        column.append(part)
                start += size
            if out[0]:
                yield to_batch(
                    _PLACES,
                    sum(out[0], []),
                    *(np.concatenate(part).astype(kind) for part, kind in zip(out[1:], ("i8", "i4", "i4", "i4"))),
                )


def _blocks_of(batches, least, block, words):
    """Rows for the blocks of starts filed under repeated samples."""
    size = _CODE if words else 1
    core, digest = least - block + 1, lambda raw: xxhash.xxh3_64_intdigest(raw) - (1 << 63)
    for batch in batches:
        for rows, raws in slices(batch, "text"):
            out = [[] for _ in _BLOCKS]
            for key, raw, spots in zip(rows.column("th").to_pylist(), raws, rows.column("spots").to_pylist()):
                raw = word_codes(raw) if words else raw
                for spot in spots:
                    at, sample = spot["at"], spot["sample"]
                    nearest, farthest = at - spot["high"], at - spot["low"]
                    for number in range(nearest // block, farthest // block + 1):
                        near, far = max(nearest, number * block), min(farthest, number * block + block - 1)
                        begin = at - number * block
                        end = begin - block + 1 + least
                        unit = digest(b"%b,%d,%d" % (key, at, number))
                        cut = lambda a, b: raw[a * size : b * size]  # noqa: B023, E731
                        half = digest(cut(begin, begin + core // 2))
                        rest = digest(cut(begin + core // 2, end))
                        row = (key, unit, sample, number, half, rest,
                               cut(at - far, begin), cut(end, at - near + least), at, at - far, at - near)
                        for column, value in zip(out, row):
                            column.append(value)
                    if len(out[0]) > 20_000:
                        yield to_batch(_BLOCKS, *out)
                        out = [[] for _ in _BLOCKS]
            yield to_batch(_BLOCKS, *out)


def _rerank(rows, *pair):
    """Rows whose pair is shared with another row, with the pair's ``rank``; ``mixed`` if their outer bytes differ."""
    outer = F.xxhash64("left", "right")
    # Staged, so that the join reads plain exchanges and adaptive execution can split a frequent pair.
    shared = stage(
        rows.groupBy(*pair)
        .agg(F.min("u").alias("new"), F.max("u").alias("other"), F.min(outer).alias("a"), F.max(outer).alias("b"))
        .where("new <> other")
        .select(*(F.col(c).alias(f"_{c}") for c in pair), F.col("new"), F.expr("a <> b").alias("_mixed")),
        "shared",
    )
    same = [F.col(c) == F.col(f"_{c}") for c in pair]
    on = same[0]
    for more in same[1:]:
        on = on & more
    keep = [c for c in rows.columns if c not in (*pair, "rank", "mixed")]
    return rows.join(shared, on).select(*keep, F.col("new").alias("rank"), F.col("_mixed").alias("mixed"))


def repeated_spans(texts, least=LEAST, words=False):
    """(th, spans): per text hash, its repeated stretches as (begin, end) pairs that may overlap.

    ``texts`` has ``th`` and ``text``; texts without a repeated stretch are left out. With
    ``words``, ``least`` and the pairs count words.
    """
    size = _CODE if words else 1
    sample, block = max(1, least // 4), max(1, min(BLOCK, least // 8))
    core = least - block + 1
    filed = stage(
        texts.mapInArrow(
            tidied(lambda batches: _file_strings(batches, least, sample, words), _codes),
            "th binary, sample long, at int, low int, high int",
        ),
        "filed",
    )
    unit = F.xxhash64("th", "at")
    shared = stage(
        filed.groupBy("sample")
        .agg(F.min(unit).alias("one"), F.max(unit).alias("other"))
        .where("one <> other")
        .select(F.col("sample").alias("_sample")),
        "shared",
    )
    spots = (
        filed.join(shared, F.col("sample") == F.col("_sample"))
        .groupBy(F.col("th").alias("_th"))
        .agg(F.collect_set(F.struct("at", "sample", "low", "high")).alias("spots"))
    )
    # One of each text, however many copies it has; tasks send one a text.
    single = texts.groupBy("th").agg(F.first("text").alias("text"))
    blocks = stage(
        single.join(spots.hint("shuffle_hash"), F.col("th") == F.col("_th"))
        .select("th", "text", "spots")
        .mapInArrow(
            tidied(lambda batches: _blocks_of(batches, least, block, words), _codes),
            "th binary, u long, sample long, block int, half long, rest long, "
            "left binary, right binary, at int, low int, high int",
        ),
        "blocks",
    )
    halves = _rerank(blocks, "sample", "block", "half")
    cores = stage(_rerank(halves, "rank", "rest"), "cores")
    covered = lambda df: df.select(
        "th", F.struct(F.col("low").alias("begin"), (F.col("high") + least).alias("end")).alias("span")
    )
    alike = covered(cores.where("not mixed"))
    mixed = cores.where("mixed")
    groups = mixed.groupBy("rank", "left", "right").agg(F.min("u").alias("one"), F.max("u").alias("other"))
    groups = stage(groups, "groups")
    grouped = stage(
        mixed.join(
            groups.select(
                F.col("rank").alias("_rank"), F.col("left").alias("_left"), F.col("right").alias("_right"), "one", "other"
            ),
            (F.col("rank") == F.col("_rank")) & (F.col("left") == F.col("_left")) & (F.col("right") == F.col("_right")),
        ).select("th", "u", "rank", "left", "right", "at", "low", "high", "one", "other"),
        "grouped",
    )
    whole = covered(grouped.where("one <> other"))
    # One row of each group of alike blocks stands for it.
    starts = grouped.where("u = one").select(
        "th", "u", "rank", "left", "right", "at", "high",
        (F.col("one") == F.col("other")).alias("open"),
        F.explode(F.sequence("low", "high")).alias("start"),
    )
    # left holds the bytes from the block's first start to its core, right those up to its last string's end.
    begin = F.expr(
        "substring(left, (start - high - {0}) * {1} + length(right) + length(left) + 1)".format(least - core, size)
    )
    tail = F.expr("substring(right, 1, length(right) - (high - start) * {0})".format(size))
    starts = starts.select("th", "u", "rank", "open", "start", F.xxhash64(begin, tail).alias("outer"),
                           F.length(begin).alias("before"))
    alone = (
        starts.groupBy("rank", "before", "outer")
        .agg(F.min("u").alias("one"), F.max("u").alias("other"))
        .where("one <> other")
        .select(F.col("rank").alias("_rank"), F.col("before").alias("_before"), F.col("outer").alias("_outer"))
    )
    lone = (
        starts.where("open")
        .join(
            alone,
            (F.col("rank") == F.col("_rank")) & (F.col("before") == F.col("_before")) & (F.col("outer") == F.col("_outer")),
        )
        .select(
            "th", F.struct(F.col("start").alias("begin"), (F.col("start") + least).alias("end")).alias("span")
        )
    )
    copies = (
        filed.where("low = 0")
        .groupBy("th")
        .agg(F.count("*").alias("n"))
        .where("n > 1")
        .select("th", F.struct(F.lit(0).alias("begin"), F.lit(2**31 - 1).alias("end")).alias("span"))
    )
    spans = alike.union(whole).union(lone).union(copies)
    return spans.groupBy("th").agg(F.collect_set("span").alias("spans"))


def merged(spans, n):
    """Disjoint stretches of [0, n) in order."""
    found = []
    for begin, end in sorted((s["begin"], min(n, s["end"])) for s in spans or ()):
        if found and begin <= found[-1][1]:
            found[-1][1] = max(found[-1][1], end)
        else:
            found.append([begin, end])
    return found


def kept(raw, stretches):
    """What is left of a text, in pieces."""
    at = 0
    for begin, end in stretches:
        yield raw[at:begin]
        at = end
    yield raw[at:]


def text_hash(column):
    return F.unhex(F.md5(F.encode(F.coalesce(column, F.lit("")), "UTF-8")))


def _with_spans(docs, text_col, least, words=False):
    """``docs`` with a last column of spans under an unused name; only texts and hashes are shuffled with other columns."""
    th, key, spans_col = unused_names(docs, "_th", "_key", "_spans")
    docs = docs.withColumn(th, text_hash(F.col(f"`{text_col}`").cast("string")))
    texts = docs.select(F.col(th).alias("th"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    spans = repeated_spans(texts, least, words).select(F.col("th").alias(key), F.col("spans").alias(spans_col))
    # Staged, so that the join reads plain exchanges and adaptive execution can split the copies of a frequent text.
    spans = stage(spans, "spans")
    return docs.join(spans.hint("shuffle_hash"), F.col(th) == F.col(key), "left").drop(th, key)


def repeat_digests(docs, least=LEAST, id_col="doc_id", text_col="text"):
    """One row per row of ``docs``: bytes, bytes removed, maximal removed runs, digest of the rest."""
    schema = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("n_bytes", pa.int64()),
            ("n_removed", pa.int64()),
            ("n_spans", pa.int64()),
            ("kept_sha256", pa.string()),
        ]
    )

    def run(batches):
        for batch in batches:
            for rows, raws in slices(batch, "text"):
                found = [merged(s, len(raw)) for s, raw in zip(rows.column("_spans").to_pylist(), raws)]
                yield to_batch(
                    schema,
                    rows.column("doc_id"),
                    [len(raw) for raw in raws],
                    [sum(end - begin for begin, end in f) for f in found],
                    [len(f) for f in found],
                    [hashlib.sha256(b"".join(kept(raw, f))).hexdigest() for raw, f in zip(raws, found)],
                )

    picked = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text")
    )
    return _with_spans(picked, "text", least).mapInArrow(
        tidied(run), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    )


def remove_repeats(docs, least=LEAST, text_col="text", words=False):
    """``docs`` without the repeated stretches of their texts; every other column as it was.

    ``least`` counts bytes, or words if ``words``; words are whole and equal byte by byte, the
    blanks between them may differ. A character that is repeated in part stays, so texts stay valid; null texts stay null.
    """
    columns = docs.columns
    at = columns.index(text_col)
    schema = docs.schema

    def run(batches):
        for batch in batches:
            for rows, raws in slices(batch, text_col):
                texts = []
                for raw, spans, text in zip(raws, rows.column(len(columns)).to_pylist(), rows.column(at)):
                    if not spans:
                        texts.append(text.as_py())
                        continue
                    inner = []
                    if words:
                        bounds = [m.span() for m in _WORD.finditer(raw)]
                        found = [(bounds[a][0], bounds[b - 1][1]) for a, b in merged(spans, len(bounds))]
                    else:
                        found = merged(spans, len(raw))
                    for begin, end in found:
                        while begin < end and raw[begin] & 0xC0 == 0x80:
                            begin += 1
                        while begin < end < len(raw) and raw[end] & 0xC0 == 0x80:
                            end -= 1
                        inner.append((begin, end))
                    texts.append(b"".join(kept(raw, inner)).decode())
                arrays = [
                    pa.array(texts, rows.column(i).type) if i == at else rows.column(i) for i in range(len(columns))
                ]
                yield pa.RecordBatch.from_arrays(arrays, names=columns)

    return _with_spans(docs, text_col, least, words).mapInArrow(tidied(run), schema)
