"""Benchmark decontamination with an FM-index per shard of the documents.

A window is a number of consecutive words of an item; an item with fewer words is one
window. Each task numbers the words of its documents by the benchmark's vocabulary,
shard by shard, builds an FM-index over the stretches in which every pair of neighbours
also stands together in some item (nothing else can hold a window), searches all windows
backwards, locates them through sampled suffix places and merges what they cover.

The windows of a block of items are broadcast; a block holds at most ``block_bytes`` of
item text (or one item). More items than that make more passes: what a pass marks in the documents is written before the
next block is read, so that driver and workers hold one block at a time, however large the benchmark is.
Null texts and texts without words hold no window. Repeated item rows count once, a null
item id marks words but is not listed. Documents' ids may be null or repeated.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from barkeep.llm.batches import pick, slices, to_batch, unused_names, word_bytes, words_of
from barkeep.llm.fm_index import FMIndex
from barkeep.scratch import stage

BLOCK_BYTES = 8_000_000
# What earlier blocks left at a document: its hit words as bits, and items.
MARKS = "struct<mask:binary,items:array<string>>"

SCHEMA = (
    "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"
)
_OUT = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_words", pa.int64()),
        ("n_hit", pa.int64()),
        ("n_items", pa.int64()),
        ("items_sha256", pa.string()),
        ("contaminated", pa.bool_()),
    ]
)


class Windows:
    """The windows of some items, numbered by a vocabulary of their own."""

    def __init__(self, items, size):
        """``items``: (id as text or None, text as bytes)."""
        self.vocabulary, self.names = {}, []
        windows, owners = [np.zeros((0, size), np.int64)], []
        for item, text in items:
            words = words_of(text)
            if not words:
                continue
            numbers = np.array([self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words])
            numbers = np.pad(numbers, (0, max(0, size - len(numbers))))
            windows.append(np.lib.stride_tricks.sliding_window_view(numbers, size))
            owners.append(np.full(len(windows[-1]), len(self.names)))
            self.names.append(item)
        self.patterns, which = np.unique(np.concatenate(windows), axis=0, return_inverse=True)
        self.lengths = (self.patterns > 0).sum(axis=1)
        # Items of window w: owner[first[w]:first[w + 1]].
        self.owner = np.concatenate([np.zeros(0, np.int64), *owners])[np.argsort(which.ravel(), kind="stable")]
        self.first = np.concatenate([[0], np.cumsum(np.bincount(which.ravel(), minlength=len(self.patterns)))])
        self.shortest = int(self.lengths.min(initial=size))
        left, right = self.patterns[:, :-1].ravel(), self.patterns[:, 1:].ravel()
        self.pairs = np.zeros(1 << 22, bool)
        self.pairs[self._slot(left[right > 0], right[right > 0])] = True

    @staticmethod
    def _slot(left, right):
        return (left * 2654435761 + right * 40503) & ((1 << 22) - 1)

    def candidates(self, numbers):
        """Places of the words that a window may cover; numbers has a 0 after each text."""
        if self.shortest == 1:
            return numbers > 0
        left, right = numbers[:-1], numbers[1:]
        pair = self.pairs[self._slot(left, right)] & (left > 0) & (right > 0)
        edges = np.flatnonzero(np.diff(np.concatenate([[0], pair.astype(np.int8), [0]])))
        starts, ends = edges[::2], edges[1::2]
        fit = ends - starts >= self.shortest - 1
        mark = np.zeros(len(numbers) + 1, np.int64)
        np.add.at(mark, starts[fit], 1)
        np.add.at(mark, ends[fit] + 1, -1)
        return np.cumsum(mark[:-1]) > 0

    def search(self, texts_words):
        """For texts as lists of words: per text (hit words as a mask or None, ids of items)."""
        get = self.vocabulary.get
        sizes = np.array([len(w) + 1 for w in texts_words])
        numbers = np.zeros(int(sizes.sum()), np.int64)
        starts = np.concatenate([[0], np.cumsum(sizes)])
        for at, words in zip(starts.tolist(), texts_words):
            numbers[at : at + len(words)] = [get(w, 0) for w in words]
        found = [(None, ())] * len(texts_words)
        keep = self.candidates(numbers)
        if not keep.any():
            return found
        kept = np.flatnonzero(keep)
        # Where kept places do not follow each other, a run ends.
        ends = np.concatenate([np.diff(kept) > 1, [True]])
        at = np.arange(len(kept)) + np.concatenate([[0], np.cumsum(ends[:-1])])
        sequence = np.zeros(len(kept) + int(ends.sum()), np.int64)
        origin = np.zeros(len(sequence), np.int64)
        sequence[at], origin[at] = numbers[kept], kept
        index = FMIndex(sequence)
        lo, hi = index.find(self.patterns, self.lengths)
        counts = hi - lo
        window = np.repeat(np.arange(len(counts)), counts)
        if not len(window):
            return found
        rows = np.arange(len(window)) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(lo, counts)
        places = origin[index.locate(rows)]
        cover = np.zeros(len(numbers) + 1, np.int64)
        np.add.at(cover, places, 1)
        np.add.at(cover, places + self.lengths[window], -1)
        cover = np.cumsum(cover) > 0
        text = np.searchsorted(starts, places, "right") - 1
        pairs = np.unique(np.stack([text, window], axis=1), axis=0)
        cut = np.flatnonzero(np.diff(pairs[:, 0])) + 1
        for group in np.split(pairs, cut):
            t = int(group[0, 0])
            owners = {o for w in group[:, 1] for o in self.owner[self.first[w] : self.first[w + 1]].tolist()}
            ids = {self.names[o] for o in owners} - {None}
            found[t] = (cover[starts[t] : starts[t + 1] - 1], ids)
        return found


def _blocks(benchmark, size, block_bytes, item_col):
    """Windows of items with ``block_bytes`` of text at most (or of one item), one block after the other."""
    items = benchmark.select(
        F.col(f"`{item_col}`").cast("string").alias("item"),
        F.encode(F.coalesce(F.col("text").cast("string"), F.lit("")), "UTF-8").alias("raw"),
    )
    block, held = [], 0
    for item, raw in items.toLocalIterator():
        if block and held + len(raw) > block_bytes:
            yield Windows(block, size)
            block, held = [], 0
        block.append((item, bytes(raw)))
        held += len(raw)
    yield Windows(block, size)


def _search(block, raws, marks):
    """Words per text, and the hits of a block (mask or None, ids) together with earlier marks."""
    words = [words_of(raw) for raw in raws]
    found = block.value.search(words)
    if marks is None:
        return words, found
    for t, mark in enumerate(marks.to_pylist()):
        if mark is not None:
            (mask, ids), n = found[t], len(words[t])
            known = np.unpackbits(np.frombuffer(mark["mask"], np.uint8), count=n).astype(bool)
            found[t] = (known if mask is None else known | mask, {*mark["items"], *ids})
    return words, found


def _last_block(docs, benchmark, size, block_bytes, item_col, text_col, hits):
    """(docs, last block): earlier blocks' hits, if there are any, are in the column ``hits`` of docs."""
    context, block = docs.sparkSession.sparkContext, None

    def marking(block, schema, arrow):
        def run(batches):
            for batch in batches:
                for rows, raws in slices(batch, text_col):
                    _, found = _search(block, raws, rows.column(hits))
                    marks = [
                        None if mask is None else {"mask": np.packbits(mask).tobytes(), "items": sorted(ids)}
                        for mask, ids in found
                    ]
                    columns = [*rows.columns[:-1], pa.array(marks, arrow)]
                    yield pa.RecordBatch.from_arrays(columns, names=rows.schema.names)

        return docs.mapInArrow(run, schema)

    arrow = pa.struct([("mask", pa.binary()), ("items", pa.list_(pa.string()))])
    for windows in _blocks(benchmark, size, block_bytes, item_col):
        if block is not None:
            if hits not in docs.columns:
                docs = docs.withColumn(hits, F.lit(None).cast(MARKS))
            docs = stage(marking(block, docs.schema, arrow), "marked")
            block.destroy()
        block = context.broadcast(windows)
    return docs, block


def contamination(
    docs, benchmark, window=10, block_bytes=BLOCK_BYTES, id_col="doc_id", text_col="text", item_col="item_id"
):
    """One row per row of ``docs``: words, hit words, items with a window in it and their digest."""
    texts, block = _last_block(
        pick(docs, id_col, text_col), benchmark, window, block_bytes, item_col, "text", "hits"
    )
    marked = "hits" in texts.columns

    def run(batches):
        for batch in batches:
            for rows, raws in slices(batch, "text"):
                words, found = _search(block, raws, rows.column("hits") if marked else None)
                hits = [0 if mask is None else int(mask.sum()) for mask, _ in found]
                yield to_batch(
                    _OUT,
                    rows.column("doc_id"),
                    [len(w) for w in words],
                    hits,
                    [len(ids) for _, ids in found],
                    [hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest() for _, ids in found],
                    [n > 0 for n in hits],
                )

    return texts.mapInArrow(run, SCHEMA)


def _without(raw, mask):
    """The text without its hit words; a gap leaves one blank."""
    # Where the words lie in the text: the same table marks the bytes of words.
    shown = np.frombuffer(word_bytes(raw), np.uint8) != 32
    edges = np.flatnonzero(np.diff(np.concatenate([[0], shown.astype(np.int8), [0]])))
    starts, ends = edges[::2], edges[1::2]
    runs = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(np.int8), [0]])))
    out, at = [], 0
    for first, stop in zip(runs[::2], runs[1::2]):
        out.append(raw[at : starts[first]].strip(b" ") if at else raw[: starts[first]].rstrip(b" "))
        at = int(ends[stop - 1])
    out.append(raw[at:].lstrip(b" "))
    return b" ".join(out)


def remove_benchmark(
    docs, benchmark, window=10, block_bytes=BLOCK_BYTES, text_col="text", item_col="item_id"
):
    """``docs`` with the covered spans taken out of the text; every other column as it was.

    Texts without a window, and null texts, stay exactly as they are.
    """
    (hits,), schema, at = unused_names(docs, "hits"), docs.schema, docs.columns.index(text_col)
    docs, block = _last_block(docs, benchmark, window, block_bytes, item_col, text_col, hits)
    marked = hits in docs.columns

    def run(batches):
        for batch in batches:
            for rows, raws in slices(batch, text_col):
                _, found = _search(block, raws, rows.column(hits) if marked else None)
                if marked:
                    rows = rows.drop_columns([hits])
                if all(mask is None for mask, _ in found):
                    yield rows
                    continue
                old = rows.column(at)
                texts = [
                    None if is_null else raw.decode() if mask is None else _without(raw, mask).decode()
                    for raw, (mask, _), is_null in zip(raws, found, old.is_null().to_pylist())
                ]
                columns = [pa.array(texts, old.type) if i == at else c for i, c in enumerate(rows.columns)]
                yield pa.RecordBatch.from_arrays(columns, schema=rows.schema)

    return docs.mapInArrow(run, schema)
