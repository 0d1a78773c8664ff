"""Small helpers shared by the operators that work on Arrow batches."""

import ctypes
import os

import pyarrow as pa
from pyspark.sql import functions as F

# Text of one inner batch. Arrow batches hold thousands of rows of any length; the
# operators work through them in pieces of about this size to keep memory bounded.
SLICE_BYTES = 2_000_000

# Words of the license and benchmark operators: A-Z lower-cased, every other ASCII
# character but 0-9 and a-z separates, everything beyond ASCII belongs to a word.
_WORD_TABLE = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
    for c in range(256)
)


def word_bytes(raw):
    """The bytes of a text with letters lower-cased and everything between words blank."""
    return raw.translate(_WORD_TABLE)


def words_of(raw):
    """Words of UTF-8 bytes, as bytes."""
    return raw.translate(_WORD_TABLE).split()


def text_bytes(column):
    """UTF-8 bytes per row of a string array; None counts as empty."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def slices(batch, column, limit=SLICE_BYTES):
    """(rows, texts as bytes) of a record batch, in pieces of about ``limit`` bytes."""
    texts = text_bytes(batch.column(column))
    start = size = 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= limit:
            yield batch.slice(start, i + 1 - start), texts[start : i + 1]
            start, size = i + 1, 0
    if start < len(texts):
        yield batch.slice(start), texts[start:]


def pick(docs, id_col="doc_id", text_col="text"):
    """The two columns an operator reads, under fixed names: clashes cannot arise."""
    return docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.col(f"`{text_col}`").cast("string").alias("text"),
    )


def to_batch(schema, *columns):
    return pa.RecordBatch.from_arrays(
        [
            c if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c, f.type)
            for c, f in zip(columns, schema)
        ],
        schema=schema,
    )


def tokenizer_file(name):
    """A public vocabulary file; an existing path is taken as it is."""
    if os.path.exists(name):
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


class Memo(dict):
    """Remembers ``compute(key)`` for about ``most`` keys, then starts afresh."""

    def __init__(self, compute, most=300_000):
        super().__init__()
        self.compute, self.most = compute, most

    def __missing__(self, key):
        value = self.compute(key)
        if len(self) >= self.most:
            self.clear()
        self[key] = value
        return value


def unused_names(docs, *wanted):
    """Column names like ``wanted`` that ``docs`` does not have, in any letter case."""
    taken, found = {c.lower() for c in docs.columns}, []
    for name in wanted:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        found.append(name)
    return found


def tidied(run, *memos):
    """``run`` over batches that gives its memory back at the end: workers outlive their tasks."""

    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            for memo in memos:
                memo.clear()
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL(None).malloc_trim(0)
            except AttributeError:  # not glibc
                pass

    return wrapped
