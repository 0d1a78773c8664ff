"""Packing of documents into training sequences along a space-filling curve.

A document's token ids become a hashed vector (damped counts in ``BUCKETS`` buckets, of length one), which fixed
random directions project to ``DIMS`` numbers; their place along a Hilbert curve is the document's
key. Documents are range-sorted by key, so those that lie near one another in the vector
space lie side by side, and each range is packed in order: ids are laid end to end and cut
every ``limit`` ids. A range's last, unfilled sequence is cut into sequences whose lengths are powers of
two, which need no padding; with the others full, no id of padding is left.

Ids are those of the ``tokenizers`` library without special tokens added (special strings inside texts are
read as it does by default), and ``end_id`` closes each document. Vocabularies of byte-level BPE whose merges
stand in the order of their ids are read by ``tiktoken`` instead, which gives the same ids several times faster.

Null texts count as empty: their one id is ``end_id``. Every row is packed, repeated rows as often as they
stand; rows with null ids too. Ties on the curve go by id, then by the place of the row in its
task, so that copies of one text, however many, are split between ranges. Further columns are not read.
"""

import json
import os

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import functions as F

from barkeep.llm.batches import pick, slices, to_batch, tokenizer_file
from barkeep.llm.hilbert import hilbert_keys
from barkeep.llm.token_counts import PATTERN, _byte_of_char
from barkeep.scratch import stage

LIMIT = 1024
BUCKETS, DIMS, BITS = 1 << 15, 4, 15
# Projections lie within this many units of zero, but for some that are set to the edge.
REACH = 4.0

_TOKENS = pa.schema(
    [("doc_id", pa.int64()), ("key", pa.int64()), ("spot", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())]
)
PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
_PIECES = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids", pa.binary()),
        ("doc_tokens", pa.int64()),
        ("sequence_id", pa.int64()),
        ("offset", pa.int64()),
    ]
)
_directions = np.random.default_rng(13).standard_normal((BUCKETS, DIMS))
_encoders = {}


def _byte_pairs(spec):
    """A ``tiktoken`` encoding with the vocabulary's ids; None if it might merge otherwise."""
    model = spec["model"]
    level = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
    plain = (
        model["type"] == "BPE"
        and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix"))
        and not any(model.get(k) for k in ("fuse_unk", "byte_fallback", "ignore_merges"))
        and not spec.get("normalizer")
        and level.items() <= (spec.get("pre_tokenizer") or {}).items()
        and not any(t[k] for t in spec["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized"))
    )
    if not plain:
        return None
    vocab, special = model["vocab"], {t["content"]: t["id"] for t in spec["added_tokens"]}
    merged = [vocab["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
    if merged != sorted(set(merged)) or len(merged) + 256 != len(vocab.keys() - special.keys()):
        return None
    import tiktoken

    stand_in = _byte_of_char()
    ranks = {bytes(stand_in[c] for c in t): i for t, i in vocab.items() if t not in special}
    return tiktoken.Encoding("byte pairs", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)


def id_encoder(path):
    """Function from texts to lists of ids; one per worker and vocabulary."""
    if path not in _encoders:
        with open(path, encoding="utf-8") as file:
            pairs = _byte_pairs(json.load(file))
        if pairs:
            _encoders[path] = lambda texts: [pairs.encode(text, allowed_special="all") for text in texts]
        else:
            # Spark's tasks are the parallelism; the library's own threads would only compete with them.
            os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
            from tokenizers import Tokenizer

            known = Tokenizer.from_file(path)
            _encoders[path] = lambda texts: [x.ids for x in known.encode_batch(texts, add_special_tokens=False)]
    return _encoders[path]


def curve_keys(documents):
    """Places along the curve of documents, each an array of ids."""
    points = np.zeros((len(documents), DIMS))
    for row, ids in enumerate(documents):
        found, counts = np.unique((ids.astype(np.uint32) * np.uint32(2654435761)) >> np.uint32(17), return_counts=True)
        weights = np.log1p(counts)
        if len(found):
            points[row] = weights @ _directions[found] / np.sqrt(weights @ weights)
    cells = (np.clip(points / REACH, -1, 1) * 0.5 + 0.5) * ((1 << BITS) - 1)
    return hilbert_keys(cells.astype(np.uint64), BITS)


def tokens(docs, vocabulary="byte_bpe_50k.json", end_id=0, id_col="doc_id", text_col="text"):
    """``doc_id``, ``key``, ``spot``, ``n_tokens`` and ``ids`` of each row: 2 bytes an id where all fit, else 4."""

    def run(batches):
        encode, spot = id_encoder(tokenizer_file(vocabulary)), 0
        for batch in batches:
            for rows, raws in slices(batch, "text", 1_000_000):
                found = [np.array([*ids, end_id], "<u4") for ids in encode([raw.decode() for raw in raws])]
                keys = curve_keys([ids[:-1] for ids in found])
                yield to_batch(
                    _TOKENS,
                    rows.column("doc_id"),
                    keys,
                    np.arange(spot, spot + len(found)),
                    [len(ids) for ids in found],
                    [ids.astype("<u2" if ids.max() < 1 << 16 else "<u4").tobytes() for ids in found],
                )
                spot += len(found)

    return pick(docs, id_col, text_col).mapInArrow(run, "doc_id long, key long, spot long, n_tokens long, ids binary")


def _pack(batches, limit):
    """Pieces of one range's documents, end to end."""
    sequence, used, held, out, size = TaskContext.get().partitionId() << 32, 0, [], [[] for _ in _PIECES], 0

    def close(pieces):
        nonlocal sequence
        offset = 0
        for doc_id, start, ids, whole in pieces:
            row = (doc_id, start, len(ids), ids.tobytes(), whole, sequence, offset)
            for column, value in zip(out, row):
                column.append(value)
            offset += len(ids)
        sequence += 1
        return 4 * offset

    for batch in batches:
        columns = (batch.column("doc_id").to_pylist(), batch.column("n_tokens").to_pylist(), batch.column("ids"))
        for doc_id, n, raw in zip(*columns):
            ids, at = np.frombuffer(raw.as_buffer(), f"<u{len(raw.as_buffer()) // n}").astype("<u4"), 0
            while at < len(ids):
                piece = ids[at : at + limit - used]
                held.append((doc_id, at, piece, len(ids)))
                used += len(piece)
                at += len(piece)
                if used == limit:
                    size += close(held)
                    held, used = [], 0
                if size > 4_000_000:
                    yield to_batch(_PIECES, *out)
                    out, size = [[] for _ in _PIECES], 0
    while used:
        room, pieces = 1 << (used.bit_length() - 1), []
        used -= room
        while room:
            doc_id, start, ids, whole = held.pop(0)
            pieces.append((doc_id, start, ids[:room], whole))
            if len(ids) > room:
                held.insert(0, (doc_id, start + room, ids[room:], whole))
            room -= len(pieces[-1][2])
        close(pieces)
    yield to_batch(_PIECES, *out)


def pack_documents(docs, limit=LIMIT, vocabulary="byte_bpe_50k.json", end_id=0, id_col="doc_id", text_col="text"):
    """One row per piece: ``doc_id``, ``start``, ``length``, ``ids``, ``doc_tokens``, ``sequence_id``, ``offset``.

    ``ids`` are 4-byte little-endian numbers; ``start`` counts the document's ids before the piece, ``offset``
    the sequence's. Each id lies in one piece, and a sequence has ``limit`` ids or a power of two below.
    """
    encoded = stage(tokens(docs, vocabulary, end_id, id_col, text_col), "tokens")
    along = ["key", "doc_id", "spot"]
    ranged = encoded.repartitionByRange(*along).sortWithinPartitions(*along).select("doc_id", "n_tokens", "ids")
    return ranged.mapInArrow(lambda batches: _pack(batches, limit), PIECES)
