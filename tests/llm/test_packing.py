"""Packing along the curve: every id once, no padding, neighbours together."""

import itertools
import zlib
from collections import defaultdict

import numpy as np
import pytest
import tokenizers

from barkeep.llm.batches import tokenizer_file
from barkeep.llm.hilbert import hilbert_keys
from barkeep.llm.packing import curve_keys, id_encoder, pack_documents
from barkeep.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
VOCABULARY = "byte_bpe_50k.json"


@pytest.fixture(scope="module")
def library():
    known = tokenizers.Tokenizer.from_file(tokenizer_file(VOCABULARY))
    return lambda text: known.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("dims,bits", [(1, 4), (2, 1), (2, 4), (3, 3), (4, 2), (5, 2)])
def test_curve_visits_every_cell_by_single_steps(dims, bits):
    cells = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
    keys = hilbert_keys(cells, bits)
    assert sorted(keys) == list(range(len(cells)))
    assert (np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(axis=1) == 1).all()


def sequences(rows):
    found = defaultdict(list)
    for r in rows:
        found[r.sequence_id].append((r.offset, r.length))
    return found.values()


def held_to_rules(rows, limit=1024):
    for pieces in sequences(rows):
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at and length > 0
            at += length
        assert at == limit or at < limit and at & (at - 1) == 0


def test_query_against_the_library(spark, library):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op13_packing"](spark, SF).collect()
    held_to_rules(rows)
    of = defaultdict(list)
    for r in rows:
        of[r.doc_id].append(r)
    assert of.keys() == texts.keys()
    for doc_id, pieces in of.items():
        ids, at = np.array([*library(texts[doc_id]), 0], "<u4"), 0
        for r in sorted(pieces, key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            at += r.length
            assert r.ids_crc32 == zlib.crc32(ids[r.start : at].tobytes())
        assert at == len(ids)


def test_fast_ids_equal_the_library(library):
    encode = id_encoder(tokenizer_file(VOCABULARY))
    rnd = np.random.default_rng(4)
    vocabulary = tokenizers.Tokenizer.from_file(tokenizer_file(VOCABULARY))
    parts = [vocabulary.decode([i]) for i in rnd.integers(0, 50_000, 3_000)]
    texts = ["".join(parts[j][: rnd.integers(1, 9)] for j in rnd.integers(0, 3_000, 5)) for _ in range(20_000)]
    texts += ["", "<|endoftext|>", "a<|endoftext|> b", " \n\n  x", "　  x", "\x00" * 9, "a" * 3_000, "😀é́"]
    assert encode(texts) == [library(text) for text in texts]
    # Another vocabulary goes to the library itself.
    other = tokenizers.Tokenizer.from_file(tokenizer_file("word_bpe_49k.json"))
    assert id_encoder(tokenizer_file("word_bpe_49k.json"))(texts[:50]) == [
        other.encode(text, add_special_tokens=False).ids for text in texts[:50]
    ]


def test_nulls_copies_long_texts_and_clashing_columns(spark, library):
    rows = [(1, "same words"), (1, "same words"), (None, "same words"), (2, None), (3, ""), (4, "long " * 300_000)]
    rows += [(5, "hot")] * 3_000
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as key", "2 as ids", "3 as spot")
    got = pack_documents(docs, limit=64).collect()
    held_to_rules(got, 64)
    tokens = defaultdict(int)
    for r in got:
        assert len(r.ids) == 4 * r.length
        tokens[r.doc_id] += r.length
    size = len(library("same words")) + 1
    long = len(library("long " * 300_000)) + 1
    assert tokens == {1: 2 * size, None: size, 2: 1, 3: 1, 4: long, 5: 3_000 * (len(library("hot")) + 1)}
    assert pack_documents(docs.limit(0)).count() == 0


def test_like_documents_lie_side_by_side():
    rnd = np.random.default_rng(6)
    topics = [rnd.integers(256, 50_000, 80) for _ in range(30)]
    documents = [rnd.choice(topics[t], 300) for t in range(30) for _ in range(10)]
    order = np.argsort(curve_keys(documents))
    same = np.mean(order[1:] // 10 == order[:-1] // 10)
    assert same > 0.3  # by chance 0.03
