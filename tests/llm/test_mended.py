"""Cases that operators once got wrong."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from barkeep.llm import repeats
from barkeep.llm.batches import tokenizer_file
from barkeep.llm.chat import render_conversations
from barkeep.llm.decontamination import contamination, remove_benchmark
from barkeep.llm.licenses import license_scan
from barkeep.llm.quality import quality
from barkeep.llm.repeats import remove_repeats, repeat_digests
from barkeep.llm.simhash import drop_near_duplicates
from barkeep.llm.token_counts import answered, stored_counts
from barkeep.llm.topk import top_k

TURNS = "conv_id long, turn long, role string, text string"


def kept(spark, rows):
    return sorted(r.conv_id for r in render_conversations(spark.createDataFrame(rows, TURNS)).collect())


def test_conversations_that_count_their_turns_otherwise(spark):
    first = [(1, 0, "user", "a"), (1, 1, "bot", "b")]
    assert kept(spark, first + [(2, 1, "user", "a"), (2, 2, "bot", "b"), (2, 3, "user", "c")]) == [2]
    # Gaps beyond a chunk, and null numbers, which stand last.
    assert kept(spark, first + [(2, -700, "user", "a"), (2, 900, "bot", "b"), (2, None, "user", "c")]) == [2]
    # Two turns of one number are two turns, in the order of role and text.
    tied = [(3, 5, "bot", "b"), (3, 5, "a", "z"), (3, 6, "c", "d")]
    assert kept(spark, tied + [(4, 1, "a", "z"), (4, 2, "bot", "b")]) == [3]
    assert kept(spark, tied + [(4, 1, "bot", "b"), (4, 2, "a", "z")]) == [3, 4]


def test_long_conversations_renumbered(spark):
    turns = [("user", f"t{i}") for i in range(700)]
    rows = [(1, i * 3, *t) for i, t in enumerate(turns[:600])] + [(2, i + 5, *t) for i, t in enumerate(turns)]
    rows += [(3, i, *t) for i, t in enumerate(turns[:599] + [("user", "other")])]
    assert kept(spark, rows) == [2, 3]


def best(vectors, k):
    """(query, rank, id, score) by brute force with Python's whole numbers."""
    found = []
    for q, v in set(vectors):
        scores = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in vectors if i != q)
        found += [(q, rank, i, -s) for rank, (s, i) in enumerate(scores[:k], 1)]
    return sorted(found)


def test_blocks_of_small_and_of_large_numbers(spark):
    """Some blocks are searched in doubles, others in whole numbers; a query is one in either."""
    rnd = random.Random(7)
    small = [(i, tuple(rnd.randrange(-9, 9) for _ in range(20))) for i in range(40)]
    large = [(100 + i, tuple(rnd.randrange(-(2**26), 2**26) for _ in range(20))) for i in range(40)]
    frame = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in small + large], "vec_id long, embedding array<double>")
    parts = frame.where("vec_id < 100").coalesce(1).union(frame.where("vec_id >= 100").coalesce(1))
    got = top_k(parts, parts, k=2, scale=1).collect()
    assert sorted(map(tuple, got)) == best(small + large, 2)


def test_numbers_that_do_not_fit(spark):
    schema = "vec_id long, embedding array<double>"
    for rows in ([(1, [1e300]), (2, [1.0])], [(1, [2.0**52] * 4), (2, [2.0**52] * 4)]):
        frame = spark.createDataFrame(rows, schema)
        with pytest.raises(Exception, match="beyond 2\\^53|may not fit a long"):
            top_k(frame, frame, scale=1).collect()


def test_repeated_ids(spark):
    rows = [(1, [1.0]), (1, [2.0]), (2, [3.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(map(tuple, top_k(frame, frame, k=5, scale=1).collect()))
    assert got == [(1, 1, 2, 3), (1, 1, 2, 6), (2, 1, 1, 6), (2, 2, 1, 3)]


CLASHES = ("_id", "_th", "_key", "_spans", "_row", "_stay_id", "_stay_th", "_rank", "th", "spans", "node")


def test_columns_named_like_our_own(spark):
    long = " ".join(f"w{i}" for i in range(120))
    rows = [(1, long), (2, long + " tail"), (3, "else")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for i, name in enumerate(CLASHES):
        docs = docs.withColumn(name, F.concat(F.lit(f"{name}-"), F.col("doc_id")))
    for found in (drop_near_duplicates(docs, 5), remove_repeats(docs, 50, words=True)):
        assert found.columns == docs.columns
        for r in found.collect():
            assert [r[c] for c in CLASHES] == [f"{c}-{r.doc_id}" for c in CLASHES]
    assert sorted(r.doc_id for r in drop_near_duplicates(docs, 5).collect()) == [1, 3]
    assert {r.doc_id: r.text for r in remove_repeats(docs, 50, words=True).collect()} == {1: "", 2: " tail", 3: "else"}


def test_rows_alike_in_id_and_text_keep_the_same_one(spark):
    docs = spark.createDataFrame([(1, "a b", x) for x in "zxy"] + [(None, None, "n"), (None, None, "m")], "doc_id long, text string, note string")
    for frame in (docs, docs.repartition(3)):
        assert sorted(r.note for r in drop_near_duplicates(frame).collect()) == ["m", "x"]


@pytest.mark.parametrize("piece", [7, 64, 1000])
def test_long_texts_are_filed_in_pieces(monkeypatch, piece):
    rnd = np.random.default_rng(piece)
    for size, least in ((60, 60), (500, 40), (3000, 400)):
        raw = rnd.integers(97, 99, size).astype(np.uint8).tobytes()
        monkeypatch.setattr(repeats, "PIECE", 10**9)
        whole = repeats._filed(raw, least, least // 4, False)
        monkeypatch.setattr(repeats, "PIECE", piece)
        cut = repeats._filed(raw, least, least // 4, False)
        assert all((a == b).all() for a, b in zip(whole, cut))


def test_repeats_in_a_text_of_8_mb_and_in_many_copies(spark):
    rnd = np.random.default_rng(2)
    long = rnd.integers(97, 123, 8_000_000).astype(np.uint8).tobytes()
    long = long[:5_000_000] + long[1_000_000:1_000_450] + long[5_000_000:]
    copy = rnd.integers(97, 123, 900).astype(np.uint8).tobytes().decode()
    docs = spark.createDataFrame([(0, long.decode())] + [(i, copy) for i in range(1, 3_000)], "doc_id long, text string")
    got = {r.doc_id: (r.n_removed, r.n_spans) for r in repeat_digests(docs).collect()}
    assert got.pop(0) == (900, 2)
    assert set(got.values()) == {(900, 1)} and len(got) == 2_999


def test_limits_answered_from_one_encoding(spark, tmp_path):
    import tokenizers

    library = tokenizers.Tokenizer.from_file(tokenizer_file("byte_bpe_50k.json"))
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(40).collect()}
    texts.update({-1: None, -2: "", -3: "a<|endoftext|> bé<|endoftext|>", -4: "unbelievableness 😀é" * 9})
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    stored_counts(docs).write.parquet(f"{tmp_path}/counts")
    limits = (1, 7, 100)
    rows = answered(spark.read.parquet(f"{tmp_path}/counts"), limits).collect()
    assert len(rows) == 3 * len(texts)
    count = lambda text: len(library.encode(text, add_special_tokens=False).ids)
    for r in rows:
        text = texts[r.doc_id] or ""
        raw = text.encode()
        assert r.n_tokens == count(text) and r.over_limit == (r.n_tokens > r.token_limit)
        cut = raw[: r.bytes_within_limit].decode()
        assert count(cut) <= r.token_limit
        if not r.over_limit:
            assert cut == text
        else:
            # The next character belongs to a piece that does not fit.
            assert len(cut) < len(text)


def test_texts_of_8_mb_are_read_to_their_end(spark):
    rnd = random.Random(4)
    words = [f"w{rnd.randrange(50_000)}" for _ in range(1_200_000)]
    notice, item = "released under the mit license", [f"q{i}" for i in range(12)]
    long = " ".join([*words, notice, "then", *item, "end"])
    docs = spark.createDataFrame([(1, long), (2, "short text"), (3, long)], "doc_id long, text string")
    benchmark = spark.createDataFrame([("a", " ".join(item)), ("b", "not in any text at all of these three documents")], "item_id string, text string")
    at = len(words) + notice.split().index("mit")
    for r in license_scan(docs).where("doc_id <> 2").collect():
        assert (r.n_words, r.n_base, r.first_word, r.labels) == (len(long.split()), 1, at, "mit") and r.n_matches >= 1
    for r in contamination(docs, benchmark).where("doc_id <> 2").collect():
        assert (r.n_words, r.n_hit, r.n_items) == (len(long.split()), 12, 1)
    cleaned = {r.doc_id: r.text for r in remove_benchmark(docs, benchmark).collect()}
    assert cleaned[1] == cleaned[3] == long.replace(" ".join(item) + " ", "") and cleaned[2] == "short text"
    rows = quality(docs).collect()
    assert sorted(r.doc_id for r in rows) == [1, 2, 3]
    assert len({r.score for r in rows if r.doc_id != 2}) == 1 and all(0 <= r.score <= 1 for r in rows)
