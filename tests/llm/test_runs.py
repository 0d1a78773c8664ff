"""Periodic runs against their definition."""

import hashlib
import random
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from barkeep.llm import runs
from barkeep.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def by_definition(words):
    """(start, length, period) of every run, period by period."""
    n, found = len(words), []
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            begin = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i + q - begin
            if i > begin and length >= max(12, 2 * q):
                root = words[begin : begin + q]
                if not any(q % d == 0 and root[:d] * (q // d) == root for d in range(1, q)):
                    found.append((begin, length, q))
            i += i == begin
    return sorted(found, key=lambda r: (r[0], r[2]))


def by_strips(words):
    """The operator's own steps without Spark."""
    codes, parts = runs.word_numbers(words), {}
    for octave, places in runs.live_places(codes):
        for at in runs.strips(octave, places, len(words)):
            strip = codes[at : at + runs.strip_stride(octave) + runs.geometry(octave)[4]]
            for q, begin, finish in runs.tile_runs(strip, octave):
                parts.setdefault(q, set()).add((at + begin, at + finish))
    found = []
    for q, stretches in parts.items():
        joined = []
        for begin, finish in sorted(stretches):
            if joined and begin + q <= joined[-1][1]:
                joined[-1][1] = max(joined[-1][1], finish)
            else:
                joined.append([begin, finish])
        found += [(a, b - a, q) for a, b in joined]
    return sorted(found, key=lambda r: (r[0], r[2]))


def repetitive(seed):
    rnd = random.Random(seed)
    n, letters = rnd.choice([0, 11, 12, 40, 130, 500]), rnd.choice([1, 2, 3, 40])
    words = [rnd.randrange(letters) for _ in range(n)]
    for _ in range(rnd.randrange(4) if n > 3 else 0):
        at = rnd.randrange(n - 2)
        period = rnd.randrange(1, (n - at) // 2 + 1)
        length = rnd.randrange(period, min(n - at, period * rnd.choice([3, 6, 40])) + 1)
        words[at : at + length] = (words[at : at + period] * (length // period + 1))[:length]
    return words


@pytest.mark.parametrize("strip", [40, 4096])
@settings(max_examples=150, deadline=None)
@given(seed=st.integers(0, 10**9))
def test_strips_find_all_runs(strip, seed):
    words, kept = repetitive(seed), runs.STRIP
    runs.STRIP = strip
    try:
        assert by_strips(words) == by_definition(words)
    finally:
        runs.STRIP = kept


def test_z_values():
    s = [1, 2, 1, 2, 1, 3, 1, 2, 1, 2, 1]
    assert z_of(s) == runs.z_values(s, len(s))[1:]
    assert runs.z_values([], 3) == []


def z_of(s):
    return [next((k for k in range(len(s) - i) if s[k] != s[i + k]), len(s) - i) for i in range(1, len(s))]


def rewritten(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    if h % 10 or not words:
        return words
    n, g = len(words), h // 10
    a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def test_query_against_definition(spark):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op11_periodic_runs"](spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    checked = 0
    for r in rows:
        words = rewritten(r.doc_id, re.findall(r"[^\x20\x09-\x0D]+", texts[r.doc_id]))
        if len(words) > 2000:
            continue
        found = by_definition(words)
        gone = {i for s, n, q in found for i in range(s + q, s + n)}
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in found)
        best = min(found, key=lambda x: (-x[1], x[0], x[2])) if found else (None,) * 3
        assert (r.n_runs, r.start, r.length, r.period) == (len(found), *best)
        assert r.exponent_milli == (1000 * best[1] // best[2] if found else None)
        assert r.runs_sha256 == hashlib.sha256(lines.encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(kept.encode()).hexdigest()
        checked += bool(found)
    assert checked > 10


def test_nulls_empty_texts_copies_and_clashing_columns(spark):
    loop = "a b c " * 10
    rows = [
        (1, loop, "x"), (1, loop, "y"), (None, loop, None), (2, None, "z"), (3, "", "z"),
        (4, "no run here", "z"), (5, "w " * 11, "z"), (6, "\x1c  " * 12, "z"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, key string").selectExpr(
        "*", "1 as codes", "2 as octave", "3 as runs", "4 as salt"
    )
    got = sorted(
        (str(r.doc_id), r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in runs.periodic_runs(docs).collect()
    )
    assert got == sorted([
        *[(i, 30, [(0, 30, 3)], "a b c") for i in ("1", "1", "None")],
        ("2", 0, [], ""), ("3", 0, [], ""), ("4", 3, [], "no run here"), ("5", 11, [], " ".join("w" * 11)),
        ("6", 12, [(0, 12, 1)], "\x1c "),
    ])
    assert runs.periodic_runs(docs.limit(0)).count() == 0


def test_run_over_many_strips(spark):
    """A text of 8 MB whose run begins and ends far apart, found once."""
    rnd = random.Random(1)
    root = [f"w{rnd.randrange(10**6)}" for _ in range(5_000)]
    words = ["start"] + (root * 181)[:900_001] + ["end"]
    docs = spark.createDataFrame([(1, " ".join(words))], "doc_id long, text string")
    (row,) = runs.periodic_runs(docs).collect()
    assert [tuple(x) for x in row.runs] == [(1, 900_001, 5_000)]
    assert row.collapsed == " ".join(["start", *root, "end"])
