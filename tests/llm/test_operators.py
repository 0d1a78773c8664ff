"""The training-data operators against brute force, their libraries and awkward tables."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import public_tokenizers
import sentencepiece
from barkeep.llm.batches import words_of
from barkeep.llm.chat import render_conversations
from barkeep.llm.components import components
from barkeep.llm.decontamination import contamination, remove_benchmark
from barkeep.llm.fm_index import FMIndex
from barkeep.llm.licenses import TEMPLATES, license_matches, license_scan
from barkeep.llm.pieces import PieceCodec, encoded_pieces, piece_digests
from barkeep.llm.quality import drawn_texts, fit, keep_quality, posteriors, quality
from barkeep.llm.repeats import remove_repeats, repeat_digests
from barkeep.llm.simhash import drop_near_duplicates, fold, fingerprint_text, near_duplicates, shingle_hashes
from barkeep.llm.token_counts import PrefixCounter, token_counts
from barkeep.llm.topk import top_k
from barkeep.llm.toxicity import Lexicon, toxicity
from tokenizers import Tokenizer

DOCS = "doc_id long, text string, n_words string, score double, rank int, Text2 string"
AWKWARD = [
    None, "", " ", "\n\n", "a", "word", "é漢字🎉", "▁ ▁", "<|endoftext|>", "</s><s>", "x" * 3000,
    "Licensed under the Apache License, Version 2.0.", "same text twice here now", "same text twice here now",
]


def docs_of(spark, texts, ids=None):
    """Texts with ids, and further columns whose names operators use themselves."""
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, "x", 0.5, 7, "y") for i, t in zip(ids, texts)], DOCS)


@pytest.fixture(scope="module")
def awkward(spark):
    """Nulls, empty texts, repeated rows and ids, clashing column names."""
    ids = [*range(len(AWKWARD) - 3), None, 3, 3]
    return docs_of(spark, AWKWARD, ids)


@pytest.fixture(scope="module")
def nothing(spark):
    return docs_of(spark, [])


def random_texts(seed, n, letters="abcdé ", pieces=40):
    rnd = random.Random(seed)
    base = ["".join(rnd.choice(letters) for _ in range(rnd.randint(50, 600))) for _ in range(pieces)]
    texts = []
    for _ in range(n):
        parts = []
        for _ in range(rnd.randint(1, 4)):
            source = rnd.choice(base)
            at = rnd.randrange(len(source))
            parts.append(source[at : at + rnd.randint(10, 400)])
        texts.append("".join(parts))
    return texts


def whole(spark, labels=False):
    empty = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    return empty if labels else None


def test_each_row_of_awkward_tables_gets_its_row(spark, awkward, nothing):
    benchmark = spark.createDataFrame([(1, "same text twice here now"), (None, "word"), (2, None), (3, "")], "item_id int, text string")
    labels = whole(spark, labels=True)
    for run in (
        license_scan,
        lambda d: repeat_digests(d, 40),
        near_duplicates,
        piece_digests,
        encoded_pieces,
        quality,
        lambda d: toxicity(d, labels),
        token_counts,
        lambda d: contamination(d, benchmark),
        lambda d: remove_repeats(d, 40),
        lambda d: remove_benchmark(d, benchmark),
    ):
        got = run(awkward)
        assert sorted(map(str, (r.doc_id for r in got.collect()))) == sorted(map(str, (r.doc_id for r in awkward.collect())))
        assert run(nothing).count() == 0
    for run in (keep_quality, drop_near_duplicates, lambda d: remove_repeats(d, 40), lambda d: remove_benchmark(d, benchmark)):
        assert run(awkward).columns == awkward.columns
        assert run(nothing).count() == 0


# -- op 1


def base_places(words):
    phrases = {("mit", "license"): "mit", ("apache", "license"): "apache", ("general", "public", "license"): "gpl"}
    return [(i, label) for i in range(len(words)) for p, label in phrases.items() if tuple(words[i : i + len(p)]) == p]


@pytest.mark.parametrize("threshold", [0.5, 0.8, 1.0])
def test_license_matches_are_all_pairs_at_the_threshold(spark, threshold):
    rnd = random.Random(5)
    known = [w for _, text in TEMPLATES for w in text.split()]
    texts = [None, "", "mit", *AWKWARD[1:], *(text for _, text in TEMPLATES)]
    for _ in range(80):
        parts = []
        for _ in range(rnd.randint(1, 5)):
            words = rnd.choice(TEMPLATES)[1].split()
            kept = [w for w in words if rnd.random() < 0.9]
            parts += kept + [rnd.choice([*known, "é", "other", "words"]) for _ in range(rnd.randint(0, 40))]
        texts.append(" ".join(parts))
    sets = [(label, text, set(words_of(text.encode()))) for label, text in TEMPLATES]
    step = max(len(words_of(text.encode())) for _, text in TEMPLATES)
    expected = Counter()
    for d, text in enumerate(texts):
        words = words_of((text or "").encode())
        for start in range(0, max(1, len(words) - step), step):
            block = set(words[start : start + 2 * step])
            for label, template, s in sets:
                if len(s & block) >= threshold * len(s) - 1e-9:
                    expected[d, start, label, template, len(s & block), len(s & block) / len(s)] += 1
    assert Counter(map(tuple, license_matches(docs_of(spark, texts), threshold=threshold).collect())) == expected
    counted = {r.doc_id: r.n_matches for r in license_scan(docs_of(spark, texts), threshold=threshold).collect()}
    per_text = Counter(key[0] for key in expected.elements())
    assert counted == {d: per_text[d] for d in range(len(texts))}


def test_license_scan(spark):
    notice = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"
    texts = [
        "MIT\tlicense, mit-license; the GNU General Public License",
        f"{'lorem ' * 300}{notice} {'ipsum ' * 300}",
        notice.replace("hereby granted, ", ""),
        "permission to any person",
        "apache licenses", "mit license é", None,
    ]
    rows = {r.doc_id: r for r in license_scan(docs_of(spark, texts)).collect()}
    for i, text in enumerate(texts):
        words = [w.decode() for w in words_of((text or "").encode())]
        places = base_places(words)
        assert (rows[i].n_words, rows[i].n_base) == (len(words), len(places))
        assert rows[i].first_word == min((p for p, _ in places), default=None)
        assert rows[i].last_word == max((p for p, _ in places), default=None)
        assert rows[i].base_labels == ",".join(sorted({label for _, label in places}))
        assert 0 <= rows[i].score <= 1
    assert [rows[i].labels for i in range(7)] == ["gpl,mit", "mit", "mit", "", "", "mit", ""]


def test_short_notices_get_their_own_label_only(spark):
    texts = [
        "Licensed under CC BY-NC 4.0", "text. Licensed under CC BY-SA 4.0, text", "Released under the MIT License",
        "Released under the Apache License", "lizenz mit text. This work is licensed under the GNU General Public License, version 3",
        "mit der software. Licensed under the Apache License, Version 2.0", "released mit under the license", "Released under the Apache License mit der Software",
        "licensed under the CC BY-NC 4.0 license",
        "This work is licensed under a Creative Commons Attribution 4.0 International License",
    ]
    rows = {r.doc_id: r.labels for r in license_scan(docs_of(spark, texts)).collect()}
    assert [rows[i] for i in range(len(texts))] == ["cc-by-nc", "cc-by-sa", "mit", "apache", "gpl", "apache", "", "apache", "cc-by-nc", "cc-by"]


# -- op 2


@pytest.mark.parametrize("least", [16, 40, 100, 400])
def test_repeats_equal_brute_force(spark, least):
    texts = [*random_texts(least, 40), None, "", "ab" * 300, "a" * 700, "xyz" * 400]
    texts += texts[:2]
    raws = [(t or "").encode() for t in texts]
    starts = Counter(r[i : i + least] for r in raws for i in range(len(r) - least + 1))
    rows = {r.doc_id: r for r in repeat_digests(docs_of(spark, texts), least).collect()}
    for i, raw in enumerate(raws):
        gone = np.zeros(len(raw), bool)
        for at in range(len(raw) - least + 1):
            if starts[raw[at : at + least]] > 1:
                gone[at : at + least] = True
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        assert (rows[i].n_removed, rows[i].n_spans) == (int(gone.sum()), runs)
        assert rows[i].kept_sha256 == hashlib.sha256(kept).hexdigest()


def test_repeated_words_go_as_by_brute_force(spark):
    rnd = random.Random(2)
    words = ["a", "of", "été", "漢字", "long-winded", "x.", "no", "blank"]
    passages = [[rnd.choice(words) for _ in range(n)] for n in (51, 49, 70, 200)]
    texts = []
    for _ in range(40):
        parts = [f"own{rnd.random()}"]
        for _ in range(rnd.randint(1, 3)):
            source = rnd.choice(passages)
            at = rnd.randrange(len(source)) if rnd.random() < 0.5 else 0
            parts += [*source[at : at + rnd.randint(40, 210)], f"own{rnd.random()}"]
        texts.append(rnd.choice([" ", "\n", "  "]).join(parts))
    texts += [None, "", "ab " * 120, texts[0], "short copy", "short copy"]
    split = re.compile(r"[^\s漢字]+|[漢字]")
    found = [list(split.finditer(t or "")) for t in texts]
    units = [[m.group() for m in f] for f in found]
    starts = Counter(tuple(u[i : i + 50]) for u in units for i in range(len(u) - 49))
    rows = {r.doc_id: r.text for r in remove_repeats(docs_of(spark, texts), 50, words=True).collect()}
    for i, (text, f, u) in enumerate(zip(texts, found, units)):
        gone = np.zeros(len(u), bool)
        for at in range(len(u) - 49):
            if starts[tuple(u[at : at + 50])] > 1:
                gone[at : at + 50] = True
        kept = [w for w, g in zip(u, gone) if not g]
        assert [m.group() for m in split.finditer(rows[i] or "")] == kept
        assert (rows[i] is None) == (text is None) and (gone.any() or rows[i] == text)


def test_the_pipeline_removes_a_short_worded_passage_of_51_words(spark):
    import corpus_pipeline

    rnd = random.Random(51)
    passage = " ".join(rnd.choice(["so", "it", "is", "we", "go", "on", "a"]) for _ in range(51))
    assert len(passage.encode()) < 200
    texts = [f"{' '.join(f'own{d}x{i}' for i in range(60))} {passage} end{d}" for d in range(2)]
    rows = corpus_pipeline.repeat_removal(spark, docs_of(spark, texts), None).collect()
    assert all(passage not in r.text and f"own{r.doc_id}x59" in r.text and f"end{r.doc_id}" in r.text for r in rows)


# -- op 3


def test_top_k_equals_brute_force(spark):
    rnd = np.random.default_rng(3)
    vectors = [(i, v.tolist()) for i, v in enumerate(rnd.integers(-3, 4, (300, 37)) / 7.0)]
    vectors += [(0, vectors[0][1]), (40, vectors[41][1]), (301, None), (302, [1.0, None]), (None, [0.5] * 37)]
    vectors += [(303, [float("nan")] * 37), (304, [float("inf")] * 37), (320, [0.1, 0.2]), (305, [0.3, 0.4])]
    table = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    good = [(i, np.floor(64 * np.array(v)).astype(int)) for i, v in vectors
            if i is not None and v is not None and None not in v and np.isfinite(v).all()]
    expected = []
    for q, v in {(q, tuple(v)) for q, v in good if q % 20 == 0}:
        scores = sorted((-int(np.dot(v, w)), c) for c, w in good if c != q and len(w) == len(v))
        expected += [(q, r, c, -s) for r, (s, c) in enumerate(scores[:20], 1)]
    got = [tuple(r) for r in top_k(table, table.where("vec_id % 20 = 0")).collect()]
    assert sorted(got) == sorted(expected)
    assert top_k(table.limit(0), table).count() == 0


# -- op 4


def test_simhash_equals_brute_force(spark):
    rnd = random.Random(4)
    words = [f"w{i}" for i in range(400)]
    texts = [" ".join(rnd.choice(words) for _ in range(60)) for _ in range(60)]
    for i in range(40):
        copy = texts[i % 10].split()
        copy[rnd.randrange(60)] = "edited"
        texts.append(" ".join(copy))
    texts += [None, "", "A b", "a  B\n"]
    found = near_duplicates(docs_of(spark, texts)).select("doc_id", fingerprint_text().alias("fp"), "component_id")
    rows = {r.doc_id: r for r in found.collect()}

    def fingerprint(text):
        parts = (text or "").encode().lower().split()
        shingles = [b" ".join(parts[i : i + 4]) for i in range(max(1, len(parts) - 3))] if parts else []
        hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))

    prints = [fingerprint(t) for t in texts]
    assert [rows[i].fp for i in range(len(texts))] == [f"{p:016x}" for p in prints]
    least = list(range(len(texts)))
    for _ in texts:
        least = [min(least[j] for j, q in enumerate(prints) if (p ^ q).bit_count() <= 4) for p in prints]
    assert [rows[i].component_id for i in range(len(texts))] == least


def test_a_crowded_entry_is_split_and_loses_no_link(spark, monkeypatch):
    from barkeep.llm import simhash

    rnd = random.Random(5)
    prints = list({sum(1 << rnd.randrange(64) for _ in range(3)) for _ in range(300)})
    table = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in prints], "fp long")
    groups = []
    for entry in (50_000, 7):
        monkeypatch.setattr(simhash, "ENTRY", entry)
        roots = {r.node: r.root for r in components(simhash.links(table)).collect()}
        groups.append({frozenset(n for n in roots if roots[n] == r) for r in set(roots.values())})
    assert groups[0] == groups[1]
    around = {n for g in groups[0] for n in g}
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    near = {p for p in signed if any(p != q and ((p ^ q) & (2**64 - 1)).bit_count() <= 4 for q in signed)}
    assert around == near


def test_components_of_a_long_chain_and_a_hub(spark):
    chain = [(i, i + 1) for i in range(200)]
    hub = [(1000, 1001 + i) for i in range(300)]
    found = components(spark.createDataFrame([*chain, *hub, (5000, 5000)], "a long, b long")).collect()
    roots = {r.node: r.root for r in found}
    assert len({roots[i] for i in range(201)}) == 1 and len({roots[1000 + i] for i in range(301)}) == 1
    assert roots[0] != roots[1000] and len(roots) == 502


def test_one_of_each_group_of_copies_stays(spark):
    rnd = random.Random(6)
    words = [f"word{i}" for i in range(3000)]
    origins = [[rnd.choice(words) for _ in range(200)] for _ in range(12)]
    texts, group = [], []
    for g, origin in enumerate(origins):
        for copy in range(6):
            edited = list(origin)
            for _ in range(copy):
                edited[rnd.randrange(200)] = rnd.choice(words)
            texts.append(" ".join(edited))
            group.append(g)
    docs = docs_of(spark, [*texts, texts[0]], [*range(len(texts)), 0])
    kept = [r.doc_id for r in drop_near_duplicates(docs).collect()]
    assert sorted(group[i] for i in kept) == list(range(12)) and all(i % 6 == 0 for i in kept)


def kept_by_brute_force(rows):
    """(ids that stay, pairs of different sets at 0.8 or more) of (id, text) with distinct ids."""
    sets = []
    for _, text in rows:
        words = (text or "").encode().lower().split()
        sets.append({tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set())
    holders, root = {}, list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    pairs = 0
    for i, own in enumerate(sets):
        met = Counter(j for s in own or {()} for j in holders.get(s, ()))
        for j, both in met.items():
            if not own or 5 * both >= 4 * (len(own) + len(sets[j]) - both):
                root[top(i)] = top(j)
                pairs += own != sets[j]
        for s in own or {()}:
            holders.setdefault(s, []).append(i)
    least = {}
    for i, (number, _) in enumerate(rows):
        least[top(i)] = min(number, least.get(top(i), number))
    return sorted(least.values()), pairs


def test_near_copies_equal_brute_force(spark):
    rnd = random.Random(9)
    words = [f"w{i}" for i in range(500)]
    texts = []
    for _ in range(12):
        origin = [rnd.choice(words) for _ in range(rnd.randint(60, 300))]
        texts.append(" ".join(origin))
        # Edits from none to beyond the limit, some in a block of their own.
        for share in (0.0, 0.005, 0.01, 0.02, 0.022, 0.025, 0.03, 0.05):
            edited = [rnd.choice(words) if rnd.random() < share else w for w in origin]
            texts.append(" ".join(edited))
            n = round(len(origin) * rnd.uniform(0.05, 0.3))
            texts.append(" ".join([*origin[n:], *(rnd.choice(words) for _ in range(n // 4))]))
        # The same words in another order are no copy.
        texts.append(" ".join(sorted(origin)))
        texts.append(" ".join(sorted(origin, reverse=True)))
    texts += [None, "", " ", "one", "One ", "one two"]
    expected, pairs = kept_by_brute_force(list(enumerate(texts)))
    kept = [r.doc_id for r in drop_near_duplicates(docs_of(spark, texts), 5).collect()]
    assert pairs > 100 and sorted(kept) == expected


def test_near_copies_of_a_whole_table_equal_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    expected, pairs = kept_by_brute_force([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    assert pairs and sorted(r.doc_id for r in drop_near_duplicates(docs, 5).collect()) == expected


def test_crowded_bands_are_split_and_lose_no_link(spark, monkeypatch):
    from barkeep.llm import simhash

    rnd = random.Random(10)
    passage = [f"p{i}" for i in range(70)]
    texts = [" ".join([*passage, *(f"q{rnd.randrange(40)}" for _ in range(rnd.randint(8, 30)))]) for _ in range(120)]
    expected, _ = kept_by_brute_force(list(enumerate(texts)))
    monkeypatch.setattr(simhash, "CELL", 7)
    assert sorted(r.doc_id for r in drop_near_duplicates(docs_of(spark, texts), 5).collect()) == expected


def test_fold_of_more_than_255_shingles():
    hashes = [[xxhash.xxh64_intdigest(str(i * n), 42) for i in range(n)] for n in (0, 1, 255, 256, 1000)]
    expected = [sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs)) for hs in hashes]
    assert fold(hashes).tolist() == expected
    assert shingle_hashes(b"", 4) == []


# -- op 5


def test_pieces_equal_the_library(spark):
    path = public_tokenizers.path("piece_bpe_32k.model")
    library, rnd = sentencepiece.SentencePieceProcessor(model_file=path), random.Random(7)
    texts = [t for t in AWKWARD if t is not None] + ["\x00\x01 \r\n", "　a b", " " * 777, "ﬁ é"]
    texts += ["".join(rnd.choice(" abeé'\n\tst1漢🎉. \x85▁") for _ in range(30)) for _ in range(500)]
    codec = PieceCodec(path)
    coded = codec.encode(texts)
    assert coded == [",".join(map(str, library.encode(t))) for t in texts] and codec.corrected == 0
    ids = [library.encode(t) for t in texts]
    assert list(codec.texts(coded)) == [library.decode(i) for i in ids]
    assert [codec.decode(i) for i in ids] == [library.decode(i) for i in ids]
    rows = {r.doc_id: r for r in encoded_pieces(docs_of(spark, texts[:40])).collect()}
    assert all(rows[i].ids == ids[i] and rows[i].decoded == library.decode(ids[i]) for i in range(40))
    long = "thn" * 200 + " " + "漢" * 100
    assert codec.heaped(" " + long.split()[0]) == library.encode(long.split()[0])


# -- op 6


def test_posteriors_find_labellers_of_disjoint_kinds():
    counts = {"0000000": 900, "1000000": 30, "0100000": 30, "0011000": 40, "2222222": 5, "0000002": 100}
    chance = posteriors(counts)
    assert all(chance[p] > 0.5 for p in ("1000000", "0100000", "0011000"))
    assert chance["0000000"] < 0.2 and chance["2222222"] == 0 and posteriors({}) == {}


def test_quality_keeps_clean_and_rejects_junk(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = quality(docs).join(labels, "doc_id").groupBy("quality", "keep").count().collect()
    n = {(r.quality, r.keep): r["count"] for r in rows}
    assert n.get((1, False), 0) <= 0.01 * n[(1, True)]
    assert n[(0, False)] >= 0.9 * (n[(0, False)] + n.get((0, True), 0))


def test_sample_is_of_different_texts_however_rows_lie(spark):
    texts = ["hot"] * 400 + [f"text {i}" for i in range(200)] + [f"twice {i}" for i in range(50)] * 2 + [None, ""]
    counts = Counter(t or "" for t in texts)
    docs = docs_of(spark, texts)
    draws = []
    for frame, most in ((docs, 60), (docs.repartition(5), 60), (docs, 10_000)):
        rows = drawn_texts(frame, most).collect()
        assert len(rows) == min(most, len(counts)) and all(r.n == counts[r.text] for r in rows)
        draws.append({r.text for r in rows})
    assert draws[0] == draws[1] and draws[2] == set(counts)


def test_counted_rows_fit_like_repeated_ones():
    rnd = np.random.default_rng(1)
    x, y, n = rnd.random((30, 8), np.float32), rnd.random(30), rnd.integers(1, 5, 30)
    apart = fit(np.repeat(x, n, axis=0), np.repeat(y, n), np.ones(n.sum()))
    assert np.allclose(fit(x, y, n), apart, atol=1e-3)


def test_posteriors_equal_plain_expectation_maximisation():
    rnd = random.Random(3)
    counts = Counter("".join(rnd.choice("0012") for _ in range(3)) for _ in range(500))
    total = sum(counts.values())
    junk = {p: 0.9 if "1" in p else 0.02 for p in counts}
    for _ in range(100):
        share = (sum(n * junk[p] for p, n in counts.items()) + 1) / (total + 2)
        rates = []
        for clean, (cries, votes) in ((True, (0.002 * 50 * total, 50 * total)), (False, (0.6, 2.0))):
            weight = {p: n * (1 - junk[p] if clean else junk[p]) for p, n in counts.items()}
            rates.append([
                (sum(w for p, w in weight.items() if p[i] == "1") + cries)
                / (sum(w for p, w in weight.items() if p[i] != "2") + votes)
                for i in range(3)
            ])
        for p in counts:
            chances = []
            for prior, rate in ((1 - share, rates[0]), (share, rates[1])):
                for figure, r in zip(p, rate):
                    prior *= {"0": 1 - r, "1": r, "2": 1}[figure]
                chances.append(prior)
            junk[p] = chances[1] / sum(chances)
    for p, chance in posteriors(counts).items():
        assert abs(chance - (0 if p == "222" else junk[p])) < 1e-5


# -- op 7


def test_lexicon_equals_plain_distances():
    rnd = random.Random(8)

    def distances(term, word):
        row = list(range(len(word) + 1))
        for i, x in enumerate(term, 1):
            row_above, row = row, [i]
            for j, y in enumerate(word, 1):
                row.append(min(row_above[j] + 1, row[-1] + 1, row_above[j - 1] + (x != y)))
        return row

    for _ in range(3000):
        shown = {"".join(rnd.choice("abc") for _ in range(rnd.randint(4, 6))) for _ in range(3)}
        lexicon = Lexicon({t + rnd.choice(["", "*"]): rnd.random() for t in shown})
        word = "".join(rnd.choice("abc") for _ in range(rnd.randint(1, 9)))
        expected = None
        for term, weight in lexicon.weights.items():
            row = distances(term.rstrip("*"), word)
            edits = min(row) if term.endswith("*") else row[-1]
            if edits <= 1:
                expected = min(expected or (9,), (edits, -weight, term))
        found = lexicon.find(word)
        assert found == (expected and (expected[2], expected[0]))
        assert found is None or lexicon.may(word)


def test_toxicity_on_held_out_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = toxicity(docs, labels).where("held_out").join(labels, "doc_id")
    n = {(r.toxic, r.predicted): r["count"] for r in rows.groupBy("toxic", "predicted").count().collect()}
    assert n[(1, 1)] >= 0.9 * (n[(1, 1)] + n.get((1, 0), 0))
    assert n.get((0, 1), 0) <= 0.03 * n[(0, 0)]


# -- op 8


def test_only_maximal_conversations_are_rendered(spark):
    def conversation(i, turns, first=0):
        return [(i, first + n, "user" if n % 2 == 0 else "assistant", t) for n, t in enumerate(turns)]

    rows = [
        *conversation(1, "ab"), *conversation(2, "abcd"), *conversation(3, "abd"), *conversation(4, "abcd"),
        *conversation(5, "b"), *conversation(6, ["a"] * 700), *conversation(7, ["a"] * 690), *conversation(8, "bx"),
        (9, None, None, None), (9, 0, "user", "q"), (2, 0, "user", "a"),
        (None, 0, "user", "alone"), (None, 0, "user", "alone"), (None, 1, "user", "other"),
    ]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = render_conversations(table).collect()
    assert sorted(str(r.conv_id) for r in found) == sorted(["2", "3", "6", "8", "9", "None", "None"])
    by_id = {r.conv_id: r for r in found}
    assert by_id[2].text.startswith("<|user|>\na<|end|><|assistant|>\nb<|end|>".replace("<|end|>", "<|end|>\n"))
    assert by_id[6].n_turns == 700 and by_id[9].n_turns == 2
    assert render_conversations(table.limit(0)).count() == 0


# -- op 9


def test_token_counts_equal_the_library(spark):
    path, rnd = public_tokenizers.path("byte_bpe_50k.json"), random.Random(9)
    library, counter = Tokenizer.from_file(path), PrefixCounter(path, 50)
    count = lambda t: len(library.encode(t, add_special_tokens=False).ids)
    texts = [t for t in AWKWARD if t is not None] + ["it's we'll 're'd", "\x1c\x1d\x85 a b", " " * 3000]
    texts += ["".join(rnd.choice(" abeé'\n\tst1漢🎉. \x85") for _ in range(40)) for _ in range(500)]
    assert [counter.count(t) for t in texts] == [count(t) for t in texts]
    for text in (t[:40] for t in texts[:150] if "<|" not in t):
        assert counter.prefix_counts(text) == [count(text[:i]) for i in range(len(text) + 1)]
    rows = {r.doc_id: r for r in token_counts(docs_of(spark, texts), limit=12).collect()}
    for i, text in enumerate(texts):
        raw = text.encode()
        assert (rows[i].n_bytes, rows[i].n_tokens, rows[i].over_limit) == (len(raw), count(text), count(text) > 12)
        assert rows[i].bytes_within_limit <= len(raw)
        raw[: rows[i].bytes_within_limit].decode()


# -- op 10


def test_fm_index_finds_every_place():
    rnd = np.random.default_rng(10)
    for _ in range(30):
        sequence = rnd.integers(0, 5, 200)
        sequence[-1] = 0
        index = FMIndex(sequence)
        patterns = rnd.integers(1, 8, (50, 4))
        lengths = rnd.integers(1, 5, 50)
        patterns[np.arange(4) >= lengths[:, None]] = 0
        lo, hi = index.find(patterns, lengths)
        for p, n, a, b in zip(patterns, lengths, lo, hi):
            expected = [i for i in range(200 - n + 1) if (sequence[i : i + n] == p[:n]).all()]
            assert sorted(index.locate(np.arange(a, b)).tolist()) == expected


def test_contamination_equals_brute_force(spark):
    rnd = random.Random(11)
    vocabulary = [f"v{i}" for i in range(12)] + ["é", "Licence"]
    items = [(str(i), " ".join(rnd.choice(vocabulary) for _ in range(rnd.randint(0, 9)))) for i in range(25)]
    items += [("4", items[4][1]), (None, "v1 v2 v3 v4 v5"), ("x", None)]
    texts = [" ".join(rnd.choice([*vocabulary, "other", "-"]) for _ in range(rnd.randint(0, 300))) for _ in range(40)]
    texts += ["; ".join(w.upper() for w in items[3][1].split()), None, ""]
    windows = {}
    for item, text in items:
        words = words_of((text or "").encode())
        for i in range(max(1, len(words) - 4) if words else 0):
            windows.setdefault(tuple(words[i : i + 5]), set()).add(item)
    benchmark = spark.createDataFrame(items, "item_id string, text string")
    for block in (8_000_000, 40):
        rows = {r.doc_id: r for r in contamination(docs_of(spark, texts), benchmark, 5, block).collect()}
        for d, text in enumerate(texts):
            words = words_of((text or "").encode())
            hit, ids = [False] * len(words), set()
            for window, found in windows.items():
                for i in range(len(words) - len(window) + 1):
                    if tuple(words[i : i + len(window)]) == window:
                        hit[i : i + len(window)] = [True] * len(window)
                        ids |= found - {None}
            digest = hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
            r = rows[d]
            assert (r.n_words, r.n_hit, r.n_items, r.items_sha256) == (len(words), sum(hit), len(ids), digest)
            assert r.contaminated == any(hit)


def test_removed_benchmark_leaves_the_rest(spark):
    benchmark = spark.createDataFrame([(1, "one two three four five")], "item_id long, text string")
    texts = ["Before one, TWO three; four five after.", "one two three four", None]
    rows = {r.doc_id: r.text for r in remove_benchmark(docs_of(spark, texts), benchmark).collect()}
    assert rows == {0: "Before after.", 1: "one two three four", 2: None}
    assert remove_benchmark(docs_of(spark, texts), benchmark.limit(0)).where(F.col("doc_id") == 0).first().text == texts[0]


def test_removed_in_passes_of_one_item_each(spark):
    benchmark = spark.createDataFrame([(i, f"a{i} b{i} c{i}") for i in range(4)], "item_id long, text string")
    texts = ["x A0 b0 c0 y, a3 b3 c3", "a1 b1 c1", "a1 b1", None, ""]
    docs = docs_of(spark, texts).withColumnRenamed("Text2", "Hits")
    whole, passes = (remove_benchmark(docs, benchmark, block_bytes=size) for size in (8_000_000, 1))
    assert whole.schema == passes.schema == docs.schema
    rows = sorted(passes.collect(), key=lambda r: r.doc_id)
    assert rows == sorted(whole.collect(), key=lambda r: r.doc_id)
    assert [r.text for r in rows] == ["x y, ", " ", "a1 b1", None, ""]
    nothing = docs.limit(0)
    assert remove_benchmark(nothing, benchmark, block_bytes=1).count() == 0
    assert contamination(nothing, benchmark, block_bytes=1).count() == 0 == license_matches(nothing).count()
