"""SimHash near-duplicates by multi-index hashing.

A fingerprint is cut into three segments. Two fingerprints at 4 differing bits or fewer
differ in at most one bit in the first or the second segment, or not at all in the third
(2 + 2 + 1 would be five). So each is entered in a table per segment, the balls of radius 1 around
its first two segments are enumerated, and what meets in a table entry is verified on all
64 bits. Entries work on distinct fingerprints, and give a spanning forest of their links,
never all pairs; an entry with more than ``ENTRY`` fingerprints is dealt out as a grid of
cells that together hold each of its pairs.

A row without words (null and empty texts too) has fingerprint zero and is linked like any
other. Rows may repeat; null ids keep a null-safe place: a component's id is its smallest
id that is not null, and null if it has none.

Which documents stay starts from the same links between fingerprints. Each is then checked by the Jaccard similarity
of the whole sets of shingles. As some sets of similarity 0.8 are more than 4 bits apart, what shares a band of a min-hash
sketch is checked too: two such sets share none of the bands with a chance of about one in ten million. Equality of
shingles and of whole sets is that of 64-bit hashes.
"""

from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Window
from pyspark.sql import functions as F

from barkeep.llm.batches import pick, slices, tidied, to_batch, unused_names
from barkeep.llm.components import components
from barkeep.scratch import stage

WORDS, DISTANCE, SEED = 4, 4, 42
# (bits, radius) of the segments, lowest first.
SEGMENTS = ((22, 1), (21, 1), (21, 0))
ENTRY = 50_000
PAIRS = 500_000

# Near copies: sets of shingles whose shared part is four fifths of all or more.
SIMILAR = (4, 5)
BANDS, BAND = 40, 5
# Of a sketch's 200 places two sets of similarity 0.8 share 160 on average, with a deviation of 5.7.
ALIKE = 128
CELL = 2_000

_LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])
_LANES = np.uint64(0x0101010101010101)
_rnd = np.random.default_rng(SEED)
_FLIPS, _FACTORS, _MIX = (_rnd.integers(0, 1 << 64, BANDS * BAND, dtype=np.uint64) | np.uint64(1) for _ in range(3))


def shingle_hashes(raw, words=WORDS, seed=SEED):
    """XXH64 of each shingle of a text, repeats included."""
    parts = raw.lower().split()
    if not parts:
        return []
    text = b" ".join(parts)
    if len(parts) <= words:
        return [xxhash.xxh64_intdigest(text, seed)]
    ends = list(accumulate(len(p) + 1 for p in parts))
    digest = xxhash.xxh64_intdigest
    return [digest(text[a : b - 1], seed) for a, b in zip([0, *ends], ends[words - 1 :])]


def shingle_set(raw, words):
    """Sorted distinct shingle hashes that near copies are compared by."""
    return np.unique(np.array(shingle_hashes(raw, words), np.uint64))


def sketch(shingles):
    """Of a set: a key for each band of least hashes, and a byte of each of these hashes."""
    least = np.full(BANDS * BAND, np.iinfo(np.uint64).max)
    for at in range(0, len(shingles), 256):
        part = (shingles[at : at + 256, None] ^ _FLIPS) * _FACTORS
        least = np.minimum(least, part.min(axis=0))
    keys = (least * _MIX).reshape(BANDS, BAND).sum(axis=1, dtype=np.uint64)
    return keys.view(np.int64), (least >> np.uint64(8)).astype(np.uint8).tobytes()


def fold(hashes):
    """Fingerprints of several texts from their shingle hashes."""
    sizes = np.array([len(h) for h in hashes], np.int64)
    prints = np.zeros(len(hashes), np.uint64)
    full = np.flatnonzero(sizes)
    if not len(full):
        return prints
    flat = np.concatenate([np.array(hashes[i], np.uint64) for i in full])
    sizes = sizes[full]
    # Eight one-byte counters share a number, so no more than 255 hashes may be added up in one.
    blocks = -(-sizes // 255)
    starts = np.cumsum(sizes) - sizes
    inner = np.arange(blocks.sum()) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    cuts = np.repeat(starts, blocks) + inner * 255
    first = np.cumsum(blocks) - blocks
    found = np.zeros(len(full), np.uint64)
    for bit in range(8):
        lanes = np.add.reduceat((flat >> np.uint64(bit)) & _LANES, cuts)
        counts = lanes.view(np.uint8).reshape(-1, 8).astype(np.int64)
        counts = np.add.reduceat(counts, first, axis=0)
        for lane in range(8):
            most = 2 * counts[:, lane] > sizes
            found |= most.astype(np.uint64) << np.uint64(8 * lane + bit)
    prints[full] = found
    return prints


def _prints(texts, hashed):
    """``texts`` with ``text`` replaced by one fingerprint per function of ``hashed``: fp0, fp1, …"""
    kept = [c for c in texts.columns if c != "text"]
    names = [f"fp{i}" for i in range(len(hashed))]

    def run(batches):
        for batch in batches:
            for rows, raws in slices(batch, "text"):
                prints = [pa.array(fold([f(raw) for raw in raws]).view(np.int64)) for f in hashed]
                arrays = [rows.column(rows.schema.get_field_index(c)) for c in kept]
                yield pa.RecordBatch.from_arrays([*arrays, *prints], names=[*kept, *names])

    schema = ", ".join(f"`{c}` {texts.schema[c].dataType.simpleString()}" for c in kept)
    return texts.mapInArrow(run, ", ".join([schema, *(f"{n} long" for n in names)]))


def fingerprints(docs, words=WORDS, id_col="doc_id", text_col="text"):
    """``doc_id`` and ``fp`` (as a signed number) per row."""
    shingled = lambda raw: shingle_hashes(raw, words)
    return _prints(pick(docs, id_col, text_col), [shingled]).withColumnRenamed("fp0", "fp")


def _entries(prints):
    """Table entries (probe false) and ball members (probe true) of each fingerprint."""
    def entry(value, number, probe):
        return F.struct(
            (value + F.lit(number << 32).cast("long")).alias("entry"), F.lit(probe).alias("probe")
        )

    def ball(value, number, bits):
        flips = F.array(*[F.lit(1 << bit).cast("long") for bit in range(bits)])
        return F.transform(flips, lambda flip: entry(value.bitwiseXOR(flip), number, True))

    rows, low = [], 0
    for number, (bits, radius) in enumerate(SEGMENTS):
        value = F.shiftrightunsigned("fp", low).bitwiseAND((1 << bits) - 1)
        rows.append(F.array(entry(value, number, False)))
        if radius:
            rows.append(ball(value, number, bits))
        low += bits
    return prints.select("fp", F.explode(F.concat(*rows)).alias("e")).select("e.entry", "e.probe", "fp")


def _in_cells(entries):
    """Entries with a cell; those with very many fingerprints are spread over a grid of cells."""
    tables = entries.where(~F.col("probe")).groupBy("entry").count()
    large = stage(
        tables.where(F.col("count") > ENTRY).select(
            "entry", F.ceil(F.col("count") / ENTRY).cast("int").alias("side")
        ),
        "large",
    )
    if large.isEmpty():
        return entries.withColumn("cell", F.lit(0))
    spread = entries.join(large, "entry", "left")
    lane = F.pmod(F.xxhash64("fp"), F.col("side")).cast("int")
    steps = F.sequence(F.lit(0), F.col("side") - 1)
    as_table = F.transform(steps, lambda i: F.struct((lane * F.col("side") + i).alias("cell"), F.lit(False).alias("p")))
    as_probe = F.transform(steps, lambda i: F.struct((i * F.col("side") + lane).alias("cell"), F.lit(True).alias("p")))
    cells = (
        F.when(F.col("side").isNull(), F.array(F.struct(F.lit(0).alias("cell"), F.col("probe").alias("p"))))
        .when(F.col("probe"), as_probe)
        .otherwise(F.concat(as_table, as_probe))
    )
    return spread.select("entry", "fp", F.explode(cells).alias("c")).select(
        "entry", F.col("c.p").alias("probe"), "fp", F.col("c.cell").alias("cell")
    )


def _near(a, b, distance):
    return np.bitwise_count(a ^ b) <= distance


def _forest(table, probe, distance):
    """Links that connect whatever links of table with table or probe connect."""
    found = []
    table, probe = np.unique(table), np.setdiff1d(probe, table)
    while len(table):
        front, table = [(table[-1], True)], table[:-1]
        while front:
            node, is_table = front.pop()
            hit = _near(table, node, distance)
            near, table = table[hit], table[~hit]
            front.extend((x, True) for x in near)
            found.append((np.full(len(near), node), near))
            if is_table and len(probe):
                hit = _near(probe, node, distance)
                near, probe = probe[hit], probe[~hit]
                front.extend((x, False) for x in near)
                found.append((np.full(len(near), node), near))
    if not found:
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    return tuple(np.concatenate(side) for side in zip(*found))


def _links_of(entry, cell, probe, fp, distance):
    """Links within runs of equal (entry, cell); within a run, table members come first."""
    fresh = np.concatenate([[True], (entry[1:] != entry[:-1]) | (cell[1:] != cell[:-1])])
    starts = np.flatnonzero(fresh)
    sizes = np.diff(np.concatenate([starts, [len(entry)]]))
    tables = np.add.reduceat((~probe).astype(np.int64), starts)
    work = tables * sizes
    lefts, rights = [], []
    small = np.flatnonzero((tables > 0) & (sizes > 1) & (work <= 4096))
    bounds = np.searchsorted(np.cumsum(work[small]), np.arange(PAIRS, work[small].sum() + PAIRS, PAIRS))
    for group in np.split(small, np.unique(bounds)):
        n = work[group]
        pair = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        width = np.repeat(sizes[group], n)
        start = np.repeat(starts[group], n)
        a, b = fp[start + pair // width], fp[start + pair % width]
        hit = _near(a, b, distance) & (a != b)
        lefts.append(a[hit])
        rights.append(b[hit])
    for g in np.flatnonzero((tables > 0) & (sizes > 1) & (work > 4096)):
        at, n, t = starts[g], sizes[g], tables[g]
        a, b = _forest(fp[at : at + t], fp[at + t : at + n], distance)
        lefts.append(a)
        rights.append(b)
    a, b = (np.concatenate(side) if side else np.empty(0, np.uint64) for side in (lefts, rights))
    both = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0)
    return both[:, 0], both[:, 1]


def links(prints, distance=DISTANCE):
    """Links (a, b) between distinct fingerprints that connect all that are near one another."""
    cells = _in_cells(_entries(prints))

    def run(batches):
        held, size = [], 0

        def flush(rows, last):
            entry, cell = rows.column("entry").to_numpy(), rows.column("cell").to_numpy()
            keep = len(entry)
            if not last:
                final = (entry == entry[-1]) & (cell == cell[-1])
                keep = int(np.flatnonzero(final)[0])
            probe = rows.column("probe").to_numpy(zero_copy_only=False)
            fp = rows.column("fp").to_numpy().view(np.uint64)
            if keep:
                a, b = _links_of(entry[:keep], cell[:keep], probe[:keep], fp[:keep], distance)
            else:
                a = b = np.empty(0, np.uint64)
            return to_batch(_LINKS, pa.array(a.view(np.int64)), pa.array(b.view(np.int64))), rows.slice(keep)

        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= 400_000:
                out, rest = flush(pa.Table.from_batches(held).combine_chunks().to_batches()[0], False)
                yield out
                held, size = [rest] if rest.num_rows else [], 0
        if held and sum(b.num_rows for b in held):
            yield flush(pa.Table.from_batches(held).combine_chunks().to_batches()[0], True)[0]

    # Entries of one cell lie side by side, table members before probes.
    dealt = cells.repartition("entry", "cell").sortWithinPartitions("entry", "cell", "probe")
    return dealt.select("entry", "cell", "probe", "fp").mapInArrow(run, "a long, b long")


def near_duplicates(docs, words=WORDS, distance=DISTANCE, id_col="doc_id", text_col="text"):
    """``doc_id``, ``fp`` and ``component_id`` per row of ``docs``."""
    if distance > DISTANCE:
        raise ValueError("the segments' balls hold all links of up to 4 bits only")
    prints = stage(fingerprints(docs, words, id_col, text_col), "prints")
    heads = prints.groupBy("fp").agg(F.min("doc_id").alias("head"))
    roots = components(links(heads.select("fp"), distance))
    rooted = heads.join(roots, heads["fp"] == roots["node"], "left").select(
        "fp", "head", F.coalesce("root", "fp").alias("root")
    )
    rooted = stage(rooted, "rooted")
    least = rooted.groupBy("root").agg(F.min("head").alias("component_id"))
    of_print = rooted.join(least, "root").select("fp", "component_id")
    return prints.join(of_print, "fp").select("doc_id", "fp", "component_id")


def _sketched(batches, words):
    schema = pa.schema(
        [("_id", pa.int64()), ("_th", pa.string()), ("fp", pa.int64()), ("node", pa.int64()), ("keys", pa.list_(pa.int64())), ("sketch", pa.binary())]
    )
    for batch in batches:
        for rows, raws in slices(batch, "text"):
            prints, nodes, keys, sketches = [], [], [], []
            for raw in raws:
                hashes = np.array(shingle_hashes(raw, words), np.uint64)
                prints.append(fold([hashes])[0])
                shingles = np.unique(hashes)
                nodes.append(xxhash.xxh3_64_intdigest(shingles.tobytes()) - (1 << 63))
                own, shown = sketch(shingles)
                keys.append(own)
                sketches.append(shown)
            prints = np.array(prints, np.uint64).view(np.int64)
            yield to_batch(schema, rows.column("_id"), rows.column("_th"), prints, nodes, keys, sketches)


def _sets(batches, words):
    schema = pa.schema([("node", pa.int64()), ("shingles", pa.binary())])
    for batch in batches:
        for rows, raws in slices(batch, "text"):
            yield to_batch(schema, rows.column("node"), [shingle_set(raw, words).tobytes() for raw in raws])


def _are_similar(left, right):
    part, of = SIMILAR
    both = len(np.intersect1d(left, right, assume_unique=True))
    return of * both >= part * (len(left) + len(right) - both)


def _similar(batches):
    for batch in batches:
        good = []
        for left, right in zip(batch.column("left"), batch.column("right")):
            good.append(_are_similar(*(np.frombuffer(x.as_buffer(), np.uint64) for x in (left, right))))
        yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))


def _cell_links(band, node, root, keys, shown, sets):
    """Links between similar sets of a cell that join its roots as all links between them would.

    A pair is looked at in the first band that it shares only, and compared in whole where its roots
    are not joined yet. So a cell gives fewer links than it has sets.
    """
    joined, found = {}, []

    def find(x):
        while x in joined:
            x = joined[x]
        return x

    roots, counts = np.unique(root, return_counts=True)
    for i in np.flatnonzero(root != roots[counts.argmax()]):
        maybe = np.flatnonzero((np.count_nonzero(shown == shown[i], axis=1) >= ALIKE) & (root != root[i]))
        earlier = (keys[maybe, :band] == keys[i, :band]).any(axis=1)
        for j in maybe[~earlier]:
            a, b = find(int(root[i])), find(int(root[j]))
            if a != b and _are_similar(sets(i), sets(j)):
                joined[a] = b
                found.append((node[i], node[j]))
    return found


def _alike(batches):
    """Links within runs of equal (band, key, cell), see ``_cell_links``."""
    held = []

    def links_of(rows):
        band, key, cell, node, root = (rows.column(c).to_numpy() for c in ("band", "key", "cell", "node", "root"))
        shown = np.frombuffer(b"".join(rows.column("sketch").to_pylist()), np.uint8).reshape(len(key), -1)
        keys = rows.column("keys").flatten().to_numpy().reshape(len(key), -1)
        column = rows.column("shingles")
        fresh = (band[1:] != band[:-1]) | (key[1:] != key[:-1]) | (cell[1:] != cell[:-1])
        starts, found = np.flatnonzero(np.concatenate([[True], fresh])), []
        for at, end in zip(starts, [*starts[1:], len(key)]):
            sets = lambda i, at=at: np.frombuffer(column[int(at + i)].as_buffer(), np.uint64)
            found += _cell_links(band[at], node[at:end], root[at:end], keys[at:end], shown[at:end], sets)
        return to_batch(_LINKS, [int(a) for a, _ in found], [int(b) for _, b in found])

    def whole(batches):
        return pa.Table.from_batches(batches).combine_chunks().to_batches()[0]

    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) < 5_000:
            continue
        rows = whole(held)
        last = [rows.column(c).to_numpy() for c in ("band", "key", "cell")]
        same = np.logical_and.reduce([c == c[-1] for c in last])
        keep = int(np.flatnonzero(same)[0])
        if keep:
            yield links_of(rows.slice(0, keep))
        held = [rows.slice(keep)]
    if sum(b.num_rows for b in held):
        yield links_of(whole(held))


def _sets_of(nodes, heads, own, words):
    """(node, shingles): the whole sets of ``nodes``, one text read for each."""
    places = heads.join(nodes, "node").select("node", F.col("head._id").alias("_at"), F.col("head._th").alias("_in"))
    rows = own.join(places, F.col("_id").eqNullSafe(F.col("_at")) & (F.col("_th") == F.col("_in")))
    # Rows may repeat with their id.
    rows = rows.dropDuplicates(["_id", "_th"]).select("node", "text")
    return stage(rows.mapInArrow(tidied(lambda batches: _sets(batches, words)), "node long, shingles binary"), "sets")


def _verified(pairs, heads, own, words):
    """The ``pairs`` (a, b) of sets that are similar, by their whole sets."""
    used = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
    sets = _sets_of(used, heads, own, words)
    side = lambda end, name: sets.select(F.col("node").alias(end), F.col("shingles").alias(name))
    # Many pairs may share their a: that join comes last, so that adaptive execution can split it.
    both = pairs.join(side("b", "right"), "b").join(side("a", "left"), "a").select("a", "b", "left", "right")
    return stage(both.mapInArrow(tidied(_similar), "a long, b long"), "similar")


def print_pairs(prints):
    """Pairs (a, b) of sets to be compared: those of one fingerprint with the least of them, and the least ones of
    linked fingerprints."""
    sets = stage(prints.select("fp", "node").distinct(), "sets-of-prints")
    least = sets.groupBy("fp").agg(F.min("node").alias("least"))
    found = links(least.select("fp"))
    end = lambda name: least.select(F.col("fp").alias(name), F.col("least").alias(f"of_{name}"))
    near = found.join(end("a"), "a").join(end("b"), "b").select("of_a", "of_b")
    pairs = sets.join(least, "fp").select("least", "node").union(near).toDF("a", "b")
    return pairs.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def near_copies(prints, heads, own, words):
    """(node, root) of the sets that have a link: pairs with a Jaccard similarity of 0.8 or more.

    First the pairs that ``print_pairs`` finds are compared, and each set with the least one of each band it shares.
    Bands whose sets are not yet connected by that are searched in whole, and each gives links enough to connect what
    is similar in it.
    """
    entries = prints.select("node", F.posexplode("keys").alias("band", "key"))
    shared = stage(
        entries.groupBy("band", "key").agg(F.min("node").alias("least"), F.max("node").alias("other")).where("least <> other"),
        "shared",
    )
    members = entries.distinct().join(shared, ["band", "key"]).select("band", "key", "node", "least")
    members = stage(members, "members")
    stars = members.where("node <> least").select(F.col("least").alias("a"), F.col("node").alias("b"))
    pairs = stage(print_pairs(prints).union(stars).distinct(), "pairs")
    linked = _verified(pairs, heads, own, words)
    roots = components(linked)
    placed = members.join(roots, "node", "left").select("band", "key", "node", F.coalesce("root", "node").alias("root"))
    placed = stage(placed, "placed")
    divided = stage(
        placed.groupBy("band", "key")
        .agg(F.min("root").alias("one"), F.max("root").alias("other"), F.count("*").alias("n"))
        .where("one <> other")
        .select("band", "key", F.ceil(F.col("n") / CELL).cast("int").alias("side")),
        "divided",
    )
    # A band with very many sets is spread over a grid of cells that together hold each of its pairs.
    lane = F.pmod(F.xxhash64("node"), F.col("side")).cast("int")
    cells = F.transform(
        F.sequence(F.lit(0), F.col("side") - 1), lambda i: F.least(lane, i) * F.col("side") + F.greatest(lane, i)
    )
    dealt = stage(
        placed.join(divided, ["band", "key"]).select("band", "key", "node", "root", F.explode(cells).alias("cell")), "dealt"
    )
    sets = _sets_of(dealt.select("node").distinct(), heads, own, words)
    shown = heads.select("node", "sketch", "keys").join(sets, "node")
    dealt = dealt.join(stage(shown, "shown"), "node")
    dealt = dealt.repartition("band", "key", "cell").sortWithinPartitions("band", "key", "cell", "node")
    columns = ("band", "key", "cell", "node", "root", "sketch", "keys", "shingles")
    more = stage(dealt.select(*columns).mapInArrow(tidied(_alike), "a long, b long"), "more")
    return components(linked.union(more))


def drop_near_duplicates(docs, words=WORDS, id_col="doc_id", text_col="text"):
    """The rows of ``docs`` that stand for their group of near copies, unchanged: one of each group.

    Candidates are rows with fingerprints at 4 differing bits or fewer, and rows that share a band. They are linked if
    the Jaccard similarity of their texts' sets of shingles of ``words`` words is 0.8 or more; of a group of linked rows the smallest id stays (nulls last, then by the text's MD5), and
    of rows with that id and text one.
    """
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    # Names of our own that no column of the documents has.
    at, th, row = unused_names(docs, "_id", "_th", "_row")
    own = docs.withColumn(at, F.col(f"`{id_col}`").cast("long")).withColumn(th, F.md5(F.encode(text, "UTF-8")))
    texts = own.select(F.col(at).alias("_id"), F.col(th).alias("_th"), text.alias("text"))
    prints = texts.mapInArrow(
        tidied(lambda batches: _sketched(batches, words)),
        "_id long, _th string, fp long, node long, keys array<long>, sketch binary",
    )
    prints = stage(prints, "prints")
    first = F.struct(F.col("_id").isNull().alias("none"), "_id", "_th")
    heads = prints.groupBy("node").agg(F.min(first).alias("head"), F.max(F.struct("sketch", "keys")).alias("shown"))
    heads = heads.select("node", "head", "shown.sketch", "shown.keys")
    heads = stage(heads, "heads")
    rooted = heads.select("node", "head").join(near_copies(prints, heads, texts, words), "node", "left")
    stay = (
        rooted.groupBy(F.coalesce("root", "node").alias("root"))
        .agg(F.min("head").alias("head"))
        .select(F.col("head._id").alias("_stay_id"), F.col("head._th").alias("_stay_th"))
    )
    stay = stage(stay, "stay")
    stay_id, stay_th = unused_names(own, "_stay_id", "_stay_th")
    stay = stay.toDF(stay_id, stay_th)
    kept = own.join(stay, F.col(at).eqNullSafe(F.col(stay_id)) & (F.col(th) == F.col(stay_th)))
    # Of rows with the same id and text, the one whose other columns come first as JSON.
    columns = [f"`{c}`" for c in docs.columns]
    others = [f"`{c}`" for c in docs.columns if c not in (id_col, text_col)]
    kept = kept.withColumn(row, F.to_json(F.struct(*others)) if others else F.lit(""))
    first = Window.partitionBy(at, th).orderBy(row)
    (rank,) = unused_names(kept, "_rank")
    return kept.withColumn(rank, F.row_number().over(first)).where(F.col(rank) == 1).select(*columns)


def fingerprint_text(column="fp"):
    return F.lower(F.lpad(F.hex(F.col(column)), 16, "0"))
