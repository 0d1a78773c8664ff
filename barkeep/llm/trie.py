"""The trie of conversation prefixes, by ROLLUP over positional turn columns.

A conversation is cut into blocks of ``WIDTH`` turns, a row each with a column per position. One Spark SQL
``ROLLUP`` over these columns gives every prefix of a block, and ``grouping_id`` tells how long it
is; blocks beyond the first are keyed by the node that the block before them ends in, so that all blocks of
all conversations are aggregated together, whatever their number.

What concerns a subtree is a sum over its members, too. Each node belongs to its smallest member, so a
conversation owns its nodes from some depth on. Of a subtree, the bytes saved are those of its members' turns
at nodes they do not own, and its leaves are the members that own the childless node they end in. So a first
rollup tells owners and children, and a second adds all of it up.

Turns are equal if role and text are (by two 64-bit hashes); null roles and texts count as empty. Turns
are ordered by number (null first), then role, then the text's MD5; repeated rows are turns each. A conversation with a
great many turns is sorted, numbered and rolled up in parts. Rows without a conversation id belong to no
conversation and take no part. Without conversations there is no node, not even the root.
"""

import hashlib

import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from barkeep.llm.batches import to_batch
from barkeep.scratch import stage

WIDTH = 8
# Blocks of a conversation whose hashes are added up in one task.
CHUNK = 64
# Ids of ends are joined to text by ranges of so many.
RANGE = 4096

_TURNS = [f"t{i}" for i in range(WIDTH)]
_DIGESTS = pa.schema([("n1", pa.int64()), ("n2", pa.int64()), ("ends_sha256", pa.string())])


def numbered_turns(
    conversations, conv_col="conv_id", turn_col="turn", role_col="role", text_col="text"
):
    """``conv_id``, ``place`` (from 1), the turn's two hashes ``a`` and ``b``, and its text's ``bytes``."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = conversations.select(
        F.col(f"`{conv_col}`").cast("long").alias("conv_id"),
        F.col(f"`{turn_col}`").cast("long").alias("turn"),
        F.coalesce(F.col(f"`{role_col}`").cast("string"), F.lit("")).alias("role"),
        F.md5(F.encode(text, "UTF-8")).alias("digest"),
        F.octet_length(text).cast("long").alias("bytes"),
        text.alias("text"),
    ).where("conv_id is not null")
    rows = rows.select(
        "conv_id", "turn", "role", "digest", "bytes",
        F.xxhash64("role", "text").alias("a"),
        F.xxhash64(F.lit("second"), "text", "role").alias("b"),
        F.monotonically_increasing_id().alias("spot"),
    )
    # Ranges cut through long conversations; a range's part of one is numbered on from the parts before.
    along = ["conv_id", "turn", "role", "digest", "spot"]
    ranged = rows.repartitionByRange(*along).sortWithinPartitions(*along)
    ranged = stage(
        ranged.select(
            "conv_id", "a", "b", "bytes",
            F.spark_partition_id().alias("part"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "ranged",
    )
    parts = ranged.groupBy("conv_id", "part").agg(F.min("row").alias("first"), F.count("*").alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = stage(
        parts.select("conv_id", "part", "first", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")), "parts"
    )
    return ranged.join(parts, ["conv_id", "part"]).select(
        "conv_id", (F.col("row") - F.col("first") + F.col("before") + 1).alias("place"), "a", "b", "bytes"
    )


def _turn_hashes(place, a, b):
    """What a turn adds to the key of the node it leads to."""
    return F.xxhash64(place.cast("long"), a, b), F.xxhash64(b, place.cast("long"), a)


def _blocks(turns, members):
    """A row per conversation and block: positional turns, the node before it (``k1``, ``k2``), the bytes before it."""
    none = [F.lit(None).cast("long").alias(c) for c in ("place", "a", "b", "bytes")]
    rows = turns.select("conv_id", "place", "a", "b", "bytes").union(members.select("conv_id", *none))
    slot, (h1, h2) = F.pmod(F.col("place") - 1, WIDTH), _turn_hashes(F.col("place"), F.col("a"), F.col("b"))
    at = lambda i, c: F.max(F.when(slot == i, F.col(c)))
    made = rows.groupBy(
        "conv_id", F.coalesce(F.floor((F.col("place") - 1) / WIDTH), F.lit(0)).cast("long").alias("block")
    ).agg(
        *(at(i, c).alias(f"{c}{i}") for i in range(WIDTH) for c in ("a", "b", "bytes")),
        F.bit_xor(F.when(F.col("place").isNotNull(), h1)).alias("x1"),
        F.bit_xor(F.when(F.col("place").isNotNull(), h2)).alias("x2"),
        F.coalesce(F.sum("bytes"), F.lit(0)).alias("size"),
    )
    turn = lambda i: F.when(
        F.col(f"a{i}").isNotNull(),
        F.struct(F.col(f"a{i}").alias("a"), F.col(f"b{i}").alias("b"), F.col(f"bytes{i}").alias("bytes")),
    )
    made = made.select(
        "conv_id", "block", "x1", "x2", "size", F.floor(F.col("block") / CHUNK).alias("chunk"),
        *(turn(i).alias(t) for i, t in enumerate(_TURNS)),
    )
    made = stage(made, "blocks")
    # Sums over the blocks before: of whole chunks, and within the chunk.
    sums = {"k1": (F.bit_xor, "x1"), "k2": (F.bit_xor, "x2"), "before": (F.sum, "size")}
    zero = F.lit(0).cast("long")
    chunks = made.groupBy("conv_id", "chunk").agg(*(f(c).alias(f"_{k}") for k, (f, c) in sums.items()))
    earlier = Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = chunks.select("conv_id", "chunk", *(F.coalesce(sums[k][0](f"_{k}").over(earlier), zero).alias(f"_{k}") for k in sums))
    within = Window.partitionBy("conv_id", "chunk").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    rolled = made.select("conv_id", "chunk", "block", *_TURNS, *(F.coalesce(f(c).over(within), zero).alias(k) for k, (f, c) in sums.items()))
    return rolled.join(chunks, ["conv_id", "chunk"]).select(
        "conv_id", "block", *_TURNS,
        F.col("k1").bitwiseXOR(F.col("_k1")).alias("k1"),
        F.col("k2").bitwiseXOR(F.col("_k2")).alias("k2"),
        (F.col("before") + F.col("_before")).alias("before"),
    )


def _rolled_up(rows, sums):
    """A row per node: ``depth``, its key ``n1``, ``n2``, its parent's ``p1``, ``p2``, and the sums."""
    found = rows.sparkSession.sql(
        f"""
        select block, k1, k2, {", ".join(_TURNS)}, {WIDTH} - bit_count(grouping_id()) as level, {sums}
        from {{rows}}
        group by block, k1, k2, rollup({", ".join(_TURNS)})
        """,
        rows=rows,
    )
    # A group that keeps the empty place of a shorter conversation is no prefix; a block's bare key is the block before's.
    found = found.where(
        "(level = 0 and block = 0) or (level > 0 and element_at(array({}), greatest(level, 1)) is not null)".format(
            ", ".join(_TURNS)
        )
    )
    n1, n2, last1, last2 = F.col("k1"), F.col("k2"), F.lit(0).cast("long"), F.lit(0).cast("long")
    for i, t in enumerate(_TURNS):
        h1, h2 = _turn_hashes(F.col("block") * WIDTH + i + 1, F.col(f"{t}.a"), F.col(f"{t}.b"))
        there, is_last = F.col(t).isNotNull(), F.col("level") == i + 1
        n1 = n1.bitwiseXOR(F.when(there, h1).otherwise(0))
        n2 = n2.bitwiseXOR(F.when(there, h2).otherwise(0))
        last1, last2 = F.when(is_last, h1).otherwise(last1), F.when(is_last, h2).otherwise(last2)
    return found.select(
        "*", (F.col("block") * WIDTH + F.col("level")).alias("depth"), n1.alias("n1"), n2.alias("n2"),
        n1.bitwiseXOR(last1).alias("p1"), n2.bitwiseXOR(last2).alias("p2"),
    )


def prefix_trie(turns, members):
    """(nodes, ends) of the trie of ``turns`` (as ``numbered_turns`` gives them; places without gaps).

    ``members`` has the ``conv_id`` of every conversation, once; those without turns are members of the root. ``nodes``:
    key ``n1``, ``n2``, ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``,
    ``n_leaves``, ``saved_bytes``; ``ends``: each ``conv_id`` with the key of the node it ends in.
    """
    turns, members = stage(turns, "turns"), stage(members, "members")
    blocks = stage(_blocks(turns, members), "rolled")
    nodes = _rolled_up(blocks, "count(*) as n_convs, min(conv_id) as conv_id")
    nodes = stage(nodes.select("depth", "n1", "n2", "p1", "p2", "conv_id"), "nodes")
    children = stage(
        nodes.where("depth > 0").groupBy("p1", "p2").agg(F.count("*").alias("n_children")), "children"
    )
    owned = stage(nodes.groupBy("conv_id").agg(F.min("depth").alias("own")), "owned")
    # Per conversation: where it ends, and the bytes of its turns at nodes of others.
    h1, h2 = _turn_hashes(F.col("place"), F.col("a"), F.col("b"))
    lengths = turns.join(owned, "conv_id", "left").groupBy("conv_id").agg(
        F.count("*").alias("length"), F.bit_xor(h1).alias("e1"), F.bit_xor(h2).alias("e2"),
        F.sum(F.when(F.col("own").isNull() | (F.col("place") < F.col("own")), F.col("bytes")).otherwise(0)).alias("spared"),
    )
    none = F.lit(0).cast("long")
    lengths = members.join(lengths, "conv_id", "left").select(
        "conv_id", *(F.coalesce(c, none).alias(c) for c in ("length", "e1", "e2", "spared"))
    )
    lengths = stage(lengths, "lengths")
    ends = lengths.select("conv_id", F.col("e1").alias("n1"), F.col("e2").alias("n2"))
    leaves = (
        lengths.join(owned, "conv_id")
        .where("own <= length")
        .join(children, (F.col("e1") == F.col("p1")) & (F.col("e2") == F.col("p2")), "left_anti")
        .select("conv_id", F.lit(1).cast("long").alias("leaf"))
    )
    facts = stage(
        lengths.select("conv_id", "spared").join(leaves, "conv_id", "left").select(
            "conv_id", "spared", F.coalesce("leaf", none).alias("leaf")
        ),
        "facts",
    )
    # Of a member's spared bytes, those from each position of the block on.
    rest, before = [], F.col("before")
    for t in _TURNS:
        rest.append(F.greatest(F.col("spared") - before, none))
        before = before + F.coalesce(F.col(f"{t}.bytes"), none)
    rows = blocks.join(facts, "conv_id").select(
        "conv_id", "block", "k1", "k2", *_TURNS, "leaf", *(r.alias(f"s{i}") for i, r in enumerate(rest))
    )
    sums = ", ".join(f"sum(s{i}) as s{i}" for i in range(WIDTH))
    whole = _rolled_up(rows, f"count(*) as n_convs, min(conv_id) as conv_id, sum(leaf) as n_leaves, {sums}")
    saved = F.element_at(F.array(*(F.col(f"s{i}") for i in range(WIDTH))), F.greatest(F.col("level"), F.lit(1)).cast("int"))
    whole = stage(
        whole.select("n1", "n2", "p1", "p2", "conv_id", "depth", "n_convs", "n_leaves", saved.alias("saved_bytes")), "whole"
    )
    parents = nodes.select(
        F.col("n1").alias("p1"), F.col("n2").alias("p2"), F.col("conv_id").alias("parent_conv_id"), F.col("depth").alias("above")
    )
    # The root's key is its own parent's.
    whole = whole.join(parents, ["p1", "p2"], "left")
    whole = whole.join(children.select(F.col("p1").alias("n1"), F.col("p2").alias("n2"), "n_children"), ["n1", "n2"], "left")
    return whole.select(
        "n1", "n2", "conv_id", "depth",
        F.when(F.col("depth") > 0, F.col("parent_conv_id")).alias("parent_conv_id"),
        "n_convs", F.coalesce("n_children", none).alias("n_children"), "n_leaves", "saved_bytes",
    ), ends


def end_digests(ends):
    """SHA-256 per node of the ids that end in it, in numeric order and joined by commas."""
    pieces = ends.groupBy("n1", "n2", F.floor(F.col("conv_id") / RANGE).alias("range")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids")
    )

    def run(batches):
        # Fed piece by piece, as a node may have any number of ends.
        key, digest = None, None
        for batch in batches:
            out = [[], [], []]
            for *own, ids in zip(*(batch.column(c).to_pylist() for c in ("n1", "n2", "ids"))):
                if own == key:
                    digest.update(b"," + ids.encode())
                    continue
                if key:
                    for column, value in zip(out, (*key, digest.hexdigest())):
                        column.append(value)
                key, digest = own, hashlib.sha256(ids.encode())
            yield to_batch(_DIGESTS, *out)
        if key:
            yield to_batch(_DIGESTS, *([value] for value in (*key, digest.hexdigest())))

    along = pieces.repartition("n1", "n2").sortWithinPartitions("n1", "n2", "range").select("n1", "n2", "ids")
    return along.mapInArrow(run, "n1 long, n2 long, ends_sha256 string")


def conversation_trie(
    conversations, conv_col="conv_id", turn_col="turn", role_col="role", text_col="text"
):
    """(nodes, ends) of the trie of logged conversations, see ``prefix_trie``."""
    turns = stage(numbered_turns(conversations, conv_col, turn_col, role_col, text_col), "numbered")
    return prefix_trie(turns, turns.select("conv_id").distinct())
