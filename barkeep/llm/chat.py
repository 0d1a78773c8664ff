"""Chat formatting that keeps only maximal conversations.

Logged conversations are often snapshots: each holds all turns of an earlier one and some
more. A turn is hashed with its place in the conversation (first, second, …, whatever its number), role
and text; the hash of a prefix is the XOR of its turns' hashes, so it rolls along a conversation and adds up from
parts. A conversation whose whole hash is the hash of a proper prefix of a longer one goes (an
anti-join), of equal ones the smallest id stays, and what is left is rendered.

Turns are counted in chunks of ``CHUNK`` turn numbers and hashed in chunks of as many places, whose sums are then
carried on, so that a very long conversation is no single task's work until it is written as
the one text it is. All of it is DataFrame functions.

Null turns stand last. A turn logged twice with equal number, role and text counts once. Turns of equal
number are ordered by role and text. Null roles and texts count as empty.
Rows without a conversation id are conversations of one turn each, equal ones kept once.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from barkeep.scratch import stage

CHUNK = 256
TEMPLATE = ("<|", "|>\n", "<|end|>\n")


def _turns(conversations, conv_col, turn_col, role_col, text_col):
    """Distinct turns with two hashes and a conversation ``key`` that is never null."""
    turns = conversations.select(
        F.col(f"`{conv_col}`").cast("long").alias("conv_id"),
        F.coalesce(F.col(f"`{turn_col}`").cast("long"), F.lit(2**62)).alias("turn"),
        F.coalesce(F.col(f"`{role_col}`").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"),
    )
    turns = turns.withColumn("h1", F.xxhash64("role", "text"))
    turns = turns.withColumn("h2", F.xxhash64(F.lit("second"), "text", "role"))
    alone = F.struct(F.lit(1).alias("kind"), F.xxhash64("turn", "h1").alias("h1"), F.xxhash64("h2", "turn").alias("h2"))
    return turns.withColumn(
        "key", F.when(F.col("conv_id").isNull(), alone).otherwise(
            F.struct(F.lit(0).alias("kind"), F.col("conv_id").alias("h1"), F.lit(0).cast("long").alias("h2"))
        )
    )


def _carried(rows, chunk, order, sums):
    """``rows`` with running totals per ``key`` along ``order``, each row's own included: in its chunk, and of the
    chunks before. ``sums`` maps a name to (aggregate function, column)."""
    chunked = rows.withColumn("chunk", chunk)
    whole = chunked.groupBy("key", "chunk").agg(*(f(c).alias(f"of_{name}") for name, (f, c) in sums.items()))
    earlier = Window.partitionBy("key").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    before = whole.select(
        "key", "chunk", *(F.coalesce(f(f"of_{name}").over(earlier), zero).alias(f"of_{name}") for name, (f, _) in sums.items())
    )
    within = Window.partitionBy("key", "chunk").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return chunked.select("*", *(f(c).over(within).alias(name) for name, (f, c) in sums.items())).join(before, ["key", "chunk"])


def _placed(turns):
    """(key, place, h1, h2) of each distinct turn: its place in the conversation, from 1."""
    hashed = turns.select("key", "turn", "h1", "h2").distinct()
    numbers = hashed.groupBy("key", "turn").agg(F.count("*").alias("n"))
    counted = _carried(numbers, F.floor(F.col("turn") / CHUNK), "turn", {"upto": (F.sum, "n")})
    counted = counted.select("key", "turn", "n", (F.col("upto") + F.col("of_upto") - F.col("n")).alias("before"))
    # Only where several turns have one number do role and text decide.
    several = turns.join(counted.where("n > 1"), ["key", "turn"]).select("key", "turn", "role", "text", "h1", "h2", "before")
    by_text = Window.partitionBy("key", "turn").orderBy("role", "text")
    several = several.distinct().withColumn("rank", F.row_number().over(by_text))
    single = hashed.join(counted.where("n = 1"), ["key", "turn"]).withColumn("rank", F.lit(1))
    columns = ["key", (F.col("before") + F.col("rank")).alias("place"), "h1", "h2"]
    return single.select(*columns).union(several.select(*columns))


def _prefixes(placed):
    """Per conversation and place, the hash of everything up to it."""
    steps = placed.select(
        "key",
        "place",
        F.xxhash64("place", "h1", "h2").alias("s1"),
        F.xxhash64("h2", "place", "h1").alias("s2"),
    )
    rolled = _carried(
        steps, F.floor(F.col("place") / CHUNK), "place", {"p1": (F.bit_xor, "s1"), "p2": (F.bit_xor, "s2")}
    )
    return rolled.select(
        "key",
        "place",
        F.col("p1").bitwiseXOR(F.col("of_p1")).alias("p1"),
        F.col("p2").bitwiseXOR(F.col("of_p2")).alias("p2"),
    )


def maximal_conversations(
    conversations, conv_col="conv_id", turn_col="turn", role_col="role", text_col="text"
):
    """(``key``, ``conv_id``) of the conversations that are kept."""
    turns = _turns(conversations, conv_col, turn_col, role_col, text_col)
    prefixes = stage(_prefixes(_placed(turns)), "prefixes")
    ends = prefixes.groupBy("key").agg(F.max("place").alias("last"))
    marked = prefixes.join(ends, "key")
    last = marked.where("place = last").select("key", "p1", "p2")
    # A prefix is proper where the conversation goes on.
    proper = marked.where("place < last").select("p1", "p2").distinct()
    kept = last.groupBy("p1", "p2").agg(F.min("key").alias("key")).join(proper, ["p1", "p2"], "left_anti")
    return kept.select("key", F.when(F.col("key.kind") == 0, F.col("key.h1")).alias("conv_id"))


def render_conversations(
    conversations,
    template=TEMPLATE,
    conv_col="conv_id",
    turn_col="turn",
    role_col="role",
    text_col="text",
):
    """One row per maximal conversation: ``conv_id``, ``n_turns`` and its turns as one ``text``.

    ``template`` is what stands before a role, between role and text, and after a text.
    """
    kept = maximal_conversations(conversations, conv_col, turn_col, role_col, text_col)
    turns = _turns(conversations, conv_col, turn_col, role_col, text_col)
    before, between, after = (F.lit(part) for part in template)
    turn = F.struct("turn", "role", "text")
    return (
        turns.join(kept.select("key"), "key", "left_semi")
        .groupBy("key")
        .agg(F.array_sort(F.collect_set(turn)).alias("turns"))
        .select(
            F.when(F.col("key.kind") == 0, F.col("key.h1")).alias("conv_id"),
            F.size("turns").cast("long").alias("n_turns"),
            F.array_join(
                F.transform("turns", lambda t: F.concat(before, t["role"], between, t["text"], after)), ""
            ).alias("text"),
        )
    )
