"""The registered queries of the training-data operators, each over its whole tables."""

import zlib

from pyspark.sql import functions as F

from barkeep.llm.chat import render_conversations
from barkeep.llm.decontamination import contamination
from barkeep.llm.licenses import license_scan
from barkeep.llm.packing import pack_documents
from barkeep.llm.pieces import piece_digests
from barkeep.llm.quality import quality
from barkeep.llm.repeats import repeat_digests
from barkeep.llm.runs import periodic_runs
from barkeep.llm.simhash import fingerprint_text, near_duplicates
from barkeep.llm.token_counts import token_counts
from barkeep.llm.topk import top_k
from barkeep.llm.toxicity import toxicity
from barkeep.llm.trie import end_digests, numbered_turns, prefix_trie
from barkeep.scratch import stage


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_license_scan(spark, sf_dir):
    return license_scan(table(spark, sf_dir, "documents"))


def op2_repeats(spark, sf_dir):
    return repeat_digests(table(spark, sf_dir, "documents"))


def op3_exact_topk(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return top_k(vectors, vectors.where("vec_id % 20 = 0"))


def op4_simhash(spark, sf_dir):
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", fingerprint_text().alias("fingerprint"), "component_id")


def op5_sentencepiece(spark, sf_dir):
    return piece_digests(table(spark, sf_dir, "documents"))


def op6_quality(spark, sf_dir):
    return quality(table(spark, sf_dir, "documents"))


def op7_toxicity(spark, sf_dir):
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_chat_format(spark, sf_dir):
    return render_conversations(table(spark, sf_dir, "conversations"))


def op9_token_counts(spark, sf_dir):
    return token_counts(table(spark, sf_dir, "documents"))


def op10_decontamination(spark, sf_dir):
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def planted_run(doc_id, words):
    """Every tenth document, by the CRC-32 of its id, has its words made periodic from some word on."""
    n, h = len(words), 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * (1 + (n - a) // p))[: n - a]


def op11_periodic_runs(spark, sf_dir):
    found = periodic_runs(table(spark, sf_dir, "documents"), rewrite=planted_run, digest=True)
    longest = F.expr("array_max(transform(runs, r -> struct(r.length as length, -r.start as start, -r.period as period)))")
    lines = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')")
    return found.withColumn("longest", longest).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("longest.start")).alias("start"),
        F.col("longest.length").alias("length"),
        (-F.col("longest.period")).alias("period"),
        F.expr("1000 * longest.length div -longest.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.col("collapsed").alias("collapsed_sha256"),
        "n_words",
    )


def rebuilt(turns):
    """(turns, members): each conversation c begins with the first turns of c - c % 5, as many as its CRC-32 tells."""
    turns = turns.withColumn("head", F.crc32(F.col("conv_id").cast("string")) % 9)
    turns = turns.withColumn("base", F.col("conv_id") - F.col("conv_id") % 5)
    members = turns.groupBy("conv_id").agg(F.min("head").alias("head"), F.min("base").alias("base"))
    sizes = turns.groupBy("conv_id").agg(F.count("*").alias("size")).select(F.col("conv_id").alias("base"), "size")
    first = turns.where("conv_id = base and place <= 8").select("base", "place", "a", "b", "bytes")
    first = members.join(first, "base").where("place <= head").select("conv_id", "place", "a", "b", "bytes")
    shift = F.least("head", F.coalesce("size", F.lit(0).cast("long"))) - F.col("head")
    own = turns.where("place > head").join(stage(sizes, "sizes"), "base", "left")
    own = own.select("conv_id", (F.col("place") + shift).alias("place"), "a", "b", "bytes")
    return first.union(own), members.select("conv_id")


def op12_conversation_trie(spark, sf_dir):
    turns = stage(numbered_turns(table(spark, sf_dir, "conversations")), "numbered")
    nodes, ends = prefix_trie(*rebuilt(turns))
    return nodes.join(end_digests(ends), ["n1", "n2"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
        F.col("saved_bytes").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )


def op13_packing(spark, sf_dir):
    return pack_documents(table(spark, sf_dir, "documents")).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


QUERIES = {
    name: query for name, query in list(globals().items()) if name.startswith("op") and callable(query)
}
