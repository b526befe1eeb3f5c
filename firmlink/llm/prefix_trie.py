"""Prefix trie of conversations by truncation peeling.

Conversations are paths of turns. The trie is built from its deepest level up:
a round at depth d merges the conversations that end there with the nodes that
survived from below, by one aggregation on the path, which both finds the nodes
of that depth and sums their members, children, leaves and savings. Then the
last turn is stripped and the paths are grouped again, up to the root. Every
round is an aggregation with map-side sums, so a node that a third of all
conversations share reaches a reducer as one row for each task; conversations
with equal paths are merged before the first round.

Turns count as equal if the MD5 of role and text (lengths included) is; only
those 16 bytes and the text's length move, never a text (but for rows that tie,
see below). One conversation's digests stand in one row. A node below ``LONG``
turns that only one distinct path holds, and so all nodes under it, form a single
branch: such a tail is stripped at once, so the number of rounds is that of the
longest path shared by two different conversations, or ``LONG``.

``ends_sha256`` hashes a node's conversation ids in numerical order. The digest is
sequential by definition: ids are range-sorted and packed into chunks by many
tasks, and a node's chunks then stream through one hash object.

Defined results: rows without a conversation id are left out; null role or text
counts as empty; a null turn number stands first; rows of one conversation with
equal turn numbers are ordered by role, then text (code points), and repeated
rows stay repeated turns; an empty table gives no rows; other columns are not
read. A negative id's base follows SQL's remainder (-5 % 100 = -5).
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firmlink.llm.common import Tables

#: Ids packed into one row before they are hashed.
CHUNK = 1000
#: Depth from which unshared tails are looked for and stripped at once.
LONG = 16
_SUMS = ("n_convs", "n_children", "n_leaves", "saved_tokens")


def turn_paths(turns: DataFrame, tables: Tables, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
               text_col: str = "text") -> DataFrame:
    """``(conv, path)`` for each conversation, ``path`` an array of
    ``(digest, chars)`` in the order of the turns."""
    role, text = F.coalesce(F.col(role_col), F.lit("")), F.coalesce(F.col(text_col), F.lit(""))
    rows = turns.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"), role.alias("role"), text.alias("text"),
        F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))).alias("digest"),
        F.length(text).alias("chars"))
    keys = rows.groupBy("conv", "turn").agg(F.min("digest").alias("least"), F.max("digest").alias("most"))
    ties = tables.save(keys.where("least != most").select(F.col("conv").alias("tie_conv"), F.col("turn").alias("tie_turn")), "ties")
    if ties.isEmpty():
        rows = rows.withColumn("tie", F.lit(None).cast("struct<role:string,text:string>"))
    else:
        on = (F.col("conv") == F.col("tie_conv")) & F.col("turn").eqNullSafe(F.col("tie_turn"))
        rows = rows.join(ties, on, "left").withColumn("tie", F.when(F.col("tie_conv").isNotNull(), F.struct("role", "text")))
    ordered = F.sort_array(F.collect_list(F.struct("turn", "tie", "digest", "chars")))
    return rows.groupBy("conv").agg(F.transform(ordered, lambda x: F.struct(
        x["digest"].alias("digest"), x["chars"].alias("chars"))).alias("path"))


def share_heads(paths: DataFrame, group: int = 100, most: int = 6) -> DataFrame:
    """Conversations rebuilt on a common head: the first ``h`` turns of
    conversation ``c - c % group``, then the own turns after the first ``h``;
    ``h`` is the CRC-32 of the decimal id modulo ``most``."""
    c = F.col("conv")
    heads = paths.where(c % group == 0).select(c.alias("base"), F.slice("path", 1, most - 1).alias("head"))
    h = (F.crc32(F.encode(c.cast("string"), "UTF-8")) % most).cast("int")
    none = F.slice("path", 1, 0)
    rest = F.slice(F.col("path"), F.col("h") + 1, F.greatest(F.size("path") - F.col("h"), F.lit(0)))
    return (paths.withColumns({"h": h, "of": c - c % group}).join(heads, F.col("of") == F.col("base"), "left")
            .select("conv", F.concat(F.slice(F.coalesce("head", none), F.lit(1), F.col("h")), rest).alias("path")))


def _pack(batches):
    """Sorted ``(key, conv)`` rows as ``(key, first, ids)``, runs of one key in pieces of ``CHUNK`` ids."""
    for b in batches:
        b["run"] = (b["key"] != b["key"].shift()).cumsum()
        b["piece"] = b.groupby("run").cumcount() // CHUNK
        b["text"] = b["conv"].astype(str)
        g = b.groupby(["run", "piece"], sort=False)
        yield pd.DataFrame({"key": g["key"].first(), "first": g["conv"].first(), "ids": g["text"].agg(",".join)})


def _hash(batches):
    """The digest of each key, from chunks sorted by key and first id."""
    key = digest = None
    for b in batches:
        done = []
        for k, ids in zip(b["key"], b["ids"]):
            if k == key:
                digest.update(b"," + ids.encode())
                continue
            if key is not None:
                done.append((key, digest.hexdigest()))
            key, digest = k, hashlib.sha256(ids.encode())
        yield pd.DataFrame(done, columns=["end_key", "ends_sha256"])
    if key is not None:
        yield pd.DataFrame([(key, digest.hexdigest())], columns=["end_key", "ends_sha256"])


def id_digests(members: DataFrame) -> DataFrame:
    """``(end_key, ends_sha256)`` for stored rows ``(key, conv)``."""
    chunks = members.repartitionByRange("key", "conv").sortWithinPartitions("key", "conv").mapInPandas(
        _pack, "key string, first long, ids string")
    return chunks.repartition("key").sortWithinPartitions("key", "first").mapInPandas(_hash, "end_key string, ends_sha256 string")


def private_tops(ended: DataFrame, after: int) -> DataFrame:
    """``(top_key, top)``: the least depth beyond ``after`` from which no other
    row of ``ended`` (key, path; paths distinct) shares the path."""
    none = F.array().cast("array<string>")
    link = F.aggregate("path", none, lambda done, x: F.array_append(
        done, F.md5(F.concat(F.coalesce(F.try_element_at(done, F.lit(-1)), F.lit("")), F.hex(x["digest"])))))
    links = ended.where(F.col("turns") > after).select("key", F.posexplode(link).alias("pos", "link")).where(F.col("pos") >= after)
    alone = links.groupBy("pos", "link").agg(F.count("*").alias("k"), F.min("key").alias("top_key")).where("k = 1")
    return alone.groupBy("top_key").agg((F.min("pos") + 1).alias("top"))


def trie(paths: DataFrame, tables: Tables | None = None, long: int = LONG) -> DataFrame:
    """One row for each node of the trie over ``paths`` (conv, path), the root
    included: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``,
    ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens`` and ``ends_sha256``."""
    spark = paths.sparkSession
    tables = tables or Tables(spark, "trie")
    key = F.md5(F.array_join(F.transform("path", lambda x: F.hex(x["digest"])), ""))
    members = tables.save(paths.select("conv", "path", key.alias("key")), "members")
    digests = id_digests(members.select("key", "conv"))
    ended = members.groupBy("key", "path").agg(F.count("*").alias("n_convs"), F.min("conv").alias("conv_id"))
    whole = tables.save(ended.join(digests, F.col("key") == F.col("end_key")).drop("end_key").withColumn("turns", F.size("path")), "whole")
    tables.drop(members)
    cut = tables.save(whole.join(private_tops(whole, long), F.col("key") == F.col("top_key"), "left")
                      .withColumn("top", F.coalesce("top", "turns")).drop("top_key", "key").sortWithinPartitions("top"), "ended")
    tables.drop(whole)
    deepest = cut.agg(F.max("top")).first()[0]
    nobody = hashlib.sha256(b"").hexdigest()
    columns = ["conv_id", "depth", "parent_conv_id", *_SUMS, "ends_sha256"]
    out_schema = ", ".join(f"{c} {'string' if c == 'ends_sha256' else 'long'}" for c in columns)
    out_path = f"{tables.base}/nodes"
    if deepest is None:
        return spark.createDataFrame([], out_schema)

    def emit(nodes, depth, parent):
        rows = nodes.withColumns({"depth": depth.cast("long"), "ends_sha256": F.coalesce("ends_sha256", F.lit(nobody))})
        rows.withColumn("parent_conv_id", parent).select(columns).write.mode("append").parquet(out_path)

    def chars_from(depth):
        """Code points of the turns of ``path`` from ``depth`` on."""
        rest = F.slice(F.col("path"), depth, F.greatest(F.col("turns") - depth + 1, F.lit(0)))
        return F.aggregate(rest, F.lit(0).cast("long"), lambda n, x: n + x["chars"])

    one, again, ends = F.lit(1).cast("long"), F.col("n_convs") - 1, F.col("depth") == F.col("turns")
    tails = cut.where(F.col("turns") > F.col("top")).withColumn("depth", F.explode(F.sequence(F.col("top") + 1, F.col("turns"))))
    tails = tails.withColumns({"n_children": F.when(ends, 0).otherwise(1).cast("long"), "n_leaves": one,
                               "saved_tokens": again * chars_from(F.col("depth")), "ends_sha256": F.when(ends, F.col("ends_sha256"))})
    emit(tails, F.col("depth"), F.col("conv_id"))
    # What has ended below its row's path is counted in; the rounds add the node itself.
    goes_on = F.col("turns") > F.col("top")
    ended = cut.select(
        F.slice(F.col("path"), F.lit(1), F.col("top")).alias("path"), "conv_id", "n_convs",
        goes_on.cast("long").alias("n_children"), goes_on.cast("long").alias("n_leaves"),
        (again * chars_from(F.col("top") + 1)).alias("saved_tokens"),
        F.when(~goes_on, F.col("ends_sha256")).alias("ends_sha256"), "top")
    below = None
    for depth in range(deepest, -1, -1):
        here = ended.where(F.col("top") == depth).drop("top")
        if below is not None:
            here = here.unionByName(below.select(
                F.slice("path", 1, depth).alias("path"), "conv_id", "n_convs", F.lit(1).cast("long").alias("n_children"),
                "n_leaves", "saved_tokens", F.lit(None).cast("string").alias("ends_sha256")))
        nodes = here.groupBy("path").agg(F.min("conv_id").alias("conv_id"), *[F.sum(c).alias(c) for c in _SUMS],
                                         F.max("ends_sha256").alias("ends_sha256"))
        chars = F.coalesce(F.try_element_at("path", F.lit(-1))["chars"], F.lit(0))
        nodes = tables.save(nodes.withColumns({
            "n_leaves": F.when(F.col("n_children") == 0, F.lit(1).cast("long")).otherwise(F.col("n_leaves")),
            "saved_tokens": F.col("saved_tokens") + (F.col("n_convs") - 1) * chars}), "level")
        if below is not None:
            parents = nodes.select(F.col("path").alias("parent"), F.col("conv_id").alias("parent_id"))
            emit(below.join(parents, F.slice("path", 1, depth) == F.col("parent")), F.lit(depth + 1), F.col("parent_id"))
            tables.drop(below)
        below = nodes
    emit(below, F.lit(0), F.lit(None).cast("long"))
    tables.drop(below, cut)
    return spark.read.schema(out_schema).parquet(out_path)


def conversation_trie(turns: DataFrame) -> DataFrame:
    """The trie of ``turns`` (conv_id, turn, role, text), rebuilt on common heads."""
    tables = Tables(turns.sparkSession, "trie")
    own = tables.save(turn_paths(turns, tables), "own")
    return trie(share_heads(own), tables)
