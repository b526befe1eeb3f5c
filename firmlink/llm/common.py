"""Helpers shared by the operators: intermediate tables in the cluster's shared
folder, connected components, and near-duplicate linking inside buckets."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session. Where it is unset, a local
    session (tests) gets a scratch folder of its own; any other master is an
    error, because its executors would not see a local folder."""
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if base:
        return base.rstrip("/")
    if not sc.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    base = tempfile.mkdtemp(prefix="firmlink-llm-")
    sc.setCheckpointDir(base)
    return base


class Tables:
    """Intermediate Parquet tables of one operator call, under one folder of
    the shared directory. Writing a table and reading it back cuts the lineage:
    a lost executor costs a re-read of files, not a recomputation. ``drop``
    deletes tables that no returned DataFrame reads."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.base = f"{shared_dir(spark)}/llm-{name}-{uuid.uuid4().hex}"
        self._n = 0

    def save(self, df: DataFrame, name: str = "t") -> DataFrame:
        self._n += 1
        path = f"{self.base}/{self._n:03d}-{name}"
        df.write.option("compression", "zstd").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._llm_path = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for t in tables:
            p = jvm.org.apache.hadoop.fs.Path(t._llm_path)
            p.getFileSystem(conf).delete(p, True)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column of ``df`` has it
    (column names compare without case, as Spark resolves them)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def id_text(col="doc_id"):
    """An id as text for the fold rules; a null id counts as the empty text."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def ordered(docs: DataFrame, id_col: str, tables: Tables) -> tuple[DataFrame, str]:
    """``docs`` with a long column that orders its rows by id: the id itself
    where it is a whole number, present and unique; otherwise row numbers of a
    table sorted by id (nulls first) and text, so rows of one id count as
    different documents."""
    ord_col = free_name(docs, "ord")
    if docs.schema[id_col].dataType.typeName() in ("byte", "short", "integer", "long"):
        bad = docs.groupBy(id_col).count().where(F.col(id_col).isNull() | (F.col("count") > 1))
        if bad.isEmpty():
            return docs.withColumn(ord_col, F.col(id_col).cast("long")), ord_col
    keys = [F.col(id_col), *[F.col(c) for c in docs.columns if c != id_col and docs.schema[c].dataType.typeName() == "string"]]
    in_order = docs.repartitionByRange(*keys).sortWithinPartitions(*keys)
    return tables.save(in_order.withColumn(ord_col, F.monotonically_increasing_id()), "ordered"), ord_col


#: Ids that choose rows with texts are broadcast up to so many (8 bytes each).
BROADCAST_IDS = 2_000_000

#: Edge tables of up to so many rows are handled in one partition, without shuffles.
SMALL_EDGES = 200_000


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def components(edges: DataFrame, tables: Tables) -> DataFrame:
    """Connected components of the undirected edges ``(a, b)`` as rows
    ``(id, component)`` for every node of an edge, ``component`` being the
    smallest id of the component.

    Union-find by alternating large-star and small-star rounds (Kiveris et al.
    2014): a round hooks every node's larger neighbours, then the node itself,
    to its smallest neighbour. Each is an aggregation with map-side minima and a
    join, so a hub with many edges neither meets in one task (the join's skewed
    partitions can be split) nor reaches the driver; the number of rounds grows
    with the logarithm of the longest path. Up to ``SMALL_EDGES`` edges the same
    rounds run in one partition, which saves the shuffles. An empty edge table
    gives no rows.
    """
    a, b = F.col("a"), F.col("b")
    cur = tables.save(
        edges.where(a.isNotNull() & b.isNotNull() & (a != b))
        .select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct(), "cc")
    state = _state(cur)
    while state[0]:
        base = cur.coalesce(1) if state[0] <= SMALL_EDGES else cur
        both = base.select(F.inline(F.array(F.struct(a, b), F.struct(b.alias("a"), a.alias("b")))))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = (both.where(b > a).join(low, "a")
                 .select(b.alias("a"), F.col("m").alias("b")).where(a != b).distinct())
        large = tables.save(large, "cc")
        base = large.coalesce(1) if state[0] <= SMALL_EDGES else large
        low = base.groupBy("a").agg(F.min("b").alias("m"))
        small = (base.join(low, "a").select(F.inline(F.array(
            F.struct(b.alias("a"), F.col("m").alias("b")), F.struct(a, F.col("m").alias("b"))))).where(a != b).distinct())
        small = tables.save(small, "cc")
        before, state = state, _state(small)
        tables.drop(cur, large)
        cur = small
        if state == before:
            break
    out = cur.select(a.alias("id"), b.alias("component"))
    return out.unionByName(out.select(F.col("component").alias("id"), "component").distinct())


def link_buckets(members: DataFrame, verify: Callable[[DataFrame], DataFrame], tables: Tables,
                 carry: tuple[str, ...] = ()) -> DataFrame:
    """Components of the graph whose edges are the pairs of one bucket that
    ``verify`` accepts, without listing all pairs of a bucket.

    ``members``: rows ``(key, id, *carry)``, distinct in key and id; ``verify``
    keeps the accepted rows of a table of distinct pairs ``(a, b)`` with the
    carried columns of both sides as ``a_x, b_x``. Steps:

    1. each member is compared with the bucket's smallest id (its hub);
    2. members not connected with their hub yet are compared with the smallest
       such id of the bucket, and so is every other member;
    3. what is still unconnected is compared with every member of another
       component in its bucket.

    Pairs that step 3 leaves out lie in one component already, so the
    components equal those of all bucket pairs. A bucket of true near copies
    costs a multiple of its size; only members that belong to none of its
    large components meet all others.

    Returns ``(id, component)`` for ids that have a link.
    """
    side = lambda p: [F.col(c).alias(f"{p}_{c}") for c in carry]
    hubs = members.groupBy("key").agg(F.min(F.struct("id", *carry)).alias("hub"), F.count("*").alias("n")).where("n > 1").drop("n")
    live = tables.save(members.join(hubs, "key"), "bucket")
    star = live.where("id != hub.id").select(
        F.col("hub.id").alias("a"), F.col("id").alias("b"),
        *[F.col("hub")[c].alias(f"a_{c}") for c in carry], *side("b")).dropDuplicates(["a", "b"])
    edges = tables.save(verify(star).select("a", "b"), "edges")

    def labelled(comp):
        c1 = comp.select("id", F.col("component").alias("c"))
        c2 = comp.select(F.col("id").alias("h"), F.col("component").alias("hc"))
        out = live.join(c1, "id", "left").join(c2, F.col("hub.id") == F.col("h"), "left")
        return out.select("key", "id", *carry, F.col("hub.id").alias("hub"), F.coalesce("c", "id").alias("c"),
                          F.coalesce("hc", "hub.id").alias("hc"))

    def pairs(left, left_id, right):
        """Pairs of one bucket across components, the smaller id first."""
        swap = F.col(left_id) > F.col("id")
        both = left.join(right, "key").where("c != sc")
        return both.select(
            F.least(left_id, "id").alias("a"), F.greatest(left_id, "id").alias("b"),
            *[F.when(swap, F.col(c)).otherwise(F.col(f"s_{c}")).alias(f"a_{c}") for c in carry],
            *[F.when(swap, F.col(f"s_{c}")).otherwise(F.col(c)).alias(f"b_{c}") for c in carry])

    comp = tables.save(components(edges, tables), "comp")
    lab = tables.save(labelled(comp), "labelled")
    rest = lab.where("c != hc")
    if rest.isEmpty():
        return comp
    second = rest.groupBy("key").agg(F.min(F.struct("id", "c", *carry)).alias("s")).select(
        "key", F.col("s.id").alias("s"), F.col("s.c").alias("sc"), *[F.col("s")[c].alias(f"s_{c}") for c in carry])
    mine = lab.where("id != hub").select("key", "id", "c", *carry)
    edges2 = tables.save(verify(pairs(second, "s", mine).dropDuplicates(["a", "b"])).select("a", "b"), "edges")
    known = comp.where("id != component").select(F.col("id").alias("a"), F.col("component").alias("b"))
    if not edges2.isEmpty():
        comp = tables.save(components(known.unionByName(edges2), tables), "comp")
        lab = tables.save(labelled(comp), "labelled")
        known = comp.where("id != component").select(F.col("id").alias("a"), F.col("component").alias("b"))
        mine = lab.where("id != hub").select("key", "id", "c", *carry)
    rest = lab.where("c != hc").select("key", F.col("id").alias("s"), F.col("c").alias("sc"), *side("s"))
    if rest.isEmpty():
        return comp
    edges3 = tables.save(verify(pairs(rest, "s", mine).dropDuplicates(["a", "b"])).select("a", "b"), "edges")
    return comp if edges3.isEmpty() else tables.save(components(known.unionByName(edges3), tables), "comp")
