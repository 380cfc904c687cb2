"""A property graph as vertex and edge tables, with upserts as joins: the last row of a key wins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.functions.text import RELATIONS, node_key, truthy


def last_per_key(rows: DataFrame, keys: tuple[str, ...], seq: str = "seq") -> DataFrame:
    """The row of the greatest seq of each key. It is an aggregation, so copies of a key fold before the shuffle."""
    rest = [c for c in rows.columns if c not in (*keys, seq)]
    picked = rows.groupBy(*keys).agg(F.max_by(F.struct(seq, *rest), seq).alias("_r"))
    return picked.select(*keys, *(F.col(f"_r.{c}").alias(c) for c in rows.columns if c not in keys))


def upsert(old: DataFrame, new: DataFrame, keys: tuple[str, ...], merge: dict[str, Column] | None = None) -> DataFrame:
    """old with rows of new put in: all columns are overwritten, with nulls too, but where merge gives an expression over o.<c> and n.<c>.

    new has a key once (see last_per_key). Columns are those of old.
    """
    o, n = old.alias("o"), new.alias("n")
    on = [F.col(f"o.{k}") == F.col(f"n.{k}") for k in keys]
    cond = on[0]
    for c in on[1:]:
        cond = cond & c
    given = F.col(f"n.{keys[0]}").isNotNull()
    held = F.col(f"o.{keys[0]}").isNotNull()

    def value(c: str) -> Column:
        if c in keys:
            return F.coalesce(F.col(f"n.{c}"), F.col(f"o.{c}"))
        if c not in new.columns:
            return F.col(f"o.{c}")
        both = (merge or {}).get(c, F.col(f"n.{c}"))
        return F.when(given & held, both).when(given, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}"))

    return o.join(n, cond, "full").select(*(value(c).alias(c) for c in old.columns))


def reference_edges(documents: DataFrame) -> DataFrame:
    """(src, rel_type, dst, seq, context, anchor_text, target_url): references with a target and a legal relation, the last of each key.

    A missing relation is REFERENCES.
    """
    rows = documents.select(F.col("id").alias("src"), F.posexplode("cross_references").alias("pos", "r"), "seq")
    kind = F.coalesce("r.rel_type", F.lit("REFERENCES"))
    rows = rows.where(truthy("r.target_slug").isNotNull() & kind.isin(*RELATIONS))
    rows = rows.select("src", kind.alias("rel_type"), F.col("r.target_slug").alias("dst"), F.struct("seq", "pos").alias("seq"), "r.context", "r.anchor_text", "r.target_url")
    return last_per_key(rows, ("src", "rel_type", "dst"))


def with_stubs(documents: DataFrame, edges: DataFrame) -> DataFrame:
    """documents, and a row with id and slug only for each target of an edge that is no document."""
    missing = edges.select(F.col("dst").alias("id")).distinct().join(documents.select("id"), "id", "left_anti")
    return documents.unionByName(missing.withColumn("slug", F.col("id")), allowMissingColumns=True)


def edges_of_known(edges: DataFrame, nodes: DataFrame, src: str = "src", key: str = "id") -> DataFrame:
    """Edges whose source is there."""
    return edges.join(nodes.select(F.col(key).alias(src)).distinct(), src, "left_semi")


def chunk_edges(chunks: DataFrame, documents: DataFrame) -> DataFrame:
    """(document_id, language, chunk_id, order) for chunks whose document is there; the chunks themselves are kept anyway."""
    rows = chunks.select("document_id", "language", F.col("id").alias("chunk_id"), "order")
    return edges_of_known(rows, documents, "document_id")


def topic_nodes(topics: DataFrame) -> DataFrame:
    return last_per_key(topics.select("canonical_name", "seq", "name", "embedding"), ("canonical_name",))


def topic_edges(topics: DataFrame, documents: DataFrame) -> DataFrame:
    last = last_per_key(topics.select("document_id", "canonical_name", "seq", "confidence", "evidence"), ("document_id", "canonical_name"))
    return edges_of_known(last, documents, "document_id")


def put_communities(nodes: DataFrame, assignments: DataFrame, kind: str, key: str) -> DataFrame:
    """community_id and community_summary of existing nodes, from assignments of node `kind:key`; others keep theirs."""
    given = last_per_key(assignments.withColumn("_key", node_key(kind, "node")).where("_key IS NOT NULL").select("_key", "seq", "community_id", "community_summary"), ("_key",))
    had = [c for c in ("community_id", "community_summary") if c in nodes.columns]
    rows = nodes.alias("x").join(given.alias("g"), F.col(f"x.{key}") == F.col("g._key"), "left")
    put = [F.when(F.col("g._key").isNotNull(), F.col(f"g.{c}")).otherwise(F.col(f"x.{c}") if c in had else F.lit(None)).alias(c) for c in ("community_id", "community_summary")]
    return rows.select(*(F.col(f"x.{c}") for c in nodes.columns if c not in had), *put)


def vector_dimension(*tables: DataFrame) -> int | None:
    """The length of the first embedding that isn't empty, of the first table that has one."""
    for t in tables:
        row = t.select(F.size("embedding").alias("n")).where("n > 0").first()
        if row:
            return row.n
    return None


def same_dimension(table: DataFrame) -> bool:
    ends = table.where(F.size("embedding") > 0).agg(F.min(F.size("embedding")).alias("a"), F.max(F.size("embedding")).alias("b")).first()
    return ends.a == ends.b


def unique(rows: DataFrame, keys: tuple[str, ...]) -> bool:
    """Whether no key repeats: the check that a constraint would make."""
    return rows.groupBy(*keys).count().where("count > 1").isEmpty()


def community_graph(documents: DataFrame, topics: DataFrame) -> DataFrame:
    """(a, b), a < b: documents and the targets of their references, and documents and their topics, each pair once."""
    refs = documents.select(F.concat(F.lit("doc:"), "id").alias("x"), F.explode("cross_references").alias("r")).where(truthy("r.target_slug").isNotNull()).select("x", F.concat(F.lit("doc:"), F.col("r.target_slug")).alias("y"))
    tops = topics.select(F.concat(F.lit("doc:"), "document_id").alias("x"), F.concat(F.lit("topic:"), "canonical_name").alias("y"))
    return refs.union(tops).where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def expand_one_hop(candidates: DataFrame, edges: DataFrame, src: str = "document_id") -> DataFrame:
    """Out-edges of the candidates' documents."""
    return candidates.select(src).distinct().join(edges.withColumnRenamed("src", src), src)


class Graph:
    """The graph's tables in a folder. Each load reads what is there, merges, and writes the next version beside it."""

    TABLES = {
        "documents": ("id",),
        "topics": ("canonical_name",),
        "chunks": ("id",),
        "references": ("src", "rel_type", "dst"),
        "has_chunk": ("document_id", "language", "chunk_id"),
        "has_topic": ("document_id", "canonical_name"),
    }

    def __init__(self, spark, path: str) -> None:
        self.spark, self.path = spark, path

    def versions(self, name: str) -> list[int]:
        """Versions of a table that were written to their end, by the folder's listing, so a later session finds them."""
        hadoop = self.spark.sparkContext._jvm.org.apache.hadoop.fs
        at = hadoop.Path(f"{self.path}/{name}")
        files = at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not files.exists(at):
            return []
        found = [s.getPath() for s in files.listStatus(at) if s.getPath().getName().startswith("version=")]
        return sorted(int(p.getName().split("=")[1]) for p in found if files.exists(hadoop.Path(p, "_SUCCESS")))

    def read(self, name: str) -> DataFrame | None:
        held = self.versions(name)
        return self.spark.read.parquet(f"{self.path}/{name}/version={held[-1]}") if held else None

    def merge(self, name: str, rows: DataFrame) -> None:
        """Upserts rows (a key once) into a table; a failed write leaves the version before. Versions before that go."""
        old, held = self.read(name), self.versions(name)
        out = rows if old is None else upsert(old.unionByName(rows.limit(0), allowMissingColumns=True), rows, self.TABLES[name])
        out.write.mode("overwrite").parquet(f"{self.path}/{name}/version={held[-1] + 1 if held else 0}")
        hadoop = self.spark.sparkContext._jvm.org.apache.hadoop.fs
        for version in held[:-1]:
            old_path = hadoop.Path(f"{self.path}/{name}/version={version}")
            old_path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(old_path, True)

    def load_documents(self, documents: DataFrame, include_stubs: bool = True) -> None:
        edges = reference_edges(documents)
        rows = last_per_key(documents, ("id",)).drop("seq", "cross_references", "raw")
        self.merge("documents", rows)
        if include_stubs:
            held = self.read("documents")
            stubs = with_stubs(held, edges).join(held.select("id"), "id", "left_anti")
            self.merge("documents", stubs.select(*held.columns))
        self.merge("references", edges.drop("seq"))

    def load_chunks(self, chunks: DataFrame) -> None:
        self.merge("chunks", last_per_key(chunks, ("id",)).drop("seq"))
        self.merge("has_chunk", chunk_edges(chunks, self.read("documents")))

    def load_topics(self, topics: DataFrame) -> None:
        self.merge("topics", topic_nodes(topics).drop("seq"))
        self.merge("has_topic", topic_edges(topics, self.read("documents")).drop("seq"))

    def load_communities(self, assignments: DataFrame) -> None:
        for name, kind, key in (("documents", "doc", "id"), ("topics", "topic", "canonical_name")):
            self.merge(name, put_communities(self.read(name), assignments, kind, key))
