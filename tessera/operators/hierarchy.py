"""Code hierarchies on flat rows.

Codes form a tree by prefix: a code's ancestors are its proper prefixes that exist
in the same edition. Paths are materialised (root -> parent) so queries never
recurse. Prefix enumeration is bounded by the code length, and tree walks are a
fixed number of join rounds bounded by the maximum depth, with lineage cut
through the shared checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def proper_prefixes(code: Column, min_len: int = 1) -> Column:
    """Array of struct(len, prefix) for lengths min_len .. length(code) - 1."""
    n = F.length(code)
    return F.when(n > min_len, F.transform(F.sequence(F.lit(min_len), n - 1),
                                           lambda i: F.struct(i.alias("len"), F.substring(code, 1, i).alias("prefix")))) \
            .otherwise(F.array().cast("array<struct<len:int,prefix:string>>"))


def prefix_ancestors(codes: DataFrame, code: str = "code", min_len: int = 1,
                     existing: DataFrame | None = None) -> DataFrame:
    """H1/H2: (code, ancestors array root->parent, parent, depth).

    ``existing`` is the membership truth set (defaults to ``codes``)."""
    existing = (existing if existing is not None else codes).select(F.col(code).alias("__e")).distinct()
    ex = codes.select(F.col(code).alias("__c")).distinct() \
              .select("__c", F.explode(proper_prefixes(F.col("__c"), min_len)).alias("__p"))
    hits = ex.join(existing, F.col("__p.prefix") == F.col("__e"), "left_semi")
    paths = hits.groupBy("__c").agg(F.array_sort(F.collect_list("__p")).alias("__ps"))
    out = codes.select(F.col(code).alias("__c")).distinct().join(paths, "__c", "left")
    anc = F.coalesce(F.transform("__ps", lambda s: s["prefix"]), F.array().cast("array<string>"))
    return out.select(F.col("__c").alias(code), anc.alias("ancestors")) \
              .withColumn("parent", F.when(F.size("ancestors") > 0, F.element_at("ancestors", -1))) \
              .withColumn("depth", F.size("ancestors"))


def longest_existing_prefix(codes: DataFrame, existing: DataFrame, code: str = "code",
                            min_len: int = 1) -> DataFrame:
    """(code, anchor): the nearest (longest) proper prefix present in ``existing``."""
    e = existing.select(F.col(code).alias("__e")).distinct()
    ex = codes.select(F.col(code).alias("__c")).distinct() \
              .select("__c", F.explode(proper_prefixes(F.col("__c"), min_len)).alias("__p"))
    hits = ex.join(e, F.col("__p.prefix") == F.col("__e"), "left_semi")
    return hits.groupBy("__c").agg(F.max("__p").alias("__m")) \
               .select(F.col("__c").alias(code), F.col("__m.prefix").alias("anchor"))


def walk(start: DataFrame, edges: DataFrame, max_depth: int, *, fail_on_unfinished: bool = True) -> DataFrame:
    """Follow pointers ``edges(src, dst)`` from ``start(node, cur)``.

    Returns (node, chain, last): ``chain`` lists the visited pointers in visit order
    (starting with ``cur``), ``last`` is the final non-NULL pointer. Each round joins
    only the walks still moving; finished walks are set aside. The moving frontier
    is checkpointed every round (lineage stays one round deep) and the loop stops
    as soon as it is empty. Walks still moving after ``max_depth`` rounds mean a
    cycle or a deeper tree than declared, which raises."""
    # the edge list is joined every round: materialise it once
    e = edges.select(F.col("src").alias("__src"), F.col("dst").alias("__dst")).checkpoint()
    s = start.select("node", "cur",
                     F.when(F.col("cur").isNotNull(), F.array("cur")).otherwise(F.array().cast("array<string>")).alias("chain"),
                     F.col("cur").alias("last"))
    done = s.filter(F.col("cur").isNull())
    moving = s.filter(F.col("cur").isNotNull())
    for _ in range(max_depth):
        j = moving.join(e, F.col("cur") == F.col("__src"), "left")
        nxt = F.col("__dst")
        step = j.select("node", nxt.alias("cur"),
                        F.when(nxt.isNotNull(), F.concat("chain", F.array(nxt))).otherwise(F.col("chain")).alias("chain"),
                        F.coalesce(nxt, F.col("last")).alias("last")).checkpoint()
        done = done.unionByName(step.filter(F.col("cur").isNull()))
        moving = step.filter(F.col("cur").isNotNull())
        if moving.isEmpty():
            break
    else:
        if fail_on_unfinished and not moving.isEmpty():
            raise ValueError(f"hierarchy walk did not finish in {max_depth} rounds (cycle or deeper tree)")
    return done.select("node", "chain", "last")


def tree_first_paths(code_set: DataFrame, tree: DataFrame, max_depth: int, min_len: int = 1) -> DataFrame:
    """H3: ancestors root->parent for every code of ``code_set`` (column ``code``).

    A code listed in the ``tree(child, parent)`` takes its ancestors from the tree
    chain; any other code anchors on its nearest existing prefix (existing = code
    set plus tree nodes) and takes the anchor's ancestors plus the anchor."""
    tree = tree.select("child", "parent").distinct().checkpoint()  # read by both walks and the final join
    tree_keys = tree.select(F.col("child").alias("code")).distinct()
    # tree chains
    tw = walk(tree.select(F.col("child").alias("node"), F.col("parent").alias("cur")),
              tree.filter(F.col("parent").isNotNull()).select(F.col("child").alias("src"), F.col("parent").alias("dst")),
              max_depth)
    tree_path = tw.select(F.col("node").alias("__tn"), F.reverse("chain").alias("__tp"))
    # anchors for codes not in the tree
    existing = code_set.select("code").unionByName(tree_keys).distinct()
    anchors = longest_existing_prefix(existing, existing, "code", min_len)
    non_tree_anchor = anchors.join(tree_keys, "code", "left_anti").checkpoint()  # walk start and edges
    aw = walk(non_tree_anchor.select(F.col("code").alias("node"), F.col("anchor").alias("cur")),
              non_tree_anchor.select(F.col("code").alias("src"), F.col("anchor").alias("dst")), max_depth)
    aw = aw.join(tree_path, F.col("last") == F.col("__tn"), "left") \
           .select(F.col("node").alias("__an"),
                   F.concat(F.coalesce("__tp", F.array().cast("array<string>")), F.reverse("chain")).alias("__ap"))
    codes = code_set.select("code").distinct()
    out = codes.join(tree_path, F.col("code") == F.col("__tn"), "left").join(aw, F.col("code") == F.col("__an"), "left")
    anc = F.coalesce("__tp", "__ap", F.array().cast("array<string>"))
    return out.select("code", anc.alias("ancestors")) \
              .withColumn("parent", F.when(F.size("ancestors") > 0, F.element_at("ancestors", -1))) \
              .withColumn("depth", F.size("ancestors"))


def non_leaf(codes: DataFrame, code: str = "code", min_len: int = 1) -> DataFrame:
    """Codes that are a proper prefix of some other code."""
    pre = codes.select(F.explode(proper_prefixes(F.col(code), min_len)).alias("__p")).select(F.col("__p.prefix").alias(code))
    return codes.select(code).distinct().join(pre.distinct(), code, "left_semi")


def leaf_flags(codes: DataFrame, code: str = "code", min_len: int = 1) -> DataFrame:
    """H4: is_leaf = no other code has this code as a proper prefix."""
    nl = non_leaf(codes, code, min_len).withColumn("__nl", F.lit(True))
    return codes.select(code).distinct().join(nl, code, "left") \
                .select(code, F.col("__nl").isNull().alias("is_leaf"))


def paths_by_doubling(edges: DataFrame, child: str = "child", parent: str = "parent") -> DataFrame:
    """(node, path): the path root -> node of every child of ``edges`` (roots have a NULL parent).

    Each node knows a stretch of ancestors and who comes next; a round joins the stretch of that next
    one, so stretches double and a tree of depth d takes log2(d) rounds. A parent that is no child itself
    is a root above. Nodes that never reach a root (a cycle) raise."""
    e = edges.select(F.col(child).alias("node"), F.col(parent).alias("up")).distinct()
    tops = e.where(F.col("up").isNotNull()).select(F.col("up").alias("node")).distinct().join(e.select("node"), "node", "left_anti")
    now = e.unionByName(tops.withColumn("up", F.lit(None).cast(e.schema["up"].dataType))).withColumn("path", F.array("node")).checkpoint()
    limit = now.count().bit_length() + 1
    for _ in range(limit):
        if now.where(F.col("up").isNotNull()).isEmpty():
            return now.select("node", "path")
        above = now.select(F.col("node").alias("__n"), F.col("up").alias("__up"), F.col("path").alias("__path"))
        now = now.join(above, F.col("up") == F.col("__n"), "left").select(
            "node", F.col("__up").alias("up"), F.concat(F.coalesce("__path", F.array().cast(now.schema["path"].dataType)), "path").alias("path")).checkpoint()
    raise ValueError("hierarchy holds a cycle")


def interval_labels(paths: DataFrame, folder: str, node: str = "node", path: str = "path") -> DataFrame:
    """H5/H6: store every node with its interval in pre-order, and return the stored table.

    Rows (``node``, ``path`` from the root to the node itself, further columns kept) are sorted by path, so that a node
    stands before its descendants and these stand together; ``first`` numbers them in that order (growing, with
    gaps between partitions), ``last`` is the greatest number of the node's subtree. Then X lies below Y exactly if
    Y.first < X.first <= Y.last: a subtree is a range, which files sorted by ``first`` answer from their statistics."""
    spark = paths.sparkSession
    paths.repartitionByRange(path).sortWithinPartitions(path).withColumn("first", F.monotonically_increasing_id()).write.parquet(f"{folder}/numbered")
    numbered = spark.read.parquet(f"{folder}/numbered")
    ends = numbered.select(F.explode(path).alias("__n"), "first").groupBy("__n").agg(F.max("first").alias("last"))
    out = numbered.join(ends, numbered[node] == ends["__n"]).drop("__n")
    out.repartitionByRange("first").sortWithinPartitions("first").write.parquet(f"{folder}/labels")
    return spark.read.parquet(f"{folder}/labels")


def subtree(labels: DataFrame, root, node: str = "node") -> DataFrame:
    """H5: the nodes below ``root``, by its interval; none if it is not there."""
    at = labels.where(F.col(node) == F.lit(root)).select("first", "last").first()
    return labels.where((F.col("first") > at["first"]) & (F.col("first") <= at["last"])) if at else labels.where(F.lit(False))
