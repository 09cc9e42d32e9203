"""Exact deduplication by deterministic block naming.

Every text is cut into blocks of ``block_bytes`` bytes. Equal blocks get
one integer name: the distinct blocks are sorted and numbered. Then
adjacent names are paired, the distinct pairs are sorted and numbered in
turn, and so on, until one name is left for each document. Two texts with
equally many blocks have the same last name exactly if they are equal, as
each round of naming is one-to-one.

Block texts move once, to be sorted (copies are merged before that
shuffle). Names find their way back to the documents by a short signature
of the block. That the signature tells all distinct blocks apart is
checked on the sorted blocks; if it ever does not, the run is repeated
with a SHA-256 signature, and fails if even that has a collision.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pluvio.llm.common import free_prefix, others, staged

BLOCK_BYTES = 4096


def _short(block: Column) -> Column:
    return F.struct(F.xxhash64(block).alias("a"), F.hash(block).alias("b"),
                    F.octet_length(block).alias("c"))


def _long(block: Column) -> Column:
    return F.struct(F.sha2(block, 256).alias("a"), F.lit(0).alias("b"),
                    F.octet_length(block).alias("c"))


def _blocks(content: Column, block_bytes: int) -> Column:
    """The bytes in blocks; an empty text is one empty block."""
    n = F.greatest(F.lit(1), F.ceil(F.octet_length(content) / block_bytes)).cast("int")
    return F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.substr(
        content, i * block_bytes + 1, F.lit(block_bytes)))


def _named(units: DataFrame, key: list[str]) -> DataFrame:
    """The distinct keys in sorted order, with an integer name each."""
    return (units.select(*key).distinct().sortWithinPartitions(*key)
            .withColumn("name", F.monotonically_increasing_id()))


def _gathered(units: DataFrame) -> DataFrame:
    """(row, names): a document's names in order."""
    in_order = F.array_sort(F.collect_list(F.struct("pos", "name")))
    return units.groupBy("row").agg(F.transform(in_order, lambda x: x["name"]).alias("names"))


def _block_names(content: DataFrame, block_bytes: int) -> tuple[DataFrame, DataFrame]:
    """(rows with their signatures, signature -> name)."""
    for signature in (_short, _long):
        rows = staged(content.select(
            F.monotonically_increasing_id().alias("row"), "doc_id",
            F.sha2("content", 256).alias("text_sha256"),
            F.transform(_blocks(F.col("content"), block_bytes), signature).alias("signatures")), "rows")
        blocks = content.select(F.explode(_blocks(F.col("content"), block_bytes)).alias("block"))
        names = staged(_named(blocks, ["block"]).select(
            signature(F.col("block")).alias("signature"), "name"), "names")
        if names.groupBy("signature").count().where("count > 1").isEmpty():
            return rows, names
    raise RuntimeError("two different blocks share a SHA-256 digest")


def identities(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document row: (row, doc_id, text_sha256, n_blocks, name).

    ``(n_blocks, name)`` is the same for two rows exactly if their texts are.
    A null text counts as empty. Names hold inside one call only.
    """
    content = docs.select(F.col(id_col).alias("doc_id"),
                          F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("content"))
    rows, names = _block_names(content, block_bytes)
    units = rows.select("row", F.posexplode("signatures").alias("pos", "signature"))
    current = staged(_gathered(units.join(names, "signature")), "level")
    finished = [current.where(F.size("names") == 1)]
    most = current.agg(F.max(F.size("names"))).first()[0] or 1
    while most > 1:
        pair = lambda i: F.struct(
            F.get("names", 2 * i).alias("left"),
            F.coalesce(F.get("names", 2 * i + 1), F.lit(-1)).alias("right"))
        halves = F.ceil(F.size("names") / 2).cast("int")
        units = (current.where(F.size("names") > 1)
                 .select("row", F.posexplode(F.transform(F.sequence(F.lit(0), halves - 1), pair))
                         .alias("pos", "pair")).select("row", "pos", "pair.*"))
        names = staged(_named(units, ["left", "right"]), "names")
        current = staged(_gathered(units.join(names, ["left", "right"])), "level")
        finished.append(current.where(F.size("names") == 1))
        most = (most + 1) // 2
    last = finished[0]
    for level in finished[1:]:
        last = last.unionByName(level)
    return rows.join(last, "row").select(
        "row", "doc_id", "text_sha256", F.size("signatures").alias("n_blocks"),
        F.col("names")[0].alias("name"))


def duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document row, dropped ones too: (doc_id, keep_id,
    group_size, kept, text_sha256).

    Of equal texts the row with the largest id stays; a null id is smaller
    than any other. Of rows that are equal in id and text, one stays.
    An empty table gives an empty result. Other columns are not read.
    """
    members = staged(identities(docs, id_col, text_col, block_bytes), "identities")
    # written first, so that the join has a shuffle of its own whose hot keys Spark can split
    groups = staged(members.groupBy("n_blocks", "name").agg(
        F.max(F.struct("doc_id", "row")).alias("top"), F.count(F.lit(1)).alias("group_size")), "groups")
    return members.join(groups, ["n_blocks", "name"]).select(
        "doc_id", F.col("top.doc_id").alias("keep_id"), "group_size",
        (F.col("row") == F.col("top.row")).alias("kept"), "text_sha256")


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` without the rows that :func:`duplicates` drops, all columns kept.

    Columns and their names stay as they are, whatever they are called.
    """
    found = staged(duplicates(docs, id_col, text_col, block_bytes), "duplicates")
    # rows equal in id and text cannot be told apart by key: their one survivor is picked below
    again = staged(found.where("doc_id <=> keep_id and group_size > 1")
                   .groupBy("doc_id", "text_sha256").count().where("count > 1"), "again")
    dropped = (found.where("not kept and not doc_id <=> keep_id")
               .select(F.col("doc_id").alias("d"), F.col("text_sha256").alias("s")).distinct())
    digest = free_prefix(docs, "_exact_dedup_digest_")
    marked = docs.withColumn(digest, F.sha2(F.coalesce(F.col(text_col), F.lit("")).cast("binary"), 256))
    left = marked.join(dropped, marked[id_col].eqNullSafe(dropped["d"])
                       & (marked[digest] == dropped["s"]), "left_anti")
    if not again.isEmpty():
        twins = again.select(F.col("doc_id").alias("d"), F.col("text_sha256").alias("s"))
        same = left[id_col].eqNullSafe(twins["d"]) & (left[digest] == twins["s"])
        left = (left.join(twins, same, "left_anti")
                .unionByName(left.join(twins, same, "left_semi").dropDuplicates([id_col, digest])))
    return left.select(*others(left, [digest]))
