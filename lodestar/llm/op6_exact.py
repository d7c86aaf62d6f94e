"""Exact dedup by progressive refinement: length, prefix hash, full hash.

Each level groups only what the level before left undecided:

1. rows are grouped by text length (one number per row);
2. rows whose length repeats are grouped by (length, hash of the first
   ``prefix_chars`` characters);
3. the surviving (length, prefix) classes set bits in a fixed-size bitmap
   (``bitmap_bits``, 1 MB: the only thing broadcast, whatever the input
   size).  A second scan reads full content and takes SHA-256 only for rows
   whose bit is set; a bit shared by chance costs one hash more and decides
   nothing;
4. rows with equal (length, SHA-256) form a group.

Text never crosses a shuffle: rows travel as (id, length, hash).  Groups are
counted by map-side combined aggregates; the join back to the rows is an
equi-join of narrow rows, salted for groups above ``rows_per_task``.

Defined cases: null text counts as empty; the largest doc_id of a group
stays; a null doc_id is smaller than any other; rows that repeat a doc_id
with equal text share its decision (``kept`` true for each of them, all
counted in ``group_size``); an empty table gives an empty result; other
columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm.common import FILTER_BITS, documents, possible, stored
from lodestar.operators.skew import salted_join_back

PREFIX_CHARS = 64


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 prefix_chars: int = PREFIX_CHARS, bitmap_bits: int = FILTER_BITS,
                 digest_all: bool = False) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) of every row.

    ``text_sha256`` is null for rows that no level had to read in full;
    ``digest_all`` fills it for them too, for callers that want the digest."""
    base = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    length, prefix = F.octet_length("t"), F.xxhash64(F.substring("t", 1, prefix_chars))
    first = stored(base.select(length.alias("len"), prefix.alias("prefix")).groupBy("len", "prefix").count(), "op6-level")
    # level 1: lengths that repeat; level 2: (length, prefix) classes that repeat
    by_len = first.groupBy("len").agg(F.sum("count").alias("n")).filter("n > 1").select("len")
    classes = first.join(by_len, "len", "left_semi").filter("count > 1")
    full = F.sha2("t", 256)        # level 3: full content
    marked = possible(base.withColumns({"len": length, "prefix": prefix}), F.struct("len", "prefix"),
                      classes.select("len", "prefix"), F.struct("len", "prefix"), bitmap_bits)
    rows = stored(marked.select("doc_id", "len", F.col("_maybe").alias("suspect"),
                                (full if digest_all else F.when(F.col("_maybe"), full)).alias("text_sha256")), "op6-rows")
    keys = ["len", "text_sha256"]
    groups = (rows.filter("suspect").groupBy(keys)
              .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")))
    grouped = salted_join_back(rows.filter("suspect"), groups, keys, "group_size", salt_cols=["doc_id"])
    alone = rows.filter("not suspect").withColumns({"keep_id": F.col("doc_id"), "group_size": F.lit(1)})
    return grouped.unionByName(alone).select(
        "doc_id", "keep_id", F.col("group_size").cast("long").alias("group_size"),
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def query(spark, sf_dir: str) -> DataFrame:
    return exact_groups(documents(spark, sf_dir), digest_all=True)


ORACLE = """
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256
FROM (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256,
             max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
             count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size
      FROM documents)
"""
