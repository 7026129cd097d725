"""Operator 3: benchmark decontamination by size-partitioned MinHash containment search.

A test item is short, a document may be long, so sketches of equal size say nothing. Here the sketch
of an item with ``n`` distinct five-word shingles is its ``n - ceil(0.8 n) + 1`` smallest hashes (a
bottom-k MinHash); a document that holds 0.8 of the shingles can't miss them all. Items are put into
partitions by size, powers of two. The largest hash in any sketch of a partition is its bound, and
the sketch of a document for that partition is all its hashes up to the bound, so a document's
sketch grows with the document and the search loses nothing. Items and documents that share a
sketched hash of a partition are candidates, and a candidate counts after its shingles themselves
are compared.

Only DataFrame functions are used. Words are what white space separates, with A to Z in lower case.

Results for odd input: null or blank texts and texts of fewer than five words hold nothing and match
nothing, items included. Repeated documents are reported once per id. A null id is reported as null.
Empty tables give no rows; other columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forerate.functions.joins import lookup
from forerate.llm.common import free_names, words_sql
from forerate.sources.staging import staged

WORDS, SHARE = 5, 0.8


def shingle_hashes(words: int) -> str:
    """SQL for the hashes of all shingles of an array column ``words``."""
    at = ", ".join(f"hashed[i + {j}]" for j in range(words))
    # the planner may ask for these before it drops short texts
    return f"if(size(hashed) >= {words}, transform(sequence(0, size(hashed) - {words}), i -> xxhash64({at})), array())"


def with_shingles(df: DataFrame, words: int) -> DataFrame:
    """Adds ``hashed``, a hash per word, for texts of at least ``words`` words; others go."""
    df = df.withColumn("hashed", F.expr(f"transform({words_sql('text', lower=True)}, w -> xxhash64(w))"))
    return df.where(F.size("hashed") >= words)


def exact_shingles(words: int) -> str:
    """SQL for the distinct shingles themselves, as strings, of an array column ``words``."""
    at = ", ".join(f"words[i + {j}]" for j in range(words))
    found = f"transform(sequence(0, size(words) - {words}), i -> concat_ws(' ', {at}))"
    return f"if(size(words) >= {words}, array_distinct({found}), array())"


def item_sketches(items: DataFrame, words: int = WORDS, share: float = SHARE) -> DataFrame:
    """``item, hash, bound``: the sketch of each item and the bound of its size partition."""
    rows = with_shingles(items.select(F.col("item_id").cast("long").alias("item"), "text"), words)
    rows = rows.withColumn("hashes", F.expr(f"array_sort(array_distinct({shingle_hashes(words)}))"))
    n = F.size("hashes")
    keep = n - F.ceil(n * share - 1e-9).cast("int") + 1
    rows = rows.select("item", F.floor(F.log2(n)).cast("int").alias("size_class"), F.slice("hashes", 1, keep).alias("sketch"))
    bounds = rows.groupBy("size_class").agg(F.max(F.array_max("sketch")).alias("bound"))
    return rows.join(bounds, "size_class").select("item", "size_class", "bound", F.explode("sketch").alias("hash"))


def candidates(docs: DataFrame, sketches: DataFrame, words: int = WORDS) -> DataFrame:
    """Distinct ``(doc, mark, item)`` that share a sketched hash of the item's size partition.

    ``sketches`` is staged: it has few rows per item of a test set. A document's sketches are nested,
    so one with the largest bound serves every partition.
    """
    top = sketches.agg(F.max("bound")).first()[0]
    if top is None:
        top = -(1 << 63)
    rows = with_shingles(docs, words)
    sketch = F.expr(f"array_distinct(filter({shingle_hashes(words)}, h -> h <= {top}L))")
    rows = rows.select("doc", "mark", F.explode(sketch).alias("hash"))
    size = sketches.count()
    return lookup(rows, sketches.select("item", "hash"), ["hash"], size, "inner").select("doc", "mark", "item").distinct()


def contained(docs: DataFrame, items: DataFrame, words: int = WORDS, share: float = SHARE) -> DataFrame:
    """``doc_id, mark, item_id, n_shingles, n_found`` of every document that holds ``share`` of an item.

    ``mark`` is the hash of the document's text; together with the id it names the row.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc"), F.xxhash64("text").alias("mark"), "text")
    sketches = staged(item_sketches(items, words, share), "sketches")
    pairs = staged(candidates(docs, sketches, words), "leaks")
    found = pairs.select("doc", "mark").distinct()
    asked = pairs.select("item").distinct()
    named = items.select(F.col("item_id").cast("long").alias("item"), F.expr(words_sql("text", lower=True)).alias("words"))
    named = named.where(F.size("words") >= words).join(asked, "item", "left_semi")
    named = staged(named.select("item", F.expr(exact_shingles(words)).alias("wanted")), "wanted")
    # a null-safe key, as ids may be null
    key = [docs["doc"].eqNullSafe(found["doc"]), docs["mark"] == found["mark"]]
    texts = docs.join(F.broadcast(found) if found.count() <= 1_000_000 else found, key, "left_semi").distinct()
    texts = texts.select("doc", "mark", F.expr(words_sql("text", lower=True)).alias("words"))
    texts = texts.select("doc", "mark", F.expr(exact_shingles(words)).alias("held"))
    pairs = pairs.withColumnsRenamed({"doc": "d", "mark": "m"})
    both = texts.join(pairs, [texts["doc"].eqNullSafe(pairs["d"]), texts["mark"] == pairs["m"]])
    both = lookup(both, named, ["item"], named.count(), "inner")
    n, hits = F.size("wanted"), F.size(F.array_intersect("wanted", "held"))
    out = both.select("doc", "mark", "item", n.cast("long").alias("n_shingles"), hits.cast("long").alias("n_found"))
    out = out.where(F.col("n_found") >= F.ceil(F.col("n_shingles") * share - 1e-9)).distinct()
    return out.withColumnsRenamed({"doc": "doc_id", "item": "item_id"})


def decontaminated(docs: DataFrame, items: DataFrame, words: int = WORDS, share: float = SHARE) -> DataFrame:
    """The documents, all columns, that hold no item."""
    found = staged(contained(docs, items, words, share).select("doc_id", "mark").distinct(), "contaminated")
    ident, mark = free_names(docs.columns, "_doc", "_mark")
    found = found.toDF(ident, mark)
    if found.count() <= 1_000_000:
        found = F.broadcast(found)
    return docs.join(found, docs["doc_id"].eqNullSafe(F.col(ident)) & (F.xxhash64(docs["text"]) == F.col(mark)), "left_anti")
