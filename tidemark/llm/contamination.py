"""Benchmark decontamination by size-partitioned MinHash containment (native).

Containment of an item in a document is the share of the item's distinct
five-word shingles that the document holds. Items are partitioned by the
number of their shingles into classes [8*4^k, 8*4^(k+1)); for each class every
document is cut into blocks of the class's upper bound, and a block's
signature is its bottom-s MinHash sketch (the s smallest distinct shingle hashes).
A short item is thereby met by blocks of its own size however long the
document is, instead of by one signature of the whole document in which it
would drown. Item and block are a candidate when their sketches share a hash;
candidates are verified by exact shingle containment in the whole document.

With sketch share f of a block, an item of q shingles at containment t is
missed with probability (1-f)^(t*q): below 2e-4 at q = 8, below 1e-5 from
q = 11 up (f = 3/4 in the lowest class, 3/8 above it). Items of fewer than
eight shingles are compared by all hashes (f = 1), so none of them is missed.

Words are runs of letters and digits in lower case; an item or document of
fewer than five words has no shingle and matches nothing. Null texts match
nothing. Documents are verified by text, so repeated rows, repeated ids and
null ids each get the result of their text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bound, col, packed, unpacked, written

SHINGLE = 5
THRESHOLD = 0.8


def words(text: Column) -> Column:
    """Lower-case words; empty array for null."""
    parts = F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+", -1), lambda w: w != "")
    return F.coalesce(parts, F.array().cast("array<string>"))


def _shingles(words_: Column, n: int, one) -> Column:
    """``one`` applied to the n words of every shingle, in order.

    Words are taken by index: ``slice`` copies the whole array on every call.
    """
    none = F.array().cast("array<int>")
    starts = lambda w: F.when(F.size(w) >= n, F.sequence(F.lit(0), F.size(w) - n)).otherwise(none)
    return bound(words_, lambda w: F.transform(starts(w), lambda i: one(*[F.get(w, i + k) for k in range(n)])))


def shingle_hashes(words_: Column, n: int = SHINGLE) -> Column:
    return _shingles(words_, n, F.xxhash64)


def shingle_set(words_: Column, n: int = SHINGLE) -> Column:
    return F.array_distinct(_shingles(words_, n, lambda *w: F.concat_ws(" ", *w)))


def _class(size: Column) -> Column:
    """0 below 8 shingles, then 1 + k for [8*4^k, 8*4^(k+1))."""
    k = F.floor(F.log2(size / 8.0) / 2 + 1e-12).cast("int")
    return F.when(size < 8, F.lit(0)).otherwise(k + 1)


def _block(cls: int) -> tuple[int, int]:
    """(block length, sketch length) in shingles for a class."""
    if cls == 0:
        return 32, 32
    length = 8 * 4**cls
    return length, length * 3 // 4 if cls == 1 else length * 3 // 8


def item_sketches(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """``(item_id, item_key, shingles, cls, hashes)`` for items that have a shingle."""
    w = items.select(col(item_id).alias("item_id"), text_key(col(text)).alias("item_key"), words(col(text)).alias("w"))
    w = w.select("item_id", "item_key", shingle_set(F.col("w")).alias("shingles"), F.sort_array(F.array_distinct(shingle_hashes(F.col("w")))).alias("hashes"))
    return w.filter(F.size("shingles") > 0).select("item_id", "item_key", "shingles", _class(F.size("shingles")).alias("cls"), "hashes")


def contained_items(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """``(text_key, item_id, n_item_shingles, n_shared, containment)``.

    ``text_key`` is ``text_key(text)`` of a document; one row per different
    text and item row at or above ``threshold``. Item sketches join the block
    sketches on the hash; AQE broadcasts the item side only while it is below
    the session's broadcast threshold. Only the candidates' texts are shuffled
    with their pairs for verification.
    """
    sketches = item_sketches(items, item_id, item_text)
    classes = sorted(
        r["cls"] for r in sketches.select("cls").distinct().collect()
    )  # about log4 of the longest item
    base = docs.select(col(text).alias("text")).filter(F.col("text").isNotNull())

    def signature(h: Column, cls: int) -> Column:
        length, keep = _block(cls)
        starts = F.sequence(F.lit(0), F.floor((F.size(h) - 1) / length).cast("int"))
        last = lambda j: F.least((j + 1) * length, F.size(h)) - 1
        cut = F.transform(starts, lambda j: F.transform(F.sequence(j * length, last(j)), lambda i: F.get(h, i)))
        if keep < length:  # a block of fewer distinct shingles than its class keeps the same share of them
            least = lambda d: F.slice(d, 1, F.ceil(F.size(d) * (keep / length)).cast("int"))
            cut = F.transform(cut, lambda x: bound(F.sort_array(F.array_distinct(x)), least))
        return F.transform(F.array_distinct(F.flatten(cut)), lambda x: F.struct(F.lit(cls).alias("cls"), x.alias("hash")))

    def signatures(h: Column) -> Column:
        every = F.concat(*[signature(h, c) for c in classes or [0]])
        return F.when(F.size(h) > 0, every)

    # explode_outer: with explode, Catalyst infers a filter below that computes the shingles twice
    blocks = base.select(text_key(F.col("text")).alias("text_key"), F.explode_outer(bound(shingle_hashes(words(F.col("text"))), signatures)).alias("s"))
    blocks = blocks.select("text_key", "s.cls", "s.hash")
    item_side = sketches.dropDuplicates(["item_key"]).select("item_key", "cls", F.explode_outer("hashes").alias("hash"))
    # written: the pairs are used twice below, the search behind them reads every text
    pairs = written(blocks.join(item_side, ["cls", "hash"]).select("text_key", "item_key").distinct(), "leak-pairs")
    full = pairs.join(sketches.select("item_key", "item_id", "shingles"), "item_key")
    # each different text once (combined before the shuffle), then only the candidates, before the pairs multiply them.
    # Candidates grow with the documents, so the join is a merge join at every size.
    texts = base.groupBy(text_key(F.col("text")).alias("text_key")).agg(F.first("text").alias("text"))
    texts = texts.join(pairs.select("text_key").distinct().hint("merge"), "text_key", "left_semi")
    texts = texts.select("text_key", shingle_set(words(F.col("text"))).alias("doc_shingles"))
    checked = full.join(texts, "text_key").select(
        "text_key",
        "item_id",
        F.size("shingles").cast("long").alias("n_item_shingles"),
        F.size(F.array_intersect("shingles", "doc_shingles")).cast("long").alias("n_shared"),
    )
    checked = checked.withColumn("containment", F.col("n_shared") / F.col("n_item_shingles"))
    return checked.filter(F.col("containment") >= threshold)


def text_key(text: Column) -> Column:
    return F.md5(text.cast("binary"))


def contaminated_documents(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per document row and item that it contains."""
    hits = contained_items(docs, items, text, threshold=threshold)
    ids = docs.select(col(doc_id).alias("doc_id"), text_key(col(text)).alias("text_key"))
    return ids.join(hits, "text_key").select("doc_id", "item_id", "n_item_shingles", "n_shared", "containment")


def drop_contaminated(docs: DataFrame, items: DataFrame, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The documents that contain no item; null texts stay."""
    hits = contained_items(docs, items, text, threshold=threshold).select("text_key").distinct()
    rows = docs.select(packed(docs).alias("row"), F.coalesce(text_key(col(text)), F.lit("")).alias("text_key"))
    return rows.join(hits.hint("merge"), "text_key", "left_anti").select(*unpacked(rows, "row", docs.columns))
