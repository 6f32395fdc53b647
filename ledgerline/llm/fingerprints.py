"""Document fingerprints: mergeable bottom-k sketches of shingle hashes.

A sketch is the ascending array of the ``k`` smallest distinct 64-bit hashes
of a text's word shingles. The ``k`` smallest of two sketches' union are the
sketch of both texts together, and the share of these that both sketches
hold estimates resemblance (Broder, 1997). Everything is built-in functions:
sketches are made inside one row, without exploding shingles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import let, order_key, parallelism, range_bounds, range_of, texts

SHINGLE_WORDS = 5
SKETCH_SIZE = 128


def shingle_hashes(text: Column, words: int = SHINGLE_WORDS) -> Column:
    """Hashes of all shingles of ``words`` words between white space, repeats
    included; a text of fewer words is one shingle, one without words none."""
    tokens = F.filter(F.split(text, r"\s+"), lambda w: w != "")
    hashes = F.transform(tokens, lambda w: F.xxhash64(w))
    shingles = lambda h: F.transform(
        F.sequence(F.lit(0), F.size(h) - words), lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(words)]))
    none = F.array().cast("array<bigint>")
    return let(hashes, lambda h: F.when(F.size(h) >= words, shingles(h)).when(F.size(h) > 0, F.array(F.xxhash64(h))).otherwise(none))


def sketch(text: Column, words: int = SHINGLE_WORDS, k: int = SKETCH_SIZE) -> Column:
    """Bottom-k sketch of a text, ascending."""
    return F.slice(F.sort_array(F.array_distinct(shingle_hashes(text, words))), 1, k)


def merged(a: Column, b: Column, k: int = SKETCH_SIZE) -> Column:
    """The sketch of two texts together."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def _shared(a: Column, b: Column, union: Column) -> Column:
    return F.size(F.filter(F.array_intersect(a, b), lambda h: h <= F.element_at(union, -1)))


def resemblance(a: Column, b: Column, k: int = SKETCH_SIZE) -> Column:
    """Estimated share of the shingles of either text that both have; two
    texts without shingles resemble each other fully, one with and one
    without not at all."""
    return let(merged(a, b, k), lambda u: F.when(F.size(u) == 0, F.lit(1.0)).otherwise(_shared(a, b, u) / F.size(u)))


def distinct_count(a: Column, k: int = SKETCH_SIZE) -> Column:
    """Estimated number of distinct shingles; exact below ``k``."""
    place = (F.element_at(a, -1).cast("double") + F.lit(2.0 ** 63)) / F.lit(2.0 ** 64)
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise(F.lit(k - 1.0) / place)


def containment(like: Column, n_a: Column, n_b: Column) -> Column:
    """Estimated share of a's distinct shingles that b has, from their
    resemblance and their distinct counts (1 if a has none)."""
    shared = like * (n_a + n_b) / (F.lit(1.0) + like)
    return F.when(n_a == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), shared / n_a))


def as_text(a: Column) -> Column:
    """A sketch as a string: 16 hex digits for each hash."""
    return F.lower(F.array_join(F.transform(a, lambda h: F.lpad(F.hex(h), 16, "0")), ""))


def merge_sketches(parts: DataFrame, keys: list[str], column: str = "sketch", k: int = SKETCH_SIZE) -> DataFrame:
    """One sketch per ``keys`` from the sketches of any number of parts (null
    and empty ones add nothing). Hashes meet in a distinct and a top-k window,
    both of which reduce before they exchange, so a key may have any number
    of parts."""
    hashes = parts.select(*keys, F.explode_outer(column).alias("__h")).distinct()
    top = Window.partitionBy(*keys).orderBy(F.col("__h").asc_nulls_last())
    kept = hashes.withColumn("__n", F.row_number().over(top)).where(F.col("__n") <= k)
    return kept.groupBy(*keys).agg(F.sort_array(F.collect_list("__h")).alias(column))


def fingerprint_documents(docs: DataFrame, words: int = SHINGLE_WORDS, k: int = SKETCH_SIZE) -> DataFrame:
    """Every document's sketch, compared with that of an edited text and that
    of the next document by doc_id (after the last: the first).

    The edited text has the last floor(n_chars / 2) code points replaced by
    the first as many (or all) of the next document. Columns: doc_id, n_chars,
    edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next
    (resemblance), in_edited (containment of the document in its edited text)
    and n_shingles (estimated distinct shingles).

    A null text is empty; a null doc_id stands before all others; rows that
    repeat a doc_id follow each other by the hash of their text, so equal
    rows are each other's next. An empty table gives an empty result.

    The next document is found with ``lead`` inside ranges of doc_id. The
    first row of each range is also sent to the range before it as a
    sentinel, so no range needs another, and texts are exchanged once.
    """
    spark = docs.sparkSession
    key = order_key("doc_id")
    bounds = range_bounds(docs, key, 2 * parallelism(spark))
    n = max(1, len(bounds))
    at = F.struct(range_of(key, bounds).alias("range"), F.lit(False).alias("sentinel"))
    before = F.struct(F.pmod(range_of(key, bounds) - 1, F.lit(n)).alias("range"), F.lit(True).alias("sentinel"))
    heads = key.isin(bounds) if bounds else F.lit(False)
    rows = (texts(docs).withColumn("sketch", sketch(F.col("text"), words, k)).withColumn("key", key)
            .withColumn("tie", F.xxhash64("text"))
            .withColumn("place", F.explode(F.when(heads, F.array(at, before)).otherwise(F.array(at)))))
    rows = rows.select("doc_id", "text", "sketch", "key", "tie", "place.range", "place.sentinel")
    order = Window.partitionBy("range").orderBy("sentinel", "key", "tie")
    rows = (rows.withColumn("next", F.lead(F.struct("text", "sketch")).over(order)).where("not sentinel")
            .select("doc_id", "text", "sketch", F.col("next.text").alias("next_text"), F.col("next.sketch").alias("next_sketch")))
    half = F.floor(F.char_length("text") / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), F.char_length("text") - half),
                      F.substring(F.col("next_text"), F.lit(1), half))
    rows = rows.select("doc_id", F.char_length("text").cast("bigint").alias("n_chars"), edited.alias("edited"), "sketch", "next_sketch")
    rows = rows.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "sketch", "next_sketch",
                       sketch(F.col("edited"), words, k).alias("edited_sketch"))
    own, new = F.col("sketch"), F.col("edited_sketch")
    rows = rows.select("doc_id", "n_chars", "edited_sha256", as_text(own).alias("fingerprint"),
                       as_text(new).alias("edited_fingerprint"), resemblance(own, new, k).alias("near_edited"),
                       resemblance(own, F.col("next_sketch"), k).alias("near_next"),
                       distinct_count(own, k).alias("n_shingles"), distinct_count(new, k).alias("n_edited"))
    return rows.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next",
                       containment(F.col("near_edited"), F.col("n_shingles"), F.col("n_edited")).alias("in_edited"), "n_shingles")
