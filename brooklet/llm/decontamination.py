"""Benchmark items inside documents, by MinHash containment search.

The words of a text are its maximal runs of letters and digits, lower-cased; its set is
the distinct five-word shingles, or the whole sequence as one where there are fewer
words. An item leaks into a document when the document has 0.75 or more of the item's
shingles, however long the document is. Similarity of the two sets says nothing here, so
the search asks for containment. An item of one to four words is looked for among the
documents' sequences of as many words, which are made only for lengths that items have.

* Items are partitioned by size, n shingles into the part floor(log2 n). All items of a
  part have MinHash sketches of one size, the k smallest hashes of their shingles.
* k is large enough that a document with 0.75 of an item must hold at least
  k - (n - ceil(0.75 n)) of its sketch, by counting; larger parts ask for more hits, so
  a chance hit does not make a candidate. The documents' shingles, whole texts, are
  looked up among the sketches, which are small, and never shuffled.
* Candidates are verified by the exact count of the item's shingles in the document.

Everything is DataFrame expressions; shingles are 64-bit hashes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brooklet.llm.common import columns, written

WORDS = 5
TOKENS = "filter(split(lower(coalesce(text, '')), '[^\\\\p{L}\\\\p{N}]+'), x -> x <> '')"
#: Containment in hundredths.
CONTAINMENT = 75
#: Sketches, and whole sets, are broadcast up to this many hashes each (some 60 MB); joined by shuffle beyond.
BROADCAST_HASHES = 1_000_000


def with_grams(rows: DataFrame, words: int = WORDS) -> DataFrame:
    """``rows`` (with text) and ``grams``: the hashes of the distinct shingles of the text.

    Explode them by ``explode_outer``: ``explode`` adds a filter on their number, which
    Spark would push below and so compute the words anew for every shingle.
    """
    tokens = F.expr(TOKENS)
    at = ", ".join(f"_words[i + {k}]" if k else "_words[i]" for k in range(words))
    grams = f"""CASE WHEN size(_words) >= {words} THEN
        array_distinct(transform(sequence(0, size(_words) - {words}), i -> xxhash64({at})))
        WHEN size(_words) > 0 THEN array(xxhash64(concat_ws(' ', _words)))
        ELSE CAST(array() AS array<bigint>) END"""
    return rows.withColumn("_words", tokens).withColumn("grams", F.expr(grams)).drop("_words")


def with_document_grams(rows: DataFrame, lengths: list[int], words: int = WORDS) -> DataFrame:
    """As ``with_grams``, and the sequences of each of the ``lengths``, below ``words``, in place of a short text's one."""
    rows = with_grams(rows, words)
    if not lengths:
        return rows
    tokens = F.expr(TOKENS)
    rows = rows.withColumn("_words", tokens)
    parts = [F.when(F.size("_words") >= words, F.col("grams")).otherwise(F.array().cast("array<bigint>"))]
    for n in lengths:
        runs = f"transform(sequence(0, size(_words) - {n}), i -> xxhash64(concat_ws(' ', slice(_words, i + 1, {n}))))"
        parts.append(F.expr(f"CASE WHEN size(_words) >= {n} THEN {runs} ELSE CAST(array() AS array<bigint>) END"))
    return rows.withColumn("grams", F.array_distinct(F.concat(*parts))).drop("_words")


def short_lengths(items: DataFrame, words: int = WORDS) -> list[int]:
    """Numbers of words, from one to ``words`` - 1, that items have."""
    tokens = F.expr(TOKENS)
    sizes = items.select(F.size(tokens).alias("n")).filter(F.col("n").between(1, words - 1)).distinct()
    return sorted(row.n for row in sizes.collect())


def item_sets(items: DataFrame) -> DataFrame:
    """item_id, grams, n, need: one row per item with any word. Equal rows count once."""
    rows = items.filter("item_id IS NOT NULL").select("item_id", "text").distinct()
    sets = with_grams(rows).select("item_id", F.explode_outer("grams").alias("gram")).groupBy("item_id")
    sets = sets.agg(F.sort_array(F.collect_set("gram")).alias("grams")).filter(F.size("grams") > 0)
    n = F.size("grams")
    return sets.withColumn("n", n).withColumn("need", F.expr(f"({CONTAINMENT} * n + 99) div 100"))


def sketches(sets: DataFrame) -> DataFrame:
    """item_id, gram, hits: the sketch of every item, and how many hits make a candidate."""
    part = sets.withColumn("part", F.floor(F.log2("n")).cast("int"))
    # The largest n of a part is 2 ** (part + 1) - 1; an item may miss n - need of its shingles.
    most = f"CAST(pow(2, part + 1) - 1 AS int) * {100 - CONTAINMENT} div 100"
    k = F.expr(f"least(n, {most} + 1 + CAST(pow(2, part) AS int) div 16)")
    part = part.withColumn("k", k).withColumn("hits", F.expr("greatest(1, k - (n - need))"))
    return part.select("item_id", "hits", F.explode(F.expr("slice(grams, 1, k)")).alias("gram"))


def _bounded(hashes: DataFrame, n: int) -> DataFrame:
    """``hashes``, ``n`` rows of them, with a broadcast hint if they are few enough."""
    return F.broadcast(hashes) if n <= BROADCAST_HASHES else hashes


def leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, item_id, n_grams (of the item), n_shared, containment: one row per leak.

    A null text is an empty one and neither leaks nor is leaked into. Rows of the same
    doc_id are one document, with the shingles of all; rows without an id are left out,
    of either table. An item of fewer than five words leaks into every document that has
    these words one after another. Very long texts are looked at whole. An empty table of
    either kind gives no row. Other columns are not looked at.
    """
    sets = written(item_sets(items), "items")
    searched = written(sketches(sets), "sketches")
    lengths = short_lengths(items)
    texts = docs.filter("doc_id IS NOT NULL").select("doc_id", "text")
    grams = with_document_grams(texts, lengths).select("doc_id", F.explode_outer("grams").alias("gram"))
    hit = grams.join(_bounded(searched, searched.count()), "gram").groupBy("doc_id", "item_id", "hits")
    hit = hit.agg(F.size(F.collect_set("gram")).alias("found")).filter("found >= hits")
    candidates = written(hit.select("doc_id", "item_id"), "candidates")

    asked = written(candidates.select("doc_id").distinct(), "asked")
    few = with_document_grams(texts.join(asked, "doc_id", "left_semi"), lengths)
    few = few.select("doc_id", F.explode_outer("grams").alias("gram"))
    whole = sets.select("item_id", F.explode_outer("grams").alias("gram"))
    hashes = sets.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    shared = few.join(_bounded(whole, hashes), "gram").groupBy("doc_id", "item_id")
    shared = shared.agg(F.size(F.collect_set("gram")).alias("n_shared"))
    found = shared.join(candidates, ["doc_id", "item_id"]).join(sets.select("item_id", "n", "need"), "item_id")
    return found.filter("n_shared >= need").select(
        "doc_id",
        "item_id",
        F.col("n").cast("long").alias("n_grams"),
        F.col("n_shared").cast("long").alias("n_shared"),
        (F.col("n_shared") / F.col("n")).alias("containment"),
    )


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that no item leaks into; rows without a doc_id stay."""
    found = written(leaks(docs, items).select("doc_id").distinct(), "leaked")
    return docs.join(found, "doc_id", "left_anti").select(*columns(docs))
