"""Benchmark decontamination: a hash set of test n-grams meets the word windows of the training texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import ROW_KEY, keyed, let, maybe_broadcast, words

#: n-grams (about 100 bytes each) up to which the set is broadcast. A larger set is joined by shuffle.
BROADCAST_GRAMS = 500_000


def _windows(ws: Column, size: int) -> Column:
    """(at, gram) for each run of ``size`` words, ``at`` from 1."""
    return F.when(F.size(ws) >= size, F.transform(
        F.sequence(F.lit(1), F.size(ws) - (size - 1)),
        lambda i: F.struct(i.alias("at"), F.array_join(F.slice(ws, i, F.lit(size)), " ").alias("gram")),
    )).otherwise(F.array().cast("array<struct<at:int,gram:string>>"))


def benchmark_grams(benchmark: DataFrame, item: str = "item_id", text: str = "text", size: int = 10) -> DataFrame:
    """(gram, len, items): each distinct window of the items with the sorted ids that hold it.

    An item of fewer than ``size`` words is one window. Items without words, and NULL ids, have none.
    """
    ws = benchmark.where(F.col(item).isNotNull()).select(F.col(item).cast("string").alias("item"), words(F.col(text)).alias("ws")).where(F.size("ws") > 0)
    whole = F.array(F.struct(F.lit(1).alias("at"), F.array_join("ws", " ").alias("gram")))
    grams = ws.select("item", F.explode(F.when(F.size("ws") < size, whole).otherwise(_windows(F.col("ws"), size))).alias("w"))
    return grams.groupBy(F.col("w.gram").alias("gram")).agg(F.array_sort(F.collect_set("item")).alias("items")).withColumn(
        "len", F.size(F.split("gram", " ")))


def find_hits(docs: DataFrame, grams: DataFrame, id: str = "doc_id", text: str = "text", size: int = 10,
              broadcast_grams: int = BROADCAST_GRAMS) -> DataFrame:
    """One row per contaminated row key: ``spans`` of hit words (from 1, end exclusive), ``n_hit``, ``items``.

    The window text itself is the join key, so a hash hit is verified word by word in the join.
    Only windows of lengths that the benchmark holds are looked up.
    """
    lengths = sorted({r["len"] for r in grams.select("len").distinct().limit(size).collect()})
    known = maybe_broadcast(grams, grams.count(), broadcast_grams)
    ws = keyed(docs.select(id, text), id, text).select(*ROW_KEY, words(F.col(text)).alias("ws"))
    found = F.flatten(F.array(*[_windows(F.col("ws"), n) for n in lengths])) if len(lengths) > 1 else _windows(
        F.col("ws"), lengths[0] if lengths else size)
    seen = ws.select(*ROW_KEY, F.explode(found).alias("w")).select(*ROW_KEY, "w.at", "w.gram").join(known, "gram")
    per_row = seen.groupBy(*ROW_KEY).agg(
        F.array_sort(F.collect_set(F.struct(F.col("at"), (F.col("at") + F.col("len")).alias("end")))).alias("raw"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
    # the spans are sorted by start: each begins a new one or carries the last one on
    merged = F.aggregate("raw", F.array().cast("array<struct<at:int,end:int>>"), lambda done, s: F.when(
        (F.size(done) > 0) & (F.get(done, F.size(done) - 1)["end"] >= s["at"]),
        F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(F.struct(
            F.get(done, F.size(done) - 1)["at"].alias("at"),
            F.greatest(F.get(done, F.size(done) - 1)["end"], s["end"]).alias("end")))),
    ).otherwise(F.concat(done, F.array(s))))
    spanned = per_row.select(*ROW_KEY, "items", merged.alias("spans"))
    return spanned.withColumn("n_hit", F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["at"]))


def without_spans(text: Column, spans: Column) -> Column:
    """The text without the words of ``spans`` and the separators that follow them."""
    def cut(ws, seps):
        # a text that begins with a separator begins with an empty word, which no span counts
        shift = F.when(F.get(ws, F.lit(0)) == "", 1).otherwise(0)
        return F.array_join(F.transform(ws, lambda w, i: F.when(
            F.exists(spans, lambda s: (i + 1 - shift >= s["at"]) & (i + 1 - shift < s["end"]) & (w != "")), F.lit(""),
        ).otherwise(F.concat(w, F.coalesce(F.get(seps, i), F.lit(""))))), "")

    apart = r"[^0-9A-Za-z\x{80}-\x{10FFFF}]+"
    return let(F.split(text, apart), lambda ws: let(F.regexp_extract_all(text, F.lit(apart), F.lit(0)), lambda seps: cut(ws, seps)))


def decontaminate(docs: DataFrame, benchmark: DataFrame, id: str = "doc_id", text: str = "text",
                  item: str = "item_id", item_text: str = "text", size: int = 10, remove: str = "documents") -> DataFrame:
    """``docs`` without benchmark passages, columns as given.

    ``remove``: "documents" drops every row with a hit word, "spans" cuts the hit words out of its
    text. Texts that are NULL or empty, and any text when the benchmark is empty, are clean.
    Repeated rows are judged alike. Only the row key and the spans are shuffled beside the rows.
    """
    hits = find_hits(docs, benchmark_grams(benchmark, item, item_text, size), id, text, size)
    rows = keyed(docs, id, text)
    if remove == "documents":
        return rows.join(hits.select(*ROW_KEY), ROW_KEY, "left_anti").select(*docs.columns)
    cut = rows.join(hits.select(*ROW_KEY, F.col("spans").alias("__spans")), ROW_KEY, "left")
    return cut.withColumn(text, F.when(F.col("__spans").isNull(), F.col(text)).otherwise(
        without_spans(F.col(text), F.col("__spans")))).select(*docs.columns)


def contamination(docs: DataFrame, benchmark: DataFrame, id: str = "doc_id", text: str = "text",
                  item: str = "item_id", item_text: str = "text", size: int = 10) -> DataFrame:
    """One row per row of ``docs``: id, n_words, n_hit, n_items, items, spans, contaminated.

    A word is hit when an occurring benchmark window covers it. NULL and empty texts have no
    words; an empty benchmark hits nothing; an empty table gives an empty result.
    """
    hits = find_hits(docs, benchmark_grams(benchmark, item, item_text, size), id, text, size)
    rows = keyed(docs.select(id, text), id, text).select(
        F.col(id), *ROW_KEY, F.size(words(F.col(text))).cast("bigint").alias("n_words"))
    none = F.array().cast("array<string>")
    return rows.join(hits, ROW_KEY, "left").select(
        id, "n_words", F.coalesce("n_hit", F.lit(0).cast("bigint")).alias("n_hit"),
        F.size(F.coalesce("items", none)).cast("bigint").alias("n_items"), F.coalesce("items", none).alias("items"),
        F.coalesce("spans", F.array().cast("array<struct<at:int,end:int>>")).alias("spans"),
        F.col("n_hit").isNotNull().alias("contaminated"))
