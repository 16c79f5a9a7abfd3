"""Benchmark decontamination: windows of benchmark words found again in documents.

The windows of all benchmark items form one hash table, which is broadcast when its
measured size allows and joined by a shuffle otherwise. Each document's windows are
hashed where the document is read; a hit of the hash is verified on the words
themselves. Only hits and one row per document go through a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vertexloom.llm.common import ascii_lower, stored

BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10
PIECES = (4_096, 64)
BROADCAST_WINDOWS = 1_000_000
BROADCAST_BYTES = 64 * 1024 * 1024


def words_of(text: Column) -> Column:
    return F.filter(F.split(ascii_lower(text), BETWEEN_WORDS), lambda w: w != "")


def with_hashes(df: DataFrame, lengths: list[int]) -> DataFrame:
    """Adds ``hashes_n`` for each n of ``lengths``: a hash for each run of n words of ``w``.

    Hashes of runs of 1, 2, 4, ... words are joined to those of the wanted length, which
    takes a few steps per word instead of one for each word of each window.
    """
    rest = 1_000_000
    columns = [*df.columns, *[f"hashes_{n}" for n in lengths]]

    def join(left: Column, right: Column, start: int) -> Column:
        return F.zip_with(left, F.slice(right, start + 1, rest), lambda a, b: F.xxhash64(a, b))

    df = df.withColumn("_p1", F.transform("w", lambda x: F.xxhash64(x)))
    run = 1
    while run * 2 <= max(lengths, default=1):
        df = df.withColumn(f"_p{run * 2}", join(F.col(f"_p{run}"), F.col(f"_p{run}"), run))
        run *= 2
    for length in lengths:
        parts = [1 << bit for bit in range(length.bit_length() - 1, -1, -1) if length >> bit & 1]
        joined, covered = F.col(f"_p{parts[0]}"), parts[0]
        for part in parts[1:]:
            joined, covered = join(joined, F.col(f"_p{part}"), covered), covered + part
        whole = F.greatest(F.size("w") - length + 1, F.lit(0))
        df = df.withColumn(f"hashes_{length}", F.slice(joined, 1, whole))
    return df.select(*columns)


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Distinct windows: ``hash``, ``length``, ``words`` and the ids of the ``items`` that hold them.

    An item of fewer than ``window`` words is one window, one without words none.
    """
    items = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), words_of(F.col("text")).alias("w")
    ).where(F.size("w") > 0)
    length = F.least(F.size("w"), F.lit(window))
    slices = F.transform(F.sequence(F.lit(1), F.size("w") - length + 1), lambda i: F.slice("w", i, length))
    found = (
        items.select("item", F.explode(slices).alias("w"))
        .groupBy("w")
        .agg(F.array_sort(F.collect_set("item")).alias("items"))
        .withColumn("length", F.size("w"))
    )
    lengths = range(1, window + 1)
    whole = F.coalesce(*[F.when(F.col("length") == n, F.get(f"hashes_{n}", F.lit(0))) for n in lengths])
    return with_hashes(found, list(lengths)).select(whole.alias("hash"), "length", F.col("w").alias("words"), "items")


def _hits(docs: DataFrame, benchmark: DataFrame, window: int, with_text: bool) -> DataFrame:
    """One row per document: ``row``, ``n_words`` and ``hits``, each with pos, end and items."""
    table = stored(benchmark_windows(benchmark, window), "windows")
    text_bytes = F.aggregate("words", F.lit(0), lambda s, w: s + F.octet_length(w))
    item_bytes = F.aggregate("items", F.lit(0), lambda s, w: s + F.octet_length(w) + 16)
    size = table.agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(text_bytes + item_bytes), F.lit(0)).alias("bytes"),
        F.collect_set("length").alias("lengths"),
    ).first()
    small = size["rows"] <= BROADCAST_WINDOWS and size["bytes"] <= BROADCAST_BYTES
    known = table.select(F.col("hash").alias("_hash"), F.col("words").alias("_words"), F.col("items").alias("_items"))

    carried = F.struct("*") if with_text else F.struct(*[docs[c] for c in docs.columns if c.lower() != "text"])
    read = docs.select(
        F.monotonically_increasing_id().alias("rid"), carried.alias("row"), words_of(F.col("text")).alias("w")
    )
    row_type = read.schema["row"].dataType.simpleString()
    # The words are cut into pieces, large ones and those into small ones, so that no step
    # takes time by the length of the document for each window. What a document carries
    # stands on a piece of its own, its marker, and not beside each of its windows.
    marker = F.struct(
        F.lit(-1).alias("base"), F.array().cast("array<string>").alias("w"), "row", F.size("w").alias("n_words")
    )

    def parts(base: Column, size_of_piece: int) -> Column:
        count = F.floor(F.greatest(F.size("w") - 1, F.lit(0)) / size_of_piece).cast("int")
        return F.transform(
            F.sequence(F.lit(0), count),
            lambda c: F.struct(
                (base + c * size_of_piece).alias("base"),
                F.slice("w", c * size_of_piece + 1, size_of_piece + window - 1).alias("w"),
                F.lit(None).cast(row_type).alias("row"),
                F.lit(None).cast("int").alias("n_words"),
            ),
        )

    large = read.select("rid", F.explode(F.concat(F.array(marker), parts(F.lit(0), PIECES[0]))).alias("p")).select("rid", "p.*")
    as_is = F.array(F.struct("base", "w", "row", "n_words"))
    cut = F.when(F.col("base") < 0, as_is).otherwise(parts(F.col("base"), PIECES[1]))
    small_ones = large.select("rid", F.explode(cut).alias("p")).select("rid", "p.*")

    # Pieces overlap, so that short windows may be found twice, which does no harm.
    lengths = sorted(size["lengths"])
    at_type = "array<struct<i:int,length:int,hash:bigint>>"

    def places(length: int) -> Column:
        at = lambda h, i: F.struct(i.alias("i"), F.lit(length).alias("length"), h.alias("hash"))
        return F.transform(f"hashes_{length}", at)

    of_marker = F.array(F.struct(F.lit(-1).alias("i"), F.lit(0).alias("length"), F.lit(None).cast("bigint").alias("hash")))
    first = F.when(F.col("base") < 0, of_marker).otherwise(F.array().cast(at_type))
    spread = with_hashes(small_ones, lengths).select(
        "rid", "base", "w", "row", "n_words", F.explode(F.concat(first, *map(places, lengths))).alias("at")
    )
    joined = spread.join(F.broadcast(known) if small else known, F.col("at.hash") == F.col("_hash"), "left")
    is_marker = F.col("base") < 0
    verified = F.col("_words").isNotNull() & (F.slice("w", F.greatest("at.i", F.lit(0)) + 1, F.col("at.length")) == F.col("_words"))
    start = F.col("base") + F.col("at.i")
    hit = F.struct(start.alias("pos"), (start + F.col("at.length")).alias("end"), F.col("_items").alias("items"))
    kept = joined.where(is_marker | verified).select("rid", "row", "n_words", F.when(~is_marker, hit).alias("hit"))
    return kept.groupBy("rid").agg(
        F.first("row", ignorenulls=True).alias("row"),
        F.max("n_words").alias("n_words"),
        F.collect_list("hit").alias("hits"),
    )


def _covered(hits: Column) -> Column:
    """Number of words inside at least one hit."""
    start = F.struct(F.lit(0).alias("covered"), F.lit(0).alias("end"))
    spans = F.array_sort(F.transform(hits, lambda h: F.struct(h["pos"].alias("pos"), h["end"].alias("end"))))
    return F.aggregate(
        spans,
        start,
        lambda a, h: F.struct(
            (a["covered"] + F.greatest(F.lit(0), h["end"] - F.greatest(h["pos"], a["end"]))).alias("covered"),
            F.greatest(a["end"], h["end"]).alias("end"),
        ),
        lambda a: a["covered"],
    )


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``row`` (the document without its text), ``n_words``, ``n_hit``, ``items``, ``hits`` of every row of ``docs``.

    A null or empty text has no words and no hits. Repeated rows are separate
    documents. With an empty benchmark, or one without words, nothing is hit. Null item
    ids count as the empty string; an item id in several rows counts once. Extra columns
    travel inside ``row``, so their names cannot clash.
    """
    return _hits(docs, benchmark, window, with_text=False).select(
        "row",
        "n_words",
        _covered(F.col("hits")).alias("n_hit"),
        F.array_sort(F.array_distinct(F.flatten(F.col("hits.items")))).alias("items"),
        F.col("hits").alias("hits"),
    )


def remove_contaminated(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, unit: str = "document"
) -> DataFrame:
    """``docs`` without what a benchmark window hits: whole documents, or the hit words (``unit="span"``).

    A removed span goes with the separators in front of its words; all else of the text stays.
    """
    if unit not in ("document", "span"):
        raise ValueError(f"unit is document or span, not {unit}")
    found = _hits(docs, benchmark, window, with_text=True)
    if unit == "document":
        return found.where(F.size("hits") == 0).select("row.*")
    text = F.coalesce(F.col("row.text"), F.lit(""))
    # A piece is a word with the separators before it, so piece i belongs to word i.
    between = r"\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F"
    pieces = F.regexp_extract_all(text, F.lit(f"[{between}]*+[^{between}]+"), F.lit(0))
    rest = F.regexp_extract(text, rf"(?<![{between}])[{between}]*+\z", 0)
    hit_words = F.array_distinct(F.flatten(F.transform("hits", lambda h: F.sequence(h["pos"], h["end"] - 1))))
    left = F.filter(F.col("pieces"), lambda p, i: ~F.array_contains(F.col("hit_words"), i))
    cut = found.select("row", "hits", pieces.alias("pieces"), rest.alias("rest"), hit_words.alias("hit_words"))
    shortened = F.concat(F.array_join(left, ""), F.col("rest"))
    return cut.select(
        F.col("row").withField("text", F.when(F.size("hits") > 0, shortened).otherwise(F.col("row.text"))).alias("row")
    ).select("row.*")
