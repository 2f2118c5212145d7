"""Small helpers that the operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from skygauge.session import scratch_path, shared_dir

#: Bits of a bitmap that tells which texts have no marks.
MOST_SLOTS = 1 << 26
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(column: Column) -> Column:
    """A to Z in lower case, all other letters as they are."""
    return F.translate(column, UPPER, LOWER)


def whole_text(column: str = "text") -> Column:
    """The text; a null counts as an empty one."""
    return F.coalesce(F.col(column), F.lit(""))


def whole_row(docs: DataFrame) -> Column:
    """All columns as one struct ``row``, so that none can clash with columns that an operator adds."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")


def id_remainder(column: str, divisor: int) -> Column:
    """``crc32`` of the id as text, modulo ``divisor``; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))) % F.lit(divisor)


def materialized(df: DataFrame) -> DataFrame:
    """The rows written to the folder that all executors share, so that a lost executor loses none."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows as a Parquet table in the same folder, for larger ones that are read more than once."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def maybe_among(rows: DataFrame, column: str, known: DataFrame) -> DataFrame:
    """The rows whose 64-bit hash ``column`` is one of ``known``, and a few more; nothing is shuffled.

    ``known`` is materialised and has a column of that name. Its hashes set bits of a map that every executor gets, of
    at most 2 ** 26 bits in 2 ** 20 rows of 64. With 256 bits a hash, up to 262,144 of them, one row in 256 is let
    through by chance; with a million one in 64.
    """
    slots = min(MOST_SLOTS, max(1 << 15, 1 << (256 * known.count()).bit_length()))
    word = F.expr(f"pmod(`{column}`, {slots}L) div 64").alias("__word")
    bits = materialized(known.select(word, F.expr(f"shiftleft(1L, cast(pmod(`{column}`, 64) as int))").alias("bit")).groupBy(
        "__word").agg(F.bit_or("bit").alias("__bits")))
    tested = rows.withColumn("__word", word).join(F.broadcast(bits), "__word")
    return tested.where(F.expr(f"bit_get(__bits, cast(pmod(`{column}`, 64) as int)) = 1")).drop("__word", "__bits")


def by_marks(texts: DataFrame, marks: DataFrame, key: list[str]) -> tuple[DataFrame, DataFrame]:
    """The texts that may have marks, and those that certainly have none, by a bitmap of at most 8 MB.

    ``marks`` are materialised; the last column of ``key`` is a hash.
    """
    slots = min(MOST_SLOTS, max(1 << 15, 1 << (8 * marks.count()).bit_length()))
    slot = F.pmod(key[-1], F.lit(slots)) + 1
    bucket, place = F.bitmap_bucket_number(slot), F.bitmap_bit_position(slot)
    bitmap = materialized(marks.select(bucket.alias("__bucket"), place.alias("__place")).groupBy("__bucket").agg(
        F.bitmap_construct_agg("__place").alias("__bitmap")))
    octet = F.conv(F.hex(F.substring("__bitmap", (F.col("__place") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    hit = octet.bitwiseAND(F.expr("shiftleft(1, cast(__place % 8 as int))")) != 0
    tested = texts.withColumns({"__bucket": bucket, "__place": place}).join(F.broadcast(bitmap), "__bucket", "left")
    tested = tested.withColumn("__hit", F.coalesce(hit, F.lit(False))).drop("__bucket", "__place", "__bitmap")
    return tested.where("__hit").drop("__hit"), tested.where("not __hit").drop("__hit")


def beside_marks(texts: DataFrame, marks: DataFrame, key: list[str]) -> tuple[DataFrame, DataFrame]:
    """The texts beside their marks (null for a few without), and those that certainly have none.

    The number or size of ``marks`` (as in :func:`by_marks`) may grow with the texts, so they are never broadcast:
    texts are shuffled to them and sorted, which can spill. What the bitmap rules out isn't shuffled.
    """
    maybe, free = by_marks(texts, marks, key)
    return maybe.join(marks.hint("merge"), key, "left"), free
