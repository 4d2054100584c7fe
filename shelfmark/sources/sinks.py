"""Writers. Spark's commit protocol makes each of them all-or-nothing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import text, urls


CHUNK = "chunk_no"


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header; null is written as empty text."""
    (text.blanks_for_nulls(df).write.mode("overwrite").option("header", True)
     .option("escape", '"').csv(path))


def widen(df: DataFrame, images: str = "images", prefix: str = "image_") -> DataFrame:
    """Array column -> ``image_1`` .. ``image_N``, N being the longest list."""
    most = df.agg(F.max(F.size(images))).first()[0] or 0
    others = [c for c in df.columns if c != images]
    return df.select(*others, *[F.coalesce(F.get(images, F.lit(i)), F.lit("")).alias(
        f"{prefix}{i + 1}") for i in range(most)])


def gather(df: DataFrame, images: str = "images", prefix: str = "image_") -> DataFrame:
    """``image_1`` .. ``image_N`` -> one array column in numeric order, blanks dropped."""
    wide = sorted((c for c in df.columns if c.startswith(prefix) and c[len(prefix):].isdigit()),
                  key=lambda c: int(c[len(prefix):]))
    listed = F.filter(F.array(*[F.col(c) for c in wide]), lambda u: u != "")
    return df.select(*[c for c in df.columns if c not in wide], listed.alias(images))


def replace_table(df: DataFrame, table: str, path: str | None = None) -> None:
    """Replace a catalogue table by these rows (schema and data), at ``path`` if given."""
    writer = df.write.mode("overwrite").format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(table)


def append_table(df: DataFrame, table: str) -> None:
    df.write.mode("append").format("parquet").saveAsTable(table)


def start_table(like: DataFrame, table: str, path: str | None = None) -> None:
    """An empty catalogue table for numbered chunks with the columns of ``like``; an older one goes."""
    writer = (like.limit(0).withColumn(CHUNK, F.lit(0).cast("bigint")).write.mode("overwrite")
              .format("parquet").partitionBy(CHUNK))
    (writer.option("path", path) if path else writer).saveAsTable(table)


def append_chunk(df: DataFrame, table: str, chunk: int) -> None:
    """Append the rows of one chunk. A chunk that is appended again, after a failure or by mistake,
    replaces itself: only the partition of its number is overwritten."""
    spark = df.sparkSession
    columns = [c for c in spark.table(table).columns if c != CHUNK]
    spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION ({CHUNK} = {int(chunk)}) "
              "SELECT * FROM {rows}", rows=df.select(*columns))


def append_jdbc(df: DataFrame, url: str, table: str, replace: bool = False,
                **properties: str) -> None:
    """Rows into a relational table through a JDBC driver on the class path."""
    df.write.jdbc(url, table, mode="overwrite" if replace else "append", properties=properties)


def write_id_list(df: DataFrame, path: str, column: str = "listing_id") -> None:
    """Done ids as JSON lines: a state of any size is written in parallel."""
    df.select(column).write.mode("overwrite").json(path)


def image_files(df: DataFrame, shop: str, listing: str, position: Column, url: Column) -> DataFrame:
    """Where each image belongs: shop and listing folders and a deterministic file name."""
    return df.select(shop, listing, position.cast("bigint").alias("position"),
                     url.alias("url"), urls.saved_name(position, url).alias("file_name"))


def write_by_shop(df: DataFrame, path: str, shop: str) -> None:
    """Parquet below one folder per shop.

    Rebalanced by shop: adaptive execution splits a shop that is too large for one task and
    puts small shops together.
    """
    df.hint("rebalance", shop).write.mode("overwrite").partitionBy(shop).parquet(path)
