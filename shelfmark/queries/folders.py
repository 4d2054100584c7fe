"""Files: the tables are written in a messy format first, then read back by the readers."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from . import query, table
from .. import scratch
from ..operators import enrich
from ..sources import checks, files, quoted, sinks

_IMAGE = r"https://img\.example/\S+?full\.\S+?\.jpg"


@query("raw_line_parser", """
WITH a AS (
  SELECT o_custkey, o_orderkey, u, i FROM orders, LATERAL (VALUES
    (0, 'https://img.example/x,' || o_custkey || '/full.' || o_orderkey % 50 || '.jpg'),
    (1, 'https://img.example/x,' || o_custkey || '/full.' || (o_orderkey + 1) % 50 || '.jpg')) v(i, u)),
b AS (
  SELECT o_custkey, o_orderkey, u, i FROM orders, LATERAL (VALUES
    (0, 'https://img.example/y/full.' || o_orderkey || '.jpg'),
    (1, 'https://img.example/y/full.' || (o_orderkey + 1) || '.jpg'),
    (2, 'https://img.example/y/full.' || (o_orderkey + 2) || '.jpg')) v(i, u)
  WHERE o_orderstatus = 'F'),
d AS (SELECT 0 AS f, o_custkey, u, min(o_orderkey * 10 + i) AS spot FROM a GROUP BY ALL
      UNION ALL SELECT 1, o_custkey, u, min(o_orderkey * 10 + i) FROM b GROUP BY ALL),
best AS (SELECT o_custkey, f FROM (
  SELECT o_custkey, f, row_number() OVER (PARTITION BY o_custkey ORDER BY count(*) DESC, f) AS rn
  FROM d GROUP BY o_custkey, f) WHERE rn = 1)
SELECT CAST(o_custkey AS VARCHAR) AS listing_id, u AS url,
       row_number() OVER (PARTITION BY o_custkey ORDER BY spot) AS position
FROM d JOIN best USING (o_custkey, f)""")
def raw_line_parser(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    cust, key = F.col("o_custkey").cast("string"), F.col("o_orderkey")

    def wide(n):
        return F.concat(F.lit("https://img.example/x,"), cust, F.lit("/full."),
                        (n % 50).cast("string"), F.lit(".jpg"))

    def plain(n):
        return F.concat(F.lit("https://img.example/y/full."), n.cast("string"), F.lit(".jpg"))

    first = orders.select("o_custkey", "o_orderkey", F.concat_ws(
        ",", cust, wide(key), wide(key), wide(key + 1)).alias("value"))
    noise = orders.select("o_custkey", "o_orderkey", F.concat(
        F.lit("row"), cust, F.lit(",https://img.example/z/full.1.jpg")).alias("value"))
    second = orders.filter("o_orderstatus = 'F'").select("o_custkey", "o_orderkey", F.concat_ws(
        ",", F.concat(F.lit(" https://shop.example/listing/"), cust, F.lit("/t")), plain(key),
        plain(key + 1), plain(key + 2)).alias("value"))
    folder = scratch.fresh(spark, "lines")
    for name, lines in (("a", first.union(noise)), ("b", second)):
        (lines.repartition("o_custkey").sortWithinPartitions("o_orderkey").select("value")
         .write.text(f"{folder}/{name}"))
    return files.merge_url_lines(files.read_url_lines(spark, [f"{folder}/a", f"{folder}/b"], _IMAGE))


@query("multiline_csv", """
SELECT CAST(doc_id AS VARCHAR) AS doc_id, CASE WHEN doc_id % 7 > 0 THEN lang END AS lang, text
FROM documents""")
def multiline_csv(spark, sf_dir):
    folder = scratch.fresh(spark, "csv")
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", F.when(F.col("doc_id") % 7 > 0, F.col("lang")).alias("lang"), "text")
    sinks.write_csv(docs, folder)
    return quoted.read_quoted_csv(spark, folder, ["doc_id", "lang", "text"]).select(
        "doc_id", "lang", "text")


@query("csv_any_encoding", """
SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, 'café; "' || p_name || '"' AS name FROM part""")
def csv_any_encoding(spark, sf_dir):
    folder = scratch.fresh(spark, "latin")
    rows = table(spark, sf_dir, "part").select("p_partkey", F.concat(
        F.lit('café; "'), F.col("p_name"), F.lit('"')).alias("name"))
    rows.write.option("header", True).option("encoding", "iso-8859-1").option("sep", ";").option(
        "escape", '"').csv(folder)
    return files.read_csv_any_encoding(spark, f"{folder}/*.csv", ["p_partkey", "name"],
                                       delimiter=";").select("p_partkey", "name")


@query("csv_mixed_encodings", """
SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, CASE p_partkey % 3
  WHEN 0 THEN p_name || ' naïve €' WHEN 1 THEN p_name || ' café €' ELSE p_name || ' é' || chr(129) END
  AS name FROM part""")
def csv_mixed_encodings(spark, sf_dir):
    folder = scratch.fresh(spark, "mixed")
    # Bytes 80 and 81 are written through Latin-1: the first is a sign in cp1252, the second is not.
    for rest, (encoding, tail) in enumerate([("utf-8", " naïve €"), ("iso-8859-1", " café \x80"),
                                             ("iso-8859-1", " é\x81")]):
        rows = table(spark, sf_dir, "part").where(F.col("p_partkey") % 3 == rest).select(
            "p_partkey", F.concat("p_name", F.lit(tail)).alias("name"))
        rows.write.option("header", True).option("encoding", encoding).csv(f"{folder}/{rest}")
    return files.read_csv_any_encoding(spark, f"{folder}/*/*.csv", ["p_partkey", "name"]).select(
        "p_partkey", "name")


@query("csv_drifted_union", """
SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name, c_mktsegment AS segment,
       CAST(NULL AS VARCHAR) AS nation FROM customer
UNION ALL SELECT CAST(s_suppkey AS VARCHAR), s_name, NULL, CAST(s_nationkey AS VARCHAR)
FROM supplier""")
def csv_drifted_union(spark, sf_dir):
    folder = scratch.fresh(spark, "drift")
    sinks.write_csv(table(spark, sf_dir, "customer").selectExpr(
        "c_custkey id", "c_name name", "c_mktsegment segment"), f"{folder}/a")
    sinks.write_csv(table(spark, sf_dir, "supplier").selectExpr(
        "s_name name", "s_nationkey nation", "s_suppkey id"), f"{folder}/b")
    return files.read_csv_drifted(spark, [
        (f"{folder}/a", ["id", "name", "segment"]), (f"{folder}/b", ["name", "nation", "id"])
    ]).select("id", "name", "segment", "nation")


@query("typed_csv", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders""")
def typed_csv(spark, sf_dir):
    folder = scratch.fresh(spark, "typed")
    columns = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"]
    orders = table(spark, sf_dir, "orders").select(*columns)
    sinks.write_csv(orders, folder)
    return files.read_typed_csv(spark, folder, orders.schema)


@query("state_files", """
SELECT o_custkey AS c_custkey, o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 'card' || o_orderkey END
  AS card_id FROM orders WHERE o_orderkey % 3 > 0""")
def state_files(spark, sf_dir):
    folder = scratch.fresh(spark, "state")
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey")
    key = F.col("o_orderkey").cast("string")
    orders.filter("o_orderkey % 3 = 0").select(F.to_json(F.array(key, key))).write.text(
        f"{folder}/done")
    orders.filter("o_orderkey % 2 = 0").select(F.to_json(F.create_map(key, F.concat(
        F.lit("card"), key)))).write.text(f"{folder}/cards")
    todo = orders.withColumn("listing_id", key)
    left = enrich.unfinished(todo, files.read_id_list(spark, f"{folder}/done"), "listing_id")
    carded = enrich.keep_failed(left, files.read_id_map(spark, f"{folder}/cards"), "listing_id")
    return carded.select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", "card_id")


_IMAGE_PATHS_SQL = """
p AS (SELECT DISTINCT l_suppkey, l_partkey, l_linenumber, l_orderkey FROM lineitem
      WHERE l_linenumber % 5 > 0)"""


@query("image_folders", f"""WITH {_IMAGE_PATHS_SQL}
SELECT 'S' || l_suppkey AS shop_name, CAST(l_partkey AS VARCHAR) AS listing_id,
       'root/S' || l_suppkey || '/' || l_partkey || '/image_' || l_linenumber * 6 || '_' || l_orderkey
         || '.JPG' AS path,
       row_number() OVER (PARTITION BY l_suppkey, l_partkey ORDER BY l_linenumber,
         'root/S' || l_suppkey || '/' || l_partkey || '/image_' || l_linenumber * 6 || '_'
         || l_orderkey || '.JPG') AS position FROM p""")
def image_folders(spark, sf_dir):
    def text(column):
        return F.col(column).cast("string")

    paths = table(spark, sf_dir, "lineitem").select(F.concat(
        F.lit("root/S"), text("l_suppkey"), F.lit("/"), text("l_partkey"), F.lit("/image_"),
        (F.col("l_linenumber") * 6).cast("string"), F.lit("_"), text("l_orderkey"),
        F.when(F.col("l_linenumber") % 5 > 0, ".JPG").otherwise(".txt")).alias("path"))
    return files.images_of_paths(paths.distinct())


@query("art_folders", """
SELECT CAST(o_custkey AS VARCHAR) AS listing_id,
       max('art/' || o_custkey || '_art.png') FILTER (o_orderkey % 3 = 0) AS front,
       max('art/' || o_custkey || '_art_back.webp') FILTER (o_orderkey % 3 = 1) AS back
FROM orders GROUP BY o_custkey HAVING count(*) FILTER (o_orderkey % 3 = 0) > 0""")
def art_folders(spark, sf_dir):
    paths = table(spark, sf_dir, "orders").select(F.concat(
        F.lit("art/"), F.col("o_custkey").cast("string"),
        F.when(F.col("o_orderkey") % 3 == 0, "_art.png").when(
            F.col("o_orderkey") % 3 == 1, "_art_back.webp").otherwise("_art.txt")).alias("path"))
    return files.art_of_paths(paths)


@query("wide_images", """
SELECT p_partkey, CASE WHEN p_size % 4 > 0 THEN p_name || 1 ELSE '' END AS image_1,
       CASE WHEN p_size % 4 > 1 THEN p_name || 2 ELSE '' END AS image_2,
       CASE WHEN p_size % 4 > 2 THEN p_name || 3 ELSE '' END AS image_3 FROM part""")
def wide_images(spark, sf_dir):
    size = (F.col("p_size") % 4).cast("int")
    images = F.transform(F.slice(F.array(*[F.lit(str(i)) for i in (1, 2, 3)]), F.lit(1), size),
                         lambda i: F.concat(F.col("p_name"), i))
    return sinks.widen(table(spark, sf_dir, "part").select("p_partkey", images.alias("images")))


@query("wide_images_gathered", """
SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN '' WHEN 1 THEN p_name WHEN 2 THEN p_name || ',' || p_type
  ELSE p_name || ',' || p_type || ',' || p_brand END AS images FROM part""")
def wide_images_gathered(spark, sf_dir):
    size = F.col("p_size") % 4
    rows = table(spark, sf_dir, "part").select(
        "p_partkey", F.when(size == 3, F.col("p_brand")).otherwise("").alias("image_10"),
        F.when(size >= 2, F.col("p_type")).alias("image_2"),
        F.when(size >= 1, F.col("p_name")).otherwise("").alias("image_1"))
    return sinks.gather(rows).withColumn("images", F.array_join("images", ","))


@query("written_by_shop", """
SELECT c_custkey, c_name, CAST(c_nationkey AS INTEGER) AS shop_name FROM customer""")
def written_by_shop(spark, sf_dir):
    folder = scratch.fresh(spark, "shops")
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_name", F.col("c_nationkey")
                                                   .alias("shop_name"))
    sinks.write_by_shop(rows, folder, "shop_name")
    return spark.read.schema(
        T.StructType([T.StructField("c_custkey", T.LongType()), T.StructField(
            "c_name", T.StringType()), T.StructField("shop_name", T.IntegerType())])
    ).parquet(folder)


@query("relational_append", """
SELECT o_orderkey, o_totalprice, o_orderkey % 3 AS chunk_no FROM orders""")
def relational_append(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_totalprice", "o_orderkey")
    path = scratch.fresh(spark, "loaded")
    name = "loaded_" + path.rsplit("-", 1)[1]
    sinks.start_table(orders.select("o_orderkey", "o_totalprice"), name, path)
    for chunk in (0, 1, 1, 2):      # the load of chunk 1 is taken for failed and comes twice
        sinks.append_chunk(orders.where(F.col("o_orderkey") % 3 == chunk), name, chunk)
    loaded = spark.table(name).select("o_orderkey", "o_totalprice", sinks.CHUNK)
    spark.sql(f"DROP TABLE {name}")    # the files stay at the path
    return spark.read.schema(loaded.schema).parquet(path)


@query("column_aliases", """
SELECT c_custkey AS id, c_name AS title FROM customer
UNION ALL SELECT s_suppkey, s_name FROM supplier""")
def column_aliases(spark, sf_dir):
    named = {"customer": {"c_custkey": "Listing_ID", "c_name": "product"},
             "supplier": {"s_suppkey": "listing_id", "s_name": "Product Name"}}
    frames = [table(spark, sf_dir, t).select(*[F.col(c).alias(a) for c, a in names.items()])
              for t, names in named.items()]
    found = [frame.select(
        F.col(checks.column_ignoring_case(frame, "listing_id")).alias("id"),
        F.col(f"`{checks.first_present(frame, ['title', 'Product Name', 'product'], True)}`").alias("title"))
        for frame in frames]
    return found[0].unionByName(found[1])
