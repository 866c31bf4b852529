"""Reading and writing: transactions, items, datasets, submissions and reports."""

from __future__ import annotations

import gc
import json
import tempfile
from concurrent.futures import ThreadPoolExecutor
from uuid import uuid4

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def load_data(spark: SparkSession, transactions_path: str, items_path: str) -> tuple[DataFrame, DataFrame]:
    """Transactions with date, month and year, and items; prices as doubles."""
    tx = spark.read.parquet(transactions_path)
    tx = with_calendar(tx).withColumns({c: F.col(c).cast("double") for c in ("price", "discount")})
    items = spark.read.parquet(items_path)
    return tx, items.withColumn("price", F.col("price").cast("double"))


def with_calendar(tx: DataFrame) -> DataFrame:
    when = F.col("updated_date")
    return tx.withColumns({"date": F.to_date(when), "month": F.month(when), "year": F.year(when)})


def print_schema(tx: DataFrame, items: DataFrame) -> None:
    tx.printSchema()
    items.printSchema()


def require_unique_items(items: DataFrame) -> DataFrame:
    """``items`` as given; fails if an item has two rows, which would multiply joins."""
    twice = items.groupBy("item_id").count().where("count > 1").limit(1).collect()
    if twice:
        raise ValueError(f"item_id is not unique: {twice[0]['item_id']!r}")
    return items


def scan_dataset(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet dataset at ``path``; where ``x_chunks`` is absent, ``x.parquet`` beside it.

    Paths are looked up through Hadoop, so any store that Spark reads will do.
    """
    if not path_exists(spark, path) and path.rstrip("/").endswith("_chunks"):
        path = path.rstrip("/").removesuffix("_chunks") + ".parquet"
    return spark.read.parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def remove_path(spark: SparkSession, path: str) -> bool:
    """Delete a path if it exists."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def cleanup_paths(spark: SparkSession, paths: list[str]) -> int:
    """Delete those of ``paths`` that exist; returns their number."""
    return sum(remove_path(spark, p) for p in paths)


def sink_dataset(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` as one Parquet dataset and return it read back, its lineage cut."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def scratch_folder(spark: SparkSession) -> str:
    """This application's folder for tables between steps, deleted when it ends.

    It lies in the shared folder that the session names in spark.checkpoint.dir.
    Only a local master may go without one and gets a temporary folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        shared = _local.setdefault(spark.sparkContext.applicationId, "") or tempfile.mkdtemp(prefix="scratch-")
        _local[spark.sparkContext.applicationId] = shared
    path = f"{shared.rstrip('/')}/{spark.sparkContext.applicationId}-tables"
    if path not in _leaving:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        store = where.getFileSystem(spark._jsc.hadoopConfiguration())
        store.mkdirs(where)
        store.deleteOnExit(where)
        _leaving.add(path)
    return path


_local: dict[str, str] = {}
_leaving: set[str] = set()


def materialise(df: DataFrame, partition_by: tuple[str, ...] = (), codec: str = "snappy", file_rows: int = 0) -> DataFrame:
    """Write ``df`` as Parquet in the shared scratch folder and return it read back.

    Lineage ends there: executors may be lost, later steps read only the columns
    that they need, and sizes are known to the planner. ``file_rows``, if given, is
    the most rows of a file.
    """
    path = f"{scratch_folder(df.sparkSession)}/{uuid4().hex}"
    df.write.partitionBy(*partition_by).option("maxRecordsPerFile", file_rows).parquet(path, compression=codec)
    out = df.sparkSession.read.schema(df.schema).parquet(path).select(*[f"`{c}`" for c in df.columns])
    out.scratch_path = path
    return out


def materialise_dealt(df: DataFrame, key: str, n: int, lies: bool = False) -> DataFrame:
    """Like :func:`materialise`, dealt by ``key`` to ``n`` buckets: what is grouped or joined by it, or by
    it and more, is dealt no more. ``lies``: so do the rows of ``df`` already."""
    name = f"dealt_{uuid4().hex}"
    path = f"{scratch_folder(df.sparkSession)}/{name}"
    (df if lies else df.repartition(n, key)).write.bucketBy(n, key).options(path=path, compression="zstd").saveAsTable(name, format="parquet")
    out = df.sparkSession.table(name)
    out.scratch_path, out.scratch_table = path, name
    return out


def materialise_all(tables: dict[str, DataFrame], at_once: int = 4) -> dict[str, DataFrame]:
    """Each of ``tables`` written and read back, several at the same time."""
    with ThreadPoolExecutor(at_once) as pool:
        return dict(zip(tables, pool.map(lambda df: inheritable_thread_target(df.sparkSession)(materialise)(df), tables.values())))


def file_sizes(spark: SparkSession, path: str) -> dict[str, int]:
    """Bytes of each data file in a folder."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = where.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(where)
    return {s.getPath().toString(): s.getLen() for s in found if s.getPath().getName().startswith("part-")}


def discard(*tables: DataFrame) -> None:
    """Delete what :func:`materialise` wrote for ``tables``: nothing may read them any more."""
    for df in tables:
        if hasattr(df, "scratch_table"):
            df.sparkSession.sql(f"DROP TABLE IF EXISTS {df.scratch_table}")
        remove_path(df.sparkSession, df.scratch_path)


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of plans that nothing holds any more.

    It does so when the driver's garbage is collected.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def count_rows(spark: SparkSession, path: str) -> int:
    """Rows of a dataset, from the files' footers."""
    return spark.read.parquet(path).count()


def write_csv(df: DataFrame, path: str) -> None:
    """A small report as one CSV file with a header."""
    df.coalesce(1).write.mode("overwrite").csv(path, header=True)


def save_submission(submission: DataFrame, path: str) -> None:
    """customer_id and its ordered array of items."""
    submission.select(F.col("customer_id").cast("int"), F.col("items").cast("array<string>")).write.mode("overwrite").parquet(path)


def load_submission(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).select("customer_id", "items")


def export_lists(submission: DataFrame, path: str) -> None:
    """The lists as JSON lines, one small object a customer, for programs without Parquet."""
    submission.select(F.col("customer_id").cast("int"), F.col("items").cast("array<string>")).write.mode("overwrite").json(path)


def import_lists(spark: SparkSession, path: str) -> DataFrame:
    """Lists that :func:`export_lists` or another program wrote as JSON lines."""
    return spark.read.schema("customer_id int, items array<string>").json(path)


def export_dict(submission: DataFrame, path: str, most: int = 20_000_000) -> int:
    """The lists as one JSON object of customer to items, written row by row.

    For programs that read a dictionary: a local file on the driver, which holds one
    partition of lists at a time; fails beyond ``most`` customers. Returns their number.
    """
    rows = submission.select(F.col("customer_id").cast("int"), F.col("items").cast("array<string>"))
    count = rows.count()
    if count > most:
        raise ValueError(f"{count} lists are too many for one file")
    with open(path, "w", encoding="utf-8") as out:
        out.write("{")
        for k, r in enumerate(rows.toLocalIterator()):
            out.write(f"{', ' if k else ''}{json.dumps(str(r['customer_id']))}: {json.dumps(r['items'])}")
        out.write("}")
    return count


def import_dict(spark: SparkSession, path: str) -> DataFrame:
    """Lists from a JSON object of customer to items on the driver."""
    with open(path, encoding="utf-8") as file:
        found = json.load(file)
    return spark.createDataFrame([(int(c), [str(i) for i in items]) for c, items in found.items()], "customer_id int, items array<string>")


# The supplied benchmark tables as transactions and items.


def benchmark_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount")
    order = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_custkey", "o_orderdate")
    supplier = spark.read.parquet(f"{sf_dir}/supplier.parquet").select("s_suppkey", "s_nationkey")
    joined = line.join(order, line.l_orderkey == order.o_orderkey).join(supplier, line.l_suppkey == supplier.s_suppkey)
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    tx = joined.select(
        F.col("o_custkey").cast("int").alias("customer_id"),
        F.col("l_partkey").cast("string").alias("item_id"),
        F.col("l_orderkey").alias("bill_id"),
        F.col("o_orderdate").alias("updated_date"),
        F.col("l_quantity").cast("long").alias("quantity"),
        price.alias("price"),
        (price * F.col("l_discount").cast("decimal(4,2)")).alias("discount"),
        F.nullif(F.col("s_nationkey"), F.lit(24)).cast("int").alias("location"),
    )
    return with_calendar(tx)


def benchmark_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    word = lambda n: F.split_part("p_name", F.lit(" "), F.lit(n))
    return part.select(
        F.col("p_partkey").cast("string").alias("item_id"),
        F.col("p_retailprice").cast("decimal(12,2)").alias("price"),
        F.col("p_type").alias("category_l1"),
        word(2).alias("category_l2"),
        word(1).alias("category_l3"),
        F.col("p_name").alias("category"),
        F.when(F.col("p_partkey") % 17 != 0, F.col("p_brand")).alias("brand"),
        F.concat(F.lit("Mfr#"), (F.substring("p_brand", 7, 10).cast("int") % 5).cast("string")).alias("manufacturer"),
        (F.col("p_partkey") % 3).cast("int").alias("sale_status"),
        F.col("p_size").cast("string").alias("size"),
    )
