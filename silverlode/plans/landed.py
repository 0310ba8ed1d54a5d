"""Landing areas made from the plain tables, for the queries that go through bronze."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import Warehouse
from .config import Source, SourceContract

PEOPLE = SourceContract("people", ("person",), {"person": "bigint", "name": "string", "segment": "string"})
GOODS = SourceContract("goods", ("good",), {"good": "bigint", "label": "string", "size": "int"})
GOODS_SOURCE = Source("goods", "json", None, {"north": "goods/north", "south": "goods/south"})
#: Rows of a landed file.
FILE_ROWS = 2000


def land(rows: DataFrame, place: Column, line: Column, header: str | None, folder: str, name: Callable[[int], str]) -> None:
    """Lines in files of at most ``FILE_ROWS``, each with the header, under names of the landing contract."""
    spark = rows.sparkSession
    dealt = rows.select(F.floor(place / FILE_ROWS).alias("file"), F.struct(place.alias("place"), line.alias("line")).alias("r"))
    lines = F.transform(F.array_sort(F.collect_list("r")), lambda r: r["line"])
    text = F.array_join(F.concat(F.array(F.lit(header)), lines) if header else lines, "\n")
    staged = f"{folder}/.staged"
    dealt.groupBy("file").agg(text.alias("value")).select("value").write.option("maxRecordsPerFile", 1).mode("overwrite").text(staged)
    fs, at = Warehouse(spark, folder)._at(staged)
    path = spark._jvm.org.apache.hadoop.fs.Path
    parts = sorted(f.getPath().toString() for f in fs.listStatus(at) if f.getPath().getName().startswith("part-"))
    for k, part in enumerate(parts):
        fs.rename(path(part), path(f"{folder}/{name(k + 1)}"))
    fs.delete(at, True)


def _cell(c: Column) -> Column:
    """Quoted, with quotes doubled."""
    return F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))


def land_people(spark: SparkSession, sf_dir: str, folder: str) -> None:
    """CSV of customers in three kinds of file: quoted names with commas, quotes and line ends; thirty columns more, in front; and
    no identity column, a repeated name and a cell beyond the header."""
    rows = spark.read.parquet(f"{sf_dir}/customer.parquet").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("n"), F.col("c_mktsegment").alias("s"))
    key = F.col("k").cast("string")
    odd = F.when(F.col("k") % 5 == 0, F.concat("n", F.lit(', "'), "s", F.lit('"\nof '), key)).otherwise(F.col("n"))
    extra = ",".join(f"x{i}" for i in range(1, 31))
    kinds = (
        ("person,name,segment,_ingestion_order", F.concat_ws(",", key, _cell(odd), "s", key)),
        (f"{extra},_ingestion_order,segment,name,person", F.concat(F.lit("first"), F.lit("," * 29), F.lit("last,"), F.concat_ws(",", key, "s", "n", key))),
        ("name,segment,name,_ingestion_order", F.concat_ws(",", "n", "s", F.lit("again"), key, F.lit("beyond"))),
    )
    for i, (header, line) in enumerate(kinds):
        land(rows.where(F.col("k") % 3 == i), F.col("k"), line, header, folder, lambda k, i=i: f"people_2026060{i + 1}_080000_{k:03d}.csv")


def land_goods(spark: SparkSession, sf_dir: str, folder: str, day: int) -> None:
    """JSON lines of parts from two emitters: unknown fields, broken lines, blank lines, missing fields. Days share the parts."""
    rows = spark.read.parquet(f"{sf_dir}/part.parquet").select(F.col("p_partkey").alias("k"), F.col("p_name").alias("n"), F.col("p_size").alias("s")).where(F.col("k") % 2 == day % 2)
    good = F.to_json(F.struct(F.col("k").alias("good"), F.when(F.col("k") % 6 != 0, F.col("n")).alias("label"), F.col("s").alias("size"), F.when(F.col("k") % 4 == 0, F.lit("red")).alias("colour"), F.col("k").alias("_ingestion_order")))
    line = F.when(F.col("k") % 50 == 1, F.concat(F.lit('{"good": '), F.col("k").cast("string"))).when(F.col("k") % 50 == 2, F.lit("  ")).otherwise(good)
    for i, emitter in enumerate(GOODS_SOURCE.emitters):
        part = rows.where((F.col("k") % 10 < 5) == F.lit(i == 0))
        land(part, F.col("k"), line, None, f"{folder}/{GOODS_SOURCE.emitters[emitter]}", lambda k: f"goods_2026060{day}_080000_{k:03d}.json")
