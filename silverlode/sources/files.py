"""Landed files: readers with lineage and rescue, names, identity, checks."""

from __future__ import annotations

import fnmatch
import posixpath
import re
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.values import content, raw_schema
from ..plans.config import Source, SourceContract

#: <source>_<YYYYMMDD>_<HHMMSS>_<seq>.<ext>
NAME = r"^([A-Za-z][A-Za-z_]*?)_(\d{8})_(\d{6})_(\d+)\.(\w+)$"
LINEAGE = ("_ingest_ts", "_source_file", "_file_path", "_file_size", "_file_mod_ts", "_batch_date")


@dataclass(frozen=True)
class BatchName:
    """What a file name says; all null where it says nothing readable."""

    source: str | None = None
    batch_ts: datetime | None = None
    sequence: int | None = None
    extension: str | None = None

    @property
    def malformed(self) -> bool:
        return self.source is None


def parse_name(name: str | None) -> BatchName:
    """Never raises."""
    m = re.match(NAME, posixpath.basename(name or ""))
    if not m:
        return BatchName()
    try:
        return BatchName(m[1], datetime.strptime(m[2] + m[3], "%Y%m%d%H%M%S"), int(m[4]), m[5])
    except ValueError:
        return BatchName()


def name_columns(name: Column) -> dict[str, Column]:
    """``parse_name`` over a column."""
    # the pattern runs once: its groups, joined by a mark that no name holds, are taken apart again
    groups = F.split(F.regexp_replace(name, NAME, "$1\x01$2\x01$3\x01$4\x01$5"), "\x01")
    part = lambda i: F.get(groups, F.lit(i))
    ts = F.try_to_timestamp(F.concat(part(1), part(2)), F.lit("yyyyMMddHHmmss"))
    good = ts.isNotNull()
    return {"source": F.when(good, part(0)), "batch_ts": ts, "sequence": F.when(good, part(3).try_cast("int")), "extension": F.when(good, part(4))}


def batch_date(name: Column) -> Column:
    return F.try_to_date(F.regexp_extract(name, r"_(\d{8})_", 1), "yyyyMMdd")


def file_identity(path: str) -> str:
    """A path without doubled or relative parts."""
    return posixpath.normpath(re.sub(r"(?<!:)/{2,}", "/", path.strip()))


def identity_column(path: Column) -> Column:
    """``file_identity`` over a column: parts are folded from the left, so ``..`` takes back the part before it."""
    clean = F.regexp_replace(F.trim(path), r"(?<!:)/{2,}", "/")
    rooted = F.startswith(clean, F.lit("/"))
    last = lambda a: F.try_element_at(a, F.lit(-1))

    def fold(a: Column, part: Column) -> Column:
        up = (F.size(a) > 0) & (last(a) != "..")
        back = F.when(up, F.slice(a, 1, F.greatest(F.size(a) - 1, F.lit(0)))).when(rooted, a).otherwise(F.array_append(a, F.lit("..")))
        return F.when(part.isin("", "."), a).when(part == "..", back).otherwise(F.array_append(a, part))

    parts = F.array_join(F.aggregate(F.split(clean, "/"), F.array().cast("array<string>"), fold), "/")
    return F.when(rooted, F.concat(F.lit("/"), parts)).when(parts == "", ".").otherwise(parts)


def check_file(source: Source, name: str, emitter: str | None = None, size: int | None = None, known: set[str] = frozenset()) -> list[str]:
    """Issues of a landed file: its name, source, format, emitter, and whether it is empty or seen."""
    found, batch = [], parse_name(name)
    if batch.malformed:
        found.append("malformed_name")
    elif batch.source != source.name:
        found.append("wrong_source")
    if source.filename_pattern and not fnmatch.fnmatch(posixpath.basename(name), source.filename_pattern):
        found.append("pattern_mismatch")
    if batch.extension is not None and batch.extension != source.format:
        found.append("wrong_format")
    if (emitter is None) != (not source.emitters) or emitter is not None and emitter not in source.emitters:
        found.append("unknown_emitter")
    if size == 0:
        found.append("empty_file")
    if file_identity(name) in known:
        found.append("already_ingested")
    return found


def fingerprint(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """A digest of the rows whatever their order: of counts and sums of hashes, so no task sees all rows."""
    h = F.sha2(content(columns or df.columns), 256)
    part = lambda i: F.sum(F.conv(F.substring(h, 1 + 8 * i, 8), 16, 10).cast("decimal(38,0)")).cast("string")
    return df.agg(F.sha2(F.concat_ws("|", F.count(F.lit(1)).cast("string"), *(part(i) for i in range(8))), 256).alias("fingerprint"))


def with_batch_order(df: DataFrame, batch_seq: int, order: str = "_ingestion_order") -> DataFrame:
    """``_order``: the batch and the landed position in it."""
    return df.withColumn("_order", F.struct(F.lit(batch_seq).alias("batch_seq"), F.col(order).cast("bigint").alias("position")))


def _lineage(df: DataFrame) -> DataFrame:
    m = F.col("_metadata")
    return df.select(
        "*", F.current_timestamp().alias("_ingest_ts"), m["file_name"].alias("_source_file"), m["file_path"].alias("_file_path"), m["file_size"].alias("_file_size"),
        m["file_modification_time"].alias("_file_mod_ts"), batch_date(m["file_name"]).alias("_batch_date"),
    )


def _from_json(lines: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Contract columns by name; whatever else an object holds goes to ``_rescued_data``, and so does a broken line."""
    held = lines.withColumn("_m", F.from_json("value", "map<string,string>"))
    extra = F.map_filter("_m", lambda k, v: ~k.isin(*columns))
    rescued = F.when(F.col("_m").isNull(), F.to_json(F.struct(F.col("value").alias("_corrupt")))).when(F.size(extra) > 0, F.to_json(extra))
    rest = [c for c in lines.columns if c != "value"]
    return held.where(F.trim("value") != "").select(*(F.try_element_at("_m", F.lit(c)).alias(c) for c in columns), *rest, rescued.alias("_rescued_data"))


def read_json(spark: SparkSession, path: str, contract: SourceContract, streaming: bool = False) -> DataFrame:
    """JSON lines as texts, with lineage and rescue."""
    reader = spark.readStream if streaming else spark.read
    # a stream would otherwise leave out files older than a week beside the newest
    lines = _lineage(reader.format("text").option("recursiveFileLookup", "true").option("maxFileAge", "3650d").load(path))
    return _from_json(lines, (*contract.columns, "_ingestion_order"))


#: A doubled quote stands for one; a quoted cell may hold delimiters and line ends. No file is refused for its width.
_CSV = {"multiLine": "true", "escape": '"', "recursiveFileLookup": "true", "maxColumns": str(1 << 20)}


def _csv_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Every record of every file, headers included, as ``record``, with a number that grows along its file."""
    # a schema of one cell makes each longer record a misfit, which is kept whole
    rows = spark.read.format("csv").schema("_first string, _whole string").options(**_CSV, columnNameOfCorruptRecord="_whole", header="false").load(path)
    return rows.select(F.col("_metadata.file_path").alias("_hp"), F.monotonically_increasing_id().alias("at"), F.coalesce("_whole", "_first").alias("record"))


def _cell_names(cells: Column) -> Column:
    """The name of each cell of a header: as written, or ``name#position`` where blank, repeated or so written, so that none clash."""
    clean = F.transform(cells, lambda c, i: F.when(i == 0, F.regexp_replace(F.coalesce(c, F.lit("")), "^\ufeff", "")).otherwise(F.coalesce(c, F.lit(""))))

    def name(c: Column, i: Column) -> Column:
        plain = (F.array_position(clean, c) == i + 1) & (F.trim(c) != "") & ~c.rlike(r"#\d+$")
        return F.when(plain, c).otherwise(F.concat(c, F.lit("#"), (i + 1).cast("string")))

    return F.transform(clean, name)


def read_csv(spark: SparkSession, path: str | list[str], contract: SourceContract) -> DataFrame:
    """CSV with a header as texts, by name: each row is read against its own file's header, the first record of the file.

    A fixed schema would be applied by position, so a file with one more column would shift the rest.
    The files are read as wide as their widest record can be. What has no place in the contract goes to
    ``_rescued_data`` under its name: unknown columns, a name that is repeated (its first column counts),
    and cells beyond the header, as ``#position``. A column that the header lacks is null. Files are read
    once for their width and headers and once for their rows; a stream goes through ``streaming.bronze``,
    which reads each batch so.
    """
    columns = (*contract.columns, "_ingestion_order")
    records = _csv_records(spark, path)
    commas = F.length("record") - F.length(F.replace(F.col("record"), F.lit(","), F.lit("")))
    width = (records.agg(F.max(commas)).first()[0] or 0) + 1
    cells = [f"_c{i}" for i in range(width)]
    schema = ", ".join(f"{c} string" for c in cells)
    header = F.from_csv("record", schema, {"multiLine": "true", "escape": '"', "maxColumns": str(width + 1)})
    heads = records.groupBy("_hp").agg(F.min_by("record", "at").alias("record")).select("_hp", header.alias("h")).select("_hp", _cell_names(F.array(*(F.col("h")[c] for c in cells))).alias("_names"))
    rows = spark.read.format("csv").schema(schema).options(**_CSV, header="true", enforceSchema="true").load(path)
    body = _lineage(rows.withColumn("_cells", F.array(*cells)).select("_cells", "_metadata")).drop("_metadata")
    body = body.join(heads, F.col("_file_path") == F.col("_hp"), "left")
    named = F.arrays_zip(F.col("_names").alias("n"), F.col("_cells").alias("v"))
    held = body.withColumn("_m", F.map_from_entries(F.transform(named, lambda p: F.struct(p["n"], p["v"]))))
    extra = F.map_filter("_m", lambda k, v: ~k.isin(*columns) & v.isNotNull())
    return held.select(*(F.try_element_at("_m", F.lit(c)).alias(c) for c in columns), *LINEAGE, F.when(F.size(extra) > 0, F.to_json(extra)).alias("_rescued_data"))


def read_source(spark: SparkSession, root: str, source: Source, contract: SourceContract) -> DataFrame:
    """All emitters of a source as one relation."""
    out = None
    for path in source.paths.values():
        at = f"{root.rstrip('/')}/{path}"
        part = read_csv(spark, at, contract) if source.format == "csv" else read_json(spark, at, contract)
        out = part if out is None else out.unionByName(part)
    return out


def typed(spark: SparkSession, rows: list[tuple], columns: dict[str, str]) -> DataFrame:
    """A relation of landed texts from rows in memory."""
    return spark.createDataFrame(rows, raw_schema(columns))
