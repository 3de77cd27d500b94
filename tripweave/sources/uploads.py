"""CSV upload scan with row numbers per file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F

from tripweave.functions.once import with_computed
from tripweave.schemas import UPLOAD
from tripweave.sources import files

BYTE_ORDER_MARK = "\ufeff"
# A comma and the field behind it: in quotes, a quote inside being doubled, or plain.
CSV_FIELD = r',("(?:[^"]++|"")*+"|[^,]*)'


def upload_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per file, header-only and empty files included; contents are not read."""
    return (
        spark.read.format("binaryFile")
        .load(path)
        .select(F.col("_metadata.file_path").alias("upload_file"))
    )


def read_uploads(
    spark: SparkSession, path: str, multi_line: bool = False
) -> DataFrame:
    """Upload rows as text, numbered from 1 inside each file.

    Each file has its own header: columns go by its names, in any order, others are left
    out, a missing one reads as NULL; so does an empty field without quotes. Blank lines do
    not count. Files are split over tasks. With ``multi_line`` quoted fields may hold line
    breaks; a header may not. A file that ends inside quotes has its rest as one last row.
    """
    records = _whole_records(spark, path) if multi_line else _line_records(spark, path)
    names = F.transform(
        _fields(F.ltrim(F.col("header"), F.lit(BYTE_ORDER_MARK))), lambda name: F.trim(name)
    )
    rows = with_computed(
        records.where("record > 1"), {"fields": _fields(F.col("line")), "names": names}
    )
    named = [
        F.get("fields", (F.array_position("names", name) - 1).cast("int")).alias(name)
        for name in UPLOAD.names
    ]
    return rows.select(*named, "upload_file", (F.col("record") - 1).alias("row_number"))


BLOCK = ["upload_file", "block_start"]
#: Rows for blocks that may be broadcast: each a path, a header and a few numbers, some 20 MB.
MOST_BLOCKS = 100_000


def _with_blocks(spark: SparkSession, path: str, lines: DataFrame, blocks: DataFrame) -> DataFrame:
    """Lines with what is known of their blocks. How many blocks there can be follows from the
    files' sizes; if they are few, lines stay where they were read."""
    conf = spark._jsparkSession.sessionState().conf()
    least = min(conf.filesMaxPartitionBytes(), conf.filesOpenCostInBytes())
    count, size = files.extent(spark, path)
    few = count + size // max(least, 1) <= MOST_BLOCKS
    return lines.join(F.broadcast(blocks) if few else blocks, BLOCK)


def _earlier_blocks() -> WindowSpec:
    """The blocks of a file before one: windows over one row for each block."""
    return (
        Window.partitionBy("upload_file")
        .orderBy("block_start")
        .rowsBetween(Window.unboundedPreceding, -1)
    )


def _first_line() -> list[Column]:
    """A block's first line that is not blank. The set beside it has Spark aggregate by hash,
    which a text alone in the buffer would turn into a sort of all lines."""
    return [
        F.min_by("line", "position").alias("first_line"),
        F.collect_set(F.lit(True)).alias("by_hash"),
    ]


def _file_header() -> Column:
    blocks = Window.partitionBy("upload_file").orderBy("block_start")
    return F.first("first_line", ignorenulls=True).over(
        blocks.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )


def _line_records(spark: SparkSession, path: str) -> DataFrame:
    """``upload_file, record, line, header``: each line that is not blank is a record.

    Record number = lines in earlier blocks of the file + place inside the block. Two passes
    over the files and no sort: the first gives a row for each block, with the file's header.
    Positions rise by one inside a block, because one task reads the whole block.
    """
    filled = spark.read.text(path).where(F.trim("value") != "").select(
        F.col("value").alias("line"), *_place(), F.monotonically_increasing_id().alias("position")
    )
    blocks = filled.groupBy(*BLOCK).agg(
        F.count(F.lit(1)).alias("lines"), F.min("position").alias("begin"), *_first_line()
    )
    before = F.coalesce(F.sum("lines").over(_earlier_blocks()), F.lit(0))
    blocks = blocks.select(*BLOCK, "begin", before.alias("before"), _file_header().alias("header"))
    number = F.col("before") + F.col("position") - F.col("begin") + 1
    return _with_blocks(spark, path, filled, blocks).select(
        "upload_file", number.alias("record"), "line", "header"
    )


def _whole_records(spark: SparkSession, path: str) -> DataFrame:
    """The same where quoted fields may hold line breaks.

    A line begins a record if the quotes before it in the file are even. Inside a block they are
    counted in order, whatever came before; a row for each block says how many quotes the block
    has, and how many records begin in it in either case, and sums over these rows say which
    case holds. A record of one line, as most are, is complete; only lines of longer records,
    also those that a block's border cuts, are gathered. No task sees more than a block.
    """
    odd = (F.length("line") - F.length(F.replace("line", F.lit('"'), F.lit("")))) % 2
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("value").alias("line"), *_place(), F.monotonically_increasing_id().alias("position")
    )
    in_order = Window.partitionBy(*BLOCK).orderBy("position")
    earlier = in_order.rowsBetween(Window.unboundedPreceding, -1)
    filled = F.trim(F.rtrim(F.col("line"), F.lit("\r"))) != ""
    lines = lines.select(
        "*", odd.alias("odd"), filled.alias("filled")
    ).withColumn("even", F.coalesce(F.sum("odd").over(earlier), F.lit(0)) % 2 == 0)
    own = lines.groupBy(*BLOCK).agg(
        F.sum("odd").alias("quotes"),
        F.count_if(F.col("even") & F.col("filled")).alias("if_even"),
        F.count_if(~F.col("even") & F.col("filled")).alias("if_odd"),
        F.min_by(F.when(F.col("filled"), F.col("line")), F.when(F.col("filled"), F.col("position"))).alias("first_line"),
    )
    quotes = F.coalesce(F.sum("quotes").over(_earlier_blocks()), F.lit(0))
    cases = own.select(
        "*", (quotes % 2 == 0).alias("from_even"), _file_header().alias("header")
    ).withColumn("begun", F.when(F.col("from_even"), F.col("if_even")).otherwise(F.col("if_odd")))
    before = F.coalesce(F.sum("begun").over(_earlier_blocks()), F.lit(0))
    blocks = cases.select(*BLOCK, "from_even", "header", before.alias("before"))
    outside = F.col("even") == F.col("from_even")
    placed = (
        _with_blocks(spark, path, lines, blocks)
        .withColumn("begins", outside & F.col("filled"))
        .where("begins or even != from_even")  # a blank line between records is none
        .withColumn("record", F.col("before") + F.count_if("begins").over(in_order))
    )
    whole = F.col("begins") & (F.col("odd") == 0)
    columns = ["upload_file", "record", "line", "header"]
    single = placed.where(whole).select(*columns)
    longer = (
        placed.where(~whole)
        .groupBy("upload_file", "record")
        .agg(
            F.array_sort(F.collect_list(F.struct("block_start", "position", "line"))).alias("parts"),
            F.first("header").alias("header"),
        )
        .withColumn("line", F.array_join(F.col("parts.line"), "\n"))
        .select(*columns)
    )
    return single.unionByName(longer).withColumns(
        {name: F.rtrim(F.col(name), F.lit("\r")) for name in ("line", "header")}
    )


def _place() -> list[Column]:
    return [
        F.col("_metadata.file_path").alias("upload_file"),
        F.col("_metadata.file_block_start").alias("block_start"),
    ]


def _fields(line: Column) -> Column:
    """The fields of a CSV line; a quoted field may hold commas and doubled quotes."""
    # With a comma before the first field too, an empty one is found like all others.
    found = F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(CSV_FIELD), F.lit(1))
    quoted = F.lit('"')

    def plain(field: Column) -> Column:
        inner = F.replace(F.substring(field, F.lit(2), F.length(field) - 2), F.lit('""'), quoted)
        whole = field.startswith('"') & field.endswith('"') & (F.length(field) > 1)
        return F.when(whole, inner).when(field != "", field)

    return F.transform(found, plain)
