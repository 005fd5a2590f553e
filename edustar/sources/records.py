"""CSV records across line breaks, read by many tasks.

A quoted field may hold line breaks, so a task that starts in the middle of a file cannot tell from its bytes whether
it starts inside quotes. Each physical line is therefore a function of the quote state at its start: it keeps the
state, turns it round, or ends in a known state whatever came before. These functions compose, so

1. one scan writes down the lines that change the state (few in most files) and composes them for each block of a file
   (the part of the file that one task reads);
2. a scan over the blocks of each file, one small row a block, gives every block the state it starts in. A file that
   ends inside quotes holds a cut record: reading stops with the file and the line at which the record begins;
3. files without a record across lines go to Spark's own reader, which splits them. Otherwise the lines are put in order
   within their blocks (one shuffle by block), lines that begin outside quotes begin a record, and only records of
   several lines are gathered, across blocks too.

The quoting rule is the reader's: a field that begins with a quote runs to the quote that closes it, two quotes inside
stand for one, and a quote inside a field that does not begin with one is a plain sign. Records end with LF or CR LF; line
breaks inside quotes stay as they are.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

QUOTE = '"'
_BLOCK = ["file", "block"]


class CutRecordError(ValueError):
    """A quoted field that is still open at the end of its file."""

    def __init__(self, file: str, line: int):
        super().__init__(f"the record that begins at line {line} of {file} is cut: a quoted field is never closed")
        self.file, self.line = file, line


def ends_inside(line: Column, inside: Column, delimiter: str = ",") -> Column:
    """Whether a line ends inside quotes, given whether it starts there."""
    def odd(part: Column) -> Column:
        return (F.length(part) - F.length(F.replace(part, F.lit(QUOTE), F.lit("")))) % 2 == 1
    # within quotes a delimiter is text, so a part with an even number of quotes leaves the state as it is; outside, only
    # a field that begins with a quote can open
    step = lambda state, part: F.when(state, ~odd(part)).otherwise(part.startswith(QUOTE) & odd(part))
    return F.aggregate(F.split(line, delimiter), inside, step)


def _lines(spark: SparkSession, path: str, encoding: str) -> DataFrame:
    """Every physical line with its file, block and an id that grows within the block."""
    text = F.col("value") if encoding.upper() == "UTF-8" else F.decode(F.col("value").cast("binary"), encoding)
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("id"), text.alias("line"))
    quoted = F.contains("line", F.lit(QUOTE))
    return lines.withColumns({
        "from_outside": F.when(quoted, ends_inside(F.col("line"), F.lit(False))).otherwise(False),
        "from_inside": F.when(quoted, ends_inside(F.col("line"), F.lit(True))).otherwise(True)})


def _before(df: DataFrame) -> DataFrame:
    """Adds ``known`` (the state at the line's start as far as an earlier line of its block settles it) and ``turned``
    (whether an odd number of lines since then, or since the block's start, turned the state round)."""
    order = Window.partitionBy(*_BLOCK).orderBy("id")
    so_far, earlier = order.rowsBetween(Window.unboundedPreceding, 0), order.rowsBetween(Window.unboundedPreceding, -1)
    settles = F.col("from_outside") == F.col("from_inside")
    turns = F.sum((F.col("from_outside") & ~F.col("from_inside")).cast("int"))
    return (df.withColumn("__turns", turns.over(so_far))
            .withColumns({
                "known": F.last(F.when(settles, F.col("from_outside")), ignorenulls=True).over(earlier),
                "turned": (F.coalesce(F.lag("__turns").over(order), F.lit(0))
                           - F.coalesce(F.last(F.when(settles, F.col("__turns")), ignorenulls=True).over(earlier), F.lit(0))) % 2 == 1})
            .drop("__turns"))


def _inside(known: Column, turned: Column, start: Column) -> Column:
    return F.coalesce(known, start) != turned


def _after(start: Column) -> Column:
    """The state behind a line, for a block that starts in ``start``."""
    return F.when(_inside(F.col("known"), F.col("turned"), start), F.col("from_inside")).otherwise(F.col("from_outside"))


@dataclass
class Boundaries:
    """What the first scan finds: ``blocks`` (file, block, n_lines, starts_inside), and whether any record spans lines."""
    blocks: DataFrame
    spans_lines: bool


def find_boundaries(spark: SparkSession, path: str, encoding: str, keep) -> Boundaries:
    """Scan the files under ``path`` once. ``keep(df, name)`` writes a table and reads it back."""
    lines = _lines(spark, path, encoding)
    changes = ~(~F.col("from_outside") & F.col("from_inside"))
    events = lines.where(changes).select(*_BLOCK, "id", "from_outside", "from_inside")
    ends = (_before(events).groupBy(*_BLOCK).agg(
        F.max_by(_after(F.lit(False)), "id").alias("ends_from_outside"), F.max_by(_after(F.lit(True)), "id").alias("ends_from_inside"),
        F.max(F.col("from_outside")).alias("opens")))
    counts = lines.groupBy(*_BLOCK).agg(F.count("*").alias("n_lines"))
    per_block = keep(counts.join(ends, _BLOCK, "left").select(
        *_BLOCK, "n_lines", F.coalesce("opens", F.lit(False)).alias("opens"),
        F.coalesce("ends_from_outside", F.lit(False)).alias("ends_from_outside"),
        F.coalesce("ends_from_inside", F.lit(True)).alias("ends_from_inside")), "blocks")
    # one row a block: compose along each file
    order = Window.partitionBy("file").orderBy("block")
    so_far, earlier = order.rowsBetween(Window.unboundedPreceding, 0), order.rowsBetween(Window.unboundedPreceding, -1)
    settles = F.col("ends_from_outside") == F.col("ends_from_inside")
    scanned = (per_block
               .withColumn("turns", F.sum((F.col("ends_from_outside") & ~F.col("ends_from_inside")).cast("int")).over(so_far))
               .withColumns({"known": F.last(F.when(settles, F.col("ends_from_outside")), ignorenulls=True).over(earlier),
                             "at_known": F.last(F.when(settles, F.col("turns")), ignorenulls=True).over(earlier),
                             "turns_before": F.lag("turns").over(order)})
               .withColumn("starts_inside", _inside(F.col("known"), (F.coalesce("turns_before", F.lit(0)) - F.coalesce("at_known", F.lit(0))) % 2 == 1, F.lit(False)))
               .withColumn("ends_inside", F.when(F.col("starts_inside"), F.col("ends_from_inside")).otherwise(F.col("ends_from_outside")))
               .withColumn("lines_before", F.sum("n_lines").over(so_far) - F.col("n_lines")))
    blocks = keep(scanned.select(*_BLOCK, "n_lines", "lines_before", "starts_inside", "ends_inside", "opens"), "states")
    cut = blocks.groupBy("file").agg(F.max_by("ends_inside", "block").alias("cut")).where("cut").select("file")
    first = cut.orderBy("file").first()
    if first:
        raise CutRecordError(first["file"], _last_open(lines, blocks, first["file"]))
    return Boundaries(blocks, blocks.where("opens or starts_inside").limit(1).count() > 0)


def _last_open(lines: DataFrame, blocks: DataFrame, file: str) -> int:
    """The line (from 1) at which the file's last open record begins: the last one that goes from outside to inside."""
    here = lines.where(F.col("file") == file).drop("line")
    numbered = _before(here).withColumn("n", F.row_number().over(Window.partitionBy(*_BLOCK).orderBy("id")))
    opening = numbered.join(blocks.select(*_BLOCK, "lines_before", "starts_inside"), _BLOCK).where(
        ~_inside(F.col("known"), F.col("turned"), F.col("starts_inside")) & F.col("from_outside"))
    return opening.agg(F.max(F.col("lines_before") + F.col("n"))).first()[0]


def records(spark: SparkSession, path: str, encoding: str, blocks: DataFrame) -> DataFrame:
    """Every record but each file's first (its header) as one text: (record)."""
    starts = blocks.select(*_BLOCK, "starts_inside")
    lines = _before(_lines(spark, path, encoding)).join(starts, _BLOCK)
    lines = lines.withColumn("inside", _inside(F.col("known"), F.col("turned"), F.col("starts_inside")))
    lines = lines.withColumn("open", F.when(F.col("inside"), F.col("from_inside")).otherwise(F.col("from_outside")))
    order = Window.partitionBy(*_BLOCK).orderBy("id")
    lines = lines.withColumn("number", F.sum((~F.col("inside")).cast("long")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    header = (F.col("block") == 0) & (F.col("number") == 1)
    whole = lines.where(~F.col("inside") & ~F.col("open") & ~header).select("line")
    # a record that runs on from earlier blocks is the last one that begins there
    part = lines.where((F.col("inside") | F.col("open")) & ~header)
    last = lines.groupBy(*_BLOCK).agg(F.max("number").alias("n"))
    along = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    origin = last.withColumn("origin", F.last(F.when(F.col("n") > 0, F.struct("block", "n")), ignorenulls=True).over(along)).select(*_BLOCK, "origin")
    part = part.join(origin, _BLOCK).withColumn(
        "record", F.when(F.col("number") > 0, F.struct("block", F.col("number").alias("n"))).otherwise(F.col("origin")))
    part = part.where(~((F.col("record.block") == 0) & (F.col("record.n") == 1)))
    joined = part.groupBy("file", "record").agg(F.sort_array(F.collect_list(F.struct("block", "id", "line"))).alias("lines")).select(
        F.array_join(F.col("lines.line"), "\n").alias("line"))
    record = F.when(F.endswith("line", F.lit("\r")), F.expr("left(line, length(line) - 1)")).otherwise(F.col("line"))
    return whole.unionByName(joined).select(record.alias("record")).where(F.length("record") > 0)
