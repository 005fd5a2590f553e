"""CSV landing: read all-text files, apply the header and NULL rules, land as Parquet.

Reading rules follow the original loader: the register is Latin-1, the statistics
files UTF-8; nothing is type-inferred; a malformed row aborts the load (FAILFAST);
the reader's NULL tokens become NULL while suppression markers survive as text.

A quoted field may hold line breaks. By default a first scan finds the record boundaries in parallel (see
``records``): files without such fields are split by Spark's own reader, others are put together from their lines
by many tasks. ``multi_line=True`` leaves it to Spark's reader, one task a file; ``multi_line=False`` skips the scan
for files known to hold one record a line.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from edustar.operators.checks import metric_rows, observed
from edustar.schema import NULL_TOKENS, REGISTER_COLUMNS
from edustar.session import storage_root
from edustar.sources.manifest import current, new_version, publish
from edustar.sources.records import find_boundaries, records

_HEADER_PART = re.compile("[a-z0-9]+")
_BOMS = ("\ufeff", "\u00ef\u00bb\u00bf")  # the BOM decoded as UTF-8, and as Latin-1


def sanitise_name(name: str) -> str:
    """Header -> lowercase snake_case: its runs of ASCII letters and digits, joined by one ``_``."""
    return "_".join(_HEADER_PART.findall(name.lower()))


def strip_bom(name: str) -> str:
    """Drop a leading byte-order mark (as decoded by UTF-8 or by Latin-1).

    Under Latin-1 the BOM bytes sit in front of the opening quote, so the reader
    keeps a quoted first header verbatim (``ï»¿"URN"``); unquote it here too.
    """
    for bom in _BOMS:
        if name.startswith(bom):
            rest = name[len(bom):]
            if len(rest) >= 2 and rest[0] == rest[-1] == '"':
                rest = rest[1:-1].replace('""', '"')
            return rest
    return name


def sanitise_headers(df: DataFrame) -> DataFrame:
    """Rename every column by ``sanitise_name``; two headers that collide raise."""
    names = [sanitise_name(strip_bom(c)) for c in df.columns]
    seen: dict[str, str] = {}
    for orig, new in zip(df.columns, names):
        if new in seen:
            raise ValueError(f"headers {seen[new]!r} and {orig!r} both become {new!r}")
        seen[new] = orig
    return df.toDF(*names)


def require_columns(df: DataFrame, expected: Iterable[str]) -> DataFrame:
    """Raise before any job when the input lacks a column; every lacking one is named."""
    lacking = sorted(set(expected) - set(map(strip_bom, df.columns)))
    if lacking:
        raise ValueError("input lacks the column(s) " + ", ".join(map(repr, lacking)))
    return df


def rename_map(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Keep and rename the mapped columns, in mapping order."""
    actual = {strip_bom(c): c for c in df.columns}
    return df.select(*[F.col(f"`{actual[src]}`").alias(dst) for src, dst in mapping.items()])


def na_tokens_to_null(df: DataFrame, tokens: Iterable[str] = NULL_TOKENS) -> DataFrame:
    """Reader NULL tokens (``NA``, ``None``, ``n/a``...) -> NULL, on every column."""
    toks = list(tokens)
    return df.select(*[
        F.when(~F.col(f"`{c}`").isin(toks), F.col(f"`{c}`")).alias(c) for c in df.columns
    ])


def _reader(spark: SparkSession, encoding: str, multi_line: bool = False):
    return (spark.read.option("header", True).option("encoding", encoding)
            .option("multiLine", multi_line).option("quote", '"').option("escape", '"')
            .option("mode", "FAILFAST").option("inferSchema", False)
            # every record is parsed whole, so one that is cut or too short always aborts the read
            .option("columnPruning", False))


def _keep(spark: SparkSession, run: str):
    """Writes the boundary finder's small tables to the shared folder."""
    def keep(df: DataFrame, name: str) -> DataFrame:
        path = f"{storage_root(spark)}/csv/{run}/{name}"
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)
    return keep


def read_csv(spark: SparkSession, path: str, encoding: str, multi_line: bool | None = None) -> DataFrame:
    """Headed CSV files -> all columns as text. A record with too few or too many fields, or cut inside quotes, aborts."""
    if multi_line is not None:
        return _reader(spark, encoding, multi_line).csv(path)
    found = find_boundaries(spark, path, encoding, _keep(spark, uuid.uuid4().hex))
    if not found.spans_lines:
        return _reader(spark, encoding, False).csv(path)
    schema = _reader(spark, encoding, True).csv(path).schema  # reads the first file's header
    options = {"quote": '"', "escape": '"', "mode": "FAILFAST", "multiLine": "true", "columnPruning": "false"}
    plain = StructType([StructField(f"c{i}", StringType()) for i in range(len(schema))])
    row = F.from_csv("record", plain.simpleString()[len("struct<"):-1].replace(":", " "), options)
    return records(spark, path, encoding, found.blocks).select(row.alias("r")).select("r.*").toDF(*schema.names)


def read_register_csv(spark: SparkSession, path: str, multi_line: bool | None = None) -> DataFrame:
    """School register CSV (Latin-1) -> the 7 landed columns, all text."""
    df = read_csv(spark, path, "ISO-8859-1", multi_line)
    require_columns(df, REGISTER_COLUMNS)
    return na_tokens_to_null(rename_map(df, REGISTER_COLUMNS))


def read_ees_csv(spark: SparkSession, path: str, multi_line: bool | None = None) -> DataFrame:
    """Statistics CSV (UTF-8) -> every column, all text, headers sanitised."""
    return na_tokens_to_null(sanitise_headers(read_csv(spark, path, "UTF-8", multi_line)))


def land_raw(df: DataFrame, path: str) -> int:
    """Replace the raw table at ``path`` in full; returns its row count, taken by the write itself."""
    rows, count = observed(sanitise_headers(df), "raw")
    rows.write.mode("overwrite").parquet(path)
    return metric_rows("raw", count)[0][3]


def load_counts(metrics: DataFrame) -> DataFrame:
    """Rows per landed table, from the counts of the landing jobs: ``(table_name, n_rows)``."""
    return metrics.where((F.col("check_name") == "rows") & F.col("model").startswith("raw_")).select(
        F.col("model").alias("table_name"), F.col("failures").alias("n_rows"))


def content_digest(df: DataFrame, name: str) -> DataFrame:
    """One row (table_name, n_rows, digest): the digest does not depend on the order of rows or columns, and any changed,
    lost or repeated value changes it.

    A row's text is its columns by name, each as length, colon and value (``-`` for NULL; doubles with six decimals); the
    digest is the sum over rows of the first 60 bits of its MD5.
    """
    def text(c: str, kind: str) -> Column:
        value = F.col(f"`{c}`").cast("decimal(30,6)") if kind in ("double", "float") else F.col(f"`{c}`")
        value = value.cast("string")
        return F.coalesce(F.concat(F.length(value).cast("string"), F.lit(":"), value), F.lit("-"))
    row = F.concat(*[text(c, kind) for c, kind in sorted(df.dtypes)])
    return df.select(F.conv(F.substring(F.md5(row), 1, 15), 16, 10).cast("decimal(38,0)").alias("h")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.coalesce(F.sum("h"), F.lit(0)).cast("string").alias("digest")).select(
        F.lit(name).alias("table_name"), "n_rows", "digest")


def content_digests(tables: Mapping[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [content_digest(df, name) for name, df in tables.items()])


def export_marts(marts: Mapping[str, DataFrame], out_root: str) -> DataFrame:
    """Write a clean serving copy of each mart (lowercase names) and publish it as the current export under ``out_root``;
    returns the row count and content digest of what is read back from each."""
    spark, root, version = next(iter(marts.values())).sparkSession, out_root.rstrip("/"), new_version()
    for name, df in marts.items():
        df.toDF(*[c.lower() for c in df.columns]).write.parquet(f"{root}/versions/{version}/{name}")
    publish(spark, root, version)
    return content_digests({name: spark.read.parquet(f"{root}/versions/{version}/{name}") for name in marts})


def read_export(spark: SparkSession, out_root: str, name: str) -> DataFrame:
    """A mart of the current export."""
    root = out_root.rstrip("/")
    return spark.read.parquet(f"{root}/versions/{current(spark, root)}/{name}")


def write_csv(df: DataFrame, path: str, encoding: str = "UTF-8") -> None:
    """Write a headed CSV folder (used to round-trip landed tables through the readers)."""
    (df.write.mode("overwrite").option("header", True).option("encoding", encoding)
     .option("quote", '"').option("escape", '"').option("quoteAll", True).csv(path))
