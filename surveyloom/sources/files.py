"""CSV and Parquet in and out."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import NUMBER_TEXT, named
from ..operators.unify import unify, widest_type
from . import records


_BAD = "_bad_record"
_OPTIONS = {"quote": '"', "escape": '"', "columnNameOfCorruptRecord": _BAD, "mode": "PERMISSIVE"}
# A field put behind a faulty record's own; where it is found tells how many fields the record has.
_END = "\u0001end\u0002"


def csv_schema(spark: SparkSession, path: str, multi_line: bool = True) -> T.StructType:
    """Schema inferred by one pass; keep it and hand it to ``read_csv`` to spare later passes."""
    return read_csv(spark, path, None, multi_line).schema


def _split_csv(spark: SparkSession, path: str, schema: T.StructType | None) -> DataFrame:
    """Files without quoted line breaks, read by Spark's own reader, which takes columns by place.

    Only the header lines are looked at beforehand: those of the files' first blocks.
    """
    reader = spark.read.option("header", True).option("quote", '"').option("escape", '"')
    headers = spark.read.text(path).where("_metadata.file_block_start = 0").select(
        "value", F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("place")
    ).groupBy("file").agg(F.min_by("value", "place").alias("header")).groupBy("header").agg(
        F.sort_array(F.collect_list("file")).alias("files")
    ).collect()

    def part(files: list[str]) -> DataFrame:
        kinds = reader.option("inferSchema", schema is None).csv(files).schema
        if schema is not None:
            kinds = T.StructType([schema[f.name] if f.name in schema.names else f for f in kinds.fields])
        return reader.schema(kinds).csv(files)

    groups = sorted([unquote(name) for name in row["files"]] for row in headers)
    return unify(dict(enumerate(map(part, groups))), "outer", lead=())


def _texts_of(header: list[str], more: Sequence[str] = ()) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in [*header, *more]])


def _place_names(header: list[str]) -> list[str]:
    """Names for the columns of a header that cannot clash, whatever the header's own names are."""
    return [f"c{i}" for i in range(len(header))]


# Tests of the types a text column is taken for, narrowest first; each value of the column has to pass.
_WHOLE_TEXT = r"^[+-]?[0-9]+$"
_KINDS: list[tuple[T.DataType, Callable[[Column], Column]]] = [
    (T.IntegerType(), lambda c: c.rlike(_WHOLE_TEXT) & c.try_cast("int").isNotNull()),
    (T.LongType(), lambda c: c.rlike(_WHOLE_TEXT) & c.try_cast("bigint").isNotNull()),
    (T.DecimalType(38, 0), lambda c: c.rlike(_WHOLE_TEXT) & c.try_cast("decimal(38,0)").isNotNull()),
    (T.DoubleType(), lambda c: c.rlike(NUMBER_TEXT) | c.isin("NaN", "Inf", "-Inf")),
    (T.DateType(), lambda c: c.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$") & c.try_cast("date").isNotNull()),
    (T.TimestampType(), lambda c: c.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}") & c.try_cast("timestamp").isNotNull()),
    (T.BooleanType(), lambda c: F.lower(c).isin("true", "false")),
]


def _inferred(parsed: DataFrame, headers: list[list[str]]) -> list[list[T.DataType]]:
    """Types of the columns of every header, from one aggregate over all records."""
    tests = [
        F.bool_and(F.when(F.col(f"_p{h}")[f"c{i}"].isNotNull(), test(F.col(f"_p{h}")[f"c{i}"]))).alias(f"{h} {i} {k}")
        for h, header in enumerate(headers) for i in range(len(header)) for k, (_, test) in enumerate(_KINDS)
    ]
    row = parsed.agg(*tests).first()
    return [
        [next((kind for k, (kind, _) in enumerate(_KINDS) if row[f"{h} {i} {k}"]), T.StringType()) for i in range(len(header))]
        for h, header in enumerate(headers)
    ]


def _parsed(found: DataFrame, schemas: list[T.StructType], options: dict[str, str]) -> DataFrame:
    """Records with ``_p<h>``: the fields of those under header ``h``, null for the others."""
    columns = [
        F.when(F.col("header") == h, F.from_csv("record", kind.simpleString(), options)).alias(f"_p{h}")
        for h, kind in enumerate(schemas)
    ]
    return found.select("place", "header", "record", "closed", *columns)


class CsvFiles:
    """The files of a path under one set of columns: the rows, and the records that were not read as they stand.

    Columns go by name: files whose headers differ are read under their own headers and stacked, with null where a
    file lacks a column. Without a schema, types are inferred and widened where files differ; with one, columns it
    doesn't list are left out. Files are split among tasks also where quoted fields span lines.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType | None = None, delimiter: str = ","):
        self.spark = spark
        self.layout = records.layout(spark, path, delimiter)
        self.options = {**_OPTIONS, "sep": delimiter}
        self.found = records.records(spark, path, self.layout)
        self.headers = self.layout.headers
        if schema is None:
            texts = [_texts_of(_place_names(header)) for header in self.headers]
            self.kinds = _inferred(_parsed(self.found, texts, self.options), self.headers) if self.headers else []
            every: dict[str, list[T.DataType]] = {}
            for header, kinds in zip(self.headers, self.kinds):
                for name, kind in zip(header, kinds):
                    every.setdefault(name, []).append(kind)
            self.schema = T.StructType([T.StructField(name, widest_type(kinds)) for name, kinds in every.items()])
        else:
            self.schema = schema
            self.kinds = [
                [schema[name].dataType if name in schema.names else T.StringType() for name in header] for header in self.headers
            ]
        fields = [
            T.StructType([T.StructField(f"c{i}", kind) for i, kind in enumerate(kinds)] + [T.StructField(_BAD, T.StringType())])
            for kinds in self.kinds
        ]
        self.parsed = _parsed(self.found, fields, self.options)

    def _column(self, field: T.StructField) -> Column:
        value = None
        for h, header in enumerate(self.headers):
            if field.name in header:
                here = F.col(f"_p{h}")[f"c{header.index(field.name)}"].cast(field.dataType)
                value = here if value is None else F.when(F.col("header") == h, here).otherwise(value)
        return (F.lit(None).cast(field.dataType) if value is None else value).alias(field.name)

    def rows(self, position: str | None = None) -> DataFrame:
        """All records as rows; ``position`` names a column that orders rows as their files do, by name and line."""
        place = [F.col("place").alias(position)] if position else []
        return self.parsed.select(*place, *[self._column(field) for field in self.schema.fields])

    def rejected(self) -> DataFrame:
        """Records that ``rows`` holds in part only: ``file``, ``line``, ``reason``, ``field`` and the ``record``.

        Reasons are ``extra fields``, ``missing fields``, ``bad value`` (with the first such field) and ``open quote``.
        A record is looked at twice only if the first reading found fault with it.
        """
        bad = F.coalesce(F.lit(None).cast("string"), *[F.col(f"_p{h}")[_BAD] for h in range(len(self.headers))])
        odd = self.parsed.where(bad.isNotNull() | ~F.col("closed"))
        texts = [_texts_of(_place_names(header), ["more"]) for header in self.headers]
        ended = F.concat("record", F.lit(self.layout.delimiter + _END))
        again = odd.select("*", *[
            F.when(F.col("header") == h, F.from_csv(ended, kind.simpleString(), self.options)).alias(f"_t{h}")
            for h, kind in enumerate(texts)
        ])
        reason, field = F.lit("bad value"), F.lit(None).cast("string")
        for h, header in enumerate(self.headers):
            text, value = F.col(f"_t{h}"), F.col(f"_p{h}")
            wrong = F.lit(None).cast("string")
            for i in reversed(range(len(header))):
                here = value[f"c{i}"].isNull() & text[f"c{i}"].isNotNull() & (text[f"c{i}"] != "")
                wrong = F.when(here, F.lit(header[i])).otherwise(wrong)
            ends_early = F.lit(False)
            for i in range(len(header)):
                ends_early = ends_early | F.coalesce(text[f"c{i}"] == _END, F.lit(False))
            why = F.when(ends_early, "missing fields").when(
                F.coalesce(text["more"], F.lit("")) != _END, "extra fields"
            ).otherwise("bad value")
            reason = F.when(F.col("header") == h, why).otherwise(reason)
            field = F.when(F.col("header") == h, F.when(why == "bad value", wrong)).otherwise(field)
        reason = F.when(~F.col("closed"), "open quote").otherwise(reason)
        names = records.file_names(self.spark, self.layout)
        number = F.shiftright("place", records.LINE_BITS)
        return again.select(
            number.alias("file_number"), F.col("place").bitwiseAND(F.lit((1 << records.LINE_BITS) - 1)).alias("line"),
            reason.alias("reason"), F.when(F.col("closed"), field).alias("field"), "record",
        ).join(names, "file_number").select("file", "line", "reason", "field", "record")


def rejected_counts(rejected: DataFrame) -> DataFrame:
    """Rejected records per file, reason and field."""
    return rejected.groupBy("file", "reason", "field").agg(F.count("*").alias("n_records"))


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType | None = None, multi_line: bool = True, position: str | None = None
) -> DataFrame:
    """One edition with a header row, as one file or many; ``CsvFiles`` also tells which records are faulty.

    ``position`` names a column to add that orders rows as their files do. ``multi_line=False`` is for files without
    quoted line breaks: Spark's own reader then splits them, in one pass less, without positions.
    """
    if multi_line or position:
        return CsvFiles(spark, path, schema).rows(position)
    frame = _split_csv(spark, path, schema)
    if schema is None:
        return frame
    return frame.select(*[
        (named(f.name) if f.name in frame.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields
    ])


def write_csv(df: DataFrame, path: str) -> None:
    """Extract with a header row, without an index column. Empty texts are read back as null."""
    writer = df.write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"')
    for side in ("ignoreLeadingWhiteSpace", "ignoreTrailingWhiteSpace"):
        writer = writer.option(side, False)
    writer.csv(path)


def read_parquet(spark: SparkSession, path: str, position: str | None = None) -> DataFrame:
    """A dataset; ``position`` names a column to add that orders rows as their files do, by name and row."""
    rows = spark.read.parquet(path)
    if not position:
        return rows
    at = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    return rows.select(at.alias(position), *[named(c) for c in rows.columns])


def write_parquet(
    df: DataFrame, path: str, partition_by: str | Sequence[str] = (), rows_per_file: int = 0, whole: bool = False
) -> None:
    """Overwrite a dataset; of a partitioned one, unless ``whole``, only the partitions the frame has rows for.

    Tasks write their own rows, without a shuffle by partition value, so one year that holds
    most rows is written by many tasks.
    """
    keys = [partition_by] if isinstance(partition_by, str) else list(partition_by)
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static" if whole else "dynamic")
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    if keys:
        writer = writer.partitionBy(*keys)
    writer.parquet(path)
