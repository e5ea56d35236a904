"""Delimited files of the lake, as lines or as tables."""

from __future__ import annotations

from pathlib import PurePosixPath

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemark.sources.fields import folded


# Charsets that ``decode`` knows without the session's legacy setting, and the bytes of a unit of
# those that are wider than a byte.
KNOWN_CHARSETS = ("US-ASCII", "ISO-8859-1", "UTF-8", "UTF-16BE", "UTF-16LE", "UTF-16", "UTF-32")
UNIT_BYTES = {"UTF-16": 2, "UTF-32": 4}
BYTE_ORDER_MARKS = {"UTF-16": {b"\xff\xfe": "LE", b"\xfe\xff": "BE"}, "UTF-32": {b"\xff\xfe\x00\x00": "LE", b"\x00\x00\xfe\xff": "BE"}}
LEGACY_CHARSETS = "spark.sql.legacy.javaCharsets"


def read_lines(spark: SparkSession, path: str, encoding: str | None = None, whole_files: bool = False, **options: str) -> DataFrame:
    """Lines of a file or folder as ``value STRING``, whatever they hold, blank ones included.

    ``options`` go to the text reader, such as ``lineSep``; without it a line ends at a line feed,
    a carriage return, or both together. ``encoding`` is any charset of the Java machine; the
    lines are cut as bytes, by the line feed in that charset, and then decoded, so large files
    stay split. Bytes that are none of its characters fail. ``UTF-16`` and ``UTF-32`` without
    a byte order take it from the mark at the beginning of the first line read, for all files.

    The bytes of a line feed may also be halves of two wider characters. Such a line is not taken
    for two: the read fails and asks for ``whole_files``, with which a task reads a file at once.
    """
    if encoding is None or encoding.upper() in ("UTF-8", "UTF8"):
        return spark.read.options(**options).text(path, wholetext=False)
    charset = _with_byte_order(spark, path, encoding.upper())
    unit = UNIT_BYTES.get(charset[:6], 1)
    separator = options.pop("lineSep", None)
    if whole_files:
        lines = _decoded(spark.read.options(**options).text(path, wholetext=True), F.col("value").cast("binary"), charset)
        text = F.regexp_replace("value", "^\ufeff", "")
        if separator is None:
            text, separator = F.regexp_replace(text, "\r\n?", "\n"), "\n"
        # A separator at the end of the file begins no line; an empty file has none.
        text = F.when(F.endswith(text, F.lit(separator)), F.substring(text, F.lit(1), F.char_length(text) - len(separator))).otherwise(F.nullif(text, F.lit("")))
        return lines.select(F.explode(F.split(text, rf"\Q{separator}\E")).alias("value"))
    if unit == 1:
        reader = spark.read.options(**options)
        rows = (reader.option("lineSep", separator) if separator else reader).option("encoding", charset).text(path)
        return _decoded(rows, F.col("value").cast("binary"), charset)
    reader = spark.read.options(**options).option("encoding", charset).option("lineSep", separator or "\n")
    rows = reader.text(path).select(F.col("value").cast("binary").alias("value"), F.col("_metadata.file_block_start").alias("start"))
    halved = F.raise_error(F.lit(f"{path}: a line feed inside two {charset} characters; read it with whole_files"))
    cut = F.when(F.pmod(F.octet_length("value"), F.lit(unit)) == 0, F.col("value")).otherwise(halved.cast("binary"))
    lines = _decoded(rows, cut, charset, "start")
    text = F.when(F.col("start") == 0, F.regexp_replace("value", "^\ufeff", "")).otherwise(F.col("value"))
    if separator is not None:
        return lines.select(text.alias("value"))
    # Carriage returns: one in front of the line feed belongs to it, others end lines too.
    return lines.select(F.explode(F.split(F.regexp_replace(text, r"\r\z", ""), "\r")).alias("value"))


def _decoded(rows: DataFrame, data: Column, charset: str, *others: str) -> DataFrame:
    """``rows`` with ``value`` decoded from ``data``."""
    spark = rows.sparkSession
    before = spark.conf.get(LEGACY_CHARSETS)
    # The charsets that are known are fixed when the columns are made.
    if charset not in KNOWN_CHARSETS:
        spark.conf.set(LEGACY_CHARSETS, "true")
    try:
        return rows.select(F.decode(data, charset).alias("value"), *others)
    finally:
        spark.conf.set(LEGACY_CHARSETS, before)


def _with_byte_order(spark: SparkSession, path: str, charset: str) -> str:
    """``charset``, with the byte order of the first line read where its name has none."""
    marks = BYTE_ORDER_MARKS.get(charset)
    if marks is None:
        return charset
    first = spark.read.text(path).select(F.col("value").cast("binary")).first()
    start = bytes(first[0]) if first else b""
    for mark in sorted(marks, key=len, reverse=True):
        if start.startswith(mark):
            return charset + marks[mark]
    raise ValueError(f"{path} begins without a byte order mark: say {charset}LE or {charset}BE")


def read_texts(spark: SparkSession, path: str, sep: str = ",", header: str | None = None, **options: str) -> DataFrame:
    """A headered CSV file as a table of texts, types left open.

    ``header`` is its first line, if it was read before; no other job reads the file.
    """
    encoding = options.get("encoding")
    header = first_line(read_lines(spark, path, encoding)) if header is None else header
    if header is None:
        return spark.createDataFrame([], "value STRING").select()
    given = {"sep": sep} | {k: v for k, v in options.items() if k != "encoding"}
    line = spark.createDataFrame([(header,)], "value STRING")
    fields = len(T.DataType.fromDDL(line.select(F.schema_of_csv(F.lit(header), given)).first()[0]).fields)
    cells = line.select(F.from_csv("value", ", ".join(f"c{i} STRING" for i in range(fields)), given).alias("cells")).first()["cells"]
    # As Spark names them: a blank name by its place, and of names that are alike all with their place.
    names = [f"_c{i}" if not name else name for i, name in enumerate(cells)]
    alike = [folded(spark, n) for n in names]
    names = [f"{n}{i}" if alike.count(folded(spark, n)) > 1 else n for i, n in enumerate(names)]
    schema = T.StructType([T.StructField(name, T.StringType()) for name in names])
    return spark.read.options(header=True, sep=sep, **options).schema(schema).csv(path)


def plain_bytes(spark: SparkSession, path: str) -> int | None:
    """Bytes of a file or folder, from the file system; None where files are compressed."""
    jvm, hadoop = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(hadoop)
    if any(codecs.getCodec(jvm.org.apache.hadoop.fs.Path(file)) for file in spark.read.text(path).inputFiles()):
        return None
    place = jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(hadoop).getContentSummary(place).getLength()


def first_line(lines: DataFrame) -> str | None:
    """The first line, from the first split; None if there is none."""
    first = lines.first()
    return None if first is None else first[0]


def strip_header(lines: DataFrame, header: str | None = None) -> DataFrame:
    """Drop every line equal to the header, wherever it stands.

    Without ``header`` the first line is taken, which reads one row of the
    first split.
    """
    if header is None:
        header = first_line(lines)
    if header is None:
        return lines
    return lines.filter(F.col("value") != header)


def read_table(
    spark: SparkSession,
    path: str,
    sep: str = ",",
    schema: T.StructType | str | None = None,
    **options: str,
) -> DataFrame:
    """A headered CSV file as a typed table.

    Types are inferred unless ``schema`` is given; inferring reads the file
    twice. ``options`` go to the CSV reader.
    """
    reader = spark.read.options(header=True, sep=sep, **options)
    if schema is not None:
        return reader.schema(schema).csv(path)
    return reader.option("inferSchema", True).csv(path)


def dataset_name(path: str) -> str:
    """Name a profile is stored under: the file name without its suffix."""
    return PurePosixPath(path).stem
