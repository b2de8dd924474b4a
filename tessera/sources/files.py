"""File scans: tolerant typed CSV, text, JSON dictionary, binary blobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

CORRUPT = "_corrupt"
MARK = "\u0001end"


def parse_csv_lines(lines: DataFrame, column: str, schema: StructType, sep: str = ",") -> DataFrame:
    """One pass over CSV lines: ``lines`` plus the typed fields (NULL where
    they do not fit) and ``reason`` (NULL for a good row).

    The CSV parser itself counts the fields: a mark appended as one more
    field is found right behind the line's own. Short lines are padded with
    NULLs (as a pandas reader does); ``too_many_fields`` and ``bad_value``
    (text that does not fit its type) are the reasons."""
    n_expected = len(schema.fields)
    raw = F.col(column)
    wide = ", ".join(f"`c{i}` string" for i in range(n_expected + 1))
    cells = F.from_csv(F.concat(raw, F.lit(sep + MARK)), wide, {"sep": sep, "mode": "PERMISSIVE"})
    counted = lines.withColumn("_cells", F.array(*[cells[f"c{i}"] for i in range(n_expected + 1)]))
    n_fields = F.array_position("_cells", MARK) - 1  # -1: the mark lies beyond, so there are too many
    padded = F.concat(raw, F.repeat(F.lit(sep), F.greatest(F.lit(n_expected) - n_fields, F.lit(0)).cast("int")))
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    typed = counted.withColumn("_p", F.from_csv(padded, ddl, {"sep": sep, "mode": "PERMISSIVE"}))
    fits = F.lit(True)
    for i, f in enumerate(schema.fields):
        own = F.when(F.lit(i) < n_fields, F.trim(F.get("_cells", F.lit(i))))
        fits = fits & (F.coalesce(own, F.lit("")).eqNullSafe("") | F.col("_p")[f.name].isNotNull())
    reason = F.when(n_fields < 0, "too_many_fields").when(~fits, "bad_value")
    return typed.withColumn("reason", reason).select(
        *lines.columns, *[F.col("_p")[f.name].alias(f.name) for f in schema.fields], "reason")


def read_csv_tolerant(spark: SparkSession, path: str, schema: StructType, header: bool = True,
                      sep: str = ",") -> tuple[DataFrame, DataFrame]:
    """Typed CSV scan that never aborts on bad rows.

    Returns ``(rows, rejects)``. Rows with too few fields are padded with
    NULLs and kept; rows with too many fields or a value that does not fit
    its type go to ``rejects(raw, reason, <fields as far as they parsed>)``.
    """
    full = StructType(list(schema.fields) + [StructField(CORRUPT, StringType(), True)])
    raw = (spark.read.schema(full).option("header", header).option("sep", sep)
           .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).csv(path))
    names = [f.name for f in schema.fields]
    good = raw.where(F.col(CORRUPT).isNull()).drop(CORRUPT)
    # Keep every parsed field next to the raw line: Spark prunes columns inside
    # the CSV parser, and a row is only found faulty in the columns it parses.
    bad = raw.where(F.col(CORRUPT).isNotNull()).select(F.col(CORRUPT).alias("raw"), F.struct(*names).alias("_read"))
    again = parse_csv_lines(bad, "raw", schema, sep)
    again = again.select("raw", "reason", *[F.coalesce(F.col(n), F.col("_read")[n]).alias(n) for n in names])
    return (good.unionByName(again.where(F.col("reason").isNull()).select(*names)),
            again.where(F.col("reason").isNotNull()))


def read_text(spark: SparkSession, path: str, whole: bool = False) -> DataFrame:
    """One row per line, or one row per file with ``whole=True``."""
    return spark.read.text(path, wholetext=whole)


def read_json_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """A JSON object ``{word: [meaning, ...]}`` per file -> (word, meanings)."""
    doc = spark.read.text(path, wholetext=True)
    m = F.from_json("value", "map<string,array<string>>")
    return doc.select(F.explode(m).alias("word", "meanings"))


def read_blobs(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """Binary files as rows (path, modificationTime, length, content)."""
    r = spark.read.format("binaryFile")
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.load(path)


def read_jdbc(spark: SparkSession, url: str, table: str, **props) -> DataFrame:
    """Relational table scan; needs the database's JDBC driver on the classpath."""
    return spark.read.jdbc(url, table, properties=props)


# File signatures and extension to MIME type.
SIGNATURES = [("png", "89504E470D0A1A0A"), ("jpeg", "FFD8FF"), ("gif", "47494638")]
EXT_FORMAT = {".png": "png", ".jpg": "jpeg", ".jpeg": "jpeg", ".gif": "gif"}
MIME = {"png": "image/png", "jpeg": "image/jpeg", "gif": "image/gif"}


def sniff_format(content: Column) -> Column:
    """Image format from magic bytes, NULL when unknown."""
    hexed = F.hex(F.substring(content, 1, 8))
    out = F.lit(None).cast("string")
    for fmt, sig in reversed(SIGNATURES):
        out = F.when(hexed.startswith(sig), F.lit(fmt)).otherwise(out)
    return out


def mime_of(fmt: Column) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for kv in MIME.items() for x in kv]), fmt)
