"""Record patches in XML: <record id= model=> with <field> children, and <template>."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evolve.operators.ordered import Running, running

# The attributes a record and a field may carry.
_FIELDS = "_name string, _eval string, _ref string, _type string, _file string, _VALUE string"
_RECORD = f"_id string, _model string, _forcecreate string, field array<struct<{_FIELDS}>>"
_MARKUP = "field array<string>"


def parse_records(df: DataFrame, text: str, module: Column) -> DataFrame:
    """One row per field of the record held in ``text``.

    Returns (module, record_id, model, forcecreate, field, value, kind); kind is
    text, eval, ref, markup or file, whose value is the file's path. A dotted id names its own module. An eval of
    None or False stays literal; who applies the patch decides what it means.
    """
    # The record is parsed twice: as structs for attributes and text, as strings
    # for fields that hold markup, whose inner tags a struct would drop.
    parsed = df.select(
        module.alias("__module"),
        F.from_xml(F.col(text), _RECORD).alias("r"), F.from_xml(F.col(text), _MARKUP).alias("m"),
    )
    zipped = parsed.select(
        "__module", F.col("r._id").alias("__id"), F.col("r._model").alias("model"),
        F.col("r._forcecreate").alias("__force"),
        F.explode(F.arrays_zip(F.col("r.field").alias("f"), F.col("m.field").alias("markup"))).alias("z"),
    )
    f = F.col("z.f")
    dotted = F.col("__id").contains(".")
    kind = (
        F.when(f["_file"].isNotNull(), "file").when(f["_eval"].isNotNull(), "eval").when(f["_ref"].isNotNull(), "ref")
        .when(f["_type"].isin("html", "xml"), "markup").otherwise("text")
    )
    return zipped.select(
        F.when(dotted, F.substring_index("__id", ".", 1)).otherwise(F.col("__module")).alias("module"),
        F.when(dotted, F.substring_index("__id", ".", -1)).otherwise(F.col("__id")).alias("record_id"),
        "model",
        F.lower("__force").cast("boolean").alias("forcecreate"),
        f["_name"].alias("field"),
        F.when(kind == "file", f["_file"]).when(kind == "eval", f["_eval"]).when(kind == "ref", f["_ref"])
        .when(kind == "markup", F.trim(F.col("z.markup"))).otherwise(f["_VALUE"]).alias("value"),
        kind.alias("kind"),
    )


def _pieces(spark: SparkSession, path: str, end: str) -> DataFrame:
    """File text cut at a closing tag, without comments: (text).

    The files are read in parallel however large they are. A comment may hold
    closing tags and so span pieces; whether a piece starts inside one is
    carried down from the pieces above it.
    """
    cut = spark.read.option("lineSep", end).text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.struct(
            F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line")
        ).alias("at"),
        F.col("value").alias("text"),
    )
    mark = F.nullif(F.regexp_extract("text", r"(?s)^.*(<!--|-->)", 1), F.lit(""))
    marked = running(cut.withColumn("__mark", mark), ["file"], ["at"], {"__above": Running("before", "__mark")}, unique=True, key=["file", "at"])
    closed = F.regexp_replace("text", r"(?s)^.*?-->", "")
    rest = F.when(F.coalesce(F.col("__above") == "<!--", F.lit(False)), F.when(F.col("text").contains("-->"), closed).otherwise("")).otherwise(F.col("text"))
    return marked.select(F.regexp_replace(F.regexp_replace(rest, r"(?s)<!--.*?-->", ""), r"(?s)<!--.*$", "").alias("text"))


def read_records(spark: SparkSession, path: str, module: str) -> DataFrame:
    """Read the records of patch files."""
    # An empty element has no fields and would swallow the next record.
    bare = F.regexp_replace("text", r"<record\b[^>]*/>", "")
    record = F.regexp_extract(bare, r"(?s)(<record\b.*)$", 1)
    texts = _pieces(spark, path, "</record>").select(record.alias("__body")).where("__body <> ''")
    closed = texts.select(F.concat("__body", F.lit("</record>")).alias("__xml"))
    return parse_records(closed, "__xml", F.lit(module))


def read_templates(spark: SparkSession, path: str, module: str) -> DataFrame:
    """Read <template> elements in the same shape: one markup field named arch."""
    head = F.regexp_extract("text", r"(?s)(<template\b[^>]*[^/]>).*$", 1)
    body = F.regexp_extract("text", r"(?s)<template\b[^>]*[^/]>(.*)$", 1)
    return _pieces(spark, path, "</template>").select(head.alias("h"), body.alias("b")).where("h <> ''").select(
        F.lit(module).alias("module"), F.regexp_extract("h", r'\bid="([^"]*)"', 1).alias("record_id"),
        F.lit("template").alias("model"), F.lit(None).cast("boolean").alias("forcecreate"),
        F.lit("arch").alias("field"), F.trim("b").alias("value"), F.lit("markup").alias("kind"),
    )
