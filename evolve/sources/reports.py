"""Line reports: schema diffs, their annotated copies, and the module status grid."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evolve.operators.joins import attach
from evolve.operators.ordered import Running, running


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text lines with their file and a position that sorts them within it.

    A file may be cut into splits: the split's offset comes first, then the
    place of the line within the split.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"), F.col("value").alias("text"),
    )
    return lines.select("file", F.struct("block", "line").alias("at"), "text")


# The marks of a schema diff report.
_SECTION = r"^---(Models|Fields|XML records) in module '([^']*)'---\s*$"
_FIELD = r"^(\S+)\s+/ (\S+)\s+/ (\S+)(?: \(([^)]*)\))?\s*: (.*)$"
_MODEL = r"^(new|obsolete|renamed)? ?model (\S+)(?: \(([^)]*)\))?(?: \[([^\]]*)\])?\s*$"
_RECORD = r"^(NEW |DEL )?(\S+): (\S+?)(?: \((changed definition: .*)\))?(?: \[([^\]]*)\])?(?: \((noupdate.*|deleted domain.*)\))?\s*$"


def parse_diff_lines(
    lines: DataFrame, by: Sequence[str], order: Sequence[Column | str], text: str = "text", key: Sequence[str] | None = None
) -> DataFrame:
    """Rows of a schema diff: section, module, and the parts of each line; ``key`` is unique.

    Returns ``by``, module, section, model, field, type, change, detail. The
    section heading above a line is carried down to it in line order.
    """
    t = F.col(text)
    section = F.nullif(F.regexp_extract(t, _SECTION, 1), F.lit(""))
    tagged = lines.withColumn(
        "__head", F.when(section.isNotNull(), F.struct(section.alias("section"), F.regexp_extract(t, _SECTION, 2).alias("module")))
    )
    carried = running(tagged, by, order, {"__sec": Running("last", "__head")}, key=key)
    body = carried.where(F.col("__head").isNull() & (F.trim(t) != "") & ~t.startswith("#"))

    def part(pattern: str, group: int) -> Column:
        return F.nullif(F.regexp_extract(t, pattern, group), F.lit(""))

    sec = F.col("__sec.section")
    is_field, is_model = sec == "Fields", sec == "Models"
    note = part(_FIELD, 5)
    field_change = (
        F.when(note.rlike(r"^(NEW|DEL)\b"), F.substring_index(note, " ", 1)).otherwise("changed")
    )
    model_note = F.concat_ws("; ", part(_MODEL, 3), part(_MODEL, 4))
    record_note = F.concat_ws("; ", part(_RECORD, 4), part(_RECORD, 5), part(_RECORD, 6))
    return body.select(
        *by,
        F.col("__sec.module").alias("module"), sec.alias("section"),
        F.when(is_field, part(_FIELD, 2)).when(is_model, part(_MODEL, 2)).otherwise(part(_RECORD, 2)).alias("model"),
        F.when(is_field, part(_FIELD, 3)).when(~is_model, part(_RECORD, 3)).alias("field"),
        F.when(is_field, part(_FIELD, 4)).alias("type"),
        F.when(is_field, field_change)
        .when(is_model, F.coalesce(part(_MODEL, 1), F.lit("changed")))
        .otherwise(F.coalesce(F.trim(part(_RECORD, 1)), F.lit("changed"))).alias("change"),
        F.when(is_field, F.nullif(F.trim(F.regexp_replace(note, r"^(NEW|DEL)\b", "")), F.lit("")))
        .when(is_model, F.nullif(model_note, F.lit("")))
        .otherwise(F.nullif(record_note, F.lit(""))).alias("detail"),
    )


def read_schema_diff(spark: SparkSession, path: str) -> DataFrame:
    return parse_diff_lines(read_lines(spark, path), ["file"], ["at"], key=["file", "at"])


def attach_notes(
    lines: DataFrame, by: Sequence[str], order: Sequence[Column | str], is_note: Column, note: Column, dst: str,
    key: Sequence[str] | None = None,
) -> DataFrame:
    """Give every line the note that closes its block; the notes themselves leave. ``key`` is unique.

    A block is the run of lines above a note, up to the note before. Lines below
    the last note get NULL.
    """
    tagged = lines.withColumn("__is", F.when(is_note, F.lit(1)).otherwise(F.lit(0)))
    counted = running(tagged, by, order, {"__upto": Running("sum", "__is")}, key=key)
    blocks = counted.withColumn("__block", F.col("__upto") - F.col("__is"))
    notes = blocks.where("__is = 1").select(*by, "__block", note.alias("__note"))
    kept = blocks.where("__is = 0")
    return attach(kept, notes, [*by, "__block"], {dst: "__note"}).drop("__is", "__upto", "__block")


def read_annotations(spark: SparkSession, path: str) -> DataFrame:
    """Schema diff lines with the '# ..' comment that answers their block."""
    lines = read_lines(spark, path).where(F.trim("text") != "")
    text = F.col("text")
    noted = attach_notes(lines, ["file"], ["at"], text.startswith("#"), F.trim(F.regexp_replace(text, r"^#\s*", "")), "note", ["file", "at"])
    return noted.where(~text.startswith("---"))


def parse_status_lines(lines: DataFrame, text: str = "text") -> DataFrame:
    """Rows of a status grid: (module, change, status, note).

    Cells are cut by '|'; a module may be marked '|new|' or '|del|' as added or removed.
    """
    t = F.col(text)
    change = F.nullif(F.regexp_extract(t, r"^\|\s*\|(new|del)\|", 1), F.lit(""))
    cells = F.split(F.regexp_replace(t, r"^\|\s*\|(new|del)\|", "|"), r"\|")

    def cell(i: int) -> Column:
        return F.nullif(F.trim(F.get(cells, F.lit(i))), F.lit(""))

    rows = lines.where(t.startswith("|")).select(
        cell(1).alias("module"), change.alias("change"), cell(2).alias("status"), cell(3).alias("note")
    )
    return rows.where(F.col("module").isNotNull() & (F.col("module") != "Module"))


def read_status_grid(spark: SparkSession, path: str) -> DataFrame:
    return parse_status_lines(spark.read.text(path).withColumnRenamed("value", "text"))
