"""JSON objects and arrays, per-company values and translated texts, as maps."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAP_OF_TEXT = "map<string,string>"


def sorted_json(m: Column) -> Column:
    """JSON text of a map with its keys in order, so equal maps are equal texts."""
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(m))))


def parse_map(c: Column, value_type: str = "string") -> Column:
    return F.from_json(c, f"map<string,{value_type}>")


def build_json(df: DataFrame, dst: str, key: Column, fields: Mapping[str, Column]) -> DataFrame:
    """A one-key JSON object whose key comes from the data: ``{key: {..}}``."""
    inner = F.struct(*[c.alias(n) for n, c in fields.items()])
    return df.withColumn(dst, F.to_json(F.create_map(key.cast("string"), inner)))


def merge_maps(left: Column, right: Column) -> Column:
    """Shallow merge in which the right side wins; a NULL left side is empty."""
    kept = F.map_filter(left, lambda k, _: ~F.map_contains_key(right, k))
    return F.when(left.isNull(), right).when(right.isNull(), left).otherwise(F.map_concat(kept, right))


def merge_json(df: DataFrame, dst: str, a: Column, b: Column, value_type: str = "string") -> DataFrame:
    """``merge_maps`` on two JSON object texts, each parsed once."""
    parsed = df.withColumns({"__left": parse_map(a, value_type), "__right": parse_map(b, value_type)})
    merged = parsed.withColumn("__merged", merge_maps(F.col("__left"), F.col("__right")))
    return merged.withColumn(dst, sorted_json(F.col("__merged"))).drop("__left", "__right", "__merged")


def concat_arrays(a: Column, b: Column) -> Column:
    """Array concatenation; a NULL left side is empty, duplicates stay."""
    return F.when(a.isNull(), b).otherwise(F.concat(a, b))


def json_get(df: DataFrame, dst: str, col: str, key: str, as_type: str = "string") -> DataFrame:
    """One key of a JSON object, cast; a key that is absent gives NULL."""
    return df.withColumn(dst, F.get_json_object(F.col(col), f"$.{key}").try_cast(as_type))


def json_set_where(m: Column, old, new) -> Column:
    """Replace a value wherever it stands, for every key of the map in one pass."""
    return F.transform_values(m, lambda _, v: F.when(v == F.lit(old), F.lit(new)).otherwise(v))


def json_set_key_where(m: Column, key: str, old, new) -> Column:
    """Replace the value of one key when it has a given value."""
    return F.transform_values(
        m, lambda k, v: F.when((k == F.lit(key)) & (v == F.lit(old)), F.lit(new)).otherwise(v)
    )


def language_map(texts: Mapping[str, str]) -> Column:
    """A translated text: language code to text."""
    return F.create_map(*[F.lit(x) for pair in texts.items() for x in pair])


def in_language(m: Column, lang: Column, default: str) -> Column:
    """The text in the row's language, or in the default language."""
    return F.coalesce(F.try_element_at(m, lang), F.try_element_at(m, F.lit(default)))


def keep_languages(m: Column, languages: Sequence[str]) -> Column:
    return F.map_filter(m, lambda k, _: k.isin(list(languages)))
