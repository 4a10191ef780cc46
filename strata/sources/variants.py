"""JSON documents of any shape, parsed once and kept as VARIANT, with the schema of all of them found on the way."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.session import scratch_path

DOCUMENT = "__document"
# White space of JSON, and the mark that some editors put before UTF-8.
_BLANK = " \t\r\n\ufeff"


def stage_documents(texts: DataFrame, corrupt: str) -> tuple[DataFrame, T.StructType]:
    """(one row per JSON object with the object in ``__document``, the schema that holds all of them).

    ``texts`` has a column ``value``: an object, or an array of objects; its other columns go with every object. What is not
    an object (an element of another kind, text that can't be parsed, an object that repeats a name) is kept as text in
    ``corrupt`` with a NULL document. Blank texts and empty arrays give no row. The texts are read once: the objects are stored,
    and their schema is aggregated by the job that stores them, where repeated tasks change nothing.
    """
    spark, others = texts.sparkSession, [F.col("`" + c.replace("`", "``") + "`") for c in texts.columns if c != "value"]
    text = F.ltrim("value", F.lit(_BLANK))
    whole = F.array(F.try_parse_json(text))
    items = F.when(text.startswith("["), F.coalesce(F.from_json(text, "array<variant>"), whole)).otherwise(whole)
    parsed = texts.where(text != "").select(*others, "value", items.alias("items"))
    # Only a text that could not be parsed goes on beside its items: each of them would get a copy of the whole text.
    lost = F.when((F.size("items") == 1) & F.col("items")[0].isNull(), F.col("value"))
    found = parsed.select(*others, lost.alias("lost"), "items").select(*others, "lost", F.explode("items").alias("item"))
    is_object = F.expr("try_variant_get(item, '$', 'struct<>')").isNotNull()
    rows = found.select(
        *others,
        F.when(is_object, F.col("item")).alias(DOCUMENT),
        F.when(F.col("item").isNull(), F.col("lost")).when(~is_object, F.to_json("item")).alias(corrupt),
    )
    seen, path = Observation("documents"), scratch_path(spark, "documents")
    rows.observe(seen, F.expr(f"schema_of_variant_agg({DOCUMENT})").alias("schema")).write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path), _parsed(seen.get["schema"])


def _parsed(text: str) -> T.StructType:
    """The description that Spark gives of objects, as a type."""
    parts = re.split(r"(`(?:[^`]|``)*`)", text)
    kind = T._parse_datatype_string("".join(p if p.startswith("`") else p.replace("OBJECT<", "STRUCT<") for p in parts))
    return kind if isinstance(kind, T.StructType) else T.StructType([])


def column_types(schema: T.StructType, infer_types: bool) -> T.StructType:
    """The schema as columns have it: numbers with a point as doubles, values of several kinds as text.

    Fields that are NULL or empty everywhere have no type yet and are left out. Without ``infer_types`` all values are text.
    """
    return _column_type(schema, infer_types) or T.StructType([])


def _column_type(kind: T.DataType, infer_types: bool) -> T.DataType | None:
    if isinstance(kind, T.StructType):
        fields = [(f.name, _column_type(f.dataType, infer_types)) for f in kind.fields]
        known = [T.StructField(n, t) for n, t in fields if t is not None]
        return T.StructType(known) if known else None
    if isinstance(kind, T.ArrayType):
        element = _column_type(kind.elementType, infer_types)
        return None if element is None else T.ArrayType(element)
    if isinstance(kind, T.NullType):
        return None
    if isinstance(kind, T.VariantType) or not infer_types:
        return T.StringType()
    return T.DoubleType() if isinstance(kind, T.DecimalType) else kind


def field(names: Sequence[str], kind: T.DataType) -> Column:
    """A field of the document as a column; of several spellings of its name the first that is not NULL counts."""
    return F.coalesce(*[_field(n, _ddl(kind)) for n in names])


def _field(name: str, ddl: str) -> Column:
    for quote in "\"'":
        if quote not in name:
            return F.try_variant_get(F.col(DOCUMENT), f"$[{quote}{name}{quote}]", ddl)
    # Paths have no way to write a name with both quotes.
    return F.try_variant_get(F.try_variant_get(F.col(DOCUMENT), "$", "map<string,variant>")[name], "$", ddl)


def _ddl(kind: T.DataType) -> str:
    if isinstance(kind, T.StructType):
        parts = (f"`{f.name.replace('`', '``')}`: {_ddl(f.dataType)}" for f in kind.fields)
        return f"struct<{', '.join(parts)}>"
    if isinstance(kind, T.ArrayType):
        return f"array<{_ddl(kind.elementType)}>"
    return kind.simpleString()
