"""Files that arrive in a landing folder, read once each into an append-only bronze table.

A stream of file *names* (the content column of ``binaryFile`` is never read) drives ``foreachBatch``; the files of each
micro-batch are then read by a batch query, because only there can the schema still grow. Nothing per row passes through
the driver: it sees the file names of the micro-batch, at most ``max_files`` of them, and their header lines.
"""

from __future__ import annotations

import csv
import datetime as dt
import re
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.sources.schemas import SchemaStore, merge_schemas
from strata.sources.variants import column_types, field as document_field, stage_documents
from strata.streaming.runs import run_available

RESCUED, CORRUPT = "_rescued_data", "_corrupt_record"
LINEAGE = T.StructType(
    [
        T.StructField(RESCUED, T.StringType()),
        T.StructField("ingestion_ts", T.TimestampType()),
        T.StructField("file_name", T.StringType()),
        T.StructField("file_modified", T.TimestampType()),
    ]
)
_LISTING = "path string, modificationTime timestamp, length long, content binary"


# The file source leaves out files that are a week older than the newest one, unless told otherwise.
NO_AGE = "36500d"
# Files whose header is read at a time.
_OPENERS = 16


@dataclass(frozen=True)
class Landing:
    """One landing folder.

    ``format`` is csv (with header) or json (``multi_line``: a file is one document or one array of documents; such a file
    is read by one task, so keep files below some hundred MB). Without ``infer_types`` every column is a string. Files
    older than ``since`` are passed over. ``key=value`` folder names below ``path`` become columns. ``hints`` are columns
    that always exist, with the type they have whatever the files hold. ``max_age`` is how much older than the newest
    file a new one may be; by default there is no limit that a real file could reach.

    With ``one_pass`` JSON files are read once instead of once for their schema and once for their rows: they are parsed
    into VARIANT, stored as that, and the columns are taken from there. Files are UTF-8 then, reader ``options`` are refused,
    objects that repeat a name are corrupt, text of numbers has no closing zeros, and whole numbers of more than 64 bits are
    doubles unless ``hints`` say otherwise.
    """

    path: str
    format: str
    infer_types: bool = False
    multi_line: bool = True
    max_files: int = 1000
    since: dt.datetime | None = None
    options: Mapping[str, str] = field(default_factory=dict)
    hints: Mapping[str, str] = field(default_factory=dict)
    max_age: str = NO_AGE
    one_pass: bool = False

    def __post_init__(self):
        if self.one_pass and (self.format != "json" or self.options):
            raise ValueError("one pass is for JSON without reader options")


def discover(spark: SparkSession, landing: Landing) -> DataFrame:
    """Stream of the names of new files."""
    files = (
        spark.readStream.format("binaryFile")
        .schema(_LISTING)
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", landing.max_files)
        .option("maxFileAge", landing.max_age)
        .load(landing.path)
        .select("path", "modificationTime")
    )
    return files if landing.since is None else files.where(F.col("modificationTime") >= F.lit(landing.since))


def landing_stream(spark: SparkSession, landing: Landing, store: SchemaStore) -> DataFrame:
    """Plain streaming frame over a folder whose columns do not change, with lineage columns.

    The schema is inferred once and remembered. A CSV file with another header stops the stream instead of being read
    by position; :func:`ingest` is the way to follow changing columns.
    """
    schema = store.load()
    if schema is None:
        schema = merge_schemas(None, _reader(spark, landing, infer=True).load(landing.path).schema)
        store.save(schema)
    reader = spark.readStream.format(landing.format).options(**_options(landing)).schema(schema)
    if landing.format == "csv":
        reader = reader.option("enforceSchema", "false")
    reader = reader.option("maxFilesPerTrigger", landing.max_files).option("maxFileAge", landing.max_age)
    return _with_lineage(reader.load(landing.path))


def ingest(spark: SparkSession, landing: Landing, table: str, checkpoint: str, store: SchemaStore) -> None:
    """Append all new files to the bronze table and return.

    Each micro-batch owns one ``ingest_batch`` partition and overwrites it when it is run again after a failure, so no
    file is counted twice.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        paths = [r.path for r in batch.select("path").collect()]
        rows = read_files(batch.sparkSession, landing, paths, store) if paths else None
        if rows is not None:
            rows.write.mode("overwrite").parquet(f"{table}/ingest_batch={batch_id}")

    run_available(discover(spark, landing), load, checkpoint)


def bronze_frame(spark: SparkSession, table: str, store: SchemaStore) -> DataFrame:
    """The bronze table as it is now; rows older than a column have NULL in it."""
    return spark.read.schema(_bronze_schema(store)).option("basePath", table).parquet(table)


def bronze_stream(
    spark: SparkSession, table: str, store: SchemaStore, max_files: int | None = None
) -> DataFrame:
    """The bronze table as a stream of appended rows."""
    reader = spark.readStream.schema(_bronze_schema(store)).option("maxFileAge", NO_AGE)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(table)


def read_files(
    spark: SparkSession, landing: Landing, paths: Sequence[str], store: SchemaStore
) -> DataFrame | None:
    """Rows of the given files in the remembered schema, which grows by the columns that are new in them.

    Values that do not fit their column's remembered type are NULL in the column and kept in ``_rescued_data``.
    None when the files hold no row at all.
    """
    read = _read_csv if landing.format == "csv" else _read_documents if landing.one_pass else _read_json
    stored = store.load()
    found = read(spark, landing, paths, stored)
    if found is None:
        return None
    raw, observed = found
    schema = _hinted(merge_schemas(stored, observed), landing)
    rows = _typed(raw, schema, observed)
    # Only a schema that reads these files is remembered.
    if schema != stored:
        store.save(schema)
    return rows


def _hinted(schema: T.StructType, landing: Landing) -> T.StructType:
    """The schema with the declared types in place of others, and the declared columns that no file had so far."""
    wanted = {n.lower(): (n, T._parse_datatype_string(t)) for n, t in landing.hints.items()}
    fields = [T.StructField(f.name, wanted.pop(f.name.lower(), (None, f.dataType))[1]) for f in schema.fields]
    return T.StructType(fields + [T.StructField(n, t) for n, t in wanted.values()])


def literal(path: str) -> str:
    """A path as readers take it: they expand patterns, so characters that stand for one are escaped."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def _column(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _load(reader, paths: Sequence[str]) -> DataFrame:
    """Exactly these files. A file that is missing, or one that was not asked for, is an error."""
    plain = lambda p: re.sub(r"^([A-Za-z][A-Za-z0-9+.-]*:)/+", r"\1/", p)
    df = reader.load([literal(p) for p in paths])
    asked, found = {plain(p) for p in paths}, {plain(unquote(p)) for p in df.inputFiles()}
    if asked != found:
        raise ValueError(f"files asked for and files found differ: {sorted(asked ^ found)[:5]}")
    return df


def _read_csv(
    spark: SparkSession, landing: Landing, paths: Sequence[str], stored: T.StructType | None
) -> tuple[DataFrame, T.StructType] | None:
    """Files are read per header layout, because Spark matches CSV columns by position, not by name."""
    frames, observed = [], None
    # A column keeps the spelling it was first seen with.
    spelling = {n.lower(): n for n in [*(stored.names if stored else ()), *landing.hints]}
    known = set(stored.names if stored else ()) | {spelling[n.lower()] for n in landing.hints}
    for header, files in _layouts(spark, landing, paths).items():
        names = [spelling.setdefault(n.lower(), n) for n in header]
        text = T.StructType([T.StructField(n, T.StringType()) for n in [*names, CORRUPT]])
        raw = _with_lineage(_load(_reader(spark, landing).schema(text), files))
        fields = [f for f in raw.schema.fields if f.name not in {CORRUPT, *LINEAGE.names}]
        if landing.infer_types and not known.issuperset(names):
            types = _load(_reader(spark, landing, infer=True), files).schema
            fields = [T.StructField(f.name, t.dataType) for f, t in zip(fields, types.fields)]
        observed = merge_schemas(observed, T.StructType(fields), widen=True)
        frames.append(raw)
    if not frames:
        return None
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames), observed


def _layouts(spark: SparkSession, landing: Landing, paths: Sequence[str]) -> dict[tuple[str, ...], list[str]]:
    """{column names: files} of a micro-batch. Files without any line that is not blank are left out.

    Of every file only the beginning is opened, from several threads, because a store answers slowly but in parallel.
    """
    with ThreadPoolExecutor(_OPENERS) as pool:
        headers = list(pool.map(lambda p: _first_line(spark, p, landing.options.get("encoding", "UTF-8")), paths))
    layouts: dict[tuple[str, ...], list[str]] = {}
    for path, header in sorted(zip(paths, headers)):
        if header is not None:
            names = next(csv.reader([header.lstrip("\ufeff")], delimiter=landing.options.get("sep", ",")))
            layouts.setdefault(_unique(names), []).append(path)
    return layouts


def _first_line(spark: SparkSession, path: str, encoding: str) -> str | None:
    """The first line of a file, compressed or not, that is not blank."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    name = jvm.org.apache.hadoop.fs.Path(path)
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(name)
    stream = name.getFileSystem(conf).open(name)
    try:
        content = codec.createInputStream(stream) if codec else stream
        lines = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(content, encoding))
        while (line := lines.readLine()) is not None:
            if line.strip():
                return line
        return None
    finally:
        stream.close()


def _unique(names: Sequence[str]) -> tuple[str, ...]:
    """Empty names and those repeated in any case get their position."""
    clean = [n.strip() for n in names]
    lower = [n.lower() for n in clean]
    return tuple(
        n if n and lower.count(n.lower()) == 1 else f"{n or '_c'}{i}" for i, n in enumerate(clean)
    )


def _read_json(
    spark: SparkSession, landing: Landing, paths: Sequence[str], stored: T.StructType | None
) -> tuple[DataFrame, T.StructType] | None:
    """Columns whose values do not have the remembered type in every file are read as text and cast row by row."""
    inferred = _inferred_json(spark, landing, paths)
    spelling = {n.lower(): n for n in [*(stored.names if stored else ()), *landing.hints]}
    source = {spelling.get(f.name.lower(), f.name): f.name for f in inferred.fields if f.name != CORRUPT}
    observed = T.StructType([T.StructField(spelling.get(f.name.lower(), f.name), f.dataType) for f in inferred.fields if f.name != CORRUPT])
    merged = _hinted(merge_schemas(stored, observed), landing)
    seen = {f.name: f.dataType for f in observed.fields}
    fields = [
        T.StructField(source.get(f.name, f.name), f.dataType if _readable(f.dataType, seen.get(f.name)) else T.StringType())
        for f in merged.fields
    ]
    text = T.StructType([*fields, T.StructField(CORRUPT, T.StringType())])
    raw = _load(_reader(spark, landing).schema(text), paths).withColumnsRenamed({old: new for new, old in source.items()})
    return _with_lineage(raw), observed


def _read_documents(
    spark: SparkSession, landing: Landing, paths: Sequence[str], stored: T.StructType | None
) -> tuple[DataFrame, T.StructType]:
    """As :func:`_read_json`, from documents that were parsed once. Spellings of a name that differ in case are one column."""
    reader = spark.read.format("text").option("wholetext", str(landing.multi_line).lower()).option("basePath", landing.path)
    texts = _with_lineage(_load(reader, paths))
    documents, found = stage_documents(texts, CORRUPT)
    spelling = {n.lower(): n for n in [*(stored.names if stored else ()), *landing.hints]}
    spellings: dict[str, list[str]] = {}
    # Columns from folder names win over fields of the same name, as with other readers.
    folders = [f for f in texts.schema.fields if f.name not in {"value", *LINEAGE.names}]
    observed = T.StructType([T.StructField(spelling.setdefault(f.name.lower(), f.name), f.dataType) for f in folders])
    taken = {f.name.lower() for f in folders}
    for f in column_types(found, landing.infer_types).fields:
        name = spelling.setdefault(f.name.lower(), f.name)
        if name.lower() not in taken:
            spellings.setdefault(name, []).append(f.name)
            observed = merge_schemas(observed, T.StructType([T.StructField(name, f.dataType)]), widen=True)
    merged = _hinted(merge_schemas(stored, observed), landing)
    wanted, seen = {f.name: f.dataType for f in merged.fields}, {f.name: f.dataType for f in observed.fields}
    read = {n: wanted[n] if _readable(wanted[n], seen[n]) else T.StringType() for n in spellings}
    kept = [_column(f.name).alias(spelling[f.name.lower()]) for f in folders]
    raw = documents.select(*kept, *[document_field(names, read[n]).alias(n) for n, names in spellings.items()], CORRUPT, *LINEAGE.names[1:])
    return raw, observed


def _inferred_json(spark: SparkSession, landing: Landing, paths: Sequence[str]) -> T.StructType:
    """Columns and types of the files. When it infers multi-line JSON, Spark expands names as patterns once more, so
    files with such names (few, as a rule) are handed to it as texts."""
    odd = [p for p in paths if literal(p) != p]
    plain = [p for p in paths if literal(p) == p]
    schema = _load(_reader(spark, landing, infer=True), plain).schema if plain else None
    if odd:
        whole = _load(spark.read.format("text").option("wholetext", str(landing.multi_line).lower()), odd).select("value")
        found = _reader(spark, landing, infer=True).json(whole.rdd.map(lambda r: r.value)).schema
        schema = merge_schemas(schema, found, widen=True)
    return schema


def _readable(stored: T.DataType, seen: T.DataType | None) -> bool:
    """Can the JSON reader give every value of type ``seen`` as type ``stored``?"""
    if seen is None or stored == seen or isinstance(stored, T.StringType):
        return True
    if isinstance(stored, T.DoubleType):
        return isinstance(seen, T.LongType)
    if isinstance(stored, T.ArrayType) and isinstance(seen, T.ArrayType):
        return _readable(stored.elementType, seen.elementType)
    if isinstance(stored, T.StructType) and isinstance(seen, T.StructType):
        kinds = {f.name: f.dataType for f in seen.fields}
        return all(_readable(f.dataType, kinds.get(f.name)) for f in stored.fields)
    return False


def _typed(raw: DataFrame, schema: T.StructType, observed: T.StructType) -> DataFrame:
    have = {f.name: f.dataType for f in raw.schema.fields}
    seen = {f.name: f.dataType for f in observed.fields}
    values, lost = [], [F.col(CORRUPT)]
    for f in schema.fields:
        column = _column(f.name)
        if f.name not in have:
            values.append(F.lit(None).cast(f.dataType).alias(f.name))
        elif have[f.name] == f.dataType:
            values.append(column)
        else:
            value, fits = _fit(column, f.dataType, seen.get(f.name))
            values.append(value.alias(f.name))
            lost.append(F.when(column.isNotNull() & ~fits, column).alias(f.name))
    rescued = F.when(F.coalesce(*lost).isNotNull(), F.to_json(F.struct(*lost)))
    return raw.select(*values, rescued.alias(RESCUED), "ingestion_ts", "file_name", "file_modified")


def _fit(text: Column, wanted: T.DataType, seen: T.DataType | None) -> tuple[Column, Column]:
    """(the text as the wanted type, whether nothing of it was lost)."""
    if isinstance(wanted, (T.StructType, T.ArrayType)):
        value = F.from_json(text, wanted)
        whole = F.to_json(F.from_json(text, seen)) if isinstance(seen, type(wanted)) else F.lit(None)
        return value, F.coalesce(F.to_json(value) == whole, F.lit(False))
    value = text.try_cast(wanted)
    return value, value.isNotNull()


def _reader(spark: SparkSession, landing: Landing, infer: bool = False):
    reader = spark.read.format(landing.format).options(**_options(landing))
    if not infer:
        return reader.option("columnNameOfCorruptRecord", CORRUPT)
    if landing.format == "csv":
        return reader.option("inferSchema", str(landing.infer_types).lower())
    # A column of which only NULLs and empty arrays are known has no type yet.
    reader = reader.option("dropFieldIfAllNull", "true")
    return reader.option("primitivesAsString", str(not landing.infer_types).lower())


def _options(landing: Landing) -> dict[str, str]:
    own = {"basePath": landing.path}
    if landing.format == "csv":
        own["header"] = "true"
    else:
        own["multiLine"] = str(landing.multi_line).lower()
    return {**own, **landing.options}


def _with_lineage(df: DataFrame) -> DataFrame:
    data = [_column(c) for c in df.columns]
    return df.select(
        *data,
        F.current_timestamp().alias("ingestion_ts"),
        F.col("_metadata.file_path").alias("file_name"),
        F.col("_metadata.file_modification_time").alias("file_modified"),
    )


def _bronze_schema(store: SchemaStore) -> T.StructType:
    schema = store.load()
    if schema is None:
        raise ValueError("no file has been ingested yet")
    return T.StructType([*schema.fields, *LINEAGE.fields])
