"""Token ids as flat binary files.

A dataset is a folder: per part a ``.bin`` file of unsigned ids, nothing between documents; an ``.idx`` file of 64-bit
offsets into it, counted in ids, one more than there are documents; a ``.doc`` file of 64-bit document ids. The table
``manifest`` lists the parts in order with the base of each, the number of ids in all parts before it. All numbers are
little-endian. Offset plus base is a document's place in the whole.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strata.llm.common import Store, arrow_map, with_text
from strata.llm.vocab import encoder

# Stands for a NULL document id in a .doc file.
NO_ID = -(1 << 63)
# Text of one part, and documents that a reader hands on at a time.
PART_BYTES, BATCH_DOCS = 512 << 20, 4096
# Characters of a text by which rows of one id are dealt to parts.
ORDER_CHARS = 64
WRITTEN = "part int, bin string, idx string, doc string, n_docs bigint, n_ids bigint, dtype string"


def write_token_files(
    docs: DataFrame, tokenizer: str, end_id: int, path: str, id_col: str = "doc_id", text_col: str = "text", part_bytes: int = PART_BYTES
) -> DataFrame:
    """Encode every text, append ``end_id``, write the dataset to ``path``; returns its manifest.

    Documents are in ascending order of id (NULL first), rows with the same id in order of their text. Ids take two
    bytes where the vocabulary allows it, else four. NULL and empty texts hold ``end_id`` alone. An empty table gives a
    manifest without parts. A part is one range of ids, written by one task as a stream, offsets too; a repeated attempt
    writes files of its own and only those of the attempt that counts are in the manifest. There are as many parts as Spark
    has shuffle partitions, or more where these would hold more than ``part_bytes`` of text on average. An id that many rows
    share is spread by how their texts begin; only rows alike in that too lie in one part.
    """
    spark, store = docs.sparkSession, Store(path)
    plain = with_text(docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text")), "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, coder, files, n_ids, n_docs = TaskContext.get().partitionId(), encoder(tokenizer), {}, 0, 0
        end = np.asarray([end_id], coder.dtype).tobytes()
        for batch in batches:
            if not files:
                files = {kind: store.create(f"part-{part:06d}.{kind}") for kind in ("bin", "idx", "doc")}
                files["idx"][0].write(np.zeros(1, "<u8").tobytes())
            offsets = []
            for text in batch.column(1).to_pylist():
                made = coder.encode(text) + end
                files["bin"][0].write(made)
                n_ids += len(made) // coder.dtype.itemsize
                offsets.append(n_ids)
            files["idx"][0].write(np.asarray(offsets, "<u8").tobytes())
            files["doc"][0].write(np.asarray([NO_ID if i is None else i for i in batch.column(0).to_pylist()], "<i8").tobytes())
            n_docs += len(batch)
        if files:
            for f, _ in files.values():
                f.close()
            row = {"part": [part], **{k: [name] for k, (_, name) in files.items()}, "n_docs": [n_docs], "n_ids": [n_ids], "dtype": [coder.dtype.str]}
            types = {"part": pa.int32(), "n_docs": pa.int64(), "n_ids": pa.int64()}
            yield pa.RecordBatch.from_arrays([pa.array(v, types.get(k, pa.string())) for k, v in row.items()], list(row))

    n_bytes = plain.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 0
    wanted, usual = -(-n_bytes // part_bytes), int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("id").asc(), F.substring("text", 1, ORDER_CHARS).asc()]
    dealt = plain.repartitionByRange(wanted, *order) if wanted > usual else plain.repartitionByRange(*order)
    parts = arrow_map(dealt.sortWithinPartitions("id", "text"), write, WRITTEN)
    parts.write.parquet(f"{path}/parts")
    # One row per part, so the running sum is over a table as short as the list of files.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    manifest = spark.read.schema(WRITTEN).parquet(f"{path}/parts").withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))
    manifest.write.parquet(f"{path}/manifest")
    return spark.read.parquet(f"{path}/manifest")


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` per document of a dataset, from its memory-mapped files.

    The checksum is over the ids as little-endian unsigned 32-bit integers, whatever width they are stored in.
    """
    store = Store(path)
    manifest = spark.read.parquet(f"{path}/manifest")
    types = [pa.int64()] * 4
    names = ["doc_id", "start", "n_tokens", "ids_crc32"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = store.read(row["bin"]).view(row["dtype"])
                offsets = store.read(row["idx"]).view("<i8")
                docs = store.read(row["doc"]).view("<i8")
                if len(docs) != row["n_docs"] or len(offsets) != len(docs) + 1 or offsets[-1] != len(ids) or len(ids) != row["n_ids"]:
                    raise ValueError(f"{path}: part {row['part']} is not what the manifest says")
                for at in range(0, len(docs), BATCH_DOCS):
                    some = offsets[at : at + BATCH_DOCS + 1]
                    own = docs[at : at + BATCH_DOCS]
                    crc = [zlib.crc32(ids[a:b].astype("<u4")) for a, b in zip(some[:-1].tolist(), some[1:].tolist(), strict=True)]
                    columns = [own, some[:-1] + row["base"], np.diff(some), np.asarray(crc, np.int64)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t, mask=(c == NO_ID) if i == 0 else None) for i, (c, t) in enumerate(zip(columns, types, strict=True))], names
                    )

    # A part is read by a task of its own; the rows dealt out here are the manifest's.
    dealt = manifest.repartitionByRange(max(1, manifest.count()), "part")
    return arrow_map(dealt, read, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
