"""Concatenate-and-cut packing of tokenised documents into fixed windows.

Pass one tokenises every document once, keeps a running token total inside
each partition and stores ids with their in-partition start.  The partition
totals are then prefix-summed, which gives each document its global offset.
Pass two cuts the one long token stream at multiples of the window and returns
a boundary record per piece, from stored ids, with built-in functions only.

Defined cases: a null or empty text is the separator alone; repeated rows and
repeated or null ids are packed once per row; an empty table gives no rows;
further columns are ignored.  Only the last window can be short.
"""

from __future__ import annotations

import base64
import re
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shoplens.llm.common import small_batches, stored

WINDOW = 1024
SEPARATOR = 0
#: Partition totals that may be broadcast: 24 bytes each, so 24 MB at most.
BROADCAST_PARTS = 1_000_000

#: Characters for which both tokeniser libraries are tested to agree; other texts take the reference library.
_COMMON = re.compile(r"[^\n\r\t\x20-\x7e¡-ɏ‐-‧]")
_SPECIAL = "<|endoftext|>"


def default_tokenizer_files() -> dict[str, str]:
    """Paths of the byte-level BPE vocabulary: as tokenizers JSON and as ranks."""
    import public_tokenizers as public

    return {"json": public.path("byte_bpe_50k.json"), "ranks": public.path("byte_bpe_50k.tiktoken"), "pattern": public.PATTERN}


class _Encoder:
    """Ids of the JSON tokeniser.

    The same vocabulary and merges loaded as ranks encode four times as fast,
    with equal ids; texts with a special token's string or characters outside
    the tested ranges go to the JSON tokeniser itself.
    """

    def __init__(self, files: dict[str, str]) -> None:
        import tiktoken
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(files["json"])
        with open(files["ranks"], "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding("ranks", pat_str=files["pattern"], mergeable_ranks=ranks, special_tokens={})

    def __call__(self, text: str) -> list[int]:
        if _SPECIAL in text or _COMMON.search(text):
            return self.slow.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)


def tokenize(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", files: dict[str, str] | None = None, separator: int = SEPARATOR) -> DataFrame:
    """(doc_id, part, local_start, n_ids, ids): ids as little-endian unsigned 32-bit integers, the separator last."""
    files = files or default_tokenizer_files()
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, at = _Encoder(files), TaskContext.get().partitionId(), 0
        for batch in batches:
            starts, counts, blobs = [], [], []
            for text in batch.column(1).to_pylist():
                ids = array("I", encode(text) if text else ())
                ids.append(separator)
                starts.append(at)
                counts.append(len(ids))
                blobs.append(ids.tobytes())
                at += len(ids)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([part] * len(counts), pa.int32()), pa.array(starts, pa.int64()), pa.array(counts, pa.int64()), pa.array(blobs, pa.binary())],
                ["doc_id", "part", "local_start", "n_ids", "ids"],
            )

    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return docs.mapInArrow(run, "doc_id long, part int, local_start long, n_ids long, ids binary")


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, files: dict[str, str] | None = None, separator: int = SEPARATOR, with_ids: bool = False) -> DataFrame:
    """One boundary record per piece: which tokens of which document lie where in which sequence.

    ``start`` counts the document's tokens before the piece, ``offset`` the
    sequence's.  ``with_ids`` adds the ids themselves as an array.
    """
    tokens = stored(tokenize(docs, id_col, text_col, files, separator), "tokens", "zstd")
    totals = stored(tokens.groupBy("part").agg(F.sum("n_ids").alias("total")), "totals")
    # one row per partition of the scan, never per document
    before = F.sum("total").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = totals.select("part", F.coalesce(before, F.lit(0)).alias("part_start"))
    if totals.count() <= BROADCAST_PARTS:
        offsets = F.broadcast(offsets)
    placed = tokens.join(offsets, "part").withColumn("at", F.col("part_start") + F.col("local_start"))
    first, last = F.expr(f"at div {window}"), F.expr(f"(at + n_ids - 1) div {window}")

    def piece(k: F.Column) -> F.Column:
        begin = F.greatest(F.col("at"), k * window)
        end = F.least(F.col("at") + F.col("n_ids"), (k + 1) * window)
        start, length = begin - F.col("at"), end - begin
        cut = F.substring(F.col("ids"), (start * 4 + 1).cast("int"), (length * 4).cast("int"))
        fields = [start.alias("start"), length.alias("length"), F.crc32(cut).alias("ids_crc32"), k.alias("sequence_id"), (begin - k * window).alias("offset")]
        return F.struct(*fields, *([cut.alias("piece_ids")] if with_ids else []))

    # pieces are cut inside the row, so that a long document's ids are never copied once per piece
    pieces = placed.select("doc_id", F.col("n_ids").alias("doc_tokens"), F.explode(F.transform(F.sequence(first, last), piece)).alias("p"))
    out = pieces.select(
        "doc_id", "p.start", "p.length", "p.ids_crc32", "doc_tokens", "p.sequence_id", "p.offset",
        (F.col("p.start") == 0).alias("opens_doc"),
        (F.col("p.start") + F.col("p.length") == F.col("doc_tokens")).alias("closes_doc"),
        *(["p.piece_ids"] if with_ids else []),
    )
    return out
