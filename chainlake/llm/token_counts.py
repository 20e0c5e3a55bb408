"""Token counts (operator 9): whole-token shortcut."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chainlake.llm.words import WordEncoder, gathered, sent_tokens


def count_tokens(docs: DataFrame, path: str, limit: int = 1024,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every whole text.

    Counts equal the library's for the byte-level BPE file at `path`: no begin, end or
    added specials, special strings inside a text as the library's default treats them.
    Which vocabulary strings stand for one token alone is proven once, ahead of the scan;
    units found among them count one, and only the rest are merged, once per distinct unit of
    some 8 MB of texts. No shuffle; a task holds that much text at a time, or one longer text.

    A null text counts as empty: 0 bytes, 0 tokens. Repeated rows, null ids and extra
    columns pass through or are ignored: one row out per row in.
    """
    import pyarrow as pa

    table = sent_tokens(docs.sparkSession, path)

    def run(batches):
        coder = WordEncoder(path, table.value)
        for table_ in gathered(batches, 1):
            ids, texts, sizes = (c.combine_chunks() for c in table_.columns)
            yield pa.RecordBatch.from_arrays(
                [ids, sizes, pa.array(coder.counts(texts), pa.int64())],
                names=["doc_id", "n_bytes", "n_tokens"])

    kind = docs.schema[id_col].dataType.simpleString()
    picked = docs.select(
        F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
        F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes"))
    counted = picked.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
