"""BPE encoding and decoding of whole texts (operator 6), by the prefix programme of ``bpe_prefix``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrow import by_rows


def encode_decode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id_col, ids binary, decoded string): exact ids, 4 bytes each, little-endian, and their decoding.

    path: the vocabulary file. A null text counts as empty: no ids, decoded ''. Each input row gives one
    row, repeated rows too; a null id stays null; other columns are not looked at. Texts are encoded whole.
    """

    def run(texts):
        from .bpe_prefix import word_bpe

        bpe = word_bpe(path)
        ids = [bpe.encode(t) for t in texts]
        return {"ids": ids, "decoded": [bpe.decode(x) for x in ids]}

    return by_rows(docs, id_col, text_col, run, {"ids": "binary", "decoded": "string"})


def digests(encoded: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """n_tokens and SHA-256 of ids and decoded text, of encode_decode's rows."""
    return encoded.select(
        id_col,
        F.expr("cast(length(ids) div 4 as bigint)").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
