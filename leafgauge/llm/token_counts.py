"""Token counts from per-prefix dynamic programming (operator 9)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from .arrow import by_rows


def token_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id_col, n_bytes, n_tokens) for every whole text; a null text counts as empty: 0 and 0.

    path: a sentencepiece BPE file. Each input row gives one row; a null id stays null.
    """

    def run(texts):
        from .bpe_prefix import piece_bpe

        bpe = piece_bpe(path)
        return {"n_bytes": [len((t or "").encode("utf-8", "surrogatepass")) for t in texts], "n_tokens": [bpe.count(t) for t in texts]}

    return by_rows(docs, id_col, text_col, run, {"n_bytes": "bigint", "n_tokens": "bigint"})


def truncation_points(docs: DataFrame, path: str, budget: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id_col, n_tokens, keep_chars): how many leading characters encode to at most budget tokens.

    Both come from the stored counts of all prefixes; nothing is encoded again. Null and empty texts give 0, 0.
    """
    if budget < 0:
        raise ValueError("budget is negative")

    def run(texts):
        from .bpe_prefix import piece_bpe

        bpe = piece_bpe(path)
        counts = [bpe.prefix_counts(t) for t in texts]
        return {"n_tokens": [c[-1] for c in counts], "keep_chars": [max(i for i, n in enumerate(c) if n <= budget) for c in counts]}

    return by_rows(docs, id_col, text_col, run, {"n_tokens": "bigint", "keep_chars": "bigint"})
