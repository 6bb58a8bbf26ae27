"""Token counts: pieces are counted once per distinct pre-token and joined to each document's pre-token frequencies.

The join runs inside each Arrow batch: the batch's pre-tokens are reduced to
distinct ones, the library counts the pieces of those that the worker has not
met, and the counts are taken back to the occurrences and summed by document.
No ids are built and no pre-token crosses the network; a shuffled form of the
same join would move about one row for each word of the corpus.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernel
from .common import arrow_map, doc_text


def _library_counts(path: str, texts: list[str]) -> np.ndarray:
    if path.endswith(".model"):
        import sentencepiece

        lib = sentencepiece.SentencePieceProcessor(model_file=path)
        return np.array([len(x) for x in lib.encode(texts, num_threads=1)], np.int64)
    lib = kernel.pieces(path).lib
    return np.array([len(e.ids) for e in lib.encode_batch_fast(texts, add_special_tokens=False)], np.int64)


def is_byte_level(path: str) -> bool:
    """Whether the pre-tokens of the kernel are those of this tokenizer."""
    import json

    if not path.endswith(".json"):
        return False
    with open(path, encoding="utf-8") as f:
        t = json.load(f)
    pre = t.get("pre_tokenizer") or {}
    plain = all(not (a["single_word"] or a["lstrip"] or a["rstrip"]) for a in t.get("added_tokens", []))
    return plain and t.get("normalizer") is None and pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True) and not t.get("truncation") and not t.get("padding")


def token_counts(df: DataFrame, path: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row.

    A null text counts as empty: 0 bytes, 0 tokens. Repeated rows stay repeated
    and a null id stays null. Other columns of df, whatever their names, are
    not read. An empty table gives an empty table.
    """
    fast = is_byte_level(path)

    def count(batch):
        if fast:
            own = kernel.pieces(path, False)
            n = [own.counts(data, offsets) for _, _, offsets, data in kernel.chunks(batch.column(1))]
        else:
            n = [_library_counts(path, [t or "" for t in batch.column(1).to_pylist()])]
        offsets, _ = kernel.utf8(batch.column(1))
        yield batch.column(0), np.diff(offsets), np.concatenate(n)

    out = arrow_map(doc_text(df, id_col, text_col), count, "doc_id long, n_bytes long, n_tokens long")
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
