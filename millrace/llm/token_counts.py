r"""Token counts of whole texts under a byte-level BPE vocabulary.

Method: rank-synchronous array merging. The distinct pre-tokens of a batch lie in one ragged numpy array of
symbols; every round finds each sequence's lowest-ranked adjacent pair and merges all its places, in all
sequences at once, until no sequence has a pair with a rank. What survives is counted.

Defined cases: null text counts as empty (0 bytes, 0 tokens); an empty table gives no rows; repeated rows give
repeated rows; other columns of the input are ignored, whatever their names; texts of any length are counted whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import RankedMerges
from .pretokens import Numbered, split



class TokenCounter:
    """Counts by text; a worker remembers the counts of up to a million pre-tokens."""

    def __init__(self, path: str):
        self.merges = RankedMerges(path)
        self.special = self.merges.special
        self.known = Numbered()
        self.counts = np.empty(0, np.int64)

    def count(self, texts: list[str]) -> list[int]:
        """Special strings inside a text are one token each, and cut it."""
        parts, owner, specials = list(texts), np.arange(len(texts)), 0
        for special in self.special:
            if any(special in x for x in parts):
                cut = [x.split(special) for x in parts]
                specials = specials + np.bincount(owner, [len(x) - 1 for x in cut], len(texts))
                owner = np.repeat(owner, [len(x) for x in cut])
                parts = [y for x in cut for y in x]
        joined, starts, ends, keys, offsets = split(parts, spaced=True)
        number = self.known.find(keys)
        missing = np.flatnonzero(number < 0)
        if len(missing):
            new, first = np.unique(keys[missing], return_index=True)
            if self.known.full(len(new)):
                self.known.clear()
                self.counts = np.empty(0, np.int64)
                new, first = np.unique(keys, return_index=True)
                missing = np.arange(len(keys))
            first = missing[first]
            tokens = [joined[a:b].encode() for a, b in zip(starts[first].tolist(), ends[first].tolist())]
            self.known.add(new)
            self.counts = np.concatenate([self.counts, self.merges.merge(tokens)[1]])
            number = self.known.find(keys)
        sums = np.concatenate([[0], np.cumsum(self.counts[number])])[offsets]
        return (np.bincount(owner, np.diff(sums), len(texts)) + specials).astype(np.int64).tolist()


def token_counts(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 512) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of every row; a map without a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = TokenCounter(vocabulary)
        for batch in batches:
            texts = [x or "" for x in batch.column(1).to_pylist()]
            counts: list[int] = []
            begin = size = 0
            for i, x in enumerate([*texts, None]):
                if x is None or size + len(x) > 1 << 20 and i > begin:
                    counts += counter.count(texts[begin:i])
                    begin, size = i, 0
                size += len(x or "")
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(counts, pa.int64())], names=["id", "n_bytes", "n_tokens"])

    kind = docs.schema[id_col].dataType.simpleString()
    asked = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes"))
    return asked.mapInArrow(run, f"id {kind}, n_bytes long, n_tokens long").select(
        F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
