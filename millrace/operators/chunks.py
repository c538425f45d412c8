"""Blocks of a document packed in order into chunks under a token and an item limit."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame


def assign(tokens: list[int], sections: list[int], items: list[int], max_tokens: int = 3500, max_items: int | None = None) -> list[int]:
    """Chunk number of each block, from 1; blocks are never split, so a block over the limit is a chunk by itself."""
    out: list[int] = []
    used = dense = 0
    for i, (t, k) in enumerate(zip(tokens, items, strict=True)):
        turn = i > 0 and sections[i] != sections[i - 1]
        full = used + t > max_tokens or (turn and used > 0.6 * max_tokens) or (max_items is not None and dense + k > max_items)
        if not out or full:
            out.append(out[-1] + 1 if out else 1)
            used = dense = 0
        else:
            out.append(out[-1])
        used, dense = used + t, dense + k
    return out


def build_chunks(blocks: DataFrame, key: str = "page_id", max_tokens: int = 3500, max_items: int | None = None) -> DataFrame:
    """(key, ord, chunk): one group is one document's blocks, without their texts."""
    kind = blocks.schema[key].dataType.simpleString()

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("ord")
        return pdf[[key, "ord"]].assign(chunk=assign(pdf["tokens"].tolist(), pdf["section"].tolist(), pdf["items"].tolist(), max_tokens, max_items))

    sized = blocks.selectExpr(key, "ord", "section", "floor(length(text) / 3.6) + 5 as tokens", "cast(regexp_count(text, '[0-9]+([.,][0-9]+)*') as int) as items")
    return sized.groupBy(key).applyInPandas(pack, f"{key} {kind}, ord int, chunk int")
