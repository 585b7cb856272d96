"""Packing token sequences: best-fit decreasing over a segment tree of remaining capacities."""

from __future__ import annotations

import json
import math
import re
import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, read_table, settled, slices, text_or_empty

WINDOW = 2048
#: Follows each document's ids.
END_ID = 1
#: Pieces that are packed together on average; windows are shared only within such a group.
GROUP = 8192
#: The vocabulary's rules for cutting text; the short form holds for texts without two white spaces in a row.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SPLIT_SINGLE = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+"

_loaded: dict = {}


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def byte_bpe(path: str):
    """text -> ids, those of tokenizers.Tokenizer.from_file(path) without added special tokens.

    The vocabulary's own file gives the merge ranks of a faster engine; a text that spells a special token goes to
    the tokenizers library itself, which maps it to that token.
    """
    if path in _loaded:
        return _loaded[path]
    import tiktoken

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    special = [t["content"] for t in spec.get("added_tokens", [])]
    # Byte-level vocabularies write the bytes without a printable form as the code points from 256 on.
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    byte_of = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}
    ranks = {bytes(byte_of[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in special}
    full = tiktoken.Encoding("full", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    single = tiktoken.Encoding("single", pat_str=SPLIT_SINGLE, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    del ranks, spec
    whole = []

    def exact(text: str) -> list[int]:
        if not whole:  # the library's own copy of the vocabulary, if ever a text needs it
            from tokenizers import Tokenizer

            whole.append(Tokenizer.from_file(path))
        return whole[0].encode(text, add_special_tokens=False).ids

    double_space = re.compile(r"\s\s").search

    def encode(text: str) -> list[int]:
        if any(t in text for t in special):
            return exact(text)
        return full(text) if double_space(text) else single(text)

    _loaded[path] = encode
    return encode


def _pieces(path: str | None, window: int):
    """Arrow batches of (doc_id, text) to one row a piece: full windows first, then the rest of the document."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        encode = byte_bpe(path or default_vocabulary())
        for batch in slices(batches, 1):
            ids, texts = batch.column(0), batch.column(1)
            row, start, length, crc, total = [], [], [], [], []
            for i in range(batch.num_rows):
                tokens = np.array([*encode(texts[i].as_py()), END_ID], dtype="<u4")
                for a in range(0, len(tokens), window):
                    piece = tokens[a : a + window]
                    row.append(i)
                    start.append(a)
                    length.append(len(piece))
                    crc.append(zlib.crc32(piece))
                    total.append(len(tokens))
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(row, pa.int64())), *(pa.array(x, pa.int64()) for x in (start, length, crc, total))],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"],
            )

    return run


def best_fit(lengths: list[int], window: int = WINDOW) -> tuple[list[int], list[int]]:
    """(window number, offset) of each length; lengths must come in decreasing order.

    A segment tree over the remaining capacities 0..window counts the open windows of each; descending it finds the
    smallest capacity that still holds a piece, so that a piece costs O(log window) however many windows are open.
    """
    leaves = 1 << window.bit_length()
    tree = [0] * (2 * leaves)
    open_: list[list[int]] = [[] for _ in range(window + 1)]
    into, offset, count = [], [], 0
    for n in lengths:
        node = leaves + n
        if not tree[node]:  # up to the first right sibling that has an open window, then down to its leftmost leaf
            while node > 1 and (node & 1 or not tree[node + 1]):
                node >>= 1
            node = node + 1 if node > 1 else 0
            while 0 < node < leaves:
                node = 2 * node if tree[2 * node] else 2 * node + 1
        if node:
            room = node - leaves
            at = open_[room].pop()
            while node:
                tree[node] -= 1
                node >>= 1
        else:
            room, at, count = window, count, count + 1
        into.append(at)
        offset.append(window - room)
        room -= n
        if room:
            open_[room].append(at)
            node = leaves + room
            while node:
                tree[node] += 1
                node >>= 1
    return into, offset


def _pack_group(groups: int, window: int):
    def run(pdf):
        pdf = pdf.sort_values(["length", "doc_id", "start", "ids_crc32"], ascending=[False, True, True, True])
        into, pdf["offset"] = best_fit(pdf["length"].tolist(), window)
        pdf["sequence_id"] = [i * groups + int(pdf["pack"].iloc[0]) for i in into]
        return pdf.drop(columns="pack")

    return run


def pack(docs: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None, window: int = WINDOW) -> DataFrame:
    """One row a piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Documents are cut into full windows from their start; what is left of each is packed best-fit decreasing. Null text
    counts as empty and still has its closing id. Pieces are dealt into groups by a hash of id, start, content and place, each
    small enough for one task; rows that repeat, in any number, are packed each. An empty table gives an empty one. vocabulary is a
    byte-level BPE file, the installed default if None, and is read on the executors.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(F.col(text_col)).alias("text"))
    pieces = rows.mapInArrow(_pieces(vocabulary, window), f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long")
    pieces = scratch.write(pieces)
    groups = max(1, math.ceil(pieces.count() / GROUP))
    # The place in the written table parts pieces that repeat, so that any number of copies spreads over the groups.
    deal = F.pmod(F.xxhash64("doc_id", "start", "ids_crc32", F.monotonically_increasing_id()), F.lit(groups))
    packed = pieces.withColumn("pack", deal).groupBy("pack").applyInPandas(
        _pack_group(groups, window), f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, offset long, sequence_id long"
    )
    return packed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return settled(spark, "pack", lambda scratch: pack(read_table(spark, sf_dir, "documents"), scratch))
