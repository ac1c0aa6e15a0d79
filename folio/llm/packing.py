"""Packing of token ids into sequences: first-fit decreasing in randomised groups.

Documents are dealt to tasks by a hash, which makes random groups of them.  A
task reads its rows in the order of that hash.  A document's ids (plus a final
0) are cut into full sequences and one rest; the rests of ``GROUP_DOCS``
documents are packed together by first-fit decreasing.  The first open
sequence with room is found in a tournament tree over the free room of all
sequences: each node holds the larger room of its two children, so the search
goes down one path.  A task holds the rests of one group only, whatever the
number of rows or the length of a text.

Ids are those of the byte-level tokenizer of the library ``tokenizers``.  The
same vocabulary in its rank form gives the same ids faster (tested), and a
bounded memo holds the ids of pieces between blanks, as no token crosses
their borders.

Defined cases: a null text is empty and has the final id only.  Repeated rows
and null ids are documents of their own.  An empty table gives no rows.
Extra columns are not carried.
"""

from __future__ import annotations

import base64
import re
from typing import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.llm.base import in_small_batches, ship

ship(__name__)

LENGTH = 1024
GROUP_DOCS = 4096
MEMO_PIECES = 1 << 18
TASK_DOCS = 8192           # documents of a task, on average
#: White space as Unicode's property has it.
SPACE = "\t-\r \x85\xa0" + chr(0x1680) + chr(0x2000) + "-" + chr(0x200A) + "".join(map(chr, (0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
_MEMO: dict = {}


def tokenizer(ranks_path: str, pattern: str) -> Callable[[str], bytes]:
    """Text -> ids as little-endian unsigned 32-bit numbers."""
    import tiktoken

    key = ("encoder", ranks_path)
    if key not in _MEMO:
        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _MEMO[key] = (tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}),
                      re.compile(f" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]"), {})
    encoding, pieces, memo = _MEMO[key]
    encode, cut = encoding.encode_ordinary, pieces.findall

    def ids(text: str) -> bytes:
        if len(memo) > MEMO_PIECES:
            memo.clear()
        parts = cut(text)
        for p in set(parts).difference(memo):
            memo[p] = np.array(encode(p), "<u4").tobytes()
        return b"".join(map(memo.__getitem__, parts))
    return ids


class Rooms:
    """Free room of sequences, with the first one that has enough."""

    def __init__(self, leaves: int, room: int):
        self.size = 1 << max(0, (leaves - 1).bit_length())
        self.tree = [room] * (2 * self.size)

    def take(self, need: int) -> tuple[int, int]:
        """First sequence with room for ``need``; its number and its room before."""
        tree, at = self.tree, 1
        while at < self.size:
            at *= 2
            if tree[at] < need:
                at += 1
        before = tree[at]
        tree[at] = before - need
        leaf = at - self.size
        at //= 2
        while at:
            tree[at] = max(tree[2 * at], tree[2 * at + 1])
            at //= 2
        return leaf, before


def first_fit_decreasing(sizes: list[int], length: int) -> list[tuple[int, int]]:
    """(sequence, offset) of each size; ties keep their order."""
    rooms, out = Rooms(len(sizes), length), [(0, 0)] * len(sizes)
    for k in sorted(range(len(sizes)), key=lambda k: -sizes[k]):
        seq, room = rooms.take(sizes[k])
        out[k] = (seq, length - room)
    return out


SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def _pack(ranks_path: str, pattern: str, length: int, group: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        ids_of = tokenizer(ranks_path, pattern)
        sequence = TaskContext.get().partitionId() << 40
        end = np.zeros(1, "<u4").tobytes()
        schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
                            ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])
        rests: list[tuple] = []
        rows: list[tuple] = []

        def pack_rests() -> None:
            nonlocal sequence
            places = first_fit_decreasing([r[2] for r in rests], length)
            rows.extend((*r, sequence + s, o) for r, (s, o) in zip(rests, places))
            sequence += 1 + max(s for s, _ in places)
            rests.clear()

        def flush() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
            rows.clear()
            return batch

        for b in batches:
            held = 0
            for doc, text in zip(b.column(0).to_pylist(), b.column(1)):
                ids = ids_of(text.as_py() or "") + end
                n = len(ids) // 4
                full = n - n % length
                for s in range(0, full, length):
                    rows.append((doc, s, length, ids[4 * s:4 * (s + length)], n, sequence, 0))
                    sequence += 1
                if full < n:
                    rests.append((doc, full, n - full, ids[4 * full:], n))
                if len(rests) >= group:
                    pack_rests()
                held += len(ids)
                if held > 1 << 24 and rows:
                    yield flush()
                    held = 0
            if rows:
                yield flush()
        if rests:
            pack_rests()
        if rows:
            yield flush()
    return run


def pack(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text: str = "text",
         length: int = LENGTH, group_docs: int = GROUP_DOCS) -> DataFrame:
    """Pieces of all documents with their ids and places; see the module.

    A sequence holds ``length`` ids at most; what is left of it is padding.
    """
    rows = in_small_batches(docs).select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    tasks = max(1, -(-rows.count() // TASK_DOCS), rows.sparkSession.sparkContext.defaultParallelism)
    rows = rows.withColumn("deal", F.xxhash64("doc_id", "text"))
    rows = rows.repartition(tasks, "deal").sortWithinPartitions("deal", "doc_id").select("doc_id", "text")
    return rows.mapInArrow(_pack(ranks_path, pattern, length, group_docs), SCHEMA)


def digest(pieces: DataFrame) -> DataFrame:
    """Pieces with a checksum in place of the ids."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op4_packing(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers as P

    return digest(pack(spark.read.parquet(f"{sf_dir}/documents.parquet"), P.path("byte_bpe_50k.tiktoken"), P.PATTERN))
