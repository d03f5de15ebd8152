"""Encoding of a corpus with a public byte-level BPE tokenizer, exact for texts of any length.

Texts are cut only where the cut can be mended. Between two classes of characters (a letter run and a blank, say)
the pre-tokenizer always stops, so encodings of both sides concatenate as they are. Inside a run that no such place
interrupts, halves are encoded on their own, in parallel if the text is very long, and the join is repaired: a window
of tokens around it is decoded and encoded again, growing until its outer tokens agree with what both halves had.
Agreement is tested pairwise: a byte-level BPE sequence is the encoding of its bytes exactly when every two
neighbours, encoded together, come out as themselves.
"""

from __future__ import annotations

import base64
import sys
import types
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKENIZERS = "/opt/tokenizers"

#: The vocabulary's published pre-tokenizer pattern (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Characters a piece has at most before it is halved within a task, and before its halves go to other tasks.
PIECE = 1 << 11
SPREAD = 1 << 20


def encoder(folder: str = TOKENIZERS, name: str = "byte_bpe_50k"):
    """The tokenizer, loaded once per worker process."""
    import tiktoken

    store = sys.modules.setdefault("_rodaje_encoders", types.ModuleType("_rodaje_encoders"))
    key = f"{folder}/{name}"
    if not hasattr(store, key):
        with open(f"{key}.tiktoken", "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        setattr(store, key, tiktoken.Encoding(name, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}))
    return getattr(store, key)


def _pretokens() -> regex.Pattern:
    return regex.compile(PATTERN.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))


def _kind(c: str) -> str:
    if c == "'":
        return c
    for kind, pattern in (("l", r"\p{L}"), ("s", r"\p{White_Space}"), ("n", r"\p{N}")):
        if regex.match(pattern, c):
            return kind
    return "o"


def _cut_near(text: str, low: int, high: int) -> tuple[int, bool] | None:
    """A place in [low, high) to cut at, and whether the pre-tokenizer always stops there.

    Before white space and between two other classes it does; inside a run of one class the join can be mended.
    At apostrophes and at the end of white space it looks across, so no cut is made there.
    """
    found = None
    for p in range(max(low, 3), min(high, len(text) - 1)):
        if found is not None and p > low + 256:
            break
        a, b = _kind(text[p - 1]), _kind(text[p])
        if a == "'" or b == "'" or (a == "s" and b != "s"):
            continue
        if a != b:
            return p, True
        if found is None and _kind(text[p - 2]) == a == _kind(text[p + 1]) and text[p - 3] != "'":
            found = p, False
    return found


def pieces(text: str, size: int) -> list[tuple[str, bool]]:
    """The text in pieces of about `size` characters, each with whether it starts where the pre-tokenizer stops."""
    out, start, apart, at = [], 0, True, size
    while len(text) - at > size // 2:
        cut = _cut_near(text, at, at + max(4, size // 2))
        if cut is None:
            at += max(4, size // 2)
            continue
        out.append((text[start : cut[0]], apart))
        start, apart = cut
        at = start + size
    return [*out, (text[start:], apart)]


#: Tokens of a piece, how many of them belong to its first and its last pre-token, and whether it has one only.
Node = tuple[list[int], int, int, bool]


def encode_piece(enc, text: str, open_left: bool = True, open_right: bool = True) -> Node:
    """Encode one piece; its ends are told apart only where they may have to be mended."""
    pattern = _pretokens()
    first = pattern.match(text).end() if open_left and text else 0
    if first == len(text) and open_left:
        tokens = _bpe(enc, text.encode())
        return tokens, len(tokens), len(tokens), True
    if not open_right:
        return _bpe(enc, text[:first].encode()) + enc.encode_ordinary(text[first:]), len(_bpe(enc, text[:first].encode())), 0, False
    starts = [m.start() for m in pattern.finditer(text)]
    last = starts.pop()
    if last == 0:
        tokens = _bpe(enc, text.encode())
        return tokens, len(tokens), len(tokens), True
    # The middle must not end in white space, which the pre-tokenizer would then take as a whole.
    stop, between = last, []
    while stop > first and regex.match(r"\p{White_Space}", text[stop - 1]):
        between.append(text[starts[-1] : stop])
        stop = starts.pop()
    a, c = _bpe(enc, text[:first].encode()), _bpe(enc, text[last:].encode())
    middle = enc.encode_ordinary(text[first:stop]) + [t for s in reversed(between) for t in _bpe(enc, s.encode())]
    return a + middle + c, len(a), len(c), False


def _bpe(enc, raw: bytes) -> list[int]:
    return enc._core_bpe.encode_single_piece(raw) if raw else []


def _stands(enc, a: int, b: int) -> bool:
    return _bpe(enc, enc.decode_single_token_bytes(a) + enc.decode_single_token_bytes(b)) == [a, b]


def mend(enc, left: list[int], right: list[int]) -> list[int]:
    """The encoding of one pre-token from those of its two parts: a window around the join grows until it fits."""
    if not left or not right or _stands(enc, left[-1], right[0]):
        return left + right
    size = 1
    while True:
        a, b = max(0, len(left) - size), min(len(right), size)
        mid = _bpe(enc, b"".join(map(enc.decode_single_token_bytes, left[a:] + right[:b])))
        if (a == 0 or _stands(enc, left[a - 1], mid[0])) and (b == len(right) or _stands(enc, mid[-1], right[b])):
            return left[:a] + mid + right[b:]
        size *= 2


def concatenate(enc, a: Node, b: Node, apart: bool) -> Node:
    """The node of two neighbouring pieces."""
    if apart:
        return a[0] + b[0], a[1], b[2], False
    mid = mend(enc, a[0][len(a[0]) - a[2] :], b[0][: b[1]])
    tokens = a[0][: len(a[0]) - a[2]] + mid + b[0][b[1] :]
    return tokens, len(mid) if a[3] else a[1], len(mid) if b[3] else b[2], a[3] and b[3]


def tree(enc, nodes: list[tuple[Node, bool]]) -> list[int]:
    """Concatenate neighbours, then neighbours of those, until one is left."""
    while len(nodes) > 1:
        paired = [
            (concatenate(enc, nodes[i][0], nodes[i + 1][0], nodes[i + 1][1]), nodes[i][1])
            for i in range(0, len(nodes) - 1, 2)
        ]
        nodes = paired + nodes[len(paired) * 2 :]
    return nodes[0][0][0]


def encode(enc, text: str | None, piece: int = PIECE) -> list[int]:
    """Token ids of one text; none for a null or empty one."""
    if not text:
        return []
    if len(text) <= piece * 2:
        return enc.encode_ordinary(text)
    parts = pieces(text, piece)
    open_right = [not apart for _, apart in parts[1:]] + [False]
    return tree(enc, [(encode_piece(enc, t, not apart, r), apart) for (t, apart), r in zip(parts, open_right)])


def _lists(rows: list[np.ndarray]) -> pa.ListArray:
    offsets = np.zeros(len(rows) + 1, dtype=np.int32)
    np.cumsum([len(r) for r in rows], out=offsets[1:])
    values = np.concatenate(rows) if rows else np.empty(0, dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(np.int32, copy=False)))


def _encode_batches(folder: str, name: str, piece: int, counts: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(folder, name)

        def ids(t: str | None) -> np.ndarray:
            if t and len(t) <= piece * 2:
                return np.frombuffer(enc._core_bpe.encode_to_tiktoken_buffer(t, set()), dtype=np.uint32)
            return np.asarray(encode(enc, t, piece), dtype=np.uint32)

        for batch in batches:
            for start in range(0, len(batch), 512):
                block = batch.slice(start, 512)
                if counts:
                    sizes = [len(ids(t)) for t in block.column(1).to_pylist()]
                    out = pa.array(sizes, type=pa.int64())
                else:
                    out = _lists([ids(t) for t in block.column(1).to_pylist()])
                yield pa.RecordBatch.from_arrays([block.column(0), out], names=["doc_id", "n" if counts else "ids"])

    return run


def _split_batches(piece: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, key, text in zip(*[batch.column(i).to_pylist() for i in range(3)]):
                parts = pieces(text, piece)
                open_right = [not apart for _, apart in parts[1:]] + [False]
                for i, ((t, apart), r) in enumerate(zip(parts, open_right)):
                    row = [[doc], [key], [i], [t], [apart], [r]]
                    types_ = [pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.bool_(), pa.bool_()]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(v, type=k) for v, k in zip(row, types_)], names=["doc_id", "key", "i", "t", "apart", "right"]
                    )

    return run


def _piece_batches(folder: str, name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(folder, name)
        for batch in batches:
            for row in batch.to_pylist():
                tokens, head, tail, single = encode_piece(enc, row["t"], not row["apart"], row["right"])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["doc_id"]], type=pa.int64()), pa.array([row["key"]], type=pa.int64()),
                        pa.array([row["i"]], type=pa.int32()), pa.array([row["apart"]]),
                        _lists([np.asarray(tokens, dtype=np.int32)]), pa.array([head], type=pa.int32()),
                        pa.array([tail], type=pa.int32()), pa.array([single]),
                    ],
                    names=["doc_id", "key", "i", "apart", "tokens", "head", "tail", "single"],
                )

    return run


def _joined(folder: str, name: str):
    def run(group: pa.Table) -> pa.Table:
        enc = encoder(folder, name)
        rows = group.sort_by("i").to_pylist()
        ids = tree(enc, [((r["tokens"], r["head"], r["tail"], r["single"]), r["apart"]) for r in rows])
        return pa.table({"doc_id": pa.array([rows[0]["doc_id"]], type=pa.int64()), "ids": _lists([np.asarray(ids, dtype=np.int32)])})

    return run


def token_ids(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folder: str = TOKENIZERS, name: str = "byte_bpe_50k",
    piece: int = PIECE, spread: int = SPREAD,
) -> DataFrame:
    """doc_id, ids: each row's token ids, without special tokens; an empty list for a null or empty text.

    One row comes out for each row in, repeated ids included. Texts of up to `spread` characters are encoded where
    they are read, without a shuffle; longer ones are cut into pieces for other tasks and joined again.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("t"))
    short = F.coalesce(F.length("t") <= spread, F.lit(True))
    near = rows.where(short).mapInArrow(_encode_batches(folder, name, piece, False), "doc_id long, ids array<int>")
    # A row number, given before a text is cut, tells repeated ids apart.
    far = rows.where(~short).select("doc_id", F.monotonically_increasing_id().alias("key"), "t")
    parts = far.mapInArrow(
        _split_batches(max(piece, spread // 8)), "doc_id long, key long, i int, t string, apart boolean, right boolean"
    )
    encoded = parts.repartition("doc_id", "key", "i").mapInArrow(
        _piece_batches(folder, name),
        "doc_id long, key long, i int, apart boolean, tokens array<int>, head int, tail int, single boolean",
    )
    whole = encoded.groupBy("doc_id", "key").applyInArrow(_joined(folder, name), "doc_id long, ids array<int>")
    return near.unionByName(whole)


def texts_of(encoded: DataFrame, folder: str = TOKENIZERS, name: str = "byte_bpe_50k") -> DataFrame:
    """doc_id, text: the texts that token ids stand for; '' for an empty list."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(folder, name)
        for batch in batches:
            texts = [enc.decode(ids) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, type=pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def token_counts(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folder: str = TOKENIZERS, name: str = "byte_bpe_50k",
    piece: int = PIECE, spread: int = SPREAD,
) -> DataFrame:
    """doc_id, n: how many tokens each text has; 0 for a null or empty one."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("t"))
    short = F.coalesce(F.length("t") <= spread, F.lit(True))
    near = rows.where(short).mapInArrow(_encode_batches(folder, name, piece, True), "doc_id long, n long")
    far = token_ids(rows.where(~short), "doc_id", "t", folder, name, piece, spread)
    return near.unionByName(far.select("doc_id", F.size("ids").cast("long").alias("n")))
