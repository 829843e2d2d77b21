"""Alignment of two tokenizers by an inverted index of linked token ids.

Both tokenizers encode a space and the text. Where a token of each ends at the same byte a group ends, and all A-B pairs of tokens
in a group are linked. The index holds, for every id pair, a compressed bitmap of the documents that link it, with bit planes for
how often each does.

A cut before a space that follows no white space ends a token of either tokenizer, and neither looks across it. So texts are cut
there, a task encodes and aligns each distinct chunk once, and a document is the sum of its chunks.

* A task numbers documents within blocks. A block's bitmaps are built by sorting (pair, document): few documents are kept as a list of
  their numbers, many as bits, whichever is smaller; plane j holds bit j of each set document's number of links.
  Blocks number their documents apart, so the OR of a pair's bitmaps is their union, and its popcount the sum of theirs.
* Popcounts go to shards by the pair's hash and are added up; the highest count of each A id (as many rows as A has ids) is broadcast.
* Each block's pairs get their counts back; with the block's bitmaps and planes they give every document its scores.

Nothing is pruned. A hot pair is one entry of a block. Null and empty texts, and texts that a tokenizer does not
give back byte for byte, have no tokens: zeros, and an empty digest. Strings of special tokens are plain text. Repeated rows are
documents of their own; null ids are kept. Extra columns are not carried. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import slices, staged
from ledgerlens.llm.words import dictionary, text_bytes

SLICE_BYTES = 2 << 20  # of text that a task holds as tokens at once
BLOCK_LINKS = 2_000_000  # (pair, document) entries after which a block ends
BLOCK_DOCS = 1 << 16
SHARD_BYTES = 32 << 20  # of text for each shard of pairs
EXPAND = 4_000_000  # links of long groups expanded at once
LONG_CHUNK = 1000  # bytes; longer chunks are encoded apart
# How a byte-level pre-tokenizer parts texts; control characters that some count as white space.
BYTE_LEVEL_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_CONTROL = "\x1c\x1d\x1e\x1f"
INDEX = ("kind string, block long, pos int, doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, "
         "shard int, n long, pairs binary, postings binary")


# Chunks -------------------------------------------------------------------------------------------------------------


def _after_space(data: np.ndarray) -> np.ndarray:
    """True where the character that ends just before a byte is white space (or a control that some count as such)."""
    p = [np.concatenate([np.zeros(k, np.uint8), data[:-k]]) if len(data) >= k else np.zeros(len(data), np.uint8) for k in (1, 2, 3)]
    a, b, c = p
    ascii_space = (a == 0x20) | ((a >= 0x09) & (a <= 0x0D)) | ((a >= 0x1C) & (a <= 0x1F))
    two = (b == 0xC2) & ((a == 0x85) | (a == 0xA0))
    three = (((c == 0xE1) & (b == 0x9A) & (a == 0x80)) | ((c == 0xE2) & (b == 0x81) & (a == 0x9F)) | ((c == 0xE3) & (b == 0x80) & (a == 0x80))
             | ((c == 0xE2) & (b == 0x80) & ((a <= 0x8A) | (a == 0xA8) | (a == 0xA9) | (a == 0xAF))))
    return ascii_space | two | three


def chunks(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.BinaryArray]:
    """(codes, first chunk of each text, distinct chunks) of space + text; every chunk begins with a space."""
    data, starts = text_bytes(texts)
    n = len(starts) - 1
    spaced = np.full(len(data) + n, 0x20, np.uint8)
    begin = starts[:-1] + np.arange(n)
    own = np.ones(len(spaced), bool)
    own[begin] = False
    spaced[own] = data
    cut = (spaced == 0x20) & ~_after_space(spaced)
    cut[begin] = True
    at = np.flatnonzero(cut)
    codes, entries = dictionary(spaced, np.append(at, len(spaced)))
    return codes, np.searchsorted(at, np.append(begin, len(spaced))), entries


class Pair:
    """The two tokenizers: A a byte-level BPE given as a tokenizers file, B by sentencepiece.

    Where A's file is a plain byte-level BPE whose ids follow the order of its merges, tiktoken encodes by the same ids;
    otherwise, and for long chunks, the tokenizers library does.
    """

    def __init__(self, a_json: str, b_model: bytes):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(a_json)
        self.a.encode_special_tokens = True
        ranks = _merge_ranks(json.loads(a_json))
        self.fast = tiktoken.Encoding("a", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks, special_tokens={}) if ranks else None
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        self.b_space = self.b.piece_to_id("\u2581")
        self.a_bytes = pa.array([byte_level(self.a.id_to_token(i)) for i in range(self.a.get_vocab_size())], pa.binary())
        self.b_bytes = pa.array([_piece_bytes(self.b, i) for i in range(self.b.get_piece_size())], pa.binary())
        size = max(len(self.a_bytes), len(self.b_bytes))
        # Decimal ids, each followed by one of the three separators.
        self.printed = pa.array([f"{i}{s}".encode() for i in range(size) for s in ",|;"], pa.binary())

    def _encode_a(self, entries: pa.BinaryArray, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all chunks, tokens of each). Chunks that end in no white space are encoded as one text: a space begins each."""
        size = pc.binary_length(entries).to_numpy()
        joined = np.array([self.fast is not None and n <= LONG_CHUNK and not t[-1].isspace() and t[-1] not in _CONTROL
                           for n, t in zip(size.tolist(), texts, strict=True)], bool)
        alone = np.flatnonzero(~joined)
        other = [e.ids for e in self.a.encode_batch_fast([texts[i] for i in alone.tolist()], add_special_tokens=False)] if len(alone) else []
        counts = np.zeros(len(texts), np.int64)
        counts[alone] = [len(x) for x in other]
        apart = np.fromiter(chain.from_iterable(other), np.uint32, int(counts.sum()))
        if len(alone) == len(texts):
            return apart, counts
        ids = self.fast.encode_to_numpy("".join(compress(texts, joined)), disallowed_special=())
        ends = np.cumsum(pc.binary_length(self.a_bytes).to_numpy()[ids])
        counts[joined] = np.diff(np.searchsorted(ends, np.append(0, np.cumsum(size[joined])), side="right"))
        flat = np.empty(int(counts.sum()), np.uint32)
        mine = np.repeat(joined, counts)
        flat[mine], flat[~mine] = ids, apart
        return flat, counts

    def encode(self, entries: pa.BinaryArray) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of all distinct chunks by A and by B, and each chunk's number of them; none where one changes the bytes."""
        texts = entries.cast(pa.string()).to_pylist()
        a, n_a = self._encode_a(entries, texts)
        got = self.b.encode([t[1:] for t in texts], num_threads=1)  # which puts a space before every text but an empty one
        n_b = np.fromiter(map(len, got), np.int64, len(got))
        b = np.fromiter(chain.from_iterable(got), np.uint32, int(n_b.sum()))
        lone = np.flatnonzero(pc.binary_length(entries).to_numpy() == 1)
        if len(lone):
            b, n_b[lone] = np.insert(b, (np.cumsum(n_b) - n_b)[lone], self.b_space), 1
        same = _same(self.a_bytes, a, n_a, entries) & _same(self.b_bytes, b, n_b, entries)
        return [a[np.repeat(same, n_a)], b[np.repeat(same, n_b)]], [n_a * same, n_b * same]


def _merge_ranks(spec: dict) -> dict[bytes, int] | None:
    """Ids by bytes of a plain byte-level BPE whose merges make tokens of ascending ids; None for any other tokenizer."""
    model, before = spec["model"], spec.get("pre_tokenizer") or {}
    if (model["type"] != "BPE" or spec.get("normalizer") or before.get("type") != "ByteLevel" or before.get("add_prefix_space")
            or not before.get("use_regex", True) or model.get("ignore_merges") or model.get("dropout")):
        return None
    vocab = model["vocab"]
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    made = [vocab[x + y] for x, y in pairs]
    special = {t["content"] for t in spec.get("added_tokens", [])}
    ranks = {byte_level(t): i for t, i in vocab.items() if t not in special}
    plain = made == sorted(set(made)) and len(ranks) == 256 + len(made) and all(bytes([b]) in ranks for b in range(256))
    return ranks if plain else None


def _byte_level_table() -> dict[str, int]:
    """Byte by character of byte-level entries: printable bytes are themselves, the others follow from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    moved = sorted(set(range(256)).difference(plain))
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(moved)}


_BYTE = _byte_level_table()


def byte_level(token: str) -> bytes:
    """The bytes that a byte-level entry stands for."""
    return bytes(_BYTE[c] for c in token) if all(c in _BYTE for c in token) else token.encode()


def _piece_bytes(b, i: int) -> bytes:
    piece = b.id_to_piece(i)
    return bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("\u2581", " ").encode()


def _same(pieces: pa.BinaryArray, ids: np.ndarray, counts: np.ndarray, entries: pa.BinaryArray) -> np.ndarray:
    """Whether the joined bytes of each chunk's ids are the chunk."""
    raw = pc.take(pieces, pa.array(ids)).cast(pa.large_binary())
    offsets = np.frombuffer(raw.buffers()[1], np.int64)[:len(ids) + 1] if len(ids) else np.zeros(1, np.int64)
    joined = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(counts), [
        None, pa.py_buffer(offsets[np.append(0, np.cumsum(counts))]), raw.buffers()[2] or pa.py_buffer(b"")])
    return pc.equal(joined, entries.cast(pa.large_binary())).to_numpy(zero_copy_only=False)


# Groups and links of distinct chunks ------------------------------------------------------------------------------


@dataclass
class Aligned:
    """For each distinct chunk: tokens, groups, printed groups, and its linked pairs with their numbers of links."""

    same: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    printed: pa.LargeBinaryArray
    pairs: np.ndarray  # a << 32 | b
    links: np.ndarray
    first: np.ndarray  # of a chunk's pairs


def _counts(at: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(at, minlength=n)[:n]


def _weighed(keys: np.ndarray, more: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (key, more) in order, with the sums of their weights."""
    order = np.lexsort((more, keys))
    keys, more = keys[order], more[order]
    first = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]) | (more[1:] != more[:-1]))) if len(keys) else np.empty(0, np.int64)
    return keys[first], more[first], np.add.reduceat(weight[order], first) if len(first) else weight[:0]


def align(pair: Pair, entries: pa.BinaryArray) -> Aligned:
    ids, sizes = pair.encode(entries)
    n = len(entries)
    chunk = [np.repeat(np.arange(n), s) for s in sizes]
    same = sizes[0] > 0
    # Ends of all tokens in the joined bytes of the chunks that came back the same.
    width = [pc.binary_length(p).to_numpy()[i].astype(np.int64) for p, i in zip((pair.a_bytes, pair.b_bytes), ids, strict=True)]
    ends = [np.cumsum(w) for w in width]
    total = int(ends[0][-1]) if len(ends[0]) else 0
    common = np.zeros(total + 1, bool)
    common[ends[0]] = True
    other = np.zeros(total + 1, bool)
    other[ends[1]] = True
    common &= other
    before = np.cumsum(common)
    group = [before[e - w] for e, w in zip(ends, width, strict=True)]  # groups ended at or before a token's start
    n_all = int(before[-1])
    per = [_counts(g, n_all) for g in group]
    upto = [np.cumsum(p) for p in per]
    # Printed: A's ids of a group, then B's; a token's separator says what follows.
    place = [np.arange(len(ids[0])) + (upto[1] - per[1])[group[0]], np.arange(len(ids[1])) + upto[0][group[1]]]
    signs = [np.where(np.arange(1, len(i) + 1) == u[g], last, 0) for i, u, g, last in zip(ids, upto, group, (1, 2), strict=True)]
    shown = np.empty(len(ids[0]) + len(ids[1]), np.int64)
    for at, i, s in zip(place, ids, signs, strict=True):
        shown[at] = i.astype(np.int64) * 3 + s
    text = pc.take(pair.printed, pa.array(shown)).cast(pa.large_binary())
    offsets = np.frombuffer(text.buffers()[1], np.int64)[:len(shown) + 1] if len(shown) else np.zeros(1, np.int64)
    tokens = np.append(0, np.cumsum(sizes[0] + sizes[1]))
    printed = pa.LargeBinaryArray.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(offsets[tokens]), text.buffers()[2] or pa.py_buffer(b"")])
    groups = np.zeros(n, np.int64)
    last = np.flatnonzero(signs[0] == 1)
    groups[:] = _counts(chunk[0][last], n)
    # Links: distinct ids of a group with their counts, A's times B's.
    ga, ia, ca = _weighed(group[0], ids[0].astype(np.int64), np.ones(len(ids[0]), np.int64))
    gb, ib, cb = _weighed(group[1], ids[1].astype(np.int64), np.ones(len(ids[1]), np.int64))
    of_group = np.zeros(n_all, np.int64)
    of_group[group[0]] = chunk[0]
    b_first = np.searchsorted(gb, np.arange(n_all + 1))
    fan = np.diff(b_first)[ga]
    made: list[tuple] = []
    lo, upto_fan = 0, np.cumsum(fan)
    while lo < len(ga):
        hi = max(lo + 1, int(np.searchsorted(upto_fan, (upto_fan[lo - 1] if lo else 0) + EXPAND, side="right")))
        f = fan[lo:hi]
        left = np.repeat(np.arange(lo, hi), f)
        right = b_first[ga[left]] + np.arange(len(left)) - np.repeat(np.cumsum(f) - f, f)
        made.append(_weighed(of_group[ga[left]], ia[left] << 32 | ib[right], ca[left] * cb[right]))
        lo = hi
    if len(made) > 1:
        made = [_weighed(*(np.concatenate(c) for c in zip(*made, strict=True)))]
    at, pairs, links = made[0] if made else (np.empty(0, np.int64),) * 3
    return Aligned(same, sizes[0], sizes[1], groups, printed, pairs, links, np.searchsorted(at, np.arange(n + 1)))


# Bitmaps ------------------------------------------------------------------------------------------------------------


def _ranges(first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """first[i], first[i] + 1, ... (sizes[i] of them), one after the other."""
    return np.repeat(first - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))


def pack_postings(sizes: np.ndarray, docs: np.ndarray, links: np.ndarray, n_docs: int) -> bytes:
    """Bitmaps and planes of consecutive pairs; pair i has ``sizes[i]`` ascending documents."""
    row = (n_docs + 7) // 8
    dense = sizes * 2 > row  # a list takes two bytes a document, a bitmap a bit for every document of the block
    which = np.repeat(dense, sizes)
    bits = np.zeros((int(dense.sum()), row * 8), np.uint8)
    bits[np.repeat(np.arange(len(bits)), sizes[dense]), docs[which]] = 1
    planes = max(1, int(links.max(initial=1)).bit_length())
    parts = [docs[~which].astype("<u2").tobytes(), np.packbits(bits, axis=1).tobytes()]
    parts += [np.packbits((links >> j & 1).astype(np.uint8)).tobytes() for j in range(planes)]
    return np.array([planes, n_docs], "<u4").tobytes() + pa.compress(b"".join(parts), codec="zstd", asbytes=True)


def unpack_postings(data: bytes, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(documents, links) of ``pack_postings``."""
    planes, n_docs = np.frombuffer(data, "<u4", 2).tolist()
    row = (n_docs + 7) // 8
    dense = sizes * 2 > row
    n, few, wide = int(sizes.sum()), int(sizes[~dense].sum()), int(dense.sum())
    per = (n + 7) // 8
    raw = np.frombuffer(pa.decompress(data[8:], decompressed_size=2 * few + wide * row + planes * per, codec="zstd"), np.uint8)
    which = np.repeat(dense, sizes)
    docs = np.empty(n, np.int64)
    docs[~which] = raw[:2 * few].view("<u2")
    docs[which] = np.nonzero(np.unpackbits(raw[2 * few:2 * few + wide * row].reshape(wide, row), axis=1))[1]
    links = np.zeros(n, np.int64)
    for j in range(planes):
        at = 2 * few + wide * row + j * per
        links |= np.unpackbits(raw[at:at + per], count=n).astype(np.int64) << j
    return docs, links


def _hashed(pairs: np.ndarray) -> np.ndarray:
    h = pairs.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(40)


def _pack(*columns: np.ndarray) -> bytes:
    return pa.compress(b"".join(np.ascontiguousarray(c.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes() for c in columns),
                       codec="zstd", asbytes=True)


def _unpack(data: bytes, n: int, columns: int) -> list[np.ndarray]:
    raw = np.frombuffer(pa.decompress(data, decompressed_size=8 * n * columns, codec="zstd"), np.uint8)
    return [np.ascontiguousarray(p.reshape(8, n).T).view("<i8").reshape(n) for p in raw.reshape(columns, 8 * n)]


# Spark --------------------------------------------------------------------------------------------------------------


_INDEX_ARROW = pa.schema([("kind", pa.string()), ("block", pa.int64()), ("pos", pa.int32()), ("doc_id", pa.int64()), ("n_a", pa.int64()),
                          ("n_b", pa.int64()), ("n_groups", pa.int64()), ("groups_sha256", pa.string()), ("shard", pa.int32()),
                          ("n", pa.int64()), ("pairs", pa.binary()), ("postings", pa.binary())])


def _rows(**columns) -> pa.RecordBatch:
    n = len(next(iter(columns.values())))
    return pa.RecordBatch.from_arrays([columns[f.name] if isinstance(columns.get(f.name), pa.Array) else
                                       pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type)
                                       for f in _INDEX_ARROW], schema=_INDEX_ARROW)


class _Block:
    """Documents and (pair, document, links) entries of a block that is not yet full."""

    def __init__(self) -> None:
        self.docs, self.size, self.entries = 0, 0, []

    def add(self, pairs: np.ndarray, docs: np.ndarray, links: np.ndarray, n: int) -> None:
        self.entries.append((pairs, (docs + self.docs).astype(np.uint16), links))
        self.docs, self.size = self.docs + n, self.size + len(pairs)

    def rows(self, block: int, shards: int) -> Iterator[pa.RecordBatch]:
        pairs, docs, links = (np.concatenate(c) for c in zip(*self.entries, strict=True))
        order = np.argsort(pairs, kind="stable")  # documents ascend within a pair
        pairs, docs, links = pairs[order], docs[order].astype(np.int64), links[order]
        first = np.flatnonzero(np.append(True, pairs[1:] != pairs[:-1])) if len(pairs) else np.empty(0, np.int64)
        sizes = np.diff(np.append(first, len(pairs)))
        keys = pairs[first]
        shard = (_hashed(keys) % np.uint64(shards)).astype(np.int64)
        for s in np.unique(shard).tolist():
            mine = np.flatnonzero(shard == s)
            at = _ranges(first[mine], sizes[mine])
            yield _rows(kind=["pairs"], block=[block], shard=[s], n=[len(mine)], pairs=[_pack(keys[mine], sizes[mine])],
                        postings=[pack_postings(sizes[mine], docs[at], links[at], self.docs)])


def _document_links(got: Aligned, codes: np.ndarray, text: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(pair, document, links) of a slice's documents, distinct, documents ascending within equal pairs."""
    key, times = np.unique(text * len(got.same) + codes, return_counts=True)
    doc, code = key // len(got.same), key % len(got.same)
    sizes = np.diff(got.first)[code]
    at = _ranges(got.first[code], sizes)
    distinct, which = np.unique(got.pairs, return_inverse=True)
    entry = which[at] * n + np.repeat(doc, sizes)
    order = np.argsort(entry, kind="stable")
    entry, links = entry[order], (got.links[at] * np.repeat(times, sizes))[order]
    first = np.flatnonzero(np.append(True, entry[1:] != entry[:-1])) if len(entry) else np.empty(0, np.int64)
    links = np.add.reduceat(links, first) if len(first) else links
    return distinct[entry[first] // n], entry[first] % n, links


_PAIRS: dict[int, Pair] = {}


def _tokenizers(a_json: str, b_model: bytes) -> Pair:
    key = hash((a_json, b_model))
    if key not in _PAIRS:
        _PAIRS.clear()
        _PAIRS[key] = Pair(a_json, b_model)
    return _PAIRS[key]


def index(docs: DataFrame, a_path: str, b_path: str, *, id_col: str, text_col: str) -> DataFrame:
    """Rows of documents (tokens, groups) and of bitmaps (for each block and shard of pairs), written."""
    spark = docs.sparkSession
    with open(a_path, encoding="utf-8") as fa, open(b_path, "rb") as fb:
        files = spark.sparkContext.broadcast((fa.read(), fb.read()))  # a few MB
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("_text"))
    size = rows.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    shards = max(1, -(-size // SHARD_BYTES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        pair, held = _tokenizers(*files.value), _Block()
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in slices(batch, "_text", SLICE_BYTES):
                n = part.num_rows
                if held.docs and (held.size >= BLOCK_LINKS or held.docs + n > BLOCK_DOCS):
                    yield from held.rows(block, shards)
                    held, block = _Block(), block + 1
                codes, first, entries = chunks(part.column(1))
                got = align(pair, entries)
                text = np.repeat(np.arange(n), np.diff(first))
                length = pc.fill_null(pc.binary_length(part.column(1)), 0).to_numpy(zero_copy_only=False)
                whole = (length > 0) & np.logical_and.reduceat(got.same[codes], first[:-1])
                sums = [np.where(whole, np.add.reduceat(x[codes], first[:-1]), 0) for x in (got.n_a, got.n_b, got.n_groups)]
                shown = pc.take(got.printed, pa.array(codes))
                raw, offsets = memoryview(shown.buffers()[2] or b""), np.frombuffer(shown.buffers()[1], np.int64)[first]
                digest = [hashlib.sha256(raw[a:b - 1]).hexdigest() if w else ""
                          for a, b, w in zip(offsets[:-1].tolist(), offsets[1:].tolist(), whole.tolist(), strict=True)]
                yield _rows(kind=["doc"] * n, block=np.full(n, block), pos=np.arange(held.docs, held.docs + n, dtype=np.int32),
                            doc_id=part.column(0), n_a=sums[0], n_b=sums[1], n_groups=sums[2], groups_sha256=digest)
                keep = whole[text]
                held.add(*_document_links(got, codes[keep], text[keep], n), n)
        if held.docs:
            yield from held.rows(block, shards)

    return staged(rows.mapInArrow(run, INDEX))


def pair_counts(indexed: DataFrame) -> DataFrame:
    """(shard, a, b, n_docs, best): documents that link each id pair, and whether no pair of its A id has more."""
    def add(key: tuple, table: pa.Table) -> pa.Table:
        parts = [_unpack(d, n, 2) for n, d in zip(table.column("n").to_pylist(), table.column("pairs").to_pylist(), strict=True)]
        pairs, sizes = (np.concatenate(c) for c in zip(*parts, strict=True))
        pairs, at = np.unique(pairs, return_inverse=True)
        total = np.zeros(len(pairs), np.int64)
        np.add.at(total, at, sizes)
        return pa.table({"shard": pa.array(np.full(len(pairs), key[0].as_py(), np.int32)), "a": pairs >> 32, "b": pairs & 0xFFFFFFFF,
                         "n_docs": total})

    rows = staged(indexed.where("kind = 'pairs'").select("shard", "n", "pairs").groupBy("shard")
                  .applyInArrow(add, "shard int, a long, b long, n_docs long"))
    most = rows.groupBy("a").agg(F.max("n_docs").alias("_most"))  # a row for each id of A's vocabulary
    return rows.join(F.broadcast(most), "a").select("shard", "a", "b", "n_docs", (F.col("n_docs") == F.col("_most")).alias("best"))


def pair_links(indexed: DataFrame) -> DataFrame:
    """(a, b, n_docs, n_links): documents and links of each id pair, from popcounts of its bitmaps and of their planes."""
    def add(key: tuple, table: pa.Table) -> pa.Table:
        found: list[tuple] = []
        for n, p, d in zip(*(table.column(c).to_pylist() for c in ("n", "pairs", "postings")), strict=True):
            pairs, sizes = _unpack(p, n, 2)
            _, links = unpack_postings(d, sizes)
            found.append((pairs, sizes, np.add.reduceat(links, np.cumsum(sizes) - sizes)))
        pairs, sizes, links = (np.concatenate(c) for c in zip(*found, strict=True))
        pairs, at = np.unique(pairs, return_inverse=True)
        totals = [np.zeros(len(pairs), np.int64) for _ in range(2)]
        np.add.at(totals[0], at, sizes)
        np.add.at(totals[1], at, links)
        return pa.table({"a": pairs >> 32, "b": pairs & 0xFFFFFFFF, "n_docs": totals[0], "n_links": totals[1]})

    rows = indexed.where("kind = 'pairs'").select("shard", "n", "pairs", "postings")
    return rows.groupBy("shard").applyInArrow(add, "a long, b long, n_docs long, n_links long")


def _block_scores(indexed: DataFrame, counts: DataFrame) -> DataFrame:
    """(block, shard, scores): for every pair of a block, twice its count, and one more if it is a best one."""
    def give(key: tuple, blocks: pa.Table, table: pa.Table) -> pa.Table:
        if not blocks.num_rows:
            return pa.table({"block": pa.array([], pa.int64()), "shard": pa.array([], pa.int32()), "scores": pa.array([], pa.binary())})
        pairs = table.column("a").to_numpy() << 32 | table.column("b").to_numpy()
        value = table.column("n_docs").to_numpy() * 2 + table.column("best").to_numpy().astype(np.int64)
        order = np.argsort(pairs)
        pairs, value = pairs[order], value[order]
        out = [_pack(value[np.searchsorted(pairs, _unpack(d, n, 2)[0])])
               for n, d in zip(blocks.column("n").to_pylist(), blocks.column("pairs").to_pylist(), strict=True)]
        return pa.table({"block": blocks.column("block"), "shard": blocks.column("shard"), "scores": pa.array(out, pa.binary())})

    held = indexed.where("kind = 'pairs'").select("shard", "block", "n", "pairs")
    return held.groupBy("shard").cogroup(counts.groupBy("shard")).applyInArrow(give, "block long, shard int, scores binary")


def scores(indexed: DataFrame) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every document."""
    def give(key: tuple, held: pa.Table, given: pa.Table) -> pa.Table:
        docs = held.filter(pc.equal(held.column("kind"), "doc"))
        maps = held.filter(pc.equal(held.column("kind"), "pairs"))
        value = dict(zip(given.column("shard").to_pylist(), given.column("scores").to_pylist(), strict=True))
        totals = np.zeros((3, docs.num_rows), np.int64)
        for shard, n, p, d in zip(*(maps.column(c).to_pylist() for c in ("shard", "n", "pairs", "postings")), strict=True):
            sizes = _unpack(p, n, 2)[1]
            at, links = unpack_postings(d, sizes)
            v = np.repeat(_unpack(value[shard], n, 1)[0], sizes)
            for row, x in zip(totals, (links, links * (v & 1), links * (v >> 1)), strict=True):
                np.add.at(row, at, x)
        totals = totals[:, docs.column("pos").to_numpy()]
        return pa.table({**{c: docs.column(c) for c in ("doc_id", "n_a", "n_b", "n_groups")}, "n_links": totals[0], "n_best": totals[1],
                         "count_sum": totals[2], "groups_sha256": docs.column("groups_sha256")})

    given = _block_scores(indexed, pair_counts(indexed))
    return indexed.groupBy("block").cogroup(given.groupBy("block")).applyInArrow(
        give, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")
