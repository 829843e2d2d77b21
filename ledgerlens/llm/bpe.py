"""Byte-level BPE encoding and decoding without regular expressions.

Pre-tokenisation follows the public pattern

    's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+

as a finite automaton. Each code point gets a class (lookaheads are folded into
the class), each class is a transition function on eight states, and function
composition is associative: blocks of the text compose their functions side by
side, a doubling scan over the blocks gives every block its start state, and a
second pass marks the token starts. The slices found go through a cache of
merged pairs; slices not yet seen are merged in lockstep, many at a time.

Null text counts as empty and gives no ids. Repeated rows are encoded alike, row
by row; extra columns are dropped unless named in ``keep``.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import sys
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import codepoints, slices, texts_of

# Classes of code points after the lookahead is folded in.
L, N, O, SP_LAST, WS_LAST, WS_MID, AP2, AP3, RESET = range(9)
# States: what the scan is inside of. BREAK: the next character starts a token.
BREAK, IN_L, IN_N, IN_O, AFTER_SP, IN_WS, ONE_LEFT, TWO_LEFT = range(8)
BLOCK = 128
CACHE_LIMIT = 300_000
LONG_PIECE = 48  # bytes; longer slices are merged one by one with a heap


def _automaton() -> tuple[np.ndarray, np.ndarray]:
    """next_state[class * 8 + state] and starts[class * 8 + state]."""
    nxt, start = np.zeros((9, 8), np.uint8), np.ones((9, 8), bool)
    for s in range(8):
        for cls, own in ((L, IN_L), (N, IN_N), (O, IN_O)):
            nxt[cls, s], start[cls, s] = own, s not in (own, AFTER_SP)
        for cls, left in ((AP2, ONE_LEFT), (AP3, TWO_LEFT)):
            inside = s in (IN_O, AFTER_SP)
            nxt[cls, s], start[cls, s] = (IN_O if inside else left), not inside
        nxt[SP_LAST, s], nxt[WS_LAST, s], nxt[RESET, s] = AFTER_SP, BREAK, BREAK
        nxt[WS_MID, s], start[WS_MID, s] = IN_WS, s != IN_WS
    for cls in (L, N, O, AP2, AP3):
        nxt[cls, TWO_LEFT], start[cls, TWO_LEFT] = ONE_LEFT, False
        nxt[cls, ONE_LEFT], start[cls, ONE_LEFT] = BREAK, False
    return nxt.ravel(), start.ravel()


NEXT, STARTS = _automaton()


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """Class of every code point: L, N, WS_MID for white space, O for all others."""
    table = np.full(sys.maxunicode + 1, O, np.uint8)
    for i in range(sys.maxunicode + 1):
        major = unicodedata.category(chr(i))[0]
        if major == "L":
            table[i] = L
        elif major == "N":
            table[i] = N
    # The code points with the Unicode property White_Space.
    for lo, hi in ((9, 13), (32, 32), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680), (0x2000, 0x200A),
                   (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000)):
        table[lo:hi + 1] = WS_MID
    return table


def classify(cp: np.ndarray, resets: np.ndarray) -> np.ndarray:
    """Classes of a text's code points; ``resets`` are positions of separators between documents."""
    cls = _classes()[cp]
    cls[resets] = RESET
    space = (cls == WS_MID)
    more = np.zeros(len(cp), bool)  # the next character is no white space and the text goes on
    if len(cp) > 1:
        more[:-1] = ~(space[1:] | (cls[1:] == RESET))
    last = space & more
    ap = np.flatnonzero((cp == 39) & more)
    if len(ap):
        pad = np.concatenate([cp, np.zeros(2, np.uint32)])
        a, b = pad[ap + 1], pad[ap + 2]
        one = (a == 115) | (a == 116) | (a == 109) | (a == 100)  # s t m d
        two = ((a == 114) | (a == 118)) & (b == 101) | (a == 108) & (b == 108)  # re ve ll
        inside = np.concatenate([cls, np.full(2, RESET, np.uint8)])[ap + 2] != RESET
        cls[ap[one]] = AP2
        cls[ap[two & inside]] = AP3
    cls[last] = WS_LAST
    cls[last & (cp == 32)] = SP_LAST
    return cls


def token_starts(cls: np.ndarray) -> np.ndarray:
    """Boolean: a token starts at this position (separators count as starts of nothing)."""
    n = len(cls)
    blocks = max(1, -(-n // BLOCK))
    grid = np.full(blocks * BLOCK, RESET, np.uint8)
    grid[:n] = cls
    cols = np.ascontiguousarray(grid.reshape(blocks, BLOCK).T).astype(np.int32) * 8
    # Each block's function: where every state ends up after the block.
    f = np.broadcast_to(np.arange(8, dtype=np.uint8), (blocks, 8)).copy()
    for c in cols:
        f = NEXT.take(c[:, None] + f)
    # Doubling scan: f[i] becomes the composition of blocks 0..i.
    step = 1
    while step < blocks:
        f[step:] = np.take_along_axis(f[step:], f[:-step].astype(np.intp), axis=1)
        step *= 2
    state = np.empty(blocks, np.uint8)
    state[0], state[1:] = BREAK, f[:-1, BREAK]
    out = np.empty((BLOCK, blocks), bool)
    for j, c in enumerate(cols):
        k = c + state
        out[j] = STARTS.take(k)
        state = NEXT.take(k)
    starts = out.T.reshape(-1)[:n]
    return starts & (cls != RESET)


class Merger:
    """Byte pair merging by rank with a cache of slices; ids equal ranks."""

    def __init__(self, rank_file: bytes):
        pairs = (line.split() for line in rank_file.splitlines() if line.strip())
        self.ranks = {base64.b64decode(a): int(b) for a, b in pairs}
        self.tokens = {i: t for t, i in self.ranks.items()}
        self.byte_id = np.array([self.ranks[bytes([b])] for b in range(256)], np.int64)
        self.base = max(self.tokens) + 1
        keys, vals = [], []
        get = self.ranks.get
        for t, r in self.ranks.items():
            for i in range(1, len(t)):
                a, b = get(t[:i]), get(t[i:])
                if a is not None and b is not None:
                    keys.append(a * self.base + b)
                    vals.append(r)
        order = np.argsort(np.array(keys, np.int64))
        self.keys, self.vals = np.array(keys, np.int64)[order], np.array(vals, np.int64)[order]
        self.cache: dict[str, bytes] = {}
        self.first = np.full((256, 256), self.base, np.int64)  # ranks of pairs of bytes
        for t, r in self.ranks.items():
            if len(t) == 2:
                self.first[t[0], t[1]] = r

    def _rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the pair (a, b), ``base`` where they don't merge or one is a pad (-1)."""
        k = a * self.base + b
        i = np.minimum(np.searchsorted(self.keys, k), len(self.keys) - 1)
        return np.where((self.keys[i] == k) & (a >= 0) & (b >= 0), self.vals[i], self.base)

    def _lockstep(self, words: list[bytes]) -> list[bytes]:
        """Ids of words of one padded width; each round merges every word's best pair."""
        n, lens = len(words), np.array([len(w) for w in words])
        width = int(lens.max())
        raw = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(n, width)
        live = np.arange(width) < lens[:, None]
        ids = np.where(live, self.byte_id[raw], -1)
        ranks = np.full((n, width), self.base, np.int64)
        if width > 1:
            ranks[:, :-1] = np.where(live[:, 1:], self.first[raw[:, :-1], raw[:, 1:]], self.base)
        done: list[bytes] = [b""] * n
        rows, at = np.arange(n), np.arange(width)
        while True:
            j = ranks.argmin(axis=1)
            best = ranks[np.arange(len(rows)), j]
            open_ = best < self.base
            if not open_.all():
                for r, line in zip(rows[~open_].tolist(), ids[~open_], strict=True):
                    done[r] = line[line >= 0].astype("<u4").tobytes()
                rows, ids, ranks, j, best = rows[open_], ids[open_], ranks[open_], j[open_], best[open_]
                if not len(rows):
                    return done
            k = np.arange(len(rows))
            ids[k, j] = best
            shift = np.minimum(at + (at > j[:, None]), width - 1)
            ids = np.take_along_axis(ids, shift, axis=1)
            ranks = np.take_along_axis(ranks, shift, axis=1)
            ids[:, -1], ranks[:, -1] = -1, self.base
            right = np.where(j + 1 < width, ids[k, np.minimum(j + 1, width - 1)], -1)
            ranks[k, j] = self._rank(best, right)
            left = j > 0
            ranks[k[left], j[left] - 1] = self._rank(ids[k[left], j[left] - 1], best[left])

    def _one(self, word: bytes) -> bytes:
        """A long slice: linked list and heap, time n log n."""
        ids = [int(x) for x in self.byte_id[np.frombuffer(word, np.uint8)]]
        n, get = len(ids), self.ranks.get
        tok = self.tokens
        nxt, prv, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n

        def rank(i: int) -> int | None:
            return get(tok[ids[i]] + tok[ids[nxt[i]]]) if nxt[i] < n else None

        heap = [(r, i, ids[i], ids[i + 1]) for i in range(n - 1) if (r := rank(i)) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            if not alive[i] or ids[i] != a or nxt[i] >= n or ids[nxt[i]] != b:
                continue
            j = nxt[i]
            ids[i], alive[j], nxt[i] = r, False, nxt[j]
            if nxt[i] < n:
                prv[nxt[i]] = i
            for p in (i, prv[i]):
                if p >= 0 and (q := rank(p)) is not None:
                    heapq.heappush(heap, (q, p, ids[p], ids[nxt[p]]))
        return np.array([x for x, ok in zip(ids, alive, strict=True) if ok], "<u4").tobytes()

    def merge(self, words: list[str]) -> dict[str, bytes]:
        """Put the ids of ``words`` into the cache; returns those of long slices, which aren't kept."""
        if len(self.cache) + len(words) > CACHE_LIMIT:
            self.cache.clear()
        long: dict[str, bytes] = {}
        by_width: dict[int, list[tuple[str, bytes]]] = {}
        for w in words:
            b = w.encode()
            if (r := self.ranks.get(b)) is not None:
                self.cache[w] = r.to_bytes(4, "little")
            elif len(b) > LONG_PIECE:
                long[w] = self._one(b)
            else:
                by_width.setdefault(-(-len(b) // 4), []).append((w, b))
        for group in by_width.values():
            for i in range(0, len(group), 8192):
                part = group[i:i + 8192]
                for (w, _), ids in zip(part, self._lockstep([b for _, b in part]), strict=True):
                    self.cache[w] = ids
        return long

    def encode(self, texts: list[str]) -> Iterator[tuple[bytes, bytes]]:
        """(ids, piece starts) of each text, both little-endian unsigned 32-bit."""
        joined = "\n".join(texts)
        ends = np.cumsum(np.array([len(t) for t in texts], np.int64) + 1) - 1
        begins = np.concatenate([[0], ends[:-1] + 1])
        cp = codepoints(joined)
        starts = np.flatnonzero(token_starts(classify(cp, ends[:-1]))) if len(cp) else np.zeros(0, np.int64)
        stops = np.append(starts[1:], len(cp))[:len(starts)]
        first = np.searchsorted(starts, begins)
        last = np.concatenate([first[1:], [len(starts)]])
        final = last[last > first] - 1  # a document's last slice ends with the document, before the separator
        stops[final] = ends[last > first]
        pieces = [joined[a:b] for a, b in zip(starts.tolist(), stops.tolist(), strict=True)]
        found = list(map(self.cache.get, pieces))
        if None in found:
            long = self.merge(list({p for p, f in zip(pieces, found, strict=True) if f is None}))
            look = self.cache.get
            found = [f if f is not None else look(p) or long[p] for p, f in zip(pieces, found, strict=True)]
        for a, b, at in zip(first.tolist(), last.tolist(), begins.tolist(), strict=True):
            yield b"".join(found[a:b]), (starts[a:b] - at).astype("<u4").tobytes()


    def decode(self, ids: bytes) -> bytes:
        """The bytes of little-endian unsigned 32-bit ids."""
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_MERGERS: dict[int, Merger] = {}


def _merger(rank_file: bytes) -> Merger:
    key = hash(rank_file)
    if key not in _MERGERS:
        _MERGERS.clear()
        _MERGERS[key] = Merger(rank_file)
    return _MERGERS[key]


def _ranks(df: DataFrame, rank_path: str):
    with open(rank_path, "rb") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def encode(docs: DataFrame, rank_path: str, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",),
           digest: str | None = None) -> DataFrame:
    """One row per input row: the kept columns, ``ids`` and ``piece_starts``.

    Both are little-endian unsigned 32-bit integers in a binary: token ids, and
    for each slice its first code point in the text. The rank file (under a
    megabyte, read on the driver) is broadcast; texts are never cut. ``digest`` names one more column, the SHA-256 of
    the ids decoded again by the same worker.
    """
    ranks = _ranks(docs, rank_path)
    src = docs.select(*keep, F.col(text_col).alias("_text"))
    schema = docs.select(*keep).schema.add("ids", "binary").add("piece_starts", "binary")
    if digest:
        schema = schema.add(digest, "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = _merger(ranks.value)
        try:
            for batch in batches:
                for part in slices(batch, "_text"):
                    got = list(m.encode(texts_of(part, "_text")))
                    cols = [part.column(i) for i in range(len(keep))]
                    cols += [pa.array([g[0] for g in got], pa.binary()), pa.array([g[1] for g in got], pa.binary())]
                    if digest:
                        cols.append(pa.array([hashlib.sha256(m.decode(g[0])).hexdigest() for g in got]))
                    yield pa.RecordBatch.from_arrays(cols, names=schema.names)
        finally:
            m.cache.clear()  # the worker lives on; the next task may be another operator's

    return src.mapInArrow(run, schema)


def slice_bytes(decoded: bytes, ids: np.ndarray, widths: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """First byte of each slice in the decoded text, from its first code point; each must be the first byte of a token."""
    raw = np.frombuffer(decoded, np.uint8)
    first = np.flatnonzero((raw & 0xC0) != 0x80)[starts]  # of each code point: not a continuation byte
    ends = np.cumsum(widths[ids])
    if len(first) and not np.isin(first[1:], ends).all():
        raise ValueError("a slice begins inside a token")
    return first


def decode(encoded: DataFrame, rank_path: str, ids_col: str = "ids", keep: tuple[str, ...] = ("doc_id",),
           starts_col: str | None = None) -> DataFrame:
    """One row per input row: the kept columns and ``decoded``, the bytes of the ids (null ids: empty).

    With ``starts_col`` (``encode``'s piece_starts) also ``slice_starts``: the first byte of each slice in ``decoded``, as
    little-endian unsigned 32-bit integers, so that a slice's text and tokens can be cut out; a slice that does not begin
    with a token is an error.
    """
    ranks = _ranks(encoded, rank_path)
    src = encoded.select(*keep, F.col(ids_col).alias("_ids"), *([F.col(starts_col).alias("_starts")] if starts_col else []))
    schema = encoded.select(*keep).schema.add("decoded", "binary")
    if starts_col:
        schema = schema.add("slice_starts", "binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = _merger(ranks.value)
        tokens = m.tokens
        widths = np.zeros(max(tokens) + 1, np.int64)
        widths[list(tokens)] = list(map(len, tokens.values()))
        for batch in batches:
            for part in slices(batch, "_ids"):
                raw = [x or b"" for x in part.column(len(keep)).to_pylist()]
                out = list(map(m.decode, raw))
                cols = [*(part.column(i) for i in range(len(keep))), pa.array(out, pa.binary())]
                if starts_col:
                    at = [np.frombuffer(x or b"", "<u4") for x in part.column(len(keep) + 1).to_pylist()]
                    cols.append(pa.array([slice_bytes(d, np.frombuffer(x, "<u4"), widths, a).astype("<u4").tobytes()
                                          for d, x, a in zip(out, raw, at, strict=True)],
                                         pa.binary()))
                yield pa.RecordBatch.from_arrays(cols, names=schema.names)

    return src.mapInArrow(run, schema)
