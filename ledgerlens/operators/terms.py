"""1-2-gram terms of whole Arrow batches (G5-G7), for use inside tasks.

Texts come without nulls and in any case; words are runs of two or more of [a-z0-9] of the text in lower case, as ``clean_text`` and
``tokens`` find them. Words become numbers first, so a bigram is a pair of numbers and only the distinct terms of a batch are ever written out as text.
Every function that tasks run is built inside another one: tasks carry its code and import nothing of this package.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE_BYTES = 8 << 20  # bytes of text that are worked on at once, at most (one text may be longer)


def _splitter(most: int):
    """(pieces of an array of texts of at most ``most`` bytes each with their bytes, words of texts with their rows)."""

    def pieces(texts: pa.Array) -> Iterator[tuple[pa.Array, int]]:
        ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
        a = 0
        while a < len(texts):
            before = ends[a - 1] if a else 0
            b = max(a + 1, int(np.searchsorted(ends, before + most, side="right")))
            yield texts.slice(a, b - a), int(ends[b - 1] - before)
            a = b

    plain = np.full(256, ord(" "), dtype=np.uint8)  # every other byte, also those of longer characters, parts words
    for ch in b"abcdefghijklmnopqrstuvwxyz0123456789":
        plain[ch] = ch
    for ch in b"ABCDEFGHIJKLMNOPQRSTUVWXYZ":
        plain[ch] = ch + 32
    others = (("\u0130", "i\u0307"), ("\u212a", "k"))  # no other character's lower case holds any of [a-z0-9]

    def words(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
        texts = texts.cast(pa.large_string())
        for upper, lower in others:
            if pc.any(pc.match_substring(texts, upper)).as_py():
                texts = pc.replace_substring(texts, upper, lower)
        _, at, data = texts.buffers()
        at = np.frombuffer(at, dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
        clean = plain[np.frombuffer(data or b"", dtype=np.uint8)[at[0]:at[-1]]] if len(at) else np.empty(0, dtype=np.uint8)
        texts = pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(np.ascontiguousarray(at - at[:1])), pa.py_buffer(clean))
        lists = pc.ascii_split_whitespace(texts)
        row = np.repeat(np.arange(len(texts)), lists.value_lengths().to_numpy(zero_copy_only=False))
        flat = lists.flatten()
        long = pc.greater_equal(pc.binary_length(flat), 2)
        return row[long.to_numpy(zero_copy_only=False)], flat.filter(long)

    return pieces, words


def term_counter(n_max: int = 2, most: int = PIECE_BYTES, widest: int = 1 << 62):
    """For ``mapInArrow`` over one column of texts: (term, count, df) of every piece of them, each term once a piece.

    A term's number and its row are sorted as one number, up to ``widest``."""
    pieces, words = _splitter(most)

    def distinct(row, code):
        """(distinct codes, occurrences, rows that hold them)."""
        n = int(row[-1]) + 1 if len(row) else 1
        if len(code) and int(code.max()) < widest // n:
            key = np.sort(code * n + row)
            code = key // n
            first = np.flatnonzero(np.diff(code, prepend=-1))
            return code[first], np.diff(first, append=len(key)), np.add.reduceat(np.diff(key, prepend=-1) != 0, first, dtype=np.int64)
        d = pa.array(code).dictionary_encode()
        at, k = d.indices.to_numpy(zero_copy_only=False).astype(np.int64), len(d.dictionary)
        once = pc.unique(pa.array(row * max(k, 1) + at)).to_numpy(zero_copy_only=False) % max(k, 1)
        return d.dictionary.to_numpy(zero_copy_only=False), np.bincount(at, minlength=k), np.bincount(once, minlength=k)

    def counted(texts: pa.Array) -> Iterator[pa.RecordBatch]:
        row, flat = words(texts)
        known = flat.dictionary_encode()
        code, lexicon = known.indices.to_numpy(zero_copy_only=False).astype(np.int64), known.dictionary.cast(pa.string())
        got = [(lambda c, n, d: (lexicon.take(pa.array(c)), n, d))(*distinct(row, code))]
        if n_max >= 2:
            same, v = row[1:] == row[:-1], max(len(lexicon), 1)
            c, n, d = distinct(row[1:][same], (code[:-1] * v + code[1:])[same])
            got.append((pc.binary_join_element_wise(lexicon.take(pa.array(c // v)), lexicon.take(pa.array(c % v)), " "), n, d))
        for term, n, d in got:
            out = pa.RecordBatch.from_arrays([term, pa.array(n, pa.int64()), pa.array(d, pa.int64())], names=["term", "n", "d"])
            for a in range(0, len(out), 1 << 16):
                yield out.slice(a, 1 << 16)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for part, n in pieces(batch.column(0)):
                if held and size + n > most:
                    yield from counted(pa.concat_arrays(held))
                    held, size = [], 0
                held.append(part)
                size += n
        if held:
            yield from counted(pa.concat_arrays(held))

    return run


def vectoriser(terms: list[str], idf: list[float], n_max: int = 2, most: int = PIECE_BYTES):
    """For ``arrow_udf`` over texts: sparse ML vectors of term counts times idf, of unit length (or without entries)."""
    pieces, words = _splitter(most)
    parts = [(t.split(" "), i) for i, t in enumerate(terms)]
    parts = [(p, i) for p, i in parts if len(p) <= min(n_max, 2)]
    known = sorted({w for p, _ in parts for w in p})
    at, m, v = {w: k for k, w in enumerate(known)}, len(terms), len(known)
    single = np.full(v + 1, -1, dtype=np.int64)  # the last entry is that of unknown words (-1)
    for p, i in parts:
        if len(p) == 1:
            single[at[p[0]]] = i
    pairs = np.array(sorted((at[p[0]] * v + at[p[1]], i) for p, i in parts if len(p) == 2), dtype=np.int64).reshape(-1, 2)
    keys, to, weight, lexicon = pairs[:, 0].copy(), pairs[:, 1].copy(), np.asarray(idf, dtype=float), pa.array(known, pa.string())

    def vectors(texts: pa.Array) -> pa.Array:
        n = len(texts)
        row, flat = words(texts)
        code = pc.fill_null(pc.index_in(flat, value_set=lexicon.cast(flat.type)), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        one = single[code]
        cells = [(row * m + one)[one >= 0]]
        if len(keys):
            ok = (code[:-1] >= 0) & (code[1:] >= 0) & (row[:-1] == row[1:])
            key = (code[:-1] * v + code[1:])[ok]
            pos = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            cells.append((row[1:][ok] * m + to[pos])[keys[pos] == key])
        cell, tf = np.unique(np.concatenate(cells), return_counts=True)
        r, i = cell // max(m, 1), cell % max(m, 1)
        w = tf * weight[i]
        norm = np.sqrt(np.bincount(r, weights=w * w, minlength=n))
        w = w / np.where(norm > 0, norm, 1.0)[r]
        ends = np.concatenate([[0], np.cumsum(np.bincount(r, minlength=n))]).astype(np.int32)
        return pa.StructArray.from_arrays(
            [pa.array(np.zeros(n, dtype=np.int8)), pa.array(np.full(n, m, dtype=np.int32)),
             pa.ListArray.from_arrays(ends, pa.array(i.astype(np.int32))), pa.ListArray.from_arrays(ends, pa.array(w))],
            names=["type", "size", "indices", "values"])

    def run(texts: pa.Array) -> pa.Array:
        return pa.concat_arrays([vectors(part) for part, _ in pieces(texts)] or [vectors(texts)])

    return run
