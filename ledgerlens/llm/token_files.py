"""Token ids in ORC files: run-length encoded integers, row indexes, Bloom filters on document ids.

Documents are dealt out by ranges of their id and sorted within each range, so
files follow each other in ascending id order. A row holds the id, the ids of its
text with the end id, and where they start among the ids of its range; ranges'
totals (as many numbers as files) turn that into a start among all ids. Readers
take single stripes in parallel, skip stripes and row groups by the id's minimum
and maximum, and skip row groups whose Bloom filter lacks a looked-up id.

Texts are encoded at white space apart: the tokenizer drops white space, so the words' ids in order are the text's ids.
A task dictionary-encodes the words of a slice of texts, encodes distinct words only (with a cache), and gathers ids by code.
Null text counts as empty: the end id alone. Rows without an id come first;
repeated ids follow each other, ordered by text. Extra columns are not written.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator
from itertools import chain
from struct import pack
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import slices
from ledgerlens.llm.words import dictionary, split_words, text_bytes

SLICE_BYTES = 4 << 20  # of text that a task holds as words at once
CACHE_LIMIT = 250_000  # words of a generation of the cache; it has two
LONG_WORD = 64  # bytes; longer words are not kept in the cache
STRIPE_BYTES = 32 << 20
_TAIL = bytes(c for c in range(33, 127) if not chr(c).isalnum())
ROW_GROUP = 1000  # rows of a row group, the unit that indexes and Bloom filters skip
SCHEMA = "doc_id long, part int, start_in_part long, n_tokens long, ids array<int>"


def _table(kind: bytes) -> np.ndarray:
    t = np.zeros(256, bool)
    t[list(kind)] = True
    return t


_IS_LETTER, _IS_TAIL = _table(bytes(range(ord("a"), ord("z") + 1))), _table(_TAIL)


def _ranges(first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """first[i], first[i] + 1, ... (sizes[i] of them), one after the other."""
    return np.repeat(first - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))


def _word_ranks(spec: dict) -> dict[bytes, int] | None:
    """Ids by bytes of a byte-level BPE with word ends, a space standing for the end; None for any other tokenizer.

    Words hold no spaces. The ids of single bytes with a word end come before those of merges, as the merges' ids
    come in their order, so joining by the smallest id joins as the tokenizer does.
    """
    from ledgerlens.llm.alignment import byte_level

    model = spec["model"]
    if (model["type"] != "BPE" or model.get("end_of_word_suffix") != "</w>" or model.get("continuing_subword_prefix")
            or model.get("ignore_merges") or model.get("dropout")):
        return None
    vocab = model["vocab"]
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    made = [vocab[x + y] for x, y in pairs]
    special = {t["content"] for t in spec.get("added_tokens", [])}
    ranks = {byte_level(t.removesuffix("</w>")) + b" " * t.endswith("</w>"): i for t, i in vocab.items() if t not in special}
    single = [bytes([b]) + e for b in range(256) for e in (b"", b" ")]
    plain = (made == sorted(set(made)) and len(ranks) == 512 + len(made) and all(b in ranks for b in single)
             and max(ranks[b] for b in single) < made[0])
    return ranks if plain else None


class WordEncoder:
    """Ids of whole texts by the tokenizers library, distinct word by distinct word.

    Where the tokenizer's file is a plain byte-level BPE with word ends, words of the letters a to z, with ASCII punctuation behind
    them or not, are encoded as one text by tiktoken with the same ids. Other words go through the library and a cache.

    The tokenizer's own rules make a word of letters one piece and a run of
    punctuation another, so a word not seen yet is encoded without its trailing ASCII
    punctuation, which is encoded apart. A word that is all letters, composed and
    in lower case is left as it is by the normalizer and the splitter; it goes
    through the same model without them. All other words go through the whole tokenizer.
    """

    def __init__(self, tokenizer_json: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        import tiktoken

        ranks = _word_ranks(json.loads(tokenizer_json))
        self.fast = tiktoken.Encoding("words", pat_str="[^ ]+ ", mergeable_ranks=ranks, special_tokens={}) if ranks else None
        self.ends = np.zeros(1 + max(ranks.values()), bool) if ranks else None
        if ranks:
            self.ends[[i for b, i in ranks.items() if b.endswith(b" ")]] = True
        self.whole = Tokenizer.from_str(tokenizer_json)
        self.letters = Tokenizer.from_str(tokenizer_json)
        self.letters.normalizer = normalizers.Sequence([])
        self.letters.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.cache: dict[bytes, bytes] = {}  # words met lately
        self.old: dict[bytes, bytes] = {}  # words met before; those met again move back

    def _encode(self, words: list[bytes], into: dict[bytes, bytes]) -> None:
        """Put the ids of ``words`` into a table."""
        plain: list[tuple[bytes, str]] = []
        other: list[tuple[bytes, str]] = []
        for w in words:
            text = w.decode()
            low = text.lower()
            # Final sigma is the one letter whose lower case depends on its neighbours.
            if low.isalpha() and "\u03a3" not in text and is_normalized("NFC", text):
                plain.append((w, low))
            else:
                other.append((w, text))
        for tok, pairs in ((self.letters, plain), (self.whole, other)):
            got = tok.encode_batch_fast([t for _, t in pairs], add_special_tokens=False)
            for (w, _), e in zip(pairs, got, strict=True):
                ids = e.ids
                into[w] = pack(f"<{len(ids)}I", *ids)

    def _add(self, missing: set[bytes]) -> dict[bytes, bytes]:
        """Put the ids of ``missing`` into the cache; returns those of long words, which aren't kept."""
        long: dict[bytes, bytes] = {}
        self._encode([w for w in missing if len(w) > LONG_WORD], long)
        if len(self.cache) > CACHE_LIMIT:
            self.cache, self.old = {}, self.cache
        cache, old = self.cache, self.old
        cut, fresh = [], []
        for w in missing.difference(long):
            ids = old.get(w)
            if ids is not None:
                cache[w] = ids
                continue
            core = w.rstrip(_TAIL)
            if core and len(core) < len(w) and core[-1:].isalnum() and b"<|" not in w:
                cut.append((w, core, w[len(core):]))
            else:
                fresh.append(w)
        parts = {c for _, c, _ in cut} | {t for _, _, t in cut}
        self._encode([w for w in parts.union(fresh) if w not in cache], cache)
        for w, core, tail in cut:
            cache[w] = cache[core] + cache[tail]
        return long

    def encode_words(self, words: list[bytes]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each word, ASCII letters in lower case where it could make no special token."""
        words = [w if b"<|" in w else w.lower() for w in words]
        found = list(map(self.cache.get, words))
        missing = {w for w, f in zip(words, found, strict=True) if f is None}
        if not missing:
            return found
        long = self._add(missing)
        look = self.cache.get
        # A new generation may have begun: then words found before are still at hand in ``found``.
        return [(long[w] if w in long else look(w)) if f is None else f for w, f in zip(words, found, strict=True)]

    def _simple(self, entries: pa.BinaryArray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Which entries are letters with punctuation behind them, all entries' bytes and offsets, and which bytes are letters."""
        data, offsets = text_bytes(entries)
        letter, tail = _IS_LETTER[data], _IS_TAIL[data]
        if self.fast is None or not len(entries):
            return np.zeros(len(entries), bool), data, offsets, letter
        wrong = ~(letter | tail)
        wrong[1:] |= letter[1:] & tail[:-1]  # a letter behind punctuation ...
        begin = offsets[:-1]
        wrong[begin] = ~letter[begin]  # ... but for a word's first byte, which is to be a letter
        return ~np.logical_or.reduceat(wrong, begin), data, offsets, letter

    def encode_entries(self, entries: pa.BinaryArray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all entries one after the other, number of ids of each)."""
        simple, data, offsets, letter = self._simple(entries)
        other = np.flatnonzero(~simple)
        got = self.encode_words(entries.take(pa.array(other)).to_pylist())
        n_other = np.fromiter(map(len, got), np.int64, len(got)) // 4
        parts = [np.frombuffer(b"".join(got), "<u4")]
        first = np.zeros((2, len(entries)), np.int64)  # of an entry's ids in the joined parts: word, punctuation
        sizes = np.zeros((2, len(entries)), np.int64)
        sizes[0, other], first[0, other] = n_other, np.cumsum(n_other) - n_other
        if simple.any():
            of = np.repeat(np.arange(len(entries)), np.diff(offsets))
            mine = simple[of]
            n_letters = np.bincount(of[mine & letter], minlength=len(entries))[simple]
            joined = np.full(int(n_letters.sum()) + len(n_letters), ord(" "), np.uint8)
            own = np.ones(len(joined), bool)
            own[np.cumsum(n_letters + 1) - 1] = False
            joined[own] = data[mine & letter]
            ids = self.fast.encode_to_numpy(joined.tobytes().decode("ascii"), disallowed_special=())
            last = np.flatnonzero(self.ends[ids])  # one for each word
            sizes[0, simple] = np.diff(np.append(-1, last))
            first[0, simple] = np.append(0, last[:-1] + 1) + len(parts[0])
            parts.append(ids)
            n_tail = np.bincount(of[mine & ~letter], minlength=len(entries))
            tailed = np.flatnonzero(n_tail)
            if len(tailed):
                codes, tails = dictionary(data[mine & ~letter], np.append(0, np.cumsum(n_tail[tailed])))
                ends = [e.ids for e in self.whole.encode_batch_fast([t.decode() for t in tails.to_pylist()], add_special_tokens=False)]
                size = np.array([len(x) for x in ends], np.int64)
                sizes[1, tailed] = size[codes]
                first[1, tailed] = (np.cumsum(size) - size)[codes] + sum(map(len, parts))
                parts.append(np.fromiter(chain.from_iterable(ends), np.uint32, int(size.sum())))
        flat = np.concatenate(parts)
        return flat[_ranges(first.T.reshape(-1), sizes.T.reshape(-1))], sizes.sum(axis=0)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, where each text's begin), without special tokens added.

        Each distinct word is encoded once; the words' ids are then gathered by code. Other white space stays inside a word.
        """
        words = split_words(texts, lower=not pc.any(pc.match_substring(texts.cast(pa.large_binary()), b"<|")).as_py())
        flat, size = self.encode_entries(words.entries)
        n = size[words.codes]
        stops = np.append(0, np.cumsum(n))
        return flat[_ranges((np.cumsum(size) - size)[words.codes], n)], stops[words.starts]


_ENCODERS: dict[int, WordEncoder] = {}


def _encoder(tokenizer_json: str) -> WordEncoder:
    key = hash(tokenizer_json)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = WordEncoder(tokenizer_json)
    return _ENCODERS[key]


def write(docs: DataFrame, path: str, tokenizer_path: str, *, end_id: int, id_col: str = "doc_id",
          text_col: str = "text") -> None:
    """Encode every text and write the files in ascending id order below ``path``."""
    spark = docs.sparkSession
    with open(tokenizer_path, encoding="utf-8") as f:
        tok = spark.sparkContext.broadcast(f.read())
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("_text"))
    rows = rows.repartitionByRange(F.col("doc_id").asc_nulls_first()).sortWithinPartitions("doc_id", "_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, at, here = _encoder(tok.value), 0, TaskContext.get().partitionId()
        for batch in batches:
            for part in slices(batch, "_text", SLICE_BYTES):
                ids, starts = enc.encode(part.column(1))
                n = np.diff(starts) + 1
                stops = np.cumsum(n)
                ended = np.full(int(stops[-1]), end_id, np.int32)
                own = np.ones(len(ended), bool)
                own[stops - 1] = False
                ended[own] = ids
                ids = pa.ListArray.from_arrays(pa.array(np.append(0, stops).astype(np.int32)), pa.array(ended))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(np.full(len(n), here, np.int32)), pa.array(at + stops - n), pa.array(n), ids],
                    names=["doc_id", "part", "start_in_part", "n_tokens", "ids"])
                at += int(n.sum())

    (rows.mapInArrow(run, SCHEMA).write
     .option("compression", "snappy").option("orc.stripe.size", str(STRIPE_BYTES))
     .option("orc.row.index.stride", str(ROW_GROUP)).option("orc.create.index", "true")
     .option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", "0.01").orc(path))


def read(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, ids): every document of the files with its place among all ids."""
    rows = spark.read.schema(SCHEMA).orc(path)
    totals = rows.groupBy("part").agg(F.sum("n_tokens").alias("_n"))  # a row for each file
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return rows.join(F.broadcast(offsets), "part").select(
        "doc_id", (F.col("_before") + F.col("start_in_part")).alias("start"), "ids")


def lookup(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """(doc_id, ids) of a few documents; the filter reaches the files' indexes and Bloom filters."""
    return spark.read.schema(SCHEMA).orc(path).where(F.col("doc_id").isin(doc_ids)).select("doc_id", "ids")


def digests(rows: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of ``read``'s rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(2)
            at = ids.offsets.to_numpy()
            raw = memoryview(np.ascontiguousarray(ids.values.to_numpy().astype("<u4")).view(np.uint8))
            crc = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(np.diff(at).astype(np.int64)),
                                              pa.array(crc, pa.int64())],
                                             names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return rows.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
