"""Words, hashes and subword ids of Arrow batches of texts, by whole arrays."""

from __future__ import annotations

import unicodedata
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

CHUNK_BYTES = 8 << 20  # text handled at once; one longer text is handled whole


def chunks(batch: pa.RecordBatch | pa.Table, column: str = "text", size: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of whole rows with about ``size`` bytes of text each."""
    parts = batch.to_batches() if isinstance(batch, pa.Table) else [batch]
    for part in parts:
        if not part.num_rows:
            continue
        ends = np.cumsum(pc.fill_null(pc.binary_length(part.column(column)), 0).to_numpy(zero_copy_only=False))
        start = 0
        while start < part.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + size, "right")))
            yield part.slice(start, stop - start)
            start = stop


def words(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(distinct words, number of each word in them, where each text's words start) for [^\\x20\\x09-\\x0D]+.

    The last of the starts is the number of all words. Null text has none.
    """
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    offsets = lists.offsets.to_numpy().astype(np.int64)
    coded = lists.flatten().dictionary_encode()
    if isinstance(coded, pa.ChunkedArray):
        coded = coded.combine_chunks()
    codes, known = coded.indices.to_numpy(), coded.dictionary
    offsets = offsets - offsets[0]
    empty = pc.index(known, "").as_py()  # at the ends of a text
    if empty >= 0:
        kept = codes != empty
        offsets = np.concatenate([[0], np.cumsum(kept)])[offsets]
        codes = codes[kept]
    return known, codes, offsets


def word_hashes(known: pa.Array) -> np.ndarray:
    digest = xxhash.xxh3_64_intdigest
    return np.fromiter((digest(w) for w in known.to_pylist()), np.uint64, len(known))


_ODD = np.uint64(0x9E3779B97F4A7C15)


def gram_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of every ``n`` consecutive items of ``hashes``; also those that span two texts."""
    count = max(0, len(hashes) - n + 1)
    value = np.zeros(count, np.uint64)
    for i in range(n):
        value *= _ODD
        value += hashes[i : i + count]
        value ^= value >> np.uint64(29)
    value *= np.uint64(0xBF58476D1CE4E5B9)
    value ^= value >> np.uint64(32)
    return value


def gram_starts(offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(starts of the ``n``-grams that lie within one text, the text of each)."""
    lengths = np.maximum(np.diff(offsets) - n + 1, 0)
    texts = np.repeat(np.arange(len(lengths)), lengths)
    first = np.cumsum(lengths) - lengths
    return np.arange(lengths.sum()) - first[texts] + offsets[:-1][texts], texts


class Subwords:
    """Subword ids of whole texts by a public tokenizer that splits at white space.

    The words of a batch are made distinct, each distinct word is encoded once by the library, and the ids are put
    together by whole arrays. Words of letters that the normaliser leaves alone go straight to the library's model.
    """

    MOST_KEPT = 300_000  # words kept between batches, some 60 MB in each worker; the rest is encoded again
    ENDS = ".,;:!?"  # runs of these are a token split of their own after letters

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        as_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        letters = [chr(c) for c in (*range(97, 123), *range(0xDF, 0xF7), *range(0xF8, 0x17F))]
        letters = [c for c in letters if c == c.lower() and c.isalpha() and unicodedata.is_normalized("NFC", c)]
        self.spelled = {ord(c): as_bytes.pre_tokenize_str(c)[0][0] for c in letters}
        self.plain = frozenset(letters)
        self.kept: dict[str, bytes] = {}

    def _encode(self, found: list[str]) -> list[bytes]:
        """Ids of each word, four bytes each."""
        kept = self.kept
        if len(kept) > self.MOST_KEPT:
            kept.clear()
        plain, spelled, tokenize = self.plain.issuperset, self.spelled, self.model.tokenize
        out, rest = list(map(kept.get, found)), []
        for i, ids in enumerate(out):
            if ids is None:
                word = found[i]
                # In lower case already; a word of ASCII letters is found so much faster than by looking each one up.
                if (word.isascii() and word.isalpha()) or plain(word):
                    spelling = word if word.isascii() else word.translate(spelled)
                    out[i] = kept[word] = array("i", [t.id for t in tokenize(spelling)]).tobytes()
                else:
                    rest.append(i)
        if rest:
            encoded = self.tokenizer.encode_batch_fast([found[i] for i in rest], add_special_tokens=False)
            for i, e in zip(rest, encoded, strict=True):
                out[i] = kept[found[i]] = array("i", e.ids).tobytes()
        return out

    def encode_words(self, known: pa.Array) -> pa.ListArray:
        """Ids of each of the distinct words ``known``."""
        lower = pc.ascii_lower(known)
        stems = pc.utf8_rtrim(lower, self.ENDS)
        plain = self.plain.issuperset
        apart = pc.match_substring_regex(stems, "^[a-z]+$").to_numpy(zero_copy_only=False).copy()
        other = np.flatnonzero(~apart)
        apart[other] = np.fromiter((plain(s) and s != "" for s in stems.take(pa.array(other)).to_pylist()), bool, len(other))
        whole = pc.if_else(pa.array(apart), stems, lower).dictionary_encode()
        cut = pc.utf8_length(stems).to_numpy(zero_copy_only=False)
        ended = np.flatnonzero(apart & (cut < pc.utf8_length(lower).to_numpy(zero_copy_only=False)))
        ends = [w[n:] for w, n in zip(lower.take(pa.array(ended)).to_pylist(), cut[ended].tolist(), strict=True)]
        after = {e: i for i, e in enumerate(dict.fromkeys(ends))}
        # Every word is its stem's piece followed by its end's piece, the latter often the empty last one.
        pieces = [*self._encode(whole.dictionary.to_pylist()), *self._encode(list(after)), b""]
        parts = np.full((len(known), 2), len(pieces) - 1)
        parts[:, 0] = whole.indices.to_numpy()
        parts[ended, 1] = [len(whole.dictionary) + after[e] for e in ends]
        joined = _lists(pieces).take(pa.array(parts.ravel()))
        return pa.ListArray.from_arrays(pa.array(joined.offsets.to_numpy()[::2]), joined.values)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, where each text's ids start and the last end)."""
        return self.encode_coded(*words(texts))

    def encode_coded(self, known: pa.Array, codes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same for texts given as ``words`` has them."""
        if not len(codes):
            return np.zeros(0, np.int32), np.zeros(len(offsets), np.int64)
        lists = self.encode_words(known).take(pa.array(codes))
        return lists.values.to_numpy(), lists.offsets.to_numpy().astype(np.int64)[offsets]


def _lists(pieces: list[bytes]) -> pa.ListArray:
    ends = np.cumsum(np.fromiter(map(len, pieces), np.int32, len(pieces)) // 4, dtype=np.int32)
    flat = np.frombuffer(b"".join(pieces), np.int32)
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(flat))


_SUBWORDS: dict[str, Subwords] = {}


def subwords(path: str) -> Subwords:
    """One encoder for each Python worker and file."""
    if path not in _SUBWORDS:
        _SUBWORDS[path] = Subwords(path)
    return _SUBWORDS[path]


def release() -> None:
    """Give back what this Python worker holds for other stages: words kept by encoders, and Arrow's unused memory. Spark keeps
    a worker for a while, also when stages follow that need none."""
    for encoder in _SUBWORDS.values():
        encoder.kept.clear()
    pa.default_memory_pool().release_unused()
