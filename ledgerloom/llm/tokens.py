"""Encoding with a public tokenizer file, whole Arrow columns at a time.

A file whose normaliser and pre-tokenizer are the ones below drops white space before it splits, so the words between
white space are encoded independently of each other.  Arrow splits a column into words and numbers the distinct ones.
Those of Latin-1 letters and ASCII signs are lowered and split by numpy, at the places of the file's own pattern; their
distinct pieces are looked up among those of former columns, and new ones go to the library's model, which spares them
the normaliser's bookkeeping; so a word with a capital or a full stop costs no more than the bare one.  Other words are
looked up as they are, and new ones go through the whole tokenizer.  The ids of all words are laid out by numpy.  Texts
with the strings of special tokens, or with control characters on which Arrow and the tokenizer disagree about white
space, go through the library whole, and so does every text where the file is of another kind.
"""

from __future__ import annotations

import json
import os
from array import array
from collections.abc import Callable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import held

END_ID = 2
_WHOLE = "<\\||[\x1c-\x1f]"
# The tokenizer's steps before its model.
_NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
_SPLIT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
_LETTER, _DIGIT, _SIGN, _OTHER = range(4)


def _kinds() -> bytes:
    """The kind of each UTF-8 byte.  À to ÿ, which are composed and lowered one by one, are 0xC3 and a second byte, which
    for × and ÷ is 0x97 and 0xB7; every other character beyond ASCII has another first byte."""
    kinds = [_LETTER if chr(b).isalpha() else _DIGIT if chr(b).isdigit() else _SIGN if 33 <= b <= 126 else _OTHER for b in range(128)]
    kinds += [_LETTER if b < 192 or b == 0xC3 else _OTHER for b in range(128, 256)]
    kinds[0x97] = kinds[0xB7] = _OTHER
    return bytes(kinds)


_KINDS = _kinds()
_LOWER = bytes(b + 32 if 65 <= b <= 90 or 0x80 <= b <= 0x9E else b for b in range(256))


def _byte_letters() -> dict[int, str]:
    """The letters by which a byte-level vocabulary writes the UTF-8 bytes of each Latin-1 character."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in plain]
    letter = {b: chr(b) for b in plain} | {b: chr(256 + n) for n, b in enumerate(rest)}
    return {c: "".join(letter[b] for b in chr(c).encode()) for c in range(256)}


def _splits_words(library) -> bool:
    """Whether the tokenizer has the steps for which words can be encoded apart."""
    normalizer, pre = (json.loads(step.__getstate__()) if step else {} for step in (library.normalizer, library.pre_tokenizer))
    pre = pre.get("pretokenizers") or [{}]
    return (
        normalizer.get("normalizers") == _NORMALIZERS
        and len(pre) == 2
        and pre[0].get("pattern") == {"Regex": _SPLIT}
        and (pre[0].get("behavior"), pre[0].get("invert")) == ("Removed", True)
        and (pre[1].get("type"), pre[1].get("add_prefix_space"), pre[1].get("use_regex")) == ("ByteLevel", False, False)
        and all(t.content.startswith("<|") for t in library.get_added_tokens_decoder().values())
        and type(library.model).__name__ == "BPE"
    )


def cuts(lengths: np.ndarray) -> np.ndarray:
    """Where runs of these lengths begin when laid end to end, and where the last one ends."""
    return np.concatenate(([0], np.cumsum(lengths)))


def gather(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The runs of values that begin at starts, end to end."""
    at = cuts(lengths)
    return values[np.repeat(starts - at[:-1], lengths) + np.arange(at[-1])]


def pieces(words: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The lowered pieces of all words, end to end, how many each word has, and the numbers of the words that have
    characters of other kinds, which are not split."""
    at = np.frombuffer(words.buffers()[1], np.int32, len(words) + 1, 4 * words.offset)
    data = words.buffers()[2].slice(at[0], at[-1] - at[0]).to_pybytes() if at[-1] > at[0] else b""
    at = at - at[0]
    kind = np.frombuffer(data.translate(_KINDS), np.uint8)
    other = np.unique(np.searchsorted(at, np.flatnonzero(kind == _OTHER), "right") - 1)
    if len(other):
        mask = np.zeros(len(words), bool)
        mask[other] = True
        return *pieces(pc.if_else(pa.array(mask), "", words))[:2], other
    # a piece begins with a word, where the kind changes, and at every digit
    low = data.translate(_LOWER)
    begins = kind == _DIGIT
    begins[1:] |= kind[1:] != kind[:-1]
    begins[at[:-1][np.diff(at) > 0]] = True
    # but an apostrophe that begins one takes s, t, m, d, re, ve or ll with it
    sign = np.flatnonzero(begins & (np.frombuffer(low, np.uint8) == ord("'")))
    if len(sign):
        end, ahead = at[np.searchsorted(at, sign, "right")], np.frombuffer(low + b"\0\0", np.uint8)
        one, two = ahead[sign + 1], ahead[sign + 1].astype(np.int32) << 8 | ahead[sign + 2]
        size = np.where(np.isin(one, list(b"stmd")), 2, np.where(np.isin(two, [ord(x) << 8 | ord(y) for x, y in ("re", "ve", "ll")]), 3, 1))
        taken = (size > 1) & (sign + size <= end)
        begins[sign[taken] + 1] = False
        after = (sign + size)[taken & (sign + size < end)]
        begins[after] = True
    places = np.flatnonzero(begins)
    offsets = np.append(places, len(data)).astype(np.int32)
    return pa.StringArray.from_buffers(len(places), pa.py_buffer(offsets), pa.py_buffer(low)), np.diff(np.searchsorted(places, at)), other


class _Known:
    """Strings and their ids: numbers has the place of each, whose ids are those from ends[place] to ends[place + 1]."""

    def __init__(self):
        self.numbers, self.ids, self.ends = {}, array("I"), array("q", [0])


class Encoder:
    """Texts to ids.  Pieces, and words that are not split, live in two generations of at most ``most_words`` each: a full
    younger one becomes the older one, from which those that are seen again return."""

    def __init__(self, path: str, most_words: int = 150_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._library = Tokenizer.from_file(path)
        self._by_word, self._most, self._letters = _splits_words(self._library), most_words, _byte_letters()
        self._young, self._old = _Known(), _Known()
        self._tokenize = self._library.model.tokenize
        #: the smallest kind of number that holds all ids
        self.kind = "<u2" if self._library.get_vocab_size() <= 1 << 16 else "<u4"

    def _whole(self, text: str) -> list[int]:
        return self._library.encode(text, add_special_tokens=False).ids

    def _piece(self, piece: str) -> list[int]:
        return [t.id for t in self._tokenize(piece if piece.isascii() else piece.translate(self._letters))]

    def _places(self, keys: list[str], make: Callable[[str], list[int]]) -> np.ndarray:
        """The places of distinct strings in the younger generation; make gives the ids of one that no generation knows."""
        young, old = self._young, self._old
        out = np.fromiter(map(young.numbers.get, keys, repeat(-1)), np.int64, len(keys))
        new = np.flatnonzero(out < 0)
        out[new] = np.arange(len(young.numbers), len(young.numbers) + len(new))
        ids, ends, before = young.ids, young.ends, old.numbers.get
        for k in new.tolist():
            place = before(keys[k])
            if place is None:
                ids.fromlist(make(keys[k]))
            else:
                ids.extend(old.ids[old.ends[place] : old.ends[place + 1]])
            ends.append(len(ids))
        young.numbers.update(zip([keys[k] for k in new.tolist()], out[new].tolist()))
        return out

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of distinct words, end to end, and the number of each one's."""
        if len(self._young.numbers) > self._most:
            self._young, self._old = _Known(), self._young
        parts, counts, other = pieces(words)
        parts = parts.dictionary_encode()
        places = self._places(parts.dictionary.to_numpy(zero_copy_only=False).tolist(), self._piece)[parts.indices.to_numpy()]
        if len(other):
            places = np.insert(places, cuts(counts)[other], self._places(words.take(pa.array(other)).to_pylist(), self._whole))
            counts[other] = 1
        ends = np.array(self._young.ends, np.int64)
        lengths = np.diff(ends)[places]
        ids = gather(np.array(self._young.ids, "<u4"), ends[places], lengths)
        return ids, np.diff(cuts(lengths)[cuts(counts)])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, end to end, and the number of each text's; a null text counts as empty."""
        texts = pc.fill_null(texts.cast(pa.string()), "")
        whole = np.flatnonzero(pc.match_substring_regex(texts, _WHOLE).to_numpy(zero_copy_only=False)) if self._by_word else np.arange(len(texts))
        apart = {k: np.array(self._whole(texts[k].as_py()), "<u4") for k in whole.tolist()}
        if len(whole):
            mask = np.zeros(len(texts), bool)
            mask[whole] = True
            texts = pc.if_else(pa.array(mask), "", texts)
        lists = pc.utf8_split_whitespace(texts)
        words = lists.flatten().dictionary_encode()
        codes = words.indices.to_numpy(zero_copy_only=False)
        ids, sizes = self._words(words.dictionary)
        lengths = sizes[codes]
        offsets = np.asarray(lists.offsets) - lists.offsets[0].as_py()
        flat = gather(ids, cuts(sizes)[:-1][codes], lengths)
        counts = np.diff(cuts(lengths)[offsets])
        if apart:
            ends = cuts(counts)
            runs = [apart.get(k, flat[ends[k] : ends[k + 1]]) for k in range(len(counts))]
            flat, counts = np.concatenate(runs), np.array([len(r) for r in runs])
        return flat, counts


def documents(batches: Iterator[pa.RecordBatch], tokens: Encoder, at_once: int = 3 << 20) -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
    """(doc_ids, ids of all of them end to end, their numbers of ids), each with its end id, from Arrow batches with
    doc_id and text, about at_once bytes of text at a time (one text at least)."""
    for batch in batches:
        text = batch.column("text").cast(pa.large_string())
        size, at = cuts(pc.fill_null(pc.binary_length(text), 0).to_numpy(zero_copy_only=False)), 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(size, size[at] + at_once, "right")) - 1)
            ids, counts = tokens.encode(text.slice(at, to - at))
            yield batch.column("doc_id").slice(at, to - at).to_pylist(), np.insert(ids, cuts(counts)[1:], np.uint32(END_ID)), counts + 1
            at = to


def encoder(path: str) -> Encoder:
    """One encoder per worker process and file."""
    return held(("encoder", path), lambda: Encoder(path))


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")
