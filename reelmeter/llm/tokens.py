"""Token ids of texts, by the ``tokenizers`` library, with repeated words encoded once per task."""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel, Sequence, WhitespaceSplit

#: Bytes of words and ids that a worker process remembers; those of the last texts stay.
REMEMBERED = 16 << 20
#: What a remembered word takes besides its text and ids.
_ENTRY = 17
#: Bytes of text whose ids are put together at a time.
AT_ONCE = 2 << 20
#: Bytes of text whose words are looked up together.
TOGETHER = 16 << 20
#: Words handed to the library at a time.
_WORDS = 8192
END = 1
DEFAULT = "word_bpe_49k.json"

#: Words of small letters alone, and marks other than the apostrophe.
_LETTERS = r"^[a-zß-öø-ÿ]+$"
_STEM = r"^[a-zß-öø-ÿ]+"
_MARKS = "".join(c for c in string.punctuation if c != "'")


def tokenizer_path(name: str = DEFAULT) -> str:
    return public_tokenizers.path(name)


def _binary(ids: np.ndarray, ends: np.ndarray) -> pa.LargeBinaryArray:
    """Runs of 16-bit ids as bytes, given where each run ends."""
    offsets = np.concatenate([[0], 2 * ends.astype(np.int64)])
    data = pa.py_buffer(np.ascontiguousarray(ids, "<u2"))
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(offsets), data])


class Remembered:
    """Words and their ids in Arrow arrays, which take far less room than Python objects."""

    def __init__(self):
        self.clear()

    def clear(self) -> None:
        self.words, self.ids = pa.array([], pa.large_string()), pa.array([], pa.large_binary())

    def keep(self, words: pa.Array, ids: pa.Array, order: np.ndarray) -> None:
        """Words and ids in the given order as far as there is room; a very long word is not worth it."""
        sizes = (pc.binary_length(words).to_numpy() + pc.binary_length(ids).to_numpy() + _ENTRY)[order]
        order = order[sizes <= REMEMBERED >> 4]
        sizes = sizes[sizes <= REMEMBERED >> 4]
        kept = pa.array(order[: np.searchsorted(np.cumsum(sizes), REMEMBERED, "right")])
        self.words, self.ids = words.take(kept), ids.take(kept)


class WordTokens:
    """Ids of texts for a vocabulary that drops white space and never merges across it.

    Such a vocabulary encodes a text as the ids of its parts between white space,
    one after the other, so parts are encoded once and looked up from then on.
    ``tests/llm`` compares this with encoding whole texts. Ids must be below 65,536.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        size = self.tokenizer.get_vocab_size()
        if size > 1 << 16:
            raise ValueError("ids do not fit in 16 bits")
        self.known = Remembered()
        # for words that need no normalising and whose split is known; the last id of a piece tells where it ends
        self.plain = Tokenizer(self.tokenizer.model)
        self.plain.pre_tokenizer = Sequence([WhitespaceSplit(), ByteLevel(add_prefix_space=False, use_regex=False)])
        suffix = self.tokenizer.model.end_of_word_suffix
        vocab = self.tokenizer.get_vocab(with_added_tokens=False)
        self.closing = np.zeros(1 << 16, bool)
        if suffix and all(c + suffix in vocab for c in ByteLevel.alphabet()):
            self.closing[[i for token, i in vocab.items() if token.endswith(suffix)]] = True

    def _letters(self, words: pa.Array) -> pa.LargeBinaryArray:
        """Ids of words of small letters, a piece each."""
        ids = [np.zeros(0, "<u2")]
        for k in range(0, len(words), _WORDS):
            text = " ".join(words.slice(k, _WORDS).to_pylist())
            ids.append(np.array(self.plain.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u2"))
        flat = np.concatenate(ids)
        return _binary(flat, np.flatnonzero(self.closing[flat]) + 1)

    def _any(self, words: pa.Array) -> pa.LargeBinaryArray:
        ids, sizes = [np.zeros(0, "<u2")], [np.zeros(0, np.int64)]
        for k in range(0, len(words), _WORDS):
            some = words.slice(k, _WORDS).to_pylist()
            found = self.tokenizer.encode(some, is_pretokenized=True, add_special_tokens=False)
            ids.append(np.array(found.ids, "<u2"))
            sizes.append(np.bincount(np.array(found.word_ids, np.int64), minlength=len(some)))
        return _binary(np.concatenate(ids), np.cumsum(np.concatenate(sizes)))

    def _encode(self, words: pa.Array) -> pa.LargeBinaryArray:
        if not self.closing.any():
            return self._any(words)
        letters = pc.match_substring_regex(words, _LETTERS)
        found = [self._letters(words.filter(letters)), self._any(words.filter(pc.invert(letters)))]
        letters = letters.to_numpy(zero_copy_only=False)
        place = np.where(letters, np.cumsum(letters), letters.sum() + np.cumsum(~letters)) - 1
        return pa.concat_arrays(found).take(pa.array(place))

    def _looked_up(self, words: pa.Array) -> pa.LargeBinaryArray:
        """Ids of distinct words, by memory where it has them."""
        at = pc.index_in(words, value_set=self.known.words)
        missing = at.is_null()
        new = words.filter(missing)
        every = pa.concat_arrays([self.known.words, new])
        ids = pa.concat_arrays([self.known.ids, self._encode(new)])
        missing = missing.to_numpy(zero_copy_only=False)
        place = np.where(missing, len(every) - len(new) + np.cumsum(missing) - 1, at.fill_null(0).to_numpy())
        unused = np.ones(len(every), bool)
        unused[place] = False
        self.known.keep(every, ids, np.concatenate([place, np.flatnonzero(unused)]))
        return ids.take(pa.array(place))

    def _of_words(self, words: pa.Array) -> pa.LargeBinaryArray:
        """Ids of words; of letters with marks behind them, which are pieces of their own, each is looked up by itself."""
        words = words.cast(pa.large_string())
        stems = pc.utf8_rtrim(words, _MARKS)
        marked = pc.and_(pc.not_equal(stems, words), pc.match_substring_regex(stems, _LETTERS))
        marks = pc.replace_substring_regex(pc.if_else(marked, words, ""), _STEM, "")
        parts = pa.chunked_array([pc.if_else(marked, stems, words), marks]).dictionary_encode()
        table = self._looked_up(parts.chunk(0).dictionary)
        return pc.binary_join_element_wise(*[table.take(p.indices) for p in parts.chunks], pa.scalar(b"", pa.large_binary()))

    @staticmethod
    def _split(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
        """Words of all texts, one after the other, and where those of each text end. Null texts have none."""
        texts = pc.fill_null(texts, "")
        # up to U+00FF, lower-casing here or in the library is the same, but for special tokens, whose case counts
        lower = pc.utf8_lower(texts)
        texts = pc.if_else(pc.match_substring_regex(texts, r"[^\x{00}-\x{FF}]|<\|"), texts, lower)
        parts = pc.ascii_split_whitespace(texts)
        return parts.flatten().dictionary_encode(), parts.offsets.to_numpy()[1:] - parts.offsets[0].as_py()

    def documents(self, batch: pa.RecordBatch, text: str = "text") -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(first row, ids with ``END`` after every text, ends) of parts of the batch of bounded size."""
        texts = batch[text]
        texts = pa.concat_arrays([texts]) if texts.offset else texts
        total = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
        first = 0
        while first < len(texts):
            firsts, words, stops, begin = [], [], [], total[first - 1] if first else 0
            while first < len(texts) and (not words or total[first] - begin <= TOGETHER):
                before = total[first - 1] if first else 0
                last = max(first + 1, int(np.searchsorted(total, before + AT_ONCE, "right")))
                split, stop = self._split(texts.slice(first, last - first))
                firsts.append(first)
                words.append(split)
                stops.append(stop)
                first = last
            words = pa.chunked_array(words).unify_dictionaries()
            table = self._of_words(words.chunk(0).dictionary)
            for at, part, stop in zip(firsts, words.chunks, stops):
                found = table.take(part.indices)
                _, offsets, data = found.buffers()
                ends = np.frombuffer(offsets, np.int64)[stop] // 2
                ids = np.frombuffer(data, "<u2")[: ends[-1]] if data else np.zeros(0, "<u2")
                yield at, np.insert(ids, ends, END), ends + np.arange(1, len(ends) + 1)


_loaded: dict[str, WordTokens] = {}


def word_tokens(path: str) -> WordTokens:
    """The tokenizer of this worker process, loaded once."""
    if path not in _loaded:
        _loaded[path] = WordTokens(path)
    return _loaded[path]
