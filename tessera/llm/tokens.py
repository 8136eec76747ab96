"""Token ids of whole texts by a public tokenizer, with a bounded table of words.

The ids of a text are the ids of its words between ASCII white space, one after the other, as neither
the normalizer nor the pre-tokenizer of the file looks across white space. So each distinct word goes
through the library once and the rest is look-up, in Arrow and numpy for all texts of a call. A word of Latin
letters with ASCII punctuation after them is put together from the ids of its letters in lower case and of the
punctuation: the file lower-cases, and cuts there.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

END_ID = 1
#: Letters that lower-case to one letter and are not composed with what follows; punctuation without the apostrophe, and without the signs of special tokens.
_PARTED = r"^(?P<letters>[A-Za-zÀ-ÖØ-öø-ÿ]*)(?P<signs>[!-&(-/:;=?-@\[-`{}~]*)$"
_encoders: dict[tuple, "WordEncoder"] = {}


def take_runs(values: np.ndarray, ends: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs number at of values, one after the other, with their ends. Run k is values[ends[k] : ends[k + 1]]."""
    start = ends[at]
    size = ends[at + 1] - start
    out = np.concatenate([[0], np.cumsum(size)])
    return values[np.repeat(start - out[:-1], size) + np.arange(out[-1])], out


class WordEncoder:
    """text -> little-endian unsigned 32-bit ids. Holds at most max_words words besides those of a call."""

    def __init__(self, path: str, max_words: int = 1_000_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer, self.max_words = Tokenizer.from_file(path), max_words
        self.clear()

    def clear(self) -> None:
        self.words, self.ids, self.ends = pa.array([], pa.string()), np.zeros(0, dtype="<u4"), np.zeros(1, dtype=np.int64)

    def look_up(self, missing: pa.Array) -> None:
        """Puts words in the table, encoded joined by blanks, a few hundred at a time; the ids are split by offset."""
        ids, ends = [self.ids], [self.ends]
        for start in range(0, len(missing), 1 << 15):
            words = missing.slice(start, 1 << 15).to_pylist()
            groups = [words[i : i + 512] for i in range(0, len(words), 512)]
            for part, enc in zip(groups, self.tokenizer.encode_batch([" ".join(p) for p in groups], add_special_tokens=False)):
                first = np.cumsum(np.fromiter(map(len, part), dtype=np.int64, count=len(part)) + 1)
                at = np.fromiter((o[0] for o in enc.offsets), dtype=np.int64, count=len(enc.ids))
                ids.append(np.asarray(enc.ids, dtype="<u4"))
                ends.append(ends[-1][-1] + np.searchsorted(at, first))
        self.words, self.ids, self.ends = pa.concat_arrays([self.words, missing]), np.concatenate(ids), np.concatenate(ends)

    def places(self, words: pa.Array) -> np.ndarray:
        """Where distinct words are in the table."""
        at = pc.index_in(words, value_set=self.words)
        if at.null_count and len(self.words) + at.null_count > self.max_words:
            self.clear()
            at = pc.index_in(words, value_set=self.words)
        if at.null_count:
            known = len(self.words)
            new = at.is_null().to_numpy(zero_copy_only=False)
            self.look_up(words.filter(at.is_null()))
            out = pc.fill_null(at, 0).to_numpy().astype(np.int64)
            out[new] = known + np.arange(new.sum())
            return out
        return at.to_numpy().astype(np.int64)

    def encode_texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts (null: none) one after the other, and the texts' ends."""
        split = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        coded = split.flatten().dictionary_encode()
        words, n = coded.dictionary, len(coded.dictionary)
        parts = pc.extract_regex(words, pattern=_PARTED)
        letters, signs = pc.utf8_lower(pc.struct_field(parts, "letters")), pc.struct_field(parts, "signs")
        both = pa.concat_arrays([pc.coalesce(letters, words), pc.fill_null(signs, "")]).dictionary_encode()
        at = self.places(both.dictionary)[both.indices.to_numpy()]
        ids, ends = take_runs(self.ids, self.ends, np.stack([at[:n], at[n:]], axis=1).reshape(-1))
        ids, ends = take_runs(ids, ends[::2], coded.indices.to_numpy().astype(np.int64))
        return ids, ends[split.offsets.to_numpy() - split.offsets[0].as_py()]

    def encode_ended(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The same with the end id after each text."""
        ids, ends = self.encode_texts(texts)
        return np.insert(ids, ends[1:], END_ID), ends + np.arange(len(ends))

    def encode(self, texts: list[str | None]) -> list[bytes]:
        ids, ends = self.encode_texts(pa.array(texts, pa.string()))
        data = ids.tobytes()
        return [data[4 * a : 4 * b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]


def encoder(path: str, max_words: int = 1_000_000) -> WordEncoder:
    """One for each worker process, kept over its tasks."""
    key = (path, max_words)
    if key not in _encoders:
        _encoders[key] = WordEncoder(path, max_words)
    return _encoders[key]


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
