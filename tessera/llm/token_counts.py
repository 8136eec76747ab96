"""Token counts under a unigram model, by dynamic programming shared in a trie.

A pre-token (a word with the word mark before it) is cut into the vocabulary's pieces with the greatest
sum of scores. The best score of a prefix doesn't depend on what follows, so distinct pre-tokens go into
a trie whose nodes hold it, with the number of pieces: a shared prefix is computed once, and a word's
count is read at its terminal node. Counts of words stay in a bounded table for later texts.

The vocabulary is a public one and stays as it is. The scores are log shares of its pieces in the corpus, fitted
by rounds of best cuts (expectation by the best path, then counting) on all distinct words with their counts in
all documents. Words are cut side by side, level by level of the trie of a task's words. A character that no piece has
costs ``-40`` a byte and counts its bytes. Of equal scores fewer pieces win.

Defined cases: null texts and those without a word have zero tokens; words of any length are whole;
repeated rows are counted each; other columns are not read.
"""

from __future__ import annotations

import math
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Staging, chunks_of, sliced

MARK = "▁"
_UNKNOWN = -40.0
_LONG = 1_000  # characters of a word that is cut alone
_MANY = 500  # words that are cut side by side
_tries: dict[int, "CountTrie"] = {}
SPACES = r"[\x20\x09-\x0D]+"


def vocabulary(path: str) -> dict[str, float]:
    """piece -> score to begin with (a Zipf law over its rank), of the ordinary pieces of a sentencepiece model."""
    import sentencepiece

    m = sentencepiece.SentencePieceProcessor(model_file=path)
    names = [m.id_to_piece(i) for i in range(m.get_piece_size()) if not (m.is_control(i) or m.is_unknown(i) or m.is_byte(i) or m.is_unused(i))]
    return {p: -math.log(r + 1) - 1 for r, p in enumerate(names, 1)}


def best_pieces(word: str, pieces: dict[str, float], longest: int) -> list[str]:
    """The best cut of a word; characters that no piece has are left out."""
    scores, counts, begins = array("d", [0.0]), array("q", [0]), array("q", [0])
    for end in range(1, len(word) + 1):
        n = len(word[end - 1].encode())
        best, fewest, begin = scores[end - 1] + _UNKNOWN * n, counts[end - 1] + n, -1
        for start in range(max(0, end - longest), end):
            value = pieces.get(word[start:end])
            if value is not None:
                value += scores[start]
                if value > best or value == best and counts[start] + 1 < fewest:
                    best, fewest, begin = value, counts[start] + 1, start
        scores.append(best)
        counts.append(fewest)
        begins.append(begin)
    out, end = [], len(word)
    while end:
        start = begins[end]
        if start >= 0:
            out.append(word[start:end])
        end = start if start >= 0 else end - 1
    return out


class PieceStates:
    """The pieces as a trie in arrays: a sorted key (state, character) for each edge, its target, and each state's piece or -1. State 0 is the root."""

    def __init__(self, names: list[str]):
        self.longest = max(map(len, names), default=1)
        edges, piece = {}, [-1]
        for k, name in enumerate(names):
            state = 0
            for ch in name:
                key = state << 21 | ord(ch)
                if (state := edges.get(key, 0)) == 0:
                    state = edges[key] = len(piece)
                    piece.append(-1)
            piece[state] = k
        self.keys = np.array(sorted(edges) + [1 << 62], dtype=np.int64)
        self.targets = np.array([edges[k] for k in sorted(edges)] + [0], dtype=np.int32)
        self.piece = np.array(piece, dtype=np.int32)

    def step(self, states: np.ndarray, chars: np.ndarray) -> np.ndarray:
        """Where chars (one a column) lead from states; -1 is nowhere."""
        out = np.full(states.shape, -1, dtype=np.int32)
        flat = states.reshape(-1)
        some = np.flatnonzero(flat >= 0)
        key = flat[some].astype(np.int64) << 21 | chars[some % len(chars)]
        at = np.searchsorted(self.keys, key)
        out.reshape(-1)[some] = np.where(self.keys[at] == key, self.targets[at], -1)
        return out


class SharedCuts:
    """Best cuts of words in code point order, by levels of the trie of their pre-tokens: a level holds the nodes of one depth, side by side.

    The cuts are those of best_pieces, ties included. A node's owner is the first word under it.
    """

    def __init__(self, words: list[str], states: PieceStates, scores: np.ndarray):
        self.lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1
        depth = int(self.lengths.max(initial=1))
        chars = np.zeros((len(words), depth), dtype=np.int64)
        chars[:, 0] = ord(MARK)
        if depth > 1:
            chars[:, 1:] = np.array(words, dtype=f"<U{depth - 1}").view(np.uint32).reshape(len(words), depth - 1)
        shared = np.zeros(len(words), dtype=np.int64)
        differ = chars[1:] != chars[:-1]
        shared[1:] = np.minimum(np.where(differ.any(axis=1), differ.argmax(axis=1), depth), np.minimum(self.lengths[1:], self.lengths[:-1]))
        self.node = [np.zeros(len(words), dtype=np.int32)]  # of each word, level by level
        self.owner = [np.zeros(1, dtype=np.int64)]
        self.score, self.count = [np.zeros(1)], [np.zeros(1, dtype=np.int64)]
        self.last, self.size = [np.full(1, -1, dtype=np.int32)], [np.zeros(1, dtype=np.int32)]  # the last piece of a cut, or -1, and its characters
        open_ = np.full((states.longest + 1, 1), -1, dtype=np.int32)  # row k: the state after the last k characters
        open_[0] = 0
        for d in range(1, depth + 1):
            new = (self.lengths >= d) & (shared < d)
            owner = np.flatnonzero(new)
            self.node.append(np.cumsum(new, dtype=np.int32) - 1)
            self.owner.append(owner)
            parent, ch = self.node[d - 1][owner], chars[owner, d - 1]
            n = 1 + (ch > 0x7F) + (ch > 0x7FF) + (ch > 0xFFFF)
            best, fewest = self.score[d - 1][parent] + _UNKNOWN * n, self.count[d - 1][parent] + n
            last, size = np.full(len(owner), -1, dtype=np.int32), np.ones(len(owner), dtype=np.int32)
            moved = states.step(open_[:-1, parent], ch)
            for k in range(min(states.longest, d), 0, -1):
                piece = np.where(moved[k - 1] >= 0, states.piece[moved[k - 1]], -1)
                at = np.flatnonzero(piece >= 0)
                if not len(at):
                    continue
                piece, before = piece[at], self.node[d - k][owner[at]]
                value, parts = scores[piece] + self.score[d - k][before], self.count[d - k][before] + 1
                better = (value > best[at]) | (value == best[at]) & (parts < fewest[at])
                at = at[better]
                best[at], fewest[at], last[at], size[at] = value[better], parts[better], piece[better], k
            open_ = np.concatenate([np.zeros((1, len(owner)), dtype=np.int32), moved])
            for column, v in ((self.score, best), (self.count, fewest), (self.last, last), (self.size, size)):
                column.append(v)

    def token_counts(self) -> np.ndarray:
        """Pieces of each word's cut, a byte of what no piece has counted as one."""
        out = np.zeros(len(self.lengths), dtype=np.int64)
        for d in range(1, len(self.count)):
            ends = np.flatnonzero(self.lengths == d)
            out[ends] = self.count[d][self.node[d][ends]]
        return out

    def piece_counts(self, times: np.ndarray, pieces: int) -> np.ndarray:
        """How often each piece is in the cuts of the words, each taken so many times."""
        weight = [np.zeros(len(o), dtype=np.int64) for o in self.owner]
        for d in range(1, len(weight)):
            ends = np.flatnonzero(self.lengths == d)
            np.add.at(weight[d], self.node[d][ends], times[ends])
        sums = np.zeros(pieces, dtype=np.int64)
        for d in range(len(weight) - 1, 0, -1):
            known = self.last[d] >= 0
            np.add.at(sums, self.last[d][known], weight[d][known])
            for k in np.unique(self.size[d]).tolist():
                of = np.flatnonzero(self.size[d] == k)
                np.add.at(weight[d - k], self.node[d - k][self.owner[d][of]], weight[d][of])
        return sums


def _tables(words: list[str], order: list[int]):
    """The places in order of words of up to _LONG characters, in runs that have about the same length and 4,000,000 characters at most."""
    for low, high in ((0, 40), (40, _LONG)):
        some = [i for i in order if low < len(words[i]) <= high]
        rows = 4_000_000 // high
        for a in range(0, len(some), rows):
            yield some[a : a + rows]


def count_pieces(words: list[str], times: list[int], names: list[str], states: PieceStates, scores: np.ndarray) -> np.ndarray:
    """How often each piece is in the best cuts of distinct words, each taken so many times: words of one class of lengths share a trie, very long ones are cut alone."""
    sums = np.zeros(len(names), dtype=np.int64)
    order = sorted(range(len(words)), key=words.__getitem__)
    for part in _tables(words, order):
        sums += SharedCuts([words[i] for i in part], states, scores).piece_counts(np.array([times[i] for i in part], dtype=np.int64), len(names))
    if long := [i for i in order if len(words[i]) > _LONG]:
        number, given = {p: k for k, p in enumerate(names)}, dict(zip(names, scores.tolist()))
        for i in long:
            for p in best_pieces(MARK + words[i], given, states.longest):
                sums[number[p]] += times[i]
    return sums


def fit_scores(docs: DataFrame, pieces: dict[str, float], rounds: int = 2, longest_word: int | None = 100) -> dict[str, float]:
    """Scores of pieces fitted to all words of docs(text) of up to longest_word characters, or of any length (None)."""
    split = docs.select(F.explode_outer(F.split(F.coalesce("text", F.lit("")), SPACES)).alias("word")).where("word != ''")
    if longest_word is not None:
        split = split.where(F.length("word") <= longest_word)
    names, context = list(pieces), docs.sparkSession.sparkContext
    with Staging(docs.sparkSession) as stage:
        words = stage(split.groupBy("word").agg(F.count("*").alias("n")), "word-counts")
        for _ in range(rounds):
            given = context.broadcast((names, PieceStates(names), np.array([pieces[p] for p in names], dtype=np.float64)))  # as large as the vocabulary

            def cut(batches, given=given):
                names, states, scores = given.value
                sums = np.zeros(len(names), dtype=np.int64)
                some: tuple[list[str], list[int]] = ([], [])
                held = 0
                for batch in batches:
                    found = batch.column(0).to_pylist()
                    some[0].extend(found)
                    some[1].extend(batch.column(1).to_pylist())
                    held += sum(map(len, found))
                    if held > 1_000_000:
                        sums += count_pieces(*some, names, states, scores)
                        some, held = ([], []), 0
                sums += count_pieces(*some, names, states, scores)
                at = np.flatnonzero(sums)
                yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(sums[at], pa.int64())], names=["piece", "n"])

            found = words.mapInArrow(cut, "piece long, n long").groupBy("piece").agg(F.sum("n").alias("n"))
            seen = {names[r["piece"]]: r["n"] for r in found.collect()}  # at most as many rows as pieces
            given.destroy()
            total = sum(seen.values()) + len(pieces)
            pieces = {p: math.log((seen.get(p, 0) + 1) / total) for p in pieces}
    return pieces


class CountTrie:
    """max_words and max_nodes bound the memory: beyond them a table starts anew, and words of over longest_word characters are not put in; counts stay the same."""

    def __init__(self, pieces: dict[str, float], max_words: int = 500_000, max_nodes: int = 300_000, longest_word: int = 1_000):
        self.pieces, self.longest = pieces, max(map(len, pieces), default=1)
        self.max_words, self.max_nodes, self.longest_word = max_words, max_nodes, longest_word
        self.words: dict[bytes, int] = {}
        self.states: PieceStates | None = None
        self.clear()

    def clear(self) -> None:
        self.child: dict[tuple[int, str], int] = {}
        self.score, self.count = [0.0], [0]

    def insert(self, word: str) -> int:
        """Tokens of a pre-token."""
        node, path = 0, [0]
        for end, ch in enumerate(word, 1):
            key = (node, ch)
            node = self.child.get(key, 0)
            if not node:
                n = len(ch.encode())
                best, fewest = self.score[path[-1]] + _UNKNOWN * n, self.count[path[-1]] + n
                for start in range(max(0, end - self.longest), end):
                    value = self.pieces.get(word[start:end])
                    if value is not None:
                        value += self.score[path[start]]
                        if value > best or value == best and self.count[path[start]] + 1 < fewest:
                            best, fewest = value, self.count[path[start]] + 1
                node = self.child[key] = len(self.score)
                self.score.append(best)
                self.count.append(fewest)
            path.append(node)
        return self.count[node]

    def long_word(self, word: str) -> int:
        """Tokens of a word of any length, with the state of its last characters alone."""
        state = [(0.0, 0)]
        for end, ch in enumerate(word, 1):
            n, last = len(ch.encode()), state[-1]
            best, fewest = last[0] + _UNKNOWN * n, last[1] + n
            for back in range(1, min(self.longest, len(state), end) + 1):
                value = self.pieces.get(word[end - back : end])
                if value is not None:
                    value += state[-back][0]
                    if value > best or value == best and state[-back][1] + 1 < fewest:
                        best, fewest = value, state[-back][1] + 1
            state.append((best, fewest))
            if len(state) > self.longest:
                del state[0]
        return state[-1][1]

    def add_many(self, new: list[bytes]) -> set[bytes]:
        """Puts those of the sorted words that are not very long in the table, by levels of a trie of their own; gives them back."""
        if self.states is None:
            self.states, self.scores = PieceStates(list(self.pieces)), np.array(list(self.pieces.values()), dtype=np.float64)
        words, done = [w.decode() for w in new], []
        for part in _tables(words, range(len(words))):
            self.words.update(zip((new[i] for i in part), SharedCuts([words[i] for i in part], self.states, self.scores).token_counts().tolist()))
            done += part
        return {new[i] for i in done}

    def counts(self, texts: list[str | None]) -> list[tuple[int, int]]:
        """(words, tokens) of each text."""
        if len(self.words) > self.max_words:
            self.words.clear()
        split = [(t or "").encode().split() for t in texts]
        new: set[bytes] = set()
        for ws in split:
            new |= set(ws).difference(self.words)
        if len(new) >= _MANY:
            new -= self.add_many(sorted(new))
        for w in sorted(new):
            if len(self.score) > self.max_nodes:
                self.clear()
            word = MARK + w.decode()
            self.words[w] = self.insert(word) if len(word) <= self.longest_word else self.long_word(word)
        get = self.words.__getitem__
        return [(len(ws), sum(map(get, ws))) for ws in split]


def token_counts(docs: DataFrame, pieces: dict[str, float] | None = None) -> DataFrame:
    """(doc_id, n_words, n_tokens) of each row of docs(doc_id, text), by scored pieces; without them, those of the public vocabulary with scores fitted to docs."""
    if pieces is None:
        import public_tokenizers

        pieces = fit_scores(docs, vocabulary(public_tokenizers.path("piece_bpe_32k.model")), longest_word=None)
    given, mark = docs.sparkSession.sparkContext.broadcast(pieces), hash(tuple(sorted(pieces.items())))  # as large as the vocabulary

    def run(batches):
        if mark not in _tries:  # a worker keeps its last trie over its tasks
            _tries.clear()
            _tries[mark] = CountTrie(given.value)
        trie = _tries[mark]
        for batch in sliced(batches):
            texts = batch.column(1).to_pylist()
            found = [c for a, b in chunks_of(texts, 2_000_000) for c in trie.counts(texts[a:b])]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([c[k] for c in found], pa.int64()) for k in (0, 1))], names=["doc_id", "n_words", "n_tokens"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n_words long, n_tokens long")
