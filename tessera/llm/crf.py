"""A linear-chain conditional random field over word shapes, trained and decoded with numpy.

Tokens are runs of letters, runs of digits and single other characters. A token's features are its shape
(case and length of a word, length of a number, the character itself), its class in a small list of words,
both of its neighbours, some of these together, and the spaces between. Labels are O and begin / inside of
each kind.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Classes of words that mean something beside personal data.
WORD_CLASSES = {
    "at": "at arobase", "dot": "dot punto punkt point", "phone": "phone tel telephone telefon teléfono téléphone call fax mobile cell text whatsapp dial ring hotline handy móvil portable",
    "mail": "email mail e-mail contact reach write courriel correo", "card": "card visa mastercard amex maestro credit debit pan karte carte tarjeta paid",
    "ip": "ip host address addr server gateway router ping", "tld": "com org net edu io gov co de fr es uk info",
    "other": "version order invoice isbn item page pages room date dated id ref no number score vol chapter build release v section part model serial account on from between to year in of sku lot",
}
_SYMBOLS = "@.-()+/:,[]_#=%$\"'*<>{}&|;!?"
_LENGTHS = [1, 2, 3, 4, 5, 6, 7, 8, 9, 13, 16, 17]  # least length of each class of numbers
_WORDS, _NUMBERS = 16, len(_LENGTHS)
EDGE = _WORDS + _NUMBERS + len(_SYMBOLS) + 1
SHAPES = EDGE + 1
COARSE = 12
_LEX = len(WORD_CLASSES) + 1

_SPACE, _LETTER, _UPPER, _DIGIT, _SYMBOL, _BREAK = range(6)
_CLASS = np.full(128, _SYMBOL, dtype=np.uint8)
_CLASS[[9, 11, 12, 13, 32]] = _SPACE
_CLASS[10] = _BREAK
_CLASS[ord("0") : ord("9") + 1] = _DIGIT
_CLASS[ord("a") : ord("z") + 1] = _LETTER
_CLASS[ord("A") : ord("Z") + 1] = _UPPER
_SYMBOL_ID = np.full(128, len(_SYMBOLS), dtype=np.int64)
for _i, _c in enumerate(_SYMBOLS):
    _SYMBOL_ID[ord(_c)] = _i
_COARSE_SYMBOL = {"@": 4, ".": 5, "-": 6, "(": 7, ")": 7, "[": 8, "]": 8, "+": 9, "/": 9, "_": 9}


def _coarse_of(shape: np.ndarray) -> np.ndarray:
    table = np.full(SHAPES, 10, dtype=np.int64)
    table[:_WORDS] = 0
    table[_WORDS : _WORDS + _NUMBERS] = 1 + np.minimum(np.arange(_NUMBERS) // 3, 2)
    for i, c in enumerate(_SYMBOLS):
        table[_WORDS + _NUMBERS + i] = _COARSE_SYMBOL.get(c, 10)
    table[EDGE] = 11
    return table[shape]


def _word_hash(word: str) -> int:
    h = 0
    for c in word:
        h = (h * 1000003 + ord(c)) % (1 << 61)
    return h


_LEXICON = {_word_hash(w): i for i, ws in enumerate(WORD_CLASSES.values(), 1) for w in ws.split()}


@dataclass
class Tokens:
    start: np.ndarray
    end: np.ndarray
    shape: np.ndarray
    lex: np.ndarray
    space: np.ndarray  # white space before
    first: np.ndarray  # index of the first token of each sequence
    size: np.ndarray


def tokenize(text: str) -> Tokens:
    """Tokens of text; each line is a sequence."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    low = codes < 128
    kind = np.where(low, _CLASS[np.where(low, codes, 0)], _LETTER)
    kind[(codes == 0xA0) | ((codes >= 0x2000) & (codes <= 0x200B))] = _SPACE
    kind[(codes >= 0x2010) & (codes <= 0x206F)] = _SYMBOL
    group = np.where(kind == _UPPER, _LETTER, kind)
    begins = np.empty(len(codes), dtype=bool)
    begins[:1] = True
    begins[1:] = (group[1:] != group[:-1]) | (group[1:] == _SYMBOL) | (group[1:] == _BREAK)
    edges = np.flatnonzero(begins)
    stop = np.append(edges[1:], len(codes))
    g = group[edges]
    line = np.cumsum(g == _BREAK)
    real = (g != _SPACE) & (g != _BREAK)
    space = np.zeros(len(edges), dtype=np.int64)
    space[1:] = g[:-1] == _SPACE
    start, end, g, line, space = edges[real], stop[real], g[real], line[real], space[real]
    n = len(start)
    length = end - start
    ups = np.concatenate([[0], np.cumsum(kind == _UPPER)])
    upper, opens = ups[end] - ups[start], kind[start] == _UPPER if n else np.zeros(0, dtype=bool)
    case = np.where(upper == 0, 0, np.where(upper == length, 2, np.where(opens & (upper == 1), 1, 3)))
    word = case * 4 + np.searchsorted([2, 4, 8], length, side="right")
    number = _WORDS + np.searchsorted(_LENGTHS, length, side="right") - 1
    c = codes[start] if n else codes
    symbol = _WORDS + _NUMBERS + np.where(c < 128, _SYMBOL_ID[np.where(c < 128, c, 0)], len(_SYMBOLS))
    shape = np.where(g == _LETTER, word, np.where(g == _DIGIT, number, symbol)).astype(np.int64)
    lex = np.zeros(n, dtype=np.int64)
    for i in np.flatnonzero((g == _LETTER) & (length <= 10)):
        lex[i] = _LEXICON.get(_word_hash(text[start[i] : end[i]].lower()), 0)
    first = np.flatnonzero(np.append(True, line[1:] != line[:-1])) if n else np.zeros(0, dtype=np.int64)
    return Tokens(start, end, shape, lex, space, first, np.diff(np.append(first, n)))


def _shifted(values: np.ndarray, t: Tokens, by: int, edge: int) -> np.ndarray:
    """values of the token `by` places on, edge beyond the sequence."""
    n = len(values)
    at = np.arange(n) + by
    last = np.repeat(t.first + t.size, t.size)
    begin = np.repeat(t.first, t.size)
    ok = (at >= begin) & (at < last)
    return np.where(ok, values[np.clip(at, 0, max(n - 1, 0))], edge)


def features(t: Tokens) -> np.ndarray:
    """(tokens, templates) of feature ids."""
    s, coarse = t.shape, _coarse_of(t.shape)
    at = {k: _shifted(s, t, k, EDGE) for k in (-2, -1, 1, 2)}
    c = {k: _coarse_of(v) for k, v in at.items()}
    lex = {k: _shifted(t.lex, t, k, 0) for k in (-5, -4, -3, -2, -1, 1, 2)}
    space_next = _shifted(t.space, t, 1, 1)
    parts = [(s, SHAPES), (at[-1], SHAPES), (at[1], SHAPES), (at[-2], SHAPES), (at[2], SHAPES), (c[-1] * SHAPES + s, COARSE * SHAPES), (s * COARSE + c[1], COARSE * SHAPES)]
    parts += [((c[-2] * COARSE + c[-1]) * SHAPES + s, COARSE * COARSE * SHAPES), ((s * COARSE + c[1]) * COARSE + c[2], COARSE * COARSE * SHAPES), ((c[-1] * COARSE + coarse) * COARSE + c[1], COARSE**3)]
    parts += [(t.lex, _LEX), (lex[-1] * COARSE + coarse, _LEX * COARSE), (lex[1] * COARSE + coarse, _LEX * COARSE), (lex[-2] * COARSE + coarse, _LEX * COARSE), (lex[2] * COARSE + coarse, _LEX * COARSE)]
    parts += [((t.space * 2 + space_next) * SHAPES + s, 4 * SHAPES), (t.space * COARSE * COARSE + c[-1] * COARSE + coarse, 2 * COARSE * COARSE)]
    for k in (lambda i: np.maximum.reduce([(lex[j] == i) for j in (-5, -4, -3, -2, -1)]),):
        for i in range(1, _LEX):
            parts.append((k(i) * COARSE + coarse, 2 * COARSE))
    ids, offset = [], 0
    for values, n in parts:
        ids.append(values + offset)
        offset += n
    return np.stack(ids, axis=1)


def n_features() -> int:
    t = tokenize("a")
    probe = features(t)
    sizes = [SHAPES] * 5 + [COARSE * SHAPES] * 2 + [COARSE * COARSE * SHAPES] * 2 + [COARSE**3, _LEX] + [_LEX * COARSE] * 4 + [4 * SHAPES, 2 * COARSE * COARSE] + [2 * COARSE] * (_LEX - 1)
    assert len(sizes) == probe.shape[1]
    return sum(sizes)


@dataclass
class Model:
    kinds: tuple[str, ...]
    weights: np.ndarray  # features x labels
    moves: np.ndarray  # label x next label
    opening: np.ndarray

    def labels(self) -> int:
        return 1 + 2 * len(self.kinds)


def _allowed(k: int) -> np.ndarray:
    """0 where a label may follow, -1e4 else: inside only after begin or inside of its kind. Label 2i+1 begins kind i, 2i+2 goes on."""
    out = np.zeros((k, k))
    for b in range(2, k, 2):
        out[:, b] = -1e4
        out[b - 1, b] = out[b, b] = 0.0
    return out


def _scores(weights: np.ndarray, ids: np.ndarray) -> np.ndarray:
    out = weights[ids[:, 0]].copy()
    for j in range(1, ids.shape[1]):
        out += weights[ids[:, j]]
    return out


def _steps(t: Tokens):
    """Token indices of each step over all sequences, longest first."""
    order = np.argsort(-t.size, kind="stable")
    first, size = t.first[order], t.size[order]
    alive = np.searchsorted(-size, -np.arange(size[0] if len(size) else 0), side="left")
    return first, alive


def decode(model: Model, t: Tokens) -> np.ndarray:
    """The best label of each token by Viterbi, all sequences of t in step."""
    n, k = len(t.start), model.labels()
    if not n:
        return np.zeros(0, dtype=np.int64)
    unary, moves = _scores(model.weights, features(t)), model.moves + _allowed(k)
    first, alive = _steps(t)
    back = np.zeros((n, k), dtype=np.int8)
    best = unary[first] + model.opening
    ends = np.zeros(len(first), dtype=np.int64)
    for step, m in enumerate(alive):
        if step:
            total = best[:m, :, None] + moves
            back[first[:m] + step] = total.argmax(axis=1)
            best[:m] = total.max(axis=1) + unary[first[:m] + step]
    ends = best.argmax(axis=1)
    out = np.zeros(n, dtype=np.int64)
    for step in range(len(alive) - 1, -1, -1):
        m = alive[step]
        later = alive[step + 1] if step + 1 < len(alive) else 0
        at = first[:m] + step
        label = ends[:m].copy()
        label[:later] = back[at[:later] + 1, out[at[:later] + 1]]
        out[at] = label
    return out


def _logsum(a: np.ndarray, axis: int) -> np.ndarray:
    top = a.max(axis=axis, keepdims=True)
    return np.log(np.exp(a - top).sum(axis=axis)) + np.squeeze(top, axis)


def train(texts: list[str], spans: list[list[tuple[str, int, int]]], kinds: tuple[str, ...], rounds: int = 45, rate: float = 0.2, shrink: float = 3e-4) -> Model:
    """Maximum likelihood by Adam over all labelled lines; texts are single lines with (kind, start, end) spans."""
    joined = "\n".join(x.replace("\n", " ") for x in texts)
    t, k = tokenize(joined), 1 + 2 * len(kinds)
    gold, offset = np.zeros(len(t.start), dtype=np.int64), 0
    for text, marks in zip(texts, spans):
        for kind, a, b in marks:
            inside = np.flatnonzero((t.start >= offset + a) & (t.end <= offset + b))
            gold[inside] = 2 * kinds.index(kind) + 2
            gold[inside[:1]] -= 1
        offset += len(text) + 1
    ids = features(t)
    used, compact = np.unique(ids, return_inverse=True)
    compact = compact.reshape(ids.shape)
    first, alive = _steps(t)
    w, moves, opening = np.zeros((len(used), k)), np.zeros((k, k)), np.zeros(k)
    rows = np.arange(len(gold))
    follows = np.ones(len(gold), dtype=bool)
    follows[t.first] = False
    seen = np.zeros((k, k))
    np.add.at(seen, (gold[np.flatnonzero(follows) - 1], gold[follows]), 1)
    opened = np.bincount(gold[t.first], minlength=k).astype(float)
    params = [w, moves, opening]
    m1, m2 = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    flat = compact.ravel()
    for r in range(1, rounds + 1):
        unary, go = _scores(w, compact), moves + _allowed(k)
        fwd, bwd = np.zeros((len(gold), k)), np.zeros((len(gold), k))
        fwd[first] = unary[first] + opening
        for step, m in enumerate(alive[1:], 1):
            fwd[first[:m] + step] = _logsum(fwd[first[:m] + step - 1][:, :, None] + go, 1) + unary[first[:m] + step]
        for step in range(len(alive) - 2, -1, -1):
            m = alive[step + 1]
            bwd[first[:m] + step] = _logsum(go + (unary + bwd)[first[:m] + step + 1][:, None, :], 2)
        whole = np.repeat(_logsum(fwd[t.first + t.size - 1], 1), t.size)[:, None]
        share = np.exp(fwd + bwd - whole)
        later = np.flatnonzero(follows)
        pairs = np.exp(fwd[later - 1][:, :, None] + go + (unary + bwd)[later][:, None, :] - whole[later][:, :, None])
        error = share.copy()
        error[rows, gold] -= 1
        grad_w = np.stack([np.bincount(flat, weights=np.repeat(error[:, j], compact.shape[1]), minlength=len(used)) for j in range(k)], axis=1)
        grads = [grad_w, pairs.sum(axis=0) - seen, share[t.first].sum(axis=0) - opened]
        for p, g, a, b in zip(params, grads, m1, m2):
            g = g / len(texts) + shrink * p
            a += 0.1 * (g - a)
            b += 0.001 * (g * g - b)
            p -= rate * (a / (1 - 0.9**r)) / (np.sqrt(b / (1 - 0.999**r)) + 1e-8)
    full = np.zeros((n_features(), k), dtype=np.float32)
    full[used] = w
    return Model(kinds, full, moves.astype(np.float32), opening.astype(np.float32))


def spans_of(labels: np.ndarray, t: Tokens, kinds: tuple[str, ...]) -> list[tuple[str, int, int]]:
    """(kind, start, end) of each run of a begin and its insides."""
    out = []
    begins = np.flatnonzero(labels % 2 == 1)
    sequence = np.repeat(np.arange(len(t.size)), t.size)
    for i in begins:
        j = i
        while j + 1 < len(labels) and labels[j + 1] == labels[i] + 1 and sequence[j + 1] == sequence[i]:
            j += 1
        out.append((kinds[(labels[i] - 1) // 2], int(t.start[i]), int(t.end[j])))
    return out
