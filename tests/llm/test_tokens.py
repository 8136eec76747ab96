import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from .conftest import ROWS

from tessera.llm.packing import best_fit_packing, plan_patterns
from tessera.llm.range_coder import decode_blocks, encode_blocks
from tessera.llm.token_counts import MARK, CountTrie, best_pieces, fit_scores, token_counts
from tessera.llm.token_output import crc32_joined, read_token_blocks, write_token_blocks
from tessera.llm.tokens import WordEncoder, tokenizer_path

TOK = Tokenizer.from_file(tokenizer_path())
ENC = WordEncoder(tokenizer_path())


def ids(text):
    return np.array(TOK.encode(text or "", add_special_tokens=False).ids + [1], dtype="<u4")


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(codec="utf-8"), st.sampled_from(" \n\t\x0b\x1c\u0085　'sdSÉé.,!<|>ſŉ½²")), max_size=40))
def test_word_encoder_is_the_library(text):
    assert ENC.encode([text])[0] == np.array(TOK.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()


def test_packing(docs, no_docs):
    got = best_fit_packing(docs).collect()
    want = sorted((r[0], k, s, min(4096, len(v) - s), zlib.crc32(v[s : s + 4096].tobytes())) for r in ROWS for v in [ids(r[1])] for k, s in enumerate(range(0, len(v), 4096)))
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for s in by.values():
        at = 0
        for offset, n in sorted(s):
            assert offset == at
            at += n
        assert at <= 4096
    assert len(by) == -(-sum(r.length for r in got) // 4096)
    assert best_fit_packing(no_docs).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_plan(seed):
    rng = random.Random(seed)
    cap = rng.choice([7, 30, 100])
    counts = {rng.randint(1, cap): rng.randint(1, 50) for _ in range(rng.randint(1, 40))}
    used = {}
    for parts, times in plan_patterns(counts, cap):
        assert 0 < sum(parts) <= cap and times > 0
        for p in parts:
            used[p] = used.get(p, 0) + times
    assert used == counts


@settings(max_examples=25, deadline=None)
@given(st.lists(st.lists(st.one_of(st.integers(0, 65535), st.integers(0, 5), st.integers(0, (1 << 32) - 1)), max_size=300), min_size=1, max_size=6))
def test_coder_round_trip(blocks):
    blocks = sorted((np.array(b, dtype=np.int64) for b in blocks), key=len, reverse=True)
    back = decode_blocks(encode_blocks(blocks), [len(b) for b in blocks])
    assert all(np.array_equal(a, b) for a, b in zip(blocks, back))


def test_coder_gains_on_repeats():
    block = np.tile(np.arange(100, 160), 60)
    assert len(encode_blocks([block])[0]) < len(block) // 4


def test_coder_is_smaller_than_zlib_on_ids_of_texts():
    import pyarrow.parquet as pq

    texts = pq.read_table("/root/testdata/sf0.001/documents.parquet", columns=["text"]).column("text").to_pylist()
    data = np.concatenate([ids(t) for t in texts]).astype(np.int64)
    blocks = [data[i : i + 2048] for i in range(0, len(data), 2048)]
    coded = encode_blocks(blocks)
    assert sum(map(len, coded)) < 0.9 * sum(len(zlib.compress(b.astype("<u2").tobytes(), 9)) for b in blocks)
    assert encode_blocks(blocks[3:5])[0] == coded[3]  # a block's bytes are its own


def test_coder_round_trip_over_lanes():
    """Blocks of several lanes, in any order: one id, all ids different, ids of 32 bits, pairs that a list has and a pair has."""
    rng = np.random.default_rng(5)
    words = [rng.integers(0, 3000, n) for n in rng.integers(1, 6, 200)]
    text = np.concatenate([words[k] for k in rng.zipf(1.3, 20_000) % 200])
    blocks = [text[:513], np.zeros(0, dtype=np.int64), np.full(5000, 7), rng.permutation(40_000), text, rng.integers(0, 1 << 32, 3000), text[:512], text[:1]]
    coded = encode_blocks(blocks)
    back = decode_blocks(coded, [len(b) for b in blocks])
    assert all(np.array_equal(a, b) for a, b in zip(blocks, back))
    assert all(c == encode_blocks([b])[0] for b, c in zip(blocks, coded))
    assert len(coded[2]) < 300 and len(coded[4]) < 0.8 * len(zlib.compress(text.astype("<u2").tobytes(), 9))


def test_coder_keeps_its_time_and_size():
    """Blocks as the operator cuts them: a few microseconds an id both ways, and less than a byte an id."""
    import time

    import pyarrow.parquet as pq

    from tessera.llm.token_output import BLOCK

    texts = pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["text"]).column("text").to_pylist()
    data = np.frombuffer(b"".join(ENC.encode(texts)), dtype="<u4")[: 1 << 19].astype(np.int64)
    blocks = [data[i : i + BLOCK] for i in range(0, len(data), BLOCK)]
    before = time.process_time()
    coded = encode_blocks(blocks)
    back = decode_blocks(coded, [len(b) for b in blocks])
    assert time.process_time() - before < 4e-6 * len(data)
    assert np.array_equal(np.concatenate(back), data) and sum(map(len, coded)) < 0.95 * len(data)


def test_ties_of_doc_id_have_an_order(spark, tmp_path):
    rows = [(1, "b b"), (None, "c"), (1, "a"), (None, "d e f"), (1, "b b"), (2, None)]
    found = []
    for k in (1, 4):
        write_token_blocks(spark.createDataFrame(rows, "doc_id long, text string").repartition(k), f"file://{tmp_path}/{k}")
        found.append(sorted(map(str, read_token_blocks(spark, f"file://{tmp_path}/{k}").collect())))
    assert found[0] == found[1] and len(found[0]) == 6


@given(st.binary(max_size=50), st.binary(max_size=50))
def test_crc_join(a, b):
    assert crc32_joined(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)


def test_blocks_round_trip(spark, docs, no_docs, tmp_path):
    write_token_blocks(docs, f"file://{tmp_path}/b", block=64)
    got = sorted(tuple(r) for r in read_token_blocks(spark, f"file://{tmp_path}/b").collect())
    want, at = [], 0
    for r in sorted(ROWS, key=lambda r: r[0]):
        v = ids(r[1])
        want.append((r[0], at, len(v), zlib.crc32(v.tobytes())))
        at += len(v)
    assert got == sorted(want)
    write_token_blocks(no_docs, f"file://{tmp_path}/e")
    assert read_token_blocks(spark, f"file://{tmp_path}/e").count() == 0


def test_damage_is_found(spark, docs, tmp_path):
    write_token_blocks(docs, f"file://{tmp_path}/b")
    blocks = spark.read.parquet(f"file://{tmp_path}/b")
    blocks.selectExpr("part", "block", "first", "n_ids", "crc32 + 1 as crc32", "rows", "docs", "lengths", "payload").write.parquet(f"file://{tmp_path}/c")
    with pytest.raises(Exception, match="damaged"):
        read_token_blocks(spark, f"file://{tmp_path}/c").count()


def best_cut(word, pieces):
    longest = max(map(len, pieces))
    state = [(0.0, 0)]
    for end in range(1, len(word) + 1):
        n = len(word[end - 1].encode())
        options = [(state[end - 1][0] - 40.0 * n, -(state[end - 1][1] + n))]
        for start in range(max(0, end - longest), end):
            if word[start:end] in pieces:
                options.append((pieces[word[start:end]] + state[start][0], -(state[start][1] + 1)))
        best = max(options)
        state.append((best[0], -best[1]))
    return state[-1][1]


def test_trie_counts_small_tables():
    pieces = {"a": -1.0, "ab": -1.5, "b": -1.0, MARK: -1.0, MARK + "a": -1.2, "bab": -2.0}
    rng = random.Random(2)
    texts = [" ".join("".join(rng.choice("abcé") for _ in range(rng.randint(1, 8))) for _ in range(rng.randint(0, 20))) for _ in range(60)] + [None, ""]
    trie = CountTrie(pieces, max_words=5, max_nodes=7)
    for t in texts:
        ws = (t or "").split()
        assert trie.counts([t]) == [(len(ws), sum(best_cut(MARK + w, pieces) for w in ws))]


def test_long_words_need_no_trie():
    pieces = {"a": -1.0, "ab": -1.5, "b": -1.0, MARK: -1.0, "bab": -2.0}
    rng = random.Random(4)
    for n in (1, 5, 300):
        word = "".join(rng.choice("abc") for _ in range(n))
        assert CountTrie(pieces, longest_word=2).counts([word]) == [(1, best_cut(MARK + word, pieces))]
    trie = CountTrie(pieces)
    assert trie.counts(["ab" * 300_000])[0][0] == 1 and len(trie.score) < 10


def test_token_counts(spark, docs, no_docs):
    """Against best cuts by scores fitted here in the same way."""
    import math

    pieces = {p: -2.0 - k / 10 for k, p in enumerate([MARK, MARK + "a", "lpha", "a", "b", "eta", "ta", "e", "m", "mu", "nu", "n", "u", "x", "i", "xi", "pi", "p", "z", "zz"])}
    want = dict(pieces)
    counts = {}
    for r in ROWS:
        for w in (r[1] or "").encode().split():
            counts[w.decode()] = counts.get(w.decode(), 0) + 1
    for _ in range(2):
        seen = {}
        for w, n in counts.items():
            if len(w) <= 100:
                for p in best_pieces(MARK + w, want, 6):
                    seen[p] = seen.get(p, 0) + n
        want = {p: math.log((seen.get(p, 0) + 1) / (sum(seen.values()) + len(want))) for p in want}
    fitted = fit_scores(docs, pieces)
    assert fitted == want and fitted != pieces
    got = sorted((r.doc_id, r.n_words, r.n_tokens) for r in token_counts(docs, fitted).collect())
    assert got == sorted((r[0], len((r[1] or "").encode().split()), sum(best_cut(MARK + w.decode(), fitted) for w in (r[1] or "").encode().split())) for r in ROWS)
    assert all((r.n_tokens > 0) == (r.n_words > 0) for r in token_counts(docs).collect())
    assert token_counts(no_docs).count() == 0


def test_scores_come_from_all_words(spark):
    """More distinct words than any bound there was, and words that are cut alone."""
    import math

    rng = random.Random(3)
    pieces = {p: -1.0 - k for k, p in enumerate([MARK, MARK + "a", "a", "b", "ab", "bab", "cc", "c", "é", "日本", *map(str, range(120))])}
    words = [f"{rng.choice(['a', 'b', 'ab', 'é'])}{k}" for k in range(60_000)] + ["日本" * 30, "ab" * 60, "abc" * 700, "x\x00"]
    seen = {}
    for w in words:
        for p in best_pieces(MARK + w, pieces, 4):
            seen[p] = seen.get(p, 0) + 2
    want = {p: math.log((seen.get(p, 0) + 1) / (sum(seen.values()) + len(pieces))) for p in pieces}
    texts = spark.createDataFrame([(" ".join(words[k::50]),) for k in range(50)] * 2, "text string")
    assert fit_scores(texts, pieces, rounds=1, longest_word=None) == want


def test_words_side_by_side_are_cut_as_alone():
    pieces = {"a": -1.0, "ab": -2.0, "b": -1.0, MARK: -1.0, MARK + "a": -1.2, "bab": -2.0, "cé": -3.0}
    rng = random.Random(6)
    words = sorted({"".join(rng.choice("abcé\x00") for _ in range(rng.choice([1, 3, 8, 60]))) for _ in range(900)} | {"ab" * 700})
    want = [best_cut(MARK + w, pieces) for w in words]
    assert CountTrie(pieces).counts([" ".join(words)]) == [(len(words), sum(want))]
    assert [CountTrie(pieces).counts([w])[0][1] for w in words] == want


def test_table_of_words_is_bounded_and_shared_by_variants():
    enc = WordEncoder(tokenizer_path(), max_words=8)
    for text in ("Alpha, alpha ALPHA. alpha!!", "Écoles; écoles", None, " one  two\x1cthree\u0085four\u3000five ", "it's 3.14 ½ <|endoftext|> ﬁn", "x" * 3000, ""):
        got = enc.encode([text, text])
        assert got == [np.array(TOK.encode(text or "", add_special_tokens=False).ids, dtype="<u4").tobytes()] * 2
        assert len(enc.words) <= 8
    enc.clear()
    enc.encode(["Alpha, alpha ALPHA. alpha!! alpha,"])
    assert sorted(enc.words.to_pylist()) == ["", "!!", ",", ".", "alpha"]


def test_texts_are_packed_whole_over_slices(spark):
    """Texts that are longer than a slice of a task, nulls between them."""
    rows = [(k, None if k % 7 == 0 else ("wört %d, " % k) * (400_000 if k == 3 else k)) for k in range(30)]
    got = best_fit_packing(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)).collect()
    want = sorted((i, k, s, min(4096, len(v) - s), zlib.crc32(v[s : s + 4096].tobytes())) for i, t in rows for v in [ids(t)] for k, s in enumerate(range(0, len(v), 4096)))
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
