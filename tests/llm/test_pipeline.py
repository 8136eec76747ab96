import corpus_pipeline
from .conftest import ROWS, words
from .test_decontamination import split
from .test_dedup import brute_components
from .test_tokens import ids


def test_stages_against_brute_force(spark, docs, tmp_path):
    secret = 'note token = "0123456789abcdef0123456789abcdef01234567" ' + words(30)
    more = spark.createDataFrame([(50 + k, f"{secret} {k} {words(25)}", "en", "s", 1, *ROWS[0][5:]) for k in range(3)], docs.schema)
    docs.union(more).select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"file://{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, ROWS[12][1])], "item_id long, text string").write.parquet(f"file://{tmp_path}/benchmark.parquet")
    sf = f"file://{tmp_path}"
    now = spark.read.parquet(f"{sf}/documents.parquet")
    columns = now.columns
    kept = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, now, sf)
        assert out.columns == columns
        out.write.parquet(f"file://{tmp_path}/out-{name.replace(' ', '-')}")
        now = spark.read.parquet(f"file://{tmp_path}/out-{name.replace(' ', '-')}")
        kept.append({r.doc_id: r.text for r in now.collect()})
    rows = spark.read.parquet(f"{sf}/documents.parquet").collect()
    lettered = [r for r in rows if any(c.isalpha() for c in r.text or "")]
    assert set(kept[0]) == {r.doc_id for r in lettered}
    lows = {r.doc_id: c for r, (_, _, c) in zip(sorted(lettered, key=lambda r: r.doc_id), brute_components(lettered, 5, 80))}
    assert set(kept[1]) == {d for d, c in lows.items() if d == c}
    passage = split(ROWS[12][1])
    windows = {tuple(passage[i : i + 10]) for i in range(len(passage) - 9)}
    assert set(kept[2]) == {d for d, t in kept[1].items() if not any(tuple(split(t)[i : i + 10]) in windows for i in range(len(split(t))))}
    assert set(kept[3]) == set(kept[2]) and all("0123456789abcdef0123456789abcdef01234567" not in t for t in kept[3].values())
    packed = corpus_pipeline.STAGES[-1][1](spark, now, sf).collect()
    assert sum(r.length for r in packed) == sum(len(ids(t)) for t in kept[3].values())
    ran = corpus_pipeline.run(spark, sf).collect()
    assert sorted((r.doc_id, r.piece, r.ids_crc32) for r in ran) == sorted((r.doc_id, r.piece, r.ids_crc32) for r in packed)


def test_rows_of_one_or_no_doc_id(spark, tmp_path):
    a, b, c = words(60), words(60), words(60)
    passage = words(30)
    rows = [(None, a), (None, b), (None, b), (7, a + " tail"), (7, c), (8, c), (8, f"{words(20)} {passage}"), (None, f"{passage} {words(20)}"), (9, None), (9, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    docs.write.parquet(f"file://{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"file://{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"file://{tmp_path}/benchmark.parquet")
    order = lambda found: sorted(found, key=str)
    got = corpus_pipeline.near_duplicates(spark, docs, f"file://{tmp_path}")
    assert order(map(tuple, got.collect())) == order([(7, a + " tail"), (None, b), (7, c), *rows[6:]])
    got = corpus_pipeline.without_benchmarks(spark, docs, f"file://{tmp_path}")
    assert order(map(tuple, got.collect())) == order(r for r in rows if passage not in (r[1] or ""))


def test_language_stage_rejects_by_cosine(spark):
    latin = [(k, words(40), "en") for k in range(300)]
    noise = [(1000, "q" * 300, None), (1001, "q" * 300, "en"), (None, "日本語テキスト漢字" * 30, None), (1002, "漢" * 20_000, None), (1003, "1234 " * 60, "en")]
    docs = spark.createDataFrame(latin + noise, "doc_id long, text string, lang string")
    assert {r.doc_id for r in corpus_pipeline.language(spark, docs, "").collect()} == {r[0] for r in latin}
    blank = spark.createDataFrame([(k, t, None) for k, t, _ in latin + noise], docs.schema)
    assert corpus_pipeline.language(spark, blank, "").count() == len(latin) + 4


_WORKER = """
import ctypes, io, re, sys
sys.path.insert(0, sys.argv[1])
import numpy as np, pyarrow as pa
from tessera.llm import packing

class Docs:  # takes the function that a worker would run
    def select(self, *_):
        return self
    col = cast = select
    def mapInArrow(self, run, _):
        self.run = run

def held():
    return sum(map(int, re.findall(r"Pss_(?:Anon|Shmem):\\s+(\\d+)", open("/proc/self/smaps_rollup").read()))) / 1024

rng, docs = np.random.default_rng(1), Docs()
words = np.array(["".join(map(chr, rng.integers(97, 123, 6))) for _ in range(20_000)])
data = io.BytesIO()
with pa.ipc.new_stream(data, pa.schema([("doc_id", pa.int64()), ("text", pa.string())])) as out:
    out.write(pa.record_batch([pa.array(range(4_000)), pa.array([" ".join(rng.choice(words, 600)) for _ in range(4_000)])], names=["doc_id", "text"]))
packing.F = docs
packing.token_pieces(docs)
for text in ("", "a b"):  # loads what stays
    list(docs.run([pa.record_batch([pa.array([1]), pa.array([text])], names=["doc_id", "text"])]))
pa.default_memory_pool().release_unused()
ctypes.CDLL(None).malloc_trim(0)
before = held()
assert sum(len(x) for x in docs.run(iter(pa.ipc.open_stream(data.getbuffer())))) == 4_000
print(held() - before)
"""


def test_workers_hold_little_after_a_task(tmp_path):
    import subprocess
    import sys
    from pathlib import Path

    (tmp_path / "worker.py").write_text(_WORKER)
    ran = subprocess.run([sys.executable, tmp_path / "worker.py", Path(corpus_pipeline.__file__).parent], capture_output=True, text=True, timeout=300)
    assert ran.returncode == 0, ran.stderr
    assert float(ran.stdout) < 15, ran.stdout  # MB
