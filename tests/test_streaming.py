import random

import pytest

from tessera.operators import buckets
from tessera.operators.graph import fold_edge, resolve_conflicts
from tessera.streaming import jobs

CLAIM = "src string, predicate string, dst string, cs double, ts double, seq int"
KEY = "spark.sql.streaming.stateStore.providerClass"


@pytest.fixture
def rocks(spark):
    spark.conf.set(KEY, jobs.ROCKSDB)
    yield spark
    spark.conf.unset(KEY)


def put(spark, rows, schema, folder):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"file://{folder}")


def run(stream, folder, mode="update"):
    """The batches of a stream up to the end of its input."""
    got = []
    q = stream.writeStream.outputMode(mode).option("checkpointLocation", f"file://{folder}/cp").trigger(availableNow=True).foreachBatch(lambda b, n: got.append((n, b.collect()))).start()
    q.awaitTermination(180)
    return [rows for _, rows in got if rows]


def edges_of(batches, state):
    for rows in batches:
        state |= {(r.src, r.predicate, r.dst): (r.status, r.is_contested, r.valid_from, r.valid_to, r.cs, r.ts) for r in rows}
    return state


def test_edges_over_batches_and_a_restart(rocks, tmp_path):
    """Three batches, the last after a restart from the checkpoint, equal one fold of all claims; a batch gives what it changes."""
    rng = random.Random(7)
    claims = [(f"s{rng.randint(0, 3)}", "p", f"{rng.randint(1, 6)} km", rng.choice((0.5, 0.55, 0.9)), float(rng.randint(1, 9)), i) for i in range(90)]
    stream = lambda: jobs.stream_versioned_edges(rocks.readStream.schema(CLAIM).option("maxFilesPerTrigger", 1).parquet(f"file://{tmp_path}/in"))
    for part in (claims[:30], claims[30:60]):
        put(rocks, part, CLAIM, tmp_path / "in")
    batches = run(stream(), tmp_path)
    assert len(batches) == 2
    state = edges_of(batches, {})
    put(rocks, claims[60:], CLAIM, tmp_path / "in")
    put(rocks, [("s0", "p", "none", 0.0, 0.0, 999)], CLAIM, tmp_path / "in")
    again = run(stream(), tmp_path)
    assert [(r.dst, r.status) for r in again[-1]] == [("none", "History")]
    want = resolve_conflicts(rocks.createDataFrame([*claims, ("s0", "p", "none", 0.0, 0.0, 999)], CLAIM)).collect()
    assert edges_of(again, state) == edges_of([want], {})


def test_edges_begin_with_existing_ones(rocks, tmp_path):
    first = [("a", "p", "1 km", 0.9, 5.0, 1), ("a", "p", "7 km", 0.2, 6.0, 2), ("b", "p", "x", 0.5, 1.0, 3)]
    later = [("a", "p", "9 km", 0.95, 9.0, 4), ("a", "p", "7 km", 0.99, 10.0, 5)]
    put(rocks, later, CLAIM, tmp_path / "in")
    old = resolve_conflicts(rocks.createDataFrame(first, CLAIM))
    batches = run(jobs.stream_versioned_edges(rocks.readStream.schema(CLAIM).parquet(f"file://{tmp_path}/in"), old), tmp_path)
    whole = edges_of([resolve_conflicts(rocks.createDataFrame(later, CLAIM), old).collect()], {})
    got = edges_of(batches, {})
    assert got == {k: v for k, v in whole.items() if k[0] == "a"} and got["a", "p", "7 km"][0] == "Current"


def test_gate_over_batches_with_late_rows(spark, tmp_path):
    """What repeats within the watermark goes, in another batch too; a row beyond it is late and goes; one after it is new."""
    schema = "subject string, predicate string, object string, confidence double, t int"
    batches = [[("Mars", "near", "Sun", 0.95, 0), ("Mars", "near", "Sun", 0.99, 5)], [("mars", "near", "sun", 0.95, 900), ("Io", "orbits", "Jupiter", 1.0, 3000)], [("Venus", "near", "Sun", 1.0, -7200), ("Ceres", "in", "Belt", 0.1, 3000)], [("Pluto", "near", "Sun", 1.0, 90_000)], [("Eris", "near", "Sun", 1.0, 90_001)], [("Mars", "near", "Sun", 0.95, 99_000)]]
    for rows in batches:
        put(spark, rows, schema, tmp_path / "in")
    raw = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"file://{tmp_path}/in").selectExpr("* except (t)", "timestamp_seconds(1700000000 + t) as ts")
    got = [sorted(r.subject for r in rows) for rows in run(jobs.stream_quality_gate(raw), tmp_path, "append")]
    assert got == [["Mars"], ["Io"], ["Pluto"], ["Eris"], ["Mars"]]


NODE = "id string, attributes map<string,string>, seq long"


def folders(spark, folder, version):
    path = spark._jvm.org.apache.hadoop.fs.Path(f"file://{folder}/data/v{version}")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return {s.getPath().getName() for s in fs.listStatus(path) if s.isDirectory()} if fs.exists(path) else set()


def test_upsert_keeps_the_greatest_seq_and_writes_touched_buckets(spark, tmp_path):
    batches = [[(f"n{i}", {"x": "10", "y": "a"}, 10) for i in range(200)], [("n7", {"x": "2", "z": "new"}, 2), ("n7", {"y": "b"}, 11)], [("n7", {"name": "no", "y": "c"}, 11), (None, {"x": "lost"}, 99), ("empty", None, 1)]]
    for rows in batches:
        put(spark, rows, NODE, tmp_path / "in")
    stream = spark.readStream.schema(NODE).option("maxFilesPerTrigger", 1).parquet(f"file://{tmp_path}/in")
    jobs.stream_upsert_graph(stream, f"file://{tmp_path}/out", f"file://{tmp_path}/cp", buckets=16).awaitTermination(180)
    got = {r.id: r.attributes for r in buckets.read_nodes(spark, f"file://{tmp_path}/out").collect()}
    assert len(got) == 201
    assert got["n7"] == {"name": "n7", "x": "10", "y": "c", "z": "new"} and got["n8"] == {"name": "n8", "x": "10", "y": "a"} and got["empty"] == {"name": "empty"}
    assert len(folders(spark, tmp_path / "out", 2)) <= 2
    assert buckets.versions(spark, f"file://{tmp_path}/out") == [1, 2]
    assert len(folders(spark, tmp_path / "out", 1)) == 1 and len(folders(spark, tmp_path / "out", 0)) >= 14


def test_a_version_written_twice_is_the_same(spark, tmp_path):
    folder = f"file://{tmp_path}/t"
    put_ = lambda v, rows: buckets.upsert(spark.createDataFrame(rows, "id string, attributes map<string,string>"), folder, v, 4)
    put_(0, [("a", {"x": "1"})])
    put_(1, [("a", {"x": "2"})])
    put_(1, [("a", {"x": "3"})])
    assert buckets.read_nodes(spark, folder).first().attributes == {"name": "a", "x": "2"}
    assert buckets.read_nodes(spark, folder, 0).first().attributes == {"name": "a", "x": "1"}
    assert buckets.read_nodes(spark, f"file://{tmp_path}/none").count() == 0


def test_fold_edge_of_an_equal_claim_changes_times_only():
    state = {}
    fold_edge(state, "1 km", 0.5, 1.0)
    fold_edge(state, "1 km", 0.6, 2.0)
    assert state["1 km"]["status"] == "Current" and state["1 km"]["valid_from"] == 2.0


def test_a_log_of_edges_over_batches_and_a_restart(spark, tmp_path):
    """Batches over existing edges, gathered every second one, with runs of 7 claims, equal one fold; a batch done again changes nothing."""
    from tessera.operators import edge_log

    rng = random.Random(3)
    claims = [(f"s{rng.randint(0, 3)}", "p", f"{rng.randint(1, 6)} km", rng.choice((0.5, 0.55, 0.9, None)), float(rng.randint(1, 9)), i) for i in range(120)]
    old = resolve_conflicts(spark.createDataFrame([*claims[:20], ("lone", "p", "x", 0.5, 1.0, 0)], CLAIM))
    start = lambda: jobs.stream_edge_log(spark.readStream.schema(CLAIM).option("maxFilesPerTrigger", 1).parquet(f"file://{tmp_path}/in"), f"file://{tmp_path}/log", f"file://{tmp_path}/cp", old, gather=2, run=7).awaitTermination(180)
    for i in range(20, 80, 20):
        put(spark, claims[i : i + 20], CLAIM, tmp_path / "in")
    start()
    for i in range(80, 120, 20):
        put(spark, claims[i : i + 20], CLAIM, tmp_path / "in")
    start()
    edge_log.append(spark.createDataFrame(claims[:5], CLAIM), f"file://{tmp_path}/log", 2)
    assert edge_log.versions(spark, f"file://{tmp_path}/log/log") == [-1, 0, 1, 2, 3, 4] and edge_log.versions(spark, f"file://{tmp_path}/log/current") == [1, 3]
    for version, n in ((None, 120), (1, 60)):
        want = resolve_conflicts(spark.createDataFrame(claims[20:n], CLAIM), old).collect()
        assert edges_of([edge_log.read_edges(spark, f"file://{tmp_path}/log", version).collect()], {}) == edges_of([want], {})
    assert edge_log.read_edges(spark, f"file://{tmp_path}/none").count() == 0


def test_the_streaming_query_keeps_no_state_by_claim(spark, monkeypatch):
    """Asking Python's state store claim by claim took 0.6 ms of a core each."""
    from pyspark.sql.streaming import DataStreamWriter

    from tessera.plans import catalog

    begun, start = [], DataStreamWriter.start
    monkeypatch.setattr(DataStreamWriter, "start", lambda *a, **b: begun.append(start(*a, **b)) or begun[-1])
    assert catalog.queries()["stream_versioned_edges"](spark, "/root/testdata/sf0.001").count() > 0
    assert len(begun) == 1 and not any(p["stateOperators"] for p in begun[0].recentProgress)
