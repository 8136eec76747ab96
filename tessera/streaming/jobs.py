"""Structured Streaming forms: quality gate, versioned edges, graph upsert."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..functions import scores as S
from ..operators import edge_log
from ..operators.buckets import upsert
from ..operators.graph import EDGE, fold_edge
from ..operators.quality import signature

#: transformWithState keeps its state there.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_VALUES = ("status", "is_contested", "valid_from", "valid_to", "cs", "ts")
_VALUE_TYPE = "status string, is_contested boolean, valid_from double, valid_to double, cs double, ts double"


def stream_quality_gate(triples: DataFrame, least: float = 0.9, time: str = "ts", late: str = "1 hour") -> DataFrame:
    """Valid triples, the first of each signature within the watermark."""
    valid = triples.withColumn("confidence", S.coerce_confidence("confidence")).where(S.validity_reason(least=least) == "valid")
    keyed = valid.withColumn("_sig", F.concat_ws("\u0001", *signature()))
    return keyed.withWatermark(time, late).dropDuplicatesWithinWatermark(["_sig"]).drop("_sig")


class EdgeFold(StatefulProcessor):
    """Folds the claims of a source and predicate; current and past edges are maps by target, of which only what changes is written.

    A claim is weighed against the current edges alone, so past ones are looked up by their target and never
    read as a whole.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.current = handle.getMapState("current", "dst string", _VALUE_TYPE)
        self.past = handle.getMapState("past", "dst string", _VALUE_TYPE)

    def _loaded(self, dst: str, values: tuple) -> dict:
        return {"dst": dst} | dict(zip(_VALUES, values))

    def handleInputRows(self, key, rows, timerValues):
        claims = pd.concat(list(rows)).sort_values("seq", kind="stable")
        edges = {k[0]: self._loaded(k[0], v) for k, v in self.current.iterator()}
        before = {d: dict(e) for d, e in edges.items()}
        for dst, cs, ts in zip(claims["dst"], claims["cs"].fillna(0.0), claims["ts"].fillna(0.0)):
            if dst not in edges and self.past.containsKey((dst,)):
                edges[dst] = self._loaded(dst, self.past.getValue((dst,)))
                before[dst] = dict(edges[dst])
            fold_edge(edges, dst, float(cs), float(ts))
        out = []
        for dst, e in edges.items():
            if before.get(dst) == e:
                continue
            e["is_contested"] = bool(e["is_contested"])
            value = tuple(e[v] for v in _VALUES)
            into, other = (self.current, self.past) if e["status"] == "Current" else (self.past, self.current)
            into.updateValue((dst,), value)
            if dst in before and before[dst]["status"] != e["status"]:
                other.removeKey((dst,))
            out.append((*key, dst, *value))
        yield pd.DataFrame(out, columns=[x.split()[0] for x in EDGE.split(", ")])

    def handleInitialState(self, key, initialState, timerValues) -> None:
        for r in initialState[["dst", *_VALUES]].itertuples(index=False):
            value = tuple(None if pd.isna(v) else v for v in r[1:])
            (self.current if r.status == "Current" else self.past).updateValue((r.dst,), value)

    def close(self) -> None:
        pass


def stream_versioned_edges(claims: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """The edges that each batch of claims(src, predicate, dst, cs, ts, seq) changes, folded in order of seq within it over existing edges.

    The last row of a (src, predicate, dst) is that edge's state. Needs the state store ROCKSDB. Each edge
    that a claim meets is asked from the store by Python: for batches of many claims take stream_edge_log.
    """
    rows = claims.select("src", "predicate", "dst", F.col("cs").cast("double").alias("cs"), F.col("ts").cast("double").alias("ts"), "seq")
    first = {} if existing is None else {"initialState": existing.groupBy("src", "predicate")}
    return rows.groupBy("src", "predicate").transformWithStateInPandas(EdgeFold(), EDGE, "Update", "None", **first)


def stream_edge_log(claims: DataFrame, folder: str, checkpoint: str, existing: DataFrame | None = None, **fold):
    """Starts a query that folds each batch of claims(src, predicate, dst, cs, ts, seq) into the log of edges in folder (operators.edge_log).

    The edges are those of stream_versioned_edges, folded in the JVM; edge_log.read_edges has them after any
    batch, keys without a claim among them. A batch done twice gives the same.
    """
    def write(batch: DataFrame, number: int) -> None:
        edge_log.append(batch, folder, number, existing, **fold)

    return claims.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stream_upsert_graph(nodes: DataFrame, folder: str, checkpoint: str, buckets: int = 64):
    """Starts a query that upserts each batch of nodes(id, attributes, seq) into the bucketed table in folder (operators.buckets).

    A batch reads and writes the buckets of its ids. An attribute's greatest seq wins over all batches;
    without a seq a later batch wins. A batch done twice gives the same.
    """
    def write(batch: DataFrame, number: int) -> None:
        upsert(batch, folder, number, buckets)

    return nodes.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
