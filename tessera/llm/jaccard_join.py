"""N-gram Jaccard join with signature trees.

A text's set is its distinct word shingles. Texts with equal sets are one member. Members meet where
they share a prefix token: of each set the ``n - ceil(t n) + 1`` tokens that come first in one order of
all tokens, rare ones first (an order by a count sketch of the whole corpus, then by hash); two sets with
Jaccard t or more share one. Members of such a block have a signature, a bitmap of their tokens as long as their size class asks for. A
signature tree over the block has OR-combined bitmaps, size ranges and the greatest surplus of tokens
over bits in its nodes; a dual traversal drops node pairs whose possible overlap is too small and leaves
the block's members that may link with another one in it.

Blocks that such members share make up a group, which meets once, with whole sets. There a second tree
yields the pairs whose sets are compared; node pairs that are one component already are left out, so a
group of very many near copies doesn't become all pairs, and only links leave the task. A group of more
than ``max_group`` members is dealt to parts, each with a few members that all parts have, which tie them
together. Only if it is not one component then, its parts meet in pairs.

Copies are cut before the shuffle by tokens: a task gives the tokens of a set once. Identity of sets is
that of two 64-bit hashes and of their size.

Defined cases: null texts and texts without words have an empty set and link with nothing; repeated
rows and texts with equal sets are in one component; a component without any doc_id has a null id;
other columns are not read, but for those to be carried along.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .bytehash import many_word_hashes, mix, shingle_set
from .common import Staging, broadcast_within, chunks_of, lean, sliced, staged
from .components import components

BITS = 1024  # of a bitmap of up to 256 tokens; twice as many for each doubling
_GROUP = 500_000
_FAN = 16


def _sets(texts, size):
    for a, b in chunks_of(texts, _GROUP):
        for k, ws in enumerate(many_word_hashes(texts[a:b]), a):
            yield k, shingle_set(ws, size)


def sketch_bits(rows: int) -> int:
    """Of a token hash, for the place in the sketch: about 16 places a row, from 2**16 up to 2**24, a bound of 16 MB."""
    return min(24, max(16, (16 * rows).bit_length()))


def _packed(counts: np.ndarray) -> bytes:
    """Counts in as few bytes each as the largest needs."""
    kind = np.min_scalar_type(int(counts.max(initial=0)))
    return bytes([kind.itemsize]) + zlib.compress(counts.astype(kind).tobytes(), 1)


def _unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(data[1:]), dtype=f"u{data[0]}")


def token_sketch(docs: DataFrame, size: int = 4, bits: int = 20, slices: int = 64) -> np.ndarray:
    """8 log2 of how many sets hold tokens of each of 2**bits hash ranges."""
    slices = min(slices, 1 << bits)
    width = (1 << bits) // slices

    def count(batches):
        sums = np.zeros(1 << bits, dtype=np.int32)
        for batch in sliced(batches):
            for _, s in _sets(batch.column(0).to_pylist(), size):
                np.add.at(sums, (s >> np.uint64(64 - bits)).astype(np.int64), 1)
        packed = [_packed(sums[i : i + width]) for i in range(0, 1 << bits, width)]
        yield pa.RecordBatch.from_arrays([pa.array(range(slices), pa.int32()), pa.array(packed, pa.binary())], names=["at", "sums"])

    def add(parts: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(width, dtype=np.int64)
        for part in parts["sums"]:
            total += _unpacked(part)
        return pd.DataFrame({"at": parts["at"].iloc[:1], "sums": [_packed(total)]})

    # parts are added twice over, so that no task gets the parts of all others
    parts = docs.select("text").mapInArrow(lean(count), "at int, sums binary").withColumn("_part", F.pmod(F.xxhash64("sums"), F.lit(8)))
    whole = parts.groupBy("at", "_part").applyInPandas(add, "at int, sums binary").groupBy("at").applyInPandas(add, "at int, sums binary")
    out = np.zeros(1 << bits, dtype=np.int64)
    for r in whole.collect():
        out[r["at"] * width : (r["at"] + 1) * width] = _unpacked(r["sums"])
    return np.minimum(8 * np.log2(out + 1), 255).astype(np.uint8)


def _size_class(n: int) -> int:
    return max(0, (n - 1).bit_length() - 8)


def _bitmap(s: np.ndarray, size_class: int) -> bytes:
    """A bit for each token; that of a lower class is the same as two halves ORed."""
    out = np.zeros(BITS << size_class, dtype=bool)
    out[(mix(s) & np.uint64((BITS << size_class) - 1)).astype(np.int64)] = True
    return np.packbits(out).tobytes()


def _set_key(s: np.ndarray) -> tuple[int, int]:
    return tuple(int(mix(s ^ np.uint64(x)).sum(dtype=np.uint64).view(np.int64)) for x in (11, 12))


def signatures(docs: DataFrame, sketch: np.ndarray, size: int = 4, percent: int = 85, carry: tuple[str, ...] = ()) -> DataFrame:
    """(rid, node, doc_id, n, h1, h2, tokens, class, bits, low, carried columns) of each row: number of the row and of the task's first one of its set, set size, set hash, prefix tokens,
    bitmap of its size class, and that of the class below if sets of it may link; the last four of the task's first row of a set only."""
    ranks, shift = docs.sparkSession.sparkContext.broadcast(sketch), np.uint64(65 - len(sketch).bit_length())

    def sign(batches):
        from pyspark import TaskContext

        rank, rid, seen = ranks.value, TaskContext.get().partitionId() << 33, {}
        for batch in sliced(batches):
            texts = batch.column(1).to_pylist()
            cols = [[], [], [], [], [], [], [], [], []]
            for _, s in _sets(texts, size):
                n, k = len(s), _size_class(len(s))
                h1, h2 = _set_key(s)
                if len(seen) > 100_000:
                    seen.clear()
                node = seen.setdefault((h1, h2, n), rid)
                tokens = bits = low = None
                if n and node == rid:
                    order = np.lexsort((s, rank[(s >> shift).astype(np.int64)]))[: n - (percent * n + 99) // 100 + 1]
                    tokens, bits = s[order].view(np.int64), _bitmap(s, k)
                    low = _bitmap(s, k - 1) if k and percent * n <= 100 << (k + 7) else None
                for col, v in zip(cols, (rid, node, n, h1, h2, tokens, k, bits, low)):
                    col.append(v)
                rid += 1
            types = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.int32(), pa.binary(), pa.binary())
            made = [pa.array(c, t) for c, t in zip(cols, types)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *made, *batch.columns[2:]], names=["doc_id", "rid", "node", "n", "h1", "h2", "tokens", "class", "bits", "low", *carry])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *carry)
    more = "".join(f", `{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[2:])
    return rows.mapInArrow(lean(sign), "doc_id long, rid long, node long, n int, h1 long, h2 long, tokens array<long>, class int, bits binary, low binary" + more)


def _need(na, nb, percent):
    """Least overlap of sets of these sizes that link."""
    return -(-percent * (na + nb) // (100 + percent))


def _words(bits) -> np.ndarray:
    """Rows of 64-bit words of bitmaps of one size."""
    return np.frombuffer(b"".join(bits), dtype=np.uint64).reshape(len(bits), -1)


def _bound(or_a, or_b, sur_a, sur_b, max_a, max_b):
    """Greatest possible overlap: a common bit for each token but for those that share a bit in their own set."""
    shared = np.bitwise_count(or_a & or_b).sum(axis=-1).astype(np.int64)
    return np.minimum(np.minimum(max_a, max_b), shared + np.minimum(sur_a, sur_b))


class SignatureTree:
    """Levels of nodes over members sorted by size, _FAN children to a node; level 0 are the members."""

    def __init__(self, bits: np.ndarray, n: np.ndarray):
        own = np.bitwise_count(bits).sum(axis=1).astype(np.int64)
        self.levels = [(bits, n - own, n, n)]
        while len(self.levels[-1][0]) > 1:
            b, sur, low, high = self.levels[-1]
            at = np.arange(0, len(b), _FAN)
            self.levels.append((np.bitwise_or.reduceat(b, at), np.maximum.reduceat(sur, at), np.minimum.reduceat(low, at), np.maximum.reduceat(high, at)))

    def pairs(self, other: "SignatureTree", percent: int, same: bool, done=None):
        """(i, j) of members that may link; with same, those with i < j of one tree. Works level by level in pieces of bounded size, near members first.

        Node pairs of which done(members of i, members of j) says so are left out.
        """
        top = min(len(self.levels), len(other.levels)) - 1
        na, nb = len(self.levels[top][0]), len(other.levels[top][0])
        first = np.stack(np.meshgrid(np.arange(na), np.arange(nb), indexing="ij"), axis=-1).reshape(-1, 2)
        work = [(top, first[first[:, 0] <= first[:, 1]] if same else first)]
        while work:
            level, at = work.pop()
            if same and level and len(at) > 1 and (own := at[:, 0] == at[:, 1]).any() and not own.all():
                work += [(level, at[~own]), (level, at[own])]
                continue
            piece = max(64, (1 << 23) // (8 * self.levels[0][0].shape[1]) // (_FAN * _FAN if level else 1))  # a pair of nodes becomes _FAN * _FAN
            if len(at) > piece:
                work += [(level, at[i : i + piece]) for i in range(0, len(at), piece)]
                continue
            i, j = at[:, 0], at[:, 1]
            if done is not None:
                left = ~done(level, i, j)
                i, j = i[left], j[left]
            ba, sa, la, ha = self.levels[level]
            bb, sb, lb, hb = other.levels[level]
            fits = (100 * ha[i] >= percent * lb[j]) & (100 * hb[j] >= percent * la[i])
            i, j = i[fits], j[fits]
            fits = _bound(ba[i], bb[j], sa[i], sb[j], ha[i], hb[j]) >= _need(la[i], lb[j], percent)
            i, j = i[fits], j[fits]
            if level == 0:
                yield (i[i < j], j[i < j]) if same else (i, j)
                continue
            step = np.arange(_FAN)
            ci = (i[:, None] * _FAN + step)[:, :, None] + 0 * step
            cj = (j[:, None] * _FAN + step)[:, None, :] + 0 * step[:, None]
            down = np.stack([ci.reshape(-1), cj.reshape(-1)], axis=1)
            down = down[(down[:, 0] < len(self.levels[level - 1][0])) & (down[:, 1] < len(other.levels[level - 1][0]))]
            if same:
                down = down[down[:, 0] <= down[:, 1]]
            if len(down):
                work.append((level - 1, down))


def _groups(frames, keys, run):
    """run(rows of one key) over frames sorted by keys."""
    held = None
    for f in frames:
        f = f if held is None else pd.concat([held, f], ignore_index=True)
        if not len(f):
            continue
        new = np.zeros(len(f), dtype=bool)
        for k in keys:
            new[1:] |= f[k].to_numpy()[1:] != f[k].to_numpy()[:-1]
        cuts = np.r_[0, np.flatnonzero(new)].tolist()
        for a, b in zip(cuts, cuts[1:]):
            yield from run(f.iloc[a:b])
        held = f.iloc[cuts[-1] :]
    if held is not None and len(held):
        yield from run(held)


def _mark_small(starts, size, bits, n, own, percent, marked):
    """Marks, in all blocks of a few members at once, those that may link with another."""
    at = starts[:, None] + np.arange(size)
    for p in range(size):
        for q in range(p + 1, size):
            i, j = at[:, p], at[:, q]
            yes = _bound(bits[i], bits[j], n[i] - own[i], n[j] - own[j], n[i], n[j]) >= _need(n[i], n[j], percent)
            marked[i[yes]] = marked[j[yes]] = True


def _mark_tree(rows, other, bits, n, percent, marked):
    """The same for one block, or two parts of it, by signature trees. rows and other are places, sorted by size."""
    trees = [SignatureTree(bits[r], n[r]) for r in ([rows] if other is None else [rows, other])]
    marks = [np.zeros(len(r), dtype=bool) for r in ([rows] if other is None else [rows, other])]

    def done(level, i, j):
        """Nodes all of whose members are marked."""
        full = []
        for m in marks:
            for _ in range(level):
                m = np.logical_and.reduceat(m, np.arange(0, len(m), _FAN))
            full.append(m)
        return full[0][i] & full[-1][j]

    for i, j in trees[0].pairs(trees[-1], percent, other is None, done):
        marks[0][i] = True
        marks[-1][j] = True
    for r, m in zip([rows] if other is None else [rows, other], marks):
        marked[r] |= m


def _may_link(percent):
    """(token, rid) of members that may link with another of their block, from frames sorted by block."""

    def whole_blocks(f: pd.DataFrame, cuts: np.ndarray):
        bits, n = _words(f["bits"]), f["n"].to_numpy(np.int64)
        own = np.bitwise_count(bits).sum(axis=1).astype(np.int64)
        i, j, part = (f[k].to_numpy() for k in ("i", "j", "part"))
        marked = np.zeros(len(f), dtype=bool)
        starts, sizes = cuts[:-1], np.diff(cuts)
        alone = i[starts] == j[starts]
        for size in np.unique(sizes[alone & (sizes <= _FAN)]):
            _mark_small(starts[alone & (sizes == size)], int(size), bits, n, own, percent, marked)
        for a, size, one in zip(starts, sizes, alone):
            if one and size <= _FAN:
                continue
            rows = a + np.argsort(n[a : a + size], kind="stable")
            if one:
                _mark_tree(rows, None, bits, n, percent, marked)
            else:
                left, right = rows[part[rows] == i[a]], rows[part[rows] == j[a]]
                if len(left) and len(right):
                    _mark_tree(left, right, bits, n, percent, marked)
        return f.loc[marked, ["token", "rid"]]

    def borders(f: pd.DataFrame) -> np.ndarray:
        new = np.zeros(len(f), dtype=bool)
        for k in ("class", "token", "i", "j"):
            new[1:] |= f[k].to_numpy()[1:] != f[k].to_numpy()[:-1]
        return np.r_[0, np.flatnonzero(new), len(f)]

    def by_class(f: pd.DataFrame):
        for _, some in f.groupby("class", sort=False):
            some = some.reset_index(drop=True)
            yield whole_blocks(some, borders(some))

    def run(frames):
        held = None
        for f in frames:
            f = f if held is None else pd.concat([held, f], ignore_index=True)
            if len(f):
                last = borders(f)[-2]  # the last block may go on
                yield from by_class(f.iloc[:last])
                held = f.iloc[last:]
        if held is not None and len(held):
            yield from by_class(held)

    return run


def _links_of(rid, n, sets, percent, root, split=None):
    """Links that join the components root of sets. They come from the pairs of a dual traversal, compared as sets; with split, from pairs of the first split ones and the others."""
    width = min(5, max(_size_class(int(x)) for x in n))
    bits = _words([_bitmap(s, width) for s in sets])
    sides = [np.argsort(n, kind="stable")] if split is None else [a + np.argsort(n[a:b], kind="stable") for a, b in ((0, split), (split, len(n)))]
    trees = [SignatureTree(bits[r], n[r]) for r in sides]

    def done(level, i, j):
        """Node pairs that are one component altogether."""
        same = []
        for r in sides:
            low = high = root[r]
            for _ in range(level):
                at = np.arange(0, len(low), _FAN)
                low, high = np.minimum.reduceat(low, at), np.maximum.reduceat(high, at)
            same.append((low, high))
        (la, ha), (lb, hb) = ([x[i] for x in same[0]], [x[j] for x in same[-1]])
        return (la == ha) & (lb == hb) & (la == lb)

    found = []
    for i, j in trees[0].pairs(trees[-1], percent, split is None, done):
        a, b = sides[0][i], sides[-1][j]
        apart = root[a] != root[b]
        for x, y in zip(a[apart].tolist(), b[apart].tolist()):
            if root[x] != root[y] and len(np.intersect1d(sets[x], sets[y], assume_unique=True)) >= _need(n[x], n[y], percent):
                found.append((rid[x], rid[y]))
                root[root == root[y]] = root[x]
    return found


def _group_links(percent):
    """Links that make up the components of each part of a group of whole sets, or those across two parts."""

    def of_group(f: pd.DataFrame):
        f = f.drop_duplicates("rid")
        split = None
        if f["i"].iloc[0] != f["j"].iloc[0]:
            f = f.iloc[np.argsort(f["part"].to_numpy() != f["i"].iloc[0], kind="stable")]
            split = int((f["part"] == f["i"]).sum())
            if split in (0, len(f)):
                return
        root = f["label"].to_numpy(np.int64).copy()
        sets = [np.frombuffer(w, dtype=np.uint64) for w in f["whole"]]
        if found := _links_of(f["rid"].to_numpy(np.int64), f["n"].to_numpy(np.int64), sets, percent, root, split):
            yield pd.DataFrame(found, columns=["a", "b"])

    return lambda frames: _groups(frames, ["root", "i", "j"], of_group)


def _parted(df: DataFrame, size: str, max_block: int) -> DataFrame:
    """df with part, and i <= j: a row for each pair of parts that it belongs to."""
    df = df.withColumn("_parts", F.ceil(F.col(size) / F.lit(max_block)).cast("int"))
    df = df.withColumn("part", F.pmod(F.xxhash64("rid"), F.col("_parts")).cast("int")).withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
    return df.withColumns({"i": F.least("part", "_other"), "j": F.greatest("part", "_other")}).drop("_parts", "_other")


def _with_sets(docs: DataFrame, members: DataFrame, size: int, broadcast_rows: int) -> DataFrame:
    """members(doc_id, h1, h2, n, ...) with whole, the tokens, from the texts again. A text that stands in several rows gives several."""
    rows = members.count()
    wanted = broadcast_within(members.select(F.col("doc_id").alias("_want")).distinct(), rows, broadcast_rows)
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    some = own.join(wanted, F.col("doc_id").eqNullSafe(F.col("_want")), "left_semi")

    def build(batches):
        for batch in sliced(batches):
            rows = [(*_set_key(s), len(s), s.tobytes()) for _, s in _sets(batch.column(0).to_pylist(), size)]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.int32(), pa.binary()))], names=["h1", "h2", "n", "whole"])

    found = some.select("text").mapInArrow(lean(build), "h1 long, h2 long, n int, whole binary")
    return found.join(broadcast_within(members.drop("doc_id"), rows, broadcast_rows), ["h1", "h2", "n"])


def _group_components(docs: DataFrame, group: DataFrame, stage: Staging, size: int, percent: int, max_group: int, broadcast_rows: int) -> DataFrame:
    """(node, root) from group(rid, root, doc_id, h1, h2, n): the links within groups, as components."""
    group = group.join(group.groupBy("root").agg(F.count("*").alias("_size")), "root").withColumn("label", F.col("rid"))
    group = stage(group, "group-members")
    columns = ["root", "i", "j", "part", "rid", "n", "label", "whole"]

    def links(rows: DataFrame, name: str) -> DataFrame:
        rows = rows.select(*columns).repartition("root", "i", "j").sortWithinPartitions("root", "i", "j")
        return stage(rows.mapInPandas(lean(_group_links(percent)), "a long, b long"), name)  # one Python step a stage, as each holds a worker

    parts = F.ceil(F.col("_size") / F.lit(max_group)).cast("int")
    part = F.pmod(F.xxhash64("rid"), parts).cast("int")
    # about eight members of a group that are in each of its parts
    tie = (parts > 1) & (F.pmod(F.xxhash64(F.lit("tie"), F.col("rid")), F.col("_size")) < 8)
    own = group.withColumn("i", F.explode(F.when(tie, F.sequence(F.lit(0), parts - 1)).otherwise(F.array(part)))).withColumns({"j": F.col("i"), "part": F.col("i")})
    found = links(_with_sets(docs, own, size, broadcast_rows), "links")
    done = components(found, stage)
    large = group.where(F.col("_size") > max_group)
    if large.isEmpty():
        return done
    named = large.join(done.select(F.col("node").alias("rid"), F.col("root").alias("_of")), "rid", "left").withColumn("label", F.coalesce("_of", "rid")).drop("_of")
    apart = named.groupBy("root").agg(F.min("label").alias("_low"), F.max("label").alias("_high")).where("_low < _high").select("root")
    rest = stage(_parted(named.join(apart, "root", "left_semi"), "_size", max_group).where("i < j"), "groups-apart")
    if rest.isEmpty():
        return done
    return components(found.union(links(_with_sets(docs, rest, size, broadcast_rows), "links-across")), stage)


def jaccard_components(docs: DataFrame, size: int = 4, percent: int = 85, max_block: int = 20_000, broadcast_rows: int = 1_000_000, max_group: int = 2_500, carry: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, n_shingles, component_id, carried columns) for each row of docs(doc_id, text)."""
    with Staging(docs.sparkSession) as stage:
        sketch = token_sketch(docs, size, sketch_bits(docs.count()))
        signs = stage(signatures(docs, sketch, size, percent, carry), "signatures")
        keys = ["h1", "h2", "n"]
        sets = signs.where("n > 0").groupBy(*keys).agg(F.min("node").alias("rid"), F.min("doc_id").alias("low_id"), F.collect_set("node").alias("nodes"))
        sets = stage(sets, "sets")
        # the rows by which other tasks gave a set again
        again = sets.where("size(nodes) > 1").select(F.explode(F.array_except("nodes", F.array("rid"))).alias("rid"))
        again = broadcast_within(again, again.count(), broadcast_rows)

        # Blocks: tokens that several members have in their prefix; of blocks with the same members, one.
        # At the first token that two sets share, at place p of the smaller set x, they can have n - p more: so p is at
        # most n(x) less what sets of its size need. A row stays if it may be such an x below the next larger set,
        # or lies over the nearest such x.
        w, up = W.partitionBy("token"), W.partitionBy("token").orderBy("at", "rid")
        met = signs.where("tokens is not null").select("rid", "n", "tokens").join(again, "rid", "left_anti").select("rid", "n", F.posexplode("tokens").alias("_p", "token"))
        met = met.select("token", F.shiftleft(F.col("n").cast("long"), 32).bitwiseOR(F.col("_p").cast("long")).alias("at"), "rid").repartition("token")
        n = F.shiftright("at", 32)
        least = F.ceil((2 * percent * n) / F.lit(100 + percent))
        met = met.withColumns({"n": n, "_x": F.when(F.col("at").bitwiseAND(F.lit((1 << 32) - 1)) <= n - least, n)})
        met = met.withColumns({"_over": F.last("_x", ignorenulls=True).over(up.rowsBetween(W.unboundedPreceding, -1)), "_next": F.lead("n").over(up)})
        pairs = F.coalesce(100 * F.col("_over") >= percent * F.col("n"), F.lit(False)) | F.coalesce(F.col("_x").isNotNull() & (100 * F.col("n") >= percent * F.col("_next")), F.lit(False))
        met = met.where(pairs).select("rid", F.col("n").cast("int").alias("n"), "token").withColumns({"_cnt": F.count("*").over(w), "_mix": F.bit_xor(F.xxhash64("rid")).over(w), "_low": F.min("rid").over(w)}).where("_cnt > 1")
        met = stage(met, "met")
        chosen = met.groupBy("_cnt", "_mix", "_low").agg(F.min("token").alias("token")).select("token")
        blocks = stage(met.join(chosen, "token", "left_semi").drop("_mix", "_low"), "blocks")
        stage.drop(met)

        # Members that may link, by the blocks' trees; those that share a block with such are a group.
        used = blocks.select("rid").distinct()
        used = broadcast_within(used, used.count(), broadcast_rows)
        own, low = signs.where("bits is not null").select("rid", "class", "bits"), signs.where("low is not null").select("rid", (F.col("class") - 1).alias("class"), F.col("low").alias("bits"))
        rows = _parted(blocks.join(own.union(low).join(used, "rid", "left_semi"), "rid"), "_cnt", max_block).select("class", "token", "i", "j", "part", "rid", "n", "bits")
        maybe = rows.repartition("class", "token", "i", "j").sortWithinPartitions("class", "token", "i", "j").mapInPandas(lean(_may_link(percent)), "token long, rid long")
        maybe = stage(maybe.distinct(), "may-link")
        signs = _replaced(stage, signs, "doc_id", "rid", *keys, *carry)
        centers = maybe.groupBy("token").agg(F.min("rid").alias("b"))
        group = components(maybe.join(centers, "token").select(F.col("rid").alias("a"), "b"), stage).withColumnRenamed("node", "rid")
        group = signs.select("rid", "doc_id", *keys).join(group, "rid")
        whole = _group_components(docs, group, stage, size, percent, max_group, broadcast_rows)

        named = sets.join(whole.withColumnRenamed("node", "rid"), "rid", "left").withColumn("root", F.coalesce("root", "rid"))
        lows = named.groupBy("root").agg(F.min("low_id").alias("component_id"))
        named = named.join(lows, "root").select(*keys, "component_id")
        out = signs.join(named, keys, "left")
        return staged(out.select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"), *carry), "jaccard-components")


def _replaced(stage: Staging, table: DataFrame, *columns: str) -> DataFrame:
    """table's columns, staged in its place."""
    out = stage(table.select(*columns), "narrow")
    stage.drop(table)
    return out
