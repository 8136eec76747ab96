"""A trie of the turn prefixes of conversations that begin with another one's turns.

A rebuilt conversation is some first turns of its base and its own turns after as many. Its prefixes are
known by fingerprints that are composed and never need its text: a run of turns is an element (B**length,
sum of x[i] * B**i) of a monoid, modulo four primes, where x[i] comes from a hash of the turn. Products of
whole source conversations are summed up along their turns once, in partitions that are joined by the
products of whole parts; head * suffix is then worked out from two of these products, where a suffix is
the quotient of two prefixes.

Equality is not left to the hashes. A node refers to source turns; source turns of one hash are compared
as texts where they are stored, and each group of prefixes must agree in its parent's fingerprint and in
its last turn's hash, which by induction over the depth makes its prefixes equal. If one does not, all is
done again with other constants.

Sums over subtrees double their reach in each round: after round k a node has what lies less than 2**k
below, so a conversation of a million turns takes 20 rounds.

Defined cases: turns are ordered by turn (null first), role and text; null role or text is empty; repeated
turns count each; turns without conv_id belong to no conversation and are left out; a conversation of any
number of turns lies over many partitions; an empty table gives no node; other columns are not read.
"""

from __future__ import annotations

import hashlib
import random
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import Staging
from .ordering import part_starts, sorted_parts

#: The greatest primes below 2**31: products of two remainders fit a long.
PRIMES = (2147483647, 2147483629, 2147483587, 2147483579)
_SUMS = [f"s{m}" for m in range(len(PRIMES))]
_NODE = ["depth", "a", "b"]
_EMPTY_SHA = hashlib.sha256(b"").hexdigest()


class Constants:
    """The bases of one attempt and columns made with them."""

    def __init__(self, attempt: int, max_head: int):
        rng = random.Random(attempt)
        self.bases = [rng.randrange(1 << 20, p) for p in PRIMES]
        self.seeds = [rng.randrange(1 << 30) for _ in PRIMES]
        self.back = [F.array(*[F.lit(pow(b, -k, p)).cast("long") for k in range(max_head + 1)]) for b, p in zip(self.bases, PRIMES)]

    def x(self, m: int) -> Column:
        return F.pmod(F.xxhash64(F.lit(self.seeds[m]), F.col("h1"), F.col("h2")), F.lit(PRIMES[m]))

    def power(self, m: int, n: str) -> Column:
        """base m to the column n (below 2**35), modulo its prime: a factor looked up for each of seven digits of five bits."""
        p = PRIMES[m]
        digit = lambda j: "array(" + ", ".join(f"{pow(self.bases[m], d << (5 * j), p)}L" for d in range(32)) + f")[cast(shiftright(cast({n} as bigint), {5 * j}) & 31 as int)]"
        return F.expr(reduce(lambda acc, j: f"{acc} * {digit(j)} % {p}L", range(1, 7), digit(0)))

    def term(self, m: int, place: str) -> Column:
        return self.x(m) * self.power(m, place) % F.lit(PRIMES[m])


def _key(values: list[Column]) -> tuple[Column, Column]:
    return F.shiftleft(values[0], 31) + values[1], F.shiftleft(values[2], 31) + values[3]


def source_turns(conversations: DataFrame, attempt: int = 0) -> DataFrame:
    """(conv_id, turn, role, text, h1, h2): turns with two hashes of role and text."""
    turns = conversations.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return turns.withColumns({f"h{i}": F.xxhash64(F.lit(2 * attempt + i), F.length("role"), "role", "text") for i in (1, 2)})


def hashes_are_equal_texts(turns: DataFrame) -> bool:
    same = turns.groupBy("h1", "h2").agg(F.min("role").alias("r"), F.max("role").alias("r2"), F.min("text").alias("t"), F.max("text").alias("t2"))
    return same.where("r <> r2 or t <> t2").isEmpty()


def source_products(turns: DataFrame, c: Constants, stage) -> tuple[DataFrame, DataFrame]:
    """(conv_id, i from 1, sums of the prefix up to i, h1, h2, n_chars) and (conv_id, n)."""
    placed = sorted_parts(turns, ["conv_id"], ["turn", "role", "text"], stage, keep=["conv_id", "h1", "h2", F.length("text").cast("long").alias("n_chars")])
    here = W.partitionBy("_part", "conv_id").orderBy("_pos")
    local = placed.withColumn("i", F.row_number().over(here).cast("long"))
    so_far = here.rowsBetween(W.unboundedPreceding, W.currentRow)
    local = stage(local.withColumns({s: F.sum(c.term(m, "i")).over(so_far) % F.lit(PRIMES[m]) for m, s in enumerate(_SUMS)}), "local-products")
    starts = part_starts(local, ["conv_id"], {s: F.max_by(s, "_pos") for s in _SUMS})
    earlier = W.partitionBy("conv_id").orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    joined = {f"_{s}": F.sum(F.col(s) * c.power(m, "_before") % F.lit(PRIMES[m])).over(earlier) % F.lit(PRIMES[m]) for m, s in enumerate(_SUMS)}
    # a part goes on with at most one conversation of earlier parts: as many rows as partitions
    carried = starts.withColumns(joined).where("_before > 0").select("_part", "conv_id", "_before", *joined)
    both = local.join(F.broadcast(carried), ["_part", "conv_id"], "left")
    before = F.coalesce("_before", F.lit(0))
    sums = [F.when(F.col("_before").isNull(), F.col(s)).otherwise((F.col(f"_{s}") + F.col(s) * c.power(m, "coalesce(_before, 0L)")) % F.lit(PRIMES[m])).alias(s) for m, s in enumerate(_SUMS)]
    return both.select("conv_id", (F.col("i") + before).alias("i"), *sums, "h1", "h2", "n_chars"), starts.groupBy("conv_id").agg(F.sum("_n").alias("n"))


def rebuilt_prefixes(prefixes: DataFrame, sizes: DataFrame, base: Column, head: Column, max_head: int, c: Constants) -> tuple[DataFrame, DataFrame]:
    """(conv_id, depth, last, sums, h1, h2, n_chars) of each prefix of a turn and more, and (conv_id, last depth) of each rebuilt conversation."""
    short = prefixes.where(F.col("i") <= max_head).groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("i", *_SUMS, "h1", "h2", "n_chars"))).alias("first"))
    convs = sizes.join(short, "conv_id", "left").withColumns({"_base": base.cast("long"), "h": head.cast("int")})
    bases = convs.select(F.col("conv_id").alias("_base"), F.col("n").alias("_n"), F.col("first").alias("_first"))
    plan = convs.join(bases, "_base", "left")
    plan = plan.withColumn("hl", F.least("h", F.coalesce("_n", F.lit(0))).cast("int")).withColumn("last", F.col("hl") + F.greatest(F.col("n") - F.col("h"), F.lit(0)))
    at = lambda array, k, s: F.coalesce(F.try_element_at(array, F.when(k > 0, k).otherwise(F.lit(max_head + 1)))[s], F.lit(0))
    plan = plan.withColumns({f"mul{m}": F.element_at(c.back[m], F.col("h") - F.col("hl") + 1) for m in range(len(PRIMES))})
    lead = {f"add{m}": F.pmod(at(F.col("_first"), F.col("hl"), s) - F.col(f"mul{m}") * at(F.col("first"), F.col("h"), s) % F.lit(p), F.lit(p)) for m, (s, p) in enumerate(zip(_SUMS, PRIMES))}
    plan = plan.withColumns(lead)
    heads = plan.where("hl > 0").select("conv_id", "last", F.explode(F.slice("_first", 1, F.col("hl"))).alias("t"))
    heads = heads.select("conv_id", F.col("t.i").alias("depth"), "last", *[F.col(f"t.{x}") for x in (*_SUMS, "h1", "h2", "n_chars")])
    own = prefixes.join(plan.where("n > h").select("conv_id", "h", "hl", "last", *[f"mul{m}" for m in range(len(PRIMES))], *lead), "conv_id").where("i > h")
    sums = [F.pmod(F.col(f"add{m}") + F.col(f"mul{m}") * F.col(s) % F.lit(p), F.lit(p)).alias(s) for m, (s, p) in enumerate(zip(_SUMS, PRIMES))]
    own = own.select("conv_id", (F.col("hl") + F.col("i") - F.col("h")).alias("depth"), "last", *sums, "h1", "h2", "n_chars")
    return heads.unionByName(own), plan.select("conv_id", "last")


def _hash_streams(batches):
    """SHA-256 over the chunks of one node after the other; nothing but the running digest is held."""
    key, sha, out, first = None, None, [], True

    def table():
        cols = list(zip(*out)) if out else [[]] * 4
        return pa.RecordBatch.from_arrays([pa.array(list(v), t) for v, t in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.string()))], names=[*_NODE, "ends_sha256"])

    for batch in batches:
        for row in zip(*[batch.column(i).to_pylist() for i in range(4)]):
            if row[:3] != key:
                if sha:
                    out.append((*key, sha.hexdigest()))
                key, sha, first = row[:3], hashlib.sha256(), True
            sha.update(("" if first else ",").encode() + row[3].encode())
            first = False
        if len(out) > 10_000:
            yield table()
            out.clear()
    if sha:
        out.append((*key, sha.hexdigest()))
    if out:
        yield table()


def hashed_ends(ends: DataFrame, stage) -> DataFrame:
    """(node, ends_sha256) of ends(node, conv_id): ids ascending, comma-joined.

    Ids are sorted and joined to chunks by range partitions, so a node where most conversations end is
    joined by many tasks; the digest itself can only be taken in order, over a chunk for each of them.
    """
    placed = sorted_parts(ends.select(*_NODE, "conv_id"), _NODE, ["conv_id"], stage)
    ids = F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda v: v.cast("string")), ",")
    chunks = placed.groupBy("_part", *_NODE).agg(ids.alias("ids"))
    return chunks.repartition(*_NODE).sortWithinPartitions(*_NODE, "_part").select(*_NODE, "ids").mapInArrow(_hash_streams, "depth long, a long, b long, ends_sha256 string")


def subtree_sums(nodes: DataFrame, columns: list[str], stage) -> DataFrame:
    """nodes(depth, a, b, pa, pb, columns) with columns summed over each node's subtree."""
    most = nodes.agg(F.max("depth")).first()[0] or 0
    state, reach = nodes.select(*_NODE, F.col("pa").alias("ua"), F.col("pb").alias("ub"), *columns), 1
    while reach <= most:
        up = [(F.col("depth") - reach).alias("depth"), F.col("ua").alias("a"), F.col("ub").alias("b")]
        below = state.where(F.col("depth") >= reach).groupBy(*up).agg(*[F.sum(x).alias(f"_{x}") for x in columns])
        above = state.select((F.col("depth") + reach).alias("depth"), F.col("a").alias("ua"), F.col("b").alias("ub"), F.col("ua").alias("_ua"), F.col("ub").alias("_ub")).where(F.col("depth") >= 2 * reach)
        summed = state.join(below, _NODE, "left").select(*_NODE, "ua", "ub", *[(F.col(x) + F.coalesce(f"_{x}", F.lit(0))).alias(x) for x in columns])
        if 2 * reach <= most:
            summed = summed.join(above, ["depth", "ua", "ub"], "left").select(*_NODE, F.col("_ua").alias("ua"), F.col("_ub").alias("ub"), *columns)
        older, state, reach = state, stage(summed, f"subtree-{reach}"), 2 * reach
        stage.drop(older)
    return state.select(*_NODE, *columns)


def prefix_trie(conversations: DataFrame, base: Column, head: Column, max_head: int, attempts: int = 5) -> DataFrame:
    """A row for each distinct turn prefix of the rebuilt conversations of conversations(conv_id, turn, role, text).

    base and head are columns of conv_id: whose first turns a conversation begins with, and how many (0 to
    max_head) they are. Columns: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256.
    """
    for attempt in range(attempts):
        turns, passing = source_turns(conversations, attempt), Staging(conversations.sparkSession)
        if not hashes_are_equal_texts(turns):
            continue
        c = Constants(attempt, max_head)
        prefixes, sizes = source_products(turns, c, passing)
        prefixes = passing(prefixes, "prefixes")
        members, lasts = rebuilt_prefixes(prefixes, passing(sizes, "sizes"), base, head, max_head, c)
        a, b = _key([F.col(s) for s in _SUMS])
        pa_, pb = _key([F.pmod(F.col(s) - c.term(m, "depth"), F.lit(PRIMES[m])) for m, s in enumerate(_SUMS)])
        members = members.select("conv_id", "depth", "last", a.alias("a"), b.alias("b"), pa_.alias("pa"), pb.alias("pb"), "h1", "h2", "n_chars")
        zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
        root = lasts.select("conv_id", zero.alias("depth"), "last", zero.alias("a"), zero.alias("b"), none.alias("pa"), none.alias("pb"), none.alias("h1"), none.alias("h2"), zero.alias("n_chars"))
        members = passing(members.unionByName(root), "members")
        alike = ["pa", "pb", "h1", "h2"]
        nodes = members.groupBy(*_NODE).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("n_chars").alias("n_chars"), *[F.min(x).alias(x) for x in alike], *[F.max(x).alias(f"_{x}") for x in alike])
        nodes = passing(nodes, "nodes")
        if nodes.where(" or ".join(f"{x} <> _{x}" for x in alike)).isEmpty():
            break
        passing.close()
    else:
        raise RuntimeError(f"hashes of different turns or prefixes met in {attempts} attempts")
    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("pa").alias("a"), F.col("pb").alias("b")).agg(F.count("*").alias("n_children"))
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("conv_id").alias("parent_conv_id"))
    nodes = nodes.join(children, _NODE, "left").join(parents, ["depth", "pa", "pb"], "left").select(*_NODE, "pa", "pb", "conv_id", "parent_conv_id", "n_convs", F.coalesce("n_children", zero).alias("n_children"), ((F.col("n_convs") - 1) * F.col("n_chars")).alias("saved_tokens"))
    nodes = passing(nodes.withColumn("n_leaves", (F.col("n_children") == 0).cast("long")), "linked-nodes")
    sums = subtree_sums(nodes, ["n_leaves", "saved_tokens"], passing)
    ends = hashed_ends(members.where("depth = last"), passing)
    out = nodes.drop("n_leaves", "saved_tokens").join(sums, _NODE).join(ends, _NODE, "left")
    out = out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(_EMPTY_SHA)).alias("ends_sha256"))
    out = Staging(conversations.sparkSession)(out, "prefix-trie")
    passing.close()
    return out
