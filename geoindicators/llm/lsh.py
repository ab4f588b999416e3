"""Near-duplicate classes from band keys: bucket candidates, exact verification, components.

Nodes are classes of equal texts (their digest), so copies are never expanded into pairs.  Every node has band keys; a
bucket is the nodes of one key.

* A bucket of up to ``SMALL`` nodes gives all its pairs.
* In a larger bucket every node is paired with one leader, the least node.  Nodes that are similar to it are done:
  they are in one component, whatever links they have among themselves.
* The others are open.  They are compared with all nodes of the bucket, block against block: a task gets a block of
  open nodes and a block of all nodes, builds an inverted index over the latter and emits a spanning forest of the
  links it finds.  So a bucket's components come out exact.
* A bucket of more than ``CROWD`` nodes with open ones is first dealt anew by further independent samples of its nodes
  ("fine" keys).  That only finds links early: nodes known to be in the bucket's largest component are done, and those
  still open are compared in blocks as in any other bucket.

No node is dropped and no bucket is capped.  What a bucket of n nodes costs grows with n as long as they are near copies; o open
nodes cost o x n / ``BLOCK`` profile rows, at any size.

Pairs are verified on the nodes' profiles, dealt by (leader, salt), a salt holding some hundred pairs, and streamed: a
task holds one leader's profile at a time, so a leader with very many members is many tasks.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoindicators.llm.common import parts, table
from geoindicators.llm.graph import components

SMALL = 12
BLOCK = 512
CROWD = 8192
PAIRS_PER_SALT = 256
FINE_SETS = 2


def fine_sets(keys: np.ndarray) -> pa.Array:
    """The fine keys of each node (a row) as FINE_SETS lists."""
    n, width = len(keys), keys.shape[1] // FINE_SETS
    inner = pa.ListArray.from_arrays(pa.array(np.arange(n * FINE_SETS + 1) * width, pa.int32()), pa.array(keys.ravel(), pa.int64()))
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * FINE_SETS, pa.int32()), inner)


def _in_buckets(members: DataFrame) -> DataFrame:
    """(key, cls, open, n, leader) of the nodes that share their key with another, one of them open; a leader isn't open if any node isn't."""
    sizes = members.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max("open").alias("some"), F.min(F.struct("open", "cls"))["cls"].alias("leader"))
    # written, so that the join below has an exchange on either side that AQE can split at a hot key
    sizes = table(sizes.where("n > 1 and some").drop("some"), "buckets")
    return members.join(sizes, "key").select("key", "cls", "open", "n", "leader")


def _all_pairs(members: DataFrame) -> DataFrame:
    """(a, b, salts), a < b, one of them open; for buckets of a bounded number of nodes."""
    own = members.groupBy("key").agg(F.sort_array(F.collect_set(F.struct("cls", "open"))).alias("s"))
    each = own.select(F.posexplode("s").alias("i", "y"), "s").where("i > 0").select(F.explode(F.slice("s", F.lit(1), F.col("i"))).alias("x"), "y")
    return each.where("x.open or y.open").select(F.col("x.cls").alias("a"), F.col("y.cls").alias("b"), F.lit(1).alias("salts"))


def _leader_pairs(members: DataFrame) -> DataFrame:
    return members.where("open and cls != leader").select(F.col("leader").alias("a"), F.col("cls").alias("b"), F.ceil(F.col("n") / PAIRS_PER_SALT).cast("int").alias("salts"))


class Profiles:
    """How a profile is read: ``unpack`` gives its distinct keys in order and their weights."""

    def __init__(self, unpack: Callable[[bytes], tuple[np.ndarray, np.ndarray]], threshold: float):
        self.unpack, self.threshold = unpack, threshold

    def similarity(self, p, q) -> float:
        """Weighted Jaccard of two unpacked profiles: the lesser weights over the greater ones."""
        (pk, pw), (qk, qw) = p, q
        at = np.minimum(np.searchsorted(qk, pk), max(0, len(qk) - 1))
        hit = qk[at] == pk if len(qk) else np.zeros(len(pk), bool)
        both = np.minimum(pw[hit], qw[at[hit]]).sum()
        return float(both / max(1e-9, pw.sum() + qw.sum() - both))


class _Block:
    """Unpacked profiles of a block of nodes as an inverted index."""

    def __init__(self, names: list, profiles: list):
        self.names = names
        owner = np.repeat(np.arange(len(profiles)), [len(k) for k, _ in profiles])
        keys = np.concatenate([k for k, _ in profiles])
        weight = np.concatenate([w for _, w in profiles])
        order = np.argsort(keys, kind="stable")
        self.keys, self.owner, self.weight = keys[order], owner[order], weight[order]
        self.total = np.bincount(owner, weight, len(profiles))

    def similar(self, keys: np.ndarray, weight: np.ndarray, threshold: float) -> list:
        """Names of the nodes whose weighted Jaccard similarity is the threshold or more."""
        low, high = np.searchsorted(self.keys, keys, "left"), np.searchsorted(self.keys, keys, "right")
        n = high - low
        at = np.repeat(low, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        both = np.bincount(self.owner[at], np.minimum(np.repeat(weight, n), self.weight[at]), len(self.names))
        return [self.names[i] for i in np.flatnonzero(both >= threshold * (self.total + weight.sum() - both) - 1e-9)]


def _kind(name: str) -> pa.DataType:
    return {"bigint": pa.int64(), "string": pa.string()}[name]


def verify(pairs: DataFrame, profiles: DataFrame, how: Profiles) -> DataFrame:
    """The pairs (a, b) whose profiles are similar; pairs: (a, b, salts), profiles: (cls, profile)."""
    salt = F.pmod(F.xxhash64("b"), F.max("salts")).cast("int")
    salted = table(pairs.groupBy("a", "b").agg(salt.alias("salt")), "pairs")
    members = salted.join(profiles.withColumnRenamed("cls", "b"), "b").select("a", "salt", F.lit(1).alias("tag"), "b", "profile")
    leaders = salted.select("a", "salt").distinct().join(profiles.withColumnRenamed("cls", "a"), "a").select(
        "a", "salt", F.lit(0).alias("tag"), F.col("a").alias("b"), "profile")
    dealt = leaders.unionByName(members).repartition(parts(pairs.sparkSession), "a", "salt").sortWithinPartitions("a", "salt", "tag")
    name = pairs.schema["a"].dataType.simpleString()
    kind = _kind(name)

    def compare(batches):
        leader, own = None, None
        for b in batches:
            left, right = [], []
            for a, tag, other, profile in zip(b.column("a").to_pylist(), b.column("tag").to_pylist(), b.column("b").to_pylist(), b.column("profile"), strict=True):
                if tag == 0:
                    leader, own = a, how.unpack(profile.as_py())
                elif how.similarity(own, how.unpack(profile.as_py())) >= how.threshold:
                    left.append(leader)
                    right.append(other)
            yield pa.RecordBatch.from_arrays([pa.array(left, kind), pa.array(right, kind)], names=["a", "b"])

    return table(dealt.mapInArrow(compare, f"a {name}, b {name}"), "links")


def compare_blocks(rest: DataFrame, profiles: DataFrame, how: Profiles) -> DataFrame:
    """Links that span the components of each bucket's open nodes among all its nodes; rest: (key, cls, open).

    The nodes that aren't open are known to be in one component.
    """
    size = rest.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("nb"), F.ceil(F.count_if("open") / BLOCK).cast("int").alias("no")).where("no > 0")
    each = rest.join(table(size, "blocks"), "key")
    upto = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    every = each.select("key", upto("no").alias("i"), F.pmod(F.xxhash64("cls"), F.col("nb")).cast("int").alias("j"), F.lit(0).alias("tag"), "cls", "open")
    opens = each.where("open").select("key", F.pmod(F.xxhash64(F.lit(1), "cls"), F.col("no")).cast("int").alias("i"), upto("nb").alias("j"), F.lit(1).alias("tag"), "cls", "open")
    rows = every.unionByName(opens).join(profiles.select("cls", "profile"), "cls")
    dealt = rows.repartition(parts(rest.sparkSession), "key", "i", "j").sortWithinPartitions("key", "i", "j", "tag")
    name = rest.schema["cls"].dataType.simpleString()
    kind = _kind(name)

    def compare(batches):
        at, names, found, block, up = None, [], [], None, {}

        def root(x):
            while (y := up.get(x, x)) != x:
                up[x] = up.get(y, y)
                x = y
            return x

        for b in batches:
            left, right = [], []
            for key, i, j, tag, cls, is_open, profile in zip(*(b.column(c).to_pylist() for c in ("key", "i", "j", "tag", "cls", "open", "profile")), strict=True):
                if (key, i, j) != at:
                    at, names, found, block, up = (key, i, j), [], [], None, {}
                if tag == 0:
                    names.append(cls)
                    found.append(how.unpack(profile))
                    if not is_open:
                        up[cls] = up.setdefault(None, cls)  # the first of them stands for all
                    continue
                if names and block is None:
                    block, found = _Block(names, found), []
                if block:
                    for other in block.similar(*how.unpack(profile), how.threshold):
                        if (x := root(cls)) != (y := root(other)):
                            up[x] = y
                            left.append(cls)
                            right.append(other)
            yield pa.RecordBatch.from_arrays([pa.array(left, kind), pa.array(right, kind)], names=["a", "b"])

    return table(dealt.mapInArrow(compare, f"a {name}, b {name}"), "links")


def _found_early(crowds: DataFrame, profiles: DataFrame, how: Profiles) -> DataFrame:
    """Links between the nodes of crowded buckets that share a fine key; crowds: (key, cls, open)."""
    keys = profiles.select("cls", F.posexplode(F.flatten("fine")).alias("j", "f"))
    dealt = crowds.join(keys, "cls").groupBy(F.xxhash64("key", "j", "f").alias("key"), "cls").agg(F.max("open").alias("open"))
    found = table(_in_buckets(dealt), "members")
    return verify(_all_pairs(found.where(F.col("n") <= SMALL)).unionByName(_leader_pairs(found.where(F.col("n") > SMALL))), profiles, how)


def _still_open(crowds: DataFrame, links: DataFrame) -> DataFrame:
    """(key, cls, open) of crowded buckets: open are the nodes that no links join with the bucket's largest component."""
    comps = components(links).withColumnRenamed("node", "cls")
    known = table(crowds.select("key", "cls").join(comps, "cls", "left").select("key", "cls", F.coalesce("comp", "cls").alias("comp")), "known")
    sizes = known.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("m"))
    largest = table(sizes.groupBy("key").agg(F.max(F.struct("m", "comp"))["comp"].alias("largest")), "largest")
    return known.join(largest, "key").select("key", "cls", (F.col("comp") != F.col("largest")).alias("open"))


def near_links(bands: DataFrame, profile_of: Callable[[DataFrame], DataFrame], how: Profiles) -> DataFrame:
    """Verified links (a, b) between nodes; bands: (cls, keys), each node once.

    profile_of(nodes: DataFrame (cls)) -> (cls, profile binary, fine array<array<bigint>>: sets of fine keys).
    """
    found = table(_in_buckets(bands.select(F.explode("keys").alias("key"), "cls", F.lit(True).alias("open"))), "members")
    profiles = table(profile_of(found.select("cls").distinct()), "profiles")
    large = found.where(F.col("n") > SMALL)
    links = [verify(_all_pairs(found.where(F.col("n") <= SMALL)).unionByName(_leader_pairs(large)), profiles, how)]
    matched = links[0].select(F.col("a").alias("leader"), F.col("b").alias("cls"), F.lit(True).alias("hit")).distinct()
    rest = large.join(matched, ["leader", "cls"], "left").select("key", "cls", "n", (F.col("hit").isNull() & (F.col("cls") != F.col("leader"))).alias("open"))
    rest = table(rest, "rest")
    crowds = rest.where(F.col("n") > CROWD)
    if not crowds.where("open").isEmpty():
        links.append(_found_early(crowds, profiles, how))
        crowds = _still_open(crowds, links[0].unionByName(links[1]))
    rest = rest.where(F.col("n") <= CROWD).drop("n").unionByName(crowds.select("key", "cls", "open"))
    links.append(compare_blocks(rest, profiles, how))
    return reduce(DataFrame.unionByName, links)


def near_classes(bands: DataFrame, profile_of, how: Profiles) -> DataFrame:
    """(node, comp) of the nodes with a link."""
    return table(components(near_links(bands, profile_of, how)), "classes")
