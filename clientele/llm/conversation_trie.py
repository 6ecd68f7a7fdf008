"""The prefix trie of conversations, grouped by blocks of turns and refined where siblings diverge.

A conversation is cut into blocks of ``BLOCK`` turns. The name of a prefix of whole blocks is the digest
of the name before it and the turns of the block, so conversations are grouped by (name, block) with
one row per distinct block, however many share it. Where all that go on from a prefix go on by
the same block, the turns inside need no look: the block's row stands for a chain of nodes. Only where
several blocks follow the same prefix are they cut into their turns and grouped again.

Sums over subtrees need no walk over the trie. A node is owned by its smallest member. If a
conversation owns a node it owns all deeper ones on its path, so the nodes of a subtree are counted by
its members: each adds the nodes (bytes, leaves) that it owns, and the smallest member, which
owns its path beyond the subtree's top as well, only those inside. So every number of a node is a
sum over its members, taken by the same two groupings.

Long conversations are dealt out by stretches of ``STRETCH`` turns; names and byte counts of later stretches
begin at sums over the earlier ones. Joins on names that many rows share are salted. The digest of a
node's ends is taken in order over blocks of ids, each a bounded row.

Defined results: turns are ordered by turn, null first, then by the digest of role and text; equal rows
are turns of their own; null role and text are empty; rows without conv_id belong to no conversation and
are left out; an empty table has no nodes; other columns are not read. Keys of turns and names of
prefixes are 128 bits of SHA-256.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clientele.llm.staging import salted_join, saved

BLOCK, STRETCH, NAME = 4, 4096, 16
#: Turn numbers that differ in higher bits are counted apart, so that a long conversation is spread.
PART_BITS = 12
#: Ends of a node are listed in blocks of so many ids.
ID_BITS = 16
ROOT = bytes(NAME)
#: Conversations borrow turns from the one whose id is the next lower multiple, so many at most.
SHARE, MOST = 5, 9


def digest(*parts: bytes) -> bytes:
    return hashlib.sha256(b"".join(parts)).digest()[:NAME]


def _short(text: Column) -> Column:
    return F.unhex(F.substring(F.sha2(text, 256), 1, 2 * NAME))


# --- turns -----------------------------------------------------------------------------


def keyed_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, part, key, bytes): one row per turn, without its text."""
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    turn = F.col("turn").cast("bigint")
    return conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        turn.alias("turn"),
        # Turns of a part are numbered together; a conversation without turn numbers is one part.
        F.coalesce(F.shiftright(turn, PART_BITS), F.lit(-(1 << 62))).alias("part"),
        _short(F.concat_ws(":", F.octet_length(role).cast("string"), role, text)).alias("key"),
        F.octet_length(text).cast("bigint").alias("bytes"),
    )


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The conversations (conv_id, length) and their turns (conv_id, length, place, key, bytes), places from 1.

    Of conversation c the first h turns are those of c - c % SHARE, h being the crc32 of its number.
    """
    sizes = turns.groupBy("conv_id", "part").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    base = F.col("conv_id") - F.col("conv_id") % SHARE
    totals = saved(
        sizes.groupBy("conv_id").agg(F.sum("n").alias("total")).withColumns(
            {"base": base, "h": F.when(base != F.col("conv_id"), F.crc32(F.col("conv_id").cast("string")) % MOST).otherwise(0)}
        ),
        "totals",
    )
    lenders = totals.where("conv_id = base").select(F.col("conv_id").alias("lender"), F.col("total").alias("has"))
    people = totals.join(lenders, F.col("base") == F.col("lender"), "left").select(
        "conv_id", "base", "h",
        F.least("h", F.coalesce("has", F.lit(0))).alias("gain"),
        (F.least("h", F.coalesce("has", F.lit(0))) + F.greatest(F.col("total") - F.col("h"), F.lit(0))).alias("length"),
    )
    people = saved(people, "people")
    # At most 2 * SHARE - 2 conversations borrow from one.
    takers = people.where("conv_id != base AND gain > 0").groupBy(F.col("base").alias("of")).agg(
        F.collect_list(F.struct("conv_id", "length", "gain")).alias("takers")
    )
    plan = people.join(takers, F.col("conv_id") == F.col("of"), "left").drop("of", "base")
    parts = sizes.drop("n").join(plan, "conv_id")
    inside = Window.partitionBy("conv_id", "part").orderBy(F.col("turn").asc_nulls_first(), "key")
    placed = turns.withColumn("nth", F.row_number().over(inside)).join(parts, ["conv_id", "part"])
    p = (F.col("nth") + F.col("before")).cast("bigint")
    placed = placed.withColumn("p", p)
    own = F.struct("conv_id", "length", (F.col("p") - F.col("h") + F.col("gain")).alias("place"))
    none = F.array().cast("array<struct<conv_id:bigint,length:bigint,place:bigint>>")
    lent = F.transform(
        F.filter("takers", lambda t: t["gain"] >= F.col("p")),
        lambda t: F.struct(t["conv_id"].alias("conv_id"), t["length"].alias("length"), F.col("p").alias("place")),
    )
    goes = F.concat(F.when(F.col("p") > F.col("h"), F.array(own)).otherwise(none), F.coalesce(lent, none))
    rows = placed.select("key", "bytes", F.inline(goes))
    return people.select("conv_id", "length"), rows


# --- blocks ----------------------------------------------------------------------------


def stretches(turns: DataFrame, size: int) -> DataFrame:
    """(conv_id, length, turns, start, finish, pre): runs of ``size`` turns, names before and after them, bytes before."""
    runs = turns.groupBy("conv_id", "length", F.floor((F.col("place") - 1) / size).cast("bigint").alias("stretch")).agg(
        F.array_sort(F.collect_list(F.struct("place", "key", "bytes"))).alias("turns"), F.sum("bytes").alias("bytes")
    )
    runs = saved(runs, "stretches")
    # Only conversations that fill a stretch need the sums over earlier ones.
    spelled = F.sha2(F.concat_ws("", F.col("stretch").cast("string"), F.transform("turns", lambda t: F.hex(t["key"]))), 256)
    long = runs.where(F.col("length") >= size).select("conv_id", "stretch", "bytes", spelled.alias("hex"))
    order = Window.partitionBy("conv_id").orderBy("stretch")

    def name(at: Column, window) -> Column:
        lanes = [F.bit_xor(F.conv(F.substring("hex", k, 15), 16, 10).cast("bigint")).over(window) for k in (1, 16)]
        return _short(F.concat_ws(":", at.cast("string"), *[lane.cast("string") for lane in lanes]))

    before, until = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(Window.unboundedPreceding, 0)
    sums = long.select(
        F.col("conv_id").alias("of"),
        F.col("stretch").alias("at"),
        F.when(F.col("stretch") > 0, name(F.col("stretch"), before)).alias("begin"),
        name(F.col("stretch") + 1, until).alias("finish"),
        F.sum("bytes").over(before).alias("pre"),
    )
    joined = runs.join(sums, (F.col("conv_id") == F.col("of")) & (F.col("stretch") == F.col("at")), "left")
    return joined.select(
        "conv_id", "length", "turns", F.coalesce("begin", F.lit(ROOT)).alias("start"), "finish",
        F.coalesce("pre", F.lit(0)).alias("pre"),
    )


_BLOCKS = "conv_id bigint, depth bigint, parent binary, name binary, keys binary, sizes array<bigint>, pre bigint, last boolean"


def blocks(runs: DataFrame, size: int) -> DataFrame:
    """One row per block: the depth of its first turn, the names before and after it, its turns' keys and bytes."""
    names = ["conv_id", "depth", "parent", "name", "keys", "sizes", "pre", "last"]
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.int64(), pa.bool_()]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = {c: batch.column(c)[at].as_py() for c in batch.schema.names}
                turns, out, parent, pre = row["turns"], [], row["start"], row["pre"]
                for k in range(0, len(turns), BLOCK):
                    block = turns[k : k + BLOCK]
                    keys, sizes = b"".join(t["key"] for t in block), [t["bytes"] for t in block]
                    # A full stretch ends with the name by which the next one begins.
                    name = row["finish"] if k + BLOCK == size else digest(parent, keys)
                    last = block[-1]["place"] == row["length"]
                    out.append((row["conv_id"], block[0]["place"], parent, name, keys, sizes, pre, last))
                    parent, pre = name, pre + sum(sizes)
                columns = [pa.array(list(c), kind) for c, kind in zip(zip(*out), kinds)]
                yield pa.RecordBatch.from_arrays(columns, names)

    return runs.mapInArrow(cut, _BLOCKS)


def refined(edges: DataFrame, carried: list[str]) -> DataFrame:
    """One row per turn of every block, named by the turns up to it; ``carried`` columns repeat."""
    kept = [f for f in edges.schema.fields if f.name in carried]
    names = ["depth", "parent", "name", "sizes", "pre"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            which, depth, parents, nodes, sizes, pres = [], [], [], [], [], []
            columns = (batch.column(c).to_pylist() for c in ("depth", "parent", "name", "keys", "sizes", "pre"))
            for at, (first, parent, name, keys, lengths, pre) in enumerate(zip(*columns)):
                before = parent
                for j, size in enumerate(lengths):
                    node = name if j + 1 == len(lengths) else digest(parent, keys[: NAME * (j + 1)])
                    which.append(at)
                    depth.append(first + j)
                    parents.append(before)
                    nodes.append(node)
                    sizes.append([size])
                    pres.append(pre)
                    before, pre = node, pre + size
            made = [
                pa.array(depth, pa.int64()), pa.array(parents, pa.binary()), pa.array(nodes, pa.binary()),
                pa.array(sizes, pa.list_(pa.int64())), pa.array(pres, pa.int64()),
            ]
            rest = [batch.column(f.name).take(pa.array(which, pa.int64())) for f in kept]
            yield pa.RecordBatch.from_arrays(made + rest, names + [f.name for f in kept])

    made = "depth bigint, parent binary, name binary, sizes array<bigint>, pre bigint"
    return edges.mapInArrow(run, ", ".join([made, *[f"{f.name} {f.dataType.simpleString()}" for f in kept]]))


_NODE = ("name", "parent", "depth", "sizes", "pre")


def grouped(edges: DataFrame, sums: dict[str, Column], carried: list[str]) -> DataFrame:
    """Nodes of the trie: blocks without siblings as they are, the others cut into turns and grouped again."""
    straight = edges.where(~F.col("forked")).select(*_NODE, *carried)
    cut = refined(edges.where("forked"), carried).groupBy(*_NODE).agg(*[sums[c].alias(c) for c in carried])
    return straight.unionByName(cut)


# --- ends ------------------------------------------------------------------------------


def ends_digests(ends: DataFrame) -> DataFrame:
    """(name, ends_sha256) of (name, conv_id): the ids in order, joined by commas.

    The ids of a node are listed in blocks by their leading bits, and the digest runs over the blocks in order.
    """
    listed = F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",")
    parts = ends.groupBy("name", F.shiftright("conv_id", ID_BITS).alias("block")).agg(listed.alias("ids"))
    # One row stands for up to 2**16 ids, so also a node with most of the ends is few rows.
    ordered = parts.repartition("name").sortWithinPartitions("name", "block").select("name", "ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, state, done = None, None, []
        for batch in batches:
            for name, ids in zip(batch.column("name").to_pylist(), batch.column("ids").to_pylist()):
                if name == last:
                    state.update(b"," + ids.encode())
                else:
                    if last is not None:
                        done.append((last, state.hexdigest()))
                    last, state = name, hashlib.sha256(ids.encode())
            if done:
                yield _digest_rows(done)
                done = []
        if last is not None:
            yield _digest_rows([(last, state.hexdigest())])

    return ordered.mapInArrow(run, "name binary, ends_sha256 string")


def _digest_rows(rows: list[tuple[bytes, str]]) -> pa.RecordBatch:
    names, digests = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(digests)], ["name", "ends_sha256"])


# --- trie ------------------------------------------------------------------------------


def prefix_trie(conversations: DataFrame, stretch: int = STRETCH) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    everyone, turns = rebuilt(keyed_turns(conversations))
    cut = saved(blocks(stretches(turns, stretch), stretch), "blocks")
    by = [*_NODE, "keys"]

    # First grouping: members and owners.
    edges = cut.groupBy(*by).agg(F.count("*").alias("n"), F.min("conv_id").alias("first"))
    edges = saved(edges, "edges")
    forks = edges.groupBy("parent").agg(F.count("*").alias("ways")).where("ways > 1")
    forks = forks.select("parent", F.lit(True).alias("fork"))
    edges = salted_join(edges, forks, "parent", "name", "left").withColumn("forked", F.coalesce("fork", F.lit(False)))
    edges = saved(edges.drop("fork"), "edges")
    nodes = grouped(edges, {"n": F.sum("n"), "first": F.min("first")}, ["n", "first"])
    # A parent's children: the refined nodes below it, or the only block that follows it.
    kids = nodes.groupBy(F.col("parent").alias("of")).agg(F.count("*").alias("kids"))
    nodes = nodes.join(kids, F.col("name") == F.col("of"), "left").withColumn("kids", F.coalesce("kids", F.lit(0))).drop("of")
    nodes = saved(nodes, "nodes")
    owned = nodes.groupBy("first").agg(
        F.sum(F.aggregate("sizes", F.lit(0).cast("bigint"), lambda a, x: a + x)).alias("owned"),
        F.count_if(F.col("kids") == 0).alias("leaves"),
        F.min_by(F.struct("name", "parent"), "depth").alias("top"),
    )
    totals = cut.groupBy("conv_id").agg(F.sum(F.aggregate("sizes", F.lit(0).cast("bigint"), lambda a, x: a + x)).alias("bytes"))
    people = everyone.join(totals, "conv_id", "left").join(owned.withColumnRenamed("first", "conv_id"), "conv_id", "left")
    people = people.select(
        "conv_id", "length", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("bytes", "owned", "leaves")], "top"
    )
    people = saved(people, "people")

    # Second grouping: what members add to the sums over a subtree, and what its smallest member has.
    added = salted_join(cut, people.select("conv_id", "bytes", "owned", "leaves"), "conv_id", "depth")
    sums = added.groupBy(F.col("name").alias("of")).agg(
        F.sum("bytes").alias("bytes"), F.sum("owned").alias("owned"), F.sum("leaves").alias("leaves"),
        F.min_by("bytes", "conv_id").alias("first_bytes"), F.min_by("owned", "conv_id").alias("first_owned"),
    )
    carried = ["first", "bytes", "owned", "leaves", "first_bytes", "first_owned"]
    summed = edges.join(sums, F.col("name") == F.col("of")).drop("of", "n")
    total = {c: F.sum(c) for c in ("bytes", "owned", "leaves")} | {c: F.min_by(c, "first") for c in ("first_bytes", "first_owned")}
    summed = grouped(summed, total | {"first": F.min("first")}, carried).drop("first", *_NODE[1:]).withColumnRenamed("name", "of")
    summed = nodes.join(summed, F.col("name") == F.col("of")).drop("of")

    ends = cut.where("last").select("name", "conv_id").unionByName(
        everyone.where("length = 0").select(F.lit(ROOT).alias("name"), "conv_id")
    )
    ends = saved(ends_digests(ends), "ends")

    # The parent of the topmost node that a conversation owns has another owner; others keep it. Such a
    # parent has several children, or an end and a child.
    branching = nodes.join(ends.select(F.col("name").alias("end")), F.col("name") == F.col("end"), "left").where(
        "kids > 1 OR (kids > 0 AND end IS NOT NULL)"
    )
    tops = people.where("top IS NOT NULL").select(F.col("top.parent").alias("parent"), F.col("top.name").alias("top_name"))
    tops = salted_join(tops, branching.select(F.col("name").alias("parent"), F.col("first").alias("above")), "parent", "top_name")
    tops = tops.select("top_name", "above")

    head = people.agg(F.min("conv_id").alias("first"), F.count("*").alias("n")).first()
    if not head["n"]:
        return conversations.sparkSession.createDataFrame([], _RESULT)
    root = people.agg(
        F.count("*").alias("n"), F.sum("bytes").alias("bytes"), F.sum("owned").alias("owned"), F.sum("leaves").alias("leaves"),
        F.min_by("bytes", "conv_id").alias("first_bytes"), F.min_by("owned", "conv_id").alias("first_owned"),
        F.min("conv_id").alias("first"),
    ).withColumn("name", F.lit(ROOT))
    root = root.join(kids, F.col("name") == F.col("of"), "left").select(
        "name", F.lit(0).cast("bigint").alias("depth"), F.array(F.lit(0).cast("bigint")).alias("sizes"), F.lit(0).cast("bigint").alias("pre"),
        "first", "n", F.coalesce("kids", F.lit(0)).alias("kids"), "bytes", "owned",
        F.when(F.col("kids").isNull(), 1).otherwise(F.col("leaves")).cast("bigint").alias("leaves"), "first_bytes", "first_owned",
    )
    every = summed.select(root.columns).unionByName(root)
    every = every.join(ends.withColumnRenamed("name", "end"), F.col("name") == F.col("end"), "left")
    every = every.join(tops, F.col("name") == F.col("top_name"), "left")

    # A chain of nodes unfolds into its turns.
    chain = every.select("*", F.posexplode("sizes").alias("j", "size"))
    pre = F.col("pre") + F.aggregate(F.slice("sizes", F.lit(1), F.col("j")), F.lit(0).cast("bigint"), lambda a, x: a + x)
    is_last, depth = F.col("j") == F.size("sizes") - 1, F.col("depth") + F.col("j")
    inside = F.col("owned") - F.col("first_owned") + F.col("first_bytes") - pre
    parent = F.when(depth > 1, F.when(F.col("j") == 0, F.coalesce("above", "first")).otherwise(F.col("first")))
    return chain.select(
        F.col("first").alias("conv_id"),
        depth.cast("bigint").alias("depth"),
        F.when(depth == 1, F.lit(head["first"])).otherwise(parent).cast("bigint").alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        F.when(is_last, F.col("kids")).otherwise(1).cast("bigint").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        (F.col("bytes") - F.col("n") * pre - inside).cast("bigint").alias("saved_tokens"),
        F.coalesce(F.when(is_last, F.col("ends_sha256")), F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
    )


_RESULT = (
    "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint,"
    " saved_tokens bigint, ends_sha256 string"
)
