"""Conversation prefix trie: nodes from conversations, subtree totals by parallel tree contraction.

A node is a distinct sequence of first turns. Its identity is the sum, over the turns of the
sequence, of 192 bits of a SHA-256 over the turn's place, role and text; the sums are taken blockwise,
so a conversation of any length is spread over many tasks. Equal sums count as equal sequences.

Totals over subtrees come from tree contraction. A round rakes every leaf (its total is known) and
compresses an independent third of the unary chains: a node with one child hands its value to its
parent, the child moves up to the parent, and the node remembers the child. So a chain of n nodes
ends after about log(n) rounds. Afterwards the remembered children are followed, twice as far each
time, until every contracted node has its total again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm.frames import arrow_map, batch_of, drop_stored, stored, tidy

#: Turns of a conversation that are summed in one group, and ends of a node whose ids are joined in one string.
BLOCK_TURNS, BLOCK_IDS = 1 << 16, 1 << 12
_WORDS = [f"w{k}" for k in range(6)]
_NOTHING = hashlib.sha256(b"").hexdigest()


@tidy
def numbered_turns(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_id, pos (from 1), n_bytes and key of every turn, in order of turn (null first).

    Null roles and texts are empty; equal turns are ordered by role and text; repeated rows are turns
    of their own; rows without a conversation are left out. Rows are sorted over all partitions by
    range and numbered from counts per partition, so a long conversation is not one group.
    """
    rows = turns.select(
        F.col(conv_col).cast("bigint").alias("conv_id"), F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    ).where("conv_id IS NOT NULL")
    order = ["conv_id", F.asc_nulls_first("turn"), "role", "text", "spread"]
    # `spread` parts equal rows only; which of them comes first makes no difference
    ranged = rows.withColumn("spread", F.rand(11)).repartitionByRange(*order).withColumn("part", F.spark_partition_id())
    key = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    within = Window.partitionBy("conv_id", "part").orderBy(F.asc_nulls_first("turn"), "role", "text", "spread")
    placed = ranged.withColumn("row", F.row_number().over(within))
    placed = stored(placed.select("conv_id", "part", "row", F.octet_length("text").cast("bigint").alias("n_bytes"), key.alias("key")), "turns")
    counts = placed.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.select("conv_id", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    return placed.join(firsts, ["conv_id", "part"]).select("conv_id", (F.col("first") + F.col("row")).alias("pos"), "n_bytes", "key")


@tidy
def rebuilt(turns: DataFrame, base: Column, borrowed: Column, most: int) -> DataFrame:
    """Turns after the first `borrowed` ones of each conversation are replaced by those of conversation `base`.

    `turns` as `numbered_turns` gives them. `base` and `borrowed` (at most `most`) are expressions over conv_id; a
    conversation that is its own base stays as it is, an absent base has no turns. Result: conv_id, pos, n_bytes,
    key, and for a conversation left without turns one row with pos 0.
    """
    heads = turns.where(F.col("pos") <= most)
    sizes = turns.groupBy("conv_id").agg(F.max("pos").alias("n"))
    convs = sizes.select("conv_id", "n", base.alias("base"), borrowed.cast("bigint").alias("h"))
    convs = convs.withColumn("h", F.when(F.col("base") == F.col("conv_id"), 0).otherwise(F.col("h")))
    lengths = sizes.select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"))
    convs = convs.join(lengths, "base", "left").withColumn("taken", F.least("h", F.coalesce("n_base", F.lit(0))))
    convs = stored(convs, "conversations")
    own = turns.join(convs.select("conv_id", "h", "taken"), "conv_id").where("pos > h")
    own = own.select("conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "n_bytes", "key")
    # at most `most` rows of a base, for each conversation that borrows from it
    lent = convs.where("taken > 0").select("conv_id", "base", "taken").join(heads.withColumnRenamed("conv_id", "base"), "base")
    lent = lent.where("pos <= taken").select("conv_id", "pos", "n_bytes", "key")
    bare = convs.where("taken = 0 AND n <= h").select("conv_id", F.lit(0).cast("bigint").alias("pos"), F.lit(0).cast("bigint").alias("n_bytes"), F.lit("").alias("key"))
    return own.unionByName(lent).unionByName(bare)


@tidy
def trie_nodes(turns: DataFrame, block: int = BLOCK_TURNS) -> DataFrame:
    """Nodes of the trie over `turns` (conv_id, pos, n_bytes, key; pos 0: a conversation without turns).

    One row per distinct sequence of first turns, the empty one included: conv_id (smallest member), depth,
    parent_conv_id (null for the root), n_convs, n_bytes (of the last turn), ends_sha256. (conv_id, depth) is the
    node's key. Without conversations there is no node.
    """
    digest = F.sha2(F.concat(F.col("pos").cast("string"), F.lit(":"), "key"), 256)
    word = lambda k: F.conv(F.substring("digest", 8 * k + 1, 8), 16, 10).cast("bigint")
    rows = turns.where("pos > 0").withColumn("digest", digest).select("conv_id", "pos", "n_bytes", F.expr(f"CAST((pos - 1) DIV {block} AS BIGINT)").alias("block"), *[word(k).alias(w) for k, w in enumerate(_WORDS)])
    in_block = Window.partitionBy("conv_id", "block").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy("conv_id", "block").agg(*[F.sum(w).alias(w) for w in _WORDS])
    starts = totals.select("conv_id", "block", *[F.coalesce(F.sum(w).over(earlier), F.lit(0)).alias(f"s_{w}") for w in _WORDS])
    sums = rows.select("*", *[F.sum(w).over(in_block).alias(f"r_{w}") for w in _WORDS]).join(starts, ["conv_id", "block"])
    whole = F.md5(F.concat_ws(",", "pos", *[F.col(f"s_{w}") + F.col(f"r_{w}") for w in _WORDS]))
    rest = F.md5(F.concat_ws(",", F.col("pos") - 1, *[F.col(f"s_{w}") + F.col(f"r_{w}") - F.col(w) for w in _WORDS]))
    root = F.md5(F.concat_ws(",", F.lit(0), *[F.lit(0) for _ in _WORDS]))
    member = F.max(F.struct("depth", "node")).alias("end")
    steps = stored(sums.select("conv_id", F.col("pos").alias("depth"), "n_bytes", F.unhex(whole).alias("node"), F.unhex(rest).alias("parent")), "trie-steps")
    ends = steps.groupBy("conv_id").agg(member).select("conv_id", "end.node")
    ends = ends.unionByName(turns.where("pos = 0").select("conv_id", F.unhex(root).alias("node")))
    plain = steps.groupBy("node").agg(F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"), F.count(F.lit(1)).alias("n_convs"), F.max("n_bytes").alias("n_bytes"), F.first("parent").alias("parent"))
    convs = ends.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0")
    top = convs.select(F.unhex(root).alias("node"), "conv_id", F.lit(0).cast("bigint").alias("depth"), "n_convs", F.lit(0).cast("bigint").alias("n_bytes"), F.lit(None).cast("binary").alias("parent"))
    nodes = stored(plain.unionByName(top), "trie-nodes")
    parents = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    out = nodes.join(parents, "parent", "left").join(_digests(ends), "node", "left")
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_bytes", F.coalesce("ends_sha256", F.lit(_NOTHING)).alias("ends_sha256"))


def _digests(ends: DataFrame) -> DataFrame:
    """(node, ends_sha256): SHA-256 of the node's conversations, ascending, joined by commas.

    Ids are joined in blocks of the number line, so a group holds at most BLOCK_IDS ids; the blocks of a node with
    several of them stream in order through one hash state.
    """
    ids = F.array_sort(F.collect_list("conv_id"))
    bits = BLOCK_IDS.bit_length() - 1
    parts = ends.groupBy("node", F.shiftright("conv_id", bits).alias("block")).agg(F.array_join(F.transform(ids, lambda x: x.cast("string")), ",").alias("ids"))
    parts = stored(parts, "trie-ends")
    many = parts.groupBy("node").agg(F.count(F.lit(1)).alias("n"))
    single = parts.join(many.where("n = 1"), "node", "left_semi").select("node", F.sha2("ids", 256).alias("ends_sha256"))
    several = parts.join(many.where("n > 1"), "node", "left_semi").select("node", "block", "ids")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, hashlib.sha256()
        for batch in batches:
            done: list[tuple[bytes, str]] = []
            for node, text in zip(batch.column("node").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                if node != now:
                    if now is not None:
                        done.append((now, state.hexdigest()))
                    now, state = node, hashlib.sha256(text.encode())
                else:
                    state.update(b"," + text.encode())
            if done:
                yield batch_of(node=pa.array([x for x, _ in done], pa.binary()), ends_sha256=pa.array([x for _, x in done]))
        if now is not None:
            yield batch_of(node=pa.array([now], pa.binary()), ends_sha256=pa.array([state.hexdigest()]))

    ordered = several.repartition("node").sortWithinPartitions("node", "block")
    return single.unionByName(arrow_map(ordered, hashed, "node binary, ends_sha256 string"))


@tidy
def subtree_totals(nodes: DataFrame, key: Sequence[str], parent: Sequence[str], values: Sequence[str]) -> DataFrame:
    """`key` and, for each of `values` (whole numbers), its sum over the node and all below it.

    `key` and `parent` are whole-number columns; a root's parent columns are null; every other parent must be
    a node and nodes must form a forest, else an error is raised once a round removes nothing. Nulls count as 0.
    A node with very many children is a row of an aggregate with map-side combining. An empty table gives none.
    """
    own, up, down = [f"k{i}" for i in range(len(key))], [f"p{i}" for i in range(len(key))], [f"c{i}" for i in range(len(key))]
    sums = [f"v{i}" for i in range(len(values))]
    active = nodes.select(*[F.col(c).cast("bigint").alias(a) for c, a in zip([*key, *parent], [*own, *up], strict=True)], *[F.coalesce(F.col(c).cast("bigint"), F.lit(0)).alias(a) for c, a in zip(values, sums, strict=True)])
    rounds: list[DataFrame] = []
    left = None
    while True:
        step = stored(_contracted(active, own, up, down, sums, len(rounds)), "contraction")
        active = step.where("NOT gone").select(*own, *up, *sums)
        rounds.append(step.where("gone").select(*own, *down, *sums))
        now = active.count()
        if not now:
            break
        if now == left:
            raise ValueError("the parents do not form a forest")
        left = now
    removed = rounds[0]
    for frame in rounds[1:]:
        removed = removed.unionByName(frame)
    known = stored(removed, "contracted")
    while not known.where(f"{down[0]} IS NOT NULL").isEmpty():
        open_ = known.where(f"{down[0]} IS NOT NULL")
        below = known.select(*[F.col(a).alias(b) for a, b in zip(own, down, strict=True)], *[F.col(c).alias(f"n_{c}") for c in down], *[F.col(v).alias(f"n_{v}") for v in sums])
        further = open_.join(below, down).select(*own, *[F.col(f"n_{c}").alias(c) for c in down], *[(F.col(v) + F.col(f"n_{v}")).alias(v) for v in sums])
        before, known = known, stored(known.where(f"{down[0]} IS NULL").unionByName(further), "expanded")
        drop_stored(before)
    return known.select(*[F.col(a).alias(c) for a, c in zip(own, key, strict=True)], *[F.col(v).alias(c) for v, c in zip(sums, values, strict=True)])


def _contracted(active: DataFrame, own: list[str], up: list[str], down: list[str], sums: list[str], turn: int) -> DataFrame:
    """The nodes after one round: `gone` ones with their remembered child (null for a leaf), others with new parent and sums."""
    # a single child's key is the exclusive or over all children; HashAggregate holds it, unlike a minimum of a struct
    kids = active.where(f"{up[0]} IS NOT NULL").groupBy(*[F.col(u).alias(k) for u, k in zip(up, own, strict=True)]).agg(F.count(F.lit(1)).alias("n"), *[F.bit_xor(k).alias(c) for k, c in zip(own, down, strict=True)])
    chance = lambda columns: F.xxhash64(*columns, F.lit(turn))
    single = (F.col("n") == 1) & F.col(up[0]).isNotNull()
    # a node that beats both neighbours of its chain is never next to another such node
    wins = single & (chance(own) > chance(up)) & (chance(own) > chance(down))
    marked = active.join(kids, own, "left")
    leaf = F.col("n").isNull()
    marked = marked.select(*own, *up, *sums, *[F.when(F.coalesce(wins, F.lit(False)), F.col(c)).alias(c) for c in down], leaf.alias("leaf"))
    inner = marked.where(f"{down[0]} IS NOT NULL").select(*[F.col(c).alias(k) for c, k in zip(down, own, strict=True)], *[F.col(u).alias(f"u_{u}") for u in up])
    # the child of a compressed node moves up
    moved = marked.join(inner, own, "left").select(*own, *[F.coalesce(f"u_{u}", u).alias(u) for u in up], *sums, *down, "leaf")
    gone = F.col("leaf") | F.col(down[0]).isNotNull()
    given = moved.where(gone & F.col(up[0]).isNotNull()).groupBy(*[F.col(u).alias(k) for u, k in zip(up, own, strict=True)]).agg(*[F.sum(v).alias(f"g_{v}") for v in sums])
    return moved.join(given, own, "left").select(
        *own, *up, *down, gone.alias("gone"), *[F.when(gone, F.col(v)).otherwise(F.col(v) + F.coalesce(f"g_{v}", F.lit(0))).alias(v) for v in sums]
    )


@tidy
def conversation_trie(turns: DataFrame) -> DataFrame:
    """One row per node of the trie over `turns` (as `numbered_turns` or `rebuilt` give them).

    conv_id (smallest member), depth, parent_conv_id, n_convs (members), n_children, n_leaves (childless nodes in the
    subtree), saved_tokens (sum over the subtree of (n_convs - 1) * bytes of the last text), ends_sha256.
    """
    nodes = trie_nodes(turns)
    key, parent = ["conv_id", "depth"], ["parent_conv_id", "parent_depth"]
    linked = nodes.withColumn("parent_depth", F.when(F.col("parent_conv_id").isNotNull(), F.col("depth") - 1))
    kids = linked.where("parent_depth IS NOT NULL").groupBy(*[F.col(p).alias(k) for p, k in zip(parent, key, strict=True)]).agg(F.count(F.lit(1)).alias("n_children"))
    linked = linked.join(kids, key, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("bigint")))
    linked = stored(linked, "trie-linked")
    valued = linked.select(*key, *parent, F.when(F.col("n_children") == 0, 1).otherwise(0).alias("n_leaves"), ((F.col("n_convs") - 1) * F.col("n_bytes")).alias("saved_tokens"))
    totals = subtree_totals(valued, key, parent, ["n_leaves", "saved_tokens"])
    return linked.join(totals, key).select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def trie_sql(every: int = 5, most: int = 9) -> str:
    """DuckDB SQL for the trie of rebuilt conversations; CRC-32 is computed bit by bit."""
    bits = "list_reduce([xor(a, b)] || range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384::BIGINT) ELSE c // 2 END)"
    letters = "list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)"
    crc = f"xor(list_reduce([4294967295::BIGINT] || {letters}, lambda a, b: {bits}), 4294967295::BIGINT)"
    return f"""
    WITH turns AS (
        SELECT conv_id, coalesce(role, '') AS role, coalesce("text", '') AS "text",
               row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce("text", '')) AS pos
        FROM conversations WHERE conv_id IS NOT NULL
    ), original AS (
        SELECT conv_id, list({{'role': role, 'text': "text"}} ORDER BY pos) AS turns FROM turns GROUP BY conv_id
    ), plan AS (
        SELECT conv_id, turns, conv_id - conv_id % {every} AS base, {crc} % {most} AS h FROM original
    ), rebuilt AS (
        SELECT p.conv_id, CASE WHEN p.base = p.conv_id THEN p.turns ELSE coalesce(b.turns[1:p.h], []) || p.turns[p.h + 1:] END AS turns
        FROM plan p LEFT JOIN original b ON b.conv_id = p.base
    ), steps AS (
        SELECT conv_id, d AS depth, turns[1:d] AS prefix, turns[1:d - 1] AS upper, len(turns) = d AS at_end
        FROM (SELECT conv_id, turns, unnest(range(0, len(turns) + 1)) AS d FROM rebuilt)
    ), nodes AS (
        SELECT prefix, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(upper) AS upper,
               coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (at_end), '') AS ends,
               CASE WHEN depth = 0 THEN 0 ELSE octet_length(encode(any_value(prefix[depth]['text']))) END AS n_bytes
        FROM steps GROUP BY prefix, depth
    ), linked AS (
        SELECT n.*, p.conv_id AS parent_conv_id, n.depth - 1 AS parent_depth,
               (SELECT count(*) FROM nodes c WHERE c.depth = n.depth + 1 AND c.upper = n.prefix) AS n_children
        FROM nodes n LEFT JOIN nodes p ON n.depth = p.depth + 1 AND p.prefix = n.upper
    ), below AS (
        SELECT a.conv_id, a.depth, sum((x.n_children = 0)::BIGINT) AS n_leaves, sum((x.n_convs - 1) * x.n_bytes) AS saved_tokens
        FROM linked x JOIN steps s ON s.conv_id = x.conv_id AND s.depth <= x.depth JOIN linked a ON a.depth = s.depth AND a.prefix = s.prefix
        GROUP BY a.conv_id, a.depth
    )
    SELECT conv_id, depth::BIGINT AS depth, parent_conv_id, n_convs::BIGINT AS n_convs, n_children::BIGINT AS n_children,
           n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, sha256(ends) AS ends_sha256
    FROM linked JOIN below USING (conv_id, depth)
    """
