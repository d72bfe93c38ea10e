"""The prefix trie of rebuilt conversations, rolled up band by band.

A node is a distinct sequence of first turns.  Its key is 128 bits: two XOR
sums over (turn digest, depth) pairs, so that prefixes come from running sums
within chunks of ``CHUNK`` turns and from the totals of the chunks before; no
task holds a whole conversation.  Nodes, their members and their ends come from
one grouped aggregation that combines before the shuffle.

Only nodes with more than one member need a subtree: below a node with a
single member lies a chain, whose one leaf its topmost node hands to its parent.
Of the shared nodes, each explodes to its ancestors within its band of
``BAND`` levels, found by doubling pointers.  Band roots with their band's
sums then form a tree ``BAND`` times lower, rolled up by the same step;
the roots' completed totals go to the band above them.  So a trie of depth D
takes log(D) / log(BAND) rounds, and a node makes at most ``BAND`` rows a round.

``ends_sha256`` hashes ids in order: they are sorted over all tasks, short
lists are hashed where they lie, and lists that are long or cross tasks go on
as pieces of text that one task hashes as they stream by (SHA-256 knows no
other order), holding one piece at a time.

Edge cases: rows without a conv_id take no part; a null turn comes first;
turns of one number follow by their digest, so repeated rows are turns of
their own; null roles and texts are empty; negative ids take the remainder
of SQL's ``%``; a conversation may end up without a turn; an empty table gives no rows;
other columns are ignored, whatever their names; texts are hashed whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterlens.llm.merkle import crc_sql
from meterlens.llm.ranks import ranked
from meterlens.llm.util import written

#: Fixed by the query: copies come from the next lower multiple of this id, and have fewer turns than that.
GROUP, HEADS = 5, 9
#: Turns of a conversation that one window holds; levels of a band; ids of a piece of text.
CHUNK, BAND, PIECE = 4096, 8, 4096
KEY = ["depth", "ka", "kb"]


def turn_rows(conversations: DataFrame) -> DataFrame:
    """``conv_id, p`` (place from 1), ``a, b`` (the turn's digest), ``size`` (bytes of text)."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)
    rows = (conversations.filter(F.col("conv_id").isNotNull())
            .select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("turn"), digest.alias("digest"),
                    F.octet_length(text).cast("long").alias("size")))
    rows = written(rows.select("conv_id", "turn", F.substring("digest", 1, 16).alias("tie"), F.xxhash64("digest").alias("a"),
                               F.xxhash64("digest", F.lit(1)).alias("b"), "size"), "trie-turns")
    placed = ranked(rows, "conv_id", [F.col("turn").asc_nulls_first(), F.col("tie").asc()], "trie-ranked")
    return placed.select("conv_id", (F.col("rank") + 1).alias("p"), "a", "b", "size")


def _copied(conv_id: str) -> Column:
    return F.crc32(F.col(conv_id).cast("string").cast("binary")) % HEADS


def rebuilt(turns: DataFrame) -> DataFrame:
    """A row per conversation: ``conv_id, n`` (own turns), ``h, m`` (turns
    asked for and found in the source), ``length``, ``heads`` (those turns)."""
    own = turns.groupBy("conv_id").agg(F.max("p").alias("n"))
    first = turns.filter((F.col("conv_id") % GROUP == 0) & (F.col("p") < HEADS))
    heads = first.groupBy(F.col("conv_id").alias("source")).agg(F.sort_array(F.collect_list(F.struct("p", "a", "b", "size"))).alias("heads"))
    convs = own.select("conv_id", "n", _copied("conv_id").alias("h"), (F.col("conv_id") - F.col("conv_id") % GROUP).alias("source"))
    m = F.least(F.col("h"), F.coalesce(F.size("heads"), F.lit(0)).cast("long"))
    return (convs.join(heads, "source", "left").select("conv_id", "n", "h", F.greatest(m, F.lit(0)).alias("m"), "heads")
            .withColumn("length", F.col("m") + F.greatest(F.col("n") - F.col("h"), F.lit(0)))
            .withColumn("heads", F.when(F.col("m") > 0, F.slice("heads", F.lit(1), F.col("m").cast("int")))))


def path_rows(turns: DataFrame, convs: DataFrame, chunk: int) -> DataFrame:
    """A row per rebuilt turn: ``conv_id, depth, ka, kb`` (key of the sequence
    that ends there), ``pa, pb`` (of the one before), ``size, last``."""
    none = F.lit(None).cast("long")
    # each chunk starts with a row of what its conversation says about all of its turns
    marks = convs.select("conv_id", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(n - 1) div {chunk}"))).alias("chunk"),
                         "h", "m", "length", "n")
    marks = marks.select("conv_id", "chunk", (F.col("chunk") * chunk).alias("p"), none.alias("a"), none.alias("b"), none.alias("size"),
                         F.lit(False).alias("own"), (F.col("h") - F.col("m")).alias("gap"), "length", (F.col("n") > chunk).alias("long"))
    plain = (none.alias("gap"), none.alias("length"), F.lit(None).cast("boolean").alias("long"))
    heads = convs.filter("m > 0").select("conv_id", F.lit(0).cast("long").alias("chunk"), F.inline("heads")).select(
        "conv_id", "chunk", "p", "a", "b", "size", F.lit(False).alias("own"), *plain)
    own = turns.filter(F.col("p") > _copied("conv_id")).select(
        "conv_id", F.expr(f"(p - 1) div {chunk}").alias("chunk"), "p", "a", "b", "size", F.lit(True).alias("own"), *plain)
    w = Window.partitionBy("conv_id", "chunk").orderBy("p")
    so_far = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = marks.unionByName(heads).unionByName(own)
    rows = rows.select("conv_id", "chunk", "p", "a", "b", "size", "own", *[F.first(c).over(so_far).alias(c) for c in ("gap", "length", "long")])
    depth = F.when(F.col("own"), F.col("p") - F.col("gap")).otherwise(F.col("p"))
    rows = rows.withColumn("depth", depth)
    rows = rows.select("*", *[F.when(F.col(c).isNotNull(), F.xxhash64(c, "depth")).otherwise(0).alias("l" + c) for c in "ab"])
    rows = rows.select("conv_id", "chunk", "p", "depth", "size", "length", "long", "la", "lb",
                       *[F.bit_xor("l" + c).over(so_far).alias("k" + c) for c in "ab"])
    rows = written(rows.filter(F.col("size").isNotNull()).select(
        "conv_id", "chunk", "depth", "size", (F.col("depth") == F.col("length")).alias("last"), "long", "la", "lb", "ka", "kb"), "trie-paths")
    # chunks of long conversations go on from the chunks before
    totals = rows.filter("long").groupBy("conv_id", "chunk").agg(*[F.bit_xor("l" + c).alias("t" + c) for c in "ab"])
    before = Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("conv_id", "chunk", *[F.bit_xor("t" + c).over(before).alias("t" + c) for c in "ab"]).filter("chunk > 0")
    later = rows.filter("chunk > 0").join(totals, ["conv_id", "chunk"], "left")
    later = later.select("conv_id", "depth", "size", "last", "la", "lb",
                         *[F.col("k" + c).bitwiseXOR(F.coalesce("t" + c, F.lit(0))).alias("k" + c) for c in "ab"])
    rows = rows.filter("chunk = 0").select(*later.columns).unionByName(later)
    return rows.select("conv_id", *KEY, *[F.col("k" + c).bitwiseXOR(F.col("l" + c)).alias("p" + c) for c in "ab"], "size", "last")


def node_rows(paths: DataFrame, convs: DataFrame) -> DataFrame:
    """A row per node: key, parent's key, ``conv_id`` (smallest member),
    ``n_convs, size, n_ends, end`` (smallest member that ends there)."""
    end = F.when(F.col("last"), F.col("conv_id"))
    nodes = paths.groupBy(*KEY).agg(
        F.max("pa").alias("pa"), F.max("pb").alias("pb"), F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"),
        F.max("size").alias("size"), F.count(end).alias("n_ends"), F.min(end).alias("end"))
    short = F.when(F.col("length") == 0, F.col("conv_id"))
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.count(short).alias("n_ends"),
                     F.min(short).alias("end")).filter("n_convs > 0")
    return nodes.unionByName(root.select(*[zero.alias(c) for c in KEY], none.alias("pa"), none.alias("pb"), "conv_id", "n_convs",
                                         zero.alias("size"), "n_ends", "end"))


def _with_ancestors(nodes: DataFrame, band: int) -> DataFrame:
    """``nodes`` and ``up``: the keys above each within its band, nearest first."""
    height = F.col("depth") % band
    up = F.when(height > 0, F.array(F.struct((F.col("depth") - 1).alias("depth"), F.col("pa").alias("ka"), F.col("pb").alias("kb"))))
    out = nodes.withColumn("up", F.coalesce(up, F.array().cast("array<struct<depth:long,ka:long,kb:long>>")))
    known = 1
    while known < band - 1:  # a node's list goes on with its last ancestor's list
        out = written(out, "trie-up")
        last = F.element_at("up", -1)
        asks = out.filter(height > known).select("*", *[last[c].alias("to_" + c) for c in KEY])
        theirs = out.filter(height > 0).select(*[F.col(c).alias("to_" + c) for c in KEY], F.col("up").alias("more"))
        longer = asks.join(theirs.hint("shuffle_merge"), ["to_" + c for c in KEY], "left")
        longer = longer.withColumn("up", F.concat("up", F.coalesce("more", F.array().cast("array<struct<depth:long,ka:long,kb:long>>"))))
        out = out.filter(height <= known).unionByName(longer.select(*out.columns))
        known *= 2
    return out


def _add(rows: DataFrame, to: str) -> DataFrame:
    """Sums of ``leaves`` and ``saved`` at each key in the list ``to``."""
    return (rows.select(F.inline(to), "leaves", "saved").groupBy(*KEY)
                .agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")))


def subtree_sums(nodes: DataFrame, band: int) -> DataFrame:
    """``depth, ka, kb, leaves, saved``: sums over each node's subtree of
    ``nodes`` (``depth, ka, kb, pa, pb, leaves, saved``; a parent is one level up)."""
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    listed = written(_with_ancestors(nodes, band), "trie-bands")
    me = F.array(F.struct(*KEY))
    inside = listed.select(F.concat(me, F.col("up")).alias("to"), "leaves", "saved")
    if deepest < band:
        return _add(inside, "to")
    sums = written(_add(inside, "to"), "trie-sums")
    # each band's root: its parent and what is above that make the band above
    parents = listed.select((F.col("depth") + 1).alias("depth"), F.col("ka").alias("pa"), F.col("kb").alias("pb"),
                            F.concat(F.array(F.struct(*KEY)), F.col("up")).alias("to"))
    roots = listed.filter(F.col("depth") % band == 0).select(*KEY, "pa", "pb")
    roots = written(roots.join(parents.filter(F.col("depth") % band == 0).hint("shuffle_merge"), ["depth", "pa", "pb"], "left")
                    .join(sums, KEY).select(*KEY, "to", "leaves", "saved"), "trie-roots")
    top = F.element_at("to", -1)
    lower = roots.select((F.col("depth") / band).cast("long").alias("depth"), "ka", "kb", top["ka"].alias("pa"), top["kb"].alias("pb"),
                         "leaves", "saved")
    done = subtree_sums(lower, band).withColumn("depth", F.col("depth") * band)
    passed = roots.select(*KEY, "to").filter("depth > 0").join(done, KEY).select("to", "leaves", "saved")
    both = sums.unionByName(_add(passed, "to"))
    return written(both.groupBy(*KEY).agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")), "trie-totals")


def end_digests(ends: DataFrame, piece: int = PIECE) -> DataFrame:
    """``depth, ka, kb, ends_sha256`` of every key with two ``conv_id`` or more."""
    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        key, held, sent = None, [], True  # the task's first run may have begun in the task before: all of it is sent on

        def send() -> None:
            for at in range(0, len(held), piece):
                part = held[at:at + piece]
                out.append((*key, part[0], ",".join(map(str, part)), None))
            held.clear()

        for b in batches:
            cols = [b.column(c).to_numpy() for c in (*KEY, "conv_id")]
            if not b.num_rows:
                continue
            cut = np.flatnonzero(np.any([c[1:] != c[:-1] for c in cols[:3]], axis=0)) + 1
            for s, e in zip([0, *cut], [*cut, b.num_rows]):
                now = tuple(int(c[s]) for c in cols[:3])
                if now != key:
                    if key is not None:
                        if sent:
                            send()
                        elif len(held) > 1:
                            out.append((*key, held[0], None, hashlib.sha256(",".join(map(str, held)).encode()).hexdigest()))
                        held.clear()
                        sent = False
                    else:
                        sent = True
                    key = now
                held += cols[3][s:e].tolist()
                if len(held) >= piece:
                    sent = True
                    send()
            yield from flush(out)
        if key is not None:
            send()
        yield from flush(out)

    def flush(out: list[tuple]) -> Iterator[pa.RecordBatch]:
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), [pa.int64()] * 4 + [pa.string()] * 2)],
                                             [*KEY, "first", "ids", "ends_sha256"])
            out.clear()

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for b in batches:
            done = []
            for *now, ids in zip(*(b.column(c).to_pylist() for c in (*KEY, "ids"))):
                if now != key:
                    if key is not None:
                        done.append((*key, None, None, state.hexdigest()))
                    key, state = now, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield from flush(done)
        if key is not None:
            yield from flush([(*key, None, None, state.hexdigest())])

    schema = "depth long, ka long, kb long, first long, ids string, ends_sha256 string"
    by = ["ka", "kb", "depth", "conv_id"]
    rows = written(ends.select(*KEY, "conv_id").repartitionByRange(*by).sortWithinPartitions(*by).mapInArrow(runs, schema), "trie-ends")
    split = rows.filter("ids IS NOT NULL").repartition(*KEY).sortWithinPartitions(*KEY, "first").mapInArrow(chain, schema)
    return rows.filter("ids IS NULL").unionByName(split).select(*KEY, "ends_sha256")


def build_trie(conversations: DataFrame, chunk: int = CHUNK, band: int = BAND, piece: int = PIECE) -> DataFrame:
    """The contract's row per node, and the node's key (``ka, kb``)."""
    turns = turn_rows(conversations)
    convs = written(rebuilt(turns), "trie-convs")
    paths = path_rows(turns, convs, chunk)
    nodes = written(node_rows(paths, convs), "trie-nodes")
    single = (F.col("n_convs") == 1).cast("long")
    parent = ((F.col("depth") - 1).alias("depth"), F.col("pa").alias("ka"), F.col("pb").alias("kb"))
    children = (nodes.filter("depth > 0").select(*parent, single.alias("chain")).groupBy(*KEY)
                     .agg(F.count(F.lit(1)).alias("n_children"), F.sum("chain").alias("chains")))
    shared = nodes.filter("n_convs > 1").join(children, KEY, "left").na.fill(0, ["n_children", "chains"])
    shared = written(shared.withColumn("leaves", F.col("chains") + (F.col("n_children") == 0).cast("long"))
                           .withColumn("saved", (F.col("n_convs") - 1) * F.col("size")), "trie-shared")
    sums = subtree_sums(shared.select(*KEY, "pa", "pb", "leaves", "saved"), band)
    zero = F.lit(0).cast("long")
    ends = paths.filter("last").select(*KEY, "conv_id").unionByName(
        convs.filter("length = 0").select(*[zero.alias(c) for c in KEY], "conv_id"))
    digests = end_digests(ends, piece)
    texts = F.when(F.col("n_ends") == 1, F.sha2(F.col("end").cast("string").cast("binary"), 256)).when(
        F.col("n_ends") == 0, F.sha2(F.lit("").cast("binary"), 256))
    full = (shared.drop("leaves", "saved").join(sums, KEY, "left").join(digests, KEY, "left")
                  .select(*KEY, "pa", "pb", "conv_id", "n_convs", "n_children", F.col("leaves").alias("n_leaves"),
                          F.col("saved").alias("saved_tokens"), F.coalesce(texts, F.col("ends_sha256")).alias("ends_sha256")))
    one = F.lit(1).cast("long")
    chains = nodes.filter("n_convs = 1").select(
        *KEY, "pa", "pb", "conv_id", "n_convs", (1 - F.col("n_ends")).alias("n_children"), one.alias("n_leaves"),
        zero.alias("saved_tokens"), texts.alias("ends_sha256"))
    # a parent is shared, or is the same conversation's; AQE splits the children of a hot one
    above = shared.select((F.col("depth") + 1).alias("depth"), F.col("ka").alias("pa"), F.col("kb").alias("pb"),
                          F.col("conv_id").alias("above"))
    out = full.unionByName(chains).join(above.hint("shuffle_merge"), ["depth", "pa", "pb"], "left")
    return out.select("conv_id", "depth", F.when(F.col("depth") > 0, F.coalesce("above", "conv_id")).alias("parent_conv_id"),
                      "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256", "ka", "kb")


CONTRACT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]

#: The same trie in DuckDB SQL: prefixes as lists of digests, each node exploded to all of its ancestors.
ORACLE = f"""
WITH t AS (SELECT conv_id, sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS x,
    strlen(coalesce(text, '')) AS size, turn FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT conv_id, list({{'x': x, 'size': size}} ORDER BY turn NULLS FIRST, x) AS own,
    {crc_sql('CAST(conv_id AS VARCHAR)')} % {HEADS} AS h FROM t GROUP BY conv_id),
s AS (SELECT o.conv_id, list_concat(coalesce(b.own, [])[1:o.h], o.own[o.h + 1:]) AS seq
    FROM o LEFT JOIN o b ON b.conv_id = o.conv_id - o.conv_id % {GROUP}),
q AS (SELECT conv_id, list_transform(seq, lambda e: e.x) AS xs, list_transform(seq, lambda e: e.size) AS sizes FROM s),
p AS (SELECT conv_id, d, xs[1:d] AS path, CASE WHEN d = 0 THEN 0 ELSE sizes[d] END AS size, d = len(xs) AS last
    FROM (SELECT *, unnest(range(len(xs) + 1)) AS d FROM q)),
n AS (SELECT d, path, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(size) AS saved,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE last), '')) AS ends FROM p GROUP BY d, path),
k AS (SELECT path[1:d - 1] AS path, count(*) AS n_children FROM n WHERE d > 0 GROUP BY 1),
m AS (SELECT n.*, coalesce(k.n_children, 0) AS n_children FROM n LEFT JOIN k ON k.path = n.path),
u AS (SELECT path[1:a] AS path, sum(saved) AS saved, count(*) FILTER (WHERE n_children = 0) AS leaves
    FROM (SELECT *, unnest(range(d + 1)) AS a FROM m) GROUP BY 1)
SELECT m.conv_id, CAST(m.d AS BIGINT) AS depth, b.conv_id AS parent_conv_id, CAST(m.n_convs AS BIGINT) AS n_convs,
    CAST(m.n_children AS BIGINT) AS n_children, CAST(u.leaves AS BIGINT) AS n_leaves, CAST(u.saved AS BIGINT) AS saved_tokens,
    m.ends AS ends_sha256
FROM m JOIN u ON u.path = m.path LEFT JOIN m b ON m.d > 0 AND b.path = m.path[1:m.d - 1]
"""
