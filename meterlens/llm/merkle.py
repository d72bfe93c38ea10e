"""A Merkle manifest of ``documents`` as a persistent, path-copying tree.

Leaves rank within their language by one range shuffle (``ranks``).  Runs of
``2 ** LEVELS`` neighbours are aligned blocks; a task builds one block at a
time and hands on only the block's top.  Tops are the leaves of the next
round, so that a language of any size takes log(n) / LEVELS rounds and no
task holds more than one block.  The languages' tops form the last tree, by
the same rounds.

Every tampered leaf makes a version of the tree: it copies only the leaf's
ancestors and shares all other nodes with the original.  Inside a block the
copies are made next to the block's nodes; above it the version goes on along
the siblings that the block's top got from the distributed rounds.

``H`` is the lowercase hex SHA-256 of its inputs' hex texts one after another.

Edge cases: a null language is a tree of its own (first); null ids come first
in their language and are never tampered with; rows of one id follow by
digest, so that repeated rows are leaves of their own with equal digests;
null fields count as ``-``; ``n_chars`` of the largest long is still one
more when tampered with; an empty table gives no rows; other columns are
ignored, whatever their names; texts are hashed whole, in the JVM.
"""

from __future__ import annotations

import hashlib
from binascii import hexlify, unhexlify

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlens.llm.ranks import ranked
from meterlens.llm.util import written
from meterlens.plans.joins import join_small

#: Levels of an aligned block: 4,096 leaves, 160 kB of digests.
LEVELS = 12
#: Every how manieth id hash is tampered with.
TAMPER = 7
_ALONE, _LEFT, _RIGHT = b"-LR"


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_rows(docs: DataFrame) -> DataFrame:
    """``tree, lang, doc_id, leaf, changed``: digests as bytes; ``changed`` is
    the digest after tampering, null where nothing is done."""
    d = docs.select(*[F.col(c).alias(c) for c in ("doc_id", "source", "lang", "n_chars", "text")])

    def digest(n_chars: Column) -> Column:
        fields = [F.col("doc_id"), F.col("source"), F.col("lang"), n_chars, F.col("text")]
        return F.unhex(F.sha2(F.concat(*map(_field, fields)).cast("binary"), 256))

    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPER == 0
    more = F.col("n_chars").cast("decimal(20,0)") + 1
    return d.select(F.when(F.col("lang").isNull(), "-").otherwise(F.concat(F.lit("="), F.col("lang"))).alias("tree"),
                    "lang", F.col("doc_id").cast("long").alias("doc_id"), digest(F.col("n_chars")).alias("leaf"),
                    F.when(hit, digest(more)).alias("changed"))


def H(*parts: bytes) -> bytes:
    """Hex digest of hex digests."""
    return hexlify(hashlib.sha256(b"".join(parts)).digest())


class Block:
    """The nodes above one run of neighbours: ``levels[0]`` are the leaves."""

    def __init__(self, leaves: list[bytes], first: bool, height: int = LEVELS) -> None:
        alone = first and len(leaves) < 1 << height  # the whole tree: it ends where one node is left
        self.levels = [leaves]
        while len(self.levels[-1]) > 1 if alone else len(self.levels) <= height:
            low = self.levels[-1]
            self.levels.append([H(*low[i:i + 2]) for i in range(0, len(low), 2)])

    @property
    def top(self) -> bytes:
        return self.levels[-1][0]

    def siblings(self, at: int) -> list[tuple[int, bytes]]:
        """Side and digest of what stands next to each node on the way up."""
        out = []
        for level in self.levels[:-1]:
            near = at ^ 1
            out.append((_LEFT if near < at else _RIGHT, level[near]) if near < len(level) else (_ALONE, b""))
            at >>= 1
        return out


def copy_path(leaf: bytes, siblings: list[tuple[int, bytes]]) -> list[bytes]:
    """The nodes a version has of its own, from the leaf up; all else is shared."""
    out = [leaf]
    for side, near in siblings:
        out.append(H(near, out[-1]) if side == _LEFT else H(out[-1], near))
    return out


def _pack(siblings: list[tuple[int, bytes]]) -> tuple[bytes, bytes]:
    return bytes(s for s, _ in siblings), b"".join(unhexlify(d) for _, d in siblings)


def _unpack(sides: bytes, digests: bytes) -> list[tuple[int, bytes]]:
    out, at = [], 0
    for s in sides:
        out.append((s, b"" if s == _ALONE else hexlify(digests[at:at + 32])))
        at += 0 if s == _ALONE else 32
    return out


def _sorted(table: pa.Table) -> pa.Table:
    return table.sort_by("rank").combine_chunks()


def _hex(column) -> list[bytes]:
    return [hexlify(x) for x in column.to_pylist()]


def climb(nodes: DataFrame, name: str, levels: int = LEVELS) -> DataFrame:
    """``tree, rank, sides, digests, top`` of ``nodes`` (``tree, rank, node``):
    what stands next to each node's ancestors up to its tree's top, and that top.

    One call a round: blocks hand their tops to the next call, whose answer is
    joined to them again block by block.  ``nodes`` should be a table.
    """
    largest = nodes.agg(F.max("rank")).first()[0]
    if not largest:  # every tree is one node
        return nodes.select("tree", "rank", F.lit(b"").alias("sides"), F.lit(b"").alias("digests"), F.col("node").alias("top"))
    blocked = nodes.withColumn("block", F.shiftright("rank", levels))

    def tops(key, table):
        tree, block = (k.as_py() for k in key)
        b = Block(_hex(_sorted(table).column("node")), block == 0, levels)
        return pa.table({"tree": [tree], "rank": pa.array([block], pa.int64()), "node": [unhexlify(b.top)]})

    higher = written(blocked.groupBy("tree", "block").applyInArrow(tops, "tree string, rank long, node binary"), name)
    above = climb(higher, name, levels).withColumnRenamed("rank", "block")

    def paths(key, low, up):
        tree, block = (k.as_py() for k in key)
        low = _sorted(low)
        b = Block(_hex(low.column("node")), block == 0, levels)
        rest = up.column("sides")[0].as_py(), up.column("digests")[0].as_py()
        own = [_pack(b.siblings(i)) for i in range(low.num_rows)]
        return pa.table({"tree": pa.array([tree] * low.num_rows, pa.string()), "rank": low.column("rank"),
                         "sides": pa.array([s + rest[0] for s, _ in own], pa.binary()),
                         "digests": pa.array([d + rest[1] for _, d in own], pa.binary()),
                         "top": pa.array([up.column("top")[0].as_py()] * low.num_rows, pa.binary())})

    both = blocked.groupBy("tree", "block").cogroup(above.groupBy("tree", "block"))
    return written(both.applyInArrow(paths, "tree string, rank long, sides binary, digests binary, top binary"), name)


def build_manifest(docs: DataFrame, levels: int = LEVELS) -> DataFrame:
    """A row per document: ``lang, doc_id, rank`` (its place in its language),
    ``leaf``, ``changed``, ``subroot``, ``root``, the siblings on its way to the
    root (``sides``: a letter a level, ``digests``: 32 bytes each, none for
    ``-``), ``folded`` (the root recomputed from the changed, else the
    original leaf) and, for tampered leaves, ``copies``: the nodes of its
    version, from the leaf to the version's root.  Digests are bytes."""
    leaves = written(leaf_rows(docs), "merkle-leaves")
    placed = ranked(leaves, "tree", [F.col("doc_id").asc_nulls_first(), F.col("leaf").asc()], "merkle-ranked")
    blocked = placed.withColumn("block", F.shiftright("rank", levels))

    def tops(key, table):
        tree, block = (k.as_py() for k in key)
        b = Block(_hex(_sorted(table).column("leaf")), block == 0, levels)
        return pa.table({"tree": [tree], "rank": pa.array([block], pa.int64()), "node": [unhexlify(b.top)]})

    tops_of = written(blocked.select("tree", "block", "rank", "leaf").groupBy("tree", "block")
                      .applyInArrow(tops, "tree string, rank long, node binary"), "merkle-tops")
    above = climb(tops_of, "merkle-climb", levels)  # one row a block
    # the languages' own tops are the leaves of one more tree
    subroots = written(above.filter("rank = 0").select(F.lit("").alias("tree"), F.col("tree").alias("of"), F.col("top").alias("node")),
                       "merkle-subroots")
    ordered = written(ranked(subroots, "tree", [F.col("of").asc()], "merkle-order"), "merkle-langs")
    last = climb(ordered.select("tree", "rank", "node"), "merkle-root", levels)
    langs = (ordered.join(last.select("rank", F.col("sides").alias("more_sides"), F.col("digests").alias("more_digests"),
                                      F.col("top").alias("root")), "rank")
             .select(F.col("of").alias("tree"), "more_sides", "more_digests", "root"))
    up = join_small(above.withColumnRenamed("rank", "block"), langs, "tree").select(
        "tree", "block", F.concat("sides", "more_sides").alias("sides"), F.concat("digests", "more_digests").alias("digests"),
        F.col("top").alias("subroot"), "root")

    def finish(key, low, up):
        low, n = _sorted(low), low.num_rows
        b = Block(_hex(low.column("leaf")), key[1].as_py() == 0, levels)
        more_sides, more_digests, subroot, root = (up.column(c)[0].as_py() for c in ("sides", "digests", "subroot", "root"))
        rest = _unpack(more_sides, more_digests)
        sides, digests, folded, copies = [], [], [], []
        for i, (leaf, changed) in enumerate(zip(b.levels[0], low.column("changed").to_pylist())):
            near = b.siblings(i)
            version = copy_path(leaf if changed is None else hexlify(changed), near + rest)
            s, d = _pack(near)
            sides.append(s + more_sides)
            digests.append(d + more_digests)
            folded.append(unhexlify(version[-1]))
            copies.append(None if changed is None else [unhexlify(c) for c in version])
        return pa.table({**{c: low.column(c) for c in ("lang", "doc_id", "rank", "leaf", "changed")},
                         "subroot": pa.array([subroot] * n, pa.binary()), "root": pa.array([root] * n, pa.binary()),
                         "sides": pa.array([s.decode() for s in sides], pa.string()), "digests": pa.array(digests, pa.binary()),
                         "folded": pa.array(folded, pa.binary()), "copies": pa.array(copies, pa.list_(pa.binary()))})

    return blocked.groupBy("tree", "block").cogroup(up.groupBy("tree", "block")).applyInArrow(
        finish, "lang string, doc_id long, rank long, leaf binary, changed binary, subroot binary, root binary, "
                "sides string, digests binary, folded binary, copies array<binary>")


def proofs(manifest: DataFrame) -> DataFrame:
    """The contract's columns."""
    def text(c: str) -> Column:
        return F.lower(F.hex(c))
    return manifest.select(
        "doc_id", text("leaf").alias("leaf"), text("subroot").alias("subroot"), text("root").alias("root"),
        F.sha2(text("digests").cast("binary"), 256).alias("proof_sha256"), text("folded").alias("folded_root"),
        (F.col("folded") == F.col("root")).alias("verified"))


def crc_sql(text: str) -> str:
    """crc32 of a short ASCII text in DuckDB SQL, bit by bit."""
    bits = (f"flatten(list_transform(range(1, strlen({text}) + 1), lambda i: list_concat([CAST(ascii(substr({text}, i, 1)) AS BIGINT)], "
            f"list_transform(range(8), lambda j: CAST(256 AS BIGINT)))))")
    step = "CASE WHEN x < 256 THEN xor(c, x) ELSE xor(c >> 1, (c & 1) * 3988292384) END"
    return f"xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], {bits}), lambda c, x: {step}), 4294967295)"


def _f(column: str) -> str:
    t = f"CAST({column} AS VARCHAR)"
    return f"(CASE WHEN {column} IS NULL THEN '-' ELSE strlen({t}) || ':' || {t} END)"


def _leaf_sql(n_chars: str) -> str:
    return "sha256(" + " || ".join(_f(c) for c in ("doc_id", "source", "lang", n_chars, "text")) + ")"


#: The same manifest in DuckDB SQL, level by level.
ORACLE = f"""
WITH RECURSIVE l AS (SELECT row_number() OVER () AS n, doc_id, lang, {_leaf_sql('n_chars')} AS leaf,
    CASE WHEN {crc_sql('CAST(doc_id AS VARCHAR)')} % {TAMPER} = 0 THEN {_leaf_sql('(CAST(n_chars AS HUGEINT) + 1)')} END AS changed
    FROM documents),
p AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf, n) - 1 AS i,
    count(*) OVER (PARTITION BY lang) AS size FROM l),
v(lang, level, i, h, size) AS (SELECT lang, 0, i, leaf, size FROM p
    UNION ALL SELECT lang, level + 1, i // 2, sha256(string_agg(h, '' ORDER BY i)), any_value((size + 1) // 2)
    FROM v WHERE size > 1 GROUP BY lang, level, i // 2),
s AS (SELECT lang, h, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i, count(*) OVER () AS size FROM v WHERE size = 1),
t(level, i, h, size) AS (SELECT 0, i, h, size FROM s
    UNION ALL SELECT level + 1, i // 2, sha256(string_agg(h, '' ORDER BY i)), any_value((size + 1) // 2)
    FROM t WHERE size > 1 GROUP BY level, i // 2),
-- all siblings of a leaf, bottom to top
x AS (SELECT p.n, v.level, v.h, v.i < (p.i >> v.level) AS is_left FROM p JOIN v ON v.lang IS NOT DISTINCT FROM p.lang AND v.size > 1
        AND v.i = xor(p.i >> v.level, 1)
    UNION ALL SELECT p.n, 1000 + t.level, t.h, t.i < (s.i >> t.level) FROM p JOIN s ON s.lang IS NOT DISTINCT FROM p.lang
        JOIN t ON t.size > 1 AND t.i = xor(s.i >> t.level, 1)),
-- the levels a leaf climbs, with or without a sibling
c AS (SELECT p.n, v.level FROM p JOIN (SELECT DISTINCT lang, level FROM v WHERE size > 1) v ON v.lang IS NOT DISTINCT FROM p.lang
    UNION ALL SELECT p.n, 1000 + t.level FROM p, (SELECT DISTINCT level FROM t WHERE size > 1) t),
w AS (SELECT c.n, row_number() OVER (PARTITION BY c.n ORDER BY c.level) AS step, x.h, x.is_left
    FROM c LEFT JOIN x ON x.n = c.n AND x.level = c.level),
f(n, step, cur) AS (SELECT n, 0, coalesce(changed, leaf) FROM p
    UNION ALL SELECT f.n, w.step, sha256(CASE WHEN w.h IS NULL THEN f.cur WHEN w.is_left THEN w.h || f.cur ELSE f.cur || w.h END)
    FROM f JOIN w ON w.n = f.n AND w.step = f.step + 1),
g AS (SELECT n, arg_max(cur, step) AS folded FROM f GROUP BY n),
y AS (SELECT n, sha256(coalesce(string_agg(h, '' ORDER BY level), '')) AS proof FROM (SELECT p.n, x.level, x.h FROM p LEFT JOIN x ON x.n = p.n) GROUP BY n),
r AS (SELECT h AS root FROM t WHERE size = 1)
SELECT p.doc_id, p.leaf, s.h AS subroot, r.root, y.proof AS proof_sha256, g.folded AS folded_root, g.folded = r.root AS verified
FROM p JOIN s ON s.lang IS NOT DISTINCT FROM p.lang JOIN y ON y.n = p.n JOIN g ON g.n = p.n, r
"""
