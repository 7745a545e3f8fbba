"""A Merkle tree over a documents table, and what becomes of it under tampering.

Leaves are digests of whole rows.  Per source they stand in doc_id order, and
every run of 16 consecutive nodes becomes the digest of its concatenated hex
texts, level by level, to one subroot; the subroots, in order of their sources,
form a tree of the same kind above.

The nodes of a tree are dealt in aligned blocks of 16^3 consecutive ones.

1. Upwards: each block is built in the task that holds it; the block roots are
   the leaves of the next, 4,096 times smaller, distributed level.
2. Downwards: each block is told the path of its own root to the root of all:
   the siblings on the way, and its place among them.
3. In the leaf blocks, a tampered leaf makes a version of the block's tree: a
   persistent one, in which only the ancestors of that leaf are copied and all
   other nodes are shared.  The version goes on upwards along the block's path,
   from the copied block root to a root of its own.

Nothing but digests and positions is shuffled: the texts are read once, where
they lie.  A source of any size is any number of blocks; a task holds one block
at a time.  Positions come from a range partitioning by (source, doc_id, leaf)
and per-partition counts, never from a window over a source's rows.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ascii_lower, saved

ARITY = 16
LEVELS = 3  # of a block
BLOCK = ARITY**LEVELS
HEX = 64  # characters of a digest


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


# -------------------------------------------------------------------- leaves ---


def _field(value: Column) -> Column:
    """`-` for NULL, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaves(docs: DataFrame) -> DataFrame:
    """(doc_id, skey, leaf, tampered): the digest of every row, and that of the row
    with the letters A-Z of its text in lower case, where 5 divides the CRC-32 of
    its doc_id (NULL elsewhere).  skey orders sources as the tree does: NULL comes
    first, then bytewise."""
    columns = ["doc_id", "source", "lang", "n_chars", "text"]

    def leaf(text):
        return F.sha2(F.concat(*[_field(text if c == "text" else F.col(c)) for c in columns]), 256)

    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return docs.select(*columns).select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("skey"),
        leaf(F.col("text")).alias("leaf"),
        F.when(hit, leaf(ascii_lower(F.col("text")))).alias("tampered"),
    )


def placed(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``rows`` with ``pos``, the place of a row within its ``group`` by ``order``
    (from 0; rows equal in all of ``order`` stand next to one another), and ``n``,
    the size of its group.

    Equal rows, too, are dealt to several ranges, by a number of their own.  Sizes
    are counted per range and group, so nothing runs over the rows of a group."""
    numbered = rows.withColumn("own", F.monotonically_increasing_id())
    ranged = numbered.repartitionByRange(group, *order, "own").sortWithinPartitions(group, *order, "own").drop("own")
    ranged = saved(ranged.withColumn("at", F.monotonically_increasing_id()), "ordered")
    part = F.shiftright("at", 33).alias("part")
    sizes = ranged.groupBy(F.col(group), part).agg(F.min("at").alias("first"), F.count("*").alias("size"))
    own = Window.partitionBy(group)
    before = own.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(
        F.col(group).alias("_group"), F.col("part").alias("_part"), "first",
        F.coalesce(F.sum("size").over(before), F.lit(0)).alias("before"), F.sum("size").over(own).alias("n"),
    )
    met = ranged.join(sizes, (ranged[group] == sizes["_group"]) & (F.shiftright("at", 33) == sizes["_part"]))
    return met.select(*rows.columns, (F.col("at") - F.col("first") + F.col("before")).alias("pos"), "n")


# --------------------------------------------------------------------- trees ---


class Block:
    """The tree of one block: ``levels`` from its leaves to its root."""

    def __init__(self, nodes: list[str], height: int):
        self.levels = [nodes]
        for _ in range(height):
            below = self.levels[-1]
            self.levels.append([digest("".join(below[i : i + ARITY])) for i in range(0, len(below), ARITY)])

    def path(self, i: int):
        """Per level below the root: (siblings before, siblings after) of the node over leaf ``i``."""
        for nodes in self.levels[:-1]:
            run = i - i % ARITY
            yield "".join(nodes[run:i]), "".join(nodes[i + 1 : run + ARITY])
            i //= ARITY

    def version(self, i: int, leaf: str) -> dict[tuple[int, int], str]:
        """The copied nodes {(level, index): digest} of the tree in which leaf ``i``
        is ``leaf``; all others are shared with this one."""
        copied = {(0, i): leaf}
        for level, nodes in enumerate(self.levels[:-1]):
            run = i - i % ARITY
            children = [copied.get((level, j), node) for j, node in enumerate(nodes[run : run + ARITY], run)]
            i //= ARITY
            copied[level + 1, i] = digest("".join(children))
        return copied

    @property
    def root(self) -> str:
        return self.levels[-1][0]


def height(n: int) -> int:
    """Levels a block of a tree over ``n`` nodes has."""
    levels = 0
    while n > 1 and levels < LEVELS:
        n, levels = -(-n // ARITY), levels + 1
    return levels


def fold(node: str, path) -> str:
    """The end of a path of (siblings before, siblings after) that starts at ``node``."""
    for before, after in path:
        node = digest(before + node + after)
    return node


# One stream serves all passes: the nodes of a block in order, its head (pos -1:
# the path above the block) before them.
_PATH = "path array<struct<before:string,after:string>>, subroot string, root string"
_NODES = "g string, pos long, n long, node string"


def _in_blocks(nodes: DataFrame, heads: DataFrame | None = None) -> DataFrame:
    rows = nodes.withColumn("block", F.expr(f"pos div {BLOCK}"))
    if heads is not None:
        above = heads.select("g", F.col("pos").alias("block"), F.lit(-1).cast("long").alias("pos"), "path", "subroot", "root")
        rows = rows.unionByName(above, allowMissingColumns=True)
    return rows.repartition("g", "block").sortWithinPartitions("g", "block", "pos")


def _blocks(batches):
    """(head row or None, node rows) of each block of a sorted stream."""
    key, head, rows = None, None, []
    for b in batches:
        for row in b.to_pylist():
            if (row["g"], row["block"]) != key:
                if rows:
                    yield head, rows
                key, head, rows = (row["g"], row["block"]), None, []
            if row["pos"] < 0:
                head = row
            else:
                rows.append(row)
    if rows:
        yield head, rows


def _batch(rows, schema):
    import pyarrow as pa

    return pa.RecordBatch.from_pylist(rows, schema=schema)


def _node_schema():
    import pyarrow as pa

    return pa.schema([("g", pa.string()), ("pos", pa.int64()), ("n", pa.int64()), ("node", pa.string())])


def _path_schema():
    import pyarrow as pa

    step = pa.struct([("before", pa.string()), ("after", pa.string())])
    text = pa.string()
    return pa.schema([("g", text), ("pos", pa.int64()), ("path", pa.list_(step)), ("subroot", text), ("root", text)])


def _up(batches):
    """Nodes -> block roots, which are the nodes of the next level."""
    schema, out = _node_schema(), []
    for _, rows in _blocks(batches):
        n = rows[0]["n"]
        root = Block([r["node"] for r in rows], height(n)).root
        out.append({"g": rows[0]["g"], "pos": rows[0]["block"], "n": -(-n // BLOCK), "node": root})
        if len(out) == 1024:
            yield _batch(out, schema)
            out = []
    if out:
        yield _batch(out, schema)


def _down(batches):
    """Nodes and the paths of their blocks -> the paths of the nodes."""
    schema = _path_schema()
    for head, rows in _blocks(batches):
        block = Block([r["node"] for r in rows], height(rows[0]["n"]))
        above = head["path"] or []
        for at in range(0, len(rows), 256):
            yield _batch(
                [
                    {
                        "g": r["g"],
                        "pos": r["pos"],
                        "path": [{"before": x, "after": y} for x, y in block.path(i)] + above,
                        "subroot": head["subroot"],
                        "root": head["root"],
                    }
                    for i, r in enumerate(rows[at : at + 256], at)
                ],
                schema,
            )


_RESULT = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def _verify(batches):
    """Leaves and the paths of their blocks -> proofs and the roots of all versions."""
    import pyarrow as pa

    text = pa.string()
    schema = pa.schema(
        [("doc_id", pa.int64()), ("leaf", text), ("subroot", text), ("root", text), ("proof_sha256", text),
         ("folded_root", text), ("verified", pa.bool_())]
    )
    for head, rows in _blocks(batches):
        block = Block([r["node"] for r in rows], height(rows[0]["n"]))
        above = [(p["before"], p["after"]) for p in head["path"]]
        siblings_above = "".join(x + y for x, y in above)
        top = len(block.levels) - 1
        out = []
        for i, r in enumerate(rows):
            proof = "".join(x + y for x, y in block.path(i)) + siblings_above
            version = block.version(i, r["tampered"] or r["node"])
            folded = fold(version[top, 0], above)
            out.append(
                {
                    "doc_id": r["doc_id"],
                    "leaf": r["node"],
                    "subroot": head["subroot"],
                    "root": head["root"],
                    "proof_sha256": digest(proof),
                    "folded_root": folded,
                    "verified": folded == head["root"],
                }
            )
        yield _batch(out, schema)


def _grown(nodes: DataFrame, name: str) -> list[DataFrame]:
    """The node tables of all distributed levels, the last with one root per group."""
    levels = [nodes]
    while True:
        levels.append(saved(_in_blocks(levels[-1]).mapInArrow(_up, _NODES), name))
        if (levels[-1].agg(F.max("n")).first()[0] or 1) <= 1:  # one number
            return levels


class Manifest:
    """The tree over ``docs``: ``leaves`` (g, pos, n, node, doc_id, tampered),
    ``subroots`` (g, node) and the one-row ``root`` (node); g is the source behind
    an equals sign, empty for NULL.

    A row is a leaf of its own however often it repeats; rows of equal doc_id stand
    in the order of their digests, rows without one come first and are never
    tampered with.  Texts may be NULL, empty or of any length.  An empty table has
    no root.  Columns beyond doc_id, source, lang, n_chars and text are ignored.
    """

    def __init__(self, docs: DataFrame):
        rows = saved(leaves(docs), "leaves")
        at = placed(rows.withColumnRenamed("skey", "g"), "g", ["doc_id", "leaf"])
        self.leaves = at.select("g", "pos", "n", F.col("leaf").alias("node"), "doc_id", "tampered")
        self._tree = _grown(self.leaves.select("g", "pos", "n", "node"), "nodes")
        self.subroots = self._tree[-1].select("g", "node")
        own = placed(self.subroots.select(F.lit("all").alias("all"), "g", "node"), "all", ["g"])
        self._names = own.select(F.col("g").alias("skey"), "pos", "node")
        self._top = _grown(own.select(F.col("all").alias("g"), "pos", "n", "node"), "source-nodes")
        self.root = self._top[-1].select("node")

    def paths(self) -> DataFrame:
        """(g, pos, path, subroot, root) of every block of leaves."""
        heads = self._top[-1].selectExpr(
            "g", "pos", "cast(array() as array<struct<before:string,after:string>>) AS path", "cast(null as string) AS subroot", "node AS root"
        )
        for nodes in reversed(self._top[:-1]):
            heads = saved(_in_blocks(nodes, heads).mapInArrow(_down, _PATHS), "paths")
        named = heads.join(self._names, "pos").select(F.col("skey").alias("g"), F.lit(0).cast("long").alias("pos"), "path", F.col("node").alias("subroot"), "root")
        for nodes in reversed(self._tree[1:-1]):
            named = saved(_in_blocks(nodes, named).mapInArrow(_down, _PATHS), "paths")
        return named

    def verify(self) -> DataFrame:
        """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) per row:
        the proof of its original leaf, and the root its tampered version leads to."""
        return _in_blocks(self.leaves, self.paths()).mapInArrow(_verify, _RESULT)


_PATHS = f"g string, pos long, {_PATH}"
