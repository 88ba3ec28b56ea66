"""Merkle manifest of a dataset: one tree a partition (here: a language), and one tree over the partitions' roots.

A leaf is the hash of a row's columns; a node is the hash of its two children's digests, of one child's where the last
run has only one. Trees are written as a postorder append log: row (tree, pos, digest) in the order in which nodes are
completed, so that what is appended to a tree never moves a node of a finished run. Builders work side by side on
aligned runs of 2 ** RUN_BITS nodes of one level; their run roots are the nodes of the next round of builders, until one
node is left. A node's place in the log needs no look-up: from (level, number) and the tree's leaves it follows in closed
form (``postorder``: twice the leaves before it less the ones in their binary number, plus its subtree's size). A proof
is the list of siblings on the way up, and their places in the log are known the same way (``sibling_places``).

The proofs of all rows go back down in the same runs: a builder gets the siblings above its run's root as one row, reads
the siblings below from its own piece of the log, and so gives each row its whole path. So a round moves its nodes once,
and a row's path is made where it is used.

Rows are put in order by a range sort and numbered by counts per (tree, sorted piece); a task holds one run of one tree at
a time, whatever a tree's share of the rows. Every round is written to the shared folder.

Defined cases: a null in any column hashes as ``-`` (a null tree is a tree of its own and comes first); empty text is
``0:``; rows with the same id (or null ids, which come first) ascend by their leaf, so the root does not depend on the
order of the input; repeated rows are leaves each; an empty table has no root (null) and no proofs; extra columns are
ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from semjoin.llm.common import join_counted, stage

#: An aligned run of a builder holds 2 ** RUN_BITS nodes of a level.
RUN_BITS = 10
#: The tree over the other trees' roots. Names of these are empty (null) or start with "=".
TOP = "*"


def h(*parts: str) -> str:
    """Lower-case hex SHA-256 of the parts put together."""
    return hashlib.sha256("".join(parts).encode()).hexdigest()


# --------------------------------------------------------------------------- places in the log

def _size(level: int, leaves: int) -> int:
    """Nodes of a subtree of ``level`` over so many leaves (at most 2 ** level)."""
    if leaves == 1 << level:
        return 2 * leaves - 1
    return sum(-(-leaves // (1 << k)) for k in range(level + 1))


def postorder(level: int, number: int, leaves: int) -> int:
    """The place of node ``number`` of ``level`` in the postorder of a tree with so many leaves."""
    before = number << level
    return 2 * before - before.bit_count() + _size(level, min(1 << level, leaves - before)) - 1


def height(leaves: int) -> int:
    return max(0, leaves - 1).bit_length()


def sibling_places(index: int, leaves: int) -> list[int]:
    """The places in the log of the siblings on the way from leaf ``index`` to the root, from below; a node without one has none."""
    up = [(level, (index >> level) ^ 1) for level in range(height(leaves))]
    return [postorder(level, other, leaves) for level, other in up if other << level < leaves]


def fold(digest: str, index: int, leaves: int, siblings: list[str]) -> str:
    """The root that a leaf and its siblings (in the order of ``sibling_places``) give."""
    left = iter(siblings)
    for level in range(height(leaves)):
        number = index >> level
        if (number ^ 1) << level < leaves:
            digest = h(next(left), digest) if number & 1 else h(digest, next(left))
        else:
            digest = h(digest)
    return digest


# --------------------------------------------------------------------------- leaves

def field(c: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, ``:`` and the value."""
    text = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*columns: Column) -> Column:
    """The hash of a row's columns."""
    return F.sha2(F.concat(*[field(c) for c in columns]), 256)


def tree_name(partition: Column) -> Column:
    """A name without null that sorts as the partitions do: null first, then by bytes."""
    return F.coalesce(F.concat(F.lit("="), partition.cast("string")), F.lit(""))


def _numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` (staged) plus ``number``, 0, 1, ... along ``order`` in their ``tree``, and ``leaves``, the tree's rows.

    ``order`` must be unique in a tree. A range sort cuts the rows into pieces, a task numbers each tree's rows within
    its piece, and the counts of the (tree, piece) pairs give the rest.
    """
    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece, last, seen = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            tree = batch.column("tree").to_numpy(zero_copy_only=False)
            starts = np.flatnonzero(np.concatenate([[True], tree[1:] != tree[:-1]]))
            ends = np.append(starts[1:], n)
            at = np.arange(n) - np.repeat(starts, ends - starts)
            if tree[0] == last:
                at[:ends[0]] += seen
            last, seen = tree[-1], int(at[-1]) + 1
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(n, piece)), pa.array(at)], [*batch.schema.names, "piece", "at"])

    schema = ", ".join(f"{name} {kind}" for name, kind in rows.dtypes) + ", piece long, at long"
    in_order = rows.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
    cut = stage(in_order.mapInArrow(number, schema), "merkle_order")
    pieces = cut.groupBy("tree", "piece").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("tree").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stage(pieces.withColumn("off", F.coalesce(F.sum("n").over(before), F.lit(0)))
                    .withColumn("leaves", F.sum("n").over(Window.partitionBy("tree"))), "merkle_pieces")
    out = join_counted(cut, offsets, ["tree", "piece"], "n", cut.count())
    return out.withColumn("number", F.col("off") + F.col("at")).drop("piece", "at", "off", "n")


# --------------------------------------------------------------------------- builders

_NODE = "tree string, leaves long, level int, number long, pos long, digest string"


def _run_levels(digests: list[str], rounds: int) -> list[list[str]]:
    """The nodes of an aligned run, level by level: its own, and those that so many rounds put above them."""
    levels = [digests]
    for _ in range(rounds):
        now = levels[-1]
        levels.append([h(*now[i:i + 2]) for i in range(0, len(now), 2)])
    return levels


def _rounds(base: int, leaves: int, bits: int) -> int:
    """Levels that a builder puts above level ``base``: ``bits``, or what is left up to the root."""
    return min(bits, height(leaves) - base)


def _build(nodes: DataFrame, base: int, bits: int) -> DataFrame:
    """The nodes above ``nodes`` of level ``base`` that one round of builders makes, each builder's in order of completion."""
    def build(run: pd.DataFrame) -> pd.DataFrame:
        run = run.sort_values("number")
        leaves, first = int(run["leaves"].iat[0]), int(run["number"].iat[0])
        levels = _run_levels(run["digest"].tolist(), _rounds(base, leaves, bits))
        made = [(base + up, (first >> up) + i, d) for up, level in enumerate(levels) if up for i, d in enumerate(level)]
        out = pd.DataFrame(made, columns=["level", "number", "digest"])
        out["pos"] = [postorder(v, j, leaves) for v, j in zip(out["level"], out["number"])]
        out["tree"], out["leaves"] = run["tree"].iat[0], leaves
        return out.sort_values("pos")[["tree", "leaves", "level", "number", "pos", "digest"]]

    return nodes.groupBy("tree", F.expr(f"shiftright(number, {bits})")).applyInPandas(build, _NODE)


def _run_siblings(run: pd.DataFrame, base: int, bits: int) -> list[list[str]]:
    """For each node of an aligned run (sorted by number) its siblings within the run, from below.

    The run's piece of the log is one stretch, counted in nodes of level ``base``: it begins where the leaves before the
    run have been completed, and each sibling stands at its postorder place less that.
    """
    first, leaves = int(run["number"].iat[0]), int(run["leaves"].iat[0])
    width, rounds = -(-leaves // (1 << base)), _rounds(base, leaves, bits)
    begin = 2 * first - first.bit_count()
    piece = [""] * _size(rounds, len(run))
    for up, level in enumerate(_run_levels(run["digest"].tolist(), rounds)):
        for i, d in enumerate(level):
            piece[postorder(up, (first >> up) + i, width) - begin] = d
    # the siblings above a pair are the same for both: each level's lists from the one above it
    rest: list[list[str]] = [[]]
    for up in range(rounds - 1, -1, -1):
        own = []
        for number in range(first >> up, (first >> up) + -(-len(run) // (1 << up))):
            other = number ^ 1
            beside = [piece[postorder(up, other, width) - begin]] if other << up < width else []
            own.append(beside + rest[(number >> 1) - (first >> up + 1)])
        rest = own
    return rest


def _extract(base: int, bits: int, finish):
    """Co-group function: ``finish`` for a run of nodes of level ``base``, given the row of what is above it."""
    def extract(run: pd.DataFrame, up: pd.DataFrame) -> pd.DataFrame:
        run = run.sort_values("number").reset_index(drop=True)
        return finish(run, _run_siblings(run, base, bits), up["path"].iat[0], up["above"].iat[0])
    return extract


def _hand_down(run: pd.DataFrame, siblings: list[list[str]], rest: str, above: str) -> pd.DataFrame:
    """For each node of the run, which is the root of a run below, the siblings above that."""
    return pd.DataFrame({"tree": run["tree"], "run": run["number"], "above": above, "path": ["".join(s) + rest for s in siblings]})


class Manifest:
    """The manifest of ``docs``: a tree for each value of ``tree_col`` over rows ascending by ``id_col``, and the tree over these.

    ``columns`` are what a leaf hashes, in turn. ``claimed`` may give the columns of what someone claims to hold instead,
    which ``proofs`` then checks. Builders take runs of 2 ** ``bits`` nodes. ``log`` and ``top`` hold the tables of the rounds, ``root`` the digest of all (or None).
    """

    def __init__(self, docs: DataFrame, columns: list[Column], tree_col: str, id_col: str, claimed: list[Column] | None = None,
                 bits: int = RUN_BITS):
        self.bits = bits
        own = leaf(*columns)
        rows = docs.select(tree_name(F.col(tree_col)).alias("tree"), F.col(id_col).cast("long").alias("id"), own.alias("digest"),
                           (leaf(*claimed) if claimed else own).alias("claimed"), F.monotonically_increasing_id().alias("rid"))
        self.log = self._trees(stage(rows, "merkle_leaves"), ["id", "digest", "rid"])
        names = self._ends(self.log).select(F.lit(TOP).alias("tree"), F.col("tree").alias("name"), "digest", F.col("leaves").alias("of"))
        self.top = self._trees(stage(names, "merkle_subroots"), ["name"])
        end = self._ends(self.top).first()
        self.root = end.digest if end else None

    def _trees(self, rows: DataFrame, order: list[str]) -> list[DataFrame]:
        """The rounds of the trees over ``rows``: the first table holds the leaves with all their columns, the others what a round made."""
        place = F.expr("2 * number - bit_count(number)")
        log = [stage(_numbered(rows, order).withColumn("level", F.lit(0)).withColumn("pos", place), "merkle_log")]
        base = 0
        while True:
            more = log[-1].filter((F.col("level") == base) & F.expr(f"leaves > shiftleft(1L, {base})"))
            if more.isEmpty():
                return log
            log.append(stage(_build(more.select("tree", "leaves", "number", "digest"), base, self.bits), "merkle_log"))
            base += self.bits

    @staticmethod
    def _ends(log: list[DataFrame]) -> DataFrame:
        """(tree, leaves, digest) of the roots: the last entry of each tree's log."""
        is_root = F.expr("number = 0 AND leaves <= shiftleft(1L, level) AND (level = 0 OR leaves > shiftleft(1L, level - 1))")
        found = [part.filter(is_root).select("tree", "leaves", "digest") for part in log]
        out = found[0]
        for part in found[1:]:
            out = out.unionByName(part)
        return out

    def append_log(self) -> DataFrame:
        """(tree, pos, digest) of every node; ordered by (tree, pos) it is the order in which nodes were completed."""
        out = None
        for part in [*self.log, *self.top]:
            part = part.select("tree", "pos", "digest")
            out = part if out is None else out.unionByName(part)
        return out

    def _descend(self, log: list[DataFrame], lead: DataFrame, finish, schema: str) -> DataFrame:
        """``finish`` for each run of leaves, given its rows, their siblings within the run, and the ``lead`` row above the run.

        ``lead`` has a row a tree: tree, turn (the last round that the tree takes part in), above (what the caller wants
        to know of it) and path (siblings above the run, as one text).
        """
        carried = "tree string, run long, above string, path string"
        down: DataFrame | None = None
        for turn in range(len(log) - 1, -1, -1):
            base = turn * self.bits
            nodes = log[turn].filter(F.col("level") == base).withColumn("run", F.expr(f"shiftright(number, {self.bits})"))
            enter = lead.filter(F.col("turn") == turn).select("tree", F.lit(0).cast("long").alias("run"), "above", "path")
            down = enter if down is None else down.unionByName(enter)

            met = nodes.groupBy("tree", "run").cogroup(down.groupBy("tree", "run"))
            if turn == 0:
                return met.applyInPandas(_extract(0, self.bits, finish), schema)
            down = stage(met.applyInPandas(_extract(base, self.bits, _hand_down), carried), "merkle_paths")

    def proofs(self) -> DataFrame:
        """For each row: doc_id, leaf, subroot, root, proof_sha256, folded_root (from the claimed leaf), verified."""
        turn = F.expr(f"length(bin(leaves - 1)) * int(leaves > 1) div {self.bits}")
        top_lead = self._ends(self.top).select("tree", turn.alias("turn"), F.lit("").alias("above"), F.lit("").alias("path"))

        def names(run: pd.DataFrame, siblings: list[list[str]], rest: str, _: str) -> pd.DataFrame:
            above = [f"{j} {n} {d}" for j, n, d in zip(run["number"], run["leaves"], run["digest"])]
            return pd.DataFrame({"tree": run["name"], "leaves": run["of"], "above": above, "path": ["".join(s) + rest for s in siblings]})

        lead = stage(self._descend(self.top, top_lead, names, "tree string, leaves long, above string, path string"), "merkle_leads")
        root = self.root

        def check(run: pd.DataFrame, siblings: list[list[str]], rest: str, above: str) -> pd.DataFrame:
            place, trees, subroot = above.split(" ")
            place, trees, leaves = int(place), int(trees), int(run["leaves"].iat[0])
            shared, out = [rest[i:i + 64] for i in range(0, len(rest), 64)], []
            for number, claimed, own in zip(run["number"], run["claimed"], siblings):
                path = own + shared
                inside = len(sibling_places(number, leaves))
                folded = fold(fold(claimed, number, leaves, path[:inside]), place, trees, path[inside:])
                out.append((h(*path), folded, folded == root))
            got = pd.DataFrame(out, columns=["proof_sha256", "folded_root", "verified"])
            got["doc_id"], got["leaf"], got["subroot"], got["root"] = run["doc_id"], run["digest"], subroot, root
            return got[["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]]

        schema = "doc_id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
        # ids travel as text: pandas would round a long beside a null
        leaves = self.log[0].withColumn("doc_id", F.col("id").cast("string")).drop("id", "rid")
        found = self._descend([leaves, *self.log[1:]], lead.withColumn("turn", turn), check, schema)
        return found.withColumn("doc_id", F.col("doc_id").cast("long"))
