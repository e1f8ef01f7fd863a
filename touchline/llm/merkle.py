"""Merkle manifest of a table: leaves per group, subtrees per block, upper levels by butterfly exchange.

``H`` is the lowercase hex SHA-256 of its inputs concatenated, digests taken as
hex text. In each group (a source) the leaves ascend by their order; while more
than one node remains, every ``FANOUT`` consecutive nodes (the last run may be
shorter, even one) become their ``H``. The last node is the group's subroot;
subroots in group order form the leaves of the top tree, whose last node is the
root. A proof holds, level by level from a leaf to the root, the siblings of the
leaf's node: the others of its run, those left of it and those right of it.

Plan. Leaves get a dense rank inside their group from one range sort. A block
is ``FANOUT ** BLOCK_HEIGHT`` consecutive ranks, aligned, so its leaves form a
whole subtree; one task hashes it (a bounded group, however large a source is).
Above the blocks, aligned groups of ``FANOUT`` blocks swap their subtree roots
round by round: every block hashes its ancestor itself, redundantly, and keeps
its siblings of that level, so each block holds its upper proof without a
downward pass. Each round is a small join over one row per block, written to
the shared folder. The subroots then go through the same steps as one group.
"""

from __future__ import annotations

import hashlib
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.llm.common import POSITION, part_of, positioned, row_in_part
from touchline.sources.scratch import staged

# Values fixed by the contract of the query.
FANOUT = 3
TAMPER_EVERY = 2
#: A block holds FANOUT ** BLOCK_HEIGHT leaves (729): the most one task hashes at once.
BLOCK_HEIGHT = 6
#: Copies of a source's top-tree row, so that the blocks of a hot source meet them in as many tasks.
SALT = 64

_LEFTS, _RIGHTS, _ROOT = "__llm_lefts", "__llm_rights", "__llm_root"
_RANK, _SIZE, _BLOCK, _DIGEST = "__llm_rank", "__llm_size", "__llm_block", "__llm_digest"


def digest_of(*parts: Column) -> Column:
    """``H`` of the parts, all strings."""
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """``-`` for null, else UTF-8 byte count, ``:`` and the value (integers in decimal)."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_of(*values: Column) -> Column:
    return digest_of(*map(field, values))


def height(size: int) -> int:
    """Levels above the leaves of a tree over ``size`` leaves: none for one leaf."""
    levels, reach = 0, 1
    while reach < size:
        levels, reach = levels + 1, reach * FANOUT
    return levels


def _ranked(items: DataFrame, group: str, order: list[Column]) -> DataFrame:
    """Items with their dense rank in the group (from 0) and the group's size, from one range sort."""
    placed = positioned(items, F.col(group).asc_nulls_first(), *order)
    part, row = part_of(F.col(POSITION)), row_in_part(F.col(POSITION))
    # One row per (range, group): at most the ranges plus the groups, however hot a group is.
    spans = placed.groupBy(part.alias("__llm_part"), F.col(group).alias("__llm_group")).agg(
        F.min(row).alias("__llm_first"), F.count(F.lit(1)).alias("__llm_count")
    )
    earlier = Window.partitionBy("__llm_group").orderBy("__llm_part").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.withColumn("__llm_before", F.coalesce(F.sum("__llm_count").over(earlier), F.lit(0))).withColumn(
        _SIZE, F.sum("__llm_count").over(Window.partitionBy("__llm_group"))
    )
    joined = placed.join(spans, (part == F.col("__llm_part")) & F.col(group).eqNullSafe(F.col("__llm_group")))
    rank = F.col("__llm_before") + row - F.col("__llm_first")
    return joined.select(*items.columns, rank.alias(_RANK), F.col(_SIZE))


def _block_trees(ranked: DataFrame, group: str, keep: list[str], block_height: int) -> DataFrame:
    """Hash each block's subtree in one task; every item gets its siblings inside the block."""
    span = FANOUT**block_height
    rows = ranked.select(F.col(group), *keep, F.col(_DIGEST), F.col(_RANK), F.col(_SIZE), F.floor(F.col(_RANK) / span).alias(_BLOCK))
    out = rows.select(
        F.col(group), *keep, F.col(_BLOCK), F.col(_SIZE),
        F.array().cast("array<string>").alias(_LEFTS), F.array().cast("array<string>").alias(_RIGHTS), F.lit("").alias(_ROOT),
    )

    def subtree(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(_RANK, kind="stable")
        first = int(frame[_RANK].iloc[0])
        levels = min(block_height, height(int(frame[_SIZE].iloc[0])))
        nodes = frame[_DIGEST].tolist()
        at = [int(r) - first for r in frame[_RANK]]
        lefts: list[list[str]] = [[] for _ in at]
        rights: list[list[str]] = [[] for _ in at]
        for _ in range(levels):
            runs = [nodes[i : i + FANOUT] for i in range(0, len(nodes), FANOUT)]
            for k, node in enumerate(at):
                run, place = runs[node // FANOUT], node % FANOUT
                lefts[k].append("".join(run[:place]))
                rights[k].append("".join(run[place + 1 :]))
            nodes = [hashlib.sha256("".join(run).encode()).hexdigest() for run in runs]
            at = [node // FANOUT for node in at]
        result = frame.drop(columns=[_DIGEST, _RANK])
        return result.assign(**{_LEFTS: lefts, _RIGHTS: rights, _ROOT: nodes[0]})

    return rows.groupBy(group, _BLOCK).applyInPandas(subtree, out.schema)


def _exchange(blocks: DataFrame, group: str, rounds: int, block_height: int) -> DataFrame:
    """Butterfly rounds over one row per block: aligned groups of FANOUT nodes swap roots and hash their parent."""
    for r in range(rounds):
        level = block_height + r
        node = F.floor(F.col(_BLOCK) / FANOUT**r)
        active = F.col(_SIZE) > FANOUT**level
        # The block at the start of a node's span speaks for it; the others hold the same digest.
        speakers = blocks.where(active & (F.col(_BLOCK) % FANOUT**r == 0)).select(
            F.col(group).alias("__llm_g"), F.floor(node / FANOUT).alias("__llm_run"), F.struct(node.alias("at"), F.col(_ROOT).alias("digest")).alias("__llm_node")
        )
        runs = speakers.groupBy("__llm_g", "__llm_run").agg(F.sort_array(F.collect_list("__llm_node")).alias("__llm_members"))
        here = blocks.where(active)
        joined = here.join(runs, F.col(group).eqNullSafe(F.col("__llm_g")) & (F.floor(node / FANOUT) == F.col("__llm_run")))
        members = F.col("__llm_members")
        side = lambda keep: F.array_join(F.transform(F.filter(members, keep), lambda m: m["digest"]), "")
        moved = joined.select(
            *[F.col(c) for c in blocks.columns if c not in (_LEFTS, _RIGHTS, _ROOT)],
            F.concat(F.col(_LEFTS), F.array(side(lambda m: m["at"] < node))).alias(_LEFTS),
            F.concat(F.col(_RIGHTS), F.array(side(lambda m: m["at"] > node))).alias(_RIGHTS),
            digest_of(F.array_join(F.transform(members, lambda m: m["digest"]), "")).alias(_ROOT),
        )
        blocks = staged(moved.unionByName(blocks.where(~active)), "merkle-round")
    return blocks


def tree_levels(
    items: DataFrame, group: str, order: list[Column], digest: str, keep: list[str], block_height: int = BLOCK_HEIGHT
) -> tuple[DataFrame, DataFrame]:
    """Siblings of every item inside its block, and of every block above it, up to its group's root.

    Returns (items, blocks). Items: ``keep``, ``group``, ``__llm_block`` and
    ``__llm_lefts``/``__llm_rights``, arrays of concatenated sibling digests,
    one entry per level from the leaves up. Blocks: ``group``,
    ``__llm_block``, the same arrays for the levels above the block and
    ``__llm_root``, the group's root. The order must be total up to equal items.
    """
    ranked = _ranked(items.select(group, *keep, F.col(digest).alias(_DIGEST)), group, order)
    leaves = staged(_block_trees(ranked, group, keep, block_height), "merkle-blocks")
    blocks = leaves.groupBy(group, _BLOCK).agg(
        F.first(_SIZE).alias(_SIZE), F.first(_ROOT).alias(_ROOT),
        F.array().cast("array<string>").alias(_LEFTS), F.array().cast("array<string>").alias(_RIGHTS),
    )
    largest = blocks.agg(F.max(_SIZE)).first()[0] or 0
    upper = _exchange(staged(blocks, "merkle-block-roots"), group, max(0, height(largest) - block_height), block_height)
    return leaves.drop(_ROOT, _SIZE), upper.drop(_SIZE)


def _salted_join(many: DataFrame, few: DataFrame, key: str, few_key: str) -> DataFrame:
    """``many`` joined to one row of ``few`` per key; each row of ``few`` is copied SALT times so a hot key spreads."""
    salt = F.pmod(F.xxhash64(F.col(_BLOCK)), F.lit(SALT))
    few = few.withColumn("__llm_salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    joined = many.withColumn("__llm_mine", salt).join(
        few, F.col(key).eqNullSafe(F.col(few_key)) & (F.col("__llm_mine") == F.col("__llm_salt"))
    )
    return joined.drop("__llm_mine", "__llm_salt")


def folded(start: Column, lefts: Column, rights: Column) -> Column:
    """Root recomputed from a leaf and its siblings."""
    return F.aggregate(
        F.arrays_zip(lefts.alias("l"), rights.alias("r")), start, lambda acc, s: digest_of(F.coalesce(s["l"], F.lit("")), acc, F.coalesce(s["r"], F.lit("")))
    )


def manifest(docs: DataFrame, block_height: int = BLOCK_HEIGHT) -> DataFrame:
    """Leaf, subroot, root and proof of every row of ``documents``, and whether a tampered copy still verifies.

    A leaf is ``H`` of doc_id, source, lang, n_chars and text, each ``-`` if
    null, else UTF-8 byte count, ``:`` and value. Groups are sources (null
    first, UTF-8 bytewise); inside one, leaves ascend by doc_id (null first),
    equal ids by leaf. Rows that repeat stay separate leaves. Where
    ``TAMPER_EVERY`` divides the unsigned crc32 of the decimal doc_id, the text
    loses its ``\\n`` characters (null text and null id: unchanged);
    ``folded_root`` is that leaf folded with the original siblings, and
    ``verified`` tells if it equals the root. Empty table: no rows. Extra
    columns are ignored. A lone leaf is its own subroot and, alone in the table,
    the root; its proof is ``H`` of nothing.
    """
    doc_id, source, lang, n_chars, text = (F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text"))
    tampered = F.when(F.crc32(doc_id.cast("string").cast("binary")) % TAMPER_EVERY == 0, F.regexp_replace(text, "\n", "")).otherwise(text)
    leaves = docs.select(
        doc_id.alias("doc_id"), source.alias("source"),
        leaf_of(doc_id, source, lang, n_chars, text).alias("leaf"),
        leaf_of(doc_id, source, lang, n_chars, tampered).alias("__llm_tampered"),
    )
    keep = ["doc_id", "leaf", "__llm_tampered"]
    low, blocks = tree_levels(leaves, "source", [F.col("doc_id").asc_nulls_first(), F.col("leaf")], "leaf", keep, block_height)
    subroots = blocks.where(F.col(_BLOCK) == 0).select(F.lit(0).alias("__llm_all"), "source", F.col(_ROOT).alias("subroot"))
    top, top_blocks = tree_levels(subroots, "__llm_all", [F.col("source").asc_nulls_first()], "subroot", ["source", "subroot"], block_height)
    top = top.join(top_blocks.select(F.col(_BLOCK).alias("__llm_tb"), F.col(_LEFTS).alias("__llm_tl"), F.col(_RIGHTS).alias("__llm_tr"), F.col(_ROOT).alias("root")), F.col(_BLOCK) == F.col("__llm_tb"))
    top = top.select(
        F.col("source").alias("__llm_source"), "subroot", "root",
        F.concat(_LEFTS, "__llm_tl").alias("__llm_hl"), F.concat(_RIGHTS, "__llm_tr").alias("__llm_hr"),
    )
    # Levels above each block: its own, then those of its source in the top tree. One row per block.
    above = _salted_join(blocks, top, "source", "__llm_source").select(
        F.col("source").alias("__llm_g"), F.col(_BLOCK).alias("__llm_b"), "subroot", "root",
        F.concat(_LEFTS, "__llm_hl").alias("__llm_ul"), F.concat(_RIGHTS, "__llm_hr").alias("__llm_ur"),
    )
    whole = low.join(above, F.col("source").eqNullSafe(F.col("__llm_g")) & (F.col(_BLOCK) == F.col("__llm_b")))
    lefts, rights = F.concat(_LEFTS, "__llm_ul"), F.concat(_RIGHTS, "__llm_ur")
    proof = F.array_join(F.transform(F.arrays_zip(lefts.alias("l"), rights.alias("r")), lambda s: F.concat(s["l"], s["r"])), "")
    out = whole.select(
        "doc_id", "leaf", "subroot", "root", digest_of(proof).alias("proof_sha256"),
        folded(F.col("__llm_tampered"), lefts, rights).alias("folded_root"),
    )
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
