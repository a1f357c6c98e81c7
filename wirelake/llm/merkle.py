"""A Merkle manifest of a dataset, with a membership proof for every row.

Rows of a source, in order, are the leaves of its tree; every ``FAN`` consecutive nodes become
one. The roots of the sources are the leaves of the dataset's tree in the same way. Trees are cut
into superblocks of ``FAN ** LEVELS`` consecutive nodes. Upwards, each superblock is reduced on
its own and leaves one node; rounds go on until each tree is one node, so a large source is many
tasks. Downwards, the nodes of a round meet the outer nodes that their superblock needs (what
stands beside its path to the root) in a cogroup, which repeats the local reduction, puts local
and outer siblings together and folds.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wirelake.llm import common, places

FAN, LEVELS = 16, 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_DIGITS = 64  # hex digits of a digest
_NODES = "tree bigint, pos bigint, n bigint, hash string"
_OUTER = "tree bigint, pos bigint, subroot string, root string, proof array<string>, places array<int>"


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_hash(values: Mapping[str, Column]) -> Column:
    """The hash of a row: each value as its UTF-8 length, a colon and itself; null is a dash."""
    parts = []
    for value in values.values():
        text = value.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


# A tree is reduced level by level; a level keeps, for each run of siblings, their digests in a row.


def reduced(hashes: list[str], n: int, fan: int, levels: int) -> tuple[list[list[str]], str]:
    """The levels of one superblock of a tree of ``n`` nodes, and the node that is left."""
    kept = []
    while len(kept) < levels and n > 1:
        runs = ["".join(hashes[i : i + fan]) for i in range(0, len(hashes), fan)]
        kept.append(runs)
        hashes, n = [digest(run) for run in runs], -(-n // fan)
    return kept, hashes[0]


def left_after(n: int, fan: int, levels: int) -> int:
    """How many nodes of a tree are left after one round."""
    for _ in range(levels):
        if n > 1:
            n = -(-n // fan)
    return n


def proofs(kept: list[list[str]], count: int, fan: int) -> Iterator[tuple[list[str], list[int]]]:
    """For each of ``count`` nodes its siblings level by level, and its own place among them."""
    known: dict[tuple[int, int], tuple[str, int]] = {}
    for node in range(count):
        siblings, at = [], []
        for level, runs in enumerate(kept):
            found = known.get((level, node))
            if found is None:
                place = node % fan
                run = runs[node // fan]
                found = (run[: _DIGITS * place] + run[_DIGITS * (place + 1) :], place)
                if level:  # shared by the nodes below
                    known[level, node] = found
            siblings.append(found[0])
            at.append(found[1])
            node //= fan
        yield siblings, at


def fold(value: str, siblings: Sequence[str], at: Sequence[int]) -> str:
    """The root that a leaf and its proof give; the way to check a proof."""
    for run, place in zip(siblings, at):
        value = digest(run[: _DIGITS * place] + value + run[_DIGITS * place :])
    return value


def _parents(fan: int, levels: int):
    """Reduce the superblocks of one group, sorted by tree and place, to a node each."""

    def run(nodes: pd.DataFrame) -> pd.DataFrame:
        nodes = nodes.sort_values(["tree", "pos"])
        out = []
        for (tree, block), part in nodes.groupby(["tree", "block"], sort=False):
            n = int(part["n"].iat[0])
            out.append((tree, block, left_after(n, fan, levels), reduced(part["hash"].tolist(), n, fan, levels)[1]))
        return pd.DataFrame(out, columns=["tree", "pos", "n", "hash"])

    return run


def _blocks(nodes: DataFrame, fan: int, levels: int) -> DataFrame:
    return nodes.withColumn("block", F.expr(f"pos div {fan ** levels}"))


def rounds(nodes: DataFrame, group: Sequence[str], fan: int, levels: int) -> list[DataFrame]:
    """The nodes of each round up to the roots; ``nodes`` has tree, pos, n, hash and what groups them.

    A group holds whole superblocks. The first round takes all nodes, a later one those of trees
    that are more than one node.
    """
    found = [nodes]
    while True:
        above = common.written(_blocks(nodes, fan, levels).groupBy(*group).applyInPandas(_parents(fan, levels), _NODES), "nodes")
        found.append(above)
        if not above.filter("n > 1").take(1):
            return found
        nodes, group = above.filter("n > 1"), ["tree", "block"]


def _exchange(nodes: DataFrame, outer: DataFrame, fan: int, levels: int) -> DataFrame:
    """The outer nodes of each node of a round, from those of the round above."""

    def run(nodes: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        if nodes.empty:
            return pd.DataFrame(columns=["tree", "pos", "subroot", "root", "proof", "places"])
        nodes = nodes.sort_values("pos")
        hashes = nodes["hash"].tolist()
        kept, _ = reduced(hashes, int(nodes["n"].iat[0]), fan, levels)
        above = outer.iloc[0]
        out = [
            (tree, pos, above["subroot"], above["root"], siblings + list(above["proof"]), at + list(above["places"]))
            for tree, pos, (siblings, at) in zip(nodes["tree"], nodes["pos"], proofs(kept, len(nodes), fan))
        ]
        return pd.DataFrame(out, columns=["tree", "pos", "subroot", "root", "proof", "places"])

    keyed = _blocks(nodes.select("tree", "pos", "n", "hash"), fan, levels)
    return keyed.groupBy("tree", "block").cogroup(outer.groupBy("tree", "pos")).applyInPandas(run, _OUTER)


def _leaves(fan: int, levels: int):
    """Finish the leaves of some superblocks: local levels, outer siblings, and the folded claim."""
    columns = ["doc_id", "source", "leaf", "subroot", "root", "proof", "places", "folded_root"]

    def run(leaves: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        leaves = leaves.sort_values(["tree", "pos"])
        above = {(r.tree, r.pos): r for r in outer.itertuples(index=False)}
        out = []
        for key, part in leaves.groupby(["tree", "block"], sort=False):
            far = above[key]
            far_proof, far_places = list(far.proof), [int(x) for x in far.places]
            hashes = part["hash"].tolist()
            kept, _ = reduced(hashes, int(part["n"].iat[0]), fan, levels)
            rows = zip(part["doc_id"], part["source"], hashes, part["claim"], proofs(kept, len(part), fan))
            for doc_id, source, leaf, claim, (siblings, at) in rows:
                siblings, at = siblings + far_proof, at + far_places
                folded = fold(claim if isinstance(claim, str) else leaf, siblings, at)
                out.append((doc_id, source, leaf, far.subroot, far.root, siblings, at, folded))
        return pd.DataFrame(out, columns=columns)

    return run


def manifest(
    docs: DataFrame,
    claimed: tuple[Column, Mapping[str, Column]] | None = None,
    *,
    fields: Sequence[str] = FIELDS,
    order: str = "doc_id",
    group: str = "source",
    fan: int = FAN,
    levels: int = LEVELS,
) -> DataFrame:
    """Each row's leaf, the roots of its source and of the dataset, its proof, and a check of it.

    doc_id (the ``order`` column), source (the ``group`` column), leaf, subroot, root, proof (for
    each level up to the root the digests of the run's other nodes, in a row), places (the node's
    own place in each run), folded_root and verified. ``claimed`` names rows by a condition and
    the values that someone gives for them; their root is folded from those. Null in ``order`` or
    ``group`` comes first; rows that share an order value are ordered by leaf, equal rows each
    count; a null or empty text is a value like any other; an empty table gives no rows; other
    columns are ignored.
    """
    kinds = dict(docs.dtypes)
    where, values = claimed or (F.lit(False), {})
    stored = {f: F.col(f) for f in fields}
    keyed = docs.select(
        F.col(order).alias("doc_id"),
        F.col(group).alias("source"),
        leaf_hash(stored).alias("hash"),
        F.when(where, leaf_hash(stored | {f: v for f, v in values.items() if f in stored})).alias("claim"),
        F.monotonically_increasing_id().alias("row"),
    )
    keyed = common.written(keyed, "leaves")  # else the ranging would hash every text twice
    size = fan**levels
    leaves = places.grouped(keyed, "source", ["doc_id", "hash", "row"]).select(
        # as text, which pandas keeps exact beside nulls
        F.col("doc_id").cast("string").alias("doc_id"), F.col("source").cast("string").alias("source"),
        "hash", "claim", F.col("start").alias("tree"), "pos", "n",
    )
    # Superblocks that begin in the same stretch of the whole order go together, so small sources do.
    pack = F.expr(f"(tree + pos div {size} * {size}) div {size}")
    leaves = common.written(_blocks(leaves, fan, levels).withColumn("pack", pack), "placed")
    up = rounds(leaves.select("tree", "pos", "n", "hash", "pack"), ["pack"], fan, levels)

    subroots = up[1].filter("n = 1")
    for nodes in up[2:]:
        subroots = subroots.unionByName(nodes.filter("n = 1"))
    sources = places.grouped(subroots.select("tree", "hash", F.lit(0).alias("all")), "all", ["tree"])
    sources = common.written(
        sources.select(F.lit(-1).cast("bigint").alias("tree"), "pos", "n", "hash", F.col("tree").alias("of")), "subroots"
    )
    top = rounds(_blocks(sources, fan, levels), ["tree", "block"], fan, levels)
    root = top[-1].filter("n = 1").select(
        "tree", "pos", F.lit(None).cast("string").alias("subroot"), F.col("hash").alias("root"),
        F.array().cast("array<string>").alias("proof"), F.array().cast("array<int>").alias("places"),
    )
    outer = root
    for nodes in reversed(top[:-1]):
        outer = _exchange(nodes, outer, fan, levels)
    # Above its own root, a source needs what its subroot needs, which is found by its place.
    of = sources.select("pos", "of", F.col("hash").alias("own"))
    above = common.written(
        outer.join(of, "pos").select(F.col("of").alias("tree"), F.col("own").alias("subroot"), "root", "proof", "places"),
        "outer",
    )

    def roots(nodes: DataFrame) -> DataFrame:
        return nodes.filter("n = 1").select("tree", "pos").join(above, "tree").select(*outer.columns)

    outer = roots(up[-1])
    for k in range(len(up) - 2, 0, -1):
        outer = _exchange(up[k].filter("n > 1"), outer, fan, levels).unionByName(roots(up[k]))
    # The place of a superblock's first leaf tells which pack of leaves it belongs to.
    outer = outer.withColumn("pack", F.expr(f"(tree + pos * {size}) div {size}"))
    done = (
        leaves.groupBy("pack")
        .cogroup(outer.groupBy("pack"))
        .applyInPandas(
            _leaves(fan, levels),
            "doc_id string, source string, leaf string, subroot string, root string, proof array<string>, "
            "places array<int>, folded_root string",
        )
    )
    return done.select(
        F.col("doc_id").cast(kinds[order]).alias("doc_id"), F.col("source").cast(kinds[group]).alias("source"),
        "leaf", "subroot", "root", "proof", "places", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"),
    )


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    changed = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    claimed = (changed, {"text": F.translate("text", UPPER, LOWER)})
    done = manifest(common.table(spark, sf_dir, "documents"), claimed)
    proof = F.sha2(F.concat_ws("", "proof"), 256)
    return done.select("doc_id", "leaf", "subroot", "root", proof.alias("proof_sha256"), "folded_root", "verified")


#: Levels written out in the SQL: enough for 16.7 million rows of a source and 65,536 sources.
_SQL_LEVELS = {"s": 6, "t": 4}


def op11_sql() -> str:
    """Level by level: ``s`` are the trees of the sources, ``t`` the tree of their roots.

    The checksum of a number is worked out from its digits with the table of the polynomial.
    """
    value = "coalesce(strlen({0}) || ':' || {0}, '-')"

    def leaf(text: str) -> str:
        columns = ["CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text]
        return f"sha256({' || '.join(value.format(c) for c in columns)})"

    steps = []

    def tree(name: str, base: str) -> None:
        """``base`` has tree, pos, n and h; level k has each node's run, level by level."""
        steps.append(f"{name}0 AS (SELECT tree, pos, n, h FROM {base})")
        for k in range(_SQL_LEVELS[name]):
            steps.append(
                f"{name}r{k} AS (SELECT tree, pos // {FAN} AS run, n, string_agg(h, '' ORDER BY pos) AS cat "
                f"FROM {name}{k} WHERE n > 1 GROUP BY ALL)"
            )
            steps.append(
                f"{name}{k + 1} AS (SELECT tree, run AS pos, (n + {FAN - 1}) // {FAN} AS n, sha256(cat) AS h FROM {name}r{k} "
                f"UNION ALL SELECT tree, pos, n, h FROM {name}{k} WHERE n = 1)"
            )

    def climb(name: str, start: str, tree_column: str, pos_column: str) -> str:
        """Rows of ``start`` with their proof and fold carried up through the tree."""
        before = start
        for k in range(_SQL_LEVELS[name]):
            at = f"{_DIGITS} * (d.{pos_column} // {FAN ** k} % {FAN})"
            head, tail = f"substr(r.cat, 1, {at})", f"substr(r.cat, {at} + {_DIGITS + 1})"
            steps.append(
                f"{start}{k} AS (SELECT d.* REPLACE (d.proof || coalesce({head} || {tail}, '') AS proof, "
                f"CASE WHEN r.cat IS NULL THEN d.folded ELSE sha256({head} || d.folded || {tail}) END AS folded) "
                f"FROM {before} d LEFT JOIN {name}r{k} r ON r.tree = d.{tree_column} AND r.run = d.{pos_column} // {FAN ** (k + 1)})"
            )
            before = f"{start}{k}"
        return before

    table = "SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce(list_concat([CAST(i AS UBIGINT)], CAST(range(8) AS UBIGINT[])), " \
        "lambda c, x: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384::UBIGINT) ELSE c // 2 END) AS c FROM range(256) g(i))"
    crc = (
        "xor(list_reduce(list_concat([4294967295::UBIGINT], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), "
        "lambda x: CAST(ascii(x) AS UBIGINT))), lambda c, x: xor(c // 256, crc.t[CAST(xor(c, x) % 256 + 1 AS BIGINT)])), 4294967295::UBIGINT)"
    )
    steps.append(f"crc AS ({table})")
    steps.append(
        f"""docs AS (SELECT doc_id, source, {leaf('text')} AS leaf,
          CASE WHEN {crc} % 5 = 0 THEN {leaf(f"translate(text, '{UPPER}', '{LOWER}')")} ELSE {leaf('text')} END AS claim
          FROM documents, crc)"""
    )
    steps.append(
        """placed AS (SELECT doc_id, leaf, claim, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
          row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
          count(*) OVER (PARTITION BY source) AS n FROM docs)"""
    )
    steps.append("bases AS (SELECT tree, pos, n, leaf AS h FROM placed)")
    tree("s", "bases")
    steps.append(f"subroots AS (SELECT -1 AS tree, tree AS pos, count(*) OVER () AS n, h FROM s{_SQL_LEVELS['s']})")
    tree("t", "subroots")
    steps.append("a AS (SELECT doc_id, leaf, tree, pos, -1 AS top, '' AS proof, claim AS folded FROM placed)")
    low = climb("s", "a", "tree", "pos")
    steps.append(f"b AS (SELECT * FROM {low})")
    high = climb("t", "b", "top", "tree")
    return f"""WITH {', '.join(steps)}
    SELECT d.doc_id, d.leaf, s.h AS subroot, t.h AS root, sha256(d.proof) AS proof_sha256, d.folded AS folded_root, d.folded = t.h AS verified
    FROM {high} d JOIN subroots s ON s.pos = d.tree CROSS JOIN t{_SQL_LEVELS['t']} t"""
