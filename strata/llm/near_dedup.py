"""Groups of near copies: documents whose sets of five-word shingles have a Jaccard similarity of 0.75 or more.

Documents with the same set are one node. HyperMinHash registers are banded; nodes that share a band are candidates.
Links are only those that the full sets confirm. Pairs of a group are never listed:

1. Every node goes to its star, the smallest node that leads one of its bands. Within a star, in blocks bounded by rows
   and by bytes, registers are compared first, by the collision-corrected estimate. Only nodes with a partner above 0.75
   less five standard errors send their full sets, which are compared by bit vectors; a block gives a spanning forest.
2. Nodes of bands that still hold different components of different blocks are open. Two sets of that similarity share
   one at least of the rarest quarter (and one more) of their shingles, in any order common to all sets. Counting
   shingles over the open nodes gives that order. An open node goes on only if such a shingle of its own is also one of a
   node of another component, so texts that have only a common frame, like pages of one template, cost nothing further.
3. Where a star of several blocks isn't connected yet, its nodes outside its leader's component are compared with the
   other blocks, by full sets.
4. Bands that still hold different components and stars are searched: sets of up to ``LIGHT`` shingles by themselves, as
   they are no larger than registers, others by the estimate: first the best pairs that would connect components, then,
   after those are confirmed or not, all that remain above the bar. Both are confirmed on full sets. Nodes of a band's
   largest component meet only the nodes outside it.

Sets of up to ``LITTLE`` shingles are always open and meet at their rare shingles as well as in bands, so that no link
among them rests on a band. For larger sets a link of
exactly 0.75 is missed by all bands with a probability below 2e-5 (simulated).

Rows: null or empty text, or white space only, has no shingles and is linked with nothing. Rows with the same doc_id
are one node for linking. A null doc_id takes part through its set only: it gets the component of its equals, or null.
An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm import hyperminhash as H
from strata.llm.components import components
from strata.llm.ship import ship, tidied
from strata.llm.text import distinct, mix, shingle_hashes, slices, word_hashes
from strata.session import written

BLOCK = 512
BLOCK_BYTES = 32 << 20
LIGHT = 64  # shingles whose hashes take as much room as registers
LITTLE = 16
NUM, DEN = 3, 4  # the threshold, as a fraction
SURE = 5.0


def shingle_sets(column: pa.Array) -> Iterator[tuple[int, list[np.ndarray]]]:
    """Sorted distinct shingle hashes of each row, some rows at a time with the number of the first."""
    for row, _, data, offsets in slices(column):
        found, bounds = shingle_hashes(*word_hashes(data, offsets))
        yield row, [distinct(found[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


def _binary(parts: list[np.ndarray]) -> pa.Array:
    return pa.array([p.tobytes() for p in parts], pa.binary())


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row, sets in shingle_sets(batch.column("text")):
            sums = np.array([[mix(s ^ np.uint64(c)).sum(dtype=np.uint64) for c in (11, 29)] for s in sets], np.uint64)
            some = [k for k, s in enumerate(sets) if len(s)]
            codes: list[bytes | None] = [None] * len(sets)
            if some:
                for k, line in zip(some, H.registers([sets[k] for k in some]), strict=True):
                    codes[k] = line.tobytes()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").slice(row, len(sets)),
                    pa.array([len(s) for s in sets], pa.int64()),
                    *(pa.array(sums[:, k].view(np.int64)) for k in (0, 1)),
                    pa.array(codes, pa.binary()),
                    pa.array([s.tobytes() if len(s) <= LIGHT else None for s in sets], pa.binary()),
                ],
                ["doc_id", "n_shingles", "h1", "h2", "registers", "light"],
            )


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(len(column), H.BUCKETS)


def _banded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            keys = H.bands(_matrix(batch.column("registers")))
            nodes = batch.column("node").to_numpy().repeat(H.BANDS)
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(nodes)], ["band", "node"])


def _full(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row, sets in shingle_sets(batch.column("text")):
            ids = batch.column("doc_id").slice(row, len(sets))
            part = np.array([mix(s ^ np.uint64(11)).sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([ids, pa.array(part), _binary(sets)], ["node", "part", "shingles"])


def _postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for node, part, raw in zip(*(batch.column(c).to_pylist() for c in ("node", "part", "shingles")), strict=True):
            own = np.frombuffer(raw, np.int64)
            columns = (np.full(len(own), v, np.int64) for v in (node, part, len(own)))
            yield pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.array(own)], ["node", "part", "n", "shingle"])


class _Forest:
    def __init__(self, n: int):
        self.up = list(range(n))

    def top(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = x = self.up[self.up[x]]
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.top(a), self.top(b)
        self.up[max(a, b)] = min(a, b)
        return a != b


def _shared(sets: list[np.ndarray]) -> np.ndarray:
    """Bit vectors of the sets over those hashes that two sets at least have."""
    values = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    new = np.diff(values, prepend=values[:1] ^ np.uint64(1)) != 0
    number = np.cumsum(new) - 1
    common = np.bincount(number) > 1
    column = np.cumsum(common) - 1
    keep = common[number]
    width = -(-max(int(common.sum()), 1) // 64) * 8
    bits = np.zeros((len(sets), width), np.uint8)
    at = column[number[keep]]
    np.bitwise_or.at(bits, (owner[keep], at >> 3), (1 << (at & 7)).astype(np.uint8))
    return bits.view(np.uint64)


def _similar(inter: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    return inter * DEN >= NUM * (n + m - inter)


def _links_in_block(table: pa.Table) -> pa.Table:
    """A spanning forest of the links in a block. Roles: 0 any with any, 1 only with 2 of other components."""
    node, role, comp = (table[c].to_numpy() for c in ("node", "role", "component"))
    sets = [np.frombuffer(b, np.uint64) for b in table["shingles"].to_pylist()]
    size = np.fromiter(map(len, sets), np.int64, len(sets))
    bits, forest, out = _shared(sets), _Forest(len(sets)), []
    for k in range(len(sets)):
        if role[k] == 2:
            continue
        rest = np.arange(k + 1, len(sets)) if role[k] == 0 else np.flatnonzero((role == 2) & (comp != comp[k]))
        rest = rest[(np.minimum(size[rest], size[k]) * DEN >= NUM * np.maximum(size[rest], size[k]))]
        inter = np.bitwise_count(bits[rest] & bits[k]).sum(axis=1, dtype=np.int64)
        for j in rest[_similar(inter, size[rest], size[k])]:
            if forest.join(k, int(j)):
                out.append((node[k], node[j]))
    return pa.table({"a": pa.array([a for a, _ in out], pa.int64()), "b": pa.array([b for _, b in out], pa.int64())})


def _estimates(lines: np.ndarray, size: np.ndarray, k: int, rest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Estimated similarity of row k to the others, and whether it may reach the threshold."""
    guess = H.estimate((lines[rest] == lines[k]).mean(axis=1), size[rest], size[k])
    return guess, guess >= NUM / DEN - SURE * H.spread(np.minimum(size[rest], size[k]))


def _promising(table: pa.Table) -> pa.Table:
    """The rows of a block that have a partner by the estimate."""
    size = table["n_shingles"].to_numpy()
    lines = _matrix(table["registers"])
    near = np.zeros(len(size), bool)
    for k in range(len(size)):
        rest = np.arange(k + 1, len(size))
        rest = rest[np.minimum(size[rest], size[k]) * DEN >= NUM * np.maximum(size[rest], size[k])]
        if near[k]:
            rest = rest[~near[rest]]
        if len(rest):
            hit = rest[_estimates(lines, size, k, rest)[1]]
            near[hit] = True
            near[k] |= len(hit) > 0
    return table.select(["star", "block", "node"]).filter(pa.array(near))


def _near_pairs(best: bool):
    """Pairs of different components and stars of a cell: links of light sets, and pairs that may be links by estimate."""

    def search(table: pa.Table) -> pa.Table:
        names = ("node", "component", "star", "n_shingles", "side")
        node, comp, star, size, side = (table[c].to_numpy() for c in names)
        lines, raw = _matrix(table["registers"]), table["light"].to_pylist()
        light = np.array([r is not None for r in raw])
        bits = _shared([np.frombuffer(r or b"", np.uint64) for r in raw]) if light.any() else None
        first = side == side.min()
        other = ~first if side.max() > side.min() else first
        sure, left, right, score = [], [], [], []
        for k in np.flatnonzero(first):
            ok = other & (comp != comp[k]) & (star != star[k]) & (node != node[k])
            ok &= np.minimum(size, size[k]) * DEN >= NUM * np.maximum(size, size[k])
            exact = np.flatnonzero(ok & light) if light[k] else np.zeros(0, np.int64)
            if len(exact):
                inter = np.bitwise_count(bits[exact] & bits[k]).sum(axis=1, dtype=np.int64)
                sure += [(k, j) for j in exact[_similar(inter, size[exact], size[k])].tolist()]
            rest = np.flatnonzero(ok & ~light) if light[k] else np.flatnonzero(ok)
            if len(rest):
                guess, keep = _estimates(lines, size, k, rest)
                left += [k] * int(keep.sum())
                right += rest[keep].tolist()
                score += guess[keep].tolist()
        number = {c: k for k, c in enumerate(np.unique(comp).tolist())}
        forest = _Forest(len(number))
        tops = [number[c] for c in comp.tolist()]
        pairs = [p for p in sure if forest.join(tops[p[0]], tops[p[1]])]
        guessed = [p for p in zip(left, right, strict=True) if forest.top(tops[p[0]]) != forest.top(tops[p[1]])]
        if best:
            rank = dict(zip(zip(left, right, strict=True), score, strict=True))
            guessed.sort(key=lambda p: -rank[p])
            guessed = [p for p in guessed if forest.join(tops[p[0]], tops[p[1]])]
        ends = {tuple(sorted((int(node[a]), int(node[b])))) for a, b in pairs + guessed}
        return pa.table({"a": pa.array([a for a, _ in ends], pa.int64()), "b": pa.array([b for _, b in ends], pa.int64())})

    return search


def _confirmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = []
        for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), strict=True):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            both = np.sort(np.concatenate((x, y)))
            keep.append(bool(_similar(np.count_nonzero(both[1:] == both[:-1]), len(x), len(y))))
        if any(keep):
            yield batch.select(["a", "b"]).filter(pa.array(keep))


def near_components(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id (smallest reachable doc_id), kept."""
    ship(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    sketch = written(
        rows.mapInArrow(tidied(_sketch), "doc_id long, n_shingles long, h1 long, h2 long, registers binary, light binary"), "sketch"
    )
    same_set = ["n_shingles", "h1", "h2"]
    classes = sketch.filter("n_shingles > 0").groupBy(*same_set).agg(F.min("doc_id").alias("node"))
    noded = sketch.join(classes, same_set, "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("n_shingles") > 0, F.col("node")).otherwise(F.col("doc_id")).alias("node"),
        *(F.when(F.col("doc_id") == F.col("node"), F.col(c)).alias(c) for c in ("registers", "light")),
    )
    noded = written(noded, "nodes")
    nodes = noded.filter("registers is not null").select("node", "n_shingles", "registers", "light")

    banded = nodes.select("node", "registers").mapInArrow(_banded, "band long, node long")
    shared = (
        banded.groupBy("band").agg(F.min("node").alias("leader"), F.max("node").alias("last")).filter("leader < last")
    )
    members = written(banded.join(shared.select("band", "leader"), "band"), "band-members")
    placed = written(_placed(members, nodes), "stars")

    wanted = rows.join(placed.select(F.col("node").alias("doc_id")), "doc_id", "left_semi")
    sets = written(wanted.mapInArrow(tidied(_full), "node long, part long, shingles binary"), "sets")
    full = sets.select("node", "shingles")

    found = _with(placed.withColumn("component", F.col("node")), written(_star_links(placed, nodes, full), "star-links"))
    rare = written(_rare(written(_open(members, found), "open"), sets), "rare")
    partners = written(_partners(rare, found), "partners")
    found = _with(found, written(_cross_block_links(found, partners, full), "cross-links"))
    little = found.filter("little").select("node")
    bands = members.select("band", "node").join(partners, "node", "left_semi")
    bands = written(bands.unionByName(rare.toDF("node", "band").join(little, "node", "left_semi")), "bands")
    for best in (True, False):
        pairs = written(_band_pairs(bands, found, nodes, best), "near-pairs")
        a, b = full.toDF("a", "x"), full.toDF("b", "y")
        near = pairs.join(a, "a").join(b, "b").select("a", "b", "x", "y").mapInArrow(_confirmed, "a long, b long")
        found = _with(found, written(near, "links"))
    total = noded.join(found.select("node", "component"), "node", "left")
    component = F.coalesce("component", "node")
    return total.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, component.isNull()).alias("kept"),
    )


def _placed(members: DataFrame, nodes: DataFrame) -> DataFrame:
    """Star and block of every node that shares a band, and of every little set (in a star of its own)."""
    star = members.groupBy("node").agg(F.min("leader").alias("star"))
    sized = nodes.groupBy("node").agg(F.max("n_shingles").alias("size"), F.min("n_shingles").alias("least"))
    own = sized.join(star, "node", "left").filter(F.col("star").isNotNull() | (F.col("least") <= LITTLE))
    own = own.select("node", F.coalesce("star", "node").alias("star"), "size", (F.col("least") <= LITTLE).alias("little"))
    many = F.greatest(F.count("*") / BLOCK, F.sum("size") * 8 / BLOCK_BYTES)
    sizes = own.groupBy("star").agg(F.ceil(many).cast("long").alias("blocks"))
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).alias("block")
    return own.join(sizes, "star").select("node", "star", block, "blocks", "little")


def _with(found: DataFrame, links: DataFrame) -> DataFrame:
    """``found`` after further links: only the components that they touch are joined."""
    if links.isEmpty():
        return found
    of = found.select("node", "component")
    ends = links.join(of.toDF("a", "x"), "a").join(of.toDF("b", "y"), "b").select(F.col("x").alias("a"), F.col("y").alias("b"))
    into = components(ends).toDF("component", "into")
    joined = found.join(into, "component", "left").withColumn("component", F.coalesce("into", "component"))
    return written(joined.select("node", "star", "block", "blocks", "little", "component"), "found")


def _star_links(placed: DataFrame, nodes: DataFrame, full: DataFrame) -> DataFrame:
    """Links within each block of each star; the leader is in every block. Registers move first, sets of survivors after."""
    inner = placed.filter("node <> star").select("star", "block", "node")
    cells = inner.union(inner.select("star", "block").distinct().select("star", "block", F.col("star").alias("node")))
    cells = cells.join(nodes.select("node", "n_shingles", "registers"), "node")
    near = cells.groupBy("star", "block").applyInArrow(_promising, "star long, block long, node long").distinct()
    near = near.join(full, "node").withColumns({"role": F.lit(0), "component": F.lit(0).cast("long")})
    return near.groupBy("star", "block").applyInArrow(_links_in_block, "a long, b long")


def _open(members: DataFrame, found: DataFrame) -> DataFrame:
    """Nodes of bands that hold several components in several blocks, and all little sets."""
    rows = members.select("band", "node").join(found, "node")
    cell = F.struct("star", "block")
    mixed = (
        rows.groupBy("band")
        .agg(*(f(c).alias(n) for n, f, c in (("c", F.min, "component"), ("d", F.max, "component"), ("p", F.min, cell), ("q", F.max, cell))))
        .filter("c < d and p < q")
    )
    nodes = members.join(mixed.select("band"), "band", "left_semi").select("node")
    return nodes.union(found.filter("little").select("node")).distinct()


def _rare(nodes: DataFrame, sets: DataFrame) -> DataFrame:
    """The shingles of each open node by which a partner must be found: its rarest quarter and one, where others have them."""
    own = sets.join(nodes, "node", "left_semi").dropDuplicates(["node", "part"])
    postings = written(own.mapInArrow(_postings, "node long, part long, n long, shingle long"), "postings")
    counts = postings.groupBy("shingle").agg(F.count("*").alias("times")).filter("times > 1")
    place = F.row_number().over(Window.partitionBy("node", "part").orderBy(F.desc("times"), F.desc("shingle")))
    ranked = postings.join(counts, "shingle").withColumn("place", place)
    return ranked.filter(F.col("place") >= F.col("n") - F.floor(F.col("n") * (DEN - NUM) / DEN)).select("node", "shingle").distinct()


def _partners(rare: DataFrame, found: DataFrame) -> DataFrame:
    """Open nodes that have a rare shingle in common with a node of another component."""
    rows = rare.join(found.select("node", "component"), "node")
    ends = rows.groupBy("shingle").agg(F.min("component").alias("c"), F.max("component").alias("d")).filter("c < d")
    return rare.join(ends.select("shingle"), "shingle", "left_semi").select("node").distinct()


def _cross_block_links(found: DataFrame, partners: DataFrame, full: DataFrame) -> DataFrame:
    """Links of the partners outside the leader's component with partners in other blocks of their star."""
    leader = found.select(F.col("node").alias("star"), F.col("component").alias("leading"))
    blocks = found.filter("blocks > 1").join(partners, "node", "left_semi").join(leader, "star", "left")
    asks = blocks.filter("component <> coalesce(leading, star)")
    asking = asks.select("star", F.col("block").alias("of")).distinct()
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    cell = ("star", "of", "to", "node", "component", "role")
    ask = asks.withColumns({"of": F.col("block"), "to": every, "role": F.lit(1)}).filter("to <> block").select(*cell)
    answer = blocks.join(asking, "star").filter("of <> block").withColumns({"to": F.col("block"), "role": F.lit(2)}).select(*cell)
    cells = ask.union(answer).join(full, "node")
    return cells.groupBy("star", "of", "to").applyInArrow(_links_in_block, "a long, b long")


def _band_pairs(bands: DataFrame, found: DataFrame, nodes: DataFrame, best: bool) -> DataFrame:
    """Candidates in each band: the nodes outside its largest component with each other and with that component."""
    rows = bands.join(found, "node")
    each = rows.groupBy("band", "component").agg(F.count("*").alias("n"), F.min("star").alias("p"), F.max("star").alias("q"))
    total = each.groupBy("band").agg(
        F.max(F.struct("n", "component")).alias("top"), F.sum("n").alias("n"), F.min("p").alias("p"), F.max("q").alias("q")
    )
    chunks = lambda n: F.ceil(n / BLOCK).cast("long")
    mixed = total.filter("n > top.n and p < q").select(
        "band", F.col("top.component").alias("main"), chunks(F.col("top.n")).alias("mains"),
        chunks(F.col("n") - F.col("top.n")).alias("others"),
    )
    rows = rows.join(mixed, "band").withColumn("is_main", F.col("component") == F.col("main"))
    own = F.pmod(F.xxhash64("node"), F.when(F.col("is_main"), F.col("mains")).otherwise(F.col("others")))
    rows = rows.withColumn("own", own)
    to = lambda n: F.sequence(F.lit(0).cast("long"), F.col(n) - 1)
    cell_of = lambda i, j, side: F.struct(i.alias("i"), j.alias("j"), side.cast("long").alias("side"))
    mine = F.col("own")
    beside = F.transform(to("others"), lambda o: cell_of(F.least(mine, o), -1 - F.greatest(mine, o), mine))
    across = F.transform(to("mains"), lambda m: cell_of(mine, m, F.lit(0)))
    main = F.transform(to("others"), lambda o: cell_of(o, mine, F.lit(1)))
    cells = rows.withColumn("cell", F.explode(F.when(F.col("is_main"), main).otherwise(F.concat(beside, across))))
    cells = cells.select("band", "cell.*", "node", "component", "star").join(nodes, "node")
    return cells.groupBy("band", "i", "j").applyInArrow(_near_pairs(best), "a long, b long").distinct()


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, one of each group, with all their columns.

    Rows are judged by their own text: where a doc_id (null ones as well) stands for different texts, each text is a document
    of its own. Rows that agree in doc_id and text stay or go together.
    """
    number = F.col("doc_id").cast("long")
    code = F.xxhash64(F.col("text"))
    texts = docs.groupBy(number.alias("__id")).agg(F.min(code).alias("low"), F.max(code).alias("high"))
    several = written(texts.filter("low <> high or __id is null").select("__id", F.lit(True).alias("__several")), "shared-ids")
    own = number
    rows = docs
    if not several.isEmpty():
        rows = docs.join(several, number.eqNullSafe(F.col("__id")), "left")
        own = F.when(F.col("__several"), F.xxhash64(number, F.col("text"))).otherwise(number)
    rows = rows.withColumn("__own", own)
    found = near_components(rows.select(F.col("__own").alias("doc_id"), "text"))
    gone = found.filter("not kept").select(F.col("doc_id").alias("__gone")).distinct()
    stay = rows.join(gone, F.col("__own") == F.col("__gone"), "left_anti")
    return stay.select(*[F.col(f"`{c}`") for c in docs.columns])
