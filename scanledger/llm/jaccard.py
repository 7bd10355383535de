"""Similarity join of documents on their word shingles, with adaptive prefixes.

Two sets whose Jaccard similarity reaches the threshold share most of their
members, so if both are put in one order, short prefixes of them share a member,
and prefixes longer by l - 1 share l of them.  The join runs in these steps.

1. Copies.  Equal sets become one node.
2. Survivors.  In the order of the hashes, a node needs a number of members of
   its prefix in other nodes too.  A batch counts what it holds twice itself and
   sends each member once, so a member that is everywhere is a row for a batch.
3. Ranks.  Survivors count in how many nodes each member lies and order their
   members from rare to frequent.
4. Adaptive prefixes.  Each node lengthens its prefix to the l with the least
   estimated cost: more to compare, but l matches needed, so fewer candidates.
5. Leaders.  For each member of the shortest prefix the nodes are compared with
   one leader, twice, which joins large groups of near copies in linear work.
6. The rest, exactly.  Members that still lie in several groups bring together
   those nodes that are not in the largest group with all others, in blocks, and
   count the matches of their prefixes.  Pairs with enough are verified.

Links between groups that are joined already are not looked for: they change no
component.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scanledger.llm.common import give_back, narrow, released, staged, text_slices
from scanledger.llm.components import components
from scanledger.llm.words import BLANKS, Words

WIDTH, PERCENT = 5, 80
#: Nodes of one member that are compared in one piece of work.
BLOCK = 256
#: Rounds with leaders, and leaders of each node in a round.
ROUNDS, LEADERS = 2, 2
#: Rows (member, node) that one task sorts at once.
SORTED_ROWS = 1_000_000
#: Bytes of text whose sets are made at once: they take about a hundred times that for a moment.
SET_BYTES = 256 << 10
#: Bytes of text whose members are counted together before they are sent.
COUNTED_BYTES = 12 << 20
#: Up to this number of survivors their ids are sent to every task; more are joined by shuffle.
SENT_IDS = 2_000_000


def needed(n: int, percent: int = PERCENT) -> int:
    """Members that a set of n must share with any set it is linked with."""
    return -(-n * percent // 100)


def set_key(members: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(members.tobytes(), seed=len(members)) - (1 << 63)


SETS = "doc_id long, n long, node long, shared long, members array<long>"


def _first_members(n: int, percent: int) -> int:
    """Length of the first prefix: the shortest, and a tenth of the set more."""
    return min(n, n - needed(n, percent) + 1 + n // 10)


def shingle_table(docs: DataFrame, percent: int) -> DataFrame:
    """Size and key of each text's set, and prefixes in the order of the hashes.

    A member that several nodes of a batch hold is counted for them there
    (``shared``) and sent once, in a row without n; the others go with their node.
    """

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text", COUNTED_BYTES):
            nodes: dict[int, int] = {}
            sizes, keys, lengths, held = [], [], [], []
            for piece in text_slices([batch], "text", SET_BYTES):
                fronts = [np.zeros(0, np.uint64)]
                for members in Words(piece.column("text"), BLANKS).shingle_sets(WIDTH):
                    key = set_key(members) if len(members) else None
                    sizes.append(len(members))
                    keys.append(key)
                    first = key is not None and nodes.setdefault(key, len(keys) - 1) == len(keys) - 1
                    fronts.append(members[: _first_members(len(members), percent) if first else 0])
                    lengths.append(len(fronts[-1]))
                # One array for a piece: as views the prefixes would keep whole sets, and as many small copies the memory between them.
                held.append(np.concatenate(fronts).view(np.int64))
            del fronts
            lengths = np.array(lengths, dtype=np.int64)
            all_ = np.concatenate([*held, np.zeros(0, np.int64)])
            held.clear()
            # Which are there more than once, by one sort: the tables of np.unique are larger than the batch.
            order = np.argsort(all_)
            members = all_[order]
            like_next = np.append(members[1:] == members[:-1], False) if len(members) else np.zeros(0, bool)
            like_last = np.append(False, like_next[:-1]) if len(members) else like_next
            many = np.empty(len(all_), dtype=bool)
            many[order] = like_next | like_last
            members = members[like_next & ~like_last]
            del order, like_next, like_last
            ends = np.concatenate([[0], np.cumsum(lengths)])
            before = np.concatenate([[0], np.cumsum(many)])
            shared = before[ends[1:]] - before[ends[:-1]]
            single = np.concatenate([[0], np.cumsum(lengths - shared), [(~many).sum() + len(members)]])
            sent = pa.ListArray.from_arrays(pa.array(single, pa.int32()), pa.array(np.concatenate([all_[~many], members])))
            ids = pa.concat_arrays([batch.column("doc_id").cast(pa.int64()), pa.nulls(1, pa.int64())])
            yield pa.RecordBatch.from_arrays([ids, pa.array([*sizes, None], pa.int64()), pa.array([*keys, None], pa.int64()), pa.array([*shared.tolist(), None], pa.int64()), sent], ["doc_id", "n", "node", "shared", "members"])

    return docs.mapInArrow(run, SETS)


def members_elsewhere(sent: DataFrame, partitions: int) -> DataFrame:
    """Of rows (member, node), null for several nodes: how many members of a node others hold too, to be added up.

    A single task counts them.  Several give a row for each: a node's members lie
    in more tasks the more there are, so counts of each task would grow with both.
    """

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrived = [b.select(["member", "node"]) for b in batches if b.num_rows]
        if not arrived:
            return
        rows = pa.Table.from_batches(arrived)
        arrived.clear()
        member, node = rows.column("member").to_numpy(), rows.column("node")
        several, node = pc.is_null(node).to_numpy(), pc.fill_null(node, 0).to_numpy()
        del rows
        order = np.lexsort((node, member))
        member, node, several = member[order], node[order], several[order]
        del order
        first = np.flatnonzero(np.concatenate([[True], member[1:] != member[:-1]]))
        run_of = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(member))))
        # A run counts if it has a row for several nodes, or two different nodes.
        differs = np.zeros(len(first), dtype=bool)
        np.logical_or.at(differs, run_of[1:], (member[1:] == member[:-1]) & (node[1:] != node[:-1]))
        np.logical_or.at(differs, run_of, several)
        nodes = node[differs[run_of] & ~several]
        counts = np.ones(len(nodes), np.int64)
        if partitions == 1:
            nodes, counts = np.unique(nodes, return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(counts, pa.int64())], ["node", "shared"])

    return sent.repartition(partitions, "member").mapInArrow(run, "node long, shared long")


def _needed(n: Column, percent: int) -> Column:
    return F.ceil(n * percent / 100).cast("long")


def survivors(table: DataFrame, percent: int) -> DataFrame:
    """Nodes (node, doc_id, n) that may have links: enough of their prefix lies in other nodes."""
    sent = table.select(F.explode("members").alias("member"), "node")
    rows = table.agg(F.sum(F.size("members"))).first()[0] or 0
    counts = members_elsewhere(sent, -(-rows // SORTED_ROWS) or 1).unionByName(table.where("shared > 0").select("node", "shared")).groupBy("node").agg(F.sum("shared").alias("shared"))
    nodes = table.where("node IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.max("n").alias("n"))
    n = F.col("n")
    first = F.least(n, n - _needed(n, percent) + 1 + F.floor(n / 10))
    return nodes.join(counts, "node").where(F.col("shared") >= first - (n - _needed(n, percent))).select("node", "doc_id", "n")


def full_sets(docs: DataFrame, alive: DataFrame) -> DataFrame:
    """All members of the surviving nodes (node, n, members), from one document of each."""
    ids = alive.select(F.col("doc_id").alias("wanted"))
    if alive.count() <= SENT_IDS:
        ids, keys = F.broadcast(ids), F.broadcast(alive.select("node"))
    else:
        keys = alive.select("node")

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text", SET_BYTES):
            sets = list(Words(batch.column("text"), BLANKS).shingle_sets(WIDTH))
            ends = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
            members = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(sets).view(np.int64)))
            keys = pa.array([set_key(s) if len(s) else None for s in sets], pa.int64())
            yield pa.RecordBatch.from_arrays([keys, pa.array(np.diff(ends), pa.int64()), members], ["node", "n", "members"])

    wanted = docs.join(ids, docs["doc_id"].eqNullSafe(F.col("wanted")), "left_semi")
    return wanted.mapInArrow(run, "node long, n long, members array<long>").join(keys, "node", "left_semi").dropDuplicates(["node"])


def choose_matches(weights: np.ndarray, alpha: int, n: int) -> int:
    """The number of matches l whose prefix has the least estimated cost.

    ``weights`` are the frequencies of the shared members, rare first.  A longer
    prefix is sent along for each member of the shortest one.  The candidates
    are its postings divided by the matches that one needs, and each costs a
    reading of both sets.
    """
    shortest = len(weights) - alpha + 1
    postings = np.cumsum(weights - 1)
    best, cost = 1, None
    matches = 1
    while True:
        length = min(len(weights), shortest + matches - 1)
        estimate = length * shortest + 2 * n * postings[length - 1] / matches
        if cost is None or estimate < cost:
            best, cost = matches, estimate
        if matches >= alpha:
            return best
        matches = min(2 * matches, alpha)


def ranked_prefixes(sets: DataFrame, percent: int) -> DataFrame:
    """Prefixes of the nodes in the order from rare to frequent members.

    ``keys`` is the shortest prefix and ``prefix`` the one for ``matches``, both
    without members that no other node holds; ``held`` counts all others.  Only
    the frequencies go to Python.
    """
    postings = sets.select("node", "n", F.explode("members").alias("member"))
    often = postings.groupBy("member").agg(F.count("*").alias("df")).where("df > 1")
    lists = postings.join(often, "member").groupBy("node").agg(F.max("n").alias("n"), F.collect_list(F.struct("df", "member")).alias("held"))
    linked = lists.where(F.size("held") >= _needed(F.col("n"), percent)).select("node", "n", F.array_sort("held").alias("held"))

    def best(n: pa.Array, weights: pa.Array) -> pa.Array:
        found = [choose_matches(np.asarray(w.values), needed(size, percent), size) for size, w in zip(n.to_pylist(), weights, strict=True)]
        give_back()
        return pa.array(found, pa.int64())

    shortest = F.col("held") - _needed(F.col("n"), percent) + 1
    chosen = linked.select("node", "n", F.size("held").cast("long").alias("held"), F.arrow_udf(best, "long")("n", "held.df").alias("matches"), F.col("held.member").alias("members"))
    first = lambda length: F.slice("members", F.lit(1), length.cast("int"))
    return chosen.select("node", "n", "held", "matches", first(shortest).alias("keys"), first(shortest + F.col("matches") - 1).alias("prefix"))


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar enough."""
    left = sets.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("members").alias("ma"))
    right = sets.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("members").alias("mb"))
    both = F.size(F.array_intersect("ma", "mb"))
    return pairs.join(left, "a").join(right, "b").where(100 * both >= percent * (F.col("na") + F.col("nb") - both)).select("a", "b")


def _sizes_fit(percent: int) -> Column:
    return 100 * F.least("n", "m") >= percent * F.greatest("n", "m")


def leader_pairs(postings: DataFrame, turn: int, percent: int) -> DataFrame:
    """A few pairs (a, b) for each node: with the leaders of the most of its members, in other groups."""
    chosen = F.struct(F.xxhash64("node", F.lit(turn)).alias("draw"), F.col("node").alias("b"), F.col("n").alias("m"), F.col("group").alias("g"))
    leaders = postings.groupBy("member").agg(F.min(chosen).alias("first")).select("member", "first.b", "first.m", "first.g")
    pairs = postings.join(leaders, "member").where((F.col("group") != F.col("g")) & _sizes_fit(percent)).groupBy(F.col("node").alias("a"), "b").count()
    place = F.row_number().over(Window.partitionBy("a").orderBy(F.col("count").desc(), "b"))
    return pairs.withColumn("place", place).where(F.col("place") <= LEADERS).select("a", "b")


def grouped(nodes: DataFrame, links: DataFrame | None) -> DataFrame:
    """Nodes with the group that the links put them in; a node without links is its own."""
    if links is None:
        return nodes.withColumn("group", F.col("node"))
    found = components(links).withColumnRenamed("component", "group")
    return nodes.join(found, "node", "left").withColumn("group", F.coalesce("group", "node"))


def work_pieces(ranked: DataFrame, block: int) -> DataFrame:
    """Rows for comparing: nodes with their prefixes for each piece (member, i, j) of work.

    A member's nodes outside its largest group are dealt to blocks, and those
    in it to further blocks; each block of the former meets every block once.
    A member with few nodes is one piece.
    """
    postings = ranked.select("node", "group", F.explode("keys").alias("member"))
    per_group = postings.groupBy("member", "group").agg(F.count("*").alias("size"))
    members = per_group.groupBy("member").agg(F.max(F.struct("size", "group")).alias("top"), F.sum("size").alias("all")).where("all > top.size")
    outside, inside = F.col("all") - F.col("top.size"), F.col("top.size")
    blocks = lambda size: F.ceil(size / block).cast("int")
    small = F.col("all") <= block
    members = members.select("member", F.col("top.group").alias("largest"), F.when(small, 1).otherwise(blocks(outside)).alias("n_out"), F.when(small, 0).otherwise(blocks(inside)).alias("n_in"))
    placed = postings.join(members, "member")
    draw = F.xxhash64("node", "member")
    out = (F.col("group") != F.col("largest")) | (F.col("n_in") == 0)
    own = F.when(out, F.pmod(draw, "n_out")).otherwise(F.col("n_out") + F.pmod(draw, F.greatest("n_in", F.lit(1)))).cast("int")
    others = F.when(out, F.sequence(F.lit(0), F.col("n_out") + F.col("n_in") - 1)).otherwise(F.sequence(F.lit(0), F.col("n_out") - 1))
    pieces = placed.withColumn("own", own).select("node", "member", "own", F.explode(others).alias("other"))
    with_prefix = pieces.join(ranked.select("node", "group", "n", "held", "matches", "prefix"), "node")
    return with_prefix.withColumns({"i": F.least("own", "other"), "j": F.greatest("own", "other")})


class Piece:
    """The nodes of a piece of work, compared all at once by counting common prefix members."""

    def __init__(self, nodes, groups, n, held, matches, blocks, prefixes, percent: int):
        self.nodes, self.groups, self.n, self.held, self.matches, self.blocks, self.percent = nodes, groups, n, held, matches, blocks, percent
        self.lengths = np.array([len(p) for p in prefixes])
        self.rows = np.repeat(np.arange(len(prefixes)), self.lengths)
        _, self.columns, times = np.unique(np.concatenate(prefixes), return_inverse=True, return_counts=True)
        useful = times[self.columns] > 1
        self.rows, self.columns = self.rows[useful], self.columns[useful]

    def common(self, width: int = 4096) -> np.ndarray:
        """Numbers of common prefix members of all pairs, by products of pieces of the 0-1 table."""
        size = len(self.nodes)
        out = np.zeros((size, size), dtype=np.float32)
        _, columns = np.unique(self.columns, return_inverse=True)
        order = np.argsort(columns, kind="stable")
        rows, columns = self.rows[order], columns[order]
        last = int(columns[-1]) + 1 if len(columns) else 0
        for start in range(0, last, width):
            here = slice(*np.searchsorted(columns, [start, start + width]))
            table = np.zeros((size, min(width, last - start)), dtype=np.float32)
            table[rows[here], columns[here] - start] = 1
            out += table @ table.T
        return out.astype(np.int64)

    def pairs(self, apart: bool) -> Iterator[tuple[int, int, bool]]:
        """Pairs that can be linked, and whether they are known to be; ``apart``: only across the two blocks.

        Known links are given only where they join groups that this piece has not joined yet.
        """
        common, n = self.common(), self.n
        least, most = np.minimum.outer(n, n), np.maximum.outer(n, n)
        total = np.add.outer(n, n)
        rest = self.held - self.lengths
        fits = (np.subtract.outer(self.groups, self.groups) != 0) & (100 * least >= self.percent * most)
        fits &= common >= np.minimum.outer(self.matches, self.matches)
        # What is not counted lies behind the end of one of the prefixes.
        bound = common + np.maximum.outer(rest, rest)
        fits &= (100 + self.percent) * bound >= self.percent * total
        if apart:
            fits &= np.subtract.outer(self.blocks, self.blocks) != 0
        whole = rest == 0
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while parent.setdefault(x, x) != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        for a, b in zip(*(x.tolist() for x in np.nonzero(np.triu(fits, 1))), strict=True):
            known = bool(whole[a] and whole[b])
            if known:
                x, y = root(int(self.groups[a])), root(int(self.groups[b]))
                if x == y:
                    continue
                parent[x] = y
            yield int(self.nodes[a]), int(self.nodes[b]), known


def candidate_pairs(pieces: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b, known) out of all pieces of work."""

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, at = [], None

        def compare() -> pa.RecordBatch:
            part = pa.Table.from_batches(held).combine_chunks()
            number = lambda c: part.column(c).to_numpy()
            prefixes = [np.asarray(p.values) for p in part.column("prefix").chunk(0)]
            piece = Piece(number("node"), number("group"), number("n"), number("held"), number("matches"), number("own"), prefixes, percent)
            found = list(piece.pairs(apart=at[1] != at[2]))
            return pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.bool_()))], ["a", "b", "known"])

        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(c).to_numpy() for c in ("member", "i", "j")])
            cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            for start, end in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows], strict=True):
                here = tuple(keys[:, start].tolist())
                if held and here != at:
                    if sum(h.num_rows for h in held) > 1:
                        yield compare()
                    held = []
                at = here
                held.append(batch.slice(start, end - start))
        if held and sum(h.num_rows for h in held) > 1:
            yield compare()

    dealt = pieces.repartition("member", "i", "j").sortWithinPartitions("member", "i", "j")
    return dealt.mapInArrow(run, "a long, b long, known boolean")


def similar_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """Components of documents linked by similar shingle sets: doc_id, n_shingles, component_id.

    One row for each row of ``docs``.  A null or empty text has no shingles and
    its component is itself; so is, for rows with a null id, a null.  Repeated
    rows are copies of each other.
    """
    source = narrow(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    table = staged(shingle_table(source, percent), "shingles").where("n IS NOT NULL OR size(members) > 0")
    alive = staged(survivors(table, percent), "survivors")
    sets = staged(full_sets(source, alive), "sets")
    ranked = staged(ranked_prefixes(sets, percent), "prefixes")
    links = None
    for turn in range(ROUNDS):
        postings = grouped(ranked, links).select("node", "n", "group", F.explode("keys").alias("member"))
        found = staged(verified(leader_pairs(staged(postings, "postings"), turn, percent), sets, percent), "links")
        links = found if links is None else links.unionByName(found)
    pieces = work_pieces(staged(grouped(ranked, links), "groups"), BLOCK)
    pairs = staged(candidate_pairs(pieces, percent), "pairs")
    open_ = pairs.where("NOT known").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    links = links.unionByName(pairs.where("known").select("a", "b")).unionByName(verified(open_, sets, percent))
    nodes = table.where("node IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("first"))
    joined = nodes.join(components(links), "node", "left").withColumn("component", F.coalesce("component", "node"))
    smallest = joined.groupBy("component").agg(F.min("first").alias("component_id"))
    named = joined.join(smallest, "component").select("node", "component_id")
    rows = table.where("n IS NOT NULL").select("doc_id", "n", "node")
    return rows.join(named, "node", "left").select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs``, with all their columns, of the smallest id of each component.

    Rows under one id are one document, of which one row stays.  Rows without an
    id are no copies of anything and stay.
    """
    found = staged(similar_components(docs, id_col, text_col, percent), "components")
    lost = staged(found.where("component_id < doc_id").select("doc_id").distinct(), "lost")
    twice = staged(found.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").select("doc_id"), "twice")
    small = lambda ids: F.broadcast(ids) if ids.count() <= SENT_IDS else ids
    same = lambda ids: docs[id_col] == ids["doc_id"]
    lost, twice = small(lost), small(twice)
    kept = docs.join(lost, same(lost), "left_anti")
    return kept.join(twice, same(twice), "left_anti").unionByName(kept.join(twice, same(twice), "left_semi").dropDuplicates([id_col]))
