"""Near-duplicate documents by fast similarity sketches, banding and exact checks.

Sketch. A document's shingles are thrown into ``COORDS`` bins, round by round:
in the first rounds each shingle picks a bin by hash, in the later ones a round
fills one fixed bin, so every coordinate is filled after at most twice as many
rounds; a bin keeps the smallest hash of the round that filled it. Two documents
agree in a coordinate with a probability that is their similarity, concentrated
as for independent hashes. Bands of ``ROWS`` coordinates make candidates: at
similarity 0.75 the chance to share none of 40 bands is below one in a million.

Exact part. Documents of one shingle set are one node. In each band bucket the
member that shares most buckets leads; each distinct (leader, member) pair is
checked on the full sets, which also gives the member's difference from its
leader. Members that are not linked to their leader may still be linked to one
another: each of them is checked against all members of its leader from the
differences alone, blocks of members against blocks, so no pairs become rows
and no group has to fit a task. Since two documents of one bucket have its
leader in common, no candidate pair goes unchecked. Links are joined to
components by labels that spread and jump until they rest. Shingles are told
apart by a 64-bit hash of their words' bytes under a key that follows from all
texts, so that no one can build words that collide; whole sets by 128 bits and
their size.

Ids are integers. Null and empty texts and texts without words have an empty set
and no links; a component_id is then the row's own id. With fewer than five
words the whole sequence is the one shingle. Long texts are read whole. Repeated
rows are of one component as their sets are equal; an id with several texts has
each row linked by its own text. Rows without an id are of the component of an
equal set that has one, and are not compared beyond that. Columns besides id and
text are not read. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from pageloom.llm.storage import saved
from pageloom.llm.text import SPACED, blocks, corpus_key, gram_hash, gram_inside, map_blocks, mix, word_hash, words
from pageloom.llm.tokens import list_array

COORDS, ROWS = 160, 4
WORDS = 5
#: Members of a leader that are held against as many others at a time, and that meet the leader in one lot.
BLOCK_MEMBERS, LOT = 512, 256
_ODD = np.uint64(0x9E3779B97F4A7C15)


def shingle_sets(block, k: int = WORDS, key: int = 0) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each row's text."""
    found = words(block, SPACED)
    hashes = word_hash(block, found, lower=True, key=key)
    grams = gram_hash(hashes, k)
    out = []
    for r in range(len(block)):
        low, high = found.first[r], found.first[r + 1]
        if high - low >= k:
            out.append(np.unique(grams[low : high - k + 1]))
        elif high > low:
            out.append(gram_hash(hashes[low:high], int(high - low)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _set_hash(items: np.ndarray) -> np.uint64:
    """64-bit hash of a set of shingle hashes."""
    return mix(items).sum(dtype=np.uint64)


def sketch(sets: list[np.ndarray], coords: int = COORDS) -> np.ndarray:
    """A row of coordinates for each set; rows of empty sets stay zero."""
    n = len(sets)
    row = np.repeat(np.arange(n), [len(s) for s in sets])
    item = np.concatenate(sets) if n else np.zeros(0, np.uint64)
    out = np.full(n * coords, np.iinfo(np.uint64).max, np.uint64)
    empty = np.ones(n * coords, bool)
    for turn in range(2 * coords):
        if not len(item):
            break
        value = mix(item ^ (np.uint64((turn + 1) * int(_ODD) % (1 << 64))))
        if turn < coords:
            bin_ = ((value & np.uint64(0xFFFFFFFF)) * np.uint64(coords) >> np.uint64(32)).astype(np.int64)
        else:
            bin_ = np.full(len(item), turn - coords)
        at = row * coords + bin_
        new = empty[at]
        at = at[new]
        np.minimum.at(out, at, value[new])
        empty[at] = False
        open_rows = empty.reshape(n, coords).any(1)
        if not open_rows[row].all():
            keep = open_rows[row]
            row, item = row[keep], item[keep]
    out = out.reshape(n, coords)
    out[[len(s) == 0 for s in sets]] = 0
    return out


def band_keys(coordinates: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """A hash for each band of each row."""
    n, coords = coordinates.shape
    bands = coordinates.reshape(n, coords // rows, rows)
    out = np.broadcast_to(np.arange(coords // rows, dtype=np.uint64) * _ODD, (n, coords // rows)).copy()
    for j in range(rows):
        out = mix(out ^ bands[:, :, j]) + _ODD
    return out


def signatures(docs: DataFrame, id_col: str = "doc_id", key: int = 0) -> DataFrame:
    """id, n_shingles, a 128-bit hash of the set (h1, h2) and the band keys."""

    def fn(block, rows):
        sets = shingle_sets(block, key=key)
        n = np.array([len(s) for s in sets])
        keys = band_keys(sketch(sets))
        h1 = np.array([_set_hash(s) for s in sets], np.uint64)
        h2 = np.array([mix(s ^ _ODD).sum(dtype=np.uint64) for s in sets], np.uint64)
        bands = list_array(keys[n > 0].view(np.int64).reshape(-1), np.where(n > 0, keys.shape[1], 0))
        return pa.record_batch({id_col: rows.column(id_col), "n_shingles": n.astype(np.int64), "h1": h1.view(np.int64), "h2": h2.view(np.int64), "bands": bands})

    kind = docs.schema[id_col].dataType.simpleString()
    return map_blocks(docs, [id_col], fn, f"{id_col} {kind}, n_shingles long, h1 long, h2 long, bands array<long>")


def leader_pairs(nodes: DataFrame) -> DataFrame:
    """Distinct (leader, member) of the band buckets of nodes (node, bands)."""
    spots = nodes.select("node", F.explode("bands").alias("key"))
    shared = spots.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key")
    spots = saved(spots.join(shared, "key"))
    weight = spots.groupBy("node").agg(F.count("*").alias("weight"))
    ranked = spots.join(weight, "node")
    lead = ranked.groupBy("key").agg(F.max(F.struct("weight", (-F.col("node")).alias("least")))["least"].alias("least"))
    pairs = spots.join(lead, "key").select((-F.col("least")).alias("leader"), F.col("node").alias("member"))
    return pairs.filter("leader <> member").distinct()


def check_leaders(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, percent: int, key: int = 0) -> DataFrame:
    """leader, member, linked, n_leader, missing, added, diff: the exact comparison of each pair.

    A leader meets its members in lots of about ``LOT``, so no group has to fit a task; within a lot its set is made once and the members stream past it.
    nodes: node, least (id), h1; docs: _id and text. Of a repeated id only texts of the node's set count.
    """
    lots = pairs.groupBy("leader").agg(F.ceil(F.count("*") / LOT).cast("int").alias("lots"))
    lot = F.pmod(F.xxhash64("member"), "lots").cast("int")
    asked = pairs.join(lots, "leader").select("leader", lot.alias("lot"), F.lit(1).alias("role"), F.col("member").alias("node"))
    leads = lots.select("leader", F.explode(F.sequence(F.lit(0), F.col("lots") - 1)).alias("lot"), F.lit(0).alias("role"), F.col("leader").alias("node"))
    asked = asked.union(leads).join(nodes.select("node", "least", "h1"), "node")
    # texts meet ids by one plan at every size, which a broadcast of few ids would not be
    rows = asked.hint("merge").join(docs, F.col("least") == F.col("_id")).select("leader", "lot", "role", "node", "h1", "text")
    rows = rows.repartition("leader", "lot").sortWithinPartitions("leader", "lot", "role", "node")

    def run(batches):
        own, base, last = None, None, None
        for batch in batches:
            col = {c: batch.column(c).to_pylist() for c in ("leader", "lot", "role", "node", "h1")}
            for block in blocks(batch.column("text")):
                out: dict[str, list] = {c: [] for c in ("leader", "member", "linked", "n_leader", "missing", "added")}
                diffs = [np.zeros(0, np.uint64)]
                for i, member in enumerate(shingle_sets(block, key=key), block.first):
                    lot_of, node = (col["leader"][i], col["lot"][i]), col["node"][i]
                    if (lot_of, node) == last or int(_set_hash(member).view(np.int64)) != col["h1"][i]:
                        continue  # a repeated row, or another text of the id
                    last = lot_of, node
                    if not col["role"][i]:
                        own, base = lot_of, member
                        continue
                    if own != lot_of:
                        raise ValueError(f"no text of leader {lot_of[0]}")
                    diff = np.setxor1d(base, member, assume_unique=True)
                    both = (len(base) + len(member) - len(diff)) // 2
                    linked = 100 * both >= percent * (both + len(diff))
                    for name, value in zip(out, (lot_of[0], node, linked, len(base), len(base) - both, len(member) - both), strict=True):
                        out[name].append(value)
                    diffs.append(diff)
                yield pa.record_batch({c: pa.array(v, pa.bool_() if c == "linked" else pa.int64()) for c, v in out.items()} | {"diff": list_array(np.concatenate(diffs).view(np.int64), np.array([len(d) for d in diffs[1:]], np.int64))})

    return rows.mapInArrow(run, "leader long, member long, linked boolean, n_leader long, missing long, added long, diff array<long>")


def _pair_links(left, right, n_leader: int, percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the links of members of two blocks, of which one is not linked to the leader.

    With D the difference from the leader X, the members a and b share
    |X| - missing(a) - missing(b) + |D(a) and D(b)| shingles.
    """
    same = left is right
    member_a, linked_a, missing_a, added_a, diff_a, size_a = left
    member_b, linked_b, missing_b, added_b, diff_b, size_b = right
    common = np.zeros((len(member_a), len(member_b)), np.float32)
    # only elements of both blocks can be shared by two members; of one block, those that stand twice
    values, counts = np.unique(diff_a, return_counts=True)
    values = values[counts > 1] if same else np.intersect1d(values, diff_b)
    for low in range(0, len(values), 4096):
        part = values[low : low + 4096]

        def bits(diff, sizes, part=part):
            at = np.minimum(np.searchsorted(part, diff), len(part) - 1)
            hit = part[at] == diff
            out = np.zeros((len(sizes), len(part)), np.float32)
            out[np.repeat(np.arange(len(sizes)), sizes)[hit], at[hit]] = 1
            return out

        a = bits(diff_a, size_a)
        common += a @ (a if same else bits(diff_b, size_b)).T
    both = n_leader - missing_a[:, None] - missing_b[None] + common.astype(np.int64)
    total = (n_leader - missing_a + added_a)[:, None] + (n_leader - missing_b + added_b)[None]
    hit = (100 * both >= percent * (total - both)) & ~(linked_a[:, None] & linked_b[None])
    if same:
        hit &= np.arange(len(member_a))[:, None] < np.arange(len(member_b))[None]
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.get(x, x) != x:
            x = root[x]
        return x

    for x, linked in [*zip(member_a.tolist(), linked_a.tolist(), strict=True), *zip(member_b.tolist(), linked_b.tolist(), strict=True)]:
        if linked:
            root[x] = -1  # all of these are together already
    out = []
    for i, j in zip(*np.nonzero(hit), strict=True):
        a, b = find(int(member_a[i])), find(int(member_b[j]))
        if a != b:
            root[max(a, b)] = min(a, b)
            out.append((int(member_a[i]), int(member_b[j])))
    return out


def check_members(checked: DataFrame, percent: int, block_members: int | None = None) -> DataFrame:
    """Links (a, b) between members of one leader, of which at least one is not linked to it.

    Open members (not linked to the leader) meet the open ones and the linked ones block by block; linked ones never meet each other.
    """
    size = block_members or BLOCK_MEMBERS
    is_open = F.when(F.col("linked"), 0).otherwise(1)
    groups = checked.groupBy("leader").agg(F.count("*").alias("n"), F.sum(is_open).alias("u")).filter("n > 1 and u > 0")
    parts = groups.select("leader", F.ceil(F.col("u") / size).cast("int").alias("opens"), F.ceil((F.col("n") - F.col("u")) / size).cast("int").alias("rest"))
    rows = checked.join(parts, "leader").withColumn("part", F.pmod(F.xxhash64("member"), F.when(F.col("linked"), F.col("rest")).otherwise(F.col("opens"))).cast("int"))
    upto = lambda n: F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))

    def meet(kind: int, p, q, side):
        return F.struct(F.lit(kind).alias("kind"), p.alias("p"), q.alias("q"), side.alias("side"))

    part = F.col("part")
    # kind 0: open blocks p <= q; kind 1: an open block p and a linked block q; side: which of the two this member is of
    among = F.transform(upto(F.col("opens")), lambda x: meet(0, F.least(part, x), F.greatest(part, x), F.when(part <= x, 0).otherwise(1)))
    across = F.transform(upto(F.col("rest")), lambda x: meet(1, part, x, F.lit(0)))
    back = F.transform(upto(F.col("opens")), lambda x: meet(1, x, part, F.lit(1)))
    rows = rows.withColumn("at", F.explode(F.when(F.col("linked"), back).otherwise(F.concat(among, across))))
    rows = rows.select("leader", "at.kind", "at.p", "at.q", "at.side", "member", "linked", "n_leader", "missing", "added", "diff")
    rows = rows.repartition("leader", "kind", "p", "q").sortWithinPartitions("leader", "kind", "p", "q", "side", "member")

    def run(batches):
        held: list[pa.RecordBatch] = []
        now = None

        def side(of):
            table = pa.Table.from_batches(held)
            table = table.filter(pa.array(table.column("side").to_numpy() == of)).combine_chunks()
            diff = table.column("diff").combine_chunks()
            sizes = np.diff(diff.offsets.to_numpy())
            col = lambda name: table.column(name).to_numpy()
            return col("member"), col("linked").astype(bool), col("missing"), col("added"), diff.flatten().to_numpy(), sizes

        def flush():
            left = side(0)
            links = _pair_links(left, left if now[1] == 0 and now[2] == now[3] else side(1), held[0].column("n_leader")[0].as_py(), percent)
            return pa.record_batch({"a": pa.array([x[0] for x in links], pa.int64()), "b": pa.array([x[1] for x in links], pa.int64())})

        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in ("leader", "kind", "p", "q")])
            edges = np.r_[0, np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1, batch.num_rows]
            for low, high in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                key = tuple(keys[:, low].tolist())
                if now is not None and key != now:
                    yield flush()
                    held = []
                now = key
                held.append(batch.slice(low, high - low))
        if held:
            yield flush()

    return rows.mapInArrow(run, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """node, component: the least node that can be reached over the edges (a, b).

    Each round a node takes the least label of its neighbours and itself, and
    then the label of that label; rounds follow the logarithm of the diameter.
    """
    both = saved(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).filter("a <> b").distinct())
    labels = saved(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("c")).select(F.col("a").alias("node"), F.col("c").alias("component")))
    while True:
        near = both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("component").alias("near"))
        joined = labels.join(near, F.col("node") == F.col("a")).select("node", F.col("component").alias("old"), F.least("component", "near").alias("component"))
        jump = labels.select(F.col("node").alias("_n"), F.col("component").alias("_c"))
        joined = joined.join(jump, F.col("component") == F.col("_n"), "left").select("node", "old", F.least("component", "_c").alias("component"))
        joined = saved(joined)
        labels = joined.select("node", "component")
        if joined.filter("old <> component").isEmpty():
            return labels


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", percent: int = 75) -> DataFrame:
    """id, n_shingles, component_id of every row of docs; ids are integers, others are an error before any work."""
    if not isinstance(docs.schema[id_col].dataType, IntegralType):
        raise TypeError(f"{id_col} must be of an integer type")
    docs = docs.select(F.col(id_col).cast("long").alias("_id"), "text")
    key = corpus_key(docs)
    signed = saved(signatures(docs, "_id", key))
    nodes = signed.filter("n_shingles > 0").groupBy("h1", "h2", "n_shingles").agg(F.min("_id").alias("least"), F.first("bands").alias("bands"))
    nodes = saved(nodes.withColumn("node", F.monotonically_increasing_id()))
    pairs = saved(leader_pairs(nodes.filter("least is not null").select("node", "bands")))
    checked = saved(check_leaders(pairs, nodes, docs, percent, key))
    links = checked.filter("linked").select(F.col("leader").alias("a"), F.col("member").alias("b")).union(check_members(checked, percent))
    found = components(links)
    named = found.join(nodes.select("node", "least"), "node")
    named = named.join(named.groupBy("component").agg(F.min("least").alias("component_id")), "component").select("node", "component_id")
    sets = nodes.join(named, "node", "left").select("h1", "h2", "n_shingles", F.coalesce("component_id", "least").alias("component_id"))
    rows = signed.join(sets, ["h1", "h2", "n_shingles"], "left")
    return rows.select(F.col("_id").alias(id_col), "n_shingles", F.coalesce("component_id", F.col("_id")).alias("component_id"))


def op6_fast_sketch_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.withColumn("kept", F.col("doc_id") == F.col("component_id"))


#: Every pair of documents with a shingle in common is counted: for small tables.
ORACLE_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(w) >= 5 THEN [array_to_string(w[i:i + 4], ' ') for i in range(1, len(w) - 3)] WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM d),
e AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k, any_value(a.n) AS x, any_value(b.n) AS y FROM e a JOIN e b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p WHERE 100 * k >= 75 * (x + y - k)),
links AS MATERIALIZED (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(a, b) AS (SELECT doc_id, doc_id FROM d UNION SELECT r.a, links.b FROM r JOIN links ON links.a = r.b),
c AS (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a)
SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept FROM s JOIN c USING (doc_id)
"""
