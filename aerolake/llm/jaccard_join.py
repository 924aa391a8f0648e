"""Near duplicates by a parity-sketch join.

The shingles of a text are dealt to the parts of a sketch, each part the XOR of
its shingles' hashes, so a shingle that only one of two texts has changes one part
at most: the number of parts that differ is at most the symmetric difference. The
threshold bounds that difference within a band of sizes by D, so of D + 1 + E
parts two linked texts share more than E, and if one of them has at most E empty
parts, one that is not empty. Texts with more empty parts also send a prefix of
their shingles, of which linked ones share one.

Texts that share a part meet in a bucket, where each is tied to the least of them
only, and to none where all of them meet at a lesser text that other parts tie them to.
The tie with most shared parts is verified on the texts; components of the
verified links then settle nearly all buckets. Where a tie joins two components
still, its hub's texts are compared in blocks of bounded size: those that have another
one near by bit sketches meet again with their shingles, and each block gives the links
that join its components, a forest. Blocks of one hub meet each other only where it is
still open then.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolake.llm.common import map_arrow, parts, shards_for, stored
from aerolake.llm.graph import components
from aerolake.llm.hashing import mix, shingle_sets

SHINGLE = 5
#: Links have 100 * intersection >= PERCENT * union.
PERCENT = 80
#: Ratio of the size bands.
RATIO = 1.5
#: Signatures gathered before they are dealt to buckets, and texts at most.
FLUSH = 2_000_000
FLUSH_TEXTS = 60_000
#: Texts of a hub in one block of comparisons, or tied to one copy of it, and their
#: shingles together.
BLOCK = 2_000
BLOCK_SHINGLES = 4_000_000
#: Signatures that one task holds, about, and at least where there are few in all: a tie
#: is found again in each bucket that has a part of it.
BUCKET_KEYS = 8_000_000
FEW_KEYS = 1_000_000
SKETCH_BITS = 2048


def _bands(largest: int) -> np.ndarray:
    """First sizes of the bands; the first is below any size that can be near another."""
    edges = [1]
    while edges[-1] <= largest * RATIO:
        edges.append(max(edges[-1] + 1, int(edges[-1] * RATIO)))
    return np.array(edges, np.int64)


def _plan(edges: np.ndarray, band: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Parts and allowed empty parts of these bands; 0 parts where only equal sets link.

    The lesser of two linked sets has m shingles, the greater at most m * 100 / P:
    they differ in at most (100 - P) / (100 + P) of the sum.
    """
    most = edges[band + 1] - 1
    differ = most * (100 - PERCENT) // PERCENT
    spare = np.maximum(1, differ // 6)
    return np.where(differ > 0, differ + 1 + spare, 0), spare


def _identity(own: np.ndarray) -> int:
    """A number for the set: 63 bits, so equal for different sets with a chance of
    about N * N / 2 ** 64 among N sets."""
    if not len(own):
        return -1
    h = mix(np.array([np.bitwise_xor.reduce(mix(own)), own.sum(dtype=np.uint64), np.uint64(len(own))]))
    return int(mix(h[:1] + h[1:2] * np.uint64(3) + h[2:] * np.uint64(5))[0] >> np.uint64(1))


def describe(docs: DataFrame) -> DataFrame:
    """doc_id, key, n_shingles, node: the number of its shingle set (-1: empty)."""

    def make():
        def step(batch: pa.RecordBatch):
            sizes, nodes = [], []
            for _, sets in shingle_sets(batch["text"], SHINGLE):
                sizes += map(len, sets)
                nodes += map(_identity, sets)
            yield {
                "doc_id": batch["doc_id"],
                "key": batch["key"],
                "n_shingles": pa.array(sizes, pa.int64()),
                "node": pa.array(nodes, pa.int64()),
            }

        return step

    keyed = docs.withColumn("key", row_key())
    return map_arrow(keyed, make, "doc_id long, key long, n_shingles long, node long")


def row_key() -> Column:
    """Names a row by doc_id and text; repeated rows have the same."""
    return F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string"))


def _signatures(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the sets, and which set each is from."""
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    values = np.concatenate(sets)
    edges = _bands(int(sizes.max()))
    own = np.searchsorted(edges, sizes, side="right") - 1
    keys, owners = [], []
    for lower in (0, 1):
        band = own - lower
        # below its own band a set can only meet sets of at least P % of its size
        use = (band >= 0) & (sizes * PERCENT <= 100 * (edges[np.maximum(band, 0) + 1] - 1))
        count, spare = _plan(edges, np.maximum(band, 0))
        count = np.where(use, count, 0)
        base = np.cumsum(count) - count
        total = int(count.sum())
        if not total:
            continue
        per = np.repeat(count, sizes)
        used = per > 0
        shingles = mix(values[used] + np.uint64(0x51ED270B))
        owner = np.repeat(np.arange(len(sets)), sizes)[used]
        slot = base[owner] + ((shingles >> np.uint64(32)) * per[used].astype(np.uint64) >> np.uint64(32)).astype(np.int64)
        words = np.zeros(total, np.uint64)
        np.bitwise_xor.at(words, slot, mix(values[used]))
        filled = np.bincount(slot, minlength=total) > 0
        doc = np.repeat(np.arange(len(sets)), count)
        part = np.arange(total) - base[doc]
        key = mix(words + mix((band[doc] << 40 | part).astype(np.uint64)))
        keys.append(key[filled])
        owners.append(doc[filled])
        empty = np.bincount(doc[~filled], minlength=len(sets))
        for i in np.flatnonzero((count > 0) & (empty > spare)).tolist():
            n = len(sets[i])
            prefix = sets[i][: n - (n * PERCENT + 99) // 100 + 1]  # sorted alike everywhere
            keys.append(mix(prefix ^ np.uint64(0xA5A5A5A5A5A5A5A5)))
            owners.append(np.full(len(prefix), i))
    if not keys:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(keys), np.concatenate(owners)


def _deal(buckets: int):
    """Signatures in packs by bucket: 8 bytes of key and 2 of the text's place."""

    def close(nodes: list[int], keys: list, owners: list) -> pa.RecordBatch:
        key, owner = np.concatenate(keys), np.concatenate(owners)
        # equal keys of different parts only add a comparison
        bucket = (key % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        bounds = np.searchsorted(bucket[order], np.arange(buckets + 1)).tolist()
        names = np.array(nodes, "<i8")
        packs = []
        for k in range(buckets):
            own = order[bounds[k] : bounds[k + 1]]
            if len(own):
                used = np.zeros(len(names), bool)
                used[owner[own]] = True
                short = key[own].astype("<u8").tobytes()
                places = (np.cumsum(used) - 1)[owner[own]].astype("<u2").tobytes()
                head = np.array([used.sum(), len(own)], "<u8").tobytes()
                packs.append((k, head + names[used].tobytes() + short + places))
        return pa.RecordBatch.from_pydict(
            {
                "bucket": pa.array([k for k, _ in packs], pa.int32()),
                "pack": pa.array([p for _, p in packs], pa.binary()),
            }
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nodes, keys, owners, seen, size = [], [], [], set(), 0
        for batch in batches:
            for _, sets in shingle_sets(batch["text"], SHINGLE):
                fresh = []
                for own in sets:
                    name = _identity(own)
                    if len(own) and name not in seen:
                        seen.add(name)
                        fresh.append(own)
                        nodes.append(name)
                if not fresh:
                    continue
                key, owner = _signatures(fresh)
                keys.append(key)
                owners.append(owner + len(nodes) - len(fresh))
                size += len(key)
                if size >= FLUSH or len(nodes) >= FLUSH_TEXTS:
                    if size:
                        yield close(nodes, keys, owners)
                    nodes, keys, owners, seen, size = [], [], [], set(), 0
        if size:
            yield close(nodes, keys, owners)

    return run


def _stars(key: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ties (node, hub, shared) of sorted keys: the texts of a key all have a tie to one
    hub, if they are not it."""
    first = np.ones(len(key), bool)
    first[1:] = key[1:] != key[:-1]
    starts = np.flatnonzero(first)
    several = np.diff(starts, append=len(key)) > 1
    within = np.repeat(several, np.diff(starts, append=len(key)))
    names, node = np.unique(node[within], return_inverse=True)
    if not len(names):
        return names, names, names
    size = np.diff(starts, append=len(key))[several]
    starts = np.cumsum(size) - size
    least = np.minimum.reduceat(node, starts)
    tie = node * len(names) + np.repeat(least, size)  # places of names: less than 2 ** 63
    known = np.unique(tie[node != np.repeat(least, size)])
    # a hub tied to a lesser one that is tied to none: its keys whose texts all are tied
    # to that one too need no ties of their own
    top = np.arange(len(names))
    np.minimum.at(top, known // len(names), known % len(names))
    other = top[least]
    spare = (other != least) & (top[other] == other)
    at = np.repeat(spare, size)
    wanted = node[at] * len(names) + np.repeat(other[spare], size[spare])
    if len(wanted):
        found = known[np.minimum(np.searchsorted(known, wanted), len(known) - 1)] == wanted
        spare[spare] = np.logical_and.reduceat(found, np.cumsum(size[spare]) - size[spare])
    left = ~np.repeat(spare, size) & (node != np.repeat(least, size))
    tie, shared = np.unique(tie[left], return_counts=True)
    return names[tie // len(names)], names[tie % len(names)], shared


def _tie(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tie the texts of each key to the least of them: node, hub, shared."""
    keys, nodes = [], []
    for batch in batches:
        for pack in batch["pack"].to_pylist():
            n, m = (int(x) for x in np.frombuffer(pack, "<u8", 2))
            names = np.frombuffer(pack, "<i8", n, 16)
            at = 16 + 8 * n
            keys.append(np.frombuffer(pack, "<u8", m, at))
            nodes.append(names[np.frombuffer(pack, "<u2", m, at + 8 * m)])
    if not keys:
        return
    key, node = np.concatenate(keys), np.concatenate(nodes)
    del keys, nodes
    order = np.argsort(key, kind="stable")
    key, node = key[order], node[order]
    node, hub, shared = _stars(key, node)
    for a in range(0, len(node), 100_000):
        yield pa.RecordBatch.from_pydict(
            {
                "node": pa.array(node[a : a + 100_000], pa.int64()),
                "hub": pa.array(hub[a : a + 100_000], pa.int64()),
                "shared": pa.array(shared[a : a + 100_000], pa.int64()),
            }
        )


def one_of_each(docs: DataFrame) -> DataFrame:
    """Of each group of near duplicates the row with the least doc_id (none counts
    as least), with all its columns; texts without shingles stay, repeated or not."""
    found = stored(join(docs), "groups")
    first = found.where("component is not null").groupBy("component").agg(
        F.min_by("key", F.struct("doc_id", "key")).alias("_key")
    )
    alone = found.where("component is null").select(F.col("key").alias("_key")).distinct()
    keyed = docs.withColumn("_key", row_key())
    kept = keyed.join(stored(first.select("_key"), "first"), "_key", "left_semi").dropDuplicates(["_key"])
    blank = keyed.join(stored(alone, "blank"), "_key", "left_semi")
    return kept.unionByName(blank).drop("_key")


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sorted sets reach the threshold."""
    if min(len(a), len(b)) * 100 < PERCENT * max(len(a), len(b)):
        return False
    both = np.sort(np.concatenate((a, b)))
    common = int((both[1:] == both[:-1]).sum())
    return 100 * common >= PERCENT * (len(a) + len(b) - common)


def _check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by hub, the hub's own text first; give the links."""
    hub, own = None, None
    for batch in batches:
        names, roles, nodes = (batch[c].to_pylist() for c in ("hub", "member", "node"))
        a, b = [], []
        for doc, sets in shingle_sets(batch["text"], SHINGLE):
            for i, found in enumerate(sets, doc):
                if _identity(found) != nodes[i]:
                    continue  # another row with this key
                if not roles[i]:
                    hub, own = names[i], found
                elif names[i] == hub and linked(found, own):
                    a.append(nodes[i])
                    b.append(hub)
        yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _verify(pairs: DataFrame, docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Links (a, b) among pairs (node, hub), each judged on the whole texts.

    A hub with many pairs is copied, so that no task gets more than some of them.
    """
    copies = pairs.groupBy("hub").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("copies"))
    members = pairs.join(copies, "hub").select(
        "hub", F.pmod(F.xxhash64("node"), "copies").cast("int").alias("copy"), F.lit(True).alias("member"), "node"
    )
    hubs = copies.select(
        "hub",
        F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy"),
        F.lit(False).alias("member"),
        F.col("hub").alias("node"),
    )
    # written, so that the union is no side of a join
    wanted = stored(members.unionByName(hubs), "pairs").join(nodes.select("node", "key"), "node")
    return (
        wanted.join(docs.select(row_key().alias("key"), "text"), "key")
        .repartition(parts(docs.sparkSession), "hub", "copy")
        .sortWithinPartitions("hub", "copy", "member")
        .select("hub", "member", "node", "text")
        .mapInArrow(_check, "a long, b long")
        .distinct()
    )


def _sketch(sets: list[np.ndarray]) -> list[bytes]:
    out = []
    for own in sets:
        bits = np.bincount((own >> np.uint64(20)).astype(np.int64) % SKETCH_BITS, minlength=SKETCH_BITS) & 1
        out.append(np.packbits(bits.astype(np.uint8)).tobytes())
    return out


def _near(key: tuple, rows: pa.Table) -> pa.Table:
    """The texts of one block that sketches and sizes allow a link to one of another
    component: no pairs, at most the rows that came in."""
    size, part = (rows[c].to_numpy() for c in ("size", "component"))
    words = np.frombuffer(b"".join(rows["sketch"].to_pylist()), "<u8").reshape(len(size), -1)
    hit = np.zeros(len(size), bool)
    for i in range(len(size) - 1):
        rest = slice(i + 1, None)
        sizes = size[rest]
        fits = np.minimum(sizes, size[i]) * 100 >= PERCENT * np.maximum(sizes, size[i])
        at = np.flatnonzero(fits & (part[rest] != part[i])) + i + 1
        if not len(at):
            continue
        apart = np.bitwise_count(words[at] ^ words[i]).sum(axis=1, dtype=np.int64)
        at = at[apart * (100 + PERCENT) <= (100 - PERCENT) * (size[at] + size[i])]
        hit[at] = True
        hit[i] |= len(at) > 0
    kept = rows.filter(pa.array(hit)).select(["node", "component"])
    for name, value in zip(("hub", "i", "j"), key, strict=True):
        kept = kept.append_column(name, pa.repeat(value, len(kept)))
    return kept


def forest(sets: list[np.ndarray], part: np.ndarray) -> list[tuple[int, int]]:
    """Pairs of linked sets that join all components which links among the sets join: at
    most one less than there are components. ``part`` has each set's component."""
    _, part = np.unique(part, return_inverse=True)
    size = np.fromiter(map(len, sets), np.int64, len(sets))
    owner = np.repeat(np.arange(len(sets)), size)
    _, shingle, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    # sets of each shingle, one after the other
    holders = owner[np.argsort(shingle, kind="stable")]
    starts = np.cumsum(times) - times
    bounds = np.cumsum(size) - size
    found = []
    for i in range(len(sets) - 1):
        open_to = part != part[i]
        if not open_to[i + 1 :].any():
            continue
        own = shingle[bounds[i] : bounds[i] + size[i]]
        own = own[times[own] > 1]
        each = times[own]
        at = np.repeat(starts[own] - (np.cumsum(each) - each), each) + np.arange(each.sum())
        common = np.bincount(holders[at], minlength=len(sets))
        near = open_to & (100 * common >= PERCENT * (size + size[i] - common))
        near[: i + 1] = False
        for j in np.flatnonzero(near).tolist():
            if part[j] != part[i]:
                found.append((i, j))
                part[part == part[j]] = part[i]
    return found


def _joined(rows: pa.Table) -> pa.Table:
    """Links that join the components of one block, judged on the shingles."""
    node = rows["node"].to_numpy()
    sets = [np.frombuffer(x, "<u8") for x in rows["shingles"].to_pylist()]
    links = forest(sets, rows["component"].to_numpy())
    ends = node[np.array(links, np.int64).reshape(-1, 2)]
    return pa.table({"a": pa.array(ends.max(axis=1, initial=-1), pa.int64()), "b": pa.array(ends.min(axis=1, initial=2**63 - 1), pa.int64())})


def _texts(docs: DataFrame, nodes: DataFrame, wanted: DataFrame) -> DataFrame:
    """node, text of the wanted nodes."""
    keys = nodes.join(wanted, "node").select("node", "key")
    return docs.select(row_key().alias("key"), "text").join(keys, "key").select("node", "text")


def _sets(texts: DataFrame, name: str, kind: str, make_value) -> DataFrame:
    """node and what ``make_value`` makes of its shingles, for rows whose text has them."""

    def make():
        def step(batch: pa.RecordBatch):
            nodes, named, values = batch["node"].to_pylist(), [], []
            for doc, sets in shingle_sets(batch["text"], SHINGLE):
                some = [(nodes[i], own) for i, own in enumerate(sets, doc) if _identity(own) == nodes[i]]
                named += [n for n, _ in some]
                values += make_value([own for _, own in some])
            yield {"node": pa.array(named, pa.int64()), name: pa.array(values, pa.binary())}

        return step

    # rows of equal text have the same sets
    return stored(map_arrow(texts, make, f"node long, {name} {kind}").dropDuplicates(["node"]), name)


def hub_blocks(ties: DataFrame, nodes: DataFrame) -> DataFrame:
    """hub, blocks: how many blocks its texts are dealt to, by number and shingles."""
    sized = ties.select("node", "hub").join(nodes.select("node", "n_shingles"), "node")
    need = F.greatest((F.count("*") + 1) / BLOCK, F.sum("n_shingles") / BLOCK_SHINGLES)
    return sized.groupBy("hub").agg(F.ceil(need).cast("int").alias("blocks"))


def _unsettled(
    ties: DataFrame, found: DataFrame, docs: DataFrame, nodes: DataFrame, blocks: DataFrame, across: bool
) -> DataFrame:
    """Links (a, b) between components around hubs whose ties are not all settled: inside
    the blocks of each hub, or ``across`` the blocks of those that have several."""

    def labelled(df: DataFrame, column: str, name: str) -> DataFrame:
        known = found.select(F.col("node").alias(column), F.col("component").alias(name))
        return df.join(known, column, "left").withColumn(name, F.coalesce(name, column))

    both = stored(labelled(labelled(ties.select("node", "hub"), "node", "component"), "hub", "own"), "ties")
    open_hubs = both.where("component <> own").select("hub").distinct()
    if across:
        open_hubs = open_hubs.join(blocks.where("blocks > 1").select("hub"), "hub")
    members = both.join(open_hubs, "hub").select("hub", "node", "component")
    centres = labelled(open_hubs.select("hub", F.col("hub").alias("node")), "node", "component")
    members = stored(members.unionByName(centres.select("hub", "node", "component")), "open-hubs")
    texts = _texts(docs, nodes, members.select("node").distinct())
    sketches = _sets(texts, "sketch", "binary", _sketch)
    placed = members.join(blocks, "hub").withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
    if across:
        others = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        placed = others.where("block <> other").withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")})
    else:
        placed = placed.withColumns({"i": F.col("block"), "j": F.col("block")})
    sized = nodes.select("node", F.col("n_shingles").alias("size"))
    compared = placed.join(sketches, "node").join(sized, "node")
    near = stored(
        compared.select("hub", "i", "j", "node", "component", "size", "sketch")
        .groupBy("hub", "i", "j")
        .applyInArrow(_near, "node long, component long, hub long, i int, j int"),
        "near",
    )
    texts = _texts(docs, nodes, near.select("node").distinct())
    shingles = _sets(texts, "shingles", "binary", lambda sets: [own.astype("<u8").tobytes() for own in sets])
    return (
        near.join(shingles, "node")
        .groupBy("hub", "i", "j")
        .applyInArrow(_joined, "a long, b long")
        .distinct()
    )


def join(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, key, component of every row.

    component_id is the least doc_id that links lead to. Null, empty and blank
    texts have no shingles and are linked with nothing; rows without doc_id get no
    component_id but are compared like all others. Repeated rows give a row each.
    ``key`` is the row's ``row_key``; ``component`` numbers the group, null for
    texts without shingles.
    Other columns are not looked at. An empty table gives no rows.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    about = stored(describe(docs), "shingle-sets")
    # one text stands for all with the same set
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key", "n_shingles"))
    nodes = stored(
        about.where("node >= 0").groupBy("node").agg(first.alias("first")).select(
            "node", "first.doc_id", "first.key", "first.n_shingles"
        ),
        "nodes",
    )
    # a text has up to four signatures for five shingles
    keys = 0.8 * (nodes.agg(F.sum("n_shingles")).first()[0] or 0)
    buckets = max(shards_for(int(keys), BUCKET_KEYS), min(parts(spark), shards_for(int(keys), FEW_KEYS)))
    ties = stored(
        docs.select("text")
        .mapInArrow(_deal(buckets), "bucket int, pack binary")
        .repartition(buckets, "bucket")
        .mapInArrow(_tie, "node long, hub long, shared long")
        .groupBy("node", "hub")
        .agg(F.sum("shared").alias("shared")),
        "ties",
    )
    best = ties.groupBy("node").agg(F.max_by("hub", F.struct("shared", "hub")).alias("hub"))
    links = stored(_verify(best, docs, nodes), "links")
    found = stored(components(links), "components")
    blocks = stored(hub_blocks(ties, nodes), "blocks")
    for across in (False, True):
        if across and blocks.where("blocks > 1").isEmpty():
            break
        rest = stored(_unsettled(ties, found, docs, nodes, blocks, across), "links")
        if not rest.isEmpty():
            links = links.unionByName(rest)
            found = stored(components(links), "components")
    least = (
        nodes.join(found, "node", "left")
        .withColumn("component", F.coalesce("component", "node"))
        .groupBy("component")
        .agg(F.min("doc_id").alias("component_id"))
    )
    by_node = found.join(least, "component").select("node", "component", F.col("component_id").alias("near"))
    alone = nodes.select("node", F.col("doc_id").alias("least"))
    return (
        about.join(alone, "node", "left")
        .join(by_node, "node", "left")
        .select(
            "doc_id",
            "n_shingles",
            F.when(F.col("doc_id").isNotNull(), F.coalesce("near", "least", "doc_id")).alias("component_id"),
            "key",
            F.when(F.col("node") >= 0, F.coalesce("component", "node")).alias("component"),
        )
    )
