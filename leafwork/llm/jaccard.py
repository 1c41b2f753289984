"""N-gram Jaccard join by parity sketches.

A document is its set of distinct word shingles, as 64-bit hashes. For a band of set sizes the hash space is cut into
chunks, and a set's sketch holds, by chunk, the XOR of its hashes. Each differing shingle changes one chunk, so sets
that link differ in at most d chunks, where d follows from the band and the threshold. Of all chunks only the d + 1
greatest in the order (number of shingles, value) are joined on: chunks that two sets share have the same place in that
order, so some shared chunk is among those that both send. Chunks of many shingles are rarely shared by chance.

Groups of sets that sent the same chunk are compared in cells, which hold their members and keep a union-find: two sets
of one component are never compared again, and a cell gives at most one link for each component that it joins, however
many pairs it sees. First, on bit sketches alone, whose Hamming distance never exceeds the symmetric difference: sets that
may link make candidate clusters. Then, on the sets themselves, within each cluster. A cluster beyond one cell is dealt to
cells of bounded size that share its hubs; what is then still apart meets the rest of the cluster, block by block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafwork.llm.common import discard, lean, materialize, rows_whole, small_batches, table

BAND_RATIO = 1.5
CHUNKS_PER_DIFFERENCE = 1.3
#: Rows of one batch that a task returns: sketches and keys of long texts are large.
ROWS = 1_000
#: Rows up to which a table of ids is broadcast to documents; beyond it, a join.
BROADCAST_IDS = 1_000_000
#: Sets of one block, and shingles of one block where the sets themselves are compared; a cell holds two blocks.
BLOCK, BLOCK_SHINGLES = 2_048, 4_000_000
#: Sets with the most candidates that every block of a large cluster holds.
HUBS = 32
#: Members of one group that a task holds before it passes them on as they come.
HELD = 500_000
#: Links that one task unites before labels spread between tasks.
LINKS_PER_TASK = 1_000_000
_K = [np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB)]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingles(text: str | None, n: int) -> np.ndarray:
    """The sorted distinct hashes of a text's n-word shingles; bytes.lower and bytes.split know ASCII only."""
    from xxhash import xxh3_64_intdigest

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))
    size = min(n, len(w))
    s = np.full(len(w) - size + 1, size, np.uint64)
    for k in range(size):
        s = (s + w[k : len(w) - size + 1 + k]) * _K[k % len(_K)]
        s ^= s >> np.uint64(29)
    return np.unique(mix(s))


class Bands:
    """Bands of set sizes with their largest difference and number of chunks, for similarity num / 100."""

    def __init__(self, num: int):
        self.num = num
        self.starts = [1]

    def _grow(self, size: int) -> None:
        while self.starts[-1] <= size:
            self.starts.append(max(self.starts[-1] + 1, int(self.starts[-1] * BAND_RATIO)))

    def of(self, size: int) -> Iterator[tuple[int, int, int]]:
        """(band, d, chunks) of each band that may hold the smaller set of a pair with a set of this size."""
        self._grow(size)
        least = -(-self.num * size // 100)
        for k in range(len(self.starts) - 1):
            if self.starts[k] <= size and self.starts[k + 1] > least:
                a = self.starts[k + 1] - 1
                d = self.difference(a, a * 100 // self.num)
                if d:  # else only equal sets link
                    yield k, d, int(CHUNKS_PER_DIFFERENCE * d) + 2

    def difference(self, a: int, b: int) -> int:
        """The largest symmetric difference with which sets of these sizes link."""
        return (a + b) * (100 - self.num) // (100 + self.num)


def chunk_keys(s: np.ndarray, bands: Bands) -> np.ndarray:
    out = []
    with np.errstate(over="ignore"):
        for band, d, chunks in bands.of(len(s)):
            place = ((s >> np.uint64(32)) * np.uint64(chunks) >> np.uint64(32)).astype(np.int64)
            weight = np.bincount(place, minlength=chunks)
            value = np.zeros(chunks, np.uint64)
            some = np.flatnonzero(weight)
            value[some] = np.bitwise_xor.reduceat(s, np.searchsorted(place, some))
            key = mix(value ^ mix(np.arange(chunks, dtype=np.uint64) + np.uint64(band << 40)))
            out.append(key[np.lexsort((key, weight))[chunks - d - 1 :]])
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def bit_sketch(s: np.ndarray) -> bytes:
    """Parities of a power of two of bits, at least 64 and one to two times the set's size; halves fold by XOR."""
    bits = max(64, 1 << int(len(s) - 1).bit_length())
    return np.packbits(np.bincount((s & np.uint64(bits - 1)).astype(np.int64), minlength=bits).astype(np.uint8) & 1).tobytes()


def _fold(sketch: np.ndarray, size: int) -> np.ndarray:
    while len(sketch) > size:
        half = len(sketch) // 2
        sketch = sketch[:half] ^ sketch[half:]
    return sketch


def sketches(docs: DataFrame, n: int, num: int) -> DataFrame:
    """doc_id, h (the text's hash), n_shingles, k1 and k2 (the set's identity), sketch, and keys: the chunks it sends.

    Within a task only the first of equal sets has keys.
    """

    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bands, seen, names = Bands(num), set(), ["doc_id", "h", "n_shingles", "k1", "k2", "sketch", "keys"]
        for batch in batches:
            rows = []
            for doc_id, h, text in zip(batch["doc_id"].to_numpy(), batch["h"].to_numpy(), batch["text"].to_numpy()):
                if len(rows) == ROWS:
                    yield pd.DataFrame(rows, columns=names)
                    rows = []
                s = shingles(text, n)
                k1, k2 = identity(s)
                first = len(s) > 0 and (k1, k2) not in seen
                if first and len(seen) < 1_000_000:
                    seen.add((k1, k2))
                keys = chunk_keys(s, bands).view(np.int64) if first else np.empty(0, np.int64)
                rows.append((doc_id, h, len(s), k1, k2, bit_sketch(s) if len(s) else b"", keys))
            yield pd.DataFrame(rows, columns=names)

    rows = docs.select(F.col("doc_id").cast("long"), text_hash().alias("h"), F.col("text").cast("string")).filter("doc_id is not null")
    return rows.mapInPandas(lean(make, True), "doc_id long, h long, n_shingles long, k1 long, k2 long, sketch binary, keys array<long>")


def text_hash() -> Column:
    return F.xxhash64(F.col("text").cast("string"))


def identity(s: np.ndarray) -> tuple[int, int]:
    """Two signed 64-bit sums over a set; 0 for the empty set."""
    if not len(s):
        return 0, 0
    with np.errstate(over="ignore"):
        sums = np.array([s.sum(dtype=np.uint64), mix(s ^ _K[0]).sum(dtype=np.uint64)])
    return tuple(sums.view(np.int64).tolist())


def _groups(sketched: DataFrame) -> DataFrame:
    """Distinct (g, m, node): the m >= 2 sets that sent the same chunk. g is a hash of the members, so that chunks with the same members
    make one group; of groups with more than HELD members, it is a hash of the chunk, and m is as if endless."""
    parts = max(1, int(sketched.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    sent = sketched.filter("size(keys) > 0").select(F.explode("keys").alias("key"), "k1").repartition(parts, "key").sortWithinPartitions("key", "k1")

    def star(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, own = np.empty(0, np.int64), np.empty(0, np.int64)
        endless = None  # the key whose members are passed on as they come
        done = False
        source = iter(batches)
        while not done:
            batch = next(source, None)
            done = batch is None
            if not done:
                key, own = np.concatenate([key, batch["key"].to_numpy()]), np.concatenate([own, batch["k1"].to_numpy()])
            if not len(key):
                continue
            if endless is not None or key[0] == key[-1] and len(key) > HELD:
                endless = key[0] if endless is None else endless
                stop = np.searchsorted(key, endless, side="right")
                if stop:
                    node = np.unique(own[:stop])
                    yield pd.DataFrame({"g": np.full(len(node), mix(np.array([endless]).view(np.uint64)).view(np.int64)[0]), "m": np.full(len(node), 2**62), "node": node})
                    key, own = key[stop:], own[stop:]
                if len(key):
                    endless = None
            end = len(key) if done else np.searchsorted(key, key[-1]) if len(key) else 0
            k, o = key[:end], own[:end]
            key, own = key[end:], own[end:]
            if not len(k):
                continue
            new = np.ones(len(k), bool)
            new[1:] = (k[1:] != k[:-1]) | (o[1:] != o[:-1])
            k, o = k[new], o[new]
            start = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
            size = np.diff(np.append(start, len(k)))
            with np.errstate(over="ignore"):
                g = mix(np.add.reduceat(mix(o.view(np.uint64) ^ _K[1]), start) + size.astype(np.uint64)).view(np.int64)
            _, first = np.unique(g, return_index=True)
            some = np.zeros(len(g), bool)
            some[first] = True
            some = np.repeat(some & (size > 1), size)
            if some.any():
                yield pd.DataFrame({"g": np.repeat(g, size)[some], "m": np.repeat(size, size)[some].astype(np.int64), "node": o[some]})

    return sent.mapInPandas(lean(star), "g long, m long, node long").distinct()


def unite(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of the links (a, b) and the smallest node of each one's component."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while True:
        lx, ly = label[x], label[y]
        apart = lx != ly
        if not apart.any():
            return nodes, nodes[label]
        np.minimum.at(label, np.maximum(lx, ly)[apart], np.minimum(lx, ly)[apart])
        while (label[label] != label).any():
            label = label[label]


def components(links: DataFrame) -> DataFrame:
    """(node, label): the smallest node that each node of the stored `links` (a, b) reaches.

    Tasks of at most LINKS_PER_TASK links unite what they have; labels then spread between tasks and jump until none
    changes.
    """

    def stars(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = list(batches)
        if held:
            node, label = unite(*(np.concatenate([x[c].to_numpy() for x in held]) for c in ("a", "b")))
            yield pd.DataFrame({"node": node, "label": label})

    tasks = -(-links.count() // LINKS_PER_TASK)
    dealt = links.select("a", "b")
    dealt = dealt.repartition(tasks, "a", "b") if tasks > 1 else dealt.coalesce(1)
    labels = materialize(dealt.mapInPandas(stars, "node long, label long"), "labels")
    if tasks <= 1:
        return labels
    apart = labels.filter("node <> label")
    both = materialize(apart.selectExpr("node as a", "label as b").union(apart.selectExpr("label as a", "node as b")).distinct(), "links")
    discard(labels)
    labels = materialize(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "labels")
    while True:
        near = both.join(labels, F.col("b") == F.col("node")).groupBy(F.col("a").alias("_n")).agg(F.min("label").alias("_near"))
        spread = labels.join(near, F.col("node") == F.col("_n"), "left").selectExpr("node", "label as old", "least(label, _near) as label")
        jump = labels.selectExpr("node as _j", "label as _to")
        after = materialize(spread.join(jump, F.col("label") == F.col("_j"), "left").selectExpr("node", "old", "least(label, _to) as label"), "labels")
        discard(labels)
        labels = after
        if after.filter("old <> label").isEmpty():
            discard(both)
            return labels


def _cell(lo: int, hi: int, own: np.ndarray, node: np.ndarray, comp: np.ndarray, n: np.ndarray, data: list[bytes], num: int, exact: bool) -> tuple[list[int], list[int]]:
    """Links (a, b) that join the components `comp` of the pairs of this cell that link, or without `exact` may link.

    With `exact`, data are the sets, else their bit sketches. The pairs are those of block lo with block hi.
    """
    sets = [np.frombuffer(x, np.uint64) for x in data] if exact else []
    sketch = [np.frombuffer(bit_sketch(x) if exact else x, np.uint8) for x in (sets if exact else data)]
    size = min(map(len, sketch))
    bits = np.stack([_fold(x, size) for x in sketch]).view(np.uint64)
    codes: list[np.ndarray] = []
    _, label = np.unique(comp, return_inverse=True)
    left = label.max() + 1
    a, b = [], []
    for k in range(len(node)):
        if left == 1:
            break
        if lo != hi and own[k] != lo:
            continue
        rest = np.flatnonzero(label != label[k])
        rest = rest[rest > k] if lo == hi else rest[own[rest] == hi]
        rest = rest[100 * np.minimum(n[rest], n[k]) >= num * np.maximum(n[rest], n[k])]
        if not len(rest):
            continue
        far = np.bitwise_count(bits[rest] ^ bits[k]).sum(axis=1, dtype=np.int64)
        rest = rest[far <= (n[rest] + n[k]) * (100 - num) // (100 + num)]
        if exact and len(rest):
            if not codes:  # shingles of one set of the cell alone, and those of all, need no comparison
                _, code, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
                place = np.where((count > 1) & (count < len(node)), np.cumsum((count > 1) & (count < len(node))), 0)
                codes = [x[x > 0] for x in np.split(place[code], np.cumsum([len(s) for s in sets])[:-1])]
                common, mark = int((count == len(node)).sum()) if len(node) > 1 else 0, np.zeros(place.max() + 1, np.int64)
            mark[codes[k]] = 1
            sizes = np.array([len(codes[i]) for i in rest])
            hits = np.concatenate([[0], np.cumsum(mark[np.concatenate([codes[i] for i in rest])])])
            ends = np.cumsum(sizes)
            both = common + hits[ends] - hits[ends - sizes]
            mark[codes[k]] = 0
            rest = rest[100 * both >= num * (n[rest] + n[k] - both)]
        if not len(rest):
            continue
        met, first = np.unique(label[rest], return_index=True)
        a += [int(node[k])] * len(met)
        b += node[rest[first]].tolist()
        label[np.isin(label, met)] = label[k]
        left -= len(met)
    return a, b


def _cells(rows: DataFrame, data: DataFrame, num: int, exact: bool) -> DataFrame:
    """The links (a, b) that the cells (g, lo, hi) of `rows` (g, lo, hi, own, node, comp) give; `data` has (node, n, data)."""
    parts = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    cells = rows.join(data, "node").select("g", "lo", "hi", "own", "node", "comp", "n", "data").repartition(parts, "g", "lo", "hi").sortWithinPartitions("g", "lo", "hi", "node")

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        source = iter(batches)
        while True:
            batch = next(source, None)
            if batch is not None:
                held = batch if held is None else pd.concat([held, batch], ignore_index=True)
            if held is not None and len(held):
                at = held[["g", "lo", "hi", "node"]].to_numpy()
                again = np.concatenate([[False], (at[1:] == at[:-1]).all(axis=1)])
                if again.any():
                    held, at = held[~again].reset_index(drop=True), at[~again]
                start = np.flatnonzero(np.concatenate([[True], (at[1:, :3] != at[:-1, :3]).any(axis=1)]))
                ends = np.append(start[1:], len(held)) if batch is None else start[1:]
                columns = [held[c].to_numpy() for c in ("own", "node", "comp", "n", "data")]
                a, b = [], []
                for i, j in zip(start.tolist(), ends.tolist()):
                    if j - i > 1:
                        x, y = _cell(*at[i, 1:3].tolist(), *(c[i:j] for c in columns), num, exact)
                        a, b = a + x, b + y
                held = None if batch is None else held.iloc[start[-1] :].reset_index(drop=True)
                if a:
                    yield pd.DataFrame({"a": a, "b": b})
            if batch is None:
                return

    return cells.mapInPandas(lean(work), "a long, b long")


def _block(count: str) -> str:
    return f"cast(pmod(xxhash64(node), {count}) as int)"


def _arranged(rows: DataFrame, weighed: bool) -> DataFrame:
    """(g, lo, hi, own, node, comp) for `rows` (g, node, comp, n): each pair of members of a group in different components meets in a cell.

    Of a group beyond one block the largest component is dealt to blocks of its own, which meet the other blocks but not each other.
    """
    per = rows.groupBy("g", "comp").agg(F.count("*").alias("c"), F.sum("n").alias("w"))
    whole = per.groupBy(F.col("g").alias("_g")).agg(F.sum("c").alias("_c"), F.sum("w").alias("_w"), F.max(F.struct("c", "comp", "w")).alias("_main"), F.count("*").alias("_comps"))
    blocks = (lambda c, w: f"greatest(1, cast(ceil(({c}) / {BLOCK}) as int), cast(ceil(({w}) / {BLOCK_SHINGLES}) as int))") if weighed else (lambda c, w: f"greatest(1, cast(ceil(({c}) / {BLOCK}) as int))")
    whole = whole.filter("_comps > 1").selectExpr("_g", "_main.comp as _first", f"{blocks('_c', '_w')} as _all", f"{blocks('_c - _main.c', '_w - _main.w')} as _rest", f"{blocks('_main.c', '_main.w')} as _most")
    dealt = rows.join(whole, F.col("g") == F.col("_g"))
    own = f"case when _all = 1 then 0 when comp = _first then _rest + {_block('_most')} else {_block('_rest')} end"
    others = "case when _all = 1 then array(0) when comp = _first then sequence(0, _rest - 1) else sequence(0, _rest + _most - 1) end"
    met = dealt.selectExpr("g", "node", "comp", f"{own} as own", f"explode({others}) as other")
    return met.selectExpr("g", "least(own, other) as lo", "greatest(own, other) as hi", "own", "node", "comp")


def _with_label(rows: DataFrame, comps: DataFrame) -> DataFrame:
    """`rows` with comp, the label of their node in `comps`, or the node itself."""
    return rows.join(comps.selectExpr("node as _n", "label as _l"), F.col("node") == F.col("_n"), "left").withColumn("comp", F.expr("coalesce(_l, node)")).drop("_n", "_l")


def _candidates(members: DataFrame, sketched: DataFrame, num: int) -> DataFrame:
    """Stored links (a, b) of sets that may link by size and bit sketch; every pair that does has both ends in one component of them."""
    # Each set in its largest group first: most groups then hold one component, and no pairs that are left to compare.
    first = members.groupBy("node").agg(F.max(F.struct("m", "g")).alias("x")).selectExpr("x.g as g", "node")
    many = first.groupBy(F.col("g").alias("_g")).agg(F.count("*").alias("_c")).filter("_c > 1")
    first = first.join(many, F.col("g") == F.col("_g")).selectExpr("g", f"{_block(f'cast(ceil(_c / {BLOCK}) as int)')} as lo", "node")
    found = materialize(_cells(first.selectExpr("g", "lo", "lo as hi", "lo as own", "node", "node as comp"), sketched, num, False), "links")
    comps = components(found)
    rows = materialize(_with_label(members.select("g", "node"), comps), "members")
    across = materialize(_arranged(rows.join(sketched.select("node", "n"), "node"), False), "cells")
    more = materialize(_cells(across, sketched, num, False).distinct(), "links")
    both = materialize(found.union(more), "links")
    discard(found, comps, rows, across, more)
    return both


def _linked(near: DataFrame, clusters: DataFrame, sets: DataFrame, num: int) -> DataFrame:
    """Stored (node, label) of the sets that links reach within the `clusters` (node, label); `sets` has (node, n, data)."""
    nodes = clusters.selectExpr("label as g", "node").join(sets.select("node", "n").distinct(), "node")
    whole = nodes.groupBy(F.col("g").alias("_g")).agg(F.expr(f"greatest(cast(ceil(count(*) / {BLOCK}) as int), cast(ceil(sum(n) / {BLOCK_SHINGLES}) as int))").alias("_blocks"))
    nodes = materialize(nodes.join(whole, F.col("g") == F.col("_g")).select("g", "node", "n", "_blocks"), "clusters")
    dealt = nodes.selectExpr("g", f"{_block('_blocks')} as lo", "node")
    large = nodes.filter("_blocks > 1")
    degree = near.selectExpr("a as node").union(near.selectExpr("b as node")).groupBy("node").agg(F.count("*").alias("_d"))
    hubs = large.join(degree, "node").selectExpr("g", "node", "_blocks", "row_number() over (partition by g order by _d desc, node) as _r").filter(f"_r <= {HUBS}")
    dealt = dealt.union(hubs.selectExpr("g", "explode(sequence(0, _blocks - 1)) as lo", "node"))
    found = materialize(_cells(dealt.selectExpr("g", "lo", "lo as hi", "lo as own", "node", "node as comp"), sets, num, True), "links")
    comps = components(found)
    across = materialize(_arranged(_with_label(large.select("g", "node", "n"), comps), True), "cells")
    if not across.isEmpty():
        more = materialize(_cells(across, sets, num, True), "links")
        joined = components(found.union(more))
        discard(comps, more)
        comps = joined
    discard(nodes, found, across)
    return comps


def classes(docs: DataFrame, n: int, num: int) -> DataFrame:
    """doc_id, h, n_shingles, label (equal for documents that links join, null without shingles) and component_id of each row with a doc_id."""
    with small_batches(docs.sparkSession):
        sent = materialize(sketches(docs, n, num), "keys")
    members = materialize(_groups(sent), "groups")
    marked = materialize(sent.drop("keys"), "sketches")
    discard(sent)
    reps = marked.filter("n_shingles > 0").groupBy("k1", "k2", "n_shingles").agg(F.min(F.struct("doc_id", "h")).alias("rep"), F.min("sketch").alias("data"))
    reps = materialize(reps.selectExpr("k1 as node", "k2", "n_shingles as n", "rep.doc_id as doc_id", "rep.h as h", "data"), "classes")
    near = _candidates(members, reps.select("node", "n", "data"), num)
    discard(members)
    clusters = components(near)

    ids = materialize(reps.join(clusters, "node", "left_semi").select("doc_id", "h").distinct(), "ids")
    texts = docs.select(F.col("doc_id").cast("long"), text_hash().alias("h"), F.col("text").cast("string"))
    texts = texts.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, ["doc_id", "h"], "left_semi").select("text")

    def hashes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = batch["text"].to_numpy()
            for at in range(0, len(texts), ROWS):
                found = [shingles(t, n) for t in texts[at : at + ROWS]]
                yield pd.DataFrame({"node": [identity(s)[0] for s in found], "n": [len(s) for s in found], "data": [s.tobytes() for s in found]})

    with small_batches(docs.sparkSession):
        sets = materialize(texts.mapInPandas(lean(hashes, True), "node long, n long, data binary"), "sets")
    discard(ids)
    comps = _linked(near, clusters, sets, num)
    discard(sets, near, clusters)

    named = _with_label(reps, comps).selectExpr("node", "k2 as c2", "n as cn", "doc_id as rep", "comp")
    least = named.groupBy(F.col("comp").alias("_comp")).agg(F.min("rep").alias("component"))
    named = materialize(named.join(least, F.col("comp") == F.col("_comp")).select("node", "c2", "cn", "comp", "component"), "classes")
    discard(reps, comps)
    out = marked.join(named, F.expr("k1 = node and k2 = c2 and n_shingles = cn"), "left")
    return out.selectExpr("doc_id", "h", "n_shingles", "comp as label", "coalesce(component, doc_id) as component_id")


def join(docs: DataFrame, n: int = 5, num: int = 80) -> DataFrame:
    """doc_id, n_shingles and component_id of every document: links are a Jaccard similarity of at least num / 100.

    component_id is the smallest doc_id that links reach. Null and empty texts have no shingles and stay alone; rows
    of equal text are one class; rows of one doc_id with different texts are told apart, each with its own links. Rows
    with null doc_id are left out; other columns are ignored. Sets are told apart, and shingles compared, by 64-bit hashes.
    """
    return classes(docs, n, num).select("doc_id", "n_shingles", "component_id")


def keep_one(docs: DataFrame, n: int = 5, num: int = 80) -> DataFrame:
    """The documents with their columns, one of each component: that with the smallest doc_id, then hash of the text.

    Of rows repeated with doc_id and text one stays. Rows with a null doc_id, and those without words, which belong to
    no component, all stay.
    """
    rows = materialize(classes(docs.select("doc_id", "text"), n, num).filter("label is not null").select("doc_id", "h", "label"), "labels")
    best = rows.groupBy(F.col("label").alias("_l")).agg(F.min(F.struct("doc_id", "h")).alias("_best"))
    gone = materialize(rows.join(best, F.col("label") == F.col("_l")).filter("doc_id <> _best.doc_id or h <> _best.h").selectExpr("doc_id as _d", "h as _t").distinct(), "ids")
    again = materialize(rows.groupBy(F.col("doc_id").alias("_d"), F.col("h").alias("_t")).count().filter("count > 1").select("_d", "_t"), "ids")
    discard(rows)

    def small(ids: DataFrame) -> DataFrame:
        return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids

    whole = rows_whole(docs, F.col("doc_id").cast("long").alias("_doc"), text_hash().alias("_hash"))
    same = F.expr("_doc = _d and _hash = _t")
    kept = whole.join(small(gone), same, "left_anti")
    if not again.isEmpty():
        repeated = kept.join(small(again), same, "left_semi").dropDuplicates(["_doc", "_hash"])
        kept = kept.join(small(again), same, "left_anti").unionByName(repeated)
    return kept.select("_row.*")


def op8_jaccard(spark, sf_dir: str) -> DataFrame:
    """Four-word shingles at a similarity of 0.85 over all documents; see `join` for nulls, empty texts, ties and repeated rows."""
    return join(table(spark, sf_dir, "documents").select("doc_id", "text"), 4, 85)
