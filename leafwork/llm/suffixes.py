"""Removal of repeated byte strings by external induced sorting of suffixes.

Only some suffixes are sorted directly. In each window of LENGTH bytes the position whose next GRAM bytes hash least is
an S-position (leftmost on ties); equal windows choose the same one, as the choice looks at nothing else. S-suffixes
meet by their first GRAM bytes, are sorted by Spark's external sort, whose spilled runs are merged through a priority
queue on disk, and carry the common-prefix length to their neighbours. All suffixes before an S-position up to the one
before it are then induced: one step to the left, the order follows from the preceding byte and the order so far, and
the common prefix from the range minimum of the prefixes carried. A suffix that shares LENGTH bytes with a neighbour
repeats. Equal contexts are counted before anything is sorted, so copies cost a count; only S-suffixes whose beginning
occurs with several contexts reach the sort, and shards hold rows of about 400 bytes, never texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafwork.llm.common import lean, materialize, table
from leafwork.llm.jaccard import mix

LENGTH, GRAM = 200, 64
#: Bytes of text that are hashed together in a task.
SLICE = 1 << 18
#: Rows that a worker makes before it hands them on.
ROWS = 10_000
#: Texts up to which the ids of wanted texts are broadcast to fetch them; beyond it, a join.
BROADCAST_IDS = 1_000_000
#: Contexts of one beginning that are induced in memory; a beginning with more has its windows counted instead.
GROUP_ROWS = 200_000


def _grams(b: np.ndarray) -> np.ndarray:
    """64-bit hashes of the GRAM bytes from each position, by doubling."""
    h = b.astype(np.uint64)
    h = h[:-1] | h[1:] << np.uint64(8)
    h = h[:-2] | h[2:] << np.uint64(16)
    h = h[:-4] | h[4:] << np.uint64(32)
    for k in (8, 16, 32):
        h = mix(h[:-k] * np.uint64(0x9E3779B97F4A7C15) + h[k:])
    return h


def _least(keys: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each `width` neighbouring keys, by doubling."""
    have = 1
    while have * 2 <= width:
        keys = np.minimum(keys[:-have], keys[have:])
        have *= 2
    return np.minimum(keys[: len(keys) - (width - have)], keys[width - have :]) if width > have else keys


def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Rows of about SLICE bytes of text at once, and their texts: a batch is held as it came, and only these as objects."""
    for batch in batches:
        text = pc.fill_null(batch.column("text").cast(pa.large_binary()), b"")
        ends = np.cumsum(pc.binary_length(text).to_numpy(zero_copy_only=False))
        at = 0
        while at < len(ends):
            end = max(at + 1, int(np.searchsorted(ends, SLICE + (ends[at - 1] if at else 0), "right")))
            yield batch.slice(at, end - at), text.slice(at, end - at).to_pylist()
            at = end


def positions(texts: list[bytes], length: int = LENGTH) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For texts of at least `length` bytes: (index, first window, last window, S-position, gram hash) of each run of
    windows that share an S-position, by position in the text. A text beyond SLICE is hashed by pieces; a run that crosses
    their border comes as two."""
    assert length > GRAM
    at = 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and (end == at or size + len(texts[end]) <= SLICE):
            size += len(texts[end])
            end += 1
        # A text beyond SLICE stands alone; windows across a border belong to the piece before it.
        for lead in range(0, size, SLICE):
            part = [texts[at][lead : lead + SLICE + length - 1]] if size > SLICE else texts[at:end]
            joined = np.frombuffer(b"".join(part), np.uint8)
            starts = np.cumsum([0, *map(len, part)])
            if len(joined) < length:
                continue
            h = _grams(joined)
            keys = (h >> np.uint64(32) << np.uint64(32)) | np.arange(len(h), dtype=np.uint64)
            chosen = (_least(keys, length - GRAM + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
            for k in range(len(part)):
                a, b = starts[k], starts[k + 1] - length + 1
                if b <= a:
                    continue
                own = chosen[a:b]
                new = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
                last = np.append(new[1:], len(own)) - 1
                yield at + k, lead + new, lead + last, lead + own[new] - a, h[own[new]]
        at = end


def runs(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """A row per run of windows with one S-position: core (its gram hash), full (hash of all bytes of the run's windows
    and the place of the S-position in them), doc and uid (the text's document and hash), lo (first window), least and most
    (bytes from a window's start to the S-position)."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_64_intdigest

        kinds = dict(core=np.int64, full=np.int64, doc=np.int64, uid=np.int64, lo=np.int64, least=np.int32, most=np.int32)
        rows = lambda out: pa.RecordBatch.from_pydict({c: np.concatenate(x).astype(kind, copy=False) for (c, kind), x in zip(kinds.items(), zip(*out))})
        for part, texts in sliced(batches):
            ids, uids = (part.column(c).to_numpy() for c in ("doc", "uid"))
            out, held = [], 0
            for k, first, last, s, core in positions(texts, length):
                text, least, most = texts[k], s - last, s - first
                full = [xxh3_64_intdigest(text[a : b + length], c) for a, b, c in zip(first.tolist(), last.tolist(), most.tolist())]
                out.append((core.view(np.int64), np.array(full, np.uint64).view(np.int64), np.full(len(s), ids[k]), np.full(len(s), uids[k]), first, least, most))
                held += len(s)
                if held >= ROWS:
                    yield rows(out)
                    out, held = [], 0
            if out:
                yield rows(out)

    return docs.select("doc", "uid", "text").mapInArrow(lean(find, True), "core long, full long, doc long, uid long, lo long, least int, most int")


def _fetch(docs: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """core, full, n, least, most, right (bytes from the S-position) and left (the bytes before it, nearest first)."""
    asked = materialize(wanted.groupBy("doc", "uid").agg(F.collect_list(F.struct("core", "full", "n", "lo", "least", "most")).alias("asked")), "asked")
    some = asked.select("doc", "uid")
    texts = docs.select("doc", "uid", "text").join(F.broadcast(some) if asked.count() <= BROADCAST_IDS else some, ["doc", "uid"], "left_semi").dropDuplicates(["doc", "uid"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.schema([("core", pa.int64()), ("full", pa.int64()), ("n", pa.int64()), ("least", pa.int32()), ("most", pa.int32()), ("right", pa.binary()), ("left", pa.binary())])
        for part, texts in sliced(batches):
            rows = []
            for text, asks in zip(texts, part.column("asked")):
                for first in range(0, len(asks.values), ROWS):
                    for x in asks.values.slice(first, ROWS).to_pylist():
                        s = x["lo"] + x["most"]
                        rows.append(x | {"right": text[s : s - x["least"] + length], "left": text[x["lo"] : s][::-1]})
                    if len(rows) >= ROWS:
                        yield pa.RecordBatch.from_pylist(rows, kind)
                        rows = []
            if rows:
                yield pa.RecordBatch.from_pylist(rows, kind)

    return texts.join(asked, ["doc", "uid"]).select("text", "asked").mapInArrow(lean(cut, True), "core long, full long, n long, least int, most int, right binary, left binary")


class _RangeMinimum:
    def __init__(self, x: np.ndarray):
        self.levels = [x]
        while 2 << len(self.levels) - 1 <= len(x):
            half = 1 << len(self.levels) - 1
            self.levels.append(np.minimum(self.levels[-1][:-half], self.levels[-1][half:]))

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Minima over positions a to b, both inclusive, a <= b."""
        level = np.frexp((b - a + 1).astype(np.float64))[1] - 1
        out = np.empty(len(a), self.levels[0].dtype)
        for k in np.unique(level):
            own = level == k
            out[own] = np.minimum(self.levels[k][a[own]], self.levels[k][b[own] - (1 << int(k)) + 1])
        return out


def _matrix(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.array([len(x) for x in parts], np.int64)
    width = max(1, int(sizes.max(initial=0)))
    return np.frombuffer(b"".join(x.ljust(width, b"\0") for x in parts), np.uint8).reshape(len(parts), width), sizes


def induce(core: np.ndarray, right: list[bytes], left: list[bytes], least: np.ndarray, most: np.ndarray, length: int = LENGTH) -> list[list[tuple[int, int]]]:
    """For S-suffixes sorted by (core, right): by suffix the ranges of steps to the left at which `length` bytes recur
    with another of the suffixes.

    Suffixes stay in one class while their cores and the bytes stepped over agree. In a class they keep the order of
    their right contexts, which is what sorting by preceding byte and order so far gives, so the common prefix of
    neighbours is a range minimum of the prefixes carried from the first sort. A class of one ends.
    """
    m = len(core)
    rights, rsize = _matrix(right)
    lefts, _ = _matrix(left)
    carried = np.zeros(m, np.int64)
    if m > 1:
        width = np.minimum(rsize[1:], rsize[:-1])
        differ = rights[1:] != rights[:-1]
        first = np.where(differ.any(axis=1), differ.argmax(axis=1), rights.shape[1])
        carried[1:] = np.where(core[1:] == core[:-1], np.minimum(first, width), 0)
    minimum = _RangeMinimum(carried)
    live = np.arange(m)
    label = np.cumsum(np.concatenate([[0], core[1:] != core[:-1]])) if m else live
    hits = np.zeros((m, int(most.max(initial=0)) + 2), bool)
    for step in range(int(most.max(initial=0)) + 1):
        if step:
            keep = most[live] >= step
            live, label = live[keep], label[keep]
            key = label * 256 + lefts[live, step - 1] if len(live) else label
            order = np.argsort(key, kind="stable")
            live, key = live[order], key[order]
            label = np.cumsum(np.concatenate([[0], key[1:] != key[:-1]])) if len(live) else key
        if len(live) < 2:
            break
        same = np.flatnonzero(label[1:] == label[:-1])
        pair = minimum.of(live[same] + 1, live[same + 1])
        again = same[pair >= length - step]
        hits[live[again], step] = hits[live[again + 1], step] = True
        alone = np.ones(len(live), bool)
        alone[same] = alone[same + 1] = False
        live, label = live[~alone], label[~alone]
    hits[np.arange(hits.shape[1])[None, :] < least[:, None]] = False
    out = []
    for k in range(m):
        x = np.flatnonzero(np.diff(np.concatenate([[0], hits[k].astype(np.int8), [0]])))
        out.append(list(zip(x[::2].tolist(), (x[1::2] - 1).tolist())))
    return out


def _induced(rows: DataFrame, length: int) -> DataFrame:
    """core, full, from_step, to_step from rows of `_fetch`, whole cores at a time."""
    parts = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    shards = rows.repartition(parts, "core").sortWithinPartitions("core", "right")

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        source = iter(batches)
        while True:
            batch = next(source, None)
            if batch is not None and len(batch):
                held.append(batch)
                cores = batch["core"].to_numpy()
                end = int(np.searchsorted(cores == cores[-1], True)) if cores[0] != cores[-1] else 0
                if not end and (len(held) == 1 or held[0]["core"].iloc[0] == cores[-1]):
                    continue
                full = pd.concat([*held[:-1], batch.iloc[:end]])
                held = [batch.iloc[end:]]
            elif batch is None:
                full, held = pd.concat(held) if held else None, []
            else:
                continue
            if full is not None and len(full):
                ranges = induce(full["core"].to_numpy(), full["right"].tolist(), full["left"].tolist(), full["least"].to_numpy(), full["most"].to_numpy(), length)
                out = [(c, f, a, b) for c, f, own in zip(full["core"].tolist(), full["full"].tolist(), ranges) for a, b in own]
                if out:
                    yield pd.DataFrame(out, columns=["core", "full", "from_step", "to_step"])
            if batch is None:
                return

    return shards.mapInPandas(lean(work), "core long, full long, from_step int, to_step int")


def _counted(rows: DataFrame, length: int) -> DataFrame:
    """The same for cores with very many contexts: windows are counted by 128-bit hashes, so no group is gathered."""

    def windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from xxhash import xxh3_128_digest

        for batch in batches:
            for row in batch.itertuples():
                whole = row.left[::-1] + row.right
                steps = range(row.least, row.most + 1)
                yield pd.DataFrame({"core": row.core, "full": row.full, "step": list(steps), "w": [xxh3_128_digest(whole[row.most - o : row.most - o + length]) for o in steps]})

    each = rows.mapInPandas(lean(windows), "core long, full long, step int, w binary")
    again = each.groupBy("core", "step", "w").agg(F.count("*").alias("_n")).filter("_n > 1").selectExpr("core as _c", "step as _s", "w as _w")
    return each.join(again, F.expr("core = _c and step = _s and w = _w")).selectExpr("core", "full", "step as from_step", "step as to_step")


def repeated(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc, uid, spans: array<struct<a: long, b: long>> of bytes covered by repeated strings; spans may overlap."""
    found = materialize(runs(docs, length), "runs")
    # Stored, so that the join below reads plain exchanges on both sides and Spark can split a frequent core's rows.
    twice = materialize(found.groupBy("core").agg(F.count("*").alias("_n")).filter("_n > 1").select("core"), "twice")
    rows = materialize(found.join(twice, "core", "left_semi"), "contested")
    contexts = materialize(rows.groupBy("core", "full").agg(F.count("*").alias("n"), F.min(F.struct("doc", "uid", "lo", "least", "most")).alias("at")).select("core", "full", "n", "at.*"), "contexts")
    mixed = materialize(contexts.groupBy("core").agg(F.count("*").alias("_m"), F.min("n").alias("_least")).filter("_m > 1 and _least = 1").select(F.col("core").alias("_core"), "_m"), "mixed")
    wanted = contexts.join(mixed, F.col("core") == F.col("_core"))
    texts = materialize(_fetch(docs, wanted.drop("_core", "_m"), length), "contexts")
    large = mixed.filter(F.col("_m") > GROUP_ROWS).select(F.col("_core").alias("core"))
    if large.limit(1).count():
        induced = _induced(texts.join(large, "core", "left_anti"), length).unionByName(_counted(texts.join(large, "core", "left_semi"), length))
    else:
        induced = _induced(texts, length)
    copies = contexts.filter("n > 1").selectExpr("core", "full", "least as from_step", "most as to_step")
    once = contexts.filter("n = 1").select("core", "full")
    steps = materialize(copies.unionByName(induced.join(once, ["core", "full"], "left_semi")), "steps").selectExpr("core as _c", "full as _f", "from_step", "to_step")
    hit = rows.join(steps, F.expr("core = _c and full = _f")).selectExpr("doc", "uid", f"named_struct('a', lo + most - to_step, 'b', lo + most - from_step + {length}) as s")
    return hit.groupBy("doc", "uid").agg(F.collect_list("s").alias("spans"))


def remove(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept (binary) of every row, without each byte in a repeated string.

    Strings are compared as they stand in the input. Null and empty texts have no bytes; a text shorter than `length`
    keeps all. Of repeated rows each is another place of the same strings, so all lose them. Strings never cross rows.
    Rows are told apart by doc_id and the text's hash, so rows that agree in both share their spans.
    """
    keyed = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).withColumn("doc", F.coalesce("doc_id", F.lit(-1))).withColumn("uid", F.xxhash64("text"))
    spans = materialize(repeated(keyed, length), "spans")
    joined = keyed.join(spans, ["doc", "uid"], "left").select("doc_id", "text", "spans")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.binary())])
        for part, texts in sliced(batches):
            rows = []
            for doc_id, text, own in zip(part.column("doc_id").to_pylist(), texts, part.column("spans").to_pylist()):
                merged: list[list[int]] = []
                for s in sorted((x["a"], x["b"]) for x in own) if own is not None else ():
                    if merged and s[0] <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], s[1])
                    else:
                        merged.append(list(s))
                kept, at = [], 0
                for a, b in merged:
                    kept.append(text[at:a])
                    at = b
                kept = b"".join([*kept, text[at:]])
                rows.append((doc_id, len(text), len(text) - len(kept), len(merged), kept))
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows), kind)], schema=kind)

    return joined.mapInArrow(lean(cut, True), "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def op9_suffixes(spark, sf_dir: str) -> DataFrame:
    """Bytes in 200-byte strings that occur more than once, over all documents; see `remove` for nulls and repeated rows."""
    rows = remove(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
