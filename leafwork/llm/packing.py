"""Best-fit packing of token pieces into sequences: bin completion with branch and bound.

The search never sees documents. Pieces of one length are interchangeable, so the problem is fixed by a histogram of
at most `capacity` lengths, whatever the input's size. The driver completes bins over that histogram: around the
largest length left it enumerates the undominated fillings, prunes branches whose waste can no longer beat the best
packing so far, and keeps best-fit packings as incumbents. A filling applies as often as its lengths last, so a plan
has some thousand patterns at most. Executors then look up each piece by its rank among the pieces of its length.
"""

from __future__ import annotations

import bisect
import re
import struct
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafwork.llm.common import lean, materialize, small_batches, table

CAPACITY = 2048
#: Nodes of the branch and bound on the driver, over all branches.
SEARCH_NODES = 5_000
#: Steps of one enumeration of fillings, and fillings tried from one node.
FILL_STEPS, BRANCHES = 400, 3
#: Pieces of the longest filling that is tested for dominance.
TESTED_PIECES = 20
#: Words that a worker remembers with their ids, and pieces of words; up to three times as many of each.
CACHE_WORDS = 60_000
#: Pieces of one length and bucket that one task ranks, about.
BUCKET_ROWS = 50_000

# ---------------------------------------------------------------- tokens


class _Recent(dict):
    """`make` of a key, remembered for keys that came again while they were among the last `most` new ones; 3 * `most` keys at most,
    however long a text is."""

    def __init__(self, make: Callable[[str], bytes], most: int):
        super().__init__()
        self.make, self.most, self.older, self.once = make, most, {}, {}

    def __missing__(self, key: str) -> bytes:
        found = self.once.pop(key, None)
        if found is None and (found := self.older.get(key)) is None:
            if len(self.once) >= self.most:
                self.once.clear()
            found = self.once[key] = self.make(key)
            return found
        if len(self) >= self.most:
            self.older = dict(self)
            self.clear()
        self[key] = found
        return found

    def forget(self) -> None:
        for known in (self, self.older, self.once):
            known.clear()


class _WordIds:
    """Ids by white-space separated word: the tokenizer drops white space and never looks across it."""

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.words, self.pieces = _Recent(self.word, CACHE_WORDS), _Recent(self.piece, CACHE_WORDS)
        # The split pattern of the tokenizer file.
        self.pattern = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
        self.ascii = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")  # the same, of ASCII in lower case
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in printable]
        self.bytes = {b: chr(b) for b in printable} | {b: chr(256 + k) for k, b in enumerate(rest)}

    def piece(self, part: str) -> bytes:
        shown = part if part.isascii() and "\x7f" not in part else part.encode().decode("latin1").translate(self.bytes)
        ids = [t.id for t in self.model.tokenize(shown)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def word(self, word: str) -> bytes:
        # Latin letters are in NFC and lower-case one by one; a dotted capital I gains a mark, which is no letter.
        if word.isascii() or max(word) < "ɐ" and "\u0130" not in word:
            if word.isalpha():
                return self.pieces[word.lower()]
            if "<|" in word or not word.isprintable():
                return self.whole(word)
            pattern = self.ascii if word.isascii() else self.pattern
            return b"".join(map(self.pieces.__getitem__, pattern.findall(word.lower())))
        return self.whole(word)

    def text(self, text: str | None) -> bytes:
        if not text:
            return b""
        if any(c in text for c in "\x1c\x1d\x1e\x1f"):
            return self.whole(text)  # str.split() would drop these four
        return b"".join(map(self.words.__getitem__, text.split()))

    def forget(self) -> None:
        self.words.forget()
        self.pieces.forget()


_worker_ids: dict[str, _WordIds] = {}


def word_ids(path: str) -> _WordIds:
    if path not in _worker_ids:
        _worker_ids[path] = _WordIds(path)
    return _worker_ids[path]


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def token_pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Each document's ids with id 0 after them, cut at every `capacity` ids.

    One row per piece: doc_id, piece (from 0), start, length, ids_crc32 and, if asked for, ids (unsigned 32-bit,
    little-endian). Null and empty texts give one piece of the id 0 alone; a null doc_id stays null; repeated rows
    give their pieces each time; other columns of `docs` are ignored.
    """
    path = path or tokenizer_path()

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids_of = word_ids(path)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"].tolist(), batch["text"].tolist()):
                ids = ids_of.text(text) + b"\0\0\0\0"
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    rows.append((doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part), *((part,) if with_ids else ())))
            out = pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])])
            yield out.astype({"doc_id": "Int64"})
        ids_of.forget()  # the worker stays, for tasks of any stage

    kind = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInPandas(lean(cut, True), kind)


# ---------------------------------------------------------------- the plan


class _Lengths:
    """A multiset of lengths, sorted upwards, with the sum of what is left."""

    def __init__(self, counts: dict[int, int]):
        self.keys = sorted(k for k, n in counts.items() if n)
        self.counts = {k: counts[k] for k in self.keys}
        self.total = sum(k * n for k, n in self.counts.items())

    def take(self, lengths: list[int], times: int) -> None:
        for x in lengths:
            self.total -= x * times
            self.counts[x] -= times
            if not self.counts[x]:
                del self.counts[x]
                self.keys.pop(bisect.bisect_left(self.keys, x))

    def give(self, lengths: list[int], times: int) -> None:
        for x in lengths:
            self.total += x * times
            if x not in self.counts:
                self.counts[x] = 0
                bisect.insort(self.keys, x)
            self.counts[x] += times

    def times(self, lengths: list[int]) -> int:
        """How often a bin of these lengths can be filled."""
        return min(self.counts.get(x, 0) // lengths.count(x) for x in set(lengths))


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """Bins that any packing needs: the larger of the sum's bound and the bounds that set small lengths aside."""
    total = sum(k * n for k, n in counts.items())
    best = -(-total // capacity)
    keys = sorted(counts)
    for small in [0, *[k for k in keys if 2 * k <= capacity]]:
        big = sum(counts[k] for k in keys if k > capacity - small)
        half = [k for k in keys if capacity / 2 < k <= capacity - small]
        n_half = sum(counts[k] for k in half)
        rest = sum(k * counts[k] for k in keys if small <= k <= capacity / 2) if small else sum(k * counts[k] for k in keys if 2 * k <= capacity)
        room = n_half * capacity - sum(k * counts[k] for k in half)
        best = max(best, big + n_half + max(0, -(-(rest - room) // capacity)))
    return best


def dominates(a: list[int], b: list[int]) -> bool:
    """Whether b's lengths can be put into the places that a's lengths leave, several into one: then a does at least as well as b.

    Not tested for b of more than TESTED_PIECES pieces, which costs search steps only.
    """
    if len(a) > len(b) or sum(b) > sum(a) or len(b) > TESTED_PIECES:
        return False
    rest = sorted(b, reverse=True)

    def put(k: int, rooms: tuple[int, ...]) -> bool:
        if k == len(rest):
            return True
        return any(put(k + 1, (*rooms[:r], rooms[r] - rest[k], *rooms[r + 1 :])) for r in range(len(rooms)) if rooms[r] >= rest[k] and rooms[r] not in rooms[:r])

    return put(0, tuple(sorted(a, reverse=True)))


def fillings(left: _Lengths, room: int, steps: int = FILL_STEPS, most: int = BRANCHES) -> list[list[int]]:
    """The first `most` undominated fillings of `room` that `steps` steps find, least waste first, then fewer and larger lengths.

    Lengths are taken downwards. Where one length fills what is left exactly, every other way to fill that is dominated by
    it. Of what is found, a filling that another one dominates is dropped (Martello and Toth's test). With enough steps, and
    `most` as large, these are all undominated fillings. The filling at which the steps run out is completed by largest
    lengths, so none leaves room that a length left would fit.
    """
    if not left.keys or left.keys[0] > room:
        return [[]]
    found: list[tuple[int, int, list[int]]] = []
    budget = steps

    def completed(room: int, chosen: list[int]) -> tuple[int, list[int]]:
        out, used = list(chosen), Counter(chosen)
        at = bisect.bisect_right(left.keys, room) - 1
        while at >= 0:
            x = left.keys[at]
            n = min(room // x, left.counts[x] - used[x])
            out += [x] * n
            room -= x * n
            at = min(at, bisect.bisect_right(left.keys, room)) - 1
        return room, out

    def go(room: int, top: int, chosen: list[int]) -> None:
        nonlocal budget
        budget -= 1
        used = Counter(chosen)
        if room <= top and left.counts.get(room, 0) > used[room]:
            found.append((0, len(chosen) + 1, [*chosen, room]))
            return
        at = bisect.bisect_right(left.keys, min(room, top)) - 1
        none = True
        while at >= 0 and budget > 0:
            x = left.keys[at]
            if left.counts[x] > used[x]:
                none = False
                go(room - x, x, [*chosen, x])
            at -= 1
        if none:
            if budget <= 0:
                room, chosen = completed(room, chosen)
            if not any(x <= room and left.counts[x] > Counter(chosen)[x] for x in left.keys[: bisect.bisect_right(left.keys, room)]):
                found.append((room, len(chosen), chosen))

    go(room, room, [])
    kept: list[list[int]] = []
    for _, _, f in sorted(found, key=lambda x: (x[0], x[1], [-v for v in x[2]])):
        if len(kept) >= most:
            break
        if f not in kept and not any(dominates(k, f) for k in kept):
            kept = [k for k in kept if not dominates(f, k)]
            kept.append(f)
    return kept or [[]]


def plan_bins(counts: dict[int, int], capacity: int = CAPACITY, nodes: int = SEARCH_NODES) -> list[tuple[list[int], int]]:
    """Patterns (lengths of one sequence, how many such sequences), by branch and bound over bin completions.

    A depth-first search: the first branch of every node is the filling with least waste, so its first leaf is a
    best-fit packing and the first incumbent. A branch ends when its waste leaves no packing with fewer bins than the
    incumbent. The search ends at the lower bound or after `nodes` nodes, with the best incumbent: `lower_bound` says how far
    from the least it can be at most.
    """
    left = _Lengths(counts)
    bound = lower_bound(counts, capacity)
    best: list[tuple[list[int], int]] | None = None
    best_bins = sum(counts.values()) + 1
    path: list[tuple[list[int], int]] = []
    bins = 0
    budget = nodes

    def options() -> Iterator[tuple[list[int], int]]:
        top = left.keys[-1]
        left.take([top], 1)
        tries = [[top, *f] for f in fillings(left, capacity - top)]
        left.give([top], 1)
        for bin_ in tries:
            yield bin_, left.times(bin_)

    stack: list[Iterator[tuple[list[int], int]]] = []
    if not left.keys:
        return []
    stack.append(options())
    while stack and budget > 0:
        step = next(stack[-1], None)
        if step is None:
            stack.pop()
            if path and len(path) >= len(stack) and stack:
                undo, times = path.pop()
                left.give(undo, times)
                bins -= times
            continue
        budget -= 1
        bin_, times = step
        left.take(bin_, times)
        path.append(step)
        bins += times
        if bins + -(-left.total // capacity) >= best_bins or not left.keys:
            if not left.keys and bins < best_bins:
                best, best_bins = list(path), bins
                if best_bins <= bound:
                    break
            undo, times = path.pop()
            left.give(undo, times)
            bins -= times
            continue
        stack.append(options())
    if best is None:  # the budget ended within the first branch: complete it by best fit
        while left.keys:
            bin_, times = next(options())
            left.take(bin_, times)
            path.append((bin_, times))
        best = path
    return best


# ---------------------------------------------------------------- the operator


def pack(pieces: DataFrame, capacity: int = CAPACITY, nodes: int = SEARCH_NODES) -> DataFrame:
    """`pieces` (length, doc_id, piece and more) with sequence_id and offset; `length` must be 1 to `capacity`.

    Sequences are gapless from offset 0. Pieces of one length take their slots in the order of a hash bucket, doc_id
    and piece, so no task ranks all pieces of a frequent length. Repeated rows are packed each. An empty table gives
    an empty table.
    """
    with small_batches(pieces.sparkSession):
        pieces = materialize(pieces, "pieces")
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most `capacity` rows
    slots: dict[int, list[tuple[int, int, int]]] = {}
    next_rank = dict.fromkeys(counts, 0)
    base = 0
    for bin_, times in plan_bins(counts, capacity, nodes):
        at = 0
        for x in bin_:
            slots.setdefault(x, []).append((next_rank[x], base, at))
            next_rank[x] += times
            at += x
        base += times
    table_ = {x: np.array(rows, dtype=np.int64) for x, rows in slots.items()}

    buckets = max(16, sum(counts.values()) // BUCKET_ROWS)
    dealt = pieces.withColumn("_bucket", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets)).cast("int"))
    sizes = dealt.groupBy("length", "_bucket").agg(F.count("*").alias("_n"))
    before = sizes.selectExpr("length as _length", "_bucket as _b", "sum(_n) over (partition by length order by _bucket rows between unbounded preceding and 1 preceding) as _before")
    ranked = dealt.selectExpr("*", "row_number() over (partition by length, _bucket order by doc_id, piece) - 1 as _local")
    joined = ranked.join(before, (F.col("length") == F.col("_length")) & (F.col("_bucket") == F.col("_b")), "left")
    ready = joined.select(*pieces.columns, (F.col("_local") + F.coalesce("_before", F.lit(0))).cast("long").alias("_rank"))

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rank, length = batch.pop("_rank").to_numpy(), batch["length"].to_numpy()
            sequence, offset = np.empty(len(batch), np.int64), np.empty(len(batch), np.int64)
            for x in np.unique(length):
                rows, own = table_[int(x)], length == x
                slot = rows[np.searchsorted(rows[:, 0], rank[own], side="right") - 1]
                sequence[own], offset[own] = slot[:, 1] + rank[own] - slot[:, 0], slot[:, 2]
            batch["sequence_id"], batch["offset"] = sequence, offset
            yield batch

    kind = ", ".join(f"{n} {t}" for n, t in pieces.dtypes) + ", sequence_id long, offset long"
    return ready.mapInPandas(place, kind)


def sequences(packed: DataFrame) -> DataFrame:
    """The sequences themselves, from packed pieces with ids: sequence_id, ids (binary), length, doc_ids."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids", "doc_id")))
    rows = packed.groupBy("sequence_id").agg(parts.alias("parts"))
    return rows.select("sequence_id", F.concat(F.lit(b""), F.expr("aggregate(parts, cast('' as binary), (a, p) -> concat(a, p.ids))")).alias("ids"), F.expr("cast(aggregate(parts, 0, (a, p) -> a + length(p.ids)) / 4 as long)").alias("length"), F.expr("transform(parts, p -> p.doc_id)").alias("doc_ids"))


def op1_pack(spark, sf_dir: str) -> DataFrame:
    """Every document in as few sequences of at most 2048 ids as the search finds.

    A null or empty text is one piece of the id 0; repeated rows are packed each; an empty table gives no rows.
    """
    return pack(token_pieces(table(spark, sf_dir, "documents"))).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
