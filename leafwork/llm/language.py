"""Language ID by cross-parsing entropy.

For each language a suffix automaton of labelled text is built once. A text is parsed from left to right into the
longest phrases that occur in a language's labelled text; the language that needs the fewest phrases, normalised by the
text's length, wins. A greedy parse only follows transitions and starts again at the root when there is none, so each
automaton becomes one dense table of (state, byte) with the restart folded in, and many segments of text step through it
together. Texts are lower-case letters and marks in UTF-8, so letters of any script are told apart, and a table has only the bytes that
its language uses. Segments are cut every SEGMENT bytes of the whole text, which adds at most one phrase a segment, to
every language alike.
"""

from __future__ import annotations

import sys
import unicodedata
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafwork.llm.common import table

#: Labelled bytes by language that an automaton holds, documents by language that they are taken from, and bytes of one
#: piece: pieces come from hashed places all over each document.
TRAIN_BYTES = 24_000
TRAIN_DOCS = 64
PIECE = 96
SEGMENT = 512
#: Segments that step together.
WIDTH = 16_384


@lru_cache(1)
def _kinds() -> np.ndarray:
    """By code point 2 for letters, 1 for marks, else 0."""
    return np.array([{"L": 2, "M": 1}.get(unicodedata.category(chr(c))[0], 0) for c in range(sys.maxunicode + 1)], np.uint8)


def _clean(text: str) -> bytes:
    """Lower case in UTF-8, with each run of anything but letters and marks as one space; empty if there is no letter."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    kind = _kinds()[codes]
    if not (kind == 2).any():
        return b""
    part = kind > 0
    keep = part.copy()
    keep[1:] |= part[:-1]
    return np.where(part, codes, 32)[keep].astype(np.uint32).tobytes().decode("utf-32-le").strip().encode()


class Automaton:
    """Suffix automaton of a text of small integers, as a dense table of (next state * 2 + whether a phrase ended)."""

    def __init__(self, symbols: list[int], classes: int):
        link, length, step = [-1], [0], [{}]
        last = 0
        for c in symbols:
            new = len(length)
            length.append(length[last] + 1)
            link.append(0)
            step.append({})
            at = last
            while at >= 0 and c not in step[at]:
                step[at][c] = new
                at = link[at]
            if at >= 0:
                other = step[at][c]
                if length[at] + 1 == length[other]:
                    link[new] = other
                else:
                    clone = len(length)
                    length.append(length[at] + 1)
                    link.append(link[other])
                    step.append(dict(step[other]))
                    while at >= 0 and step[at].get(c) == other:
                        step[at][c] = clone
                        at = link[at]
                    link[other] = link[new] = clone
            last = new
        table_ = np.full((len(step), classes), -1, np.int32)
        for s, steps in enumerate(step):
            for c, to in steps.items():
                table_[s, c] = to
        root = np.where(table_[0] < 0, 0, table_[0])
        # A class that never occurs is a phrase of its own: back at the root, one more phrase.
        ended = table_ < 0
        out = np.where(ended, root[None, :] * 2 + 1, table_ * 2)
        out[0] = np.where(table_[0] < 0, 1, root * 2 + 1)  # each phrase counts where it begins
        later = ended.copy()
        later[0] = False
        out[1:] = np.where(later[1:], np.where(table_[0] < 0, 1, root * 2 + 1)[None, :], out[1:])
        self.table = np.ascontiguousarray(out.astype(np.int32).ravel())


class Model:
    """Automata by language, each over the bytes of its own text."""

    def __init__(self, texts: dict[str, bytes]):
        self.languages = sorted(texts)
        self.tables, self.codes, self.classes = [], [], []
        for name in self.languages:
            text = np.frombuffer(texts[name], np.uint8)
            codes = np.zeros(256, np.int32)  # 0 pads, the last is any byte that the language doesn't have
            own = np.unique(text)
            codes[1:] = len(own) + 1
            codes[own] = np.arange(1, len(own) + 1)
            full = Automaton(codes[text].tolist(), len(own) + 2).table.reshape(-1, len(own) + 2)
            full[:, 0] = 0  # padding goes to the root and counts nothing
            self.tables.append(np.ascontiguousarray(full.ravel()))
            self.codes.append(codes)
            self.classes.append(len(own) + 2)

    def phrases(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Phrases of each text by language, and the texts' lengths in bytes, for cleaned texts."""
        counts = np.zeros((len(texts), len(self.languages)), np.int64)
        sizes = np.array([len(t) for t in texts], np.int64)
        owner = np.repeat(np.arange(len(texts)), -(-sizes // SEGMENT))
        joined = b"".join(t + b"\0" * (-len(t) % SEGMENT) for t in texts)
        if not joined:
            return counts, sizes
        grid = np.frombuffer(joined, np.uint8).reshape(-1, SEGMENT)
        for at in range(0, len(grid), WIDTH):
            columns = np.ascontiguousarray(grid[at : at + WIDTH].T)
            for k, steps in enumerate(self.tables):
                state = np.zeros(columns.shape[1], np.int32)
                found = np.zeros(columns.shape[1], np.int32)
                for column in columns:
                    got = steps.take(state * self.classes[k] + self.codes[k].take(column))
                    found += got & 1
                    state = got >> 1
                np.add.at(counts[:, k], owner[at : at + WIDTH], found)
        return counts, sizes


def labelled(docs: DataFrame, train_docs: int = TRAIN_DOCS) -> DataFrame:
    """A sample of (lang, text): by language about `train_docs` documents with text, by smallest hash of doc_id.

    Counts by language give the share of hashes to keep, so neither a task nor the driver meets all rows of a language.
    """
    rows = docs.filter("lang is not null and text is not null and text <> ''").select("doc_id", "lang", "text", F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)).alias("_h"))
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}  # one row per language
    if not counts:
        return rows.select("lang", "text", F.lit(1).alias("_n"))
    keep = None
    for lang, n in counts.items():
        own = (F.col("lang") == lang) & (F.col("_h") < int((1 << 30) * min(1.0, 2.0 * train_docs / n)) + 1)
        keep = own if keep is None else keep | own
    return rows.filter(keep).selectExpr("lang", "text", "row_number() over (partition by lang order by _h, doc_id, text) as _n").filter(F.col("_n") <= train_docs)


def pieces(text: str, most: int = TRAIN_BYTES) -> bytes:
    """At most `most` bytes of a cleaned text: all of it, or pieces from places that a hash picks from the whole text."""
    whole = _clean(text)
    if len(whole) <= most:
        return whole
    cut = [whole[i : i + PIECE] for i in range(0, len(whole), PIECE)]
    order = sorted(range(len(cut)), key=lambda k: (zlib.crc32(cut[k], k), k))
    return b"".join(cut[k] for k in order)[:most]


def shares(sizes: list[int], most: int) -> list[int]:
    """What each of several texts gives to a sum of `most`: alike, and what short ones can't give falls to longer ones."""
    out, left = [0] * len(sizes), most
    order = sorted(range(len(sizes)), key=lambda k: sizes[k])
    for n, k in enumerate(order):
        out[k] = min(sizes[k], left // (len(order) - n))
        left -= out[k]
    return out


def fit(docs: DataFrame, train_docs: int = TRAIN_DOCS, train_bytes: int = TRAIN_BYTES) -> Model:
    """A model from documents with lang; at most `train_bytes` bytes by language are kept, from all over the sampled texts.

    Each sampled text gives an equal share, so one long document can't stand for a language; what short ones lack, longer
    ones give. Only pieces reach the driver: at most `train_bytes` a text.
    """

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"lang": batch["lang"], "n": batch["_n"], "piece": [pieces(t, train_bytes) for t in batch["text"].tolist()]})

    texts: dict[str, list[bytes]] = {}
    found = labelled(docs, train_docs).select("lang", "text", F.col("_n").cast("long").alias("_n")).mapInPandas(cut, "lang string, n long, piece binary")
    for r in found.orderBy("lang", "n").toLocalIterator():
        if r["piece"]:
            texts.setdefault(r["lang"], []).append(bytes(r["piece"]))
    joined = {}
    for lang, parts in texts.items():
        each = shares([len(p) for p in parts], train_bytes)
        joined[lang] = b" ".join(_whole(p, PIECE, n) for p, n in zip(parts, each))
    return Model(joined)


def _whole(text: bytes, size: int, most: int) -> bytes:
    """At most `most` bytes from pieces of `size` bytes of a text, spread over it."""
    if len(text) <= most:
        return text
    cut = [text[i : i + size] for i in range(0, len(text), size)]
    order = sorted(range(len(cut)), key=lambda k: (zlib.crc32(cut[k], k), k))[: -(-most // size)]
    return b"".join(cut[k] for k in sorted(order))[:most]


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred and score of every row, from its whole text.

    A null text, or one without letters (Unicode category L), is `und` with score 0, and so is every text under a model without languages.
    The score is how much fewer phrases the winner needs than the runner-up, as a share; ties go to the first language
    by name with score 0. Repeated rows are judged each; other columns are ignored.
    """
    handed = docs.sparkSession.sparkContext.broadcast(model) if model.languages else None  # size bounded by TRAIN_BYTES

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = handed.value if handed else None
        for batch in batches:
            texts = [_clean(t) if t else b"" for t in batch["text"].tolist()]
            pred, score = np.full(len(texts), "und", object), np.zeros(len(texts))
            if m and texts:
                counts, sizes = m.phrases(texts)
                some = sizes > 0
                best = counts.argmin(axis=1)
                pred[some] = np.array(m.languages, object)[best[some]]
                if len(m.languages) > 1:
                    two = np.partition(counts, 1, axis=1)[:, :2].astype(float)
                    score[some] = (1 - two[:, 0] / np.maximum(two[:, 1], 1))[some]
                else:
                    score[some] = 1.0
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "lang_pred": pred, "score": np.clip(score, 0, 1)})

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInPandas(judge, "doc_id long, lang_pred string, score double")


def held_out(docs: DataFrame) -> DataFrame:
    return docs.withColumn("held_out", F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 3 == 1)


def op6_language(spark, sf_dir: str) -> DataFrame:
    """The language of every document, learned from those not held out.

    A null text, or one without letters, is `und` with score 0; repeated rows are judged each; a null doc_id counts as
    an empty text in the split. Without labelled text, or without rows, all is `und` or empty.
    """
    docs = held_out(table(spark, sf_dir, "documents"))
    model = fit(docs.filter(~F.col("held_out")).select("doc_id", "lang", "text"))
    rows = identify(docs.select("doc_id", "text"), model)
    return held_out(rows).select("doc_id", "held_out", "lang_pred", "score")
