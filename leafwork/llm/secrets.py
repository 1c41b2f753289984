"""Secret scans: fixed patterns, and Markov models of random strings and of ordinary identifiers.

The patterns find assignments, access keys and long hex runs. For other long runs of key characters, two first-order
character models are compared by their log-likelihood ratio: one of random strings, learned from what the patterns
find, one of ordinary identifiers, learned from the words of a sample of documents. Both are small tables of character
pairs. Everything runs as built-in expressions.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafwork.llm.common import of_row, rows_whole, table

# The base patterns.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{32,}"
KINDS = ("assign", "access", "hex", "markov")

ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
#: Runs that the models judge. Shorter ones hold too little to tell.
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
IDENTIFIER = r"[A-Za-z0-9+/_=-]{4,}"
#: The labelled sample: so many documents with pattern matches, and so many for identifiers, by smallest hash.
TRAIN_DOCS = 2_000
#: Values that one document gives to the sample of random strings, and characters of one value.
TRAIN_VALUES, TRAIN_CHARS = 64, 256
#: Log-likelihood ratio that a run needs: odds of e**12 against the rarity of secrets.
LEAST_RATIO = 12.0
SMOOTHING = 0.5
#: Pairs' worth of weight that single characters have in a pair model, so that rare contexts say what their characters say.
BACKOFF = 100
#: The pair of characters that ends at the 1-based place i of the array c, as one number; 0 stands before the first.
_PAIR = f"if(i = 1, 0, locate(c[if(i = 1, 0, i - 2)], '{ALPHABET}')) * {len(ALPHABET) + 1} + locate(c[i - 1], '{ALPHABET}')"
_BLOCK = 256

_SPAN = "array<struct<start: long, end: long, value: string>>"


def _quoted(pattern: str) -> str:
    return pattern.replace("\\", "\\\\").replace("'", "\\'")


def _spans(columns: list[str], text: str, pattern: str, group: int, least: int, out: str) -> list[list[str]]:
    """Two projections that give `out`, the leftmost non-overlapping matches with code-point positions.

    The texts between the matches and the matches themselves have lengths, and the positions are their running sums,
    taken over blocks so that a text with very many matches stays cheap.
    """
    quoted = _quoted(pattern)
    hit = f"{text} rlike '{quoted}'"
    value = f"regexp_extract_all({text}, '{quoted}', {group})"
    first = [
        f"if({hit}, transform(split({text}, '{quoted}', -1), x -> char_length(x)), array()) as _gaps",
        f"if({hit}, regexp_extract_all({text}, '{quoted}', 0), array()) as _all",
        f"if({hit}, {value}, array()) as _values",
    ]
    second = ["_gaps", "_all", "_values", "transform(_all, (m, i) -> _gaps[i] + char_length(m)) as _steps"]
    third = ["_gaps", "_all", "_values", "_steps", f"transform(sequence(0, size(_steps) div {_BLOCK}), b -> aggregate(slice(_steps, b * {_BLOCK} + 1, {_BLOCK}), 0L, (a, x) -> a + x)) as _blocks"]
    before = f"aggregate(slice(_blocks, 1, i div {_BLOCK}), 0L, (a, x) -> a + x) + aggregate(slice(_steps, i div {_BLOCK} * {_BLOCK} + 1, i % {_BLOCK}), 0L, (a, x) -> a + x)"
    fourth = [f"filter(transform(_all, (m, i) -> named_struct('start', {before} + _gaps[i], 'end', {before} + _gaps[i] + char_length(m), 'value', _values[i])), s -> char_length(s.value) >= {least}) as {out}"]
    return [[*columns, *x] for x in (first, second, third, fourth)]


def _with_spans(df: DataFrame, text: str, pattern: str, group: int, least: int, out: str) -> DataFrame:
    columns = [f"`{c}`" for c in df.columns]
    for step in _spans(columns, text, pattern, group, least, out):
        df = df.selectExpr(*step)
    return df


def pattern_spans(docs: DataFrame) -> DataFrame:
    """`docs` with the arrays _assign, _access and _hex of (start, end, value), and _runs for the models to judge.

    start and end are code points of the text, end exclusive; a null text has no spans. _runs are runs of key characters
    outside of base spans: a run that base spans cut counts as its pieces of 20 characters or more.
    """
    df = docs.withColumn("_text", F.coalesce(F.col("text").cast("string"), F.lit("")))
    df = _with_spans(df, "_text", ASSIGN, 2, 8, "_assign")
    df = _with_spans(df, "_text", ACCESS, 0, 16, "_access")
    df = _with_spans(df, "_text", HEX, 0, 32, "_hex")
    df = _with_spans(df, "_text", CANDIDATE, 0, 20, "_runs")
    base = "concat(_assign, _access, _hex)"
    starts = "filter(array_distinct(concat(array(r.start), transform(t, b -> b.end))), s -> s < r.end and not exists(t, b -> b.start <= s and s < b.end))"
    end = "coalesce(array_min(transform(filter(t, b -> b.start > s), b -> b.start)), r.end)"
    pieces = f"transform({starts}, s -> named_struct('start', s, 'end', {end}, 'value', substring(r.value, cast(s - r.start as int) + 1, cast({end} - s as int))))"
    cut = f"transform(_runs, r -> element_at(transform(array(filter({base}, b -> b.start < r.end and r.start < b.end)), t -> if(size(t) = 0, array(r), {pieces})), 1))"
    return df.withColumn("_runs", F.expr(f"filter(flatten({cut}), r -> char_length(r.value) >= 20)")).drop("_text")


def _pairs(strings: DataFrame, column: str) -> DataFrame:
    """Counts of character pairs (a, b); a is 0 at the start, else the 1-based place in ALPHABET."""
    pair = f"element_at(transform(array(split({column}, '')), c -> transform(sequence(1, size(c)), i -> {_PAIR})), 1)"
    return strings.selectExpr(f"explode({pair}) as pair").groupBy("pair").count()


def train(docs: DataFrame, train_docs: int = TRAIN_DOCS) -> list[float]:
    """Log ratios of random against ordinary by pair of characters, (len(ALPHABET) + 1) squared values.

    Labels: values that the patterns found are random strings; words outside of them, with letters, are ordinary
    identifiers. Random strings come from the `train_docs` documents with matches that have the smallest hashes, at most
    TRAIN_VALUES from each and TRAIN_CHARS characters of one; identifiers from all documents whose hash is within the share
    that makes `train_docs` documents. With no sample a model is uniform. What reaches the driver is a count for each pair
    of characters.
    """
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    hits = pattern_spans(rows.filter(" or ".join(f"text rlike '{_quoted(p)}'" for p in (ASSIGN, ACCESS, HEX))))
    short = hits.selectExpr("doc_id", f"slice(transform(filter(concat(_assign, _access, _hex), s -> char_length(s.value) >= 16), s -> regexp_replace(substring(s.value, 1, {TRAIN_CHARS}), '[^A-Za-z0-9+/_=-]', '')), 1, {TRAIN_VALUES}) as vs")
    values = short.orderBy(F.xxhash64("doc_id"), "doc_id", "vs").limit(train_docs).selectExpr("explode(vs) as v").filter("v <> ''")
    share = min(1.0, train_docs / max(1, docs.count()))
    plain = rows.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) <= int(share * (1 << 30)))
    bare = "text"
    for p in (ASSIGN, ACCESS, HEX):
        bare = f"regexp_replace({bare}, '{_quoted(p)}', ' ')"
    names = plain.selectExpr(f"explode(regexp_extract_all({bare}, '{IDENTIFIER}', 0)) as v").filter("v rlike '[A-Za-z]'")
    size = len(ALPHABET) + 1
    tables = []
    for strings in (values, names):
        counts = {r["pair"]: r["count"] for r in _pairs(strings, "v").collect()}
        sums = [sum(counts.get(a * size + b, 0) for b in range(1, size)) for a in range(size)]
        single = [sum(counts.get(a * size + b, 0) for a in range(size)) + SMOOTHING for b in range(size)]
        total = sum(single[1:])
        tables.append([math.log((counts.get(a * size + b, 0) + BACKOFF * single[b] / total) / (sums[a] + BACKOFF)) for a in range(size) for b in range(size)])
    return [x - y for x, y in zip(*tables)]


def judged(found: DataFrame, ratios: list[float], least: float = LEAST_RATIO) -> DataFrame:
    """`found` with _markov: the runs whose log-likelihood ratio, summed over their pairs, reaches `least`."""
    some = found.withColumn("_ratios", F.when(F.size("_runs") > 0, F.array(*[F.lit(x) for x in ratios])))
    score = f"element_at(transform(array(split(r.value, '')), c -> aggregate(sequence(1, size(c)), 0D, (a, i) -> a + _ratios[{_PAIR}])), 1)"
    return some.withColumn("_markov", F.expr(f"filter(_runs, r -> {score} >= {least}D)")).drop("_ratios")


def scan(docs: DataFrame, train_docs: int = TRAIN_DOCS, least: float = LEAST_RATIO) -> DataFrame:
    """`docs` with secrets: array<struct<start, kind_order, end, kind, value>>, sorted by start and kind.

    A null or empty text has none. Kinds may overlap; spans of one kind don't. Repeated rows are scanned each. A column
    of `docs` named `secrets` is replaced; all others, whatever their names, stay as they are.
    """
    own = [c for c in docs.columns if c != "secrets"]
    return _scanned(docs.select(*[f"`{c}`" for c in own]), train_docs, least).select(*of_row(own), "secrets")


def _scanned(docs: DataFrame, train_docs: int = TRAIN_DOCS, least: float = LEAST_RATIO) -> DataFrame:
    """_row (the columns of `docs`), text and secrets."""
    found = pattern_spans(rows_whole(docs, F.col("text").cast("string").alias("text")))
    ratios = train(docs, train_docs)
    every = ", ".join(f"transform(_{k}, s -> named_struct('start', s.start, 'kind_order', {n}, 'end', s.end, 'kind', '{k}', 'value', s.value))" for n, k in enumerate(KINDS))
    return judged(found, ratios, least).select("_row", "text", F.expr(f"array_sort(concat({every}))").alias("secrets"))


def redact(docs: DataFrame, mark: str = "[SECRET]", **options) -> DataFrame:
    """`docs` with every secret replaced by `mark`, and n_chars, if there, counted again; all documents stay.

    Spans that overlap or touch become one mark. A text without secrets stays as it is; a null text stays null.
    """
    rows = _scanned(docs, **options)
    last = "a[size(a) - 1]"
    merged = f"aggregate(secrets, cast(array() as array<struct<start: long, end: long>>), (a, s) -> if(size(a) > 0 and s.start <= a[if(size(a) > 0, size(a) - 1, 0)].end, concat(slice(a, 1, size(a) - 1), array(named_struct('start', {last}.start, 'end', greatest({last}.end, s.end)))), concat(a, array(named_struct('start', s.start, 'end', s.end)))))"
    rows = rows.withColumn("_spans", F.when(F.size("secrets") > 0, F.expr(merged)).otherwise(F.expr("cast(array() as array<struct<start: long, end: long>>)")))
    kept = "transform(_spans, (s, i) -> substring(text, cast(if(i > 0, _spans[if(i > 0, i - 1, 0)].end, 0) as int) + 1, cast(s.start - if(i > 0, _spans[if(i > 0, i - 1, 0)].end, 0) as int)))"
    tail = "substring(text, cast(_spans[size(_spans) - 1].end as int) + 1)"
    changed = F.size("_spans") > 0
    out = rows.withColumn("_new", F.when(changed, F.expr(f"concat(array_join(transform({kept}, x -> concat(x, '{mark}')), ''), {tail})")).otherwise(F.col("text")))
    kinds = dict(docs.dtypes)
    new = {"text": F.col("_new").cast(kinds["text"])}
    if "n_chars" in kinds:
        new["n_chars"] = F.when(changed, F.length("_new").cast(kinds["n_chars"])).otherwise(F.col("_row").getField("n_chars"))
    return out.select(*[new[c].alias(c) if c in new else x for c, x in zip(docs.columns, of_row(docs.columns))])


def digest(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op2_secrets(spark, sf_dir: str) -> DataFrame:
    """The secrets of all documents. A null or empty text has none, a repeated row is scanned each time, and an empty
    table gives no rows; only doc_id and text are read."""
    rows = scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    n = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return rows.select("doc_id", n("assign"), n("access"), n("hex"), F.sha2(digest(F.filter("secrets", lambda s: s["kind"] != "markov")), 256).alias("base_sha256"), digest(F.col("secrets")).alias("spans"), n("markov"))
