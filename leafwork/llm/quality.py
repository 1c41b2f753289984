"""Quality rules as a bitmask ledger: every rule is evaluated once, policies and ablations read the bits.

The ledger has a row per document with its measurements and `failed_bits`, in which bit k stands for RULES[k]. A policy
is a versioned set of rules, that is a mask; applying one, or asking what a rule alone rejects, needs the bits only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafwork.llm.common import BLANKS, materialize, of_row, rows_whole, table, words

WINDOW = 5
#: Rejected rows up to which their keys are broadcast; beyond it, a join.
BROADCAST_IDS = 1_000_000
#: Rule name and condition over the measurements, by bit.
RULES: list[tuple[str, str]] = [
    ("too_few_words", "n_words < 10"),
    ("repeated_windows", "100 * n_repeat_words > 20 * n_words"),
    ("symbols_per_word", "10 * n_symbols > n_words"),
    ("duplicate_lines", "2 * n_dup_lines > n_lines"),
    ("word_length", "word_chars < 2 * n_words or word_chars > 15 * n_words"),
    ("capitals", "2 * n_capitals > n_letters"),
    ("exclamations", "5 * n_exclamations > n_words"),
    ("few_letters", "2 * n_letters < word_chars"),
]
BITS = {name: k for k, (name, _) in enumerate(RULES)}
#: The rules of each policy version; a version is never changed, a new one is added.
POLICIES: dict[str, tuple[str, ...]] = {
    "base": ("too_few_words", "repeated_windows"),
    "v1": tuple(BITS),
}
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_letters", "n_capitals", "n_exclamations"]


def mask(policy: str) -> int:
    return sum(1 << BITS[name] for name in POLICIES[policy])


def _without(text: Column, chars: str) -> Column:
    return F.translate(text, chars, "")


def measured(docs: DataFrame) -> DataFrame:
    """`docs` with MEASURES, all long; null and blank texts measure 0.

    n_repeat_words counts the words in windows of five words found twice or more in the text. Windows are compared by
    a 64-bit hash. Only texts with a hash that repeats sort their windows by hash and position; the words covered
    follow from the distances of neighbouring window starts, so the cost stays n log n for any text.
    """
    kept = [f"`{c}`" for c in docs.columns]
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    a = docs.select(*kept, text.alias("_text"), words(text).alias("_words"))
    hashed = ", ".join(f"_words[i + {k}]" for k in range(WINDOW))
    b = a.select(
        *kept, "_text",
        F.size("_words").cast("long").alias("n_words"),
        F.expr(f"if(size(_words) >= {WINDOW}, transform(sequence(0, size(_words) - {WINDOW}), i -> xxhash64({hashed})), cast(array() as array<bigint>))").alias("_windows"),
    )
    c = b.select(
        *kept, "_text", "n_words",
        F.expr("if(size(array_distinct(_windows)) < size(_windows), sort_array(transform(_windows, (h, i) -> named_struct('h', h, 'i', i))), cast(array() as array<struct<h: bigint, i: int>>))").alias("_sorted"),
    )
    repeated = "(i > 0 and _sorted[if(i > 0, i - 1, 0)].h = x.h) or (i + 1 < size(_sorted) and _sorted[if(i + 1 < size(_sorted), i + 1, i)].h = x.h)"
    d = c.select(
        *kept, "_text", "n_words",
        F.expr(f"sort_array(transform(filter(_sorted, (x, i) -> {repeated}), x -> x.i))").alias("_starts"),
        F.expr("filter(split(_text, '\\n', -1), x -> btrim(x, ' \\t\\n\\u000b\\f\\r') <> '')").alias("_lines"),
    )
    step = f"if(i + 1 < size(_starts), least({WINDOW}, _starts[if(i + 1 < size(_starts), i + 1, i)] - p), {WINDOW})"
    bare = _without(F.col("_text"), BLANKS)
    return d.select(
        *kept, "n_words",
        F.length(bare).cast("long").alias("word_chars"),
        (F.length("_text") - F.length(_without(F.col("_text"), "#*$%&|<>"))).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.expr(f"cast(aggregate(transform(_starts, (p, i) -> {step}), 0, (a, x) -> a + x) as long)").alias("n_repeat_words"),
        F.size("_lines").cast("long").alias("n_lines"),
        F.length(F.regexp_replace("_text", r"\P{L}+", "")).cast("long").alias("n_letters"),
        F.length(F.regexp_replace("_text", r"\P{Lu}+", "")).cast("long").alias("n_capitals"),
        (F.length("_text") - F.length(F.replace(F.col("_text"), F.lit("!"), F.lit("")))).cast("long").alias("n_exclamations"),
    )


def ledger(docs: DataFrame) -> DataFrame:
    """`docs` without text, with MEASURES and failed_bits (long), stored once; policies and ablations read what is stored.

    Nulls: a null text measures 0 everywhere and so fails too_few_words. Repeated rows give a ledger row each. Columns
    of `docs` that clash with the ledger's are replaced by the ledger's.
    """
    own = [c for c in docs.columns if c not in {*MEASURES, "failed_bits"}]
    rows = judged(docs.select(*[f"`{c}`" for c in own])).select(*of_row([c for c in own if c != "text"]), *MEASURES, "failed_bits")
    return materialize(rows, "ledger")


def judged(docs: DataFrame) -> DataFrame:
    """_row (the columns of `docs`), MEASURES and failed_bits: every rule evaluated once."""
    rows = measured(rows_whole(docs, F.col("text").cast("string").alias("text")))
    bits = " | ".join(f"if({rule}, {1 << k}L, 0L)" for k, (_, rule) in enumerate(RULES))
    return rows.select("_row", *MEASURES, F.expr(bits).alias("failed_bits"))


def kept(policy: str = "v1") -> Column:
    """Whether a ledger row passes a policy."""
    return F.col("failed_bits").bitwiseAND(F.lit(mask(policy)).cast("long")) == 0


def ablation(rows: DataFrame, policy: str = "v1", by: str | None = None) -> DataFrame:
    """What each rule of a policy rejects at all and alone, and which bits ever fail, in one bitwise aggregation."""
    m, picked = mask(policy), F.col("failed_bits").bitwiseAND(F.lit(mask(policy)).cast("long"))
    sums = [F.count("*").alias("n_docs"), F.count_if(picked == 0).alias("n_kept"), F.bit_or(picked).alias("any_failed_bits"), F.bit_and(picked).alias("all_failed_bits")]
    for name in POLICIES[policy]:
        one = 1 << BITS[name]
        sums += [F.count_if(picked.bitwiseAND(F.lit(one)) != 0).alias(f"{name}_rejects"), F.count_if(picked == one).alias(f"{name}_alone")]
    assert m
    return rows.groupBy(*([by] if by else [])).agg(*sums)


def keep_documents(docs: DataFrame, policy: str = "v1") -> DataFrame:
    """The documents that pass a policy, with the columns of `docs`.

    The ledger is stored without texts; the policy reads its bits, and rows that it rejects, by doc_id and the text's hash,
    leave `docs`. Rows that agree in both have the same text and so the same bits.
    """
    text_hash = F.xxhash64(F.col("text").cast("string"))
    rows = judged(docs.select("doc_id", F.col("text").cast("string").alias("text")))
    led = materialize(rows.select(*of_row(["doc_id"]), F.xxhash64(F.col("_row").getField("text")).alias("h"), *MEASURES, "failed_bits"), "ledger")
    gone = materialize(led.filter(~kept(policy)).select(F.col("doc_id").alias("_d"), F.col("h").alias("_h")).distinct(), "rejected")
    small = F.broadcast(gone) if gone.count() <= BROADCAST_IDS else gone
    whole = rows_whole(docs, F.col("doc_id").alias("_doc"), text_hash.alias("_hash"))
    return whole.join(small, F.expr("_doc <=> _d and _hash = _h"), "left_anti").select("_row.*")


def op3_quality(spark, sf_dir: str) -> DataFrame:
    """The ledger of all documents, stored, under policy v1; a null or empty text measures 0, repeated rows count each."""
    rows = ledger(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", (~kept("base")).alias("base_failed"), kept("v1").alias("kept"), "failed_bits")


OP3_SQL = r"""
with t as (select doc_id, coalesce(text, '') as text from documents),
m as (
  select doc_id, text,
    list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda w: w <> '') as ws,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as ls
  from t),
g as (
  select doc_id, i, ws[i] || ' ' || ws[i+1] || ' ' || ws[i+2] || ' ' || ws[i+3] || ' ' || ws[i+4] as gram
  from m, unnest(range(1, greatest(len(ws) - 3, 1))) as u(i)),
p as (
  select doc_id, i, lead(i) over (partition by doc_id order by i) as nxt
  from (select *, count(*) over (partition by doc_id, gram) as c from g) where c > 1),
r as (select doc_id, sum(case when nxt is null then 5 else least(5, nxt - i) end) as n_repeat_words from p group by doc_id),
a as (
  select m.doc_id, cast(len(ws) as bigint) as n_words,
    cast(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) as bigint) as word_chars,
    cast(length(text) - length(translate(text, '#*$%&|<>', '')) as bigint) as n_symbols,
    cast(len(ls) - len(list_distinct(ls)) as bigint) as n_dup_lines,
    cast(coalesce(n_repeat_words, 0) as bigint) as n_repeat_words,
    len(ls) as n_lines,
    length(regexp_replace(text, '\P{L}', '', 'g')) as n_letters,
    length(regexp_replace(text, '\P{Lu}', '', 'g')) as n_capitals,
    length(text) - length(replace(text, '!', '')) as n_exclamations
  from m left join r using (doc_id)),
b as (
  select *, cast(
    (case when n_words < 10 then 1 else 0 end) + (case when 100 * n_repeat_words > 20 * n_words then 2 else 0 end)
    + (case when 10 * n_symbols > n_words then 4 else 0 end) + (case when 2 * n_dup_lines > n_lines then 8 else 0 end)
    + (case when word_chars < 2 * n_words or word_chars > 15 * n_words then 16 else 0 end)
    + (case when 2 * n_capitals > n_letters then 32 else 0 end) + (case when 5 * n_exclamations > n_words then 64 else 0 end)
    + (case when 2 * n_letters < word_chars then 128 else 0 end) as bigint) as failed_bits
  from a)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed, failed_bits = 0 as kept, failed_bits
from b
"""
