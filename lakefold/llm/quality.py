"""Quality rules as a rule bitmask ledger (SQL functions only).

Every rule is evaluated once per document; the ledger keeps the measurements
and one integer with a bit per failed rule.  A policy is a versioned choice of
rules: applying it is one bitwise AND, so policies change without touching a
text again, and the effect of leaving a rule out is read off the failure bits.

Words are `[^\\x20\\x09-\\x0D]+`.  Defined results: a null or empty text has no
words and fails `few_words`; repeated rows are judged alike, one by one; null
ids are kept; an empty table gives an empty ledger; other columns of the input
are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 5

# The rules in bit order, as conditions over the measurements.
RULES = {
    "few_words": "n_words < 10",
    "repeated_words": "100 * n_repeat_words > 20 * n_words",
    "symbols": "4 * n_symbols > n_words",
    "repeated_lines": "n_lines >= 4 AND 2 * n_dup_lines > n_lines",
    "shouting": "n_letters >= 20 AND 10 * n_upper > 6 * n_letters",
    "word_length": "word_chars < 2 * n_words OR word_chars > 30 * n_words",
}

# The rules of each policy version.
POLICIES = {
    "base": ["few_words", "repeated_words"],
    "v1": ["few_words", "repeated_words", "symbols", "repeated_lines", "shouting", "word_length"],
}
CURRENT = "v1"

MEASURES = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_letters", "n_upper"]


def policy_mask(version: str) -> int:
    names = list(RULES)
    return sum(1 << names.index(rule) for rule in POLICIES[version])


def measure(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """`key` and the measurements of each document.

    Words in repeated windows are found inside the row: window hashes are
    sorted with their positions, and those equal to a neighbour are repeats
    (n log n in the text's length).  Texts without an equal pair skip the sort.
    """
    blank = r"translate(body, ' \t\n\u000B\u000C\r', '')"
    df = docs.select(key, F.coalesce("text", F.lit("")).alias("body"))
    df = df.select(
        key,
        F.expr(r"filter(split(body, '[\\x20\\x09-\\x0D]+'), w -> w <> '')").alias("words"),
        F.expr(r"filter(split(body, '\n'), l -> l rlike '[^\\x20\\x09-\\x0D]')").alias("lines"),
        F.expr(f"CAST(length({blank}) AS BIGINT)").alias("word_chars"),
        F.expr("CAST(length(body) - length(translate(body, '#*$%&|<>', '')) AS BIGINT)").alias("n_symbols"),
        F.expr(r"CAST(length(regexp_replace(body, '[^\\p{L}]+', '')) AS BIGINT)").alias("n_letters"),
        F.expr(r"CAST(length(regexp_replace(body, '[^\\p{Lu}]+', '')) AS BIGINT)").alias("n_upper"))
    df = df.select("*", F.expr("transform(words, w -> xxhash64(w))").alias("hashes"))
    df = df.select("*", F.expr(
        f"CASE WHEN size(hashes) >= {WINDOW} THEN transform(sequence(1, size(hashes) - {WINDOW - 1}), "
        f"i -> xxhash64(slice(hashes, i, {WINDOW}))) ELSE CAST(array() AS ARRAY<BIGINT>) END").alias("windows"))
    df = df.select("*", F.expr(
        "CASE WHEN size(array_distinct(windows)) < size(windows) THEN "
        "sort_array(transform(windows, (h, i) -> struct(h AS h, i AS i))) "
        "ELSE CAST(array() AS ARRAY<STRUCT<h: BIGINT, i: INT>>) END").alias("ordered"))
    df = df.select("*", F.expr(
        "sort_array(transform(filter(ordered, (x, j) -> (j > 0 AND get(ordered, j - 1).h = x.h) "
        "OR (j < size(ordered) - 1 AND get(ordered, j + 1).h = x.h)), x -> x.i))").alias("repeats"))
    return df.select(key, F.inline_outer(F.array(F.struct(
        F.size("words").cast("bigint").alias("n_words"), "word_chars", "n_symbols",
        F.size("lines").cast("bigint").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        F.expr(f"aggregate(repeats, named_struct('n', 0L, 'last', -{WINDOW}), "
               f"(a, p) -> named_struct('n', a.n + least({WINDOW}, p - a.last), 'last', p), a -> a.n)")
        .alias("n_repeat_words"),
        "n_letters", "n_upper"))))


def failure_bits() -> Column:
    """One bit per failed rule, in the order of RULES."""
    bits = [F.when(F.expr(rule), F.lit(1 << i)).otherwise(F.lit(0)).cast("bigint") for i, rule in enumerate(RULES.values())]
    total = bits[0]
    for bit in bits[1:]:
        total = total.bitwiseOR(bit)
    return total


def ledger(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """`key`, the measurements and `failed` (bits) of each document."""
    return measure(docs, key).withColumn("failed", failure_bits())


def kept(version: str = CURRENT) -> Column:
    return F.col("failed").bitwiseAND(F.lit(policy_mask(version))) == 0


def ablation(entries: DataFrame, version: str = CURRENT) -> DataFrame:
    """Per rule of a policy: documents that fail it, and documents that only it rejects
    (those that come back if the rule is dropped).  The ledger is first summed to one row
    per bit pattern, so the second step sees at most 2^rules rows."""
    mask = policy_mask(version)
    patterns = (entries.groupBy(F.col("failed").bitwiseAND(F.lit(mask)).alias("bits"))
                .agg(F.count(F.lit(1)).alias("n")))
    rules = F.array(*[F.struct(F.lit(name).alias("rule"), F.lit(1 << i).cast("bigint").alias("bit"))
                      for i, name in enumerate(RULES) if name in POLICIES[version]])
    return (patterns.select("bits", "n", F.explode(rules).alias("r"))
            .groupBy("r.rule").agg(
                F.sum(F.when(F.col("bits").bitwiseAND(F.col("r.bit")) != 0, F.col("n")).otherwise(0)).alias("n_failed"),
                F.sum(F.when(F.col("bits") == F.col("r.bit"), F.col("n")).otherwise(0)).alias("n_only_this")))


def quality_report(docs: DataFrame, version: str = CURRENT) -> DataFrame:
    """Per document: measurements, failure bits, the base verdict and the policy's verdict."""
    base = F.col("failed").bitwiseAND(F.lit(policy_mask("base"))) != 0
    return ledger(docs).select("doc_id", *MEASURES, "failed", base.alias("base_failed"),
                               (~base & kept(version)).alias("kept"))


def keep_good(docs: DataFrame, version: str = CURRENT) -> DataFrame:
    """The documents that the policy keeps, with all their columns, in one pass over the texts."""
    names = docs.columns
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.col("text"))
    judged = measure(packed, "row").withColumn("failed", failure_bits()).filter(kept(version))
    return judged.select(*[F.col("row").getField(c).alias(c) for c in names])
