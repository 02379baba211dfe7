"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document. The ledger holds the measurements and one
integer whose bit r says that rule r failed. A policy is a named set of rules, that is
a mask; applying another policy, or asking what a rule costs, reads the ledger only.

Each text is handled within its row: nothing is shuffled, and repeated word windows
are found by sorting one packed number per window (hash in the upper bits, position
in the lower ones). With n words at least ``62 - log2(n)`` bits of hash are compared,
so a wrong match needs two of about ``2**50`` values to fall together in one text.

Defined cases: a null or empty text has no words and fails ``few_words``; rows that
repeat others are judged one by one; an empty table gives no rows; other columns are
kept in the struct ``doc``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartdex.llm.shared import SPACE, WORD, let, split_lines

#: Name and failing condition of each rule; the place in the list is the bit.
RULES: tuple[tuple[str, str], ...] = (
    ("few_words", "n_words < 50"),
    ("repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    ("many_symbols", "10 * n_symbols > n_words"),
    ("odd_word_length", "word_chars < 3 * n_words or word_chars > 10 * n_words"),
    ("repeated_lines", "2 * n_dup_lines > n_lines"),
    ("few_letters", "5 * n_letterless > n_words"),
)
BITS = {name: 1 << bit for bit, (name, _) in enumerate(RULES)}
BASE = BITS["few_words"] | BITS["repeated_windows"]
#: Policies by version; a published version is never changed.
POLICIES: dict[str, int] = {"base": BASE, "v1": sum(BITS.values())}
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_letterless")


def _covered_words(words: Column) -> Column:
    """Words that lie in 3-word windows found at least twice in the text."""
    n = F.size(words)
    one = F.lit(1).cast("bigint")

    def packed(hashes: Column, unit: Column) -> Column:
        high = F.negative(unit)

        def window(i: Column) -> Column:
            h = F.xxhash64(F.get(hashes, i), F.get(hashes, i + 1), F.get(hashes, i + 2))
            return F.coalesce(h.bitwiseAND(high).bitwiseOR(i.cast("bigint")), F.lit(0).cast("bigint"))

        def repeated(found: Column) -> Column:
            def same(i: Column) -> Column:
                return F.get(found, i).bitwiseAND(high) == F.get(found, i - 1).bitwiseAND(high)

            twins = F.when(F.size(found) > 1, F.filter(F.sequence(F.lit(1), F.size(found) - 1), same))
            low = unit - 1
            places = F.transform(
                twins, lambda i: F.array(F.get(found, i - 1).bitwiseAND(low), F.get(found, i).bitwiseAND(low))
            )
            return F.sort_array(F.array_distinct(F.flatten(places)))

        return let(F.sort_array(F.transform(F.sequence(F.lit(0), n - 3), window)), repeated)

    def total(places: Column) -> Column:
        step = lambda p, i: F.least(F.lit(3).cast("bigint"), F.get(places, i + 1) - p)
        return F.aggregate(F.transform(places, step), F.lit(0).cast("bigint"), lambda a, x: a + x)

    unit = F.call_function("shiftleft", one, F.length(F.bin(n)))
    hashes = F.transform(words, lambda w: F.xxhash64(w))
    places = let(hashes, lambda h: let(unit, lambda u: packed(h, u)))
    return F.when(n >= 3, F.coalesce(let(places, total), F.lit(0).cast("bigint"))).otherwise(F.lit(0).cast("bigint"))


def measure(text: Column) -> Column:
    """Struct of the measurements of a text."""
    text = F.coalesce(text, F.lit(""))
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))

    def of_words(w: Column) -> Column:
        return F.struct(
            F.size(w).cast("bigint").alias("n_words"),
            F.length(F.array_join(w, "")).cast("bigint").alias("word_chars"),
            _covered_words(w).alias("n_repeat_words"),
            F.size(F.filter(w, lambda x: ~x.rlike(r"\p{L}"))).cast("bigint").alias("n_letterless"),
        )

    def of_lines(lines: Column) -> Column:
        return F.struct(
            F.size(lines).cast("bigint").alias("n_lines"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint").alias("n_dup_lines"),
        )

    return F.struct(
        let(words, of_words).alias("w"),
        let(F.filter(split_lines(text), lambda x: x.rlike(f"[^{SPACE}]")), of_lines).alias("l"),
        F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("bigint").alias("n_symbols"),
    )


def quality_ledger(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The document as struct ``doc``, its measurements, and the failed rules as ``fail_bits``."""
    measured = docs.select(F.struct("*").alias("doc"), measure(F.col(text_col)).alias("m"))
    flat = measured.select("doc", "m.w.*", "m.l.*", "m.n_symbols")
    bits = [F.when(F.expr(rule), F.lit(1 << bit)).otherwise(0) for bit, (_, rule) in enumerate(RULES)]
    return flat.select("doc", *MEASURES, sum(bits, F.lit(0)).cast("bigint").alias("fail_bits"))


def passes(policy: str, fail_bits: str = "fail_bits") -> Column:
    """Whether a ledger row passes a policy."""
    return F.col(fail_bits).bitwiseAND(F.lit(POLICIES[policy])) == 0


def ablation(ledger: DataFrame, policy: str) -> DataFrame:
    """For each rule of a policy: documents it fails, and those that no other rule of it fails.

    The ledger shrinks to one row per bit pattern before anything else is counted.
    """
    mask = POLICIES[policy]
    patterns = ledger.groupBy(F.col("fail_bits").bitwiseAND(F.lit(mask)).alias("bits")).agg(F.count("*").alias("n"))
    rules = [(name, bit) for name, bit in BITS.items() if bit & mask]
    per_rule = F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), F.lit(b).cast("bigint").alias("bit")) for n, b in rules]))
    failed = F.col("bits").bitwiseAND(F.col("r.bit")) != 0
    alone = F.col("bits") == F.col("r.bit")
    return (
        patterns.select("bits", "n", per_rule.alias("r"))
        .groupBy("r.rule")
        .agg(
            F.sum(F.when(failed, F.col("n")).otherwise(0)).alias("n_failed"),
            F.sum(F.when(alone, F.col("n")).otherwise(0)).alias("n_only_this"),
        )
    )
