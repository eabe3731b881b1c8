"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document; the ledger stores what was measured and one bit for each failed rule.
A policy is a version, a mask of the rules that count and the number of failures it allows, so a new policy, or
the question what a rule is worth, reads the ledger and never the texts again. All of it is built-in functions.

Defined results: a null or empty text has no words, all measures 0, and fails ``few_words``. Repeated rows and
repeated ids are judged row by row. Columns of the input are kept only if named in ``keep``; the ledger's own
columns win over columns of the same name. An empty table gives an empty ledger.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kohortflow.llm.common import words

#: name -> SQL condition on the measurements under which a document fails; the bit is the place in this list.
RULES: dict[str, str] = {
    "few_words": "n_words < 50",
    "repeated_windows": "100 * n_repeat_words > 50 * n_words",
    "symbols": "5 * n_symbols > n_words",
    "duplicate_lines": "2 * n_dup_lines > n_lines",
    "shouting": "2 * n_upper > word_chars",
    "word_length": "word_chars > 25 * n_words",
}


@dataclass(frozen=True)
class Policy:
    """A named version: which rules count, and how many of them a kept document may fail."""

    version: str
    rules: tuple[str, ...]
    allowed: int = 0

    @property
    def mask(self) -> int:
        return sum(1 << list(RULES).index(r) for r in self.rules)


#: Fixed by the contract of the base verdict.
BASE = Policy("base", ("few_words", "repeated_windows"))
STRICT = Policy("2", tuple(RULES))


def _repeat_words(with_words: DataFrame) -> DataFrame:
    """Add ``n_repeat_words``: words inside a window of three words that the text holds twice or more.

    Most texts repeat no window, which equal counts of window hashes and distinct hashes prove (equal windows have
    equal hashes). Only the others sort their windows, as text, so a hash collision cannot change the result.
    """
    at = "sequence(0, size(_words) - 3)"
    hashed = f"transform({at}, i -> xxhash64(_words[i], _words[i + 1], _words[i + 2]))"
    return (
        with_words.withColumn("_hashes", F.expr(f"CASE WHEN size(_words) > 3 THEN {hashed} END"))
        .withColumn("_again", F.expr("size(array_distinct(_hashes)) < size(_hashes)"))
        .withColumn(
            "_sorted",
            F.expr(f"CASE WHEN _again THEN sort_array(transform({at}, i -> named_struct('w', concat_ws(' ', _words[i], _words[i + 1], _words[i + 2]), 'i', i))) END"),
        )
        .withColumn(
            "_starts",
            F.expr("sort_array(transform(filter(_sorted, (x, k) -> get(_sorted, k - 1).w <=> x.w OR get(_sorted, k + 1).w <=> x.w), x -> x.i))"),
        )
        .withColumn(
            "n_repeat_words",
            F.expr(
                "coalesce(aggregate(_starts, named_struct('n', 0L, 'last', -3), "
                "(s, i) -> named_struct('n', s.n + least(3, i - s.last), 'last', i), s -> s.n), 0L)"
            ),
        )
    )


def ledger(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Measurements and ``failed_bits`` of every document, beside the columns in ``keep``."""
    base = docs.select(*keep, F.coalesce(F.col(text), F.lit("")).alias("_text"))
    base = base.withColumn("_words", words(F.col("_text"))).withColumn("_lines", F.expr(r"filter(split(_text, '\n'), l -> l rlike '[^\\x20\\x09-\\x0D]')"))
    measured = _repeat_words(base).select(
        *keep,
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.regexp_count("_text", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words",
        F.regexp_count("_text", F.lit(r"\p{Lu}")).cast("long").alias("n_upper"),
    )
    bits = [F.when(F.expr(rule), F.lit(1 << bit)).otherwise(F.lit(0)).cast("long") for bit, rule in enumerate(RULES.values())]
    failed = bits[0]
    for bit in bits[1:]:
        failed = failed.bitwiseOR(bit)
    return measured.withColumn("failed_bits", failed)


def passes(policy: Policy, bits: str = "failed_bits") -> Column:
    """Verdict of a policy from the stored bits."""
    return F.bit_count(F.col(bits).bitwiseAND(F.lit(policy.mask).cast("long"))) <= policy.allowed


def ablations(book: DataFrame, policy: Policy) -> DataFrame:
    """What each rule of a policy does: documents failing it, and documents kept if it alone were left out.

    The ledger is first counted by its distinct bit patterns (at most 2^rules rows, combined in the map tasks);
    the rest is arithmetic on bits of those rows.
    """
    patterns = book.groupBy(F.col("failed_bits").bitwiseAND(F.lit(policy.mask).cast("long")).alias("bits")).count()
    rules = [(name, 1 << list(RULES).index(name)) for name in policy.rules]
    each = patterns.select(
        "count",
        "bits",
        F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), F.lit(b).cast("long").alias("bit")) for n, b in rules])).alias("r"),
    ).select("count", "bits", "r.rule", "r.bit")
    hit = F.col("bits").bitwiseAND(F.col("bit")) != 0
    freed = hit & (F.bit_count("bits") == policy.allowed + 1)
    return each.groupBy("rule").agg(
        F.sum(F.when(hit, F.col("count")).otherwise(0)).alias("failing"),
        F.sum(F.when(freed, F.col("count")).otherwise(0)).alias("kept_without"),
    )


def judged(docs: DataFrame, policy: Policy = STRICT) -> DataFrame:
    """The ledger with the base verdict and the policy's."""
    base_failed = ~passes(BASE)
    return ledger(docs).withColumns({"base_failed": base_failed, "kept": ~base_failed & passes(policy)})


def accepted(docs: DataFrame, policy: Policy = STRICT) -> DataFrame:
    """The documents that the base rules and the policy keep, with their own columns."""
    columns = [F.col(f"`{c}`") for c in docs.columns]
    whole = docs.select(F.struct(*columns).alias("_row"), F.col("text"))
    book = ledger(whole, keep=("_row",))
    # a filter would be pushed below the measuring steps, which would then be computed in each other's place again
    # and again; an array that is empty for a rejected document stays above them
    once = F.explode(F.when(passes(BASE) & passes(policy), F.array(F.lit(1))).otherwise(F.array().cast("array<int>")))
    return book.select("_row", once.alias("_kept")).select("_row.*")
