"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document. The ledger keeps the measurements and one
bit per failed rule; policies are versioned bit masks applied later, and ablations
(what each rule removes, what only it removes, what a policy without it would keep) are
bitwise aggregates of the ledger, with no second look at the texts.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from . import text as T

SYMBOLS = b"#*$%&|<>"
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_bangs", "n_upper", "n_lower"]
_CONTINUATION = bytes(range(0x80, 0xC0))
_UPPER, _LOWER = bytes(range(65, 91)), bytes(range(97, 123))


@dataclass(frozen=True)
class Rule:
    """A named test; ``fails`` is an expression over the measurements and is never null."""

    bit: int
    name: str
    fails: str


#: A bit keeps its meaning for ever; new rules take new bits.
RULES = (
    Rule(0, "few_words", "n_words < 50"),
    Rule(1, "repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    Rule(2, "many_symbols", "10 * n_symbols > n_words"),
    Rule(3, "repeated_lines", "100 * n_dup_lines > 60 * n_lines"),
    Rule(4, "short_words", "word_chars < 2 * n_words"),
    Rule(5, "long_words", "word_chars > 20 * n_words"),
    Rule(6, "shouting", "n_upper > n_lower and 2 * n_bangs > n_words"),
    Rule(7, "very_long", "n_words > 100000"),
)
BASE = ("few_words", "repeated_windows")


@dataclass(frozen=True)
class Policy:
    """A version and the rules it enforces."""

    version: str
    rules: tuple[str, ...]

    def mask(self, rules: Sequence[Rule] = RULES) -> int:
        bits = {r.name: r.bit for r in rules}
        return sum(1 << bits[name] for name in self.rules)


#: Length alone is no fault in the policy in force; ``strict`` shows how a version adds a rule.
POLICIES = {
    "v1": Policy("v1", tuple(r.name for r in RULES if r.name != "very_long")),
    "strict": Policy("strict", tuple(r.name for r in RULES)),
}


def _measure(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    column, last = batch.column(batch.num_columns - 1), batch.num_columns - 1
    for first, texts in T.buffers(column):
        hashes, bounds = T.word_hashes(texts)
        words = np.diff(bounds)
        places, owner = T.window_places(bounds, 3)
        value, _ = T.windows(hashes, bounds, 3)
        # Windows of different texts never meet: the text's number is mixed in.
        _, which, counts = np.unique(
            T.mix64(value ^ T.mix64(owner.astype(np.uint64) + np.uint64(1))), return_inverse=True, return_counts=True
        )
        twice = places[counts[which] > 1]
        hit = np.zeros(len(hashes) + 3, dtype=bool)
        for k in range(3):
            hit[twice + k] = True
        repeated = np.add.reduceat(np.concatenate((hit, [False])).astype(np.int64), bounds[:-1]) if len(texts) else []
        repeated = np.where(words > 0, repeated, 0)
        rest = []
        for t in texts:
            bare = t.translate(None, T.SPACE)
            lines = [x for x in t.split(b"\n") if x.strip(T.SPACE)]
            rest.append((
                len(bare.translate(None, _CONTINUATION)),
                len(t) - len(t.translate(None, SYMBOLS)),
                len(lines) - len(set(lines)),
                len(lines),
                t.count(b"!"),
                len(t) - len(t.translate(None, _UPPER)),
                len(t) - len(t.translate(None, _LOWER)),
            ))
        chars, symbols, dups, lines, bangs, upper, lower = (np.array(x, dtype=np.int64) for x in zip(*rest))
        columns = [words, chars, symbols, dups, repeated, lines, bangs, upper, lower]
        kept = [batch.column(i).slice(first, len(texts)) for i in range(last)]
        yield pa.RecordBatch.from_arrays(
            [*kept, *(pa.array(np.asarray(c, dtype=np.int64)) for c in columns)],
            names=[*batch.schema.names[:last], *MEASURES],
        )


def fail_bits(rules: Sequence[Rule] = RULES) -> Column:
    """One bit per failed rule."""
    bits = F.lit(0).cast("long")
    for r in rules:
        bits = bits.bitwiseOR(F.when(F.expr(r.fails), F.lit(1 << r.bit)).otherwise(F.lit(0)).cast("long"))
    return bits


def ledger(docs: DataFrame, keep: Sequence[str] = ("doc_id",), text: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """The columns ``keep``, the measurements and ``fail_bits``, one row per document.

    A null text counts as empty: all measurements are 0. Columns of ``docs`` named like a
    measurement do no harm unless they are in ``keep``, which is refused. Repeated rows stay
    repeated. An empty table gives an empty ledger.
    """
    clash = set(keep) & {*MEASURES, "fail_bits"}
    if clash:
        raise ValueError(f"columns of the ledger cannot be kept: {sorted(clash)}")
    slim = docs.select(*keep, F.coalesce(T.utf8(text), F.lit(b"")).alias("ledger_text"))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in slim.schema.fields[:-1]]
    schema = ", ".join([*fields, *(f"{m} long" for m in MEASURES)])
    return T.map_batches(slim, _measure, schema).withColumn("fail_bits", fail_bits(rules))


def passes(policy: Policy, rules: Sequence[Rule] = RULES) -> Column:
    """True where no rule of ``policy`` failed."""
    return F.col("fail_bits").bitwiseAND(F.lit(policy.mask(rules)).cast("long")) == 0


def ablation(book: DataFrame, policy: Policy, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Per rule of ``policy``: documents it fails, fails alone, and the policy's count kept without it.

    One aggregation of the ledger to its distinct bit patterns (at most 2^rules), then bitwise sums.
    """
    mask = policy.mask(rules)
    patterns = book.groupBy(F.col("fail_bits").bitwiseAND(F.lit(mask).cast("long")).alias("bits")).agg(F.count(F.lit(1)).alias("n"))
    enforced = [r for r in rules if r.name in policy.rules]
    named = F.explode(F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(1 << r.bit).cast("long").alias("own")) for r in enforced]))
    each = patterns.select("bits", "n", named.alias("r")).select("bits", "n", "r.rule", "r.own")

    def total(condition: Column) -> Column:
        return F.sum(F.when(condition, F.col("n")).otherwise(F.lit(0))).cast("long")

    return each.groupBy("rule").agg(
        F.lit(policy.version).alias("policy"),
        total(F.col("bits").bitwiseAND(F.col("own")) != 0).alias("n_failed"),
        total(F.col("bits") == F.col("own")).alias("n_failed_alone"),
        total(F.col("bits").bitwiseAND(F.bitwise_not("own")) == 0).alias("n_kept_without"),
    )


def base_failed() -> Column:
    base = sum(1 << r.bit for r in RULES if r.name in BASE)
    return F.col("fail_bits").bitwiseAND(F.lit(base).cast("long")) != 0


def accept(docs: DataFrame, policy: Policy, text: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """The rows of ``docs`` that ``policy`` accepts, with all their columns, whatever their names.

    The row travels through the measuring task as one struct, so no join is needed.
    """
    book = ledger(docs.select(F.struct("*").alias("doc"), F.col(text).alias("doc_text")), ["doc"], "doc_text", rules)
    return book.where(passes(policy, rules)).select("doc.*")
