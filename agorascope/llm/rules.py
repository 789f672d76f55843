"""Quality rules as a bitmask ledger, in DataFrame functions only.

Every rule is evaluated once; a row of the ledger has the measurements and one long with a bit for
each failed rule. A policy is a named, versioned mask over those bits, so a new policy or an
ablation never reads a text again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agorascope.llm.common import named

SPACE = r"[ \t\n\x0B\f\r]"
WINDOW = 5
#: Bit order of the ledger. Never reorder: stored ledgers depend on it; append instead.
RULES = (
    ("few_words", "n_words < 10"),
    ("repeated_words", "100 * n_repeat_words > 20 * n_words"),
    ("many_symbols", "n_symbols > n_words"),
    ("repeated_lines", "n_lines >= 4 and 2 * n_dup_lines > n_lines"),
    ("short_words", "n_words >= 10 and word_chars < 2 * n_words"),
    ("long_words", "n_words >= 10 and word_chars > 20 * n_words"),
)


@dataclass(frozen=True)
class Policy:
    """A row passes if none of the policy's rules failed."""

    name: str
    version: int
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        names = [n for n, _ in RULES]
        return sum(1 << names.index(r) for r in self.rules)


BASE = Policy("base", 1, ("few_words", "repeated_words"))
DEFAULT = Policy("default", 1, tuple(n for n, _ in RULES))


def _let(name: str, value: str, body: str) -> str:
    """``body``, in which ``name`` stands for ``value``, evaluated once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _repeated(w: str) -> str:
    """Words of the array ``w`` in windows that occur twice or more.

    Only where some window's hash repeats are the windows sorted, as pairs of hash and position, so that
    equal ones are neighbours; each such window then covers the words that the one before it doesn't.
    """
    hashes = f"transform(sequence(0, size({w}) - {WINDOW}), i -> xxhash64(" + ", ".join(f"{w}[i + {k}]" for k in range(WINDOW)) + "))"
    beside = "(j > 0 and s[greatest(j - 1, 0)].h = x.h) or (j < size(s) - 1 and s[least(j + 1, size(s) - 1)].h = x.h)"
    places = f"sort_array(transform(filter(s, (x, j) -> {beside}), x -> x.i))"
    covered = f"aggregate(transform(p, (x, j) -> if(j = 0, {WINDOW}L, cast(least({WINDOW}, x - p[greatest(j - 1, 0)]) as bigint))), 0L, (a, x) -> a + x)"
    counted = _let("s", "sort_array(transform(h, (x, i) -> named_struct('h', x, 'i', i)))", _let("p", places, covered))
    return f"case when size({w}) >= {WINDOW} then {_let('h', hashes, f'case when size(array_distinct(h)) < size(h) then {counted} else 0L end')} else 0L end"


def ledger(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, fail_bits) for every row.

    Null and empty texts have no words and fail ``few_words``. Repeated rows each have a row, null
    ids stay, ids may be of any type, other columns are not read, an empty table gives an empty table.
    Nothing is shuffled: a text's windows are compared inside its row, in n log n for any length, by
    the 64-bit hashes of their five words.
    """
    words = docs.select(
        named(id).alias("id"),
        F.coalesce(named(text).cast("string"), F.lit("")).alias("t"),
        F.array_remove(F.split(F.coalesce(named(text).cast("string"), F.lit("")), SPACE + "+"), "").alias("w"),
    )
    lines = F.filter(F.split("t", "\n"), lambda line: line.rlike(r"[^ \t\n\x0B\f\r]"))
    measured = words.select(
        "id",
        F.size("w").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.regexp_count("t", F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.element_at(F.transform(F.array(lines), lambda x: F.struct(F.size(x).cast("long").alias("n"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dup"))), 1).alias("l"),
        # The condition on a row number always holds: no filter on what follows is moved below it, where all
        # steps would be written out at each of their uses.
        F.when(F.monotonically_increasing_id() >= 0, F.expr(_repeated("w"))).alias("n_repeat_words"),
    )
    out = measured.select("id", "n_words", "word_chars", "n_symbols", F.col("l.n").alias("n_lines"), F.col("l.dup").alias("n_dup_lines"), "n_repeat_words")
    bits = sum((F.when(F.expr(rule), F.lit(1 << k)).otherwise(F.lit(0)).cast("long") for k, (_, rule) in enumerate(RULES)), F.lit(0).cast("long"))
    return out.withColumn("fail_bits", bits).withColumnRenamed("id", id)


def apply_policy(ledger_rows: DataFrame, policy: Policy) -> DataFrame:
    """The ledger with a boolean ``kept``, which every row has, repeated rows each; an empty table stays empty."""
    return ledger_rows.withColumn("kept", F.col("fail_bits").bitwiseAND(F.lit(policy.mask)) == 0)


def ablations(ledger_rows: DataFrame, policy: Policy) -> DataFrame:
    """(policy, version, rule, n_failed, n_only, n_kept, n_kept_without): each rule's effect.

    ``n_only`` rows fail no other rule of the policy, so they come back without the rule. Rows
    are first counted by their masked bits, of which there are at most two to the number of
    rules, and everything else is bitwise work on those counts. Without rows there are none.
    """
    masks = ledger_rows.groupBy(F.col("fail_bits").bitwiseAND(F.lit(policy.mask)).alias("bits")).agg(F.count(F.lit(1)).alias("n"))
    each = [F.struct(F.lit(r).alias("rule"), F.lit(Policy("", 0, (r,)).mask).cast("long").alias("bit")) for r in policy.rules]
    rows = masks.select("bits", "n", F.inline(F.array(*each)))
    hit = F.col("bits").bitwiseAND(F.col("bit")) != 0
    only = F.col("bits") == F.col("bit")
    total = lambda condition: F.sum(F.when(condition, F.col("n")).otherwise(0)).cast("long")
    return rows.groupBy("rule").agg(total(hit).alias("n_failed"), total(only).alias("n_only"), total(F.col("bits") == 0).alias("n_kept"), total((F.col("bits") == 0) | only).alias("n_kept_without")).select(F.lit(policy.name).alias("policy"), F.lit(policy.version).alias("version"), "*")


def judged(docs: DataFrame, policy: Policy = DEFAULT, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The ledger with ``base_failed`` and ``kept``; the base rules reject under any policy."""
    rows = apply_policy(ledger(docs, id, text), Policy(policy.name, policy.version, tuple(dict.fromkeys((*BASE.rules, *policy.rules)))))
    return rows.withColumn("base_failed", F.col("fail_bits").bitwiseAND(F.lit(BASE.mask)) != 0)


def passing(docs: DataFrame, policy: Policy = DEFAULT, text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns unchanged, that the policy keeps, in one pass and without a join.

    Each row is judged by its own text: null and empty texts go with ``few_words``, repeated rows stay or
    go together, ids are not read, an empty table stays empty. Columns may have any names.
    """
    row = docs.select(F.struct(*[named(n).alias(n) for n in docs.columns]).alias("id"), named(text).cast("string").alias("text"))
    return judged(row, policy, "id", "text").where("kept").select("id.*")
