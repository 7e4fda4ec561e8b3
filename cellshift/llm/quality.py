"""Quality rules kept as a ledger of failure bits.

Every rule is evaluated once, over one set of measurements of the whole text, and
sets one bit.  The ledger holds measurements and bits.  A policy is a version and a
mask of rules; applying one, or telling what a rule does inside it, reads bits only:
policies can be changed, compared and ablated without reading a text again.

All of it is column expressions.  A document is measured inside its own row, nothing
is shuffled, and ablations travel as one count per combination of bits.

Defined results: a null or empty text has no word and measures 0 throughout; repeated
rows are judged each on its own; an empty table makes an empty ledger.  Passages are
compared by 64-bit hashes inside one text.  A bit, once given to a rule, is never given
to another.
"""

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellshift.llm.common import WORD, bound, text_or_empty

WINDOW = 8
MEASURES = (
    "n_chars", "n_words", "word_chars", "n_lines", "n_symbols", "n_dup_lines",
    "n_repeat_words", "n_letter_words", "n_capital_words", "n_stutters",
)


@dataclass(frozen=True)
class Rule:
    """Fails where ``fails``, SQL over the measurements, holds."""

    name: str
    bit: int
    fails: str


RULES = (
    Rule("too_short", 0, "n_words < 20"),
    Rule("repeated_passages", 1, "100 * n_repeat_words > 30 * n_words"),
    Rule("symbols", 2, "10 * n_symbols > n_words"),
    Rule("word_length", 3, "word_chars < 3 * n_words OR word_chars > 12 * n_words"),
    Rule("duplicate_lines", 4, "100 * n_dup_lines > 40 * n_lines"),
    Rule("few_letters", 5, "100 * n_letter_words < 80 * n_words"),
    Rule("capitals", 6, "2 * n_capital_words > n_words"),
    Rule("stutter", 7, "100 * n_stutters > 20 * n_words"),
)


@dataclass(frozen=True)
class Policy:
    """The rules a version applies; a document fails it by any of them."""

    version: str
    rules: tuple[str, ...]

    def mask(self, rules: Sequence[Rule] = RULES) -> int:
        bits = {rule.name: 1 << rule.bit for rule in rules}
        return sum(bits[name] for name in set(self.rules))


BASE = Policy("base", ("too_short", "repeated_passages"))
POLICIES = (BASE, Policy("2", tuple(rule.name for rule in RULES)))
CURRENT = POLICIES[-1]


def _repeat_words(words: Column, n: Column) -> Column:
    """Words inside windows of ``WINDOW`` words that occur twice or more in the text.

    Hashes of the windows are sorted with their places; equal neighbours are repeats, and
    each repeat adds the words that the one before it did not cover.
    """
    starts = F.sequence(F.lit(0), n - WINDOW)
    hashed = F.transform(
        starts, lambda i: F.struct(F.xxhash64(F.slice(words, i + 1, WINDOW)).alias("h"), i.alias("at"))
    )

    def covered(windows: Column) -> Column:
        def twice(window: Column, k: Column) -> Column:
            near = lambda j: F.coalesce(F.get(windows, j)["h"] == window["h"], F.lit(False))
            return near(k - 1) | near(k + 1)

        places = F.sort_array(F.transform(F.filter(windows, twice), lambda w: w["at"]))
        return F.aggregate(
            places,
            F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last")),
            lambda done, at: F.struct(
                (done["n"] + F.least(F.lit(WINDOW), at - done["last"])).alias("n"), at.alias("last")
            ),
            lambda done: done["n"],
        )

    return F.when(n < WINDOW, 0).otherwise(bound(F.sort_array(hashed), covered))


def measured(text: Column) -> Column:
    """A struct of ``MEASURES`` of a text that is not null."""

    def of(words: Column) -> Column:
        n = F.size(words)
        count = lambda pattern: F.size(F.filter(words, lambda w: w.rlike(pattern)))
        lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD))
        values = {
            "n_chars": F.length(text),
            "n_words": n,
            "word_chars": F.aggregate(words, F.lit(0), lambda s, w: s + F.length(w)),
            "n_lines": F.size(lines),
            "n_symbols": F.regexp_count(text, F.lit(r"[#*$%&|<>]")),
            "n_dup_lines": bound(lines, lambda found: F.size(found) - F.size(F.array_distinct(found))),
            "n_repeat_words": _repeat_words(words, n),
            "n_letter_words": count(r"\p{L}"),
            "n_capital_words": count(r"^\P{Ll}*\p{Lu}\P{Ll}*$"),
            "n_stutters": F.size(
                F.filter(words, lambda w, i: F.coalesce(F.get(words, i - 1) == w, F.lit(False)))
            ),
        }
        return F.struct(*[values[name].cast("long").alias(name) for name in MEASURES])

    return bound(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), of)


def failures(rules: Sequence[Rule] = RULES) -> Column:
    """The bits of the rules that fail, from columns named as the measurements."""
    if len({rule.bit for rule in rules}) < len(rules) or not all(0 <= rule.bit < 63 for rule in rules):
        raise ValueError("every rule needs a bit of its own, 0 to 62")
    bits = [F.when(F.expr(rule.fails), F.lit(1 << rule.bit)).otherwise(0).cast("long") for rule in rules]
    total = F.lit(0).cast("long")
    for bit in bits:
        total = total.bitwiseOR(bit)
    return total


def ledger(docs: DataFrame, keys: Sequence[str] = ("doc_id",), rules: Sequence[Rule] = RULES) -> DataFrame:
    """``keys``, the measurements and ``failures`` of every row; other columns are not read."""
    taken = {*MEASURES, "failures", "measured"} & {key.lower() for key in keys}
    if taken:
        raise ValueError(f"keys named like columns of the ledger: {sorted(taken)}")
    rows = docs.select(*keys, measured(text_or_empty("text")).alias("measured"))
    return rows.select(*keys, "measured.*").withColumn("failures", failures(rules))


def applied(rows: DataFrame, policies: Sequence[Policy] = POLICIES, rules: Sequence[Rule] = RULES) -> DataFrame:
    """A ledger with ``kept``, a map from version to whether that policy keeps the document."""
    pairs = []
    for policy in policies:
        passes = F.col("failures").bitwiseAND(F.lit(policy.mask(rules)).cast("long")) == 0
        pairs += [F.lit(policy.version), passes]
    return rows.withColumn("kept", F.create_map(*pairs))


def ablations(
    rows: DataFrame, policy: Policy = CURRENT, rules: Sequence[Rule] = RULES, by: Sequence[str] = ()
) -> DataFrame:
    """What each rule of a policy does: ``by, version, rule, n_docs, n_failing, n_only, n_kept, n_kept_without``.

    ``n_only`` fail by this rule alone, so they come back where it is left out.  Documents are
    counted per combination of bits first; rules then read those counts.
    """
    mask = F.lit(policy.mask(rules)).cast("long")
    counts = rows.groupBy(*by, F.col("failures").bitwiseAND(mask).alias("bits")).agg(F.count(F.lit(1)).alias("n"))
    chosen = [rule for rule in rules if rule.name in policy.rules]
    listed = F.array(
        *[F.struct(F.lit(r.name).alias("rule"), F.lit(1 << r.bit).cast("long").alias("bit")) for r in chosen]
    )
    bits, bit = F.col("bits"), F.col("bit")
    total = lambda holds: F.coalesce(F.sum(F.when(holds, F.col("n"))), F.lit(0))
    return (
        counts.select(*by, "bits", "n", F.inline(listed))
        .groupBy(*by, F.lit(policy.version).alias("version"), "rule")
        .agg(
            F.sum("n").alias("n_docs"),
            total(bits.bitwiseAND(bit) != 0).alias("n_failing"),
            total(bits == bit).alias("n_only"),
            total(bits == 0).alias("n_kept"),
            total((bits == 0) | (bits == bit)).alias("n_kept_without"),
        )
    )


def changes(
    rows: DataFrame, before: Policy, after: Policy, rules: Sequence[Rule] = RULES, by: Sequence[str] = ()
) -> DataFrame:
    """What another version decides otherwise: ``by, n_docs, n_dropped, n_restored, dropped_by``.

    ``dropped_by`` joins the bits of ``after`` that the newly dropped documents fail.
    """
    old, new = (F.col("failures").bitwiseAND(F.lit(p.mask(rules)).cast("long")) for p in (before, after))
    dropped, restored = (old == 0) & (new != 0), (old != 0) & (new == 0)
    return rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.count_if(dropped).alias("n_dropped"),
        F.count_if(restored).alias("n_restored"),
        F.coalesce(F.bit_or(F.when(dropped, new)), F.lit(0).cast("long")).alias("dropped_by"),
    )
