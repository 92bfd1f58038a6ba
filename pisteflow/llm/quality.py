"""Quality rules as a bitmask ledger (operator 8), in DataFrame functions only.

The ledger holds one row a document: its measurements, and a bit for each rule that it fails.
Every rule is evaluated once. Policies are versioned sets of rules applied to the stored bits, and
ablations (what would stay if a rule were left out) are sums over those bits: neither reads text.

Defined results: null text has no words, lines or symbols; long texts are measured whole (word
windows are compared by 64-bit hash within a text); ties and repeated rows are measured alike; an
empty table gives an empty ledger; only the id and the text column are read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WHITE_CHARS = " \t\n\x0b\x0c\r"
WHITE = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
WINDOW = 5

#: Rule to its failure, over the measurements. The position is the bit; only append.
RULES: dict[str, Column | str] = {
    "few_words": "n_words < 10",
    "repeated_windows": "100 * n_repeat_words > 20 * n_words",
    "symbols": "2 * n_symbols > 3 * n_words",
    "long_words": "word_chars > 30 * n_words",
    "repeated_lines": "n_lines > 3 and 2 * n_dup_lines > n_lines",
}
#: The base rules, then a policy which adds rules that only junk breaks.
POLICIES: dict[str, tuple[str, ...]] = {
    "base": ("few_words", "repeated_windows"),
    "v1": ("few_words", "repeated_windows", "symbols", "long_words", "repeated_lines"),
}


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body over a value that is computed once: a lambda variable isn't inlined."""
    return F.transform(F.array(value), body)[0]


def _covered(hashes: Column) -> Column:
    """Words in windows whose hash comes twice or more; hashes: of the window at each word."""
    size = F.size

    def slow(h: Column) -> Column:
        ordered = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def places(s: Column) -> Column:
            same = lambda k, x: F.coalesce(F.get(s, k)["h"] == x["h"], F.lit(False))
            twice = F.filter(s, lambda x, k: same(k + 1, x) | F.when(k > 0, same(k - 1, x)).otherwise(F.lit(False)))
            return F.array_sort(F.transform(twice, lambda x: x["i"]))

        total = lambda p: F.aggregate(F.transform(p, lambda x, k: F.least(F.lit(WINDOW), F.coalesce(F.get(p, k + 1) - x, F.lit(WINDOW)))), F.lit(0).cast("long"), lambda a, x: a + x)
        return _let(_let(ordered, places), total)

    return _let(hashes, lambda h: F.when(size(F.array_distinct(h)) == size(h), F.lit(0).cast("long")).otherwise(slow(h)))


def measure(df: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and n_lines (all long)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    trimmed = F.trim(text, F.lit(WHITE_CHARS))

    def of_words(w: Column) -> Column:
        hashes = F.transform(F.sequence(F.lit(1), F.size(w) - (WINDOW - 1)), lambda i: F.xxhash64(*(F.element_at(w, i + k) for k in range(WINDOW))))
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            F.when(F.size(w) > WINDOW, _covered(hashes)).otherwise(F.lit(0).cast("long")).alias("n_repeat_words"),
        )

    def of_lines(lines: Column) -> Column:
        return F.struct(F.size(lines).cast("long").alias("n_lines"), (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"))

    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, WHITE))
    lines = F.filter(F.split(text, "\n"), lambda x: F.trim(x, F.lit(WHITE_CHARS)) != "")
    staged = df.select(F.col(id_col), _let(words, of_words).alias("w"), _let(lines, of_lines).alias("l"), F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"))
    return staged.select(id_col, "w.n_words", "w.word_chars", "n_symbols", "l.n_dup_lines", "w.n_repeat_words", "l.n_lines")


def ledger(df: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Measurements and fail_bits, one row a document."""
    bits = F.lit(0).cast("long")
    for k, rule in enumerate(RULES.values()):
        bits = bits.bitwiseOR(F.when(F.expr(rule), F.lit(1 << k).cast("long")).otherwise(F.lit(0).cast("long")))
    return measure(df, text_col, id_col).withColumn("fail_bits", bits)


def policy_mask(rules: tuple[str, ...]) -> int:
    place = {name: k for k, name in enumerate(RULES)}
    return sum(1 << place[r] for r in rules)


def passes(policy: str, bits: str = "fail_bits") -> Column:
    """True where a ledger row breaks no rule of the policy."""
    return F.col(bits).bitwiseAND(F.lit(policy_mask(POLICIES[policy])).cast("long")) == 0


def ablations(book: DataFrame, policy: str) -> DataFrame:
    """For each rule of a policy: n_failed, n_only (failing no other rule of it) and n_kept_without."""
    mask, rules = policy_mask(POLICIES[policy]), POLICIES[policy]
    hit = F.col("fail_bits").bitwiseAND(F.lit(mask).cast("long"))
    sums = [F.count_if(hit == 0).alias("kept")]
    for r in rules:
        one = F.lit(policy_mask((r,))).cast("long")
        sums += [F.count_if(hit.bitwiseAND(one) != 0).alias(f"{r}_failed"), F.count_if(hit == one).alias(f"{r}_only")]
    row = book.agg(*sums)
    each = F.array(*(F.struct(F.lit(r).alias("rule"), F.col(f"{r}_failed").alias("n_failed"), F.col(f"{r}_only").alias("n_only"), (F.col("kept") + F.col(f"{r}_only")).alias("n_kept_without")) for r in rules))
    return row.select(F.explode(each).alias("x")).select("x.*")
