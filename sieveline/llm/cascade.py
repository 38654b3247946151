"""Quality rules in a short-circuit cascade, ordered by rejections per cost."""

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from sieveline.llm.tables import BLANK, text_of, words
from sieveline.staging import stage

SAMPLE_ROWS = 2_000
SYMBOLS = "#*$%&|<>"
WINDOW = 8


def _let(value, body):
    """`body` of a lambda variable, so that `value` is computed once."""
    return F.transform(F.array(value), body)[0]


def word_chars(text, _):
    return F.char_length(F.regexp_replace(text, BLANK + "+", "")).cast("long")


def n_symbols(text, _):
    return F.char_length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("long")


def n_dup_lines(text, _):
    """Lines with a word that are equal to an earlier line."""
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    return _let(lines, lambda found: F.size(found) - F.size(F.array_distinct(found))).cast("long")


def n_lines(text, _):
    """Lines with a word."""
    return F.size(F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))).cast("long")


def n_upper(text, _):
    return F.char_length(F.regexp_replace(text, r"[^\p{Lu}]+", "")).cast("long")


def n_words(_, found):
    return F.size(found).cast("long")


def n_repeat_words(_, found):
    """Words in windows of eight words that occur twice or more in the text, the first occurrence included.

    Windows are 64-bit hashes of their words' hashes. Most texts repeat none,
    which one hash set tells; else windows are sorted with their places, those
    equal to a neighbour are kept, and the places they cover are counted.
    """

    def windows(hashes):
        places = F.sequence(F.lit(1), F.size(hashes) - (WINDOW - 1))
        return F.transform(places, lambda at: F.xxhash64(F.slice(hashes, at, WINDOW)))

    def covered(hashed):
        placed = F.array_sort(F.transform(hashed, lambda value, at: F.struct(value.alias("value"), at.alias("at"))))

        def equal(ranked):
            def neighbour(one, k):
                before = F.get(ranked, k - 1)["value"]
                after = F.get(ranked, k + 1)["value"]
                return F.coalesce(before == one["value"], F.lit(False)) | F.coalesce(after == one["value"], F.lit(False))

            return F.array_sort(F.transform(F.filter(ranked, neighbour), lambda one: one["at"]))

        def length(starts):
            steps = F.transform(starts, lambda at, k: F.least(F.lit(WINDOW), F.coalesce(F.get(starts, k + 1) - at, F.lit(WINDOW))))
            return F.aggregate(steps, F.lit(0).cast("long"), lambda total, step: total + step)

        return _let(placed, lambda ranked: _let(equal(ranked), length))

    def counted(hashed):
        return F.when(F.size(F.array_distinct(hashed)) == F.size(hashed), F.lit(0).cast("long")).otherwise(covered(hashed))

    hashes = F.transform(found, lambda word: F.xxhash64(word))
    count = _let(hashes, lambda known: _let(windows(known), counted))
    return F.when(F.size(found) > WINDOW, count).otherwise(F.lit(0).cast("long"))


MEASURES = {
    "n_words": n_words,
    "word_chars": word_chars,
    "n_symbols": n_symbols,
    "n_dup_lines": n_dup_lines,
    "n_lines": n_lines,
    "n_upper": n_upper,
    "n_repeat_words": n_repeat_words,
}


@dataclass(frozen=True)
class Rule:
    """Rejects a text if `rejects` holds of the `measures` it names, given as columns in that order."""

    name: str
    measures: tuple
    rejects: Callable[..., Column]


BASE = (
    Rule("few_words", ("n_words",), lambda words: words < 20),
    Rule("repeats", ("n_repeat_words", "n_words"), lambda repeats, words: 100 * repeats > 30 * words),
)
RULES = (
    *BASE,
    Rule("symbols", ("n_symbols", "word_chars"), lambda symbols, chars: 100 * symbols > 8 * chars),
    Rule("duplicate_lines", ("n_dup_lines", "n_lines"), lambda again, lines: (again >= 3) & (100 * again > 30 * lines)),
    Rule("shouting", ("n_upper", "word_chars"), lambda upper, chars: 100 * upper > 40 * chars),
)


def _prepared(docs):
    """`docs` packed into one column beside its text and words, whatever its columns are called."""
    text = text_of(docs)
    return docs.select(F.struct("*").alias("_doc"), text.alias("_text"), words(text).alias("_words"))


def _measure(name):
    return MEASURES[name](F.col("_text"), F.col("_words"))


def estimate(docs, rules=RULES, rows=SAMPLE_ROWS, seed=0):
    """(rule, seconds, share rejected) of each rule, measured by itself on a random sample of about `rows` rows.

    The sample is read once and staged. A rule's cost is the time of a count of
    its rejections beyond that of a plain count, the better of two runs.
    """
    share = min(1.0, rows / max(1, docs.count()))
    sample = stage(_prepared(docs.sample(fraction=share, seed=seed)).drop("_doc"), "sample")

    def seconds(column):
        best, found = None, None
        for _ in range(2):
            start = time.perf_counter()
            found = sample.agg(F.count("*").alias("n"), F.count_if(column).alias("rejected")).first()
            spent = time.perf_counter() - start
            best = spent if best is None else min(best, spent)
        return best, found

    plain, _ = seconds(F.size("_words") < 0)
    result = []
    for rule in rules:
        spent, found = seconds(rule.rejects(*map(_measure, rule.measures)))
        result.append((rule, max(spent - plain, 1e-4), found["rejected"] / max(1, found["n"])))
    return result


def ordered(estimates):
    """The rules by rejections per cost, best first; then the cheaper, then the name."""
    return [rule for rule, *_ in sorted(estimates, key=lambda e: (-e[2] / e[1], e[1], e[0].name))]


def cascade(docs, rules, complete=()):
    """`docs` with the columns kept, failed_rule, measured and counts, by `rules` in the given order.

    A text's rules are tried one after the other; the first that rejects it ends
    it, and no measure of later rules is computed (SQL CASE). `kept` does not
    depend on the order; `failed_rule`, the first rule to reject, does.
    `measured` is a struct of the measures of `rules`, null where the cascade did
    not come to them. `counts` is one of the measures named in `complete`, those
    taken from the cascade as it found them and the others computed after it.

    Columns of `docs` of these names are replaced. Null text counts as empty;
    rows are judged each for itself, so repeated rows are judged alike.
    """
    names = list(dict.fromkeys(name for rule in rules for name in rule.measures))
    rows = _prepared(docs).withColumn("_failed", F.lit(None).cast("string"))
    known = []
    for rule in rules:
        # Measures come into being rule by rule: those of earlier rules are read, not computed again.
        for name in rule.measures:
            if name not in known:
                rows = rows.withColumn(f"_m_{name}", F.when(F.col("_failed").isNull(), _measure(name)))
                known.append(name)
        rejects = rule.rejects(*(F.col(f"_m_{name}") for name in rule.measures))
        failed = F.when(F.col("_failed").isNull() & rejects, F.lit(rule.name)).otherwise(F.col("_failed"))
        rows = rows.withColumn("_failed", failed)
    own = {
        "kept": F.col("_failed").isNull(),
        "failed_rule": F.col("_failed"),
        "measured": F.struct(*(F.col(f"_m_{name}").alias(name) for name in names)),
    }
    if complete:
        found = {name: F.coalesce(f"_m_{name}", _measure(name)) if name in known else _measure(name) for name in complete}
        own["counts"] = F.struct(*(column.alias(name) for name, column in found.items()))
    return rows.select(
        *(F.col("_doc")[c].alias(c) for c in docs.columns if c not in own),
        *(column.alias(name) for name, column in own.items()),
    )


def apply_rules(docs, rules=RULES):
    """cascade() in the order that estimate() finds."""
    return cascade(docs, ordered(estimate(docs, rules)))
