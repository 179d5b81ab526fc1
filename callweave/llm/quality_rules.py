"""Quality rules by weak supervision, in DataFrame operations only.

Each rule votes for good (1), votes for bad (-1) or abstains (0). The rules are taken as
independent given the unknown class, and expectation-maximisation over all documents
estimates how often each rule casts each vote in either class. The posterior probability of
good then decides, instead of all rules having to pass.

EM needs only how many documents cast each combination of votes: with m rules at most 3^m
rows, whatever the number of documents. That table is aggregated by Spark and iterated on the
driver; the posterior is applied as a column expression (a sum of log odds by vote).

Null and empty texts have no words, fail the base rules and are rejected. Repeated rows are
judged each on its own. An empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from callweave.llm.common import stages, text_column

BLANK = r"[ \t\n\x0B\f\r]"
N_SYMBOLS = "[^#*$%&|<>]+"

#: Rules as (bad if, good if) over the measures; neither: the rule abstains. A rule that looks
#: for one fault says nothing about texts without it.
RULES: dict[str, tuple[str, str]] = {
    "symbol_words": ("n_symbols > 0.1 * n_words", "false"),
    "symbol_share": ("n_symbols > 0.02 * word_chars", "false"),
    "shouting": ("n_upper > 0.4 * word_chars", "false"),
    "repetition": ("n_repeat_words > 0.3 * n_words", "false"),
    "variety": ("n_distinct < 0.3 * n_words and n_words < 2000", "false"),
    "duplicate_lines": ("n_dup_lines > 0.3 * n_lines", "false"),
    "word_length": ("word_chars < 2.5 * n_words or word_chars > 12 * n_words", "false"),
    "length": ("n_words < 10", "n_words >= 100"),
}

#: Documents added to each count of votes.
SMOOTH = 0.1

#: Share of good documents that a rule votes bad, before anything is seen.
FALSE_ALARMS = 0.005

MEASURES = [
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_upper", "n_distinct",
]


def _size(column: Column) -> Column:
    return F.size(column).cast("long")


def measured(docs: DataFrame) -> DataFrame:
    """Rows with a column ``text`` without nulls, and the measures of that text beside the rest.

    Words in repeated 3-word windows: the windows' hashes are sorted with their positions, so
    equal windows are neighbours; positions of those cover up to three words each. Texts
    without a repeated window, told by the count of distinct hashes, skip the sort.
    """
    rest = [c for c in docs.columns if c != "text"]
    split = docs.select(
        *rest,
        "text",
        F.array_remove(F.split("text", f"{BLANK}+"), "").alias("words"),
        F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^ \t\n\x0B\f\r]")).alias("lines"),
    )
    hashed = split.select(
        *rest,
        "text",
        _size(F.col("words")).alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("text", N_SYMBOLS, "")).cast("long").alias("n_symbols"),
        (_size(F.col("lines")) - _size(F.array_distinct("lines"))).alias("n_dup_lines"),
        _size(F.col("lines")).alias("n_lines"),
        F.length(F.regexp_replace("text", r"[^\p{Lu}]+", "")).cast("long").alias("n_upper"),
        _size(F.array_distinct("words")).alias("n_distinct"),
        F.when(
            F.size("words") >= 3,
            F.expr("zip_with(slice(words, 1, size(words) - 2), "
                   "zip_with(slice(words, 2, size(words) - 2), slice(words, 3, size(words) - 2), "
                   "(b, c) -> struct(b, c)), (a, r) -> xxhash64(a, r))"),
        ).alias("windows"),
    )
    ordered = hashed.withColumn(
        "windows",
        F.when(
            F.size(F.array_distinct("windows")) < F.size("windows"),
            F.sort_array(F.expr("transform(windows, (h, i) -> struct(h, i))")),
        ),
    )
    # A window is repeated if its hash equals that before it or that after it.
    n = F.size("windows")
    repeated = ordered.withColumn(
        "windows",
        F.when(
            n > 1,
            F.expr(
                "sort_array(array_compact(zip_with(windows, zip_with("
                "array_append(slice(windows.h, 2, size(windows) - 1), null),"
                "array_prepend(slice(windows.h, 1, size(windows) - 1), null), "
                "(after, before) -> struct(after, before)), "
                "(w, r) -> case when w.h = r.after or w.h = r.before then w.i end)))"
            ),
        ),
    )
    # Windows of three words cover their distance to the next one, at most three words.
    return repeated.withColumn(
        "n_repeat_words",
        F.coalesce(
            F.expr(
                "aggregate(zip_with(slice(windows, 2, greatest(size(windows) - 1, 0)), "
                "slice(windows, 1, greatest(size(windows) - 1, 0)), (b, a) -> least(b - a, 3)), "
                "if(size(windows) > 0, 3L, 0L), (s, x) -> s + x)"
            ),
            F.lit(0),
        ).cast("long"),
    ).drop("windows")


def votes(rules: dict[str, tuple[str, str]] = RULES) -> dict[str, Column]:
    """A column of -1, 0 or 1 for each rule; texts without words get no vote for good."""
    return {
        f"vote_{name}": F.expr(
            f"case when {bad} then -1 when n_words > 0 and ({good}) then 1 else 0 end"
        ).cast("byte")
        for name, (bad, good) in rules.items()
    }


def fit_votes(patterns: list[tuple[tuple[int, ...], int]], rounds: int = 200) -> tuple[float, list[dict[int, float]]]:
    """EM over (votes, documents) rows: log odds of good before any vote, and by rule and vote.

    A vote for bad names a fault and most texts have few, so the start takes a document without
    such a vote for good at odds of e^2 and each such vote for e^3 against it. Rules are taken
    to be better than chance beforehand: as many good documents again as the table has rows
    are counted, of which a rule votes ``FALSE_ALARMS`` bad. Without that prior, two rules that see
    the same fault would outvote one that alone sees another. A part of a document
    (``SMOOTH``) is added to each count, so that no vote is impossible in either class.
    """
    m = len(patterns[0][0]) if patterns else 0
    total = sum(n for _, n in patterns)
    good = [_share(2.0 - 3.0 * sum(v < 0 for v in votes)) for votes, _ in patterns]
    prior, odds = 0.0, [dict.fromkeys((-1, 0, 1), 0.0) for _ in range(m)]
    for _ in range(rounds):
        n_good = sum(p * n for p, (_, n) in zip(good, patterns)) + 3 * SMOOTH
        n_bad = sum((1 - p) * n for p, (_, n) in zip(good, patterns)) + 3 * SMOOTH
        prior = math.log(n_good / n_bad)
        for j in range(m):
            a, b = dict.fromkeys((-1, 0, 1), SMOOTH), dict.fromkeys((-1, 0, 1), SMOOTH)
            for p, (votes, n) in zip(good, patterns):
                a[votes[j]] += p * n
                b[votes[j]] += (1 - p) * n
            alarms = (a[-1] + FALSE_ALARMS * total) / (n_good + total)
            rates = {v: (1 - alarms) * a[v] / (a[0] + a[1]) for v in (0, 1)} | {-1: alarms}
            odds[j] = {v: math.log(rates[v]) - math.log(b[v] / n_bad) for v in rates}
            odds[j][-1] = min(odds[j][-1], 0.0)
        new = [_share(prior + sum(odds[j][v] for j, v in enumerate(votes))) for votes, _ in patterns]
        moved = max((abs(a - b) for a, b in zip(good, new)), default=0.0)
        good = new
        if moved < 1e-9:
            break
    return prior, odds


def _share(odds: float) -> float:
    return 1 / (1 + math.exp(-max(-500.0, min(500.0, odds))))


def posterior(prior: float, odds: list[dict[int, float]], names: list[str]) -> Column:
    total = F.lit(prior)
    for name, by_vote in zip(names, odds):
        total = total + (
            F.when(F.col(name) == 1, by_vote[1]).when(F.col(name) == -1, by_vote[-1]).otherwise(by_vote[0])
        )
    return 1 / (1 + F.exp(-total))


def judged(docs: DataFrame, text: str = "text", carry: list[str] | None = None,
           rules: dict[str, tuple[str, str]] = RULES, threshold: float = 0.5) -> DataFrame:
    """Every row with its measures, votes, posterior, ``base_failed`` and ``kept``.

    The given row, or the columns ``carry`` of it, is the column ``row``, so that no name of its
    own can clash. The rows are written once with their measures, then counted by votes, then judged from there.
    """
    kept = stages(docs.sparkSession)
    names = [f"vote_{n}" for n in rules]
    rows = docs.select(F.struct(*(carry or ["*"])).alias("row"), text_column(text).alias("text"))
    table = kept.keep(
        measured(rows).drop("text").select("row", *MEASURES).withColumns(votes(rules)), "measured"
    )
    patterns = [
        (tuple(r[n] for n in names), r["count"]) for r in table.groupBy(*names).count().collect()
    ]
    prior, odds = fit_votes(sorted(patterns))
    failed = F.expr("n_words < 50 or 100 * n_repeat_words > 50 * n_words")
    return (
        table.withColumn("posterior", posterior(prior, odds, names))
        .withColumn("base_failed", failed)
        .withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= threshold))
    )
