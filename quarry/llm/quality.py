"""Quality rules under weak supervision: rules vote or abstain, their accuracies are estimated
by expectation-maximisation over the whole corpus, and documents are kept by posterior probability.

Everything runs as DataFrame functions. Per document, word statistics become a
vote of every rule: 1 (good), -1 (bad) or 0 (abstains). The corpus is then a
table of vote patterns with counts, at most 3 ** (number of rules) rows, on
which the driver runs EM for a two-class model with conditionally independent
rules: P(vote | class) for each rule, and the share of good documents. The
posterior of a document is a sum of per-vote weights, so scoring needs no join.

Defined results: null and empty texts have no words, all counts 0, and fail
the base rules; repeated rows are judged alike; an empty table gives an empty
result (the prior is kept); other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.session import materialize

# fixed values: the contract's white space, symbols and limits
SPACE = "[\\x20\\x09-\\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 8              # a power of two, for the doubling below
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

KEEP_ABOVE = 0.5         # posterior probability of being good
PRIOR_GOOD = 0.8         # where EM starts: share of good documents, and chances of each vote in either class;
START = {(1, 1): 0.90, (1, 0): 0.08, (1, -1): 0.02,     # a rule looks at one kind of fault, so it
         (-1, 1): 0.60, (-1, 0): 0.15, (-1, -1): 0.25}  # calls most bad documents good as well
FALSE_ALARM = 0.02       # a rule calls at most this share of the good documents bad
ROUNDS = 100


def words(text: Column) -> Column:
    """Words of a text; none for a null text."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def word_stats(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds the columns ``q_*`` to ``docs``: word, symbol, line and repeat statistics of each text."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    df = docs.withColumns({"q_w": words(F.col(text_col).cast("string")), "q_lines": lines})
    n = F.size("q_w")
    # hash of every window of WINDOW words, from words to pairs, fours and eights of them
    df = df.withColumn("q_windows", F.transform("q_w", lambda w: F.xxhash64(w)))
    width = 1
    while width < WINDOW:
        have = F.size("q_windows")
        rest = F.greatest(have - width, F.lit(0))
        df = df.withColumn("q_windows", F.zip_with(F.slice("q_windows", 1, rest), F.slice("q_windows", width + 1, rest),
                                                   lambda x, y: F.xxhash64(x, y)))
        width *= 2
    # counted once: a column of its own is not evaluated again by each of its readers
    df = df.withColumn("q_distinct_windows", F.size(F.array_distinct("q_windows")))
    again = F.col("q_distinct_windows") < F.size("q_windows")
    # an independent hash of the words beside the first: equal pairs are equal windows
    df = df.withColumn("q_sorted", F.when(again, F.array_sort(F.transform("q_windows", lambda h, i: F.struct(
        h.alias("a"), F.xxhash64(F.lit(1), F.slice("q_w", i + 1, WINDOW)).alias("b"), (i + 1).alias("i"))))))
    size = F.size("q_sorted")
    # starts of windows that equal their neighbour in sorted order, in text order
    same = F.zip_with(F.slice("q_sorted", 1, size - 1), F.slice("q_sorted", 2, size - 1), lambda x, y: F.when(
        (x["a"] == y["a"]) & (x["b"] == y["b"]), F.array(x["i"], y["i"])).otherwise(F.array().cast("array<int>")))
    df = df.withColumn("q_at", F.when(again, F.array_sort(F.array_distinct(F.flatten(same)))))
    k = F.size("q_at")
    covered = F.aggregate(F.zip_with(F.slice("q_at", 1, k - 1), F.slice("q_at", 2, k - 1),
                                     lambda x, y: F.least(y - x, F.lit(WINDOW))),
                          F.lit(WINDOW), lambda total, x: total + x)
    return df.withColumns({
        "q_words": n.cast("bigint"),
        "q_chars": F.length(F.array_join("q_w", "")).cast("bigint"),
        "q_symbols": F.regexp_count(text, F.lit(f"[{SYMBOLS}]")).cast("bigint"),
        "q_n_lines": F.size("q_lines").cast("bigint"),
        "q_dup_lines": (F.size("q_lines") - F.size(F.array_distinct("q_lines"))).cast("bigint"),
        "q_repeats": F.when(again & (k > 0), covered).otherwise(F.lit(0)).cast("bigint"),
        "q_distinct": F.size(F.array_distinct("q_w")).cast("bigint"),
        "q_n_windows": F.size("q_windows").cast("bigint"),
        "q_distinct_windows": F.col("q_distinct_windows").cast("bigint"),
        "q_symbol_runs": F.regexp_count(text, F.lit("[#*$%&|<>]+")).cast("bigint"),
        "q_lone_symbols": F.regexp_count(text, F.lit("(?<![^\\x20\\x09-\\x0D])[#*$%&|<>]+(?![^\\x20\\x09-\\x0D])"))
                           .cast("bigint"),
        "q_marks": (F.length(text) - F.length(F.replace(text, F.lit("!"), F.lit("")))).cast("bigint"),
        "q_mark_runs": F.regexp_count(text, F.lit("!!+")).cast("bigint"),
        "q_letters": (F.length(text) - F.length(F.regexp_replace(text, "\\p{L}+", ""))).cast("bigint"),
        "q_upper_words": F.regexp_count(text, F.lit("(?<!\\p{L})\\p{Lu}{2,}(?!\\p{L})")).cast("bigint"),
    }).drop("q_w", "q_lines", "q_windows", "q_sorted", "q_at")


def base_failed() -> Column:
    return (F.col("q_words") < MIN_WORDS) | (100 * F.col("q_repeats") > MAX_REPEAT_PERCENT * F.col("q_words"))


def rules() -> dict[str, Column]:
    """Vote of each rule. A ratio below its first limit is a good sign, above its second a bad one;
    between the two, and in texts without words, the rule abstains."""
    w = F.col("q_words")

    def ratio(part: str, whole: str, good: float, bad: float) -> Column:
        r = F.col(part) / F.when(F.col(whole) > 0, F.col(whole))
        return F.when(r <= good, 1).when(r > bad, -1).otherwise(0)

    def share(part: str, whole: str, good: float, bad: float) -> Column:
        r = F.col(part) / F.when(F.col(whole) > 0, F.col(whole))
        return F.when(r >= good, 1).when(r < bad, -1).otherwise(0)

    return {
        "symbols": ratio("q_symbols", "q_words", 0.05, 0.2),
        "symbol_runs": ratio("q_symbol_runs", "q_words", 0.05, 0.2),
        "lone_symbols": ratio("q_lone_symbols", "q_words", 0.05, 0.2),
        "letters": share("q_letters", "q_chars", 0.88, 0.78),
        "exclamations": ratio("q_marks", "q_words", 0.05, 0.2),
        "exclamation_runs": ratio("q_mark_runs", "q_words", 0.02, 0.1),
        "capital_words": ratio("q_upper_words", "q_words", 0.1, 0.3),
        "repeats": ratio("q_repeats", "q_words", 0.1, 0.25),
        "repeated_windows": share("q_distinct_windows", "q_n_windows", 0.95, 0.85),
        "duplicate_lines": ratio("q_dup_lines", "q_n_lines", 0.1, 0.4),
        "variety": F.when(w >= MIN_WORDS, share("q_distinct", "q_words", 0.2, 0.1)).otherwise(0),
    }


def fit(patterns: list[tuple[tuple[int, ...], int]], n_rules: int) -> tuple[float, list[dict]]:
    """EM on vote patterns with counts: share of good documents, and per rule {(class, vote): probability}.

    Votes are smoothed as if each class had shown every rule's starting guess once. Rules that
    look at different faults seldom vote together, so nothing else would keep EM from taking a
    rare fault for a habit of good documents; hence the bound ``FALSE_ALARM``.
    """
    share, table = PRIOR_GOOD, [dict(START) for _ in range(n_rules)]
    total = sum(n for _, n in patterns)
    for _ in range(ROUNDS if total else 0):
        good = 0.0
        seen = [dict(START) for _ in range(n_rules)]
        for votes, n in patterns:
            p = n * posterior(votes, share, table)
            good += p
            for r, v in enumerate(votes):
                seen[r][1, v] += p
                seen[r][-1, v] += n - p
        before, share = share, (good + PRIOR_GOOD) / (total + 1)
        table = [{(c, v): s[c, v] / sum(s[c, x] for x in (1, 0, -1)) for c, v in s} for s in seen]
        for t in table:
            if t[1, -1] > FALSE_ALARM:
                scale = (1 - FALSE_ALARM) / (t[1, 1] + t[1, 0])
                t.update({(1, 1): t[1, 1] * scale, (1, 0): t[1, 0] * scale, (1, -1): FALSE_ALARM})
        if abs(share - before) < 1e-9:
            break
    return share, table


def posterior(votes: tuple[int, ...], share: float, table: list[dict]) -> float:
    logit = math.log(share / (1 - share)) + sum(math.log(t[1, v] / t[-1, v]) for t, v in zip(table, votes))
    return 1 / (1 + math.exp(-max(-700.0, min(700.0, logit))))


def judge(stats: DataFrame) -> DataFrame:
    """Adds ``q_failed``, ``q_good`` (posterior) and ``q_kept`` to a written table with the columns ``q_*``.

    Reads ``stats`` twice: once for the patterns, once for the result.
    """
    votes = rules()
    names = list(votes)
    rows = (stats.select(*[v.alias(n) for n, v in votes.items()]).groupBy(*names).count().collect())
    share, table = fit([(tuple(r[n] for n in names), r["count"]) for r in rows], len(names))
    logit = F.lit(math.log(share / (1 - share)))
    for name, t in zip(names, table):
        weight = {v: math.log(t[1, v] / t[-1, v]) for v in (1, 0, -1)}
        logit = logit + F.when(votes[name] == 1, weight[1]).when(votes[name] == -1, weight[-1]).otherwise(weight[0])
    return stats.withColumns({"q_failed": base_failed(), "q_good": 1 / (1 + F.exp(-logit))}) \
        .withColumn("q_kept", ~F.col("q_failed") & (F.col("q_good") >= KEEP_ABOVE))


def quality(docs: DataFrame) -> DataFrame:
    """op5: one row per document with its base statistics and the verdict."""
    stats = word_stats(docs.select("doc_id", "text")).drop("text")
    judged = judge(materialize(stats, "quality-stats"))
    return judged.select("doc_id", F.col("q_words").alias("n_words"), F.col("q_chars").alias("word_chars"),
                         F.col("q_symbols").alias("n_symbols"), F.col("q_dup_lines").alias("n_dup_lines"),
                         F.col("q_repeats").alias("n_repeat_words"), F.col("q_failed").alias("base_failed"),
                         F.col("q_kept").alias("kept"), F.col("q_good").alias("p_good"))


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents whose verdict is kept, with all columns of ``docs``."""
    # the row as one column, so that none of its names meets a statistic's
    rows = docs.select(F.struct(*docs.columns).alias("row"), "text")
    judged = judge(materialize(word_stats(rows).drop("text"), "quality-docs"))
    return judged.filter("q_kept").select("row.*")
