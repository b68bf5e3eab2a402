"""Text quality by weak supervision: rules vote or abstain, and their votes are weighed.

Each rule looks at one trait of a text and votes for good (1), for bad (-1) or abstains
(0). How far a rule can be trusted is not given but estimated from where the rules agree
and disagree, over all rows, by expectation-maximisation. A text is kept if the
posterior probability of good reaches a threshold; no single rule decides.

Everything here is DataFrame functions; no Python runs on the executors.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.llm.shared import WORD_SPACE, fresh, saved

# Frequent function words of English, German, French and Spanish.
FUNCTION_WORDS = (
    "the of and to in is that it for as with was on be by this are from "
    "der die und das den dem ein eine ist nicht mit auf zu von im sich des auch als für "
    "le la les des et un une du que qui est pour dans en au par sur pas avec ce il elle "
    "el los las de y por con para se del no lo su al"
).split()
SPACE_CLASS = r"\x20\x09-\x0D"
MIN_WORDS = 50
#: More than this share of words in repeated windows fails a text outright.
MAX_REPEAT_PERCENT = 50
#: A text with at least this posterior probability of being good is kept.
THRESHOLD = 0.5


@dataclass(frozen=True)
class Rule:
    """Votes good on one side of ``good``, bad on the other side of ``bad``, else abstains."""

    name: str
    measure: str
    good: float
    bad: float


RULES = (
    Rule("symbols", "n_symbols / n_words", 0.02, 0.10),
    Rule("repeated_words", "n_repeat_words / n_words", 0.10, 0.30),
    Rule("repeated_lines", "n_dup_lines / n_lines", 0.05, 0.30),
    Rule("function_words", "n_function / n_words", 0.12, 0.04),
    Rule("capitals", "n_capitals / word_chars", 0.10, 0.40),
    Rule("word_variety", "n_distinct / n_words", 0.35, 0.10),
    Rule("exclamations", "n_exclamations / n_words", 0.05, 0.25),
    Rule("marked_words", "n_plain / n_words", 0.90, 0.60),
)


def add_counts(df: DataFrame, text: str, name: str) -> DataFrame:
    """``df`` with a struct ``name`` of counts over the whole text; see :data:`RULES`.

    Null counts as empty. Repeated windows are found by a 64-bit hash of their three
    words. The steps are separate projections so that each array is made once.
    """
    w = fresh(df.columns, "work")
    own = [f"`{c}`" for c in df.columns]
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    trimmed = F.trim(body, F.lit(WORD_SPACE))
    df = df.select(
        *own,
        body.alias(f"{w}_text"),
        F.when(trimmed == "", F.array().cast("array<string>"))
        .otherwise(F.split(trimmed, f"[{SPACE_CLASS}]+"))
        .alias(f"{w}_words"),
        F.filter(F.split(body, "\n"), lambda x: x.rlike(f"[^{SPACE_CLASS}]")).alias(f"{w}_lines"),
    )
    words, lines = F.col(f"{w}_words"), F.col(f"{w}_lines")
    at = lambda i: F.get(words, i)
    windows = F.when(
        F.size(words) >= 4,
        F.transform(
            F.sequence(F.lit(0), F.size(words) - 3), lambda i: F.xxhash64(at(i), at(i + 1), at(i + 2))
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    df = df.select(
        *own,
        f"{w}_text",
        f"{w}_words",
        F.size(lines).alias(f"{w}_n_lines"),
        (F.size(lines) - F.size(F.array_distinct(lines))).alias(f"{w}_dup_lines"),
        windows.alias(f"{w}_windows"),
    )
    h = F.col(f"{w}_windows")
    rest = [f"{w}_text", f"{w}_words", f"{w}_n_lines", f"{w}_dup_lines", f"{w}_windows"]
    df = df.select(*own, *rest, F.sort_array(h).alias(f"{w}_sorted"))
    s = F.col(f"{w}_sorted")
    twice = F.array_distinct(F.filter(s, lambda x, i: x == F.get(s, i - 1)))
    df = df.select(*own, *rest, twice.alias(f"{w}_twice"))
    # a bit for each repeated hash narrows down the windows that are then sorted
    bit = lambda x: x.bitwiseAND(F.lit(63)).cast("int")
    sieve = F.aggregate(
        F.col(f"{w}_twice"),
        F.lit(0).cast("bigint"),
        lambda a, x: a.bitwiseOR(_shift_left(bit(x))),
    )
    df = df.select(
        *own, *rest, F.size(f"{w}_twice").alias(f"{w}_n_twice"), sieve.alias(f"{w}_sieve")
    )
    mark = F.col(f"{w}_sieve")
    candidates = F.when(
        F.col(f"{w}_n_twice") > 0,
        F.filter(
            F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))),
            lambda c: mark.bitwiseAND(_shift_left(bit(c["h"]))) != 0,
        ),
    ).otherwise(F.array().cast("array<struct<h:bigint,i:int>>"))
    df = df.select(*own, *rest[:4], F.sort_array(candidates).alias(f"{w}_found"))
    c = F.col(f"{w}_found")
    starts = F.filter(
        F.transform(
            c,
            lambda x, i: F.when(
                (x["h"] == F.get(c, i - 1)["h"]) | (x["h"] == F.get(c, i + 1)["h"]), x["i"]
            ),
        ),
        lambda x: x.isNotNull(),
    )
    df = df.select(*own, *rest[:4], F.sort_array(starts).alias(f"{w}_starts"))
    p = F.col(f"{w}_starts")
    # a window covers three words, fewer where the next repeated window begins
    covered = F.aggregate(
        F.transform(p, lambda x, i: F.coalesce(F.least(F.lit(3), F.get(p, i + 1) - x), F.lit(3))),
        F.lit(0),
        lambda a, x: a + x,
    )
    whole = F.col(f"{w}_text")
    count = lambda pattern: F.regexp_count(whole, F.lit(pattern))
    counts = F.struct(
        F.size(words).cast("long").alias("n_words"),
        F.char_length(F.array_join(words, "")).cast("long").alias("word_chars"),
        count(r"[#*$%&|<>]").cast("long").alias("n_symbols"),
        F.col(f"{w}_dup_lines").cast("long").alias("n_dup_lines"),
        F.when(F.size(p) > 0, covered).otherwise(0).cast("long").alias("n_repeat_words"),
        F.col(f"{w}_n_lines").cast("long").alias("n_lines"),
        count(r"[A-ZÀ-Þ]").cast("long").alias("n_capitals"),
        count("!").cast("long").alias("n_exclamations"),
        F.size(F.array_distinct(words)).cast("long").alias("n_distinct"),
        F.size(F.filter(words, lambda x: F.lower(x).isin(FUNCTION_WORDS)))
        .cast("long")
        .alias("n_function"),
        (
            F.size(words)
            - count(rf"[#*$%&|<>=_~^!]+[.,]?(?=[{SPACE_CLASS}]|$)")
        )
        .cast("long")
        .alias("n_plain"),
    )
    return df.select(*own, counts.alias(name))


def _shift_left(n: Column) -> Column:
    """1 shifted by ``n`` bits, as a long."""
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), n)


def vote(rule: Rule, counts: Column) -> Column:
    """1, -1 or 0; a measure without a denominator abstains."""
    over, under = rule.measure.split(" / ")
    share = F.when(counts[under] > 0, counts[over] / counts[under])
    good, bad = (
        (share <= rule.good, share >= rule.bad)
        if rule.good < rule.bad
        else (share >= rule.good, share <= rule.bad)
    )
    return F.when(good, 1).when(bad, -1).otherwise(0).cast("int")


def add_votes(df: DataFrame, text: str, name: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``df`` with a struct ``name``: the counts, base_failed, and ``votes`` (one per rule)."""
    df = add_counts(df, text, name)
    n = F.col(name)
    base = (n["n_words"] < MIN_WORDS) | (
        100 * n["n_repeat_words"] > MAX_REPEAT_PERCENT * n["n_words"]
    )
    votes = F.struct(*(vote(r, n).alias(r.name) for r in rules))
    return df.withColumn(
        name, n.withField("base_failed", base).withField("votes", votes)
    )


VOTES = (-1, 0, 1)
#: What a rule is taken to do before anything is known: how often it gives each of
#: :data:`VOTES` to a good text and to a bad one.
START = {"good": (0.02, 0.08, 0.90), "bad": (0.40, 0.20, 0.40)}
START_PRIOR = 0.9


@dataclass(frozen=True)
class Model:
    """The share of good texts, and how often each rule gives each vote to either kind."""

    prior: float
    good: dict[str, tuple[float, ...]]
    bad: dict[str, tuple[float, ...]]

    def posterior(self, votes: Column) -> Column:
        """Probability of good, given a struct of votes."""
        score = F.lit(log(self.prior / (1 - self.prior)))
        for rule in self.good:
            weights = [log(g / b) for g, b in zip(self.good[rule], self.bad[rule], strict=True)]
            vote = votes[rule]
            score = score + F.when(vote < 0, weights[0]).when(vote > 0, weights[2]).otherwise(
                weights[1]
            )
        return 1 / (1 + F.exp(-score))

    def accuracy(self, rule: str) -> float:
        """How often the rule is right where it does not abstain, by this model."""
        right = self.prior * self.good[rule][2] + (1 - self.prior) * self.bad[rule][0]
        wrong = self.prior * self.good[rule][0] + (1 - self.prior) * self.bad[rule][2]
        return right / (right + wrong)


def fit(votes: DataFrame, rules: tuple[Rule, ...] = RULES, rounds: int = 40) -> Model:
    """Expectation-maximisation over all rows of ``votes`` (a column per rule).

    Rows with the same votes count together, so a round works on at most 3^rules
    rows however many texts there are, and hands a few numbers to the driver. Each rule
    has its own accuracy on good and on bad texts, abstentions included: a rule that
    seldom condemns good texts weighs more when it does. Every frequency is smoothed by
    one row in a thousand, the prior stays between 0.02 and 0.98, and no rule comes to
    condemn good texts more often than bad ones, so the two kinds can't change places.
    Stops when nothing moves by over 1e-4. An empty table leaves the starting values.
    """
    names = [r.name for r in rules]
    patterns = saved(votes.groupBy(*names).agg(F.count("*").alias("rows")).coalesce(1), "votes")
    model = Model(START_PRIOR, dict.fromkeys(names, START["good"]), dict.fromkeys(names, START["bad"]))
    every = F.struct(*names)
    by_rule = F.array(*(F.struct(F.lit(x).alias("rule"), F.col(x).alias("vote")) for x in names))
    for _ in range(rounds):
        cast = (
            patterns.withColumn("good", model.posterior(every))
            .select("rows", "good", F.explode(by_rule).alias("cast"))
            .groupBy("cast.rule", "cast.vote")
            .agg(
                F.sum(F.col("rows") * F.col("good")).alias("good"),
                F.sum(F.col("rows") * (1 - F.col("good"))).alias("bad"),
            )
            .collect()
        )
        sums = {f"{kind}_{r['rule']}_{r['vote']}": r[kind] for r in cast for kind in ("good", "bad")}
        for kind in ("good", "bad"):
            sums[kind] = sum(sums.get(f"{kind}_{names[0]}_{v}", 0.0) for v in VOTES)
        if not cast:
            return model
        every_row = sums["good"] + sums["bad"]
        soft = every_row / 1000
        share = {
            kind: {
                x: tuple(
                    (sums.get(f"{kind}_{x}_{v}", 0.0) + soft * START[kind][i]) / (sums[kind] + soft)
                    for i, v in enumerate(VOTES)
                )
                for x in names
            }
            for kind in ("good", "bad")
        }
        for x in names:
            if share["good"][x][0] > share["bad"][x][0]:
                share["good"][x] = share["bad"][x] = tuple(
                    (sum(sums.get(f"{k}_{x}_{v}", 0.0) for k in share) + soft / 3) / (every_row + soft)
                    for v in VOTES
                )
        new = Model(min(0.98, max(0.02, sums["good"] / every_row)), share["good"], share["bad"])
        moved = abs(new.prior - model.prior) + max(
            abs(p - q)
            for x in names
            for old, now in ((model.good[x], new.good[x]), (model.bad[x], new.bad[x]))
            for p, q in zip(old, now, strict=True)
        )
        model = new
        if moved < 1e-4:
            break
    return model


def judge(df: DataFrame, text: str = "text", threshold: float = THRESHOLD) -> tuple[DataFrame, str]:
    """``df`` with a struct of counts, base_failed, votes, ``quality`` and ``kept``; its name.

    ``df`` is written to the shared folder with its votes, so that texts are read once;
    drop columns that are not needed before, or pass none but the text.
    Null and empty texts fail the base. Repeated rows are judged alike.
    """
    name = fresh(df.columns, "quality")
    voted = saved(add_votes(df, text, name), "votes")
    return judged(voted, name, threshold), name


def judged(voted: DataFrame, name: str, threshold: float = THRESHOLD) -> DataFrame:
    """The verdicts on rows with a struct ``name`` of votes."""
    model = fit(voted.select(f"{name}.votes.*"))
    n = F.col(name)
    good = model.posterior(n["votes"])
    return voted.withColumn(
        name,
        n.withField("quality", good).withField(
            "kept", ~n["base_failed"] & (good >= F.lit(threshold))
        ),
    )


def quality_report(df: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, quality)."""
    rows = df.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").alias("text"))
    voted = saved(add_votes(rows, "text", "q").select("id", "q"), "votes")
    q = F.col("q")
    return judged(voted, "q").select(
        F.col("id").alias(key),
        *(
            q[c].alias(c)
            for c in (
                "n_words",
                "word_chars",
                "n_symbols",
                "n_dup_lines",
                "n_repeat_words",
                "base_failed",
                "kept",
            )
        ),
        F.col("q.quality").alias("quality"),
    )


def keep_good(df: DataFrame, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``df`` whose text is kept, with the columns of ``df``."""
    found, name = judge(df, text, threshold)
    return found.where(F.col(name)["kept"]).select(*(f"`{c}`" for c in df.columns))
