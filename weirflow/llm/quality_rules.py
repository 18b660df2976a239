"""Quality rules by weak supervision: rules vote or abstain, expectation-maximisation weighs them.

Each rule says good (1), bad (-1) or nothing (0) about a document. The votes are summed up to one row per
vote pattern, at most 3 to the power of the number of rules, and expectation-maximisation runs on those
rows: both classes have a frequency, and each rule has, per class, the probability of each vote (its
accuracy). A document is kept if its posterior probability of being good reaches a half.

Null or empty text has no words and is rejected by the base rule. Repeated rows are judged alike and each
counts. An empty table gives an empty result. Columns of the input other than id and text play no part.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from weirflow.llm.common import BLANKS, let, words
from weirflow.session import cut_lineage

SYMBOLS = "#*$%&|<>"
LINE_ENDS = ".!?:;\"')"
#: Frequent function words of English, German, French and Spanish.
FUNCTION_WORDS = (
    "the of and to in that is was it for with as on be at by this from or an are not but had his they you which have "
    "der die das und ist in den von zu mit sich des auf für im dem nicht ein eine als auch es an "
    "le la les de des et en un une du que est pour qui dans par sur au pas plus ce il "
    "el los las y que es por con una para del se no su al lo como más"
).split()
#: Insults; a parameter of ``measures``.
INSULTS = (
    "idiot idiots stupid moron morons dumb trash garbage scum filth filthy vermin worthless disgusting pathetic loser "
    "losers imbecile retard retarded bastard bitch whore slut asshole shit fuck fucking crap cunt"
).split()

MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_terms", "n_distinct_terms",
    "n_function_words", "n_insults", "n_upper", "n_exclaims", "n_ended_lines",
)


def _windows(w: Column) -> Column:
    """64-bit hashes of all 3-word windows, in order."""
    return F.when(F.size(w) < 4, F.array().cast("array<bigint>")).otherwise(F.transform(F.slice(w, 1, F.size(w) - 2), lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2))))


def _covered(windows: Column) -> Column:
    """Words that lie in a window found twice or more: equal windows meet by sorting, overlaps count once."""
    ordered = F.sort_array(F.transform(windows, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

    def places(s: Column) -> Column:
        twice = F.filter(s, lambda x, j: F.coalesce(F.get(s, j + 1)["h"] == x["h"], F.lit(False)) | ((j > 0) & (F.get(s, F.greatest(j - 1, F.lit(0)))["h"] == x["h"])))
        return F.sort_array(F.transform(twice, lambda x: x["i"]))

    def total(p: Column) -> Column:
        steps = F.zip_with(p, F.slice(p, 2, F.size(p)), lambda a, b: F.least(F.lit(3), F.coalesce(b - a, F.lit(3))))
        return F.aggregate(steps, F.lit(0), lambda acc, x: acc + x)

    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(let(let(ordered, places), total))


def _insults(terms: Column, insults: list[str]) -> Column:
    """How many of the words are insults; most texts have none and are not read word by word."""
    listed = F.array(*[F.lit(x) for x in insults])
    return F.when(F.arrays_overlap(terms, listed), F.size(F.filter(terms, lambda x: x.isin(list(insults))))).otherwise(0)


def measures(docs: DataFrame, text: str = "text", carry: list[str] | None = None, insults: list[str] = INSULTS) -> DataFrame:
    """``carry`` columns of ``docs`` (all by default) as struct ``doc``, and the counts the rules are made of (struct ``m``)."""
    t = F.coalesce(F.col("d")["t"], F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != "")
    doc = F.struct(*[F.col(f"`{c}`") for c in (docs.columns if carry is None else carry)])
    # One pass over the signs of a text leaves only those that are counted.
    signs = F.regexp_replace(t, rf"[^\p{{Lu}}!{SYMBOLS}]+", "")
    staged = docs.select(doc.alias("doc"), F.struct(F.col(f"`{text}`").alias("t")).alias("d")).select(
        "doc", words(t).alias("w"), lines.alias("l"), F.array_remove(F.split(F.lower(t), r"[^\p{L}]+"), "").alias("terms"), signs.alias("signs"),
    ).withColumns({"windows": _windows(F.col("w")), "n_insults": _insults(F.col("terms"), insults)})
    left = lambda unlike: F.length(F.regexp_replace("signs", unlike, ""))
    count = {
        "n_words": F.size("w"), "word_chars": F.length(F.array_join("w", "")), "n_symbols": left(rf"[^{SYMBOLS}]+"),
        "n_dup_lines": F.size("l") - F.size(F.array_distinct("l")), "n_repeat_words": _covered(F.col("windows")),
        "n_lines": F.size("l"), "n_terms": F.size("terms"), "n_distinct_terms": F.size(F.array_distinct("terms")),
        "n_function_words": F.size(F.filter("terms", lambda x: x.isin(FUNCTION_WORDS))), "n_insults": F.col("n_insults"),
        "n_upper": left(r"\P{Lu}+"), "n_exclaims": left("[^!]+"),
        "n_ended_lines": F.size(F.filter("l", lambda x: F.substring(F.btrim(x, F.lit(BLANKS)), -1, 1).isin(*LINE_ENDS))),
    }
    return staged.select("doc", F.struct(*[count[k].cast("long").alias(k) for k in MEASURES]).alias("m"))


@dataclass(frozen=True)
class Rule:
    """Votes bad or good where the condition holds, else abstains."""

    name: str
    bad: str
    good: str = "false"

    def vote(self) -> Column:
        return F.when(F.expr(self.bad), -1).when(F.expr(self.good), 1).otherwise(0).cast("tinyint")


#: Shares are of words unless they say otherwise; ``m`` is the struct of ``measures``.
RULES = (
    Rule("word_length", "m.word_chars < 2.5 * m.n_words OR m.word_chars > 12 * m.n_words", "m.word_chars BETWEEN 3.5 * m.n_words AND 9 * m.n_words"),
    Rule("symbols", "10 * m.n_symbols > m.n_words", "m.n_symbols = 0"),
    Rule("many_symbols", "10 * m.n_symbols > 3 * m.n_words"),
    Rule("dup_lines", "10 * m.n_dup_lines > 3 * m.n_lines"),
    Rule("repeats", "5 * m.n_repeat_words > m.n_words", "50 * m.n_repeat_words <= m.n_words"),
    Rule("capitals", "10 * m.n_upper > 3 * m.word_chars", "10 * m.n_upper <= m.word_chars"),
    Rule("exclaims", "20 * m.n_exclaims > m.n_words"),
    Rule("variety", "5 * m.n_distinct_terms < m.n_terms", "5 * m.n_distinct_terms >= 2 * m.n_terms"),
    Rule("function_words", "50 * m.n_function_words < m.n_terms", "20 * m.n_function_words >= m.n_terms"),
    Rule("letters", "10 * m.n_terms < 7 * m.n_words", "10 * m.n_terms >= 9 * m.n_words"),
    Rule("line_ends", "10 * m.n_ended_lines < m.n_lines", "2 * m.n_ended_lines >= m.n_lines"),
    Rule("insults", "m.n_insults >= 2 AND 200 * m.n_insults >= m.n_words"),
)

VOTES = (-1, 0, 1)


def base_failed() -> Column:
    return (F.col("m.n_words") < 50) | (100 * F.col("m.n_repeat_words") > 50 * F.col("m.n_words"))


def _log_odds(votes: Column, model: Column) -> Column:
    """Log odds of good; ``model`` holds the prior's log odds, then three weights per rule."""
    return F.aggregate(F.transform(votes, lambda v, k: F.get(model, v.cast("int") + k * 3 + 2)), model[0], lambda acc, x: acc + x)


def _weights(prior: float, good: list[list[float]], bad: list[list[float]], least: float = math.log(2)) -> list[float]:
    """Log odds of the prior and of each vote. A rule is taken to be better than chance: a vote for bad counts at
    least ``least`` against a document, a vote for good never counts against it, silence never for either side."""
    out = [math.log(prior / (1 - prior))]
    for gs, bs in zip(good, bad):
        against, _, for_ = (math.log(g / b) for g, b in zip(gs, bs))
        out += [min(against, -least), 0.0, max(for_, 0.0)]
    return out


def fit(voted: DataFrame, n_rules: int, rounds: int = 40, tolerance: float = 1e-3, smoothing: float = 1e-3) -> list[float]:
    """Weights of ``_log_odds`` by expectation-maximisation over all rows of ``voted`` (``votes``: array of tinyint).

    Starts from rules that are right more often than not. ``smoothing`` is a share of all rows that votes as at the
    start, so a vote never seen keeps a finite weight. Per round three rows for each rule come to the driver.
    """
    start = {True: (0.05, 0.35, 0.6), False: (0.4, 0.4, 0.2)}
    prior, chance = 0.8, {c: [list(start[c])] * n_rules for c in start}
    patterns = cut_lineage(voted.groupBy("votes").agg(F.count(F.lit(1)).alias("n")).coalesce(1), "votes").coalesce(1)
    for _ in range(rounds):
        share = 1 / (1 + F.exp(-_log_odds(F.col("votes"), F.lit(_weights(prior, chance[True], chance[False])))))
        each = patterns.select("n", (F.col("n") * share).alias("g"), F.posexplode("votes").alias("k", "v"))
        sums = {(r.k, r.v): (r.g, r.n - r.g) for r in each.groupBy("k", "v").agg(F.sum("n").alias("n"), F.sum("g").alias("g")).collect()}
        g, b = (sum(sums.get((0, v), (0, 0))[i] for v in VOTES) for i in (0, 1))
        if not g + b:
            break
        extra, was = smoothing * (g + b), [prior, *(x for c in start for vs in chance[c] for x in vs)]
        prior = (g + 0.8 * extra) / (g + b + extra)
        chance = {c: [[(sums.get((k, v), (0, 0))[i] + extra * s) / (t + extra) for v, s in zip(VOTES, start[c])] for k in range(n_rules)] for c, i, t in ((True, 0, g), (False, 1, b))}
        if max(abs(x - y) for x, y in zip(was, [prior, *(x for c in start for vs in chance[c] for x in vs)])) < tolerance:
            break
    return _weights(prior, chance[True], chance[False])


def judge(docs: DataFrame, text: str = "text", carry: list[str] | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Every row of ``docs``: struct ``doc`` (the ``carry`` columns), struct ``m``, ``base_failed``, ``posterior``, ``kept``.

    The counts are made in one pass over the texts and written to the shared folder with the carried columns. The
    weights are fitted to all rows that the base rule leaves, since it is those that the votes decide about.
    """
    counted = measures(docs, text, carry)
    voted = cut_lineage(counted.select("doc", "m", F.array(*[r.vote() for r in rules]).alias("votes")), "judged")
    model = F.lit(fit(voted.filter(~base_failed()), len(rules)))
    scored = voted.select("doc", "m", base_failed().alias("base_failed"), (1 / (1 + F.exp(-_log_odds(F.col("votes"), model)))).alias("posterior"), "votes")
    return scored.withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= 0.5))


def keep_good(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that are kept, with its columns."""
    return judge(docs, text).filter("kept").select("doc.*")
