"""Quality rules combined by weak supervision, in DataFrame operations only.

Each rule looks at a text and votes good (1), bad (0) or abstains (null). Expectation-maximisation
over the votes of the whole corpus estimates the share of good texts and each rule's accuracy in
either class; a text's quality is the posterior probability of good given its votes, and it is kept
from min_posterior on. So a rule that often errs weighs little, and a text need not pass all rules.

Votes are aggregated to counts of vote patterns, combined before their shuffle: there are 3 to the
power of the number of rules at most, whatever the corpus, and the iterations run on them. Texts
are measured once: rows are written with their votes, counted, and filtered as they are read again;
nothing that grows with the corpus is shuffled.

Words are runs of characters other than space and U+0009 to U+000D. Defined results: a null or
empty text has no words and fails; a posterior that equals the least one is kept; a very long text is
measured whole, in time that grows with its length (and its logarithm, as windows are sorted); repeated
rows give repeated results; an empty table gives no rows. keep_good keeps columns of any name; in a
report the id column may have any name but those of the report.
"""

from __future__ import annotations

import math
import unicodedata

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm import _common as C

BLANK = r"[\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\f\r"
#: Capital letters of the scripts that have them up to U+058F (Latin, Greek, Cyrillic, Armenian).
CAPITALS = "".join(c for c in map(chr, range(0x590)) if unicodedata.category(c) == "Lu")
SYMBOLS = "#*$%&|<>"
MIN_WORDS, MAX_REPEAT_PERCENT = 10, 20
#: Iterations end when no estimate moves by more than the tolerance.
ITERATIONS, TOLERANCE, MIN_POSTERIOR = 12, 1e-12, 0.5
#: Frequent function words of English, German, French and Spanish. Fixed values.
COMMON = ("the", "of", "and", "to", "in", "is", "that", "for", "was", "with", "der", "die", "und", "den", "von", "zu", "das", "mit", "ist", "sich", "le", "la", "les", "des", "et", "en", "un", "une", "du", "que", "el", "los", "las", "y", "por", "con", "para", "su", "al", "de")


def words(text: Column) -> Column:
    return F.filter(F.split(text, BLANK), lambda w: w != "")


def repeated_words(ws: Column) -> Column:
    """Words within five-word windows that stand in the text twice or more (the first time included).

    Linear but for one sort: hashes of windows with their places are sorted, equal neighbours give
    the places, and consecutive places cover 5 words or, where they overlap, their distance.
    """
    h = F.transform(ws, lambda w: F.xxhash64(w))
    n = F.size(ws)

    def windows(hs: Column) -> Column:
        return F.transform(F.slice(hs, 1, F.greatest(F.size(hs) - 4, F.lit(0))), lambda x, i: F.xxhash64(x, F.get(hs, i + 1), F.get(hs, i + 2), F.get(hs, i + 3), F.get(hs, i + 4)))

    def let(value: Column, body) -> Column:  # noqa: ANN001
        """body(value) with value worked out once."""
        return F.get(F.transform(F.array(value), body), F.lit(0))

    def places(win: Column) -> Column:
        ordered = F.array_sort(F.transform(win, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        same = lambda o, a, b: F.get(o, a)["h"].eqNullSafe(F.get(o, b)["h"])
        return let(ordered, lambda o: F.array_sort(F.transform(F.filter(F.transform(o, lambda x, k: F.struct(x["i"].alias("i"), ((k > 0) & same(o, k - 1, k) | same(o, k + 1, k)).alias("twice"))), lambda x: x["twice"]), lambda x: x["i"])))

    def covered(p: Column) -> Column:
        return F.aggregate(F.transform(p, lambda x, k: F.when(k == 0, F.lit(5)).otherwise(F.least(F.lit(5), x - F.get(p, k - 1)))), F.lit(0).cast("long"), lambda a, x: a + x)

    some = let(h, lambda hs: let(windows(hs), lambda win: F.when(F.size(F.array_distinct(win)) == F.size(win), F.lit(0).cast("long")).otherwise(let(places(win), covered))))
    return F.when(n < 6, F.lit(0).cast("long")).otherwise(some)


def share(part: Column, whole: Column) -> Column:
    return part / F.greatest(whole, F.lit(1))


def measure(df: DataFrame, text_col: str = "text") -> DataFrame:
    """df with columns __m_<name> of what the rules look at.

    Flat columns, as fields of a struct would be worked out anew wherever they are used.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    df = df.withColumn("__t", text).withColumn("__w", words(F.col("__t"))).withColumn("__l", F.filter(F.split("__t", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    t, w, lines = F.col("__t"), F.col("__w"), F.col("__l")
    without = lambda chars: F.length(F.translate(t, chars, ""))
    long = lambda c: c.cast("long")
    m = {
        "n_words": long(F.size(w)),
        "word_chars": long(without(BLANKS)),
        "n_symbols": long(F.length(t) - without(SYMBOLS)),
        "n_dup_lines": long(F.size(lines) - F.size(F.array_distinct(lines))),
        "n_repeat_words": repeated_words(w),
        "n_lines": long(F.size(lines)),
        "n_distinct": long(F.size(F.array_distinct(w))),
        "n_upper": long(F.length(t) - without(CAPITALS)),
        "n_common": long(F.size(F.filter(w, lambda x: F.lower(x).isin(*COMMON)))),
        "n_bangs": long(F.length(t) - without("!")),
        "n_stops": long(F.size(F.filter(w, lambda x: F.substring(x, -1, 1).isin(".", "!", "?", ":")))),
    }
    return df.select("*", *(c.alias(f"__m_{k}") for k, c in m.items())).drop("__t", "__w", "__l")


def measured() -> dict[str, Column]:
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct", "n_upper", "n_common", "n_bangs", "n_stops")
    return {k: F.col(f"__m_{k}") for k in names}


def rules(m: dict[str, Column]) -> dict[str, Column]:
    """Votes: 1 good, 0 bad, null abstains. Each has a band between in which it does not know."""
    n = m["n_words"]

    def vote(good: Column, bad: Column) -> Column:
        return F.when(bad, F.lit(0)).when(good, F.lit(1))

    sym, dup, rep = share(m["n_symbols"], n), share(m["n_dup_lines"], m["n_lines"]), share(m["n_repeat_words"], n)
    up, common, distinct = share(m["n_upper"], m["word_chars"]), share(m["n_common"], n), share(m["n_distinct"], n)
    per, bangs, stops = share(m["word_chars"], n), share(m["n_bangs"], n), share(n, m["n_stops"])
    return {
        "symbols": vote(sym < 0.02, sym > 0.1),
        "dup_lines": vote((dup < 0.1) & (m["n_lines"] > 2), dup > 0.34),
        "repeats": vote((rep < 0.05) & (n > 50), rep > 0.2),
        "capitals": vote((up > 0) & (up < 0.1), up > 0.3),
        "common": vote(common > 0.08, (common < 0.03) & (n > 30)),
        "distinct": vote((distinct > 0.4) & (n > 30), (distinct < 0.25) & (n < 2000)),
        "word_length": vote((per > 3.5) & (per < 7), (per < 2) | (per > 9)),
        "bangs": vote(bangs < 0.02, bangs > 0.1),
        "sentences": vote(stops < 40, (stops > 100) & (n > 100)),
    }


def votes(df: DataFrame, text_col: str = "text") -> DataFrame:
    """df with what measure adds and the votes __v_<rule>."""
    df = measure(df, text_col)
    return df.select("*", *(v.cast("int").alias(f"__v_{k}") for k, v in rules(measured()).items()))


def estimate(voted: DataFrame, iterations: int = ITERATIONS) -> tuple[float, dict[str, tuple[float, float]]]:
    """(share of good, {rule: (how often it votes good on good ones, how often on bad ones)}).

    The E step gives each vote pattern its posterior, the M step averages votes by it; both run over
    the table of patterns, 3 to the power of the rules at most. It starts from what the rules are
    made for: a good text seldom breaks any of them, a bad one breaks some and obeys others, as
    there are several kinds of bad texts. Counts are smoothed by one, so an unused rule says nothing.
    """
    names = [c for c in voted.columns if c.startswith("__v_")]
    patterns = C.materialise(voted.groupBy(*names).agg(F.count(F.lit(1)).alias("__n")), "votes", folded=True)
    prior, says = 0.8, {k: (0.98, 0.7) for k in names}
    for _ in range(iterations):
        good, bad = F.col("__n") * F.col("__p"), F.col("__n") * (1 - F.col("__p"))
        sums = [F.sum(good).alias("g"), F.sum("__n").alias("n")]
        for k in names:
            sums += [F.sum(F.when(F.col(k) == 1, x)).alias(f"{a}1_{k}") for a, x in (("g", good), ("b", bad))]
            sums += [F.sum(F.when(F.col(k).isNotNull(), x)).alias(f"{a}_{k}") for a, x in (("g", good), ("b", bad))]
        s = patterns.withColumn("__p", posterior(prior, says)).agg(*sums).first()
        if not s["n"]:
            break
        was = [prior, *(x for k in names for x in says[k])]
        prior = (s["g"] + 1) / (s["n"] + 2)
        says = {k: tuple(((s[f"{a}1_{k}"] or 0) + 1) / ((s[f"{a}_{k}"] or 0) + 2) for a in "gb") for k in names}
        if max(abs(x - y) for x, y in zip(was, [prior, *(x for k in names for x in says[k])])) < TOLERANCE:
            break
    return prior, says


def posterior(prior: float, says: dict[str, tuple[float, float]]) -> Column:
    """Probability of good given the votes; an abstention says nothing."""
    odds = F.lit(math.log(prior / (1 - prior)))
    for k, (g, b) in says.items():
        yes, no = math.log(g / b), math.log((1 - g) / (1 - b))
        odds = odds + F.when(F.col(k) == 1, F.lit(yes)).when(F.col(k) == 0, F.lit(no)).otherwise(F.lit(0.0))
    return 1 / (1 + F.exp(-odds))


BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def failed() -> Column:
    """The base rules, by what measure adds."""
    m = measured()
    return (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > MAX_REPEAT_PERCENT * m["n_words"])


def quality_report(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_posterior: float = MIN_POSTERIOR) -> DataFrame:
    """One row per input row: id, the base measures, base_failed, quality, kept. Votes are written once, without texts."""
    voted = votes(df.select(F.col(f"`{id_col}`").alias("__id"), F.col(f"`{text_col}`").alias("__text")), "__text")
    voted = C.materialise(voted.drop("__text"), "measures")
    prior, says = estimate(voted)
    m, quality = measured(), posterior(prior, says)
    kept = ~F.col("base_failed") & (F.col("quality") >= min_posterior)
    out = voted.select(F.col("__id").alias(id_col), *(m[k].alias(k) for k in BASE), failed().alias("base_failed"), quality.alias("quality"))
    return out.withColumn("kept", kept)


def keep_good(df: DataFrame, text_col: str = "text", min_posterior: float = MIN_POSTERIOR) -> DataFrame:
    """The rows of df that are kept, with df's columns.

    Rows are written with their votes (those that fail the base rules without their contents), so a
    text is measured once, and the decision needs only a scan.
    """
    row = F.struct(*(F.col(f"`{c}`") for c in df.columns))
    voted = votes(df.select(row.alias("__row"), F.col(f"`{text_col}`").alias("__text")), "__text")
    voted = C.materialise(voted.select(F.when(~failed(), F.col("__row")).alias("__row"), *(c for c in voted.columns if c.startswith("__v_"))), "voted")
    prior, says = estimate(voted)
    return voted.filter(F.col("__row").isNotNull() & (posterior(prior, says) >= min_posterior)).select(*(F.col("__row").getField(c).alias(c) for c in df.columns))
