"""Quality rules as weak supervision: rules vote or abstain, and the probability of quality decides.

Each rule says good, bad or nothing of a document. How often it says each of good and of bad documents is
estimated by expectation-maximisation from the votes of all documents alone; a document's posterior
probability weighs its votes by that. Documents with equal votes are alike, so the estimation runs over the
distinct vote patterns and their counts, at most 3 to the power of the number of rules.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kglake.llm import shared

SYMBOLS = "#*$%&|<>"
WINDOW = 8
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_distinct_words", "n_lines",
            "n_letters", "n_upper", "n_ended")
ENDS = (".", "!", "?", ":", ";", "…", "。", "\"", "'", ")")
GOOD, BAD, NONE = 2, 0, 1
# Starting beliefs: how often a rule says bad, nothing, good of bad documents and of good ones.
START = ((0.3, 0.6, 0.1), (0.01, 0.39, 0.6))
PRIOR_GOOD = 0.8
EM_STEPS = 100
SMOOTHING = 1.0
# Texts of a batch that are Python strings at a time.
SLICE = 512


def repeated_words(ids: np.ndarray, distinct: int, window: int = WINDOW) -> int:
    """Words that lie in some window of `window` words which occurs at least twice; exact, `window` a power of two."""
    n = len(ids) - window + 1
    if n < 2:
        return 0
    names, count, size = ids, distinct, 1
    while size < window:  # names of windows of twice the size, from pairs of names
        pairs = names[:len(names) - size] * count + names[size:]
        found, names = np.unique(pairs, return_inverse=True)
        count = len(found)
        if count == len(names) and size * 2 == window:
            return 0
        size *= 2
    again = np.flatnonzero(np.bincount(names, minlength=count)[names] > 1)
    edges = np.zeros(len(ids) + 1, np.int64)
    np.add.at(edges, again, 1)
    np.add.at(edges, again + window, -1)
    return int((np.cumsum(edges[:-1]) > 0).sum())


def measure_text(text: str | None) -> tuple[int, ...]:
    """The `MEASURES` of a whole text; white space is space and the characters from tab to carriage return."""
    if not text:
        return (0,) * len(MEASURES)
    words = text.encode("utf-8", "surrogatepass").split()
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
    lines = [line for line in text.split("\n") if line.strip(shared.SPACE_BYTES)]
    ended = sum(line.rstrip(shared.SPACE_BYTES).endswith(ENDS) for line in lines)
    lower, upper = text.lower(), text.upper()
    letters = upper_letters = 0
    if lower != upper:
        letters = sum(map(str.isalpha, text))
        upper_letters = sum(map(str.isupper, text))
    return (len(words), len(text) - sum(map(text.count, shared.SPACE_BYTES)), sum(map(text.count, SYMBOLS)),
            len(lines) - len(set(lines)), repeated_words(ids, len(known)), len(known), len(lines),
            letters, upper_letters, ended)


def measure(docs: DataFrame) -> DataFrame:
    """`docs` with the `MEASURES` of each row's whole text; clashing columns of `docs` are replaced."""
    names = [c for c in docs.columns if c not in MEASURES]

    @F.arrow_udf(", ".join(f"{name} long" for name in MEASURES))
    def run(texts: pa.Array) -> pa.Array:
        rows = (measure_text(text) for at in range(0, len(texts), SLICE) for text in texts.slice(at, SLICE).to_pylist())
        flat = np.fromiter((value for row in rows for value in row), np.int64, len(texts) * len(MEASURES)).reshape(-1, len(MEASURES))
        return pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(len(MEASURES))], names=list(MEASURES))

    # Texts alone go to Python; the rows wait in Spark. An indeterminate column is not computed again by a filter above it.
    found = docs.select(*names, F.struct(run.asNondeterministic()("text").alias("of")).alias("measures_"))
    return found.select(*names, *[F.col("measures_")["of"][name].alias(name) for name in MEASURES])


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def votes() -> dict[str, Column]:
    """The rules over `MEASURES`: good, bad or no vote.

    A rule against one kind of junk says nothing of other documents, for lacking one fault proves nothing; the
    two rules for prose ask for several signs at once and say nothing where one is missing. A share of nothing
    is null, on which rules say nothing.
    """
    words = F.col("n_words").cast("double")
    length = F.try_divide(F.col("word_chars"), words)
    symbols = F.try_divide(F.col("n_symbols"), words)
    # A text of many words repeats its words: the bar falls with the length.
    variety = F.try_divide(F.col("n_distinct_words"), F.pow(words, F.lit(0.85)))
    again = F.try_divide("n_dup_lines", "n_lines")
    upper = F.try_divide("n_upper", "n_letters")
    letters = F.try_divide("n_letters", "word_chars")
    ended = F.try_divide("n_ended", "n_lines")

    def against(fault: Column) -> Column:
        return F.when(fault, BAD).otherwise(NONE)

    def in_favour(sign: Column) -> Column:
        return F.when(sign, GOOD).otherwise(NONE)

    return {
        "word_length": against((length < 2) | (length > 14)),
        "symbols": against(symbols > 0.15),
        "repeated_words": against(100 * F.col("n_repeat_words") > 28 * F.col("n_words")),
        "few_words": against(variety < 0.4),
        "repeated_lines": against(again > 0.3),
        "capitals": against(upper > 0.4),
        "letters": against(letters < 0.6),
        "sentences": in_favour((ended > 0.5) & (upper < 0.2) & (symbols < 0.05)),
        "wording": in_favour((letters > 0.75) & (length >= 2.5) & (length <= 12) & (variety > 0.6)
                              & (upper < 0.2) & (symbols < 0.05)),
    }


def estimate(patterns: np.ndarray, counts: np.ndarray, steps: int = EM_STEPS) -> tuple[np.ndarray, float, np.ndarray]:
    """Vote rates `[class, rule, vote]` (class 1 is good), the share of good documents, each pattern's posterior.

    A rule that speaks against the sense of its votes counts as saying nothing.
    """
    rules = patterns.shape[1]
    rates = np.repeat(np.array(START)[:, None, :], rules, 1)
    good, total = PRIOR_GOOD, max(1.0, float(counts.sum()))
    each = np.arange(rules)
    posterior = np.full(len(patterns), PRIOR_GOOD)
    for _ in range(steps):
        logs = np.log(rates[:, each[None, :], patterns]).sum(2)
        odds = np.clip(logs[1] - logs[0] + np.log(good / (1 - good)), -500, 500)
        before, posterior = posterior, 1 / (1 + np.exp(-odds))
        good = float(np.clip((posterior * counts).sum() / total, 0.05, 0.95))
        for cls, weight in ((0, (1 - posterior) * counts), (1, posterior * counts)):
            for vote in (BAD, NONE, GOOD):
                # The starting belief counts as `SMOOTHING` documents, so no rate is 0.
                rates[cls, :, vote] = ((patterns == vote) * weight[:, None]).sum(0) + SMOOTHING * START[cls][vote]
            rates[cls] /= rates[cls].sum(1, keepdims=True)
        wrong = (rates[0, :, BAD] < rates[1, :, BAD]) & (rates[0, :, GOOD] > rates[1, :, GOOD])
        rates[:, wrong] = rates[:, wrong].mean(0)
        if np.abs(posterior - before).max(initial=0) < 1e-12:
            break
    return rates, good, posterior


def _voted(docs: DataFrame) -> DataFrame:
    return measure(docs).select("*", *[v.alias(f"vote_{k}") for k, v in votes().items()])


def _verdicts(measured: DataFrame, voted: DataFrame, threshold: float) -> DataFrame:
    """`measured` with `base_failed`, `p_quality` and `kept`, by the beliefs that the votes of `voted` lead to."""
    names = [f"vote_{name}" for name in votes()]
    found = voted.groupBy(*names).count().orderBy(*names).collect()  # at most 3 ** rules patterns
    patterns = np.array([row[:-1] for row in found], np.int64).reshape(-1, len(names))
    _, _, posterior = estimate(patterns, np.array([row[-1] for row in found], float))
    code = sum((F.col(name) * 3 ** k for k, name in enumerate(names)), F.lit(0))
    codes = (patterns * 3 ** np.arange(len(names))).sum(1)
    table = measured.sparkSession.createDataFrame(
        [(int(c), float(p)) for c, p in zip(codes, posterior)], "code int, p_quality double")
    failed = base_failed()
    return (measured.withColumn("code", code.cast("int")).join(F.broadcast(table), "code").drop("code")
            .withColumn("base_failed", failed)
            .withColumn("kept", ~failed & (F.col("p_quality") >= threshold)))


def judge(docs: DataFrame, threshold: float = 0.5, with_text: bool = True) -> DataFrame:
    """`docs` with `MEASURES`, the votes as `vote_<rule>`, `base_failed`, `p_quality` and `kept`.

    A null text is an empty one: it fails the base rule and no other rule says anything of it. Repeated rows
    are judged each. Columns of `docs` with those names are replaced. An empty table gives an empty result. Rows are stored with
    their measures; without `with_text` their texts are not, nor returned.
    """
    added = {*MEASURES, *[f"vote_{name}" for name in votes()], "base_failed", "p_quality", "kept"}
    measured = _voted(docs.select(*[c for c in docs.columns if c not in added]))
    measured = shared.stored(measured if with_text else measured.drop("text"), "quality")
    return _verdicts(measured, measured, threshold)


def kept_documents(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows of `docs` that `judge` keeps, with all their columns as they are, whatever their names.

    Texts are measured twice, once for the votes and once for the verdicts, so no text is stored.
    """
    voted = shared.stored(_voted(docs.select("text")).select(*[f"vote_{name}" for name in votes()]), "votes")
    measured = _voted(docs.select(F.struct(*docs.columns).alias("row"), "text"))
    return _verdicts(measured, voted, threshold).where("kept").select("row.*")
