"""Quality rules whose cutoffs are certified on labelled documents.

A rule rejects a document if a number of it, symbols for each thousand code points for
instance, is above a cutoff. Cutoffs come from a fixed ladder per rule, laxest first. For
every stratum of documents and every rule the labelled good documents of the stratum test
the steps of the ladder in that order: a step is certified if the exact binomial probability
of seeing so few good documents rejected, were the true share of rejected good documents
above the rule's part of ``risk``, is at most the stratum's and rule's part of ``doubt``. The
first step that fails ends the ladder, so a ladder needs no correction of its own; over strata
and rules ``doubt`` is divided evenly (Bonferroni), and over rules ``risk``. So with
probability of at least ``1 - doubt`` no stratum loses more than ``risk`` of its good documents.

Among the certified steps that one is used which rejects the most labelled bad documents, of
equals the laxest. A rule without a certified step rejects nothing in that stratum: too few
labels never make a rule stricter. Only DataFrame expressions are used.
"""

from __future__ import annotations

from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import fresh, full_text, join_hot, put, written

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
LEAST_WORDS = 50
MOST_REPEATED = 50

RISK = 0.05
DOUBT = 0.1

# rule: what it counts, in how many, of which unit, and its ladder of cutoffs
RULES = {
    "symbols": ("n_symbols", "word_chars", 1000, (400, 300, 200, 150, 100, 70, 50, 30, 20, 10, 5)),
    "dup_lines": ("n_dup_lines", "n_lines", 100, (90, 80, 70, 60, 50, 40, 30, 25, 20, 15, 10)),
    "repeated": ("n_repeat_words", "n_words", 100, (45, 40, 35, 30, 25, 20, 15, 10)),
    "long_words": ("word_chars", "n_words", 100, (3000, 2000, 1500, 1200, 1000, 900, 800)),
}
COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def _covered(words: Column) -> Column:
    """Words in windows of three words that the list has twice or more.

    Windows are compared by hashes of 64 bits; two unlike ones of a text of a million words
    agree with a probability of 1 in 40 million.
    """
    windows = F.transform(
        F.sequence(F.lit(0), F.size(words) - 3),
        lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(3)]),
    )

    def spots(ordered: Column) -> Column:
        def same(x: Column, k: Column) -> Column:
            return F.coalesce(F.get(ordered, k)["hash"] == x["hash"], F.lit(False))

        marked = F.transform(
            ordered,
            lambda x, k: F.when(same(x, k - F.lit(1)) | same(x, k + F.lit(1)), x["at"]),
        )
        return _let(F.sort_array(F.filter(marked, lambda x: x.isNotNull())), _union_of_threes)

    def repeated(hashes: Column) -> Column:
        placed = F.transform(hashes, lambda x, i: F.struct(x.alias("hash"), i.alias("at")))
        # most texts repeat no window: they are not sorted
        twice = F.size(F.array_distinct(hashes)) < F.size(hashes)
        return F.when(twice, _let(F.sort_array(placed), spots)).otherwise(0)

    return F.when(F.size(words) > 3, _let(windows, repeated)).otherwise(0)


def _union_of_threes(starts: Column) -> Column:
    """How many places runs of three from ordered ``starts`` cover together."""
    steps = F.transform(
        starts, lambda x, k: F.least(F.lit(3), F.coalesce(F.get(starts, k + F.lit(1)) - x, F.lit(3)))
    )
    return F.aggregate(steps, F.lit(0), lambda so_far, x: so_far + x)


def _let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` evaluated once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _words(pieces: Column) -> Column:
    """Numbers of a text's words from its pieces between white space, empty ones included."""
    return _let(
        F.filter(pieces, lambda w: w != ""),
        lambda w: F.struct(
            F.size(w).alias("all"),
            _covered(w).alias("again"),
            (F.size(pieces) - 1).alias("spaces"),
        ),
    )


def _counts(text: Column) -> Column:
    """The counts of a text as a struct."""
    pieces = F.split(F.translate(text, SPACES, " " * len(SPACES)), " ", -1)
    lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(r"[^\x09-\x0D\x20]"))
    numbers = {
        "words": _let(pieces, _words),
        "lines": _let(
            lines,
            lambda x: F.struct(
                F.size(x).alias("all"), (F.size(x) - F.size(F.array_distinct(x))).alias("again")
            ),
        ),
        "chars": F.char_length(text),
        "others": F.char_length(F.translate(text, SYMBOLS, "")),
    }
    return F.struct(*[value.alias(name) for name, value in numbers.items()])


def with_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """Every row of ``docs`` with ``COUNTS`` and ``base_failed``.

    Words are runs without ASCII white space, ``word_chars`` their code points, ``n_lines``
    lines with a word and ``n_dup_lines`` those equal to an earlier one; ``n_repeat_words``
    counts the words that lie in a window of three words the text has twice or more.
    ``base_failed`` says that there are fewer than ``LEAST_WORDS`` words or that more than
    ``MOST_REPEATED`` of 100 are repeated.

    A null text is an empty one, whose counts are zero. Whole texts count whatever their
    length. Rows that repeat each other get equal results, an empty table gives an empty
    table, and columns named like a result are replaced.
    """
    (held,) = fresh(docs, "held")
    found = docs.withColumn(held, _let(full_text(text), _counts))
    words, lines, chars = found[held]["words"], found[held]["lines"], found[held]["chars"]
    numbers = {
        "n_words": words["all"],
        "word_chars": chars - words["spaces"],
        "n_symbols": chars - found[held]["others"],
        "n_lines": lines["all"],
        "n_dup_lines": lines["again"],
        "n_repeat_words": words["again"],
    }
    counted = put(found, {name: value.cast("long") for name, value in numbers.items()}).drop(held)
    failed = (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")
    )
    return put(counted, {"base_failed": failed})


def over(rule: str, cutoff: Column | int) -> Column:
    """Whether a counted document is above a cutoff of a rule, in whole numbers."""
    part, whole, unit, _ = RULES[rule]
    return unit * F.col(part) > cutoff * F.col(whole)


def binomial_tail(k: Column, n: Column, share: float) -> Column:
    """Probability of at most ``k`` of ``n`` where each is met with probability ``share``.

    The terms are added as logarithms, each made from the one before, so nothing under- or
    overflows; ``k`` at or above the expected number gives 1, which certifies nothing either.
    """
    odds = log(share) - log(1 - share)
    first = n * F.lit(log(1 - share))

    def add(so_far: Column, i: Column) -> Column:
        term = so_far["term"] + F.log((n - i + 1) / i) + F.lit(odds)
        high = F.greatest(term, so_far["total"])
        low = F.least(term, so_far["total"])
        return F.struct(term.alias("term"), (high + F.log1p(F.exp(low - high))).alias("total"))

    total = F.aggregate(
        F.when(k > 0, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<long>")),
        F.struct(first.alias("term"), first.alias("total")),
        add,
        lambda x: F.exp(x["total"]),
    )
    return F.when(k >= n * F.lit(share), F.lit(1.0)).otherwise(total)


def certified_cutoffs(
    labelled: DataFrame,
    good: str = "good",
    stratum: str = "stratum",
    risk: float = RISK,
    doubt: float = DOUBT,
) -> DataFrame:
    """(stratum, rule, cutoff): the cutoff of each rule that has a certified one.

    ``labelled`` has the counts of documents that pass the base rules, whether each is
    ``good``, and its ``stratum``. It is read once, into numbers of documents by the first
    step that rejects them: some ten rows per stratum and rule, whatever the input.
    """

    def place(rule: str) -> Column:
        passed = F.filter(F.lit(list(RULES[rule][3])), lambda cutoff: ~over(rule, cutoff))
        return F.struct(F.lit(rule).alias("rule"), F.size(passed).alias("first"))

    placed = labelled.select(
        F.col(good).alias("good"),
        F.col(stratum).alias("stratum"),
        F.explode(F.array(*map(place, RULES))).alias("p"),
    )
    counts = placed.groupBy("stratum", "p.rule", "p.first").agg(
        F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad")
    )
    known = written(
        counts.groupBy("stratum", "rule")
        .agg(F.sum("good").alias("n"), F.collect_list(F.struct("first", "good", "bad")).alias("firsts"))
        .where("n > 0"),
        "quality-sums",
    )
    tests = known.count()
    ladders = F.create_map(
        *[F.lit(x) for rule in RULES for x in (rule, list(RULES[rule][3]))]
    )

    def up_to(name: str) -> Column:
        """Documents rejected by step ``step`` or one before it."""
        return F.aggregate(
            F.filter("firsts", lambda x: x["first"] <= F.col("step")),
            F.lit(0).cast("long"),
            lambda so_far, x: so_far + x[name],
        )

    stepped = known.select("*", F.posexplode(ladders[F.col("rule")]).alias("step", "cutoff"))
    tail = binomial_tail(up_to("good"), F.col("n"), risk / len(RULES))
    # the tail grows along a ladder, so a step passes only if all before it do
    best = F.max(F.struct(up_to("bad").alias("bad"), -F.col("step"), "cutoff"))
    return (
        stepped.where(tail <= doubt / max(tests, 1))
        .groupBy("stratum", "rule")
        .agg(best.alias("best"))
        .select("stratum", "rule", F.col("best.cutoff").alias("cutoff"))
    )


def with_verdicts(
    counted: DataFrame,
    labels: DataFrame,
    strata: str = "lang",
    id_col: str = "doc_id",
    label: str = "quality",
    risk: float = RISK,
    doubt: float = DOUBT,
) -> DataFrame:
    """Every row of ``counted``, from :func:`with_counts`, with ``kept``.

    ``labels`` has an id and 1 for a good document or 0 for a bad one; other values and
    nulls are no labels, and an id with several labels counts as bad if one of them says so.
    Good documents that fail the base rules test no cutoff, as they are lost anyway. A null
    stratum is a stratum of its own. Rows of equal id share their label and each count. If
    there is no label, or no row, no rule has a cutoff.

    The rows are written once, as the counts are dear; drop what is not needed before. A
    column named like the result is replaced.
    """
    rows = written(counted, "quality-rows")
    stratum, good = fresh(rows, "stratum", "good")
    named = F.coalesce(F.concat(F.lit("="), F.col(strata).cast("string")), F.lit(""))
    rows = rows.withColumn(stratum, named)
    told = (
        labels.where(F.col(label).isin(0, 1) & F.col(id_col).isNotNull())
        .groupBy(F.col(id_col).alias(id_col))
        .agg((F.min(label) == 1).alias(good))
    )
    labelled = join_hot(
        rows.where(~F.col("base_failed")).select(id_col, stratum, *COUNTS), told, id_col
    )
    found = certified_cutoffs(labelled, good, stratum, risk, doubt)
    by_rule = written(
        found.groupBy("stratum").agg(
            *[F.max(F.when(F.col("rule") == rule, F.col("cutoff"))).alias(rule) for rule in RULES]
        ),
        "quality-cutoffs",
    )
    names = fresh(rows, *[f"most_{rule}" for rule in RULES])
    cutoffs = by_rule.select(
        F.col("stratum").alias(stratum), *[F.col(r).alias(n) for r, n in zip(RULES, names)]
    )
    judged = rows.join(cutoffs, stratum, "left")
    rejected = F.col("base_failed")
    for rule, name in zip(RULES, names):
        rejected = rejected | F.coalesce(over(rule, F.col(name)), F.lit(False))
    return put(judged, {"kept": ~rejected}).drop(stratum, *names)


def apply_quality_rules(
    docs: DataFrame, labels: DataFrame, text: str = "text", **options: str | float
) -> DataFrame:
    """Every row of ``docs`` with its counts, ``base_failed`` and ``kept``.

    See :func:`with_counts` and :func:`with_verdicts` for odd rows and ``options``.
    """
    return with_verdicts(with_counts(docs, text), labels, **options)
