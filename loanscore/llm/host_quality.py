"""Quality rules with host-level verdicts, in DataFrame functions only.

Each document gets its rule counts from its whole text and fails when it is
too short or repeats itself. Failures are then aggregated by host; the host's
failure rate is shrunk towards an empirical beta prior (moments of the hosts'
rates), so that a host with few documents is judged mostly by the corpus and
a host with many by itself. Documents of a host whose shrunk rate passes the
threshold go too.

The counts come from arrays inside one row. Five-word windows are compared by
64-bit hashes; a document without a repeated hash (the common case) is done
after one hash-set pass, the others sort their hashes once.

Defined results: a null text has no words (and fails); null hosts are one
host; repeated rows count as often as they stand; an empty table gives an
empty result. With one host, or hosts of one rate, the prior is taken to be
that rate exactly. Other columns pass through and give way to results of
their name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanscore.llm.common import Written, packed, text_of, with_results

WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
MAX_HOST_RATE = 0.5

# White space between words, and the symbols that are counted.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]"
NOT_SYMBOL = r"[^#*$%&|<>]+"

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _window_hash(words: Column, word: Column, i: Column) -> Column:
    return F.xxhash64(word, *[F.get(words, i + F.lit(k)) for k in range(1, WINDOW)])


def with_counts(rows: DataFrame, text: str) -> DataFrame:
    """Adds ``COUNTS`` of the column ``text`` and drops the text and all intermediate arrays."""
    kept = [c for c in rows.columns if c != text]
    split = rows.select(
        *kept,
        F.filter(F.split(text, SPACE), lambda w: w != "").alias("words"),
        F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD)).alias("lines"),
        F.char_length(F.regexp_replace(text, NOT_SYMBOL, "")).cast("long").alias("n_symbols"),
    )
    hashed = split.select(
        *kept,
        "n_symbols",
        F.size("words").cast("long").alias("n_words"),
        F.char_length(F.array_join("words", "")).cast("long").alias("word_chars"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.slice(
            F.transform("words", lambda w, i: _window_hash(F.col("words"), w, i)),
            F.lit(1),
            F.greatest(F.size("words") - F.lit(WINDOW - 1), F.lit(0)),
        ).alias("windows"),
    )
    counted = [*kept, "n_symbols", "n_words", "word_chars", "n_dup_lines"]
    placed = hashed.select(
        *counted,
        F.when(
            F.size(F.array_distinct("windows")) < F.size("windows"),
            F.array_sort(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ).alias("sorted"),
    )

    def twice(x: Column, i: Column) -> Column:
        near = [F.get("sorted", i + F.lit(step))["h"] for step in (-1, 1)]
        return F.when((x["h"] == near[0]) | (x["h"] == near[1]), x["i"])

    starts = placed.select(
        *counted,
        F.array_sort(F.filter(F.transform("sorted", twice), lambda p: p.isNotNull())).alias("starts"),
    )
    covered = F.aggregate(
        F.transform("starts", lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get("starts", i + F.lit(1)) - p, F.lit(WINDOW)))),
        F.lit(0).cast("long"),
        lambda total, n: total + n,
    )
    return starts.select(*counted, F.coalesce(covered, F.lit(0)).alias("n_repeat_words"))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)


def host_rates(hosts: DataFrame) -> DataFrame:
    """(host, n, failed) with ``rate``: the failure rate shrunk towards the hosts' beta prior."""
    moments = hosts.select((F.col("failed") / F.col("n")).alias("r")).agg(F.avg("r").alias("m"), F.var_pop("r").alias("v"))
    mean = moments.select("m").scalar()
    # alpha + beta of the beta distribution with these moments; null: no spread, the prior is the mean.
    strength = moments.select(F.when((F.col("v") > 0) & (F.col("v") < F.col("m") * (1 - F.col("m"))), F.col("m") * (1 - F.col("m")) / F.col("v") - 1)).scalar()
    prior = hosts.select("host", "n", "failed", mean.alias("m"), strength.alias("s"))
    shrunk = (F.col("failed") + F.col("m") * F.col("s")) / (F.col("n") + F.col("s"))
    return prior.select("host", "n", "failed", F.coalesce(shrunk, "m").alias("rate"))


def judge_documents(
    docs: DataFrame,
    text: str = "text",
    host: str = "source",
    max_host_rate: float = MAX_HOST_RATE,
    carry: list[str] | None = None,
) -> DataFrame:
    """Every row of ``docs`` (its columns, or those in ``carry``) with ``COUNTS``, base_failed, host_rate and kept."""
    carried = docs if carry is None else docs.select(*carry)
    rows = docs.select(packed(carried).alias("row"), F.col(host).alias("host"), text_of(text).alias("text"))
    scored = Written(with_counts(rows, "text").withColumn("base_failed", base_failed()), "quality")
    hosts = Written(
        scored.df.groupBy("host").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("base_failed").cast("long")).alias("failed")),
        "hosts",
    )
    rates = host_rates(hosts.df).select(F.col("host").alias("rated"), "rate")
    judged = scored.df.join(rates, F.col("host").eqNullSafe(F.col("rated")), "left")
    results = {name: F.col(name) for name in (*COUNTS, "base_failed")}
    results |= {"host_rate": F.col("rate"), "kept": ~F.col("base_failed") & (F.col("rate") <= max_host_rate)}
    return with_results(judged, "row", results)
