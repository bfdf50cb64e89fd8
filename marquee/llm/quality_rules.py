"""Quality rules with adaptive thresholds (DataFrame functions only).

Every text gives integer measures (symbols, repeated words and repeated lines
per mille, mean word length in thousandths).  Instead of fixed cutoffs each
(lang, source) group gets fences from a mergeable quantile sketch of its own
documents: a histogram whose buckets keep a value's leading ``BITS`` bits, so a
quantile is off by at most 1/128 and two sketches merge by adding counts.
Merging a language's sources gives the language's sketch, merging those the
corpus's.  A group's quantile is the mean of its own, its language's and the
corpus's, weighted by its documents and ``PRIOR`` for each of the other two: a
small group leans on them, a large one stands alone.

Rates (mostly zero in clean text) have an upper fence: the ``HIGH`` quantile q
plus ``REACH`` times its distance from the median, or plus the measure's
allowance if that is more.  Junk moves it only where more than 15% of the group
is junk; a source made of such texts (code, say) gets a fence beyond them.  Word
length has fences on both sides, ``REACH`` times the distance from the median
to the quartile beyond that quartile.  Only documents that pass the base rules
feed the sketches.  The fences join back on (lang, source).

The base rules are the contract's: fewer than 50 words, or over half of the
words in repeated three-word windows.

Defined cases: null and empty texts have no words and fail the base rules; null
lang or source form groups of their own; repeated rows count each; an empty
table gives no rows; very long texts are measured whole, in memory proportional
to the text; input columns named like an added one are replaced by it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marquee.llm import common

MIN_WORDS = 50
REPEAT_PERCENT = 50
PRIOR = 100                             # documents that the language's and the corpus's quantile count as, each
REACH = 8
BITS = 8                                # of a value, that its sketch bucket keeps
LOW, MIDDLE, UPPER, HIGH = 25, 50, 75, 85
QUANTILES = (LOW, MIDDLE, UPPER, HIGH)
BROADCAST_GROUPS = 100_000              # (lang, source) groups, about 10 MB of fences
SYMBOLS = "#*$%&|<>"
#: measure -> how far above the HIGH quantile a text may be in any case; None: fences by quartiles
MEASURES = {"symbol_rate": 100, "repeat_rate": 300, "dup_line_rate": 350, "word_length": None}
LEAST_SPREAD = 32                       # of word length: a sketch bucket at usual lengths
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
ADDED = [*BASE, "base_failed", "kept", *MEASURES]


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def repeat_words(words: Column) -> Column:
    """Words covered by three-word windows that occur at least twice.

    Window hashes are sorted with their position in the low bits, so equal
    windows are neighbours; full hashes are compared before a window counts.
    """
    def covered(hashes: Column) -> Column:
        bits = F.length(F.bin(F.size(hashes).cast("long")))
        return let(bits, lambda k: let(
            F.sort_array(F.transform(hashes, lambda h, i: F.call_function(
                "shiftleft", F.call_function("shiftright", h, k), k).bitwiseOR(i.cast("long")))),
            lambda s: let(
                F.transform(s, lambda x: x.bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), k)
                                                      - F.lit(1)).cast("int")),
                lambda pos: widths(hashes, pos))))

    def widths(hashes: Column, pos: Column) -> Column:
        same = lambda i, p, d: F.coalesce(
            F.get(hashes, p) == F.get(hashes, F.get(pos, i + F.lit(d))), F.lit(False))
        found = F.sort_array(F.filter(pos, lambda p, i: same(i, p, -1) | same(i, p, 1)))
        start = F.struct(F.lit(-3).alias("prev"), F.lit(0).cast("long").alias("n"))
        return F.aggregate(
            found, start,
            lambda acc, p: F.struct(p.alias("prev"), (acc["n"] + F.least(F.lit(3), p - acc["prev"])).alias("n")),
            lambda acc: acc["n"])

    triples = F.arrays_zip(words, F.slice(words, F.lit(2), F.size(words)),
                           F.slice(words, F.lit(3), F.size(words)))
    hashes = F.transform(F.slice(triples, F.lit(1), F.size(words) - F.lit(2)), lambda t: F.xxhash64(t))
    out = let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long"))
              .otherwise(covered(h)))
    return F.when(F.size(words) < 4, F.lit(0).cast("long")).otherwise(out)


def measure(docs: DataFrame, carry: list[str]) -> DataFrame:
    """``carry`` columns with the base counts, the four measures and base_failed."""
    text = F.coalesce(F.col("text"), F.lit(""))
    words = F.filter(F.split(text, common.SPACE_CLASS + "+"), lambda w: w != F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.trim(x, F.lit(common.SPACE_CHARS)) != F.lit(""))
    per_word = let(words, lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"), repeat_words(w).alias("n_repeat_words")))
    per_line = let(lines, lambda x: F.struct(
        F.size(x).cast("long").alias("n_lines"),
        (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines")))
    kept = [F.col(f"`{c}`") for c in carry]
    df = docs.select(
        *kept,
        per_word.alias("_w"), per_line.alias("_l"),
        F.length(F.translate(text, common.SPACE_CHARS, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"))
    df = df.select(*kept, F.col("_w.n_words").alias("n_words"), "word_chars", "n_symbols",
                   F.col("_l.n_dup_lines").alias("n_dup_lines"),
                   F.col("_w.n_repeat_words").alias("n_repeat_words"), F.col("_l.n_lines").alias("_n_lines"))
    rate = lambda a, b: F.when(F.col(b) > 0, F.floor(
        F.lit(1000) * F.col(a) / F.col(b)).cast("long")).otherwise(F.lit(0).cast("long"))
    return df.select(
        "*",
        rate("n_symbols", "n_words").alias("symbol_rate"),
        rate("n_repeat_words", "n_words").alias("repeat_rate"),
        rate("n_dup_lines", "_n_lines").alias("dup_line_rate"),
        rate("word_chars", "n_words").alias("word_length"),
        ((F.col("n_words") < MIN_WORDS) | (F.lit(100) * F.col("n_repeat_words")
                                           > F.lit(REPEAT_PERCENT) * F.col("n_words"))).alias("base_failed"),
    ).drop("_n_lines")


def bucket(v: Column) -> Column:
    """Lower end of the sketch bucket of ``v`` >= 0: its leading bits."""
    e = F.greatest(F.length(F.bin(v)) - F.lit(BITS), F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", v, e), e)


def sketches(measured: DataFrame) -> DataFrame:
    """(_lang, _source, measure, bucket, n): one sketch per group and measure."""
    entries = F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), bucket(F.col(m)).alias("bucket"))
                                  for m in MEASURES]))
    return (measured.filter(~F.col("base_failed"))
            .select("_lang", "_source", entries.alias("_e"))
            .groupBy("_lang", "_source", F.col("_e.measure").alias("measure"),
                     F.col("_e.bucket").alias("bucket"))
            .agg(F.count(F.lit(1)).alias("n")))


def quantiles(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """docs and the quantiles (q25, ...) of the sketches merged to ``keys``.

    The window runs over a sketch's buckets, whose number is bounded by the
    width of a long, not over documents.
    """
    merged = sketch.groupBy(*keys, "measure", "bucket").agg(F.sum("n").alias("n"))
    w = Window.partitionBy(*keys, "measure")
    run = w.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = merged.withColumn("_cum", F.sum("n").over(run)).withColumn("_docs", F.sum("n").over(w))
    q = lambda k: F.min(F.when(F.col("_cum") * F.lit(100) >= F.col("_docs") * F.lit(k), F.col("bucket")))
    return (ranked.groupBy(*keys, "measure")
            .agg(F.first("_docs").alias("docs"), *[q(k).alias(f"q{k}") for k in QUANTILES]))


def fences(sketch: DataFrame) -> DataFrame:
    """(_lang, _source, low and high of each measure): the fences of every group."""
    leaf, lang, whole = (quantiles(sketch, k) for k in (["_lang", "_source"], ["_lang"], []))
    wide = lang.select("_lang", "measure", *[F.col(f"q{k}").alias(f"l{k}") for k in QUANTILES])
    all_ = whole.select("measure", *[F.col(f"q{k}").alias(f"a{k}") for k in QUANTILES])
    # one row per measure, one per measure and language
    j = leaf.join(wide, ["_lang", "measure"]).join(F.broadcast(all_), "measure")

    def pooled(k: int) -> Column:
        total = F.col("docs") * F.col(f"q{k}") + F.lit(PRIOR) * (F.col(f"l{k}") + F.col(f"a{k}"))
        return F.floor(total / (F.col("docs") + F.lit(2 * PRIOR))).cast("long")

    allowance = F.element_at(F.create_map(*[F.lit(x) for m, a in MEASURES.items() for x in (m, a or 0)]), F.col("measure"))
    quartiles = F.col("measure") == "word_length"
    j = j.select("_lang", "_source", "measure", allowance.alias("_allowance"), quartiles.alias("_both"),
                 *[pooled(k).alias(f"_p{k}") for k in QUANTILES])
    high, upper, low, mid = (F.col(f"_p{k}") for k in (HIGH, UPPER, LOW, MIDDLE))
    j = j.select("_lang", "_source", "measure",
                 F.when(F.col("_both"), upper + F.lit(REACH) * F.greatest(upper - mid, F.lit(LEAST_SPREAD)))
                 .otherwise(high + F.greatest(F.lit(REACH) * (high - mid), F.col("_allowance"))).alias("high"),
                 F.when(F.col("_both"), low - F.lit(REACH) * F.greatest(mid - low, F.lit(LEAST_SPREAD)))
                 .otherwise(F.lit(0)).cast("long").alias("low"))
    return j.groupBy("_lang", "_source").agg(
        *[F.max(F.when(F.col("measure") == m, F.col(end))).alias(f"_{end}_{m}")
          for m in MEASURES for end in ("low", "high")])


def judge(docs: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """``carry`` columns plus the base counts, base_failed, kept and the measures."""
    docs = common.drop_clashes(docs, ADDED)
    carry = [c for c in (carry or docs.columns) if c in docs.columns]
    keyed = docs.withColumns({"_lang": common.key_text(F.col("lang")),
                              "_source": common.key_text(F.col("source"))})
    measured = measure(keyed, [*carry, "_lang", "_source"])
    if "text" not in carry:            # else the texts are measured twice rather than stored once more
        measured = common.materialize(measured, "quality-measures")
    limits = fences(common.materialize(sketches(measured), "quality-sketches"))
    # one row of seven numbers per group: a group may hold a third of the documents, so they don't move
    limits = common.broadcast_if_small(common.materialize(limits, "quality-fences"), BROADCAST_GROUPS)
    inside = F.lit(True)
    for m in MEASURES:
        inside = inside & F.col(m).between(F.col(f"_low_{m}"), F.col(f"_high_{m}"))
    judged = measured.join(limits, ["_lang", "_source"], "left")
    return judged.select(*[F.col(f"`{c}`") for c in carry], *BASE, "base_failed",
                         F.coalesce(~F.col("base_failed") & inside, F.lit(False)).alias("kept"), *MEASURES)


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(common.table(spark, sf_dir, "documents"), carry=["doc_id"])


def _sql() -> str:
    measures = " union all ".join(
        f"select lang, source, '{m}' measure, {m} v from m where not base_failed" for m in MEASURES)
    allowance = "case measure " + " ".join(f"when '{m}' then {a or 0}" for m, a in MEASURES.items()) + " end"

    def level(keys: str) -> str:
        cols, by = (f"{keys}, ", f"{keys}, ") if keys else ("", "")
        q = ", ".join(f"min(case when cum * 100 >= docs * {k} then b end) q{k}" for k in QUANTILES)
        return f"""
  select {cols}measure, any_value(docs) docs, {q}
  from (select *, sum(n) over (partition by {by}measure order by b) cum,
               sum(n) over (partition by {by}measure) docs
        from (select {cols}measure, b, sum(n) n from sk group by {cols}measure, b))
  group by {cols}measure"""

    pooled = ", ".join(f"((lf.docs * lf.q{k} + {PRIOR} * (la.q{k} + al.q{k})) // (lf.docs + {2 * PRIOR}))::bigint p{k}"
                       for k in QUANTILES)
    checks = [f"{m} between (select low from f where f.lang = m.lang and f.source = m.source and measure = '{m}') "
              f"and (select high from f where f.lang = m.lang and f.source = m.source and measure = '{m}')"
              for m in MEASURES]
    return rf"""
with t as (
  select doc_id, coalesce('s' || lang, 'n') lang, coalesce('s' || source, 'n') source, coalesce(text, '') text
  from documents),
p as (
  select *, row_number() over () rid, regexp_extract_all(text, '[^\x20\x09-\x0D]+') w,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) ln from t),
g as (
  select rid, i, count(*) over (partition by rid, a, b, c) n
  from (select rid, unnest(range(1, len(w) - 1)) i, w[i] a, w[i + 1] b, w[i + 2] c from p where len(w) >= 4)),
r as (
  select rid, sum(least(3, i - prev)) n
  from (select rid, i, coalesce(lag(i) over (partition by rid order by i), i - 3) prev from g where n > 1)
  group by rid),
b as (
  select doc_id, lang, source, cast(len(w) as bigint) n_words,
         cast(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) as bigint) word_chars,
         cast(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) as bigint) n_symbols,
         cast(len(ln) - len(list_distinct(ln)) as bigint) n_dup_lines,
         cast(coalesce(r.n, 0) as bigint) n_repeat_words, len(ln) n_lines
  from p left join r using (rid)),
m as (
  select *, cast(case when n_words > 0 then (1000 * n_symbols) // n_words else 0 end as bigint) symbol_rate,
         cast(case when n_words > 0 then (1000 * n_repeat_words) // n_words else 0 end as bigint) repeat_rate,
         cast(case when n_lines > 0 then (1000 * n_dup_lines) // n_lines else 0 end as bigint) dup_line_rate,
         cast(case when n_words > 0 then (1000 * word_chars) // n_words else 0 end as bigint) word_length,
         n_words < {MIN_WORDS} or 100 * n_repeat_words > {REPEAT_PERCENT} * n_words base_failed
  from b),
sk as (
  select lang, source, measure, b, count(*) n
  from (select *, (v >> e) << e b
        from (select *, greatest(length(bin(v)) - {BITS}, 0)::bigint e from ({measures})))
  group by lang, source, measure, b),
lf as ({level("lang, source")}),
la as ({level("lang")}),
al as ({level("")}),
pk as (
  select lf.lang, lf.source, measure, {pooled}, {allowance} allowance
  from lf join la using (lang, measure) join al using (measure)),
f as (
  select lang, source, measure,
         case when measure = 'word_length' then p{UPPER} + {REACH} * greatest(p{UPPER} - p{MIDDLE}, {LEAST_SPREAD})
              else p{HIGH} + greatest({REACH} * (p{HIGH} - p{MIDDLE}), allowance) end high,
         case when measure = 'word_length' then p{LOW} - {REACH} * greatest(p{MIDDLE} - p{LOW}, {LEAST_SPREAD})
              else 0 end low
  from pk)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       coalesce(not base_failed and {' and '.join(checks)}, false) kept,
       symbol_rate, repeat_rate, dup_line_rate, word_length
from m
"""


QUALITY_SQL = _sql()
