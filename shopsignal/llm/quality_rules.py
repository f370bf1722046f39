"""Quality rules: a threshold table compiled into one Spark projection.

Every figure is a built-in expression over the text, so the whole operator is
one scan with projections: no shuffle, no Python, no state.

Defined cases: a null or empty text has no words, all counts 0, and fails the
base rule (fewer than ten words).  Repeated rows are judged alike, each on its
own.  Columns other than the text are never read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WHITE_SPACE, fresh_name, split_words, text_or_empty, window_hashes

WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
SYMBOLS = "#*$%&|<>"

# Frequent function words of the four languages of the corpus.
STOP_WORDS = (
    "the of and to in a is that for on with as are be this it at from or was "
    "der die das und ist von zu den mit auf für ein eine im dem nicht als es "
    "le la les de des et un une est en que du dans pour qui "
    "el los las y del se por con no lo para"
).split()


@dataclass(frozen=True)
class Rule:
    """``low <= ratio <= high`` (None: no bound), judged once the text has at least ``min_words`` words."""

    name: str
    low: float | None
    high: float | None
    min_words: int = MIN_WORDS


# The table: figures are defined in ``ratios``.
RULES = (
    Rule("mean_word_chars", 2.5, 14.0),
    Rule("symbol_ratio", None, 0.05),
    Rule("exclamation_ratio", None, 0.3),
    Rule("wordless_token_ratio", None, 0.3),
    Rule("upper_ratio", None, 0.5, 20),
    Rule("stop_word_ratio", 0.02, None, 50),
    Rule("dup_line_ratio", None, 0.5),
    Rule("ellipsis_line_ratio", None, 0.5),
    Rule("bullet_line_ratio", None, 0.9),
)

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _has_word(line: Column) -> Column:
    return F.btrim(line, F.lit(WHITE_SPACE)) != ""


def _removed_chars(text: Column, pattern: str) -> Column:
    """Characters of ``text`` that match ``pattern`` (a class with +)."""
    return F.char_length(text) - F.char_length(F.regexp_replace(text, pattern, ""))


def _token(body: str) -> str:
    """A pattern for whole words that look like ``body``."""
    return rf"(?<![^ \t-\r]){body}(?![^ \t-\r])"


def ratios(n_words: Column, word_chars: Column, n_symbols: Column, n_dup_lines: Column, n_lines: Column,
           text: Column) -> dict[str, Column]:
    """The figures the table bounds, by rule name."""
    words, chars, lines = (F.greatest(c, F.lit(1)) for c in (n_words, word_chars, n_lines))
    stop = "|".join(STOP_WORDS)
    return {
        "mean_word_chars": word_chars / words,
        "symbol_ratio": n_symbols / chars,
        "exclamation_ratio": F.regexp_count(text, F.lit("!!")) / words,
        "wordless_token_ratio": F.regexp_count(text, F.lit(_token(r"[^\p{L}\p{N} \t-\r]+"))) / words,
        "upper_ratio": _removed_chars(text, r"\p{Lu}+") / chars,
        "stop_word_ratio": F.regexp_count(text, F.lit(_token(rf"(?i:{stop})[.,;:!?]?"))) / words,
        "dup_line_ratio": n_dup_lines / lines,
        "ellipsis_line_ratio": F.regexp_count(text, F.lit(r"(?:\.\.\.|…)[ \t\x0b-\r]*(?:\n|$)")) / lines,
        "bullet_line_ratio": F.regexp_count(text, F.lit(r"(?:^|\n)[ \t\x0b-\r]*[-•‣●*][ \t]")) / lines,
    }


def compile_rules(n_words: Column, figures: dict[str, Column], rules: tuple[Rule, ...] = RULES) -> Column:
    """The table as one boolean expression: true if a text breaks none of the rules.

    Only bounds that are there are compared, since a filter writes a figure out once for each comparison.
    """
    verdict = F.lit(True)
    for rule in rules:
        figure = figures[rule.name]
        low = F.lit(True) if rule.low is None else figure >= rule.low
        high = F.lit(True) if rule.high is None else figure <= rule.high
        verdict = verdict & ((n_words < rule.min_words) | (low & high))
    return verdict


def with_rules(df: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``df`` plus the counts, ``base_failed``, ``kept`` (a column of ``df`` with such a name is replaced)."""
    names = {n: fresh_name(df, f"__qr_{n}") for n in ("text", "words", "hashes", "lines", "windows", "sorted", "place", *COUNTS)}
    c = {n: F.col(f"`{v}`") for n, v in names.items()}
    out = df.withColumn(names["text"], text_or_empty(F.col(f"`{text}`")))
    out = out.withColumns({
        names["words"]: split_words(c["text"]),
        names["lines"]: F.filter(F.split(c["text"], "\n"), _has_word),
    })
    out = out.withColumns({
        names["hashes"]: F.transform(c["words"], lambda w: F.xxhash64(w)),
        names["n_words"]: F.size(c["words"]).cast("long"),
        names["word_chars"]: F.char_length(F.array_join(c["words"], "")).cast("long"),
        names["n_symbols"]: (F.char_length(c["text"]) - F.char_length(F.translate(c["text"], SYMBOLS, ""))).cast("long"),
        names["n_dup_lines"]: (F.size(c["lines"]) - F.size(F.array_distinct(c["lines"]))).cast("long"),
    })
    out = out.withColumn(names["windows"], window_hashes(c["hashes"], WINDOW))
    # Only a text with a repeated window pays for the sort that finds where the repeats are.
    out = out.withColumn(
        names["sorted"],
        F.when(
            F.size(F.array_distinct(c["windows"])) < F.size(c["windows"]),
            F.sort_array(F.transform(c["windows"], lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ),
    )
    in_a_run = F.filter(
        c["sorted"],
        lambda x, k: (x.h == F.get(c["sorted"], k - 1).h).eqNullSafe(F.lit(True))
        | (x.h == F.get(c["sorted"], k + 1).h).eqNullSafe(F.lit(True)),
    )
    covered = F.aggregate(
        F.sort_array(F.transform(in_a_run, lambda x: x.i)),
        F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n")),
        lambda s, p: F.struct(p.alias("last"), (s.n + F.least(F.lit(WINDOW), p - s.last)).alias("n")),
        lambda s: s.n,
    )
    # A filter on the verdict would be pushed through all projections, with each figure written out again wherever
    # it is used.  It stops at this one, because the verdict also asks for a row number (which is always there).
    out = out.withColumns({
        names["n_repeat_words"]: F.when(c["sorted"].isNull(), F.lit(0)).otherwise(covered).cast("long"),
        names["place"]: F.monotonically_increasing_id(),
    })
    failed = (c["n_words"] < MIN_WORDS) | (100 * c["n_repeat_words"] > MAX_REPEAT_PERCENT * c["n_words"])
    figures = ratios(c["n_words"], c["word_chars"], c["n_symbols"], c["n_dup_lines"], F.size(c["lines"]), c["text"])
    results = {n: c[n] for n in COUNTS} | {"base_failed": failed, "kept": (c["place"] >= 0) & ~failed & compile_rules(c["n_words"], figures, rules)}
    kept = [F.col(f"`{x}`") for x in df.columns if x.lower() not in results]
    return out.select(*kept, *[v.alias(n) for n, v in results.items()])


def keep_good(df: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of ``df`` whose text passes, with exactly the columns of ``df``."""
    # The row goes along as one value, so columns called like a figure survive.
    row = fresh_name(df, "__qr_row")
    flagged = with_rules(
        df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(row), F.col(f"`{text}`").alias("text")), "text", rules)
    return flagged.filter("kept").select(*[F.col(row).getField(c).alias(c) for c in df.columns])


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return with_rules(docs).drop("text")


ORACLE = rf"""
with d as (
  select row_number() over () rid, doc_id, coalesce(text, '') t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) l
  from documents),
p as (
  select rid, unnest(range(1, len(w) - {WINDOW - 2})) p, w from d where len(w) >= {WINDOW}),
g as (select rid, p, array_to_string(w[p:p + {WINDOW - 1}], ' ') g from p),
r as (select rid, p from (select rid, p, count(*) over (partition by rid, g) n from g) where n > 1),
cov as (select rid, count(distinct q) n from (select rid, unnest(range(p, p + {WINDOW})) q from r) group by rid),
f as (
  select d.doc_id, d.t, len(w) n_words, length(array_to_string(w, '')) word_chars,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) n_symbols,
         len(l) - len(list_distinct(l)) n_dup_lines, coalesce(cov.n, 0) n_repeat_words,
         greatest(len(w), 1) nw, greatest(length(array_to_string(w, '')), 1) nc, greatest(len(l), 1) nl,
         len(list_filter(w, lambda x: regexp_full_match(x, '(?i:{"|".join(STOP_WORDS)})[.,;:!?]?'))) stops,
         len(list_filter(w, lambda x: regexp_full_match(x, '[^\pL\pN]+'))) wordless,
         (length(t) - length(replace(t, '!!', ''))) / 2 excl,
         length(t) - length(regexp_replace(t, '\p{{Lu}}', '', 'g')) uppers,
         len(regexp_extract_all(t, '(?:\.\.\.|…)[ \t\x0b-\r]*(?:\n|$)')) ell,
         len(regexp_extract_all(t, '(?:^|\n)[ \t\x0b-\r]*[-•‣●*][ \t]')) bul
  from d left join cov using (rid)),
b as (select *, n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words base_failed from f)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words::bigint n_repeat_words, base_failed,
       not base_failed and word_chars / nw between 2.5 and 14.0 and n_symbols / nc <= 0.05 and excl / nw <= 0.3
       and wordless / nw <= 0.3 and (n_words < 20 or uppers / nc <= 0.5)
       and (n_words < 50 or stops / nw between 0.02 and 1.0) and n_dup_lines / nl <= 0.5 and ell / nl <= 0.5 and bul / nl <= 0.9 kept
from b
"""
