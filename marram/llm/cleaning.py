"""Quality rules, line first: judge each line, drop the failing ones, reject what loses too much text."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marram.llm.tokens import GAP_CHARS

# Characters counted as symbols.
SYMBOLS = "#*$%&|<>"

# Characters that separate menu entries when they stand alone.
SEPARATORS = ("|", ">", "»", "·", "•")

# Phrases that mark a line as boilerplate, lower case.
BOILERPLATE = (
    "all rights reserved", "copyright", "javascript", "licensed under", "lorem ipsum", "privacy policy", "terms of use",
)
# A line made of these words alone is navigation.
MENU = (
    "about", "account", "back", "blog", "contact", "faq", "help", "home", "login", "logout", "menu", "more",
    "next", "news", "previous", "register", "search", "share", "sitemap",
)


_PARTS = (_TEXT, _LOWER, _SYMBOLS, _SEPARATED, _PHRASED, _SPLIT, _WORDS, _LINES, _REPEATS, _WITH_WORD, _KEPT_LINES, _CHARS,
          _LOST) = tuple(f"_line_quality_{n}" for n in (
              "text", "lower", "symbols", "separated", "phrased", "split", "words", "lines", "repeats", "with_word",
              "kept_lines", "chars", "lost"))


@dataclass(frozen=True)
class LineRules:
    """The thresholds of the rules; all apply to single lines, `max_lost_percent` to the document.

    * punctuation: more than `marks_per_10_words` marks (`!` and symbols) per ten words, or at least
      `min_unpunctuated` words without a single `.`, `,`, `!`, `?`, `;` or `:`.
    * navigation: separators (`|`, `>`, `»`, `·`, `•` standing alone) make up more than
      `separator_percent` of the words, or every word is a menu word.
    * boilerplate: the lower-cased line holds one of the phrases.
    """

    marks_per_10_words: int = 5
    min_unpunctuated: int = 80
    separator_percent: int = 20
    max_lost_percent: int = 50
    min_words: int = 50
    max_repeat_percent: int = 50
    phrases: tuple[str, ...] = BOILERPLATE
    menu: tuple[str, ...] = MENU


def _ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _occurrences(text: Column, chars: str) -> Column:
    """How many of these one-byte characters the text holds. Searching for one at a time is several times faster
    than `translate`, which walks a map per character."""
    total = F.lit(0)
    for c in chars:
        total = total + F.octet_length(text) - F.octet_length(F.replace(text, F.lit(c), F.lit("")))
    return total


def _single_gaps(text: Column) -> Column:
    """Every gap character becomes a space: splitting by one character needs no regular expression."""
    return reduce(lambda t, c: F.replace(t, F.lit(c), F.lit(" ")), GAP_CHARS.replace(" ", ""), text)


def _holds_any(text: Column, parts: tuple[str, ...] | str) -> Column:
    return reduce(lambda a, b: a | b, (F.contains(text, F.lit(p)) for p in parts))


def line_fails(line: Column, words: Column, rules: LineRules, marked: Column, separated: Column,
               phrased: Column) -> Column:
    """Name of the first rule a line breaks, null if none. A line without a word breaks none.

    The last three say whether the whole document holds any mark, separator or phrase at all: most do not,
    and their lines skip the searches.
    """
    n = F.size(words)
    marks = F.when(marked, _occurrences(line, "!" + SYMBOLS)).otherwise(0)
    alone = F.when(separated, F.size(F.filter(words, lambda w: w.isin(*SEPARATORS)))).otherwise(0)
    menu = rf"^[\x20\x09-\x0D]*(?:(?:{'|'.join(rules.menu)})[\x20\x09-\x0D]*(?:$|[\x20\x09-\x0D]))+$"
    return (
        F.when(n == 0, F.lit(None).cast("string"))
        .when((marks * 10 > n * rules.marks_per_10_words)
              | ((n >= rules.min_unpunctuated) & ~F.rlike(line, F.lit("[.,!?;:]"))), "punctuation")
        .when((alone * 100 > n * rules.separator_percent) | F.rlike(line, F.lit("(?i)" + menu)), "navigation")
        .when(phrased & _holds_any(_ascii_lower(line), rules.phrases), "boilerplate")
    )


def _named(value: Column, use: Callable[[Column], Column]) -> Column:
    """Compute a value once and use it in many places: as the only element of an array that `use` maps over.

    A column used in one place within a lambda would be inlined there and computed for every element.
    """
    return F.element_at(F.transform(F.array(value), use), 1)


def _repeat_words(words: Column) -> Column:
    """Words inside three-word windows that occur twice or more in the row's word list.

    Everything happens within the row, in n log n time. Hashes find the few places where a window may
    repeat; those windows are then compared as text, so a hash collision changes nothing.
    """
    n_windows = F.size(words) - 2

    def hashes(w: Column) -> Column:
        return F.slice(F.transform(w, lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2))), 1, n_windows)

    def neighbours(ordered: Column) -> Column:
        """Places whose key equals that of the entry before or after."""
        equal = F.filter(ordered, lambda s, k: (s["x"] == F.get(ordered, k - 1)["x"])
                         | (s["x"] == F.get(ordered, k + 1)["x"]))
        return F.sort_array(F.transform(equal, lambda s: s["i"]))

    def candidates(h: Column) -> Column:
        none = F.array().cast("array<int>")
        ordered = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), none).otherwise(_named(ordered, neighbours))

    def places(found: Column) -> Column:
        windows = F.transform(found, lambda i: F.struct(
            F.concat_ws(" ", F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)).alias("x"), i.alias("i")))
        return _named(F.sort_array(windows), neighbours)

    def covered(found: Column) -> Column:
        return F.aggregate(
            F.transform(found, lambda p, k: F.least(F.lit(3), F.coalesce(F.get(found, k + 1) - p, F.lit(3)))),
            F.lit(0), lambda total, n: total + n)

    all_steps = _named(hashes(words), lambda h: _named(candidates(h), lambda c: _named(places(c), covered)))
    return F.when(n_windows < 2, F.lit(0)).otherwise(all_steps)


def with_line_verdicts(docs: DataFrame, rules: LineRules = LineRules(), text: str = "text") -> DataFrame:
    """Append `line_quality` to every row: base counts, the verdict and the cleaned text.

    Fields: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, n_failed_lines,
    lost_chars, cleaned. A null or empty text has no words: all counts are 0, it fails the base rule and
    `cleaned` is empty. Other columns, whatever their names, pass through; an existing column
    `line_quality` is replaced. Rows are judged alone, so ties and repeated rows get equal verdicts.
    """
    # Plain columns, not one struct: Catalyst would inline a struct's fields into every use.
    whole = docs.withColumn(_TEXT, F.coalesce(F.col(text), F.lit("")))
    split = whole.withColumn(_LOWER, F.lower(_TEXT)).withColumns({
        _SYMBOLS: _occurrences(F.col(_TEXT), SYMBOLS), _SEPARATED: _holds_any(F.col(_TEXT), SEPARATORS),
        _PHRASED: _holds_any(F.col(_LOWER), rules.phrases),
        _SPLIT: F.transform(F.split(_TEXT, "\n"), lambda line: F.struct(
            line.alias("line"), F.array_remove(F.split(_single_gaps(line), " "), "").alias("words")))})
    seen = F.struct(((F.col(_SYMBOLS) > 0) | F.contains(F.col(_TEXT), F.lit("!"))).alias("marked"),
                    F.col(_SEPARATED).alias("separated"), F.col(_PHRASED).alias("phrased"))
    parts = split.withColumns({
        _WORDS: F.flatten(F.transform(_SPLIT, lambda s: s["words"])),
        _LINES: _named(seen, lambda g: F.transform(_SPLIT, lambda s: F.struct(
            s["line"].alias("line"), F.size(s["words"]).alias("n"), F.length(F.array_join(s["words"], "")).alias("chars"),
            line_fails(s["line"], s["words"], rules, g["marked"], g["separated"], g["phrased"]).alias("why"))))})
    add = lambda total, s: total + s["chars"]
    counted = parts.withColumns({
        _REPEATS: _repeat_words(F.col(_WORDS)),
        _WITH_WORD: F.transform(F.filter(_LINES, lambda s: s["n"] > 0), lambda s: s["line"]),
        _KEPT_LINES: F.filter(F.col(_LINES), lambda s: s["why"].isNull()),
        _CHARS: F.aggregate(_LINES, F.lit(0), add),
        _LOST: F.aggregate(F.filter(_LINES, lambda s: s["why"].isNotNull()), F.lit(0), add)})
    n_words, n_repeats = F.size(_WORDS), F.col(_REPEATS)
    base = (n_words < rules.min_words) | (n_repeats * 100 > n_words * rules.max_repeat_percent)
    verdict = F.struct(
        n_words.cast("long").alias("n_words"), F.col(_CHARS).cast("long").alias("word_chars"),
        F.col(_SYMBOLS).cast("long").alias("n_symbols"),
        (F.size(_WITH_WORD) - F.size(F.array_distinct(_WITH_WORD))).cast("long").alias("n_dup_lines"),
        n_repeats.cast("long").alias("n_repeat_words"), base.alias("base_failed"),
        (~base & (F.col(_LOST) * 100 <= F.col(_CHARS) * rules.max_lost_percent)).alias("kept"),
        (F.size(_LINES) - F.size(_KEPT_LINES)).cast("long").alias("n_failed_lines"),
        F.col(_LOST).cast("long").alias("lost_chars"),
        F.array_join(F.transform(_KEPT_LINES, lambda s: s["line"]), "\n").alias("cleaned"))
    return counted.withColumn("line_quality", verdict).drop(*_PARTS)


def clean_documents(docs: DataFrame, rules: LineRules = LineRules()) -> DataFrame:
    """The documents that pass, under their own columns: failing lines are gone and `n_chars` is counted anew."""
    q = F.col("line_quality")
    fields = [q["cleaned"].alias("text")]
    if "n_chars" in docs.columns:
        fields.append(F.length(q["cleaned"]).cast(docs.schema["n_chars"].dataType).alias("n_chars"))
    # One entry for a document that passes, none otherwise. A filter on the verdict would be pushed below the
    # columns that it is made of, and Catalyst would then write out the whole rule set once per use.
    passed = F.when(q["kept"], F.array(F.struct(*fields))).otherwise(F.array())
    rest = [c for c in docs.columns if c not in ("text", "n_chars")]
    return with_line_verdicts(docs, rules).select(*rest, F.inline(passed)).select(*docs.columns)


def quality_report(docs: DataFrame, rules: LineRules = LineRules()) -> DataFrame:
    q = F.col("line_quality")
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
             "n_failed_lines", "lost_chars")
    return with_line_verdicts(docs, rules).select("doc_id", *(q[c].alias(c) for c in names))


def quality_sql(rules: LineRules = LineRules()) -> str:
    """The same report for DuckDB, from exploded lines and words."""
    phrases = " or ".join(f"contains(lower_line, '{p}')" for p in rules.phrases)
    menu = "|".join(rules.menu)
    gap, word = r"[\x20\x09-\x0D]", r"[^\x20\x09-\x0D]+"
    return rf"""
with d as (select row_number() over () as rid, doc_id, coalesce(text, '') as t from documents),
lines as (
    select rid, line, len(regexp_extract_all(line, '{word}')) as n,
           length(regexp_replace(line, '{gap}', '', 'g')) as chars,
           translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as lower_line
    from (select rid, unnest(string_split(t, chr(10))) as line from d)),
judged as (
    select *, n > 0 and (
        length(regexp_replace(line, '[^!#*$%&|<>]', '', 'g')) * 10 > n * {rules.marks_per_10_words}
        or (n >= {rules.min_unpunctuated} and not regexp_matches(line, '[.,!?;:]'))
        or len(list_filter(regexp_extract_all(line, '{word}'), lambda x: x in ('|', '>', '»', '·', '•'))) * 100
            > n * {rules.separator_percent}
        or regexp_matches(lower_line, '^{gap}*(?:(?:{menu}){gap}*(?:$|{gap}))+$')
        or {phrases}) as failed
    from lines),
per_line as (
    select rid, sum(chars) as word_chars, count(*) filter (failed) as n_failed_lines,
           coalesce(sum(chars) filter (failed), 0) as lost_chars,
           count(*) filter (n > 0) - count(distinct line) filter (n > 0) as n_dup_lines
    from judged group by rid),
words as (
    select rid, unnest(w) as w, generate_subscripts(w, 1) as i
    from (select rid, regexp_extract_all(t, '{word}') as w from d)),
windows as (
    select rid, i, w || ' ' || lead(w) over o || ' ' || lead(w, 2) over o as s
    from words window o as (partition by rid order by i)),
repeated as (
    select rid, i from (select rid, i, count(*) over (partition by rid, s) as c from windows where s is not null)
    where c > 1),
per_word as (
    select rid, count(distinct i + k) as n_repeat_words from repeated, (values (0), (1), (2)) v(k) group by rid),
counted as (
    select doc_id, len(regexp_extract_all(t, '{word}')) as n_words, word_chars,
           length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) as n_symbols, n_dup_lines,
           coalesce(n_repeat_words, 0) as n_repeat_words, n_failed_lines, lost_chars
    from d join per_line using (rid) left join per_word using (rid)),
based as (
    select *, n_words < {rules.min_words} or 100 * n_repeat_words > {rules.max_repeat_percent} * n_words
        as base_failed
    from counted)
select doc_id, n_words::bigint as n_words, word_chars::bigint as word_chars, n_symbols::bigint as n_symbols,
       n_dup_lines::bigint as n_dup_lines, n_repeat_words::bigint as n_repeat_words, base_failed,
       not base_failed and lost_chars * 100 <= {rules.max_lost_percent} * word_chars as kept,
       n_failed_lines::bigint as n_failed_lines, lost_chars::bigint as lost_chars
from based"""
