"""Quality rules as a short-circuit cascade of SQL expressions.

A rule rejects a text by a comparison of measures of the whole text. The order
of the rules comes from a sample: each rule is timed there and its rejections
are counted, and the rule with the most rejections per second among the texts
still undecided goes next. The verdict does not depend on the order (a text is
kept if no rule rejects it); the work does, as later rules are not evaluated for
texts that an earlier one rejects.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import BLANKS, WORD_GAP, spare_name, sql_text
from tillroll.sources.workspace import land

SYMBOLS = "#*$%&|<>"
WINDOW = 5
#: Rows of the sample on which rules are timed (chosen by a hash), at most about.
SAMPLE_ROWS = 2000
_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZÄÖÜÀÂÇÈÉÊËÎÏÔÙÛÁÍÓÚÑ"


_TRIMMED = f"btrim({{text}}, {sql_text(BLANKS)})"
#: Words of a text (no words: an empty array).
_WORDS = f"filter(split({_TRIMMED}, {sql_text(WORD_GAP)}), w -> w != '')"
#: 64-bit hashes of all windows of five words, in order.
_WINDOWS = (
    f"CASE WHEN size({{words}}) < {WINDOW} THEN array() ELSE transform(sequence(0, size({{words}}) - {WINDOW}), "
    "i -> xxhash64({words}[i], {words}[i + 1], {words}[i + 2], {words}[i + 3], {words}[i + 4])) END"
)
#: Words covered by windows that occur twice or more. Windows are sorted with their places;
#: a place counts if a neighbour has the same window; then places in order add what they newly cover.
_REPEATED = f"""
CASE WHEN size(array_distinct({{windows}})) = size({{windows}}) THEN 0L ELSE
  aggregate(
    sort_array(transform(filter(
      transform(array(sort_array(transform({{windows}}, (x, i) -> struct(x AS x, i AS i)))), s ->
        transform(s, (p, k) -> struct(p.i AS i,
          (k > 0 AND s[greatest(k - 1, 0)].x = p.x)
          OR (k < size(s) - 1 AND s[least(k + 1, size(s) - 1)].x = p.x) AS hit)))[0],
      p -> p.hit), p -> p.i)),
    struct(-{WINDOW} AS last, 0L AS covered),
    (acc, i) -> struct(i AS last, acc.covered + least({WINDOW}, i - acc.last) AS covered),
    acc -> acc.covered)
END"""
#: Each measure as SQL over {text}, {words} and {windows}.
MEASURES = {
    "n_words": "cast(size({words}) AS bigint)",
    "word_chars": f"cast(char_length(translate({{text}}, {sql_text(BLANKS)}, '')) AS bigint)",
    "n_symbols": f"cast(char_length({{text}}) - char_length(translate({{text}}, {sql_text(SYMBOLS)}, '')) AS bigint)",
    "n_lines": "cast(size({lines}) AS bigint)",
    "n_dup_lines": "cast(size({lines}) - size(array_distinct({lines})) AS bigint)",
    "n_repeat_words": _REPEATED,
    "n_capitals": f"cast(char_length({{text}}) - char_length(translate({{text}}, {sql_text(_CAPITALS)}, '')) AS bigint)",
}
_PARTS = {
    "words": _WORDS,
    "lines": f"filter(split({{text}}, '\\n'), l -> l rlike {sql_text('[^' + WORD_GAP[1:-2] + ']')})",
    "windows": _WINDOWS,
}


@dataclass(frozen=True)
class Rule:
    """A named rejection: SQL over the measures that it needs."""

    name: str
    needs: tuple[str, ...]
    reject: str


BASE_RULES = (
    Rule("few_words", ("n_words",), "n_words < 10"),
    Rule("repeated_windows", ("n_repeat_words", "n_words"), "100 * n_repeat_words > 20 * n_words"),
)
RULES = (
    Rule("symbols", ("n_symbols", "word_chars"), "100 * n_symbols > 8 * word_chars"),
    Rule("word_length", ("word_chars", "n_words"), "word_chars > 15 * n_words OR 2 * word_chars < 3 * n_words"),
    Rule("repeated_lines", ("n_dup_lines", "n_lines"), "n_dup_lines > 2 AND 10 * n_dup_lines > 3 * n_lines"),
    Rule("capitals", ("n_capitals", "word_chars"), "2 * n_capitals > word_chars"),
)


def measure(docs: DataFrame, names: list[str], text: str = "text") -> DataFrame:
    """Append measures of each whole text (null: the empty text); of clashing names the new columns stay.

    A text without a word measures 0 everywhere. Equal windows are told by a
    64-bit hash within one text.
    """
    kept = [c for c in docs.columns if c not in names]
    needs = " ".join(MEASURES[n] for n in names)
    step = {part: spare_name(part, docs.columns) for part in ("text", *_PARTS)}
    wide = docs.select(*kept, F.coalesce(F.col(text), F.lit("")).alias(step["text"]))
    # Each part is a column of its own, so that measures share it.
    if "{words}" in needs or "{windows}" in needs:
        wide = wide.withColumn(step["words"], F.expr(_PARTS["words"].format(**step)))
    if "{lines}" in needs:
        wide = wide.withColumn(step["lines"], F.expr(_PARTS["lines"].format(**step)))
    if "{windows}" in needs:
        wide = wide.withColumn(step["windows"], F.expr(_PARTS["windows"].format(**step)))
    return wide.select(*[F.col(f"`{c}`") for c in kept], *[F.expr(MEASURES[n].format(**step)).alias(n) for n in names])


def _whole(measure_name: str, text: str) -> str:
    """A measure as one expression over the text column, for evaluation inside a CASE branch."""
    t = f"coalesce(`{text}`, '')"
    words = _PARTS["words"].format(text=t)
    lines = _PARTS["lines"].format(text=t)
    if "{windows}" in MEASURES[measure_name]:
        # One-element arrays bind a value to a name, so that it is computed once.
        windows = f"transform(array({words}), ws -> {_WINDOWS.format(words='ws')})"
        return f"transform({windows}, g -> {MEASURES[measure_name].format(windows='g')})[0]"
    return MEASURES[measure_name].format(text=t, words=words, lines=lines)


def rejects(rule: Rule, text: str, have: set[str] = frozenset()) -> Column:
    """The rule as a condition; measures in ``have`` are columns, others are computed from the text."""
    sql = rule.reject
    for name in rule.needs:
        if name not in have:
            sql = _replace_word(sql, name, f"({_whole(name, text)})")
    return F.coalesce(F.expr(sql), F.lit(False))


def _replace_word(sql: str, word: str, by: str) -> str:
    return " ".join(by if part == word else part for part in sql.split(" "))


def plan_cascade(
    docs: DataFrame,
    rules: tuple[Rule, ...],
    key: str,
    text: str = "text",
    sample_rows: int = SAMPLE_ROWS,
    have: tuple[str, ...] = (),
    after: tuple[Rule, ...] = (),
) -> list[Rule]:
    """The rules in order of rejections per second, as measured on a sample of about ``sample_rows``.

    The sample is chosen by a hash of key and text. A rule's time is that of computing,
    from the text, the measures that it needs and that are not in ``have`` (those are
    columns where the rules run); only texts that pass the rules ``after`` which these
    come count as rejected. Rules that reject as many per second: the quicker one, then
    the one named first. An empty table gives the rules as they are.
    """
    n = docs.count()
    share = min(1.0, sample_rows / max(1, n))
    place = F.pmod(F.xxhash64(key, text), F.lit(1 << 30))
    chosen = docs.where(place < int(share * (1 << 30))).select(F.col(text).alias("text"))
    sample = land(measure(chosen, list(have)) if have else chosen, "sample")
    known = set(have)
    seconds = {}
    for rule in rules:
        best = []
        for _ in range(2):
            start = time.perf_counter()
            sample.agg(F.count_if(rejects(rule, "text", known))).collect()
            best.append(time.perf_counter() - start)
        seconds[rule.name] = min(best)
    reached = sample.where(cascade(sample, list(after), "text", known))
    hits = reached.select(*[rejects(r, "text", known).cast("int").alias(r.name) for r in rules])
    patterns = [(tuple(row)[:-1], row[-1]) for row in hits.groupBy(*[r.name for r in rules]).count().collect()]
    place_of = {r.name: i for i, r in enumerate(rules)}
    ordered, left = [], list(rules)
    while left:
        gain = {r.name: sum(c for hit, c in patterns if hit[place_of[r.name]]) / seconds[r.name] for r in left}
        best_rule = max(left, key=lambda r: (gain[r.name], -seconds[r.name]))
        ordered.append(best_rule)
        left.remove(best_rule)
        patterns = [(hit, c) for hit, c in patterns if not hit[place_of[best_rule.name]]]
    return ordered


def cascade(docs: DataFrame, ordered: list[Rule], text: str = "text", have: set[str] = frozenset()) -> Column:
    """Whether a text passes: a CASE whose branches stand in the given order, so that evaluation stops early."""
    verdict = F.lit(True)
    for rule in reversed(ordered):
        verdict = F.when(rejects(rule, text, have), False).otherwise(verdict)
    return verdict


def keep_by_rules(docs: DataFrame, key: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = BASE_RULES + RULES) -> DataFrame:
    """The rows that no rule rejects, all columns as they are; rules run in their planned order."""
    return docs.where(cascade(docs, plan_cascade(docs, rules, key, text), text))
