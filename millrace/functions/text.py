"""Column functions over text: tokenisers, replacements, numbers and formats.

White space is ASCII unless said otherwise; patterns end with \\z rather than $, which would match before a last line
feed.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A word's edge by ASCII letters alone; the engine's own \\b also knows others.
EDGE = r"(?:(?<=\w)(?!\w)|(?<!\w)(?=\w))"
MARKS = ".,/#!$%^&*;:{}=-_`~()"
PUNCTUATION = "[" + MARKS.replace("-", r"\-") + "]"


def non_empty(parts: Column) -> Column:
    return F.filter(parts, lambda x: x != "")


def tokens_decimal(text: Column) -> Column:
    """Lower-case tokens; commas between digits are joined, decimal points stay, other punctuation goes."""
    x = F.regexp_replace(F.lower(text), r"(\d),(\d)", "$1$2")
    x = F.regexp_replace(x, r"[?!,]", " ")
    x = F.regexp_replace(x, r"\.(\s)", "$1")
    return non_empty(F.split(F.regexp_replace(x, r"\.\z", ""), r"\s+"))


def tokens_punct(text: Column) -> Column:
    """Lower-case tokens between single spaces; tabs and line feeds inside a token stay."""
    return non_empty(F.transform(F.split(F.translate(F.lower(text), ".,?!", "    "), " "), lambda t: F.trim(t)))


def tokens_space(text: Column) -> Column:
    """As `tokens_punct`, between runs of white space."""
    return non_empty(F.split(F.translate(F.lower(text), ".,?!", "    "), r"\s+"))


def tokens_strip(text: Column, seed: str | None = None) -> Column:
    """Words without punctuation; with a seed, half of those over seven characters are cut in two, the second marked ##."""
    words = F.transform(non_empty(F.split(text, r"\s+")), lambda w: F.regexp_replace(w, PUNCTUATION, ""))
    if seed is None:
        return words

    def halved(w: Column) -> Column:
        half = F.floor(F.length(w) / 2).cast("int")
        cut = (F.length(w) > 7) & (draw(F.lit(seed), w) > 0.5)
        return F.when(cut, F.array(F.substring(w, F.lit(1), half), F.concat(F.lit("##"), F.substring(w, half + 1, F.length(w))))).otherwise(F.array(w))

    return F.flatten(F.transform(words, halved))


def sentences(text: Column) -> Column:
    return non_empty(F.transform(F.split(text, r"[.;!?\r\n]+"), lambda s: F.trim(s)))


def capitalise(text: Column) -> Column:
    """First character in upper case, the rest as it is."""
    return F.concat(F.upper(F.substring(text, 1, 1)), F.substring(text, F.lit(2), F.length(text)))


def collapse_space(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def replace_word(text: Column, word: str, new: str) -> Column:
    """Every whole word, whatever its case."""
    return F.regexp_replace(text, rf"(?i){EDGE}{word}{EDGE}", new.replace("\\", r"\\").replace("$", r"\$"))


def grammar_slips(text: Column) -> Column:
    """Articles dropped, is for are, do for does."""
    x = F.regexp_replace(text, rf"(?i){EDGE}(a|an|the){EDGE}\s", "")
    x = F.regexp_replace(x, rf"{EDGE}is{EDGE}", "are")
    return collapse_space(F.regexp_replace(x, rf"{EDGE}does{EDGE}", "do"))


def overlapping_count(text: Column, key: Column) -> Column:
    """Occurrences of a literal, overlapping ones too, in one pass: the places that it begins at."""
    quoted = F.concat(F.lit(r"(?=\Q"), F.replace(key, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E)"))
    return F.when(text.isNull(), None).when(F.length(key) == 0, 0).otherwise(F.regexp_count(text, quoted)).cast("bigint")


def literal_count(text: Column, key: str) -> Column:
    """As `overlapping_count`, of a literal that is known. One that can't overlap itself is counted by what goes when it is taken out."""
    if any(key[:n] == key[-n:] for n in range(1, len(key))):
        return overlapping_count(text, F.lit(key))
    return F.floor((F.length(text) - F.length(F.replace(text, F.lit(key), F.lit("")))) / len(key)).cast("bigint")


def amount_digits(text: Column) -> Column:
    """Digits and points alone; the text itself if it has none."""
    return F.coalesce(F.nullif(F.regexp_replace(text, "[^0-9.]", ""), F.lit("")), text)


def placeholders(template: Column) -> Column:
    """Names in braces, in lower case."""
    return F.transform(F.regexp_extract_all(template, F.lit(r"\{(\w+)\}"), F.lit(1)), lambda x: F.lower(x))


def csv_field(text: Column) -> Column:
    """Quoted only if it holds a comma, a quote or a line feed; quotes doubled."""
    return F.when(text.rlike('[,\\n"]'), F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(text)


def without_fences(text: Column) -> Column:
    """A model's reply without the code fences around it."""
    return F.trim(F.regexp_replace(text, r"```(?:json)?", ""))


def draw(*parts: Column | str) -> Column:
    """A number in [0, 1) that depends on the parts alone, equal on every engine that has md5."""
    text = F.concat_ws("|", *(p.cast("string") if isinstance(p, Column) else F.lit(p) for p in parts))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)


def pick(values: list[str], *parts: Column | str) -> Column:
    """One of the values, by a draw."""
    return F.element_at(F.array(*map(F.lit, values)), (F.floor(draw(*parts) * len(values)) + 1).cast("int"))


def slip(word: Column, neighbours: dict[str, str], *key: Column | str) -> Column:
    """One slip at an inner character: half of the time one of its neighbours on the keyboard if it has any, else a swap with the next."""
    spot = (F.lit(2) + F.floor(draw(*key, "spot") * F.greatest(F.length(word) - 2, F.lit(1)))).cast("int")
    table = F.create_map(*(F.lit(x) for kv in neighbours.items() for x in kv))
    here, following = F.substring(word, spot, F.lit(1)), F.substring(word, spot + 1, F.lit(1))
    beside = F.try_element_at(table, F.lower(here))
    near = F.substring(beside, (F.floor(draw(*key, "near") * F.length(beside)) + 1).cast("int"), F.lit(1)) if max(map(len, neighbours.values()), default=1) > 1 else beside
    tail = F.length(word)
    return F.when((draw(*key, "kind") < 0.5) & near.isNotNull(), F.concat(F.substring(word, F.lit(1), spot - 1), near, F.substring(word, spot + 1, tail))).otherwise(F.concat(F.substring(word, F.lit(1), spot - 1), following, here, F.substring(word, spot + 2, tail)))


def typo(word: Column, neighbours: dict[str, str], *key: Column | str) -> Column:
    """One slip, in a fifth of the words two; words of three characters at most stay."""
    again = lambda once: F.when(draw(*key, "edits") < 0.2, slip(once, neighbours, *key, "again")).otherwise(once)
    return F.when(F.length(word) > 3, F.get(F.transform(F.array(slip(word, neighbours, *key)), again), 0)).otherwise(word)


def slips(text: Column, neighbours: dict[str, str], *key: Column | str) -> Column:
    """In 15 % of the texts of three words or more a typo in one word, in 10 % slips of grammar."""

    def one(words: Column) -> Column:
        at = F.floor(draw(*key, "word") * F.size(words))
        return F.array_join(F.transform(words, lambda w, i: F.when(i == at, typo(w, neighbours, *key)).otherwise(w)), " ")

    words = F.split(text, " ")
    typed = F.when((draw(*key, "typo") < 0.15) & (F.size(words) > 2), F.get(F.transform(F.array(words), one), 0)).otherwise(text)
    return F.get(F.transform(F.array(typed), lambda t: F.when(draw(*key, "grammar") < 0.1, grammar_slips(t)).otherwise(t)), 0)


def regional_slang(text: Column, region: Column, slang: dict[str, dict[str, str]], *key: Column | str) -> Column:
    """Each word that the region has slang for is replaced, whatever its case, in half of the texts, by a draw for each word."""

    def replaced(word: str) -> Callable[[Column], Column]:
        table = F.create_map(*(F.lit(x) for r, words in slang.items() if word in words for x in (r, words[word])))
        value = F.try_element_at(table, region)
        literal = F.replace(F.replace(value, F.lit("\\"), F.lit("\\\\")), F.lit("$"), F.lit("\\$"))
        pattern = F.lit(rf"(?i){EDGE}{re.escape(word)}{EDGE}")
        return lambda t: F.when(value.isNotNull() & (draw(*key, word) < 0.5), F.regexp_replace(t, pattern, literal)).otherwise(t)

    for word in dict.fromkeys(w for words in slang.values() for w in words):
        text = F.get(F.transform(F.array(text), replaced(word)), 0)
    return text


def grouped_digits(number: Column, indian: bool = False) -> Column:
    """A number with commas between groups of three digits, or of two before the last three; up to three decimals."""
    plain = F.regexp_replace(F.round(number, 3).cast("decimal(38,3)").cast("string"), r"\.?0+$", "")
    whole, rest = F.substring_index(plain, ".", 1), F.regexp_extract(plain, r"(\..*)$", 1)
    return F.concat(F.regexp_replace(whole, r"(\d)(?=(?:\d\d)+\d$)" if indian else r"(\d)(?=(?:\d{3})+$)", "$1,"), rest)


def mulberry_draw(seed: Column, n: Column | int = 1) -> Column:
    """The n-th draw of the 32-bit generator that adds 0x6d2b79f5 to its state, as a number in [0, 1)."""
    mask, count = F.lit(4294967295), n if isinstance(n, Column) else F.lit(n)

    def times(a: Column, b: Column) -> Column:
        """The low 32 bits of a product, without an overflow of 64 bits."""
        low, high = b.bitwiseAND(F.lit(65535)), F.shiftright(b, 16)
        return (a * low + F.shiftleft((a * high).bitwiseAND(F.lit(65535)), 16)).bitwiseAND(mask)

    state = (seed.cast("bigint").bitwiseAND(mask) + times(F.lit(0x6D2B79F5).cast("bigint"), count.cast("bigint"))).bitwiseAND(mask)
    t = times(state.bitwiseXOR(F.shiftright(state, 15)), state.bitwiseOR(F.lit(1)))
    t = t.bitwiseXOR((t + times(t.bitwiseXOR(F.shiftright(t, 7)), t.bitwiseOR(F.lit(61)))).bitwiseAND(mask))
    return t.bitwiseXOR(F.shiftright(t, 14)) / F.lit(4294967296.0)
