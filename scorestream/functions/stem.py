"""English suffix stripping (Porter 1980) as native column expressions.

Each step maps a word column to a word column, so a token array is stemmed by
nested ``transform`` calls: no Python worker, no join with a vocabulary, no
shuffle.  Suffixes are tested with ``endswith`` first; the costlier patterns
on the remaining stem run only for words that carry the suffix.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed values of the published algorithm.  A consonant run may start with y,
# a vowel run may start with y; the measure m counts vowel-consonant pairs.
_CONSONANTS = "[^aeiou][^aeiouy]*"
_VOWELS = "[aeiouy][aeiou]*"
_M_POSITIVE = f"^({_CONSONANTS})?{_VOWELS}{_CONSONANTS}"
_M_ONE = f"^({_CONSONANTS})?{_VOWELS}{_CONSONANTS}({_VOWELS})?$"
_M_ABOVE_ONE = f"^({_CONSONANTS})?{_VOWELS}{_CONSONANTS}{_VOWELS}{_CONSONANTS}"
_HAS_VOWEL = f"^({_CONSONANTS})?[aeiouy]"
_SHORT_END = f"^{_CONSONANTS}[aeiouy][^aeiouwxy]$"

_STEP_2 = {
    "ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize",
    "abli": "able", "alli": "al", "entli": "ent", "eli": "e", "ousli": "ous",
    "ization": "ize", "ation": "ate", "ator": "ate", "alism": "al", "iveness": "ive",
    "fulness": "ful", "ousness": "ous", "aliti": "al", "iviti": "ive", "biliti": "ble",
}
_STEP_3 = {
    "icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "",
    "ness": "",
}
_STEP_4 = (
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent",
    "sion", "tion", "ou", "ism", "ate", "iti", "ous", "ive", "ize",
)
# End of the fixed values.


def _without(word: Column, n: int) -> Column:
    return F.substring(word, F.lit(1), F.length(word) - n)


def _double_end(word: Column) -> Column:
    """Two equal consonants at the end."""
    last = F.right(word, F.lit(1))
    pair = (F.length(word) > 1) & (F.right(word, F.lit(2)) == F.concat(last, last))
    return pair & last.rlike("[^aeiou]")


def _plural(word: Column) -> Column:
    return (
        F.when(word.endswith("sses"), _without(word, 2))
        .when(word.endswith("ies"), _without(word, 2))
        .when(word.endswith("ss"), word)
        .when(word.endswith("s"), _without(word, 1))
        .otherwise(word)
    )


def _repair(stem: Column) -> Column:
    """Restore the ending a removed -ed or -ing leaves behind."""
    return (
        F.when(stem.rlike("(at|bl|iz)$"), F.concat(stem, F.lit("e")))
        .when(_double_end(stem) & ~stem.rlike("[lsz]$"), _without(stem, 1))
        .when(stem.rlike(_M_ONE) & stem.rlike(_SHORT_END), F.concat(stem, F.lit("e")))
        .otherwise(stem)
    )


def _past(word: Column) -> Column:
    def drop(n: int) -> Column:
        stem = _without(word, n)
        return F.when(stem.rlike(_HAS_VOWEL), _repair(stem)).otherwise(word)

    agreed = F.when(_without(word, 3).rlike(_M_POSITIVE), _without(word, 1)).otherwise(word)
    return (
        F.when(word.endswith("eed"), agreed)
        .when(word.endswith("ed"), drop(2))
        .when(word.endswith("ing"), drop(3))
        .otherwise(word)
    )


def _final_y(word: Column) -> Column:
    stem = _without(word, 1)
    to_i = word.endswith("y") & stem.rlike(_HAS_VOWEL)
    return F.when(to_i, F.concat(stem, F.lit("i"))).otherwise(word)


def _by_last_letter(rules):
    """Step that tries the longest suffix first, among those sharing the last letter."""
    groups: dict[str, list] = {}
    for suffix in sorted(rules, key=len, reverse=True):
        groups.setdefault(suffix[-1], []).append(suffix)

    def step(word: Column) -> Column:
        branches = F
        for letter, suffixes in groups.items():
            chain = F
            for suffix in suffixes:
                chain = chain.when(word.endswith(suffix), rules[suffix](word))
            branches = branches.when(word.endswith(letter), chain.otherwise(word))
        return branches.otherwise(word)

    return step


def _replaced(suffix: str, new: str):
    def rule(word: Column) -> Column:
        stem = _without(word, len(suffix))
        return F.when(stem.rlike(_M_POSITIVE), F.concat(stem, F.lit(new))).otherwise(word)

    return rule


def _dropped(cut: int):
    def rule(word: Column) -> Column:
        stem = _without(word, cut)
        return F.when(stem.rlike(_M_ABOVE_ONE), stem).otherwise(word)

    return rule


def _replace_suffix(table: dict[str, str]):
    return _by_last_letter({suffix: _replaced(suffix, new) for suffix, new in table.items()})


# -ion goes only after s or t, which stay part of the stem.
_drop_suffix = _by_last_letter(
    {s: _dropped(3 if s in ("sion", "tion") else len(s)) for s in _STEP_4}
)


def _final_e(word: Column) -> Column:
    stem = _without(word, 1)
    short = stem.rlike(_M_ONE) & ~stem.rlike(_SHORT_END)
    dropped = F.when(stem.rlike(_M_ABOVE_ONE) | short, stem).otherwise(word)
    return F.when(word.endswith("e"), dropped).otherwise(word)


def _final_ll(word: Column) -> Column:
    cut = word.endswith("ll") & word.rlike(_M_ABOVE_ONE)
    return F.when(cut, _without(word, 1)).otherwise(word)


_STEPS = (
    _plural,
    _past,
    _final_y,
    _replace_suffix(_STEP_2),
    _replace_suffix(_STEP_3),
    _drop_suffix,
    _final_e,
    _final_ll,
)


def _unless_short(step):
    return lambda word: F.when(word.startswith(" "), word).otherwise(step(word))


def stem_tokens(tokens: Column, lower: bool = True) -> Column:
    """Stem every token of an array.  Words of one or two letters stay."""
    words = F.transform(tokens, F.lower) if lower else tokens
    # The length rule is about the word as given, so it is decided up front.
    marked = F.transform(
        words, lambda w: F.when(F.length(w) > 2, w).otherwise(F.concat(F.lit(" "), w))
    )
    for step in _STEPS:
        marked = F.transform(marked, _unless_short(step))
    return F.transform(marked, lambda word: F.ltrim(word))


def stem_word(word: Column, lower: bool = True) -> Column:
    """Stem of a single-word column."""
    return F.element_at(stem_tokens(F.array(word), lower), 1)
