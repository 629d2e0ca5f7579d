"""Porter stemming (M. F. Porter, "An algorithm for suffix stripping", 1980).

``porter_stem`` also knows the additions that the usual Python stemmer makes by default: a few
irregular words, short ``-ies``/``-ied`` words, and later rules of Porter's own. ``extended=False``
gives the paper alone. Runs once per distinct term, in Arrow batches; the corpus itself never passes
through Python.
"""

from __future__ import annotations

import re
import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# The stemmer travels to executors whole, so that none of them has to import this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The suffix rules of the paper.
STEP_2 = (
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"),
    ("abli", "able"), ("alli", "al"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous"),
    ("ization", "ize"), ("ation", "ate"), ("ator", "ate"), ("alism", "al"), ("iveness", "ive"),
    ("fulness", "ful"), ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"),
)
STEP_3 = (
    ("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"), ("ful", ""),
    ("ness", ""),
)
STEP_4 = (
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou",
    "ism", "ate", "iti", "ous", "ive", "ize",
)

# Additions to the paper.
IRREGULAR = {
    "sky": "sky", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie", "news": "news",
    "innings": "inning", "inning": "inning", "outings": "outing", "outing": "outing",
    "cannings": "canning", "canning": "canning", "howe": "howe", "proceed": "proceed",
    "exceed": "exceed", "succeed": "succeed",
}
EXTENDED_STEP_2 = tuple(r for r in STEP_2 if r[0] != "abli") + (("bli", "ble"), ("fulli", "ful"))

_VOWEL_RUN_THEN_CONSONANT_RUN = re.compile("v+c+")


def _shape(stem: str) -> str:
    """The stem as a string of v and c; y is a vowel after a consonant."""
    shape = ""
    for letter in stem:
        vowel = letter in "aeiou" or (letter == "y" and shape.endswith("c"))
        shape += "v" if vowel else "c"
    return shape


def _measure(stem: str) -> int:
    return len(_VOWEL_RUN_THEN_CONSONANT_RUN.findall(_shape(stem)))


def _double_consonant(stem: str) -> bool:
    return len(stem) > 1 and stem[-1] == stem[-2] and _shape(stem)[-1] == "c"


def _short_end(stem: str, extended: bool) -> bool:
    shape = _shape(stem)
    if extended and shape == "vc":
        return True
    return shape[-3:] == "cvc" and stem[-1] not in "wxy"


def _longest(word: str, suffixes) -> str | None:
    return max((s for s in suffixes if word.endswith(s)), key=len, default=None)


def _plurals(word: str, extended: bool) -> str:
    ending = _longest(word, ("sses", "ies", "ss", "s"))
    cut = {"sses": 2, "ies": 2, "s": 1}.get(ending, 0)
    if extended and ending == "ies" and len(word) == 4:
        cut = 1
    return word[: len(word) - cut]


def _past_and_progressive(word: str, extended: bool) -> str:
    if extended and word.endswith("ied"):
        return word[:-1] if len(word) == 4 else word[:-2]
    ending = _longest(word, ("eed", "ed", "ing"))
    if ending is None:
        return word
    stem = word[: -len(ending)]
    if ending == "eed":
        return word[:-1] if _measure(stem) > 0 else word
    if "v" not in _shape(stem):
        return word
    if stem.endswith(("at", "bl", "iz")):
        return stem + "e"
    if _double_consonant(stem) and stem[-1] not in "lsz":
        return stem[:-1]
    return stem + "e" if _measure(stem) == 1 and _short_end(stem, extended) else stem


def _final_y(word: str, extended: bool) -> str:
    if not word.endswith("y"):
        return word
    shape = _shape(word[:-1])
    turns = len(shape) > 1 and shape.endswith("c") if extended else "v" in shape
    return word[:-1] + "i" if turns else word


def _mapped(word: str, rules) -> str:
    table = dict(rules)
    ending = _longest(word, table)
    if ending is None or _measure(word[: -len(ending)]) == 0:
        return word
    return word[: -len(ending)] + table[ending]


def _second_step(word: str, extended: bool) -> str:
    if not extended:
        return _mapped(word, STEP_2)
    if word.endswith("alli") and _measure(word[:-4]) > 0:
        return _second_step(word[:-2], extended)
    if word.endswith("logi"):
        return word[:-1] if _measure(word[:-3]) > 0 else word
    return _mapped(word, EXTENDED_STEP_2)


def _stripped(word: str) -> str:
    ending = _longest(word, STEP_4)
    if ending is None:
        return word
    stem = word[: -len(ending)]
    allowed = _measure(stem) > 1 and (ending != "ion" or stem.endswith(("s", "t")))
    return stem if allowed else word


def _tidied(word: str, extended: bool) -> str:
    if word.endswith("e"):
        stem = word[:-1]
        measure = _measure(stem)
        if measure > 1 or (measure == 1 and not _short_end(stem, extended)):
            word = stem
    return word[:-1] if word.endswith("ll") and _measure(word[:-1]) > 1 else word


def porter_stem(word: str, extended: bool = True) -> str:
    """The stem of one lowercase word; words of one or two letters stay as they are."""
    if extended and word in IRREGULAR:
        return IRREGULAR[word]
    if len(word) <= 2:
        return word
    word = _past_and_progressive(_plurals(word, extended), extended)
    word = _second_step(_final_y(word, extended), extended)
    return _tidied(_stripped(_mapped(word, STEP_3)), extended)


@F.pandas_udf(StringType())
def stem(terms: pd.Series) -> pd.Series:
    return terms.map(porter_stem)
