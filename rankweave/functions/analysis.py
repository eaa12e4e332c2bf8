"""Terms as a text index sees them: accents folded, words cut to a-z, suffixes stripped. All of it runs on the JVM."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: what separates terms after folding.
SEPARATOR = "[^a-z]+"
# Code points beyond this have no letter with an accent that folds to one other letter.
LAST_FOLDED = 0x2FFF

# Fixed values of the published suffix stripper of 1980: what a letter run is, and the measure of a stem (how often
# vowels are followed by consonants in it). ``y`` is a vowel unless it begins the word or follows a vowel.
CONSONANTS = "[^aeiou][^aeiouy]*"
VOWELS = "[aeiouy][aeiou]*"
SOME = f"^({CONSONANTS})?{VOWELS}{CONSONANTS}"  # measure above 0
ONE = f"^({CONSONANTS})?{VOWELS}{CONSONANTS}({VOWELS})?$"  # measure 1
MORE = f"^({CONSONANTS})?{VOWELS}{CONSONANTS}{VOWELS}{CONSONANTS}"  # measure above 1
VOWEL = f"^({CONSONANTS})?[aeiouy]"  # a vowel somewhere
SHORT = f"^{CONSONANTS}[aeiouy][^aeiouwxy]$"  # consonant, vowel, consonant other than w, x, y
DOUBLE = "^.*(bb|cc|dd|ff|gg|hh|jj|kk|mm|nn|pp|qq|rr|tt|vv|ww|xx)$"
PLURALS = {"sses": "ss", "ies": "i", "ss": "ss", "s": ""}
RESTORED = {"at": "ate", "bl": "ble", "iz": "ize"}
LONG_SUFFIXES = {
    "ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize", "abli": "able", "alli": "al",
    "entli": "ent", "eli": "e", "ousli": "ous", "ization": "ize", "ation": "ate", "ator": "ate", "alism": "al",
    "iveness": "ive", "fulness": "ful", "ousness": "ous", "aliti": "al", "iviti": "ive", "biliti": "ble",
}
MIDDLE_SUFFIXES = {"icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "", "ness": ""}
LAST_SUFFIXES = [
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ou", "ism", "ate", "iti", "ous",
    "ive", "ize",
]


def folding() -> tuple[str, str]:
    """(letters with an accent, the letters they fold to), then the combining marks, which fold to nothing."""
    plain, marks = [], []
    for code in range(0x80, LAST_FOLDED + 1):
        letter = chr(code)
        if unicodedata.combining(letter):
            marks.append(letter)
            continue
        base = "".join(c for c in unicodedata.normalize("NFD", letter) if not unicodedata.combining(c))
        if base != letter and len(base) == 1:
            plain.append((letter, base))
    return "".join(x for x, _ in plain) + "".join(marks), "".join(x for _, x in plain)


def fold_accents(text: Column) -> Column:
    """Letters without their accents; canonical decomposition without the combining marks."""
    marked, plain = folding()
    return F.translate(text, marked, plain)


def terms(text: Column) -> Column:
    """Lower-cased a-z runs of the folded text, repeats and order kept; NULL text has none."""
    parts = F.split(fold_accents(F.lower(F.coalesce(text, F.lit("")))), SEPARATOR)
    return F.filter(parts, lambda t: t != "")


def _replaced(word: Column, suffixes: dict[str, str], condition: str | None) -> Column:
    """The longest of the suffixes that the word has, replaced where the stem before it meets the condition."""
    pattern = f"^(.*?)({'|'.join(sorted(suffixes, key=len, reverse=True))})$"
    stem, suffix = F.regexp_extract(word, pattern, 1), F.regexp_extract(word, pattern, 2)
    pairs = F.create_map(*[F.lit(x) for pair in suffixes.items() for x in pair])
    fits = F.rlike(word, F.lit(pattern))
    if condition:
        fits &= F.rlike(stem, F.lit(condition))
    return F.when(fits, F.concat(stem, F.element_at(pairs, suffix))).otherwise(word)


def _without(word: Column, n: int) -> Column:
    return F.substring(word, F.lit(1), F.length(word) - n)


def stemming_steps() -> list:
    """The steps of the stemmer in order, each a function of the word so far."""

    def past(word: Column) -> Column:
        """eed, ed, ing; what ed or ing leave gets back an ending that a stem needs."""
        eed = F.rlike(word, F.lit("eed$"))
        stem = F.regexp_extract(word, "^(.*?)(ed|ing)$", 1)
        cut = F.rlike(word, F.lit("(ed|ing)$")) & F.rlike(stem, F.lit(VOWEL))
        mended = F.when(F.rlike(stem, F.lit("(at|bl|iz)$")), F.concat(stem, F.lit("e")))
        mended = mended.when(F.rlike(stem, F.lit(DOUBLE)), _without(stem, 1))
        mended = mended.when(F.rlike(stem, F.lit(ONE)) & F.rlike(stem, F.lit(SHORT)), F.concat(stem, F.lit("e")))
        whole = F.when(F.rlike(_without(word, 3), F.lit(SOME)), _without(word, 1)).otherwise(word)
        return F.when(eed, whole).when(cut, mended.otherwise(stem)).otherwise(word)

    def y_to_i(word: Column) -> Column:
        stem = _without(word, 1)
        return F.when(F.rlike(word, F.lit("y$")) & F.rlike(stem, F.lit(VOWEL)), F.concat(stem, F.lit("i"))).otherwise(word)

    def last(word: Column) -> Column:
        """A suffix that goes; ``ion`` only behind s or t."""
        pattern = f"^(.*?)({'|'.join(sorted(LAST_SUFFIXES, key=len, reverse=True))})$"
        stem = F.regexp_extract(word, pattern, 1)
        ion = F.regexp_extract(word, "^(.*?[st])ion$", 1)
        return (
            F.when(F.rlike(word, F.lit("[st]ion$")), F.when(F.rlike(ion, F.lit(MORE)), ion).otherwise(word))
            .when(F.rlike(word, F.lit(pattern)) & F.rlike(stem, F.lit(MORE)), stem)
            .otherwise(word)
        )

    def final_e(word: Column) -> Column:
        stem = _without(word, 1)
        goes = F.rlike(stem, F.lit(MORE)) | (F.rlike(stem, F.lit(ONE)) & ~F.rlike(stem, F.lit(SHORT)))
        return F.when(F.rlike(word, F.lit("e$")) & goes, stem).otherwise(word)

    def final_l(word: Column) -> Column:
        return F.when(F.rlike(word, F.lit("ll$")) & F.rlike(word, F.lit(MORE)), _without(word, 1)).otherwise(word)

    return [
        lambda word: _replaced(word, PLURALS, None),
        past,
        y_to_i,
        lambda word: _replaced(word, LONG_SUFFIXES, SOME),
        lambda word: _replaced(word, MIDDLE_SUFFIXES, SOME),
        last,
        final_e,
        final_l,
    ]


def with_stem(df, term: str, out: str = "stem"):
    """Add the stem of an a-z term. Each step is a projection of its own, so that no expression is repeated inside the next."""
    df = df.withColumn(out, F.col(term))
    for step in stemming_steps():
        df = df.withColumn(out, step(F.col(out)))
    return df
