"""Text that displays alike brought to one form (problem 6).

Each letter of a token has a set of scripts it can be resolved to: its own, and Latin
(or Greek, Cyrillic, Armenian, Cherokee, Coptic, Lisu) where it has a twin there.  The sets of a token are intersected.
If Latin survives, the token is spelled in Latin: that mends mixed tokens (``hCΑX2``) and
tokens wholly of another script whose letters all have Latin twins.  If another script
survives, because a letter has no Latin twin, the token is a foreign word and keeps, or
gets, that script.  What is left (full-width and other compatibility forms, combining
marks, blanks, dashes, characters without width) is normalised character by character.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayweave.functions.textfold import DASHES, INVISIBLE, TWINS

# Signs that display like an ASCII sign.
SIGNS = {
    "’": "'", "‘": "'", "‛": "'", "′": "'", "ʹ": "'", "ʼ": "'", "＇": "'", "“": '"', "”": '"', "‟": '"', "″": '"', "‚": ",", "٬": ",",
    "∕": "/", "⁄": "/", "∶": ":", "꞉": ":", "∗": "*", "⁎": "*", "∼": "~", "˜": "~", "∣": "|", "ǀ": "|", "‹": "<", "›": ">", "˂": "<", "˃": ">",
    "․": ".", "…": "...", ";": ";", "﹢": "+", "⁺": "⁺",
}
#: Greek letters that stand for themselves in chemistry and never hint at a script.
SYMBOLS = set("αβγΔ")
MICRO = "µ"

_LATIN_OF = {twin: ascii_ for ascii_, twins in TWINS.items() for twin in twins if not unicodedata.name(twin).startswith("ROMAN")}
_ROMAN = re.compile("[Ⅰ-ⅿ]")
_KEEP = re.compile("[²³¹⁰ⁱ⁴-⁹⁺-ⁿ₀-₎ₐ-ₜªºᵃ-ᵪʰ-ʸˡ-ˣ]")
_DASH = set(DASHES) | {chr(c) for c in range(0x80, 0x10000) if unicodedata.category(chr(c)) == "Pd"}
_LETTERS = re.compile(r"[^\W\d_](?:[^\W_]|[̀-ͯ])*|\d+[^\W\d_](?:[^\W_]|[̀-ͯ])*")


#: Scripts that are told apart: Latin and those with letters that display like Latin ones.
SCRIPTS = ("Latin", "Greek", "Cyrillic", "Armenian", "Cherokee", "Coptic", "Lisu")


def script_of(ch: str) -> str:
    """Script of a letter, ``Common`` for anything else."""
    if not ch.isalpha() or ch == MICRO or _KEEP.match(ch):
        return "Common"
    if ch.isascii():
        return "Latin"
    name = unicodedata.name(ch, "").split(" ")[0].title()
    return name if name in SCRIPTS else "Other"


def _twin_table() -> dict[str, dict[str, str]]:
    """Script to spelling: Latin twins as given, and back from Latin to the other scripts."""
    table: dict[str, dict[str, str]] = {script: {} for script in SCRIPTS} | {"Latin": dict(_LATIN_OF)}
    for twin, ascii_ in _LATIN_OF.items():
        if script_of(twin) in SCRIPTS[1:]:
            table[script_of(twin)].setdefault(ascii_, twin)
    for twins in TWINS.values():
        for a in twins:
            for b in twins:
                if script_of(b) in SCRIPTS[1:] and script_of(a) != script_of(b):
                    table[script_of(b)].setdefault(a, b)
    return table


_TWIN = _twin_table()


def resolved_scripts(ch: str) -> set[str] | None:
    """Scripts in which the letter can be spelled; None for characters that fit any."""
    script = script_of(ch)
    if script == "Common":
        return None
    return {script} | {other for other, spelled in _TWIN.items() if ch in spelled}


def spell(token: str) -> str:
    """The token in its consistent script."""
    if token.isascii():
        return token
    kept = [ch for ch in token if ch not in SYMBOLS]
    sets = [s for s in map(resolved_scripts, kept) if s is not None]
    if not sets:
        return token
    common = set.intersection(*sets)
    if not common:
        # no script spells it all: the one that letters without twins ask for, else Latin
        bound = [next(iter(s)) for s in sets if len(s) == 1]
        foreign = [s for s in bound if s in _TWIN and s != "Latin"]
        latin = sum(ch.isascii() for ch in kept)
        common = {foreign[0]} if foreign and len(foreign) > latin else {"Latin"}
    script = "Latin" if "Latin" in common else sorted(common)[0]
    twins = _TWIN.get(script, {})
    return "".join(ch if ch in SYMBOLS else twins.get(ch, ch) for ch in token)


def _compatible(ch: str) -> str:
    """A single character in its plain form."""
    if ch < "\x7f" or ch in SYMBOLS:
        return ch
    if ch in "µμ":
        return ch
    if ch in INVISIBLE:
        return ""
    if ch in SIGNS:
        return SIGNS[ch]
    if ch in _DASH:
        return "-"
    kind = unicodedata.category(ch)
    if kind == "Zs":
        return " "
    if kind in ("Cf", "Cc") or "\U000e0100" <= ch <= "\U000e01ef":
        return ""
    if _KEEP.match(ch):
        return ch
    if _ROMAN.match(ch) or "＀" <= ch <= "￯" or "\U0001d400" <= ch <= "\U0001d7ff" or unicodedata.decomposition(ch).startswith(("<wide>", "<narrow>", "<font>", "<square>")) or "ﬀ" <= ch <= "ﬆ":
        plain = unicodedata.normalize("NFKC", ch)
        return "".join("-" if c in _DASH else SIGNS.get(c, c) for c in plain)
    return ch


def _micro(text: str) -> str:
    """Greek mu as the micro sign unless it is part of a Greek word."""
    if "μ" not in text:
        return text

    def fix(found: re.Match) -> str:
        token = found[0]
        others = [ch for ch in token if ch != "μ"]
        greek = any(script_of(ch) == "Greek" and ch not in SYMBOLS and "Latin" not in (resolved_scripts(ch) or ()) for ch in others)
        return token if greek else token.replace("μ", MICRO)

    return _LETTERS.sub(fix, text)


def consistent(text: str | None) -> str | None:
    """The consistent form of a text; null stays null, an ASCII text without controls stays as it is."""
    if text is None or (text.isascii() and text.isprintable()):
        return text
    plain = "".join(map(_compatible, text))
    plain = unicodedata.normalize("NFC", plain)
    return _LETTERS.sub(lambda found: spell(found[0]), _micro(plain))


#: Characters that take a text out of the ones that need no look.
SUSPECT = "[^\\x20-\\x7e]"


def normalized_fields(rows: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """``key, field, text, form`` of the fields that hold a non-ASCII character.

    Plain fields are dropped by a column expression before any Python runs; repeated
    texts are worked out once per batch.  No shuffle.
    """
    stacked = rows.select(key, F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("text")) for c in fields])).alias("f"))
    suspect = stacked.select(key, "f.field", "f.text").where(F.col("text").rlike(SUSPECT))
    kind = rows.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            known = {text: consistent(text) for text in pdf["text"].unique()}
            yield pdf.assign(form=pdf["text"].map(known))

    return suspect.mapInPandas(run, f"{key} {kind}, field string, text string, form string")


def inconsistent_fields(rows: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """``key, field`` of the fields whose text is not in the consistent form."""
    changed = normalized_fields(rows, key, fields).where(F.col("text") != F.col("form"))
    return changed.select(key, "field").distinct()
