"""Folding of look-alike characters to ASCII, as column expressions.

Used wherever numbers, units and keys are parsed; the result is for parsing only and
never shown.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# Letters of other scripts (Greek, Cyrillic, Armenian, Cherokee, Coptic, Lisu, Roman numerals, small capitals) that display like the ASCII letter.
TWINS = {
    "A": "ΑАᎪⲀꓮ", "B": "ΒВᏴⲂꓐ", "C": "ϹСⅭᏟⲤꓚ", "D": "ⅮᎠꓓ", "E": "ΕЕᎬⲈꓰ", "F": "Ϝꓝ", "G": "ԌᏀꓖ", "H": "ΗНᎻⲎꓧ", "I": "ΙІⅠӀⲒꓲ", "J": "ЈᎫꓙ", "K": "ΚКᏦⲔꓗ", "L": "ⅬᏞꓡ",
    "M": "ΜМⅯᎷⲘꓟ", "N": "ΝⲚꓠ", "O": "ΟОՕⲞꓳ", "P": "ΡРᏢⲢꓑ", "Q": "Ԛ", "R": "ᎡᏒꓣ", "S": "ЅՏᏕᏚꓢ", "T": "ΤТᎢⲦꓔ", "U": "Սꓴ", "V": "ⅤᏙꓦ", "W": "ԜᎳᏔꓪ", "X": "ΧХⅩⲬꓫ", "Y": "ΥҮᎩⲨꓬ", "Z": "ΖᏃⲌꓜ",
    "a": "аɑ", "b": "Ꮟ", "c": "ϲсⅽⲥᴄ", "d": "ԁⅾᏧꓒ", "e": "е", "f": "ք", "g": "ɡց", "h": "һհᏂ", "i": "іⅰıɩᎥ", "j": "јϳյ", "l": "ӏⅼ", "m": "ⅿ", "n": "ո", "o": "οоօⲟᴏ",
    "p": "ρрⲣ", "q": "ԛզգ", "s": "ѕꜱ", "u": "սᴜ", "v": "νⅴᴠ", "w": "ԝաᴡ", "x": "хⅹ", "y": "у", "z": "ᴢ",
}
# Dashes other than the hyphen-minus.
DASHES = "‐‑‒–—―−﹘﹣－⁃"
# Characters without any width.
INVISIBLE = "­͏؜᠎​‌‍‎‏‪‫‬‭‮⁠⁡⁢⁣⁤⁦⁧⁨⁩﻿" + "".join(map(chr, range(0xFE00, 0xFE10)))
SPACES = "".join(chr(c) for c in range(0x80, 0x3001) if unicodedata.category(chr(c)) == "Zs")
SUPERSCRIPTS = "⁺⁻⁰¹²³⁴⁵⁶⁷⁸⁹"
SUBSCRIPTS = "₀₁₂₃₄₅₆₇₈₉"

_PAIRS = {
    **{twin: ascii_ for ascii_, twins in TWINS.items() for twin in twins},
    **{dash: "-" for dash in DASHES},
    **{space: " " for space in SPACES},
    **{chr(0xFEE0 + n): chr(n) for n in range(0x21, 0x7F)},
    **dict(zip(SUPERSCRIPTS, "+-0123456789")),
    **dict(zip(SUBSCRIPTS, "0123456789")),
    "µ": "u", "μ": "u", "×": "x", "·": "x", "⋅": "x", "∗": "*", "∼": "~", "⁄": "/", "∕": "/", "′": "'", "’": "'", "‘": "'",
}


def fold(column: Column) -> Column:
    """Lower-case ASCII spelling of a text where there is one; superscripts become ``^digits``.

    Pure-ASCII texts, the bulk, skip the folding.  Null stays null.
    """
    raised = F.regexp_replace(column, f"([{SUPERSCRIPTS}]+)", "^$1")
    folded = F.translate(raised, "".join(_PAIRS) + INVISIBLE, "".join(_PAIRS.values()))
    return F.lower(F.when(column.rlike("[^\\x00-\\x7f]"), folded).otherwise(column))


def fold_text(text: str) -> str:
    """The same folding for one Python string."""
    out = []
    raised = False
    for ch in text:
        up = ch in SUPERSCRIPTS
        if up and not raised:
            out.append("^")
        raised = up
        if ch not in INVISIBLE:
            out.append(_PAIRS.get(ch, ch))
    return "".join(out).lower()
