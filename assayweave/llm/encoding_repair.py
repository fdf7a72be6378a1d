"""Text that went through a wrong character encoding (problem 9).

Two kinds of damage are told apart.

*Multibyte*: UTF-8 bytes shown in a legacy code page (``fÃ¼r``).  Characters are mapped
back to the bytes of a code page, a byte-structure automaton finds the maximal spans
that are well-formed multibyte sequences, and only those spans are decoded.  The result
is fed back, which undoes text encoded twice.

*Single byte*: bytes of one legacy code page shown in another (``FŸr``).  No byte
structure tells these, so a second stage compares each word holding a non-ASCII
character with the word that another pair of code pages would give: a word is garbled if
its counterpart is far more frequent over all documents or over all distinct texts.  Where
much of the input is damaged alike, frequencies don't tell; there a word is garbled if no
language writes it so and its counterpart is known, or if its pair of code pages is proven
by other words of the same text.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayweave.session import settle

#: Code pages in which UTF-8 bytes may have been shown, likeliest first.
PAGES = ("cp1252", "cp1250", "cp1251", "cp437", "cp866", "cp850", "mac_roman", "iso8859_2", "koi8_r")
#: (shown in, written in) pairs of single-byte code pages.
PAIRS = (
    ("cp1252", "mac_roman"), ("mac_roman", "cp1252"), ("cp437", "cp1252"), ("cp850", "cp1252"), ("cp1252", "cp437"), ("cp1252", "cp850"),
    ("cp1252", "cp1251"), ("cp1251", "cp1252"), ("cp1252", "iso8859_2"), ("iso8859_2", "cp1252"), ("cp1252", "cp1250"), ("cp1250", "cp1252"),
    ("iso8859_2", "cp1250"), ("cp1252", "koi8_r"), ("koi8_r", "cp1252"), ("cp1251", "koi8_r"), ("koi8_r", "cp1251"), ("cp866", "cp1251"),
    ("cp1251", "cp866"), ("cp1252", "cp866"), ("cp866", "cp1252"), ("cp437", "cp1250"), ("mac_roman", "cp1250"), ("cp1252", "iso8859_7"),
    ("cp1252", "cp1253"), ("mac_roman", "cp1251"), ("cp437", "cp1251"), ("cp437", "mac_roman"), ("mac_roman", "cp437"), ("cp1252", "cp852"),
    ("cp852", "cp1250"), ("cp1250", "cp852"),
)


def _page(name: str) -> dict[str, int]:
    """Character to byte for the upper half; bytes the page leaves free stand for themselves."""
    out = {}
    for byte in range(0x80, 0x100):
        try:
            out[bytes([byte]).decode(name)] = byte
        except UnicodeDecodeError:
            out[chr(byte)] = byte
    if name == "cp1252":  # shown as ISO 8859-1, the same page with controls
        out.update({chr(b): b for b in range(0x80, 0xA0)})
    return out


_BYTES = {name: _page(name) for name in set(PAGES) | {p for pair in PAIRS for p in pair}}
_CHARS = {name: {b: c for c, b in reversed(table.items())} for name, table in _BYTES.items()}
for _name in _CHARS:
    for _b in range(0x80, 0x100):
        try:
            _CHARS[_name][_b] = bytes([_b]).decode(_name)
        except UnicodeDecodeError:
            pass


def _byte_class(byte: int) -> str:
    """Role of a byte in the automaton: continuation, or lead of 2, 3 or 4 bytes."""
    if byte < 0xC0:
        return "c"
    return "2" if 0xC2 <= byte <= 0xDF else "3" if 0xE0 <= byte <= 0xEF else "4" if 0xF0 <= byte <= 0xF4 else "-"


class _Roles(dict):
    def __missing__(self, key: int) -> str:
        return "-"


_ROLES = {name: _Roles({ord(ch): _byte_class(b) for ch, b in _BYTES[name].items()}) for name in PAGES}
# Transitions of the automaton over roles; a span is a maximal run of whole sequences.
_SPAN = re.compile("(?:2c|3cc|4ccc)+")
_SEQUENCE = re.compile("2c|3cc|4ccc")
_RUN = re.compile("[^\x00-\x7f]{2,}")
_CONTROL = re.compile("[\x80-\x84\x86-\x9f�]")
_TYPOGRAPHIC = set(" ‚„…†‡‰‹‘’“”•–—™›«»­°±·§©®¶¬¦¤€")


def _expected(ch: str, page: str) -> bool:
    """Whether a decoded character occurs in the texts one expects: letters, signs, punctuation, emoji."""
    c = ord(ch)
    if c < 0xA0:
        return page == "cp1252" and c >= 0x80
    return (
        c <= 0x17F or c in (0x192, 0x2C6, 0x2DC) or 0x370 <= c <= 0x45F or c in (0x490, 0x491) or 0x2010 <= c <= 0x2046 or c in (0x2009, 0x200B, 0x202F, 0xFEFF, 0xFFFD)
        or 0x2070 <= c <= 0x209C or 0x20A0 <= c <= 0x23FF or 0x2500 <= c <= 0x27BF or 0x1F300 <= c <= 0x1FAFF or 0x3000 <= c <= 0x30FF or 0x4E00 <= c <= 0x9FFF
        or 0xAC00 <= c <= 0xD7A3 or 0xFB00 <= c <= 0xFB04 or 0xFE0F == c
    )


def _accept(text: str, start: int, stop: int, decoded: str, page: str) -> bool:
    """Whether a well-formed span is damage rather than letters that happen to stand together."""
    if not all(_expected(ch, page) for ch in decoded):
        return False
    span = text[start:stop]
    if page in ("cp1251", "koi8_r"):
        # genuine Cyrillic: a capital before punctuation, or a word that goes on beside the span
        if all(ch in _TYPOGRAPHIC for ch in span[1:]) and len(decoded) == 1:
            if span[1] in "°±·µ" or len(span) > 2:
                return True
            before, after = text[max(0, start - 1) : start], text[stop : stop + 1]
            latin = (before.isalpha() and before.isascii()) or (after.isalpha() and after.isascii())
            return latin and span[1] not in "  "
        if page == "koi8_r":
            return len(decoded) > 1
        return True
    if page == "cp866":
        # lower-case Cyrillic are lead and continuation bytes too; damage starts with a box
        # character, or shows a capital inside a word
        return all(0x2500 <= ord(ch) <= 0x259F for ch in span[::2]) if len(decoded[0].encode()) == 2 else 0x2000 <= ord(decoded[0]) <= 0x22FF
    if page == "cp850":
        return 0x2500 <= ord(span[0]) <= 0x259F or span[0] == "Ô"
    if page in ("iso8859_2", "cp1250"):
        return span[0] in "ĂÄĹÎâĎĐŃÂ"
    if page == "mac_roman":
        return span[0] in "√¬‚ƒ≈Œ–—Ãœ‘“"
    if page == "cp437":
        return span[0] in "┬├─┼╞╟╬╧╨╤ΓΓ≡"
    if page == "cp1252" and len(span) == 2:
        # a capital letter beside its closing punctuation or a spaced sign is not damage
        if span[1] in "–—”»…" and text[stop : stop + 1] in ("", " ", "\n") and span[0] in "ÅØÐÑÓÖÜÉÇ":
            return False
    return True


@lru_cache(maxsize=200_000)
def _well_formed(run: str) -> tuple[tuple[str, int, int, str], ...]:
    """Well-formed spans of a run of non-ASCII characters in any page: ``(page, start, stop, decoded)``."""
    out = []
    for page in PAGES:
        roles = run.translate(_ROLES[page])
        for found in _SPAN.finditer(roles):
            out += [(page, *piece) for piece in _runs(run, roles, found.start(), found.end(), _BYTES[page])]
    return tuple(out)


def damaged_spans(text: str) -> list[tuple[int, int, str]]:
    """Accepted maximal spans ``(start, stop, decoded)``; they never hold ASCII, so runs are looked at one by one.

    A span that could be genuine by itself is accepted where its page shows sure damage elsewhere.
    """
    sure, unsure = [], []
    for run in _RUN.finditer(text):
        base = run.start()
        for page, start, stop, decoded in _well_formed(run[0]):
            piece = (base + start, base + stop, decoded)
            if _accept(text, *piece, page):
                sure.append((page, piece))
            elif all(_expected(ch, page) for ch in decoded) and page in ("cp1252", "cp1251"):
                unsure.append((page, piece))
    pages = {page for page, _ in sure}
    return [piece for _, piece in sure] + [piece for page, piece in unsure if page in pages]


def _runs(text: str, roles: str, start: int, stop: int, table: dict[str, int]) -> Iterator[tuple[int, int, str]]:
    """The parts of a run that decode; a sequence that is overlong or a surrogate splits it."""
    raw = bytes(table[ch] for ch in text[start:stop])
    try:
        yield start, stop, raw.decode()
        return
    except UnicodeDecodeError:
        pass
    for m in _SEQUENCE.finditer(roles, start, stop):
        try:
            yield m.start(), m.end(), raw[m.start() - start : m.end() - start].decode()
        except UnicodeDecodeError:
            continue


def repair_multibyte(text: str) -> tuple[str, bool]:
    """``(text with the damaged spans decoded, whether there were any)``.

    Layers are undone until no span is left; each pass shortens the text, so it ends.
    """
    hit = False
    while found := damaged_spans(text):
        hit = True
        found.sort(key=lambda s: (s[0], -(s[1] - s[0])))
        out, at = [], 0
        for start, stop, decoded in found:
            if start >= at:
                out += [text[at:start], decoded]
                at = stop
        text = "".join(out) + text[at:]
    return text, hit


def has_control(text: str) -> bool:
    """Whether the text holds C1 controls or replacement characters, which no correct text does."""
    return bool(_CONTROL.search(text))


_EDGE = " \t\r\n!\"#$%&'()*+,-./:;<=>?@[]^_`{|}~\\"
_DIGITS = re.compile("[0-9]+")
_LOWER = re.compile("[a-z]{1,9}")
#: Words with at least so many letters stand for themselves; shorter ones are told by their neighbours.
LONG_WORD = 4


def _shape(token: str) -> str:
    """A neighbour as it enters a context: short plain words as they are, others by kind."""
    core = token.strip(_EDGE).lower()
    if not core:
        return "-"
    if _LOWER.fullmatch(core):
        return core
    return "N" if not core.isascii() else "0" if core[0].isdigit() else "L" if core.isalpha() and len(core) > 9 else "W"


_TOKEN = re.compile(r"\S+")
_INNER = re.compile(f"[^{re.escape(_EDGE)}]+")
#: Longer chains without blanks are taken apart at their punctuation.
LONG_CHAIN = 60


def _tokens(text: str) -> list[tuple[int, str]]:
    """``(start, token)`` between blanks; the words of a long chain are tokens of their own."""
    out = []
    for found in _TOKEN.finditer(text):
        token = found[0]
        if token.isascii() or len(token.strip(_EDGE)) <= LONG_CHAIN:
            out.append((found.start(), token))
        else:
            out += [(found.start() + piece.start(), piece[0]) for piece in _INNER.finditer(token)]
    return out


def contexts(text: str) -> dict[str, str]:
    """Context of each distinct non-ASCII word: ``{context: word}``.

    A context is ``before|word|after``; around long words both sides are left empty.
    """
    out: dict[str, str] = {}
    tokens = [token for _, token in _tokens(text)]
    for i, token in enumerate(tokens):
        if token.isascii():
            continue
        core = _DIGITS.sub("0", token.strip(_EDGE))
        if not core:
            continue
        if sum(map(str.isalpha, core)) >= LONG_WORD:
            out[f"|{core}|"] = core
        else:
            before = _shape(tokens[i - 1]) if i else "-"
            after = _shape(tokens[i + 1]) if i + 1 < len(tokens) else "-"
            out[f"{before}|{core}|{after}"] = core
    return out


_SWAPS = {(shown, written): str.maketrans({ch: _CHARS[written].get(b, ch) for ch, b in _BYTES[shown].items()}) for shown, written in PAIRS}


@lru_cache(maxsize=100_000)
def counterparts(word: str) -> tuple[tuple[int, str], ...]:
    """What ``word`` would be if shown in another page than it was written in: ``(pair, word)``."""
    out, seen = [], {word}
    for n, (shown, written) in enumerate(PAIRS):
        if all(ch in _BYTES[shown] for ch in word if ch > "\x7f"):
            other = word.translate(_SWAPS[shown, written])
            if other not in seen:
                seen.add(other)
                out.append((n, other))
    return tuple(out)


#: Signs that stand between letters in correct texts.
_JOINERS = _TYPOGRAPHIC - set("‚„†‡‰‹›°§®©¶¬¦¤€™") | set("−×→←↔⇌≤≥≈~‐‑\xad⁄′″")


@lru_cache(maxsize=10_000)
def _letter(ch: str) -> str:
    """Script of a letter, ``?`` of a micro sign and the like, empty for other characters."""
    if ch.isascii():
        return "LATIN" if ch.isalpha() else ""
    if unicodedata.category(ch) not in ("Lu", "Ll", "Lt", "Lo"):
        return ""
    script = unicodedata.name(ch, "?").split()[0]
    return script if script in ("LATIN", "CYRILLIC", "GREEK") else "?"


@lru_cache(maxsize=100_000)
def implausible(word: str) -> bool:
    """Whether no language writes ``word`` so, whatever the other texts hold.

    That is a sign between letters; a Latin capital beyond ASCII behind a small letter; a small
    Cyrillic letter before five capitals (fewer are units and kinds of RNA); a Cyrillic letter beside
    a Latin one; a Greek letter between small Latin ones; four Latin letters in a row beyond ASCII.
    """
    scripts = [_letter(ch) for ch in word]
    beyond = 0
    for i, (ch, script) in enumerate(zip(word, scripts)):
        beyond = beyond + 1 if script == "LATIN" and ch > "\x7f" else 0
        if beyond == 4:
            return True
        before, after = scripts[i - 1] if i else "", scripts[i + 1] if i + 1 < len(word) else ""
        if {before, script} == {"LATIN", "CYRILLIC"}:
            return True
        if not before or ch < "\x80":
            continue
        if script == "LATIN" and word[i - 1].islower() and ch.isupper():
            return True
        if script == "CYRILLIC" and word[i - 1].islower() and len(word[i : i + 5]) == 5 and all(x == "CYRILLIC" for x in scripts[i : i + 5]) and word[i : i + 5].isupper():
            return True
        if script == "GREEK" and before == after == "LATIN" and word[i - 1].islower() and word[i + 1].islower():
            return True
        if after and not script and ch not in _JOINERS and unicodedata.category(ch)[0] not in "MNC":
            return True
    return False


def _seen(documents: DataFrame, key: str, text: str) -> DataFrame:
    """One row per document and distinct context, and one without context per document with sure damage.

    ``copy`` is a hash of the text, which documents with the same text share.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            keys, found, words, copies = [], [], [], []
            for own, value, copy in zip(pdf[key], pdf[text], pdf["copy"]):
                if not value or value.isascii():
                    continue
                repaired, hit = repair_multibyte(value)
                if hit or has_control(value):
                    keys.append(own), found.append(None), words.append(None), copies.append(copy)
                here = contexts(repaired)
                keys += [own] * len(here)
                found += here.keys()
                words += here.values()
                copies += [copy] * len(here)
            if keys:  # a batch of plain texts has no rows
                yield pd.DataFrame({key: pd.Series(keys, dtype=pdf[key].dtype), "context": found, "word": words, "copy": copies})

    kind = documents.schema[key].dataType.simpleString()
    return documents.select(key, text, F.xxhash64(text).alias("copy")).mapInPandas(run, f"{key} {kind}, context string, word string, copy long")


def suspects(seen: DataFrame, least: int = 3, ratio: int = 4) -> DataFrame:
    """``context, pair, fixed, n_texts, m, sure`` of the contexts whose counterpart occurs in ``least`` documents.

    ``sure`` ones are garbled wherever they occur: the counterpart is far more frequent, over
    documents or over distinct texts, or the word is implausible and the counterpart is not.
    Counts are combined before the shuffle; only distinct contexts are compared.
    """
    counted = seen.where(F.col("context").isNotNull()).groupBy("context", "word").agg(F.count("*").alias("n"), F.countDistinct("copy").alias("n_texts"))

    def offer(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for context, word, n, n_texts in zip(pdf["context"], pdf["word"], pdf["n"], pdf["n_texts"]):
                before, after = context[: context.index("|")], context[context.rindex("|") + 1 :]
                odd = implausible(word)
                rows += [(context, n, n_texts, pair, other, f"{before}|{other}|{after}", odd - implausible(other)) for pair, other in counterparts(word)]
            yield pd.DataFrame(rows, columns=["context", "n", "n_texts", "pair", "fixed", "target", "odder"])

    offered = counted.mapInPandas(offer, "context string, n long, n_texts long, pair int, fixed string, target string, odder int")
    known = counted.select(F.col("context").alias("target"), F.col("n").alias("m"), F.col("n_texts").alias("m_texts"))
    frequent = (F.col("m") >= ratio * F.col("n")) | ((F.col("m_texts") >= least) & (F.col("m_texts") >= ratio * F.col("n_texts")))
    met = offered.join(known, "target").where(F.col("m") >= least).withColumn("sure", frequent | (F.col("odder") > 0))
    return met.where(F.col("sure") | (F.col("odder") == 0)).select("context", "pair", "fixed", "n_texts", "m", "sure")


def garbled_contexts(seen: DataFrame, least: int = 3, ratio: int = 4) -> DataFrame:
    """``context, copy, fixed`` of the garbled contexts; ``copy`` is null where a context is garbled in every text.

    A suspect that is not sure is garbled in the texts in which a sure one shows the same pair
    of code pages, and in every text if those are at least half of the texts that hold it.
    """
    found = settle(suspects(seen, least, ratio), "suspects")
    texts = seen.where(F.col("context").isNotNull()).select("context", "copy").distinct()
    proven = texts.join(found.where("sure").select("context", "pair").distinct(), "context").select("copy", "pair").distinct()
    backed = texts.join(found.where(~F.col("sure")), "context").join(proven, ["copy", "pair"])
    backed = settle(backed.select("context", "copy", "fixed", "n_texts", "m"), "backed").distinct()
    mostly = backed.groupBy("context", "fixed").agg(F.count("*").alias("k"), F.first("n_texts").alias("n_texts"), F.first("m").alias("m")).where(2 * F.col("k") >= F.col("n_texts"))
    ranked = found.where("sure").select("context", F.lit(1).alias("rank"), "m", "fixed").unionByName(mostly.select("context", F.lit(0).alias("rank"), "m", "fixed"))
    always = ranked.groupBy("context").agg(F.max(F.struct("rank", "m", "fixed")).alias("b")).select("context", F.lit(None).cast("long").alias("copy"), "b.fixed")
    here = backed.join(always.select("context"), "context", "left_anti").groupBy("context", "copy").agg(F.max(F.struct("m", "fixed")).alias("b"))
    return settle(always.unionByName(here.select("context", "copy", "b.fixed")), "garbled")


def _fixes(seen: DataFrame, key: str) -> DataFrame:
    """``key, context, fixed`` of the garbled contexts of each document."""
    garbled = garbled_contexts(seen)
    rows = seen.where(F.col("context").isNotNull())
    always = rows.join(garbled.where(F.col("copy").isNull()).drop("copy"), "context")
    here = rows.join(garbled.where(F.col("copy").isNotNull()), ["context", "copy"])
    return always.select(key, "context", "fixed").unionByName(here.select(key, "context", "fixed"))


def find_garbled(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Distinct ``key`` of the documents any part of which was decoded wrongly, restorable or not.

    Null, empty and pure-ASCII texts are never a case.
    """
    seen = settle(_seen(documents, key, text), "contexts")
    sure = seen.where(F.col("context").isNull()).select(key)
    likely = _fixes(seen, key).select(key)
    return sure.unionByName(likely).distinct()


def restore(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, restored, complete`` of the garbled documents.

    Multibyte spans are decoded and garbled words replaced by their counterparts.
    ``complete`` is false if damaged spans, or characters that no correct text holds, remain.
    """
    seen = settle(_seen(documents, key, text), "contexts")
    hits = seen.where(F.col("context").isNull()).select(key).distinct()
    per = _fixes(seen, key).groupBy(key).agg(F.collect_list(F.struct("context", "fixed")).alias("fixes"))
    wanted = hits.join(per, key, "full")
    kind = documents.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for own, value, pairs in zip(pdf[key], pdf[text], pdf["fixes"]):
                repaired, _ = repair_multibyte(value)
                known = {p["context"]: p["fixed"] for p in pairs} if pairs is not None else {}
                done = replace_words(repaired, known)
                out.append((own, done, not has_control(done) and not damaged_spans(done)))
            yield pd.DataFrame(out, columns=[key, "restored", "complete"])

    return documents.select(key, text).join(wanted, key).mapInPandas(run, f"{key} {kind}, restored string, complete boolean")


def replace_words(text: str, fixes: dict[str, str]) -> str:
    """``text`` with the words of garbled contexts replaced; digits, which contexts fold, are kept."""
    if not fixes:
        return text
    tokens = _tokens(text)
    out, at = [], 0
    for i, (place, token) in enumerate(tokens):
        if token.isascii():
            continue
        bare = token.strip(_EDGE)
        core = _DIGITS.sub("0", bare)
        before = _shape(tokens[i - 1][1]) if i else "-"
        after = _shape(tokens[i + 1][1]) if i + 1 < len(tokens) else "-"
        fixed = fixes.get(f"|{core}|") or fixes.get(f"{before}|{core}|{after}")
        if fixed is None or not bare:
            continue
        numbers = iter(_DIGITS.findall(bare))
        fixed = re.sub("0", lambda _: next(numbers, "0"), fixed)
        start = place + token.index(bare)
        out += [text[at:start], fixed]
        at = start + len(bare)
    return "".join(out) + text[at:]
