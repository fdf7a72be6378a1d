"""Hashing, numeric and guarding functions, as column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once, however often ``use`` mentions it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def record_id(*parts: Column) -> Column:
    """First 20 hex digits of the SHA-256 of the parts joined by a slash."""
    return F.substring(F.sha2(F.concat_ws("/", *parts), 256), 1, 20)


def scoped_id(pmcid: Column, label: Column) -> Column:
    """A label made unique by its article."""
    return F.concat(pmcid, F.lit(":"), label)


def row_hash(*columns: Column) -> Column:
    """Content hash of a row; hashes of a sorted set of rows give a content id."""
    return F.sha2(F.to_json(F.struct(*columns)), 256)


def content_id(hashes: Column) -> Column:
    """16 hex digits from an array of row hashes, whatever their order."""
    return F.substring(F.sha2(F.array_join(F.array_sort(hashes), ""), 256), 1, 16)


def content_sum(*columns: Column) -> Column:
    """16 hex digits for all rows of a group, whatever their order: an aggregate that gathers no list.

    The digits of the row hashes are added up in five parts, so copies of a row count.
    """
    digest = row_hash(*columns)
    parts = [F.sum(F.conv(F.substring(digest, at, 15), 16, 10).cast("decimal(20,0)")) for at in range(1, 65, 15)]
    return F.substring(F.sha2(F.concat_ws("/", F.count("*").cast("string"), *[p.cast("string") for p in parts]), 256), 1, 16)


def hash_modulus(text: Column, modulus: int) -> Column:
    """The SHA-1 of a text as one big number, modulo ``modulus``: the hex digits are folded."""
    digest = F.sha1(text)
    digits = F.transform(F.sequence(F.lit(1), F.lit(40)), lambda i: F.conv(F.substring(digest, i, F.lit(1)), 16, 10).cast("int"))
    return F.aggregate(digits, F.lit(0), lambda a, d: (a * 16 + d) % modulus)


def scaffold_split(scaffold: Column) -> Column:
    """train / valid / test at 80 / 10 / 10 by the scaffold's hash; null without scaffold."""
    bucket = hash_modulus(scaffold, 100)
    return F.when(scaffold.isNull(), None).when(bucket < 80, "train").when(bucket < 90, "valid").otherwise("test")


def molecule_split(molecule: Column) -> Column:
    """test / val / train at 10 / 10 / 80 by the molecule's hash; null without molecule."""
    bucket = hash_modulus(molecule, 10)
    return F.when(molecule.isNull(), None).when(bucket == 0, "test").when(bucket == 1, "val").otherwise("train")


def p_value(nm: Column, relation: Column) -> Column:
    """Negative logarithm of the molar value, three decimals; only for exact positive values."""
    return F.when((relation == "=") & (nm > 0), F.round(F.lit(9.0) - F.log10(nm), 3))


def two_figures(x: Column) -> Column:
    """A number at two significant figures, ties to even."""
    shift = F.floor(F.log10(F.abs(x))).cast("int") - 1
    scale = F.pow(F.lit(10.0), -shift.cast("double"))
    return F.when(x == 0, F.lit(0.0)).otherwise(F.bround(x * scale, 0) / scale)


def tolerant_equal(a: Column, b: Column, reference: Column, share: float = 0.02) -> Column:
    """Within ``share`` of the reference, or equal at two significant figures."""
    close = F.abs(a - b) <= F.lit(share) * F.abs(reference)
    figures = F.abs(two_figures(a) - two_figures(b)) <= 1e-9 * F.abs(two_figures(b))
    return close | figures


def media_type(content: Column) -> Column:
    """png, jpeg or gif by the leading bytes, else null."""
    head = F.hex(F.substring(content, 1, 4))
    return F.when(head.startswith("89504E47"), "image/png").when(head.startswith("FFD8FF"), "image/jpeg").when(head.startswith("47494638"), "image/gif")


def sheet_safe(text: Column) -> Column:
    """Text that a spreadsheet would run as a formula gets a leading quote; plain relations are exempt."""
    risky = text.rlike(r"^\s*[=+\-@\t\r]") & ~text.isin("=", "<", ">", "<=", ">=", "~")
    return F.when(risky, F.concat(F.lit("'"), text)).otherwise(text)


def safe_url(url: Column) -> Column:
    """The url if it is http or https, else null."""
    return F.when(F.lower(F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1)).isin("http", "https"), url)


def plain_doi(doi: Column) -> Column:
    """A doi in lower case; null is ''."""
    return F.lower(F.coalesce(doi, F.lit("")))


def slug(text: Column) -> Column:
    """Lower-case words joined by hyphens."""
    return F.regexp_replace(F.regexp_replace(F.lower(text), r"[^a-z0-9]+", "-"), "^-|-$", "")


def model_slug(name: Column) -> Column:
    """A model's name without vendor prefix and date suffix, for file names."""
    return F.regexp_replace(F.regexp_replace(name, r"^[a-z]+-(?=[a-z])", ""), r"-\d{8}$", "")


def show_number(x: Column, digits: int = 5) -> Column:
    """A number for display: at most ``digits`` decimals, no trailing zeros."""
    return F.regexp_replace(F.regexp_replace(F.format_string(f"%.{digits}f", x), r"0+$", ""), r"\.$", "")


def size_bucket(rows: Column) -> Column:
    """The size class of a data set by its rows."""
    return F.when(rows < 1000, "n<1K").when(rows < 10_000, "1K<n<10K").when(rows < 100_000, "10K<n<100K").when(rows < 1_000_000, "100K<n<1M").otherwise("n>1M")
