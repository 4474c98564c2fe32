"""Text column functions: normalising, synonyms, repair, decoding."""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Ordered (broken, fixed) pairs for text whose accents were lost.
ACCENT_REPAIRS = [
    ("Eltrico", "Elétrico"),
    ("El\xef\xbf\xbd\xef\xbf\xbd\xef\xbf\xbdtrico", "Elétrico"),
    ("Hbrido", "Híbrido"),
    ("No Informado", "Não Informado"),
    ("Econmico", "Econômico"),
    ("Baixa Relevncia", "Baixa Relevância"),
    ("Disponvel", "Disponível"),
    ("Analtico", "Analítico"),
    ("Mdio", "Médio"),
    ("Converso", "Conversão"),
    ("Anncios", "Anúncios"),
]
REPLACEMENT_CHAR = "�"


def strip(x: Column) -> Column:
    """Trim every kind of Unicode whitespace at both ends."""
    return F.regexp_replace(x, r"(?U)^\s+|\s+$", "")


def title_case(x: Column) -> Column:
    """Upper-case the first letter of every run of letters, lower-case the rest."""
    words = F.split(x, r"(?<=[^\p{L}])(?=\p{L})", -1)
    return F.array_join(F.transform(words, F.initcap), "")


def normalize_text(x: Column, default: str) -> Column:
    return title_case(strip(F.coalesce(x, F.lit(default))))


def unify_synonyms(x: Column, synonyms: Mapping[str, str]) -> Column:
    """Exact-match value map; anything unmapped stays."""
    out = x
    for old, new in synonyms.items():
        out = F.when(x == old, F.lit(new)).otherwise(out)
    return out


def brand_of(x: Column) -> Column:
    """First word of the entity name; any Unicode white space separates words."""
    return F.regexp_extract(x, r"(?U)^\s*(\S+)", 1)


def repair_text(x: Column, pairs: Sequence[tuple[str, str]] = ACCENT_REPAIRS) -> Column:
    """Drop the replacement character, then apply literal replacements in order."""
    x = F.replace(x, F.lit(REPLACEMENT_CHAR), F.lit(""))
    for broken, fixed in pairs:
        x = F.replace(x, F.lit(broken), F.lit(fixed))
    return x


def _cp1252_high() -> tuple[str, str]:
    points = [b for b in range(0x80, 0xA0) if bytes([b]).decode("cp1252", "ignore")]
    return "".join(map(chr, points)), "".join(bytes([b]).decode("cp1252") for b in points)


def decode_text(raw: Column) -> Column:
    """Bytes to text: UTF-8 when valid, otherwise Windows-1252."""
    as_utf8 = F.try_validate_utf8(raw.cast("string"))
    latin, western = _cp1252_high()
    return F.coalesce(as_utf8, F.translate(F.decode(raw, "ISO-8859-1"), latin, western))
