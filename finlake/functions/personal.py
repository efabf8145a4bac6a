"""Column builders for personal data: detection, masking, levels."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .columns import band

# The patterns that mark a text field as personal data.
# (?U) makes \d, \s and \b follow Unicode.
PII_PATTERNS = {
    "cpf": r"\d{3}\.\d{3}\.\d{3}-\d{2}",
    "cnpj": r"\d{2}\.\d{3}\.\d{3}/\d{4}-\d{2}",
    "email": r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b",
    "phone": r"\(\d{2}\)\s\d{4,5}-\d{4}",
    "credit_card": r"\d{4}\s\d{4}\s\d{4}\s\d{4}",
    "bank_account": r"\d{4,5}-\d{1}",
    "rg": r"\d{1,2}\.\d{3}\.\d{3}-\d{1}",
}

# Parts of a column name that mark the column as personal data.
PII_COLUMN_NAMES = ("cpf", "cnpj", "email", "telefone", "senha", "token")

PERMANENT = -1
RETENTION_DAYS = {"restricted": 2555, "confidential": 365}
SHORT_RETENTION_DAYS = 30


def _unicode(pattern: str) -> str:
    return f"(?U){pattern}"


# What a text must hold for a pattern to match at all: literals, looked for before any regular expression runs.
_LITERALS = {
    "cpf": (".",), "cnpj": (".", "/"), "email": ("@",), "phone": ("(", ")"), "credit_card": (), "bank_account": (), "rg": (".",),
}
_DASHED = ("cpf", "cnpj", "phone", "bank_account", "rg")
# Every match of cnpj and phone holds four digits, a dash and a digit, the least match of bank_account; every match of
# cpf holds the least match of rg. Tried from the dash backwards, only dashes cost anything.
_DASH = r"-(?:(?<=\d{4}-)|(?<=\d\.\d{3}\.\d{3}-))\d"
# No character before the @ of an address is an @, so a shorter run need not be tried.
_EMAIL = PII_PATTERNS["email"].replace("]+@", "]++@")


def _holds(value: Column, *literals: str) -> Column:
    return reduce(lambda a, b: a & b, [value.contains(x) for x in literals])


def dashed_number(value: Column) -> Column:
    """Whether any of the patterns with a dash matches; one pass over the text's dashes."""
    return value.contains("-") & value.rlike(_unicode(_DASH))


def contains_pii(value: Column) -> Column:
    """Whether any of the patterns matches; false for NULL."""
    email = value.contains("@") & value.rlike(_unicode(_EMAIL))
    return F.coalesce(dashed_number(value) | email | value.rlike(_unicode(PII_PATTERNS["credit_card"])), F.lit(False))


def pii_count(value: Column, kind: str, dashed: Column | None = None) -> Column:
    """Matches of one pattern, 0 for NULL; ``dashed`` is ``dashed_number(value)`` where it is known already."""
    pattern = _EMAIL if kind == "email" else PII_PATTERNS[kind]
    count = F.regexp_count(value, F.lit(_unicode(pattern)))
    gates = [_holds(value, *_LITERALS[kind])] if _LITERALS[kind] else []
    if kind in _DASHED:
        gates = [dashed_number(value) if dashed is None else dashed, *gates]
    possible = reduce(lambda a, b: a & b, gates, F.lit(True))
    return F.when(possible, F.coalesce(count, F.lit(0))).otherwise(0)


def sensitivity(fields_with_pii: Column) -> Column:
    return band(fields_with_pii, [(3, "restricted"), (2, "confidential"), (1, "internal")], "public")


def retention_days(level: Column) -> Column:
    out = F
    for name, days in RETENTION_DAYS.items():
        out = out.when(level == name, days)
    return out.otherwise(SHORT_RETENTION_DAYS)


def mask_hash(value: Column) -> Column:
    return F.substring(F.sha2(value.cast("string"), 256), 1, 8)


def mask_cpf(value: Column) -> Column:
    masked = F.concat(F.lit("***.***.***-"), F.substring(value, -2, 2))
    return F.when(F.length(value) == 11, masked).otherwise(mask_hash(value))


def mask_email(value: Column) -> Column:
    parts = F.split(value, "@")
    masked = F.concat(F.substring(parts[0], 1, 2), F.lit("***@"), F.get(parts, F.lit(1)))
    return F.when(value.contains("@"), masked).otherwise(mask_hash(value))


def mask_phone(value: Column) -> Column:
    masked = F.concat(F.lit("("), F.substring(value, 1, 2), F.lit(") ***-"), F.substring(value, -4, 4))
    return F.when(F.length(value) >= 10, masked).otherwise(mask_hash(value))


def mask_name(value: Column) -> Column:
    words = F.split(F.regexp_replace(value, r"(?U)^\s+|\s+$", ""), r"(?U)\s+")
    full = F.concat(F.get(words, F.lit(0)), F.lit(" "), F.substring(F.element_at(words, -1), 1, 1), F.lit("***"))
    return F.when(F.size(words) >= 2, full).otherwise(F.concat(F.substring(value, 1, 1), F.lit("***")))


# Fields with a mask of their own; every other field is replaced by a short hash.
MASKS = {"cpf": mask_cpf, "email": mask_email, "phone": mask_phone, "name": mask_name}


def column_sensitivity(name: Column) -> Column:
    lowered = F.lower(name)
    hit = F.lit(False)
    for part in PII_COLUMN_NAMES:
        hit = hit | lowered.contains(part)
    return F.when(hit, "PII").otherwise("NORMAL")
