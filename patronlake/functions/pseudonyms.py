"""Reproducible stand-in names, e-mail addresses and phone numbers, derived from md5(id)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from patronlake.functions.text import strip_accents

# The name and provider lists the pseudonyms are drawn from, in index order.
FIRST_NAMES = [
    "João", "Maria", "Pedro", "Ana", "Lucas", "Juliana", "Carlos", "Fernanda",
    "Rafael", "Larissa", "Bruno", "Patricia", "Felipe", "Camila", "Matheus",
    "Bianca", "Gustavo", "Amanda", "Thiago", "Letícia", "Leonardo", "Mariana",
    "Gabriel", "Beatriz", "André", "Raquel", "Diego", "Daniela", "Eduardo",
    "Vanessa", "Rodrigo", "Carolina", "Marcelo", "Aline", "Vinícius", "Natália",
]
LAST_NAMES = [
    "Silva", "Santos", "Oliveira", "Souza", "Lima", "Pereira", "Ferreira",
    "Costa", "Rodrigues", "Almeida", "Nascimento", "Araújo", "Melo", "Ribeiro",
    "Barbosa", "Cardoso", "Gomes", "Rocha", "Carvalho", "Martins", "Correia",
    "Mendes", "Moreira", "Freitas", "Nunes", "Reis", "Monteiro", "Teixeira",
]
EMAIL_DOMAINS = ["gmail.com", "hotmail.com", "yahoo.com.br", "outlook.com", "uol.com.br"]


def _hex_number(digest: Column, start: int, length: int) -> Column:
    return F.conv(F.substring(digest, start, length), 16, 10).cast("bigint")


def hex_mod(digest: Column, digits: int, modulus: int) -> Column:
    """(first ``digits`` hex digits as one number) mod ``modulus``.

    128 bits fit no Spark number type, so the remainder is folded over 8-digit chunks.
    """
    remainder = F.lit(0).cast("bigint")
    for start in range(1, digits + 1, 8):
        length = min(8, digits - start + 1)
        shifted = remainder * F.lit(16**length % modulus)
        remainder = (shifted + _hex_number(digest, start, length)) % F.lit(modulus)
    return remainder


def _pick(values: list[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def full_name(entity_id: Column) -> Column:
    digest = F.md5(entity_id)
    first = _pick(FIRST_NAMES, hex_mod(digest, 32, len(FIRST_NAMES)))
    # Dropping the last byte of the digest is the 8-bit shift.
    last = _pick(LAST_NAMES, hex_mod(digest, 30, len(LAST_NAMES)))
    return F.concat(first, F.lit(" "), last)


def email(entity_id: Column, name: Column | None = None) -> Column:
    name = full_name(entity_id) if name is None else name
    local = strip_accents(F.regexp_replace(F.lower(name), " ", "."))
    domain = _pick(EMAIL_DOMAINS, _hex_number(F.md5(entity_id), 1, 8) % len(EMAIL_DOMAINS))
    return F.concat(local, F.lit("."), F.left(entity_id, F.lit(4)), F.lit("@"), domain)


def phone(entity_id: Column) -> Column:
    h = _hex_number(F.md5(entity_id), 1, 12)
    return F.concat(
        F.lit("+55 "), (h % 79 + 11).cast("string"),
        F.lit(" "), (h % 100_000_000 + 900_000_000).cast("string"),
    )
